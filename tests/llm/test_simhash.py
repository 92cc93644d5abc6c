import collections
import random

import xxhash

from tests.llm.helpers import SF001, WORD, empty_docs, odd_docs, odd_rows, table
from tiertrip.llm import components, registry, simhash


def brute(text, n=4):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(lower)
    grams = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def union(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_fingerprints():
    texts = [t for t, in table(SF001, "SELECT text FROM documents LIMIT 60")] + [r[1] for r in odd_rows() if len(r[1] or "") < 9000]
    for t in texts + ["É e É e É", "a\x85b c d e", "one two", "A B C D"]:
        assert simhash.simhash(t) == brute(t)


def test_links_equal_all_pairs(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(120)]
    fps = set(base) | {0, (1 << 64) - 1}
    for x in base:
        for d in (1, 2, 3, 4, 5, 6, 7):
            y = x
            for b in rng.sample(range(64), d):
                y ^= 1 << b
            fps.add(y)
    signed = {f - (1 << 64) if f >> 63 else f: f for f in fps}
    nodes = spark.createDataFrame([(s,) for s in signed], "fp long")
    for tau in (1, 2, 4, 6):
        got = {(r["u"], r["v"]) for r in simhash.links(nodes, tau).collect()}
        order = sorted(signed)
        want = {(a, b) for i, a in enumerate(order) for b in order[i + 1:] if (signed[a] ^ signed[b]).bit_count() <= tau}
        assert got == want, tau


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(1000 + i, 1001 + i) for i in range(40)]
    edges += [(2000, 3000 + i) for i in range(200)] + [(7, 7), (7, None)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    real = [(a, b) for a, b in edges if b is not None and a != b]
    assert got == union({n for e in real for n in e}, real)
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def expected(rows, tau=4):
    """(id, fingerprint) -> component id, by all pairs."""
    fps = sorted({f for _, f in rows})
    pairs = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if (a ^ b).bit_count() <= tau]
    root = union(fps, pairs)
    least = {}
    for i, f in rows:
        r = root[f]
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return {(i, f): least[root[f]] for i, f in rows}


def test_query_equals_all_pairs(spark):
    docs = table(SF001, "SELECT doc_id, text FROM documents")
    want = expected([(i, brute(t)) for i, t in docs])
    got = registry.op5_simhash_pigeonring(spark, SF001).collect()
    assert {(r["doc_id"], int(r["fingerprint"], 16)): r["component_id"] for r in got} == want
    assert len(got) == 200 and all(len(r["fingerprint"]) == 16 for r in got)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    got = collections.Counter((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect())
    rows = [(r[0], brute(r[1])) for r in odd_rows()]
    want = expected(rows)
    assert got == collections.Counter((i, want[i, f]) for i, f in rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    fps = {f for _, f in rows}
    roots = union(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4])
    assert kept.count() == len(set(roots.values()))
    assert {r["doc_id"] for r in kept.collect()} >= {1, 4, 5}
    assert simhash.keep_one(empty_docs(spark)).count() == 0


def test_hub_joins_are_split(spark):
    """Half of all edges meet in one node: every star step's join splits its partition."""
    from pyspark.sql import functions as F
    from tests.conftest import plan_text
    from tiertrip.llm import components as comp
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        hub = spark.range(1, 60_000).select(F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") + 1_000_000).alias("u"),
                                            (F.col("id") + 100_000).alias("v"))
        edges = comp.stash(hub, "edges")
        for step in (comp._large_star, comp._small_star):
            df = step(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")) if step is comp._large_star else
                      edges.select(F.when(F.col("u") == 0, 2_000_000).otherwise(F.col("u")).alias("u"), "v"))
            df.collect()
            assert "skew=true" in plan_text(df, "simple"), step
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    got = {r["node"]: r["root"] for r in comp.components(spark.createDataFrame([(5, 3), (3, 1), (9, 8)], "u long, v long")).collect()}
    assert got == {5: 1, 3: 1, 1: 1, 9: 8, 8: 8}
