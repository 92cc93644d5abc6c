import collections
import zlib

import pytest
from pyspark.sql import functions as F

from scripts.oracle_check import digest
from tests.llm.helpers import SF001, WORD, duck, empty_docs, odd_docs, odd_rows
from tiertrip.llm import hilbert, mixing, registry


def check_law(rows, total, shards):
    per = collections.defaultdict(list)
    for r in rows:
        per[r["shard"]].append(r["slot"])
    counts = [len(per.get(s, [])) for s in range(shards)]
    assert sum(counts) == total and max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in per.values())


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 3), (4, 2)])
def test_hilbert_curve_visits_neighbours(spark, dims, bits):
    axes = [F.shiftright("id", bits * k).bitwiseAND(F.lit((1 << bits) - 1)) for k in reversed(range(dims))]
    rows = spark.range(1 << bits * dims).withColumn("h", hilbert.hilbert_index(axes, bits)).orderBy("h").collect()
    assert [r["h"] for r in rows] == list(range(1 << bits * dims))
    point = [[r["id"] >> bits * k & (1 << bits) - 1 for k in range(dims)] for r in rows]
    assert all(sum(abs(x - y) for x, y in zip(a, b)) == 1 for a, b in zip(point, point[1:]))


def test_shards_of_query(spark):
    rows = registry.op2_hilbert_shards(spark, SF001).collect()
    check_law(rows, 200, 40)
    texts = dict(duck().sql("SELECT doc_id, text FROM documents").fetchall())
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
    rel = duck().sql(registry.ORACLE["op2_hilbert_shards"])
    assert digest(rel.columns, rel.fetchall())[1] == digest(list(rows[0].asDict()), [tuple(r) for r in rows])[1]


def test_shards_follow_the_curve_and_split_hot_cells(spark, monkeypatch):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"), F.lit("hot").alias("source"),
                                    F.lit("en").alias("lang")).where("doc_id < 2000 OR doc_id % 2 = 0")
    monkeypatch.setattr(hilbert, "GROUP_ROWS", 50)
    rows = hilbert.shard(docs.repartition(7), 11).collect()
    check_law(rows, 2500, 11)
    level = lambda r: min(15, r["doc_id"] // (2998 // 16 + 1))
    # One dimension varies: a shard holds few of its levels, and each level lies in few shards.
    for s in range(11):
        assert len({level(r) for r in rows if r["shard"] == s}) <= 3
    for k in range(16):
        assert len({r["shard"] for r in rows if level(r) == k}) <= 3


def test_shard_odd_rows(spark):
    docs = odd_docs(spark)
    out = hilbert.shard(docs, 5)
    check_law(out.collect(), len(odd_rows()), 5)
    assert set(docs.columns) <= set(out.columns) and len(out.columns) == len(set(out.columns))
    assert hilbert.shard(empty_docs(spark), 5).count() == 0


def test_mix_equals_oracle(spark):
    df = registry.op10_source_mix(spark, SF001)
    rel = duck().sql(registry.ORACLE["op10_source_mix"])
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[1] == digest(rel.columns, rel.fetchall())[1]


def fill(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Targets by repeated resharing of the excess."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        part = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = [s for s in rest if part[s] > most * sizes[s] + 1e-9]
        if not over:
            return fixed | part
        fixed |= {s: most * sizes[s] for s in over}


def test_targets_and_copies(spark):
    sizes = {"b": 1000, "a": 10, None: 400, "é": 300, "c": 0, "d": 2500}
    made = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()
    want = fill(sizes)
    assert all(abs(r["target"] - want[r["source"]]) < 1e-6 for r in made) and len(made) == len(sizes)
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text"),
                                    F.when(F.col("id") % 3 > 0, F.concat(F.lit("s"), F.col("id") % 3)).alias("source"))
    rows = mixing.plan(docs).collect()
    by = collections.defaultdict(lambda: [0, 0])
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by[r["target"]][0] += r["taken"]
    assert all(abs(v[0] - t) < 0.1 * t for t, v in by.items())
    mixed = mixing.mix(docs).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in mixed} == {r["doc_id"]: r["copies"] for r in rows if r["copies"]}


def test_mix_odd_rows(spark, monkeypatch):
    docs = odd_docs(spark)
    rows = mixing.plan(docs).collect()
    assert len(rows) == len(odd_rows())
    size = collections.Counter(len(WORD.findall(r[1] or "")) for r in odd_rows())
    assert collections.Counter(r["size"] for r in rows) == size
    out = mixing.mix(docs)
    assert out.columns == docs.columns and out.count() == sum(r["copies"] for r in rows)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)  # the salted join gives the same
    assert sorted(map(str, mixing.plan(docs).collect())) == sorted(map(str, rows))
    assert mixing.plan(empty_docs(spark)).count() == 0


def test_shards_of_ids_across_the_whole_bigint_range(spark):
    ids = [-9 * 10 ** 18, -5, None, 0, 7, 9 * 10 ** 18, 2 ** 63 - 1, -2 ** 63]
    docs = spark.createDataFrame([(i, f"text {i}", "s", "en") for i in ids], "doc_id long, text string, source string, lang string")
    rows = hilbert.shard(docs, 3).collect()
    check_law(rows, len(ids), 3)
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(map(str, ids))
