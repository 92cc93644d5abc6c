import collections
import zlib

import numpy as np
import pyarrow as pa

from tests.llm.helpers import SF001, SF01, WORD, empty_docs, odd_docs, odd_rows, prose, table
from tiertrip.llm import quality_mil, quality_rules, registry
from tiertrip.llm.common import within


def counts(text):
    words = WORD.findall(text or "")
    windows = list(zip(words, words[1:], words[2:]))
    times = collections.Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, dup, len(covered)


def test_counts_equal_brute_force():
    texts = [t for t, in table(SF001, "SELECT text FROM documents")] + [r[1] for r in odd_rows()]
    texts += ["a b c a b c a", "x\nx\n\nx \n x", "w " * 300, "one\x0btwo\x0cthree\x85four\xa0five"]
    stats = quality_rules.statistics(texts)
    for i, t in enumerate(texts):
        got = tuple(int(stats[k][i]) for k in quality_rules._COUNTS)
        assert got == counts(t), t and t[:60]


def test_rules_query_on_labels(spark):
    out = {r["doc_id"]: r for r in registry.op3_rule_votes(spark, SF01).collect()}
    assert len(out) == 1000
    for i, q in table(SF01, "SELECT doc_id, quality FROM labels"):
        r = out[i]
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
    hits = [out[i]["kept"] == bool(q) for i, q in table(SF01, "SELECT doc_id, quality FROM labels") if not out[i]["base_failed"]]
    assert np.mean(hits) > 0.98


def test_rules_odd_rows(spark):
    rows = quality_rules.judge(odd_docs(spark)).collect()
    assert len(rows) == len(odd_rows()) and all(r["kept"] is not None for r in rows)
    assert quality_rules.judge(empty_docs(spark)).count() == 0


def test_attention_gradient():
    rng = np.random.default_rng(1)
    net, first = quality_mil.Network(), np.array([0, 3, 4, 9])
    x, y = rng.normal(size=(9, quality_mil.WIDTH)), np.array([1.0, 0.0, 1.0])

    def loss():
        p = net._forward(x, first)["y"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for k, g in net._gradient(x, first, y).items():
        at = tuple(s // 2 for s in g.shape)
        net.p[k][at] += 1e-5
        up = loss()
        net.p[k][at] -= 2e-5
        assert abs((up - loss()) / 2e-5 - g[at]) < 1e-6, k
        net.p[k][at] += 1e-5


def test_attention_query_on_held_out_labels(spark):
    out = {r["doc_id"]: r for r in registry.op4_attention_mil(spark, SF01).collect()}
    assert len(out) == 1000
    hits = []
    for i, q in table(SF01, "SELECT doc_id, quality FROM labels"):
        assert out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= out[i]["score"] <= 1 and out[i]["predicted"] == int(out[i]["score"] >= 0.5)
        if out[i]["held_out"]:
            hits.append(out[i]["predicted"] == q)
    assert np.mean(hits) > 0.9


def test_attention_weighs_the_bad_passage(spark):
    bad, rows, labels = "CLICK!! HERE!! " * 32, [], []
    for i in range(120):
        text = " ".join(prose(100 + i + 1000 * j, 64) for j in range(3))
        rows.append((i, text.replace(".", "", 1) if i % 2 else text + " " + bad))
        labels.append((i, i % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    net = quality_mil.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    x, first = quality_mil.encode([prose(9, 192) + " " + bad, prose(8, 256)])
    assert net.score(x, first)[0] < 0.5 < net.score(x, first)[1]
    assert net.attention(x, first)[:first[1]].argmax() >= 2


def test_attention_learns_from_long_documents(spark):
    rows = [(i, prose(i, 64 * 260) if i % 2 else "CLICK!! HERE!! " * 32 * 260) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    for most in (400_000, 1000, 1):
        net = quality_mil.fit(docs, labels, train_passages=most)
        assert net.constant is None and net.score(*quality_mil.encode([prose(99, 640)])).item() != 0.5
    assert within([(1, 0, 5), (2, 0, 5), (3, 0, 5), (4, 1, 9), (5, 1, 1)], 10) == [1, 2, 4]
    texts = [None, "", "a b", " ".join("w" * 200), prose(3, 129), "x\n\ny"]
    sizes = next(quality_mil._sizes([pa.RecordBatch.from_arrays(
        [pa.array([1] * 6), pa.array(range(6)), pa.array(texts)], names=["y", "id", "text"])]))
    assert sizes["n"].to_pylist() == np.diff(quality_mil.encode(texts)[1]).tolist()


def test_attention_odd_rows(spark):
    docs, labels = odd_docs(spark), spark.createDataFrame([(5, 1), (7, 0), (7, 1), (None, 1), (9, 0), (8, None)], "doc_id long, quality int")
    net = quality_mil.fit(docs, labels)
    rows = docs.select(quality_mil.score(docs["text"], net).alias("s")).collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r["s"] <= 1 for r in rows)
    none = quality_mil.fit(empty_docs(spark), labels.where("doc_id < 0"))
    assert none.constant == 0.5


def test_a_document_that_does_not_fit_ends_no_sample():
    from tiertrip.llm.common import within
    rows = [(0, 1, 10), (1, 0, 400_001)] + [(i, i % 2, 5) for i in range(2, 4000)]
    kept = within(rows, 400_000)
    assert kept[:2] == [0, 1]  # the first of each label always
    rows = [(0, 1, 10), (1, 0, 5), (2, 0, 400_001)] + [(i, i % 2, 5) for i in range(3, 4000)]
    assert len(within(rows, 400_000)) == 3999
