import collections
import hashlib
import zlib

import corpus_pipeline
from tests.llm.helpers import SF001, WORD, empty_docs, odd_docs, table
from tests.llm.test_sharding_mixing import check_law, fill
from tests.llm.test_simhash import brute as fingerprint
from tests.llm.test_simhash import expected
from tiertrip.llm import decontaminate


def brute(docs, items):
    """The rows run() keeps, by all pairs and plain loops: {doc_id: copies}."""
    docs = [d for d in docs if any(c.isalpha() for c in d[1] or "")]
    comp = expected([(d[0], fingerprint(d[1])) for d in docs])
    docs = [d for d in docs if comp[d[0], fingerprint(d[1])] == d[0]]
    own = [decontaminate.shingles(t, 5) for t, in items]
    docs = [d for d in docs if not any(o and len(o & decontaminate.shingles(d[1], 5)) >= 0.8 * len(o) for o in own)]
    size = {d[0]: len(WORD.findall(d[1])) for d in docs}
    per = collections.Counter()
    for d in docs:
        per[d[2]] += size[d[0]]
    target, out = fill(per), {}
    for d in docs:
        rate = target[d[2]] / per[d[2]]
        draw = int(hashlib.md5(f"42:{d[0]}".encode()).hexdigest()[:13], 16) / (1 << 52)
        out[d[0]] = int(rate) + (draw < rate - int(rate))
    return {i: n for i, n in out.items() if n}


def test_run_equals_brute_force(spark):
    docs = table(SF001, "SELECT doc_id, text, source FROM documents")
    want = brute(docs, table(SF001, "SELECT text FROM benchmark"))
    rows = corpus_pipeline.run(spark, SF001).collect()
    assert dict(collections.Counter(r["doc_id"] for r in rows)) == want
    check_law(rows, sum(want.values()), 40)
    texts = {i: t for i, t, _ in docs}
    assert all(r["text"] == texts[r["doc_id"]] and r["text_crc32"] == zlib.crc32(r["text"].encode()) for r in rows)


def test_stages_take_odd_and_empty_tables(spark):
    for docs in (odd_docs(spark), empty_docs(spark)):
        columns = docs.columns
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF001)
            assert out.columns == columns if i < 4 else set(columns) <= set(out.columns)
            out.collect()
