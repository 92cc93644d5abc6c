"""Token files, whitening and hard negatives against brute force, and their odd rows."""

import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scripts.oracle_check import digest
from tests.llm.helpers import SF001, duck, empty_docs, odd_docs, odd_rows
from tiertrip.llm import hard_negatives, registry, token_files, whitening

BPE = public_tokenizers.path("word_bpe_49k.json")
VECTORS = "vec_id long, embedding array<float>, label int, id string, x string, `a.b` string, score string, slot string"


def vector_rows():
    """NULLs in every column and entry, non-finite, empty, short, huge, zero, equal and repeated rows."""
    rng = random.Random(4)
    v = lambda n=6: [rng.gauss(0, 1) for _ in range(n)]
    more = ("m",) * 5
    same = v()
    rows = [(i, v(), i % 3, *more) for i in range(60)]
    rows += [(100, None, 1, *more), (101, v(), None, *more), (None, v(), 2, *[None] * 5), (102, [1.0, None, 2.0, 3.0, 4.0, 5.0], 0, *more),
             (103, [1.0, math.nan, 2.0, 3.0, 4.0, 5.0], 0, *more), (104, [math.inf] * 6, 0, *more), (105, [], 0, *more),
             (106, v(4), 0, *more), (107, same, 1, *more), (108, same, 1, *more), (150, same, 2, *more), (150, same, 2, *more),
             (200, [0.0] * 6, 1, *more), (-50, v(), 0, *more)]
    return rows


def tokens(text):
    return Tokenizer.from_file(BPE).encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(BPE)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("aAb 'sTt<|endoftext|>09.!éÉß́\x1f\x85²ªµ日\n\t")), max_size=60))
def test_word_encoder_is_the_tokenizer(text):
    enc = token_files.encoder(BPE)
    assert enc.wordwise
    assert np.frombuffer(enc.encode(text.encode()), enc.dtype).tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids


def test_word_encoder_forgets_words_at_its_bound(monkeypatch):
    monkeypatch.setattr(token_files, "CACHE_PARTS", 3)
    enc = token_files.Encoder(BPE)
    for text in ("one two three four five one two " + "x" * 200, "日本 日本 三 四 五 六 one日 " + "日" * 200):
        assert np.frombuffer(enc.encode(text.encode()), enc.dtype).tolist() == tokens(text)
        assert len(enc.young) <= 3 and len(enc.old) <= 3


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aelrstvmdz0 9'!.\t\néßÿ"), max_size=30), max_size=6))
def test_pieces_of_many_texts_are_those_of_the_split(texts):
    pieces, ends = token_files.split_plain([t.encode() for t in texts])
    split = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\sa-z0-9ß-öø-ÿ]+")
    want = [[p.encode() for p in split.findall(t)] for t in texts]
    assert pieces.to_pylist() == sum(want, []) and ends.tolist() == np.cumsum([len(w) for w in want]).tolist()


@pytest.mark.parametrize("chunk", (1, 40, 1 << 23))
def test_texts_encoded_together_are_those_encoded_alone(monkeypatch, chunk):
    monkeypatch.setattr(token_files, "CHUNK", chunk)
    enc = token_files.Encoder(BPE)
    texts = [r[1] for r in odd_rows()] + ["it's", "'S we'll", " \t ", "日本 one", None, "", "ÀÉ' 'ß''s", "a<|endoftext|>b", "x"]
    want = [np.array(tokens(t or ""), enc.dtype).tobytes() for t in texts]
    assert enc.encode_all([None if t is None else t.encode() for t in texts]) == want


def test_each_distinct_piece_is_looked_up_once():
    class Counted(dict):
        asked = 0

        def get(self, *key):
            Counted.asked += 1
            return super().get(*key)

    enc = token_files.Encoder(BPE)
    enc.young = Counted()
    text = "the same few words, again and again. " * 5000
    assert np.frombuffer(enc.encode(text.encode()), enc.dtype).tolist() == tokens(text)
    assert Counted.asked < 100


def test_other_tokenizers_encode_whole_texts():
    enc = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not enc.wordwise
    text = "A text,  with blanks\nand <|endoftext|> "
    assert np.frombuffer(enc.encode(text.encode()), enc.dtype).tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids


@given(st.lists(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 300), st.integers(0, 70_000), st.integers(0, 2**32 - 1)), max_size=9), max_size=9))
def test_codes_round_trip(docs):
    counts = np.array([len(d) for d in docs], np.int64)
    ranks = np.array([r for d in docs for r in d], "<u4")
    control, data = token_files.code_ranks(ranks, counts)
    assert len(control) == int(((counts + 3) // 4).sum())
    assert len(data) == sum(0 if r == 0 else 1 if r < 256 else 2 if r < 65536 else 4 for r in ranks.tolist())
    assert token_files.decode_ranks(control, data, counts).tolist() == ranks.tolist()


def test_token_files_of_query(spark, tok):
    got = registry.op11_token_files(spark, SF001).orderBy("doc_id").collect()
    rows, start = duck().sql("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall(), 0
    assert len(got) == len(rows)
    for (ident, text), g in zip(rows, got):
        ids = tok.encode(text or "", add_special_tokens=False).ids + [2]
        assert tuple(g) == (ident, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_token_files_odd_rows_and_small_shards(spark, tok, tmp_path):
    docs = odd_docs(spark).repartition(5)
    token_files.write(docs, str(tmp_path / "t"), BPE, 2, shard_ids=20)
    got = token_files.read(spark, str(tmp_path / "t")).collect()
    shards = token_files.manifest(spark, str(tmp_path / "t")).collect()
    assert len(shards) > 5 and all(s["documents"] == 1 or s["ids"] <= 20 for s in shards)
    want = sorted((r[0] is not None, r[0] or 0, tuple(tok.encode(r[1] or "", add_special_tokens=False).ids + [2])) for r in odd_rows())
    got = sorted(got, key=lambda r: r["start"])
    back = [(r["id"] is not None, r["id"] or 0, tuple(np.frombuffer(bytes(r["ids"]), "<u4").tolist())) for r in got]
    assert sorted(back) == want and [b[:2] for b in back] == [w[:2] for w in want]  # ids ascending, NULL first
    ends = np.cumsum([r["n_tokens"] for r in got]).tolist()
    assert [r["start"] for r in got] == [0, *ends[:-1]] and ends[-1] == sum(s["ids"] for s in shards)


def test_token_ranks_follow_the_corpus(spark, tmp_path):
    docs = spark.createDataFrame([(i, "cat cat cat dog") for i in range(5)], "doc_id long, text string")
    token_files.write(docs, str(tmp_path / "t"), BPE, 2)
    book = np.fromfile(tmp_path / "t" / "codebook.u32", "<u4")
    cat, dog = tokens("cat")[0], tokens("dog")[0]
    assert book[0] == cat and set(book[1:3].tolist()) == {2, dog} and sorted(book.tolist()) == list(range(49408))


def test_only_committed_shards_count(spark, tmp_path):
    docs = spark.createDataFrame([(1, "one text")], "doc_id long, text string")
    token_files.write(docs, str(tmp_path / "t"), BPE, 2)
    name = token_files.manifest(spark, str(tmp_path / "t")).first()["file"]
    (tmp_path / "t" / ("999999-" + name)).write_bytes((tmp_path / "t" / name).read_bytes())  # of an attempt that was lost
    assert token_files.read(spark, str(tmp_path / "t")).count() == 1
    (tmp_path / "t" / name).write_bytes(b"TOKVB01\n" + bytes(40))
    with pytest.raises(Exception, match="cut or of another codebook"):
        token_files.read(spark, str(tmp_path / "t")).collect()


def test_token_files_of_nothing(spark, tmp_path):
    token_files.write(empty_docs(spark), str(tmp_path / "t"), BPE, 2)
    out = token_files.read(spark, str(tmp_path / "t"))
    assert out.columns == ["id", "start", "n_tokens", "ids"] and out.count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_rank_one_update(seed):
    rng = np.random.default_rng(seed)
    d = int(rng.integers(1, 12))
    lam = np.sort(np.repeat(rng.random(d)[: max(1, d // 2)], 2)[:d] if d > 1 else rng.random(1))  # equal eigenvalues
    lam = np.pad(lam, (d - len(lam), 0))
    q = np.linalg.qr(rng.normal(size=(d, d)))[0]
    v = q[:, 0] if seed == 1 else rng.normal(size=d) * 10.0 ** rng.integers(-9, 9)
    new, vectors = whitening.rank_one(lam, q, 2.5, v)
    whole = q @ np.diag(lam) @ q.T + 2.5 * np.outer(v, v)
    assert np.allclose(vectors @ np.diag(new) @ vectors.T, whole, atol=1e-12 * np.abs(whole).max())
    assert np.allclose(vectors.T @ vectors, np.eye(d), atol=1e-12) and (np.diff(new) >= 0).all()


def test_secular_roots_interlace():
    rng = np.random.default_rng(3)
    poles, z = np.sort(rng.random(40)) * 1e4, rng.normal(size=40) * 10.0 ** rng.integers(-6, 1, 40)
    origin, step = whitening.secular_roots(poles, z, 3.0)
    roots = poles[origin] + step
    assert (roots >= poles).all() and (roots[:-1] <= poles[1:]).all()
    assert np.allclose(roots, np.linalg.eigvalsh(np.diag(poles) + 3 * np.outer(z, z)), rtol=1e-12)


def check_whitening(rows, raw, k):
    x = np.floor(64 * np.array(raw, np.float64)).astype(np.int64) + 1_000_000
    n, S = len(x), x.sum(0)
    c = (x - 1_000_000) - (S - n * 1_000_000) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    want, got = (c @ u / np.sqrt(np.maximum(e, 1e-300)))[:, :k], np.array([r["whitened"] for r in rows])
    sign = np.sign((got * want).sum(0))
    assert np.allclose(got * sign, want, atol=1e-9)
    assert [int(r["deviation"]) for r in rows] == ((n * x - S) ** 2).sum(1).tolist()
    assert np.allclose(rows[0]["explained"], (e / e.sum())[:k], rtol=1e-9) and {r["n"] for r in rows} == {n}
    assert all(r["identity_error"] < 1e-9 for r in rows)


def test_whitening_of_query(spark):
    got = registry.op12_whitening(spark, SF001).orderBy("vec_id", "component").collect()
    raw = duck().sql(f"SELECT vec_id, embedding FROM '{SF001}/embeddings.parquet' ORDER BY 1").fetchall()
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], []).append(r)
    assert list(by) == [r[0] for r in raw] and all([c["component"] for c in v] == list(range(1, 33)) for v in by.values())
    check_whitening([{**v[0].asDict(), "whitened": [c["whitened"] for c in v], "explained": [c["explained"] for c in v]}
                     for v in by.values()], [r[1] for r in raw], 32)


def test_whitening_odd_rows(spark):
    table = spark.createDataFrame(vector_rows(), VECTORS)
    whole = [(r[0], r[1]) for r in vector_rows()
             if r[1] and len(r[1]) == 6 and all(c is not None and math.isfinite(c) for c in r[1])]
    rows = whitening.whiten(table.repartition(9), components=4).collect()
    key = lambda i, w: (i is not None, i or 0, w)
    assert sorted(key(r["vec_id"], 0) for r in rows) == sorted(key(i, 0) for i, _ in whole)
    order = sorted(range(len(rows)), key=lambda k: (key(rows[k]["vec_id"], 0), rows[k]["deviation"]))
    as32 = {k: np.array(v, np.float32).astype(float).tolist() for k, (i, v) in enumerate(whole)}
    x = np.floor(64 * np.array(list(as32.values()))).astype(np.int64)
    dev = ((len(x) * x - x.sum(0)) ** 2).sum(1)
    mine = sorted(range(len(whole)), key=lambda k: (key(whole[k][0], 0), dev[k]))
    check_whitening([rows[k] for k in order], [as32[k] for k in mine], 4)


def test_whitening_many_parts_and_no_spread(spark):
    rng = np.random.default_rng(1)
    raw = rng.normal(size=(400, 5)).tolist()
    table = spark.createDataFrame([(i, v) for i, v in enumerate(raw)], "vec_id long, embedding array<double>")
    check_whitening(whitening.whiten(table.repartition(40), components=5).orderBy("vec_id").collect(), raw, 5)
    flat = spark.createDataFrame([(i, [1.0, 2.0, float(i % 2)]) for i in range(10)], "vec_id long, embedding array<double>")
    r = whitening.whiten(flat).first()
    assert r["whitened"][0] is not None and r["whitened"][1:] == [None, None] and r["identity_error"] < 1e-12
    one = whitening.whiten(flat.limit(1)).collect()
    assert [(r["n"], int(r["deviation"]), r["whitened"], r["explained"]) for r in one] == [(1, 0, [None] * 3, [None] * 3)]
    huge = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0])], "vec_id long, embedding array<double>")
    assert [int(r["deviation"]) for r in whitening.whiten(huge).collect()] == [(2 * (1 << 40)) ** 2 + 64 ** 2] * 2
    assert whitening.whiten(table.limit(0)).count() == 0


def brute_negatives(rows, anchor, moved=lambda i, y: y):
    best = {}
    for i, v, y in rows:
        if i is None or v is None or y is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        x = tuple(math.floor(256 * float(np.float32(c))) for c in v)
        best[i] = min(best.get(i, (moved(i, y), x)), (moved(i, y), x))
    out = []
    for a, (ya, xa) in best.items():
        if not anchor(a):
            continue
        scored = sorted((-sum(p * q for p, q in zip(xa, x)), i, y) for i, (y, x) in best.items() if i != a)
        for ps, p, _ in [s for s in scored if s[2] == ya][:5]:
            near = [(-s, i) for s, i, y in scored if y != ya and 50 * -ps <= 100 * -s <= 95 * -ps][:3]
            out += [(a, p, k + 1, i, -ps, s) for k, (s, i) in enumerate(near)]
    return sorted(out)


def test_hard_negatives_of_query(spark):
    rows = registry.op13_hard_negatives(spark, SF001)
    con = duck()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF001}/embeddings.parquet'")
    raw = con.sql("SELECT vec_id, embedding, label FROM embeddings").fetchall()
    got = sorted(tuple(r) for r in rows.collect())
    assert got == brute_negatives(raw, lambda i: i % 50 == 0, lambda i, y: (y + 1) % 10 if i % 7 == 0 else y)
    rel = con.sql(registry.ORACLE["op13_hard_negatives"])
    assert digest(rel.columns, rel.fetchall())[0] == digest(rows.columns, got)[0]


def test_hard_negatives_odd_rows_in_small_blocks(spark, monkeypatch):
    table = spark.createDataFrame(vector_rows(), VECTORS)
    want = brute_negatives([r[:3] for r in vector_rows()], lambda i: i % 10 == 0)
    for rows, anchors, depth in ((4096, 1024, 16), (7, 3, 1)):
        monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", rows)
        monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", anchors)
        monkeypatch.setattr(hard_negatives, "FIRST_DEPTH", depth)
        assert sorted(tuple(r) for r in hard_negatives.mine(table, F.col("id") % 10 == 0).collect()) == want
    assert hard_negatives.mine(table.limit(0), F.col("id") % 10 == 0).count() == 0
    assert hard_negatives.mine(table, F.lit(False)).count() == 0


def test_threshold_search_reads_part_of_the_lists(monkeypatch):
    """A row far ahead of the others ends the search early, and the result is the full scan's."""
    rng = np.random.default_rng(5)
    x = rng.integers(-20, 20, (2000, 4))
    x[77] = 900
    monkeypatch.setattr(hard_negatives, "FIRST_DEPTH", 2)
    block = hard_negatives.Lists(np.arange(2000), np.zeros(2000), x)
    q = np.array([5, 6, 7, 8])
    full = sorted((-int(s), i) for i, s in enumerate(x @ q))
    read = []
    block.x = type("Rows", (), {"__getitem__": lambda s, at: read.append(len(at)) or x[at].astype(float),
                                "__matmul__": lambda s, v: read.append(len(x)) or x.astype(float) @ v, "astype": lambda s, k: s})()
    assert block.search(q, np.ones(2000, bool), [(None, None)], 1)[0] == [(-full[0][0], full[0][1])]
    assert sum(read) < 200
    w = (100, 300)
    inside = [(-s, i) for s, i in full if w[0] <= -s <= w[1]][:3]
    assert block.search(q, np.ones(2000, bool), [w, (10**9, 10**9), (5, 4)], 3) == [inside, [], []]


def test_components_beyond_the_bound(spark):
    table = spark.createDataFrame([(0, [1e38, 1.0], 1), (1, [1e38, 1.0], 1), (2, [0.7e6, 1.0], 2)],
                                  "vec_id long, embedding array<double>, label int")
    rows = hard_negatives.integer_rows(table, 256).orderBy("id").collect()
    assert [np.frombuffer(bytes(r["x"]), "<i4").tolist() for r in rows] == [[1518500249, 256], [1518500249, 256], [179200000, 256]]
    hard_negatives.mine(table, F.col("id") == 0).collect()
