import hashlib
import random

import numpy as np
import pytest

from scripts.oracle_check import digest
from tests.llm.helpers import SF001, duck, empty_docs, odd_docs, odd_rows, prose, table
from tiertrip.llm import decontaminate, registry, suffix_dedup


def brute(rows, n=50):
    """Expected result of each row, by looking at every string."""
    last = (1 << 63) - 1
    first, out = {}, []
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - n + 1):
            k = b[p:p + n]
            first[k] = min(first.get(k, last), last if i is None else i)
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - n + 1):
            if first[b[p:p + n]] < (last if i is None else i):
                gone[p:p + n] = b"\1" * n
        spans = sum(1 for p in range(len(b)) if gone[p] and not (p and gone[p - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def planted(seed=1):
    """Passages of 45 to 70 bytes at edges and in the middle, chains of overlaps, near copies, one very common line."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcde ") for _ in range(rng.randint(3, 30)))
    pool = ["".join(rng.choice("abcdefgh \n") for _ in range(rng.randint(45, 70))) for _ in range(12)]
    line = "a very common line that stands in a great many documents of all kinds."
    rows = []
    for i in range(90):
        parts = [rng.choice(pool) if rng.random() < 0.4 else word() for _ in range(rng.randint(0, 6))]
        if i % 2:
            parts.insert(rng.randint(0, len(parts)), line)
        rows.append((i, "".join(parts)))
    long = "".join(rng.choice("abcdefghij ") for _ in range(400))
    for i in range(90, 110):
        p = rng.randint(0, 399)
        rows.append((i, long[:p] + "Z" + long[p + 1:]))
    rows += [(120, "x" * 300), (121, "x" * 49), (122, "x" * 50), (123, "xy" * 100 + "x" * 60), (123, "x" * 120), (None, "x" * 80)]
    rows += [(130, "\x00" * 70), (131, "q" * 25 + "\x00" * 55), (132, "é" * 60), (133, "é" * 40 + "e")]
    return rows


@pytest.mark.parametrize("limit", [suffix_dedup.GROUP_LIMIT, 3])
def test_removal_equals_brute_force(spark, limit):
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = suffix_dedup.remove_repeats(docs, group_limit=limit).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_texts_that_share_their_surroundings_only(spark):
    """Two anchors whose hashes agree in 48 bits, between equal surroundings: nothing is repeated."""
    rows = [(1, "24eowrxyxc8u6jnqujnm0756pjbtal7i9mg5gcnye5mit655la"), (2, "24eowrxyxc8u6jn1ixsi1lgf90k955cjzks5gcnye5mit655la")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r["n_removed"] for r in suffix_dedup.remove_repeats(docs).collect()] == [0, 0]


def test_equal_hashes_of_different_anchors(spark, monkeypatch):
    """Anchors that share all bits of their hash are still told apart by their bytes."""
    real = suffix_dedup.anchors
    monkeypatch.setattr(suffix_dedup, "anchors", lambda d, o: (lambda p, h: (p, h & np.uint64(1)))(*real(d, o)))
    rows = planted()
    docs = [(d, t) for d, t in rows]
    emitted = []
    for limit in (10 ** 6, 50):
        h, c, low, bytes_ = [], [], [], []
        for ident, text in docs:
            raw = (text or "").encode()
            if len(raw) >= suffix_dedup.LENGTH:
                data, offsets = suffix_dedup.joined([text])
                _, _, hh, cc, out = suffix_dedup._contexts(data, offsets, lambda x: np.ones(len(x), bool))
                h.append(hh), c.append(cc), bytes_.append(out), low.append(np.full(len(hh), (1 << 63) - 1 if ident is None else ident))
        parts = suffix_dedup._merged(*map(np.concatenate, (h, c, low, low, bytes_)))
        emitted.append(suffix_dedup._covered(parts[0], parts[2], parts[4]))
        whole = [bytes(r[:suffix_dedup.REACH][::-1]) + bytes(r[suffix_dedup.REACH:-2]) for r in parts[4]]
        for k in range(0, len(whole), 7):  # the claimed bytes do lie, around the same offset, in a smaller document
            before, after = emitted[-1][0][k], emitted[-1][1][k]
            if before >= 0:
                mine = whole[k][suffix_dedup.REACH - before:suffix_dedup.REACH + suffix_dedup.K + suffix_dedup.REACH - before]
                assert any(parts[2][i] < parts[2][k] and mine in whole[i] for i in range(len(whole)))


def test_hot_anchors_are_dealt_out(spark):
    line = "a line of some length that very many documents have in common, word by word"
    rows = [(i, f"{i:05d} {i * 7919 % 10007:05d} begins " + line + f" and ends with {i * 104729 % 99991:05d} or so") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    base = docs.select("text")
    hot = suffix_dedup._filter(base, 50)[1]
    assert 1 <= len(hot) <= 12 and suffix_dedup._filter(base, 500)[1].size == 0
    got = suffix_dedup.remove_repeats(docs, group_limit=50).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_shallow_order_is_a_sort():
    rng = np.random.default_rng(7)
    for n, top in ((1, 2), (500, 3), (3000, 5), (2000, 2 ** 40)):
        group = np.sort(rng.integers(0, 1 + n // 9, n))
        chars = rng.integers(0, top, (n, 2)).astype(np.uint64)
        order = suffix_dedup.shallow_order(group, chars)
        keys = [(int(group[i]), *map(int, chars[i])) for i in order]
        assert keys == sorted(keys) and sorted(order.tolist()) == list(range(n))
    assert len(suffix_dedup.shallow_order(np.empty(0, np.int64), np.empty((0, 2), np.uint64))) == 0


def test_query_equals_brute_force(spark):
    got = registry.op7_deep_shallow_dedup(spark, SF001)
    want = brute(table(SF001, "SELECT doc_id, text FROM documents"))
    assert sorted(map(tuple, got.collect()), key=str) == want
    rel = duck().sql(registry.ORACLE["op7_deep_shallow_dedup"])
    assert rel.columns == got.columns and sorted(rel.fetchall(), key=str) == want


def test_removal_odd_rows(spark):
    got = suffix_dedup.remove_repeats(odd_docs(spark)).collect()
    assert sorted(map(tuple, got), key=str) == brute([(r[0], r[1]) for r in odd_rows()])
    assert suffix_dedup.remove_repeats(empty_docs(spark)).count() == 0


def test_blind_trie_and_deep_shallow_sort():
    rng = random.Random(2)
    strings = list({bytes(rng.choice(b"ab\x00") for _ in range(14)) for _ in range(600)})
    rng.shuffle(strings)
    assert [strings[i] for i in suffix_dedup.blind_trie_order(strings)] == sorted(strings)
    rows = np.array([list(b"0123456789abcdef" + s) for s in strings * 2], np.uint8)
    group = np.sort(np.array([rng.randrange(5) for _ in rows]))
    order, shared = suffix_dedup.deep_shallow(group, rows)
    keys = [(group[i], rows[i].tobytes()) for i in order]
    assert keys == sorted(keys)
    for (g, a), (h, b), n in zip(keys, keys[1:], shared[1:]):
        same = next((p for p in range(len(a)) if a[p] != b[p]), len(a))
        assert n == (same if g == h else -1)


def test_containment_equals_oracle(spark):
    df = registry.op8_minhash_containment(spark, SF001)
    rel = duck().sql(registry.ORACLE["op8_minhash_containment"])
    got = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(rel.columns) and got
    assert digest(df.columns, got)[1] == digest(rel.columns, rel.fetchall())[1]


def test_containment_of_changed_and_short_items(spark):
    rng = random.Random(7)
    items = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(n)))
             for i, n in enumerate([3, 4, 5, 6, 9, 12, 17, 21, 30, 40, 60, 90, 130, 200, 300, 700] * 3)]
    items += [(900, ""), (901, None), (None, items[8][1]), (902, "the")]
    docs = []
    for i, (_, text) in enumerate(items[:48]):
        w = text.split()
        for changes in (0, 1, 2):
            v = list(w)
            for _ in range(changes * len(w) // 60 if changes < 2 else 0):
                v[rng.randrange(len(v))] = "CHANGED"
            if changes == 2:
                v = v[:int(len(v) * 0.9)]
            body = [f"v{rng.randrange(9000)}" for _ in range(rng.randrange(1500))]
            at = rng.randrange(len(body) + 1)
            docs.append((1000 + 3 * i + changes, " ".join(body[:at] + [x.upper() + "," for x in v] + body[at:])))
    got = {(r["doc_id"], r["item_id"], r["n_shingles"], r["n_found"]) for r in decontaminate.contained_items(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"),
        block_bytes=4000).collect()}
    want = set()
    for i, text in items:
        width = min(5, len((text or "").split()))
        own = decontaminate.shingles(text, width) if width else set()
        for d, body in docs:
            found = len(own & decontaminate.shingles(body, width)) if own else 0
            if own and found >= 0.8 * len(own):
                want.add((d, i, len(own), found))
    assert got == want and len(want) > 100


def test_containment_odd_rows(spark):
    docs, items = odd_docs(spark), spark.createDataFrame([(1, prose(1)), (2, "hello"), (3, None)], "item_id long, text string")
    found = sorted((r["doc_id"], r["item_id"]) for r in decontaminate.contained_items(docs, items).collect())
    assert found == [(4, 2), (4, 2), (5, 1), (6, 1), (6, 1)]
    kept = decontaminate.keep_clean(docs, items)
    assert kept.columns == docs.columns and kept.count() == len(odd_rows()) - 5
    assert decontaminate.contained_items(docs, items.where("item_id > 9")).count() == 0
    assert decontaminate.keep_clean(empty_docs(spark), items).count() == 0


def test_index_is_small_beside_its_items():
    import pickle
    items = [(i, prose(i, 150)) for i in range(1500)]
    index = decontaminate.Index(items)
    raw = sum(len(t) for _, t in items)
    assert len(pickle.dumps(index)) < 3 * raw + decontaminate.SEEDS * (1 << 20)
    hit = index.search([prose(7, 150) + " and more", "nothing here"], 0.8)
    assert [(i, index.items[at][0]) for i, at, _ in hit] == [(0, 7)] and hit[0][2] == index.size[hit[0][1]]
    assert len(pickle.dumps(index)) < 3 * raw + decontaminate.SEEDS * (1 << 20)  # remembered sets do not travel
