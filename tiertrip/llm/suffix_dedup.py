"""Removal of repeated passages: each byte that a ``LENGTH``-byte string covers which also starts in a
document with a smaller id goes.

Sampled suffixes. Of the ``K``-byte strings in any ``LENGTH`` bytes, the one with the least hash is an
anchor; the choice depends on nothing but those bytes, so equal strings have equal anchors in them.
Comparing at anchors is therefore exact, and only one position in sixteen is looked at:

1. Anchors are counted (partial counts first). Only those in two documents or more matter; a Bloom
   filter of them, of at most ``FILTER_BITS`` bits, goes to all tasks. It only saves work: a false hit is
   dropped later, and a full filter would let everything through.
2. An anchor's context is the anchor with up to ``REACH`` bytes on either side: every string of LENGTH
   bytes around the anchor lies in it. It is known by 64 bits of the anchor and 64 bits of the whole
   context, the anchor's bytes included; strings of different contexts are compared byte by byte,
   across the anchor too. Distinct contexts (with the least and largest id that have
   them, merged in each task before the shuffle) are brought together by anchor, and suffix-sorted
   by what follows the anchor and by what precedes it, backwards. The sort is deep-shallow:
   multikey quicksort on eight-byte characters to depth ``SHALLOW``, then a blind trie for each group
   of strings that agree so far. The orders' common prefix lengths say which contexts share a string
   at each offset, and so how far a context's own first document is covered by smaller ones.
   An anchor in more than ``group_limit`` rows never meets in one task: its contexts are dealt out
   by their own hash, and their strings grouped by hash with partial minima instead.
3. Occurrences of the contexts kept are joined with them (AQE splits a hot context) and give covered
   intervals, which are united per document and cut out of its bytes.

Edge cases. NULL text is empty; a text under LENGTH bytes loses nothing. Equal ids are not smaller than
each other, so repeated rows keep what they share only with themselves. A NULL id counts as larger
than all others. Ids are compared as bigint. Bytes cut from inside a character are cut all the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import col, stash
from .textarrays import by_bytes, joined, scramble

LENGTH, K = 50, 20
REACH = LENGTH - K
SHALLOW = 16
GROUP_LIMIT = 100_000
FILTER_BITS = 30  # power of two: 128 MB at most
_PIECE = 1 << 17
_ID_BITS = 64
#: Anchors whose contexts are dealt out from the start; should there be more, the others are dealt out once
#: a task has met ``group_limit`` of their contexts.
HOT_ANCHORS = 1 << 20
_TABLE = scramble(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_P = 0xD1342543DE82EF95
_POW = {n: np.uint64(pow(_P, n, 1 << 64)) for n in (1, 2, 4, 8, 16)}
_WIDTH = 2 * REACH + K + 2  # bytes before the anchor (backwards), from the anchor on, and the two lengths
_SPOT = scramble(np.arange(1000, 1000 + _WIDTH, dtype=np.uint64)) | np.uint64(1)
_LAST = (1 << 63) - 1


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the anchors of texts that lie in ``data`` with one byte after each."""
    found, hashes = [], []
    low = np.uint64((1 << 24) - 1)
    for s in range(0, max(0, len(data) - LENGTH + 1), _PIECE):
        piece = _TABLE[data[s:s + _PIECE + LENGTH - 1]]
        runs = {1: piece}
        for n in (1, 2, 4, 8):
            runs[2 * n] = runs[n][:-n] * _POW[n] + runs[n][n:]
        g = scramble(runs[16][:-4] * _POW[4] + runs[4][16:])  # K = 16 + 4
        key = (g & ~low) | np.arange(len(g), dtype=np.uint64)  # ties go to the left
        least = key
        for n in (1, 2, 4, 8):
            least = np.minimum(least[:-n], least[n:])
        least = np.minimum(least[:-15], least[15:])  # of 31 strings: LENGTH - K + 1
        at = s + np.arange(len(least))
        text = np.searchsorted(offsets, at, "right") - 1
        inside = at + LENGTH < offsets[text + 1]
        pos = (least[inside] & low).astype(np.int64)
        pos = pos[np.concatenate(([True], pos[1:] != pos[:-1]))] if len(pos) else pos
        found.append(pos + s)
        hashes.append(g[pos])
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    pos, h = np.concatenate(found), np.concatenate(hashes)
    new = np.concatenate(([True], pos[1:] != pos[:-1])) if len(pos) else np.empty(0, bool)
    return pos[new], h[new]


def _slots(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << bits) - 1)
    return (h & mask).astype(np.int64), ((h >> np.uint64(_ID_BITS - bits)) & mask).astype(np.int64)


class Filter:
    """A Bloom filter with two bits for each anchor."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    def __call__(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for slot in _slots(h, self.bits):
            out &= (self.words[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1
        return out


def _emit_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct anchors of each text."""
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for a, b in by_bytes(texts):
            data, offsets = joined(texts[a:b])
            pos, h = anchors(data, offsets)
            owner = np.searchsorted(offsets, pos, "right").astype(np.uint64)
            _, one = np.unique(scramble(h ^ scramble(owner)), return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(h[one].view(np.int64))], names=["h"])


def _filter(base: DataFrame, group_limit: int) -> tuple[Filter, np.ndarray] | None:
    """The filter of anchors that are in two rows or more, and those in more than ``group_limit`` (sorted, at
    most ``HOT_ANCHORS``, the most frequent); None if there are none."""
    often = stash(base.select("text").mapInArrow(_emit_anchors, "h bigint").groupBy("h").count()
                  .where("count > 1"), "anchors")
    hot = often.where(F.col("count") > group_limit).orderBy(F.col("count").desc(), "h").limit(HOT_ANCHORS).select("h")
    hot = np.sort(hot.toArrow().column("h").to_numpy().view(np.uint64))
    total = often.count()
    if not total:
        return None
    bits = min(FILTER_BITS, max(16, (16 * total - 1).bit_length()))
    mask = F.lit((1 << bits) - 1)
    slot = F.explode(F.array(F.col("h").bitwiseAND(mask), F.shiftright("h", _ID_BITS - bits).bitwiseAND(mask)))
    words = (often.select(slot.alias("s")).groupBy(F.shiftright("s", 6).alias("w"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("s").bitwiseAND(F.lit(63))
                                           .cast("int"))).alias("v"))).toArrow()
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[words.column("w").to_numpy()] = words.column("v").to_numpy().view(np.uint64)
    return Filter(table, bits), hot


def _contexts(data: np.ndarray, offsets: np.ndarray, keep: Filter):
    """(owner, position in its text, anchor, context hash, context bytes) of the anchors that pass."""
    pos, h = anchors(data, offsets)
    ok = keep(h)
    pos, h = pos[ok], h[ok]
    owner = np.searchsorted(offsets, pos, "right") - 1
    begin, end = offsets[owner], offsets[owner + 1] - 1
    left, right = np.minimum(REACH, pos - begin), np.minimum(REACH, end - pos - K)
    padded = np.concatenate((np.zeros(REACH, np.uint8), data, np.zeros(REACH, np.uint8)))
    step = np.arange(REACH)
    out = np.zeros((len(pos), _WIDTH), np.uint8)
    ahead = np.arange(K + REACH)
    for a in range(0, len(pos), 1 << 15):  # the bytes before, backwards, then the anchor and those after
        s = slice(a, a + (1 << 15))
        out[s, :REACH] = padded[pos[s, None] + REACH - 1 - step] * (step < left[s, None])
        out[s, REACH:-2] = padded[pos[s, None] + REACH + ahead] * (ahead < K + right[s, None])
    out[:, -2], out[:, -1] = left, right
    c = np.zeros(len(pos), np.uint64)
    for j in range(out.shape[1]):
        c += _TABLE[out[:, j]] * _SPOT[j]
    return owner, pos - begin, h, scramble(c), out


def _binary(rows: np.ndarray) -> pa.Array:
    n, width = rows.shape
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(0, (n + 1) * width, width, dtype=np.int32)),
                                                  pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def _matrix(column: pa.Array) -> np.ndarray:
    width = _WIDTH
    if not len(column):
        return np.empty((0, width), np.uint8)
    buf = np.frombuffer(column.buffers()[2], np.uint8)
    at = column.offset
    first = int(np.frombuffer(column.buffers()[1], np.int32)[at])
    return buf[first:first + len(column) * width].reshape(-1, width)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys."""
    if not len(keys[0]):
        return np.empty(0, np.int64)
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _merged(h, c, low, high, rows):
    """One entry of each (anchor, context), with the least and largest id."""
    order = np.lexsort((c, h))
    h, c, low, high, rows = h[order], c[order], low[order], high[order], rows[order]
    s = _runs(h, c)
    if not len(s):
        return h, c, low, high, rows
    return h[s], c[s], np.minimum.reduceat(low, s), np.maximum.reduceat(high, s), rows[s]


_CONTEXT = ["h", "c", "low", "high", "bytes", "hot"]


def _context_batch(hot, h, c, low, high, rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), pa.array(low),
                                       pa.array(high), _binary(rows), pa.array(np.isin(h, hot))], names=_CONTEXT)


def _emit_contexts(keep, hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            for a, b in by_bytes(texts, 1 << 20):
                data, offsets = joined(texts[a:b])
                owner, _, h, c, rows = _contexts(data, offsets, keep.value)
                doc = ids[a:b][owner]
                held.append(_merged(h, c, doc, doc, rows))
                size += len(h)
                if size > 300_000:
                    yield _context_batch(hot.value, *_merged(*map(np.concatenate, zip(*held))))
                    held, size = [], 0
        if held:
            yield _context_batch(hot.value, *_merged(*map(np.concatenate, zip(*held))))
    return run


def blind_trie_order(strings: list[bytes]) -> list[int]:
    """Order of distinct equally long strings by a blind trie: a node keeps only the position where its
    strings part and the byte of each branch, so an insertion reads single bytes on the way down, is
    compared with one leaf, and is hung in where that comparison says."""
    # A node is [position, {byte: child}]; a leaf is the number of its string.
    root: list | int = 0
    for i in range(1, len(strings)):
        s = strings[i]
        node = root
        while not isinstance(node, int):
            node = node[1].get(s[node[0]]) if s[node[0]] in node[1] else next(iter(node[1].values()))
        other = strings[node]
        at = next(p for p in range(len(s)) if s[p] != other[p])
        parent, byte, node = None, -1, root
        while not isinstance(node, int) and node[0] < at:
            parent, byte, node = node, s[node[0]], node[1][s[node[0]]]
        if not isinstance(node, int) and node[0] == at:
            node[1][s[at]] = i
            continue
        new = [at, {other[at]: node, s[at]: i}]
        if parent is None:
            root = new
        else:
            parent[1][byte] = new
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, int):
            out.append(node)
        else:
            stack.extend(node[1][b] for b in sorted(node[1], reverse=True))
    return out


def shallow_order(group: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """Order by ascending ``group`` and then by the columns of ``chars``: multikey quicksort. Every part is split in
    three by its middle element's character, smaller, equal and larger; equal ones go on with the next
    character. The parts of one round are split together."""
    n, depth = chars.shape
    order = np.arange(n)
    start = _runs(group)
    end, at = np.append(start[1:], n), np.zeros(len(start), np.int64)
    while True:
        more = (end - start > 1) & (at < depth)
        start, end, at = start[more], end[more], at[more]
        if not len(start):
            return order
        size = end - start
        first = np.cumsum(size) - size
        part = np.repeat(np.arange(len(start)), size)
        rows = order[np.arange(len(part)) + np.repeat(start - first, size)]
        char, pivot = chars[rows, at[part]], chars[order[(start + end) // 2], at][part]
        less, same = char < pivot, char == pivot
        place = np.empty(len(part), np.int64)
        base = start.copy()
        bounds = [start]
        for kind in (less, same, ~(less | same)):
            run = np.cumsum(kind)
            before = run[first] - kind[first]
            place[kind] = (base[part] + run - 1 - before[part])[kind]
            base = base + np.add.reduceat(kind.astype(np.int64), first)
            bounds.append(base)
        order[place] = rows
        start, end = np.concatenate(bounds[:3]), np.concatenate(bounds[1:])
        at = np.concatenate([at, at + 1, at])


def deep_shallow(group: np.ndarray, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the strings within ascending ``group`` numbers, length each shares with the one before
    it in that order, -1 at the start of a group). Strings are rows of a byte matrix."""
    n, width = strings.shape
    pad = np.zeros((n, -(-width // 8) * 8), np.uint8)
    pad[:, :width] = strings
    chars = pad.view(">u8").astype(np.uint64)  # eight bytes as one character
    depth = SHALLOW // 8
    order = shallow_order(group, chars[:, :depth])
    starts = _runs(group[order], *[chars[order, j] for j in range(depth)])
    ends = np.append(starts[1:], n)
    for s, e in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
        part = order[s:e]
        if (chars[part[1:], depth:] == chars[part[0], depth:]).all():
            continue
        tails = [strings[i, SHALLOW:].tobytes() for i in part]
        first: dict[bytes, list[int]] = {}
        for i, t in zip(part.tolist(), tails):
            first.setdefault(t, []).append(i)
        distinct = list(first)
        order[s:e] = [i for j in blind_trie_order(distinct) for i in first[distinct[j]]]
    shared = np.full(n, -1, np.int64)
    if n > 1:
        a, b = strings[order[1:]], strings[order[:-1]]
        differs = a != b
        common = np.where(differs.any(1), differs.argmax(1), width)
        shared[1:] = np.where(group[order[1:]] == group[order[:-1]], common, -1)
    return order, shared


def _covered(h: np.ndarray, low: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each context (sorted by anchor): how many bytes before and after the anchor its least id's
    document shares, in strings of LENGTH bytes, with contexts of smaller ids; -1 where there are none."""
    n = len(h)
    group = np.zeros(n, np.int64)
    group[_runs(h)[1:]] = 1
    group = np.cumsum(group)
    left, right = rows[:, -2].astype(np.int64), rows[:, -1].astype(np.int64)
    back_order, back_shared = deep_shallow(group, rows[:, :REACH])
    ahead_order, ahead_shared = deep_shallow(group, rows[:, REACH:-2])
    most, least = np.full(n, -1), np.full(n, REACH + 1)
    for j in range(REACH + 1):  # strings that start j bytes before the anchor
        a, b = np.empty(n, np.int64), np.empty(n, np.int64)
        a[back_order] = np.cumsum(back_shared < j)
        b[ahead_order] = np.cumsum(ahead_shared < K + REACH - j)
        real = np.flatnonzero((left >= j) & (right >= REACH - j))
        key = a[real] * (n + 1) + b[real]
        order = np.argsort(key, kind="stable")
        s = _runs(key[order])
        if not len(s):
            continue
        first = np.empty(len(real), np.int64)
        first[order] = np.repeat(np.minimum.reduceat(low[real][order], s), np.diff(np.append(s, len(real))))
        hit = real[first < low[real]]
        most[hit] = j
        least[hit] = np.minimum(least[hit], j)
    return most, np.where(most >= 0, REACH - least, -1)


_RESULT = "h bigint, c bigint, low bigint, before int, after int, bytes binary"


def _resolve(limit: int):
    """Contexts sorted by anchor -> those that cover something: (before, after) for the least id, and all
    of the context for larger ids. Contexts of a hot anchor (which come last), and of one with more than
    ``limit`` here, come out with bytes."""
    def result(h, c, low, before, after, rows) -> pa.RecordBatch:
        n = len(h)
        return pa.RecordBatch.from_arrays(
            [pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), pa.array(low),
             pa.array(np.broadcast_to(before, n).astype(np.int32)), pa.array(np.broadcast_to(after, n).astype(np.int32)),
             pa.nulls(n, pa.binary()) if rows is None else _binary(rows)],
            names=["h", "c", "low", "before", "after", "bytes"])

    def settle(h, c, low, high, rows) -> pa.RecordBatch:
        s = _runs(h, c)
        h, c, rows = h[s], c[s], rows[s]
        low, high = np.minimum.reduceat(low, s), np.maximum.reduceat(high, s)
        g = _runs(h)
        several = np.repeat(np.diff(np.append(g, len(h))) > 1, np.diff(np.append(g, len(h))))
        before, after = np.full(len(h), -1), np.full(len(h), -1)
        if several.any():
            before[several], after[several] = _covered(h[several], low[several], rows[several])
        useful = (high > low) | (before >= 0)
        return result(h[useful], c[useful], low[useful], before[useful], after[useful], None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, large = 0, None  # large: the anchor whose contexts are passed on unsettled
        for batch in batches:
            h, c = (batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (0, 1))
            low, high = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            rows = _matrix(batch.column(4))
            cold = int((~batch.column(5).to_numpy(zero_copy_only=False)).sum())
            if cold < len(h):
                yield result(h[cold:], c[cold:], low[cold:], -1, -1, rows[cold:])
                h, c, low, high, rows = h[:cold], c[:cold], low[:cold], high[:cold], rows[:cold]
            if large is not None and len(h):
                n = int(np.searchsorted(h.view(np.int64), np.uint64(large).view(np.int64), "right"))
                if n:
                    yield result(h[:n], c[:n], low[:n], -1, -1, rows[:n])
                h, c, low, high, rows = h[n:], c[n:], low[n:], high[n:], rows[n:]
                large = None if len(h) else large
            if not len(h):
                continue
            held.append((h, c, low, high, rows))
            size += len(h)
            if size < limit:
                continue
            part = tuple(np.concatenate(x) for x in zip(*held))
            last = int(_runs(part[0])[-1])  # the last anchor may go on
            if last:
                yield settle(*(x[:last] for x in part))
            part = tuple(x[last:].copy() for x in part)
            size = len(part[0])
            held = [part]
            if size >= limit:
                large = part[0][0]
                yield result(part[0], part[1], part[2], -1, -1, part[4])
                held, size = [], 0
        if held:
            yield settle(*(np.concatenate(x) for x in zip(*held)))
    return run


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each string of LENGTH bytes of large anchors' contexts, by a hash of its bytes and place; with the anchor's
    that makes 128 bits."""
    for batch in batches:
        h, c = (batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (0, 1))
        low, rows = batch.column(2).to_numpy(zero_copy_only=False), _matrix(batch.column(3))
        left, right = rows[:, -2], rows[:, -1]
        parts = _TABLE[rows[:, :-2]] * _SPOT[None, :-2]
        back = np.concatenate((np.zeros((len(h), 1), np.uint64), np.cumsum(parts[:, :REACH], 1, dtype=np.uint64)), 1)
        ahead = np.concatenate((np.zeros((len(h), 1), np.uint64), np.cumsum(parts[:, REACH:], 1, dtype=np.uint64)), 1)
        for j in range(REACH + 1):
            ok = (left >= j) & (right >= REACH - j)
            key = scramble(scramble(back[ok, j] + ahead[ok, K + REACH - j]) + np.uint64(j))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(h[ok].view(np.int64)), pa.array(c[ok].view(np.int64)),
                 pa.array(low[ok]), pa.array(np.full(int(ok.sum()), j, np.int32))], names=["key", "h", "c", "low", "j"])


def _large(rest: DataFrame) -> DataFrame:
    """The same answer for contexts of large anchors, by grouping strings with partial minima."""
    whole = rest.groupBy("h", "c").agg(F.min("low").alias("low"), F.max("bytes").alias("bytes"))
    strings = stash(whole.select("h", "c", "low", "bytes").mapInArrow(
        _strings, "key bigint, h bigint, c bigint, low bigint, j int"), "strings")
    first = stash(strings.groupBy("h", "key").agg(F.min("low").alias("first")), "least")
    near = (strings.join(first, ["h", "key"]).where("first < low").groupBy("h", "c")
            .agg(F.max("j").alias("before"), (F.lit(REACH) - F.min("j")).alias("after")))
    out = whole.select("h", "c", "low").join(near, ["h", "c"], "left")
    return out.select("h", "c", "low", F.coalesce("before", F.lit(-1)).alias("before"),
                      F.coalesce("after", F.lit(-1)).alias("after"))


def _emit_places(keep):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            texts, mark = batch.column(1).to_pylist(), batch.column(2).to_numpy(zero_copy_only=False)
            for a, b in by_bytes(texts, 1 << 20):
                data, offsets = joined(texts[a:b])
                owner, pos, h, c, rows = _contexts(data, offsets, keep.value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), pa.array(ids[a:b][owner]),
                     pa.array(mark[a:b][owner]), pa.array(pos.astype(np.int32)), pa.array(rows[:, -2].astype(np.int32)),
                     pa.array(rows[:, -1].astype(np.int32))], names=["h", "c", "id", "mark", "pos", "l", "r"])
    return run


def cut(text: str | None, starts: list[int], ends: list[int]) -> tuple[int, int, int, str]:
    """(bytes, removed bytes, maximal removed runs, SHA-256 of the rest) of a text without the intervals."""
    data = text.encode("utf-8") if text else b""
    kept, removed, spans, upto = hashlib.sha256(), 0, 0, 0
    reach = -1
    for s, e in sorted(zip(starts, ends)):
        if s > reach:
            kept.update(data[upto:s])
            spans += 1
            reach = s
        removed += max(0, e - reach)
        reach = max(reach, e)
        upto = reach
    kept.update(data[upto:])
    return len(data), removed, spans, kept.hexdigest()


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [cut(t.as_py(), s or [], e or []) for t, s, e in
                 zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        cols = list(zip(*found)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(x, pa.int64()) for x in cols[:3]], pa.array(cols[3], pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def covered_intervals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      group_limit: int = GROUP_LIMIT) -> DataFrame | None:
    """``id, mark, start, end`` of covered pieces (they overlap); a row is known by its id, NULL as the
    largest bigint, and ``mark``, a hash of its text. None where nothing repeats."""
    base = docs.select(F.coalesce(col(id_col).cast("bigint"), F.lit(_LAST)).alias("id"), col(text_col).alias("text"),
                       F.xxhash64(col(text_col)).alias("mark")).where(F.octet_length("text") >= LENGTH)
    found = _filter(base, group_limit)
    if found is None:
        return None
    keep = base.sparkSession.sparkContext.broadcast(found[0])
    hot = base.sparkSession.sparkContext.broadcast(found[1])
    # a hot anchor's contexts are dealt out by their own hash; all others by their anchor
    contexts = (base.select("id", "text")
                .mapInArrow(_emit_contexts(keep, hot), "h bigint, c bigint, low bigint, high bigint, bytes binary, hot boolean")
                .repartition("h", F.when(F.col("hot"), F.col("c")))
                .sortWithinPartitions("hot", "h", "c").mapInArrow(_resolve(group_limit), _RESULT))
    settled = stash(contexts, "contexts")
    small = settled.where("bytes IS NULL").drop("bytes")
    rest = settled.where("bytes IS NOT NULL").select("h", "c", "low", "bytes")
    if rest.limit(1).count():
        small = small.unionByName(_large(rest))
    places = base.mapInArrow(_emit_places(keep), "h bigint, c bigint, id bigint, mark bigint, pos int, l int, r int")
    hit = places.join(small, ["h", "c"])
    larger = F.col("id") > F.col("low")
    return (hit.where((larger & (F.col("l") + F.col("r") >= REACH)) | (~larger & (F.col("before") >= 0)))
            .select("id", "mark", (F.col("pos") - F.when(larger, F.col("l")).otherwise(F.col("before"))).alias("start"),
                    (F.col("pos") + K + F.when(larger, F.col("r")).otherwise(F.col("after"))).alias("end")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   group_limit: int = GROUP_LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, one row per row of ``docs``."""
    kind = docs.schema[id_col].dataType
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    found = covered_intervals(docs, id_col, text_col, group_limit)
    schema = f"doc_id {kind.simpleString()}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    none = F.lit(None).cast("array<int>")
    if found is None:
        return rows.select("doc_id", "text", none.alias("starts"), none.alias("ends")).mapInArrow(_finish, schema)
    spans = (found.groupBy("id", "mark").agg(F.collect_set(F.struct("start", "end")).alias("at"))
             .select("id", "mark", F.col("at.start").alias("starts"), F.col("at.end").alias("ends")))
    keyed = rows.withColumn("id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST))).withColumn(
        "mark", F.xxhash64("text"))
    return (keyed.join(spans, ["id", "mark"], "left").select("doc_id", "text", "starts", "ends")
            .mapInArrow(_finish, schema))


def oracle(n: int = LENGTH) -> str:
    """Every string of every document, looked at one by one; for tables whose ids are not NULL."""
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS h FROM documents),
w AS (SELECT r, doc_id, p, h[p + 1 : p + {n}] AS s
      FROM (SELECT *, unnest(range(0, octet_length(h) - {n - 1})) AS p FROM d)),
m AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s),
i AS (SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS before FROM w JOIN m USING (s) WHERE least < doc_id),
g AS (SELECT r, p, sum(CASE WHEN p <= before + {n} THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY p) AS k FROM i),
c AS (SELECT r, min(p) AS a, max(p) + {n} AS b FROM g GROUP BY r, k),
e AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS upto FROM c),
k AS (SELECT r, sum(b - a) AS gone, count(*) AS spans, max(b) AS last,
        string_agg(hex(h[upto + 1 : a]), '' ORDER BY a) AS kept
      FROM e JOIN d USING (r) GROUP BY r)
SELECT doc_id, octet_length(h)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed,
  coalesce(spans, 0)::BIGINT AS n_spans,
  sha256(CASE WHEN spans IS NULL THEN h ELSE unhex(kept || hex(h[last + 1 : octet_length(h)])) END) AS kept_sha256
FROM d LEFT JOIN k USING (r)"""
