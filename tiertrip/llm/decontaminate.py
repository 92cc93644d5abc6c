"""Benchmark decontamination: size-partitioned MinHash containment search, then an exact check.

Words are runs of letters, digits and non-ASCII characters of the lower-cased text. An item's
shingles are its runs of ``shingle`` words (a shorter item is one shingle of all its words). Items
are partitioned by their number of shingles, up to 4, 8, 16, and so on. For a partition with bound
``u`` each document is seen as windows of ``2u`` shingles that overlap by half, so that any passage
of ``u`` shingles lies in one window whose size is near the item's: that is what makes a MinHash of
a short item comparable with a long document. A window has ``SEEDS`` one-permutation MinHash
signatures of ``BINS`` bins; with one agreeing bin the document is a candidate for the item. A
candidate is kept if the share of the item's distinct shingles (as strings) that the whole
document contains is at least ``threshold``.

A window that holds an item's passage misses it only if no bin of any seed agrees. With 96 bins in
all the chance is about 1e-6 at the threshold, and less for whole passages (tests compare with the
exact search). Items of up to 16 shingles use every shingle as a signature value (a sketch no
smaller than the set is the set), so none of those is missed.

The items are the stated query set: they are read in blocks of at most ``block_bytes`` of text, and
each block is held in every task. Documents are only mapped over, never shuffled, so a hot source
or a group of copies does not matter.

Edge cases. NULL or text without a word: contains nothing, and as an item is contained in nothing.
Equal items with different ids all match. Repeated documents give equal rows each. Only the named
columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import col
from .textarrays import by_bytes, joined, scramble, words

SEEDS, BINS = 6, 16
#: Sets of shingle strings remembered by a task.
SETS_KEPT = 2000
_SMALL = 16
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_IS_WORD = np.array([not (b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F) for b in range(256)])
_SEED = [np.uint64(0x5851F42D4C957F2D * (2 * i + 1) % (1 << 64)) for i in range(SEEDS)]
_STEP = np.uint64(0xD1342543DE82EF95)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_BIN = np.uint64((1 << 64) // BINS)


def shingles(text: str | None, width: int) -> set[tuple[str, ...]]:
    """Distinct runs of ``width`` words."""
    w = _WORD.findall(text.lower()) if text else []
    return set(zip(*[w[i:] for i in range(width)]))


def _runs(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive words."""
    n = len(hashes) - width + 1
    out = hashes[:n].copy()
    for j in range(1, width):
        out = out * _STEP + hashes[j:j + n]
    return scramble(out)


class Index:
    """Items by (shingle width, size bound): for each seed, the sorted signature values and their items.

    Of an item's shingles only their number is kept; the strings are made again from its text for an item that
    turns up as a candidate, and the last few thousand of those sets are remembered in each task."""

    def __init__(self, items: list[tuple], shingle: int = 5):
        self.items, self.width, self.size, grouped = items, [], [], {}
        self._sets: dict[int, set[str]] = {}
        for at, (_, text) in enumerate(items):
            w = len(_WORD.findall(text.lower())) if text else 0
            width = min(shingle, w)
            n = len(shingles(text, width)) if width else 0
            self.width.append(width)
            self.size.append(n)
            if n:
                bound = max(4, 1 << (n - 1).bit_length())
                grouped.setdefault((width, bound), []).append(at)
        self.parts = {}
        for (width, bound), members in grouped.items():
            per_seed = [([], []) for _ in range(SEEDS)]
            for at in members:
                data, _ = joined([items[at][1].lower()])
                _, _, h = words(data, _IS_WORD[data])
                runs = np.unique(_runs(h, width))
                for s in range(1 if bound <= _SMALL else SEEDS):
                    v = scramble(runs ^ _SEED[s])
                    if bound > _SMALL:
                        v = np.sort(v)  # the least of each bin
                        v = v[np.concatenate(([True], np.diff(v // _BIN) > 0))]
                    per_seed[s][0].append(v)
                    per_seed[s][1].append(np.full(len(v), at))
            tables = []
            for values, owners in per_seed:
                if not values:
                    continue
                v, o = np.concatenate(values), np.concatenate(owners)
                order = np.argsort(v, kind="stable")
                seen = np.zeros(1 << max(10, min(20, (16 * len(v) - 1).bit_length())), bool)
                seen[(v & np.uint64(len(seen) - 1)).astype(np.int64)] = True
                tables.append((v[order], o[order].astype(np.int32), seen))
            self.parts[width, bound] = tables

    def __getstate__(self):
        return self.__dict__ | {"_sets": {}}

    def shingles_of(self, at: int) -> set[str]:
        found = self._sets.get(at)
        if found is None:
            if len(self._sets) >= SETS_KEPT:
                self._sets.clear()
            found = self._sets[at] = shingles(self.items[at][1], self.width[at])
        return found

    def _candidates(self, texts: list[str]) -> set[tuple[int, int]]:
        """(text, item) pairs of which one signature value agrees."""
        data, offsets = joined(texts)
        starts, _, hashes = words(data, _IS_WORD[data])
        first = np.searchsorted(starts, offsets)  # of each text's words
        out: set[tuple[int, int]] = set()
        for width in {w for w, _ in self.parts}:
            if len(hashes) < width:
                continue
            runs = _runs(hashes, width)
            text_of = np.repeat(np.arange(len(texts)), np.diff(first))
            whole = text_of[:len(runs)] == text_of[width - 1:]
            runs, owner = runs[whole], text_of[:len(runs)][whole]
            if not len(runs):
                continue
            begin = np.searchsorted(owner, np.arange(len(texts)))
            nth = np.arange(len(runs)) - begin[owner]
            per_text = np.bincount(owner, minlength=len(texts))
            for (w, bound), tables in self.parts.items():
                if w != width:
                    continue
                blocks = -(-per_text // bound)
                block0 = np.concatenate(([0], np.cumsum(blocks)))
                block = block0[owner] + nth // bound
                block_text = np.repeat(np.arange(len(texts)), blocks)
                for s, (values, owners, seen) in enumerate(tables):
                    v = scramble(runs ^ _SEED[s])
                    if bound <= _SMALL:
                        hit, at = v, owner
                    else:
                        low = np.full((len(block_text), BINS), _NONE)
                        np.minimum.at(low.reshape(-1), block * BINS + (v // _BIN).astype(np.int64), v)
                        pair = low.copy()  # a window is a block and the next one of the same text
                        same = block_text[1:] == block_text[:-1]
                        pair[:-1][same] = np.minimum(low[:-1][same], low[1:][same])
                        hit, at = pair.reshape(-1), np.repeat(block_text, BINS)
                    maybe = seen[(hit & np.uint64(len(seen) - 1)).astype(np.int64)]
                    hit, at = hit[maybe], at[maybe]
                    lo, hi = np.searchsorted(values, hit), np.searchsorted(values, hit, "right")
                    for i in np.flatnonzero(hi > lo):
                        out.update((int(at[i]), int(o)) for o in owners[lo[i]:hi[i]])
        return out

    def search(self, texts: list[str | None], threshold: float) -> list[tuple[int, int, int]]:
        """(text, item, found shingles) of every item that a text contains."""
        out = []
        for a, b in by_bytes(texts):
            low = [(t or "").lower() for t in texts[a:b]]
            known: tuple = (None, None)
            for i, at in sorted(self._candidates(low), key=lambda p: (p[0], self.width[p[1]], p[1])):
                own, width = self.shingles_of(at), self.width[at]
                if known[0] != (i, width):
                    known = ((i, width), shingles(low[i], width))
                found = len(own & known[1])
                if found >= threshold * len(own):
                    out.append((a + i, at, found))
        return out


def _blocks(items: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple]]:
    rows = items.select(col(item_col).alias("item"), col(text_col).alias("text")).where("text IS NOT NULL").distinct()
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = -(-size // block_bytes) or 1
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield [tuple(r) for r in part.collect()]


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = 0.8, shingle: int = 5,
                    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                    item_text_col: str = "text", block_bytes: int = 16 << 20) -> DataFrame:
    """``doc_id, item_id, n_shingles, n_found, containment`` for every item a document contains."""
    kind = docs.schema[id_col].dataType.simpleString()
    item_kind = items.schema[item_col].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_kind}, n_shingles bigint, n_found bigint, containment double"
    base = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    out = None
    for block in _blocks(items, item_col, item_text_col, block_bytes):
        index = Index(block, shingle)
        part = base.mapInArrow(_searcher(index, threshold, to_arrow_type(items.schema[item_col].dataType)), schema)
        out = part if out is None else out.unionByName(part)
    return out


def _searcher(index: Index, threshold: float, item_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = index.search(batch.column(1).to_pylist(), threshold)
            sizes = [index.size[at] for _, at, _ in found]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array([i for i, _, _ in found], pa.int64())),
                pa.array([index.items[at][0] for _, at, _ in found], item_type),
                pa.array(sizes, pa.int64()), pa.array([f for _, _, f in found], pa.int64()),
                pa.array([f / n for (_, _, f), n in zip(found, sizes)], pa.float64())],
                names=["doc_id", "item_id", "n_shingles", "n_found", "containment"])
    return run


def contains_any(text: Column, index: Index, threshold: float) -> Column:
    """True where a text contains an item of the index."""
    def batch(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            leak = np.zeros(len(s), bool)
            leak[[i for i, _, _ in index.search(s.tolist(), threshold)]] = True
            yield pd.Series(leak)
    batch.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(batch, "boolean").asNondeterministic()(text)


def keep_clean(docs: DataFrame, items: DataFrame, threshold: float = 0.8, shingle: int = 5, text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = 16 << 20) -> DataFrame:
    """``docs`` without the rows that contain an item."""
    out = docs
    for block in _blocks(items, item_col, item_text_col, block_bytes):
        out = out.where(~contains_any(col(text_col), Index(block, shingle), threshold))
    return out


def oracle(threshold: float = 0.8) -> str:
    """Exact containment of five-word shingles, for items of five words or more and of fewer."""
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    return rf"""
WITH iw AS (
  SELECT DISTINCT item_id, text, regexp_extract_all(lower(text), {word}) AS w FROM benchmark WHERE text IS NOT NULL),
i AS (
  SELECT item_id, text, least(5, len(w)) AS k,
    unnest(list_distinct([array_to_string(w[p:p + least(5, len(w)) - 1], ' ')
      for p in range(1, len(w) - least(5, len(w)) + 2)])) AS g
  FROM iw WHERE len(w) > 0),
n AS (SELECT item_id, text, count(*) AS n_shingles FROM i GROUP BY ALL),
ks AS (SELECT DISTINCT k FROM i),
d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(text), {word}) AS w FROM documents),
ds AS (
  SELECT r, doc_id, k, unnest(list_distinct([array_to_string(w[p:p + k - 1], ' ')
    for p in range(1, len(w) - k + 2)])) AS g
  FROM d, ks WHERE len(w) >= k)
SELECT doc_id, item_id, n_shingles, n_found, n_found::DOUBLE / n_shingles AS containment
FROM (SELECT ds.r, ds.doc_id, i.item_id, i.text, count(*) AS n_found FROM ds JOIN i ON ds.g = i.g AND ds.k = i.k
      GROUP BY ALL) JOIN n USING (item_id, text)
WHERE n_found >= {threshold} * n_shingles"""
