"""SimHash near-duplicates, with candidates found by pigeonring chains.

Fingerprint: ASCII letters are lower-cased, words are runs of non-white-space, and each run of
``shingle`` words (repeats count) is hashed with 64-bit xxHash, seed 42. A bit is set when more
than half of the hashes set it.

Links: the 64 bits are cut into a ring of ``m = tau + 1`` segments. If two fingerprints differ in at
most ``tau`` bits, then the pigeonring principle gives a segment from which every chain of
``l`` consecutive segments differs in at most ``floor(l * tau / m)`` bits. So the first segment of
such a chain is equal and the second differs in one bit at most: these two are the join key (one
side is probed with each single-bit change of the second segment). The budgets of the longer
chains are tested in the join condition, the last of them being the full Hamming check.

Only distinct fingerprints are joined, so a group of copies counts once; the join condition holds
all checks, so candidates that fail are never emitted.

Edge cases. NULL or empty text, and text of white space only: fingerprint 0, linked like any
other. Fewer words than ``shingle``: one shingle of all words. Repeated rows are one node. A NULL
id joins its fingerprint's component but is never its name (``component_id`` is NULL only when
all ids of a component are). Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import col, fresh, stash
from .components import components

_LANES = np.uint64(0x0101010101010101)


def simhash(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    words = text.encode("utf-8").lower().split() if text else []
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        grams = [line[a:b] for a, b in zip(starts[:len(words) - shingle + 1].tolist(),
                                           ends[shingle - 1:].tolist())]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(g, seed) for g in grams], np.uint64)
    votes = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 255):  # a byte lane counts to 255
        block = hashes[a:a + 255]
        for b in range(8):
            lanes = ((block >> np.uint64(b)) & _LANES).sum(dtype=np.uint64)
            votes[b::8] += np.frombuffer(np.uint64(lanes).tobytes(), np.uint8)
    bits = (2 * votes > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprint(text: Column, shingle: int = 4, seed: int = 42) -> Column:
    """Fingerprint as a signed bigint (the same 64 bits)."""
    def batch(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            out = np.fromiter((simhash(t, shingle, seed) for t in s), np.uint64, len(s))
            yield pd.Series(out.view(np.int64))
    batch.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(batch, "long")(text)


def ring(tau: int) -> list[tuple[int, int]]:
    """(offset, width) of the ``tau + 1`` segments (3 at least), widest first."""
    m = max(tau + 1, 3)
    widths = [64 // m + (i < 64 % m) for i in range(m)]
    return [(sum(widths[:i]), w) for i, w in enumerate(widths)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def links(nodes: DataFrame, tau: int = 4) -> DataFrame:
    """Pairs ``(u, v)``, u < v, of the distinct values of ``nodes.fp`` that differ in at most
    ``tau`` bits, for ``tau`` from 1 to 20 (beyond it a segment has too few bits to select)."""
    if not 1 <= tau <= 20:
        raise ValueError("tau must be from 1 to 20")
    segs = ring(tau)
    m = len(segs)
    part = [F.shiftrightunsigned("fp", off).bitwiseAND(F.lit((1 << w) - 1)) for off, w in segs]

    def key(i: int, second: Column) -> Column:
        return F.lit(i << 58) + F.shiftleft(part[i], segs[(i + 1) % m][1]) + second

    exact, probes = [], []
    for i in range(m):
        second = part[(i + 1) % m]
        exact.append(key(i, second))
        probes.append(key(i, second))
        for b in range(segs[(i + 1) % m][1] if 2 * tau >= m else 0):
            bit = F.lit(1 << b)  # only a clear bit is changed: the other fingerprint has it set
            probes.append(F.when(second.bitwiseAND(bit) == 0, key(i, second.bitwiseOR(bit))))
    index = nodes.select(F.col("fp").alias("b"), F.explode(F.array(*exact)).alias("key"))
    probe = nodes.select(F.col("fp").alias("a"), F.explode(F.array_compact(F.array(*probes))).alias("key"))

    diff = F.col("a").bitwiseXOR(F.col("b"))

    def differs(first: int, length: int) -> Column:
        """Bits that differ in ``length`` segments from ``first`` segments after the chain's start."""
        masks = [_signed(sum(((1 << w) - 1) << off for off, w in (segs * 3)[i + first:i + first + length]))
                 for i in range(m)]
        at = (F.shiftright("key", 58) + 1).cast("int")
        return F.bit_count(diff.bitwiseAND(F.element_at(F.array(*map(F.lit, masks)), at)))

    ok = F.bit_count(diff) <= tau
    for length in range(2, m):
        ok = ok & (differs(0, length) <= length * tau // m)
    # Pairs with equal keys meet in both orders and one is enough; with a changed bit they meet once.
    ok = ok & ((F.col("a") < F.col("b")) | (differs(1, 1) > 0))
    pairs = probe.join(index.withColumnRenamed("key", "ikey"), (F.col("key") == F.col("ikey")) & ok)
    return pairs.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 4, tau: int = 4, id_col: str = "doc_id",
                    text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``doc_id, fp, component_id`` (smallest id reachable over links), ``root``
    (the component's smallest fingerprint, as a signed bigint) and the columns of ``keep``."""
    base = stash(docs.select(col(id_col).alias("doc_id"), *[col(c) for c in keep],
                             fingerprint(col(text_col), shingle).alias("fp")), "fingerprints")
    nodes = base.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    roots = components(links(nodes.select("fp"), tau)).select(F.col("node").alias("fp"), "root")
    named = stash(nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "named")
    # written, so that the join below splits the partition of a root with very many fingerprints
    names = stash(named.groupBy("root").agg(F.min("least_id").alias("component_id")), "names")
    member = named.select("fp", "root").join(names, "root")
    return base.join(member, "fp")


def keep_one(docs: DataFrame, shingle: int = 4, tau: int = 4, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate component: the one with the smallest id (NULL
    ids last), of rows with one id the one with the smallest row hash, of equal rows any one."""
    mark = fresh(docs, "row")
    rows = docs.withColumn(mark, F.xxhash64(*[col(c) for c in docs.columns]))
    found = near_duplicates(rows, shingle, tau, id_col, text_col, keep=(mark,)).withColumnRenamed(mark, "row")
    found = found.select("root", "doc_id", "row")
    first = found.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("w"))
    first = first.select(F.col("w.doc_id").alias("wid"), F.col("w.row").alias("wrow"))
    times = found.groupBy(F.col("doc_id").alias("tid"), F.col("row").alias("trow")).agg(F.count("*").alias("times"))
    win = stash(first.join(times, F.col("wid").eqNullSafe(F.col("tid")) & (F.col("wrow") == F.col("trow")))
                .select("wid", "wrow", "times"), "winners")
    hit = rows.join(win, col(id_col).eqNullSafe(F.col("wid")) & (col(mark) == F.col("wrow")))
    same = [col(c) for c in docs.columns]
    several = hit.where("times > 1").dropDuplicates(["wid", "wrow"])
    return hit.where("times = 1").select(*same).unionByName(several.select(*same))
