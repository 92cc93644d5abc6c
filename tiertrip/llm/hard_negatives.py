"""Hard negatives of anchors by Fagin's threshold algorithm over integer vectors.

Every vector component becomes ``floor(scale * x)``; a row's score is its integer inner product with the
anchor, higher first, ties by smaller id. An anchor's positives are its first other rows of its label;
each positive's window holds the rows of other labels whose score lies between two shares of the positive's.

Anchors are a stated set of rows, and rows are dealt to blocks by a hash of their id, anchors likewise: one
group is one block of anchors against one block of rows, both of bounded size whatever the labels. Within a
group each dimension has a list of the rows sorted by its component. For an anchor the lists are read from
the large end where its component is positive and from the small end where it is negative; a row met for the
first time is scored in full (random access), and the anchor's components times the last values read add up
to the threshold, which no row still unseen can exceed. Reading stops once the threshold falls strictly
below the k-th score of every window (below the window itself where it holds fewer rows). What a group
returns is k rows a window; Spark merges the groups.

Rows: those with a NULL id, label or vector, or a NULL or non-finite component, take no part. Of several
rows with one id the one with the smallest label, then vector bytes, takes part. Vectors shorter than the longest are
filled with zeros. Components beyond the bound that keeps every score a long (2^28 after scaling at 64
dimensions) count as that bound. Extra columns are not read. A table without a whole vector gives no row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import col, stash

#: Rows and anchors in a group.
BLOCK_ROWS, BLOCK_ANCHORS = 4096, 1024
#: Rows read from each list before the first test of the threshold, and the growth from test to test.
FIRST_DEPTH, GROWTH = 16, 4

_ROW = "id long, label long, x binary"


def integer_rows(table: DataFrame, scale: int, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``id, label, x``: one row an id, ``x`` the integer components as little-endian 32-bit numbers."""
    picked = table.select(col(vec_id).cast("long").alias("id"), col(label).cast("long").alias("label"),
                          col(vector).cast("array<double>").alias("v"))
    whole = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf)))
    picked = picked.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).where(whole)
    dims = max(1, picked.agg(F.max(F.size("v"))).first()[0] or 0)
    bound = float(min((1 << 31) - 1, math.isqrt((1 << 62) // dims)))

    def run(batches):
        for b in batches:
            v = b.column(2)
            size = np.diff(v.offsets.to_numpy())
            x = np.zeros((len(v), dims))
            x[np.arange(dims) < size[:, None]] = v.flatten().to_numpy(zero_copy_only=False)
            with np.errstate(over="ignore"):  # an overflow is beyond the bound too
                x = np.clip(np.floor(scale * x), -bound, bound).astype("<i4")
            yield pa.record_batch([b.column(0), b.column(1), pa.array([r.tobytes() for r in x], pa.binary())],
                                  names=["id", "label", "x"])

    rows = picked.mapInArrow(run, _ROW)
    return rows.groupBy("id").agg(F.min(F.struct("label", "x")).alias("r")).select("id", "r.label", "r.x")


class Lists:
    """The sorted lists of a block of rows."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels = ids, labels
        # Sums of products below 2^53 are exact in doubles, whose products are fast.
        small = len(x) and float(np.abs(x).max()) ** 2 * x.shape[1] < 2.0 ** 52
        self.x = x.astype(np.float64 if small else np.int64)
        self.small, self.most = small, float(np.abs(x).max(initial=0))
        self.order = np.argsort(x, axis=0, kind="stable")
        self.values = np.take_along_axis(x, self.order, 0).astype(np.int64)

    def search(self, anchor: np.ndarray, allowed: np.ndarray, windows: list[tuple[int | None, int | None]],
               k: int) -> list[list[tuple[int, int]]]:
        """For each window (least and greatest score, None for none) the first ``k`` allowed rows in it, as
        (score, id). Windows that no score can lie in are left empty."""
        m = len(self.ids)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        open_ = [w for w in windows if w[0] is None or w[1] is None or w[0] <= w[1]]
        exact = self.small and float(np.abs(anchor).max(initial=0)) * self.most * len(anchor) < 2.0 ** 52
        x, q = (self.x, anchor.astype(np.float64)) if exact else (self.x.astype(np.int64), anchor.astype(np.int64))
        seen, scores = np.zeros(m, bool), np.zeros(m, np.int64)
        done, depth = 0, min(m, FIRST_DEPTH)
        while open_ and m:
            met = np.zeros(m, bool)
            met[self.order[m - depth:m - done, up]] = True
            met[self.order[done:depth, down]] = True
            if not len(up) and not len(down):  # a zero anchor: every score is 0
                met[:] = True
            new = np.flatnonzero(met & ~seen)
            if 8 * len(new) < m:
                scores[new] = (x[new] @ q).astype(np.int64)
            else:  # many rows of the block: reading it in order is cheaper than gathering them
                scores[new] = (x @ q).astype(np.int64)[new]
            seen[new] = True
            done = depth
            if seen.all() or done == m:
                break
            threshold = int((self.values[m - done, up] * anchor[up]).sum() + (self.values[done - 1, down] * anchor[down]).sum())
            ranked = np.sort(scores[seen & allowed])
            if all(self._closed(ranked, w, k, threshold) for w in open_):
                break
            depth = min(m, depth * GROWTH)
        inside = seen & allowed
        if open_ and all(lo is not None for lo, _ in open_):
            inside &= scores >= min(lo for lo, _ in open_)
        if open_ and all(hi is not None for _, hi in open_):
            inside &= scores <= max(hi for _, hi in open_)
        at = np.flatnonzero(inside)
        at = at[np.lexsort((self.ids[at], -scores[at]))]
        found = -scores[at]  # ascending
        out = []
        for lo, hi in windows:
            begin = 0 if hi is None else int(np.searchsorted(found, -hi, "left"))
            end = len(found) if lo is None else int(np.searchsorted(found, -lo, "right"))
            out.append([(int(scores[i]), int(self.ids[i])) for i in at[begin:max(begin, min(end, begin + k))]])
        return out

    @staticmethod
    def _closed(ranked: np.ndarray, window: tuple[int | None, int | None], k: int, threshold: int) -> bool:
        lo, hi = window
        if lo is not None and threshold < lo:
            return True
        end = len(ranked) if hi is None else int(np.searchsorted(ranked, hi, "right"))
        return end >= k and threshold < ranked[end - k] and (lo is None or ranked[end - k] >= lo)


def _rows(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = np.frombuffer(b"".join(t.column("x").to_pylist()), "<i4")
    return t.column("id").to_numpy(), t.column("label").to_numpy(), x.reshape(t.num_rows, -1).astype(np.int64)


def _groups(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int):
    """Both sides dealt to groups of one anchor block and one row block: every anchor meets every row once."""
    na, nb = -(-n_anchors // BLOCK_ANCHORS), -(-n_rows // BLOCK_ROWS)
    deal = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))
    parts = min(na * nb, 20_000)  # a fixed number: the work lies in the groups, not in their bytes
    anchors = anchors.toDF(*anchors.columns)  # columns of its own: it is cut from ``rows``
    left = anchors.withColumn("a", deal(na, 1)).withColumn("b", every(nb)).repartition(parts, "a", "b")
    right = rows.withColumn("b", deal(nb, 2)).withColumn("a", every(na)).select("a", "b", *rows.columns).repartition(parts, "a", "b")
    return left.groupBy("a", "b").cogroup(right.groupBy("a", "b"))


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first ``k`` of each key by falling score, then id; Spark cuts each task's rows before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def positives(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, k: int) -> DataFrame:
    """``id, other, score, rank``: the first ``k`` other rows of each anchor's label."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            ids, labels, x = _rows(right)
            lists: dict[int, Lists] = {}
            for ident, label, q in zip(*_rows(left)):
                if label not in lists:
                    own = labels == label
                    lists[label] = Lists(ids[own], labels[own], x[own])
                block = lists[label]
                for score, other in block.search(q, block.ids != ident, [(None, None)], k)[0]:
                    out.append((int(ident), other, score))
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("id", "other", "score"), zip(*out) if out else ((), (), ()))})

    found = _groups(anchors, rows, n_anchors, n_rows).applyInArrow(run, "id long, other long, score long")
    return _first(found, ["id"], k)


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """The integer scores s with low * score <= 100 * s <= high * score."""
    return -(-low * score // 100), high * score // 100


def negatives(asked: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, low: int, high: int, k: int) -> DataFrame:
    """``id, positive_id, positive_score, other, score, rank`` for anchors with an array ``positives`` of (other, score)."""
    names = ("id", "positive_id", "positive_score", "other", "score")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            block = Lists(*_rows(right))
            for ident, label, q, pos in zip(*_rows(left), left.column("positives").to_pylist()):
                found = block.search(q, block.labels != label, [window(p["score"], low, high) for p in pos], k)
                out += [(int(ident), p["other"], p["score"], other, score) for p, f in zip(pos, found) for score, other in f]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, zip(*out) if out else ((),) * 5)})

    found = _groups(asked, rows, n_anchors, n_rows).applyInArrow(run, ", ".join(f"{n} long" for n in names))
    return _first(found, ["id", "positive_id"], k)


def mine(table: DataFrame, is_anchor: Column, scale: int = 256, n_positives: int = 5, n_negatives: int = 3, low: int = 50,
         high: int = 95, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``. ``is_anchor`` is a condition
    on column ``id``; ``low`` and ``high`` are percentages of the positive's score."""
    rows = stash(integer_rows(table, scale, vec_id, vector, label), "negatives-rows")
    anchors = rows.where(is_anchor)
    n_rows, n_anchors = rows.count(), anchors.count()
    if not n_anchors:
        n_rows = n_anchors = 1  # no group has two sides then
    pos = stash(positives(anchors, rows, n_anchors, n_rows, n_positives), "negatives-positives")
    by_anchor = pos.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("rank", "other", "score"))).alias("p"))
    asked = anchors.join(by_anchor, "id").withColumn(
        "positives", F.transform("p", lambda r: F.struct(r["other"].alias("other"), r["score"].alias("score")))).drop("p")
    found = negatives(asked, rows, n_anchors, n_rows, low, high, n_negatives)
    return found.select(F.col("id").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"),
                        F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def oracle() -> str:
    """DuckDB text of the query ``op13_hard_negatives``."""
    return """
WITH clean AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id AS other,
         CAST(list_dot_product(a.x, r.x) AS BIGINT) AS score
  FROM clean a JOIN clean r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id),
pos AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
neg AS (
  SELECT p.anchor_id, p.positive_id,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other) AS INTEGER) AS "rank",
         s.other AS negative_id, p.positive_score, s.score AS negative_score
  FROM pos p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT * FROM neg WHERE "rank" <= 3"""
