"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Each passage is encoded by character and
repetition statistics and by the mean of its words' hashed sign vectors. A hidden layer maps the
encoding to h; the passage's weight is the softmax, over the bag, of w . (tanh(V h) * sigmoid(U h));
the document's score is a logistic function of the weighted mean of its h. Only documents have
labels; which passages decide is learned.

The network is fitted on at most about ``train_rows`` labelled documents, taken by a hash of the id
(all where there are fewer), whatever their length. Where these have more than ``train_passages``
passages together, fewer are taken, in the order of the hash, until the next would exceed it; the first
of each label is always taken. Rows to hold out are the caller's filter. Every passage of every document is scored,
in one map over the texts.

Edge cases. NULL or empty text: a bag of one empty passage. Label rows with a NULL label, or with
different labels for one id, are not learned from. No labels, or labels of one kind: every score is
the share of label 1 (0.5 without any). Repeated rows get equal scores. Only the named columns are
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import col, hash_share, within
from .textarrays import (CLOSING, CODE_POINT, DIGIT, IN_WORD, LETTER, LETTER_BYTE, MARK, SYMBOL, UPPER, by_bytes,
                         joined, scramble, words)

PASSAGE = 64
SIGNS = 16
_STATS = 16
WIDTH = _STATS + SIGNS


def encode(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(encodings of all passages, index of each text's first passage and the end)."""
    data, offsets = joined(texts)
    n = len(texts)
    starts, ends, hashes = words(data, IN_WORD[data])
    owner = np.searchsorted(offsets, starts, "right") - 1
    per_text = np.bincount(owner, minlength=n)
    first_word = np.concatenate(([0], np.cumsum(per_text)))
    bags = np.maximum(1, -(-per_text // PASSAGE))
    first = np.concatenate(([0], np.cumsum(bags)))
    passage = first[owner] + (np.arange(len(starts)) - first_word[owner]) // PASSAGE
    m = int(first[-1])
    count = np.bincount(passage, minlength=m).astype(np.float64)

    def total(values: np.ndarray) -> np.ndarray:
        return np.bincount(passage, values, m)

    def in_words(table: np.ndarray) -> np.ndarray:
        upto = np.concatenate(([0], np.cumsum(table[data])))
        return upto[ends] - upto[starts]

    size = in_words(CODE_POINT)
    letters, other = in_words(LETTER), (ends - starts) - in_words(LETTER_BYTE)
    closing = CLOSING[data[ends - 1]] if len(ends) else np.empty(0, bool)
    plain = (other == 0) | ((other == 1) & closing & (ends - starts > 1))

    def back(lag: int) -> np.ndarray:
        same = np.zeros(len(hashes), bool)
        same[lag:] = (hashes[lag:] == hashes[:-lag]) & (passage[lag:] == passage[:-lag])
        return same

    mixed = scramble(hashes ^ scramble(passage.astype(np.uint64)))
    order = np.argsort(mixed, kind="stable")
    lead = np.zeros(len(hashes), bool)
    if len(order):
        lead[order] = np.concatenate(([True], mixed[order][1:] != mixed[order][:-1]))
    gap = np.ones(len(starts), np.int64)
    gap[1:] = starts[1:] - ends[:-1]
    w, chars = np.maximum(count, 1), np.maximum(total(size), 1)
    out = np.empty((m, WIDTH), np.float32)
    for j, x in enumerate([
            np.log1p(count) / np.log1p(PASSAGE), chars / w / 10, total(in_words(SYMBOL)) / w,
            total(in_words(UPPER)) / np.maximum(total(letters), 1), total(in_words(MARK)) / w,
            total(letters == 0) / w, total(in_words(DIGIT)) / chars, total(letters) / chars, total(lead) / w,
            total(back(1)) / w, total(back(2) | back(3)) / w, total(plain) / w, total(closing) / w,
            (total(ends - starts) - total(size)) / chars, total(gap > 1) / w, (count == 0).astype(float)]):
        out[:, j] = x
    for b in range(SIGNS):
        out[:, _STATS + b] = total(((hashes >> np.uint64(b)) & np.uint64(1)).astype(np.float64)) / w * 2 - 1
    return out, first


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Gated attention over the passages of a bag, by numpy, with a hand-written gradient."""

    def __init__(self, hidden: int = 24, gate: int = 12, seed: int = 4):
        rng = np.random.default_rng(seed)
        self.mean, self.std, self.constant = np.zeros(WIDTH), np.ones(WIDTH), None
        self.p = {"W": rng.normal(0, WIDTH ** -0.5, (WIDTH, hidden)), "a": np.zeros(hidden),
                  "V": rng.normal(0, hidden ** -0.5, (hidden, gate)), "U": rng.normal(0, hidden ** -0.5, (hidden, gate)),
                  "w": rng.normal(0, gate ** -0.5, gate), "c": rng.normal(0, hidden ** -0.5, hidden), "b": np.zeros(1)}

    def _forward(self, x: np.ndarray, first: np.ndarray) -> dict:
        p, bag = self.p, np.repeat(np.arange(len(first) - 1), np.diff(first))
        h = np.tanh(x @ p["W"] + p["a"])
        t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * s) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, first[:-1])[bag])
        a = e / np.add.reduceat(e, first[:-1])[bag]
        z = np.add.reduceat(a[:, None] * h, first[:-1], axis=0)
        return {"bag": bag, "h": h, "t": t, "s": s, "a": a, "z": z, "y": _sigmoid(z @ p["c"] + p["b"][0])}

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(first) - 1, self.constant)
        return self._forward((x - self.mean) / self.std, first)["y"]

    def attention(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Weight of each passage in its document."""
        return self._forward((x - self.mean) / self.std, first)["a"]

    def _gradient(self, x: np.ndarray, first: np.ndarray, labels: np.ndarray) -> dict:
        p, f = self.p, self._forward(x, first)
        dy = (f["y"] - labels) / len(labels)
        dz = dy[:, None] * p["c"]
        dzk = dz[f["bag"]]
        da = (dzk * f["h"]).sum(1)
        de = f["a"] * (da - np.add.reduceat(f["a"] * da, first[:-1])[f["bag"]])
        dt, ds = de[:, None] * p["w"] * f["s"], de[:, None] * p["w"] * f["t"]
        dt, ds = dt * (1 - f["t"] ** 2), ds * f["s"] * (1 - f["s"])
        dh = (f["a"][:, None] * dzk + dt @ p["V"].T + ds @ p["U"].T) * (1 - f["h"] ** 2)
        return {"W": x.T @ dh, "a": dh.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ ds,
                "w": (f["t"] * f["s"]).T @ de, "c": f["z"].T @ dy, "b": np.array([dy.sum()])}

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, epochs: int = 40, batch: int = 128, rate: float = 5e-3,
            decay: float = 1e-4, seed: int = 4) -> "Network":
        """Adam on the log loss of the document labels, 0 and 1."""
        if not len(labels) or labels.min() == labels.max():
            self.constant = float(labels.mean()) if len(labels) else 0.5
            return self
        every = np.concatenate(bags)
        self.mean, self.std = every.mean(0), np.maximum(every.std(0), 1e-3)
        bags = [(b - self.mean) / self.std for b in bags]
        rng, step = np.random.default_rng(seed), 0
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        for epoch in range(epochs):
            order = rng.permutation(len(bags))
            for i in range(0, len(order), batch):
                part = order[i:i + batch]
                x = np.concatenate([bags[j] for j in part])
                first = np.concatenate(([0], np.cumsum([len(bags[j]) for j in part])))
                step += 1
                pace = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
                for k, g in self._gradient(x, first, labels[part]).items():
                    g = g + decay * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] = self.p[k] - pace * m[k] / (np.sqrt(v[k]) + 1e-8)
        return self


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, id, bytes of the passage encodings) of the labelled texts."""
    for batch in batches:
        texts = batch.column(2).to_pylist()
        for a, b in by_bytes(texts):
            x, first = encode(texts[a:b])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                 pa.array([x[first[i]:first[i + 1]].tobytes() for i in range(b - a)], pa.binary())], names=["y", "id", "x"])


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, passages) of the labelled texts."""
    for batch in batches:
        texts = batch.column(2).to_pylist()
        for a, b in by_bytes(texts):
            data, offsets = joined(texts[a:b])
            starts = np.flatnonzero(np.diff(np.concatenate(([0], IN_WORD[data].view(np.int8)))) == 1)
            n = np.diff(np.searchsorted(starts, offsets))
            yield pa.RecordBatch.from_arrays([batch.column(1).slice(a, b - a), pa.array(np.maximum(1, -(-n // PASSAGE)))],
                                             names=["id", "n"])


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality", train_rows: int = 4000, seed: int = 4,
        train_passages: int = 400_000) -> Network:
    """A network fitted to labelled documents for which ``train`` (a condition on the id column of
    ``labels``) holds: about ``train_rows`` of them, and ``train_passages`` passages in all. They are
    taken in the order of a hash; one that no longer fits is passed over and the next ones still are tried."""
    chosen = labels if train is None else labels.where(train)
    one = (chosen.select(col(id_col).cast("long").alias("id"), col(label_col).cast("int").alias("y"))
           .where("id IS NOT NULL AND y IS NOT NULL").groupBy("id")
           .agg(F.min("y").alias("y"), F.max("y").alias("top")).where("y = top").select("id", "y"))
    total = one.count()
    sample = one.where(hash_share(F.col("id"), train_rows, total, seed))
    # About train_rows rows: small enough to send to every task.
    texts = docs.select(col(id_col).cast("long").alias("id"), col(text_col).alias("text"))

    def of(ids: DataFrame) -> DataFrame:
        return texts.join(F.broadcast(ids), "id").select("y", "id", "text")

    sizes = (of(sample).mapInArrow(_sizes, "id long, n long").groupBy("id").agg(F.max("n").alias("n"))
             .join(F.broadcast(sample), "id").select("id", "y", "n", F.xxhash64(F.lit(seed), "id").alias("at")).collect())
    sizes = sorted(((r["id"], r["y"], r["n"], r["at"]) for r in sizes), key=lambda r: (r[3] % (1 << 32), r[0]))
    if sum(r[2] for r in sizes) > train_passages:
        sample = sample.where(F.col("id").isin(within([r[:3] for r in sizes], train_passages)))
    rows = (of(sample).mapInArrow(_bags, "y int, id long, x binary")
            .groupBy("id").agg(F.min("y").alias("y"), F.min("x").alias("x")).collect())  # a bag per id, however often it comes
    rows = sorted(rows, key=lambda r: r["id"])
    bags = [np.frombuffer(r["x"], np.float32).reshape(-1, WIDTH).astype(np.float64) for r in rows]
    return Network().fit(bags, np.array([r["y"] for r in rows], float))


def score(text: Column, network: Network) -> Column:
    def batch(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            texts = s.tolist()
            out = [network.score(*encode(texts[a:b])) for a, b in by_bytes(texts)]
            yield pd.Series(np.concatenate(out) if out else np.empty(0))
    batch.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(batch, "double").asNondeterministic()(text)
