"""Language identification by rank-order n-gram profiles.

A profile is the list of a language's most frequent letter n-grams, by rank. A text gets the same
list of its own, and the language with the least out-of-place distance: the sum over the text's
n-grams of how far the rank is from the profile's rank, or the profile's length where the profile
lacks the n-gram. N-grams of equal count in a text share their mean rank.

Letters are lower-cased, everything else is a word break (shown as a blank around each word), and
n-grams stay inside a word with its blanks. An n-gram is a 64-bit hash of its code points.

Profiles are fitted on at most about ``rows_per_lang`` labelled rows of each language, taken by a
hash of the id (all rows where there are fewer); rows to hold out are the caller's filter. Counts are
merged per task before the shuffle, and only the top of each language reaches the driver: ``top``
rows for each of the ``MAX_LANGS`` languages with the most rows (a dirty column has more). Scoring sees whole texts of all rows.

Edge cases. NULL text, empty text, no letter: ``und``, score 0. Equal distances: the language that
sorts first (score 0 where no n-gram is in any profile; ``keep_identified`` drops such rows). NULL language: not learned from. No labelled row at all: ``und`` for every text.
Repeated rows get equal results. Only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import col

MAX_LANGS = 2000
_MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(1)
def _letters() -> np.ndarray:
    """Lower-case code point of each letter or mark, 0 for everything else."""
    out = np.zeros(0x110000, np.uint32)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha() or unicodedata.category(c) in ("Mn", "Mc"):
            low = c.lower()
            out[cp] = ord(low) if len(low) == 1 else cp
    return out


def ngrams(text: str, sizes: tuple[int, ...] = (1, 2, 3)) -> np.ndarray:
    """Hashes of all letter n-grams of a text, repeats included."""
    a = _letters()[np.frombuffer(text.encode("utf-32-le"), np.uint32)].astype(np.uint64)
    a = np.concatenate(([0], a, [0])).astype(np.uint64)
    a = a[np.concatenate(([True], (a[1:] != 0) | (a[:-1] != 0)))]  # one blank between words
    out = []
    for n in sizes:
        m = len(a) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n, np.uint64)
        for j in range(n):
            h = (h ^ a[j:j + m]) * _MIX
            h ^= h >> np.uint64(29)
        ok = np.ones(m, bool)
        if n == 1:
            ok = a != 0
        for j in range(1, n - 1):  # a blank inside would join two words
            ok &= a[j:j + m] != 0
        out.append(h[ok])
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def top_ranks(text: str, sizes: tuple[int, ...], top: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent n-grams of a text and their ranks, from 0; ties share the mean rank."""
    grams, counts = np.unique(ngrams(text, sizes), return_counts=True)
    order = np.argsort(-counts, kind="stable")[:top]
    grams, counts = grams[order], counts[order]
    if not len(grams):
        return grams, np.empty(0)
    first = np.flatnonzero(np.concatenate(([True], counts[1:] != counts[:-1])))
    last = np.append(first[1:], len(counts)) - 1
    return grams, np.repeat((first + last) / 2, last - first + 1)


class Profiles:
    """The ranks of each known n-gram in the languages that have it, as (n-gram, language, rank) in order."""

    def __init__(self, ranked: dict[str, list[int]], top: int, sizes: tuple[int, ...]):
        self.langs, self.top, self.sizes = sorted(ranked), top, sizes
        gram = np.array([g for lang in self.langs for g in ranked[lang]], np.uint64)
        lang = np.array([j for j, lang in enumerate(self.langs) for _ in ranked[lang]], np.int64)
        rank = np.array([r for lang in self.langs for r in range(len(ranked[lang]))], float)
        order = np.argsort(gram, kind="stable")
        self.lang, self.rank = lang[order], rank[order]
        self.grams, first = np.unique(gram[order], return_index=True)
        self.first = np.append(first, len(gram))

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score). The distance to a language is ``top`` for each n-gram that it lacks and the
        difference of the ranks for the others."""
        grams, ranks = top_ranks(text or "", self.sizes, self.top)
        if not len(grams) or not self.langs or not any(map(str.isalpha, text)):
            return "und", 0.0
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        known = self.grams[at] == grams
        begin, size = self.first[at[known]], np.diff(self.first)[at[known]]
        each = np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size)
        nearer = np.abs(self.rank[each] - np.repeat(ranks[known], size)) - self.top
        away = self.top * len(grams) + np.bincount(self.lang[each], nearer, len(self.langs))
        best = int(away.argmin())
        return self.langs[best], float(1 - away[best] / (self.top * len(grams)))


def _count(sizes: tuple[int, ...]):
    """Counts of (lang, n-gram) of a task's batches, merged before they leave it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0

        def flush():
            for lang, parts in held.items():
                grams, inv = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                n = np.bincount(inv, np.concatenate([p[1] for p in parts])).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n)],
                    names=["lang", "gram", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                grams, n = np.unique(ngrams(text.as_py(), sizes), return_counts=True)
                held.setdefault(lang, []).append((grams, n))
                size += len(grams)
            if size > 4_000_000:
                yield from flush()
                held, size = {}, 0
        yield from flush()
    return run


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        rows_per_lang: int = 20_000, top: int = 400, sizes: tuple[int, ...] = (1, 2, 3), seed: int = 6,
        most_langs: int = MAX_LANGS) -> Profiles:
    """Profiles from the rows of ``labelled`` that have a text and a language: about ``rows_per_lang`` rows of
    each of the ``most_langs`` languages with the most rows."""
    rows = labelled.select(col(id_col).cast("string").alias("id"), col(lang_col).cast("string").alias("lang"),
                           col(text_col).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    found = rows.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(most_langs).collect()
    if not found:
        return Profiles({}, top, sizes)
    key = F.coalesce("id", F.md5("text"))
    shares = {r["lang"]: min(1.0, rows_per_lang / r["count"]) for r in found}
    # one row a language, most_langs at most
    known = rows.sparkSession.createDataFrame([(k, int(v * (1 << 32))) for k, v in shares.items()], "lang string, share long")
    draw = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 32))
    rows = rows.join(F.broadcast(known), "lang").where(draw < F.col("share"))
    counts = rows.select("lang", "text").mapInArrow(_count(sizes), "lang string, gram long, n long")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = (counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))
    ranked: dict[str, list] = {}
    for r in sorted(best.collect(), key=lambda r: (r["lang"], r["rank"])):
        ranked.setdefault(r["lang"], []).append(r["gram"] % (1 << 64))
    return Profiles(ranked, top, sizes)


def predict(text: Column, profiles: Profiles) -> Column:
    """struct<lang_pred string, score double> for a text column."""
    def batch(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in parts:
            yield pd.DataFrame([profiles.predict(t) for t in s], columns=["lang_pred", "score"])
    batch.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(batch, "lang_pred string, score double").asNondeterministic()(text)


def keep_identified(docs: DataFrame, profiles: Profiles, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that no language can be given to: ``und``, or no n-gram in any profile
    (score 0), where the distances to all languages are equal."""
    keep = [col(c) for c in docs.columns]
    found = docs.select(F.struct(*keep).alias("row"), predict(col(text_col), profiles).alias("found"))
    return found.where("found.lang_pred != 'und' AND found.score > 0").select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns])
