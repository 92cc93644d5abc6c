"""Quality rules as weak supervision: each rule votes good, bad or abstains; expectation-maximisation
over the counts of vote patterns estimates how far each rule is right; a document is kept when its
posterior probability of good is at least ``threshold``, in place of having to pass every rule. A
document that fails the base test (fewer than ``min_words`` words, or more than half of its words in
repeated three-word windows) is never kept.

Text statistics are made in one map over whole texts with array code; the vote patterns (at most
2^12) are counted by Spark with partial sums; the model is fitted on that table and applied as a
column expression. No row is shuffled except as a count of its pattern.

Edge cases. NULL or empty text: all counts 0, every rule abstains, base test failed. Repeated rows
get equal results and count as often as they come. Empty table: no rows. Only the named columns
are read, so others cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import weak_labels
from .common import col, stash
from .textarrays import (CLOSING, CODE_POINT, IN_LINE, IN_WORD, LETTER, LETTER_BYTE, MARK, SYMBOL, UPPER, by_bytes,
                         joined, scramble, words)

#: (statistic, vote, from, to): the vote is cast where from <= statistic < to.
_TOP = float("inf")
RULES = [
    ("symbols", "n", 0.10, _TOP),       # characters of #*$%&|<> per word
    ("repeats", "n", 0.25, _TOP),       # share of words in repeated three-word windows
    ("dup_lines", "n", 0.30, _TOP),     # share of lines equal to an earlier one, from three lines on
    ("capitals", "n", 0.40, _TOP),      # share of capitals among letters
    ("marks", "n", 0.25, _TOP),         # exclamation and question marks per word
    ("bare", "n", 0.20, _TOP),          # share of words without a letter
    ("variety", "n", 0.0, 1.5),         # distinct words over sqrt(2 n), from 50 words on
    ("letters", "n", 0.0, 0.80),        # share of letters among the characters of words
    ("length", "n", 4.0, _TOP),         # distance of the mean word length from 6
    ("run", "n", 0.08, _TOP),           # longest run of one word as a share of words, from 50 words on
    ("plain", "n", 0.0, 0.50),          # share of words of letters with at most one closing mark
    ("plain", "y", 0.90, _TOP),
]


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.add.reduceat(flags, offsets[:-1], dtype=np.int64)


def _counted(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(how often each element's key comes in its text, whether it is the first of its key in sort order)."""
    mixed = scramble(keys ^ scramble(owner.astype(np.uint64)))
    order = np.argsort(mixed, kind="stable")
    same = mixed[order]
    first = np.concatenate(([True], same[1:] != same[:-1])) if len(same) else np.empty(0, bool)
    group = np.cumsum(first) - 1
    times, lead = np.empty(len(keys), np.int64), np.empty(len(keys), bool)
    times[order] = np.bincount(group, minlength=1)[group] if len(same) else 0
    lead[order] = first
    return times, lead


def statistics(texts: list[str | None]) -> dict[str, np.ndarray]:
    """Counts and ratios of each text, as arrays."""
    data, offsets = joined(texts)
    n = len(texts)
    starts, ends, hashes = words(data, IN_WORD[data])
    owner = np.searchsorted(offsets, starts, "right") - 1
    n_words = np.bincount(owner, minlength=n)
    out = {"n_words": n_words, "word_chars": _per_text((CODE_POINT & IN_WORD)[data], offsets),
           "n_symbols": _per_text(SYMBOL[data], offsets)}

    ls, le, lh = words(data, IN_LINE[data])
    filled = np.concatenate(([0], np.cumsum(IN_WORD[data])))
    full = filled[le] > filled[ls]
    lowner = np.searchsorted(offsets, ls[full], "right") - 1
    _, lead = _counted(lh[full], lowner)
    n_lines = np.bincount(lowner, minlength=n)
    out["n_dup_lines"] = n_lines - np.bincount(lowner, lead, n).astype(np.int64)

    covered = np.zeros(len(hashes) + 2, bool)
    if len(hashes) >= 3:
        whole = owner[:-2] == owner[2:]
        step = np.uint64(0xD1342543DE82EF95)
        window = ((hashes[:-2] * step + hashes[1:-1]) * step + hashes[2:])[whole]
        twice = np.zeros(len(hashes) - 2, bool)
        twice[whole] = _counted(window, owner[:-2][whole])[0] >= 2
        for j in range(3):
            covered[j:j + len(twice)] |= twice
    out["n_repeat_words"] = np.bincount(owner, covered[:len(hashes)], n).astype(np.int64)

    _, lead = _counted(hashes, owner)
    distinct = np.bincount(owner, lead, n)
    letters = np.concatenate(([0], np.cumsum(LETTER[data])))
    bare = np.bincount(owner, letters[ends] == letters[starts], n)
    other = np.concatenate(([0], np.cumsum(~LETTER_BYTE[data])))
    odd = other[ends] - other[starts]
    plain = np.bincount(owner, (odd == 0) | ((odd == 1) & CLOSING[data[ends - 1]] & (ends - starts > 1)), n)
    change = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1]))) if len(hashes) else []
    heads = np.flatnonzero(change)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, owner[heads], np.diff(np.append(heads, len(hashes))))
    with np.errstate(divide="ignore", invalid="ignore"):
        w = n_words.astype(float)
        n_letters = _per_text(LETTER[data], offsets)
        out |= {"symbols": out["n_symbols"] / w, "repeats": out["n_repeat_words"] / w,
                "dup_lines": np.where(n_lines >= 3, out["n_dup_lines"] / n_lines, np.nan),
                "capitals": _per_text(UPPER[data], offsets) / n_letters,
                "marks": _per_text(MARK[data], offsets) / w, "bare": bare / w, "plain": plain / w,
                "variety": np.where(w >= 50, distinct / np.sqrt(2 * w), np.nan),
                "letters": n_letters / out["word_chars"], "length": np.abs(out["word_chars"] / w - 6),
                "run": np.where(w >= 50, longest / w, np.nan)}
    return out


def votes(stats: dict[str, np.ndarray]) -> list[str]:
    """One character for each rule: its vote, or abstain (out of its range, or nothing to measure)."""
    cols = []
    for key, vote, low, high in RULES:
        with np.errstate(invalid="ignore"):
            cols.append(np.where((stats[key] >= low) & (stats[key] < high), vote, weak_labels.ABSTAIN))
    return ["".join(r) for r in zip(*cols)]


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        for a, b in by_bytes(texts):
            stats = statistics(texts[a:b])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), *[pa.array(stats[c], pa.int64()) for c in _COUNTS],
                 pa.array(votes(stats), pa.string())], names=["doc_id", *_COUNTS, "votes"])


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the five counts, and ``votes`` (one character for each of ``RULES``)."""
    schema = ", ".join([f"doc_id {docs.schema[id_col].dataType.simpleString()}", *[f"{c} bigint" for c in _COUNTS], "votes string"])
    return docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text")).mapInArrow(
        _measure, schema)


def posterior(votes_col: Column, model: weak_labels.Reliability) -> Column:
    """Probability of good as an expression over a vote string."""
    p = model.prior.get(0, 0.5)
    odds = F.lit(float(np.log(p / (1 - p))))
    for j, (yes, no) in enumerate(model.log_odds().tolist()):
        v = F.substring(votes_col, j + 1, 1)
        odds = odds + F.when(v == weak_labels.YES, yes).when(v == weak_labels.NO, no).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def judge(docs: DataFrame, min_words: int = 50, threshold: float = 0.5, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """The columns of :func:`measure` with ``base_failed``, ``p_good`` and ``kept``."""
    found = stash(measure(docs, id_col, text_col), "statistics")
    patterns = [(0, r["votes"], r["n"]) for r in
                found.groupBy("votes").agg(F.count("*").alias("n")).collect()]  # 2^12 rows at most
    model = weak_labels.fit(patterns, len(RULES), prior=0.8)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    found = found.withColumn("base_failed", failed).withColumn("p_good", posterior(F.col("votes"), model))
    return found.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold))
