"""Toxicity scoring of restored text: noisy-channel deobfuscation, then a word classifier.

Restoration. A word that mixes letters with look-alike digits and signs, repeats a letter, or is spelled
out with separators becomes a lattice: each character is itself or a letter it stands for, punctuation
after the last letter may be left out at little cost, a separator may be dropped or be a break between
two words, a repeat may be cut to one or two. Single characters with up to four separators of any
kind between them are spelled out too; words joined by hyphens, dashes or dots are also read as one, and
two words with a blank between them where together they are a word of the lexicon. Full-width signs and
letters are read as plain ones. Viterbi decoding picks the path of least cost, the channel's cost plus that of a trigram
character model, and its breaks split it into words (see ``BREAKS``). All other words have a lattice of
one path and are left alone. The character model is counted over all texts given (partial counts in
each task, summed by Spark): its table is bounded by the alphabet cubed, and its counts grow with the
corpus.

Scoring. Features of a document are its distinct restored words and their beginnings of four to six
letters. A lexicon of features with their toxic probabilities is learned by sequential covering from
at most about ``train_rows`` labelled documents, equal texts and near copies (four fifths of the distinct
words in common) once, taken by a hash of the id (all where there are fewer), with ``train_words``
distinct words in all, counted by document; rows to hold out are the
caller's filter. The score is the probability that at
least one of the document's features is toxic. It uses the whole text, and a feature counts once, so
that a long clean text around it does not dilute it.

Edge cases. NULL, empty text, or no word: the share of toxic texts that no feature explains. Label rows with a NULL label, or
with different labels for one id, are not learned from. No labels, or labels of one kind: every score
is the share of toxic labels (0 without any). Repeated rows get equal scores. Only the named columns
are read.
"""

from __future__ import annotations

import itertools
import operator
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import col, hash_share, stash, within
from .textarrays import scramble

#: What a character can stand for in disguise.
LOOK_ALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
               "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c", "<": "c", "*": "aeiou"}
_SIGNS = "".join(re.escape(c) for c in LOOK_ALIKES)
#: Cost of reading a look-alike as a letter, of leaving it out as a sign, of dropping a separator or a repeat.
SUBSTITUTE, LEAVE_OUT, DROP = 1.0, 6.0, 0.5
#: Signs that also end a word as punctuation, and the cost of leaving one out after the last letter of a word.
PUNCTUATION, TRAILING = frozenset("!*+|(<"), 0.5
#: Cost of reading a separator as a break between two words. Three characters seldom tell where a word ends, so
#: what is spelled out is read once at each of these costs, from one word to many, and all readings count.
BREAKS = (np.inf, 0.5, -2.0)

ALPHABET = 64  # classes of the character model: blank, a-z, the rest of the letters by code point
_READINGS = {c: tuple((x, SUBSTITUTE) for x in letters) for c, letters in LOOK_ALIKES.items()}
#: Three or more single letters, digits or look-alikes with the same separator between them; a sign after another sign starts none.
_UNIT = rf"(?!_)[\w{_SIGNS}]"
_SPELLED = re.compile(rf"(?<![^\W_])(?:[^\W_]|(?<![{_SIGNS}])[{_SIGNS}])([ .\-_*]){_UNIT}(?:\1{_UNIT})+(?![^\W_])")
#: The same with one to four separators of any kind, line breaks included, between two characters.
_LOOSE = re.compile(rf"(?<![^\W_])(?:[^\W_]|(?<![{_SIGNS}])[{_SIGNS}])(?:[\s.\-_]{{1,4}}{_UNIT}){{2,}}(?![^\W_])")
_UNITS = re.compile(_UNIT)
#: Pieces of a word with a hyphen, a dash or dots between them, at a line's end too.
_BROKEN = re.compile(r"(?<![^\W\d_])[^\W\d_]+(?:(?:-\n|[-_\u00ad\u00b7\u2010-\u2015\u2026]|\.{2,4})[^\W\d_]+)+")
_BREAK = re.compile(r"[-_\u00ad\u00b7\u2010-\u2015\u2026]|\.\.")
_FULL_WIDTH = re.compile("[\uff01-\uff5e]")
_NARROW = {0xFF01 + i: 0x21 + i for i in range(94)}
_LETTER = re.compile(r"[^\W\d_]")
_SEPARATORS = frozenset(" .-_*")
_PLAIN = re.compile(r"[^\W\d_]+")
_SIGN = re.compile(rf"[{_SIGNS}]")
#: A run of letters and look-alikes with both in it. It starts at the beginning of a run of signs or letters, so
#: that no run is tried from each of its characters.
_ODD = re.compile(rf"(?<![^\W_])(?<![{_SIGNS}])(?:[^\W\d_]++[{_SIGNS}]|[{_SIGNS}]++[^\W\d_])(?:[^\W\d_]|[{_SIGNS}])*+")
#: One step of a lattice: each reading of a character, and its cost.
Options = tuple[tuple[str, float], ...]
_REPEAT = re.compile(r"([^\W\d_])\1")


def _class(c: str) -> int:
    """Class of a character: 0 for a blank, 1 to 26 for a to z, 27 up for other letters."""
    if "a" <= c <= "z":
        return ord(c) - 96
    return 27 + ord(c) % (ALPHABET - 27) if c.isalpha() else 0


_CLASSES: np.ndarray | None = None


def _classes() -> np.ndarray:
    global _CLASSES
    if _CLASSES is None:
        _CLASSES = np.array([_class(chr(i).lower()[:1] or " ") for i in range(0x110000)], np.uint8)
    return _CLASSES


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table, classes = np.zeros(ALPHABET ** 3, np.int64), _classes()
    for batch in batches:
        for value in batch.column(0):
            text = value.as_py()
            if not text:
                continue
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            a = np.concatenate(([0], classes[points], [0])).astype(np.int64)
            a = a[np.concatenate(([True], (a[1:] > 0) | (a[:-1] > 0)))]
            if len(a) > 2:
                code = (a[:-2] * ALPHABET + a[1:-1]) * ALPHABET + a[2:]
                grams, n = np.unique(code, return_counts=True)
                table[grams] += n
    used = np.flatnonzero(table)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(table[used])], names=["gram", "n"])


class CharModel:
    """-log P(character | two before it), by trigram counts backed off to bigrams and single characters."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        n3 = np.zeros(ALPHABET ** 3)
        n3[grams] = counts
        n3 = n3.reshape(ALPHABET, ALPHABET, ALPHABET)
        n2 = n3.sum(0)
        n1 = n2.sum(0)
        p1 = (n1 + 1) / (n1.sum() + ALPHABET)
        p2 = (n2 + 20 * p1) / (n2.sum(1, keepdims=True) + 20)
        p3 = (n3 + 20 * p2) / (n3.sum(2, keepdims=True) + 20)
        self.cost = -np.log(p3).astype(np.float32)
        self._table: list | None = None
        self._ways: dict = {}

    def __getstate__(self):
        return self.__dict__ | {"_table": None, "_ways": {}}

    def ways(self, states: tuple[int, ...], options: Options) -> tuple[tuple[int, ...], list]:
        """The states (last two classes) that one step of a lattice leads to, and for each the ways into it:
        (index of the state before, cost, characters). Remembered, up to a bound, since long runs repeat them."""
        out = self._ways.get((states, options))
        if out is None:
            if self._table is None:
                self._table = self.cost.reshape(ALPHABET * ALPHABET, ALPHABET).tolist()
            into: dict[int, list[tuple[int, float, str]]] = {}
            for chars, extra in options:
                classes = [_class(ch) for ch in chars]
                for i, state in enumerate(states):
                    here = extra
                    for k in classes:
                        here += self._table[state][k]
                        state = state % ALPHABET * ALPHABET + k
                    into.setdefault(state, []).append((i, here, chars))
            out = (tuple(into), list(into.values()))
            if len(options[0][0]) <= 16:
                if len(self._ways) >= 2000:
                    self._ways.clear()
                self._ways[states, options] = out
        return out


def char_model(docs: DataFrame, text_col: str = "text") -> CharModel:
    """Trigram counts over all texts; at most ``ALPHABET`` cubed rows reach the driver."""
    counts = (docs.select(col(text_col).alias("text")).mapInArrow(_count_trigrams, "gram bigint, n bigint")
              .groupBy("gram").agg(F.sum("n").alias("n")).collect())
    return CharModel(np.array([r["gram"] for r in counts], np.int64), np.array([r["n"] for r in counts], float))


def is_spelled(word: str) -> bool:
    return word[1:2] in _SEPARATORS and _SPELLED.fullmatch(word) is not None


def _joined(options: Options, after: str) -> Options:
    return _short_joined(options, after) if len(after) < 16 else tuple((chars + after, cost) for chars, cost in options)


@lru_cache(10_000)
def _short_joined(options: Options, after: str) -> Options:
    return tuple((chars + after, cost) for chars, cost in options)


def decode(word: str, model: CharModel, break_cost: float = BREAKS[1]) -> str:
    """The likeliest plain spelling of one lower-cased word, or words with blanks between them where it
    is spelled out (Viterbi over its character lattice)."""
    spelled = is_spelled(word)
    breaks = () if break_cost == np.inf else ((" ", break_cost),)
    # Characters with one reading are joined to the readings before them.
    steps: list[Options] = []
    options, fixed, i = (("", 0.0),), [], 0
    end = len(word)
    while end and not _LETTER.match(word, end - 1):
        end -= 1
    while i < len(word):
        c = word[i]
        run = 1
        while c.isalpha() and i + run < len(word) and word[i + run] == c:
            run += 1
        letters = _READINGS.get(c, ())
        if spelled and i % 2:
            readings = (("", DROP), *breaks, *letters)
        elif letters:
            readings = (*letters, ("", TRAILING if i >= end and c in PUNCTUATION else LEAVE_OUT))
        elif not c.isalpha():
            readings = (("", DROP),)
        elif run > 1:
            readings = ((c, DROP), (c + c, DROP if run > 2 else 0.0))
        else:
            readings = ((c, 0.0),)
        if len(readings) == 1:
            fixed.append(readings[0][0])
        else:
            steps.append(_joined(options, "".join(fixed)))
            options, fixed = readings, []
        i += run
    steps.append(_joined(options, "".join(fixed) + " "))
    # A path's text is a chain of (chain before, characters): chains that no path continues are freed on the way.
    states, totals, chains = (0,), [0.0], [None]
    for options in steps:
        states, ways = model.ways(states, options)
        best_totals, best_chains = [], []
        for edges in ways:
            best = np.inf
            for i, extra, chars in edges:
                here = totals[i] + extra
                if here < best:
                    best, source, out = here, i, chars
            best_totals.append(best)
            best_chains.append((chains[source], out) if out else chains[source])
        totals, chains = best_totals, best_chains
    chain, parts = chains[totals.index(min(totals))], []
    while chain:
        chain, chars = chain
        parts.append(chars)
    return "".join(reversed(parts)).strip()


def _remember(known: dict, word: str, out: tuple[str, ...], most: int) -> None:
    if len(word) > 64:  # long ones seldom come again and would make the memory large
        return
    if len(known) >= most:
        known.clear()
    known[word] = out


class Restorer:
    """Distinct words of a text, and their restored forms; restored words are remembered, up to a bound."""

    def __init__(self, model: CharModel, remember: int = 200_000):
        self.model, self.remember, self.known = model, remember, {}

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def read(self, text: str | None) -> tuple[list[str], set[str]]:
        """(plain words in order; all distinct words: the plain ones, words with look-alikes in them,
        spelled-out words and words put together across hyphens and dots), lower-cased."""
        if not text:
            return [], set()
        low = text.lower()
        if _FULL_WIDTH.search(low):
            low = low.translate(_NARROW).lower()
        plain = _PLAIN.findall(low)
        found = set(plain)
        if _SIGN.search(low):
            found.update(m[0] for m in _ODD.finditer(low))
        single = sum(len(w) == 1 for w in plain)
        if single:
            found.update(m[0] for m in _SPELLED.finditer(low) if _LETTER.search(m[0]))
        if single > 2:  # three letters at least that stand alone
            for m in _LOOSE.finditer(low):
                if _LETTER.search(m[0]) and not _SPELLED.fullmatch(m[0]):
                    found.add(" ".join(_UNITS.findall(m[0])))
        if _BREAK.search(low):
            found.update("".join(_PLAIN.findall(m[0])) for m in _BROKEN.finditer(low))
        return plain, found

    def raw_words(self, text: str | None) -> set[str]:
        return self.read(text)[1]

    def restored(self, word: str) -> tuple[str, ...]:
        """The word, and the words of its decoded forms where its lattice has more than one path."""
        out = self.known.get(word)
        if out is None:
            plain = word.isalpha()
            if plain and not _REPEAT.search(word):
                out = (word,)
            else:
                costs = BREAKS if is_spelled(word) else BREAKS[1:2]
                read = [w for c in costs for w in decode(word, self.model, c).split()]
                out = tuple(dict.fromkeys([word] * plain + read))
            _remember(self.known, word, out, self.remember)
        return out

    def words(self, text: str | None) -> set[str]:
        out = {r for w in self.raw_words(text) for r in self.restored(w)}
        out.discard("")
        return out


def features(word: str) -> list[str]:
    """The word and its beginnings of four to six letters (marked)."""
    return [word, *[word[:n] + "~" for n in (4, 5, 6) if len(word) > n]]


class Model:
    """Probability that each feature of the lexicon makes a text toxic, and that of a text without any."""

    def __init__(self, restorer: Restorer, lexicon: dict[str, float], rest: float):
        self.restorer, self.lexicon, self.rest, self.known = restorer, lexicon, rest, {}
        self.whole = frozenset(w for w in lexicon if len(w) >= 5 and not w.endswith("~"))

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def _hits(self, word: str) -> tuple[str, ...]:
        out = self.known.get(word)
        if out is None:
            out = tuple(f for r in self.restorer.restored(word) for f in features(r) if f in self.lexicon)
            _remember(self.known, word, out, self.restorer.remember)
        return out

    def score(self, text: str | None) -> float:
        plain, found = self.restorer.read(text)
        hits: set[str] = set()
        for w in self.whole.intersection(map(operator.add, plain, itertools.islice(plain, 1, None))):
            hits.update(f for f in features(w) if f in self.lexicon)
        for w in found:
            hits.update(self._hits(w))
        clean = 1 - self.rest
        for h in sorted(hits):
            clean *= 1 - self.lexicon[h]
        return 1 - clean


def _signatures(docs: list[list[str]], size: int) -> np.ndarray:
    """``size`` MinHash values of each document's words (the upper 32 bits of each); documents are not empty."""
    at: dict[str, int] = {}
    index = np.array([at.setdefault(w, len(at)) for d in docs for w in d], np.int64)
    first = np.concatenate(([0], np.cumsum([len(d) for d in docs])[:-1]))
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in at], np.uint64)
    out = np.empty((len(docs), size), np.uint32)
    for j in range(size):
        key = np.uint64(xxhash.xxh64_intdigest(str(j)))
        out[:, j] = np.minimum.reduceat((scramble(hashes ^ key) >> np.uint64(32)).astype(np.uint32)[index], first)
    return out


def _apart(docs: list[list[str]], labels: np.ndarray, alike: float = 0.8, size: int = 64) -> list[int]:
    """The documents without near copies: one goes only if its distinct words have a Jaccard similarity of at
    least ``alike``, counted, with a kept one of its label. Documents whose MinHash values agree to about that
    share are compared, the likeliest first; those are only candidates."""
    kept: list[int] = []
    for label in np.unique(labels):
        rows = [i for i in np.flatnonzero(labels == label) if docs[i]]
        kept += [i for i in np.flatnonzero(labels == label) if not docs[i]][:1]
        if not rows:
            continue
        signs, sets = _signatures([docs[i] for i in rows], size), [frozenset(docs[i]) for i in rows]
        held, here = np.empty((len(rows), size), np.uint32), []
        for i, words in enumerate(sets):
            agree = (held[:len(here)] == signs[i]).mean(1)
            near = np.flatnonzero(agree >= alike - 0.2)
            if any(len(words & sets[j]) >= alike * len(words | sets[j])
                   for j in (here[k] for k in near[np.argsort(-agree[near], kind="stable")])):
                continue
            held[len(here)] = signs[i]
            here.append(i)
        kept += [rows[i] for i in here]
    return sorted(int(i) for i in kept)


def fit_lexicon(docs: list[list[str]], labels: np.ndarray, min_docs: int = 3, precision: float = 0.6,
                chance: float = 0.01, sure: float = 0.9) -> tuple[dict[str, float], float]:
    """Sequential covering: the feature that best explains the toxic documents not yet explained is
    taken, until none is left that is in ``min_docs`` of them and right with ``precision``. So words
    that merely stand beside a toxic one are not learned. Features that are right with ``sure``,
    in so many toxic documents that no feature is expected there by chance (with ``chance``), are learned besides. Near
    copies (see ``_apart``) count once. Labels are 0 and 1."""
    if not len(labels):
        return {}, 0.0
    few = _apart(docs, labels)
    docs, labels = [docs[i] for i in few], labels[few]
    base = float(labels.mean())
    if base in (0.0, 1.0):
        return {}, base
    at: dict[str, int] = {}
    rows = [np.unique([at.setdefault(f, len(at)) for w in d for f in features(w)]).astype(np.int32) for d in docs]
    row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
    index = np.concatenate(rows)
    del rows
    names = list(at)
    bad = labels[row] == 1
    against = np.bincount(index[~bad], minlength=len(at))
    index, row = index[bad], row[bad]
    whole = np.bincount(index, minlength=len(at))
    usable = (whole >= min_docs) & (whole >= precision * (whole + against + 1))
    open_doc, lexicon = labels == 1, {}
    while True:
        left = open_doc[row] & usable[index]
        gain = np.bincount(index[left], minlength=len(at)).astype(float)
        gain[(gain < min_docs) | (gain < precision * (gain + against + 1))] = 0
        if not gain.any():
            break
        gain *= np.log(gain.clip(1) / (gain + against + 1) / base).clip(1e-9)
        best = np.flatnonzero(gain >= gain.max() * (1 - 1e-9))
        f = max(best, key=lambda i: (len(names[i]), names[i]))  # of equal ones the most specific
        lexicon[names[f]] = float(whole[f] + base) / float(whole[f] + against[f] + 1)
        open_doc[row[index == f]] = False
        usable[f] = False
    enough = max(min_docs, int(np.ceil(np.log(chance / len(at)) / np.log(base))))
    for f in np.flatnonzero((whole >= enough) & (whole >= sure * (whole + against + 1))):
        lexicon.setdefault(names[f], float(whole[f] + base) / float(whole[f] + against[f] + 1))
    unexplained = open_doc.sum() / max(1, (labels == 0).sum() + open_doc.sum())
    return lexicon, float(unexplained)


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic", train_rows: int = 4000, seed: int = 9,
        train_words: int = 4_000_000) -> Model:
    """The character model from all of ``docs``; the lexicon from labelled documents where ``train`` (a
    condition on the id column of ``labels``) holds: about ``train_rows`` of them, and ``train_words`` distinct
    words of theirs in all (a document that no longer fits is passed over)."""
    chars = char_model(docs, text_col)
    restorer = Restorer(chars)
    named = labels.select(col(id_col).alias("id"), col(label_col).cast("int").alias("y"))
    if train is not None:
        named = labels.where(train).select(col(id_col).alias("id"), col(label_col).cast("int").alias("y"))
    one = (named.where("id IS NOT NULL AND y IS NOT NULL").groupBy("id")
           .agg(F.min("y").alias("y"), F.max("y").alias("top")).where("y = top").select("id", "y"))
    total = one.count()
    sample = one.where(hash_share(F.col("id"), train_rows, total, seed))
    # About train_rows rows: small enough to send to every task.
    texts = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    words = F.pandas_udf(_words_of(restorer), "array<string>")
    rows = stash(texts.join(F.broadcast(sample), "id").select("id", "y", words("text").alias("words"))
                 .groupBy("id").agg(F.min("y").alias("y"), F.min("words").alias("words"))  # one text per id, however often it comes
                 .groupBy("words").agg(F.min("id").alias("id"), F.min("y").alias("y"), F.max("y").alias("top")).where("y = top"), "toxic-words")
    sizes = rows.select("id", "y", F.size("words").alias("n")).orderBy(F.xxhash64(F.lit(seed), "id"), "id").collect()
    if sum(r["n"] for r in sizes) > train_words:
        rows = rows.where(F.col("id").isin(within([tuple(r) for r in sizes], train_words)))
    found = rows.select("y", "words").orderBy("words").toArrow()
    lexicon, rest = fit_lexicon(_shared_strings(found.column("words")), found.column("y").to_numpy().astype(float))
    return Model(restorer, lexicon, rest)


def _shared_strings(column: pa.ChunkedArray) -> list[list[str]]:
    """The lists of a column, with one string for all its occurrences."""
    lists = column.combine_chunks()
    if not len(lists):
        return []
    lists = lists if isinstance(lists, pa.ListArray) else lists.chunk(0)
    coded = lists.flatten().dictionary_encode()
    names, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    ends = np.cumsum(lists.value_lengths().to_numpy())
    return [[names[c] for c in codes[e - n:e].tolist()] for e, n in zip(ends, lists.value_lengths().to_numpy())]


def _words_of(restorer: Restorer):
    def batch(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield pd.Series([sorted(restorer.words(t)) for t in s])
    batch.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return batch


def score(text: Column, model: Model) -> Column:
    def batch(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield pd.Series([model.score(t) for t in s], dtype=float)
    batch.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(batch, "double").asNondeterministic()(text)
