"""Words of many texts as flat arrays, for the operators that look at words inside a task."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

_P = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_P_INV = pow(_P, -1, 1 << 64)
#: Bytes hashed at once; a text is cut only between words.
_PIECE = 1 << 20


_BYTE = np.arange(256)
SPACE = np.isin(_BYTE, [0x20, 9, 10, 11, 12, 13])
IN_WORD = ~SPACE
IN_LINE = _BYTE != 10
SYMBOL = np.isin(_BYTE, list(b"#*$%&|<>"))
CODE_POINT = (_BYTE & 0xC0) != 0x80  # the first byte of a code point
UPPER = (_BYTE >= 65) & (_BYTE <= 90)
LETTER = UPPER | ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 0xC0)  # one byte for each letter
LETTER_BYTE = LETTER | (_BYTE >= 0x80)
DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
CLOSING = np.isin(_BYTE, list(b".,;:!?"))
MARK = np.isin(_BYTE, list(b"!?"))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


class _Tables:
    up = _powers(_P, _PIECE + 1)
    down = _powers(_P_INV, _PIECE + 1)


def scramble(h: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _pieces(data: np.ndarray, is_word: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of pieces of about ``_PIECE`` bytes that end outside a word (a longer word is one piece)."""
    start, n = 0, len(data)
    while start < n:
        stop = min(n, start + _PIECE)
        if stop < n:
            back = np.flatnonzero(~is_word[start:stop])
            if len(back):
                stop = start + int(back[-1]) + 1
            else:
                ahead = np.flatnonzero(~is_word[stop:])
                stop = stop + int(ahead[0]) + 1 if len(ahead) else n
        yield start, stop
        start = stop


def words(data: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash) of the runs of word bytes in a byte array. Equal words have equal hashes;
    the hash is a polynomial modulo 2^64 of the bytes and the length, scrambled."""
    edge = np.diff(np.concatenate(([0], is_word.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    hashes = np.empty(len(starts), np.uint64)
    for a, b in _pieces(data, is_word):
        lo, hi = np.searchsorted(starts, (a, b))
        if lo == hi:
            continue
        n = b - a
        up = _Tables.up if n <= _PIECE else _powers(_P, n + 1)
        down = _Tables.down if n <= _PIECE else _powers(_P_INV, n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((data[a:b].astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
        s, e = starts[lo:hi] - a, ends[lo:hi] - a
        hashes[lo:hi] = scramble((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
    return starts, ends, hashes


def joined(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts with a line feed after each, start offset of each text and the end)."""
    parts = [t.encode("utf-8") if t else b"" for t in texts]
    offsets = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=offsets[1:])
    return np.frombuffer(b"\n".join([*parts, b""]), np.uint8), offsets


def by_bytes(texts: list, limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``limit`` characters together (one text at least)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size + n > limit and i > start:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)
