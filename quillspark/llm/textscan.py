"""Vectorised scanning of whole texts: code points, runs of a class, and 64-bit hashes of runs.

A batch of texts becomes one array of code points with a separator after each
text.  Character classes come from a table, runs from class changes, and the
hash of any run from two prefix arrays, so that no Python loop visits words.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np

U64 = np.uint64
#: Code points of one scanned piece; a longer text is a piece of its own.
PIECE = 1 << 19

_R = 0x9E3779B97F4A7C15 | 1
_RINV = pow(_R, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("r")
    if have is None or len(have) < n:
        size = max(n, PIECE + 1)
        with np.errstate(over="ignore"):
            for k, base in (("r", _R), ("i", _RINV)):
                step = np.full(size, base, U64)
                step[0] = 1
                _POWERS[k] = np.multiply.accumulate(step)
    return _POWERS["r"][:n], _POWERS["i"][:n]


@functools.cache
def char_table(kind: str) -> np.ndarray:
    """Tables over all 65,536 code points of the first plane (the rest counts as U+FFFF's neighbour, a letter if it is one)."""
    chars = [chr(i) for i in range(0x10000)]
    if kind == "lower":
        out = np.arange(0x10000, dtype=np.uint32)
        for i, c in enumerate(chars):
            low = c.lower()
            if len(low) == 1:
                out[i] = ord(low)
        return out
    if kind == "word":
        return np.array([c.isalnum() or c == "_" for c in chars])
    if kind == "pretoken":  # 0 other, 1 letter, 2 number, 3 white space
        cat = [unicodedata.category(c)[0] for c in chars]
        space = [c.isspace() and c not in "\x1c\x1d\x1e\x1f" for c in chars]
        return np.array([3 if s else 1 if k == "L" else 2 if k == "N" else 0 for k, s in zip(cat, space)], np.uint8)
    raise KeyError(kind)


def lookup(table: np.ndarray, codes: np.ndarray, beyond) -> np.ndarray:
    """table[codes]; code points beyond the first plane get `beyond(char)`."""
    if len(codes) == 0 or codes.max() < 0x10000:
        return table[codes]
    out = table[np.minimum(codes, 0xFFFF)]
    far = np.nonzero(codes > 0xFFFF)[0]
    for code in np.unique(codes[far]):
        out[far[codes[far] == code]] = beyond(chr(code))
    return out


def pieces(texts: list[str]):
    """Index ranges of `texts` whose joint length stays near PIECE."""
    start, total = 0, 0
    for i, t in enumerate(texts):
        if total and total + len(t) > PIECE:
            yield start, i
            start, total = i, 0
        total += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points with a separator (0) after each text, and the start of each text and of the end."""
    codes = np.frombuffer(("\0".join(texts) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return codes, starts


def run_hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of codes[start:end]."""
    r, inv = _powers(len(codes))
    with np.errstate(over="ignore"):
        val = mix((codes.astype(U64) + U64(1)) * U64(0xD1342543DE82EF95))
        prefix = np.zeros(len(codes) + 1, U64)
        np.cumsum(val * r, out=prefix[1:])
        return mix((prefix[end] - prefix[start]) * inv[np.minimum(start, len(codes) - 1)] + (end - start).astype(U64))
