"""Exact token counts of a public byte-level BPE, without encoding every text.

BPE never merges across pre-tokens, so a text's count is the sum over its
pre-tokens.  They are found and hashed by array operations; each distinct one
is encoded once per worker and its count kept in a direct-mapped table keyed by
its full 64-bit hash.
"""

from __future__ import annotations

import base64
import os

import numpy as np

from quillspark.llm import textscan as ts

#: Folder of the vocabulary files; a parameter, never copied into the repository.
TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
# Fixed value: the pre-token pattern of that vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_SLOTS = 1 << 20
_OPEN: dict[str, "TokenCounter"] = {}


def counter(folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> "TokenCounter":
    """The worker's own counter for a vocabulary."""
    path = os.path.join(folder, vocabulary)
    if path not in _OPEN:
        _OPEN[path] = TokenCounter(path)
    return _OPEN[path]


class TokenCounter:
    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.keys = np.zeros(_SLOTS, np.uint64)
        self.counts = np.zeros(_SLOTS, np.int32)

    def encode(self, text: str) -> list[int]:
        return self.encoding.encode_ordinary(text)

    def count(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        for a, b in ts.pieces(texts):
            out[a:b] = self._count(texts[a:b])
        return out

    def _count(self, texts: list[str]) -> np.ndarray:
        codes, starts = ts.code_points(texts)
        first, last = pretokens(codes, starts)
        if not len(first):
            return np.zeros(len(texts), np.int64)
        h = ts.run_hashes(codes, first, last)
        slot = (h & np.uint64(_SLOTS - 1)).astype(np.int64)
        n = np.where(self.keys[slot] == h, self.counts[slot], -1)
        miss = np.nonzero(n < 0)[0]
        if len(miss):
            _, at, back = np.unique(h[miss], return_index=True, return_inverse=True)
            where = miss[at]
            words = [codes[i:j].tobytes().decode("utf-32-le", "surrogatepass") for i, j in zip(first[where], last[where])]
            got = np.array([len(self.encode(w)) for w in words], np.int32)
            n[miss] = got[back]
            self.keys[slot[where]], self.counts[slot[where]] = h[where], got
        text_of = np.searchsorted(starts, first, side="right") - 1
        return np.bincount(text_of, weights=n, minlength=len(texts)).astype(np.int64)


def pretokens(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end positions of the pre-tokens of all texts, as PATTERN cuts them."""
    sep = starts[1:] - 1
    cls = ts.lookup(ts.char_table("pretoken"), codes, lambda c: 1 if c.isalpha() else 2 if c.isnumeric() else 0).astype(np.uint8)
    cls[sep] = 4
    begin = np.empty(len(cls), bool)
    begin[0] = True
    np.not_equal(cls[1:], cls[:-1], out=begin[1:])
    # white space before a visible run: its last character leaves the run, and a blank joins what follows
    space = cls == 3
    last_space = np.zeros(len(cls), bool)
    last_space[:-1] = space[:-1] & ~space[1:] & (cls[1:] != 4)
    at = np.nonzero(last_space)[0]
    begin[at] = True
    blank = at[codes[at] == 32]
    begin[blank + 1] = False
    # contractions: an apostrophe that starts a pre-token, is alone, and is followed by s, t, m, d, re, ve or ll
    apo = np.nonzero((codes == 39) & begin)[0]
    apo = apo[(apo + 2 < len(codes))]
    apo = apo[cls[apo + 1] == 1]
    if len(apo):
        c1, c2 = codes[apo + 1], codes[np.minimum(apo + 2, len(codes) - 1)]
        one = np.isin(c1, [115, 116, 109, 100])
        two = ((c1 == 114) & (c2 == 101)) | ((c1 == 118) & (c2 == 101)) | ((c1 == 108) & (c2 == 108))
        for hit, n in ((one, 2), (two & ~one, 3)):
            p = apo[hit]
            begin[p + 1] = False
            nxt = p + n
            begin[nxt[cls[nxt] == 1]] = True
    first = np.nonzero(begin)[0]
    end = np.append(first[1:], len(codes))
    keep = cls[first] != 4
    return first[keep], end[keep]
