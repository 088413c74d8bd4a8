"""Held-out items that stand in corpus documents, whole or in part.

Items and documents become word sequences (letters, digits and underscores;
case, punctuation, layout, marks and typographic variants removed).  Every
window of `window` words of an item is a query.  Every window of every
document is embedded by the CGK random walk: at step t the word under the
pointer is put out, and the pointer advances by a bit that depends on the step
and the word, so that sequences at a small edit distance end at a small Hamming
distance.  Signatures sample positions of the walk; they are repeated until a
simulation reaches the target recall at `edits` edits a window (equal windows
have equal walks, so those are never missed).  Only windows with enough pairs
of neighbouring words that stand in some item so are walked: an edit breaks two
of them at most, so none that could be verified is passed over.  Windows that share a signature
with an item's are verified by their edit distance (the document's may be longer or
shorter by the edits), and what they cover of the item is counted twice: by all verified windows, and by those that are equal
word for word.

The items (a stated query set) go to the tasks in blocks of bounded size, as many
blocks to one scan of the documents as `PASS_BYTES` allows; the documents are
scanned where they lie, nothing is shuffled.

Defined results
  null or empty text              no words, no rows
  item with fewer words than window   can't be found
  repeated texts or items         a row for each pair of ids
  ties                            none: coverage is a union of intervals
"""

from __future__ import annotations

import html
import math
import random
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm import textscan as ts
from quillspark.session import ship

#: Item windows of one index at most; more items make more blocks.
BLOCK_WINDOWS = 1_000_000
#: Bytes of item texts that one scan of the documents takes along, broadcast; more items make more scans.
PASS_BYTES = 64 << 20

# Inline and block elements whose tags are marks around words.
_TAGS = "a|abbr|b|big|blockquote|body|br|center|cite|code|dd|del|details|div|dl|dt|em|font|h[1-6]|hr|html|i|img|ins|kbd|li|mark|ol|p|pre|q|s|samp|section|small|span|strike|strong|sub|summary|sup|table|tbody|td|tfoot|th|thead|tr|tt|u|ul|var"
_TAG = re.compile(rf"</(?:{_TAGS})\s*>|(?<![\w>])<(?:{_TAGS})(?:\s[^<>]*)?/?>|(?<=>)<(?:{_TAGS})(?:\s[^<>]*)?/?>", re.I)
_ENTITY = re.compile(r"&(?:[a-zA-Z]{2,8}|#\d{1,6}|#x[0-9a-fA-F]{1,5});")
_NUMBERED = re.compile(r"^[ \t]*\d+(?:[ ]{2,}|\t|[:|][ ]+)(?=\S)", re.M)
_IGNORED = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])


def plain(text: str) -> str:
    """Text without marks around words and lines and without typographic variants; words are still to be cut."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text.translate(_IGNORED))
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = _ENTITY.sub(lambda m: html.unescape(m.group()), text)
    return text


def unnumbered(text: str) -> str:
    """Without the line numbers of lines that are numbered one after the other."""
    marks = list(_NUMBERED.finditer(text))
    if len(marks) < 2:
        return text
    out, at, before = [], 0, None
    numbers = [int(m.group().strip(" \t:|")) for m in marks]
    for k, m in enumerate(marks):
        follows = k and numbers[k - 1] + 1 == numbers[k] and text.count("\n", marks[k - 1].start(), m.start()) == 1
        leads = k + 1 < len(marks) and numbers[k] + 1 == numbers[k + 1] and text.count("\n", m.start(), marks[k + 1].start()) == 1
        if follows or leads:
            out.append(text[at : m.start()])
            at = m.end()
    return "".join([*out, text[at:]])


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the (plain) texts, and the index of the text of each."""
    codes, starts = ts.code_points(texts)
    codes = ts.lookup(ts.char_table("lower"), codes, lambda c: ord(c.lower()) if len(c.lower()) == 1 else ord(c))
    word = ts.lookup(ts.char_table("word"), codes, str.isalnum)
    word[starts[1:] - 1] = False
    low = np.nonzero((codes == 95) & word)[0]
    while len(low):  # underscores at the edge of a word are marks around it
        edge = low[~(word[np.maximum(low - 1, 0)] & (low > 0) & word[np.minimum(low + 1, len(word) - 1)])]
        if not len(edge):
            break
        word[edge] = False
        low = low[word[low]]
    step = np.diff(word.astype(np.int8), prepend=0, append=0)
    first, last = np.nonzero(step == 1)[0], np.nonzero(step == -1)[0]
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return ts.run_hashes(codes, first, last), np.searchsorted(starts, first, side="right") - 1


# ---------------------------------------------------------------- CGK and bit sampling


@dataclass(frozen=True)
class Walk:
    """CGK walks over windows of `window` words: a salt for the bits and the sampled positions of each repetition."""

    window: int
    repetitions: tuple[tuple[int, tuple[int, ...]], ...]


def make_walk(window: int, edits: int = 0, recall: float = 0.95, sampled: int = 8, seed: int = 7) -> Walk:
    """As many repetitions as reach the target recall.

    Equal windows have equal walks, so one is enough at edits = 0.  Otherwise the
    recall is simulated: random windows with `edits` edits at random
    places, repetitions added until the share found exceeds the target.
    """
    r = random.Random(seed)
    if edits == 0:
        return Walk(window, ((0, tuple(sorted(r.sample(range(2 * window), min(sampled, 2 * window))))),))
    if not 0 <= recall < 1:
        raise ValueError("a recall below 1 is needed where edits are allowed")
    one, two = edited_windows(np.random.default_rng(seed), 2000, window, edits)
    start = np.arange(len(one)) * one.shape[1]
    left = np.ones(len(one), bool)
    out: list[tuple[int, tuple[int, ...]]] = []
    while left.mean() > 1 - recall:
        rep = (r.getrandbits(63), tuple(sorted(r.sample(range(2 * window), min(sampled, 2 * window)))))
        out.append(rep)
        a, b = (walk_signatures(x.ravel(), start, Walk(window, (rep,)))[0] for x in (one, two))
        left &= a != b
    return Walk(window, tuple(out))


def edited_windows(g: np.random.Generator, n: int, window: int, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """n random windows (with some words after them), and the same with `edits` words changed, put in or taken out."""
    one = g.integers(1, 1 << 63, (n, window + edits), dtype=np.int64).astype(np.uint64)
    two = one.copy()
    for row in two:
        for _ in range(edits):
            at = int(g.integers(window))
            kind = int(g.integers(3))
            if kind == 0:
                row[at] = g.integers(1, 1 << 63)
            elif kind == 1:
                row[at + 1 :] = row[at:-1].copy()
                row[at] = g.integers(1, 1 << 63)
            else:
                row[at:-1] = row[at + 1 :].copy()
    return one, two


def walk_signatures(words: np.ndarray, start: np.ndarray, walk: Walk, chunk: int = 1 << 15) -> list[np.ndarray]:
    """One 64-bit signature for each repetition and window."""
    out = []
    odd = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for salt, samples in walk.repetitions:
            salted = ts.mix(words ^ np.uint64(salt)) if salt else words
            padded = np.append(salted, np.zeros(walk.window + 1, np.uint64))
            got = np.empty(len(start), np.uint64)
            for a in range(0, len(start), chunk):
                p = start[a : a + chunk].copy()
                end = p + walk.window
                sig = np.full(len(p), np.uint64(salt + 1))
                for t in range(max(samples) + 1):
                    v = padded[p]
                    if t >= walk.window:  # beyond the window the walk puts out a blank
                        v = np.where(p < end, v, np.uint64(0))
                    if t in samples:
                        sig = sig * odd + v
                    p = p + ((v >> np.uint64(t)) & np.uint64(1)).astype(np.int64)
                got[a : a + chunk] = ts.mix(sig)
            out.append(got)
    return out


def window_starts(text_of: np.ndarray, window: int) -> np.ndarray:
    """Word positions from which a whole window lies within one text."""
    if len(text_of) < window:
        return np.zeros(0, np.int64)
    return np.nonzero(text_of[: len(text_of) - window + 1] == text_of[window - 1 :])[0]


def prefix_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Edit distance of each row of a from the nearest prefix of the same row of b, all rows at once."""
    k = b.shape[1]
    row = np.tile(np.arange(k + 1, dtype=np.int16), (len(a), 1))
    for i in range(a.shape[1]):
        new = np.empty_like(row)
        new[:, 0] = i + 1
        np.minimum(row[:, :-1] + (b != a[:, i : i + 1]), row[:, 1:] + 1, out=new[:, 1:])
        for j in range(1, k + 1):
            np.minimum(new[:, j], new[:, j - 1] + 1, out=new[:, j])
        row = new
    return row.min(axis=1)


def neighbours(words: np.ndarray, bits: int) -> np.ndarray:
    """A hash of `bits` bits of each word and the one after it."""
    with np.errstate(over="ignore"):
        return (ts.mix(words[:-1] * np.uint64(3) + words[1:]) >> np.uint64(64 - bits)).astype(np.int64)


def promising(words: np.ndarray, start: np.ndarray, window: int, edits: int, pairs: np.ndarray) -> np.ndarray:
    """The windows of which all but two for each edit of the pairs of neighbouring words are in `pairs`."""
    if not len(start):
        return start
    n = np.zeros(len(words), np.int64)
    np.cumsum(pairs[neighbours(words, int(len(pairs)).bit_length() - 1)], out=n[1:])
    return start[n[start + window - 1] - n[start] >= window - 1 - 2 * edits]


class ItemIndex:
    """Signatures of all windows of a block of items."""

    FILTER = 22

    def __init__(self, ids: list, texts: list[str], walk: Walk) -> None:
        self.ids, self.walk = ids, walk
        self.words, item_of = word_hashes([unnumbered(plain(t or "")) for t in texts])
        self.length = np.bincount(item_of, minlength=len(ids))
        self.first = np.concatenate([[0], np.cumsum(self.length)[:-1]]).astype(np.int64)
        start = window_starts(item_of, walk.window)
        self.item_of = item_of
        self.pairs = np.zeros(1 << self.FILTER, bool)
        self.pairs[neighbours(self.words, self.FILTER)] = True
        self.tables = []
        for sig in walk_signatures(self.words, start, walk):
            order = np.argsort(sig, kind="stable")
            mask = np.zeros(1 << self.FILTER, bool)
            mask[(sig & np.uint64((1 << self.FILTER) - 1)).astype(np.int64)] = True
            self.tables.append((sig[order], start[order], mask))

    def candidates(self, signatures: list[np.ndarray], start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (window of the texts, window of an item) that share a signature; start: where the windows of the texts begin."""
        left, right = [], []
        for sig, (known, pos, mask) in zip(signatures, self.tables):
            if not len(known):
                continue
            may = np.nonzero(mask[(sig & np.uint64((1 << self.FILTER) - 1)).astype(np.int64)])[0]
            lo, hi = np.searchsorted(known, sig[may], "left"), np.searchsorted(known, sig[may], "right")
            n = hi - lo
            left.append(np.repeat(start[may], n))
            offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            right.append(pos[np.repeat(lo, n) + offset])
        if not left:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, b = np.concatenate(left), np.concatenate(right)
        if len(self.tables) > 1 and len(a):
            pair = np.unique(a * np.int64(len(self.words)) + b)
            a, b = pair // len(self.words), pair % len(self.words)
        return a, b

    def verified(self, words: np.ndarray, a: np.ndarray, b: np.ndarray, edits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pairs within `edits` edits, and whether they are equal."""
        k, chunk = self.walk.window, 1 << 16
        keep, same = np.zeros(len(a), bool), np.zeros(len(a), bool)
        padded = np.append(words, np.zeros(edits, np.uint64)) if edits else words
        for x in range(0, len(a), chunk):
            u, v = padded[a[x : x + chunk, None] + np.arange(k + edits)], self.words[b[x : x + chunk, None] + np.arange(k)]
            same[x : x + chunk] = (u[:, :k] == v).all(axis=1)
            keep[x : x + chunk] = same[x : x + chunk]
            if edits:
                rest = np.nonzero(~same[x : x + chunk])[0]
                # within e edits at least window - e words are aligned, up to e places off
                near = np.zeros(len(rest), np.int64)
                for d in range(-edits, edits + 1):
                    lo, hi = max(-d, 0), min(k, k + edits - d)
                    near += (u[rest, lo + d : hi + d] == v[rest, lo:hi]).sum(axis=1)
                rest = rest[near >= k - edits]
                keep[x + rest] = prefix_distances(v[rest], u[rest]) <= edits
        return a[keep], b[keep], same[keep]

    def coverage(self, text_of: np.ndarray, b: np.ndarray) -> dict[tuple[int, int], int]:
        """Words of the item covered by verified windows, of each (text, item); text_of: the text of each."""
        k, n_items = self.walk.window, len(self.ids)
        pair = text_of.astype(np.int64) * n_items + self.item_of[b]
        order = np.lexsort((b, pair))
        pair, b = pair[order], b[order]
        out = {}
        cuts = np.nonzero(np.diff(pair))[0] + 1
        for x, y in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(pair)]])):
            if y > x:
                step = np.diff(b[x:y])
                out[int(pair[x] // n_items), int(pair[x] % n_items)] = int(np.minimum(step, k).sum()) + k
        return out


def find_leaks(
    docs: DataFrame, items: DataFrame, window: int = 10, share: float = 1 / 3, edits: int = 0, recall: float = 0.95, doc_key: str = "doc_id", item_key: str = "item_id", pass_bytes: int = PASS_BYTES
) -> DataFrame:
    """(doc_key, item_key, matched_words, near_words, item_words): items of which at least `share` stands in a document.

    near_words are covered by windows of `window` words within `edits` edits of the document's, matched_words by equal ones.
    """
    spark = docs.sparkSession
    ship(spark)
    walk = make_walk(window, edits, recall)
    doc_kind, item_kind = dict(docs.dtypes)[doc_key], dict(items.dtypes)[item_key]
    rows = docs.select(F.col(doc_key).alias("k"), F.col("text").alias("t")).where("t is not null and length(t) > 0")
    schema = f"{doc_key} {doc_kind}, {item_key} {item_kind}, matched_words int, near_words int, item_words int"
    out = None
    for ids, texts in item_blocks(items, item_key, pass_bytes):
        sent = spark.sparkContext.broadcast((ids, texts))
        part = rows.mapInPandas(_scanner(sent, walk, share, edits, (doc_key, item_key)), schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def item_blocks(items: DataFrame, key: str, most_bytes: int) -> Iterator[tuple[list, list[str]]]:
    """The items in blocks of about `most_bytes` bytes, read one row at a time."""
    ids, texts, n = [], [], 0
    for r in items.select(F.col(key), F.col("text")).where("text is not null").toLocalIterator():
        ids.append(r[0])
        texts.append(r[1])
        n += 64 + len(r[1].encode("utf-8", "surrogatepass"))
        if n >= most_bytes:
            yield ids, texts
            ids, texts, n = [], [], 0
    if ids:
        yield ids, texts


def indexes(ids: list, texts: list[str], walk: Walk) -> list[ItemIndex]:
    """Indexes of at most BLOCK_WINDOWS windows each (counted by half the characters, so at least by words)."""
    out, start, n = [], 0, 0
    for i, t in enumerate(texts):
        if i > start and n + len(t) // 2 > BLOCK_WINDOWS:
            out.append(ItemIndex(ids[start:i], texts[start:i], walk))
            start, n = i, 0
        n += len(t) // 2
    return [*out, ItemIndex(ids[start:], texts[start:], walk)] if ids else out


_INDEXES: dict = {}


def _scanner(sent, walk: Walk, share: float, edits: int, names: tuple[str, str]):
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = (sent.value[0][:1], len(sent.value[0]), hash(tuple(sent.value[1])), walk)
        if _INDEXES.get("key") != repr(known):  # one worker keeps the indexes of one block of items from task to task
            at = indexes(*sent.value, walk)
            _INDEXES.update(key=repr(known), at=at, pairs=np.logical_or.reduce([x.pairs for x in at]))
        pairs = _INDEXES["pairs"]
        for batch in batches:
            keys, texts, got = batch["k"].to_numpy(), batch["t"].tolist(), []
            for x, y in ts.pieces(texts):
                words, text_of = word_hashes([unnumbered(plain(t)) for t in texts[x:y]])
                start = promising(words, window_starts(text_of, walk.window), walk.window, edits, pairs)
                signatures = walk_signatures(words, start, walk)
                for index in _INDEXES["at"]:
                    a, b, same = index.verified(words, *index.candidates(signatures, start), edits)
                    exact = index.coverage(text_of[a[same]], b[same])
                    for (t, i), n in index.coverage(text_of[a], b).items():
                        if n >= share * index.length[i] - 1e-9:
                            got.append((keys[x + t], index.ids[i], exact.get((t, i), 0), n, int(index.length[i])))
            yield pd.DataFrame(got, columns=[*names, "matched_words", "near_words", "item_words"])

    return scan
