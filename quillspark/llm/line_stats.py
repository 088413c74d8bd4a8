"""Statistics of lines, blocks and whole texts, by array operations over batches of texts."""

from __future__ import annotations

import functools
import unicodedata

import numpy as np

from quillspark.llm import textscan as ts

# Character classes of the line counts.
CLASSES = ("lower", "upper", "digit", "blank", "tab", "pipe", "comma", "semicolon", "ampersand", "angle", "brace", "colon", "stop", "mark", "symbol", "letter", "strange", "other")
_K = {c: i for i, c in enumerate(CLASSES)}
_TEXT_MARKS = "'\"()[]-`_/!?“”‘’„«»…–—• "
# Letters and signs that UTF-8 read as a one-byte encoding consists of.
_MOJIBAKE = "ÃÂâ€�"

# Words of the runs by which repetition is seen where nothing separates it.
WINDOW = 5

BLANK, PLAIN, LIST, TABLE, JUNK = range(5)

#: Shares of the visible characters that the rules for lines call text, list, table or junk.
SHARES = ("plain_share", "list_share", "table_share", "junk_share")
#: Document statistics that no rule for lines enters, in this order.
MEASURES = (
    "words", "mean_word", "symbol_ratio", "digit_ratio", "upper_ratio", "blank_ratio", "strange_ratio", "lines", "mean_line",
    "end_mark_ratio", "common_ratio", "bullet_share", "repeat_share", "long_word_share", "words_line", "short_line_share", "distinct_lines", "odd_inside",
    "pipe_ratio", "tab_ratio", "tight_comma_ratio", "gap_ratio", "ampersand_ratio", "cell_ratio", "brace_ratio", "semicolon_ratio",
    "sentence_chars", "wordless_chars", "bullet_chars", "delimited_chars", "unspaced_chars", "odd_chars", "short_chars", "again_chars", "runs_on",
)
FEATURES = (*MEASURES, *SHARES)


@functools.cache
def class_table() -> np.ndarray:
    out = np.full(0x10000, _K["other"], np.uint8)
    single = {" ": "blank", "\t": "tab", "|": "pipe", ",": "comma", ";": "semicolon", "&": "ampersand", "<": "angle", ">": "angle", "{": "brace", "}": "brace", ":": "colon", ".": "stop"}
    for i in range(0x10000):
        c = chr(i)
        cat = unicodedata.category(c)
        if c in single:
            k = single[c]
        elif c in _MOJIBAKE:
            k = "strange"
        elif c in _TEXT_MARKS:
            k = "mark"
        elif i < 128 and c.islower():
            k = "lower"
        elif i < 128 and c.isupper():
            k = "upper"
        elif cat[0] == "N":
            k = "digit"
        elif cat[0] in "LM":
            k = "letter"
        elif c.isspace():
            k = "blank"
        elif i < 128 and i > 32:
            k = "symbol"
        elif cat[0] in "SPC":
            k = "strange"
        else:
            k = "other"
        out[i] = _K[k]
    return out


def common_hashes(words: list[str]) -> np.ndarray:
    codes, starts = ts.code_points([w.lower() for w in words])
    return np.unique(ts.run_hashes(codes, starts[:-1], starts[1:] - 1))


def _sum_by(index: np.ndarray, n: int, weight: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(index, weights=weight, minlength=n).astype(np.float64)


def _repeated(codes: np.ndarray, first: np.ndarray, last: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """How often each run occurs in its text."""
    if not len(first):
        return np.zeros(0, np.int64)
    h = ts.run_hashes(codes, first, np.maximum(last, first)) ^ ts.mix(text_of.astype(np.uint64) + np.uint64(17))
    _, back, n = np.unique(h, return_inverse=True, return_counts=True)
    return n[back]


class Scan:
    """Lines of a piece of a batch, their counts and kinds."""

    def __init__(self, texts: list[str], common: np.ndarray) -> None:
        codes, starts = ts.code_points(texts)
        self.n_texts, self.codes = len(texts), codes
        cls = ts.lookup(class_table(), codes, lambda c: _K["letter"] if c.isalpha() else _K["strange"])
        brk = codes == 10
        brk[starts[1:] - 1] = True
        ends = np.nonzero(brk)[0]
        first = np.concatenate([[0], ends[:-1] + 1])
        self.first, self.end = first, ends
        n = len(ends)
        line_of = np.repeat(np.arange(n), ends - first + 1)
        self.text_of = np.searchsorted(starts, first, side="right") - 1
        k = len(CLASSES)
        key = line_of * k + cls
        key = key[~brk]
        self.count = np.bincount(key, minlength=n * k).reshape(n, k).astype(np.float64)
        self.length = (ends - first).astype(np.float64)
        self.visible = self.length - self.count[:, _K["blank"]] - self.count[:, _K["tab"]]
        self._edges(cls, brk)
        self._words(cls, line_of, common)
        self._inside(cls, line_of, n)
        self._segments(brk, starts)
        self._windows(cls, line_of, starts)
        self.kind = self._kinds()

    def c(self, name: str) -> np.ndarray:
        return self.count[:, _K[name]]

    def _edges(self, cls: np.ndarray, brk: np.ndarray) -> None:
        solid = np.nonzero((cls != _K["blank"]) & (cls != _K["tab"]) & ~brk)[0]
        n, last_code = len(self.first), len(self.codes) - 1
        if not len(solid):
            self.empty = np.ones(n, bool)
            self.head = self.tail = self.indent = np.zeros(n, np.int64)
            self.bullet = self.number = np.zeros(n, bool)
            return
        lo = np.searchsorted(solid, self.first)
        hi = np.searchsorted(solid, self.end) - 1
        self.empty = hi < lo
        p = solid[np.minimum(lo, len(solid) - 1)]
        q = solid[np.maximum(hi, 0)]
        at = lambda d: self.codes[np.minimum(p + d, last_code)]
        c0, c1, c2, c3 = at(0), at(1), at(2), at(3)
        self.head, self.tail = np.where(self.empty, 0, c0), np.where(self.empty, 0, self.codes[q])
        self.indent = np.where(self.empty, 0, p - self.first)
        box = (c0 == 91) & (c2 == 93) & (c3 == 32)
        self.bullet = ~self.empty & ((np.isin(c0, [45, 42, 43, 0x2022, 0x25E6, 0x25AA, 0x2023, 0xB7, 0x2013]) & (c1 == 32)) | box)
        d0, d1 = (c0 >= 48) & (c0 <= 57), (c1 >= 48) & (c1 <= 57)
        d2 = (c2 >= 48) & (c2 <= 57)
        dot = lambda c: (c == 46) | (c == 41)
        self.number = ~self.empty & d0 & ((dot(c1) & (c2 == 32)) | (d1 & dot(c2) & (c3 == 32)) | (d1 & d2 & dot(c3)))

    def _words(self, cls: np.ndarray, line_of: np.ndarray, common: np.ndarray) -> None:
        low = ts.lookup(ts.char_table("lower"), self.codes, ord)
        letter = (cls == _K["lower"]) | (cls == _K["upper"]) | (cls == _K["letter"]) | (self.codes == 39) | (self.codes == 0x2019)
        step = np.diff(letter.astype(np.int8), prepend=0, append=0)
        a, b = np.nonzero(step == 1)[0], np.nonzero(step == -1)[0]
        n = len(self.first)
        w_line = line_of[a]
        size = b - a
        self.words = _sum_by(w_line, n)
        self.word_chars = _sum_by(w_line, n, size)
        self.long_chars = _sum_by(w_line, n, np.where(size > 24, size, 0))
        if len(a) and len(common):
            h = ts.run_hashes(low, a, b)
            k = np.minimum(np.searchsorted(common, h), len(common) - 1)
            self.common = _sum_by(w_line, n, common[k] == h)
        else:
            self.common = np.zeros(n)

    def _inside(self, cls: np.ndarray, line_of: np.ndarray, n: int) -> None:
        codes = self.codes
        nxt, prev = np.append(codes[1:], 10), np.append(10, codes[:-1])
        gap = np.nonzero((codes == 32) & (nxt == 32) & (prev != 32) & (prev != 10))[0]
        self.gaps = _sum_by(line_of[gap], n)
        tight = np.nonzero((codes == 44) & (nxt != 32) & (nxt != 10) & (nxt != 13))[0]
        self.tight_commas = _sum_by(line_of[tight], n)
        after = np.append(nxt[1:], 10)
        cell = np.nonzero((codes == 60) & (nxt == 116) & np.isin(after, [100, 104, 114]))[0]
        self.cells = _sum_by(line_of[cell], n)
        # digits and symbols between letters, as in scrambled text
        letter = (cls == _K["lower"]) | (cls == _K["upper"])
        odd = (cls == _K["symbol"]) | (cls == _K["digit"]) | (cls == _K["pipe"]) | (cls == _K["semicolon"]) | np.isin(codes, [33, 63])
        within = np.nonzero(odd[1:-1] & letter[:-2] & letter[2:])[0] + 1 if len(codes) > 2 else np.zeros(0, np.int64)
        self.odd = _sum_by(line_of[within], n)

    def _segments(self, brk: np.ndarray, starts: np.ndarray) -> None:
        """Characters of each line in clauses or lines that occur four times or more in the text."""
        codes = self.codes
        cut = brk | ((codes == 32) & np.isin(np.append(10, codes[:-1]), [33, 44, 46, 59, 63]))
        ends = np.nonzero(cut)[0]
        first = np.concatenate([[0], ends[:-1] + 1])
        last = ends.copy()
        ret = (last > first) & (codes[np.maximum(last - 1, 0)] == 13)
        last[ret] -= 1
        size = last - first
        ok = size >= 10
        first, last, size = first[ok], last[ok], size[ok]
        text_of = np.searchsorted(starts, first, side="right") - 1
        n = _repeated(codes, first, last, text_of)
        line = np.searchsorted(self.first, first, side="right") - 1
        self.repeat = _sum_by(line, len(self.first), np.where(n >= 4, size, 0))

    def _windows(self, cls: np.ndarray, line_of: np.ndarray, starts: np.ndarray) -> None:
        """Share of each line's word characters in runs of words that occur four times or more, in texts that mostly consist of such runs."""
        low = ts.lookup(ts.char_table("lower"), self.codes, ord)
        step = np.diff(np.isin(cls, [_K["lower"], _K["upper"], _K["letter"], _K["digit"]]).astype(np.int8), prepend=0, append=0)
        a, b = np.nonzero(step == 1)[0], np.nonzero(step == -1)[0]
        n, m = len(self.first), len(a) - WINDOW + 1
        self.again = np.zeros(n)
        if m < 1:
            return
        words, text_of = ts.run_hashes(low, a, b), np.searchsorted(starts, a, side="right") - 1
        h = ts.mix(text_of[:m].astype(np.uint64) + np.uint64(17))
        for k in range(WINDOW):
            h = ts.mix(h ^ words[k : k + m])
        whole = text_of[:m] == text_of[WINDOW - 1 :]
        at, h = np.nonzero(whole)[0], h[whole]
        _, back, times = np.unique(h, return_inverse=True, return_counts=True)
        times = times[back]
        # if half of the windows occur four times or more, at most 1/2 + 1/2 * 1/4 of them are distinct
        every, distinct = _sum_by(text_of[at], self.n_texts), _sum_by(text_of[at], self.n_texts, 1 / times)
        over = at[(times >= 4) & (distinct <= 0.625 * every)[text_of[at]]]
        inside = np.zeros(len(a), bool)
        for k in range(WINDOW):
            inside[over + k] = True
        size = b - a
        self.again = _sum_by(line_of[a], n, size * inside) / np.maximum(_sum_by(line_of[a], n, size), 1)

    def _kinds(self) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return self._kinds_of_lines()

    def _kinds_of_lines(self) -> np.ndarray:
        length, vis = self.length, np.maximum(self.visible, 1)
        share = lambda *names: sum(self.c(x) for x in names) / vis
        kind = np.full(len(length), PLAIN)
        letters = share("lower", "upper", "letter")
        common = self.common / np.maximum(self.words, 1)
        # tables: cells in a row
        jumbled = self.odd / np.maximum(self.words, 1)
        pipe = (self.c("pipe") >= 2) & ((self.head == 124) | ((self.c("pipe") >= 3) & (jumbled <= 0.1)))
        tab = self.c("tab") - np.minimum(self.indent, self.c("tab")) >= 2
        csv = (self.tight_commas >= 2) & (self.tight_commas >= 0.6 * self.c("comma")) & (self.c("blank") <= 0.35 * length)
        csv &= jumbled <= 0.1
        aligned = (self.gaps >= 2) & (jumbled <= 0.1)
        latex = (self.c("ampersand") >= 1) & (self.tail == 92)
        tags = (self.cells >= 1) & (jumbled <= 0.1)
        kind[pipe | tab | csv | aligned | latex | tags] = TABLE
        # lists: short entries
        entry = (self.bullet | self.number) & (length <= 160) & (self.words >= 1)
        kind[entry & ~aligned & ~tab & ~pipe] = LIST
        index = (self.c("digit") >= 1) & (self.words >= 1) & (self.words <= 4) & (self.c("comma") >= 1) & (common < 0.3) & (length <= 80) & ~csv
        kind[index & (self.c("digit") + self.c("comma") >= 0.2 * vis)] = LIST
        run = (self.c("semicolon") >= 4) & (length / (self.c("semicolon") + 1) <= 48) & (common < 0.2) & (letters > 0.8) & (jumbled <= 0.1)
        kind[run] = LIST
        # junk: nothing readable
        spaced = self.c("blank") / np.maximum(length, 1)
        noise = (length >= 20) & (share("symbol", "brace", "angle", "pipe", "semicolon", "ampersand", "colon") + share("digit") > 0.45) & (letters < 0.5) & ~(pipe & (self.head == 124)) & ~tab & ~csv & ~tags & ~latex & ~aligned & ~index
        # cell marks by chance: too many other signs
        noise |= (length >= 20) & (share("symbol", "brace", "angle", "semicolon", "ampersand") > 0.25) & (letters < 0.45) & ~tags & ~latex
        hexes = (length >= 20) & (self.c("blank") >= 6) & (vis >= 1.5 * (self.c("blank") + 1)) & (vis <= 4 * (self.c("blank") + 1)) & (share("digit") > 0.3) & (self.c("upper") == 0) & (share("lower", "digit") > 0.95)
        packed = (length >= 30) & (spaced < 0.02) & (self.c("tab") == 0) & ~csv & ~pipe & ~tags & (self.words >= 1)
        packed &= (share("digit") > 0.02) | (self.long_chars > 0.3 * vis) | (self.c("upper") > 0.15 * vis) | (self.c("brace") >= 2)
        style = (self.c("brace") >= 2) & (self.c("colon") + self.c("semicolon") >= 3) & (spaced < 0.1)
        mojibake = (length >= 8) & (share("strange") > 0.15)
        jumble = (length >= 30) & (jumbled > 0.1) & (common < 0.3) & ~pipe & ~tab & ~csv & ~tags
        glued = (length >= 30) & (self.long_chars > 0.5 * vis)
        salad = (length >= 60) & (self.words >= 8) & (common < np.where(self.words >= 20, 0.12, 0.04)) & ~entry & (letters > 0.8) & ~run & (kind == PLAIN)
        junk = noise | hexes | packed | style | mojibake | jumble | glued | salad
        kind[junk] = JUNK
        kind[(self.repeat > 0.5 * np.maximum(length - 1, 1))] = JUNK
        # entries and rows may share words, running text that consists of the same words does not
        phrase = (kind == PLAIN) & (self.again > 0.5)
        kind[phrase] = JUNK
        self.repeat = np.where(phrase, np.maximum(self.repeat, self.again * self.visible), self.repeat)
        kind[self.empty] = BLANK
        self._plain_blocks(kind, common)
        return kind

    def _runs_on(self) -> np.ndarray:
        """Lines that don't end a sentence and are followed by a small letter."""
        out = np.zeros(len(self.length), bool)
        if len(out) > 1:
            tail, head = self.tail[:-1], self.head[1:]
            out[:-1] = ~np.isin(tail, [46, 33, 63, 58, 59, 0]) & (((head >= 97) & (head <= 122)) | np.isin(head, [96, 40])) & (self.text_of[1:] == self.text_of[:-1])
        return out

    def _plain_blocks(self, kind: np.ndarray, common: np.ndarray) -> None:
        """Blocks of short plain lines are lists if they hold few common words and do not run on."""
        n = len(kind)
        # numbered or bulleted lines that are sentences stay text
        sentence = (kind == LIST) & (self.words >= 12) & (common > 0.3) & ~((self.c("semicolon") >= 4))
        kind[sentence] = PLAIN
        short = (kind == PLAIN) & (self.length <= 100)
        new = np.ones(n, bool)
        if n > 1:
            new[1:] = (short[1:] != short[:-1]) | (self.text_of[1:] != self.text_of[:-1])
        block = np.cumsum(new) - 1
        m = block[-1] + 1 if n else 0
        lines = _sum_by(block, m, short)
        words = _sum_by(block, m, self.words * short)
        hits = _sum_by(block, m, self.common * short)
        size = words / np.maximum(lines, 1)
        few = hits / np.maximum(words, 1)
        listed = (lines >= 3) & (size <= 9.5) & (few < 0.26)
        kind[short & listed[block]] = LIST
        wordless = short & (few[block] < 0.03) & (words[block] >= 25) & (size[block] > 9.5)
        kind[wordless] = JUNK

    def features(self) -> np.ndarray:
        t, n = self.text_of, self.n_texts
        by = lambda w: _sum_by(t, n, w)
        vis = np.maximum(by(self.visible), 1)
        words, solid = by(self.words), by((~self.empty).astype(float))
        of = lambda k: by(self.visible * (self.kind == k)) / vis
        chars = lambda lines: by(self.visible * (lines & ~self.empty)) / vis
        ended = np.isin(self.tail, [46, 33, 63, 58, 34, 39, 41, 0x201D]) & ~self.empty
        uniq = _repeated(self.codes, self.first, self.end, t)
        one = lambda a, b: a / np.maximum(b, 1)
        common, each = self.common / np.maximum(self.words, 1), np.maximum(self.visible, 1)
        marks = self.c("pipe") + self.c("tab") + self.tight_commas + self.gaps + self.c("ampersand") + self.cells
        cols = [
            words, one(by(self.word_chars), words), by(self.c("symbol") + self.c("brace") + self.c("angle") + self.c("pipe") + self.c("semicolon")) / vis,
            by(self.c("digit")) / vis, by(self.c("upper")) / vis, one(by(self.c("blank")), by(self.length)), by(self.c("strange")) / vis,
            solid, one(by(self.length), solid), one(by(ended), solid), one(by(self.common), words), one(by(self.bullet | self.number), solid),
            by(np.minimum(self.repeat, self.visible)) / vis, by(self.long_chars) / vis, one(words, solid), one(by((self.length < 60) & ~self.empty), solid),
            one(by(~self.empty / np.maximum(uniq, 1)), solid), one(by(self.odd), words),
            by(self.c("pipe")) / vis, by(self.c("tab")) / vis, by(self.tight_commas) / vis, by(self.gaps) / vis, by(self.c("ampersand")) / vis, by(self.cells) / vis,
            by(self.c("brace")) / vis, by(self.c("semicolon")) / vis,
            chars((common >= 0.25) & (self.words >= 4)), chars(common < 0.05), chars(self.bullet | self.number), chars(marks >= 2),
            chars(self.c("blank") < 0.03 * self.length), chars(self.odd > 0.1 * self.words), chars(self.length < 60), chars(self.repeat > 0.5 * each), one(by(self._runs_on()), solid),
            of(PLAIN), of(LIST), of(TABLE), of(JUNK),
        ]
        return np.stack(cols, axis=1)


def text_features(texts: list[str], common: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text."""
    out = np.zeros((len(texts), len(FEATURES)))
    for a, b in ts.pieces(texts):
        out[a:b] = Scan(texts[a:b], common).features()
    return out
