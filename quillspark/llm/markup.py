"""Markup in text: conversion of marked-up sources to clean text, and residue left in cleaned text.

One pass sets fenced code and formulas aside (they are kept as they are), the
passes after it rewrite or report LaTeX, HTML, Markdown and wiki markup by
patterns that C++ text and file paths don't meet.  Suffix arrays of a host's
pages (`shared_runs`) find text that pages share, not markup, so they can't give
this result; README has their figures.

Defined results
  null text              null, no kinds
  empty text             empty, no kinds
  unclosed fence         code to the end of the text
  several kinds          a row for each kind
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.session import ship

KINDS = ("latex", "html", "markdown", "wiki")

# Commands without an argument.
_BARE = "pnum|item|par|ldots|dots|textbackslash|noindent|newline|linebreak|pagebreak|newpage|clearpage|bigskip|medskip|smallskip|hfill|vfill|quad|qquad|tt|bf|it|em|sc|rm|sf|textasciitilde|textasciicircum|textbar|textless|textgreater|verb|hline|centering|maketitle|tableofcontents|LaTeX|TeX|Cpp|CppXX|xspace|opt|unspec|UNSP|shl|shr|dcr|exor|bigoh|caret|bnfindent|br|glossary|effects|returns|remarks|requires|ensures|throws|complexity|mandates|constraints|expects|result|recommended|required|postconditions|preconditions|sync|implimits|default|small|footnotesize|tiny|large|Large|normalsize|tcode|keyword|S|P"
# Command names that no C++ text has before a brace.
_NAMED = "tcode|keyword|grammarterm|defn|defnx|defnadj|textit|texttt|textbf|textrm|textsc|emph|iref|indextext|indexlibrary|indexlibraryglobal|footnote|placeholder|placeholdernc|exposid|libconcept|libheader|doccite|libmember|mathit|mathtt|termref|nontermdef|ucode|unicode|textsubscript|textsuperscript|underline|nopnumdiffref"
# Entities of text (many others are words of code, as in `int &ref;`).
_ENTITIES = "amp|lt|gt|quot|apos|nbsp|mdash|ndash|hellip|lsquo|rsquo|ldquo|rdquo|bull|middot|times|shy|thinsp|ensp|emsp|laquo|raquo|sect|para|deg|euro|eacute|egrave|agrave|ccedil|auml|ouml|uuml|Auml|Ouml|Uuml|szlig|oslash|aring|ntilde|rarr|larr|harr"
# Element names of at least two letters (<map> is a header, and so is a bare <span>).
_ELEMENTS = "abbr|article|aside|big|blockquote|body|br|button|caption|center|cite|code|col|colgroup|dd|del|details|dfn|div|dl|dt|em|fieldset|figcaption|figure|font|footer|form|h[1-6]|head|header|hr|html|iframe|img|input|ins|kbd|label|li|link|main|mark|meta|nav|ol|pre|samp|script|section|small|span|strike|strong|style|sub|summary|sup|table|tbody|td|textarea|tfoot|th|thead|title|tr|tt|ul|var|wbr"
_LETTERS = "a|b|i|p|q|s|u"
# Attributes that stand in [[ ]].
_ATTRIBUTES = "nodiscard|noreturn|deprecated|fallthrough|maybe_unused|likely|unlikely|assume|no_unique_address|carries_dependency|indeterminate|optimize_for_synchronized"

_FENCE = re.compile(r"^[ \t]*(```+|~~~+)[^\n]*\n(?:.*?^[ \t]*\1[^\n]*$|.*\Z)", re.S | re.M)
_FORMULA = re.compile(r"(?<![\\$])\$\$.+?\$\$|(?<![\\$\w])\$(?=[^\s$])[^$\n]*(?<=[^\s\\])\$(?!\w)|(?<!\\)\$[^$\n]+\$", re.S)

_LATEX = re.compile(
    rf"\\(?:begin|end)\b|\\(?![uxoNU]\{{)[A-Za-z]+\d?\*?[ ]?[\[{{]|(?<![A-Za-z]:)(?<!\w)\\(?:{_BARE})(?![A-Za-z])(?!\\)"
    rf"|\w\\(?:ldots|dots|item|pnum|newline|par|xspace|textbackslash)(?![A-Za-z\\])|\\[_&%#${{}}]|\\\\(?=[ \t]*(?:\n|\Z))|\\\\\[\d"
    rf"|``[^`'\n]+''|\{{\\[a-z]{{2,}}\s|(?<![\w\\])(?:{_NAMED})\{{|\w~\\"
)
_HTML = re.compile(
    rf"<!--|-->|<!DOCTYPE|</(?:{_ELEMENTS}|{_LETTERS}|[A-Z])\s*>|<(?:{_ELEMENTS}|{_LETTERS})(?:\s+[\w:-]+\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]+))+\s*/?>"
    rf"|<(?!span\b)(?:{_ELEMENTS})\s*/?>|&(?:{_ENTITIES});|&#(?:\d{{1,7}}|[xX][0-9a-fA-F]{{1,6}});",
    re.I,
)
_HTML_LETTER = re.compile(rf"(?<![\w:>])<(?:{_LETTERS})\s*/?>")
_MARKDOWN = re.compile(
    r"(?<![\w*])\*{1,3}(?=[^\s*])[^*\n]+(?<=[^\s*])\*{1,3}(?![\w*])|(?<!\w)\*\*(?=[^\s*])[^*\n]+(?<=[^\s*])\*\*"
    r"|~~(?=\S)[^~\n]+~~|!\[[^\]\n]*\]\([^)\n]+\)|\[[^\]\n]+\]\(\s*(?:#|/|\./|\.\./|www\.|[a-zA-Z]+://|mailto:|[\w./-]+/[\w./-]+|[\w-]+\.(?:md|html?|pdf|svg|png))[^)\s]*(?:\s+\"[^\"]*\")?\s*\)"
    r"|(?<!`)`(?!`)[^`\n]+(?<!`)`(?!`)|^#{2,6}[ \t]+\S|^[ \t]*>+[ \t]|^[*+][ \t]+\S|^\|.*\|[ \t]*$|^[ \t]*(?:\*{3,}|-{3,}|_{3,}|={3,})[ \t]*$|\[\^\w+\]"
    r"|(?<![\w\\])_(?=[a-z]{3,})[a-z][a-z -]*[a-z]_(?!\w)|(?<![\w\\])__(?=[a-z])[a-z]+ [a-z ]*[a-z]__(?!\w)|<https?://[^>\s]+>",
    re.M,
)
_WIKI = re.compile(
    rf"\[\[(?!\s*(?:using\s+\w+\s*:\s*)?(?:{_ATTRIBUTES}|\w+::\w+)\b)[^\[\]\n]*[A-Za-z][^\[\]\n]*\]\]|(?<!\w)\{{\{{\s*[A-Za-z#][^{{}}\n,]*(?:\|[^{{}}\n]*)?\}}\}}|\{{\{{[^{{}}\n]*\|[^{{}}\n]*\}}\}}"
    r"|(?<![`'\w])'{2,5}(?=[^'\s])[^'\n]*[^'\s]'{2,5}(?!')|^[ \t]*={2,6}[ \t]*[^=\s][^=\n]*={2,6}[ \t]*$|(?<!\])\[(?:https?|ftp)://[^\s\]]+(?:\s[^\]\n]*)?\](?!\()"
    r"|<(?:ref|nowiki|gallery|references)\b[^>]*>|^\{\||^\|[-}]|__(?:TOC|NOTOC|NOEDITSECTION)__|~~~~|^#REDIRECT\b",
    re.M,
)


def _masked(text: str) -> str:
    return _FORMULA.sub(" ", _FENCE.sub("\n", text))


def residue(text: str | None) -> list[str]:
    """Kinds of markup that a cleaned text still holds."""
    if not text:
        return []
    t = _masked(text.replace("\r\n", "\n"))
    out = []
    if ("\\" in t or "`" in t or "{" in t) and _LATEX.search(t):
        out.append("latex")
    if ("<" in t or "&" in t or "-->" in t) and (_HTML.search(t) or _HTML_LETTER.search(t)):
        out.append("html")
    quiet = re.sub(r"``[^`'\n]+''", " ", t)
    if _MARKDOWN.search(re.sub(r"<!--|-->", " ", quiet)):
        out.append("markdown")
    if _WIKI.search(quiet):
        out.append("wiki")
    return out


# ---------------------------------------------------------------- conversion

# Environments of source text and what opens and closes them in clean text.
_CODE_ENV = "codeblock|codeblocktu|outputblock|verbatim|lstlisting|bnf|ncbnf|ncsimplebnf|itemdecl"
_NOTE_ENV = {"note": "Note", "example": "Example", "defnote": "Note"}


class _Kept:
    """Parts that no later pass may touch; the marks that stand for them don't occur in the text."""

    def __init__(self, text: str) -> None:
        used = set(text)
        free = (c for c in map(chr, chain(range(0xE000, 0xF900), range(0xF0000, 0xFFFFE), range(0x100000, 0x10FFFE))) if c not in used)
        self.open, self.close = next(free), next(free)
        self.mark = re.compile(f"{self.open}(\\d+){self.close}")
        self.parts: list[str] = []

    def put(self, s: str) -> str:
        self.parts.append(self.back(s))  # marks in it are of earlier parts, which have none left
        return f"{self.open}{len(self.parts) - 1}{self.close}"

    def back(self, t: str) -> str:
        return self.mark.sub(lambda m: self.parts[int(m.group(1))], t) if self.open in t else t


_BRACE = re.compile(r"(?<!\\)[{}]")


def _groups(t: str) -> dict[int, int]:
    """Where each group in braces that is closed opens and closes."""
    out, open_ = {}, []
    for m in _BRACE.finditer(t):
        if m.group() == "{":
            open_.append(m.start())
        elif open_:
            out[open_.pop()] = m.start()
    return out


_DROPPED = re.compile(r"\\(?:index\w*|label|vspace|hspace|pagestyle|thispagestyle|addtocounter|setcounter|input|include|enlargethispage|footnote(?:mark|text)?|rSecindex)\*?\s*\{")
_COMMAND = re.compile(r"\\([A-Za-z]+)\*?\s*(\[[^\]\n]*\])?\{")
_REFERENCE = {"ref", "iref", "cite", "eqref", "autoref", "tref", "fref", "pref"}
_HEADING = re.compile(r"\\(?:rSec\d|chapter|section|subsection|subsubsection|paragraph|infannex|normannex)\*?\s*(?:\[([^\]]*)\])?\s*\{")


def _each_group(t: str, pattern: re.Pattern, put) -> str:
    """The text with each command that `pattern` finds and its group replaced by put(what is in the group, or None if it isn't closed)."""
    ends, out, i = _groups(t), [], 0
    while m := pattern.search(t, i):
        e = ends.get(m.end() - 1)
        out += [t[i : m.start()], put(None if e is None else t[m.end() : e])]
        i = m.end() if e is None else e + 1
        if e is not None and pattern is _DROPPED and t[i : i + 1] == "%":
            i += 1
    return "".join([*out, t[i:]])


def _commands(t: str) -> str:
    """Commands with an argument replaced by it, at any depth; some are dropped, and references get brackets."""
    t = _each_group(t, _DROPPED, lambda _: "")
    ends, out, todo = _groups(t), [], [(0, len(t))]
    while todo:
        i, stop = todo.pop()
        m = _COMMAND.search(t, i, stop)
        if not m:
            out.append(t[i:stop])
            continue
        out.append(t[i : m.start()])
        e = ends.get(m.end() - 1, stop)
        if e >= stop:
            todo.append((m.end(), stop))
            continue
        todo.append((e + 1, stop))
        if m.group(1) not in _REFERENCE:
            todo.append((m.end(), e))
            continue
        before = next((x for x in reversed(out) if x), "")
        out.append(" " * (m.group(1) == "iref" and before[-1:].isalnum()) + ", ".join(f"[{x.strip()}]" for x in t[m.end() : e].split(",")))
    return "".join(out)


def clean(text: str | None) -> str | None:
    """Clean text of a LaTeX source in which HTML, Markdown and wiki markup may stand: headings, lists, code and formulas are kept."""
    if not text:
        return text
    t, kept = text.replace("\r\n", "\n"), _Kept(text)
    t = _FENCE.sub(lambda m: kept.put(m.group()), t)
    t = re.sub(rf"\\begin\{{({_CODE_ENV})\}}(?:\[[^\]]*\])?[ \t]*\n?(.*?)\n?[ \t]*\\end\{{\1\}}", lambda m: kept.put(f"```cpp\n{m.group(2)}\n```"), t, flags=re.S)
    t = re.sub(r"<pre[^>]*>\s*(?:<code[^>]*>)?(.*?)(?:</code>)?\s*</pre>", lambda m: kept.put(f"```cpp\n{html.unescape(m.group(1))}\n```"), t, flags=re.S | re.I)
    t = _FORMULA.sub(lambda m: kept.put(m.group()), t)
    t = re.sub(r"(?<!\\)%[^\n]*$", "", t, flags=re.M)
    t = re.sub(r"<!--.*?-->", "", t, flags=re.S)
    # notes, lists, headings
    for env, name in _NOTE_ENV.items():
        t = re.sub(rf"\\begin\{{{env}\}}\s*(.*?)\s*\\end\{{{env}\}}", lambda m, n=name: f"[{n}: {m.group(1)} --end {n.lower()}]", t, flags=re.S)
    t = _lists(t)
    t = _each_group(t, _HEADING, lambda title: f"# {title or ''}")
    t = re.sub(r"^[ \t]*<h[1-6][^>]*>(.*?)</h[1-6]>[ \t]*$", r"# \1", t, flags=re.M | re.I)
    t = re.sub(r"^[ \t]*(={2,6})[ \t]*([^=\n]+?)[ \t]*\1[ \t]*$", r"# \2", t, flags=re.M)
    t = re.sub(r"^#{1,6}[ \t]+(.*?)[ \t]*#*[ \t]*$", r"# \1", t, flags=re.M)
    t = re.sub(r"^[*+][ \t]+(?=\S)", "- ", t, flags=re.M)
    # LaTeX
    t = re.sub(r"``([^`'\n]*)''", r'"\1"', t)
    t = re.sub(r"\\(?:begin|end)\{[^}\n]*\}(?:\[[^\]\n]*\])?", "", t)
    t = re.sub(r"\\textbackslash(?:\{\})?[ ]?", lambda _: kept.put("\\"), t)
    t = re.sub(r"\\([_&%#${}])", lambda m: kept.put(m.group(1)), t)
    t = _commands(t)
    t = re.sub(r"^[ \t]*\\pnum[ \t]*\n?", "", t, flags=re.M)
    t = re.sub(r"\\(?:ldots|dots)(?:\{\})?", "...", t)
    t = re.sub(r"\\\\(?:\[[^\]\n]*\])?(?=[ \t]*(?:\n|\Z))", "", t)
    t = re.sub(r"\{\\[a-z]{2,}\s+([^{}]*)\}", r"\1", t)
    t = re.sub(rf"\\(?:{_BARE})(?![A-Za-z])[ ]?", "", t)
    t = re.sub(rf"(?<=\w)~(?=[\w\[{kept.open}])", " ", t)
    # HTML, wiki, Markdown
    t = re.sub(r"<br\s*/?>", "\n", t, flags=re.I)
    t = re.sub(r"^[ \t]*<li[^>]*>(.*?)(?:</li>)?[ \t]*$", r"- \1", t, flags=re.M | re.I)
    t = re.sub(rf"</?(?:{_ELEMENTS}|{_LETTERS})(?:\s+[\w:-]+\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]+))*\s*/?>", lambda m: m.group() if m.group() == "<span>" or not (_HTML.match(m.group()) or m.group()[1:2].islower()) else "", t, flags=re.I)
    t = re.sub(rf"&(?:{_ENTITIES});|&#(?:\d+|[xX][0-9a-fA-F]+);", lambda m: html.unescape(m.group()), t)
    t = re.sub(rf"\[\[(?!\s*(?:{_ATTRIBUTES}|\w+::\w+)\b)(?:[^\[\]\n|]*\|)?([^\[\]\n|]*)\]\]", r"\1", t)
    t = re.sub(r"\{\{[A-Za-z][^{}|\n,]*\|([^{}\n]*)\}\}", r"\1", t)
    t = re.sub(r"\[(?:https?|ftp)://[^\s\]]+\s([^\]\n]*)\]", r"\1", t)
    t = re.sub(r"(?<![\w'])'{2,5}(?=[^'\s])([^'\n]*[^'\s])'{2,5}(?!')", r"\1", t)
    t = re.sub(r"!?\[([^\]\n]+)\]\((?:#|/|\./|[a-zA-Z]+://|mailto:|[\w./-]+/)[^)\s]*\)", r"\1", t)
    t = re.sub(r"(?<![\w*])(\*{1,3})(?=[^\s*])([^*\n]+?)(?<=[^\s*])\1(?![\w*])", r"\2", t)
    t = re.sub(r"~~(?=\S)([^~\n]+)~~", r"\1", t)
    t = re.sub(r"(?<!`)`(?!`)([^`\n]+)`(?!`)", r"\1", t)
    t = re.sub(r"^[ \t]*>[ \t]", "", t, flags=re.M)
    t = re.sub(r"[ \t]+$", "", t, flags=re.M)
    t = re.sub(r"\n{3,}", "\n\n", t).strip("\n")
    return kept.back(t)


def _lists(t: str) -> str:
    """Items of list environments as lines with a mark or a number."""
    out, stack = [], []
    for line in t.split("\n"):
        if m := re.match(r"\s*\\begin\{(itemize|enumerate|description)\}", line):
            stack.append([m.group(1), 0])
            continue
        if re.match(r"\s*\\end\{(itemize|enumerate|description)\}", line):
            if stack:
                stack.pop()
            continue
        if stack and (m := re.match(r"\s*\\item\s*(?:\[([^\]]*)\]\s*)?", line)):
            stack[-1][1] += 1
            mark = f"{stack[-1][1]}. " if stack[-1][0] == "enumerate" else "- "
            line = mark + (f"{m.group(1)}: " if m.group(1) else "") + line[m.end() :]
        out.append(line)
    return "\n".join(out)


# ---------------------------------------------------------------- operators


def find_residue(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, kind) for each kind of markup that a text still holds."""
    ship(df.sparkSession)

    def kinds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [(k, x) for k, t in zip(b["k"], b["t"]) for x in residue(t)]
            yield pd.DataFrame(got, columns=[key, "kind"])

    rows = df.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t is not null")
    return rows.mapInPandas(kinds, f"{key} {dict(df.dtypes)[key]}, kind string").distinct()


def clean_texts(df: DataFrame, key: str, raw: str, cleaned: str) -> DataFrame:
    """(key, clean_text, residue): clean text of `raw`, and the kinds of markup in `cleaned`, as it was."""
    ship(df.sparkSession)

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({key: b["k"], "clean_text": [clean(t) for t in b["r"]], "residue": [residue(t) for t in b["t"]]})

    rows = df.select(F.col(key).alias("k"), F.col(raw).alias("r"), F.col(cleaned).alias("t"))
    return rows.mapInPandas(convert, f"{key} {dict(df.dtypes)[key]}, clean_text string, residue array<string>")
