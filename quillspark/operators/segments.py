"""Markdown taken apart: front matter, sections, paragraphs, fences, pipe tables, chunks, blocks.

The functions on one text are plain Python; the DataFrame operators below run
them over Arrow batches of whole documents, which never leave their partition.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.session import ship

_FENCE = re.compile(r"^\s*(```+|~~~+)\s*([\w+#.-]*)")
_HEAD = re.compile(r"^(#{1,6})\s+(.*?)\s*#*\s*$")


def front_matter(text: str) -> tuple[dict[str, str], str]:
    """(fields, body); a block between --- lines at the very start, scalar lines only."""
    lines = text.replace("\r\n", "\n").split("\n")
    if lines[:1] != ["---"]:
        return {}, text
    for k in range(1, len(lines)):
        if lines[k] in ("---", "..."):
            out: dict[str, str] = {}
            last = ""
            for line in lines[1:k]:
                if m := re.match(r"^([\w-]+):\s*(.*)$", line):
                    last = m.group(1)
                    out[last] = m.group(2).strip().strip("\"'")
                elif last and (m := re.match(r"^\s*-\s+(.*)$", line)):
                    out[last] = ", ".join(filter(None, [out[last], m.group(1).strip().strip("\"'")]))
            return out, "\n".join(lines[k + 1 :])
    return {}, text


# Order of the front matter's fields.
FIELD_ORDER = ("title", "document", "date", "intent", "audience", "reply-to")


def format_front_matter(fields: dict[str, str]) -> str:
    """Fields in their fixed order, the rest after them; blank ones are left out."""
    names = [f for f in FIELD_ORDER if f in fields] + [f for f in fields if f not in FIELD_ORDER]
    body = [f'{n}: "{v}"' if re.search(r"[:#\[\]{}\",&*!|>'%@`]", v) else f"{n}: {v}" for n in names if (v := str(fields[n]).strip())]
    return "\n".join(["---", *body, "---"]) if body else ""


def fenced_lines(lines: list[str]) -> list[bool]:
    """Whether each line belongs to a fenced block, fences included."""
    out, mark = [], ""
    for line in lines:
        m = _FENCE.match(line)
        if mark:
            out.append(True)
            if m and m.group(1)[0] == mark[0] and len(m.group(1)) >= len(mark) and not m.group(2):
                mark = ""
        else:
            out.append(bool(m))
            if m:
                mark = m.group(1)
    return out


def code_blocks(text: str) -> list[tuple[int, str, str]]:
    """(first line from 1, language, code) of the fenced blocks."""
    lines = text.split("\n")
    inside, out, k = fenced_lines(lines), [], 0
    while k < len(lines):
        if inside[k]:
            m, start = _FENCE.match(lines[k]), k
            k += 1
            while k < len(lines) and inside[k] and not ((e := _FENCE.match(lines[k])) and e.group(1)[0] == m.group(1)[0] and not e.group(2)):
                k += 1
            out.append((start + 1, m.group(2).lower(), "\n".join(lines[start + 1 : k])))
        k += 1
    return out


def headings(text: str) -> tuple[list[int], list[str]]:
    lines = text.split("\n")
    found = [m for line, f in zip(lines, fenced_lines(lines)) if not f and (m := _HEAD.match(line))]
    return [len(m.group(1)) for m in found], [m.group(2) for m in found]


def sections(text: str, level: int = 2) -> list[tuple[str, int, str]]:
    """(title, first line from 1, body) of the sections of a level; a line of dashes ends one, what follows is dropped up to the next."""
    lines = text.split("\n")
    out: list[tuple[str, int, list[str]]] = []
    open_ = False
    for k, (line, fenced) in enumerate(zip(lines, fenced_lines(lines)), 1):
        m = None if fenced else _HEAD.match(line)
        if m and len(m.group(1)) == level:
            out.append((m.group(2), k, []))
            open_ = True
        elif not fenced and re.match(r"^-{3,}\s*$", line):
            open_ = False
        elif open_:
            out[-1][2].append(line)
    return [(t, k, "\n".join(b).strip("\n")) for t, k, b in out]


def paragraphs(text: str) -> list[str]:
    """Blocks between blank lines, fenced code left out."""
    lines = text.replace("\r\n", "\n").split("\n")
    kept = "\n".join("" if f else line for line, f in zip(lines, fenced_lines(lines)))
    return [p.strip() for p in re.split(r"\n[ \t]*\n", kept) if p.strip()]


def _cells(line: str) -> list[str]:
    body = line.strip().strip("|") if not line.strip().endswith("\\|") else line.strip().lstrip("|")
    return [c.strip().replace("\\|", "|") for c in re.split(r"(?<!\\)\|", body)]


def pipe_tables(text: str) -> list[list[list[str]]]:
    """Grids of the pipe tables, without the rule under the header."""
    lines = text.split("\n")
    out, grid = [], []
    for line, fenced in zip([*lines, ""], [*fenced_lines(lines), False]):
        if not fenced and line.strip().startswith("|") and line.count("|") >= 2:
            if not re.match(r"^\s*\|?(?:\s*:?-{2,}:?\s*\|?)+\s*$", line):
                grid.append(_cells(line))
        elif grid:
            out.append(grid)
            grid = []
    return out


def spanned_grid(rows: list[list[tuple[str, int, int]]]) -> list[list[str]]:
    """Rectangular grid of rows of (text, rowspan, colspan); a spanning cell is repeated, gaps are ''."""
    grid: dict[tuple[int, int], str] = {}
    for r, row in enumerate(rows):
        c = 0
        for text, down, across in row:
            while (r, c) in grid:
                c += 1
            for i in range(max(1, down)):
                for j in range(max(1, across)):
                    if r + i < len(rows):
                        grid[r + i, c + j] = text
            c += max(1, across)
    width = max((c for _, c in grid), default=-1) + 1
    return [[grid.get((r, c), "") for c in range(width)] for r in range(len(rows))]


def blocks(text: str) -> list[dict]:
    """Block structure: heading, paragraph, list, code, table, quote."""
    lines = text.replace("\r\n", "\n").split("\n")
    fenced, out, k = fenced_lines(lines), [], 0

    def take(kind, test, **more):
        nonlocal k
        start = k
        while k < len(lines) and test(k):
            k += 1
        out.append({"kind": kind, "line": start + 1, "text": "\n".join(lines[start:k]), "level": 0, **more})

    bullet = re.compile(r"^\s*(?:[-*+•]|\d+[.)])\s")
    while k < len(lines):
        line = lines[k]
        if not line.strip():
            k += 1
        elif fenced[k]:
            take("code", lambda i: fenced[i])
        elif m := _HEAD.match(line):
            out.append({"kind": "heading", "line": k + 1, "text": m.group(2), "level": len(m.group(1))})
            k += 1
        elif line.strip().startswith("|"):
            take("table", lambda i: lines[i].strip().startswith("|") and not fenced[i])
        elif line.lstrip().startswith(">"):
            take("quote", lambda i: lines[i].lstrip().startswith(">"))
        elif bullet.match(line):
            take("list", lambda i: bool(lines[i].strip()) and not fenced[i] and (bool(bullet.match(lines[i])) or lines[i].startswith((" ", "\t"))))
        else:
            take("paragraph", lambda i: bool(lines[i].strip()) and not fenced[i] and not _HEAD.match(lines[i]) and not bullet.match(lines[i]))
    return out


def chunks(text: str, limit: int = 6500) -> list[dict]:
    """Chunks of whole sections: a section tree is flattened where it is too large, adjacent small ones are joined (titles with ' + ')."""
    lines = text.split("\n")
    fenced = fenced_lines(lines)
    starts = [(k, len(m.group(1)), m.group(2)) for k, line in enumerate(lines) if not fenced[k] and (m := _HEAD.match(line))]
    bounds = [(0, 0, "(untitled)")] if not starts or starts[0][0] > 0 else []
    bounds += starts
    parts = []
    for (a, level, title), nxt in zip(bounds, [*[b[0] for b in bounds[1:]], len(lines)]):
        body = lines[a:nxt]
        if any(x.strip() for x in body):
            parts.append({"heading": title, "start_line": a + 1, "end_line": nxt, "chars": sum(len(x) + 1 for x in body), "level": level})
    out: list[dict] = []
    for p in parts:
        if out and out[-1]["chars"] + p["chars"] <= limit and p["level"] >= out[-1]["level"]:
            o = out[-1]
            out[-1] = {**o, "heading": f"{o['heading']} + {p['heading']}", "end_line": p["end_line"], "chars": o["chars"] + p["chars"]}
        else:
            out.append(p)
    return out


def rag_chunks(text: str, budget: int = 400) -> list[dict]:
    """Paragraphs of ##/### sections packed up to a token budget (characters / 4), the heading in front of each chunk."""
    lines = text.split("\n")
    fenced, title, line_of, pack = fenced_lines(lines), "", 1, []
    out: list[dict] = []

    def flush():
        nonlocal pack
        if pack:
            out.append({"heading": title, "start_line": pack[0][0], "end_line": pack[-1][1], "text": (f"{title}\n\n" if title else "") + "\n\n".join(p[2] for p in pack)})
        pack = []

    buf: list[str] = []
    for k, line in enumerate([*lines, ""], 1):
        m = _HEAD.match(line) if k <= len(lines) and not fenced[k - 1] else None
        blank = not line.strip() and not (k <= len(lines) and fenced[k - 1])
        if (blank or m or k > len(lines)) and buf:
            p = "\n".join(buf)
            if pack and sum(len(x[2]) // 4 for x in pack) + len(p) // 4 > budget:
                flush()
            pack.append((line_of, k - 1, p))
            buf = []
        if m and len(m.group(1)) in (2, 3):
            flush()
            title = m.group(2)
        elif not blank and k <= len(lines):
            if not buf:
                line_of = k
            buf.append(line)
    flush()
    return out


# ---------------------------------------------------------------- DataFrames


def _each(docs: DataFrame, key: str, text: str, schema: str, f) -> DataFrame:
    ship(docs.sparkSession)
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [(k, *row) for k, t in zip(b["k"], b["t"]) for row in f(t)]
            yield pd.DataFrame(got, columns=["k", *names])

    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t is not null")
    return rows.mapInPandas(run, f"k {kind}, {schema}").withColumnRenamed("k", key)


def table_cells(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, tbl, r, c, text) of all pipe tables."""
    return _each(docs, key, text, "tbl int, r int, c int, cell string", lambda t: [(k, r, c, x) for k, g in enumerate(pipe_tables(t)) for r, row in enumerate(g) for c, x in enumerate(row)])


def document_blocks(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return _each(docs, key, text, "kind string, line int, level int, chars int", lambda t: [(b["kind"], b["line"], b["level"], len(b["text"])) for b in blocks(t)])


def document_chunks(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = 6500) -> DataFrame:
    return _each(docs, key, text, "heading string, start_line int, end_line int, chars int", lambda t: [(c["heading"], c["start_line"], c["end_line"], c["chars"]) for c in chunks(t, limit)])


def document_rag_chunks(docs: DataFrame, key: str = "doc_id", text: str = "text", budget: int = 400) -> DataFrame:
    return _each(docs, key, text, "heading string, start_line int, end_line int, chunk string", lambda t: [(c["heading"], c["start_line"], c["end_line"], c["text"]) for c in rag_chunks(t, budget)])


def document_fields(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, name, value) of the front matter."""
    return _each(docs, key, text, "name string, value string", lambda t: list(front_matter(t)[0].items()))


def document_code(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return _each(docs, key, text, "line int, language string, code string", code_blocks)


def document_sections(docs: DataFrame, key: str = "doc_id", text: str = "text", level: int = 2) -> DataFrame:
    return _each(docs, key, text, "title string, line int, body string", lambda t: sections(t, level))


def cell_neighbours(cells: DataFrame, key: str = "doc_id") -> DataFrame:
    """Each cell with the cells above, below, left and right of it and its column's heading."""
    c = cells
    out = c
    for name, dr, dc in (("up", -1, 0), ("down", 1, 0), ("left", 0, -1), ("right", 0, 1)):
        o = c.select(key, "tbl", (F.col("r") - dr).alias("r"), (F.col("c") - dc).alias("c"), F.col("cell").alias(name))
        out = out.join(o, [key, "tbl", "r", "c"], "left")
    head = c.where("r = 0").select(key, "tbl", "c", F.col("cell").alias("heading"))
    return out.join(head, [key, "tbl", "c"], "left")
