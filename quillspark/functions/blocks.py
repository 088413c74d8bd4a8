"""Functions on lines and blocks of one text: authors with their addresses, step prompts, what a code block looks like."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.operators.segments import fenced_lines

_MAIL = re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+")
_HIDDEN = re.compile(r"([\w.+-]+)(?:\s*[\[(]\s*at\s*[\])]\s*|\s+at\s+)([\w-]+)((?:(?:\s*[\[(]\s*dot\s*[\])]\s*|\s+dot\s+|\.)[\w-]+)+)", re.I)


def _address(line: str) -> tuple[str, str]:
    """(address in lower case or '', what stands before it)."""
    if m := _MAIL.search(line):
        return m.group(), line[: m.start()]
    if m := _HIDDEN.search(line):
        ends = re.sub(r"\s*[\[(]\s*dot\s*[\])]\s*|\s+dot\s+", ".", m.group(3), flags=re.I)
        return f"{m.group(1)}@{m.group(2)}{ends}".lower(), line[: m.start()]
    return "", line


def author_lines(lines: list[str], skip=lambda line: False) -> list[str]:
    """Authors of a list of lines: `Name <address>`, a name alone, or `<address>`.

    An address belongs to the name on its own line, else to the name on the line
    before it that has none yet.
    """
    out: list[str] = []
    waiting = ""
    for line in (x.strip() for x in lines):
        mail, before = _address(line)
        name = before.strip().strip("<>(,").strip() if mail else line
        if not mail:
            if name and not skip(name):
                out += [waiting] if waiting else []
                waiting = name
            continue
        if name and waiting:
            out.append(waiting)
        name, waiting = name or waiting, ""
        out.append(f"{name} <{mail}>".strip())
    return [*out, waiting] if waiting else out


_STEP = re.compile(r"^(?:(\d+)\.\s+\S.*|Step\s+(\d+)\b.*)$")
_FIELD = re.compile(r"^-\s+\*\*([^*:]+):?\*\*:?\s*(.*)$")
# Fields of a step that have a place of their own.
STEP_FIELDS = ("model", "execution", "tools", "condition", "system prompt", "max-output", "thinking-budget", "chunk-tokens", "concurrency")


def step_prompt(name: str, body: str) -> dict:
    """Fields, system prompt and other fields of a step's section; bullets within fences don't count.

    ValueError for a name without a number, an unknown mode, and a replacing
    mode without a system prompt.
    """
    m = _STEP.match(name)
    if not m:
        raise ValueError(f"{name!r} has no number")
    lines = body.split("\n")
    fields: dict[str, str] = {}
    prompt: list[str] | None = None
    for line, fenced in zip(lines, fenced_lines(lines)):
        if not fenced and re.match(r"^###\s+System Prompt\s*$", line, re.I):
            prompt = []
        elif not fenced and prompt is None and (f := _FIELD.match(line)):
            fields[f.group(1).strip().lower()] = f.group(2).strip()
        elif prompt is not None and not fenced and line.startswith("### "):
            prompt, lines = [*prompt], []
            break
        elif prompt is not None:
            prompt.append(line)
    system = "\n".join(prompt or []).strip()
    mode = (fields.get("system prompt") or "append").split()[0].lower()
    if mode not in ("append", "replace") or mode == "replace" and not system:
        raise ValueError(f"{name!r}: mode {mode!r} doesn't fit its system prompt")
    number = lambda k: int(fields[k]) if k in fields else None
    return {
        "number": int(m.group(1) or m.group(2)), "model": fields.get("model", "default").split("(")[0].strip().lower(), "execution": fields.get("execution", "main").lower(),
        "tools": [t.strip() for t in fields.get("tools", "").split(",") if t.strip()], "condition": fields.get("condition"), "mode": mode, "system": system,
        "max_output": number("max-output"), "thinking_budget": number("thinking-budget"), "chunk_tokens": number("chunk-tokens"), "concurrency": number("concurrency"),
        "extra": {k: v for k, v in fields.items() if k not in STEP_FIELDS},
    }


# Commands that start a shell transcript.
_COMMANDS = "git|cd|ls|cp|mv|rm|mkdir|cat|curl|wget|sudo|apt|pip|python3?|cmake|make|ninja|docker|npm"


def block_kind(c: Column) -> Column:
    """What a code block without a language looks like: shell, grammar, json, diagram or code; the first that fits."""
    first = F.regexp_extract(c, r"^\s*([^\n]*)", 1)
    shell = first.rlike(rf"^(?:#!|[$>] |(?:{_COMMANDS})\s)") | (F.size(F.regexp_extract_all(c, F.lit(r"(?m)^\s*\$ "), F.lit(0))) >= 2)
    data = c.rlike(r"^\s*[\[{]") & c.rlike(r'"[^"\n]*"\s*:')
    drawn = c.rlike(r"(?m)^\s*\+-[-+]*-\+\s*$") | c.rlike(r"[\x{2500}-\x{257f}]")
    return F.when(shell, "shell").when(c.rlike(r"::="), "grammar").when(data, "json").when(drawn, "diagram").otherwise("code")


def content_only(c: Column) -> Column:
    """Letters, digits and underscores alone, circled numbers as digits."""
    circled = "".join(chr(0x2460 + k) for k in range(9))
    return F.regexp_replace(F.translate(c, circled, "123456789"), r"[^\p{L}\p{N}_]", "")


# Phrases that comments must not hold.
RULES = (
    ("personal-attack", r"(?i)\b(idiots?|morons?|charlatans?|clueless (?:author|committee|op))\b", False),
    ("typo-nitpick", r"(?i)\b(typos?|misspell\w*|spelling (?:error|mistake)s?|missing semicolons?)\b", True),
    ("fourth-wall", r"(?i)\b(as a language model|language model|system prompt|my persona|my brief|fourth wall|slot s\d+)\b", False),
)


def broken_rules(c: Column) -> Column:
    """The content rules that a comment breaks; nitpicks are allowed beside code."""
    return F.array_compact(F.array(*[F.when(c.rlike(p) & (~c.contains("```") if but_code else F.lit(True)), name) for name, p, but_code in RULES]))


def quoted_blocks(c: Column) -> Column:
    """The texts of blockquotes, each with single blanks."""
    runs = F.regexp_extract_all(c, F.lit(r"(?m)(?:^[ \t]*>[^\n]*(?:\n|\z))+"), F.lit(0))
    return F.transform(runs, lambda r: F.trim(F.regexp_replace(F.regexp_replace(r, r"(?m)^[ \t]*[> ]+", ""), r"\s+", " ")))
