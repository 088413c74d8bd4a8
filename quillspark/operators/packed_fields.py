"""Several values packed in one text field, split into one row per value.

A text is cut into tokens: delimiter characters, runs of blanks, and ordinary
runs of words.  Its *skeleton* names the class of each token and masks all
ordinary characters, so a whole table has few distinct skeletons.  The
splitting rule, one action per token, is resolved once per distinct skeleton;
the rules are broadcast (after their size has been measured; beyond the limit
a salted join takes over) and applied by position inside the JVM.

Defined results
  null, empty or blank field       no rows
  delimiters without a value       no rows for the empty places, pos counts values only
  repeated values in a field       one row each, at their own places
  unbalanced quote or bracket      an ordinary character
  extra columns                    ignored; the key column is kept as it is
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.session import BROADCAST_BYTES, broadcast_if_small, checkpointed, salted_join, ship

# Suffixes that belong to the name before the comma.
SUFFIXES = (
    "Jr", "Jr.", "Sr", "Sr.", "II", "III", "IV", "V", "PhD", "Ph.D.", "Ph.D", "MD", "M.D.", "MSc", "BSc", "Esq", "Esq.",
    "Inc", "Inc.", "LLC", "L.L.C.", "Ltd", "Ltd.", "GmbH", "AG", "Corp", "Corp.", "Co", "Co.", "S.A.", "SA", "B.V.", "BV",
    "plc", "PLC", "LLP", "LP", "SE", "Oy", "AB", "KG",
)

SPECIAL = r",;|/&+\t\r\n\"“”„'\\\[\]()<>"
SEPARATORS = set(",;|/&+\t\r\nB")


@dataclass(frozen=True)
class PackedField:
    """How one field is typed.

    acronym: pattern of codes that separate by a mere blank; family_comma:
    whether `Family, Given` is one value.
    """

    name: str
    acronym: str = ""
    family_comma: bool = False


AUTHORS = PackedField("authors", family_comma=True)
GROUPS = PackedField("target_group", acronym=r"SG\d{1,3}|WG\d{1,3}|[A-Z]{1,4}WGI?")


def _quoted(words: tuple[str, ...]) -> str:
    return "|".join(w.replace(".", r"\.") for w in sorted(words, key=len, reverse=True))


def _marked(field: PackedField) -> str:
    """Words that are tokens of their own."""
    kinds = ["and", _quoted(SUFFIXES)] + ([field.acronym] if field.acronym else [])
    return rf"(?:{'|'.join(kinds)})(?=[\s{SPECIAL}]|$)"


def token_pattern(field: PackedField) -> str:
    word = rf"[^\s{SPECIAL}]+"
    plain = rf"(?!{_marked(field)}){word}"
    return rf"(?i:<br\s*/?>)|[{SPECIAL}]|[^\S\t\r\n]+|{plain}(?: +{plain})*|{word}"


def token_class(field: PackedField, token: Column) -> Column:
    """One character per token; delimiters stand for themselves."""
    initial = r"\p{L}\p{M}*"
    out = (
        F.when(token.rlike(r"(?i)^<br\s*/?>$"), "B")
        .when(token.rlike(rf"^[{SPECIAL}]$"), token)
        .when(token.rlike(r"^\s+$"), "_")
        .when(token == "and", "a")
        .when(token.rlike(rf"^(?:{_quoted(SUFFIXES)})$"), "s")
    )
    if field.acronym:
        out = out.when(token.rlike(rf"^(?:{field.acronym})$"), "g")
    return (
        out.when(token.rlike(rf"^{initial}(?:\. *{initial}| +{initial})*\.?$"), "i")
        .when(token.rlike(rf"^[\p{{L}}\p{{M}}\p{{N}}-]+\.?(?: +\p{{L}}\p{{M}}*\.)+$"), "n")
        .when(token.contains(" "), "W")
        .otherwise("w")
    )


def tokens(field: PackedField, value: Column) -> Column:
    return F.regexp_extract_all(value, F.lit(token_pattern(field)), F.lit(0))


def skeleton(field: PackedField, toks: Column) -> Column:
    return F.array_join(F.transform(toks, lambda t: token_class(field, t)), "")


# ---------------------------------------------------------------- rules

#: Actions: k keep, d drop, x separate.  "json": the text is a JSON array.
JSON_RULE = "json"


def resolve(skel: str, family_comma: bool = False) -> str:
    """The splitting rule of one skeleton: an action for each of its tokens."""
    core = skel.strip("_\n\r\t")
    if core[:1] == "[" and core[-1:] == "]" and len(core) > 1:
        inner = core[1:-1].strip("_\n\r\t")
        if inner[:1] == '"' and inner[-1:] == '"' or not inner:
            return JSON_RULE
        if inner[:1] in "'\"" and inner[-1:] in "'\"":
            return _list_literal(skel)
    actions = _cut(skel)
    if family_comma:
        _join_commas(skel, actions)
    else:
        _join_suffixes(skel, actions)
    return "".join(actions)


def _list_literal(skel: str) -> str:
    """A bracketed list whose values stand in single (or double) quotes."""
    out, inside, i = [], "", 0
    while i < len(skel):
        c = skel[i]
        if inside:
            if c == "\\" and i + 1 < len(skel):
                out += ["d", "k"]
                i += 2
                continue
            rest = skel[i + 1 :].lstrip("_")
            if c == inside and rest[:1] in (",", "]"):
                inside = ""
                out.append("d")
            else:
                out.append("k")
        elif c in "'\"":
            inside = c
            out.append("d")
        else:
            out.append("x" if c == "," else "d")
        i += 1
    return "".join(out)


_CLOSE = {'"': '"', "“": "”", "„": "“"}


def _closing(skel: str, i: int) -> int:
    """The place of the quote that closes the one at i, or -1: what follows it must be a separator or the end."""
    want, j = _CLOSE[skel[i]], i + 1
    while j < len(skel):
        if skel[j] == want:
            if want == '"' and skel[j + 1 : j + 2] == '"':
                j += 2
                continue
            rest = skel[j + 1 :].lstrip("_")
            return j if not rest or rest[0] in SEPARATORS or rest[0] == "a" else -1
        j += 1
    return -1


def _cut(skel: str) -> list[str]:
    out: list[str] = []
    depth, blank, i = 0, True, 0  # blank: nothing but blanks since the last separator
    while i < len(skel):
        c = skel[i]
        if blank and c in _CLOSE and (j := _closing(skel, i)) > i:
            out.append("d")
            k = i + 1
            while k < j:
                if skel[k : k + 2] == '""' and c == '"':
                    out += ["d", "k"]
                    k += 2
                else:
                    out.append("k")
                    k += 1
            out.append("d")
            i, blank = j + 1, False
            continue
        if c in "(<":
            depth += (")" if c == "(" else ">") in skel[i + 1 :]
        elif c in ")>" and depth:
            depth -= 1
        if depth == 0 and c in SEPARATORS:
            out.append("x")
            blank = True
        elif depth == 0 and c == "a" and skel[i - 1 : i] in ("_", "", *SEPARATORS) and skel[i + 1 : i + 2] == "_" and i:
            out.append("x")
            blank = True
        elif depth == 0 and c == "_" and skel[i - 1 : i] == "g" and skel[i + 1 : i + 2] == "g":
            out.append("x")
            blank = True
        else:
            out.append("k")
            blank = blank and c == "_"
        i += 1
    return out


def _segments(skel: str, actions: list[str]) -> list[tuple[int, int]]:
    """Ranges between separators, with empty ones."""
    out, start = [], 0
    for i, a in enumerate([*actions, "x"]):
        if a == "x":
            out.append((start, i))
            start = i + 1
    return out


def _kept(skel: str, actions: list[str], a: int, b: int) -> str:
    quoted = "d" in actions[a:b]
    return "q" if quoted else skel[a:b].strip("_")


def _join_suffixes(skel: str, actions: list[str]) -> None:
    seg = _segments(skel, actions)
    for (a, b), (c, d) in zip(seg, seg[1:]):
        if skel[b : b + 1] == "," and _kept(skel, actions, c, d) == "s" and _kept(skel, actions, a, b) not in ("", "q"):
            actions[b] = "k"


def _join_commas(skel: str, actions: list[str]) -> None:
    """Keep the comma of `Family, Given` and of `Name, Suffix`: a lone word followed by a given name or initials."""
    seg, k = _segments(skel, actions), 0
    while k + 1 < len(seg):
        (a, b), (c, d) = seg[k], seg[k + 1]
        left, right = _kept(skel, actions, a, b), _kept(skel, actions, c, d)
        if skel[b : b + 1] == "," and left == "w" and right in ("w", "i", "n"):
            actions[b] = "k"
            if k + 2 < len(seg) and skel[d : d + 1] == "," and _kept(skel, actions, *seg[k + 2]) == "s":
                actions[d] = "k"
                k += 1
            k += 2
            continue
        if skel[b : b + 1] == "," and right == "s" and left not in ("", "q"):
            actions[b] = "k"
            k += 1
        k += 1


# ---------------------------------------------------------------- operator


def split_packed(df: DataFrame, key: str, fields: list[PackedField], broadcast_limit: int = BROADCAST_BYTES) -> DataFrame:
    """One row per packed value: (key, field, pos, value), pos from 1."""
    ship(df.sparkSession)
    parts = [
        df.select(F.col(key).alias("_key"), F.lit(f.name).alias("field"), F.col(f"`{f.name}`").cast("string").alias("_text"))
        .where(F.col("_text").rlike(r"\S"))
        .withColumn("_tok", tokens(f, F.col("_text")))
        .withColumn("_skel", F.coalesce(skeleton(f, F.col("_tok")), F.lit("")))  # known not to be null, else the join would look twice
        for f in fields
    ]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    family = {f.name: f.family_comma for f in fields}

    def rules_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["_rule"] = [resolve(s, family[f]) for f, s in zip(b["field"], b["_skel"])]
            yield b

    skels = rows.groupBy("field", "_skel").agg(F.lit(1).alias("_one")).drop("_one")
    rules = checkpointed(skels.mapInPandas(rules_of, "field string, _skel string, _rule string"))
    side, small = broadcast_if_small(rules, broadcast_limit)
    joined = rows.join(side, ["field", "_skel"]) if small else salted_join(rows, rules, ["field", "_skel"], "inner")
    return _apply(joined).select(F.col("_key").alias(key), "field", "pos", "value")


def _apply(df: DataFrame) -> DataFrame:
    mark = "\u0000"
    acted = F.zip_with(
        F.col("_tok"),
        F.split(F.col("_rule"), ""),
        lambda t, a: F.when(a == "x", F.lit(mark)).when(a == "d", F.lit("")).otherwise(t),
    )
    values = F.when(F.col("_rule") == JSON_RULE, F.coalesce(F.from_json("_text", "array<string>"), F.array("_text"))).otherwise(
        F.split(F.array_join(acted, ""), mark)
    )
    clean = F.filter(F.transform(values, lambda v: F.regexp_replace(v, r"^\s+|\s+$", "")), lambda v: v != "")
    return df.select("_key", "field", F.posexplode(clean).alias("_p", "value")).select("_key", "field", (F.col("_p") + 1).cast("int").alias("pos"), "value")
