"""Rule-based routing of documents: units, section types, catalogue hits, densities, emission.

A document is cut into units (headings, fenced blocks, rules of grammars,
sentences) where it lies; every unit gets the section type of the last heading and the set of
catalogue patterns that it meets; densities per section weigh into scores, the
weaker domain is put aside, and groups are emitted that are both sustained and
above their threshold.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions.text import has_phrase
from quillspark.operators.segments import fenced_lines
from quillspark.operators.sequence import neighbours_cofire
from quillspark.session import checkpointed, ship

GROUPS = ("LEWG", "LWG", "EWG", "CWG")
# Domain and mode of each group, emission thresholds, margins.
GROUP_AXES = {"LEWG": ("lib", "design"), "LWG": ("lib", "wording"), "EWG": ("lang", "design"), "CWG": ("lang", "wording")}
THRESHOLDS = {"LEWG": 0.30, "LWG": 0.12, "EWG": 0.35, "CWG": 0.18}
SECONDARY_MARGIN, ADMIN_GATE, DOMAIN_MARGIN = 0.08, 0.05, 0.10
LEAST_SUSTAINED, SUSTAINED_SHARE, LEAST_CHARS = 3, 0.02, 20

# Weights of section types for the design and the wording mode.
DESIGN_WEIGHTS = {"PREAMBLE": 0.3, "MOTIVATION": 1.0, "DESIGN": 1.0, "WORDING": 0.1, "IMPACT": 0.5, "IMPLEMENTATION": 0.3, "APPENDIX": 0.0}
WORDING_WEIGHTS = {"PREAMBLE": 0.1, "MOTIVATION": 0.1, "DESIGN": 0.1, "WORDING": 1.0, "IMPACT": 0.2, "IMPLEMENTATION": 0.0, "APPENDIX": 0.0}

# Heading patterns, the specific ones before the general ones.
HEADINGS = (
    ("WORDING", r"\b(proposed\s+wording|standardese|proposed\s+changes|modifications?\s+to\s+the\s+standard)\b"),
    ("DESIGN", r"\b(design\s+decisions?|proposed\s+design|interface|proposal)\b"),
    ("MOTIVATION", r"\b(introduction|motivation|background|problem\s+statement)\b"),
    ("IMPACT", r"\b(impact\s+on\s+the\s+standard|compatibility|ABI\s+considerations?|feature\s+test\s+macro)\b"),
    ("IMPLEMENTATION", r"\b(implementation\s+experience|reference\s+implementation)\b"),
    ("APPENDIX", r"\b(acknowledg[e]?ments?|references|bibliography|appendix|examples?|revision\s+history|change\s*log|document\s+history)\b"),
    ("PREAMBLE", r"\babstract\b"),
    ("WORDING", r"\bwording\b"),
    ("DESIGN", r"\bdesign\b(?!\s+of\s+this\s+document)|\bAPI\b"),
    ("IMPLEMENTATION", r"\bimplementation\b"),
)

# The catalogue, pattern by id (case ignored where the flag is set).
CATALOGUE = {
    "D1": (False, r"<\s*[a-z_][a-z0-9_]*\s*>"),
    "D2": (False, r"\b\d{1,2}\.\d+(?:\.\d+)*\s+\[[\w.]+\]"),
    "D3": (True, r"\bstd::|\b\w+_v\b|\b\w+_t\b|\b(is_same|is_convertible|tuple_size|decay_t|enable_if|type_traits)\b"),
    "D4": (True, r"\bnamespace\s+std\b|\b(?:standard\s+)?library\b.{0,60}?\b(?:should|shall|must|will|needs?\s+to)\s+be\s+(?:updated|modified|changed|extended|amended)\b|\b(?:should|shall|must|will|needs?\s+to)\s+be\s+(?:updated|modified|changed|extended|amended)\b.{0,60}?\b(?:standard\s+)?library\b"),
    "D5": (True, r"\b(LWG|LEWG|Library\s+Evolution|library\s+evolution)\b|\bLWG\s+\d+"),
    "D6": (True, r"\b(Iterator|Allocator\s+model|Ranges|Container\s+requirements|named\s+requirement)\b"),
    "D7": (True, r"\b(customization\s+point|users?\s+may\s+specialize|customization\s+point\s+object)\b"),
    "D8": (True, r"\[(?:expr|dcl|class|stmt|decl|basic|conv|temp|cpp|lex)\.[\w.]+\]|\b(?:[1-9]|1[0-6])\.\d+(?:\.\d+)*\s+\["),
    "D9": (True, r"\b(concepts?|modules?|coroutines?|structured\s+bindings?|constexpr|variable\s+templates?|ranges?|attributes?|lambdas?)\b"),
    "D10": (True, r"\b[a-z][a-z0-9]*(?:-[a-z0-9]+)+:\s*|(?:^|\n)\s*[a-z][a-z0-9]*(?:-[a-z0-9]+)+\s*::=|\blambda-expression\b|\bassignment-expression\b"),
    "D11": (True, r"\b(overload\s+resolution|argument-dependent\s+lookup|name\s+lookup|candidate\s+set|ADL)\b"),
    "D12": (True, r"\b(template\s+(argument\s+deduction|instantiation)|substitution\s+failure|SFINAE)\b"),
    "D13": (True, r"\b(lifetime|storage\s+duration|temporary\s+materialization|destruction\s+order)\b"),
    "D14": (True, r"\b(EWG|CWG|Evolution\s+Working\s+Group|Core\s+Working\s+Group)\b|\b(?:CWG|EWG)\s+\d+"),
    "D15": (True, r"\b(implicit\s+conversion\s+sequence|decltype|type\s+deduction)\b"),
    "M1": (True, r"\b(proposal\s+to\s+add|we\s+propose|this\s+paper\s+introduces?|this\s+proposal\s+adds?)\b"),
    "M2": (True, r"\b(?:should|shall|must|will|needs?\s+to)\s+be\s+(?:changed|modified|updated|revised|amended)\b|\bwe\s+modify\b|\bupdat(?:e|ed)\s+accordingly\b"),
    "M3": (True, r"\b(should\s+be\s+deprecated|propose\s+removing|proposes?\s+removing)\b"),
    "M4": (True, r"\b(for\s+consistency\s+with|for\s+several\s+reasons|because)\b"),
    "M5": (True, r"\b(_v\s+suffix|_t\s+suffix|naming\s+convention)\b"),
    "M6": (True, r"\b(superior\s+to|compared\s+to|alternative\s+approach)\b"),
    "M7": (True, r"\b(simple\s+to\s+learn|less\s+verbose|easier\s+to|unintuitive)\b"),
    "M8": (True, r"\b(the\s+function\s+takes|returns\s+a|template\s+parameter)\b"),
    "M9": (True, r"\b(pure\s+extension|no\s+breaking\s+changes?|backward\s+compatible)\b"),
    "M10": (True, r"\b(does(?:n't| not)\s+(?:touch|affect)|limited\s+to|out\s+of\s+scope)\b"),
    "M11": (True, r"\b(successfully\s+compiled|implemented\s+in)\b"),
    "M12": (True, r"\b(existing\s+practice\s+in\s+Boost|other\s+languages\s+provide|widely\s+used)\b"),
    "M13": (True, r"\b(zero\s+overhead|compile[- ]time\s+cost|no\s+runtime\s+penalty)\b"),
    "W1": (True, r"\b(shall\b|Effects:|Returns:|Mandates:|Preconditions:)\b"),
    "W2": (True, r"\b(add\s+the\s+following|modify\s+paragraph|strike\b|insert\s+before)\b|(?:,\s*)?add:\s*$"),
    "W3": (True, r"\b\d{1,2}\.\d+(?:\.\d+)*\s+\[[\w.]+\].*(?:modify|add)"),
    "W4": (True, r"\b(Table\s+\d+|modify\s+Table|add\s+a\s+row\s+to\s+Table)\b"),
    "W5": (True, r"__cpp|__has_cpp_attribute|feature-test\s+macro"),
    "S1": (True, r"\baudience:\s*"),
    "S2": (False, r"\b[PND]\d{4}R\d+\b"),
    "S3": (True, r"\b(does(?:n't| not)\s+affect\s+existing\s+user\s+code|migration\s+path)\b"),
    "S4": (True, r"\b(ABI\s+break|binary\s+compatibility|layout\s+compatible)\b"),
    "S5": (True, r"\b(unanimous\s+consent|no\s+objection|poll\s+result|straw\s+poll|SF/F/N/A/SA)\b"),
}
AXES = {
    "lib": [f"D{k}" for k in range(1, 8)],
    "lang": [f"D{k}" for k in range(8, 16)],
    "design": [f"M{k}" for k in range(1, 14)],
    "wording": [f"W{k}" for k in range(1, 6)],
}


def section_type(heading: Column) -> Column:
    """Type of a heading; the first pattern that fits, PREAMBLE without one."""
    out = F.lit("PREAMBLE")
    for kind, pattern in reversed(HEADINGS):
        out = F.when(heading.rlike("(?i)" + pattern), kind).otherwise(out)
    return out


#: Of each pattern, parts (in small letters) of which every text that meets it has one; they are looked for before the pattern is tried.
PARTS = {
    "D1": "<", "D2": "[", "D3": "_ std::", "D4": "namespace library", "D5": "lwg lewg library", "D6": "iterator allocator ranges container named", "D7": "customization user", "D8": "[",
    "D9": "concept module coroutine structured constexpr variable range attribute lambda", "D10": "-", "D11": "overload argument- lookup candidate adl", "D12": "template substitution sfinae",
    "D13": "lifetime storage temporary destruction", "D14": "ewg cwg evolution core", "D15": "implicit decltype deduction", "M1": "propos introduce", "M2": "changed modified updated revised amended modify accordingly",
    "M3": "deprecated removing", "M4": "consistency several because", "M5": "suffix convention", "M6": "superior compared alternative", "M7": "simple verbose easier unintuitive", "M8": "function returns parameter",
    "M9": "extension breaking backward", "M10": "touch affect limited scope", "M11": "compiled implemented", "M12": "practice languages widely", "M13": "zero compile runtime",
    "W1": "shall effects: returns: mandates: preconditions:", "W2": "following modify strike insert add:", "W3": "[", "W4": "table", "W5": "__cpp __has feature-test", "S1": "audience:", "S2": "r",
    "S3": "affect migration", "S4": "abi binary layout", "S5": "consent objection poll sf/",
}


def hits(text: Column, low: Column | None = None) -> Column:
    """Ids of the catalogue's patterns that a text meets, in the catalogue's order; letters, digits, blanks and case are Unicode's, only a line feed ends a line.

    low: the text in small letters, if there is a column of it.
    """
    low = F.lower(text) if low is None else low
    odd = low.contains("ſ")  # a small letter that is an s where case is ignored

    def met(key: str, fold: bool, pattern: str) -> Column:
        may = odd
        for part in PARTS[key].split():
            may = may | low.contains(part)
        return may & text.rlike(("(?iUd)" if fold else "(?Ud)") + pattern)

    return F.array_compact(F.array(*[F.when(met(k, fold, p), k) for k, (fold, p) in CATALOGUE.items()]))


# Labels of normative elements, and words before a colon that are no rule of a grammar.
LABELS = (
    "Effects", "Returns", "Requires", "Remarks", "Throws", "Complexity", "Mandates", "Preconditions", "Postconditions", "Constraints",
    "Error conditions", "Recommended practice", "Hardware constraints", "Synchronization", "Expects", "Notes",
)
NO_RULES = ("add", "modify", "insert", "strike", "delete")

_LABEL = rf"\*{{0,2}}(?:{'|'.join(LABELS)})\*{{0,2}}\s*:"
_LABEL_LINE = re.compile(rf"\s*{_LABEL}", re.I)
_RULE_LINE = re.compile(rf"\s*(?!(?:{'|'.join(NO_RULES)})\s*:)[a-z][a-z0-9_-]*\s*:(?=\s*\S)(?!.*[A-Z])(?!.*[.!?](?:\s|$)).+")
# a sentence ends before a capital, code or a bracket
_SENTENCE_END = re.compile(r"(?<=[.!?])\s+(?=[A-Z`\[(À-ÞĀ-Ž])")


def is_label_line(c: Column) -> Column:
    """Whether a line starts with the label of a normative element."""
    return c.rlike(rf"(?i)^\s*{_LABEL}")


def is_rule_line(c: Column) -> Column:
    """Whether a line is a rule of a grammar: a small name, a colon and neither capitals nor the end of a sentence after it."""
    rhs = F.regexp_extract(c, r"^\s*[a-z][a-z0-9_-]*\s*:\s*(.+)$", 1)
    return (rhs != "") & ~is_label_line(c) & ~c.rlike(rf"^\s*(?:{'|'.join(NO_RULES)})\s*:") & ~rhs.rlike(r"[A-Z]|[.!?](?:\s|$)")


def _sentences(text: str) -> list[str]:
    """A paragraph's sentences; labels start one where they stand at a line's start or after an instruction to add or modify."""
    parts = []
    for piece in re.split(rf"\n(?=[ \t]*{_LABEL})|(?i:(?<=add:)|(?<=modify:))\s+(?={_LABEL})", text, flags=re.I):
        parts += _SENTENCE_END.split(piece)
    return [p.strip() for p in parts if p.strip()]


def text_units(text: str) -> list[tuple[int, str, str]]:
    """(first line from 0, kind, unit) of headings, fenced blocks, rules of grammars and sentences, after the front matter."""
    lines = re.split(r"\r?\n", text)
    start = next((k + 1 for k in range(1, len(lines)) if lines[k] in ("---", "...")), 0) if lines[0] == "---" else 0
    fenced = fenced_lines(lines)
    out: list[tuple[int, str, str]] = []
    held: list[str] = []
    kind_before, first = "", 0

    def close() -> None:
        if kind_before == "fence":
            out.append((first, "fence", "\n".join(held)))
        elif held:
            out.extend((first, "prose", s) for s in _sentences("\n".join(held)))
        held.clear()

    for k in range(start, len(lines)):
        line = lines[k]
        kind = "fence" if fenced[k] else "blank" if not line.strip() else "heading" if re.match(r"#{1,6}\s", line) else "rule" if _RULE_LINE.fullmatch(line) and not _LABEL_LINE.match(line) else "prose"
        opens = kind == "fence" and (kind_before != "fence" or not fenced[k - 1] or _closed(held))
        if held and (kind != kind_before or opens):
            close()
        if kind in ("heading", "rule"):
            out.append((k, kind, line.strip()))
        elif kind != "blank":
            first = first if held else k
            held.append(line)
        kind_before = kind
    close()
    return out


def _closed(block: list[str]) -> bool:
    """Whether the lines of a fenced block end with the fence that closes it."""
    mark = re.match(r"\s*(`{3,}|~{3,})", block[0]) if block else None
    last = re.fullmatch(r"\s*(`{3,}|~{3,})\s*", block[-1]) if len(block) > 1 else None
    return bool(mark and last and last.group(1)[0] == mark.group(1)[0] and len(last.group(1)) >= len(mark.group(1)))


def units(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, pos, line, kind, unit): headings, fenced blocks, rules of grammars and sentences in order, with their first line from 0.

    Every document is taken apart where it lies, in one pass.
    """
    ship(docs.sparkSession)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [(k, pos, *u) for k, t in zip(b["k"], b["t"]) for pos, u in enumerate(text_units(t), 1)]
            yield pd.DataFrame(got, columns=[key, "pos", "line", "kind", "unit"])

    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t"))
    return rows.mapInPandas(cut, f"{key} {dict(docs.dtypes)[key]}, pos int, line int, kind string, unit string")


def tagged_units(u: DataFrame, key: str = "doc_id") -> DataFrame:
    """Units of enough length with their section type and axis flags."""
    w = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    head = F.when(F.col("kind") == "heading", section_type(F.regexp_replace("unit", r"^#+\s*", "")))
    x = u.withColumn("section", F.coalesce(F.last(head, ignorenulls=True).over(w), F.lit("PREAMBLE"))).where((F.col("kind") != "heading") & (F.length("unit") >= LEAST_CHARS))
    x = x.withColumn("_low", F.lower("unit")).withColumn("hits", hits(F.col("unit"), F.col("_low"))).drop("_low")
    flag = lambda ids: F.arrays_overlap("hits", F.array(*[F.lit(i) for i in ids]))
    return x.withColumns({axis: flag(ids) for axis, ids in AXES.items()})


def sustained(tagged: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, units, a count per group of units where its domain and mode meet)."""
    x = tagged
    for g, (a, b) in GROUP_AXES.items():
        x = neighbours_cofire(x, [key], ["pos"], "section", a, b, f"n_{g}")
    return x.groupBy(key).agg(F.count("*").alias("units"), *[F.count_if(F.col(f"n_{g}")).alias(f"n_{g}") for g in GROUPS])


def quadrant_scores(tagged: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, a score per group): weight of the section type * least of both densities * share of the section."""
    per = tagged.groupBy(key, "section").agg(F.count("*").alias("n"), *[F.avg(F.col(a).cast("int")).alias(a) for a in AXES])
    weight = lambda ws: F.create_map(*[F.lit(v) for kv in ws.items() for v in kv])[F.col("section")]
    mass = F.col("n") / F.sum("n").over(Window.partitionBy(key))
    per = per.withColumn("_mass", mass).withColumn("_design", weight(DESIGN_WEIGHTS)).withColumn("_wording", weight(WORDING_WEIGHTS))
    return per.groupBy(key).agg(*[F.sum(F.col(f"_{b}") * F.least(a, b) * F.col("_mass")).alias(g) for g, (a, b) in GROUP_AXES.items()])


def arbitrated(scores: DataFrame) -> DataFrame:
    """The weaker domain at 0 unless it comes within the margin of the stronger."""
    lib, lang = F.greatest("LEWG", "LWG"), F.greatest("EWG", "CWG")
    no_lang, no_lib = (lib >= lang) & (lang < lib - DOMAIN_MARGIN), (lib < lang) & (lib < lang - DOMAIN_MARGIN)
    return scores.withColumns({g: F.when(no_lang if g in ("EWG", "CWG") else no_lib, 0.0).otherwise(F.col(g)) for g in GROUPS})


def audience_bonus(scores: DataFrame, audience: str) -> DataFrame:
    """Additions for what the audience text names; the more specific phrase comes first."""
    a = F.upper(F.coalesce(F.col(audience), F.lit("")))
    evolution, library = has_phrase(a, "LIBRARY EVOLUTION") | has_phrase(a, "LEWG"), has_phrase(a, "LIBRARY") | has_phrase(a, "LWG")
    core, lang = has_phrase(a, "CORE") | has_phrase(a, "CWG"), (has_phrase(a, "EVOLUTION") | has_phrase(a, "EWG")) & ~has_phrase(a, "LIBRARY EVOLUTION")
    # The additions.
    add = {
        "LEWG": F.when(evolution, 0.20).when(library, 0.15).otherwise(0.0), "LWG": F.when(evolution | library, 0.10).otherwise(0.0),
        "CWG": F.when(core, 0.15).otherwise(0.0), "EWG": F.when(core, 0.10).when(lang, 0.20).otherwise(0.0),
    }
    return scores.withColumns({g: F.col(g) + x for g, x in add.items()})


def emitted(scores: DataFrame, counts: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, group, score, role): primary and near secondaries among the sustained groups above their threshold, else the best one if it is."""
    j = scores.join(counts, key)
    least = F.greatest(F.lit(LEAST_SUSTAINED), F.floor(F.col("units") * SUSTAINED_SHARE))
    entry = lambda k, g: F.struct(F.col(g).alias("score"), F.lit(-k).alias("o"), F.lit(g).alias("group"), ((F.col(g) >= THRESHOLDS[g]) & (F.col(f"n_{g}") >= least)).alias("ok"), (F.col(g) >= THRESHOLDS[g]).alias("above"))
    e = F.array(*[entry(k, g) for k, g in enumerate(GROUPS)])
    j = j.select(key, e.alias("all"), F.greatest(*GROUPS).alias("top")).where(F.col("top") > ADMIN_GATE)
    j = j.withColumn("cand", F.filter("all", lambda x: x["ok"]))
    primary = F.array_max(F.when(F.size("cand") > 0, F.col("cand")).otherwise(F.col("all")))
    j = j.withColumn("p", primary).withColumn("out", F.when(F.size("cand") > 0, F.filter("cand", lambda x: x["score"] >= F.col("p.score") - SECONDARY_MARGIN)).otherwise(F.filter(F.array("p"), lambda x: x["above"])))
    return j.select(key, F.explode("out").alias("x"), "p").select(key, "x.group", "x.score", F.when(F.col("x.group") == F.col("p.group"), "primary").otherwise("secondary").alias("role"))


def route(docs: DataFrame, audience: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, group, score, role) of every document that is routed at all."""
    tagged = checkpointed(tagged_units(units(docs, key, text), key).select(key, "pos", "section", *AXES))  # narrow rows, read twice
    scores = arbitrated(quadrant_scores(tagged, key))
    if audience:
        scores = audience_bonus(scores.join(docs.select(key, audience), key), audience).drop(audience)
    return emitted(scores, sustained(tagged, key), key)


def triage(signal: Column, chars: Column, wording_ratio: Column) -> Column:
    """analyze, or why a document is skipped."""
    return F.when(signal, "analyze").when((chars > 300_000) & (wording_ratio > 0.5), "skip_wording").when(chars > 300_000, "skip_long").otherwise("analyze")
