"""Spellings of names that mean the same person or organisation.

Every distinct value is read once: mojibake is repaired, case, accents, titles,
addresses, affiliations and suffixes are set aside, and what is left becomes a
record of family, given name or prefix of one, middle initials and nickname
(organisations: name and kind).  Equal records are joined through their key, never in
pairs.  Records are blocked by phonetic codes of their sorted tokens (of the
family, and of either end of it with the given name), compared by edit distance,
Jaro-Winkler similarity and a nickname table within the block, and the accepted pairs are
clustered by connected components.  Initials and abbreviations join the one
cluster they can mean; if there are several they stay by themselves.

A block is read as a stream.  One of more than `BLOCK` records is spread over many
tasks: its records are grouped by the strings that are left when a letter is
taken out of a name.  Every two names that the comparison can accept
share one (they are one edit apart at most), and few names share the same, so the
pairs are the same for any `BLOCK` and no group grows with the table.

Defined results
  null, blank value            no record
  values without letters       each stands for itself
  several possible persons     no link
  repeated values              one
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.operators.graph import connected_components
from quillspark.session import broadcast_if_small, checkpointed, lookup_join, ship

#: Records of a block that stay in one task; larger ones are split (without an effect on the result).
BLOCK = 200
#: Jaro-Winkler similarity that a pair needs besides its edit distance.
SIMILAR = 0.85

# Nicknames and the given names they stand for.
NICKNAMES = {
    "abby": "abigail", "al": "albert alan alexander", "alex": "alexander alexandra", "andy": "andrew", "annie": "anne anna", "becky": "rebecca",
    "bella": "isabella", "ben": "benjamin", "benny": "benjamin", "beth": "elizabeth", "betty": "elizabeth", "bill": "william", "bob": "robert",
    "charlie": "charles charlotte", "chris": "christopher christine", "chuck": "charles", "dan": "daniel", "dave": "david", "deb": "deborah",
    "debbie": "deborah", "dick": "richard", "dom": "dominic", "don": "donald", "drew": "andrew", "ed": "edward edwin", "ellie": "eleanor",
    "fran": "francis frances francisco", "fred": "frederick alfred", "freda": "winifred frederica", "fritz": "frederick friedrich", "gabi": "gabriella gabriele",
    "greg": "gregory", "gus": "august gustav", "hal": "harold henry", "hank": "henry", "harry": "harold henry", "jack": "john", "jan": "janet",
    "jenny": "jennifer", "jim": "james", "joe": "joseph", "johnny": "john", "jon": "jonathan", "josie": "josephine", "kate": "katherine catherine",
    "kathy": "katherine", "kit": "christopher katherine", "larry": "lawrence", "len": "leonard", "lenny": "leonard", "liv": "olivia", "liz": "elizabeth",
    "lottie": "charlotte", "maggie": "margaret", "matt": "matthew matteo", "max": "maximilian", "meg": "margaret", "mick": "michael", "mike": "michael",
    "molly": "mary", "nastya": "anastasia", "nat": "nathaniel natalie", "nate": "nathan nathaniel", "ned": "edward", "nick": "nicholas", "nico": "dominic nicholas nicolas",
    "paco": "francisco", "pat": "patrick patricia", "peggy": "margaret", "pete": "peter", "polly": "mary", "ray": "raymond", "rich": "richard",
    "rick": "richard", "rob": "robert", "ron": "ronald", "sam": "samuel samantha", "sandy": "alexander sandra", "sasha": "alexander alexandra", "steve": "steven stephen",
    "sue": "susannah susan", "tilda": "matilda", "tilly": "matilda", "ted": "theodore edward", "teddy": "theodore", "theo": "theodore", "tim": "timothy", "tom": "thomas", "tony": "anthony",
    "trish": "patricia", "val": "valentina valerie", "vic": "victor victoria", "vova": "vladimir", "will": "william", "zack": "zachary", "zach": "zachary",
}
# Words of organisations, with their usual abbreviations.
ORGANISATION = {
    "institute": "inst", "foundation": "fdn found", "systems": "sys syst", "services": "svcs serv", "works": "wks", "office": "off", "laboratory": "lab",
    "laboratories": "labs", "partners": "ptnrs", "university": "univ", "society": "soc", "association": "assn assoc", "department": "dept", "committee": "cttee",
    "center": "ctr centre", "group": "grp", "international": "intl", "technologies": "tech", "company": "coy", "corporation": "corp", "research": "rsch res",
    "software": "sw", "standards": "stds std", "compiler": "comp", "toolchain": "", "data": "", "national": "natl", "school": "sch", "college": "coll", "consortium": "",
}


@functools.cache
def _full(words: tuple[tuple[str, str], ...]) -> dict[str, str]:
    return {a: w for w, s in words for a in s.split()}


_LEGAL = re.compile(r"[,\s]+(?:inc|llc|l\.l\.c|ltd|limited|gmbh|ag|corp|co|plc|llp|lp|s\.a|b\.v|bv|kg|oy|ab|se)\.?\s*$", re.I)
_SUFFIX = re.compile(r"[,\s]+(?:jr|sr|ii|iii|iv|ph\.?\s?d|m\.?d|msc|bsc|esq|mba)\.?\s*$", re.I)
_TITLE = re.compile(r"^(?:dr|prof|professor|mr|mrs|ms|miss|sir|dame|herr|frau|ing|mag)\.?\s+", re.I)
_ASIDE = re.compile(r"\([^()]*\)|<[^<>]*>|\[[^\[\]]*\]")
_LETTERS = str.maketrans({"đ": "d", "ł": "l", "ø": "o", "ß": "ss", "æ": "ae", "œ": "oe", "ð": "d", "þ": "th", "ı": "i"})
_DIGITS = str.maketrans("01345", "oleas")


def repaired(s: str) -> str:
    """UTF-8 that was read as a one-byte encoding, read again."""
    if any(c in s for c in "ÃÂÄÅÐÑâ"):
        for enc in ("latin-1", "cp1252"):
            try:
                return s.encode(enc).decode("utf-8")
            except UnicodeError:
                continue
    return s


def folded(s: str) -> str:
    """Lower case without accents; digits among letters as the letters they look like."""
    s = unicodedata.normalize("NFKD", s.lower().translate(_LETTERS))
    s = "".join(c for c in s if not unicodedata.combining(c))
    return re.sub(r"\w*[a-z]\w*", lambda m: m.group().translate(_DIGITS), s) if any(c.isdigit() for c in s) else s


def phonetic(s: str) -> str:
    """Classes of the consonants; vowels, doubled and mute letters fall away."""
    s = re.sub(r"ph", "f", re.sub(r"[^a-z]", "", s))
    code = s[:1]
    last = ""
    for c in s:
        k = next((d for d, cs in (("1", "bpfvw"), ("2", "cgjkqsxz"), ("3", "dt"), ("4", "l"), ("5", "mn"), ("6", "r")) if c in cs), "")
        if k and k != last:
            code += k
        last = k
    return code if len(code) == 1 else code[1:]


def edits(a: str, b: str) -> int:
    """Edit distance with transpositions, as far as 2."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > 1:
        return 2
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    j = 0
    while j < min(len(a), len(b)) - i and a[-1 - j] == b[-1 - j]:
        j += 1
    x, y = a[i : len(a) - j], b[i : len(b) - j]
    return 1 if max(len(x), len(y)) <= 1 or (len(x) == len(y) == 2 and x == y[::-1]) else 2


def jaro_winkler(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(len(a), len(b)) // 2 - 1
    taken = [False] * len(b)
    left = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                left.append(c)
                break
    right = [c for c, t in zip(b, taken) if t]
    m = len(left)
    if not m:
        return 0.0
    swaps = sum(x != y for x, y in zip(left, right)) / 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = next((k for k in range(min(4, len(a), len(b))) if a[k] != b[k]), min(4, len(a), len(b)))
    return jaro + prefix * 0.1 * (1 - jaro)


# ---------------------------------------------------------------- reading one value

COLUMNS = ("kind", "family", "given", "prefix", "middle", "nick", "ordered")
_NONE = ("other", "", "", "", "", "", True)


def read_name(value: str, words: dict[str, str] = ORGANISATION) -> tuple:
    """(kind, family, given, prefix, middle, nick, ordered); ordered: the family is certain.  words: words of organisations and their abbreviations."""
    s = _ASIDE.sub(" ", repaired(value))
    legal = bool(_LEGAL.search(s))
    while _LEGAL.search(s) and len(s.split()) > 2:
        s = _LEGAL.sub("", s)
    s = re.sub(r"\s+", " ", s).strip(" ,;")
    org = _organisation(s, legal, words)
    if org:
        return ("org", org[0], org[1], "", "", "", True)
    s = _TITLE.sub("", s)
    while _SUFFIX.search(s) and len(s.split()) > 2:
        s = _SUFFIX.sub("", s)
    nick = ""
    if m := re.search(r"[\"“'‘]([^\"”'’]+)[\"”'’]", s):
        nick = folded(m.group(1)).strip()
        s = (s[: m.start()] + " " + s[m.end() :]).strip()
    family, comma, rest = s.partition(",")
    if comma:
        words, fam = _words(rest), [w for w, _ in _words(family)]
    else:
        words = _words(s)
        full = [w for w, dot in words if len(w) > 1 and not dot]
        if not full:
            return _NONE
        fam = [full[-1]]
        at = max(i for i, (w, dot) in enumerate(words) if w == full[-1] and not dot)
        words = words[:at] + words[at + 1 :]
    if not fam:
        return _NONE
    given = next((w for w, dot in words[:1] if len(w) > 1 and not dot), "")
    prefix = words[0][0] if words and not given else ""
    middle = "".join(w[0] for w, _ in words[1:])
    certain = bool(comma) or not given or len(words) > 1
    return ("person", "-".join(fam), given, prefix, middle, nick, certain)


def _words(s: str) -> list[tuple[str, bool]]:
    """Folded words and whether a full stop shortens them."""
    out = []
    for w in re.findall(r"[^\s.,]+\.?", folded(s)):
        bare = re.sub(r"[^a-z'-]", "", w)
        if bare:
            out.append((bare, w.endswith(".")))
    return out


def _organisation(s: str, legal: bool, known_words: dict[str, str]) -> tuple[str, str] | None:
    full = _full(tuple(known_words.items()))
    words = [re.sub(r"[^a-z0-9+&]", "", w) for w in folded(s).split()]
    words = ["and" if w in ("&", "+") else w for w in words if w]
    if words[:1] == ["the"]:
        words = words[1:]
    if len(words) < 2:
        return None
    kinds = [full.get(w, w) for w in words[1:]]
    known = [w for w in kinds if w in known_words or (len(w) >= 5 and any(edits(w, o) == 1 for o in known_words))]
    if not known and not legal:
        return None
    fixed = [w if w in known_words or len(w) < 5 else next((o for o in known_words if edits(w, o) == 1), w) for w in kinds]
    return words[0], " ".join(fixed)


# ---------------------------------------------------------------- blocks and comparison


def given_names(given: str) -> list[str]:
    return [given, *NICKNAMES.get(given, "").split()]


def called(given: str, nick: str) -> set[str]:
    """What a person may be called."""
    return {g for g in (*given_names(given), nick) if g}


def block_keys(kind: str, family: str, given: str, nick: str) -> set[str]:
    """Phonetic codes of the sorted tokens: of the family, and of the given name with what one slip leaves of a family of five letters or more."""
    ends = (family[:3], family[-3:], family[:2] + family[-2:], "".join(sorted(family)))
    if kind == "org":
        return {f"o|{phonetic(family)}|{given}", *(f"o{k}|{e}|{given}" for k, e in enumerate(ends))}
    return {"p|" + phonetic(family), *(f"p{k}|{e}|{phonetic(g)}" for g in called(given, nick) for k, e in enumerate(ends))}


def shortened(family: str, given: str, nick: str) -> set[str]:
    """All names of a record, and each without one of its letters: accepted pairs share one of these."""
    names = {f"{family} {g}" for g in called(given, nick)}
    return names | {n[:i] + n[i + 1 :] for n in names for i in range(len(n))}


def much_rarer(m: int, n: int) -> bool:
    """Whether one of two spellings is so rare beside the other that it may be a slip."""
    return min(m, n) <= 1 or 2 * min(m, n) <= max(m, n)


def same_given(a: tuple, b: tuple) -> int:
    """0 equal or nickname, 1 a misspelling, 2 different; a, b: (given, nick, how many families have it)."""
    ga, gb = called(a[0], a[1]), called(b[0], b[1])
    if a[0] in gb or b[0] in ga or (a[1] and a[1] in gb) or (b[1] and b[1] in ga):
        return 0
    rare = much_rarer(a[2], b[2])
    return 1 if rare and any(min(len(x), len(y)) >= 4 and edits(x, y) == 1 for x in ga for y in gb) else 2


def accepted(a: dict, b: dict) -> bool:
    """Whether two records of one block mean the same."""
    fam = edits(a["family"], b["family"])
    if fam > 1 or (fam and (min(len(a["family"]), len(b["family"])) < 5 or not much_rarer(a["fam_n"], b["fam_n"]))):
        return False
    if a["kind"] == "org":
        return a["given"] == b["given"]
    if a["middle"] and b["middle"] and a["middle"][0] != b["middle"][0]:
        return False
    given = same_given((a["given"], a["nick"], a["given_n"]), (b["given"], b["nick"], b["given_n"]))
    if given + fam > 1:
        return False
    return given == 0 or jaro_winkler(f"{a['family']} {a['given']}", f"{b['family']} {b['given']}") >= SIMILAR


def compared(rows: list[dict]) -> Iterator[tuple[str, str]]:
    """Accepted pairs of a group."""
    for i, a in enumerate(rows):
        for b in rows[i + 1 :]:
            if accepted(a, b):
                yield a["rid"], b["rid"]


def variant_clusters(values: DataFrame, column: str = "value", words: dict[str, str] = ORGANISATION) -> DataFrame:
    """(value, entity) of every distinct value; entity is the least record key of its cluster.  words: as in read_name."""
    ship(values.sparkSession)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [(v, *read_name(v, words)) for v in b["value"]]
            yield pd.DataFrame(got, columns=["value", *COLUMNS])

    text = "value string, kind string, family string, given string, prefix string, middle string, nick string, ordered boolean"
    distinct = values.select(F.col(column).alias("value")).where(F.col("value").rlike(r"\S")).groupBy("value").agg(F.lit(1)).select("value")
    read_ = checkpointed(distinct.mapInPandas(read, text))
    people = read_.where("kind = 'person'")
    records = checkpointed(_oriented(people).unionByName(read_.where("kind <> 'person'").drop("ordered")).withColumn("rid", _record_key()))
    full = records.where("kind = 'org' or (kind = 'person' and given <> '')")
    keys = full.groupBy("rid", "kind", "family", "given").agg(F.max("middle").alias("middle"), F.max("nick").alias("nick"))
    fam_n = full.groupBy("kind", "family").agg(F.countDistinct("value").alias("fam_n"))
    given_n = keys.groupBy("kind", "given").agg(F.countDistinct("family").alias("given_n"))
    keys = checkpointed(keys.join(fam_n, ["kind", "family"]).join(given_n, ["kind", "given"]))
    pairs = checkpointed(_pairs(keys))
    first = connected_components(pairs)
    named = keys.join(first.withColumnRenamed("node", "rid"), "rid", "left").withColumn("entity", F.coalesce("component", "rid")).drop("component")
    short = _short_links(records, checkpointed(named))
    entity = named.select("rid", "entity").unionByName(short)
    return records.join(entity, "rid", "left").select("value", F.coalesce("entity", "rid").alias("entity"))


def _record_key() -> F.Column:
    person = F.concat_ws("|", F.lit("p"), "family", "given", "prefix", F.when(F.col("given") == "", F.col("middle")).otherwise(""))
    return F.when(F.col("kind") == "person", person).when(F.col("kind") == "org", F.concat_ws("|", F.lit("o"), "family", "given")).otherwise(F.concat(F.lit("x|"), F.col("value")))


def _oriented(people: DataFrame) -> DataFrame:
    """Family and given name changed places where their use elsewhere tells so; where it tells nothing, in the order of the alphabet."""
    votes = people.where("given <> ''").select(F.explode(F.array(F.struct(F.col("given").alias("token"), F.lit(1).alias("g")), F.struct(F.col("family").alias("token"), F.lit(0).alias("g")))).alias("v"))
    sure = people.where("given = ''").select(F.struct(F.col("family").alias("token"), F.lit(0).alias("g")).alias("v"))
    score = votes.unionByName(sure).groupBy("v.token").agg(F.avg("v.g").alias("score"))
    a, b = score.select(F.col("token").alias("given"), F.col("score").alias("sg")), score.select(F.col("token").alias("family"), F.col("score").alias("sf"))
    sg, sf = F.coalesce("sg", F.lit(1.0)), F.coalesce("sf", F.lit(0.0))
    swap = ~F.col("ordered") & (((sg < 0.5) & (sf > 0.5)) | ((sg == sf) & (F.col("given") > F.col("family"))))
    out = people.join(a, "given", "left").join(b, "family", "left").withColumn("swap", swap)
    return out.select(
        "value", "kind", F.when(F.col("swap"), F.col("given")).otherwise(F.col("family")).alias("family"),
        F.when(F.col("swap"), F.col("family")).otherwise(F.col("given")).alias("given"), "prefix", "middle", "nick",
    )


_RECORD = ["rid", "kind", "family", "given", "middle", "nick", "fam_n", "given_n"]


def _pairs(keys: DataFrame) -> DataFrame:
    record = "rid string, kind string, family string, given string, middle string, nick string, fam_n long, given_n long"
    names = ["block", *_RECORD]

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(k, *r) for r in b.itertuples(index=False) for k in block_keys(r.kind, r.family, r.given, r.nick)], columns=names)

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(f"{r.block}|{s}", *r[1:]) for r in b.itertuples(index=False) for s in shortened(r.family, r.given, r.nick)], columns=names)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_: list[dict] = []
        for b in batches:
            got = []
            for r in b.to_dict("records"):
                if open_ and open_[0]["block"] != r["block"]:
                    got += compared(open_)
                    open_ = []
                open_.append(r)
            yield pd.DataFrame(got, columns=["src", "dst"])
        yield pd.DataFrame(list(compared(open_)), columns=["src", "dst"])

    schema = f"block string, {record}"
    blocked = checkpointed(keys.select(*_RECORD).mapInPandas(blocks, schema))
    large = checkpointed(blocked.groupBy("block").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK).select("block"))
    if not large.isEmpty():
        side, _ = broadcast_if_small(large)
        blocked = blocked.join(side, "block", "left_anti").unionByName(blocked.join(side, "block", "left_semi").mapInPandas(parts, schema))
    return blocked.repartition("block").sortWithinPartitions("block", "rid").mapInPandas(compare, "src string, dst string")


def _short_links(records: DataFrame, named: DataFrame) -> DataFrame:
    """(rid, entity) of initials and abbreviations: the one cluster they can mean, else the least among themselves."""
    short = records.where("kind = 'person' and given = '' and prefix <> ''").groupBy("rid", "family", "prefix", "middle").agg(F.lit(1)).drop("1")
    short = checkpointed(short.withColumn("letter", F.substring("prefix", 1, 1)))
    nick = F.create_map(*[F.lit(x) for k, v in NICKNAMES.items() for x in (k, v)])
    names = F.array_distinct(F.concat(F.array("given"), F.coalesce(F.split(nick[F.col("given")], " "), F.array().cast("array<string>"))))
    known = named.where("kind = 'person'").select("family", "entity", F.explode(names).alias("name")).distinct().withColumn("letter", F.substring("name", 1, 1))
    middles = named.where("kind = 'person' and middle <> ''").groupBy("entity").agg(F.collect_set(F.substring("middle", 1, 1)).alias("middles"))
    fits = short.join(known.join(middles, "entity", "left"), ["family", "letter"]).where(F.col("name").startswith(F.col("prefix")))
    fits = checkpointed(fits.where("middle = '' or middles is null or array_contains(middles, substring(middle, 1, 1))"))
    exact = F.coalesce(F.expr("middle <> '' and array_contains(middles, substring(middle, 1, 1))"), F.lit(False))
    cand = fits.groupBy("rid").agg(
        F.countDistinct("entity").alias("n"), F.min("entity").alias("one"), F.countDistinct(F.when(exact, F.col("entity"))).alias("n_exact"), F.min(F.when(exact, F.col("entity"))).alias("one_exact")
    )
    to_cluster = cand.where("n_exact = 1 or n = 1").select("rid", F.when(F.col("n_exact") == 1, F.col("one_exact")).otherwise(F.col("one")).alias("entity"))
    alone = short.where("length(prefix) = 1").join(cand.select("rid"), "rid", "left_anti")
    by = alone.groupBy("family", "prefix").agg(F.min("rid").alias("entity"), F.countDistinct(F.when(F.col("middle") != "", F.substring("middle", 1, 1))).alias("m"))
    among = alone.join(by.where("m <= 1"), ["family", "prefix"]).select("rid", "entity")
    return to_cluster.unionByName(among)


def variant_links(values: DataFrame, column: str = "value") -> DataFrame:
    """(value, entity, links) of every distinct value, with the number of other values of its entity: what to use where clusters are large."""
    c = checkpointed(variant_clusters(values, column))
    return lookup_join(c, checkpointed(c.groupBy("entity").agg((F.count("*") - 1).alias("links"))), ["entity"]).select("value", "entity", "links")


def variant_pairs(values: DataFrame, column: str = "value") -> DataFrame:
    """(name_a, name_b) of all different values of one entity, name_a before name_b by code point."""
    c = checkpointed(variant_clusters(values, column))
    a, b = c.select("entity", F.col("value").alias("name_a")), c.select("entity", F.col("value").alias("name_b"))
    return a.join(b, "entity").where("name_a < name_b").select("name_a", "name_b")
