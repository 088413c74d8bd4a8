import random

import pytest

from quillspark.llm import name_variants as n

PEOPLE = {
    "one": ["Nathaniel Barhomidish", "Dr. Nathaniel Barhomidish", "NATHANIEL BARHOMIDISH", "Barhomidish, Nathaniel", "Barhomidish Nathaniel", "N. Barhomidish", "Barhomidish, N. D.", "N.D. Barhomidish", "Nathaniel D. Barhomidish", "Nat Barhomidish", 'Nathaniel "Nat" Barhomidish', "Nath. Barhomidish", "Nathaniel Barhomidish (independent)", "Nathaniel Barhomidish <n@mail.example>", "Nathatniel Barhomidish", "Nathaniel Barhomiadish", "Nathaniel  Barhomidish", "Nathaniel Barh0midish", "Nathaniel Barhomidish, III"],
    "two": ["Đorđe Litgikiromb", "Dorde Litgikiromb", "Ä\x90orÄ\x91e Litgikiromb", "Litgikiromb, Đ."],
    "three": ["Winifred Curdategess", "Freda Curdategess", "W. Curdategess"],
    "four": ["Yusuf Barhomidish"],
    "five": ["Putka Research Institute", "Putka Rsch. Inst.", "The Putka Research Institute", "Putka Research Institute, GmbH", "PUTKA RESEARCH INSTITUTE"],
    "six": ["Putka Systems", "Putka Sys. Inc."],
    "seven": ["Nuska and Partners", "Nuska & Partners", "Nuska + Partners Ltd"],
    "ten": ["Farid Calgifahind", "Calgifahind Farid"],
    "eight": ["Nathaniel Folrazozuck"], "nine": ["Nathaniel Ralku"],
}


def test_clusters(spark):
    rows = [(v, e, "x") for e, vs in PEOPLE.items() for v in vs] + [("Nathaniel Barhomidish", "again", None), (None, "", ""), (" ", "", ""), ("…", "", "")]
    df = spark.createDataFrame(rows, "value string, entity string, rid string")
    got = {r.value: r.entity for r in n.variant_clusters(df).collect()}
    for e, vs in PEOPLE.items():
        assert len({got[v] for v in vs}) == 1, (e, {v: got[v] for v in vs})
    assert len({got[vs[0]] for vs in PEOPLE.values()}) == len(PEOPLE) and "…" in got
    pairs = {tuple(r) for r in n.variant_pairs(df).collect()}
    assert all(a < b for a, b in pairs) and ("Nat Barhomidish", "Nathaniel Barhomidish") in pairs
    assert n.variant_pairs(df.limit(0)).count() == 0
    links = {r.value: r.links for r in n.variant_links(df).collect()}
    assert all(links[v] == len(vs) - 1 for vs in PEOPLE.values() for v in vs) and links["…"] == 0
    assert n.read_name("Putka Guild")[0] == "person" and n.read_name("Putka Gld.", {"guild": "gld"})[:3] == ("org", "putka", "guild")


def test_ambiguous_initials_stay_alone(spark):
    df = spark.createDataFrame([(v,) for v in ["Theodore Dandu", "Tariq Dandu", "T. Dandu", "Theodore J. Dandu", "T.J. Dandu"]], "value string")
    got = {r.value: r.entity for r in n.variant_clusters(df).collect()}
    assert got["T. Dandu"] not in (got["Theodore Dandu"], got["Tariq Dandu"]) and got["T.J. Dandu"] == got["Theodore Dandu"]


def random_names(seed):
    """Spellings with slips, swaps, nicknames typed and meant, and organisations."""
    r = random.Random(seed)
    given = ["robert", "bob", "william", "bill", "xavier", "katherine", "kate", "nathaniel"]
    family = ["smith", "barhomidish", "barhomidash", "smithe", "parker", "jensen"]
    slip = lambda w: w[: (i := r.randrange(len(w)))] + r.choice(["", "q", w[i] * 2, w[i + 1 : i + 2] + w[i]]) + w[i + 1 :]
    out = []
    for _ in range(400):
        g, f = r.choice(given), r.choice(family)
        g, f = (slip(g), f) if r.random() < 0.3 else (g, slip(f)) if r.random() < 0.3 else (g, f)
        nick = r.choice(["", "", "bo", "zed", "bill"])
        out.append(r.choice([f"{g} {f}", f"{f}, {g}", f'{g} "{nick}" {f}' if nick else g + " " + f, f"{nick or g} {f}", f"{slip(f)} {r.choice(['Systems', 'Research Institute', 'Sys. Inc.'])}"]).title())
    return sorted(set(out))


@pytest.mark.parametrize("seed", [1, 2])
def test_any_block_size_gives_the_same_pairs(spark, monkeypatch, seed):
    df = spark.createDataFrame([(v,) for v in [*random_names(seed), 'Xavier "Zed" Smith', "Zed Smith"]], "value string")
    got = []
    for block in (100_000, 20, 1):
        monkeypatch.setattr(n, "BLOCK", block)
        got.append({tuple(r) for r in n.variant_pairs(df).collect()})
    assert got[0] == got[1] == got[2] and len(got[0]) > 100 and ('Xavier "Zed" Smith', "Zed Smith") in got[0]


def test_accepted_pairs_share_a_shortened_name():
    rows = [{"rid": v, **dict(zip(n.COLUMNS, n.read_name(v))), "fam_n": 1, "given_n": 1} for v in random_names(3)]
    rows = [r for r in rows if r["kind"] != "other"]
    pairs = list(n.compared(rows))
    by = {r["rid"]: n.shortened(r["family"], r["given"], r["nick"]) for r in rows}
    assert len(pairs) > 100 and all(by[a] & by[b] for a, b in pairs)


@pytest.mark.parametrize("family", ["parker", "jensen", "lopez", "barhomidish"])
def test_a_slip_leaves_a_shared_block(family):
    for k in range(len(family)):
        for other in (family[:k] + family[k + 1 :], family[:k] + "q" + family[k + 1 :], family[:k] + "q" + family[k:], family[:k] + family[k + 1 : k + 2] + family[k] + family[k + 2 :]):
            assert len(other) < 5 or n.block_keys("person", family, "anna", "") & n.block_keys("person", other, "anna", ""), other


def test_measures():
    assert n.edits("abc", "acb") == 1 and n.edits("abc", "abcd") == 1 and n.edits("abc", "axyc") == 2 and n.edits("abcd", "abcd") == 0
    assert round(n.jaro_winkler("martha", "marhta"), 3) == 0.961 and n.jaro_winkler("", "a") == 0 and n.phonetic("robert") == n.phonetic("rupert")
