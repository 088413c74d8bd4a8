import random
import re
import unicodedata

import numpy as np
import pytest

from quillspark.llm import leakage as k

D = "doc_id long, text string, item_id string"
I = "item_id long, text string, task string"  # noqa: E741


def brute(doc, item, window, share):
    words = lambda t: re.findall(r"\w+", unicodedata.normalize("NFKC", t or "").lower())
    d, i = words(doc), words(item)
    grams = {tuple(d[j : j + window]) for j in range(len(d) - window + 1)}
    hit = {j + m for j in range(len(i) - window + 1) if tuple(i[j : j + window]) in grams for m in range(window)}
    return len(hit) if hit and len(hit) >= share * len(i) else 0


def test_same_as_brute_force(spark):
    r = random.Random(3)
    vocab = [f"w{n}" for n in range(12)] + ["straße", "été", "ﬁle"]
    text = lambda n: " ".join(r.choice(vocab) + r.choice(["", ",", ".", "\n"]) for _ in range(n))
    items = [(n, text(r.randrange(3, 40)), "") for n in range(25)]
    docs = []
    for n in range(120):
        t = text(r.randrange(0, 60))
        if n % 2:
            w = items[r.randrange(25)][1].split()
            a = r.randrange(len(w))
            t += " " + " ".join(w[a : a + r.randrange(1, 40)]).upper() + " " + text(5)
        docs.append((n, t, ""))
    docs += [(500, None, ""), (501, "", ""), (502, docs[1][1], "")]
    got = {(x.doc_id, x.item_id): x.matched_words for x in k.find_leaks(spark.createDataFrame(docs, D), spark.createDataFrame([*items, (99, None, ""), (98, "", "")], I), window=4).collect()}
    want = {(d, i): n for d, t, _ in docs for i, s, _ in items if (n := brute(t, s, 4, 1 / 3))}
    assert got == want and len(want) > 20


def test_blocks_of_items(spark, monkeypatch):
    items = spark.createDataFrame([(n, f"one two three four five six seven eight nine ten number{n} end", "") for n in range(6)], I)
    docs = spark.createDataFrame([(1, "zero one two three four five six seven eight nine ten eleven", "")], D)
    whole = {tuple(r) for r in k.find_leaks(docs, items).collect()}
    monkeypatch.setattr(k, "BLOCK_WINDOWS", 20)
    assert {tuple(r) for r in k.find_leaks(docs, items).collect()} == whole and len(whole) == 6
    assert {tuple(r) for r in k.find_leaks(docs, items, pass_bytes=200).collect()} == whole
    assert k.find_leaks(docs, items.limit(0)).count() == 0 and k.find_leaks(docs.limit(0), items).count() == 0


ITEM = "Users who move the file today have to annotate three concepts and then preserve it by hand. It is typical of snake_case names."
VARIANTS = [
    ITEM.upper(), ITEM.replace(" ", "\n> "), ITEM.replace("file", "ﬁle").replace(" ", "\u00a0"), ITEM.replace("three", "**three**").replace("then", "_then_").replace("hand", "<em>hand</em>"),
    "\n".join(f"{n}  {' '.join(w)}" for n, w in enumerate(zip(*[iter(ITEM.split() + ['end'] * 2)] * 4), 1)), "<p>" + ITEM.replace("and", "<b>and</b>"), ITEM.replace("concepts", "con\u00adcepts"),
]


@pytest.mark.parametrize("text", VARIANTS)
def test_marks_and_variants(text):
    index = k.ItemIndex([1], [ITEM], k.make_walk(10))
    words, of = k.word_hashes([k.unnumbered(k.plain("Before it. " + text + " After."))])
    start = k.window_starts(of, 10)
    a, b, same = index.verified(words, *index.candidates(k.walk_signatures(words, start, index.walk), start), 0)
    got = index.coverage(of[a], b)
    assert same.all() and got[0, 0] >= index.length[0] / 3


def test_template_arguments_stay_words():
    words = lambda t: len(k.word_hashes([k.plain(t)])[0])
    assert words("cursor<b> and gadget<T>") == 5 and words("an <b>old</b> word") == 3


@pytest.mark.parametrize("edits", [1, 2])
def test_edits_reach_the_target_recall(edits):
    one, two = k.edited_windows(np.random.default_rng(5), 3000, 10, edits)
    walk = k.make_walk(10, edits=edits, recall=0.95)
    start = np.arange(len(one)) * one.shape[1]
    same = np.zeros(len(start), bool)
    for x, y in zip(k.walk_signatures(one.ravel(), start, walk), k.walk_signatures(two.ravel(), start, walk)):
        same |= x == y
    assert len(walk.repetitions) > 1 and same.mean() >= 0.9
    assert len(k.make_walk(10, edits=4, recall=0.97).repetitions) > 20  # no bound on the repetitions


def test_prefix_distances():
    def slow(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
            row = new
        return min(row)

    g = np.random.default_rng(1)
    a, b = g.integers(0, 4, (200, 10)), g.integers(0, 4, (200, 11))
    assert k.prefix_distances(a, b).tolist() == [slow(x, y) for x, y in zip(a.tolist(), b.tolist())]


@pytest.mark.parametrize("edits", [0, 1, 2])
def test_no_window_within_reach_is_passed_over(edits):
    one, two = k.edited_windows(np.random.default_rng(9), 500, 10, edits)
    near = k.prefix_distances(one[:, :10], two) <= edits
    assert near.all()
    start = np.arange(500) * two.shape[1]
    pairs = np.zeros(1 << 22, bool)
    for row in one:
        pairs[k.neighbours(row[:10], 22)] = True
    assert len(k.promising(two.ravel(), start, 10, edits, pairs)) == 500


@pytest.mark.parametrize("step", [12, 8])
def test_planted_passages_with_edits(spark, step):
    """Passages of real words with a substitution, an insertion or a deletion every few words: at least 0.9 of them are found, with every eighth word changed by near windows alone."""
    r = random.Random(11)
    vocab = [f"{a}{b}{c}" for a in ("ta", "mo", "le", "ri") for b in ("ver", "din", "sol", "par") for c in ("ed", "ing", "s", "ly", "")]
    items = [(n, " ".join(r.choice(vocab) for _ in range(48)), "") for n in range(150)]
    docs, planted = [], set()
    for n in range(150):
        words = items[n][1].split()
        for at in range(48 - step, 0, -step):
            kind = r.randrange(3)
            words[at : at + (kind != 1)] = [] if kind == 0 else [r.choice(vocab) + "x"]
        docs.append((n, " ".join([r.choice(vocab) for _ in range(30)] + words + [r.choice(vocab) for _ in range(30)]), ""))
        planted.add((n, n))
    got = {(x.doc_id, x.item_id): x for x in k.find_leaks(spark.createDataFrame(docs, D), spark.createDataFrame(items, I), share=0.9, edits=1).collect()}
    assert len(planted & got.keys()) >= 0.9 * len(planted) and set(got) <= planted
    assert all(x.matched_words <= x.near_words <= x.item_words for x in got.values())
    assert sum(x.matched_words for x in got.values()) == 0 if step == 8 else any(x.matched_words < x.near_words for x in got.values())
