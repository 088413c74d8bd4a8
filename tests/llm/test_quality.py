import random
import textwrap

import numpy as np

from quillspark.llm import gbt, quality
from quillspark.llm.line_stats import FEATURES, MEASURES, common_hashes, text_features

COMMON = "the a of to and in is it that was for we on not be by with as at this all have had no but from so or an would could should them then out last nobody if what i do its us any one der die das ist und nicht dass wir so es le la les une des est pas n'a cette plus pour".split()
D = "doc_id long, text string, kind string, blank boolean"


def corpus(seed, n):
    """Documents of every kind, none of them a checked one; most are prose."""
    r = random.Random(seed)
    nouns = [a + b for a in ("gar", "mel", "tor", "vin", "dra", "pol", "sek") for b in ("den", "ton", "ling", "ber", "mont", "ris")]
    word = lambda: r.choice(nouns)
    forms = ["we would not have {0} it as the {1} of the {2} was for all", "it is the {0} that should be at the {1} but nobody had {2} it", "if the {0} is in a {1} then what do we {2} from it", "das {0} ist nicht der {1} und wir {2} es so", "la {0} est une {1} pour les {2} des"]
    sentence = lambda: r.choice(forms).format(word(), word(), word()).capitalize() + "."
    wrap = lambda t, w: "\n".join(textwrap.wrap(t, w))
    prose = lambda: r.choice([str, str.lower, lambda t: wrap(t, r.choice([30, 40, 70])), lambda t: t.replace(". ", ".\n\n"), lambda t: t.replace(". ", ".\n- ")])(" ".join(sentence() for _ in range(r.randrange(1, 12))))
    lines = lambda f, lo=5, hi=25: "\n".join(f(k) for k in range(1, r.randrange(lo, hi)))
    entry = lambda: " ".join(word() for _ in range(r.randrange(1, 5)))
    lists = [lambda: lines(lambda k: f"- {entry()}"), lambda: lines(lambda k: f"{k}. {entry()}"), lambda: lines(lambda k: entry().capitalize()), lambda: lines(lambda k: f"{word()}, {k}, {k * 7}"), lambda: "; ".join(entry() for _ in range(20)), lambda: lines(lambda k: f"[{r.choice(' x')}] {entry()}")]
    cells = lambda k: [f"P{k}", str(k * 3), str(r.randrange(90)), word()]
    tables = [lambda: lines(lambda k: "| " + " | ".join(cells(k)) + " |"), lambda: lines(lambda k: ",".join(cells(k))), lambda: lines(lambda k: "\t".join(cells(k))), lambda: lines(lambda k: "".join(c.ljust(12) for c in cells(k))), lambda: "<table>\n" + lines(lambda k: "<tr><td>" + "</td><td>".join(cells(k)) + "</td></tr>") + "\n</table>"]
    letters = lambda n, al="abcdefghijklmnopqrstuvwxyz": "".join(r.choice(al) for _ in range(n))
    scramble = lambda t: "".join(r.choice("~!|;0") if r.random() < 0.12 and c.isalpha() else c for c in t)
    junk = [
        lambda: " ".join(letters(r.randrange(2, 9)) for _ in range(60)), lambda: " ".join(word() for _ in range(60)), lambda: (sentence() + "\n") * 15, lambda: (sentence()[:20] + " ") * 30, lambda: letters(400, "abcXYZ0123456789"),
        lambda: lines(lambda k: f"{k * 16:08x}  " + " ".join(f"{r.randrange(256):02x}" for _ in range(16))), lambda: "".join(f".{letters(2)}{{top:{k}px;c:#{k:06x}}}" for k in range(30)), lambda: letters(300, "#$%^&*;:<>{}[]|~\\ 0123456789"), lambda: scramble(" ".join(sentence() for _ in range(8))), lambda: "".join(sentence() for _ in range(6)).replace(" ", ""), lambda: "Home | About | Help\n" * 20,
    ]
    kinds = {"list": lists, "table": tables, "junk": junk}
    for k in range(n):
        kind = r.choice(["prose"] * 6 + [*kinds])
        yield k, prose() if kind == "prose" else r.choice(["", "", sentence() + "\n\n"]) + r.choice(kinds[kind])(), kind


def test_kinds_of_unseen_texts(spark):
    rows = [(k, t, kind, None) for k, t, kind in corpus(1, 1500)]
    far = [(10_000 + k, t, kind, None) for k, (t, kind) in enumerate(quality.SCORED)]
    docs = spark.createDataFrame([*rows, *far, (-1, None, "", None), (-2, "", "", None), (-3, " \n\t", "", None), (-4, "word " * 200_000, "", None)], D)
    stats = quality.document_stats(docs, COMMON).cache()
    # the checked texts take no part in the training
    model = quality.train_kinds(stats.where("doc_id < 10000"), COMMON, sample=800)
    got = {r.doc_id: r.kind for r in quality.classify(stats, model).collect()}
    assert not {-1, -2, -3} & set(got) and got[-4] == "junk"
    wrong = [(k, got[k], kind, t[:60]) for k, t, kind, _ in rows if got[k] != kind]
    assert len(wrong) <= 0.03 * len(rows), wrong
    wrong = [(k, got[k], kind, t[:60]) for k, t, kind, _ in far if got[k] != kind]
    assert len(wrong) <= 4, wrong
    assert not {"plain_share", "list_share", "table_share", "junk_share"} & set(MEASURES)


def test_no_documents(spark):
    docs = spark.createDataFrame([], D)
    assert quality.document_kinds(docs, COMMON).count() == 0


def test_thresholds_change_decisions():
    m = gbt.Model(("a", "b", "c"), np.zeros(3), thresholds=np.array([0.0, 0.7, 0.4]))
    assert m.decided(np.array([[0.3, 0.6, 0.1], [0.1, 0.45, 0.45], [0.1, 0.8, 0.1], [0.5, 0.1, 0.4]])).tolist() == [0, 2, 1, 2]
    assert gbt.prior_shift(np.array([8, 1, 1]))[0] > 0 > gbt.prior_shift(np.array([8, 1, 1]))[1]


def test_statistics():
    x = dict(zip(FEATURES, text_features(["One two three.\nFour!", ""], common_hashes(["two"]))[0]))
    assert x["words"] == 4 and x["lines"] == 2 and abs(x["common_ratio"] - 0.25) < 1e-9 and x["end_mark_ratio"] == 1 and abs(x["mean_word"] - 15 / 4) < 1e-9
    batch = ["a\tb\tc\n1\t2\t3", "- x\n- y\n- z", "plain words of a text, and more of it."]
    whole = text_features(batch, common_hashes(COMMON))
    for k, t in enumerate(batch):
        assert np.allclose(whole[k], text_features([t], common_hashes(COMMON))[0])


def test_one_phrase_over_and_over():
    at = lambda t, f: dict(zip(FEATURES, text_features([t], common_hashes(COMMON))[0]))[f]
    phrase = "We believe that trivial relocation of the "
    assert len(set(phrase.split())) == 7 and at(phrase * 60, "repeat_share") > 0.9 and at(phrase * 60, "junk_share") > 0.9
    wrapped = "\n".join(" ".join((phrase * 60).split()[i : i + 11]) for i in range(0, 420, 11))
    assert at(wrapped, "junk_share") > 0.9
    assert at(phrase * 2, "repeat_share") == 0 and at(quality._PROSE, "repeat_share") == 0
    # entries that share words are a list, and prose with a recurring phrase is prose
    assert at("\n".join(f"* item number {i} of the box" for i in range(12)), "list_share") == 1
    assert at("".join(f"We believe that trivial relocation {w} could be what {w}s of the {w} house had asked for. " for w in "abcdefghij"), "junk_share") == 0


def test_trees_learn_a_majority():
    r = np.random.default_rng(0)
    x = r.random((800, 5))
    y = (x[:, 2] + 0.1 * x[:, 0] > 0.55).astype(int)
    m = gbt.train(x[:600], y[:600], ("a", "b"))
    assert (m.probabilities(x[600:]).argmax(1) == y[600:]).mean() > 0.93
    gbt.calibrate(m, x[600:], y[600:])
    assert 0.2 < m.temperature < 8.1
    assert gbt.train(x[:0], y[:0], ("a", "b")).probabilities(x[:3]).tolist() == [[0.5, 0.5]] * 3
