"""Per-document text statistics and the kind of text they tell: prose, list, table or junk.

Statistics come from `line_stats` over whole texts.  Gradient-boosted trees are
trained on the statistics of a bounded sample (`SAMPLE` rows, drawn by hash) that are weakly labelled
by rules for lines (the share of characters in plain, list, table and unreadable
ones).  The trees don't see those shares, only measures of the document
(`MEASURES`), so that they can't repeat a rule and are free to disagree with a
wrong label.  As the sample holds the kinds in equal shares, the scores are moved by the kinds'
shares in all labelled rows; temperature and a threshold for each kind are then
set on one hand-checked holdout (`HOLDOUT`), and another (`SCORED`) is only for
tests.

Defined results
  null, empty or blank text    statistics 0 (null stays null), no kind
  repeated texts               a row for each id
  too small a sample           the trees know the classes they saw; with an empty one all are equal and the text counts as prose
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm import gbt
from quillspark.llm.line_stats import FEATURES, MEASURES, common_hashes, text_features
from quillspark.session import checkpointed, ship

KINDS = ("prose", "list", "table", "junk")
#: Rows of the weakly labelled training sample, at most.
SAMPLE = 4000
#: A weak label needs this share of the characters.
SURE = 0.6

_SHARES = {"prose": "plain_share", "list": "list_share", "table": "table_share", "junk": "junk_share"}

# Checked by hand: short texts of each kind.
_PROSE = "We tried the new allocator for a week. It did what we had hoped, and nobody asked for the old one again.\n\nThe cost was small, because most of the code had been written with care."
HOLDOUT = (
    (_PROSE, "prose"),
    ("The committee met in the morning and\nagreed that the wording should be changed\nbefore the end of the week, since the\neditor could not wait any longer.", "prose"),
    ("AB: I do not think that we should ship this.\nCD: It was agreed last year, and nothing has changed since.\nAB: Then let us at least write down why.", "prose"),
    ("Wir haben das gestern besprochen, und es war allen klar, dass die Regel so nicht bleiben kann. Der Entwurf wird geändert.", "prose"),
    ("Le groupe a demandé si la règle pouvait être plus simple, et personne n'a encore répondu à cette question.", "prose"),
    ("IT IS NOT POSSIBLE TO SAY WHAT THE RESULT OF THIS WILL BE, BUT WE SHOULD TRY IT AND THEN DECIDE WHAT TO DO.", "prose"),
    ("the paper was read by all of us and we could not find anything wrong with it so we sent it on to the next group", "prose"),
    (_PROSE + "\n\n- red\n- green\n- blue", "prose"),
    ("- milk and bread\n- two lemons\n- olive oil\n- tea\n- paper bags\n- candles", "list"),
    ("1. Introduction\n2. Motivation\n3. Design\n4. Wording\n5. Acknowledgements\n6. References", "list"),
    ("Narrow contracts\nWide contracts\nNames of members\nOpen questions\nFuture work\nHistory of drafts", "list"),
    ("[x] wording\n[ ] tests\n[x] feature macro\n[ ] examples\n[ ] poll", "list"),
    ("allocator, 12, 56\nbuffer, 77, 103\ncontract, 9\ndeclaration, 14, 15, 90\nexception, 6", "list"),
    ("small boxes; blue paper; short pencils; long rulers; spare ink; thin cards; red string; steel pins; cork boards; old maps", "list"),
    ("We need these for the meeting.\n\n" + "\n".join(f"* item number {i} of the box" for i in range(12)), "list"),
    ("| Name | Votes |\n|---|---|\n| P1 | 12 |\n| P2 | 7 |\n| P3 | 9 |", "table"),
    ("Name\tFor\tAgainst\nP1\t12\t3\nP2\t7\t8\nP3\t9\t1", "table"),
    ("name,for,against,result\nP1,12,3,yes\nP2,7,8,no\nP3,9,1,yes\nP4,2,2,no", "table"),
    ("Name      For     Against\nP1        12      3\nP2        7       8\nP3        9       1", "table"),
    ("<table>\n<tr><td>P1</td><td>12</td></tr>\n<tr><td>P2</td><td>7</td></tr>\n<tr><td>P3</td><td>9</td></tr>\n</table>", "table"),
    ("\\begin{tabular}{lr}\nP1 & 12 & 3 \\\\\nP2 & 7 & 8 \\\\\nP3 & 9 & 1 \\\\\n\\end{tabular}", "table"),
    ("The votes were counted twice.\n" + "\n".join(f"| P{i} | {i * 3} | {i * 7} |" for i in range(20)), "table"),
    ("kX9fQ2LmZt7Bv0RnWq8YpJ4sHd3Gc6Ae1UoTi5xNzKbVfMwE\nPq8ZrT3yLk0WmXc7VbN5sJd2HfGa9QeUiOp4RtYxCzKvBnMwL6", "junk"),
    ("00000000  4d 5a 90 00 03 00 00 00 04 00 00 00 ff ff 00 00\n00000010  b8 00 00 00 00 00 00 00 40 00 00 00 00 00 00 00", "junk"),
    ("#4%&;{2[}]<~^3=+*|\\8@!$;:>?_-/(9{%&$#@!~^*+=|<>;2[4]{6}\n%^&*|{}<>~;:=+#@!$_\\/?4[6]8{%}&^*|~<>2=+#@!$;:5", "junk"),
    (".a{top:1px;left:2px}.b{width:3px;color:#fff}.c{top:4px;bg:#123456}d{left:5px;c:#abcdef}", "junk"),
    ("Ã¤Ã¶Ã¼ÃŸâ€œâ€¦Ã©Ã¨Ã¸Ã±Ã¤Ã¶Ã¼ÃŸâ€œâ€¦Ã©Ã¨Ã¸Ã±Ã¤Ã¶Ã¼ÃŸâ€œâ€¦Ã©Ã¨", "junk"),
    ("table window green pencil cloud river stone paper engine garden bottle winter market silver button forest mirror candle basket ladder copper velvet marble", "junk"),
    ("Home | About | Search | Log in\n" * 12, "junk"),
    ("This sentence is all that there is to read.\n" * 15, "junk"),
    ("Wkj tri|d th0 ne! allo;ator fo~ a w!ek a0d it d;d wha| we h~d hop!d an; nob0dy as~ed f|r th! old o;e ag0in bec~use m!st of th| c;de h0d be~n wri!ten w|th ca;e", "junk"),
    ("zqk wobbu jefal mi pud xoq rilke zan bof wexi doqq uvam teb kilj sopra xu mivel hurgo daq pelnu wix ofor jub lemma tzik qo ruv nesti", "junk"),
    ("The old allocator could not be\nreplaced before the end of the\nmeeting, and nobody minded.", "prose"),
    ("Wetriedthenewallocatorforaweekanditdidwhatwehadhopedandnobodyaskedfortheoldoneagainbecausemostofthecodehadbeenwrittenwithcare", "junk"),
)


# Checked by hand as well, and used for nothing but to measure what the trees get right.
SCORED = (
    ("Nobody had expected that the second draft would be shorter than the first one, but it was, and it was better too.", "prose"),
    ("> Could we wait for another meeting?\n\nNo, I think that we have waited for long enough.\n\n> Then let us vote.", "prose"),
    ("Es bleibt die Frage, ob wir das so lassen können. Ich würde lieber noch einmal darüber sprechen, bevor etwas entschieden wird.", "prose"),
    ("Nous avons lu le document pendant la nuit, et il nous semble que tout y est, sauf la raison pour laquelle on en a besoin.", "prose"),
    ("It took a day to find the fault and\nan hour to remove it, which is what\nmost of us had thought it would be\nwhen we saw the first report.", "prose"),
    ("## Result\n\nThe test passed on every machine that we have.\n\n| a | b |\n|---|---|\n| 1 | 2 |\n\nThere is no reason to run it again, and we did not.", "prose"),
    ("- The first point was that nobody reads the notes, so they should be shorter.\n- The second was that they should be sent out on the same day as the meeting.", "prose"),
    ("* apples\n* pears\n* a bag of flour\n* salt\n* brown sugar\n* yeast\n* soap", "list"),
    ("1. Scope\n2. Terms\n3. Overview\n4. Changes to clause nine\n5. Bibliography", "list"),
    ("barrier, 3, 19\ncache, 44\nfence, 8, 91, 120\nlatch, 77\nmutex, 12, 13\nqueue, 61", "list"),
    ("green door; white wall; small window; round table; old chair; wooden floor; iron stove; glass lamp; woollen rug", "list"),
    ("[ ] open the hall\n[x] print the agenda\n[x] order lunch\n[ ] send the minutes", "list"),
    ("| Year | Members | Guests |\n|---|---|---|\n| 2019 | 84 | 12 |\n| 2020 | 91 | 0 |\n| 2021 | 97 | 3 |", "table"),
    ("year,members,guests\n2019,84,12\n2020,91,0\n2021,97,3\n2022,99,8", "table"),
    ("Year\tMembers\tGuests\n2019\t84\t12\n2020\t91\t0\n2021\t97\t3", "table"),
    ("Year    Members    Guests\n2019    84         12\n2020    91         0\n2021    97         3", "table"),
    ("<table><tr><td>2019</td><td>84</td></tr>\n<tr><td>2020</td><td>91</td></tr>\n<tr><td>2021</td><td>97</td></tr></table>", "table"),
    ("00001a40  7f 45 4c 46 02 01 01 00 00 00 00 00 00 00 00 00\n00001a50  03 00 3e 00 01 00 00 00 40 10 00 00 00 00 00 00", "junk"),
    ("#main{top:0px;left:3px}#side{width:40px;color:#eee}p{margin:1px;bg:#012345}h1{left:9px;c:#fedcba}", "junk"),
    ("R0lGODlhAQABAIAAAAUEBAAAACwAAAAAAQABAAACAkQBADsR0lGODlhEAAQAMQAAORHHOVSKudfOulrSOp3WOyDZu6QdvCchPGolfO0o", "junk"),
    ("copper ladder window market velvet engine bottle garden mirror forest button stone paper cloud river pencil silver basket winter candle marble table", "junk"),
    ("Next page | Previous page | Contents\n" * 14, "junk"),
    ("and so it goes on and so it goes on " * 20, "junk"),
    ("Th| se!ond d~aft wo;ld be sh0rter th|n th! fir~t o;e bu0 it w|s an! it w~s be;ter to0 sai| th! ch~ir of th; gro0p at th| en!", "junk"),
)


def document_stats(docs: DataFrame, common: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, blank, *FEATURES) of every document; blank: there is nothing visible."""
    ship(docs.sparkSession)
    known = common_hashes(common) if common else np.zeros(0, np.uint64)

    def stats(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = ["" if t is None else t for t in b["t"]]
            out = pd.DataFrame(text_features(texts, known), columns=FEATURES)
            out.insert(0, "blank", [not t.strip() for t in texts])
            out.insert(0, "k", b["k"].to_numpy())
            yield out

    kind = dict(docs.dtypes)[key]
    schema = f"k {kind}, blank boolean, " + ", ".join(f"{f} double" for f in FEATURES)
    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(stats, schema).withColumnRenamed("k", key)


def weak_label() -> F.Column:
    """The kind that most characters belong to by the rules for lines, if they are enough to be sure."""
    out = F.lit(None).cast("string")
    for kind, share in _SHARES.items():
        out = F.when(F.col(share) >= SURE, kind).otherwise(out)
    return F.when(~F.col("blank"), out)


def measures_of(texts: list[str], common: list[str]) -> np.ndarray:
    """What the trees see of texts."""
    return text_features(texts, common_hashes(common) if common else np.zeros(0, np.uint64))[:, : len(MEASURES)]


def train_kinds(stats: DataFrame, common: list[str], key: str = "doc_id", sample: int = SAMPLE) -> gbt.Model:
    """Trees fitted on a bounded sample of weakly labelled rows of `stats`, calibrated on HOLDOUT."""
    labelled = stats.withColumn("label", weak_label()).where("label is not null")
    counts = dict(labelled.groupBy("label").count().collect())  # at most a row for each kind
    # each kind gets its share of the sample, so that rare kinds are seen
    least = [labelled.where(F.col("label") == k).orderBy(F.xxhash64(key)).limit(sample // len(KINDS)) for k in KINDS]
    rows = least[0]
    for r in least[1:]:
        rows = rows.unionByName(r)
    pdf = rows.select("label", *MEASURES).toPandas()
    model = gbt.train(pdf[list(MEASURES)].to_numpy(float), np.array([KINDS.index(x) for x in pdf["label"]], int), KINDS)
    model.shift = gbt.prior_shift(np.array([counts.get(k, 0) for k in KINDS]))
    return gbt.calibrate(model, measures_of([t for t, _ in HOLDOUT], common), np.array([KINDS.index(k) for _, k in HOLDOUT]))


def classify(stats: DataFrame, model: gbt.Model, key: str = "doc_id") -> DataFrame:
    """(key, kind, probability) of every document that isn't blank."""
    kind = dict(stats.dtypes)[key]

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            p = model.probabilities(b[list(MEASURES)].to_numpy(float))
            best = model.decided(p)
            yield pd.DataFrame({key: b[key].to_numpy(), "kind": [KINDS[i] for i in best], "probability": p[np.arange(len(p)), best]})

    return stats.where("not blank").mapInPandas(decide, f"{key} {kind}, kind string, probability double")


def document_kinds(docs: DataFrame, common: list[str], key: str = "doc_id", sample: int = SAMPLE) -> DataFrame:
    stats = checkpointed(document_stats(docs, common, key))
    return classify(stats, train_kinds(stats, common, key, sample), key)
