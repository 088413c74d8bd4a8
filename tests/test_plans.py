"""Queries on small tables written to a folder, for what their SQL leaves out."""

import re
from collections import Counter

import __spark_entry__
from quillspark.operators import routing


def run(spark, folder, name, **tables):
    for t, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/{t}.parquet")
    return [tuple(r) for r in __spark_entry__.queries()[name](spark, str(folder)).collect()]


def documents(*texts):
    return "doc_id long, text string, lang string, paper_id string", [(i, t, "en", "P1") for i, t in enumerate(texts)]


def test_numbered_lines_of_long_texts(spark, tmp_path):
    long = [f"line {i} of a text" for i in range(100_001)]
    texts = ["a\n\nb", None, "", "\n".join(long), "x" * 2000]
    got = run(spark, tmp_path, "numbered_lines", documents=documents(*texts))
    assert sorted(got) == sorted((i, f"  {k:>5}: {s}") for i, t in enumerate(texts) if t is not None for k, s in enumerate(t.split("\n"), 1))


def test_hypothesis_hits_of_any_text(spark, tmp_path):
    texts = [
        "We propose a müller_t and std::x.\r\nadd: \r\nÜber shall be", "because “we modify” it, naming convention", "éshall shallé shall", "library   should be changed\nadd:",
        "der Bibliothek – name lookup\rlifetime", "İ conceptſ 1٢.3 [a.é]", None, "",
    ]
    lines = [s for t in texts if t is not None for s in re.split("\r?\n", t)]
    want = Counter(k for s in lines for k, (fold, p) in routing.CATALOGUE.items() if re.search(p, s, re.I if fold else 0))
    assert dict(run(spark, tmp_path, "hypothesis_hits", documents=documents(*texts))) == want and want["M5"] and want["W2"] == 2


def test_entity_escapes_of_whole_texts(spark, tmp_path):
    texts = ["a" * 300 + "é", "é" + "a" * 300, "plain " * 100, "", None, "x" * 500 + "\U0001f600"]
    assert run(spark, tmp_path, "entity_escapes", documents=documents(*texts)) == [("en", 5, 3)]


def test_gates_of_texts_with_carriage_returns(spark, tmp_path):
    texts = ["# A\n\n```\nx\n", "|a|b|\n|a|b|c|\n", "---\ntitle: x\n---\n", "# B\n\ufffd Ã¤\n```\nÃ¤\n```\nÃ¶", "# C\n|a|b|\n|c|d|\n"]
    both = documents(*texts, *[t.replace("\n", "\r\n") for t in texts], None)
    want = {"open_fence": 2, "no_heading": 4, "front_matter_only": 2, "ragged_table": 2, "replacement_chars": 2}
    assert dict(run(spark, tmp_path, "structural_gates", documents=both)) == want
    broken = dict(run(spark, tmp_path, "mojibake_counts", documents=both))
    assert broken == {i: 3 if i in (3, 8) else 0 for i in range(10)}
