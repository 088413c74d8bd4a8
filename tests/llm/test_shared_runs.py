import random
import re

import numpy as np
import pytest

from quillspark.llm import shared_runs as s


def brute(rows, run, pages):
    """(host, index of the row) -> whether each token lies in a run of tokens that stands on enough pages of the host."""
    toks = [[t[1].lower() and m.group() for m in re.finditer(r"\w+|[^\w\s]", t[1])] for t in rows]
    seen = {}
    for i, (h, _) in enumerate(rows):
        for k in range(len(toks[i]) - run + 1):
            seen.setdefault((h, tuple(toks[i][k : k + run])), set()).add(i)
    out = []
    for i, (h, _) in enumerate(rows):
        inside = [False] * len(toks[i])
        for k in range(len(toks[i]) - run + 1):
            if len(seen[h, tuple(toks[i][k : k + run])]) >= pages:
                inside[k : k + run] = [True] * run
        out.append([t for t, x in zip(toks[i], inside) if x])
    return out


@pytest.mark.parametrize("block", [1_000_000, 40])
def test_same_as_brute_force(spark, block):
    r = random.Random(2)
    bits = [" ".join(r.choice("abcdef") + r.choice("xyz") for _ in range(9)) + r.choice([".", ";\n", " {"]) for _ in range(12)]
    rows = [(r.choice(["d1", "d2", None]), " ".join([r.choice(bits) for _ in range(r.randrange(4))] + [f"w{r.randrange(900)} ü{k}" for k in range(6)])) for _ in range(60)] + [("d1", ""), ("d1", None)]
    df = spark.createDataFrame([(h, k, t, "x") for k, (h, t) in enumerate(rows)], "h string, id int, text string, key string")
    got = s.shared_runs(df, "h", "id", "text", run=6, pages=3, block_tokens=block).collect()
    full = [x for x in rows if x[1]]
    want = brute(full, 6, 3)
    whole, shared = {}, {}
    for x in sorted(got, key=lambda x: (x.page, x.start_char)):
        whole[x.page] = whole.get(x.page, "") + x.piece
        assert len(x.piece) == x.end_char - x.start_char
        if x.shared:
            shared.setdefault(x.page, []).extend(re.findall(r"\w+|[^\w\s]", x.piece))
    assert whole == {k: t for k, (_, t) in enumerate(full)}
    assert [shared.get(k, []) for k in range(len(full))] == want and any(want)
    assert s.shared_runs(df.limit(0), "h", "id", "text").count() == 0


def test_suffix_array():
    r = np.random.default_rng(3)
    t = r.integers(0, 3, 60)
    order, rank = s.suffix_classes(t, 5)
    cut = [tuple(t[k : k + 5]) for k in range(60)]
    assert [cut[k] for k in order] == sorted(cut)
    assert all((rank[i] == rank[j]) == (cut[i] == cut[j]) for i in range(60) for j in range(60))
