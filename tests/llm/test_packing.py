import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm import packing
from quillspark.llm.token_counts import counter

DOCS = "doc_id long, text string, tokens string, shard long"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t'sdtmrevléab12.,-—　\U0001f600x\x1c\x85\u00a0", max_size=40), max_size=8))
def test_counts_are_exact(texts):
    c = counter()
    assert c.count(texts).tolist() == [len(c.encode(t)) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 100), max_size=120))
def test_pack_is_valid(sizes):
    where = packing.pack(np.array(sizes, np.int64), 100)
    used = {}
    large = {}
    for s, c in zip(sizes, where):
        assert c >= 0
        used[c] = used.get(c, 0) + s
        large[c] = large.get(c, 0) + (s > 33)
    assert all(u <= 100 for u in used.values()) and all(n <= 2 for n in large.values())


def test_little_space_is_left():
    r = random.Random(1)
    sizes = np.array([r.choice([r.randrange(1, 300), r.randrange(300, 2048)]) for _ in range(5000)])
    where = packing.pack(sizes, 2048)
    assert len(set(where)) <= 1.03 * -(-int(sizes.sum()) // 2048)


def test_documents(spark):
    words = "alpha beta gamma delta "
    rows = [(1, words * 2000, "", 1), (2, None, "x", 2), (3, "", "x", 2), (4, words, None, None), (5, words, None, None), (6, words * 3000, "", 1)] + [(10 + k, words * (k % 60), "", 0) for k in range(300)]
    df = spark.createDataFrame(rows, DOCS)
    sizes = packing.token_sizes(df, "doc_id", "text")
    got = packing.pack_documents(sizes, "doc_id", shard_containers=4).collect()
    size = {r.doc_id: r.tokens for r in sizes.collect()}
    used, per = {}, {}
    for r in got:
        used[r.container] = used.get(r.container, 0) + r.tokens
        per.setdefault(r.doc_id, []).append(r)
    assert max(used.values()) <= 2048 and set(per) == set(size)
    for k, parts in per.items():
        parts.sort(key=lambda r: r.piece)
        assert sum(r.tokens for r in parts) == size[k] and [r.piece for r in parts] == list(range(parts[0].n_pieces))
        assert len(parts) == max(1, -(-size[k] // 2048)) and all(a.first_token + a.tokens == b.first_token for a, b in zip(parts, parts[1:]))
    assert packing.pack_documents(sizes.limit(0), "doc_id").count() == 0
