import random

import pytest

from quillspark import session as s
from quillspark.operators.graph import connected_components


@pytest.mark.parametrize("limit,heavy", [(1 << 20, 5), (0, 5), (0, 10_000), (1500, 5)])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_is_the_plain_join(spark, limit, heavy, how):
    r = random.Random(4)
    big = [(r.choice([None, 1, 1, 1, 2, r.randrange(40)]), k, "clash") for k in range(300)]
    small = [(k, f"v{k}") for k in range(0, 40, 2)]
    a = spark.createDataFrame(big, "key int, row int, extra string")
    b = spark.createDataFrame(small, "key int, value string")
    want = sorted(map(str, a.join(b, ["key"], how).collect()))
    assert sorted(map(str, s.lookup_join(a, b, ["key"], how, limit, heavy).collect())) == want


def test_checkpoints_need_a_shared_folder(monkeypatch):
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()
        conf = {}

    class Frame:
        sparkSession = Session()

    with pytest.raises(RuntimeError):
        s.checkpointed(Frame())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components(spark, seed):
    r = random.Random(seed)
    links = [(f"n{r.randrange(400)}", f"n{r.randrange(400)}") for _ in range(260)] + [("hub", f"h{k}") for k in range(200)] + [(f"c{k}", f"c{k + 1}") for k in range(150)] + [("a", "a"), (None, "b"), ("b", None)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        if a and b and a != b:
            up[find(a)] = find(b)
    sets = {}
    for x in list(up):
        sets.setdefault(find(x), set()).add(x)
    want = {x: min(m) for m in sets.values() for x in m}
    df = spark.createDataFrame([(*x, "e") for x in links], "src string, dst string, component string").repartition(7)
    got = connected_components(df).collect()
    assert {x.node: x.component for x in got} == want and len(got) == len(want)
    assert connected_components(df.limit(0)).count() == 0
