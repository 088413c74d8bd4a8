"""Parent-child rows turned into full hierarchies: root, depth, path, descendants, cycles.

Trees are separate per scope (a draft, say).  The first parents of all nodes are
combined by weighted disjoint-set forests, whose members know the distance to
their representative, the top of their chain.  A scope of at most
`local_links` links has one forest in one task.  A larger one gets as many
partitions as that bound asks for, ranges of labels; each builds the forest of
its own links, and the forests are merged by looking up the representatives
(offsets add up, and the height covered doubles with each merge).  A circle is
found as what never gets to a root and is opened at its least label.  Paths
grow in the same lookups, parent after parent.  Ancestors are read off the
paths; links beside the forest (second parents, opened circles) are followed
from path to path.

Defined results
  null scope, null or blank label or parent     no link; a null scope has no nodes
  parent that is no node            no link, the node is a root
  repeated links                    count once
  several parents                   all are followed for ancestors; the smallest label is the one of path and depth
  members of a circle               reach themselves; they have no root, depth or path
  nodes below a circle              no root, depth or path either
  empty table                       empty result
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.session import broadcast_if_small, checkpointed, lookup_join, ship

#: Links that one task holds; even if they form one chain, their ancestor pairs fit there.
LOCAL_LINKS = 2_000


def label_key(c: Column) -> Column:
    """Lower case, without blanks and square brackets around it; null if nothing is left."""
    x = F.regexp_replace(F.lower(c), r"^[\s\[\]]+|[\s\[\]]+$", "")
    return F.when(x != "", x)


def links(df: DataFrame, scope: str, node: str, parent: str) -> DataFrame:
    """Distinct (scope, child, parent) of normalised labels whose parent is a node of the scope."""
    rows = df.select(F.col(scope).alias("scope"), label_key(F.col(node)).alias("child"), label_key(F.col(parent)).alias("parent")).where("scope is not null")
    nodes = rows.where("child is not null").select("scope", F.col("child").alias("parent")).distinct()
    return rows.where("child is not null and parent is not null").distinct().join(nodes, ["scope", "parent"], "left_semi").select("scope", "child", "parent")


# ---------------------------------------------------------------- one scope in one task


class WeightedForest:
    """Disjoint sets whose members know their distance to the representative, the top of their chain."""

    def __init__(self) -> None:
        self.up: dict[str, str] = {}
        self.off: dict[str, int] = {}

    def find(self, x: str) -> tuple[str, int]:
        chain = []
        while self.up.get(x, x) != x:
            chain.append(x)
            x = self.up[x]
        d = 0
        for y in reversed(chain):
            d += self.off[y]
            self.up[y], self.off[y] = x, d
        return x, d

    def link(self, child: str, parent: str) -> bool:
        """Hang a top under `parent`; False if that closes a circle."""
        top, d = self.find(parent)
        if top == child:
            return False
        self.up[child], self.off[child] = parent, 1
        return True


def primary_parents(pairs: list[tuple[str, str]]) -> dict[str, str]:
    out: dict[str, str] = {}
    for c, p in pairs:
        if c not in out or p < out[c]:
            out[c] = p
    return out


def forest_of(parent: dict[str, str]) -> tuple[WeightedForest, set[str]]:
    """The forest of single parents, and a member of every circle."""
    f, circles = WeightedForest(), set()
    for c, p in parent.items():
        if not f.link(c, p):
            circles.add(c)
    return f, circles


def ancestors_of(pairs: list[tuple[str, str]]) -> dict[str, dict[str, int]]:
    """Least distance from every child to each of its ancestors.

    The forest of primary parents tells roots, offsets and circles; nodes are
    taken by their offset from the root, so that the ancestors of a parent are
    there before its children's.  Nodes on or below a circle, and those with a
    parent whose ancestors aren't known yet, climb the indexed parents level by level.
    """
    up: dict[str, list[str]] = {}
    for c, p in pairs:
        up.setdefault(c, []).append(p)
    forest, circles = forest_of(primary_parents(pairs))
    place = {c: forest.find(c) for c in up}
    out: dict[str, dict[str, int]] = {}
    open_ = {c for c in up if place[c][0] in circles}
    for c in sorted(up.keys() - open_, key=lambda c: place[c][1]):
        if any(p in up and p not in out for p in up[c]):
            out[c] = _climbed(c, up)
            continue
        got = dict.fromkeys(up[c], 1)
        for p in up[c]:
            for a, d in out.get(p, {}).items():
                if d + 1 < got.get(a, 1 << 60):
                    got[a] = d + 1
        out[c] = got
    out.update((c, _climbed(c, up)) for c in open_)
    return out


def _climbed(c: str, up: dict[str, list[str]]) -> dict[str, int]:
    got: dict[str, int] = {}
    level, d = [c], 0
    while level:
        d += 1
        level = list({p for x in level for p in up.get(x, ()) if p not in got})
        got.update(dict.fromkeys(level, d))
    return got


def _local_closure(pdf: pd.DataFrame) -> pd.DataFrame:
    scope = pdf["scope"].iloc[0]
    pairs = list(zip(pdf["child"], pdf["parent"]))
    rows = [(scope, a, c, d) for c, got in ancestors_of(pairs).items() for a, d in got.items()]
    return pd.DataFrame(rows, columns=["scope", "ancestor", "descendant", "distance"])


def _local_forest(pdf: pd.DataFrame) -> pd.DataFrame:
    scope = pdf["scope"].iloc[0]
    parent = primary_parents(list(zip(pdf["child"], pdf["parent"])))
    f, circles = forest_of(parent)
    rows = []
    for c in parent:
        root, d = f.find(c)
        if root in circles:
            rows.append((scope, c, None, None, None))
            continue
        path, x = [c], c
        while x in parent:
            x = parent[x]
            path.append(x)
        rows.append((scope, c, root, d, "/".join(reversed(path))))
    return pd.DataFrame(rows, columns=["scope", "node", "root", "depth", "path"]).astype({"depth": "Int64"})


# ---------------------------------------------------------------- scopes of any size


def _by_size(edges: DataFrame, local_links: int) -> tuple[DataFrame, DataFrame | None]:
    sizes = edges.groupBy("scope").agg(F.count("*").alias("n"))
    large = checkpointed(sizes.where(F.col("n") > local_links).select("scope"))  # at most all links / local_links rows
    if large.isEmpty():
        return edges, None
    side, _ = broadcast_if_small(large)
    return edges.join(side, "scope", "left_anti"), checkpointed(edges.join(side, "scope", "left_semi"))


_STATE = "scope string, node string, up string, off long, path array<string>"


def _local_forests(first: DataFrame, local_links: int) -> DataFrame:
    """(scope, node, up, off, path) of the forest of each partition; path: from the parent to the representative.  A node that would close a circle hangs on nothing."""

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scopes: dict[str, dict[str, str]] = {}
        for b in batches:
            for s, c, p in zip(b["scope"], b["child"], b["parent"]):
                scopes.setdefault(s, {})[c] = p
        for scope, parent in scopes.items():
            f, circles = forest_of(parent)
            got = []
            for c in parent:
                if c in circles:
                    continue
                (top, d), path, x = f.find(c), [], c
                while x != top:
                    x = parent[x]
                    path.append(x)
                got.append((scope, c, top, d, path))
            yield pd.DataFrame(got, columns=["scope", "node", "up", "off", "path"])

    parts = max(1, -(-first.count() // local_links))
    return checkpointed(first.repartitionByRange(parts, "scope", "child").mapInPandas(combine, _STATE))


def _looked_up(state: DataFrame, cols: list[str]) -> DataFrame | None:
    """(scope, up, *cols with 2 after them) of the representatives that hang on something themselves."""
    tops = state.select("scope", "up").distinct()
    far = state.select("scope", F.col("node").alias("up"), *[F.col(c).alias(c + "2") for c in cols])
    far = checkpointed(tops.join(far, ["scope", "up"]))
    return None if far.isEmpty() else far


def _opened(state: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The state without the links of the least label of each circle, and those labels (scope, node)."""
    jump = state.select("scope", "node", "up")
    reach, most = 1, state.count()
    while (far := _looked_up(jump.where("node <> up"), ["up"])) is not None and reach <= 2 * most:
        jump = checkpointed(lookup_join(jump, far, ["scope", "up"]).select("scope", "node", F.coalesce("up2", "up").alias("up")))
        reach *= 2
    if far is None:
        return state, None
    # after as many steps as there are nodes, all that is still led to lies on a circle
    on = checkpointed(jump.join(state.select("scope", F.col("node").alias("up")), ["scope", "up"], "left_semi").select("scope", F.col("up").alias("node")).distinct())
    ring = checkpointed(state.join(on, ["scope", "node"], "left_semi").select("scope", "node", "up", F.col("node").alias("least")))
    reach, most = 1, ring.count()
    while reach <= 2 * most:
        nxt = ring.select("scope", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("least").alias("least2"))
        ring = checkpointed(ring.join(nxt, ["scope", "up"]).select("scope", "node", F.col("up2").alias("up"), F.least("least", "least2").alias("least")))
        reach *= 2
    cut = checkpointed(ring.where("node = least").select("scope", "node"))
    return checkpointed(state.join(cut, ["scope", "node"], "left_anti")), cut


def _forest(edges: DataFrame, local_links: int) -> tuple[DataFrame, DataFrame]:
    """((scope, node, up, off, path) with up the root and path all ancestors in the forest, (scope, node) of the roots that lie on a circle)."""
    first = checkpointed(edges.groupBy("scope", "child").agg(F.min("parent").alias("parent")))
    state, cut = _opened(_local_forests(first, local_links))
    while (far := _looked_up(state, ["up", "off", "path"])) is not None:
        state = checkpointed(
            lookup_join(state, far, ["scope", "up"]).select("scope", "node", F.coalesce("up2", "up").alias("up"), (F.col("off") + F.coalesce("off2", F.lit(0))).alias("off"), F.when(F.col("path2").isNull(), F.col("path")).otherwise(F.concat("path", "path2")).alias("path"))
        )
    within = first.select("scope", F.col("child").alias("node")).join(state.select("scope", "node"), ["scope", "node"], "left_anti")  # circles of one partition
    return state, checkpointed((within if cut is None else within.unionByName(cut)).distinct())


def _paired(edges: DataFrame, state: DataFrame) -> DataFrame:
    """Ancestors from the paths of the forest and the links beside it, with their least distance."""
    least = lambda df, *by: df.groupBy("scope", *by).agg(F.min("d").alias("d"))
    tree = state.select("scope", "node", F.posexplode("path").alias("d", "anc")).select("scope", "node", "anc", (F.col("d") + 1).cast("long").alias("d"))
    beside = edges.join(state.select("scope", F.col("node").alias("child"), F.get("path", F.lit(0)).alias("parent")), ["scope", "child", "parent"], "left_anti")
    beside = checkpointed(beside.select("scope", F.col("child").alias("anc"), F.col("parent").alias("gate")))
    if beside.isEmpty():
        return tree
    nodes = edges.select("scope", F.explode(F.array("child", "parent")).alias("node")).distinct()
    reach = checkpointed(tree.unionByName(nodes.select("scope", "node", F.col("node").alias("anc"), F.lit(0).cast("long").alias("d"))))
    # a gate is the upper end of a link beside the forest; steps lead from any node to the gates its path meets
    step = least(lookup_join(reach, checkpointed(beside.groupBy("scope", "anc").agg(F.collect_set("gate").alias("gates"))), ["scope", "anc"], "inner").select("scope", "node", F.explode("gates").alias("gate"), (F.col("d") + 1).alias("d")), "node", "gate")
    step = checkpointed(step)
    gates = beside.select("scope", "gate").distinct()
    known = checkpointed(step.join(gates.withColumnRenamed("gate", "node"), ["scope", "node"], "left_semi"))
    before = None
    while (now := known.agg(F.count("*"), F.sum("d")).first()) != before:  # from gate to gate, twice as many with each round
        before = now
        on = known.select("scope", F.col("node").alias("mid"), F.col("gate"), F.col("d").alias("d2"))
        far = known.withColumnRenamed("gate", "mid").join(on, ["scope", "mid"]).select("scope", "node", "gate", (F.col("d") + F.col("d2")).alias("d"))
        known = checkpointed(least(known.unionByName(far), "node", "gate"))
    on = known.select("scope", F.col("node").alias("mid"), "gate", F.col("d").alias("d2"))
    every = least(step.unionByName(step.withColumnRenamed("gate", "mid").join(on, ["scope", "mid"]).select("scope", "node", "gate", (F.col("d") + F.col("d2")).alias("d"))), "node", "gate")
    above = reach.select("scope", F.col("node").alias("gate"), "anc", F.col("d").alias("d2"))
    through = every.join(above, ["scope", "gate"]).select("scope", "node", "anc", (F.col("d") + F.col("d2")).alias("d"))
    return least(tree.unionByName(through), "node", "anc")


def _large_pairs(edges: DataFrame, state: DataFrame) -> DataFrame:
    return _paired(edges, state).select("scope", F.col("anc").alias("ancestor"), F.col("node").alias("descendant"), F.col("d").cast("int").alias("distance"))


def _small_pairs(edges: DataFrame) -> DataFrame:
    return edges.groupBy("scope").applyInPandas(_local_closure, "scope string, ancestor string, descendant string, distance int")


def ancestor_pairs(edges: DataFrame, local_links: int = LOCAL_LINKS) -> DataFrame:
    """(scope, ancestor, descendant, distance) over distinct `links`."""
    ship(edges.sparkSession)
    small, large = _by_size(edges, local_links)
    return _small_pairs(small) if large is None else _small_pairs(small).unionByName(_large_pairs(large, _forest(large, local_links)[0]))


def tree_nodes(df: DataFrame, scope: str, node: str, parent: str, local_links: int = LOCAL_LINKS) -> DataFrame:
    """(scope, node, root, depth, path, n_descendants, on_circle), a row for each label of a scope."""
    ship(df.sparkSession)
    edges = checkpointed(links(df, scope, node, parent))
    small, large = _by_size(edges, local_links)
    forest = small.groupBy("scope").applyInPandas(_local_forest, "scope string, node string, root string, depth long, path string")
    pairs = _small_pairs(small)
    if large is not None:
        state, looped = _forest(large, local_links)
        free = lookup_join(state, looped.select("scope", F.col("node").alias("up"), F.lit(True).alias("looped")), ["scope", "up"]).withColumn("free", F.col("looped").isNull())
        path = F.array_join(F.concat(F.reverse("path"), F.array("node")), "/")
        rooted = free.select("scope", "node", F.when(F.col("free"), F.col("up")).alias("root"), F.when(F.col("free"), F.col("off")).alias("depth"), F.when(F.col("free"), path).alias("path"))
        none = F.lit(None).cast("string")
        forest = forest.unionByName(rooted).unionByName(looped.select("scope", "node", none.alias("root"), F.lit(None).cast("long").alias("depth"), none.alias("path")))
        pairs = pairs.unionByName(_large_pairs(large, state))
    below = pairs.groupBy("scope", F.col("ancestor").alias("node")).agg(
        F.count_if(F.col("ancestor") != F.col("descendant")).alias("n_descendants"), F.bool_or(F.col("ancestor") == F.col("descendant")).alias("on_circle")
    )
    nodes = df.select(F.col(scope).alias("scope"), label_key(F.col(node)).alias("node")).where("scope is not null and node is not null").distinct()
    whole = nodes.join(forest.withColumn("linked", F.lit(True)), ["scope", "node"], "left").join(below, ["scope", "node"], "left")
    free = F.col("linked").isNull()
    return whole.select(
        "scope", "node",
        F.when(free, F.col("node")).otherwise(F.col("root")).alias("root"),
        F.when(free, F.lit(0)).otherwise(F.col("depth")).cast("long").alias("depth"),
        F.when(free, F.col("node")).otherwise(F.col("path")).alias("path"),
        F.coalesce("n_descendants", F.lit(0)).cast("long").alias("n_descendants"),
        F.coalesce("on_circle", F.lit(False)).alias("on_circle"),
    )
