"""Groups of any size compared in blocks, and connected components of what was linked.

A group is cut into blocks of bounded size by a hash of the member; each pair of blocks is one unit of
work, so a group that holds a third of all rows becomes many units. A unit compares its members with
matrix products and gives back a spanning forest, at most one edge per member, never its pairs.

Where only components are wanted, pairs inside a component need no look. ``edges_within`` first compares a large group's
blocks inside themselves and with a few pivots common to all blocks, which takes a row per member and joins near copies
into one component. Members left outside it are compared with more pivots of that component while that helps; in the end
only they are paired in blocks, with each other and with the component. No pair of different components goes without its comparison.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from betaloom.llm.tokens import tidy
from betaloom.tables import materialize

BLOCK = 512
PIVOTS = 32
MORE_PIVOTS = 256
ROUNDS = 3
COLUMNS_AT_ONCE = 4096

EDGES = "a binary, b binary"


def in_blocks(rows: DataFrame, size: Column, member: Column, block: int = BLOCK) -> DataFrame:
    """Add ``own`` (the member's block) and ``i <= j`` (the pair of blocks); one row for each pair the block is in."""
    many = F.ceil(size / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64(member, F.lit(11)), many).cast("int")
    others = F.sequence(F.lit(0), F.col("many") - 1)
    pairs = F.transform(others, lambda o: F.struct(F.least("own", o).alias("i"), F.greatest("own", o).alias("j")))
    dealt = rows.withColumn("many", many).withColumn("own", own).withColumn("pair", F.explode(pairs))
    return dealt.withColumn("i", F.col("pair.i")).withColumn("j", F.col("pair.j")).drop("pair", "many")


def by_unit(
    rows: DataFrame, keys: list[str], work: Callable[[pd.DataFrame], pd.DataFrame | None], schema: str
) -> DataFrame:
    """Run ``work`` on each group of ``keys``. Groups are read in order from sorted partitions, many to a batch."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def cut(frame: pd.DataFrame, last: bool) -> Iterator[pd.DataFrame]:
            """Work on whole groups; the last group waits for the next batch unless this is the end."""
            key = frame[keys]
            new = (key.ne(key.shift())).any(axis=1).to_numpy()
            starts = np.flatnonzero(new)
            stops = np.append(starts[1:], len(frame))
            done = [out for a, b in zip(starts[: None if last else -1], stops, strict=False) if b - a > 1 and (out := work(frame.iloc[a:b])) is not None]
            held[:] = [] if last else [frame.iloc[starts[-1] :]]
            if done:
                yield pd.concat(done, ignore_index=True)

        for frame in frames:
            if len(frame):
                yield from cut(pd.concat([*held, frame], ignore_index=True) if held else frame, False)
        if held:
            yield from cut(held[0].reset_index(drop=True), True)

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(tidy(run), schema)


def _block_of(count: Column, seed: int, block: int) -> Column:
    return F.pmod(F.xxhash64("class", F.lit(seed)), F.ceil(count / F.lit(block)).cast("int")).cast("int")


def _pivots(rows: DataFrame, key: str, many: int, seed: int) -> DataFrame:
    """``many`` members of each group, by hash."""
    order = W.partitionBy(key).orderBy(F.xxhash64("class", F.lit(seed)), "class")
    return rows.select(key, "class").withColumn("place", F.row_number().over(order)).where(F.col("place") <= many).drop("place")


def _with_pivots(members: DataFrame, pivots: DataFrame, rows: DataFrame, key: str, count: str, seed: int) -> DataFrame:
    """Members (key, class, ``count`` per group) in blocks, and every pivot (key, class, main) of a group in each of its blocks."""
    held = BLOCK // 2
    blocks = F.ceil(F.col(count) / F.lit(held)).cast("int")
    own = members.select(key, "class", F.lit(False).alias("main"), _block_of(F.col(count), seed, held).alias("unit"))
    wide = members.groupBy(key).agg(F.max(blocks).alias("blocks"))
    common = pivots.join(wide, key).select(key, "class", "main", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("unit"))
    return own.unionByName(common).join(rows, [key, "class"])


def _joined_to_main(key: str, work: Callable[[pd.DataFrame], pd.DataFrame | None]) -> Callable[[pd.DataFrame], pd.DataFrame | None]:
    """``work`` on a unit, with the key and whether the edge's first end is in one component with a pivot of the main one.

    Members of such a component are linked with its pivot alone, so that units that share the pivots give the same edges.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame | None:
        edges = work(frame)
        if edges is None:
            return None
        root: dict[bytes, bytes] = {}

        def find(x: bytes) -> bytes:
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for a, b in zip(edges["a"], edges["b"], strict=True):
            root[find(a)] = find(b)
        main = {find(x): x for x in sorted(frame.loc[frame["main"], "class"], reverse=True)}
        ends = list(dict.fromkeys([*edges["a"], *edges["b"]]))
        near = [x for x in ends if find(x) in main]
        apart = edges[[find(x) not in main for x in edges["a"]]]
        out = pd.concat([apart.assign(main=False), pd.DataFrame({"a": near, "b": [main[find(x)] for x in near], "main": True})], ignore_index=True)
        out.insert(0, key, [frame[key].iloc[0]] * len(out))
        return out

    return run


def edges_within(
    rows_where: Callable[[Column], DataFrame], key: str, size: str, payload: list[str], work: Callable[[pd.DataFrame], pd.DataFrame | None], largest: int
) -> DataFrame:
    """Edges (a, b) that connect what ``work`` links inside the groups of ``key``: same components as all links.

    ``rows_where`` gives the rows (``key``, ``class``, ``size`` of the group, payload) that meet a condition on ``size``; ``largest`` is the
    largest size.
    """
    small = by_unit(rows_where(F.col(size) <= BLOCK).select(key, "class", *payload), [key], work, EDGES)
    if largest <= BLOCK:
        return small
    found = [materialize(small, "links")]
    rows = rows_where(F.col(size) > BLOCK).select(key, "class", size, *payload).dropDuplicates([key, "class"])
    rows = materialize(rows, "large-groups")
    data = rows.drop(size)
    every = rows.select(key, "class", F.col(size).alias("left"))
    kind = rows.schema[key].dataType.simpleString()
    first = W.partitionBy(key).orderBy("class")
    pivots = _pivots(every, key, PIVOTS, 21).withColumn("main", F.row_number().over(first) == 1)
    outside, before = every, None
    for step in range(ROUNDS):
        units = _with_pivots(outside, pivots, data, key, "left", 31 + step)
        joined = by_unit(units.select(key, "unit", "class", "main", *payload), [key, "unit"], _joined_to_main(key, work), f"{key} {kind}, {EDGES}, main boolean")
        joined = materialize(joined, "links")
        found.append(joined.select("a", "b"))
        near = joined.where("main").select(key, F.col("a").alias("class")).unionByName(pivots.where("main").select(key, "class"))
        rest = outside.select(key, "class").join(near, [key, "class"], "left_anti")
        sizes = rest.groupBy(key).agg(F.count("*").alias("left"))
        outside = materialize(rest.join(sizes, key), "outside")
        total, widest = outside.agg(F.count("*"), F.max("left")).first()
        if not total or widest <= BLOCK or (before is not None and total > 0.8 * before):
            break
        before = total
        main = every.join(outside.select(key, "class"), [key, "class"], "left_anti")
        pivots = _pivots(main, key, MORE_PIVOTS, 41 + step).withColumn("main", F.lit(True))
    links = reduce(DataFrame.unionByName, found)
    if not total:
        return links

    # what is left: members outside the main component, with each other and with it
    counts = outside.groupBy(key).agg(F.max("left").alias("out"))
    sides = every.withColumnRenamed("left", "all").join(counts, key).join(outside.select(key, "class", F.lit(True).alias("is_out")), [key, "class"], "left")
    blocks = lambda c: F.greatest(F.ceil(c / F.lit(BLOCK)).cast("int"), F.lit(1))
    is_out, joined_size = F.coalesce("is_out", F.lit(False)), F.col("all") - F.col("out")
    own = _block_of(F.when(is_out, F.col("out")).otherwise(joined_size), 51, BLOCK)
    sides = sides.select(key, "class", is_out.alias("is_out"), blocks(F.col("out")).alias("i_many"), blocks(joined_size).alias("j_many"), own.alias("own"))
    others = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    unit = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    own = F.col("own")
    among = F.transform(others("i_many"), lambda o: unit("out", F.least(own, o), F.greatest(own, o)))
    against = F.transform(others("j_many"), lambda o: unit("main", own, o))
    facing = F.transform(others("i_many"), lambda o: unit("main", o, own))
    dealt = sides.select(key, "class", F.inline(F.when(F.col("is_out"), F.concat(among, against)).otherwise(facing))).join(data, [key, "class"])
    last = by_unit(dealt.select(key, "kind", "i", "j", "class", *payload), [key, "kind", "i", "j"], work, EDGES)
    return links.unionByName(last)


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of sets of integers, by products of 0/1 matrices in bounded slices."""
    n = len(sets)
    if n == 2:
        common = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), common], [common, len(sets[1])]], np.int64)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    column = np.cumsum(shared) - 1
    keep = shared[place]
    owner, column = owner[keep], column[place[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((n, n), np.float64)
    width = int(shared.sum())
    for low in range(0, width, COLUMNS_AT_ONCE):
        a, b = np.searchsorted(column, (low, low + COLUMNS_AT_ONCE))
        part = np.zeros((n, min(COLUMNS_AT_ONCE, width - low)), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        out += part @ part.T
    return out.astype(np.int64)


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges (member, its parent) of a spanning forest of a symmetric boolean matrix."""
    n = len(linked)
    fresh, edges = np.ones(n, bool), []
    for root in range(n):
        if not fresh[root]:
            continue
        fresh[root] = False
        todo = [root]
        while todo:
            u = todo.pop()
            near = np.flatnonzero(linked[u] & fresh)
            fresh[near] = False
            edges += [(v, u) for v in near.tolist()]
            todo += near.tolist()
    return edges


def stars(linked: np.ndarray, names: np.ndarray) -> list[tuple[bytes, bytes]]:
    """Edges (member, the least name of its component) of a symmetric boolean matrix.

    Groups that share members mostly share the least of them too, and so give the same edges.
    """
    linked = linked.copy()
    np.fill_diagonal(linked, False)
    order = np.argsort(names, kind="stable")
    up = list(range(len(linked)))
    for child, parent in forest(linked[np.ix_(order, order)]):  # a parent comes before its children
        up[child] = up[parent]
    return [(names[order[i]], names[order[j]]) for i, j in enumerate(up) if i != j]


def components(edges: DataFrame) -> DataFrame:
    """The least node each node of (a, b) is connected with: columns node, root.

    Alternates large-star and small-star steps; each pair of steps is written, so lineage stays short, and a pair that
    moves no edge ends the loop: then every edge leads to the least node of its component. A step sorts the edges of each
    node once, which finds its least neighbour and its repeated edges. Edges with a null end or two equal ends are ignored.
    """
    least_first = W.partitionBy("u").orderBy("v", F.col("moved").desc())
    least, again = F.first("v").over(least_first), F.lag("v").over(least_first).eqNullSafe(F.col("v"))
    pair = lambda u, v: F.struct(F.col(u).alias("u"), F.col(v).alias("v"))
    current = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    while True:
        both = current.select(F.inline(F.array(pair("u", "v"), pair("v", "u")))).withColumn("moved", F.lit(False))
        both = both.withColumns({"m": F.least("u", least), "again": again}).where("v > u AND NOT again")
        large = both.select(F.col("v").alias("u"), F.col("m").alias("v"), (F.col("m") != F.col("u")).alias("moved"))
        large = large.withColumns({"m": least, "again": again}).where("NOT again")
        first = F.col("v") == F.col("m")
        small = large.select(F.when(first, F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"), (F.col("moved") | ~first).alias("moved"))
        current = materialize(small, "edges")
        if not current.agg(F.max("moved")).first()[0]:
            break
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
