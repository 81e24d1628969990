"""Exact quantiles (linear interpolation, NULLs ignored) that never gather a large group.

``percentile`` keeps every distinct value of a group on one task. That is fine for a group
whose size was checked; beyond the limit a mergeable rank sketch of each group brackets the wanted ranks
between two of its values, and one exact pass counts the values below the bracket and tallies those inside.
Only if a bracket would still hold more than the limit is it sketched again. The tally says whether it
covers the ranks, so the answer is exact whatever the sketch says; ranks that it doesn't cover are bracketed again more widely.
Brackets are ranks, not widths: infinities, ties and values near the largest double take no extra pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from betaloom.tables import materialize

SMALL_GROUP = 20_000
#: Sizes of a sketch per group and of the one of a whole column. The error of a rank is about 2.3 / size of the values.
SKETCH, WHOLE_SKETCH = 1000, 8000


def grouped_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    small_group: int = SMALL_GROUP,
    largest: int | None = None,
) -> DataFrame:
    """One row per key with a column per entry of ``probs``.

    ``largest`` is the size of the largest group where the caller has counted it already.
    """
    present = df.select(*keys, F.col(value).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    largest = largest_group(df, keys, value) if largest is None else largest
    if largest <= small_group:
        cuts = F.percentile("_x", F.array(*[F.lit(p) for p in probs.values()]))
        found = present.groupBy(*keys).agg(cuts.alias("_q"))
        return found.select(*keys, *[F.get("_q", i).alias(n) for i, n in enumerate(probs)])
    return _narrowed(present, list(keys), probs, small_group)


def largest_group(df: DataFrame, keys: Sequence[str], value: str) -> int:
    """Most values any key holds."""
    sizes = df.groupBy(*keys).agg(F.count(value).alias("n"))
    return sizes.agg(F.max("n")).first()[0] or 0


def _rank(n: Column, p: float) -> Column:
    return (n - 1) * F.lit(float(p))


def _position(n: Column, p: float) -> tuple[Column, Column]:
    """The ranks, from 0, on either side of the wanted place."""
    place = _rank(n, p)
    return F.floor(place).cast("long"), F.ceil(place).cast("long")


def _grid(sketch: Column, size: int) -> Column:
    """The sketch's values at equal steps of rank, half as many as its size."""
    steps = size // 2
    ranks = ", ".join(f"{i / steps!r}D" for i in range(steps + 1))
    return F.kll_sketch_get_quantile_double(sketch, F.expr(f"array({ranks})"))


def _bracket(i: Column, first: Column, last: Column, before: Column, held: Column, least: Column, most: Column, size: int, margin: float) -> Column:
    """Two values between which the ranks ``first`` and ``last`` lie, if the sketch (its ``_grid``) of ``held`` values is right."""
    steps = size // 2
    below = F.floor(((first - before) / held - margin) * steps).cast("int")
    above = F.ceil(((last - before + 1) / held + margin) * steps).cast("int")
    # ranks that the values don't hold: an earlier bracket was wrong, and the exact pass will say so
    inside = (held > size) & (first >= before) & (last < before + held)
    low = F.when(inside & (below > 0), F.get("_grid", below)).otherwise(least)
    high = F.when(inside & (above < steps), F.get("_grid", above)).otherwise(most)
    share = F.when(inside, F.lit(min(1.0, 4 * margin + 4 / steps))).otherwise(1.0)
    held = F.ceil(held * share).cast("long")
    return F.struct(i.alias("i"), first.alias("first"), last.alias("last"), low.alias("low"), high.alias("high"), held.alias("held"))


def _placed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per value and bracket that reaches it: (i, first, last, x), where x is NULL for a value below the bracket."""
    x = F.col("_x")

    def mark(s: Column) -> Column:
        found = lambda v: F.struct(s["i"].alias("i"), s["first"].alias("first"), s["last"].alias("last"), v.alias("x"))
        return F.when(x < s["low"], found(F.lit(None).cast("double"))).when(x <= s["high"], found(x))

    marks = F.filter(F.transform("spans", mark), lambda m: m.isNotNull())
    return rows.select(*keys, F.inline(marks))


def _with_spans(present: DataFrame, spans: DataFrame, keys: list[str]) -> DataFrame:
    """Values beside the brackets of their group; without keys there is one row of brackets, read as constants."""
    if keys:
        return present.join(spans, keys)
    own = spans.first()
    rows = [] if own is None else own.spans
    constant = F.array(*[F.struct(*[F.lit(s[c]).alias(c) for c in ("i", "first", "last", "low", "high")]) for s in rows])
    return present.withColumn("spans", constant if rows else F.lit(None).cast("array<struct<i:int,first:bigint,last:bigint,low:double,high:double>>"))


def _widest(spans: DataFrame) -> int:
    """An upper bound on what the largest bracket holds that isn't one value only."""
    each = spans.select(F.inline("spans"))
    return each.where("low < high").agg(F.max("held")).first()[0] or 0


def _narrowed(present: DataFrame, keys: list[str], probs: Mapping[str, float], limit: int, margin: float | None = None) -> DataFrame:
    """One row per key with a column per entry of ``probs``."""
    size = SKETCH if keys else WHOLE_SKETCH
    # three times the error to either side
    margin = 7 / size if margin is None else margin
    n, least, most = (F.col(c) for c in ("_n", "_least", "_most"))
    sketch = lambda c: F.kll_sketch_agg_double(c, F.lit(size)).alias("_sketch")
    start = present.groupBy(*keys).agg(F.count("_x").alias("_n"), F.min("_x").alias("_least"), F.max("_x").alias("_most"), sketch("_x")).where("_n > 0")
    start = start.withColumn("_grid", _grid(F.col("_sketch"), size))
    ranks = [_position(n, p) for p in probs.values()]
    zero = F.lit(0).cast("long")
    brackets = [_bracket(F.lit(i), first, last, zero, n, least, most, size, margin) for i, (first, last) in enumerate(ranks)]
    spans = materialize(start.select(*keys, n.alias("_n"), F.array(*brackets).alias("spans")), "quantile-spans")
    sizes = spans.select(*keys, "_n")
    wide, before = _widest(spans), None
    while wide > limit and (before is None or wide < before):
        before = wide
        inner = _placed(_with_spans(present, spans, keys), keys).groupBy(*keys, "i", "first", "last").agg(
            F.count_if(F.col("x").isNull()).alias("_before"), F.count("x").alias("_held"), F.min("x").alias("_least"), F.max("x").alias("_most"), sketch("x")
        ).where("_held > 0").withColumn("_grid", _grid(F.col("_sketch"), size))
        again = _bracket(F.col("i"), F.col("first"), F.col("last"), F.col("_before"), F.col("_held"), least, most, size, margin)
        spans = materialize(inner.select(*keys, again.alias("span")).groupBy(*keys).agg(F.collect_list("span").alias("spans")), "quantile-spans")
        wide = _widest(spans)

    tally = _placed(_with_spans(present, spans, keys), keys).groupBy(*keys, "i", "first", "last", "x").agg(F.count("*").alias("held"))
    upto = F.sum("held").over(W.partitionBy(*keys, "i").orderBy(F.col("x").asc_nulls_first()).rowsBetween(W.unboundedPreceding, 0))
    counted = tally.withColumn("upto", upto)
    at = lambda rank: F.max(F.when((F.col(rank) < F.col("upto")) & (F.col(rank) >= F.col("upto") - F.col("held")), F.col("x")))
    ends = counted.groupBy(*keys, "i").agg(at("first").alias("low"), at("last").alias("high"))
    found = ends.groupBy(*keys).agg(*[F.max(F.when(F.col("i") == i, F.struct("low", "high"))).alias(f"_e{i}") for i in range(len(probs))])
    found = _joined(sizes, found, keys)
    cuts = []
    for i, (name, p) in enumerate(probs.items()):
        share = _rank(n, p) - F.floor(_rank(n, p))
        low, high = F.col(f"_e{i}.low"), F.col(f"_e{i}.high")
        between = F.when((share == 0) | (low == high), low).otherwise(low * (1 - share) + high * share)
        cuts.append(F.when(low.isNotNull() & high.isNotNull(), between).alias(name))
    out = materialize(found.select(*keys, *cuts), "quantiles")
    missed = out.where(" OR ".join(f"`{name}` IS NULL" for name in probs))
    if margin < 1 and missed.limit(1).count():
        rest = present.join(missed.select(*keys), keys, "left_semi") if keys else present
        wider = _narrowed(rest, keys, probs, limit, 8 * margin)
        out = out.exceptAll(missed).unionByName(wider)
    return out


def _joined(sizes: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Group sizes beside what was found, also where nothing was; one row each without keys."""
    if keys:
        return sizes.join(found, keys, "left")
    own = sizes.first()
    return found.withColumn("_n", F.lit(own[0] if own else 0).cast("long"))


def global_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], small_group: int = SMALL_GROUP
) -> list[float] | None:
    """Exact quantiles of a whole column, or ``None`` when it holds no value.

    The input is read twice as a rule, so pass a stored table, not a long chain of steps.
    """
    present = df.select(F.col(value).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    n = present.count()
    if n == 0:
        return None
    if n <= small_group:
        cuts = F.percentile("_x", F.array(*[F.lit(float(p)) for p in probs]))
        return list(present.agg(cuts).first()[0])
    named = {f"q{i}": float(p) for i, p in enumerate(probs)}
    row = _narrowed(present, [], named, small_group).first()
    return [row[name] for name in named]
