"""Document fingerprints that subtract: invertible Bloom lookup sketches, in DataFrame functions only.

A text is cut into paragraphs at line breaks and, inside a line, after the end of a sentence; the set of their
64-bit digests is sketched in 24 cells, eight for each of three hash functions, that hold the number of
digests, their exclusive or, and that of a check hash. Cells of two versions subtract: what both have
cancels, and peeling cells with one digest left recovers the digests in which they differ. If a table doesn't peel, the
digests are dealt by further hash bits to as many tables of the same size as they need, and a part that
fails again to four more with other hash functions: the sketch gets larger until everything is recovered. Those larger tables are made from the
digests of both texts, not from the fingerprints returned, and a part that failed three times (digests whose cells coincide for all functions) is compared as
it is. Texts of any length are cut and sketched in one expression each. The
likeness of two texts is shared / all digests.

Null text counts as empty; two texts without paragraphs have likeness 1. Documents are ordered by descending id, null ids last, rows of one id by a hash
of their text; rows equal in id and text are one document, and each gets its result. The only document of a table is its own next. An
empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from betaloom.tables import materialize

FUNCTIONS, WIDTH_BITS = 3, 3
WIDTH = 1 << WIDTH_BITS
CELLS = FUNCTIONS * WIDTH
PER_TABLE = 6
PARAGRAPH_END = r"(?<=[.!?])\s+|\n+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def paragraph_digests(text: Column) -> Column:
    """The distinct digests of a text's paragraphs, in order."""
    parts = F.filter(F.split(text, PARAGRAPH_END, -1), lambda p: F.trim(p) != "")
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(F.trim(p))))


def _place(digest: Column, function: int, turn: int) -> Column:
    """The cell of ``digest`` among those of a hash function: three bits of the digest, other ones for each function and turn."""
    return F.shiftrightunsigned(digest, function * 3 + 9 * turn).bitwiseAND(F.lit(WIDTH - 1).cast("long"))


def _check(digest: Column) -> Column:
    return F.hash(digest, F.lit(1))


def _changed(by: int) -> Callable[[Column, Column], Column]:
    def change(cell: Column, digest: Column) -> Column:
        return F.struct((cell["n"] + by).alias("n"), cell["key"].bitwiseXOR(digest).alias("key"), cell["check"].bitwiseXOR(_check(digest)).alias("check"))

    return change


def _cells(turn: int, body: Callable[[Callable[[Column], Column]], Column]) -> Column:
    """An array with ``body`` of every cell, given the test of a digest for being in this cell."""

    def cells(function: int) -> Column:
        places = F.array(*[F.lit(j).cast("long") for j in range(WIDTH)])
        return F.transform(places, lambda j: body(lambda digest: _place(digest, function, turn) == j))

    return F.concat(*[cells(function) for function in range(FUNCTIONS)])


ZERO = "named_struct('n', 0, 'key', 0L, 'check', 0)"


def sketch(digests: Column, turn: int = 0) -> Column:
    """The cells of a set of digests: array of (n, key, check)."""
    return _cells(turn, lambda inside: F.aggregate(F.filter(digests, inside), F.expr(ZERO), _changed(1)))


def difference(left: Column, right: Column, turn: int) -> Column:
    """``subtract`` of the sketches of two sets, in one step: cells are sums, so digests of the right set are taken away at once."""

    def cell(inside: Callable[[Column], Column]) -> Column:
        held = F.aggregate(F.filter(left, inside), F.expr(ZERO), _changed(1))
        return F.aggregate(F.filter(right, inside), held, _changed(-1))

    return _cells(turn, cell)


def subtract(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: F.struct(
        (a["n"] - b["n"]).alias("n"), a["key"].bitwiseXOR(b["key"]).alias("key"), a["check"].bitwiseXOR(b["check"]).alias("check")
    ))


def peeled(cells: Column, most: Column, turn: int = 0) -> Column:
    """The number of digests recovered from subtracted cells, or null if some are left."""

    def pure(c: Column) -> Column:
        return (F.abs(c["n"]) == 1) & (_check(c["key"]) == c["check"])

    def step(state: Column, _: Column) -> Column:
        def take(out: Column) -> Column:
            own = F.array(*[(_place(out["key"], f, turn) + f * WIDTH).cast("int") for f in range(FUNCTIONS)])

            def clear(places: Column) -> Column:
                return F.transform(state["cells"], lambda c, j: F.when(F.get(places, F.shiftright(j, WIDTH_BITS)) == j, F.struct(
                    (c["n"] - out["n"]).alias("n"),
                    c["key"].bitwiseXOR(out["key"]).alias("key"),
                    c["check"].bitwiseXOR(out["check"]).alias("check"),
                )).otherwise(c))

            stuck = F.struct(state["cells"].alias("cells"), state["found"].alias("found"), F.lit(True).alias("stuck"))
            return F.when(out.isNull(), stuck).otherwise(
                F.struct(let(own, clear).alias("cells"), (state["found"] + 1).alias("found"), F.lit(False).alias("stuck"))
            )

        # once no cell is pure, the steps left have nothing to do
        return F.when(state["stuck"], state).otherwise(let(F.get(F.filter(state["cells"], pure), 0), take))

    start = F.struct(cells.alias("cells"), F.lit(0).alias("found"), F.lit(False).alias("stuck"))
    steps = F.sequence(F.lit(0), F.least(most, F.lit(CELLS)))

    def end(state: Column) -> Column:
        rest = F.exists(state["cells"], lambda c: (c["n"] != 0) | (c["key"] != 0) | (c["check"] != 0))
        return F.when(~rest, state["found"])

    return F.aggregate(steps, start, step, end)


def _attempt(left: Column, right: Column, turn: int) -> Column:
    return let(difference(left, right, turn), lambda c: peeled(c, F.size(left) + F.size(right), turn))


def _part_bits(digest: Column, turn: int) -> Column:
    """Bits that no cell depends on: 19, then the last 18, then those of another hash."""
    if turn == 1:
        return F.shiftrightunsigned(digest, 27).bitwiseAND(F.lit((1 << 19) - 1).cast("long"))
    return F.shiftrightunsigned(digest, 46) if turn == 2 else F.xxhash64(digest, F.lit(100 + turn))


def _dealt(left: Column, right: Column, many: Column, turn: int, body: Callable[[Column, Column], Column]) -> Column:
    """The sum of ``body`` over ``many`` parts of both sets, by hash bits of the digests; null if any part is null."""

    def part(side: Column, i: Column) -> Column:
        return F.filter(side, lambda d: F.pmod(_part_bits(d, turn), many.cast("long")) == i)

    def one(i: Column) -> Column:
        return let(F.struct(part(left, i).alias("l"), part(right, i).alias("r")), lambda s: body(s["l"], s["r"]))

    parts = F.transform(F.sequence(F.lit(0).cast("long"), many.cast("long") - 1), one)
    return F.aggregate(parts, F.lit(0), lambda s, x: s + x)


def differing(left: Column, right: Column, left_sketch: Column, right_sketch: Column) -> Column:
    """How many digests only one of two sets has, by peeling tables made larger until they all peel.

    The sketches given are those of the whole sets, turn 0.
    """

    def last(a: Column, b: Column) -> Column:
        # a part that failed three times holds digests whose cells coincide for all functions
        return F.size(F.array_except(a, b)) + F.size(F.array_except(b, a))

    def third(a: Column, b: Column) -> Column:
        return F.coalesce(_attempt(a, b, 2), last(a, b))

    def second(a: Column, b: Column) -> Column:
        return F.coalesce(_attempt(a, b, 1), _dealt(a, b, F.lit(4), 3, third))

    def tables(a: Column, b: Column) -> Column:
        return F.greatest(F.lit(1), F.ceil((F.size(a) + F.size(b)) / PER_TABLE))

    def fine(a: Column, b: Column) -> Column:
        return let(tables(a, b), lambda n: _dealt(a, b, n, 2, second))

    def coarse(a: Column, b: Column) -> Column:
        # dealt in two steps, so that the work for n digests is n * sqrt(n)
        return let(F.ceil(F.sqrt(tables(a, b))), lambda n: _dealt(a, b, n, 1, fine))

    whole = let(subtract(left_sketch, right_sketch), lambda c: peeled(c, F.size(left) + F.size(right), 0))
    return F.coalesce(whole, coarse(left, right))


def likeness(left: Column, right: Column, left_sketch: Column, right_sketch: Column) -> Column:
    total = F.size(left) + F.size(right)
    return let(differing(left, right, left_sketch, right_sketch), lambda d: F.when(total == 0, 1.0).otherwise((total - d) / (total + d)))


def as_text(cells: Column) -> Column:
    def cell(c: Column) -> Column:
        check = c["check"].cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
        return F.concat(F.lpad(F.hex(c["n"]), 8, "0"), F.lpad(F.hex(c["key"]), 16, "0"), F.lpad(F.hex(check), 8, "0"))

    return F.array_join(F.transform(cells, cell), "")


def neighbours(keys: DataFrame) -> DataFrame:
    """For each (key, doc_id, mark, n_chars): ``next_key``, and ``before_key`` and ``before_half`` of the document it is the next of.

    Keys are dealt by ranges of the order, each range is ordered by itself, and the first of each range closes the one before.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("mark").asc()]
    dealt = keys.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    dealt = materialize(dealt, "ranges")  # the ranges are those of the written table from here on
    inside = W.partitionBy("range").orderBy(*order)
    held = dealt.withColumn("following", F.lead("key").over(inside)).withColumn("at", F.row_number().over(inside))
    firsts = held.where("at = 1").select("range", "key")  # one row per range
    over = W.orderBy("range")
    every = over.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    closing = firsts.select("range", F.coalesce(F.lead("key").over(over), F.first("key").over(every)).alias("closing"))
    nexts = held.join(closing, "range").select("key", F.coalesce("following", "closing").alias("next_key"), F.floor(F.col("n_chars") / 2).alias("half"))
    nexts = materialize(nexts, "nexts")
    before = nexts.select(F.col("next_key").alias("key"), F.col("key").alias("before_key"), F.col("half").alias("before_half"))
    return nexts.select("key", "next_key").join(before, "key")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, next_id."""
    text = F.coalesce("text", F.lit(""))
    mark = F.xxhash64(text)
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), mark.cast("string"))
    base = docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    keys = base.select("key", "doc_id", F.xxhash64("text").alias("mark"), F.char_length("text").alias("n_chars"))
    keys = keys.groupBy("key", "doc_id", "mark").agg(F.max("n_chars").alias("n_chars"))
    whole = base.join(neighbours(keys), "key")
    lent = whole.select(
        F.col("before_key").alias("key"),
        F.col("doc_id").alias("next_id"),
        F.substring(F.col("text"), F.lit(1), F.col("before_half").cast("int")).alias("prefix"),
        paragraph_digests(F.col("text")).alias("next_digests"),
    )
    # next_id goes along, so that this side reads the same columns and the shuffled texts serve both
    lent = lent.groupBy("key").agg(F.first("next_id").alias("next_id"), F.first("prefix").alias("prefix"), F.first("next_digests").alias("next_digests"))
    n = F.char_length("text")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (n - F.floor(n / 2)).cast("int")), F.col("prefix"))
    joined = whole.select("key", "doc_id", "text").join(lent, "key").select("doc_id", "text", "next_id", "next_digests", edited.alias("edited"))

    def results(x: Column) -> Column:
        def compared(s: Column) -> Column:
            cells = F.struct(sketch(s["own"]).alias("own"), sketch(s["edited"]).alias("edited"), sketch(s["next"]).alias("next"))
            return let(cells, lambda c: F.struct(
                as_text(c["own"]).alias("fingerprint"),
                as_text(c["edited"]).alias("edited_fingerprint"),
                likeness(s["own"], s["edited"], c["own"], c["edited"]).alias("near_edited"),
                likeness(s["own"], s["next"], c["own"], c["next"]).alias("near_next"),
            ))

        return let(
            F.struct(paragraph_digests(x["text"]).alias("own"), paragraph_digests(x["edited"]).alias("edited"), x["next"].alias("next")), compared
        )

    row = F.struct(F.col("text"), F.col("edited"), F.col("next_digests").alias("next"))
    out = joined.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), let(row, results).alias("r"), "next_id"
    )
    return out.select("doc_id", "n_chars", "edited_sha256", F.inline(F.array("r")), "next_id")
