"""Line dedup over overlapping windows of three lines.

Lines that are blank aren't counted. Every three consecutive lines of a document make a window,
known by 96 bits of hashes of the trimmed lines. A window that occurs again, anywhere, is a repeat: its first
occurrence in (doc_id, position) order stays, all later ones are covered, and every covered line
goes. Where a document repeats itself so closely that a later window overlaps the first one, the
lines of the first stay.

Null texts stay null and empty ones empty; documents of fewer than three lines have no window and
stay as they are. Every row has a key of its own, written first: rows that share a doc_id come in the order of their
texts' hashes, and of rows equal in both the first written stays whole, later ones are repeats of it. Null ids come last. Every input column is kept, whatever its name, except that ``text`` is
rewritten; ``n_lines`` and ``n_removed`` are added by ``deduplicated`` (which replaces input columns of
those names).

Long lines hide passages from windows of whole lines. ``without_passages`` cuts texts into sentences and takes every
shortest run of whole ones, forward from each and backward from each, of more than ``PASSAGE_WORDS`` words. Any longer
run is covered by those inside it, so every repeated run of whole sentences or lines of more words is found.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from betaloom.llm.spans import packed, unpacked, without_spans
from betaloom.llm.tokens import tidy
from betaloom.tables import materialize

WINDOW = 3
LINE_BREAK = "\n"
PASSAGE_WORDS = 50
RUNS_TOGETHER = 50_000

# Where a sentence or line ends, with the white space after it.
UNIT_END = re.compile(r"[.!?\u2026][\"'\u201d\u2019)\]]*\s+|\n\s*")
RUNS = "row long, place long, long long, short long"


def _lines(text: Column) -> Column:
    return F.split(text, LINE_BREAK, -1)


def _is_line(line: Column) -> Column:
    return F.trim(line) != ""


def windows(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """One row per window: owner, doc_id, pos (of its first line among the lines), lines (where they stand), long and short (hashes)."""

    def digest(line: Column, i: Column) -> Column:
        x = F.trim(line)
        return F.struct(i.alias("i"), (x != "").alias("counts"), F.xxhash64(x).alias("long"), F.hash(x).alias("short"))

    counted = F.filter(F.transform(_lines(F.col("text")), digest), lambda s: s["counts"])
    held = docs.select("owner", "doc_id", counted.alias("a")).where(F.size("a") >= width)
    at = F.sequence(F.lit(0), F.size("a") - width)

    def window(i: Column) -> Column:
        each = [F.get("a", i + k) for k in range(width)]
        long, short = F.xxhash64(*[e["long"] for e in each]), F.hash(*[e["short"] for e in each], F.lit(7))
        return F.struct(i.alias("pos"), F.array(*[e["i"] for e in each]).alias("lines"), long.alias("long"), short.alias("short"))

    return held.select("owner", "doc_id", F.explode(F.transform(at, window)).alias("w")).select("owner", "doc_id", "w.*")


def covered(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """For every document with repeats: owner, doc_id and the array of its line positions to remove."""
    seen = windows(docs, width)
    repeated = seen.groupBy("long", "short").count().where("count > 1").select("long", "short")
    repeats = materialize(seen.join(repeated, ["long", "short"]), "repeats")
    place = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("owner"), F.col("pos"))
    firsts = repeats.groupBy("long", "short").agg(F.min(place).alias("first"))
    later = repeats.join(firsts, ["long", "short"]).where(place != F.col("first"))
    same = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.owner") == F.col("owner"))
    start = F.when(same, F.greatest(F.col("pos"), F.col("first.pos") + width)).otherwise(F.col("pos"))
    lines = F.slice("lines", F.least(start - F.col("pos"), F.lit(width)) + 1, F.lit(width))
    spans = later.select("owner", "doc_id", F.explode(lines).alias("line"))
    return spans.groupBy("owner", "doc_id").agg(F.collect_set("line").alias("gone"))


def deduplicated(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """All rows and columns of ``docs`` with later repeats taken out of ``text``."""
    rows, names = packed(docs, ("n_lines", "n_removed"))
    source = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "keyed")
    owner = F.struct(F.xxhash64("text").alias("hash"), F.col("row").alias("row"))
    gone = covered(source.select(owner.alias("owner"), "doc_id", "text"), width).select(F.col("owner.row").alias("row"), "gone")
    joined = source.join(gone, "row", "left")
    kept = F.filter(_lines(F.col("text")), lambda x, i: ~F.array_contains("gone", i))
    text = F.when(F.col("gone").isNotNull(), F.array_join(kept, LINE_BREAK)).otherwise(F.col("text"))
    n_lines = F.coalesce(F.size(F.filter(_lines(F.col("text")), _is_line)), F.lit(0))
    return unpacked(joined, names, text, n_lines=F.greatest(n_lines, F.lit(0)), n_removed=F.coalesce(F.size("gone"), F.lit(0)))


def runs_of(text: str, words: int = PASSAGE_WORDS) -> Iterator[tuple[int, int, str]]:
    """(start, end, content) of the shortest runs of whole sentences or lines of more than ``words`` words."""
    starts = [0, *(m.end() for m in UNIT_END.finditer(text))]
    units = [(a, b, held) for a, b in zip(starts, [*starts[1:], len(text)], strict=True) if (held := text[a:b].split())]
    upto = np.cumsum([0, *(len(held) for *_, held in units)])
    if upto[-1] <= words:
        return
    forward = enumerate(np.searchsorted(upto, upto[:-1] + words, side="right").tolist())
    backward = ((i, j) for j, i in enumerate((np.searchsorted(upto, upto - words, side="left") - 1).tolist()))
    content = [" ".join(held) for *_, held in units]
    for i, j in sorted({(i, j) for source in (forward, backward) for i, j in source if i >= 0 and j <= len(units)}):
        yield units[i][0], units[j - 1][1], " ".join(content[i:j])


def runs(docs: DataFrame, words: int = PASSAGE_WORDS) -> DataFrame:
    """One row per run of (row, text): row, place (start and stop in characters, in one number), long and short (hashes)."""

    def table(held: list) -> pd.DataFrame:
        return pd.DataFrame(held, columns=["row", "place", "long", "short"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row, text in zip(frame["row"].tolist(), frame["text"], strict=True):
                for a, b, content in runs_of(text if isinstance(text, str) else "", words):
                    digest = hashlib.blake2b(content.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                    long, short = (int.from_bytes(x, "little", signed=True) for x in (digest[:8], digest[8:]))
                    out.append((row, a << 32 | b, long, short))
                if len(out) >= RUNS_TOGETHER:
                    yield table(out)
                    out = []
            yield table(out)

    return docs.select("row", "text").mapInPandas(tidy(run), RUNS)


def without_passages(docs: DataFrame, words: int = PASSAGE_WORDS) -> DataFrame:
    """All rows and columns of ``docs`` with later repeats of passages cut out of ``text``; ``n_cut`` counts the runs covered.

    Runs travel as four numbers. Half their hash finds those that may be repeats, the whole hash decides, and ids are joined to
    the repeats only.
    """
    rows, names = packed(docs, ("n_cut",))
    source = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "keyed")
    seen = runs(source, words)
    likely = seen.groupBy("long").agg(F.count("*").alias("n")).where("n > 1").select("long")
    repeats = seen.join(likely, "long", "left_semi").select(
        "row", F.shiftright("place", 32).cast("int").alias("pos"), F.col("place").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("stop"), "long", "short"
    )
    repeats = materialize(repeats, "passages")
    owners = repeats.select("row").distinct()
    repeats = materialize(repeats.join(source.select("row", "doc_id").join(owners, "row", "left_semi"), "row"), "owned-passages")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", "pos", "stop")
    firsts = repeats.groupBy("long", "short").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = repeats.join(firsts, ["long", "short"]).where((F.col("row") != F.col("first.row")) | (F.col("pos") != F.col("first.pos")))
    start = F.when(F.col("row") == F.col("first.row"), F.greatest("pos", F.col("first.stop"))).otherwise(F.col("pos"))
    spans = later.select("row", F.struct(start.alias("start"), F.col("stop").alias("end")).alias("s")).where("s.start < s.end")
    gone = spans.groupBy("row").agg(F.array_sort(F.collect_set("s")).alias("gone"))
    joined = source.join(gone, "row", "left")
    return unpacked(joined, names, without_spans(F.col("text"), F.col("gone")), n_cut=F.coalesce(F.size("gone"), F.lit(0)))
