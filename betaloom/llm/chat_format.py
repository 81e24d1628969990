"""Reply trees to formatted conversations.

A message names its tree, itself and the message it answers. Iterative self-joins double the reach of every message's
pointer to its ancestors (1, 2, 4, ... answers up) and add up scores on the way, so a tree of depth d takes log2(d) joins. Leaves
are ranked in their tree by the mean score of their branch; the chosen leaves' paths are listed by going through the same
pointers from the longest to the shortest, each step doubling what is listed. Each path is formatted as one conversation.

The template writes a turn as ``### role:`` and a line break, the text, and a line ``</turn>``. A control string
(``###`` or ``</turn>``) inside a text gets a backslash before it and before the backslashes in front of it, so that reading takes exactly
one away; backslashes and line breaks in a role are written ``\\\\`` and ``\\n``. The loss mask is a list of code point spans that hold the
texts of assistant turns. A conversation is written in parts of at most ``TURNS`` turns (one part, for most); its spans count
from the start of the part.

Null roles and texts are empty; rows without a tree are one tree. A message whose parent isn't in its tree is a root. Messages with the same tree and
node are one: the first by parent, best score and row. Null scores are 0. Ties go to the leaf of the least node. Parents
that lead in a circle raise ValueError. Very long texts are held one batch at a time. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from betaloom.llm.places import keyed, named, placed, unnamed
from betaloom.llm.tokens import tidy
from betaloom.tables import materialize

ASSISTANT = "assistant"
HEAD, END = "### ", "</turn>"
CONTROL = re.compile(r"(\\*)(###|</turn>)")
ESCAPED = re.compile(r"\\(\\*(?:###|</turn>))")
ROLE = re.compile(r"\\(.)")
#: Turns of a part.
TURNS = 256


def escaped(text: str) -> str:
    return CONTROL.sub(r"\\\1\2", text)


def unescaped(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def formatted(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text of (role, text) turns and the spans of assistant texts in it."""
    pieces, spans, at = [], [], 0
    for role, text in turns:
        head = HEAD + role.replace("\\", "\\\\").replace("\n", "\\n") + ":\n"
        body = escaped(text)
        if role == ASSISTANT:
            spans.append((at + len(head), at + len(head) + len(body)))
        piece = f"{head}{body}\n{END}\n"
        pieces.append(piece)
        at += len(piece)
    return "".join(pieces), spans


def read(text: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    turns, at = [], 0
    while at < len(text):
        line = text.index("\n", at)
        head = text[at:line]
        if not (head.startswith(HEAD) and head.endswith(":")):
            raise ValueError(f"no turn begins at {at}")
        stop = text.find(f"\n{END}\n", line)
        # An escaped text has a backslash before each control string, so a line that is the end mark ends the turn.
        if stop < 0:
            raise ValueError(f"the turn at {at} has no end")
        role = ROLE.sub(lambda m: "\n" if m[1] == "n" else m[1], head[len(HEAD) : -1])
        turns.append((role, unescaped(text[line + 1 : stop])))
        at = stop + len(END) + 2
    return turns


def one_message_each(messages: DataFrame) -> DataFrame:
    """``conv``, ``node``, ``up`` (row_key of the parent) and ``score`` by ``row_key``; repeated nodes once."""
    best = F.min(F.struct(F.col("parent").isNull().alias("root"), "parent", (-F.col("score")).alias("rank"), "row_key")).alias("best")
    first = messages.where("node IS NOT NULL").groupBy("conv", "node").agg(best)
    first = first.select("conv", "node", F.col("best.parent").alias("parent"), (-F.col("best.rank")).alias("score"), F.col("best.row_key").alias("row_key"))
    nameless = messages.where("node IS NULL").select("conv", "node", "parent", "score", "row_key")
    rows = materialize(first.unionByName(nameless), "messages")
    known = rows.where("node IS NOT NULL").select("conv", F.col("node").alias("parent"), F.col("row_key").alias("up"))
    answers = rows.where("parent IS NOT NULL").join(known, ["conv", "parent"], "left").drop("parent")
    return answers.unionByName(rows.where("parent IS NULL").drop("parent").withColumn("up", F.lit(None).cast("long")))


def doubled(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Pointers 1, 2, 4, ... answers up (``row_key``, ``up``), and every node with its ``total`` score and ``length`` to the root."""
    state = materialize(nodes.select("conv", "node", "row_key", "up", F.col("score").alias("total"), F.lit(1).cast("long").alias("length")), "reach")
    levels, finished, before = [], [state.where("up IS NULL")], None
    while True:
        open_nodes = state.where("up IS NOT NULL")
        left = open_nodes.count()
        if not left:
            break
        if left == before:
            raise ValueError(f"the parents of {left} messages lead in a circle")
        before = left
        levels.append(open_nodes.select("row_key", "up"))
        target = state.select(F.col("row_key").alias("up"), F.col("up").alias("next"), F.col("total").alias("more"), F.col("length").alias("steps"))
        # A node that is done is reached by its whole way to the root; those of earlier rounds are still targets.
        moved = open_nodes.join(target, "up").select(
            "conv", "node", "row_key", F.col("next").alias("up"), (F.col("total") + F.col("more")).alias("total"), (F.col("length") + F.col("steps")).alias("length")
        )
        state = materialize(moved.unionByName(state.where("up IS NULL")), "reach")
    return levels, state


def paths(messages: DataFrame, keep: int = 1) -> DataFrame:
    """The ``keep`` best root-to-leaf paths of each tree: ``conv``, ``leaf``, ``rank``, ``position``, ``row_key``.

    ``messages`` holds conv, node, parent, score and row_key.
    """
    nodes = materialize(one_message_each(messages), "nodes")
    levels, ends = doubled(nodes)
    parents = nodes.where("up IS NOT NULL").select(F.col("up").alias("row_key")).distinct()
    leaves = ends.join(parents, "row_key", "left_anti").withColumn("mean", F.col("total") / F.col("length"))
    best = W.partitionBy("conv").orderBy(F.desc("mean"), F.col("node").asc_nulls_last(), "row_key")
    chosen = leaves.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep)
    listed = materialize(chosen.select("conv", F.col("row_key").alias("leaf"), "rank", "row_key", (F.col("length") - 1).alias("position")), "paths")
    for k in reversed(range(len(levels))):
        above = listed.join(levels[k], "row_key").select("conv", "leaf", "rank", F.col("up").alias("row_key"), (F.col("position") - (1 << k)).alias("position"))
        listed = materialize(listed.unionByName(above), "paths")
    return listed


PARTS = "conv string, leaf long, rank int, part long, text string, n_turns long, loss array<struct<start: long, stop: long>>"


def _parts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["conv", "leaf", "rank", "part", "text", "n_turns", "loss"]

    def part(key: tuple, turns: list[tuple[str, str]]) -> tuple:
        text, spans = formatted(turns)
        return *key, text, len(turns), [{"start": a, "stop": b} for a, b in spans]

    now, turns = None, []
    for frame in frames:
        done = []
        for conv, leaf, rank, number, role, text in frame.itertuples(index=False):
            key = (conv, leaf, rank, number)
            if key != now:
                if turns:
                    done.append(part(now, turns))
                now, turns = key, []
            turns.append((role, text))
        if done:
            yield pd.DataFrame(done, columns=names)
    if turns:
        yield pd.DataFrame([part(now, turns)], columns=names)


def conversations(messages: DataFrame, keep: int = 1) -> DataFrame:
    """Formatted conversations of reply trees: ``conv``, ``leaf``, ``rank``, ``part``, ``text``, ``n_turns``, ``loss``.

    ``messages`` holds conv_id (the tree), node, parent, role, text and, if branches are to be ranked, score. ``conv`` names the tree
    and is never null (``places.unnamed`` gives the id back).
    """
    score = F.coalesce(F.col("score").cast("double"), F.lit(0.0)) if "score" in messages.columns else F.lit(0.0)
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    rows = keyed(messages.select(named("conv_id").alias("conv"), "node", "parent", score.alias("score"), *texts), "replies")
    listed = paths(rows.select("conv", "node", "parent", "score", "row_key"), keep)
    turns = listed.join(rows.select("row_key", "role", "text"), "row_key").withColumn("part", F.floor(F.col("position") / TURNS))
    group = ["conv", "leaf", "rank", "part"]
    turns = turns.repartition(*group).sortWithinPartitions(*group, "position")
    return turns.select(*group, "role", "text").mapInPandas(tidy(_parts), PARTS)


READ = "conv string, leaf long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _read_back(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in READ.split(", ")]
    now, state = None, None

    def closed() -> tuple:
        n, turns, chars, loss, size = state
        return *now, n, turns.hexdigest(), chars, loss.hexdigest(), size

    for frame in frames:
        done = []
        for conv, leaf, text, spans in frame.itertuples(index=False):
            if (conv, leaf) != now:
                if state:
                    done.append(closed())
                now, state = (conv, leaf), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, said in read(text):
                state[0] += 1
                state[1].update(f"{role}\n{said}\n".encode())
            for span in spans:
                said = unescaped(text[span["start"] : span["stop"]])
                state[2] += len(said)
                state[3].update(said.encode())
            state[4] += len(text)
        if done:
            yield pd.DataFrame(done, columns=names)
    if state:
        yield pd.DataFrame([closed()], columns=names)


def read_back(parts: DataFrame) -> DataFrame:
    """Turns, loss text and size of each formatted conversation, read from its parts as they stream by.

    Digests need a conversation's parts in a row, so one task reads them; it holds a batch.
    """
    in_order = parts.select("conv", "leaf", "part", "text", "loss").repartition("conv", "leaf").sortWithinPartitions("conv", "leaf", "part")
    return in_order.select("conv", "leaf", "text", "loss").mapInPandas(tidy(_read_back), READ)


def as_replies(turns: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) as messages, each answering the one before it.

    Turns follow each other by turn (nulls first), then role, digest of the text, and row. Rows are sorted by range; a row whose
    predecessor lies in an earlier range finds it by the last row of that range.
    """
    columns = ["conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]]
    texts = keyed(turns.select(*columns).withColumn("conv", named("conv_id")), "turns")
    narrow = texts.select("conv", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), "row_key")
    order = ["conv", "turn", "role", "digest", "row_key"]
    ordered = materialize(placed(narrow, order).select("conv", "row_key", "place"), "places")
    part = F.shiftright("place", 33)
    ends = ordered.groupBy(part.alias("range")).agg(F.max_by("conv", "place").alias("conv"), F.max("place").alias("parent"))
    ends = ends.select(F.lead("range").over(W.orderBy("range")).alias("range"), "conv", "parent").where("range IS NOT NULL")
    inside = ordered.select("conv", (F.col("place") + 1).alias("place"), F.col("place").alias("parent"))
    across = ends.select("conv", F.shiftleft("range", 33).alias("place"), "parent")
    before = inside.unionByName(across)
    replies = ordered.join(before, ["conv", "place"], "left").select("row_key", F.col("place").alias("node"), "parent")
    return replies.join(texts, "row_key").select("conv_id", "node", "parent", "role", "text")
