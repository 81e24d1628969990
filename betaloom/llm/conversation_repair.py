"""Cheapest repair of damaged conversations by a dynamic program that stores cost vectors at checkpoints only.

Rows of a conversation are taken by turn (nulls first; then by role, digest of the text, and row). Each row's first fault counts:
blank (no character but white space ``[\\x20\\x09-\\x0D]``), duplicate (role and text seen earlier), truncated (the last such
character isn't one of ``.!?``). Edits: Keep (0), Rerole to user or assistant (1), Delete (2; required for blank and
duplicate), Insert an empty user or assistant text anywhere (5); a truncated row that stays adds 5. The roles that are left must
read ``(s?(ua)+)?`` by their initials; a role of another initial can't stay as it is. Of the cheapest edits those whose initials
are least in ASCII are taken.

The program has four states: nothing yet, after a system row, after a user row, after an assistant row. Going
backward over n rows it stores the costs of the states at every sqrt(n)-th row; going forward it computes a block's costs again
from the checkpoint at its end and takes the least letter that keeps the cost.

A conversation of any length is cut into segments of bounded size by a sort by range. A segment is first reduced to a
4 x 4 matrix of costs from state to state; a scan over matrices gives the costs behind each segment, a scan over
the states each segment maps to gives the state before it; then segments are edited by themselves. Only conversations
that are cut take part in the scans.

Null roles and texts are one space; rows with a null conversation are one conversation; a null turn sorts first and counts
in no gap. Repeated rows are duplicates. Texts of any length are read in the JVM only. An empty table gives no rows. Only
``conv_id``, ``turn``, ``role`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from betaloom.llm.places import keyed, named, placed, unnamed
from betaloom.llm.tokens import tidy
from betaloom.tables import materialize

WHITE = " \t\n\x0b\x0c\r"
STOPS = ".!?"

# Costs of the edits.
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5

SYSTEM, USER, ASSISTANT, OTHER = range(4)
INITIALS = "sua"
SOUND, TRUNCATED, GOES = range(3)
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}

#: Where a row of a role leads from each state; states are 0 (start), 1 (system), 2 (user), 3 (assistant).
AFTER_ROLE = {SYSTEM: {0: 1}, USER: {0: 2, 1: 2, 3: 2}, ASSISTANT: {2: 3}, OTHER: {}}
#: The only row that may come next, other than a system row.
NEXT = {0: USER, 1: USER, 2: ASSISTANT, 3: USER}
STATES = (0, 1, 2, 3)
NEVER = 1 << 60

SEGMENT = 1 << 14

Costs = tuple[int, int, int, int]


def with_inserts(costs: Costs) -> Costs:
    """Costs when rows may be inserted first."""
    start, system, user, assistant = costs
    user, assistant = min(user, INSERT + assistant), min(assistant, INSERT + user)
    return min(start, INSERT + user), min(system, INSERT + user), user, assistant


#: Costs behind the last row: the conversation may end at the start or after an assistant row.
END = with_inserts((0, NEVER, NEVER, 0))


def choices(kind: int, state: int) -> Iterator[tuple[str, int, int]]:
    """Edits of a row by letter: (letter, cost, next state)."""
    role, fault = divmod(kind, 3)
    yield "D", DELETE, state
    if fault != GOES:
        more = CUT if fault == TRUNCATED else 0
        if state in AFTER_ROLE[role]:
            yield "K", KEEP + more, AFTER_ROLE[role][state]
        yield "R", REROLE + more, AFTER_ROLE[NEXT[state]][state]


class Program:
    """Steps of the dynamic program, remembered by kind of row and by costs relative to their least."""

    def __init__(self):
        self.steps: dict[tuple[int, Costs], tuple[Costs, int]] = {}
        self.moves: dict[tuple[int, int, Costs], tuple[str, int]] = {}

    def before(self, kind: int, after: Costs) -> tuple[Costs, int]:
        """Costs before a row, less their least, and that least. ``after`` has the least 0."""
        known = self.steps.get((kind, after))
        if known is None:
            costs = with_inserts(tuple(min(cost + after[to] for _, cost, to in choices(kind, s)) for s in STATES))
            least = min(costs)
            known = self.steps[kind, after] = tuple(min(c - least, NEVER) for c in costs), least
        return known

    def move(self, kind: int, state: int, after: Costs) -> tuple[str, int]:
        """The least letter among the cheapest before a row and the state it leads to; ``I`` stays before the row."""
        known = self.moves.get((kind, state, after))
        if known is None:
            own, least = self.before(kind, after)
            to_insert = AFTER_ROLE[NEXT[state]][state]
            tight = [(letter, to) for letter, cost, to in choices(kind, state) if cost + after[to] == own[state] + least]
            if INSERT + own[to_insert] == own[state]:
                tight.append(("I", to_insert))
            known = self.moves[kind, state, after] = min(tight)
        return known

    def back(self, kinds: bytes, after: Costs) -> Costs:
        """Whole costs before all of ``kinds``."""
        least = min(after)
        costs = tuple(min(c - least, NEVER) for c in after)
        for kind in reversed(kinds):
            costs, more = self.before(kind, costs)
            least += more
        return tuple(min(c + least, NEVER) for c in costs)

    def edits(self, kinds: bytes, state: int, after: Costs, last: bool) -> tuple[str, int]:
        """Letters of the cheapest edits from ``state`` and the state they end in; ``last`` if the conversation ends here."""
        block = max(1, isqrt(len(kinds)))
        marks, costs = [], tuple(c - min(after) for c in after)
        for low in range((len(kinds) - 1) // block * block, -1, -block):
            marks.append((low, costs))
            for kind in reversed(kinds[low : low + block]):
                costs, _ = self.before(kind, costs)
        letters = []
        for low, costs in reversed(marks):
            own = kinds[low : low + block]
            behind = [costs]
            for kind in reversed(own[1:]):
                behind.append(self.before(kind, behind[-1])[0])
            for kind, costs_behind in zip(own, reversed(behind), strict=True):
                letter = "I"
                while letter == "I":
                    letter, state = self.move(kind, state, costs_behind)
                    letters.append(letter)
        while last and state in (1, 2):
            letters.append("I")
            state = AFTER_ROLE[NEXT[state]][state]
        return "".join(letters), state


class Repair(NamedTuple):
    """``report``: a row per conversation. ``turns``: the repaired rows, in the order of (segment, position)."""

    report: DataFrame
    turns: DataFrame


SEGMENTS = "conv string, start long, whole boolean, kinds binary, keys array<long>, illegal long, costs array<long>"


def _segments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cut sorted rows into segments of one conversation and at most ``SEGMENT`` rows.

    The first and the last conversation of a partition may go on in its neighbours, so their segments aren't whole.
    """
    program = Program()
    names = [c.split()[0] for c in SEGMENTS.split(", ")]
    legal = [a * 4 + b for a, b in LEGAL]

    def described(conv: str, kinds: np.ndarray, keys: np.ndarray, start: int, whole: bool) -> tuple:
        roles, packed, costs = kinds // 3, kinds.tobytes(), None
        illegal = int((~np.isin(roles[:-1] * 4 + roles[1:], legal)).sum())
        if not whole:
            ends = [tuple(0 if s == t else NEVER for s in STATES) for t in STATES]
            columns = [program.back(packed, end) for end in ends]
            costs = [columns[t][s] for s in STATES for t in STATES]
        return conv, start, whole, packed, keys, illegal, costs

    held, opens = None, False
    for frame in frames:
        if not len(frame):
            continue
        columns = [frame["conv"].to_numpy(), frame["kind"].to_numpy(np.uint8), frame["key"].to_numpy(np.int64), frame["place"].to_numpy(np.int64)]
        if held is not None:
            columns = [np.concatenate(pair) for pair in zip(held, columns, strict=True)]
        conv, kinds, keys, places = columns
        starts = np.r_[0, np.flatnonzero(conv[1:] != conv[:-1]) + 1, len(conv)]
        done = []
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            opens = opens or a > 0
            while b - a > SEGMENT:
                done.append(described(conv[a], kinds[a : a + SEGMENT], keys[a : a + SEGMENT], int(places[a]), False))
                a, opens = a + SEGMENT, False
            if b < len(conv):
                done.append(described(conv[a], kinds[a:b], keys[a:b], int(places[a]), opens))
                opens = True
            else:
                held = [column[a:b].copy() for column in columns]
        if done:
            yield pd.DataFrame(done, columns=names)
    if held is not None:
        yield pd.DataFrame([described(held[0][0], held[1], held[2], int(held[3][0]), False)], columns=names)


def _costs_behind(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Segments of each conversation from the last to the first: the costs behind each."""
    now, costs = None, END
    for frame in frames:
        out = []
        for conv, start, matrix in zip(frame["conv"], frame["start"], frame["costs"], strict=True):
            last = conv != now
            if last:
                now, costs = conv, END
            out.append((start, list(costs), last))
            costs = tuple(min(matrix[4 * s + t] + costs[t] for t in STATES) for s in STATES)
        yield pd.DataFrame(out, columns=["start", "behind", "last"])


def _exits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The state each segment ends in, for each state before it."""
    program = Program()
    for frame in frames:
        out = frame[["conv", "start"]].copy()
        rows = list(zip(frame["kinds"], frame["behind"], strict=True))
        out["exits"] = [[program.edits(bytes(kinds), s, tuple(map(int, behind)), False)[1] for s in STATES] for kinds, behind in rows]
        out["first"] = [kinds[0] // 3 for kinds, _ in rows]
        out["final"] = [kinds[-1] // 3 for kinds, _ in rows]
        yield out


def _states_before(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Segments of each conversation from the first to the last: the state before each, and if its seam is illegal."""
    now, state, final = None, 0, None
    for frame in frames:
        out = []
        for conv, start, exits, first, last in frame[["conv", "start", "exits", "first", "final"]].itertuples(index=False):
            if conv != now:
                now, state, final = conv, 0, None
            out.append((start, state, int(final is not None and (final, first) not in LEGAL)))
            state, final = int(exits[state]), last
        yield pd.DataFrame(out, columns=["start", "state", "seam"])


EDITED = "conv string, start long, audit string, cost long, illegal long, keys array<long>, roles array<string>"


def _edited(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    program = Program()
    roles = {USER: "user", ASSISTANT: "assistant"}
    for frame in frames:
        out = []
        for row in frame.itertuples(index=False):
            kinds, after = bytes(row.kinds), tuple(map(int, row.behind))
            letters, _ = program.edits(kinds, row.state, after, row.last)
            state, i, cost, keys, new = row.state, 0, 0, [], []
            for letter in letters:
                if letter == "D":
                    cost += DELETE
                    i += 1
                    continue
                kind, role = kinds[i] // 3 if letter == "K" else NEXT[state], None
                if letter == "I":
                    cost, key, role = cost + INSERT, None, roles[kind]
                else:
                    cost += (KEEP if letter == "K" else REROLE) + (CUT if kinds[i] % 3 == TRUNCATED else 0)
                    key, role, i = int(row.keys[i]), roles[kind] if letter == "R" else None, i + 1
                state = AFTER_ROLE[kind][state]
                keys.append(key)
                new.append(role)
            out.append((row.conv, row.start, letters, cost, row.illegal + row.seam, keys, new))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in EDITED.split(", ")])


def repaired(rows: DataFrame) -> Repair:
    """Faults and cheapest edits of each conversation, and its repaired rows.

    ``report``: conv, conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit. ``turns``: conv, start, position, role, text;
    ``conv`` names the conversation and is never null.
    """
    kind_of_id = rows.schema["conv_id"].dataType.simpleString()
    texts = rows.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    texts = keyed(texts.withColumn("conv", named("conv_id")), "turns")

    stripped = F.rtrim(F.col("text"), F.lit(WHITE))
    same = F.unhex(F.sha2(F.to_json(F.array("conv", "role", "text")).cast("binary"), 256))
    initial = F.substring("role", 1, 1)
    role = F.lit(OTHER)
    for number, letter in enumerate(INITIALS):
        role = F.when(initial == letter, F.lit(number)).otherwise(role)
    narrow = texts.select(
        "conv", "turn", "role", "row_key", same.alias("same"), role.cast("int").alias("class"),
        (stripped == "").alias("blank"), (~F.right(stripped, F.lit(1)).isin(*STOPS)).alias("cut"),
    )
    narrow = materialize(narrow, "turn-faults")
    first = F.struct(F.col("turn").isNotNull().alias("has"), "turn", "row_key")
    repeated = narrow.where("NOT blank").groupBy("same").agg(F.min(first).alias("first"), F.count("*").alias("n")).where("n > 1")
    flagged = narrow.join(repeated.select("same", F.col("first.row_key").alias("first_key")), "same", "left")
    duplicate = F.col("first_key").isNotNull() & (F.col("first_key") != F.col("row_key"))
    fault = F.when(F.col("blank") | duplicate, F.lit(GOES)).when(F.col("cut"), F.lit(TRUNCATED)).otherwise(F.lit(SOUND))
    flagged = materialize(
        flagged.select("conv", "turn", "role", "same", "row_key", "blank", (~F.col("blank") & duplicate).alias("duplicate"), (F.col("class") * 3 + fault).alias("kind")),
        "turn-kinds",
    )
    truncated = F.col("kind") % 3 == TRUNCATED
    counts = {"blank": F.col("blank"), "duplicate": F.col("duplicate"), "truncated": truncated}
    by_turn = flagged.groupBy("conv", "turn").agg(*[F.count_if(c).alias(name) for name, c in counts.items()])
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0))
    stats = by_turn.groupBy("conv").agg(gaps.cast("long").alias("gaps"), *[F.sum(name).alias(name) for name in counts])

    ordered = placed(flagged.select("conv", "turn", "role", "same", F.col("row_key").alias("key"), "kind"), ["conv", "turn", "role", "same", "key"])
    segments = materialize(ordered.select("conv", "kind", "key", "place").mapInPandas(tidy(_segments), SEGMENTS), "segments")
    parts = segments.where("NOT whole")
    behind = parts.select("conv", "start", "costs").repartition("conv").sortWithinPartitions("conv", F.desc("start"))
    behind = materialize(behind.mapInPandas(_costs_behind, "start long, behind array<long>, last boolean"), "costs-behind")
    exits = parts.select("conv", "start", "kinds").join(behind, "start").mapInPandas(_exits, "conv string, start long, exits array<int>, first int, final int")
    states = exits.repartition("conv").sortWithinPartitions("conv", "start").mapInPandas(_states_before, "start long, state int, seam long")
    known = materialize(behind.join(states, "start"), "segment-states")

    end = F.array(*[F.lit(c).cast("long") for c in END])
    todo = segments.join(known, "start", "left").select(
        "conv", "start", "kinds", "keys", "illegal", F.coalesce("behind", end).alias("behind"), F.coalesce("last", F.lit(True)).alias("last"),
        F.coalesce("state", F.lit(0)).alias("state"), F.coalesce("seam", F.lit(0)).alias("seam"),
    )
    edited = materialize(todo.mapInPandas(tidy(_edited), EDITED), "edited")
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "audit"))), lambda x: x["audit"]), "")
    per_conv = edited.groupBy("conv").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), audit.alias("audit"))
    report = stats.join(per_conv, "conv").select("conv", unnamed("conv", kind_of_id).alias("conv_id"), "gaps", *counts, "illegal", "cost", "audit")

    each = edited.select("conv", "start", F.posexplode(F.arrays_zip("keys", "roles")).alias("position", "turn"))
    each = each.select("conv", "start", "position", F.col("turn.keys").alias("row_key"), F.col("turn.roles").alias("new"))
    kept = each.where("row_key IS NOT NULL").join(texts.select("row_key", "role", "text"), "row_key")
    kept = kept.select("conv", "start", "position", F.coalesce("new", "role").alias("role"), "text")
    added = each.where("row_key IS NULL").select("conv", "start", "position", F.col("new").alias("role"), F.lit("").alias("text"))
    return Repair(report, kept.unionByName(added))


def damaged(rows: DataFrame) -> DataFrame:
    """Faults planted by the checksum of ``conv_id:turn``: a twentieth each is dropped, emptied, cut, repeated, or given to the user."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    draw = F.crc32(F.concat(text[0], F.lit(":"), text[1]).cast("binary")) % 20
    planted = rows.select("conv_id", "turn", text[2].alias("role"), text[3].alias("text"), draw.alias("draw")).where("draw <> 0")
    new_text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate("text", STOPS, "")).otherwise(F.col("text"))
    copies = F.when(F.col("draw") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return planted.select(
        "conv_id", "turn", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"), new_text.alias("text"), F.explode(copies).alias("copy")
    ).drop("copy")
