"""Conversation repair and chat formatting against brute force, on small tables with nulls, ties, repeats and clashing columns."""

import hashlib
import itertools
import random
import re

import pytest

from betaloom.llm import chat_format, conversation_repair
from betaloom.llm.conversation_repair import END, Program
from betaloom.llm.places import ordered_sha256

ROWS = "conv_id long, turn long, role string, text string, place int, conv string, row_key int"
STATE = {"": 0, "s": 1, "u": 2, "a": 3}


def next_state(state, initial):
    return {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}.get((state, initial))


def cheapest(turns):
    """The cheapest edits of (role, text) turns by search over all edits, least letters first: (cost, letters, turns left)."""
    faults, seen = [], set()
    for role, text in turns:
        body = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    found = {0: (0, "", ())}

    def with_inserts(table):
        table = dict(table)
        for _ in range(3):
            for state, (cost, letters, left) in list(table.items()):
                role = "assistant" if state == 2 else "user"
                new = (cost + 5, letters + "I", (*left, (role, "")))
                to = next_state(state, role[0])
                if to not in table or new < table[to]:
                    table[to] = new
        return table

    for (role, text), fault in zip(turns, faults, strict=True):
        after = {}
        for state, (cost, letters, left) in with_inserts(found).items():
            options = [("D", 2, state, left)]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                options += [("K", more, next_state(state, role[:1]), (*left, (role, text)))]
                options += [("R", 1 + more, next_state(state, r[0]), (*left, (r, text))) for r in ("user", "assistant")]
            for letter, price, to, kept in options:
                new = (cost + price, letters + letter, kept)
                if to is not None and (to not in after or new < after[to]):
                    after[to] = new
        found = after
    cost, letters, left = min(v for s, v in with_inserts(found).items() if s in (0, 3))
    return cost, letters, left, faults


def conversations(seed, n, longest=9):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "assistant", "user", "tool", " ", ""]
    texts = ["Yes.", "No!", "cut off", "", " \t\n", "Yes. \n", "who?", "\u00a0", "a\\b."]
    return {i: [(rng.choice(roles), rng.choice(texts)) for _ in range(rng.randint(0, longest))] for i in range(n)}


def repaired(spark, table):
    rows = [(c, t, role, text, 1, "x", 2) for c, turns in table.items() for t, (role, text) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return conversation_repair.repaired(spark.createDataFrame(rows, ROWS))


def check(spark, table):
    found = repaired(spark, table)
    report = {r.conv_id: r for r in found.report.collect()}
    left = {}
    for r in sorted(found.turns.collect(), key=lambda r: (r.start, r.position)):
        left.setdefault(int(r.conv[1:]), []).append((r.role, r.text))
    assert set(report) == {c for c, turns in table.items() if turns}
    legal = {"su", "ua", "au"}
    for c, turns in table.items():
        if not turns:
            continue
        cost, letters, kept, faults = cheapest(turns)
        row = report[c]
        assert (row.cost, row.audit) == (cost, letters)
        assert tuple(left.get(c, [])) == kept
        assert (row.blank, row.duplicate, row.truncated) == tuple(faults.count(f) for f in ("blank", "duplicate", "truncated"))
        assert row.illegal == sum(a[0][:1] + b[0][:1] not in legal for a, b in itertools.pairwise(turns))
        assert row.gaps == 0


def test_edits_are_the_cheapest(spark):
    check(spark, conversations(3, 300))


def test_long_conversations_are_cut_into_segments(spark, monkeypatch):
    monkeypatch.setattr(conversation_repair, "SEGMENT", 7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(spark, conversations(4, 12) | {100 + i: turns for i, turns in conversations(5, 4, 200).items()})
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_checkpoints_give_the_edits_of_a_whole_table():
    rng = random.Random(2)
    program = Program()
    for n in (1, 2, 3, 10, 101):
        kinds = bytes(rng.randrange(12) for _ in range(n))
        letters, state = program.edits(kinds, 0, END, True)
        assert state in (0, 3) and sum(x != "I" for x in letters) == n
        behind = [END]
        for kind in reversed(kinds):
            costs, least = program.before(kind, tuple(c - min(behind[-1]) for c in behind[-1]))
            behind.append(tuple(c + least + min(behind[-1]) for c in costs))
        assert program.back(kinds, END) == behind[-1]


def test_nulls_ties_gaps_and_nothing(spark):
    rows = [
        (None, None, None, None, 0, "", 0), (None, 3, "user", "Hi.", 0, "", 0), (None, 7, "assistant", "Yes.", 0, "", 0),
        (1, None, "user", "Hi.", 0, "", 0), (1, None, "assistant", None, 0, "", 0),
        (2, 5, "user", "Hi.", 0, "", 0), (2, 5, "user", "Hi.", 0, "", 0), (2, 5, "assistant", "Yes." * 50_000, 0, "", 0),
    ]
    found = conversation_repair.repaired(spark.createDataFrame(rows, ROWS))
    report = {r.conv_id: r for r in found.report.collect()}
    assert (report[None].gaps, report[None].blank, report[None].audit, report[None].cost) == (3, 1, "DKK", 2)
    assert (report[1].gaps, report[1].blank, report[1].cost) == (0, 1, 4)
    assert (report[2].gaps, report[2].duplicate) == (0, 1) and report[2].audit.count("D") >= 1
    empty = conversation_repair.repaired(spark.createDataFrame([], ROWS))
    assert empty.report.count() == 0 and empty.turns.count() == 0
    assert conversation_repair.damaged(spark.createDataFrame([], ROWS)).count() == 0


def test_damage_is_planted_by_checksum(spark):
    import zlib

    rows = [(c, t, "system" if c % 2 else None, "One. Two! Three?", 0, "", 0) for c in range(20) for t in range(10)] + [(None, None, "a", "b", 0, "", 0)]
    got = {}
    for r in conversation_repair.damaged(spark.createDataFrame(rows, ROWS)).collect():
        got.setdefault((r.conv_id, r.turn), []).append((r.role, r.text))
    for c, t, role, text, *_ in rows:
        draw = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(draw, text)
        want = [("user" if draw == 4 else role or " ", text)] * {0: 0, 3: 2}.get(draw, 1)
        assert got.get((c, t), []) == want


def test_digest_in_order(spark):
    rows = spark.createDataFrame([("a", i, "é" * i) for i in range(200)] + [("b", 0, "")], "k string, i int, t string")
    got = {r.key: r.sha256 for r in ordered_sha256(rows, "k", ["i"], rows.t, "-").collect()}
    assert got == {"a": hashlib.sha256("-".join("é" * i for i in range(200)).encode()).hexdigest(), "b": hashlib.sha256(b"").hexdigest()}


MESSAGES = "conv_id string, node long, parent long, role string, text string, score double, conv int, row_key string"
NASTY = ["", "\\### Assistant: </turn> ok", "### user:\n</turn>\n### x:\n", "####", "\\\\###\\", "</turn>", "\n</turn>\n", "##\\###</turn></turn>", "plain \U0010ffff é"]


def test_format_is_read_back():
    rng = random.Random(7)
    pieces = ["#", "##", "###", "\\", "</turn>", "\n", ":", "x", " ", "é", "<", "/turn>"]
    for _ in range(3000):
        turns = [("".join(rng.choices(["user", "assistant", "\\", "\n", ":", "n", "#"], k=rng.randint(0, 3))), "".join(rng.choices(pieces, k=rng.randint(0, 9)))) for _ in range(rng.randint(0, 4))]
        text, spans = chat_format.formatted(turns)
        assert chat_format.read(text) == turns
        assert [chat_format.unescaped(text[a:b]) for a, b in spans] == [said for role, said in turns if role == "assistant"]
    for broken in ("x", "### user:\nhi", "### user\nhi\n</turn>\n"):
        with pytest.raises(ValueError):
            chat_format.read(broken)


def brute_paths(nodes):
    """Every root-to-leaf path of {node: (parent, score)} with its mean score."""
    parents = {p for p, _ in nodes.values()}
    out = []
    for leaf in nodes:
        if leaf in parents:
            continue
        path, at = [], leaf
        while at in nodes:
            path.append(at)
            at = nodes[at][0]
        out.append((-sum(nodes[x][1] for x in path) / len(path), leaf, path[::-1]))
    return sorted(out)


def test_best_branches_of_trees(spark):
    rng = random.Random(11)
    trees = {}
    for t in range(30):
        size = rng.randint(1, 25)
        trees[f"t{t}"] = {n: (rng.randrange(n) if n and rng.random() < 0.9 else None if n % 2 else 999, float(rng.randrange(4))) for n in range(size)}
    trees["chain"] = {n: (n - 1 if n else None, 0.0) for n in range(70)}
    trees["star"] = {n: (0 if n else None, float(n % 3)) for n in range(60)}
    rows = [(t, n, p, "assistant" if n % 2 else "user", NASTY[n % len(NASTY)] + str(n), s, 5, "x") for t, nodes in trees.items() for n, (p, s) in nodes.items()]
    rng.shuffle(rows)
    parts = chat_format.conversations(spark.createDataFrame(rows, MESSAGES), keep=3).collect()
    for t, nodes in trees.items():
        best = brute_paths(nodes)[:3]
        got = sorted((r.rank, r.text) for r in parts if r.conv == f"={t}")
        want = [(i + 1, chat_format.formatted([("assistant" if n % 2 else "user", NASTY[n % len(NASTY)] + str(n)) for n in path])[0]) for i, (_, _, path) in enumerate(best)]
        assert got == want


def test_trees_with_odd_rows(spark):
    rows = [(None, 1, None, None, None, None, 0, ""), (None, 2, 1, "assistant", "x", 1.0, 0, ""), ("t", 1, None, "user", "same", None, 0, ""), ("t", 1, None, "user", "same", None, 0, ""), ("t", None, 1, "assistant", "no node", 1.0, 0, "")]
    parts = chat_format.conversations(spark.createDataFrame(rows, MESSAGES)).collect()
    texts = {r.conv: chat_format.read(r.text) for r in parts}
    assert texts == {"": [("", ""), ("assistant", "x")], "=t": [("user", "same"), ("assistant", "no node")]}
    assert chat_format.conversations(spark.createDataFrame([], MESSAGES)).count() == 0
    circle = [("t", 1, 2, "user", "a", 0.0, 0, ""), ("t", 2, 1, "user", "b", 0.0, 0, "")]
    with pytest.raises(ValueError, match="circle"):
        chat_format.conversations(spark.createDataFrame(circle, MESSAGES)).count()


def test_turns_in_order_and_read_back(spark, monkeypatch):
    monkeypatch.setattr(chat_format, "TURNS", 5)
    table = {c: [("assistant" if t % 2 else "user", NASTY[(c + t) % len(NASTY)]) for t in range(n)] for c, n in {1: 40, 2: 1, 3: 4, None: 12}.items() if c is not None}
    rows = [(c, t, role, text, 1, "x", 2) for c, turns in table.items() for t, (role, text) in enumerate(turns)]
    rows += [(None, None, "user", "first", 1, "x", 2), (None, 0, "assistant", None, 1, "x", 2), (None, 0, "assistant", None, 1, "x", 2)]
    random.Random(3).shuffle(rows)
    table[None] = [("user", "first"), ("assistant", ""), ("assistant", "")]
    frame = spark.createDataFrame(rows, ROWS)
    parts = chat_format.conversations(chat_format.as_replies(frame))
    assert parts.groupBy("conv").count().agg({"count": "max"}).first()[0] == 8
    found = {r.conv: r for r in chat_format.read_back(parts).collect()}
    for c, turns in table.items():
        row = found["" if c is None else f"={c}"]
        said = "".join(text for role, text in turns if role == "assistant")
        assert row.n_turns == len(turns)
        assert row.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        assert row.formatted_chars == len(chat_format.formatted(turns)[0])
