"""Odd column names, large groups, hash collisions and long texts."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from betaloom.llm import best_fit, blocks, language, line_dedup, near_dedup, sampled_pieces, secrets, token_counts
from betaloom.llm.tokens import SpanHash, code_points, default_vocabulary

ODD = ["a.b", "__row", "__gone", "row", "rest", "c0", "gone", "spans", "blob", "none", "found", "lang"]


def with_odd_columns(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return rows.select("doc_id", *[F.concat(F.lit(f"{c}-"), "doc_id").alias(c) for c in ODD], "text")


def odd_columns_of(row):
    return [row[c] for c in ODD]


def test_odd_column_names_pass_through(spark):
    block = "one line.\ntwo lines.\nthree lines."
    long = " ".join(f"w{i}" for i in range(60)) + "."
    table = with_odd_columns(spark, [block, block + "\nown", None, f"{long} x. password: abcdefgh1", f"y. {long}"])
    for made, extra in (
        (line_dedup.deduplicated(table), ["n_lines", "n_removed"]),
        (line_dedup.without_passages(table), ["n_cut"]),
        (secrets.redacted(table), []),
        (language.identify(table), ["lang_pred", "score"]),
    ):
        assert made.columns == ["doc_id", *ODD, "text", *extra]
        for r in made.collect():
            assert odd_columns_of(r) == [f"{c}-{r.doc_id}" for c in ODD]
    assert {r.doc_id: r.text for r in line_dedup.deduplicated(table).collect()}[1] == "own"
    assert "abcdefgh1" not in {r.doc_id: r.text for r in secrets.redacted(table).collect()}[3]
    assert {r.doc_id: r.text for r in line_dedup.without_passages(table).collect()}[4] == "y. "


def test_many_spans_in_one_text_take_linear_time(spark):
    text = "x token=abcdefgh y\n" * 40_000
    table = spark.createDataFrame([(1, text)], "doc_id long, text string")
    secrets.redacted(table.limit(0)).count()
    began = time.perf_counter()
    got = secrets.redacted(table).first().text
    assert got == "x [secret] y\n" * 40_000
    assert time.perf_counter() - began < 20


def thue_morse(n, letters):
    out = [0]
    while len(out) < n:
        out += [1 - x for x in out]
    return "".join(letters[x] for x in out)


@pytest.fixture(scope="module")
def pair():
    return thue_morse(1024, "ab"), thue_morse(1024, "ba")


def test_words_that_a_power_of_two_modulus_mixes_up(spark, pair):
    from tokenizers import Tokenizer

    codes = code_points("".join(pair))
    found = SpanHash()(codes, np.array([0, 1024]), np.array([1024, 2048]))
    assert found[0] != found[1]
    table = spark.createDataFrame([*enumerate(pair), (2, " ".join(pair))], "doc_id long, text string").coalesce(1)
    library = Tokenizer.from_file(default_vocabulary())
    import zlib

    got = {r.doc_id: r.ids_crc32 for r in best_fit.pack(table).collect()}
    for i, text in enumerate(pair):
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        assert got[i] == zlib.crc32(np.array(ids, "<u4").tobytes())
    groups = {r.doc_id: r.component_id for r in near_dedup.groups(table, 3, (85, 100)).collect()}
    assert groups == {0: 0, 1: 1, 2: 2}


def test_sampling_is_lossless_for_every_character(spark, pair):
    texts = [*pair, "a \U0010ffff b", "▁ \U0010ffff▁", "".join(pair)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    sampler = sampled_pieces.Sampler(sampled_pieces.default_model())
    ids, bounds = sampler.encode(texts, np.arange(len(texts), dtype=np.uint64))
    assert [sampler.decode(ids[a:b].tolist()) for a, b in zip(bounds, bounds[1:], strict=False)] == texts
    assert all(r.lossless for r in sampled_pieces.encode(table, digests=True).collect())


def test_hashes_of_spans_don_t_depend_on_their_place():
    rng = np.random.default_rng(0)
    word = rng.integers(1, 0x110000, 50).astype(np.uint32)
    text = np.concatenate([rng.integers(1, 0x110000, 200_000).astype(np.uint32), word, rng.integers(1, 99, 70_000).astype(np.uint32), word, word[:49]])
    spans = SpanHash()
    a, b, c = spans(text, np.array([200_000, 270_050, 270_100]), np.array([200_050, 270_100, 270_149]))
    assert a == b != c


def test_token_files_of_any_name_are_read(spark, tmp_path):
    ids = np.array([5, 6, 50256, 7, 50256], "<u2")
    for name, part in (("shard_0.bin", ids[:2]), ("shard_1.bin", ids[2:]), ("_hidden", ids), (".other", ids)):
        (tmp_path / name).write_bytes(part.tobytes())
    assert sorted(r.n_tokens for r in token_counts.counted(spark, f"file://{tmp_path}").collect()) == [1, 2]


def brute_components(names, linked):
    root = {n: n for n in names}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in names}


@pytest.mark.parametrize("shape", ["near", "chain", "star", "apart", "two"])
def test_large_groups_keep_their_components(spark, monkeypatch, shape):
    """Members are points on a line or circle; two are linked if near enough. Blocks are small, so groups span many."""
    monkeypatch.setattr(blocks, "BLOCK", 16)
    monkeypatch.setattr(blocks, "PIVOTS", 3)
    monkeypatch.setattr(blocks, "MORE_PIVOTS", 6)
    rng = np.random.default_rng(5)
    n = 300
    at = {
        "near": rng.uniform(0, 0.9, n), "chain": np.arange(n) * 0.9, "star": np.r_[0.0, rng.choice([-0.99, 0.99], n - 1)], "apart": np.arange(n) * 5.0,
        "two": np.r_[rng.uniform(0, 0.5, n - 30), rng.uniform(1.4, 1.9, 29), 0.95],
    }[shape]
    rows = [("g", f"{i:04d}".encode(), n, float(x)) for i, x in enumerate(at)] + [("h", b"x", 2, 0.0), ("h", b"y", 2, 0.5)]
    table = spark.createDataFrame(rows, "key string, class binary, many long, x double")
    looked = []

    def work(frame):
        looked.append(len(frame))
        x = frame["x"].to_numpy()
        return near_dedup._edges(frame, np.abs(x[:, None] - x) < 1)

    found = blocks.edges_within(lambda wanted: table.where(wanted), "key", "many", ["x"], work, n)
    got = {bytes(r.node).decode(): bytes(r.root).decode() for r in blocks.components(found).collect()}
    names = [f"{i:04d}" for i in range(n)]
    near = np.argwhere(np.triu(np.abs(at[:, None] - at) < 1, 1))
    want = brute_components(names, [(names[a], names[b]) for a, b in near])
    assert {k: got.get(k, k) for k in names} == want
    assert got["x"] == got["y"] == "x"


def test_rows_dealt_for_a_near_copy_group_grow_with_its_members(spark):
    n = 80_000
    table = spark.range(n).select(F.lit("g").alias("key"), F.unhex(F.md5(F.col("id").cast("string"))).alias("class"), F.lit(n).cast("long").alias("many"))
    members = table.select("key", "class", F.col("many").alias("left"))
    units = blocks._with_pivots(members, blocks._pivots(members, "key", blocks.PIVOTS, 21).withColumn("main", F.lit(False)), table.drop("many"), "key", "left", 31)
    assert n <= units.count() < 2 * n
    assert units.groupBy("unit").count().agg(F.max("count")).first()[0] < 2 * blocks.BLOCK


def test_lists_of_one_group_give_the_same_edges(spark, monkeypatch):
    """Lists that share most members link each with few others, whatever the number of lists."""
    monkeypatch.setattr(blocks, "BLOCK", 64)
    monkeypatch.setattr(blocks, "PIVOTS", 8)
    rng = np.random.default_rng(4)
    n, share = 300, {"small": 50, "large": 270}
    names = [bytes(x) for x in rng.integers(0, 256, (n, 16), np.uint8)]
    for many in share.values():
        rows = [(f"{k}", names[i], many, 0.0) for k in range(24) for i in rng.choice(n, many, replace=False)]
        table = spark.createDataFrame(rows, "key string, class binary, many long, x double")
        found = blocks.edges_within(lambda wanted, t=table: t.where(wanted), "key", "many", ["x"], lambda f: near_dedup._edges(f, np.ones((len(f), len(f)), bool)), many)
        edges = {tuple(sorted((bytes(r.a), bytes(r.b)))) for r in found.where("a <> b").collect()}
        linked = {x for pair in edges for x in pair}
        assert set(brute_components(sorted(linked), edges).values()) == {min(linked)}
        assert len(edges) <= 8 * n
    assert len(linked) == n and len(edges) <= 4 * n


def test_components_of_paths_cycles_and_repeated_edges(spark):
    rng = np.random.default_rng(8)
    pairs = [(i, i + 1) for i in range(40)] + [(100 + i, 100 + (i * 7 + 3) % 30) for i in range(30)] + [(200, 200 + i) for i in range(60)] * 2
    pairs += [tuple(p) for p in rng.integers(300, 420, (70, 2)).tolist()] + [(500, 500)]
    shown = rng.permutation(1000)
    names = [(f"{shown[a]:04d}", f"{shown[b]:04d}") for a, b in pairs]
    table = spark.createDataFrame([(a.encode(), b.encode()) for a, b in names] + [(None, b"x"), (b"x", None)], blocks.EDGES)
    rows = [(bytes(r.node).decode(), bytes(r.root).decode()) for r in blocks.components(table).collect()]
    linked = [p for p in names if p[0] != p[1]]
    assert dict(rows) == brute_components(sorted({x for p in linked for x in p}), linked)
    assert len(rows) == len(dict(rows))
    assert blocks.components(table.where("a IS NULL")).count() == 0


def test_large_groups_read_each_text_once(spark, monkeypatch, tmp_path):
    """Groups of both kinds are there; what makes a full set of a text runs once for it."""
    monkeypatch.setattr(blocks, "BLOCK", 16)
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    base = [f"w{i}" for i in range(300)]
    texts = [" ".join([*base[:150], f"x{i}", *base[150:]]) for i in range(40)] + [" ".join(f"{i}y{j}" for j in range(80)) for i in (1, 1, 2, 3)]
    texts[-3] += " more"
    spark.createDataFrame([(i, t, str(tmp_path)) for i, t in enumerate(texts)], "doc_id long, text string, path string").write.parquet(str(tmp_path / "docs"))
    seen = []
    monkeypatch.setattr(near_dedup, "edges_within", lambda *a: seen.append(a) or blocks.edges_within(*a))
    got = {r.doc_id: r.component_id for r in near_dedup.groups(spark.read.parquet(str(tmp_path / "docs")), width=3, share=(85, 100)).collect()}
    assert got == {i: 0 for i in range(40)} | {40: 40, 41: 40, 42: 42, 43: 43}
    for args in seen:  # rows of groups are scanned from a table, not made for each kind of group
        plan = args[0](F.lit(True))._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "MapInPandas" not in plan


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_passages_are_cut_in_one_worker_of_a_task(spark):
    """The filter on what is left reads the texts that were cut; it doesn't cut them again."""
    lines = [(i, f"own {i}. " + " ".join(f"w{j}" for j in range(60)) + ".", "en", "s", 1) for i in range(4)]
    done = corpus_pipeline.repeated_lines(spark, spark.createDataFrame(lines, COLUMNS), "")
    assert done._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert [len(r.text) < 10 for r in done.orderBy("doc_id").collect()] == [False, True, True, True]


def test_tables_of_the_span_hash_go_with_the_task(spark):
    from pyspark.sql import functions as F

    table = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit("a b c d "), F.col("id")).alias("text"))
    assert near_dedup.groups(table.repartition(1), width=3, share=(85, 100)).count() == 40

    def held(frames):
        import pandas as pd

        for frame in frames:
            yield pd.DataFrame({"n": [len(near_dedup._spans)] * len(frame)})

    assert {r.n for r in spark.range(64).repartition(8).mapInPandas(held, "n long").collect()} == {0}


def test_the_whole_pipeline_on_planted_rows(spark, tmp_path):
    rng = np.random.default_rng(3)
    words = {"en": "the of and that with this from have they were which their".split(), "de": "der die und das nicht mit sich auf für eine auch nach".split()}

    def prose(lang, n):
        return " ".join(rng.choice(words[lang], n)) + "."

    texts = {i: (prose("en" if i % 2 else "de", 60), "en" if i % 2 else "de") for i in range(60)}
    secret = "password = hunter2hunter2"
    texts[100] = (f"{prose('en', 40)} {secret} {prose('en', 30)}", "en")
    texts[101] = (texts[1][0], "en")
    texts[102] = ("1234 5678", "en")
    texts[103] = (None, "en")
    rows = [(i, t, lang, "s", len(t or "")) for i, (t, lang) in texts.items()]
    spark.createDataFrame(rows, COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    known = corpus_pipeline.known_language(spark, docs, "")
    assert {r.doc_id for r in known.collect()} == set(texts) - {102, 103}
    assert known._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    cleaned = {r.doc_id: r.text for r in corpus_pipeline.secret_spans(spark, docs, "").collect()}
    assert "hunter2" not in cleaned[100] and "[secret]" in cleaned[100] and cleaned[1] == texts[1][0]
    plan = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert set(plan.doc_id) == set(texts) - {101, 102, 103}
    assert (plan.groupby("sequence_id").length.sum() <= 2048).all()
    from betaloom.llm.tokens import encoded

    (_, ids), = list(encoded([cleaned[100]], default_vocabulary()))
    assert plan.set_index("doc_id").length[100] == len(ids) + 1
