import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from betaloom.functions import columns as C
from betaloom.functions.quantiles import global_quantiles, grouped_quantiles
from betaloom.functions.running import hash_prefix, running_totals

PROBS = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.99, "e": 1.0}


def awkward_groups():
    """One group with most rows, heavy ties, far outliers, a constant group, one value."""
    rng = np.random.default_rng(3)
    return {
        "hot": np.concatenate([rng.normal(size=3000), [1e9, -1e9]]),
        "ties": rng.integers(0, 3, size=500).astype(float),
        "flat": np.full(200, 0.25),
        "one": np.array([7.0]),
        "tiny": rng.normal(size=4) * 1e-12,
    }


@pytest.mark.parametrize("limit", [0, 10, 10_000])
def test_grouped_quantiles_equal_numpy(spark, limit):
    groups = awkward_groups()
    frame = pd.concat([pd.DataFrame({"g": g, "x": v}) for g, v in groups.items()])
    df = spark.createDataFrame(frame).unionByName(spark.createDataFrame([("hot", None)], "g string, x double"))
    got = grouped_quantiles(df, ["g"], "x", PROBS, limit).toPandas().set_index("g")
    assert sorted(got.index) == sorted(groups)
    for g, v in groups.items():
        np.testing.assert_allclose(got.loc[g, list(PROBS)].astype(float), np.percentile(v, [p * 100 for p in PROBS.values()]), rtol=1e-12)


@pytest.mark.parametrize("limit", [1, 50, 100_000])
def test_global_quantiles_equal_numpy(spark, limit):
    x = np.concatenate(list(awkward_groups().values()))
    df = spark.createDataFrame(pd.DataFrame({"x": x})).unionByName(spark.createDataFrame([(None,)], "x double"))
    got = global_quantiles(df, "x", (0.01, 0.5, 0.99), limit)
    np.testing.assert_allclose(got, np.percentile(x, [1, 50, 99]), rtol=1e-12)


def test_global_quantiles_without_values(spark):
    assert global_quantiles(spark.createDataFrame([(None,)], "x double"), "x", (0.5,)) is None


def test_running_totals_equal_a_plain_sort(spark):
    rng = np.random.default_rng(5)
    frame = pd.DataFrame({"k": rng.choice(["a", "a", "a", "b"], 400), "i": np.arange(400), "x": rng.integers(0, 9, 400)})
    df = spark.createDataFrame(frame).withColumn("h", F.md5(F.col("i").cast("string")))
    got = running_totals(df, ["k"], hash_prefix(F.col("h"), 1), ["h"], {"t": F.col("x"), "r": F.lit(1)}).toPandas()
    want = got.sort_values(["k", "h"])
    assert (want.groupby("k")["x"].cumsum() == want["t"]).all()
    assert (want.groupby("k").cumcount() + 1 == want["r"]).all()
    assert len(got) == 400


def test_parsed_number(rows):
    texts = {"0.5": 0.5, " 0.25 ": 0.25, "1e-3": 0.001, "NA": None, "NaN": None, "nan": None, "": None, "abc": None, "1.5f": None, "2d": None, "-3": -3.0}
    df = rows([(t,) for t in texts], "t string").select("t", C.parsed_number(F.col("t")).alias("v"))
    assert {r.t: r.v for r in df.collect()} == texts


@settings(max_examples=3, deadline=None)
@given(st.lists(st.floats(0, 1), min_size=1, max_size=50))
def test_m_value_inverts_to_the_clipped_beta(spark, betas):
    df = spark.createDataFrame([(b,) for b in betas] + [(None,)], "b double")
    got = df.select("b", C.beta_from_m(C.m_value(F.col("b"))).alias("back")).collect()
    for r in got:
        assert r.back is None if r.b is None else abs(r.back - min(max(r.b, 1e-3), 1 - 1e-3)) < 1e-12


def test_batch_id_and_portion(rows):
    df = rows([("TCGA-A-B-01A-11D-0001-05",), ("A-B-C-D-E-F",), ("A-B-C-D-E",), (None,)], "barcode string")
    got = df.select(C.batch_id(F.col("barcode")).alias("b")).select("b", C.portion(F.col("b")).alias("p")).collect()
    assert [(r.b, r.p) for r in got] == [("01A-0001", "01A"), ("D-F", "D"), (None, None), (None, None)]


def test_clipped_keeps_null(rows):
    df = rows([(None,), (5.0,), (-5.0,), (0.5,)], "x double")
    assert [r[0] for r in df.select(C.clipped(F.col("x"), F.lit(-1.0), F.lit(1.0))).collect()] == [None, 1.0, -1.0, 0.5]


def odd_values():
    rng = np.random.default_rng(6)
    return {
        "infinite": np.concatenate([rng.normal(size=1000), [np.inf]]),
        "both": np.concatenate([rng.normal(size=900), [np.inf] * 30, [-np.inf] * 40]),
        "huge": np.concatenate([(rng.random(1000) * 2 - 1) * 1.7e308, [1e300, -1e300]]),
        "two": np.repeat([1.0, 2.0], 600),
        "spike": np.concatenate([np.full(2000, 0.5), rng.normal(size=20)]),
        "steps": np.repeat(np.arange(40.0), 30),
    }


def plain_quantile(x, p):
    x = sorted(x.tolist())
    place = (len(x) - 1) * p
    low, high, share = x[int(np.floor(place))], x[int(np.ceil(place))], place - np.floor(place)
    return low if share == 0 or low == high else low * (1 - share) + high * share


@pytest.mark.parametrize("limit", [0, 30])
def test_quantiles_end_on_infinities_ties_and_huge_values(spark, limit):
    groups = odd_values()
    df = spark.createDataFrame([(g, float(v)) for g, x in groups.items() for v in x], "g string, x double")
    got = {r.g: r for r in grouped_quantiles(df, ["g"], "x", PROBS, limit).collect()}
    for g, x in groups.items():
        want = [plain_quantile(x, p) for p in PROBS.values()]
        assert list(got[g])[1:] == pytest.approx(want, rel=1e-12)
        if limit and g in ("both", "huge", "two"):
            whole = global_quantiles(df.where(F.col("g") == g), "x", list(PROBS.values()), limit)
            assert whole == pytest.approx(want, rel=1e-12)


def test_a_bracket_that_misses_is_made_wider(spark):
    from betaloom.functions import quantiles

    x = np.random.default_rng(1).normal(size=30_000)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "g": np.arange(len(x)) % 2}))
    present = df.select("g", F.col("x").alias("_x"))
    got = quantiles._narrowed(present, ["g"], {"m": 0.5, "h": 0.9}, 100, margin=1e-9).orderBy("g").collect()
    for r in got:
        assert (r.m, r.h) == pytest.approx(tuple(np.percentile(x[r.g :: 2], [50, 90])), rel=1e-12)


def test_a_large_group_is_scanned_twice(spark):
    from betaloom.functions import quantiles

    present = spark.range(300_000).select(F.lit("a").alias("g"), F.hash("id").cast("double").alias("_x"))
    calls = []
    real = quantiles._placed
    quantiles._placed = lambda *a: calls.append(1) or real(*a)
    try:
        quantiles._narrowed(present, ["g"], {"m": 0.5}, 20_000).collect()
    finally:
        quantiles._placed = real
    assert len(calls) == 1, "one sketch, one tally"


def test_dense_numbers_in_order(spark):
    from betaloom.functions.running import numbered

    ids = [f"{i * 7919 % 5000:05d}" for i in range(5000)]
    got = numbered(spark.createDataFrame([(i,) for i in ids], "id string").repartition(7), ["id"], "n").collect()
    assert {r.id: r.n for r in got} == {x: n for n, x in enumerate(sorted(ids))}
    assert numbered(spark.createDataFrame([], "id string"), ["id"], "n").count() == 0
