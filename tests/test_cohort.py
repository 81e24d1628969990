import hashlib
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from betaloom.dataset import Dataset
from betaloom.operators import cohort as co
from betaloom.operators import split as sp
from betaloom.operators.matrix import dataset_row
from betaloom.plans import cohort as plan
from betaloom.settings import PLATFORM_PRIORITY, CohortOptions


def test_common_probes_need_every_project(rows):
    probes = rows([("P", "1"), ("P", "2"), ("Q", "2"), ("Q", "3"), ("R", "1"), ("P", "2")], "project_id string, probe_id string")
    meta = rows([("P",), ("Q",)], "project_id string")
    assert [r.probe_id for r in co.common_probes(probes, meta).collect()] == ["2"]


def test_platform_priority_and_default(rows):
    name = lambda *p: co.resolve_platform(rows([(x,) for x in p], "platform string")).first().platform
    assert name(PLATFORM_PRIORITY[2], PLATFORM_PRIORITY[1]) == PLATFORM_PRIORITY[1]
    assert name("unheard of", None) == PLATFORM_PRIORITY[2]
    assert name(*reversed(PLATFORM_PRIORITY)) == PLATFORM_PRIORITY[0]


def test_cohort_row_takes_first_project(rows):
    df = rows([("P", 2, "a"), ("Q", 1, "b")], "project_id string, ordinal int, g string")
    meta = df.join(dataset_row(df, F.lit(PLATFORM_PRIORITY[1]), F.col("g")), "project_id").drop("g")
    row = co.cohort_row(meta, "pan").first()
    assert row.reference_genome == "b" and set(row.projects) == {"P", "Q"} and row.projects["P"].reference_genome == "a"
    assert {r.field: r.distinct_values for r in co.mixed_fields(meta).collect()}["reference_genome"] == 2


@pytest.mark.parametrize("limit", [0, 10_000])
def test_mad_equals_numpy(spark, limit):
    rng = np.random.default_rng(1)
    wide = rng.normal(size=(41, 6))
    wide[:, 3] = 2.0
    frame = pd.DataFrame(wide, columns=list("abcdef")).melt(var_name="probe_id", value_name="value")
    got = co.mad_scores(spark.createDataFrame(frame), limit)
    scores = {r.probe_id: r.mad_score for r in got.collect()}
    want = np.median(np.abs(wide - np.median(wide, axis=0)), axis=0)
    np.testing.assert_allclose([scores[c] for c in "abcdef"], want)
    order = [c for c in np.array(list("abcdef"))[np.argsort(-want)] if c != "d"]
    assert [r.probe_id for r in co.top_probes(got, 3).collect()] == order[:3]
    assert co.top_probes(got, 99).count() == 5, "a probe that does not vary is dropped"


def test_gene_lists_repeat_and_blank_genes(rows, matrix):
    notes = rows([("1", "A;A;B", True, False), ("2", "A;", True, False), ("3", None, True, True), ("4", "B", False, True), ("5", "B", False, False)],
                 "probe_id string, gene_symbol string, TSS200 boolean, TSS1500 boolean")
    cells = matrix([("P", "s", p, v) for p, v in (("1", 1.0), ("2", 4.0), ("3", 9.0), ("4", None), ("5", 7.0))])
    mean = lambda **kw: {r.gene_symbol: r.value for r in co.gene_aggregation(cells, co.gene_map(notes, ("TSS200", "TSS1500"), **kw)).collect()}
    assert mean() == {"A": 2.0, "B": 1.0, "": 4.0}
    assert mean(distinct_genes=True) == {"A": 2.5, "B": 1.0, "": 4.0}
    with pytest.raises(ValueError, match="enhancer"):
        co.gene_map(notes, ("enhancer",))


def test_scaling_range_and_degenerate_matrices(matrix):
    rng = np.random.default_rng(2)
    x = rng.normal(size=200)
    cells = matrix([("P", str(i), "1", float(v)) for i, v in enumerate(x)] + [("P", "gap", "1", None)])
    scaled, (lo, hi) = co.clip_and_scale(cells)
    assert (lo, hi) == pytest.approx(tuple(np.percentile(x, [1, 99])))
    got = {r.sample_id: r.value for r in scaled.collect()}
    assert got["gap"] is None
    want = 2 * ((np.clip(x, lo, hi) - lo) / (hi - lo)) - 1
    np.testing.assert_allclose([got[str(i)] for i in range(200)], want)
    assert min(want) == -1 and max(want) == 1
    flat = matrix([("P", "a", "1", 3.0), ("P", "b", "1", 3.0)])
    assert [r.value for r in co.clip_and_scale(flat)[0].collect()] == [3.0, 3.0]
    assert co.clip_and_scale(matrix([("P", "a", "1", None)]))[1] is None


def test_unique_names_follow_project_and_file_order(rows):
    df = rows([("Q", "x", "a"), ("P", "x", "b"), ("P", "x", "a"), ("P", "y", "a")], "project_id string, sample_id string, file_name string")
    got = {(r.project_id, r.sample_id, r.file_name): r.sample_name for r in co.unique_names(df).collect()}
    assert got == {("P", "x", "a"): "x", ("P", "x", "b"): "x-1", ("Q", "x", "a"): "x-2", ("P", "y", "a"): "y"}


def shares(counts, fraction):
    """Largest-remainder share of what stays after ceil(fraction * total) are drawn."""
    total = sum(counts.values())
    stay = total - math.ceil(fraction * total)
    floors = {k: n * stay // total for k, n in counts.items()}
    ranked = sorted(counts, key=lambda k: (-(counts[k] * stay % total), k))
    for k in ranked[: stay - sum(floors.values())]:
        floors[k] += 1
    return floors


@pytest.mark.parametrize("sizes", [{"A": 500, "B": 37, "C": 3}, {"A": 1, "B": 1, "C": 1}, {"A": 10}])
def test_split_is_exact_disjoint_and_reproducible(rows, sizes):
    data = [(p, f"{p}{i}") for p, n in sizes.items() for i in range(n)]
    df = rows(data, "project_id string, sample_id string")
    placed = sp.split(df, (0.6, 0.2, 0.2), seed=7).toPandas()
    assert len(placed) == len(data) and placed["sample_id"].is_unique
    rest = shares(sizes, 0.2)
    train = shares(rest, 0.2)
    for p, n in sizes.items():
        order = sorted((s for q, s in data if q == p), key=lambda s: hashlib.md5(f"7:{s}".encode()).hexdigest())
        n_test, n_val = n - rest[p], rest[p] - train[p]
        part = placed.set_index("sample_id")["split"]
        assert [part[s] for s in order] == ["test"] * n_test + ["validation"] * n_val + ["training"] * train[p]
    again = sp.split(df.repartition(5), (0.6, 0.2, 0.2), seed=7).toPandas()
    assert dict(zip(again.sample_id, again.split)) == dict(zip(placed.sample_id, placed.split))
    assert (placed.loc[placed.split == "training", "split_percentage"] == 0.6).all()


def test_samples_without_a_project_or_id_stay(rows):
    data = [(p, f"{p}{i}" if i else None, f"f{i}") for p in ("A", None) for i in range(10)]
    df = rows([*data, (None, "A3", "g"), ("A", "A3", "h")], "project_id string, sample_id string, file_name string")
    placed = sp.split(df, (0.6, 0.2, 0.2), seed=7).toPandas()
    assert len(placed) == 22 and placed["project_id"].isna().sum() == 11
    assert sorted(placed.loc[placed["project_id"].isna(), "split"].value_counts()) == [2, 2, 7]
    named = co.unique_names(df).toPandas()
    assert len(named) == 22 and named["sample_id"].isna().sum() == 2
    names = named["sample_name"].dropna()
    assert len(names) == 20 and names.is_unique


def cohort_input(rows, matrix):
    rng = np.random.default_rng(4)
    cells = [(p, f"{p}{i}", f"cg{j}", float(rng.normal(j, 1 + j))) for p in "PQ" for i in range(10) for j in range(6) if (p, j) != ("Q", 5)]
    values = matrix(cells)
    projects = rows([("P", 0), ("Q", 1)], "project_id string, ordinal int")
    meta = projects.join(dataset_row(projects, F.lit(PLATFORM_PRIORITY[0]), F.lit("GRCh38")), "project_id").withColumn("conversion", F.lit("m_value"))
    samples = values.select("project_id", "sample_id").distinct().withColumn("file_name", F.col("sample_id"))
    samples = samples.withColumn("batch_id", F.concat(F.lit("b"), F.substring("sample_id", 2, 1).cast("int") % 2))
    return Dataset(values, samples, values.select("project_id", "probe_id").distinct(), meta)


def test_cohort_steps_and_parts(rows, matrix):
    done = plan.prepare_cohort(cohort_input(rows, matrix), "pan", options=CohortOptions(top_n=3, batch_correction=True))
    row = done.meta.first()
    assert row.preprocessing_steps == ["MAD_probe_filtering", "batch_correction", "clip_and_scale"]
    assert row.state == "processed" and row.cohort_id == "pan" and row.lower_bound < row.upper_bound
    values = done.values.toPandas()
    assert set(values.probe_id) == {"cg2", "cg3", "cg4"} and values.value.between(-1, 1).all() and len(values) == 60
    parts = {name: plan.part(done, name) for name in ("training", "validation", "test")}
    sizes = {name: p.samples.count() for name, p in parts.items()}
    assert sizes == {"training": 12, "validation": 4, "test": 4}
    assert parts["test"].values.count() == 12 and parts["test"].meta.first().split_percentage == 0.2


def test_saved_split_prunes_parts(spark, rows, matrix, tmp_path):
    from betaloom.sources.matrix import load_dataset, save_split

    save_split(plan.prepare_cohort(cohort_input(rows, matrix), options=CohortOptions(top_n=2)), str(tmp_path / "c"))
    test = load_dataset(spark, str(tmp_path / "c")).values.where("split = 'test'")
    assert test.count() == 8
    assert "PartitionFilters: [isnotnull(split" in test._jdf.queryExecution().executedPlan().toString()


def test_cohort_without_steps_is_the_stack(rows, matrix):
    off = CohortOptions(mad_probe_filtering=False, clip_and_scale=False, split=False)
    done = plan.prepare_cohort(cohort_input(rows, matrix), options=off)
    assert done.values.count() == 100 and done.meta.first().preprocessing_steps == []
    with pytest.raises(ValueError, match="annotation"):
        plan.prepare_cohort(cohort_input(rows, matrix), options=CohortOptions(mad_probe_filtering=False, gene_aggregation=True))


def test_options_from_nested_configuration():
    got = CohortOptions.from_config({"toggles": {"split": False}, "MAD_probe_filtering": 5, "gene_aggregation": ["gene_body"], "split": [0.8, 0.1, 0.1], "batch_correction": {"covariates": []}})
    assert (got.split, got.top_n, got.regions, got.fractions, got.covariates) == (False, 5, ("gene_body",), (0.8, 0.1, 0.1), ())
