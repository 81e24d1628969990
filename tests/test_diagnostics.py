import numpy as np
import pandas as pd
import pytest

from betaloom.operators import diagnostics as dg


def long(spark, wide):
    frame = pd.DataFrame(wide, index=[f"s{i:03d}" for i in range(len(wide))], columns=[f"p{j:02d}" for j in range(wide.shape[1])])
    frame = frame.rename_axis("sample_id").reset_index().melt("sample_id", var_name="probe_id").assign(project_id="P")
    return spark.createDataFrame(frame[["project_id", "sample_id", "probe_id", "value"]])


def test_components_equal_numpy(spark):
    rng = np.random.default_rng(0)
    wide = rng.normal(size=(80, 7)) @ np.diag([5, 4, 3, 2, 1, 0.5, 0.2]) + 3
    got = dg.principal_components(long(spark, wide), 4).orderBy("sample_id").toPandas()
    centred = wide - wide.mean(axis=0)
    loadings = np.linalg.svd(centred, full_matrices=False)[2][:4]
    signs = np.sign(loadings[np.arange(4), np.abs(loadings).argmax(axis=1)])
    np.testing.assert_allclose(got[[f"PC{i}" for i in range(1, 5)]], centred @ (loadings * signs[:, None]).T, atol=1e-8)


def test_standardize_limits_and_flat_probe(spark):
    wide = np.column_stack([np.r_[np.zeros(300), 100.0], np.full(301, 2.0)])
    got = dg.standardize(long(spark, wide), 10).toPandas().pivot(index="sample_id", columns="probe_id", values="value").to_numpy()
    assert got[:, 0].max() == 10 and (got[:, 1] == 0).all()
    assert got[0, 0] == pytest.approx(-wide[:, 0].mean() / wide[:, 0].std(ddof=1))


def test_dispersion_scores(spark):
    rng = np.random.default_rng(1)
    wide = np.abs(rng.normal(1, 0.4, size=(50, 30)))
    wide[:, 0] += 3
    got = dg.dispersions(long(spark, wide), 5).orderBy("probe_id").toPandas()
    raw = np.expm1(wide)
    mean, disp = np.log1p(raw.mean(axis=0)), np.log(raw.var(axis=0, ddof=1) / raw.mean(axis=0))
    bins = pd.cut(mean, 5, labels=False)
    frame = pd.DataFrame({"d": disp, "b": bins})
    center, spread = frame.groupby("b")["d"].transform("mean"), frame.groupby("b")["d"].transform("std")
    want = np.where(spread.isna(), 1.0, (disp - center) / spread)
    assert spread.isna().any(), "one probe has a bin of its own"
    np.testing.assert_allclose(got["score"], want, atol=1e-9)
    top = dg.highly_variable(long(spark, wide), 4, 5).toPandas()
    assert list(top.probe_id) == list(got.sort_values(["score", "probe_id"], ascending=[False, True]).probe_id[:4])


def test_fraction_variance(rows):
    scores = rows([("a", 1.0, 0.0), ("a", 3.0, 2.0), ("b", 5.0, 1.0), (None, 9.0, 9.0)], "f string, x double, y double")
    frame = scores.toPandas()
    want = frame.groupby("f")[["x", "y"]].mean().var().sum() / frame[["x", "y"]].var().sum()
    assert dg.fraction_variance(scores, ["x", "y"], "f").first().fraction == pytest.approx(want)


def test_histogram_equals_numpy(spark, matrix):
    rng = np.random.default_rng(2)
    x = np.r_[rng.random(500), 0.0, 1.0]
    cells = matrix([("P", str(i), "1", float(v)) for i, v in enumerate(x)] + [("P", "gap", "1", None)])
    got = dg.histogram(cells, 10).orderBy("bin").toPandas()
    counts, edges = np.histogram(x, 10)
    assert list(got.n) == list(counts)
    np.testing.assert_allclose(got.low, edges[:-1])
    assert dg.histogram(cells, 10, sample=100).agg({"n": "sum"}).first()[0] == 100
    flat = dg.histogram(matrix([("P", "a", "1", 2.0)]), 10).where("n > 0").first()
    assert (flat.bin, flat.n) == (5, 1)


def test_integrity_counts_absent_cells(matrix):
    row = dg.integrity(matrix([("P", "a", "1", 0.1), ("P", "b", "2", None), ("P", "b", "1", 0.9)])).first()
    assert tuple(row) == (2, 2, 0.1, 0.9, 2)


def scores_of(wide, k):
    centred = wide - wide.mean(axis=0)
    left, values, loadings = np.linalg.svd(centred, full_matrices=False)
    signs = np.sign(loadings[np.arange(k), np.abs(loadings[:k]).argmax(axis=1)])
    return left[:, :k] * values[:k] * signs


def got_scores(spark, wide, k):
    got = dg.principal_components(long_cells(spark, wide), k).orderBy("sample_id").toPandas()
    return got[[f"PC{i}" for i in range(1, k + 1)]].to_numpy()


def long_cells(spark, wide):
    cells = spark.createDataFrame([(f"s{i:05d}", row.tolist()) for i, row in enumerate(wide)], "sample_id string, v array<double>")
    return cells.selectExpr("'P' AS project_id", "sample_id", "posexplode(v) AS (at, value)").selectExpr("project_id", "sample_id", "lpad(at, 6, '0') AS probe_id", "value")


@pytest.mark.parametrize("samples,probes", [(120, 100), (60, 5000)])
def test_components_of_a_flat_spectrum(spark, samples, probes):
    wide = np.random.default_rng(probes).normal(size=(samples, probes))
    np.testing.assert_allclose(got_scores(spark, wide, 5), scores_of(wide, 5), atol=1e-6)


def test_components_beyond_the_rank_are_zero(spark):
    rng = np.random.default_rng(9)
    wide = rng.normal(size=(40, 2)) @ rng.normal(size=(2, 30)) + 5
    got = got_scores(spark, wide, 4)
    np.testing.assert_allclose(got[:, :2], scores_of(wide, 2), atol=1e-7)
    assert (got[:, 2:] == 0).all()
    assert (got_scores(spark, np.ones((5, 3)), 2) == 0).all()
    assert (got_scores(spark, np.ones((1, 3)), 2) == 0).all()


def test_components_need_all_cells_and_convergence(spark, matrix):
    with pytest.raises(ValueError, match="missing"):
        dg.principal_components(matrix([("P", "a", "1", 0.1), ("P", "b", "1", 0.2), ("P", "b", "2", 0.3)]), 1)
    wide = np.random.default_rng(3).normal(size=(80, 90))
    with pytest.raises(ArithmeticError, match="converged"):
        dg.principal_components(long_cells(spark, wide), 3, most_steps=1)


def test_report_iterates_over_a_stored_matrix(spark, monkeypatch):
    """The standardized matrix and the probes' dispersions are scanned, not made for every read of them."""
    from betaloom.plans import batch_report

    rng = np.random.default_rng(4)
    cells = [(f"P{i % 2}", str(i), f"p{j}", float(rng.normal(j, 1))) for i in range(20) for j in range(6)]
    values = spark.createDataFrame(cells, "project_id string, sample_id string, probe_id string, value double")
    samples = spark.createDataFrame([(f"P{i % 2}", str(i), f"b{i % 3}-x") for i in range(20)], "project_id string, sample_id string, batch_id string")
    plans, real = [], dg.principal_components
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(batch_report.dg, "principal_components", lambda v, k: plans.append(plan(v)) or real(v, k))
    rows = {r.factor: r.fraction for r in batch_report.explained(values, samples, top_n=4, k=2).collect()}
    assert set(rows) == {"project_id", "portion"} and all(0 <= v < 2 for v in rows.values())
    assert len(plans) == 1 and "FileScan" in plans[0] and "Join" not in plans[0] and "Aggregate" not in plans[0]
    scored = plan(dg.dispersions(values))
    assert "expm1" not in scored.lower() and "FileScan" in scored
