import numpy as np
import pandas as pd
import pytest

from betaloom.operators import combat


def reference_combat(y, batch, mod):
    """Plain NumPy ComBat (parametric) on probes x samples."""
    names, n = np.unique(batch, return_counts=True)
    design = np.hstack([batch[:, None] == names[None, :], mod]).astype(float)
    beta = np.linalg.lstsq(design, y.T, rcond=None)[0]
    grand = (n / len(batch)) @ beta[: len(names)]
    sd = np.sqrt(((y - (design @ beta).T) ** 2).mean(axis=1))
    vary = np.ptp(y, axis=1) > 0
    center = grand[:, None] + (design[:, len(names):] @ beta[len(names):]).T
    z = (y[vary] - center[vary]) / sd[vary, None]
    out = y.copy()
    adjusted = np.empty_like(z)
    for name in names:
        own = z[:, batch == name]
        k = own.shape[1]
        g_hat = own.mean(axis=1)
        d_hat = own.var(axis=1, ddof=1) if k > 1 else np.ones(len(own))
        bar, t2 = g_hat.mean(), g_hat.var(ddof=1)
        m, s2 = d_hat.mean(), d_hat.var(ddof=1)
        g, d = g_hat.copy(), d_hat.copy()
        if k > 1:
            a, b = (2 * s2 + m**2) / s2, (m * s2 + m**3) / s2
        change = 1.0
        while change >= 1e-4:
            g_new = (t2 * k * g_hat + d * bar) / (t2 * k + d)
            d_new = (b + 0.5 * ((own - g_new[:, None]) ** 2).sum(axis=1)) / (k / 2 + a - 1) if k > 1 else d
            change = max((np.abs(g_new - g) / np.abs(g)).max(), (np.abs(d_new - d) / np.abs(d)).max())
            g, d = g_new, d_new
        adjusted[:, batch == name] = (own - g[:, None]) / np.sqrt(d)[:, None]
    out[vary] = adjusted * sd[vary, None] + center[vary]
    return out


def make(seed=0, probes=30, single=False):
    rng = np.random.default_rng(seed)
    size = 60
    batch = rng.choice(["a-1", "b-1", "b-2"], size)
    if single:
        batch[5] = "b-1"
        batch = np.where(np.arange(size) == 5, "z", np.where(batch == "a-1", "a", "b"))
    project = np.where(rng.random(size) < 0.6, "P", "Q")
    y = rng.normal(size=(probes, size)) * rng.uniform(0.5, 2, (probes, 1))
    y += rng.normal(size=(probes, 1)) * (batch == np.unique(batch)[0]) * 3 + (project == "Q") * rng.normal(size=(probes, 1))
    y[0] = 1.5
    return y, batch, project


def tables(spark, y, batch, project):
    ids = [f"s{i:03d}" for i in range(y.shape[1])]
    samples = pd.DataFrame({"project_id": project, "sample_id": ids, "batch_id": batch})
    cells = pd.DataFrame(y, columns=ids).assign(probe_id=[f"p{i:03d}" for i in range(len(y))]).melt("probe_id", var_name="sample_id")
    cells = cells.merge(samples[["project_id", "sample_id"]], on="sample_id")
    return spark.createDataFrame(cells[["project_id", "sample_id", "probe_id", "value"]]), spark.createDataFrame(samples)


def corrected(df):
    return df.toPandas().pivot(index="probe_id", columns="sample_id", values="value").to_numpy()


@pytest.mark.parametrize("covariates", [("project_id",), ()])
def test_equals_plain_numpy(spark, covariates):
    y, batch, project = make()
    values, samples = tables(spark, y, batch, project)
    got = corrected(combat.batch_correction(values, samples, covariates=covariates))
    mod = (project == "Q")[:, None] if covariates else np.zeros((len(batch), 0))
    np.testing.assert_allclose(got, reference_combat(y, batch, mod), rtol=1e-9, atol=1e-9)
    np.testing.assert_array_equal(got[0], y[0])
    first = batch == np.unique(batch)[0]
    gap = lambda m: np.abs(m[1:, first].mean(axis=1) - m[1:, ~first].mean(axis=1)).mean()
    assert gap(got) < 0.5 * gap(y)


def test_one_sample_batch_is_only_shifted(spark):
    y, batch, project = make(3, single=True)
    values, samples = tables(spark, y, batch, project)
    got = corrected(combat.batch_correction(values, samples))
    np.testing.assert_allclose(got, reference_combat(y, batch, (project == "Q")[:, None]), rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize(
    "keys, labels",
    [
        (["a-1", "a-1", "b-2", "b-2"], ["a-1", "a-1", "b-2", "b-2"]),
        (["a-1", "a-2", "b-2", "b-2"], ["a", "a", "b", "b"]),
        (["a-1-x", "b-2", "b-2", None], ["a-1", "b-2", "b-2", "None"]),
        ([None, None, "a-1", "a-2"], ["None", "None", "a", "a"]),
    ],
)
def test_batch_collapse(rows, keys, labels):
    df = rows([("P", str(i), k) for i, k in enumerate(keys)], "project_id string, sample_id string, batch_id string")
    assert [r.batch for r in combat.batch_labels(df).orderBy("sample_id").collect()] == labels


def test_refusals(spark):
    y, batch, project = make()
    values, samples = tables(spark, y, batch, project)
    with pytest.raises(ValueError, match="M-values"):
        combat.batch_correction(values, samples, "beta_value")
    with pytest.raises(ValueError, match="plate"):
        combat.batch_correction(values, samples, batch_key="plate")
    gap = values.selectExpr("project_id", "sample_id", "probe_id", "nullif(value, 1.5D) value")
    with pytest.raises(ValueError, match="missing"):
        combat.batch_correction(gap, samples)
    with pytest.raises(ValueError, match="missing"):
        combat.batch_correction(values.where("sample_id != 's003' or probe_id != 'p004'"), samples)


def test_batches_nested_in_projects_are_refused(spark):
    y, batch, _ = make()
    values, samples = tables(spark, y, batch, np.where(batch == "a-1", "P", "Q"))
    with pytest.raises(ValueError, match="confounded"):
        combat.batch_correction(values, samples)


def test_many_batches_and_two_covariates(spark):
    rng = np.random.default_rng(8)
    size = 900
    batch = np.array([f"{i % 300:03d}-x" for i in range(size)])
    project = rng.choice(["P", "Q", "R"], size)
    sex = rng.choice(["f", "m"], size)
    y = rng.normal(size=(12, size)) + rng.normal(size=(12, 300))[:, [int(b[:3]) for b in batch]] + (project == "Q") * 2.0 - (sex == "m") * 1.5
    values, samples = tables(spark, y, batch, project)
    ids = [f"s{i:03d}" for i in range(size)]
    sexes = spark.createDataFrame(list(zip(ids, sex.tolist(), strict=True)), "sample_id string, sex string")
    got = corrected(combat.batch_correction(values, samples.join(sexes, "sample_id"), covariates=("project_id", "sex")))
    mod = np.column_stack([project == "Q", project == "R", sex == "m"])
    np.testing.assert_allclose(got, reference_combat(y, batch, mod), rtol=1e-7, atol=1e-7)


def test_no_batch_reaches_a_task_or_the_driver_as_an_array(spark):
    y, batch, project = make(4)
    values, samples = tables(spark, y, batch, project)
    cells = combat.design(combat.batch_labels(samples), ("project_id",))
    plan = combat.cell_stats(values, cells)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "Python" not in plan and "MapInPandas" not in plan
    assert cells.inverse.count() == 1 and cells.levels.count() == 1
