import numpy as np
import pytest
from pyspark.sql import functions as F

from betaloom.dataset import Dataset
from betaloom.operators import matrix as mx
from betaloom.operators import preprocess as prep
from betaloom.operators import quality as qc
from betaloom.plans import project
from betaloom.settings import ProjectOptions

FLAGS = "is_sex_chr boolean, has_cpg_snp boolean, has_sbe_snp boolean, has_probe_snp boolean, is_cross_reactive boolean, is_multi_mapped boolean"


def as_dict(df, value="value"):
    return {(r.sample_id, r.probe_id): r[value] for r in df.collect()}


def samples_of(rows, *ids, project="P"):
    return rows([(project, i) for i in ids], "project_id string, sample_id string")


def annotation(rows, *probes, **flagged):
    names = ("is_sex_chr", "has_cpg_snp", "has_sbe_snp", "has_probe_snp", "is_cross_reactive", "is_multi_mapped")
    return rows([(p, *[p in flagged.get(n, ()) for n in names]) for p in probes], "probe_id string, " + FLAGS)


def meta_of(rows):
    return mx.dataset_row(rows([("P",)], "project_id string"), F.lit("Illumina Methylation Epic"), F.lit("GRCh38"))


def test_absent_cells_count_as_missing(matrix):
    cells = matrix([("P", "a", "1", 0.1), ("P", "a", "2", None), ("P", "b", "1", 0.3), ("P", "b", "3", 0.5), ("P", "b", "2", 0.4)])
    got = {r.sample_id: r for r in qc.sample_stats(cells).collect()}
    assert got["a"].n_probes == 3 and got["a"].missing_rate == pytest.approx(2 / 3)
    assert got["b"].missing_rate == 0 and got["b"].mean == pytest.approx(0.4)


def test_sample_without_values_is_not_an_outlier(matrix):
    cells = matrix([("P", "empty", "1", None)] + [("P", f"s{i}", "1", 0.5) for i in range(4)])
    got = {r.sample_id: r for r in qc.sample_verdicts(qc.sample_stats(cells)).collect()}
    assert got["empty"].fail_missing and not got["empty"].fail_mean and not got["empty"].passed
    assert all(got[f"s{i}"].passed for i in range(4))


def test_fences_use_failing_samples_and_are_strict(rows):
    stats = rows([("P", str(i), 0.0, m) for i, m in enumerate([0.0, 1.0, 2.0, 3.0, 4.0])], "project_id string, sample_id string, missing_rate double, mean double")
    low, high = np.percentile([0, 1, 2, 3, 4], [25, 75])
    reach = 0.5 * (high - low)
    got = {r.mean: r.passed for r in qc.sample_verdicts(stats, outlier_threshold=0.5).collect()}
    assert got == {m: low - reach <= m <= high + reach for m in [0.0, 1.0, 2.0, 3.0, 4.0]}
    edge = {r.mean: r.passed for r in qc.sample_verdicts(stats.withColumn("missing_rate", F.lit(0.2))).collect()}
    assert all(edge.values()), "a rate equal to the threshold passes"


def test_project_of_failed_samples_stays_out(matrix, rows):
    cells = matrix([("P", "a", "cg1", None), ("Q", "b", "cg1", 0.5)])
    samples = rows([("P", "a"), ("Q", "b")], "project_id string, sample_id string")
    ds = project.sample_qc(Dataset(cells, samples, cells.select("project_id", "probe_id"), meta_of(rows)))
    assert [r.sample_id for r in ds.samples.collect()] == ["b"]


def test_probe_qc_order_and_toggles(matrix, rows):
    probes = ["cg1", "cg2", "cg3", "cg4", "cg5", "ch.1", "cgX"]
    cells = matrix([("P", s, p, None if (p, s) == ("cg2", "a") else 0.5) for s in "ab" for p in probes])
    notes = annotation(rows, *probes[:-1], is_sex_chr=["cg3"], has_sbe_snp=["cg4"], is_multi_mapped=["cg5"])
    stats = qc.probe_stats(cells, qc.sample_counts(samples_of(rows, "a", "b")))
    passed = lambda o: {r.probe_id for r in qc.probe_verdicts(stats, notes, o).where("passed").collect()}
    assert passed(ProjectOptions()) == {"cg1"}
    assert passed(ProjectOptions(remove_snp_associated=False, probe_missing_threshold=0.5)) == {"cg1", "cg2", "cg4"}
    usable = {r.probe_id for r in qc.usable_probes(notes).collect()}
    early = qc.align_to_annotation(cells, qc.usable_probes(notes))
    again = qc.probe_stats(early, qc.sample_counts(samples_of(rows, "a", "b"))).where("missing_rate <= 0.05")
    assert usable == {"cg1", "cg2"} and {r.probe_id for r in again.collect()} == {"cg1"}, "filters commute"


def test_variance_filter_bounds_and_policies(matrix, rows):
    kinds = {"low_mean": [0.0, 0.019], "edge_mean": [0.0, 0.02], "flat": [0.5, 0.5], "gap": [0.2, None], "good": [0.2, 0.6], "high_mean": [0.981, 1.0]}
    cells = matrix([("P", s, p, v[i]) for p, v in kinds.items() for i, s in enumerate("ab")])
    stats = qc.probe_stats(cells, qc.sample_counts(samples_of(rows, "a", "b")))
    names = lambda o: {r.probe_id for r in prep.filter_variance(stats, o).collect()}
    assert names(ProjectOptions()) == {"edge_mean", "good"}
    assert names(ProjectOptions(min_variance=0.0, na_policy="skip")) >= {"gap", "flat"}
    with pytest.raises(ValueError, match="na_policy"):
        names(ProjectOptions(na_policy="drop"))


def test_impute_leaves_probe_without_values(matrix, rows):
    cells = matrix([("P", "a", "1", 0.2), ("P", "b", "1", 0.4), ("P", "a", "2", None), ("P", "b", "2", None)])
    samples = samples_of(rows, "a", "b", "c")
    stats = qc.probe_stats(cells, qc.sample_counts(samples))
    dense = mx.densify(cells, samples, stats)
    got = as_dict(prep.impute(dense, prep.imputation_table(stats)))
    assert got == {("a", "1"): 0.2, ("b", "1"): 0.4, ("c", "1"): pytest.approx(0.3), **{(s, "2"): None for s in "abc"}}
    assert {r.probe_id: r.frac_imputed for r in prep.imputation_table(stats).collect()} == {"1": pytest.approx(1 / 3), "2": 1.0}


def test_densify_adds_only_what_is_absent(matrix, rows):
    cells = matrix([("P", "a", "1", 0.1), ("P", "a", "2", 0.2), ("P", "b", "2", None), ("Q", "c", "9", 0.9)])
    samples = samples_of(rows, "a", "b", "d").unionByName(samples_of(rows, "c", project="Q"))
    got = mx.densify(cells, samples, cells.select("project_id", "probe_id"))
    assert got.count() == 7
    assert as_dict(got) == {("a", "1"): 0.1, ("a", "2"): 0.2, ("b", "1"): None, ("b", "2"): None, ("d", "1"): None, ("d", "2"): None, ("c", "9"): 0.9}


def test_densify_counts_listed_probes_only(matrix, rows):
    cells = matrix([("P", "a", "1", 0.1), ("P", "a", "zz", 0.5), ("P", "b", "1", 0.2), ("P", "b", "1", 0.2)])
    listed = rows([("P", "1"), ("P", "2"), ("P", "1")], "project_id string, probe_id string")
    got = sorted((r.sample_id, r.probe_id, r.value) for r in mx.densify(cells, samples_of(rows, "a", "b"), listed).where("value IS NOT NULL").collect())
    assert got == [("a", "1", 0.1), ("a", "zz", 0.5), ("b", "1", 0.2), ("b", "1", 0.2)]
    absent = mx.densify(cells, samples_of(rows, "a", "b"), listed).where("value IS NULL")
    assert {(r.sample_id, r.probe_id) for r in absent.collect()} == {("a", "2"), ("b", "2")}


def test_assemble_by_file_id_not_by_position(rows):
    beta = rows([("f2", "cg1", 0.2), ("f1", "cg1", 0.1), ("f3", "cg1", float("nan"))], "file_id string, probe_id string, beta_value double")
    meta = rows([("f1", "success"), ("f2", "failed"), ("f3", "success")], "file_id string, status string")
    got = {r.sample_id: r.value for r in mx.assemble(beta, meta, "P").collect()}
    assert got == {"f1": 0.1, "f3": None}


def test_pack_orders_by_probe(matrix):
    cells = matrix([("P", "a", "2", 0.2), ("P", "a", "1", None), ("P", "a", "3", 0.3)])
    row = mx.pack(cells).first()
    assert row.probe_ids == ["1", "2", "3"] and row.vector[0] is None
    assert row.vector[1:] == [pytest.approx(0.2, abs=1e-7), pytest.approx(0.3, abs=1e-7)]


def test_first_replicate_by_file_name(rows):
    df = rows([("s1", "C", "b.txt"), ("s2", "C", "a.txt"), ("s3", "D", "z.txt")], "sample_id string, submitter_id string, file_name string")
    assert {r.sample_id for r in mx.first_replicates(df).collect()} == {"s2", "s3"}


def full_dataset(matrix, rows):
    rng = np.random.default_rng(0)
    cells = [("P", f"s{i}", f"cg{j}", float(rng.uniform(0.2, 0.8))) for i in range(12) for j in range(8)]
    cells = [c for c in cells if not (c[1] == "s0" and c[2] in ("cg1", "cg2"))]
    values = matrix(cells)
    probes = values.select("project_id", "probe_id").distinct()
    return Dataset(values, samples_of(rows, *[f"s{i}" for i in range(12)]), probes, meta_of(rows))


def test_fused_plan_equals_step_by_step(matrix, rows):
    ds = full_dataset(matrix, rows)
    notes = annotation(rows, *[f"cg{j}" for j in range(8)], is_sex_chr=["cg7"])
    audit = rows([(f"s{i}", None) for i in range(13)], "file_id string, qc_pass int")
    for options in (ProjectOptions(), ProjectOptions(na_policy="skip"), ProjectOptions(sample_qc=False), ProjectOptions(convert_to_mval=False, filter_variance=False)):
        fused, fused_audit = project.prepare_dataset(ds, notes, options, audit)
        checked, step_audit = project.quality_control(ds, notes, options, audit)
        stepped = project.preprocess(checked, options)
        a, b = as_dict(fused.values), as_dict(stepped.values)
        assert a.keys() == b.keys() and a
        assert all(a[k] == pytest.approx(b[k]) for k in a)
        assert {tuple(r) for r in fused_audit.collect()} == {tuple(r) for r in step_audit.collect()}
        assert fused.meta.first().preprocessing_steps == stepped.meta.first().preprocessing_steps
        assert fused.meta.first().state == "processed"


def test_steps_are_logged_once_and_in_order(matrix, rows):
    ds, _ = project.prepare_dataset(full_dataset(matrix, rows), annotation(rows, *[f"cg{j}" for j in range(8)]))
    row = ds.meta.first()
    assert row.preprocessing_steps == ["sample_qc", "probe_qc", "filter_variance", "impute", "convert_to_mval"]
    assert row.conversion == "m_value"
    assert ds.probes.columns[-2:] == ["frac_imputed", "impute_value"]


def test_options_from_nested_configuration():
    config = {"toggles": {"sample_qc": False}, "quality_control": {"probe_qc": {"remove_SNP_associated": False, "missing_threshold": 0.1}}, "preprocessing": {"filter_variance": {"min_mean": 0.05}}}
    got = ProjectOptions.from_config(config)
    assert (got.sample_qc, got.remove_snp_associated, got.probe_missing_threshold, got.min_mean) == (False, False, 0.1, 0.05)
    assert got.impute and got.max_mean == 0.99


def test_aligned_blocks_keep_every_place(matrix, rows):
    rng = np.random.default_rng(4)
    table = {(s, f"cg{j:02d}"): float(rng.random()) for s in "abc" for j in range(23) if not (s == "b" and j in (1, 9, 10))}
    table["c", "cg05"] = None
    cells = matrix([("P", s, p, v) for (s, p), v in table.items()])
    samples = samples_of(rows, "a", "b", "c", "empty")
    dictionary = mx.probe_dictionary(cells)
    places = {r.probe_id: r["index"] for r in dictionary.collect()}
    assert places == {f"cg{j:02d}": j for j in range(23)}
    blocks = mx.pack_blocks(cells, samples, dictionary, 10)
    assert set(blocks.columns) == {"project_id", "sample_id", "block", "vector", "present"}
    found = {(r.sample_id, r.block): r for r in blocks.collect()}
    assert set(found) == {(s, b) for s in ("a", "b", "c", "empty") for b in range(3)}
    for (s, b), row in found.items():
        assert len(row.vector) == (10, 10, 3)[b]
        bits = np.unpackbits(np.frombuffer(row.present, np.uint8))[: len(row.vector)]
        for i, (value, bit) in enumerate(zip(row.vector, bits, strict=True)):
            want = table.get((s, f"cg{b * 10 + i:02d}"))
            assert bit == (want is not None) and value == pytest.approx(want or 0.0, abs=1e-7)
    back = {(r.sample_id, r.probe_id): r.value for r in mx.unpack_blocks(blocks, dictionary, 10).collect()}
    assert back == {k: pytest.approx(v, abs=1e-7) for k, v in table.items() if v is not None}
    nothing = matrix([])
    assert mx.pack_blocks(nothing, samples, mx.probe_dictionary(nothing), 10).count() == 0


def test_states_of_batches_merge_to_a_full_recount(spark, matrix, rows, tmp_path):
    from betaloom.operators import states

    rng = np.random.default_rng(7)
    every = [("PQ"[i % 2], f"s{i}", f"cg{j}", None if rng.random() < 0.2 else float(1e6 + rng.normal())) for i in range(20) for j in range(6)]
    every += [("P", "s99", "cg0", None), ("P", "s98", "cgx", None)]
    cuts = [every[:7], every[7:60], every[60:]]
    path = str(tmp_path / "states")
    for number, cells in enumerate(cuts):
        states.add_states(matrix(cells), path, f"b{number}")
        states.add_states(matrix(cells), path, f"b{number}")
    whole = matrix(every)
    for kind, keys in (("samples", qc.SAMPLE), ("probes", qc.PROBE)):
        got = {tuple(r[k] for k in keys): r for r in states.read_states(spark, path, kind).collect()}
        want = {tuple(r[k] for k in keys): r for r in states.state(whole, keys).collect()}
        assert got.keys() == want.keys()
        for k, r in want.items():
            assert (got[k].n_cells, got[k].n_present) == (r.n_cells, r.n_present)
            assert got[k].mean == (None if r.mean is None else pytest.approx(r.mean, rel=1e-12))
            assert got[k].squares == (None if r.squares is None else pytest.approx(r.squares, rel=1e-6, abs=1e-8))
    counts = qc.probe_counts(whole)
    by_sample = states.sample_stats(states.read_states(spark, path, "samples"), counts)
    plain = {r.sample_id: r for r in qc.sample_stats(whole, counts).collect()}
    assert {r.sample_id: (r.n_present, r.missing_rate) for r in by_sample.collect()} == {s: (r.n_present, r.missing_rate) for s, r in plain.items()}
    probes = states.probe_stats(states.read_states(spark, path, "probes", ["Q"]), qc.sample_counts(whole))
    want = {r.probe_id: r for r in qc.probe_stats(whole, qc.sample_counts(whole)).where("project_id = 'Q'").collect()}
    for r in probes.collect():
        assert r.variance == pytest.approx(want[r.probe_id].variance, rel=1e-6)
    # a new batch is added without a look at old cells
    for part in (tmp_path / "states").rglob("*.parquet"):
        part.write_bytes(b"not readable")
    states.add_states(matrix(every[:3]), path, "b9")


def exchanges_above_matrix(df):
    """Shuffles between the matrix's scan and the top of the plan."""
    found, stack = [], []
    for line in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        depth = len(line) - len(line.lstrip(" :+-"))
        while stack and stack[-1][0] >= depth:
            stack.pop()
        stack.append((depth, line))
        if "by_probe_" in line and "Scan" in line:
            found = [text for _, text in stack if "Exchange" in text and "Broadcast" not in text]
    return found


def test_probe_work_on_the_matrix_by_probe_moves_no_cell(spark, matrix, rows):
    from betaloom.sources.layout import buckets_for, by_probe

    cells = matrix([("P", f"s{i}", f"cg{j}", 0.1 * i + 0.01 * j) for i in range(9) for j in range(30)])
    stored = by_probe(cells, buckets=6)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, cells.collect()))
    samples = samples_of(rows, *[f"s{i}" for i in range(9)])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        per_probe = stored.groupBy("project_id", "probe_id").agg(F.avg("value"))
        kept = stored.join(rows([(f"cg{j}",) for j in range(20)], "probe_id string"), "probe_id", "left_semi")
        scaled = stored.join(stored.groupBy("probe_id").agg(F.avg("value").alias("m")), "probe_id")
        for df in (per_probe, kept, scaled):
            assert exchanges_above_matrix(df) == []
        assert exchanges_above_matrix(stored.groupBy("sample_id").count()) != []
        assert kept.count() == 180 and scaled.count() == 270
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    want = {(r.project_id, r.probe_id): r.variance for r in qc.probe_stats(cells, qc.sample_counts(samples)).collect()}
    assert {(r.project_id, r.probe_id): pytest.approx(r.variance) for r in qc.probe_stats(stored, qc.sample_counts(samples)).collect()} == want
    assert (buckets_for(1), buckets_for(10**9), buckets_for(5, 8)) == (1, 50, 8)
