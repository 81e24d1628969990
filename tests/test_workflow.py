"""A project from raw files, killed between steps and started again."""

import pytest
from pyspark.sql import functions as F

from betaloom import schemas
from betaloom.plans import workflow
from betaloom.settings import ManifestRequest, ProjectOptions
from betaloom.sources import beta as bt
from betaloom.sources import versions
from betaloom.sources.matrix import load_dataset, save_dataset



@pytest.fixture
def inputs(spark, rows, tmp_path):
    raw = tmp_path / "raw"
    hits = []
    for i in range(8):
        folder = raw / f"f-{i}"
        folder.mkdir(parents=True)
        lines = [f"cg{j}\t{0.3 + 0.05 * i + 0.01 * j if (i, j) != (3, 2) else 'NA'}" for j in range(6)]
        (folder / "x.txt").write_text("Composite Element REF\tBeta_value\n" + "\n".join(lines) + "\n")
        case = {"submitter_id": f"C{i}", "project": {"project_id": "P"}, "samples": [{"sample_type": "Primary Tumor", "portions": None}]}
        hits.append((f"f-{i}", "x.txt", "DNA Methylation", "Methylation Array", "Methylation Beta Value", "Illumina Human Methylation 450", "GRCh38", "open", None, [case]))
    hits.append(("f-lost", "x.txt", *hits[0][2:]))
    notes = rows([(f"cg{j}", *[False] * 6) for j in range(6)], "probe_id string, is_sex_chr boolean, has_cpg_snp boolean, has_sbe_snp boolean, has_probe_snp boolean, is_cross_reactive boolean, is_multi_mapped boolean")
    named = ["file_id", "file_name", "data_category", "experimental_strategy", "data_type", "platform", "reference_genome", "access", "status", "cases"]
    assert named == schemas.FILE_HIT.names
    frame = spark.createDataFrame(hits, schemas.FILE_HIT)
    want = ManifestRequest("P")
    return workflow.ProjectInputs(str(raw), frame, spark.createDataFrame([], schemas.CASE), notes, want, "P", want.platform, "GRCh38", 9)


def run(spark, path, inputs):
    return workflow.prepare_project(spark, path, inputs, ProjectOptions(convert_to_mval=False), timestamp=F.lit("2024-01-01").cast("timestamp"))


def test_raw_files_to_matrix_and_audit(spark, inputs, tmp_path):
    ds, audit = run(spark, str(tmp_path / "run"), inputs)
    got = {(r.sample_id, r.probe_id): r.value for r in ds.values.collect()}
    assert got == {(f"f-{i}", f"cg{j}"): pytest.approx(0.3 + 0.05 * i + 0.01 * j) for i in range(8) for j in range(6) if j != 2}
    marks = {r.file_id: (r.downloaded, r.metadata_status, r.qc_pass, r.parquet_path is not None) for r in audit.collect()}
    assert marks == {f"f-{i}": (1, "success", 1, True) for i in range(8)} | {"f-lost": (0, None, None, False)}


@pytest.mark.parametrize("step", ["register_files", "clean_data", "load_raw_project", "prepare_dataset", "save_dataset"])
def test_a_killed_run_goes_on(spark, inputs, tmp_path, monkeypatch, step):
    path = str(tmp_path / "run")
    with monkeypatch.context() as broken:
        broken.setattr(workflow, step, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            run(spark, path, inputs)
    first = {name: versions.versions(spark, f"{path}/{name}") for name in ("control", "stored", "prepared")}
    ds, _ = run(spark, path, inputs)
    assert ds.values.count() == 40 and bt.read_store(spark, f"{path}/store").count() == 48
    for name, had in first.items():
        assert len(versions.versions(spark, f"{path}/{name}")) == 1 and (not had or had == versions.versions(spark, f"{path}/{name}"))
    calls = []
    with monkeypatch.context() as counted:
        for each in ("register_files", "clean_data", "load_raw_project", "prepare_dataset", "save_dataset"):
            counted.setattr(workflow, each, lambda *a, **k: calls.append(1))
        run(spark, path, inputs)
    assert not calls, "a finished run repeats nothing"


def test_a_truncated_response_is_refused(spark, inputs, tmp_path):
    from dataclasses import replace

    with pytest.raises(ValueError, match="not_truncated"):
        run(spark, str(tmp_path / "run"), replace(inputs, expected=10))


def test_tables_of_a_dataset_appear_together(spark, inputs, tmp_path, monkeypatch):
    ds, _ = run(spark, str(tmp_path / "run"), inputs)
    path = str(tmp_path / "saved")
    save_dataset(ds, path)
    bad = ds.replaced(meta=ds.meta.select(F.raise_error(F.lit("cut off")).alias("x")))
    with pytest.raises(Exception, match="cut off"):
        save_dataset(bad, path)
    assert versions.versions(spark, path) == ["version-000000001"] and load_dataset(spark, path).values.count() == 40
    save_dataset(ds.replaced(values=ds.values.limit(3)), path)
    assert load_dataset(spark, path).values.count() == 3 and len(versions.versions(spark, path)) == 2
    with pytest.raises(FileNotFoundError):
        load_dataset(spark, str(tmp_path / "none"))


def test_tables_of_a_row_per_file_are_not_broadcast(spark, tmp_path):
    """Columns of few values are stored in a hundredth of what they take in memory, so by its files such a table is small enough for the driver."""
    from betaloom.plans.intake import load_raw_project, register_files
    from betaloom.tables import materialize, spread

    want = ManifestRequest("P")
    file_id = F.concat(F.lit("f-"), F.col("id").cast("string"))
    specimen = F.struct(F.lit(want.sample_type).alias("sample_type"), F.lit(None).cast(schemas._SAMPLE["portions"].dataType).alias("portions"))
    case = F.struct(F.lit("C").alias("submitter_id"), F.struct(F.lit("P").alias("project_id")).alias("project"), F.array(specimen).alias("samples"))
    known = {"file_id": file_id, "cases": F.array(case)}
    hits = spark.range(30_000).select(*[known.get(f.name, F.lit("x")).cast(f.dataType).alias(f.name) for f in schemas.FILE_HIT.fields])
    hits = materialize(hits, "hits")
    manifest = hits.select("file_id", "file_name")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    try:
        assert "BroadcastHashJoin" in plan(manifest.join(hits, "file_id", "left")), "by its files the table is small"
        marked = spread(hits)
        for side in (marked, marked.where("file_id <> 'x'").select("file_id", "access"), marked.select("file_id").distinct().withColumn("there", F.lit(True))):
            assert "SortMergeJoin" in plan(manifest.join(side, "file_id", "left"))
        assert "SortMergeJoin" in plan(manifest.join(spread(hits.join(manifest, "file_id", "left_semi"), hits), "file_id"))
        few = hits.where("file_id < 'f-1000'")
        assert "BroadcastHashJoin" in plan(manifest.join(spread(few), "file_id", "left"))
        found = register_files(manifest, hits, spark.createDataFrame([], schemas.CASE), manifest, F.lit(1), F.lit("2024-01-01").cast("timestamp"))
        assert "SortMergeJoin" in plan(found.audit) and "BroadcastHashJoin" not in plan(found.audit)
        bt.write_store(hits.select("file_id", F.lit("cg1").alias("probe_id"), F.lit(0.5).alias("beta_value"), F.lit("P").alias("project_id")), str(tmp_path / "store"))
        ds = load_raw_project(spark, str(tmp_path / "store"), found.metadata, "P", want.platform, "GRCh38")
        assert "BroadcastHashJoin" not in plan(ds.values) and "BroadcastHashJoin" not in plan(ds.samples)
        assert ds.values.count() == ds.samples.count() == found.audit.where("downloaded = 1 AND metadata_fetched = 1").count() == 30_000
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert spread(hits) is hits
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
