import json

import pytest
from pyspark.sql import functions as F

from betaloom import schemas
from betaloom.operators import control as ct
from betaloom.settings import ManifestRequest
from betaloom.sources import control as files

WANT = ManifestRequest(project_id="P1", platform="X")


def hit(file_id, cases, access="open", platform="X"):
    return {
        "file_id": file_id, "file_name": f"{file_id}.txt", "data_category": WANT.data_category, "experimental_strategy": WANT.experimental_strategy,
        "data_type": WANT.data_type, "platform": platform, "reference_genome": "GRCh38", "access": access, "cases": cases,
    }


def case(project="P1", kind="Primary Tumor", **extra):
    return {"submitter_id": f"C-{project}", "project": {"project_id": project}, "samples": [{"sample_type": kind, **extra}]}


@pytest.fixture
def responses(spark, tmp_path):
    def write(*hits):
        (tmp_path / "r1.json").write_text(json.dumps({"data": {"hits": list(hits)}}, indent=1))
        return files.read_responses(spark, str(tmp_path), schemas.FILE_HIT)

    return write


def test_manifest_filter_matches_any_nested_element(responses):
    hits = responses(
        hit("ok", [case("P2", "Blood"), case("P1")]), hit("closed", [case()], access="controlled"),
        hit("other", [case("P2")]), hit("blood", [case(kind="Blood")]), hit("none", None), hit("array", [case()], platform="Y"),
    )
    assert [r.file_id for r in ct.build_manifest(hits, WANT).collect()] == ["ok"]


def test_manifest_checks_count_first_case_types(responses):
    hits = responses(hit("a", [case()]), hit("b", [case("P1", "Blood"), case("P1")]), hit("c", [case("P2")]))
    got = {r.check: (r.violations, r.ok) for r in ct.manifest_checks(hits, WANT, expected=4).collect()}
    assert got["sample_type"] == (1, False) and got["project_id"] == (1, False)
    assert got["not_truncated"] == (1, False) and got["not_empty"] == (0, True) and got["platform"] == (0, True)
    empty = {r.check: r.ok for r in ct.manifest_checks(hits.where("false"), WANT).collect()}
    assert not empty["not_empty"] and empty["platform"]


def test_flatten_survives_every_missing_level(responses):
    deep = {"portions": [{"analytes": [{"aliquots": [{"aliquot_id": "A1"}, {"aliquot_id": "A2"}]}]}]}
    hits = responses(
        hit("full", [case(**deep), case("P9")]), hit("no_cases", None), hit("empty", []), hit("no_samples", [{"submitter_id": "S"}]),
        hit("no_aliquots", [case(portions=[{"analytes": [{"aliquots": []}]}])]), hit("no_portions", [case(portions=[])]),
    )
    got = {r.file_id: (r.project_id, r.submitter_id, r.sample_type, r.aliquot_id) for r in ct.flatten_metadata(hits).collect()}
    assert got == {
        "full": ("P1", "C-P1", "Primary Tumor", "A1"), "no_cases": (None,) * 4, "empty": (None,) * 4, "no_samples": (None, "S", None, None),
        "no_aliquots": ("P1", "C-P1", "Primary Tumor", None), "no_portions": ("P1", "C-P1", "Primary Tumor", None),
    }


def test_failed_metadata_stays_failed(rows):
    asked = rows([("a",), ("b",), ("c",)], "file_id string")
    returned = rows([("a", None), ("b", "failed")], "file_id string, status string")
    assert {r.file_id: r.status for r in ct.complete_metadata(asked, returned).collect()} == {"a": "success", "b": "failed", "c": "failed"}


def test_audit_life_cycle(rows):
    manifest = rows([("a", "a.txt"), ("b", "b.txt"), ("c", "c.txt")], "file_id string, file_name string")
    landed = rows([("a",), ("a",), ("b",)], "file_id string")
    assert {r.file_id for r in ct.pending_files(manifest, landed).collect()} == {"c"}
    log = ct.download_status(manifest, landed, F.lit(2), F.lit("2024-01-01").cast("timestamp"))
    audit = ct.initialize_audit_table(manifest, log)
    assert audit.schema.names == schemas.AUDIT.names
    audit = ct.update_metadata(audit, rows([("a", "success"), ("b", "failed")], "file_id string, status string"))
    audit = ct.update_qc(audit, rows([("a",), ("b",)], "file_id string"), rows([("b",)], "file_id string"))
    audit = ct.update_paths(audit, rows([("a", "p/a")], "file_id string, path string"))
    audit = ct.update_paths(audit, rows([("a", "elsewhere"), ("b", "p/b")], "file_id string, path string"))
    got = {r.file_id: (r.downloaded, r.download_status, r.metadata_fetched, r.qc_pass, r.parquet_path) for r in audit.collect()}
    assert got == {"a": (1, "success", 1, 0, "p/a"), "b": (1, "success", 0, 1, "p/b"), "c": (0, "failed", 0, None, None)}


def test_unlogged_file_counts_as_not_downloaded(rows):
    log = rows([], "file_id string, status string, attempts int, timestamp timestamp")
    row = ct.initialize_audit_table(rows([("a", "a.txt")], "file_id string, file_name string"), log).first()
    assert row.downloaded == 0 and row.download_status is None


def test_biospecimen_falls_back_and_keeps_one_row(spark):
    aliquots = [{"aliquot_id": "A", "submitter_id": "z"}, {"aliquot_id": "A", "submitter_id": "b"}, {"aliquot_id": "N"}, {"aliquot_id": "other"}]
    specimen = [
        {"submitter_id": "C", "samples": [{"portions": [{"submitter_id": "PB", "analytes": [{"aliquots": aliquots}, {}]}, {}]}, {}]},
        {"submitter_id": "unasked", "samples": []},
    ]
    cases = spark.createDataFrame([json.dumps(c) for c in specimen], "string").select(F.from_json("value", schemas.CASE).alias("c")).select("c.*")
    metadata = spark.createDataFrame([("C", "A"), ("C", "N")], "submitter_id string, aliquot_id string")
    got = {(r.case_id, r.aliquot_id, r.barcode) for r in ct.build_biospecimen(cases, metadata).collect()}
    assert got == {("C", "A", "b"), ("C", "N", "PB")}
    joined = ct.attach_barcodes(metadata, ct.build_biospecimen(cases, metadata))
    assert {r.aliquot_id: (r.barcode, r.batch_id) for r in joined.collect()} == {"A": ("b", None), "N": ("PB", None)}


def test_failed_manifest_checks_stop_registration(responses):
    from betaloom.plans.intake import verified_manifest

    mixed = responses(hit("ok", [case()]), hit("late", [case(kind="Blood"), case()]))
    with pytest.raises(ValueError, match="sample_type"):
        verified_manifest(mixed, WANT)
    assert [r.file_id for r in verified_manifest(mixed.where("file_id = 'ok'"), WANT).collect()] == ["ok"]
    with pytest.raises(ValueError, match="not_empty"):
        verified_manifest(mixed.where("false"), WANT)
