import bz2
import gzip
import io
from collections import Counter

import pytest
from pyspark.sql import functions as F

from betaloom import schemas
from betaloom.dataset import Dataset
from betaloom.operators.matrix import dataset_row
from betaloom.settings import PLATFORMS
from betaloom.sources import annotation as an
from betaloom.sources import beta as bt
from betaloom.sources import ledger
from betaloom.sources import control as files
from betaloom.sources.matrix import load_datasets, save_dataset
from betaloom.streaming.ingest import ingest_available, read_raw_stream


def write_raw(folder, file_id, name, lines):
    (folder / file_id).mkdir(parents=True)
    (folder / file_id / name).write_text("Composite Element REF\tBeta_value\n" + "".join(f"{p}\t{v}\n" for p, v in lines))


@pytest.fixture
def raw_dir(tmp_path):
    raw = tmp_path / "raw"
    write_raw(raw, "f-1", "level 3+a.txt", [("cg1", "0.5"), ("cg2", "NA")])
    write_raw(raw, "f-2", "b.txt", [("cg1", "NaN"), ("cg3", "1e-2")])
    write_raw(raw, "f-3", "c.txt", [("cg1", "0.9")])
    (raw / "f-1" / "logs").mkdir()
    (raw / "f-1" / "logs" / "x.parcel").write_text("h\tv\njunk\t1\n")
    return raw


def audit_of(rows):
    data = [("f-1", "level 3+a.txt", 1, None), ("f-2", "b.txt", 1, None), ("f-3", "c.txt", 0, None)]
    audit = rows(data, "file_id string, file_name string, downloaded int, parquet_path string")
    return audit


def cells(df):
    return {(r.file_id, r.probe_id): r.beta_value for r in df.collect()}


def test_clean_data_takes_pending_files_once(spark, rows, raw_dir, tmp_path):
    store = str(tmp_path / "store")
    audit = bt.clean_data(spark, str(raw_dir), audit_of(rows), store, "P")
    (batch,) = ledger.published(spark, store)
    folder = f"{store}/data/batch={batch}/project_id=P"
    assert {r.file_id: r.parquet_path for r in audit.collect()} == {"f-1": folder, "f-2": folder, "f-3": None}
    want = {("f-1", "cg1"): 0.5, ("f-1", "cg2"): None, ("f-2", "cg1"): None, ("f-2", "cg3"): 0.01}
    assert cells(bt.read_store(spark, store)) == want
    bt.clean_data(spark, str(raw_dir), audit.cache(), store, "P")
    assert bt.read_store(spark, store).count() == 4
    assert {r.probe_id: r.beta_value for r in bt.load_sample(bt.read_store(spark, store), "f-2").collect()} == {"cg1": None, "cg3": 0.01}
    assert bt.read_store(spark, store, ["Q"]).count() == 0


def test_clean_data_reports_a_missing_file(spark, rows, raw_dir, tmp_path):
    audit = audit_of(rows).unionByName(rows([("gone", "g.txt", 1, None)], audit_of(rows).schema))
    with pytest.raises(FileNotFoundError, match="gone"):
        bt.clean_data(spark, str(raw_dir), audit, str(tmp_path / "store"), "P")


def test_stream_ingests_each_file_once(spark, raw_dir, tmp_path):
    store, mark = str(tmp_path / "store"), str(tmp_path / "mark")
    for _ in range(2):
        ingest_available(read_raw_stream(spark, str(raw_dir)), store, "P", mark).awaitTermination()
    write_raw(raw_dir, "f-4", "d.txt", [("cg9", "0.1")])
    ingest_available(read_raw_stream(spark, str(raw_dir)), store, "P", mark).awaitTermination()
    got = bt.read_store(spark, store)
    assert got.count() == 6
    assert cells(got)[("f-4", "cg9")] == 0.1 and cells(got)[("f-2", "cg1")] is None


BETA = "project_id string, file_id string, probe_id string, beta_value double"


def test_a_batch_is_there_once_published(spark, rows, tmp_path):
    store = str(tmp_path / "store")
    assert bt.read_store(spark, store).count() == 0 and bt.stored_files(spark, store).count() == 0
    first = rows([("P", "f-1", "cg1", 0.5), ("P", "f-1", "cg2", None), ("7", "f-2", "cg1", 0.1)], BETA)
    bt.add_files(first, store, "one")
    bt.add_files(first, store, "one")
    bt.add_files(first, store, "two")
    assert ledger.published(spark, store) == ["one"], "neither the same batch nor the same files again"
    # a batch cut off before and one cut off after its log entry was written
    ledger.write_batch(rows([("P", "f-3", "cg1", 0.3)], BETA), store, "half")
    ledger.write_batch(rows([("P", "f-4", "cg1", 0.4)], BETA), store, "late")
    (tmp_path / "store" / "log" / "_writing-late" / "project_id=P").mkdir(parents=True)
    assert bt.read_store(spark, store).count() == 3
    assert {r.file_id for r in bt.stored_files(spark, store).collect()} == {"f-1", "f-2"}
    bt.add_files(rows([("P", "f-1", "cg1", 0.5), ("P", "f-3", "cg1", 0.3), ("P", "f-3", "cg2", 0.2)], BETA), store, "half")
    assert cells(bt.read_store(spark, store, ["P"])) == {("f-1", "cg1"): 0.5, ("f-1", "cg2"): None, ("f-3", "cg1"): 0.3, ("f-3", "cg2"): 0.2}
    assert {(r.project_id, r.file_id, r.n_rows) for r in ledger.logged_files(spark, store).collect()} == {("P", "f-1", 2), ("7", "f-2", 1), ("P", "f-3", 2)}
    with pytest.raises(FileExistsError):
        ledger.publish(spark, store, "half", schemas.BETA)
    with open(tmp_path / "ledger.txt", "w") as plan:
        plan.write(bt.stored_files(spark, store, ["7"])._jdf.queryExecution().executedPlan().toString())
    text = (tmp_path / "ledger.txt").read_text()
    assert "/data" not in text and "PartitionFilters: [isnotnull(project_id" in text


def test_adding_files_never_reads_stored_rows(spark, rows, tmp_path):
    store = str(tmp_path / "store")
    bt.add_files(rows([("P", "f-1", "cg1", 0.5)], BETA), store)
    for part in (tmp_path / "store" / "data").rglob("*.parquet"):
        part.write_bytes(b"not readable")
    bt.add_files(rows([("P", "f-1", "cg1", 0.5), ("P", "f-2", "cg1", 0.5)], BETA), store)
    assert sorted(r.file_id for r in bt.stored_files(spark, store).collect()) == ["f-1", "f-2"]


def test_raw_folders_by_pattern_and_odd_ids(spark, tmp_path):
    for root, file_id in (("raw1", "a=b"), ("raw2", "file_id=x"), ("raw2", "plain")):
        write_raw(tmp_path / root, file_id, "t.txt", [("cg1", "0.5")])
    assert {r.file_id for r in bt.read_raw(spark, str(tmp_path / "raw*")).collect()} == {"a=b", "x", "plain"}
    assert {r.file_id for r in bt.read_raw(spark, str(tmp_path / "raw1/")).collect()} == {"a=b"}


def test_annotation_partitions_and_refusals(spark, rows, tmp_path):
    path = str(tmp_path / "anno")
    data = [(g, p, f"cg-{g}-{p}") for g in ("GRCh37", "GRCh38") for p in PLATFORMS]
    an.write_annotation(rows(data, "reference_genome string, platform string, probe_id string"), path)
    got = an.load_annotation(spark, path, PLATFORMS[2], "GRCh37")
    assert [r.probe_id for r in got.collect()] == [f"cg-GRCh37-{PLATFORMS[2]}"]
    scan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in scan
    with pytest.raises(ValueError, match="platform"):
        an.load_annotation(spark, path, "Illumina", "GRCh37")
    with pytest.raises(ValueError, match="genome"):
        an.load_annotation(spark, path, PLATFORMS[0], "hg19")


def test_annotation_csvs(spark, tmp_path):
    header = ",".join(schemas.ANNOTATION.names)
    for name in ("epic", "k27"):
        (tmp_path / f"{name}.csv").write_text(f"{header}\ncg-{name},chr1,12,+,I,NA,TRUE,FALSE,FALSE,FALSE,FALSE,TRUE\n")
    got = an.csvs_to_parquet(spark, str(tmp_path), str(tmp_path / "out"))
    rows = {r.table: r for r in got.collect()}
    assert set(rows) == {"epic", "k27"}
    assert rows["epic"].probe_id == "cg-epic" and rows["epic"].gene_symbol is None and rows["epic"].is_sex_chr and rows["epic"].pos == 12


def test_control_tables_round_trip(rows, spark, tmp_path):
    audit = rows([("a", "a.txt", 1, "success", 2, None, None, None, None, None, None)], schemas.AUDIT)
    files.save_audit_table(audit, str(tmp_path / "audit"))
    assert files.load_audit_table(spark, str(tmp_path / "audit")).collect() == audit.collect()
    manifest = rows([("a", "x\ty.txt")], schemas.MANIFEST)
    files.save_manifest(manifest, str(tmp_path / "m"))
    assert files.load_manifest(spark, str(tmp_path / "m")).collect() == manifest.collect()


def test_saved_datasets_stack(rows, spark, matrix, tmp_path):
    paths = []
    for p in ("P", "Q"):
        values = matrix([(p, "s", "cg1", 0.5)])
        meta = dataset_row(rows([(p,)], "project_id string"), F.lit("x"), F.lit("GRCh38"))
        samples = values.select("project_id", "sample_id").withColumn(f"only_{p}", F.lit(1))
        paths.append(str(tmp_path / p))
        save_dataset(Dataset(values, samples, values.select("project_id", "probe_id"), meta), paths[-1])
    both = load_datasets(spark, paths)
    assert both.values.count() == 2 and both.meta.count() == 2
    assert both.samples.columns == ["project_id", "sample_id"], "only shared sample columns stay"


def test_raw_project_from_store_and_metadata(spark, rows, raw_dir, tmp_path):
    from betaloom import api

    store = str(tmp_path / "store")
    api.clean_data(spark, str(raw_dir), audit_of(rows), store, "P")
    metadata = rows([("f-1", "success", "z.txt"), ("f-2", "failed", "a.txt"), ("f-9", "success", "b.txt")], "file_id string, status string, file_name string")
    ds = api.load_raw_project(spark, store, metadata, "P", PLATFORMS[1], "GRCh38")
    assert {(r.sample_id, r.probe_id): r.value for r in ds.values.collect()} == {("f-1", "cg1"): 0.5, ("f-1", "cg2"): None}
    assert [r.sample_id for r in ds.samples.collect()] == ["f-1"]
    row = ds.meta.first()
    assert (row.platform, row.conversion, row.state, row.preprocessing_steps) == (PLATFORMS[1], "beta_value", "raw", [])
    with pytest.raises(ValueError, match="genome"):
        api.load_raw_project(spark, store, metadata, "P", PLATFORMS[1], "hg38")


def test_raw_files_of_a_query_are_written_one_a_sample(spark, rows, tmp_path):
    from betaloom.catalog.matrix_queries import _write_raw
    from betaloom.sources.beta import raw_files, read_raw

    cells = [(s, f"cg{p}", "NA" if p == 3 else repr(p / 7)) for s in range(50) for p in range(s % 4 + 3)]
    _write_raw(rows(cells, "file_id long, probe_id string, value string"), str(tmp_path / "raw"))
    assert sorted(int(r.file_id) for r in raw_files(spark, str(tmp_path / "raw")).collect()) == list(range(50))
    got = {(int(r.file_id), r.probe_id, r.beta_value) for r in read_raw(spark, str(tmp_path / "raw")).collect()}
    assert got == {(s, p, None if v == "NA" else float(v)) for s, p, v in cells}


ODD_FILES = {
    "plain/a.txt": b"h\tv\ncg1\t0.5\ncg2\tNA\n",
    "crlf/a b+c%20.txt": b"h\tv\r\ncg1\t0.5\r\n\r\ncg2\t 0.25 \r\n",
    "cr/\u00e4.txt": b"h\tv\rcg1\t0.5\rcg2\t1e-2",
    "bom/a.txt": b"\xef\xbb\xbf\nh\tv\ncg1\t0.5\n",
    "blank/a.txt": b"\n  \t \nh\tv\n\n \ncg1\t0.5\n\t\n",
    "quotes/a.txt": b'h\tv\n"cg1"\t"0.5"\n"cg\t2"\t0.1\n"cg3\t0.1\n"c""g"\t0.2\n"a\\"b"\t0.3\n""\t0.7\n',
    "widths/a.txt": b"h\tv\ncg1\ncg2\t0.5\tmore\n\t0.7\ncg3\t\n#cg4\t0.1\n cg5 \t0.1\n\x00cg6\t0.1\n",
    "bytes/a.txt": b"h\tv\ncg\xff\xe41\t0.5\ncg\xc3\xa42\t0.25\n\xe2\x80\xa8x\x0by\x1cz\t0.1\n",
    "empty/a.txt": b"",
    "header/a.txt": b"h\tv",
    "gz/a.txt.gz": gzip.compress(b"h\tv\ncg1\t0.5\n") + gzip.compress(b"cg2\t0.25\n"),
    "two/a.txt": b"h\tv\ncg1\t0.5\n",
    "two/b.txt": b"h\tv\ncg1\t0.6\n",
    "deep/logs/a.txt": b"h\tv\ncg1\t0.5\n",
    "shallow.txt": b"h\tv\ncg1\t0.5\n",
    "hidden/.a.txt": b"h\tv\ncg1\t0.5\n",
    "hidden/_a.txt": b"h\tv\ncg1\t0.5\n",
    "hidden/_a=1.txt": b"h\tv\ncg1\t0.5\n",
    "hidden/a._COPYING_": b"h\tv\ncg1\t0.5\n",
    "_hidden/a.txt": b"h\tv\ncg1\t0.5\n",
    "file_id=7/a.txt": b"h\tv\ncg1\t0.5\n",
}


def by_sparks_reader(monkeypatch, read):
    with monkeypatch.context() as patch:
        patch.setattr(bt.folders, "roots", lambda *_: None)
        return Counter(tuple(r) for r in read().collect())


@pytest.mark.parametrize("root", ["ra w%41+", "r*"])
def test_tasks_list_and_read_what_sparks_readers_do(spark, tmp_path, monkeypatch, root):
    for name, content in ODD_FILES.items():
        path = tmp_path / "ra w%41+" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
    (tmp_path / "ra w%41+" / "plain" / "gone.txt").symlink_to(tmp_path / "nowhere")
    (tmp_path / "r.txt").write_text("h\tv\ncg1\t0.5\n")
    folder = str(tmp_path / root)
    for read in (lambda: bt.raw_files(spark, folder), lambda: bt.read_raw(spark, folder)):
        assert Counter(tuple(r) for r in read().collect()) == by_sparks_reader(monkeypatch, read)


def test_packed_files_that_tasks_cannot_read_are_left_to_spark(spark, tmp_path):
    write_raw(tmp_path / "raw", "f-1", "a.txt", [("cg1", "0.5")])
    (tmp_path / "raw" / "f-2").mkdir()
    (tmp_path / "raw" / "f-2" / "b.txt.bz2").write_bytes(bz2.compress(b"h\tv\ncg1\t0.25\n"))
    assert cells(bt.read_raw(spark, str(tmp_path / "raw"))) == {("f-1", "cg1"): 0.5, ("f-2", "cg1"): 0.25}


def test_lines_are_cut_alike_wherever_a_block_ends(monkeypatch):
    content = b"\r\n \r\nhead\r\ncg1\t0.5\rcg2\t1\r\n\r\r\n\ncg3\n\rcg4\r"
    for size in range(1, len(content) + 2):
        monkeypatch.setattr(bt.folders, "BLOCK", size)
        found = [line for part in bt.folders._file_lines(io.BytesIO(content)) for line in part]
        assert found == [b"cg1\t0.5", b"cg2\t1", b"cg3", b"cg4"], size


def test_raw_files_are_not_listed_by_the_driver(spark, rows, raw_dir, tmp_path):
    """A reader of Spark's keeps every file of the folder in the driver's memory; files that nobody waits for aren't opened either."""
    (raw_dir / "f-3" / "c.txt").write_bytes(b"h\tv\n" + b"not opened")
    for df in (bt.raw_files(spark, str(raw_dir)), bt.read_raw(spark, str(raw_dir), rows([("f-1", "level 3+a.txt")], "file_id string, file_name string"))):
        assert not [f for f in df.inputFiles() if f.startswith(raw_dir.as_uri())]
    bt.clean_data(spark, str(raw_dir), audit_of(rows), str(tmp_path / "store"), "P")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "csv" not in plan.replace("from_csv", "") and {r.file_id for r in df.collect()} == {"f-1"}
