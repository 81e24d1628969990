"""Raw sample files and the columnar beta store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from betaloom import schemas
from betaloom.functions.columns import parsed_number
from betaloom.sources import folders, ledger
from betaloom.tables import materialize, spread

FILE = ["file_id", "file_name"]


def read_raw(spark: SparkSession, raw_dir: str, only: DataFrame | None = None) -> DataFrame:
    """All ``<raw_dir>/<file_id>/<file_name>`` tables as ``(file_id, file_name, probe_id, beta_value)``.

    Header names are ignored and text that is no number becomes NULL. Tasks list the folders and open the files; ``only`` may name the files
    (``file_id``, ``file_name``) that are wanted, others aren't opened then. Where Arrow can't open the store, or files are packed by a
    codec it hasn't, one scan of Spark's reader goes over all files, which the driver lists.
    """
    files = _listed(spark, raw_dir)
    if files is None or not files.where(F.col("file_name").rlike(folders.CODECS)).isEmpty():
        reader = spark.read.schema(schemas.RAW_BETA).option("recursiveFileLookup", True)
        rows = located(reader.csv(raw_dir, sep="\t", header=True, enforceSchema=True), raw_dir)
        return rows if only is None else rows.join(only, FILE, "left_semi")
    if only is not None:
        files = materialize(files.join(only, FILE, "left_semi"), "wanted-files")
    fields = F.from_csv("line", schemas.RAW_BETA.toDDL(), {"sep": "\t"})
    rows = folders.lines_of(files).select(*FILE, fields.alias("row"))
    return rows.select(*FILE, "row.probe_id", parsed_number(F.col("row.beta_value")).alias("beta_value"))


def _listed(spark: SparkSession, raw_dir: str) -> DataFrame | None:
    """The files below a folder or pattern with their ids, or ``None`` where Arrow can't list them. A folder ``file_id=<id>``, as Spark's writers
    name it, is read as its id."""
    roots = folders.roots(spark, raw_dir)
    if roots is None:
        return None
    return folders.listed(spark, roots).withColumn("file_id", F.regexp_replace("folder", "^file_id=", ""))


def located(rows: DataFrame, raw_dir: str) -> DataFrame:
    """Take file id and name from the path a row was read from, and parse its value."""
    return _placed(rows, raw_dir, "_metadata.file_path").select("file_id", "file_name", "probe_id", parsed_number(F.col("beta_value")).alias("beta_value"))


def raw_files(spark: SparkSession, raw_dir: str) -> DataFrame:
    """(file_id, file_name) of the raw files that exist; no file is opened."""
    files = _listed(spark, raw_dir)
    if files is None:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(raw_dir).select("path")
        files = _placed(listed, raw_dir, "path")
    return files.select(*FILE)


def _placed(rows: DataFrame, raw_dir: str, path: str) -> DataFrame:
    """Add ``file_id`` and ``file_name`` from a path column.

    ``raw_dir`` may be a pattern. Files deeper than ``<raw_dir>/<file_id>/`` (logs of the transfer client) are left out. A folder
    ``file_id=<id>``, as Spark's writers name it, is read as its id.
    """
    folder = rows.sparkSession._jvm.org.apache.hadoop.fs.Path(raw_dir)
    configuration = rows.sparkSession._jsc.hadoopConfiguration()
    depth = folder.getFileSystem(configuration).makeQualified(folder).depth()
    text = F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B"))) if path != "path" else F.col(path)
    names = F.split(F.regexp_replace(text, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/", ""), "/")
    placed = rows.withColumn("_names", names)
    return placed.where(F.size("_names") == depth + 2).withColumns(
        {"file_id": F.regexp_replace(F.get("_names", depth), "^file_id=", ""), "file_name": F.get("_names", depth + 1)}
    )


def _pending(audit: DataFrame) -> DataFrame:
    return audit.where((F.col("downloaded") == 1) & F.col("parquet_path").isNull()).select(*FILE)


def pending_rows(raw: DataFrame, audit: DataFrame) -> DataFrame:
    """Rows of files that were downloaded but not yet stored."""
    return raw.join(_pending(audit), FILE, "left_semi")


def write_store(beta: DataFrame, path: str, batch: str | None = None) -> str:
    """Append rows as one batch, a few large files per project in place of one file per sample."""
    return ledger.add_batch(beta, path, schemas.BETA, batch)


def stored_files(spark: SparkSession, path: str, projects: list[str] | None = None) -> DataFrame:
    """(project_id, file_id, batch) of the store, from its log alone."""
    return ledger.logged_files(spark, path, projects).select("project_id", "file_id", "batch")


def add_files(beta: DataFrame, path: str, batch: str | None = None) -> None:
    """Append the files that the store lacks, so that a run repeated adds nothing. Reads the log, never the stored rows."""
    held = stored_files(beta.sparkSession, path).drop("batch")
    write_store(beta.join(held, ["project_id", "file_id"], "left_anti"), path, batch)


def read_store(spark: SparkSession, path: str, projects: list[str] | None = None) -> DataFrame:
    """The beta store's published batches; a project list prunes folders."""
    return ledger.stored_rows(spark, path, schemas.BETA, projects)


def load_sample(store: DataFrame, file_id: str) -> DataFrame:
    """Values of one sample; the id filter reaches the Parquet scan."""
    return store.where(F.col("file_id") == file_id).select("probe_id", "beta_value")


def clean_data(spark: SparkSession, raw_dir: str, audit: DataFrame, store_path: str, project_id: str) -> DataFrame:
    """Add pending raw files that the store lacks and return the audit table with their paths."""
    from betaloom.operators.control import update_paths

    pending = _pending(audit)
    held = spread(stored_files(spark, store_path, [project_id]).select("file_id"))
    lacked = spread(pending.join(held, "file_id", "left_anti"), audit)
    fresh = read_raw(spark, raw_dir, lacked)
    write_store(fresh.drop("file_name").withColumn("project_id", F.lit(project_id)), store_path)
    stored = spread(stored_files(spark, store_path, [project_id]).select("file_id", "batch"))
    missing = pending.join(stored, "file_id", "left_anti").select("file_id").take(1)
    if missing:
        raise FileNotFoundError(f"no raw file for downloaded file {missing[0].file_id}")
    folder = F.concat(F.lit(f"{store_path}/data/batch="), F.col("batch"), F.lit(f"/project_id={project_id}"))
    return update_paths(audit, stored.select("file_id", folder.alias("path")))
