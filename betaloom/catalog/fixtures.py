"""Methylation-shaped inputs derived from the whole given tables.

Nothing is sampled or cut: every embedding is a sample, every dimension a probe, every part an
annotation row, every document a file, every line item two aliquots. Planted defects (missing
cells, outliers, odd ids) are arithmetic on the keys. ``prelude.py`` states the same in SQL.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from betaloom.dataset import Dataset
from betaloom.functions.columns import batch_id, m_value
from betaloom.operators.matrix import dataset_row
from betaloom.plans.project import prepare_dataset
from betaloom.tables import checkpoint_root, materialize


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def _probe_id(number: Column, odd: Column) -> Column:
    return F.concat(F.when(odd, "ch.").otherwise("cg"), F.lpad(number.cast("string"), 8, "0"))


class Fixtures:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def scratch(self, name: str) -> str:
        """A fresh folder path next to the session's checkpoints."""
        return f"{checkpoint_root(self.spark)}/betaloom/files/{name}-{uuid.uuid4().hex}"

    # --- matrix ---

    @cached_property
    def cells(self) -> DataFrame:
        spread = self.table("embeddings").select("vec_id", "label", F.posexplode("embedding").alias("dim", "v"))
        return spread.withColumn("v", F.col("v").cast("double"))

    @cached_property
    def beta(self) -> DataFrame:
        vec, dim, v = F.col("vec_id"), F.col("dim"), F.col("v")
        value = (
            F.when((vec % 41 == 0) & (dim % 3 == 0), None)
            .when((dim % 16 == 5) & (vec % 7 == 0), None)
            .when((dim % 16 == 9) & (vec % 83 == 1), None)
            .when(dim % 16 == 7, 0.995 + v * 0.001)
            .when(dim % 16 == 11, 0.5 + v * 0.01)
            .when(vec % 97 == 3, 0.57 + v * 0.8)
            .otherwise(0.5 + v * 0.8)
        )
        own_design = (F.col("label") == 4) & (dim % 16 == 2)
        number = dim + F.when(own_design, 1000).otherwise(0)
        return self.cells.select(
            F.concat(F.lit("PRJ-"), _text("label")).alias("project_id"),
            vec.alias("sample_id"),
            _probe_id(number, dim % 16 == 15).alias("probe_id"),
            value.alias("value"),
        )

    @cached_property
    def designs(self) -> DataFrame:
        """Probes of both array designs, listed for every project."""
        numbers = F.when(F.col("dim") % 16 == 2, F.array("dim", F.col("dim") + 1000)).otherwise(F.array("dim"))
        listed = self.cells.select("label", "dim").distinct().select("label", "dim", F.explode(numbers).alias("number"))
        return listed.select(
            F.concat(F.lit("PRJ-"), _text("label")).alias("project_id"),
            _probe_id(F.col("number"), F.col("dim") % 16 == 15).alias("probe_id"),
        )

    @cached_property
    def mvals(self) -> DataFrame:
        return self.beta.withColumn("value", m_value(F.col("value")))

    @cached_property
    def samples(self) -> DataFrame:
        vec, label = _text("vec_id"), _text("label")
        plain = F.concat(
            F.lit("TC-"), label, F.lit("-"), vec, F.lit("-0"), (F.col("vec_id") % 3 + 1).cast("string"),
            F.lit("A-11D-000"), (F.col("vec_id") % 5).cast("string"), F.lit("-05"),
        )
        barcode = (
            F.when(F.col("vec_id") % 50 == 9, "TC-1-2")
            .when(F.col("vec_id") == 17, F.concat(F.lit("TC-"), label, F.lit("-17-02A-11D-9999-05")))
            .otherwise(plain)
        )
        return self.table("embeddings").select(
            F.col("vec_id").alias("sample_id"),
            F.concat(F.lit("PRJ-"), label).alias("project_id"),
            F.concat(F.lit("CASE-"), F.floor(F.col("vec_id") / 2).cast("string")).alias("submitter_id"),
            F.concat(F.lit("AL-"), vec).alias("aliquot_id"),
            F.concat(F.lit("f"), F.lpad(vec, 9, "0"), F.lit(".txt")).alias("file_name"),
            barcode.alias("barcode"),
        )

    @cached_property
    def batched(self) -> DataFrame:
        return self.samples.withColumn("batch_id", batch_id(F.col("barcode")))

    @cached_property
    def annotation(self) -> DataFrame:
        key, size = F.col("p_partkey"), F.col("p_size")
        number = key + F.when(key >= 60, 4).otherwise(0)
        gene = (
            F.when(key % 9 == 0, None)
            .when(key % 4 == 1, F.concat_ws(";", "p_brand", "p_brand"))
            .when(key % 4 == 2, F.concat(F.col("p_brand"), F.lit(";G"), (size % 7).cast("string")))
            .otherwise(F.col("p_brand"))
        )
        flags = {
            "is_sex_chr": size % 13 == 0,
            "has_cpg_snp": size % 17 == 0,
            "has_sbe_snp": size % 19 == 0,
            "has_probe_snp": size % 23 == 0,
            "is_cross_reactive": key % 29 == 3,
            "is_multi_mapped": key % 31 == 4,
            "TSS200": size % 3 == 0,
            "TSS1500": size % 3 == 1,
            "gene_body": size % 2 == 0,
        }
        return self.table("part").select(
            _probe_id(number, number % 16 == 15).alias("probe_id"),
            gene.alias("gene_symbol"),
            *[flag.alias(name) for name, flag in flags.items()],
        )

    @cached_property
    def projects(self) -> DataFrame:
        label = F.col("label")
        platform = (
            F.when(label % 3 == 0, "Illumina Human Methylation 450")
            .when(label % 3 == 1, "Illumina Methylation Epic")
            .otherwise("Illumina Human Methylation 27")
        )
        return self.table("embeddings").select("label").distinct().select(
            F.concat(F.lit("PRJ-"), _text("label")).alias("project_id"), label.alias("ordinal"), platform.alias("platform")
        )

    @cached_property
    def meta(self) -> DataFrame:
        rows = dataset_row(self.projects, F.col("platform"), F.lit("GRCh38"))
        return self.projects.select("project_id", "ordinal").join(rows, "project_id")

    @cached_property
    def raw(self) -> Dataset:
        probes = self.beta.select("project_id", "probe_id").distinct()
        return Dataset(self.beta, self.batched, probes, self.meta)

    @cached_property
    def prepared(self) -> Dataset:
        """All projects after quality control and preprocessing, stored."""
        ds, _ = prepare_dataset(self.raw, self.annotation)
        return ds.replaced(values=materialize(ds.values, "prepared"))

    # --- control tables ---

    @cached_property
    def manifest(self) -> DataFrame:
        doc = _text("doc_id")
        return self.table("documents").select(
            F.concat(F.lit("F-"), doc).alias("file_id"),
            F.concat(F.col("source"), F.lit("/"), doc, F.lit(".txt")).alias("file_name"),
        )

    @cached_property
    def status_log(self) -> DataFrame:
        status = F.when(F.col("quality") == 1, "success").otherwise("failed")
        return self.table("labels").select(
            F.concat(F.lit("F-"), _text("doc_id")).alias("file_id"),
            status.alias("status"),
            (F.col("toxic") + 1).alias("attempts"),
            F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"),
        )

    @cached_property
    def landed(self) -> DataFrame:
        """Files on disk: raw ones, and some twice because they are stored as well."""
        files = self.table("labels").where(F.col("quality") == 1).select(F.concat(F.lit("F-"), _text("doc_id")).alias("file_id"))
        return files.unionByName(files)

    @cached_property
    def hits(self) -> DataFrame:
        """Nested file records. Cases, samples and portions are missing or empty for some."""
        doc = F.col("doc_id")
        aliquot = F.struct(
            F.concat(F.lit("AL-"), _text("doc_id")).alias("aliquot_id"),
            F.when(doc % 3 != 0, F.concat(F.lit("BC-"), _text("doc_id"))).alias("submitter_id"),
        )
        portions = F.array(
            F.struct(
                F.concat(F.lit("PO-"), _text("doc_id")).alias("submitter_id"),
                F.array(F.struct(F.array(aliquot).alias("aliquots"))).alias("analytes"),
            )
        )
        sample = F.struct(
            F.when(F.col("n_chars") % 2 == 0, "Primary Tumor").otherwise("Solid Tissue Normal").alias("sample_type"),
            F.when(doc % 5 == 0, F.slice(portions, 1, 0)).otherwise(portions).alias("portions"),
        )
        other = F.struct(F.lit("Metastatic").alias("sample_type"), F.slice(portions, 1, 0).alias("portions"))
        first = F.struct(
            F.concat(F.lit("S-"), F.floor(doc / 2).cast("string")).alias("submitter_id"),
            F.struct(F.col("source").alias("project_id")).alias("project"),
            F.when(doc % 7 != 0, F.array(sample)).alias("samples"),
        )
        second = F.struct(
            F.concat(F.lit("T-"), _text("doc_id")).alias("submitter_id"),
            F.struct(F.lit("src7").alias("project_id")).alias("project"),
            F.array(other).alias("samples"),
        )
        cases = F.array(first, second)
        return self.table("documents").select(
            F.concat(F.lit("F-"), _text("doc_id")).alias("file_id"),
            F.concat(F.col("source"), F.lit("/"), _text("doc_id"), F.lit(".txt")).alias("file_name"),
            F.lit("DNA Methylation").alias("data_category"),
            F.lit("Methylation Array").alias("experimental_strategy"),
            F.lit("Methylation Beta Value").alias("data_type"),
            F.col("lang").alias("platform"),
            F.lit("GRCh38").alias("reference_genome"),
            F.when(doc % 13 == 0, "controlled").otherwise("open").alias("access"),
            F.when(doc % 11 == 1, F.slice(cases, 1, 0)).when(doc % 11 != 0, cases).alias("cases"),
        )

    @cached_property
    def cases(self) -> DataFrame:
        """Nested specimen records, one per line item: two analytes (one empty), two aliquots."""
        order, line = _text("l_orderkey"), F.col("l_linenumber")
        barcode = F.when(line % 3 != 0, F.concat(F.lit("B-"), order, F.lit("-"), _text("l_suppkey")))
        named = F.struct(F.concat(F.lit("A-"), order, F.lit("-"), _text("l_linenumber")).alias("aliquot_id"), barcode.alias("submitter_id"))
        plain = F.struct(F.concat(F.lit("X-"), order, F.lit("-"), _text("l_partkey")).alias("aliquot_id"), F.lit(None).cast("string").alias("submitter_id"))
        full = F.struct(F.array(named, plain).alias("aliquots"))
        empty = F.struct(F.slice(F.array(named, plain), 1, 0).alias("aliquots"))
        portion = F.struct(F.concat(F.lit("P-"), order).alias("submitter_id"), F.array(full, empty).alias("analytes"))
        bare = F.struct(F.slice(F.array(portion), 1, 0).alias("portions"))
        samples = F.array(F.struct(F.array(portion).alias("portions")), bare)
        lines = self.table("lineitem").join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        return lines.select(F.concat(F.lit("C-"), _text("o_custkey")).alias("submitter_id"), samples.alias("samples"))

    # --- intervals ---

    @cached_property
    def positions(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.table("part").select(
            key.alias("probe_id"),
            F.concat(F.lit("chr"), (key % 5).cast("string")).alias("chr"),
            (key * 7919 % 200000 + 1).alias("pos"),
            F.when(key % 2 == 0, "+").otherwise("-").alias("strand"),
        )

    @cached_property
    def genes(self) -> DataFrame:
        """A gene some way above every part's position, on either strand."""
        start = F.col("pos") + F.col("p_size") * 40
        own = self.positions.join(self.table("part").select(F.col("p_partkey").alias("probe_id"), "p_size"), "probe_id")
        return own.select(
            F.concat(F.lit("G"), (F.col("probe_id") % 97).cast("string")).alias("gene_symbol"), "chr", start.alias("start"),
            (start + 500 + F.col("p_size") * 10).alias("end"), F.when(F.col("probe_id") % 5 < 3, "+").otherwise("-").alias("strand"),
        )

    @cached_property
    def annotated_positions(self) -> DataFrame:
        """Every annotated probe at the position of its part."""
        number = F.col("probe_id") + F.when(F.col("probe_id") >= 60, 4).otherwise(0)
        named = self.positions.select(_probe_id(number, number % 16 == 15).alias("probe_id"), "chr", "pos")
        return self.annotation.join(named, "probe_id")

    @cached_property
    def chain_file(self) -> str:
        """A written chain file: a stanza per order, a block per line item."""
        line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
        lines = self.table("lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("lines"))
        lines = lines.join(self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
        size, dt, dq = (lambda x: x["l_quantity"].cast("long")), (lambda x: x["l_partkey"] % 50), (lambda x: x["l_suppkey"] % 50)
        inner, last = F.slice("lines", F.lit(1), F.size("lines") - 1), F.element_at("lines", -1)
        steps = F.transform(inner, lambda x: F.concat_ws(" ", size(x), dt(x), dq(x)))
        total = lambda step: F.aggregate(inner, size(last), lambda done, x: done + size(x) + step(x))
        stanzas = lines.select("l_orderkey", "o_custkey", total(dt).alias("t"), total(dq).alias("q"), F.concat(steps, F.array(size(last).cast("string"))).alias("lines"))
        start = F.col("l_orderkey") * 10
        strand = F.when(F.col("l_orderkey") % 3 == 0, "-").otherwise("+")
        header = F.concat_ws(
            " ", F.lit("chain 1000"), F.concat(F.lit("chr"), F.col("o_custkey") % 5), F.lit(900_000_000), F.lit("+"), start, start + F.col("t"),
            F.concat(F.lit("chr"), F.col("o_custkey") % 7), F.lit(800_000_000), strand, start + 7, start + 7 + F.col("q"), F.col("l_orderkey"),
        )
        path = self.scratch("chain")
        text = F.concat_ws("\n", header, F.col("lines"), F.lit(""))
        stanzas.select(text.alias("value")).write.text(path)
        return path

    @cached_property
    def attempt_log(self) -> DataFrame:
        """Three attempts at some files: requests that failed, and successes noted for all files of a request."""
        doc = F.col("doc_id")
        tries = F.array(F.lit(1), F.when(doc % 3 != 0, F.lit(2)), F.when(doc % 21 == 7, F.lit(3)))
        each = self.table("documents").where(doc % 17 != 5).select("doc_id", F.explode(F.filter(tries, lambda t: t.isNotNull())).alias("attempt"))
        failed = F.when((doc + F.col("attempt")) % 2 == 0, F.array(F.lit("failed"), F.lit("success"))).otherwise(F.array(F.lit("success")))
        return each.select(
            F.concat(F.lit("F-"), _text("doc_id")).alias("file_id"), "attempt", F.explode(failed).alias("status"),
            F.timestamp_seconds(F.lit(1_700_000_000) + F.col("attempt") * 60).alias("timestamp"),
        )

    @cached_property
    def islands(self) -> DataFrame:
        base = F.floor(F.col("s_suppkey") / 5) * 10000
        return self.table("supplier").select(
            F.concat(F.lit("chr"), (F.col("s_suppkey") % 5).cast("string")).alias("chr"),
            (base + F.col("s_nationkey") * 37 + 1).alias("start"),
            (base + F.col("s_nationkey") * 57 + 501).alias("end"),
        )

    @cached_property
    def chain(self) -> DataFrame:
        key, region = F.col("n_nationkey"), F.col("n_regionkey")
        start = (F.floor(key / 5) * 40000 + 1).cast("long")
        own = F.concat(F.lit("chr"), (key % 5).cast("string"))
        blocks = self.table("nation").select(
            own.alias("chr"),
            start.alias("start"),
            (start + 38999).alias("end"),
            F.when(key % 7 == 0, "chr9").otherwise(own).alias("to_chr"),
            (start + region * 1000).alias("to_start"),
            F.when(key % 4 == 3, "-").otherwise("+").alias("to_strand"),
        )
        repeats = self.table("region").select(
            F.concat(F.lit("chr"), _text("r_regionkey")).alias("chr"),
            F.lit(5000).cast("long").alias("start"),
            F.lit(9000).cast("long").alias("end"),
            F.lit("chrUn").alias("to_chr"),
            F.lit(5000).cast("long").alias("to_start"),
            F.lit("+").alias("to_strand"),
        )
        return blocks.unionByName(repeats)
