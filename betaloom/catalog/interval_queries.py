"""Annotation building and genomic intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from betaloom.catalog.fixtures import Fixtures
from betaloom.catalog.matrix_queries import rounded
from betaloom.catalog.registry import query
from betaloom.operators import annotation as an
from betaloom.operators import cohort as co
from betaloom.operators import intervals as iv
from betaloom.operators.regions import region_flags, with_regions
from betaloom.settings import PLATFORMS
from betaloom.sources.chain import read_chain

SEX = ("chr0", "chr1")


def _array_table(fx: Fixtures) -> DataFrame:
    """What an array's own table looks like: gene list, probe type, rs ids where known."""
    size = F.col("p_size")
    rs = lambda every: F.when(size % every == 0, F.concat(F.lit("rs"), size.cast("string")))
    parts = fx.table("part").select(
        F.col("p_partkey").alias("probe_id"), F.col("p_brand").alias("Symbol"), F.col("p_type").alias("Type"),
        rs(17).alias("CpG_rs"), rs(19).alias("SBE_rs"), rs(23).alias("Probe_rs"),
    )
    return fx.positions.join(parts, "probe_id")


def _reactive(fx: Fixtures) -> DataFrame:
    """A curated list that repeats ids: one row per line item of the parts on it."""
    return fx.table("lineitem").where(F.col("l_returnflag") == "R").select(F.col("l_partkey").alias("probe_id"))


VIEW = """
SELECT p.probe_id, p.chr, p.pos, p.strand, q.p_type AS probe_type, q.p_brand AS gene_symbol, p.chr IN ('chr0', 'chr1') AS is_sex_chr,
       q.p_size % 17 = 0 AS has_cpg_snp, q.p_size % 19 = 0 AS has_sbe_snp, q.p_size % 23 = 0 AS has_probe_snp,
       p.probe_id IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R') AS reactive
FROM fx_positions p JOIN part q ON q.p_partkey = p.probe_id"""


@query("H1 H2 H4", f"""
SELECT probe_id, is_sex_chr, has_cpg_snp, has_sbe_snp, has_probe_snp, false AS is_cross_reactive FROM ({VIEW})""")
def annotation_flags(fx: Fixtures) -> DataFrame:
    flags = an.snp_flags(has_cpg_snp="CpG_rs", has_sbe_snp="SBE_rs", has_probe_snp="Probe_rs")
    flags["is_sex_chr"] = an.sex_chromosome_flag(F.col("chr"), SEX)
    flags |= an.constant_flags("is_cross_reactive")
    return _array_table(fx).select("probe_id", *[c.alias(n) for n, c in flags.items()])


@query("H3", f"SELECT probe_id, reactive AS is_cross_reactive FROM ({VIEW})")
def listed_probes(fx: Fixtures) -> DataFrame:
    return an.flag_members(fx.positions.select("probe_id"), _reactive(fx), "is_cross_reactive")


@query("H5", f"""
SELECT 'Illumina Human Methylation 27' AS platform, probe_id, chr, pos, strand, probe_type, gene_symbol, is_sex_chr,
       false AS has_cpg_snp, false AS has_sbe_snp, false AS has_probe_snp, false AS is_cross_reactive, false AS is_multi_mapped FROM ({VIEW})
UNION ALL
SELECT 'Illumina Human Methylation 450', probe_id, chr, pos, strand, probe_type, gene_symbol, is_sex_chr,
       has_cpg_snp, has_sbe_snp, has_probe_snp, reactive, reactive FROM ({VIEW})
UNION ALL
SELECT 'Illumina Methylation Epic', probe_id, chr, pos, strand, probe_type, gene_symbol, is_sex_chr,
       has_cpg_snp, has_sbe_snp, has_probe_snp, reactive, false FROM ({VIEW})""")
def harmonized_annotation(fx: Fixtures) -> DataFrame:
    raw, listed = _array_table(fx), _reactive(fx)
    snps = {"has_cpg_snp": "CpG_rs", "has_sbe_snp": "SBE_rs", "has_probe_snp": "Probe_rs"}
    settings = zip(PLATFORMS, ({}, dict(snp_columns=snps, cross_reactive=listed, multi_mapped=listed), dict(snp_columns=snps, cross_reactive=listed)))
    tables = [an.platform_annotation(raw, p, "GRCh37", "Symbol", sex_chromosomes=SEX, **extra) for p, extra in settings]
    return an.harmonize(tables).drop("reference_genome")


LIFTED = """
SELECT p.probe_id, c.to_chr AS chr, CASE WHEN c.to_strand = '-' THEN c.to_start + (c."end" - p.pos) ELSE c.to_start + (p.pos - c."start") END AS pos,
       CASE WHEN c.to_strand = '-' THEN CASE p.strand WHEN '+' THEN '-' ELSE '+' END ELSE p.strand END AS strand
FROM fx_positions p JOIN fx_chain c ON p.chr = c.chr AND p.pos BETWEEN c."start" AND c."end\""""


@query("H6", LIFTED)
def lifted_positions(fx: Fixtures) -> DataFrame:
    return iv.liftover(fx.positions, fx.chain)


# Blocks of the written chain file, by running sums over the lines of each stanza.
BLOCKS = """
SELECT chr, t + 1 AS "start", t + size AS "end", to_chr, CASE WHEN strand = '-' THEN 800000000 - q - size + 1 ELSE q + 1 END AS to_start, strand AS to_strand
FROM (SELECT 'chr' || (o_custkey % 5) AS chr, 'chr' || (o_custkey % 7) AS to_chr, CASE WHEN l_orderkey % 3 = 0 THEN '-' ELSE '+' END AS strand, size,
             l_orderkey * 10 + coalesce(sum(size + l_partkey % 50) OVER w, 0) AS t, l_orderkey * 10 + 7 + coalesce(sum(size + l_suppkey % 50) OVER w, 0) AS q
      FROM (SELECT *, CAST(l_quantity AS BIGINT) AS size FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
      WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


@query("H6", f"SELECT chr, CAST(\"start\" AS BIGINT) AS \"start\", CAST(\"end\" AS BIGINT) AS \"end\", to_chr, CAST(to_start AS BIGINT) AS to_start, to_strand FROM ({BLOCKS})")
def chain_file_blocks(fx: Fixtures) -> DataFrame:
    return read_chain(fx.spark, fx.chain_file)


@query("H6", f"""
SELECT p.probe_id, c.to_chr AS chr, CAST(CASE WHEN c.to_strand = '-' THEN c.to_start + (c."end" - p.pos) ELSE c.to_start + (p.pos - c."start") END AS BIGINT) AS pos,
       CASE WHEN c.to_strand = '-' THEN CASE p.strand WHEN '+' THEN '-' ELSE '+' END ELSE p.strand END AS strand
FROM fx_positions p JOIN ({BLOCKS}) c ON p.chr = c.chr AND p.pos BETWEEN c."start" AND c."end\"""")
def lifted_by_chain_file(fx: Fixtures) -> DataFrame:
    return iv.liftover(fx.positions, read_chain(fx.spark, fx.chain_file))


@query("F9 H5", """
SELECT p.probe_id, string_agg(DISTINCT gene_symbol, ';' ORDER BY gene_symbol) AS gene_symbol, coalesce(bool_or(region = 'TSS200'), false) AS TSS200,
       coalesce(bool_or(region = 'TSS1500'), false) AS TSS1500, coalesce(bool_or(region = 'gene_body'), false) AS gene_body
FROM fx_places p LEFT JOIN fx_hits_of_genes USING (probe_id) GROUP BY p.probe_id""")
def gene_regions(fx: Fixtures) -> DataFrame:
    return region_flags(fx.annotated_positions, fx.genes)


@query("F9 F10", """
SELECT project_id, sample_id, gene_symbol, round(avg(value), 6) AS value
FROM fx_m JOIN (SELECT DISTINCT h.probe_id, h.gene_symbol FROM fx_hits_of_genes h
                WHERE h.probe_id IN (SELECT probe_id FROM fx_hits_of_genes WHERE region IN ('TSS200', 'TSS1500'))) USING (probe_id)
GROUP BY project_id, sample_id, gene_symbol""")
def gene_matrix_by_position(fx: Fixtures) -> DataFrame:
    """Gene means from positions: region flags, then the probe to gene map, then the roll-up."""
    annotation = with_regions(fx.annotated_positions, fx.genes)
    genes = co.gene_map(annotation, ("TSS200", "TSS1500"))
    return rounded(co.gene_aggregation(fx.mvals, genes), "value")


@query("H7", f"SELECT * FROM ({LIFTED}) QUALIFY count(*) OVER (PARTITION BY probe_id) = 1")
def uniquely_mapped(fx: Fixtures) -> DataFrame:
    return iv.uniquely_mapped(iv.liftover(fx.positions, fx.chain))


@query("H8", f"""
SELECT p.probe_id, p.chr AS hg19_chr, p.pos AS hg19_pos, p.strand AS hg19_strand, u.chr AS hg38_chr, u.pos AS hg38_pos, u.strand AS hg38_strand
FROM fx_positions p JOIN (SELECT * FROM ({LIFTED}) QUALIFY count(*) OVER (PARTITION BY probe_id) = 1) u USING (probe_id)""")
def lifted_annotation(fx: Fixtures) -> DataFrame:
    return iv.liftover_annotation(fx.positions, fx.chain)


@query("H9", """
SELECT chr, "start" - 2000 AS "start", "start" + 1999 AS "end" FROM fx_islands""")
def flanks(fx: Fixtures) -> DataFrame:
    return iv.flank(fx.islands, 2_000)


@query("H9", """
SELECT chr, "start" - 2000 AS "start", "start" + 1999 AS "end" FROM fx_islands
UNION ALL SELECT chr, "end" - 1999, "end" + 2000 FROM fx_islands""")
def flanks_both_ends(fx: Fixtures) -> DataFrame:
    return iv.flank(fx.islands, 2_000, both_ends=True)


# Positions covered by A and not by B, as maximal runs of the elementary segments between all ends.
def _minus(a: str, b: str) -> str:
    return f"""
SELECT chr, min(lo) AS "start", max(hi) AS "end" FROM (
  SELECT chr, lo, hi, sum(fresh) OVER (PARTITION BY chr ORDER BY lo) AS run FROM (
    SELECT chr, lo, hi, CASE WHEN lag(hi) OVER (PARTITION BY chr ORDER BY lo) = lo - 1 THEN 0 ELSE 1 END AS fresh FROM (
      SELECT chr, pos AS lo, lead(pos) OVER (PARTITION BY chr ORDER BY pos) - 1 AS hi,
             sum(a) OVER (PARTITION BY chr ORDER BY pos) AS in_a, sum(b) OVER (PARTITION BY chr ORDER BY pos) AS in_b
      FROM (SELECT chr, pos, sum(a) AS a, sum(b) AS b FROM (
              SELECT chr, "start" AS pos, 1 AS a, 0 AS b FROM {a} UNION ALL SELECT chr, "end" + 1, -1, 0 FROM {a}
              UNION ALL SELECT chr, "start", 0, 1 FROM {b} UNION ALL SELECT chr, "end" + 1, 0, -1 FROM {b}) GROUP BY chr, pos))
    WHERE in_a > 0 AND in_b = 0)) GROUP BY chr, run"""


NEAR = '(SELECT chr, "start" - 2000 AS "start", "start" + 1999 AS "end" FROM fx_islands)'
WIDE = '(SELECT chr, "start" - 4000 AS "start", "start" + 3999 AS "end" FROM fx_islands)'
SHORES = f"({_minus(NEAR, 'fx_islands')})"
TAKEN = f'(SELECT chr, "start", "end" FROM fx_islands UNION ALL SELECT chr, "start", "end" FROM {SHORES})'
SHELVES = f"({_minus(WIDE, TAKEN)})"


@query("H10", f"SELECT 'shore' AS kind, * FROM {SHORES} UNION ALL SELECT 'shelf', * FROM {SHELVES}")
def shores_and_shelves(fx: Fixtures) -> DataFrame:
    shores, shelves = iv.shores_and_shelves(fx.islands)
    return shores.withColumn("kind", F.lit("shore")).unionByName(shelves.withColumn("kind", F.lit("shelf")))


@query("H11", f"""
SELECT p.probe_id, CASE max(CASE kind WHEN 'Shelf' THEN 3 WHEN 'Shore' THEN 2 WHEN 'Island' THEN 1 ELSE 0 END)
         WHEN 3 THEN 'Shelf' WHEN 2 THEN 'Shore' WHEN 1 THEN 'Island' ELSE 'OpenSea' END AS context
FROM fx_positions p LEFT JOIN (
  SELECT 'Island' AS kind, chr, "start", "end" FROM fx_islands
  UNION ALL SELECT 'Shore', chr, "start", "end" FROM {SHORES}
  UNION ALL SELECT 'Shelf', chr, "start", "end" FROM {SHELVES}) k
ON p.chr = k.chr AND p.pos BETWEEN k."start" AND k."end" GROUP BY p.probe_id""")
def island_context(fx: Fixtures) -> DataFrame:
    return iv.island_context(fx.positions, fx.islands)
