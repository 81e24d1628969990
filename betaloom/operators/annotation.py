"""Building one probe annotation table from the arrays' own tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from betaloom.operators.regions import with_regions
from betaloom.settings import GENE_REGIONS

# fixed value: sex chromosomes in UCSC naming
SEX_CHROMOSOMES = ("chrX", "chrY")

SNP_FLAGS = ("has_cpg_snp", "has_sbe_snp", "has_probe_snp")


def sex_chromosome_flag(chromosome: Column, names: tuple[str, ...] = SEX_CHROMOSOMES) -> Column:
    return F.coalesce(chromosome.isin(*names), F.lit(False))


def snp_flags(**rs_columns: str) -> dict[str, Column]:
    """A flag is set where the array lists an rs id."""
    return {flag: F.col(column).isNotNull() for flag, column in rs_columns.items()}


def constant_flags(*names: str) -> dict[str, Column]:
    """Flags of arrays without a curated list."""
    return {name: F.lit(False) for name in names}


def flag_members(df: DataFrame, listed: DataFrame, flag: str) -> DataFrame:
    """Set ``flag`` for probes on a curated list, which may repeat ids."""
    marks = listed.select("probe_id").distinct().withColumn(flag, F.lit(True))
    return df.join(marks, "probe_id", "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def platform_annotation(
    raw: DataFrame,
    platform: str,
    reference_genome: str,
    gene_column: str,
    snp_columns: dict[str, str] | None = None,
    cross_reactive: DataFrame | None = None,
    multi_mapped: DataFrame | None = None,
    sex_chromosomes: tuple[str, ...] = SEX_CHROMOSOMES,
    type_column: str = "Type",
    genes: DataFrame | None = None,
) -> DataFrame:
    """One array's table in the shared layout.

    With ``genes`` (gene_symbol, chr, start, end, strand) the gene symbols and region flags follow from the probes'
    positions; without, symbols come from ``gene_column`` and region flags are kept if the table has them.
    """
    flags = snp_flags(**snp_columns) if snp_columns else constant_flags(*SNP_FLAGS)
    flags["is_sex_chr"] = sex_chromosome_flag(F.col("chr"), sex_chromosomes)
    named = raw.withColumns(flags).withColumns(
        {"gene_symbol": F.col(gene_column), "probe_type": F.col(type_column), "platform": F.lit(platform), "reference_genome": F.lit(reference_genome)}
    )
    for flag, listed in (("is_cross_reactive", cross_reactive), ("is_multi_mapped", multi_mapped)):
        named = named.withColumn(flag, F.lit(False)) if listed is None else flag_members(named, listed, flag)
    if genes is not None:
        named = with_regions(named, genes)
    return named.select(
        "platform", "reference_genome", "probe_id", "chr", "pos", "strand", "probe_type", "gene_symbol",
        "is_sex_chr", *SNP_FLAGS, "is_cross_reactive", "is_multi_mapped", *[r for r in GENE_REGIONS if r in named.columns],
    )


def harmonize(tables: list[DataFrame]) -> DataFrame:
    """All arrays' tables in one; a region flag that only some have is false for the others."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return stacked.withColumns({r: F.coalesce(r, F.lit(False)) for r in GENE_REGIONS if r in stacked.columns})
