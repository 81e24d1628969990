"""Which genes a probe lies in or upstream of."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from betaloom.operators.intervals import containing, difference, segment_starts
from betaloom.settings import GENE_REGIONS
from betaloom.tables import materialize

# Distances upstream of a transcription start that the two promoter regions end at.
NEAR, FAR = 200, 1500


def region_windows(genes: DataFrame) -> DataFrame:
    """(chr, start, end, region, gene_symbol) of genes ``(gene_symbol, chr, start, end, strand)``, 1-based and closed.

    A gene on ``-`` starts at its upper end and upstream is above it; any other strand counts as ``+``. ``TSS200`` are the
    200 positions upstream of the start, ``TSS1500`` the 1,300 above those, ``gene_body`` the gene itself.
    """
    start, end, reverse = F.col("start").cast("long"), F.col("end").cast("long"), F.coalesce(F.col("strand") == "-", F.lit(False))

    def window(region: str, low, high):
        return F.struct(low.alias("start"), high.alias("end"), F.lit(region).alias("region"))

    def upstream(region: str, nearest: int, farthest: int):
        low = F.when(reverse, end + nearest).otherwise(start - farthest)
        return window(region, low, low + (farthest - nearest))

    near, far, body = GENE_REGIONS
    windows = F.array(upstream(near, 1, NEAR), upstream(far, NEAR + 1, FAR), window(body, start, end))
    return genes.where("chr IS NOT NULL AND start <= end").select("chr", F.inline(windows), "gene_symbol")


def merged_windows(genes: DataFrame) -> DataFrame:
    """The windows of all genes of a symbol as intervals without overlap, for each region."""
    return difference(region_windows(genes), keys=("chr", "gene_symbol", "region"))


def region_hits(points: DataFrame, genes: DataFrame) -> DataFrame:
    """(probe_id, gene_symbol, region): each gene region that holds a probe's position, once."""
    places = points.select("probe_id", "chr", "pos")
    return containing(places, merged_windows(genes)).select("probe_id", "gene_symbol", "region").distinct()


def region_flags(points: DataFrame, genes: DataFrame) -> DataFrame:
    """A flag per region and the symbols of all genes found, in order and joined by ``;``, for every probe.

    A probe without a gene has no symbol. Genes are looked up once for all probes between the same window ends: windows of a symbol are
    merged first, so the pairs joined are those of a symbol and a region, however many genes overlap there.
    """
    windows = materialize(merged_windows(genes), "gene-windows")
    placed = points.select("probe_id", "chr", F.col("pos").cast("long").alias("pos"))
    placed = placed.join(segment_starts(placed, windows), ["chr", "pos"], "left")
    found_at = F.when(F.col("segment").isNotNull(), F.struct("chr", F.col("segment").alias("pos")))
    spots = materialize(placed.groupBy("probe_id").agg(F.array_sort(F.collect_set(found_at)).alias("spots")), "probe-spots")
    looked_up = spots.select("spots").distinct().select(F.col("spots").alias("probe_id"), F.inline("spots"))
    flags = [F.bool_or(F.col("region") == r).alias(r) for r in GENE_REGIONS]
    symbols = F.array_join(F.array_sort(F.collect_set("gene_symbol")), ";").alias("gene_symbol")
    found = containing(looked_up, windows).groupBy(F.col("probe_id").alias("spots")).agg(symbols, *flags)
    every = spots.join(found, "spots", "left")
    return every.select("probe_id", "gene_symbol", *[F.coalesce(r, F.lit(False)).alias(r) for r in GENE_REGIONS])


def with_regions(annotation: DataFrame, genes: DataFrame) -> DataFrame:
    """An annotation with the region flags and gene symbols of its own positions in place of any it had."""
    bare = annotation.drop("gene_symbol", *GENE_REGIONS)
    return bare.join(region_flags(annotation, genes), "probe_id")
