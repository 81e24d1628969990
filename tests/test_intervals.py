import numpy as np
import pandas as pd
import pytest

from betaloom.operators import annotation as an
from betaloom.operators import intervals as iv
from pyspark.sql import functions as F


def covered(frame):
    return {(r.chr, p) for r in frame.itertuples() for p in range(r.start, r.end + 1)}


@pytest.fixture
def intervals(spark):
    def build(seed, n=60, span=2500):
        rng = np.random.default_rng(seed)
        start = rng.integers(-50, span, n)
        frame = pd.DataFrame({"chr": rng.choice(["c1", "c1", "c2"], n), "start": start, "end": start + rng.integers(0, 60, n)})
        return frame, spark.createDataFrame(frame)

    return build


@pytest.mark.parametrize("seed", [1, 2])
def test_difference_equals_position_sets(intervals, seed, monkeypatch):
    monkeypatch.setattr(iv, "SWEEP_BIN", 100)
    (fa, a), (fb, b) = intervals(seed), intervals(seed + 10, 30)
    for frame, want in ((iv.difference(a, b), covered(fa) - covered(fb)), (iv.difference(a), covered(fa))):
        got = frame.toPandas()
        assert covered(got) == want
        assert sum(got["end"] - got["start"] + 1) == len(want), "pieces do not overlap"
        for _, g in got.sort_values("start").groupby("chr"):
            assert (g["start"].to_numpy()[1:] > g["end"].to_numpy()[:-1] + 1).all(), "pieces are maximal"


def test_containing_equals_all_pairs(intervals, spark):
    frame, df = intervals(7, 80)
    rng = np.random.default_rng(8)
    points = pd.DataFrame({"probe_id": [f"p{i}" for i in range(200)], "chr": rng.choice(["c1", "c2"], 200), "pos": rng.integers(0, 2600, 200)})
    got = iv.containing(spark.createDataFrame(points), df, bin_width=37, salts=3).select("probe_id", "start", "end").toPandas()
    pairs = points.merge(frame, on="chr")
    want = pairs[(pairs.pos >= pairs.start) & (pairs.pos <= pairs.end)][["probe_id", "start", "end"]]
    assert sorted(map(tuple, got.to_numpy())) == sorted(map(tuple, want.to_numpy()))


def test_liftover_reverse_and_double_mapping(rows):
    chain = rows(
        [("c1", 100, 199, "c1", 1100, "+"), ("c1", 300, 399, "c2", 500, "-"), ("c1", 150, 160, "c9", 1, "+")],
        "chr string, start long, end long, to_chr string, to_start long, to_strand string",
    )
    points = rows([("a", "c1", 100, "+"), ("b", "c1", 310, "-"), ("two", "c1", 155, "+"), ("gap", "c1", 250, "+"), ("x", "c7", 100, "+")], "probe_id string, chr string, pos long, strand string")
    lifted = iv.liftover(points, chain)
    assert {tuple(r) for r in lifted.collect()} == {("a", "c1", 1100, "+"), ("b", "c2", 589, "+"), ("two", "c1", 1155, "+"), ("two", "c9", 6, "+")}
    assert {r.probe_id for r in iv.uniquely_mapped(lifted).collect()} == {"a", "b"}
    notes = points.withColumn("is_sex_chr", F.col("chr") == "c7")
    got = {r.probe_id: r for r in iv.liftover_annotation(notes, chain).collect()}
    assert set(got) == {"a", "b"} and got["b"].hg19_pos == 310 and got["b"].hg38_pos == 589 and not got["b"].is_sex_chr


def test_flanks_straddle_the_start(rows):
    df = rows([("c", 5000, 6000)], "chr string, start long, end long")
    assert [tuple(r) for r in iv.flank(df, 10).collect()] == [("c", 4990, 5009)]
    assert [tuple(r) for r in iv.flank(df, 10, both_ends=True).collect()] == [("c", 4990, 5009), ("c", 5991, 6010)]


def test_island_context(rows):
    islands = rows([("c", 10000, 10500), ("c", 10400, 10600)], "chr string, start long, end long")
    points = rows([("in", "c", 10450), ("shore", "c", 9000), ("shelf", "c", 7000), ("sea", "c", 99999), ("other", "d", 10450)], "probe_id string, chr string, pos long")
    got = {r.probe_id: r.context for r in iv.island_context(points, islands).collect()}
    assert got == {"in": "Island", "shore": "Shore", "shelf": "Shelf", "sea": "OpenSea", "other": "OpenSea"}


def test_platform_tables_share_one_layout(rows):
    raw = rows([("cg1", "chrX", 5, "+", "I", "G", "rs1", None, None), ("cg2", None, 6, "-", "II", None, None, None, "rs2")],
               "probe_id string, chr string, pos int, strand string, Type string, Gene string, CpG_rs string, SBE_rs string, Probe_rs string")
    listed = rows([("cg2",), ("cg2",)], "probe_id string")
    full = an.platform_annotation(raw, "E", "GRCh37", "Gene", dict(has_cpg_snp="CpG_rs", has_sbe_snp="SBE_rs", has_probe_snp="Probe_rs"), cross_reactive=listed)
    bare = an.platform_annotation(raw, "K", "GRCh37", "Gene")
    got = {(r.platform, r.probe_id): r for r in an.harmonize([full, bare]).collect()}
    assert len(got) == 4
    assert got["E", "cg1"].is_sex_chr and got["E", "cg1"].has_cpg_snp and not got["E", "cg1"].is_cross_reactive
    assert got["E", "cg2"].is_sex_chr is False and got["E", "cg2"].has_probe_snp and got["E", "cg2"].is_cross_reactive
    assert not got["K", "cg1"].has_cpg_snp and not got["K", "cg2"].is_multi_mapped
