"""Chain files and gene regions against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from betaloom.operators import cohort as co
from betaloom.operators import intervals as iv
from betaloom.operators import regions
from betaloom.sources.chain import read_chain

CHAIN = """# a comment
chain 100 chr1 1000 + 10 40 chr2 500 + 100 130 1
10 3 0
5	2	5
10

chain 90 chr1 1000 + 100 125 chr3 300 - 20 50 2\r
20 0 5\r
5\r
\r
chain 80 chr9 50 + 0 50 chr9 50 + 0 50 3
50
"""


def mapped(chain):
    """Every position of every block, base by base: {(chr, pos): (to_chr, to_pos, strand)}."""
    out = {}
    for stanza in chain.replace("\r", "").split("\n\n"):
        lines = [x for x in stanza.strip().split("\n") if not x.startswith("#")]
        _, _, t, _, _, t_at, _, q, q_size, strand, q_at, *_ = lines[0].split()
        t_at, q_at = int(t_at), int(q_at)
        for line in lines[1:]:
            size, *gaps = map(int, line.split())
            for i in range(size):
                at = q_at + i
                out[t, t_at + i + 1] = (q, at + 1 if strand == "+" else int(q_size) - at, strand)
            dt, dq = gaps or (0, 0)
            t_at, q_at = t_at + size + dt, q_at + size + dq
    return out


def write(tmp_path, text):
    (tmp_path / "a.chain").write_bytes(text.encode())
    return str(tmp_path / "a.chain")


def test_chain_file_maps_every_base(spark, rows, tmp_path):
    chain = read_chain(spark, write(tmp_path, CHAIN))
    assert chain.count() == 6
    want = mapped(CHAIN)
    points = rows([(f"{c}:{p}", c, p, "+") for c in ("chr1", "chr9") for p in range(0, 160)], "probe_id string, chr string, pos long, strand string")
    got = {tuple(r.probe_id.split(":")): (r.chr, r.pos, r.strand) for r in iv.liftover(points, chain).collect()}
    assert got == {(c, str(p)): v for (c, p), v in want.items()}


def test_chain_folder_of_files(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.chain").write_text(CHAIN.replace("chr", f"c{i}_"))
    (tmp_path / "empty.chain").write_text("\n\n# nothing\n")
    chain = read_chain(spark, str(tmp_path))
    assert chain.count() == 18 and chain.select("chr").distinct().count() == 6


@pytest.mark.parametrize(
    "broken",
    [
        "chain 1 chr1 100 + 0 10 chr2 100 + 0 10 1\n",
        "chain 1 chr1 100 + 0 10 chr2 100 + 0 10 1\n5 1\n4\n",
        "chain 1 chr1 100 + 0 10 chr2 100 + 0 10 1\n5 0 0\n4\n",
        "chain 1 chr1 100 + 0 10 chr2 100 + 0 10 1\n5 0 0\n",
        "chain 1 chr1 100 - 0 10 chr2 100 + 0 10 1\n10\n",
        "chain 1 chr1 100 + 0 x chr2 100 + 0 10 1\n10\n",
        "chain 1 chr1 100 + 0 10 chr2 100 ? 0 10 1\n10\n",
        "chian 1 chr1 100 + 0 10 chr2 100 + 0 10 1\n10\n",
        "chain 1 chr1 100 + 0 10\n10\n",
        "chain 1 chr1 100 + 0 10 chr2 100 + 0 10 1\n-10\n",
    ],
)
def test_malformed_stanza_fails(spark, tmp_path, broken):
    for text in (broken, CHAIN + "\n" + broken):
        with pytest.raises(Exception, match="malformed chain stanza: ch"):
            read_chain(spark, write(tmp_path, text)).collect()


def test_regions_of_every_probe(rows):
    rng = np.random.default_rng(2)
    genes = [(f"G{i}", f"chr{i % 3}", int(s), int(s + rng.integers(0, 3000)), "+-"[i % 2]) for i, s in enumerate(rng.integers(1, 40_000, 60))]
    genes += [("G0", "chr0", 5, 4, "+"), ("N", None, 1, 2, "+"), ("odd", "chr0", 30_000, 30_010, None)]
    points = [(f"cg{i}", f"chr{i % 3}", int(p)) for i, p in enumerate(rng.integers(1, 45_000, 300))] + [("lost", None, None)]
    table = rows(genes, "gene_symbol string, chr string, start int, end int, strand string")
    got = {r.probe_id: r for r in regions.region_flags(rows(points, "probe_id string, chr string, pos int"), table).collect()}
    assert set(got) == {p for p, *_ in points}
    hit = 0
    for probe, c, pos in points:
        found = {"TSS200": set(), "TSS1500": set(), "gene_body": set()}
        for g, gc, start, end, strand in genes:
            if gc is None or gc != c or end < start:
                continue
            up = pos - end if strand == "-" else start - pos
            if start <= pos <= end:
                found["gene_body"].add(g)
            if 1 <= up <= 200:
                found["TSS200"].add(g)
            if 201 <= up <= 1500:
                found["TSS1500"].add(g)
        names = set().union(*found.values())
        hit += bool(names)
        assert got[probe].gene_symbol == (";".join(sorted(names)) if names else None)
        assert all(got[probe][r] == bool(g) for r, g in found.items())
    assert hit > 100


def test_regions_reach_the_gene_map(rows):
    notes = rows([("cg1", "chr1", 900, "old", True), ("cg2", "chr1", 1200, "old", True), ("cg3", "chr2", 1, "old", True)], "probe_id string, chr string, pos int, gene_symbol string, TSS200 boolean")
    genes = rows([("A", "chr1", 1000, 2000, "+"), ("B", "chr1", 500, 1100, "-")], "gene_symbol string, chr string, start int, end int, strand string")
    full = regions.with_regions(notes, genes)
    got = {(r.probe_id, r.gene_symbol) for r in co.gene_map(full, ("TSS200", "TSS1500")).collect()}
    assert got == {("cg1", "A"), ("cg1", "B"), ("cg2", "A"), ("cg2", "B")}
    assert full.where(F.col("probe_id") == "cg3").first().gene_symbol is None


def test_harmonized_annotation_keeps_regions(rows):
    from betaloom.operators import annotation as an

    raw = rows([("cg1", "chr1", 900, "+", "A", "I")], "probe_id string, chr string, pos int, strand string, Symbol string, Type string")
    genes = rows([("B", "chr1", 1000, 2000, "+")], "gene_symbol string, chr string, start int, end int, strand string")
    tables = [an.platform_annotation(raw, "x", "g", "Symbol", genes=genes), an.platform_annotation(raw, "y", "g", "Symbol")]
    got = {r.platform: r for r in an.harmonize(tables).collect()}
    assert (got["x"].TSS200, got["x"].TSS1500, got["x"].gene_symbol) == (True, False, "B")
    assert (got["y"].TSS200, got["y"].gene_body, got["y"].gene_symbol) == (False, False, "A")
    assert an.harmonize(tables[1:]).columns == tables[1].columns


def test_overlapping_genes_are_looked_up_once(rows):
    schema = "gene_symbol string, chr string, start int, end int, strand string"
    genes = [(f"G{i % 3}" if i % 50 else None, "chr1", 10_000 + i, 12_000 + i, "+-"[i // 200]) for i in range(400)]
    points = [(f"cg{p}", "chr1", p) for p in range(8_000, 15_000, 37)] + [("two", "chr1", 11_000), ("two", "chr1", 9_990), ("two", None, 3)]
    table = rows(genes, schema)
    merged = regions.merged_windows(table).collect()
    assert len(merged) < 40
    got = {r.probe_id: r for r in regions.region_flags(rows(points, "probe_id string, chr string, pos int"), table).collect()}
    want = {}
    for probe, c, pos in points:
        names, flags = want.setdefault(probe, (set(), set()))
        for g, gc, start, end, strand in genes:
            up = pos - end if strand == "-" else start - pos
            kind = "gene_body" if start <= pos <= end else "TSS200" if 1 <= up <= 200 else "TSS1500" if 201 <= up <= 1500 else None
            if gc == c and kind:
                flags.add(kind)
                names.update([g] if g else [])
    assert set(got) == set(want)
    for probe, (names, flags) in want.items():
        assert (got[probe].gene_symbol or "") == ";".join(sorted(names))
        assert {r for r in ("TSS200", "TSS1500", "gene_body") if got[probe][r]} == flags


def test_symbols_are_listed_after_the_shuffle(rows):
    notes = rows([("cg1", "A;B;A", True), ("cg1", "B", True), ("cg2", "", True), ("cg3", None, True)], "probe_id string, gene_symbol string, TSS200 boolean")
    genes = co.gene_map(notes, ("TSS200",))
    plan = genes._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Exchange") and plan.count("Exchange") == 1
    assert {tuple(r) for r in genes.collect()} == {("cg1", "A", 2), ("cg1", "B", 2), ("cg2", "", 1)}


def test_chain_is_read_without_a_shuffle(spark, tmp_path):
    chain = read_chain(spark, write(tmp_path, CHAIN))
    assert "Exchange" not in chain._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in chain.orderBy("chr", "start").collect()][:2] == [("chr1", 11, 20, "chr2", 101, "+"), ("chr1", 24, 28, "chr2", 111, "+")]
