"""The fixtures of ``fixtures.py`` in SQL, as named views a check query is prefixed with."""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    "fx_cells": """
SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS dim
FROM embeddings""",
    "fx_beta": """
SELECT 'PRJ-' || label AS project_id, vec_id AS sample_id,
       (CASE WHEN dim % 16 = 15 THEN 'ch.' ELSE 'cg' END)
         || lpad(CAST(dim + CASE WHEN label = 4 AND dim % 16 = 2 THEN 1000 ELSE 0 END AS VARCHAR), 8, '0') AS probe_id,
       CASE WHEN vec_id % 41 = 0 AND dim % 3 = 0 THEN NULL
            WHEN dim % 16 = 5 AND vec_id % 7 = 0 THEN NULL
            WHEN dim % 16 = 9 AND vec_id % 83 = 1 THEN NULL
            WHEN dim % 16 = 7 THEN CAST(0.995 AS DOUBLE) + v * CAST(0.001 AS DOUBLE)
            WHEN dim % 16 = 11 THEN CAST(0.5 AS DOUBLE) + v * CAST(0.01 AS DOUBLE)
            WHEN vec_id % 97 = 3 THEN CAST(0.57 AS DOUBLE) + v * CAST(0.8 AS DOUBLE)
            ELSE CAST(0.5 AS DOUBLE) + v * CAST(0.8 AS DOUBLE) END AS value
FROM fx_cells""",
    "fx_designs": """
SELECT 'PRJ-' || label AS project_id,
       (CASE WHEN dim % 16 = 15 THEN 'ch.' ELSE 'cg' END) || lpad(CAST(unnest(CASE WHEN dim % 16 = 2 THEN [dim, dim + 1000] ELSE [dim] END) AS VARCHAR), 8, '0') AS probe_id
FROM (SELECT DISTINCT label, dim FROM fx_cells)""",
    "fx_m": """
SELECT project_id, sample_id, probe_id,
       CASE WHEN value IS NULL THEN NULL
            ELSE log2(least(greatest(value, 0.001), 0.999) / (1 - least(greatest(value, 0.001), 0.999))) END AS value
FROM fx_beta""",
    "fx_samples": """
SELECT vec_id AS sample_id, 'PRJ-' || label AS project_id, 'CASE-' || (vec_id // 2) AS submitter_id,
       'AL-' || vec_id AS aliquot_id, 'f' || lpad(CAST(vec_id AS VARCHAR), 9, '0') || '.txt' AS file_name,
       CASE WHEN vec_id % 50 = 9 THEN 'TC-1-2'
            WHEN vec_id = 17 THEN 'TC-' || label || '-17-02A-11D-9999-05'
            ELSE 'TC-' || label || '-' || vec_id || '-0' || (vec_id % 3 + 1) || 'A-11D-000' || (vec_id % 5) || '-05' END AS barcode
FROM embeddings""",
    "fx_batched": """
SELECT *, CASE WHEN len(string_split(barcode, '-')) >= 6
               THEN string_split(barcode, '-')[4] || '-' || string_split(barcode, '-')[6] END AS batch_id
FROM fx_samples""",
    "fx_annotation": """
SELECT (CASE WHEN number % 16 = 15 THEN 'ch.' ELSE 'cg' END) || lpad(CAST(number AS VARCHAR), 8, '0') AS probe_id,
       CASE WHEN p_partkey % 9 = 0 THEN NULL
            WHEN p_partkey % 4 = 1 THEN p_brand || ';' || p_brand
            WHEN p_partkey % 4 = 2 THEN p_brand || ';G' || (p_size % 7)
            ELSE p_brand END AS gene_symbol,
       p_size % 13 = 0 AS is_sex_chr, p_size % 17 = 0 AS has_cpg_snp, p_size % 19 = 0 AS has_sbe_snp,
       p_size % 23 = 0 AS has_probe_snp, p_partkey % 29 = 3 AS is_cross_reactive, p_partkey % 31 = 4 AS is_multi_mapped,
       p_size % 3 = 0 AS TSS200, p_size % 3 = 1 AS TSS1500, p_size % 2 = 0 AS gene_body
FROM (SELECT *, p_partkey + CASE WHEN p_partkey >= 60 THEN 4 ELSE 0 END AS number FROM part)""",
    "fx_projects": """
SELECT DISTINCT 'PRJ-' || label AS project_id, label AS ordinal,
       CASE label % 3 WHEN 0 THEN 'Illumina Human Methylation 450' WHEN 1 THEN 'Illumina Methylation Epic'
                      ELSE 'Illumina Human Methylation 27' END AS platform
FROM embeddings""",
    "fx_manifest": """
SELECT 'F-' || doc_id AS file_id, source || '/' || doc_id || '.txt' AS file_name FROM documents""",
    "fx_status": """
SELECT 'F-' || doc_id AS file_id, CASE quality WHEN 1 THEN 'success' ELSE 'failed' END AS status, toxic + 1 AS attempts
FROM labels""",
    "fx_hits": """
SELECT doc_id, 'F-' || doc_id AS file_id, source || '/' || doc_id || '.txt' AS file_name, lang AS platform,
       CASE WHEN doc_id % 13 = 0 THEN 'controlled' ELSE 'open' END AS access,
       doc_id % 11 > 1 AS has_cases, doc_id % 7 <> 0 AS has_samples, doc_id % 5 <> 0 AS has_portions,
       source, 'S-' || (doc_id // 2) AS submitter,
       CASE WHEN n_chars % 2 = 0 THEN 'Primary Tumor' ELSE 'Solid Tissue Normal' END AS first_type
FROM documents""",
    "fx_metadata": """
SELECT file_id, file_name, platform,
       CASE WHEN has_cases THEN source END AS project_id,
       CASE WHEN has_cases THEN submitter END AS submitter_id,
       CASE WHEN has_cases AND has_samples THEN first_type END AS sample_type,
       CASE WHEN has_cases AND has_samples AND has_portions THEN 'AL-' || doc_id END AS aliquot_id
FROM fx_hits""",
    "fx_aliquots": """
SELECT 'C-' || o_custkey AS case_id, 'A-' || l_orderkey || '-' || l_linenumber AS aliquot_id,
       CASE WHEN l_linenumber % 3 = 0 THEN 'P-' || o_orderkey ELSE 'B-' || l_orderkey || '-' || l_suppkey END AS barcode
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
UNION ALL
SELECT 'C-' || o_custkey, 'X-' || l_orderkey || '-' || l_partkey, 'P-' || o_orderkey
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "fx_positions": """
SELECT p_partkey AS probe_id, 'chr' || (p_partkey % 5) AS chr, (p_partkey * 7919) % 200000 + 1 AS pos,
       CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand FROM part""",
    "fx_genes": """
SELECT 'G' || (p.probe_id % 97) AS gene_symbol, chr, pos + p_size * 40 AS "start", pos + p_size * 40 + 500 + p_size * 10 AS "end",
       CASE WHEN p.probe_id % 5 < 3 THEN '+' ELSE '-' END AS strand FROM fx_positions p JOIN part q ON q.p_partkey = p.probe_id""",
    "fx_places": """
SELECT (CASE WHEN number % 16 = 15 THEN 'ch.' ELSE 'cg' END) || lpad(CAST(number AS VARCHAR), 8, '0') AS probe_id, chr, pos
FROM (SELECT *, probe_id + CASE WHEN probe_id >= 60 THEN 4 ELSE 0 END AS number FROM fx_positions)""",
    "fx_hits_of_genes": """
SELECT DISTINCT probe_id, gene_symbol, CASE WHEN up BETWEEN 1 AND 200 THEN 'TSS200' WHEN up BETWEEN 201 AND 1500 THEN 'TSS1500' ELSE 'gene_body' END AS region
FROM (SELECT probe_id, gene_symbol, CASE WHEN pos BETWEEN "start" AND "end" THEN 0 WHEN strand = '-' THEN pos - "end" ELSE "start" - pos END AS up
      FROM fx_places JOIN fx_genes USING (chr)) WHERE up BETWEEN 0 AND 1500""",
    "fx_attempts": """
SELECT doc_id, attempt, unnest(CASE WHEN (doc_id + attempt) % 2 = 0 THEN ['failed', 'success'] ELSE ['success'] END) AS status
FROM (SELECT doc_id, unnest(list_filter([1, CASE WHEN doc_id % 3 <> 0 THEN 2 END, CASE WHEN doc_id % 21 = 7 THEN 3 END], lambda x: x IS NOT NULL)) AS attempt
      FROM documents WHERE doc_id % 17 <> 5)""",
    "fx_islands": """
SELECT 'chr' || (s_suppkey % 5) AS chr, 10000 * (s_suppkey // 5) + s_nationkey * 37 + 1 AS "start",
       10000 * (s_suppkey // 5) + s_nationkey * 57 + 501 AS "end" FROM supplier""",
    "fx_chain": """
SELECT 'chr' || (n_nationkey % 5) AS chr, 40000 * (n_nationkey // 5) + 1 AS "start", 40000 * (n_nationkey // 5) + 39000 AS "end",
       CASE WHEN n_nationkey % 7 = 0 THEN 'chr9' ELSE 'chr' || (n_nationkey % 5) END AS to_chr,
       40000 * (n_nationkey // 5) + 1 + 1000 * n_regionkey AS to_start, CASE WHEN n_nationkey % 4 = 3 THEN '-' ELSE '+' END AS to_strand FROM nation
UNION ALL
SELECT 'chr' || r_regionkey, 5000, 9000, 'chrUn', 5000, '+' FROM region""",
    # quality control and preprocessing of all projects
    "qc_sizes": """
SELECT project_id, count(DISTINCT probe_id) AS n_probes FROM fx_beta GROUP BY project_id""",
    "qc_stats": """
SELECT project_id, sample_id, count(value) AS n_present, any_value(n_probes) AS n_probes,
       (any_value(n_probes) - count(value)) / any_value(n_probes) AS missing_rate, avg(value) AS mean
FROM fx_beta JOIN qc_sizes USING (project_id) GROUP BY project_id, sample_id""",
    "qc_fences": """
SELECT project_id, quantile_cont(mean, 0.25) AS q1, quantile_cont(mean, 0.75) AS q3,
       q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high
FROM qc_stats GROUP BY project_id""",
    "qc_samples": """
SELECT project_id, sample_id, missing_rate, mean, missing_rate > 0.2 AS fail_missing,
       coalesce(mean < low OR mean > high, false) AS fail_mean, NOT (fail_missing OR fail_mean) AS passed
FROM qc_stats JOIN qc_fences USING (project_id)""",
    "qc_kept": """
SELECT * FROM fx_beta WHERE (project_id, sample_id) IN (SELECT (project_id, sample_id) FROM qc_samples WHERE passed)""",
    "qc_sample_counts": """
SELECT project_id, count(*) AS n_samples FROM qc_samples WHERE passed GROUP BY project_id""",
    "qc_probes": """
SELECT project_id, probe_id, count(value) AS n_present, any_value(n_samples) AS n_samples,
       (any_value(n_samples) - count(value)) / any_value(n_samples) AS missing_rate, avg(value) AS mean, var_pop(value) AS variance
FROM qc_kept JOIN qc_sample_counts USING (project_id) GROUP BY project_id, probe_id""",
    "qc_flags": """
SELECT probe_id, NOT (is_sex_chr OR has_cpg_snp OR has_sbe_snp OR has_probe_snp OR is_cross_reactive OR is_multi_mapped) AS keep_annotation
FROM fx_annotation WHERE starts_with(probe_id, 'cg')""",
    "qc_passed": """
SELECT * FROM qc_probes JOIN qc_flags USING (probe_id) WHERE missing_rate <= 0.05 AND keep_annotation""",
    "qc_matrix": """
SELECT k.* FROM qc_kept k JOIN qc_passed USING (project_id, probe_id)""",
    "pp_probes": """
SELECT * FROM qc_passed WHERE n_present = n_samples AND variance >= 0.0001 AND mean BETWEEN 0.01 AND 0.99""",
    "pp_matrix": """
SELECT m.project_id, m.sample_id, m.probe_id, m.value FROM fx_m m
JOIN pp_probes USING (project_id, probe_id)
JOIN (SELECT project_id, sample_id FROM qc_samples WHERE passed) USING (project_id, sample_id)""",
    "co_common": """
SELECT probe_id FROM pp_probes GROUP BY probe_id
HAVING count(*) = (SELECT count(*) FROM fx_projects)""",
    "co_matrix": """
SELECT * FROM pp_matrix WHERE probe_id IN (SELECT probe_id FROM co_common)""",
    "gs_scores": """
SELECT q.*, b.batch_id, split_part(b.batch_id, '-', 1) AS portion FROM qc_stats q JOIN fx_batched b USING (project_id, sample_id)""",
    "co_survivors": """
SELECT project_id, sample_id FROM qc_samples WHERE passed""",
    "co_selected": """
SELECT * FROM co_matrix WHERE probe_id IN (SELECT probe_id FROM co_mad WHERE mad_score > 0 ORDER BY mad_score DESC, probe_id LIMIT 12)""",
    "co_genes": """
SELECT project_id, sample_id, gene_symbol, avg(value) AS value
FROM co_matrix JOIN (SELECT probe_id, unnest(string_split(gene_symbol, ';')) AS gene_symbol FROM fx_annotation
                     WHERE (TSS200 OR TSS1500) AND gene_symbol IS NOT NULL) USING (probe_id)
GROUP BY project_id, sample_id, gene_symbol""",
    # empirical-Bayes batch correction of the cohort matrix
    "cb_keys": """
SELECT project_id, sample_id, coalesce(batch_id, 'None') AS full_key FROM fx_batched JOIN co_survivors USING (project_id, sample_id)""",
    "cb_samples": """
SELECT project_id, sample_id,
       CASE WHEN (SELECT min(n) FROM (SELECT count(*) AS n FROM cb_keys GROUP BY full_key)) > 1 THEN full_key
            WHEN (SELECT min(n) FROM (SELECT count(*) AS n FROM cb_keys GROUP BY split_part(full_key, '-', 1))) > 1 THEN split_part(full_key, '-', 1)
            ELSE array_to_string(string_split(full_key, '-')[1:2], '-') END AS batch
FROM cb_keys""",
    # design columns: every batch, every project but the first
    "cb_columns": """
SELECT label, kind, row_number() OVER (ORDER BY kind, label) AS k
FROM (SELECT DISTINCT batch AS label, 'batch' AS kind FROM cb_samples
      UNION ALL SELECT DISTINCT project_id, 'project' FROM cb_samples WHERE project_id > (SELECT min(project_id) FROM cb_samples))""",
    "cb_design": """
SELECT s.project_id, s.sample_id, c.k FROM cb_samples s
JOIN cb_columns c ON (c.kind = 'batch' AND c.label = s.batch) OR (c.kind = 'project' AND c.label = s.project_id)""",
    "cb_normal": """
SELECT list(line ORDER BY i) AS m FROM (
  SELECT i, list(CAST(coalesce(n, 0) AS DOUBLE) ORDER BY j) AS line
  FROM (SELECT a.k AS i, b.k AS j FROM cb_columns a CROSS JOIN cb_columns b)
  LEFT JOIN (SELECT a.k AS i, b.k AS j, count(*) AS n FROM cb_design a JOIN cb_design b USING (project_id, sample_id) GROUP BY 1, 2) USING (i, j)
  GROUP BY i)""",
    # in-place Gauss-Jordan inversion, one pivot per step
    "cb_pivots": """
SELECT CAST(0 AS BIGINT) AS p, m FROM cb_normal
UNION ALL
SELECT p + 1, list_transform(range(1, len(m) + 1), lambda i: list_transform(range(1, len(m) + 1), lambda j:
         CASE WHEN i = p + 1 AND j = p + 1 THEN 1 / m[i][j]
              WHEN i = p + 1 THEN m[i][j] / m[i][i]
              WHEN j = p + 1 THEN -m[i][j] / m[j][j]
              ELSE m[i][j] - m[i][p + 1] * m[p + 1][j] / m[p + 1][p + 1] END))
FROM cb_pivots WHERE p < len(m)""",
    "cb_inverse": """
SELECT a.k AS i, b.k AS j, m[a.k][b.k] AS v FROM cb_columns a CROSS JOIN cb_columns b CROSS JOIN (SELECT m FROM cb_pivots ORDER BY p DESC LIMIT 1)""",
    "cb_coefficients": """
SELECT probe_id, i AS k, sum(v * total) AS b
FROM (SELECT probe_id, k AS j, sum(value) AS total FROM co_matrix JOIN cb_design USING (project_id, sample_id) GROUP BY 1, 2)
JOIN cb_inverse USING (j) GROUP BY 1, 2""",
    "cb_grand": """
SELECT probe_id, sum(b * n) / (SELECT count(*) FROM cb_samples) AS grand
FROM cb_coefficients JOIN cb_columns USING (k) JOIN (SELECT batch AS label, count(*) AS n FROM cb_samples GROUP BY 1) USING (label)
WHERE kind = 'batch' GROUP BY 1""",
    "cb_fitted": """
SELECT m.project_id, m.sample_id, m.probe_id, any_value(m.value) AS y, sum(b) AS fit, coalesce(sum(b) FILTER (kind = 'project'), 0) AS effect
FROM co_matrix m JOIN cb_design d USING (project_id, sample_id) JOIN cb_coefficients c ON c.probe_id = m.probe_id AND c.k = d.k
JOIN cb_columns l ON l.k = d.k GROUP BY 1, 2, 3""",
    "cb_pooled": """
SELECT probe_id, sqrt(avg((y - fit) * (y - fit))) AS sd FROM cb_fitted GROUP BY 1""",
    "cb_scores": """
SELECT f.project_id, f.sample_id, f.probe_id, batch, y, sd, grand + effect AS center, (y - grand - effect) / sd AS z
FROM cb_fitted f JOIN cb_pooled USING (probe_id) JOIN cb_grand USING (probe_id) JOIN cb_samples USING (project_id, sample_id)""",
    "cb_stats": """
SELECT probe_id, batch, count(*) AS n, avg(z) AS gamma, coalesce(var_samp(z), 1) AS delta, sum(z) AS total, sum(z * z) AS squares
FROM cb_scores GROUP BY 1, 2""",
    "cb_priors": """
SELECT batch, avg(gamma) AS bar, var_samp(gamma) AS t2, (2 * var_samp(delta) + avg(delta) ** 2) / var_samp(delta) AS a,
       (avg(delta) * var_samp(delta) + avg(delta) ** 3) / var_samp(delta) AS b
FROM cb_stats GROUP BY 1""",
    "cb_steps": """
SELECT probe_id, batch, CAST(0 AS BIGINT) AS step, gamma AS g, delta AS d, CAST(1 AS DOUBLE) AS change FROM cb_stats
UNION ALL
SELECT probe_id, batch, step + 1, g2, d2, greatest(abs(g2 - g) / abs(g), abs(d2 - d) / abs(d))
FROM (SELECT *, (b + 0.5 * (squares - 2 * g2 * total + n * g2 * g2)) / (n / 2 + a - 1) AS d2
      FROM (SELECT *, (t2 * n * gamma + d * bar) / (t2 * n + d) AS g2
            FROM cb_steps JOIN cb_stats USING (probe_id, batch) JOIN cb_priors USING (batch)
            WHERE change >= 0.0001))""",
    "cb_agreed": """
SELECT batch, max(step) AS last FROM cb_steps GROUP BY 1""",
    "cb_run": """
SELECT probe_id, batch, CAST(0 AS BIGINT) AS step, gamma AS g, delta AS d FROM cb_stats
UNION ALL
SELECT probe_id, batch, step + 1, g2, (b + 0.5 * (squares - 2 * g2 * total + n * g2 * g2)) / (n / 2 + a - 1)
FROM (SELECT *, (t2 * n * gamma + d * bar) / (t2 * n + d) AS g2
      FROM cb_run JOIN cb_stats USING (probe_id, batch) JOIN cb_priors USING (batch) JOIN cb_agreed USING (batch)
      WHERE step < last)""",
    "cb_corrected": """
SELECT s.project_id, s.sample_id, s.probe_id, sd * (z - g) / sqrt(d) + center AS value
FROM cb_scores s JOIN cb_agreed USING (batch) JOIN cb_run r ON r.probe_id = s.probe_id AND r.batch = s.batch AND r.step = last""",
    "co_mad": """
SELECT probe_id, mad(value) AS mad_score FROM co_matrix GROUP BY probe_id""",
}


def _component_views(tag: str, source: str, sweeps: int = 8) -> dict[str, str]:
    """Principal components of ``source`` by cyclic Jacobi rotations of its covariance."""
    n = "range(1, len(m) + 1)"
    return {
        f"pc_{tag}_scaled": f"""
SELECT project_id, sample_id, probe_id, least(greatest((value - center) / CASE WHEN spread > 0 THEN spread ELSE 1 END, -10), 10) AS x
FROM {source} JOIN (SELECT probe_id, avg(value) AS center, stddev_samp(value) AS spread FROM {source} GROUP BY 1) USING (probe_id)""",
        f"pc_{tag}_covariance": f"""
SELECT list(line ORDER BY i) AS m, list(i ORDER BY i) AS probes FROM (
  SELECT i, list(c ORDER BY j) AS line FROM (
    SELECT a.probe_id AS i, b.probe_id AS j, covar_samp(a.x, b.x) AS c
    FROM pc_{tag}_scaled a JOIN pc_{tag}_scaled b USING (project_id, sample_id) GROUP BY 1, 2) GROUP BY i)""",
        f"pc_{tag}_turns": f"""
SELECT CAST(0 AS BIGINT) AS step, m, list_transform({n}, lambda i: list_transform({n}, lambda j: CAST(i = j AS DOUBLE))) AS v,
       flatten(list_transform({n}, lambda i: list_transform(range(i + 1, len(m) + 1), lambda j: [i, j]))) AS pairs
FROM pc_{tag}_covariance
UNION ALL
SELECT step + 1, list_transform({n}, lambda i: CASE WHEN i = p THEN list_transform({n}, lambda j: c * m[p][j] - s * m[q][j])
         WHEN i = q THEN list_transform({n}, lambda j: s * m[p][j] + c * m[q][j]) ELSE m[i] END), v, pairs
FROM (SELECT step, pairs, p, q, c, s,
             list_transform(m, lambda r: list_transform(range(1, len(r) + 1), lambda j: CASE WHEN j = p THEN c * r[p] - s * r[q] WHEN j = q THEN s * r[p] + c * r[q] ELSE r[j] END)) AS m,
             list_transform(v, lambda r: list_transform(range(1, len(r) + 1), lambda j: CASE WHEN j = p THEN c * r[p] - s * r[q] WHEN j = q THEN s * r[p] + c * r[q] ELSE r[j] END)) AS v
      FROM (SELECT *, 1 / sqrt(t * t + 1) AS c, t / sqrt(t * t + 1) AS s
            FROM (SELECT *, CASE WHEN m[p][q] = 0 THEN 0 ELSE (CASE WHEN m[q][q] < m[p][p] THEN -1 ELSE 1 END) /
                            (abs((m[q][q] - m[p][p]) / (2 * m[p][q])) + sqrt(((m[q][q] - m[p][p]) / (2 * m[p][q])) ** 2 + 1)) * (CASE WHEN m[p][q] < 0 THEN -1 ELSE 1 END) END AS t
                  FROM (SELECT *, pairs[step % len(pairs) + 1][1] AS p, pairs[step % len(pairs) + 1][2] AS q
                        FROM pc_{tag}_turns WHERE step < {sweeps} * len(pairs)))))""",
        f"pc_{tag}_loadings": f"""
SELECT probes[i] AS probe_id, rank AS k, v[i][j] * sign(arg_max(v[i][j], abs(v[i][j])) OVER (PARTITION BY j)) AS loading
FROM (SELECT probes, v, m[j][j] AS strength, j, row_number() OVER (ORDER BY m[j][j] DESC) AS rank
      FROM (SELECT probes, t.v, t.m, unnest(range(1, len(t.m) + 1)) AS j
            FROM (SELECT m, v FROM pc_{tag}_turns ORDER BY step DESC LIMIT 1) t CROSS JOIN pc_{tag}_covariance))
CROSS JOIN (SELECT unnest(range(1, len(m) + 1)) AS i FROM pc_{tag}_covariance)""",
        f"pc_{tag}_scores": f"""
SELECT project_id, sample_id, k, sum((x - middle) * loading) AS score
FROM pc_{tag}_scaled JOIN (SELECT probe_id, avg(x) AS middle FROM pc_{tag}_scaled GROUP BY 1) USING (probe_id)
JOIN pc_{tag}_loadings USING (probe_id) WHERE k <= 10 GROUP BY 1, 2, 3""",
    }


def dispersion_sql(source: str) -> str:
    """Normalised dispersion of every probe of ``source`` in 20 bins of mean."""
    return f"""
SELECT probe_id, mean, dispersion, bin,
       (dispersion - CASE WHEN spread IS NULL THEN 0 ELSE center END) / CASE WHEN spread IS NULL THEN center ELSE spread END AS score
FROM (SELECT *, avg(dispersion) OVER (PARTITION BY bin) AS center, stddev_samp(dispersion) OVER (PARTITION BY bin) AS spread
      FROM (SELECT *, CAST(greatest(ceil((mean - min(mean) OVER ()) / (max(mean) OVER () - min(mean) OVER ()) * 20), 1) AS INTEGER) AS bin
            FROM (SELECT probe_id, ln(1 + m) AS mean, CASE WHEN v / m > 0 THEN ln(v / m) END AS dispersion
                  FROM (SELECT probe_id, CASE WHEN avg(exp(value) - 1) = 0 THEN 1e-12 ELSE avg(exp(value) - 1) END AS m, var_samp(exp(value) - 1) AS v
                        FROM {source} GROUP BY probe_id))))"""


def _report_views(tag: str, source: str) -> dict[str, str]:
    """Share of component variance by project and by portion, over the variable probes of ``source``."""
    return {
        f"hv_{tag}_matrix": f"""
SELECT * FROM {source} WHERE probe_id IN (
  SELECT probe_id FROM ({dispersion_sql(source)}) WHERE score IS NOT NULL ORDER BY score DESC, probe_id LIMIT 5000)""",
        **_component_views(tag, f"hv_{tag}_matrix"),
        f"pc_{tag}_labelled": f"""
SELECT p.project_id, split_part(batch_id, '-', 1) AS portion, k, score FROM pc_{tag}_scores p JOIN fx_batched USING (project_id, sample_id)""",
        f"pc_{tag}_total": f"""
SELECT sum(v) AS total FROM (SELECT var_samp(score) AS v FROM pc_{tag}_labelled GROUP BY k)""",
        f"pc_{tag}_shares": f"""
SELECT 'project_id' AS factor, sum(v) AS between FROM (
  SELECT var_samp(a) AS v FROM (SELECT k, avg(score) AS a FROM pc_{tag}_labelled GROUP BY k, project_id) GROUP BY k)
UNION ALL
SELECT 'portion', sum(v) FROM (
  SELECT var_samp(a) AS v FROM (SELECT k, avg(score) AS a FROM pc_{tag}_labelled WHERE portion IS NOT NULL GROUP BY k, portion) GROUP BY k)""",
    }


VIEWS |= _component_views("plain", "co_matrix")
VIEWS |= _report_views("before", "co_matrix")
VIEWS |= _report_views("after", "cb_corrected")

_NAME = re.compile(r"\b(?:fx|qc|pp|co|cb|gs|pc|hv|one)_[a-z0-9_]+\b")


def _needed(sql: str) -> list[str]:
    """Views a statement uses, each after the ones it rests on."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in _NAME.findall(text):
            if name in VIEWS and name not in ordered:
                visit(VIEWS[name].replace(name, ""))
                if name not in ordered:
                    ordered.append(name)

    visit(sql)
    return ordered


def _one_project_views(last: str) -> dict[str, str]:
    """The views ``last`` rests on, over the samples of all projects as one project."""
    names = [*_needed(f"SELECT * FROM {last}")]
    renamed = {name: _NAME.sub(lambda m: f"one_{m[0]}" if m[0] in VIEWS and m[0] != "fx_annotation" else m[0], VIEWS[name]) for name in names}
    views = {f"one_{name}": body for name, body in renamed.items()}
    views["one_fx_beta"] = "SELECT * REPLACE ('ALL' AS project_id) FROM fx_beta"
    views["one_fx_m"] = "SELECT * REPLACE ('ALL' AS project_id) FROM fx_m"
    return views


VIEWS |= _one_project_views("pp_matrix")


def with_views(sql: str) -> str:
    """``sql`` with the views it names as leading common table expressions."""
    body = sql.strip()
    needed = _needed(body)
    if not needed:
        return body
    recursive = any(re.search(rf"\b{name}\b", VIEWS[name]) for name in needed)
    views = [f"{name} AS ({VIEWS[name].strip()})" for name in needed]
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(views) + "\n" + body
