"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local cores.
Each query is built and run in full, writing to the no-op sink, after one untimed warm-up of
the session.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from betaloom import catalog  # noqa: E402
from betaloom.session import local_session  # noqa: E402

HEADLINE = (
    "read_raw_beta", "beta_store", "saved_projects", "assemble_matrix", "dense_matrix", "packed_vectors",
    "sample_qc", "probe_qc", "quality_control", "filter_variance", "impute", "m_values", "prepare_dataset",
    "cohort_matrix", "mad_scores", "top_variable_probes", "batch_corrected", "gene_means", "winsorized",
    "scaled_matrix", "stratified_split", "prepare_cohort", "prepare_gene_cohort", "highly_variable_probes",
    "standardized", "principal_components", "variance_by_factor", "value_histogram", "biospecimen", "first_aliquots",
    "audit_with_metadata", "manifest_checks", "lifted_annotation", "shores_and_shelves", "island_context",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, "betaloom-bench")
    known = catalog.load()
    known["sample_mean"].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        known[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir.rstrip("/").split("sf")[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
