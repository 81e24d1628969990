"""Every public function in one place.

Steps over a ``Dataset``: ``quality_control``, ``preprocess``, ``prepare_dataset``, ``aggregate_cohort``,
``filter_by_mad``, ``cohort_batch_correction``, ``aggregate_genes``, ``clip_and_scale``, ``split``, ``prepare_cohort``.
The rest works on plain DataFrames and columns.
"""

from betaloom.functions.columns import batch_id as extract_batch_id
from betaloom.functions.columns import case_aliquot_id as extract_aliquot_id
from betaloom.functions.columns import case_project_id as extract_project_id
from betaloom.functions.columns import case_sample_type as extract_sample_type
from betaloom.functions.columns import case_submitter_id as extract_submitter_id
from betaloom.functions.columns import first_file_name as extract_file_name
from betaloom.operators.attempts import audit_of_attempts, fold_attempts, next_attempts, still_pending
from betaloom.operators.cohort import cohort_aggregation, gene_aggregation, mad_scores, top_probes
from betaloom.operators.combat import batch_correction
from betaloom.operators.control import (
    build_biospecimen,
    build_manifest,
    build_metadata,
    clean_metadata,
    download_status,
    initialize_audit_table,
    landed_files,
    pending_files,
    update_metadata,
)
from betaloom.operators.diagnostics import (
    distribution,
    fraction_variance,
    highly_variable,
    histogram,
    integrity,
    principal_components,
    standardize,
)
from betaloom.operators.intervals import island_context, liftover, liftover_annotation
from betaloom.operators.matrix import pack_blocks, probe_dictionary, unpack_blocks
from betaloom.operators.preprocess import convert_to_mval, filter_variance, impute
from betaloom.operators.quality import iqr_bounds
from betaloom.operators.regions import region_flags, region_hits, with_regions
from betaloom.operators.states import add_states, read_states
from betaloom.plans.batch_report import explain_batch
from betaloom.plans.cohort import (
    aggregate_cohort,
    aggregate_genes,
    clip_and_scale,
    cohort_batch_correction,
    filter_by_mad,
    prepare_cohort,
    split,
)
from betaloom.plans.intake import load_raw_project, register_files, verified_manifest
from betaloom.plans.project import prepare_dataset, preprocess, probe_qc, quality_control, sample_qc
from betaloom.plans.workflow import ProjectInputs, prepare_project
from betaloom.sources.annotation import csvs_to_parquet, load_annotation
from betaloom.sources.beta import clean_data, load_sample, raw_files
from betaloom.sources.chain import read_chain
from betaloom.sources.control import (
    load_audit_table,
    load_manifest,
    load_metadata,
    load_status_log,
    save_audit_table,
    save_manifest,
    save_metadata,
    save_status_log,
)
from betaloom.sources.layout import by_probe
from betaloom.sources.matrix import load_datasets, load_processed_project, save_cohort, save_project, save_split

__all__ = [name for name in dir() if not name.startswith("_")]
