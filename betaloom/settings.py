"""Fixed values, defaults and the option records that steer a run."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from typing import Any

# --- fixed values: names used by the public data portal and the default thresholds ---
PLATFORMS = (
    "Illumina Human Methylation 27",
    "Illumina Human Methylation 450",
    "Illumina Methylation Epic",
)
# highest resolution first
PLATFORM_PRIORITY = (
    "Illumina Methylation Epic",
    "Illumina Human Methylation 450",
    "Illumina Human Methylation 27",
)
REFERENCE_GENOMES = ("GRCh37", "GRCh38")
GENE_REGIONS = ("TSS200", "TSS1500", "gene_body")
EPSILON = 1e-3
# --- end of fixed values ---


@dataclass(frozen=True)
class ManifestRequest:
    """The values a manifest row must carry to belong to a project."""

    project_id: str
    data_category: str = "DNA Methylation"
    experimental_strategy: str = "Methylation Array"
    data_type: str = "Methylation Beta Value"
    platform: str = "Illumina Human Methylation 450"
    sample_type: str = "Primary Tumor"
    access: str = "open"
    reference_genome: str | None = None


@dataclass(frozen=True)
class ProjectOptions:
    """Steps and thresholds of the per-project job."""

    sample_qc: bool = True
    probe_qc: bool = True
    filter_variance: bool = True
    impute: bool = True
    convert_to_mval: bool = True
    sample_missing_threshold: float = 0.20
    outlier_threshold: float = 1.5
    probe_missing_threshold: float = 0.05
    remove_cross_reactive: bool = True
    remove_snp_associated: bool = True
    remove_sex_chromosome: bool = True
    remove_multi_mapped: bool = True
    min_variance: float = 0.0001
    min_mean: float = 0.01
    max_mean: float = 0.99
    na_policy: str = "propagate"
    epsilon: float = EPSILON

    @classmethod
    def from_config(cls, config: Mapping[str, Any]) -> ProjectOptions:
        """Read the nested mapping a project configuration file holds."""
        toggles = config.get("toggles", {})
        samples = config.get("quality_control", {}).get("sample_qc", {})
        probes = config.get("quality_control", {}).get("probe_qc", {})
        variance = config.get("preprocessing", {}).get("filter_variance", {})
        named = {
            "sample_missing_threshold": samples.get("missing_threshold"),
            "outlier_threshold": samples.get("outlier_threshold"),
            "probe_missing_threshold": probes.get("missing_threshold"),
            "remove_cross_reactive": probes.get("remove_cross_reactive"),
            "remove_snp_associated": probes.get("remove_SNP_associated"),
            "remove_sex_chromosome": probes.get("remove_sex_chromosome"),
            "remove_multi_mapped": probes.get("remove_multi_mapped"),
            "min_variance": variance.get("min_variance"),
            "min_mean": variance.get("min_mean"),
            "max_mean": variance.get("max_mean"),
        }
        for step in ("sample_qc", "probe_qc", "filter_variance", "impute", "convert_to_mval"):
            named[step] = toggles.get(step)
        return replace(cls(), **{k: v for k, v in named.items() if v is not None})


@dataclass(frozen=True)
class CohortOptions:
    """Steps and parameters of the cohort job."""

    mad_probe_filtering: bool = True
    batch_correction: bool = False
    gene_aggregation: bool = False
    clip_and_scale: bool = True
    split: bool = True
    top_n: int = 30_000
    batch_key: str = "batch_id"
    covariates: tuple[str, ...] = ("project_id",)
    regions: tuple[str, ...] = ("TSS200", "TSS1500")
    clip_quantiles: tuple[float, float] = (0.01, 0.99)
    fractions: tuple[float, float, float] = (0.60, 0.20, 0.20)
    seed: int = 42

    @classmethod
    def from_config(cls, config: Mapping[str, Any]) -> CohortOptions:
        """Read the nested mapping a cohort configuration file holds."""
        toggles = config.get("toggles", {})
        batches = config.get("batch_correction", {})
        named = {
            "mad_probe_filtering": toggles.get("MAD_probe_filtering"),
            "batch_correction": toggles.get("batch_correction"),
            "gene_aggregation": toggles.get("gene_aggregation"),
            "clip_and_scale": toggles.get("clip_and_scale"),
            "split": toggles.get("split"),
            "top_n": config.get("MAD_probe_filtering"),
            "batch_key": batches.get("batch_key"),
            "covariates": batches.get("covariates"),
            "regions": config.get("gene_aggregation"),
            "clip_quantiles": config.get("clip_and_scale"),
            "fractions": config.get("split"),
            "seed": config.get("seed"),
        }
        tuples = ("covariates", "regions", "clip_quantiles", "fractions")
        kept = {k: tuple(v) if k in tuples else v for k, v in named.items() if v is not None}
        return replace(cls(), **kept)
