"""DNA-methylation matrix preparation as Spark DataFrame jobs."""

from betaloom.dataset import Dataset
from betaloom.settings import CohortOptions, ProjectOptions

__all__ = ["CohortOptions", "Dataset", "ProjectOptions"]
