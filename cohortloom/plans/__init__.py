"""User-level operations, composed of the scans and operators."""

from ..cohort import Cohort  # noqa: F401
