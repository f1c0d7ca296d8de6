"""A cohort in long form."""

from typing import NamedTuple

from pyspark.sql import DataFrame


class Cohort(NamedTuple):
    """One table with a row per sample, and one with a row per sample and gene."""

    samples: DataFrame
    expr: DataFrame
