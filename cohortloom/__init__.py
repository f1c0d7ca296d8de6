"""Cohort harmonisation on Spark: many heterogeneous measurement cohorts, one analysis-ready dataset."""
