"""Outcome labels. A policy is always named: the four policies contradict each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixed_values import LABEL_POLICIES
from .text import contains_any, strip


def label(response: Column, policy: str) -> Column:
    """0/1 label of a response text under a named policy; NULL when no rule applies."""
    text = F.upper(strip(response))
    chain = None
    for kind, value, tokens in LABEL_POLICIES[policy]:
        hit = text.isin(*tokens) if kind == "equals" else contains_any(text, tokens)
        chain = F.when(hit, F.lit(value)) if chain is None else chain.when(hit, F.lit(value))
    return chain.cast("int")


def add_label(df: DataFrame, response: str, policy: str, name: str = "response_binary") -> DataFrame:
    """Add the label of a response column.

    The response is a column by then, so that the rules refer to it and do not
    each repeat the expression that made it.
    """
    return df.withColumn(name, label(F.col(response), policy))


def label_policy_table(spark: SparkSession) -> DataFrame:
    """The policies as a table, one row per token."""
    rows = [
        (policy, kind, token, value, priority)
        for policy, rules in LABEL_POLICIES.items()
        for priority, (kind, value, tokens) in enumerate(rules, start=1)
        for token in tokens
    ]
    return spark.createDataFrame(
        rows, "policy string, match_kind string, token string, label int, priority int"
    )
