"""Attribute lines: ``!Sample_<key>`` followed by one value per sample, tab-separated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.fixed_values import (
    ATTRIBUTE_PREFIXES,
    CHARACTERISTIC_RULES,
    CHARACTERISTICS_KEY,
    TITLE_KEY,
)
from ..functions.text import (
    after_first_colon,
    after_last_colon,
    attribute_key,
    attribute_slug,
    clean_text,
    strip,
)
from ..operators.ordering import number_within
from ..session import settle


def scan_attribute_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, line_no, block, key, line, fields) of the ``!Sample_`` lines of one or many files, in file order.

    ``line_no`` orders the lines of one file; it is a position, not a count.
    """
    block = F.col("_metadata.file_block_start")
    return (
        spark.read.text(path if isinstance(path, str) else list(path))
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.struct(block.alias("block"), F.monotonically_increasing_id().alias("seq")).alias("line_no"),
            block.alias("block"),
            strip(F.col("value")).alias("line"),
        )
        .filter(F.col("line").startswith("!Sample_"))
        .transform(_with_fields)
    )


def _with_fields(lines: DataFrame) -> DataFrame:
    parts = F.split("line", "\t")
    return lines.withColumn("key", F.get(parts, F.lit(0))).withColumn(
        "fields", F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    )


def named_attributes(lines: DataFrame, prefixes: Sequence[str] = ATTRIBUTE_PREFIXES) -> DataFrame:
    """(file, name, sample_idx, value): the useful lines, each under the name of its column.

    A characteristics line is named by the label of its first value; a name
    that a file uses again becomes ``name_2``, ``name_3``. Any other line is
    named by its key, and the last line of a key counts. Names are found on
    whole lines; values are exploded afterwards.
    """
    useful = F.lit(False)
    for prefix in prefixes:
        useful = useful | F.col("key").startswith(prefix)
    # read several times below: stored once, with its line numbers
    lines = settle(lines.filter(useful), "attribute-lines")
    is_characteristic = F.col("key") == CHARACTERISTICS_KEY

    labelled = lines.filter(is_characteristic).select(
        "file", "line_no", "block", clean_text(F.get("fields", F.lit(0))).alias("first_value")
    )
    numbered = number_within(
        labelled.withColumn("slug", attribute_slug(F.col("first_value"))).drop("first_value"),
        ["file", "slug"],
        F.col("line_no"),
        F.col("block"),
    )
    named = _settle_collisions(settle(numbered.select("file", "line_no", "slug", F.col("n").cast("bigint").alias("n")), "numbered"))

    last_of_key = (
        lines.filter(~is_characteristic)
        .groupBy("file", attribute_key(F.col("key")).alias("name"))
        .agg(F.max("line_no").alias("line_no"))
    )
    names = named.select("file", "line_no", "name").unionByName(last_of_key.select("file", "line_no", "name"))
    values = (
        lines.join(names, ["file", "line_no"])
        .select("file", "name", "key", F.posexplode("fields").alias("sample_idx", "field"))
        .withColumn("value", clean_text(F.col("field")))
    )
    text = F.when(is_characteristic, after_first_colon(F.col("value"))).otherwise(F.col("value"))
    return values.select("file", "name", "sample_idx", text.alias("value"))


def _settle_collisions(numbered: DataFrame) -> DataFrame:
    """(file, line_no, name): every line takes the first of ``x``, ``x_2``, ``x_3``, ... that no earlier line has.

    ``numbered`` has the label ``x`` of a line as ``slug`` and counts its lines in ``n``. A name clashes where a number of
    one label is another label (``x_2``). The earliest line keeps it; the number is closed to the later line's label, whose
    further lines move up. That can clash again, so it is repeated until nothing does: as claims to a name only ever
    pass to earlier lines, a closed number stays closed. No file is gathered; a round is a few joins on (file, name) and
    (file, label), and one question to the driver, whether there was a clash.
    """
    closed = None
    while True:
        named = _with_names(numbered, closed)
        owners = named.groupBy("file", "name").agg(F.min("line_no").alias("owner"), F.count(F.lit(1)).alias("lines")).filter("lines > 1")
        losers = named.join(owners, ["file", "name"]).filter("line_no > owner").select("file", "slug", "number", "owner")
        losers = settle(losers, "name-clashes")
        if losers.isEmpty():
            return named.select("file", "line_no", "name")
        # of several numbers of a label, one may come to an earlier line when those before it are closed: if that line
        # stands before the owner, the number waits for the next round
        before = F.row_number().over(Window.partitionBy("file", "slug").orderBy("number")) - 1
        asked = losers.withColumn("at", F.col("number") - before)
        takers = named.select("file", "slug", F.col("number").alias("at"), "line_no")
        sure = asked.join(takers, ["file", "slug", "at"]).filter("line_no > owner").select("file", "slug", "number")
        closed = settle(sure if closed is None else closed.unionByName(sure), "closed-numbers")


def _with_names(numbered: DataFrame, closed: DataFrame | None) -> DataFrame:
    """Lines with ``number`` and ``name``; the n-th line of a label has the n-th number that is not closed to it."""
    if closed is None:
        counted = numbered.withColumn("number", F.col("n"))
    else:
        # the i-th closed number moves every line up that would have it or a later one
        order = F.row_number().over(Window.partitionBy("file", "slug").orderBy("number"))
        moves = closed.withColumn("from", F.col("number") - order + 1).groupBy("file", "slug").agg(F.collect_list("from").alias("moves"))
        up = F.coalesce(F.size(F.filter("moves", lambda at: at <= F.col("n"))), F.lit(0))
        counted = numbered.join(moves, ["file", "slug"], "left").withColumn(
            "number", F.col("n") + F.when(F.col("moves").isNull(), 0).otherwise(up)
        ).drop("moves")
    suffix = F.when(F.col("number") > 1, F.concat(F.lit("_"), F.col("number").cast("string"))).otherwise("")
    return counted.withColumn("name", F.concat("slug", suffix))


#: Columns that attribute names may become; tables of more names are refused, or kept as maps.
MAX_NAMES = 10_000


def attribute_maps(attributes: DataFrame) -> DataFrame:
    """One row per sample of a file, with a map from every name to its value; names need not be known.

    Names are one per line of the file, which bounds what is gathered for a sample. A null name is left out.
    """
    entry = F.struct("name", "value")
    return (
        attributes.filter(F.col("name").isNotNull())
        .groupBy("file", "sample_idx")
        .agg(F.map_from_entries(F.array_sort(F.collect_set(entry))).alias("attributes"))
    )


def pivot_attributes(attributes: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """One row per sample of a file, one column per name; shorter lines are padded with NULL.

    Without ``names`` the distinct names are read first: they are the columns
    of the result, at most ``MAX_NAMES``; more of them fail.
    """
    if names is None:
        found = attributes.select("name").dropna().distinct().limit(MAX_NAMES + 1).collect()
        if len(found) > MAX_NAMES:
            raise ValueError(f"more than {MAX_NAMES} attribute names: use attribute_maps")
        names = sorted(row[0] for row in found)
    return (
        attributes.groupBy("file", "sample_idx").pivot("name", list(names)).agg(F.first("value", ignorenulls=True))
    )


def extract_labelled_attributes(
    lines: DataFrame, rules: Sequence[tuple[str, str]] = CHARACTERISTIC_RULES
) -> DataFrame:
    """One row per sample with a known set of columns.

    A characteristics line belongs to the first rule whose text it contains,
    in any case; a later line of the same column replaces an earlier one. The
    value is the text after the last colon. A column whose length differs
    from the number of titles is NULL throughout, except the response, where
    this is an error.
    """
    text = F.lower("line")
    column = F.when(F.col("key").startswith(TITLE_KEY), "patient_id")
    for needle, name in rules:
        column = column.when(
            F.col("key").startswith(CHARACTERISTICS_KEY) & text.contains(needle.lower()), name
        )
    columns = [name for _, name in rules]
    latest = (
        lines.withColumn("column", column)
        .dropna(subset=["column"])
        .groupBy("file")
        .pivot("column", ["patient_id", *columns])
        .agg(F.max_by("fields", "line_no"))
    )
    n_titles = F.size("patient_id")
    checked = latest.withColumns(
        {
            "patient_id": F.when(F.col("patient_id").isNotNull(), F.col("patient_id")).otherwise(
                F.raise_error(F.lit("no sample title"))
            ),
            "response": F.when(F.size("response") == n_titles, F.col("response")).otherwise(
                F.raise_error(F.lit("number of responses differs from number of titles"))
            ),
        }
    ).withColumns(
        {
            name: F.when(F.size(name) == n_titles, F.col(name))
            for name in columns
            if name != "response"
        }
    )
    titles = checked.select("file", *columns, F.posexplode("patient_id").alias("sample_idx", "title"))
    return titles.select(
        "file",
        "sample_idx",
        clean_text(F.col("title"), keep_empty=True).alias("patient_id"),
        *[
            after_last_colon(clean_text(F.get(F.col(name), F.col("sample_idx")), keep_empty=True)).alias(name)
            for name in columns
        ],
    )
