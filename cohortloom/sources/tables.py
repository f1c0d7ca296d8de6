"""Text tables with a header line."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed_values import NA_TOKENS
from ..functions.numeric import missing_to_null
from ..functions.text import strip
from ..session import settle

SEPARATORS = (",", "\t", ";")


def row_order() -> Column:
    """Position of a row in file order: (file, block, running id). Take it directly on a scan."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
    )


def first_line(spark: SparkSession, path: str, comment: str | None = None) -> str:
    """The header line of a text file or folder: one row read by one task."""
    lines = spark.read.text(path).filter(F.btrim("value") != "")
    if comment:
        lines = lines.filter(~F.col("value").startswith(comment))
    row = lines.first()
    if row is None:
        raise ValueError(f"no line in {path}")
    return row[0]


def header_names(line: str, sep: str) -> list[str]:
    """Column names of a header line: stripped, empty ones named, repeated ones numbered ``.1``, ``.2``.

    Names that differ only in case count as repeated, as a table of Spark cannot tell them apart.
    """
    names: list[str] = []
    taken: set[str] = set()
    for i, name in enumerate(next(csv.reader([line], delimiter=sep))):
        name = base = name.strip() or f"Unnamed: {i}"
        count = 0
        while name.lower() in taken:
            count += 1
            name = f"{base}.{count}"
        taken.add(name.lower())
        names.append(name)
    return names


def data_lines(spark: SparkSession, paths: str | Sequence[str], comment: str | None = None) -> DataFrame:
    """(value) of the lines after the header of every file: its first line that is neither blank nor a comment.

    The CSV reader drops the first line of a file and no other, even if it
    comes again; a separator that no text holds keeps lines whole. Blank lines
    and, with ``comment``, lines that begin with it are left out.
    """
    options = {"sep": "\u0001\u0002\u0001", "quote": "", "header": True, "comment": comment or ""}
    return spark.read.csv(paths if isinstance(paths, str) else list(paths), schema="value string", **options)


def first_lines(spark: SparkSession, path: str | Sequence[str], comment: str | None = None) -> DataFrame:
    """(file, header): the first line of every file that is neither blank nor a comment, from two passes over the first blocks.

    Texts cannot be kept in a hash table of aggregates, and all lines would be sorted for the sake of one. So the first
    pass finds two hashes of the first line, which it stores, and the second the line that has them.
    """
    lines = spark.read.text(path if isinstance(path, str) else list(path)).select(
        F.col("_metadata.file_path").alias("file"),
        "value",
        F.monotonically_increasing_id().alias("line"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    lines = lines.filter((F.col("block") == 0) & (F.btrim("value") != ""))
    if comment:
        lines = lines.filter(~F.col("value").startswith(comment))
    marked = lines.select("file", "line", "value", F.xxhash64("value").alias("mark"), F.xxhash64(F.lit(1), "value").alias("mark_2"))
    first = settle(marked.groupBy("file").agg(*[F.min_by(m, "line").alias(m) for m in ("mark", "mark_2")]), "first-lines")
    found = marked.join(first, ["file", "mark", "mark_2"])
    return found.select("file", F.col("value").alias("header")).distinct()


def header_groups(spark: SparkSession, path: str, sep: str = ",", comment: str | None = None) -> list[str | list[str]]:
    """The files of a path by their header: the path itself if all have the same, else lists of files.

    Headers stay in Spark; of every file its name and two hashes reach the driver. Files whose columns differ in more
    than their order are refused.
    """
    if len(spark.read.text(path).inputFiles()) < 2:
        return [path]
    names = F.transform(split_fields(F.col("header"), sep), lambda field: strip(unquote(field)))
    # a sum of hashes, and how many, do not depend on the order
    total = F.aggregate(names, F.lit(0).cast("decimal(38,0)"), lambda n, name: (n + F.xxhash64(F.lower(name))).cast("decimal(38,0)"))
    marks = first_lines(spark, path, comment).select("file", F.xxhash64("header").alias("mark"), F.struct(total, F.size(names)).alias("columns"))
    groups: dict[int, list[str]] = {}
    kinds = set()
    for row in marks.orderBy("file").collect():
        groups.setdefault(row["mark"], []).append(row["file"])
        kinds.add(tuple(row["columns"]))
    if len(kinds) > 1:
        raise ValueError(f"the files of {path} have different columns")
    if not groups:
        raise ValueError(f"no line in {path}")
    return list(groups.values()) if len(groups) > 1 else [path]


def detect_separator(spark: SparkSession, path: str, comment: str | None = None) -> str:
    """First of comma, tab and semicolon that splits the header; else what the header suggests."""
    line = first_line(spark, path, comment)
    for sep in SEPARATORS:
        if len(next(csv.reader([line], delimiter=sep))) > 1:
            return sep
    try:
        return csv.Sniffer().sniff(line).delimiter
    except csv.Error:
        return SEPARATORS[0]


def matrix_header(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """Column names of a text table, without reading its rows."""
    return header_names(first_line(spark, path), sep)


def scan_table(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    na_tokens: Sequence[str] = NA_TOKENS,
    comment: str | None = None,
    with_row: bool = False,
    multi_line: bool = False,
    max_columns: int = 1_000_000,
) -> DataFrame:
    """All-text table of a delimited file or folder, plain or gzipped.

    Missing-value tokens become NULL. A doubled quote inside quotes is a quote,
    a backslash a backslash. ``multi_line`` lets quoted fields hold line
    breaks; a file is then read by one task. Files of a folder that order their
    columns differently are matched by name. With ``comment``, comment lines
    are dropped and a line is cut at a later comment sign, which leaves its
    remaining columns NULL. ``with_row`` adds the file order as ``_row``.
    Tables with more than ``max_columns`` columns fail.
    """
    if comment is not None and multi_line:
        raise ValueError("comments are looked for line by line")
    parts = []
    for files in header_groups(spark, path, sep, comment):
        # the columns of a table are its schema, so one header of each kind reaches the driver
        names = header_names(first_line(spark, files if isinstance(files, str) else files[0], comment), sep)
        # read by place, so that no name can clash with another
        schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(names))])
        order = [row_order().alias("_row")] if with_row else []
        if comment is None:
            options = {"escape": '"', "header": True, "multiLine": multi_line, "maxColumns": max_columns}
            rows = spark.read.csv(files, schema=schema, sep=sep, **options).select(*schema.names, *order)
        else:
            rows = _rows_without_comments(spark, files, sep, comment, schema, order)
        # Spark splits only plain files; what a gzip file yields is spread by the next shuffle.
        parts.append(
            rows.select(
                *[missing_to_null(F.col(f"_c{i}"), na_tokens).alias(c) for i, c in enumerate(names)],
                *(["_row"] if with_row else []),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def read_alias(spark: SparkSession, path: str) -> DataFrame:
    """(protein_id, alias, source, row) of a tab-separated alias table, in file order."""
    return scan_table(spark, path, sep="\t", with_row=True).select(
        F.col("`#string_protein_id`").alias("protein_id"), "alias", "source", F.col("_row").alias("row")
    )


def without_comment(line: Column, comment: str) -> Column:
    """The line up to its first comment sign outside quotes."""
    sign = re.escape(comment)
    unquoted = rf'^((?:[^"{sign}]*+"[^"]*+")*+[^"{sign}]*+)'
    # Only a line with a quote pays for looking at quotes.
    return F.when(line.contains('"'), F.regexp_extract(line, unquoted, 1)).otherwise(
        F.split_part(line, F.lit(comment), F.lit(1))
    )


def split_fields(line: Column, sep: str) -> Column:
    """Fields of a line. Only a line with a quote pays for honouring quoted separators."""
    plain = F.split(line, re.escape(sep))
    mark = re.escape(sep)
    quoted = F.regexp_extract_all(
        line, F.lit(rf'(?<=^|{mark})("[^"]*+(?:""[^"]*+)*+"|[^{mark}"]*+)'), F.lit(1)
    )
    return F.when(line.contains('"'), quoted).otherwise(plain)


def unquote(field: Column) -> Column:
    """A field without its outer quotes; a doubled quote inside them is one quote."""
    inside = F.regexp_extract(field, r'(?s)^"(.*?)"?$', 1)
    return F.when(field.startswith('"'), F.replace(inside, F.lit('""'), F.lit('"'))).otherwise(field)


def whole_line(line: Column, sep: str) -> Column:
    """The line; one that opens quotes and has an odd number of them fails, as its record goes on in the next line."""
    odd = (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1
    opens = line.startswith('"') | line.contains(sep + '"')
    broken = line.contains('"') & opens & odd
    return F.when(broken, F.raise_error(F.lit("a quoted field holds a line break, which a scan by lines cannot follow"))).otherwise(line)


def _rows_without_comments(
    spark: SparkSession, files: str | list[str], sep: str, comment: str, schema: T.StructType, order: list[Column]
) -> DataFrame:
    lines = (
        data_lines(spark, files, comment)
        .select(without_comment(F.col("value"), comment).alias("text"), *order)
        .filter(F.btrim("text") != "")
    )
    columns = ", ".join(f"{field.name} string" for field in schema)
    parsed = F.from_csv("text", columns, {"sep": sep, "escape": '"'})
    return lines.withColumn("parsed", parsed).select("parsed.*", *(["_row"] if order else []))
