"""Many text files of different headers and separators in one scan.

What differs between the files is data: their headers and separators are tables, joined to the lines. So the number
of jobs does not depend on the number of files.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import strip
from .tables import SEPARATORS, data_lines, first_lines, split_fields, unquote

#: Separators that are tried, in this order, where none of the usual ones splits a header.
RARE_SEPARATORS = ("|", " ", ":")


def list_files(spark: SparkSession, catalog: DataFrame) -> DataFrame:
    """(path, file, name) of the files behind every ``path`` of a catalogue: the file itself, or those of a folder.

    ``file`` is what ``_metadata.file_path`` says, ``name`` what a reader takes; both are NULL where nothing is there.
    Spark lists the folders that hold the paths; only the names of these folders reach the driver.
    """
    parent = F.regexp_replace("path", "/+[^/]*/*$", "")
    folders = {}
    for row in catalog.select(parent.alias("parent")).distinct().collect():
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(row["parent"] or "/")
        system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if system.exists(place):
            folders[row["parent"]] = system.makeQualified(place).toString().rstrip("/")
    if not folders:
        return catalog.select("path", F.lit(None).cast("string").alias("file"), F.lit(None).cast("string").alias("name"))
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(sorted(set(folders.values())))
        .select(F.col("path").alias("name"), F.col("_metadata.file_path").alias("file"))
        .distinct()
    )
    # a path is a file or a folder of files
    whole = found.select("*", F.explode(F.array("name", F.regexp_replace("name", "/[^/]*$", ""))).alias("target"))
    known = spark.createDataFrame(list(folders.items()), "parent string, qualified string")
    wanted = catalog.select("path", parent.alias("parent"), F.regexp_extract("path", "([^/]*)/*$", 1).alias("last"))
    targets = wanted.join(known, "parent", "left").withColumn("target", F.concat_ws("/", "qualified", "last"))
    return targets.join(whole, "target", "left").select("path", "file", "name")


def literal_path(name: str) -> str:
    """A file's name as the readers take it, which look for patterns in names."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", name)


def set_aside_unreadable(
    files: dict[str, str], work: Callable[[list[str]], DataFrame | None]
) -> tuple[DataFrame | None, dict[str, str]]:
    """Result of ``work`` on the files (file: name) that can be read, and why the others cannot.

    Spark names the file that it fails on. Such a file is put aside and the work done again without it; any other
    failure is raised. So a run costs one attempt more for every unreadable file, and none for readable ones.
    """
    bad: dict[str, str] = {}
    while True:
        left = {file: name for file, name in files.items() if file not in bad}
        if not left:
            return None, bad
        try:
            return work([literal_path(name) for name in left.values()]), bad
        except Exception as error:  # noqa: BLE001 - the cause is told from its text
            text = str(error)
            failed = re.search(r"FAILED_READ_FILE.*? reading file (.*?)\.\s+SQLSTATE", text)
            named = [file for file in left if failed and _bare(file) == _bare(failed[1])]
            if not named:
                raise
            causes = re.findall(r"Caused by: ([^\n]+)", text)
            bad[named[0]] = "cannot be read: " + (causes[-1] if causes else text.splitlines()[0])


def _bare(file: str) -> str:
    """A file's address with one slash after the scheme, however many it was written with."""
    return re.sub(r"^(\w+):/+", r"\1:/", file)


def by_separator(sep: Column, line: Column) -> Column:
    """Fields of a line whose separator stands in another column."""
    first, *rest = (*SEPARATORS, *RARE_SEPARATORS)
    chain = F.when(sep == first, split_fields(line, first))
    for other in rest:
        chain = chain.when(sep == other, split_fields(line, other))
    return chain


def headers_of(spark: SparkSession, files: Sequence[str], comment: str | None = None) -> DataFrame:
    """(file, sep, idx, name) of the columns of every file, from its first line that is neither blank nor a comment.

    The separator is the first of comma, tab, semicolon, bar, blank and colon that splits the header. Names are
    stripped, empty ones named by their place, repeated ones (in any case) numbered.
    """
    first = first_lines(spark, files, comment)
    splits = [F.when(F.size(split_fields(F.col("header"), s)) > 1, F.lit(s)) for s in (*SEPARATORS, *RARE_SEPARATORS)]
    named = (
        first.withColumn("sep", F.coalesce(*splits, F.lit(SEPARATORS[0])))
        .select("file", "sep", F.posexplode(by_separator(F.col("sep"), F.col("header"))).alias("idx", "field"))
        .select("file", "sep", "idx", strip(unquote(F.col("field"))).alias("name"))
    )
    unnamed = F.concat(F.lit("Unnamed: "), F.col("idx").cast("string"))
    named = named.withColumn("name", F.when(F.col("name") == "", unnamed).otherwise(F.col("name")))
    again = F.row_number().over(Window.partitionBy("file", F.lower("name")).orderBy("idx")) - 1
    numbered = F.concat("name", F.lit("."), again.cast("string"))
    return named.select("file", "sep", "idx", F.when(again > 0, numbered).otherwise(F.col("name")).alias("name"))


def lines_of(spark: SparkSession, files: Sequence[str], comment: str | None = None) -> DataFrame:
    """(file, value) of the lines after the header of every file."""
    return data_lines(spark, list(files), comment).select(F.col("_metadata.file_path").alias("file"), "value")
