"""Gene sets of studies as stored bitmaps.

Every gene has a number for good; the genes of a study are bits, 32 768 of them (4 KB) a row. Sets are compared
without the measurements: a cohort is added by reading its own genes alone, and no earlier one is read again.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle
from .genes import genes_of
from .ordering import with_position


class GeneSets(NamedTuple):
    #: (idx, gene): the number of every gene ever seen, from 0; numbers never change.
    index: DataFrame
    #: (study, bucket, genes): bitmaps; a study may have several rows of a bucket, which count together.
    bitmaps: DataFrame


def _bucket(idx: Column) -> Column:
    return F.bitmap_bucket_number(idx + 1)


def _place(idx: Column) -> Column:
    return F.bitmap_bit_position(idx + 1)


def extend_index(index: DataFrame | None, genes: DataFrame) -> DataFrame:
    """The index, stored, with the genes that it lacks behind those it has, in sorted order."""
    wanted = genes.select("gene").dropna().distinct()
    if index is None:
        return settle(with_position(wanted, ["gene"]).select(F.col("idx").cast("bigint").alias("idx"), "gene"), "gene-numbers")
    after = index.agg(F.coalesce(F.max("idx") + 1, F.lit(0))).scalar()
    new = with_position(wanted.join(index, "gene", "left_anti"), ["gene"]).withColumn("idx", F.col("idx") + after)
    return settle(index.select("idx", "gene").unionByName(new.select("idx", "gene")), "gene-numbers")


def bitmaps_of(genes: DataFrame, index: DataFrame) -> DataFrame:
    """(study, bucket, genes) of (study, gene); every gene must be in the index."""
    return (
        genes.join(index, "gene").groupBy("study", _bucket(F.col("idx")).alias("bucket"))
        .agg(F.bitmap_construct_agg(_place(F.col("idx"))).alias("genes"))
    )


def add_genes(expr: DataFrame, known: GeneSets | None = None) -> GeneSets:
    """Gene sets with those of the studies of ``expr`` (study, gene, ...) added; only ``expr`` is read, once."""
    own = settle(genes_of(expr).dropna(subset=["gene"]), "genes")
    index = extend_index(known.index if known else None, own)
    made = settle(bitmaps_of(own, index), "gene-bitmaps")
    return GeneSets(index, known.bitmaps.unionByName(made) if known else made)


def write_gene_sets(sets: GeneSets, path: str) -> None:
    """Store the sets as two tables."""
    sets.index.write.mode("overwrite").parquet(f"{path}/genes")
    sets.bitmaps.write.mode("overwrite").parquet(f"{path}/bitmaps")


def read_gene_sets(spark: SparkSession, path: str) -> GeneSets:
    return GeneSets(spark.read.parquet(f"{path}/genes"), spark.read.parquet(f"{path}/bitmaps"))


def common_bitmap(sets: GeneSets, studies: Sequence[str]) -> DataFrame:
    """(bucket, genes) of the genes that every named study has; reads the bitmaps alone."""
    wanted = list(dict.fromkeys(studies))
    per_study = _per_study(sets.bitmaps.filter(F.col("study").isin(*wanted)))
    return (
        per_study.groupBy("bucket")
        .agg(F.bitmap_and_agg("genes").alias("genes"), F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") == len(wanted)) & (F.bitmap_count("genes") > 0))
        .select("bucket", "genes")
    )


def _per_study(bitmaps: DataFrame) -> DataFrame:
    return bitmaps.groupBy("study", "bucket").agg(F.bitmap_or_agg("genes").alias("genes"))


def genes_in(bitmap: DataFrame, index: DataFrame) -> DataFrame:
    """(idx, gene) of the set bits of (bucket, genes)."""
    place = _place(F.col("idx"))
    byte = F.conv(F.hex(F.substring("genes", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    met = index.withColumn("bucket", _bucket(F.col("idx"))).join(bitmap, "bucket")
    return met.filter(F.getbit(byte, (place % 8).cast("int")) == 1).select("idx", "gene")


def common_genes_of(sets: GeneSets, studies: Sequence[str]) -> DataFrame:
    """(gene) that every named study has, as ``common_genes`` gives it, without the measurements."""
    return genes_in(common_bitmap(sets, studies), sets.index).select("gene")


def overlap_of_sets(main: DataFrame, sets: GeneSets) -> DataFrame:
    """Per study: genes of the bitmap ``main`` (bucket, genes), of the study, and of both; as ``gene_overlap``."""
    own = _per_study(sets.bitmaps)
    sizes = own.groupBy("study").agg(F.sum(F.bitmap_count("genes")).alias("n_extra_genes"))
    both = own.unionByName(own.select("study", "bucket").join(main, "bucket").select("study", "bucket", "genes"))
    met = both.groupBy("study", "bucket").agg(F.bitmap_and_agg("genes").alias("genes"), F.count(F.lit(1)).alias("n"))
    common = met.filter("n = 2").groupBy("study").agg(F.sum(F.bitmap_count("genes")).alias("n_common_genes"))
    n_main = main.agg(F.coalesce(F.sum(F.bitmap_count("genes")), F.lit(0))).scalar()
    return sizes.join(common, "study", "left").select(
        "study", "n_extra_genes", F.coalesce("n_common_genes", F.lit(0).cast("bigint")).alias("n_common_genes"), n_main.alias("n_main_genes")
    )
