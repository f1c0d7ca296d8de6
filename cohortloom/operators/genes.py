"""Gene identifiers: alias maps, duplicate genes, gene sets and their order."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import mean_of
from ..functions.text import drop_ensembl_version, strip
from ..session import settle
from .ordering import with_position

SAMPLE_KEYS = ("study", "sample_id")


def entrez_aliases(alias: DataFrame) -> DataFrame:
    """(protein_id, id, row) of the numeric gene ids in an alias table."""
    return alias.filter(F.col("source") == "Ensembl_HGNC_entrez_id").select(
        "protein_id", F.col("alias").alias("id"), "row"
    )


def symbol_aliases(alias: DataFrame) -> DataFrame:
    """(protein_id, symbol, row) of the official symbols in an alias table."""
    return alias.filter(F.col("source") == "Ensembl_HGNC").select(
        "protein_id", F.col("alias").alias("symbol"), "row"
    )


def ensembl_aliases(alias: DataFrame) -> DataFrame:
    """(protein_id, id, row) of the Ensembl ids, without their version."""
    name = strip(F.col("alias"))
    return alias.filter(name.startswith("ENSG")).select(
        "protein_id", drop_ensembl_version(name).alias("id"), "row"
    )


def preferred_symbol_aliases(alias: DataFrame) -> DataFrame:
    """(protein_id, symbol, row) of the names that are no id; HGNC sources only, if there are any."""
    name = strip(F.col("alias"))
    named = alias.filter(~name.startswith("ENSG") & ~name.rlike(r"^\d+$")).withColumn("symbol", name)
    hgnc = F.lower("source").contains("hgnc")
    any_hgnc = named.agg(F.coalesce(F.max(hgnc), F.lit(False)).alias("any_hgnc")).scalar()
    return named.filter(hgnc | ~any_hgnc).select("protein_id", "symbol", "row")


def alias_pairs(ids: DataFrame, symbols: DataFrame) -> DataFrame:
    """Distinct (id, symbol) pairs that share a protein."""
    left = ids.select("protein_id", "id").dropna().distinct()
    right = symbols.select("protein_id", "symbol").dropna().distinct()
    return left.join(right, "protein_id").select("id", "symbol").distinct()


def first_symbol_map(ids: DataFrame, symbols: DataFrame) -> DataFrame:
    """(id, symbol): the pair that appears first in the id-symbol join.

    Only the first symbol of a protein can win, so each protein is reduced to
    one row before the join and no pair list is built.
    """
    left = _first_rows(ids, "id")
    right = (
        symbols.dropna(subset=["protein_id", "symbol"])
        .groupBy("protein_id")
        .agg(F.min_by("symbol", "row").alias("symbol"), F.min("row").alias("right_row"))
    )
    return (
        left.join(right, "protein_id")
        .groupBy("id")
        .agg(F.min_by("symbol", F.struct("first_row", "right_row")).alias("symbol"))
    )


def last_symbol_map(ids: DataFrame, symbols: DataFrame) -> DataFrame:
    """(id, symbol): of the distinct pairs, the one whose first appearance is latest.

    Exact without forming the pairs of a protein. Let an id's proteins stand in
    the order of its rows, latest first. Its symbol is the latest of the first
    protein that has one which no later protein of the list has too, as a pair
    appears first in the last protein that both share. So ids with the same
    list have the same symbol, and of every protein its symbols are read from
    the latest on, down to a bound: a symbol that no other protein has, or one
    more than the following proteins have in all, ends the search.
    """
    ranked = _ranked_symbols(symbols)
    sizes = ranked.groupBy("protein_id").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.when(~F.col("shared"), F.col("rank"))).alias("own_rank")
    )
    placed = _first_rows(ids, "id").join(sizes, "protein_id")
    member = F.struct("first_row", "protein_id", "n", "own_rank")
    listed = placed.groupBy("id").agg(F.sort_array(F.collect_list(member), asc=False).alias("members"))
    known = settle(listed.withColumn("proteins", F.col("members.protein_id")), "protein-lists")

    # an id of one protein takes that protein's latest symbol
    top = ranked.filter("rank = 1").select("protein_id", "symbol")
    alone = known.filter("size(proteins) = 1").select("id", F.col("proteins")[0].alias("protein_id")).join(top, "protein_id")

    several = known.filter("size(proteins) > 1")
    lists = several.groupBy("proteins").agg(F.first("members").alias("members"))
    lists = settle(lists.withColumn("list", F.monotonically_increasing_id()), "lists")
    places = _read_bounds(lists)
    wanted = places.withColumn("rank", F.explode(F.sequence(F.lit(1).cast("bigint"), "bound"))).drop("bound")
    read = wanted.join(ranked.select("protein_id", "rank", "symbol"), ["protein_id", "rank"])
    later = places.select("list", F.col("place").alias("later_place"), F.col("protein_id").alias("later_protein"))
    has = ranked.select(F.col("protein_id").alias("later_protein"), "symbol")
    taken = read.join(later, "list").filter("later_place > place").select("list", "place", "symbol", "later_protein").join(
        has, ["later_protein", "symbol"], "left_semi"
    )
    free = read.join(taken.select("list", "place", "symbol").distinct(), ["list", "place", "symbol"], "left_anti")
    best = free.groupBy("list").agg(F.min_by("symbol", F.struct("place", "rank")).alias("symbol"))
    chosen = several.select("id", "proteins").join(lists.select("proteins", "list"), "proteins").join(best, "list")
    return alone.select("id", "symbol").unionByName(chosen.select("id", "symbol"))


def _read_bounds(lists: DataFrame) -> DataFrame:
    """(list, place, protein_id, bound): how many symbols of the proteins of a list have to be read, from the latest on."""
    places = lists.select("list", F.posexplode("members").alias("place", "m"), "members")
    following = F.aggregate(F.expr("slice(members, place + 2, size(members))"), F.lit(0).cast("bigint"), lambda total, m: total + m["n"])
    bound = F.least("m.n", F.coalesce("m.own_rank", "m.n"), following + 1)
    return places.select("list", "place", "m.protein_id", bound.alias("bound"))


def _ranked_symbols(symbols: DataFrame) -> DataFrame:
    """(protein_id, symbol, rank, shared): symbols of a protein from the latest on; ``shared`` ones have several proteins."""
    places = _first_rows(symbols, "symbol")
    proteins = places.groupBy("symbol").agg((F.count(F.lit(1)) > 1).alias("shared"))
    rank = F.row_number().over(Window.partitionBy("protein_id").orderBy(F.desc("first_row"))).cast("bigint")
    return settle(places.withColumn("rank", rank).join(proteins, "symbol").drop("first_row"), "ranked-symbols")


def _first_rows(aliases: DataFrame, name: str) -> DataFrame:
    return (
        aliases.dropna(subset=["protein_id", name])
        .groupBy(name, "protein_id")
        .agg(F.min("row").alias("first_row"))
    )


def apply_gene_map(
    expr: DataFrame, gene_map: DataFrame, unmatched: Literal["drop", "keep"]
) -> DataFrame:
    """Replace gene ids by symbols; ids without a symbol are dropped or kept as they are."""
    if unmatched not in ("drop", "keep"):
        raise ValueError(f"unmatched must be 'drop' or 'keep', not {unmatched!r}")
    pairs = gene_map.select(F.col("id").alias("gene"), "symbol")
    joined = expr.join(pairs, "gene", "inner" if unmatched == "drop" else "left")
    return joined.withColumn("gene", F.coalesce("symbol", "gene")).drop("symbol").select(*expr.columns)


def mean_duplicates(expr: DataFrame, keys: Sequence[str] = (*SAMPLE_KEYS, "gene")) -> DataFrame:
    """One value per sample and gene: the mean of the present values, whatever the order of the rows."""
    return expr.groupBy(*keys).agg(mean_of(expr, "value").alias("value"))


def genes_of(expr: DataFrame) -> DataFrame:
    return expr.select("study", "gene").distinct()


def common_genes(expr: DataFrame, studies: Sequence[str]) -> DataFrame:
    """Genes that every named study has. One shuffle on the gene, pre-aggregated."""
    present = [F.max(F.col("study") == study).alias(f"in_{i}") for i, study in enumerate(studies)]
    shared = F.lit(True)
    for i in range(len(studies)):
        shared = shared & F.col(f"in_{i}")
    return (
        expr.filter(F.col("study").isin(*studies) & F.col("gene").isNotNull())
        .groupBy("gene")
        .agg(*present)
        .filter(shared)
        .select("gene")
    )


def require_genes(genes: DataFrame, what: str) -> DataFrame:
    """Store a gene set and fail when it is empty (an action, on the stored set)."""
    stored = settle(genes, "genes")
    if stored.isEmpty():
        raise ValueError(f"no common gene found: {what}")
    return stored


def gene_index(genes: DataFrame) -> DataFrame:
    """(idx, gene) of distinct genes in sorted order, stored."""
    return with_position(genes.select("gene").dropna().distinct(), ["gene"]).select("idx", "gene")


def on_genes(expr: DataFrame, genes: DataFrame) -> DataFrame:
    """Measurements of the given genes; a gene a sample lacks stays absent."""
    return expr.join(genes.select("gene"), "gene", "left_semi").select(*expr.columns)


def gene_overlap(main: DataFrame, extra: DataFrame) -> DataFrame:
    """Per study of ``extra``: genes of the main set, of the study, and of both.

    ``main`` is (gene), ``extra`` is (study, gene); the counts come from one join.
    """
    main_genes = main.select("gene").distinct()
    n_main = main_genes.agg(F.count(F.lit(1))).scalar()
    return (
        genes_of(extra)
        .join(main_genes.withColumn("in_main", F.lit(1)), "gene", "left")
        .groupBy("study")
        .agg(F.count(F.lit(1)).alias("n_extra_genes"), F.count("in_main").alias("n_common_genes"))
        .withColumn("n_main_genes", n_main)
    )
