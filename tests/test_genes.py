import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortloom.functions.numeric import mean_with_zeros, total_of
from cohortloom.operators import genes as G
from cohortloom.sinks.features import to_wide


def brute_pairs(ids, symbols):
    """Inner join in file order, first appearance of every pair kept."""
    seen = {}
    for protein, name, _ in sorted(ids, key=lambda r: r[2]):
        for other, symbol, _ in sorted(symbols, key=lambda r: r[2]):
            if protein == other:
                seen.setdefault((name, symbol))
    return list(seen)


@pytest.mark.parametrize("seed", range(6))
def test_symbol_maps_against_brute_force(spark, seed):
    pick = random.Random(seed)
    proteins, names, symbols = "pqrs"[: 2 + seed % 3], "abcdef", "UVWXYZ"
    left = [(pick.choice(proteins), pick.choice(names), i) for i in range(25)]
    right = [(pick.choice(proteins), pick.choice(symbols), 100 + i) for i in range(25)]
    ids = spark.createDataFrame(left, "protein_id string, id string, row bigint")
    syms = spark.createDataFrame(right, "protein_id string, symbol string, row bigint")
    pairs = brute_pairs(left, right)
    assert rows(G.alias_pairs(ids, syms), "id", "symbol") == sorted(pairs, key=repr)
    assert rows(G.last_symbol_map(ids, syms), "id", "symbol") == sorted(dict(pairs).items(), key=repr)
    first = {}
    for name, symbol in pairs:
        first.setdefault(name, symbol)
    assert rows(G.first_symbol_map(ids, syms), "id", "symbol") == sorted(first.items(), key=repr)


def test_last_symbol_of_private_and_shared(spark):
    ids = spark.createDataFrame([("p", "7", 1), ("q", "7", 2), ("q", "8", 3)], "protein_id string, id string, row bigint")
    syms = spark.createDataFrame(
        [("p", "A", 1), ("p", "B", 2), ("q", "B", 3), ("q", "A", 4)], "protein_id string, symbol string, row bigint"
    )
    # Everything in q was seen in p before: B, later in p, wins for 7.
    assert rows(G.last_symbol_map(ids, syms), "id", "symbol") == [("7", "B"), ("8", "A")]


def test_last_symbol_reads_no_pairs(spark, monkeypatch):
    """Hot proteins: every id and every symbol has two, of which one holds them all; what is read stays in proportion."""
    n, bounds = 10_000, []
    read_bounds = G._read_bounds

    def watched(lists):
        places = read_bounds(lists)
        bounds.append(places.agg(F.sum("bound")).first()[0])
        return places

    monkeypatch.setattr(G, "_read_bounds", watched)
    number = spark.range(n).selectExpr("id AS n")
    own = F.concat(F.lit("q"), F.col("n").cast("string"))
    name = F.concat(F.lit("x"), F.col("n").cast("string"))

    def both(second, shift):
        hot = number.select(F.lit("p").alias("protein_id"), name.alias("name"), (F.col("n") + shift).alias("row"))
        return hot.unionByName(number.select(second.alias("protein_id"), name.alias("name"), (F.col("n") + shift + n).alias("row")))

    last = {}
    for kind, second in (("own", own), ("other", F.lit("z"))):
        ids = both(second, 0).withColumnRenamed("name", "id")
        symbols = both(second, 5 * n).withColumnRenamed("name", "symbol")
        last[kind] = {r.id: r.symbol for r in G.last_symbol_map(ids, symbols).collect()}
    assert max(bounds) <= 4 * n
    # the second protein's rows come later; what it has was seen with the first one before, so the first one's latest counts
    assert last["own"] == {f"x{i}": f"x{n - 1}" for i in range(n)} and last["other"] == last["own"]


ALIAS = [
    ("p", "7", "Ensembl_HGNC_entrez_id", 1), ("p", "A", "Ensembl_HGNC", 2), ("p", "B", "Ensembl_HGNC", 3),
    ("p", "ENSG01.3", "Ensembl_gene", 4), ("p", "C", "UniProt", 0),
]


def alias(spark, entries=ALIAS):
    return spark.createDataFrame(entries, "protein_id string, alias string, source string, row bigint")


def test_drop_takes_last_and_keep_takes_first(spark):
    table = alias(spark)
    last = G.last_symbol_map(G.entrez_aliases(table), G.symbol_aliases(table))
    first = G.first_symbol_map(G.ensembl_aliases(table), G.preferred_symbol_aliases(table))
    assert rows(last) == [("7", "B")]
    assert rows(first) == [("ENSG01", "A")]


def test_symbols_fall_back_without_hgnc(spark):
    table = alias(spark, [("p", "ENSG01", "x", 1), ("p", "12", "x", 2), ("p", "C", "UniProt", 3)])
    assert rows(G.preferred_symbol_aliases(table), "symbol") == [("C",)]


def test_apply_map(spark):
    expr = spark.createDataFrame(
        [("s", "1", "7", 1.0), ("s", "1", "9", 2.0)], "study string, sample_id string, gene string, value double"
    )
    pairs = spark.createDataFrame([("7", "B")], "id string, symbol string")
    assert rows(G.apply_gene_map(expr, pairs, "drop"), "gene") == [("B",)]
    assert rows(G.apply_gene_map(expr, pairs, "keep"), "gene") == [("9",), ("B",)]
    with pytest.raises(ValueError):
        G.apply_gene_map(expr, pairs, "other")


def test_duplicate_means(spark):
    expr = spark.createDataFrame(
        [("s", "1", "TP53", 1.0), ("s", "1", "TP53", None), ("s", "1", "X", None), ("s", "1", "X", None)],
        "study string, sample_id string, gene string, value double",
    )
    assert rows(G.mean_duplicates(expr), "gene", "value") == [("TP53", 1.0), ("X", None)]
    sums = expr.groupBy("gene").agg(total_of(expr, "value").alias("v"), mean_with_zeros(expr, "value").alias("m"))
    assert rows(sums, "gene", "v", "m") == [("TP53", 1.0, 0.5), ("X", 0.0, 0.0)]


def gene_sets(spark):
    return spark.createDataFrame(
        [("a", "G1"), ("a", "G2"), ("b", "G2"), ("b", "G3"), ("b", None), ("a", None), ("c", "G2")],
        "study string, gene string",
    )


def test_common_genes_and_index(spark):
    sets = gene_sets(spark)
    assert rows(G.common_genes(sets, ["a", "b"])) == [("G2",)]
    assert rows(G.gene_index(sets), "idx", "gene") == [(0, "G1"), (1, "G2"), (2, "G3")]
    assert rows(G.gene_overlap(sets.filter("study = 'a'").dropna(), sets.filter("study <> 'a'").dropna())) == [
        ("b", 2, 1, 2), ("c", 1, 1, 2),
    ]


def test_no_common_gene_is_an_error(spark):
    with pytest.raises(ValueError, match="no common gene"):
        G.require_genes(G.common_genes(gene_sets(spark).filter("gene <> 'G2'"), ["a", "b"]), "a, b")


def test_wide_has_one_grouping(spark):
    expr = spark.createDataFrame(
        [("A", "1", "g", 1.0), ("A", "1", "h", None), ("A", "2", "other", 3.0), ("A", None, "h", 2.0), ("A", "3", None, 5.0)],
        "study string, sample_id string, gene string, value double",
    )
    wide = to_wide(expr, ["h", "g"])
    assert wide.columns == ["study", "sample_id", "h", "g"]
    assert rows(wide) == [("A", "1", None, 1.0), ("A", "2", None, None), ("A", "3", None, None), ("A", None, 2.0, None)]
    # no grouping by samples and genes before that by samples
    assert "pivotfirst" not in wide._jdf.queryExecution().executedPlan().toString()
