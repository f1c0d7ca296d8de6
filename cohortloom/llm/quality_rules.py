"""Quality rules: surface counts of a text, and a hashed n-gram log-likelihood ratio against trusted texts.

Word unigrams and bigrams are hashed into a fixed number of buckets. Two
multinomials over the buckets are counted, one from at most MAX_TRUSTED trusted texts
and one from all texts; the mean of log(trusted / raw) over the n-grams of a document
decides, by a fixed threshold. Only built-in functions are used.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, Run, ahead, col, exploded, hash_pair, paired, table, with_windows, words

BUCKETS = 32_768
SMOOTHING = 1.0
#: Trusted documents that the target multinomial is fitted on at most.
MAX_TRUSTED = 50_000
WINDOW = 5
#: Mean log-likelihood ratio from which a document is kept. Junk has n-grams that trusted texts hardly hold.
THRESHOLD = -0.12
SYMBOLS = "#*$%&|<>"


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def hashed_ngrams(word_hashes: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of all unigrams and bigrams, from the hashes of the words in order."""
    pairs = paired(word_hashes, 1, lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(buckets)))
    return F.concat(F.transform(word_hashes, lambda h: F.pmod(h, F.lit(buckets))), pairs)


def ratios(
    docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str, buckets: int = BUCKETS, max_trusted: int = MAX_TRUSTED
) -> list[float]:
    """log(trusted / raw) of every bucket, to six decimals; raw counts all documents, trusted a bounded number of them.

    ``trusted`` holds the ids of trusted documents; repeats and nulls do not
    matter. The trusted multinomial is fitted on ``max_trusted`` of them at
    most, those with the least hashes, so that their ids can be broadcast and
    no text is shuffled; the raw one counts every document. What reaches the
    driver is one row per bucket, however large the corpus.
    """
    chosen = trusted.select(col(id_col)).where(col(id_col).isNotNull()).distinct()
    chosen = chosen.orderBy(F.xxhash64(col(id_col)), col(id_col)).limit(max_trusted)
    marked = F.broadcast(chosen.withColumn("trusted", F.lit(1)))
    hashed = (
        docs.select(col(id_col), col(text_col).alias("text"))
        .join(marked, id_col, "left")
        .select("trusted", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("hashes"))
    )
    grams = exploded(hashed, hashed_ngrams(F.col("hashes"), buckets), "bucket", "trusted")
    counts = {
        r["bucket"]: (r["n"], r["t"] or 0)
        for r in grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("trusted").alias("t")).collect()
    }
    raw = sum(n for n, _ in counts.values()) + SMOOTHING * buckets
    target = sum(t for _, t in counts.values()) + SMOOTHING * buckets
    out = []
    for bucket in range(buckets):
        n, t = counts.get(bucket, (0, 0))
        out.append(round(log((t + SMOOTHING) / target) - log((n + SMOOTHING) / raw), 6))
    return out


def with_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and ``_hashes`` to a table with a text column.

    n_repeat_words counts the words inside 5-word windows that the text holds
    twice or more. Windows are told apart by a 64-bit hash. Only texts that
    have a repeated window pay for finding its places, by one sort.
    """
    text = F.coalesce(col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    first = docs.select(
        "*",
        F.transform(words(col(text_col)), lambda w: F.xxhash64(w)).alias("_hashes"),
        F.length(_without(text, BLANKS)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(_without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
    )
    counted = first.select(
        "*",
        F.size("_hashes").cast("long").alias("n_words"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
    ).drop("_lines")
    counted = with_windows(counted, "_hashes", "_windows", WINDOW, hash_pair)
    # (hash, place) in order, if any hash occurs twice
    placed = counted.select(
        "*",
        F.when(
            F.size("_windows") > F.size(F.array_distinct("_windows")),
            F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("p")))),
        ).alias("_sorted"),
    ).drop("_windows")
    twice = F.flatten(
        paired(
            F.col("_sorted"),
            1,
            lambda a, b: F.when(a["h"] == b["h"], F.array(a["p"], b["p"])).otherwise(F.array().cast("array<int>")),
        )
    )
    places = placed.select("*", F.sort_array(F.array_distinct(twice)).alias("_places")).drop("_sorted")
    # each place adds the words up to the next place, at most the window
    gaps = F.zip_with(
        F.col("_places"), ahead(F.col("_places"), 1), lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW))
    )
    return places.select(
        "*", F.coalesce(F.aggregate(gaps, F.lit(0).cast("long"), lambda s, g: s + g), F.lit(0)).alias("n_repeat_words")
    ).drop("_places")


def judge(
    docs: DataFrame,
    trusted: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    buckets: int = BUCKETS,
) -> DataFrame:
    """One row per document: id, the counts, base_failed, llr (mean log-likelihood ratio, null without words), kept.

    Null texts count as empty; they fail the base rules (under ten words).
    Repeated rows are each judged, other columns ignored. A bucket that no
    document has counts as seen SMOOTHING times on both sides, so an empty
    trusted table makes every ratio finite.
    """
    weights = F.expr(f"array({', '.join(f'{x:.6f}D' for x in ratios(docs, trusted, id_col, text_col, buckets))})")
    counted = with_counts(docs.select(col(id_col).alias("_id"), col(text_col).alias("_text")), "_text")
    scored = counted.select("*", hashed_ngrams(F.col("_hashes"), buckets).alias("_grams"))
    total = F.aggregate(
        F.col("_grams"), F.lit(0.0), lambda s, g: s + F.get(weights, g.cast("int"))
    )
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    out = scored.select(
        F.col("_id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        F.when(F.size("_grams") > 0, total / F.size("_grams")).alias("llr"),
    )
    return out.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("llr") >= threshold, F.lit(False)))


def op6(spark, folder):
    trusted = table(spark, folder, "labels").where("quality = 1")
    return judge(table(spark, folder, "documents"), trusted)


QUERIES: dict[str, Run] = {"op6_quality_rules": op6}
SQL: dict[str, str] = {}
