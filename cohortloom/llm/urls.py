"""URL filter: allow and block rules, and logistic regression on hashed character n-grams where no rule fits."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Run, ascii_lower, col, table

FEATURES = 1 << 16
SIZES = (3, 4, 5)
#: Rules are conditions of one expression; longer lists belong into a table.
MAX_RULES = 1000


class Rule(NamedTuple):
    """``action`` (allow or block) for ``host``, its subdomains, and paths that start with ``path``."""

    action: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


#: Rules of the query.
RULES = (
    Rule("block", "net"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)

#: Small labelled table, made by hand: host names that are unwanted and wanted. Both kinds get domains,
#: prefixes and paths of the same forms in turn, so that these say nothing about the label.
UNWANTED = """
casino-jackpot online-casino casino-royal casinowin lucky-slots poker-bets best-bets sport-betting free-spins big-win
win-prizes cheap-meds pills-online diet-pills cheap-viagra cheap-replica pharma-cheap pillshop adult-chat adult-video
hot-adult xxx-adult adult-cams sexcams spam-links link-farm seo-farm spamfarm content-farm linkspam click-farm
ads-server track-ads ad-track adstracker click-ads track-click popup-ads free-money free-gift get-rich cheap-loans
payday-loan free-download warez-free cracked-keys win-free bets-win cheap-tickets spam-mail spam-offers tracker
""".split()
WANTED = """
news city-news garden library open-library weather university physics-dept recipes cooking travel maps museum history
science theatre river-valley forest music painting literature school hospital health-care statistics software python
chess football tennis north northwest adherent continent wandering harvesting marathon station thinning mention thorned enthusiast
gathering anthem seventeenth rethink other mother father another hinterland winter translation tithe hand land island pantheon blender
house mountain outing thorn stand notion nation ration lotion essay estate heather weathering thistle whither reading
leading sheath breath earth hearth northern southern eastern western tenth seventh fourth athens thames orchard wharf
reunion online-library free-library adult-education farm-museum track-and-field
""".split()
DOMAINS = ("example.com", "example.net", "example.org")
PREFIXES = ("", "www.", "blog.", "m.")
PATHS = ("/en/{}", "/de/{}/", "/fr/{}.html", "/es/{}?page=2", "/en/{}#top", "/en/{}?utm_source=feed", "")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(text, pattern, 1)), F.regexp_extract(text, pattern, 2)


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and action of the longest fitting rule; both null if none fits."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    if len({r.text for r in rules}) < len(rules):
        raise ValueError("two rules for one host and path")
    text, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):  # the last one set wins
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text, action = F.when(fits, rule.text).otherwise(text), F.when(fits, rule.action).otherwise(action)
    return text, action


def _with_grams(df: DataFrame, text: str, mark: str, name: str) -> DataFrame:
    """Adds the character n-grams of a text between ``^`` and ``$``, digits as 0, each behind a mark for its field.

    A text shorter than n is its only n-gram. The text is split into characters once and windows are put together from
    neighbouring ones, so the work grows with its length alone.
    """
    whole, pairs, parts = f"{name}_1", f"{name}_2", [f"{name}_{n}" for n in SIZES]
    framed = F.concat(F.lit("^"), F.translate(text, "123456789", "000000000"), F.lit("$"))
    df = df.withColumn(whole, F.regexp_extract_all(framed, F.lit("(?s)."), F.lit(0)))
    # a window of n characters is one of the first and one of the last of them
    for n, first, last in ((2, 1, 1), (3, 2, 1), (4, 2, 2), (5, 4, 1)):
        many = F.greatest(F.size(whole) - (n - 1), F.lit(0))
        ends = F.slice(F.col(f"{name}_{first}"), 1, many), F.slice(F.col(f"{name}_{last}"), first + 1, many)
        df = df.withColumn(f"{name}_{n}", F.zip_with(*ends, lambda x, y: F.concat(x, y)))
    grams = [F.when(F.size(whole) < n, F.array(F.array_join(whole, ""))).otherwise(F.col(part)) for n, part in zip(SIZES, parts)]
    marked = F.transform(F.concat(*grams), lambda gram: F.concat(F.lit(mark), gram))
    return df.withColumn(name, marked).drop(whole, pairs, *parts)


def with_features(urls: DataFrame, host: str, path: str, name: str) -> DataFrame:
    """Adds a sparse vector that marks the hashed n-grams of host and path that occur."""
    by_host, by_path, grams = name + "_host", name + "_path", name + "_grams"
    listed = _with_grams(_with_grams(urls, host, "h", by_host), path, "p", by_path).withColumn(grams, F.concat(by_host, by_path))
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol=grams, outputCol=name).transform(listed).drop(grams, by_host, by_path)


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table: url, label."""
    rows = [
        (f"http://{PREFIXES[i % 4]}{host}.{DOMAINS[i % 3]}{PATHS[i % 7].format(i)}", label)
        for hosts, label in ((UNWANTED, 1.0), (WANTED, 0.0))
        for i, host in enumerate(hosts)
    ]
    return spark.createDataFrame(rows, "url string, label double")


def fit(labelled: DataFrame, url_col: str = "url", label_col: str = "label") -> LogisticRegressionModel:
    """Logistic regression on the labelled urls; rows without label are left out."""
    host, path = split_url(col(url_col))
    rows = labelled.where(col(label_col).isNotNull()).select(
        host.alias("host"), path.alias("path"), col(label_col).cast("double").alias("label")
    )
    regression = LogisticRegression(
        featuresCol="features", labelCol="label", regParam=0.01, standardization=False, maxIter=50
    )
    return regression.fit(with_features(rows, "host", "path", "features").select("features", "label"))


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    model: LogisticRegressionModel,
    id_col: str = "page_id",
    url_col: str = "url",
    threshold: float = 0.5,
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, score.

    A page is blocked or allowed by its longest fitting rule; without one it
    is blocked if the model's score (1: unwanted) reaches the threshold. A null
    url has an empty host and path and is judged by the model. Repeated rows
    are each returned, other columns ignored.
    """
    host, path = split_url(col(url_col))
    parts = pages.select(col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    text, action = longest_rule(F.col("host"), F.col("path"), rules)
    scored = model.transform(with_features(parts, "host", "path", "features"))
    score = vector_to_array("probability")[1]
    return scored.select(F.col("id").alias(id_col), "host", "path", score.alias("score")).select(
        col(id_col),
        "host",
        "path",
        text.alias("rule"),
        F.coalesce(action, F.when(F.col("score") >= threshold, "block").otherwise("allow")).alias("verdict"),
        "score",
    )


def op3(spark, folder):
    return judge(table(spark, folder, "pages"), RULES, fit(labelled_urls(spark)))


QUERIES: dict[str, Run] = {"op3_url_filter": op3}
SQL: dict[str, str] = {}
