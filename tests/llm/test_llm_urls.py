import pytest
from conftest import rows

from cohortloom.llm import urls as U
from cohortloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model(spark):
    return U.fit(U.labelled_urls(spark))


def naive_split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def naive_rule(host, path):
    fitting = [r for r in U.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fitting, key=lambda r: len(r.text), default=None)
    return (best.text, best.action) if best else (None, None)


URLS = [
    None, "", "no scheme", "http://", "HTTP://A.NET/x", "https://example.net/en/1", "https://sub.EXAMPLE.net/en/", "http://example.net/de/1",
    "http://badexample.net/en/", "http://x.net", "http://x.net?q=/", "http://x.org/fr/y#z", "http://org/fr/", "http://xorg/fr/",
    "http://example.com/de/", "http://Ünï.com/de/", "a://b://c/d", "http://u@h:80/p?x#y", "http://h#f?/", "http://x.com/a\nb?c", "http://" + "h" * 5000,
]


def test_rules_and_parts(spark, model):
    pages = spark.createDataFrame([(i if i else None, u) for i, u in enumerate(URLS)] + [(3, URLS[3])], "page_id long, url string")
    pages = pages.selectExpr("*", "1 AS id", "2 AS host", "3 AS features", "'x' AS probability", "0 AS score")
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict, r.score) for r in U.judge(pages, U.RULES, model).collect()), key=repr)
    assert len(got) == len(URLS) + 1
    for page, host, path, rule, verdict, score in got:
        url = URLS[page or 0]
        assert (host, path) == naive_split(url)
        text, action = naive_rule(host, path)
        assert rule == text and verdict == (action or ("block" if score >= 0.5 else "allow"))
    assert U.judge(pages.limit(0), U.RULES, model).collect() == []


def test_rule_lists_are_checked(spark, model):
    pages = spark.createDataFrame([(1, "http://a/")], "page_id long, url string")
    with pytest.raises(ValueError, match="one host"):
        U.judge(pages, [U.Rule("block", "a"), U.Rule("allow", "a")], model)
    with pytest.raises(ValueError, match="more than"):
        U.judge(pages, [U.Rule("block", f"h{i}") for i in range(1001)], model)


def test_held_out_accuracy(spark, model):
    bad = "casino-club bets-online cheap-watches adult-films spam-network ads-clicks free-pills lucky-casino pills-cheap link-spam".split()
    good = "harbour-news county-library meadow physics history-of-art gardening choir village-school astronomy bakery".split()
    rows_ = [(i, f"http://www.{h}.example.com/en/{i}") for i, h in enumerate(bad + good)]
    scores = [r.score for r in U.judge(spark.createDataFrame(rows_, "page_id long, url string"), [], model).orderBy("page_id").collect()]
    right = sum(s >= 0.5 for s in scores[: len(bad)]) + sum(s < 0.5 for s in scores[len(bad) :])
    assert right >= 17


def naive_grams(host, path):
    out = set()
    for mark, text in (("h", host), ("p", path)):
        whole = "^" + "".join("0" if c in "123456789" else c for c in text) + "$"
        for n in U.SIZES:
            out |= {mark + whole[i : i + n] for i in range(max(len(whole) - n + 1, 1))}
    return out


def test_features_are_the_grams(spark):
    parts = [("", ""), ("a", "/"), ("example.com", "/en/12"), ("ünï𝄞.org", "/日本/a b\nc"), ("h" * 400, "/x" * 300)]
    table = spark.createDataFrame(parts, "host string, path string")
    from pyspark.ml.feature import HashingTF

    hashing = HashingTF(numFeatures=U.FEATURES, binary=True, inputCol="g", outputCol="v")
    want = hashing.transform(spark.createDataFrame([(h, p, sorted(naive_grams(h, p))) for h, p in parts], "host string, path string, g array<string>"))
    wanted = {(r.host, r.path): r.v for r in want.collect()}
    got = U.with_features(table, "host", "path", "f")
    assert got.columns == ["host", "path", "f"]
    assert {(r.host, r.path): r.f for r in got.collect()} == wanted


def test_long_url(spark, model):
    import time

    pages = spark.createDataFrame([(1, "http://" + "host" * 50_000 + "/" + "path/" * 160_000)], "page_id long, url string")
    began = time.perf_counter()
    assert U.judge(pages, U.RULES, model).first().verdict in ("block", "allow")
    assert time.perf_counter() - began < 30


def test_no_host_of_the_pages_was_learned_from(spark):
    hosts = {naive_split(r.url)[0] for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("url").collect()}
    assert not hosts & {naive_split(r.url)[0] for r in U.labelled_urls(spark).collect()}


def test_query(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    got = QUERIES["op3_url_filter"](spark, FOLDER).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        assert (r.host, r.path) == naive_split(pages[r.page_id])
        text, action = naive_rule(r.host, r.path)
        assert r.rule == text and r.verdict == (action or ("block" if r.score >= 0.5 else "allow"))


def test_missing_labels_are_left_out(spark):
    labelled = U.labelled_urls(spark).unionByName(spark.createDataFrame([("http://x/", None), (None, 0.0)], "url string, label double"))
    assert rows(U.judge(spark.createDataFrame([(1, None)], "page_id long, url string"), [], U.fit(labelled)), "host", "verdict") == [("", "allow")]
