import re

from pyspark.sql import functions as F

from tidegauge.llm import url_filter as U
from tidegauge.llm.queries import URL_RULES

URLS = ["http://a.example.org/en/12?x#y", "https://example.org/es/1", "http://EXAMPLE.org/en/1", "http://notexample.org/es/1", "http://x.com/fr/2", "http://x.com/de/2", "http://x.com", "ftp://x.com?/fr/",
        "no scheme", "", None, "http://org/", "http://x.com/fr", "a://b://c/d", "http://ÀÉ.com/de/", "http://" + "x" * 5000 + ".net/" + "y" * 20000, "http://x.com/\nde/", "http://x.com#/de/"]


def brute(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1], m[2]) if m else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(h + p, ok) for ok, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, key=lambda x: len(x[0]), default=(None, None))
    return host, path, *best


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)] + [(0, URLS[0]), (None, URLS[4])], "page_id long, url string").withColumns({c: F.lit("x") for c in ("host", "path", "rule", "label", "_grams")})
    labelled = spark.createDataFrame([*U.LABELLED, (None, 1), ("http://x.test", None)], "url string, blocked int")
    rows = U.verdicts(pages, URL_RULES, labelled).collect()
    assert len(rows) == len(URLS) + 2
    for r in rows:
        url = URLS[r["page_id"]] if r["page_id"] is not None else URLS[4]
        host, path, rule, allow = brute(url)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), url
        assert r["verdict"] == ("allow" if (allow if rule else r["block_score"] < 0.5) else "block")
    assert U.verdicts(pages.limit(0), URL_RULES, labelled).count() == 0


def test_held_out_urls(spark):
    labelled = spark.createDataFrame(U.LABELLED, "url string, blocked int")
    pages = spark.createDataFrame([(1, "http://buy-cheap-pills-online.test/x"), (2, "http://my-casino-bonus.test/"), (3, "http://townlibrary.test/en/4"), (4, "http://northern-museum.test/fr/8")], "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in U.verdicts(pages, [], labelled).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "allow"}


def test_no_python_in_the_plan(spark):
    labelled = spark.createDataFrame(U.LABELLED, "url string, blocked int")
    plan = U.verdicts(spark.createDataFrame([(1, "http://x")], "page_id long, url string"), URL_RULES, labelled)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_labels_hold_no_host_of_the_test_tables(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    known = {brute(r["url"])[0].removeprefix("www.").removeprefix("m.").removeprefix("blog.").split(".")[0] for r in pages.collect()} - {""}
    assert known and not known & {brute(u)[0].removeprefix("www.").removeprefix("m.").removeprefix("blog.").split(".")[0] for u, _ in U.LABELLED}
