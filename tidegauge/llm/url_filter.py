"""URL filter: rules first, then logistic regression on hashed character n-grams of host and path.

Only DataFrame functions and Spark ML stages, which run in the JVM. The model is trained on a small labelled URL table
that the caller gives; n-grams keep their field (host or path), so the same letters count apart in either.

A rule (allow, host, path) fits its host and all subdomains if the URL's path starts with the rule's; the longest
``host + path`` wins, of equals the first in the list. Without a fitting rule the model decides: block from ``threshold``.
Null URLs and URLs without ``://`` have an empty host and path and, fitting no rule, the model's verdict on the empty
text. Repeated rows stay, an empty table gives an empty result, null ids stay null. Columns other than page_id and url are ignored.
If the labelled table has a single class, that class is every verdict of the model.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SIZES = (3, 4, 5)

#: Labelled URLs, 1 for those to block: written by hand from words that are common in either kind, without hosts of the test tables.
LABELLED = [(u, 1) for u in """
https://www.cheap-meds.test/buy/2 http://online-pills-shop.test/en/44 https://pharma-cheap.test/viagra https://best-casino.test/bonus
http://casino-jackpot.test/en/12 https://m.win-casino.test/slots/3 http://sports-bets.test/free https://bets-live.test/en/90
http://free-spins.test/de/5 https://link-farm.test/en/3 http://seo-spam.test/fr/81 https://spam-links.test/es/2
http://xxx-adult.test/cam/3 https://adult-chat.test/en/6 http://hot-adult-x.test/fr/4 https://track-ads.test/pixel/1
http://ad-click.test/en/70 https://ads-banner.test/redirect/5 http://free-money.test/win/2 https://payday-loans.test/apply
http://loan-fast.test/cheap https://replica-watches.test/buy/4 http://luckyslots.test/play https://pokerbonus.test/join/4
http://www.viagrashop.test/order http://bestreplicas.test/buy/9 https://quick-cash-now.test/apply/3 http://sexcams.test/live/1
https://m.clickbanner.test/go/7 http://win-lottery.test/claim
""".split()] + [(u, 0) for u in """
https://www.library.test/en/catalogue/12 http://university.test/en/courses/31 https://museum.test/fr/expo/7 http://blog.gardener.test/en/66
https://news.northern.test/en/2019/4 https://townhall.test/de/amt/8 http://weather.test/es/madrid/3 https://blog.tension.test/en/58
https://www.other.test/de/71 https://blog.northwest.test/fr/8 https://history.test/en/archive/77 http://mathematics.test/en/lecture/5
https://rivers.test/de/elbe/1 http://bridges.test/en/640 https://www.recipes.test/fr/soupe/3 http://linguistics.test/en/480
https://earth.test/es/978 https://blog.reading.test/en/18 http://cathedral.test/fr/5 http://orient.test/de/37
https://city-archive.test/en/maps/4 http://old-town-choir.test/de/konzert https://book-club.test/en/list/12 http://www.open-data.test/fr/9
https://school.test/en/term/3 http://blog.astronomy.test/en/88 https://harbour.test/es/barcos http://clinic.test/en/hours
""".split()]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/ ? #`` or the end, A-Z lowered. Path: from there up to ``? #`` or the end."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"\A[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[bool, str, str]]) -> tuple[Column, Column]:
    """The longest rule's text and whether it allows; null if none fits. The rules are a list of the program, not data."""
    text, allows = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for allow, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        longer = [r for r in rules if r[1] + r[2] == rule_host + rule_path]
        if longer[0] != (allow, rule_host, rule_path):
            continue
        text, allows = F.when(fits, F.lit(rule_host + rule_path)).otherwise(text), F.when(fits, F.lit(allow)).otherwise(allows)
    return text, allows


def _grams(text: Column, field: str) -> list[Column]:
    """All overlapping character n-grams, found by one look-ahead pattern for each size."""
    ends = F.concat(F.lit("\x02"), text, F.lit("\x03"))
    return [F.transform(F.regexp_extract_all(ends, F.lit(f"(?s)(?=(.{{{n}}}))"), 1), lambda g: F.concat(F.lit(field), g)) for n in SIZES]


def features(df: DataFrame, buckets: int) -> DataFrame:
    grams = F.concat(*_grams(F.col("host"), "h"), *_grams(F.col("path"), "p"))
    return HashingTF(inputCol="_grams", outputCol="_features", numFeatures=buckets, binary=True).transform(df.withColumn("_grams", grams)).drop("_grams")


def train(labelled: DataFrame, buckets: int = 1 << 14) -> LogisticRegressionModel:
    """Fit on a table (url, blocked 0/1)."""
    host, path = host_and_path(F.col("url"))
    rows = labelled.filter(F.col("blocked").isNotNull()).select(host.alias("host"), path.alias("path"), F.col("blocked").cast("double").alias("label"))
    return LogisticRegression(featuresCol="_features", regParam=0.001, maxIter=100, standardization=False).fit(features(rows, buckets))


def verdicts(pages: DataFrame, rules: Sequence[tuple[bool, str, str]], labelled: DataFrame, threshold: float = 0.5, buckets: int = 1 << 14) -> DataFrame:
    """Host, path, fitting rule, verdict and the model's probability of ``block`` for each page."""
    model = train(labelled, buckets)
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    model.setFeaturesCol("_features").setRawPredictionCol("").setPredictionCol("").setProbabilityCol("_probability")
    scored = model.transform(features(rows, buckets))
    text, allows = fitting_rule(F.col("host"), F.col("path"), rules)
    chance = vector_to_array("_probability").getItem(1)
    allowed = F.coalesce(allows, chance < threshold)
    return scored.select("page_id", "host", "path", text.alias("rule"), F.when(allowed, "allow").otherwise("block").alias("verdict"), chance.alias("block_score"))
