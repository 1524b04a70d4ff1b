"""URLs judged by rules, and where no rule fits by a classifier.

The classifier is a logistic regression on hashed character n-grams of host
and path, trained on a small table of labelled URLs. Training touches only
that table; the judgement is a plain expression per row, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAMS = (3, 4, 5)
BUCKETS = 1 << 15
RIDGE = 1e-3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host and path from the first slash on). A rule fits its host and all subdomains.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: Hosts (below ``.test``) labelled by hand, by their words: what sells, bets, tracks or deceives, and what is there to be
#: read. No host of the test pages is among them.
BLOCKED_HOSTS = """
online-casino jackpot-casino royal-poker poker-bonus slots-jackpot lucky-lottery sports-betting bet-bonus bets-today
pills-online discount-pharmacy viagra-shop diet-pills replica-bags replica-watches cheap-loans fast-cash-loans
payday-money adult-video adult-cams xxx-movies hot-singles sex-dating click-track track-pixel ads-server popup-ads
banner-ads ad-clicks spam-links spam-mailer seo-links link-farm content-farm crack-download keygen-warez
torrent-free free-prizes win-money win-prizes free-gift-cards work-from-home-cash miracle-cure crypto-doubler
""".split()
ALLOWED_HOSTS = """
river-notes garden-letters mountain-weather history-reader library city-news open-science museum school-physics
university recipes cooking-book theatre weather thinking documentation manual software-guide mathematics literature
health-information government parliament theory gathering north-shore another-station the-thin-line other-thoughts
healthy-earth astronomy botany travel-journal railway-history music-lessons public-radio community-garden
language-notes courthouse hospital farmers-market chess-club philosophy geology
""".split()
#: What stands before and after each labelled host, alike for both kinds.
URL_FORMS = (("", "/en/1"), ("www.", "/de/2.html"), ("blog.", "/fr/3?page=2"), ("m.", "/es/4/"))
BLOCKED_URLS = [f"https://{before}{host}.test{path}" for host in BLOCKED_HOSTS for before, path in URL_FORMS]
ALLOWED_URLS = [f"https://{before}{host}.test{path}" for host in ALLOWED_HOSTS for before, path in URL_FORMS]


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, label): 1 is blocked."""
    rows = [(u, 1.0) for u in BLOCKED_URLS] + [(u, 0.0) for u in ALLOWED_URLS]
    return spark.createDataFrame(rows, "url string, label double")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path of a URL; both empty for NULL and without ``://``."""
    url, form = F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(url, form, 1), _UPPER, _LOWER), F.regexp_extract(url, form, 2)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else NULLs; of equally long ones the one with the longer host."""
    order = sorted(rules, key=lambda r: (-len(r[1]), -r[1].index("/"), r[1]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in reversed(order):
        own_host, _, own_path = text.partition("/")
        on_host = (host == own_host) | F.endswith(host, F.lit("." + own_host))
        fits = on_host & F.startswith(path, F.lit("/" + own_path))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def character_grams(text: Column, prefix: str) -> Column:
    """All n-grams of ``text`` between two marks, each with ``prefix``; no grams for an empty text."""
    marked = F.concat(F.lit("^"), text, F.lit("$"))

    def of(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(marked) - n + 1, F.lit(1)))
        return F.transform(starts, lambda i: F.concat(F.lit(prefix), F.substring(marked, i, F.lit(n))))

    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.concat(*[of(n) for n in GRAMS]))


def grams(host: Column, path: Column) -> Column:
    """N-grams of host and path; a number in the path is only a number, whichever it is."""
    return F.concat(character_grams(host, "h"), character_grams(F.regexp_replace(path, r"\d+", "0"), "p"))


def train(labelled: DataFrame, buckets: int = BUCKETS, ridge: float = RIDGE) -> PipelineModel:
    """Fit on (url, label); rows without either are left out."""
    rows = labelled.select("url", F.col("label").cast("double").alias("label")).dropna()
    hashing = HashingTF(inputCol="_grams", outputCol="_features", numFeatures=buckets, binary=True)
    rows = hashing.transform(rows.select("label", grams(*url_parts(F.col("url"))).alias("_grams"))).coalesce(1)
    regression = LogisticRegression(
        featuresCol="_features", predictionCol="_class", probabilityCol="_probability", rawPredictionCol="_raw",
        regParam=ridge, maxIter=50,
    )
    return PipelineModel([hashing, regression.fit(rows)])


def constant_answer(labelled: DataFrame) -> float | None:
    """The probability for every URL if the labels have fewer than two classes: that of the class, and 0 without labels."""
    labels = labelled.select("url", F.col("label").cast("double").alias("label")).dropna()
    low, high = labels.agg(F.min("label"), F.max("label")).first()
    return None if low != high else float(high or 0.0)


def judge(pages: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, p_block.

    The longest fitting rule decides; without one the classifier blocks from
    one half on. A URL that is NULL or has no ``://`` has empty parts, fits no
    rule, and is judged by the classifier's constant. Without labels all URLs
    are allowed that no rule blocks; labels of one class are the answer for all.
    Repeated rows give repeated rows; other columns are not read.
    """
    host, path = url_parts(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    constant = constant_answer(labelled)
    if constant is None:
        scored = train(labelled).transform(rows.withColumn("_grams", grams(F.col("host"), F.col("path"))))
        p_block = vector_to_array("_probability")[1]
    else:
        scored, p_block = rows, F.lit(constant)
    return scored.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("_said"), p_block.alias("p_block")).select(
        "page_id", "host", "path", "rule",
        F.coalesce("_said", F.when(F.col("p_block") >= 0.5, "block").otherwise("allow")).alias("verdict"),
        "p_block",
    )
