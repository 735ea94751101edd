"""URL filter: host and path rules first, then logistic regression on hashed character n-grams.

The model learns from a small labelled URL table, here one made of fixed names; any table with ``url``
and ``label`` (1: block) can be given instead. Host and path are cut into n-grams that
carry their part's name, so the same letters weigh differently in a host and in a path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sellerlens.llm.common import ascii_lower, read

# (verdict, host and path); the longest that fits wins.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)

# The labelled URL table is made of fixed words: what sites and pages that a reviewer would block are about, and others.
BLOCKED = (
    "casino poker slots jackpot roulette blackjack bets betting bookmaker gambling lottery wager viagra cialis pills pharma "
    "steroids slimming replica warez crack keygen serials torrent phishing malware spyware botnet spam seolinks "
    "adware popup adserver adtrack clickbait porn xxx adult escort nude sexcam webcam fetish payday loans "
    "forex getrich cashback freebies giveaway"
).split()
ALLOWED = (
    "library museum school weather university newspaper cooking garden music travel science hospital "
    "council books theatre health forest history language therapy station nation writer "
    "encyclopedia teacher northern mother other information question method ether "
    "theory thread three another leather rather father southern thesis hearing thunder "
    "international relations notions motion action lotion rations ocean nature culture earth north "
    "winter freedom farming birds lexicon essays software address adventure education xylophone law pillow "
    "bibliothek schule zeitung wetter universite musee hopital jardin biblioteca escuela noticias tiempo "
    "docs blog wiki forum contact about archive calendar research community"
).split()
# Words that say nothing stand beside the others, and top-level labels on either side; few of them lean to one.
NEUTRAL = "my best online world top the go net city first open live club new get".split()
TOPS = "com net org info eu de fr es io example".split()
BLOCKED_TOPS = "casino bet xxx porn win loan click top".split()
ALLOWED_TOPS = "edu gov museum int".split()

BUCKETS = 1 << 15
MIN_GRAM, MAX_GRAM = 3, 5
THRESHOLD = 0.5


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://``; both empty without one or for a null URL."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest)), r"^([^?#]*)", 1)
    return ascii_lower(host), path


def best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest fitting rule as struct(rule, verdict), else null.

    A rule fits its host and every subdomain when the path begins with the rule's path.
    """
    choice = F.lit(None).cast("struct<rule:string,verdict:string>")
    ordered = sorted(rules, key=lambda r: (len(r[1]), r[1], r[0]))
    for verdict, rule in ordered:
        rule_host, slash, rest = rule.partition("/")
        fits = F.concat(F.lit("."), host).endswith(f".{rule_host}") & path.startswith(slash + rest)
        choice = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
                        ).otherwise(choice)
    return choice


def _grams(text: Column, mark: str) -> Column:
    """All n-grams of ``^text$`` behind ``mark``; no gram for an empty text."""
    padded = F.concat(F.lit("^"), text, F.lit("$"))
    none = F.array().cast("array<string>")

    def of_size(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(padded) - n + 1)
        cut = F.transform(starts, lambda i: F.concat(F.lit(f"{mark}{n}"), padded.substr(i, F.lit(n))))
        return F.when(F.length(padded) >= n, cut).otherwise(none)

    sizes = [of_size(n) for n in range(MIN_GRAM, MAX_GRAM + 1)]
    return F.when(text == "", none).otherwise(F.concat(*sizes))


def _featured(df: DataFrame, host: Column, path: Column) -> DataFrame:
    """``df`` with the hashed n-gram presence vector of the whole host and path in ``_features``."""
    grams = df.withColumn("_grams", F.concat(_grams(host, "h"), _grams(ascii_lower(path), "p")))
    hashing = HashingTF(
        inputCol="_grams", outputCol="_features", numFeatures=BUCKETS, binary=True
    )
    return hashing.transform(grams).drop("_grams")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The labelled table of ``url`` and ``label``: each word in several hosts, and in paths of hosts that say nothing.

    Either part decides: a blocked word in the path of any host is blocked, and so is any path of a
    host with such a word. Hosts have plain paths of the same kinds on both sides.
    """
    rows = []
    for label, words, tops in ((1.0, BLOCKED, BLOCKED_TOPS), (0.0, ALLOWED, ALLOWED_TOPS)):
        for i, word in enumerate(words):
            one, two, three = (NEUTRAL[(i + k) % len(NEUTRAL)] for k in (0, 5, 9))
            top, other, leaning = TOPS[i % len(TOPS)], TOPS[(i + 3) % len(TOPS)], tops[i % len(tops)]
            mate = words[(i + 7) % len(words)]
            rows += [
                (f"http://www.{word}.{top}/", label), (f"https://{word}-{one}.{other}/en/{17 * i}.html", label),
                (f"https://{two}{word}.{top}/a/{i}/", label), (f"http://{word}{i}.{leaning}/index?page={i}", label),
                (f"http://blog.{mate}{word}.{other}/de/{i}/", label),
                (f"https://www.{three}{one}.{top}/{word}/{two}-{i}.html", label),
                (f"http://{two}.{other}/{one}/{mate}-{word}/", label),
            ]
    # Hosts and paths that say nothing, and short ones.
    for i, (one, two) in enumerate((a, b) for a in NEUTRAL for b in NEUTRAL if a != b):
        top = TOPS[i % len(TOPS)]
        rows.append((f"http://{('www.', 'm.', 'blog.', '')[i % 4]}{one}{two}.{top}/{('en', 'de', 'fr', 'es')[i % 4]}/{31 * i}", 0.0))
    return spark.createDataFrame(rows, "url string, label double")


def train(labelled: DataFrame) -> LogisticRegressionModel:
    """The model for a table of ``url`` and ``label``; rows without a label are left out.

    Both labels weigh the same, however many rows they have.
    """
    host, path = url_parts(F.col("url"))
    rows = labelled.filter("label IS NOT NULL").select(
        F.col("label").cast("double").alias("_label"), host.alias("_h"), path.alias("_p")
    )
    blocked = rows.agg(F.avg("_label")).first()[0] or 0.5
    share = F.when(F.col("_label") == 1, F.lit(blocked)).otherwise(F.lit(1 - blocked))
    learn = _featured(rows, F.col("_h"), F.col("_p")).withColumn("_weight", 0.5 / share)
    return LogisticRegression(
        featuresCol="_features", labelCol="_label", weightCol="_weight", regParam=0.001, maxIter=60,
        standardization=False,
    ).fit(learn.coalesce(1))


def filter_urls(
    pages: DataFrame,
    model: LogisticRegressionModel,
    rules: Sequence[tuple[str, str]] = RULES,
) -> DataFrame:
    """page_id, host, path, rule, verdict, score for every row; no shuffle, no Python on the executors.

    ``score`` is the model's probability that a page is to be blocked. A null or malformed URL has
    empty host and path, fits no rule and is judged by the model's bias alone. Repeated rows
    are judged alike; other columns are not looked at.
    """
    host, path = url_parts(F.col("url"))
    parted = pages.select("page_id", host.alias("host"), path.alias("path"))
    judged = model.setFeaturesCol("_features").setProbabilityCol("_p").transform(
        _featured(parted, F.col("host"), F.col("path"))
    )
    score = vector_to_array("_p")[1]
    best = best_rule(F.col("host"), F.col("path"), rules)
    by_model = F.when(score >= THRESHOLD, "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path",
        best["rule"].alias("rule"),
        F.coalesce(best["verdict"], by_model).alias("verdict"),
        score.alias("score"),
    )


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read(spark, sf_dir, "pages"), train(labelled_urls(spark)))
