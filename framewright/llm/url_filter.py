"""URL filter: rules on host and path, and for the rest logistic regression
on hashed character n-grams of host and path.  All of it is DataFrame
expressions, training too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 4096
SIZES = (3, 4, 5)
ROUNDS = 12
RATE = 1.0

#: Rules (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

#: Words that the labelled URLs are made of: unwanted and wanted hosts, some of
#: either with a hyphen.  None of them is a host of the driver's pages.
UNWANTED = (
    "casino-slots", "online-casino", "royalcasino", "poker-bonus", "pokernight", "win-cash", "bigwin", "lucky-win",
    "free-spins", "free-money", "freegift", "sport-bets", "betsonline", "sure-bets", "ads-serve", "popads", "banner-ads",
    "click-track", "trackpixel", "spam-mail", "bulkspam", "link-farm", "content-farm", "cheap-meds", "cheapwatches", "cheap-loans",
    "diet-pills", "bluepills", "buy-pills", "adult-chat", "adultcams", "xxx-cams", "replica-bags", "quick-loan",
)
WANTED = (
    "city-library", "library", "thunder", "old-theatre", "theatre", "museum", "nation", "weather-station", "weather", "motion", "university", "heritage",
    "recipes", "family-recipes", "station", "gathering", "news", "daily-news", "research", "monthly", "school", "high-school", "garden", "travel-notes",
    "hat-shop", "thatched-roof", "youth-club", "south-coast", "habitat", "history", "astronomy", "book-club", "gardening", "tourist-office", "meadow", "thirteen", "therapist", "ninth-street", "together",
)


def labelled_urls(spark: SparkSession) -> DataFrame:
    """A small labelled table (url, label 1: unwanted), made from UNWANTED and
    WANTED over prefixes, domains, languages and page numbers."""
    words = F.array_union(F.array([F.struct(F.lit(w).alias("w"), F.lit(1).alias("y")) for w in UNWANTED]), F.array([F.struct(F.lit(w).alias("w"), F.lit(0).alias("y")) for w in WANTED]))

    def each(*values: str) -> Column:
        return F.explode(F.array([F.lit(v) for v in values]))

    frame = spark.range(1).select(F.explode(words).alias("x")).select("x.w", "x.y")
    frame = frame.withColumn("pre", each("", "www.", "m.", "blog.")).withColumn("end", each("com", "net", "org"))
    page = F.pmod(F.xxhash64("w", "pre", "end"), F.lit(900)).cast("string")
    lang = F.element_at(F.array([F.lit(x) for x in ("en", "de", "fr", "es")]), (F.pmod(F.xxhash64("pre", "end", "w"), F.lit(4)) + 1).cast("int"))
    return frame.select(F.concat(F.lit("http://"), "pre", "w", F.lit(".example."), "end", F.lit("/"), lang, F.lit("/"), page).alias("url"), "y")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to /, ?, # or the end, A-Z lower-cased; "" if
    null or without ``://``."""
    raw = F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the host's end up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as (name, verdict), or null."""
    best = F.lit(None).cast("struct<name:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        best = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("name"), F.lit(verdict).alias("verdict"))).otherwise(best)
    return best


def features(host: Column, path: Column, buckets: int = BUCKETS, sizes: tuple[int, ...] = SIZES) -> Column:
    """The distinct buckets (1 up) of the character n-grams of host and path,
    and bucket 1 always, as bias.  Digits of the path count as 0."""

    def of(text: Column, kind: str, n: int) -> Column:
        count = F.length(text) - n + 1
        return F.when(
            count > 0,
            F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: F.pmod(F.xxhash64(F.lit(kind), F.substring(text, i, F.lit(n))), F.lit(buckets - 1)).cast("int") + 2),
        ).otherwise(F.array().cast("array<int>"))

    host = F.concat(F.lit("^"), host, F.lit("$"))
    path = F.regexp_replace(path, "[0-9]+", "0")
    return F.array_distinct(F.concat(F.array(F.lit(1)), *[of(host, "h", n) for n in sizes], *[of(path, "p", n) for n in sizes]))


def probability(found: Column, weights: list[float]) -> Column:
    """Of being unwanted, from the buckets found."""
    w = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")  # folded into one constant
    score = F.aggregate(found, F.lit(0.0), lambda total, i: total + F.element_at(w, i))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score / F.sqrt(F.size(found).cast("double"))))


def trained(labelled: DataFrame, buckets: int = BUCKETS, rounds: int = ROUNDS, rate: float = RATE) -> list[float]:
    """Weights by full-batch gradient steps, scaled per bucket by its count.
    The labelled table is small by contract; what comes to the driver is one
    number per bucket and round."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = labelled.where("y is not null").select("y", features(host, path, buckets).alias("found")).coalesce(1).cache()
    counts = {r["i"]: r["n"] for r in rows.select(F.explode("found").alias("i")).groupBy("i").agg(F.count("*").alias("n")).collect()}
    weights = [0.0] * buckets
    for _ in range(rounds):
        wrong = F.col("y") - probability(F.col("found"), weights)
        steps = rows.select(wrong.alias("e"), F.sqrt(F.size("found").cast("double")).alias("z"), F.explode("found").alias("i")).groupBy("i").agg(F.sum(F.col("e") / F.col("z")).alias("g")).collect()
        for r in steps:
            weights[r["i"] - 1] += rate * 20.0 * r["g"] / (counts[r["i"]] + 10.0)
    rows.unpersist()
    return weights


def judged(urls: DataFrame, labelled: DataFrame, rules=RULES, url_col: str = "url", threshold: float = 0.5) -> DataFrame:
    """All columns of ``urls`` but those of these names, and host, path, rule
    (the longest that fits, else null), unwanted (the model's probability,
    null where a rule decides) and verdict (allow or block).

    A null url or one without ``://`` has an empty host and path and is judged
    by the model's bias alone.  Repeated rows are judged alike.  No shuffle.
    """
    weights = trained(labelled)
    kept = [F.col(f"`{c}`") for c in urls.columns if c not in ("host", "path", "rule", "verdict", "unwanted")]
    rows = urls.select(*kept, host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rows = rows.withColumn("__rule", rule_of(F.col("host"), F.col("path"), rules))
    rows = rows.withColumn("unwanted", F.when(F.col("__rule").isNull(), probability(features(F.col("host"), F.col("path")), weights)))
    verdict = F.coalesce(F.col("__rule.verdict"), F.when(F.col("unwanted") >= threshold, "block").otherwise("allow"))
    return rows.withColumn("rule", F.col("__rule.name")).withColumn("verdict", verdict).drop("__rule")
