"""URL filter: rules by host and path, and for the rest a ratio of two character language models. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Store, table

#: (host and path, verdict); fixed values of the query's contract.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
ORDER = 4  # longest context, in characters
STRENGTH = 4.0  # pseudo-counts that the shorter context's estimate gets in the longer one's
MARK, END = "\u0002", "\u0003"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first :// up to / ? # or the end, A-Z lower-cased; path then up to ? # or the end."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(F.coalesce(rest, F.lit("")), "^([^/?#]*)", 1)
    path = F.regexp_extract(F.coalesce(rest, F.lit("")), "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # the longest is asked first
        own, slash, below = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + below)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def padded(url: Column) -> Column:
    return F.concat(F.lit(MARK * ORDER), F.coalesce(url, F.lit("")), F.lit(END))


def places(texts: DataFrame) -> DataFrame:
    """A row for each character of `text` and one for its end: texts' columns without text, and gram, the character after the ORDER before it."""
    at = F.sequence(F.lit(1), F.length("text") + 1)
    s = padded(F.col("text"))
    return texts.withColumn("gram", F.explode(F.transform(at, lambda i: F.substr(s, i, F.lit(ORDER + 1))))).drop("text")


def chances(grams: DataFrame) -> DataFrame:
    """(gram, p_good, p_bad) of every gram of grams (gram, good, bad): P(last character | those before) in accepted and in rejected urls.

    P is each order's count smoothed by the estimate of the next shorter context; below order 0 all characters that occur are alike, so
    that a context's chances add up to 1. The shorter n-grams are the ends of the longer ones, and a context's count is that of the
    n-grams it begins. All tables grow with the distinct n-grams and meet by equi-joins.
    """
    both = [F.sum(says).alias(says) for says in ("good", "bad")]
    alphabet = grams.select(F.substr("gram", F.lit(ORDER + 1)).alias("c")).distinct().agg(F.count("*").alias("n")).scalar()
    below = None
    for k in range(ORDER + 1):
        own = grams.groupBy(F.substr("gram", F.lit(ORDER + 1 - k)).alias("gram")).agg(*both) if k < ORDER else grams
        own = own.withColumn("context", F.substr("gram", F.lit(1), F.lit(k))).withColumn("end", F.substr("gram", F.lit(2)))
        total = own.groupBy("context").agg(*[F.sum(says).alias(f"{says}_total") for says in ("good", "bad")])
        own = own.join(total, "context")
        if below is None:
            own = own.withColumns({"p_good": 1.0 / alphabet, "p_bad": 1.0 / alphabet})
        else:
            own = own.join(below.withColumnRenamed("gram", "end"), "end")
        p = {says: (F.col(says) + F.col(f"p_{says}") * STRENGTH) / (F.col(f"{says}_total") + STRENGTH) for says in ("good", "bad")}
        below = own.select("gram", p["good"].alias("p_good"), p["bad"].alias("p_bad"))
    return below


def scored(rows: DataFrame, store: Store) -> DataFrame:
    """rows (url, says, any other columns) with score: the mean ratio of a url's characters; the end counts as one.

    Rows that says is "allow" or "block" of teach. Equal urls are scored once; a null one has no character.
    """
    text = F.coalesce("url", F.lit(""))
    taught = [F.count_if(F.col("says") == says).alias(name) for says, name in (("allow", "good"), ("block", "bad"))]
    texts = store.keep(rows.groupBy(text.alias("text")).agg(*taught).withColumn("_id", F.monotonically_increasing_id()))
    grams = store.keep(places(texts.drop("_id")).groupBy("gram").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")))
    known = store.keep(chances(grams).select("gram", (F.log("p_good") - F.log("p_bad")).alias("ratio")))
    means = places(texts.select("text", "_id")).join(known, "gram").groupBy("_id").agg(F.avg("ratio").alias("score"))
    scores = store.keep(texts.join(means, "_id").select(F.col("text").alias("_text"), "score"))
    return rows.withColumn("_text", text).join(scores, "_text").drop("_text")


def judge(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict, score and threshold of every row of pages (page_id, url, any other columns).

    Urls that a rule allows or blocks teach the two models; all of them count. The threshold is where both classes'
    normal curves leave the same share on the wrong side: (m1 * s0 + m0 * s1) / (s0 + s1). Where a class has no url, the
    threshold is null and the method allows. A null url has an empty host, path and text. Repeated rows are judged alike.
    """
    store = Store(spark, "urls")
    host, path = split_url(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, says = rule_of(F.col("host"), F.col("path"))
    rows = store.keep(rows.select("*", rule.alias("rule"), says.alias("says")))
    rated = store.keep(scored(rows, store))
    by = {says: F.col("says") == says for says in ("allow", "block")}
    moments = rated.agg(
        *[f(F.when(by[says], F.col("score"))).alias(f"{name}_{says}") for says in by for name, f in (("m", F.avg), ("s", F.stddev_pop))]
    )
    spread = F.greatest(F.col("s_allow"), F.lit(1e-9)), F.greatest(F.col("s_block"), F.lit(1e-9))
    threshold = moments.select(((F.col("m_allow") * spread[1] + F.col("m_block") * spread[0]) / (spread[0] + spread[1])).alias("t")).scalar()
    out = rated.withColumn("threshold", threshold)
    method = F.when(F.col("threshold").isNull() | (F.col("score") >= F.col("threshold")), "allow").otherwise("block")
    return out.select("page_id", "host", "path", "rule", F.coalesce("says", method).alias("verdict"), "score", "threshold")


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url; see judge()."""
    return judge(spark, table(spark, sf_dir, "pages"))
