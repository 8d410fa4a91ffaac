"""Keyword counts and series as a maintained aggregate: the archive's postings, kept up to date.

The table (versions, see snapshots.py) holds one row for each article: its id, its time and the list of its distinct runs.
An update is one commit, so one that dies has not happened, and one that is repeated adds nothing. An update cuts only articles that are not indexed yet; counts and
series read the postings, never the texts. An article is indexed once: later changes of its text are not seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import config as C
from feedlake.config import LIMITS
from feedlake.operators import mentions as MN
from feedlake.operators import snapshots as SN
from feedlake.session import spread

BUCKETS = 16


def _few(ids: DataFrame, n: int) -> DataFrame:
    """A join side of n ids: broadcast up to the bound, so that the texts stay where they are."""
    return F.broadcast(ids) if n <= MN.LOOKUP * LIMITS.broadcast_rows else ids


def _one_each(rows: DataFrame, several: DataFrame, n: int) -> DataFrame:
    """rows(id, ts, text), of the n ids in `several` the row of the smallest text alone. Only the texts of these are shuffled."""
    if not n:
        return rows
    own = rows.join(_few(several, n), "id", "left_semi").groupBy("id").agg(F.min(F.struct("text", "ts")).alias("a")).select("id", "a.ts", "a.text")
    return rows.join(_few(several, n), "id", "left_anti").select(*own.columns).unionByName(own)


def update(spark: SparkSession, path: str, articles: DataFrame, ts_col: str = "published_ts") -> int:
    """Index those of articles(id, text lowered, ts) that are not indexed; how many they are. Of several rows of an id the
    one of the smallest text counts. A null text has no runs, a null time counts at the series' as_of."""
    new = articles.select("id", F.col(ts_col).alias("ts"), "text").where(F.col("id").isNotNull())
    if SN.exists(spark, path):
        known = indexed(spark, path).select("id")
        new = new.join(_few(known, known.count()), "id", "left_anti")
    ids = new.groupBy("id").agg(F.count(F.lit(1)).alias("c"))
    facts = ids.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("c") > 1, 1)).alias("several")).first()
    n = facts["n"]
    one = _one_each(spread(new), ids.where("c > 1").select("id"), facts["several"])
    runs = MN.postings(one.where("text is not null"), ["id", "ts"])
    rows = runs.unionByName(one.where("text is null").select("id", "ts", F.array().cast("array<string>").alias("runs")))
    if not SN.exists(spark, path):
        SN.create(spark, path, rows, "id", BUCKETS)
    elif n:
        SN.append(spark, path, rows, f"{n} articles")
    return n


def indexed(spark: SparkSession, path: str) -> DataFrame:
    """(id, ts) of the articles of the index."""
    return SN.read(spark, path).select("id", "ts")


def _counts(keywords: DataFrame, articles: DataFrame, carry: list[str]) -> DataFrame:
    return MN.literal_counts(articles.select("runs", *carry), keywords.select("kw").where("kw is not null").distinct(), carry, articles)


def counts(spark: SparkSession, path: str, keywords: DataFrame) -> DataFrame:
    """(kw, n): articles of the index that contain each keyword `kw` (lowered); keywords without any are absent."""
    return _counts(keywords, SN.read(spark, path), [])


def series(spark: SparkSession, path: str, keywords: DataFrame, days: int = C.MENTION_BIN_DAYS, as_of=None) -> DataFrame:
    """(keyword, bin_start, mentions) as mentions.mention_series gives it for the articles of the index."""
    table = SN.read(spark, path)
    kw = keywords.select("keyword").distinct().withColumn("kw", F.lower("keyword"))
    articles, origin, last = MN.archive_bins(table, "ts", days, as_of)
    if origin is None:
        return kw.select("keyword", F.lit(None).cast("timestamp").alias("bin_start"), F.lit(0).cast("long").alias("mentions")).limit(0)
    start = F.lit(origin).cast("timestamp")
    n = _counts(kw, articles, ["bin_start"])
    spine = kw.withColumn("bin_start", F.explode(F.sequence(start, F.lit(last).cast("timestamp"), F.expr(f"INTERVAL {int(days)} DAYS"))))
    return spine.join(n, ["kw", "bin_start"], "left").select("keyword", "bin_start", F.coalesce("n", F.lit(0)).cast("long").alias("mentions"))
