"""Table readers and the adapters that present the driver tables as the domain tables.

Every reader selects only the columns it needs, so the parquet scan prunes the rest
(ReadSchema in the plan), and filters placed on the result push down to the scan.

Adapters (identical in the SQL oracle):
  articles   documents: id=doc_id, title=first line cut to 80, url='https://'||source||'.example/'||doc_id,
             published text in the feed's own format (RFC-822 GMT for en, ISO aware for fr,
             RFC-822 +0100 for de, ISO naive otherwise) of 2024-01-01 + (doc_id*7919 mod 129600) min,
             summary=text cut to 800, content=text
  seen       labels: url_hash=sha1(url), first_seen = published + 1 day
  memo       labels with quality=1: key 'url:'||sha1(url)[:16] -> text ('article_text')
  summaries  labels with toxic=1: key 'summary:'||sha1(url)[:32] -> extractive summary ('summary')
  open titles benchmark: first 80 chars of text
  vectors    embeddings: id=vec_id
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import config as C
from feedlake.functions import text as T

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
                 "pages benchmark labels conversations").split()

EPOCH = "2024-01-01 00:00:00"
SPREAD_MINUTES = 129600  # 90 days
SPREAD_STEP = 7919       # prime, coprime with the spread, so timestamps are distinct per id


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.select(*cols) if cols else df


def true_published(doc_id) -> F.Column:
    return F.timestamp_add("MINUTE", F.pmod(T.col_(doc_id) * SPREAD_STEP, F.lit(SPREAD_MINUTES)),
                           F.lit(EPOCH).cast("timestamp"))


def published_text(ts, lang) -> F.Column:
    from feedlake.functions import dates as D
    shifted = F.timestamp_add("HOUR", F.lit(1), T.col_(ts))
    return (F.when(T.col_(lang) == "en", D.rfc822(ts))
            .when(T.col_(lang) == "fr", D.iso_utc(ts))
            .when(T.col_(lang) == "de", F.concat(F.date_format(shifted, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0100")))
            .otherwise(D.iso_naive(ts)))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    ts = true_published(F.col("doc_id"))
    return d.select(
        F.col("doc_id").alias("id"),
        T.cut(T.first_line("text"), 80).alias("title"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example/"), F.col("doc_id").cast("string")).alias("url"),
        F.col("source"),
        published_text(ts, F.col("lang")).alias("published"),
        T.cut("text", C.STORED_SUMMARY_CHARS).alias("summary"),
        F.col("text").alias("content"),
        F.col("lang"),
    )


def seen(spark: SparkSession, sf_dir: str, hash_len: int = 40) -> DataFrame:
    a = articles(spark, sf_dir).select("id", "url")
    lab = table(spark, sf_dir, "labels", "doc_id")
    return (a.join(lab, a.id == lab.doc_id, "left_semi")
            .select(T.short_hash("url", hash_len).alias("url_hash"), "url",
                    F.timestamp_add("DAY", F.lit(1), true_published(F.col("id"))).alias("first_seen")))


def memo(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = articles(spark, sf_dir).select("id", "url", "content")
    lab = table(spark, sf_dir, "labels", "doc_id", "quality").where("quality = 1")
    return (a.join(lab, a.id == lab.doc_id, "left_semi")
            .select(T.url_key("url").alias("cache_key"), F.col("content").alias("value"),
                    F.lit("article_text").alias("content_type"),
                    true_published(F.col("id")).alias("created_at")))


def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = articles(spark, sf_dir).select("id", "url", "content")
    lab = table(spark, sf_dir, "labels", "doc_id", "toxic").where("toxic = 1")
    return (T.with_summary(a.join(lab, a.id == lab.doc_id, "left_semi"), "content", "brief")
            .select(T.summary_key(T.short_hash("url")).alias("cache_key"),
                    F.col("brief").alias("value"),
                    F.lit("summary").alias("content_type"),
                    true_published(F.col("id")).alias("created_at")))


def open_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark", "text").select(T.cut("text", 80).alias("title"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings", "vec_id", "embedding").withColumnRenamed("vec_id", "id")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages", "page_id", "url", "html")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with ts as a session-zone TIMESTAMP (watermarks reject TIMESTAMP_NTZ)."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
