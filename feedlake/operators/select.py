"""Ordering, newest-N, candidate selection, article-text fallback chain, duplicate-title
suppression.

Ordered top-N is `orderBy(...).limit(n)`, which Catalyst plans as TakeOrderedAndProject: each
partition keeps its own n best rows and only n * partitions rows reach the final merge.
Every order has a unique tie-break column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake import config as C
from feedlake.functions import text as T
from feedlake.operators.state import unseen


def recency_order(ts_col: str = "published_ts", tie: str = "id"):
    """Newest first; unparsable dates (NULL) sort as the oldest; ties broken by `tie`."""
    return [F.col(ts_col).desc_nulls_last(), F.col(tie).asc()]


def recency_sort(items: DataFrame, ts_col: str = "published_ts", tie: str = "id") -> DataFrame:
    return items.orderBy(*recency_order(ts_col, tie))


def latest_n(items: DataFrame, n: int = C.HOME_FEED_SIZE, ts_col: str = "published_ts", tie: str = "id") -> DataFrame:
    return items.orderBy(*recency_order(ts_col, tie)).limit(n)


def newest_unseen(items: DataFrame, seen: DataFrame, n: int | None = None, key: str = "url_hash",
                  ts_col: str = "published_ts", tie: str = "id") -> DataFrame:
    """Unseen items, newest first. The original takes n=1; a batch takes all (n=None)."""
    out = recency_sort(unseen(items, seen, key), ts_col, tie)
    return out if n is None else out.limit(n)


def page_slices(items: DataFrame, ts_col: str = "published_ts", tie: str = "id",
                size: int = C.HOME_FEED_SIZE, recent: int = C.RECENT_SLICE) -> DataFrame:
    """Latest card (pos 0) and the next `recent` cards of the newest `size` (pos 1..recent).
    Positions come from a row_number over at most `size` rows (already limited)."""
    top = latest_n(items, size, ts_col, tie)
    from pyspark.sql import Window
    w = Window.orderBy(*recency_order(ts_col, tie))
    ranked = top.withColumn("pos", F.row_number().over(w) - 1)
    return (ranked.where(F.col("pos") <= recent)
            .withColumn("slot", F.when(F.col("pos") == 0, F.lit("latest")).otherwise(F.lit("recent"))))


def article_text_chain(items: DataFrame, summary_memo: DataFrame, text_memo: DataFrame,
                       page_text: DataFrame, hash_len: int = 40) -> DataFrame:
    """Text handed to the summariser, per item (columns link, title, summary):

      cached summary hit -> cached article text, else the feed summary;
      miss -> the feed summary when longer than 200 chars, else the page text (memo first,
              then the fetched page, cut to 6000), else the feed summary.

    `page_text` has (url, page_text). Adds content_hash, cached_summary, article_text, text_path.
    """
    it = (items.withColumn("content_hash", T.short_hash(T.first_truthy("link", "title"), hash_len))
          .withColumn("_skey", T.summary_key("content_hash"))
          .withColumn("_ukey", T.url_key("link")))
    sm = summary_memo.select(F.col("cache_key").alias("_skey"), T.truthy("value").alias("cached_summary"))
    tm = text_memo.select(F.col("cache_key").alias("_ukey"), T.truthy("value").alias("_memo_text"))
    pt = page_text.select(F.col("url").alias("link"), T.truthy("page_text").alias("_page_text"))
    j = it.join(sm, "_skey", "left").join(tm, "_ukey", "left").join(pt, "link", "left")
    feed = F.col("summary")
    long_feed = T.truthy(feed).isNotNull() & (F.length(feed) > C.FEED_SUMMARY_MIN_CHARS)
    fetched = T.truthy(F.when(T.truthy("link").isNull(), F.lit(""))
                       .otherwise(T.cut(F.coalesce("_memo_text", "_page_text"), C.ARTICLE_TEXT_CHARS)))
    hit = F.col("cached_summary").isNotNull()
    text = (F.when(hit, F.coalesce(F.col("_memo_text"), F.coalesce(feed, F.lit(""))))
            .when(long_feed, feed)
            .otherwise(F.coalesce(fetched, F.coalesce(feed, F.lit("")))))
    path = (F.when(hit & F.col("_memo_text").isNotNull(), F.lit("summary_hit_memo_text"))
            .when(hit, F.lit("summary_hit_feed_summary"))
            .when(long_feed, F.lit("feed_summary"))
            .when(T.truthy("link").isNotNull() & F.col("_memo_text").isNotNull(), F.lit("memo_text"))
            .when(T.truthy("link").isNotNull() & F.col("_page_text").isNotNull(), F.lit("page_text"))
            .otherwise(F.lit("feed_fallback")))
    return j.withColumn("article_text", text).withColumn("text_path", path).drop("_skey", "_ukey", "_memo_text", "_page_text")


SNIPPET_PROBE = 8


def title_duplicates_removed(items: DataFrame, open_titles: DataFrame, title_col: str = "title",
                             snippet_chars: int = C.TITLE_SNIPPET_CHARS) -> DataFrame:
    """Drop items whose title snippet (first 60 chars, case-insensitive) occurs inside an open
    title; an empty snippet matches any open title.

    One plan at every size: each distinct open title is expanded to its windows of up to
    SNIPPET_PROBE characters, items are matched to them by the snippet's first SNIPPET_PROBE
    characters (all of a shorter one), and the anti join verifies the whole snippet. An empty
    snippet is its own probe, which every open title has."""
    snip = F.lower(T.cut(F.coalesce(F.col(title_col), F.lit("")), snippet_chars))
    it = items.withColumn("_snip", snip).withColumn("_probe", F.substring("_snip", 1, SNIPPET_PROBE))
    ot = open_titles.select(F.lower(F.coalesce("title", F.lit(""))).alias("_open")).distinct()
    sizes = F.array(*(F.lit(n) for n in range(1, SNIPPET_PROBE + 1)))
    windows = (ot.withColumn("_n", F.explode(sizes)).where(F.length("_open") >= F.col("_n"))
               .select("_open", F.explode(F.array_distinct(F.transform(
                   F.sequence(F.lit(1), F.length("_open") - F.col("_n") + 1), lambda i: F.substring(F.col("_open"), i, F.col("_n"))))).alias("_probe")))
    windows = windows.unionByName(ot.limit(1).withColumn("_probe", F.lit("")))
    return (it.join(windows, (it["_probe"] == windows["_probe"]) & F.contains(windows["_open"], it["_snip"]), "left_anti")
            .drop("_snip", "_probe"))
