"""End-to-end batch jobs.

brief_batch: the whole per-article run as one lazy plan over every unseen item of a batch
  items -> keys/dates -> unseen (anti join) -> article text chain (memo/page lookups) ->
  extractive summary (or cached summary) -> keyword counts -> insight -> markdown / SEO rows.
  Actions happen only where the caller writes.
home_feed: latest-N cards + static features -> flat rows / one JSON document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import config as C
from feedlake.functions import dates as D
from feedlake.functions import text as T
from feedlake.operators import insight as I
from feedlake.operators import mentions as MN
from feedlake.operators import select as S
from feedlake.operators import similar as SIM
from feedlake.operators import snapshots as SN
from feedlake.operators import sparse as SP
from feedlake.operators import state as ST
from feedlake.session import written
from feedlake.sinks import export as X
from feedlake.sources import pages as P
from feedlake.sources import tables as TB

AS_OF = "2024-04-01 00:00:00"
RUN_TS = "2024-04-01 06:30:00"


def ensure_utc(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def keyed_articles(spark: SparkSession, sf_dir: str, hash_len: int = 40) -> DataFrame:
    """Archive/batch articles with url_hash (hash of the link, else title) and published_ts."""
    a = TB.articles(spark, sf_dir)
    return (a.withColumn("url_hash", ST.item_key("url", "title", hash_len))
             .withColumn("published_ts", D.parse_published("published")))


def article_keys(spark: SparkSession, sf_dir: str, hash_len: int = 40) -> DataFrame:
    """(id, url, url_hash, published_ts) without reading the text when it is not needed.

    The key is the hash of the link, else of the title. The adapter's link is empty only when
    `source` is NULL, so the rows with a source are keyed from (doc_id, source) alone, and only
    the NULL-source rows read the text for the title (IsNull pushed to the scan, where row-group
    null counts skip the rest). Same keys as keyed_articles."""
    base = TB.table(spark, sf_dir, "documents", "doc_id", "source", "lang")
    url = F.concat(F.lit("https://"), F.col("source"), F.lit(".example/"), F.col("doc_id").cast("string"))
    ts = D.parse_published(TB.published_text(TB.true_published(F.col("doc_id")), F.col("lang")))
    linked = base.where(F.col("source").isNotNull()).select(
        F.col("doc_id").alias("id"), url.alias("url"), T.short_hash(url, hash_len).alias("url_hash"), ts.alias("published_ts"))
    orphan = (TB.table(spark, sf_dir, "documents", "doc_id", "source", "lang", "text").where(F.col("source").isNull())
              .select(F.col("doc_id").alias("id"), url.alias("url"),
                      ST.item_key(url, T.cut(T.first_line("text"), 80), hash_len).alias("url_hash"), ts.alias("published_ts")))
    return linked.unionByName(orphan)


def newest_articles(spark: SparkSession, sf_dir: str, n: int = C.HOME_FEED_SIZE) -> DataFrame:
    """The n newest articles. The sort reads keys alone; its n ids (the feature's own limit) then filter
    the scan that reads the text, so row groups without them are skipped."""
    ids = [r[0] for r in S.latest_n(article_keys(spark, sf_dir).select("id", "published_ts"), n).select("id").collect()]
    return keyed_articles(spark, sf_dir).where(F.col("id").isin(ids))


def archive_text(articles: DataFrame) -> DataFrame:
    return articles.select("id", T.search_text("title", "summary", "content").alias("text"), "published_ts")


def page_text_by_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages keyed by the article url they belong to (page_id = article id)."""
    a = TB.articles(spark, sf_dir).select("id", "url")
    p = P.page_text(TB.pages(spark, sf_dir).select("page_id", "html"))
    return p.join(a, p.page_id == a.id, "inner").select("url", "page_text", "full_text")


def article_keywords(articles: DataFrame) -> DataFrame:
    """(id, pos, keyword) from the title keywords."""
    return articles.select("id", F.posexplode(T.title_keywords("title")).alias("pos", "keyword")) \
                   .select("id", F.col("pos").cast("long").alias("pos"), "keyword")


def keyword_counts(batch: DataFrame, archive: DataFrame) -> DataFrame:
    return MN.keyword_article_counts(article_keywords(batch), archive_text(archive).select("id", "text"))


def similar_articles(batch: DataFrame, archive: DataFrame, k: int = C.SIMILAR_K_INSIGHT) -> DataFrame:
    """(qid, rank, id, score): for each article of the batch, which is part of the archive, the k most similar of the
    archive by tf-idf vectors of their own texts (summary and content)."""
    texts = archive.select("id", T.embedding_text("summary", "content").alias("embed_text"))
    counts = written(SP.term_counts(texts), "term-counts")
    return SP.sparse_topk(counts.join(batch.select("id"), "id", "left_semi"), counts, k, model=SP.fit_counts(counts))


def evidence(batch: DataFrame, archive: DataFrame, summary_chars: int) -> DataFrame:
    """(qid, evidence) of the articles of a batch that is part of the archive."""
    return I.evidence_text(SIM.enrich_hits(similar_articles(batch, archive), archive), summary_chars)


def brief_batch(spark: SparkSession, sf_dir: str, hash_len: int = 40) -> DataFrame:
    """Every item with its unseen flag; unseen items carry article text, brief content and
    the heuristic insight. Columns: id, title, url, source, published, published_ts, url_hash,
    is_unseen, text_path, cached_summary, article_text, content, insight."""
    arts = keyed_articles(spark, sf_dir, hash_len)
    seen = TB.seen(spark, sf_dir, hash_len)
    flagged = arts.join(seen.select("url_hash").withColumn("_seen", F.lit(True)), "url_hash", "left") \
                  .withColumn("is_unseen", F.col("_seen").isNull()).drop("_seen")
    cand = flagged.where("is_unseen").select(
        "id", "title", F.col("url").alias("link"), "summary", "url_hash")
    chain = S.article_text_chain(cand, TB.summaries(spark, sf_dir), TB.memo(spark, sf_dir),
                                 page_text_by_url(spark, sf_dir), hash_len)
    briefs = T.with_summary(chain, "article_text", "_brief") \
        .withColumn("content", F.coalesce("cached_summary", "_brief")).drop("_brief")
    kv = I.keyword_count_pairs(keyword_counts(cand, arts))
    ins = I.heuristic_insight(cand.select("id", "title", "summary"), kv).select("id", "insight")
    out = (flagged.withColumnRenamed("summary", "feed_summary").drop("content")
           .join(briefs.select("id", "text_path", "cached_summary", "article_text", "content"), "id", "left")
           .join(ins, "id", "left"))
    return out.select("id", "title", "url", "source", "published", "published_ts", "url_hash", "is_unseen",
                      "feed_summary", "text_path", "cached_summary", "article_text", "content", "insight")


def home_feed(spark: SparkSession, sf_dir: str, as_of: str = AS_OF, n: int = C.HOME_FEED_SIZE) -> DataFrame:
    """Flat home-feed rows (section, pos, title, summary, date, read_time, url, source)."""
    arts = newest_articles(spark, sf_dir, n).select("id", "title", "summary", "published", "source", "published_ts")
    top = S.latest_n(arts, n)
    from pyspark.sql import Window
    ranked = top.withColumn("pos", (F.row_number().over(Window.orderBy(*S.recency_order())) - 1))
    cards = X.home_cards(ranked.withColumnRenamed("published_ts", "published_iso_ts"), as_of, keep=("pos",))
    return X.home_feed_rows(cards, X.static_features(spark))


def run_brief_batch(spark: SparkSession, sf_dir: str, out_dir: str, run_ts: str = RUN_TS,
                    hash_len: int = 40, buckets: int = 64) -> dict:
    """The whole run for a batch, written out:

      out_dir/briefs     parquet, one row per unseen item (text path, brief, insight), by date
      out_dir/markdown   parquet (id, md_name, markdown), one row per brief, by date
      out_dir/seo        parquet SEO / JSON-LD rows
      out_dir/seen       versioned seen table, briefed items inserted if absent (C1)
      out_dir/memo       versioned memo table, summaries and article texts upserted (C3)
      out_dir/vector_model   the model behind the text vectors, fitted once on the archive
      out_dir/articles   versioned article table, whole rows replaced (C2), with a 384-d
                         text vector per article (G2)
      out_dir/prompts    prompt rows of the briefed items (G7), with the similar articles of that table

    The brief frame is checkpointed (reliable checkpoint in the shared checkpoint folder) so the
    exports and merges reuse it without recomputing the lineage, and a lost executor only
    recomputes from the checkpoint. Metrics are collected with an Observation during the
    briefs write (no extra pass). Returns the metrics."""
    from pyspark.sql import Observation

    from feedlake.session import checkpoint_dir, path_exists
    checkpoint_dir(spark)
    ensure_utc(spark)
    batch = brief_batch(spark, sf_dir, hash_len)
    cand = ST.keep_first(batch.where("is_unseen"), "url_hash", ["id"])  # a second item of one link is skipped
    cand = cand.withColumn("date", D.date_slug(F.lit(run_ts).cast("timestamp")))
    cand = cand.checkpoint(eager=True)

    obs = Observation("brief_batch")
    observed = cand.observe(obs, F.count(F.lit(1)).alias("candidates"),
                            F.count("content").alias("summaries"),
                            F.count("cached_summary").alias("cache_reused"),
                            F.sum(F.length("insight")).alias("insight_chars"))
    observed.write.mode("overwrite").partitionBy("date").parquet(f"{out_dir}/briefs")

    md = X.markdown_brief(cand.select("id", "title", F.col("url").alias("link"),
                                      F.col("feed_summary").alias("summary"),
                                      "content", "date"), run_ts)
    md.withColumn("date", D.date_slug(F.lit(run_ts).cast("timestamp"))).write.mode("overwrite").partitionBy("date").parquet(f"{out_dir}/markdown")

    seo_in = cand.select("id", "title", F.substring("feed_summary", 1, C.SEO_SUMMARY_CHARS).alias("summary"),
                         F.col("published").alias("date_iso"),
                         F.concat(F.lit("previews/"), F.col("date"), F.lit("-"), F.col("id").cast("string"),
                                  F.lit(".html")).alias("url_path"),
                         F.col("source").alias("author"), T.title_tags("title").alias("tags"))
    X.seo_metadata(seo_in).write.mode("overwrite").parquet(f"{out_dir}/seo")

    seen_path, memo_path = f"{out_dir}/seen", f"{out_dir}/memo"
    if not SN.exists(spark, seen_path):
        SN.create(spark, seen_path, TB.seen(spark, sf_dir, hash_len), "url_hash", buckets)
    new_seen = cand.select("url_hash", "url", F.lit(run_ts).cast("timestamp").alias("first_seen"))
    SN.merge(spark, seen_path, new_seen, ["first_seen"], mode="keep_first")

    memo_rows = (cand.where(F.col("content").isNotNull() & F.col("cached_summary").isNull())  # written on a miss only
                 .select(T.summary_key("url_hash").alias("cache_key"), F.col("content").alias("value"),
                         F.lit("summary").alias("content_type"))
                 .unionByName(cand.where((F.col("text_path") == "page_text") & T.truthy("article_text").isNotNull())
                              .select(T.url_key("url").alias("cache_key"), F.col("article_text").alias("value"),
                                      F.lit("article_text").alias("content_type")))
                 .withColumn("created_at", F.lit(run_ts).cast("timestamp")))
    if not SN.exists(spark, memo_path):
        SN.create(spark, memo_path, TB.memo(spark, sf_dir), "cache_key", buckets)
    # one row per key: a summary and a page text have keys of their own
    SN.merge(spark, memo_path, memo_rows, ["content_type"], mode="keep_last")

    from feedlake.functions.dates import iso_utc
    from pyspark.ml import PipelineModel

    from feedlake.operators.similar import fit_text_vectors, text_vectors
    arts = cand.where(F.col("content").isNotNull()).select(
        F.col("url_hash").alias("id"), "title", "url", "source",
        F.coalesce(T.truthy("published"), iso_utc(F.lit(run_ts).cast("timestamp"))).alias("published"),
        T.cut(F.coalesce("feed_summary", F.lit("")), C.STORED_SUMMARY_CHARS).alias("summary"),
        F.coalesce("article_text", F.lit("")).alias("content"))
    model_path = f"{out_dir}/vector_model"
    if not path_exists(spark, model_path):  # one model for all batches, fitted on the archive
        archive = TB.articles(spark, sf_dir).select(T.embedding_text("summary", "content").alias("embed_text"))
        fit_text_vectors(archive).save(model_path)
    arts = text_vectors(arts.withColumn("embed_text", T.embedding_text("summary", "content")), model=PipelineModel.load(model_path)).drop("embed_text")
    arts = arts.withColumn("saved_at", F.lit(run_ts).cast("timestamp"))
    art_path = f"{out_dir}/articles"
    if not SN.exists(spark, art_path):
        SN.create(spark, art_path, arts.limit(0), "id", buckets)
    arts = written(arts, "new-articles")
    SN.merge(spark, art_path, arts, ["saved_at"], mode="keep_last")

    # the saved articles are found again: evidence from the table's own vectors, the new ones among them
    archive = SN.read(spark, art_path)
    hits = SIM.cosine_topk(arts, archive, C.SIMILAR_K_INSIGHT)
    ev = I.evidence_text(SIM.enrich_hits(hits, archive), C.EVIDENCE_SUMMARY_CHARS)
    kv = I.keyword_count_pairs(MN.keyword_article_counts(article_keywords(arts), archive.select(T.search_text("title", "summary", "content").alias("text"))))
    I.insight_prompt(arts, ev, kv).write.mode("overwrite").parquet(f"{out_dir}/prompts")
    return dict(obs.get)
