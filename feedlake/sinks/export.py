"""Exports: markdown briefs, home-feed cards and document, JSON-LD/SEO metadata, sitemap
entries, artifact names, run metrics.

Row-wise exports are columns written with partitioned `write.text` (one file set per date, no
driver round trip). The two single-document exports (home feed, sitemap) are built as one
row by an aggregate over an already bounded input (latest-N cards, sorted listing).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import config as C
from feedlake.session import checkpoint_dir
from feedlake.config import SITE, Site
from feedlake.functions import dates as D
from feedlake.functions import markup as M
from feedlake.functions import text as T


# ------------------------------------------------------------------ B1 markdown brief

def front_matter(title, date_iso, link, summary) -> F.Column:
    """'---' + title/date/sources/summary lines with JSON-encoded (ASCII) values + '---' + blank."""
    return F.concat(
        F.lit("---\ntitle: "), T.json_quote_ascii(title),
        F.lit("\ndate: "), T.json_quote_ascii(date_iso),
        F.lit("\nsources: ["), T.json_quote_ascii(link), F.lit("]"),
        F.lit("\nsummary: "), T.json_quote_ascii(T.cut(F.coalesce(T.col_(summary), F.lit("")), C.FRONT_MATTER_SUMMARY_CHARS)),
        F.lit("\n---\n\n"))


def markdown_brief(briefs: DataFrame, run_ts) -> DataFrame:
    """briefs: (id, title, link, summary, content) -> (id, md_name, markdown).
    `run_ts` is the run timestamp (the `date` field and the file-name date)."""
    ts = F.lit(run_ts).cast("timestamp")
    return briefs.select(
        "id",
        F.concat(D.date_slug(ts), F.lit("-"), F.col("id").cast("string"), F.lit(".md")).alias("md_name"),
        F.concat(front_matter("title", D.iso_utc(ts), "link", "summary"), F.coalesce("content", F.lit(""))).alias("markdown"))


def write_text_files(df: DataFrame, path: str, value_col: str, partition_col: str | None = None) -> None:
    out = df.select(F.col(value_col).alias("value"), *([partition_col] if partition_col else []))
    w = out.write.mode("overwrite")
    if partition_col:
        w = w.partitionBy(partition_col)
    w.text(path)


# ------------------------------------------------------------------ F11 cards / B2 home feed

def home_cards(articles: DataFrame, as_of, ts_col: str = "published_iso_ts", keep: tuple = ()) -> DataFrame:
    """Card projection of (id, title, summary, published, source): untitled -> '(untitled)',
    summary trimmed, display date '%b %e, %Y', read time from the summary, preview url from the
    published date; a date that does not parse counts as `as_of`. `keep` columns pass through."""
    ts = F.coalesce(F.col(ts_col), F.lit(as_of).cast("timestamp"))
    return articles.select(
        "id", *keep,
        F.coalesce(T.truthy("title"), F.lit(C.UNTITLED)).alias("title"),
        T.full_trim(F.coalesce("summary", F.lit(""))).alias("summary"),
        D.display_short(ts).alias("date"),
        T.read_time(F.coalesce("summary", F.lit(""))).alias("read_time"),
        F.concat(F.lit("/previews/"), D.date_slug(ts), F.lit("-"), F.col("id").cast("string"), F.lit(".html")).alias("url"),
        F.coalesce("source", F.lit("")).alias("source"),
    )


def static_features(spark: SparkSession) -> DataFrame:
    rows = [(i, f["title"], f["summary"], f["date"], f["read_time"], f["url"]) for i, f in enumerate(C.STATIC_FEATURES)]
    return spark.createDataFrame(rows, "pos int, title string, summary string, date string, read_time int, url string")


CARD_FIELDS = ["title", "summary", "date", "read_time", "url", "source"]


def home_feed_rows(cards: DataFrame, features: DataFrame) -> DataFrame:
    """Flat form of the home feed: (section, pos, title, summary, date, read_time, url, source)
    for briefs (pos by recency), top_insights (the first 3 briefs; the document keeps their
    titles) and features (no source)."""
    b = cards.select("pos", *CARD_FIELDS).withColumn("section", F.lit("briefs"))
    t = cards.where(F.col("pos") < C.TOP_INSIGHTS).select("pos", *CARD_FIELDS).withColumn("section", F.lit("top_insights"))
    f = features.select("pos", "title", "summary", "date", "read_time", "url",
                        F.lit(None).cast("string").alias("source")).withColumn("section", F.lit("features"))
    cols = ["section", "pos", *CARD_FIELDS]
    return b.select(*cols).unionByName(t.select(*cols)).unionByName(f.select(*cols))


def home_feed_document(rows: DataFrame, updated_at: str) -> DataFrame:
    """One-row JSON document {updated_at, top_insights, briefs, features} from the flat rows
    (the input is bounded: at most 9 + 3 + 2 rows)."""
    card = F.struct("title", "summary", "date", "read_time", "url", "source")
    feat = F.struct("title", "summary", "date", "read_time", "url")
    agg = rows.agg(
        F.array_sort(F.collect_list(F.when(F.col("section") == "top_insights", F.struct("pos", "title")))).alias("_t"),
        F.array_sort(F.collect_list(F.when(F.col("section") == "briefs", F.struct("pos", card.alias("c"))))).alias("_b"),
        F.array_sort(F.collect_list(F.when(F.col("section") == "features", F.struct("pos", feat.alias("c"))))).alias("_f"))
    doc = F.struct(
        F.lit(updated_at).alias("updated_at"),
        F.transform("_t", lambda x: x["title"]).alias("top_insights"),
        F.transform("_b", lambda x: x["c"]).alias("briefs"),
        F.transform("_f", lambda x: x["c"]).alias("features"))
    return agg.select(F.to_json(doc).alias("value"))


# ------------------------------------------------------------------ B5 SEO / JSON-LD

def seo_metadata(briefs: DataFrame, url_path_col: str = "url_path", site: Site = SITE,
                 og_image: str | None = None) -> DataFrame:
    """briefs: (id, title, summary, date_iso, url_path, author, tags) ->
    SEO fields and the JSON-LD document (keywords only when there are tags)."""
    title = F.when(T.truthy("title").isNull(), F.lit(site.name)).otherwise(F.col("title"))
    seo_title = T.full_trim(title)
    desc = M.clip_description("summary")
    canonical = M.join_url(site.url, F.col(url_path_col))
    og = F.lit(og_image or site.og_image)
    date = F.coalesce(T.truthy("date_iso"), D.zulu(F.current_timestamp()))
    tags = F.col("tags")
    ld = F.struct(
        F.lit("https://schema.org").alias("@context"),
        F.lit("Article").alias("@type"),
        F.struct(F.lit("WebPage").alias("@type"), canonical.alias("@id")).alias("mainEntityOfPage"),
        seo_title.alias("headline"),
        desc.alias("description"),
        F.array(og).alias("image"),
        date.alias("datePublished"),
        date.alias("dateModified"),
        F.struct(F.lit("Person").alias("@type"), F.coalesce("author", F.lit(site.author)).alias("name")).alias("author"),
        F.struct(F.lit("Organization").alias("@type"), F.lit(site.name).alias("name"),
                 F.struct(F.lit("ImageObject").alias("@type"),
                          M.join_url(site.url, F.lit(site.logo_path)).alias("url")).alias("logo")).alias("publisher"),
        F.when(F.size(tags) > 0, F.array_join(tags, ",")).alias("keywords"),
    )
    return briefs.select(
        "id", seo_title.alias("seo_title"), desc.alias("seo_description"), canonical.alias("canonical_url"),
        og.alias("og_image"), date.alias("date_published"),
        F.when(F.size(tags) > 0, F.array_join(tags, ",")).alias("keywords"),
        F.concat(F.lit('<script type="application/ld+json">'), F.to_json(ld), F.lit("</script>")).alias("json_ld"))


# ------------------------------------------------------------------ B4 sitemap

def export_previews(previews: DataFrame, path: str) -> None:
    """Preview pages (name, html, date) as a date-partitioned table stamped with the write
    time. One row per page instead of one file per page: a file per brief does not survive
    archive scale (listing and commit cost grow with the file count)."""
    (previews.withColumn("modified_at", F.current_timestamp())
     .hint("rebalance", F.col("date")).write.mode("overwrite").partitionBy("date").parquet(path))


def sitemap_entries(listing: DataFrame, site: Site = SITE) -> DataFrame:
    """(name, loc, lastmod, changefreq, priority) per listed .html file."""
    return listing.select(
        "name",
        M.join_url(site.url, F.concat(F.lit(C.PREVIEWS_PREFIX), F.col("name"))).alias("loc"),
        D.zulu("modificationTime").alias("lastmod"),
        F.lit(C.SITEMAP_CHANGEFREQ).alias("changefreq"),
        F.lit(C.SITEMAP_PRIORITY).alias("priority"))


SITEMAP_MAX_URLS = 50_000  # sitemap protocol limit per file


def sitemap_document(entries: DataFrame, max_urls: int = SITEMAP_MAX_URLS, site: Site = SITE) -> DataFrame:
    """Sitemap documents (name, value): sitemap-0.xml, sitemap-1.xml, ... with `max_urls` entries each in the order
    of their names, and sitemap.xml, the index over them.

    The entries are range-sorted by name; a row count for each range gives every entry its global position, and
    position / max_urls its part, so that no part is larger than the protocol allows and no group holds more."""
    spark = entries.sparkSession
    checkpoint_dir(spark)
    line = F.concat(
        F.lit("  <url>\n    <loc>"), F.col("loc"), F.lit("</loc>\n    <lastmod>"), F.col("lastmod"),
        F.lit("</lastmod>\n    <changefreq>"), F.col("changefreq"), F.lit("</changefreq>\n    <priority>"),
        F.col("priority"), F.lit("</priority>\n  </url>"))
    sorted_ = entries.select("name", line.alias("x")).orderBy("name").withColumn("at", F.monotonically_increasing_id()).checkpoint()
    counts = sorted((r[0], r[1]) for r in sorted_.groupBy(F.shiftright("at", 33).alias("range")).count().collect())
    before, total = [], 0
    for k, n in counts:
        before.append((k, total))
        total += n
    first = spark.createDataFrame(before, "range long, first long")
    position = F.col("first") + F.col("at").bitwiseAND((1 << 33) - 1)
    placed = sorted_.withColumn("range", F.shiftright("at", 33)).join(F.broadcast(first), "range").select((position / max_urls).cast("long").alias("part"), "name", "x")
    parts = placed.groupBy("part").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("name", "x"))), lambda s: s["x"]), "\n").alias("b"))
    documents = parts.select(F.format_string("sitemap-%d.xml", "part").alias("name"), F.concat(F.lit(C.SITEMAP_HEAD), F.col("b"), F.lit(C.SITEMAP_END)).alias("value"))
    n_parts = -(-total // max_urls)
    listed = "\n".join(f"  <sitemap>\n    <loc>{site.url.rstrip('/')}/sitemap-{k}.xml</loc>\n  </sitemap>" for k in range(n_parts))
    index = spark.createDataFrame([("sitemap.xml", C.SITEMAP_INDEX_HEAD + listed + C.SITEMAP_INDEX_END)], "name string, value string")
    return documents.unionByName(index)


# ------------------------------------------------------------------ F15 field aliases

def card_aliases(items: DataFrame) -> DataFrame:
    """Cards as the pages read them, from items whose fields go by several names (any may be missing or empty):
    summary or description; the long date date_display or date, the short one date_short before both; link or
    url, else '#'."""
    def chain(*names, default=""):
        return F.coalesce(*(T.truthy(n) for n in names if n in items.columns), F.lit(default))

    return items.select(
        "id", chain("title", default=C.UNTITLED_BRIEF).alias("title"), chain("summary", "description").alias("summary"),
        chain("date_display", "date").alias("date_long"), chain("date_short", "date_display", "date").alias("date_short"),
        chain("link", "url", default="#").alias("link"))
