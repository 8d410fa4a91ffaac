"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Every query reads the driver tables (through the adapters of sources/tables.py) over their
whole extent; the only limits are the features themselves (latest-N, top-k, first 3 entries
per feed). Output columns are explicitly named and typed (bigint for integers) so they line up
with the SQL oracle in plans/oracle.py.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import config as C
from feedlake.functions import dates as D
from feedlake.functions import markup as M
from feedlake.functions import text as T
from feedlake.functions import vectors as V
from feedlake.operators import insight as I
from feedlake.operators import mention_index as MI
from feedlake.operators import mentions as MN
from feedlake.operators import select as S
from feedlake.operators import similar as SIM
from feedlake.operators import snapshots as SN
from feedlake.operators import state as ST
from feedlake.plans import brief as B
from feedlake.session import scratch_path
from feedlake.sinks import export as X
from feedlake.sources import feeds as FD
from feedlake.sources import pages as P
from feedlake.sources import tables as TB

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        B.ensure_utc(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def _long(c):
    return F.col(c).cast("long") if isinstance(c, str) else c.cast("long")


# ============================================================ A. sources

@query
def archive_scan(spark, sf):
    """A1: archive scan without the embedding column, published parsed."""
    a = B.keyed_articles(spark, sf)
    return a.select(_long("id").alias("id"), "title", "url", "source", "published", "published_ts", "summary", "content")


@query
def embedding_scan(spark, sf):
    """A2: (id, vector) with NULL vectors dropped."""
    v = TB.vectors(spark, sf).where(F.col("embedding").isNotNull())
    return v.select(_long("id").alias("id"), F.size("embedding").cast("long").alias("dim"),
                    F.round(V.l2_norm("embedding"), 4).alias("norm"))


def _doc_feed_entries(spark, sf, group_size: int = 100):
    """Feed documents derived from the archive: one feed per (source, id div group_size), its
    entries in id order (bounded groups of <= group_size rows)."""
    a = B.keyed_articles(spark, sf)
    return (a.select("id", "source", "lang", "content", "published_ts",
                     T.cut(T.first_line("content"), 80).alias("e_title"), F.col("url").alias("e_link"))
            .withColumn("g", F.floor(F.col("id") / group_size).cast("long")))


def _rss_payloads(entries):
    e = entries.select("source", "g", F.struct(
        F.col("id"), F.col("e_title").alias("title"), F.col("e_link").alias("link"),
        F.col("content").alias("description"), D.rfc822("published_ts").alias("pubDate")).alias("e"))
    grouped = e.groupBy("source", "g").agg(F.array_sort(F.collect_list("e")).alias("items"))
    return grouped.select(
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example/feed/"), F.col("g").cast("string"), F.lit(".xml")).alias("url"),
        FD.rss_payload(F.col("source"), F.transform("items", lambda x: x.dropFields("id"))).alias("payload"))


def _json_payloads(entries):
    e = entries.select("source", "g", F.struct(
        F.col("id"), F.col("e_title").alias("title"),
        F.concat(F.lit("/r/"), F.col("source"), F.lit("/comments/"), F.col("id").cast("string")).alias("permalink"),
        F.col("content").alias("selftext"),
        F.unix_timestamp("published_ts").cast("double").alias("created_utc")).alias("p"))
    grouped = e.groupBy("source", "g").agg(F.array_sort(F.collect_list("p")).alias("posts"))
    return grouped.select(
        F.concat(F.lit("https://www.reddit.com/r/"), F.col("source"), F.lit("/"), F.col("g").cast("string"), F.lit(".json")).alias("url"),
        FD.json_payload(F.transform("posts", lambda x: x.dropFields("id"))).alias("payload"))


def _items_out(items):
    return items.select("feed_url", _long("entry_pos").alias("entry_pos"), "title", "link", "summary", "published", "source")


@query
def rss_ingest(spark, sf):
    """A3: RSS payloads -> first 3 entries per feed."""
    return _items_out(FD.rss_items(_rss_payloads(_doc_feed_entries(spark, sf))))


@query
def json_feed_normalise(spark, sf):
    """A4: reddit-style JSON payloads -> items (no per-feed limit)."""
    return _items_out(FD.json_items(_json_payloads(_doc_feed_entries(spark, sf))))


@query
def feed_union(spark, sf):
    """A5: mixed payloads routed by url (en/de feeds as RSS, others as JSON) and unioned."""
    e = _doc_feed_entries(spark, sf)
    is_rss = F.coalesce(F.col("lang"), F.lit("")).isin("en", "de")
    rss = _rss_payloads(e.where(is_rss))
    js = _json_payloads(e.where(~is_rss))
    return _items_out(FD.feed_items(rss.unionByName(js)))


@query
def feed_rejects(spark, sf):
    """A3/A5: payloads that can't be taken, with the reason. Of the mixed payloads by number of the group: one in
    five is cut in half, one an error page, one blank, one a feed without entries, one as it should be."""
    e = _doc_feed_entries(spark, sf)
    is_rss = F.coalesce(F.col("lang"), F.lit("")).isin("en", "de")
    p = _rss_payloads(e.where(is_rss)).unionByName(_json_payloads(e.where(~is_rss)))
    turn = F.regexp_extract("url", r"/(\d+)\.[a-z]+$", 1).cast("long") % 5
    page = F.lit("<html><body>503</body></html>")
    bare = F.when(FD.is_json_feed("url"), F.lit('{"data":{"children":[]}}')).otherwise(F.lit("<rss><channel><title>t</title></channel></rss>"))
    broken = (F.when(turn == 0, F.expr("substring(payload, 1, CAST(length(payload) / 2 AS INT))")).when(turn == 1, page)
              .when(turn == 2, F.lit(" \n")).when(turn == 3, bare).otherwise(F.col("payload")))
    return FD.feed_rejects(p.select("url", broken.alias("payload"))).select("feed_url", "kind", "reason")


@query
def source_list_dedup(spark, sf):
    """Defaults then the user's list (one feed url per archive article), first wins."""
    a = TB.articles(spark, sf)
    user = a.select(F.col("id").alias("pos"), F.concat(F.lit("https://"), F.col("source"), F.lit(".example/rss.xml")).alias("url"))
    return FD.source_list(spark, user).select(_long("pos").alias("pos"), "url")


@query
def seen_import(spark, sf):
    """Seen-hash lists (JSON arrays, one per 50 archive ids) imported into seen."""
    a = B.article_keys(spark, sf)
    lists = (a.groupBy(F.floor(F.col("id") / 50).alias("g"))
             .agg(F.to_json(F.array_sort(F.collect_list("url_hash"))).alias("payload")))
    out = FD.import_seen(TB.seen(spark, sf), FD.seen_hashes(lists), B.AS_OF)
    return out.select("url_hash", "url", "first_seen")


@query
def page_text(spark, sf):
    """Main text of every landed page."""
    p = P.page_text(TB.pages(spark, sf))
    return p.select(_long("page_id").alias("page_id"), "url", "page_text",
                    F.length("full_text").cast("long").alias("full_chars"))


# ============================================================ B. sinks

def _unseen_articles(spark, sf):
    a = B.keyed_articles(spark, sf)
    return ST.unseen(a, TB.seen(spark, sf))


@query
def markdown_brief(spark, sf):
    """B1: markdown brief (front matter + extractive summary) per unseen article."""
    u = T.with_summary(_unseen_articles(spark, sf), "content", "brief") \
        .select("id", "title", F.col("url").alias("link"), "summary", F.col("brief").alias("content"))
    md = X.markdown_brief(u, B.RUN_TS)
    return md.select(_long("id").alias("id"), "md_name", "markdown")


@query
def home_feed(spark, sf):
    """Flat home feed rows (briefs, top insights, static features)."""
    r = B.home_feed(spark, sf)
    return r.select("section", _long("pos").alias("pos"), "title", "summary", "date",
                    _long("read_time").alias("read_time"), "url", "source")


def _sitemap_listing(spark, sf):
    """One preview name per page, with its article's publish time; no page body is read."""
    a = B.article_keys(spark, sf).select("id", "published_ts")
    p = TB.table(spark, sf, "pages", "page_id").join(a, F.col("page_id") == F.col("id"))
    return p.select(F.concat(D.date_slug("published_ts"), F.lit("-"), F.col("page_id").cast("string"), F.lit(".html")).alias("name"),
                    F.col("published_ts").alias("modificationTime"))


@query
def sitemap_entries(spark, sf):
    """One sitemap entry per preview page, lastmod = its article's publish time."""
    return X.sitemap_entries(_sitemap_listing(spark, sf)).select("name", "loc", "lastmod", "changefreq", "priority")


@query
def sitemap_documents(spark, sf):
    """The sitemap files themselves, parts and index."""
    return X.sitemap_document(X.sitemap_entries(_sitemap_listing(spark, sf)))


@query
def card_aliases(spark, sf):
    """cards from items whose fields go by other names in each language."""
    a = B.keyed_articles(spark, sf)
    lang, short, long_ = F.coalesce("lang", F.lit("")), D.display_short("published_ts"), D.display_long("published_ts")
    items = a.select(
        "id", F.when(F.pmod("id", F.lit(7)) == 0, F.lit("")).otherwise(F.col("title")).alias("title"),
        F.when(lang == "en", F.col("summary")).when(lang == "fr", F.lit("")).alias("summary"), T.cut("content", 40).alias("description"),
        F.when(lang == "en", short).alias("date_short"), F.when(lang == "fr", long_).when(lang == "de", F.lit("")).alias("date_display"),
        F.when(lang != "es", F.col("published")).alias("date"), F.when(F.pmod("id", F.lit(2)) == 0, F.col("url")).alias("link"),
        F.when(F.pmod("id", F.lit(3)) == 0, F.concat(F.lit("/p/"), F.col("id").cast("string"))).alias("url"))
    return X.card_aliases(items).select(_long("id").alias("id"), "title", "summary", "date_long", "date_short", "link")


@query
def seo_metadata(spark, sf):
    """SEO fields and JSON-LD keywords per unseen article."""
    u = _unseen_articles(spark, sf)
    b = u.select("id", "title", T.cut("summary", C.SEO_SUMMARY_CHARS).alias("summary"),
                 F.col("published").alias("date_iso"),
                 F.concat(F.lit("previews/"), D.date_slug(F.lit(B.RUN_TS).cast("timestamp")), F.lit("-"),
                          F.col("id").cast("string"), F.lit(".html")).alias("url_path"),
                 F.col("source").alias("author"), T.title_tags("title").alias("tags"))
    s = X.seo_metadata(b)
    return s.select(_long("id").alias("id"), "seo_title", "seo_description", "canonical_url", "og_image",
                    "date_published", "keywords", "json_ld")


@query
def paragraph_markup(spark, sf):
    """Paragraph HTML of each article's extractive summary."""
    a = T.with_summary(TB.articles(spark, sf), "content", "brief")
    return a.select(_long("id").alias("id"), M.paragraphs_html("brief").alias("content_html"))


@query
def run_metrics(spark, sf):
    """One metrics row of the brief batch."""
    b = B.brief_batch(spark, sf)
    return b.agg(
        F.count(F.lit(1)).cast("long").alias("items"),
        F.sum(F.col("is_unseen").cast("long")).cast("long").alias("candidates"),
        F.count("content").cast("long").alias("summaries"),
        F.sum((F.col("cached_summary").isNull() & F.col("content").isNotNull()).cast("long")).cast("long").alias("fallback_used"),
        F.count("cached_summary").cast("long").alias("cache_reused"),
        F.sum(F.length("content")).cast("long").alias("content_chars"),
        F.sum(F.length("insight")).cast("long").alias("insight_chars"))


# ============================================================ C. keyed writes

def _events(spark, sf):
    return TB.events(spark, sf).select("user_id", "event_id", "ts", "event_type", "value")


@query
def seen_keep_first(spark, sf):
    """C1: 'view' events form the table (first per user); other events are inserted if absent."""
    ev = _events(spark, sf)
    existing = ST.keep_first(ev.where("event_type = 'view'"), "user_id", ["ts", "event_id"])
    out = ST.insert_if_absent(existing, ev.where("event_type <> 'view'"), "user_id", ["ts", "event_id"])
    return out.select(_long("user_id").alias("user_id"), _long("event_id").alias("event_id"), "ts", "event_type")


@query
def upsert_keep_last(spark, sf):
    """C2: 'view' events form the table (last per user); the last other event replaces it."""
    ev = _events(spark, sf)
    existing = ST.keep_last(ev.where("event_type = 'view'"), "user_id", ["ts", "event_id"])
    out = ST.upsert_keep_last(existing, ev.where("event_type <> 'view'"), "user_id", ["ts", "event_id"])
    return out.select(_long("user_id").alias("user_id"), _long("event_id").alias("event_id"), "ts", "event_type", "value")


@query
def memo_upsert(spark, sf):
    """Memo from the last user turn per conversation, then the assistant turns upserted."""
    cv = TB.table(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    key = F.concat(F.lit("summary:"), F.col("conv_id").cast("string"))
    users = ST.keep_last(cv.where("role = 'user'").select(key.alias("cache_key"), "turn", F.col("text").alias("value")),
                         "cache_key", ["turn"])
    memo = users.select("cache_key", "value", F.lit("summary").alias("content_type"),
                        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("created_at"))
    batch = cv.where("role = 'assistant'").select(key.alias("cache_key"), F.col("text").alias("value"),
                                                   F.lit("summary").alias("content_type"), F.col("turn").alias("_seq"))
    return ST.memo_upsert(memo, batch, "2024-02-01 00:00:00").select("cache_key", "value", "content_type", "created_at")


@query
def memo_delete(spark, sf):
    """C4: memo entries of toxic-labelled articles deleted."""
    a = TB.articles(spark, sf).select("id", "url")
    tox = TB.table(spark, sf, "labels", "doc_id", "toxic").where("toxic = 1")
    keys = a.join(tox, a.id == tox.doc_id, "left_semi").select(T.url_key("url").alias("cache_key"))
    return ST.memo_delete(TB.memo(spark, sf), keys).select("cache_key", "value", "content_type", "created_at")


@query
def snapshot_merge(spark, sf):
    """C1/C2 on a stored table: the 'view' events as version 0, then the other events merged in two commits (even users
    inserted if absent, odd ones replaced); read back from the newest version."""
    ev = _events(spark, sf)
    path = scratch_path(spark, "event-table")
    SN.create(spark, path, ST.keep_last(ev.where("event_type = 'view'"), "user_id", ["ts", "event_id"]), "user_id", buckets=16)
    rest = ev.where("event_type <> 'view'")
    SN.merge(spark, path, rest.where("user_id % 2 = 0"), ["ts", "event_id"], mode="keep_first")
    SN.merge(spark, path, rest.where("user_id % 2 = 1"), ["ts", "event_id"], mode="keep_last")
    return SN.read(spark, path).select(_long("user_id").alias("user_id"), _long("event_id").alias("event_id"), "ts", "event_type", "value")


@query
def snapshot_delete(spark, sf):
    """C4 on a stored table: the memo as version 0, the entries of toxic-labelled articles deleted in one commit."""
    path = scratch_path(spark, "memo-table")
    SN.create(spark, path, TB.memo(spark, sf).select("cache_key", "value", "content_type", "created_at"), "cache_key", buckets=16)
    a = TB.articles(spark, sf).select("id", "url")
    tox = TB.table(spark, sf, "labels", "doc_id", "toxic").where("toxic = 1")
    SN.merge(spark, path, a.join(tox, a.id == tox.doc_id, "left_semi").select(T.url_key("url").alias("cache_key")), mode="delete")
    return SN.read(spark, path)


# ============================================================ D. ordering / limits

@query
def feed_recency_sort(spark, sf):
    """Items newest first (unparsable dates last, id tie-break)."""
    a = B.keyed_articles(spark, sf)
    return S.recency_sort(a).select(_long("id").alias("id"), "published", "published_ts")


@query
def newest_unseen(spark, sf):
    """The 10 newest unseen items."""
    u = S.newest_unseen(B.article_keys(spark, sf), TB.seen(spark, sf), n=10)
    return u.select(_long("id").alias("id"), "url_hash", "published_ts")


@query
def latest_n(spark, sf):
    """D3: the 9 newest articles."""
    return S.latest_n(B.newest_articles(spark, sf)).select(_long("id").alias("id"), "title", "published_ts")


@query
def top_insights(spark, sf):
    """Titles of the 3 newest articles, with their position."""
    t = S.page_slices(B.newest_articles(spark, sf))
    return t.where(F.col("pos") < C.TOP_INSIGHTS).select(_long("pos").alias("pos"), "title")


@query
def recent_slice(spark, sf):
    """Latest card and the next 7."""
    t = S.page_slices(B.newest_articles(spark, sf))
    return t.select("slot", _long("pos").alias("pos"), _long("id").alias("id"), "title")


@query
def seen_history(spark, sf):
    """Seen table (one row per event url) newest first."""
    ev = TB.events(spark, sf)
    seen = ev.select(T.short_hash(F.concat(F.lit("evt:"), F.col("event_id").cast("string"))).alias("url_hash"),
                     F.concat(F.lit("https://events.example/"), F.col("event_id").cast("string")).alias("url"),
                     F.col("ts").alias("first_seen"))
    return ST.seen_history(seen)


# ============================================================ E. joins / lookups

@query
def unseen_anti(spark, sf):
    """Articles whose key is not in seen."""
    return ST.unseen(B.article_keys(spark, sf), TB.seen(spark, sf)).select(_long("id").alias("id"), "url_hash")


@query
def seen_semi(spark, sf):
    """Articles whose key is in seen."""
    a = B.article_keys(spark, sf)
    return ST.already_seen(a, TB.seen(spark, sf)).select(_long("id").alias("id"), "url_hash")


@query
def memo_lookup(spark, sf):
    """Cached article text per article (miss -> NULL)."""
    a = TB.articles(spark, sf).select("id", T.url_key("url").alias("cache_key"))
    j = ST.memo_lookup(a, TB.memo(spark, sf), "cache_key", "cached")
    return j.select(_long("id").alias("id"), "cache_key", "cached")


@query
def text_fallback_chain(spark, sf):
    """Article text chosen by the summary-memo / feed / memo / page fallback chain."""
    a = B.keyed_articles(spark, sf).select("id", "title", F.col("url").alias("link"), "summary")
    ch = S.article_text_chain(a, TB.summaries(spark, sf), TB.memo(spark, sf), B.page_text_by_url(spark, sf))
    return ch.select(_long("id").alias("id"), "text_path", "article_text")


@query
def title_dup_anti(spark, sf):
    """Articles whose title snippet is not inside any open title."""
    a = TB.articles(spark, sf).select("id", "title")
    return S.title_duplicates_removed(a, TB.open_titles(spark, sf)).select(_long("id").alias("id"), "title")


# ============================================================ F. columns

@query
def url_keys(spark, sf):
    """short hash, full hash, url key and summary key of each article url."""
    a = TB.articles(spark, sf)
    return a.select(_long("id").alias("id"), T.short_hash("url", 8).alias("short_id"), T.short_hash("url").alias("url_hash"),
                    T.url_key("url").alias("url_key"), T.summary_key(T.short_hash("url")).alias("summary_key"))


@query
def sentence_split(spark, sf):
    """sentences of every article, exploded with their position."""
    a = TB.articles(spark, sf)
    return a.select(_long("id").alias("id"), F.posexplode(T.sentences("content")).alias("pos", "sentence")) \
            .select("id", _long("pos").alias("pos"), "sentence")


@query
def extractive_summary(spark, sf):
    """extractive brief of every article."""
    a = T.with_summary(TB.articles(spark, sf), "content", "brief")
    return a.select(_long("id").alias("id"), F.col("brief").alias("summary"))


@query
def read_time(spark, sf):
    """read-time estimate of summary and content."""
    a = TB.articles(spark, sf)
    return a.select(_long("id").alias("id"), _long(T.read_time("summary")).alias("summary_minutes"),
                    _long(T.read_time("content")).alias("content_minutes"))


@query
def title_keywords(spark, sf):
    """insight keywords (len > 4, 4) and tags (len > 3, 6) of every title."""
    a = TB.articles(spark, sf)
    k = a.select("id", F.lit("keyword").alias("kind"), F.posexplode(T.title_keywords("title")).alias("pos", "word"))
    t = a.select("id", F.lit("tag").alias("kind"), F.posexplode(T.title_tags("title")).alias("pos", "word"))
    return k.unionByName(t).select(_long("id").alias("id"), "kind", _long("pos").alias("pos"), "word")


@query
def published_parse(spark, sf):
    """F8: mixed-format published text -> UTC timestamp."""
    a = B.keyed_articles(spark, sf)
    return a.select(_long("id").alias("id"), "published", "published_ts",
                    D.display_short("published_ts").alias("date_short"), D.display_long("published_ts").alias("date_long"))


@query
def home_cards(spark, sf):
    """card projection of every article."""
    a = B.keyed_articles(spark, sf).withColumnRenamed("published_ts", "published_iso_ts")
    c = X.home_cards(a, B.AS_OF)
    return c.select(_long("id").alias("id"), "title", "summary", "date", _long("read_time").alias("read_time"), "url", "source")


@query
def link_resolve(spark, sf):
    """browser link resolution of card, absolute and relative links, two base paths."""
    a = TB.articles(spark, sf)
    card = F.concat(F.lit("/previews/"), F.col("id").cast("string"), F.lit(".html"))
    links = a.select("id", F.explode(F.array(
        F.struct(F.lit("card").alias("kind"), card.alias("raw")),
        F.struct(F.lit("absolute").alias("kind"), F.col("url").alias("raw")),
        F.struct(F.lit("relative").alias("kind"), F.substring(card, 2, 1000).alias("raw")),
        F.struct(F.lit("empty").alias("kind"), F.lit("").alias("raw")))).alias("l")).select("id", "l.*")
    return (links.select(_long("id").alias("id"), "kind", F.lit("").alias("base"), M.resolve_link("raw", "").alias("resolved"))
            .unionByName(links.select(_long("id").alias("id"), "kind", F.lit("/site").alias("base"),
                                      M.resolve_link("raw", "/site").alias("resolved"))))


# ============================================================ G. aggregates / similarity

@query
def similar_topk(spark, sf):
    """G1: exact cosine top-5 of every vector against the whole archive (self-match kept)."""
    v = TB.vectors(spark, sf)
    h = SIM.cosine_topk(v, v, k=C.SIMILAR_K_SEARCH)
    return h.select(_long("qid").alias("qid"), _long("rank").alias("rank"), _long("id").alias("id"),
                    F.round("score", 4).alias("score"))


@query
def keyword_counts(spark, sf):
    """Per unseen article and title keyword, the number of archive articles containing it."""
    arts = B.keyed_articles(spark, sf)
    u = ST.unseen(arts, TB.seen(spark, sf))
    c = B.keyword_counts(u, arts)
    return c.select(_long("id").alias("id"), _long("pos").alias("pos"), "keyword", _long("mentions").alias("mentions"))


@query
def keyword_counts_regex(spark, sf):
    """G3, patterns: each title keyword of the unseen articles as a regular expression, in two forms (as it stands, and with
    its second letter free); mentions is NULL for what is no valid pattern."""
    arts = B.keyed_articles(spark, sf)
    kw = B.article_keywords(ST.unseen(arts, TB.seen(spark, sf)))
    free = F.concat(F.substring("keyword", 1, 1), F.lit("."), F.substring("keyword", 3, 1000))
    both = kw.select("id", (F.col("pos") * 2).alias("pos"), "keyword").unionByName(kw.select("id", (F.col("pos") * 2 + 1).alias("pos"), free.alias("keyword")))
    c = MN.keyword_article_counts(both, B.archive_text(arts).select("id", "text"), regex=True)
    return c.select(_long("id").alias("id"), _long("pos").alias("pos"), "keyword", _long("mentions").alias("mentions"))


def _unseen_keywords(spark, sf, n_keywords: int):
    """The first keywords of every unseen article's title, and the archive."""
    arts = B.keyed_articles(spark, sf)
    unseen = ST.unseen(arts, TB.seen(spark, sf))
    return B.article_keywords(unseen).where(F.col("pos") < n_keywords).select("keyword"), arts


@query
def mention_series(spark, sf):
    """Weekly mention series (gap-filled) of every unseen article's first keyword."""
    kw, arts = _unseen_keywords(spark, sf, 1)
    s = MN.mention_series(B.archive_text(arts), kw, days=C.MENTION_BIN_DAYS, as_of=B.AS_OF)
    return s.select("keyword", "bin_start", _long("mentions").alias("mentions"))


@query
def mention_series_multi(spark, sf):
    """30-day mention series of all keywords of all unseen articles."""
    kw, arts = _unseen_keywords(spark, sf, C.KEYWORDS_PER_TITLE)
    s = MN.mention_series(B.archive_text(arts), kw, days=C.INSIGHT_BIN_DAYS, as_of=B.AS_OF)
    return s.select("keyword", "bin_start", _long("mentions").alias("mentions"))


@query
def mention_index_series(spark, sf):
    """G4 as a maintained aggregate: the archive indexed in two increments (the second finds the first one's articles
    there), then the weekly series of every unseen article's first keyword from the postings."""
    kw, arts = _unseen_keywords(spark, sf, 1)
    text = B.archive_text(arts)
    path = scratch_path(spark, "mention-index")
    MI.update(spark, path, text.where("id % 3 = 0"))
    MI.update(spark, path, text)
    s = MI.series(spark, path, kw, days=C.MENTION_BIN_DAYS, as_of=B.AS_OF)
    return s.select("keyword", "bin_start", _long("mentions").alias("mentions"))


@query
def evidence_text(spark, sf):
    """Evidence block of the top-6 similar archive articles for every vector."""
    v = TB.vectors(spark, sf)
    hits = SIM.cosine_topk(v, v, k=C.SIMILAR_K_INSIGHT)
    enriched = SIM.enrich_hits(hits, TB.articles(spark, sf))
    return I.evidence_text(enriched).select(_long("qid").alias("qid"), "evidence")


@query
def insight_fallback(spark, sf):
    """Heuristic insight of every unseen article (keyword counts over the archive)."""
    arts = B.keyed_articles(spark, sf)
    u = ST.unseen(arts, TB.seen(spark, sf))
    kv = I.keyword_count_pairs(B.keyword_counts(u, arts))
    return I.heuristic_insight(u.select("id", "title", "summary"), kv).select(_long("id").alias("id"), "insight")


@query
def insight_archive(spark, sf):
    """G8 (archive-analysis wording): heuristic insight of every unseen article."""
    u = _unseen_articles(spark, sf)
    return I.heuristic_insight_archive(u.select("id", "title", "summary")).select(_long("id").alias("id"), "insight")


@query
def similar_articles(spark, sf):
    """The 6 most similar archive articles of every unseen article, by tf-idf vectors of their own texts."""
    arts = B.keyed_articles(spark, sf)
    h = B.similar_articles(ST.unseen(arts, TB.seen(spark, sf)), arts)
    return h.select(_long("qid").alias("qid"), _long("rank").alias("rank"), _long("id").alias("id"), F.round("score", 6).alias("score"))


@query
def insight_prompt(spark, sf):
    """Prompt rows (system, user) of every unseen article: evidence from its 6 most similar archive articles by
    their own texts, and its keyword counts as JSON (no model call)."""
    arts = B.keyed_articles(spark, sf)
    u = ST.unseen(arts, TB.seen(spark, sf))
    kv = I.keyword_count_pairs(B.keyword_counts(u, arts))
    p = I.insight_prompt(u.select("id", "title", "summary"), B.evidence(u, arts, C.EVIDENCE_SUMMARY_CHARS), kv)
    return p.select(_long("id").alias("id"), "system", "user")


@query
def insight_archive_prompt(spark, sf):
    """G6/G7 (archive-analysis wording): evidence with longer summaries, and the 30-day series of each keyword as JSON."""
    arts = B.keyed_articles(spark, sf)
    u = ST.unseen(arts, TB.seen(spark, sf))
    kw = B.article_keywords(u)
    series = MN.mention_series(B.archive_text(arts), kw, days=C.INSIGHT_BIN_DAYS, as_of=B.AS_OF)
    p = I.insight_prompt_archive(u.select("id", "title", "summary"), B.evidence(u, arts, C.ARCHIVE_EVIDENCE_SUMMARY_CHARS), I.keyword_series(kw, series))
    return p.select(_long("id").alias("id"), "system", "user")


@query
def text_vectors(spark, sf):
    """384-d unit vector per article from its summary + content (tokenise, hashed TF, IDF): its norm, how many places
    are taken, and the sum of the values by place and of their squares by place."""
    a = TB.articles(spark, sf).select("id", T.embedding_text("summary", "content").alias("embed_text"))
    return _vector_digest(SIM.text_vectors(a, dim=C.EMBED_DIM))


def _vector_digest(v):
    by_place = lambda value: F.round(F.aggregate(F.transform("embedding", value), F.lit(0.0), lambda s, x: s + x), 3)
    return v.select(_long("id").alias("id"), F.size("embedding").cast("long").alias("dim"),
                    F.round(V.l2_norm("embedding"), 4).alias("norm"),
                    F.size(F.filter("embedding", lambda x: x != 0)).cast("long").alias("taken"),
                    by_place(lambda x, i: x.cast("double") * (i + 1)).alias("sum_by_place"),
                    by_place(lambda x, i: x.cast("double") * x.cast("double") * (i + 1)).alias("squares_by_place"))


@query
def model_vectors(spark, sf):
    """G2 with a user's own model: loaded once in each Python worker, here md5-hashed terms with weights fitted on the
    archive. Digest as in text_vectors."""
    a = TB.articles(spark, sf).select("id", T.embedding_text("summary", "content").alias("embed_text"))
    model = SIM.fit_hashed_terms(a, dim=C.EMBED_DIM)
    name = f"hashed terms, weights {hashlib.md5(model.weights.tobytes()).hexdigest()}"
    return _vector_digest(SIM.model_vectors(a, name, lambda: model, dim=C.EMBED_DIM))


# ============================================================ H. streaming

@query
def stream_ingest(spark, sf):
    """H1: events file source read incrementally (availableNow) into a parquet table."""
    from feedlake.streaming import feeds as SF
    return SF.ingest_events(spark, sf).select(_long("event_id").alias("event_id"), _long("user_id").alias("user_id"),
                                              "event_type", "ts")


@query
def stream_feed_ingest(spark, sf):
    """H1/H2 on feed payloads: the mixed payloads of `feed_union` landed as JSON lines, streamed
    (availableNow), parsed, keyed, filtered against a seen snapshot and appended."""
    from feedlake.streaming import feeds as SF
    e = _doc_feed_entries(spark, sf)
    is_rss = F.coalesce(F.col("lang"), F.lit("")).isin("en", "de")
    payloads = (_rss_payloads(e.where(is_rss)).unionByName(_json_payloads(e.where(~is_rss)))
                .withColumn("fetched_at", F.lit(B.RUN_TS).cast("timestamp")))
    landing = scratch_path(spark, "landing")
    payloads.write.mode("overwrite").json(landing)
    table, seen, ck = scratch_path(spark, "items"), scratch_path(spark, "seen"), scratch_path(spark, "feed-ck")
    SF.ingest_feed_payloads(spark, landing, table, seen, ck).awaitTermination()
    return _items_out(spark.read.parquet(table))


@query
def stream_seen(spark, sf):
    """H2: streaming first-seen per user (foreachBatch keep-first into a seen table)."""
    from feedlake.streaming import feeds as SF
    return SF.first_seen_stream(spark, sf).select(_long("user_id").alias("user_id"), _long("event_id").alias("event_id"), "ts")


@query
def stream_first_seen(spark, sf):
    """H2 with state of its own for each user: the earliest event of each user, given out when the watermark (a day) has
    passed it. Two runs: the second goes on from the first one's state, with the other half of the events."""
    from feedlake.streaming import feeds as SF
    landing, table, ck = scratch_path(spark, "first-events"), scratch_path(spark, "first-seen"), scratch_path(spark, "first-ck")
    ev = TB.events(spark, sf).select("user_id", "event_id", "ts")
    middle = F.percentile_approx("ts", 0.5)
    cut = ev.agg(middle).first()[0]
    seen = None
    for part in (ev.where(F.col("ts") < F.lit(cut)), ev.where(F.col("ts") >= F.lit(cut))):
        part.write.mode("append").parquet(landing)
        seen = SF.first_seen_with_expiry(spark, spark.readStream.schema(ev.schema).parquet(landing), table, ck)
    return seen.select(_long("user_id").alias("user_id"), _long("event_id").alias("event_id"), "ts")


@query
def stream_closed_windows(spark, sf):
    """H3 in append mode: weekly counts per event type of the windows the watermark has closed, and how many rows came too
    late. Three runs: the events of the first two thirds of the time, those of the rest, and every tenth event of
    the first week, which comes last and is too late."""
    from feedlake.streaming import feeds as SF
    landing, table, ck = scratch_path(spark, "window-events"), scratch_path(spark, "windows"), scratch_path(spark, "window-ck")
    ev = TB.events(spark, sf).select("event_id", "event_type", "ts")
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
    if lo is None:
        return spark.createDataFrame([], "event_type string, bin_start timestamp, n long, late_rows long")
    origin = lo.replace(hour=0, minute=0, second=0, microsecond=0)
    start = F.lit(origin.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
    tardy = (F.col("event_id") % 10 == 0) & (F.col("ts") < F.timestamp_add("DAY", F.lit(7), start))
    early = F.col("ts") < F.lit(lo + (hi - lo) * 2 / 3)
    late = 0
    for part in (ev.where(~tardy & early), ev.where(~tardy & ~early), ev.where(tardy)):
        part.write.mode("append").parquet(landing)
        closed, n = SF.closed_window_counts(spark, spark.readStream.schema(ev.schema).parquet(landing), origin.strftime("%Y-%m-%d %H:%M:%S"), table, ck)
        late += n
    return closed.select("event_type", "bin_start", "n", F.lit(late).cast("long").alias("late_rows"))


@query
def stream_keyword_mentions(spark, sf):
    """H3 on the archive: weekly mention series of all unseen articles' keywords from a documents
    stream, gap-filled at read time."""
    from feedlake.streaming import feeds as SF
    kw, _ = _unseen_keywords(spark, sf, C.KEYWORDS_PER_TITLE)
    s = SF.keyword_mention_stream(spark, sf, kw, days=C.MENTION_BIN_DAYS)
    return s.select("keyword", "bin_start", _long("mentions").alias("mentions"))


@query
def stream_mentions(spark, sf):
    """H3: 7-day tumbling counts per event type with a watermark (complete mode)."""
    from feedlake.streaming import feeds as SF
    return SF.windowed_counts(spark, sf).select("event_type", "bin_start", _long("n").alias("n"))
