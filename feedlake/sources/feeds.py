"""Feed ingest: landed RSS/Atom and reddit-style JSON payloads -> normalised feed items,
source routing and union, the ordered source list, and seen-hash import.

A payload is one fetched document (url, payload). Payloads are parsed with explicit schemas
(`from_xml` / `from_json`, never inference); a malformed payload parses to NULL and yields no
items, so one bad feed never fails the batch; `feed_rejects` keeps it with the reason. Items carry (feed_url, entry_pos) so arrival
order is explicit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from feedlake import config as C
from feedlake.functions import dates as D
from feedlake.functions import text as T

RSS_ITEM = Ty.StructType([
    Ty.StructField("title", Ty.StringType()),
    Ty.StructField("link", Ty.StringType()),
    Ty.StructField("description", Ty.StringType()),
    Ty.StructField("content:encoded", Ty.StringType()),
    Ty.StructField("pubDate", Ty.StringType()),
    Ty.StructField("dc:date", Ty.StringType()),
])
RSS_SCHEMA = Ty.StructType([
    Ty.StructField("item", Ty.ArrayType(RSS_ITEM)),  # RSS 1.0: items stand beside the channel
    Ty.StructField("channel", Ty.StructType([
        Ty.StructField("title", Ty.StringType()),
        Ty.StructField("item", Ty.ArrayType(RSS_ITEM)),
    ])),
])
JSON_POST = Ty.StructType([
    Ty.StructField("title", Ty.StringType()),
    Ty.StructField("permalink", Ty.StringType()),
    Ty.StructField("selftext", Ty.StringType()),
    Ty.StructField("created_utc", Ty.DoubleType()),
])
JSON_SCHEMA = Ty.StructType([
    Ty.StructField("data", Ty.StructType([
        Ty.StructField("children", Ty.ArrayType(Ty.StructType([Ty.StructField("data", JSON_POST)]))),
    ])),
])
ATOM_ENTRY = Ty.StructType([
    Ty.StructField("title", Ty.StringType()),
    Ty.StructField("link", Ty.ArrayType(Ty.StructType([Ty.StructField("_href", Ty.StringType()),
                                                       Ty.StructField("_rel", Ty.StringType())]))),
    Ty.StructField("summary", Ty.StringType()),
    Ty.StructField("content", Ty.StringType()),
    Ty.StructField("published", Ty.StringType()),
    Ty.StructField("updated", Ty.StringType()),
])
ATOM_SCHEMA = Ty.StructType([
    Ty.StructField("title", Ty.StringType()),
    Ty.StructField("entry", Ty.ArrayType(ATOM_ENTRY)),
])
ITEM_COLUMNS = ["feed_url", "entry_pos", "title", "link", "summary", "published", "source"]


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed payload files, one row per file: (url = file path, payload)."""
    return (spark.read.text(path, wholetext=True)
            .select(F.input_file_name().alias("url"), F.col("value").alias("payload")))


def is_json_feed(url) -> F.Column:
    u = T.col_(url)
    return u.contains("reddit.com") & u.endswith(".json")


CORRUPT = "_corrupt_record"
ENTRY = "array<struct<title: string, link: string, summary: string, published: string>>"


def is_atom(payload) -> F.Column:
    """An Atom document: its root element is <feed> (after an optional XML declaration)."""
    return T.col_(payload).rlike(r"^\s*(<\?xml[^>]*\?>\s*)?<feed[\s>]")


def payload_kind(url="url", payload="payload") -> F.Column:
    """Which reader takes a payload: 'json' for a reddit *.json url, 'atom' by the root element, else 'rss'."""
    return (F.when(F.coalesce(is_json_feed(url), F.lit(False)), "json")
            .when(F.coalesce(is_atom(payload), F.lit(False)), "atom").otherwise("rss"))


def _parsed(payloads: DataFrame, kind) -> DataFrame:
    """(feed_url, kind, payload, rss, atom, json): each payload parsed once, by its own reader; the other two
    documents are NULL. A document that can't be read whole keeps its text in the corrupt-record field."""
    of = lambda k, doc: F.when(F.col("kind") == k, doc)
    return (payloads.select(F.col("url").alias("feed_url"), kind.alias("kind"), "payload")
            .select("*", of("rss", F.from_xml("payload", _flagged(RSS_SCHEMA))).alias("rss"),
                    of("atom", F.from_xml("payload", _flagged(ATOM_SCHEMA))).alias("atom"),
                    of("json", F.from_json("payload", _flagged(JSON_SCHEMA))).alias("json")))


def _flagged(schema: Ty.StructType) -> Ty.StructType:
    return Ty.StructType([*schema.fields, Ty.StructField(CORRUPT, Ty.StringType())])


def _rss_entries(limit: int) -> F.Column:
    return F.transform(F.slice(F.coalesce("rss.channel.item", "rss.item"), 1, limit), lambda e: F.struct(
        T.full_trim(F.coalesce(e["title"], F.lit(""))).alias("title"),
        T.full_trim(F.coalesce(e["link"], F.lit(""))).alias("link"),
        T.cut(F.coalesce(e["description"], e["content:encoded"], F.lit("")), C.RSS_SUMMARY_CHARS).alias("summary"),
        F.coalesce(e["pubDate"], e["dc:date"], F.lit("")).alias("published")))


def _atom_entries(limit: int) -> F.Column:
    def href(links):
        alternate = F.filter(links, lambda l: F.coalesce(l["_rel"], F.lit("alternate")) == "alternate")
        return F.coalesce(F.get(alternate, 0)["_href"], F.get(links, 0)["_href"])

    return F.transform(F.slice("atom.entry", 1, limit), lambda e: F.struct(
        T.full_trim(F.coalesce(e["title"], F.lit(""))).alias("title"),
        T.full_trim(F.coalesce(href(e["link"]), F.lit(""))).alias("link"),
        T.cut(F.coalesce(e["summary"], e["content"], F.lit("")), C.RSS_SUMMARY_CHARS).alias("summary"),
        F.coalesce(e["published"], e["updated"], F.lit("")).alias("published")))


def _json_entries() -> F.Column:
    return F.transform("json.data.children", lambda c: F.struct(
        F.coalesce(c["data"]["title"], F.lit("")).alias("title"),
        F.concat(F.lit(C.JSON_LINK_PREFIX), F.coalesce(c["data"]["permalink"], F.lit(""))).alias("link"),
        T.cut(F.coalesce(c["data"]["selftext"], F.lit("")), C.JSON_SUMMARY_CHARS).alias("summary"),
        D.iso_naive(D.epoch_to_ts(c["data"]["created_utc"])).alias("published")))


def _entries(limit: int) -> F.Column:
    by_kind = F.when(F.col("kind") == "json", _json_entries()).when(F.col("kind") == "atom", _atom_entries(limit)).otherwise(_rss_entries(limit))
    return F.coalesce(by_kind.cast(ENTRY), F.array().cast(ENTRY))


def _items(payloads: DataFrame, kind, limit: int) -> DataFrame:
    source = (F.when(F.col("kind") == "json", F.lit(C.JSON_SOURCE_NAME))
              .otherwise(F.coalesce("rss.channel.title", "atom.title", "feed_url")))
    e = _parsed(payloads, kind).select("feed_url", source.alias("source"), F.posexplode(_entries(limit)).alias("entry_pos", "e"))
    return e.select("feed_url", "entry_pos", "e.title", "e.link", "e.summary", "e.published", "source")


def rss_items(payloads: DataFrame, limit: int = C.ENTRIES_PER_FEED) -> DataFrame:
    """RSS payloads (0.9x, 2.0 and RDF) -> items: first `limit` entries in document order; title/link
    trimmed, summary (description, else content:encoded) cut to 1000, published pubDate else dc:date,
    source = channel title else the feed url. Bad payload -> no rows."""
    return _items(payloads, F.lit("rss"), limit)


def json_items(payloads: DataFrame) -> DataFrame:
    """reddit-style JSON payloads -> items (all children, no limit): link = prefix + permalink,
    summary = selftext cut to 500, published = naive ISO of created_utc (0 when missing),
    source 'Reddit'. Missing fields -> ''. Malformed payload -> no rows."""
    return _items(payloads, F.lit("json"), C.ENTRIES_PER_FEED)


def atom_items(payloads: DataFrame, limit: int = C.ENTRIES_PER_FEED) -> DataFrame:
    """Atom payloads -> items with the RSS rules: first `limit` entries, link = the alternate
    (or first) link's href, summary (else content) cut to 1000, published else updated, source =
    feed title else the feed url."""
    return _items(payloads, F.lit("atom"), limit)


def feed_items(payloads: DataFrame, limit: int = C.ENTRIES_PER_FEED) -> DataFrame:
    """All payloads -> items, each by its own reader (payload_kind), in one pass over the payloads. A payload
    that fails gives no rows and harms no other; feed_rejects tells which and why."""
    return _items(payloads, payload_kind(), limit)


def feed_rejects(payloads: DataFrame) -> DataFrame:
    """The payloads that give no items, or not all: (feed_url, kind, reason, payload), a row for each such
    payload. Reasons: 'empty' (null or white space), 'malformed' (not well-formed, or a field of another type
    than the format's), 'not a feed' (well-formed, without the format's container), 'no entries'."""
    p = _parsed(payloads, payload_kind())
    corrupt = F.coalesce(*(F.col(f"{k}.{CORRUPT}") for k in ("rss", "atom", "json")))
    feed = (F.when(F.col("kind") == "json", F.col("json.data.children").isNotNull())
            .when(F.col("kind") == "atom", F.lit(True))  # the root element said so
            .otherwise(F.col("rss.channel").isNotNull() | F.col("rss.item").isNotNull()))
    reason = (F.when(T.full_trim(F.coalesce("payload", F.lit(""))) == "", "empty")
              .when(corrupt.isNotNull(), "malformed").when(~feed, "not a feed")
              .when(F.size(_entries(1)) == 0, "no entries"))
    return p.select("feed_url", "kind", reason.alias("reason"), "payload").where(F.col("reason").isNotNull())


def with_item_keys(items: DataFrame, hash_len: int = 40) -> DataFrame:
    """Adds url_hash (hash of link, else title) and published_ts (mixed-format parse)."""
    from feedlake.operators.state import item_key
    return (items.withColumn("url_hash", item_key("link", "title", hash_len))
            .withColumn("published_ts", D.parse_published("published")))


def source_list(spark: SparkSession, file_sources: DataFrame | None = None,
                defaults: list[str] | None = None) -> DataFrame:
    """Defaults first, then the user's list (pos, url); first occurrence wins.
    Returns (pos, url) ordered by pos, where pos is the first position in the combined list."""
    d = defaults if defaults is not None else C.DEFAULT_SOURCES
    base = spark.createDataFrame([(i, u) for i, u in enumerate(d)], "pos long, url string")
    allsrc = base
    if file_sources is not None:
        allsrc = base.unionByName(file_sources.select((F.col("pos") + len(d)).cast("long").alias("pos"), "url"))
    return (allsrc.where(F.col("url").isNotNull()).groupBy("url").agg(F.min("pos").alias("pos"))
            .select("pos", "url").orderBy("pos"))


def read_source_file(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of urls -> (pos, url); a missing or invalid file gives no rows."""
    try:
        raw = spark.read.text(path, wholetext=True)
    except Exception:  # missing file: defaults only
        return spark.createDataFrame([], "pos long, url string")
    arr = raw.select(F.from_json("value", "array<string>").alias("a"))
    return arr.select(F.posexplode(F.coalesce("a", F.array().cast("array<string>"))).alias("pos", "url")) \
              .select(F.col("pos").cast("long"), "url")


def seen_hashes(payloads: DataFrame) -> DataFrame:
    """JSON arrays of hash strings -> (url_hash); invalid payloads give nothing."""
    a = payloads.select(F.from_json("payload", "array<string>").alias("a"))
    return a.select(F.explode(F.coalesce("a", F.array().cast("array<string>"))).alias("url_hash")) \
            .where(F.col("url_hash").isNotNull())


def import_seen(seen: DataFrame, hashes: DataFrame, as_of) -> DataFrame:
    """Seen-list migration: each hash inserted if absent with url NULL, first_seen = as_of.
    Idempotent: importing the same list twice changes nothing."""
    from feedlake.operators.state import insert_if_absent
    batch = hashes.select("url_hash", F.lit(None).cast("string").alias("url"),
                          F.lit(as_of).cast("timestamp").alias("first_seen"))
    return insert_if_absent(seen.select("url_hash", "url", "first_seen"), batch, "url_hash", ["first_seen"])


# ------------------------------------------------------------- payload builders (for tests/queries)

def xml_text(c) -> F.Column:
    s = F.replace(T.col_(c), F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(s, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def rss_payload(channel_title, items) -> F.Column:
    """RSS document text from an array<struct<title,link,description,pubDate>>."""
    item_xml = F.transform(items, lambda e: F.concat(
        F.lit("<item><title>"), xml_text(e["title"]), F.lit("</title><link>"), xml_text(e["link"]),
        F.lit("</link><description>"), xml_text(e["description"]), F.lit("</description><pubDate>"),
        xml_text(e["pubDate"]), F.lit("</pubDate></item>")))
    return F.concat(F.lit('<rss version="2.0"><channel><title>'), xml_text(channel_title), F.lit("</title>"),
                    F.array_join(item_xml, ""), F.lit("</channel></rss>"))


def json_payload(posts) -> F.Column:
    """reddit-style listing JSON from an array<struct<title,permalink,selftext,created_utc>>."""
    return F.to_json(F.struct(F.struct(F.transform(posts, lambda p: F.struct(p.alias("data"))).alias("children")).alias("data")))
