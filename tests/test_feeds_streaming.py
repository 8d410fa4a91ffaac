import datetime as dt
import json
import os

from pyspark.sql import functions as F

from feedlake.operators import snapshots as SN
from feedlake import config as C
from feedlake.sources import feeds as FD
from feedlake.sources import pages as P
from feedlake.session import scratch_path
from feedlake.streaming import feeds as SF


def rss(title, items):
    body = "".join("<item>" + "".join(f"<{k}>{v}</{k}>" for k, v in it.items()) + "</item>" for it in items)
    t = f"<title>{title}</title>" if title is not None else ""
    return f'<rss version="2.0"><channel>{t}{body}</channel></rss>'


def test_rss_items(spark):
    five = [{"title": f" T{i} ", "link": f" https://x/{i} ", "description": "d" * 1200, "pubDate": "Mon, 01 Jan 2024 10:00:00 GMT"}
            for i in range(5)]
    payloads = [("https://a/feed.xml", rss("Chan", five)),
                ("https://b/feed.xml", rss(None, [{"title": "only"}])),          # no channel title, missing fields
                ("https://c/feed.xml", "<rss><channel><item><title>broken"),   # malformed
                ("https://d/feed.xml", rss("Empty", []))]
    df = spark.createDataFrame(payloads, "url string, payload string")
    got = sorted((r.feed_url, r.entry_pos, r.title, r.link, len(r.summary), r.published, r.source)
                 for r in FD.rss_items(df).collect())
    assert [g[1] for g in got if g[0] == "https://a/feed.xml"] == [0, 1, 2]        # first 3 in document order
    assert got[0][2:] == ("T0", "https://x/0", C.RSS_SUMMARY_CHARS, "Mon, 01 Jan 2024 10:00:00 GMT", "Chan")
    assert [g for g in got if g[0] == "https://b/feed.xml"] == [("https://b/feed.xml", 0, "only", "", 0, "", "https://b/feed.xml")]
    assert not [g for g in got if g[0] in ("https://c/feed.xml", "https://d/feed.xml")]


def test_json_items_and_routing(spark):
    good = json.dumps({"data": {"children": [
        {"data": {"title": "A", "permalink": "/r/x/1", "selftext": "s" * 600, "created_utc": 1704103200.0}},
        {"data": {}}]}})
    payloads = [("https://www.reddit.com/r/x/top/.json", good), ("https://www.reddit.com/r/y/.json", "{not json"),
                ("https://a/feed.xml", rss("Chan", [{"title": "R", "link": "L"}]))]
    df = spark.createDataFrame(payloads, "url string, payload string")
    got = sorted((r.source, r.title, r.link, len(r.summary), r.published) for r in FD.feed_items(df).collect())
    assert got == [("Chan", "R", "L", 0, ""),
                   ("Reddit", "", "https://reddit.com", 0, "1970-01-01T00:00:00"),
                   ("Reddit", "A", "https://reddit.com/r/x/1", C.JSON_SUMMARY_CHARS, "2024-01-01T10:00:00")]


def test_feed_rejects(spark):
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><title>A</title>%s'
    payloads = {"https://good/feed.xml": (rss("Chan", [{"title": "R"}]), None),
                "https://cut/feed.xml": ("<rss><channel><item><title>broken", "malformed"),
                "https://page/feed.xml": ("<html><body>503</body></html>", "not a feed"),
                "https://text/feed.xml": ("Service unavailable", "malformed"),
                "https://bare/feed.xml": (rss("Empty", []), "no entries"),
                "https://blank/feed.xml": (" \n", "empty"), "https://null/feed.xml": (None, "empty"),
                "https://atom/feed": (atom % "<entry><title>e</title></entry></feed>", None),
                "https://atom/cut": (atom % "<entry><title>e</title>", "malformed"),
                "https://atom/bare": (atom % "</feed>", "no entries"),
                "https://www.reddit.com/r/a/.json": ('{"data": {"children": [{"data": {"title": "t"}}]}}', None),
                "https://www.reddit.com/r/b/.json": ('{"data": {"children": [{"data": {"title', "malformed"),
                "https://www.reddit.com/r/c/.json": ('{"data": {"children": "none"}}', "malformed"),
                "https://www.reddit.com/r/d/.json": ('{"error": 404}', "not a feed"),
                "https://www.reddit.com/r/e/.json": ('{"data": {"children": []}}', "no entries")}
    df = spark.createDataFrame([(u, p) for u, (p, _) in payloads.items()] + [(None, "x")], "url string, payload string")
    got = {r.feed_url: (r.reason, r.payload) for r in FD.feed_rejects(df).collect()}
    assert got == {**{u: (why, p) for u, (p, why) in payloads.items() if why}, None: ("malformed", "x")}
    assert {r.feed_url for r in FD.feed_items(df).collect()} == set(payloads) - {u for u in got}
    assert FD.feed_rejects(df.limit(0)).count() == 0


def test_feed_items_reads_payloads_once(spark, tmp_path):
    spark.createDataFrame([("https://a/feed.xml", "<rss/>")], "url string, payload string").write.parquet(str(tmp_path / "p"))
    plan = FD.feed_items(spark.read.parquet(str(tmp_path / "p")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_source_list(spark, tmp_path):
    p = tmp_path / "sources.json"
    p.write_text(json.dumps(["https://new/feed", C.DEFAULT_SOURCES[2], "https://new/feed", "https://other"]))
    out = [(r.pos, r.url) for r in FD.source_list(spark, FD.read_source_file(spark, str(p))).collect()]
    assert [u for _, u in out] == C.DEFAULT_SOURCES + ["https://new/feed", "https://other"]
    bad = tmp_path / "bad.json"
    bad.write_text("{oops")
    assert [u for _, u in FD.source_list(spark, FD.read_source_file(spark, str(bad))).collect()] == C.DEFAULT_SOURCES
    missing = FD.read_source_file(spark, str(tmp_path / "missing.json"))
    assert [u for _, u in FD.source_list(spark, missing).collect()] == C.DEFAULT_SOURCES


def test_seen_import_idempotent(spark):
    seen = spark.createDataFrame([("h1", "u1", None)], "url_hash string, url string, first_seen timestamp")
    lists = spark.createDataFrame([(json.dumps(["h1", "h2", "h2"]),), ("not json",)], "payload string")
    once = FD.import_seen(seen, FD.seen_hashes(lists), "2024-04-01 00:00:00")
    twice = FD.import_seen(once, FD.seen_hashes(lists), "2024-05-01 00:00:00")
    assert sorted((r.url_hash, r.url) for r in once.collect()) == [("h1", "u1"), ("h2", None)]
    assert sorted(tuple(r) for r in twice.collect()) == sorted(tuple(r) for r in once.collect())


def test_artifact_listing_and_sitemap(spark, tmp_path):
    from feedlake.sinks import export as X
    for n in ("b.html", "a.html", "c.txt"):
        (tmp_path / n).write_text("<html></html>")
    listing = P.artifact_listing(spark, str(tmp_path))
    entries = X.sitemap_entries(listing)
    got = sorted((r.name, r.loc, r.changefreq, r.priority) for r in entries.collect())
    assert got == [("a.html", "https://example.com/previews/a.html", "daily", "0.6"),
                   ("b.html", "https://example.com/previews/b.html", "daily", "0.6")]
    docs = {d["name"]: d["value"] for d in X.sitemap_document(entries).collect()}
    assert set(docs) == {"sitemap.xml", "sitemap-0.xml"} and "<loc>https://example.com/sitemap-0.xml</loc>" in docs["sitemap.xml"]
    assert docs["sitemap-0.xml"].index("a.html") < docs["sitemap-0.xml"].index("b.html") and docs["sitemap-0.xml"].endswith("</urlset>\n")
    # every part but the last is full, and parts follow the names
    many = spark.range(25).select(F.format_string("p%03d.html", "id").alias("name"), F.format_string("p%03d", "id").alias("loc"),
                                  F.lit("T").alias("lastmod"), F.lit("daily").alias("changefreq"), F.lit("0.6").alias("priority"))
    docs = {d["name"]: d["value"] for d in X.sitemap_document(many.repartition(4), max_urls=10).collect()}
    assert [docs[f"sitemap-{k}.xml"].count("<url>") for k in range(3)] == [10, 10, 5] and docs["sitemap.xml"].count("<sitemap>") == 3
    assert "p010" in docs["sitemap-1.xml"] and "p009" not in docs["sitemap-1.xml"]
    assert [d["name"] for d in X.sitemap_document(many.where("false")).collect()] == ["sitemap.xml"]


def test_rss_other_shapes(spark):
    dc = ('<rss xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>C</title>'
          '<item><title>t</title><dc:date>2024-01-02T00:00:00Z</dc:date><content:encoded>body</content:encoded></item></channel></rss>')
    rdf = ('<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>R</title></channel>'
           '<item><title>a</title><link>l</link><dc:date>2024-01-03</dc:date></item><item><title>b</title></item></rdf:RDF>')
    df = spark.createDataFrame([("u", dc), ("v", rdf)], "url string, payload string")
    got = sorted((r.source, r.title, r.link, r.summary, r.published) for r in FD.feed_items(df).collect())
    assert got == [("C", "t", "", "body", "2024-01-02T00:00:00Z"), ("R", "a", "l", "", "2024-01-03"), ("R", "b", "", "", "")]


def test_streaming_matches_batch(spark):
    sf = "/root/testdata/sf0.001"
    ev = spark.read.parquet(os.path.join(sf, "events.parquet"))
    assert SF.ingest_events(spark, sf).count() == ev.count()
    first = SF.first_seen_stream(spark, sf)
    assert first.count() == ev.select("user_id").distinct().count()
    counts = SF.windowed_counts(spark, sf)
    assert counts.agg(F.sum("n")).first()[0] == ev.count()


def test_atom_items(spark):
    atom = ('<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><title>Atom Chan</title>'
            + "".join(f'<entry><title> E{i} </title><link rel="self" href="https://x/self{i}"/>'
                      f'<link rel="alternate" href="https://x/{i}"/><summary>S{i}</summary>'
                      f'<updated>2024-01-0{i + 1}T00:00:00Z</updated></entry>' for i in range(4))
            + "</feed>")
    df = spark.createDataFrame([("https://a/atom", atom)], "url string, payload string")
    got = sorted((r.entry_pos, r.title, r.link, r.summary, r.published, r.source) for r in FD.feed_items(df).collect())
    assert got == [(i, f"E{i}", f"https://x/{i}", f"S{i}", f"2024-01-0{i + 1}T00:00:00Z", "Atom Chan") for i in range(3)]


def test_stream_feed_ingest_skips_seen_items(spark):
    landing, table, seen, ck = (scratch_path(spark, n) for n in ("landing", "items", "seen", "ck"))
    one = [{"title": f"T{i}", "link": f"https://x/{i}"} for i in range(2)]
    two = [{"title": f"T{i}", "link": f"https://x/{i}"} for i in range(1, 3)]   # x/1 already seen
    rows = lambda items: [("https://a/feed.xml", "2024-01-01 00:00:00", rss("A", items))]
    spark.createDataFrame(rows(one), "url string, fetched_at string, payload string").write.json(landing + "/b1")
    SF.ingest_feed_payloads(spark, landing + "/*", table, seen, ck).awaitTermination()
    spark.createDataFrame(rows(two), "url string, fetched_at string, payload string").write.json(landing + "/b2")
    SF.ingest_feed_payloads(spark, landing + "/*", table, seen, ck).awaitTermination()
    got = sorted((r.link, r._epoch) for r in spark.read.parquet(table).collect())
    assert [g[0] for g in got] == ["https://x/0", "https://x/1", "https://x/2"]
    assert got[0][1] == got[1][1] < got[2][1]
    assert SN.read(spark, seen).count() == 3


def test_source_file_multiline(spark, tmp_path):
    p = tmp_path / "sources.json"
    p.write_text(json.dumps(["https://n/1", "https://n/2"], indent=2))
    got = [u for _, u in FD.source_list(spark, FD.read_source_file(spark, str(p))).collect()]
    assert got == C.DEFAULT_SOURCES + ["https://n/1", "https://n/2"]


def test_first_seen_within_watermark(spark):
    sf = "/root/testdata/sf0.001"
    ev = spark.read.parquet(os.path.join(sf, "events.parquet"))
    got = SF.first_seen_within_watermark(spark, sf, watermark="365 days")
    assert sorted(r.user_id for r in got.collect()) == sorted(r.user_id for r in ev.select("user_id").distinct().collect())


def _dealt_events(spark, tmp_path):
    """The events as a folder of part files that are not in time order, two of them held back."""
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    parts = tmp_path / "parts"
    ev.repartition(5, F.pmod(F.hash("event_id"), F.lit(5))).write.parquet(str(parts))
    files = sorted(p for p in parts.iterdir() if p.name.startswith("part-") and p.stat().st_size > 2000)
    folder = tmp_path / "sf" / "events.parquet"
    folder.mkdir(parents=True)
    for f in files[:-1]:
        (folder / f.name).write_bytes(f.read_bytes())
    return ev, folder, files[-1]


def test_streams_over_a_folder_of_files_and_resume(spark, tmp_path):
    ev, folder, late = _dealt_events(spark, tmp_path)
    sf, where = str(tmp_path / "sf"), {"table": str(tmp_path / "out"), "checkpoint": str(tmp_path / "offsets")}
    rows = spark.read.parquet(str(folder)).count()
    assert 0 < rows < ev.count()
    assert SF.ingest_events(spark, sf, **where).count() == rows
    assert SF.windowed_counts(spark, sf).agg(F.sum("n")).first()[0] == rows  # no row is late in a replay
    seen = {"table": str(tmp_path / "seen"), "checkpoint": str(tmp_path / "seen-offsets")}
    SF.first_seen_stream(spark, sf, **seen).count()
    (folder / late.name).write_bytes(late.read_bytes())
    assert SF.ingest_events(spark, sf, **where).count() == ev.count()  # resumed: only the new file is added
    first = {(r.user_id, r.event_id) for r in SF.first_seen_stream(spark, sf, **seen).collect()}
    assert {u for u, _ in first} == {r.user_id for r in ev.select("user_id").distinct().collect()}


def test_keyword_stream_equals_the_batch_series(spark, tmp_path):
    from feedlake.operators import mentions as MN
    from feedlake.plans import brief as B
    folder = tmp_path / "documents.parquet"
    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(4).write.parquet(str(folder))
    words = spark.createDataFrame([(w,) for w in ["the", "Ention", "thereisnosuchword", "and"] + [f"w{i}" for i in range(100)]], "keyword string")
    got = SF.keyword_mention_stream(spark, str(tmp_path), words, days=7, max_files=1)
    want = MN.mention_series(B.archive_text(B.keyed_articles(spark, str(tmp_path))), words, days=7)
    rows = lambda df: sorted((r.keyword, r.bin_start, r.mentions) for r in df.collect())
    assert rows(got) == rows(want) and sum(r[2] for r in rows(got)) > 0


def _land(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def test_first_seen_with_expiry(spark, tmp_path):
    landing, table, ck = (str(tmp_path / n) for n in ("in", "seen", "ck"))
    schema, day = "user_id long, event_id long, ts timestamp", lambda d, h=0: dt.datetime(2024, 1, 1) + dt.timedelta(days=d, hours=h)

    def run():
        got = SF.first_seen_with_expiry(spark, spark.readStream.schema(schema).parquet(landing), table, ck, forget_days=30)
        return sorted(((r.user_id, r.event_id, r.ts) for r in got.collect()), key=str)

    # out of order inside the watermark, ties by event_id, a null user, rows without time or id left out
    _land(spark, landing, [(1, 5, day(3, 6)), (1, 4, day(3, 2)), (2, 9, day(3)), (2, 8, day(3)), (None, 1, day(1)), (3, 1, None), (3, None, day(3)), (4, 7, day(3, 20))], schema)
    first = run()
    assert first == sorted([(None, 1, day(1))], key=str)  # the watermark stands at day 2, 20 h: the others may still have earlier rows
    _land(spark, landing, [(1, 6, day(3, 1)), (2, 10, day(6)), (5, 1, day(6))], schema)
    second = run()
    assert second == sorted([(None, 1, day(1)), (1, 6, day(3, 1)), (2, 8, day(3)), (4, 7, day(3, 20))], key=str)  # user 1: by the later file's earlier row
    assert run() == second  # a run without new files gives nothing twice
    _land(spark, landing, [(6, 1, day(60))], schema)  # the watermark passes 30 days after everyone's last row
    assert run() == sorted([*second, (5, 1, day(6))], key=str)
    _land(spark, landing, [(1, 99, day(70)), (1, 98, day(69, 12)), (7, 1, day(80))], schema)
    assert run() == sorted([*second, (5, 1, day(6)), (6, 1, day(60)), (1, 98, day(69, 12))], key=str)


def test_closed_windows_and_late_rows(spark, tmp_path):
    landing, table, ck = (str(tmp_path / n) for n in ("in", "closed", "ck"))
    schema, day = "ts timestamp, event_type string", lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d)

    def run():
        closed, late = SF.closed_window_counts(spark, spark.readStream.schema(schema).parquet(landing), "2024-01-01 00:00:00", table, ck)
        return sorted((str(r.event_type), r.bin_start, r.n) for r in closed.collect()), late

    _land(spark, landing, [(day(0), "a"), (day(1), "a"), (day(9), "b"), (day(6), None), (None, "a")], schema)
    week = [("None", day(0), 1), ("a", day(0), 2)]
    assert run() == (week, 1)  # the row without time is in no window
    _land(spark, landing, [(day(2), "a"), (day(3), "a"), (day(4), "c"), (day(8), "b"), (day(20), "b")], schema)
    assert run() == ([*week, ("b", day(7), 2)], 3)  # two of them share window and type: rows are counted, not groups
    assert run() == ([*week, ("b", day(7), 2)], 0)
