import datetime as dt

from pyspark.sql import functions as F

from feedlake.operators import state as ST

SCHEMA = "k string, v string, ver long"


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_keep_first_last(spark):
    df = spark.createDataFrame([("a", "x", 2), ("a", "y", 1), ("b", "z", 5), ("a", "w", 3)], SCHEMA)
    assert rows(ST.keep_first(df, "k", ["ver"]), "k", "v") == [("a", "y"), ("b", "z")]
    assert rows(ST.keep_last(df, "k", ["ver"]), "k", "v") == [("a", "w"), ("b", "z")]


def test_keep_first_hot_key_is_aggregated(spark):
    # one key with most rows: the dedup plan is a hash aggregate with a partial (map-side) step
    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
                                   F.col("id").cast("string").alias("v"), F.col("id").alias("ver"))
    out = ST.keep_first(df, "k", ["ver"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan or "ObjectHashAggregate" in plan or "SortAggregate" in plan
    assert "Window" not in plan
    assert out.where("k = 'hot'").first()["v"] == "0"


def test_insert_if_absent_keeps_existing_and_is_idempotent(spark):
    ex = spark.createDataFrame([("a", "old", 9)], SCHEMA)
    b = spark.createDataFrame([("a", "new", 1), ("b", "b2", 2), ("b", "b1", 1)], SCHEMA)
    once = ST.insert_if_absent(ex, b, "k", ["ver"])
    assert rows(once, "k", "v") == [("a", "old"), ("b", "b1")]
    twice = ST.insert_if_absent(once, b, "k", ["ver"])
    assert rows(twice, "k", "v", "ver") == rows(once, "k", "v", "ver")


def test_upsert_replaces_whole_row(spark):
    ex = spark.createDataFrame([("a", "old", 9), ("c", "keep", 1)], SCHEMA)
    b = spark.createDataFrame([("a", None, 1), ("a", "mid", 0)], SCHEMA)
    out = ST.upsert_keep_last(ex, b, "k", ["ver"])
    # the batch row wins even with a smaller version, NULL fields included
    assert rows(out, "k", "v", "ver") == [("a", None, 1), ("c", "keep", 1)]
    again = ST.upsert_keep_last(out, b, "k", ["ver"])
    assert rows(again, "k", "v", "ver") == rows(out, "k", "v", "ver")


def test_memo_upsert_delete_lookup(spark):
    t0 = dt.datetime(2024, 1, 1)
    memo = spark.createDataFrame([("k1", "v1", "text", t0), ("k2", "", "text", t0)],
                                 "cache_key string, value string, content_type string, created_at timestamp")
    b = spark.createDataFrame([("k1", "v1b"), ("k3", "v3")], "cache_key string, value string")
    up = ST.memo_upsert(memo, b, "2024-02-01 00:00:00", "summary")
    got = {r["cache_key"]: (r["value"], r["content_type"], r["created_at"]) for r in up.collect()}
    assert got["k1"] == ("v1b", "summary", dt.datetime(2024, 2, 1)) and got["k2"][0] == ""
    dele = ST.memo_delete(up, spark.createDataFrame([("k2",), ("missing",)], "cache_key string"))
    assert sorted(r["cache_key"] for r in dele.collect()) == ["k1", "k3"]
    items = spark.createDataFrame([("k1",), ("k2",), ("zz",)], "cache_key string")
    look = {r["cache_key"]: r["cached"] for r in ST.memo_lookup(items, up, "cache_key").collect()}
    assert look == {"k1": "v1b", "k2": None, "zz": None}  # empty value counts as a miss


def test_unseen_plus_seen_is_input(spark):
    items = spark.createDataFrame([(i, f"h{i}") for i in range(50)], "id long, url_hash string")
    seen = spark.createDataFrame([(f"h{i}",) for i in range(0, 50, 3)], "url_hash string")
    u, s = ST.unseen(items, seen), ST.already_seen(items, seen)
    assert u.count() + s.count() == 50
    assert sorted(r.id for r in u.union(s).collect()) == list(range(50))


def test_item_key_falls_back_to_title(spark):
    import hashlib
    df = spark.createDataFrame([("", "T"), (None, "T"), ("L", "T")], "link string, title string")
    got = [r["h"] for r in df.select(ST.item_key("link", "title", 8).alias("h")).collect()]
    h = lambda s: hashlib.sha1(s.encode()).hexdigest()[:8]
    assert got == [h("T"), h("T"), h("L")]


def test_title_duplicates(spark):
    from feedlake.operators import select as S
    items = spark.createDataFrame([(1, "Breaking: Markets Fall"), (2, "Unrelated story"), (3, ""), (4, None),
                                   (5, "x" * 70), (6, "MARKETS"), (7, "\u0130" * 70), (8, "q")], "id long, title string")
    opens = spark.createDataFrame([("Auto: breaking: markets fall sharply",), ("prefix " + "x" * 65,), ("a " + "\u0130" * 80,)], "title string")
    # 1, 6: contained (case-insensitive); 3, 4: empty snippet matches; 5: first 60 chars contained; 7: lower case is longer
    out = S.title_duplicates_removed(items, opens)
    assert sorted(r.id for r in out.collect()) == [2, 8]
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()
    assert S.title_duplicates_removed(items, spark.createDataFrame([], "title string")).count() == 8


def test_upsert_hot_key_is_aggregated(spark):
    ex = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
                                  F.col("id").cast("string").alias("v"), F.col("id").alias("ver"))
    b = spark.createDataFrame([("hot", "new", -1)], SCHEMA)
    out = ST.upsert_keep_last(ex, b, "k", ["ver"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Aggregate" in plan
    assert out.where("k = 'hot'").collect()[0]["v"] == "new"
    assert out.count() == 2001
