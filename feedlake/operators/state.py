"""Keyed table maintenance and key lookups: keep-first insert, keep-last upsert, memo upsert and
delete, unseen/seen filters, memo lookup, seen history. Stored tables: operators/snapshots.py.

Dedup is an aggregate (min_by / max_by over a struct), not a row_number window: the hash
aggregate combines map-side, so a key holding a third of all rows is reduced to one row per
input partition before the shuffle instead of landing whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.functions import text as T


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _pick(df: DataFrame, key, order: Sequence[str], fn) -> DataFrame:
    keys = _keys(key)
    payload = [c for c in df.columns if c not in keys]
    row = F.struct(*payload) if payload else F.lit(1)
    agg = df.groupBy(*keys).agg(fn(row, F.struct(*order)).alias("_row"))
    return agg.select(*keys, *([F.col(f"_row.{c}").alias(c) for c in payload]))


def keep_first(df: DataFrame, key, order: Sequence[str]) -> DataFrame:
    """One row per key: the smallest `order` tuple wins (arrival order must be given explicitly)."""
    return _pick(df, key, order, F.min_by)


def keep_last(df: DataFrame, key, order: Sequence[str]) -> DataFrame:
    """One row per key: the largest `order` tuple wins."""
    return _pick(df, key, order, F.max_by)


def insert_if_absent(existing: DataFrame, batch: DataFrame, key, order: Sequence[str]) -> DataFrame:
    """INSERT OR IGNORE: batch deduped keep-first, keys already present are ignored, existing
    rows never change."""
    keys = _keys(key)
    fresh = keep_first(batch.select(*existing.columns), keys, order)
    fresh = fresh.join(existing.select(*keys), keys, "left_anti")
    return existing.unionByName(fresh)


def upsert_keep_last(existing: DataFrame, batch: DataFrame, key, order: Sequence[str]) -> DataFrame:
    """INSERT OR REPLACE: the last batch row per key replaces the whole stored row (NULL
    fields included), whatever the stored row's version; keys absent from the batch keep
    their stored row."""
    keys = _keys(key)
    cols = existing.columns
    tagged = (existing.select(*cols).withColumn("_gen", F.lit(0))
              .unionByName(batch.select(*cols).withColumn("_gen", F.lit(1))))
    return keep_last(tagged, keys, ["_gen", *order]).select(*cols)


def memo_upsert(memo: DataFrame, batch: DataFrame, as_of, content_type: str | None = None) -> DataFrame:
    """cache_set for a batch of (cache_key, value[, content_type]); created_at refreshed to as_of.
    Within the batch the last row per key (by `_seq` if present) wins."""
    b = batch
    if "content_type" not in b.columns:
        b = b.withColumn("content_type", F.lit(content_type or "text"))
    if "_seq" not in b.columns:
        b = b.withColumn("_seq", F.lit(0))
    b = b.withColumn("created_at", F.lit(as_of).cast("timestamp"))
    m = memo.withColumn("_seq", F.lit(0))
    return upsert_keep_last(m, b.select(*m.columns), "cache_key", ["_seq"]).drop("_seq")


def memo_delete(memo: DataFrame, keys: DataFrame) -> DataFrame:
    """cache_delete for a set of keys; a missing key is a no-op."""
    return memo.join(keys.select("cache_key").distinct(), "cache_key", "left_anti")


def item_key(link, title, hash_len: int = 40):
    """Seen key of a feed item: hash of the link, else of the title ('' counts as missing)."""
    return T.short_hash(T.first_truthy(link, title), hash_len)


def unseen(items: DataFrame, seen: DataFrame, key: str = "url_hash") -> DataFrame:
    return items.join(seen.select(F.col("url_hash").alias(key)), key, "left_anti")


def already_seen(items: DataFrame, seen: DataFrame, key: str = "url_hash") -> DataFrame:
    return items.join(seen.select(F.col("url_hash").alias(key)), key, "left_semi")


def memo_lookup(items: DataFrame, memo: DataFrame, key_col: str, out: str = "cached") -> DataFrame:
    """Left lookup of memo values; a miss and an empty value both give NULL."""
    m = memo.select(F.col("cache_key").alias(key_col), T.truthy("value").alias(out))
    return items.join(m, key_col, "left")


def seen_history(seen: DataFrame) -> DataFrame:
    return seen.orderBy(F.col("first_seen").desc(), F.col("url_hash"))
