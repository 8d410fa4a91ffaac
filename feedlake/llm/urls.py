"""URL filters: ordered rules, and behind them an exact host list in a Bloom filter cascade.

The cascade answers "is this key listed?" without a join and without error over a known universe of
keys, here all hosts of the corpus and their parent domains. Level 1 holds the listed keys. Level 2
holds the universe's other keys that level 1 lets pass by mistake, level 3 the listed keys that level 2
holds by mistake, and so on until no mistake is left. The first level that a key is not in decides.

Building: the universe is made distinct by a shuffle once; each level's bits are set in the tasks, joined
by word with bit_or, and only the bits (BITS for each key) reach the driver. A list whose level 1 would
be larger than MOST_BITS is dealt by hash into shards, one scan for each, chained.

Defined cases: a null url, or one without ://, has an empty host and path, which no rule with a host
fits and no list holds; repeated rows are judged alike; an empty list allows all; an empty table gives
none; keys of equal length and rank go by the rule's place; extra columns pass through (`judged` puts
its own in place of input columns of their names).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from feedlake.llm.common import packed, stored, table, unpacked

#: Bits for each key of a level and hash functions: about 1 % pass by mistake.
BITS, HASHES = 10, 7
MOST_BITS = 1 << 30
U = np.uint64


# -- parts of a url ----------------------------------------------------------------------------------------


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def host_keys(host: Column) -> Column:
    """The host and its parent domains, without empty ones."""
    parts = F.split(host, r"\.")
    keys = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    return F.filter(keys, lambda k: k != "")


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; rules are (verdict, host, path)."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


# -- the cascade -------------------------------------------------------------------------------------------


def _places(a: np.ndarray, b: np.ndarray, level: int, m: int) -> np.ndarray:
    """HASHES places of each key in a filter of m bits."""
    x = (a.view(U) ^ U(0x9E3779B97F4A7C15 * (level + 1) & 0xFFFFFFFFFFFFFFFF)) * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(31)
    y = (b.view(U) + x) * U(0x94D049BB133111EB) | U(1)
    y ^= (y >> U(32)) << U(1)
    return (x[None, :] + np.arange(HASHES, dtype=U)[:, None] * y[None, :]) % U(m)


class Cascade:
    """Levels of (bits, words)."""

    def __init__(self, levels: list[tuple[int, np.ndarray]] | None = None):
        self.levels = levels or []

    def passes(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        m, words = self.levels[level]
        at = _places(a, b, level, m)
        return ((words[(at >> U(6)).astype(np.int64)] >> (at & U(63))) & U(1)).all(axis=0)

    def holds(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.full(len(a), len(self.levels) % 2 == 1)
        alive = np.arange(len(a))
        for level in range(len(self.levels)):
            ok = self.passes(level, a[alive], b[alive])
            out[alive[~ok]] = level % 2 == 1
            alive = alive[ok]
        return out


def _level(keys: DataFrame, n: int, level: int) -> tuple[int, np.ndarray]:
    m = max(64, BITS * n)

    def run(batches):
        for batch in batches:
            at = np.unique(_places(batch.column(0).to_numpy(), batch.column(1).to_numpy(), level, m))
            word, bit = (at >> U(6)).astype(np.int64), U(1) << (at & U(63))
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else np.zeros(0, np.int64)
            bits = np.bitwise_or.reduceat(bit, first) if len(word) else bit
            yield pa.RecordBatch.from_arrays([pa.array(word[first]), pa.array(bits.view(np.int64))], names=["word", "bits"])

    found = keys.select("a", "b").mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(m // 64 + 1, U)
    words[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(U)
    return m, words


def _passing(keys: DataFrame, cascade: Cascade, level: int) -> DataFrame:
    sent = keys.sparkSession.sparkContext.broadcast(cascade)

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(sent.value.passes(level, b.column("a").to_numpy(), b.column("b").to_numpy()), pa.bool_()))

    return keys.mapInArrow(run, keys.schema)


def _hashed(keys: DataFrame) -> DataFrame:
    return keys.select("key", F.xxhash64("key").alias("a"), F.xxhash64("key", F.lit(1)).alias("b"))


def build(listed: DataFrame, universe: DataFrame) -> Cascade:
    """listed(key), universe(key) -> a cascade that is exact for every key of the universe."""
    inside = stored(_hashed(listed.where("key is not null").distinct()), "bloom-listed")
    outside = stored(_hashed(universe.where("key is not null").distinct().join(inside.select("key"), "key", "left_anti")), "bloom-others")
    cascade, sides, level = Cascade(), [inside, outside], 0
    while n := sides[0].count():
        cascade.levels.append(_level(sides[0], n, level))
        through = stored(_passing(sides[1], cascade, level), f"bloom-{level + 1}")
        sides, level = [through, sides[0]], level + 1
    return cascade


def judged(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]], url: str = "url", keep: list[str] | None = None) -> DataFrame:
    """pages (or its columns `keep`) with host, path, rule (host and path of the longest fitting rule, or
    null) and verdict (the rule's, or block where the host or a parent domain is listed, else allow)."""
    keep = pages.columns if keep is None else keep
    host, path = host_and_path(F.col(url))
    split = packed(pages, keep, host.alias("host"), path.alias("path"))
    hosts = stored(split.select("host").distinct(), "url-hosts")  # a host with a third of all pages is one row here
    universe = hosts.select(F.explode(host_keys(F.col("host"))).alias("key"))
    n = listed.count()
    shards = max(1, -(-BITS * n // MOST_BITS))
    rule, ruled = fitting_rule(F.col("host"), F.col("path"), rules)
    out = split.withColumns({"rule": rule, "ruled_": ruled, "listed_": F.lit(False)})
    keys = F.transform(host_keys(F.col("host")), lambda k: F.struct(F.xxhash64(k).alias("a"), F.xxhash64(k, F.lit(1)).alias("b"), F.pmod(F.xxhash64(k, F.lit(2)), F.lit(shards)).alias("shard")))
    shard = F.pmod(F.xxhash64("key", F.lit(2)), F.lit(shards))
    for s in range(shards):
        cascade = build(listed.select("key").where(shard == s), universe.where(shard == s))
        sent = pages.sparkSession.sparkContext.broadcast(cascade)
        kind = T.StructType([f for f in out.schema])
        schema = to_arrow_schema(kind)

        def run(batches, sent=sent, s=s, schema=schema):
            for b in batches:
                col = b.column("keys_")
                edge, flat = col.offsets.to_numpy(), col.flatten()
                edge = edge - edge[0]
                hit = sent.value.holds(flat.field("a").to_numpy(), flat.field("b").to_numpy()) & (flat.field("shard").to_numpy() == s)
                some = np.concatenate([[0], np.cumsum(hit)])
                found = (some[edge[1:]] - some[edge[:-1]] > 0) | b.column("listed_").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.bool_()) if f.name == "listed_" else b.column(f.name) for f in schema], schema=schema)

        out = out.withColumn("keys_", keys).mapInArrow(run, kind)
    return out.withColumn("verdict", F.coalesce("ruled_", F.when(F.col("listed_"), "block").otherwise("allow"))).transform(unpacked, keep, "host", "path", "rule", "verdict")


#: The query's rules: verdict, host, path.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
#: Names of unwanted sites; the query lists each host or domain of the corpus that begins with one.
UNWANTED = ("adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def op7_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    keys = pages.select(F.explode(host_keys(host_and_path(F.col("url"))[0])).alias("key")).distinct()
    listed = stored(keys.where(F.substring_index("key", ".", 1).isin(*UNWANTED)), "url-listed")
    return judged(pages, listed, RULES, keep=["page_id"])


OP7_SQL = r"""
WITH part AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
host AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS h FROM part),
split AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM host),
rules(what, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fit AS (SELECT page_id, max_by(h || p, length(h || p)) AS rule, max_by(what, length(h || p)) AS what FROM split JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT page_id, host, path, rule,
       coalesce(what, CASE WHEN list_has_any(string_split(host, '.'), ['adult-x', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm']) THEN 'block' ELSE 'allow' END) AS verdict
FROM split LEFT JOIN fit USING (page_id)
"""
