"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source with target / source_size = c copies expects c copies. floor(c) are sure; the
fraction is rounded: two documents with fractional probabilities exchange words (one's gain in
expected words is the other's loss) until one of them is taken or left for certain, the direction
drawn so that both keep their expectations. The words that a pair takes together stay as they are,
so a source misses its target by at most one document: the one left fractional at the end, which is
drawn alone.

The pairing runs over a reduction tree. Leaves hold about `leaf` documents of one source, dealt by a
hash of doc_id, so a hot source has many leaves. Every leaf ends with one fractional document at
most; these go up, `fanout` leaves to a node, until each source has one. Within a node, documents
meet in order of falling size, so that the one left is a small one; nothing else is chosen by its
outcome, so every document is taken with its own probability. The draws are hashes of the document
ids: a rerun takes the same.

Defined cases: null source is a source of its own, last in order; a source without words, or a
document without words (null, empty), has nothing to take: target 0 or size 0, taken 0; repeated
rows are documents of their own; a table without rows gives none; extra columns pass through
(`mix` puts its own in place of input columns of their names).
"""

from __future__ import annotations

from functools import reduce
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feedlake.llm.common import WORD, packed, small_batches, stored, table, unpacked

LEAF = 256
FANOUT = 256
#: Most rows that are paired together.
MOST_ROWS = 4096
#: Most sources whose table is broadcast; beyond, the join shuffles.
MOST_SOURCES = 50_000


def n_words(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_ranks(sources: DataFrame) -> DataFrame:
    """sources (one row each) with `rank`, from 0, by code point, null last. The sources are sorted
    over partitions; only a row count for each partition goes to the driver."""
    at = F.monotonically_increasing_id()
    ordered = stored(sources.orderBy(F.col("source").asc_nulls_last()).withColumn("at_", at), "mix-sources")
    part, within = F.shiftright("at_", 33), F.col("at_").bitwiseAND((1 << 33) - 1)
    counts = {r[0]: r[1] for r in ordered.groupBy(part.alias("p")).count().collect()}
    before, total = [], 0
    for p in sorted(counts):
        before += [F.lit(p).cast("long"), F.lit(total).cast("long")]
        total += counts[p]
    offset = F.create_map(*before)[part.cast("long")] if before else F.lit(0).cast("long")
    return ordered.withColumn("rank", offset + within).drop("at_")


def source_targets(docs: DataFrame, weights: tuple, share: float, most_copies: float) -> DataFrame:
    """source, n_docs, source_size, target: `share` of all sizes dealt by weight, at most
    `most_copies` times a source's size, the excess dealt again by weight until none is above."""
    sources = source_ranks(docs.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size")))
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = sources.withColumn("weight", weight).withColumn("most", most_copies * F.col("source_size"))
    sources = stored(sources, "mix-ranked")
    full = F.lit(False)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    while True:  # each round closes a source at least, or ends
        r = sources.agg(F.sum(F.when(full, F.col("most"))).alias("gone"), F.sum(F.when(~full, F.col("weight"))).alias("weight"),
                        F.sum(full.cast("int")).alias("n")).first()
        level = (share * total - (r["gone"] or 0.0)) / r["weight"] if r["weight"] else 0.0
        now = F.col("most") <= level * F.col("weight")
        if (sources.agg(F.sum(now.cast("int"))).first()[0] or 0) <= (r["n"] or 0):
            break
        full = now
    return sources.select("source", "n_docs", "source_size", F.when(full, F.col("most")).otherwise(level * F.col("weight")).alias("target"))


def _mixed(*keys: int) -> float:
    """A number in [0, 1) from whole numbers, the same in every run."""
    h = 0x9E3779B97F4A7C15
    for k in keys:
        h = ((h ^ (k & (1 << 64) - 1)) * 0xBF58476D1CE4E5B9) & (1 << 64) - 1
        h ^= h >> 31
        h = (h * 0x94D049BB133111EB) & (1 << 64) - 1
        h ^= h >> 29
    return (h >> 11) / (1 << 53)


def exchange(p: float, v: int, q: float, w: int, u: float) -> tuple[float, float]:
    """New probabilities of two documents of v and w words: p*v + q*w stays, one becomes 0 or 1, and
    both keep their expectations over u, uniform in [0, 1)."""
    up, down = min((1 - p) * v, q * w), min(p * v, (1 - q) * w)
    if u * (up + down) < down:
        return (1.0, q - (1 - p) * v / w) if (1 - p) * v <= q * w else (p + q * w / v, 0.0)
    return (0.0, q + p * v / w) if p * v <= (1 - q) * w else (p - (1 - q) * w / v, 1.0)


def paired(p: list[float], size: list[int], key: list[int], seed: int) -> list[float]:
    """One node's probabilities after its pairings, in the given order: all but one are 0 or 1."""
    out = [float(_mixed(seed, k) < x) if not w and 0 < x < 1 else x for x, w, k in zip(p, size, key)]
    at = [i for i, x in enumerate(out) if 0 < x < 1]
    i = at[0] if at else 0
    for j in at[1:]:
        if not 0 < out[i] < 1:
            i = j
            continue
        a, b = exchange(out[i], size[i], out[j], size[j], _mixed(seed, key[i], key[j]))
        out[i], out[j] = (0.0 if x < 1e-12 else 1.0 if x > 1 - 1e-12 else x for x in (a, b))
        i = i if 0 < out[i] < 1 else j
    return out


def _nodes(seed: int):
    """Rows sorted by node and falling size, with each node's p paired. A node is read whole, up to
    MOST_ROWS rows; a larger one (many rows of one doc_id) goes in runs, each handing on its open row."""

    def closed(rows: pa.Table) -> pa.Table:
        rank, node = (rows.column(c).to_numpy() for c in ("rank", "node"))
        edge = [0, *(np.flatnonzero((rank[1:] != rank[:-1]) | (node[1:] != node[:-1])) + 1).tolist(), len(rank)]
        p, size, key = (rows.column(c).to_pylist() for c in ("p", "size", "key"))
        out = [x for a, b in zip(edge, edge[1:]) for x in paired(p[a:b], size[a:b], key[a:b], seed)]
        at = rows.schema.get_field_index("p")
        return rows.set_column(at, rows.schema.field(at), pa.array(out, pa.float64()))

    def run(batches):
        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            rank, node = (rows.column(c).to_numpy() for c in ("rank", "node"))
            last = np.flatnonzero((rank != rank[-1]) | (node != node[-1])) if len(rank) else np.zeros(0, int)
            cut = int(last[-1]) + 1 if len(last) else 0
            yield from closed(rows.slice(0, cut)).to_batches() if cut else ()
            rest = rows.slice(cut)
            if rest.num_rows > MOST_ROWS:
                rest = closed(rest)
                p = rest.column("p").to_numpy()
                yield from rest.filter(pa.array((p == 0) | (p == 1))).to_batches()
                rest = rest.filter(pa.array((p > 0) & (p < 1)))
        if rest is not None and rest.num_rows:
            yield from closed(rest).to_batches()

    return run


def rounded(docs: DataFrame, most_docs: int, seed: int = 7, leaf: int = LEAF, fanout: int = FANOUT) -> DataFrame:
    """docs(rank, n_docs, key, size, p, ...) with every p 0 or 1. most_docs: of the largest source."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("n_docs") / leaf))
    level, most = docs.withColumn("node", F.pmod(F.xxhash64("key", F.lit(seed)), blocks)), -(-most_docs // leaf)
    fractional = (F.col("p") > 0) & (F.col("p") < 1)
    done, k = [], 0
    while True:
        by = level.repartition(parts, "rank", "node").sortWithinPartitions("rank", "node", F.desc("size"), "key")
        after = stored(by.mapInArrow(_nodes(seed + k), level.schema), f"mix-level{k}")
        if most <= 1:  # one document a source may be open: drawn alone
            draw = F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
            done.append(after.withColumn("p", F.when(fractional, (draw < F.col("p")).cast("double")).otherwise(F.col("p"))))
            return reduce(DataFrame.unionByName, done).drop("node")
        done.append(after.where(~fractional))
        level = after.where(fractional).withColumn("node", F.floor(F.col("node") / fanout))
        most, k = -(-most // fanout), k + 1


def mix(docs: DataFrame, weights: tuple = (5, 2, 1), share: float = 1.5, most_copies: float = 2.0, seed: int = 7,
        text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs (or its columns `keep`) with size, source_size, target (the source's words in the mix) and
    copies, each document's whole number of copies."""
    small_batches(docs.sparkSession)
    keep = docs.columns if keep is None else keep
    sized = packed(docs, keep, "doc_id", "source", n_words(F.col(text)).alias("size"))
    if text not in keep:
        sized = stored(sized, "mix-sizes")
    targets = stored(source_targets(sized, weights, share, most_copies), "mix-targets")
    n, most_docs = targets.agg(F.count("*"), F.max("n_docs")).first()
    ranked = targets.withColumnRenamed("source", "source_").withColumn("rank", F.xxhash64("source_"))
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sure = F.floor(expected + 1e-9)
    rows = (sized.join(F.broadcast(ranked) if n <= MOST_SOURCES else ranked, F.col("source").eqNullSafe(F.col("source_"))).drop("source_")
            .withColumn("key", F.xxhash64("doc_id")).withColumn("p", F.greatest(F.lit(0.0), expected - sure)).withColumn("sure", sure))
    out = rounded(rows, most_docs or 0, seed)
    return out.withColumn("copies", (F.col("sure") + F.col("p")).cast("long")).transform(unpacked, keep, "size", "source_size", "target", "copies")


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: each document as often as it has copies; the columns of docs."""
    whole = packed(docs, docs.columns, "doc_id", "source", "text")
    taken = mix(whole, keep=["row__", "text"], **how).where("copies > 0")
    return unpacked(taken.withColumn("copy_", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))), docs.columns)


def op2_mix(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs, keep=["doc_id"]).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
