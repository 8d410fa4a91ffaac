"""Exact cosine top-k by cells: k-means centroids route, the triangle inequality skips.

The archive's unit vectors are dealt to the nearest of some centroids (fitted on a bounded sample; they decide the speed,
never the result). A cell knows its radius, the largest angle between its centroid and its vectors. A query first
searches the cell of its nearest centroid; its k-th best score there is the one to beat. By the triangle
inequality no vector of a cell is nearer to the query than the angle to the centroid less the radius; cells whose
best possible cosine is below that score are skipped, all others are searched.

A cell of more than `block_rows` vectors is split by a hash of the id, so a group of copies of any size is many blocks.
Queries are rows that travel to the blocks they search: no vectors reach the driver but the sample and the
centroids, both bounded. A zero vector has cosine 0 with everything; it has a cell of its own.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlake.operators.blocks import Residents, best, searched
from feedlake.session import written

#: Most cells, and sampled vectors for each of them.
MOST_CELLS, SAMPLE = 1024, 32
ROUNDS = 5
#: Queries that pass one copy of a block; more are dealt over several copies.
LANE = 65_536
#: Queries whose scores a task holds at once.
SLICE = 512
#: Scores are rounded to so many places before they are ranked, so that no two plans order equal ones differently.
PLACES = 12
#: Added to every bound, in radians: what rounding may have taken from an angle.
SLACK = 1e-6


def unit_rows(column) -> np.ndarray:
    """The vectors of a list column as rows of length 1 (a zero vector stays zero)."""
    rows = column.to_pylist()
    m = np.array(rows, dtype=np.float64) if rows else np.zeros((0, 1))
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, n, out=np.zeros_like(m), where=n > 0)


def fit_centroids(sample: np.ndarray, cells: int) -> np.ndarray:
    """Spherical k-means: at most `cells` unit vectors."""
    points = np.unique(sample[np.any(sample != 0, axis=1)], axis=0)
    if len(points) <= 1 or cells <= 1:
        return points[:1]
    centroids = points[np.random.default_rng(7).permutation(len(points))[:cells]]
    for _ in range(ROUNDS):
        own = np.argmax(points @ centroids.T, axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, points)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(length > 0, np.divide(sums, length, out=np.zeros_like(sums), where=length > 0), centroids)
    return centroids


def _assigner(centroids: np.ndarray):
    def run(batches):
        for batch in batches:
            units = unit_rows(batch.column("vec"))
            zero = ~np.any(units != 0, axis=1)
            cos = units @ centroids.T if len(units) and len(centroids) else np.zeros((len(units), 1))
            cell = np.where(zero, len(centroids), np.argmax(cos, axis=1)).astype(np.int64)
            angle = np.arccos(np.clip(np.max(cos, axis=1, initial=-1), -1, 1))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vec"), pa.array(cell), pa.array(angle)], ["id", "vec", "cell", "angle"])

    return run


class Block(Residents):
    def __init__(self, rows: pa.Table, k: int):
        self.k, self.units = k, unit_rows(rows.column("vec"))
        self.batch, self.at, self.scores = None, 0, None

    def search(self, queries, row, least, own):
        if self.batch is not queries or not self.at <= row < self.at + SLICE:
            self.batch, self.at = queries, row // SLICE * SLICE
            self.scores = np.round(unit_rows(queries.column("vec").slice(self.at, SLICE)) @ self.units.T, PLACES)
        s = self.scores[row - self.at]
        places = np.arange(len(s))
        if own >= 0:
            s, places = np.delete(s, own), np.delete(places, own)
        if len(s) > self.k:
            some = s >= np.partition(s, len(s) - self.k)[len(s) - self.k]
            s, places = s[some], places[some]
        return best(s, places, self.k)


@dataclass
class CellIndex:
    """rows: id, vec, cell, group. centroids; per cell its radius, its first group and its number of groups."""

    rows: DataFrame
    centroids: np.ndarray
    radius: dict[int, float]
    first: dict[int, int]
    blocks: dict[int, int]


def build(archive: DataFrame, block_rows: int) -> CellIndex:
    """archive: id, vec (no nulls)."""
    spark, n = archive.sparkSession, archive.count()
    cells = max(1, min(MOST_CELLS, math.ceil(n / block_rows)))
    centroids = np.zeros((0, 1))
    if cells > 1:
        share = min(1.0, SAMPLE * cells / n)
        some = archive.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < math.ceil(share * (1 << 20))).select("vec").toArrow()
        centroids = fit_centroids(unit_rows(some.column("vec")), cells)
    kinds = {f.name: f.dataType.simpleString() for f in archive.schema}
    out = f"id {kinds['id']}, vec {kinds['vec']}, cell long, angle double"
    rows = written(archive.select("id", "vec").mapInArrow(_assigner(centroids), out), "cells")
    sizes = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius")).collect()  # MOST_CELLS + 1 rows at most
    first, blocks, radius, groups = {}, {}, {}, 0
    for r in sorted(sizes, key=lambda r: r["cell"]):
        first[r["cell"]], blocks[r["cell"]], radius[r["cell"]] = groups, math.ceil(r["n"] / block_rows), r["radius"]
        groups += blocks[r["cell"]]
    table = spark.createDataFrame([(c, first[c], blocks[c]) for c in first], "cell long, first long, blocks long")
    dealt = rows.join(F.broadcast(table), "cell").withColumn("group", F.col("first") + F.pmod(F.xxhash64("id"), F.col("blocks")))
    return CellIndex(dealt.select("id", "vec", "cell", "group"), centroids, radius, first, blocks)


def _router(index: CellIndex, home: bool):
    """Adds the groups to visit: those of the nearest centroid's cell, or those of the other cells that may hold a hit."""
    cells = sorted(index.first)
    groups = [list(range(index.first[c], index.first[c] + index.blocks[c])) for c in cells]
    radius = np.array([index.radius[c] for c in cells])
    centroids = index.centroids

    def run(batches):
        for batch in batches:
            units = unit_rows(batch.column("vec"))
            real = [j for j, c in enumerate(cells) if c < len(centroids)]
            bound = np.zeros((len(units), len(cells)))
            bound[:, [j for j in range(len(cells)) if j not in real]] = 0.0 if len(centroids) else 1.0
            if real and len(units):
                angle = np.arccos(np.clip(units @ centroids[[cells[j] for j in real]].T, -1, 1))
                bound[:, real] = np.cos(np.maximum(0.0, angle - radius[real] - SLACK))
                nearest = np.array(real)[np.argmin(angle, axis=1)]
                bound[~np.any(units != 0, axis=1)] = 0.0
            else:
                nearest = np.zeros(len(units), int)
            if home:
                out = [groups[j] for j in nearest]
            else:
                least = np.array(batch.column("least").to_pylist(), dtype=np.float64)
                out = [[g for j in np.flatnonzero(b >= low - SLACK) if j != own for g in groups[j]] for b, low, own in zip(bound, least, nearest)]
            cols = [batch.column(c) for c in batch.schema.names] + [pa.array(out, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, [*batch.schema.names, "groups"])

    return run


def routed(index: CellIndex, asked: DataFrame, home: bool) -> DataFrame:
    """asked (qid, vec, least) with `groups`."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asked.schema)
    return asked.mapInArrow(_router(index, home), f"{schema}, groups array<long>")


def topk(queries: DataFrame, archive: DataFrame, k: int, block_rows: int, exclude_self: bool = False, stats: dict | None = None) -> DataFrame:
    """(qid, rank, id, score). queries: qid, vec; archive: id, vec; no nulls. stats, if given, is filled with the numbers of
    blocks, of queries and of visits to blocks (without skipping: their product)."""
    index = build(archive, block_rows)
    kind = archive.schema["id"].dataType
    if not index.first:
        return queries.select("qid", F.lit(0).alias("rank"), F.lit(None).cast(kind).alias("id"), F.lit(0.0).alias("score")).limit(0)

    def make(rows):
        return Block(rows, k)

    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("id").asc())
    n = queries.count()
    lanes = max(1, math.ceil(n / LANE))
    lane = F.pmod(F.xxhash64("qid"), F.lit(lanes))
    held = index.rows.select("id", "vec", F.explode(F.sequence(F.col("group") * lanes, F.col("group") * lanes + lanes - 1)).alias("group"))
    held = held if lanes > 1 else index.rows.select("id", "vec", "group")
    visits = lambda f: f.select(F.explode(F.transform("groups", lambda g: g * lanes + lane)).alias("group"), "qid", "vec", "least")
    asked = queries.select("qid", "vec", F.lit(-2.0).alias("least"))
    first = routed(index, asked, True)
    hits = searched(held, visits(first), make, exclude_self)
    total = sum(index.blocks.values())
    if stats is not None:
        stats.update(blocks=total, queries=n, visits=first.agg(F.sum(F.size("groups"))).first()[0] or 0)
    if len(index.first) > 1:
        hits = written(hits, "cell-hits")
        reached = hits.withColumn("nth", F.row_number().over(w)).where(F.col("nth") == k).select("qid", F.col("score").alias("low"))
        again = queries.join(reached, "qid", "left").select("qid", "vec", F.coalesce("low", F.lit(-2.0)).alias("least"))
        others = routed(index, again, False)
        if stats is not None:
            others = written(others, "cell-visits")
            stats["visits"] += others.agg(F.sum(F.size("groups"))).first()[0] or 0
        hits = hits.unionByName(searched(held, visits(others), make, exclude_self))
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("qid", F.col("rank").cast("int"), "id", "score")
