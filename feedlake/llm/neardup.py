"""MinHash near-dedup with bottom-k sketches from one hash function.

A document's set holds its distinct shingles of `size` words. Two sets are linked when
100 * |A & B| >= percent * |A | B|. The steps:

1. Sets are hashed with one 64-bit function. Documents of one set (found by a 128-bit fingerprint)
   are a class; the class's smallest doc_id stands for it.
2. All shingles of all documents are counted. Those in more than LONG documents are "common" and
   are ordered after all others; inside each half the hash gives the order.
3. The sketch of a set of n shingles is its first k = n - ceil(percent * n / 100) + 1 in that order.
   Linked sets share a value of their sketches, whatever the order (the prefix-filter theorem), so
   the inverted lists of retained values miss no link. Frequent passages land in sketches only of
   sets that consist of them, so other lists are short.
4. Lists of at most LONG classes give pairs. How many retained values a pair shares, and what the
   union of both sketches leaves open, bounds its overlap from above; pairs below the threshold go.
5. Longer lists hold large groups of near copies. Each is first compared with one pivot, the member
   with the fewest uncommon shingles; what the pivot joins needs no other pair inside the list. The
   rest goes on in PIVOTS rounds, and then every pair of different components that is left, behind
   an exact bound from 512-bit parities of the sets.
6. Every pair that is left is verified on the full sets, and links give components by large-star and
   small-star rounds. Pairs inside a component that is known already are not verified again.

Defined cases: a text of fewer words than `size` has one shingle, the whole sequence; no words, or a
null text, gives the empty set, linked with nothing; repeated rows, and rows of one doc_id, are one
document, joined with what any of its texts is linked with; a null doc_id gets the component of its
copies, if any; extra columns pass through `deduplicated`,
whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from feedlake.llm.common import LOWER, kept, packed, small_batches, stored, table, texts, unpacked
from feedlake.llm.components import components

#: Longest list of retained values whose pairs are all looked at, and the count from which a shingle is common.
LONG = 40
#: Most common shingles that are broadcast (8 bytes each), the most frequent first; any choice gives the same links.
MOST_COMMON = 3_000_000
PIVOTS = 3
#: Shingles counted together in a task, and words whose hashes a worker remembers.
CHUNK = 1_500_000
MEMO = 200_000
#: Bits of a packed size that hold the number of common values.
HOT_BITS = 24
#: Most doc_ids that are broadcast to pick the texts to verify; more are joined by a shuffle.
MOST_IDS = 4_000_000
M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xBF58476D1CE4E5B9)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: bytes, size: int = 3) -> np.ndarray:
    """The set as sorted, distinct 63-bit hashes."""
    words = text.translate(LOWER).split()
    if not words:
        return np.zeros(0, np.int64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words)) >> 1], np.int64)
    own = kept("shingles", _Hashes)
    h = np.array([own[w] for w in words], np.uint64)
    n = len(h) - size + 1
    z = np.zeros(n, np.uint64)
    for k in range(size):
        z = (z ^ h[k : k + n]) * M1
        z ^= z >> np.uint64(32)
    z = (z ^ (z >> np.uint64(29))) * M3
    z ^= z >> np.uint64(32)
    return np.unique((z >> np.uint64(1)).view(np.int64))


def sketch_size(n: int, percent: int) -> int:
    return n + percent * -n // 100 + 1 if n else 0


def least_overlap(a, b, percent: int):
    """Smallest |A & B| of linked sets of a and b shingles."""
    return F.ceil(percent * (a + b) / F.lit(100.0 + percent) - 1e-9)


# -- 1 and 2: sets, classes, counts ------------------------------------------------------------------------


def _counted(size: int, ranges: int):
    """The task's shingle counts, packed by hash range: the 32 bits below the range's, and where a
    count is not 1, its place and the count."""
    shift = np.int64(63 - (ranges.bit_length() - 1))

    def packed(parts: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(parts), return_counts=True)
        edge = np.searchsorted(values >> shift, np.arange(ranges + 1))
        low = ((values >> (shift - np.int64(32))) & np.int64(0xFFFFFFFF)).astype(np.uint32)
        out = []
        for r in np.flatnonzero(np.diff(edge)).tolist():
            own = slice(int(edge[r]), int(edge[r + 1]))
            more = np.flatnonzero(counts[own] > 1).astype(np.uint32)
            out.append((r, low[own].tobytes(), more.tobytes(), counts[own][more].astype(np.uint32).tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int32(), pa.binary(), pa.binary(), pa.binary()))], names=["range", "low", "more", "counts"])

    def run(batches):
        parts, held = [], 0
        for batch in batches:
            for t in texts(batch.column(0)):
                s = shingles(t, size)
                if len(s):
                    parts.append(s)
                    held += len(s)
                if held >= CHUNK:
                    yield packed(parts)
                    parts, held = [], 0
        if parts:
            yield packed(parts)

    return run


def _common(long: int):
    """Of one hash range: the values in more than `long` documents."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        low, add = [], []
        for a, m, c in zip(rows.column("low").to_pylist(), rows.column("more").to_pylist(), rows.column("counts").to_pylist()):
            v = np.frombuffer(a, np.uint32)
            n = np.ones(len(v), np.int64)
            n[np.frombuffer(m, np.uint32)] = np.frombuffer(c, np.uint32)
            low.append(v)
            add.append(n)
        low, add = np.concatenate(low), np.concatenate(add)
        order = np.argsort(low, kind="stable")
        low, add = low[order], add[order]
        first = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        total = np.add.reduceat(add, first)
        hot = total > long
        value = (np.int64(key[0].as_py()) << np.int64(32)) | low[first][hot].astype(np.int64)
        return pa.table({"value": pa.array(value, pa.int64()), "count": pa.array(total[hot], pa.int64())})

    return run


# -- 3: sketches -------------------------------------------------------------------------------------------


def _sketches(common, size: int, percent: int, ranges: int):
    """(doc, print, n, cold, hot, sketch, parity): the class's fingerprint, the set's size, its uncommon
    shingles, the common ones in its sketch, the sketch, and for sketches with common ones the parities."""
    shift = np.int64(63 - (ranges.bit_length() - 1) - 32)

    def run(batches):
        hot = common.value
        for batch in batches:
            out = {"print": [], "n": [], "cold": [], "hot": [], "sketch": [], "parity": []}
            for t in texts(batch.column(1)):
                s = shingles(t, size)
                cold, k = len(s), sketch_size(len(s), percent)
                out["print"].append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                parity = None
                if len(hot) and len(s):
                    top = s >> shift
                    is_hot = hot[np.minimum(np.searchsorted(hot, top), len(hot) - 1)] == top
                    cold = int((~is_hot).sum())
                    if k > cold:
                        bits = np.bincount((s.view(np.uint64) * M2 >> np.uint64(55)).astype(np.int64), minlength=512) & 1
                        parity = np.packbits(bits.astype(np.uint8)).view(np.int64)
                    s = np.concatenate([s[~is_hot], s[is_hot]])
                for c, x in (("n", len(s)), ("cold", cold), ("hot", max(0, k - cold)), ("sketch", s[:k]), ("parity", parity)):
                    out[c].append(x)
            kinds = {"print": pa.binary(), "sketch": pa.list_(pa.int64()), "parity": pa.list_(pa.int64())}
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, kinds.get(c, pa.int64())) for c, x in out.items())], names=["doc", *out])

    return run


# -- 4: lists ----------------------------------------------------------------------------------------------


def gathered(batches, rows: int):
    """The same rows as tables of about `rows` rows."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _lists(long: int, percent: int):
    """Rows (v, doc, n) sorted by v, n being the size and the common values of the sketch in one number ->
    for lists of 2 to `long` rows the pairs that sizes allow, for longer ones their rows again (b null)."""
    names = ["a", "b", "na", "nb", "v"]

    def pairs(v, doc, n):
        """Complete lists only."""
        first = np.concatenate([[True], v[1:] != v[:-1]])
        start = np.flatnonzero(first)
        length = np.diff(np.concatenate([start, [len(v)]]))
        mine = np.repeat(length, length)
        big = mine > long
        if big.any():
            k = int(big.sum())
            yield pa.RecordBatch.from_arrays([pa.array(doc[big]), pa.nulls(k, pa.int64()), pa.array(n[big]), pa.nulls(k, pa.int64()), pa.array(v[big])], names=names)
        some = (mine > 1) & ~big
        v, doc, n = v[some], doc[some], n[some]
        for d in range(1, int(min(long, length.max()))):
            if len(v) <= d:
                break
            ok = np.flatnonzero((v[d:] == v[:-d]) & (100 * np.minimum(n[d:] >> HOT_BITS, n[:-d] >> HOT_BITS) >= percent * np.maximum(n[d:] >> HOT_BITS, n[:-d] >> HOT_BITS)) & (doc[d:] != doc[:-d]))
            if len(ok):
                x, y, nx, ny = doc[ok], doc[ok + d], n[ok], n[ok + d]
                swap = x > y
                yield pa.RecordBatch.from_arrays([pa.array(np.where(swap, y, x)), pa.array(np.where(swap, x, y)), pa.array(np.where(swap, ny, nx)), pa.array(np.where(swap, nx, ny)), pa.nulls(len(ok), pa.int64())], names=names)

    def run(batches):
        rest, open_big = None, None  # open_big: a value whose first rows went out as a long list already
        for batch in gathered(batches, 20_000):
            own = [batch.column(c).to_numpy() for c in ("v", "doc", "n")]
            own = own if rest is None else [np.concatenate(x) for x in zip(rest, own)]
            if not len(own[0]):
                continue
            if open_big is not None:
                more = int(np.searchsorted(own[0], open_big, side="right"))
                if more:
                    yield pa.RecordBatch.from_arrays([pa.array(own[1][:more]), pa.nulls(more, pa.int64()), pa.array(own[2][:more]), pa.nulls(more, pa.int64()), pa.array(own[0][:more])], names=names)
                    own = [x[more:] for x in own]
                if not len(own[0]):
                    rest = None
                    continue
            open_big = None
            cut = int(np.searchsorted(own[0], own[0][-1], side="left"))
            if cut:
                yield from pairs(*(x[:cut] for x in own))
            rest = [x[cut:] for x in own]
            if len(rest[0]) > long:
                open_big = rest[0][-1]
                yield from pairs(*rest)
                rest = None
        if rest is not None and len(rest[0]):
            yield from pairs(*rest)

    return run


# -- 6: verification ---------------------------------------------------------------------------------------


def _sets(size: int):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingles(t, size).tobytes() for t in texts(b.column(1))], pa.binary())], names=["doc", "shingles"])

    return run


def _linked(percent: int):
    def run(batches):
        for b in (whole.slice(at, 200) for whole in batches for at in range(0, whole.num_rows, 200)):
            ok = []
            for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                ok.append(100 * common >= percent * (len(x) + len(y) - common))
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def verified(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Of pairs(a, b), those linked on their full sets. docs(doc, text)."""
    pairs = stored(pairs, "neardup-pairs")
    need = stored(pairs.select(F.col("a").alias("doc")).union(pairs.select(F.col("b").alias("doc"))).distinct(), "neardup-need")
    need = F.broadcast(need) if need.count() <= MOST_IDS else need
    sets = stored(docs.join(need, "doc", "left_semi").mapInArrow(_sets(size), "doc long, shingles binary"), "neardup-sets")
    left = pairs.join(sets.select(F.col("doc").alias("a"), F.col("shingles").alias("x")), "a")
    both = left.join(sets.select(F.col("doc").alias("b"), F.col("shingles").alias("y")), "b")
    return stored(both.select("a", "b", "x", "y").mapInArrow(_linked(percent), "a long, b long"), "neardup-links")


# -- 5: long lists -----------------------------------------------------------------------------------------


def _possible(percent: int):
    """Of rows with n, parity and pn, pparity: what sizes and parities leave possible."""
    differ = F.aggregate(F.zip_with("parity", "pparity", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    need = least_overlap(F.col("n"), F.col("pn"), percent)
    return (need <= F.least("n", "pn")) & (F.coalesce(differ, F.lit(0)) <= F.col("n") + F.col("pn") - 2 * need)


def _pairs(x: DataFrame) -> DataFrame:
    return x.select(F.least("doc", "pdoc").alias("a"), F.greatest("doc", "pdoc").alias("b")).distinct()


def _placed(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """rows with `place`, the component of doc."""
    return rows.join(nodes.select(F.col("node").alias("doc"), "component"), "doc", "left").withColumn("place", F.coalesce("component", "doc")).drop("component")


def long_lists(rows: DataFrame, links: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """rows(v, doc, n, cold, parity) of the long lists, and the links so far -> all links that matter for
    the components."""
    nodes, used, first = components(links), None, None
    for _ in range(PIVOTS):
        here = stored(_placed(rows, nodes), "neardup-placed")
        free = here
        if used is not None:
            taken = _placed(used.withColumnRenamed("pdoc", "doc"), nodes).select("v", "place").distinct()
            free = here.join(taken, ["v", "place"], "left_anti")
        one = F.min(F.struct("cold", "doc", "n", "parity", "place")).alias("p")
        pivots = stored(free.groupBy("v").agg(one).select("v", F.col("p.doc").alias("pdoc"), F.col("p.n").alias("pn"), F.col("p.parity").alias("pparity"), F.col("p.place").alias("pplace")), "neardup-pivots")
        if pivots.isEmpty():
            break
        found = verified(_pairs(here.join(pivots, "v").where((F.col("place") != F.col("pplace")) & _possible(percent))), docs, size, percent)
        links = stored(links.unionByName(found), "neardup-links")
        nodes = components(links)
        chosen = pivots.select("v", "pdoc")
        first, used = (chosen, chosen) if first is None else (first, stored(used.unionByName(chosen), "neardup-used"))
    here = stored(_placed(rows, nodes), "neardup-placed")
    main = _placed(first.withColumnRenamed("pdoc", "doc"), nodes).select("v", "place")
    rest = here.join(main, ["v", "place"], "left_anti").select("v", *(F.col(c).alias(f"p{c}") for c in ("doc", "n", "parity", "place")))
    found = verified(_pairs(here.join(rest, "v").where((F.col("place") != F.col("pplace")) & _possible(percent))), docs, size, percent)
    return stored(links.unionByName(found), "neardup-links")


# -- the whole ---------------------------------------------------------------------------------------------


def clusters(docs: DataFrame, size: int = 5, percent: int = 80, text: str = "text") -> DataFrame:
    """A row for each row of docs: doc_id, n_shingles, component_id (the smallest doc_id reachable over links)."""
    spark = small_batches(docs.sparkSession)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = 1 << max(5, (4 * parts - 1).bit_length())
    packed = docs.select(text).mapInArrow(_counted(size, ranges), "range int, low binary, more binary, counts binary")
    common = stored(packed.groupBy("range").applyInArrow(_common(LONG), "value long, count long"), "neardup-common")
    capped = common.count() > MOST_COMMON
    hot = (common.orderBy(F.desc("count"), "value").limit(MOST_COMMON) if capped else common).select("value").toArrow().column(0).to_numpy()
    sent = spark.sparkContext.broadcast(np.sort(hot))
    own = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col(text).alias("text"))
    sketches = stored(own.mapInArrow(_sketches(sent, size, percent, ranges), "doc long, print binary, n long, cold long, hot long, sketch array<long>, parity array<long>"), "neardup-sketches")
    classes = stored(sketches.where("n > 0").groupBy("print").agg(F.min("doc").alias("rep"), F.count("*").alias("copies")), "neardup-classes")
    reps = sketches.join(classes.select(F.col("print"), F.col("rep").alias("doc")), ["print", "doc"])
    retained = F.col("hot") if not capped else F.size("sketch").cast("long")
    postings = reps.select(F.explode("sketch").alias("v"), "doc", (F.shiftleft("n", HOT_BITS) + F.least(retained, F.lit((1 << HOT_BITS) - 1))).alias("n"))
    lists = stored(postings.repartition(parts, "v").sortWithinPartitions("v").mapInArrow(_lists(LONG, percent), "a long, b long, na long, nb long, v long"), "neardup-lists")

    na, nb = F.shiftright("na", HOT_BITS), F.shiftright("nb", HOT_BITS)
    open_ = F.greatest(*(F.ceil(percent * n / F.lit(100.0)) - 1 for n in (na, nb)))  # n - sketch_size(n): shared values that lie beyond one sketch at most
    most = F.col("shared") + F.least(F.col("na").bitwiseAND((1 << HOT_BITS) - 1), F.col("nb").bitwiseAND((1 << HOT_BITS) - 1)) + open_
    pairs = lists.where("b is not null").groupBy("a", "b", "na", "nb").agg(F.count("*").alias("shared")).where(most >= least_overlap(na, nb, percent)).select("a", "b").distinct()
    links = verified(pairs, own, size, percent)
    long_rows = lists.where("b is null").select("v", F.col("a").alias("doc"))
    if not long_rows.isEmpty():
        about = sketches.where("n > 0").select("doc", "n", "cold", "parity").dropDuplicates(["doc"])
        links = long_lists(stored(long_rows.distinct().join(about, "doc"), "neardup-long"), links, own, size, percent)
    nodes = components(links)

    placed = classes.join(nodes, F.col("rep") == F.col("node"), "left").where("copies > 1 or component is not null")
    placed = stored(placed.select("print", F.coalesce("component", "rep").alias("component")), "neardup-components")
    return sketches.select(F.col("doc").alias("doc_id"), "print", F.col("n").alias("n_shingles")).join(placed, "print", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def deduplicated(docs: DataFrame, size: int = 5, percent: int = 80, text: str = "text") -> DataFrame:
    """One row of each component: that of the smallest doc_id, null last; the columns of docs.

    Decided row by row: where a doc_id is null or repeated, a row goes by the hash of its doc_id and text, so rows of one
    doc_id with different texts are documents of their own. Of rows with equal doc_id and text one stays, whatever
    their other columns hold."""
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.count_if(F.col("doc_id").isNull())).first()
    unique = (ids[0] or 1) == 1 and not ids[1]
    node = F.col("doc_id").cast("long") if unique else F.xxhash64("doc_id", text)
    whole = packed(docs, docs.columns, node.alias("doc_id"), F.col(text).alias("text_"))
    seen = clusters(whole, size, percent, "text_").select("doc_id", "component_id")
    if unique:
        gone = seen.where("doc_id <> component_id").select("doc_id")
        return unpacked(whole.join(gone, "doc_id", "left_anti"), docs.columns)
    names = docs.select(node.alias("doc_id"), F.col("doc_id").alias("name")).distinct()
    first = F.min_by("doc_id", F.struct(F.col("name").isNull().alias("last"), "name", "doc_id"))
    stay = stored(seen.distinct().join(names, "doc_id").groupBy("component_id").agg(first.alias("doc_id")).select("doc_id"), "neardup-stay")
    rows = whole.join(stay, "doc_id", "left_semi")
    return unpacked(rows.groupBy("doc_id").agg(F.min_by("row__", F.xxhash64("row__")).alias("row__")), docs.columns)


def op10_near_duplicates(spark, sf_dir: str) -> DataFrame:
    found = clusters(table(spark, sf_dir, "documents"), size=3, percent=85)
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


OP10_SQL = r"""
WITH RECURSIVE
doc AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(len(w), 3) - 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM doc WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS (SELECT a, b FROM shared JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id, doc_id AS root FROM size UNION SELECT b, root FROM reach JOIN edge ON a = reach.doc_id),
component AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(component_id, doc_id) = doc_id AS kept
FROM documents LEFT JOIN size USING (doc_id) LEFT JOIN component USING (doc_id)
"""
