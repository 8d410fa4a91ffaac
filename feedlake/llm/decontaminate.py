"""Benchmark decontamination: a broadcast hash set of the benchmark's word windows, one scan of the
training texts, and an exact check of every hash hit.

Words are maximal runs of digits, letters a-z (A-Z lowered) and non-ASCII characters. A benchmark
item's windows are its runs of `window` consecutive words; an item of fewer words is one window.

Defined cases: null or empty text has no words and is clean; an item without words has no window;
repeated rows are judged alike, each on its own; items that share a window are all reported; null
item ids are left out of item_ids but their windows still hit; extra columns pass through,
whatever their names (`contamination` adds its own columns last, in place of input columns of their names).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from feedlake.llm.common import packed, small_batches, table, texts, unpacked

#: A byte's word form: a-z, 0-9 and bytes from 0x80 stay, A-Z lowered, all else a space.
FORM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
WORD_BYTES = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
ADDED = ("n_words", "n_hit", "item_ids", "hit_spans")
#: Documents scanned together.
SLICE = 2000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FORM).split()


def windows_of(words: list[bytes], window: int) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    return [tuple(words[i : i + window]) for i in range(max(1, len(words) - window + 1))]


def rolled(ids: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of each run of `length` ids (wrapping arithmetic), by start."""
    out = np.zeros(len(ids) - length + 1, np.uint64)
    for k in range(length):
        out = (out + ids[k : k + len(out)] + np.uint64(1)) * MULTIPLIER
        out ^= out >> np.uint64(29)
    return out


class Index:
    """The windows of one bounded block of the benchmark: a vocabulary, per window length the sorted
    hashes for the scan, and the windows themselves for the check."""

    def __init__(self, items: list[tuple[object, bytes]], window: int):
        self.items: dict[tuple[bytes, ...], set] = {}
        for item_id, text in items:
            for w in windows_of(words_of(text), window):
                self.items.setdefault(w, set()).add(item_id)
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for t in self.items for w in t}))}
        self.hashes = {}
        for length in sorted({len(t) for t in self.items}):
            ids = np.array([[self.vocabulary[w] for w in t] for t in self.items if len(t) == length], np.uint64)
            self.hashes[length] = np.unique(np.concatenate([rolled(row, length) for row in ids]))

    def scan(self, docs: list[list[bytes]]) -> dict[int, tuple[np.ndarray, set]]:
        """Of the documents with hits: the marked words, and the items found."""
        starts = np.cumsum([0] + [len(d) + 1 for d in docs])
        ids = np.full(int(starts[-1]), -1, np.int64)
        get = self.vocabulary.get
        for d, at in zip(docs, starts):
            if d:
                ids[at : at + len(d)] = [get(w, -1) for w in d]
        known = np.flatnonzero(ids >= 0)
        out: dict[int, tuple[np.ndarray, set]] = {}
        if not len(known):
            return out
        unknown = np.concatenate([[0], np.cumsum(ids < 0)])
        for length, hashes in self.hashes.items():
            first = known[known + length <= len(ids)]
            first = first[unknown[first + length] == unknown[first]]  # runs of known words within a document
            if not len(first):
                continue
            h = np.zeros(len(first), np.uint64)
            for k in range(length):
                h = (h + ids[first + k].astype(np.uint64) + np.uint64(1)) * MULTIPLIER
                h ^= h >> np.uint64(29)
            for at in first[np.isin(h, hashes)].tolist():
                doc = int(np.searchsorted(starts, at, side="right")) - 1
                i = at - int(starts[doc])
                found = self.items.get(tuple(docs[doc][i : i + length]))
                if found is None:  # a hash hit that is no window
                    continue
                mark, seen = out.setdefault(doc, (np.zeros(len(docs[doc]), bool), set()))
                mark[i : i + length] = True
                seen |= found
        return out


def _runs(mark: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mark.astype(np.int8), [0]])))
    return [{"first": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])]


def _scanner(index, schema: pa.Schema, text: str):
    """Arrow batches in, the kept columns and the verdicts out. Verdicts of an earlier block of the
    benchmark, where the batch has them, are joined with this block's."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for whole in batches:
            for batch in (whole.slice(at, SLICE) for at in range(0, whole.num_rows, SLICE)):
                docs = [words_of(t) for t in texts(batch.column(text))]
                found = own.scan(docs)
                ids, spans, n_hit = [[] for _ in docs], [[] for _ in docs], [0] * len(docs)
                earlier = {c: batch.column(c).to_pylist() for c in ADDED if c in batch.schema.names}
                for k in range(len(docs)) if earlier else found:
                    mark, seen = found.get(k, (np.zeros(len(docs[k]), bool), set()))
                    for s in earlier["hit_spans"][k] if earlier else ():
                        mark[s["first"] : s["end"]] = True
                    ids[k] = sorted({str(x) for x in seen if x is not None} | set(earlier["item_ids"][k] if earlier else ()))
                    spans[k], n_hit[k] = _runs(mark), int(mark.sum())
                new = {"n_words": [len(d) for d in docs], "n_hit": n_hit, "item_ids": ids, "hit_spans": spans}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(new[f.name], f.type) if f.name in new else batch.column(f.name) for f in schema], schema=schema)

    return run


def benchmark_blocks(benchmark: DataFrame, most_chars: int) -> list[list]:
    """The items in blocks of about `most_chars` characters, each small enough to broadcast."""
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-total // most_chars))
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        yield [(r[0], r[1].encode()) for r in rows]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text",
                  keep: list[str] | None = None, most_chars: int = 16_000_000) -> DataFrame:
    """docs (or the columns `keep` of it) with n_words, n_hit (words inside any benchmark window),
    item_ids (the items found, as sorted strings) and hit_spans (runs of hit words, by word index).

    One scan, no shuffle. Of the benchmark, at most about `most_chars` characters are broadcast at
    once; a larger one goes through the same scan in several chained passes.
    """
    spark = small_batches(docs.sparkSession)
    keep = docs.columns if keep is None else keep
    need = packed(docs, keep, F.col(text).alias("text__"))
    added = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("item_ids", T.ArrayType(T.StringType())),
             T.StructField("hit_spans", T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())])))]
    blocks = [spark.sparkContext.broadcast(Index(b, window)) for b in benchmark_blocks(benchmark, most_chars)]
    for index in blocks:
        out = T.StructType([*(f for f in need.schema if f.name not in ADDED), *added])
        need = need.mapInArrow(_scanner(index, to_arrow_schema(out), "text__"), out)
    return unpacked(need, keep, *ADDED)


def without_spans(text: bytes, spans: list) -> str:
    """The text less its hit words and what stands between them inside a run."""
    words = [m.span() for m in WORD_BYTES.finditer(text)]
    out, at = [], 0
    for s in spans:
        out.append(text[at : words[s["first"]][0]])
        at = words[s["end"] - 1][1]
    return b"".join([*out, text[at:]]).decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text", mode: str = "document") -> DataFrame:
    """docs without contaminated documents (mode "document"), or with the hit runs cut out of their
    texts (mode "span"; all documents stay). The columns are those of docs."""
    whole = packed(docs, docs.columns, F.col(text).alias("text_"))
    seen = contamination(whole, benchmark, window, "text_")
    if mode == "document":
        return unpacked(seen.where("n_hit = 0"), docs.columns)
    if mode != "span":
        raise ValueError(f"mode is document or span, not {mode}")
    out = T.StructType([*whole.schema])
    schema = to_arrow_schema(out)

    def cut(batches):
        for b in batches:
            old = b.column("text_")
            new = [None if null else without_spans(t, s) for t, null, s in zip(texts(old), old.is_null().to_pylist(), b.column("hit_spans").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(new, f.type) if f.name == "text_" else b.column(f.name) for f in schema], schema=schema)

    done = seen.mapInArrow(cut, out)
    return done.select(*(F.col("text_").alias(text) if c == text else F.col(f"row__.`{c}`") for c in docs.columns))


def op6_decontaminate(spark, sf_dir: str) -> DataFrame:
    seen = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return seen.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                       F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP6_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_window AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM item_window),
doc_window AS (
  SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, sizes WHERE len(w) >= n)),
hit AS (SELECT r, i, d.n, item_id FROM doc_window d JOIN item_window USING (n, s)),
marked AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS k FROM hit) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN marked USING (r) LEFT JOIN found USING (r)
"""
