"""Target-distribution importance resampling: documents drawn so that their word features follow a target's.

Features are all runs of one to `longest` words (as in decontaminate: a-z with A-Z lowered, digits, non-ASCII
characters), hashed into buckets by crc32. A bucket's gain is the logarithm of its share in the target over its
share in the corpus, both smoothed by one; a document's weight is the floored mean of its features' gains, and
its score the weight plus a Gumbel number from a hash of its doc_id: the highest scores are a draw without
replacement in proportion to exp(weight / 1000).

Plan: one scan counts the corpus's features (each task adds its counts to one array), a second looks the gains up in
an array and writes the scores out. The score at which the draw ends is found by bisection: each job counts
the persisted scores up to 15 thresholds exactly, four bisection steps at once; then the doc_id among the
documents tied at that score in the same way. The drawn rows are range-partitioned and sorted, for their ranks.

Defined cases: a null or empty text has no features and weight 0; a row with a null doc_id has no score and is
never drawn; of repeated rows at the end of the draw as many are drawn as there is room for; a table without
rows gives none, an empty target's gains come from the smoothing alone; extra columns pass through, whatever
their names (n_features, weight, score and rank replace input columns of their names). doc_id is a whole number.
"""

from __future__ import annotations

import hashlib
import math
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from feedlake.llm.common import numbered, packed, pieces, small_batches, stored, table, texts, unpacked
from feedlake.llm.decontaminate import words_of

BUCKETS, LONGEST, LEAST_WORDS, PERCENT, SEED = 10_000, 2, 20, 25, 7
#: Thresholds counted by one job of the bisection: four steps.
THRESHOLDS = 15


def feature_buckets(words: list[bytes], longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """The bucket of each run of 1 to `longest` words; crc32 goes on from a run to the next longer one."""
    runs = [crc32(w) for w in words]
    out = list(runs)
    for n in range(1, longest):
        runs = [crc32(b" " + w, c) for c, w in zip(runs, words[n:])]
        out += runs
    return np.array(out, np.int64) % buckets


def _counter(text: str, longest: int, buckets: int):
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in pieces(batches, text):
            for t in texts(batch.column(text)):
                total += np.bincount(feature_buckets(words_of(t), longest, buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    return run


def bucket_counts(df: DataFrame, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall in each bucket. `buckets` numbers go to the driver."""
    counted = df.select(text).mapInArrow(_counter(text, longest, buckets), "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for b, n in counted.groupBy("bucket").agg(F.sum("n")).collect():
        out[b] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed shares' ratio) for each bucket, in doubles."""
    s_all, t_all, n = float(corpus.sum()), float(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def gumbel(doc_id: int, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _scorer(gain: np.ndarray, longest: int, seed: int, schema: pa.Schema):
    def run(batches):
        for batch in pieces(batches, "text__"):
            rows = []
            for t, doc in zip(texts(batch.column("text__")), batch.column("doc__").to_pylist()):
                words = words_of(t)
                at = feature_buckets(words, longest, len(gain))
                weight = int(gain[at].sum()) // len(at) if len(at) else 0
                rows.append((len(words), len(at), weight, None if doc is None else weight + gumbel(doc, seed)))
            new = {n: pa.array([r[k] for r in rows], pa.int64()) for k, n in enumerate(("n_words", "n_features", "weight", "score"))}
            yield pa.RecordBatch.from_arrays([new[f.name] if f.name in new else batch.column(f.name) for f in schema], schema=schema)

    return run


def scored(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST, seed: int = SEED, text: str = "text",
           keep: list[str] | None = None) -> DataFrame:
    """row__ (the columns `keep`), doc__, n_words, n_features, weight, score: written out."""
    need = packed(docs, keep or [], F.col("doc_id").cast("long").alias("doc__"), F.col(text).alias("text__"))
    numbers = [T.StructField(n, T.LongType()) for n in ("n_words", "n_features", "weight", "score")]
    out = T.StructType([*(f for f in need.schema if f.name != "text__"), *numbers])
    return stored(need.mapInArrow(_scorer(gain, longest, seed, to_arrow_schema(out)), out), "resample-scores")


def cutoff(rows: DataFrame, value: Column, want: int) -> tuple[int, int]:
    """The smallest x such that `want` rows (1 at least) have value <= x, and how many have value < x."""
    low, high = rows.agg(F.min(value), F.max(value)).first()
    below = 0  # rows under low; the answer is in [low, high]
    while low < high:
        step = max(1, -(-(high - low) // (THRESHOLDS + 1)))
        at = list(range(low + step - 1, high, step))
        counts = rows.agg(*(F.count_if(value <= x) for x in at)).first()
        for x, n in zip(at, counts):
            if n >= want:
                high = x
                break
            low, below = x + 1, n
    return low, below


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, longest: int = LONGEST,
             buckets: int = BUCKETS, seed: int = SEED, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs (or its columns `keep`) with n_features, weight, score and rank: 1, 2, 3... by falling score and rising
    doc_id for the floor(percent * N / 100) drawn of the N documents with `least_words` words, else null."""
    small_batches(docs.sparkSession)
    keep = docs.columns if keep is None else keep
    gain = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, text, longest, buckets))
    rows = scored(docs, gain, longest, seed, text, keep)
    able = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    draw = percent * rows.where(able).count() // 100
    unranked = F.lit(None).cast("long")
    if not draw:
        return rows.withColumn("rank", unranked).transform(unpacked, keep, "n_features", "weight", "score", "rank")
    fall = -F.col("score")
    last, before = cutoff(rows.where(able), fall, draw)
    last_doc, _ = cutoff(rows.where(able & (fall == last)), F.col("doc__"), draw - before)
    taken = able & ((fall < last) | ((fall == last) & (F.col("doc__") <= last_doc)))
    place = numbered(rows.where(taken), "resample-ranks", F.desc("score"), "doc__", "n_features", "weight")
    ranked = place.withColumn("rank", F.when(F.col("at") < draw, F.col("at") + 1)).drop("at")
    rest = rows.where(~F.coalesce(taken, F.lit(False))).withColumn("rank", unranked)
    return ranked.unionByName(rest).transform(unpacked, keep, "n_features", "weight", "score", "rank")


def resampled(docs: DataFrame, target: DataFrame, **how) -> DataFrame:
    """The drawn documents, with the columns of docs."""
    whole = packed(docs, docs.columns, "doc_id", F.col(how.pop("text", "text")).alias("text_"))
    return unpacked(resample(whole, target.withColumnRenamed("text", "text_"), text="text_", keep=["row__"], **how).where("rank is not null"), docs.columns)


def op12_resample(spark, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return resample(docs.select("doc_id", "text"), target.select("text"), keep=["doc_id"])


OP12_SQL = r"""
WITH shifted AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS x),
doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
part AS (
  SELECT r, f, count(*) AS n FROM (
    SELECT r, unnest(w) AS f FROM doc UNION ALL SELECT r, w[i] || ' ' || w[i + 1] AS f FROM (SELECT r, w, unnest(range(1, len(w))) AS i FROM doc)
    UNION ALL SELECT 0 AS r, unnest(w) AS f FROM item UNION ALL SELECT 0 AS r, w[i] || ' ' || w[i + 1] AS f FROM (SELECT w, unnest(range(1, len(w))) AS i FROM item)) GROUP BY ALL),
crc AS (
  SELECT f, xor(list_reduce(list_transform(range(1, len(h), 2), lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT)), lambda c, b: xor(c >> 8, x[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT f, hex(encode(f)) AS h FROM part), shifted),
total AS (SELECT bucket, sum(CASE WHEN r > 0 THEN n END) AS s, sum(CASE WHEN r = 0 THEN n END) AS t FROM part JOIN crc USING (f) GROUP BY bucket),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((sum(s) OVER ())::DOUBLE + 10000) / ((coalesce(s, 0) + 1)::DOUBLE * (coalesce(sum(t) OVER (), 0)::DOUBLE + 10000)))) AS BIGINT) AS g FROM total),
weighed AS (SELECT r, sum(n)::BIGINT AS n_features, CAST(floor(sum(n * g) / sum(n)) AS BIGINT) AS weight FROM part JOIN crc USING (f) JOIN gain USING (bucket) WHERE r > 0 GROUP BY r),
score AS (
  SELECT r, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM doc LEFT JOIN weighed USING (r)),
place AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS k, 25 * count(*) OVER () // 100 AS most FROM score WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN k <= most THEN k END AS rank FROM score LEFT JOIN place USING (r)
"""
