"""Line dedup: lines that many documents share stay in the last of these documents only; the result is a
compressed bitmap of kept lines for each document, not text. DataFrame functions alone.

A line's key is the line without white space at both ends, A-Z lowered. Keys of at least `min_chars` code
points in at least `min_docs` documents lose all their lines but those of the largest doc_id.

Plan:
  1. The lines with long keys, as (document, position, 128 bits of hash), are written out once.
  2. Keys that are more than about an eighth of a partition are found by a frequent-items sketch; there are at
     most some 8 for each partition. They are counted by partial aggregates, (key, document) first, and their
     verdicts, one row a key, are broadcast: no line of such a key is shuffled.
  3. All other lines are range-partitioned by hash and sorted by (hash, document from the largest, position);
     a window streams over each key's run, in which the first document's lines are the ones that stay.
  4. The lines to drop are or-ed into words of 64 lines for each document. A bitmap lists the words that drop
     a line, (word, bits of the kept lines); absent words keep all of theirs.

Defined cases: a null or empty text is one empty line; a null doc_id is a document of its own, smaller than all
others; rows of one doc_id are one document, with a bitmap for each text, and equal rows have equal bitmaps;
a table without rows gives none; extra columns pass through, whatever their names (n_lines, n_dropped and
keep_bitmap replace input columns of their names). Two keys whose 128 bits agree would be one key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedlake.llm.common import packed, stored, table, unpacked

SPACE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A key is frequent from this share of a partition's rows on, and from LEAST_ROWS rows on.
SHARE, LEAST_ROWS = 8, 1000
#: Most counters of the frequent-items sketch.
MOST_TRACKED = 1 << 19


def line_list(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    key = F.btrim(line, F.lit(SPACE))
    ascii_only = F.octet_length(key) == F.char_length(key)
    return F.when(ascii_only, F.lower(key)).otherwise(F.translate(key, UPPER, LOWER))


def long_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc_, print_, pos, h1, h2 of the lines whose keys are long enough. docs(doc_, print_, text_)."""
    lines = docs.select("doc_", "print_", F.posexplode(line_list("text_")).alias("pos", "line"))
    lines = lines.where(F.char_length(F.btrim("line", F.lit(SPACE))) >= min_chars)
    key = line_key(F.col("line"))
    return lines.select("doc_", "print_", "pos", F.xxhash64(F.lit(1), key).alias("h1"), F.xxhash64(F.lit(2), key).alias("h2"))


def frequent(lines: DataFrame, parts: int) -> DataFrame:
    """(h1) of the keys with more than about 1 / (SHARE * parts) of all lines."""
    n = lines.count()
    least = max(LEAST_ROWS, n // (SHARE * parts))
    most = min(MOST_TRACKED // 8, 2 * SHARE * parts)
    top = lines.select(F.expr(f"approx_top_k(h1, {most}, {min(MOST_TRACKED, 64 * most)})").alias("top"))
    found = top.select(F.explode("top").alias("t")).where(F.col("t.count") >= least)
    return stored(found.select(F.col("t.item").alias("h1")), "lines-frequent")


def dropped_frequent(lines: DataFrame, hot: DataFrame, min_docs: int) -> DataFrame:
    """The lines of frequent keys that go: verdicts by partial aggregates."""
    rows = lines.join(F.broadcast(hot), "h1", "left_semi")
    verdicts = (rows.select("h1", "h2", "doc_").groupBy("h1", "h2", "doc_").agg(F.lit(1).alias("one"))
                .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_").alias("last")).where(F.col("n_docs") >= min_docs))
    gone = rows.join(F.broadcast(verdicts.select("h1", "h2", "last")), ["h1", "h2"])
    return gone.where(~F.col("doc_").eqNullSafe(F.col("last"))).select("doc_", "print_", "pos")


def dropped_ranged(lines: DataFrame, hot: DataFrame, min_docs: int, parts: int) -> DataFrame:
    """The lines of all other keys that go: hash ranges, each sorted by document and position, streamed."""
    last_first = F.col("doc_").desc_nulls_last()
    rows = (lines.join(F.broadcast(hot), "h1", "left_anti").repartitionByRange(parts, "h1", "h2")
            .sortWithinPartitions("h1", "h2", last_first, "pos"))
    key = Window.partitionBy("h1", "h2")
    nth = F.dense_rank().over(key.orderBy(last_first))
    rows = rows.withColumn("nth", nth).withColumn("n_docs", F.max("nth").over(key))
    return rows.where((F.col("nth") > 1) & (F.col("n_docs") >= min_docs)).select("doc_", "print_", "pos")


def bitmaps(dropped: DataFrame) -> DataFrame:
    """doc_, print_, n_dropped, keep_bitmap of the documents that lose lines."""
    bit = F.expr("shiftleft(1L, pos & 63)")
    words = dropped.groupBy("doc_", "print_", F.shiftright("pos", 6).alias("word")).agg(F.bit_or(bit).alias("gone"))
    return words.groupBy("doc_", "print_").agg(
        F.sum(F.bit_count("gone")).alias("n_dropped"),
        F.array_sort(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("keep")))).alias("keep_bitmap"))


def line_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs (or its columns `keep`; without them all but the text) with n_lines, n_dropped and keep_bitmap: the
    words of 64 lines that lose one, as (word, bits of the lines that stay), or null if every line stays."""
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = docs.select(F.col("doc_id").alias("doc_"), F.xxhash64(text).alias("print_"), F.col(text).alias("text_"))
    lines = stored(long_lines(own, min_chars), "lines")
    hot = frequent(lines, parts)
    gone = dropped_frequent(lines, hot, min_docs).unionByName(dropped_ranged(lines, hot, min_docs, parts))
    found = bitmaps(gone).withColumnsRenamed({"doc_": "doc__", "print_": "print__", "n_dropped": "n_dropped_"})
    rows = packed(docs, keep, F.col("doc_id").alias("doc_"), F.xxhash64(text).alias("print_"),
                  F.size(line_list(text)).cast("long").alias("n_lines"))
    same = F.col("doc_").eqNullSafe(F.col("doc__")) & (F.col("print_") == F.col("print__"))
    # a bitmap is far smaller than its text: hashed, so that the rows with texts need not be sorted
    out = rows.join(found.hint("shuffle_hash"), same, "left").withColumn("n_dropped", F.coalesce("n_dropped_", F.lit(0)).cast("long"))
    return unpacked(out, keep, "n_lines", "n_dropped", "keep_bitmap")


def dense(bitmap: str) -> Column:
    """The words of a bitmap from the first to its last, the absent ones filled in."""
    before = lambda k: F.coalesce(F.get(F.col(bitmap), k - 1)["word"], F.lit(-1))
    return F.flatten(F.transform(bitmap, lambda w, k: F.concat(F.array_repeat(F.lit(-1).cast("long"), w["word"] - before(k) - 1), F.array(w["keep"]))))


def kept_text(text: str, words: str) -> Column:
    """The kept lines of a text, joined by line feeds; `words` is a column of dense words (null: all stay)."""
    stays = lambda line, i: F.coalesce(F.getbit(F.get(F.col(words), F.shiftright(i, 6)), F.pmod(i, F.lit(64))), F.lit(1)) == 1
    return F.when(F.col(words).isNull(), F.coalesce(text, F.lit(""))).otherwise(F.array_join(F.filter(line_list(text), stays), "\n"))


def deduplicated(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, text: str = "text") -> DataFrame:
    """docs with the kept lines as their texts. A null text stays null."""
    whole = packed(docs, docs.columns, "doc_id", F.col(text).alias("text_"))
    out = with_words(line_bitmaps(whole, min_chars, min_docs, "text_", keep=["row__", "text_"]))
    new = F.when(F.col("text_").isNotNull(), kept_text("text_", "words_"))
    return out.select(*(new.alias(c) if c == text else F.col(f"row__.`{c}`") for c in docs.columns))


def with_words(rows: DataFrame) -> DataFrame:
    """rows with the dense words of their bitmaps, words_: once for a text, not once for a line."""
    return rows.withColumn("words_", F.explode(F.array(dense("keep_bitmap"))))


def op11_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    seen = with_words(line_bitmaps(docs, keep=["doc_id", "text"]))
    return seen.select("doc_id", "n_lines", "n_dropped", F.sha2(kept_text("text", "words_"), 256).alias("kept_sha256"))


OP11_SQL = r"""
WITH line AS (
  SELECT r, doc_id, i, x[i] AS line, translate(trim(x[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT r, doc_id, x, unnest(range(1, len(x) + 1)) AS i
        FROM (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents))),
common AS (SELECT key, max(doc_id) AS last FROM line WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (last <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (last IS NULL OR last = doc_id), '')) AS kept_sha256
FROM line LEFT JOIN common USING (key) GROUP BY r, doc_id
"""
