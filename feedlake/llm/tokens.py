"""Token-ID output: whole texts as ids, in ascending doc_id order, in files of range-coded blocks.

The file format is a Parquet table whose rows are blocks (see codec.py), in the order of (part, block):
`part` numbers the ranges of doc_id in ascending order, `block` the blocks of a part, `before` and
`first_row` count the ids and documents of the part before the block, `doc_ids` and `counts` tell whose
ids the block holds, `body` is the coded block with its checksums. A long document runs over many
blocks. Ids of a document end with `end_id`.

Defined cases: null or empty text is `end_id` alone; documents of one doc_id stand next to each other,
by text; null doc_ids come first; an empty table gives a table without blocks; extra columns are not
written; a damaged block raises ValueError on reading.
"""

from __future__ import annotations

import json
import zlib
from array import array
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from feedlake.llm.codec import BLOCK, LANES, decode_blocks, encode_blocks
from feedlake.llm.common import kept, pieces, small_batches, stored, table
from feedlake.session import scratch_path

#: Words whose ids a worker remembers, in two halves, and the longest of them in bytes.
MEMO, MEMO_BYTES = 1_000_000, 48
#: What may end a plain word as a piece of its own, and the first character that is none of plain words'.
PUNCTUATION, RARE = b"!#$%&()*+,-./:;=?@[]^_{|}~", "\u0250"
FILES = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("block", T.LongType()), T.StructField("before", T.LongType()), T.StructField("first_row", T.LongType()),
                      T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("counts", T.ArrayType(T.IntegerType())), T.StructField("body", T.BinaryType())])
PIECES = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("at", T.LongType()),
                       T.StructField("n", T.LongType()), T.StructField("crc", T.LongType()), T.StructField("whole", T.BooleanType())])


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds(dict):
    """Ids of white-space-separated words as bytes, for tokenizers that drop white space and split at it,
    so that a text's ids are its words' ids in a row. Plain words (no control, combining or
    rare characters, where normalising means lower-casing alone) go straight to the library's model,
    all others through the whole library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.model = Tokenizer.from_file(path), Tokenizer.from_file(path).model
        spec = json.loads(Path(path).read_text())
        steps = [p for p in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        split = next((p["pattern"]["Regex"] for p in steps if p["type"] == "Split" and p["behavior"] == "Removed" and p["invert"]), None)
        names = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        if names != ["NFC", "Replace", "Lowercase"] or split is None or [p["type"] for p in steps] != ["Split", "ByteLevel"]:
            raise ValueError("WordIds needs a tokenizer that lower-cases, drops white space and splits at it")
        self.pieces = regex.compile(split)
        plain = [chr(b) for b in (*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100))]
        others = iter(range(256, 512))  # the byte-level alphabet: printable bytes stand for themselves
        letter = {b: chr(b) if chr(b) in plain else chr(next(others)) for b in range(256)}
        self.mapped = {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0x21, ord(RARE) + 2)}
        self.plain = regex.compile("[!-~¡-¬®-ɏ]+")
        self.special = [str(t["content"]).encode() for t in spec.get("added_tokens", [])]
        self.kind, self.code = ("<u2", "H") if self.tokenizer.get_vocab_size() <= 1 << 16 else ("<u4", "I")
        #: The words that were remembered before this half filled up; those still in use move on to the next.
        self.older: dict[bytes, bytes] = {}

    def of(self, word: bytes) -> bytes:
        core = word.rstrip(PUNCTUATION)
        text = core.decode().lower()
        if text.isalpha() and (core.isascii() or max(text) < RARE):
            if len(core) < len(word):
                return self[core] + self[word[len(core) :]]
            ids = [t.id for t in self.model.tokenize(text if core.isascii() else text.translate(self.mapped))]
            return array(self.code, ids).tobytes()
        text = word.decode()
        if self.plain.fullmatch(low := text.lower()) and not any(s in word for s in self.special):
            ids = [t.id for p in self.pieces.findall(low) for t in self.model.tokenize(p.translate(self.mapped))]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array(self.code, ids).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        if len(word) > MEMO_BYTES:
            return self.of(word)
        if len(self) >= MEMO // 2:
            self.older = dict(self)
            self.clear()
        out = self.older.get(word)
        if out is None:
            out = self.of(word)
        self[word] = out
        return out

    def ids(self, text: bytes) -> np.ndarray:
        # A-Z are lower-cased by the tokenizer in any case; special tokens are matched as they are written
        words = text.split() if b"<|" in text else text.lower().split()
        return np.frombuffer(b"".join(map(self.__getitem__, words)), self.kind)

    def of_texts(self, column: pa.Array) -> list[np.ndarray]:
        """ids() of each text, null being empty. Each different word of the texts is looked up once."""
        column = column.cast(pa.string()).fill_null("")
        special, low = pc.match_substring(column, "<|"), pc.ascii_lower(column)
        words = pc.ascii_split_whitespace(pc.if_else(special, column, low) if pc.any(special).as_py() else low)
        each = words.flatten().dictionary_encode()
        if not len(each):
            return [np.zeros(0, self.kind)] * len(column)
        one = pa.ListArray.from_arrays(pa.array([0, len(each.dictionary)], pa.int32()), each.dictionary)
        different = pc.binary_join(one, "\n")[0].as_py().encode().split(b"\n")  # no word holds white space
        coded = pa.array(map(self.__getitem__, different), pa.large_binary(), size=len(different)).take(each.indices)
        at = np.frombuffer(coded.buffers()[1], np.int64)[coded.offset : coded.offset + len(coded) + 1]
        data = np.frombuffer(coded.buffers()[2] or b"", np.uint8)[: at[-1]].view(self.kind)
        edges = (at[words.offsets.to_numpy() - words.offsets[0].as_py()] // data.itemsize).tolist()
        return [data[a:b] for a, b in zip(edges, edges[1:])]


def word_ids(path: str) -> WordIds:
    """This worker's own, kept from task to task."""
    return kept(f"word ids of {path}", lambda: WordIds(path))


def _gathered(batches, most: int = 8 << 20):
    """The same rows in fewer batches, of `most` bytes or a little more."""
    held: list[pa.RecordBatch] = []

    def out():
        return pa.Table.from_batches(held).combine_chunks().to_batches()

    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= most:
            yield from out()
            held = []
    if held:
        yield from out()


def _written(path: str, end_id: int):
    schema = to_arrow_schema(FILES)

    def run(batches):
        part, own = TaskContext.get().partitionId(), word_ids(path)
        block = before = row = 0
        held: list[np.ndarray] = []  # ids of whole documents, the first from `row` on
        names: list[int | None] = []

        def blocks(ids: np.ndarray, ends: np.ndarray, names: list, last: bool):
            """The full blocks of ids (all, if last); how many ids and documents they end."""
            nonlocal block, before, row
            n = -(-len(ids) // BLOCK) if last else len(ids) // BLOCK
            cuts = [ids[k * BLOCK : (k + 1) * BLOCK] for k in range(n)]
            rows = {f.name: [] for f in schema}
            starts = np.concatenate([[0], ends])
            for k, (cut, body) in enumerate(zip(cuts, encode_blocks(cuts))):
                a = k * BLOCK
                b = a + len(cut)
                first, stop = int(np.searchsorted(ends, a, side="right")), int(np.searchsorted(starts, b, side="left"))
                for c, x in (("part", part), ("block", block), ("before", before + a), ("first_row", row + first), ("doc_ids", names[first:stop]),
                             ("counts", (np.minimum(ends[first:stop], b) - np.maximum(starts[first:stop], a)).tolist()), ("body", body)):
                    rows[c].append(x)
                block += 1
            return pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in schema], schema=schema), sum(map(len, cuts))

        def flush(last: bool):
            nonlocal held, names, before, row
            ids = np.concatenate(held) if held else np.zeros(0, np.uint32)
            ends = np.cumsum([len(x) for x in held])
            out, used = blocks(ids, ends, names, last)
            done = int(np.searchsorted(ends, used, side="right"))
            before, row = before + used, row + done
            held, names = held[done:], names[done:]
            if held and used:
                held[0] = held[0][used - (int(ends[done - 1]) if done else 0) :]
            return out

        end, n = np.array([end_id], own.kind), 0
        for batch in pieces(_gathered(batches), "text"):
            for doc_id, ids in zip(batch.column(0).to_pylist(), own.of_texts(batch.column(1))):
                ids = np.concatenate([ids, end])
                held.append(ids)
                names.append(doc_id)
                n += len(ids)
                if n >= BLOCK * LANES:
                    yield flush(False)
                    n = sum(map(len, held))
        if n:
            yield flush(True)

    return run


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, text: str = "text") -> None:
    """Write the ids of docs(doc_id, text) to `path`. The texts are range-partitioned by doc_id, once."""
    parts = int(small_batches(docs.sparkSession).conf.get("spark.sql.shuffle.partitions"))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = own.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_written(tokenizer, end_id), FILES).write.parquet(path)


def read_ids(spark, path: str) -> DataFrame:
    """The files' ids again: part, block, row (the document's place in its part), doc_id, ids, a row for
    each block that a document has ids in."""
    out = T.StructType([*FILES.fields[:2], T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.LongType()))])
    schema = to_arrow_schema(out)

    def run(batches):
        for head, ids in _decoded(batches):
            rows = {f.name: [] for f in schema}
            at = 0
            for k, (doc_id, n) in enumerate(zip(head["doc_ids"], head["counts"])):
                for c, x in (("part", head["part"]), ("block", head["block"]), ("row", head["first_row"] + k), ("doc_id", doc_id), ("ids", ids[at : at + n])):
                    rows[c].append(x)
                at += n
            yield pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in schema], schema=schema)

    return spark.read.schema(FILES).parquet(path).mapInArrow(run, out)


def _decoded(batches):
    """(the block's row less its body, its ids), decoded LANES blocks at a time."""
    held: list[dict] = []

    def out():
        for head, ids in zip(held, decode_blocks([h.pop("body") for h in held])):
            yield head, ids

    for batch in batches:
        for head in batch.to_pylist():
            held.append(head)
            if len(held) == LANES:
                yield from out()
                held = []
    if held:
        yield from out()


def _times(a: int, b: int) -> int:
    """Product of two polynomials over GF(2), bits reflected, modulo CRC-32's."""
    out, m = 0, 1 << 31
    while m:
        if a & m:
            out ^= b
        m >>= 1
        b = (b >> 1) ^ 0xEDB88320 if b & 1 else b >> 1
    return out


def crc_joined(first: int, second: int, length: int) -> int:
    """CRC-32 of two byte strings in a row, of their own CRC-32s and the second's length."""
    shift, power, n = 1 << 31, 1 << 30, 8 * length
    while n:
        if n & 1:
            shift = _times(shift, power)
        power, n = _times(power, power), n >> 1
    return _times(shift, first) ^ second


def _pieces(batches):
    """A row for each document, or for the part of one that a task's run of blocks holds."""
    schema = to_arrow_schema(PIECES)
    rows: dict[str, list] = {f.name: [] for f in schema}
    open_ = last = None  # the document that may go on: [part, row, doc_id, at, n, crc, begun here]

    def close(ended: bool):
        for c, x in zip(rows, (*open_[:6], open_[6] and ended)):
            rows[c].append(x)

    for head, ids in _decoded(batches):
        at, before = 0, head["before"]
        goes_on = last == (head["part"], head["block"] - 1)
        last = (head["part"], head["block"])
        if open_ and not goes_on:
            close(False)
            open_ = None
        data = ids.astype("<u4")
        for k, (doc_id, n) in enumerate(zip(head["doc_ids"], head["counts"])):
            own, row = data[at : at + n].tobytes(), head["first_row"] + k
            if open_ and open_[1] == row:
                open_[4] += n
                open_[5] = zlib.crc32(own, open_[5])
            else:
                if open_:
                    close(True)
                begun = at > 0 or head["block"] == 0 or goes_on
                open_ = [head["part"], row, doc_id, before + at, n, zlib.crc32(own), begun]
            at += n
        if len(rows["n"]) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in schema], schema=schema)
            rows = {f.name: [] for f in schema}
    if open_:
        close(False)
    if rows["n"]:
        yield pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in schema], schema=schema)


def _joined(batches):
    schema = to_arrow_schema(T.StructType([*PIECES.fields[:6]]))
    for b in batches:
        rows = []
        for r in b.to_pylist():
            ps = r["pieces"]
            n, crc = ps[0]["n"], ps[0]["crc"]
            for p in ps[1:]:
                n, crc = n + p["n"], crc_joined(crc, p["crc"], 4 * p["n"])
            rows.append({"part": r["part"], "row": r["row"], "doc_id": r["doc_id"], "at": ps[0]["at"], "n": n, "crc": crc})
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def read_summary(spark, path: str) -> DataFrame:
    """Read the files back: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    files = spark.read.schema(FILES).parquet(path)
    ids = F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x)
    total, offsets = 0, []
    for part, n in sorted((r[0], r[1]) for r in files.groupBy("part").agg(F.sum(ids)).collect()):
        offsets.append((part, total))
        total += n
    pieces = stored(files.mapInArrow(_pieces, PIECES), "token-pieces")
    names = [f.name for f in PIECES.fields[:6]]
    split = pieces.where(~F.col("whole")).groupBy("part", "row", "doc_id").agg(F.sort_array(F.collect_list(F.struct("at", "n", "crc"))).alias("pieces"))
    every = pieces.where("whole").select(*names).unionByName(split.mapInArrow(_joined, T.StructType([*PIECES.fields[:6]])))
    first = spark.createDataFrame(offsets, "part int, first long")
    return every.join(F.broadcast(first), "part").select("doc_id", (F.col("first") + F.col("at")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))


def op4_token_ids(spark, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    write_ids(table(spark, sf_dir, "documents"), path, default_tokenizer())
    return read_summary(spark, path)
