import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from feedlake.llm import codec, tokens as k

DOCS = "doc_id long, text string, source string"
ODD = ["", None, " \n\t", "Hello, WORLD's it'll 123 4.5", "<|endoftext|> a<|startoftext|>b <|x|>", "ÀÉÎ Straße İstanbul ΣΊΣΥΦΟΣ ﬁne", "e\u0301 \u0301x A\u030a", "a\u00a0b\u2003c\x1cd\x85e", "日本語 テスト 한국어", "😀 👩‍👩‍👧", "don't DON'T ''s 's't", "x" * 5000, "tab\x0bvt\x0cff\x00nul", "ǅ ǆ ŉ ſ K Å"]


def blocks():
    r = np.random.default_rng(3)
    return [np.zeros(0, np.uint32), np.array([7], np.uint32), np.zeros(codec.BLOCK, np.uint32), np.arange(codec.BLOCK, dtype=np.uint32), r.integers(0, 2**32, codec.BLOCK, dtype=np.uint32),
            r.integers(0, 3, 1000).astype(np.uint32), np.minimum(r.geometric(0.02, codec.BLOCK), 3000).astype(np.uint32), np.tile(np.arange(40, dtype=np.uint32), 50)]


def test_blocks_round_trip():
    made = codec.encode_blocks(blocks())
    assert all(np.array_equal(a, b) for a, b in zip(blocks(), codec.decode_blocks(made)))
    assert len(made[2]) < 60 and len(made[7]) < 500  # repetition is cheap
    assert codec.encode_blocks([]) == [] and codec.decode_blocks([]) == []
    with pytest.raises(ValueError):
        codec.encode_blocks([np.zeros(codec.BLOCK + 1, np.uint32)])


def test_blocks_are_independent():
    every = codec.encode_blocks(blocks())
    assert [codec.encode_blocks([b])[0] for b in blocks()] == every
    assert np.array_equal(codec.decode_blocks(every[5:6])[0], blocks()[5])


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 5), st.integers(0, 2**32 - 1)), max_size=200), max_size=6))
def test_any_ids_round_trip(ids):
    given_ = [np.array(x, np.uint32) for x in ids]
    assert all(np.array_equal(a, b) for a, b in zip(given_, codec.decode_blocks(codec.encode_blocks(given_))))


def test_damage_is_noticed():
    made = codec.encode_blocks(blocks())[6]
    for at in (0, 5, 9, 30, len(made) - 1):
        bad = bytearray(made)
        bad[at] ^= 4
        with pytest.raises(ValueError):
            codec.decode_blocks([bytes(bad)])
    with pytest.raises(ValueError):
        codec.decode_blocks([made[:10]])


def library_ids(texts):
    t = Tokenizer.from_file(k.default_tokenizer())
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_word_ids_equal_the_whole_text():
    own = k.word_ids(k.default_tokenizer())
    for text, want in zip(ODD, library_ids([t or "" for t in ODD])):
        assert own.ids((text or "").encode()).tolist() == want, text


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(blacklist_categories=("Cs",)), max_size=60))
def test_any_text_has_the_library_s_ids(text):
    assert k.word_ids(k.default_tokenizer()).ids(text.encode()).tolist() == library_ids([text])[0]


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=80), st.binary(max_size=80))
def test_joined_crc(a, b):
    assert k.crc_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_files_read_back(spark, tmp_path):
    texts = {i: t for i, t in enumerate(ODD)} | {100: "long text " * 20000, 101: "after"}
    docs = spark.createDataFrame([(i, t, "s") for i, t in sorted(texts.items(), reverse=True)], DOCS).repartition(5)
    k.write_ids(docs, f"{tmp_path}/ids", k.default_tokenizer())
    at, want = 0, {}
    for i, ids in zip(sorted(texts), library_ids([texts[i] or "" for i in sorted(texts)])):
        own = np.array([*ids, 1], "<u4")
        want[i] = (at, len(own), zlib.crc32(own.tobytes()))
        at += len(own)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in k.read_summary(spark, f"{tmp_path}/ids").collect()}
    assert got == want
    back = {}
    for r in sorted(k.read_ids(spark, f"{tmp_path}/ids").collect(), key=lambda r: (r.part, r.block, r.row)):
        back.setdefault(r.doc_id, []).extend(r.ids)
    assert back[3] == library_ids([ODD[3]])[0] + [1] and len(back[100]) == want[100][1]


def test_pieces_of_split_documents_join(spark, tmp_path):
    docs = spark.createDataFrame([(i, "some words here " * (400 * i), "s") for i in range(6)], DOCS)
    k.write_ids(docs, f"{tmp_path}/ids", k.default_tokenizer())
    want = {tuple(r) for r in k.read_summary(spark, f"{tmp_path}/ids").collect()}
    spark.read.parquet(f"{tmp_path}/ids").repartition(7, "block").write.parquet(f"{tmp_path}/dealt")  # no task has neighbours
    assert {tuple(r) for r in k.read_summary(spark, f"{tmp_path}/dealt").collect()} == want


def test_repeated_rows_null_ids_and_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([(2, "a", "s"), (2, "a", "s"), (None, "b", "s")], DOCS)
    k.write_ids(docs, f"{tmp_path}/ids", k.default_tokenizer())
    got = sorted((r.start, r.doc_id, r.n_tokens) for r in k.read_summary(spark, f"{tmp_path}/ids").collect())
    assert got == [(0, None, 2), (2, 2, 2), (4, 2, 2)]
    k.write_ids(docs.where("false"), f"{tmp_path}/none", k.default_tokenizer())
    assert k.read_summary(spark, f"{tmp_path}/none").count() == 0


def test_each_different_word_of_a_batch_is_looked_up_once():
    class Counted(k.WordIds):
        def __getitem__(self, word):
            asked.append(word)
            return super().__getitem__(word)

    asked, own = [], Counted(k.default_tokenizer())
    got = own.of_texts(pa.array(["the cat saw The cat", None, " \n ", "cat the"] * 50).slice(1, 198))
    assert sorted(asked) == [b"", b"cat", b"saw", b"the"]
    assert [g.tolist() for g in got] == library_ids((["the cat saw the cat", "", "", "cat the"] * 50)[1:199])


def test_words_in_use_stay_remembered(monkeypatch):
    monkeypatch.setattr(k, "MEMO", 40)
    own, coded = k.WordIds(k.default_tokenizer()), []
    of = own.of
    monkeypatch.setattr(own, "of", lambda word: coded.append(word) or of(word))
    got = [own.ids(b"often word%d" % i).tolist() for i in range(300)]
    assert got == library_ids([f"often word{i}" for i in range(300)])
    assert coded.count(b"often") == 1 and len(own) + len(own.older) <= 40


@settings(max_examples=30, deadline=None)
@given(st.lists(st.one_of(st.none(), st.sampled_from(ODD), st.text(st.characters(blacklist_categories=("Cs",)), max_size=40)), max_size=8))
def test_texts_of_a_batch_have_the_library_s_ids(texts):
    got = k.word_ids(k.default_tokenizer()).of_texts(pa.array(texts, pa.string()))
    assert [g.tolist() for g in got] == (library_ids([t or "" for t in texts]) if texts else [])


def test_ids_that_come_once_cost_their_class_alone():
    r = np.random.default_rng(5)
    once = r.permutation(40_000)[: codec.BLOCK].astype(np.uint32)
    mixed = np.where(r.random(codec.BLOCK) < 0.5, once, r.integers(0, 4, codec.BLOCK)).astype(np.uint32)
    wide = once + np.uint32(1 << 31)
    made = codec.encode_blocks([once, mixed, wide])
    assert all(np.array_equal(a, b) for a, b in zip([once, mixed, wide], codec.decode_blocks(made)))
    assert len(made[0]) < 2 * codec.BLOCK + 100
