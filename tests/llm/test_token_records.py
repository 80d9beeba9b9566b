import sys
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from brindle.llm import token_records as tr
from brindle.llm.common import KEPT_BYTES, pieces, scratch

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)


def by_hand(rows):
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*WHOLE.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=12), st.sampled_from([" ", "\n", "\x0b", "\x1c", "́", "H", "̱", "क़", "İ", "I", "²", "一", ".", ",!", "don't", "DON'T.", "The%%%", "<|", "|>", "'s", "<|endoftext|>", " ", "Σ", "ß"])), max_size=12).map("".join))
def test_word_by_word_equals_whole_text(text):
    got = np.frombuffer(next(tr.encoder(PATH).encode([text])), "<u2").tolist()
    assert got == WHOLE.encode(text, add_special_tokens=False).ids


def test_every_letter_and_number_before_punctuation():
    """Each alphanumeric code point (of ideographs and Hangul syllables, which behave alike, with two marks) before each mark of punctuation."""
    every = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000 and chr(c).isalnum()]
    alike = [c for c in every if unicodedata.name(c, "").startswith(("CJK UNIFIED", "HANGUL SYLLABLE", "TANGUT", "CUNEIFORM", "EGYPTIAN", "NUSHU", "KHITAN", "BAMUM", "YI SYLLABLE"))]
    rest = sorted(set(every) - set(alike))
    enc = tr.Encoder(PATH, keep=1_000_000)
    for mark in tr._PUNCTUATION:
        text = " ".join(c + mark for c in (rest + alike if mark in ".)" else rest))
        assert np.frombuffer(next(enc.encode([text])), "<u2").tolist() == WHOLE.encode(text, add_special_tokens=False).ids, mark


@pytest.mark.parametrize("text", ["DENİZLİ, İSTANBUL. İ.", "क़) ड़. ग़! য়. ড়,", "שׁ) בּ. וֹ, ﭏ.", "é. É, ñ) ß! ﬁ."])
def test_words_whose_letters_decompose(text):
    assert np.frombuffer(next(tr.encoder(PATH).encode([text])), "<u2").tolist() == WHOLE.encode(text, add_special_tokens=False).ids


def test_long_words_are_not_kept():
    enc = tr.Encoder(PATH)
    list(enc.encode(["x" * 5000 + ". short"]))
    assert set(enc.known) == {b"short"} and max(map(len, enc.stems)) <= KEPT_BYTES


def test_read_back_is_not_one_task(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat('word ', 50) as text")
    out = scratch(spark, "t")
    tr.write_token_records(docs, out, PATH, shard_bytes=20_000)
    assert tr.read_token_records(spark, out, ids=False).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_bounded_memory_changes_nothing():
    texts = ["a b c d e f g a b", "h. I j! a c,"]
    few, many = tr.Encoder(PATH, keep=4), tr.Encoder(PATH)
    assert list(few.encode(texts)) == list(many.encode(texts))
    assert len(few.known) <= 4 and len(few.stems) <= 2
    assert many.by_word and many.last is not None


class Counting:
    """A tokenizer that counts the characters it is given."""

    def __init__(self, of):
        self.of, self.chars = of, 0

    def encode(self, text, **options):
        self.chars += len(text)
        return self.of.encode(text, **options)

    def encode_batch_fast(self, texts, **options):
        self.chars += sum(map(len, texts))
        return self.of.encode_batch_fast(texts, **options)


def test_a_word_of_many_texts_is_encoded_once():
    """Also where nothing is kept: what costs is the number of distinct stems of some megabytes, not of each text."""
    enc = tr.Encoder(PATH, keep=0)
    enc.of = Counting(enc.of)
    texts = ["Erkeit, enzuver! 77,", "erkeit ENZUVER."] * 100
    got = [np.frombuffer(x, "<u2").tolist() for x in enc.encode(texts)]
    assert got == [WHOLE.encode(t, add_special_tokens=False).ids for t in texts]
    assert enc.of.chars < len("".join(texts[:2])) and not enc.known and not enc.stems


@pytest.mark.parametrize("text", ["<|ENDOFTEXT|>", "a<|EndOfText|>. <|endoftext|>! A<|endoftext|>B", "<|STARTOFTEXT|> <|startoftext|>, <|X"])
def test_special_tokens_in_capitals_are_none(text):
    assert np.frombuffer(next(tr.Encoder(PATH).encode([text])), "<u2").tolist() == WHOLE.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("most", [1, 7, 40])
def test_texts_across_blocks(monkeypatch, most):
    monkeypatch.setattr(tr, "BLOCK_CHARS", most)
    monkeypatch.setattr(tr, "pieces", lambda t: pieces(t, 5))
    texts = ["", "One, two! three", "\t x\x0by\x0cz\r\n ", "", "été. " * 9, "end", ""]
    got = [np.frombuffer(x, "<u2").tolist() for x in tr.Encoder(PATH).encode(iter(texts))]
    assert got == [WHOLE.encode(t, add_special_tokens=False).ids for t in texts]
    assert list(tr.Encoder(PATH).encode([])) == []


def test_texts_of_no_words():
    assert list(tr.Encoder(PATH).encode(["", " \n", "\t"])) == [b""] * 3


@pytest.mark.parametrize("rows", [
    [(5, "Hello world"), (1, None), (3, ""), (None, "no id"), (2, "x " * 5000), (9, "y" * 3000)],
    [],
    [(1, "same"), (1, "same"), (1, "same")],
])
def test_round_trip(spark, rows):
    docs = spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id long, text string, shard string, start int")
    got = tr.token_records(docs, PATH).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == by_hand(rows)


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = tr.token_records(docs, PATH).orderBy("doc_id").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == by_hand([tuple(r) for r in docs.collect()])


def test_frames_go_to_the_file_as_they_come(tmp_path):
    """A worker holds no file's frames, however large the file may become."""
    to = tr.Shards(tr._fs(str(tmp_path))[0], str(tmp_path), "part-0", 7, 16 << 20)
    for _ in range(5):
        to.add(bytes(2 << 20), 3)
    assert sum(f.stat().st_size for f in tmp_path.iterdir()) >= 8 << 20 and not to.done
    to.add(bytes(7 << 20), 4)
    to.close()
    to.close()
    assert to.done == [("part-0-000000", 5, 15, 10 << 20), ("part-0-000001", 1, 4, 7 << 20)]
    assert sorted(f.name for f in tmp_path.iterdir()) == [f"part-0-00000{k}.{x}" for k in (0, 1) for x in ("idx", "rec")]
    assert (tmp_path / "part-0-000000.rec").stat().st_size == 10 << 20


def test_small_shards_index_and_damage(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(30)
    out = scratch(spark, "t")
    shards = tr.write_token_records(docs, out, PATH, shard_bytes=4000).orderBy("shard").collect()
    assert len(shards) > 3
    name = max(shards, key=lambda s: s.n_docs).shard
    whole = list(tr.records_of(f"{out}/{name}"))
    back = list(tr.records_of(f"{out}/{name}", list(range(len(whole)))[::-1]))[::-1]
    assert [(d, i.tolist()) for d, i in whole] == [(d, i.tolist()) for d, i in back]
    path = tr._fs(f"{out}/{name}")[1] + ".rec"
    data = bytearray(open(path, "rb").read())
    data[20] ^= 1
    with pytest.raises(ValueError):
        tr.unframe(memoryview(bytes(data)))
    assert tr.read_token_records(spark, out).count() == 30
