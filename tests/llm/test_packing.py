import itertools
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from brindle.llm import packing as pk
from brindle.llm.queries import op12_sequence_packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(PATH)
ODD = [" ", "  ", "   ", "\n", "\n\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", " ", " ", " ", "　", "​", "a", "Word", "don't", "'s", "'", ".", "!?", "...", "42", "\xb2", "\xe9", "é", "क़", "一", "<|endoftext|>", "<|", "\U0001f600", "\0", "ȷ", "ɐ."]


ENCODERS = {r: pk.ByteLevel(PATH, ranked=r) for r in (True, False)}


def own_ids(text, ranked=True):
    enc = ENCODERS[ranked]
    return np.frombuffer(enc.ids(text), enc.type).tolist()


def whole(text):
    return WHOLE.encode(text, add_special_tokens=False).ids


@settings(max_examples=600, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=8), st.sampled_from(ODD)), max_size=14).map("".join))
def test_word_by_word_equals_whole_text(text):
    assert own_ids(text) == own_ids(text, False) == whole(text)


@pytest.mark.parametrize("text", ["".join(x) for x in itertools.product(["", "a"], [" ", "\n", "\t", "\xa0", "  ", " \n", "\n "], [" ", "\n", "\xa0", "\t "], ["", "b", ".", "'s"])])
def test_runs_of_white_space(text):
    assert own_ids(text) == own_ids(text, False) == whole(text)


def test_every_character_in_words():
    """Each code point that is not white space, within and at either end of a word, between letters and marks."""
    every = [chr(c) for c in range(0x21, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000 and chr(c) not in pk.WHITE]
    for form in (" a{0}b.", " {0}1", " .{0}.", " {0}{0}'s", "\n{0}x"):
        for at in range(0, len(every), 20_000):
            text = "".join(form.format(c) for c in every[at : at + 20_000])
            assert own_ids(text) == whole(text), form


def test_pieces_of_long_texts(monkeypatch):
    monkeypatch.setattr(pk, "PIECE", 7)
    text = "one two  three\n four\xa0 five.   six \n\n seven eight nine ten\n\neleven " * 5
    assert own_ids(text) == whole(text)


def test_long_words_are_not_kept():
    enc = pk.ByteLevel(PATH)
    enc.ids("a " + "x" * 5000 + ". short")
    assert set(enc.known) == {b"short"}


class Counting:
    """An encoder that counts the characters it is given."""

    def __init__(self, of):
        self.of, self.chars = of, 0

    def encode_batch(self, texts, **options):
        self.chars += sum(map(len, texts))
        return self.of.encode_batch(texts, **options)

    def encode_to_numpy(self, text, **options):
        self.chars += len(text)
        return self.of.encode_to_numpy(text, **options)


@pytest.mark.parametrize("ranked", [True, False])
def test_a_word_of_many_texts_is_encoded_once(ranked):
    """Also where nothing is kept, and with other punctuation behind it."""
    enc = pk.ByteLevel(PATH, keep=0, ranked=ranked)
    enc.of = Counting(enc.of)
    enc.ranks = enc.ranks and Counting(enc.ranks)
    texts = ["Erkeit enzuver! erkeit, 77,", "Erkeit enzuver. erkeit!"] * 100
    got = list(enc.encode(texts)) if hasattr(enc, "encode") else list(map(enc.ids, texts))
    assert [np.frombuffer(x, enc.type).tolist() for x in got] == [whole(t) for t in texts]
    assert enc.of.chars + (enc.ranks.chars if ranked else 0) < 2 * len("".join(texts[:2])) and not enc.known


@pytest.mark.parametrize("most", [1, 7, 40])
def test_texts_across_blocks(monkeypatch, most):
    monkeypatch.setattr(pk, "BLOCK_CHARS", most)
    monkeypatch.setattr(pk, "PIECE", 9)
    texts = ["", "One, two! three", "\t x\x0by\n\n\nz\r\n ", "", "été. " * 9, "a<|endoftext|>! b", "end", "", " ", "\n", "No\xa0break. \u0180. \xb2, \u02b0."]
    got = list(pk.ByteLevel(PATH).encode(iter(texts)))
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == [whole(t) for t in texts]
    assert list(pk.ByteLevel(PATH).encode([])) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.one_of(st.text(max_size=6), st.sampled_from(ODD)), max_size=8).map("".join), max_size=6))
def test_texts_together_equal_each_alone(texts):
    assert [np.frombuffer(x, "<u2").tolist() for x in ENCODERS[True].encode(texts)] == [whole(t) for t in texts]


def padding(n, most):
    return 0 if n & (n - 1) == 0 else most - n


def cost_of(cuts, at, cost, most):
    pen = dict(zip(at, cost, strict=True))
    return sum(padding(b - a, most) + pen[b] + pk.WINDOW for a, b in zip([0, *cuts], cuts))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 11), st.sampled_from([0, 3, 8, 64])), min_size=1, max_size=11), st.sampled_from([11, 12, 16]))
def test_windows_cost_least(gaps, most):
    at = np.cumsum([g for g, _ in gaps])
    cost = [c for _, c in gaps]
    got = pk.windows(at, np.array(cost), most)
    last = int(at[-1])
    possible = []
    for r in range(len(at)):
        for inner in itertools.combinations(at[:-1].tolist(), r):
            cuts = [*inner, last]
            if all(b - a <= most for a, b in zip([0, *cuts], cuts)):
                possible.append(cost_of(cuts, at.tolist(), cost, most))
    assert cost_of(got, at.tolist(), cost, most) == min(possible)


def test_spans():
    at = np.cumsum(np.random.default_rng(3).integers(1, 40, 3000))
    cost = np.full(3000, 8)
    cuts = pk.in_spans(at, cost, 256, 5000)
    assert cuts[-1] == at[-1] and set(cuts) <= set(at.tolist()) and max(np.diff([0, *cuts])) <= 256
    assert pk.in_spans(at, cost, 256, 10**9) == pk.windows(at, cost, 256)


def test_places():
    enc = pk.encoder(PATH)
    one, two = ([*whole(t), 1] for t in ("One two. Three four! 3.5 five?\nSix.", "Seven."))
    ids, ends = np.array(one + two), np.array([len(one), len(one) + len(two)])
    at, cost = pk.places(ids, ends, enc)
    parts = [WHOLE.decode(ids[a:b].tolist()) for a, b in zip([0, *at], at)]
    assert parts[:3] == ["One two.", " Three four!", " 3.5 five?"] and parts[-1] == 'Seven."'
    assert [c for c in cost if c == 0] == [0, 0] and set(cost.tolist()) == {0, pk.SENTENCE}
    assert set(at[cost == 0].tolist()) == set(ends.tolist())
    at, cost = pk.places(np.zeros(500, enc.type), np.array([500]), enc)
    assert np.diff(at, prepend=0).max() <= pk.STRETCH and at[-1] == 500
    assert pk.places(np.array([1]), np.array([1]), enc)[0].tolist() == [1]
    assert pk.places(np.array([1, 1, 5, 1]), np.array([1, 2, 4]), enc)[0].tolist() == [1, 2, 4]


def held(rows, docs, most=2048):
    """Every id in one piece, sequences without gaps, checksums; returns padding and tokens."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    wanted = {}
    for d, t in docs:
        ids = [*whole(t or ""), 1]
        wanted.setdefault((d, len(ids)), []).append(ids)
    assert set(by_doc) == set(wanted)
    for key, texts in wanted.items():
        got = sorted(by_doc[key], key=lambda r: (r.sequence_id, r.offset))
        pieces = [(r.start, r.length, r.ids_crc32) for r in got]
        assert sum(p[1] for p in pieces) == sum(map(len, texts))
        if len(texts) == 1:
            at = 0
            for start, length, crc in pieces:
                assert start == at and length > 0
                assert crc == zlib.crc32(np.asarray(texts[0][start : start + length], "<u4").tobytes())
                at += length
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    pad = 0
    for got in by_sequence.values():
        at = 0
        for r in sorted(got, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= most
        pad += padding(at, most)
    return pad, sum(len(i) for texts in wanted.values() for i in texts)


def test_tables(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows = op12_sequence_packing(spark, sf_dir).collect()
    pad, tokens = held(rows, docs)
    print(f"padding {pad / tokens:.4%} of {tokens}")
    assert pad < tokens / 100
    order = [r.doc_id for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset))]
    assert order == sorted(order)


def test_defined_cases(spark):
    docs = [(5, "One two."), (None, "x"), (3, None), (3, ""), (4, "same"), (4, "same"), (6, "long " * 30_000), (7, "z" * 20_000)]
    frame = spark.createDataFrame([(*d, 7, "p") for d in docs], "doc_id long, text string, start long, part string")
    rows = pk.packed(frame, PATH, ids=True).collect()
    held(rows, docs)
    six = [r for r in rows if r.doc_id == 6]
    assert [i for r in sorted(six, key=lambda r: r.start) for i in r.ids] == [*whole(docs[6][1]), 1]
    assert pk.packed(frame.limit(0), PATH).collect() == []


def test_the_same_however_rows_lie(spark):
    """Ranges, blocks and sequences depend on the documents alone; ids that repeat, many times, too."""
    docs = [(k % 40 if k % 3 else 7, f"Words of text {k}. " * (k % 23)) for k in range(400)] + [(None, "Null. " * k) for k in range(30)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    one = sorted(map(tuple, pk.packed(frame.coalesce(1), PATH, range_chars=3000).collect()), key=str)
    other = sorted(map(tuple, pk.packed(frame.repartition(7), PATH, range_chars=3000).collect()), key=str)
    assert one == other
    cuts = pk.range_cuts(frame.withColumn("_tie", pk.F.xxhash64("text")), 3000)
    assert len(cuts) > 10 and cuts == sorted(set(cuts))
    order = [r[0] for r in sorted(one, key=lambda r: (r[5], r[6]))]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    held(pk.packed(frame, PATH, range_chars=3000).collect(), docs)


def test_small_blocks_and_other_lengths(spark):
    docs = [(k, f"Words of number {k}. " * (k % 9)) for k in range(120)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for most, block in ((64, 100), (100, 5000), (20, 3000), (64, 8)):
        held(pk.packed(frame, PATH, most=most, block=block).collect(), docs, most)


def test_other_tokenizers_get_whole_texts():
    enc = pk.ByteLevel(public_tokenizers.path("word_bpe_49k.json"))
    text = "Some Words  here.\n\nAnd there!"
    assert not enc.by_word and np.frombuffer(enc.ids(text), enc.type).tolist() == Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode(text, add_special_tokens=False).ids
