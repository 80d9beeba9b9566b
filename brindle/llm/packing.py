"""Packing: documents' token ids, in order, cut into sequences of at most `most` tokens by dynamic programming.

The ids of all documents, by ascending doc_id (null first; rows of equal doc_id by a hash of their text), each with an end id, are one stream. A
sequence is a window of it. A window of fewer than `most` tokens is padded to that, unless its length is a power of two. Windows may
end at the end of a document, at that of a sentence (a token that ends in . ! ? or a line break, before white space), and, where a
stretch of more than STRETCH tokens has no such place, at every STRETCH tokens of it. For places p in order

    cost(p) = penalty(p) + WINDOW + min over places q with p - q <= most of cost(q) + padding(p - q)

with a penalty of 0 for the end of a document, SENTENCE for that of a sentence, INSIDE for other places. As padding(p - q) is most - p + q, the minimum
is that of cost(q) + q over a sliding window: a monotone queue gives it in constant time; lengths that are powers of two are
looked at besides. What is minimised is exact for each block, a run of documents of about BLOCK tokens (a longer document is a block of
its own, and beyond four times that several). Blocks lie within ranges of documents of some RANGE characters, a task each, whose bounds come from the documents
alone, so the same documents are packed alike however they lie in files; so no task holds more ids than that and one document's, and nothing runs over the whole stream.

Ids are those of the tokenizers library over the whole text. Where its tokenizer is byte-level without normalizer, no token crosses the place before a space
that does not lie within white space, so distinct words are encoded once (ByteLevel). Sequences are numbered in the order of the stream, without gaps.

Defined cases: null and empty texts are the end id alone; repeated rows are documents of their own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import zlib
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from brindle.llm.common import KEPT_BYTES, bounded_batches, column, parted, spans, stored, take_turn, tidy

MOST, BLOCK = 2048, 1 << 20
RANGE, RANGES, SAMPLED = 4_000_000, 20_000, 40
LEAST = -(1 << 63)  # where null ids lie
#: Costs in tokens of padding.
WINDOW, SENTENCE, INSIDE, STRETCH = 8, 8, 64, 64
PIECE = 1 << 20
#: Characters of texts whose parts are encoded together.
BLOCK_CHARS = 6 << 20
#: The white space of Unicode, as the tokenizer's pattern takes it.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_RUN = re.compile(rf"[{WHITE}]{{3,}}|[{WHITE}]{{2,}}\Z")
#: White space that words may hold; spaces and line breaks only begin them.
_WITHIN = re.compile(rf"[{WHITE.replace(' ', '').replace(chr(10), '')}]")
#: As bytes, to see at once that a text has no long run: ASCII white space made one, what a text may not end in, beginnings of the rest.
_SPACES = bytes(32 if chr(b) in WHITE and b < 128 else b for b in range(256))
_ENDS = (b"\t", b"\n", b"\x0b", b"\x0c", b"\r", b" ")
_BEYOND = tuple({c.encode()[:2] for c in WHITE if ord(c) >= 128})


class ByteLevel:
    """A tokenizer's ids, word by word where it is byte-level and has no other rules; else of whole texts.

    The tokenizer takes a run of white space before a word as all but its last character, then that one (a space with the word behind it). So a text
    without runs of three and more falls apart before each space and line break; longer runs are encoded for themselves. Texts are taken BLOCK_CHARS characters
    at a time, of which each distinct word is looked up once, without the punctuation at its end, which no token holds together with a letter or number.
    The first `keep` of those, of KEPT_BYTES at most, stay. Words that were not met yet are encoded together: a token that begins with a space or a line break begins the
    next. Where the file's merges are in the order of ids, tiktoken does that, for which the file's vocabulary is a table of ranks: the same ids in a third of the time.
    """

    def __init__(self, path: str, keep: int = 400_000, ranked: bool = True):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.of = Tokenizer.from_file(path)
        kind = json.loads(self.of.to_str())
        pre, added = kind.get("pre_tokenizer") or {}, kind.get("added_tokens") or []
        plain = all(not t[x] for t in added for x in ("single_word", "lstrip", "rstrip", "normalized"))
        self.by_word = (
            pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space", True)
            and not kind.get("normalizer") and not kind.get("post_processor") and len(added) <= 1 and plain
        )
        self.special = re.compile(f"({re.escape(added[0]['content'])})") if added else None
        size = self.of.get_vocab_size()
        self.type = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        names = [self.of.id_to_token(k) or "" for k in range(size)]
        texts = [self.of.decode([k], skip_special_tokens=False) if len(t) < 64 else t for k, t in enumerate(names)]
        self.ends = np.array([t.endswith((".", "!", "?", "\n")) for t in texts])
        self.begins = np.array([t[:1].isspace() for t in texts])
        self.first = np.array([t[:1] in (_BYTES[32], _BYTES[10]) for t in names])
        self.ranks = _ranks(kind["model"], {t["content"] for t in added}) if self.by_word and ranked else None
        self.keep, self.known = keep, {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, self.type).tobytes() for e in self.of.encode_batch(texts, add_special_tokens=False)]

    def ids(self, text: str) -> bytes:
        """As little-endian unsigned integers of `type`."""
        return next(self.encode([text]))

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text: of BLOCK_CHARS characters at a time the parts are made together, each distinct word once."""
        if not self.by_word:
            yield from (self._whole([t])[0] for t in texts)
            return
        own: list[bytes] | None = None
        for block in self._blocks(texts):
            for first, ids in zip((p is None for p in block), self._ids(block), strict=True):
                if first:
                    if own is not None:
                        yield b"".join(own)
                    own = []
                own.append(ids)
        if own is not None:
            yield b"".join(own)

    def _blocks(self, texts: Iterable[str]) -> Iterator[list[str | bytes | None]]:
        """Where a text begins None, then its parts: str to be encoded as it is, bytes for words between spaces that have one before them each."""
        held, size = [], 0
        for text in texts:
            held.append(None)
            for k, part in enumerate(self.special.split(text) if self.special else [text]):
                for x in [part] if k % 2 else self._segment(part) if part else ():
                    held.append(x)
                    size += len(x)
                    if size >= BLOCK_CHARS:
                        yield held
                        held, size = [], 0
        if held:
            yield held

    def _ids(self, block: list[str | bytes | None]) -> list[bytes]:
        texts = list({x for x in block if isinstance(x, str)})
        whole = dict(zip(texts, self._whole(texts), strict=True))
        words = iter(self._looked_up([x for x in block if isinstance(x, bytes)]))
        return [b"" if x is None else whole[x] if isinstance(x, str) else next(words) for x in block]

    def _segment(self, text: str) -> Iterator[str | bytes]:
        raw = text.encode()
        if b"   " not in raw.translate(_SPACES) and raw[-1:] not in _ENDS and not any(x in raw for x in _BEYOND):
            yield from self._words(text)
            return
        at = 0
        for m in _RUN.finditer(text):
            yield from self._words(text[at : m.start()])
            last = m.end() == len(text)
            yield m[0] if last else m[0][:-1]
            at = len(text) if last else m.end() - 1
        yield from self._words(text[at:] if at else text)

    def _words(self, text: str) -> Iterator[str | bytes]:
        """Of a text without long runs of white space."""
        at = 0
        while len(text) - at > PIECE:  # a piece ends before a word
            cut = text.find(" ", at + PIECE)
            while cut > 0 and (text[cut - 1] in WHITE or text[cut + 1 : cut + 2] in WHITE):
                cut = text.find(" ", cut + 1)
            if cut < 0:
                break
            yield from self._piece(text[at:cut])
            at = cut
        yield from self._piece(text[at:] if at else text)

    def _piece(self, text: str) -> Iterator[str | bytes]:
        # a word that begins with a line break has no space before it, others have; but the first, which is encoded by itself
        first, space, words = text.encode().replace(b"\n", b" \n").partition(b" ")
        if first:
            yield first.decode()
        if space:
            yield words

    def _looked_up(self, pieces: list[bytes]) -> list[bytes]:
        words = pc.split_pattern(pa.array(pieces, pa.string()), " ")
        each = words.flatten().dictionary_encode()
        stem, tail = (x.dictionary_encode() for x in parted(each.dictionary, _stays))
        keys = stem.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.known.get, keys))
        new = [w for w, x in zip(keys, ids) if x is None]
        made = self._made(new)
        for w in itertools.islice((w for w in new if len(w) <= KEPT_BYTES), max(0, self.keep - len(self.known))):
            self.known[w] = made[w]
        ids = [made[w] if x is None else x for w, x in zip(keys, ids)]
        behind = self._whole(tail.dictionary.to_pylist())
        both = (pa.array(x, pa.large_binary()).take(of.indices) for x, of in ((ids, stem), (behind, tail)))
        return spans(pc.binary_join_element_wise(*both, pa.scalar(b"", pa.large_binary())).take(each.indices), words.offsets)

    def _made(self, words: list[bytes]) -> dict[bytes, bytes]:
        out: dict[bytes, bytes] = {}
        texts = [w.decode() if w[:1] == b"\n" else " " + w.decode() for w in words]
        if self.ranks:
            odd = _WITHIN.search("".join(texts)) is not None
            plain = [k for k, t in enumerate(texts) if len(t) > 1 and not (odd and _WITHIN.search(t))]
            ids = self.ranks.encode_to_numpy("".join([texts[k] for k in plain]), allowed_special=set(), disallowed_special=()).astype(self.type)
            starts = np.flatnonzero(self.first[ids])
            if len(starts) == len(plain):
                raw, width = ids.tobytes(), self.type.itemsize
                cuts = [*(starts * width).tolist(), len(raw)]
                out = {words[k]: raw[a:b] for k, a, b in zip(plain, cuts, cuts[1:])}
        rest = [k for k, w in enumerate(words) if w not in out]
        return out | dict(zip([words[k] for k in rest], self._whole([texts[k] for k in rest]), strict=True))


def _stays(last: str) -> bool:
    """Whether a word's last character is a letter or number in every version of Unicode: punctuation behind it is a run of its own."""
    return last.isalnum() and last < "\u0180"


#: The character that stands for each byte in byte-level vocabularies: printable ones of Latin-1 for themselves, the others from U+0100 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = [chr(b) if b in _SHOWN else chr(256 + b - sum(c < b for c in _SHOWN)) for b in range(256)]
#: A fixed value: the words of byte-level tokenizers.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _ranks(model: dict, special: set[str]):
    """tiktoken's form of the model, where merges and ids are in one order; else None."""
    import tiktoken

    back = {c: b for b, c in enumerate(_BYTES)}
    vocab = {t: k for t, k in model["vocab"].items() if t not in special}
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    if len(vocab) != 256 + len(merged) or any(vocab.get(t) != 256 + k for k, t in enumerate(merged)) or {vocab.get(c) for c in _BYTES} != set(range(256)):
        return None
    return tiktoken.Encoding("words", pat_str=_PATTERN, mergeable_ranks={bytes(back[c] for c in t): k for t, k in vocab.items()}, special_tokens={})


_encoders: dict[tuple[str, int], ByteLevel] = {}


def encoder(path: str, keep: int = 400_000) -> ByteLevel:
    """One a worker."""
    take_turn("packing", _encoders.clear)
    if (path, keep) not in _encoders:
        _encoders.clear()
        _encoders[path, keep] = ByteLevel(path, keep)
    return _encoders[path, keep]


def places(ids: np.ndarray, ends: np.ndarray, enc: ByteLevel, most: int = MOST) -> tuple[np.ndarray, np.ndarray]:
    """Where documents' ids, one after another (each one's end id last, at ends - 1), may be cut, ascending, and the penalty of each place."""
    cut = enc.ends[ids[:-1]] & enc.begins[ids[1:]]
    cut[ends[ends > 1] - 2] = False  # nothing is gained by parting the end id from its text
    cut[ends[:-1] - 1] = True
    at = np.append(np.flatnonzero(cut) + 1, len(ids))
    cost = np.full(len(at), SENTENCE)
    cost[np.searchsorted(at, ends)] = 0
    gap, stretch = np.diff(at, prepend=0), min(STRETCH, most)
    wide = np.flatnonzero(gap > stretch)
    if len(wide):
        more = (gap[wide] - 1) // stretch
        first = np.repeat(at[wide] - gap[wide], more)
        within = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
        at, cost = np.concatenate((at, first + within * stretch)), np.concatenate((cost, np.full(len(within), INSIDE)))
        order = np.argsort(at, kind="stable")
        at, cost = at[order], cost[order]
    return at, cost


def windows(at: np.ndarray, cost: np.ndarray, most: int) -> list[int]:
    """The places, ascending, at which windows of least cost end. at: places from 1 on, gaps of `most` at most; the last must end one."""
    at = np.concatenate(([0], at))
    n = len(at)
    place = np.full(int(at[-1]) + 1, -1, np.int64)
    place[at] = np.arange(n)
    exact: dict[int, list[int]] = {}
    size = 1
    while size <= most:
        far = at >= size
        before = place[at[far] - size]
        hit = before >= 0
        for j, i in zip(np.flatnonzero(far)[hit].tolist(), before[hit].tolist()):
            exact.setdefault(j, []).append(i)
        size *= 2
    pos, pen = at.tolist(), [0, *cost.tolist()]
    total, key, back = [0] * n, [0] * n, [0] * n  # key: total + place
    queue: deque[int] = deque([0])
    for j in range(1, n):
        p = pos[j]
        while p - pos[queue[0]] > most:
            queue.popleft()
        i = queue[0]
        best = key[i] + most - p
        for e in exact.get(j, ()):
            if total[e] < best:
                best, i = total[e], e
        best += pen[j] + WINDOW
        total[j], back[j] = best, i
        best += p
        key[j] = best
        while queue and key[queue[-1]] >= best:
            queue.pop()
        queue.append(j)
    out, j = [], n - 1
    while j:
        out.append(pos[j])
        j = back[j]
    return out[::-1]


def in_spans(at: np.ndarray, cost: np.ndarray, most: int, span: int) -> list[int]:
    """windows() of stretches of about `span`, so that what a very long document takes is bounded."""
    out: list[int] = []
    begin, base = 0, 0
    while begin < len(at):
        end = len(at) if at[-1] - base <= span else max(begin + 1, int(np.searchsorted(at, base + span, "right")))
        out += [base + c for c in windows(at[begin:end] - base, cost[begin:end], most)]
        begin, base = end, int(at[end - 1])
    return out


def range_cuts(rows: DataFrame, chars: int) -> list[tuple[int, int]]:
    """Where ranges of (doc_id, _tie) begin, of about `chars` characters of rows (doc_id, text, _tie): the same for the same rows, however they lie in
    files and tasks. From SAMPLED rows a range, those of certain hashes; at most RANGES ranges, so what comes to the driver is bounded."""
    size = F.coalesce(F.length("text"), F.lit(0)) + 1
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    many = min(RANGES, -(-total // chars))
    if many < 2:
        return []
    every = max(1, n // (SAMPLED * many))
    some = rows.where(F.pmod(F.xxhash64("doc_id", "_tie"), F.lit(every)) == 0).select(F.coalesce("doc_id", F.lit(LEAST)).alias("d"), "_tie", size.alias("n")).collect()
    some = sorted(map(tuple, some))
    before = np.cumsum([n for _, _, n in some]) - [n for _, _, n in some] if some else np.zeros(0)
    share = sum(n for _, _, n in some) / many
    at = np.searchsorted(before, share * np.arange(1, many))
    return sorted({some[k][:2] for k in at.tolist() if k < len(some)})


def sent_within(cuts: list[tuple[int, int]]):
    """A function of doc_id and _tie: how many of the cuts are at or before them."""
    ids, ties = (np.array(x, np.int64) for x in zip(*cuts))

    @F.arrow_udf(LongType())
    def within(doc_id: pa.Array, tie: pa.Array) -> pa.Array:
        d, t = doc_id.fill_null(LEAST).to_numpy(zero_copy_only=False), tie.to_numpy(zero_copy_only=False)
        low, high = np.searchsorted(ids, d, "left"), np.searchsorted(ids, d, "right")
        for k in np.flatnonzero(low < high):
            low[k] += np.searchsorted(ties[low[k] : high[k]], t[k], "right")
        return pa.array(low, pa.int64())

    return within


_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "number", "offset"]


def packed(docs: DataFrame, tokenizer: str, most: int = MOST, end_id: int = 1, block: int = BLOCK, ids: bool = False, range_chars: int = RANGE) -> DataFrame:
    """A row for each piece of docs (doc_id, text): doc_id, start and length of the piece in its document's ids, ids_crc32 (of the piece's ids as unsigned
    32-bit little-endian), doc_tokens (all of the document's), sequence_id, offset in the sequence; and ids, where asked for.

    tokenizer: a file of the tokenizers library that every machine can open; end_id is appended to each document.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kinds = [pa.int64()] * len(_NAMES) + [pa.list_(pa.int64())] * ids
    names = [*_NAMES, "ids"][: len(kinds)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, number = encoder(tokenizer), 0, 0
        end = np.asarray(end_id, enc.type).tobytes()
        held: list[tuple[int | None, bytes]] = []
        size = 0

        def pack() -> Iterator[pa.RecordBatch]:
            nonlocal held, size, number
            flat = np.frombuffer(b"".join([raw for _, raw in held]), enc.type)
            ends = np.cumsum([len(raw) // enc.type.itemsize for _, raw in held])
            cuts = in_spans(*places(flat, ends, enc, most), most, 4 * block)
            rows, k, begin, s = [], 0, 0, 0
            for (doc_id, _), stop in zip(held, ends.tolist()):
                at, n = 0, stop - s
                wide = flat[s:stop].astype("<u4")
                raw = memoryview(wide).cast("B")
                while at < n:
                    to = min(n, cuts[k] - s)
                    rows.append((doc_id, at, to - at, zlib.crc32(raw[4 * at : 4 * to]), n, part, number, s + at - begin) + ((wide[at:to].astype("i8"),) if ids else ()))
                    at = to
                    if s + to == cuts[k]:
                        k, begin, number = k + 1, cuts[k], number + 1
                s = stop
                if len(rows) >= 5000:
                    yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds)], names=names)
                    rows = []
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds)], names=names)
            held, size = [], 0

        taken: deque = deque()  # range and doc_id of the texts that the encoder has taken

        def texts() -> Iterator[str]:
            for batch in batches:
                for of, doc_id, text in zip(*(column(batch, c) for c in ("_range", "doc_id", "text")), strict=True):
                    taken.append((of, doc_id))
                    yield text or ""

        for raw in enc.encode(texts()):
            of, doc_id = taken.popleft()
            if of != part:
                if held:
                    yield from pack()
                part, number = of, 0
            held.append((doc_id, raw + end))
            size += len(held[-1][1]) // enc.type.itemsize
            if size >= block:
                yield from pack()
        if held:
            yield from pack()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64(F.col("text").cast("string")).alias("_tie"))
    cuts = range_cuts(rows, range_chars)
    many = len(cuts) + 1
    within = sent_within(cuts)("doc_id", "_tie") if many > 1 else F.lit(0).cast("long")
    order = ["_range", F.col("doc_id").asc_nulls_first(), "_tie"]
    rows = rows.withColumn("_range", within).repartitionById(many, F.col("_range").cast("int")).sortWithinPartitions(*order).select("_range", "doc_id", "text")
    schema = ", ".join(f"{c} long" for c in _NAMES) + ", ids array<long>" * ids
    pieces = stored(rows.mapInArrow(tidy(run), schema), "packed")
    # sequences before a range's own: a row for each range
    parts = pieces.groupBy("part").agg((F.max("number") + 1).alias("n"))
    before = parts.select(F.col("part").alias("_part"), F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    numbered = pieces.join(F.broadcast(before), F.col("part") == F.col("_part"))
    return numbered.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("_before") + F.col("number")).alias("sequence_id"), "offset", *(["ids"] if ids else []))
