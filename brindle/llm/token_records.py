"""Token ids of documents as length-delimited binary records with a separate offset index.

A record file is a run of frames:

    u64 length | u32 masked crc of those 8 bytes | payload | u32 masked crc of the payload

The payload is: u8 flags (1: doc_id is null), u8 bytes per id, i64 doc_id, then the ids; all little-endian.
The checksum is CRC-32 turned right by 15 bits plus 0xA282EAD8 modulo 2**32, so that a checksum of
data which holds checksums stays sound. Beside each `.rec` file lies an `.idx` file: 8 bytes of magic, then
u64 offset and u64 length of each frame in order, so a reader can fetch records in any order.

Order: ascending doc_id, null first; rows of equal doc_id by a hash of their text, so equal rows are
interchangeable. Null text counts as empty: its record holds the end id only. Files are written under another
name and renamed, so a task that runs again leaves the same files. Other columns of the input are not read.
"""

from __future__ import annotations

import json
import os
import struct
import unicodedata
import zlib
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brindle.llm.common import _PUNCTUATION, KEPT_BYTES, bounded_batches, column, parted, pieces, scratch, spans, take_turn, tidy

MAGIC = b"BRNDLIX1"
_HEAD = "<BBq"
#: Of token files that a task reads back, where there are more than tasks can run at once.
READ_BYTES = 64 << 20
MANIFEST = "shard string, n_docs long, n_tokens long, n_bytes long"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def unframe(data: memoryview) -> tuple[memoryview, int]:
    """The first payload of data, and the bytes its frame takes."""
    length = bytes(data[:8])
    n = struct.unpack("<Q", length)[0]
    if struct.unpack("<I", data[8:12])[0] != masked(length) or len(data) < n + 16:
        raise ValueError("damaged record length")
    payload = data[12 : 12 + n]
    if struct.unpack("<I", data[12 + n : 16 + n])[0] != masked(payload):
        raise ValueError("damaged record")
    return payload, n + 16


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, as Spark resolves it: workers' own default must not decide where a file goes."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(conf).makeQualified(where).toString()


def _fs(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return (pafs.LocalFileSystem(), uri) if uri.startswith("/") else pafs.FileSystem.from_uri(uri)


class Encoder:
    """A tokenizer of the tokenizers library, with the ids of words it has met.

    Where the tokenizer drops white space before it looks for merges, no token crosses ASCII white space, and
    a text's ids are those of its words one after another; then texts are taken some BLOCK_CHARS characters at a time, and each
    distinct word of those is looked at once. A word's
    trailing ASCII punctuation is a run of its own behind what is a letter or number in normal form, and case falls away, so what is
    encoded and kept is the stem. The first `keep` stems of letters (`known`), of KEPT_BYTES at most, and a third as many other stems and tails (`stems`)
    stay (memory is bounded); others are encoded again in each block. Any other tokenizer gets whole texts.
    """

    def __init__(self, path: str, keep: int = 300_000):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.of = Tokenizer.from_file(path)
        kind = json.loads(self.of.to_str())
        first = (kind.get("pre_tokenizer") or {}).get("pretokenizers", [kind.get("pre_tokenizer") or {}])[0]
        norm = kind.get("normalizer") or {}
        self.by_word = (
            first.get("type") == "Split" and first.get("behavior") == "Removed" and bool(first.get("invert")) and "[^\\s\\p{L}\\p{N}]+" in first["pattern"].get("Regex", "")
            and {n.get("type") for n in norm.get("normalizers", [norm])} == {"NFC", "Replace", "Lowercase"} and not kind.get("post_processor")
        )
        size = self.of.get_vocab_size()
        self.width = 2 if size <= 1 << 16 else 4
        self.type = np.dtype("<u2" if self.width == 2 else "<u4")
        suffix = kind["model"].get("end_of_word_suffix")
        #: ids that end a run of letters; None if the vocabulary does not mark them
        self.last = np.array([(self.of.id_to_token(k) or "").endswith(suffix) for k in range(size)]) if suffix else None
        self.keep, self.known, self.stems = keep, {}, {}

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text, as little-endian unsigned integers of `width` bytes."""
        if not self.by_word:
            yield from map(self._one, texts)
            return
        parts: list[bytes] | None = None
        for block in blocks(texts):
            for ids, (_, first) in zip(self._block([piece for piece, _ in block]), block, strict=True):
                if first and parts is not None:
                    yield b"".join(parts)
                parts = [ids] if first else [*parts, ids]
        if parts is not None:
            yield b"".join(parts)

    def _block(self, texts: list[str]) -> list[bytes]:
        words = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
        each = words.flatten().dictionary_encode()
        if not len(each):
            return [b""] * len(texts)
        made = pc.binary_join_element_wise(*map(self._ids, folded(each.dictionary)), pa.scalar(b"", pa.large_binary()))
        return spans(made.take(each.indices), words.offsets)

    def _ids(self, parts: pa.Array) -> pa.Array:
        """The ids of stems or tails."""
        each = parts.dictionary_encode()
        keys = each.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.known.get, keys))
        places = [k for k, x in enumerate(ids) if x is None]
        for k, x in zip(places, self._made([keys[k] for k in places]), strict=True):
            ids[k] = x
        return pa.array(ids, pa.large_binary()).take(each.indices)

    def _made(self, new: list[bytes]) -> list[bytes]:
        """The ids of distinct stems or tails that are not known; the first are kept from now on."""
        out = list(map(self.stems.get, new))
        places = [k for k, x in enumerate(out) if x is None]
        texts = [new[k].decode() for k in places]
        made = self._stems(texts)
        for k, t in zip(places, texts, strict=True):
            out[k] = made[t]
            kept, most = (self.known, self.keep) if t.isalpha() else (self.stems, self.keep // 3)
            if len(kept) < most and len(new[k]) <= KEPT_BYTES:
                kept[new[k]] = made[t]
        return out

    def _one(self, text: str) -> bytes:
        return np.asarray(self.of.encode(text, add_special_tokens=False).ids, self.type).tobytes()

    def _stems(self, new: list[str]) -> dict[str, bytes]:
        out: dict[str, bytes] = {}
        letters = [w for w in new if w.isalpha()] if self.last is not None else []
        for some in _runs(letters, TOGETHER * 8):
            runs = list(_runs(some, TOGETHER))
            for own, ids in zip(runs, self._batch([" ".join(r) for r in runs]), strict=True):
                ends = np.flatnonzero(self.last[np.frombuffer(ids, self.type)]) + 1
                if len(ends) == len(own):  # each is one run of letters, as it is but for a few odd characters
                    cuts = [0, *(ends * self.width).tolist()]
                    out |= {w: ids[a:b] for w, a, b in zip(own, cuts, cuts[1:])}
        for some in _runs([w for w in new if w not in out], TOGETHER):
            out |= dict(zip(some, self._batch(some), strict=True))
        return out

    def _batch(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, self.type).tobytes() for e in self.of.encode_batch_fast(texts, add_special_tokens=False)]


#: Characters of texts whose distinct words are looked up together, and stems that the tokenizer gets as one text.
BLOCK_CHARS, TOGETHER = 2 << 20, 256


def _runs(items: list, n: int) -> Iterator[list]:
    return (items[k : k + n] for k in range(0, len(items), n))


def blocks(texts: Iterable[str]) -> Iterator[list[tuple[str, bool]]]:
    """Pieces of the texts in order, some BLOCK_CHARS characters at a time, and whether each is its text's first."""
    held, size = [], 0
    for t in texts:
        for k, piece in enumerate(pieces(t)):
            held.append((piece, k == 0))
            size += len(piece)
            if size >= BLOCK_CHARS:
                yield held
                held, size = [], 0
    if held:
        yield held


def folded(words: pa.StringArray) -> tuple[pa.Array, pa.Array]:
    """Stems of words, ASCII ones in lower case, and the punctuation behind them. What may hold a special token stays as it is."""
    special = pc.match_substring(words, "<|")
    stem, tail = parted(words, _stays, special)
    return pc.if_else(pc.and_not(pc.string_is_ascii(stem), special), pc.ascii_lower(stem), stem), tail


def _stays(last: str) -> bool:
    """Whether a letter or number still is one at its end when normalised: of some (a capital I with a dot, letters that
    are taken apart) a mark is left last, which would be one run with punctuation behind it."""
    if last.isascii():
        return last.isalnum()
    return unicodedata.category(unicodedata.normalize("NFC", last).lower()[-1])[0] in "LN" and last.isalnum()


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, keep: int = 300_000) -> Encoder:
    """One a worker: workers are used again, and with them what they know."""
    take_turn("tokens", _encoders.clear)
    if (path, keep) not in _encoders:
        _encoders.clear()
        _encoders[path, keep] = Encoder(path, keep)
    return _encoders[path, keep]


class Shards:
    """Files of about `most` bytes (one longer frame has a file of its own). Frames go to the file as they come, so none is held."""

    def __init__(self, fs: pafs.FileSystem, base: str, name: str, attempt: int, most: int):
        self.fs, self.base, self.name, self.attempt, self.most = fs, base, name, attempt, most
        #: name, frames, tokens, bytes of each file
        self.done: list[tuple] = []
        self._open()

    def _open(self) -> None:
        self.file, self.index, self.tokens, self.at = None, [], 0, 0

    def _path(self, kind: str, done: bool = False) -> str:
        name = f"{self.name}-{len(self.done):06d}.{kind}"
        return f"{self.base}/{name}" if done else f"{self.base}/.{name}.{self.attempt}"

    def add(self, one: bytes, tokens: int) -> None:
        if self.index and self.at + len(one) > self.most:
            self.close()
        if self.file is None:
            self.file = self.fs.open_output_stream(self._path("rec"), buffer_size=1 << 20)
        self.file.write(one)
        self.index.append((self.at, len(one)))
        self.tokens += tokens
        self.at += len(one)

    def close(self) -> None:
        """End the file; the next frame begins another."""
        if not self.index:
            return
        self.file.close()
        with self.fs.open_output_stream(self._path("idx")) as f:
            f.write(MAGIC + np.asarray(self.index, "<u8").tobytes())
        for kind in ("rec", "idx"):
            self.fs.move(self._path(kind), self._path(kind, done=True))
        self.done.append((f"{self.name}-{len(self.done):06d}", len(self.index), self.tokens, self.at))
        self._open()


def write_token_records(docs: DataFrame, out_dir: str, tokenizer: str, end_id: int | None = 2, shard_bytes: int = 16 << 20) -> DataFrame:
    """Write the ids of docs (doc_id long, text string) below out_dir; return the manifest.

    Texts are dealt by ranges of doc_id, so partitions follow each other in order, and each writes files of
    about shard_bytes (one longer record has a file of its own). tokenizer: a file of the tokenizers library
    that every machine can open; end_id is appended to each document, None for no end. The manifest has a row
    for each file: shard (names ascend in the order of the documents), n_docs, n_tokens, n_bytes. No rows, no files.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    out_dir = qualified(spark, out_dir)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, fs, base = encoder(tokenizer), *_fs(out_dir)
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        end = b"" if end_id is None else np.asarray([end_id], enc.type).tobytes()
        fs.create_dir(base, recursive=True)
        to = Shards(fs, base, f"part-{part:08d}", attempt, shard_bytes)

        doc_ids: deque = deque()  # of the texts that the encoder has taken

        def texts() -> Iterator[str]:
            for batch in batches:
                for doc_id, text in zip(column(batch, "doc_id"), column(batch, "text"), strict=True):
                    doc_ids.append(doc_id)
                    yield text or ""

        for ids in enc.encode(texts()):
            doc_id = doc_ids.popleft()
            ids += end
            to.add(frame(struct.pack(_HEAD, doc_id is None, enc.width, doc_id or 0) + ids), len(ids) // enc.width)
        to.close()
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in to.done], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.int64()))], names=["shard", "n_docs", "n_tokens", "n_bytes"])

    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("_tie"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("_tie"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("_tie"))
        .select("doc_id", "text")
    )
    rows.mapInArrow(tidy(write), MANIFEST).write.mode("overwrite").parquet(f"{out_dir}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{out_dir}/manifest")


def records_of(uri: str, order: list[int] | None = None) -> Iterator[tuple[int | None, np.ndarray]]:
    """doc_id and ids of a file's records: all in order, or by number in any order through the index."""
    fs, path = _fs(uri)
    if order is None:
        with fs.open_input_stream(f"{path}.rec") as f:
            data = memoryview(f.read())
        at = 0
        while at < len(data):
            payload, n = unframe(data[at:])
            yield _parse(payload)
            at += n
    else:
        with fs.open_input_stream(f"{path}.idx") as f:
            raw = f.read()
        if raw[:8] != MAGIC:
            raise ValueError("not an index")
        places = np.frombuffer(raw, "<u8", offset=8).reshape(-1, 2)
        with fs.open_input_file(f"{path}.rec") as f:
            for k in order:
                yield _parse(unframe(memoryview(f.read_at(int(places[k][1]), int(places[k][0]))))[0])


def _parse(payload: memoryview) -> tuple[int | None, np.ndarray]:
    null, width, doc_id = struct.unpack(_HEAD, payload[: struct.calcsize(_HEAD)])
    return None if null else doc_id, np.frombuffer(payload, "<u2" if width == 2 else "<u4", offset=struct.calcsize(_HEAD))


def read_token_records(spark: SparkSession, out_dir: str, ids: bool = True) -> DataFrame:
    """The records below out_dir: doc_id, start (ids before it), n_tokens, ids_crc32 (of the ids as u32), and ids where asked for.

    Each task reads whole files named by the manifest, READ_BYTES of them at a time or more, and checks both checksums of each record.
    What comes before a file are the sums of the parts (a writing task's files) before its own, and of the files before it
    in its part: no window runs over more rows than there were writing tasks, or files of one.
    """
    out_dir = qualified(spark, out_dir)
    shards = spark.read.schema(MANIFEST).parquet(f"{out_dir}/manifest").withColumn("part", F.substring_index("shard", "-", 2))
    earlier = lambda w: F.coalesce(F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens")).select(F.col("part").alias("_part"), earlier(Window.orderBy("part")).alias("_before"))
    shards = shards.withColumn("_within", earlier(Window.partitionBy("part").orderBy("shard"))).join(parts, F.col("part") == F.col("_part"))
    before = F.col("_before") + F.col("_within")
    # AQE would put the manifest's few bytes into one task: the number of tasks goes by the bytes of the files it names
    n, size = shards.agg(F.count("*"), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    tasks = max(1, min(n, max(spark.sparkContext.defaultParallelism, -(-size // READ_BYTES))))
    names = ["doc_id", "start", "n_tokens", "ids_crc32", "shard", "record"] + ["ids"] * ids
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()] + [pa.list_(pa.int64())] * ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, start in zip(column(batch, "shard"), column(batch, "before"), strict=True):
                rows = []
                for k, (doc_id, got) in enumerate(records_of(f"{out_dir}/{shard}")):
                    wide = got.astype("<u4")
                    rows.append((doc_id, start, len(got), zlib.crc32(wide.tobytes()), shard, k) + ((wide.astype("i8"),) if ids else ()))
                    start += len(got)
                    if len(rows) == 2000:
                        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)
                        rows = []
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long, shard string, record long" + ", ids array<long>" * ids
    return shards.select("shard", before.alias("before")).repartition(tasks, "shard").mapInArrow(tidy(read), schema)


def token_records(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write, then read back: a row for each document from the files."""
    spark = docs.sparkSession
    out = scratch(spark, "tokens")
    write_token_records(docs, out, tokenizer, end_id)
    return read_token_records(spark, out, ids=False)
