"""What the operators share: the shared folder, cut lineage, bounded Arrow batches, words and pieces of texts."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, and what parts words: the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
_BLANK = " \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder all machines see (spark.checkpoint.dir). A temporary one only for a local master without it."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir")
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named.rstrip("/")
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="brindle-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, in a folder of this application's: it may be deleted when the application is over."""
    return f"{shared_dir(spark)}/brindle-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """The rows, computed once and kept in the shared folder; lost executors cannot lose them."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


#: Parquet's writer looks at sizes every 100 rows: of rows of megabytes, a page would be hundreds of them, and with it
#: the native buffers that compress and read it, which executors keep.
_BY_SIZE = {"parquet.page.size.row.check.min": "1", "parquet.block.size.row.check.min": "1"}


def stored(df: DataFrame, name: str) -> DataFrame:
    """As settle(), in compressed columns: for wide or binary rows."""
    path = scratch(df.sparkSession, name)
    df.write.options(**_BY_SIZE).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: What a worker keeps of words are those of this many bytes at most, so a bound on their number is one on memory.
KEPT_BYTES = 64


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 500 rows and 8 MB (one longer text is a batch of its own), so that a Python worker holds a few MB
    at a time. The same for every operator: which was called last makes no difference."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


_turn: list = [None, None]


def take_turn(name, forget=None) -> None:
    """What a Python worker keeps between tasks is one operator's at a time: before another's turn the last is told to forget."""
    if _turn[0] != name:
        if _turn[1]:
            _turn[1]()
        release()
        _turn[:] = [name, forget]


def release() -> None:
    """Give freed memory back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidy(run, forget=None):
    """For functions over batches: when a task ends, leave nothing freed but held behind, and nothing that `forget` drops."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            if forget:
                forget()
            release()

    return wrapped


def pieces(text: str, most: int = 1 << 20) -> Iterator[str]:
    """The text in pieces of about `most` characters, cut before ASCII white space only."""
    at = 0
    while len(text) - at > most:
        cut = min((p for p in (text.find(c, at + most) for c in _BLANK) if p >= 0), default=len(text))
        yield text[at:cut]
        at = cut
    yield text[at:] if at else text


def unused(df: DataFrame, name: str) -> str:
    """The name, or the first longer one that no column of df has: columns of the input may be called anything."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def spans(values: pa.LargeBinaryArray, offsets: pa.Array) -> list[bytes]:
    """The values between one offset and the next, joined."""
    if not len(values):
        return [b""] * (len(offsets) - 1)
    ends = np.frombuffer(values.buffers()[1], "i8", len(values) + 1)[offsets.to_numpy()].tolist()
    data = memoryview(values.buffers()[2] or b"")
    return [bytes(data[a:b]) for a, b in zip(ends, ends[1:])]


#: ASCII punctuation but the apostrophe, which the tokenizers' own patterns may tie to letters.
_PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def parted(words: pa.StringArray, stays: Callable[[str], bool], whole: pa.BooleanArray | None = None) -> tuple[pa.Array, pa.Array]:
    """Stems and the ASCII punctuation behind them, where the stem's last character is one that `stays` and the word is none of `whole`; else the word and nothing."""
    stem = pc.utf8_rtrim(words, characters=_PUNCTUATION)
    last = pc.utf8_slice_codeunits(stem, start=-1).dictionary_encode()
    can = pa.array([stays(c) for c in last.dictionary.to_pylist()], pa.bool_()).take(last.indices)
    stem = pc.if_else(can if whole is None else pc.and_not(can, whole), stem, words)
    if not len(words):
        return stem, words
    ends = np.frombuffer(words.buffers()[1], "i4", len(words) + 1, 4 * words.offset)[1:]
    n = (pc.binary_length(words).to_numpy() - pc.binary_length(stem).to_numpy()).astype("i4")
    to = np.append(np.zeros(1, "i4"), np.cumsum(n, dtype="i4"))
    marks = np.frombuffer(words.buffers()[2] or b"", "u1")[np.arange(to[-1]) + np.repeat(ends - to[1:], n)]
    return stem, pa.Array.from_buffers(pa.string(), len(words), [None, pa.py_buffer(to), pa.py_buffer(marks)])
