import os

import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from brindle.llm.common import stored


def _first_page(path: str, at: int) -> int:
    """The uncompressed bytes of the page there: the second field of its header."""
    with open(path, "rb") as f:
        f.seek(at)
        head = f.read(24)
    where, fields = 0, []
    for _ in range(2):
        assert head[where] == 0x15  # the next field, an i32
        value, shift, where = 0, 0, where + 1
        while True:
            value, more = value | (head[where] & 127) << shift, head[where] >= 128
            where, shift = where + 1, shift + 7
            if not more:
                break
        fields.append((value >> 1) ^ -(value & 1))
    return fields[1]


def test_pages_of_large_rows_are_bounded(spark):
    """Parquet's writer would put a hundred rows in a page, and its compressor takes native memory of a page's size, and keeps it."""
    rows = spark.range(0, 30, 1, 1).select("id", F.concat(*(F.sha2(F.concat("id", F.lit(f" {k}")), 512) for k in range(64))).alias("one")).select("id", F.expr("cast(repeat(one, 256) as binary)").alias("wide"))
    got = stored(rows, "wide")
    assert got.agg(F.count("*"), F.sum(F.length("wide"))).first()[:] == (30, 30 * 64 * 128 * 256)
    pages = []
    for uri in got.inputFiles():
        path = pafs.FileSystem.from_uri(uri)[1]
        meta = pq.ParquetFile(path).metadata
        assert os.path.getsize(path) and meta.num_row_groups
        pages += [_first_page(path, meta.row_group(k).column(1).data_page_offset) for k in range(meta.num_row_groups)]
    assert pages and max(pages) < 3 * 64 * 128 * 256
