"""Text helpers that run inside Spark tasks, on bytes so that broken UTF-8 cannot stop a job."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from wattloom.session import work_path

#: The white space of all word rules here: space and the control characters 9 to 13.
BLANK = " \t\n\x0b\x0c\r"
#: Rows of the batches that go to Python.
BATCH = 1000


def raw(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """The bytes of each string, without decoding them."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    return column.cast(pa.large_binary() if wide else pa.binary()).to_pylist()


def plain(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """The strings; null as empty."""
    return [b.decode("utf-8", "replace") if b else "" for b in raw(column)]


def slices(texts: list[str], most: int = 500,
           characters: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Start and end of slices of bounded size; a very long text is one alone."""
    start = held = 0
    for end, text in enumerate(texts):
        if end > start and (end - start == most or held + len(text) > characters):
            yield start, end
            start, held = end, 0
        held += len(text)
    if texts:
        yield start, len(texts)


def words(text: bytes | None) -> list[bytes]:
    """Runs without white space, A-Z in lower case (`bytes` methods know ASCII only)."""
    return text.lower().split() if text else []


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: T.StructType | str) -> DataFrame:
    """`mapInArrow` in batches of at most BATCH rows. Spark's 10,000 rows of text are held several
    times over, in buffers that double, by the executor and by its Python worker."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))
    return df.mapInArrow(run, schema)


def map_rows(df: DataFrame, schema: T.StructType | str,
             rows: Callable[[Iterator[pa.RecordBatch]], Iterable[list[tuple]]]) -> DataFrame:
    """`mapInArrow` for a function that yields lists of row tuples."""
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in rows(batches):
            if out:
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow, strict=True)],
                    schema=arrow)
    return map_arrow(df, run, kind)


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as far as a text is long."""

    base = 0xD1342543DE82EF95
    up = down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> None:
        if len(cls.up) < n:
            n = max(n, 2 * len(cls.up), 1 << 14)
            inverse = pow(cls.base, -1, 1 << 64)
            cls.up, cls.down = (np.cumprod(np.concatenate(
                [np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)])) for b in (cls.base, inverse))


_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, np.uint64)
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[list(BLANK.encode())] = True


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word (run without BLANK), from differences of prefix sums."""
    codes = np.frombuffer(text, np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate([[True], _IS_BLANK[codes], [True]])))
    starts, ends = edges[::2], edges[1::2]
    _Powers.upto(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_BYTE[codes] * _Powers.up[:len(codes)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _Powers.down[starts]
               + (ends - starts).astype(np.uint64))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of `size` consecutive word hashes."""
    n = len(h) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for j in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + h[j:n + j]
    return mix(out)


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again: computed once, free of its lineage."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def freed(spark: SparkSession) -> None:
    """Have the shuffle files of finished steps removed now. Spark removes them when the driver
    happens to collect its garbage, and until then they fill the executors' disks."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
