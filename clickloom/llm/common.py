"""What the operators of this subpackage share.

``documents`` rows are told apart by ``doc_id`` and text.  Rows that agree in both
are one document: they get the same result, once for each row.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.sources.scratch import scratch_path

BITMAP_PIECE = 32768


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts lineage, and a lost
    executor costs no recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released(df: DataFrame) -> None:
    """Delete the files of a table made by ``written`` that nothing reads any more."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def give_back() -> None:
    """Return to the system what freed batches leave with the allocators.  A Python worker
    lives on for later tasks, and an executor has several."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim:
        trim(0)


def by_batch(
    df: DataFrame, schema: str, f: Callable[[Iterator[dict[str, list]]], Iterator[dict]]
) -> DataFrame:
    """``mapInArrow`` with columns as Python lists in and out."""
    from pyspark.sql.types import _parse_datatype_string

    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ({n: b.column(n).to_pylist() for n in b.schema.names} for b in batches)
        got = None
        for got in f(columns):
            yield pa.RecordBatch.from_arrays(
                [
                    got[x.name].cast(x.type) if isinstance(got[x.name], pa.Array) else pa.array(got[x.name], x.type)
                    for x in out
                ],
                schema=out,
            )
        del got
        give_back()

    return df.mapInArrow(run, schema)


def bitmap(values: DataFrame, column: str, bits: int = 22) -> bytes:
    """A bit for each ``crc32(value) mod 2**bits`` that occurs: a filter of fixed size
    (512 KB at 22) without false negatives, whatever the number of values."""
    slot = F.pmod(F.crc32(F.col(column).cast("binary")), F.lit(1 << bits))
    rows = (
        values.select(slot.alias("slot"))
        .groupBy((F.col("slot") / BITMAP_PIECE).cast("long").alias("piece"))
        .agg(F.expr(f"bitmap_construct_agg(slot % {BITMAP_PIECE})").alias("bits"))
        .collect()
    )
    out = bytearray((1 << bits) // 8)
    for r in rows:
        out[r.piece * BITMAP_PIECE // 8 : (r.piece + 1) * BITMAP_PIECE // 8] = bytes(r.bits)
    return bytes(out)


def bitmap_of_longs(values: DataFrame, column: str, bits: int = 24) -> bytes:
    """As ``bitmap``, by the low bits of a ``bigint`` that is a hash already."""
    rows = (
        values.select(F.pmod(F.col(column), F.lit(1 << bits)).alias("slot"))
        .groupBy((F.col("slot") / BITMAP_PIECE).cast("long").alias("piece"))
        .agg(F.expr(f"bitmap_construct_agg(slot % {BITMAP_PIECE})").alias("bits"))
        .collect()
    )
    out = bytearray((1 << bits) // 8)
    for r in rows:
        out[r.piece * BITMAP_PIECE // 8 : (r.piece + 1) * BITMAP_PIECE // 8] = bytes(r.bits)
    return bytes(out)


def bits_set(bitmap_bytes: bytes, slots: np.ndarray) -> np.ndarray:
    """Whether the bit of each slot is set."""
    taken = np.frombuffer(bitmap_bytes, np.uint8)
    slots = slots.astype(np.int64)
    return (taken[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: multiply and shift until every bit depends on all."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class WordHashes:
    """Stable 64-bit hashes of byte words, kept for the words met lately."""

    def __init__(self, most: int = 300_000):
        self.known: dict[bytes, int] = {}
        self.most = most

    def of(self, words: list[bytes]) -> np.ndarray:
        import xxhash

        known = self.known
        if len(known) > self.most:
            known.clear()
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            for w in set(words).difference(known):
                known[w] = xxhash.xxh3_64_intdigest(w)
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, size: int = 5) -> np.ndarray:
    """One hash for each run of ``size`` words, in order; a shorter text is one run."""
    n = len(words)
    if n == 0:
        return words
    k = min(size, n)
    out = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        out = (out + words[i : n - k + 1 + i]) * np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(27)
    return mixed(out + np.uint64(k))


def spans_text() -> Column:
    """``spans`` as text: ``kind:start:end`` by start, comma-joined."""
    return F.array_join(
        F.transform(
            F.array_sort("spans"),
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
