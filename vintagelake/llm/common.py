"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import sys
import tempfile
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Functions of this subpackage travel to the executors whole, so nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__package__])

# Rows of an Arrow batch; whole texts are sent, so a batch is kept small.
BATCH_ROWS = 256


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, UTC, and a checkpoint folder.

    The folder is the one named by spark.checkpoint.dir. Only a local session
    without that setting (tests, a laptop) gets one of its own.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
    elif sc.master.startswith("local[") or sc.master == "local":
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    else:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return spark


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: store the rows in the checkpoint folder, so a lost executor costs no earlier work.

    Shuffle files of what earlier cuts stored go when the driver's garbage is collected, on Python's side and then on the
    JVM's, which may be half an hour later; a chain of cuts would hold all of them until then. So both are asked to.
    """
    spark = prepare(df.sparkSession)
    gc.collect()
    rows = df.checkpoint(eager=True)
    spark._jvm.System.gc()
    return rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts_of(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a text column; no decoding, so broken text can't fail."""
    return column.cast(pa.binary()).to_pylist()


def words_of(text: bytes | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+`: the white space that bytes.split knows is exactly this set."""
    return text.split() if text else []


def mapped(
    df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """Apply fn to each Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def runs(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, across batches. The caller bounds the length of a run."""
    held: list[pa.Table] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        change = np.zeros(batch.num_rows, bool)
        for k in keys:
            v = t[k].to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
        starts = [0, *np.flatnonzero(change).tolist()]
        for lo, hi in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            piece = t.slice(lo, hi - lo)
            key = tuple(piece[k][0].as_py() for k in keys)
            if key != held_key and held:
                yield pa.concat_tables(held)
                held = []
            held_key = key
            held.append(piece)
    if held:
        yield pa.concat_tables(held)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64, on uint64."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(27))
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def seeds(n: int, salt: int) -> np.ndarray:
    """n fixed pseudo-random uint64."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15))


class ByteHash:
    """Hashes of many substrings of one byte string: a polynomial over random byte values, modulo 2**64.

    Prefix sums make each substring O(1); powers of the odd base have inverses modulo 2**64.
    """

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self) -> None:
        self.values = seeds(256, 77)
        self._grow(1 << 12)

    def _grow(self, n: int) -> None:
        inverse = pow(self.BASE, -1, 1 << 64)
        with np.errstate(over="ignore"):
            ones = np.ones(n, np.uint64)
            ones[1:] = np.uint64(self.BASE)
            self.power = np.multiply.accumulate(ones)
            ones[1:] = np.uint64(inverse)
            self.back = np.multiply.accumulate(ones)

    def __call__(self, text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(text)
        if n > len(self.power):
            self._grow(1 << (n - 1).bit_length())
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(self.values[np.frombuffer(text, np.uint8)] * self.power[:n], out=sums[1:])
            return mix((sums[ends] - sums[starts]) * self.back[starts] + (ends - starts).astype(np.uint64))


def crc_mod(id_col: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo divisor."""
    return F.crc32(F.col(id_col).cast("string")) % divisor


def worker_state(key: tuple, make: Callable[[], object]):
    """What make returns, once in each Python worker: kept between its tasks."""
    name = f"{__package__}.worker_state"
    store = sys.modules.setdefault(name, types.ModuleType(name)).__dict__
    if key not in store:
        store[key] = make()
    return store[key]
