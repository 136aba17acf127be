"""Helpers that several corpus operators share."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows and bytes of an Arrow batch: bound what a Python worker and its executor hold at once (a longer text is a batch of its own).
BATCH_ROWS, BATCH_BYTES = 512, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def extended(df: DataFrame, more: str) -> StructType:
    """The schema of ``df`` with the columns of a DDL string behind it."""
    return StructType([*df.schema.fields, *StructType.fromDDL(more).fields])


def prepare(spark: SparkSession) -> None:
    """Bound Arrow batches and those of the Parquet reader, and let Python workers import this package when run from a checkout."""
    for name, usual in (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000"), ("spark.sql.parquet.columnarReaderBatchSize", "4096")):
        if int(spark.conf.get(name, usual)) > BATCH_ROWS:
            spark.conf.set(name, str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(x for x in (environment.get("PYTHONPATH", ""), root) if x)


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor sees; one of our own only where a session without executors elsewhere names none."""
    folder = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = f"file:///tmp/lumenspan-checkpoints-{os.getuid()}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder, with options of the writer, and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/stored/{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files behind a :func:`stored` frame that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)


def crc_mod(column, n: int):
    """crc32 of the id as text, modulo n; a null id counts as remainder -1."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % n, F.lit(-1))


def texts(batch, column: str = "text") -> list[str]:
    """Texts of an Arrow batch, null as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


# splitmix64 finaliser constants (fixed values)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix64(x: np.ndarray) -> np.ndarray:
    """Vectorised 64-bit finaliser."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64))
ODD = np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
ODD_INVERSE = np.uint64(pow(int(ODD), -1, 1 << 64))
#: Longest piece of a text that is split into words at once, in bytes.
PIECE = 1 << 20
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in ((0, ODD), (1, ODD_INVERSE)):
            p = np.full(max(n, 1 << 17), base, np.uint64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS


def hashed_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash and the first byte of every word of a text whose words are parted by blanks (byte 32)."""
    hashes, starts, at = [], [], 0
    while at < len(data):
        to = data.find(b" ", at + PIECE)
        to = len(data) if to < 0 else to
        part = np.frombuffer(data, np.uint8, to - at, at)
        blank = part == 32
        edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).astype(np.int8)))
        start, stop = edge[::2], edge[1::2]
        up, down = _powers(len(part) + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * up[: len(part)], out=total[1:])
        hashes.append(mix64((total[stop] - total[start]) * down[start] + (stop - start).astype(np.uint64)))
        starts.append(start + at)
        at = to
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)
