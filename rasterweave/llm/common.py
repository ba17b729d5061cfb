"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterweave.session import ship

#: The separators of a word, as bytes: space and \x09-\x0D. bytes.split() without arguments splits on exactly these.
SEPARATORS = b" \t\n\x0b\x0c\r"
#: Text that one vectorised step works on. A longer document is a step of its own.
STEP_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where it is unset, one of our own on a single machine (tests), an error on a cluster."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isEmpty() and not re.fullmatch(r"local(\[[^\[]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = current.get() if current.isDefined() else "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """df as a written table in the shared folder: cuts lineage, and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


def removed(*tables: DataFrame) -> None:
    """Deletes tables of saved() that nothing reads any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._saved_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the inputs. The first call sends this package to the executors."""
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def partitions_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32(doc_id as text) mod modulus; 0 for a null id, which is thus held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus, F.lit(0))


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [x or b"" for x in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()]


def steps(sizes: list[int], most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of up to most bytes together, one text at least."""
    begin = total = 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > most:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield begin, len(sizes)


# --- vectorised hashes of words -------------------------------------------------------------------------------

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0, ..., base**(n-1) mod 2**64."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, STEP_BYTES + 4096), base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if len(have) > 4 * STEP_BYTES:
            return have
        _powers[int(base)] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for each range, equal for equal ranges wherever they stand."""
    total = np.empty(len(values) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(values * powers(_BASE, len(values)), out=total[1:])
    return mix((total[ends] - total[starts]) * powers(_INVERSE, len(values) + 1)[starts] + (ends - starts).astype(np.uint64))


_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SEPARATORS)] = True


def word_spans(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text given as uint8."""
    edge = np.empty(len(text) + 2, dtype=bool)
    edge[0] = edge[-1] = True
    edge[1:-1] = _IS_SPACE[text]
    change = np.flatnonzero(edge[1:] != edge[:-1])
    return change[::2], change[1::2]


def hash_words(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return rolling(_BYTE[text], starts, ends) if len(starts) else np.empty(0, dtype=np.uint64)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each width consecutive values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def rolling_fixed(values: np.ndarray, width: int) -> np.ndarray:
    """rolling() of each width consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.empty(len(values) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(values * powers(_BASE, len(values)), out=total[1:])
    return mix((total[width:] - total[:n]) * powers(_INVERSE, n) + np.uint64(width))


def byte_values(text: np.ndarray) -> np.ndarray:
    return _BYTE[text]


def buckets_for(docs: DataFrame, bytes_each: int = 4 << 20) -> int:
    """Buckets by the bytes that Spark expects to scan, 2**20 if it can't tell; a bucket is a group, not a partition, so their number has no cap."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(partitions_for(docs.sparkSession), size // bytes_each if size < 1 << 60 else 1 << 20)
