"""Small helpers shared by the operators: tables, written cuts, word splitting, hashing."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.session import scratch_path, ship_package

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the shared tables, by a path that only Spark has to be able to open."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ready(spark: SparkSession) -> None:
    """Make this package importable on the executors."""
    ship_package(spark)


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write a frame as a Parquet table into the shared folder and read it back.

    This cuts the lineage: later passes, and retries after a lost executor, start from the files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{tag}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# --- words ---------------------------------------------------------------------------------
# Words are split on bytes: bytes.translate folds A-Z and turns every separator into a space in
# one pass, and bytes.split() then cuts at runs of spaces. UTF-8 bytes of 0x80 and up always
# belong to a word, as every separator is ASCII.

def byte_table(is_word) -> bytes:
    """256-byte table: A-Z to a-z, bytes outside ``is_word`` to a space."""
    out = bytearray(range(256))
    for b in range(65, 91):
        out[b] = b + 32
    for b in range(128):
        if not is_word(out[b]):
            out[b] = 32
    return bytes(out)


#: Words of letters, digits and anything beyond ASCII.
ALNUM_TABLE = byte_table(lambda b: 48 <= b <= 57 or 97 <= b <= 122)
#: Words between ASCII white space.
SPACE_TABLE = byte_table(lambda b: not (b == 32 or 9 <= b <= 13))


def words(text: bytes | None, tab: bytes = ALNUM_TABLE) -> list[bytes]:
    # \x1c-\x1f are no separators for split() of bytes, so only the table decides
    return text.translate(tab).split() if text else []


def as_bytes(column) -> Iterable[bytes | None]:
    """The UTF-8 bytes of an Arrow string column, one by one."""
    import pyarrow as pa
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    for x in column.cast(kind):
        yield x.as_py()


# --- hashing -------------------------------------------------------------------------------

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64), vectorised; wraps modulo 2**64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


_BYTE_CODES = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _GOLD)
_BASE = 0x9E3779B97F4A7C15 | 1


class WordHasher:
    """64-bit hashes of all words of a text at once: a polynomial over random byte codes."""

    def __init__(self) -> None:
        self._pow = np.ones(1, np.uint64)
        self._inv = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._pow) >= n:
            return
        size = 1 << max(10, n.bit_length())
        with np.errstate(over="ignore"):
            for name, base in (("_pow", _BASE), ("_inv", pow(_BASE, -1, 1 << 64))):
                steps = np.full(size, np.uint64(base))
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def __call__(self, text: bytes | None, tab: bytes) -> np.ndarray:
        """The words' hashes in order of the text."""
        if not text:
            return np.empty(0, np.uint64)
        b = np.frombuffer(text.translate(tab), np.uint8)
        inside = b != 32
        edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        if not len(starts):
            return np.empty(0, np.uint64)
        self._grow(len(b) + 1)
        with np.errstate(over="ignore"):
            codes = np.where(inside, _BYTE_CODES[b], np.uint64(0)) * self._pow[:len(b)]
            h = np.add.reduceat(codes, starts) * self._inv[starts]
            return mix(h + (ends - starts).astype(np.uint64) * _GOLD)


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``k`` words; fewer words make one run."""
    if not len(h):
        return h
    k = min(k, len(h))
    n = len(h) - k + 1
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = mix(out * _GOLD + h[i:i + n])
        out += np.uint64(k)  # a short run is never a part of a full one
    return np.unique(out)


def column_or(df: DataFrame, name: str, kind: str):
    """A column cast to ``kind``; NULL of that type where the frame has no such column."""
    return F.col(f"`{name}`").cast(kind) if name in df.columns else F.lit(None).cast(kind)
