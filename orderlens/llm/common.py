"""Helpers that the operators share: a place for intermediate tables, batches of texts, range hashes of byte strings."""

from __future__ import annotations

import atexit
import hashlib
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task turns into numpy arrays at once; a longer single text is taken alone.
CHUNK_BYTES = 2 << 20
#: Bits of a map of hashes: so many for each, in all between the two powers of two.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 20, 28


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder only on a local master, where nobody else has to see it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="orderlens-llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


class Workspace:
    """Intermediate tables of one run: Parquet in the shared folder. They survive lost executors; what is left goes at exit."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.count = 0
        atexit.register(self._remove, self.root)

    def store(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept.stored_at = path
        return kept

    def drop(self, *tables: DataFrame | None) -> None:
        """Remove stored tables that no later step reads."""
        for table in tables:
            if table is not None:
                self._remove(table.stored_at)

    def _remove(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        if jvm is not None:
            try:
                target = jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
            except Exception:  # the session may be gone at exit
                return


def held_out(doc_id="doc_id"):
    """True for the rows that no classifier may learn from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def text_batches(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Arrow batches cut into runs of rows of about CHUNK_BYTES, with the column's texts as UTF-8; null is empty."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
        start, held = 0, 0
        for row, size in enumerate(sizes):
            if held and held + size > CHUNK_BYTES:
                part = batch.slice(start, row - start)
                yield part, [b"" if x is None else x for x in part.column(column).cast(pa.binary()).to_pylist()]
                start, held = row, 0
            held += size
        if start < batch.num_rows:
            part = batch.slice(start)
            yield part, [b"" if x is None else x for x in part.column(column).cast(pa.binary()).to_pylist()]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class HashBits:
    """Which 64-bit hashes may be among those of hash_bits(): another hash is, too, where it has the same last bits as one of them."""

    def __init__(self, bitmap: bytes):
        self.raw, self.bitmap, self.mask = bitmap, np.frombuffer(bitmap, dtype=np.uint8), 8 * len(bitmap) - 1

    def has(self, value: int) -> int:
        place = value & self.mask
        return self.raw[place >> 3] >> (place & 7) & 1

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        place = (hashes & np.uint64(self.mask)).astype(np.int64)
        return (self.bitmap[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


def hash_bits(hashes: DataFrame, each: int = BITS_EACH) -> Broadcast:
    """The bitmap of all hashes(hash), broadcast. However many there are, the driver holds 2**MOST_BITS bits at most."""
    bits = min(MOST_BITS, max(LEAST_BITS, (each * hashes.count()).bit_length()))
    places = hashes.select(F.col("hash").bitwiseAND(F.lit((1 << bits) - 1)).alias("place"))
    # 4096 bytes in a row
    maps = places.groupBy(F.expr("place div 32768").alias("bucket")).agg(F.bitmap_construct_agg(F.expr("place % 32768")).alias("bitmap"))
    whole = bytearray((1 << bits) // 8)
    for row in maps.toLocalIterator():
        whole[row["bucket"] * 4096:row["bucket"] * 4096 + 4096] = row["bitmap"]
    return hashes.sparkSession.sparkContext.broadcast(bytes(whole))


class RangeHash:
    """64-bit polynomial hashes of any ranges of a byte string, from one prefix sum (modulo 2**64, bytes coded at random)."""

    BASE = 6364136223846793005

    def __init__(self):
        self.code = np.random.default_rng(20240601).integers(0, 2**64, 256, dtype=np.uint64)
        self.size = 0

    def _grow(self, n: int) -> None:
        if n > self.size:
            self.size = max(n, 2 * self.size, 1 << 16)
            inverse = pow(self.BASE, -1, 2**64)
            for name, base in (("powers", self.BASE), ("inverses", inverse)):
                x = np.full(self.size, base, dtype=np.uint64)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        self._grow(n + 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.code[data] * self.powers[:n], out=sums[1:])
        return sums

    def ranges(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((sums[end] - sums[start]) * self.inverses[start] + (end - start).astype(np.uint64))


class PrimeHash:
    """64-bit hashes of ranges of a byte string: polynomials modulo two primes, so that no text is known beforehand to collide.

    Prefix sums may wrap: the difference of two is exact for ranges of up to LONG bytes. Longer ranges are digested one by one.
    """

    PRIMES = (2147483647, 2147483629)
    BASES = (1103515245, 1389796171)
    LONG = 1 << 23

    def __init__(self):
        self.size = 0

    def _grow(self, n: int) -> None:
        if n <= self.size:
            return
        self.size = max(n, 2 * self.size, 1 << 16)
        self.tables = []
        for prime, base in zip(self.PRIMES, self.BASES):
            pair = []
            for factor in (base, pow(base, -1, prime)):
                x = np.ones(1, dtype=np.uint64)
                while len(x) < self.size:
                    x = np.concatenate((x, x * np.uint64(pow(factor, len(x), prime)) % np.uint64(prime)))
                pair.append(x[:self.size])
            self.tables.append((np.uint64(prime), *pair))

    def ranges(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        n = len(data)
        self._grow(n + 1)
        out = (end - start).astype(np.uint64)
        for prime, powers, inverses in self.tables:
            sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum((data + np.uint64(1)) * powers[:n], out=sums[1:])
            value = (sums[end] - sums[start]) % prime * inverses[start] % prime
            out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + value)
        for at in np.flatnonzero(end - start > self.LONG):
            digest = hashlib.blake2b(data[start[at]:end[at]].tobytes(), digest_size=8).digest()
            out[at] = int.from_bytes(digest)
        return out
