"""Vector code compression: product codes in exact integers, with nearest entries found by slicing and intersecting bitmasks.

A vector is cut into equal consecutive parts, and each part position has a codebook, trained by rounds of assigning all parts
to their nearest entries and moving every entry to the floor of its parts' mean. All arithmetic is in integers, so the result
does not depend on how rows are spread over tasks.

Nearest entries: for each dimension the codebook's coordinates are sorted, and place i of the sorted list carries the mask of
the i entries before it (prefix masks, as uint64 words). A radius around a part's coordinate is a range of that list, found by
two binary searches; the exclusive-or of the masks at its ends is the set of entries inside. ANDed over the dimensions, these
sets leave the entries of a box. An entry at most as far as the radius lies in that box, so the best candidate is exact as
soon as its distance is within the radius. Parts for which that fails are searched again: with the distance of the candidate
they have as radius, or twice the radius where the box was empty.

Each round is one pass over the vectors: a task gives back the sums and counts of its parts, one row per part position, entry
and coordinate, which Spark adds up. The driver holds codebooks only (parts x codes entries), which are broadcast.

Cases: rows whose vector is null or holds a null or non-finite component are dropped. So are vectors of another length than
the most common one (the greater at a tie), since they cannot be cut alike; a most common length that the parts do not divide
is a ValueError. Null ids come after all others when codebooks start, equal ids by their vectors. With fewer rows than codes the codebooks are shorter.
Repeated rows count each time. Ties go to the lower index. An empty table gives an empty result. Components too large for
exact 64-bit distances are a ValueError. Columns other than the three named are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Workspace

SCALE = 4096


class Codebook:
    """One part position's entries, with sorted coordinates and prefix masks for exact nearest-entry search."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        count, width = entries.shape
        self.words = max(1, -(-count // 64))
        bits = np.zeros((count, self.words), dtype=np.uint64)
        bits[np.arange(count), np.arange(count) // 64] = np.uint64(1) << (np.arange(count) % 64).astype(np.uint64)
        order = np.argsort(entries, axis=0, kind="stable")
        self.coordinates = np.take_along_axis(entries, order, axis=0).T.copy()
        self.prefixes = []
        for d in range(width):
            masks = np.zeros((count + 1, self.words), dtype=np.uint64)
            np.bitwise_or.accumulate(bits[order[:, d]], axis=0, out=masks[1:])
            self.prefixes.append(masks)
        self.first_radius = self._typical_gap()

    def _typical_gap(self) -> int:
        """Half the median distance of an entry to another, a guess that needs no proof."""
        if len(self.entries) < 2:
            return 1
        middle = np.median(self.entries, axis=0)
        return 1 + int(np.median(np.sqrt(((self.entries - middle) ** 2).sum(axis=1))) / 2)

    def candidates(self, parts: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries within the radius in every dimension."""
        mask = np.full((len(parts), self.words), np.uint64(2**64 - 1), dtype=np.uint64)
        for d, coordinates in enumerate(self.coordinates):
            low = np.searchsorted(coordinates, parts[:, d] - radius, side="left")
            high = np.searchsorted(coordinates, parts[:, d] + radius, side="right")
            mask &= self.prefixes[d][high] ^ self.prefixes[d][low]
        return mask

    def _closest(self, parts: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distance to the nearest candidate (-1: none) and its index, the lowest at a tie."""
        best, index = np.full(len(parts), -1, dtype=np.int64), np.zeros(len(parts), dtype=np.int64)
        for j, entry in enumerate(self.entries):
            rows = np.flatnonzero(mask[:, j // 64] >> np.uint64(j % 64) & np.uint64(1))
            far = ((parts[rows] - entry) ** 2).sum(axis=1)
            closer = (best[rows] < 0) | (far < best[rows])
            best[rows[closer]], index[rows[closer]] = far[closer], j
        return best, index

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact: index of the nearest entry of each part, and the squared distance."""
        best, index = np.zeros(len(parts), dtype=np.int64), np.zeros(len(parts), dtype=np.int64)
        left, radius = np.arange(len(parts)), np.full(len(parts), self.first_radius, dtype=np.int64)
        while len(left):
            far, which = self._closest(parts[left], self.candidates(parts[left], radius))
            sure = (far >= 0) & (far <= radius * radius)
            best[left[sure]], index[left[sure]] = far[sure], which[sure]
            open_ = ~sure
            grown = np.where(far < 0, 2 * radius, np.sqrt(np.maximum(far, 0)).astype(np.int64) + 2)
            left, radius = left[open_], np.minimum(grown[open_], 1 << 31)
        return index, best


def largest_component(length: int) -> int:
    """Up to here, squared distances over a whole vector stay below 2**62."""
    return math.isqrt((1 << 62) // max(1, length)) // 2


def integers(vectors: pa.Array, length: int, scale: int) -> np.ndarray:
    """floor(scale * x) of equally long vectors, one row each."""
    flat = np.asarray(vectors.flatten().cast(pa.float64()))
    whole = np.floor(flat * scale).reshape(len(vectors), length)
    if whole.size and np.abs(whole).max() > largest_component(length):
        raise ValueError(f"a component is beyond {largest_component(length)} / {scale}, too large for exact distances")
    return whole.astype(np.int64)


def _usable(length: int | None = None) -> Column:
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.col("vector").isNotNull() & F.coalesce(finite, F.lit(False))
    return usable if length is None else usable & (F.size("vector") == length)


def _sums(books, length: int, scale: int):
    """Per task: the sum of every entry's parts, a row for each part position, entry and coordinate."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [Codebook(entries) for entries in books.value]
        width = length // len(tables)
        sums = [np.zeros(t.entries.shape, dtype=np.int64) for t in tables]
        counts = [np.zeros(len(t.entries), dtype=np.int64) for t in tables]
        for batch in batches:
            rows = integers(batch.column("vector"), length, scale)
            for p, table in enumerate(tables):
                parts = rows[:, p * width:(p + 1) * width]
                index, _ = table.nearest(parts)
                counts[p] += np.bincount(index, minlength=len(table.entries))
                order = np.argsort(index, kind="stable")
                starts = np.flatnonzero(np.diff(index[order], prepend=-1))
                if len(starts):
                    sums[p][index[order][starts]] += np.add.reduceat(parts[order], starts, axis=0)
        out = [(p, e, d, int(counts[p][e]), int(sums[p][e, d]))
               for p, table in enumerate(tables) for e in np.flatnonzero(counts[p]).tolist() for d in range(width)]
        columns = list(zip(*out)) if out else [[]] * 5
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["part", "entry", "place", "n", "total"])

    return add


def _codes(books, length: int, scale: int):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [Codebook(entries) for entries in books.value]
        width = length // len(tables)
        for batch in batches:
            rows = integers(batch.column("vector"), length, scale)
            codes, error = np.zeros((len(rows), len(tables)), dtype=np.uint8), np.zeros(len(rows), dtype=np.int64)
            for p, table in enumerate(tables):
                index, far = table.nearest(rows[:, p * width:(p + 1) * width])
                codes[:, p] = index
                error += far
            text = pa.array([row.tobytes().hex() for row in codes], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), text, pa.array(error)], names=["vec_id", "label", "code", "error"])

    return code


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for entries in books for x in entries.ravel().tolist()).encode()).hexdigest()


def trained(kept: DataFrame, length: int, parts: int, codes: int, rounds: int, scale: int) -> list[np.ndarray]:
    """The codebooks after all rounds; kept has vec_id and usable vectors of one length."""
    spark, width = kept.sparkSession, length // parts
    # top-k: each task keeps its own first rows only
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(codes).select("vector").toArrow()
    start = integers(first.column("vector").combine_chunks(), length, scale)
    books = [start[:, p * width:(p + 1) * width].copy() for p in range(parts)]
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(books)
        task = kept.select("vector").mapInArrow(_sums(shared, length, scale), "part int, entry int, place int, n bigint, total bigint")
        means = task.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        books = [entries.copy() for entries in books]
        for row in means.collect():  # at most parts x codes x width rows
            books[row["part"]][row["entry"], row["place"]] = int(row["total"]) // row["n"]
        shared.unpersist()
    return books


def compressed(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
               parts: int = 8, codes: int = 16, rounds: int = 6, scale: int = SCALE) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error, label_error) of every usable vector, and the codebooks; see the module's notes."""
    if not 1 <= codes <= 256:
        raise ValueError("a code is two hexadecimal digits, so a codebook has 1 to 256 entries")
    spark = vectors.sparkSession
    named = vectors.select(*[F.col(f"`{c}`").alias(a) for c, a in ((id_column, "vec_id"), (vector_column, "vector"), (label_column, "label"))])
    lengths = named.where(_usable()).groupBy(F.size("vector").alias("length")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    if common is None:
        return named.where("false").selectExpr("vec_id", "label", "'' AS code", "0L AS error", "0L AS label_error"), []
    length = common["length"]
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    kept = named.where(_usable(length))
    books = trained(kept, length, parts, codes, rounds, scale)
    shared = spark.sparkContext.broadcast(books)
    id_type, label_type = kept.schema["vec_id"].dataType.simpleString(), kept.schema["label"].dataType.simpleString()
    coded = Workspace(spark, "vector-codes").store(
        kept.mapInArrow(_codes(shared, length, scale), f"vec_id {id_type}, label {label_type}, code string, error bigint"))
    # partial sums before the shuffle; a label that holds many rows is a skewed join, which adaptive execution splits
    totals = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of_label")), "left").drop("of_label"), books


def code_table(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every usable vector."""
    rows, books = compressed(vectors, **options)
    return rows.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
