"""Removal of long repeated byte strings, by a logarithmic family of sparse suffix arrays.

Which suffixes are indexed: of each string of `length` bytes, the one that starts at the smallest hash of SEED bytes in it.
Equal strings choose the same suffix, so a repeat always shares an indexed one, and only about one position in 180 is kept.
A suffix array here is a table of such suffixes in the order of their first SEED bytes, then of the stretch of text whose
strings chose it. New batches are sorted into such arrays; a level of the same size is merged with it, and the merged array
goes on to the next size, so a family over n batches has at most log2(n) levels. A scan of the merged levels looks at each
row's two neighbours only. Rows are dealt out in ranges of the whole order, so a suffix of very many texts is spread.

What repeats, exactly: neighbours of one stretch (by a 64-bit hash of it, with suffix and place) repeat as a whole. A stretch that
is alone, though its suffix is not, is one at the ends of a copied passage: its bytes are read, and it is put in order twice, by what follows
the suffix and by what precedes it. The next few neighbours in either order give intervals of strings that repeat, by
their common bytes; the nearest ones also bound how far any other suffix can agree. Strings within those bounds and in no
interval (texts that follow one family ahead and another one behind) are looked for among all strings of their suffix.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HashBits, RangeHash, Workspace, hash_bits, mixed, text_batches

LENGTH = 400
SEED = 32
BATCHES = 4
#: Neighbours on either side that a stretch is compared with.
NEAR = 4
#: Starts of strings that are looked at together in a long text.
SEGMENT = 1 << 20

_HASHES = RangeHash()
ROW = "head binary, stretch long, before int, after int, content binary, position long"
ORDER = ["head", "stretch", "before", "after", "content", "position"]
PLACE = ["content", "position", "before", "after", "whole"]


def _suffixes(data: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, ...]:
    """head, stretch, before, after, position of the suffixes chosen by the strings that start in data."""
    width = length - seed + 1
    sums = _HASHES.prefix(data)
    n = len(data) - seed + 1
    hashes = mixed((sums[seed:] - sums[:-seed]) * _HASHES.inverses[:n])
    keys = (hashes & ~np.uint64(0xFFFFFF)) | np.arange(n, dtype=np.uint64)   # the leftmost of equal hashes wins
    rows = -(-n // width)
    padded = np.full(rows * width, np.uint64(2**64 - 1))
    padded[:n] = keys
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(grid, axis=1).ravel()
    chosen = (np.minimum(ahead[:n - width + 1], behind[width - 1:n]) & np.uint64(0xFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
    last = np.append(first[1:], len(chosen)) - 1
    position = chosen[first]
    stretch = _HASHES.ranges(sums, first, last + length)
    heads = np.lib.stride_tricks.sliding_window_view(data, seed)[position]
    return heads, stretch.view(np.int64), position - first, position - last, position


def suffixes(texts: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """The indexed suffixes of texts(content, text): ROW, with position as a byte offset into the text."""
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in text_batches(batches):
            parts, owners = [], []
            for content, text in zip(batch.column("content").to_pylist(), found):
                data = np.frombuffer(text, dtype=np.uint8)
                for at in range(0, len(data) - length + 1, SEGMENT):
                    part = _suffixes(data[at:at + SEGMENT + length - 1], length, seed)
                    parts.append((*part[:4], part[4] + at))
                    owners += [content] * len(part[0])
            if parts:
                heads, *columns = [np.concatenate(c) for c in zip(*parts)]
                offsets = np.arange(0, (len(heads) + 1) * seed, seed, dtype=np.int32)
                head = pa.Array.from_buffers(pa.binary(), len(heads), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(heads))])
                arrays = [pa.array(c, k) for c, k in zip(columns, [pa.int64(), pa.int32(), pa.int32()])]
                yield pa.RecordBatch.from_arrays([head, *arrays, pa.array(owners, pa.binary()), pa.array(columns[3], pa.int64())],
                                                 names=ORDER)

    return texts.select("content", "text").mapInArrow(index, ROW)


class IndexFamily:
    """Suffix arrays of one, two, four, ... batches; at most one of each size."""

    def __init__(self, space: Workspace):
        self.space = space
        self.levels: dict[int, DataFrame] = {}

    def insert(self, batch: DataFrame) -> None:
        """Sort a batch into an array and merge it with the levels of its size."""
        array, size = self._sorted(batch), 0
        while size in self.levels:
            array, size = self._merged(self.levels.pop(size), array), size + 1
        self.levels[size] = array

    def matching(self) -> DataFrame:
        """content, position, before, after, whole, open: the rows that repeat as a whole, and those to be compared.

        Levels of different size are merged first, as every suffix has to meet those of all batches.
        """
        while len(self.levels) > 1:
            low, next_one = sorted(self.levels)[:2]
            self.levels[next_one] = self._merged(self.levels.pop(low), self.levels[next_one])
        (level,) = self.levels.values()
        return level.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).mapInArrow(
            _neighbours, "content binary, position long, before int, after int, whole boolean, open boolean")

    def _merged(self, one: DataFrame, other: DataFrame) -> DataFrame:
        merged = self._sorted(one.union(other))
        self.space.drop(one, other)
        return merged

    def _sorted(self, rows: DataFrame) -> DataFrame:
        return self.space.store(rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER))


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted part that share their stretch (whole) or only their suffix (open) with a neighbour.

    The first and the last row, whose neighbours are in other parts, are open.
    """
    previous, held = None, None
    for batch in batches:
        if batch.num_rows:
            if held is not None:
                yield _marked(previous, held, batch.slice(0, 1))
                previous = held.slice(held.num_rows - 1)
            held = batch
    if held is not None:
        yield _marked(previous, held, None)


def _marked(previous: pa.RecordBatch | None, held: pa.RecordBatch, following: pa.RecordBatch | None) -> pa.RecordBatch:
    table = pa.Table.from_batches([b for b in (previous, held, following) if b is not None]).combine_chunks()

    def equal(name: str) -> np.ndarray:
        column = table.column(name).combine_chunks()
        return np.asarray(pc.equal(column.slice(0, len(column) - 1), column.slice(1)))

    head = equal("head")
    same = head & equal("stretch") & equal("before") & equal("after")
    differ = head & ~same
    if previous is None:
        head, same, differ = (np.concatenate(([x], y)) for x, y in ((False, head), (False, same), (True, differ)))
    if following is None:
        head, same, differ = (np.concatenate((y, [x])) for x, y in ((False, head), (False, same), (True, differ)))
    whole, open_ones = same[:-1] | same[1:], differ[:-1] | differ[1:]
    columns = [held.column(c) for c in ("content", "position", "before", "after")]
    out = pa.RecordBatch.from_arrays([*columns, pa.array(whole), pa.array(open_ones)],
                                     names=["content", "position", "before", "after", "whole", "open"])
    return out.filter(pa.array(whole | open_ones))


def repeated_spans(texts: DataFrame, length: int = LENGTH, seed: int = SEED, batches: int = BATCHES, near: int = NEAR,
                   space: Workspace | None = None) -> DataFrame:
    """content, spans array<struct<start, end>> of texts(id, content, text): unsorted spans of repeated strings, by byte.

    Rows of one content are copies of one another; content must identify the text.
    """
    space = space or Workspace(texts.sparkSession, "suffixes")
    found = space.store(suffixes(texts, length, seed))
    family = IndexFamily(space)
    for number in range(batches):
        family.insert(found.where(F.pmod(F.xxhash64("content"), F.lit(batches)) == number))
    space.drop(found)
    rows = space.store(family.matching())
    space.drop(*family.levels.values())

    whole = rows.where("whole").select("content", (F.col("position") - F.col("before")).alias("start"),
                                       (F.col("position") - F.col("after") + length).alias("end"))
    open_ones = space.store(_stretches(texts, rows.where("open").select(*PLACE).distinct(), length))
    start = F.substring("fore", 1, seed)
    scans = []
    for order in (["fore", "back", "content", "position"], [start, "back", "fore", "content", "position"]):
        compare = _compared(length, seed, near)
        scan = space.store(open_ones.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(compare, COMPARED))
        # first and last rows of all parts, two a part, meet their neighbours here
        edges = scan.where("edge").select(*PLACE, "fore", "back").repartition(1).sortWithinPartitions(*order).mapInArrow(compare, COMPARED)
        scans += [scan, edges]
    everything = scans[0].union(scans[1]).union(scans[2]).union(scans[3]).where("NOT whole")
    judged = space.store(everything.groupBy(*PLACE).agg(
        F.max("ahead").alias("ahead"), F.max("behind").alias("behind"),
        F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans")).mapInArrow(_judged(length), JUDGED))
    some = judged.select("content", "position", F.explode("spans").alias("span")).select(
        "content", (F.col("position") - F.col("span.high")).alias("start"), (F.col("position") - F.col("span.low") + length).alias("end"))
    spans = whole.union(some)
    asking = judged.where(F.size("rest") > 0).select(*PLACE, F.col("rest").alias("distances"))
    wanted = space.store(open_ones.withColumn("head", start).join(asking, PLACE))
    if not wanted.isEmpty():
        own = wanted.mapInArrow(_strings(length), STRING)
        bits = hash_bits(own.select("hash").distinct(), each=256)
        asked = wanted.select("head", F.explode("distances").alias("distance")).groupBy("head").agg(F.collect_set("distance").alias("distances"))
        # of all strings of such a suffix only those go on that may be one of the wanted; others that do only cost a row
        strings = space.store(open_ones.withColumn("head", start).join(asked, "head").mapInArrow(_strings(length, bits), STRING))
        twice = strings.groupBy("string").agg(F.count("*").alias("n")).where("n > 1").select("string")
        spans = spans.union(strings.where("NOT whole").join(twice, "string", "left_semi").select(
            "content", "start", (F.col("start") + length).alias("end")))
    return space.store(spans.distinct().groupBy("content").agg(F.collect_list(F.struct("start", "end")).alias("spans")))


def _stretches(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """wanted with the bytes of each stretch from the suffix on and, backwards, before it; read from one text of each content."""
    requests = wanted.groupBy("content").agg(F.collect_list(F.struct("position", "before", "after", "whole")).alias("wanted"))
    named = texts.select("content", "text", F.coalesce(F.col("id").cast("string"), F.lit("")).alias("name"))
    one = named.groupBy("content").agg(F.min("name").alias("name"))
    chosen = named.join(one.join(requests, "content"), ["content", "name"]).select("content", "text", "wanted")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in text_batches(batches):
            out = []
            for content, text, asked in zip(batch.column("content").to_pylist(), found, batch.column("wanted").to_pylist()):
                for x in asked:
                    at, before, after = x["position"], x["before"], x["after"]
                    out.append((content, at, before, after, x["whole"], text[at:at - after + length], text[at - before:at][::-1]))
            kinds = [pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 7, kinds)], names=STRETCH)

    schema = "content binary, position long, before int, after int, whole boolean, fore binary, back binary"
    return chosen.mapInArrow(cut, schema).dropDuplicates(PLACE)     # repeated rows of the table bring a stretch twice


STRETCH = [*PLACE, "fore", "back"]
COMPARED = ("content binary, position long, before int, after int, whole boolean, ahead int, behind int, spans array<long>, "
            "edge boolean, fore binary, back binary")
STRING = "string binary, hash long, content binary, start long, whole boolean"
JUDGED = "content binary, position long, spans array<struct<low: int, high: int>>, rest array<int>, before int, after int, whole boolean"


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings as rows of a matrix, filled up with zeros, and their lengths."""
    sizes = np.asarray(pc.binary_length(column), dtype=np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0)) + 1), dtype=np.uint8)
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8)
    return out, sizes


def _common(strings: tuple[np.ndarray, np.ndarray], step: int) -> np.ndarray:
    """How many bytes each string has in common at its start with the one `step` rows on."""
    matrix, sizes = strings
    unequal = matrix[:-step] != matrix[step:]
    first = np.where(unequal.any(axis=1), unequal.argmax(axis=1), matrix.shape[1])
    return np.minimum(first, np.minimum(sizes[:-step], sizes[step:]))


def _compared(length: int, seed: int, near: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted stretches compared with their next neighbours: longest agreement ahead and behind, and strings found again.

    Strings are named by how far before the suffix they start, spans as low * 2**32 + high. A stretch may come out in several
    rows. The first and last ones of a part come out once more with their bytes (edge).
    """
    def partial(rows: pa.RecordBatch) -> pa.RecordBatch:
        fore, back = _matrix(rows.column("fore")), _matrix(rows.column("back"))
        before, after = (rows.column(c).to_numpy() for c in ("before", "after"))
        n = rows.num_rows
        ahead, behind = np.zeros(n, dtype=np.int32), np.full(n, -1, dtype=np.int32)
        spans = np.full((n, 2 * near), -1, dtype=np.int64)
        for step in range(1, min(near, n - 1) + 1):
            lead, trail = _common(fore, step), _common(back, step)
            one = lead >= seed      # the same suffix
            for at, rows_of in ((2 * step - 2, slice(None, -step)), (2 * step - 1, slice(step, None))):
                low, high = np.maximum(after[rows_of], length - lead), np.minimum(before[rows_of], trail)
                spans[rows_of, at] = np.where(one & (low <= high), (low.astype(np.int64) << 32) + high, -1)
                ahead[rows_of] = np.maximum(ahead[rows_of], np.where(one, lead, 0))
                behind[rows_of] = np.maximum(behind[rows_of], np.where(one, trail, -1))
        spans.sort(axis=1)
        keep = spans >= 0
        keep[:, 1:] &= spans[:, 1:] != spans[:, :-1]
        offsets = np.concatenate(([0], np.cumsum(keep.sum(axis=1)))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(spans[keep]))
        return _rows(rows, pa.array(ahead), pa.array(behind), lists, False)

    def _rows(rows: pa.RecordBatch, ahead: pa.Array, behind: pa.Array, spans: pa.Array, edge: bool) -> pa.RecordBatch:
        n = rows.num_rows
        bytes_of = [rows.column(c) if edge else pa.nulls(n, pa.binary()) for c in ("fore", "back")]
        return pa.RecordBatch.from_arrays(
            [*(rows.column(c) for c in PLACE), ahead, behind, spans, pa.array([edge] * n, pa.bool_()), *bytes_of],
            names=[*PLACE, "ahead", "behind", "spans", "edge", "fore", "back"])

    def at_edge(row: pa.RecordBatch) -> pa.RecordBatch:
        return _rows(row, pa.array([0], pa.int32()), pa.array([-1], pa.int32()), pa.array([[]], pa.list_(pa.int64())), True)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = None
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = batch.select(STRETCH)
            if carried is None:
                yield at_edge(batch.slice(0, 1))
                rows = batch
            else:
                rows = pa.Table.from_batches([carried, batch]).combine_chunks().to_batches()[0]
            yield partial(rows)
            carried = rows.slice(max(0, rows.num_rows - near))
        if carried is not None:
            yield at_edge(carried.slice(carried.num_rows - 1))

    return compare


def _judged(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The union of each stretch's spans, and the strings within its bounds that are in none."""
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ("before", "after", "ahead", "behind", "spans")
            spans, rest = [], []
            for before, after, ahead, behind, packed in zip(*(batch.column(c).to_pylist() for c in names)):
                at, end = max(after, length - ahead), min(before, behind)
                merged, left = [], []
                for low, high in sorted((x >> 32, x & 0xFFFFFFFF) for x in packed):
                    left += range(at, min(low, end + 1))
                    at = max(at, high + 1)
                    if merged and low <= merged[-1]["high"] + 1:
                        merged[-1]["high"] = max(merged[-1]["high"], high)
                    else:
                        merged.append({"low": low, "high": high})
                spans.append(merged)
                rest.append(left + list(range(at, end + 1)))
            kinds = [pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())])), pa.list_(pa.int32())]
            columns = [batch.column("content"), batch.column("position"), *(pa.array(c, k) for c, k in zip((spans, rest), kinds)),
                       *(batch.column(c) for c in ("before", "after", "whole"))]
            yield pa.RecordBatch.from_arrays(columns, names=["content", "position", "spans", "rest", "before", "after", "whole"])

    return judge


def _strings(length: int, bits: Broadcast | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The strings of each stretch that start at one of the asked distances before the suffix; given bits, only those it holds."""
    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None if bits is None else HashBits(bits.value)
        for batch in batches:
            out = []
            names = ("content", "position", "before", "after", "whole", "fore", "back", "distances")
            for content, position, before, after, whole, fore, back, distances in zip(*(batch.column(c).to_pylist() for c in names)):
                data = back[::-1] + fore
                for distance in distances:
                    if after <= distance <= before:
                        string = hashlib.blake2b(data[before - distance:before - distance + length], digest_size=16).digest()
                        code = int.from_bytes(string[:8], "little", signed=True)
                        if held is None or held.has(code):
                            out.append((string, code, content, position - distance, whole))
            kinds = [pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 5, kinds)],
                                             names=["string", "hash", "content", "start", "whole"])

    return strings


def without_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED, batches: int = BATCHES, near: int = NEAR,
                    with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the bytes left, if asked for) of docs(doc_id, text).

    Every byte covered by a string of `length` bytes that also starts anywhere else, in the same text too, is removed; what
    repeats is judged on the input. Null and empty texts have no bytes. Repeated rows are copies of one another, so all of
    a copied text of `length` bytes goes in all of them. No other column is read; an empty table gives no rows.
    """
    space = Workspace(docs.sparkSession, "suffixes")
    content = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    texts = docs.select(F.col("doc_id").alias("id"), content.alias("content"), F.coalesce("text", F.lit("")).alias("text"))
    spans = repeated_spans(texts.where(F.octet_length("text") >= length), length, seed, batches, near, space)
    joined = texts.join(spans, "content", "left")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def remove(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data in text_batches(found):
            out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
            for text, spans in zip(data, batch.column("spans").to_pylist()):
                kept, count = _cut(text, spans or [])
                out["n_bytes"].append(len(text))
                out["n_removed"].append(len(text) - len(kept))
                out["n_spans"].append(count)
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["kept"].append(kept if with_text else None)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            arrays = [batch.column("id"), *(pa.array(v, k) for v, k in zip(out.values(), kinds))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *out])

    result = joined.select("id", "text", "spans").mapInArrow(
        remove, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return result if with_text else result.drop("kept")


def _cut(text: bytes, spans: list[dict]) -> tuple[bytes, int]:
    """The text without the union of the spans, and how many runs that union has; spans that touch are one run."""
    kept, at, count = [], 0, 0
    end = -1
    for start, stop in sorted((s["start"], s["end"]) for s in spans):
        if start > end:
            count += 1
            kept.append(text[at:start])
        end = max(end, stop)
        at = end
    kept.append(text[at:])
    return b"".join(kept), count
