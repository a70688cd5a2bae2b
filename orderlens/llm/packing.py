"""Packing documents into sequences of a fixed number of tokens by swap-based local search.

Documents are tokenised once into pieces. Full pieces are sequences already; the others are dealt out evenly into groups
of bounded size (by row number, so that no key matters). In its group, each piece goes into the fullest bin that takes it,
largest first; then the local search exchanges pieces between underfull bins. A move is taken if it adds to the sum of
squared fills, so the emptiest bins pour into the fuller ones until one is empty. The bins that stay most open are
dissolved and their pieces meet those of other groups, over fewer and fewer groups, until one is left.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, text_batches
from .tokens import JsonTokenizer, public_path, shipped

SEQUENCE = 2048
GROUP_PIECES = 20_000
#: Open bins that a group hands on, and the largest share of its pieces in them.
HANDED_BINS, HANDED_SHARE = 16, 0.125

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids of docs(doc_id, text).

    A document is its ids and id 0; only longer ones than `sequence` are cut, so that all pieces but the first are full.
    Null and empty texts are one piece of id 0. Repeated rows are documents of their own.
    """
    file = shipped(docs.sparkSession, tokenizer_path)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = JsonTokenizer(file.value)
        for batch, texts in text_batches(batches):
            rows, ids_out = [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                ids = np.array([*tokenizer.ids(text.decode()), 0], dtype="<u4")
                first = len(ids) % sequence or sequence
                edges = [0, *range(first, len(ids) + 1, sequence)]
                for number, (start, end) in enumerate(zip(edges, edges[1:])):
                    rows.append((doc_id, number, start, end - start, zlib.crc32(ids[start:end].tobytes())))
                    if with_ids:
                        ids_out.append(ids[start:end].astype(np.int32))
            columns = list(zip(*rows)) if rows else [[]] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays, names = [pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays, names = [*arrays, pa.array(ids_out, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return chosen.mapInArrow(cut, PIECE + (", ids array<int>" if with_ids else ""))


class Bins:
    """Bins of pieces (by number) of one group."""

    def __init__(self, lengths: np.ndarray, size: int):
        self.lengths, self.size = lengths, size
        self.bins: list[list[int]] = []
        self.fills: list[int] = []

    def best_fit(self) -> None:
        gaps: list[int] = []           # sorted gaps of open bins
        by_gap: dict[int, list[int]] = {}
        for piece in np.argsort(-self.lengths, kind="stable"):
            length = int(self.lengths[piece])
            at = bisect.bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                number = by_gap[gap].pop()
                if not by_gap[gap]:
                    del by_gap[gap], gaps[at]
            else:
                number, gap = len(self.bins), self.size
                self.bins.append([])
                self.fills.append(0)
            self.bins[number].append(int(piece))
            self.fills[number] += length
            gap -= length
            if gap:
                if gap not in by_gap:
                    by_gap[gap] = []
                    bisect.insort(gaps, gap)
                by_gap[gap].append(number)

    def search(self) -> None:
        """Empty bins while there may be one too many."""
        least = -(-int(self.lengths.sum()) // self.size)
        while len(self.bins) > least:
            source = min(range(len(self.bins)), key=lambda b: (self.fills[b], b))
            if not self._pour(source):
                return
            del self.bins[source], self.fills[source]

    def _pour(self, source: int) -> bool:
        """Exchange pieces of the source with other underfull bins, the largest gain first, until it is empty or stuck."""
        while self.bins[source]:
            own = np.array(self.bins[source])
            size = self.lengths[own]
            open_bins = [b for b, fill in enumerate(self.fills) if fill < self.size and b != source]
            if not open_bins:
                return False
            gap = np.array([self.size - self.fills[b] for b in open_bins])
            best = (0, None)
            # move: one piece for nothing
            best = self._better(best, size, [(int(p),) for p in own], np.zeros(len(gap), int), gap, [(b, ()) for b in open_bins])
            theirs = [(b, p, self.size - self.fills[b]) for b in open_bins for p in self.bins[b]]
            other, room = self.lengths[[p for _, p, _ in theirs]], np.array([g for _, _, g in theirs])
            named = [(b, (p,)) for b, p, _ in theirs]
            best = self._better(best, size, [(int(p),) for p in own], other, room, named)      # one for one
            if len(own) > 1:                                                                   # two of ours for one
                i, j = np.triu_indices(min(len(own), 64), 1)
                best = self._better(best, size[i] + size[j], [(int(own[a]), int(own[b])) for a, b in zip(i, j)], other, room, named)
            pairs = [(b, p, q, self.size - self.fills[b]) for b in open_bins if 1 < len(self.bins[b]) <= 8
                     for k, p in enumerate(self.bins[b]) for q in self.bins[b][k + 1:]]
            if pairs:                                                                          # one of ours for two
                both = self.lengths[[p for _, p, _, _ in pairs]] + self.lengths[[q for _, _, q, _ in pairs]]
                best = self._better(best, size, [(int(p),) for p in own], both, np.array([g for *_, g in pairs]), [(b, (p, q)) for b, p, q, _ in pairs])
            if not best[0]:
                return False
            _, (ours, (target, theirs_out)) = best
            self.bins[source] = [p for p in self.bins[source] if p not in ours] + list(theirs_out)
            self.bins[target] = [p for p in self.bins[target] if p not in theirs_out] + list(ours)
            for b in (source, target):
                self.fills[b] = int(self.lengths[self.bins[b]].sum()) if self.bins[b] else 0
            if self.fills[source] >= max(self.fills[target], self.size):
                return False
        return True

    @staticmethod
    def _better(best, size, ours, other, room, named):
        """The exchange that moves most into another bin: size - other positive and at most its room."""
        order = np.argsort(size, kind="stable")
        at = np.searchsorted(size[order], other + room, side="right") - 1
        gain = np.where(at >= 0, size[order][np.maximum(at, 0)] - other, 0)
        k = int(np.argmax(gain)) if len(gain) else 0
        if len(gain) and gain[k] > best[0]:
            return int(gain[k]), (ours[order[at[k]]], named[k])
        return best

    def handed_on(self) -> set[int]:
        """The emptiest bins, few enough that the pieces left shrink from level to level."""
        out, count = set(), 0
        for b in sorted(range(len(self.bins)), key=lambda b: (self.fills[b], b)):
            count += len(self.bins[b])
            if len(out) == HANDED_BINS or self.fills[b] == self.size or count > HANDED_SHARE * len(self.lengths):
                break
            out.add(b)
        return out


def pack(table: DataFrame, sequence: int = SEQUENCE, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """The rows of table(length, ...) with sequence_id and offset; pieces longer than `sequence` are an error of the caller."""
    space = Workspace(table.sparkSession, "packing")
    table = space.store(table.withColumn("rid", F.monotonically_increasing_id()))
    kept = [c for c in table.columns if c != "rid"]
    done = [table.where(F.col("length") >= sequence).withColumns({"sequence_id": F.col("rid"), "offset": F.lit(0).cast("long")}).select(*kept, "sequence_id", "offset")]
    rest, level = table.where(F.col("length") < sequence), 1
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema) + ", sequence_id long, offset long, open boolean"
    while True:
        groups = max(1, -(-rest.count() // group_pieces))

        dealt = rest.withColumn("group", F.pmod(F.xxhash64("rid", F.lit(level)), F.lit(groups)))
        packed = space.store(dealt.groupBy("group").applyInPandas(_arranged(sequence, level, groups == 1), schema))
        done.append(packed.where("NOT open").select(*kept, "sequence_id", "offset"))
        if groups == 1:
            break
        rest, level = packed.where("open").select(*kept, "rid"), level + 1
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    return out


def _arranged(sequence: int, level: int, last: bool):
    """A function that packs the pieces of one group; at the last level nothing is handed on."""

    def arrange(frame):
        frame = frame.sort_values("rid", ignore_index=True)
        bins = Bins(frame["length"].to_numpy(), sequence)
        bins.best_fit()
        bins.search()
        handed = set() if last else bins.handed_on()
        number, offset, still = (np.zeros(len(frame), kind) for kind in (np.int64, np.int64, bool))
        first = (level << 56) + (int(frame["group"].iloc[0]) << 20)
        for b, held in enumerate(bins.bins):
            at = np.concatenate(([0], np.cumsum(bins.lengths[held])[:-1]))
            number[held], offset[held], still[held] = first + b, at, b in handed
        return frame.drop(columns="group").assign(sequence_id=number, offset=offset, open=still)

    return arrange


def packed_documents(docs: DataFrame, tokenizer_path: str | None = None, sequence: int = SEQUENCE, group_pieces: int = GROUP_PIECES,
                     with_ids: bool = False) -> DataFrame:
    """One row per piece of docs(doc_id, text) with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    No other column is read. An empty table gives no rows; rows without doc_id are packed like the others.
    """
    return pack(pieces(docs, tokenizer_path or public_path("byte_bpe_50k.json"), sequence, with_ids), sequence, group_pieces)
