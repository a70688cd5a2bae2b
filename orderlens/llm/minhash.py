"""Near-duplicates: minima of many universal hashes, bands, verified signatures, full sets, components by two star operations.

1. A document's shingles are hashed; HASHES minima of affine hashes are its signature, cut into bands. Texts with the same
   words are one node (the smallest doc_id), so groups of exact copies cost one row each.
2. Documents that share a band share a bucket. One whose shingles are too often found in no other candidate cannot reach the
   threshold with any of them and leaves (in a family of edited copies, all that were edited much). A bucket is not turned
   into all its pairs: each round takes a few pivots for a bucket, the same ones in every bucket of a group, as the order is
   global: first those with most company, which are the originals of a family. The other members are compared with them,
   unless both are in one component already. Estimates from signatures drop pairs that are far off (five deviations below
   the threshold): first inside the bucket join, by the low eight bits of every minimum and of as many further ones, which
   only candidates get; these bits agree wherever the minima do. Then by the whole minima. The rest is confirmed on the full sets.
3. Links go into alternating large-star and small-star steps. Pivots have met everyone in their bucket and leave it. Rounds
   go on, with eight times the pivots each, until every bucket's members are in one component: no link is lost, and groups
   of near copies end after a round or two. Only families of similar texts below the threshold cost more rounds.

With 32 bands of 6 rows a pair of similarity 0.85 is missed with probability 3e-7, one of 0.8 with 6e-5.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import PrimeHash, Workspace, mixed, text_batches

BANDS, ROWS = 32, 6
WORDS = 5
FIRST_PIVOTS = 4
#: A member of a bucket: with the number of its shingles that other candidates have too, of its fellow members in all buckets,
#: 32 bits of each of its bands, and the low bytes of its minima and of the further ones, eight to a number.
ENTRY = ["bucket", "doc_id", "n_shingles", "common", "company", "marks", "brief"]

_HASHES = PrimeHash()


def shingles(text: bytes, words: int = WORDS) -> tuple[bytes, np.ndarray]:
    """The lower-cased words joined by single spaces, and the sorted distinct 64-bit hashes of their shingles."""
    tokens = text.lower().split()
    joined = b" ".join(tokens)
    if not tokens:
        return joined, np.empty(0, dtype=np.uint64)
    data = np.frombuffer(joined, dtype=np.uint8)
    spaces = np.flatnonzero(data == 32)
    starts, ends = np.concatenate(([0], spaces + 1)), np.append(spaces, len(data))
    n = max(1, len(tokens) - words + 1)
    return joined, np.unique(_HASHES.ranges(data, starts[:n], ends[len(ends) - n:]))


def signature(shingle_hashes: np.ndarray, slopes: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """The minimum of each hash x -> slope * x + shift (modulo 2**32) over the set, in blocks."""
    low = (shingle_hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    best = np.full(len(slopes), 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(low), 1024):
        values = slopes[:, None] * low[None, at:at + 1024]
        values += shifts[:, None]
        np.minimum(best, values.min(axis=1), out=best)
    return best


def _affine(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(seed)
    return (random.integers(0, 2**31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1),
            random.integers(0, 2**32, count, dtype=np.uint32))


def _low_bytes(sigs: np.ndarray) -> pa.Array:
    """The low byte of every minimum, eight to a number, filled up with zeros."""
    brief = np.zeros((len(sigs), -(-sigs.shape[1] // 8) * 8), dtype=np.uint8)
    brief[:, :sigs.shape[1]] = sigs & np.uint32(255)
    return _lists(brief.view(np.int64))


def signatures(docs: DataFrame, words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, content (16 bytes, the same for texts of the same words), n_shingles, sig array<int>, bands and brief array<long>."""
    schema = "doc_id long, content binary, n_shingles long, sig array<int>, bands array<long>, brief array<long>"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slopes, shifts = _affine(bands * rows, 7)
        for batch, texts in text_batches(batches):
            content, sizes, sigs = [], [], np.full((len(texts), bands * rows), 0, dtype=np.uint32)
            for row, text in enumerate(texts):
                joined, hashes = shingles(text, words)
                content.append(hashlib.blake2b(joined, digest_size=16).digest())
                sizes.append(len(hashes))
                if len(hashes):
                    sigs[row] = signature(hashes, slopes, shifts)
            keys = np.empty((len(texts), bands), dtype=np.uint64)
            cut = sigs.reshape(len(texts), bands, rows).astype(np.uint64)
            keys[:] = np.arange(1, bands + 1, dtype=np.uint64)
            for column in range(rows):
                keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + cut[:, :, column])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(content, pa.binary()), pa.array(sizes, pa.int64()),
                _lists(sigs.view(np.int32)), _lists(keys.view(np.int64)), _low_bytes(sigs)],
                names=["doc_id", "content", "n_shingles", "sig", "bands", "brief"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(sign, schema)


def _lists(matrix: np.ndarray) -> pa.Array:
    rows, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (rows + 1) * width, width, dtype=np.int32)), pa.array(matrix.ravel()))


def _unequal_bytes(left: str, right: str) -> Column:
    """The number of bytes that differ between two columns of array<long>."""
    def differ(a: Column, b: Column) -> Column:
        bits = a.bitwiseXOR(b)
        for step in (4, 2, 1):
            bits = bits.bitwiseOR(F.shiftrightunsigned(bits, step))
        return F.bit_count(bits.bitwiseAND(F.lit(0x0101010101010101)))
    return F.aggregate(F.zip_with(left, right, differ), F.lit(0), lambda total, n: total + n)


def shingle_sets(docs: DataFrame, words: int = WORDS, further: int = BANDS * ROWS) -> DataFrame:
    """doc_id, content, shingles array<long> (the full sets), more array<long> (low bytes of further minima)."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slopes, shifts = _affine(further, 8)
        for batch, texts in text_batches(batches):
            both = [shingles(text, words) for text in texts]
            content = [hashlib.blake2b(joined, digest_size=16).digest() for joined, _ in both]
            sets = [hashes for _, hashes in both]
            offsets = np.zeros(len(sets) + 1, dtype=np.int32)
            np.cumsum([len(x) for x in sets], out=offsets[1:])
            flat = np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)
            sigs = np.zeros((len(sets), further), dtype=np.uint32)
            for row, hashes in enumerate(sets):
                if len(hashes):
                    sigs[row] = signature(hashes, slopes, shifts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(content, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                 _low_bytes(sigs)], names=["doc_id", "content", "shingles", "more"])

    return docs.select("doc_id", "text").mapInArrow(take, "doc_id long, content binary, shingles array<long>, more array<long>")


def components(space: Workspace, links: DataFrame) -> DataFrame:
    """node, component (the smallest node that links reach) for every node of links(a, b).

    Large-star: every neighbour above a node goes to the smallest of its neighbourhood. Small-star: every neighbour below it
    does, and so does the node. Alternated until the set of links stands still; each step is an aggregate with partial sums
    and a join, and is written to the shared folder.
    """
    def state(edges: DataFrame) -> tuple:
        return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()

    edges = space.store(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    before = state(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.explode(F.array(F.col("b"), F.col("a"))).alias("a"), F.col("m").alias("b"))
        after_edges = space.store(small.where("a <> b").distinct())
        after = state(after_edges)
        space.drop(edges)
        edges = after_edges
        if after == before:
            break
        before = after
    return edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.col("m").alias("component")).union(
        edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component")))


def near_duplicates(docs: DataFrame, percent: int = 85, words: int = WORDS, bands: int = BANDS, rows: int = ROWS,
                    first_pivots: int = FIRST_PIVOTS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs(doc_id, text); other columns are not read.

    Two documents are linked if 100 * intersection >= percent * union of their shingle sets. Null and empty texts have no
    shingles and are alone; so are rows without doc_id, whose component_id is null and which are kept. Repeated rows come
    back as often as they came in; of rows that share a doc_id but not their words, the one with the least content hash
    stands for the document. An empty table gives an empty table.
    """
    space = Workspace(docs.sparkSession, "minhash")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = space.store(signatures(docs, words, bands, rows))
    members = space.store(signed.select("doc_id", "content", "n_shingles"))
    whole = space.store(members.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("content").alias("content")))
    nodes = space.store(whole.groupBy("content").agg(F.min("doc_id").alias("node")))
    signed_nodes = space.store(signed.join(nodes.withColumnRenamed("node", "doc_id"), ["content", "doc_id"], "left_semi")
                               .dropDuplicates(["content", "doc_id"]))
    space.drop(signed)

    entries = signed_nodes.select(F.explode("bands").alias("bucket"), "doc_id", "n_shingles")
    crowded = entries.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    shared_buckets = space.store(entries.join(crowded, "bucket"))
    company = space.store(shared_buckets.groupBy("doc_id").agg(F.sum("n").alias("company")))
    candidates = signed_nodes.select("doc_id", "content").join(company, "doc_id", "left_semi")
    sets = space.store(shingle_sets(docs.join(candidates, "doc_id", "left_semi"), words, bands * rows).join(
        candidates, ["doc_id", "content"], "left_semi").dropDuplicates(["doc_id"]).select("doc_id", "shingles", "more"))
    signs = signed_nodes.select("doc_id", F.col("n_shingles").alias("n"), "sig")
    floor, wide_floor = (int(n * max(0.0, percent / 100 - 5 * (percent / 100 * (1 - percent / 100) / n) ** 0.5)) for n in (bands * rows, 2 * bands * rows))

    # shingles that no other candidate has; what is left must make up the threshold
    alone = sets.select("doc_id", F.explode("shingles").alias("shingle")).groupBy("shingle").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("doc_id")).where("n = 1").groupBy("doc_id").agg(F.count("*").alias("alone"))
    marks = signed_nodes.select("doc_id", F.transform("bands", lambda b: F.shiftright(b, 32).cast("int")).alias("marks"), "brief").join(
        sets.select("doc_id", "more"), "doc_id").select("doc_id", "marks", F.concat("brief", "more").alias("brief"))
    able = company.join(alone, "doc_id", "left").withColumn("alone", F.coalesce("alone", F.lit(0))).join(marks, "doc_id")
    members_left = shared_buckets.drop("n").join(able, "doc_id").withColumn("common", F.col("n_shingles") - F.col("alone"))
    buckets = space.store(members_left.where(100 * F.col("common") >= percent * F.col("n_shingles")).select(*ENTRY))
    space.drop(shared_buckets)
    links, component, pivots = None, None, first_pivots
    while not buckets.isEmpty():
        labelled = space.store(_labelled(buckets, component))
        open_ones = labelled.groupBy("bucket").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.min("n_shingles").alias("least")).where("low < high")
        # a member shares `common` shingles at most, and every other member has at least `least`
        able = (F.col("least") < F.col("common")) | (100 * F.col("common") >= percent * (F.col("n_shingles") + F.col("least") - F.col("common")))
        active = labelled.join(open_ones.select("bucket", "least"), "bucket").where(able).drop("least")
        order = F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("company"), "doc_id"))
        chosen = space.store(active.withColumn("rank", order).where(F.col("rank") <= pivots).drop("rank"))
        left, right = active.alias("x"), chosen.alias("p")
        most = F.least("x.common", "p.common")
        # a pair comes from the first band that it shares
        first = F.array_position(F.zip_with("x.marks", "p.marks", lambda a, b: a == b), True)
        mark = F.shiftright("x.bucket", 32).cast("int")
        pairs = left.join(right, F.col("x.bucket") == F.col("p.bucket")).where(
            (F.col("x.component") != F.col("p.component")) & (F.col("x.doc_id") != F.col("p.doc_id"))
            & (100 * most >= percent * (F.col("x.n_shingles") + F.col("p.n_shingles") - most))
            & (F.element_at("x.marks", first.cast("int")) == mark)
            & (_unequal_bytes("x.brief", "p.brief") <= 2 * bands * rows - wide_floor)
        ).select(F.least("x.doc_id", "p.doc_id").alias("a"), F.greatest("x.doc_id", "p.doc_id").alias("b")).distinct()
        pairs = space.store(pairs)
        rest = space.store(active.select(*ENTRY).join(chosen.select("bucket", "doc_id"), ["bucket", "doc_id"], "left_anti"))
        space.drop(buckets, labelled, chosen)
        buckets, pivots = rest, pivots * 8
        if pairs.isEmpty():
            continue
        close = pairs.join(signs.select(F.col("doc_id").alias("a"), F.col("sig").alias("sig_a"), F.col("n").alias("n_a")), "a").join(
            signs.select(F.col("doc_id").alias("b"), F.col("sig").alias("sig_b"), F.col("n").alias("n_b")), "b").where(
            F.aggregate(F.zip_with("sig_a", "sig_b", lambda p, q: (p == q).cast("int")), F.lit(0), lambda s, x: s + x) >= floor)
        shared = F.size(F.array_intersect("set_a", "set_b"))
        linked = close.select("a", "b", "n_a", "n_b").join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a")), "a").join(
            sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b")), "b").where(
            100 * shared >= percent * (F.col("n_a") + F.col("n_b") - shared)).select("a", "b")
        found = space.store(linked)
        links = links.union(found) if links else found
        space.drop(pairs)
        if not found.isEmpty():
            component = components(space, links)
    placed = _labelled(whole.join(nodes, "content").select("doc_id", "node"), component, "node").select(
        "doc_id", F.col("component").alias("component_id"))
    space.drop(signed_nodes, sets)
    out = members.join(placed, "doc_id", "left")
    component_id = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component_id.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component_id, F.lit(True)).alias("kept"))


def _labelled(rows: DataFrame, component: DataFrame | None, by: str = "doc_id") -> DataFrame:
    """rows with a column component: that of the node in column by, itself where it has no link."""
    if component is None:
        return rows.withColumn("component", F.col(by))
    nodes = component.withColumnRenamed("node", by)
    return rows.join(nodes, by, "left").withColumn("component", F.coalesce("component", by))
