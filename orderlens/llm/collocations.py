"""Phrase collocation mining: phrases whose words meet more often than their parts' counts suggest, per language.

Counting is done by HAT-tries. A task numbers the words it meets; its trie has one subtree for each language
and first word (one for all single words of a language). A subtree is a hash container from the rest of a phrase to its
count, and bursts into containers by second word when it grows past `BURST` phrases. When a task's trie holds more than
`TRIE_PHRASES`, its largest subtrees are spilled whole, as sorted runs, until half of that is left. Runs are dealt out by
prefix (language and first two words), and each partition merges the runs of its own prefixes; equal phrases meet as one
row per run. No task holds all phrases of a word or of a language.

A phrase occurs at most as often as its parts, so pairs are only counted of words that occur `least` times, and triples only of
such pairs. Words come first; then tasks send 64-bit hashes of the pairs of frequent words, with counts, and then those of triples of
two frequent pairs; pairs and triples whose hash occurs `least` times are counted in full. Tasks know what is frequent from bitmaps of
hashes, which are broadcast: at most 2^28 bits each, whatever the size of the corpus. A hash that collides lets a phrase be counted
that could be left out, and changes no result.

What counts (n: all words; f: all contiguous occurrences within a piece, overlaps included) covers every text in full. Texts
are read in blocks, and the last two words go over into the next block, so a very long text costs no more memory than a short one.

A candidate has 2 or 3 words and a = f >= `least`. Its score is floor(10^6 a a / (l r)) for the cut into a first part (f = l) and a
rest (f = r) that scores lowest, ties to the shorter first part; in decimals of 38 digits, exact for counts up to 10^16. Candidates
inside a longer candidate with at least `share` percent of their occurrences are dropped. The best `first` of each language
are found by rounds: in each, the best of every group stay and sixteen groups become one.

Cases: a null language is `und`, a null or empty text has no words. Repeated rows count each time. Ties in rank go by
occurrences, then by the phrase's bytes. An empty table gives an empty result. Only `lang` and `text` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import HashBits, Workspace, hash_bits, mixed, text_batches

#: A subtree's hash container bursts at so many phrases, and a task's trie spills at so many.
BURST, TRIE_PHRASES = 4096, 600_000
#: A task's word numbers start again, after spilling all, at so many words; a number has BITS bits in a phrase's key.
TRIE_WORDS, BITS = 400_000, 21
#: Bytes of text that are cut into words at once.
BLOCK = 1 << 20
UNDETERMINED = "und"
#: Lower case for A-Z; line breaks for what ends a piece; blanks for tabs.
_FOLDED = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")
_GROUPS_IN_ONE = 16


class Frequent(HashBits):
    """Which words or pairs may be frequent: a bitmap by hash."""

    def has_word(self, word: bytes) -> int:
        return self.has(xxhash.xxh64_intdigest(word, 42))


def pair_hashes(lang: str, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Of pairs of words, from the words' hashes."""
    start = np.uint64(xxhash.xxh64_intdigest(lang, 7))
    return mixed((start ^ first) * np.uint64(0x9E3779B97F4A7C15) + second)


def triple_hashes(lang: str, first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
    return mixed(pair_hashes(lang, first, second) * np.uint64(0x9E3779B97F4A7C15) + third)


class WordNumbers(dict):
    """Numbers of words as they come; 0 ends a piece, as do words that cannot be in a frequent phrase."""

    def __init__(self, frequent: Frequent | None = None):
        super().__init__({b"\n": 0})
        self.words, self.frequent, self.hashes = [b""], frequent, np.zeros(1, dtype=np.uint64)

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.words) if self.frequent is None or self.frequent.has_word(word) else 0
        if number:
            self.words.append(word)
        return number

    def hashes_of(self, numbers: np.ndarray) -> np.ndarray:
        if new := self.words[len(self.hashes):]:
            self.hashes = np.append(self.hashes, np.array([xxhash.xxh64_intdigest(w, 42) for w in new], dtype=np.uint64))
        return self.hashes[numbers]


class Subtree:
    """Phrases of one first word: a hash container of their rests, or, once burst, one such container per second word."""

    __slots__ = ("rests", "children", "size")

    def __init__(self):
        self.rests: dict[int, int] = {}
        self.children: dict[int, dict[int, int]] | None = None
        self.size = 0

    def add(self, rests: list[int], counts: list[int], burst: int) -> int:
        """Returns how many phrases are new."""
        before = self.size
        if self.children is None:
            held = self.rests
            for rest, count in zip(rests, counts):
                held[rest] = held.get(rest, 0) + count
            self.size = len(held)
            if self.size > burst:
                self.children, self.rests = {}, {}
                self._into_children(held.keys(), held.values())
        else:
            self.size += self._into_children(rests, counts)
        return self.size - before

    def _into_children(self, rests, counts) -> int:
        children, low, new = self.children, (1 << BITS) - 1, 0
        for rest, count in zip(rests, counts):
            second = rest >> BITS
            child = children.get(second)
            if child is None:
                child = children[second] = {}
            third = rest & low
            if third in child:
                child[third] += count
            else:
                child[third] = count
                new += 1
        return new

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """Rests and counts."""
        if self.children is None:
            return (np.fromiter(x, dtype=np.int64, count=self.size) for x in (self.rests.keys(), self.rests.values()))
        rests = [np.fromiter(c, dtype=np.int64, count=len(c)) | second << BITS for second, c in self.children.items()]
        counts = [np.fromiter(c.values(), dtype=np.int64, count=len(c)) for c in self.children.values()]
        return np.concatenate(rests), np.concatenate(counts)


class HatTrie:
    """A task's phrase counts, with subtrees by language and first word."""

    def __init__(self, frequent: Frequent | None = None, burst: int = BURST, most_phrases: int = TRIE_PHRASES, most_words: int = TRIE_WORDS):
        self.frequent, self.burst, self.most_phrases, self.most_words = frequent, burst, most_phrases, most_words
        self._clear()

    def _clear(self) -> None:
        self.numbers, self.subtrees, self.size = WordNumbers(self.frequent), {}, 0

    def add(self, lang: str, keys: np.ndarray, counts: np.ndarray) -> None:
        """Sorted, distinct phrase keys and their counts."""
        firsts = keys >> (2 * BITS)
        rests, counts = (keys & ((1 << 2 * BITS) - 1)).tolist(), counts.tolist()
        starts = np.flatnonzero(np.diff(firsts, prepend=-1)).tolist()
        for start, end, first in zip(starts, [*starts[1:], len(keys)], firsts[starts].tolist()):
            subtree = self.subtrees.get((lang, first))
            if subtree is None:
                subtree = self.subtrees[lang, first] = Subtree()
            self.size += subtree.add(rests[start:end], counts[start:end], self.burst)

    def runs(self) -> Iterator[pa.RecordBatch]:
        """What has to be spilled by now."""
        if len(self.numbers) > self.most_words:
            yield from self.all()
        elif self.size > self.most_phrases:
            largest, spilled = sorted(self.subtrees, key=lambda k: -self.subtrees[k].size), []
            for key in largest:
                if self.size <= self.most_phrases // 2:
                    break
                spilled.append((key, self.subtrees.pop(key)))
                self.size -= spilled[-1][1].size
            yield self._sorted_run(spilled)

    def all(self) -> Iterator[pa.RecordBatch]:
        if self.subtrees:
            yield self._sorted_run(list(self.subtrees.items()))
        self._clear()

    def _sorted_run(self, subtrees: list[tuple[tuple[str, int], Subtree]]) -> pa.RecordBatch:
        """Rows (lang, w1, w2, w3, f) in the order of their words' bytes; words that a phrase lacks are empty."""
        langs = sorted({lang for (lang, _), _ in subtrees}, key=str.encode)
        parts = [(langs.index(lang), first, *subtree.items()) for (lang, first), subtree in subtrees]
        sizes = [len(p[2]) for p in parts]
        lang, first = (np.repeat([p[k] for p in parts], sizes) for k in (0, 1))
        rest, counts = (np.concatenate([p[k] for p in parts]) for k in (2, 3))
        phrase = np.stack([np.where(first > 0, first, rest), rest >> BITS, np.where(first > 0, rest & ((1 << BITS) - 1), 0)])
        used, places = np.unique(phrase, return_inverse=True)
        words = [self.numbers.words[i] for i in used.tolist()]
        ranked = sorted(range(len(words)), key=words.__getitem__)
        rank = np.empty(len(words), dtype=np.int64)
        rank[ranked] = np.arange(len(words))
        places = rank[places.reshape(phrase.shape)]
        order = np.lexsort((places[2], places[1], places[0], lang))
        table = pa.array([words[i] for i in ranked], pa.binary()).cast(pa.string())
        columns = [pa.array(langs, pa.string()).take(pa.array(lang[order]))]
        columns += [table.take(pa.array(place[order])) for place in places]
        return pa.RecordBatch.from_arrays([*columns, pa.array(counts[order])], names=["lang", "w1", "w2", "w3", "f"])


def blocks(text: bytes, size: int = BLOCK) -> Iterator[bytes]:
    """The text in blocks that end where a word ends."""
    start = 0
    while start < len(text):
        end = start + size
        while end < len(text) and text[end] not in b" \n":
            end += 1
        yield text[start:end]
        start = end


def frequent_pairs(lang: str, numbers: np.ndarray, hashes: np.ndarray, pairs: Frequent) -> np.ndarray:
    """At which places a pair starts that may be frequent."""
    return (numbers[:-1] > 0) & (numbers[1:] > 0) & pairs.holds(pair_hashes(lang, hashes[:-1], hashes[1:]))


def phrase_keys(words: WordNumbers, lang: str, numbers: np.ndarray, new: int, pairs: Frequent | None, triples: Frequent | None) -> np.ndarray:
    """Keys of the phrases that end in numbers[new:]: single words, or, given what is frequent, pairs and triples.

    A single word has no first word in its key.
    """
    if pairs is None:
        keys = numbers[new:]
        return keys[keys > 0]
    hashes = words.hashes_of(numbers)
    good = frequent_pairs(lang, numbers, hashes, pairs)
    two = np.flatnonzero(good[max(0, new - 1):]) + max(0, new - 1)
    three = np.flatnonzero(good[:-1] & good[1:])
    three = three[three >= new - 2]
    three = three[triples.holds(triple_hashes(lang, hashes[three], hashes[three + 1], hashes[three + 2]))]
    keys = numbers[:-1] << 2 * BITS | numbers[1:] << BITS
    return np.concatenate([keys[two], keys[three] | numbers[three + 2]])


def _numbered(batches: Iterator[pa.RecordBatch], words_of, block: int) -> Iterator[tuple[str, np.ndarray, int]]:
    """(language, word numbers, how many of them were there before) of all texts, block by block."""
    for batch, texts in text_batches(batches):
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), texts):
            by_lang.setdefault(UNDETERMINED if lang is None else lang, []).append(text)
        for lang, own in by_lang.items():
            carried: list[bytes] = []
            for part in blocks(b"\n".join(own).translate(_FOLDED), block):
                words = carried + [w for w in part.replace(b"\n", b" \n ").split(b" ") if w]
                yield lang, np.fromiter(map(words_of().__getitem__, words), dtype=np.int64, count=len(words)), len(carried)
                carried = words[-2:]


def _count(maps: list[Broadcast | None], block: int, limits: dict):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, pairs, triples = (None if m is None else Frequent(m.value) for m in maps)
        trie = HatTrie(frequent, **limits)
        for lang, numbers, known in _numbered(batches, lambda: trie.numbers, block):
            if pairs is None or len(numbers) > 1:
                trie.add(lang, *np.unique(phrase_keys(trie.numbers, lang, numbers, known, pairs, triples), return_counts=True))
            yield from trie.runs()
        yield from trie.all()

    return count


def sorted_runs(docs: DataFrame, words_map: Broadcast | None = None, pairs_map: Broadcast | None = None, triples_map: Broadcast | None = None,
                block: int = BLOCK, **limits) -> DataFrame:
    """(lang, w1, w2, w3, f): the spilled runs of all tasks, a phrase once in each. Of single words, or of frequent pairs and triples."""
    count = _count([words_map, pairs_map, triples_map], block, limits)
    return docs.select("lang", "text").mapInArrow(count, "lang string, w1 string, w2 string, w3 string, f bigint")


def _added_up(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    hashes, places = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
    return hashes, np.bincount(places, np.concatenate([n for _, n in held])).astype(np.int64)


def _hash_phrases(words_map: Broadcast, pairs_map: Broadcast | None, block: int, most: int):
    def run(held: list) -> pa.RecordBatch:
        hashes, counts = _added_up(held)
        return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts)], names=["hash", "f"])

    def pairs_of(words: WordNumbers, lang: str, numbers: np.ndarray, known: int) -> tuple[np.ndarray, np.ndarray]:
        first, second = numbers[max(0, known - 1):-1], numbers[max(1, known):]
        good = (first > 0) & (second > 0)
        keys, counts = np.unique(first[good] << BITS | second[good], return_counts=True)
        return pair_hashes(lang, words.hashes_of(keys >> BITS), words.hashes_of(keys & (1 << BITS) - 1)), counts

    def triples_of(words: WordNumbers, lang: str, numbers: np.ndarray, known: int, pairs: Frequent) -> tuple[np.ndarray, np.ndarray]:
        numbers = numbers[max(0, known - 2):]
        good = frequent_pairs(lang, numbers, words.hashes_of(numbers), pairs)
        at = np.flatnonzero(good[:-1] & good[1:])
        keys, counts = np.unique(numbers[at] << 2 * BITS | numbers[at + 1] << BITS | numbers[at + 2], return_counts=True)
        parts = (words.hashes_of(keys >> shift & (1 << BITS) - 1) for shift in (2 * BITS, BITS, 0))
        return triple_hashes(lang, *parts), counts

    def hash_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, size = WordNumbers(Frequent(words_map.value)), [], 0
        pairs = None if pairs_map is None else Frequent(pairs_map.value)
        for lang, numbers, known in _numbered(batches, lambda: words, block):
            if len(numbers) > 1:
                held.append(pairs_of(words, lang, numbers, known) if pairs is None else triples_of(words, lang, numbers, known, pairs))
                size += len(held[-1][0])
            if size > 2 * most:
                held = [_added_up(held)]
                size = len(held[0][0])
            if size > most or len(words) > TRIE_WORDS:
                if held:
                    yield run(held)
                held, size = [], 0
                if len(words) > TRIE_WORDS:
                    words = WordNumbers(words.frequent)
        if held:
            yield run(held)

    return hash_phrases


def phrase_hash_counts(docs: DataFrame, words_map: Broadcast, pairs_map: Broadcast | None = None, block: int = BLOCK,
                       most: int = 2 * TRIE_PHRASES) -> DataFrame:
    """(hash, f): pairs of frequent words, or triples of frequent pairs, by hash; tasks add up as many as `most` before they send them."""
    runs = docs.select("lang", "text").mapInArrow(_hash_phrases(words_map, pairs_map, block, most), "hash bigint, f bigint")
    return runs.groupBy("hash").agg(F.sum("f").alias("f"))


def merged(runs: DataFrame) -> DataFrame:
    """Counts of phrases: the runs dealt out by prefix, and added up there."""
    return runs.repartition("lang", "w1", "w2").groupBy("lang", "w1", "w2", "w3").agg(F.sum("f").alias("f"))


def _scored(counts: DataFrame, share: int) -> DataFrame:
    """Candidates with a, l, r and score; counts holds the frequent phrases of 1 to 3 words."""
    text = "struct({} AS k, {} AS l1, {} AS l2, {} AS r1, {} AS r2)".format
    cuts = F.expr(f"IF(w3 = '', array({text(1, 'w1', repr(''), 'w2', repr(''))}), array({text(1, 'w1', repr(''), 'w2', 'w3')}, {text(2, 'w1', 'w2', 'w3', repr(''))}))")
    candidates = counts.where("w2 != ''").withColumnRenamed("f", "a")
    longer = candidates.where("w3 != ''").select("lang", "a", F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("pair"))
    within = longer.groupBy("lang", F.col("pair.w1").alias("w1"), F.col("pair.w2").alias("w2")).agg(F.max("a").alias("most")).withColumn("w3", F.lit(""))
    left = candidates.join(within, ["lang", "w1", "w2", "w3"], "left").where(f"most IS NULL OR 100 * most < {int(share)} * a").drop("most")
    cut = left.withColumn("cut", F.explode(cuts)).select("lang", "w1", "w2", "w3", "a", "cut.*")
    parts = counts.where("w3 = ''")
    firsts = parts.select("lang", F.col("w1").alias("l1"), F.col("w2").alias("l2"), F.col("f").alias("l"))
    rests = parts.select("lang", F.col("w1").alias("r1"), F.col("w2").alias("r2"), F.col("f").alias("r"))
    both = cut.join(firsts, ["lang", "l1", "l2"]).join(rests, ["lang", "r1", "r2"])
    wide = "CAST(CAST({} AS DECIMAL(18, 0)) * CAST({} AS DECIMAL(18, 0)) AS DECIMAL(38, 0))".format
    score = F.expr(f"CAST({wide('a', 'a')} * CAST(1000000 AS DECIMAL(7, 0)) AS DECIMAL(38, 0)) div {wide('l', 'r')}")
    lowest = both.select("lang", "w1", "w2", "w3", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
    return lowest.groupBy("lang", "w1", "w2", "w3", "a").agg(F.min("cut").alias("cut")).select(
        "lang", F.concat_ws(" ", "w1", "w2", F.expr("nullif(w3, '')")).alias("phrase"), "a", "cut.l", "cut.r", "cut.score")


def best_of_each(scored: DataFrame, first: int, groups: int) -> DataFrame:
    """The first rows of each language by score, a and phrase, with their rank."""
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    left = scored.withColumn("group", F.pmod(F.xxhash64("phrase"), F.lit(groups)))
    while groups > 1:
        within = Window.partitionBy("lang", "group").orderBy(*best)
        groups = -(-groups // _GROUPS_IN_ONE)
        left = left.withColumn("rank", F.row_number().over(within)).where(F.col("rank") <= first).withColumn("group", F.pmod("group", F.lit(groups)))
    ranked = F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("bigint")
    return left.withColumn("rank", ranked).where(F.col("rank") <= first).drop("group")


def collocations(docs: DataFrame, least: int = 10, share: int = 50, first: int = 2000, block: int = BLOCK, **limits) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's best phrases in docs(lang, text); see the module's notes."""
    spark = docs.sparkSession
    space = Workspace(spark, "collocations")
    words = space.store(merged(sorted_runs(docs, block=block, **limits)))
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    often = words.where(F.col("f") >= least)
    words_map = hash_bits(often.select(F.xxhash64("w1").alias("hash")))
    pairs = space.store(phrase_hash_counts(docs, words_map, None, block).where(F.col("f") >= least).select("hash"))
    pairs_map = hash_bits(pairs)
    triples = space.store(phrase_hash_counts(docs, words_map, pairs_map, block).where(F.col("f") >= least).select("hash"))
    phrases = space.store(merged(sorted_runs(docs, words_map, pairs_map, hash_bits(triples), block, **limits)).where(F.col("f") >= least))
    space.drop(pairs, triples)
    counts = often.union(phrases)
    groups = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranked = best_of_each(_scored(counts, share), first, groups)
    # one row for each language
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
