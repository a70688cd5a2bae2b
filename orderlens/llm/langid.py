"""Language identification: multinomial naive Bayes over hashed character n-grams.

Text is folded to lower-case letters and spaces; its 1-, 2- and 3-grams are hashed into buckets. Training adds up bucket
counts per language; scoring gathers rows of the broadcast matrix of log-probabilities and sums them per text in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out, text_batches

BUCKETS = 1 << 16
GRAMS = (1, 2, 3)
#: About so many labelled documents of each language are learned from (all, where there are fewer), chosen by hash of doc_id.
SAMPLE = 4000
#: A label column with more values than this is taken for something else.
MAX_LANGUAGES = 500
#: Evidence counts as that of so many n-grams at most; else each longer text has a score of 1.
EVIDENCE = 150
UNKNOWN = "und"


class Folder:
    """Texts as one array of lower-case letters (other characters are spaces), with the bounds of each text."""

    def __init__(self):
        codes = np.full(0x110000, 32, dtype=np.uint32)
        for code in range(0x110000):
            letter = chr(code)
            if letter.isalpha():
                low = letter.lower()
                codes[code] = ord(low[0])
        self.codes = codes

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        strings = ["  " + text.decode() + " " for text in texts]     # no n-gram of up to three joins letters of two texts
        bounds = np.concatenate(([0], np.cumsum([len(s) for s in strings])))
        return self.codes[np.frombuffer("".join(strings).encode("utf-32-le"), dtype=np.uint32)], bounds


def buckets(codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of the n-gram at each place, and whether it counts (it is not all spaces)."""
    size = len(codes) - n + 1
    if size <= 0:
        return np.empty(0, np.uint32), np.empty(0, bool)
    value = np.full(size, n, dtype=np.uint32)
    letters = np.zeros(size, dtype=bool)
    for k in range(n):
        part = codes[k:k + size]
        value = (value ^ part) * np.uint32(0x9E3779B1)
        value ^= value >> np.uint32(15)
        letters |= part != 32
    return (value * np.uint32(0x85EBCA6B)) >> np.uint32(16), letters


def _texts(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *more)


def train(docs: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages, and the matrix of log-probabilities with the log-priors as its last row, from docs(doc_id, text, lang)."""
    rows = docs.where(~held_out() & F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    sizes = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"lang has more than {MAX_LANGUAGES} values")
    counts = {r["lang"]: r["count"] for r in sizes}
    languages = sorted(counts)
    if not languages:
        return [], np.zeros((BUCKETS + 1, 0), dtype=np.float32)
    share = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(min(1.0, sample / counts[k])))])
    part = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)
    number = F.array_position(F.array(*[F.lit(k) for k in languages]), F.col("lang")).cast("int") - 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, sums = Folder(), np.zeros((len(languages), BUCKETS), dtype=np.int64)
        for batch, found in text_batches(batches):
            codes, bounds = fold(found)
            owner = np.repeat(np.asarray(batch.column("number")), np.diff(bounds))
            for n in GRAMS:
                bucket, counted = buckets(codes, n)
                cell = owner[:len(bucket)][counted].astype(np.int64) * BUCKETS + bucket[counted]
                sums += np.bincount(cell, minlength=sums.size).reshape(sums.shape)
        who, where = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(who, pa.int32()), pa.array(where, pa.int32()), pa.array(sums[who, where], pa.int64())], names=["number", "bucket", "n"])

    cells = rows.where(part).select(number.alias("number"), "text").mapInArrow(count, "number int, bucket int, n long")
    table = cells.groupBy("number", "bucket").agg(F.sum("n").alias("n")).toPandas()   # languages x buckets cells at most
    sums = np.ones((len(languages), BUCKETS))
    sums[table["number"].to_numpy(int), table["bucket"].to_numpy(int)] += table["n"].to_numpy(float)
    matrix = np.log(sums / sums.sum(axis=1, keepdims=True)).T
    prior = np.log(np.array([counts[k] for k in languages], dtype=float) / sum(counts.values()))
    return languages, np.vstack([matrix, prior]).astype(np.float32)


def predict(docs: DataFrame, languages: list[str], matrix: np.ndarray) -> DataFrame:
    """doc_id, lang_pred, score of docs(doc_id, text). A text that is null or has no letter is `und` with score 0."""
    model = docs.sparkSession.sparkContext.broadcast(np.ascontiguousarray(matrix.T))
    kind = docs.schema["doc_id"].dataType

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, table = Folder(), model.value
        for batch, found in text_batches(batches):
            codes, bounds = fold(found)
            sums = np.zeros((len(found), len(languages)))
            counts = np.zeros(len(found))
            for n in GRAMS:
                bucket, counted = buckets(codes, n)
                short = len(codes) - len(bucket)
                counted = np.append(counted, np.zeros(short, bool))
                bucket = np.append(bucket, np.zeros(short, bucket.dtype))
                counts += np.add.reduceat(counted, bounds[:-1], dtype=np.int64)
                for k in range(len(languages)):
                    sums[:, k] += np.add.reduceat(np.where(counted, table[k][bucket], np.float32(0)), bounds[:-1], dtype=np.float64)
            names, scores = [UNKNOWN] * len(found), np.zeros(len(found))
            if languages:
                logits = (sums + table[:, -1]) * np.minimum(1, EVIDENCE / np.maximum(counts, 1))[:, None]
                logits -= logits.max(axis=1, keepdims=True)
                shares = np.exp(logits)
                best = shares.argmax(axis=1)
                scores = np.where(counts > 0, shares.max(axis=1) / shares.sum(axis=1), 0.0)
                names = [languages[b] if c else UNKNOWN for b, c in zip(best, counts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)], names=["doc_id", "lang_pred", "score"])

    return _texts(docs).mapInArrow(score, f"doc_id {kind.simpleString()}, lang_pred string, score double")


def identified(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of docs(doc_id, text, lang).

    Learned from rows with text and lang that are not held out; rows without doc_id are not held out. Repeated rows come
    back repeated. Without any labelled row everything is `und`. Columns beyond the three named are not read.
    """
    scored = predict(docs, *train(docs, sample))
    return scored.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
