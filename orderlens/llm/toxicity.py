"""Toxicity: a support vector machine with a gap-weighted subsequence kernel and Nystroem landmarks.

The kernel compares two words by the triples of characters that they share in order, gaps allowed: a triple that spans s
characters weighs DECAY**s, with s up to SPAN. "id-iot", "i d i o t" and "idxiot" stay close to the word without the insertion.
It is normalised by a norm that depends on a word's length. An approximate feature map comes from LANDMARKS words (Nystroem),
and the machine is linear in it. As the kernel has an explicit form over triples, landmarks, map and machine fold into one
weight per triple, so that scoring costs the same for any number of landmarks.

Labels are of documents, and words decide: a sentence is as toxic as its worst word, a document as its worst sentence. So
training alternates between choosing each toxic document's witness and fitting the machine against the words that clean
documents score highest on. A logistic model over the worst two words and the count of toxic ones gives the probability.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, held_out, text_batches

DECAY, SPAN = 0.7, 5
LANDMARKS = 384
#: Labelled documents of either kind that are learned from, about (all, where there are fewer), chosen by hash of doc_id.
SAMPLE = {1: 3000, 0: 9000}
ROUNDS = 3
#: Of the sample's units: the most marked ones that the machine starts from, those a single witness may be taken from, and the
#: commonest clean ones.
MARKED, USUAL, COMMON = 200, 1000, 2000
#: How many times commoner a unit has to be in toxic documents than the clean ones let expect, to be learned as toxic.
EXCESS = 3
THRESHOLD = 0.3
#: Longer words are cut into overlapping parts of this length.
LONGEST = 22
#: Words whose score a worker remembers before it starts anew.
REMEMBERED = 300_000

_STEPS = [(a, b) for a in range(1, SPAN) for b in range(1, SPAN + 1 - a)]
_LETTERS = re.compile(r"[\W\d_]+")
_SPACED = re.compile(r"(?<!\S)\w(?:[ .\-*_]\w){2,}(?!\w)")
_CODES = 64


def _code(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 32 + ord(c) % 32


def unit(word: str) -> str:
    """The letters of a word in lower case, behind a mark for how it is written: a (lower case), A (first letter), ! (all)."""
    letters = _LETTERS.sub("", word)
    if not letters:
        return ""
    mark = "a" if letters[0].islower() or not letters[0].isupper() else "!" if len(letters) > 2 and letters.isupper() else "A"
    return mark + letters.lower()


def units_of(text: str) -> set[str]:
    """The distinct words of a text, with words spelled out letter by letter put together."""
    found = set(text.split())
    for run in _SPACED.findall(text):
        found.add(_LETTERS.sub("", run))
    return found


def _norms() -> np.ndarray:
    out = np.zeros(LONGEST + 2)
    for size in range(LONGEST + 2):
        out[size] = sum(DECAY ** (2 * (a + b)) * max(0, size - a - b) for a, b in _STEPS)
    return np.sqrt(np.maximum(out, DECAY ** 4))


_NORMS = _norms()
_MARKS = {"a": 27, "A": 28, "!": 29}


def coded(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of codes, padded with zeros, and lengths; units are at most LONGEST letters behind a mark."""
    sizes = np.array([len(u) for u in units], dtype=np.int64)
    out = np.zeros((len(units), LONGEST + 1 + SPAN), dtype=np.int32)
    if len(units):
        letters = np.frombuffer("".join(units).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        codes = np.where((letters >= 97) & (letters <= 122), letters - 96, 32 + letters % 32)
        rows = np.repeat(np.arange(len(units)), sizes)
        columns = np.arange(len(letters)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[rows, columns] = codes
        out[:, 0] = [_MARKS[u[0]] for u in units]
    return out, sizes


def _triples(codes: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, float]]:
    for a, b in _STEPS:
        index = (codes[:, :width] * _CODES + codes[:, a:a + width]) * _CODES + codes[:, a + b:a + b + width]
        yield index, DECAY ** (a + b)


def _weights(units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, triple and normalised weight of every triple of the units; one that occurs several times stands several times."""
    codes, sizes = coded(units)
    rows, triples, weights = [], [], []
    for index, weight in _triples(codes, int(sizes.max()) if len(sizes) else 0):
        row, column = np.nonzero(index % _CODES)
        rows.append(row)
        triples.append(index[row, column])
        weights.append(weight / _NORMS[sizes[row]])
    return np.concatenate(rows), np.concatenate(triples), np.concatenate(weights)


def features(units: list[str], columns: np.ndarray) -> np.ndarray:
    """Rows of normalised weights over the triples in columns (sorted); other triples are left out."""
    row, triple, weight = _weights(units)
    at = np.minimum(np.searchsorted(columns, triple), len(columns) - 1)
    known = columns[at] == triple
    cell = row[known] * len(columns) + at[known]
    return np.bincount(cell, weight[known], len(units) * len(columns)).reshape(len(units), len(columns))


def kernel(left: list[str], right: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Kernel values of units against rows of features() that have no other triples than columns."""
    return np.vstack([features(left[at:at + 256], columns) @ right.T for at in range(0, len(left), 256)])


@dataclass
class Model:
    """Folded weights per triple, the bias, and the logistic model over a document's values."""

    weights: np.ndarray
    bias: float
    logistic: np.ndarray | None = None

    def sent(self, spark: SparkSession) -> Broadcast:
        """The three parts, a megabyte whatever was learned from; plain values, as broadcasts don't travel with this package."""
        return spark.sparkContext.broadcast((self.weights, self.bias, self.logistic))

    def unit_scores(self, units: list[str]) -> np.ndarray:
        out = np.zeros(len(units))
        order = np.argsort([len(u) for u in units], kind="stable")
        for part in np.array_split(order, max(1, len(units) // 4096)):
            codes, sizes = coded([units[k] for k in part])
            width = int(sizes.max()) if len(sizes) else 0
            total = np.zeros(len(part))
            for index, weight in _triples(codes, width):
                total += self.weights[index].sum(axis=1) * weight
            out[part] = total / _NORMS[sizes] + self.bias
        return out


class Scorer:
    """Scores of words with a memory, and from them a document's values."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def learn(self, words: set[str]) -> None:
        if len(self.known) + len(words) > REMEMBERED:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        parts, owner = [], []
        for number, word in enumerate(new):
            u = unit(word)
            if len(u) > 2:
                for at in range(1, max(2, len(u) - LONGEST // 2), LONGEST // 2):
                    parts.append(u[0] + u[at:at + LONGEST])
                    owner.append(number)
        best = np.full(len(new), self.model.bias)
        if parts:
            np.maximum.at(best, owner, self.model.unit_scores(parts))
        self.known.update(zip(new, best.tolist()))

    def values(self, words: set[str]) -> tuple:
        """VALUES of a text, and its worst word."""
        if not words:
            return (-1.0, -1.0, -1.0, 0.0, 0.0, 0.0, "")
        listed = list(words)
        scores = np.fromiter(map(self.known.__getitem__, listed), dtype=float, count=len(listed))
        top = np.sort(np.partition(scores, -3)[-3:] if len(scores) > 3 else scores)[::-1].tolist() + [-1.0, -1.0]
        return (*top[:3], float(np.log1p((scores > 0).sum())), float(np.log1p((scores > 0.5).sum())), float(np.log1p(len(listed))),
                min(w for w, s in zip(listed, scores) if s == top[0]))


#: What a document's probability hangs on: the scores of its three worst words, logs of 1 + the number of words above 0,
#: above 0.5, and of all words.
VALUES = ["first", "second", "third", "above", "well_above", "words"]


def expanded(x: np.ndarray) -> np.ndarray:
    """The columns of the logistic model: the values, products of the scores, and one."""
    scores = np.clip(x[:, :3], -1.5, 1.5)
    products = [scores[:, i] * scores[:, j] for i in range(3) for j in range(i, 3)]
    return np.column_stack([scores, x[:, 3:], *products, np.maximum(0, scores[:, 0] - 0.8), np.ones(len(x))])


def _valued(docs: DataFrame, model, columns: list[str], score: bool) -> DataFrame:
    """columns of docs with the values of each text, or with its probability."""
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    names = ["score"] if score else [*VALUES, "witness"]
    schema = kinds + (", score double" if score else "".join(f", {v} double" for v in VALUES) + ", witness string")

    def value(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Model(*model.value))
        for batch, texts in text_batches(batches):
            sets = [units_of(t.decode()) for t in texts]
            scorer.learn(set().union(*sets))
            rows = [scorer.values(s) for s in sets]
            if score:
                x = expanded(np.array([r[:-1] for r in rows]))
                arrays = [pa.array(1 / (1 + np.exp(-np.clip(x @ scorer.model.logistic, -40, 40))))]
            else:
                arrays = [pa.array(c) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *arrays], names=[*columns, *names])

    return docs.select(*dict.fromkeys([*columns, "text"])).mapInArrow(value, schema)


def _newton(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, logistic: bool) -> np.ndarray:
    """Minimum of ridge / 2 * |u|^2 + the weighted squared hinge losses (or logistic ones); the last column is the bias."""
    u = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6

    def loss(v):
        margin = y * (x @ v)
        each = np.logaddexp(0, -margin) if logistic else np.maximum(0, 1 - margin) ** 2
        return 0.5 * (penalty * v * v).sum() + (weight * each).sum()

    for _ in range(60):
        margin = y * (x @ u)
        if logistic:
            p = 1 / (1 + np.exp(np.clip(margin, -40, 40)))
            slope, curve = -weight * y * p, weight * p * (1 - p)
        else:
            short = np.maximum(0, 1 - margin)
            slope, curve = -2 * weight * y * short, 2 * weight * (short > 0)
        gradient = penalty * u + x.T @ slope
        step = np.linalg.solve((x * curve[:, None]).T @ x + np.diag(penalty) + 1e-9 * np.eye(len(u)), gradient)
        size, before = 1.0, loss(u)
        while size > 1e-4 and loss(u - size * step) > before:
            size /= 2
        u = u - size * step
        if np.abs(size * step).max() < 1e-7:
            break
    return u


def fit_machine(positives: dict[str, float], negatives: dict[str, float], landmarks: int = LANDMARKS) -> Model:
    """The machine over units with weights, folded into weights per triple."""
    chosen = sorted(positives, key=lambda u: (-positives[u], u))[:landmarks // 2]
    chosen += sorted(set(negatives) - set(chosen), key=lambda u: (-negatives[u], u))[:landmarks - len(chosen)]
    columns = np.unique(_weights(chosen)[1])
    marks = features(chosen, columns)
    values, vectors = np.linalg.eigh(marks @ marks.T)
    root = (vectors * (1 / np.sqrt(np.maximum(values, 1e-3)))) @ vectors.T
    names = [*positives, *negatives]
    x = kernel(names, marks, columns) @ root
    x = np.hstack([x, np.ones((len(x), 1))])
    y = np.array([1.0] * len(positives) + [-1.0] * len(negatives))
    weight = np.concatenate([np.sqrt(list(positives.values())) / max(1e-9, np.sqrt(list(positives.values())).sum()),
                             np.sqrt(list(negatives.values())) / max(1e-9, np.sqrt(list(negatives.values())).sum())])
    u = _newton(x, y, weight, 0.002, logistic=False)
    folded = np.zeros(_CODES ** 3, dtype=np.float32)
    folded[columns] = marks.T @ (root @ u[:-1])
    return Model(folded, float(u[-1]))


def _learned(docs: DataFrame, labels: DataFrame, space: Workspace, sample: dict[int, int]) -> DataFrame | None:
    """doc_id, toxic, text of the sample; None where one of the kinds is missing."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.where("toxic IN (0, 1)").groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return None
    share = F.when(F.col("toxic") == 1, min(1.0, sample[1] / counts[1])).otherwise(min(1.0, sample[0] / counts[0]))
    part = known.where("toxic IN (0, 1)").where(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20)) < share * (1 << 20))
    # a sample of about sample[0] + sample[1] ids, whatever the size of the tables, so no text has to be shuffled
    return space.store(docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(space.store(part)), "doc_id"))


def _unit_counts(sample: DataFrame) -> DataFrame:
    """unit, toxic (documents of that kind that have it), clean."""
    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches):
            names, kinds = [], []
            for text, toxic in zip(texts, batch.column("toxic").to_pylist()):
                units = {u[:LONGEST + 1] for u in map(unit, units_of(text.decode())) if len(u) > 2}
                names += units
                kinds += [toxic] * len(units)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(kinds, pa.int32())], names=["unit", "toxic"])

    each = sample.select("text", "toxic").mapInArrow(distinct, "unit string, toxic int")
    return each.groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))


def train(docs: DataFrame, labels: DataFrame, sample: dict[int, int] | None = None, rounds: int = ROUNDS) -> Model:
    """The model of docs(doc_id, text) and labels(doc_id, toxic); with labels of one kind only, it knows just their share."""
    spark = docs.sparkSession
    space = Workspace(spark, "toxicity")
    rows = _learned(docs, labels, space, sample or SAMPLE)
    if rows is None or rows.isEmpty():
        return Model(np.zeros(_CODES ** 3, np.float32), -1.0, np.append(np.zeros(len(expanded(np.zeros((1, len(VALUES))))[0]) - 1), -4.0))
    total = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    ratio = total.get(1, 0) / max(1, total.get(0, 0))
    counts = space.store(_unit_counts(rows))
    # deviations by which a unit is commoner in toxic documents than the clean ones let expect
    z = (F.col("toxic") - F.col("clean") * ratio) / F.sqrt(F.col("toxic") + F.col("clean") * ratio ** 2 + 1)
    # common words, only because toxic documents are somewhat longer, deviate too, but are no commoner
    marked = f"toxic > {EXCESS * ratio!r} * clean"
    best = counts.withColumn("z", z).where("z > 2.5 AND toxic > 3").where(marked).orderBy(F.desc("z"), "unit").limit(USUAL).collect()
    common = counts.orderBy(F.desc("clean"), "unit").limit(COMMON).collect()
    positives = {r["unit"]: r["toxic"] - ratio * r["clean"] for r in best[:MARKED]}
    negatives = {r["unit"]: float(r["clean"]) for r in common if r["unit"] not in positives and r["clean"]}
    usual = {r["unit"] for r in best}
    model = fit_machine(positives or {"a": 1.0}, negatives or {"a": 1.0})
    for _ in range(rounds):
        seen = _valued(rows, model.sent(spark), ["toxic"], False).select("toxic", "witness").distinct().collect()
        found = {kind: {unit(r["witness"])[:LONGEST + 1] for r in seen if r["toxic"] == kind and len(unit(r["witness"])) > 2} for kind in (0, 1)}
        # a unit counts by the documents that have it, not by those whose witness it is: these change with every round
        witnesses = spark.createDataFrame([(u,) for u in sorted(found[0] | found[1])], "unit string")
        known = counts.join(F.broadcast(witnesses), "unit").withColumn("marked", F.expr(marked)).collect()
        positives |= {r["unit"]: r["toxic"] - ratio * r["clean"] for r in known
                      if r["unit"] in found[1] and r["marked"] and (r["toxic"] > 1 or r["unit"] in usual)}
        negatives |= {r["unit"]: float(r["clean"]) for r in known if r["unit"] in found[0]}
        negatives = {u: n for u, n in negatives.items() if u not in positives}
        model = fit_machine(positives or {"a": 1.0}, negatives or {"a": 1.0})
    values = _valued(rows, model.sent(spark), ["toxic"], False).select("toxic", *VALUES).toPandas()
    x = expanded(values[VALUES].to_numpy(float))
    y = np.where(values["toxic"] == 1, 1.0, -1.0)
    known = {r["toxic"]: r["count"] for r in labels.where("toxic IN (0, 1)").where(~held_out()).groupBy("toxic").count().collect()}
    weight = np.where(y > 0, known[1] / max(1, (y > 0).sum()), known[0] / max(1, (y < 0).sum())) * len(y) / (known[0] + known[1])
    model.logistic = _newton(x, y, weight, 0.1, logistic=True)
    space.drop(rows, counts)
    return model


def scored(docs: DataFrame, labels: DataFrame, sample: dict[int, int] | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs(doc_id, text).

    Learned from rows of labels(doc_id, toxic) that are not held out; of several labels of a document the highest counts.
    Null and empty texts get the score of a text without words. Repeated rows come back repeated; an empty table gives no
    rows; other columns are not read.
    """
    model = train(docs, labels, sample).sent(docs.sparkSession)
    out = _valued(docs, model, ["doc_id"], True)
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def acceptable(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs below the threshold, with all their columns."""
    model = train(docs, labels).sent(docs.sparkSession)
    # other names meanwhile, as docs may have a score of its own
    inner = docs.select(*[F.col(f"`{c}`").alias(c if c == "text" else f"in_{k}") for k, c in enumerate(docs.columns)])
    return _valued(inner, model, inner.columns, True).where(F.col("score") < threshold).select(inner.columns).toDF(*docs.columns)
