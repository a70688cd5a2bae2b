"""Benchmark decontamination: one Aho-Corasick automaton over the windows of normalised test items.

Normalised text is the lower-cased words (runs of 0-9, a-z and everything beyond ASCII) between single spaces, so a window
of words is a plain substring with a space on either side. The automaton is built in each worker from the windows, which
are broadcast: their size is checked, and items beyond MAX_BYTES go into further blocks that are scanned one after the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_batches

WINDOW = 10
#: Bytes of normalised items in one automaton (some 100 times as much memory in a worker).
MAX_BYTES = 4 << 20

#: ASCII bytes that are no word characters become spaces, A-Z becomes a-z.
_WORDS = bytes(32 if b < 48 or 57 < b < 65 or 90 < b < 97 or 122 < b < 128 else b + 32 * (65 <= b <= 90) for b in range(256))


def normalised(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split(b" ")


def _item_words() -> Column:
    """The same words in SQL, for the few rows of the benchmark; A-Z by translate, as lower() knows more letters."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), upper, lower), F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), 1)


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """pattern, item_ids (sorted as strings): each distinct window with the items that hold it."""
    words = benchmark.select(F.col("item_id").cast("string").alias("item_id"), _item_words().alias("words")).where("size(words) > 0 AND item_id IS NOT NULL")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (window - 1)))
    each = words.select("item_id", F.explode(F.transform(starts, lambda i: F.array_join(F.slice("words", i, window), " "))).alias("pattern"))
    return each.groupBy("pattern").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_bytes: int = MAX_BYTES, columns: list[str] | None = None) -> DataFrame:
    """columns of docs, n_words, words array<int> (hit words by number), spans array<struct<start, end>> (their runs, as
    byte offsets into the UTF-8 text), item_ids array<string>.

    Null and empty texts have no words; an item without words has no window; items without id are skipped; an item that
    repeats counts once by its id. With an empty benchmark nothing is hit. Columns of docs beyond `columns` are not read.
    """
    columns = columns or ["doc_id"]
    patterns = item_windows(benchmark, window)
    total = benchmark.agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))))).first()[0] or 0
    blocks = max(1, -(-total // max_bytes))
    kept = [docs.schema[c] for c in columns]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["n_words long", "words array<int>", "spans array<struct<start: long, end: long>>", "item_ids array<string>"])
    found = docs.select(*dict.fromkeys([*columns, "text"]))
    schema_between = None
    if blocks > 1:  # carry what earlier blocks hit along with the text
        found = found.withColumns({"words": F.expr("array_repeat(0, 0)"), "item_ids": F.expr("array_repeat('', 0)")})
        schema_between = schema + ("" if "text" in columns else ", text string")
    for block in range(blocks):
        rows = patterns.where(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == block).collect()
        last = block == blocks - 1
        table = docs.sparkSession.sparkContext.broadcast([(r["pattern"], r["item_ids"]) for r in rows])
        found = found.mapInArrow(_scan(table, columns, last), schema if last else schema_between)
        if not last:
            found = found.drop("n_words", "spans")
    return found


def _automaton(patterns):
    machine = ahocorasick.Automaton()
    for pattern, items in patterns:
        machine.add_word(f" {pattern} ", (len(pattern.split(" ")), tuple(items)))
    if len(machine):
        machine.make_automaton()
    return machine


def _scan(table, columns: list[str], last: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton(table.value)
        for batch, texts in text_batches(batches):
            held = batch.schema.names
            earlier = [batch.column(c).to_pylist() if c in held else None for c in ("words", "item_ids")]
            out = {"n_words": [], "words": [], "spans": [], "item_ids": []}
            for row, text in enumerate(texts):
                words = [w for w in normalised(text) if w]
                marks, items = set(earlier[0][row] if earlier[0] else ()), set(earlier[1][row] if earlier[1] else ())
                if words and len(machine):
                    line = (b" " + b" ".join(words) + b" ").decode()
                    at, number = 0, 0
                    for end, (size, ids) in machine.iter(line):
                        number += line.count(" ", at, end)
                        at = end
                        marks.update(range(number - size, number))
                        items.update(ids)
                hit = sorted(marks)
                out["n_words"].append(len(words))
                out["words"].append(hit)
                out["spans"].append(_spans(text, hit) if last else [])
                out["item_ids"].append(sorted(items))
            types = {"n_words": pa.int64(), "words": pa.list_(pa.int32()), "spans": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), "item_ids": pa.list_(pa.string())}
            arrays = [batch.column(c) for c in columns] + [pa.array(v, types[k]) for k, v in out.items()]
            names = [*columns, *out]
            if not last and "text" not in columns:
                arrays, names = [*arrays, batch.column("text")], [*names, "text"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return scan


def _spans(text: bytes, hit: list[int]) -> list[dict]:
    """Byte offsets of the runs of hit words in the original text."""
    if not hit:
        return []
    flags = np.frombuffer(text.translate(_WORDS), dtype=np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    hit = np.asarray(hit)
    cuts = np.flatnonzero(np.diff(hit) > 1) + 1
    return [{"start": int(starts[run[0]]), "end": int(ends[run[-1]])} for run in np.split(hit, cuts)]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_bytes: int = MAX_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every row of docs(doc_id, text); see hits()."""
    return hits(docs, benchmark, window, max_bytes).select(
        "doc_id", "n_words", F.size("words").cast("long").alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.size("words") > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs in which nothing is hit, with all their columns."""
    # other names meanwhile, as docs may have columns named like those of hits()
    inner = docs.select(*[F.col(f"`{c}`").alias(c if c == "text" else f"in_{k}") for k, c in enumerate(docs.columns)])
    return hits(inner, benchmark, columns=inner.columns).where("size(words) = 0").select(inner.columns).toDF(*docs.columns)
