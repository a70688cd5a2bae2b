"""Quality rules from tokeniser fertility, beside base counts of words, symbols, lines and repeats.

A public byte-level BPE gives characters per token and the entropy of the tokens of a text; the characters that a public
piece vocabulary lacks, and would write byte by byte, give the byte-fallback share. A text is rejected if a measure lies
outside the band of its script (that of most of its letters). Bands are wide: they hold for natural text of any subject.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_batches
from .tokens import ByteBpe, public_path, shipped


@dataclass(frozen=True)
class Band:
    """What is accepted. Entropy is judged only over `least_tokens`, relative to the most that so many tokens could have."""

    chars_per_token: tuple[float, float]
    most_fallback: float
    least_entropy: float
    least_tokens: int = 100


#: Scripts by ranges of code points; letters elsewhere are "other".
SCRIPTS: dict[str, tuple[tuple[int, int], ...]] = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F),),
    "hebrew": ((0x590, 0x5FF),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F)),
    "indic": ((0x900, 0xDFF),),
    "thai": ((0xE00, 0xE7F),),
    "hangul": ((0x1100, 0x11FF), (0xAC00, 0xD7AF)),
    "han": ((0x3040, 0x30FF), (0x3400, 0x9FFF)),
}
BANDS: dict[str, Band] = {
    "latin": Band((2.0, 8.0), 0.10, 0.45),
    "greek": Band((0.5, 6.0), 0.30, 0.30),
    "cyrillic": Band((0.6, 6.0), 0.30, 0.30),
    "hebrew": Band((0.4, 6.0), 0.60, 0.30),
    "arabic": Band((0.4, 6.0), 0.60, 0.30),
    "indic": Band((0.2, 6.0), 1.0, 0.25),
    "thai": Band((0.2, 6.0), 1.0, 0.25),
    "hangul": Band((0.3, 4.0), 0.80, 0.25),
    "han": Band((0.3, 3.0), 0.60, 0.25),
    "other": Band((0.2, 8.0), 1.0, 0.20),
}
#: Fixed value: the six characters of white space between words.
SPACE = b" \t\n\r\x0b\x0c"
#: Fixed value: the characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
#: The entropy of longer texts counts as that of so many tokens, as it grows no further with the length.
ENTROPY_TOKENS = 4096
FAILED_WORDS, FAILED_REPEATS = 50, 0.5


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words that lie in a window of three words which is found twice or more in the text."""
    if len(words) <= window:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    m = len(numbers)
    key = ids[:-2]
    for k in range(1, window):
        if m ** 2 > 2**62 // max(m, 1):
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
        key = key * m + ids[k:len(ids) - window + 1 + k]
    order = np.argsort(key, kind="stable")
    equal = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), dtype=bool)
    twice[order[1:]] |= equal
    twice[order[:-1]] |= equal
    hit = np.zeros(len(ids), dtype=bool)
    for k in range(window):
        hit[k:k + len(twice)] |= twice
    return int(hit.sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.split()
    dense = text.translate(None, SPACE)
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (len(words), len(dense.decode()), len(dense) - len(dense.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words))


class Measures:
    """chars_per_token, fallback_share, entropy (relative) and script of texts."""

    def __init__(self, ranks: bytes, model: bytes):
        import sentencepiece

        self.bpe = ByteBpe(ranks)
        pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        known = {p for p in map(pieces.id_to_piece, range(pieces.vocab_size())) if len(p) == 1}
        self.covered = np.zeros(0x110000, dtype=bool)
        self.covered[[ord(c) for c in known] + [ord(c) for c in " \n\t\r"]] = True
        self.names = [*SCRIPTS, "other", ""]
        letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
        self.script = np.where(letters, len(SCRIPTS), len(SCRIPTS) + 1).astype(np.uint8)
        for number, ranges in enumerate(SCRIPTS.values()):
            for low, high in ranges:
                part = self.script[low:high + 1]
                part[letters[low:high + 1]] = number

    def __call__(self, text: bytes) -> tuple[int, float, float, float, str]:
        string = text.decode()
        if not string:
            return 0, 0.0, 0.0, 0.0, "other"
        codes = np.frombuffer(string.encode("utf-32-le"), dtype=np.uint32)
        ids = np.array(self.bpe.ids(string))
        counts = np.bincount(ids)
        counts = counts[counts > 0]
        entropy = math.log2(len(ids)) - float((counts * np.log2(counts)).sum()) / len(ids)
        most = math.log2(min(len(ids), ENTROPY_TOKENS))
        missing = codes[~self.covered[codes]]
        fallback = len(missing) + int(sum((missing >= edge).sum() for edge in (0x80, 0x800, 0x10000)))
        letters = np.bincount(self.script[codes], minlength=len(self.names))[:-1]
        script = self.names[int(letters.argmax())] if letters.any() else "other"
        return len(ids), len(codes) / len(ids), fallback / len(text), min(1.0, entropy / most) if most else 1.0, script


def within(n_tokens: int, chars_per_token: float, fallback: float, entropy: float, script: str, bands: dict[str, Band]) -> bool:
    band = bands.get(script, bands["other"])
    low, high = band.chars_per_token
    return low <= chars_per_token <= high and fallback <= band.most_fallback and (n_tokens < band.least_tokens or entropy >= band.least_entropy)


def judged(docs: DataFrame, ranks_path: str | None = None, model_path: str | None = None, bands: dict[str, Band] | None = None) -> DataFrame:
    """One row for every row of docs(doc_id, text): the base counts, base_failed, kept, and the measures behind it.

    Null and empty texts have no words and fail; other columns are not read; an empty table gives no rows.
    """
    context = docs.sparkSession
    ranks = shipped(context, ranks_path or public_path("byte_bpe_multi_50k.tiktoken"))
    model = shipped(context, model_path or public_path("piece_bpe_32k.model"))
    bands = bands or BANDS
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    measures = ["n_tokens", "chars_per_token", "fallback_share", "entropy", "script"]
    names = ["doc_id", *counts, "base_failed", "kept", *measures]
    kinds = [*[pa.int64()] * 5, pa.bool_(), pa.bool_(), pa.int64(), *[pa.float64()] * 3, pa.string()]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measured = Measures(ranks.value, model.value)
        for batch, texts in text_batches(batches):
            rows = []
            for text in texts:
                base = base_counts(text)
                failed = base[0] < FAILED_WORDS or base[4] > FAILED_REPEATS * base[0]
                values = measured(text)
                rows.append((*base, failed, not failed and within(*values, bands), *values))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))], names=names)

    types = ["long"] * 5 + ["boolean"] * 2 + ["long", "double", "double", "double", "string"]
    return docs.select("doc_id", "text").mapInArrow(judge, f"doc_id {kind}, " + ", ".join(f"{n} {t}" for n, t in zip(names[1:], types)))
