"""Collocations, token counts and vector codes against plain models."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import orderlens.llm.token_counts as counting
from orderlens.llm import collocations, queries, tokens, vector_codes
from tests.oracle import connect, difference
from tests.test_queries import SF


# --- collocations ---------------------------------------------------------------------------------------------


def plain_collocations(rows, least=10, share=50, first=2000):
    total, f = Counter(), defaultdict(Counter)
    lower = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    for lang, text in rows:
        lang, text = "und" if lang is None else lang, (text or "").translate(lower)
        for c in ".,;:!?\n\x0b\x0c\r":
            text = text.replace(c, "\n")
        for piece in text.split("\n"):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            total[lang] += len(words)
            for n in (1, 2, 3):
                for i in range(len(words) - n + 1):
                    f[lang][tuple(words[i:i + n])] += 1
    out = []
    for lang, counted in f.items():
        often = {g: a for g, a in counted.items() if len(g) > 1 and a >= least}
        longer = [(g, a) for g, a in often.items() if len(g) == 3]
        scored = []
        for g, a in often.items():
            if len(g) == 2 and any(g in (x[:2], x[1:]) and 100 * b >= share * a for x, b in longer):
                continue
            score, k = min((10**6 * a * a // (counted[g[:k]] * counted[g[k:]]), k) for k in range(1, len(g)))
            scored.append((-score, -a, " ".join(g).encode(), counted[g[:k]], counted[g[k:]]))
        out += [(lang, rank, p.decode(), -a, x, y, total[lang], -s) for rank, (s, a, p, x, y) in enumerate(sorted(scored)[:first], 1)]
    return sorted(out)


def as_rows(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.fixture(scope="module")
def phrases():
    rng = random.Random(3)
    vocabulary = ["the", "The", "of", "a", "new", "york", "city", "straße", "x\x00y", "日本", "über", "no", "'s"]
    joints = [" ", " ", " ", " ", "\t", ", ", "\n", "  ", ". ", "\x0b"]
    rows = [(rng.choice(["en", "de", None, ""]), "".join(rng.choice(vocabulary) + rng.choice(joints) for _ in range(rng.randrange(60)))) for _ in range(80)]
    rows += [("en", None), ("en", ""), (None, " \t\n.,"), ("de", "Solo"), ("fr", "a a a a " * 40), ("en", rows[0][1]), ("en", rows[0][1])]
    return rows


@pytest.mark.parametrize("limits", [{}, {"burst": 3, "most_phrases": 20, "most_words": 1000, "block": 7}, {"burst": 1, "most_phrases": 50, "most_words": 4, "block": 64}])
def test_collocations_like_plain_counting(spark, phrases, limits):
    rows = [(lang, text, 1, "clash") for lang, text in phrases]
    docs = spark.createDataFrame(rows, "lang string, text string, f int, w1 string").repartition(3)
    assert as_rows(collocations.collocations(docs, **limits)) == plain_collocations(phrases)
    assert as_rows(collocations.collocations(docs, least=2, share=90, first=5, **limits)) == plain_collocations(phrases, 2, 90, 5)


def test_collocations_count_in_full_only_what_is_frequent(spark, monkeypatch):
    """All words and most pairs are frequent here, but few triples: rare ones are not sent word by word."""
    rng = random.Random(8)
    rows = [("en", " ".join(f"w{rng.randrange(12)}" for _ in range(100))) for _ in range(60)]
    sent, merged = [], collocations.merged

    def counted(runs):
        sent.append(runs.count())
        return merged(runs)

    monkeypatch.setattr(collocations, "merged", counted)
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    assert as_rows(collocations.collocations(docs)) == plain_collocations(rows)
    often = Counter(tuple(t.split()[i:i + n]) for _, t in rows for n in (2, 3) for i in range(101 - n))
    assert sent[1] <= 1.1 * sum(a >= 10 for a in often.values())


def test_collocations_of_a_very_long_text_and_of_nothing(spark):
    rng = random.Random(9)
    text = " ".join(f"w{rng.randrange(40)}" for _ in range(60_000)) + " " + "z" * 200_000
    rows = [("en", text)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert as_rows(collocations.collocations(docs, block=1000)) == plain_collocations(rows)
    assert collocations.collocations(docs.where("false")).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    a, x, y = 3_037_000_500_123, 3_037_000_500_124, 9_999_999_999_999_999
    counts = spark.createDataFrame([("en", "u", "", "", x), ("en", "v", "", "", y), ("en", "u", "v", "", a)], "lang string, w1 string, w2 string, w3 string, f bigint")
    assert [r["score"] for r in collocations._scored(counts, 50).collect()] == [10**6 * a * a // (x * y)]


def test_best_of_each_with_many_groups(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("lang"), F.concat(F.lit("p"), "id").alias("phrase"),
                                    (F.col("id") % 7).alias("a"), F.lit(1).alias("l"), F.lit(1).alias("r"), (F.col("id") % 11).alias("score"))
    got = sorted((r["lang"], r["rank"], r["phrase"]) for r in collocations.best_of_each(rows, 30, 300).collect())
    want = defaultdict(list)
    for r in rows.collect():
        want[r["lang"]].append((-r["score"], -r["a"], r["phrase"]))
    assert got == sorted((lang, k, x[2]) for lang, own in want.items() for k, x in enumerate(sorted(own)[:30], 1))


# --- token counts ---------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.public_path(counting.VOCABULARY))


def counted(library, texts):
    return [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def odd_texts(n):
    rng = random.Random(11)
    parts = ["a", "be", "the", " ", "  ", "\n", "\t", "\r\n", "\xa0", "　", "'", "'s", "'re", "'rx", "'ll", "'S", "l", "1", "234", "é", "ß", "漢", "😀", "!", "--", "====",
             "<|endoftext|>", "<|endo", "x" * 40, " " * 30, "\x00", "́"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_token_counts_like_the_library(spark, library):
    texts = [None, "", " ", "'", *odd_texts(1500), "same", "same", "word " * 40_000, "q" * 50_000 + " end", " " * 30_000]
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int").repartition(2)
    got = {r["doc_id"]: r for r in counting.token_counts(docs, limit=20).collect()}
    want = counted(library, texts)
    assert [got[i]["n_tokens"] for i in range(len(texts))] == want
    assert all(got[i]["n_bytes"] == len((t or "").encode()) and got[i]["over_limit"] == (want[i] > 20) for i, t in enumerate(texts))
    assert counting.token_counts(docs.where("false")).count() == 0


@pytest.mark.parametrize("chunk, block, few", [(1, 16, 1), (3, 64, 0), (7, 1 << 18, 10**6), (256, 1 << 18, 24)])
def test_token_counts_do_not_depend_on_chunks(library, monkeypatch, chunk, block, few):
    """Every cut of the texts, and a table that is started again all the time."""
    for name, value in {"CHUNK": chunk, "BLOCK": block, "FEW_LANES": few, "MOST_STATES": 50 if block < 100 else 300_000}.items():
        monkeypatch.setattr(counting, name, value)
    with open(tokens.public_path(counting.VOCABULARY), "rb") as file:
        machine = counting.Transducer(counting.Merges(file.read()))
    texts = odd_texts(250)
    assert machine.counts([t.encode() for t in texts]).tolist() == counted(library, texts)


def test_every_prefix_has_its_own_count(library):
    """A transition's annotation is the difference between two prefixes."""
    with open(tokens.public_path(counting.VOCABULARY), "rb") as file:
        machine = counting.Transducer(counting.Merges(file.read()))
    for text in odd_texts(40):
        text = text.replace("<", "")[:60]
        machine.counts([b""])
        if not machine.ready:
            machine._prepare()
        state, total = ("fresh",), 0
        for n, char in enumerate(text, 1):
            state, added = machine._after(state, char)
            total += added
            assert total == len(library.encode(text[:n], add_special_tokens=False).ids), text[:n]


def test_other_tokenizers_are_refused():
    with open(tokens.public_path("word_bpe_49k.json"), "rb") as file, pytest.raises(ValueError):
        counting.Merges(file.read())


# --- vector codes ---------------------------------------------------------------------------------------------


def plain_codes(rows, parts=8, codes=16, rounds=6, scale=4096):
    kept = [(i, [int(np.floor(np.float64(x) * scale)) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0))
    width = len(kept[0][1]) // parts
    cut = [[tuple(v[p * width:(p + 1) * width]) for p in range(parts)] for _, v, _ in kept]
    books = [[cut[e][p] for e in range(min(codes, len(kept)))] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, entry)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = defaultdict(list)
            for row in cut:
                own[nearest(row[p], books[p])[1]].append(row[p])
            books[p] = [tuple(sum(c) // len(own[e]) for c in zip(*own[e])) if e in own else entry for e, entry in enumerate(books[p])]
    out, by_label = [], Counter()
    for (i, _, label), row in zip(kept, cut):
        best = [nearest(row[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), label))
        by_label[label] += out[-1][2]
    text = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return sorted(((i, code, error, by_label[label], text) for i, code, error, label in out), key=str)


@pytest.mark.parametrize("n, codes", [(300, 16), (200, 70), (9, 16), (1, 16)])
def test_vector_codes_like_plain_rounds(spark, n, codes):
    rng = random.Random(n)
    rows = [(i, [float(np.float32(rng.choice([rng.gauss(0, 1), rng.gauss(3, 0.1), 0.5]))) for _ in range(16)], rng.choice([1, 1, 1, 2, None])) for i in range(n)]
    rows += [(1000, None, 1), (1001, [0.0] * 15 + [None], 1), (1002, [0.0] * 15 + [float("nan")], 2), (1003, [float("inf")] * 16, None)]
    rows += [(2000 + i, rows[0][1], 1) for i in range(3)]  # copies
    vectors = spark.createDataFrame([(*r, "clash", 5) for r in rows], "vec_id long, embedding array<float>, label int, code string, vector int").repartition(3)
    got = sorted((tuple(r) for r in vector_codes.code_table(vectors, codes=codes).collect()), key=str)
    assert got == plain_codes(rows, codes=codes)


def test_vector_codes_of_odd_tables(spark):
    kind = "vec_id long, embedding array<float>, label int"
    none = spark.createDataFrame([(1, None, 1)], kind)
    assert vector_codes.code_table(none).count() == 0 and vector_codes.code_table(none.where("false")).count() == 0
    mixed = spark.createDataFrame([(1, [1.0] * 8, 1), (None, [2.0] * 8, 1), (3, [1.0] * 9, 1), (4, [], None), (5, [1.0] * 8, 2)], kind)
    assert sorted(str(r["vec_id"]) for r in vector_codes.code_table(mixed).collect()) == ["1", "5", "None"]
    with pytest.raises(ValueError):
        vector_codes.code_table(spark.createDataFrame([(1, [1.0] * 7, 1)], kind))


def test_nearest_entries_from_any_radius():
    rng = np.random.default_rng(4)
    for count, width in ((1, 1), (16, 8), (64, 2), (130, 3)):
        entries = rng.integers(-50, 50, (count, width))
        parts = rng.integers(-300, 300, (500, width))
        book = vector_codes.Codebook(entries)
        far = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
        for radius in (1, book.first_radius, 10_000):
            book.first_radius = radius
            index, best = book.nearest(parts)
            assert (index == far.argmin(axis=1)).all() and (best == far.min(axis=1)).all()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_like_its_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLES[name]) is None
