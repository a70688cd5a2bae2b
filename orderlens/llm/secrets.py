"""Secret scans: fixed patterns, and character Markov models of random strings and of ordinary identifiers. Only SQL functions.

Two first-order models over the characters of ALPHABET give each long run of such characters a log-likelihood ratio per
step: how much likelier it is as a random string than as an identifier or a word. The models are bigram counts of labelled
samples: random ones are digests in the usual spellings, made from row numbers, with the pattern matches of the sampled
documents; ordinary ones are the sampled documents' words without digits. Their counts have one row per pair of characters.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: The patterns of the base kinds, in their order. Runs of one class are maximal, so a lower bound on their
#: length within the pattern finds the same matches as dropping short ones; that does not hold for "assign".
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_LENGTH = 8
#: Runs that the models judge, and the ratio per step above which one is taken for random.
SHORTEST = 20
RUN = rf"[A-Za-z0-9+/_=-]{{{SHORTEST},}}"
#: What may join a secret to its neighbours, and the pieces of a run without it.
SEPARATORS = "+/_=-"
PIECE = rf"[A-Za-z0-9]{{{SHORTEST},}}"
RATIO = 0.6
#: Documents, and made-up random strings, that the models learn from (about; chosen by hash of doc_id).
SAMPLE_DOCUMENTS, SAMPLE_STRINGS = 3000, 4000

KINDS = ("assign", "access", "hex", "markov")
SPAN = "array<struct<start: bigint, rank: int, kind: string, end: bigint>>"


def _matches(text: Column, pattern: str, kind: str, accepted=None) -> Column:
    """Spans of the matches, by code point, of texts that have any: what lies between them gives their places.

    The running sum is kept as an array, whose cost grows with the square of a text's number of matches; it is computed
    only for texts with a match, and takes a second at ten thousand matches.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    widths = F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda b, m: (F.length(b) + F.length(m)).cast("long"))
    ends = F.aggregate(widths, F.array(F.lit(0).cast("long")), lambda done, w: F.array_append(done, F.element_at(done, -1) + w), lambda done: F.slice(done, F.lit(2), F.size(done) - 1))
    spans = F.zip_with(ends, found, lambda end, m: F.struct(
        (end - F.length(m)).alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"), m.alias("match")))
    if accepted is not None:
        spans = F.filter(spans, accepted)
    return F.when(F.coalesce(F.rlike(text, F.lit(pattern)), F.lit(False)), spans).otherwise(
        F.array().cast("array<struct<start: bigint, rank: int, kind: string, end: bigint, match: string>>"))


def _plain(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["kind"].alias("kind"), s["end"].alias("end")))


def _pairs(strings: DataFrame) -> DataFrame:
    """pair, n: counts of neighbouring characters of strings(word)."""
    letters = F.split("word", "")
    size = F.size(letters) - 1
    pairs = F.zip_with(F.slice(letters, F.lit(1), size), F.slice(letters, F.lit(2), size), lambda a, b: F.concat(a, b))
    return strings.where(F.length("word") > 1).select(F.explode(pairs).alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))


def train(docs: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS, sample_strings: int = SAMPLE_STRINGS) -> np.ndarray:
    """The table of log-likelihood ratios by first and second character, flattened; 0 in the row and column of others."""
    spark = docs.sparkSession
    total = docs.count()
    part = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20)) < F.lit(min(1.0, sample_documents / max(1, total)) * (1 << 20))
    words = docs.where(part).select(F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[A-Za-z0-9+/_=-]{4,}"), F.lit(0))).alias("word"))
    ordinary = words.where(~F.rlike("word", F.lit("[0-9+/=]")))
    caught = words.where(F.rlike("word", F.lit(f"{HEX}|{ACCESS}")))
    digest = F.sha2(F.concat(F.lit("random string "), F.col("id").cast("string")), 256)
    spelled = F.array(F.base64(F.unhex(digest)), F.translate(F.base64(F.unhex(digest)), "+/=", "-_"), digest, F.upper(F.conv(F.substring(digest, 1, 15), 16, 36)), F.lower(F.conv(F.substring(digest, 20, 15), 16, 36)))
    made = spark.range(sample_strings).select(F.explode(spelled).alias("word"))
    counts = _pairs(ordinary).withColumn("label", F.lit(0)).union(_pairs(made.union(caught)).withColumn("label", F.lit(1)))
    size = len(ALPHABET)
    tables = np.full((2, size, size), 0.05)
    for row in counts.collect():     # two labels, pairs of one alphabet
        first, second = map(ALPHABET.find, row["pair"])
        if first >= 0 and second >= 0:
            tables[row["label"], first, second] += row["n"]
    # little is known of what follows rare characters: their rows lean on the overall counts
    overall = tables.sum(axis=1, keepdims=True)
    tables = tables + 20 * overall / overall.sum(axis=2, keepdims=True)
    logs = np.log(tables / tables.sum(axis=2, keepdims=True))
    out = np.zeros((size + 1, size + 1))
    out[1:, 1:] = logs[1] - logs[0]
    return out.ravel()


def ratio(run: Column, table: np.ndarray) -> Column:
    """The log-likelihood ratio per step of a run of characters."""
    numbers = F.transform(F.split(run, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    size = F.size(numbers) - 1
    steps = F.zip_with(F.slice(numbers, F.lit(1), size), F.slice(numbers, F.lit(2), size),
                       lambda a, b: F.element_at(F.lit(table), a * (len(ALPHABET) + 1) + b + 1))
    return F.aggregate(steps, F.lit(0.0), lambda s, x: s + x) / F.greatest(size, F.lit(1))


def _left_over(run: Column) -> Column:
    """The parts of a run that no base span covers; separators next to a base span belong to no part."""
    cuts = F.filter("base_spans", lambda b: (b["start"] < run["end"]) & (b["end"] > run["start"]))
    parts = "array<struct<start: bigint, rank: int, kind: string, end: bigint, match: string>>"

    def part(start: Column, end: Column) -> Column:
        text = F.substr(run["match"], (start - run["start"] + 1).cast("int"), F.greatest(F.lit(0), end - start).cast("int"))
        head = F.when(start > run["start"], F.length(text) - F.length(F.ltrim(text, F.lit(SEPARATORS)))).otherwise(0)
        text = F.substr(text, (head + 1).cast("int"))
        text = F.when(end < run["end"], F.rtrim(text, F.lit(SEPARATORS))).otherwise(text)
        return F.when(F.length(text) > 0, F.array(F.struct(
            (start + head).cast("long").alias("start"), run["rank"].alias("rank"), run["kind"].alias("kind"), (start + head + F.length(text)).cast("long").alias("end"), text.alias("match")))
        ).otherwise(F.array()).cast(parts)

    start = F.struct(run["start"].alias("at"), F.array().cast(parts).alias("parts"))
    step = lambda done, b: F.struct(F.greatest(done["at"], b["end"]).alias("at"), F.concat(done["parts"], part(done["at"], b["start"])).alias("parts"))
    return F.when(F.size(cuts) == 0, F.array(run).cast(parts)).otherwise(
        F.aggregate(cuts, start, step, lambda done: F.concat(done["parts"], part(done["at"], run["end"]))))


def with_spans(docs: DataFrame, table: np.ndarray, threshold: float = RATIO) -> DataFrame:
    """docs with the columns base_spans and secret_spans, of type SPAN, by start and kind; a null text has none.

    What base spans leave of a run is judged part by part; of a part that is not taken as a whole, the pieces between separators.
    """
    text = F.coalesce("text", F.lit(""))
    found = docs.withColumns({
        "_assign": _matches(text, ASSIGN, "assign", lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= ASSIGN_LENGTH),
        "_access": _matches(text, ACCESS, "access"),
        "_hex": _matches(text, HEX, "hex"),
        "_runs": _matches(text, RUN, "markov"),
    })
    found = found.withColumn("base_spans", F.array_sort(F.concat(_plain(F.col("_assign")), _plain(F.col("_access")), _plain(F.col("_hex")))))
    found = found.withColumn("_parts", F.flatten(F.transform("_runs", _left_over)))

    def taken(part: Column) -> Column:
        pieces = _matches(part["match"], PIECE, "markov", lambda s: ratio(s["match"], table) > threshold)
        moved = F.transform(_plain(pieces), lambda s: F.struct((s["start"] + part["start"]).alias("start"), s["rank"].alias("rank"), s["kind"].alias("kind"), (s["end"] + part["start"]).alias("end")))
        return F.when((F.length(part["match"]) >= SHORTEST) & (ratio(part["match"], table) > threshold), _plain(F.array(part))).otherwise(moved)

    judged = F.flatten(F.transform("_parts", taken))
    return found.withColumn("secret_spans", F.array_sort(F.concat("base_spans", judged))).drop("_assign", "_access", "_hex", "_runs", "_parts")


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets(docs: DataFrame, table: np.ndarray | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov for every row of docs(doc_id, text).

    Null and empty texts have no spans. Repeated rows come back repeated; an empty table gives no rows; other columns are
    not read, so their names don't matter.
    """
    table = train(docs) if table is None else table
    found = with_spans(docs.select("doc_id", "text"), table)

    def count(kind: str) -> Column:
        return F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(_listed("base_spans"), 256).alias("base_sha256"),
                        _listed("secret_spans").alias("spans"), count("markov"))


def redacted(docs: DataFrame, table: np.ndarray | None = None, mark: str = "[SECRET]") -> DataFrame:
    """docs, all columns, with every span of the texts replaced by a mark (overlapping ones by a single one)."""
    table = train(docs) if table is None else table
    found = with_spans(docs, table)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(done: Column, span: Column) -> Column:
        gap = F.substr(F.col("text"), (done["at"] + 1).cast("int"), F.greatest(F.lit(0), span["start"] - done["at"]).cast("int"))
        return F.struct(F.greatest(done["at"], span["end"]).alias("at"),
                        F.when(span["start"] >= done["at"], F.concat(done["out"], gap, F.lit(mark))).otherwise(done["out"]).alias("out"))

    text = F.aggregate("secret_spans", start, step, lambda done: F.concat(done["out"], F.substr(F.col("text"), (done["at"] + 1).cast("int"))))
    return found.withColumn("text", F.when(F.size("secret_spans") > 0, text).otherwise(F.col("text"))).select(docs.columns)
