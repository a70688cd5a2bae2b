"""The pipeline's stages take effect and keep the columns; the named queries agree with their SQL."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from orderlens.llm.queries import ORACLES, QUERIES
from tests.conftest import SF_DIR
from tests.llm import brute


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], SF_DIR).cache())
    return out


def test_stages_keep_columns_and_shrink(stages):
    names = stages[0].columns
    assert all(s.columns == names for s in stages[:-1])
    counts = [s.count() for s in stages[:-1]]
    assert counts == sorted(counts, reverse=True) and counts[3] == counts[4] and 0 < counts[4] < counts[0]


def test_near_duplicates_stage_links_from_eighty_percent(spark, stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[1].collect()]
    want = {i for i, (_, component) in brute.near_duplicates(rows, 80).items() if i == component}
    assert {r["doc_id"] for r in stages[2].collect()} == want
    base = [f"w{i}" for i in range(100)]
    pair = [" ".join(base), " ".join("x" if i in (30, 60) else w for i, w in enumerate(base))]     # 86 of 106 shingles: 0.81
    far = " ".join("y" if i in (20, 40, 80) else w for i, w in enumerate(base))                    # 81 of 111: 0.73
    docs = spark.createDataFrame(list(enumerate([*pair, far])), "doc_id long, text string")
    assert {r["doc_id"] for r in corpus_pipeline.without_near_duplicates(spark, docs, SF_DIR).collect()} == {0, 2}


def test_no_item_and_no_secret_is_left(stages, spark):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    before, after = ({r["doc_id"]: r["text"] for r in s.collect()} for s in stages[2:4])
    assert set(after) == {i for i, t in before.items() if not brute.contamination(t, items)[1]}
    for r in stages[4].collect():
        assert not [s for s in brute.base_spans(r["text"]) if s[2] != "assign"] and r["n_chars"] == len(r["text"])
        assert bool(brute.base_spans(after[r["doc_id"]])) <= (r["text"] != after[r["doc_id"]])


def test_packing_holds_every_document(stages):
    rows = stages[5].collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in stages[4].collect()}
    fill = {}
    for r in rows:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert max(fill.values()) <= 2048 and len(fill) <= -(-sum(fill.values()) // 2048) * 1.02 + 1


def test_awkward_documents_pass_through_all_stages(spark, tmp_path):
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{SF_DIR}/{table}.parquet").write.parquet(f"{tmp_path}/{table}.parquet")
    rows = [(None, None, "en", "s", None, 1), (1, "", "en", "s", 0, 2), (1, "", "en", "s", 0, 2), (2, None, None, None, None, 3), (3, "a b", "de", "s", 3, 4), (4, "word " * 20000, "en", "s", 0, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in out} == {None, 1, 2, 3, 4} and sum(r["doc_id"] == 1 for r in out) == 1
    docs.where("false").write.parquet(f"{tmp_path}/none/documents.parquet")
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{tmp_path}/{table}.parquet").where("false").write.parquet(f"{tmp_path}/none/{table}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "conversations", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    got, want = QUERIES[name](spark, SF_DIR).toPandas(), connection.execute(ORACLES[name]).fetchdf()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    a, b = (x[columns].astype(str).sort_values(columns, ignore_index=True) for x in (got, want))
    assert a.equals(b)


def test_held_out_quality_of_the_classifiers(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op8_language_id"](spark, SF_DIR).join(docs, "doc_id").where("held_out").selectExpr("avg(int(lang_pred = lang))").first()[0]
    assert found > 0.95


def test_whole_string_removal_over_the_documents(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    want = brute.without_repeats([r["text"] for r in rows], 400)
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op6_suffix_array_dedup"](spark, SF_DIR).collect()}
    assert got == {r["doc_id"]: w for r, w in zip(rows, want)}
