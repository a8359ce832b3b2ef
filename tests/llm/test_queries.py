"""Registered queries against SQL, and the pipeline against plain versions of its stages."""

import re
from pathlib import Path

import duckdb
import pytest
from test_secret_scan import plain as plain_spans
from test_simhash import fingerprint, plain_components

import corpus_pipeline
from threadloom.llm import decontaminate
from threadloom.llm.queries import ORACLES, QUERIES

SF = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    got, want = QUERIES[name](spark, str(SF)), duck.sql(ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = lambda data: sorted(tuple(map(str, r)) for r in data)
    sql = ", ".join(columns)
    assert rows(got.select(*columns).collect()) == rows(duck.sql(f"SELECT {sql} FROM ({ORACLES[name]})").fetchall())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {name: None for name, _ in corpus_pipeline.STAGES}
    for name, stage in corpus_pipeline.STAGES:
        before, columns = docs.collect(), docs.columns
        docs = stage(spark, docs, str(SF))
        after = docs.collect()
        kept[name] = before, after
        assert name == "encoding" or docs.columns == columns
        docs = spark.createDataFrame(after, docs.schema)

    before, after = kept["quality"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = {r.doc_id for r in after}
    good = [r.doc_id for r in before if labels.get(r.doc_id) == 1]
    assert sum(i in left for i in good) >= 0.97 * len(good)

    before, after = kept["near_duplicates"]
    codes = {r.doc_id: fingerprint(r.text, 4) for r in before}
    pairs = [(a, b) for a in codes for b in codes if (codes[a] ^ codes[b]).bit_count() <= 4]
    assert {r.doc_id for r in after} == set(plain_components(pairs).values())

    before, after = kept["decontamination"]
    words = lambda t: b" " + b" ".join(decontaminate.words_of((t or "").encode())) + b" "
    items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    holds = {r.doc_id for r in before if any(i in words(r.text) for i in items)}
    dropped = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert holds <= dropped and len(dropped) <= len(holds) + 2

    before, after = kept["secrets"]
    texts = {r.doc_id: r for r in after}
    for r in before:
        spans = plain_spans(r.text or "")
        assert (texts[r.doc_id].text == r.text) == (not spans)
        assert not spans or "[secret]" in texts[r.doc_id].text
        assert texts[r.doc_id].n_chars == len(texts[r.doc_id].text)

    before, after = kept["encoding"]
    assert len(after) == len(before) and all(r.round_trip and r.n_tokens == len(r.ids) for r in after)


def test_pipeline_edges(spark, tmp_path):
    from edges import edge_docs, empty_docs

    for docs in (edge_docs(spark), empty_docs(spark)):
        for name, stage in corpus_pipeline.STAGES:
            made = stage(spark, docs, str(SF))
            assert name == "encoding" or made.columns == docs.columns
            made.collect()
    kept = corpus_pipeline.keep_first_of_near_duplicates(spark, edge_docs(spark), str(SF)).collect()
    assert sorted(r.doc_id or 0 for r in kept) == [0, 1, 2, 5, 6, 7, 8]
