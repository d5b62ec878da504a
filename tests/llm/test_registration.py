"""What the driver sees: names, SQL, the pipeline and its stages."""

import re
import zlib

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from curbside.llm import queries

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator_and_the_pipeline():
    names = list(entry.queries())
    assert [sum(bool(re.match(rf"op{n}_", x)) for x in names) for n in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert len(corpus_pipeline.STAGES) == 5 and "op1_url_filter" in entry.oracle_sql()


def test_url_rules_equal_their_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{SF}/pages.parquet'")
    expected = sorted(con.sql(entry.oracle_sql()["op1_url_filter"]).fetchall())
    got = queries.QUERIES["op1_url_filter"](spark, SF).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(tuple, got)) == expected and len({r.verdict for r in got}) == 2


@pytest.mark.parametrize("name", ["op2_language_id", "op3_substring_dedup", "op4_toxicity", "op8_bpe", "op9_jaccard_join", "op10_fingerprints", "op13_decontamination"])
def test_one_row_per_document(spark, name):
    ids = sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
    found = queries.QUERIES[name](spark, SF).collect()
    assert sorted(r.doc_id for r in found) == ids
    for r in found:
        if "held_out" in r.asDict():
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1


def test_each_stage_does_its_part_to_all_that_was_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.stage(stage(spark, docs, SF), "test")
        assert out.dtypes == docs.dtypes, name
        rows, was = {r.doc_id: r for r in out.collect()}, {r.doc_id: r for r in docs.collect()}
        assert len(rows) == out.count() and set(rows) <= set(was)
        if name == "substring_dedup":
            assert set(rows) == set(was) and all(r.n_chars == len(r.text) for r in rows.values())
            from test_text_operators import removed_by_brute_force

            expected = removed_by_brute_force([r.text for r in was.values()], 35)
            assert [rows[i].text for i in was] == [kept for *_, kept in expected]
        else:
            assert all(rows[i] == was[i] for i in rows)
        if name == "jaccard_join":
            from test_text_operators import components_by_brute_force

            expected = components_by_brute_force([(i, r.text) for i, r in was.items()])
            assert set(rows) == {i for i, (_, c) in expected.items() if c == i}
        docs = out
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()} and len({r.doc_id for r in packed}) < before


def test_stages_take_odd_rows(spark, make_docs):
    rows = [(None, "the of and that was for it"), (1, None), (2, ""), (3, "the of and that was for it"), (3, "the of and that was for it"), (4, "x" * 100_000)]
    for docs in (make_docs(rows), make_docs([])):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert name == "best_fit_packing" or out.columns == docs.columns
            out.collect()
