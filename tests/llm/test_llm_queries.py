import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__
import corpus_pipeline
from parcelmart.llm.common import table, written
from parcelmart.llm.decontaminate import find_leaks
from parcelmart.llm.licence_texts import MORE_NOTICES, NOTICES, published_texts
from parcelmart.llm.ngram_join import near_duplicates
from parcelmart.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in os.listdir(SF):
        path = f"{SF}/{name}"
        con.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def plain(frame, columns):
    def value(v):
        if pd.api.types.is_scalar(v) and pd.isna(v):
            return "-"
        return float(v) if isinstance(v, int | float) else str(v)

    return sorted(str(tuple(value(v) for v in row)) for row in frame[columns].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_with_sql(spark, tables, name):
    got, want = QUERIES[name](spark, SF).toPandas(), tables.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got, sorted(got.columns)) == plain(want, sorted(got.columns))


def test_license_scan_of_whole_licences_against_sql(spark, tmp_path):
    texts = published_texts()
    rows = [f"Copyright (c) 2020 Foo\n\n{text}" for _, text in texts] + [text.upper().replace("\n", " \n* ") for _, text in texts]
    rows += [f"Copyright Foo Inc. and others\n{text}" for _, text in texts] + [text + "\none clause more" for _, text in texts]
    rows += [f"first words\n  {line.upper()}\nlast words" for line in NOTICES | MORE_NOTICES]
    rows += ["Released under the MIT Licence.\nCopyright the Foo Group\nCopyright Law of 1976\nCopyright holder Foo\ncopyright Foo", "", None]
    pd.DataFrame({"doc_id": range(len(rows)), "text": rows}).to_parquet(tmp_path / "documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet')")
    got, want = QUERIES["op7_license_scan"](spark, str(tmp_path)).toPandas(), con.sql(ORACLES["op7_license_scan"]).df()
    columns = sorted(got.columns)
    assert plain(got, columns) == plain(want, columns)
    by_id = got.set_index("doc_id").sort_index()
    assert by_id.licence[: 3 * len(texts)].notna().all() and by_id.licence[3 * len(texts) :].isna().all()
    assert (by_id.notices[4 * len(texts) : -3] != "").all()


EDGE_TEXT = "one two three four five six seven"
EDGES = [(None, None), (None, ""), (1, None), (2, ""), (3, EDGE_TEXT), (3, EDGE_TEXT), (4, EDGE_TEXT), (None, EDGE_TEXT), (7, "other words stand here alone")]


def test_stages_on_nulls_repeats_and_very_long_texts(spark):
    """Each stage by itself on rows whose results are known; a column is named as one of the stages' own."""
    item = table(spark, SF, "benchmark").first().text
    long = " ".join(f"w{k % 7919}x{k % 31}" for k in range(150_000))
    rows = EDGES + [(5, long), (6, f"so it says {item} and goes on")]
    kinds = {f.name: f.dataType.simpleString() for f in table(spark, SF, "documents").schema}
    schema = ", ".join(f"{name} {kind}" for name, kind in kinds.items()) + ", cls string, keys long"
    values = [[{"doc_id": i, "text": t, "n_chars": len(t or "")}.get(c) for c in kinds] + ["x", 1] for i, t in rows]
    docs = written(spark.createDataFrame(values, schema), "edges")
    held = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    (_, classify), (_, lines), (_, copies), (_, leaks), (_, encode) = corpus_pipeline.STAGES
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
    good = held(classify(spark, docs, SF))
    assert all(good.count(r) in (0, rows.count(r)) for r in rows) and set(good) <= set(rows)
    # of equal lines the first by id stays, null first
    assert held(lines(spark, docs, SF)) == sorted(((i, "" if t == EDGE_TEXT and i is not None else t) for i, t in rows), key=str)
    # of each group the smallest id stays, null last; texts without a word are in no group
    alone = [r for r in rows if r[1] != EDGE_TEXT]
    assert held(copies(spark, docs, SF)) == sorted([*alone, (3, EDGE_TEXT)], key=str)
    assert held(leaks(spark, docs, SF)) == sorted((r for r in rows if r[0] != 6), key=str)
    coded = encode(spark, docs, SF).collect()
    assert sorted((r.doc_id for r in coded), key=str) == sorted((i for i, _ in rows), key=str)
    assert all(r.round_trip for r in coded) and sum(not r.n_ids for r in coded) == 4


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op1_hnsw"}))
def test_other_queries_give_a_row_for_each_document(spark, name):
    assert QUERIES[name](spark, SF).count() == table(spark, SF, "documents").count()


def test_nearest_neighbours_query(spark):
    got = QUERIES["op1_hnsw"](spark, SF)
    assert got.columns[:4] == ["query_id", "rank", "vec_id", "score"]
    assert got.groupBy("query_id").count().filter("count <> 10").count() == 0


def test_all_are_registered():
    names = {k.split("_")[0] for k in __spark_entry__.queries()}
    assert {f"op{n}" for n in range(1, 14)} <= names and "pipeline" in __spark_entry__.queries()


def test_pipeline_stage_by_stage(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    (_, classify), (_, lines), (_, copies), (_, leaks), (_, encode) = corpus_pipeline.STAGES
    good = written(classify(spark, docs, SF), "t1")
    scores = {r.doc_id: r.predicted for r in QUERIES["op4_quality_classifier"](spark, SF).collect()}
    assert {r.doc_id for r in good.collect()} == {i for i, p in scores.items() if p == 1} and good.columns == columns
    cut = written(lines(spark, good, SF), "t2")
    assert cut.columns == columns and cut.count() == good.count() and cut.filter("n_chars <> length(text)").count() == 0
    one = written(copies(spark, cut, SF), "t3")
    found = near_duplicates(cut)
    assert one.columns == columns
    assert {r.doc_id for r in one.collect()} == {r.component_id for r in found.collect()}
    clean = written(leaks(spark, one, SF), "t4")
    bad = {r.doc_id for r in find_leaks(one, table(spark, SF, "benchmark")).collect()}
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == {r.doc_id for r in one.collect()} - bad
    coded = encode(spark, clean, SF)
    assert coded.filter("not round_trip").count() == 0
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, whole.collect())) == sorted(map(str, coded.collect()))


def test_stages_take_empty_tables_and_other_columns(spark):
    empty = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
