from __future__ import annotations

import re

import duckdb
import pytest
from tests.llm.conftest import SF
from tests.llm.test_near_copies import brute as groups_by_force
from tests.llm.test_quality import brute as quality_by_force
from tools.compare import TABLES, rows_of

import corpus_pipeline
from riskweave.llm import pseudonyms, registry

QUERIES, SQL = registry.load()


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage is given and returns."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        made = corpus_pipeline.Staged(spark, "test").write(stage(spark, docs, SF), "stage")
        out.append((name, docs, made))
        docs = made
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(stages):
    assert [name for name, _, _ in stages] == ["quality rules", "near-copy removal", "personal data", "source mix", "piece encoding"]
    assert all(made.columns == given.columns for _, given, made in stages[:-1])


def test_quality_stage(stages):
    _, given, made = stages[0]
    assert set(rows(made)) == {i for i, r in rows(given).items() if quality_by_force(r.text)[-1]}


def test_near_copy_stage(stages):
    _, given, made = stages[1]
    groups = groups_by_force([(r.doc_id, r.text) for r in given.collect()], 5)
    assert sorted(r.doc_id for r in made.collect()) == sorted(i for i, (_, first) in groups.items() if i == first)


def test_personal_data_stage(stages):
    _, given, made = stages[2]
    maker = pseudonyms.Pseudonyms(corpus_pipeline.KEY)
    assert {i: r.text for i, r in rows(made).items()} == {i: maker.replaced(r.text)[0] for i, r in rows(given).items()}
    assert all(len(r.text) == r.n_chars for r in rows(made).values())
    emails = {m for r in rows(given).values() for m in re.findall(r"[\w.]+@[\w.]+[a-z]", r.text)}
    assert emails and not any(e in r.text for e in emails for r in rows(made).values())


def test_mix_stage(stages):
    _, given, made = stages[3]
    con = duckdb.connect()
    given_rows = [(r.doc_id, r.text, r.lang, r.source) for r in given.collect()]
    con.execute("CREATE TABLE given (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO given VALUES (?, ?, ?, ?)", given_rows)
    from riskweave.llm.queries_corpus import mixing_sql

    want = con.execute(mixing_sql(corpus_pipeline.MIX, "given", "SELECT doc_id FROM taken")).fetchall()
    assert sorted(r.doc_id for r in made.collect()) == sorted(w[0] for w in want)
    assert 0 < made.count() < given.count()


def test_encoding_stage(stages):
    _, given, made = stages[4]
    assert set(rows(made)) == set(rows(given)) and all(r.round_trip and r.n_pieces == len(r.ids) for r in rows(made).values())


def test_run_equals_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    want = stages[-1][2]
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_stages_take_empty_and_odd_tables(spark, documents_of, clashing):
    odd = clashing([(1, None, None, None), (1, None, None, None), (None, " ".join(f"w{i}" for i in range(80)), "en", "src1"), (2, "", "en", "src2"), (3, " ".join(f"w{i}" for i in range(90)), None, "src3")])
    for docs in (documents_of([]), odd):
        for name, stage in corpus_pipeline.STAGES:
            given = docs if name != "piece encoding" else docs.select("doc_id", "text", "lang", "source", "n_chars")
            made = stage(spark, given, SF)
            made.collect()
            if name != "piece encoding":
                assert made.columns == given.columns


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(SQL[name])
    assert got == rows_of([d[0] for d in cur.description], cur.fetchall())


def test_ten_queries_and_the_pipeline_are_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {n.split("_")[0] for n in names if re.match(r"op\d+_", n)} == {f"op{i}" for i in range(1, 11)} and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= names
