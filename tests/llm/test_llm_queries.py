"""Registered queries against SQL, brute force or held-out labels; the pipeline stage by stage."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from test_llm_operators import brute_fingerprint, brute_repeats, components_of

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not there")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.fixture(scope="module")
def texts(tables):
    return tables.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


def test_simhash_query(spark, texts):
    got = {r.doc_id: r for r in entry.queries()["op7_simhash"](spark, FOLDER).collect()}
    prints = {i: brute_fingerprint(t) for i, t in texts}
    roots = components_of(sorted(set(prints.values())))
    least = {}
    for i in sorted(prints):
        least.setdefault(roots[prints[i]], i)
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == {i: (f"{p:016x}", least[roots[p]]) for i, p in prints.items()}


def test_suffix_dedup_query(spark, texts):
    got = entry.queries()["op4_suffix_dedup"](spark, FOLDER).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_repeats(texts)


@pytest.mark.parametrize("name,label", [("op2_toxicity", "toxic"), ("op10_quality", "quality")])
def test_held_out_accuracy(spark, name, label):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    truth = dict(con.execute(f"SELECT doc_id, {label} FROM '{folder}/labels.parquet'").fetchall())
    rows = entry.queries()[name](spark, folder).collect()
    assert all(0 <= r.score <= 1 for r in rows) and len(rows) == 1000
    hits = [r.predicted == truth[r.doc_id] for r in rows if r.held_out and r.doc_id in truth]
    assert sum(hits) / len(hits) > 0.93


def test_pipeline_stages(spark, tables, texts):
    ran = {}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        ran[name] = ({r.doc_id for r in docs.collect()}, out.collect(), out.columns)
        if name != "source_mixing":
            assert out.columns == columns
            docs = spark.createDataFrame(ran[name][1], docs.schema) if ran[name][1] else docs.limit(0)
    by_id = dict(texts)
    before, rows, _ = ran["exact_dedup"]
    squeeze = lambda t: "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")
    groups = {}
    for i in before:
        groups.setdefault(squeeze(by_id[i]), []).append(i)
    assert {r.doc_id for r in rows} == {min(g, key=lambda i: (-len(by_id[i] or ""), i)) for g in groups.values()}
    before, rows, _ = ran["simhash_near_dedup"]
    prints = {i: brute_fingerprint(by_id[i]) for i in before}
    roots = components_of(sorted(set(prints.values())))
    least = {}
    for i in sorted(before):
        least.setdefault(roots[prints[i]], i)
    assert {r.doc_id for r in rows} == set(least.values())
    leaks = {r[0] for r in tables.execute(entry.oracle_sql()["op8_decontamination"]).fetchall() if r[5]}
    before, rows, _ = ran["benchmark_decontamination"]
    assert {r.doc_id for r in rows} == before - leaks
    before, rows, _ = ran["source_mixing"]
    assert {r.doc_id for r in rows} <= before and all(r.text == by_id[r.doc_id] for r in rows)
