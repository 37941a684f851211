"""Exact dedup over several batches: the state of earlier calls goes on."""

import json
import os

import pytest
from pyspark.sql import functions as F

from loadlens.llm import exact_dedup

DOCS = "doc_id long, text string, key string, loc string, n long"


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, "k", "l", 9) for i, t in rows], DOCS)


def _brute(rows):
    """{doc_id: (keep_id, group_size)}; ids are unique, None sorts last."""
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate({c: None for c in (32, 9, 10, 11, 12, 13)}), []).append((-len(t or ""), i is None, i))
    return {i: (min(g)[2], len(g)) for g in groups.values() for _, _, i in g}


def _got(found):
    rows = found.collect()
    assert all(r.kept == (r.doc_id == r.keep_id) for r in rows)
    return {r.doc_id: (r.keep_id, r.group_size) for r in rows}


def _read_rows(folder):
    """Files that the stream read, batch by batch, from its own record."""
    names = []
    for path, _, files in os.walk(f"{folder}/state/sources/0"):
        for name in files:
            if not name.startswith("."):
                with open(f"{path}/{name}") as lines:
                    names += [json.loads(line)["path"] for line in lines.read().splitlines()[1:]]
    return names


def test_batches_continue_one_state(spark, tmp_path):
    folder = str(tmp_path)
    first = [(2, "one two"), (3, "onetwo"), (4, None), (5, "other"), (6, "é" * 20_000)]
    second = [(1, "one two"), (7, "one  two"), (8, "new"), (9, "\n"), (None, "é" * 20_000), (10, "other ")]
    exact_dedup.append_batch(_frame(spark, first), folder, "a")
    assert _got(exact_dedup.settle(spark, folder, "a")) == _brute(first)
    seen = set(_read_rows(folder))
    exact_dedup.append_batch(_frame(spark, second), folder, "b")
    found = _got(exact_dedup.settle(spark, folder, "b"))
    assert found == _brute(first + second) and found[2] == (7, 4) and found[5] == (10, 2)
    files = _read_rows(folder)
    assert len(files) == len(set(files)) and all("/log/a/" in f for f in seen) and any("/log/b/" in f for f in set(files) - seen)
    assert _got(exact_dedup.settle(spark, folder)) == found  # nothing new: nothing is counted twice


def test_batch_names_serve_once(spark, tmp_path):
    folder = str(tmp_path)
    exact_dedup.append_batch(_frame(spark, [(1, "x")]), folder, "a")
    with pytest.raises(Exception, match="(?i)exist"):
        exact_dedup.append_batch(_frame(spark, [(2, "x")]), folder, "a")
    assert _got(exact_dedup.settle(spark, folder, "a")) == {1: (1, 1)}


def test_empty_batches(spark, tmp_path):
    folder = str(tmp_path)
    exact_dedup.append_batch(_frame(spark, []), folder, "a")
    assert exact_dedup.settle(spark, folder, "a").count() == 0
    exact_dedup.append_batch(_frame(spark, [(1, ""), (2, None)]), folder, "b")
    assert _got(exact_dedup.settle(spark, folder, "b")) == {1: (1, 2), 2: (1, 2)}


def test_shared_digest_is_refused(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    monkeypatch.setattr(exact_dedup, "_key", lambda bits, turn: F.unhex(F.lit("00")))
    exact_dedup.append_batch(_frame(spark, [(1, "x"), (2, "y")]), folder, "a")
    with pytest.raises(ValueError, match="share a digest"):
        exact_dedup.settle(spark, folder, "a")
