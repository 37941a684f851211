"""Periodic runs against a search of all periods."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from loadlens.llm import periodic_runs
from loadlens.llm.common import located
from loadlens.llm.queries import with_planted_runs

FOLDER = "/root/testdata/sf0.001"


def brute_runs(words):
    """(start, length, period) by comparing all words that are q apart, for every q."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def made_up(rng, most=150):
    n, letters = rng.randint(0, most), rng.choice([1, 2, 3, 30])
    words = [f"w{rng.randrange(letters)}" for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n else 0):
        s, p = rng.randrange(n), rng.randint(1, 25)
        for i in range(s + p, min(n, s + rng.randint(1, n))):
            words[i] = words[i - p]
    return words


def test_z_function():
    rng = random.Random(1)
    for _ in range(300):
        s = [rng.randrange(2) for _ in range(rng.randint(0, 30))]
        z = periodic_runs.z_function(s)
        assert z == [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]


def test_random_texts(spark):
    rng = random.Random(7)
    texts = [" ".join(made_up(rng)) for _ in range(400)]
    docs = located(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {r.doc_id: r for r in periodic_runs.collapse(docs, ["doc_id"]).collect()}
    for i, text in enumerate(texts):
        words, r = split(text), got[i]
        runs = brute_runs(words)
        assert [tuple(x) for x in r.runs] == runs and r.n_words == len(words) and r.collapsed == brute_collapse(words, runs)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "BATCH_WORDS", 500)
    long = "x y " * 40_000 + " ".join(str(i) for i in range(100_000)) + " z" * 50_000
    texts = [(1, "a b " * 5), (1, "a b " * 5), (None, "c " * 9), (2, None), (3, ""), (4, "\x0b \t"), (5, long), (6, "é é " * 6)]
    docs = located(spark.createDataFrame([(i, t, "o", 1) for i, t in texts], "doc_id long, text string, runs string, start int"), "at")
    rows = periodic_runs.collapse(docs, ["doc_id"], "at").collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    got = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in rows), key=key)
    runs = {1: [(0, 10, 2)], None: [(0, 9, 1)], 5: [(0, 80_000, 2), (180_000, 50_000, 1)], 6: [(0, 6, 1)]}
    want = [(i, runs.get(i, []), brute_collapse(split(t), runs.get(i, []))) for i, t in texts]
    assert got == sorted(want, key=key)
    assert periodic_runs.collapse(located(spark.createDataFrame([], "doc_id long, text string")), ["doc_id"]).count() == 0


@pytest.mark.parametrize("runs,best", [([(0, 6, 1), (9, 12, 2)], (0, 6, 1)), ([(5, 8, 2), (0, 12, 3)], (0, 12, 3)), ([(4, 9, 2), (0, 4_000_001, 1_000_000)], (4, 9, 2)), ([], None)])
def test_strongest(spark, runs, best):
    row = spark.createDataFrame([(runs,)], "runs array<struct<start:long,length:long,period:long>>")
    got = row.select(periodic_runs.strongest(F.col("runs")).alias("r")).first().r
    assert (tuple(got) if got else None) == best


def test_query(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    rows = {r.doc_id: r for r in entry.queries()["op13_periodic_runs"](spark, FOLDER).collect()}
    assert len(rows) == len(table)
    for doc_id, text in table:
        words = planted(doc_id, split(text))
        runs, r = brute_runs(words), rows[doc_id]
        digest = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.n_runs == len(runs) and r.runs_sha256 == digest
        assert r.collapsed_sha256 == hashlib.sha256(brute_collapse(words, runs).encode()).hexdigest()
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=None)
        want = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r.start, r.length, r.period, r.exponent_milli) == want
    assert any(r.n_runs for r in rows.values())


def test_planting_leaves_other_documents(spark):
    docs = spark.createDataFrame([(i, f"a  b\tc d e {i}") for i in range(60)] + [(None, "x"), (61, None)], "doc_id long, text string")
    for r in with_planted_runs(docs).collect():
        words = split(f"a  b\tc d e {r.doc_id}")
        if r.doc_id is not None and r.doc_id < 60:
            assert split(r.text) == planted(r.doc_id, words) and (zlib.crc32(str(r.doc_id).encode()) % 10 == 0 or "\t" in r.text)
