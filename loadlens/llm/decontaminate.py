"""Benchmark decontamination with one Aho-Corasick automaton over item words."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import free_name, keep_located, located, small_batches, whole_text, write_table

WINDOW = 10
#: UTF-8 bytes of words: digits, letters (capitals are lowered) and all bytes beyond ASCII; all else divides words.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: Bytes of benchmark text that one automaton holds; a larger benchmark is scanned in blocks.
BLOCK_BYTES = 8 * 1024 * 1024


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


class Windows:
    """An automaton over numbered words that finds every window of every item."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.number: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words_of(text)]
            if ids:
                size = min(window, len(ids))
                for i in range(len(ids) - size + 1):
                    found.setdefault(tuple(ids[i : i + size]), set()).add(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, owners in found.items():
            self.automaton.add_word(key, (len(key), frozenset(owners)))
        self.empty = not found
        if found:
            self.automaton.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[list[list[int]], set[str]]:
        """Maximal runs [first, last] of hit words in one pass, and the items found."""
        runs: list[list[int]] = []
        items: set[str] = set()
        if self.empty or not words:
            return runs, items
        number = self.number
        # Words that no item has are 0 and lead the automaton back to its root.
        ids = tuple([number.get(w, 0) for w in words])
        for end, (size, owners) in self.automaton.iter(ids):
            items |= owners
            start = end - size + 1
            while runs and start <= runs[-1][1] + 1:
                start = min(start, runs.pop()[0])
            runs.append([start, end])
        return runs, items


def original_spans(text: str, runs: list[list[int]]) -> list[tuple[int, int]]:
    """Runs of words as (start, end) code point offsets in the original text."""
    raw = text.encode("utf-8", "surrogatepass")
    edges = [m.span() for m in _WORD.finditer(raw)] if runs else []
    spans, at, points = [], 0, 0
    for first, last in runs:
        start, end = edges[first][0], edges[last][1]
        points += len(raw[at:start].decode("utf-8", "surrogatepass"))
        inside = len(raw[start:end].decode("utf-8", "surrogatepass"))
        spans.append((points, points + inside))
        at, points = end, points + inside
    return spans


_SCHEMA = "doc_id long, loc string, n_words long, runs array<array<long>>, items array<string>, spans array<struct<start:long,end:long>>"


def _scan_block(docs: DataFrame, items: list[tuple[str, str]], window: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = Windows(items, window)
        for pdf in batches:
            rows = []
            for doc_id, loc, text in zip(pdf["doc_id"], pdf["loc"], pdf["text"]):
                words = words_of(text)
                runs, found = finder.scan(words)
                spans = [{"start": a, "end": b} for a, b in original_spans(text, runs)]
                rows.append((doc_id, loc, len(words), runs, sorted(found - {None}), spans))
            out = pd.DataFrame(rows, columns=["doc_id", "loc", "n_words", "runs", "items", "spans"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return docs.mapInPandas(run, _SCHEMA)


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks of bounded size; one block at a time is on the driver."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), whole_text().alias("text"))
    size = F.octet_length("text") + 16
    total = rows.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    n = max(1, -(-total // block_bytes))
    if n == 1:
        yield [(r.item, r.text) for r in rows.collect()]
        return
    numbered = write_table(rows.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(2 * n))), "items")
    for b in range(2 * n):
        yield [(r.item, r.text) for r in numbered.where(F.col("block") == b).select("item", "text").collect()]


def scan(docs: DataFrame, benchmark: DataFrame, loc: str = "loc", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of located ``docs``: words, hit words, items found, spans of the original text.

    Words are runs of ASCII letters and digits (capitals lowered) and of all
    characters beyond ASCII. Each run of ``window`` item words is a pattern; a
    shorter item is one pattern, an item without words none. A benchmark
    beyond ``block_bytes`` is cut into blocks of items, each with its own
    automaton, and the hits are merged per document. NULL text has no words,
    an item without id hits words but is not listed, repeated rows give repeated rows.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(loc).alias("loc"), whole_text().alias("text"))
    parts = [_scan_block(rows, items, window) for items in _blocks(benchmark, block_bytes)]
    if len(parts) == 1:
        found = parts[0]
    else:
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part)
        found = found.groupBy("loc").agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list("runs")).alias("runs"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            F.flatten(F.collect_list("spans")).alias("spans"),
        )
        found = found.withColumn("runs", _merged(F.array_sort("runs"), lambda r: r[0], lambda r: r[1], F.array, "array<array<bigint>>", 1))
        pair = lambda a, b: F.struct(a.alias("start"), b.alias("end"))
        found = found.withColumn(
            "spans", _merged(F.array_sort("spans"), lambda s: s["start"], lambda s: s["end"], pair, "array<struct<start:bigint,end:bigint>>", 0)
        )
    hit = F.aggregate("runs", F.lit(0).cast("long"), lambda acc, r: acc + r[1] - r[0] + 1)
    return found.select("loc", "doc_id", "n_words", hit.alias("n_hit"), "items", "spans")


def _merged(spans, start, end, make, kind: str, touch: int):
    """Union of sorted intervals that overlap or touch."""

    def step(acc, s):
        last = F.try_element_at(acc, F.lit(-1))
        joins = (F.size(acc) > 0) & (start(s) <= end(last) + touch)
        grown = make(start(last), F.greatest(end(last), end(s)))
        head = F.slice(acc, 1, F.size(acc) - 1)
        return F.when(joins, F.concat(head, F.array(grown))).otherwise(F.concat(acc, F.array(make(start(s), end(s)))))

    return F.aggregate(spans, F.array().cast(kind), step)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with its own columns, without the documents that hold a benchmark window."""
    loc = free_name("loc", docs.columns)
    rows = located(docs, loc)
    return keep_located(rows, loc, scan(rows, benchmark, loc).where("n_hit = 0").select("loc"))
