"""SimHash near-duplicates: fingerprints, popcount grid, exact distance, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import free_name, keep_located, located, small_batches, unsent, whole_text, write_table
from loadlens.llm.components import connected_components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: The 64 bits as 16 segments of 4; a count of 0 to 4 takes 3 bits of the cell number.
SEGMENTS, WIDTH, DIGIT = 16, 4, 3
#: A cell of more fingerprints is split by exact midpoints instead of being paired.
PAIRED_CELL = 4


def fingerprint(text: str, words: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text; a text without words has fingerprint 0."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    if len(parts) < words:
        shingles = [b" ".join(parts)]
    else:
        shingles = list(map(b" ".join, zip(*[parts[i:] for i in range(words)])))
    digest, seed = xxhash.xxh64_intdigest, SEED
    ones, step = np.zeros(64, dtype=np.int64), 1 << 14
    for at in range(0, len(shingles), step):
        h = np.array([digest(s, seed) for s in shingles[at : at + step]], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = ones * 2 > len(shingles)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, loc: str = "loc", words: int = SHINGLE) -> DataFrame:
    """(doc_id, loc, fp) of located ``docs``; NULL counts as the empty text."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fp = np.array([fingerprint(t, words) for t in pdf["text"]], dtype="<u8").view("<i8")
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "loc": pdf["loc"], "fp": fp})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(loc).alias("loc"), whole_text().alias("text"))
    return rows.mapInPandas(run, "doc_id long, loc string, fp long")


def _segment(fp: Column, i: int) -> Column:
    return F.bit_count(F.shiftrightunsigned(fp, WIDTH * i).bitwiseAND(F.lit((1 << WIDTH) - 1)))


def cell_of(fp: Column) -> Column:
    """The vector of segment popcounts as one number, a digit per segment."""
    return sum((F.shiftleft(_segment(fp, i).cast("long"), DIGIT * i) for i in range(1, SEGMENTS)), _segment(fp, 0).cast("long"))


def _cells_near(fp: Column, own: Column) -> Column:
    """All cells within Manhattan distance 1 of a fingerprint's own cell.

    The Manhattan distance of two popcount vectors is at most the bit distance
    of the fingerprints. Two vectors at distance 2 or less have a vector
    within 1 of both, so their fingerprints meet in at least one cell.
    """
    near = [own]
    for i in range(SEGMENTS):
        ones, unit = _segment(fp, i), 1 << (DIGIT * i)
        near += [F.when(ones < WIDTH, own + F.lit(unit)), F.when(ones > 0, own - F.lit(unit))]
    return F.array_compact(F.array(*near))


def _midpoints(fp: Column, own: Column, cell: Column) -> Column:
    """The 64-bit values within one bit of ``fp`` whose popcount vector is ``cell``."""
    diff = cell - own
    up = diff > 0
    segment = F.round(F.log2(F.abs(diff).cast("double")) / DIGIT).cast("int")

    bits = F.transform(F.sequence(F.lit(0), F.lit(WIDTH - 1)), lambda b: F.call_function("shiftleft", F.lit(1).cast("long"), segment * WIDTH + b))
    fitting = F.filter(bits, lambda bit: (fp.bitwiseAND(bit) == 0) == up)
    return F.when(diff == 0, F.array(fp)).otherwise(F.transform(fitting, lambda bit: fp.bitwiseXOR(bit)))


def links(distinct: DataFrame, paired_cell: int = PAIRED_CELL) -> DataFrame:
    """Edges (a, b) that connect all of ``distinct`` (fp) at a bit distance of 2 or less.

    Fingerprints join on the grid cells near their popcount vectors, and every
    candidate's bit distance is checked. In a small cell all pairs are
    checked. In a larger one each fingerprint is laid out by the values one
    bit away that lie in this cell: fingerprints that share such a value are
    within 2 bits of each other, and any two within 2 bits that meet in the
    cell share one; at most 65 share a value, and each is linked to the
    smallest, so components are exact and links grow with the rows.
    """
    fp, cell = F.col("fp"), F.col("cell")
    laid = distinct.select("fp", cell_of(fp).alias("own")).select("fp", "own", F.explode(_cells_near(fp, F.col("own"))).alias("cell"))
    full = laid.groupBy("cell").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    meeting = write_table(laid.join(unsent(full), "cell"), "cells")
    few = meeting.where(F.col("size") <= paired_cell).select("cell", "fp")
    pairs = few.select("cell", fp.alias("a")).join(unsent(few.select("cell", fp.alias("b"))), "cell").where("a < b")
    near = pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS).select("a", "b")
    many = meeting.where(F.col("size") > paired_cell)
    spread = many.select("fp", F.explode(_midpoints(fp, F.col("own"), cell)).alias("mid"))
    shared = spread.groupBy("mid").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    stars = shared.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b")
    checked = stars.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS)
    return near.unionByName(checked).distinct()


def near_duplicates(docs: DataFrame, loc: str = "loc", words: int = SHINGLE) -> DataFrame:
    """loc, doc_id, fp and component_id (smallest doc_id reachable) per row.

    Equal fingerprints are one class from the start, so copies are never
    paired. component_id is NULL only where no row of the component has an
    id. ``first_loc`` names the row that stands for the component: smallest
    doc_id, then smallest locator. An empty table gives an empty result.
    """
    prints = write_table(fingerprints(docs, loc, words), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "loc")
    classes = write_table(prints.groupBy("fp").agg(F.min(order).alias("first")), "classes")
    roots = connected_components(links(classes.select("fp")))
    rooted = classes.join(unsent(roots.withColumnRenamed("node", "fp")), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    best = rooted.groupBy("root").agg(F.min("first").alias("first"))
    labels = rooted.select("fp", "root").join(unsent(best), "root").select("fp", "first")
    return prints.join(unsent(labels), "fp").select(
        "loc", "doc_id", "fp", F.col("first.doc_id").alias("component_id"), F.col("first.loc").alias("first_loc")
    )


def drop_near_copies(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """``docs`` with its own columns and one row of each component."""
    loc = free_name("loc", docs.columns)
    rows = located(docs, loc)
    return keep_located(rows, loc, near_duplicates(rows, loc, words).where("loc = first_loc").select("loc"))
