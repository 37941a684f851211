"""Column expressions on hand-made rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadlens.functions import cleaning, files, keys
from loadlens.functions.bins import edge_count, interval, nearest_edge


def values(spark, expression, texts, kind="string"):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("c"))).collect()]


def test_null_text_and_casts(spark):
    texts = ["null", "12", "nullx", "", "12.5", "-3"]
    assert values(spark, cleaning.as_long, texts) == [0, 12, None, None, 12, -3]
    assert values(spark, cleaning.as_double, texts) == [0.0, 12.0, None, None, 12.5, -3.0]
    assert values(spark, lambda c: cleaning.replace_null_text(c, "0"), ["null", "nullx", "a"]) == ["0", "0x", "a"]
    assert values(spark, cleaning.blank_to, ["", "x"]) == ["NA", "x"]
    assert values(spark, cleaning.without_quotes, ['["a"]']) == ["[a]"]


def test_long_beyond_32_and_53_bits(spark):
    assert values(spark, cleaning.as_long, ["3000000000", "9007199254740993"]) == [3000000000, 9007199254740993]


FILES = [
    '[{"type":"image","size":10},{"type":"video","size":7},{"type":"image","size":5}]',
    "[]",
    "null",
    "",
    '[{"type":"mp4","size":3}]',
    '[{"size":4,"type":"image"}]',
    '[{"type":"image","size":3000000000},{"type":"image","size":null}]',
]


def test_file_sizes(spark):
    bare = lambda f: lambda c: f(cleaning.without_quotes(c))
    assert values(spark, bare(files.image_size), FILES) == [15, 0, 0, 0, 0, 0, 3000000000]
    assert values(spark, lambda c: files.image_size(c, quoted=True), FILES) == [15, 0, 0, 0, 0, 0, 3000000000]
    assert values(spark, bare(files.video_size), FILES) == [7, 0, 0, 0, 0, 0, 0]
    assert values(spark, files.total_size, FILES) == [22, 0, 0, 0, 7, 4, 3000000000]
    assert values(spark, lambda c: files.json_size(c, "image"), FILES) == [15, 0, 0, 0, 0, 4, 3000000000]
    assert values(spark, files.json_size, FILES) == [22, 0, 0, 0, 3, 4, 3000000000]
    assert values(spark, files.total_size, [None]) == [0]


def test_keys(spark):
    df = spark.createDataFrame(
        [("United States", "CA", "null"), ("New_Land", "X", "a"), ("France", None, "null")], "c string, r string, p string"
    )
    got = df.select(
        keys.country_region("c", "r"),
        keys.joined("c", "r", sep="_"),
        keys.collapse_null_key(keys.joined("p", "p", "p", sep="_")),
        keys.same("c", "p"),
    ).collect()
    assert [tuple(g) for g in got] == [
        ("United States_CA", "United States_CA", "null", False),
        ("New", "New_Land_X", "a_a_a", False),
        ("France", "France_", "null", False),
    ]


@pytest.mark.parametrize("width", [0.5, 0.1, 0.2, 10.0, 0.3])
def test_bins_equal_search_over_edges(spark, width):
    rng = np.random.default_rng(7)
    count = edge_count(20 if width < 1 else 490, width)
    edges = np.arange(0, 20 if width < 1 else 490, width)
    assert len(edges) == count
    x = np.concatenate(
        [rng.uniform(-1, edges[-1] + 2, 500), edges, edges + width / 2, np.nextafter(edges, -1), [-5.0, 1e12, 0.0]]
    )
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i int, x double")
    got = df.orderBy("i").select(nearest_edge(F.col("x"), width, count), interval(F.col("x"), width, count)).collect()
    assert [g[0] for g in got] == np.argmin(np.abs(edges[None, :] - np.clip(x, 0, edges[-1])[:, None]), axis=1).tolist()
    counts = np.bincount([g[1] for g in got if g[1] is not None], minlength=count - 1)
    assert counts.tolist() == np.histogram(x, bins=edges)[0].tolist()


def test_bin_examples(spark):
    count = edge_count(20, 0.5)
    near = lambda c: nearest_edge(c, 0.5, count)
    assert values(spark, near, [0.25, 0.75, -1.0, 30.0], "double") == [0, 1, 0, 39]
    assert values(spark, lambda c: interval(c, 0.5, 3), [0.0, 0.5, 1.0, 1.2, -0.1], "double") == [0, 1, 1, None, None]
    assert count == math.ceil(20 / 0.5)
