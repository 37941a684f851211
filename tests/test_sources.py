"""Tab-separated files."""

import pytest
from pyspark.sql import functions as F

from loadlens.session import as_lookup, cut_lineage, scratch_path, shared_folder
from loadlens.sources import tsv


def write(tmp_path, text, name="in.tsv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_reader(spark, tmp_path):
    path = write(tmp_path, 'A\tB\tC\n1\t["x",\ty"\nA\tB\tC\n2\t\t\nA\tB\tother\n')
    df = tsv.read_tsv(spark, path)
    assert df.columns == ["A", "B", "C"]
    rows = [tuple(r) for r in df.collect()]
    assert rows == [("1", '["x",', 'y"'), ("2", "", ""), ("A", "B", "other")]
    assert tsv.read_tsv(spark, path, drop_repeated_header=False).count() == 4


def test_malformed_lines_are_kept_aside(spark, tmp_path):
    path = write(tmp_path, "A\tB\n1\t2\n3\n4\t5\t6\n")
    df = tsv.read_tsv(spark, path, corrupt_column="_bad")
    assert sorted(r._bad for r in df.filter(F.col("_bad").isNotNull()).collect()) == ["3", "4\t5\t6"]
    assert df.filter(F.col("_bad").isNull()).count() == 1


def test_many_columns_with_later_filters(spark, tmp_path):
    names = [f"C{i}" for i in range(60)]
    path = write(tmp_path, "\t".join(names) + "\n" + "\t".join(str(i) for i in range(60)) + "\n")
    df = tsv.read_tsv(spark, path).withColumns({n: F.col(n).try_cast("int") for n in names[:30]})
    assert df.filter("C3 = 3").filter("C40 = '40'").select(*[F.col(n).alias(n + "x") for n in names]).count() == 1


def test_predictions(spark, tmp_path):
    out = str(tmp_path / "scores")
    df = spark.createDataFrame([(1, 0.5), (2, 1.25)], "id int, prediction double")
    tsv.write_predictions(df, out, "id")
    assert sorted(tuple(r) for r in tsv.read_tsv(spark, out).collect()) == [("1", "0.5"), ("2", "1.25")]


def test_shared_folder(spark):
    folder = shared_folder(spark)
    assert shared_folder(spark) == folder and scratch_path(spark, "a") != scratch_path(spark, "a")
    assert cut_lineage(spark.range(3)).count() == 3
    assert as_lookup(spark.range(3)).count() == 3


def test_only_measured_tables_are_broadcast(spark, monkeypatch):
    from loadlens import session

    plan = lambda df: df._jdf.queryExecution().logical().toString()
    assert "Hint broadcast" in plan(as_lookup(spark.range(3)))
    monkeypatch.setattr(session, "BROADCAST_ROWS", 2)
    assert "Hint broadcast" not in plan(as_lookup(spark.range(3)))


def test_model_of_unknown_path(spark, tmp_path):
    from loadlens.plans.models import Model

    with pytest.raises(Exception):
        Model.load(spark, str(tmp_path / "missing"))


def test_texts_come_back_as_they_were(spark, tmp_path):
    rows = [(" lead", "trail "), ('"q"', "back\\slash"), ("  ", "x"), ("A", "x"), ("é\u00a0", "'")]
    out = str(tmp_path / "texts")
    tsv.write_tsv(spark.createDataFrame(rows, "A string, B string"), out)
    assert sorted(tuple(r) for r in tsv.read_tsv(spark, out).collect()) == sorted(rows)


@pytest.mark.parametrize("bad", ["a\tb", "a\nb", "a\rb"])
def test_a_text_without_a_form_fails_the_write(spark, tmp_path, bad):
    with pytest.raises(Exception, match="tab or line break in column A"):
        tsv.write_tsv(spark.createDataFrame([(bad,)], "A string"), str(tmp_path / "bad"))


def test_files_with_other_headers_raise(spark, tmp_path):
    write(tmp_path, "A\tB\n1\t2\n", "one.tsv")
    write(tmp_path, "B\tA\n1\t2\n", "two.tsv")
    with pytest.raises(Exception, match="(?i)header"):
        tsv.read_tsv(spark, str(tmp_path)).collect()
