"""Tab-separated impression logs and prediction files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.functions.cleaning import filled
from loadlens.session import cut_lineage, measured


#: A line whose first fields, so many, are the names of their columns repeats the header.
HEADER_FIELDS = 3


def read_tsv(
    spark: SparkSession,
    path: str,
    drop_repeated_header: bool = True,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Read a headed TSV as text columns, without quoting; empty fields are ``''``.

    The reader takes the first line of each file as header. A line inside a file
    that repeats the header is dropped as well; only its first fields are looked
    at, so a query on few columns parses few. With ``corrupt_column``, lines
    with too few or too many fields are kept there in full. A file whose header
    differs from that of the first one raises an error; ``read_aligned`` takes
    such folders.
    """
    reader = spark.read.option("sep", "\t").option("quote", "").option("header", True).option("enforceSchema", False)
    # No inference: this reads the header line only.
    names = reader.csv(path).columns
    fields = [T.StructField(n, T.StringType()) for n in names]
    if corrupt_column:
        fields.append(T.StructField(corrupt_column, T.StringType()))
        reader = (
            reader.option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", corrupt_column)
            .option("columnPruning", False)
        )
    df = reader.schema(T.StructType(fields)).csv(path)
    if drop_repeated_header:
        # On the columns as read, before they get new aliases: a condition over
        # many aliased columns makes the optimiser derive one per combination.
        tested = names[:HEADER_FIELDS]
        df = df.filter(F.concat_ws("\t", *tested) != "\t".join(tested))
    return df.select(*[filled(n).alias(n) for n in names], *([corrupt_column] if corrupt_column else []))


def file_headers(spark: SparkSession, path: str) -> DataFrame:
    """(file, header): the first line of every file.

    A file's first block is read by one task, line by line, so the first line
    seen of it is the header.
    """
    lines = spark.read.text(path)
    meta = lines.metadataColumn("_metadata")
    first = lines.select("value", meta["file_path"].alias("file"), meta["file_block_start"].alias("_start")).where("_start = 0")
    return first.groupBy("file").agg(F.first("value").alias("header"))


def header_report(spark: SparkSession, path: str, known: list[str] | None = None) -> DataFrame:
    """(file, position, column, known): where each file has which column, and whether it is a known one."""
    fields = file_headers(spark, path).select("file", F.posexplode(F.split("header", "\t", -1)).alias("position", "column"))
    return fields.withColumn("known", F.lit(True) if known is None else F.col("column").isin(known))


def read_aligned(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Read TSV files whose headers differ in order or names; fields are aligned by name.

    Gives ``columns``, by default every column of any file in order of first
    use (most files first). A column that a file lacks, and a field that a line
    lacks, is the empty text; fields beyond a file's header are left out. Lines
    that equal the header of their own file are dropped.
    """
    headers = cut_lineage(file_headers(spark, path))
    if columns is None:
        layouts = headers.groupBy("header").agg(F.count("*").alias("n"), F.min("file").alias("file"))
        named = layouts.select("n", "file", F.posexplode(F.split("header", "\t", -1)).alias("position", "column"))
        best = named.groupBy("column").agg(F.max(F.struct("n", (-F.col("position")).alias("p"))).alias("best"))
        columns = [r[0] for r in best.orderBy(F.desc("best.n"), F.desc("best.p"), "column").collect()]
    own = F.split("header", "\t", -1)
    places = F.transform(F.array(*[F.lit(c) for c in columns]), lambda c: F.array_position(own, c) - 1)
    table = measured(cut_lineage(headers.select("file", "header", places.cast("array<int>").alias("places"))))
    lines = spark.read.text(path)
    rows = (
        lines.select("value", lines.metadataColumn("_metadata")["file_path"].alias("file"))
        .join(table, "file")
        .where((F.col("value") != F.col("header")) & (F.col("value") != ""))
        .select(F.split("value", "\t", -1).alias("_fields"), "places")
    )
    field = lambda i: F.when(F.col("places")[i] >= 0, F.get("_fields", F.col("places")[i]))
    return rows.select(*[filled(field(i)).alias(c) for i, c in enumerate(columns)])


def write_tsv(df: DataFrame, path: str, header: bool = True, mode: str = "errorifexists") -> None:
    """Write text columns as they are: no quoting, no escaping, blanks kept.

    A text with a tab or a line break has no form in this format; it fails the
    write instead of becoming another row. A row of blanks only is read back as
    no row, as the reader skips blank lines.
    """
    texts = [c for c, kind in df.dtypes if kind == "string"]
    checked = [F.col(f"`{c}`") for c in df.columns]
    if texts:
        # One look at the whole line instead of one at each field.
        line = F.concat_ws("", *[F.col(f"`{c}`") for c in texts])
        bad = lambda text: F.translate(text, "\t\n\r", "") != text
        told = F.coalesce(*[F.when(bad(F.col(f"`{c}`")), F.concat(F.lit(f"{c}: "), F.col(f"`{c}`"))) for c in texts])
        broken = F.raise_error(F.concat(F.lit("tab or line break in column "), told)).cast("string")
        checked = [F.when(bad(line), broken).otherwise(c).alias(n) if n == texts[0] else c for c, n in zip(checked, df.columns)]
    (
        df.select(*checked)
        .write.mode(mode)
        .option("sep", "\t")
        .option("header", header)
        .option("quote", "")
        .option("escape", "")
        .option("emptyValue", "")
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_predictions(df: DataFrame, path: str, key: str, prediction: str = "prediction", mode: str = "errorifexists") -> None:
    """One line per row: key and predicted value. Each task writes its own part."""
    write_tsv(df.select(key, prediction), path, mode=mode)
