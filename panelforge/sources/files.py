"""File sources and sinks.

Every scan declares its schema (keys are never inferred); NaN in double
columns becomes NULL at the scan so averages skip it. Only small manifests
(variable lists, rename maps) are read on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructField, StructType



def nan_to_null(df: DataFrame) -> DataFrame:
    """NULL for NaN in every floating column (a typed CSV read yields NaN for 'NaN')."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            out.append(F.when(~F.isnan(F.col(f"`{f.name}`")), F.col(f"`{f.name}`")).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def scan_csv(spark: SparkSession, path: str, schema: StructType | str, *, header: bool = True,
             sep: str = ",") -> DataFrame:
    """CSV with an explicit schema (header row skipped, not used for types)."""
    df = spark.read.schema(schema).option("header", header).option("sep", sep).option("mode", "FAILFAST").csv(path)
    return nan_to_null(df)


def scan_csv_headerless(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV without a header row; names and types are declared."""
    return scan_csv(spark, path, schema, header=False)


def scan_csv_strings(spark: SparkSession, path: str, columns: Sequence[str], *, header: bool = True) -> DataFrame:
    """All columns as text (protects leading zeros of codes)."""
    schema = StructType([StructField(c, StringType(), True) for c in columns])
    return spark.read.schema(schema).option("header", header).csv(path)


# A fixed-width field: (name, start offset, end offset [exclusive], type).
FixedField = tuple[str, int, int, str]


def scan_fixed_width(spark: SparkSession, path: str, fields: Sequence[FixedField]) -> DataFrame:
    """Fixed-width text: each field is a 0-based [start, end) slice of the line.

    Strings stay untrimmed (like plain slicing); numbers are trimmed and cast.
    Short lines give empty strings / NULL numbers for missing slices.
    """
    lines = spark.read.text(path)
    cols = []
    for name, start, end, typ in fields:
        piece = F.substring(F.col("value"), start + 1, end - start)
        if typ == "string":
            cols.append(piece.alias(name))
        else:
            t = F.trim(piece)
            cols.append(F.when(t != "", t).cast(typ).alias(name))
    return lines.select(*cols)


def _row_line(value) -> Column:
    """A line of a row array as one row: the outer brackets and the comma after the row are taken off."""
    return F.regexp_replace(F.regexp_replace(value, r"^\s*(\[\s*)?(?=\[)", ""), r"\]\s*[,\]]?\s*$", "]")


def scan_json_row_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON tables (an array of arrays, the header first) whose rows stand on lines of their own.

    A line break never stands inside a JSON string, so it is a record boundary
    at which Spark splits a file: one large document is read by many tasks.
    The header is the first line of the first file; rows equal to it are the
    headers of further files. A row of another length or a line that is no
    row is an error when the rows are read. Values stay text.

    Defined cases: blank lines and lines of the outer brackets alone are
    skipped; no file with a row gives an error.
    """
    lines = spark.read.text(path).where(~F.col("value").rlike(r"^\s*[\[\]]?\s*$"))
    first = lines.select(F.from_json(_row_line("value"), "array<string>").alias("row")).head(1)
    if not first or first[0]["row"] is None:
        raise ValueError(f"no header row in {path}")
    header = first[0]["row"]
    rows = lines.select("value", F.from_json(_row_line("value"), "array<string>").alias("row"))
    bad = F.raise_error(F.concat(F.lit(f"not a row of {len(header)} values: "), F.substring("value", 1, 200)))
    whole = F.col("row").isNotNull() & (F.size("row") == len(header))
    rows = rows.select(F.when(whole, F.col("row")).otherwise(bad.cast("array<string>")).alias("row"))
    rows = rows.where(~F.col("row").eqNullSafe(F.array(*[F.lit(h) for h in header])))
    return rows.select(*[F.col("row")[i].alias(h) for i, h in enumerate(header)])


def scan_json_rows(spark: SparkSession, path: str, *, whole_file: bool = False) -> DataFrame:
    """JSON tables stored as an array of arrays whose first row is the header.

    A document is one record here; ``scan_json_row_lines`` reads one large
    document, written with a row a line, in many tasks.

    One document per line (or per file with ``whole_file``); every document
    must carry the same header. Values stay text (codes, no-data markers);
    typing is the caller's step. The header is collected once (one short row
    per document), the data rows are exploded on the executors.
    """
    raw = spark.read.text(path, wholetext=whole_file).where(F.trim("value") != "")
    arr = raw.select(F.from_json("value", "array<array<string>>").alias("a"))
    headers = [tuple(r[0]) for r in arr.select(F.col("a")[0]).distinct().collect()]
    if len(headers) != 1:
        raise ValueError(f"documents disagree on the header: {headers}")
    header = headers[0]
    rows = arr.select(F.posexplode("a").alias("pos", "row")).where(F.col("pos") > 0)
    return rows.select(*[F.col("row")[i].alias(h) for i, h in enumerate(header)])


def read_manifest(spark: SparkSession, path: str) -> list[str]:
    """A short text manifest (one name per line), in file order, on the driver."""
    lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("i")).collect()
    return [r["value"].strip() for r in sorted(lines, key=lambda r: r["i"]) if r["value"].strip()]


def write_manifest(spark: SparkSession, names: Sequence[str], path: str) -> None:
    """Land a manifest as one text file (works on any Hadoop file system)."""
    spark.createDataFrame([(n,) for n in names], "value string").coalesce(1).write.mode("overwrite").text(path)


def select_manifest(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Keep the key columns plus the listed variables; an unknown name is an error."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"variables not in the table: {missing}")
    return df.select(*keep, *[n for n in names if n not in keep])


def write_csv(df: DataFrame, path: str, *, header: bool = True, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", header).csv(path)


def write_parquet(df: DataFrame, path: str, *, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_text(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).alias("value")).write.mode("overwrite").text(path)
