"""Reading and writing tables: CSV and Parquet scans, catalog tables, views and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomline.sources import schemas


def read_csv(spark: SparkSession, path: str, schema: T.StructType, one_line: bool = False) -> DataFrame:
    """Headered CSV with a declared schema; a byte order mark before the first header is ignored.

    In files from outside a quoted field may hold line breaks, so one file is read by one task. ``one_line`` is for
    files of ``write_csv(..., one_line=True)``: a row is a line there, so files of any size are split among tasks. A row that does
    not fit the schema is an error, not a row of nulls.
    """
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("escape", '"').option("mode", "FAILFAST")
    if not one_line:
        return reader.option("multiLine", True).option("lineSep", "\n").csv(path)
    read = reader.option("lineSep", "\n").csv(path)
    return read.select(*[_with_breaks(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in schema])


def _one_line(column: Column) -> Column:
    """Backslashes doubled, line breaks as backslash and letter."""
    for char, code in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        column = F.replace(column, F.lit(char), F.lit(code))
    return column


def _with_breaks(name: str) -> Column:
    """The inverse: between doubled backslashes every code is a line break."""
    pieces = F.transform(
        F.split(F.col(f"`{name}`"), r"\\\\"), lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    )
    return F.array_join(pieces, "\\")


def raw_schema(name: str) -> T.StructType:
    """The declared schema of a table under the headers of its raw file."""
    header = {v: k for k, v in schemas.RAW_HEADERS[name].items()}
    return T.StructType([T.StructField(header.get(f.name, f.name), f.dataType, True) for f in schemas.TABLES[name]])


def conform(df: DataFrame, name: str) -> DataFrame:
    """Rename raw headers and order columns as declared."""
    renamed = df.withColumnsRenamed(schemas.RAW_HEADERS[name])
    return renamed.select(*[F.col(f.name).cast(f.dataType) for f in schemas.TABLES[name]])


def read_table(spark: SparkSession, name: str, path: str, one_line: bool = False) -> DataFrame:
    """One bank table from CSV (raw headers; ``one_line`` as in ``read_csv``) or Parquet (declared columns)."""
    if path.endswith(".parquet"):
        return spark.read.schema(schemas.TABLES[name]).parquet(path)
    return conform(read_csv(spark, path, raw_schema(name), one_line), name)


def append(df: DataFrame, table: str, location: str | None = None) -> None:
    """Create the table if absent, then append the rows."""
    writer = df.write.mode("append").format("parquet")
    (writer.option("path", location) if location else writer).saveAsTable(table)


def replace(df: DataFrame, table: str, location: str | None = None) -> None:
    """Overwrite the table."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", location) if location else writer).saveAsTable(table)


def register(views: dict[str, DataFrame]) -> None:
    """Create or replace named views; nothing is computed."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def write_csv(df: DataFrame, path: str, separator: str = ", ", one_line: bool = False) -> None:
    """Headered CSV in as many files as there are partitions; arrays are joined to text first.

    With ``one_line`` line breaks in fields are written as codes, so that ``read_csv`` can split the files.
    """
    columns = [
        F.array_join(F.col(f"`{f.name}`").cast("array<string>"), separator).alias(f.name)
        if isinstance(f.dataType, T.ArrayType)
        else F.col(f"`{f.name}`")
        for f in df.schema
    ]
    flat = df.select(*columns)
    if one_line:
        flat = flat.select(*[(_one_line(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")).alias(f.name) for f in flat.schema])
    writer = flat.write.mode("overwrite").option("header", True).option("escape", '"').option("lineSep", "\n")
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
