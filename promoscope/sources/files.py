"""CSV / text inputs (SRC-1..4) and positional parsing of raw lines (PRJ-1).

Readers always take an explicit schema: no inference job, integer codes
(so "0511" and "511" agree), and PERMISSIVE mode, where a short or
unparsable line becomes NULLs instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promoscope.functions.text import field, join_fields
from promoscope.schemas import TEST_PAIRS, TRAIN_PAIRS, USER_INFO, USER_LOG

SCHEMAS = {
    "user_log": USER_LOG,
    "user_info": USER_INFO,
    "train": TRAIN_PAIRS,
    "test": TEST_PAIRS,
}


ROW_FILE, ROW_ORDER = "row_file", "row_ord"
FILE_ORDER = (ROW_FILE, ROW_ORDER)


def read_table(spark: SparkSession, kind: str, path: str, fmt: str = "csv",
               header: bool = True, row_order: bool = False) -> DataFrame:
    """Read one of the four inputs from CSV (with header) or parquet.

    ``row_order=True`` adds ``row_file`` (the source file) and ``row_ord``
    (increasing with the position in that file: a file's splits are read
    in offset order, and the id grows with the split index and the row
    within it).  Ordering by ``FILE_ORDER`` follows the files' row order,
    files taken by name (part-00000, part-00001, ...).  Ordered fills use
    it to fill in file order.
    """
    df = _read_table(spark, kind, path, fmt, header)
    if not row_order:
        return df
    return (df.withColumn(ROW_FILE, F.col("_metadata.file_path"))
            .withColumn(ROW_ORDER, F.monotonically_increasing_id()))


def _read_table(spark: SparkSession, kind: str, path: str, fmt: str, header: bool) -> DataFrame:
    schema = SCHEMAS[kind]
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    df = (spark.read.schema(schema)
          .option("header", header)
          .option("mode", "PERMISSIVE")
          .option("enforceSchema", True)
          .csv(path))
    if kind == "test":
        # The empty score column of the input is set aside (ML-10).
        df = df.drop("prob").withColumn("prob", F.lit(None).cast("double"))
    return df


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw text lines, one row each (column ``value``)."""
    return spark.read.text(path)


def lines_of(df: DataFrame, cols, sep: str = ",") -> DataFrame:
    """Rows to delimited text lines (column ``value``); NULL is an empty field."""
    return df.select(join_fields(cols, sep).alias("value"))


def _typed(line, index: int, dtype: T.DataType):
    return F.nullif(field(line, index), F.lit("")).try_cast(dtype)


def parse_log_lines(lines: DataFrame, schema: T.StructType = USER_LOG) -> DataFrame:
    """Positional fields of raw log lines to the typed log schema.

    A header line or a malformed field yields NULL in that column (never
    an error); callers' predicates then drop it.
    """
    return lines.select(*[
        _typed("value", i, f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])


def parse_user_lines(lines: DataFrame, reject_blank_fields: bool = True) -> DataFrame:
    """Raw user lines to (user_id, age_range, gender).

    ``reject_blank_fields`` drops lines holding an empty middle field
    (",,"), the map-side reader's rule for malformed user rows (FLT-7).
    """
    if reject_blank_fields:
        lines = lines.filter(~F.col("value").contains(",,"))
    return lines.select(*[
        _typed("value", i, f.dataType).alias(f.name) for i, f in enumerate(USER_INFO.fields)])
