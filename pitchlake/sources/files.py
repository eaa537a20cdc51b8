"""File sources and sinks: CSV, Parquet, raw loads and completeness checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.operators.clean import TableSpec
from pitchlake.operators.state import STORED


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    check_header: bool = True,
) -> DataFrame:
    """CSV with a header and a fixed schema; bad cells of typed columns become NULL.

    Columns bind by position, so the header is compared with the schema by default.
    """
    return spark.read.csv(
        path if isinstance(path, str) else list(path),
        header=True, schema=schema, enforceSchema=not check_header,
    )


def read_raw(spark: SparkSession, folder: str, spec: TableSpec, check_header: bool = True):
    return read_csv(spark, f"{folder.rstrip('/')}/{spec.name}.csv", spec.raw_schema, check_header)


def read_csvs(
    spark: SparkSession, folder: str, schemas: Mapping[str, T.StructType]
) -> dict[str, DataFrame]:
    """Several CSV tables of one folder, by name."""
    return {
        name: read_csv(spark, f"{folder.rstrip('/')}/{name}.csv", schema)
        for name, schema in schemas.items()
    }


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def load_raw(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Match columns by case-insensitive name; missing ones become NULL, extra ones are ignored.

    Rows with a value that doesn't fit its column are left out; ``load_checked`` returns them too.
    """
    return load_checked(df, schema).where(F.size(REASONS) == 0).drop(REASONS)


#: Column of a checked load: what is wrong with a row, as (column, type, text) entries.
REASONS = "_rejected"


def load_checked(df: DataFrame, schema: T.StructType) -> DataFrame:
    """All rows under the names and types of ``schema``, and the reasons to reject them.

    A value that can't be cast is NULL in its column and an entry in ``_rejected``; NULL stays NULL
    without a reason. Accepted and rejected rows thus come from one parse.
    """
    present = {c.lower(): c for c in df.columns}
    columns, reasons = [], []
    for f in schema:
        found = present.get(f.name.lower())
        if found is None:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        cast = F.col(f"`{found}`").try_cast(f.dataType)
        columns.append(cast.alias(f.name))
        if df.schema[found].dataType != f.dataType:
            reasons.append(F.when(
                F.col(f"`{found}`").isNotNull() & cast.isNull(), F.struct(
                    F.lit(f.name).alias("column"),
                    F.lit(f.dataType.simpleString()).alias("type"),
                    F.col(f"`{found}`").cast("string").alias("text"))))
    kind = "array<struct<column:string,type:string,text:string>>"
    return df.select(
        *columns, F.array_compact(F.array(*reasons)).cast(kind).alias(REASONS)
        if reasons else F.array().cast(kind).alias(REASONS))


#: Text of a line that the CSV reader could not fit into its columns.
CORRUPT = "_corrupt_line"


def read_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True
) -> DataFrame:
    """A typed CSV scan with the reasons to reject a line; see ``load_checked``.

    Cells are read as text and cast here, so each bad cell is named with its column. A line with too
    few or too many cells is rejected as a whole, with its text.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    lines = (
        spark.read.option("header", header).option("mode", "PERMISSIVE")
        .option("columnPruning", False)  # a reader that skips cells doesn't count them
        .option("columnNameOfCorruptRecord", CORRUPT).schema(text.add(CORRUPT, T.StringType()))
        .csv(path))
    checked = load_checked(lines, T.StructType([*schema, T.StructField(CORRUPT, T.StringType())]))
    whole = F.when(F.col(CORRUPT).isNotNull(), F.array(F.struct(
        F.lit("*").alias("column"), F.lit("line").alias("type"), F.col(CORRUPT).alias("text"))))
    return checked.withColumn(REASONS, F.coalesce(whole, F.col(REASONS))).drop(CORRUPT)


def rejected_cells(checked: DataFrame, table: str) -> DataFrame:
    """(table, column, type, text) for each reason of a checked load."""
    return checked.select(F.lit(table).alias("table"), F.inline(REASONS))


def append_load(checked: DataFrame, path: str, table: str, run: str) -> DataFrame:
    """Append the accepted rows of a load and keep the rejected ones beside them.

    Rows go to ``rows/run=…`` and rejected ones, with the reasons, to ``rejected/run=…`` below
    ``path``; a load that is repeated under its name replaces itself, so nothing is loaded twice.
    Returns the counts (table, run, accepted, rejected), which come from what was written.
    """
    spark = checked.sparkSession
    good = F.size(REASONS) == 0
    checked.where(good).drop(REASONS).write.mode("overwrite").parquet(f"{path}/rows/run={run}")
    bad = checked.where(~good).select("*", F.lit(table).alias("table"))
    bad.write.mode("overwrite").parquet(f"{path}/rejected/run={run}")
    count = lambda part: spark.read.parquet(f"{path}/{part}/run={run}").agg(
        F.count(F.lit(1))).scalar()
    return spark.range(1).select(
        F.lit(table).alias("table"), F.lit(run).alias("run"), count("rows").alias("accepted"),
        count("rejected").alias("rejected"))


def loaded_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all loads below ``path``, with their ``run``."""
    return spark.read.parquet(f"{path}/rows")


def write_silver(df: DataFrame, path: str, balance_on: Sequence[str] | None = None) -> None:
    """Replace a Parquet table. ``balance_on`` asks AQE for evenly sized output files."""
    if balance_on is not None:
        df = df.hint("rebalance", *balance_on)
    df.write.mode("overwrite").options(**STORED).parquet(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace a Parquet table laid out by ``by``; AQE splits large and merges small partitions."""
    df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, table, size and modification time of the files below ``path`` (content is not read)."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
    )
    root = path.rstrip("/").rsplit("/", 1)[-1]
    inside = F.regexp_extract("path", f"/{root}/(.*)$", 1)
    return files.select(
        "path",
        F.regexp_replace(F.split_part(inside, F.lit("/"), F.lit(1)), r"\.[^.]*$", "").alias("table"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified_at"),
    )


def check_manifest(files: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Expected against found tables: status found / missing / extra, file count, bytes, newest."""
    spark = files.sparkSession
    want = spark.createDataFrame([(t,) for t in expected], "table string").withColumn(
        "wanted", F.lit(True)
    )
    found = files.groupBy("table").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("bytes").alias("bytes"),
        F.max("modified_at").alias("modified_at"),
    )
    return want.join(found, "table", "full").select(
        "table",
        F.when(F.col("wanted").isNull(), "extra")
        .when(F.col("files").isNull(), "missing")
        .otherwise("found")
        .alias("status"),
        F.coalesce("files", F.lit(0)).alias("files"),
        F.coalesce("bytes", F.lit(0)).alias("bytes"),
        "modified_at",
    )


def inspect_table(df: DataFrame, table: str) -> DataFrame:
    """One row per column: type, rows, NULL count. The few-row sample is ``df.limit(3)``."""
    one = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in df.columns],
    )
    return one.select(
        F.col("rows"),
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(f.name).alias("column"),
                        F.lit(f.dataType.simpleString()).alias("type"),
                        F.col(f"n_{f.name}").alias("nulls"),
                    )
                    for f in df.schema
                ]
            )
        ).alias("c"),
    ).select(F.lit(table).alias("table"), "c.column", "c.type", "rows", "c.nulls")


def string_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


