"""Read daily observations from CSV, and land them as Parquet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cleaning import complete
from ..operators.states import land_states
from ..schema import CORRUPT_COLUMN, CRITICAL_COLUMNS, RAW_SCHEMA
from .headers import first_lines, readable


def file_headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Header line -> files that start with it, for the files whose first line
    names every critical column. Only the start of each file is read
    (``headers.first_lines``); in a store that Arrow does not reach, the lines
    come from a text scan. One line per file reaches the driver, which lists
    the files anyway."""
    return _headers(spark, path, _listed(spark, path))


def _listed(spark: SparkSession, path: str) -> list[str]:
    return sorted(r.path for r in spark.read.format("binaryFile").load(path).select("path").collect())


def _headers(spark: SparkSession, path: str, files: list[str]) -> dict[str, list[str]]:
    line = F.upper(F.col("line"))
    header = F.lit(True)
    for name in CRITICAL_COLUMNS:
        header = header & line.rlike(rf'(^|,)\s*"?{name}"?\s*(,|$)')
    if all(map(readable, files)):
        lines = first_lines(spark, files).select("file", "line")
    else:
        lines = (spark.read.text(path).where(F.col("_metadata.file_block_start") == 0)
                 .select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line")))
    out: dict[str, list[str]] = {}
    for row in lines.where(header).select("file", F.trim("line").alias("header")).distinct().orderBy("file").collect():
        out.setdefault(row.header, []).append(row.file)
    return out


def _names(header: str) -> list[str]:
    return [c.strip().strip('"').strip() for c in header.split(",")]


def read_observations(spark: SparkSession, path: str, *,
                      schema: T.StructType = RAW_SCHEMA,
                      mode: str = "PERMISSIVE",
                      keep_bad_rows: bool = False,
                      nan_as_null: bool = False,
                      date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Read a file or folder of observation CSV files with the declared schema.

    Station files differ in the columns that they carry and in their order.
    Files are grouped by header; each group is read by its own header, matched
    by name, and projected to the declared columns, an absent one as null.
    A folder with a file that names none or only some of the critical columns
    is refused. ``enforceSchema=false`` makes Spark check every file's header.

    ``mode`` is Spark's CSV parse mode; with ``keep_bad_rows`` a
    ``_corrupt_record`` column holds the text of rows that failed to parse
    (PERMISSIVE mode only), which ``row_accounting`` counts. ``nan_as_null``
    turns NaN doubles into nulls so that null checks and ``dropna`` agree (they
    differ on NaN otherwise).
    """
    listed = _listed(spark, path)
    groups = _headers(spark, path, listed)
    known = {f for files in groups.values() for f in files}
    plain = lambda p: p.split(":", 1)[-1].lstrip("/")  # noqa: E731  file:/x and file:///x are one file
    odd = sorted({plain(p) for p in listed} - {plain(p) for p in known})
    if odd or not groups:
        raise ValueError(f"observation files lack columns of {CRITICAL_COLUMNS} in their header: {odd[:5] or path}")
    parts = [_read_group(spark, _names(header), files, schema, mode, keep_bad_rows, date_format)
             for header, files in sorted(groups.items())]
    df = reduce(DataFrame.unionByName, parts)
    if nan_as_null:
        df = df.select(*[F.nanvl(F.col(f.name), F.lit(None).cast("double")).alias(f.name)
                         if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                         for f in df.schema.fields])
    return df


def _read_group(spark: SparkSession, header: list[str], files: list[str], schema: T.StructType,
                mode: str, keep_bad_rows: bool, date_format: str) -> DataFrame:
    """The files of one header, as the declared columns."""
    wanted = {f.name.upper(): f for f in schema.fields}
    read_schema = T.StructType([
        T.StructField(wanted[h.upper()].name, wanted[h.upper()].dataType, True)
        if h.upper() in wanted else T.StructField(h, T.StringType(), True) for h in header])
    if keep_bad_rows:
        read_schema = read_schema.add(CORRUPT_COLUMN, T.StringType(), True)
    df = (spark.read
          .option("header", "true")
          .option("ignoreLeadingWhiteSpace", "true")
          .option("ignoreTrailingWhiteSpace", "true")
          .option("enforceSchema", "false")
          .option("mode", mode)
          .option("dateFormat", date_format)
          .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
          .schema(read_schema)
          .csv(files))
    held = {h.upper() for h in header}
    cols = [F.col(f.name) if f.name.upper() in held else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields]
    return df.select(*cols, *([F.col(CORRUPT_COLUMN)] if keep_bad_rows else []))


def land_observations(df: DataFrame, path: str, mode: str = "replace_years") -> dict[str, int]:
    """Write observations as Parquet partitioned by year.

    ``replace_years`` (the default) replaces the years that ``df`` holds and
    leaves the others as they are; ``append`` adds rows, ``overwrite`` replaces
    the whole table, ``errorifexists`` refuses to touch one.

    Year partitions let the year-range filters of the roll-ups and the
    forecast prune whole directories. Range partitioning on (year, station)
    gives each task a contiguous slice, so a task writes one or two files
    rather than one per year it happens to hold, and rows come out sorted
    by station and date for the per-station windows.

    Returns A12's counts as the writing tasks observed them: RAW_ROWS,
    CLEAN_ROWS and, where the reader kept bad rows, CORRUPT_ROWS. (They are
    observed after the exchange: the sampling that range partitioning does
    before it would count rows twice.)
    """
    counts = Observation()
    corrupt = [F.count(CORRUPT_COLUMN).alias("CORRUPT_ROWS")] if CORRUPT_COLUMN in df.columns else []
    writer = (df.withColumn("OBS_YEAR", F.year("DATE"))
              .repartitionByRange("OBS_YEAR", "STATION", "DATE")
              .sortWithinPartitions("OBS_YEAR", "STATION", "DATE")
              .observe(counts, F.count(F.lit(1)).alias("RAW_ROWS"),
                       F.count(F.when(complete(), 1)).alias("CLEAN_ROWS"), *corrupt)
              .write.partitionBy("OBS_YEAR"))
    if mode == "replace_years":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode).option("partitionOverwriteMode", "static")
    writer.parquet(path)
    return dict(counts.get)


def land_with_states(spark: SparkSession, df: DataFrame, path: str, states_path: str) -> dict[str, int]:
    """Land observations (their years are replaced), then the partial states of
    the same years from the landed rows. The states are built from what was
    landed, so an interrupted call is mended by calling it again."""
    counts = land_observations(df, path)
    years = [r[0] for r in df.select(F.year("DATE")).distinct().collect()]  # one number per year
    dated = [y for y in years if y is not None]
    landed = read_landed(spark, path)
    held = F.col("OBS_YEAR").isin(dated) | (F.col("OBS_YEAR").isNull() if None in years else F.lit(False))
    land_states(landed.where(held), states_path)
    return counts


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Read observations landed by :func:`land_observations`: the raw
    columns plus the OBS_YEAR partition column, which ``between_years``
    filters on so that a year range skips whole directories."""
    return spark.read.parquet(path).select(*[f.name for f in RAW_SCHEMA.fields], "OBS_YEAR")
