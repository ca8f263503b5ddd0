"""Readers for the supplier's delimited files and the address-extract writer.

All files: one header line (skipped, names ignored), no quoting (a ``"`` is
data), ISO-8859-1, one record per line.  The feed's two-character ``||``
separator is read directly, so a TAB inside a field stays data.  Every
column is read as text, then cast to its declared type (``typed_cast``):

* a row with too few or too many fields,
* a value that does not parse as its type (only an empty field is NULL),
* a text longer than its declared length by more than blanks,
* an empty field in a required column

makes the row a reject.  ``strict`` stores all rejects and raises (the
original aborted the whole load); ``quarantine`` returns them next to the
good rows.  The typed rows are staged once, so the checks see every column
(a pruned re-read would skip validating unused columns) and later phases
read a columnar table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from landroll.functions.cast import ColumnSpec, typed_cast
from landroll.operators.quality import raise_if_any, reject_path
from landroll.session import stage
from landroll.sources.schemas import (EXTRACT_COLUMNS, FEED_FORCED, FEED_SPECS, STD_FORCED, STD_REQUIRED,
                                      STD_SPECS)

CORRUPT = "_corrupt_record"
# Where a row was read: its file, and the first byte of the block of it that the task read.
PLACE = {"file": "_metadata.file_path", "block_start": "_metadata.file_block_start"}
ENCODING = "ISO-8859-1"


@dataclass
class Loaded:
    rows: DataFrame      # typed rows that passed every check
    rejects: DataFrame   # raw line (if malformed) or key, the problems found, file and block


def read_text_columns(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], sep: str,
                      encoding: str = ENCODING) -> DataFrame:
    """Read a headed, unquoted delimited file with every column as text plus ``_corrupt_record`` and the place."""
    schema = StructType([StructField(c, StringType()) for c in columns] + [StructField(CORRUPT, StringType())])
    return (spark.read.schema(schema)
            .option("sep", sep).option("header", True).option("quote", "").option("escape", "")
            .option("encoding", encoding).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .csv(path).select("*", *[F.col(c).alias(f"_{name}") for name, c in PLACE.items()]))


def load_typed(spark: SparkSession, path: str | Sequence[str], specs: Sequence[ColumnSpec], sep: str,
               forced: Sequence[str] = (), required: Sequence[str] = (), mode: str = "strict",
               name: str = "load", columns: Sequence[str] | None = None) -> Loaded:
    """Read, cast and check every column; stage the result once.

    ``columns`` limits what is kept in the staged table (and in ``rows``);
    every column is still cast and checked while the table is written.
    """
    if mode not in ("strict", "quarantine"):
        raise ValueError(f"unknown mode {mode!r}")
    raw = read_text_columns(spark, path, [s.name for s in specs], sep)
    place = [f"_{name}" for name in PLACE]
    typed, bad = typed_cast(raw, specs, forced=forced, required=required, keep=[CORRUPT, *place])
    problems = F.when(F.col(CORRUPT).isNotNull(),
                      F.array_union(F.array(F.lit("row:field_count")), F.col("_problems"))
                      ).otherwise(F.col("_problems"))
    # Only rejects keep their place: it costs a good row nothing in the staged table.
    checked = typed.withColumn("_problems", problems).withColumns(
        {c: F.when(F.size("_problems") > 0, F.col(c)) for c in place})
    if columns is not None:
        kept = list(dict.fromkeys([specs[0].name, *columns]))
        checked = checked.select(*kept, "_problems", CORRUPT, *place)
    staged = stage(checked, name)
    rejects = staged.where(F.size("_problems") > 0).select(
        specs[0].name, F.col(CORRUPT).alias("raw_line"), F.col("_problems").alias("problems"),
        *[F.col(f"_{name}").alias(name) for name in PLACE])
    rows = staged.where(F.size("_problems") == 0).drop("_problems", CORRUPT, *place)
    if mode == "strict" and rejects.first() is not None:
        # The run's staging folder goes with the run; its rejects stay.
        path = reject_path(spark, name)
        rejects.write.mode("error").parquet(path)
        raise_if_any(rejects, name, path)
    return Loaded(rows, rejects)


def read_feed(spark: SparkSession, path: str | Sequence[str], mode: str = "strict",
              columns: Sequence[str] | None = None) -> Loaded:
    """The 332-column ``||``-separated property feed.  ``admid`` is required.

    All columns are validated; ``columns`` limits the ones kept.
    """
    return load_typed(spark, path, FEED_SPECS, "||", forced=FEED_FORCED, required=["admid"], mode=mode,
                      name="feed", columns=columns)


def read_standardized(spark: SparkSession, path: str | Sequence[str], mode: str = "strict",
                      columns: Sequence[str] | None = None) -> Loaded:
    """The 60-column tab-separated standardiser output; admid, latitude, longitude required."""
    return load_typed(spark, path, STD_SPECS, "\t", forced=STD_FORCED, required=STD_REQUIRED, mode=mode,
                      name="standardized", columns=columns)


def read_delete_list(spark: SparkSession, path: str | Sequence[str], mode: str = "strict") -> Loaded:
    """One ``admid`` per line after a header line; blank lines are skipped."""
    return load_typed(spark, path, [ColumnSpec("admid", "long")], "\t", required=["admid"], mode=mode,
                      name="deletes")


def write_address_extract(df: DataFrame, path: str) -> None:
    """Write admid, street, secondary, city, state as the standardiser's input.

    Tab-separated with a header line and CRLF line ends; NULL and '' are
    both written as an empty field; a field is quoted (with ``"`` doubled)
    only when it holds a tab, a quote or a line break.  The output is a
    folder of part files, one per partition.
    """
    (df.select(*EXTRACT_COLUMNS).write.mode("error")
     .option("sep", "\t").option("header", True).option("emptyValue", "").option("nullValue", "")
     .option("quote", '"').option("escape", '"').option("lineSep", "\r\n")
     .csv(path))
