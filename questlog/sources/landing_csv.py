"""CSV landing zone: all text, columns matched by header name, provenance kept."""

from __future__ import annotations

import csv
import re
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from questlog.session import materialise

# Columns of a telemetry drop and of the experiment export.
EVENT_COLUMNS = [
    "event_id",
    "event_name",
    "client_event_time",
    "userid",
    "platform",
    "country",
    "app_version",
    "device_id",
    "rounds_completed",
    "revenue_usd",
    "product_id",
    "currency",
]
ASSIGNMENT_COLUMNS = [
    "userid",
    "version",
    "sum_gamerounds",
    "retention_1",
    "retention_7",
]


def text_schema(columns: list[str]) -> T.StructType:
    """Every column as string."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _header_reader() -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Adds ``header``, the first line of the file at ``path``, read by its first bytes.

    The header is None where the file cannot be opened from Python. Nested
    functions travel to the tasks by value, so executors need not have this
    package installed.
    """

    def first_line(path: str) -> str | None:
        uri = urlsplit(path)
        try:
            if uri.scheme in ("", "file"):
                files, name = fs.LocalFileSystem(), path.removeprefix("file:")
            else:
                scheme = {"s3a": "s3", "s3n": "s3"}.get(uri.scheme, uri.scheme)
                files, name = fs.FileSystem.from_uri(
                    f"{scheme}://{uri.netloc}{uri.path}"
                )
            head = b""
            with files.open_input_stream(name) as stream:
                while b"\n" not in head and (chunk := stream.read(16 * 1024)):
                    head += chunk
        except (OSError, ValueError, NotImplementedError):
            return None
        return head.split(b"\n", 1)[0].decode("utf-8-sig").rstrip("\r")

    def add_headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(header=[first_line(path) for path in batch["path"]])

    return add_headers


def _as_stored(encoded: Column) -> Column:
    """Spark hands out file paths URL-encoded; undo it where it shows."""
    decoded = F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
    return F.when(encoded.contains("%"), decoded).otherwise(encoded)


def file_path() -> Column:
    """Path of the row's file."""
    return _as_stored(F.col("_metadata.file_path"))


def file_name() -> Column:
    """Last part of the path of the row's file."""
    return _as_stored(F.col("_metadata.file_name"))


def _file_key() -> list[Column]:
    """96 bits that stand for the row's file, so that a table of many files stays small."""
    path = F.col("_metadata.file_path")
    return [F.xxhash64(path).alias("file_hash"), F.crc32(path.cast("binary")).alias("file_check")]


def _headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file_hash, file_check, header) of every file that is not empty, stored.

    Tasks open the listed files and read the first bytes of each. Files on
    storage that Python cannot open there are read by Spark instead, whole.
    """
    key = ["file_hash", "file_check"]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    files = files.where("length > 0").select("path", *_file_key())
    kind = "path string, file_hash long, file_check long, header string"
    headers = materialise(files.mapInPandas(_header_reader(), kind).drop("path"), "csv-headers")
    if headers.where("header IS NULL").isEmpty():
        return headers
    lines = spark.read.option("recursiveFileLookup", True).text(path).where("_metadata.file_block_start = 0")
    lines = lines.select(*_file_key(), "value", F.monotonically_increasing_id().alias("line"))
    unread = lines.join(headers.where("header IS NULL").select(*key), key, "left_semi")
    firsts = unread.groupBy(*key).agg(F.min_by("value", "line").alias("header"))
    firsts = firsts.withColumn("header", F.ltrim(F.col("header"), F.lit("\ufeff")))
    return materialise(headers.where("header IS NOT NULL").unionByName(firsts), "csv-headers")


#: Fields of a line that are quoted, and so may hold separators.
_QUOTED = '"([^"]|"")*"'


def read_csv_by_name(
    spark: SparkSession, path: str | list[str], multiline: bool = False
) -> DataFrame:
    """All CSV files under ``path`` as text, columns united by header name.

    One scan reads all files. Spark matches CSV columns by position, so the
    scan numbers them, and each row takes its columns by the header of its own
    file, from a table of files that is joined by file. The driver sees the
    different headers, no paths. Files of one header need no such table: the
    scan then compares the header of each file with the columns itself. A file
    of another header that comes between the two looks fails the read.

    A column a file lacks is NULL. Provenance: ``filename`` and ``_source_file``.

    A row with more or fewer fields than its header fails the load, whatever
    columns of it are asked for: the parser reads whole rows. So does a line
    break inside quotes, unless ``multiline`` is set; a file is then one task.
    """
    headers = _headers(spark, path)
    lines = sorted(r["header"] for r in headers.select("header").distinct().collect())
    if not lines:
        raise FileNotFoundError(f"no CSV header under {path}")
    names = [next(csv.reader([line])) for line in lines]
    united = list(dict.fromkeys(c for n in sorted(names, key=len, reverse=True) for c in n))

    reader = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("columnPruning", False)
        .option("recursiveFileLookup", True)
        .option("multiLine", multiline)
    )
    provenance = [file_path().alias("filename"), file_name().alias("_source_file")]
    if len(lines) == 1:
        rows = reader.schema(text_schema(united)).option("mode", "FAILFAST").option("enforceSchema", False)
        return rows.csv(path).select("*", *provenance)

    width = max(map(len, names))
    columns = [f"c{i}" for i in range(width)]
    rows = reader.schema(text_schema([*columns, "line"])).option("columnNameOfCorruptRecord", "line").csv(path)
    number = F.create_map(*[F.lit(v) for n, line in enumerate(lines) for v in (line, n)])
    files = headers.select("file_hash", "file_check", number[F.col("header")].alias("own"))
    rows = rows.select("*", *provenance, *_file_key()).join(files, ["file_hash", "file_check"], "left")

    # the parser keeps the line of rows that are not as wide as the widest header
    fields = F.length(F.regexp_replace("line", f"{_QUOTED}|[^,]", "")) + 1
    own_width = F.array(*[F.lit(len(n)) for n in names])[F.col("own")]
    marked = F.col("line").isNotNull()
    malformed = F.when(own_width == width, marked).otherwise(~marked | (fields != own_width))
    wrong = F.when(F.col("own").isNull(), F.concat(F.lit("a file came while headers were read: "), F.col("filename"))).when(
        # a count of rows must read a column besides the marked lines, so the first one is named
        malformed, F.concat(F.lit("malformed row in "), F.col("filename"), F.lit(": "), F.coalesce("line", "c0"))
    )
    rows = rows.where(F.when(wrong.isNotNull(), F.raise_error(wrong).cast("boolean")).otherwise(True))

    def by_name(column: str) -> Column:
        """The column where each file has it."""
        value = F.lit(None).cast("string")
        for place in range(width):
            held = [n for n, own in enumerate(names) if place < len(own) and own[place] == column]
            if held:
                value = F.when(F.col("own").isin(held), F.col(f"c{place}")).otherwise(value)
        return value.alias(column)

    return rows.select(*[by_name(c) for c in united], "filename", "_source_file")


def _with_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add expected columns that no file had."""
    missing = {c: F.lit(None).cast("string") for c in columns if c not in df.columns}
    return df.withColumns(missing) if missing else df


def read_event_drops(
    spark: SparkSession, path: str | list[str], multiline: bool = False
) -> DataFrame:
    """Telemetry drops as delivered, ready for ``operators.bronze.land``."""
    return _with_columns(read_csv_by_name(spark, path, multiline), EVENT_COLUMNS)


def read_assignments(
    spark: SparkSession, path: str | list[str], multiline: bool = False
) -> DataFrame:
    """Experiment export as delivered, ready for ``operators.bronze.land``."""
    return _with_columns(read_csv_by_name(spark, path, multiline), ASSIGNMENT_COLUMNS)


def drop_date() -> Column:
    """Date a row was delivered: the last date in its file's path."""
    path = F.concat_ws("/", "filename", "_source_file")
    return F.regexp_extract(path, r".*(\d{4}-\d{2}-\d{2})", 1).try_cast("date")


def land_by_drop_date(events: DataFrame, path: str, load: str | None = None) -> None:
    """Add rows to a CSV landing folder, in folders by ``load`` and ``landing_date``.

    ``load`` names the delivery: landing it again replaces what it landed
    before on the dates that it has, and leaves other loads alone, so a load
    that failed is simply run again. Dates it does not have any more stay as they
    were. Without a name each call is a delivery of its own. The rebalance hint
    gathers each date into few files and lets adaptive execution split a date
    that holds most of the rows.
    """
    load = load or uuid.uuid4().hex
    if not re.fullmatch(r"[A-Za-z0-9._-]+", load):
        raise ValueError(f"a load is named by letters, digits and . _ - only: {load!r}")
    (
        events.select(*EVENT_COLUMNS, drop_date().alias("landing_date"), F.lit(load).alias("load"))
        .hint("rebalance", "landing_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("load", "landing_date")
        .csv(path, header=True, escape='"')
    )
