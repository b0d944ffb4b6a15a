"""Tick files: gzip CSV by date and ticker, and their Parquet form."""

from __future__ import annotations

import re
from os.path import commonprefix

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.functions.times import event_time, parse_ts_ns
from tickbars.schemas import MARKET_EVENT, TICK
from tickbars.session import exists, store

# Fixed value: where a day's file of a ticker lies under the data folder.
TICK_FILES = "*/{date}/{ticker}.csv.gz"

_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in MARKET_EVENT.fields])
_PLACE_BITS = 33
_FILE_BITS = 13


def ticker_list(tickers: str | list[str]) -> list[str]:
    """The distinct tickers of a list, or of text separated by commas, without blanks."""
    given = [tickers] if isinstance(tickers, str) else tickers
    cut = (name.strip() for text in given for name in text.split(","))
    return list(dict.fromkeys(name for name in cut if name))


def read_ticks(
    spark: SparkSession,
    root: str,
    tickers: str | list[str],
    start_date: str,
    end_date: str,
    files: str = TICK_FILES,
) -> DataFrame:
    """Ticks of ``tickers`` from the dates ``start_date`` to ``end_date``, both included.

    Tickers select files by glob and dates by path, before any file is opened; files
    that do not exist under an existing root are no error. ``Arrival`` orders the rows of
    a ticker as its files do: by the files' date, then by their name, then by place in
    the file; no two rows of a ticker share it. Clock text that is no time raises, as bad
    numbers do; ``read_checked_ticks`` sets such rows aside instead. A gzip file is one
    task, so what is read often should go through ``convert_ticks`` once.
    """
    scanned = _scan(spark, root, tickers, start_date, end_date, files, _TEXT)
    if scanned is None:
        return spark.createDataFrame([], TICK)
    rows, arrival = scanned
    return rows.select(*_typed_columns(), arrival.alias("Arrival")).withColumn(
        "event_time", event_time(F.col("Timestamp"))
    )


#: Why a line is no tick: the text of the line, the field at fault, and where it stands.
REJECT = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("Arrival", T.LongType()),
        T.StructField("reason", T.StringType()),
        T.StructField("line", T.StringType()),
    ]
)
_CORRUPT = "_line"


def read_checked_ticks(
    spark: SparkSession,
    root: str,
    tickers: str | list[str],
    start_date: str,
    end_date: str,
    files: str = TICK_FILES,
) -> tuple[DataFrame, DataFrame]:
    """The same ticks, and the lines that are none: (ticks, rejects of ``REJECT``).

    A line is rejected if it has too few or too many fields ("fields"), or if its time,
    price or quantity cannot be read ("Timestamp", "Price", "Quantity"); empty prices and
    quantities are null, not wrong. All lines are in one of the two, and bad ones keep
    their place in ``Arrival``. Both come from one checked scan, which is written under
    the shared folder, so that files are read and parsed once.
    """
    text = T.StructType([*_TEXT.fields, T.StructField(_CORRUPT, T.StringType())])
    scanned = _scan(spark, root, tickers, start_date, end_date, files, text)
    if scanned is None:
        return spark.createDataFrame([], TICK), spark.createDataFrame([], REJECT)
    rows, arrival = scanned
    given = {"Price": "double", "Quantity": "int"}
    typed = {name: F.col(name).try_cast(kind) for name, kind in given.items()}
    typed["Timestamp"] = parse_ts_ns(F.col("Date"), F.col("Timestamp"))
    reason = F.when(F.col(_CORRUPT).isNotNull(), "fields").when(
        typed["Timestamp"].isNull(), "Timestamp"
    )
    for name in given:
        bad = (F.coalesce(F.trim(name), F.lit("")) != "") & typed[name].isNull()
        reason = reason.when(bad, name)
    # What a whole line said is lost by the parse; its fields are put together again.
    line = F.coalesce(F.col(_CORRUPT), F.concat_ws(",", *[_field(n) for n in _TEXT.names]))
    checked = store(
        rows.select(
            F.col("_path").alias("file"),
            arrival.alias("Arrival"),
            reason.alias("reason"),
            F.when(reason.isNotNull(), line).alias("line"),
            *[
                typed.get(name, F.coalesce(name, F.lit(""))).alias(name)
                for name in _TEXT.names
            ],
        ),
        "checked-ticks",
    )
    good = checked.where("reason is null").select(*MARKET_EVENT.names, "Arrival")
    rejects = checked.where("reason is not null").select(REJECT.names)
    return good.withColumn("event_time", event_time(F.col("Timestamp"))), rejects


def _field(name: str) -> Column:
    return F.coalesce(name, F.lit(""))


def _scan(
    spark: SparkSession,
    root: str,
    tickers: str | list[str],
    start_date: str,
    end_date: str,
    files: str,
    schema: T.StructType,
) -> tuple[DataFrame, Column] | None:
    """Text rows of the selected files with ``_path``, and their arrival; None without files."""
    names = ticker_list(tickers)
    unfit = [name for name in names if not re.fullmatch(r"[\w.^=+-]+", name)]
    if unfit:
        raise ValueError(f"not tickers: {unfit}")
    # Names between two names begin as both do, so that only such dates are listed.
    dates = commonprefix([start_date, end_date]) + "*"
    glob = f"{root.rstrip('/')}/{files.format(date=dates, ticker='{' + ','.join(names) + '}')}"
    reader = spark.read.schema(schema).option("header", True)
    if _CORRUPT in schema.names:
        reader = reader.option("columnNameOfCorruptRecord", _CORRUPT)
    try:
        # Fail on files with other columns rather than read them by place.
        raw = reader.option("enforceSchema", False).csv(glob)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND" or not exists(spark, root):
            raise
        return None

    path_pattern = "".join(
        {"{date}": "([^/]+)", "{ticker}": "([^/]+)", "*": "[^/]*"}.get(part, re.escape(part))
        for part in re.split(r"(\{date\}|\{ticker\}|\*)", files)
    )
    path = _spelled("_metadata.file_path")
    date = F.regexp_extract(path, f"{path_pattern}$", 1)
    # The low bits count rows within a task, and a file is never split over tasks.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    rows = (
        raw.withColumn("_path", path)
        .filter(date.between(start_date, end_date))
        .withColumn("_place", place)
    )
    date = F.regexp_extract("_path", f"{path_pattern}$", 1)
    day = F.coalesce(F.unix_date(F.try_to_date(date, "yyyyMMdd")), F.lit(0))
    file = F.shiftleft(day.cast("bigint"), _FILE_BITS) + F.col("_file")
    arrival = F.shiftleft(file, _PLACE_BITS) + F.col("_place")
    return _with_file_number(rows, glob, path_pattern), arrival


def _spelled(path: str) -> Column:
    """Spark spells a local path with one slash in one place and three in another."""
    return F.regexp_replace(path, "^file:/+", "file:///")


def _with_file_number(rows: DataFrame, glob: str, path_pattern: str) -> DataFrame:
    """``_file``: the place of a row's file among those of its ticker and date, by name.

    Names are listed as a table, of which no file is opened, and numbered by Spark. Only
    files that are not their ticker's first of a date are looked up; with one file each,
    there is nothing to join.
    """
    spark = rows.sparkSession
    path = _spelled("_metadata.file_path").alias("_path")
    listed = spark.read.format("binaryFile").load(glob).select(path)
    kinds = range(path_pattern.count("([^/]+)"))
    parts = [F.regexp_extract("_path", f"{path_pattern}$", k + 1) for k in kinds]
    by_name = Window.partitionBy(*parts or ["_path"]).orderBy("_path")
    later = listed.withColumn("_number", F.row_number().over(by_name) - 1).where("_number > 0")
    # One value: the most files that a ticker has on a date, less one.
    most = later.agg(F.max("_number")).first()[0]
    if most is None:
        return rows.withColumn("_file", F.lit(0).cast("bigint"))
    if most >= 1 << _FILE_BITS:
        raise ValueError(f"more than {1 << _FILE_BITS} files of a ticker and date: {glob}")
    return rows.join(later, "_path", "left").withColumn(
        "_file", F.coalesce(F.col("_number").cast("bigint"), F.lit(0))
    )


def _typed_columns():
    """Text columns as tick columns; empty fields stay empty text, bad text raises."""
    given = F.concat_ws(" ", "Date", "Timestamp")
    typed = {
        "Timestamp": F.coalesce(
            parse_ts_ns(F.col("Date"), F.col("Timestamp")),
            F.raise_error(F.concat(F.lit("not a time: "), given)).cast("bigint"),
        ),
        "Price": F.col("Price").cast("double"),
        "Quantity": F.col("Quantity").cast("int"),
    }
    return [
        typed.get(name, F.coalesce(name, F.lit(""))).alias(name) for name in _TEXT.names
    ]


def convert_ticks(ticks: DataFrame, path: str) -> None:
    """Ticks as Parquet by day, each file sorted by ticker and time.

    A folder per day and ticker would make files too many and too small. Sorted files
    let a read skip the row groups of other tickers by their statistics instead. The
    rebalance hint has Spark split large days over tasks and join small ones. Days that
    ``ticks`` has are replaced as a whole; the others stay, so that history can be
    converted day by day.
    """
    (
        ticks.withColumn("day", F.regexp_replace(F.substring("Date", 1, 10), "-", ""))
        .hint("rebalance", "day")
        .sortWithinPartitions("day", "Ticker", "Timestamp", "Arrival")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(path)
    )


def read_converted_ticks(
    spark: SparkSession,
    path: str,
    tickers: str | list[str],
    start_date: str,
    end_date: str,
) -> DataFrame:
    """The same selection over converted ticks: days by folder, tickers by statistics."""
    day = T.StructField("day", T.StringType())
    return (
        spark.read.schema(T.StructType([*TICK.fields, day]))
        .parquet(path)
        .filter(F.col("day").between(start_date, end_date))
        .filter(F.col("Ticker").isin(ticker_list(tickers)))
        .drop("day")
    )
