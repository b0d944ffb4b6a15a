"""Registered queries: each operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.functions import text, times, values
from tickbars.models.grouped import GroupedLinearModel
from tickbars.models.linear import LinearBarModel
from tickbars.operators import facts, messages
from tickbars.operators.bars import Ohlc
from tickbars.operators.change import price_change
from tickbars.operators.latest import keep_last, latest_bar, latest_n
from tickbars.operators.lookback import BY_RANGE
from tickbars.operators.order import with_position
from tickbars.operators.partials import BarLevels, ChainedOhlc
from tickbars.operators.ranges import entry_range, in_time
from tickbars.operators.rolling import RollingMean
from tickbars.plans.jobs import publish_job, train_job
from tickbars.schemas import MARKET_EVENT, TICK, TOPIC_FOLDER, topic_schema
from tickbars.session import new_run_dir, store, use_utc
from tickbars.sources.facts import read_facts
from tickbars.sources.market import as_ticks, market_tick_stream, market_ticks
from tickbars.sources.ticks import (
    convert_ticks,
    read_checked_ticks,
    read_converted_ticks,
    read_ticks,
)
from tickbars.sources.topics import MessageTable
from tickbars.streaming.hops import MessageHop, TableHop, typed_rows
from tickbars.streaming.jobs import (
    default_metrics,
    land,
    open_bars,
    replay,
    start_table,
    stream_job,
    with_event_watermark,
)
from tickbars.streaming.live import LiveTable, live_bars, wait_for_silence
from tickbars.streaming.means import MeanTable, start_mean
from tickbars.streaming.serving import ServingTable, serve_job
from tickbars.streaming.supervise import Supervisor

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    """Register ``run`` under its name; its clock is UTC and its times carry no zone."""

    def registered(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _zoneless(run(use_utc(spark), sf_dir))

    QUERIES[run.__name__] = registered
    return run


def _zoneless(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else name
            for name, kind in df.dtypes
        ]
    )


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market_ticks(spark, f"{sf_dir}/events.parquet")


def _tick_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market_tick_stream(spark, f"{sf_dir}/events.parquet")


def _bars(spark: SparkSession, sf_dir: str, minutes: int) -> DataFrame:
    return Ohlc(minutes).batch(_ticks(spark, sf_dir))


def _rounded(df: DataFrame, column: str, places: int = 6) -> DataFrame:
    return df.withColumn(column, F.round(column, places))


def _bar_messages(bars: DataFrame, topic: str = "OHLC_5M") -> DataFrame:
    return messages.to_messages(bars, topic, F.unix_millis("window_end"))


# --- Ticks: parsing, time, files -------------------------------------------------------


@query
def parse_timestamp(spark, sf_dir):
    """Five spellings of the time, one per event type, read back to nanoseconds."""
    events = _table(spark, sf_dir, "events")
    kind, ts = F.col("event_type"), F.col("ts")
    nanos = F.unix_micros(ts.cast("timestamp")) * 1000
    date = F.when(
        kind.isin("purchase", "error"), F.date_format(ts, "yyyyMMdd")
    ).otherwise(F.date_format(ts, "yyyy-MM-dd"))
    time = (
        F.when(kind == "click", nanos.cast("string"))
        .when(kind == "purchase", F.date_format(ts, "HH:mm:ss"))
        .when(kind == "signup", F.date_format(ts, "H:m:s.SSSSSS"))
        .when(kind == "error", F.concat(F.date_format(ts, "HH:mm:ss.SSSSSS"), F.lit("123456")))
        .otherwise(F.date_format(ts, "HH:mm:ss.SSSSSS"))
    )
    return events.select("event_id", times.parse_ts_ns(date, time).alias("ts_ns"))


@query
def event_time(spark, sf_dir):
    return _ticks(spark, sf_dir).select(F.col("Arrival").alias("event_id"), "event_time")


_DATES = ("20240105", "20240124")
_TICKERS = "click, view, purchase"


@query
def tick_csv_scan(spark, sf_dir):
    """All ticks written as gzip CSV by date and ticker, then a selection read back."""
    root = new_run_dir(spark, "tick-files")
    (
        _ticks(spark, sf_dir)
        .select(
            *MARKET_EVENT.names,
            F.year("event_time").alias("year"),
            F.date_format("event_time", "yyyyMMdd").alias("day"),
            F.col("Ticker").alias("symbol"),
        )
        .hint("rebalance", "day", "symbol")
        .write.partitionBy("year", "day", "symbol")
        .option("header", True)
        .option("compression", "gzip")
        .csv(root)
    )
    ticks = read_ticks(
        spark, root, _TICKERS, *_DATES, files="year=*/day={date}/symbol={ticker}/*.csv.gz"
    )
    return ticks.select(MARKET_EVENT.names)


_FOLDERS = "year=*/day={date}/symbol={ticker}/*.csv.gz"


def _checked(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Ticks as gzip CSV in which one ticker has no prices and one no times."""
    root = new_run_dir(spark, "tick-files")
    ticker = F.col("Ticker")
    ticks = _ticks(spark, sf_dir)
    broken = {
        "Price": F.when(ticker == "error", "n/a").otherwise(F.col("Price").cast("string")),
        "Timestamp": F.when(ticker == "signup", "soon").otherwise(
            F.col("Timestamp").cast("string")
        ),
    }
    (
        ticks.select(
            *[broken.get(c, F.col(c)).alias(c) for c in MARKET_EVENT.names],
            F.year("event_time").alias("year"),
            F.date_format("event_time", "yyyyMMdd").alias("day"),
            ticker.alias("symbol"),
        )
        .hint("rebalance", "day", "symbol")
        .write.partitionBy("year", "day", "symbol")
        .option("header", True)
        .option("compression", "gzip")
        .csv(root)
    )
    tickers = "click, view, purchase, signup, error"
    return read_checked_ticks(spark, root, tickers, "20240101", "20241231", _FOLDERS)


@query
def tick_csv_checked(spark, sf_dir):
    """The good rows of files that also have bad ones."""
    return _checked(spark, sf_dir)[0].select(MARKET_EVENT.names)


@query
def tick_csv_rejects(spark, sf_dir):
    """The bad rows of those files, and what is wrong with them."""
    field = F.split("line", ",")
    return _checked(spark, sf_dir)[1].select(
        "reason",
        field[0].alias("date"),
        field[3].alias("ticker"),
        field[5].cast("int").alias("quantity"),
    )


@query
def tick_parquet_scan(spark, sf_dir):
    """The same selection over ticks converted to Parquet by day."""
    path = new_run_dir(spark, "converted-ticks")
    convert_ticks(_ticks(spark, sf_dir), path)
    return read_converted_ticks(spark, path, _TICKERS, *_DATES).select(MARKET_EVENT.names)


@query
def tick_convert_by_day(spark, sf_dir):
    """Two ranges of days converted one after the other: the second leaves the first."""
    path = new_run_dir(spark, "converted-ticks")
    ticks = _ticks(spark, sf_dir)
    early = F.col("Date") < "2024-01-16"
    convert_ticks(ticks.filter(early), path)
    convert_ticks(ticks.filter(~early), path)
    everyone = [r[0] for r in _ticks(spark, sf_dir).select("Ticker").distinct().collect()]
    return read_converted_ticks(spark, path, everyone, "20240101", "20241231").select(
        "Date", "Timestamp", "Ticker", "Price", "Quantity", F.col("Arrival").alias("event_id")
    )


@query
def tick_csv_bars(spark, sf_dir):
    """Hourly bars of gzip CSV files; open and close go by the place in the files."""
    root = new_run_dir(spark, "tick-files")
    (
        _ticks(spark, sf_dir)
        .select(
            *MARKET_EVENT.names,
            "Arrival",
            F.year("event_time").alias("year"),
            F.date_format("event_time", "yyyyMMdd").alias("day"),
            F.col("Ticker").alias("symbol"),
        )
        .repartition("year", "day", "symbol")
        .sortWithinPartitions("year", "day", "symbol", "Timestamp", "Arrival")
        .drop("Arrival")
        .write.partitionBy("year", "day", "symbol")
        .option("header", True)
        .option("compression", "gzip")
        .csv(root)
    )
    ticks = read_ticks(
        spark, root, _TICKERS, *_DATES, files="year=*/day={date}/symbol={ticker}/*.csv.gz"
    )
    return Ohlc(60).batch(ticks)


@query
def time_order(spark, sf_dir):
    """The place of every tick in the merged stream."""
    return with_position(_ticks(spark, sf_dir)).select(
        F.col("Arrival").alias("event_id"), "position"
    )


@query
def ticker_counts(spark, sf_dir):
    """Ticks per ticker, the ticker upper-cased."""
    ticker = F.upper("Ticker").alias("ticker")
    return _ticks(spark, sf_dir).groupBy(ticker).agg(F.count("*").alias("ticks"))


@query
def ticker_filter(spark, sf_dir):
    """Five-minute bars of two tickers; the filter reaches the scan."""
    return messages.for_tickers(_bars(spark, sf_dir, 5), ["click", "error"])


# --- Bars and indicators ---------------------------------------------------------------


@query
def ohlc_5m(spark, sf_dir):
    return _bars(spark, sf_dir, 5)


@query
def ohlc_60m(spark, sf_dir):
    return _bars(spark, sf_dir, 60)


@query
def ohlc_1440m(spark, sf_dir):
    return _bars(spark, sf_dir, 1440)


@query
def ohlc_60m_time_order(spark, sf_dir):
    """Open and close by time, then arrival, for ticks that need not arrive in order."""
    return Ohlc(60, order=("Timestamp", "Arrival")).batch(_ticks(spark, sf_dir))


@query
def rolling_mean_9(spark, sf_dir):
    return _rounded(RollingMean(9).batch(_bars(spark, sf_dir, 5)), "ema_value")


@query
def rolling_mean_12(spark, sf_dir):
    return _rounded(RollingMean(12).batch(_bars(spark, sf_dir, 5)), "ema_value")


@query
def rolling_mean_9_60m(spark, sf_dir):
    return _rounded(RollingMean(9).batch(_bars(spark, sf_dir, 60)), "ema_value")


def _tick_means(spark: SparkSession, sf_dir: str, split: int | str) -> DataFrame:
    metric = RollingMean(
        9, key="Ticker", time="event_time", value="Price", ties=["Arrival"], split=split
    )
    means = metric.batch(_ticks(spark, sf_dir)).withColumnRenamed("Arrival", "event_id")
    return _rounded(means, "ema_value")


@query
def tick_rolling_mean_9(spark, sf_dir):
    """Over the ticks themselves, where a ticker may be hot: groups of ticker and hour."""
    return _tick_means(spark, sf_dir, 3600)


@query
def tick_rolling_mean_9_by_range(spark, sf_dir):
    """The same in groups of like size, where even an hour may be hot."""
    return _tick_means(spark, sf_dir, BY_RANGE)


def _cent_means(spark: SparkSession, sf_dir: str, split: str | None) -> DataFrame:
    """Over whole cents, whose sums are exact in any order."""
    ticks = _ticks(spark, sf_dir)
    cents = F.round(F.col("Price") * 100).cast("bigint")
    metric = RollingMean(
        1000, key="Ticker", time="event_time", value="cents", ties=["Arrival"], split=split
    )
    means = metric.batch(ticks.withColumn("cents", cents))
    return means.withColumnRenamed("Arrival", "event_id")


@query
def tick_rolling_mean_1000(spark, sf_dir):
    """A frame of a thousand ticks from two block sums a row."""
    return _cent_means(spark, sf_dir, None)


@query
def tick_rolling_mean_1000_by_block(spark, sf_dir):
    """The same where a ticker may be hot: every block is a group of its own."""
    return _cent_means(spark, sf_dir, BY_RANGE)


@query
def bar_price_change(spark, sf_dir):
    return price_change(_bars(spark, sf_dir, 60)).select(
        "ticker", "window_end", "close_price", "change", "percent_change"
    )


@query
def candle_direction(spark, sf_dir):
    direction = values.candle_direction(F.col("open_price"), F.col("close_price"))
    return _bars(spark, sf_dir, 60).select(
        "ticker", "window_end", direction.alias("direction")
    )


@query
def latest_bar_snapshot(spark, sf_dir):
    # Read twice, so stored: the ticks are many times larger than their bars.
    bars = store(_bars(spark, sf_dir, 5), "bars")
    return _rounded(latest_bar(bars, RollingMean(9).latest(bars)), "ema")


@query
def latest_60(spark, sf_dir):
    return in_time(
        latest_n(_bars(spark, sf_dir, 5), ["ticker"], ["window_end"], 60), "window_end"
    )


@query
def latest_60_ticks(spark, sf_dir):
    """Over the ticks themselves, where a hot ticker sends rows from every task."""
    newest = latest_n(_ticks(spark, sf_dir), ["Ticker"], ["Timestamp", "Arrival"], 60)
    return newest.select("Ticker", F.col("Arrival").alias("event_id"), "Price")


@query
def keep_last_1000(spark, sf_dir):
    return keep_last(_bars(spark, sf_dir, 5), ["ticker"], ["window_end"])


@query
def latest_1200(spark, sf_dir):
    """More rows than Spark cuts by itself before the shuffle."""
    return latest_n(_bars(spark, sf_dir, 5), ["ticker"], ["window_end"], 1200)


@query
def served_entry_range(spark, sf_dir):
    """Entries of one ticker between two ids, oldest first, at most 200."""
    entries = messages.serving_entries(_bar_messages(_bars(spark, sf_dir, 5)))
    # Ids are bar ends in milliseconds: from 2024-01-05 to 2024-01-20.
    found = entry_range(entries, "click", 1704412800000, 1705708800000, 200)
    return messages.as_bars(found).select("ticker", "entry_id", "close")


# --- Bars from bars --------------------------------------------------------------------


def _landed_levels(spark: SparkSession, sf_dir: str) -> BarLevels:
    """Three files: the first and the last days, then, late, the days between."""
    levels = BarLevels(spark, new_run_dir(spark, "bar-levels"))
    ticks = _ticks(spark, sf_dir)
    date = F.col("Date")
    between = date.between("2024-01-10", "2024-01-19")
    # The late file also has ticks of one ticker of all days, in windows with bars.
    late = between | (F.col("Ticker") == "error")
    levels.add(ticks.filter(~late & (date < "2024-01-10")), "first")
    levels.add(ticks.filter(~late & (date > "2024-01-19")), "last")
    levels.add(ticks.filter(late), "late")
    return levels


@query
def merged_bars(spark, sf_dir):
    """Bars of 5, 60 and 1,440 minutes from partial bars; ticks are read once a file."""
    levels = _landed_levels(spark, sf_dir)
    five, hourly, daily = [
        levels.bars(m).withColumn("minutes", F.lit(m)) for m in levels.minutes
    ]
    return five.unionByName(hourly).unionByName(daily)


@query
def late_file_bars(spark, sf_dir):
    """The hourly bars that a late file changes or adds."""
    return _landed_levels(spark, sf_dir).changed(60, "late")


@query
def rewritten_bars(spark, sf_dir):
    """Daily bars after the files' parts were put together."""
    levels = _landed_levels(spark, sf_dir).rewrite(new_run_dir(spark, "bar-levels"))
    return levels.bars(1440)


# --- Messages and serving --------------------------------------------------------------


@query
def parse_bars_json(spark, sf_dir):
    """Bars written as JSON messages and decoded by the topic's schema."""
    encoded = _bar_messages(_bars(spark, sf_dir, 5))
    return messages.decode(encoded, topic_schema("OHLC_5M"))


@query
def parse_indicators_json(spark, sf_dir):
    means = RollingMean(9).batch(_bars(spark, sf_dir, 60))
    encoded = messages.to_messages(means, "OHLC_60M_EMA_9", F.unix_millis("snapshot_time"))
    read = messages.as_indicators(messages.serving_entries(encoded))
    return _rounded(read.select("topic", "ticker", "entry_id", "ema", "timestamp"), "ema")


@query
def route_messages(spark, sf_dir):
    """Events as messages of five topics, of which one is of no known kind."""
    ticker = F.col("event_type")
    topic = (
        F.when(ticker == "click", "OHLC_5M")
        .when(ticker == "view", "ohlc_5m_ema_9")
        .when(ticker == "purchase", "Ema")
        .when(ticker == "signup", "ohlc")
        .otherwise("market")
    )
    kind = messages.message_kind(F.col("topic"))
    return (
        _table(spark, sf_dir, "events")
        .select("event_id", ticker.alias("ticker"), topic.alias("topic"))
        .select(
            "event_id",
            kind.alias("kind"),
            messages.serving_key(F.col("topic"), F.col("ticker")).alias("key"),
        )
        .filter(F.col("kind").isNotNull())
    )


@query
def serve_bars(spark, sf_dir):
    """Bars as messages, some of them broken, down to what a reader gets."""
    ticker = F.col("ticker")
    fields = [
        F.when(ticker != "view", ticker).alias("ticker"),
        *[
            F.when(ticker != "signup", F.col(c).cast("string")).alias(c)
            for c in ("window_start", "window_end", "open_price", "high_price", "low_price")
        ],
        F.when(ticker != "signup", F.col("close_price")).alias("close_price"),
        F.when(ticker == "click", F.col("volume")).alias("volume"),
    ]
    value = F.when(ticker == "error", '{"ticker": "error", ').otherwise(
        F.to_json(F.struct(*fields))
    )
    sent = _bars(spark, sf_dir, 60).select(
        F.lit("OHLC_60M").alias("topic"),
        value.alias("value"),
        F.unix_millis("window_end").alias("offset"),
    )
    return messages.as_bars(messages.serving_entries(sent)).drop("start", "end")


@query
def coerce_numbers(spark, sf_dir):
    kind, plain = F.col("event_type"), F.col("value").cast("string")
    served = (
        F.when(kind == "click", plain)
        .when(kind == "view", F.concat(F.lit(" "), plain, F.lit(" ")))
        .when(kind == "purchase", F.concat(plain, F.lit("d")))
        .when(kind == "signup", F.lit(""))
        .otherwise(F.concat(F.lit("n/a "), plain))
    )
    return _table(spark, sf_dir, "events").select(
        "event_id", values.to_number(served).alias("number")
    )


@query
def served_times(spark, sf_dir):
    """Indicator times as milliseconds, as text, and as neither; bar ends as text."""
    kind, ts = F.col("event_type"), F.col("ts")
    clock = F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS")
    time = (
        F.when(kind.isin("click", "view"), F.unix_millis(ts.cast("timestamp")).cast("string"))
        .when(kind.isin("purchase", "signup"), clock)
        .otherwise(F.concat(F.lit("at "), clock))
    )
    end = F.when(kind == "error", "soon").otherwise(F.regexp_replace(clock, " ", "T"))
    return _table(spark, sf_dir, "events").select(
        "event_id",
        times.indicator_time(time).alias("indicator_time"),
        times.bar_time(end).alias("bar_time"),
    )


_DAYS = [("2024-01-01", "2024-01-10"), ("2024-01-11", "2024-01-20"), ("2024-01-21", "9999")]


# --- Streams, each run to its end ------------------------------------------------------


def _streamed(spark: SparkSession, stream: DataFrame, table: str) -> DataFrame:
    root = new_run_dir(spark, "stream")
    start_table(stream, root, table).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/{table}")


@query
def stream_ohlc_5m(spark, sf_dir):
    ticks = with_event_watermark(_tick_stream(spark, sf_dir))
    return _streamed(spark, Ohlc(5).stream(ticks), "OHLC_5M")


@query
def stream_ohlc_60m(spark, sf_dir):
    ticks = with_event_watermark(_tick_stream(spark, sf_dir))
    return _streamed(spark, Ohlc(60).stream(ticks), "OHLC_60M")


def _with_waiting(spark: SparkSession, metric: RollingMean, root: str) -> DataFrame:
    """All means of a finished stream: the emitted ones and those behind its watermark."""
    table = MeanTable(spark, metric, root)
    return _rounded(table.read().unionByName(table.waiting()), "ema_value")


@query
def stream_rolling_mean_9(spark, sf_dir):
    """Hourly bars as a stream, and their means as a stream over the bars' table."""
    root = new_run_dir(spark, "stream")
    mean = RollingMean(9, source_table="OHLC_60M")
    stream_job(spark, _tick_stream(spark, sf_dir), root, [Ohlc(60), mean])
    return _with_waiting(spark, mean, root)


@query
def stream_job_means(spark, sf_dir):
    """The whole streaming job; both mean tables, under their metric's name."""
    root = new_run_dir(spark, "stream-job")
    metrics = default_metrics()
    stream_job(spark, _tick_stream(spark, sf_dir), root, metrics)
    first, second = [
        _with_waiting(spark, m, root).withColumn("metric", F.lit(m.target_table))
        for m in metrics[1:]
    ]
    return first.unionByName(second)


@query
def stream_job_messages(spark, sf_dir):
    """The streaming job with JSON messages between its hops; the means as they were sent."""
    root = new_run_dir(spark, "stream-topics")
    hop = MessageHop(spark, root)
    mean = RollingMean(9, source_table="OHLC_60M")
    stream_job(spark, _tick_stream(spark, sf_dir), root, [Ohlc(60), mean], hop=hop)
    sent = typed_rows(hop.read(mean.target_table), mean.schema)
    waiting = MeanTable(spark, mean, root).waiting()
    return _rounded(sent.unionByName(waiting), "ema_value")


class _FailsOnce(TableHop):
    """Tables whose means fail once, in their second micro-batch, before they are done."""

    failed = False

    def append(self, table):
        def fail(rows: DataFrame, batch_id: int) -> None:
            if batch_id == 1 and not self.failed:
                self.failed = True
                raise OSError("a failure on purpose")

        return fail


@query
def stream_supervised_means(spark, sf_dir):
    """The job kept alive over a failure; its means are those of a job without one."""
    root = new_run_dir(spark, "supervised")
    ticks = _ticks(spark, sf_dir)
    mean = RollingMean(9, source_table="OHLC_60M")

    def source() -> DataFrame:
        return spark.readStream.schema(TICK).parquet(f"{root}/ticks/*")

    # The glob needs something to match before a stream reads it.
    land(ticks.filter(F.col("Date") < _DAYS[0][0]), f"{root}/ticks", "none")
    hop = _FailsOnce(spark, root)
    job = Supervisor(spark, source, root, [Ohlc(60), mean], hop=hop, processing_time="0 seconds")
    with job:
        for k, (first, last) in enumerate(_DAYS):
            land(ticks.filter(F.col("Date").between(first, last)), f"{root}/ticks", str(k))
            job.process_all()
    return _with_waiting(spark, mean, root)


@query
def stream_tick_mean_9(spark, sf_dir):
    """Means over the ticks themselves, landed in five stretches cut within a second."""
    root = new_run_dir(spark, "tick-means")
    metric = RollingMean(
        9, key="Ticker", time="event_time", value="Price", ties=["Arrival"],
        target_table="TICK_EMA_9",
    )
    ticks = _ticks(spark, sf_dir).select(TICK.names)
    # Two values: the time span in nanoseconds.
    low, high = ticks.agg(F.min("Timestamp"), F.max("Timestamp")).first()
    step = (high - low) // 5 + 1
    table = MeanTable(spark, metric, root)
    for k in range(5):
        first = low + k * step
        stretch = F.col("Timestamp").between(first, first + step - 1)
        ticks.filter(stretch).write.parquet(f"{root}/ticks/{k}")
        source = spark.readStream.schema(TICK).parquet(f"{root}/ticks/*")
        start_mean(table, source, root).awaitTermination()
    return _with_waiting(spark, metric, root).withColumnRenamed("Arrival", "event_id")


@query
def stream_late_rows(spark, sf_dir):
    """One ticker comes after all others; only its rows in open windows still count."""
    root = new_run_dir(spark, "late")
    ticks = _ticks(spark, sf_dir)
    late = F.col("Ticker") == "error"
    replay(spark, [ticks.filter(~late), ticks.filter(late)], root, [Ohlc(60)])
    return spark.read.parquet(f"{root}/OHLC_60M")


@query
def stream_replay_60m(spark, sf_dir):
    """History in three stretches of time, each streamed to its end before the next."""
    root = new_run_dir(spark, "replay")
    events = _table(spark, sf_dir, "events")
    # Two values: the time span, cut in three.
    span = events.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    third = (span.hi - span.lo) / 3
    ts = F.col("ts")
    slices = [
        events.filter(ts < span.lo + third),
        events.filter((ts >= span.lo + third) & (ts < span.lo + 2 * third)),
        events.filter(ts >= span.lo + 2 * third),
    ]
    bars = Ohlc(60)
    metrics = [bars, RollingMean(9, source_table=bars.target_table)]
    replay(spark, [as_ticks(s) for s in slices], root, metrics)
    return _with_waiting(spark, metrics[1], root)


@query
def stream_open_bars(spark, sf_dir):
    """The bars the stream has left open, from the last ticks."""
    return open_bars(_ticks(spark, sf_dir), Ohlc(60))


@query
def stream_bars_on_bars(spark, sf_dir):
    """Five-minute bars made into hourly ones within one query, over several batches."""
    root = new_run_dir(spark, "chained")
    ticks = _ticks(spark, sf_dir).select(TICK.names)
    bars = ChainedOhlc(60, 5)
    for k, (first, last) in enumerate(_DAYS):
        ticks.filter(F.col("Date").between(first, last)).write.parquet(f"{root}/ticks/{k}")
        source = spark.readStream.schema(TICK).parquet(f"{root}/ticks/*")
        stream = bars.stream(with_event_watermark(source))
        start_table(stream, root, "OHLC_60M").awaitTermination()
    return spark.read.schema(bars.schema).parquet(f"{root}/OHLC_60M")


def _live(spark: SparkSession, parts: list[DataFrame]) -> LiveTable:
    """Parts streamed one after the other, each until its tickers are silent."""
    root = new_run_dir(spark, "live")
    table = LiveTable(spark, root, "OHLC_60M")
    for k, part in enumerate(parts):
        part.select(TICK.names).write.parquet(f"{root}/ticks/{k}")
        source = spark.readStream.schema(TICK).parquet(f"{root}/ticks/*")
        running = table.start(live_bars(with_event_watermark(source), 60), partitions=4)
        try:
            wait_for_silence(running)
        finally:
            running.stop()
    return table


@query
def stream_idle_bars(spark, sf_dir):
    """All bars of a stream that falls silent twice: none is left open, none comes twice."""
    ticks = _ticks(spark, sf_dir)
    # Silence between two days, so that no window has rows on both sides.
    early = F.col("Date") < "2024-01-16"
    return _live(spark, [ticks.filter(early), ticks.filter(~early)]).bars()


@query
def stream_late_table(spark, sf_dir):
    """One ticker comes after all others: its rows in closed windows, and those they missed."""
    ticks = _ticks(spark, sf_dir)
    late = F.col("Ticker") == "error"
    rows = _live(spark, [ticks.filter(~late), ticks.filter(late)]).late()
    return rows.withColumnRenamed("Arrival", "event_id")


@query
def stream_serving(spark, sf_dir):
    """Bar and mean messages through the serving stream; what the table then holds."""
    root = new_run_dir(spark, "serving")
    bars = store(_bars(spark, sf_dir, 5), "bars")
    means = RollingMean(9).batch(bars)
    sent = _bar_messages(bars).unionByName(
        messages.to_messages(means, "OHLC_5M_EMA_9", F.unix_millis("snapshot_time"))
    )
    sent.write.parquet(f"{root}/messages")
    table = ServingTable(spark, f"{root}/table")
    stream = spark.readStream.schema(sent.schema).parquet(f"{root}/messages")
    serve_job(stream, table, f"{root}/checkpoint").awaitTermination()
    served = table.read().select("topic", "ticker", "entry_id", "close", "ema")
    number = values.to_number(F.coalesce("close", "ema"))
    return _rounded(
        served.select("topic", "ticker", "entry_id", number.alias("number")), "number"
    )


@query
def served_id_range(spark, sf_dir):
    """One ticker's means between two ids, as the serving table still has them."""
    root = new_run_dir(spark, "serving")
    means = RollingMean(9).batch(_bars(spark, sf_dir, 5))
    sent = messages.to_messages(means, "OHLC_5M_EMA_9", F.unix_millis("snapshot_time"))
    table = ServingTable(spark, f"{root}/table")
    table.append(messages.serving_entries(sent), 0)
    # Ids are bar ends in milliseconds: from 2024-01-05 to 2024-01-20.
    found = table.indicator_range("click", 1704412800000, 1705708800000)
    return _rounded(found.select("ticker", "entry_id", "ema"), "ema")


@query
def served_header(spark, sf_dir):
    """The header of one ticker, from what the serving table holds."""
    root = new_run_dir(spark, "serving")
    bars = store(_bars(spark, sf_dir, 5), "bars")
    means = RollingMean(9).batch(bars)
    table = ServingTable(spark, f"{root}/table", compact_every=2)
    for batch_id, sent in enumerate(
        [
            _bar_messages(bars),
            messages.to_messages(means, "OHLC_5M_EMA_9", F.unix_millis("snapshot_time")),
        ]
    ):
        table.append(messages.serving_entries(sent), batch_id)
    return _rounded(table.header("click"), "ema")


@query
def publish_stream_bars(spark, sf_dir):
    """Ticks published as messages in three slices by several tasks, then streamed to bars."""
    root = new_run_dir(spark, "topic")
    topic = MessageTable(spark, f"{root}/market")
    ticks = _ticks(spark, sf_dir)
    slices = [ticks.filter(F.col("Date").between(*d)) for d in _DAYS]
    publish_job(slices, lambda rows, k: topic.append(messages.placed_messages(rows), k))
    source = messages.event_ticks(topic.stream())
    return _streamed(spark, Ohlc(60).stream(with_event_watermark(source)), "OHLC_60M")


# --- Models ----------------------------------------------------------------------------


@query
def linear_model_predictions(spark, sf_dir):
    """Fitted on all five-minute bars and applied to the same rows."""
    bars = store(_bars(spark, sf_dir, 5), "bars")
    model = LinearBarModel()
    model.fit(bars)
    return _rounded(
        model.predict(bars).select("ticker", "window_end", "prediction"), "prediction", 4
    )


@query
def train_job_predictions(spark, sf_dir):
    """The training job over a topic of bar messages, for a model of one ticker."""
    sent = store(_bar_messages(_bars(spark, sf_dir, 5)), "messages")
    [outcome] = train_job(lambda topic: sent, [LinearBarModel(["click"])])
    return _rounded(
        outcome.predictions.select("ticker", "window_end", "prediction"), "prediction", 4
    )


@query
def train_job_topics(spark, sf_dir):
    """Schemas from files, one topic without rows, and two models on another."""
    hourly = _bar_messages(_bars(spark, sf_dir, 60), "OHLC_60M")
    topics = {"OHLC_60M": hourly, "OHLC_5M": hourly.limit(0)}
    models = [
        LinearBarModel(["click"], "OHLC_60M"),
        LinearBarModel(topic="OHLC_5M"),
        LinearBarModel(["view"], "OHLC_60M"),
    ]
    outcomes = train_job(topics.__getitem__, models, schemas_dir=TOPIC_FOLDER)
    first, second = [o.predictions for o in outcomes if o.trained]
    return _rounded(
        first.unionByName(second).select("ticker", "window_end", "prediction"), "prediction", 4
    )


@query
def train_job_by_ticker(spark, sf_dir):
    """A regression for every ticker of a topic, all of them in one pass."""
    sent = store(_bar_messages(_bars(spark, sf_dir, 60), "OHLC_60M"), "messages")
    [outcome] = train_job(
        lambda topic: sent, [GroupedLinearModel(topic="OHLC_60M")], schemas_dir=TOPIC_FOLDER
    )
    return _rounded(
        outcome.predictions.select("ticker", "window_end", "prediction"), "prediction", 4
    )


@query
def grouped_model_weights(spark, sf_dir):
    """What each ticker's regression was fitted on, and what it says of a mean bar."""
    bars = store(_bars(spark, sf_dir, 60), "bars")
    model = GroupedLinearModel()
    model.fit(bars)
    means = bars.groupBy("ticker").agg(*[F.avg(c).alias(c) for c in model.features])
    said = model.predict(means).join(model.coefficients.select("ticker", "rows"), "ticker")
    return _rounded(said.select("ticker", "rows", "prediction"), "prediction", 4)


@query
def prediction_head(spark, sf_dir):
    """The ten predictions a training run shows, the newest of one ticker."""
    return train_job_predictions(spark, sf_dir).orderBy(F.col("window_end").desc()).limit(10)


# --- Company facts ---------------------------------------------------------------------


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as companies: balances as prices, the rest scaled from them."""
    price, nation = F.col("c_acctbal"), F.col("c_nationkey")
    return _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("ticker"),
        price.alias("currentPrice"),
        (price - nation).alias("previousClose"),
        (price * 1000000.0).alias("marketCap"),
        (price * 1000.0).alias("totalRevenue"),
        (price * 100.0).alias("netIncomeToCommon"),
        (nation / 2.0).alias("trailingPE"),
        (nation / 100.0).alias("dividendYield"),
        (nation / 10.0).alias("beta"),
        (nation / 50.0).alias("profitMargins"),
        (nation / 40.0).alias("returnOnEquity"),
        (nation / 30.0).alias("grossMargins"),
        (nation / 60.0).alias("operatingMargins"),
        (price * 1.5).alias("targetMeanPrice"),
        (price * 2.0).alias("targetHighPrice"),
        (price * 0.5).alias("targetLowPrice"),
        (nation / 5.0).alias("recommendationMean"),
        nation.alias("numberOfAnalystOpinions"),
    )


def _balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = F.col("o_totalprice")
    return _table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("ticker"),
        F.col("o_orderdate").alias("date"),
        F.col("o_orderkey").alias("number"),
        total.alias("Total Assets"),
        (total * 0.25).alias("Total Debt"),
        (total * 0.5).alias("Cash And Cash Equivalents"),
    )


def _cashflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    return _table(spark, sf_dir, "events").select(
        F.col("user_id").alias("ticker"),
        F.col("ts").alias("date"),
        F.col("event_id").alias("number"),
        value.alias("Operating Cash Flow"),
        (value * 0.5).alias("Free Cash Flow"),
        (value * -2.0).alias("Capital Expenditure"),
    )


@query
def company_snapshot(spark, sf_dir):
    return facts.company_snapshot(
        _facts(spark, sf_dir),
        _balance(spark, sf_dir),
        _cashflow(spark, sf_dir),
        ["date", "number"],
        ["date", "number"],
    )


@query
def latest_statement(spark, sf_dir):
    return facts.latest_statement(
        _balance(spark, sf_dir),
        ["date", "number"],
        {"date": "date", "total_assets": "Total Assets"},
    )


@query
def fact_price_change(spark, sf_dir):
    price, previous = F.col("currentPrice"), F.col("previousClose")
    change = values.price_change(price, previous)
    return _facts(spark, sf_dir).select(
        "ticker", change.alias("change"), values.percent_of(change, previous).alias("percent")
    )


@query
def target_upside(spark, sf_dir):
    target = F.col("l_extendedprice") * (1 + F.col("l_tax"))
    return _table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        values.target_upside(target, F.col("l_extendedprice")).alias("upside"),
    )


@query
def rating_band(spark, sf_dir):
    rating = F.col("p_size") / 10.0
    return _table(spark, sf_dir, "part").select(
        "p_partkey", values.rating_band(rating).alias("band")
    )


@query
def amount_text(spark, sf_dir):
    """Order totals, scaled by priority so that every unit occurs."""
    priority, total = F.col("o_orderpriority"), F.col("o_totalprice")
    amount = (
        F.when(priority == "1-URGENT", total * 10000000.0)
        .when(priority == "2-HIGH", total * 10000.0)
        .when(priority == "3-MEDIUM", total * -1.0)
        .when(priority == "4-NOT SPECIFIED", total / 1024.0)
        .otherwise(total * 10.0)
    )
    return _table(spark, sf_dir, "orders").select(
        "o_orderkey", text.amount_text(amount).alias("amount")
    )


@query
def percent_text(spark, sf_dir):
    ratio = F.col("l_discount") * F.col("l_tax") - F.col("l_quantity") / 64.0
    return _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", text.percent_text(ratio).alias("percent")
    )


@query
def shorten_text(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select(
        "doc_id", text.shorten(F.col("text")).alias("summary")
    )


@query
def news_head(spark, sf_dir):
    """The first ten documents, with their summaries."""
    return facts.news_head(_table(spark, sf_dir, "documents"), "doc_id").select(
        "doc_id", "source", text.shorten(F.col("text")).alias("summary")
    )


@query
def facts_csv_scan(spark, sf_dir):
    """Documents written as quoted CSV, with their line breaks, and read back."""
    path = new_run_dir(spark, "facts")
    columns = ["doc_id", "source", "text"]
    documents = _table(spark, sf_dir, "documents").select(columns)
    documents.write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    read = read_facts(spark, path, documents.schema)
    return read.select("doc_id", "source", F.md5("text").alias("digest"))
