"""What the physical plans must and must not hold, so that the jobs scale."""

import pytest
from pyspark.sql import functions as F

from tickbars.operators.bars import Ohlc
from tickbars.operators.latest import keep_last, latest_n
from tickbars.operators.messages import for_tickers
from tickbars.operators.rolling import RollingMean
from tickbars.plans.queries import QUERIES
from tickbars.session import session_conf
from tickbars.sources.market import market_ticks
from tickbars.streaming.jobs import open_bars
from tickbars.streaming.serving import ENTRY, ServingTable

SF_DIR = "/root/testdata/sf0.001"
#: Queries that number rows over all tasks, and how often; one does it for both sides of
#: a join and for the least number of each key.
NUMBERED = {"time_order": 1, "tick_rolling_mean_1000_by_block": 4}


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def ticks(spark):
    return market_ticks(spark, f"{SF_DIR}/events.parquet")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_cross_join_no_python_no_single_task(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoop", "EvalPython", "InPandas", "BatchEval"):
        assert bad not in plan
    if name in NUMBERED:
        # Only the partition counts meet in one task.
        assert plan.count("SinglePartition") == NUMBERED[name] and "count(1)" in plan
    else:
        assert "SinglePartition" not in plan


def test_bars_aggregate_by_hash_before_one_shuffle(ticks):
    plan = plan_of(Ohlc(5).batch(ticks))
    assert "SortAggregate" not in plan and "Sort [" not in plan
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange") == 1
    assert "partial_min_by" in plan


def test_bars_read_only_their_columns_and_push_the_ticker_down(ticks):
    plan = plan_of(for_tickers(Ohlc(5).batch(ticks), ["click"]))
    schema = plan.split("ReadSchema: ")[1]
    assert "user_id" not in schema
    assert "EqualTo(event_type,click)" in plan or "In(event_type, [click])" in plan


def test_latest_rows_are_cut_before_the_shuffle(spark):
    rows = spark.range(100_000).select((F.col("id") % 3).alias("k"), "id")
    for cut in (latest_n(rows, ["k"], ["id"], 60), keep_last(rows, ["k"], ["id"])):
        plan = plan_of(cut)
        assert plan.count("WindowGroupLimit") == 4 and plan.count("Exchange") == 2
    # One plan for every count, whether Spark cuts before the shuffle or not.
    for count in (999, 1000, 1001, 5000):
        plan = plan_of(latest_n(rows, ["k"], ["id"], count))
        assert plan.count("Window [row_number()") == 2 and plan.count("Exchange") == 2


def test_hot_keys_are_split_by_time(ticks):
    metric = RollingMean(
        9, key="Ticker", time="event_time", value="Price", ties=["Arrival"], split=3600
    )
    plan = plan_of(metric.batch(ticks))
    # All rows go by ticker and chunk; by ticker alone only what the cut leaves.
    assert plan.count("WindowGroupLimit") >= 1
    assert "props" not in plan
    assert scans(metric.batch(ticks)) == 1


def scans(frame):
    """How often a run of ``frame`` reads its files, exchanges that are reused once."""
    frame.collect()
    final = plan_of(frame).split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
    return final.count("FileScan")


def test_open_bars_push_their_bound_to_the_scan(spark, ticks, tmp_path):
    path = str(tmp_path / "ticks")
    ticks.write.parquet(path)
    plan = plan_of(open_bars(spark.read.parquet(path), Ohlc(5)))
    assert "GreaterThanOrEqual(event_time," in plan


def test_serving_reads_push_the_key_to_the_scan(spark, tmp_path):
    table = ServingTable(spark, str(tmp_path / "table"))
    table.append(spark.createDataFrame([], ENTRY), 0)
    plan = plan_of(table.bars("A", 60))
    assert "EqualTo(ticker,A)" in plan and "EqualTo(topic,OHLC_5M)" in plan


def rows_scanned(frame):
    """Rows that the frame's scans hand on; those of skipped row groups and pages are not."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    counts = [leaves.apply(i).metrics().get("numOutputRows") for i in range(leaves.size())]
    return sum(c.get().value() for c in counts if c.isDefined())


def test_serving_reads_skip_what_cannot_hold_the_key(spark, tmp_path):
    """A key that is not there opens no row group, an id few pages, though many are stored."""
    entries = spark.range(60_000).select(
        F.lit("OHLC_5M").alias("topic"),
        F.when(F.col("id") < 20_000, "HOT").otherwise(F.concat(F.lit("T"), F.col("id"))).alias("ticker"),
        F.lit("k").alias("key"),
        F.col("id").alias("entry_id"),
        F.lit("OHLC").alias("kind"),
        *[F.lit("1.5").alias(f.name) for f in ENTRY.fields[5:]],
    )
    with session_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        table = ServingTable(spark, str(tmp_path / "table"), keep=50_000)
        table.append(entries, 0)
        assert table.read().count() == 60_000
        assert rows_scanned(table._newest("OHLC_5M", "T30000x", None)) == 0
        assert rows_scanned(table._newest("OHLC_9M", "HOT", None)) == 0
        # The page that holds the id, of 2,000 rows.
        assert 0 < rows_scanned(table.point("HOT", 19_990)) <= 4_000
        assert [r.entry_id for r in table.point("HOT", 19_990).collect()] == [19_990]
        assert rows_scanned(table._newest("OHLC_5M", "HOT", None)) >= 20_000
        assert table.point("HOT", 70_000).count() == 0


def test_each_streamed_metric_has_one_aggregation(spark, ticks):
    assert plan_of(RollingMean(9).batch(Ohlc(5).batch(ticks))).count("Exchange") == 2
