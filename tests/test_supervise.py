"""A job whose metrics fail and are started again."""

import pytest
from pyspark.sql import functions as F

from test_streaming import random_ticks, rows_of, ticks
from tickbars.operators.bars import Ohlc
from tickbars.operators.rolling import RollingMean
from tickbars.schemas import BAR, TICK
from tickbars.session import make_folder
from tickbars.streaming.hops import TableHop
from tickbars.streaming.jobs import land
from tickbars.streaming.means import MeanTable
from tickbars.streaming.supervise import JobFailed, Supervisor

PARTS = 3


class Fails(TableHop):
    """Tables written batch by batch; ``table`` fails in its second, so many times."""

    def __init__(self, spark, root, table, times):
        super().__init__(spark, root)
        self.table, self.left = table, times

    def _fail(self, table, batch_id):
        if table == self.table and batch_id == 1 and self.left:
            self.left -= 1
            raise OSError("a failure on purpose")

    def start(self, rows, table, checkpoint, **trigger):
        def write(batch, batch_id):
            # Before it writes: a stream may already know the files that a batch replaces.
            self._fail(table, batch_id)
            batch.write.mode("overwrite").parquet(f"{self.root}/{table}/batch-{batch_id}")

        writer = rows.writeStream.queryName(table).option("checkpointLocation", checkpoint)
        return writer.foreachBatch(write).trigger(**trigger).start()

    def stream(self, table, schema):
        make_folder(self.spark, f"{self.root}/{table}")
        reader = self.spark.readStream.schema(schema).option("recursiveFileLookup", True)
        return reader.parquet(f"{self.root}/{table}")

    def append(self, table):
        return lambda rows, batch_id: self._fail(table, batch_id)


def supervised(spark, root, table, times, most=5):
    rows = [r for i in range(PARTS) for r in random_ticks(i, 200, i * 9000, (i + 1) * 9000)]
    frame = ticks(spark, rows)
    metrics = [Ohlc(5), RollingMean(3, source_table="OHLC_5M"), Ohlc(60)]
    land(frame.limit(0), f"{root}/ticks", "none")
    job = Supervisor(
        spark, lambda: spark.readStream.schema(TICK).parquet(f"{root}/ticks/*"), root, metrics,
        processing_time="0 seconds", hop=Fails(spark, root, table, times), most_restarts=most,
    )
    with job:
        for k in range(PARTS):
            part = frame.filter(F.col("Arrival").between(k * 200, k * 200 + 199))
            land(part, f"{root}/ticks", str(k))
            job.process_all()
        assert all(q.isActive for q in job.running.values())
        kept = dict(job.running)
    assert not any(q.isActive for q in kept.values())
    return frame, job


@pytest.mark.parametrize("table, times", [("OHLC_5M", 1), ("OHLC_5M_EMA_3", 2)])
def test_a_failed_metric_goes_on_where_it_stopped(spark, tmp_path, table, times):
    root = str(tmp_path)
    frame, job = supervised(spark, root, table, times)
    assert job.restarts == {t: times * (t == table) for t in job.starters}
    newest = frame.agg(F.max(F.unix_seconds("event_time"))).first()[0]
    for minutes in (5, 60):
        batch = Ohlc(minutes).batch(frame)
        closed = batch.filter(F.unix_seconds("window_end") <= newest - 2)
        stored = spark.read.schema(BAR).option("recursiveFileLookup", True)
        stored = stored.parquet(f"{root}/OHLC_{minutes}M")
        assert rows_of(stored, *BAR.names) == rows_of(closed, *BAR.names)
        if minutes == 5:
            want = RollingMean(3).batch(closed).withColumn("ema_value", F.round("ema_value", 8))
    table = MeanTable(spark, RollingMean(3, source_table="OHLC_5M"), root)
    means = table.read().unionByName(table.waiting())
    means = means.withColumn("ema_value", F.round("ema_value", 8))
    assert rows_of(means, *want.columns) == rows_of(want, *want.columns)


def test_a_job_that_fails_too_often_is_given_up(spark, tmp_path):
    with pytest.raises(JobFailed, match="OHLC_5M failed 3 times"):
        supervised(spark, str(tmp_path), "OHLC_5M", 99, most=2)
    assert not [q for q in spark.streams.active if q.name in ("OHLC_5M", "OHLC_60M")]


def test_what_builds_on_a_metric(spark, tmp_path):
    metrics = [
        Ohlc(5), RollingMean(3, source_table="OHLC_5M"), Ohlc(60),
        RollingMean(2, source_table="OHLC_5M_EMA_3", value="ema_value", time="snapshot_time"),
    ]
    job = Supervisor(spark, lambda: None, str(tmp_path), metrics)
    assert job.dependants("OHLC_5M") == ["OHLC_5M_EMA_3", "OHLC_5M_EMA_3_EMA_2"]
    assert job.dependants("OHLC_60M") == []
