"""Rolling means on a stream: a native window per micro-batch over stored tails.

A micro-batch is read once, into a part of its own that the rest goes by. Rows wait until
the watermark has passed their time, then get their mean in time order,
whatever micro-batch they came in. The last rows of each key, and the rows that wait, are
a small written table per batch. A batch that runs again overwrites its own parts, so it
adds nothing twice. Rows behind the watermark are counted and left out.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickbars.operators.latest import latest_n
from tickbars.operators.lookback import with_lookback
from tickbars.operators.rolling import RollingMean
from tickbars.session import exists, file_system, read_text, remove, write_text


class MeanTable:
    """The table of one streamed mean under ``root``, with its tails beside it."""

    def __init__(
        self,
        spark: SparkSession,
        metric: RollingMean,
        root: str,
        delay_seconds: int = 5,
        also: Callable[[DataFrame, int], None] | None = None,
    ):
        """``also`` takes the emitted rows of every batch as well, with the batch's id."""
        self.also = also
        self.spark = spark
        self.metric = metric
        self.path = f"{root}/{metric.target_table}"
        self.state = f"{root}/_tails/{metric.target_table}"
        self.delay = delay_seconds * 1_000_000
        keys = [T.StructField("ticker", T.StringType()), T.StructField("time", T.TimestampType())]
        ties = [T.StructField(name, T.LongType()) for name in metric.ties]
        self._row = T.StructType([*keys, *ties, T.StructField("value", T.DoubleType())])
        self._stored = T.StructType(
            [
                *self._row.fields,
                T.StructField("ema_value", T.DoubleType()),
                # "tail" rows only precede others, "done" have their mean, "wait" have none.
                T.StructField("stage", T.StringType()),
            ]
        )
        self._order = ["time", *metric.ties]

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Emit what the watermark passes with this batch; the sink of a stream."""
        spark = batch.sparkSession
        before, late = self._meta(spark, batch_id - 1)
        folder = f"{self.state}/{batch_id}"
        self._shaped(batch).write.mode("overwrite").parquet(f"{folder}/in")
        rows = spark.read.schema(self._row).parquet(f"{folder}/in")
        micros = F.unix_micros("time")
        behind = F.lit(False) if before is None else micros <= before
        # Two values: the newest time and the number of late rows.
        newest, dropped = rows.agg(
            F.max(micros), F.count_if(behind & F.col("time").isNotNull())
        ).first()
        reached = [] if newest is None else [newest - self.delay]
        watermark = max(reached if before is None else [*reached, before], default=None)

        carried = self._read(spark, batch_id - 1)
        waiting = carried.where("stage = 'wait'").select(self._row.names)
        waiting = waiting.unionByName(rows.where(~behind & F.col("time").isNotNull()))
        passed = F.lit(False) if watermark is None else micros <= watermark
        stored = self._with_means(self._tails(carried), waiting.where(passed)).unionByName(
            waiting.where(~passed).withColumn("stage", F.lit("wait")), allowMissingColumns=True
        )
        stored.select(self._stored.names).write.mode("overwrite").parquet(f"{folder}/rows")
        self._emitted(self._read(spark, batch_id)).write.mode("overwrite").parquet(
            f"{self.path}/part={batch_id:09d}"
        )
        if self.also is not None:
            self.also(self._emitted(self._read(spark, batch_id)), batch_id)
        remove(spark, f"{folder}/in")
        write_text(spark, f"{folder}/meta", json.dumps([watermark, late + dropped]))
        # The batch before may still have to run again; the one before it may not.
        remove(spark, f"{self.state}/{batch_id - 2}")

    def read(self) -> DataFrame:
        """What the stream has emitted so far."""
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.metric.schema)
        schema = self.metric.schema
        return self.spark.read.schema(schema).parquet(self.path).select(schema.names)

    def waiting(self) -> DataFrame:
        """Means of the rows a finished stream still holds behind its watermark.

        They are a batch query; written to the stream's table they would come twice,
        once the stream goes on.
        """
        last = self._last()
        carried = self._read(self.spark, last)
        rows = carried.where("stage = 'wait'").select(self._row.names)
        return self._emitted(self._with_means(self._tails(carried), rows))

    def late(self) -> int:
        """Rows that came behind the watermark, over all batches."""
        return self._meta(self.spark, self._last())[1]

    def _with_means(self, tails: DataFrame, rows: DataFrame) -> DataFrame:
        both = tails.withColumn("stage", F.lit("tail")).unionByName(
            rows.withColumn("stage", F.lit("done"))
        )
        metric = self.metric
        mean = {"ema_value": F.avg("value")}
        return with_lookback(both, "ticker", self._order, metric.periods - 1, mean, metric.split)

    def _tails(self, carried: DataFrame) -> DataFrame:
        """The newest ``periods - 1`` rows of each key that have their mean."""
        if self.metric.periods == 1:
            return self.spark.createDataFrame([], self._row)
        rows = carried.where("stage <> 'wait'").select(self._row.names)
        return latest_n(rows, ["ticker"], self._order, self.metric.periods - 1)

    def _shaped(self, source: DataFrame) -> DataFrame:
        metric = self.metric
        return source.select(
            F.col(metric.key).alias("ticker"),
            F.col(metric.time).cast("timestamp").alias("time"),
            *[F.col(c).cast("bigint").alias(c) for c in metric.ties],
            F.col(metric.value).cast("double").alias("value"),
        )

    def _emitted(self, rows: DataFrame) -> DataFrame:
        return (
            rows.where("stage = 'done'")
            .withColumnRenamed("time", "snapshot_time")
            .select(self.metric.schema.names)
        )

    def _read(self, spark: SparkSession, batch_id: int) -> DataFrame:
        path = f"{self.state}/{batch_id}/rows"
        if batch_id < 0 or not exists(spark, path):
            return spark.createDataFrame([], self._stored)
        return spark.read.schema(self._stored).parquet(path)

    def _meta(self, spark: SparkSession, batch_id: int) -> tuple[int | None, int]:
        path = f"{self.state}/{batch_id}/meta"
        if batch_id < 0 or not exists(spark, path):
            return None, 0
        return tuple(json.loads(read_text(spark, path)))

    def _last(self) -> int:
        """The newest batch that was stored to its end."""
        fs, folder = file_system(self.spark, self.state)
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        whole = [n for n in names if exists(self.spark, f"{self.state}/{n}/meta")]
        return max(map(int, whole), default=-1)


def start_mean(
    table: MeanTable, rows: DataFrame, root: str, processing_time: str | None = None
) -> StreamingQuery:
    """Stream ``rows`` into ``table``; without ``processing_time`` to the end of the input."""
    name = table.metric.target_table
    writer = (
        rows.writeStream.queryName(name)
        .option("checkpointLocation", f"{root}/_checkpoints/{name}")
        .foreachBatch(table.process)
    )
    if processing_time is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=processing_time).start()
