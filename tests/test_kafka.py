"""The Kafka builders need packages that may be absent; then they must say so."""

import pytest
from pyspark.errors import AnalysisException

from tickbars.sources import kafka


@pytest.mark.parametrize(
    "build",
    [
        lambda spark: kafka.event_stream(spark, "localhost:9092", max_offsets_per_trigger=10),
        lambda spark: kafka.topic_snapshot(spark, "localhost:9092", "OHLC_5M"),
        lambda spark: kafka.metric_message_stream(spark, "localhost:9092"),
    ],
)
def test_readers_name_the_missing_package(spark, build):
    try:
        spark.readStream.format("kafka").option("subscribe", "t").option(
            "kafka.bootstrap.servers", "localhost:9092"
        ).load()
    except AnalysisException as missing:
        if "Kafka" not in str(missing):
            raise
    else:
        pytest.skip("the Kafka package is on this session")
    with pytest.raises(AnalysisException, match="Kafka"):
        build(spark)


def test_default_topics():
    assert kafka.METRIC_TOPICS == ["OHLC_5M", "OHLC_5M_EMA_9", "OHLC_5M_EMA_12"]
