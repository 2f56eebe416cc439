"""Kafka in and out. Needs Spark's own Kafka connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_LOGIN_MODULE = "org.apache.kafka.common.security.plain.PlainLoginModule"


def auth_options(username: str = "", password: str = "", login_module: str = _LOGIN_MODULE) -> dict:
    """SASL_SSL/PLAIN client options, or none without a user name.

    The password ends up in an option value; keep ``jaas`` in
    ``spark.sql.redaction.options.regex``. Platforms that relocate the Kafka client
    need their own ``login_module``.
    """
    if not username:
        return {}
    for part in (username, password):
        if '"' in part or "\\" in part:
            raise ValueError("quotes and backslashes cannot be written into a JAAS line")
    return {
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": (
            f'{login_module} required username="{username}" password="{password}";'
        ),
    }


def source_options(
    topic: str,
    bootstrap: str,
    auth: dict | None = None,
    max_offsets: int | None = None,
    min_partitions: int | None = None,
) -> dict:
    """Reader options: from the earliest offset, failing loudly if offsets are gone.

    ``max_offsets`` bounds each micro-batch of a drain; ``min_partitions`` splits
    topic partitions into more read tasks than the topic has partitions.
    """
    if not bootstrap:
        raise ValueError("bootstrap servers are required")
    options = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
        **(auth or {}),
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_source(spark: SparkSession, topic: str, bootstrap: str, **kwargs) -> DataFrame:
    """Streaming rows of one topic; options as in :func:`source_options`."""
    options = source_options(topic, bootstrap, **kwargs)
    return spark.readStream.format("kafka").options(**options).load()


def write_kafka(records: DataFrame, bootstrap: str, auth: dict | None = None) -> None:
    """Send ``(topic, key, value)`` rows; each row names its own topic."""
    options = {"kafka.bootstrap.servers": bootstrap, **(auth or {})}
    records.select("topic", "key", "value").write.format("kafka").options(**options).save()
