"""Publishing page URLs: one record per URL, value ``{"url":"..."}``, no
key. The Kafka connector is a deployment jar; when it is not on the class
path the same values can be written as JSON-lines files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Producer defaults.
KAFKA_OPTIONS = {
    "kafka.acks": "all",
    "kafka.compression.type": "lz4",
    "kafka.linger.ms": "50",
    "kafka.batch.size": "131072",
    "kafka.client.id": "crawlmeta-sitemap-url-loader",
}


def url_values(df: DataFrame, url_col: str = "page_url") -> DataFrame:
    return df.select(F.to_json(F.struct(F.col(url_col).alias("url"))).alias("value"))


def write_kafka(values: DataFrame, bootstrap: str, topic: str, **options: str) -> None:
    w = values.write.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("topic", topic)
    for k, v in {**KAFKA_OPTIONS, **options}.items():
        w = w.option(k, v)
    w.save()


def write_json_lines(values: DataFrame, path: str) -> None:
    values.write.mode("overwrite").text(path)
