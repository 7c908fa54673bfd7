"""Document sources: landing folders of XML or JSON texts.

A landing folder holds one file per call, named
``<source>/<area name>/<requested at, yyyyMMdd'T'HHmmss UTC>-<http status>.xml``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import clock
from ..operators.ids import dense_ids

PATH_PATTERN = r"([^/]+)/([^/]+)/(\d{8}T\d{6})-(\d{3})\.(?:xml|json)$"


def _call_columns(df: DataFrame, body: str) -> DataFrame:
    path = F.url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B")))

    def part(group: int) -> Column:
        return F.regexp_extract(path, PATH_PATTERN, group)

    requested = F.call_function("try_to_timestamp", part(3), F.lit("yyyyMMdd'T'HHmmss"))
    return df.select(
        path.alias("path"),
        part(1).alias("source_name"),
        part(2).alias("request_area_name"),
        clock.utc_instant(requested).alias("requested_at"),
        clock.utc_instant(F.col("modified").cast("timestamp_ntz")).alias("received_at"),
        part(4).try_cast("int").alias("http_status"),
        F.col("value").alias(body),
    )


def _whole_files(reader, folder: str, suffix: str) -> DataFrame:
    files = reader.format("text").option("wholetext", True).option("recursiveFileLookup", True)
    modified = F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), F.col("_metadata.file_modification_time").cast("timestamp_ntz")
    )
    return files.option("pathGlobFilter", f"*.{suffix}").load(folder).select(
        "value", F.col("_metadata.file_path").alias("path"), modified.alias("modified")
    )


def read_folder(spark: SparkSession, folder: str, suffix: str = "xml") -> DataFrame:
    """All documents of a landing folder, one row per file, not numbered yet."""
    body = "payload_xml" if suffix == "xml" else "payload"
    return _call_columns(_whole_files(spark.read, folder, suffix), body)


def stream_folder(spark: SparkSession, folder: str, suffix: str = "xml", files_per_batch: int = 10000) -> DataFrame:
    """New documents of a landing folder as a stream."""
    body = "payload_xml" if suffix == "xml" else "payload"
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    return _call_columns(_whole_files(reader, folder, suffix), body)


def number_calls(calls: DataFrame, after: int = 0) -> DataFrame:
    """Give each call the next raw ids, by its path, so a replay gives the same ids."""
    return dense_ids(calls, "path", "raw_id", after + 1).drop("path")


def read_records(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    """Records of XML files that hold many documents each."""
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)
