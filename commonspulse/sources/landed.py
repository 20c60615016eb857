"""Landed API objects: JSON lines in an envelope."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commonspulse import schemas


def read_api_json(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """Envelope columns plus ``o``, the typed object; ``object`` keeps the JSON text."""
    return typed_objects(spark.read.schema(schemas.LANDED).json(path), kind)


def typed_objects(landed: DataFrame, kind: str) -> DataFrame:
    return landed.withColumn("o", F.from_json("object", schemas.API_OBJECTS[kind]))
