"""Expanding the JSON label of the app log into columns."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _on_page(app_log: DataFrame, day: date, page: str) -> DataFrame:
    return app_log.filter((F.col("dt") == F.lit(day)) & (F.col("page_id") == page))


def infer_label_schema(labels: DataFrame) -> str | None:
    """Schema of all labels as DDL, merged over every row by one aggregate.

    Malformed labels and those that are no object (a number, a list) are passed over; none where there are no others.
    """
    parsed = F.try_parse_json("label")
    objects = labels.where(F.startswith(F.schema_of_variant(parsed), F.lit("OBJECT<")))
    row = objects.agg(F.schema_of_variant_agg(parsed).alias("s")).first()
    if row is None or not row.s or not row.s.startswith("OBJECT<"):
        return None
    return row.s.replace("OBJECT<", "STRUCT<")


def expand_label(
    app_log: DataFrame, day: date, page: str = "1005", schema: T.StructType | str | None = None
) -> DataFrame:
    """One day and page of the log with the fields of ``label`` as columns of their own.

    Without a schema the labels are read once to find it (the only report that runs a job while it is built).
    """
    rows = _on_page(app_log, day, page)
    schema = schema or infer_label_schema(rows)
    if schema is None:
        if not rows.where("label IS NOT NULL").isEmpty():
            raise ValueError("no label of the day is an object; give a schema")
        return rows.drop("label")
    return rows.withColumn("_fields", F.from_json("label", schema)).select("*", "_fields.*").drop("_fields", "label")
