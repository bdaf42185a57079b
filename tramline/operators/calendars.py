"""Service calendars and translations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.operators.selection import keep_first

DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
#: Validity of services without a calendar, and of those that never run.
ALWAYS, NEVER = (20230101, 20991231), (19700101, 19700101)


def calendar(services: DataFrame, known: DataFrame) -> DataFrame:
    """One row for each service_id: its public calendar, else every day; services of ``NEVER`` never run.

    services has service_id and original_service_id. Of several originals the least counts.
    """
    own = keep_first(services.select("service_id", "original_service_id").distinct(), "service_id", [F.col("original_service_id")])
    joined = own.join(known.withColumnRenamed("service_id", "original_service_id"), "original_service_id", "left")
    never = F.coalesce(F.col("original_service_id") == "NEVER", F.lit(False))
    day = [F.when(never, 0).otherwise(F.coalesce(F.col(d).cast("int"), F.lit(1))).alias(d) for d in DAYS]
    date = [F.when(never, NEVER[i]).otherwise(F.coalesce(F.col(c).cast("int"), F.lit(ALWAYS[i]))).alias(c) for i, c in enumerate(("start_date", "end_date"))]
    return joined.select("service_id", *day, *date)


def calendar_dates(services: DataFrame, known: DataFrame) -> DataFrame:
    """Exceptions of services that have a public calendar, one for each service and date.

    Of several for one date the least counts. A calendar's own dates are made one first, so what is joined grows with
    services times dates and not with how often a date is published.
    """
    least = F.min("exception_type").alias("exception_type")
    dates = known.groupBy(F.col("service_id").alias("original_service_id"), "date").agg(least)
    own = services.select("service_id", "original_service_id").distinct().join(dates, "original_service_id")
    return own.groupBy("service_id", "date").agg(least)


def translations(df: DataFrame, table: str, field: str, record: str, **languages: str | Column) -> DataFrame:
    """(table_name, field_name, language, record_id, translation) of columns by language; blank ones are left out."""
    pairs = F.array(*(F.struct(F.lit(k.replace("_", "-")).alias("language"), (F.col(c) if isinstance(c, str) else c).alias("translation")) for k, c in languages.items()))
    long = df.select(F.col(record).cast("string").alias("record_id"), F.explode(pairs).alias("t"))
    return long.where("t.translation IS NOT NULL AND trim(t.translation) <> ''").select(F.lit(table).alias("table_name"), F.lit(field).alias("field_name"), "t.language", "record_id", "t.translation")
