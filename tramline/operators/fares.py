"""Fare stages, special ranges, and which fare a journey pays."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramline.operators.selection import as_of


def price_ranges(fares: DataFrame, keys: list[str], *also: str) -> DataFrame:
    """(keys, start_seq, price, min_end, max_end): the alightings of each price, where a boarding stop has several; with what the last one has ``also``.

    fares has keys, start_seq, end_seq, price.
    """
    each = fares.groupBy(*keys, "start_seq", "price").agg(F.min("end_seq").alias("min_end"), F.max("end_seq").alias("max_end"), *(F.max_by(c, "end_seq").alias(c) for c in also))
    return each.withColumn("_prices", F.count("*").over(Window.partitionBy(*keys, "start_seq"))).where("_prices > 1").drop("_prices")


def special_ranges(fares: DataFrame, last: DataFrame) -> DataFrame:
    """(trip_id, start_seq, price, min_end, max_end): where a boarding stop has several prices, those that end before the trip does.

    fares has trip_id, start_seq, end_seq, price; last has trip_id, last_seq.
    """
    return price_ranges(fares, ["trip_id"]).join(last, "trip_id").where("max_end < last_seq").drop("last_seq")


def least_holding(asked: DataFrame, rules: DataFrame, keys: list[str], low: str, high: str, start: str, end: str, value: str) -> DataFrame:
    """asked with ``value``: the least of the rules with the same keys whose start..end holds low..high; null without one.

    No pair of a question and a rule is made. The ends that reach ``high`` fall into cells of the powers of two, at most
    one of each size, and a rule stands in one cell of each size or none, so that a question and a rule that reaches it
    meet in exactly one. Inside a cell the rules that start in time are those before the question, and the answer is a
    running least. Questions and rules that are equal are one, so a key has no more of them than it has pairs of whole
    numbers. Nulls hold nothing and are held by nothing; equal rules and ties give their one value.
    """
    c = F.col
    span = c("_most") - c("_least") + 1
    sizes = F.sequence(F.lit(0), F.length(F.bin(span)) - 1)
    ends = rules.where(c(start).isNotNull() & c(value).isNotNull()).groupBy(*keys, c(start).cast("bigint").alias("_at"), c(end).cast("bigint").alias("_end")).agg(F.min(value).alias("_value")).where("_end IS NOT NULL")
    bounds = ends.groupBy(*keys).agg(F.min("_end").alias("_least"), F.max("_end").alias("_most"))
    mine = ends.join(bounds, keys).withColumn("_to", c("_end") - c("_least") + 1)
    mine = mine.withColumn("_size", F.explode(F.filter(sizes, lambda n: F.getbit(c("_to"), n) == 1)))
    mine = mine.select(*keys, "_at", "_size", F.expr("shiftright(_to, _size)").alias("_cell"), F.lit(0).alias("_side"), "_value")
    questions = asked.select(*keys, low, high).distinct()
    theirs = questions.join(bounds, keys).where(c(high) <= c("_most")).withColumn("_to", F.greatest(c(high).cast("bigint"), c("_least")) - c("_least"))
    theirs = theirs.withColumn("_size", F.explode(F.filter(sizes, lambda n: F.getbit(c("_to"), n) == 0)))
    theirs = theirs.select(*keys, low, high, c(low).cast("bigint").alias("_at"), "_size", F.expr("shiftright(_to, _size) + 1").alias("_cell"), F.lit(1).alias("_side")).where("_at IS NOT NULL")
    window = Window.partitionBy(*keys, "_size", "_cell").orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    met = theirs.unionByName(mine, allowMissingColumns=True).withColumn("_so_far", F.min("_value").over(window)).where("_side = 1")
    found = met.groupBy(*keys, low, high).agg(F.min("_so_far").alias(value))
    return asked.join(found, [*keys, low, high], "left")


def resolve(journeys: DataFrame, stages: DataFrame, trip_rules: DataFrame, agency_rules: DataFrame) -> DataFrame:
    """journeys with price and rule: an agency rule for the exact pair of stops, else a trip rule whose range holds the
    journey, else the last stage at or before boarding.

    journeys has trip_id, board_seq, alight_seq, board_stop, alight_stop. Of several trip rules the cheapest counts.
    Each question (trip, boarding, alighting) is answered once, however many journeys ask it, so a trip that most
    journeys use is as much work as any. A journey without a trip or a boarding has an agency's price or none.
    """
    asked = journeys.select("trip_id", "board_seq", "alight_seq").where("trip_id IS NOT NULL AND board_seq IS NOT NULL").distinct()
    staged = as_of(asked, stages.select("trip_id", F.col("seq").alias("_seq"), F.col("price").alias("_stage")), ["trip_id"], "board_seq", "_seq", "_stage")
    ranged = least_holding(staged, trip_rules.withColumnRenamed("price", "_trip"), ["trip_id"], "board_seq", "alight_seq", "from_seq", "to_seq", "_trip")
    paired = agency_rules.groupBy("board_stop", "alight_stop").agg(F.min("price").alias("_agency"))
    asks = ("trip_id", "board_seq", "alight_seq")
    answers = ranged.select(*(F.col(n).alias(f"_{n}") for n in asks), "_stage", "_trip")
    same = [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in asks]
    out = journeys.join(answers, same, "left").drop(*(f"_{n}" for n in asks)).join(paired, ["board_stop", "alight_stop"], "left")
    rule = F.when(F.col("_agency").isNotNull(), "agency").when(F.col("_trip").isNotNull(), "trip").when(F.col("_stage").isNotNull(), "stage")
    return out.withColumn("price", F.coalesce("_agency", "_trip", "_stage")).withColumn("rule", rule).drop("_agency", "_trip", "_stage")


def agency_rules(fares: DataFrame, stations: DataFrame | None, prefix: str, stop_prefix: str = "", currency: str = "HKD") -> DataFrame:
    """Point-to-point rules of (from_id, to_id, fare); ids become stops by ``stations`` or a prefix; unreadable fares are dropped."""
    own = fares.where("from_id <> to_id").withColumn("price", F.col("fare").try_cast("double")).where("price IS NOT NULL")
    if stations is None:
        stop = lambda c: F.concat(F.lit(stop_prefix), F.col(c).cast("string"))
        own = own.withColumns({"onboarding_stop_id": stop("from_id"), "offboarding_stop_id": stop("to_id")})
    else:
        for side, name in (("from_id", "onboarding_stop_id"), ("to_id", "offboarding_stop_id")):
            own = own.join(stations.select(F.col("station_id").alias(side), F.col("stop_id").alias(name)), side)
    return own.select(F.concat_ws("-", F.lit(prefix), F.col("from_id").cast("string"), F.col("to_id").cast("string")).alias("special_fare_id"), F.lit("agency").alias("rule_type"), F.lit("").alias("trip_id"), "onboarding_stop_id", "offboarding_stop_id", "price", F.lit(currency).alias("currency"))
