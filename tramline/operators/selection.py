"""Picking rows: first and last of a group, best matches, ranks, priorities, set differences.

Order is always explicit: a tie column is part of every ranking, so results
don't depend on how rows are spread out.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.operators.fuzzy import best_scores


def _cols(names: str | list[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def keep_first(df: DataFrame, keys: str | list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order: ``drop_duplicates(keep='first')`` with the order made explicit."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*_cols(keys)).orderBy(*order))).where("_rank = 1").drop("_rank")


def keep_last(df: DataFrame, keys: str | list[str], order: list[str]) -> DataFrame:
    return keep_first(df, keys, [F.desc(c) for c in order])


def keep_ties(df: DataFrame, keys: str | list[str], by: Column) -> DataFrame:
    """All rows whose value is the least of their key."""
    return df.withColumn("_rank", F.rank().over(Window.partitionBy(*_cols(keys)).orderBy(by))).where("_rank = 1").drop("_rank")


def first_and_last(df: DataFrame, keys: str | list[str], by: Column, **columns: str) -> DataFrame:
    """For each name=column, name_first and name_last in the given order."""
    return df.groupBy(*_cols(keys)).agg(*(x for name, c in columns.items() for x in (F.min_by(c, by).alias(f"{name}_first"), F.max_by(c, by).alias(f"{name}_last"))))


def primary_and_alternative(df: DataFrame, keys: str | list[str], order: list[Column], columns: list[str]) -> DataFrame:
    """First and second row of each key side by side: column and column_alt."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*_cols(keys)).orderBy(*order))).where("_rank <= 2")
    return ranked.groupBy(*_cols(keys)).agg(*(F.max(F.when(F.col("_rank") == i, F.col(c))).alias(c if i == 1 else f"{c}_alt") for c in columns for i in (1, 2)))


def best_matches(left: DataFrame, right: DataFrame, name: str, left_count: str, right_count: str, tolerance: Column, key: str | list[str], condition: Column | None = None) -> DataFrame:
    """Tolerance join: equal names, counts apart by at most ``tolerance``, all rows of the least difference for each key.

    The name is the equi-join key, so the inequality is only a residual. It stands before the keys that the condition
    adds, as sorts compare the first key first.
    """
    same = F.col(name) == F.col("_name")
    joined = left.join(right.withColumnRenamed(name, "_name"), same if condition is None else same & condition).drop("_name")
    joined = joined.withColumn("count_diff", F.abs(F.col(left_count) - F.col(right_count))).where(F.col("count_diff") <= tolerance)
    return keep_ties(joined, key, F.col("count_diff"))


def rank_groups(df: DataFrame, keys: str | list[str], group: str, diff: str) -> DataFrame:
    """For each key the group with most rows, then the least mean difference, then the least id; its size and mean."""
    each = df.groupBy(*_cols(keys), group).agg(F.count("*").alias("patterns"), F.avg(diff).alias("mean_diff"))
    return keep_first(each, keys, [F.desc("patterns"), F.round("mean_diff", 9), F.col(group)])


def keep_top_group(df: DataFrame, keys: str | list[str], group: Column, diff: str) -> DataFrame:
    """All rows of the group that ``rank_groups`` puts first for their key, found in one pass over the rows.

    Where ``group`` is null for all rows of a key, they are one group and stay.
    """
    each, of_key = Window.partitionBy(*_cols(keys), "_group"), Window.partitionBy(*_cols(keys))
    sized = df.withColumn("_group", group).withColumns({"_patterns": F.count("*").over(each), "_mean": F.round(F.avg(diff).over(each), 9)})
    ranked = sized.withColumn("_rank", F.rank().over(of_key.orderBy(F.desc("_patterns"), "_mean", "_group")))
    return ranked.where("_rank = 1").drop("_group", "_patterns", "_mean", "_rank")


def nearest_within(joined: DataFrame, key: str, distance: Column, radius: float, tie: str) -> DataFrame:
    """Of candidate pairs, the nearest within a radius for each key; the lesser tie column wins."""
    found = joined.withColumn("distance", distance).where(F.col("distance") <= radius)
    return keep_first(found, key, [F.col("distance"), F.col(tie)])


def paired_directions(df: DataFrame, keys: str | list[str], group: str, out_diff: str, in_diff: str) -> DataFrame:
    """For each key the group whose two directions together differ least."""
    return keep_first(df.withColumn("total_diff", F.abs(out_diff) + F.abs(in_diff)), keys, [F.col("total_diff"), F.col(group)])


def fuzzy_sequences(pairs: DataFrame, mine: DataFrame, theirs: DataFrame, key: str, group: str, way: str, name: str) -> DataFrame:
    """(key, group, total): of the candidate groups of each key, the one whose names are nearest in both ways.

    A way's distance is 100 less the mean, over the key's names, of the best similarity to a name of the group,
    and how many names more or fewer the group has; pairs (key, group, penalty) add their penalty. Names are
    unique in a way. A name is compared with few of a candidate group (``fuzzy``).
    """
    asked = pairs.select(key, group).distinct().join(mine.select(key, way, name), key)
    best = best_scores(asked, theirs.select(group, way, F.col(name).alias("_other")), [group, way], [key], name, "_other")
    per = best.groupBy(key, group, way).agg((100 - F.avg("best")).alias("_off"), F.count("*").alias("_n"))
    sizes = theirs.groupBy(group, way).agg(F.count("*").alias("_m"))
    total = per.join(sizes, [group, way]).groupBy(key, group).agg(F.sum(F.col("_off") + F.abs(F.col("_n") - F.col("_m"))).alias("_sum"), F.count("*").alias("_ways"))
    scored = total.where("_ways = 2").join(pairs, [key, group]).withColumn("total", F.round(F.col("_sum") + F.col("penalty"), 6))
    return keep_first(scored, key, [F.col("total"), F.col(group)]).select(key, group, "total")


def override(base: DataFrame, other: DataFrame, keys: str | list[str]) -> DataFrame:
    """base, with the rows of other in place of those whose key other has."""
    return base.join(other.select(*_cols(keys)).distinct(), _cols(keys), "left_anti").unionByName(other, allowMissingColumns=True)


def referential(df: DataFrame, parents: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Rows whose key exists in parents; parents' other columns don't matter."""
    return df.join(parents.select(F.col(parent_key or key).alias(key)), key, "left_semi")


def orphans(df: DataFrame, parents: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    return df.join(parents.select(F.col(parent_key or key).alias(key)), key, "left_anti")


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by name; columns that one side lacks are null there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def undirected(a: str | Column, b: str | Column) -> Column:
    """A key of two ends that is the same in both directions."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.struct(F.least(a, b).alias("low"), F.greatest(a, b).alias("high"))


def missing_pairs(nodes: DataFrame, group: str, node: str, edges: DataFrame, a: str, b: str) -> DataFrame:
    """Unordered pairs of nodes of a group that no edge joins in either direction: (group, low, high).

    Pairs are formed within groups whose size is bounded by their meaning (platforms of a station).
    """
    pairs = nodes.select(group, F.col(node).alias("low")).join(nodes.select(group, F.col(node).alias("high")), group).where("low < high")
    known = edges.select(undirected(a, b).alias("pair")).select("pair.low", "pair.high").distinct()
    return pairs.join(known, ["low", "high"], "left_anti")


def first_of(df: DataFrame, *lookups: tuple[DataFrame, list[str], str], into: str) -> DataFrame:
    """The first value that one of the lookups (table, keys, column) has; null if none does. Keys of a lookup are unique."""
    names = []
    for i, (table, keys, column) in enumerate(lookups):
        names.append(f"_found{i}")
        df = df.join(table.select(*keys, F.col(column).alias(names[-1])), keys, "left")
    return df.withColumn(into, F.coalesce(*names)).drop(*names)


def as_of(left: DataFrame, right: DataFrame, keys: list[str], at: str, since: str, value: str) -> DataFrame:
    """For each left row the value of the last right row with the same keys at or before it; null without one.

    Both sides are laid in one order and the last value is carried forward: one
    shuffle on the keys, no pairs. Right rows come before left rows of the same time.
    """
    left = left.withColumn("_at", F.col(at)).withColumn("_side", F.lit(1)).withColumn("_value", F.lit(None).cast(right.schema[value].dataType))
    marks = right.select(*keys, F.col(since).alias("_at"), F.lit(0).alias("_side"), F.col(value).alias("_value"))
    window = Window.partitionBy(*keys).orderBy("_at", "_side", "_value").rowsBetween(Window.unboundedPreceding, 0)
    both = left.unionByName(marks, allowMissingColumns=True).withColumn("_last", F.last("_value", ignorenulls=True).over(window))
    return both.where("_side = 1").withColumn(value, F.col("_last")).drop("_at", "_side", "_value", "_last")

