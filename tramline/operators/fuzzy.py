"""The most similar name, by edit distance, found through an index of character grams instead of all pairs.

Similarity is 100 times one less the edit distance over the longer length. An edit changes at most Q grams, so a name
that is d edits away holds one of any d Q + 1 different grams of the asked name. Equal names are found by a join. Of the
others, names that share rare grams give a similarity that has to be beaten; it bounds the edits that a better name may
be away, and with them the rarest grams that are looked up and the lengths that count. Only where so many edits are
allowed that the grams say nothing are all names of the group compared that have a fitting length. So the result is that
of all pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.text import similarity

#: Characters of a gram, and the rare grams by which a first similar name is looked for.
Q, FIRST = 2, 3


def grams(name: Column) -> Column:
    """The different grams of a name; none of a name that is shorter."""
    return F.when(F.length(name) >= Q, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(name) - Q + 1), lambda i: F.substring(name, i, F.lit(Q))))).otherwise(F.array().cast("array<string>"))


def rarest_first(names: DataFrame, name: str, often: DataFrame) -> DataFrame:
    """(name, _grams) of different names: their grams, those first that fewest names of the index hold."""
    each = names.select(name).distinct().select(name, F.explode_outer(grams(F.col(name))).alias("_gram")).join(often, "_gram", "left")
    return each.groupBy(name).agg(F.transform(F.array_sort(F.collect_list(F.when(F.col("_gram").isNotNull(), F.struct(F.coalesce("_often", F.lit(0)).alias("o"), F.col("_gram").alias("g"))))), lambda x: x["g"]).alias("_grams"))


def compared_pairs(asked: DataFrame, offered: DataFrame, within: list[str], keys: list[str], name: str, other: str) -> tuple[DataFrame, DataFrame]:
    """(equal: keys, within and name of names that the group has), (compared: keys, within, name, other, score) of all others that are compared.

    asked has keys, within and name, offered has within and other, each row once; within is what both must agree in.
    """
    row = [*keys, *within, name]
    asked, offered = asked.select(*row).where(F.col(name).isNotNull()), offered.select(*within, other).where(F.col(other).isNotNull())
    equal = asked.join(offered.withColumnRenamed(other, name), [*within, name], "left_semi").select(*row)
    index = offered.select(*within, other, F.explode(grams(F.col(other))).alias("_gram"))
    often = offered.select(other).distinct().select(F.explode(grams(F.col(other))).alias("_gram")).groupBy("_gram").agg(F.count("*").alias("_often"))
    rest = asked.join(equal, row, "left_anti")
    rest = rest.join(rarest_first(rest, name, often), name)
    met = rest.select(*row, F.explode(F.slice("_grams", 1, FIRST)).alias("_gram")).join(index, [*within, "_gram"]).groupBy(*row, other).agg(F.count("*").alias("_hits"))
    first = met.groupBy(*row).agg(F.max_by(other, F.struct("_hits", -F.abs(F.length(name) - F.length(other)), F.col(other))).alias(other))
    first = first.withColumn("score", similarity(F.col(name), F.col(other)))
    least = F.coalesce("score", F.lit(0.0)) / 100
    length = F.length(name)
    beat = rest.join(first.select(*row, "score"), row, "left").withColumns({"_least": least, "_edits": F.when(least > 0, F.ceil((1 - least) * length / least - 1e-9) - 1)})
    enough = F.coalesce(F.col("_edits") * Q + 1 <= F.size("_grams"), F.lit(False))
    fits = (F.length(other) > F.col("_least") * F.length(name) - 1e-9) & (F.length(other) * F.col("_least") < F.length(name) + 1e-9)
    looked_up = beat.where(enough).select(*row, "_least", F.explode(F.slice("_grams", F.lit(1), F.greatest(F.lit(0), F.col("_edits") * Q + 1).cast("int"))).alias("_gram"))
    looked_up = looked_up.where("_least < 1").join(index, [*within, "_gram"]).where(fits).select(*row, other).distinct()
    whole = beat.where(~enough).join(offered, within).where(fits).select(*row, other)
    more = looked_up.unionByName(whole).withColumn("score", similarity(F.col(name), F.col(other)))
    return equal, first.unionByName(more)


def best_scores(asked: DataFrame, offered: DataFrame, within: list[str], keys: list[str], name: str, other: str) -> DataFrame:
    """(keys, within, name, best): the highest similarity of each asked name to a name offered within its group; none where nothing is offered."""
    equal, compared = compared_pairs(asked, offered, within, keys, name, other)
    row = [*keys, *within, name]
    return equal.withColumn("best", F.lit(100.0)).unionByName(compared.groupBy(*row).agg(F.max("score").alias("best")))
