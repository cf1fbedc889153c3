"""Mixing sources to target weights by Poisson replication.

Each source gets a mean repetition rate, so that its expected number of rows is
its share of the target. Each document draws its number of copies by inverting
the Poisson distribution at a uniform number hashed from the seed and its id; a
recomputed task draws the same. Copies are then dealt over all partitions by a
hash and sorted by it inside, which is a global shuffle without sampling.

A mean above PART is the sum of several draws of smaller mean, which is
the same distribution and never underflows. Documents without a source form a source
of their own; rows that repeat an id draw alike; a null id draws like the word null.
Null and empty texts are copied like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm.tables import written

POWER, SEED, PART = 0.5, 17, 256
#: Sources up to which their table is broadcast; beyond, it is joined by shuffling.
BROADCAST_SOURCES = 20_000


def target_rates(docs: DataFrame, weights: DataFrame | None = None, power: float = POWER, total: int | None = None) -> DataFrame:
    """(source, rate): mean copies of each document of a source.

    weights (source, weight) are the target shares up to a factor; without them a
    source weighs its size to `power`. total is the expected number of rows, or
    as many as there are. A source without a positive weight is left out of the mix.
    """
    sizes = docs.groupBy("source").agg(F.count("*").alias("n"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.pow("n", F.lit(power)))
    else:
        weights = weights.groupBy(F.col("source").alias("_s")).agg(F.sum("weight").alias("weight"))
        sizes = sizes.join(weights, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
        sizes = sizes.withColumn("weight", F.when(F.col("weight") > 0, F.col("weight").cast("double")).otherwise(0.0))
    sizes = written(sizes, "sizes")
    all_rows, all_weight = sizes.agg(F.sum("n"), F.sum("weight")).first()
    want = total if total is not None else all_rows or 0
    scale = F.lit(float(want)) * F.col("weight") / F.lit(float(all_weight or 1)) / F.col("n")
    return sizes.select("source", F.when(F.col("weight") > 0, scale).otherwise(0.0).alias("rate"))


def uniform(*parts) -> F.Column:
    """A number between 0 and 1 from 48 bits of a hash."""
    text = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]).cast("binary"))
    return (F.conv(F.substring(text, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def cumulated(rate: F.Column) -> F.Column:
    """Distribution function of the Poisson law at 0, 1, ... until it is 1 to double precision."""
    top = (rate + 12 * F.sqrt(rate) + 40).cast("int")
    return F.aggregate(
        F.sequence(F.lit(1), top),
        F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("out")),
        lambda acc, k: F.struct(
            (acc["p"] * rate / k).alias("p"), F.concat(acc["out"], F.array(F.element_at(acc["out"], -1) + acc["p"] * rate / k)).alias("out")
        ),
        lambda acc: acc["out"],
    )


def replicated(docs: DataFrame, rates: DataFrame, seed: int = SEED) -> DataFrame:
    """docs with copies (the number drawn) and copy (1 to copies), in a global random order.

    Columns copies, copy and shuffle_key of docs are replaced.
    """
    docs = docs.drop("copies", "copy", "shuffle_key")
    rates = written(
        rates.withColumn("_parts", F.ceil(F.col("rate") / PART).cast("int")).select(
            F.col("source").alias("_source"), "_parts", cumulated(F.col("rate") / F.greatest("_parts", F.lit(1))).alias("_cdf")
        ),
        "rates",
    )
    if rates.count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    joined = docs.join(rates, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "copies",
        F.aggregate(
            F.when(F.col("_parts") > 0, F.sequence(F.lit(1), "_parts")).otherwise(F.array().cast("array<int>")),
            F.lit(0),
            lambda acc, part: acc + _draws(uniform(F.lit(seed), F.col("doc_id"), part)),
        ),
    )
    copied = joined.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("_source", "_parts", "_cdf")
    key = F.md5(F.concat_ws(":", F.lit(f"order{seed}"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "copy").cast("binary"))
    return copied.withColumn("shuffle_key", key).repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def _draws(u: F.Column) -> F.Column:
    return F.size(F.filter("_cdf", lambda c: c < u))
