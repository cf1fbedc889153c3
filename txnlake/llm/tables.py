"""Helpers of the operators: inputs, written steps, connected components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.llm.hashing import mix
from txnlake.session import scratch_dir


#: Bits of a bit table, and the rows they travel in.
BITS, BLOCKS = 1 << 24, 64


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: it cuts the lineage and survives lost executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable from each node of the edges.

    Large-star and small-star steps alternate until the edges are stars. Each
    step takes minima with partial aggregation and joins them back, so a node
    with very many edges is split like any skewed join. Nodes are long values;
    loops (a = b) are allowed, null ends are ignored. The number of rounds grows
    with the logarithm of the longest path.
    """
    edges = written(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where("u is not null and v is not null")
        .distinct(),
        "edges",
    )
    nodes = edges.select(F.col("u").alias("node")).union(edges.select(F.col("v"))).distinct()
    state = None
    links = edges.where("u > v")
    while True:
        both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        links = written(small.where("u > v").distinct(), "stars")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return nodes.join(links.select(F.col("u").alias("node"), F.col("v").alias("m")), "node", "left").select(
        "node", F.coalesce("m", "node").alias("component")
    )


def bit_of(keys: np.ndarray) -> np.ndarray:
    """Place of each 64-bit key in a bit table."""
    return (mix(keys.view(np.uint64)) % np.uint64(BITS)).astype(np.int64)


def bit_table(keys: DataFrame) -> np.ndarray:
    """Which places of a table of BITS places the values of column key (long, not null) fall on.

    Its size is fixed, so it may be broadcast whatever the number of keys: a key that
    is there always passes, and more keys only let more others pass. BLOCKS rows
    of fixed length reach the driver.
    """
    width = BITS // BLOCKS

    def places(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bit": np.unique(bit_of(batch.column("key").to_numpy()))})

    def fold(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            bits = batch.column("bit").to_numpy()
            for block in np.unique(bits // width):
                total.setdefault(int(block), np.zeros(width, np.bool_))[bits[bits // width == block] % width] = True
        rows = [np.packbits(x).tobytes() for x in total.values()]
        yield pa.RecordBatch.from_pydict({"block": pa.array(list(total), pa.int32()), "bits": pa.array(rows, pa.binary())})

    bits = keys.select("key").mapInArrow(places, "bit long").distinct().repartition(F.floor(F.col("bit") / width))
    table = np.zeros((BLOCKS, width), np.bool_)
    for row in bits.mapInArrow(fold, "block int, bits binary").collect():
        table[row.block] |= np.unpackbits(np.frombuffer(row.bits, np.uint8)).view(np.bool_)
    return table.ravel()


def in_table(df: DataFrame, column: str, table: np.ndarray) -> DataFrame:
    """Rows whose long column may be among the keys of a bit table; a null counts as 0."""
    shared = df.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        for batch in batches:
            keys = batch.column(column).fill_null(0).to_numpy()
            yield batch.filter(pa.array(shared.value[bit_of(keys)]))

    return df.mapInArrow(run, df.schema)


def any_repeated(rows: DataFrame, column: str) -> bool:
    """Whether a value, null included, stands in several rows."""
    return not rows.groupBy(column).count().where("count > 1").isEmpty()


def with_texts(docs: DataFrame, request: DataFrame, repeated: bool) -> DataFrame:
    """The rows of request (doc_id and any columns but _key and text), each with the texts of the rows of docs with that id.

    A bit table of the ids keeps most texts out of the one shuffle. repeated tells that
    ids repeat in docs: each different text then counts once.
    """
    request = written(request.withColumn("_key", F.coalesce("doc_id", F.lit(0))), "request")
    texts = in_table(docs.select(F.col("doc_id").cast("long"), "text"), "doc_id", bit_table(request.select(F.col("_key").alias("key"))))
    if repeated:
        texts = texts.withColumn("_same", F.xxhash64("text")).dropDuplicates(["doc_id", "_same"]).drop("_same")
    texts = texts.select(F.col("doc_id").alias("_id"), F.coalesce("doc_id", F.lit(0)).alias("_key"), "text")
    return texts.join(request, "_key").where(F.col("_id").eqNullSafe(F.col("doc_id"))).drop("_id", "_key")
