"""Exact Jaccard join of documents as a metric-space join, and its components.

Documents are sets of word shingles; 1 - Jaccard is a metric. The join runs by
pivots, regions and triangle-inequality windows, in two levels, because a
document that is the pivot is at distance 1 from nearly every other text, so
document pivots alone would prune nothing:

1. The first pivots are all single shingles. A set lies nearest to the pivots
   that it contains, and of these its own region is that of the first in one
   global order. A set within distance t of x lacks at most a known number of
   x's shingles, so its region is one of x's first n - ceil((1 - t) n) + 1
   shingles: x is copied to those regions and no others. The order puts rare
   shingles first; passages that many documents share then hardly ever become
   regions. It comes from a table of hashed counts of fixed size; any order gives
   the same result.
2. Inside each region a member document becomes the pivot. Members measure their
   true distance to it. Those within t are linked to it and form one part, which
   is not compared within itself again. What is left (members in different
   parts) recurses with a new pivot, and finally pairs are compared whose
   distances to the pivots satisfy the triangle inequality |d(x,p) - d(y,p)| <= t.

Identical sets are one node throughout, so groups of copies cost one row each.
Distances are exact: set sizes come from 64-bit shingle hashes of the whole text.
No step gathers a region, a part or a group of copies in one task: pivots are
found with partial aggregation, regions are joined on their key (a skewed join
that Spark can split), and measured pairs are dealt by pivot and a salt.

Null, blank and empty texts have an empty set and link with nothing. Rows with
the same id are separate rows. A null id takes part like any other, and the
component is named after the smallest id that is not null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnlake.llm.hashing import SHINGLE_WORDS, mix, sets
from txnlake.llm.tables import any_repeated, components, with_texts, written

#: Two sets link when SCALE * intersection >= percent * union.
SCALE, PERCENT = 100, 80
ROUNDS = 1
#: Hashed counts behind the global order: their number, and the rows they travel in.
COUNTS, BLOCKS = 1 << 20, 64
#: Rows of a region up to which it may meet in one task.
HOT_REGION = 100_000
#: Rows of an Arrow batch that a task gives back.
ROWS_OUT = 200_000
#: Measured pairs that one copy of a pivot's set serves.
PAIRS_PER_COPY = 64


def node_of(values: np.ndarray) -> np.int64:
    """Name of a set; never used for an empty one."""
    return mix(np.array([mix(values).sum() + np.uint64(len(values))], np.uint64)).view(np.int64)[0]


def slot_of(values: np.ndarray) -> np.ndarray:
    """Place of each shingle in the table of hashed counts."""
    return (values % np.uint64(COUNTS)).astype(np.int64)


def counted(held: list[np.ndarray]) -> np.ndarray:
    return np.bincount(slot_of(np.concatenate(held)), minlength=COUNTS) if held else np.zeros(COUNTS, np.int64)


def with_nodes(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, same, n_shingles, node) of every row, and rows of hashed counts in block, counts. same is a hash of the text."""

    def run(batches):
        seen = np.zeros(COUNTS, np.int64)
        for batch in batches:
            n, node = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            held, waiting = [], 0
            for i, values in sets(batch.column("text"), size):
                if len(values):
                    n[i], node[i] = len(values), node_of(values)
                    held.append(values)
                    waiting += len(values)
                if waiting > COUNTS // 2:
                    seen += counted(held)
                    held, waiting = [], 0
            seen += counted(held)
            none = pa.nulls(batch.num_rows)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "same": batch.column("same"), "n_shingles": n, "node": pa.array(node, mask=n == 0),
                 "block": none.cast(pa.int32()), "counts": none.cast(pa.binary())}
            )
        rows = seen.astype(np.int32).reshape(BLOCKS, -1)
        none = pa.nulls(BLOCKS).cast(pa.int64())
        yield pa.RecordBatch.from_pydict(
            {"doc_id": none, "same": none, "n_shingles": none, "node": none, "block": pa.array(range(BLOCKS), pa.int32()),
             "counts": pa.array([r.tobytes() for r in rows], pa.binary())}
        )

    schema = "doc_id long, same long, n_shingles long, node long, block int, counts binary"
    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("same")).mapInArrow(run, schema)


def hashed_counts(counts: DataFrame) -> np.ndarray:
    """All hashed counts added up: BLOCKS rows of fixed length reach the driver."""

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, row in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                total[block] = total.get(block, 0) + np.frombuffer(row, np.int32).astype(np.int64)
        yield pa.RecordBatch.from_pydict(
            {"block": pa.array(list(total), pa.int32()), "counts": pa.array([x.tobytes() for x in total.values()], pa.binary())}
        )

    out = np.zeros((BLOCKS, COUNTS // BLOCKS), np.int64)
    for row in counts.select("block", "counts").repartition("block").mapInArrow(run, "block int, counts binary").collect():
        out[row.block] += np.frombuffer(row["counts"], np.int64)
    return out.ravel()


def needed(n: F.Column, m: F.Column, percent: int) -> F.Column:
    """Least intersection of two linked sets of these sizes."""
    return F.ceil((n + m) * percent / (SCALE + percent))


def _may_link(n: F.Column, at_n: F.Column, m: F.Column, at_m: F.Column, percent: int) -> F.Column:
    """Whether sets of these sizes can link if the shingles at these places are the first that they share.

    A linked pair passes in the region of the first shingle that it shares.
    """
    return (F.least(n, m) * SCALE >= F.greatest(n, m) * percent) & (F.least(n - at_n, m - at_m) >= needed(n, m, percent))


def members(docs: DataFrame, counts: np.ndarray, size: int, percent: int) -> DataFrame:
    """(pivot, node, at, hot): the regions that each set is in; at is its size and the pivot's place in it.

    A region is hot if its hashed count, never less than its members, is over HOT_REGION.
    """
    shared = docs.sparkSession.sparkContext.broadcast(((np.log2(counts + 1) * 64).astype(np.uint16), counts > HOT_REGION))

    def run(batches):
        done: set[int] = set()
        order, hot = shared.value
        for batch in batches:
            out, held = [], 0
            for _, values in sets(batch.column("text"), size):
                n = len(values)
                if n == 0 or (node := int(node_of(values))) in done:
                    continue
                done.add(node)
                slots = slot_of(values)
                keys = (order[slots].astype(np.uint64) << np.uint64(52)) | (values >> np.uint64(12))
                first = np.argsort(keys)[: n + (-n * percent // SCALE) + 1]
                out.append((keys[first], node, n, hot[slots[first]]))
                held += len(first)
                if held > ROWS_OUT:
                    yield entries(out)
                    out, held = [], 0
            if out:
                yield entries(out)

    def entries(out):
        lengths = [len(x[0]) for x in out]
        return pa.RecordBatch.from_pydict(
            {"pivot": np.concatenate([x[0] for x in out]).view(np.int64),
             "node": np.repeat(np.array([x[1] for x in out], np.int64), lengths),
             "at": np.repeat(np.array([x[2] for x in out], np.int64), lengths) << 32 | np.concatenate([np.arange(x) for x in lengths]),
             "hot": np.concatenate([x[3] for x in out])}
        )

    return docs.select("text").mapInArrow(run, "pivot long, node long, at long, hot boolean")


def pair_request(pairs: DataFrame, ids: DataFrame) -> DataFrame:
    """Which texts each task needs: one row per pair with a's id, and b's id once for PAIRS_PER_COPY pairs, with a null.

    The pairs of one b are spread over as many tasks as their number asks for. Columns of pairs
    besides a and b go with a.
    """
    copies = written(pairs.groupBy("b").agg(F.ceil(F.count("*") / PAIRS_PER_COPY).cast("int").alias("copies")), "copies")
    left = pairs.join(copies, "b").withColumn("copy", F.pmod(F.xxhash64("a"), "copies").cast("int")).withColumn("node", F.col("a")).drop("copies")
    right = copies.select(F.col("b").alias("node"), "b", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
    return left.unionByName(right, allowMissingColumns=True).join(ids.select("node", "doc_id"), "node")


def measured(docs: DataFrame, pairs: DataFrame, ids: DataFrame, repeated: bool, size: int = SHINGLE_WORDS) -> DataFrame:
    """(a, b, both, n, m) of pairs of nodes: the size of the intersection and of both sets.

    Each task streams the texts of its a past b's set. Where rows with one id
    differ, only the text with the right set counts.
    """
    dealt = with_texts(docs, pair_request(pairs, ids), repeated).select("node", "a", "b", "copy", "text")
    dealt = dealt.repartition("b", "copy").sortWithinPartitions("b", "copy", F.col("a").asc_nulls_first())

    def run(batches):
        mine = np.zeros(0, np.uint64)
        for batch in batches:
            node, a, b = (batch.column(c).to_pylist() for c in ("node", "a", "b"))
            out = []
            for i, values in sets(batch.column("text"), size):
                if not len(values) or node_of(values) != node[i]:
                    continue
                if a[i] is None:
                    mine = values
                    continue
                at = np.minimum(np.searchsorted(mine, values), len(mine) - 1)
                out.append((a[i], b[i], int((mine[at] == values).sum()), len(values), len(mine)))
            yield pa.RecordBatch.from_pydict(
                {k: pa.array([x[j] for x in out], pa.int64()) for j, k in enumerate(("a", "b", "both", "n", "m"))}
            )

    return dealt.mapInArrow(run, "a long, b long, both long, n long, m long")


def link_components(docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, same, n_shingles, node, component, component_id) of every row of docs (doc_id, text).

    component tells components apart, also where ids repeat; component_id is the least id in it.
    """
    table = written(with_nodes(docs, size), "nodes")
    rows = table.where("block is null").select("doc_id", "same", "n_shingles", "node")
    ids = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    repeated = any_repeated(rows, "doc_id")
    counts = hashed_counts(table.where("block is not null"))

    # cold regions meet in one sort; hot ones are grouped before they are shuffled, and split when joined
    entries = members(docs, counts, size, percent)
    facts = _facts(percent)
    by_pivot = Window.partitionBy("pivot")
    cells = entries.where("not hot").drop("hot").withColumns({name: fact.over(by_pivot) for name, fact in facts.items()}).where(_PROMISING)
    if (counts > HOT_REGION).any():
        hot = written(entries.where("hot").drop("hot"), "hot")
        cells = cells.unionByName(
            hot.join(written(hot.groupBy("pivot").agg(*[f.alias(x) for x, f in facts.items()]).where(_PROMISING), "pivots"), "pivot")
        )
    (n, place), (lead_n, lead_place) = _size_and_place("at"), _size_and_place("lead_at")
    cells = cells.select(
        "pivot", "node", n.alias("n"), place.alias("place"), "members", "lead", lead_n.alias("lead_n"), lead_place.alias("lead_place")
    )
    cells = written(cells, "cells")

    near = _may_link(*[F.col(x) for x in ("n", "place", "lead_n", "lead_place")], percent)
    done = None
    for step in range(ROUNDS):
        pairs = cells.where((F.col("node") != F.col("lead")) & near)
        if step:
            pairs = pairs.where("part <> lead_part")
        pairs = pairs.select(F.col("node").alias("a"), F.col("lead").alias("b")).distinct()
        done = _measure(docs, pairs, ids, size, done, repeated)
        cells = _recurse(cells, done, percent, step)
    a, b = cells.alias("a"), cells.alias("b")
    last = (
        a.join(b, "pivot")
        .where("a.node < b.node and a.part <> b.part")
        .where(_may_link(*[F.col(x) for x in ("a.n", "a.place", "b.n", "b.place")], percent))
    )
    for step in range(ROUNDS):
        apart = F.abs(F.col(f"a.far{step}") - F.col(f"b.far{step}"))
        last = last.where((F.col(f"a.pivot{step}") != F.col(f"b.pivot{step}")) | apart.isNull() | (apart <= 1 - percent / SCALE + 1e-9))
    last = last.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()
    done = _measure(docs, last, ids, size, done, repeated)
    parts = components(_links(done, percent))
    return _named(rows, parts)


#: Regions with several sets of which one may be the smaller of a linked pair.
_PROMISING = "_low <> _high and _inner"


def _facts(percent):
    """Of a region: whether it holds candidates, and its pivot, the member with the fewest rarer shingles of its own."""
    n, place = _size_and_place("at")
    first = place.cast("long") * F.lit(1 << 33) + F.col("node").bitwiseAND((1 << 32) - 1)
    return {
        "_low": F.min("node"), "_high": F.max("node"), "members": F.count("*"),
        "_inner": F.max(n - place >= needed(n, n, percent)),
        "lead": F.min_by("node", first), "lead_at": F.min_by("at", first),
    }


def _size_and_place(at):
    return F.shiftright(at, 32).cast("int"), F.col(at).bitwiseAND((1 << 32) - 1).cast("int")


def _measure(docs, pairs, ids, size, done, repeated):
    if done is not None:
        old = done.select(F.least("a", "b").alias("_a"), F.greatest("a", "b").alias("_b"))
        pairs = pairs.join(old, (F.least("a", "b") == F.col("_a")) & (F.greatest("a", "b") == F.col("_b")), "left_anti")
    pairs = written(pairs, "pairs")
    if pairs.isEmpty():
        return done if done is not None else written(pairs.selectExpr("a", "b", "0L both", "0L n", "0L m"), "measured")
    new = written(measured(docs, pairs, ids, repeated, size), "measured")
    return new if done is None else done.union(new)


def _links(done, percent):
    return done.where(F.col("both") * SCALE >= (F.col("n") + F.col("m") - F.col("both")) * percent).select("a", "b")


def _recurse(cells, done, percent, step):
    """Regions that still hold several parts, with the distances to the pivot just used and a new pivot."""
    parts = written(components(_links(done, percent)), "joined").withColumnRenamed("component", "part")
    cells = cells.drop("part", "lead_part").where("members > 2").join(parts, "node", "left").withColumn("part", F.coalesce("part", "node"))
    mixed = cells.groupBy("pivot").agg(F.min("part").alias("_low"), F.max("part").alias("_high")).where("_low <> _high").select("pivot")
    cells = written(cells.join(mixed, "pivot", "left_semi"), "mixed")
    far = done.select(F.col("a").alias("node"), F.col("b").alias("lead"), (1 - F.col("both") / (F.col("n") + F.col("m") - F.col("both"))).alias("_far"))
    far = far.union(far.select(F.col("lead").alias("node"), F.col("node").alias("lead"), "_far")).groupBy("node", "lead").agg(F.min("_far").alias("_far"))
    cells = cells.join(far, ["node", "lead"], "left")
    cells = cells.withColumn("_far", F.when(F.col("node") == F.col("lead"), 0.0).otherwise(F.col("_far")))
    cells = cells.withColumnsRenamed({"_far": f"far{step}", "lead": f"pivot{step}"}).drop("lead_n", "lead_place")
    cells = written(cells, "parts")
    if step + 1 == ROUNDS:
        return cells
    turn = F.xxhash64("node", F.lit(step))
    again = (
        cells.groupBy("pivot").agg(*[F.min_by(c, turn).alias(f"lead{x}") for c, x in (("node", ""), ("n", "_n"), ("place", "_place"), ("part", "_part"))])
    )
    return written(cells.join(written(again, "pivots"), "pivot"), "cells")


def _named(rows, parts):
    """Components by their smallest id; a row that links with nothing is its own."""
    of = rows.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = written(of.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id")), "names")
    return of.join(least, "component", "left").select(
        "doc_id", "same", "n_shingles", "node", "component", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def one_of_each(docs: DataFrame, linked: DataFrame) -> DataFrame:
    """docs with one document of each component: the smallest id's, and of several texts of it the one with the least hash.

    Each row is judged by its id and text, so a text that is no copy stays whatever else its id holds. Rows that
    repeat both stay together; rows without an id stay.
    """
    texts = linked.where("doc_id is not null and component is not null").withColumnRenamed("same", "_same")
    first = texts.where("doc_id = component_id").groupBy("component").agg(F.min("doc_id").alias("doc_id"), F.min("_same").alias("_same"))
    drop = texts.select("doc_id", "_same").distinct().join(first, ["doc_id", "_same"], "left_anti")
    marked = docs.withColumn("_same", F.xxhash64("text"))
    return marked.join(drop, ["doc_id", "_same"], "left_anti").select(*docs.columns)
