"""Exact metric range join of embeddings under cosine similarity.

On unit vectors a cosine of at least c is a Euclidean distance of at most
sqrt(2 - 2c), so the join is a range join in a metric space. Within each label,
cells that are too large are divided by pivots, some of their own vectors: each
vector's home is the cell of its nearest pivot, and it also visits every other
cell to whose border it is near enough. By the triangle inequality the distance to the
border between pivots p (home) and q is at least (d(x,q)^2 - d(x,p)^2) / (2 d(p,q)); no partner
lies beyond a border farther than the range. Cells then join independently: a
vector meets all its partners in its home cell and is counted there only.

A division is kept only where it pays: where a row visits few of the cells on average. Cells
that stay large (vectors too much alike, or too many dimensions for pivots to
tell apart) are joined in blocks, so no task holds more than two blocks. Equal
vectors of one label are one node with a count. Cosines are computed in double precision
from the given values. Links are not written out: tasks return counts and a
spanning forest of what they have seen.

Vectors that are null, zero, of no component, or hold null or non-finite components,
and vectors whose label is null, link with nothing, nor do vectors of different length.
A row without vec_id takes no part: 0 links, null component, kept null. Rows that repeat a vec_id are vectors of
their own, each with its own links; several of them may be kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm.tables import components, written

LEAST_COSINE = 0.93
#: Vectors of a cell that meet in one task, levels of division, and pivots of a cell at each.
BLOCK, LEVELS, PIVOTS = 2048, 2, 16
#: Most visits of a row, on average, for which a division is kept.
VISITS = 3
#: Rows that one copy of a cell's pivots serves.
ROWS_PER_COPY = 4096
#: Slack for rounding in windows; it only lets more vectors visit.
SLACK = 1e-9
_ROLE_PIVOT, _ROLE_MEMBER = 0, 1


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


def unit_nodes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row, vec_id, node, copies) of every row, and (node, cell, home, copies, unit) of every different vector that may link.

    A node is named by the least number of its rows, which are numbered when they are stored.
    """

    def run(batches):
        for batch in batches:
            units = []
            for v in batch.column("embedding").to_pylist():
                x = np.array([np.nan if a is None else a for a in v or []], np.float64)
                top = np.abs(x).max() if len(x) else 0
                ok = len(x) and np.isfinite(x).all() and top > 0
                if ok and not 1e-100 < top < 1e100:
                    x = x / top
                units.append((x / np.sqrt(x @ x)).tobytes() if ok else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(units, pa.binary())], names=["vec_id", "label", "unit"]
            )

    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), "embedding")
    rows = rows.mapInArrow(run, "vec_id long, label string, unit binary")
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "units")
    may = rows.where("vec_id is not null and label is not null and unit is not null")
    nodes = written(may.groupBy("label", "unit").agg(F.min("row").alias("node"), F.count("*").alias("copies")), "nodes")
    of = may.join(nodes, ["label", "unit"]).select("row", "node", "copies")
    nodes = nodes.select("node", F.xxhash64("label", F.length("unit")).alias("cell"), F.lit(True).alias("home"), "copies", "unit")
    return rows.select("row", "vec_id").join(of, "row", "left"), nodes


def _divide(rows: DataFrame, level: int, reach: float) -> DataFrame:
    """Rows of large cells dealt to the cells of pivots, with a row for every visit."""
    sizes = rows.groupBy("cell").agg(F.count("*").alias("size"))
    large = written(sizes.where(F.col("size") > BLOCK), "large")
    if large.isEmpty():
        return rows
    inside = rows.join(large, "cell")
    # a hash picks the pivots: about as many in each cell as PIVOTS says
    draw = F.pmod(F.xxhash64("node", F.lit(level)), F.lit(1 << 30)) / float(1 << 30)
    pivots = inside.where("home").where(draw < F.lit(float(PIVOTS)) / F.col("size")).select("cell", "size", "unit", F.xxhash64("node", F.lit("p")).alias("sub"))
    copies = F.ceil(F.col("size") / ROWS_PER_COPY).cast("int")
    left = inside.select("cell", "node", "home", "copies", "unit", F.lit(None).cast("long").alias("sub"), F.lit(_ROLE_MEMBER).alias("role"), F.pmod(F.xxhash64("node"), copies).cast("int").alias("copy"))
    right = pivots.select(
        "cell", F.lit(None).cast("long").alias("node"), F.lit(None).cast("boolean").alias("home"), F.lit(None).cast("long").alias("copies"), "unit", "sub",
        F.lit(_ROLE_PIVOT).alias("role"), F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"),
    )
    dealt = left.union(right)
    ordered = dealt.repartition("cell", "copy").sortWithinPartitions("cell", "copy", "role")

    def runs(batches):
        """Each cell's rows with its pivots."""
        place, subs, centres = None, [], []
        for batch in batches:
            cells, copy, role = (batch.column(c).to_numpy() for c in ("cell", "copy", "role"))
            cuts = np.flatnonzero(np.concatenate([[True], (cells[1:] != cells[:-1]) | (copy[1:] != copy[:-1]) | (role[1:] != role[:-1])]))
            for a, b in zip(cuts, [*cuts[1:], len(cells)], strict=True):
                part = batch.slice(a, b - a)
                if (cells[a], copy[a]) != place:
                    place, subs, centres = (cells[a], copy[a]), [], []
                if role[a] == _ROLE_PIVOT:
                    subs += part.column("sub").to_pylist()
                    centres.append(_matrix(part.column("unit")))
                else:
                    yield cells[a], part, _visits(part, np.array(subs, np.int64), centres, reach, cells[a])

    def count(batches):
        for cell, part, (index, _, _) in runs(batches):
            yield pa.RecordBatch.from_pydict({"cell": [cell], "rows": [part.num_rows], "visits": [len(index)]})

    def move(batches):
        for _, part, (index, cell, home) in runs(batches):
            out = part.select(["node", "copies", "unit"]).take(pa.array(index))
            yield pa.RecordBatch.from_arrays(
                [out.column("node"), pa.array(cell), pa.array(home), out.column("copies"), out.column("unit")],
                names=["node", "cell", "home", "copies", "unit"],
            )

    tried = ordered.mapInArrow(count, "cell long, rows long, visits long").groupBy("cell").agg(F.sum("rows").alias("r"), F.sum("visits").alias("v"))
    pays = written(tried.where(F.col("v") <= VISITS * F.col("r")).select("cell"), "pays")
    if pays.isEmpty():
        return rows
    moved = dealt.join(pays, "cell", "left_semi").repartition("cell", "copy").sortWithinPartitions("cell", "copy", "role")
    moved = moved.mapInArrow(move, "node long, cell long, home boolean, copies long, unit binary")
    return written(rows.join(pays, "cell", "left_anti").select(*moved.columns).union(moved.select(*moved.columns)), "cells")


def _visits(part, subs, centres, reach, cell):
    """Row index, cell and home flag of every visit of the rows of one cell."""
    home = part.column("home").to_numpy(zero_copy_only=False)
    if len(subs) < 2:
        return np.arange(part.num_rows), np.full(part.num_rows, cell), home
    centre = np.concatenate(centres)
    order = np.argsort(subs)
    subs, centre = subs[order], centre[order]
    square = 2 - 2 * (_matrix(part.column("unit")) @ centre.T)
    between = np.sqrt(np.maximum(2 - 2 * centre @ centre.T, 0))
    near = square.argmin(1)
    rows = np.arange(len(near))
    visit = square - square[rows, near][:, None] <= 2 * reach * between[near] + SLACK
    visit[rows, near] = True
    index, column = np.nonzero(visit)
    return index, subs[column], home[index] & (column == near[index])


def _joined(rows: DataFrame, least: float) -> DataFrame:
    """(node, links, other): links counted at home, and edges of a spanning forest, of every cell."""
    sizes = written(rows.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "sizes")
    rows = rows.join(sizes, "cell").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    base = ["cell", "node", "copies", "unit"]
    mine = rows.where("home").select(*base, F.col("block").alias("i"), each.alias("j"), F.lit(True).alias("mine"))
    others = rows.select(*base, F.col("block").alias("j"), each.alias("i"), F.lit(False).alias("mine")).select(*mine.columns)

    def run(key, table):
        table = table.sort_by([("node", "ascending")])
        flags = table.column("mine").to_numpy()
        a, b = table.filter(pa.array(flags)), table.filter(pa.array(~flags))
        edges = [np.zeros(0, np.int64)] * 2
        links = np.zeros(a.num_rows, np.int64)
        if a.num_rows and b.num_rows:
            left, right = (_matrix(x.column("unit").combine_chunks()) for x in (a, b))
            na, nb = a.column("node").to_numpy(), b.column("node").to_numpy()
            weight = b.column("copies").to_numpy()
            ids = np.unique(np.concatenate([na, nb]))
            part, at, bt = np.arange(len(ids)), np.searchsorted(ids, na), np.searchsorted(ids, nb)
            for s in range(0, len(left), 256):
                close = left[s : s + 256] @ right.T >= least
                close[at[s : s + 256][:, None] == bt[None, :]] = False
                links[s : s + 256] = close @ weight
                for i in np.flatnonzero(close.any(1)):
                    own = np.unique(part[np.append(bt[close[i]], at[s + i])])
                    if len(own) > 1:
                        part[np.isin(part, own)] = own[0]
            moved = np.flatnonzero(part != np.arange(len(ids)))
            edges = [ids[moved], ids[part[moved]]]
        count = pa.table({"node": a.column("node"), "links": pa.array(links), "other": pa.nulls(a.num_rows, pa.int64())})
        more = pa.table({"node": pa.array(edges[0]), "links": pa.nulls(len(edges[0]), pa.int64()), "other": pa.array(edges[1])})
        return pa.concat_tables([count, more])

    return mine.union(others).groupBy("cell", "i", "j").applyInArrow(run, "node long, links long, other long")


def link_vectors(vectors: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of vectors (vec_id, embedding, label)."""
    of, rows = unit_nodes(vectors)
    for level in range(LEVELS):
        rows = _divide(rows, level, float(np.sqrt(2 - 2 * least)))
    found = written(_joined(rows, least), "found")
    counts = found.where("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    parts = components(found.where("other is not null"), "node", "other")
    out = of.join(counts, "node", "left").join(parts, "node", "left").withColumn("part", F.coalesce("component", "node"))
    out = written(out, "linked")
    names = out.where("part is not null").groupBy("part").agg(F.min("vec_id").alias("least"))
    component = F.coalesce("least", "vec_id")
    return out.join(names, "part", "left").select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
