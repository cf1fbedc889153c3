"""Audit of how filters of documents interact, over all orders of applying them.

A state of the subset lattice is the set of filters applied so far; an edge applies one
more. What an edge removes depends on its state alone, so the 2**n states hold what all n!
orders do. Forward-backward path counting gives the orders that use an edge: those that
reach its state times those that leave its end. Weighted by it, the removals of a filter's
edges add up to its Shapley total; the steps of one order are the edges on its path.

Documents shrink to counts by part and set of failed filters before anything else, so the
lattice never sees a document. Its size follows from the number of filters: at most
MOST_FILTERS, since all orders are listed.

Null texts are empty. A document whose text equals that of a smaller id is a copy;
rows that repeat an id are no copies of each other, and a row without an id neither is a
copy nor makes one, and has no label. Several label rows of one id count as one that holds all their marks.
Parts without rows have no result, so an empty table has none.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
MOST_FILTERS = 8
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, ODD_CHARACTERS = 200, 50, 3, r"[#$%&*|]"
BLANKS = r"[\x20\x09-\x0D]+"
#: Places over which rows without an id are dealt when they meet the labels.
SALTS = 1024
_COUNTS = ("n", "good", "toxic")


def text_failures(text: Column) -> list[Column]:
    """Failure of the filters that look at one text: too short, repetitive, capitals, odd characters."""
    words = F.array_remove(F.split(text, BLANKS), "")
    return [
        F.size(words) < MIN_WORDS,
        100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * F.size(words),
        100 * F.regexp_count(text, F.lit("[A-Z]")) > CAPITAL_PERCENT * F.length(text),
        text.rlike(ODD_CHARACTERS),
    ]


def failure_counts(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by the set of filters they fail.

    Bit i of mask is filter i. A text travels as its digest, and copies add up
    before they meet, so a text that very many documents hold is a few rows.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        reduce(add, [F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(text_failures(text))]).alias("mask"),
    )
    salt = F.when(F.col("doc_id").isNull(), 1 + F.pmod(F.xxhash64("digest"), F.lit(SALTS))).otherwise(0)
    rows = rows.withColumn("_salt", salt).withColumn("_id", F.coalesce("doc_id", F.lit(0)))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_id"))
    marks = marks.agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    marked = rows.join(marks.withColumn("_salt", F.lit(0).cast("long")), ["_id", "_salt"], "left")
    kind = ["digest", "part", "mask", "good", "toxic"]
    marked = marked.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    by_id = marked.groupBy("_id", "_salt", "doc_id", *kind).agg(F.count("*").alias("n"))
    # of each kind of copies: how many there are, how many hold its least id, how many none
    first = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))
    kinds = by_id.groupBy(*kind).agg(
        F.sum("n").alias("n"), F.min(first).alias("first"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless")
    )
    least = kinds.groupBy("digest").agg(F.min("first.doc_id").alias("least"))
    kinds = kinds.join(least, "digest")
    fresh = F.col("nameless") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    copy = F.lit(1 << FILTERS.index("E"))
    both = F.array(
        F.struct(F.col("mask").alias("mask"), fresh.alias("n")), F.struct((F.col("mask") + copy).alias("mask"), (F.col("n") - fresh).alias("n"))
    )
    split = kinds.select("part", "good", "toxic", F.explode(both).alias("x")).select("part", "x.mask", "x.n", "good", "toxic")
    marked_as = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c)
    return split.groupBy("part", "mask").agg(F.sum("n").alias("n"), marked_as("good"), marked_as("toxic"))


def lattice(n: int) -> list[tuple[int, int, int, int]]:
    """(state, filter, next state, orders that use the edge) of every edge."""
    full = (1 << n) - 1
    reach, leave = [1] + [0] * full, [0] * full + [1]
    edges = [(s, f, s | 1 << f) for s in range(full + 1) for f in range(n) if not s >> f & 1]
    for s, _, after in edges:
        reach[after] += reach[s]
    for s, _, after in reversed(edges):
        leave[s] += leave[after]
    return [(s, f, after, reach[s] * leave[after]) for s, f, after in edges]


def paths(n: int) -> list[tuple[int, int, int, int]]:
    """(order, step, state, filter) of every edge on every order's path; orders as permutations() lists them."""
    out = []
    for i, order in enumerate(permutations(range(n))):
        state = 0
        for step, f in enumerate(order, 1):
            out.append((i, step, state, f))
            state |= 1 << f
    return out


def state_counts(counts: DataFrame, n: int) -> DataFrame:
    """(part, kept): what each of the 2**n states keeps, an array of (state, n, good, toxic) by state."""
    each = counts.withColumn("state", F.explode(F.sequence(F.lit(0), F.lit((1 << n) - 1))))
    passes = F.col("mask").bitwiseAND(F.col("state")) == 0
    states = each.groupBy("part", "state").agg(*[F.sum(F.when(passes, F.col(c)).otherwise(0)).alias(c) for c in _COUNTS])
    return states.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("state", *_COUNTS))).alias("kept"))


def _rows(fields: str, rows: list[tuple]) -> Column:
    """Literal rows as one array of structs."""
    return F.array(*[F.struct(*[F.lit(x).alias(k) for k, x in zip(fields.split(), row, strict=True)]) for row in rows])


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order and step from counts (part, mask, n, good, toxic).

    kept and removed count documents after and at the step; redundant are those that fail its
    filter and had gone before; unique_fails fail it alone; good_lost and toxic_lost are those of
    the removed; shapley adds up what its filter removes over all orders.
    """
    n = len(filters)
    if n > MOST_FILTERS:
        raise ValueError(f"at most {MOST_FILTERS} filters")
    full = (1 << n) - 1
    at = lambda state, c: F.get(F.col("kept"), state)[c]
    own = F.expr("shiftleft(1, filter)")
    lost = {c: at(F.col("state"), c) - at(F.col("next"), c) for c in _COUNTS}
    edges = state_counts(counts, n).select("part", "kept", F.inline(_rows("state filter next orders", lattice(n))))
    edges = edges.select(
        "part", "state", "filter", "orders",
        at(F.col("next"), "n").alias("kept"),
        lost["n"].alias("removed"),
        (at(F.lit(0), "n") - at(own, "n") - lost["n"]).alias("redundant"),
        (at(F.lit(full) - own, "n") - at(F.lit(full), "n")).alias("unique_fails"),
        lost["good"].alias("good_lost"),
        lost["toxic"].alias("toxic_lost"),
    )
    totals = edges.groupBy("part", "filter").agg(F.sum(F.col("removed") * F.col("orders")).alias("shapley"))
    names = ["".join(filters[f] for f in order) for order in permutations(range(n))]
    steps = [(names[i], step, state, f) for i, step, state, f in paths(n)]
    # as many rows as the orders have steps, whatever the documents
    steps = counts.sparkSession.createDataFrame(steps, "filter_order string, step int, state int, filter int")
    return edges.join(F.broadcast(steps), ["state", "filter"]).join(totals, ["part", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )
