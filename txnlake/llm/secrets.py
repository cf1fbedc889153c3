"""Secret scans with built-in expressions only.

Three patterns give the base spans; two character Markov models, one of random
strings and one of ordinary identifiers, add spans of unmarked secrets: a long
token whose log-likelihood ratio per transition reaches a threshold. The models
are first-order transition counts (with add-half smoothing) over a bounded sample
of labelled strings, and meet in one table of 128 x 128 ratios.

The values that the patterns find serve as labelled random strings and long plain
words as labelled identifiers, unless the caller has labelled strings of
their own. Without samples of both kinds the models add nothing.

Spans count code points and end exclusively. Null texts are empty; empty texts
have no span. Matches of one kind do not overlap; those of different kinds may.
Any further columns stay as they are, except that scan() replaces those named like a kind.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "markov")
#: The contract's patterns. Greedy runs make the length limits of access and hex part of the pattern.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LONG_TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
IDENTIFIER = r"(?<![A-Za-z0-9_])[A-Za-z][a-z0-9_]{7,}(?![A-Za-z0-9_])"
SHORTEST_VALUE = 6
#: Most labelled strings of each class, and most texts that identifiers are taken from.
TRAIN_STRINGS, TRAIN_TEXTS = 20_000, 5_000
#: Nats per transition from which a token counts as random.
RATIO = 1.0
CODES = 128


def _where(text: Column, regex: str, group: int = 2) -> Column:
    """Array of (start, end, value) of the leftmost matches that do not overlap.

    Each match takes the text since the one before it as a first group, so the
    lengths add up to positions. The anchor keeps the scan linear.
    """
    whole = r"(?s)\G(.*?)(" + regex + ")"
    gaps = F.regexp_extract_all(text, F.lit(whole), F.lit(1))
    hits = F.regexp_extract_all(text, F.lit(whole), F.lit(2))
    values = hits if group == 2 else F.regexp_extract_all(text, F.lit(whole), F.lit(group))
    start = lambda acc, x: acc["at"] + F.length(x["gap"])
    zipped = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), values.alias("value"))
    none = F.expr("cast(array() as array<struct<start:int,end:int,value:string>>)")
    out = F.aggregate(
        zipped,
        F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda acc, x: F.struct(
            (start(acc, x) + F.length(x["hit"])).alias("at"),
            F.concat(
                acc["out"],
                F.array(F.struct(start(acc, x).alias("start"), (start(acc, x) + F.length(x["hit"])).alias("end"), x["value"].alias("value"))),
            ).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    return F.when(text.rlike(regex), out).otherwise(none)


def with_base(docs: DataFrame) -> DataFrame:
    """docs with arrays assign, access and hex of (start, end, value)."""
    text = F.coalesce("text", F.lit(""))
    docs = docs.drop(*KINDS)
    docs = docs.withColumn("assign", F.filter(_where(text, ASSIGN, 3), lambda x: F.length(x["value"]) >= SHORTEST_VALUE))
    return docs.withColumn("access", _where(text, ACCESS)).withColumn("hex", _where(text, HEX))


def labelled(docs: DataFrame, strings: int = TRAIN_STRINGS, texts: int = TRAIN_TEXTS) -> DataFrame:
    """(value, random) samples: base values against plain words, each kind bounded and chosen by hash."""
    some = docs.select("text").where("text is not null")
    marked = some.where(F.col("text").rlike(ASSIGN) | F.col("text").rlike(ACCESS) | F.col("text").rlike(HEX))
    values = with_base(marked).select(F.explode(F.concat("assign", "access", "hex")).alias("x")).select("x.value")
    hashed = some.select(F.xxhash64("text").alias("h"), "text")
    last = hashed.select("h").distinct().orderBy("h").limit(texts).agg(F.max("h")).first()[0]
    few = hashed.where(F.col("h") <= F.lit(last)).dropDuplicates(["h"])
    words = few.select(F.explode(F.regexp_extract_all("text", F.lit(IDENTIFIER), F.lit(0))).alias("value"))
    pick = lambda df, kind: df.distinct().orderBy(F.xxhash64("value"), "value").limit(strings).withColumn("random", F.lit(kind))
    return pick(values, True).union(pick(words, False))


def fit(samples: DataFrame) -> list[float] | None:
    """Log-likelihood ratios of all transitions, row by row; None if a class has no transition.

    At most 2 x 128 x 128 counts reach the driver.
    """
    chars = F.split("value", "")
    pairs = F.arrays_zip(F.slice(chars, 1, F.length("value") - 1).alias("a"), F.slice(chars, 2, F.length("value") - 1).alias("b"))
    counts = (
        samples.where("value rlike '^[\\\\x00-\\\\x7f]{2,}$'")
        .select("random", F.explode(pairs).alias("p"))
        .groupBy("random", F.ascii("p.a").alias("a"), F.ascii("p.b").alias("b"))
        .count()
        .collect()
    )
    seen = {kind: [[0.5] * CODES for _ in range(CODES)] for kind in (True, False)}
    for row in counts:
        seen[row.random][row.a][row.b] += row["count"]
    if {row.random for row in counts} != {True, False}:
        return None
    share = {kind: [[math.log(x / sum(line)) for x in line] for line in table] for kind, table in seen.items()}
    return [round(r - o, 6) for x, y in zip(share[True], share[False], strict=True) for r, o in zip(x, y, strict=True)]


def ratio(value: Column, table: list[float]) -> Column:
    """Mean log-likelihood ratio per transition of an ASCII string."""
    ratios = F.from_json(F.lit(json.dumps(table)), "array<double>")
    chars, n = F.split(value, ""), F.length(value) - 1
    steps = F.zip_with(F.slice(chars, 1, n), F.slice(chars, 2, n), lambda a, b: F.get(ratios, F.ascii(a) * CODES + F.ascii(b)))
    return F.aggregate(steps, F.lit(0.0), lambda acc, x: acc + x) / n


def scan(docs: DataFrame, table: list[float] | None, least: float = RATIO) -> DataFrame:
    """docs with one array for each kind; spans of the models never overlap base spans."""
    docs = with_base(docs)
    if table is None:
        return docs.withColumn("markov", F.slice("hex", 1, 0))
    base = F.concat("assign", "access", "hex")
    clear = lambda x: ~F.exists(base, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]))
    found = F.filter(_where(F.coalesce("text", F.lit("")), LONG_TOKEN), lambda x: clear(x) & (ratio(x["value"], table) >= least))
    return docs.withColumn("markov", found)


def spans(*kinds: str) -> Column:
    """kind:start:end of the named arrays, by start and then kind, joined with commas."""

    def of(i: int, kind: str) -> Column:
        return F.transform(kind, lambda x: F.struct(x["start"].alias("start"), F.lit(i).alias("i"), x["end"].alias("end"), F.lit(kind).alias("kind")))

    rows = [of(i, kind) for i, kind in enumerate(kinds)]
    return F.array_join(F.transform(F.sort_array(F.concat(*rows)), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redacted(docs: DataFrame, table: list[float] | None, mark: str = "[SECRET]") -> DataFrame:
    """docs with every span in text replaced by the mark and n_chars brought up to date.

    Texts without a span stay as they are, null included, and so do all other columns, whatever their names.
    """
    keep = docs.columns
    docs = docs.select(F.struct(*docs.columns).alias("_doc"), "text")
    places = F.sort_array(F.transform(F.concat(*KINDS), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))))
    clean = F.aggregate(
        places,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, x: F.when(
            x["start"] < acc["at"], F.struct(F.greatest(acc["at"], x["end"]).alias("at"), acc["out"].alias("out"))
        ).otherwise(
            F.struct(
                x["end"].alias("at"),
                F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, x["start"] - acc["at"]), F.lit(mark)).alias("out"),
            )
        ),
        lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))),
    )
    found = scan(docs, table).withColumn("_any", F.size(F.concat(*KINDS)) > 0)
    out = found.withColumn("text", F.when(F.col("_any"), clean).otherwise(F.col("text")))
    new = {"text": F.col("text")}
    if "n_chars" in keep:
        new["n_chars"] = F.when(F.col("_any"), F.length("text").cast("long")).otherwise(F.col("_doc.n_chars"))
    return out.select(*[new.get(c, F.col("_doc")[c]).alias(c) for c in keep])
