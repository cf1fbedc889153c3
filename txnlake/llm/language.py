"""Language identification by rank-order profiles.

A profile is the list of the most frequent letter n-grams (1 to 3 letters, a blank
marking word ends), most frequent first. A text goes to the language whose profile
is at the smallest out-of-place distance: the sum over the text's n-grams of
how far each is from its rank there, or the most possible where it is missing.
Language profiles are counted over all training texts: each task sums its own
n-grams first, Spark sums the rest, and only the profiles reach the driver.

Ties in a profile go to the smaller n-gram code, ties between languages to the
smaller name. A null text, and a text without letters, is `und` with score 0, as is
every text when nothing was learned. Rows keep all their columns.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOP, LONGEST = 300, 3
UNKNOWN = "und"
#: More languages than this are an error, as the profiles are sent to every task.
MOST_LANGUAGES = 2000
_SHIFT = 21
#: Characters that are handled at once, and n-grams that a task holds before it counts them.
CHUNK, HELD = 1 << 18, 1 << 21
_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _letters[0]


def grams(texts: list[str | None]):
    """The n-gram codes of each text."""
    start = 0
    while start < len(texts):
        end, held = start, 0
        while end < len(texts) and (held == 0 or held + len(texts[end] or "") <= CHUNK):
            held += len(texts[end] or "") + 1
            end += 1
        low = [(t or "").lower() for t in texts[start:end]]
        codes = np.frombuffer("".join(f"\n{t}\n" for t in low).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(_letter_table()[codes], codes, 0).astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum([len(t) + 2 for t in low])])
        two = codes[:-1] | codes[1:] << _SHIFT
        three = two[:-1] | codes[2:] << 2 * _SHIFT
        two_ok = (codes[:-1] > 0) | (codes[1:] > 0)
        three_ok = codes[1:-1] > 0
        for i in range(end - start):
            a, b = bounds[i], bounds[i + 1]
            one = codes[a:b]
            # a blank as first letter of a pair gives the code of its second one alone, shifted
            yield np.concatenate([one[one > 0], two[a : b - 1][two_ok[a : b - 1]], three[a : b - 2][three_ok[a : b - 2]]])
        start = end


def counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(values, return_counts=True)


def ranked(values: np.ndarray, top: int) -> np.ndarray:
    """The most frequent values, most frequent first."""
    keys, counts = counted(values)
    if len(keys) > 4 * top:
        least = -np.partition(-counts, top - 1)[top - 1]
        keys, counts = keys[counts >= least], counts[counts >= least]
    return keys[np.lexsort((keys, -counts))[:top]]


def learn(docs: DataFrame, top: int = TOP) -> dict[str, np.ndarray]:
    """Profiles from rows of (text, lang); rows without either are left out."""

    def fold(total, held):
        for lang, lists in held.items():
            keys, counts = counted(np.concatenate(lists))
            if lang in total:
                keys, at = np.unique(np.concatenate([total[lang][0], keys]), return_inverse=True)
                counts = np.bincount(at, np.concatenate([total[lang][1], counts])).astype(np.int64)
            total[lang] = keys, counts

    def run(batches):
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        held: dict[str, list[np.ndarray]] = {}
        waiting = 0
        for batch in batches:
            for lang, values in zip(batch.column("lang").to_pylist(), grams(batch.column("text").to_pylist()), strict=True):
                held.setdefault(lang, []).append(values)
                waiting += len(values)
                if waiting > HELD:
                    fold(total, held)
                    held, waiting = {}, 0
        fold(total, held)
        for lang, (keys, counts) in total.items():
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(keys)), "gram": keys, "n": counts})

    known = docs.select("text", "lang").where("text is not null and lang is not null")
    sums = known.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("gram"), F.lit(16))).orderBy(F.desc("n"), "gram")
    best = sums.withColumn("_at", F.row_number().over(part)).where(F.col("_at") <= top)
    lists = best.groupBy("lang").agg(F.slice(F.sort_array(F.collect_list(F.struct(-F.col("n"), "gram"))), 1, top).alias("best"))
    rows = lists.select("lang", F.col("best.gram").alias("grams")).limit(MOST_LANGUAGES + 1).collect()
    if len(rows) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    return {r.lang: np.array(r.grams, np.int64) for r in rows}


def distances(profile: np.ndarray, known: list[tuple[np.ndarray, np.ndarray]], top: int) -> np.ndarray:
    """Out-of-place distance to each (sorted n-grams, their ranks)."""
    out, rank = np.empty(len(known)), np.arange(len(profile))
    for i, (keys, ranks) in enumerate(known):
        at = np.minimum(np.searchsorted(keys, profile), len(keys) - 1)
        out[i] = np.where(keys[at] == profile, np.abs(ranks[at] - rank), top).sum()
    return out


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], top: int = TOP) -> DataFrame:
    """docs with lang_pred and score: 1 at distance 0, 0 where no n-gram is shared."""
    docs = docs.drop("lang_pred", "score")
    names = sorted(lang for lang, grams_ in profiles.items() if len(grams_))
    known = [(profiles[x][order], order) for x in names for order in [np.argsort(profiles[x])]]
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        for batch in batches:
            langs, scores = [], []
            for values in grams(batch.column("text").to_pylist()):
                if not len(values) or not names:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                profile = ranked(values, top)
                far = distances(profile, shared.value, top)
                langs.append(names[int(far.argmin())])
                scores.append(1 - float(far.min()) / (top * len(profile)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names, "lang_pred", "score"]
            )

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
