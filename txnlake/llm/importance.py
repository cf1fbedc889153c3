"""Importance resampling towards a target by hashed word and word-pair features.

A feature is a word or two neighbouring words with a blank between; its bucket is the CRC-32 of
its bytes modulo BUCKETS. A bucket's gain is the log ratio of the target's share to the corpus's,
a document's weight the mean gain of its features, and adding Gumbel noise hashed from the id
makes the highest scores a sample without replacement.

Head-tail vocabulary: a pass over all documents finds frequent words and pairs with bounded
summaries (Misra-Gries); exact CRC states of the words and buckets of the pairs are broadcast,
at most HEAD of each, since a frequent one holds at least 1/HEAD of all. A feature of the head costs
one look-up. Unseen tail words take their CRC directly, and tail pairs join the states of their words, since
the CRC of a string is linear in the state it starts from. Both feed the exact bucket totals,
so the head decides about speed only, never about a result.

Look-ups compare 64-bit hashes; a tail feature takes a head feature's bucket with a chance of about HEAD / 2**64.
Texts are read in segments of at most about SEGMENT bytes that share a word at the cut, so a very long
text needs no more memory than a short one; only one word is ever held whole. Null and empty texts have no
features and weight 0. Rows that repeat an id draw the same noise; a null id draws like the word null and is
last among equals. Further columns are not read. Empty tables give no rows; with an empty target every gain
comes from the corpus alone.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txnlake.llm.hashing import BASE, mix, running_hash, span_hash, text_bytes
from txnlake.llm.tables import written

BUCKETS, SEED, PERCENT, LEAST_WORDS = 10_000, 7, 25, 20
#: A frequent word or pair holds at least one HEAD-th of all; counters of a task's summary.
HEAD, COUNTERS = 1 << 14, 1 << 12
SEGMENT = 1 << 18
#: Slots of a broadcast head; of entries that meet in a slot the most frequent stays.
SLOTS = 1 << 17
#: Words of more bytes are summed one by one.
LONGEST = 64
START = np.uint32(0xFFFFFFFF)
_BYTE = np.arange(256)
#: Digits, letters and all bytes of characters beyond ASCII.
IS_WORD = ((_BYTE >= 0x30) & (_BYTE <= 0x39)) | ((_BYTE >= 0x41) & (_BYTE <= 0x5A)) | ((_BYTE >= 0x61) & (_BYTE <= 0x7A)) | (_BYTE >= 0x80)
LOWER = np.where((_BYTE >= 0x41) & (_BYTE <= 0x5A), _BYTE + 32, _BYTE).astype(np.uint8)


def _crc_table() -> np.ndarray:
    """CRC-32 of each byte value (polynomial 0xEDB88320, reflected)."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC = _crc_table()


def step(state: np.ndarray, byte: np.ndarray | int) -> np.ndarray:
    """State after one more byte."""
    return CRC[(state ^ byte) & 0xFF] ^ (state >> 8)


def _zeros_tables() -> np.ndarray:
    """[n, i, b]: state after n zero bytes from a state with byte b at place i and zeros elsewhere."""
    table = np.empty((LONGEST + 1, 4, 256), np.uint32)
    table[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(LONGEST):
        table[n + 1] = step(table[n], 0)
    return table


ZEROS = _zeros_tables()


def states(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC state after each span of lower-case bytes."""
    out, size = np.full(len(starts), START, np.uint32), ends - starts
    alive = np.flatnonzero(size <= LONGEST)
    at = 0
    while len(alive):
        out[alive] = step(out[alive], data[starts[alive] + at])
        at += 1
        alive = alive[size[alive] > at]
    for i in np.flatnonzero(size > LONGEST):
        out[i] = ~np.uint32(zlib.crc32(data[starts[i] : ends[i]]))
    return out


def joined_states(first: np.ndarray, second: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC state after a word, a blank and the word of each span: first and second are the states of the words alone."""
    carry = step(first, 32) ^ START
    size = ends - starts
    short = np.minimum(size, LONGEST)
    out = second ^ ZEROS[short, 0, carry & 0xFF] ^ ZEROS[short, 1, (carry >> 8) & 0xFF] ^ ZEROS[short, 2, (carry >> 16) & 0xFF] ^ ZEROS[short, 3, carry >> 24]
    for i in np.flatnonzero(size > LONGEST):
        crc = zlib.crc32(b" ", int(~first[i]))
        out[i] = ~np.uint32(zlib.crc32(data[starts[i] : ends[i]], crc))
    return out


def bucket(state: np.ndarray) -> np.ndarray:
    return (~state % np.uint32(BUCKETS)).astype(np.int64)


class Segment:
    """Words of a run of texts, or of a piece of a long one.

    row is each word's text, counted from `first`; own tells which words are new, since a piece begins with the
    last word of the piece before. pairs are the places of words that have a next one in their text.
    """

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray, continued: bool):
        inside = IS_WORD[data]
        begin, end = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(data))]
        begin[cuts] = inside[cuts]
        end[cuts - 1] = inside[cuts - 1]
        self.first, self.data = first, LOWER[data]
        self.starts, self.ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
        self.row = np.searchsorted(offsets, self.starts, "right") - 1
        self.own = np.ones(len(self.starts), np.bool_)
        self.own[: int(continued)] = False
        self.pairs = np.flatnonzero(self.row[1:] == self.row[:-1])

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """64-bit hashes of the words and of the pairs."""
        words = span_hash(running_hash(self.data), self.starts, self.ends)
        return words, mix(words[self.pairs] * BASE + words[self.pairs + 1])


def segments(column: pa.Array) -> Iterator[Segment]:
    """All words of a column of texts, nulls as empty ones."""
    data, offsets = text_bytes(column)
    row, n = 0, len(column)
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + SEGMENT, "right")) - 1
        if end > row:
            yield Segment(row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row], False)
            row = end
            continue
        at, stop, last = int(offsets[row]), int(offsets[row + 1]), None
        while at < stop:
            cut = min(at + SEGMENT, stop)
            gaps = np.flatnonzero(~IS_WORD[data[at:cut]])
            if cut < stop and len(gaps):
                cut = at + int(gaps[-1]) + 1
            while cut < stop and not len(gaps) and IS_WORD[data[cut]]:
                ahead = np.flatnonzero(~IS_WORD[data[cut : min(cut + SEGMENT, stop)]])
                cut = cut + int(ahead[0]) if len(ahead) else min(cut + SEGMENT, stop)
            begin = at if last is None else last
            piece = Segment(row, data[begin:cut], np.array([0, cut - begin]), last is not None)
            yield piece
            if len(piece.starts):
                last = begin + int(piece.starts[-1])
            at = cut
        row += 1


class Head:
    """Frequent words with their CRC states and frequent pairs with their buckets, by hash."""

    def __init__(self, rows: list[tuple[int, int, int]]):
        """rows: (kind, key, value) by falling count; kind 0 are words."""
        self.keys = np.zeros((2, SLOTS), np.uint64)
        self.values = np.zeros((2, SLOTS), np.uint32)
        for kind, key, value in reversed(rows):
            at = key & (SLOTS - 1)
            self.keys[kind, at], self.values[kind, at] = np.uint64(key & (1 << 64) - 1), value

    def find(self, kind: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, places of the keys that are not there). A key of 0 counts as absent."""
        at = keys & np.uint64(SLOTS - 1)
        return self.values[kind, at], np.flatnonzero((self.keys[kind, at] != keys) | (keys == 0))

    def features(self, part: Segment) -> tuple[np.ndarray, np.ndarray]:
        """(bucket, text) of each feature of a segment."""
        words, pairs = part.hashes()
        state, tail = self.find(0, words)
        state[tail] = states(part.data, part.starts[tail], part.ends[tail])
        twos, tail = self.find(1, pairs)
        twos = twos.astype(np.int64)
        left, right = part.pairs[tail], part.pairs[tail] + 1
        twos[tail] = bucket(joined_states(state[left], state[right], part.data, part.starts[right], part.ends[right]))
        ones = bucket(state[part.own])
        return np.concatenate([ones, twos]), part.first + np.concatenate([part.row[part.own], part.row[part.pairs]])


class Summary:
    """Counts of the most frequent keys seen, in bounded memory (Misra-Gries); a key's value goes with it."""

    def __init__(self, counters: int = COUNTERS):
        self.counters, self.total = counters, 0
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray, values: np.ndarray) -> None:
        self.total += int(counts.sum())
        self.waiting.append((keys, counts, values))
        self.size += len(keys)
        if self.size > 32 * self.counters:
            self.fold()

    def fold(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.waiting:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        keys, counts, values = (np.concatenate(x) for x in zip(*self.waiting, strict=True))
        keys, first, back = np.unique(keys, return_index=True, return_inverse=True)
        counts, values = np.bincount(back, counts, len(keys)).astype(np.int64), values[first]
        if len(keys) > self.counters:
            counts = counts - np.partition(counts, -self.counters - 1)[-self.counters - 1]
            keep = counts > 0
            keys, counts, values = keys[keep], counts[keep], values[keep]
        self.waiting, self.size = [(keys, counts, values)], len(keys)
        return keys, counts, values


def learn_head(docs: DataFrame, head: int = HEAD) -> Head:
    """The frequent words and pairs of all texts. At most `head` rows of each kind reach the driver."""

    def run(batches):
        found = [Summary(), Summary()]
        for batch in batches:
            for part in segments(batch.column("text")):
                words, pairs = part.hashes()
                for kind, keys in ((0, words[part.own]), (1, pairs)):
                    keys, at, counts = np.unique(keys, return_index=True, return_counts=True)
                    if kind:
                        left, right = part.pairs[at], part.pairs[at] + 1
                        span = lambda i: (part.data, part.starts[i], part.ends[i])  # noqa: B023, E731
                        values = bucket(joined_states(states(*span(left)), states(*span(right)), *span(right)))
                    else:
                        at = np.flatnonzero(part.own)[at]
                        values = states(part.data, part.starts[at], part.ends[at])
                    found[kind].add(keys, counts, values.astype(np.uint32))
        for kind, summary in enumerate(found):
            keys, counts, values = summary.fold()
            rows = pa.table(
                {"kind": np.full(len(keys), kind, np.int32), "key": keys.view(np.int64), "n": counts, "value": values.astype(np.int64), "total": np.zeros(len(keys), np.int64)}
            )
            yield from rows.to_batches()
            yield pa.RecordBatch.from_pydict({"kind": pa.array([kind], pa.int32()), "key": [0], "n": [0], "value": [0], "total": [summary.total]})

    rows = docs.select("text").mapInArrow(run, "kind int, key long, n long, value long, total long")
    rows = written(rows.groupBy("kind", "key").agg(F.sum("n").alias("n"), F.max("value").alias("value"), F.sum("total").alias("total")), "head")
    totals = rows.groupBy("kind").agg(F.sum("total").alias("all"))
    frequent = rows.where("key <> 0").join(F.broadcast(totals), "kind").where(F.col("n") * head >= F.col("all"))
    found = frequent.select("kind", "key", "value", "n").collect()
    return Head([(r.kind, r.key, r.value) for r in sorted(found, key=lambda r: (-r.n, r.key))])


def bucket_totals(texts: DataFrame, head: Head) -> np.ndarray:
    """Exact number of features in each bucket over all texts. BUCKETS rows reach the driver."""
    shared = texts.sparkSession.sparkContext.broadcast(head)

    def run(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in segments(batch.column("text")):
                total += np.bincount(shared.value.features(part)[0], minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": used, "n": total[used]})

    out = np.zeros(BUCKETS, np.int64)
    for row in texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of the target's smoothed share to the corpus's for each bucket, in thousandths, floored."""
    scale = (float(corpus.sum()) + BUCKETS), (float(target.sum()) + BUCKETS)
    ratio = lambda s, t: math.floor(1000 * math.log((t + 1) * scale[0] / ((s + 1) * scale[1])))
    return np.array([ratio(float(s), float(t)) for s, t in zip(corpus, target, strict=True)], np.int64)


def weighed(docs: DataFrame, head: Head, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((head, gain))

    def run(batches):
        head, gain = shared.value
        for batch in batches:
            sums, words, features = np.zeros((3, batch.num_rows), np.int64)
            for part in segments(batch.column("text")):
                found, row = head.features(part)
                low, high = part.first, part.first + (int(part.row[-1]) + 1 if len(part.row) else 0)
                if high > low:
                    np.add.at(sums, row, gain[found])
                    features[low:high] += np.bincount(row - low, minlength=high - low)
                    words[low:high] += np.bincount(part.row[part.own], minlength=high - low)
            out = [batch.column("doc_id"), pa.array(words), pa.array(features), pa.array(sums // np.maximum(features, 1))]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def with_score(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """Adds score: weight plus Gumbel noise in thousandths, from a hash of the id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    u = (F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return rows.withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log(u))))


def ranked(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """Adds rank: 1, 2, 3 ... of the drawn, by falling score and rising id; null for all others.

    scored is read more than once and should be stored. Equal rows are counted before they meet. A score is a
    whole number of limited range (some 100,000 values, whatever the input), and the noise
    spreads the documents over them: the few rows of one score are ranked apart, above the total of all higher scores.
    """
    may = scored.where(F.col("n_words") >= least_words)
    drawn = may.count() * percent // 100
    rows = may.groupBy("score", "doc_id", "n_words", "n_features", "weight").agg(F.count("*").alias("n"))
    totals = may.groupBy("score").agg(F.count("*").alias("n"))
    above = F.sum("n").over(W.orderBy(F.desc("score"))) - F.col("n")
    totals = totals.select("score", above.alias("above")).where(F.col("above") < drawn)
    own = W.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), "n_words", "n_features", "weight").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = rows.join(totals, "score", "left").withColumn("last", F.col("above") + F.sum("n").over(own))
    place = F.explode(F.sequence(F.coalesce(F.col("last") - F.col("n"), F.lit(0)) + 1, F.coalesce("last", "n")))
    placed = placed.withColumn("place", place)
    rank = F.when(F.col("above").isNotNull() & (F.col("place") <= drawn), F.col("place"))
    others = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return placed.withColumn("rank", rank).select(*others.columns).union(others)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of docs (doc_id, text).

    target (text) is what the sample shall look like. Of the documents with least_words words and more, percent
    of a hundred are drawn; join the rows with a rank to docs for their texts.
    """
    head = learn_head(docs)
    gain = gains(bucket_totals(docs, head), bucket_totals(target, head))
    return ranked(written(with_score(weighed(docs, head, gain), seed), "scored"), percent, least_words)
