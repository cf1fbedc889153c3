"""Benchmark decontamination by canonical templates.

Texts become templates: a word that starts with a digit is a number, with its sign, separators
and decimals (1,200 or -3.5 is one), a unit word after a number is a unit, and a capitalised word
is a name; each is replaced by a placeholder of its type. Windows of WINDOW words of the benchmark's templates are
hash-joined with those of the documents, and the slots of each match are
checked: where the item repeats a number or a name the document must repeat one too; units
may change, and different values may become equal. A question whose numbers and
names were exchanged is caught. A second form keeps names as folded words, so copies in
other letter case are caught too, and a third has one placeholder for a run of
capitalised words with only blanks between them, so Alice may become Mary Ann.

Words are runs of letters and digits (bytes above 0x7F count as letters). An item
shorter than a window is one window of its own length; items of fewer than
SHORTEST words, and windows with fewer than LITERALS words outside slots, are too
general to prove anything and are not matched. Null and empty texts match
nothing. Repeated rows give the same result: matches are per doc_id and item_id.

The benchmark's window keys are folded into a bit table of fixed size. It drops
nearly all document windows before the join and can let wrong ones pass but never
drop right ones, so the join is exact whatever the size of the benchmark, and
nothing broadcast grows with it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm.hashing import BASE, IS_BLANK, LOWER, chunks, mix, running_hash, span_hash
from txnlake.llm.tables import bit_of, bit_table

WINDOW, SHORTEST, LITERALS = 13, 5, 4
UNITS = (
    "mm cm m km mg g kg t ml l s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months "
    "year years inch inches foot feet yard yards mile miles ounce ounces pound pounds percent euro euros dollar dollars cent cents "
    "meter meters metre metres litre litres liter liters gram grams watt watts volt volts degree degrees"
).split()
_NUMBER, _UNIT, _NAME = (np.uint64(x) for x in (11, 13, 17))
#: Kind of a slot, in the two lowest bits of its value.
_KINDS, UNIT_KIND = np.uint64(3), 2
_BYTES = np.arange(256)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_WORD = _DIGIT | _UPPER | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)


class Templates:
    """Tokens of a chunk in three forms, and which of them are slots."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        inside = _WORD[data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        first[edges] = inside[edges]
        last[edges - 1] = inside[edges - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        bounds = np.searchsorted(starts, offsets)
        if len(starts):
            # digits, one separator and digits again are one number
            point = (data[np.minimum(ends, len(data) - 1)] == 44) | (data[np.minimum(ends, len(data) - 1)] == 46)
            number, row = _DIGIT[data[starts]], np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
            more = np.zeros(len(starts), np.bool_)
            more[1:] = number[1:] & number[:-1] & _DIGIT[data[ends[:-1] - 1]] & point[:-1] & (starts[1:] == ends[:-1] + 1) & (row[1:] == row[:-1])
            ends = ends[np.append(~more[1:], True)]
            starts = starts[~more]
            bounds = np.searchsorted(starts, offsets)
            # a sign belongs to a number unless a word stands right before it
            sign, prior = data[np.maximum(starts - 1, 0)], data[np.maximum(starts - 2, 0)]
            row = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
            room = starts - offsets[row]
            signed = _DIGIT[data[starts]] & (room > 0) & ((sign == 45) | (sign == 43)) & ((room < 2) | ~_WORD[prior])
        else:
            signed = np.zeros(0, np.bool_)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
        self.place = np.arange(len(starts)) - bounds[self.row]
        sums = running_hash(data, LOWER)
        self.value = span_hash(sums, starts, ends)
        lead = data[starts]
        number = _DIGIT[lead]
        unit = np.isin(self.value, _unit_hashes())
        unit[1:] &= number[:-1]
        unit[:1] = False
        unit &= self.place > 0
        second = data[np.minimum(starts + 1, max(0, len(data) - 1))] if len(data) else lead
        # capital letters of Latin-1 are 0xC3 and a byte from 0x80 to 0x9E but 0x97
        name = _UPPER[lead] | ((lead == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (second != 0x97))
        name &= ~unit & ~number
        plain = np.where(number, _NUMBER, np.where(unit, _UNIT, self.value))
        own = np.where(signed, span_hash(sums, starts - signed, ends), self.value)
        kind = np.where(number, 1, np.where(unit, UNIT_KIND, 3)).astype(np.uint64)
        # a run of names is one token, which goes on while only blanks stand between
        words = np.concatenate([[0], np.cumsum(~IS_BLANK[data])])
        on = np.zeros(len(starts), np.bool_)
        on[1:] = name[1:] & name[:-1] & (self.row[1:] == self.row[:-1]) & (words[starts[1:]] == words[ends[:-1]])
        head = np.flatnonzero(~on)
        tail = np.append(head[1:], len(starts))[: len(head)] - 1
        run = own[head]
        for i in np.flatnonzero(tail > head):
            run[i] = mix(np.array([np.bitwise_xor.reduce(mix(own[head[i] : tail[i] + 1] + np.arange(tail[i] + 1 - head[i], dtype=np.uint64)))], np.uint64))[0]
        tagged = lambda x, k: (x & ~_KINDS) | k
        all_ = np.arange(len(starts))
        named = np.where(name, _NAME, plain)
        #: of each form: the token in which each of its tokens begins, tokens, slots, values of slots
        self.forms = [
            (all_, named, number | unit | name, tagged(own, kind)),
            (all_, plain, number | unit, tagged(own, kind)),
            (head, named[head], (number | unit | name)[head], tagged(run, kind[head])),
        ]
        self.rows = len(offsets) - 1

    def words(self, form: int) -> np.ndarray:
        """Tokens of each text in a form."""
        return np.bincount(self.row[self.forms[form][0]], minlength=self.rows)

    def windows(self, size: int):
        """(form, starts, tokens at starts, keys) of all windows of `size` words inside one text."""
        for form, (at, tokens, slot, _) in enumerate(self.forms):
            n = len(at) - size + 1
            if n <= 0:
                continue
            row = self.row[at]
            whole = row[size - 1 :] == row[:n]
            key = np.full(n, size * 4 + form, np.uint64)
            literal = np.zeros(n, np.int8)
            for i in range(size):
                key = key * BASE + tokens[i : i + n]
                literal += ~slot[i : i + n]
            starts = np.flatnonzero(whole & (literal >= min(LITERALS, size)))
            yield form, starts, at[starts], mix(key[starts])

    def slots(self, form: int, start: int, size: int) -> np.ndarray:
        own = slice(start, start + size)
        return self.forms[form][3][own][self.forms[form][2][own]].view(np.int64)


def _unit_hashes() -> np.ndarray:
    data = np.frombuffer("".join(UNITS).encode(), np.uint8)
    ends = np.cumsum([len(u) for u in UNITS])
    return span_hash(running_hash(data, LOWER), ends - [len(u) for u in UNITS], ends)


def _rows(ids: list, places: list, keys: list, slots: list, name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {name: pa.array(ids, pa.int64()), "place": pa.array(places, pa.int32()), "key": pa.array(keys, pa.int64()),
         "slots": pa.array(slots, pa.list_(pa.int64()))}
    )


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, size, place, key, slots) of each template window of the benchmark."""

    def run(batches):
        for batch in batches:
            ids, out = batch.column("item_id").to_pylist(), []
            for first, _, data, offsets in chunks(batch.column("text")):
                found = Templates(data, offsets)
                words = [found.words(form) for form in range(len(found.forms))]
                for size in {min(window, int(n)) for w in words for n in w if n >= SHORTEST}:
                    for form, starts, at, keys in found.windows(size):
                        for s, t, key in zip(starts, at, keys.view(np.int64), strict=True):
                            if min(window, words[form][found.row[t]]) == size:
                                out.append((ids[first + found.row[t]], size, int(found.place[t]), key, found.slots(form, s, size)))
            sizes = pa.array([x[1] for x in out], pa.int32())
            rows = _rows([x[0] for x in out], [x[2] for x in out], [x[3] for x in out], [x[4] for x in out], "item_id")
            yield rows.append_column("size", sizes)

    return benchmark.select(F.col("item_id").cast("long"), "text").mapInArrow(
        run, "item_id long, place int, key long, slots array<long>, size int"
    )


def document_windows(docs: DataFrame, table: np.ndarray, sizes: list[int]) -> DataFrame:
    """(doc_id, place, key, slots) of the template windows that pass the bit table."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        for batch in batches:
            ids, out = batch.column("doc_id").to_pylist(), []
            for first, _, data, offsets in chunks(batch.column("text")):
                found = Templates(data, offsets)
                for size in sizes:
                    for form, starts, tokens, keys in found.windows(size):
                        keys = keys.view(np.int64)
                        for at in np.flatnonzero(shared.value[bit_of(keys)]):
                            t = tokens[at]
                            out.append((ids[first + found.row[t]], int(found.place[t]), keys[at], found.slots(form, starts[at], size)))
            if out:
                yield _rows(*[[x[i] for x in out] for i in range(4)], "doc_id")

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, place int, key long, slots array<long>")


def first_places(slots: str) -> F.Column:
    """For each slot, where its value stands first, from 0; a unit's is its own."""
    return F.transform(slots, lambda v, i: F.when(v.bitwiseAND(3) == UNIT_KIND, i).otherwise((F.array_position(slots, v) - 1).cast("int")))


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, item_id, n_windows, verbatim) of documents that hold an item's windows.

    n_windows counts the item's windows found; verbatim tells that each was found with its own slot values.
    """
    items = item_windows(benchmark, window)
    sizes = [r[0] for r in items.select("size").distinct().collect()]
    found = document_windows(docs, bit_table(items.select("key")), sorted(sizes))
    items = items.select("item_id", F.col("place").alias("item_place"), "key", F.col("slots").alias("item_slots")).distinct()
    items = items.withColumn("repeats", first_places("item_slots"))
    same = found.join(items, "key").where(F.transform("repeats", lambda p: F.get("slots", p)) == F.col("slots"))
    places = same.groupBy("doc_id", "item_id", "item_place").agg(F.max(F.col("slots") == F.col("item_slots")).alias("verbatim"))
    return places.groupBy("doc_id", "item_id").agg(F.count("*").alias("n_windows"), F.min("verbatim").alias("verbatim"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs without the documents that match any item.

    Each row is judged by its id and text, so neither a repeated id nor a missing one takes a clean text along.
    """
    key = F.xxhash64("doc_id", "text")
    hits = contaminated(docs.select(key.alias("doc_id"), "text"), benchmark, window).select(F.col("doc_id").alias("_hit")).distinct()
    return docs.join(hits, key == F.col("_hit"), "left_anti")
