"""Token counts by linear greedy longest-match.

A vocabulary of word pieces (some start a word, some continue it) becomes a trie. Every
node has a failure link, the node of what is left after the longest pieces are taken off its
front, and the number of pieces popped on the way. Reading a word then takes one
step for each byte and each link, and adds up popped counts; pieces are never
built. The count is the number of pieces that greedy longest-match-first gives, or
1 if some rest of the word matches nothing (the unknown token).

All words of a batch that differ are read side by side, one byte at a time, as
array operations; repeated words are counted once and looked up. Once fewer than SIDE words
are left, each is read to its end by itself, from the node and count it has reached, so a very
long word costs one step of a loop for each byte and no array operation.

Words are runs of bytes between blanks; a run is cut before and after each ASCII
punctuation mark, which is a word itself. Null and empty texts have 0 tokens. Words of
every length are read.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from txnlake.llm.hashing import IS_BLANK, chunks, running_hash, span_hash

#: Fewer words than this are not worth array operations.
SIDE = 64
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
_BYTES = np.arange(256)
_MARK = ((_BYTES >= 33) & (_BYTES <= 47)) | ((_BYTES >= 58) & (_BYTES <= 64)) | ((_BYTES >= 91) & (_BYTES <= 96)) | ((_BYTES >= 123) & (_BYTES <= 126))
#: Counts of words that a task keeps between batches.
REMEMBERED = 1 << 18


def read_vocabulary(lines: list[str]) -> tuple[list[bytes], list[bytes]]:
    """(starting pieces, continuing pieces) from lines of base64 and rank.

    A token with a leading space starts a word, one of a single byte or without a space
    continues it; single bytes and lone marks do both.
    """
    tokens = [base64.b64decode(line.split()[0]) for line in lines if line.strip()]
    plain = [t for t in tokens if t and not IS_BLANK[list(t)].any()]
    start = {t[1:] for t in tokens if len(t) > 1 and t[:1] == b" " and not IS_BLANK[list(t[1:])].any()}
    start |= {t for t in plain if len(t) == 1}
    return sorted(start), sorted(plain)


class Automaton:
    """Trie with failure links and popped counts, as flat arrays.

    Node 0 is the root of starting pieces and node 1 that of continuing ones. The
    table of steps is sorted by node * 256 + byte. Link -1 means that the rest matches nothing.
    """

    def __init__(self, start: list[bytes], more: list[bytes]):
        steps: list[dict[int, int]] = [{}, {}]
        final = [False, False]
        for root, pieces in ((0, start), (1, more)):
            for piece in pieces:
                node = root
                for byte in piece:
                    if byte not in steps[node]:
                        steps[node][byte] = len(steps)
                        steps.append({})
                        final.append(False)
                    node = steps[node][byte]
                final[node] = node > 1
        link, popped = [-1] * len(steps), [0] * len(steps)
        queue = [0, 1]
        for node in queue:
            for byte, child in steps[node].items():
                if final[child]:
                    link[child], popped[child] = 1, 1
                else:
                    at, count = link[node], popped[node]
                    while at >= 0 and byte not in steps[at]:
                        count += popped[at]
                        at = link[at]
                    if at >= 0:
                        link[child], popped[child] = steps[at][byte], count
                queue.append(child)
        keys = np.array([n * 256 + b for n, s in enumerate(steps) for b in s] or [-1], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.next = np.array([c for s in steps for c in s.values()] or [0], np.int32)[order]
        self.link, self.popped = np.array(link, np.int32), np.array(popped, np.int32)
        self._plain: tuple[dict[int, int], list[int], list[int]] | None = None

    def _step(self, nodes: np.ndarray, bytes_: np.ndarray) -> np.ndarray:
        key = nodes.astype(np.int64) * 256 + bytes_
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.next[at], -1)

    def _read_on(self, data: bytes, node: int, count: int) -> tuple[int, int]:
        """(node, count) after the bytes of the rest of one word."""
        if self._plain is None:
            self._plain = dict(zip(self.keys.tolist(), self.next.tolist(), strict=True)), self.link.tolist(), self.popped.tolist()
        steps, link, popped = self._plain
        for byte in data:
            while (to := steps.get(node * 256 + byte)) is None:
                count += popped[node]
                node = link[node]
                if node < 0:
                    return node, count
            node = to
        return node, count

    def counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Pieces of each word: spans of data, none of them empty."""
        length = ends - starts
        order = np.argsort(-length, kind="stable")
        begin, length = starts[order], length[order]
        node, count = np.zeros(len(order), np.int32), np.zeros(len(order), np.int32)
        for i in range(int(length[0]) if len(length) else 0):
            live = np.searchsorted(-length, -i)  # words longer than i
            if live < SIDE:
                for j in np.flatnonzero(node[:live] >= 0):
                    rest = data[begin[j] + i : begin[j] + length[j]].tobytes()
                    node[j], count[j] = self._read_on(rest, int(node[j]), int(count[j]))
                break
            todo = np.flatnonzero(node[:live] >= 0)
            while len(todo):
                step = self._step(node[todo], data[begin[todo] + i])
                stuck = step < 0
                node[todo[~stuck]] = step[~stuck]
                todo = todo[stuck]
                count[todo] += self.popped[node[todo]]
                node[todo] = self.link[node[todo]]
                todo = todo[node[todo] >= 0]
        # at a word's end links are followed until nothing is left over, which is the second root
        todo = np.flatnonzero(node > 1)
        while len(todo):
            count[todo] += self.popped[node[todo]]
            node[todo] = self.link[node[todo]]
            todo = todo[node[todo] > 1]
        out = np.empty(len(order), np.int32)
        out[order] = np.where(node == 1, count, 1)
        return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of the words of a chunk."""
    inside, mark = ~IS_BLANK[data], _MARK[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | mark[1:] | mark[:-1]
    last[:-1] &= ~inside[1:] | mark[:-1] | mark[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(first)
    bounds = np.searchsorted(starts, offsets)
    return starts, np.flatnonzero(last) + 1, np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, column: str = "n_tokens") -> DataFrame:
    """docs with the number of pieces of text in one more column, which replaces any of that name."""
    docs = docs.drop(column)
    lines = [r.value for r in docs.sparkSession.read.text(vocabulary if "://" in vocabulary else f"file://{vocabulary}").collect()]
    shared = docs.sparkSession.sparkContext.broadcast(Automaton(*read_vocabulary(lines)))
    keep = np.arange(256)

    def run(batches):
        known, known_counts = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        for batch in batches:
            out = np.zeros(batch.num_rows, np.int64)
            for first, end, data, offsets in chunks(batch.column("text")):
                starts, ends, row = words(data, offsets)
                if not len(starts):
                    continue
                hashes, at, back = np.unique(span_hash(running_hash(data, keep), starts, ends), return_index=True, return_inverse=True)
                counts = np.zeros(len(hashes), np.int32)
                place = np.minimum(np.searchsorted(known, hashes), max(0, len(known) - 1))
                old = known[place] == hashes if len(known) else np.zeros(len(hashes), np.bool_)
                counts[old] = known_counts[place[old]]
                new = np.flatnonzero(~old)
                counts[new] = shared.value.counts(data, starts[at[new]], ends[at[new]])
                if len(known) < REMEMBERED and len(new):
                    known, known_counts = np.concatenate([known, hashes[new]]), np.concatenate([known_counts, counts[new]])
                    order = np.argsort(known)
                    known, known_counts = known[order], known_counts[order]
                out[first:end] = np.bincount(row, counts[back], end - first).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, column])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.LongType())]))
