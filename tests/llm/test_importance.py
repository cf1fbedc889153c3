"""Importance resampling against a plain version with zlib and dictionaries."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from txnlake.llm import importance

LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789"


def features(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def plain(docs, target, percent=25):
    s = Counter(bucket(f) for _, t in docs for f in features(t)[1])
    t = Counter(bucket(f) for x in target for f in features(x)[1])
    all_s, all_t = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000))))
    rows = []
    for i, text in docs:
        words, found = features(text)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    may = sorted([r for r in rows if r[1] >= 20], key=lambda r: (-r[4], r[0] is None, r[0] or 0, *r[1:4]))
    drawn = may[: len(may) * percent // 100]
    ranks = Counter((*r, i) for i, r in enumerate(drawn, 1))
    return ranks + Counter((*r, None) for r in may[len(drawn) :] + [r for r in rows if r[1] < 20])


def corpus():
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list(LETTERS), rng.integers(1, 9)))
    common = [word() for _ in range(50)]
    pick = lambda n: " ".join(rng.choice(common) if rng.random() < 0.7 else word() for _ in range(n))
    docs = [(i, pick(int(rng.integers(1, 120)))) for i in range(150)]
    long = "".join(rng.choice(list(LETTERS), 200))
    docs += [
        (200, None), (201, ""), (202, "!? \t\n"), (203, "one"), (204, "É Ünï-cödé 今日は ß " * 9), (205, f"{long} {long.upper()}_{long} x " * 12),
        (206, "Ab,aB;ab\x7fAB" * 10), (207, "x" * 700_000 + " y " * 20), (208, pick(40_000)), (209, " " * 600_000 + "end " * 25),
        (210, "w " * 10 + "v" * 400_000 + " u" * 10), (None, docs[0][1]), (None, pick(60)), (3, docs[3][1]), (3, docs[3][1]), (3, pick(50)), (-4, pick(40)),
    ]
    return docs, [docs[3][1], docs[5][1].upper(), None, "", pick(30)]


def test_states_and_buckets_are_crcs():
    rng = np.random.default_rng(9)
    texts = ["".join(rng.choice(list(LETTERS), n)).encode() for n in [1, 2, 3, 63, 64, 65, 300]]
    for a in texts:
        for b in texts:
            part = importance.Segment(0, np.frombuffer(a + b" " + b, np.uint8), np.array([0, len(a) + len(b) + 1]), False)
            state = importance.states(part.data, part.starts, part.ends)
            assert [int(~x) for x in state] == [zlib.crc32(a), zlib.crc32(b)]
            both = importance.joined_states(state[:1], state[1:], part.data, part.starts[1:], part.ends[1:])
            assert int(~both[0]) == zlib.crc32(a + b" " + b)


def test_segments_hold_every_word_and_pair_once(monkeypatch):
    docs, _ = corpus()
    texts = [t[:5000] if t else t for _, t in docs]
    monkeypatch.setattr(importance, "SEGMENT", 300)
    found = [Counter() for _ in texts]
    for part in importance.segments(pa.array(texts)):
        text = bytes(part.data)
        word = lambda i: text[part.starts[i] : part.ends[i]].decode()  # noqa: B023, E731
        for i in np.flatnonzero(part.own):
            found[part.first + part.row[i]][word(i)] += 1
        for i in part.pairs:
            found[part.first + part.row[i]][f"{word(i)} {word(i + 1)}"] += 1
    assert found == [Counter(features(t)[1]) for t in texts]


def test_summary_keeps_frequent_keys():
    summary = importance.Summary(10)
    for i in range(200):
        keys = np.array([1, 2, *range(1000 + 50 * i, 1050 + 50 * i)], np.uint64)
        summary.add(keys, np.where(keys < 3, 30, 1), keys.astype(np.uint32))
    keys, counts, values = summary.fold()
    assert {1, 2} <= set(keys.tolist()) and len(keys) <= 10 and (counts <= 6000).all() and (values == keys).all()


@pytest.mark.parametrize("head", [1 << 14, 4])
def test_resample_equals_plain(spark, monkeypatch, head):
    """With a large head, a head of few features and, in the corpus, features of neither."""
    docs, target = corpus()
    monkeypatch.setattr(importance.learn_head, "__defaults__", (head,))
    table = spark.createDataFrame([(*r, 1, 0.0, "s") for r in docs], "doc_id long, text string, score int, weight double, n string").repartition(3)
    bench = spark.createDataFrame([(t, 1) for t in target], "text string, bucket int")
    got = importance.resample(table, bench)
    assert Counter(tuple(r) for r in got.collect()) == plain(docs, target)
    if head == 4:
        empty = table.where("false")
        assert importance.resample(empty, bench).count() == 0
        alone = importance.resample(table, bench.where("false"))
        assert Counter(tuple(r) for r in alone.collect()) == plain(docs, [])
