"""The filter audit against counting every order one document at a time."""

import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from txnlake.llm import audit

FIELDS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def fails(text, filters="ABCD"):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    tests = {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
        "D": re.search(r"[#$%&*|]", text) is not None,
    }
    return {f for f in filters if tests[f]}


def brute_force(docs, labels):
    texts = [(i, t or "", part or "") for i, t, part in docs]
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, bad in labels if bad == 1 and i is not None}
    rows = []
    for i, t, part in texts:
        copy = i is not None and any(j is not None and j < i and u == t for j, u, _ in texts)
        rows.append((part, fails(t) | ({"E"} if copy else set()), i in good, i in toxic))
    out, shapley = {}, Counter()
    for part in {r[0] for r in rows}:
        for order in permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            everyone = left
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[part, f] += len(gone)
                failing = [r for r in everyone if f in r[1]]
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(failing) - len(gone), sum(r[1] == {f} for r in everyone), sum(r[2] for r in gone), sum(r[3] for r in gone)
                ]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def many(n, start="w"):
    return " ".join(f"{start}{i}" for i in range(n))


DOCS = [
    (1, many(300), "en"), (2, many(300), "en"), (2, many(300), "en"), (3, many(150), "de"), (4, "a b " * 120, "en"), (5, many(300).upper(), "de"),
    (6, many(300) + " #", "en"), (7, None, None), (8, "", ""), (9, None, "en"), (None, many(300), "en"), (None, many(300), "en"), (None, many(30), None),
    (10, many(199), "en"), (11, many(200), "en"), (12, "  \x0b é A", "en"), (13, "x" * 300_000 + " " + many(40_000), "de"), (1, many(250, "z"), "en"),
    (14, many(250, "z"), "de"), (15, "ABC " + "d" * 96 + many(300), "fr"), (16, "a b " * 120 + "#", "en"), (17, many(199).upper() + "|", "en"), (-5, many(200), "fr"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (3, 0, 1), (4, 1, 1), (5, None, 1), (6, 1, None), (None, 1, 1), (9, 0, 0), (9, 1, 0), (17, 1, 1), (99, 1, 1)]


def test_lattice_counts_paths():
    for n in range(1, 6):
        uses = Counter((state, f) for _, _, state, f in audit.paths(n))
        assert {(s, f): orders for s, f, _, orders in audit.lattice(n)} == uses


def test_audit_equals_brute_force(spark):
    schema = "doc_id long, text string, lang string, mask string, n int, digest string"
    docs = spark.createDataFrame([(*r, "x", 1, "d") for r in DOCS], schema).repartition(3)
    labels = spark.createDataFrame([(*r, "y") for r in LABELS], "doc_id long, quality int, toxic int, part string")
    got = audit.audit(audit.failure_counts(docs, labels))
    rows = {(r.part, r.filter_order, r.step): tuple(r[c] for c in FIELDS) for r in got.collect()}
    assert rows == brute_force(DOCS, LABELS)
    empty = docs.where("false")
    assert audit.audit(audit.failure_counts(empty, labels)).count() == 0
    bare = audit.audit(audit.failure_counts(docs, labels.where("false"))).agg(F.sum("good_lost"), F.sum("toxic_lost")).first()
    assert tuple(bare) == (0, 0)


def test_audit_of_other_filters(spark):
    counts = spark.createDataFrame([("p", 0b011, 4, 1, 0), ("p", 0b100, 2, 0, 0), ("p", 0, 1, 1, 1)], "part string, mask int, n long, good long, toxic long")
    got = {(r.filter_order, r.step): r for r in audit.audit(counts, "xyz").collect()}
    assert len(got) == 18 and got["xyz", 1].removed == 4 and got["xyz", 2].redundant == 4 and got["zyx", 1].kept == 5
    assert {got["xyz", i].shapley for i in (1, 2)} == {12} and got["xyz", 3].unique_fails == 2
    with pytest.raises(ValueError, match="at most"):
        audit.audit(counts, "abcdefghi")
