import json
import subprocess
import sys
from pathlib import Path

from helpers import raw_rows, utc

from txnlake.sources import landing as L
from txnlake.sources import tables as T


def rows(spark, *numbers):
    return raw_rows(spark, *[{"transaction_id": f"pay-{n:08}", "user_id": n + 1} for n in numbers])


def seen(spark, root, *numbers):
    ids = spark.createDataFrame([(f"pay-{n:08}",) for n in numbers], "transaction_id string")
    known = L.seen_before(spark, root, ids)
    return sorted(int(r[0][4:]) for r in ids.join(known, "transaction_id", "left_semi").collect())


def test_landings_are_numbered_and_counted(spark, root):
    assert L.land(rows(spark, 1, 2), root, "s", 0, attempted=5, rejected=3) == 2
    assert L.land(rows(spark), root, "s", 1, attempted=2, rejected=0) == 0
    assert L.land(rows(spark, 3), root) == 1
    log = sorted((r.landed, r.attempted, r.inserted, r.rejected) for r in L.landing_log(spark, root).collect())
    assert log == [(1, 5, 2, 3), (2, 2, 0, 0), (3, 1, 1, 0)]
    # a batch that runs again is the same landing, also if another has landed since
    assert L.land(rows(spark, 4), root, "s", 1, attempted=3, rejected=1) == 1
    assert tuple(L.totals(spark, root).first()) == (9, 4, 4)
    assert {r.transaction_id: r.landed for r in T.read_table(spark, root, L.RAW).collect()} == {
        "pay-00000001": 1, "pay-00000002": 1, "pay-00000003": 3, "pay-00000004": 2,
    }
    last = L.landing_log(spark, root).agg({"last_ingested": "max"}).first()[0]
    assert last.timestamp() == utc(2026, 5, 1, 11).timestamp()


def test_ids_are_found_in_levels_and_since_the_last_fold(spark, root, monkeypatch):
    monkeypatch.setattr(L, "FOLD_LANDINGS", 2)
    for i in range(7):
        L.land(rows(spark, 10 * i, 10 * i + 1), root, "s", i)
    versions = T.current_versions(spark, root)
    used = [name for name in T.SEEN_LEVELS if name in versions and versions[name].last_loaded > T.EPOCH]
    # three folds are one run of one fold and one of two
    assert used == ["seen_ids_0", "seen_ids_1"] and versions["seen_ids"].version == 6
    assert [T.read_table(spark, root, name).count() for name in used] == [4, 8]
    assert seen(spark, root, 0, 1, 2, 31, 60, 61, 99) == [0, 1, 31, 60, 61]
    monkeypatch.setattr(L, "PUSHED_IDS", 3)
    assert seen(spark, root, *range(70)) == sorted(10 * i + k for i in range(7) for k in (0, 1))
    # the batch that folded last runs again: it is still the same landing
    L.land(rows(spark), root, "s", 5)
    assert L.landing_log(spark, root).count() == 7


READ = """
import json, sys
sys.path[:0] = sys.argv[4:]
from txnlake.session import local_session
from txnlake.sources import landing as L
from pyspark.sql import functions as F
from helpers import raw_rows
root, events, size = sys.argv[1], sys.argv[2], int(sys.argv[3])
spark = local_session(2, "2g", **{"spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + events, "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
one = raw_rows(spark, {}).drop("transaction_id")
ids = spark.range(size).select(F.md5(F.col("id").cast("string")).alias("transaction_id"))
L.land(ids.join(one).select(*raw_rows(spark, {}).columns), root)
L.fold_seen(spark, root)
asked = spark.createDataFrame([(str(n),) for n in range(0, size, size // 20)], "n string").select(F.md5("n").alias("transaction_id"))
spark.sparkContext.setJobDescription("look-up")
assert L.seen_before(spark, root, asked).join(asked, "transaction_id", "left_semi").count() == 20
spark.stop()
"""


def rows_read(tmp_path, size):
    """Rows that tasks of a look-up of 20 ids read, from the event log."""
    events = tmp_path / f"events{size}"
    events.mkdir()
    paths = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]
    subprocess.run(
        [sys.executable, "-c", READ, str(tmp_path / f"root{size}"), str(events), str(size), *paths], check=True, capture_output=True, timeout=300
    )
    jobs, read = set(), 0
    for line in next(events.iterdir()).read_text().splitlines():
        event = json.loads(line)
        if event["Event"] == "SparkListenerJobStart" and event["Properties"].get("spark.job.description") == "look-up":
            jobs |= {s["Stage ID"] for s in event["Stage Infos"]}
        if event["Event"] == "SparkListenerTaskEnd" and event["Stage ID"] in jobs:
            read += event["Task Metrics"]["Input Metrics"]["Records Read"]
    return read


def test_a_look_up_reads_as_much_of_a_history_ten_times_as_long(spark, tmp_path):
    short, long = rows_read(tmp_path, 100_000), rows_read(tmp_path, 1_000_000)
    assert long < 1.5 * short and long < 60_000
