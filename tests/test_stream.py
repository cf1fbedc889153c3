import json
from pathlib import Path

import pytest
from helpers import as_set, message, messages
from pyspark.sql import functions as F

from txnlake.sources import landing as L
from txnlake.sources import tables as T
from txnlake.sources.events import publish_events, read_events
from txnlake.streaming import ingest as I

ONCE = {"availableNow": True}


def run(spark, source, root, seen=None, checkpoint="cp", **options):
    stream = read_events(spark, "json", path=source)
    on_batch = None if seen is None else lambda batch, counts: seen.append(counts)
    query = I.ingest(stream, root, f"{root}/{checkpoint}", ONCE, on_batch, **options)
    query.awaitTermination()


def send(spark, source, *bodies):
    messages(spark, *bodies).select(F.lit("k").alias("key"), "value").coalesce(1).write.mode(
        "append"
    ).json(source)


def stored(spark, root):
    return {
        r.transaction_id: str(r.amount)
        for r in T.read_table(spark, root, "raw_transactions").collect()
    }


@pytest.fixture
def source(tmp_path):
    return str(tmp_path / "source")


def test_stream_lands_good_events_once_and_sets_bad_ones_aside(spark, root, source):
    seen = []
    send(spark, source, message(), message(amount="1.00", transaction_id="pay-00000002"), "junk",
         message(transaction_id="pay-00000003", currency="ZZZ"))
    run(spark, source, root, seen)
    assert stored(spark, root) == {"pay-00000001": "18.60", "pay-00000002": "1.00"}
    assert seen == [{"attempted": 2, "inserted": 2, "rejected": 2}]
    aside = T.read_table(spark, root, "rejected_events").select(F.array_join("reasons", ","))
    assert as_set(aside) == {("json",), ("unknown_currency",)}

    # A later file repeats an id with another amount and adds a new one.
    send(spark, source, message(amount="99.00"), message(transaction_id="pay-00000004"))
    run(spark, source, root, seen)
    assert stored(spark, root)["pay-00000001"] == "18.60" and len(stored(spark, root)) == 3
    assert seen[-1] == {"attempted": 2, "inserted": 1, "rejected": 0}
    run(spark, source, root, seen)
    assert len(seen) == 2


def test_rejects_lie_in_one_folder_a_day(spark, root, source):
    for i in range(4):
        send(spark, source, "junk", "junk", message(currency="ZZZ", transaction_id=f"pay-{i:08}"))
        run(spark, source, root)
    kept = T.read_table(spark, root, "rejected_events")
    assert kept.count() == 12 and kept.select("stream", "batch").distinct().count() == 4
    assert kept.select("rejected_on").distinct().count() <= 2
    assert len(list(Path(root, "rejected_events").glob("rejected_on=*/*.parquet"))) <= 2 * 4
    # the same batch again, after an attempt that stored a part of it
    I.write_batch(spark, messages(spark, "a", "a", "b"), root, "load", 7)
    I.write_batch(spark, messages(spark, "a", "a", "b", "b", "c"), root, "load", 7)
    mine = [r.value for r in T.read_table(spark, root, "rejected_events").where("batch = 7").collect()]
    assert sorted(mine) == ["a", "a", "b", "b", "c"]


def test_replay_from_the_start_adds_nothing(spark, root, source):
    send(spark, source, message(), message(transaction_id="pay-00000002"))
    run(spark, source, root)
    run(spark, source, root, checkpoint="other")
    assert T.read_table(spark, root, "raw_transactions").count() == 2


@pytest.mark.parametrize("table", ["raw_transactions", "landings"])
def test_batch_that_fails_after_its_write_is_safe_to_run_again(spark, root, source, monkeypatch, table):
    send(spark, source, message(), message(transaction_id="pay-00000002"), "junk")
    real = L.append_rows

    def write_then_die(rows, root, name):
        real(rows, root, name)
        if name == table:
            raise RuntimeError("lost")

    monkeypatch.setattr(L, "append_rows", write_then_die)
    with pytest.raises(Exception, match="lost"):
        run(spark, source, root)
    monkeypatch.setattr(L, "append_rows", real)
    run(spark, source, root)
    assert T.read_table(spark, root, "raw_transactions").count() == 2
    assert T.read_table(spark, root, "rejected_events").count() == 1
    # one landing, counted with the rows of both attempts
    assert [(r.landed, r.attempted, r.inserted, r.rejected) for r in L.landing_log(spark, root).collect()] == [(1, 2, 2, 1)]
    assert tuple(L.totals(spark, root).first()) == (2, 2, 1)


def test_stream_equals_one_load(spark, root, source):
    bodies = [message(transaction_id=f"pay-{i % 7:08}", amount=str(i + 1)) for i in range(20)]
    for part in (bodies[:9], bodies[9:]):
        send(spark, source, *part)
        run(spark, source, f"{root}/s")
    for n, part in enumerate((bodies[:9], bodies[9:])):
        I.write_batch(spark, messages(spark, *part), f"{root}/b", "load", n)
    assert stored(spark, f"{root}/s") == stored(spark, f"{root}/b")
    assert len(stored(spark, f"{root}/s")) == 7


def test_kafka_arrival_order_decides_between_copies(spark, root):
    df = spark.createDataFrame(
        [(message(amount="2.00"), 0, 11), (message(amount="1.00"), 0, 12), (message(amount="3.00"), 0, 10)],
        "value string, partition int, offset bigint",
    )
    I.write_batch(spark, df, root, "load", 0)
    assert stored(spark, root) == {"pay-00000001": "3.00"}


def test_published_events_come_back(spark, root, source, tmp_path):
    from txnlake.sources.events import decode_events

    publish_events(decode_events(messages(spark, message())), "json", path=source)
    line = json.loads(spark.read.text(source).first()[0])
    assert line["key"] == "311" and json.loads(line["value"])["amount"].startswith("18.60")
    run(spark, source, root)
    assert stored(spark, root) == {"pay-00000001": "18.60"}


def test_ids_remembered_in_state(spark, root, source, monkeypatch):
    seen = []
    send(spark, source, message(), message(transaction_id="pay-00000002"), "junk", "junk")
    run(spark, source, root, seen, remember="state")
    assert seen == [{"attempted": 2, "inserted": 2, "rejected": 2}]
    assert T.read_table(spark, root, "rejected_events").count() == 2

    # A batch that fails after its write is run again from the same state.
    send(spark, source, message(amount="99.00"), message(transaction_id="pay-00000003"))
    real = L.append_rows

    def write_then_die(*args):
        real(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(L, "append_rows", write_then_die)
    with pytest.raises(Exception, match="lost"):
        run(spark, source, root, remember="state")
    monkeypatch.setattr(L, "append_rows", real)
    run(spark, source, root, remember="state")
    assert stored(spark, root)["pay-00000001"] == "18.60"
    assert T.read_table(spark, root, "raw_transactions").count() == 3

    # What the table no longer holds, the state still knows.
    send(spark, source, message(transaction_id="pay-00000003"))
    run(spark, source, f"{root}", remember="state")
    assert T.read_table(spark, root, "raw_transactions").count() == 3


def test_state_is_exact_whatever_the_clock(spark, root, source):
    from datetime import datetime, timezone

    long_ago = datetime(2020, 1, 1, tzinfo=timezone.utc)
    send(spark, source, message())
    run(spark, source, root, remember="state", now=long_ago)
    send(spark, source, message())
    run(spark, source, root, remember="state", now=long_ago)
    assert T.read_table(spark, root, "raw_transactions").count() == 1


@pytest.mark.parametrize("remember", ["table", "state"])
def test_new_checkpoint_over_old_rows_and_replay_with_recorded_time(spark, root, source, remember):
    from datetime import datetime, timezone

    long_ago = datetime(2020, 1, 1, tzinfo=timezone.utc)
    send(spark, source, message(), message(transaction_id="pay-00000002"), "junk")
    run(spark, source, root, remember=remember, now=long_ago)
    run(spark, source, root, remember=remember, checkpoint="new")
    assert T.read_table(spark, root, "raw_transactions").count() == 2
    assert T.read_table(spark, root, "rejected_events").count() == 2  # one per checkpoint
    for _ in range(2):
        I.write_batch(spark, messages(spark, message()), root, "load", 0, now=long_ago)
    assert T.read_table(spark, root, "raw_transactions").count() == 2


def test_held_reader_survives_later_publishes(spark, root):
    from txnlake.sources.tables import Version

    for version in range(1, 8):
        T.write_version(spark.createDataFrame([], T.REPLACED["dim_user"]), root, "dim_user", version)
        T.publish(spark, root, {"dim_user": Version(version, T.EPOCH)})
        if version == 1:
            held = T.read_table(spark, root, "dim_user")
    assert held.count() == 0


def test_remember_is_checked(spark, root, source):
    send(spark, source, message())
    with pytest.raises(ValueError):
        run(spark, source, root, remember="memory")


@pytest.mark.parametrize("remember", ["table", "state"])
def test_a_batch_is_staged_in_files_and_nothing_is_cached(spark, root, source, monkeypatch, remember):
    from pyspark.sql.classic.dataframe import DataFrame

    def no_cache(*_):
        raise AssertionError("rows were cached")

    monkeypatch.setattr(DataFrame, "persist", no_cache)
    monkeypatch.setattr(DataFrame, "cache", no_cache)
    seen = []
    for part in ([message(), message(amount="1.00"), "junk", "junk"], [message(amount="5.00"), message(transaction_id="pay-00000002")]):
        send(spark, source, *part)
        run(spark, source, root, seen, remember=remember)
    assert seen == [{"attempted": 2, "inserted": 1, "rejected": 2}, {"attempted": 2, "inserted": 1, "rejected": 0}]
    assert stored(spark, root) == {"pay-00000001": "1.00", "pay-00000002": "18.60"}
    assert [r.value for r in T.read_table(spark, root, "rejected_events").collect()] == ["junk", "junk"]
    # one folder for the stream, emptied once the batch has landed
    staging = list(Path(root, "_staging").iterdir())
    assert len(staging) == 1 and spark.read.parquet(str(staging[0])).count() == 0


def test_messages_in_enough_partitions_are_not_dealt_anew(spark):
    many = spark.range(0, 100, 1, 6)
    assert I._spread(many, 6) is many and I._spread(many, None) is many
    assert I._spread(many, 7).rdd.getNumPartitions() == 7


def test_ids_in_state_lie_on_disk_whatever_the_session_says(spark, root, source):
    provider, bound = (f"spark.sql.streaming.stateStore.{k}" for k in ("providerClass", "rocksdb.boundedMemoryUsage"))
    before = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        send(spark, source, message())
        run(spark, source, root, remember="state")
        used = Path(root, "cp", "offsets", "0").read_text()
        assert "RocksDBStateStoreProvider" in used and "HDFSBacked" not in used
        assert spark.conf.get(bound) == "true"
    finally:
        spark.conf.set(provider, before)


def test_a_stream_in_state_mode_decodes_each_message_once(spark, root, source, capsys):
    send(spark, source, message(), message(amount="2.00"), message(transaction_id="pay-00000002"), "junk", message(currency="ZZZ"))
    seen = []
    query = I.ingest(read_events(spark, "json", path=source), root, f"{root}/cp", ONCE, lambda _, counts: seen.append(counts), remember="state")
    query.awaitTermination()
    assert seen == [{"attempted": 3, "inserted": 2, "rejected": 2}]
    capsys.readouterr()
    query.explain()
    assert capsys.readouterr().out.count("VariantExpressionEvalUtils.parseJson") == 1


@pytest.mark.parametrize("remember", ["table", "state"])
def test_a_large_batch_lands_slice_by_slice(spark, root, source, monkeypatch, remember):
    parts, real = [], I.land

    def land(rows, *args):
        parts.append(len(rows))
        return real(rows, *args)

    monkeypatch.setattr(I, "land", land)
    monkeypatch.setattr(I, "SLICE_ROWS", 4)
    bodies = [message(transaction_id=f"pay-{i % 30:08}", amount=str(100 - i)) for i in range(60)]
    seen = []
    for part in ([*bodies[:50], "junk"], [*bodies, *bodies[:3]]):
        send(spark, source, *part)
        run(spark, source, root, seen, remember=remember)
    # of copies in a batch the first by value: "100" before "70", "99" after "69"
    first = {f"pay-{i:08}": str(min(str(100 - i), str(70 - i)) if i < 20 else 100 - i) + ".00" for i in range(30)}
    assert stored(spark, root) == first
    assert seen == [{"attempted": 50, "inserted": 30, "rejected": 1}, {"attempted": 63, "inserted": 0, "rejected": 0}]
    # the second batch has no new id, so nothing of it is shuffled whole
    assert parts[0] > 4 and parts[1] == 1
    assert [(r.landed, r.inserted) for r in L.landing_log(spark, root).orderBy("landed").collect()] == [(1, 30), (2, 0)]


def test_a_stream_in_state_mode_shuffles_no_whole_rows(spark, root, source, monkeypatch, capsys):
    staged, real = [], I._staged
    monkeypatch.setattr(I, "_staged", lambda *args: staged.append(1) or real(*args))
    send(spark, source, message(), message(amount="2.00"), "junk")
    query = I.ingest(read_events(spark, "json", path=source), root, f"{root}/cp", ONCE, remember="state")
    query.awaitTermination()
    capsys.readouterr()
    query.explain()
    exchanges = [x for x in capsys.readouterr().out.splitlines() if "Exchange hashpartitioning" in x]
    assert exchanges and not any("merchant" in x or "value#" in x for x in exchanges)
    # what has landed is decoded to whole rows for no second checkpoint
    assert staged == [1]
    run(spark, source, root, checkpoint="other", remember="state")
    assert staged == [1] and stored(spark, root) == {"pay-00000001": "18.60"}
    assert T.read_table(spark, root, "rejected_events").count() == 2


def test_a_batch_leaves_no_shuffle_files(spark, root, source):
    import time

    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {b for b in blocks.getAllBlocks().mkString(" ").split() if b.startswith("shuffle_")}
    send(spark, source, *[message(transaction_id=f"pay-{i:08}") for i in range(20)])
    before = held()
    run(spark, source, root)
    end = time.time() + 20
    while held() - before and time.time() < end:
        time.sleep(0.2)
    assert not held() - before and len(stored(spark, root)) == 20
