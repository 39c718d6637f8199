"""Sinks and the streaming queries: replay, restart, late data, stream equals batch."""

from __future__ import annotations

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clickledger.operators.first_click import first_click_attribution
from clickledger.schemas import CHECKOUT_SCHEMA, CLICK_SCHEMA, EVENT_SCHEMA, WINNER_SCHEMA
from clickledger.sources.feeds import decode, read_stream, valid_checkouts, valid_clicks
from clickledger.sources.tables import raw_checkouts
from clickledger.streaming.attribution import (
    attributing_writer,
    current_winners,
    events_of,
    final_winners,
    pair_stream,
    read_attributed,
    settle_days,
)
from clickledger.streaming.job import parse_arguments, run
from clickledger.streaming.pipeline import (
    read_raw_checkouts,
    read_raw_clicks,
    start_attribution,
    start_pipeline,
    wait,
)
from clickledger.streaming.sinks import (
    checkpoint_run,
    compact_days,
    ensure_table,
    first_copies,
    jdbc_writer,
    keyed_writer,
    read_store,
    stored_schema,
)

ONCE = {"availableNow": True}


class Feeds:
    """Two folders of JSON lines that grow file by file, read as streams."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        for name in ("clicks", "checkouts"):
            (root / name).mkdir()
        self.files = 0

    def add(self, clicks=(), checkouts=()):
        self.files += 1
        records = {
            "clicks": [
                {"event_id": e, "user_id": u, "product_id": f"P-{e}", "timestamp": t + "Z"}
                for e, u, t in clicks
            ],
            "checkouts": [
                {"event_id": e, "user_id": u, "total_amount": 5.0, "timestamp": t + "Z"}
                for e, u, t in checkouts
            ],
        }
        for name, rows in records.items():
            path = self.root / name / f"{self.files:04d}.json"
            path.write_text("".join(json.dumps(r) + "\n" for r in rows))
            os.utime(path, (1_700_000_000 + self.files, 1_700_000_000 + self.files))

    def streams(self):
        def stream(name, schema):
            lines = read_stream(
                self.spark, "text", str(self.root / name), maxFilesPerTrigger=1
            )
            return decode(lines, schema, "value")

        return stream("clicks", CLICK_SCHEMA), stream("checkouts", CHECKOUT_SCHEMA)

    def valid_streams(self):
        clicks, checkouts = self.streams()
        return valid_clicks(clicks)[0], valid_checkouts(checkouts)[0]

    def attribute(self, **options):
        clicks, checkouts = self.valid_streams()
        query = start_attribution(
            clicks,
            checkouts,
            str(self.root / "table"),
            str(self.root / "checkpoint"),
            trigger=ONCE,
            **options,
        )
        query.awaitTermination()
        return query

    def winners(self):
        return current_winners(self.spark, str(self.root / "table"))


@pytest.fixture
def feeds(spark, tmp_path):
    return Feeds(spark, tmp_path)


def credited(df):
    return sorted((r.checkout_id, r.attributed_click_id) for r in df.collect())


def test_an_earlier_click_in_a_later_batch_moves_the_credit(feeds):
    feeds.add([("c1", "u", "2024-01-01T10:30:00")], [("k", "u", "2024-01-01T10:40:00")])
    feeds.attribute()
    assert credited(feeds.winners()) == [("k", "c1")]
    # Restarted from the checkpoint: the earlier click and a repeat of the first one arrive.
    feeds.add([("c2", "u", "2024-01-01T10:36:00"), ("c1", "u", "2024-01-01T10:30:00")])
    feeds.add([("c3", "u", "2024-01-01T10:35:30")])
    feeds.attribute()
    assert credited(feeds.winners()) == [("k", "c1")]
    feeds.add([("c0", "u", "2024-01-01T10:27:00")])
    feeds.attribute()
    assert credited(feeds.winners()) == [("k", "c0")]


def test_clicks_behind_the_watermark_are_dropped_from_the_join_only(spark, feeds, tmp_path):
    feeds.add([("c1", "u", "2024-01-01T10:30:00")], [("k1", "u", "2024-01-01T10:30:00")])
    feeds.add([("c2", "u", "2024-01-01T10:31:00")], [("k2", "u", "2024-01-01T10:31:00")])
    feeds.add([("late", "u", "2024-01-01T10:10:00"), ("bad", "u", "noon")], [])
    clicks, checkouts = feeds.streams()
    queries = start_pipeline(
        clicks, checkouts, str(tmp_path / "tables"), str(tmp_path / "cp"), trigger=ONCE
    )
    for query in queries:
        query.awaitTermination()
    assert [q.name for q in queries] == ["attribution", "clicks", "checkouts"]
    store = str(tmp_path / "tables/attributed_checkouts")
    winners = current_winners(spark, store)
    assert credited(winners) == [("k1", "c1"), ("k2", "c1")]
    stored = spark.read.parquet(str(tmp_path / "tables/raw_clicks"))
    assert sorted(r.event_id for r in stored.collect()) == ["c1", "c2", "late"]
    apart = spark.read.parquet(str(tmp_path / "tables/raw_clicks_quarantine")).collect()
    assert [(r.event_id, r.timestamp) for r in apart] == [("bad", "noonZ")]


def test_stream_equals_batch(spark, feeds):
    """Time-ordered events in several files, every fourth one delivered twice."""
    start = datetime(2024, 1, 1)

    def events(prefix, n, step):
        rows = [
            (f"{prefix}{i}", f"u{i % 7}", (start + timedelta(seconds=step * i)).isoformat())
            for i in range(n)
        ]
        return [row for i, row in enumerate(rows) for _ in range(2 if i % 4 == 0 else 1)]

    clicks, checkouts = events("c", 120, 130), events("k", 60, 260)
    for part in range(4):
        at = slice(part * len(clicks) // 4, (part + 1) * len(clicks) // 4)
        checkouts_at = slice(part * len(checkouts) // 4, (part + 1) * len(checkouts) // 4)
        feeds.add(clicks[at], checkouts[checkouts_at])
    feeds.attribute(window=timedelta(minutes=20))

    def static(name, schema):
        return decode(spark.read.text(str(feeds.root / name)), schema, "value")

    batch = first_click_attribution(
        static("clicks", CLICK_SCHEMA),
        valid_checkouts(static("checkouts", CHECKOUT_SCHEMA))[0],
        timedelta(minutes=20),
    )
    winners = feeds.winners()
    assert winners.columns == [*batch.columns, "processed_at"]
    assert winners.where("processed_at IS NULL").isEmpty()
    winners = winners.drop("processed_at")
    expected = sorted(batch.collect())
    assert len(expected) > 30 and sorted(winners.collect()) == expected

    settled = str(feeds.root / "settled")
    for _ in range(2):
        settle_days(spark, str(feeds.root / "table"), settled, ["2024-01-01"])
        assert sorted(spark.read.parquet(settled).select(*batch.columns).collect()) == expected
    for open_day in ("2024-01-01", "2024-01-02"):
        table = read_attributed(spark, str(feeds.root / "table"), settled, [open_day])
        assert sorted(table.drop("processed_at").collect()) == expected


def test_final_winner_waits_for_window_and_watermark(spark, feeds):
    feeds.add(
        [("c1", "u", "2024-01-01T10:30:00"), ("c2", "u", "2024-01-01T10:20:00")],
        [("k", "u", "2024-01-01T10:40:00")],
    )

    def emitted():
        clicks, checkouts = feeds.valid_streams()
        out = str(feeds.root / "final")
        stream = final_winners(pair_stream(clicks, checkouts))
        query = (
            stream.writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", str(feeds.root / "final-checkpoint"))
            .outputMode("append")
            .trigger(**ONCE)
            .start()
        )
        query.awaitTermination()
        return credited(spark.read.schema(stream.schema).parquet(out))

    assert emitted() == []
    # The watermark is five minutes behind the newest events of both feeds.
    feeds.add([("x1", "w", "2024-01-01T11:44:00")], [("y1", "w", "2024-01-01T11:44:00")])
    assert emitted() == []
    feeds.add([("x2", "w", "2024-01-01T11:46:00")], [("y2", "w", "2024-01-01T11:46:00")])
    assert emitted()[:1] == [("k", "c2")]


def test_job_runs_from_the_command_line_arguments(spark, feeds):
    """Twice on one checkpoint, then on a new one."""

    def job(checkpoint):
        args = [
            *["--source", "text", "--clicks", f"path={feeds.root}/clicks"],
            *["--checkouts", f"path={feeds.root}/checkouts", "--once"],
            *["--tables", f"{feeds.root}/out", "--checkpoint", f"{feeds.root}/{checkpoint}"],
        ]
        run(spark, parse_arguments(args))
        return credited(read_attributed(spark, f"{feeds.root}/out/attributed_checkouts"))

    feeds.add([("c1", "u", "2024-01-01T10:30:00")], [("k1", "u", "2024-01-01T10:40:00")])
    assert job("first") == [("k1", "c1")]
    feeds.add([("c2", "u", "2024-01-01T10:41:00")], [("k2", "u", "2024-01-01T10:42:00")])
    expected = [("k1", "c1"), ("k2", "c1")]
    assert job("first") == expected
    assert job("second") == expected
    clicks = read_raw_clicks(spark, f"{feeds.root}/out/raw_clicks")
    assert sorted(r.event_id for r in clicks.collect()) == ["c1", "c2"]
    assert read_raw_checkouts(spark, f"{feeds.root}/out/raw_checkouts").count() == 2


def test_job_appends_to_a_database_and_closes_days(spark, feeds, monkeypatch):
    """No database here: only the calls to Spark's own writer are checked."""
    calls = []

    def jdbc(self, url, table, mode=None, properties=None):
        calls.append((url, table, mode, properties))
        self.format("noop").mode("overwrite").save()

    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.jdbc", jdbc)
    feeds.add([("c1", "u", "2024-01-01T10:30:00")], [("k1", "u", "2024-01-01T10:40:00")])
    args = [
        *["--source", "text", "--clicks", f"path={feeds.root}/clicks"],
        *["--checkouts", f"path={feeds.root}/checkouts", "--once", "--database", "jdbc:some:db"],
        *["--database-options", "user=me", "--tables", f"{feeds.root}/out"],
        *["--checkpoint", f"{feeds.root}/cp"],
    ]
    run(spark, parse_arguments(args))
    tables = ["attributed_checkouts", "raw_checkouts", "raw_clicks"]
    assert sorted(calls) == [("jdbc:some:db", t, "append", {"user": "me"}) for t in tables]
    for _ in range(2):
        run(spark, parse_arguments([*args, "--close-days", "2024-01-01"]))
    store = f"{feeds.root}/out/attributed_checkouts"
    assert credited(read_attributed(spark, store, f"{feeds.root}/out/attributed_settled")) == [("k1", "c1")]
    assert read_raw_clicks(spark, f"{feeds.root}/out/raw_clicks").count() == 1


def test_waiting_ends_with_a_failed_query_and_leaves_others_alone(spark, feeds, tmp_path, monkeypatch):
    """The 30-second form, with a failing raw sink: the pipeline stops, another query runs on."""
    feeds.add([("c1", "u", "2024-01-01T10:30:00")], [("k1", "u", "2024-01-01T10:40:00")])
    other = spark.readStream.format("rate").load().writeStream.format("noop").option("checkpointLocation", str(tmp_path / "other")).start()
    clicks, checkouts = feeds.streams()

    monkeypatch.setattr("clickledger.streaming.pipeline.raw_clicks", lambda df: df.select("event_id", F.raise_error(F.lit("disk full"))))
    try:
        queries = start_pipeline(clicks, checkouts, str(tmp_path / "tables"), str(tmp_path / "cp"))
        with pytest.raises(Exception):
            wait(queries, poll_seconds=0.2)
        assert not any(query.isActive for query in queries) and other.isActive
    finally:
        other.stop()


@pytest.fixture
def checkout_store(spark, make_checkouts, tmp_path):
    root = str(tmp_path / "raw")
    schema = raw_checkouts(make_checkouts(("k", "u", "2024-01-01 10:00:00", "1"))).schema
    ensure_table(spark, root, stored_schema(schema))
    return root, schema


def test_keyed_writer_survives_replays_and_repeats(spark, make_checkouts, checkout_store):
    root, schema = checkout_store
    write = keyed_writer(root, schema, "event_id", "event_timestamp")
    k1 = ("k1", "u", "2024-01-01 23:59:00", "1")
    k2 = ("k2", "u", "2024-01-02 00:01:00", "2")
    k3 = ("k3", "v", None, "3")
    first = raw_checkouts(make_checkouts(k1, k2, k1))
    second = raw_checkouts(make_checkouts(k2, k3))

    def stored():
        rows = read_store(spark, root, schema).collect()
        return sorted((r.event_id, r.batch_id) for r in rows)

    write(first, 0)
    assert stored() == [("k1", "0"), ("k2", "0")]
    for batch_id, batch in [(1, second), (1, second), (0, first), (2, second)]:
        write(batch, batch_id)
        assert stored() == [("k1", "0"), ("k2", "0"), ("k3", "1")]
    write(first.limit(0), 3)
    assert len(stored()) == 3
    days = [(f"d{i}", "u", f"2023-{i % 12 + 1:02d}-{i // 12 + 1:02d} 10:00:00", "1") for i in range(60)]
    for batch_id in (4, 5):
        write(raw_checkouts(make_checkouts(*days)), batch_id)
        assert len(stored()) == 63


def test_copies_that_differ_are_read_once(spark, make_checkouts, checkout_store):
    """The earliest copy counts, in any order of rows and batches; a replay changes nothing."""
    root, schema = checkout_store
    write = keyed_writer(root, schema, "event_id", "event_timestamp")
    early = ("k", "u", "2024-01-01 23:00:00", "1")
    late, later = ("k", "u", "2024-01-02 01:00:00", "2"), ("k", "u", "2024-01-03 01:00:00", "3")
    write(raw_checkouts(make_checkouts(late, later)), 0)
    for rows in ((early, later), (later, early)):
        write(raw_checkouts(make_checkouts(*rows)), 1)
        assert read_store(spark, root, schema).count() == 2
    assert [str(r.total_amount) for r in read_raw_checkouts(spark, root).collect()] == ["1.00"]


def test_closed_days_are_compacted(spark, make_checkouts, checkout_store):
    root, schema = checkout_store
    write = keyed_writer(root, schema, "event_id", "event_timestamp")
    for i in range(4):
        write(raw_checkouts(make_checkouts((f"k{i}", "u", "2024-01-01 10:00:00", "1"))), i)
    before = sorted(read_raw_checkouts(spark, root).collect())
    for _ in range(2):
        compact_days(spark, root, schema, ["2024-01-01"], "event_timestamp", lambda df: first_copies(df, "event_id", "event_timestamp"))
        assert sorted(read_raw_checkouts(spark, root).collect()) == before
        assert read_store(spark, root, schema).select("batch_id").distinct().count() == 1


def test_batches_of_a_new_checkpoint_do_not_replace_earlier_ones(
    spark, make_checkouts, checkout_store, tmp_path
):
    root, schema = checkout_store
    for number, checkpoint in enumerate(["a", "b", "a"]):
        run_name = checkpoint_run(spark, str(tmp_path / checkpoint), "checkouts")
        write = keyed_writer(root, schema, "event_id", "event_timestamp", run_name)
        row = (f"k-{checkpoint}", "u", "2024-01-01 10:00:00", "1")
        write(raw_checkouts(make_checkouts(row)), 0)
        assert read_store(spark, root, schema).count() == min(number + 1, 2)


def test_stored_raw_amounts_are_exact_decimals(spark, make_checkouts, checkout_store):
    root, schema = checkout_store
    write = keyed_writer(root, schema, "event_id", "event_timestamp")
    write(raw_checkouts(make_checkouts(("k", "u", "2024-01-01 10:00:00", "0.10"))), 0)
    assert dict(read_store(spark, root, schema).dtypes)["total_amount"] == "decimal(10,2)"


def test_attributing_writer_is_idempotent_and_skips_empty_batches(spark, tmp_path):
    root = str(tmp_path / "winners")
    ensure_table(spark, root, stored_schema(WINNER_SCHEMA))
    ensure_table(spark, events_of(root), stored_schema(EVENT_SCHEMA))

    def event(kind, key, at):
        at = datetime.fromisoformat(f"2024-01-01T{at}")
        click = (at, key, "P", None, None, None, None) if kind == "click" else None
        return ("u", at, click, None if click else (key, None))

    def batch(*events):
        return spark.createDataFrame([event(*e) for e in events], EVENT_SCHEMA)

    write = attributing_writer(root)
    first = batch(("click", "c2", "09:50:00"), ("checkout", "k", "10:00:00"), ("checkout", "m", "12:00:00"))
    second = batch(("click", "c1", "09:40:00"), ("click", "c3", "09:55:00"))
    for rows, batch_id in [(first, 0), (first, 0), (second, 1), (second, 1), (first.limit(0), 2)]:
        write(rows, batch_id)
    assert credited(current_winners(spark, root)) == [("k", "c1")]
    assert sorted(r.batch_id for r in read_store(spark, root, WINNER_SCHEMA).collect()) == ["0", "1"]


def test_a_failing_sink_ends_the_query(feeds, monkeypatch):
    feeds.add([("c1", "u", "2024-01-01T10:30:00")], [("k", "u", "2024-01-01T10:40:00")])

    def broken(*_):
        raise RuntimeError("disk full")

    monkeypatch.setattr("clickledger.streaming.sinks._write_batch", broken)
    with pytest.raises(Exception, match="disk full"):
        feeds.attribute()
    monkeypatch.undo()
    feeds.attribute()
    assert credited(feeds.winners()) == [("k", "c1")]


def test_jdbc_writer_skips_empty_batches(spark, monkeypatch):
    """No database here: only the call to Spark's own writer is checked."""
    calls = []

    def jdbc(self, url, table, mode=None, properties=None):
        calls.append((url, table, mode, properties))
        self.format("noop").mode("overwrite").save()

    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.jdbc", jdbc)
    write = jdbc_writer("jdbc:some:db", "raw_clicks", {"user": "me"})
    write(spark.range(0), 0)
    assert calls == []
    write(spark.range(3), 1)
    assert calls == [("jdbc:some:db", "raw_clicks", "append", {"user": "me"})]
