import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from questlog.operators.events import events_clean
from questlog.operators.sessions import merge_spans, sessions, sessions_of_spans, spans
from questlog.session import materialise
from questlog.sources import landing_csv, sample_tables
from questlog.sources.landing_csv import EVENT_COLUMNS
from questlog.sources.snapshots import BatchTable
from questlog.streaming import jobs
from questlog.streaming.seen import SeenIds


def _row(event_id, time="2024-01-01 10:00:00", user="1", **kw):
    row = dict.fromkeys(EVENT_COLUMNS, "") | {"event_name": "app_open", "app_version": "1.0", "device_id": "d"}
    return row | {"event_id": event_id, "client_event_time": time or "", "userid": user} | kw


def _drop(folder, name, rows, columns=EVENT_COLUMNS):
    folder.mkdir(exist_ok=True)
    lines = [",".join(columns), *(",".join(r[c] for c in columns) for r in rows)]
    (folder / name).write_text("\n".join(lines) + "\n")


class Stream:
    """A landing folder and a job run on what is new in it."""

    def __init__(self, spark, tmp_path, **kw):
        self.spark, self.kw, self.landing = spark, kw, tmp_path / "landing"
        self.table, self.events, self.checkpoint = (str(tmp_path / n) for n in ("table", "events", "checkpoint"))

    def run(self, job):
        jobs.run_available(self.spark, str(self.landing), self.checkpoint, job, **self.kw)
        return BatchTable(self.spark, self.table).read()

    def everything(self):
        return events_clean(jobs.land(landing_csv.read_event_drops(self.spark, str(self.landing))))


def _same(a, b):
    return a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_load_reads_new_files_only_by_column_name(spark, tmp_path):
    stream = Stream(spark, tmp_path, files_per_batch=1)

    def load():
        rows = stream.run(jobs.append_raw(stream.table)).collect()
        return sorted((r["event_id"], r["client_event_time"]) for r in rows)

    at = "2024-01-01 10:00:00"
    _drop(stream.landing, "events_2024-01-01.csv", [_row("a"), _row("b")])
    _drop(stream.landing, "events_2024-01-02.csv", [_row("a"), _row("c")], EVENT_COLUMNS[::-1])
    assert load() == [("a", at), ("a", at), ("b", at), ("c", at)]
    assert len(load()) == 4
    _drop(stream.landing, "events_2024-01-03.csv", [_row("d")], EVENT_COLUMNS[:5])
    (stream.landing / "empty.csv").write_text("")
    assert load()[-1] == ("d", at)
    names = {r["_source_file"] for r in BatchTable(spark, stream.table).read().collect()}
    assert names == {f"events_2024-01-0{i}.csv" for i in (1, 2, 3)}


def test_rows_that_do_not_fit_fail(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    _drop(stream.landing, "events_2024-01-01.csv", [_row("a,b")])
    with pytest.raises(StreamingQueryException):
        stream.run(jobs.append_raw(stream.table))


def test_dedup_loses_nothing(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    _drop(stream.landing, "events_2024-01-09.csv", [_row("a", "2024-01-09 10:00:00")] * 2 + [_row("b", "2024-01-09 11:00:00")])
    stream.run(jobs.append_new_events(stream.table))
    # copies, a first delivery nine days late, one without a time, and a row without an id
    late = [_row("b", "2024-01-09 11:00:00"), _row("late", "2024-01-01 00:00:00"), _row("untimed", None), _row("", "2024-01-01 00:00:00")]
    _drop(stream.landing, "events_2024-01-10.csv", late)
    out = stream.run(jobs.append_new_events(stream.table))
    assert sorted(r["event_id"] or "" for r in out.collect()) == ["", "a", "b", "late", "untimed"]
    _drop(stream.landing, "events_2024-01-11.csv", late)
    out = stream.run(jobs.append_new_events(stream.table))
    assert out.count() == 5 and _same(out, stream.everything())


def test_sessions_equal_the_batch_job_after_every_run(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    drops = [
        [
            _row("a", "2024-01-01 10:00:59", rounds_completed="3.0"),
            _row("b", "2024-01-01 10:30:30"),
            _row("c", "2024-01-01 11:01:00", event_name="purchase", revenue_usd="4.99"),
            _row("n", "2024-01-01 11:01:00", user=""),
        ],
        # late: joins two sessions; a copy; another user; no time; no user
        [
            _row("d", "2024-01-01 10:45:00", platform="ios"),
            _row("c", "2024-01-01 11:01:00", event_name="purchase", revenue_usd="4.99"),
            _row("e", "2024-01-02 09:00:00", user="2"),
            _row("f", None),
            _row("g", "2024-01-01 11:20:00", user=""),
        ],
        [_row("h", "2023-12-01 00:00:00"), _row("i", None)],
    ]
    for day, rows in enumerate(drops, 1):
        _drop(stream.landing, f"events_2024-01-0{day}.csv", rows)
        stream.run(jobs.append_sessions(stream.events, stream.table))
        assert _same(jobs.latest_sessions(spark, stream.table), sessions(stream.everything()))


def _ids(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "event_id string")


def test_a_batch_opens_only_buckets_that_may_hold_its_ids(spark, tmp_path):
    known = SeenIds(spark, str(tmp_path / "ids"), buckets=16)
    for batch in range(3):
        known.add(_ids(spark, [f"{batch}-{n}" for n in range(3000)] + [None] * (batch == 1)), "event_id", batch, "s")

    def unseen(ids):
        return sorted(r["event_id"] or "" for r in known.unseen(_ids(spark, ids), "event_id").collect())

    def opened():
        parts = [p["folder"] for p in known.table.parts]
        return sorted(parts.index(path.split("/")[-2]) for path in known.opened)

    # new ids: filters alone answer, no bucket of ids is read
    new = [f"3-{n}" for n in range(200)]
    assert unseen(new) == sorted(new) and opened() == []
    # one copy of an old batch: one bucket of that batch
    assert unseen([*new, "0-17"]) == sorted(new) and opened() == [0]
    assert unseen([None, "2-5", "1-9", "other"]) == ["other"] and set(opened()) == {1, 2}
    # whole copies open every bucket of their batch, and hardly any other
    assert unseen([f"2-{n}" for n in range(3000)]) == [] and opened().count(2) == 16 and len(opened()) <= 18


def test_parts_stay_few_and_batches_count_once(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), fan_in=4)
    assert table.parts == []
    for batch in range(21):
        for attempt in range(2):
            assert table.append(spark.range(batch * 10, batch * 10 + 10), batch, "s") is (attempt == 0)
        assert len(table.parts) <= 6
    assert sorted(p["level"] for p in table.parts) == [0, 1, 2]
    assert sorted(r["id"] for r in table.read().collect()) == list(range(210))
    # folders of merged parts go, but for those of the snapshot before
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("part-")]) <= 8
    with pytest.raises(ValueError, match="another stream"):
        table.append(spark.range(1), 22, "other")


def test_reader_of_a_snapshot_survives_the_next_merge(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), fan_in=2)
    table.append(spark.range(3), 0, "s")
    reader = table.read()
    table.append(spark.range(3, 5), 1, "s")
    assert reader.count() == 3 and table.read().count() == 5 and len(table.parts) == 1


@pytest.mark.parametrize("step", ["events", "state", "ids"])
def test_batch_tried_again_after_a_crash(spark, tmp_path, monkeypatch, step):
    """Wherever the writer dies, the next run ends in the same tables."""
    stream = Stream(spark, tmp_path)
    folder = {"events": stream.events, "state": stream.table, "ids": f"{stream.events}-ids"}[step]
    _drop(stream.landing, "events_2024-01-01.csv", [_row("a"), _row("b", user="2")])
    stream.run(jobs.append_sessions(stream.events, stream.table))
    _drop(stream.landing, "events_2024-01-02.csv", [_row("b", user="2"), _row("c", "2024-01-01 10:05:00"), _row("d", None)])
    append = BatchTable.append

    def dies(self, rows, *args, **kw):
        done = append(self, rows, *args, **kw)
        if self.folder == folder:
            raise OSError("executor lost")
        return done

    with monkeypatch.context() as broken:
        broken.setattr(BatchTable, "append", dies)
        with pytest.raises(StreamingQueryException):
            stream.run(jobs.append_sessions(stream.events, stream.table))
    stream.run(jobs.append_sessions(stream.events, stream.table))
    assert _same(BatchTable(spark, stream.events).read(), stream.everything())
    assert _same(jobs.latest_sessions(spark, stream.table), sessions(stream.everything()))


def test_spans_merge_in_any_order(spark, sf_dir):
    events = materialise(events_clean(sample_tables.raw_telemetry(spark, sf_dir)), "test")
    share = F.pmod(F.xxhash64("event_id"), F.lit(3))
    one, two, three = (materialise(spans(events.where(share == n)), "test") for n in range(3))
    merged = materialise(merge_spans(merge_spans(three.unionByName(one)).unionByName(two)), "test")
    whole = materialise(sessions(events), "test")
    assert merged.count() < one.count() + two.count() + three.count()
    for parts in (merged, three.unionByName(one).unionByName(two)):
        assert _same(materialise(sessions_of_spans(parts), "test"), whole)
