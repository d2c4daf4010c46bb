"""Marks table, admission in name order, and the stateful filter, against a plain replay file by file."""

import datetime as dt
import json
import random
from time import perf_counter

import pytest
from pyspark.sql import functions as F

from flowtide import schemas
from flowtide.operators.history import high_water_mark
from flowtide.sources import files, ingest, marks, sinks
from flowtide.streaming import ingest as stream

AT = dt.datetime(2026, 6, 14, 5, tzinfo=dt.timezone.utc)
LONG = schemas.TICKET_HISTORY["id"].dataType
NAMES = ["tickets_backfill_2026.json"] + [f"tickets_snapshot_202606{d:02}T001500Z.json" for d in range(1, 8)]


def put(root, name, rows):
    root.mkdir(parents=True, exist_ok=True)
    (root / name).write_text(json.dumps(rows))


def ticket(i, at, status=2):
    return {"id": i, "subject": "s", "status": status, "updated_at": at, "group_id": 2**60 + 1 if i else None}


def feed(seed=1):
    """Rows per file: few ids and times, so most of what may happen does; one id in every file many times."""
    rng = random.Random(seed)
    pick = lambda: ticket(rng.choice([1, 2, 3, 4, None]), rng.choice([None, "", *"abcdef"]), rng.randint(2, 17))
    return {n: [pick() for _ in range(rng.randint(1, 9))] + [ticket(9, rng.choice("abcdef")) for _ in range(8)] for n in NAMES}


def replayed(rows_of):
    """What is kept when files are loaded one by one, in this order."""
    known, kept = {}, []
    for name, rows in rows_of:
        fresh = []
        for r in rows:
            time = r["updated_at"] or ""
            if "_snapshot_" not in name or r["id"] not in known or time > known[r["id"]]:
                fresh.append(r)
        kept += [(name, r["id"], r["updated_at"] or "", r["status"]) for r in fresh]
        for r in rows:
            if r["id"] is not None:
                known[r["id"]] = max(known.get(r["id"], ""), r["updated_at"] or "")
    return sorted(kept, key=repr)


def stored(spark, root):
    rows = sinks.read_or_empty(spark, str(root / "history"), sinks.history_schema(schemas.TICKET_HISTORY)).collect()
    return sorted(((r._snapshot_file, r.id, r.updated_at or "", r.status) for r in rows), key=repr)


def load(spark, root, **options):
    return ingest.load_files(spark, ingest.TICKETS, str(root / "raw"), str(root / "history"), str(root / "log"), AT, **options)


def table(spark, root):
    return marks.Marks(spark, str(root / "history_marks"), LONG)


@pytest.mark.parametrize("most", [1, 3, 500])
def test_loads_equal_a_replay_file_by_file(spark, tmp_path, most):
    rows = feed()
    for some in (NAMES[:2], NAMES[2:3], NAMES[3:]):
        for n in some:
            put(tmp_path / "raw", n, rows[n])
        assert load(spark, tmp_path, most=most) == len(some)
    assert stored(spark, tmp_path) == replayed((n, rows[n]) for n in NAMES)


def test_only_buckets_of_the_batch_are_read_and_no_history(spark, tmp_path):
    rows = spark.range(1000).select("id", F.lit("b").alias("updated_at"), F.lit("f").alias("_source_file"))
    empty = marks.Marks(spark, str(tmp_path / "marks"), LONG, buckets=16)
    found = marks.known(rows.limit(1), ["g"], rows, ["f"], empty)
    assert "FileScan" not in found._jdf.queryExecution().executedPlan().toString() or len(found.inputFiles()) == 1
    again = marks.Marks(spark, str(tmp_path / "marks"), LONG)
    assert again.of == 16 and again.folded == {"f"} and len(again.builds) == 16
    one = marks.known(rows.filter("id = 7"), ["g"], None, ["f"], again)
    assert all("/bucket=" in f for f in one.inputFiles()) and len({f.split("/bucket=")[1][:2] for f in one.inputFiles()}) == 1
    assert one.filter("id = 7").first().high_water == "b" and one.count() < 200


def test_a_fold_touches_its_buckets_only_and_old_builds_go(spark, tmp_path):
    t = marks.Marks(spark, str(tmp_path / "m"), LONG, buckets=8)
    rows = lambda ids, at: spark.createDataFrame([(i, at) for i in ids], "id long, updated_at string")
    t = t.fold(rows(range(100), "c"), ["a"])
    first = dict(t.builds)
    t = t.fold(rows([5], "d"), ["b"]).fold(rows([6, None], "b"), ["c"]).fold(rows([], "b"), ["d"])
    assert sum(t.builds[b] == first[b] for b in first) >= 6 and t.folded == {"a", "b", "c", "d"}
    want = {i: "d" if i == 5 else "c" for i in range(100)}
    assert {r.id: r.high_water for r in t.read().collect()} == want
    assert t.drop_old_builds() in (0, 1, 2)
    assert {r.id: r.high_water for r in marks.Marks(spark, str(tmp_path / "m"), LONG).read().collect()} == want


def test_marks_after_a_crash_and_a_repeat(spark, tmp_path, monkeypatch):
    rows = feed(3)
    put(tmp_path / "raw", NAMES[0], rows[NAMES[0]])
    put(tmp_path / "raw", NAMES[1], rows[NAMES[1]])
    load(spark, tmp_path)
    put(tmp_path / "raw", NAMES[2], rows[NAMES[2]])

    def stop(*_):
        raise RuntimeError("stopped")

    # Once before the log entry, once before the manifest row of the marks.
    with monkeypatch.context() as m:
        m.setattr(sinks, "log_import", stop)
        with pytest.raises(RuntimeError):
            load(spark, tmp_path)
    assert table(spark, tmp_path).folded == set(NAMES[:2])
    load(spark, tmp_path)
    put(tmp_path / "raw", NAMES[3], rows[NAMES[3]])
    with monkeypatch.context() as m:
        m.setattr(marks.SparkSession, "createDataFrame", stop)
        with pytest.raises(RuntimeError):
            load(spark, tmp_path)
    assert table(spark, tmp_path).folded == set(NAMES[:2])
    load(spark, tmp_path)
    assert table(spark, tmp_path).folded == set(NAMES[:3])
    assert stored(spark, tmp_path) == replayed((n, rows[n]) for n in NAMES[:4])
    t = table(spark, tmp_path)
    schema = sinks.history_schema(schemas.TICKET_HISTORY)
    history = sinks.read_or_empty(spark, str(tmp_path / "history"), schema).filter(F.col("_source_file").isin(NAMES[:3]))
    assert sorted(t.read().collect()) == sorted(high_water_mark(history.filter("id IS NOT NULL")).collect())


def run_stream(spark, root, max_files=None, **options):
    rows = stream.ingest_stream(spark, ingest.TICKETS, str(root / "raw"), max_files=max_files)
    stream.write_history(rows, ingest.TICKETS, str(root / "history"), str(root / "log"), str(root / "cp"), AT,
                         **options).awaitTermination()


@pytest.mark.parametrize("max_files, most", [(1, 1), (3, 2), (None, 500)])
def test_stream_does_not_depend_on_bounds_or_landing_order(spark, tmp_path, max_files, most):
    rows = feed(5)
    order = list(NAMES)
    random.Random(max_files).shuffle(order)
    for n in order:
        put(tmp_path / "raw", n, rows[n])
    run_stream(spark, tmp_path, max_files, most=most)
    assert stored(spark, tmp_path) == replayed((n, rows[n]) for n in NAMES)
    assert files.children(spark, str(tmp_path / "cp_landing")) == []


def test_late_part_of_a_snapshot_already_folded(spark, tmp_path):
    folder = tmp_path / "raw" / NAMES[1]
    put(folder, "part-0.json", [ticket(1, "c")])
    run_stream(spark, tmp_path)
    put(tmp_path / "raw", NAMES[2], [ticket(1, "b"), ticket(2, "b")])
    run_stream(spark, tmp_path)
    assert table(spark, tmp_path).folded == {NAMES[1]}
    put(folder, "part-1.json", [ticket(1, "b"), ticket(2, "a"), ticket(3, "a")])
    run_stream(spark, tmp_path)
    # Other parts of its own snapshot do not outdate it, the rows of the other one do.
    assert stored(spark, tmp_path) == [(NAMES[1], 1, "b", 2), (NAMES[1], 1, "c", 2), (NAMES[1], 3, "a", 2), (NAMES[2], 2, "b", 2)]


def test_landed_rows_wait_for_the_next_run(spark, tmp_path):
    put(tmp_path / "raw", NAMES[1], [ticket(1, "b")])
    rows = stream.ingest_stream(spark, ingest.TICKETS, str(tmp_path / "raw"))
    run = stream.write_history(rows, ingest.TICKETS, str(tmp_path / "history"), str(tmp_path / "log"), str(tmp_path / "cp"), AT)
    run.query.awaitTermination()
    assert stored(spark, tmp_path) == []
    run_stream(spark, tmp_path)
    assert stored(spark, tmp_path) == [(NAMES[1], 1, "b", 2)]


def test_a_key_of_very_many_files_is_judged_in_one_pass():
    rng = random.Random(3)
    rows = [(f"tickets_{rng.choice(['backfill', 'snapshot'])}_{i:06}.json", rng.choice(["", *"abcdef"]) + f"{i:06}")
            for i in range(30_000)]
    given = [(name, time, "snapshot" in name, i) for i, (name, time) in enumerate(rows)]
    order = sorted(given, key=lambda r: r[0])
    state, kept, expected, begin = (None, None, None), [], set(), perf_counter()
    for part in (order[:10_000], order[10_000:]):
        keep, state = stream.newer_rows(rng.sample(part, len(part)), state)
        kept += keep
    # A frame for each file takes over ten seconds.
    assert perf_counter() - begin < 3
    top = None
    for name, time, rule, i in order:
        if not rule or top is None or time > top:
            expected.add(i)
        top = time if top is None else max(top, time)
    assert sorted(kept) == sorted(expected)


@pytest.mark.parametrize("runs", [[NAMES], [NAMES[:1], NAMES[1:4], NAMES[4:]]])
def test_stateful_filter_equals_a_replay(spark, tmp_path, runs):
    rows = feed(7)
    for some in runs:
        for n in some:
            put(tmp_path / "raw", n, rows[n])
        kept = stream.newer_only_stream(stream.ingest_stream(spark, ingest.TICKETS, str(tmp_path / "raw")))
        kept.writeStream.format("parquet").option("path", str(tmp_path / "kept")).option(
            "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(str(tmp_path / "kept")).collect()
    assert sorted(((r._snapshot_file, r.id, r.updated_at or "", r.status) for r in got), key=repr) == replayed(
        (n, rows[n]) for n in NAMES)
    assert {r.group_id for r in got} == {None, 2**60 + 1}
