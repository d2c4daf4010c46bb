import random

import pytest
from pyspark.sql import functions as F

from flowtide import codes
from flowtide.operators import current, history

SCHEMA = "id long, status int, created_at string, updated_at string, product_id long, group_id long, file string, pos int"
ORDER = ("updated_at", "file", "pos")


def versions(spark, rows):
    """rows: (id, status, updated_at[, group_id])"""
    full = [(r[0], r[1], "2026-01-01T00:00:00Z", r[2], 1, r[3] if len(r) > 3 else None, "f", i)
            for i, r in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def tickets(spark, rows, **options):
    got = current.current_tickets(versions(spark, rows), order=ORDER, **options)
    return {r.id: r for r in got.collect()}


def t(day, hour=0):
    return f"2026-03-{day:02d}T{hour:02d}:00:00Z"


def test_latest_ties_and_nulls(spark):
    h = versions(spark, [(1, 2, t(1)), (1, 3, t(1)), (2, 2, None), (2, 4, "x"), (3, 5, None)])
    got = {r.id: r.status for r in history.latest_version(h, order=ORDER).collect()}
    assert got == {1: 3, 2: 4, 3: 5}


def test_filter_before_rank(spark):
    rows = [(1, 2, t(1), 100), (1, 3, t(2), 5551939), (2, 2, t(1), 1939), (3, 4, t(1), None)]
    got = tickets(spark, rows)
    assert {k: v.status for k, v in got.items()} == {1: 2, 3: 4}
    after = tickets(spark, rows, filter_after=True)
    assert {k: v.status for k, v in after.items()} == {3: 4}


def test_state_dates_read_all_versions(spark):
    got = tickets(spark, [(1, 17, t(3), 8846), (1, 2, t(5), 1)])
    assert str(got[1].first_waiting_at) == "2026-03-03" and got[1].status == 2


@pytest.mark.parametrize("rows, day", [
    ([(1, 17, t(1)), (1, 6, t(2)), (1, 17, t(3)), (1, 17, t(4))], "2026-03-03"),
    ([(1, 6, t(1)), (1, 17, t(1))], None),
    ([(1, 6, t(1, 5)), (1, 17, t(1, 6))], "2026-03-01"),
    ([(1, 17, t(1, 5)), (1, 6, t(1, 6))], None),
    ([(1, 17, t(1, 1)), (1, 6, t(1, 6)), (1, 17, t(9))], "2026-03-09"),
])
def test_denied(spark, rows, day):
    row = tickets(spark, rows)[1]
    assert (row.denied_triage, row.denied_triage_at and str(row.denied_triage_at)) == (day is not None, day)


def test_bad_date_keeps_row(spark):
    h = versions(spark, [(1, 2, t(1))]).withColumn("created_at", F.lit("garbage…"))
    row = current.current_tickets(h, order=ORDER).first()
    assert row.created_at is None and row.id == 1


def random_history(seed, ids=40, n=900):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if rnd.random() < 0.35 else rnd.randrange(ids)
        time = None if rnd.random() < 0.03 else f"2026-03-{rnd.randint(1, 9):02d}T{rnd.randint(0, 23):02d}:00:00Z"
        rows.append((key, rnd.choice([2, 6, 7, 12, 17, 17]), time))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_regression_equals_definition(spark, seed):
    rows = random_history(seed)
    wanted = {}
    for key, status, time in rows:
        if status in codes.WAITING_CODES and time and any(
                k == key and s in codes.PASSED_CODES and p and p < time for k, s, p in rows):
            wanted[key] = min(wanted.get(key, "9"), time)
    got = history.first_regression(versions(spark, rows), codes.PASSED_CODES, codes.WAITING_CODES).collect()
    assert {r.id: r.regressed_on for r in got} == {k: v[:10] for k, v in wanted.items()}


@pytest.fixture(params=[1, 4, 40])
def ranges(spark, request):
    """Ranges that rows are dealt out in: far more than there are keys, too."""
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("seed", [3, None])
def test_transitions_equal_definition(spark, ranges, seed):
    # Without a seed: one id on one day holds most rows, in long runs of one state, some ids and states are missing.
    rows = random_history(seed) if seed else [
        (1 if i % 9 else (i % 7 or None), [5, None, 6][i // 70 % 3] if i % 9 else i % 4, f"2026-01-01T{i:05}") for i in range(600)]
    by_key = {}
    for pos, (key, status, time) in enumerate(rows):
        by_key.setdefault(key, []).append((time or "", pos, status, time))
    wanted = []
    for key, vs in by_key.items():
        vs.sort()
        changes = [v for i, v in enumerate(vs) if i == 0 or vs[i - 1][2] != v[2]]
        for i, c in enumerate(changes):
            after = changes[i + 1][3] if i + 1 < len(changes) else None
            wanted.append((key, changes[i - 1][2] if i else None, c[2], c[3], after))
    got = history.state_transitions(versions(spark, rows), order=ORDER).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(wanted, key=str)


def test_transitions_of_an_empty_history(spark):
    assert history.state_transitions(versions(spark, []), order=ORDER).collect() == []


def test_ranges_are_balanced_where_one_day_of_an_id_holds_a_third(spark):
    spark.conf.set("spark.sql.shuffle.partitions", 12)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(60_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS id", "CAST(id % 2 AS INT) AS status",
        "concat('2026-01-01T', lpad(id, 8, '0')) AS updated_at", "id AS pos").repartition(6)
    found = history._range_changes(rows, "id", "status", "updated_at", ("updated_at", "pos"))
    sizes = [r["count"] for r in found.groupBy("_range").count().collect()]
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) >= 2 and max(sizes) < 60_000 / 4


def replay_by_hand(files, stored):
    """The rule as it reads: one file after the other."""
    known, kept = dict(stored), []
    for name in sorted(files):
        before = dict(known)
        for key, time, tag in files[name]:
            u = time or ""
            if "_snapshot_" in name and key in before and u <= before[key]:
                continue
            kept.append((key, time, tag))
            known[key] = max(known.get(key, ""), u)
    return sorted(kept, key=str)


def replayed(spark, files, stored=None):
    rows = [(k, u, tag, name) for name, items in files.items() for k, u, tag in items]
    df = spark.createDataFrame(rows, "id long, updated_at string, tag string, _snapshot_file string")
    marks = None
    if stored is not None:
        marks = spark.createDataFrame(list(stored.items()), "id long, high_water string")
    return sorted(((r.id, r.updated_at, r.tag) for r in history.replay_snapshots(df, marks).collect()), key=str)


@pytest.mark.parametrize("files, stored, kept", [
    ({"x_snapshot_1": [(1, "a", "p")], "x_snapshot_2": [(1, "a", "q")]}, None, "p"),
    ({"x_snapshot_2": [(1, "c", "p"), (2, "a", "q")]}, {1: "b", 2: "b"}, "p"),
    ({"x_snapshot_2": [(1, None, "p"), (2, None, "q")]}, {2: "b"}, "p"),
    ({"x_snapshot_2": [(1, "c", "p"), (1, "d", "q")]}, {1: "b"}, "pq"),
    ({"x_backfill": [(1, "a", "p"), (1, "b", "q")]}, {1: "c"}, "pq"),
    ({"x_snapshot_1": [(1, "b", "p")], "x_snapshot_2": [(1, "a", "q")], "x_snapshot_3": [(1, "b", "r")],
      "x_snapshot_4": [(1, "c", "s")]}, None, "ps"),
])
def test_replay_cases(spark, files, stored, kept):
    assert "".join(sorted(r[2] for r in replayed(spark, files, stored))) == kept


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_replay_equals_file_by_file(spark, seed):
    rnd = random.Random(seed)
    files = {}
    for f in range(8):
        name = f"x_{'backfill' if rnd.random() < 0.2 else 'snapshot'}_{f}"
        files[name] = [(0 if rnd.random() < 0.35 else rnd.randrange(12),
                        rnd.choice([None, *"abcdefgh"]), f"{f}-{i}") for i in range(25)]
    stored = {k: rnd.choice(["", "c", "e"]) for k in range(0, 12, 2)} if seed > 1 else None
    assert replayed(spark, files, stored) == replay_by_hand(files, stored or {})


def test_merge_latest(spark):
    rows = [(1, "b", "w1", 0, "x"), (1, "b", "w2", 0, "y"), (1, "a", "w3", 0, "z"), (2, None, "w1", 1, "p"),
            (2, None, "w2", 1, "q")]
    df = spark.createDataFrame(rows, "id long, updated_at string, _snapshot_file string, _pos int, tag string")
    assert {r.id: r.tag for r in history.merge_latest(df).collect()} == {1: "x", 2: "p"}


def issue_rows(spark, rows):
    """rows: (id, identifier, team, labels)"""
    cols = "title state_name state_type started_at completed_at canceled_at project_name assignee_name".split()
    df = spark.createDataFrame(rows, "id string, identifier string, team_name string, labels string")
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in cols], F.lit(1).alias("priority"),
                     F.lit(False).alias("trashed"), F.lit(t(1)).alias("created_at"), F.lit(t(1)).alias("updated_at"))


def test_excluded_issues(spark):
    rows = [("a", None, "Development", None), ("b", None, "Other", None), ("c", "DEV-1", None, None),
            ("d", "dev-1", "development", None), ("e", "OPS-1", "Development", None), ("f", "DEV-2", "Ops", None)]
    got = current.current_issues(issue_rows(spark, rows), order=("updated_at",))
    assert {r.id for r in got.collect()} == {"b", "e", "f"}


def test_incident_flag(spark):
    rows = [("a", "X-1", "T", "Bug|INCIDENT"), ("b", "X-1", "T", "Non-incidental"), ("c", "X-1", "T", None)]
    got = current.current_issues(issue_rows(spark, rows), order=("updated_at",))
    assert {r.id: r.is_incident for r in got.collect()} == {"a": True, "b": True, "c": False}


def test_closed_at_takes_first_set_date(spark):
    rows = issue_rows(spark, [("a", "X-1", "T", None)])
    for completed, canceled, day in ((t(5), t(7), "2026-03-05"), (None, t(7), "2026-03-07"), ("junk", t(7), "2026-03-07")):
        df = rows.withColumn("completed_at", F.lit(completed)).withColumn("canceled_at", F.lit(canceled))
        assert str(current.current_issues(df, order=("updated_at",)).first().closed_at) == day
