import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from flowtide import schemas
from flowtide.operators import quality
from flowtide.operators.current import current_tickets
from flowtide.plans.pipeline import register_views, run_pipeline
from flowtide.sources import arrays, files, ingest, readers, sinks
from flowtide.streaming import ingest as stream

AT = dt.datetime(2026, 6, 14, 5)


def ticket(i, updated, status=2, **more):
    return {"id": i, "subject": "s", "status": status, "priority": 1, "created_at": "2026-06-01T00:00:00Z",
            "updated_at": updated, "due_by": None, "group_id": 1, "product_id": 2, "extra": {"x": 1}, **more}


def issue(i, updated="2026-06-02T00:00:00.000Z", **more):
    return {"id": i, "number": 7, "identifier": f"OPS-{i}", "title": "t", "description": None,
            "createdAt": "2026-06-01T00:00:00.000Z", "updatedAt": updated, "archivedAt": None, "completedAt": None,
            "canceledAt": None, "startedAt": None, "dueDate": None, "priority": 2, "estimate": 1.5, "trashed": None,
            "state": {"id": "s", "name": "Todo", "type": "unstarted"}, "assignee": None,
            "project": {"id": "p", "name": "Alpha"}, "team": {"id": "t", "name": "Ops"},
            "labels": {"nodes": []}, "parent": None, "cycle": None, **more}


def put(folder, name, rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(rows), encoding="utf-8")


def test_read_tickets(spark, tmp_path):
    put(tmp_path, "tickets_snapshot_20260601T001500Z.json",
        [ticket(1, "", status=9000), ticket(2, "2026-06-01T10:00:00Z"), {"id": 3}])
    rows = readers.read_tickets(spark, str(tmp_path)).orderBy("_pos").collect()
    assert [r.id for r in rows] == [1, 2, 3]
    assert rows[0].updated_at is None and rows[0].status == 9000 and rows[2].status is None
    assert rows[0]._snapshot_file == "tickets_snapshot_20260601T001500Z.json"


def test_read_issues(spark, tmp_path):
    nodes = lambda *names: {"nodes": [{"name": n} for n in names]}
    put(tmp_path, "issues_snapshot_20260601T001500Z.json", [
        issue("a", labels=nodes("A", "B"), assignee={"id": "1", "name": "Ann", "email": "a@example.com"}),
        issue("b", labels=nodes(None)), issue("c", labels=None, state=None),
        issue("d", cycle={"id": "c", "name": "C1", "startsAt": "x", "endsAt": "y"}, parent={"id": "a", "identifier": "OPS-a"})])
    rows = {r.id: r for r in readers.read_issues(spark, str(tmp_path)).collect()}
    assert [rows[k].labels for k in "abcd"] == ["A|B", None, None, None]
    assert rows["a"].assignee_name == "Ann" and rows["b"].assignee_name is None
    assert rows["c"].state_type is None and rows["d"].cycle_ends_at == "y" and rows["d"].parent_identifier == "OPS-a"
    history = [f.name for f in schemas.ISSUE_HISTORY.fields if not f.name.startswith("_")]
    assert [c for c in readers.read_issues(spark, str(tmp_path)).columns if not c.startswith("_")] == history
    assert len(history) == 32


def test_json_lines_folder_counts_as_one_snapshot(spark, tmp_path):
    folder = tmp_path / "raw" / "tickets_snapshot_20260601T001500Z.json"
    spark.range(50).select("id", F.lit("u").alias("updated_at")).repartition(3).write.json(str(folder))
    files = readers.list_files(spark, str(tmp_path / "raw"), "tickets")
    assert {r.file_name for r in files.collect()} == {"tickets_snapshot_20260601T001500Z.json"}
    rows = readers.read_tickets(spark, str(tmp_path / "raw"), multi_line=False)
    assert rows.count() == 50 and rows.select("_snapshot_file").distinct().count() == 1


def test_plan_files(spark, tmp_path):
    for name in ("tickets_snapshot_20260602T001500Z.json", "tickets_backfill_2026.json",
                 "tickets_snapshot_20260601T001500Z.json", "tickets_snapshot_20260601T001500Z.meta.json",
                 "other_snapshot_20260601T001500Z.json"):
        put(tmp_path, name, [])
    files = readers.list_files(spark, str(tmp_path), "tickets")
    log = spark.createDataFrame([("tickets_snapshot_20260601T001500Z.json",)], "file_name string")
    plan = [(r.file_name, r.incremental) for r in readers.plan_files(files, log).collect()]
    assert plan == [("tickets_backfill_2026.json", False), ("tickets_snapshot_20260602T001500Z.json", True)]


def test_expired_snapshots(spark):
    names = ["t_snapshot_20260315T235959Z.json", "t_snapshot_20260316T000000Z.json", "t_backfill_2020.json",
             "t_snapshot_junk.json"]
    df = spark.createDataFrame([(n,) for n in names], "file_name string")
    assert [r.file_name for r in readers.expired_snapshots(df, "2026-06-14").collect()] == names[:1]


def test_month_windows(spark):
    got = [(str(a), str(b)) for a, b in readers.month_windows(spark, "2025-11-15", "2026-01-20").collect()]
    assert got == [("2025-11-01", "2025-12-01"), ("2025-12-01", "2026-01-01"), ("2026-01-01", "2026-01-21")]


def test_manifest(spark, tmp_path):
    put(tmp_path, "t_snapshot_1.meta.json", {"ts": "x", "total_tickets": 4732, "pages": 48, "fields": ["id"]})
    row = readers.read_manifest(spark, str(tmp_path)).first()
    assert (row.total_tickets, row.pages, row.fields, row.total_nodes) == (4732, 48, ["id"], None)


def test_explode_json(spark):
    df = spark.createDataFrame([("f", '[{"a": 1, "b": "x"}, {"a": null}]'), ("g", "[]")], "name string, raw string")
    got = [tuple(r) for r in readers.explode_json(df, "raw", "struct<a:int,b:string>").collect()]
    assert got == [("f", 0, 1, "x"), ("f", 1, None, None)]


def load(spark, root, at=AT):
    return ingest.load_files(spark, ingest.TICKETS, str(root / "raw"), str(root / "history"), str(root / "log"), at)


def stored(spark, root):
    schema = sinks.history_schema(schemas.TICKET_HISTORY)
    return sinks.read_or_empty(spark, str(root / "history"), schema)


def counts(spark, root):
    log = sinks.read_or_empty(spark, str(root / "log"), schemas.IMPORT_LOG)
    return sorted((r.file_name[-21:-5], r.row_count) for r in log.collect())


def test_load_files(spark, tmp_path):
    raw = tmp_path / "raw"
    put(raw, "tickets_snapshot_20260601T001500Z.json", [ticket(1, "b"), ticket(2, "b")])
    put(raw, "tickets_snapshot_20260602T001500Z.json", [ticket(1, "b"), ticket(2, "a")])
    assert load(spark, tmp_path) == 2
    assert counts(spark, tmp_path) == [("20260601T001500Z", 2), ("20260602T001500Z", 0)]
    assert load(spark, tmp_path) == 0
    put(raw, "tickets_snapshot_20260603T001500Z.json", [ticket(1, "c"), ticket(1, "d"), ticket(2, "b"), ticket(3, None)])
    assert load(spark, tmp_path, AT + dt.timedelta(days=1)) == 1
    assert counts(spark, tmp_path)[-1] == ("20260603T001500Z", 3)
    got = sorted((r.id, r.updated_at) for r in stored(spark, tmp_path).select("id", "updated_at").collect() if r.updated_at)
    assert got == [(1, "b"), (1, "c"), (1, "d"), (2, "b")]
    newest = {r.id: r.updated_at for r in stored(spark, tmp_path).groupBy("id").agg(F.max("updated_at").alias("updated_at")).collect()}
    assert newest == {1: "d", 2: "b", 3: None}
    dates = {str(r[0]) for r in stored(spark, tmp_path).select("snapshot_date").distinct().collect()}
    assert dates == {"2026-06-01", "2026-06-03"}


def test_repeat_after_a_stop_before_the_log(spark, tmp_path):
    raw = tmp_path / "raw"
    put(raw, "tickets_snapshot_20260601T001500Z.json", [ticket(1, "b")])
    put(raw, "tickets_backfill_2026.json", [ticket(1, "a"), ticket(2, "a")])
    load(spark, tmp_path)
    # The same history without its log: the run stopped between the two writes.
    ingest.load_files(spark, ingest.TICKETS, str(raw), str(tmp_path / "history"), str(tmp_path / "log2"), AT)
    assert sorted((r.id, r.updated_at) for r in stored(spark, tmp_path).collect()) == [(1, "a"), (1, "b"), (2, "a")]


def test_ties_go_to_the_later_file_and_position(spark, tmp_path):
    put(tmp_path / "raw", "tickets_backfill_1.json", [ticket(1, "b", 2), ticket(1, "b", 3), ticket(2, "b", 2)])
    put(tmp_path / "raw", "tickets_backfill_2.json", [ticket(2, "b", 4)])
    load(spark, tmp_path)
    got = {r.id: r.status for r in current_tickets(stored(spark, tmp_path)).collect()}
    assert got == {1: 3, 2: 4}
    # A later run counts as later even under an earlier name.
    put(tmp_path / "raw", "tickets_backfill_0.json", [ticket(2, "b", 5)])
    load(spark, tmp_path, AT + dt.timedelta(days=1))
    assert {r.id: r.status for r in current_tickets(stored(spark, tmp_path)).collect()} == {1: 3, 2: 5}


def test_empty_landing_is_refused(spark, tmp_path):
    put(tmp_path / "raw", "tickets_snapshot_20260601T001500Z.json", [])
    with pytest.raises(ValueError):
        load(spark, tmp_path)


def run_stream(spark, root, **options):
    rows = stream.ingest_stream(spark, ingest.TICKETS, str(root / "raw"), **options)
    q = stream.write_history(rows, ingest.TICKETS, str(root / "history"), str(root / "log"), str(root / "cp"), AT)
    q.awaitTermination()


def test_stream_equals_batch(spark, tmp_path):
    raw = tmp_path / "raw"
    put(raw, "tickets_snapshot_20260601T001500Z.json", [ticket(1, "b"), ticket(2, "b")])
    put(raw, "tickets_snapshot_20260601T001500Z.meta.json", {"ts": "x"})
    run_stream(spark, tmp_path)
    put(raw, "tickets_snapshot_20260602T001500Z.json", [ticket(1, "b"), ticket(2, "c")])
    put(raw, "tickets_snapshot_20260603T001500Z.json", [ticket(2, "c"), ticket(3, None)])
    run_stream(spark, tmp_path)
    run_stream(spark, tmp_path)
    assert counts(spark, tmp_path) == [("20260601T001500Z", 2), ("20260602T001500Z", 1), ("20260603T001500Z", 1)]
    assert sorted((r.id, r.updated_at or "") for r in stored(spark, tmp_path).collect()) == [
        (1, "b"), (2, "b"), (2, "c"), (3, "")]


@pytest.mark.parametrize("options", [{}, {"max_files": 1}])
def test_stream_keeps_all_parts_of_a_snapshot(spark, tmp_path, options):
    folder = tmp_path / "raw" / "tickets_snapshot_20260601T001500Z.json"
    put(folder, "part-0.json", [ticket(i, "b") for i in (1, 2, 3)])
    put(folder, "part-1.json", [ticket(i, "b") for i in (4, 5, 6)])
    run_stream(spark, tmp_path, **options)
    put(folder, "part-2.json", [ticket(7, "b")])
    run_stream(spark, tmp_path, **options)
    assert sorted(r.id for r in stored(spark, tmp_path).collect()) == [1, 2, 3, 4, 5, 6, 7]
    log = sinks.read_or_empty(spark, str(tmp_path / "log"), schemas.IMPORT_LOG)
    assert sum(r.row_count for r in log.collect()) == 7


def test_newer_only_batch(spark):
    batch = spark.createDataFrame([(1, "a"), (1, "c"), (2, None), (3, "x")], "id long, updated_at string")
    marks = spark.createDataFrame([(1, "b"), (2, "")], "id long, high_water string")
    got = stream.newer_only_batch(batch, marks).collect()
    assert sorted((r.id, r.updated_at) for r in got) == [(1, "c"), (3, "x")]


def test_high_water_stream(spark, tmp_path):
    put(tmp_path / "raw", "tickets_snapshot_20260601T001500Z.json", [ticket(1, "b"), ticket(1, "c"), ticket(2, "a")])
    marks = stream.high_water_stream(stream.ingest_stream(spark, ingest.TICKETS, str(tmp_path / "raw")))
    q = (marks.writeStream.outputMode("complete").format("memory").queryName("marks")
         .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert {r.id: r.high_water for r in spark.table("marks").collect()} == {1: "c", 2: "a"}


def test_overwrite_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite_table(spark.range(3), path, "1")
    sinks.overwrite_table(spark.range(5), path, "2")
    assert sinks.read_table(spark, path).count() == 5
    # A build that has not been pointed to stays unseen.
    spark.range(9).write.parquet(f"{path}/build=3")
    assert sinks.read_table(spark, path).count() == 5


def test_a_second_attempt_never_touches_the_live_build(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite_table(spark.range(3), path, "1")
    before = sinks.read_table(spark, path)
    broken = spark.range(4).select(F.raise_error(F.lit("stopped")).alias("id"))
    with pytest.raises(Exception, match="stopped"):
        sinks.overwrite_table(broken, path, "1")
    assert before.count() == 3 and sinks.read_table(spark, path).count() == 3
    sinks.overwrite_table(spark.range(7), path, "1")
    # The former build stays for readers that have begun; the newest pointer counts, not the greatest name.
    assert before.count() == 3 and sinks.read_table(spark, path).count() == 7
    sinks.overwrite_table(spark.range(8), path, "0")
    assert sinks.read_table(spark, path).count() == 8
    assert len(files.children(spark, f"{path}/build=1")) == 1 and len(files.children(spark, f"{path}/build=0")) == 1
    sinks.overwrite_table(spark.range(9), path, "3", keep=1)
    assert [n for n in files.children(spark, path) if n.startswith("build=")] == ["build=3"]


def test_expired_snapshots_go_when_they_are_logged(spark, tmp_path):
    raw = tmp_path / "raw"
    for name in ("tickets_snapshot_20260101T001500Z.json", "tickets_snapshot_20260102T001500Z.json",
                 "tickets_snapshot_20260601T001500Z.json", "tickets_backfill_20260101.json"):
        put(raw, name, [ticket(1, "a")])
        put(raw, name.replace(".json", ".meta.json"), {"total_tickets": 1})
    listed = readers.list_files(spark, str(raw), "tickets")
    log = listed.filter("file_name not like '%0102T%'")
    assert sinks.drop_expired(spark, listed, log, "2026-06-14", 90) == 1
    assert sorted(p.name for p in raw.iterdir() if "0101T" in p.name) == []
    assert len([p for p in raw.iterdir() if p.suffix == ".json"]) == 6
    assert sinks.drop_expired(spark, listed.limit(0), log, "2026-06-14", 90) == 0


def test_load_reconciliation(spark, tmp_path):
    raw, name = tmp_path / "raw", "tickets_snapshot_2026060{}T001500Z.json".format
    put(raw, name(1), [ticket(1, "b"), ticket(1, "b"), ticket(2, "b")])
    put(raw, name(2), [ticket(1, "b"), ticket(2, "c")])
    for i, total in ((1, 3), (2, 5), (3, 1)):
        put(raw, name(i).replace(".json", ".meta.json"), {"total_tickets": total})
    load(spark, tmp_path)
    log = lambda: sinks.read_or_empty(spark, str(tmp_path / "log"), schemas.IMPORT_LOG)
    by_file = {r.file_name: tuple(r)[1:] for r in quality.load_reconciliation(
        readers.read_manifest(spark, str(raw)), sinks.arrivals(spark, str(tmp_path / "log_arrivals")), log(),
        stored(spark, tmp_path)).collect()}
    assert by_file == {name(1): (3, 3, 1, 3, 3, None), name(2): (5, 2, 0, 1, 1, "not as fetched"),
                       name(3): (1, None, None, None, 0, "never arrived")}
    lost = stored(spark, tmp_path).filter(F.col("_source_file") != name(1))
    by_file = {r.file_name: r.fault for r in quality.load_reconciliation(
        readers.read_manifest(spark, str(raw)), sinks.arrivals(spark, str(tmp_path / "log_arrivals")), log(), lost).collect()}
    assert by_file[name(1)] == "not as logged"
    # A part that comes again counts once.
    ingest.load_files(spark, ingest.TICKETS, str(raw), str(tmp_path / "history"), str(tmp_path / "log3"), AT)
    assert sum(r.row_count for r in sinks.arrivals(spark, str(tmp_path / "log3_arrivals")).collect()) == 5


def test_field_drift(spark):
    df = spark.createDataFrame([('{"a": 1, "b": 2}',), ('{"a": null}',), ("junk",), (None,), ("[1]",)], "raw string")
    got = {r.field: (r.found, r.objects, r.drift) for r in quality.field_drift(df, "raw", ["a", "c"]).collect()}
    assert got == {"a": (2, 2, None), "b": (1, 2, "added"), "c": (0, 2, "removed")}
    empty = quality.field_drift(df.limit(0), "raw", ["a"]).collect()
    assert [tuple(r) for r in empty] == [("a", 0, 0, "removed")]


def test_pipeline(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    put(raw / "tickets", "tickets_snapshot_20260601T001500Z.json",
        [ticket(1, "2026-06-01T10:00:00Z", 17), ticket(2, "2026-06-02T10:00:00Z", 6)])
    put(raw / "issues", "issues_snapshot_20260601T001500Z.json", [issue("a"), issue("b", completedAt="2026-06-03T00:00:00Z")])
    run_pipeline(spark, str(raw), out, "2026-06-12", AT, projects=["Alpha"])
    report = lambda name: sinks.read_table(spark, f"{out}/reports/{name}")
    row = report("summary_week").first()
    assert (row.issue_created, row.issue_closed, row.issue_open, row.ticket_waiting, row.ticket_passed) == (2, 1, 1, 1, 1)
    assert [(r.project_group, r["count"]) for r in report("project_volume").collect()] == [("Alpha", 2)]
    assert report("drill").filter("level = 15").first()["count"] == 2
    assert sinks.read_table(spark, f"{out}/load_report/tickets").first().total == 2
    register_views(spark, out, "2026-06-12")
    counted = spark.sql("""select year_week, count(*) n from fact_issues join date_dim on date_key = created_at
                           group by year_week""")
    assert [tuple(r) for r in counted.collect()] == [("2026-W23", 2)]
    put(raw / "issues", "issues_snapshot_20260613T001500Z.json",
        [issue("a", "2026-06-13T00:00:00.000Z", completedAt="2026-06-05T00:00:00Z")])
    run_pipeline(spark, str(raw), out, "2026-06-12", AT + dt.timedelta(days=1), names=["summary_week"])
    assert report("summary_week").first().issue_closed == 2
    assert sinks.read_table(spark, f"{out}/current/issues").count() == 2
    faults = {r.file_name: r.fault for r in sinks.read_table(spark, f"{out}/checks/issues_loads").collect()}
    assert faults == {"issues_snapshot_20260601T001500Z.json": None, "issues_snapshot_20260613T001500Z.json": None}
    assert {r.table_name for r in sinks.read_table(spark, f"{out}/checks/freshness").collect()} == {"tickets", "issues"}
    assert sum(r.violations for r in sinks.read_table(spark, f"{out}/checks/tickets_keys").collect()) == 0
    # What has been loaded goes after the retention time, and the tables stay.
    run_pipeline(spark, str(raw), out, "2026-09-05", AT + dt.timedelta(days=2), names=["summary_week"])
    assert [p.name for p in (raw / "issues").iterdir() if p.suffix == ".json"] == ["issues_snapshot_20260613T001500Z.json"]
    assert sinks.read_table(spark, f"{out}/current/issues").count() == 2


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "211")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield spark
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("most", [arrays.BROADCAST_BLOCKS, 0])
@pytest.mark.parametrize("indent", [None, 2])
def test_split_array_equals_the_reader_of_whole_files(small_blocks, tmp_path, monkeypatch, indent, most):
    monkeypatch.setattr(arrays, "BROADCAST_BLOCKS", most)
    spark = small_blocks
    texts = ['}, {"id": 5}', '\\', '\\"}]', '[[{{', '"', 'å}ö', '', 'x' * 700, '\\"' * 90 + '}' * 300, '{"a":"}"}\n']
    rows = [issue(f"i{i}", title=texts[i % len(texts)], labels={"nodes": [{"name": texts[i % 7]}]}) for i in range(60)]
    for name, some in (("a", rows), ("b", rows[:1]), ("c", [])):
        (tmp_path / f"issues_snapshot_{name}.json").write_text(json.dumps(some, indent=indent, ensure_ascii=False) + "\n",
                                                               encoding="utf-8")
    found = readers.read_issues(spark, str(tmp_path), "split")
    whole = readers.read_issues(spark, str(tmp_path), True)
    own = [c for c in whole.columns if c not in ("_block", "_pos")]
    assert sorted(found.select(own).collect(), key=str) == sorted(whole.select(own).collect(), key=str)
    big = found.filter("_snapshot_file = 'issues_snapshot_a.json'").orderBy("_block", "_pos").collect()
    assert [r.id for r in big] == [r["id"] for r in rows]
    assert [r.id for r in sorted(big, key=lambda r: r._pos)] == [r["id"] for r in rows]
    assert len({r._block for r in big}) > 20


def test_split_array_leaves_out_other_elements_and_finds_cut_files(small_blocks, tmp_path):
    spark = small_blocks
    deep = [[{"id": 100 + i} for i in range(60)], None, 3, "{", {"id": 1, "subject": "a" * 300}, [[{}], "}"], {"id": 2}]
    (tmp_path / "tickets_snapshot_x.json").write_text(json.dumps(deep))
    (tmp_path / "tickets_snapshot_y.json").write_text('\ufeff {"id": 3}{"id": 4}')
    rows = readers.read_tickets(spark, str(tmp_path), "split").collect()
    assert sorted(r.id for r in rows) == [1, 2, 3, 4]
    for i, cut in enumerate(('[{"id": 1}', '[{"id": 1}\n', '[{"id": 1}, {"id": "x', '[{"id": 1}, {"id": 2', '{"id": {"a": 1}')):
        put(tmp_path / f"cut{i}", "tickets_snapshot_z.json", [])
        (tmp_path / f"cut{i}" / "tickets_snapshot_z.json").write_text(cut)
        with pytest.raises(Exception, match="ends within"):
            readers.read_tickets(spark, str(tmp_path / f"cut{i}"), "split").collect()


def test_load_of_split_arrays(small_blocks, tmp_path):
    rows = [ticket(i, f"2026-06-01T10:00:{i % 60:02d}Z", subject='"}{[') for i in range(40)]
    put(tmp_path / "raw", "tickets_snapshot_20260601T001500Z.json", rows)
    put(tmp_path / "raw", "tickets_snapshot_20260602T001500Z.json", rows[:5] + [ticket(99, "2026-06-02T00:00:00Z")])
    kept = []
    for mode in ("split", True):
        out = str(tmp_path / str(mode))
        ingest.load_files(small_blocks, ingest.TICKETS, str(tmp_path / "raw"), f"{out}/h", f"{out}/l", AT, multi_line=mode)
        stored = sinks.read_or_empty(small_blocks, f"{out}/h", sinks.history_schema(schemas.TICKET_HISTORY))
        kept.append(sorted(map(str, stored.select("id", "updated_at", "subject", "_source_file").collect())))
    assert kept[0] == kept[1] and len(kept[0]) == 41
