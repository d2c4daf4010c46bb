"""Physical plans: what must not appear whatever the size of the data."""

import re

import pytest

from pyspark.sql import functions as F

from flowtide import schemas
from flowtide.operators import calendar, history
from flowtide.operators.joins import in_window
from flowtide.sources import sinks
from flowtide.workload import adapters as a
from flowtide.workload.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def no_broadcast(spark):
    """Plans as they are for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


INGEST = {"ingest_files", "ingest_stream", "ingest_loads", "ingest_stream_batches", "newer_only_stream"}


@pytest.mark.parametrize("name", [q for q in QUERIES if q not in INGEST])
def test_no_cross_join_and_no_python(no_broadcast, name):
    text = plan(QUERIES[name](no_broadcast, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas",
                 "FlatMapGroupsInPandas"):
        assert node not in text, node


def test_rebuild_reads_the_history_once(no_broadcast):
    text = plan(a.tickets(no_broadcast, SF))
    assert text.count("FileScan") == 1 and "Join" not in text
    # By id and day, so that no id is one task's, and then the days by id.
    assert len(re.findall(r"Exchange hashpartitioning\(id#\d+L, \w+#\d+, ", text)) == 1
    assert text.count("Exchange hashpartitioning") == 2


def test_newest_versions_are_dealt_out_before_they_are_sorted(no_broadcast):
    """A scan task may hold more versions than it can sort; parts of the shuffle are bounded, also those of a hot key."""
    for options in ({}, {"filter_after": True}):
        text = plan(a.current_issue_table(no_broadcast, SF, **options))
        steps = re.findall(r"SortAggregate|Exchange hashpartitioning\(\w+#\d+L?, \d+\), \w+", text)
        assert [re.sub(r"#\d+L?, \d+", "", x) for x in steps] == [
            "SortAggregate", "Exchange hashpartitioning(id), ENSURE_REQUIREMENTS", "SortAggregate",
            "Exchange hashpartitioning(_dealt), REBALANCE_PARTITIONS_BY_COL"]


def test_no_window_over_raw_versions_of_an_id(no_broadcast):
    for df in (a.tickets(no_broadcast, SF),
               history.replay_snapshots(a.ticket_snapshots(no_broadcast, SF)),
               history.state_transitions(a.ticket_history(no_broadcast, SF), order=a.TICKET_ORDER)):
        text = plan(df)
        for line in text.splitlines():
            found = re.search(r"Window .*\], \[(id#\d+L)\]", line)
            if found:
                below = text[text.index(line):].splitlines()[1:8]
                assert any("Aggregate(key=[id" in x for x in below), line


def test_kpis_scan_the_fact_once(no_broadcast):
    text = plan(QUERIES["ticket_kpis_week"](no_broadcast, SF))
    assert text.count("SinglePartition") == 1
    text = plan(QUERIES["issue_kpis_week"](no_broadcast, SF))
    assert text.count("FileScan parquet") == 2


def test_scans_read_needed_columns_and_push_filters(no_broadcast):
    text = plan(QUERIES["issue_kpis_week"](no_broadcast, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in text
    rows = no_broadcast.read.parquet(f"{SF}/documents.parquet")
    text = in_window(rows, "lang", "2026-01-01", "2026-02-01")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(lang), GreaterThanOrEqual(lang,2026-01-01), LessThan(lang,2026-02-01)]" in text


def test_calendar_joins_never_shuffle_the_fact(no_broadcast):
    text = plan(QUERIES["by_calendar"](no_broadcast, SF))
    join = next(line for line in text.splitlines() if "closed_at" in line and "BroadcastHashJoin" in line)
    assert "BuildRight" in join


def test_calendar_length_is_limited(no_broadcast):
    with pytest.raises(ValueError):
        calendar.date_dim(no_broadcast, "1400-01-01", "2100-01-01")


def test_history_scan_is_pruned_by_file(no_broadcast, tmp_path):
    path = str(tmp_path / "h")
    rows = a.ticket_snapshots(no_broadcast, SF).selectExpr(
        "id", "updated_at", "_snapshot_file", "'p' AS _part", "0L AS _block", "pos AS _pos")
    sinks.append_history(rows, path, "2024-02-01 00:00:00")
    names = ["tickets_snapshot_20240105T001500Z.json"]
    schema = sinks.history_schema(schemas.TICKET_HISTORY)
    text = plan(sinks.read_or_empty(no_broadcast, path, schema).filter(F.col("_source_file").isin(names)).select("id"))
    assert re.search(r"PartitionFilters: \[.*_source_file", text) and "ReadSchema: struct<id:bigint>" in text


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)
