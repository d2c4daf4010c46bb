import datetime as dt

import pytest
from pyspark.sql import functions as F

from flowtide.functions import dates, labels, periods, text
from flowtide.operators import joins


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_status_labels(spark):
    assert column(spark, [2, 12, 17, 23], "int", labels.status_label("v")) == [
        "Open", "Passed triage", "Waiting for triage", "Other (23)"]


def test_state_labels(spark):
    states = ["backlog", "unstarted", "started", "cancelled", "canceled", "triage", None]
    wide = ["Backlog / Unstarted", "Backlog / Unstarted", "In Progress", "Cancelled", "Cancelled", "Other", "Other"]
    assert column(spark, states, "string", labels.state_label("v")) == wide
    assert column(spark, states, "string", labels.state_label("v", strict=True)) == [*wide[:4], "Other", *wide[5:]]


def test_priority_labels(spark):
    assert column(spark, [0, 1, 4, 9, None], "int", labels.priority_label("v")) == [
        "No priority", "Urgent", "Low", "Unknown", "Unknown"]


@pytest.mark.parametrize("status, denied, label", [
    (17, True, "Denied"), (17, False, "Waiting"), (7, True, "Passed"), (6, False, "Passed"), (4, True, "Other")])
def test_triage_status(spark, status, denied, label):
    df = spark.createDataFrame([(status, denied)], "s int, d boolean")
    assert df.select(labels.triage_status("s", "d")).first()[0] == label


def test_lead_time_buckets(spark):
    days = [1, 2, 7, 8, 14, 15, 30, 31, 90, 91, 0, None]
    assert column(spark, days, "int", labels.lead_time("v")) == [
        "Same day", "2–7 days", "2–7 days", "8–14 days", "8–14 days", "15–30 days", "15–30 days",
        "31–90 days", "31–90 days", "+90 days", "2–7 days", None]
    assert column(spark, days, "int", labels.lead_time_sort("v")) == [1, 2, 2, 3, 3, 4, 4, 5, 5, 6, 2, 99]


def test_project_group(spark):
    assert column(spark, ["alpha", "Gamma", None], "string", labels.project_group("v", ["Alpha", "Beta"])) == [
        "Alpha", "Other", "Unassigned"]


def test_kpi_category_first_match_wins(spark):
    df = spark.createDataFrame(
        [("unstarted", "X"), ("started", "X"), ("backlog", "X"), ("backlog", "Backlog"), ("completed", "X"),
         ("triage", "Waiting"), ("triage", "New"), (None, None)], "t string, n string")
    assert [r[0] for r in df.select(labels.kpi_category("t", "n")).collect()] == [
        "Unassigned", "Assigned", "WaitingForTeam", "Unassigned", "Done", "WaitingForTeam", "Other", "Other"]


def test_text_functions(spark):
    df = spark.sql("""select 'DEV-1' a, '' b, cast(null as string) c, 7 n, array('x', null, 'y') arr,
      array(named_struct('name', 'A'), named_struct('name', 'B')) labels,
      array(named_struct('name', cast(null as string))) none, '{"k": {"j": 5}}' js, 12 big, 0 zero""")
    row = df.select(
        text.left("a", 3).alias("l"), text.right("a", 1).alias("r"), text.ilike("a", "dev%").alias("like"),
        text.blank_to_null("b").alias("b"), text.zero_pad("n").alias("pad"), text.flatten_array("arr").alias("arr"),
        text.join_labels("labels").alias("labels"), text.join_labels("none").alias("none"),
        text.json_path("js", "$.k.j", "int").alias("j"), text.first_set("c", "a").alias("f"),
        text.ratio("big", "zero").alias("ratio"), text.least("big", "n").alias("least"),
        text.or_unassigned("c").alias("who"), text.to_type("n", "string").alias("t"), text.try_type("a", "int").alias("ti"),
        text.switch((F.col("n") > 10, "big"), (F.col("n") > 5, "mid"), otherwise=F.lit("small")).alias("sw"),
        text.raw_json(F.struct("n")).alias("raw"), text.in_codes("n", [7]).alias("in"), text.concat("a", "a").alias("cc"),
    ).first()
    assert row.asDict() == {
        "l": "DEV", "r": "1", "like": True, "b": None, "pad": "07", "arr": "x;y", "labels": "A|B", "none": None,
        "j": 5, "f": "DEV-1", "ratio": None, "least": 7, "who": "Unassigned", "t": "7", "ti": None, "sw": "mid",
        "raw": '{"n":7}', "in": True, "cc": "DEV-1DEV-1"}


@pytest.mark.parametrize("as_of, kind, wanted", [
    ("2026-06-12", "week", "06-01 06-07 05-25 05-31"),
    ("2026-06-08", "week", "06-01 06-07 05-25 05-31"),
    ("2026-06-14", "week", "06-01 06-07 05-25 05-31"),
    ("2026-06-12", "month", "05-01 05-31 04-01 04-30"),
    ("2026-06-12", ("month", "2026-03-15"), "03-01 03-31 02-01 02-28"),
])
def test_period_bounds(as_of, kind, wanted):
    p = periods.period_bounds(as_of, kind)
    assert " ".join(f"{d:%m-%d}" for d in (p.start, p.end, p.prev_start, p.prev_end)) == wanted


def test_period_columns_agree_with_python(spark):
    days = [dt.date(2025, 11, 1) + dt.timedelta(days=i) for i in range(120)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    for kind in ("week", "month"):
        for r in df.select("d", *[c.alias(k) for k, c in periods.period_columns("d", kind).items()]).collect():
            p = periods.period_bounds(r.d, kind)
            assert (r.period_start, r.period_end, r.prev_start, r.prev_end) == (p.start, p.end, p.prev_start, p.prev_end)


def test_period_labels():
    assert periods.period_label("2026-06-12") == "Period: W23"
    assert periods.prev_period_label("2026-06-12") == "Previous: W22"
    assert periods.period_label("2026-06-12", "month") == "Period: May"
    assert periods.period_summary("2026-06-12") == "Period: W23     |     Previous: W22"
    assert periods.check_week("2026-06-12") == "2026-06-01 -> 2026-06-07"
    assert periods.last_completed_week("2026-01-07") == 1
    assert periods.prev_period_bounds("2026-06-12") == (dt.date(2026, 5, 25), dt.date(2026, 5, 31))


def test_week_class(spark):
    days = ["2026-06-01", "2026-05-31", "2026-06-08"]
    assert column(spark, [dt.date.fromisoformat(d) for d in days], "date", periods.week_class("v", "2026-06-12")) == [
        "Last Week", "Week Before", "Other"]


def test_in_window_equals_prefix_rule(spark):
    times = ["2026-01-09T23:59:59Z", "2026-01-10", "2026-01-10T00:00:00Z", "2026-01-16T23:59:59.9Z", "2026-01-17", None]
    df = spark.createDataFrame([(x,) for x in times], "u string")
    got = [r.u for r in joins.in_window(df, "u", "2026-01-10", "2026-01-17").collect()]
    assert got == [x for x in times if x and "2026-01-10" <= x[:10] < "2026-01-17"]


def test_last_months_and_exclusions(spark):
    rows = [("2026-02-28", "a"), ("2026-03-01", "b"), ("2026-06-30", "c"), ("2026-07-01", None)]
    df = spark.createDataFrame([(dt.date.fromisoformat(d), w) for d, w in rows], "d date, who string")
    pick = lambda x: [r.who for r in x.collect()]
    assert pick(joins.last_months(df, "d", 3, "2026-06-12")) == ["b", "c"]
    assert pick(joins.last_months(df, "d", 3, "2026-06-12", include_current=False)) == ["b"]
    assert pick(joins.exclude_values(df, "who", ["a", "b"])) == ["c", None]
    assert pick(joins.exclude_values(df, "who", [])) == ["a", "b", "c", None]


def test_ensure_columns_and_ranked(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, 5.0)], "id int, v double")
    wide = joins.ensure_columns(df, spark.createDataFrame([], "id int, title string").schema)
    assert wide.columns == ["id", "v", "title"]
    assert [r.id for r in joins.ranked_table(df, "v").collect()] == [3, 1, 2]
    assert [r.id for r in joins.head(df, 2, ["id"]).collect()] == [1, 2]
    assert [r.id for r in joins.order_by_sort_key(df, "id").collect()] == [1, 2, 3]


def test_uniform_time_orders_mixed_precision(spark):
    mixed = ["2026-06-04T11:14:51.968Z", "2026-06-04T11:14:51Z", "2026-06-04T13:14:51.5+02:00", "junk"]
    assert column(spark, mixed, "string", dates.uniform_time("v")) == [
        "2026-06-04T11:14:51.968000Z", "2026-06-04T11:14:51.000000Z", "2026-06-04T11:14:51.500000Z", None]
