import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from flowtide.functions import periods
from flowtide.operators import facts, measures as m, series
from flowtide.plans import reports

AS_OF = "2026-06-12"
ISSUE = ("id string, identifier string, title string, state_name string, state_type string, priority int, "
         "created_at date, started_at date, closed_at date, project_name string, assignee_name string, is_incident boolean")


def day(x):
    return dt.date.fromisoformat(f"2026-{x}") if isinstance(x, str) else x


def issues(spark, rows, as_of=AS_OF):
    """rows: (created, closed[, started, assignee, project, incident])"""
    full = []
    for i, r in enumerate(rows):
        created, closed, started, who, project, incident = (*r, *[None] * (6 - len(r)))
        full.append((str(i), f"I-{i}", f"title {i}", "Todo", "started", i % 5, day(created), day(started), day(closed),
                     project, who, bool(incident)))
    return facts.fact_issues(spark.createDataFrame(full, ISSUE), as_of, projects=["Alpha"])


def test_durations_are_inclusive(spark):
    rows = issues(spark, [("06-01", "06-01"), ("06-01", "06-02"), ("06-01", None), ("06-05", "06-01")]).orderBy("id").collect()
    assert [r.days_to_close for r in rows] == [1, 2, None, -3]
    assert [r.age_days for r in rows] == [None, None, 12, None]
    assert [r.lead_time for r in rows] == ["Same day", "2–7 days", None, "2–7 days"]


def test_issue_kpis(spark):
    rows = [("06-01", "06-03"), ("06-02", None, None, None, None, True), ("05-26", "06-05"), ("05-20", "05-28"),
            ("06-09", None)]
    k = m.issue_kpis(issues(spark, rows), AS_OF).first()
    assert (k.created, k.created_prev, k.created_change) == (2, 1, 1.0)
    assert (k.closed, k.closed_prev, k.closed_change) == (2, 1, 1.0)
    assert (k.open, k.open_prev, k.open_change) == (1, 1, 0)
    assert (k.incidents, k.incidents_prev, k.incidents_change) == (1, 0, 1)
    assert (k.avg_days_to_close, k.avg_days_to_close_prev) == (7.0, 9.0)
    # Ages do not count the first day.
    assert (k.oldest_issue, k.oldest_issue_prev, k.oldest_issue_change) == (10, 5, 5)


def test_empty_period(spark):
    k = m.issue_kpis(issues(spark, [("01-01", "01-02")]), AS_OF, blank_zero=["closed"]).first()
    assert (k.created, k.created_change, k.incidents, k.avg_days_to_close, k.oldest_issue) == (0, None, 0, None, None)
    assert k.closed is None


TICKET = ("id long, status int, created_at date, updated_at date, product_id long, first_waiting_at date, "
          "first_passed_at date, denied_triage boolean, denied_triage_at date")


def tickets(spark, rows):
    """rows: (status, created, waiting, passed, denied)"""
    full = [(i, s, day(c), day(c), 1, day(w), day(p), d is not None, day(d)) for i, (s, c, w, p, d) in enumerate(rows)]
    return facts.fact_tickets(spark.createDataFrame(full, TICKET))


def test_ticket_kpis(spark):
    fact = tickets(spark, [
        (17, "06-01", "06-02", None, None), (6, "06-03", "06-03", "06-04", None), (2, "06-04", None, None, None),
        (17, "05-25", "05-26", "05-27", "06-05"), (2, "05-26", None, None, None)])
    k = m.ticket_kpis(fact, AS_OF).first()
    assert (k.created, k.created_prev, k.created_change) == (3, 2, 0.5)
    assert (k.waiting, k.waiting_prev, k.passed, k.passed_prev) == (2, 1, 1, 1)
    assert (k.escalated, k.escalated_prev) == (2, 1)
    assert k.escalation_rate == pytest.approx(2 / 3) and k.escalation_rate_change == pytest.approx(2 / 3 - 0.5)
    assert (k.denied, k.denied_prev, k.denied_change) == (1, 0, 1)
    page = reports.ticket_page(fact, AS_OF, days=9).first()
    assert (page.waited_longest, page.waiting_over) == (10, 1)
    month = m.ticket_kpis(fact, AS_OF, ("month", "2026-05-31")).first()
    assert (month.created, month.created_prev, month.escalation_rate_prev) == (2, 0, None)


def test_escalation_series(spark):
    fact = tickets(spark, [(2, "05-01", "05-02", None, None), (2, "05-09", None, None, None), (2, "06-01", None, None, None)])
    got = {str(r.month): (r.created, r.escalation_rate) for r in series.escalation_rate_series(fact).collect()}
    assert got == {"2026-05-01": (2, 50.0), "2026-06-01": (1, 0.0)}


def test_throughput_split(spark):
    fact = issues(spark, [("06-01", "06-03"), ("05-01", "06-03"), ("05-01", "05-29"), (None, "06-04")])
    row = m.measure_table(fact, m.throughput_split(periods.period_bounds(AS_OF))).first()
    assert tuple(row) == (3, 1, 2)


def test_oldest_open_ties(spark):
    fact = issues(spark, [("05-01", None), ("05-01", None), ("04-01", "04-02"), ("06-01", None)])
    row = reports.tooltip_oldest(fact).first()
    assert (str(row.created_at), row.identifier, row.title) == ("2026-05-01", "I-1", "title 1")
    assert m.oldest_open_age(fact, AS_OF).first()[0] == 42


def test_median_and_threshold(spark):
    fact = issues(spark, [("05-01", "05-01"), ("05-01", "05-02"), ("05-01", "05-05"), ("05-01", "06-10"), ("05-01", None)])
    row = m.close_stats(fact).first()
    assert (row.avg_days_to_close, row.median_days_to_close) == (12.25, 3.5)
    assert m.pct_closed_over(fact, 30).first()[0] == 0.25
    assert m.pct_closed_over(fact.filter("closed_at is null"), 30).first()[0] is None
    with pytest.raises(ValueError):
        m.pct_closed_over(fact, 0)


def test_backlog_edges(spark):
    fact = issues(spark, [("05-10", "05-05"), ("05-01", "05-31")])
    got = {str(r.day): r.open for r in series.backlog_series(fact, "2026-06-02", "day").collect()}
    assert got["2026-05-10"] == 1 and got["2026-05-30"] == 1 and got["2026-05-31"] == 0 and got["2026-06-02"] == 0


@pytest.mark.parametrize("grain", ["day", "week", "month", "quarter"])
def test_backlog_equals_definition(spark, grain):
    rnd = random.Random(5)
    start = dt.date(2026, 1, 1)
    rows = []
    for i in range(300):
        created = start + dt.timedelta(days=rnd.randrange(200)) if rnd.random() > 0.03 else None
        closed = start + dt.timedelta(days=rnd.randrange(220)) if rnd.random() > 0.3 else None
        rows.append((created, closed, None, "hot" if rnd.random() < 0.4 else rnd.choice("abc")))
    as_of = dt.date(2026, 6, 12)
    fact = issues(spark, rows, as_of)
    got = series.backlog_series(fact, as_of, grain, ["assignee"]).collect()
    length = {"day": 1, "week": 7}
    for r in got:
        first = r[grain]
        if grain in length:
            after = first + dt.timedelta(days=length[grain])
        else:
            after = periods.add_months(first, 1 if grain == "month" else 3)
        end = min(after - dt.timedelta(days=1), as_of)
        wanted = sum(w == r.assignee and c is not None and c <= end and (x is None or x > end) for c, x, _, w in rows)
        assert r.open == wanted, (r, end)
    assert max(r[grain] for r in got) <= as_of and len({(r.assignee, r[grain]) for r in got}) == len(got)


def test_moving_volume_on_sparse_months(spark):
    rows = [("01-05", None)] * 3 + [("03-05", None)] * 6
    got = {f"{r.month:%m}": r.created for r in series.moving_volume(
        issues(spark, rows), {"created": "created_at"}, end="2026-05-31").collect()}
    assert got == {"01": 1.0, "02": 1.0, "03": 3.0, "04": 2.0, "05": 2.0}


def test_moving_average_weighs_rows(spark):
    rows = [("01-01", "01-10")] + [("03-01", "03-02")] * 3
    got = {f"{r.month:%m}": r.v for r in series.moving_average(
        issues(spark, rows), {"v": (F.col("days_to_close"), None)}).collect()}
    assert got["03"] == 4.0 and got["02"] == 10.0


def test_lifecycle_filters(spark):
    rows = [("03-05", "03-10", "03-06"), ("03-05", "03-10", "03-01"), ("03-05", "03-07", None)]
    row = series.lifecycle_averages(issues(spark, rows)).filter(F.col("month") == "2026-03-01").first()
    assert row.created_to_closed == pytest.approx((6 + 6 + 3) / 3)
    assert row.created_to_started == 2.0
    assert row.started_to_closed == pytest.approx(((6 - 2) + (6 - -3)) / 2)


def test_with_previous(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 3.0), (3, 0.0), (4, 1.0)], "i int, v double")
    assert [r.change for r in series.with_previous(df, "v", "i").orderBy("i").collect()] == [None, 0.5, -1.0, None]
    assert [r.change for r in series.with_previous(df, "v", "i", kind="difference").orderBy("i").collect()] == [
        None, 1.0, -3.0, 1.0]


def test_reports(spark):
    rows = [("03-02", "04-03", None, "ann", "Alpha"), ("05-04", None, None, "bob", "Beta"), ("06-01", "06-03", None, None, None),
            ("06-02", None, None, "ann", "Alpha", True)]
    fact = issues(spark, rows)
    overview = {f"{r.month:%m}": tuple(r)[1:] for r in reports.overview_series(fact, AS_OF).collect()}
    assert overview == {"03": (1, 0, 1), "04": (0, 1, 0), "05": (1, 0, 1), "06": (2, 1, 2)}
    table = {r.assignee: tuple(r)[1:] for r in reports.assignee_table(fact, "2026-06-01", "2026-06-30").collect()}
    assert table == {"ann": (1, 0, 1, None, 1), "Unassigned": (1, 1, 0, 3.0, 0), "bob": (0, 0, 1, None, 0)}
    assert {r.project_group: r["count"] for r in reports.project_volume(fact).collect()} == {
        "Alpha": 2, "Other": 1, "Unassigned": 1}
    assert [r.identifier for r in reports.open_issue_list(fact).collect()] == ["I-1", "I-3"]
    matrix = {r.assignee: r.asDict() for r in reports.assignee_matrix(fact, AS_OF, 3, excluded=["bob"]).collect()}
    assert set(matrix) == {"ann", "Unassigned"} and matrix["ann"]["created_2026_06"] == 1
    assert matrix["ann"]["closed_2026_04"] == 1 and matrix["Unassigned"]["closed_2026_06"] == 1
    wide = reports.assignee_week_flow(fact, weeks=["2026-W23"]).collect()
    assert {r.assignee: r["2026-W23_created"] for r in wide} == {"ann": 1, "Unassigned": 1, "bob": None}
    assert [tuple(r) for r in reports.tooltip_weekly(fact, "ann").orderBy("year_week").collect()] == [
        ("2026-W10", 1, 0), ("2026-W14", 0, 1), ("2026-W23", 1, 0)]
    assert m.top_assignee(fact).first().assignee == "ann"


def test_summary_is_one_row(spark):
    s = reports.summary(tickets(spark, [(17, "06-01", "06-02", None, None)]), issues(spark, [("06-01", "06-03")]), AS_OF)
    row = s.collect()
    assert len(row) == 1 and (row[0].issue_created, row[0].ticket_waiting, row[0].ticket_escalation_rate) == (1, 1, 1.0)


def test_person_measures(spark):
    df = spark.createDataFrame([("1", "ann", "Done"), ("1", "ann", "Done"), ("2", "bob", "Todo"), (None, None, "Done")],
                               "assignee_id string, assignee_name string, state_name string")
    people = m.person_dim(df)
    assert people.count() == 2
    assert [tuple(r) for r in m.done_per_person(df, people).collect()] == [("ann", 2)]
