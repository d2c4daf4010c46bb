"""Every operator as a query over the test tables, with the SQL its result must equal.

Results show dates as text and doubles rounded to six places, so both engines
compare without regard to their own date and float types.
"""

from pyspark.sql import DataFrame, Window, functions as F, types as T

from flowtide import codes, schemas
from flowtide.functions import dates, labels, periods, text
from flowtide.operators import calendar, cube, current, history, joins, measures as m, profiling, quality, series
from flowtide.plans import reports
from flowtide.session import scratch_dir
from flowtide.sources import ingest, marks, readers, sinks
from flowtide.streaming import ingest as stream
from flowtide.workload import adapters as a

QUERIES = {}
ORACLE = {}


def present(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            out.append(f"CAST(`{f.name}` AS STRING) AS `{f.name}`")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(f"round(`{f.name}`, 6) AS `{f.name}`")
        else:
            out.append(f"`{f.name}`")
    return df.selectExpr(*out)


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = lambda spark, sf: present(fn(spark, sf))
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return register


def d(*cols):
    """SQL: date columns as text."""
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in cols)


def r(expr, name):
    return f"round(CAST({expr} AS DOUBLE), 6) AS {name}"


def n(expr, name):
    return f"CAST({expr} AS BIGINT) AS {name}"


# ---------------------------------------------------------------- tickets

@query("ticket_latest", f"""WITH {a.TH}, x AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC, pos DESC) AS rn FROM th)
SELECT id, status, subject, updated_at, group_id, product_id, pos FROM x WHERE rn = 1""")
def _(spark, sf):
    return history.latest_version(
        a.ticket_history(spark, sf), order=a.TICKET_ORDER,
        columns=["status", "subject", "updated_at", "group_id", "product_id", "pos"])


@query("ticket_silver", f"""WITH {a.TICKETS}
SELECT id, status, {d('created_at', 'updated_at')}, product_id, {d('first_waiting_at', 'first_passed_at')},
  denied_triage, {d('denied_triage_at')} FROM tickets""")
def _(spark, sf):
    return a.tickets(spark, sf)


@query("ticket_silver_filter_after", f"""WITH {a.TICKETS},
last AS (SELECT DISTINCT ON (id) * FROM th ORDER BY id, updated_at DESC, pos DESC)
SELECT id, status, created_at[:10] AS created_at, updated_at[:10] AS updated_at, product_id,
  waited[:10] AS first_waiting_at, passed[:10] AS first_passed_at, t IS NOT NULL AS denied_triage, t[:10] AS denied_triage_at
FROM last JOIN firsts USING (id) LEFT JOIN back USING (id) WHERE group_id IS NULL OR group_id % 10 <> 3""")
def _(spark, sf):
    return current.current_tickets(
        a.ticket_history(spark, sf), suffixes=a.SUFFIXES, order=a.TICKET_ORDER, filter_after=True)


@query("ticket_fact", f"""WITH {a.TICKETS}
SELECT id, status, status_label, triage_status, {d('created_at', 'first_waiting_at')}, denied_triage FROM tf""")
def _(spark, sf):
    return a.ticket_fact(spark, sf).select(
        "id", "status", "status_label", "triage_status", "created_at", "first_waiting_at", "denied_triage")


@query("ticket_triage_counts", f"""WITH {a.TICKETS}
SELECT triage_status, status_label, {n('count(*)', 'tickets')} FROM tf GROUP BY triage_status, status_label""")
def _(spark, sf):
    return a.ticket_fact(spark, sf).groupBy("triage_status", "status_label").agg(F.count("*").alias("tickets"))


@query("ticket_load_report", f"""WITH {a.TICKETS}
SELECT {n('count(*)', 'total')}, {n('count(*) FILTER (status = 17)', 'waiting')},
  {n('count(*) FILTER (status IN (6, 7, 12))', 'passed')}, {n('count(*) FILTER (denied_triage)', 'denied')}
FROM tickets""")
def _(spark, sf):
    return current.ticket_load_report(a.tickets(spark, sf))


@query("first_in_state", f"""WITH {a.TH}
SELECT id, min(updated_at) AS first_at FROM th WHERE status IN (6, 7, 12) GROUP BY id""")
def _(spark, sf):
    return history.first_in_state(a.ticket_history(spark, sf), codes.PASSED_CODES)


@query("first_regression", f"""WITH {a.TICKETS} SELECT id, t[:10] AS regressed_on FROM back""")
def _(spark, sf):
    return history.first_regression(a.ticket_history(spark, sf), codes.PASSED_CODES, codes.WAITING_CODES)


@query("high_water_mark", f"""WITH {a.SNAPSHOTS}
SELECT id, coalesce(max(updated_at), '') AS high_water FROM sn GROUP BY id""")
def _(spark, sf):
    return history.high_water_mark(a.ticket_snapshots(spark, sf))


@query("ticket_transitions", f"""WITH {a.TH},
s AS (SELECT *, lag(status) OVER w AS before, row_number() OVER w AS rn FROM th
      WINDOW w AS (PARTITION BY id ORDER BY updated_at, pos)),
c AS (SELECT * FROM s WHERE rn = 1 OR before <> status)
SELECT id, before AS previous_status, status, updated_at AS valid_from,
  lead(updated_at) OVER (PARTITION BY id ORDER BY updated_at, pos) AS valid_to FROM c""")
def _(spark, sf):
    return history.state_transitions(a.ticket_history(spark, sf), order=a.TICKET_ORDER)


@query("issue_transitions", f"""WITH {a.IH},
s AS (SELECT *, lag(state_type) OVER w AS before, row_number() OVER w AS rn FROM ih
      WINDOW w AS (PARTITION BY id ORDER BY updated_at, pos, part, supplier)),
c AS (SELECT * FROM s WHERE rn = 1 OR before <> state_type)
SELECT id, before AS previous_state_type, state_type, updated_at AS valid_from,
  lead(updated_at) OVER (PARTITION BY id ORDER BY updated_at, pos, part, supplier) AS valid_to FROM c""")
def _(spark, sf):
    return history.state_transitions(a.issue_history(spark, sf), state="state_type", order=a.ISSUE_ORDER)


def _ticket_kpis_sql(s, e, ps, pe):
    def cnt(role, extra=""):
        return [f"count(*) FILTER ({role} BETWEEN DATE '{x}' AND DATE '{y}'{extra})" for x, y in ((s, e), (ps, pe))]

    (c, cp), (w, wp), (p, pp) = cnt("created_at"), cnt("first_waiting_at"), cnt("first_passed_at")
    x, xp = cnt("created_at", " AND first_waiting_at IS NOT NULL")
    dn, dp = cnt("denied_triage_at", " AND denied_triage")
    rate, ratep = f"{x} / nullif(CAST({c} AS DOUBLE), 0)", f"{xp} / nullif(CAST({cp} AS DOUBLE), 0)"
    cols = []
    for name, now, before in (("created", c, cp), ("waiting", w, wp), ("passed", p, pp)):
        cols += [n(now, name), n(before, name + "_prev"),
                 r(f"({now} - {before}) / nullif(CAST({before} AS DOUBLE), 0)", name + "_change")]
    cols += [n(x, "escalated"), n(xp, "escalated_prev"), r(rate, "escalation_rate"),
             r(ratep, "escalation_rate_prev"), r(f"{rate} - {ratep}", "escalation_rate_change")]
    cols += [n(dn, "denied"), n(dp, "denied_prev"), n(f"{dn} - {dp}", "denied_change")]
    return ", ".join(cols)


TICKET_WEEK = ("2024-01-15", "2024-01-21", "2024-01-08", "2024-01-14")
TICKET_MONTH = ("2024-01-01", "2024-01-31", "2023-12-01", "2023-12-31")


@query("ticket_kpis_week", f"WITH {a.TICKETS} SELECT {_ticket_kpis_sql(*TICKET_WEEK)} FROM tf")
def _(spark, sf):
    return m.ticket_kpis(a.ticket_fact(spark, sf), a.TICKET_AS_OF, "week")


@query("ticket_kpis_month", f"WITH {a.TICKETS} SELECT {_ticket_kpis_sql(*TICKET_MONTH)} FROM tf")
def _(spark, sf):
    return m.ticket_kpis(a.ticket_fact(spark, sf), a.TICKET_MONTH_AS_OF, "month")


@query("ticket_kpis_by_product", f"WITH {a.TICKETS} SELECT product_id, {_ticket_kpis_sql(*TICKET_WEEK)} "
       "FROM tf GROUP BY product_id")
def _(spark, sf):
    return m.ticket_kpis(a.ticket_fact(spark, sf), a.TICKET_AS_OF, "week", by=["product_id"])


LONGEST = f"date_diff('day', min(first_waiting_at) FILTER (triage_status = 'Waiting'), DATE '{a.TICKET_AS_OF}')"
OVER = (f"count(*) FILTER (triage_status = 'Waiting' AND "
        f"date_diff('day', first_waiting_at, DATE '{a.TICKET_AS_OF}') > $N)")


@query("ticket_page", f"""WITH {a.TICKETS} SELECT {_ticket_kpis_sql(*TICKET_WEEK)},
  CAST({LONGEST} AS INTEGER) AS waited_longest, {n(OVER.replace('$N', '10'), 'waiting_over')} FROM tf""")
def _(spark, sf):
    return reports.ticket_page(a.ticket_fact(spark, sf), a.TICKET_AS_OF, days=10)


@query("ticket_waited_longest", f"""WITH {a.TICKETS}
SELECT product_id, CAST({LONGEST} AS INTEGER) AS waited_longest FROM tf GROUP BY product_id""")
def _(spark, sf):
    p = periods.period_bounds(a.TICKET_AS_OF)
    return m.measure_table(a.ticket_fact(spark, sf), [m.waited_longest(p)], ["product_id"])


@query("ticket_waiting_over_threshold", f"""WITH {a.TICKETS}
SELECT {n(OVER.replace('$N', '5'), 'waiting_over')} FROM tf""")
def _(spark, sf):
    p = periods.period_bounds(a.TICKET_AS_OF)
    return m.measure_table(a.ticket_fact(spark, sf), [m.waiting_over(p, 5)])


def _escalation_sql(grain):
    return f"""WITH {a.TICKETS}
SELECT CAST(CAST(date_trunc('{grain}', created_at) AS DATE) AS VARCHAR) AS {grain}, {n('count(*)', 'created')},
  {r('100.0 * count(first_waiting_at) / count(*)', 'escalation_rate')} FROM tf
WHERE created_at IS NOT NULL GROUP BY 1"""


@query("ticket_escalation_monthly", _escalation_sql("month"))
def _(spark, sf):
    return series.escalation_rate_series(a.ticket_fact(spark, sf))


@query("ticket_escalation_weekly", _escalation_sql("week"))
def _(spark, sf):
    return series.escalation_rate_series(a.ticket_fact(spark, sf), "week")


@query("ticket_inflow_daily", f"""WITH {a.TICKETS}
SELECT CAST(created_at AS VARCHAR) AS date, {n('count(*)', 'created')} FROM tickets
WHERE created_at IS NOT NULL GROUP BY created_at""")
def _(spark, sf):
    return m.inflow_daily(a.tickets(spark, sf))


@query("ticket_role_counts", f"""WITH {a.TICKETS}
SELECT {", ".join(n(f"count(*) FILTER ({c} BETWEEN DATE '2024-01-15' AND DATE '2024-01-21')", c)
                  for c in ("created_at", "first_waiting_at", "first_passed_at"))} FROM tickets""")
def _(spark, sf):
    return m.role_counts(a.tickets(spark, sf), ["created_at", "first_waiting_at", "first_passed_at"],
                         "2024-01-15", "2024-01-21")


@query("snapshot_status_counts", f"""WITH {a.TH}
SELECT CAST(snapshot_ts AS VARCHAR) AS snapshot_ts,
  {n('count(*) FILTER (status IN (17, 6, 23))', 'waiting_for_triage')},
  {n('count(*) FILTER (status IN (12, 7))', 'post_triage')}, {n('count(*) FILTER (status = 7)', 'escalated')}
FROM th GROUP BY snapshot_ts""")
def _(spark, sf):
    return m.snapshot_status_counts(a.ticket_history(spark, sf))


@query("triage_stage", f"""WITH {a.TH}
SELECT CASE WHEN status IN (17, 6, 23) THEN 'WaitingForTriage' WHEN status IN (12, 7) THEN 'PostTriage'
  ELSE 'Unknown' END AS stage, {n('count(*)', 'versions')} FROM th GROUP BY 1""")
def _(spark, sf):
    return a.ticket_history(spark, sf).groupBy(labels.triage_stage("status").alias("stage")).agg(
        F.count("*").alias("versions"))


@query("status_dimension", f"""WITH {a.TH}, s(status, status_name) AS (
  VALUES (2, 'Open'), (6, 'Available'), (7, 'Escalation'), (12, 'Investigate'), (17, 'New case'))
SELECT status_name, {n('count(*)', 'versions')}, {n('count(DISTINCT id)', 'tickets')}
FROM th JOIN s USING (status) GROUP BY status_name""")
def _(spark, sf):
    dim = joins.status_dimension(spark, codes.STATUS_DIMENSION)
    # Count per id and status first, so the few status values never collect raw rows.
    counted = a.ticket_history(spark, sf).groupBy("status", "id").agg(F.count("*").alias("n"))
    per_status = counted.groupBy("status").agg(F.sum("n").alias("versions"), F.count("*").alias("tickets"))
    return joins.with_dimension(per_status, dim, "status").select("status_name", "versions", "tickets")


@query("suffix_filter", f"""WITH {a.TH}
SELECT id, group_id, pos FROM th WHERE group_id IS NULL
  OR (right(CAST(group_id AS VARCHAR), 4) NOT IN ('1939', '8846') AND right(CAST(group_id AS VARCHAR), 1) <> '3')""")
def _(spark, sf):
    suffixes = (*codes.EXCLUDED_GROUP_SUFFIXES, *a.SUFFIXES)
    return current.drop_suffix(a.ticket_history(spark, sf), "group_id", suffixes).select("id", "group_id", "pos")


@query("uniform_time", """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS t FROM events""")
def _(spark, sf):
    # Every second time is cut to whole seconds where that loses nothing.
    mixed = "CASE WHEN event_id % 2 = 0 THEN concat(replace(CAST(ts AS STRING), ' ', 'T'), 'Z') " \
            "ELSE date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\") END AS t"
    return a.table(spark, sf, "events").selectExpr("event_id", mixed).withColumn("t", dates.uniform_time("t"))


@query("window_filter", f"""WITH {a.TH}
SELECT id, updated_at, pos FROM th WHERE left(updated_at, 10) >= '2024-01-10' AND left(updated_at, 10) < '2024-01-17'""")
def _(spark, sf):
    return joins.in_window(a.ticket_history(spark, sf), "updated_at", "2024-01-10", "2024-01-17").select(
        "id", "updated_at", "pos")


# ---------------------------------------------------------------- ingest

@query("snapshot_replay", f"WITH {a.SNAPSHOTS} SELECT * FROM loaded")
def _(spark, sf):
    return history.replay_snapshots(a.ticket_snapshots(spark, sf))


@query("snapshot_incremental", f"""WITH {a.SNAPSHOTS}
SELECT * FROM loaded WHERE _snapshot_file >= 'tickets_snapshot_20240111'""")
def _(spark, sf):
    rows = a.ticket_snapshots(spark, sf)
    pending = F.col("_snapshot_file") >= "tickets_snapshot_20240111"
    stored = history.high_water_mark(rows.filter(~pending))
    return history.replay_snapshots(rows.filter(pending), stored)


@query("newer_only", f"""WITH {a.SNAPSHOTS},
old AS (SELECT id, coalesce(max(updated_at), '') AS hw FROM sn
        WHERE _snapshot_file < 'tickets_snapshot_20240130' GROUP BY id)
SELECT sn.id, updated_at, status, pos, _snapshot_file FROM sn LEFT JOIN old ON old.id = sn.id
WHERE _snapshot_file >= 'tickets_snapshot_20240130' AND (hw IS NULL OR coalesce(updated_at, '') > hw)""")
def _(spark, sf):
    rows = a.ticket_snapshots(spark, sf)
    last = F.col("_snapshot_file") >= "tickets_snapshot_20240130"
    return history.newer_only(rows.filter(last), history.high_water_mark(rows.filter(~last)))


@query("import_log", f"""WITH {a.SNAPSHOTS}, files AS (SELECT DISTINCT _snapshot_file AS file_name FROM sn),
k AS (SELECT _snapshot_file AS file_name, count(*) AS c FROM loaded GROUP BY 1)
SELECT 'tickets' AS source, file_name, {n('coalesce(c, 0)', 'row_count')},
  '2024-02-01 00:00:00' AS imported_at FROM files LEFT JOIN k USING (file_name)""")
def _(spark, sf):
    rows = a.ticket_snapshots(spark, sf)
    files = rows.select(F.col("_snapshot_file").alias("file_name")).distinct()
    kept = history.replay_snapshots(rows).withColumn("_source_file", F.col("_snapshot_file"))
    return sinks.file_counts(files, kept, "tickets", "2024-02-01 00:00:00")


def _land(spark, sf, keep="true", folder=None):
    """Write the nightly files, or those that ``keep`` picks, as JSON Lines folders below a scratch folder."""
    folder = folder or scratch_dir(spark)
    rows = a.ticket_snapshots(spark, sf).select(
        "id", F.lit("s").alias("subject"), "status", "updated_at", F.col("pos").alias("product_id"),
        F.col("_snapshot_file").alias("f")).filter(keep)
    rows.write.partitionBy("f").mode("append").option("pathGlobFilter", "*").json(f"{folder}/raw")
    return folder


LOADED = f"WITH {a.SNAPSHOTS} SELECT id, updated_at, status, pos AS product_id, _snapshot_file FROM loaded"
LOADED_COLUMNS = ["id", "updated_at", "status", "product_id", "_snapshot_file"]


@query("ingest_files", LOADED)
def _(spark, sf):
    folder = _land(spark, sf)
    ingest.load_files(spark, ingest.TICKETS, f"{folder}/raw", f"{folder}/history", f"{folder}/log",
                      "2024-02-01 00:00:00", multi_line=False)
    return sinks.read_or_empty(spark, f"{folder}/history", sinks.history_schema(schemas.TICKET_HISTORY)).select(
        *LOADED_COLUMNS)


@query("ingest_stream", LOADED)
def _(spark, sf):
    folder = _land(spark, sf)
    rows = stream.ingest_stream(spark, ingest.TICKETS, f"{folder}/raw", multi_line=False)
    run = stream.write_history(rows, ingest.TICKETS, f"{folder}/history", f"{folder}/log",
                               f"{folder}/checkpoint", "2024-02-01 00:00:00")
    run.awaitTermination()
    return sinks.read_or_empty(spark, f"{folder}/history", sinks.history_schema(schemas.TICKET_HISTORY)).select(
        *LOADED_COLUMNS)


@query("split_arrays", f"""WITH {a.SNAPSHOTS} SELECT id, updated_at, status, pos AS product_id,
  '}}, {{"id": ' || pos || ' \\"[' AS subject, _snapshot_file FROM sn""")
def _(spark, sf):
    """Nightly files as JSON arrays, one array a file, whose strings hold brackets and quotes."""
    folder = scratch_dir(spark)
    subject = F.concat(F.lit('}, {"id": '), F.col("pos").cast("string"), F.lit(' \\"['))
    place = Window.partitionBy("f").orderBy("pos")
    rows = a.ticket_snapshots(spark, sf).select(
        F.col("_snapshot_file").alias("f"), "pos",
        F.to_json(F.struct("id", subject.alias("subject"), "status", "updated_at", F.col("pos").alias("product_id")))
        .alias("item"))
    first, last = F.row_number().over(place) == 1, F.lead("pos").over(place).isNull()
    lines = rows.select("f", F.concat(F.when(first, "[").otherwise(","), "item", F.when(last, "]").otherwise("")))
    lines.write.partitionBy("f").text(f"{folder}/raw")
    return readers.read_tickets(spark, f"{folder}/raw", "split").select(
        "id", "updated_at", "status", "product_id", "subject", "_snapshot_file")


#: Name ranges of the nightly files that land one after the other.
NIGHTS = ("f < 'tickets_snapshot'", "f BETWEEN 'tickets_snapshot' AND 'tickets_snapshot_20240115'",
          "f > 'tickets_snapshot_20240115'")


@query("ingest_loads", LOADED)
def _(spark, sf):
    """Three loads one after the other: marks of the former ones come from the marks table."""
    folder = scratch_dir(spark)
    for some in NIGHTS:
        _land(spark, sf, some, folder)
        ingest.load_files(spark, ingest.TICKETS, f"{folder}/raw", f"{folder}/history", f"{folder}/log",
                          "2024-02-01 00:00:00", multi_line=False)
    return sinks.read_or_empty(spark, f"{folder}/history", sinks.history_schema(schemas.TICKET_HISTORY)).select(
        *LOADED_COLUMNS)


@query("ingest_stream_batches", LOADED)
def _(spark, sf):
    """Micro-batches of three files, loaded twelve snapshots at a time, in name order."""
    folder = _land(spark, sf)
    rows = stream.ingest_stream(spark, ingest.TICKETS, f"{folder}/raw", multi_line=False, max_files=3)
    stream.write_history(rows, ingest.TICKETS, f"{folder}/history", f"{folder}/log", f"{folder}/checkpoint",
                         "2024-02-01 00:00:00", most=12).awaitTermination()
    return sinks.read_or_empty(spark, f"{folder}/history", sinks.history_schema(schemas.TICKET_HISTORY)).select(
        *LOADED_COLUMNS)


@query("newer_only_stream", LOADED)
def _(spark, sf):
    """The rule with a state per id, over three runs of a stream."""
    folder = scratch_dir(spark)
    for some in NIGHTS:
        _land(spark, sf, some, folder)
        rows = stream.ingest_stream(spark, ingest.TICKETS, f"{folder}/raw", multi_line=False)
        kept = stream.newer_only_stream(rows).select(*LOADED_COLUMNS)
        kept.writeStream.format("parquet").option("path", f"{folder}/kept").option(
            "checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/kept")


@query("marks_table", f"""WITH {a.SNAPSHOTS}
SELECT id, max(coalesce(updated_at, '')) AS high_water FROM sn GROUP BY id""")
def _(spark, sf):
    """Marks per id, folded in by three parts of the files."""
    table = marks.Marks(spark, f"{scratch_dir(spark)}/marks", T.LongType())
    rows = a.ticket_snapshots(spark, sf).withColumn("f", F.col("_snapshot_file"))
    for i, some in enumerate(NIGHTS):
        table = table.fold(rows.filter(some), [f"part {i}"])
    return table.read()


@query("backfill_merge_latest", f"""WITH {a.SNAPSHOTS}, x AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY coalesce(updated_at, '') DESC, _snapshot_file, pos) AS rn
  FROM sn) SELECT id, updated_at, status, pos, _snapshot_file FROM x WHERE rn = 1""")
def _(spark, sf):
    return history.merge_latest(a.ticket_snapshots(spark, sf), order=("_snapshot_file", "pos"))


@query("month_windows", """WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi
  FROM orders),
w AS (SELECT CAST(unnest(generate_series(date_trunc('month', lo), CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE)
  AS window_start, hi FROM b),
v AS (SELECT window_start, least(CAST(window_start + INTERVAL 1 MONTH AS DATE), hi + 1) AS window_end FROM w)
SELECT CAST(window_start AS VARCHAR) AS window_start, CAST(window_end AS VARCHAR) AS window_end,
  CAST(count(o_orderkey) AS BIGINT) AS orders
FROM v LEFT JOIN orders ON o_orderdate >= window_start AND o_orderdate < window_end GROUP BY 1, 2""")
def _(spark, sf):
    o = a.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    lo, hi = o.agg(F.min("day"), F.max("day")).first()
    per_month = o.groupBy(dates.month_start("day").alias("window_start")).agg(F.count("*").alias("orders"))
    return readers.month_windows(spark, lo, hi).join(per_month, "window_start", "left").fillna(0, ["orders"])


@query("retention_expired", f"""WITH {a.SNAPSHOTS}
SELECT DISTINCT _snapshot_file AS file_name FROM sn WHERE _snapshot_file LIKE 'tickets_snapshot_%'
  AND strptime(substr(_snapshot_file, 18, 16), '%Y%m%dT%H%M%SZ') < TIMESTAMP '2024-04-15' - INTERVAL 90 DAY""")
def _(spark, sf):
    files = a.ticket_snapshots(spark, sf).select(F.col("_snapshot_file").alias("file_name")).distinct()
    return readers.expired_snapshots(files, "2024-04-15", codes.RETENTION_DAYS)


@query("retention_drops", f"""WITH {a.SNAPSHOTS}
SELECT DISTINCT _snapshot_file AS file_name FROM sn WHERE NOT contains(_snapshot_file, '_snapshot_')
  OR strptime(substr(_snapshot_file, 18, 16), '%Y%m%dT%H%M%SZ') >= TIMESTAMP '2024-04-15' - INTERVAL 90 DAY
  OR _snapshot_file = 'tickets_snapshot_20240103T001500Z.json'""")
def _(spark, sf):
    """What is left of the nightly files: expired ones go, unless they are no snapshots or not logged yet."""
    folder = _land(spark, sf)
    listed = readers.list_files(spark, f"{folder}/raw", "tickets")
    log = listed.filter("file_name <> 'tickets_snapshot_20240103T001500Z.json'")
    sinks.drop_expired(spark, listed, log, "2024-04-15", codes.RETENTION_DAYS)
    return readers.list_files(spark, f"{folder}/raw", "tickets").select("file_name")


@query("load_reconciliation", f"""WITH {a.SNAPSHOTS},
c AS (SELECT _snapshot_file AS file_name, count(*) AS arrived, count(*) - count(DISTINCT id) AS duplicates FROM sn GROUP BY 1),
k AS (SELECT _snapshot_file AS file_name, count(*) AS kept FROM loaded GROUP BY 1),
x AS (SELECT file_name, arrived + CASE WHEN arrived % 3 = 0 THEN 1 ELSE 0 END AS fetched, arrived, duplicates,
  coalesce(kept, 0) AS logged FROM c LEFT JOIN k USING (file_name))
SELECT file_name, CAST(fetched AS BIGINT) AS fetched, arrived, duplicates, CAST(logged AS BIGINT) AS logged,
  CAST(logged AS BIGINT) AS stored, CASE WHEN fetched <> arrived THEN 'not as fetched' END AS fault FROM x""")
def _(spark, sf):
    """Sidecars, arrivals, log and history of one load, some sidecars with one row more than came."""
    folder = _land(spark, sf)
    rows = a.ticket_snapshots(spark, sf).groupBy("_snapshot_file").agg(F.count("*").alias("c"))
    sidecars = rows.select((F.col("c") + F.when(F.col("c") % 3 == 0, 1).otherwise(0)).alias("total_tickets"),
                           F.regexp_replace("_snapshot_file", r"\.json$", ".meta.json").alias("f"))
    sidecars.write.partitionBy("f").mode("append").json(f"{folder}/raw")
    ingest.load_files(spark, ingest.TICKETS, f"{folder}/raw", f"{folder}/history", f"{folder}/log",
                      "2024-02-01 00:00:00", multi_line=False)
    return quality.load_reconciliation(
        readers.read_manifest(spark, f"{folder}/raw"), sinks.arrivals(spark, f"{folder}/log_arrivals"),
        sinks.read_or_empty(spark, f"{folder}/log", schemas.IMPORT_LOG),
        sinks.read_or_empty(spark, f"{folder}/history", sinks.history_schema(schemas.TICKET_HISTORY)))


@query("field_drift", """WITH k AS (SELECT unnest(json_keys(props)) AS field FROM events),
f AS (SELECT field, count(*) AS found FROM k GROUP BY field)
SELECT coalesce(f.field, w.field) AS field, CAST(coalesce(found, 0) AS BIGINT) AS found,
  (SELECT count(*) FROM events WHERE props IS NOT NULL) AS objects, CASE WHEN w.field IS NULL THEN 'added'
  WHEN found IS NULL THEN 'removed' WHEN found < (SELECT count(*) FROM events WHERE props IS NOT NULL) THEN 'partial' END AS drift
FROM f FULL JOIN (VALUES ('gone')) w(field) ON w.field = f.field""")
def _(spark, sf):
    return quality.field_drift(a.table(spark, sf, "events"), "props", ["gone"])


@query("blank_times", """SELECT event_id, CASE WHEN event_id % 7 > 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS at FROM events""")
def _(spark, sf):
    """Blank times and missing ones are the same."""
    times = "CASE event_id % 7 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") END AS at"
    rows = a.table(spark, sf, "events").selectExpr("event_id", times)
    return rows.select("event_id", text.blank_to_null("at").alias("at"))


@query("date_formats", """SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, strftime(o_orderdate, '%d.%m.%Y') AS dotted,
  strftime(o_orderdate, '%y-%j') AS day_of_year FROM orders""")
def _(spark, sf):
    return a.table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").cast("string").alias("day"),
        dates.format_date("o_orderdate", "dd.MM.yyyy").alias("dotted"),
        dates.format_date("o_orderdate", "yy-DDD").alias("day_of_year")).distinct()


@query("months_in_order", """SELECT monthname(o_orderdate) AS month_name, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS
  month_sort, count(*) AS orders FROM orders GROUP BY ALL ORDER BY month_sort""")
def _(spark, sf):
    """Month names in calendar order, by the key carried beside them."""
    rows = a.table(spark, sf, "orders").groupBy(
        dates.month_name("o_orderdate").alias("month_name"), dates.month_sort("o_orderdate").alias("month_sort")).agg(
        F.count("*").alias("orders"))
    return joins.order_by_sort_key(rows, "month_sort")


@query("gated_counts", """SELECT event_type, count(*) AS events FROM events GROUP BY event_type""")
def _(spark, sf):
    """Counts that are only made of a table that has rows."""
    return quality.require_rows(a.table(spark, sf, "events"), "events").groupBy("event_type").agg(F.count("*").alias("events"))


@query("plan_files", f"""WITH {a.SNAPSHOTS}, f AS (SELECT DISTINCT _snapshot_file AS file_name FROM sn)
SELECT file_name, contains(file_name, '_snapshot_') AS incremental,
  CASE WHEN contains(file_name, '_snapshot_')
       THEN strftime(strptime(substr(file_name, 18, 16), '%Y%m%dT%H%M%SZ'), '%Y-%m-%d %H:%M:%S') END AS snapshot_ts
FROM f WHERE file_name > 'tickets_snapshot_20240110T001500Z.json'""")
def _(spark, sf):
    files = a.ticket_snapshots(spark, sf).select(F.col("_snapshot_file").alias("file_name")).distinct()
    log = files.filter(F.col("file_name") <= "tickets_snapshot_20240110T001500Z.json")
    return readers.plan_files(files, log)


@query("json_extract", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  json_extract_string(props, '$.absent') AS absent FROM events""")
def _(spark, sf):
    return a.table(spark, sf, "events").select(
        "event_id", text.json_path("props", "$.k", "long").alias("k"), text.json_path("props", "$.absent").alias("absent"))


@query("explode_json", """SELECT event_id, CAST(pos AS INTEGER) AS pos, CAST(k AS BIGINT) AS k FROM (
  SELECT event_id, 0 AS pos, json_extract_string(props, '$.k') AS k FROM events
  UNION ALL SELECT event_id, 1, CAST(event_id AS VARCHAR) FROM events)""")
def _(spark, sf):
    e = a.table(spark, sf, "events")
    array = F.concat(F.lit("["), "props", F.lit(', {"k": '), F.col("event_id").cast("string"), F.lit("}]"))
    return readers.explode_json(e.select("event_id", array.alias("raw")), "raw", "struct<k:bigint>")


@query("raw_json", """SELECT page_id, '{"id":' || page_id || ',"n":' || length(html) || '}' AS raw FROM pages""")
def _(spark, sf):
    return a.table(spark, sf, "pages").select(
        "page_id", text.raw_json(F.struct(F.col("page_id").alias("id"), F.length("html").alias("n"))).alias("raw"))


@query("flatten_issue", f"""WITH {a.IH}
SELECT id, identifier, title, state_name, state_type, priority, project_name, assignee_name, team_name,
  updated_at, labels, pos, part, supplier FROM ih""")
def _(spark, sf):
    h = a.issue_history(spark, sf)
    as_struct = lambda **f: F.struct(*[F.col(c).alias(k) if c else F.lit(None).cast("string").alias(k)
                                       for k, c in f.items()])
    null = lambda t="string": F.lit(None).cast(t)
    nodes = F.transform(F.split("labels", r"\|"), lambda x: F.struct(x.alias("name")))
    nested = h.select(
        "id", null("int").alias("number"), "identifier", "title", null().alias("description"),
        F.col("created_at").alias("createdAt"), F.col("updated_at").alias("updatedAt"), null().alias("archivedAt"),
        F.col("completed_at").alias("completedAt"), F.col("canceled_at").alias("canceledAt"),
        F.col("started_at").alias("startedAt"), null().alias("dueDate"), "priority", null("double").alias("estimate"),
        "trashed", as_struct(id=None, name="state_name", type="state_type").alias("state"),
        as_struct(id=None, name="assignee_name", email=None).alias("assignee"),
        as_struct(id=None, name="project_name").alias("project"),
        F.when(F.col("team_name").isNotNull(), as_struct(id=None, name="team_name")).alias("team"),
        F.struct(nodes.alias("nodes")).alias("labels"),
        as_struct(id=None, identifier=None).alias("parent"),
        as_struct(id=None, name=None, startsAt=None, endsAt=None).alias("cycle"),
        F.struct("pos", "part", "supplier").alias("_pos"))
    flat = readers.flatten_issue(nested)
    return flat.select("id", "identifier", "title", "state_name", "state_type", "priority", "project_name",
                       "assignee_name", "team_name", "updated_at", "labels", "_pos.*")


@query("labels_join", """SELECT p_partkey, concat_ws('|', p_name, p_type, CASE WHEN p_size > 25 THEN p_brand END)
  AS labels FROM part""")
def _(spark, sf):
    names = ["p_name", F.lit(None).cast("string"), "p_type", F.when(F.col("p_size") > 25, F.col("p_brand"))]
    nodes = F.array(*[F.struct((F.col(c) if isinstance(c, str) else c).alias("name")) for c in names])
    return a.table(spark, sf, "part").select("p_partkey", text.join_labels(nodes).alias("labels"))


@query("flatten_array", """SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n,
  CAST(len(string_split(array_to_string([CAST(label AS VARCHAR), NULL, 'x'], ';'), ';')) AS INTEGER) AS parts,
  array_to_string([CAST(label AS VARCHAR), NULL, 'x'], ';') AS joined FROM embeddings""")
def _(spark, sf):
    parts = F.array(F.col("label").cast("string"), F.lit(None).cast("string"), F.lit("x"))
    joined = text.flatten_array(parts)
    return a.table(spark, sf, "embeddings").select(
        "vec_id", F.size("embedding").alias("n"), F.size(F.split(joined, ";")).alias("parts"), joined.alias("joined"))


# ---------------------------------------------------------------- issues

@query("issue_silver", f"""WITH {a.CURRENT_ISSUES}
SELECT id, identifier, title, state_name, state_type, priority,
  {d('created_at', 'started_at', 'completed_at', 'closed_at')},
  project_name, assignee_name, labels, trashed, is_incident FROM ci""")
def _(spark, sf):
    return a.current_issue_table(spark, sf)


@query("issue_silver_filter_after", f"""WITH {a.IH}, x AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC, pos DESC, part DESC, supplier DESC) AS rn
  FROM ih)
SELECT id, identifier, state_type, left(created_at, 10) AS created_at,
  coalesce(left(completed_at, 10), left(canceled_at, 10)) AS closed_at FROM x
WHERE rn = 1 AND NOT (lower(identifier) LIKE 'dev%' AND lower(team_name) = 'development')""")
def _(spark, sf):
    return a.current_issue_table(spark, sf, filter_after=True).select(
        "id", "identifier", "state_type", "created_at", "closed_at")


@query("issue_load_report", f"""WITH {a.CURRENT_ISSUES}
SELECT {n('count(*)', 'total')}, {n("count(*) FILTER (state_type = 'started')", 'started')},
  {n("count(*) FILTER (state_type = 'completed')", 'completed')},
  {n("count(*) FILTER (state_type IN ('canceled', 'cancelled'))", 'cancelled')},
  {n('count(*) FILTER (is_incident)', 'incidents')} FROM ci""")
def _(spark, sf):
    return current.issue_load_report(a.current_issue_table(spark, sf))


@query("not_and_filter", f"""WITH {a.IH}
SELECT team_name, {n('count(*)', 'versions')}, {n('count(identifier)', 'with_identifier')} FROM ih
WHERE NOT (lower(identifier) LIKE 'dev%' AND lower(team_name) = 'development') GROUP BY team_name""")
def _(spark, sf):
    kept = current.drop_where_all(a.issue_history(spark, sf), current.excluded_issue())
    return kept.groupBy("team_name").agg(
        F.count("*").alias("versions"), F.count("identifier").alias("with_identifier"))


@query("incident_flag", """SELECT coalesce(lower(p_name) LIKE '%ring%', false) AS is_ring, CAST(count(*) AS BIGINT) AS parts,
  CAST(count(*) FILTER (lower(p_type) LIKE 'eco%') AS BIGINT) AS economy FROM part GROUP BY 1""")
def _(spark, sf):
    return a.table(spark, sf, "part").groupBy(text.contains_flag("p_name", "RING").alias("is_ring")).agg(
        F.count("*").alias("parts"), F.count_if(text.ilike("p_type", "Eco%")).alias("economy"))


@query("issue_fact", f"""WITH {a.ISSUES}
SELECT id, identifier, state_label, priority_label, {d('created_at', 'started_at', 'closed_at')},
  days_to_start, days_to_close, age_days, project_group, assignee, is_incident,
  {a.lead_time_sql('days_to_close')} AS lead_time, {a.lead_time_sort_sql('days_to_close')} AS lead_time_sort FROM f""")
def _(spark, sf):
    return a.issue_fact(spark, sf, people=True).select(
        "id", "identifier", "state_label", "priority_label", "created_at", "started_at", "closed_at",
        "days_to_start", "days_to_close", "age_days", "project_group", "assignee", "is_incident",
        "lead_time", "lead_time_sort")


@query("issue_fact_reversed_dates", f"""WITH {a.RAW_ISSUES}
SELECT {a.lead_time_sql('days_to_close')} AS lead_time, {a.lead_time_sort_sql('days_to_close')} AS lead_time_sort,
  {n('count(*)', 'issues')}, CAST(min(days_to_close) AS INTEGER) AS fewest, CAST(max(days_to_close) AS INTEGER) AS most
FROM f GROUP BY 1, 2""")
def _(spark, sf):
    return a.issue_fact(spark, sf, clean=False).groupBy("lead_time", "lead_time_sort").agg(
        F.count("*").alias("issues"), F.min("days_to_close").alias("fewest"), F.max("days_to_close").alias("most"))


@query("issue_state_labels", f"""WITH {a.IH}
SELECT state_type, {a.STATE_LABEL} AS label,
  CASE WHEN state_type = 'canceled' THEN 'Other' ELSE {a.STATE_LABEL} END AS strict_label,
  {n('count(*)', 'versions')} FROM ih GROUP BY state_type""")
def _(spark, sf):
    return a.issue_history(spark, sf).groupBy(
        "state_type", labels.state_label("state_type").alias("label"),
        labels.state_label("state_type", strict=True).alias("strict_label")).agg(F.count("*").alias("versions"))


@query("issue_priority_labels", f"""WITH {a.IH}
SELECT priority, {a.PRIORITY_LABEL} AS label, {n('count(*)', 'versions')} FROM ih GROUP BY priority""")
def _(spark, sf):
    return a.issue_history(spark, sf).groupBy("priority", labels.priority_label("priority").alias("label")).agg(
        F.count("*").alias("versions"))


def _kpi_category_sql():
    whens = []
    for category, types, words in codes.KPI_RULES:
        tests = [f"state_type IN {a.sql_codes(types)}"] + [f"contains(lower(state_name), {a.sql_text(w)})" for w in words]
        whens.append(f"WHEN {' OR '.join(tests)} THEN {a.sql_text(category)}")
    return f"CASE {' '.join(whens)} ELSE {a.sql_text(codes.OTHER)} END"


@query("kpi_category", f"""WITH {a.IH}
SELECT {_kpi_category_sql()} AS category, {n('count(*)', 'versions')} FROM ih GROUP BY 1""")
def _(spark, sf):
    return a.issue_history(spark, sf).groupBy(labels.kpi_category("state_type", "state_name").alias("category")).agg(
        F.count("*").alias("versions"))


def _issue_kpis_sql(s, e, ps, pe):
    def cnt(role, extra=""):
        return [f"count(*) FILTER ({role} BETWEEN DATE '{x}' AND DATE '{y}'{extra})" for x, y in ((s, e), (ps, pe))]

    def is_open(x):
        return f"created_at <= DATE '{x}' AND (closed_at IS NULL OR closed_at > DATE '{x}')"

    cols = []
    for name, (now, before) in (("created", cnt("created_at")), ("closed", cnt("closed_at"))):
        cols += [n(now, name), n(before, name + "_prev"),
                 r(f"({now} - {before}) / nullif(CAST({before} AS DOUBLE), 0)", name + "_change")]
    opened, before = (f"count(*) FILTER ({is_open(x)})" for x in (e, pe))
    cols += [n(opened, "open"), n(before, "open_prev"), n(f"{opened} - {before}", "open_change")]
    now, before = cnt("created_at", " AND is_incident")
    cols += [n(now, "incidents"), n(before, "incidents_prev"), n(f"{now} - {before}", "incidents_change")]
    now, before = (f"avg(days_to_close) FILTER (closed_at BETWEEN DATE '{x}' AND DATE '{y}')"
                   for x, y in ((s, e), (ps, pe)))
    cols += [r(now, "avg_days_to_close"), r(before, "avg_days_to_close_prev"),
             r(f"{now} - {before}", "avg_days_to_close_change")]
    now = f"max(date_diff('day', created_at, DATE '{a.ISSUE_AS_OF}')) FILTER (closed_at IS NULL)"
    before = f"max(date_diff('day', created_at, DATE '{pe}')) FILTER ({is_open(pe)})"
    cols += [f"CAST({now} AS INTEGER) AS oldest_issue", f"CAST({before} AS INTEGER) AS oldest_issue_prev",
             f"CAST({now} - {before} AS INTEGER) AS oldest_issue_change"]
    return ", ".join(cols)


ISSUE_WEEK = ("1998-06-01", "1998-06-07", "1998-05-25", "1998-05-31")
ISSUE_MONTH = ("1998-05-01", "1998-05-31", "1998-04-01", "1998-04-30")
CHOSEN_MONTH = ("1997-02-01", "1997-02-28", "1997-01-01", "1997-01-31")


@query("issue_kpis_week", f"WITH {a.ISSUES} SELECT {_issue_kpis_sql(*ISSUE_WEEK)} FROM f")
def _(spark, sf):
    return m.issue_kpis(a.issue_fact(spark, sf), a.ISSUE_AS_OF, "week")


@query("issue_kpis_month", f"WITH {a.ISSUES} SELECT {_issue_kpis_sql(*ISSUE_MONTH)} FROM f")
def _(spark, sf):
    return m.issue_kpis(a.issue_fact(spark, sf), a.ISSUE_AS_OF, "month")


@query("issue_kpis_chosen_month", f"WITH {a.ISSUES} SELECT {_issue_kpis_sql(*CHOSEN_MONTH)} FROM f")
def _(spark, sf):
    return m.issue_kpis(a.issue_fact(spark, sf), a.ISSUE_AS_OF, ("month", "1997-02-14"))


@query("issue_kpis_by_project", f"WITH {a.ISSUES} SELECT project_group, {_issue_kpis_sql(*ISSUE_MONTH)} "
       "FROM f GROUP BY project_group")
def _(spark, sf):
    return m.issue_kpis(a.issue_fact(spark, sf, people=True), a.ISSUE_AS_OF, "month", by=["project_group"])


@query("throughput_split", f"""WITH {a.ISSUES},
c AS (SELECT created_at BETWEEN DATE '1998-05-01' AND DATE '1998-05-31' AS fresh FROM f
      WHERE closed_at BETWEEN DATE '1998-05-01' AND DATE '1998-05-31')
SELECT {n('count(*)', 'closed')}, {n('count(*) FILTER (fresh)', 'same_period')},
  {n('count(*) FILTER (NOT fresh)', 'from_backlog')} FROM c""")
def _(spark, sf):
    return m.measure_table(a.issue_fact(spark, sf), m.throughput_split(periods.period_bounds(a.ISSUE_AS_OF, "month")))


def _flow_sql(cte, grain, by=""):
    """Created and closed per calendar group by two separate aggregates."""
    sel = f"{by}, " if by else ""
    on = f"USING ({sel}{grain})"
    g = lambda c: f"CAST(date_trunc('{grain}', {c}) AS DATE)"
    grp = "GROUP BY ALL"
    return f"""{cte},
c AS (SELECT {sel}{g('created_at')} AS {grain}, count(*) AS created FROM f WHERE created_at IS NOT NULL {grp}),
k AS (SELECT {sel}{g('closed_at')} AS {grain}, count(*) AS closed FROM f WHERE closed_at IS NOT NULL {grp}),
flow AS (SELECT {sel}{grain}, coalesce(created, 0) AS created, coalesce(closed, 0) AS closed FROM c FULL JOIN k {on})"""


@query("created_closed_monthly", f"""WITH {_flow_sql(a.ISSUES, 'month')}
SELECT {d('month')}, {n('created', 'created')}, {n('closed', 'closed')} FROM flow""")
def _(spark, sf):
    return series.created_closed_series(a.issue_fact(spark, sf))


@query("role_volume_weekly", f"""WITH {_flow_sql(a.ISSUES, 'week', 'project_group')}
SELECT project_group, {d('week')}, {n('created', 'created')}, {n('closed', 'closed')} FROM flow""")
def _(spark, sf):
    return series.created_closed_series(a.issue_fact(spark, sf, people=True), "week", ["project_group"])


def _backlog_sql(cte, grain="month", by=""):
    """Open count at each group end by a range join."""
    sel, part = (f"{by}, ", f"f.{by}, ") if by else ("", "")
    start = f"(SELECT min(date_trunc('{grain}', created_at)) FROM f WHERE created_at <= DATE '{a.ISSUE_AS_OF}')"
    spine = f"unnest(generate_series({start}, TIMESTAMP '{a.ISSUE_AS_OF}', INTERVAL 1 {grain}))"
    if by:
        spine = (f"unnest(generate_series(first_day, TIMESTAMP '{a.ISSUE_AS_OF}', INTERVAL 1 {grain})) AS g "
                 f"FROM (SELECT {by}, min(date_trunc('{grain}', created_at)) AS first_day FROM f "
                 f"WHERE created_at <= DATE '{a.ISSUE_AS_OF}' GROUP BY {by})")
        source = f"SELECT {by}, {spine}"
    else:
        source = f"SELECT {spine} AS g"
    match = f"AND f.{by} = s.{by}" if by else ""
    return f"""{cte},
spine AS (SELECT {sel}CAST(g AS DATE) AS {grain},
  least(CAST(g + INTERVAL 1 {grain} - INTERVAL 1 DAY AS DATE), DATE '{a.ISSUE_AS_OF}') AS at FROM ({source})),
b AS (SELECT {'s.' + by + ', ' if by else ''}s.{grain}, count(f.id) AS open FROM spine s
  LEFT JOIN f ON f.created_at <= s.at AND (f.closed_at IS NULL OR f.closed_at > s.at) {match} GROUP BY ALL)"""


@query("backlog_monthly", f"""WITH {_backlog_sql(a.ISSUES)} SELECT {d('month')}, {n('open', 'open')} FROM b""")
def _(spark, sf):
    return series.backlog_series(a.issue_fact(spark, sf), a.ISSUE_AS_OF)


@query("backlog_weekly_reversed", f"""WITH {_backlog_sql(a.RAW_ISSUES, 'week')}
SELECT {d('week')}, {n('open', 'open')} FROM b""")
def _(spark, sf):
    return series.backlog_series(a.issue_fact(spark, sf, clean=False), a.ISSUE_AS_OF, "week")


@query("backlog_by_assignee", f"""WITH {_backlog_sql(a.ISSUES, 'month', 'assignee')}
SELECT assignee, {d('month')}, {n('open', 'open')} FROM b""")
def _(spark, sf):
    return series.backlog_series(a.issue_fact(spark, sf, people=True), a.ISSUE_AS_OF, by=["assignee"])


@query("avg_median_close_monthly", f"""WITH {a.ISSUES}
SELECT CAST(CAST(date_trunc('month', closed_at) AS DATE) AS VARCHAR) AS month,
  {r('avg(days_to_close)', 'avg_days_to_close')}, {r('median(days_to_close)', 'median_days_to_close')}
FROM f WHERE closed_at IS NOT NULL GROUP BY 1""")
def _(spark, sf):
    return m.close_stats(a.issue_fact(spark, sf), [dates.month_start("closed_at").alias("month")])


TRAILING = """spine AS (SELECT CAST(unnest(generate_series(
    (SELECT least(min(date_trunc('month', created_at)), min(date_trunc('month', closed_at))) FROM f),
    TIMESTAMP '{as_of}', INTERVAL 1 MONTH)) AS DATE) AS month)""".format(as_of=a.ISSUE_AS_OF)


def _window(c):
    return f"{c} >= month - INTERVAL 2 MONTH AND {c} < month + INTERVAL 1 MONTH"


VOLUME = f"""{TRAILING},
vol AS (SELECT month,
  (SELECT nullif(count(*), 0) FROM f WHERE {_window('created_at')}) / 3.0 AS created,
  (SELECT nullif(count(*), 0) FROM f WHERE {_window('closed_at')}) / 3.0 AS closed FROM spine)"""
LIFE = f"""life AS (SELECT month,
  (SELECT avg(days_to_close) FROM f WHERE {_window('closed_at')}) AS created_to_closed,
  (SELECT avg(days_to_start) FROM f WHERE {_window('closed_at')} AND started_at IS NOT NULL AND days_to_start >= 0)
    AS created_to_started,
  (SELECT avg(days_to_close - days_to_start) FROM f WHERE {_window('closed_at')} AND started_at IS NOT NULL)
    AS started_to_closed FROM spine)"""
NOT_EMPTY = "created IS NOT NULL OR closed IS NOT NULL"


@query("volume_3m_ma", f"""WITH {a.ISSUES}, {VOLUME}
SELECT {d('month')}, {r('created', 'created')}, {r('closed', 'closed')} FROM vol WHERE {NOT_EMPTY}""")
def _(spark, sf):
    roles = {"created": "created_at", "closed": "closed_at"}
    return series.moving_volume(a.issue_fact(spark, sf), roles, end=a.ISSUE_AS_OF)


@query("lifecycle_3m", f"""WITH {a.ISSUES}, {TRAILING}, {LIFE}
SELECT {d('month')}, {r('created_to_closed', 'created_to_closed')}, {r('created_to_started', 'created_to_started')},
  {r('started_to_closed', 'started_to_closed')} FROM life WHERE created_to_closed IS NOT NULL""")
def _(spark, sf):
    return series.lifecycle_averages(a.issue_fact(spark, sf), end=a.ISSUE_AS_OF)


@query("lifecycle_3m_reversed", f"""WITH {a.RAW_ISSUES}, {TRAILING}, {LIFE}
SELECT {d('month')}, {r('created_to_closed', 'created_to_closed')}, {r('created_to_started', 'created_to_started')},
  {r('started_to_closed', 'started_to_closed')} FROM life WHERE created_to_closed IS NOT NULL""")
def _(spark, sf):
    return series.lifecycle_averages(a.issue_fact(spark, sf, clean=False), end=a.ISSUE_AS_OF)


@query("month_over_month", f"""WITH {_flow_sql(a.ISSUES, 'month')},
p AS (SELECT *, lag(created) OVER (ORDER BY month) AS previous FROM flow)
SELECT {d('month')}, {n('created', 'created')}, {n('closed', 'closed')}, {n('previous', 'previous')},
  {r('(created - previous) / nullif(CAST(previous AS DOUBLE), 0)', 'change')} FROM p""")
def _(spark, sf):
    return series.with_previous(series.created_closed_series(a.issue_fact(spark, sf)), "created", "month")


@query("oldest_open", f"""WITH {a.ISSUES}, o AS (SELECT * FROM f WHERE closed_at IS NULL)
SELECT {d('created_at')}, max(identifier) AS identifier, max(title) AS title FROM o
WHERE created_at = (SELECT min(created_at) FROM o) GROUP BY created_at""")
def _(spark, sf):
    return reports.tooltip_oldest(a.issue_fact(spark, sf))


@query("oldest_open_age", f"""WITH {a.ISSUES}
SELECT CAST(max(date_diff('day', created_at, DATE '{a.ISSUE_AS_OF}')) AS INTEGER) AS oldest_open_days
FROM f WHERE closed_at IS NULL""")
def _(spark, sf):
    return m.oldest_open_age(a.issue_fact(spark, sf), a.ISSUE_AS_OF)


@query("pct_closed_over_threshold", f"""WITH {a.ISSUES}
SELECT project_group, {r('''count(*) FILTER (closed_at IS NOT NULL AND days_to_close > 30)
  / nullif(CAST(count(closed_at) AS DOUBLE), 0)''', 'pct_closed_over')} FROM f GROUP BY project_group""")
def _(spark, sf):
    return m.pct_closed_over(a.issue_fact(spark, sf, people=True), 30, ["project_group"])


@query("open_now", f"""WITH {a.ISSUES}
SELECT assignee, {n('count(*) FILTER (closed_at IS NULL)', 'open')} FROM f GROUP BY assignee""")
def _(spark, sf):
    return m.open_now(a.issue_fact(spark, sf, people=True), ["assignee"])


@query("top_assignee", f"""WITH {a.ISSUES}
SELECT assignee, {n('count(*) FILTER (closed_at IS NULL)', 'open')} FROM f GROUP BY assignee
ORDER BY open DESC, assignee LIMIT 3""")
def _(spark, sf):
    return m.top_assignee(a.issue_fact(spark, sf, people=True), n=3)


@query("first_issues", f"""WITH {a.ISSUES}
SELECT id, state_type, state_label, priority_label, {d('created_at', 'closed_at')} FROM f ORDER BY id LIMIT 5""")
def _(spark, sf):
    rows = a.issue_fact(spark, sf).select("id", "state_type", "state_label", "priority_label", "created_at", "closed_at")
    return joins.head(rows, 5, ["id"])


@query("incidents_by_state", f"""WITH {a.ISSUES}
SELECT state_label, {n('count(*)', 'incidents')} FROM f WHERE is_incident GROUP BY state_label""")
def _(spark, sf):
    rows = a.issue_fact(spark, sf).filter("is_incident")
    return m.volume(rows, ["state_label"]).withColumnRenamed("count", "incidents")


@query("inflow_daily", f"""WITH {a.ISSUES}
SELECT CAST(created_at AS VARCHAR) AS date, {n('count(*)', 'created')} FROM f GROUP BY created_at""")
def _(spark, sf):
    return m.inflow_daily(a.issue_fact(spark, sf))


@query("issues_per_state", f"""WITH {a.IH}
SELECT {d('snapshot_ts')}, state_type, state_name, {n('count(*)', 'issues')} FROM ih
GROUP BY snapshot_ts, state_type, state_name""")
def _(spark, sf):
    return m.issues_per_state(a.issue_history(spark, sf))


@query("backlog_per_snapshot", f"""WITH {a.IH}
SELECT {d('snapshot_ts')}, {n('count(*)', 'issues_in_backlog')} FROM ih
WHERE state_type IN ('backlog', 'unstarted') GROUP BY snapshot_ts""")
def _(spark, sf):
    return m.backlog_per_snapshot(a.issue_history(spark, sf))


@query("lead_time_exclusive", f"""WITH {a.ISSUES}
SELECT id, state_name, {d('created_at', 'updated_at')},
  CAST(date_diff('day', created_at, updated_at) AS INTEGER) AS lead_time_days FROM f WHERE state_name = 'Done'""")
def _(spark, sf):
    return m.lead_time_exclusive(a.issue_fact(spark, sf))


@query("person_dim", f"""WITH {a.ISSUES}
SELECT assignee_id AS person_id, arg_max(assignee_name, (updated_at, assignee_name)) AS person_name FROM f
WHERE assignee_id IS NOT NULL GROUP BY assignee_id""")
def _(spark, sf):
    return m.person_dim(a.issues(spark, sf, people=True))


@query("done_per_person", f"""WITH {a.ISSUES}
SELECT assignee_name AS person_name, {n('count(*)', 'issues_done')} FROM f
WHERE state_name = 'Done' AND assignee_id IS NOT NULL GROUP BY assignee_name""")
def _(spark, sf):
    rows = a.issues(spark, sf, people=True)
    return m.done_per_person(rows, m.person_dim(rows))


@query("exclude_values", f"""WITH {a.ISSUES}
SELECT assignee_name, {n('count(*)', 'issues')} FROM f
WHERE assignee_name IS NULL OR assignee_name NOT IN ('NATION_1', 'NATION_2') GROUP BY assignee_name""")
def _(spark, sf):
    rows = joins.exclude_values(a.issues(spark, sf, people=True), "assignee_name", ["NATION_1", "NATION_2"])
    return rows.groupBy("assignee_name").agg(F.count("*").alias("issues"))


@query("last_months", f"""WITH {a.ISSUES}
SELECT CAST(CAST(date_trunc('month', created_at) AS DATE) AS VARCHAR) AS month, {n('count(*)', 'created')} FROM f
WHERE created_at >= DATE '1997-06-01' AND created_at < DATE '1998-06-01' GROUP BY 1""")
def _(spark, sf):
    rows = joins.last_months(a.issue_fact(spark, sf), "created_at", 12, a.ISSUE_AS_OF, include_current=False)
    return rows.groupBy(dates.month_start("created_at").alias("month")).agg(F.count("*").alias("created"))


# ---------------------------------------------------------------- reports

@query("summary", f"""WITH {a.TICKETS}, {a.ISSUES},
i AS (SELECT {_issue_kpis_sql(*ISSUE_WEEK)} FROM f), t AS (SELECT {_ticket_kpis_sql('1998-06-01', '1998-06-07', '1998-05-25', '1998-05-31')} FROM tf)
SELECT {", ".join(f"i.{c}{s} AS issue_{c}{s}" for c in ("created", "closed", "open", "incidents", "avg_days_to_close", "oldest_issue") for s in ("", "_prev", "_change"))},
  {", ".join(f"t.{c}{s} AS ticket_{c}{s}" for c in ("waiting", "passed", "escalation_rate") for s in ("", "_prev", "_change"))}
FROM i, t""")
def _(spark, sf):
    return reports.summary(a.ticket_fact(spark, sf), a.issue_fact(spark, sf), a.ISSUE_AS_OF)


@query("overview_series", f"""WITH {_flow_sql(_backlog_sql(a.ISSUES), 'month')}
SELECT {d('month')}, {n('coalesce(created, 0)', 'created')}, {n('coalesce(closed, 0)', 'closed')},
  {n('coalesce(open, 0)', 'open')} FROM b FULL JOIN flow USING (month)
WHERE month >= DATE '1998-02-01' AND month < DATE '1998-07-01'""")
def _(spark, sf):
    return reports.overview_series(a.issue_fact(spark, sf), a.ISSUE_AS_OF)


@query("close_totals", f"""WITH {a.ISSUES}
SELECT CAST(date_trunc('month', closed_at) AS DATE)::VARCHAR AS month, project_group,
  CAST(grouping(date_trunc('month', closed_at), project_group) AS INTEGER) AS grouping, {n('count(*)', 'closed')},
  {r('avg(days_to_close)', 'avg_days_to_close')}, {r('median(days_to_close)', 'median_days_to_close')}
FROM f WHERE closed_at IS NOT NULL
GROUP BY GROUPING SETS ((date_trunc('month', closed_at), project_group), (project_group), ())""")
def _(spark, sf):
    """Close statistics per month and project group, per project group, and of all, from the daily cube."""
    days = cube.daily_cube(a.issue_fact(spark, sf, people=True), ["project_group"])
    return cube.close_stats(days, [["month", "project_group"], ["project_group"], []], ["month", "project_group"])


@query("trends", f"""WITH {a.ISSUES}, {VOLUME}, {LIFE},
cs AS (SELECT CAST(date_trunc('month', closed_at) AS DATE) AS month, avg(days_to_close) AS av, median(days_to_close) AS md
       FROM f WHERE closed_at IS NOT NULL GROUP BY 1)
SELECT {d('month')}, {r('created', 'created_3m')}, {r('closed', 'closed_3m')},
  {r('created_to_closed', 'created_to_closed')}, {r('created_to_started', 'created_to_started')},
  {r('started_to_closed', 'started_to_closed')}, {r('av', 'avg_days_to_close')}, {r('md', 'median_days_to_close')}
FROM vol LEFT JOIN life USING (month) LEFT JOIN cs USING (month) WHERE {NOT_EMPTY}""")
def _(spark, sf):
    return reports.trends(a.issue_fact(spark, sf), a.ISSUE_AS_OF)


@query("project_group_counts", f"""WITH {a.ISSUES}
SELECT project_group, {n('count(*)', 'count')} FROM f GROUP BY project_group""")
def _(spark, sf):
    return reports.project_volume(a.issue_fact(spark, sf, people=True))


@query("lead_time_histogram", f"""WITH {a.ISSUES}
SELECT {a.lead_time_sql('days_to_close')} AS lead_time, {a.lead_time_sort_sql('days_to_close')} AS lead_time_sort,
  {n('count(*)', 'count')} FROM f WHERE days_to_close IS NOT NULL GROUP BY 1, 2""")
def _(spark, sf):
    return reports.lead_time_histogram(a.issue_fact(spark, sf))


@query("project_close_times", f"""WITH {a.ISSUES}
SELECT project_group, {r('avg(days_to_close)', 'avg_days_to_close')},
  {r('median(days_to_close)', 'median_days_to_close')} FROM f WHERE closed_at IS NOT NULL GROUP BY project_group""")
def _(spark, sf):
    return reports.project_close_times(a.issue_fact(spark, sf, people=True))


@query("assignee_table", f"""WITH {a.ISSUES}
SELECT assignee, {n("count(*) FILTER (created_at BETWEEN DATE '1998-03-01' AND DATE '1998-05-31')", 'created')},
  {n("count(*) FILTER (closed_at BETWEEN DATE '1998-03-01' AND DATE '1998-05-31')", 'closed')},
  {n('count(*) FILTER (closed_at IS NULL)', 'open')},
  {r("avg(days_to_close) FILTER (closed_at BETWEEN DATE '1998-03-01' AND DATE '1998-05-31')", 'avg_days_to_close')},
  {n("count(*) FILTER (is_incident AND created_at BETWEEN DATE '1998-03-01' AND DATE '1998-05-31')", 'incidents')}
FROM f WHERE assignee NOT IN ('NATION_3') GROUP BY assignee""")
def _(spark, sf):
    return reports.assignee_table(
        a.issue_fact(spark, sf, people=True), "1998-03-01", "1998-05-31", excluded=["NATION_3"])


@query("assignee_monthly", f"""WITH {a.ISSUES}
SELECT assignee, CAST(CAST(date_trunc('month', created_at) AS DATE) AS VARCHAR) AS month, {n('count(*)', 'created')}
FROM f GROUP BY 1, 2""")
def _(spark, sf):
    return reports.assignee_monthly(a.issue_fact(spark, sf, people=True))


_MONTHS = ("1998-03-01", "1998-04-01", "1998-05-01", "1998-06-01")


@query("assignee_month_matrix", f"""WITH {_flow_sql(a.ISSUES, 'month', 'assignee')}
SELECT assignee, {", ".join(n(f"sum({c}) FILTER (month = DATE '{x}')", f"{c}_{x[:7].replace('-', '_')}")
                            for x in _MONTHS for c in ('created', 'closed'))}
FROM flow WHERE month >= DATE '1998-03-01' AND month < DATE '1998-07-01' GROUP BY assignee""")
def _(spark, sf):
    return reports.assignee_matrix(a.issue_fact(spark, sf, people=True), a.ISSUE_AS_OF)


@query("assignee_backlog_recent", f"""WITH {_backlog_sql(a.ISSUES, 'month', 'assignee')}
SELECT assignee, {d('month')}, {n('open', 'open')} FROM b WHERE month >= DATE '1998-03-01'""")
def _(spark, sf):
    return reports.assignee_backlog(a.issue_fact(spark, sf, people=True), a.ISSUE_AS_OF)


@query("tooltip_weekly", f"""WITH {_flow_sql(a.ISSUES, 'week', 'assignee')}
SELECT strftime(week, '%G-W%V') AS year_week, {n('created', 'created')}, {n('closed', 'closed')} FROM flow
WHERE assignee = 'NATION_5'""")
def _(spark, sf):
    return reports.tooltip_weekly(a.issue_fact(spark, sf, people=True), "NATION_5")


@query("open_issue_list", f"""WITH {a.ISSUES}
SELECT identifier, title, assignee, project_group, {d('created_at')}, age_days, priority_label FROM f
WHERE closed_at IS NULL""")
def _(spark, sf):
    return reports.open_issue_list(a.issue_fact(spark, sf, people=True))


@query("priority_mix_monthly", f"""WITH {a.ISSUES}
SELECT CAST(CAST(date_trunc('month', created_at) AS DATE) AS VARCHAR) AS month, priority_label,
  {n('count(*)', 'count')} FROM f GROUP BY 1, 2""")
def _(spark, sf):
    return reports.priority_mix(a.issue_fact(spark, sf))


@query("backlog_age_matrix", f"""WITH {a.ISSUES}
SELECT project_group, {a.lead_time_sql('age_days')} AS age, {a.lead_time_sort_sql('age_days')} AS age_sort,
  {n('count(*)', 'count')} FROM f WHERE closed_at IS NULL GROUP BY 1, 2, 3""")
def _(spark, sf):
    return reports.backlog_age(a.issue_fact(spark, sf, people=True))


@query("assignee_week_flow", f"""WITH {_flow_sql(a.ISSUES, 'week', 'assignee')}
SELECT assignee, strftime(week, '%G-W%V') AS year_week, {n('created', 'created')}, {n('closed', 'closed')} FROM flow""")
def _(spark, sf):
    return reports.assignee_week_flow(a.issue_fact(spark, sf, people=True))


# ---------------------------------------------------------------- calendar

def _order_days(spark, sf):
    return a.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("created_at"))


def _order_calendar(spark, sf, **options):
    lo, hi = _order_days(spark, sf).agg(F.min("created_at"), F.max("created_at")).first()
    return calendar.date_dim(spark, lo, hi, **options)


def _active_days(spark, sf):
    """The calendar with the orders of each day."""
    return calendar.with_day_volume(_order_calendar(spark, sf), a.table(spark, sf, "orders"), "o_orderdate", "orders")


ACTIVE = f"""{a.CALENDAR}, o AS (
  SELECT CAST(o_orderdate AS DATE) AS date_key, count(*) AS c FROM orders GROUP BY 1),
active AS (SELECT dim.*, CAST(coalesce(c, 0) AS BIGINT) AS orders FROM dim LEFT JOIN o USING (date_key))"""


@query("date_dim", f"""WITH {a.CALENDAR}, o AS (
  SELECT CAST(o_orderdate AS DATE) AS date_key, count(*) AS c FROM orders GROUP BY 1)
SELECT dim.* REPLACE (CAST(dim.date_key AS VARCHAR) AS date_key), {n('coalesce(c, 0)', 'orders')}
FROM dim LEFT JOIN o USING (date_key)""")
def _(spark, sf):
    return _active_days(spark, sf)


@query("calendar_labels", f"""WITH {ACTIVE}
SELECT {d('date_key')}, orders, CAST(date_key <= DATE '1998-06-12' AS INTEGER) AS is_past_or_today,
  CAST(month_sort = 199806 AS INTEGER) AS is_current_month,
  month_short || ' ''' || strftime(date_key, '%y') AS month_label,
  day(date_trunc('week', date_key)) || ' ' || left(monthname(date_trunc('week', date_key)), 3) AS week_starting,
  'Q' || quarter_num || ' ''' || strftime(date_key, '%y') AS quarter_label,
  CAST(year * 10 + quarter_num AS INTEGER) AS quarter_sort,
  CAST(strftime(date_key, '%Y%m%d') AS INTEGER) AS date_key_int,
  CAST(CAST(date_trunc('month', date_key) AS DATE) AS VARCHAR) AS month_start,
  CAST(CAST(last_day(date_key) AS DATE) AS VARCHAR) AS month_end, strftime(date_key, '%d') AS day_number,
  h.name AS holiday_name, h.name_sv AS holiday_name_sv
FROM active LEFT JOIN (SELECT holiday, min(name) AS name, min(name_sv) AS name_sv FROM hol GROUP BY holiday) h
  ON h.holiday = date_key""")
def _(spark, sf):
    return calendar.report_columns(_active_days(spark, sf), a.ISSUE_AS_OF).select(
        "date_key", "orders", "is_past_or_today", "is_current_month", "month_label", "week_starting", "quarter_label",
        "quarter_sort", "date_key_int", "month_start", "month_end", "day_number", "holiday_name", "holiday_name_sv")


@query("calendar_summary", f"""WITH {ACTIVE}
SELECT {n('sum(orders)', 'orders_total')}, {n('coalesce(sum(orders) FILTER (is_weekend), 0)', 'orders_on_weekend_days')},
  {n('coalesce(sum(orders) FILTER (is_public_holiday), 0)', 'orders_on_public_holidays')},
  {n('coalesce(sum(orders) FILTER (is_working_day), 0)', 'orders_on_working_days')},
  {n('count(*)', 'total_days')}, {n('count(*) FILTER (is_weekend)', 'weekend_days')},
  {n('count(*) FILTER (is_public_holiday)', 'public_holidays')},
  {n('count(*) FILTER (is_working_day)', 'working_days')} FROM active""")
def _(spark, sf):
    return calendar.calendar_summary(_active_days(spark, sf), "orders")


@query("holidays", f"""WITH {a.CALENDAR}
SELECT CAST(holiday AS VARCHAR) AS holiday, min(name) AS name, min(name_sv) AS name_sv FROM hol, bounds
WHERE year(holiday) BETWEEN year(lo) AND year(hi) GROUP BY holiday""")
def _(spark, sf):
    return calendar.public_holidays(_order_days(spark, sf).select(F.year("created_at").alias("year")).distinct())


@query("holiday_orders", f"""WITH {a.CALENDAR}
SELECT CAST(holiday AS VARCHAR) AS day, min(name) AS name, min(name_sv) AS name_sv,
  {n('count(DISTINCT o_orderkey)', 'orders')} FROM hol JOIN orders ON CAST(o_orderdate AS DATE) = holiday
GROUP BY holiday""")
def _(spark, sf):
    day = F.col("created_at")
    per_day = _order_days(spark, sf).groupBy(day.alias("day")).agg(F.count("*").alias("orders"))
    named = per_day.select(
        "day", dates.holiday_name("day").alias("name"), dates.holiday_name("day", "sv").alias("name_sv"), "orders")
    return named.filter(F.col("name").isNotNull())


@query("calendar_names", """SELECT DISTINCT month(o_orderdate) AS m, isodow(o_orderdate) AS w,
  ['Januari','Februari','Mars','April','Maj','Juni','Juli','Augusti','September','Oktober','November','December']
    [month(o_orderdate)] AS month_sv,
  ['Mån','Tis','Ons','Tor','Fre','Lör','Sön'][isodow(o_orderdate)] AS day_sv FROM orders""")
def _(spark, sf):
    c = F.col("created_at")
    return _order_days(spark, sf).select(
        F.month(c).cast("long").alias("m"), dates.iso_dow(c).cast("long").alias("w"),
        dates.month_name(c, "sv").alias("month_sv"), dates.day_short(c, "sv").alias("day_sv")).distinct()


@query("working_days_by_week", f"""WITH {ACTIVE}
SELECT year_week, CAST(max(working_days_in_week) AS INTEGER) AS working_days, {n('sum(orders)', 'orders')},
  {n('count(*) FILTER (is_working_day)', 'in_range')} FROM active GROUP BY year_week""")
def _(spark, sf):
    return _active_days(spark, sf).groupBy("year_week").agg(
        F.max("working_days_in_week").alias("working_days"), F.count_if("is_working_day").alias("in_range"),
        F.sum("orders").alias("orders"))


@query("volume_per_working_day", f"""WITH {a.CALENDAR}, o AS (
  SELECT strftime(o_orderdate, '%G-W%V') AS year_week, count(*) AS c FROM orders GROUP BY 1),
w AS (SELECT year_week, max(working_days_in_week) AS wd FROM dim GROUP BY 1)
SELECT year_week, {n('c', 'count')}, CAST(wd AS INTEGER) AS working_days,
  {r('c / nullif(CAST(wd AS DOUBLE), 0)', 'per_working_day')} FROM o JOIN w USING (year_week)""")
def _(spark, sf):
    volume = _order_days(spark, sf).groupBy(dates.year_week("created_at").alias("year_week")).agg(
        F.count("*").alias("count"))
    return calendar.per_working_day(volume, _order_calendar(spark, sf))


@query("by_calendar", f"""WITH {a.CALENDAR}, {a.ISSUES}
SELECT quarter_name, day_name, is_working_day, {n('count(*)', 'issues')} FROM f LEFT JOIN dim ON closed_at = date_key
GROUP BY 1, 2, 3""")
def _(spark, sf):
    rows = joins.by_calendar(a.issue_fact(spark, sf), _order_calendar(spark, sf), "closed_at")
    return rows.groupBy("quarter_name", "day_name", "is_working_day").agg(F.count("*").alias("issues"))


@query("by_two_roles", f"""WITH {a.CALENDAR}, {a.ISSUES}
SELECT x.year AS created_at_year, y.year AS closed_at_year, {n('count(*)', 'issues')}
FROM f LEFT JOIN dim x ON created_at = x.date_key LEFT JOIN dim y ON closed_at = y.date_key GROUP BY 1, 2""")
def _(spark, sf):
    rows = joins.by_two_roles(
        a.issue_fact(spark, sf), _order_calendar(spark, sf), "created_at", "closed_at", ["year"])
    return rows.groupBy("created_at_year", "closed_at_year").agg(F.count("*").alias("issues"))


@query("drill_rollup", f"""WITH {a.CALENDAR}, {a.ISSUES}
SELECT CAST(year * 10 + quarter_num AS INTEGER) AS quarter_sort, month_sort, year_week, {d('date_key')},
  CAST(grouping(quarter_sort) * 8 + grouping(month_sort) * 4 + grouping(year_week) * 2 + grouping(date_key) AS INTEGER)
    AS level, {n('count(*)', 'count')}
FROM (SELECT *, year * 10 + quarter_num AS quarter_sort FROM f LEFT JOIN dim ON created_at = date_key)
GROUP BY ROLLUP (quarter_sort, month_sort, year_week, date_key)""".replace(
    "CAST(year * 10 + quarter_num AS INTEGER) AS quarter_sort, month_sort,",
    "CAST(quarter_sort AS INTEGER) AS quarter_sort, month_sort,"))
def _(spark, sf):
    return series.drill(a.issue_fact(spark, sf), _order_calendar(spark, sf))


@query("period_bounds", """WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
p AS (
  SELECT 'week' AS period, day, date_trunc('week', day) AS nxt, date_trunc('week', day) - INTERVAL 7 DAY AS s,
    date_trunc('week', day) - INTERVAL 14 DAY AS ps FROM days
  UNION ALL
  SELECT 'month', day, date_trunc('month', day), date_trunc('month', day) - INTERVAL 1 MONTH,
    date_trunc('month', day) - INTERVAL 2 MONTH FROM days)
SELECT period, CAST(day AS VARCHAR) AS day, CAST(CAST(s AS DATE) AS VARCHAR) AS period_start,
  CAST(CAST(nxt - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS period_end, CAST(CAST(ps AS DATE) AS VARCHAR) AS prev_start,
  CAST(CAST(s - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS prev_end,
  CASE period WHEN 'week' THEN 'W' || weekofyear(s) ELSE monthname(s) END AS label FROM p""")
def _(spark, sf):
    days = _order_days(spark, sf).select(F.col("created_at").alias("day")).distinct()

    def bounds(kind):
        cols = periods.period_columns("day", kind)
        return days.select(
            F.lit(kind).alias("period"), "day", *[c.alias(k) for k, c in cols.items()],
            periods.period_label_column(cols["period_start"], kind).alias("label"))

    return joins.union_all([bounds("week"), bounds("month")])


@query("week_class", f"""SELECT CASE WHEN CAST(o_orderdate AS DATE) BETWEEN DATE '1998-06-01' AND DATE '1998-06-07'
  THEN 'Last Week' WHEN CAST(o_orderdate AS DATE) BETWEEN DATE '1998-05-25' AND DATE '1998-05-31' THEN 'Week Before'
  ELSE 'Other' END AS week_class, {n('count(*)', 'orders')} FROM orders GROUP BY 1""")
def _(spark, sf):
    return _order_days(spark, sf).groupBy(periods.week_class("created_at", a.ISSUE_AS_OF).alias("week_class")).agg(
        F.count("*").alias("orders"))


@query("last_date", f"""WITH {ACTIVE}
SELECT CAST(max(date_key) AS VARCHAR) AS last_date, CAST(max(date_key) FILTER (orders > 0) AS VARCHAR) AS last_active,
  arg_max(orders, date_key) FILTER (orders > 0) AS orders FROM active WHERE date_key < DATE '{a.ISSUE_AS_OF}'""")
def _(spark, sf):
    return calendar.last_date(_active_days(spark, sf), a.ISSUE_AS_OF, "orders")


@query("last_completed_week", f"""WITH {ACTIVE}
SELECT iso_week, year_week, {n('sum(orders)', 'orders')} FROM active
WHERE date_key BETWEEN DATE '1998-06-01' AND DATE '1998-06-07' GROUP BY ALL""")
def _(spark, sf):
    return calendar.last_completed_week(_active_days(spark, sf), a.ISSUE_AS_OF, "orders")


@query("union_distinct", """SELECT CAST(o_orderdate AS DATE)::VARCHAR AS day FROM orders
UNION SELECT CAST(l_shipdate AS DATE)::VARCHAR FROM lineitem""")
def _(spark, sf):
    shipped = a.table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("day"))
    return joins.union_distinct([_order_days(spark, sf).withColumnRenamed("created_at", "day"), shipped])


# ---------------------------------------------------------------- profiles and quality

def _profile_sql(table, numeric, texts, times):
    rows = []
    for c in numeric + texts + times:
        kind = "numeric" if c in numeric else "timestamp" if c in times else "string"
        time = c in times
        rows.append(f"""SELECT '{c}' AS field, '{kind}' AS inferred_type,
  round(CAST(count(*) FILTER ({c} IS NULL) AS DOUBLE) / count(*), 6) AS missing_rate,
  CAST(count(DISTINCT {c}) AS BIGINT) AS unique_count, CAST(NULL AS INTEGER) AS max_array_len,
  CAST(0 AS BIGINT) AS parse_errors,
  {f"strftime(min({c}), '%Y-%m-%d %H:%M:%S')" if time else "CAST(NULL AS VARCHAR)"} AS min_date,
  {f"strftime(max({c}), '%Y-%m-%d %H:%M:%S')" if time else "CAST(NULL AS VARCHAR)"} AS max_date,
  {repr(codes.SUGGESTED_HANDLING[kind])} AS suggested_handling FROM {table}""")
    return "\nUNION ALL ".join(rows)


@query("column_profile", _profile_sql(
    "orders", ["o_orderkey", "o_custkey", "o_totalprice"], ["o_orderstatus", "o_orderpriority"], ["o_orderdate"]))
def _(spark, sf):
    return profiling.profile(a.table(spark, sf, "orders"))


@query("column_profile_text_times", f"""WITH {a.TH}, x AS (
  SELECT CASE WHEN pos % 50 = 0 THEN 'garbage' ELSE created_at END AS created_at FROM th)
SELECT 'created_at' AS field, 'timestamp' AS inferred_type, 0.0::DOUBLE AS missing_rate,
  {n('count(DISTINCT created_at)', 'unique_count')}, CAST(NULL AS INTEGER) AS max_array_len,
  {n("count(*) FILTER (created_at = 'garbage')", 'parse_errors')} FROM x""")
def _(spark, sf):
    rows = a.ticket_history(spark, sf).select(
        F.when(F.col("pos") % 50 == 0, "garbage").otherwise(F.col("created_at")).alias("created_at"))
    return profiling.profile(rows, times=["created_at"]).drop("min_date", "max_date", "suggested_handling")


@query("array_profile", f"""SELECT 'embedding' AS field, 'array' AS inferred_type, 0.0::DOUBLE AS missing_rate,
  {n('count(DISTINCT embedding)', 'unique_count')}, CAST(max(len(embedding)) AS INTEGER) AS max_array_len FROM embeddings""")
def _(spark, sf):
    return profiling.profile(a.table(spark, sf, "embeddings").select("embedding")).select(
        "field", "inferred_type", "missing_rate", "unique_count", "max_array_len")


_READ_AS = {
    "boolean": "regexp_full_match({c}, 'true|false')", "numeric": "regexp_full_match({c}, '[0-9.]+')",
    "timestamp": "regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T.*')", "array": "{c}[1] = '['",
    "json": "{c}[1] = '{{'"}
_TEXT_COLUMNS = ("key_text", "price_text", "day_text", "urgent_text", "list_text", "object_text", "words", "mixed")


def _inferred_sql():
    rows = []
    for c in _TEXT_COLUMNS:
        kind = " ".join(f"WHEN bool_and({test.format(c=c)}) THEN '{name}'" for name, test in _READ_AS.items())
        rows.append(f"""SELECT 'orders' AS source, '{c}' AS field, CASE {kind} ELSE 'string' END AS inferred_type,
  round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS missing_rate, {n(f'count(DISTINCT {c})', 'unique_count')},
  CASE WHEN '{c}' = 'list_text' THEN 2 END AS max_array_len FROM x""")
    return """WITH x AS (SELECT CAST(o_orderkey AS VARCHAR) AS key_text,
  CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderkey % 97 AS VARCHAR) || '.5' END AS price_text,
  strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00Z' AS day_text,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'true' ELSE 'false' END AS urgent_text,
  '["' || o_orderstatus || '", 1]' AS list_text, '{"s": "' || o_orderstatus || '"}' AS object_text,
  o_orderpriority AS words, CASE WHEN o_orderkey % 2 = 0 THEN '1' ELSE o_orderpriority END AS mixed FROM orders)
""" + "\nUNION ALL ".join(rows)


@query("inferred_types", _inferred_sql())
def _(spark, sf):
    """Types of text columns by what their values can be read as."""
    rows = a.table(spark, sf, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS key_text",
        "CASE WHEN o_orderkey % 9 <> 0 THEN concat(o_orderkey % 97, '.5') END AS price_text",
        "date_format(o_orderdate, \"yyyy-MM-dd'T00:00:00Z'\") AS day_text",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN 'true' ELSE 'false' END AS urgent_text",
        "concat('[\"', o_orderstatus, '\", 1]') AS list_text", "concat('{\"s\": \"', o_orderstatus, '\"}') AS object_text",
        "o_orderpriority AS words", "CASE WHEN o_orderkey % 2 = 0 THEN '1' ELSE o_orderpriority END AS mixed")
    return profiling.profile(rows, source="orders").select(
        "source", "field", "inferred_type", "missing_rate", "unique_count", "max_array_len")


def _describe_sql(table, numeric, texts):
    rows = []
    for c in numeric:
        q = ", ".join(r(f"quantile_cont({c}, {v})", k) for k, v in profiling.QUARTILES.items())
        rows.append(f"""SELECT '{c}' AS field, {n(f'count({c})', 'count')}, CAST(NULL AS BIGINT) AS "unique",
  CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq, {r(f'avg({c})', 'mean')}, {r(f'stddev_samp({c})', 'std')},
  {r(f'min({c})', 'min')}, {q}, {r(f'max({c})', 'max')} FROM {table}""")
    for c in texts:
        rows.append(f"""SELECT '{c}', CAST(sum(k) AS BIGINT), CAST(count(*) AS BIGINT),
  arg_min(v, (-k, v)), CAST(max(k) AS BIGINT), NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM (SELECT {c} AS v, count(*) AS k FROM {table} WHERE {c} IS NOT NULL GROUP BY {c})""")
    return "\nUNION ALL ".join(rows)


@query("describe_profile", _describe_sql(
    "customer", ["c_custkey", "c_nationkey", "c_acctbal"], ["c_name", "c_mktsegment"]))
def _(spark, sf):
    return profiling.describe_all(a.table(spark, sf, "customer"))


@query("describe_parts", _describe_sql(
    "part", ["p_partkey", "p_size", "p_retailprice"], ["p_name", "p_brand", "p_type"]))
def _(spark, sf):
    return profiling.describe_all(a.table(spark, sf, "part"))


def _times_sql(table, c):
    second = lambda x: f"strftime(make_timestamp(CAST({x} AS BIGINT)), '%Y-%m-%d %H:%M:%S')"
    at = {"mean": "avg(u)", "min": "min(u)", "max": "max(u)",
          **{k: f"quantile_cont(u, {v})" for k, v in profiling.QUARTILES.items()}}
    figures = ", ".join(f"{second(f'floor({x})')} AS {k}" for k, x in at.items())
    return f"SELECT '{c}' AS field, {n('count(u)', 'count')}, {figures} FROM (SELECT epoch_us({c}) AS u FROM {table})"


@query("describe_times", f"""{_times_sql('lineitem', 'l_shipdate')}
UNION ALL {_times_sql('orders', 'o_orderdate')} UNION ALL {_times_sql('events', 'ts')}""")
def _(spark, sf):
    parts = joins.union_all([profiling.describe_times(a.table(spark, sf, t)) for t in ("lineitem", "orders", "events")])
    return parts.select("field", "count", *[
        F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("mean", "min", *profiling.QUARTILES, "max")])


@query("duplicate_ids", f"""SELECT {n('count(*)', 'row_count')}, {n('count(DISTINCT l_orderkey)', 'key_count')},
  {n('count(*) - count(DISTINCT l_orderkey)', 'duplicate_count')} FROM lineitem""")
def _(spark, sf):
    return quality.duplicate_ids(a.table(spark, sf, "lineitem"), "l_orderkey")


@query("pk_violations", f"""WITH {a.IH}, g AS (SELECT id, count(*) AS c FROM ih GROUP BY id)
SELECT 'unique id' AS rule, CAST((SELECT coalesce(sum(c), 0) FROM g WHERE c > 1) AS BIGINT) AS violations
UNION ALL SELECT 'not null id', CAST((SELECT count(*) FROM ih WHERE id IS NULL) AS BIGINT)
UNION ALL SELECT 'not null team_name', CAST((SELECT count(*) FROM ih WHERE team_name IS NULL) AS BIGINT)""")
def _(spark, sf):
    return quality.key_violations(a.issue_history(spark, sf), "id", ["team_name"])


@query("fk_coverage", f"""WITH {a.CALENDAR}, {a.RAW_ISSUES}
SELECT CAST(closed_at AS VARCHAR) AS date_key, {n('count(*)', 'row_count')} FROM f
WHERE closed_at IS NOT NULL AND closed_at NOT IN (SELECT date_key FROM dim) GROUP BY closed_at""")
def _(spark, sf):
    return quality.fk_coverage(a.issue_fact(spark, sf, clean=False), "closed_at", _order_calendar(spark, sf))


@query("freshness", f"""WITH {a.CALENDAR.replace("o_orderdate", "l_shipdate").replace("FROM orders", "FROM lineitem")},
due AS (SELECT max(date_key) AS d FROM dim WHERE is_working_day AND date_key < DATE '2001-11-05'),
l AS (SELECT 'orders' AS table_name, max(o_orderdate) AS t FROM orders
      UNION ALL SELECT 'events', max(ts) FROM events
      UNION ALL SELECT 'lineitem', max(l_shipdate) FROM lineitem)
SELECT table_name, CAST(date_diff('day', CAST(t AS DATE), DATE '2001-11-05') AS INTEGER) AS age_days,
  coalesce(CAST(t AS DATE) >= d, false) AS is_fresh FROM l, due""")
def _(spark, sf):
    load = lambda name, c: a.table(spark, sf, name).select(F.col(c).alias("_loaded_at"))
    tables = {"orders": load("orders", "o_orderdate"), "events": load("events", "ts"),
              "lineitem": load("lineitem", "l_shipdate")}
    lo, hi = tables["lineitem"].agg(F.min("_loaded_at").cast("date"), F.max("_loaded_at").cast("date")).first()
    return quality.freshness(tables, "2001-11-05", calendar.date_dim(spark, lo, hi)).drop("last_load")


@query("last_load", """SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_load FROM events""")
def _(spark, sf):
    stamp = a.table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("_loaded_at"))
    return joins.last_load(stamp)


@query("verify_backfill", f"""WITH {a.TH}
SELECT {n('count(*)', 'row_count')}, min(left(created_at, 10)) AS first_created, max(left(created_at, 10)) AS last_created,
  'due_by' AS missing_fields FROM th""")
def _(spark, sf):
    return quality.verify_backfill(a.ticket_history(spark, sf), ["id", "created_at", "due_by"])


@query("reconcile", f"""WITH {a.ISSUES}, k AS (
  SELECT count(*) FILTER (closed_at BETWEEN DATE '1998-06-01' AND DATE '1998-06-07') AS reported,
    count(*) FILTER (closed_at BETWEEN DATE '1998-06-01' AND DATE '1998-06-30') AS checked FROM f)
SELECT 'closed' AS figure, {r('reported', 'reported')}, {r('checked', 'checked')} FROM k WHERE reported <> checked""")
def _(spark, sf):
    rows = a.issue_fact(spark, sf)
    check = rows.agg(
        F.count_if(text.between_dates("created_at", "1998-06-01", "1998-06-07")).alias("created"),
        F.count_if(text.between_dates("closed_at", "1998-06-01", "1998-06-30")).alias("closed"))
    return quality.reconcile(m.issue_kpis(rows, a.ISSUE_AS_OF), check)


@query("ensure_columns", """SELECT n_nationkey, n_name, n_regionkey, CAST(NULL AS VARCHAR) AS identifier,
  CAST(NULL AS INTEGER) AS priority FROM nation""")
def _(spark, sf):
    wanted = T.StructType([T.StructField("n_name", T.StringType()), T.StructField("identifier", T.StringType()),
                           T.StructField("priority", T.IntegerType())])
    return joins.ensure_columns(a.table(spark, sf, "nation"), wanted)
