"""Ticket and issue tables derived from the TPC-H-like tables, in Spark and in SQL.

Both forms follow the same rules; the SQL is what the results are checked
against and goes its own way: DISTINCT ON, exact time joins, range joins.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowtide import codes
from flowtide.functions.text import contains_flag
from flowtide.operators.current import current_issues, current_tickets
from flowtide.operators.facts import fact_issues, fact_tickets

TICKET_AS_OF = "2024-01-25"
TICKET_MONTH_AS_OF = "2024-02-12"
ISSUE_AS_OF = "1998-06-12"
PROJECTS = ("BUILDING", "MACHINERY", "FURNITURE")
SUFFIXES = ("3",)
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
TICKET_ORDER = ("updated_at", "pos")
ISSUE_ORDER = ("updated_at", "pos", "part", "supplier")


def sql_text(value) -> str:
    """A Python value as a literal in SQL."""
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def sql_lookup(column, labels, otherwise) -> str:
    """SQL for the label of a code; ``otherwise`` is SQL for the codes without one."""
    keys, names = (f"[{', '.join(map(sql_text, x))}]" for x in (labels, labels.values()))
    return f"coalesce({names}[list_position({keys}, {column})], {otherwise})"


def sql_codes(values) -> str:
    return f"({', '.join(map(sql_text, values))})"


def table(spark: SparkSession, sf, name) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def ticket_history(spark, sf) -> DataFrame:
    return table(spark, sf, "events").selectExpr(
        "user_id * 1000 + CAST(get_json_object(props, '$.k') AS BIGINT) % 10 AS id",
        "event_type AS subject",
        "CASE event_type WHEN 'error' THEN 17 WHEN 'click' THEN 6 WHEN 'view' THEN 7 WHEN 'purchase' THEN 12 "
        "ELSE 2 END AS status",
        "CAST(event_id % 4 + 1 AS INT) AS priority",
        f"date_format(ts - make_dt_interval(CAST(event_id % 7 AS INT)), \"{ISO}\") AS created_at",
        f"date_format(ts, \"{ISO}\") AS updated_at",
        "CASE WHEN event_id % 11 <> 0 THEN 14000100000 + event_id END AS group_id",
        "user_id % 4 AS product_id",
        "event_id AS pos",
        "to_date(ts) AS snapshot_ts",
    )


TH = """
th AS (
  SELECT user_id * 1000 + CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS id,
         event_type AS subject,
         CASE event_type WHEN 'error' THEN 17 WHEN 'click' THEN 6 WHEN 'view' THEN 7
                         WHEN 'purchase' THEN 12 ELSE 2 END AS status,
         CAST(event_id % 4 + 1 AS INTEGER) AS priority,
         strftime(ts - to_days(CAST(event_id % 7 AS INTEGER)), '%Y-%m-%dT%H:%M:%S.%fZ') AS created_at,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS updated_at,
         CASE WHEN event_id % 11 <> 0 THEN 14000100000 + event_id END AS group_id,
         user_id % 4 AS product_id,
         event_id AS pos,
         CAST(ts AS DATE) AS snapshot_ts
  FROM events
)"""


def tickets(spark, sf) -> DataFrame:
    return current_tickets(ticket_history(spark, sf), suffixes=SUFFIXES, order=TICKET_ORDER)


def ticket_fact(spark, sf) -> DataFrame:
    return fact_tickets(tickets(spark, sf))


WAITING, PASSED = sql_codes(codes.WAITING_CODES), sql_codes(codes.PASSED_CODES)

TICKETS = TH + f""",
firsts AS (
  SELECT id, min(updated_at) FILTER (status IN {WAITING}) AS waited, min(updated_at) FILTER (status IN {PASSED}) AS passed
  FROM th GROUP BY id
),
back AS (
  SELECT th.id, min(updated_at) AS t FROM th JOIN firsts ON firsts.id = th.id AND updated_at > passed
  WHERE status IN {WAITING} GROUP BY th.id
),
newest AS (
  SELECT DISTINCT ON (id) * FROM th WHERE group_id IS NULL OR group_id % 10 <> 3
  ORDER BY id, updated_at DESC, pos DESC
),
tickets AS (
  SELECT id, status, CAST(created_at[:10] AS DATE) AS created_at, CAST(updated_at[:10] AS DATE) AS updated_at,
         product_id, CAST(waited[:10] AS DATE) AS first_waiting_at, CAST(passed[:10] AS DATE) AS first_passed_at,
         t IS NOT NULL AS denied_triage, CAST(t[:10] AS DATE) AS denied_triage_at
  FROM newest JOIN firsts USING (id) LEFT JOIN back USING (id)
),
tf AS (
  SELECT *, {sql_lookup("status", codes.STATUS_LABELS, "format('Other ({})', status)")} AS status_label,
         if(status IN {PASSED}, 'Passed', if(status IN {WAITING}, if(denied_triage, 'Denied', 'Waiting'), 'Other'))
           AS triage_status
  FROM tickets
)"""


def ticket_snapshots(spark, sf) -> DataFrame:
    """Rows of nightly files: the first day is a backfill, some times are missing."""
    return table(spark, sf, "events").selectExpr(
        "user_id AS id",
        f"CASE WHEN event_id % 23 <> 0 THEN date_format(ts - make_dt_interval(CAST(event_id % 5 AS INT)), \"{ISO}\") "
        "END AS updated_at",
        "length(event_type) AS status",
        "event_id AS pos",
        "CASE WHEN dayofmonth(ts) = 1 THEN concat('tickets_backfill_', date_format(ts, 'yyyyMMdd'), '.json') "
        "ELSE concat('tickets_snapshot_', date_format(ts, 'yyyyMMdd'), 'T001500Z.json') END AS _snapshot_file",
    )


SNAPSHOTS = """
sn AS (
  SELECT user_id AS id,
         CASE WHEN event_id % 23 <> 0
              THEN strftime(ts - to_days(CAST(event_id % 5 AS INTEGER)), '%Y-%m-%dT%H:%M:%S.%fZ') END AS updated_at,
         CAST(length(event_type) AS INTEGER) AS status,
         event_id AS pos,
         CASE WHEN day(ts) = 1 THEN 'tickets_backfill_' || strftime(ts, '%Y%m%d') || '.json'
              ELSE 'tickets_snapshot_' || strftime(ts, '%Y%m%d') || 'T001500Z.json' END AS _snapshot_file
  FROM events
),
marked AS (
  SELECT *, max(coalesce(updated_at, '')) OVER (
    PARTITION BY id ORDER BY _snapshot_file GROUPS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS known
  FROM sn
),
loaded AS (
  SELECT id, updated_at, status, pos, _snapshot_file FROM marked
  WHERE _snapshot_file NOT LIKE '%\\_snapshot\\_%' ESCAPE '\\' OR known IS NULL OR coalesce(updated_at, '') > known
)"""


def issues(spark, sf, people=False, clean=True) -> DataFrame:
    """One issue per order, with its first and last shipping day as start and close."""
    ships = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))
    closed = "CASE WHEN last_ship >= o_orderdate THEN CAST(last_ship AS DATE) END" if clean else "CAST(last_ship AS DATE)"
    who = ["project_name", "assignee_name"] if people else [
        "CAST(NULL AS STRING) AS project_name", "CAST(NULL AS STRING) AS assignee_name"]
    rows = table(spark, sf, "orders").join(ships, "o_orderkey", "left")
    if people:
        n = table(spark, sf, "nation").selectExpr(
            "n_nationkey AS c_nationkey", "nullif(n_name, 'NATION_7') AS assignee_name",
            "CASE WHEN n_name <> 'NATION_7' THEN CAST(n_nationkey AS STRING) END AS assignee_id")
        c = table(spark, sf, "customer").selectExpr("c_custkey AS o_custkey", "c_mktsegment AS project_name", "c_nationkey")
        rows = rows.join(c.join(n, "c_nationkey", "left"), "o_custkey", "left")
        who.append("assignee_id")
    rows = rows.selectExpr(
        "*", "CASE WHEN o_orderkey % 13 <> 0 THEN concat_ws('|', "
        "CASE WHEN o_orderpriority = '1-URGENT' THEN 'Incident' END, o_orderpriority) END AS labels")
    return rows.select(
        *[F.expr(e) for e in (
            "CAST(o_orderkey AS STRING) AS id",
            "concat('ISS-', o_orderkey) AS identifier",
            "concat(o_orderpriority, ' order ', o_orderkey) AS title",
            "CASE WHEN o_orderstatus = 'F' THEN 'Done' WHEN o_orderstatus = 'P' THEN 'In Progress' "
            "WHEN o_orderkey % 4 = 0 THEN 'Todo' WHEN o_orderkey % 9 = 0 THEN 'Duplicate' "
            "ELSE 'Waiting for input' END AS state_name",
            "CASE WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'P' THEN 'started' "
            "WHEN o_orderkey % 4 = 0 THEN 'unstarted' WHEN o_orderkey % 9 = 0 THEN 'canceled' "
            "ELSE 'backlog' END AS state_type",
            "CAST(left(o_orderpriority, 1) AS INT) - 1 AS priority",
            "CAST(o_orderdate AS DATE) AS created_at",
            "CAST(first_ship AS DATE) AS started_at",
            f"{closed} AS closed_at",
            "CAST(last_ship AS DATE) AS updated_at",
            "labels", *who)],
        contains_flag("labels", "incident").alias("is_incident"),
    )


def issue_fact(spark, sf, people=False, clean=True, as_of=ISSUE_AS_OF) -> DataFrame:
    return fact_issues(issues(spark, sf, people, clean), as_of, projects=PROJECTS)


STATE_LABEL = sql_lookup("state_type", {**codes.STATE_LABELS, **codes.STATE_SPELLINGS}, sql_text(codes.OTHER))
PRIORITY_LABEL = sql_lookup("priority", codes.PRIORITY_LABELS, "'Unknown'")


def _issues_sql(closed):
    return f"""
ships AS (
  SELECT l_orderkey, CAST(min(l_shipdate) AS DATE) AS first_ship, CAST(max(l_shipdate) AS DATE) AS last_ship
  FROM lineitem GROUP BY l_orderkey
),
issues AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id,
         'ISS-' || o_orderkey AS identifier,
         o_orderpriority || ' order ' || o_orderkey AS title,
         CASE WHEN o_orderstatus = 'F' THEN 'Done' WHEN o_orderstatus = 'P' THEN 'In Progress'
              WHEN o_orderkey % 4 = 0 THEN 'Todo' WHEN o_orderkey % 9 = 0 THEN 'Duplicate'
              ELSE 'Waiting for input' END AS state_name,
         CASE WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'P' THEN 'started'
              WHEN o_orderkey % 4 = 0 THEN 'unstarted' WHEN o_orderkey % 9 = 0 THEN 'canceled'
              ELSE 'backlog' END AS state_type,
         CAST(left(o_orderpriority, 1) AS INTEGER) - 1 AS priority,
         CAST(o_orderdate AS DATE) AS created_at,
         first_ship AS started_at,
         {closed} AS closed_at,
         last_ship AS updated_at,
         CASE WHEN o_orderkey % 13 <> 0 THEN concat_ws('|',
              CASE WHEN o_orderpriority = '1-URGENT' THEN 'Incident' END, o_orderpriority) END AS labels,
         c_mktsegment AS project_name,
         nullif(n_name, 'NATION_7') AS assignee_name,
         CASE WHEN n_name <> 'NATION_7' THEN CAST(n_nationkey AS VARCHAR) END AS assignee_id
  FROM orders LEFT JOIN ships ON l_orderkey = o_orderkey
  LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
),
f AS (
  SELECT *,
         coalesce(lower(labels) LIKE '%incident%', false) AS is_incident,
         {STATE_LABEL} AS state_label,
         {PRIORITY_LABEL} AS priority_label,
         CAST(date_diff('day', created_at, started_at) + 1 AS INTEGER) AS days_to_start,
         CAST(date_diff('day', created_at, closed_at) + 1 AS INTEGER) AS days_to_close,
         CAST(CASE WHEN closed_at IS NULL
              THEN date_diff('day', created_at, DATE '{ISSUE_AS_OF}') + 1 END AS INTEGER) AS age_days,
         CASE WHEN project_name IN ('BUILDING', 'MACHINERY', 'FURNITURE') THEN project_name
              WHEN project_name IS NULL THEN 'Unassigned' ELSE 'Other' END AS project_group,
         coalesce(assignee_name, 'Unassigned') AS assignee
  FROM issues
)"""


def _lead_time_cases(c, field):
    """SQL for the label (field 0) or sort key (1) of a day count that is not missing."""
    whens = [f"WHEN {c} = 1 THEN {sql_text(codes.LEAD_TIME_SAME_DAY[field])}"]
    whens += [f"WHEN {c} <= {bucket[0]} THEN {sql_text(bucket[field + 1])}" for bucket in codes.LEAD_TIME_BUCKETS]
    return f"{' '.join(whens)} ELSE {sql_text(codes.LEAD_TIME_OVER[field])} END"


def lead_time_sql(c):
    return f"CASE WHEN {c} IS NULL THEN NULL {_lead_time_cases(c, 0)}"


def lead_time_sort_sql(c):
    return f"CASE WHEN {c} IS NULL THEN {codes.LEAD_TIME_OPEN_SORT} {_lead_time_cases(c, 1)}"


ISSUES = _issues_sql("CASE WHEN last_ship >= CAST(o_orderdate AS DATE) THEN last_ship END")
RAW_ISSUES = _issues_sql("last_ship")


def issue_history(spark, sf) -> DataFrame:
    """One issue version per line item."""
    l = table(spark, sf, "lineitem")
    key, supp = F.col("l_orderkey"), F.col("l_suppkey")
    flags = F.concat("l_returnflag", "l_linestatus")
    kinds = {"AO": ("backlog", "Backlog"), "NO": ("unstarted", "Todo"), "RO": ("started", "In Progress"),
             "AF": ("completed", "Done"), "NF": ("canceled", "Duplicate"), "RF": ("triage", "Waiting")}
    pick = lambda i: F.element_at(F.create_map(*[F.lit(x) for k, v in kinds.items() for x in (k, v[i])]), flags)
    # Shipping times are whole days, so the ISO text is put together from the date.
    day_text = lambda c: F.concat(c.cast("date").cast("string"), F.lit("T00:00:00.000000Z"))
    ship_day = F.col("l_shipdate").cast("date").cast("string")
    ship = day_text(F.col("l_shipdate"))
    return l.select(
        key.cast("string").alias("id"),
        F.when(key % 17 == 0, F.lit(None)).when(key % 5 == 0, F.concat(F.lit("dev-"), key.cast("string")))
        .otherwise(F.concat(F.lit("OPS-"), key.cast("string"))).alias("identifier"),
        F.concat(F.lit("item "), key.cast("string")).alias("title"),
        pick(0).alias("state_type"),
        pick(1).alias("state_name"),
        (F.col("l_linenumber") % 6).alias("priority"),
        day_text(F.date_add(F.lit("1995-01-01").cast("date"), (key % 2000).cast("int"))).alias("created_at"),
        F.concat(ship_day, F.lit("T"), F.lpad(F.col("l_linenumber").cast("string"), 2, "0"),
                 F.lit(":00:00.000000Z")).alias("updated_at"),
        F.when(flags.isin("RO", "AF"), ship).alias("started_at"),
        F.when(flags == "AF", ship).alias("completed_at"),
        F.when(flags == "NF", ship).alias("canceled_at"),
        F.concat(F.lit("P"), (supp % 5).cast("string")).alias("project_name"),
        F.concat(F.lit("person "), (F.col("l_partkey") % 20).cast("string")).alias("assignee_name"),
        F.when(supp % 3 == 0, "development").when(supp % 3 == 1, "Operational").alias("team_name"),
        F.when(supp % 4 == 0, "Bug|INCIDENT").when(supp % 4 == 1, "Non-incidental").when(supp % 4 == 2, "Feature")
        .alias("labels"),
        F.lit(False).alias("trashed"),
        F.col("l_linenumber").alias("pos"),
        F.col("l_partkey").alias("part"),
        supp.alias("supplier"),
        F.last_day("l_shipdate").alias("snapshot_ts"),
    )


def current_issue_table(spark, sf, **options) -> DataFrame:
    return current_issues(issue_history(spark, sf), order=ISSUE_ORDER, **options)


IH = """
ih AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS id,
         CASE WHEN l_orderkey % 17 = 0 THEN NULL WHEN l_orderkey % 5 = 0 THEN 'dev-' || l_orderkey
              ELSE 'OPS-' || l_orderkey END AS identifier,
         'item ' || l_orderkey AS title,
         CASE l_returnflag || l_linestatus WHEN 'AO' THEN 'backlog' WHEN 'NO' THEN 'unstarted'
              WHEN 'RO' THEN 'started' WHEN 'AF' THEN 'completed' WHEN 'NF' THEN 'canceled' ELSE 'triage' END AS state_type,
         CASE l_returnflag || l_linestatus WHEN 'AO' THEN 'Backlog' WHEN 'NO' THEN 'Todo'
              WHEN 'RO' THEN 'In Progress' WHEN 'AF' THEN 'Done' WHEN 'NF' THEN 'Duplicate' ELSE 'Waiting' END AS state_name,
         l_linenumber % 6 AS priority,
         strftime(DATE '1995-01-01' + CAST(l_orderkey % 2000 AS INTEGER), '%Y-%m-%dT%H:%M:%S.%fZ') AS created_at,
         strftime(l_shipdate + to_hours(l_linenumber), '%Y-%m-%dT%H:%M:%S.%fZ') AS updated_at,
         CASE WHEN l_returnflag || l_linestatus IN ('RO', 'AF')
              THEN strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%fZ') END AS started_at,
         CASE WHEN l_returnflag || l_linestatus = 'AF'
              THEN strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%fZ') END AS completed_at,
         CASE WHEN l_returnflag || l_linestatus = 'NF'
              THEN strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%fZ') END AS canceled_at,
         'P' || (l_suppkey % 5) AS project_name,
         'person ' || (l_partkey % 20) AS assignee_name,
         CASE l_suppkey % 3 WHEN 0 THEN 'development' WHEN 1 THEN 'Operational' END AS team_name,
         CASE l_suppkey % 4 WHEN 0 THEN 'Bug|INCIDENT' WHEN 1 THEN 'Non-incidental' WHEN 2 THEN 'Feature' END AS labels,
         false AS trashed,
         l_linenumber AS pos, l_partkey AS part, l_suppkey AS supplier,
         CAST(last_day(l_shipdate) AS DATE) AS snapshot_ts
  FROM lineitem
)"""

CURRENT_ISSUES = IH + """,
kept AS (
  SELECT DISTINCT ON (id) * FROM ih WHERE NOT (identifier ILIKE 'dev%' AND team_name ILIKE 'development')
  ORDER BY id, updated_at DESC, pos DESC, part DESC, supplier DESC
),
ci AS (
  SELECT * REPLACE (CAST(created_at[:10] AS DATE) AS created_at, CAST(started_at[:10] AS DATE) AS started_at,
                    CAST(completed_at[:10] AS DATE) AS completed_at),
         CAST(coalesce(completed_at, canceled_at)[:10] AS DATE) AS closed_at,
         coalesce(labels ILIKE '%incident%', false) AS is_incident
  FROM kept
)"""

def sql_rows(rows) -> str:
    return ", ".join(f"({', '.join(map(sql_text, row))})" for row in rows)


# Calendar over the order dates, in SQL.
CALENDAR = f"""
bounds AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
yrs AS (SELECT unnest(generate_series(year(lo) - 1, year(hi) + 1)) AS y FROM bounds),
e0 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM yrs),
e1 AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM e0),
e2 AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM e1),
e3 AS (SELECT *, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS n FROM e2),
easter AS (SELECT y, make_date(y, n // 31, n % 31 + 1) AS d FROM e3),
hol AS (
  SELECT CAST(d + o.off AS DATE) AS holiday, o.name, o.name_sv
  FROM easter, (VALUES {sql_rows(codes.EASTER_HOLIDAYS)}) AS o(off, name, name_sv)
  UNION ALL
  SELECT make_date(y, m, dd), name, name_sv
  FROM yrs, (VALUES {sql_rows(codes.FIXED_HOLIDAYS)}) AS x(m, dd, name, name_sv)
  UNION ALL
  SELECT CAST(s + CAST((13 - isodow(s)) % 7 AS INTEGER) AS DATE), name, name_sv
  FROM (SELECT make_date(y, m, dd) AS s, name, name_sv
        FROM yrs, (VALUES {sql_rows(codes.SATURDAY_HOLIDAYS)}) AS x(m, dd, name, name_sv))
),
alldays AS (
  SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP) - INTERVAL 6 DAY, CAST(hi AS TIMESTAMP) + INTERVAL 6 DAY,
                                     INTERVAL 1 DAY)) AS DATE) AS d FROM bounds
),
flagged AS (
  SELECT d, isodow(d) >= 6 AS is_weekend, d IN (SELECT holiday FROM hol) AS is_public_holiday,
         strftime(d, '%G-W%V') AS year_week FROM alldays
),
weeks AS (
  SELECT *, NOT (is_weekend OR is_public_holiday) AS is_working_day,
         CAST(sum(CASE WHEN is_weekend OR is_public_holiday THEN 0 ELSE 1 END)
              OVER (PARTITION BY year_week) AS INTEGER) AS working_days_in_week
  FROM flagged
),
dim AS (
  SELECT d AS date_key, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter_num,
         'Q' || quarter(d) AS quarter_name, CAST(month(d) AS INTEGER) AS month_num, monthname(d) AS month_name,
         left(monthname(d), 3) AS month_short, CAST(year(d) * 100 + month(d) AS INTEGER) AS month_sort,
         CAST(weekofyear(d) AS INTEGER) AS iso_week, year_week, CAST(isodow(d) AS INTEGER) AS day_of_week_num,
         dayname(d) AS day_name, left(dayname(d), 3) AS day_short,
         is_weekend, is_public_holiday, is_working_day, working_days_in_week
  FROM weeks, bounds WHERE d BETWEEN lo AND hi
)"""
