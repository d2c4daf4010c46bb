"""Schemas of the raw, history, current and calendar tables."""

from pyspark.sql import types as T


def _struct(**fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


_S, _L, _I, _D, _B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
_DATE, _TS = T.DateType(), T.TimestampType()

RAW_TICKET = _struct(
    id=_L, subject=_S, status=_I, priority=_I, created_at=_S, updated_at=_S,
    due_by=_S, group_id=_L, product_id=_L,
)

RAW_ISSUE = _struct(
    id=_S, number=_I, identifier=_S, title=_S, description=_S,
    createdAt=_S, updatedAt=_S, archivedAt=_S, completedAt=_S, canceledAt=_S, startedAt=_S, dueDate=_S,
    priority=_I, estimate=_D, trashed=_B,
    state=_struct(id=_S, name=_S, type=_S),
    assignee=_struct(id=_S, name=_S, email=_S),
    project=_struct(id=_S, name=_S),
    team=_struct(id=_S, name=_S),
    labels=_struct(nodes=T.ArrayType(_struct(name=_S))),
    parent=_struct(id=_S, identifier=_S),
    cycle=_struct(id=_S, name=_S, startsAt=_S, endsAt=_S),
)

MANIFEST = _struct(
    ts=_S, total_tickets=_L, total_nodes=_L, pages=_I, script_version=_S, page_size=_I,
    include_fields=_S, updated_since=_S, domain=_S, fields=T.ArrayType(_S),
)

# Load order of a history row: later runs, then file name, then place in the file.
ROW_ID = _struct(loaded_at=_TS, file_name=_S, part=_S, block=_L, pos=_L)

LINEAGE = [
    T.StructField("_row_id", ROW_ID, True),
    T.StructField("_loaded_at", _TS, True),
    T.StructField("_snapshot_file", _S, True),
]

TICKET_HISTORY = T.StructType(RAW_TICKET.fields + LINEAGE)

ISSUE_HISTORY = T.StructType(_struct(
    id=_S, number=_I, identifier=_S, title=_S, description=_S,
    created_at=_S, updated_at=_S, archived_at=_S, completed_at=_S, canceled_at=_S, started_at=_S, due_date=_S,
    priority=_I, estimate=_D, trashed=_B,
    state_id=_S, state_name=_S, state_type=_S,
    assignee_id=_S, assignee_name=_S, assignee_email=_S,
    project_id=_S, project_name=_S, team_id=_S, team_name=_S,
    parent_id=_S, parent_identifier=_S,
    cycle_id=_S, cycle_name=_S, cycle_starts_at=_S, cycle_ends_at=_S,
    labels=_S,
).fields + LINEAGE)

IMPORT_LOG = _struct(source=_S, file_name=_S, row_count=_L, imported_at=_TS)

ARRIVALS = _struct(source=_S, file_name=_S, part=_S, row_count=_L, id_count=_L, imported_at=_TS)

CURRENT_TICKET = _struct(
    id=_L, status=_I, created_at=_DATE, updated_at=_DATE, product_id=_L,
    first_waiting_at=_DATE, first_passed_at=_DATE, denied_triage=_B, denied_triage_at=_DATE,
    _loaded_at=_TS,
)

CURRENT_ISSUE = _struct(
    id=_S, identifier=_S, title=_S, state_name=_S, state_type=_S, priority=_I,
    created_at=_DATE, started_at=_DATE, completed_at=_DATE, closed_at=_DATE,
    project_name=_S, assignee_name=_S, labels=_S, trashed=_B, is_incident=_B, _loaded_at=_TS,
)

DATE_DIM = _struct(
    date_key=_DATE, year=_I, quarter_num=_I, quarter_name=_S, month_num=_I, month_name=_S,
    month_short=_S, month_sort=_I, iso_week=_I, year_week=_S, day_of_week_num=_I, day_name=_S,
    day_short=_S, is_weekend=_B, is_public_holiday=_B, is_working_day=_B, working_days_in_week=_I,
)
