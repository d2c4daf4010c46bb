"""Labels, flags and buckets derived from codes."""

from pyspark.sql import Column, functions as F

from flowtide import codes
from flowtide.functions.text import _col, in_codes, literal_map


def _lookup(c, labels):
    return F.try_element_at(literal_map(labels), c)


def map_label(c, labels, fallback_prefix="Other"):
    """Label of a code; an unknown code becomes ``Other (NN)``."""
    c = _col(c)
    return F.coalesce(
        _lookup(c, labels),
        F.concat(F.lit(f"{fallback_prefix} ("), c.cast("string"), F.lit(")")),
    )


def status_label(c, labels=codes.STATUS_LABELS):
    return map_label(c, labels)


def triage_status(status, denied, waiting=codes.WAITING_CODES, passed=codes.PASSED_CODES):
    """Where a ticket stands; 'Denied' needs the flag and a waiting status now."""
    is_waiting = in_codes(status, waiting)
    return (
        F.when(is_waiting & _col(denied), "Denied")
        .when(is_waiting, "Waiting")
        .when(in_codes(status, passed), "Passed")
        .otherwise(codes.OTHER)
    )


def state_label(c, strict=False, labels=None):
    """Label of an issue state; ``strict`` knows one spelling of cancelled only."""
    labels = labels or (codes.STATE_LABELS if strict else codes.STATE_LABELS | codes.STATE_SPELLINGS)
    return F.coalesce(_lookup(F.lower(_col(c)), labels), F.lit(codes.OTHER))


def priority_label(c, labels=codes.PRIORITY_LABELS):
    return F.coalesce(_lookup(_col(c), labels), F.lit("Unknown"))


def closed_at(completed, canceled):
    return F.coalesce(_col(completed), _col(canceled))


def project_group(c, names):
    """The named projects as they are, the rest as 'Other', none as 'Unassigned'."""
    c = _col(c)
    named = None
    for n in names:
        cond = F.lower(c) == n.lower()
        named = F.when(cond, n) if named is None else named.when(cond, n)
    rest = F.when(c.isNull(), codes.UNASSIGNED).otherwise(codes.OTHER)
    return rest if named is None else named.otherwise(rest)


def _buckets(c, which, missing):
    c = _col(c)
    out = F.when(c.isNull(), F.lit(missing)).when(c == 1, codes.LEAD_TIME_SAME_DAY[which])
    for top, *bucket in codes.LEAD_TIME_BUCKETS:
        out = out.when(c <= top, bucket[which])
    return out.otherwise(codes.LEAD_TIME_OVER[which])


def lead_time(c):
    """Bucket of a day count; values below 1 fall in the 2-7 days bucket."""
    return _buckets(c, 0, None)


def lead_time_sort(c):
    return _buckets(c, 1, codes.LEAD_TIME_OPEN_SORT)


def triage_stage(status, waiting=codes.STAGE_WAITING_CODES, post=codes.STAGE_POST_CODES):
    return (
        F.when(in_codes(status, waiting), "WaitingForTriage")
        .when(in_codes(status, post), "PostTriage")
        .otherwise("Unknown")
    )


def kpi_category(state_type, state_name, rules=codes.KPI_RULES):
    """First rule whose state types hold the type or whose words occur in the name."""
    kind, name = F.lower(_col(state_type)), F.lower(_col(state_name))
    out = None
    for label, types, words in rules:
        cond: Column = F.coalesce(kind.isin(list(types)), F.lit(False))
        for w in words:
            cond = cond | F.coalesce(name.contains(w), F.lit(False))
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(codes.OTHER)
