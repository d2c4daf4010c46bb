"""Every registered query against its SQL, on the smallest tables."""

import pytest

import oracle
from flowtide.workload.queries import ORACLE, QUERIES

SF = f"{oracle.DATA}/sf0.001"
#: Queries for faults that the smallest tables do not have.
EMPTY: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    diff = oracle.compare(spark, con, SF, QUERIES[name], ORACLE[name])
    assert diff is None or (diff == "no rows" and name in EMPTY), diff


ORDERED = {
    "months_in_order": "month_sort", "first_issues": "id", "assignee_table": "created DESC NULLS LAST, assignee",
    "open_issue_list": "age_days DESC, identifier"}


@pytest.mark.parametrize("name", list(ORDERED))
def test_order(spark, con, name):
    """Rows come in the order that is the query's point."""
    df = QUERIES[name](spark, SF)
    cur = con.execute(f"SELECT * FROM ({ORACLE[name]}) ORDER BY {ORDERED[name]}")
    names = [c[0] for c in cur.description]
    plain = lambda rows, of: [tuple(oracle._plain(r[of.index(c)]) for c in names) for r in rows]
    assert plain(df.collect(), df.columns) == plain(cur.fetchall(), names)
