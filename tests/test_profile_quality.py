import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowtide.operators import calendar, profiling, quality


def test_profile(spark):
    df = spark.sql("""select * from values
      (1, 'x', array('a', 'b'), '2026-01-01T00:00:00Z', true, named_struct('a', 1)),
      (2, null, array(), 'junk', true, null),
      (2, 'x', null, '2026-02-01T00:00:00Z', false, named_struct('a', 1))
      as t(n, s, arr, ts, flag, js)""")
    got = {r.field: r for r in profiling.profile(df, times=["ts"]).collect()}
    assert {k: v.inferred_type for k, v in got.items()} == {
        "n": "numeric", "s": "string", "arr": "array", "ts": "timestamp", "flag": "boolean", "js": "json"}
    assert (got["s"].missing_rate, got["s"].unique_count, got["n"].unique_count) == (0.333333, 1, 2)
    assert (got["arr"].max_array_len, got["s"].max_array_len) == (2, None)
    assert (got["ts"].parse_errors, str(got["ts"].min_date), str(got["ts"].max_date)) == (
        1, "2026-01-01 00:00:00", "2026-02-01 00:00:00")
    assert got["flag"].suggested_handling == "normalize to boolean"


@pytest.mark.parametrize("most", [profiling.MOST, 40, 1])
def test_quantiles_are_exact(spark, most):
    rnd = random.Random(7)
    hot = [3.0] * 700
    rows = [(x, rnd.lognormvariate(0, 3), None if i % 3 else float(i)) for i, x in enumerate(
        hot + [rnd.choice([1.0, 2.0, 9.5, -4.25]) for _ in range(1300)])]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(5)
    qs = {"q01": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "q999": 0.999, "lo": 0.0, "hi": 1.0}
    got = {r.field: r for r in profiling.exact_quantiles(df, ["a", "b", "c"], qs, most).collect()}
    for i, name in enumerate("abc"):
        values = [r[i] for r in rows if r[i] is not None]
        for q, v in qs.items():
            assert got[name][q] == pytest.approx(np.quantile(values, v), rel=1e-12), (name, q)


def test_quantiles_where_one_value_fills_nearly_all(spark):
    rng = random.Random(4)
    values = [5.0] * 6000 + [rng.uniform(4.999, 5.0) for _ in range(300)] + [rng.uniform(-1e9, 1e9) for _ in range(100)]
    df = spark.createDataFrame([(x,) for x in values], "a double").repartition(4)
    qs = {"q001": 0.001, "q01": 0.01, "q02": 0.02, "p50": 0.5, "q99": 0.995}
    got = profiling.exact_quantiles(df, ["a"], qs, most=3).first()
    assert [got[q] for q in qs] == [pytest.approx(np.quantile(values, v), rel=1e-12) for v in qs.values()]


def test_types_are_inferred_from_content(spark):
    df = spark.sql("""select * from values
      ('true', '1', '2026-01-01', '[1, 2, 3]', '{"a": 1}', 'x', '1', cast(null as string), '2026-01-01T10:00:00Z'),
      ('FALSE', ' -2.5e3', '2026-02-01T00:00:00Z', '[]', '{}', '2026-01-01', 'true', null, 'soon'),
      (null, '.5', null, '["a"]', null, '1', '[', null, '2026-01-03')
      as t(flag, num, day, arr, obj, s, mixed, none, most)""")
    kinds = lambda **o: {r.field: r.inferred_type for r in profiling.profile(df, **o).collect()}
    want = {"flag": "boolean", "num": "numeric", "day": "timestamp", "arr": "array", "obj": "json", "s": "string",
            "mixed": "string", "none": "string", "most": "string"}
    assert kinds() == want
    assert kinds(tolerance=0.4) == want | {"most": "timestamp"}
    assert set(kinds(infer=False).values()) == {"string"}
    got = {r.field: r for r in profiling.profile(df, tolerance=0.4, source="t", notes={"s": "free"},
                                                 handling={"numeric": "cast", "s": "trim"}).collect()}
    assert got["arr"].max_array_len == 3 and got["num"].max_array_len is None
    assert (got["most"].parse_errors, str(got["most"].max_date)[:10], got["day"].parse_errors) == (1, "2026-01-03", 0)
    assert (got["s"].source, got["s"].notes, got["s"].suggested_handling, got["num"].suggested_handling) == (
        "t", "free", "trim", "cast")
    assert got["none"].missing_rate == 1.0 and got["none"].unique_count == 0 and got["flag"].unique_count == 2


def test_profile_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a int, `b.c` string, d array<int>, e timestamp")
    got = [(r.field, r.inferred_type, r.missing_rate, r.unique_count) for r in profiling.profile(df).collect()]
    assert sorted(got) == [("a", "numeric", None, 0), ("b.c", "string", None, 0), ("d", "array", None, 0), ("e", "timestamp", None, 0)]


def test_profile_shuffles_no_text(spark):
    df = spark.createDataFrame([("x" * 50_000 + str(i % 40),) for i in range(400)], "s string").repartition(4)
    assert profiling.profile(df).first().unique_count == 40
    plan = profiling.distinct_counts(df.select("s"))._jdf.queryExecution().executedPlan().toString()
    keys = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert keys and all("s#" not in line for line in keys)


def test_describe(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (4, "a"), (None, "b"), (5, None)], "n int, s string")
    got = {r.field: r.asDict() for r in profiling.describe_all(df).collect()}
    assert (got["s"]["count"], got["s"]["unique"], got["s"]["top"], got["s"]["freq"]) == (4, 2, "a", 2)
    n = got["n"]
    assert (n["count"], n["mean"], n["min"], n["p25"], n["p50"], n["p75"], n["max"]) == (4, 3.0, 1.0, 1.75, 3.0, 4.25, 5.0)
    assert n["std"] == pytest.approx(np.std([1, 2, 4, 5], ddof=1)) and n["top"] is None


def test_describe_of_an_empty_column(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    got = {r.field: r for r in profiling.describe_all(df).collect()}
    assert got["a"]["count"] == 0 and got["a"]["p50"] is None and got["b"]["p50"] == 1.0


def test_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "c")], "id long, status string")
    assert tuple(quality.duplicate_ids(df).first()) == (4, 3, 1)
    assert {r.rule: r.violations for r in quality.key_violations(df, "id", ["status"]).collect()} == {
        "unique id": 2, "not null id": 1, "not null status": 1}


def test_require_rows(spark):
    with pytest.raises(ValueError):
        quality.require_rows(spark.range(0), "tickets")
    assert quality.require_rows(spark.range(1), "tickets").count() == 1


def test_verify_and_drift(spark):
    df = spark.createDataFrame([(1, "2026-01-02T00:00:00Z"), (2, "2026-01-01T00:00:00Z")], "id long, created_at string")
    assert tuple(quality.verify_backfill(df, ["id", "due"]).first()) == (2, "2026-01-01", "2026-01-02", "due")
    expected = spark.createDataFrame([], "id int, created_at string, gone string").schema
    assert [tuple(r) for r in quality.schema_drift(df, expected).collect()] == [
        ("gone", "removed", "string", None), ("id", "changed", "int", "bigint")]


def test_freshness_knows_working_days(spark):
    dim = calendar.date_dim(spark, "2026-04-01", "2026-04-30")
    load = lambda d: spark.createDataFrame([(dt.datetime(2026, 4, d, 5),)], "_loaded_at timestamp")
    # Tuesday after Easter: Thursday 2 April was the last working day.
    tables = {"a": load(2), "b": load(1), "c": load(7).limit(0)}
    got = {r.table_name: (r.age_days, r.is_fresh) for r in quality.freshness(tables, "2026-04-07", dim).collect()}
    assert got == {"a": (5, True), "b": (6, False), "c": (None, False)}


def test_reconcile_and_coverage(spark):
    kpis = spark.createDataFrame([(3, 4)], "created long, closed long")
    check = spark.createDataFrame([(3, 5)], "created int, closed int")
    assert [tuple(r) for r in quality.reconcile(kpis, check).collect()] == [("closed", 4.0, 5.0)]
    dim = calendar.date_dim(spark, "2026-01-01", "2026-01-31")
    fact = spark.createDataFrame([(dt.date(2026, 1, 5),), (dt.date(2025, 12, 31),), (dt.date(2025, 12, 31),), (None,)], "d date")
    assert [(str(r.date_key), r.row_count) for r in quality.fk_coverage(fact, "d", dim).collect()] == [("2025-12-31", 2)]


def test_describe_times(spark):
    df = spark.sql("""select cast(t as timestamp_ntz) t, cast(t as date) d, 1 n from values
      ('2026-03-01 00:00:00'), ('2026-03-03 12:00:00.5'), (null), ('2026-03-04 00:00:00') as x(t)""")
    got = {r.field: r for r in profiling.describe_times(df).collect()}
    assert set(got) == {"t", "d"} and got["t"]["count"] == 3
    assert str(got["t"].p50) == "2026-03-03 12:00:00.500000" and str(got["t"].p75) == "2026-03-03 18:00:00.250000"
    assert str(got["d"].min) == "2026-03-01 00:00:00" and str(got["d"].max) == "2026-03-04 00:00:00"
