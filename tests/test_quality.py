"""Each check kind: a passing and a failing frame, plus all-NULL and empty columns."""

import pytest

from aerosift.operators.quality import Check, Suite, run_suite


def _run(spark, rows, schema, checks, **kw):
    df = spark.createDataFrame(rows, schema)
    return [r.asDict() for r in run_suite(df, Suite("t", checks), **kw).orderBy("check_order").collect()]


CASES = [
    # (check, passing values, failing values)
    (Check("not_null", "v"), [1.0, 2.0], [1.0, None]),
    (Check("accepted_range", "v", min=0, max=10), [0.0, 10.0, None], [0.0, 10.1]),
    (Check("accepted_values", "s", values=("A", "B")), ["A", "B", None], ["A", "C"]),
    (Check("expect_not_null", "v", mostly=0.5), [1.0, None], [None, None, 1.0]),
    (Check("expect_between", "v", min=0, max=10, mostly=0.5), [1.0, 11.0, None, None], [11.0, 12.0, 1.0]),
    (Check("expect_in_set", "s", values=("A",)), ["A", None], ["A", "B"]),
    (Check("expect_match_regex", "s", regex="^[0-9a-f]{6}$", mostly=0.95), ["abc123", None], ["abc123", "ABC123"]),
    (Check("unique", "s"), ["A", "B", None, None], ["A", "A", "B"]),
    (Check("expect_unique", "s"), ["A", "B"], ["A", "A"]),
    (Check("expect_unique_proportion", "s", min=0.3, max=1.0), ["A", "B", "C"], ["A", "A", "A", "A"]),
    (Check("row_count_between", min=2, max=3), [1.0, 2.0], [1.0]),
    (Check("column_exists", "v"), [1.0], None),
]


@pytest.mark.parametrize("chk,good,bad", CASES, ids=[c[0].kind for c in CASES])
def test_check_pass_and_fail(spark, chk, good, bad):
    col = chk.column or "v"
    typ = "string" if col == "s" else "double"
    ok = _run(spark, [(x,) for x in good], f"{col} {typ}", [chk])
    assert len(ok) == 1 and ok[0]["success"] is True and ok[0]["status"] == "pass", ok
    if bad is not None:
        ko = _run(spark, [(x,) for x in bad], f"{col} {typ}", [chk])
        assert ko[0]["success"] is False and ko[0]["status"] == "fail", ko


def test_missing_column_and_warn_severity(spark):
    res = _run(spark, [(1.0,)], "v double",
               [Check("column_exists", "nope"), Check("accepted_range", "v", min=5, max=6, severity="warn")])
    assert res[0]["success"] is False and res[0]["status"] == "fail"
    assert res[1]["status"] == "warn" and res[1]["unexpected"] == 1


def test_all_null_and_empty(spark):
    checks = [Check("expect_between", "v", min=0, max=1), Check("expect_unique_proportion", "v", min=0.1, max=1),
              Check("not_null", "v"), Check("unique", "v")]
    res = _run(spark, [(None,), (None,)], "v double", checks)
    assert [r["success"] for r in res] == [True, False, False, True]
    empty = _run(spark, [], "v double", checks)
    assert [r["total"] for r in empty] == [0, 0, 0, 0]


def test_relationships_and_by_groups(spark):
    parent = spark.createDataFrame([("k1",), ("k2",)], "k string")
    child = spark.createDataFrame([("g1", "k1"), ("g1", "k3"), ("g2", "k2"), ("g2", None)], "g string, k string")
    res = run_suite(child, Suite("t", [Check("relationships", "k", ref=("p", "k")), Check("not_null", "k")]),
                    by=["g"], refs={"p": parent}).collect()
    got = {(r["g"], r["check_name"]): (r["unexpected"], r["success"]) for r in res}
    assert got[("g1", "relationships")] == (1, False)
    assert got[("g1", "not_null")] == (0, True)
    assert got[("g2", "not_null")] == (1, False)
    assert ("g2", "relationships") not in got or got[("g2", "relationships")] == (0, True)


def test_enforce_raise(spark):
    from aerosift.operators.quality import enforce

    df = spark.createDataFrame([(None,)], "v double")
    res = run_suite(df, Suite("t", [Check("not_null", "v")]))
    assert enforce(res, "warn")["failed"] == 1
    with pytest.raises(RuntimeError):
        enforce(res, "raise")


def test_every_group_gets_a_row(spark):
    """Per-group suites keep a result row for groups with an all-NULL column or no orphan."""
    parent = spark.createDataFrame([("k1",)], "k string")
    df = spark.createDataFrame([("g1", "k1"), ("g1", "k9"), ("g2", None), ("g2", None), ("g3", "k1")],
                               "g string, k string")
    res = run_suite(df, Suite("t", [Check("expect_unique_proportion", "k", min=0.1, max=1.0),
                                    Check("unique", "k"), Check("relationships", "k", ref=("p", "k"))]),
                    by=["g"], refs={"p": parent}).collect()
    got = {(r["g"], r["check_name"]): (r["total"], r["unexpected"], r["success"]) for r in res}
    assert len(got) == 9
    assert got[("g2", "expect_unique_proportion")] == (0, 1, False)     # all NULL: no proportion
    assert got[("g2", "unique")] == (0, 0, True)
    assert got[("g1", "relationships")] == (2, 1, False)                # total: the rows checked, not the orphans
    assert got[("g3", "relationships")] == (1, 0, True)
