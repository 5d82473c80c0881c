import random

import pytest

from cargolens.plans import quality as q
from cargolens.plans.quality_state import CheckState
from conftest import rows


@pytest.fixture(scope="module")
def tables(spark):
    child = spark.createDataFrame(
        [("1", "a", "ok", 5.0), ("1", "a", "bad", -1.0), ("2", "x", None, 0.0), ("3", "x", "ok", 31.0),
         (None, None, "ok", None), (None, "b", "ok", 30.0)],
        "id string, parent string, status string, weight double")
    parent = spark.createDataFrame([("a",), ("b",), ("b",)], "key string")
    return {"child": child, "parent": parent}


CHECKS = [
    (q.Check("child", "id", "not_null"), 2),
    (q.Check("child", "id", "unique"), 1),
    (q.Check("child", "status", "accepted_values", values=("ok",)), 1),
    (q.Check("child", "weight", "in_range", above=0.0, high=30.0), 3),
    (q.Check("child", "weight", "in_range", low=0.0), 1),
    (q.Check("child", "parent", "relationships", parent=("parent", "key")), 2),
    (q.Check("child", None, "same_rows", parent=("parent", None)), 3),
    (q.Check("parent", "key", "not_null"), 0),
]


def test_all_checks_in_one_report(tables):
    got = q.run_checks(tables, [c for c, _ in CHECKS]).collect()
    found = {(r.table_name, r.column_name, r.check_name, r.failing_rows) for r in got}
    assert len(got) == len(CHECKS)
    assert found == {(c.table, c.column, c.kind, n) for c, n in CHECKS}
    assert all(r.passed == (r.failing_rows == 0) for r in got)


@pytest.mark.parametrize("check, n", [c for c in CHECKS if c[0].kind in q.ROW_KINDS])
def test_failing_rows(tables, check, n):
    assert q.failing_rows(tables, check).count() == n


def test_failing_keys(tables):
    unique, related = CHECKS[1][0], CHECKS[5][0]
    assert [tuple(r) for r in q.failing_rows(tables, unique).collect()] == [("1", 2)]
    assert [tuple(r) for r in q.failing_rows(tables, related).collect()] == [("x", 2)]


def test_empty_tables_pass(tables):
    empty = {name: df.where("false") for name, df in tables.items()}
    assert all(r.passed for r in q.run_checks(empty, [c for c, _ in CHECKS]).collect())


def test_unknown_checks(tables):
    with pytest.raises(ValueError):
        q.run_checks(tables, [q.Check("child", "id", "nonsense")])
    with pytest.raises(ValueError):
        q.failing_rows(tables, CHECKS[6][0])


def test_declared_checks():
    assert len(q.mart_checks()) == 17


def test_growing_tables_are_checked_by_batches(spark, tmp_path):
    """Any order of arrival gives the counts of the whole tables."""
    checks = [q.Check("child", "id", "unique"), q.Check("child", "id", "not_null"),
              q.Check("child", "parent", "relationships", parent=("parent", "id")),
              q.Check("child", "kind", "accepted_values", values=("a", "b")),
              q.Check("child", "n", "in_range", low=0.0, above=None, high=5.0),
              q.Check("parent", "id", "unique"),
              q.Check("parent", None, "same_rows", parent=("child", None))]
    pick = random.Random(4)
    child = [(pick.choice([None, *range(40)]), pick.choice([None, *range(12)]), pick.choice(["a", "b", "c", None]),
              pick.choice([-1.0, 2.0, 7.0, float("nan"), None]), f"2026-01-0{1 + k % 4}") for k in range(60)]
    parent = [(pick.randrange(9),) for _ in range(10)]
    kinds = {"child": "id int, parent int, kind string, n double, day string", "parent": "id int"}
    frames = {"child": child, "parent": parent}
    def table(name, data):
        return spark.createDataFrame(data, kinds[name])
    state = CheckState(spark, str(tmp_path), checks, {"child": "day"})
    batches = [{"child": child[:25]}, {"child": child[25:40], "parent": parent[:3]},
               {"parent": parent[3:]}, {"child": child[40:], "parent": []}, {}]
    for number, batch in enumerate(batches):
        for _ in range(1 + (number == 1)):  # a batch that runs again changes nothing
            state.add(number, {name: table(name, data) for name, data in batch.items()})
    want = q.run_checks({n: table(n, d) for n, d in frames.items()}, checks)
    assert rows(state.results()) == rows(want)
    by_day = state.by_day().where("check_name = 'in_range'").collect()
    assert {str(r["day"]): r["failing_rows"] for r in by_day} == {
        d: sum(c[4] == d and c[3] is not None and not 0 <= c[3] <= 5 for c in child) for d in {c[4] for c in child}}
