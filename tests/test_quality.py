from questlog.operators import quality
from questlog.operators.events import events_clean
from questlog.operators.retention import retention_validation
from questlog.operators.sessions import sessions
from questlog.operators.users import users_dim
from questlog.plans import medallion
from questlog.sources.warehouse import Warehouse
from tests.fixtures import raw_assignments, raw_events


def _checks(spark, assignments, raw_rows):
    raw = raw_events(spark, raw_rows)
    assigned = raw_assignments(spark, assignments)
    events = events_clean(raw)
    played = sessions(events)
    users = users_dim(assigned, events, played)
    checks = quality.quality_checks(
        raw, assigned, events, played, users, retention_validation(users)
    )
    return checks, {r["check_name"]: (r["passed"], r["detail"]) for r in checks.collect()}


def _visits(userid, *days):
    return [
        {"userid": str(userid), "client_event_time": f"2024-01-{d:02d} 10:00:00",
         "event_id": f"{userid}-{d}"}
        for d in days
    ]


def test_all_checks_pass(spark):
    rows = _visits(1, 1, 2, 8)
    checks, out = _checks(spark, [(1, "gate_30", 0, True, True)], rows + rows[:1])
    assert out == {
        "assigned_users_preserved": (True, "assignments=1 users=1"),
        "dedup_removed_rows": (True, "raw=4 clean=3"),
        "event_ids_unique": (True, "duplicated=0"),
        "d1_retention_within_5pp[gate_30]": (True, "published=1.0000 derived=1.0000"),
        "d7_retention_within_5pp[gate_30]": (True, "published=1.0000 derived=1.0000"),
        "no_orphan_sessions": (True, "orphans=0"),
    }
    assert tuple(quality.verdict(checks).first()) == (True, 0)


def test_checks_fail(spark):
    """A clean feed, a wrong rate, a player nobody assigned and one without id."""
    rows = _visits(1, 1, 2) + _visits(9, 1) + [{"userid": None, "event_id": "n"}]
    checks, out = _checks(spark, [(1, "gate_30", 0, False, False)], rows)
    failed = {name for name, (passed, _) in out.items() if not passed}
    assert failed == {
        "dedup_removed_rows",
        "d1_retention_within_5pp[gate_30]",
        "no_orphan_sessions",
    }
    assert out["no_orphan_sessions"][1] == "orphans=2"
    assert tuple(quality.verdict(checks).first()) == (False, 3)


def test_duplicate_assignments(spark):
    rows = [(1, "gate_30", 0, True, True), (1, "gate_40", 0, True, True), (2, "a", 0, True, True)]
    out = quality.duplicate_keys(raw_assignments(spark, rows), "userid").collect()
    assert [tuple(r) for r in out] == [("1", 2)]


def test_known_counts_are_not_counted_again(spark, tmp_path):
    """Counts come from the writes: the raw events are not read, the cleaned ones for their ids only."""
    rows = _visits(1, 1, 2, 8)
    raw, assigned = raw_events(spark, rows + rows[:1]), raw_assignments(spark, [(1, "gate_30", 0, True, True)])
    assigned = assigned.selectExpr("*", "'a.csv' AS filename", "'a.csv' AS _source_file")
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    made = medallion.build(raw, assigned, warehouse)
    assert {r["check_name"]: r["passed"] for r in made.collect()}["dedup_removed_rows"]
    assert [r["row_count"] for r in medallion.row_report(warehouse).collect()] == [4, 1, 3, 3, 1]

    read = {t: warehouse.read(t) for t in ("bronze.raw_events", "bronze.raw_experiment_assignments", "silver.events_clean", "silver.sessions", "silver.users_dim")}
    counts = dict(zip(("raw_events", "raw_assignments", "events", "users"), (4, 1, 3, 1)))
    checks = quality.quality_checks(*read.values(), retention_validation(read["silver.users_dim"]), counts)
    plan = checks._jdf.queryExecution().optimizedPlan().toString() + "".join(checks.inputFiles())
    assert "raw_events" not in plan and "raw_experiment_assignments" not in plan
    assert checks.exceptAll(made).count() == made.exceptAll(checks).count() == 0


def test_rows_of_empty_tables(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    for name, df in {"a": spark.createDataFrame([], "x long"), "b": spark.range(5).where("id > 9"), "c": spark.range(7)}.items():
        warehouse.write(f"gold.{name}", df)
        warehouse.write(f"gold.{name}_by", df.selectExpr("*", "1 AS part"), "part")
    assert [warehouse.rows(f"gold.{n}") for n in ("a", "b", "c", "a_by", "b_by", "c_by")] == [0, 0, 7, 0, 0, 7]
