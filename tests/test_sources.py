import subprocess
import sys
from pathlib import Path

import pytest
from pyspark import cloudpickle

from questlog.operators.bronze import land
from questlog.plans import medallion
from questlog.session import scratch_dir, scratch_scope
from questlog.sources import landing_csv
from questlog.sources.landing_csv import EVENT_COLUMNS
from questlog.sources.warehouse import TABLES, Warehouse
from tests.fixtures import raw_events


def _write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode() if isinstance(text, str) else text)


def test_columns_match_by_name(spark, tmp_path):
    _write(tmp_path / "l a" / "f1+.csv", "a,b,c\n1,2,3\n4,,\"\"\n")
    _write(tmp_path / "l a" / "f2.csv", "c,a,d\r\n30,10,40\r\n")
    _write(tmp_path / "l a" / "f3.csv", "a,b,c\n7,\"x, \"\"y\"\"\",9\n")
    _write(tmp_path / "l a" / "f4.csv", "﻿a,b,c\n")
    _write(tmp_path / "l a" / "f5.csv", "")
    df = landing_csv.read_csv_by_name(spark, str(tmp_path / "l a" / "*.csv"))
    assert df.columns == ["a", "b", "c", "d", "filename", "_source_file"]
    rows = {tuple(r)[:4] + (r["_source_file"],) for r in df.collect()}
    assert rows == {
        ("1", "2", "3", None, "f1+.csv"),
        ("4", None, None, None, "f1+.csv"),
        ("10", None, "30", "40", "f2.csv"),
        ("7", 'x, "y"', "9", None, "f3.csv"),
    }
    assert all(r["filename"].endswith(f"/l a/{r['_source_file']}") for r in df.collect())
    assert {t for _, t in df.dtypes} == {"string"}


def test_headers_from_spark_where_python_cannot_open(spark, tmp_path, monkeypatch):
    _write(tmp_path / "f1.csv", "a,b\n1,2\n")
    _write(tmp_path / "f 2.csv", "﻿b,a\n2,1\n")
    monkeypatch.setattr(landing_csv, "_header_reader", lambda: _no_header)
    rows = landing_csv.read_csv_by_name(spark, str(tmp_path)).select("a", "b").collect()
    assert [tuple(r) for r in rows] == [("1", "2")] * 2


def _no_header(batches):
    for batch in batches:
        yield batch.assign(header=None)


def test_header_longer_than_one_read(spark, tmp_path):
    names = [f"column_{i}" for i in range(4000)]
    _write(tmp_path / "f.csv", ",".join(names) + "\n" + "x," * 3999 + "x\n")
    (row,) = landing_csv._headers(spark, str(tmp_path)).collect()
    assert row["header"].split(",") == names


def test_many_small_files_of_two_headers_are_one_scan(spark, tmp_path):
    """10,000 files, a thousand of them with their columns swapped."""
    for i in range(10_000):
        header, row = ("b,a", f"x,{i}") if i % 10 == 3 else ("a,b", f"{i},x")
        (tmp_path / f"f{i}.csv").write_text(f"{header}\n{row}\n")
    df = landing_csv.read_csv_by_name(spark, str(tmp_path))
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    got = {(r["a"], r["b"], r["_source_file"]) for r in df.collect()}
    assert got == {(str(i), "x", f"f{i}.csv") for i in range(10_000)}


@pytest.mark.parametrize("first", ["a,b\n1,x\n", "b,a,c\nx,1,y\n"])
def test_file_with_swapped_columns_that_comes_in_between_fails(spark, tmp_path, monkeypatch, first):
    """Whether or not other files differ: no row is read under wrong names."""
    _write(tmp_path / "f1.csv", "a,b\n1,x\n")
    _write(tmp_path / "f2.csv", first)
    headers = landing_csv._headers

    def then_lands(spark, path):
        found = headers(spark, path)
        found.collect()
        _write(tmp_path / "f3.csv", "b,a\nx,1\n")
        return found

    monkeypatch.setattr(landing_csv, "_headers", then_lands)
    df = landing_csv.read_csv_by_name(spark, str(tmp_path))
    for read in (df.collect, df.select("a").collect, df.count):
        with pytest.raises(Exception, match="CSV header does not conform|a file came"):
            read()


def test_rows_that_do_not_fit_one_of_several_headers_fail(spark, tmp_path):
    good = ['"x, ""y""",2', ",", '"",""', '1,"a,b"']
    _write(tmp_path / "g" / "wide.csv", "a,b,c\n1,2,3\n,,\n")
    _write(tmp_path / "g" / "narrow.csv", "c,a\n" + "\n".join(good) + "\n")
    rows = landing_csv.read_csv_by_name(spark, str(tmp_path / "g")).select("a", "b", "c").collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(
        map(str, [("1", "2", "3"), (None, None, None), ("2", None, 'x, "y"'), (None, None, None), (None, None, None), ("a,b", None, "1")])
    )
    for n, (file, row) in enumerate([("wide", "1,2"), ("wide", "1,2,3,4"), ("narrow", "1"), ("narrow", "1,2,3"), ("narrow", "1,2,3,4")]):
        folder = tmp_path / str(n)
        _write(folder / "wide.csv", "a,b,c\n1,2,3\n" + (f"{row}\n" if file == "wide" else ""))
        _write(folder / "narrow.csv", "c,a\n1,2\n" + (f"{row}\n" if file == "narrow" else ""))
        df = landing_csv.read_csv_by_name(spark, str(folder))
        for read in (df.select("a").collect, df.count):
            with pytest.raises(Exception, match="(?i)malformed"):
                read()


def test_header_reader_needs_no_package_on_executors():
    code = (
        "import pickle, sys; "
        "fn = pickle.loads(sys.stdin.buffer.read()); "
        "assert 'questlog' not in sys.modules; print(callable(fn))"
    )
    out = subprocess.run(
        [sys.executable, "-c", code],
        input=cloudpickle.dumps(landing_csv._header_reader()),
        capture_output=True,
        cwd="/",
        check=True,
    )
    assert out.stdout.strip() == b"True"


def test_rows_that_do_not_fit_the_header_fail(spark, tmp_path):
    for i, row in enumerate(["1,2,3,4", "1,2"]):
        _write(tmp_path / str(i) / "f.csv", f"a,b,c\n1,2,3\n{row}\n")
        df = landing_csv.read_csv_by_name(spark, str(tmp_path / str(i)))
        for read in (df.collect, df.select("a").collect, df.select("c").distinct().collect, df.count):
            with pytest.raises(Exception, match="(?i)malformed"):
                read()


def test_line_breaks_inside_quotes(spark, tmp_path):
    _write(tmp_path / "f.csv", 'a,b\n1,"x\ny"\n2,z\n')
    df = landing_csv.read_csv_by_name(spark, str(tmp_path), multiline=True)
    assert [tuple(r)[:2] for r in df.collect()] == [("1", "x\ny"), ("2", "z")]
    assert [r[0] for r in df.select("a").collect()] == ["1", "2"] and df.count() == 2
    refused = landing_csv.read_csv_by_name(spark, str(tmp_path))
    for read in (refused.collect, refused.select("a").collect, refused.count):
        with pytest.raises(Exception, match="(?i)malformed"):
            read()


def test_nothing_to_read(spark, tmp_path):
    _write(tmp_path / "f.csv", "")
    with pytest.raises(FileNotFoundError):
        landing_csv.read_csv_by_name(spark, str(tmp_path))


def test_missing_columns_are_added(spark, tmp_path):
    _write(tmp_path / "events_2024-01-01.csv", "event_id,userid\ne,1\n")
    df = land(landing_csv.read_event_drops(spark, str(tmp_path)))
    assert set(EVENT_COLUMNS) < set(df.columns)
    row = df.first()
    assert row["_ingested_at"] is not None and row["platform"] is None
    assert row["_source_file"] == "events_2024-01-01.csv"


def test_landing_by_drop_date(spark, tmp_path):
    raw = raw_events(
        spark,
        [
            {"_source_file": f"events_2024-01-0{1 + i % 2}.csv", "product_id": 'a "b", c'}
            for i in range(6)
        ],
    )
    path = str(tmp_path / "landing")
    rows = raw.select(*EVENT_COLUMNS, "filename", "_source_file")

    def landed():
        return landing_csv.read_event_drops(spark, path).select(*EVENT_COLUMNS)

    landing_csv.land_by_drop_date(rows, path, load="monday")
    dates = sorted(p.name for p in (tmp_path / "landing" / "load=monday").iterdir() if p.is_dir())
    assert dates == ["landing_date=2024-01-01", "landing_date=2024-01-02"]
    expected = raw.select(*EVENT_COLUMNS)
    assert landed().exceptAll(expected).count() == 0 and landed().count() == 6

    # the same load again, whole or in part: the same rows
    landing_csv.land_by_drop_date(rows, path, load="monday")
    landing_csv.land_by_drop_date(rows.where("_source_file LIKE '%02.csv'"), path, load="monday")
    assert landed().exceptAll(expected).count() == 0 and landed().count() == 6
    # another one adds its own
    landing_csv.land_by_drop_date(rows, path, load="tuesday")
    landing_csv.land_by_drop_date(rows, path)
    assert landed().count() == 18
    with pytest.raises(ValueError, match="named by"):
        landing_csv.land_by_drop_date(rows, path, load="a/b")


def test_date_without_a_name_lands_once(spark, tmp_path):
    """Rows of files without a date are a partition like others."""
    rows = raw_events(spark, [{"_source_file": "x.csv", "filename": "x.csv"}]).select(*EVENT_COLUMNS, "filename", "_source_file")
    for _ in range(2):
        landing_csv.land_by_drop_date(rows, str(tmp_path / "landing"), load="one")
    assert landing_csv.read_event_drops(spark, str(tmp_path / "landing")).count() == 1


def _landing_zone(root):
    header = ",".join(EVENT_COLUMNS)
    lines = [
        "a1,app_open,2024-01-01 10:00:00,1,ios,US,1.44.0,d,,,,",
        "a2,level_progress,2024-01-01 10:01:00,1,ios,US,1.44.0,d,3.0,,,",
        "a3,purchase,2024-01-01 10:02:00,1,,US,1.44.0,d,,4.99,gems_medium,USD",
        "a4,app_open,2024-01-02 10:00:00,1,ios,US,1.44.0,d,,,,",
    ]
    _write(root / "landing" / "events_2024-01-01.csv", "\n".join([header, *lines[:3]]) + "\n")
    second = "\n".join([header, lines[3], lines[0]]) + "\n"
    _write(root / "landing" / "events_2024-01-02.csv", second)
    _write(
        root / "assignments.csv",
        "userid,version,sum_gamerounds,retention_1,retention_7\n"
        "1,gate_30,3,True,False\n2,gate_40,0,False,False\n",
    )


def test_build_from_files(spark, tmp_path):
    _landing_zone(tmp_path)
    out = str(tmp_path / "warehouse")
    args = [str(tmp_path / "landing" / "events_*.csv"), str(tmp_path / "assignments.csv"), out]
    with scratch_scope(spark):
        made = scratch_dir(spark, "probe")
        spark.range(1).write.parquet(made)
        assert Path(made.removeprefix("file:")).exists()
    scratch = Path(made.removeprefix("file:")).parent
    before = set(scratch.iterdir())
    checks = medallion.run(spark, *args)
    assert set(scratch.iterdir()) == before
    assert all(r["passed"] for r in checks.collect())

    for layer, tables in TABLES.items():
        for name in tables:
            assert spark.table(f"{layer}.{name}").count() > 0, name
    readout = spark.sql("SELECT * FROM gold.mart_ab_test_readout ORDER BY ab_version").collect()
    assert [tuple(r) for r in readout] == [
        ("gate_30", 1, 1.0, 0.0, 1.0, 4.99, 4.99),
        ("gate_40", 1, 0.0, 0.0, 0.0, 0.0, None),
    ]
    raw = spark.table("bronze.raw_events")
    assert raw.select("_ingested_at").distinct().count() == 1
    counts = medallion.row_report(Warehouse(spark, out)).collect()
    assert [r["row_count"] for r in counts] == [5, 2, 4, 2, 2]

    # a second run replaces every table
    medallion.run(spark, *args)
    assert spark.table("silver.events_clean").count() == 4


@pytest.mark.parametrize("duplicate, code", [(True, 0), (False, 1)])
def test_exit_code(spark, tmp_path, monkeypatch, duplicate, code):
    """A feed without duplicates fails its check, and the build with it."""
    _landing_zone(tmp_path)
    if not duplicate:
        second = tmp_path / "landing" / "events_2024-01-02.csv"
        second.write_text("\n".join(second.read_text().splitlines()[:2]) + "\n")
    monkeypatch.setattr(medallion, "build_session", lambda name: spark)
    monkeypatch.setattr(medallion, "PARTITION_BYTES", 100)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    args = [str(tmp_path / "landing" / "events_*.csv"), str(tmp_path / "assignments.csv")]
    try:
        assert medallion.main([*args, str(tmp_path / "warehouse")]) == code
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) > int(before)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert spark.table("gold.data_quality_checks").where("NOT passed").count() == code


def test_events_by_day_layout(spark, tmp_path):
    _landing_zone(tmp_path)
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    medallion.build(
        landing_csv.read_event_drops(spark, str(tmp_path / "landing")),
        landing_csv.read_assignments(spark, str(tmp_path / "assignments.csv")),
        warehouse,
        partition_events=True,
    )
    warehouse.commit()
    warehouse.publish()
    one_day = spark.table("silver.events_clean").where("event_date = '2024-01-02'")
    assert one_day.count() == 1
    assert "PartitionFilters: [isnotnull(event_date" in (
        one_day._jdf.queryExecution().executedPlan().toString()
    )


def test_failed_build_leaves_the_tables_of_the_one_before(spark, tmp_path, monkeypatch):
    _landing_zone(tmp_path)
    out = str(tmp_path / "warehouse")
    args = [str(tmp_path / "landing" / "events_*.csv"), str(tmp_path / "assignments.csv"), out]
    medallion.run(spark, *args)
    before = {t: spark.table(t).collect() for t in ("silver.events_clean", "gold.mart_ltv_curve")}
    reader = Warehouse(spark, out)

    _write(tmp_path / "landing" / "events_2024-01-03.csv", ",".join(EVENT_COLUMNS) + "\nnew,app_open,2024-01-03 10:00:00,2,ios,US,1.44.0,d,,,,\n")
    with monkeypatch.context() as broken:
        broken.setattr(medallion.engagement, "segment_summary", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            medallion.run(spark, *args)
    for table, rows in before.items():
        assert spark.table(table).collect() == Warehouse(spark, out).read(table).collect() == rows

    # the next build shows all its tables, and the last one's folders stay for those who read them
    medallion.run(spark, *args)
    assert spark.table("silver.events_clean").count() == 5
    assert reader.read("silver.events_clean").count() == 4
    medallion.run(spark, *args)
    assert len(list((tmp_path / "warehouse" / "silver" / "events_clean").iterdir())) == 2
    assert len([p for p in (tmp_path / "warehouse" / "_snapshots").iterdir() if p.name.endswith("json")]) == 2


def test_only_one_of_two_builds_commits(spark, tmp_path):
    one, two = (Warehouse(spark, str(tmp_path / "w")) for _ in range(2))
    for n, warehouse in enumerate((one, two)):
        warehouse.write("gold.t", spark.range(n + 1))
    one.commit()
    with pytest.raises(RuntimeError, match="another writer"):
        two.commit()
    assert Warehouse(spark, str(tmp_path / "w")).read("gold.t").count() == 1
    with pytest.raises(FileNotFoundError):
        Warehouse(spark, str(tmp_path / "w")).read("gold.none")


def test_empty_partitioned_table_is_published(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    warehouse.write("gold.nothing", spark.sql("SELECT 1L AS a, DATE'2024-01-01' AS day WHERE false"), "day")
    warehouse.commit()
    warehouse.publish()
    assert spark.table("gold.nothing").count() == 0 and spark.table("gold.nothing").dtypes == [("a", "bigint"), ("day", "date")]
    spark.sql("DROP VIEW gold.nothing")


def test_line_breaks_from_the_command_line(spark, tmp_path, monkeypatch):
    _landing_zone(tmp_path)
    first = tmp_path / "landing" / "events_2024-01-01.csv"
    first.write_text(first.read_text().replace("gems_medium", '"gems\nmedium"'))
    monkeypatch.setattr(medallion, "build_session", lambda name: spark)
    args = [str(tmp_path / "landing" / "events_*.csv"), str(tmp_path / "assignments.csv"), str(tmp_path / "warehouse")]
    with pytest.raises(Exception, match="(?i)malformed"):
        medallion.main(args)
    assert medallion.main(["--multiline", *args]) == 0
    assert spark.table("silver.events_clean").where("product_id = 'gems\nmedium'").count() == 1
