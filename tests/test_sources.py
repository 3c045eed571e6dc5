"""CSV loading by name, strict casts, sinks and the warehouse round trip."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from marginflow import schemas
from marginflow.sources import csv, sinks


def _write(text):
    d = tempfile.mkdtemp(prefix="mf-csv-")
    path = os.path.join(d, "x.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path


def test_typed_load_binds_by_name(spark):
    path = _write("spend,extra,channel,market,month\n12.50,zz,CRM,LV,2025-01-01\n0,zz,Affiliate,EE,2025-02-01\n")
    df = csv.load_typed_csv(spark, path, "fct_marketing_spend")
    assert df.columns == ["month", "market", "channel", "spend"]
    rows = sorted((str(r["month"]), r["market"], r["channel"], float(r["spend"])) for r in df.collect())
    assert rows == [("2025-01-01", "LV", "CRM", 12.5), ("2025-02-01", "EE", "Affiliate", 0.0)]


def test_missing_column_raises(spark):
    path = _write("month,market,spend\n2025-01-01,LV,1\n")
    with pytest.raises(csv.MissingColumnError):
        csv.load_typed_csv(spark, path, "fct_marketing_spend")


def test_bad_number_aborts_and_empty_string_kept(spark):
    bad = _write("month,market,channel,spend\n2025-01-01,LV,CRM,abc\n")
    with pytest.raises(Exception):
        csv.load_typed_csv(spark, bad, "fct_marketing_spend").collect()
    empty = _write('month,market,channel,spend\n2025-01-01,"",CRM,1\n')
    r = csv.load_typed_csv(spark, empty, "fct_marketing_spend").collect()[0]
    assert r["market"] == ""


def test_text_load_all_strings(spark):
    path = _write("a,b\n1,2.5\n")
    df = csv.load_text_csv(spark, path)
    assert dict(df.dtypes) == {"a": "string", "b": "string"}


def test_report_csv_sink_keeps_order(spark):
    df = spark.createDataFrame([("b", 1), ("a", 3), ("c", 2)], "k string, v int")
    out = os.path.join(tempfile.mkdtemp(prefix="mf-out-"), "r")
    sinks.write_report_csv(df, out, "logistics", [df.v.desc()])
    with pytest.raises(ValueError, match="bounded"):
        sinks.write_report_csv(df, out, "fct_orders", [df.v])
    parts = [p for p in os.listdir(out) if p.endswith(".csv")]
    assert len(parts) == 1
    with open(os.path.join(out, parts[0]), encoding="utf-8") as fh:
        assert fh.read().splitlines() == ["k,v", "a,3", "c,2", "b,1"]


def test_tables_declare_their_columns(spark):
    from conftest import SMOKE
    from marginflow.plans.warehouse import warehouse

    wh = warehouse(spark, SMOKE)
    for name, schema in schemas.TABLES.items():
        assert wh.table(name).columns == schema.names
    assert schemas.documented("fct_orders")["net_revenue"].metadata["comment"]


def test_standard_quoting(spark):
    path = _write('a,b\n"x, ""y"", q",1\n"two\nlines",2\n')
    assert sorted(map(tuple, csv.load_text_csv(spark, path).collect())) == [("two\nlines", "2"), ('x, "y", q', "1")]


def test_files_with_other_column_orders(spark):
    import pathlib

    d = pathlib.Path(tempfile.mkdtemp(prefix="mf-csv-"))
    (d / "1.csv").write_text("a,b\nA1,B1\n")
    (d / "2.csv").write_text("b,a\nB2,A2\n")
    got = csv.load_text_csv(spark, str(d)).select("a", "b").collect()
    assert sorted(map(tuple, got)) == [("A1", "B1"), ("A2", "B2")]


def test_extract_round_trip_keeps_values(spark):
    rows = [(" pad ", 'q"uo"te', "a,b"), ("", "two\nlines", "\\ back"), ("'", "é", "x")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    out = os.path.join(tempfile.mkdtemp(prefix="mf-out-"), "x")
    csv.write_csv_extract(df, out)
    assert sorted(map(tuple, csv.load_text_csv(spark, out).collect())) == sorted(rows)


def test_pipeline_writes_marts_and_ordered_reports(spark, published):
    paths = published[1]
    assert {"cohort_profitability_90d", "channel_funnel", "report:experiment", "report:channel_rank_report",
            "report:carrier_tradeoff_report"} <= set(paths)
    assert "stg_orders" in [t.name for t in spark.catalog.listTables()]
    report = paths["report:channel_profitability"]
    part = [p for p in os.listdir(report) if p.endswith(".csv")][0]
    with open(os.path.join(report, part), encoding="utf-8") as fh:
        lines = fh.read().splitlines()
    assert lines[0].startswith("acquisition_channel,prospects,customers,conversion_rate")
    margins = [float(line.split(",")[6]) for line in lines[1:]]
    assert margins == sorted(margins, reverse=True) and len(margins) == 5
    exp = spark.read.parquet(paths["experiment_stats"])
    assert {"conversion_p_value", "srm_p_value"} <= set(exp.columns)


def test_pipeline_cohort_and_carrier_reports_sorted(published):
    paths = published[1]
    for name, key in (("cohort_profitability_90d", lambda f: (f[0], f[1], f[2])),
                      ("carrier_summary", lambda f: -float(f[1]))):
        d = paths[f"report:{name}"]
        part = [p for p in os.listdir(d) if p.endswith(".csv")][0]
        with open(os.path.join(d, part), encoding="utf-8") as fh:
            rows = [line.split(",") for line in fh.read().splitlines()[1:]]
        assert rows and rows == sorted(rows, key=key)


def test_short_row_aborts(spark):
    short = _write("month,market,channel,spend\n2025-01-01,LV,CRM\n")
    with pytest.raises(Exception):
        csv.load_typed_csv(spark, short, "fct_marketing_spend").collect()


def _reference(path):
    """Records of a file or folder by Python's own reader, as dicts."""
    import csv as reader
    import pathlib

    rows = []
    files = sorted(pathlib.Path(path).glob("*.csv")) if os.path.isdir(path) else [pathlib.Path(path)]
    for f in files:
        with open(f, encoding="utf-8", newline="") as fh:
            rows += [tuple(sorted(r.items())) for r in reader.DictReader(fh, strict=True)]
    return sorted(rows)


def _loaded(df):
    return sorted(tuple(sorted(r.asDict().items())) for r in df.collect())


@pytest.mark.parametrize("size", ["150", "2000"])
def test_one_large_file_is_split_inside_quoted_fields(spark, size):
    """Quoted line breaks, quotes and commas across splits; fields longer than several splits."""
    import random

    rnd = random.Random(int(size))
    bits = ["a", "\n", '""', ",", " ", "\r\n", "é", "line\nbreak", "x" * 30]
    lines = ["id,first,second"]
    for i in range(90):
        fields = ['"' + "".join(rnd.choice(bits) for _ in range(rnd.choice([0, 1, 3, 12, 40]))) + '"'
                  if rnd.random() < 0.5 else rnd.choice(["plain", "", "7"]) for _ in range(2)]
        lines.append(",".join([str(i), *fields]))
    lines.insert(50, "")  # a blank line is no record
    path = _write("\n".join(lines) + "\n")
    keys = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "0"}
    was = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        df = csv.load_text_csv(spark, path)
        assert csv._lines(spark, path).rdd.getNumPartitions() >= min(8, os.path.getsize(path) // int(size))
        assert _loaded(df) == _reference(path)
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_many_splits_are_sorted_in_place_of_a_broadcast(spark, monkeypatch):
    path = _write("a,b\n" + "".join(f'{i},"two\nlines {i}"\n' for i in range(60)))
    monkeypatch.setattr(csv, "MOST_BROADCAST", 1)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        assert _loaded(csv.load_text_csv(spark, path)) == _reference(path)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_thousand_small_files_in_a_job_a_pass(spark):
    import pathlib

    d = pathlib.Path(tempfile.mkdtemp(prefix="mf-csv-"))
    for i in range(1000):
        names, values = ["a", "b", "c"], [str(i), f'"q""{i}\nx"', "z"]
        turn = i % 3
        (d / f"{i:04d}.csv").write_text(",".join(names[turn:] + names[:turn]) + "\n" + ",".join(values[turn:] + values[:turn]) + "\n")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("thousand", "csv")
    try:
        got = _loaded(csv.load_text_csv(spark, str(d)).select("a", "b", "c"))
        jobs = len(tracker.getJobIdsForGroup("thousand"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == _reference(str(d)) and jobs < 30


def test_windows_line_ends_and_byte_order_mark(spark):
    d = tempfile.mkdtemp(prefix="mf-csv-")
    with open(os.path.join(d, "x.csv"), "w", encoding="utf-8-sig", newline="") as fh:
        fh.write('"a",b\r\n1,"x\r\ny"\r\n\r\n2,\r\n3,"z"')
    got = csv.load_text_csv(spark, os.path.join(d, "x.csv"))
    assert got.columns == ["a", "b"]
    assert sorted(map(tuple, got.collect())) == [("1", "x\r\ny"), ("2", ""), ("3", "z")]


def test_files_split_otherwise_than_surveyed_stop_the_load(spark):
    path = _write("a,b\n" + "".join(f"{i},x\n" for i in range(500)))
    df = csv.load_text_csv(spark, path)
    assert df.count() == 500
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        assert csv.load_text_csv(spark, path).count() == 500
        with pytest.raises(Exception, match="split otherwise"):
            df.select("a").where("a <> ''").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_record_is_parsed_once_however_many_columns_are_read(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b,c\nA1,B1,C1\n")
    plan = csv.load_text_csv(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv(") == 1


def test_extract_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csv, "ROWS_PER_FILE", 100)
    out = str(tmp_path / "x")
    csv.write_csv_extract(spark.range(1000).coalesce(1).select(F.format_string("%09d", "id").alias("a")), out)
    parts = [p for p in os.listdir(out) if p.startswith("part-")]
    assert len(parts) == 10 and all(p.endswith(".csv.gz") for p in parts)
    assert sorted(r.a for r in csv.load_text_csv(spark, out).collect()) == [f"{i:09d}" for i in range(1000)]
