"""Sources, sinks, ingest (batch and stream), external table and views."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee import schema as S
from marquee.operators.incremental import new_rows
from marquee.plans.ingest import clean_zone, ingest, prepare_batch, read_clean_zone
from marquee.sources import catalog, files
from marquee.streaming.ingest_stream import ingest_stream, source_stream

CSV_TEXT = (
    "id,title,overview,release_date,revenue\n"
    '1,"Plain",simple,2020-01-02,10\n'
    '2,"Comma, inside","line one\nline two",2020-13-45,abc\n'
    '3,"Quote ""here""","",2021-03-04,5.5\n'
)


def write_text(path, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.csv"), "w", encoding="utf-8") as fh:
        fh.write(text)


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_csv_quotes_commas_and_newlines_stay_in_one_row(spark, scratch):
    p = scratch("csv-in")
    write_text(local(p), CSV_TEXT)
    df = files.read_csv_as_text(spark, p, ["id", "title", "overview", "release_date", "revenue"])
    rows = {r.id: r for r in df.collect()}
    assert set(rows) == {"1", "2", "3"}
    assert rows["2"].title == "Comma, inside" and rows["2"].overview == "line one\nline two"
    assert rows["3"].title == 'Quote "here"'
    typed = prepare_batch(df, {"id": T.LongType(), "release_date": T.DateType(), "revenue": S.MONEY}).collect()
    by_id = {r.id: r for r in typed}
    assert by_id[2].release_date is None and by_id[2].revenue is None and by_id[2].year is None
    assert by_id[1].year == 2020 and by_id[1].month == 1


def test_csv_write_read_roundtrip_keeps_text(spark, scratch):
    rows = [(1, "  lead and trail  "), (2, 'q"uo\nte, x'), (3, ""), (4, None)]
    df = spark.createDataFrame(rows, "id long, t string")
    p = scratch("csv-rt")
    files.write_csv(df, p)
    back = files.read_csv(spark, p, T.StructType(df.schema.fields), null_value=files.NULL_MARKER).collect()
    assert sorted((r.id, r.t) for r in back) == sorted(rows, key=lambda r: r[0])


def test_missing_parquet_zone_reads_empty_but_other_errors_raise(spark, scratch):
    schema = T.StructType([T.StructField("id", T.LongType())])
    assert files.read_parquet_or_empty(spark, scratch("missing"), schema).count() == 0
    bad = scratch("not-parquet")
    write_text(local(bad), "this is not parquet")
    with pytest.raises(Exception):
        files.read_parquet_or_empty(spark, bad, schema).count()


def test_new_rows_dedupes_and_rejects_null_keys(spark):
    batch = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (3, "e")], "id long, v string")
    existing = spark.createDataFrame([(3,), (3,)], "id long")
    got = sorted((r.id, r.v) for r in new_rows(batch, existing).collect())
    assert got == [(1, "b"), (2, "c")]


RAW_TEXT = [
    ("1", "A", "7.0", "3", "Released", "2020-01-05", "10", "90", "5", "Drama", "Pixar.Studio"),
    ("2", "B", "7.0", "3", "Released", None, "10", "90", "5", "Drama", "Pixar.Studio"),
    ("3", "C", "7.0", "3", "Released", "2021-02-05", "10", "400", "5", "Drama", "Pixar.Studio"),
    (None, "D", "7.0", "3", "Released", "2021-02-05", "10", "90", "5", "Drama", "Pixar.Studio"),
    ("4", "E", "7.0", "3", "Released", "2021-02-06", "10", "90", "5", "Drama", "Pixar.Studio"),
]
RAW_COLS = ["id", "title", "vote_average", "vote_count", "status", "release_date", "revenue", "runtime", "budget",
            "genres", "production_companies"]


def test_ingest_is_idempotent_and_clean_zone_roundtrips(spark, scratch):
    text = spark.createDataFrame(RAW_TEXT, ", ".join(f"{c} string" for c in RAW_COLS))
    batch = prepare_batch(text)
    raw, out = scratch("raw"), scratch("filtered")
    first = ingest(spark, batch, raw, batch.schema)
    second = ingest(spark, batch, raw, batch.schema)
    assert first == {"rows_read": 5, "rejected_null_key": 1, "duplicate_in_batch": 0, "already_in_sink": 0, "new_rows": 4, "max_id": 4}
    assert second == {**first, "already_in_sink": 4, "new_rows": 0}
    zone = files.read_parquet_or_empty(spark, raw, batch.schema)
    assert zone.count() == 4 and zone.filter("year is null").count() == 1
    clean_zone(spark, raw, batch.schema, out)
    cleaned = read_clean_zone(spark, out)
    assert sorted(r.id for r in cleaned.collect()) == [1, 4]
    assert {r.month for r in cleaned.collect()} == {"01", "02"}
    feb = read_clean_zone(spark, out, months=["02"])
    assert [r.id for r in feb.collect()] == [4]
    plan = feb._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "month#" in plan


def test_stream_ingest_twice_appends_once(spark, scratch):
    src, sink, ckpt = scratch("src"), scratch("sink"), scratch("ckpt")
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("p", T.StringType())])
    spark.createDataFrame([(1, "x"), (2, "y"), (2, "y"), (None, "z")], schema).write.parquet(src)
    for _ in range(2):
        ingest_stream(spark, source_stream(spark, src, schema), sink, ckpt, "k", "p", schema)
    spark.createDataFrame([(2, "y"), (3, "x")], schema).write.mode("append").parquet(src)
    ingest_stream(spark, source_stream(spark, src, schema), sink, ckpt, "k", "p", schema)
    got = sorted(r.k for r in files.read_parquet_or_empty(spark, sink, schema).collect())
    assert got == [1, 2, 3]


def test_external_table_and_views(spark, scratch):
    rows = [
        (1, "Released", "Drama, Comedy", dt.date(2020, 1, 5), 90, "2020", 1, 2, 3, 7.0, "A", "pixar.studio", "01"),
        (2, "Released", "Drama", dt.date(2021, 2, 5), 90, "2021", 2, 4, 3, 7.0, "B", "pixar.studio, warner.bros", "02"),
    ]
    schema = S.CLEAN_SCHEMA
    df = spark.createDataFrame([(r[0], r[1], r[2], r[3], r[4], r[5], r[6], r[7], r[8], r[9], r[10], r[11], r[12])
                                for r in rows], "id long, status string, genres string, release_date date, runtime int, "
                               "year string, budget int, revenue int, vote_count int, vote_average double, title string, "
                               "production_companies string, month string")
    df = df.select([F.col(f.name).cast(f.dataType) for f in schema.fields])
    p = scratch("ext")
    df.write.partitionBy("month").parquet(p)
    t = catalog.create_external_table(spark, "ext_test", p)
    assert t.count() == 2 and sorted(r.month for r in t.collect()) == ["01", "02"]
    catalog.create_views(spark, "ext_test", prefix="t_")
    assert spark.table("t_catalogue_releases").count() == 2
    genre = {(r.release_year, r.genre): r.movie_count for r in spark.table("t_catalogue_by_genre").collect()}
    assert genre == {(2020, "drama"): 1, (2020, "comedy"): 1, (2021, "drama"): 1}
    growth = [tuple(r) for r in spark.table("t_company_cumulative").orderBy("release_year").collect()]
    assert growth == [(2020, 1, 1), (2021, 1, 2)]


def test_sink_read_is_limited_to_the_batch_key_range(spark, scratch):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("p", T.StringType())])
    sink = scratch("range-sink")
    spark.createDataFrame([(i, "a") for i in range(100)], schema).write.parquet(sink)
    batch = spark.createDataFrame([(50, "x"), (150, "y"), (None, "z")], schema)
    from marquee.operators.incremental import key_bounds

    bounds = key_bounds(batch.filter("id is not null"))
    assert bounds == (50, 150)
    out = new_rows(batch, files.read_parquet_or_empty(spark, sink, schema), key_range=bounds)
    assert [r.id for r in out.collect()] == [150]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,50)" in plan and "LessThanOrEqual(id,150)" in plan
    empty = new_rows(batch.filter("id is null"), spark.createDataFrame([], schema), key_range=(None, None))
    assert empty.count() == 0


def test_partitioned_write_is_clustered_and_key_sorted(spark, scratch):
    import glob

    import pyarrow.parquet as pq

    from marquee.sources.sinks import write_partitioned

    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("id"), (F.col("id") % 3).cast("string").alias("p"))
    out = scratch("sorted")
    write_partitioned(df.repartition(6), out, "p", mode="overwrite", sort_key="id")
    local_out = local(out)
    for part in ("0", "1", "2"):
        parquet_files = glob.glob(f"{local_out}/p={part}/*.parquet")
        assert len(parquet_files) == 1  # small data: one file per partition value
        ids = pq.read_table(parquet_files[0]).column("id").to_pylist()
        assert ids == sorted(ids)
    assert spark.read.parquet(out).count() == 5000


def test_jobs_refuse_a_missing_source_and_leave_the_output(spark, scratch):
    from marquee.plans.jobs import transform_data

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("month", T.StringType())])
    out = scratch("kept-zone")
    spark.createDataFrame([(1, "01")], schema).write.partitionBy("month").parquet(out)
    with pytest.raises(FileNotFoundError):
        transform_data(spark, scratch("no-such-raw"), out)
    assert spark.read.parquet(out).count() == 1
    with pytest.raises(FileNotFoundError):
        read_clean_zone(spark, scratch("no-such-zone"))


def test_csv_columns_go_by_header_name(spark, scratch):
    p = scratch("csv-swapped")
    write_text(local(p), "revenue,extra,id\n10,x,1\n20,y,2.0\n5\n7,z,3,too,long\n")
    names = ["id", "revenue"]
    got = files.read_csv(spark, p, T.StructType([T.StructField(c, T.StringType()) for c in names]), corrupt_column="bad",
                         multi_line=False)
    assert got.columns == ["id", "revenue", "extra", "bad"]
    rows = got.collect()
    assert [(r.id, r.revenue, r.extra) for r in rows[:2]] == [("1", "10", "x"), ("2.0", "20", "y")]
    assert [r.bad is None for r in rows] == [True, True, False, False]
    with pytest.raises(ValueError, match="lacks"):
        files.read_csv(spark, p, T.StructType([T.StructField("title", T.StringType())]))


def test_integers_delivered_as_decimals(spark):
    from marquee.functions import parse_as

    df = spark.createDataFrame([("37.0",), ("37.9",), ("-2.5",), ("abc",), ("9223372036854775807",), ("1e30",), (None,)], "t string")
    got = [r.v for r in df.select(parse_as("t", T.LongType()).alias("v")).collect()]
    assert got == [37, 37, -2, None, 9223372036854775807, None, None]
    assert [r.v for r in df.select(parse_as("t", T.IntegerType()).alias("v")).collect()][4] is None


def test_ingest_keeps_rejects(spark, scratch):
    batch = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "id long, year string")
    sink, bad = scratch("rej-sink"), scratch("rej")
    got = ingest(spark, batch, sink, batch.schema, rejects_path=bad)
    assert got == {"rows_read": 3, "rejected_null_key": 1, "duplicate_in_batch": 1, "already_in_sink": 0, "new_rows": 1, "max_id": 1}
    assert [r.year for r in spark.read.parquet(bad).collect()] == ["c"]


def test_lines_that_do_not_fit_are_rejects_without_a_rejects_path(spark, tmp_path, monkeypatch, capsys):
    import json

    from marquee import __main__ as cli
    from marquee import schema as schemas
    from marquee.plans import jobs

    names = list(schemas.RAW_COLUMNS)
    line = lambda k: ",".join(str(k) if c == "id" else "" for c in names)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n".join([",".join(names), line(1), line(2), "3,short", line(4) + ",surplus"]) + "\n")
    want = {"rows_read": 4, "rejected_null_key": 2, "new_rows": 2}
    got = jobs.process_raw_data(spark, str(tmp_path / "in"), str(tmp_path / "raw"))
    assert want.items() <= got.items()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "raw")).collect()) == [1, 2]
    monkeypatch.setattr(cli, "_session", lambda local: spark)
    cli.main(["ingest", "--source", str(tmp_path / "in"), "--raw", str(tmp_path / "raw2"), "--rejects", str(tmp_path / "bad")])
    assert want.items() <= json.loads(capsys.readouterr().out.strip().splitlines()[-1]).items()
    kept = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert sorted(r["_corrupt_record"] for r in kept) == sorted(["3,short", line(4) + ",surplus"])
