"""Zones that grow load by load: CSV stream by header, load log, incremental cleaning, bucketed sink, stored debuts and summaries."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee import schema as S
from marquee.operators import debut_state, growth, metrics, profile, rollups
from marquee.operators.incremental import new_rows
from marquee.plans import jobs
from marquee.plans.ingest import clean_loads, clean_zone, ingest, prepare_batch, read_clean_zone
from marquee.sources import bucketed, files
from marquee.sources.load_log import COUNTS, LOAD_ID, LoadLog
from marquee.streaming.csv_stream import ingest_csv_stream


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


NAMES = list(S.RAW_COLUMNS)


def line(names, **values):
    return ",".join(str(values.get(c, "")) for c in names)


def deliveries():
    """File name → text: declared order, swapped columns with one more, and lines that do not fit."""
    swapped = [*NAMES[:2], "vote_count", "vote_average", *NAMES[4:], "studio"]
    good = dict(vote_average=7.5, vote_count=335, release_date="2020-02-03", title="T")
    return {
        "a.csv": "\n".join([",".join(NAMES), line(NAMES, id=1, **good), line(NAMES, id=2, **good), line(NAMES, id=2, **good)]) + "\n",
        "b [1].csv": "\n".join([",".join(swapped), line(swapped, id=3, studio="x", **good), line(swapped, id="abc", **good)]) + "\n",
        "c.csv": "\n".join([",".join(NAMES), "8,short", line(NAMES, id=9, **good) + ",surplus", line(NAMES, id=1, **good), line(NAMES, id="10.0", **good)]) + "\n",
        "d.csv": "",
    }


def drop(folder, names):
    os.makedirs(folder, exist_ok=True)
    for n in names:
        with open(os.path.join(folder, n), "w", encoding="utf-8") as fh:
            fh.write(deliveries()[n])


def rows_of(spark, path):
    keep = ["id", "vote_average", "vote_count", "year", "month", "studio"]
    return sorted(tuple(r) for r in spark.read.option("mergeSchema", "true").parquet(path).select(*keep).collect())


def test_csv_stream_loads_what_the_batch_loads(spark, tmp_path):
    src, batch_zone, zone = (str(tmp_path / n) for n in ("in", "batch", "stream"))
    drop(src, deliveries())
    want = jobs.process_raw_data(spark, src, batch_zone, rejects_path=str(tmp_path / "bad-batch"))
    assert want == {"rows_read": 9, "rejected_null_key": 3, "duplicate_in_batch": 2, "already_in_sink": 0, "new_rows": 4, "max_id": 10}
    got = ingest_csv_stream(spark, src, zone, str(tmp_path / "ckpt"), str(tmp_path / "log"), str(tmp_path / "bad-stream"))
    assert got == {"micro_batches": 1, **want}
    good = (7.5, 335, 2020, 2)
    assert rows_of(spark, zone) == rows_of(spark, batch_zone) == [(1, *good, None), (2, *good, None), (3, *good, "x"), (10, *good, None)]
    lines = lambda p: sorted(r["_corrupt_record"] or "" for r in spark.read.parquet(str(tmp_path / p)).collect())
    assert lines("bad-stream") == lines("bad-batch") and "8,short" in lines("bad-stream")
    # nothing new arrived; then the same files again from a fresh checkpoint
    again = ingest_csv_stream(spark, src, zone, str(tmp_path / "ckpt"), str(tmp_path / "log"))
    assert again["micro_batches"] == 0 and again["rows_read"] == 0
    fresh = ingest_csv_stream(spark, src, zone, str(tmp_path / "ckpt2"), str(tmp_path / "log"))
    assert fresh["new_rows"] == 0 and fresh["already_in_sink"] == 4 and fresh["rows_read"] == 9
    assert len(rows_of(spark, zone)) == 4
    assert LoadLog(spark, str(tmp_path / "log")).loads().count() == 2


def test_csv_stream_file_by_file(spark, tmp_path):
    src, zone = str(tmp_path / "in"), str(tmp_path / "zone")
    drop(src, deliveries())
    got = ingest_csv_stream(spark, src, zone, str(tmp_path / "ckpt"), str(tmp_path / "log"), max_files_per_trigger=1, multi_line=False)
    assert got["micro_batches"] == 4 and got["new_rows"] == 4 and got["rows_read"] == 9 and got["rejected_null_key"] == 3
    assert [r[0] for r in rows_of(spark, zone)] == [1, 2, 3, 10]


def test_csv_stream_without_a_needed_column_stops(spark, tmp_path):
    src, zone, ckpt, log = (str(tmp_path / n) for n in ("in", "zone", "ckpt", "log"))
    drop(src, ["a.csv"])
    with open(os.path.join(src, "bad.csv"), "w") as fh:
        fh.write("id,title\n5,x\n")
    with pytest.raises(Exception, match="lacks the columns"):
        ingest_csv_stream(spark, src, zone, ckpt, log)
    assert not os.path.exists(zone) and LoadLog(spark, log).loads().count() == 0
    with open(os.path.join(src, "bad.csv"), "w") as fh:  # mended under its own name: the batch runs again
        fh.write("\n".join([",".join(NAMES), line(NAMES, id=5)]) + "\n")
    assert ingest_csv_stream(spark, src, zone, ckpt, log)["new_rows"] == 3


def test_cli_stream(spark, tmp_path, monkeypatch, capsys):
    from marquee import __main__ as cli

    drop(str(tmp_path / "in"), ["a.csv", "c.csv"])
    monkeypatch.setattr(cli, "_session", lambda is_local: spark)
    cli.main(["stream", "--source", str(tmp_path / "in"), "--raw", str(tmp_path / "raw"), "--checkpoint", str(tmp_path / "ck"),
              "--rejects", str(tmp_path / "bad"), "--single-line"])
    told = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert told["rows_read"] == 7 and told["rejected_null_key"] == 2 and told["new_rows"] == 3
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 2
    assert spark.read.parquet(str(tmp_path / "ck-loads")).where("phase = 'done'").count() == 1


# -- load log ---------------------------------------------------------------

ROWS = "id long, year int, v string"


class Lost(LoadLog):
    def commit(self, load_id, counts, schema):
        raise ConnectionError(load_id)


def test_a_replayed_load_counts_once(spark, scratch):
    one = spark.createDataFrame([(1, 2020, "a"), (2, 2020, "b"), (2, 2021, "c"), (None, 2020, "d")], ROWS)
    two = spark.createDataFrame([(2, 2020, "b"), (3, None, "e"), (None, None, None)], ROWS)

    def run(interrupt):
        sink, path, bad = scratch("log-sink"), scratch("log"), scratch("log-bad")
        for load_id, batch in (("1", one), ("2", two)):
            if interrupt:
                with pytest.raises(ConnectionError):
                    ingest(spark, batch, sink, batch.schema, log=Lost(spark, path), load_id=load_id, rejects_path=bad)
            got = ingest(spark, batch, sink, batch.schema, log=LoadLog(spark, path), load_id=load_id, rejects_path=bad)
            assert ingest(spark, batch, sink, batch.schema, log=LoadLog(spark, path), load_id=load_id) == got
        log = LoadLog(spark, path)
        zone = sorted((r.id, r.year or 0, r[LOAD_ID]) for r in spark.read.parquet(sink).collect())
        return sorted(map(tuple, log.loads().select(LOAD_ID, *COUNTS).collect())), zone, spark.read.parquet(bad).count(), log

    state, zone, bad, log = run(False)
    assert state == [("1", 4, 1, 1, 0, 2, 2), ("2", 3, 1, 0, 1, 1, 3)]
    assert zone == [(1, 2020, "1"), (2, 2021, "1"), (3, 0, "2")] and bad == 2
    assert run(True)[:3] == (state, zone, bad)
    assert log.last_id() == 3 and log.last_schema().fieldNames() == ["id", "year", "v", LOAD_ID]
    empty = LoadLog(spark, scratch("no-log"))
    assert empty.last_id() is None and empty.last_schema() is None and empty.counts("1") is None and empty.loads().count() == 0
    with pytest.raises(ValueError):
        ingest(spark, one, scratch("x"), one.schema, log=log)


def test_an_empty_load_is_logged(spark, scratch):
    log, sink = LoadLog(spark, scratch("log")), scratch("sink")
    none = spark.createDataFrame([], ROWS)
    assert ingest(spark, none, sink, none.schema, log=log, load_id="e") == {**dict.fromkeys(COUNTS, 0), "max_id": None}
    assert log.counts("e")["rows_read"] == 0


# -- cleaning ---------------------------------------------------------------

RAW_COLS = "id string, title string, vote_average string, vote_count string, status string, release_date string, revenue string, runtime string, " \
           "budget string, genres string, production_companies string"


def raw_batch(spark, ids):
    rows = [(str(i), f"t{i}", "7", "3", "Released", f"20{i % 30:02d}-{i % 4 + 1:02d}-05" if i % 9 else None, "10", str(90 + 40 * (i % 8)), "5", "Drama", "Pixar.Studio")
            for i in ids]
    return prepare_batch(spark.createDataFrame(rows, RAW_COLS))


def folder_files(path):
    return {d: sorted(f for f in os.listdir(os.path.join(local(path), d)) if f.endswith(".parquet"))
            for d in os.listdir(local(path)) if d.startswith("month=")}


def test_only_touched_months_are_cleaned_again(spark, scratch):
    raw, out, full, log = scratch("raw"), scratch("zone"), scratch("full"), LoadLog(spark, scratch("log"))
    first, second = raw_batch(spark, range(1, 60)), raw_batch(spark, [i for i in range(40, 130) if i % 4 == 1])
    ingest(spark, first, raw, first.schema, log=log, load_id="1")
    clean_zone(spark, raw, first.schema, out)
    before = folder_files(out)
    ingest(spark, second, raw, first.schema, log=log, load_id="2")
    assert clean_loads(spark, raw, first.schema, out, ["2"]) == ["02"]
    after = folder_files(out)
    assert {m for m in after if after[m] != before.get(m)} == {"month=02"}
    clean_zone(spark, raw, first.schema, full)
    rows = lambda p: sorted(map(str, read_clean_zone(spark, p).collect()))
    assert rows(out) == rows(full) and len(rows(out)) > 40
    assert clean_loads(spark, raw, first.schema, out, ["2"]) == ["02"] and rows(out) == rows(full)
    assert clean_loads(spark, raw, first.schema, out, ["no such load"]) == []


def test_an_empty_source_leaves_the_zone(spark, scratch):
    out, empty, no_rows = scratch("zone"), scratch("empty"), scratch("no-rows")
    batch = raw_batch(spark, range(1, 20))
    raw = scratch("raw")
    ingest(spark, batch, raw, batch.schema)
    clean_zone(spark, raw, batch.schema, out)
    n = read_clean_zone(spark, out).count()
    os.makedirs(os.path.join(local(empty), "_temporary"))
    with open(os.path.join(local(empty), "_SUCCESS"), "w"):
        pass
    batch.limit(0).write.parquet(no_rows)
    with pytest.raises(FileNotFoundError):
        clean_zone(spark, empty, batch.schema, out)
    with pytest.raises(ValueError, match="no rows"):
        clean_zone(spark, no_rows, batch.schema, out)
    assert read_clean_zone(spark, out).count() == n > 0
    clean_zone(spark, no_rows, batch.schema, scratch("other"), allow_empty=True)


def test_a_failing_check_of_a_path_rises(spark):
    with pytest.raises(Exception):
        files.path_exists(spark, "nosuchscheme://host/path")
    with pytest.raises(Exception):
        files.read_parquet_or_empty(spark, "nosuchscheme://host/path", T.StructType([T.StructField("id", T.LongType())]))


def test_a_failing_observation_rises(spark):
    from pyspark.sql import Observation

    from marquee.plans.ingest import _observed

    with pytest.raises(AssertionError):
        _observed(Observation("never observed"))


# -- bucketed sink ----------------------------------------------------------


def test_bucketed_ingest_has_no_exchange_over_the_sink(spark, scratch):
    name = "bucketed_test_table"
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    bucketed.create_bucketed_table(spark, name, scratch("bucketed"), schema, "id", 6)
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert bucketed.bucket_spec(spark, name) == ("id", 6)
        one = spark.range(0, 500).select("id", F.lit("a").alias("v")).unionByName(spark.createDataFrame([(None, "n"), (3, "z")], schema))
        assert bucketed.ingest_bucketed(spark, one, name) == {
            "rows_read": 502, "rejected_null_key": 1, "duplicate_in_batch": 1, "already_in_sink": 0, "new_rows": 500, "max_id": 499}
        two = spark.range(300, 900).select("id", F.lit("b").alias("v"))
        fresh = bucketed.unseen_rows(spark, two, name)
        want = new_rows(two, spark.table(name))
        assert sorted(fresh.collect()) == sorted(want.collect()) and fresh.count() == 400
        plan = bucketed.unseen_rows(spark, two, name)._jdf.queryExecution().executedPlan().toString()
        # the only exchange deals the batch (a range), none lies over the scan of the sink
        assert plan.count("Exchange") == 1 and plan.index("Exchange") < plan.index("Range (300") < plan.index("FileScan"), plan
        assert "Bucketed: true" in plan
        assert bucketed.ingest_bucketed(spark, two, name)["new_rows"] == 400
        assert bucketed.ingest_bucketed(spark, two, name)["new_rows"] == 0
        assert spark.table(name).count() == spark.table(name).select("id").distinct().count() == 900
        assert spark.table(name).where("id = 3").first()["v"] == "z"  # the greatest of rows that share a key
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
        spark.sql(f"DROP TABLE {name}")
    spark.range(3).write.mode("overwrite").saveAsTable("plain_test_table")
    try:
        with pytest.raises(ValueError, match="not bucketed"):
            bucketed.bucket_spec(spark, "plain_test_table")
    finally:
        spark.sql("DROP TABLE plain_test_table")


# -- stored debuts ----------------------------------------------------------


@pytest.mark.parametrize("seed", [1, 2])
def test_debuts_brought_forward_equal_one_run(spark, scratch, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([None, *"abcdefghij"]), rng.choice([None, *range(1990, 2000)]) if rng.random() < 0.9 else None) for _ in range(60)]
    state = scratch("debuts")
    cuts = [rows[:20], rows[20:35], rows[35:]]
    for k, part in enumerate(cuts):
        changes = debut_state.apply_load(spark, spark.createDataFrame(part, "e string, y int"), "e", "y", state, f"{k}")
        so_far = spark.createDataFrame(sum(cuts[: k + 1], []), "e string, y int")
        want = sorted(map(str, growth.debut_year(so_far, "e", "y").collect()))
        assert sorted(map(str, debut_state.debuts(changes).withColumnRenamed("entity", "e").collect())) == want
        counts = lambda df: sorted(map(str, map(tuple, df.collect())))
        assert counts(debut_state.debut_counts(changes)) == counts(growth.debut_counts(so_far, "e", "y"))
    before = counts(debut_state.debut_counts(changes))
    for k in (1, 2):  # replays leave the state as it was
        changes = debut_state.apply_load(spark, spark.createDataFrame(cuts[k], "e string, y int"), "e", "y", state, f"{k}")
    assert counts(debut_state.debut_counts(changes)) == before
    with pytest.raises(ValueError, match="comes before"):
        debut_state.apply_load(spark, so_far, "e", "y", state, "00")


def test_debuts_of_an_empty_load(spark, scratch):
    state = scratch("debuts")
    none = spark.createDataFrame([], "e string, y int")
    assert debut_state.debut_counts(debut_state.apply_load(spark, none, "e", "y", state, "0")).count() == 0
    one = spark.createDataFrame([("a", 2000)], "e string, y int")
    assert [tuple(r) for r in debut_state.debut_counts(debut_state.apply_load(spark, one, "e", "y", state, "1")).collect()] == [(2000, 1)]


# -- stored summaries -------------------------------------------------------


def test_merged_moments_equal_one_pass(spark):
    rng = random.Random(4)
    rows = [(rng.choice("xy"), str(1990 + rng.randrange(3)), i % 3, rng.choice([None, 1e6 + rng.random(), 5.0]), rng.choice([None, 1e6 + rng.random()])) for i in range(300)]
    rows += [("flat", "1990", i % 3, 2.0, float(i)) for i in range(6)] + [("none", "1990", 0, None, None)]
    df = spark.createDataFrame(rows, "genres string, year string, load int, budget double, revenue double").withColumn("id", F.lit(1))
    stored = rollups.pair_moments(df, ["genres", "year", "load"])
    for keys in (["genres"], ["genres", "year"]):
        got = {tuple(r[k] for k in keys): r for r in rollups.merged_moments(stored, keys).collect()}
        want = {tuple(r[k] for k in keys): r for r in metrics.grouped_metrics(df, keys).collect()}
        assert got.keys() == want.keys()
        for k, w in want.items():
            assert got[k]["total_movies"] == w["total_movies"]
            for c in ("total_budget", "total_revenue", "budget_revenue_correlation"):
                a, b = got[k][c], w[c]
                assert (a is None and b is None) or abs(a - b) <= 1e-6 * max(1, abs(b)), (k, c, a, b)
    assert rollups.merged_moments(stored.limit(0), ["genres"]).count() == 0


def test_merged_sketches_are_within_their_error(spark):
    df = spark.range(0, 60_000).select((F.col("id") % 5).cast("string").alias("m"), (F.col("id") % 20_000).alias("a"),
                                       F.when(F.col("id") % 4 > 0, F.concat(F.lit("v"), F.col("id") % 37)).alias("b"), F.lit(None).cast("date").alias("c"))
    summary = rollups.column_summary(df, "m", ["a", "b", "c"])
    assert summary.count() == 15
    got = {r["column"]: r for r in rollups.merged_columns(summary).collect()}
    exact = {r.column_name: r.distinct_values for r in profile.distinct_profile(df, ["a", "b", "c"]).collect()}
    assert {c: (r["rows"], r["nulls"]) for c, r in got.items()} == {"a": (60_000, 0), "b": (60_000, 15_000), "c": (60_000, 60_000)}
    for c in "abc":
        assert abs(got[c]["distinct_values"] - exact[c]) <= max(1, 4 * rollups.SKETCH_ERROR * exact[c])
    assert got["c"]["distinct_values"] == 1


def test_dates_stay_dates_through_the_log(spark, scratch):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("d", T.DateType()), T.StructField("year", T.IntegerType())])
    sink = scratch("dates")
    ingest(spark, spark.createDataFrame([(1, dt.date(2020, 1, 2), 2020)], schema), sink, schema, log=LoadLog(spark, scratch("log")), load_id="1")
    assert spark.read.parquet(sink).first()["d"] == dt.date(2020, 1, 2)


# -- two-level running sums, partitions of a table, report --------------------


@pytest.mark.parametrize("ranges,inclusive", [(1, True), (7, True), (7, False), (500, False)])
def test_prefix_sums_equal_the_window(spark, ranges, inclusive):
    from pyspark.sql import Window as W

    rng = random.Random(9)
    rows = [(i, rng.choice([None, *range(12)]) if i % 3 else 5, rng.choice([None, *range(-4, 9)])) for i in range(200)]  # a hot order value
    df = spark.createDataFrame(rows, "id int, o int, v int")
    got = growth.prefix_sums(df, "o", {"s": "v", "n": "id"}, ties=("id",), ranges=ranges, inclusive=inclusive)
    over = W.orderBy(F.col("o").asc_nulls_first(), "id").rowsBetween(W.unboundedPreceding, W.currentRow if inclusive else -1)
    want = df.select("*", F.sum("v").over(over).alias("s"), F.sum("id").over(over).alias("n"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert growth.prefix_sums(df.limit(0), "o", {"s": "v"}).count() == 0


def test_prefix_sums_have_no_single_partition_over_the_rows(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(0, 5000).select("id", (F.col("id") % 17).alias("v")).write.parquet(path)
    out = growth.prefix_sums(spark.read.parquet(path), "id", {"s": "v"}, ranges=8)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the one window without a partition key stands over the sums of the ranges
    assert plan.count("SinglePartition") == 1 and plan.index("SinglePartition") < plan.index("partial_sum(v")
    assert out.agg(F.max("s")).first()[0] == sum(i % 17 for i in range(5000))
    ts = spark.range(50).select(F.timestamp_seconds(F.col("id") * 3600).alias("ts"), F.lit(1).alias("v"))
    assert growth.prefix_sums(ts, "ts", {"s": "v"}, ranges=5).agg(F.max("s")).first()[0] == 50


def test_only_touched_partitions_are_registered(spark, scratch):
    from marquee.sources import catalog

    path, name = scratch("parts"), "partition_test_table"
    schema = T.StructType([T.StructField("v", T.LongType()), T.StructField("month", T.StringType())])
    write = lambda rows, mode: spark.createDataFrame(rows, schema).write.mode(mode).option(
        "partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    write([(1, "01"), (2, "02")], "overwrite")
    catalog.create_external_table(spark, name, path, schema, partitions=["01"])
    try:
        assert [r["v"] for r in spark.table(name).collect()] == [1]  # 02 is not registered yet
        write([(3, "02"), (4, "02"), (5, "it's")], "overwrite")
        catalog.refresh_partitions(spark, name, "month", ["02", "it's"])
        assert sorted(r["v"] for r in spark.table(name).collect()) == [1, 3, 4, 5]
        assert {r["month"]: r["rows"] for r in catalog.partition_rows(spark, name, "month").collect()} == {"01": 1, "02": 2, "it's": 1}
        catalog.refresh_partitions(spark, name, "month", [])
        one = spark.table(name).where("month = '02'")
        size = one._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        whole = spark.table(name)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        assert int(str(size)) < int(str(whole))  # a plan knows the size of the partition it reads
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_report_tables(spark, tmp_path, monkeypatch):
    from marquee import __main__ as cli

    monkeypatch.setattr(cli, "_session", lambda is_local: spark)
    names = [c.split()[0] for c in RAW_COLS.split(", ")]
    batch = raw_batch(spark, range(1, 80))
    for c in S.RAW_COLUMNS:
        if c not in names:
            batch = batch.withColumn(c, F.lit(None).cast(S.raw_typed_schema()[c].dataType))
    ingest(spark, batch, str(tmp_path / "raw"), S.raw_typed_schema())
    cli.main(["transform", "--raw", str(tmp_path / "raw"), "--filtered", str(tmp_path / "zone")])
    before = folder_files(str(tmp_path / "zone"))
    more = batch.where("id in (1, 5, 9)").withColumn("id", F.col("id") + 1000)
    ingest(spark, more, str(tmp_path / "raw"), S.raw_typed_schema(), log=LoadLog(spark, str(tmp_path / "log")), load_id="more")
    cli.main(["transform", "--raw", str(tmp_path / "raw"), "--filtered", str(tmp_path / "zone"), "--loads", "more"])
    after = folder_files(str(tmp_path / "zone"))
    assert {m for m in after if after[m] != before[m]} == {"month=02"}
    with pytest.raises(ValueError):
        jobs.transform_data(spark, str(tmp_path / "raw"), str(tmp_path / "zone"), "key", ["more"])
    cli.main(["report", "--filtered", str(tmp_path / "zone"), "--out", str(tmp_path / "out"), "--raw", str(tmp_path / "raw")])
    made = set(os.listdir(tmp_path / "out"))
    assert {"genre_zero_money", "budget_by_year_genre", "company_frequency", "company_string_debut", "company_growth_largest_total_first",
            "company_growth_smallest_total_first", "cumulative_budget_latest_first", "outlier_counts", "quality_by_stage"} <= made
    counts = spark.read.parquet(str(tmp_path / "out" / "outlier_counts")).first()
    assert counts["rows_in"] == counts["rows_kept"] + counts["runtime_outliers"] and counts["runtime_outliers"] > 0


def test_a_written_batch_keeps_the_same_rows(spark, tmp_path):
    rng = random.Random(11)
    rows = [(rng.choice([None, 1, 1, 1, *range(2, 40)]), rng.choice(["a", "b", None]), rng.choice([1.5, None, 2.5])) for _ in range(300)]
    path = str(tmp_path / "batch")
    spark.createDataFrame(rows, "id long, v string, w double").write.parquet(path)
    batch, sink = spark.read.parquet(path), spark.range(30, 60)
    want = new_rows(batch, sink)
    got = new_rows(batch, sink, written=True)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == len({r[0] for r in rows if r[0] and r[0] < 30})
    assert new_rows(batch.limit(0), sink, written=True).count() == 0
