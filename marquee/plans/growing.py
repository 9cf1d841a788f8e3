"""Queries over zones that grow load by load; imported by ``plans.queries``.

Every one loads whole tables in several deliveries through the library's
incremental operators; its SQL is the plain form over the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee import schema as S
from marquee.functions.stats import to_cents
from marquee.operators import debut_state, growth, profile, rollups, tokens
from marquee.operators.cleaning import add_calendar, parse_columns
from marquee.plans import catalogue as cat
from marquee.plans.ingest import clean_loads, clean_zone, ingest, read_clean_zone, staged
from marquee.plans.jobs import CORRUPT
from marquee.plans.queries import DISTINCT_COLS, register
from marquee.session import scratch_path
from marquee.sources import bucketed, catalog, files, sinks
from marquee.sources import tpch_catalogue as tc
from marquee.sources.load_log import COUNTS, LOAD_ID, LoadLog
from marquee.sources.tables import table
from marquee.streaming.csv_stream import ingest_csv_stream

_SAID = {"key": T.LongType(), "conv_id": T.LongType(), "turn": T.LongType(), "role": T.StringType(), "text": T.StringType()}


def _counts_frame(spark: SparkSession, first: str, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, ", ".join([f"{first} long", *[f"{c} long" for c in COUNTS]]))


def _deliveries(said: DataFrame) -> list[DataFrame]:
    """Three deliveries with three headers: as declared; reversed with one more column; and one column of whole lines,
    of which every fifth conversation's are too short or too long."""
    one = said.where("turn % 3 = 0")
    two = said.where("turn % 3 = 1").select("text", F.lit("x").alias("extra"), "role", "turn", "conv_id", "key")
    flat = F.concat(F.lit('"'), F.translate("text", '"\n\r', "'  "), F.lit('"'))
    line = F.concat_ws(",", "key", "conv_id", "turn", "role", flat)
    bad = F.when(F.col("conv_id") % 10 == 0, F.concat_ws(",", "key", F.lit("short"))).when(
        F.col("conv_id") % 5 == 0, F.concat(line, F.lit(",surplus")))
    return [one, two, said.where("turn % 3 = 2").select(F.coalesce(bad, line).alias("key,conv_id,turn,role,text"))]


@register("csv_stream")
def csv_stream(spark, sf_dir):
    """Conversations as CSV deliveries of three headers, streamed one by one, then all again from a fresh checkpoint:
    what became of every row, and what the sink holds (A1, A9, L2, E1)."""
    said = table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 100_000 + F.col("turn")).alias("key"), "conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    folder, sink = scratch_path(spark, "deliveries"), scratch_path(spark, "stream-zone")
    place = {name: scratch_path(spark, name) for name in ("checkpoint", "fresh-checkpoint", "loads", "rejects")}
    options = dict(columns=T.StructType([T.StructField(c, T.StringType()) for c in _SAID]), types=_SAID, key="key", partition_col="role",
                   prepare=parse_columns, glob="*.csv", rejects_path=place["rejects"])
    runs = []
    for k, part in enumerate(_deliveries(said)):
        if k < 2:
            files.write_csv(part, folder, mode="append")
        else:  # whole lines, written as they are
            part.write.mode("append").option("header", "true").option("quote", "\u0000").option("sep", "\u0001").csv(folder)
        runs.append(ingest_csv_stream(spark, folder, sink, place["checkpoint"], place["loads"], **options))
    runs.append(ingest_csv_stream(spark, folder, sink, place["fresh-checkpoint"], place["loads"], **options))
    held = spark.read.parquet(sink).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"), F.sum("turn").alias("turns")).first()
    lines = T.StructType([T.StructField(CORRUPT, T.StringType())])
    rejected = files.read_parquet_or_empty(spark, place["rejects"], lines).where(F.col(CORRUPT).isNotNull()).count()
    return _counts_frame(spark, "run", [(k, *[r[c] for c in COUNTS]) for k, r in enumerate(runs)]).withColumns(
        {"sink_rows": F.lit(held["n"]), "sink_chars": F.lit(held["chars"]), "sink_turns": F.lit(held["turns"]), "reject_lines": F.lit(rejected)})


class _Lost(LoadLog):
    """A log whose commit never arrives: the load breaks off after its rows were published."""

    def commit(self, load_id, counts, schema):
        raise ConnectionError(f"load {load_id} was cut off")


@register("ingest_state")
def ingest_state(spark, sf_dir):
    """The load log after three loads of events, one repeated after its commit and one cut off before it."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    sink, path = scratch_path(spark, "event-zone"), scratch_path(spark, "event-loads")
    log = LoadLog(spark, path)
    loads = {"1": events.where("event_id % 3 = 0"), "2": events.where("event_id % 3 <> 1"), "3": events.unionByName(events.where("user_id % 7 = 0"))}

    def run(load_id: str, log: LoadLog) -> dict:
        return ingest(spark, loads[load_id], sink, events.schema, key="event_id", partition_col="event_type", log=log, load_id=load_id)

    run("1", log)
    run("1", log)  # known: nothing is read
    try:
        run("2", _Lost(spark, path))
    except ConnectionError:
        run("2", log)  # the replay finds its own rows published
    run("3", log)
    return log.loads().withColumn("sink_rows", F.lit(files.read_parquet_or_empty(spark, sink, events.schema).count()))


@register("incremental_clean")
def incremental_clean(spark, sf_dir):
    """The filtered zone after a second load of which only the touched months were cleaned again."""
    typed = add_calendar(cat.raw(spark, sf_dir))
    raw_path, out, log = scratch_path(spark, "grown-raw"), scratch_path(spark, "grown-zone"), LoadLog(spark, scratch_path(spark, "grown-loads"))
    rules = dict(status_allow=tc.ORDER_STATUS_ALLOW, rules=cat.order_rules())
    ingest(spark, typed.where("id % 3 <> 0"), raw_path, typed.schema, log=log, load_id="first")
    clean_zone(spark, raw_path, typed.schema, out, **rules)
    ingest(spark, typed.where("id % 3 <> 0 or month in (2, 11)"), raw_path, typed.schema, log=log, load_id="second")
    again = clean_loads(spark, raw_path, typed.schema, out, ["second"], **rules)
    zone = read_clean_zone(spark, out).groupBy("month").agg(
        F.count(F.lit(1)).alias("titles"), F.sum("revenue").alias("total_revenue"), F.sum(F.length("genres")).alias("genre_chars"))
    return zone.withColumn("rewritten", F.col("month").isin(again))


@register("bucketed_ingest")
def bucketed_ingest(spark, sf_dir):
    """Two loads into a table bucketed by key: the sink's side of the anti-join is not exchanged."""
    typed = add_calendar(cat.raw(spark, sf_dir, with_tokens=False)).select("id", "status", "release_date", "budget", "year")
    path = scratch_path(spark, "bucketed")
    name = "catalogue_keys_" + path.rsplit("-", 1)[-1]
    bucketed.create_bucketed_table(spark, name, path, typed.schema, "id", 8)
    try:
        runs = [bucketed.ingest_bucketed(spark, batch, name) for batch in (typed.where("id % 4 <> 0"), typed.unionByName(typed.where("id % 5 = 0")))]
        total = spark.table(name).agg(F.sum("budget").cast("double").alias("b")).first()["b"]
    finally:
        spark.sql(f"DROP TABLE {name}")  # external: its files stay
    return _counts_frame(spark, "run", [(k, *[r[c] for c in COUNTS]) for k, r in enumerate(runs)]).withColumn("sink_budget", F.lit(total))


def _loaded(rows: DataFrame, loads: int = 3) -> list[DataFrame]:
    return [rows.where(F.col("id") % loads == k) for k in range(loads)]


@register("debut_state")
def q_debut_state(spark, sf_dir):
    """Company growth from stored debut years brought forward by three loads, the last one run twice."""
    path = scratch_path(spark, "company-years")
    companies = tokens.company_rows(cat.cleaned(spark, sf_dir), tc.ORDER_COMPANY_DENY).select("id", "pc", "year")
    companies.write.parquet(path)
    companies, state = spark.read.parquet(path), scratch_path(spark, "debuts")
    for k, rows in [*enumerate(_loaded(companies)), (2, _loaded(companies)[2])]:
        changes = debut_state.apply_load(spark, rows, "pc", "year", state, f"load-{k}")
    return growth.growth_frame(debut_state.debut_counts(changes, as_="pc_distinct"), "year", "pc_distinct")


@register("title_debut_state")
def title_debut_state(spark, sf_dir):
    """Title growth from stored debut years, later loads bringing earlier years."""
    titles = cat.cleaned(spark, sf_dir, with_tokens=False).select("id", F.lower("title").alias("title"), "year").where("title <> 'na'")
    state = scratch_path(spark, "title-debuts")
    for k, years in enumerate((F.col("year") >= "1996", F.col("year") < "1994", F.col("year").between("1994", "1995"))):
        changes = debut_state.apply_load(spark, titles.where(years), "title", "year", state, f"load-{k}")
    return growth.growth_frame(debut_state.debut_counts(changes, as_="pc_count_by_year"), "year", "pc_count_by_year")


@register("sketch_profile")
def sketch_profile(spark, sf_dir):
    """Rows, NULLs and distinct values of a growing zone from stored sketches per month, one load merged in;
    the estimate against the exact count within four standard errors (F3, F4, L4)."""
    path, zone = scratch_path(spark, "summaries"), scratch_path(spark, "profiled")
    add_calendar(cat.raw(spark, sf_dir)).write.parquet(zone)
    raw = spark.read.parquet(zone)
    for rows in (raw.where("id % 3 <> 0 or month <> 5"), raw.where("month = 5")):
        sinks.write_partitioned(rollups.column_summary(rows, "month", DISTINCT_COLS), path, "part", mode="dynamic")
    merged = rollups.merged_columns(spark.read.parquet(path))
    told = profile.distinct_profile(raw, DISTINCT_COLS).select("column_name", F.col("distinct_values").alias("exact_values"))
    near = F.abs(F.col("distinct_values") - F.col("exact_values")) <= F.ceil(4 * rollups.SKETCH_ERROR * F.col("exact_values"))
    return merged.join(told, F.col("column") == F.col("column_name")).select("column_name", "rows", "nulls", "exact_values", near.alias("within_error"))


@register("genre_state")
def genre_state(spark, sf_dir):
    """Genre metrics per year from stored counts, sums and co-moments of three loads."""
    path, rows_path = scratch_path(spark, "genre-moments"), scratch_path(spark, "genre-rows")
    tokens.genre_rows(cat.cleaned(spark, sf_dir), tc.ORDER_GENRE_ALLOW).select("id", "year", "month", "genres", "budget", "revenue").write.parquet(rows_path)
    rows = spark.read.parquet(rows_path)
    for k, part in enumerate(_loaded(rows)):
        moments = rollups.pair_moments(part, ["year", "month", "genres"]).withColumn(LOAD_ID, F.lit(f"load-{k}"))
        sinks.write_partitioned(moments, path, LOAD_ID, mode="dynamic")
    text = {k: T.StringType() for k in ("year", "month", "genres")}
    stored = spark.read.schema(rollups.moment_schema(text, S.MONEY)).parquet(path)
    return rollups.merged_moments(stored, ["year", "genres"])


@register("partition_refresh")
def partition_refresh(spark, sf_dir):
    """An external table of which a second load's partitions alone are registered anew: its rows by month next to the
    catalogue's own counts, -1 where it holds none (A7)."""
    zone = cat.cleaned(spark, sf_dir, with_tokens=False)
    path = scratch_path(spark, "registered")
    name = "catalogue_parts_" + path.rsplit("-", 1)[-1]
    first, second = zone.where("month not in ('04', '07') and id % 2 = 0"), zone.where("month in ('04', '07', '12')")
    sinks.write_partitioned(first, path, "month", mode="overwrite")
    catalog.create_external_table(spark, name, path)
    try:
        sinks.write_partitioned(second, path, "month", mode="dynamic")
        catalog.refresh_partitions(spark, name, "month", ["04", "07", "12"])
        counted = spark.table(name).groupBy("month").agg(F.count(F.lit(1)).alias("titles"), F.sum("revenue").cast("double").alias("total_revenue")).collect()
        told = {r["month"]: -1 if r["rows"] is None else r["rows"] for r in catalog.partition_rows(spark, name, "month").collect()}
    finally:
        spark.sql(f"DROP TABLE {name}")
    return spark.createDataFrame([(r["month"], r["titles"], r["total_revenue"], told[r["month"]]) for r in counted],
                                 "month string, titles long, total_revenue double, catalogue_rows long")


@register("event_cumulative")
def event_cumulative(spark, sf_dir):
    """Running number and value of events in time order, to the event: a two-level prefix sum."""
    path = scratch_path(spark, "event-cents")
    table(spark, sf_dir, "events").select("event_id", "ts", to_cents("value").alias("cents"), F.lit(1).cast("long").alias("one")).write.parquet(path)
    rows = spark.read.parquet(path)
    both = growth.prefix_sums(rows, "ts", {"events_so_far": "one", "cents_so_far": "cents"}, ties=("event_id",), ranges=32)
    return both.select("event_id", "events_so_far", "cents_so_far")


@register("daily_cumulative")
def daily_cumulative(spark, sf_dir):
    """Revenue per release day and over all earlier days: a two-level prefix sum."""
    days = cat.cleaned(spark, sf_dir, with_tokens=False).groupBy("release_date").agg(F.sum("revenue").cast("decimal(28,2)").alias("daily_revenue"))
    out = growth.prefix_sums(staged(days, "daily"), "release_date", {"earlier_revenue": "daily_revenue"}, ranges=16, inclusive=False)
    return out.select("release_date", "daily_revenue", "earlier_revenue")
