"""Registered queries: each takes (spark, sf_dir) and returns a lazy DataFrame over whole tables.

Output columns are aliased to the names the SQL oracle uses. ``present``
normalises types for comparison across engines: money (summed exactly as
decimal) is shown as double, dates as ISO text, integers as bigint, and
correlations are rounded to 6 places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.operators import growth, incremental, metrics, profile, tokens, topk
from marquee.operators.cleaning import clean, drop_incomplete, fill_defaults, outlier_counts, parse_columns
from marquee.functions.parse import parse_as
from marquee.functions.text import normalise_category, pad_month, strip_company_text, strip_genre_text
from marquee.plans import analyses
from marquee.plans import catalogue as cat
from marquee.plans.ingest import clean_zone, ingest, prepare_batch, read_clean_zone, staged
from marquee.session import scratch_path
from marquee.sources import catalog, files, sinks
from marquee.sources import tpch_catalogue as tc
from marquee.sources.tables import table
from marquee.streaming.ingest_stream import ingest_stream, source_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: present(fn(spark, sf_dir))
        QUERIES[name].__doc__ = fn.__doc__
        QUERIES[name].__name__ = name
        return fn

    return deco


def present(df: DataFrame) -> DataFrame:
    """Engine-neutral output types (see module docstring)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        if f.name.endswith("correlation"):
            c = F.round(c, 6)
        cols.append(c.alias(f.name))
    return df.select(cols)


def _genres(spark, sf_dir) -> DataFrame:
    return tokens.genre_rows(cat.cleaned(spark, sf_dir), tc.ORDER_GENRE_ALLOW)


def _companies(spark, sf_dir) -> DataFrame:
    return tokens.company_rows(cat.cleaned(spark, sf_dir), tc.ORDER_COMPANY_DENY)


# ------------------------------------------------------------------ B: parsing


@register("typed_projection")
def typed_projection(spark, sf_dir):
    """Catalogue as text → typed columns, calendar parts, year/month text."""
    typed = prepare_batch(tc.catalogue_text(spark, sf_dir, with_tokens=False))
    out = typed.withColumns({"year_text": F.col("year").cast("string"), "month_text": pad_month("month")})
    return out.select(
        "id", "status", "release_date", "year", "month", "year_text", "month_text",
        F.col("runtime").cast("double").alias("runtime"), "budget", "revenue",
        F.col("vote_count").cast("double").alias("vote_count"), "vote_average", "title",
    )


PROBE_TYPES = {
    "id": T.LongType(), "release_date": T.DateType(), "runtime": T.IntegerType(),
    "title": T.IntegerType(), "status": T.DateType(), "genres": T.DoubleType(),
}


@register("malformed_values")
def malformed_values(spark, sf_dir):
    """Text parsed as numbers and dates: malformed values become NULL, no failure."""
    parsed = parse_columns(tc.catalogue_text(spark, sf_dir).select(*PROBE_TYPES), PROBE_TYPES)
    return profile.null_profile(parsed)


@register("numeric_text")
def numeric_text(spark, sf_dir):
    """Event values delivered as text ("37.9") read as whole numbers, cut towards zero (B1)."""
    ev = table(spark, sf_dir, "events").select("event_id", F.col("value").cast("string").alias("t"))
    return ev.select("event_id", parse_as("t", T.IntegerType()).alias("as_int"), parse_as("t", T.LongType()).alias("as_bigint"))


# ------------------------------------------------------------------ C: filters, nulls


@register("drop_incomplete")
def q_drop_incomplete(spark, sf_dir):
    """Rows with release date, revenue and budget all present."""
    return drop_incomplete(cat.raw(spark, sf_dir, with_tokens=False)).select("id", "status", "release_date", "budget", "revenue")


@register("fill_defaults")
def q_fill_defaults(spark, sf_dir):
    """Default text for NULL genres, title and companies."""
    return fill_defaults(cat.raw(spark, sf_dir)).select("id", "genres", "title", "production_companies")


@register("status_normalised")
def status_normalised(spark, sf_dir):
    """Status normalised to an allow-list, titles per status."""
    raw = cat.raw(spark, sf_dir)
    return raw.groupBy(normalise_category("status", tc.ORDER_STATUS_ALLOW).alias("status")).agg(
        F.count(F.lit(1)).alias("titles")
    )


@register("strip_text")
def strip_text(spark, sf_dir):
    """Genre and company character stripping over whole document texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    c = strip_company_text("text")
    g = strip_genre_text("text")
    return docs.select(
        "doc_id",
        F.length(g).alias("genre_text_length"), F.md5(g).alias("genre_text_md5"),
        F.length(c).alias("company_text_length"), F.md5(c).alias("company_text_md5"),
    )


# ------------------------------------------------------------------ C6, E2, E3, F12


@register("outlier_by_row")
def outlier_by_row(spark, sf_dir):
    """Cleaned catalogue with outlier rows removed (C6, E2, E3 row mode)."""
    return cat.cleaned(spark, sf_dir, "row", with_tokens=False).select("id", "year", "month")


@register("outlier_by_key")
def outlier_by_key(spark, sf_dir):
    """Cleaned catalogue with every row sharing an outlier's key removed (E2, E3 key mode)."""
    return cat.cleaned(spark, sf_dir, "key", with_tokens=False).select("id", "year", "month")


@register("outlier_by_title")
def outlier_by_title(spark, sf_dir):
    """Every row whose title has an outlier row anywhere removed: keys shared by many rows (E2, E3 key mode)."""
    raw = cat.raw(spark, sf_dir, with_tokens=False)
    kept = clean(raw, status_allow=tc.ORDER_STATUS_ALLOW, rules=cat.order_rules(), outlier_mode="key", key="title")
    return kept.select("id", "title")


@register("outlier_counts")
def q_outlier_counts(spark, sf_dir):
    """Outliers per rule in sequence, one pass."""
    return outlier_counts(cat.cleaned(spark, sf_dir, "none", with_tokens=False), cat.order_rules())


@register("zero_measures")
def zero_measures(spark, sf_dir):
    """Line items with zero discount and zero tax, per return flag."""
    li = table(spark, sf_dir, "lineitem")
    return metrics.count_both_zero(li, "l_discount", "l_tax", ["l_returnflag"])


@register("genre_zero_measures")
def genre_zero_measures(spark, sf_dir):
    """Genre rows with budget = revenue = 0 (C7 as in the genre analysis)."""
    return metrics.count_both_zero(_genres(spark, sf_dir), "budget", "revenue")


# ------------------------------------------------------------------ E1, A1-A9: I/O


@register("incremental_new_rows")
def incremental_new_rows(spark, sf_dir):
    """Catalogue rows whose key is not yet in a sink (here: keys of all line items)."""
    batch = cat.raw(spark, sf_dir, with_tokens=False).select("id", "status", "release_date")
    existing = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"))
    return incremental.new_rows(batch, existing, "id")


@register("ingest_roundtrip")
def ingest_roundtrip(spark, sf_dir):
    """Catalogue CSV → typed batch → raw zone by year (run twice) → filtered zone by month → read back
    (A1, A2, B1-B3, L2, E1, A3-A6, L1, L3)."""
    text = tc.catalogue_text(spark, sf_dir)
    csv_path = scratch_path(spark, "catalogue-csv")
    files.write_csv(text, csv_path)
    source = files.read_csv_as_text(spark, csv_path, text.columns, null_value=files.NULL_MARKER)
    batch = staged(prepare_batch(source), "catalogue-batch")  # the CSV is parsed once
    raw_schema = batch.schema
    raw_path, out_path = scratch_path(spark, "raw"), scratch_path(spark, "filtered")
    ingest(spark, batch, raw_path, raw_schema, batch_is_written=True)
    ingest(spark, batch, raw_path, raw_schema, batch_is_written=True)  # second run appends nothing
    clean_zone(spark, raw_path, raw_schema, out_path, status_allow=tc.ORDER_STATUS_ALLOW, rules=cat.order_rules())
    zone = read_clean_zone(spark, out_path)
    return zone.groupBy("month").agg(F.count(F.lit(1)).alias("titles"), F.sum("revenue").alias("total_revenue"))


@register("ingest_counts")
def ingest_counts(spark, sf_dir):
    """What became of every row of a batch, twice over: repeated, decimal and malformed keys."""
    ending = F.element_at(F.array(F.lit(""), F.lit(".0"), F.lit("?")), (F.col("turn") % 3 + 1).cast("int"))
    delivered = table(spark, sf_dir, "conversations").select(
        F.concat(F.col("conv_id").cast("string"), ending).alias("conv_id"), "turn", "role", "text")
    batch = parse_columns(delivered, {"conv_id": T.LongType()})
    sink = scratch_path(spark, "conversations")
    runs = [ingest(spark, batch, sink, batch.schema, key="conv_id", partition_col="role") for _ in range(2)]
    names = ["rows_read", "rejected_null_key", "duplicate_in_batch", "already_in_sink", "new_rows", "max_id"]
    return spark.createDataFrame([(k, *[r[n] for n in names]) for k, r in enumerate(runs)], ", ".join(f"{n} long" for n in ["run", *names]))


EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


@register("ingest_stream")
def q_ingest_stream(spark, sf_dir):
    """Events streamed (availableNow) into a sink, new keys only; the second stream, with a checkpoint of its own,
    meets every file again (A9, E1)."""
    sink = scratch_path(spark, "stream-sink")
    for _ in range(2):
        ckpt = scratch_path(spark, "stream-ckpt")
        stream = source_stream(spark, sf_dir, EVENT_SCHEMA, glob="events.parquet")
        ingest_stream(spark, stream, sink, ckpt, key="event_id", partition_col="event_type", sink_schema=EVENT_SCHEMA)
    return files.read_parquet_or_empty(spark, sink, EVENT_SCHEMA).select("event_id", "event_type", "value")


@register("csv_roundtrip")
def csv_roundtrip(spark, sf_dir):
    """Documents (quotes, commas, line breaks) → CSV → read back as text, columns by name in another order (A1, A2, A4)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    path = scratch_path(spark, "csv")
    files.write_csv(docs, path)
    back = files.read_csv_as_text(spark, path, ["source", "text", "doc_id", "lang"], null_value=files.NULL_MARKER)
    back = parse_columns(back, {"doc_id": T.LongType()})
    return back.select(
        "doc_id", F.length("text").alias("text_length"), F.md5("text").alias("text_md5"), "lang", "source"
    )


@register("external_table")
def external_table(spark, sf_dir):
    """Filtered zone registered as an external table partitioned by month, partitions recovered."""
    path = scratch_path(spark, "ext")
    sinks.write_partitioned(cat.cleaned(spark, sf_dir), path, "month", mode="overwrite")
    name = "catalogue_data_" + path.rsplit("-", 1)[-1]
    t = catalog.create_external_table(spark, name, path)
    out = t.groupBy("month").agg(
        F.count(F.lit(1)).alias("titles"), F.sum("revenue").alias("total_revenue"), F.sum("budget").alias("total_budget")
    )
    return _settled(out, f"TABLE {name}")


@register("table_views")
def table_views(spark, sf_dir):
    """Zone written, registered as an external table, persistent views over it; the genre view answers from the table
    (A6, A7, A8, F6). Table and views have names of this call and are dropped again."""
    path = scratch_path(spark, "view-zone")
    sinks.write_partitioned(cat.cleaned(spark, sf_dir), path, "month", mode="overwrite")
    suffix = path.rsplit("-", 1)[-1]
    name = f"catalogue_data_{suffix}"
    catalog.create_external_table(spark, name, path)
    views = list(catalog.create_views(
        spark, name, tc.ORDER_GENRE_ALLOW, tc.ORDER_COMPANY_DENY, prefix=f"z{suffix}_", persistent=True))
    return _settled(spark.table(views[1]), *[f"VIEW {v}" for v in views], f"TABLE {name}")


def _settled(df: DataFrame, *named: str) -> DataFrame:
    """``df`` written to the scratch folder and read again, so that what it reads can be dropped from the catalogue."""
    path = scratch_path(df.sparkSession, "settled")
    df.write.parquet(path)
    for thing in named:
        df.sparkSession.sql(f"DROP {thing}")
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ------------------------------------------------------------------ F1-F4, A12: profile


@register("schema_profile")
def schema_profile(spark, sf_dir):
    """Cleaned schema with per-column NULL counts."""
    return profile.schema_profile(cat.cleaned(spark, sf_dir))


@register("null_profile")
def null_profile(spark, sf_dir):
    """NULLs in every column of the raw catalogue, one scan."""
    return profile.null_profile(cat.raw(spark, sf_dir))


DISTINCT_COLS = ["status", "genres", "production_companies", "release_date"]


@register("distinct_profile")
def distinct_profile(spark, sf_dir):
    """Rows and distinct values (NULL counted) of the raw catalogue."""
    return profile.distinct_profile(cat.raw(spark, sf_dir), DISTINCT_COLS)


@register("distinct_profile_clean")
def distinct_profile_clean(spark, sf_dir):
    """Rows and distinct values (NULL counted) of the cleaned catalogue."""
    return profile.distinct_profile(cat.cleaned(spark, sf_dir), DISTINCT_COLS)


@register("key_max")
def key_max(spark, sf_dir):
    """Row count and numeric max of a text key (F1, F2)."""
    return profile.key_max(tc.catalogue_text(spark, sf_dir), "id")


# ------------------------------------------------------------------ F5-F8, H: genres


@register("genre_year")
def genre_year(spark, sf_dir):
    """Genre metrics per (year, genre)."""
    return analyses.genre_metrics(cat.cleaned(spark, sf_dir), "year", tc.ORDER_GENRE_ALLOW)


@register("genre_month")
def genre_month(spark, sf_dir):
    """Genre metrics per (month, genre)."""
    return analyses.genre_metrics(cat.cleaned(spark, sf_dir), "month", tc.ORDER_GENRE_ALLOW)


@register("genre_total")
def genre_total(spark, sf_dir):
    """Genre metrics per genre, ordered by budget, revenue, correlation."""
    out = analyses.genre_metrics(cat.cleaned(spark, sf_dir), "total", tc.ORDER_GENRE_ALLOW)
    return out.orderBy(F.desc("total_budget"), F.desc("total_revenue"), F.desc("budget_revenue_correlation"))


@register("genre_grouping_sets")
def genre_grouping_sets(spark, sf_dir):
    """Genre metrics at (year, genre), (month, genre) and (genre) in one scan and one shuffle."""
    return analyses.genre_metrics_all_grains(cat.cleaned(spark, sf_dir), tc.ORDER_GENRE_ALLOW)


@register("genre_view")
def genre_view(spark, sf_dir):
    """The genre view in Spark SQL over the cleaned table."""
    views = _views(spark, sf_dir)
    return spark.sql(f"SELECT * FROM {views['genre']}")


@register("genre_top5")
def genre_top5(spark, sf_dir):
    """Five largest (year, genre) groups by titles (H4)."""
    m = metrics.grouped_metrics(_genres(spark, sf_dir), ["year", "genres"])
    return topk.top_k(m, 5, [F.desc("total_movies")], ["year", "genres"])


@register("genre_month_top5")
def genre_month_top5(spark, sf_dir):
    """Five largest (month, genre) groups by titles (H4)."""
    m = metrics.grouped_metrics(_genres(spark, sf_dir), ["month", "genres"])
    return topk.top_k(m, 5, [F.desc("total_movies")], ["month", "genres"])


@register("genre_sample")
def genre_sample(spark, sf_dir):
    """First five rows of one genre by id."""
    g = _genres(spark, sf_dir).select("id", "genres", "year", "budget", "revenue")
    return topk.sample_where(g, F.col("genres") == "promo", 5, "id")


@register("budget_by_year_genre")
def budget_by_year_genre(spark, sf_dir):
    """Dashboard: budget per year and genre."""
    return _genres(spark, sf_dir).groupBy("year", "genres").agg(F.sum("budget").alias("total_budget"))


@register("releases_per_year")
def releases_per_year(spark, sf_dir):
    """Dashboard: titles released per year."""
    return analyses.releases_per_year(cat.cleaned(spark, sf_dir, with_tokens=False))


# ------------------------------------------------------------------ words of free text: short, denied, malformed and rare tokens occur

#: Words denied over the free texts.
WORD_DENY = ["license", "version", "public", ""]


def _words(spark, sf_dir) -> DataFrame:
    """One row per valid word of every document and conversation turn, line breaks taken as spaces."""
    docs = table(spark, sf_dir, "documents").select(F.lit("documents").alias("src"), "text")
    said = table(spark, sf_dir, "conversations").select(F.lit("conversations").alias("src"), "text")
    texts = docs.unionByName(said).withColumn("text", F.translate("text", "\n\t\r", "   "))
    return tokens.explode_tokens(texts, "text", "pc", keep=tokens.company_token(WORD_DENY), sep=" ")


@register("word_filter")
def word_filter(spark, sf_dir):
    """Words left per table when denied, short and malformed ones go."""
    return _words(spark, sf_dir).groupBy("src").agg(F.count(F.lit(1)).alias("words"), F.sum(F.length("pc")).alias("letters"))


@register("word_frequency")
def word_frequency(spark, sf_dir):
    """Words seen more than five times, most frequent first."""
    return metrics.frequency(_words(spark, sf_dir), "pc", min_count=5).orderBy(F.desc("count"), "pc")


@register("word_groups")
def word_groups(spark, sf_dir):
    """Number of different words, and of those seen more than five times."""
    return metrics.count_groups(_words(spark, sf_dir), "pc", min_count=5)


# ------------------------------------------------------------------ companies, W1-W3


@register("company_filter")
def company_filter(spark, sf_dir):
    """Company tokens: denied words, short and malformed names removed."""
    return _companies(spark, sf_dir).select("id", "pc")


@register("company_frequency")
def company_frequency(spark, sf_dir):
    """Rows per company token."""
    return metrics.frequency(_companies(spark, sf_dir), "pc").orderBy(F.desc("count"), "pc")


@register("company_frequent_count")
def company_frequent_count(spark, sf_dir):
    """Number of companies, and of companies seen more than 5 times."""
    return metrics.count_groups(_companies(spark, sf_dir), "pc", min_count=5)


@register("company_debut")
def company_debut(spark, sf_dir):
    """Companies per debut year."""
    return growth.debut_counts(_companies(spark, sf_dir), "pc", "year", as_="debuts")


@register("company_growth")
def company_growth(spark, sf_dir):
    """New companies per year, all earlier years, and the running total."""
    out = analyses.company_debut_growth(cat.cleaned(spark, sf_dir), tc.ORDER_COMPANY_DENY)
    return out.orderBy(F.desc("year"))


@register("company_string_growth")
def company_string_growth(spark, sf_dir):
    """Debut growth of whole company strings, "na" excluded."""
    return analyses.entity_debut_growth(cat.cleaned(spark, sf_dir), "production_companies")


@register("company_string_debut")
def company_string_debut(spark, sf_dir):
    """Whole company strings per debut year, "na" included, most first."""
    out = analyses.entity_debut_counts(cat.cleaned(spark, sf_dir), "production_companies")
    return out.orderBy(F.desc("pc_count_by_year"), "year")


@register("title_growth")
def title_growth(spark, sf_dir):
    """Debut growth with the title (customer) as entity."""
    return analyses.entity_debut_growth(cat.cleaned(spark, sf_dir, with_tokens=False), "title")


@register("company_cumulative_view")
def company_cumulative_view(spark, sf_dir):
    """The company growth view with CTEs and an inclusive running sum, in Spark SQL."""
    views = _views(spark, sf_dir)
    return spark.sql(f"SELECT * FROM {views['company']}")


@register("title_cumulative_view")
def title_cumulative_view(spark, sf_dir):
    """The company growth view over names that debut in many years: an inclusive sum of several rows."""
    views = _views(spark, sf_dir, named=F.translate("title", "#0123456789", ".abcdefghij"))
    return spark.sql(f"SELECT * FROM {views['company']}")


@register("companies_per_year")
def companies_per_year(spark, sf_dir):
    """Distinct company strings per year and their running totals."""
    return analyses.companies_per_year(cat.cleaned(spark, sf_dir)).orderBy("year")


@register("cumulative_budget")
def cumulative_budget(spark, sf_dir):
    """Budget per year and over all earlier years."""
    return analyses.cumulative_money(cat.cleaned(spark, sf_dir, with_tokens=False), "budget").orderBy("year")


@register("cumulative_revenue")
def cumulative_revenue(spark, sf_dir):
    """Revenue per year and over all earlier years."""
    return analyses.cumulative_money(cat.cleaned(spark, sf_dir, with_tokens=False), "revenue").orderBy("year")


@register("quality_report")
def quality_report(spark, sf_dir):
    """Types, NULLs, distinct values and rows of every column: raw, cleaned, and without outliers."""
    rep = analyses.quality_report(staged(cat.raw(spark, sf_dir), "quality-input"), tc.ORDER_STATUS_ALLOW, cat.order_rules())
    return rep.withColumn("distinct_values", F.col("distinct_values").cast("double"))


# ------------------------------------------------------------------ H5, views, whole rule set


@register("longest_values")
def longest_values(spark, sf_dir):
    """Ten longest document texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return topk.longest(docs, "text", 10, "doc_id").select("doc_id", "length")


@register("longest_genres")
def longest_genres(spark, sf_dir):
    """Ten longest genre lists (H5)."""
    c = cat.cleaned(spark, sf_dir).select("id", "genres")
    return topk.longest(c, "genres", 10, "id", as_="genres_len")


@register("longest_companies")
def longest_companies(spark, sf_dir):
    """Ten longest company lists (H5)."""
    c = cat.cleaned(spark, sf_dir).select("id", "production_companies")
    return topk.longest(c, "production_companies", 10, "id", as_="pc_len")


@register("release_view")
def release_view(spark, sf_dir):
    """The release projection view in Spark SQL."""
    views = _views(spark, sf_dir)
    return spark.sql(f"SELECT * FROM {views['release']}")


@register("cleaned_catalogue")
def cleaned_catalogue(spark, sf_dir):
    """Every cleaning rule at once, row mode: no join or shuffle beyond the catalogue derivation (L3)."""
    return cat.cleaned(spark, sf_dir)


def _views(spark: SparkSession, sf_dir: str, named: Column | None = None) -> dict[str, str]:
    """Register the cleaned catalogue (companies replaced by ``named``) and the three views under names unique to this call."""
    import uuid

    suffix = uuid.uuid4().hex[:8]
    src = f"catalogue_data_{suffix}"
    zone = cat.cleaned(spark, sf_dir) if named is None else cat.cleaned(spark, sf_dir, with_tokens=False).withColumn("production_companies", named)
    zone.createOrReplaceTempView(src)
    names = catalog.create_views(spark, src, tc.ORDER_GENRE_ALLOW, tc.ORDER_COMPANY_DENY, prefix=f"v{suffix}_")
    keys = ["release", "genre", "company"]
    return dict(zip(keys, names))


import marquee.plans.growing  # noqa: E402, F401 - registers its queries
