"""Declared schemas and fixed word lists of the catalogue model.

Schemas are declared, never inferred: inference costs a full extra scan of
the source and, on a 100 TB catalogue, silently changes types from one day
to the next.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values. These must equal the analysed job's values for the results to
# agree, so they are kept verbatim, in their original order.
# --------------------------------------------------------------------------

#: Allowed release statuses (matched case-insensitively after trimming).
STATUS_ALLOW = ["Released", "Planned", "In Production", "Post Production", "Cancelled", "Rumoured", "NA"]

#: Genres kept by the genre analysis (compared after lower-casing and trimming).
GENRE_ALLOW = [
    "action", "thriller", "crime", "comedy", "drama", "romance", "horror", "adventure", "documentary",
    "tv movie", "fantasy", "mystery", "history", "science fiction", "family", "war", "western",
    "animation", "na",
]

#: Tokens that are not company names (the genres plus the empty string).
COMPANY_DENY = [
    "action", "thriller", "crime", "comedy", "drama", "romance", "horror", "adventure", "documentary",
    "tv movie", "fantasy", "mystery", "history", "science fiction", "family", "war", "western", "na",
    "", "animation",
]

#: A company name is one word, or words joined by single dots.
COMPANY_NAME_PATTERN = r"^[a-zA-Z]+(\.[a-zA-Z]+)*$"
#: ... and longer than this many characters.
COMPANY_MIN_LENGTH = 5

#: Characters removed from genre text: everything but ASCII letters, white space and commas.
GENRE_STRIP_PATTERN = r"[^a-zA-Z\s,]"
#: Characters removed from company text: as above, but dots are kept.
COMPANY_STRIP_PATTERN = r"[^a-zA-Z\s,.]"

#: Separator of multi-valued text attributes.
TOKEN_SEPARATOR = ", "

#: Defaults filled after cleaning.
FILL_DEFAULTS = {"genres": "NA", "title": "", "production_companies": "NA"}

#: Category for statuses outside the allow-list (and for NULL).
OTHER_STATUS = "Others"

#: Outlier bounds; a value strictly outside (lo, hi) is an outlier, NULL never is.
RUNTIME_BOUNDS = (0, 300)
VOTE_AVERAGE_BOUNDS = (0.0, 90.0)
MONEY_LOWER_BOUND = 0

# --------------------------------------------------------------------------
# Schemas
# --------------------------------------------------------------------------

RAW_COLUMNS = [
    "id", "title", "vote_average", "vote_count", "status", "release_date", "revenue", "runtime", "budget",
    "imdb_id", "original_language", "original_title", "overview", "popularity", "tagline", "genres",
    "production_companies", "production_countries", "spoken_languages", "cast", "director",
    "director_of_photography", "writers", "producers", "music_composer",
]

#: The source CSV as delivered: every field is text until parsed.
RAW_TEXT_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

MONEY = T.DecimalType(18, 2)

#: Target types of the parsed columns (everything else stays text).
RAW_TYPES: dict[str, T.DataType] = {
    "id": T.LongType(),
    "vote_average": T.DoubleType(),
    "vote_count": T.IntegerType(),
    "release_date": T.DateType(),
    "revenue": MONEY,
    "runtime": T.IntegerType(),
    "budget": MONEY,
    "popularity": T.DoubleType(),
}

#: Columns of the cleaned ("filtered") zone, in order. ``month`` is the partition column.
CLEAN_COLUMNS = [
    "id", "status", "genres", "release_date", "runtime", "year", "month", "budget", "revenue",
    "vote_count", "vote_average", "title", "production_companies",
]

CLEAN_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("genres", T.StringType(), True),
    T.StructField("release_date", T.DateType(), True),
    T.StructField("runtime", T.IntegerType(), True),
    T.StructField("year", T.StringType(), True),
    T.StructField("budget", MONEY, True),
    T.StructField("revenue", MONEY, True),
    T.StructField("vote_count", T.IntegerType(), True),
    T.StructField("vote_average", T.DoubleType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("production_companies", T.StringType(), True),
    T.StructField("month", T.StringType(), True),
])


def raw_typed_schema(extra: dict[str, T.DataType] | None = None) -> T.StructType:
    """Schema of the raw zone: parsed source columns, then ``extra`` ones, then ``year``/``month`` ints."""
    types = {**RAW_TYPES, **(extra or {})}
    names = RAW_COLUMNS + [c for c in (extra or {}) if c not in RAW_COLUMNS]
    fields = [T.StructField(c, types.get(c, T.StringType()), True) for c in names]
    fields += [T.StructField("year", T.IntegerType(), True), T.StructField("month", T.IntegerType(), True)]
    return T.StructType(fields)
