"""File sources: CSV edge and Parquet zones (A1-A4)."""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: CSV options that keep quoted commas, quotes and line breaks inside one field.
CSV_READ_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "encoding": "UTF-8",
}

#: NULL marker of CSV files we write ourselves, so that NULL and empty text
#: survive a round trip as two different values.
NULL_MARKER = "\\N"

CSV_WRITE_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "quoteAll": "false",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
    "nullValue": NULL_MARKER,
}


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    corrupt_column: str | None = None,
    null_value: str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """CSV with declared types, columns taken by header name (A1). No inference pass over the data.

    The header's order decides which field is which column: columns of
    ``schema`` come first, in its order; columns it does not name follow as text;
    a column it names that the file lacks raises. A file whose header differs
    from the first one's fails instead of being read by position. With
    ``multi_line`` a record may span lines and each file is one task; switch it
    off for large files without line breaks in fields. With ``corrupt_column``,
    malformed lines (too short, too long, broken quotes) keep their text there.
    ``null_value`` defaults to Spark's (an empty field is NULL); pass
    ``NULL_MARKER`` for files written by ``write_csv``.
    """
    header = spark.read.options(**_csv_options(multi_line)).csv(path).columns
    return _read_layout(spark, path, header, schema, corrupt_column, null_value, multi_line)


def _csv_options(multi_line: bool) -> dict[str, str]:
    return {**CSV_READ_OPTIONS, "multiLine": str(multi_line).lower(), "enforceSchema": "false", "inferSchema": "false"}


def _read_layout(
    spark: SparkSession, path: str | list[str], header: Sequence[str], schema: T.StructType, corrupt_column: str | None,
    null_value: str | None, multi_line: bool,
) -> DataFrame:
    """CSV files that share one header, as ``read_csv`` describes it."""
    options = _csv_options(multi_line)
    missing = [f.name for f in schema.fields if f.name not in header and f.name != corrupt_column]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    known = {f.name: f.dataType for f in schema.fields}
    fields = [T.StructField(c, known.get(c, T.StringType()), True) for c in header]
    if corrupt_column:
        fields.append(T.StructField(corrupt_column, T.StringType(), True))
    reader = spark.read.schema(T.StructType(fields)).options(**options)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    if corrupt_column:  # a line is judged by all its fields, also where a query needs only some of them
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column).option("columnPruning", "false")
    wanted = [f.name for f in schema.fields if f.name != corrupt_column]
    extra = [c for c in header if c not in known]
    return reader.csv(path).select(*[f"`{c}`" for c in [*wanted, *extra, *([corrupt_column] if corrupt_column else [])]])


#: Headers read at a time by the driver (each is a read of a file's first line).
HEADER_READS = 16


def listed_files(spark: SparkSession, path: str, glob: str | None = None) -> list[str]:
    """The files of a folder as Spark lists them (names only, no content is read)."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return sorted(r["path"] for r in reader.load(path).select("path").collect())


def literal_path(path: str) -> str:
    """A file name as a path pattern that matches only itself."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def csv_layouts(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by their header line; an empty file has none and is left out.

    Only first lines are read, several at a time. ``paths`` is one delivery's
    file list, so this is work of the size of a listing. A header has no line
    break in a name; one that has fails when the file is read.
    """
    def header(path: str) -> tuple[str, ...]:
        return tuple(spark.read.options(**_csv_options(False)).csv(literal_path(path)).columns)

    out: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(HEADER_READS) as pool:
        for path, names in zip(paths, pool.map(header, paths), strict=True):
            if names:
                out.setdefault(names, []).append(path)
    return out


def read_csv_files(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType,
    corrupt_column: str | None = None,
    null_value: str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """CSV files that need not share a header: each is read by its own, as ``read_csv`` does, and rows are united by name.

    One read per different header. A file without a column that ``schema`` names
    raises, whatever the others hold; a column that only some files have is NULL
    in the rows of the others. No file, or only empty ones, gives an empty table.
    """
    parts = [_read_layout(spark, [literal_path(p) for p in some], header, schema, corrupt_column, null_value, multi_line)
             for header, some in sorted(csv_layouts(spark, paths).items())]
    if not parts:
        return empty_table(spark, schema)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    if corrupt_column:
        out = out.select(*[F.col(f"`{c}`") for c in out.columns if c != corrupt_column], corrupt_column)
    return out


def read_csv_as_text(
    spark: SparkSession, path: str, columns: list[str], null_value: str | None = None, multi_line: bool = True
) -> DataFrame:
    """CSV with every named column as text (A2): the declared all-string schema."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    return read_csv(spark, path, schema, null_value=null_value, multi_line=multi_line).select(*[f"`{c}`" for c in columns])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV that ``read_csv(..., null_value=NULL_MARKER)`` reads back unchanged
    (quotes doubled, white space kept, NULL and empty text kept apart)."""
    df.write.mode(mode).options(**CSV_WRITE_OPTIONS).csv(path)


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """Typed table with no rows (A4)."""
    return spark.createDataFrame([], schema)


def _missing(e: Exception) -> bool:
    cond = getattr(e, "getCondition", None)
    name = cond() if callable(cond) else None
    return name == "PATH_NOT_FOUND" or "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e)


def _file_system(spark: SparkSession, path: str):
    """(Hadoop file system that serves ``path``, the path for it), or None without JVM access (Spark Connect)."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        return None
    place = sc._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(sc._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, asked of the Hadoop file system that serves it (HDFS, S3A, local...).

    A failing check (credentials, network) rises. Without JVM access (Spark
    Connect) the caller's read decides: the answer is that of a read attempt.
    """
    served = _file_system(spark, path)
    if served is None:
        try:
            spark.read.format("binaryFile").load(path).limit(0).collect()
        except AnalysisException as e:
            if _missing(e):
                return False
            raise
        return True
    return bool(served[0].exists(served[1]))


def holds_files(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists and holds a data file at any depth (names with a leading ``_`` or ``.`` are none)."""
    if not path_exists(spark, path):
        return False
    served = _file_system(spark, path)
    if served is None:
        return bool(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path").limit(1).collect())
    found = served[0].listFiles(served[1], True)
    while found.hasNext():
        if not found.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def require_path(spark: SparkSession, path: str) -> None:
    """Raise where ``path`` holds no file: a job that overwrites its output must not take a wrong path for an empty source."""
    if not holds_files(spark, path):
        raise FileNotFoundError(f"no source at {path}: nothing was written")


def read_parquet_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet zone with a declared schema; a missing zone reads as an empty table (A3, A4).

    Only a missing path is treated as "no data yet"; any other failure (auth,
    corrupt footer, transient I/O) surfaces, so a failed read is never taken for
    an empty sink and everything re-appended. The declared schema also keeps
    partition values typed as declared (``month=01`` stays text ``01``).
    """
    if not path_exists(spark, path):
        return empty_table(spark, schema)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:  # removed between the check and the read
        if _missing(e):
            return empty_table(spark, schema)
        raise
