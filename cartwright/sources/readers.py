"""Readers: typed CSV, tolerant CSV, Parquet and raw-text scans.

All readers take explicit schemas, so no inference pass is spent over the
data; CSV columns are bound by the names of each file's own header (``heads``),
and read multi-line aware (quoted newlines stay in one record).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.functions.scalars import safe_cast, safe_timestamp
from cartwright.sources.fs import path_exists
from cartwright.sources.heads import HeaderGroup, Heads, file_heads, group_heads

CORRUPT = "_corrupt_record"
TEXTS = "_texts"    # a struct of the fields' texts, beside the typed columns of a scan

# Text tokens that the profiler reads as NULL (the pandas default
# missing-value spellings).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "encoding": "UTF-8",
}

# Tables whose free-text fields may hold quoted line breaks.  Multi-line
# parsing cannot split a file (one task per file), so it is switched on only
# for these; every other CSV is split into byte ranges across tasks.
MULTILINE_TABLES = frozenset({"reviews"})


def csv_options(multiline: bool = False) -> dict[str, str]:
    return {**CSV_OPTIONS, "multiLine": "true" if multiline else "false"}


class HeaderMismatch(ValueError):
    """A CSV's header lacks columns that the reader was asked for, or has one
    of them twice."""


def _read_group(spark: SparkSession, group: HeaderGroup, paths: str | list[str], types: dict[str, T.DataType],
                multiline: bool, corrupt: bool = False, **options: str) -> DataFrame:
    """Files of one header, read by position under its names (its header line
    is skipped); of a name that occurs more than once, the first column."""
    own = {k: group.header[k] for k in group.columns}
    fields = [T.StructField(f"c{k}", types.get(own[k], T.StringType()) if k in own else T.StringType(), True)
              for k in range(len(group.header))]
    if corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType(), True))
        options["columnNameOfCorruptRecord"] = CORRUPT
    raw = spark.read.options(**csv_options(multiline), **options).option("mode", "PERMISSIVE").schema(
        T.StructType(fields)).csv(paths)
    return raw.select(*[F.col(f"c{k}").alias(c) for k, c in own.items()], *([CORRUPT] if corrupt else []))


def _paths_of(heads: Heads, group: HeaderGroup, path: str) -> str | list[str]:
    """The table's own path where all its files can be read alike."""
    return path if len(heads.groups) == 1 and not heads.unreadable else group.paths


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for f in frames[1:]:
        whole = whole.union(f)
    return whole


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType,
                   infer: bool = False, multiline: bool = False) -> DataFrame:
    """Header CSV with typed columns, bound by each file's own header and
    returned in the order of ``schema``; further columns of the files are left
    out, empty files have no rows, and ``HeaderMismatch`` names columns that a
    header lacks or has twice.  ``infer=True`` takes the types from the data (a
    full extra pass, for schema-less sources)."""
    if infer:
        return spark.read.options(**csv_options(multiline)).option("inferSchema", "true").csv(path)
    names = [f.name for f in schema.fields]
    types = {f.name: f.dataType for f in schema.fields}
    heads = group_heads(file_heads(spark, path))
    if heads.unreadable:
        raise HeaderMismatch("; ".join(heads.unreadable.values()))
    for group in heads.groups:
        if lost := [c for c in names if c not in group.header]:
            raise HeaderMismatch(f"{group.paths[0]}: header {list(group.header)} lacks {lost}")
        if twice := [c for c in group.duplicates if c in names]:
            raise HeaderMismatch(f"{group.paths[0]}: header {list(group.header)} has {twice} more than once")
    if not heads.groups:
        return spark.createDataFrame([], schema)
    return _union([_read_group(spark, g, _paths_of(heads, g, path), types, multiline).select(*[f"`{c}`" for c in names])
                   for g in heads.groups])


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


@dataclass
class ScanResult:
    table_name: str
    status: str            # loaded | empty | missing | unreadable
    frame: DataFrame | None
    message: str = ""
    header: list[str] = field(default_factory=list)             # the names of all files' headers
    missing_columns: list[str] = field(default_factory=list)    # expected, in no header: read as NULL
    extra_columns: list[str] = field(default_factory=list)      # in a header, not expected: left out
    partial_columns: list[str] = field(default_factory=list)    # expected, in some files' headers only
    duplicate_columns: list[str] = field(default_factory=list)  # more than once in a header: the first is read
    heads: Heads = field(default_factory=Heads)
    with_texts: DataFrame | None = None     # the frame and the struct ``TEXTS`` of what the files hold


def _text_by_name(raw: DataFrame, schema: T.StructType, null_tokens: tuple[str, ...]) -> DataFrame:
    """The schema's columns as text (NULL where the file has none)."""
    cols = []
    for f in schema.fields:
        text = F.col(f"`{f.name}`") if f.name in raw.columns else F.lit(None).cast("string")
        cols.append((F.when(~F.trim(text).isin(*null_tokens), text) if null_tokens else text).alias(f.name))
    return raw.select(*cols, CORRUPT)


def _typed_from_text(texts: DataFrame, schema: T.StructType) -> DataFrame:
    cols = []
    for f in schema.fields:
        text = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            typed = safe_timestamp(text, T.StringType())
        elif isinstance(f.dataType, T.StringType):
            typed = text
        else:
            typed = safe_cast(text, f.dataType, T.StringType())
        cols.append(typed.alias(f.name))
    return texts.select(*cols, CORRUPT, F.struct(*[F.col(f"`{f.name}`") for f in schema.fields]).alias(TEXTS))


def tolerant_scans(spark: SparkSession, paths: dict[str, str], schemas: dict[str, T.StructType],
                   multiline: bool | None = None, null_tokens: tuple[str, ...] = NULL_TOKENS) -> dict[str, ScanResult]:
    """Read the CSV tables of a drop, any of which may be missing, empty or
    partly malformed; whatever is wrong with one leaves the others as they are.

    The head of every file is read first.  Files without a line of text are
    ``empty``, and so is a table that has no other; missing paths are
    ``missing``; a table none of whose files has a header that can be read is
    ``unreadable``.  Files are read in groups of equal headers, by the header's
    names, whatever their order, and put together by name.  Expected columns
    that no header has are NULL and reported, so are those that only some have
    (``partial_columns``), further ones (left out) and names that a header has
    more than once (the first is read).  Every field is read as text and cast
    with ``try_cast`` (bad values -> NULL); rows the CSV parser cannot fit keep
    their text in ``_corrupt_record``.  Text equal to one of ``null_tokens``
    becomes NULL: the profiler's rule, so the transform passes none and only
    empty fields are NULL there.  Quoted line breaks are honoured for
    ``MULTILINE_TABLES`` (or ``multiline=True``).
    """
    return {name: _scan(spark, name, path, schemas[name], name in MULTILINE_TABLES if multiline is None else multiline,
                        null_tokens) for name, path in paths.items()}


def _scan(spark: SparkSession, name: str, path: str, schema: T.StructType, multiline: bool,
          null_tokens: tuple[str, ...]) -> ScanResult:
    try:
        if "*" not in path and not path_exists(spark, path):
            return ScanResult(name, "missing", None, f"path does not exist: {path}")
        heads = group_heads(file_heads(spark, path))
        frames = [_scan_group(spark, heads, g, path, schema, multiline, null_tokens) for g in heads.groups]
    except (AnalysisException, Py4JJavaError) as err:
        status = "missing" if "PATH_NOT_FOUND" in str(err) else "unreadable"
        return ScanResult(name, status, None, str(err).splitlines()[0])
    if not frames:
        status = "unreadable" if heads.unreadable else "empty"
        why = "; ".join(heads.unreadable.values()) or f"no file with a line of text: {path}"
        return ScanResult(name, status, None, why, heads=heads)
    names, held = set(schema.names), [set(g.header) for g in heads.groups]
    whole = _union(frames)
    return ScanResult(
        name, "loaded", whole.drop(TEXTS), "; ".join(heads.unreadable.values()), heads.header,
        sorted(names - set.union(*held)), sorted(set.union(*held) - names),
        sorted(names & (set.union(*held) - set.intersection(*held))), heads.duplicates, heads, whole)


def _scan_group(spark: SparkSession, heads: Heads, group: HeaderGroup, path: str, schema: T.StructType, multiline: bool,
                null_tokens: tuple[str, ...]) -> DataFrame:
    raw = _read_group(spark, group, _paths_of(heads, group, path), {}, multiline, corrupt=True,
                      nullValue="\u0000" if null_tokens else "")
    return _typed_from_text(_text_by_name(raw, schema, null_tokens), schema)


def tolerant_scan(spark: SparkSession, table_name: str, path: str, schema: T.StructType,
                  multiline: bool | None = None, null_tokens: tuple[str, ...] = NULL_TOKENS) -> ScanResult:
    """``tolerant_scans`` of one table."""
    return tolerant_scans(spark, {table_name: path}, {table_name: schema}, multiline, null_tokens)[table_name]


def group_records(spark: SparkSession, heads: Heads, path: str, multiline: bool = False) -> DataFrame:
    """One row: the CSV records of all files, headers not counted."""
    if not heads.groups:
        return spark.range(1).select(F.lit(0).cast("bigint").alias("records"))
    one = [_read_group(spark, g, _paths_of(heads, g, path), {}, multiline).select(F.lit(1).alias("one"))
           for g in heads.groups]
    return _union(one).agg(F.count("one").alias("records"))


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines with the file they came from and its size."""
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
    )
