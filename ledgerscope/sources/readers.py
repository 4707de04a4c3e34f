"""Input resolution and scans.

Everything goes through Spark's readers and the Hadoop FileSystem of the session, so the
same code reads local folders, HDFS or object stores. Nothing is rewritten on the driver:
nanosecond timestamps are read as bigint and truncated to microseconds inside the plan, and
what leaves this module as a time is a timestamp, whatever its unit in the files.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --------------------------------------------------------------------------------------
# The names under which the five inputs are looked for, in priority order.
# --------------------------------------------------------------------------------------
INPUT_LOCATIONS: dict[str, tuple[str, ...]] = {
    "transactions": ("transactions", "transaction", "trx", "public/transactions"),
    "balances": ("dayend_balance", "DayEndBalance", "balance", "public/dayend_balance"),
    "kyc": ("kyc.parquet", "KYC.parquet", "public/kyc.parquet"),
    "train_labels": ("train_labels.csv", "public/train_labels.csv", "labels.csv"),
    "test_ids": ("test.csv", "public/test.csv", "sample_submission.csv", "public/sample_submission.csv"),
}
#: fallback: case-insensitive directory names, then name tokens
INPUT_DIR_NAMES: dict[str, tuple[str, ...]] = {
    "transactions": ("transactions", "transaction", "trx"),
    "balances": ("dayend_balance", "dayendbalance", "balance"),
}
INPUT_TOKENS: dict[str, tuple[tuple[str, ...], ...]] = {
    "transactions": (("trx",), ("transaction",)),
    "balances": (("balance",),),
    "kyc": (("kyc",),),
    "train_labels": (("train", "label"), ("labels",)),
    "test_ids": (("test",), ("sample", "submission")),
}
# --------------------------------------------------------------------------------------

#: inputs that may lie in several places, all of which are read
FACT_INPUTS = ("transactions", "balances")

NANOS_AS_LONG = "spark.sql.legacy.parquet.nanosAsLong"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder if it is there."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _list_recursive(spark: SparkSession, root: str) -> tuple[list[str], list[str]]:
    """(directories, files) under root, through the Hadoop FileSystem (metadata only)."""
    fs, p = _fs(spark, root)
    dirs, files, stack = [], [], [p]
    while stack:
        for st in fs.listStatus(stack.pop()):
            path = st.getPath().toString()
            if st.isDirectory():
                dirs.append(path)
                stack.append(st.getPath())
            else:
                files.append(path)
    return sorted(dirs), sorted(files)


def _base(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def resolve_inputs(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """The five inputs under ``root``: fixed names first, then directory names, then tokens.

    A fact table is everything that matches (all token groups); the others are the first match.
    """
    root = root.rstrip("/")
    listing: tuple[list[str], list[str]] | None = None
    found: dict[str, list[str]] = {}
    for name, candidates in INPUT_LOCATIONS.items():
        fact = name in FACT_INPUTS
        hits = [path for path in (f"{root}/{c}" for c in candidates) if path_exists(spark, path)]
        if not hits:
            if listing is None:
                listing = _list_recursive(spark, root) if path_exists(spark, root) else ([], [])
            hits = _by_directory(name, listing[0]) or _by_tokens(name, listing[1])
        found[name] = hits if fact else hits[:1]
    return found


def _by_directory(name: str, dirs: list[str]) -> list[str]:
    wanted = {n.lower() for n in INPUT_DIR_NAMES.get(name, ())}
    return [d for d in dirs if _base(d).lower() in wanted]


def _by_tokens(name: str, files: list[str]) -> list[str]:
    """Files named by the tokens: any token anywhere in a fact's path, else all of a group in the file name."""
    suffix = ".csv" if name in ("train_labels", "test_ids") else ".parquet"
    pool = [f for f in files if f.lower().endswith(suffix)]
    if name in FACT_INPUTS:
        tokens = [t for group in INPUT_TOKENS[name] for t in group]
        return [f for f in pool if any(t in f.lower() for t in tokens)]
    for group in INPUT_TOKENS[name]:
        hit = [f for f in pool if all(t in _base(f).lower() for t in group)]
        if hit:
            return hit
    return []


# ----------------------------------------------------------------------------- Parquet


def _has_nested_folders(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds sub-folders that are no partitions (``name=value``): those need a recursive scan."""
    fs, p = _fs(spark, path)
    if not fs.getFileStatus(p).isDirectory():
        return False
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    return any("=" not in n and not n.startswith(("_", ".")) for n in names)


def _reader(spark: SparkSession, options: dict[str, str]):
    return spark.read.options(**options)


def _nanos_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` whose scans take nanoseconds as bigint; ``spark`` keeps its settings."""
    other = spark.newSession()
    other.conf.set(NANOS_AS_LONG, "true")
    return other


#: footers read at a time
FOOTERS = 32


def _columns_of(spark: SparkSession, file: str) -> tuple[tuple[str, str], ...]:
    """``(column, type)`` of one file's footer, in the footer's order: the logical type, or else the physical one."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(file), conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    try:
        fields = reader.getFileMetaData().getSchema().getFields()
        return tuple((f.getName(), str(f.getLogicalTypeAnnotation() or f)) for f in fields)
    finally:
        reader.close()


def footer_table(spark: SparkSession, files: list[str]) -> dict[tuple[tuple[str, str], ...], list[str]]:
    """The files of each schema. Footers are small and read side by side, through the session's file systems."""
    found: dict[tuple[tuple[str, str], ...], list[str]] = {}
    with ThreadPoolExecutor(FOOTERS) as pool:
        for file, columns in zip(files, pool.map(lambda f: _columns_of(spark, f), files), strict=True):
            found.setdefault(tuple(sorted(columns)), []).append(file)
    return found


def nanos_columns(columns: Iterable[tuple[str, str]]) -> dict[str, bool]:
    """The columns in nanoseconds; True for instants, False for wall-clock times."""
    return {name: "true" in kind for name, kind in columns if "NANOS" in kind}


def _parts(spark: SparkSession, path: str, options: dict[str, str]):
    """Yields ``(files, nanosecond columns, options)``: parts of a path within which every column has one type.

    Where Spark can merge the footers of all files, that is one part. Otherwise the footers say which files go
    together: a folder whose format changed once has two parts, whatever the number of its files.
    """
    try:
        _reader(spark, options | {"mergeSchema": "true"}).parquet(path).schema  # noqa: B018 - resolves the schema
    except Exception:  # nanoseconds, or types that don't merge; the footers tell
        files = _parquet_files(spark, path)
        if not files:
            raise
        if "recursiveFileLookup" not in options and files != [path]:
            options = options | {"basePath": path}
        for columns, some in footer_table(spark, files).items():
            yield some, nanos_columns(columns), options
    else:
        yield [path], {}, options


def _parquet_files(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.getFileStatus(p).isDirectory():
        return [path]
    return [f for f in _list_recursive(spark, path)[1] if not _base(f).startswith(("_", "."))]


def _micros(column: str, instant: bool) -> Column:
    """A nanosecond column as a timestamp, cut to microseconds like a cast; wall-clock times stay such."""
    if instant:
        return F.timestamp_micros(F.expr(f"`{column}` div 1000"))
    seconds = f"CAST(CAST(`{column}` div 1000 AS DECIMAL(18, 0)) / 1000000 AS DECIMAL(18, 6))"
    return F.expr(f"TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds})")


def _before(spark: SparkSession, df: DataFrame, column: str, cutoff_date: str, instant: bool | None) -> DataFrame:
    """Rows before the cutoff's midnight, as a comparison on the stored column, which the scan can prune by.

    ``instant`` is None for a column that is not in nanoseconds.
    """
    kind = df.schema[column].dataType
    if instant is not None:
        midnight = f"unix_micros(CAST(DATE'{cutoff_date}' AS TIMESTAMP))" if instant else f"unix_date(DATE'{cutoff_date}') * 86400000000L"
        return df.where(F.col(column) < F.lit(spark.sql(f"SELECT {midnight}").first()[0] * 1000))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return df.where(F.col(column) < F.lit(cutoff_date).cast("date").cast(kind))
    return df


def read_parquet(spark: SparkSession, paths: list[str], before: dict[str, str] | None = None) -> DataFrame:
    """S3 + S5 + S6: Parquet folders and files, partitioned or nested, with any time unit.

    Partition columns are kept and prune the scan; a folder with plain sub-folders is read
    recursively. Nanosecond columns come back as timestamps, cut to microseconds. Files may differ in
    their times: units and kinds (instants, wall-clock times, bigint seconds) are taken from each file's
    footer; where a column holds both instants and wall-clock times, the latter are read in the
    session's zone. ``before``
    maps a time column to a date: rows at or after it are left out in the scan where the stored
    type allows, so this is no more than an early part of the as-of cut.
    """
    nanos = _nanos_session(spark)
    parts = []
    for path in paths:
        options = {"recursiveFileLookup": "true"} if _has_nested_folders(spark, path) else {}
        for files, stored, opts in _parts(spark, path, options):
            part = _reader(nanos if stored else spark, opts).parquet(*files)
            for column, date in (before or {}).items():
                if column in part.columns:
                    part = _before(spark, part, column, date, stored.get(column))
            if stored:
                part = part.withColumns({c: _micros(c, instant) for c, instant in stored.items()})
                # planned and run by the caller's session; only the scan keeps the other one's setting
                part = spark.createDataFrame([], part.schema).unionByName(part)
            parts.append(part)
    return _together(parts)


def _together(parts: list[DataFrame]) -> DataFrame:
    """The rows of all parts; a column that is a time in some and a bigint in others counts seconds there."""
    kinds: dict[str, set[str]] = {}
    for part in parts:
        for f in part.schema.fields:
            kinds.setdefault(f.name, set()).add(f.dataType.typeName())
    mixed = [c for c, k in kinds.items() if k & {"long", "integer"} and k & {"timestamp", "timestamp_ntz"}]
    out = None
    for part in parts:
        seconds = [c for c in mixed if c in part.columns and part.schema[c].dataType.typeName() in ("long", "integer")]
        part = part.withColumns({c: F.timestamp_seconds(F.col(c)) for c in seconds})
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


# ----------------------------------------------------------------------------- CSV, dispatch


def read_csv(spark: SparkSession, paths: list[str], schema: T.StructType | None = None) -> DataFrame:
    """Header CSV; with an explicit schema no inference pass is run over the data."""
    reader = spark.read.option("header", "true")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
    return reader.csv(paths)


def input_format(spark: SparkSession, path: str) -> str:
    """The format that a path's name, or else its being a folder, stands for."""
    by_suffix = {".csv": "csv", ".parquet": "parquet"}
    name = path.lower().rstrip("/")
    known = next((kind for suffix, kind in by_suffix.items() if name.endswith(suffix)), None)
    if known:
        return known
    fs, p = _fs(spark, path)
    return "parquet" if fs.exists(p) and fs.getFileStatus(p).isDirectory() else "csv"


def read_any(
    spark: SparkSession,
    paths: list[str] | str,
    kind: str | None = None,
    csv_schema: T.StructType | None = None,
    before: dict[str, str] | None = None,
) -> DataFrame:
    """Parquet or CSV (``csv_schema`` for CSV only); the first path decides unless ``kind`` is given."""
    every = [paths] if isinstance(paths, str) else list(paths)
    if not every:
        raise FileNotFoundError("an input was given no path to read")
    if (kind or input_format(spark, every[0])) == "parquet":
        return read_parquet(spark, every, before)
    return read_csv(spark, every, csv_schema)
