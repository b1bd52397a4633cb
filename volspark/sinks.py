"""Writing tables of series, and the folder scratch tables go to."""

from __future__ import annotations

import math
import tempfile
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folders of a table of series, whatever the number of symbols.
BUCKETS = 64

#: Column of rows that ``by_shard`` has dealt out, and the shards of a bucket at least.
SHARD, SHARDS = "shard_", 8

#: A bucket with more files than this many times its shards is written again as a whole.
FILES_A_SHARD = 8

#: Doubles that differ take a tenth less room than with the default.
CODEC = "zstd"

#: The session's setting for it; sessions that do not know it keep the files longer.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_own_folders: dict[str, str] = {}

#: Scratch paths made since the innermost ``clearing_scratch`` of this thread began.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def bucket_of(symbol: Column) -> Column:
    """The folder of a symbol; folds to a constant for a literal, so reads are pruned."""
    return F.pmod(F.xxhash64(symbol), F.lit(BUCKETS)).cast("int")


def by_shard(df: DataFrame) -> DataFrame:
    """Rows dealt out by a part of a bucket, named in the column SHARD.

    Windows by (SHARD, symbol) and ``write_table`` take them as they lie. A shard goes to
    one file, so a table has few; their number follows the session's shuffle partitions.
    """
    shards = BUCKETS * _shards_of_bucket(df.sparkSession)
    shard = F.pmod(F.xxhash64("symbol"), F.lit(shards)).cast("int")
    return df.withColumn(SHARD, shard).repartition(SHARD)


def _shards_of_bucket(spark: SparkSession) -> int:
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(SHARDS, math.ceil(4 * tasks / BUCKETS))


def _file_system(spark: SparkSession, path: str):
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return name, name.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    name, files = _file_system(spark, path)
    return files.exists(name)


def delete(spark: SparkSession, path: str) -> None:
    name, files = _file_system(spark, path)
    files.delete(name, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none where there is no such folder."""
    name, files = _file_system(spark, path)
    if not files.exists(name):
        return []
    return [f.getPath().getName() for f in files.listStatus(name) if f.isDirectory()]


def _by_bucket(df: DataFrame) -> DataFrame:
    """Rows of few buckets a task: a large bucket is split over tasks, small ones share one."""
    return df.hint("rebalance", F.col("bucket"))


def _save(dealt: DataFrame, path: str) -> None:
    """Rows into the folders of their buckets, few of them a task, sorted by symbol."""
    order = ["bucket", "symbol", *[c for c in ("date", "refit_id") if c in dealt.columns]]
    (
        dealt.sortWithinPartitions(*order)
        .write.mode("overwrite")
        .partitionBy("bucket")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", CODEC)
        .parquet(path)
    )


def write_table(
    df: DataFrame, path: str, symbols: DataFrame | None = None, as_they_lie: bool = False
) -> str:
    """Write the rows of ``df`` and return ``path``; other symbols of the table stay.

    Rows that the table has of ``symbols`` (by default those in ``df``) are replaced. The
    layout is the same for any number of symbols: a fixed number of buckets by hash. Only
    the files that hold such rows are written again; new rows go into files of their own.
    Rows of ``by_shard`` are written without another shuffle, and so are rows read from such
    a table, which the caller tells by ``as_they_lie``.
    """
    with clearing_scratch(df.sparkSession):
        return _replace(df, path, symbols, as_they_lie)


def _replace(df: DataFrame, path: str, symbols: DataFrame | None, as_they_lie: bool) -> str:
    spark = df.sparkSession
    name, files = _file_system(spark, path)
    dealt = as_they_lie or SHARD in df.columns
    new = df.drop(SHARD).withColumn("bucket", bucket_of(F.col("symbol")))
    if not files.exists(name):
        # a file without rows, so that a table without any still has its schema
        empty = spark.createDataFrame([], df.drop(SHARD).schema)
        empty.write.parquet(f"{path}/bucket=-1")
        _save(new if dealt else _by_bucket(new), path)
        return path
    if symbols is None:
        new, dealt = materialize(new, "new-rows"), False
    gone = (new if symbols is None else symbols).select("symbol").distinct()
    gone = materialize(gone.withColumn("bucket", bucket_of(F.col("symbol"))), "new-symbols")
    # at most BUCKETS numbers
    touched = [r.bucket for r in gone.select("bucket").distinct().collect()]
    if not touched:
        return path
    replaced = _files_of(spark, path, gone, touched)
    of = spark._jvm.org.apache.hadoop.fs.Path
    # what is written lies beside the table, where readers do not look, until it is moved in
    staged = f"{path}/_new-{uuid.uuid4().hex}"
    try:
        if replaced:
            old = spark.read.schema(new.schema).option("basePath", path).parquet(*replaced)
            kept = old.join(gone.select("symbol"), "symbol", "left_anti").select(*new.columns)
            if dealt:
                kept = _by_bucket(kept)
            new = new.unionByName(kept)
        _save(new if dealt else _by_bucket(new), staged)
        # moved in before old files go: a run that ends in between has lost nothing
        for folder in folders(spark, staged):
            files.mkdirs(of(path, folder))
            for file in files.listStatus(of(staged, folder)):
                if not files.rename(file.getPath(), of(f"{path}/{folder}", file.getPath().getName())):
                    raise OSError(f"cannot move {staged}/{folder} to {path}")
        for file in replaced:
            files.delete(of(file), False)
    finally:
        files.delete(of(staged), True)
    return path


def _files_of(spark: SparkSession, path: str, gone: DataFrame, touched: list[int]) -> list[str]:
    """Files that hold a symbol of ``gone``, and those of buckets that have too many files."""
    _, files = _file_system(spark, path)
    of = spark._jvm.org.apache.hadoop.fs.Path
    listed = {}
    for bucket in sorted(touched):
        folder = f"{path}/bucket={bucket}"
        if files.exists(of(folder)):
            names = [f.getPath().getName() for f in files.listStatus(of(folder))]
            listed[bucket] = [n for n in names if n.endswith(".parquet")]
    if not any(listed.values()):
        return []
    # one row per symbol and file before anything is joined; no more names than files are sent
    old = spark.read.schema("symbol string, bucket int").parquet(path)
    held = old.filter(F.col("bucket").isin(list(listed))).select(
        "symbol", "bucket", F.col("_metadata.file_name").alias("file")
    )
    held = held.distinct().join(gone.select("symbol"), "symbol", "left_semi")
    found = {(r.bucket, r.file) for r in held.select("bucket", "file").distinct().collect()}
    most = FILES_A_SHARD * _shards_of_bucket(spark)
    return [
        f"{path}/bucket={bucket}/{n}"
        for bucket, names in listed.items()
        for n in names
        if (bucket, n) in found or len(names) > most
    ]


def write_exchange(df: DataFrame, folder: str, suffix: str, header: list[str]) -> str:
    """One CSV file ``{symbol}{suffix}`` per symbol, in ``folder``, for other programs.

    ``header`` lines may name the symbol as {symbol}. A series is short by its calendar and
    is one task's work; all series are written side by side and then given their names.
    """
    spark = df.sparkSession
    names = [c for c in df.columns if c != "symbol"]
    lines = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names])
    # one row per line, in order: headers first
    tops = F.array(
        *[
            F.struct(
                F.lit(None).cast("date").alias("date"),
                F.lit(i).alias("place"),
                F.regexp_replace(F.lit(line), r"\{symbol\}", F.col("symbol")).alias("line"),
            )
            for i, line in enumerate(header)
        ]
    )
    body = df.select("symbol", "date", F.lit(len(header)).alias("place"), lines.alias("line"))
    head = df.select("symbol").distinct().select("symbol", F.inline(tops))
    both = body.unionByName(head.select(*body.columns))
    return write_lines(both, folder, suffix, "place", "date")


def write_lines(lines: DataFrame, folder: str, suffix: str, *order: str) -> str:
    """A file ``{symbol}{suffix}`` in ``folder`` of each symbol's ``line`` values, in ``order``."""
    spark = lines.sparkSession
    with clearing_scratch(spark):
        scratch = scratch_path(spark, "exchange")
        (
            lines.repartition("symbol")
            .sortWithinPartitions("symbol", *order)
            .select("symbol", "line")
            .write.partitionBy("symbol")
            .text(scratch)
        )
        target, files = _file_system(spark, folder)
        files.mkdirs(target)
        of = spark._jvm.org.apache.hadoop.fs.Path
        for part in files.listStatus(of(scratch)):
            name = part.getPath().getName()
            if not name.startswith("symbol="):
                continue
            # Spark escapes some characters in folder names; a file may have all but a slash
            symbol = unquote(name.removeprefix("symbol="))
            new = of(folder, symbol.replace("/", "%2F") + suffix)
            files.delete(new, False)
            for file in files.listStatus(part.getPath()):
                if file.getPath().getName().startswith("part-"):
                    files.rename(file.getPath(), new)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it.

    Only a local session may go without; it gets a folder of its own, once.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    on_cluster = not spark.sparkContext.master.startswith("local")
    if named:
        if on_cluster and ":" not in named and _file_system(spark, named)[1].getScheme() == "file":
            warnings.warn(f"executors may not share {named}; name it with its file system")
        return named.rstrip("/")
    if on_cluster:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    session = spark.sparkContext.applicationId
    if session not in _own_folders:
        _own_folders[session] = tempfile.mkdtemp(prefix="volspark-")
    return _own_folders[session]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def clearing_scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what was written to fresh scratch paths inside, by this thread.

    For runs whose results are written tables: what is read later must not rest on them.
    """
    paths: list[str] = []
    outer = _made.set(paths)
    try:
        yield
    finally:
        _made.reset(outer)
        for path in paths:
            delete(spark, path)


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of every action inside when it ends, not when Spark next collects."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    if before == "true":  # whoever set it ends it
        yield
        return
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def materialize(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("error").option("compression", CODEC)
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
