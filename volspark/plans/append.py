"""New days added to stored series, without computing the series again.

A rolling value reaches a fixed number of rows back, so the last rows of every symbol are all
that new bars need of the past: ``window`` bars for returns and volatility, and as many rows of
the processed series as the longest frame of the features reaches behind the rows whose target
is still open. These carried rows are stored beside the tables. An append reads them and the
new bars, writes the rows that became complete, and stores what the next one needs; its work
grows with the new days and the number of symbols, not with the history.

Every append has a number and writes folders of that number, so a run that failed is repeated
over its own leavings. Readers see the appends up to the last one that committed, which it does
by the file it writes last. ``compact`` folds all of them into one, and ``drop_folded`` deletes
what was folded.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from volspark.operators.align import attach_series
from volspark.operators.clean import drop_incomplete
from volspark.operators.features import HORIZON, LAGS, QUARTER, add_features
from volspark.operators.returns import realized_volatility
from volspark.operators.series import WHOLE, SeriesLayout, over_series
from volspark.sinks import (
    CODEC,
    SHARD,
    bucket_of,
    by_shard,
    clearing_scratch,
    delete,
    dropping_shuffles,
    exists,
    folders,
    materialize,
)

#: What readers see, and what an append takes from the one before.
TABLES, CARRIED = ("processed", "features"), ("carried_bars", "carried_processed")

#: About the size of a folded file.
FILE_BYTES = 128 << 20

#: Marks of a row in an append: carried from before, its target open; carried; new.
PAST, OPEN, NEW = 0, 1, 2

#: What windows of later rows look at in a row of the processed series.
LOOKED_AT = ("symbol", "date", "log_return", "realized_vol", "vix", "mark")


@dataclass
class SeriesStore:
    """Processed series and features under ``path``, extended by appends.

    ``window`` and ``horizon`` must be the same in all appends.
    """

    spark: SparkSession
    path: str
    window: int = 21
    horizon: int = HORIZON
    layout: SeriesLayout = WHOLE

    @cached_property
    def reach(self) -> int:
        """Rows behind a row that its features look at."""
        return max(QUARTER - 1, *LAGS)

    @property
    def committed(self) -> list[int]:
        """The numbers of the appends that readers see."""
        done = [int(name.partition("=")[2]) for name in folders(self.spark, f"{self.path}/commit")]
        done = [n for n in done if exists(self.spark, f"{self.path}/commit/append={n}/_SUCCESS")]
        if not done:
            return []
        last = max(done)
        first = self.spark.read.parquet(f"{self.path}/commit/append={last}").first()["since"]
        return [n for n in sorted(done) if n >= first]

    def read(self, table: str, symbol: str | None = None) -> DataFrame:
        """``processed`` or ``features``, of all symbols or one."""
        rows = self._in_folders(table)
        if symbol:
            rows = rows.filter(F.col("bucket") == bucket_of(F.lit(symbol)))
            rows = rows.filter(F.col("symbol") == symbol)
        return rows.drop("append", "bucket")

    def _in_folders(self, table: str) -> DataFrame:
        """A table with the number and the bucket of its folders."""
        numbers = self.committed
        if not numbers:
            raise ValueError(f"nothing has been appended to {self.path}")
        root = f"{self.path}/{table}"
        paths = [f"{root}/append={n}" for n in numbers]
        return self.spark.read.option("basePath", root).parquet(*paths)

    def append(
        self, bars: DataFrame, implied_vol: DataFrame | None, span_days: int | None = None
    ) -> int:
        """Add ``bars``, all of later days than the symbol's stored ones; the append's number.

        ``implied_vol`` has the index of the new days: a day it lacks has no processed row, now
        or later. A bar dated before or at a stored one of its symbol fails the run before
        anything is seen of it. The first append may hold whole series. Both frames are read
        more than once: store before what is costly to make.
        """
        done = self.committed
        number, before = (done[-1] + 1, done[-1]) if done else (0, None)
        with clearing_scratch(self.spark), dropping_shuffles(self.spark):
            marked = self._with_carried(drop_incomplete(bars), "carried_bars", before)
            # marks are whole numbers, so rows of history stay complete
            vol = realized_volatility(
                self._in_order(self._dealt(marked)),
                self.window,
                layout=self.layout,
                keys=self._keys,
            )
            new = vol.filter(F.col("mark") == NEW).drop("mark")
            if implied_vol is not None:
                new = attach_series(new, implied_vol, span_days=span_days)
            if self.layout.chunk_rows is not None:
                new = materialize(new, "append-processed")
            self._write(new, "processed", number)

            # the shuffle of the bars is cheaper than one of the wider stored rows
            series = self._with_carried(new, "carried_processed", before)
            featured = add_features(series, self.horizon, layout=self.layout, keys=self._keys)
            ready = featured.filter(F.col("mark") != PAST).drop("mark")
            self._write(ready, "features", number)

            self._carry(marked, "carried_bars", number, self.window, 0)
            new = new.drop(SHARD)
            stored = self.spark.read.schema(new.schema).parquet(
                f"{self.path}/processed/append={number}"
            )
            series = self._with_carried(stored.select(*new.columns), "carried_processed", before)
            behind = self.reach + self.horizon
            self._carry(series, "carried_processed", number, behind, self.horizon, LOOKED_AT)
            self._commit(number, since=done[0] if done else 0)
        return number

    def compact(self) -> int:
        """Fold all appends into one folder of each table, as the next number.

        Earlier folders stay for readers that are still at them; ``committed`` no longer
        names them, and ``drop_folded`` deletes them.
        """
        number = self.committed[-1] + 1
        with clearing_scratch(self.spark), dropping_shuffles(self.spark):
            for table in TABLES:
                self._write(self._folded(table), table, number, dealt=True)
            for table in CARRIED:
                rows = self.spark.read.parquet(f"{self.path}/{table}/append={number - 1}")
                self._store(rows, f"{table}/append={number}")
            self._commit(number, since=number)
        return number

    def _folded(self, table: str) -> DataFrame:
        """All rows of a table, unshuffled: two tasks take some buckets, more take a large one."""
        rows = self._in_folders(table)
        files = rows.select("bucket", "_metadata.file_path", "_metadata.file_size").distinct()
        sizes = files.groupBy("bucket").agg(F.sum("file_size").alias("bytes")).orderBy("bucket")
        # at most BUCKETS rows
        found = [(r.bucket, r.bytes) for r in sizes.collect()]
        cores = self.spark.sparkContext.defaultParallelism
        most = min(FILE_BYTES, 2 * sum(size for _, size in found) / cores)
        groups: list[tuple[list[int], int]] = []
        for bucket, size in found:
            if groups and groups[-1][1] + size <= most:
                groups[-1] = [*groups[-1][0], bucket], groups[-1][1] + size
            else:
                groups.append(([bucket], size))
        rows = rows.drop("append")
        # not one task: Spark makes a union of parts of one task each a single task
        parts = [
            rows.filter(F.col("bucket").isin(buckets)).coalesce(max(2, math.ceil(size / FILE_BYTES)))
            for buckets, size in groups
        ]
        return reduce(DataFrame.unionAll, parts, rows.filter(F.lit(False))).drop("bucket")

    def drop_folded(self) -> None:
        """Delete what ``compact`` has folded, once no reader is at it any more."""
        numbers = self.committed
        for table in (*TABLES, *CARRIED):
            # of the carried rows only the last are read
            first = min(numbers, default=0) if table in TABLES else max(numbers, default=0)
            for name in folders(self.spark, f"{self.path}/{table}"):
                if int(name.partition("=")[2]) < first:
                    delete(self.spark, f"{self.path}/{table}/{name}")

    @property
    def _keys(self) -> tuple[str, ...]:
        """What the windows go by; whole series lie dealt out by shard."""
        return (SHARD, "symbol") if self.layout.chunk_rows is None else ("symbol",)

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """Whole series by shard: one shuffle serves the check, all windows and the folders."""
        return by_shard(rows) if self.layout.chunk_rows is None else rows

    def _with_carried(self, new: DataFrame, table: str, before: int | None) -> DataFrame:
        """New rows behind the carried ones, each with its mark."""
        new = new.withColumn("mark", F.lit(NEW))
        if before is None:
            return new
        carried = self.spark.read.parquet(f"{self.path}/{table}/append={before}")
        if SHARD in new.columns:
            carried = by_shard(carried)
        # symbols without new rows are carried on as they are
        return carried.select(*new.columns).unionByName(new)

    def _in_order(self, marked: DataFrame) -> DataFrame:
        """Fails where a new row is not later than the carried ones of its symbol."""

        def checked(df: DataFrame, w: WindowSpec) -> DataFrame:
            early = F.col("mark") < F.lag("mark").over(w)
            repeated = F.lag("date").over(w) == F.col("date")
            clash = F.raise_error(
                F.concat(F.lit("day not after the stored ones: "), "symbol", F.lit(" "), "date")
            )
            return df.withColumn("mark", F.when(early | repeated, clash).otherwise(F.col("mark")))

        done = over_series(marked, checked, before=1, layout=self.layout, keys=self._keys)
        # asks for every mark, also of rows that drop out later, so none goes unchecked
        return done.filter(F.col("mark").isNotNull())

    def _carry(
        self,
        marked: DataFrame,
        table: str,
        number: int,
        rows: int,
        open_rows: int,
        looked_at: tuple[str, ...] | None = None,
    ) -> None:
        """The last rows of each symbol, the ``open_rows`` last of them marked open.

        Of the others only the columns ``looked_at`` are kept, if given; the rest are NULL.
        """
        newest = Window.partitionBy("symbol").orderBy(F.col("date").desc())
        last = marked.withColumn("rank_", F.row_number().over(newest))
        last = last.filter(F.col("rank_") <= rows).withColumn(
            "mark", F.when(F.col("rank_") <= open_rows, OPEN).otherwise(PAST)
        )
        if looked_at:
            own = [c for c in marked.columns if c not in looked_at]
            last = last.withColumns({c: F.when(F.col("mark") == OPEN, F.col(c)) for c in own})
        self._store(last.drop("rank_"), f"{table}/append={number}")

    def _store(self, rows: DataFrame, folder: str) -> None:
        rows.write.mode("overwrite").option("compression", CODEC).parquet(f"{self.path}/{folder}")

    def _write(self, rows: DataFrame, table: str, number: int, dealt: bool = False) -> None:
        """Rows by bucket, sorted by symbol and day, over what a failed run left.

        They are not shuffled if ``dealt`` out already, so that a task has few buckets.
        """
        path = f"{self.path}/{table}/append={number}"
        dealt = dealt or SHARD in rows.columns
        rows = rows.drop(SHARD).withColumn("bucket", bucket_of(F.col("symbol")))
        (
            (rows if dealt else rows.hint("rebalance", F.col("bucket")))
            .sortWithinPartitions("bucket", "symbol", "date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .option("compression", CODEC)
            .partitionBy("bucket")
            .parquet(path)
        )
        # an append without rows still has its columns
        empty = self.spark.createDataFrame([], rows.drop("bucket").schema)
        empty.write.parquet(f"{path}/bucket=-1")

    def _commit(self, number: int, since: int) -> None:
        commit = self.spark.createDataFrame([(since,)], "since int").coalesce(1)
        commit.write.mode("overwrite").parquet(f"{self.path}/commit/append={number}")

