"""Days added to stored series: the same rows as from the whole history."""

from datetime import date, timedelta

import pandas as pd
import pytest
from conftest import collect, frame, walk
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from volspark import schemas
from volspark.catalog.queries import queries
from volspark.operators.features import add_features
from volspark.operators.series import SeriesLayout
from volspark.plans.append import SeriesStore
from volspark.plans.pipeline import build_processed

KEYS = ("symbol", "date")


@pytest.fixture(scope="module")
def panel(spark):
    """Long, short and late series; one that ends early; a bar without a price."""
    late = date(2022, 5, 2)
    rows = pd.concat(
        [walk("AAA", 150, 1), walk("BBB", 100, 2), walk("CCC", 60, 3, late), walk("DDD", 40, 4)]
    )
    rows.loc[(rows.symbol == "AAA") & (rows.date == date(2022, 3, 1)), "close"] = None
    return frame(spark, rows, schemas.BARS).cache()


@pytest.fixture(scope="module")
def index(spark):
    """Lacks a day in each month."""
    days = [date(2022, 1, 3) + timedelta(days=i) for i in range(250)]
    rows = [(day, 18.0 + day.day / 7) for day in days if day.day != 9]
    return spark.createDataFrame(rows, schemas.IMPLIED_VOL).cache()


def between(df, first, last):
    return df.filter((F.col("date") >= F.lit(first)) & (F.col("date") < F.lit(last)))


def appended(spark, path, panel, index, cuts, **options):
    store = SeriesStore(spark, str(path), **options)
    days = [date(2000, 1, 1), *cuts, date(2030, 1, 1)]
    for first, last in zip(days, days[1:]):
        side = None if index is None else between(index, first, last)
        store.append(between(panel, first, last), side)
    return store


@pytest.mark.parametrize(
    "cuts",
    [
        [date(2022, 4, 1)],
        [date(2022, 1, 10), date(2022, 2, 1), date(2022, 5, 3)],
        [date(2022, 5, 20) + timedelta(days=i) for i in range(4)],
        [date(2022, 4, 15), date(2022, 12, 1)],
    ],
)
def test_parts_equal_the_whole(spark, tmp_path, panel, index, cuts):
    store = appended(spark, tmp_path, panel, index, cuts)
    whole = build_processed(panel, index)
    assert collect(store.read("processed"), *KEYS) == collect(whole, *KEYS)
    assert collect(store.read("features"), *KEYS) == collect(add_features(whole), *KEYS)
    one = [r for r in collect(whole, *KEYS) if r["symbol"] == "BBB"]
    assert collect(store.read("processed", "BBB"), *KEYS) == one


def test_without_an_index_and_with_other_reaches(spark, tmp_path, panel):
    cuts = [date(2022, 3, 15), date(2022, 4, 20)]
    store = appended(spark, tmp_path, panel, None, cuts, window=10, horizon=8)
    whole = build_processed(panel, None, window=10)
    assert collect(store.read("processed"), *KEYS) == collect(whole, *KEYS)
    ours = collect(store.read("features"), *KEYS)
    assert ours == collect(add_features(whole, horizon=8), *KEYS)


def test_folding_changes_no_row(spark, tmp_path, panel, index):
    cuts = [date(2022, 3, 15), date(2022, 4, 20)]
    store = appended(spark, tmp_path, between(panel, date(2000, 1, 1), date(2022, 5, 1)), index, cuts)
    before = collect(store.read("features"), *KEYS)
    assert store.committed == [0, 1, 2]
    store.compact()
    assert store.committed == [3] and collect(store.read("features"), *KEYS) == before
    late = date(2022, 5, 1), date(2030, 1, 1)
    store.append(between(panel, *late), between(index, *late))
    assert store.committed == [3, 4]
    whole = add_features(build_processed(panel, index))
    assert collect(store.read("features"), *KEYS) == collect(whole, *KEYS)


def test_a_failed_run_is_not_seen_and_is_repeated(spark, tmp_path, panel, index, monkeypatch):
    first = date(2000, 1, 1), date(2022, 4, 1)
    store = SeriesStore(spark, str(tmp_path))
    store.append(between(panel, *first), between(index, *first))
    before = collect(store.read("processed"), *KEYS)

    def breaks(*_, **__):
        raise RuntimeError("lost")

    rest = date(2022, 4, 1), date(2030, 1, 1)
    with monkeypatch.context() as patch:
        patch.setattr(SeriesStore, "_commit", breaks)
        # more symbols than the repeated run has: their folders must go
        with pytest.raises(RuntimeError, match="lost"):
            more = between(panel, *rest).withColumn("symbol", F.concat("symbol", F.lit("x")))
            store.append(between(panel, *rest).union(more), between(index, *rest))
    assert store.committed == [0] and collect(store.read("processed"), *KEYS) == before
    store.append(between(panel, *rest), between(index, *rest))
    whole = build_processed(panel, index)
    assert collect(store.read("processed"), *KEYS) == collect(whole, *KEYS)


@pytest.mark.parametrize("day", [date(2022, 3, 31), date(2022, 2, 1)])
def test_days_must_be_new(spark, tmp_path, panel, index, day):
    first = date(2000, 1, 1), date(2022, 4, 1)
    store = SeriesStore(spark, str(tmp_path))
    store.append(between(panel, *first), between(index, *first))
    again = between(panel, day, date(2022, 4, 10))
    with pytest.raises(PySparkException, match="day not after the stored ones"):
        store.append(again, index)
    assert store.committed == [0]


def test_nothing_appended(spark, tmp_path, panel, index):
    store = SeriesStore(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError, match="nothing has been appended"):
        store.read("features")
    store.append(panel.limit(0), index)
    assert store.read("features").count() == 0
    store.append(panel, index)
    whole = add_features(build_processed(panel, index))
    assert collect(store.read("features"), *KEYS) == collect(whole, *KEYS)


def test_an_append_shuffles_its_bars_and_no_wider_rows(spark, tmp_path, panel, index, monkeypatch):
    """The check, all windows and the folders of both tables go by one shuffle of the bars."""
    first, rest = (date(2000, 1, 1), date(2022, 4, 1)), (date(2022, 4, 1), date(2030, 1, 1))
    found, write = [], SeriesStore._write

    def watched(store, rows, table, number):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        by_symbol = plan.count("hashpartitioning(symbol#")
        found.append((table, plan.count("hashpartitioning(shard_#"), by_symbol))
        write(store, rows, table, number)

    def rebalanced(*_, **__):
        raise AssertionError("shuffled again")

    store = SeriesStore(spark, str(tmp_path))
    with monkeypatch.context() as patch:
        patch.setattr(SeriesStore, "_write", watched)
        patch.setattr(type(panel), "hint", rebalanced)
        store.append(between(panel, *first), between(index, *first))
        store.append(between(panel, *rest), between(index, *rest))
    # the features of a later append take the carried rows too, dealt out alike
    assert found == [("processed", 1, 0), ("features", 1, 0), ("processed", 1, 0), ("features", 2, 0)]
    whole = build_processed(panel, index)
    assert collect(store.read("processed"), *KEYS) == collect(whole, *KEYS)
    assert collect(store.read("features"), *KEYS) == collect(add_features(whole), *KEYS)


def test_carried_rows_hold_what_windows_look_at(spark, tmp_path, panel, index):
    store = appended(spark, tmp_path, panel, index, [date(2022, 4, 15)])
    carried = spark.read.parquet(f"{tmp_path}/carried_processed/append=1")
    past, still_open = carried.filter("mark = 0"), carried.filter("mark = 1")
    assert past.filter("coalesce(open, high, low, close, volume) IS NOT NULL").count() == 0
    assert past.count() == past.dropna(subset=["log_return", "realized_vol", "vix"]).count() > 0
    assert still_open.count() == still_open.dropna().count() > 0
    assert not {"bucket", "shard_"} & set(carried.columns + store.read("features").columns)


def test_chunks_of_long_series_are_appended_alike(spark, tmp_path, panel, index):
    cuts = [date(2022, 3, 15), date(2022, 5, 3)]
    store = appended(spark, tmp_path, panel, index, cuts, layout=SeriesLayout(80))
    whole = build_processed(panel, index)
    assert collect(store.read("processed"), *KEYS) == collect(whole, *KEYS)
    assert collect(store.read("features"), *KEYS) == collect(add_features(whole), *KEYS)


def test_days_of_a_series_without_volatility_must_be_new_too(spark, tmp_path, panel, index):
    """Rows that drop out for want of a full window are checked before they do."""
    store = SeriesStore(spark, str(tmp_path))
    young = panel.filter("symbol = 'DDD'").orderBy("date").limit(6).cache()
    store.append(young, index)
    with pytest.raises(PySparkException, match="day not after the stored ones"):
        store.append(young.orderBy(F.desc("date")).limit(1), index)
    assert store.committed == [0]


def test_the_query_makes_its_bars_and_index_once(spark, tmp_path, monkeypatch):
    """Each part reads stored rows, not the line items and orders again."""
    days = [date(1996, 6, 1) + timedelta(days=i) for i in range(1_300)]
    lines = [(i % 2, 900.0 + i % 37, 1.0 + i % 3, day) for i, day in enumerate(days)]
    orders = [(day, 100.0 + i * k % 11) for i, day in enumerate(days) for k in (1, 2, 3)]
    kinds = "l_suppkey long, l_extendedprice double, l_quantity double, l_shipdate date"
    spark.createDataFrame(lines, kinds).write.parquet(f"{tmp_path}/lineitem.parquet")
    kinds = "o_orderdate date, o_totalprice double"
    spark.createDataFrame(orders, kinds).write.parquet(f"{tmp_path}/orders.parquet")
    plans, append = [], SeriesStore.append

    def watched(store, bars, implied_vol, span_days=None):
        plans.extend(df._jdf.queryExecution().executedPlan().toString() for df in (bars, implied_vol))
        return append(store, bars, implied_vol, span_days)

    with monkeypatch.context() as patch:
        patch.setattr(SeriesStore, "append", watched)
        ours = queries()["suppliers_appended_features"](spark, str(tmp_path))
    assert len(plans) == 8 and not [plan for plan in plans if "Exchange" in plan]
    whole = queries()["suppliers_features_full"](spark, str(tmp_path))
    assert collect(ours, *KEYS) == collect(whole, *KEYS) != []


def test_folding_shuffles_no_row_and_leaves_few_files(spark, tmp_path, panel, index, monkeypatch):
    store = appended(spark, tmp_path, panel, index, [date(2022, 4, 15), date(2022, 5, 20)])
    before = {table: collect(store.read(table), *KEYS) for table in ("processed", "features")}
    plans, spread, write = {}, {}, SeriesStore._write

    def watched(store, rows, table, number, **options):
        plans[table] = rows._jdf.queryExecution().executedPlan().toString()
        spread[table] = {
            task: {r.symbol for r in lines}
            for task, lines in enumerate(rows.select("symbol").rdd.glom().collect()) if lines
        }
        write(store, rows, table, number, **options)

    def rebalanced(*_, **__):
        raise AssertionError("shuffled again")

    with monkeypatch.context() as patch:
        patch.setattr(SeriesStore, "_write", watched)
        patch.setattr(type(panel), "hint", rebalanced)
        number = store.compact()
    for table, rows in before.items():
        assert len(spread[table]) > 1 and max(len(of) for of in spread[table].values()) == 1
        assert "Exchange" not in plans[table]
        assert collect(store.read(table), *KEYS) == rows != []
        folder = tmp_path / table / f"append={number}"
        files = list(folder.rglob("bucket=[0-9]*/*.parquet"))
        assert len(files) <= 2 * len({f.parent for f in files})
        for file in files:
            lines = [(r.symbol, r.date) for r in spark.read.parquet(str(file)).collect()]
            assert lines == sorted(lines)
    # many tasks a bucket, and a store of no rows
    monkeypatch.setattr("volspark.plans.append.FILE_BYTES", 1_000)
    store.compact()
    assert collect(store.read("features"), *KEYS) == before["features"]
    bare = SeriesStore(spark, str(tmp_path / "bare"))
    bare.append(panel.limit(0), index.limit(0))
    bare.compact()
    assert bare.read("features").columns == store.read("features").columns
    assert bare.read("features").count() == 0


def test_folded_folders_can_be_dropped(spark, tmp_path, panel, index):
    cuts = [date(2022, 4, 15), date(2022, 5, 10)]
    early, late = (date(2000, 1, 1), date(2022, 5, 20)), (date(2022, 5, 20), date(2030, 1, 1))
    store = appended(spark, tmp_path, between(panel, *early), between(index, *early), cuts)
    store.drop_folded()
    whole = build_processed(between(panel, *early), index)
    assert collect(store.read("processed"), *KEYS) == collect(whole, *KEYS)
    number = store.compact()
    store.drop_folded()
    for table in ("processed", "features", "carried_bars", "carried_processed"):
        assert [f.name for f in (tmp_path / table).glob("append=*")] == [f"append={number}"]
    store.append(between(panel, *late), between(index, *late))
    whole = build_processed(panel, index)
    assert collect(store.read("processed"), *KEYS) == collect(whole, *KEYS)
    assert collect(store.read("features"), *KEYS) == collect(add_features(whole), *KEYS)
    SeriesStore(spark, str(tmp_path / "none")).drop_folded()


def test_the_query_keeps_no_bars_and_nothing_folded(spark, tmp_path, monkeypatch):
    days = [date(1996, 6, 1) + timedelta(days=i) for i in range(1_300)]
    lines = [(i % 2, 900.0 + i % 37, 1.0 + i % 3, day) for i, day in enumerate(days)]
    orders = [(day, 100.0 + i * k % 11) for i, day in enumerate(days) for k in (1, 2, 3)]
    kinds = "l_suppkey long, l_extendedprice double, l_quantity double, l_shipdate date"
    spark.createDataFrame(lines, kinds).write.parquet(f"{tmp_path}/lineitem.parquet")
    kinds = "o_orderdate date, o_totalprice double"
    spark.createDataFrame(orders, kinds).write.parquet(f"{tmp_path}/orders.parquet")
    scratch = tmp_path / "scratch"
    monkeypatch.setattr("volspark.sinks.shared_folder", lambda spark: str(scratch))
    ours = queries()["suppliers_appended_features"](spark, str(tmp_path))
    [store] = scratch.iterdir()
    assert [f.name for f in sorted(store.glob("features/append=*"))] == [
        "append=2", "append=3", "append=4"
    ]
    whole = queries()["suppliers_features_full"](spark, str(tmp_path))
    assert collect(ours, *KEYS) == collect(whole, *KEYS) != []
