import os
import time
from datetime import date, timedelta

import pytest
import run
from conftest import collect
from pyspark.sql import functions as F

from volspark import attach_series, realized_volatility, run_pipeline, schemas
from volspark.learners.boosting import BoostParams
from volspark.operators.backtest import walk_forward
from volspark.operators.features import add_features
from volspark.operators.series import SeriesLayout
from volspark.sinks import (
    DROP_SHUFFLES,
    by_shard,
    clearing_scratch,
    dropping_shuffles,
    materialize,
    shared_folder,
    write_table,
)
from volspark.plans.pipeline import build_processed, store_features, store_reports
from volspark.sources import (
    load_featured,
    read_bars,
    read_implied_vol,
    read_importances,
    read_models,
    read_processed,
    read_results,
    write_processed_csv,
    write_results_csv,
)
from volspark.sources.tables import _read_csv


@pytest.fixture(scope="module")
def processed(bars, implied_vol):
    return attach_series(realized_volatility(bars), implied_vol).cache()


def rows_of(df):
    return collect(df, "symbol", "date")


@pytest.mark.parametrize("fmt", ["parquet", "csv", "orc"])
def test_bars_come_back(spark, bars, tmp_path, fmt):
    path = str(tmp_path / "bars")
    bars.write.format(fmt).option("header", True).save(path)
    assert rows_of(read_bars(spark, path, fmt)) == rows_of(bars)


def test_bars_come_back_from_a_table_in_buckets(spark, bars, tmp_path):
    found = read_bars(spark, write_table(bars, str(tmp_path / "bars")))
    assert found.columns == bars.columns and rows_of(found) == rows_of(bars)


def test_bars_are_filtered_with_an_open_end(spark, bars, tmp_path):
    path = str(tmp_path / "bars")
    bars.write.parquet(path)
    part = read_bars(spark, path, symbols=["AAA"], start="2022-01-10", end="2022-01-20")
    assert [r["date"].day for r in rows_of(part)] == list(range(10, 20))
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "GreaterThanOrEqual(date" in plan


def test_index_is_read_from_bars(spark, bars, tmp_path):
    path = str(tmp_path / "bars")
    bars.withColumn("symbol", F.regexp_replace("symbol", "BBB", "^VIX")).write.parquet(path)
    index = read_implied_vol(spark, path)
    assert index.columns == ["date", "vix"] and index.count() == 150
    both = bars.withColumn("symbol", F.lit("^VIX"))
    both.write.mode("overwrite").parquet(path)
    with pytest.raises(Exception, match="duplicate date"):
        read_implied_vol(spark, path).collect()


def test_processed_comes_back_and_one_symbol_can_be_replaced(spark, processed, tmp_path):
    path = write_table(processed, str(tmp_path / "processed"))
    back = read_processed(spark, path)
    assert back.columns == schemas.PROCESSED.names
    assert rows_of(back) == rows_of(processed.select(*back.columns))
    part = processed.filter("symbol = 'AAA'").limit(10)
    write_table(part, path)
    after = read_processed(spark, path).groupBy("symbol").count().collect()
    counts = {r["symbol"]: r["count"] for r in after}
    assert counts == {"AAA": 10, "BBB": 129, "CCC": 129}


def test_results_are_pruned_to_one_bucket(spark, processed, tmp_path):
    run = walk_forward(add_features(processed), learner="persistence")
    path = write_table(run.predictions, str(tmp_path / "results"))
    one = read_results(spark, path, symbol="BBB")
    assert one.columns == schemas.PREDICTIONS.names and one.count() == 21
    assert "PartitionFilters: [isnotnull(bucket" in one._jdf.queryExecution().toString()


def write_csv(folder, name, header, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as out:
        out.write("\n".join([*header, *lines]) + "\n")


HEADER = [
    "Price,Close,High,Low,Open,Volume,log_return,realized_vol,vix",
    "Ticker,SPY,SPY,SPY,SPY,,,,",
    "Date,,,,,,,,",
]


def csv_lines(processed, symbol):
    names = schemas.PROCESSED_CSV.names
    rows = collect(processed.filter(F.col("symbol") == symbol), "date")
    return [",".join(str(r[n]) for n in names) for r in rows]


def test_csv_files_of_symbols(spark, processed, tmp_path):
    folder = str(tmp_path / "data")
    for symbol in ("AAA", "BBB", "CCC"):
        write_csv(folder, f"{symbol}_processed.csv", HEADER, csv_lines(processed, symbol))
    write_csv(folder, "AAA_backtest_results.csv", [",actual,predicted"], ["2022-05-01,0.1,0.2"])
    back = read_processed(spark, folder, "csv")
    assert rows_of(back) == rows_of(processed.select(*back.columns))
    assert load_featured(spark, folder, "csv", "AAA").count() == 62
    (result,) = read_results(spark, folder, "csv").collect()
    assert tuple(result) == ("AAA", date(2022, 5, 1), 0.1, 0.2)


@pytest.mark.parametrize("lines", [0, 1, 2])
def test_other_headers_are_refused(spark, processed, tmp_path, lines):
    folder = str(tmp_path / "data")
    write_csv(folder, "AAA_processed.csv", HEADER[:lines], csv_lines(processed, "AAA"))
    with pytest.raises(Exception, match=f"AAA_processed.csv: {lines}"):
        read_processed(spark, folder, "csv").collect()
    given = _read_csv(spark, folder, schemas.PROCESSED_CSV, "_processed.csv", lines, None)
    assert given.count() == 129


def test_broken_dates_do_not_pass_as_headers(spark, processed, tmp_path):
    folder = str(tmp_path / "data")
    lines = csv_lines(processed, "AAA")
    lines[5] = "not a date" + lines[5][10:]
    write_csv(folder, "AAA_processed.csv", HEADER, lines)
    with pytest.raises(Exception, match="found AAA_processed.csv: 4"):
        read_processed(spark, folder, "csv").collect()


def test_scratch_tables_lie_in_the_named_folder(spark, bars):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == named
    stored = materialize(bars, "bars")
    assert all(named in f for f in stored.inputFiles())
    assert rows_of(stored) == rows_of(bars)


def test_pipeline_writes_every_table(spark, bars, implied_vol, tmp_path):
    out = str(tmp_path / "run")
    paths = run_pipeline(
        spark, bars, implied_vol, out, symbols=["AAA", "CCC"], params=BoostParams(trees=3)
    )
    assert set(paths) == {
        "processed", "features", "models", "holdout_metrics", "results", "backtest_models",
        "metrics", "report_metrics", "report_series", "report_regimes", "report_residuals",
        "report_scatter", "report_scatter_bounds", "report_date_bounds", "report_symbols",
        "report_importances",
    }
    counts = {name: spark.read.parquet(path).count() for name, path in paths.items()}
    assert counts["processed"] == 2 * 129 and counts["features"] == 2 * 62
    assert counts["results"] == counts["report_series"] == 2 * 21
    assert counts["models"] == 2 and counts["report_importances"] == 2 * 16
    assert {r.symbol for r in read_models(spark, paths["models"]).collect()} == {"AAA", "CCC"}
    assert read_importances(spark, paths["models"], "CCC").count() == 16


def series(spark, names):
    rows = [(s, date(2024, 1, 1) + timedelta(days=d), float(d)) for s in names for d in range(3)]
    return spark.createDataFrame(rows, "symbol string, date date, value double")


def symbols_at(spark, path):
    found = spark.read.parquet(path).groupBy("symbol").count().collect()
    return {r["symbol"]: r["count"] for r in found}


@pytest.mark.parametrize("many", [1, 64, 65, 200])
def test_other_symbols_stay_however_many(spark, tmp_path, many):
    few, lots = ["X", "Y"], [f"S{i}" for i in range(many)]
    for i, order in enumerate(((few, lots, few), (lots, few, lots))):
        path = str(tmp_path / f"table{i}")
        for names in order:
            write_table(series(spark, names), path)
        assert symbols_at(spark, path) == dict.fromkeys([*few, *lots], 3)


def test_rows_of_a_symbol_are_replaced_even_by_none(spark, tmp_path):
    path = str(tmp_path / "table")
    write_table(series(spark, ["A", "B"]), path)
    both = spark.createDataFrame([("A",), ("C",)], "symbol string")
    write_table(series(spark, ["C"]).limit(1), path, both)
    assert symbols_at(spark, path) == {"B": 3, "C": 1}
    write_table(series(spark, ["B"]).limit(0), path)
    assert symbols_at(spark, path) == {"B": 3, "C": 1}
    none = write_table(series(spark, ["B"]).limit(0), str(tmp_path / "none"))
    assert spark.read.parquet(none).columns == ["symbol", "date", "value", "bucket"]
    assert symbols_at(spark, none) == {}


def test_exchange_files_come_back(spark, processed, tmp_path):
    folder = write_processed_csv(processed, str(tmp_path / "data"))
    assert sorted(os.listdir(folder))[-1].endswith("CCC_processed.csv")
    with open(f"{folder}/AAA_processed.csv") as file:
        assert file.read().splitlines()[:3] == [HEADER[0], "Ticker,AAA,,,,,,,", HEADER[2]]
    names = schemas.PROCESSED.names
    assert rows_of(read_processed(spark, folder, "csv")) == rows_of(processed.select(*names))
    one = read_processed(spark, folder, "csv", "BBB")
    assert one.count() == 129 and len(one.inputFiles()) == 1
    run = walk_forward(add_features(processed), learner="persistence").predictions
    folder = write_results_csv(run, str(tmp_path / "results"))
    kept = run.select("symbol", "date", "actual", "predicted")
    assert rows_of(read_results(spark, folder, "csv")) == rows_of(kept)


def test_a_date_twice_in_the_index_fails(spark, bars, implied_vol, tmp_path):
    twice = implied_vol.union(implied_vol.limit(1))
    with pytest.raises(Exception, match="duplicate date in side series"):
        attach_series(realized_volatility(bars), twice).collect()
    with pytest.raises(Exception, match="duplicate date in side series"):
        run_pipeline(spark, bars, twice, str(tmp_path / "run"), learner="persistence")


def test_reports_keep_to_their_options(spark, bars, implied_vol, tmp_path):
    out = str(tmp_path / "run")
    run_pipeline(spark, bars, implied_vol, out, learner="persistence")
    last = spark.read.parquet(f"{out}/results").filter("symbol = 'AAA'")
    start = sorted(r.date for r in last.collect())[10]
    one = spark.createDataFrame([("AAA",)], "symbol string")
    paths = store_reports(spark, f"{out}", False, symbols=one, symbol="AAA", start=str(start))
    for name in ("series", "residuals"):
        rows = spark.read.parquet(paths[f"report_{name}"])
        assert rows.filter("symbol = 'AAA'").agg(F.min("date")).first()[0] == start
        assert rows.filter("symbol = 'BBB'").count() == 21


def test_a_second_run_for_another_symbol_leaves_the_first(spark, bars, implied_vol, tmp_path):
    out = str(tmp_path / "run")
    for symbol in ("AAA", "BBB"):
        paths = run_pipeline(
            spark, bars, implied_vol, out, symbols=[symbol], learner="persistence"
        )
    for name in paths:
        assert set(symbols_at(spark, paths[name])) == {"AAA", "BBB"}, name
    before = rows_of(read_results(spark, paths["results"], symbol="AAA"))
    run_pipeline(spark, bars.filter("symbol = 'CCC'"), implied_vol, out, learner="persistence")
    assert set(symbols_at(spark, paths["report_regimes"])) <= {"AAA", "BBB", "CCC"}
    assert rows_of(read_results(spark, paths["results"], symbol="AAA")) == before


def test_runs_leave_no_scratch_tables(spark, bars, implied_vol, tmp_path):
    own = shared_folder(spark)
    before = set(os.listdir(own)) if os.path.isdir(own) else set()
    params = BoostParams(trees=2, depth=2)
    run_pipeline(spark, bars, implied_vol, str(tmp_path / "one"), params=params)
    run_pipeline(
        spark, bars, implied_vol, str(tmp_path / "two"), layout=SeriesLayout(70),
        learner="persistence",
    )
    with pytest.raises(Exception, match="duplicate date"):
        run_pipeline(spark, bars, implied_vol.union(implied_vol), str(tmp_path / "three"))
    assert set(os.listdir(own)) == before


def test_scratch_is_cleared_inside_out(spark, tmp_path):
    rows = spark.range(3)
    with clearing_scratch(spark):
        kept = materialize(rows, "outer")
        with clearing_scratch(spark):
            gone = materialize(rows, "inner").inputFiles()[0]
        assert kept.count() == 3 and not os.path.exists(gone.removeprefix("file://"))
        outer = kept.inputFiles()[0]
    assert not os.path.exists(outer.removeprefix("file://"))


def test_pipeline_keeps_to_the_period(spark, bars, implied_vol, tmp_path):
    end = str(date(2022, 1, 3) + timedelta(days=140))
    paths = run_pipeline(
        spark, bars, implied_vol, str(tmp_path / "run"), start="2022-01-03", end=end,
        learner="persistence",
    )
    last = spark.read.parquet(paths["processed"]).agg(F.max("date")).first()[0]
    assert str(last + timedelta(days=1)) == end
    assert "models" not in paths


def test_job_runs_from_a_table_of_bars(spark, bars, implied_vol, tmp_path, capsys):
    index = implied_vol.select(
        F.lit("^VIX").alias("symbol"),
        "date",
        *[F.col("vix").alias(c) for c in ("open", "high", "low", "close")],
        F.lit(0).cast("long").alias("volume"),
    )
    path, out = str(tmp_path / "bars"), str(tmp_path / "run")
    bars.unionByName(index).write.partitionBy("symbol").parquet(path)
    common = ["--bars", path, "--learner", "train_mean"]
    paths = run.main([*common, "--out", out, "--all-symbols"], spark)
    assert spark.read.parquet(paths["metrics"]).count() == 3
    assert "directional_accuracy" in capsys.readouterr().out
    paths = run.main([*common, "--out", out + "2", "--symbols", "BBB"], spark)
    assert [r.symbol for r in spark.read.parquet(paths["metrics"]).collect()] == ["BBB"]


def test_features_are_stored_by_the_shuffle_of_their_windows(spark, processed, tmp_path, monkeypatch):
    """Few files, one folder a symbol, and no second shuffle of the wide rows."""

    def rebalanced(*_, **__):
        raise AssertionError("shuffled again")

    with monkeypatch.context() as patch:
        patch.setattr(type(processed), "hint", rebalanced)
        stored = store_features(processed, str(tmp_path))
    assert stored.columns == add_features(processed).columns
    assert rows_of(stored) == rows_of(add_features(processed))
    files = [f for f in (tmp_path / "features").rglob("bucket=[0-9]*/*.parquet")]
    assert len(files) == len({f.parent for f in files}) <= 3
    # long series are cut into chunks, whatever their shard
    cut = store_features(processed, str(tmp_path / "cut"), layout=SeriesLayout(80))
    assert rows_of(cut) == rows_of(stored)


def test_replaced_buckets_are_written_once(spark, tmp_path, monkeypatch):
    """Rows go to their folders straight, not by way of scratch tables."""
    path = str(tmp_path / "t")
    rows = [(f"S{i % 40}", date(2024, 1, 1) + timedelta(days=i), float(i)) for i in range(400)]
    table = spark.createDataFrame(rows, "symbol string, date date, x double")
    write_table(table, path)
    stored = []

    def watched(df, name, by=()):
        stored.append(name)
        return materialize(df, name, by)

    monkeypatch.setattr("volspark.sinks.materialize", watched)
    own = table.select("symbol").distinct().filter("symbol < 'S2'")
    new = table.filter("symbol < 'S2' AND symbol != 'S11'").withColumn("x", -F.col("x"))
    write_table(new, path, own)
    assert stored == ["new-symbols"]
    ours = rows_of(spark.read.parquet(path).select(*table.columns))
    signs = {s: -1 if s < "S2" else 1 for s, _, _ in rows}
    assert [tuple(r.values()) for r in ours] == sorted(
        (s, day, signs[s] * x) for s, day, x in rows if s != "S11"
    )
    assert not list((tmp_path / "t").glob("_new*"))


def test_files_of_other_symbols_are_not_written_again(spark, tmp_path, monkeypatch):
    """Runs for some symbols, the others, some again: a file stays until one of its own is replaced."""
    path = str(tmp_path / "t")
    rows = [(f"S{i % 40}", date(2024, 1, 1) + timedelta(days=i), float(i)) for i in range(400)]
    table = spark.createDataFrame(rows, "symbol string, date date, x double")
    odd = F.substring("symbol", -1, 1).cast("int") % 2 == 1

    def write(new):
        write_table(new, path, new.select("symbol").distinct())
        return {f for f in (tmp_path / "t").rglob("bucket=[0-9]*/*.parquet")}

    first = write(table.filter(odd))
    second = write(table.filter(~odd))
    assert first < second
    third = write(table.filter(odd).withColumn("x", -F.col("x")))
    assert third & second == second - first and len(third) == len(second)
    # a file that also holds a symbol that stays is written again without the replaced one
    shared = write(by_shard(table.withColumn("x", F.col("x") * 2)))
    assert not shared & third
    write(table.filter("symbol = 'S3'"))

    def stored():
        return [tuple(r.values()) for r in rows_of(spark.read.parquet(path).select(*table.columns))]

    now = sorted((s, day, x if s == "S3" else 2 * x) for s, day, x in rows)
    assert stored() == now
    # buckets of too many files become few files
    write(table.filter("symbol = 'S3'"))
    monkeypatch.setattr("volspark.sinks.FILES_A_SHARD", 0)
    [mine] = {f.parent for f in write(table.filter("symbol = 'S3'")) if "S3" in set(
        spark.read.parquet(str(f)).toPandas()["symbol"])}
    assert len(list(mine.glob("*.parquet"))) == 1 and stored() == now
    assert not list((tmp_path / "t").glob("_new*"))


def test_a_run_shuffles_its_bars_once_for_the_processed_table(
    spark, bars, implied_vol, tmp_path, monkeypatch
):
    """Windows and folders share a shuffle, row by row tables of the results need none."""
    plans, lies = {}, {}

    def watched(df, path, *args, **options):
        name = path.rpartition("/")[2]
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        lies[name] = options.get("as_they_lie", False)
        return write_table(df, path, *args, **options)

    monkeypatch.setattr("volspark.plans.pipeline.write_table", watched)
    paths = run_pipeline(spark, bars, implied_vol, str(tmp_path), learner="persistence")
    assert plans["processed"].count("hashpartitioning(shard_#") == 1
    assert "hashpartitioning(symbol#" not in plans["processed"]
    for name in ("series", "residuals", "scatter"):
        assert lies[name] and "hashpartitioning" not in plans[name]
        files = list((tmp_path / "reports" / name).rglob("bucket=[0-9]*/*.parquet"))
        results = list((tmp_path / "results").rglob("bucket=[0-9]*/*.parquet"))
        assert 0 < len(files) <= len(results)
    assert rows_of(spark.read.parquet(paths["processed"]).drop("bucket")) == rows_of(
        build_processed(bars, implied_vol)
    )


def test_shuffle_files_go_with_the_action_that_made_them(
    spark, bars, implied_vol, tmp_path, monkeypatch
):
    found = []

    def watched(df, path, *args, **options):
        found.append(spark.conf.get(DROP_SHUFFLES))
        return write_table(df, path, *args, **options)

    monkeypatch.setattr("volspark.plans.pipeline.write_table", watched)

    def shuffles():
        disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return sum(1 for f in disk.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f)

    setting = spark.conf.get(DROP_SHUFFLES)
    before = shuffles()
    run_pipeline(spark, bars, implied_vol, str(tmp_path), learner="persistence")
    assert set(found) == {"true"}
    until = time.time() + 20
    while shuffles() > before and time.time() < until:
        time.sleep(0.5)
    assert shuffles() <= before
    assert spark.conf.get(DROP_SHUFFLES) == setting
    with pytest.raises(RuntimeError), dropping_shuffles(spark), dropping_shuffles(spark):
        raise RuntimeError
    assert spark.conf.get(DROP_SHUFFLES) == setting
