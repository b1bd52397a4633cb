import sys
from datetime import date, timedelta
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from volspark import schemas  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("volspark-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def walk(symbol: str, rows: int, seed: int, first: date = date(2022, 1, 3)) -> pd.DataFrame:
    """Prices that swing around a slow wave, calm and rough in turn, on consecutive days."""
    rng = np.random.default_rng(1_000 + seed)
    day = np.arange(rows)
    noise = np.zeros(rows)
    for i in range(1, rows):
        noise[i] = 0.9 * noise[i - 1] + rng.uniform(-1, 1) * (0.02 if i // 40 % 2 else 0.008)
    close = 75 + 12 * np.sin(day / 23) + 60 * noise
    spread = rng.uniform(0.1, 0.9, (3, rows))
    return pd.DataFrame(
        {
            "symbol": symbol,
            "date": [first + timedelta(days=i) for i in range(rows)],
            "open": close + spread[2] - spread[1],
            "high": close + spread[0] + spread[2],
            "low": close - spread[1],
            "close": close,
            "volume": rng.poisson(9_000, rows) * 100,
        }
    )


def frame(spark, pdf: pd.DataFrame, schema):
    """The rows as a table, with NaN as NULL and dates as dates."""
    clean = pdf.astype(object).where(pdf.notna(), None)
    return spark.createDataFrame([tuple(r) for r in clean.itertuples(index=False)], schema)


@pytest.fixture(scope="session")
def price_rows():
    """Three series of 150 rows, in no particular order."""
    panel = pd.concat([walk("AAA", 150, 1), walk("BBB", 150, 2), walk("CCC", 150, 3)])
    return panel.sample(frac=1, random_state=1).reset_index(drop=True)


@pytest.fixture(scope="session")
def bars(spark, price_rows):
    return frame(spark, price_rows, schemas.BARS).cache()


@pytest.fixture(scope="session")
def implied_vol(spark):
    rng = np.random.default_rng(5)
    days = [date(2022, 1, 3) + timedelta(days=i) for i in range(150)]
    rows = [(day, float(v)) for day, v in zip(days, 18 + rng.normal(0, 2, 150))]
    return spark.createDataFrame(rows, schemas.IMPLIED_VOL).cache()


def collect(df, *keys):
    """Rows as dicts, sorted by ``keys``."""
    return [r.asDict() for r in df.orderBy(*keys).collect()]
