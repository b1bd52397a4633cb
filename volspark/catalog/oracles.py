"""The same results as plain SQL, each from the raw test tables."""

from __future__ import annotations

import re

from dataclasses import dataclass

from volspark.catalog.queries import CUT, HIGH, LABELS, LOW, RANGE, RANGE_CUT
from volspark.schemas import feature_columns

# The SQL states its own numbers: a changed default in the library must show as a difference.
PRIME = 2_147_483_647
ROW_FACTOR, TREE_FACTOR, SEED_FACTOR, TREE_SHIFT = 48_271, 1_566_083_941, 69_621, 630_360_016


@dataclass(frozen=True)
class Fit:
    """Settings of the trees in SQL: those of the study."""

    trees: int = 100
    depth: int = 3
    learning_rate: float = 0.05
    subsample: float = 0.8
    seed: int = 42
    reg_lambda: float = 1.0
    min_child_rows: int = 1
    min_gain: float = 1e-6
    max_bins: int = 256


SMALL_FIT = Fit(trees=3, depth=2)

FEATURES = feature_columns()
NO_INDEX = feature_columns(with_vix=False)
INPUTS = ["symbol", "date", "open", "high", "low", "close", "volume", "log_return", "realized_vol"]
START, END = RANGE
T0 = "CAST(FLOOR(n * 0.6e0) AS BIGINT)"
SPLIT = "CAST(FLOOR(n * CAST(0.8 AS DOUBLE)) AS BIGINT)"


def r(name: str, alias: str | None = None, digits: int = 6) -> str:
    return f"FLOOR(({name}) * 1e{digits} + {CUT}e0) / 1e{digits} AS {alias or name}"


def rs(names: list[str], digits: int = 6) -> str:
    keep = {"symbol", "date", "volume", "row_idx", "n", "fold_id", "refit_id", "side"}
    return ", ".join(n if n in keep else r(n, digits=digits) for n in names)


def present(names: list[str]) -> str:
    return " AND ".join(f"{n} IS NOT NULL" for n in names)


def rolling(agg: str, name: str, rows: int) -> str:
    frame = f"ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW"
    over = f"OVER (PARTITION BY symbol ORDER BY date {frame})"
    return f"CASE WHEN COUNT({name}) {over} = {rows} THEN {agg}({name}) {over} END"


def moved(kind: str, name: str, rows: int) -> str:
    return f"{kind}({name}, {rows}) OVER (PARTITION BY symbol ORDER BY date)"


def base(symbol: str) -> list[tuple[str, str]]:
    """CTEs from the raw tables up to predictions and their metrics, in order."""
    lags = [(f"vol_lag_{k}", moved("LAG", "realized_vol", k)) for k in (1, 5, 10, 21)]
    plain = [
        *lags,
        ("vol_of_vol_5", rolling("STDDEV_SAMP", "realized_vol", 5)),
        ("vol_of_vol_21", rolling("STDDEV_SAMP", "realized_vol", 21)),
        ("mean_return_5", rolling("AVG", "log_return", 5)),
        ("mean_return_21", rolling("AVG", "log_return", 21)),
        ("vol_5d", f"({rolling('STDDEV_SAMP', 'log_return', 5)}) * SQRT(252)"),
        ("vol_63d", f"({rolling('STDDEV_SAMP', 'log_return', 63)}) * SQRT(252)"),
        ("abs_return", "ABS(log_return)"),
        ("target_vol", moved("LEAD", "realized_vol", 5)),
    ]
    vix = [
        ("vix_normalized", "vix / 100"),
        ("vol_risk_premium", "vix / 100 - realized_vol"),
        ("vix_lag_1", moved("LAG", "vix / 100", 1)),
        ("vix_rolling_5", rolling("AVG", "vix / 100", 5)),
    ]

    def listed(pairs):
        return ", ".join(f"{sql} AS {name}" for name, sql in pairs)

    ratio = "vol_5d / NULLIF(vol_63d, 0) AS vol_ratio"
    return [
        (
            "daily",
            f"""SELECT CAST({symbol} AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS date,
                MAX(p) AS high, MIN(p) AS low, SUM(p * l_quantity) / SUM(l_quantity) AS close,
                CAST(SUM(l_quantity) AS BIGINT) AS volume
                FROM (SELECT *, l_extendedprice / l_quantity AS p FROM lineitem) t GROUP BY 1, 2""",
        ),
        (
            "bars",
            """SELECT symbol, date,
               COALESCE(LAG(close) OVER (PARTITION BY symbol ORDER BY date), close) AS open,
               high, low, close, volume FROM daily""",
        ),
        (
            "implied",
            """SELECT CAST(o_orderdate AS DATE) AS date,
               100 * STDDEV_SAMP(o_totalprice) / AVG(o_totalprice) AS vix
               FROM orders GROUP BY 1 HAVING COUNT(*) > 1""",
        ),
        (
            "returns",
            """SELECT *, LN(close / LAG(close) OVER (PARTITION BY symbol ORDER BY date))
               AS log_return FROM bars""",
        ),
        (
            "vol_wide",
            f"""SELECT *, ({rolling('STDDEV_SAMP', 'log_return', 21)}) * SQRT(252)
                AS realized_vol FROM returns""",
        ),
        ("vol", "SELECT * FROM vol_wide WHERE log_return IS NOT NULL AND realized_vol IS NOT NULL"),
        ("processed", "SELECT vol.*, implied.vix FROM vol JOIN implied ON vol.date = implied.date"),
        ("wide", f"SELECT *, {listed(plain + vix)} FROM processed"),
        ("wide_ratio", f"SELECT *, {ratio} FROM wide"),
        ("features", f"SELECT * FROM wide_ratio WHERE {present([*FEATURES, 'target_vol'])}"),
        ("bare", f"SELECT *, {listed(plain)} FROM vol"),
        ("bare_ratio", f"SELECT *, {ratio} FROM bare"),
        (
            "bare_positioned",
            f"""SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY date) - 1 AS row_idx,
                COUNT(*) OVER (PARTITION BY symbol) AS n FROM bare_ratio
                WHERE {present([*NO_INDEX, 'target_vol'])}""",
        ),
        (
            "positioned",
            """SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY date) - 1 AS row_idx,
               COUNT(*) OVER (PARTITION BY symbol) AS n FROM features""",
        ),
        (
            "plan",
            f"""SELECT symbol, n, {T0} AS t0,
                CAST(GREATEST(0, CEIL((n - 21 - {T0}) / CAST(21 AS DOUBLE))) AS BIGINT) AS folds
                FROM (SELECT symbol, COUNT(*) AS n FROM features GROUP BY symbol) c""",
        ),
        (
            "folds",
            """SELECT symbol, CAST(k AS INTEGER) AS fold_id,
               CAST(FLOOR(k / CAST(3 AS DOUBLE)) AS INTEGER) AS refit_id,
               t0 + CAST(FLOOR(k / CAST(3 AS DOUBLE)) AS BIGINT) * 63 AS train_cut,
               t0 + k * 21 AS score_from, t0 + k * 21 + 21 AS score_to
               FROM (SELECT symbol, t0, UNNEST(RANGE(0, folds)) AS k FROM plan) f""",
        ),
        (
            "refits",
            """SELECT symbol, refit_id, train_cut, MIN(score_from) AS score_from,
               MAX(score_to) AS score_to, COUNT(*) AS folds
               FROM folds GROUP BY symbol, refit_id, train_cut""",
        ),
        (
            "scored",
            """SELECT p.*, f.fold_id, f.refit_id, f.train_cut FROM positioned p JOIN folds f
               ON p.symbol = f.symbol AND p.row_idx >= f.score_from AND p.row_idx < f.score_to""",
        ),
        (
            "persistence",
            """SELECT symbol, date, row_idx, fold_id, refit_id, target_vol AS actual,
               realized_vol AS predicted FROM scored""",
        ),
        (
            "means",
            """SELECT f.symbol, f.refit_id, AVG(p.target_vol) AS mean FROM refits f
               JOIN positioned p ON p.symbol = f.symbol AND p.row_idx < f.train_cut
               GROUP BY f.symbol, f.refit_id""",
        ),
        (
            "train_mean",
            """SELECT s.symbol, date, row_idx, fold_id, s.refit_id, target_vol AS actual,
               mean AS predicted FROM scored s JOIN means m
               ON s.symbol = m.symbol AND s.refit_id = m.refit_id""",
        ),
        (
            "refit_rows",
            f"""SELECT p.symbol || '|' || CAST(f.refit_id AS VARCHAR) AS symbol, date, row_idx,
                f.train_cut, target_vol, {', '.join(FEATURES)}
                FROM refits f JOIN positioned p
                ON p.symbol = f.symbol AND p.row_idx < f.score_to""",
        ),
        (
            "held_out",
            f"""SELECT symbol, date, target_vol AS actual, realized_vol AS predicted
                FROM positioned WHERE row_idx >= {SPLIT}""",
        ),
    ]


def metrics(source: str, where: str = "TRUE") -> str:
    over = "OVER (PARTITION BY symbol ORDER BY date)"
    return f"""SELECT symbol, COUNT(*) AS n, AVG(ABS(actual - predicted)) AS mae,
        SQRT(AVG((actual - predicted) * (actual - predicted))) AS rmse,
        AVG(CASE WHEN sa = sp THEN 1e0 WHEN sa <> sp THEN 0e0 END) AS directional_accuracy,
        COVAR_POP(actual, predicted) / NULLIF(STDDEV_POP(actual) * STDDEV_POP(predicted), 0)
        AS correlation
        FROM (SELECT *, SIGN(actual - LAG(actual) {over}) AS sa,
              SIGN(predicted - LAG(predicted) {over}) AS sp FROM {source} WHERE {where}) d
        GROUP BY symbol"""


def regimes(where: str = "TRUE") -> str:
    """Runs by counting changes, the first row after each run, and the last date."""

    def one(name: str, test: str) -> str:
        return f"""SELECT symbol, '{name}' AS regime, MIN(date) AS start_date,
            COALESCE(ARG_MAX(after, date), MAX(last_date)) AS end_date, COUNT(*) AS n_rows
            FROM (SELECT *, SUM(CASE WHEN inside THEN 0 ELSE 1 END)
                  OVER (PARTITION BY symbol ORDER BY date) AS run FROM (
                    SELECT symbol, date, actual {test} AS inside,
                    COALESCE(LEAD(date) OVER (PARTITION BY symbol ORDER BY date),
                             MAX(date) OVER (PARTITION BY symbol)) AS after,
                    MAX(date) OVER (PARTITION BY symbol) AS last_date
                    FROM persistence WHERE {where}) a) b
            WHERE inside GROUP BY symbol, run"""

    return f"{one('high', f'> {HIGH}e0')} UNION ALL {one('low', f'< {LOW}e0')}"


def adjusted() -> str:
    """Every bar next to all later actions, multiplied up."""
    rounds = ", ".join(r(f"{c} * price", c) for c in ("open", "high", "low", "close"))
    return f"""SELECT b.symbol, b.date, {rounds}, CAST(ROUND(volume * share) AS BIGINT) AS volume
        FROM (SELECT b.*, COALESCE(PRODUCT(a.price), 1) AS price,
                     COALESCE(PRODUCT(a.split), 1) AS share
              FROM bars b LEFT JOIN a_factors a ON a.symbol = b.symbol AND a.date > b.date
              GROUP BY ALL) b"""


ACTIONS = [
    (
        "a_made",
        """SELECT symbol, MIN(date) AS date, NULL::DOUBLE AS split,
           0.125e0 * (1 + ARG_MIN(volume, date) % 5) AS dividend
           FROM bars GROUP BY symbol, date_trunc('quarter', date)
           UNION ALL SELECT symbol, MIN(date), CASE YEAR(MIN(date)) WHEN 1995 THEN 2e0 ELSE 0.25e0 END,
           NULL FROM bars WHERE YEAR(date) IN (1995, 1999) GROUP BY symbol, YEAR(date)""",
    ),
    (
        "a_dated",
        """SELECT symbol, date, COALESCE(PRODUCT(split), 1) AS split,
           COALESCE(SUM(dividend), 0) AS dividend FROM a_made GROUP BY 1, 2""",
    ),
    (
        "a_factors",
        """SELECT a.symbol, a.date, a.split,
           COALESCE(1 - a.dividend * a.split / ARG_MAX(b.close, b.date), 1) / a.split AS price
           FROM a_dated a LEFT JOIN bars b ON b.symbol = a.symbol AND b.date < a.date
           GROUP BY a.symbol, a.date, a.split, a.dividend""",
    ),
]

METRIC_NAMES = "mae rmse directional_accuracy correlation".split()
IN_RANGE = f"date >= DATE '{START}' AND date <= DATE '{END}'"
IN_CUT = f"date >= DATE '{RANGE_CUT[0]}' AND date <= DATE '{RANGE_CUT[1]}'"
PREDICTION = ["symbol", "date", "row_idx", "fold_id", "refit_id", "actual", "predicted"]


def finals() -> dict[str, str]:
    """The last SELECT of each query, over the CTEs of ``base``."""
    keys = "symbol, date"
    all_metrics = f"symbol, n, {rs(METRIC_NAMES)}"
    featured = f"{rs([*INPUTS, 'vix', *FEATURES, 'target_vol'])}"
    matrix = f"SELECT {keys}, {rs([*FEATURES, 'target_vol'])} FROM features"
    run_metrics = f"SELECT {all_metrics} FROM ({metrics('persistence')}) m"
    return {
        "bars": f"SELECT {rs(INPUTS[:7])} FROM bars",
        "implied_vol": f"SELECT date, {r('vix')} FROM implied",
        "read_bars": f"""SELECT {rs(INPUTS[:7])} FROM bars WHERE symbol IN ('A', 'R')
            AND date >= DATE '{START}' AND date < DATE '{END}'""",
        "read_implied_vol": f"SELECT date, {r('vix')} FROM implied",
        "processed_table": f"SELECT {rs([*INPUTS, 'vix'])} FROM processed WHERE symbol = 'N'",
        "load_featured": matrix,
        "results_table": f"SELECT {rs(PREDICTION)} FROM persistence WHERE symbol = 'A'",
        "log_returns": f"SELECT {rs(['symbol', 'date', 'close', 'log_return'])} FROM returns",
        "realized_vol": f"SELECT {keys}, {rs(['log_return', 'realized_vol'])} FROM vol",
        "vol_summary": f"""SELECT symbol, COUNT(*) AS n, {r('AVG(realized_vol)', 'mean_vol')},
            {r('MIN(realized_vol)', 'min_vol')}, {r('MAX(realized_vol)', 'max_vol')}
            FROM vol GROUP BY symbol""",
        "attach_index": f"SELECT {keys}, {rs(['realized_vol', 'vix'])} FROM processed",
        "drop_incomplete": f"""SELECT {rs(INPUTS[:7])}, {r('vix')}
            FROM bars JOIN implied USING (date)""",
        "vol_lags": f"SELECT {keys}, {rs(FEATURES[0:4])} FROM wide_ratio",
        "vol_of_vol": f"SELECT {keys}, {rs(FEATURES[4:6])} FROM wide_ratio",
        "mean_returns": f"SELECT {keys}, {rs(FEATURES[6:8])} FROM wide_ratio",
        "vol_5_63_ratio": f"SELECT {keys}, {rs(FEATURES[8:11])} FROM wide_ratio",
        "abs_return": f"SELECT {keys}, {rs(FEATURES[11:12])} FROM wide_ratio",
        "vix_features": f"SELECT {keys}, {rs(FEATURES[12:16])} FROM wide_ratio",
        "target_vol": f"SELECT {keys}, {r('target_vol')} FROM wide_ratio",
        "features_full": f"SELECT {featured} FROM features",
        "features_without_index": f"""SELECT {rs([*INPUTS, *NO_INDEX, 'target_vol'])}
            FROM bare_ratio WHERE {present([*NO_INDEX, 'target_vol'])}""",
        "feature_warmup_counts": """SELECT b.symbol, n_bars, n_vol, n_processed, n_features
            FROM (SELECT symbol, COUNT(*) AS n_bars FROM bars GROUP BY 1) b
            JOIN (SELECT symbol, COUNT(*) AS n_vol FROM vol GROUP BY 1) v USING (symbol)
            JOIN (SELECT symbol, COUNT(*) AS n_processed FROM processed GROUP BY 1) p USING (symbol)
            JOIN (SELECT symbol, COUNT(*) AS n_features FROM features GROUP BY 1) f USING (symbol)
            """,
        "model_matrix": matrix,
        "last_rows": f"""SELECT {rs(['symbol', 'date', 'close', 'realized_vol', 'vix'])}
            FROM positioned WHERE row_idx >= n - 3""",
        "position_slice": f"""SELECT {rs(['symbol', 'date', 'row_idx', 'target_vol'])}
            FROM positioned WHERE row_idx BETWEEN 10 AND 39""",
        "chronological_split": f"""SELECT {rs(['symbol', 'date', 'row_idx', 'n', 'target_vol'])},
            CASE WHEN row_idx < {SPLIT} THEN 'train' ELSE 'test' END AS split FROM positioned""",
        "split_bounds": f"""SELECT symbol,
            CASE WHEN row_idx < {SPLIT} THEN 'train' ELSE 'test' END AS split,
            COUNT(*) AS n_rows, MIN(date) AS first_date, MAX(date) AS last_date
            FROM positioned GROUP BY 1, 2""",
        "fold_plan": "SELECT * FROM folds",
        "refit_plan": "SELECT * FROM refits",
        "scored_rows": f"SELECT {rs([*PREDICTION[:5], 'target_vol'])} FROM scored",
        "training_sets": """SELECT f.symbol, f.refit_id, COUNT(*) AS n_train,
            MAX(date) AS last_train_date FROM refits f JOIN positioned p
            ON p.symbol = f.symbol AND p.row_idx < f.train_cut GROUP BY 1, 2""",
        "walk_forward_persistence": f"SELECT {rs(PREDICTION)} FROM persistence",
        "walk_forward_train_mean": f"SELECT {rs(PREDICTION)} FROM train_mean",
        "holdout_metrics_persistence": f"""SELECT symbol, n, {rs(METRIC_NAMES[:3])}
            FROM ({metrics('held_out')}) m""",
        "backtest_metrics": run_metrics,
        "backtest_metrics_train_mean": f"SELECT {all_metrics} FROM ({metrics('train_mean')}) m",
        "backtest_metrics_in_range": f"""SELECT {all_metrics}
            FROM ({metrics('persistence', IN_RANGE)}) m""",
        "backtest_period": """SELECT symbol, MIN(date) AS first_date, MAX(date) AS last_date,
            COUNT(*) AS n_predictions FROM persistence GROUP BY symbol""",
        "directional_accuracy": f"""SELECT symbol, {r('directional_accuracy')}
            FROM ({metrics('persistence')}) m""",
        "correlation": f"SELECT symbol, {r('correlation')} FROM ({metrics('persistence')}) m",
        "step_directions": """SELECT symbol, actual_sign, predicted_sign, COUNT(*) AS n FROM (
            SELECT symbol,
            CAST(SIGN(actual - LAG(actual) OVER w) AS INTEGER) AS actual_sign,
            CAST(SIGN(predicted - LAG(predicted) OVER w) AS INTEGER) AS predicted_sign
            FROM persistence WINDOW w AS (PARTITION BY symbol ORDER BY date)) d
            WHERE actual_sign IS NOT NULL GROUP BY 1, 2, 3""",
        "metrics_text": f"""SELECT symbol, printf('%.4f', mae) AS mae,
            printf('%.4f', rmse) AS rmse, printf('%.4f', correlation) AS correlation,
            printf('%.2f%%', directional_accuracy * 100) AS directional_accuracy
            FROM ({metrics('persistence')}) m""",
        "date_range_filter": f"SELECT {rs(PREDICTION)} FROM persistence WHERE {IN_RANGE}",
        "actual_vs_predicted": f"""SELECT {keys}, {rs(['actual', 'predicted'])}
            FROM persistence WHERE {IN_RANGE}""",
        "regime_intervals": regimes(),
        "regime_intervals_in_range": regimes(IN_RANGE),
        "backtest_metrics_from_states": run_metrics,
        "metrics_in_range_from_states": f"""SELECT {all_metrics}
            FROM ({metrics('persistence', IN_CUT)}) m""",
        "regimes_from_parts": regimes(),
        "regimes_in_range_from_parts": regimes(IN_CUT),
        "running_realized_vol": f"SELECT {keys}, {rs(['log_return', 'realized_vol'])} FROM vol",
        "running_features": f"SELECT {featured} FROM features",
        "appended_features": f"SELECT {featured} FROM features",
        "appended_processed": f"SELECT {rs([*INPUTS, 'vix'])} FROM processed",
        "residuals": f"""SELECT {keys}, {r('predicted - actual', 'residual')},
            CASE WHEN predicted - actual > 0 THEN 'over' ELSE 'under' END AS side
            FROM persistence WHERE {IN_RANGE}""",
        "scatter": f"SELECT symbol, {rs(['actual', 'predicted'])} FROM persistence",
        "scatter_bounds": f"""SELECT symbol,
            {r('LEAST(MIN(actual), MIN(predicted))', 'line_from')},
            {r('GREATEST(MAX(actual), MAX(predicted))', 'line_to')}
            FROM persistence GROUP BY symbol""",
        "date_bounds": """SELECT symbol, MIN(date) AS min_allowed, MAX(date) AS max_allowed,
            MIN(date) AS start_date, MAX(date) AS end_date FROM persistence GROUP BY symbol""",
        "symbol_labels": "SELECT symbol, COUNT(*) AS n_rows, CASE symbol "
        + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LABELS.items())
        + " ELSE symbol END AS label FROM bars GROUP BY symbol",
        "run_metrics": run_metrics,
        "run_regimes": regimes(),
        "boosted_models": """SELECT f.symbol, refit_id, train_cut, train_cut AS n_train,
            score_to - score_from AS n_scored, CAST(16 AS BIGINT) AS n_features,
            1e0 AS importance_total FROM refits f""",
        "stored_models": f"""SELECT symbol, 0 AS refit_id, {SPLIT} AS train_cut,
            {SPLIT} AS n_train FROM plan""",
    }


def boosted(
    params: Fit, columns: list[str], source: str, cut: str = SPLIT
) -> list[tuple[str, str]]:
    """A holdout fit on the rows of ``source``, step by step."""
    two = "POW(2e0, FLOOR(LOG2({})) - ({}))".format
    steps = [
        ("t_rows", f"SELECT *, target_vol AS y, {cut} AS cut FROM {source} "),
        ("t_train", "SELECT * FROM t_rows WHERE row_idx < cut"),
        (
            "t_long",
            f"""SELECT symbol, row_idx, row_idx < cut AS training,
                UNNEST(RANGE({len(columns)})) AS f, UNNEST([{', '.join(columns)}]) AS x
                FROM t_rows""",
        ),
        (
            "t_units",
            f"""SELECT symbol, COUNT(*) AS n_train, MIN(y) AS lo, MAX(y) AS hi,
                {two('MAX(ABS(y))', 30)} AS y_unit FROM t_train GROUP BY symbol""",
        ),
        (
            "t_base",
            """SELECT t.symbol, MAX(n_train) AS n_train, MAX(lo) AS lo, MAX(hi) AS hi,
               CAST(SUM(CAST(ROUND_EVEN(y / y_unit, 0) AS BIGINT)) AS DOUBLE) * MAX(y_unit)
               / MAX(n_train) AS base
               FROM t_train t JOIN t_units u ON t.symbol = u.symbol GROUP BY t.symbol""",
        ),
        (
            "t_start",
            f"""SELECT symbol, n_train, base,
                {two('GREATEST(ABS(hi - base), ABS(lo - base))', 29)} AS unit FROM t_base""",
        ),
        (
            "t_value",
            """SELECT symbol, f, x, COUNT(*) AS num FROM t_long WHERE training GROUP BY 1, 2, 3""",
        ),
        (
            "t_level",
            f"""SELECT b.*, SUM(num) OVER (PARTITION BY b.symbol, f ORDER BY x)
                * {params.max_bins} // n_train AS level,
                LEAD(x) OVER (PARTITION BY b.symbol, f ORDER BY x) AS border
                FROM t_value b JOIN t_start s ON b.symbol = s.symbol""",
        ),
        (
            "t_rose",
            """SELECT *, level > LAG(level, 1, 0) OVER (PARTITION BY symbol, f ORDER BY x)
               AS rose FROM t_level""",
        ),
        (
            "t_edges",
            """SELECT symbol, f, border
               FROM t_rose WHERE rose AND border IS NOT NULL""",
        ),
        (
            "t_codes",
            """SELECT symbol, row_idx, LIST(CAST(code AS SMALLINT) ORDER BY f) AS codes FROM (
               SELECT symbol, row_idx, f, SUM(edge) OVER (PARTITION BY symbol, f
               ORDER BY x, edge DESC ROWS UNBOUNDED PRECEDING) AS code FROM (
                 SELECT symbol, row_idx, f, x, 0 AS edge FROM t_long UNION ALL
                 SELECT symbol, NULL, f, border, 1 FROM t_edges) u) c
               WHERE row_idx IS NOT NULL GROUP BY symbol, row_idx""",
        ),
        (
            "t_sum_0",
            """SELECT t.symbol, t.row_idx, cut, y, unit, codes, base AS predicted
               FROM t_rows t JOIN t_start s ON t.symbol = s.symbol
               JOIN t_codes c ON t.symbol = c.symbol AND t.row_idx = c.row_idx""",
        ),
    ]
    limit, lam = int(params.subsample * PRIME), f"{params.reg_lambda}e0"
    splits = []
    for t in range(params.trees):
        shift = (t * TREE_FACTOR + params.seed * SEED_FACTOR) % PRIME
        last = t * TREE_SHIFT % PRIME
        v = f"((row_idx % {PRIME} * {ROW_FACTOR} + {shift}) % {PRIME})"
        steps.append(
            (
                f"t_node_{t}_0",
                f"""SELECT symbol, row_idx, cut, y, unit, codes, predicted,
                    (v2 * v2 % {PRIME} * v % {PRIME} + {last}) % {PRIME} < {limit}
                    AND row_idx < cut AS kept,
                    CAST(ROUND_EVEN((predicted - y) / unit, 0) AS BIGINT) AS g,
                    0 AS node, 0 AS level
                    FROM (SELECT *, {v} AS v, {v} * {v} % {PRIME} AS v2 FROM t_sum_{t}) d""",
            )
        )
        for level in range(params.depth):
            node, best = f"t_node_{t}_{level}", f"t_best_{t}_{level}"
            splits.append(best)
            steps += [
                (
                    best,
                    f"""SELECT * FROM (SELECT *, ROW_NUMBER() OVER
                        (PARTITION BY symbol, node ORDER BY gain DESC, f, code) AS place FROM (
                        SELECT symbol, node, f, code, gl * gl / (nl + {lam})
                        + (gt - gl) * (gt - gl) / (nt - nl + {lam}) - gt * gt / (nt + {lam})
                        AS gain FROM (
                          SELECT *, SUM(g) OVER w * unit AS gl, SUM(num) OVER w AS nl,
                          SUM(g) OVER a * unit AS gt, SUM(num) OVER a AS nt FROM (
                            SELECT symbol, unit, node, f, code, SUM(g) AS g, COUNT(*) AS num
                            FROM (SELECT symbol, unit, node, g, UNNEST(RANGE({len(columns)})) AS f,
                                  UNNEST(codes) AS code
                                  FROM {node} WHERE kept AND level = {level}) c
                            GROUP BY 1, 2, 3, 4, 5) h
                          WINDOW w AS (PARTITION BY symbol, node, f ORDER BY code),
                          a AS (PARTITION BY symbol, node, f)) l
                        WHERE nl >= {params.min_child_rows}
                        AND nt - nl >= {params.min_child_rows}) s) o
                        WHERE place = 1 AND gain > {params.min_gain:.10f}""",
                ),
                (
                    f"t_node_{t}_{level + 1}",
                    f"""SELECT n.symbol, row_idx, cut, y, unit, codes, predicted, kept, n.g,
                        CASE WHEN b.f IS NULL THEN n.node
                             ELSE 2 * n.node + 1
                                  + CASE WHEN codes[b.f + 1] > b.code THEN 1 ELSE 0 END
                        END AS node,
                        CASE WHEN b.f IS NULL THEN n.level ELSE {level + 1} END AS level
                        FROM {node} n
                        LEFT JOIN {best} b ON n.symbol = b.symbol
                        AND n.node = b.node AND n.level = {level}""",
                ),
            ]
        final = f"t_node_{t}_{params.depth}"
        steps.append(
            (
                f"t_sum_{t + 1}",
                f"""SELECT n.symbol, row_idx, cut, y, unit, codes, predicted + value AS predicted
                    FROM {final} n JOIN (
                      SELECT symbol, node, -(SUM(g) * MAX(unit)) / (COUNT(*) + {lam})
                      * {params.learning_rate}e0 AS value
                      FROM {final} WHERE kept GROUP BY symbol, node) l
                    ON n.symbol = l.symbol AND n.node = l.node""",
            )
        )
    every = " UNION ALL ".join(f"SELECT symbol, f, gain FROM {name} " for name in splits)
    names = ", ".join(f"'{c}'" for c in columns)
    steps += [
        ("t_split", every),
        (
            "t_gain",
            """SELECT f.symbol, f.i, COALESCE(gain, 0) AS gain FROM
               (SELECT symbol, UNNEST(RANGE("""
            + str(len(columns))
            + """)) AS i FROM t_start) f
               LEFT JOIN (SELECT symbol, f AS i, AVG(gain) AS gain FROM t_split GROUP BY 1, 2) g
               ON f.symbol = g.symbol AND f.i = g.i""",
        ),
        (
            "t_importance",
            f"""SELECT symbol, 0 AS refit_id, list_extract([{names}], CAST(i + 1 AS INTEGER))
                AS feature, gain / SUM(gain) OVER (PARTITION BY symbol) AS importance
                FROM t_gain """,
        ),
        (
            "t_scored",
            f"""SELECT s.symbol, p.date, s.row_idx, s.y AS actual, s.predicted
                FROM t_sum_{params.trees} s
                JOIN {source} p ON p.symbol = s.symbol AND p.row_idx = s.row_idx
                WHERE s.row_idx >= s.cut""",
        ),
    ]
    return steps


#: One cut date per refit for all symbols: the default plan over the calendar of all dates.
POOLED_PLAN = """SELECT r.refit_id, r.first_scored, r.n_scored,
    CAST(count(*) AS BIGINT) AS n_train, max(f.date) AS last_trained
    FROM (SELECT CAST((d.i - d.cut) // 63 AS INTEGER) AS refit_id, min(f.date) AS first_scored,
                 count(*) AS n_scored
          FROM (SELECT date, row_number() OVER (ORDER BY date) - 1 AS i, count(*) OVER () AS n,
                       CAST(floor(count(*) OVER () * 0.6e0) AS BIGINT) AS cut
                FROM (SELECT DISTINCT date FROM features) a) d
          JOIN features f ON f.date = d.date
          WHERE d.i >= d.cut
            AND d.i < d.cut + 21 * CAST(ceil((d.n - d.cut - 21) / 21e0) AS BIGINT)
          GROUP BY 1) r
    JOIN features f ON f.date < r.first_scored GROUP BY 1, 2, 3"""


#: A symbol's rows are numbered apart from those of others.
NUMBER = """CAST('0x' || substr(md5(f.symbol), 1, 7) AS BIGINT) * 2097152 + day"""

CALENDAR = """SELECT date, ROW_NUMBER() OVER (ORDER BY date) - 1 AS day, COUNT(*) OVER () AS days
    FROM (SELECT DISTINCT date FROM features) a"""


def pooled(fit: Fit, walk: bool) -> list[tuple[str, str]]:
    """Fits on the rows of all symbols, as series named by the refit.

    Training rows are those below a cut, which is therefore put beside each row's number.
    """
    first = "CAST(FLOOR(days * 0.6e0) AS BIGINT)"
    stop = f"{first} + 21 * CAST(GREATEST(0, CEIL((days - {first} - 21) / 21e0)) AS BIGINT)"
    if walk:
        cuts = f"""SELECT CAST(k AS INTEGER) AS refit_id, first + k * 63 AS cut,
            LEAST(first + k * 63 + 63, stop) AS upto
            FROM (SELECT first, stop, UNNEST(RANGE(CAST(CEIL((stop - first) / 63e0) AS BIGINT)))
                  AS k FROM (SELECT DISTINCT {first} AS first, {stop} AS stop FROM p_days) b) c"""
    else:
        cuts = """SELECT DISTINCT 0 AS refit_id, days AS upto,
            CAST(FLOOR(days * CAST(0.8 AS DOUBLE)) AS BIGINT) AS cut FROM p_days"""
    return [
        ("p_days", CALENDAR),
        ("p_cuts", cuts),
        (
            "p_rows",
            f"""SELECT '*' || refit_id AS symbol, f.symbol AS own, f.date, refit_id, day, cut AS day_cut,
                {NUMBER} AS row_idx, {NUMBER} + CASE WHEN day < cut THEN 1 ELSE 0 END AS train_cut,
                target_vol, {', '.join(FEATURES)}
                FROM features f JOIN p_days USING (date) JOIN p_cuts ON day < upto""",
        ),
        *boosted(fit, FEATURES, "p_rows", "train_cut"),
        (
            "p_scored",
            """SELECT r.own AS symbol, r.date, r.day AS row_idx, r.refit_id,
               CAST((r.day - c.cut0) // 21 AS INTEGER) AS fold_id, t.actual, t.predicted
               FROM t_scored t JOIN p_rows r ON t.symbol = r.symbol AND t.row_idx = r.row_idx
               CROSS JOIN (SELECT MIN(cut) AS cut0 FROM p_cuts) c""",
        ),
    ]


def statement(steps: list[tuple[str, str]], final: str) -> str:
    """One statement with the CTEs that the final SELECT needs, directly or not."""
    used, words = [], set(re.findall(r"\w+", final))
    for name, sql in reversed(steps):
        if name in words:
            used.append(f"{name} AS MATERIALIZED ({sql})")
            words.update(re.findall(r"\w+", sql))
    return "WITH " + ",\n".join(reversed(used)) + f"\n{final}"


def oracle_sql() -> dict[str, str]:
    flags, suppliers = base("l_returnflag"), base("l_suppkey")
    final = finals()
    texts = {name: statement(flags, sql) for name, sql in final.items()}
    predicted = f"""SELECT symbol, date, row_idx, {rs(['actual', 'predicted'], 4)}
        FROM t_scored """
    small = flags + boosted(SMALL_FIT, FEATURES, "positioned")
    texts["boosted_holdout_small"] = statement(small, predicted)
    plain = flags + boosted(Fit(), NO_INDEX, "bare_positioned")
    texts["boosted_holdout_without_index"] = statement(plain, predicted)
    for name, fit in (("walk_forward_boosted_small", SMALL_FIT), ("walk_forward_boosted", Fit())):
        walked = flags + boosted(fit, FEATURES, "refit_rows", "train_cut")
        walked += [
            (
                "t_walked",
                f"""SELECT {', '.join(f's.{c}' for c in PREDICTION[:5])}, actual, predicted
                    FROM t_scored t JOIN scored s
                    ON split_part(t.symbol, '|', 1) = s.symbol AND t.row_idx = s.row_idx""",
            )
        ]
        texts[name] = statement(walked, f"SELECT {rs(PREDICTION, 4)} FROM t_walked")
    texts["walk_forward_boosted_metrics"] = statement(
        walked, f"SELECT symbol, n, {rs(METRIC_NAMES, 4)} FROM ({metrics('t_walked')}) m"
    )
    full = flags + boosted(Fit(), FEATURES, "positioned")
    texts["score_stored_models"] = texts["boosted_holdout_spread"] = statement(full, predicted)
    shares = f"SELECT symbol, refit_id, feature, {r('importance', digits=4)} FROM t_importance "
    texts["holdout_boosted"] = statement(
        full, f"SELECT symbol, n, {rs(METRIC_NAMES[:3], 4)} FROM ({metrics('t_scored')}) m"
    )
    texts["feature_importance"] = statement(full, shares)
    texts["feature_importance_printed"] = statement(
        full,
        "SELECT symbol, refit_id, feature, ROUND(importance, 4) AS importance FROM t_importance ",
    )
    texts["run_models"] = texts["stored_models"]
    texts["run_importances"] = texts["feature_importance"]
    texts["run_holdout_metrics"] = texts["holdout_boosted"]
    texts["processed_csv_round_trip"] = texts["processed_table"]
    texts["report_bundle_one_symbol"] = statement(
        flags, f"SELECT * FROM ({final['residuals']}) x WHERE symbol = 'A'"
    )
    texts["results_csv_round_trip"] = statement(
        flags, f"SELECT symbol, date, actual, predicted FROM ({final['results_table']}) x"
    )
    held = flags + pooled(Fit(), walk=False)
    texts["booster_file_round_trip"] = statement(
        full,
        f"""SELECT symbol, date, row_idx, {rs(['actual', 'predicted'], 4)} FROM t_scored """,
    )
    texts["adjusted_bars"] = statement(flags + ACTIONS, adjusted())
    texts["suppliers_adjusted_bars"] = statement(suppliers + ACTIONS, adjusted())
    texts["pooled_boosted"] = statement(
        held, f"SELECT symbol, n, {rs(METRIC_NAMES[:3], 4)} FROM ({metrics('p_scored')}) m"
    )
    walked = flags + pooled(Fit(), walk=True)
    texts["pooled_walk_forward"] = statement(walked, f"SELECT {rs(PREDICTION, 4)} FROM p_scored")
    short = flags + pooled(SMALL_FIT, walk=False)
    texts["run_pooled_small"] = statement(
        short, f"SELECT symbol, date, {r('predicted', digits=4)} FROM p_scored"
    )
    texts["suppliers_rerun"] = statement(suppliers, final["run_metrics"])
    texts["suppliers_pooled_plan"] = statement(suppliers, POOLED_PLAN)
    for name in (
        "realized_vol",
        "features_full",
        "scored_rows",
        "walk_forward_train_mean",
        "backtest_metrics",
        "regime_intervals",
        "running_features",
    ):
        texts[f"chunked_{name}"] = texts[name]
    for name in (
        "features_full",
        "fold_plan",
        "walk_forward_train_mean",
        "backtest_metrics",
        "regime_intervals",
        "run_metrics",
        "appended_features",
        "backtest_metrics_from_states",
        "regimes_from_parts",
    ):
        texts[f"suppliers_{name}"] = statement(suppliers, final[name])
    many = suppliers + boosted(SMALL_FIT, FEATURES, "positioned")
    texts["suppliers_boosted_holdout_small"] = statement(many, predicted)
    return texts
