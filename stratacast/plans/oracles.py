"""The same results in plain SQL over the raw tables, for checking.

Written from the definitions, not from the Spark plans: dense panels come from a
cross product, rolling statistics from sliding frames, scores from one grouping
over zero-filled rows, the projection from its closed form on a complete grid.
"""

from __future__ import annotations

import re

from stratacast.constants import HORIZON_DAYS, LAGS, LEVEL_NAMES, LEVELS, ROLLING_WINDOWS, RUN_NAMES, WINDOW_DAYS

KEYS = "state_id, store_id, cat_id, dept_id, item_id"
BURN_IN = max(LAGS)
STORE = "NATION_1"
ITEM = "Brand#1|ECONOMY"

CTES = {
    "lines": """
        SELECT r_name AS state_id, n_name AS store_id,
               'CAT_' || (CAST(split_part(p_brand, '#', 2) AS INTEGER) % 3) AS cat_id,
               p_brand AS dept_id, p_brand || '|' || p_type AS item_id,
               CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS INTEGER) AS day_num,
               CAST(l_quantity AS BIGINT) AS units, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents
        FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
        JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "bounds": f"""
        SELECT first_day, last_day, lo, lo + {BURN_IN} AS train_from,
               last_day - {HORIZON_DAYS} AS train_to, last_day - {HORIZON_DAYS} + 1 AS val_from
        FROM (SELECT min(day_num) AS first_day, max(day_num) AS last_day, min(day_num) AS lo FROM lines)""",
    "daily": f"SELECT {KEYS}, day_num, CAST(sum(units) AS INTEGER) AS sales FROM lines GROUP BY {KEYS}, day_num",
    "prices": """
        SELECT store_id, item_id, CAST(11101 + (day_num - 1) // 7 AS INTEGER) AS wm_yr_wk,
               CAST(sum(cents) // sum(units) AS DOUBLE) / 100.0 AS sell_price
        FROM lines GROUP BY 1, 2, 3""",
    "states": "SELECT r_name AS state_id, row_number() OVER (ORDER BY r_name) - 1 AS pos FROM region",
    "calendar": """
        SELECT *, CASE WHEN event_name_1 IS NOT NULL THEN 'Recurring' END AS event_type_1,
               CAST(NULL AS VARCHAR) AS event_name_2, CAST(NULL AS VARCHAR) AS event_type_2
        FROM (SELECT day_num, date, 'd_' || day_num AS d, CAST(11101 + (day_num - 1) // 7 AS INTEGER) AS wm_yr_wk,
                     dayname(date) AS weekday, CAST((dayofweek(date) + 1) % 7 + 1 AS INTEGER) AS wday,
                     CAST(month(date) AS INTEGER) AS month, CAST(year(date) AS INTEGER) AS year, day(date) AS dom,
                     CASE WHEN day(date) = 15 THEN 'PAYDAY' WHEN date = last_day(date) THEN 'MONTH_END' END AS event_name_1
              FROM (SELECT day_num, CAST(DATE '1995-01-01' + day_num AS DATE) AS date
                    FROM (SELECT CAST(unnest(generate_series(first_day, last_day)) AS INTEGER) AS day_num FROM bounds)))""",
    "days": "SELECT CAST(unnest(generate_series(lo, last_day)) AS INTEGER) AS day_num FROM bounds",
    "series": f"SELECT DISTINCT {KEYS} FROM daily",
    "dense": f"""
        SELECT {KEYS}, day_num, coalesce(sales, 0) AS sales
        FROM (SELECT * FROM series CROSS JOIN days) LEFT JOIN daily USING ({KEYS}, day_num)""",
    "panel": f"""
        SELECT {KEYS}, dense.day_num, sales, c.d, c.wm_yr_wk, c.wday, c.month, c.dom,
               coalesce(c.event_name_1, 'NoEvent') AS event_name_1, sell_price
        FROM dense LEFT JOIN calendar c ON c.day_num = dense.day_num
        LEFT JOIN prices USING (store_id, item_id, wm_yr_wk)""",
    "train": f"""
        SELECT {KEYS}, day_num, sales, coalesce(sell_price, 0) AS sell_price FROM panel, bounds
        WHERE day_num BETWEEN train_from AND train_to""",
    # The forecast looks back 28 days, so earlier ones need not be numbered.
    "val": f"""
        SELECT {KEYS}, day_num, sales, pred
        FROM (SELECT {KEYS}, day_num, sales, val_from, avg(sales) OVER (PARTITION BY store_id, item_id ORDER BY day_num
                     ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS pred
              FROM dense, bounds WHERE day_num >= val_from - 28)
        WHERE day_num >= val_from""",
    "shares": """
        SELECT store_id, item_id, avg_sales, avg_sales / nullif(sum(avg_sales) OVER (), 0) AS proportion
        FROM (SELECT store_id, item_id, avg(sales) AS avg_sales FROM train GROUP BY ALL)""",
    "within": """
        SELECT *, coalesce(avg_sales / nullif(dept_total, 0), 0) AS within_prop
        FROM (SELECT *, sum(avg_sales) OVER (PARTITION BY store_id, dept_id) AS dept_total
              FROM (SELECT store_id, dept_id, item_id, avg(sales) AS avg_sales FROM train GROUP BY ALL))""",
    # Summed base forecasts are coherent, so projecting them changes nothing.
    "reconciled": """
        SELECT v.*, pred AS pred_bu, sum(pred) OVER (PARTITION BY day_num) * proportion AS pred_td,
               sum(pred) OVER (PARTITION BY store_id, dept_id, day_num) * within_prop AS pred_mint
        FROM val v LEFT JOIN shares USING (store_id, item_id)
        LEFT JOIN (SELECT store_id, item_id, within_prop FROM within) USING (store_id, item_id)""",
}


def _level_case() -> str:
    cols = [k.strip() for k in KEYS.split(",")]
    whens = []
    for n, level in LEVELS.items():
        bits = sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in level)
        whens.append(f"WHEN {bits} THEN {n}")
    return f"CASE grouping({KEYS}) {' '.join(whens)} END"


def _sets(extra: str) -> str:
    return "GROUPING SETS (" + ", ".join("(" + ", ".join([*level, extra]) + ")" for level in LEVELS.values()) + ")"


def _by_level(source: str, sums: str) -> str:
    """Daily sums at all levels."""
    return (
        f"SELECT CAST({_level_case()} AS INTEGER) AS level, {KEYS}, day_num, {sums} "
        f"FROM {source} GROUP BY {_sets('day_num')}"
    )


CTES["price_moves"] = f"""
    SELECT {KEYS}, day_num
    FROM (SELECT *, lag(sell_price, 1, 0) OVER (PARTITION BY store_id, item_id ORDER BY day_num) AS prev FROM train)
    WHERE sell_price <> prev"""
CTES["train_levels"] = _by_level("train", "sum(sales) AS y, sum(sell_price) AS p, sum(sales * sell_price) AS revenue")
CTES["scale"] = f"""
    SELECT level, {KEYS}, CASE WHEN m = 0 THEN 1.0 ELSE m END AS scale, dollars, revenue
    FROM (SELECT level, {KEYS}, avg(power(y - before, 2)) AS m, sum(CAST(y AS DOUBLE) * p) AS dollars, sum(revenue) AS revenue
          FROM (SELECT *, lag(y) OVER (PARTITION BY level, {KEYS} ORDER BY day_num) AS before FROM train_levels)
          GROUP BY level, {KEYS})"""
CTES["val_levels"] = _by_level("reconciled", "sum(sales) AS y, " + ", ".join(f"sum({p}) AS {p}" for p in RUN_NAMES))
_SAME = " AND ".join(f"s.{k.strip()} IS NOT DISTINCT FROM v.{k.strip()}" for k in KEYS.split(","))
CTES["rmsse"] = f"""
    SELECT s.level, {', '.join('s.' + k.strip() for k in KEYS.split(','))}, method,
           sqrt(sse / ({HORIZON_DAYS} * scale)) AS rmsse,
           CASE WHEN sum(dollars) OVER (PARTITION BY s.level, method) = 0
                THEN 1.0 / count(*) OVER (PARTITION BY s.level, method)
                ELSE dollars / sum(dollars) OVER (PARTITION BY s.level, method) END AS weight
    FROM scale s JOIN (
        SELECT level, {KEYS}, method, sum(power(y - f, 2)) AS sse
        FROM (UNPIVOT val_levels ON {', '.join(RUN_NAMES)} INTO NAME method VALUE f)
        GROUP BY level, {KEYS}, method) v
    ON s.level = v.level AND {_SAME}"""
_LEVEL_NAME = "CASE level " + " ".join(f"WHEN {n} THEN '{name}'" for n, name in LEVEL_NAMES.items()) + " END"
CTES["scores"] = f"""
    SELECT method, level, {_LEVEL_NAME} AS level_name, sqrt(sum(weight * power(rmsse, 2))) AS wrmsse
    FROM rmsse GROUP BY method, level"""
_METHOD = "CASE method WHEN 'pred' THEN 'Baseline' WHEN 'pred_bu' THEN 'Bottom-Up' WHEN 'pred_td' THEN 'Top-Down' ELSE 'MinTrace' END"
CTES["named"] = f"SELECT {_METHOD} AS method, level, level_name, round6(wrmsse) AS wrmsse FROM scores WHERE method <> 'pred'"
CTES["overall"] = f"""
    SELECT {_METHOD} AS method, round6(avg(wrmsse)) AS wrmsse FROM scores WHERE method <> 'pred' GROUP BY method"""
CTES["base"] = """
    SELECT CASE grouping(state_id, store_id, dept_id) WHEN 7 THEN 'total' WHEN 3 THEN 'state' WHEN 5 THEN 'store'
                WHEN 6 THEN 'dept' ELSE 'store_dept' END AS node_level,
           state_id, store_id, dept_id, day_num, sum(pred) AS yhat
    FROM val GROUP BY GROUPING SETS ((day_num), (state_id, day_num), (store_id, day_num), (dept_id, day_num),
                                     (store_id, dept_id, day_num))"""
CTES["nodes"] = "SELECT DISTINCT state_id, store_id, dept_id FROM series"
CTES["rounded_base"] = "SELECT * REPLACE (round(round(yhat, 9)) AS yhat) FROM base"


def _with(body: str, tables: dict[str, str]) -> str:
    """Prefix the CTEs a statement needs, in order of definition."""
    words = set(re.findall(r"[a-z_0-9]+", body))
    needed: set[str] = set()
    todo = [c for c in tables if c in words]
    while todo:
        c = todo.pop()
        if c not in needed:
            needed.add(c)
            inner = set(re.findall(r"[a-z_0-9]+", tables[c]))
            todo += [d for d in tables if d in inner and d != c]
    order = [c for c in tables if c in needed]
    if not order:
        return body
    return "WITH " + ", ".join(f"{c} AS MATERIALIZED ({tables[c]})" for c in order) + " " + body


_W = "OVER (PARTITION BY store_id, item_id ORDER BY day_num"
_LAG_COLS = ", ".join(f"lag(sales, {k}) {_W}) AS sales_lag_{k}" for k in LAGS)
_ROLL = ", ".join(
    f"avg(sales) {_W} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) AS sales_rmean_{k}, "
    f"stddev_samp(sales) {_W} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) AS sales_rstd_{k}"
    for k in ROLLING_WINDOWS
)
_ROLL_NAMES = [f"sales_{s}_{k}" for k in ROLLING_WINDOWS for s in ("rmean", "rstd")]
_MOMENTUM = "coalesce(CASE WHEN prev <> 0 THEN (sell_price - prev) / prev END, 0)"
_SNAP = "CASE WHEN dom <= 10 + pos THEN 1 ELSE 0 END"
_CYC = (
    "sin(2 * pi() * wday / 7) AS wday_sin, cos(2 * pi() * wday / 7) AS wday_cos, "
    "sin(2 * pi() * month / 12) AS month_sin, cos(2 * pi() * month / 12) AS month_cos"
)


def _r(expr: str, name: str | None = None) -> str:
    return f"round6({expr}) + 0.0 AS {name or expr}"


def _sum_r(name: str) -> str:
    return _r(f"sum({name})", name)


def _coverage(key: str, left: str, right: str) -> str:
    return f"""
        SELECT '{key}' AS key, count(*) FILTER (l) AS n_left, count(*) FILTER (r) AS n_right,
               count(*) FILTER (l AND r) AS n_overlap, count(*) FILTER (l AND NOT r) AS left_only,
               count(*) FILTER (r AND NOT l) AS right_only,
               count(*) FILTER (l AND r) = count(*) AS keys_match
        FROM (SELECT a.k IS NOT NULL AS l, b.k IS NOT NULL AS r
              FROM (SELECT DISTINCT {left}) a FULL JOIN (SELECT DISTINCT {right}) b ON a.k = b.k)"""


def _nulls(table: str, cols: list[str]) -> str:
    parts = [
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS nulls, "
        f"round6(100.0 * (count(*) - count({c})) / count(*)) AS pct FROM {table}"
        for c in cols
    ]
    return " UNION ALL ".join(parts)


def _profile(table: str, cols: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, '{t}' AS dtype, count(*) - count(\"{c}\") AS nulls, "
        f"count(DISTINCT \"{c}\") AS n_distinct FROM {table}"
        for i, (c, t) in enumerate(cols, 1)
    )


_ID_COLS = [(k.strip(), "string") for k in KEYS.split(",")]
_SALES_COLS = [*_ID_COLS, ("day_num", "int"), ("sales", "int")]
_PRICE_COLS = [("store_id", "string"), ("item_id", "string"), ("wm_yr_wk", "int"), ("sell_price", "double")]
_CAL_COLS = [("wm_yr_wk", "int"), ("weekday", "string"), ("wday", "int"), ("month", "int"), ("year", "int"), ("d", "string"),
             ("event_name_1", "string"), ("event_type_1", "string"), ("event_name_2", "string"), ("event_type_2", "string")]
_STATES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def _narrow(table: str, cols: list[tuple[str, str]]) -> str:
    parts = []
    for c, t in cols:
        if t == "string":
            parts.append(
                f"SELECT '{c}' AS column_name, 'string' AS from_type, 'string' AS to_type, CAST(NULL AS DOUBLE) AS min_value, "
                f"CAST(NULL AS DOUBLE) AS max_value, count(DISTINCT {c}) AS n_distinct, "
                f"count(DISTINCT {c}) < 0.5 * count(*) AS is_categorical FROM {table}"
            )
            continue
        to = (
            f"CASE WHEN min({c}) >= -128 AND max({c}) <= 127 THEN 'tinyint' "
            f"WHEN min({c}) >= -32768 AND max({c}) <= 32767 THEN 'smallint' ELSE 'int' END"
            if t == "int"
            else "'float'"
        )
        parts.append(
            f"SELECT '{c}', '{t}', {to}, round6(CAST(min({c}) AS DOUBLE)), round6(CAST(max({c}) AS DOUBLE)), NULL, false FROM {table}"
        )
    return " UNION ALL ".join(parts)


def _size(table: str, cols: list[tuple[str, str]]) -> str:
    """Bytes per column before and after narrowing, added up."""
    before, after = [], []
    for c, t in cols:
        if t == "string":
            before.append(f"sum(strlen({c}))")
            code = f"CASE WHEN count(DISTINCT {c}) <= 127 THEN 1 WHEN count(DISTINCT {c}) <= 32767 THEN 2 ELSE 4 END"
            after.append(f"CASE WHEN count(DISTINCT {c}) < 0.5 * count(*) THEN {code} * count(*) ELSE sum(strlen({c})) END")
        elif t == "int":
            before.append("4 * count(*)")
            width = (
                f"CASE WHEN min({c}) >= -128 AND max({c}) <= 127 THEN 1 "
                f"WHEN min({c}) >= -32768 AND max({c}) <= 32767 THEN 2 ELSE 4 END"
            )
            after.append(f"{width} * count(*)")
        else:
            before.append("8 * count(*)")
            after.append("4 * count(*)")
    name = "sell_prices" if table == "prices" else "sales"
    return (
        f"SELECT '{name}' AS table_name, count(*) AS n_rows, {len(cols)} AS n_columns, "
        f"{' + '.join(before)} AS bytes_before, {' + '.join(after)} AS bytes_after FROM {table}"
    )


# The balanced grid of stores and departments splits into five independent
# parts (mean, state, store within state, department, rest); (S'S) scales each
# by a constant, so the projection divides each by it.
_INCOHERENT = """
    SELECT store_id, dept_id, day_num,
           round6(m0 / (1 + n_all + n_state + n_depts + n_stores) + (m_state - m0) / (1 + n_state + n_depts)
           + (m_store - m_state) / (1 + n_depts) + (m_dept - m0) / (1 + n_stores)
           + (b - m_store - m_dept + m0)) + 0.0 AS reconciled
    FROM (SELECT *, avg(b) OVER (PARTITION BY day_num) AS m0, avg(b) OVER (PARTITION BY day_num, state_id) AS m_state,
                 avg(b) OVER (PARTITION BY day_num, store_id) AS m_store, avg(b) OVER (PARTITION BY day_num, dept_id) AS m_dept,
                 count(*) OVER (PARTITION BY day_num) AS n_all, count(*) OVER (PARTITION BY day_num, state_id) AS n_state,
                 count(*) OVER (PARTITION BY day_num, store_id) AS n_depts, count(*) OVER (PARTITION BY day_num, dept_id) AS n_stores
          FROM (SELECT g.state_id, b.store_id, b.dept_id, b.day_num, b.yhat + t.yhat + s.yhat + o.yhat + d.yhat AS b
                FROM rounded_base b JOIN (SELECT DISTINCT state_id, store_id FROM series) g USING (store_id)
                JOIN rounded_base t ON t.node_level = 'total' AND t.day_num = b.day_num
                JOIN rounded_base s ON s.node_level = 'state' AND s.day_num = b.day_num AND s.state_id = g.state_id
                JOIN rounded_base o ON o.node_level = 'store' AND o.day_num = b.day_num AND o.store_id = b.store_id
                JOIN rounded_base d ON d.node_level = 'dept' AND d.day_num = b.day_num AND d.dept_id = b.dept_id
                WHERE b.node_level = 'store_dept'))"""

_BODIES = {
    "panel_long": "SELECT store_id, item_id, day_num, sales, wm_yr_wk, wday, event_name_1, sell_price FROM panel",
    "unpivot_wide": "SELECT item_id || '_' || store_id AS id, 'd_' || day_num AS d, day_num, sales FROM dense",
    "panel_gaps": """
        SELECT store_id, item_id,
               (SELECT last_day - lo + 1 FROM bounds) - count(*) FILTER (day_num >= lo) AS missing_days
        FROM daily, bounds GROUP BY store_id, item_id
        HAVING (SELECT last_day - lo + 1 FROM bounds) > count(*) FILTER (day_num >= lo)""",
    "price_join_coverage": "SELECT count(*) AS n_rows, count(*) - count(sell_price) AS price_nulls FROM panel",
    "lag_features": f"""
        SELECT * FROM (SELECT store_id, item_id, day_num, {_LAG_COLS} FROM dense) WHERE sales_lag_{BURN_IN} IS NOT NULL""",
    "rolling_features": f"""
        SELECT store_id, item_id, day_num, {', '.join(_r(c) for c in _ROLL_NAMES)}
        FROM (SELECT store_id, item_id, day_num, {_ROLL} FROM dense)""",
    "calendar_features": f"""
        SELECT d, state_id, day_num, {', '.join(_r(c) for c in ('wday_sin', 'wday_cos', 'month_sin', 'month_cos'))}, is_event, snap
        FROM (SELECT d, state_id, day_num, {_CYC}, CASE WHEN event_name_1 IS NULL THEN 0 ELSE 1 END AS is_event, {_SNAP} AS snap
              FROM calendar CROSS JOIN states)""",
    "price_momentum": f"""
        SELECT store_id, item_id, day_num, round6(sell_price) AS sell_price, {_r(_MOMENTUM, 'price_momentum')}
        FROM (SELECT *, lag(sell_price) {_W}) AS prev FROM panel)""",
    "feature_table": f"""
        SELECT store_id, day_num, count(*) AS n_rows, sum(sales) AS sales, {', '.join(f'sum(sales_lag_{k}) AS sales_lag_{k}' for k in LAGS)},
               {', '.join(_sum_r(c) for c in [*_ROLL_NAMES, 'wday_sin', 'wday_cos', 'month_sin', 'month_cos'])},
               sum(is_event) AS is_event, sum(snap) AS snap, {_sum_r('price_momentum')}
        FROM (SELECT *, {_MOMENTUM} AS price_momentum, {_SNAP} AS snap, CASE WHEN event_name_1 = 'NoEvent' THEN 0 ELSE 1 END AS is_event, {_CYC}
              FROM (SELECT *, lag(sell_price) {_W}) AS prev, {_LAG_COLS}, {_ROLL} FROM panel) JOIN states USING (state_id))
        WHERE sales_lag_{BURN_IN} IS NOT NULL GROUP BY store_id, day_num""",
    "train_val_split": """
        SELECT CASE WHEN day_num < val_from THEN 'train' ELSE 'validation' END AS part, count(*) AS n_rows,
               min(day_num) AS first_day, max(day_num) AS last_day
        FROM dense, bounds WHERE day_num >= train_from GROUP BY 1""",
    "level_aggregate": _by_level("daily", "CAST(sum(sales) AS BIGINT) AS sales"),
    "store_dept_daily": "SELECT store_id, dept_id, day_num, CAST(sum(sales) AS BIGINT) AS sales FROM daily GROUP BY ALL",
    # A day has a row where any series of the level changes its price.
    "price_of_levels": f"""
        SELECT l.level, {', '.join('l.' + k.strip() for k in KEYS.split(','))}, l.day_num, round6(l.price) + 0.0 AS price
        FROM ({_by_level('train', 'sum(sell_price) AS price')}) l
        JOIN (SELECT level, {KEYS}, day_num FROM ({_by_level('price_moves', 'count(*) AS n')})) c
        ON l.level = c.level AND l.day_num = c.day_num AND {' AND '.join(f'l.{k.strip()} IS NOT DISTINCT FROM c.{k.strip()}' for k in KEYS.split(','))}
        WHERE l.level <= 9""",
    "series_scale": f"SELECT level, {KEYS}, {_r('scale')} FROM scale",
    "series_weights": f"SELECT level, {KEYS}, round6(dollars / sum(dollars) OVER (PARTITION BY level)) AS weight FROM scale",
    "revenue_weights": f"SELECT level, {KEYS}, round6(revenue / sum(revenue) OVER (PARTITION BY level)) AS weight FROM scale",
    "series_rmsse": f"SELECT level, {KEYS}, {_r('rmsse')} FROM rmsse WHERE method = 'pred'",
    "wrmsse_levels": f"SELECT level, level_name, {_r('wrmsse')} FROM scores WHERE method = 'pred'",
    "wrmsse_overall": f"SELECT {_r('avg(wrmsse)', 'wrmsse_overall')} FROM scores WHERE method = 'pred'",
    "unmatched_series": f"""
        SELECT level, CASE WHEN n_train = 0 THEN 'train' ELSE 'validation' END AS missing_in, count(*) AS n_series
        FROM (SELECT CAST({_level_case()} AS INTEGER) AS level, {KEYS}, count(*) FILTER (day_num <= train_to) AS n_train,
                     count(*) FILTER (day_num >= val_from) AS n_val
              FROM daily, bounds WHERE day_num >= train_from GROUP BY {_sets('()').replace(', ()', '')})
        WHERE n_train = 0 OR n_val = 0 GROUP BY 1, 2""",
    "bottom_up_levels": f"SELECT * REPLACE (round6(pred_bu) AS pred_bu) FROM ({_by_level('val', 'sum(pred) AS pred_bu')})",
    "hist_proportions": f"SELECT store_id, item_id, {_r('avg_sales')}, {_r('proportion')} FROM shares",
    "top_down": f"SELECT store_id, item_id, day_num, {_r('pred_td')} FROM reconciled",
    "within_dept_proportions": f"""
        SELECT store_id, dept_id, item_id, {_r('avg_sales')}, {_r('dept_total')}, {_r('within_prop')} FROM within""",
    "summing_membership": """
        SELECT store_id, dept_id, 'total' AS node_level, 'Total' AS node FROM nodes
        UNION ALL SELECT store_id, dept_id, 'state', state_id FROM nodes
        UNION ALL SELECT store_id, dept_id, 'store', store_id FROM nodes
        UNION ALL SELECT store_id, dept_id, 'dept', dept_id FROM nodes
        UNION ALL SELECT store_id, dept_id, 'store_dept', store_id || '_' || dept_id FROM nodes""",
    "base_forecasts": f"SELECT node_level, state_id, store_id, dept_id, day_num, {_r('yhat')} FROM base",
    "mintrace_coherent": f"SELECT store_id, item_id, day_num, {_r('pred_mint')} FROM reconciled",
    "mintrace_incoherent": _INCOHERENT,
    "coherence_error": """
        SELECT unnest(['Baseline', 'Bottom-Up', 'Top-Down', 'MinTrace']) AS method, CAST(0 AS DOUBLE) AS coherence_error""",
    "coherence_of_levels": """
        SELECT sum(abs(coalesce(p.yhat, 0) - coalesce(c.yhat, 0))) AS coherence_error
        FROM (SELECT store_id, day_num, yhat FROM rounded_base WHERE node_level = 'store') p
        FULL JOIN (SELECT store_id, day_num, sum(yhat) AS yhat FROM rounded_base WHERE node_level = 'store_dept' GROUP BY ALL) c
        USING (store_id, day_num)""",
    "rmse": f"SELECT {_r('sqrt(avg(power(sales - pred, 2)))', 'rmse')} FROM val",
    "store_report": f"""
        SELECT state_id, store_id, sum(sales) AS actual_total, {_r('sum(pred)', 'pred_total')},
               {_r('avg(abs(sales - pred) / greatest(sales, 1)) * 100', 'mape')} FROM val GROUP BY state_id, store_id""",
    "national_daily": f"SELECT day_num, sum(sales) AS actual, {_r('sum(pred)', 'forecast')} FROM val GROUP BY day_num",
    "state_daily": f"""
        SELECT state_id, day_num, sum(sales) AS actual, {_r('sum(pred)', 'forecast')} FROM val GROUP BY state_id, day_num""",
    "state_coherence": "SELECT CAST(0 AS DOUBLE) AS difference",
    "sku_series": f"""
        SELECT store_id, item_id, day_num, sales, {_r('pred', 'forecast')} FROM val
        WHERE store_id = '{STORE}' AND item_id = '{ITEM}' ORDER BY day_num""",
    "top_items": f"""
        SELECT item_id, count(*) AS n_rows FROM daily WHERE store_id = '{STORE}'
        GROUP BY item_id ORDER BY n_rows DESC, item_id LIMIT 20""",
    "sorted_stores": "SELECT DISTINCT state_id, store_id FROM daily ORDER BY 1, 2",
    "pred_range": " UNION ALL ".join(
        f"SELECT '{n}' AS method, {_r(f'min({p})', 'min_pred')}, {_r(f'max({p})', 'max_pred')} FROM reconciled"
        for p, n in (("pred", "Baseline"), ("pred_bu", "Bottom-Up"), ("pred_td", "Top-Down"), ("pred_mint", "MinTrace"))
    ),
    "leaderboard": """
        SELECT CAST(level AS INTEGER) AS position, level_name AS row_name,
               round6(max(wrmsse) FILTER (method = 'pred')) AS "Baseline", round6(max(wrmsse) FILTER (method = 'pred_bu')) AS "Bottom-Up",
               round6(max(wrmsse) FILTER (method = 'pred_td')) AS "Top-Down", round6(max(wrmsse) FILTER (method = 'pred_mint')) AS "MinTrace"
        FROM (SELECT * FROM scores UNION ALL SELECT method, 13, 'OVERALL', avg(wrmsse) FROM scores GROUP BY method
              UNION ALL SELECT DISTINCT method, 14, 'COHERENCE ERROR', 0.0 FROM scores)
        GROUP BY level, level_name""",
    "best_per_level": """
        SELECT level, level_name, arg_min(method, (wrmsse, method)) AS best_method, min(wrmsse) AS wrmsse FROM named GROUP BY 1, 2""",
    "best_method": "SELECT method AS best_method, wrmsse FROM overall ORDER BY wrmsse, method LIMIT 1",
    "method_ranks": """
        SELECT method, wrmsse, CAST(0 AS DOUBLE) AS coherence_error, CAST(rank() OVER (ORDER BY wrmsse) AS INTEGER) AS rank_wrmsse,
               CAST(1 AS INTEGER) AS rank_coherence,
               round6((wrmsse / (SELECT o.wrmsse FROM overall o WHERE o.method = 'Bottom-Up') - 1) * 100) + 0.0 AS pct_vs_base
        FROM overall""",
    "metrics_report": f"""
        SELECT n.method, max(o.wrmsse) AS wrmsse_overall, CAST(0 AS DOUBLE) AS coherence_error,
               {', '.join(f'max(n.wrmsse) FILTER (level = {k}) AS level_{k}' for k in LEVELS)},
               n.method = (SELECT method FROM overall ORDER BY wrmsse, method LIMIT 1) AS is_best
        FROM named n JOIN overall o ON o.method = n.method GROUP BY n.method""",
    "run_log_roundtrip": f"""
        SELECT 'baseline_lgbm_sku' AS run_name, 'metric' AS kind, 'wrmsse_level_' || level AS key, {_r('wrmsse', 'value')}
        FROM scores WHERE method = 'pred'
        UNION ALL SELECT 'baseline_lgbm_sku', 'metric', 'wrmsse_overall', round6(avg(wrmsse)) FROM scores WHERE method = 'pred'
        UNION ALL SELECT 'baseline_lgbm_sku', 'param', 'horizon', {HORIZON_DAYS}.0""",
    "null_audit": "SELECT * FROM ("
    + _nulls("calendar", [c for c, _ in _CAL_COLS])
    + ") WHERE nulls > 0",
    "column_profile": _profile("calendar", _CAL_COLS)
    + " UNION ALL "
    + " UNION ALL ".join(
        f"SELECT CAST({11 + i} AS INTEGER), 'snap_{s}', 'int', 0, count(DISTINCT dom <= 10 + {i}) FROM calendar"
        for i, s in enumerate(_STATES)
    )
    + " UNION ALL "
    + _profile("daily", _SALES_COLS)
    + " UNION ALL "
    + _profile("prices", _PRICE_COLS),
    "narrow_schema": _narrow("prices", _PRICE_COLS) + " UNION ALL " + _narrow("daily", _SALES_COLS),
    "dataset_report": f"""
        SELECT coalesce(table_name, 'TOTAL') AS table_name, CAST(sum(n_rows) AS BIGINT) AS n_rows, CAST(sum(n_columns) AS BIGINT) AS n_columns,
               CAST(sum(bytes_before) AS BIGINT) AS bytes_before, CAST(sum(bytes_after) AS BIGINT) AS bytes_after,
               round6(100.0 * CAST(sum(bytes_before) - sum(bytes_after) AS DOUBLE) / CAST(sum(bytes_before) AS DOUBLE)) AS pct_saved
        FROM ({_size('daily', _SALES_COLS)} UNION ALL {_size('prices', _PRICE_COLS)}) GROUP BY ROLLUP (table_name)""",
    "hierarchy_cardinality": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, "
        f"array_to_string(list_slice(list_sort(list(DISTINCT {c})), 1, 5), ', ') AS sample FROM series"
        for c, _ in _ID_COLS
    ),
    "hierarchy_info": " UNION ALL ".join(f"SELECT DISTINCT '{c}' AS column_name, {c} AS value FROM series" for c, _ in _ID_COLS),
    "series_count": "SELECT count(*) AS n_series FROM series",
    "store_state_map": """
        SELECT store_id, min(state_id) AS state_id, count(DISTINCT state_id) AS n_states FROM series GROUP BY store_id""",
    "key_coverage_days": _coverage("d", "'d_' || day_num AS k FROM daily", "d AS k FROM calendar"),
    "key_coverage_stores": _coverage("store_id", "store_id AS k FROM daily", "store_id AS k FROM prices"),
    "key_coverage_items": _coverage("item_id", "item_id AS k FROM daily", "item_id AS k FROM prices"),
    "key_coverage_weeks": _coverage("wm_yr_wk", "wm_yr_wk AS k FROM calendar", "wm_yr_wk AS k FROM prices"),
    "priced_never_sold_in_window": """
        SELECT DISTINCT store_id, item_id FROM prices p WHERE NOT EXISTS (
            SELECT 1 FROM daily d, bounds WHERE d.store_id = p.store_id AND d.item_id = p.item_id AND day_num >= lo)""",
    "window_presence": """
        SELECT count(DISTINCT day_num) AS found, max(last_day - lo + 1) AS expected,
               count(DISTINCT day_num) = max(last_day - lo + 1) AS complete FROM daily, bounds WHERE day_num >= lo""",
    "size_estimate": """
        SELECT n_series, n_days, n_series * n_days AS est_rows, round6(n_series * n_days * 50 / 1048576.0) AS est_mb
        FROM (SELECT count(*) AS n_series, (SELECT last_day - lo + 1 FROM bounds) AS n_days FROM series)""",
    "csv_load": f"""
        SELECT 'calendar' AS table_name, 16 AS n_columns, count(*) AS n_rows,
               CAST(100 * sum(wm_yr_wk + wday + month + year + {' + '.join(f'CAST(dom <= 10 + {i} AS INTEGER)' for i in range(5))}) AS BIGINT) AS checksum
        FROM calendar
        UNION ALL SELECT 'sales_evaluation', 6 + (SELECT last_day - lo + 1 FROM bounds), count(DISTINCT (store_id, item_id)), 100 * sum(sales) FROM dense
        UNION ALL SELECT 'sales_validation', 6 + (SELECT last_day - lo + 1 - {HORIZON_DAYS} FROM bounds), count(DISTINCT (store_id, item_id)),
               100 * sum(sales) FILTER (day_num <= train_to) FROM dense, bounds
        UNION ALL SELECT 'sell_prices', 4, count(*), sum(CAST(round((wm_yr_wk + sell_price) * 100) AS BIGINT)) FROM prices
        UNION ALL SELECT 'sample_submission', 29, count(*), 0 FROM series""",
    "clip_round": """
        SELECT store_id, item_id, day_num, greatest(sales / 8 - 0.25, 0) AS clipped, round_even(greatest(sales / 8 - 0.25, 0), 2) AS rounded
        FROM val""",
    "stored_predictions": "SELECT store_id, item_id, day_num, greatest(sales / 8 - 0.25, 0) AS pred FROM val",
    "predictions_fallback": "SELECT store_id, item_id, day_num, CAST(sales AS DOUBLE) AS pred FROM val",
    "stored_panel": "SELECT store_id, count(*) AS n_rows, sum(sales) AS sales, count(sell_price) AS n_prices FROM panel GROUP BY store_id",
    "series_last": f"""
        SELECT store_id, item_id, max(day_num) AS day_num, arg_max(sales, day_num) AS sales, round6(arg_max(sell_price, day_num)) AS sell_price,
               arg_max(sales_lag_28, day_num) AS sales_lag_28, {_r('arg_max(sales_rmean_60, day_num)', 'sales_rmean_60')},
               {_r('arg_max(price_momentum, day_num)', 'price_momentum')}
        FROM (SELECT *, {_MOMENTUM} AS price_momentum FROM (SELECT *, lag(sell_price) {_W}) AS prev, {_LAG_COLS}, {_ROLL} FROM panel))
        WHERE sales_lag_{BURN_IN} IS NOT NULL GROUP BY store_id, item_id""",
    "horizon_template": f"""
        SELECT store_id, item_id, CAST(h AS INTEGER) AS h, CAST(day_num + h AS INTEGER) AS day_num, sales, sales_lag_7
        FROM (SELECT store_id, item_id, day_num, sales, lag(sales, 7) {_W}) AS sales_lag_7 FROM dense), bounds,
             (SELECT unnest(generate_series(1, {HORIZON_DAYS})) AS h)
        WHERE day_num = last_day""",
}

_FIRST_INPUTS = ("sales_lag_7", "sales_lag_14", "sales_lag_28", "wday", "month", "is_event", "snap")
# Power 1.1: first derivative mu^0.9 - y mu^-0.1, second 0.9 mu^0.9 + 0.1 y mu^-0.1, at the same mean for all rows.
_BODIES["boosted_first_gains"] = f"""
    SELECT feature, threshold, CAST(nl AS BIGINT) AS n_left,
           round(power(gl, 2) / hl + power(gr, 2) / hr - power(gl + gr, 2) / (hl + hr) + 1e-7, 3) AS gain
    FROM (SELECT feature, value AS threshold, nl, n - nl AS nr, nl * a - sl * b AS gl, (n - nl) * a - (s - sl) * b AS gr,
                 0.9 * nl * a + 0.1 * sl * b AS hl, 0.9 * (n - nl) * a + 0.1 * (s - sl) * b AS hr, last
          FROM (SELECT feature, value, sum(k) OVER (PARTITION BY feature ORDER BY value) AS nl, sum(y) OVER (PARTITION BY feature ORDER BY value) AS sl,
                       sum(k) OVER (PARTITION BY feature) AS n, sum(y) OVER (PARTITION BY feature) AS s,
                       value = max(value) OVER (PARTITION BY feature) AS last,
                       power(sum(y) OVER (PARTITION BY feature) / sum(k) OVER (PARTITION BY feature), 0.9) AS a,
                       power(sum(y) OVER (PARTITION BY feature) / sum(k) OVER (PARTITION BY feature), -0.1) AS b
                FROM (SELECT feature, value, CAST(count(*) AS DOUBLE) AS k, CAST(sum(sales) AS DOUBLE) AS y FROM (
                      UNPIVOT (SELECT sales, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _FIRST_INPUTS)}
                               FROM (SELECT *, {_LAG_COLS}, {_SNAP} AS snap, CASE WHEN event_name_1 = 'NoEvent' THEN 0 ELSE 1 END AS is_event
                                     FROM panel JOIN states USING (state_id)), bounds
                               WHERE day_num BETWEEN train_from AND train_to)
                      ON {', '.join(_FIRST_INPUTS)} INTO NAME feature VALUE value) GROUP BY feature, value)))
    WHERE NOT last AND nl >= 100 AND nr >= 100"""
_BODIES["features_in_steps"] = _BODIES["feature_table"]
_BODIES["forecast_lookup"] = f"""
    SELECT store_id, item_id, CAST(h AS INTEGER) AS h, CAST(last_day + h AS INTEGER) AS day_num, round_even(pred, 2) AS forecast
    FROM val, bounds, (SELECT unnest(generate_series(1, {HORIZON_DAYS})) AS h)
    WHERE day_num = last_day AND store_id = '{STORE}' AND item_id = '{ITEM}'
    UNION ALL SELECT '{STORE}', 'unknown', NULL, NULL, NULL"""
_BODIES["model_reuse"] = f"""
    SELECT step, step = 'reordered' AS reused, n_train, CAST(s + CASE step WHEN 'changed' THEN 1 ELSE 0 END AS BIGINT) AS sales, n_preds
    FROM (SELECT count(*) FILTER (day_num < val_from + 14) AS n_train, sum(sales) FILTER (day_num < val_from + 14) AS s,
                 count(*) FILTER (day_num >= val_from + 14) AS n_preds FROM val, bounds),
         (SELECT unnest(['first', 'reordered', 'changed']) AS step)"""
_BODIES["preview"] = f"SELECT {KEYS}, day_num, sales FROM daily ORDER BY store_id, item_id, day_num LIMIT 3"


def _fact(table: str, source: str, position: int, column: str, dtype: str) -> str:
    """One row of facts of a column; ``source`` gives its rows."""
    head = f"SELECT '{table}' AS table_name, CAST({position} AS INTEGER) AS position, '{column}' AS column_name, '{dtype}' AS dtype, "
    c = f'"{column}"'
    head += f"count(*) AS n_rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS n_distinct, "
    none = "CAST(NULL AS DOUBLE) AS min_value, CAST(NULL AS DOUBLE) AS max_value, "
    if dtype == "string":
        return head + none + f"CAST(coalesce(sum(strlen({c})), 0) AS BIGINT) AS text_bytes, 'string' AS to_type, count(DISTINCT {c}) < 0.5 * count(*) AS is_categorical FROM {source}"
    if dtype == "date":
        return head + none + f"CAST(0 AS BIGINT) AS text_bytes, 'date' AS to_type, false AS is_categorical FROM {source}"
    return head + _range(c, dtype) + f" FROM {source}"


def _range(c: str, dtype: str) -> str:
    to = "'float'" if dtype == "double" else (
        f"CASE WHEN min({c}) >= -128 AND max({c}) <= 127 THEN 'tinyint' WHEN min({c}) >= -32768 AND max({c}) <= 32767 THEN 'smallint' ELSE 'int' END"
    )
    ends = ", ".join(f"round6(CAST({f}({c}) AS DOUBLE)) + 0.0 AS {f}_value" for f in ("min", "max"))
    return f"{ends}, CAST(0 AS BIGINT) AS text_bytes, {to} AS to_type, false AS is_categorical"


def _wide_facts(table: str, cut: str) -> str:
    """Ids of the wide table, and one row per day column."""
    ids = "(SELECT item_id || '_' || store_id AS id, * FROM series)"
    parts = [_fact(table, ids, i, c, "string") for i, c in enumerate(["id", *[c for c, _ in _ID_COLS]], 1)]
    parts.append(
        f"SELECT '{table}', CAST(7 + day_num - lo AS INTEGER), 'd_' || day_num, 'bigint', count(*), 0, count(DISTINCT sales), {_range('sales', 'bigint')} "
        f"FROM dense, bounds WHERE {cut} GROUP BY day_num, lo"
    )
    return " UNION ALL ".join(parts)


_CAL_ALL = [("date", "date"), *_CAL_COLS]
_FACTS = " UNION ALL ".join(
    [_fact("calendar", "calendar", i, c, t) for i, (c, t) in enumerate(_CAL_ALL, 1)]
    + [
        _fact("calendar", f'(SELECT CAST(dom <= 10 + {i} AS INTEGER) AS "snap_{s}" FROM calendar)', len(_CAL_ALL) + 1 + i, f"snap_{s}", "int")
        for i, s in enumerate(_STATES)
    ]
    + [_wide_facts("sales_validation", "day_num <= train_to"), _wide_facts("sales_evaluation", "true")]
    + [_fact("sell_prices", "prices", i, c, t) for i, (c, t) in enumerate(_PRICE_COLS, 1)]
    + [_fact("sample_submission", "(SELECT item_id || '_' || store_id AS id FROM series)", 1, "id", "string")]
    + [_fact("sample_submission", f'(SELECT 0.0::DOUBLE AS "F{h}" FROM series)', 1 + h, f"F{h}", "double") for h in range(1, 29)]
)
_BODIES["audit_columns"] = _FACTS
_WIDTH = "CASE {t} WHEN 'tinyint' THEN 1 WHEN 'smallint' THEN 2 WHEN 'bigint' THEN 8 WHEN 'double' THEN 8 ELSE 4 END"
_BODIES["audit_datasets"] = f"""
    SELECT coalesce(table_name, 'TOTAL') AS table_name, CAST(sum(n_rows) AS BIGINT) AS n_rows, CAST(sum(n_columns) AS BIGINT) AS n_columns,
           CAST(sum(b) AS BIGINT) AS bytes_before, CAST(sum(a) AS BIGINT) AS bytes_after,
           round6(100.0 * CAST(sum(b) - sum(a) AS DOUBLE) / CAST(sum(b) AS DOUBLE)) + 0.0 AS pct_saved
    FROM (SELECT table_name, max(n_rows) AS n_rows, count(*) AS n_columns,
                 sum(CASE WHEN dtype = 'string' THEN text_bytes ELSE n_rows * {_WIDTH.format(t='dtype')} END) AS b,
                 sum(CASE WHEN is_categorical THEN n_rows * CASE WHEN n_distinct <= 127 THEN 1 WHEN n_distinct <= 32767 THEN 2 ELSE 4 END
                          WHEN dtype = 'string' THEN text_bytes ELSE n_rows * {_WIDTH.format(t='to_type')} END) AS a
          FROM ({_FACTS}) GROUP BY table_name)
    GROUP BY ROLLUP (table_name)"""

_BODIES["dtype_summary"] = f"""
    SELECT dtype, count(*) AS n_columns, CAST(sum(nulls) AS BIGINT) AS nulls FROM ({_BODIES['column_profile']}) GROUP BY dtype"""

# Queries over the last 500 days: the same statements over tables cut to them.
_WINDOWED = (
    "panel_long", "unpivot_wide", "lag_features", "rolling_features", "price_momentum", "priced_never_sold_in_window",
    "window_presence", "size_estimate", "csv_load", "metrics_report", "boosted_first_gains", "features_in_steps",
    "audit_columns", "audit_datasets",
)


def _windowed_tables() -> dict[str, str]:
    """The tables with the bounds of the window, for those that depend on the bounds."""
    cut = {"bounds": CTES["bounds"].replace("min(day_num) AS lo", f"greatest(min(day_num), max(day_num) - {WINDOW_DAYS} + 1) AS lo")}
    return {**CTES, **cut}


def _expand_round6(sql: str) -> str:
    """round6(x) stands for x, nudged away from zero by 1e-10, to six decimals."""
    while (at := sql.find("round6(")) >= 0:
        end, depth = at + len("round6("), 1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        x = sql[at + len("round6(") : end - 1]
        sql = f"{sql[:at]}round(({x}) + sign({x}) * 1e-10::DOUBLE, 6){sql[end:]}"
    return sql


ORACLES = {
    name: _expand_round6(_with(body, _windowed_tables() if name in _WINDOWED else CTES)) for name, body in _BODIES.items()
}
