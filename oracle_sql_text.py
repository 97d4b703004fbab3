"""DuckDB SQL for the correctness oracle (driver compares it with Spark).

Written independently of the Spark code path:
* stand-in inputs use DuckDB ``GROUPING SETS`` and a brute-force distinct
  count for month-to-date users (a join of each day with its month's rows);
* the metric series is the 37-branch ``UNION ALL`` at row grain, with
  window running sums where ties are peers (no bucketed scan);
* lookups are the conditional aggregate over all rows on/after the history
  start (no role-date join);
* decimal columns are exact integer arithmetic in HUGEINT (cents) with
  explicit half-up division, reproducing Spark's decimal result scales.
"""

from __future__ import annotations

import datetime as dt

# Fixed values, stated here again so that the oracle doesn't depend on the package under test.
ALL = 10000
ENTRY_TYPE_CODES = [71, 73, 64, 29, 28, 30, 31, 91, 14, 15]
SEGMENT_CODES = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4, "MACHINERY": 5}
EVENT_TYPE_CODES = {"click": 1, "error": 2, "purchase": 3, "signup": 4, "view": 5}
EVENT_FEATURE = {"click": 6, "error": 7, "purchase": 5, "signup": 7, "view": 6}


def py_month_start(day: dt.date) -> dt.date:
    return dt.date(day.year, day.month, 1)


def py_add_months(first: dt.date, k: int) -> dt.date:
    """``k`` months from the first of a month."""
    assert first.day == 1
    year, month = divmod(first.year * 12 + first.month - 1 + k, 12)
    return dt.date(year, month + 1, 1)


def run_window(base: dt.date) -> tuple[dt.date, dt.date]:
    """The days that a run on ``base`` recomputes: yesterday, or on a 1st the month before."""
    return (py_add_months(base, -1) if base.day == 1 else base - dt.timedelta(days=1)), base


KEYS = "feature, measure, period, entity, currency"


def d(day: dt.date) -> str:
    return f"DATE '{day.isoformat()}'"


def ts(day: dt.date) -> str:
    return f"TIMESTAMP '{day.isoformat()} 00:00:00'"


def case_map(col: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in mapping.items())
    return f"(CASE {col} {whens} END)"


# --------------------------------------------------------------- integers ----

def hu(n: str, den: str) -> str:
    """Half-up (away from zero) integer division n/den; NULL if den is NULL."""
    return (f"(sign({n}) * sign({den}) * ((2 * abs({n}) + abs({den})) // (2 * abs({den}))))")


def as_dec(scaled: str, scale: int, precision: int, int_digits: int = 31) -> str:
    """Integer holding value*10^scale -> DECIMAL(precision, scale), exactly."""
    unit = "0." + "0" * (scale - 1) + "1" if scale > 0 else "1"
    p_unit = scale + 1
    base_p = min(int_digits, 38 - p_unit)
    return (f"CAST(CAST({scaled} AS DECIMAL({base_p},0)) * CAST({unit} AS DECIMAL({p_unit},{scale}))"
            f" AS DECIMAL({precision},{scale}))")


def cents(col: str) -> str:
    return f"CAST(CAST({col} AS DECIMAL(31,2)) * CAST(100 AS DECIMAL(3,0)) AS HUGEINT)"


# ---------------------------------------------------------------- inputs -----

def lineitem_cte(since: dt.date | None) -> str:
    where = f"WHERE l_shipdate >= {ts(since)}" if since else ""
    return f"""li AS (
  SELECT CAST(l_shipdate AS DATE) AS date, l_orderkey, l_suppkey, l_linestatus, l_returnflag,
         CAST(l_extendedprice AS DECIMAL(20,2)) AS price, CAST(l_quantity AS DECIMAL(20,2)) AS qty
  FROM lineitem {where})"""


def card_daily_cte() -> str:
    return """card_daily AS (
  SELECT date,
    CAST(SUM(CASE WHEN l_linestatus = 'O' THEN price END) AS DECIMAL(20,2)) AS online_volume,
    CAST(SUM(CASE WHEN l_linestatus = 'F' THEN price END) AS DECIMAL(20,2)) AS offline_volume,
    CAST(SUM(CASE WHEN l_linestatus = 'O' THEN 1 END) AS DECIMAL(20,2)) AS online_count,
    CAST(SUM(CASE WHEN l_linestatus = 'F' THEN 1 END) AS DECIMAL(20,2)) AS offline_count
  FROM li GROUP BY date)"""


def entry_type_cte() -> str:
    codes = ", ".join(str(c) for c in ENTRY_TYPE_CODES)
    return f"""etd0 AS (
  SELECT date, CAST([{codes}][(l_suppkey % 10) + 1] AS INTEGER) AS type_code,
         CAST(SUM(price) AS DECIMAL(20,2)) AS volume, CAST(SUM(qty) AS DECIMAL(20,2)) AS fee
  FROM li GROUP BY ALL),
entry_type_daily AS (
  SELECT date, type_code, volume,
    CAST(SUM(volume) OVER (PARTITION BY type_code, date_trunc('month', date) ORDER BY date) AS DECIMAL(20,2)) AS volume_mtd,
    fee,
    CAST(SUM(fee) OVER (PARTITION BY type_code, date_trunc('month', date) ORDER BY date) AS DECIMAL(20,2)) AS fee_mtd
  FROM etd0)"""


def fee_rows_cte(since: dt.date | None) -> str:
    where = f"WHERE o_orderdate >= {ts(since)}" if since else ""
    return f"""fee_rows AS (
  SELECT o_orderdate AS created_at, CAST(o_totalprice AS DECIMAL(20,2)) AS fee FROM orders {where})"""


def _subsets(dims: list[str]) -> list[list[str]]:
    import itertools
    out = []
    for r in range(len(dims), -1, -1):
        out.extend([list(c) for c in itertools.combinations(dims, r)])
    return out


def _cube_ctes(name: str, detail: str, time_col: str, dims: list[str], rolled: list[str],
               prefix: list[str], user: str, net: bool, month_expr: str) -> str:
    """Grouping-set cube + brute-force month-to-date distinct users."""
    sets = _subsets(rolled)
    gsets = ", ".join("(" + ", ".join(prefix + [time_col] + s) + ")" for s in sets)
    sel_dims = ", ".join(
        (f"COALESCE({c}, {ALL}) AS {c}" if c in rolled else f"{ALL} AS {c}") for c in dims)
    pre = "".join(f"{p}, " for p in prefix)
    net_sel = ", CAST(SUM(net) AS DECIMAL(20,2)) AS net_volume_daily" if net else ""
    # each detail row, once per slice it belongs to
    member = " UNION ALL ".join(
        f"SELECT {pre}{time_col}, {month_expr.format(t=time_col)} AS m, {user}, "
        + ", ".join((c if c in s else f"{ALL}") + f" AS {c}" for c in dims)
        + f" FROM {detail}" for s in sets)
    on_dims = " AND ".join(f"x.{c} = c.{c}" for c in prefix + dims)
    part = ", ".join(prefix + dims)
    return f"""{name}_daily AS (
  SELECT {pre}{time_col}, {sel_dims}, COUNT(DISTINCT {user}) AS users_daily, COUNT(*) AS tx_daily{net_sel}
  FROM {detail} GROUP BY GROUPING SETS ({gsets})),
{name}_member AS ({member}),
{name}_users AS (
  SELECT {"".join(f"c.{p}, " for p in prefix)}c.{time_col}, {", ".join("c." + x for x in dims)}, COUNT(DISTINCT x.{user}) AS users_mtd
  FROM {name}_daily c JOIN {name}_member x
    ON {on_dims} AND x.m = {month_expr.format(t="c." + time_col)} AND x.{time_col} <= c.{time_col}
  GROUP BY ALL),
{name} AS (
  SELECT {"".join(f"c.{p}, " for p in prefix)}c.{time_col}, {", ".join("c." + x for x in dims)}, c.users_daily, u.users_mtd, c.tx_daily,
    CAST(SUM(c.tx_daily) OVER (PARTITION BY {", ".join("c." + x for x in prefix + dims)}, {month_expr.format(t="c." + time_col)} ORDER BY c.{time_col}) AS BIGINT) AS tx_mtd
    {(", c.net_volume_daily, CAST(SUM(c.net_volume_daily) OVER (PARTITION BY " + ", ".join("c." + x for x in prefix + dims) + ", " + month_expr.format(t="c." + time_col) + " ORDER BY c." + time_col + ") AS DECIMAL(20,2)) AS net_volume_mtd") if net else ""}
  FROM {name}_daily c JOIN {name}_users u USING ({", ".join(prefix + [time_col] + dims)}))"""


ACC_DIMS = ["acceptor_id", "category_id", "is_abroad", "is_offline"]
HOUR_DIMS = ["group_id", "company_id"]


def acceptor_cube_cte(full: bool) -> str:
    detail = f"""acc_detail AS (
  SELECT li.date, CAST(s_suppkey AS INTEGER) AS acceptor_id,
         CAST({case_map('c_mktsegment', SEGMENT_CODES)} AS INTEGER) AS category_id,
         CAST(c_nationkey <> s_nationkey AS INTEGER) AS is_abroad,
         CAST(l_linestatus = 'F' AS INTEGER) AS is_offline,
         o_custkey,
         CASE WHEN l_returnflag = 'R' THEN -price ELSE price END AS net
  FROM li JOIN orders ON l_orderkey = o_orderkey
          JOIN customer ON o_custkey = c_custkey
          JOIN supplier ON l_suppkey = s_suppkey)"""
    rolled = ACC_DIMS if full else ["is_abroad", "is_offline"]
    return detail + ",\n" + _cube_ctes("acceptor_cube", "acc_detail", "date", ACC_DIMS, rolled,
                                       [], "o_custkey", True, "date_trunc('month', {t})")


def hourly_cube_cte(since: dt.date | None, full: bool) -> str:
    where = f"WHERE ts >= {ts(since)}" if since else ""
    detail = f"""ev_detail AS (
  SELECT CAST({case_map('event_type', EVENT_FEATURE)} AS INTEGER) AS feature,
         date_trunc('hour', ts) AS hour,
         CAST({case_map('event_type', EVENT_TYPE_CODES)} AS INTEGER) AS group_id,
         CAST(user_id % 10 + 1 AS INTEGER) AS company_id,
         user_id
  FROM events {where})"""
    rolled = HOUR_DIMS if full else []
    body = _cube_ctes("hourly_cube0", "ev_detail", "hour", HOUR_DIMS, rolled, ["feature"],
                      "user_id", False, "date_trunc('month', {t})")
    return detail + ",\n" + body + """,
hourly_cube AS (
  SELECT feature, hour, group_id, company_id, users_daily AS users_hourly, users_mtd,
         tx_daily AS tx_hourly, tx_mtd FROM hourly_cube0)"""


# ---------------------------------------------------------------- series -----

def _tag(f: int, m: int, e: int) -> str:
    return f"{f} AS feature, {m} AS measure, 0 AS period, {e} AS entity, 0 AS currency"


def card_branches(since: dt.date | None) -> list[str]:
    where = f"WHERE date >= {d(since)}" if since else ""
    out = []
    for m, (a, b) in ((5, ("online_volume", "offline_volume")), (4, ("online_count", "offline_count"))):
        v = (f"CAST(COALESCE({a}, 0) AS DECIMAL(20,2)) + CAST(COALESCE({b}, 0) AS DECIMAL(20,2))")
        out.append(f"SELECT date, {_tag(0, m, 2)}, {v} AS value, "
                   f"SUM({v}) OVER (PARTITION BY year(date), month(date) ORDER BY date) AS value_ptd "
                   f"FROM card_daily {where}")
    return out


def fee_branch(since: dt.date | None) -> list[str]:
    where = f"WHERE created_at >= {ts(since)}" if since else ""
    return [f"SELECT CAST(created_at AS DATE) AS date, {_tag(3, 6, 2)}, "
            f"CAST(COALESCE(fee, 0) AS DECIMAL(20,2)) AS value, "
            f"CAST(SUM(COALESCE(fee, 0)) OVER (PARTITION BY year(created_at), month(created_at) "
            f"ORDER BY created_at) AS DECIMAL(20,2)) AS value_ptd FROM fee_rows {where}"]


CODED = [  # feature, measure, codes, value col, mtd col
    (1, 5, (71, 73), "volume", "volume_mtd"), (2, 5, (64,), "volume", "volume_mtd"),
    (4, 5, (29,), "volume", "volume_mtd"), (5, 5, (28,), "volume", "volume_mtd"),
    (6, 5, (30,), "volume", "volume_mtd"), (7, 5, (31,), "volume", "volume_mtd"),
    (8, 5, (91,), "volume", "volume_mtd"), (15, 5, (14,), "volume", "volume_mtd"),
    (16, 5, (15,), "volume", "volume_mtd"), (15, 6, (14,), "fee", "fee_mtd"),
]


def coded_branches(since: dt.date | None) -> list[str]:
    lower = f" AND date >= {d(since)}" if since else ""
    return [f"SELECT date, {_tag(f, m, 0)}, "
            f"CAST(COALESCE(SUM({v}), 0) AS DECIMAL(20,2)) AS value, "
            f"CAST(COALESCE(SUM({p}), 0) AS DECIMAL(20,2)) AS value_ptd "
            f"FROM entry_type_daily WHERE type_code IN ({', '.join(map(str, codes))}){lower} GROUP BY date"
            for f, m, codes, v, p in CODED]


SLICES = [(9, ALL, 1), (10, ALL, 0), (11, 0, ALL), (12, 1, ALL), (13, 1, 0), (14, 1, 1)]
CUBE_MEAS = [(5, "ABS(net_volume_daily)", "ABS(net_volume_mtd)"),
             (0, "users_daily", "users_mtd"), (4, "tx_daily", "tx_mtd")]


def cube_branches(since: dt.date | None) -> list[str]:
    lower = f" AND date >= {d(since)}" if since else ""
    out = []
    for m, v, p in CUBE_MEAS:
        for f, ab, off in SLICES:
            out.append(
                f"SELECT date, {_tag(f, m, 0)}, CAST(COALESCE(SUM({v}), 0) AS DECIMAL(20,2)) AS value, "
                f"CAST(COALESCE(SUM({p}), 0) AS DECIMAL(20,2)) AS value_ptd FROM acceptor_cube "
                f"WHERE acceptor_id = {ALL} AND category_id = {ALL} AND is_abroad = {ab} "
                f"AND is_offline = {off}{lower} GROUP BY date")
    return out


def hourly_branches(since: dt.date | None) -> list[str]:
    lower = f" AND hour >= {ts(since)}" if since else ""
    out = []
    for f in (5, 6, 7):
        for m, v, p in ((0, "users_hourly", "users_mtd"), (4, "tx_hourly", "tx_mtd")):
            out.append(
                f"SELECT CAST(hour AS DATE) AS date, {_tag(f, m, 0)}, CAST(MAX({v}) AS DECIMAL(20,2)) AS value, "
                f"CAST(MAX({p}) AS DECIMAL(20,2)) AS value_ptd FROM hourly_cube "
                f"WHERE group_id = {ALL} AND company_id = {ALL} AND feature = {f}{lower} "
                f"GROUP BY CAST(hour AS DATE)")
    return out


def inputs_ctes(since: dt.date | None, parts: set[str], full_cubes: bool = False) -> list[str]:
    ctes = []
    if parts & {"card", "coded", "cube"}:
        ctes.append(lineitem_cte(since))
    if "card" in parts:
        ctes.append(card_daily_cte())
    if "coded" in parts:
        ctes.append(entry_type_cte())
    if "fee" in parts:
        ctes.append(fee_rows_cte(since))
    if "cube" in parts:
        ctes.append(acceptor_cube_cte(full_cubes))
    if "hourly" in parts:
        ctes.append(hourly_cube_cte(since, full_cubes))
    return ctes


ALL_PARTS = ("card", "coded", "fee", "cube", "hourly")


def series_ctes(since: dt.date | None, parts=ALL_PARTS) -> list[str]:
    """CTEs ending in ``series_rows`` (row grain, as the 37 branches give)."""
    branches = []
    if "card" in parts:
        branches += card_branches(since)
    if "coded" in parts:
        branches += coded_branches(since)
    if "fee" in parts:
        branches += fee_branch(since)
    if "cube" in parts:
        branches += cube_branches(since)
    if "hourly" in parts:
        branches += hourly_branches(since)
    union = "\n  UNION ALL ".join(branches)
    return inputs_ctes(since, set(parts)) + [f"series_rows AS (\n  {union})"]


def daily_series_select() -> str:
    return (f"SELECT date, {KEYS}, CAST(MAX(value) AS DECIMAL(21,2)) AS value, "
            f"CAST(MAX(value_ptd) AS DECIMAL(31,2)) AS value_ptd FROM series_rows GROUP BY ALL")


def with_(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


# ----------------------------------------------------------------- spine -----

def spine_select(anchor_expr_source: str, own_month_shift: bool = False) -> str:
    """Spine columns over a relation with a DATE column ``a``."""
    m3_shift = "least(day(e0) - day(e3), 0)" if own_month_shift else "least(day(e0) - day(e1), 0)"
    return f"""SELECT a AS anchor, s0 AS period_start, CAST(s0 - INTERVAL 3 MONTH AS DATE) AS history_start,
  CAST(day(e0) AS INTEGER) AS days_in_month,
  CAST(a - INTERVAL 1 MONTH AS DATE) AS p1, CAST(a - INTERVAL 2 MONTH AS DATE) AS p2,
  CAST(a - INTERVAL 3 MONTH AS DATE) AS p3,
  e0, e1, e2, e3,
  CAST(e1 + CAST(least(day(e0) - day(e1), 0) AS INTEGER) AS DATE) AS m1,
  CAST(e2 + CAST(least(day(e0) - day(e2), 0) AS INTEGER) AS DATE) AS m2,
  CAST(e3 + CAST({m3_shift} AS INTEGER) AS DATE) AS m3,
  CAST(greatest(day(e0) - day(e1), 0) AS INTEGER) AS x1,
  CAST(greatest(day(e0) - day(e2), 0) AS INTEGER) AS x2,
  CAST(greatest(day(e0) - day(e3), 0) AS INTEGER) AS x3
FROM (SELECT a, s0, last_day(a) AS e0,
        last_day(CAST(s0 - INTERVAL 1 MONTH AS DATE)) AS e1,
        last_day(CAST(s0 - INTERVAL 2 MONTH AS DATE)) AS e2,
        last_day(CAST(s0 - INTERVAL 3 MONTH AS DATE)) AS e3
      FROM (SELECT a, CAST(date_trunc('month', a) AS DATE) AS s0 FROM {anchor_expr_source}))"""


def anchors_between(lo: dt.date, hi: dt.date) -> str:
    return (f"(SELECT CAST(g AS DATE) AS a FROM generate_series({d(lo)}, "
            f"{d(hi - dt.timedelta(days=1))}, INTERVAL 1 DAY) t(g))")


# --------------------------------------------------------------- forecast ----

P_ROLES = {"anchor": "anchor", "p1": "p1", "p2": "p2", "p3": "p3", "m1": "m1", "m2": "m2",
           "m3": "m3", "e0": "e0", "e1": "e1", "e2": "e2", "e3": "e3"}
V_ROLES = ["e1", "e2", "e3"]


def role_lookup_ctes(anchor_rel: str) -> list[str]:
    """Role-date form: spine unpivoted to (anchor, role, day), equi-joined on
    the day; series alive from their last day. For long anchor ranges."""
    roles = " UNION ALL ".join(
        f"SELECT anchor, history_start, x1, x2, x3, days_in_month, '{k}' AS role, {r} AS d FROM spine"
        for k, r in P_ROLES.items())
    keys = KEYS.split(", ")
    p = ",\n    ".join(f"MAX(CASE WHEN role = '{k}' THEN value_ptd END) AS P_{k}" for k in P_ROLES)
    v = ",\n    ".join(f"MAX(CASE WHEN role = '{r}' THEN value END) AS V_{r}" for r in V_ROLES)
    return [
        f"spine AS ({spine_select(anchor_rel)})",
        f"roles AS ({roles})",
        f"""daily_rows AS MATERIALIZED (
  SELECT date, {KEYS}, MAX(value) AS value, MAX(value_ptd) AS value_ptd FROM series_rows GROUP BY ALL)""",
        f"""hits AS (
  SELECT r.anchor, r.x1, r.x2, r.x3, r.days_in_month, {", ".join("s." + k for k in keys)}, r.role, s.value, s.value_ptd
  FROM roles r JOIN daily_rows s ON s.date = r.d)""",
        f"""alive AS (
  SELECT sp.anchor, sp.x1, sp.x2, sp.x3, sp.days_in_month, {", ".join("k." + c for c in keys)},
         CAST(NULL AS VARCHAR) AS role, CAST(NULL AS DECIMAL(21,2)) AS value, CAST(NULL AS DECIMAL(31,2)) AS value_ptd
  FROM spine sp JOIN (SELECT {KEYS}, MAX(date) AS last_date FROM daily_rows GROUP BY ALL) k
    ON k.last_date >= sp.history_start)""",
        f"""lookups AS (
  SELECT anchor AS date, x1, x2, x3, days_in_month, {KEYS},
    {p},
    {v}
  FROM (SELECT * FROM hits UNION ALL SELECT * FROM alive)
  GROUP BY ALL)""",
    ]


def lookup_ctes(lo: dt.date, hi: dt.date, own_month_shift: bool = False) -> list[str]:
    """Conditional aggregate over every series row on/after the history start."""
    p = ",\n    ".join(f"MAX(CASE WHEN s.date = sp.{r} THEN s.value_ptd END) AS P_{k}"
                       for k, r in P_ROLES.items())
    v = ",\n    ".join(f"MAX(CASE WHEN s.date = sp.{r} THEN s.value END) AS V_{r}" for r in V_ROLES)
    return [
        f"spine AS ({spine_select(anchors_between(lo, hi), own_month_shift)})",
        f"""lookups AS (
  SELECT sp.anchor AS date, sp.x1, sp.x2, sp.x3, sp.days_in_month, {", ".join("s." + k for k in KEYS.split(", "))},
    {p},
    {v}
  FROM spine sp JOIN series_rows s ON s.date >= sp.history_start
  GROUP BY ALL)""",
    ]


def arithmetic_ctes() -> list[str]:
    """Cents and exact half-up integer steps for every decimal column."""
    c = {f"P_{k}": cents(f"CAST(P_{k} AS DECIMAL(31,2))") for k in P_ROLES}
    c.update({f"V_{r}": cents(f"CAST(V_{r} AS DECIMAL(21,2))") for r in V_ROLES})
    cents_cols = ",\n    ".join(f"{expr} AS c_{name}" for name, expr in c.items())
    adj = {k: f"(c_P_m{k} + CASE WHEN x{k} > 0 THEN x{k} * c_V_e{k} ELSE 0 END)" for k in (1, 2, 3)}
    step1 = ",\n    ".join(
        [f"{adj[k]} AS adj{k}" for k in (1, 2, 3)])
    rate6 = {k: f"COALESCE({hu(f'c_P_p{k} * 1000000', f'NULLIF(adj{k}, 0)')}, 0)" for k in (1, 2, 3)}
    step2 = ",\n    ".join(
        [f"{rate6[k]} AS r6_{k}" for k in (1, 2, 3)]
        + [f"COALESCE({hu('c_P_p1 * CAST(10000000000000000 AS HUGEINT)', 'NULLIF(adj1, 0)')}, 0) AS r16_1"])
    step3 = ",\n    ".join([
        f"COALESCE({hu('c_P_anchor * 10000000000', 'NULLIF(r6_1, 0)')}, 0) AS e1_6",
        f"COALESCE({hu('c_P_anchor * 10000000000', 'NULLIF(r6_2, 0)')}, 0) AS e2_6",
        f"COALESCE({hu('c_P_anchor * adj3 * 10000', 'NULLIF(c_P_p3, 0)')}, 0) AS e3_6",
    ])
    step4 = ",\n    ".join([
        f"{hu('e1_6 + e2_6 + e3_6', '3')} AS mean_6",
        f"{hu('e1_6', '10000')} AS c_exp1",
        f"{hu('e2_6', '10000')} AS c_exp2",
        f"{hu('e3_6', '10000')} AS c_exp3",
        f"{hu('CAST(days_in_month AS HUGEINT) * c_P_anchor * 100000000000', 'CAST(day(date) AS HUGEINT)')} AS lin13",
    ])
    step5 = ",\n    ".join([
        f"{hu('mean_6', '10000')} AS c_mean",
        f"{hu('lin13 - c_P_e0 * 100000000000', '10')} AS lin12",
    ])
    step6 = ",\n    ".join([
        f"{hu('lin12', '100')} AS lin10",
    ])
    return [
        f"ar0 AS (SELECT *,\n    {cents_cols}\n  FROM lookups)",
        f"ar1 AS (SELECT *,\n    {step1}\n  FROM ar0)",
        f"ar2 AS (SELECT *,\n    {step2}\n  FROM ar1)",
        f"ar3 AS (SELECT *,\n    {step3}\n  FROM ar2)",
        f"ar4 AS (SELECT *,\n    {step4}\n  FROM ar3)",
        f"ar5 AS (SELECT *,\n    {step5}\n  FROM ar4)",
        f"ar6 AS (SELECT *,\n    {step6}\n  FROM ar5)",
    ]


def money(scaled: str, precision: int = 20) -> str:
    return as_dec(scaled, 2, precision)


def final_columns() -> dict[str, str]:
    """Output column -> SQL over ``ar6`` (exact Spark types)."""
    cols = {"date": "date"}
    for k in KEYS.split(", "):
        cols[k] = f"CAST({k} AS INTEGER)"
    realised = "CAST(P_e0 AS DECIMAL(31,2))"
    cols.update({
        "ptd": "CAST(P_anchor AS DECIMAL(31,2))",
        "ptd_m1": "CAST(P_p1 AS DECIMAL(31,2))",
        "eop_adj_m1": money("adj1", 33),
        "rate_m1": as_dec("r16_1", 16, 38, 21),
        "exp_m1": money("c_exp1"),
        "eop_realised": realised,
        "eop_m1": "CAST(P_e1 AS DECIMAL(31,2))",
        "eop_adj_m2": money("adj2", 33),
        "rate_m2": as_dec("r6_2", 6, 20),
        "exp_m2": money("c_exp2"),
        "eop_m2": "CAST(P_e2 AS DECIMAL(31,2))",
        "ptd_m3": "CAST(P_p3 AS DECIMAL(31,2))",
        "eop_adj_m3": money("adj3", 33),
        "rate_m3": as_dec("r6_3", 6, 20),
        "exp_m3": money("c_exp3"),
        "eop_m3": "CAST(P_e3 AS DECIMAL(31,2))",
        "exp_mean": money("c_mean"),
    })
    dev = [f"CAST({money(f'c_exp{k} - c_mean', 21)} AS DOUBLE)" for k in (1, 2, 3)]
    std = f"sqrt(({dev[0]} * {dev[0]} + {dev[1]} * {dev[1]} + {dev[2]} * {dev[2]}) / 3)"
    cols["exp_std"] = std
    for name, centre in (("exp_m1", "c_exp1"), ("exp_m2", "c_exp2"), ("exp_m3", "c_exp3"),
                         ("exp_mean", "c_mean")):
        cols[f"{name}_lo"] = f"(CAST({money(centre)} AS DOUBLE) - {std})"
        cols[f"{name}_hi"] = f"(CAST({money(centre)} AS DOUBLE) + {std})"
    for k in (1, 2, 3):
        err = f"(c_exp{k} - c_P_e0)"
        cols[f"err_m{k}"] = money(err, 32)
        cols[f"err_rate_m{k}"] = as_dec(
            f"COALESCE({hu(f'{err} * 1000000', 'NULLIF(c_P_e0, 0)')}, 0)", 6, 20)
    cols["acc_prev_m1"] = "acc_prev_m1"
    cols["linear_exp"] = money(hu("lin13", "100000000000"))
    cols["linear_err"] = money(hu("lin12", "10000000000"))
    cols["linear_err_rate"] = as_dec(
        f"COALESCE({hu('lin10 * 1000000', 'NULLIF(c_P_e0 * 100000000, 0)')}, 0)", 6, 38)
    cols["acc_prev_linear"] = "acc_prev_linear"
    return cols


OUTPUT = list(final_columns().keys())


def forecast_sql(lo: dt.date, hi: dt.date, columns: list[str] | None = None,
                 self_history: bool = True, own_month_shift: bool = False,
                 parts=ALL_PARTS, from_lo: bool = False) -> str:
    """Forecast rows of anchors ``[lo, hi)`` (previous month computed too, unless ``from_lo``)."""
    first = py_add_months(py_month_start(lo), -1) if self_history and not from_lo else lo
    since = py_add_months(py_month_start(first), -3)
    ctes = series_ctes(since, parts) + lookup_ctes(first, hi, own_month_shift) + arithmetic_ctes()
    return _forecast_tail(ctes, f"date >= {d(lo)} AND date < {d(hi)}", columns, self_history)


def backfill_all_days_sql() -> str:
    """Every day of lineitem's ship-date range (plus the month before, for the
    look-back), role-date lookup form."""
    bounds = ("bounds AS (SELECT MIN(CAST(l_shipdate AS DATE)) AS lo, "
              "MAX(CAST(l_shipdate AS DATE)) AS hi FROM lineitem)")
    anchors = ("(SELECT CAST(g AS DATE) AS a FROM bounds, generate_series("
               "CAST(date_trunc('month', lo) - INTERVAL 1 MONTH AS DATE), hi, INTERVAL 1 DAY) t(g))")
    ctes = series_ctes(None) + [bounds] + role_lookup_ctes(anchors) + arithmetic_ctes()
    return _forecast_tail(ctes, "date >= (SELECT lo FROM bounds) AND date <= (SELECT hi FROM bounds)",
                          None, True)


def _forecast_tail(ctes: list[str], where: str, columns: list[str] | None,
                   self_history: bool) -> str:
    cols = final_columns()
    pre = {k: v for k, v in cols.items() if k not in ("acc_prev_m1", "acc_prev_linear")}
    body = ",\n  ".join(f"{v} AS {k}" for k, v in pre.items())
    ctes.append(f"fc AS MATERIALIZED (SELECT\n  {body}\nFROM ar6)")
    if self_history:
        keys_eq = " AND ".join(f"h.{k} = f.{k}" for k in KEYS.split(", "))
        ctes.append(f"""fc2 AS (
  SELECT f.*,
    CAST(ABS(1 - ABS(h.err_rate_m1)) AS DECIMAL(20,6)) AS acc_prev_m1,
    CAST(ABS(1 - ABS(h.linear_err_rate)) AS DECIMAL(20,6)) AS acc_prev_linear
  FROM fc f LEFT JOIN fc h ON h.date = CAST(f.date - INTERVAL 1 MONTH AS DATE) AND {keys_eq})""")
    else:
        ctes.append("fc2 AS (SELECT *, CAST(NULL AS DECIMAL(20,6)) AS acc_prev_m1, "
                    "CAST(NULL AS DECIMAL(20,6)) AS acc_prev_linear FROM fc)")
    want = columns or OUTPUT
    sel = ", ".join(want)
    return with_(ctes, f"SELECT {sel} FROM fc2 WHERE {where}")


def run_sql(base_day: str, columns: list[str] | None = None, **kw) -> str:
    lo, hi = run_window(dt.date.fromisoformat(base_day))
    return forecast_sql(lo, hi, columns, **kw)


def lookup_sql(base_day: str, parts=ALL_PARTS) -> str:
    lo, hi = run_window(dt.date.fromisoformat(base_day))
    since = py_add_months(py_month_start(lo), -3)
    ctes = series_ctes(since, parts) + lookup_ctes(lo, hi)
    cols = (["date", "x1", "x2", "x3", "days_in_month"] + KEYS.split(", ")
            + [f"CAST(P_{k} AS DECIMAL(31,2)) AS P_{k}" for k in P_ROLES]
            + [f"CAST(V_{r} AS DECIMAL(21,2)) AS V_{r}" for r in V_ROLES])
    return with_(ctes, "SELECT " + ", ".join(cols) + " FROM lookups")


# ------------------------------------------------------------- registry ------

BASES = {"feb": "1998-03-01", "mar": "1998-04-01", "sep": "1998-10-01", "mid": "1998-04-15"}
EVENTS_CLOSE = "2024-02-01"


def _spine_days_sql(own: bool) -> str:
    return ("WITH anchors AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS a FROM lineitem)\n"
            + spine_select("anchors", own))


WEEK_START_SQL = """WITH b AS (SELECT MIN(CAST(l_shipdate AS DATE)) AS lo, MAX(CAST(l_shipdate AS DATE)) AS hi FROM lineitem),
cal AS (SELECT CAST(g AS DATE) AS day FROM b, generate_series(b.lo, b.hi, INTERVAL 1 DAY) t(g)),
calw AS (SELECT day, CAST((CAST(date_trunc('week', day) AS DATE) - DATE '1970-01-05') // 7 AS INTEGER) AS week_id FROM cal),
firsts AS (SELECT week_id, MIN(day) AS week_start FROM calw GROUP BY week_id),
od AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT od.day, f.week_start, CAST(f.week_start - INTERVAL 7 DAY AS DATE) AS prev_week_start
FROM od LEFT JOIN calw USING (day) LEFT JOIN firsts f USING (week_id)"""


CALENDAR_SQL = """WITH b AS (SELECT MIN(CAST(l_shipdate AS DATE)) AS lo, MAX(CAST(l_shipdate AS DATE)) AS hi FROM lineitem)
SELECT CAST(g AS DATE) AS day,
       CAST((CAST(date_trunc('week', CAST(g AS DATE)) AS DATE) - DATE '1970-01-05') // 7 AS INTEGER) AS week_id
FROM b, generate_series(b.lo, b.hi, INTERVAL 1 DAY) t(g)"""


def _row_mtd_sql(table: str, key: str, ts_col: str, val: str) -> str:
    price = f"CAST({val} AS DECIMAL(20,2))"
    return f"""SELECT {key}, date, CAST(MAX(price) AS DECIMAL(21,2)) AS value,
  CAST(MAX(ptd) AS DECIMAL(31,2)) AS value_ptd
FROM (SELECT {key}, CAST({ts_col} AS DATE) AS date, {price} AS price,
        SUM({price}) OVER (PARTITION BY {key}, year({ts_col}), month({ts_col}) ORDER BY {ts_col}) AS ptd
      FROM {table})
GROUP BY ALL"""


COLUMN_SETS = {
    "rates": ["date", *KEYS.split(", "), "eop_adj_m1", "rate_m1", "eop_adj_m2", "rate_m2",
              "eop_adj_m3", "rate_m3"],
    "expected": ["date", *KEYS.split(", "), "ptd", "ptd_m1", "ptd_m3", "exp_m1", "exp_m2",
                 "exp_m3", "exp_mean"],
    "bands": ["date", *KEYS.split(", "), "exp_mean", "exp_std", "exp_m1_lo", "exp_m1_hi",
              "exp_m2_lo", "exp_m2_hi", "exp_m3_lo", "exp_m3_hi", "exp_mean_lo", "exp_mean_hi"],
    "errors": ["date", *KEYS.split(", "), "eop_realised", "err_m1", "err_rate_m1", "err_m2",
               "err_rate_m2", "err_m3", "err_rate_m3"],
    "linear": ["date", *KEYS.split(", "), "ptd", "eop_realised", "linear_exp", "linear_err",
               "linear_err_rate"],
    "lookback": ["date", *KEYS.split(", "), "err_rate_m1", "linear_err_rate", "acc_prev_m1",
                 "acc_prev_linear"],
    "all": None,
}


def _late_fees_sql(sql: str, late: str) -> str:
    """A query over fees to which late orders are added."""
    fees = "CAST(o_totalprice AS DECIMAL(20,2)) AS fee FROM orders"
    assert fees in sql
    return sql.replace(fees, f"CAST(o_totalprice AS DECIMAL(20,2)) AS fee FROM (SELECT * FROM orders UNION ALL {late})")


def _late_rows_sql() -> str:
    """The mid-April run with the fees of 3 April twice and a second report row on 17 February."""
    sql = _late_fees_sql(run_sql(BASES["mid"]), "SELECT * FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1998-04-03'")
    card = "AS offline_count\n  FROM li GROUP BY date)"
    assert card in sql
    return sql.replace(card, card[:-1] + " UNION ALL SELECT DATE '1998-02-17', 100, NULL, 1, NULL)")


def _late_end_sql() -> str:
    """Errors of the March close with March's fees once more on its last day."""
    return _late_fees_sql(run_sql(BASES["mar"], COLUMN_SETS["errors"]),
                          "SELECT * REPLACE (CAST(DATE '1998-03-31' AS TIMESTAMP) AS o_orderdate) FROM orders "
                          "WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-03-01' AND DATE '1998-03-31'")


def _quarantined_sql() -> str:
    """The planted rows that break the contract, by fact, day and reason."""
    since = py_add_months(py_month_start(run_window(dt.date.fromisoformat(BASES["mar"]))[0]), -4)
    kinds = [("card_daily", "date", 7, "repeated row", 1),
             ("card_daily", "NULL", 9, "no time", 1),
             ("entry_type_daily", "date", 11, "no member: type_code", 1),
             ("fee_rows", "NULL", 12, "no time", 1),
             ("acceptor_cube", "date", 13, "negative: tx_daily", 1),
             ("acceptor_cube", "date", 14, "above month to date: users_daily", 1),
             ("entry_type_daily", "date", 15, "conflicting key", 2)]
    parts = [f"SELECT '{fact}' AS fact, CAST({day} AS DATE) AS day, '{reason}' AS reason, "
             f"CAST({n} * COUNT(*) AS BIGINT) AS n_rows, CAST({n} * COUNT(*) AS BIGINT) AS n_copies "
             f"FROM {fact} WHERE day({'created_at' if fact == 'fee_rows' else 'date'}) = {on} "
             f"GROUP BY ALL HAVING COUNT(*) > 0"
             for fact, day, on, reason, n in kinds]
    return with_(inputs_ctes(since, {"card", "coded", "fee", "cube"}), "\nUNION ALL ".join(parts))


def _series_sql(parts) -> str:
    return with_(series_ctes(None, parts), daily_series_select())


def registry() -> dict[str, str]:
    q = {
        "spine_data_days": _spine_days_sql(False),
        "spine_data_days_own_shift": _spine_days_sql(True),
        "week_start_lookup": WEEK_START_SQL,
        "mtd_by_day": _row_mtd_sql("lineitem", "l_returnflag", "l_shipdate", "l_extendedprice"),
        "mtd_with_ties": _row_mtd_sql("orders", "o_orderpriority", "o_orderdate", "o_totalprice"),
        "calendar_days": CALENDAR_SQL,
        "fee_rows": with_(inputs_ctes(None, {"fee"}), "SELECT * FROM fee_rows"),
        "card_daily": with_(inputs_ctes(None, {"card"}), "SELECT * FROM card_daily"),
        "entry_type_daily": with_(inputs_ctes(None, {"coded"}), "SELECT * FROM entry_type_daily"),
        "acceptor_cube": with_(inputs_ctes(None, {"cube"}, full_cubes=True),
                               "SELECT * FROM acceptor_cube"),
        "hourly_cube": with_(inputs_ctes(None, {"hourly"}, full_cubes=True),
                             "SELECT * FROM hourly_cube"),
        "pair_totals": _series_sql(("card",)),
        "coded_series": _series_sql(("coded",)),
        "row_fee_series": _series_sql(("fee",)),
        "row_fee_fine": with_([
            "fee_rows AS (SELECT o_orderdate AS created_at, CAST(CAST(o_totalprice AS DECIMAL(20,2)) "
            "* CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(20,4)) AS fee FROM orders)",
            f"series_rows AS ({fee_branch(None)[0]})"], daily_series_select()),
        "cube_slice_series": _series_sql(("cube",)),
        "hourly_peak_series": _series_sql(("hourly",)),
        "metric_series_all": _series_sql(ALL_PARTS),
        "lookup_mar": lookup_sql(BASES["mar"]),
        "lookup_missing_days": lookup_sql(EVENTS_CLOSE, parts=("hourly",)),
        "pace_rates_mar": run_sql(BASES["mar"], COLUMN_SETS["rates"]),
        "pace_expected_feb": run_sql(BASES["feb"], COLUMN_SETS["expected"]),
        "pace_expected_mar": run_sql(BASES["mar"], COLUMN_SETS["expected"]),
        "pace_expected_sep": run_sql(BASES["sep"], COLUMN_SETS["expected"]),
        "pace_expected_mid": run_sql(BASES["mid"], COLUMN_SETS["expected"]),
        "bands_mar": run_sql(BASES["mar"], COLUMN_SETS["bands"]),
        "errors_closed_mar": run_sql(BASES["mar"], COLUMN_SETS["errors"]),
        "errors_open_mid": run_sql(BASES["mid"], COLUMN_SETS["errors"]),
        "linear_mar": run_sql(BASES["mar"], COLUMN_SETS["linear"]),
        "lookback_accuracy_mar": run_sql(BASES["mar"], COLUMN_SETS["lookback"]),
        "close_month_all": run_sql(BASES["mar"]),
        "close_month_sep_own_shift": run_sql(BASES["sep"], own_month_shift=True),
        "run_day_mid_all": run_sql(BASES["mid"]),
        "slice_rewrite_twice": run_sql(BASES["mar"], self_history=False),
        "close_two_months_stored": forecast_sql(dt.date(1998, 2, 1), dt.date(1998, 4, 1), from_lo=True),
        "slice_rewrite_drops_day": (f"SELECT * FROM ({run_sql(BASES['mar'], self_history=False)}) "
                                    "WHERE date <> DATE '1998-03-10'"),
        "close_month_from_facts": run_sql(BASES["mar"]),
        "run_day_from_store": run_sql(BASES["mid"]),
        "run_day_late_rows": _late_rows_sql(),
        "committed_rewrite_twice": run_sql(BASES["mar"], self_history=False),
        "committed_two_months": forecast_sql(dt.date(1998, 2, 1), dt.date(1998, 4, 1), from_lo=True),
        "backfill_pieces_resumed": forecast_sql(dt.date(1998, 2, 1), dt.date(1998, 4, 1)),
        "close_month_checked": run_sql(BASES["mar"]),
        "quarantined_rows": _quarantined_sql(),
        # events lie in a later year: series that were not known when the rows were stored
        "restated_month": ("SELECT * FROM ("
                           f"{forecast_sql(dt.date(1998, 3, 1), dt.date(1998, 4, 15), parts=('card', 'coded', 'fee', 'cube'))}"
                           ") WHERE date < DATE '1998-03-31' OR date = DATE '1998-04-14'"),
        "restated_late_rows": f"SELECT * FROM ({_late_end_sql()}) WHERE date < DATE '1998-03-31'",
        "backfill_two_months": forecast_sql(dt.date(1998, 2, 1), dt.date(1998, 4, 1)),
        "backfill_all_days": backfill_all_days_sql(),
    }
    return q


def forecast_from_series_sql(lo: dt.date, hi: dt.date) -> str:
    """Forecast (41 columns, no look-back) of anchors ``[lo, hi)`` over an
    existing relation ``series_rows`` (date, keys, value, value_ptd)."""
    ctes = lookup_ctes(lo, hi) + arithmetic_ctes()
    cols = {k: v for k, v in final_columns().items() if k not in ("acc_prev_m1", "acc_prev_linear")}
    body = ",\n  ".join(f"{v} AS {k}" for k, v in cols.items())
    return with_(ctes, f"SELECT\n  {body}\nFROM ar6")
