"""Independent DuckDB SQL for every SQL-expressible registered query."""

from __future__ import annotations

from smogcast.functions.categories import ADVICE, CATEGORY_COLORS, CATEGORY_NAMES
from smogcast.plans.sqlparts import (FEATURE_NAMES, K, OBS_CTE, category_sql, d, ewm_sql,
                                     feature_select, guarded, r6, split_cte, train_cte, win)

WS = 'ws AS (PARTITION BY series_key ORDER BY "Date")'
WEATHER = ["temp", "humidity", "precip", "windspeed", "sealevelpressure"]


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def name_sql(code: str) -> str:
    return f"list_extract({_list(CATEGORY_NAMES)}, {code} + 1)"


def color_sql(code: str) -> str:
    return f"list_extract({_list(CATEGORY_COLORS)}, {code} + 1)"


def with_obs(body: str, extra: str = "") -> str:
    ctes = OBS_CTE.strip()
    if extra:
        ctes += ",\n" + extra.strip()
    return f"WITH {ctes}\n{body}"


SQL: dict[str, str] = {}

SQL["daily_series"] = with_obs(f'SELECT series_key, "Date", {r6("AQI")} AS AQI, n_readings FROM series')

SQL["weather_join"] = with_obs(
    'SELECT series_key, "Date", ' + ", ".join(f"{r6(c)} AS {c}" for c in ["AQI"] + WEATHER) + " FROM obs")

SQL["lag_features"] = with_obs(
    'SELECT series_key, "Date", ' + r6("AQI") + " AS AQI, "
    + ", ".join(f"{r6(f'lag(AQI, {k}) OVER ws')} AS AQI_lag_{k}" for k in [1, 2, 3, 7, 14])
    + f" FROM obs WINDOW {WS}")

SQL["leak_shift"] = with_obs(
    'SELECT series_key, "Date", '
    + ", ".join(f"{r6(c)} AS {c}_raw" for c in ["AQI_roll_mean_7", "AQI_ewma_7", "AQI_diff_1"]) + ", "
    + ", ".join(f"{r6(f'lag({c}, 1) OVER ws')} AS {c}" for c in ["AQI_roll_mean_7", "AQI_ewma_7", "AQI_diff_1"])
    + f" FROM raw WINDOW {WS}",
    extra=f"""raw AS (SELECT series_key, "Date",
      {guarded("avg", "AQI", "wi7", 7)} AS AQI_roll_mean_7,
      {ewm_sql("AQI", "win_e")} AS AQI_ewma_7,
      AQI - lag(AQI, 1) OVER ws AS AQI_diff_1
    FROM obs WINDOW {WS}, {win("wi7", -6, 0)}, {win("win_e", -(K - 1), 0)})""")

SQL["diff_spike"] = with_obs(
    f'SELECT series_key, "Date", {r6("AQI")} AS AQI, {r6("AQI - lag(AQI, 1) OVER ws")} AS AQI_diff_1, '
    f'{r6("lag(AQI, 1) OVER ws - lag(AQI, 2) OVER ws")} AS AQI_delta_1, '
    "CAST(coalesce(abs(lag(AQI, 1) OVER ws - lag(AQI, 2) OVER ws) > 50.0::DOUBLE, false) AS INTEGER) AS is_spike "
    f"FROM obs WINDOW {WS}")

_roll = []
for _n in [3, 7, 14]:
    for _s, _f in [("mean", "avg"), ("std", "stddev_samp"), ("max", "max")]:
        _roll.append(f"{r6(guarded(_f, 'AQI', f'w{_n}', _n))} AS AQI_roll_{_s}_{_n}")
SQL["rolling_features"] = with_obs(
    f'SELECT series_key, "Date", {r6("AQI")} AS AQI, ' + ", ".join(_roll)
    + f" FROM obs WINDOW {win('w3', -3, -1)}, {win('w7', -7, -1)}, {win('w14', -14, -1)}")

SQL["ewm_feature"] = with_obs(
    f'SELECT series_key, "Date", {r6("AQI")} AS AQI, {r6(ewm_sql("AQI", "wi"))} AS ewma_inclusive, '
    f'{r6(ewm_sql("AQI", "wx"))} AS ewma_exclusive '
    f"FROM obs WINDOW {win('wi', -(K - 1), 0)}, {win('wx', -K, -1)}")


# The recursion itself, one step a row: mean so far and the weight it still has.
SQL["ewm_masked"] = with_obs(
    f'SELECT m.series_key, m."Date", {r6("m.AQI")} AS AQI, {r6("e.y")} AS ewma_inclusive, '
    f'{r6("lag(e.y, 1) OVER (PARTITION BY m.series_key ORDER BY m.rn)")} AS ewma_exclusive '
    "FROM m JOIN e ON m.series_key = e.series_key AND m.rn = e.rn",
    extra="""m AS (SELECT series_key, "Date", AQI, row_number() OVER (PARTITION BY series_key ORDER BY "Date") AS rn FROM masked),
e AS (SELECT series_key, rn, AQI AS y, 1.0::DOUBLE AS old FROM m WHERE rn = 1
      UNION ALL
      SELECT m.series_key, m.rn,
             CASE WHEN e.y IS NULL THEN m.AQI WHEN m.AQI IS NULL THEN e.y
                  ELSE (e.old * 0.75::DOUBLE * e.y + 0.25::DOUBLE * m.AQI) / (e.old * 0.75::DOUBLE + 0.25::DOUBLE) END,
             CASE WHEN e.y IS NULL OR m.AQI IS NOT NULL THEN 1.0::DOUBLE ELSE e.old * 0.75::DOUBLE END
      FROM e JOIN m ON m.series_key = e.series_key AND m.rn = e.rn + 1)""").replace("WITH", "WITH RECURSIVE", 1)


def _share(a: str, b: str) -> str:
    both = f"({a} IS NOT NULL AND {b} IS NOT NULL)"
    return (f"CASE WHEN sum(CASE WHEN {both} THEN 1 ELSE 0 END) > 0 THEN "
            f"CAST(sum(CASE WHEN {both} AND abs({a} - {b}) <= 1e-6::DOUBLE THEN 1 ELSE 0 END) AS DOUBLE) / "
            f"CAST(sum(CASE WHEN {both} THEN 1 ELSE 0 END) AS DOUBLE) END")


SQL["leakage_audit"] = with_obs(
    "SELECT series_key, count(*) AS n_rows, "
    f"{r6(_share('sr', 'ri'))} AS roll_share_inclusive, {r6(_share('sr', 'rx'))} AS roll_share_exclusive, "
    f"{r6(_share('se', 'ei'))} AS ewm_share_inclusive, {r6(_share('se', 'ex'))} AS ewm_share_exclusive "
    "FROM a GROUP BY series_key",
    extra=f"""a AS (SELECT series_key,
      CASE WHEN series_key < '3' THEN {guarded("avg", "AQI", "wi7", 7)} ELSE {guarded("avg", "AQI", "w7", 7)} END AS sr,
      {guarded("avg", "AQI", "wi7", 7)} AS ri,
      {guarded("avg", "AQI", "w7", 7)} AS rx,
      CASE WHEN series_key < '3' THEN {ewm_sql("AQI", "wie")} ELSE {ewm_sql("AQI", "wxe")} END AS se, {ewm_sql("AQI", "wie")} AS ei, {ewm_sql("AQI", "wxe")} AS ex
    FROM obs WINDOW {win("wi7", -6, 0)}, {win("w7", -7, -1)}, {win("wie", -(K - 1), 0)}, {win("wxe", -K, -1)})""")

_vent = "CASE WHEN humidity + 1.0::DOUBLE <> 0 THEN windspeed / (humidity + 1.0::DOUBLE) END"
SQL["ventilation_features"] = with_obs(
    f'SELECT series_key, "Date", {r6(_vent)} AS ventilation, {r6(f"lag({_vent}, 1) OVER ws")} AS ventilation_lag1, '
    f'{r6("lag(windspeed, 1) OVER ws")} AS windspeed_lag1, {r6("lag(humidity, 1) OVER ws")} AS humidity_lag1, '
    f'{r6("lag(temp, 1) OVER ws")} AS temp_lag1 FROM obs WINDOW {WS}')

_TWO_PI = "6.283185307179586::DOUBLE"
SQL["calendar_features"] = with_obs(
    'SELECT series_key, "Date", CAST(year("Date") AS INTEGER) AS year, CAST(month("Date") AS INTEGER) AS month, '
    'CAST(day("Date") AS INTEGER) AS day, CAST(dayofyear("Date") AS INTEGER) AS day_of_year, '
    'monthname("Date") AS month_name, dayname("Date") AS weekday_name, '
    f'{r6(f"sin({_TWO_PI} * CAST(month(\"Date\") AS DOUBLE) / 12.0::DOUBLE)")} AS Month_sin, '
    f'{r6(f"cos({_TWO_PI} * CAST(month(\"Date\") AS DOUBLE) / 12.0::DOUBLE)")} AS Month_cos, '
    f'{r6(f"sin({_TWO_PI} * CAST(dayofyear(\"Date\") AS DOUBLE) / 365.25::DOUBLE)")} AS DayOfYear_sin, '
    f'{r6(f"cos({_TWO_PI} * CAST(dayofyear(\"Date\") AS DOUBLE) / 365.25::DOUBLE)")} AS DayOfYear_cos, '
    'CAST((month("Date") = 10 AND day("Date") >= 15) OR (month("Date") = 11 AND day("Date") <= 15) AS INTEGER)'
    ' AS is_stubble_burning FROM obs')

SQL["event_flag"] = with_obs(
    f'SELECT o.series_key, o."Date", {r6("o.AQI")} AS AQI, '
    'CASE WHEN EXISTS (SELECT 1 FROM peaks p WHERE o."Date" BETWEEN p.event_date - 1 AND p.event_date + 1) '
    'THEN 1 ELSE 0 END AS near_event FROM obs o',
    extra="""peaks AS (SELECT DISTINCT "Date" AS event_date FROM (
      SELECT "Date", row_number() OVER (PARTITION BY series_key, year("Date") ORDER BY AQI DESC, "Date") AS rn
      FROM obs WHERE AQI IS NOT NULL) WHERE rn = 1)""")

_RUN = 'PARTITION BY series_key ORDER BY "Date" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW'
_FWD = 'PARTITION BY series_key ORDER BY "Date" ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING'
SQL["interpolate_gaps"] = with_obs(
    f'SELECT series_key, "Date", {r6("AQI")} AS AQI, '
    + r6("CASE WHEN AQI IS NOT NULL THEN AQI WHEN pv IS NOT NULL AND nv IS NOT NULL THEN "
         "pv + (nv - pv) / CAST(np - pp AS DOUBLE) * CAST(rn - pp AS DOUBLE) WHEN pv IS NOT NULL THEN pv END")
    + " AS AQI_interp FROM p",
    extra=f"""m AS (SELECT series_key, "Date", AQI,
        row_number() OVER (PARTITION BY series_key ORDER BY "Date") AS rn FROM masked),
      p AS (SELECT *, last_value(AQI IGNORE NULLS) OVER ({_RUN}) AS pv,
        last_value(CASE WHEN AQI IS NOT NULL THEN rn END IGNORE NULLS) OVER ({_RUN}) AS pp,
        first_value(AQI IGNORE NULLS) OVER ({_FWD}) AS nv,
        first_value(CASE WHEN AQI IS NOT NULL THEN rn END IGNORE NULLS) OVER ({_FWD}) AS np FROM m)""")

SQL["fill_gaps"] = with_obs(
    f'SELECT series_key, "Date", {r6("AQI")} AS AQI, {r6("temp")} AS temp, '
    f'{r6(f"first_value(fa IGNORE NULLS) OVER ({_FWD})")} AS AQI_filled, '
    f'{r6(f"first_value(ft IGNORE NULLS) OVER ({_FWD})")} AS temp_filled FROM f',
    extra=f"""f AS (SELECT series_key, "Date", AQI, temp,
        last_value(AQI IGNORE NULLS) OVER ({_RUN}) AS fa,
        last_value(temp IGNORE NULLS) OVER ({_RUN}) AS ft FROM masked)""")

SQL["preceding_context"] = with_obs(
    'SELECT t.series_key, t."Date", CAST(c.rn - greatest(t.rn - 7, 1) + 1 AS INTEGER) AS pos, '
    f'c."Date" AS ctx_date, {r6("c.AQI")} AS ctx_aqi, {name_sql(category_sql("c.AQI"))} AS ctx_category, '
    f'{color_sql(category_sql("c.AQI"))} AS ctx_color '
    "FROM b t JOIN b c ON c.series_key = t.series_key AND c.rn BETWEEN t.rn - 7 AND t.rn - 1",
    extra='b AS (SELECT series_key, "Date", AQI, row_number() OVER (PARTITION BY series_key ORDER BY "Date") AS rn FROM obs)')

_SEQ = ["AQI"] + WEATHER
SQL["sequence_windows"] = with_obs(
    'SELECT t.series_key, t."Date", CAST(c.rn - t.rn + 8 AS INTEGER) AS step, '
    f'{r6("t.AQI")} AS target, ' + ", ".join(f"{r6('c.' + x)} AS f_{x}" for x in _SEQ)
    + " FROM b t JOIN b c ON c.series_key = t.series_key AND c.rn BETWEEN t.rn - 7 AND t.rn - 1 WHERE t.rn > 7",
    extra='b AS (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY "Date") AS rn FROM obs)')


def _round_features(prefix: str = "") -> str:
    out = []
    for c in FEATURE_NAMES:
        out.append(f"{prefix}{c}" if c == "is_spike" else f"{r6(prefix + c)} AS {c}")
    return ", ".join(out)


SQL["feature_table"] = with_obs(
    f'SELECT series_key, "Date", {r6("AQI")} AS AQI, {_round_features()}, AQI_Category FROM train',
    extra=train_cte())

SQL["clean_drop_fill"] = with_obs(
    f'SELECT series_key, "Date", {r6("AQI")} AS AQI, '
    + ", ".join(f"{r6(f'coalesce(CAST({c} AS DOUBLE), avg({c}) OVER (PARTITION BY series_key), 0.0::DOUBLE)')} AS {c}"
                for c in FEATURE_NAMES)
    + f", {category_sql('AQI')} AS AQI_Category FROM feat",
    extra=f"feat AS ({feature_select('obs')})")

_safe = "CASE WHEN NOT isnan({v}) AND NOT isinf({v}) THEN {v} END"
SQL["safe_number"] = (
    "SELECT event_id, "
    + r6("coalesce(" + _safe.format(v="v") + ", 0.0::DOUBLE)") + " AS safe_value, "
    + r6("coalesce(" + _safe.format(v="a") + ", -1.0::DOUBLE)") + " AS safe_amount "
    "FROM (SELECT event_id, TRY_CAST(CASE WHEN event_type IN ('click', 'purchase') "
    "THEN json_extract_string(props, '$.k') WHEN event_type = 'view' THEN 'NaN' "
    "WHEN event_type = 'error' THEN 'Infinity' ELSE event_type END AS DOUBLE) AS v, "
    "TRY_CAST(value AS DOUBLE) AS a FROM events)")

SQL["aqi_category"] = with_obs(
    f'SELECT series_key, "Date", code, {name_sql("code")} AS category_name, {color_sql("code")} AS color, '
    f'list_extract({_list([a[1] for a in ADVICE])}, code + 1) AS advice_title '
    f'FROM (SELECT series_key, "Date", {category_sql("AQI")} AS code FROM obs)')

SQL["rename_columns"] = with_obs(
    f'SELECT series_key, "Date" AS ds, {r6("AQI")} AS y, '
    'CAST((month("Date") = 10 AND day("Date") >= 15) OR (month("Date") = 11 AND day("Date") <= 15) AS INTEGER) '
    "AS is_stubble_burning FROM obs")
SQL["selected_features"] = with_obs(
    " UNION ALL ".join(f"SELECT '{c}' AS feature, count({c}) AS n_values FROM feat" for c in FEATURE_NAMES),
    extra=f"feat AS ({feature_select('obs')})")
SQL["drop_missing_days"] = with_obs(
    f'SELECT series_key, "Date", {r6("AQI")} AS AQI, {r6("temp")} AS temp FROM masked WHERE AQI IS NOT NULL')
SQL["date_filter"] = with_obs(
    f'SELECT series_key, "Date", {r6("AQI")} AS AQI FROM obs '
    "WHERE \"Date\" < DATE '1997-01-01' AND month(\"Date\") = 3 AND day(\"Date\") = 15")
SQL["row_slice"] = with_obs(
    f'SELECT series_key, "Date", {r6("AQI")} AS AQI FROM obs '
    'QUALIFY row_number() OVER (PARTITION BY series_key ORDER BY "Date") BETWEEN 11 AND 25')
SQL["trend_text"] = with_obs(
    "SELECT series_key, CAST(m AS INTEGER) AS month, CASE WHEN f > 0 THEN '+' ELSE '' END || CAST(CAST(f AS BIGINT) AS VARCHAR) "
    "AS slope_text FROM (SELECT series_key, m, floor(CASE WHEN count(*) > 1 THEN regr_slope(ym, CAST(yr AS DOUBLE)) ELSE 0 END) AS f "
    "FROM y GROUP BY 1, 2)",
    extra='y AS (SELECT series_key, month("Date") AS m, year("Date") AS yr, avg(AQI) AS ym FROM obs GROUP BY 1, 2, 3)')

_raw = "(AQI * 1.2::DOUBLE - 30.0::DOUBLE)"
SQL["clip_values"] = with_obs(
    'SELECT series_key, "Date", '
    f"{r6(f'CASE WHEN {_raw} IS NOT NULL THEN greatest(least({_raw}, 500.0::DOUBLE), 0.0::DOUBLE) END')} AS clipped, "
    f"{r6(f'CASE WHEN {_raw} IS NOT NULL THEN greatest({_raw}, 0.0::DOUBLE) END')} AS clipped_lower, "
    f"{r6(f'CASE WHEN {_raw} IS NOT NULL THEN least({_raw}, 500.0::DOUBLE) END')} AS clipped_upper "
    "FROM masked")

SQL["log_transform"] = with_obs(
    f'SELECT series_key, "Date", {r6("ln(1.0::DOUBLE + AQI)")} AS aqi_log, '
    f'{r6("exp(AQI / 100.0::DOUBLE) - 1.0::DOUBLE")} AS aqi_expm1 FROM obs')


# ---- requests / climatology --------------------------------------------------------
REQ_CTE = """req AS (
  SELECT e.event_id AS request_id, k.series_key, CAST(e.ts AS DATE) AS date
  FROM events e
  LEFT JOIN (SELECT o_custkey, o_orderpriority AS series_key FROM (
               SELECT o_custkey, o_orderpriority,
                      row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
               FROM orders) WHERE rn = 1) k ON e.user_id = k.o_custkey)"""

FI_CTE = """fi AS (SELECT series_key, "Date" AS date, AQI AS aqi, temp AS temperature, windspeed AS wind_speed FROM obs),
clim AS (SELECT series_key, dayofyear(date) AS doy, avg(temperature) AS temperature, avg(wind_speed) AS wind_speed
         FROM fi GROUP BY 1, 2)"""

_SEASON = ('CAST((month({d}) = 10 AND day({d}) >= 15) OR (month({d}) = 11 AND day({d}) <= 15) AS INTEGER)')
_RUN_DS = "PARTITION BY series_key ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_FWD_DS = "PARTITION BY series_key ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"

SQL["forecast_horizon"] = with_obs(
    f"SELECT series_key, ds, {r6(f'first_value(ft IGNORE NULLS) OVER ({_FWD_DS})')} AS temperature, "
    f"{r6(f'first_value(fw IGNORE NULLS) OVER ({_FWD_DS})')} AS wind_speed, "
    f"{_SEASON.format(d='ds')} AS is_stubble_burning FROM f",
    extra=FI_CTE + f""",
hz AS (SELECT DISTINCT series_key, date AS ds FROM fi
       UNION ALL
       SELECT series_key, mx + CAST(o AS INTEGER) AS ds
       FROM (SELECT series_key, max(date) AS mx FROM fi GROUP BY 1), unnest(range(1, 31)) AS u(o)),
j AS (SELECT h.series_key, h.ds, c.temperature, c.wind_speed FROM hz h
      LEFT JOIN clim c ON h.series_key = c.series_key AND dayofyear(h.ds) = c.doy),
f AS (SELECT *, last_value(temperature IGNORE NULLS) OVER ({_RUN_DS}) AS ft,
             last_value(wind_speed IGNORE NULLS) OVER ({_RUN_DS}) AS fw FROM j)""")

SQL["climatology_fallback"] = with_obs(
    "SELECT r.request_id, r.series_key, r.date, "
    f"{r6('CASE WHEN c.doy IS NOT NULL THEN c.temperature ELSE f.temperature END')} AS temperature, "
    f"{r6('CASE WHEN c.doy IS NOT NULL THEN c.wind_speed ELSE f.wind_speed END')} AS wind_speed "
    "FROM req r LEFT JOIN clim c ON r.series_key = c.series_key AND dayofyear(r.date) = c.doy "
    "LEFT JOIN clim f ON r.series_key = f.series_key AND f.doy = 365",
    extra=FI_CTE + ",\n" + REQ_CTE)


def _avgs(prefix=""):
    return ", ".join(f"avg({c}) AS {c}" for c in FEATURE_NAMES)


# Weather gaps take fixed values, other features the overall mean.
_WEATHER_OR = {"temp": "25.0", "humidity": "50.0", "precip": "0.0", "windspeed": "10.0", "sealevelpressure": "1010.0"}
_chosen = ("CASE WHEN md.n IS NOT NULL THEN md.{c} WHEN mo.n IS NOT NULL THEN mo.{c} ELSE se.{c} END")
SQL["climatology_features"] = with_obs(
    "SELECT r.request_id, r.series_key, r.date, "
    "CASE WHEN md.n IS NOT NULL THEN 'month_day' WHEN mo.n IS NOT NULL THEN 'month' "
    "WHEN se.n IS NOT NULL THEN 'series' END AS clim_level, "
    + ", ".join(f"{r6('coalesce(CAST(' + _chosen.format(c=c) + ' AS DOUBLE), ' + _WEATHER_OR.get(c, 'g.' + c + ', 0.0') + '::DOUBLE)')} AS {c}"
                for c in FEATURE_NAMES)
    + ' FROM req r LEFT JOIN md ON r.series_key = md.series_key AND month(r.date) = md.m AND day(r.date) = md.dd '
    "LEFT JOIN mo ON r.series_key = mo.series_key AND month(r.date) = mo.m "
    "LEFT JOIN se ON r.series_key = se.series_key CROSS JOIN g",
    extra=f"""feat AS ({feature_select('obs')}),
md AS (SELECT series_key, month("Date") AS m, day("Date") AS dd, count(*) AS n, {_avgs()} FROM feat GROUP BY 1, 2, 3),
mo AS (SELECT series_key, month("Date") AS m, count(*) AS n, {_avgs()} FROM feat GROUP BY 1, 2),
se AS (SELECT series_key, count(*) AS n, {_avgs()} FROM feat GROUP BY 1),
g AS (SELECT {_avgs()} FROM feat),
""" + REQ_CTE)


def _r2(x: str) -> str:
    return f"(floor(({x}) * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE)"


SQL["climatology_trend"] = with_obs(
    't.request_id, t."offset", t.trend_date'.join(["SELECT ", ", "])
    + r6(_r2("coalesce(CASE WHEN NOT isnan(v) AND NOT isinf(v) THEN v END, 150.0::DOUBLE)")) + " AS trend_aqi "
    "FROM (SELECT t.*, CASE WHEN md.m IS NOT NULL THEN md.v WHEN mo.n IS NOT NULL THEN mo.v END AS v FROM t "
    "LEFT JOIN mda md ON t.series_key = md.series_key AND month(t.trend_date) = md.m AND day(t.trend_date) = md.dd "
    "LEFT JOIN moa mo ON t.series_key = mo.series_key AND month(t.trend_date) = mo.m) t",
    extra="""mda AS (SELECT series_key, month("Date") AS m, day("Date") AS dd, avg(AQI) AS v FROM obs GROUP BY 1, 2, 3),
moa AS (SELECT series_key, month("Date") AS m, count(*) AS n, avg(AQI) AS v FROM obs GROUP BY 1, 2),
""" + REQ_CTE + """,
t AS (SELECT r.request_id, r.series_key, CAST(o AS INTEGER) AS "offset", r.date - CAST(o AS INTEGER) AS trend_date
      FROM req r, unnest(range(1, 8)) AS u(o))""")

MSTAT_CTE = """b AS (SELECT series_key, month("Date") AS m, AQI FROM obs WHERE AQI IS NOT NULL),
st AS (SELECT series_key, m, count(*) AS n, avg(AQI) AS mean, median(AQI) AS med,
              CASE WHEN count(*) > 1 THEN var_samp(AQI) ELSE 0.0::DOUBLE END AS variance,
              CASE WHEN count(*) > 1 THEN stddev_samp(AQI) ELSE 0.0::DOUBLE END AS std_dev
       FROM b GROUP BY 1, 2)"""

SQL["month_stats"] = with_obs(
    f"SELECT st.series_key, CAST(st.m AS INTEGER) AS month, st.n, {r6('st.mean')} AS mean, "
    f"{r6('st.med')} AS median, {r6('st.variance')} AS variance, {r6('st.std_dev')} AS std_dev, "
    f"{r6('mo.mode')} AS mode FROM st LEFT JOIN mo ON st.series_key = mo.series_key AND st.m = mo.m",
    extra=MSTAT_CTE + """,
mo AS (SELECT series_key, m, AQI AS mode FROM (
         SELECT series_key, m, AQI, row_number() OVER (PARTITION BY series_key, m ORDER BY count(*) DESC, AQI ASC) AS rn
         FROM b GROUP BY 1, 2, 3) WHERE rn = 1)""")

_slope = "CASE WHEN count(*) > 1 AND var_pop(CAST(yr AS DOUBLE)) > 0 THEN regr_slope(ym, CAST(yr AS DOUBLE)) ELSE 0.0::DOUBLE END"
SQL["month_trend_slope"] = with_obs(
    f"SELECT series_key, CAST(m AS INTEGER) AS month, count(*) AS n_years, {r6(_slope)} AS trend_slope, "
    f"CASE WHEN {_slope} < 0 THEN 'Improving Trend' ELSE 'Worsening Trend' END AS trend_label "
    "FROM y GROUP BY 1, 2",
    extra='y AS (SELECT series_key, month("Date") AS m, year("Date") AS yr, avg(AQI) AS ym FROM obs '
          'WHERE AQI IS NOT NULL GROUP BY 1, 2, 3)')

_SQRT_2PI = d(__import__("math").sqrt(2.0 * __import__("math").pi))
SQL["month_pdf"] = with_obs(
    "SELECT series_key, CAST(m AS INTEGER) AS month, i, "
    f"{r6('floor(x * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE')} AS x, "
    f"{r6(f'(1.0::DOUBLE / (sd * {_SQRT_2PI})) * exp(-0.5::DOUBLE * (((x - mean) / sd) * ((x - mean) / sd)))')} AS y "
    "FROM (SELECT *, CASE WHEN i = 39 THEN hi ELSE CAST(i AS DOUBLE) * ((hi - lo) / 39.0::DOUBLE) + lo END AS x FROM p)",
    extra=MSTAT_CTE + """,
p AS (SELECT series_key, m, mean, std_dev AS sd, greatest(0.0::DOUBLE, mean - 3.0::DOUBLE * std_dev) AS lo,
             mean + 3.0::DOUBLE * std_dev AS hi, CAST(i AS INTEGER) AS i
      FROM st, unnest(range(0, 40)) AS u(i) WHERE std_dev > 0)""")

SQL["forecast_eval_join"] = with_obs(
    f"SELECT te.series_key, te.ds, {r6('te.y')} AS y, {r6('fc.yhat')} AS yhat FROM te "
    "JOIN fc ON te.series_key = fc.series_key AND te.ds = fc.ds",
    extra="""fi2 AS (SELECT series_key, "Date" AS ds, AQI AS aqi FROM obs),
part AS (SELECT f.*, CASE WHEN f.ds <= max(f.ds) OVER (PARTITION BY f.series_key) - 90 THEN 'train' ELSE 'test' END AS split
         FROM fi2 f),
tr AS (SELECT * FROM part WHERE split = 'train'),
te AS (SELECT series_key, ds, aqi AS y FROM part WHERE split = 'test'),
cl AS (SELECT series_key, dayofyear(ds) AS doy, avg(aqi) AS aqi FROM tr GROUP BY 1, 2),
fut AS (SELECT series_key, mx + CAST(o AS INTEGER) AS ds
        FROM (SELECT series_key, max(ds) AS mx FROM tr GROUP BY 1), unnest(range(1, 31)) AS u(o)),
fc AS (SELECT f.series_key, f.ds, c.aqi AS yhat FROM fut f
       LEFT JOIN cl c ON f.series_key = c.series_key AND dayofyear(f.ds) = c.doy)""")


# ---- splits ---------------------------------------------------------------------------
def with_split(body: str, extra: str = "") -> str:
    e = train_cte() + ",\n" + split_cte()
    if extra:
        e += ",\n" + extra
    return with_obs(body, e)


SQL["split_fraction"] = with_split('SELECT series_key, "Date", split FROM split')
SQL["split_cutoff"] = with_obs(
    'SELECT series_key, "Date", CASE WHEN "Date" <= max("Date") OVER (PARTITION BY series_key) - 180 '
    "THEN 'train' ELSE 'test' END AS split FROM train", train_cte())
SQL["split_stratified"] = with_obs(
    'SELECT series_key, "Date", AQI_Category, CASE WHEN pos <= floor(CAST(n AS DOUBLE) * 0.15::DOUBLE + 0.5::DOUBLE) '
    "THEN 'test' ELSE 'train' END AS split FROM (SELECT series_key, \"Date\", AQI_Category, "
    "row_number() OVER (PARTITION BY AQI_Category ORDER BY md5(series_key || '|' || strftime(\"Date\", '%Y-%m-%d') || '|42'), "
    "series_key, \"Date\") AS pos, count(*) OVER (PARTITION BY AQI_Category) AS n FROM train)", train_cte())
SQL["split_summary"] = with_split(
    'SELECT series_key, split, min("Date") AS min_date, max("Date") AS max_date, count(*) AS n_rows '
    "FROM split GROUP BY 1, 2")

# ---- metrics --------------------------------------------------------------------------
_E = "(AQI - AQI_ewma_7)"
SQL["regression_metrics"] = with_split(
    f"SELECT split, count(*) AS n, {r6(f'avg(abs({_E}))')} AS mae, {r6(f'sqrt(avg({_E} * {_E}))')} AS rmse, "
    f"{r6(f'1.0::DOUBLE - sum({_E} * {_E}) / (var_pop(AQI) * CAST(count(*) AS DOUBLE))')} AS r2, "
    f"{r6(f'avg(abs({_E} / AQI)) * 100.0::DOUBLE')} AS mape, "
    f"{r6('avg(2.0::DOUBLE * abs(AQI_ewma_7 - AQI) / (abs(AQI) + abs(AQI_ewma_7))) * 100.0::DOUBLE')} AS smape "
    "FROM split GROUP BY split")

CM_CTE = f"""sc AS (SELECT *, {category_sql('AQI_ewma_7')} AS pc FROM split WHERE split = 'test'),
grid AS (SELECT CAST(a AS INTEGER) AS actual, CAST(p AS INTEGER) AS predicted FROM range(6) t1(a), range(6) t2(p)),
cnt AS (SELECT AQI_Category AS actual, pc AS predicted, count(*) AS n FROM sc GROUP BY 1, 2),
cm AS (SELECT g.actual, g.predicted, coalesce(c.n, 0) AS n FROM grid g
       LEFT JOIN cnt c ON g.actual = c.actual AND g.predicted = c.predicted),
pcl AS (SELECT s.label, t.tp, s.sup, p.npred FROM
          (SELECT actual AS label, sum(n) AS sup FROM cm GROUP BY 1) s
          JOIN (SELECT predicted AS label, sum(n) AS npred FROM cm GROUP BY 1) p ON s.label = p.label
          JOIN (SELECT actual AS label, n AS tp FROM cm WHERE actual = predicted) t ON s.label = t.label)"""

SQL["confusion_matrix"] = with_split("SELECT actual, predicted, n FROM cm", CM_CTE)


def _div0(a, b):
    return f"CASE WHEN CAST({b} AS DOUBLE) <> 0 THEN CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) ELSE 0.0::DOUBLE END"


SQL["classification_report"] = with_split(
    f"SELECT {name_sql('label')} AS label, {r6('prec')} AS precision, {r6('rec')} AS recall, {r6('f1')} AS f1, "
    "CAST(sup AS BIGINT) AS support FROM m "
    f"UNION ALL SELECT 'accuracy', NULL, NULL, {r6(_div0('sum(tp)', 'sum(sup)'))}, CAST(sum(sup) AS BIGINT) FROM m "
    f"UNION ALL SELECT 'micro avg', {r6('mp')}, {r6('mr')}, {r6(_div0('2.0::DOUBLE * mp * mr', 'mp + mr'))}, sup "
    f"FROM (SELECT {_div0('sum(tp)', 'sum(npred)')} AS mp, {_div0('sum(tp)', 'sum(sup)')} AS mr, "
    "CAST(sum(sup) AS BIGINT) AS sup FROM m) "
    f"UNION ALL SELECT 'macro avg', {r6('avg(prec)')}, {r6('avg(rec)')}, {r6('avg(f1)')}, CAST(sum(sup) AS BIGINT) FROM m "
    f"UNION ALL SELECT 'weighted avg', {r6('sum(prec * sup) / sum(sup)')}, {r6('sum(rec * sup) / sum(sup)')}, "
    f"{r6('sum(f1 * sup) / sum(sup)')}, CAST(sum(sup) AS BIGINT) FROM m",
    CM_CTE + f""",
m AS (SELECT label, tp, npred, sup, {_div0('tp', 'npred')} AS prec, {_div0('tp', 'sup')} AS rec,
             {_div0('2 * tp', 'npred + sup')} AS f1 FROM pcl WHERE sup > 0)""")

SQL["f1_summary"] = with_split(
    f"SELECT {r6(_div0('sum(tp)', 'sum(sup)'))} AS accuracy, {r6('avg(f1)')} AS f1_macro, "
    f"{r6(_div0('sum(f1 * sup)', 'sum(sup)'))} AS f1_weighted, CAST(sum(sup) AS BIGINT) AS n FROM m",
    CM_CTE + f""",
m AS (SELECT label, tp, npred, sup, {_div0('2 * tp', 'npred + sup')} AS f1 FROM pcl WHERE sup > 0 OR npred > 0)""")

_BASE = "[1.0::DOUBLE, 1.5::DOUBLE, 2.0::DOUBLE, 4.0::DOUBLE, 5.0::DOUBLE, 8.0::DOUBLE]"
SQL["class_weights"] = with_split(
    f'SELECT CAST(cls AS INTEGER) AS "class", n_class, {r6("bal")} AS balanced, '
    f"{r6(f'bal * list_extract({_BASE}, cls + 1)')} AS weight_scaled, "
    f"{r6('bal * CASE cls WHEN 2 THEN 1.5::DOUBLE WHEN 3 THEN 1.5::DOUBLE WHEN 5 THEN 1.2::DOUBLE ELSE 1.0::DOUBLE END')}"
    " AS weight_boosted FROM (SELECT *, CAST(n AS DOUBLE) / (CAST(k AS DOUBLE) * CAST(n_class AS DOUBLE)) AS bal FROM "
    "(SELECT cls, n_class, sum(n_class) OVER () AS n, count(*) OVER () AS k FROM "
    "(SELECT AQI_Category AS cls, count(*) AS n_class FROM split WHERE split = 'train' GROUP BY 1)))")

SQL["sample_weights"] = with_split(
    f'SELECT series_key, "Date", AQI_Category AS actual, pc AS predicted, '
    f"{r6(f'list_extract({_BASE}, AQI_Category + 1) * CASE WHEN pc < AQI_Category THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END')}"
    " AS weight FROM (SELECT *, " + category_sql("AQI_ewma_7") + " AS pc FROM split WHERE split = 'train')")


# ---- probabilities / thresholds ---------------------------------------------------------
def _probs_sql(x: str) -> list[str]:
    qs = []
    for c in (25.0, 75.0, 150.0, 250.0, 350.0, 450.0):
        dd = f"(({x} - {d(c)}) / 50.0::DOUBLE)"
        qs.append(f"(1.0::DOUBLE / (1.0::DOUBLE + {dd} * {dd}))")
    s = qs[0]
    for q in qs[1:]:
        s = f"({s} + {q})"
    return [f"({q} / {s})" for q in qs]


_P = _probs_sql("AQI_lag_1")
PROB_CTE = ("pr AS (SELECT series_key, \"Date\", split, AQI_Category AS y, AQI_lag_1, "
            + ", ".join(f"{p} AS p{i}" for i, p in enumerate(_P)) + " FROM split),\n"
            "pa AS (SELECT *, CAST(list_position([p0, p1, p2, p3, p4, p5], list_max([p0, p1, p2, p3, p4, p5])) - 1 "
            "AS INTEGER) AS a FROM pr)")

SQL["argmax_label"] = with_split(
    'SELECT series_key, "Date", ' + ", ".join(f"{r6(f'p{i}')} AS p{i}" for i in range(6))
    + ", a AS argmax, CAST(coalesce(AQI_lag_1 >= 200.0::DOUBLE, false) AS INTEGER) AS alarm_lag_poor FROM pa",
    PROB_CTE)

_STEP = d((0.95 - 0.05) / 89)
_PL = "[p0, p1, p2, p3, p4, p5]"
TUNE_CTE = PROB_CTE + f""",
v AS (SELECT * FROM pa WHERE split = 'val'),
grid AS (SELECT CAST(i AS INTEGER) AS i, CASE WHEN i = 89 THEN 0.95::DOUBLE ELSE CAST(i AS DOUBLE) * {_STEP} + 0.05::DOUBLE END AS t
         FROM range(90) g(i)),
bnd AS (SELECT * FROM (VALUES (0, 1, 2), (1, 2, 3), (2, 3, 4), (3, 4, 5)) b(ord, lo, hi)),
sup AS (SELECT y, count(*) AS n FROM v GROUP BY y),
ev AS (SELECT b.ord, b.lo, b.hi, g.i, g.t,
         sum(CASE WHEN v.a IN (b.lo, b.hi) THEN 1 ELSE 0 END) AS n_mask,
         sum(CASE WHEN v.a IN (b.lo, b.hi) AND NOT (rel > g.t) THEN 1 ELSE 0 END) AS pred_lo,
         sum(CASE WHEN v.a IN (b.lo, b.hi) AND NOT (rel > g.t) AND v.y = b.lo THEN 1 ELSE 0 END) AS tp_lo,
         sum(CASE WHEN v.a IN (b.lo, b.hi) AND rel > g.t THEN 1 ELSE 0 END) AS pred_hi,
         sum(CASE WHEN v.a IN (b.lo, b.hi) AND rel > g.t AND v.y = b.hi THEN 1 ELSE 0 END) AS tp_hi
       FROM bnd b CROSS JOIN grid g CROSS JOIN
            (SELECT v.*, b2.ord AS bo, list_extract({_PL}, b2.hi + 1)
                 / (list_extract({_PL}, b2.lo + 1) + list_extract({_PL}, b2.hi + 1) + 1e-9::DOUBLE) AS rel
             FROM v CROSS JOIN bnd b2) v
       WHERE v.bo = b.ord
       GROUP BY 1, 2, 3, 4, 5),
sc AS (SELECT ev.*, coalesce(sl.n, 0) AS act_lo, coalesce(sh.n, 0) AS act_hi FROM ev
       LEFT JOIN sup sl ON sl.y = ev.lo LEFT JOIN sup sh ON sh.y = ev.hi),
f AS (SELECT *, (CASE WHEN pred_lo + act_lo > 0 THEN CAST(2 * tp_lo AS DOUBLE) / CAST(pred_lo + act_lo AS DOUBLE) ELSE 0.0::DOUBLE END
               + CASE WHEN pred_hi + act_hi > 0 THEN CAST(2 * tp_hi AS DOUBLE) / CAST(pred_hi + act_hi AS DOUBLE) ELSE 0.0::DOUBLE END)
              / 2.0::DOUBLE AS score FROM sc),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ord ORDER BY score DESC, i ASC) AS rn FROM f) WHERE rn = 1),
tuned AS (SELECT CAST(ord AS INTEGER) AS ord, CAST(lo AS INTEGER) AS low, CAST(hi AS INTEGER) AS high,
                 CASE WHEN score > 0 AND n_mask > 0 THEN t ELSE 0.5::DOUBLE END AS t,
                 CASE WHEN score > 0 AND n_mask > 0 THEN score ELSE 0.0::DOUBLE END AS best_score,
                 CAST(n_mask AS BIGINT) AS n_at_boundary FROM best)"""

SQL["threshold_tune"] = with_split(
    f"SELECT ord, low, high, {r6('t')} AS t, {r6('best_score')} AS best_score, n_at_boundary FROM tuned", TUNE_CTE)


def _step_sql(prev: str, k: int, lo: int, hi: int) -> str:
    rel = f"(p{hi} / (p{lo} + p{hi} + 1e-9::DOUBLE))"
    return (f"CASE WHEN {prev} IN ({lo}, {hi}) THEN CASE WHEN {rel} > t{k} THEN {hi} ELSE {lo} END "
            f"ELSE {prev} END")


SQL["threshold_apply"] = with_split(
    'SELECT series_key, "Date", a AS argmax, CAST(a4 AS INTEGER) AS predicted FROM ('
    "SELECT *, " + _step_sql("a3", 3, 4, 5) + " AS a4 FROM ("
    "SELECT *, " + _step_sql("a2", 2, 3, 4) + " AS a3 FROM ("
    "SELECT *, " + _step_sql("a1", 1, 2, 3) + " AS a2 FROM ("
    "SELECT te.*, tt.*, " + _step_sql("te.a", 0, 1, 2) + " AS a1 "
    "FROM (SELECT * FROM pa WHERE split = 'test') te CROSS JOIN tt) x) x2) x3) x4",
    TUNE_CTE + """,
tt AS (SELECT max(CASE WHEN ord = 0 THEN t END) AS t0, max(CASE WHEN ord = 1 THEN t END) AS t1,
              max(CASE WHEN ord = 2 THEN t END) AS t2, max(CASE WHEN ord = 3 THEN t END) AS t3 FROM tuned)""")

# ---- scaling / voting -------------------------------------------------------------------------
_SC = ["AQI", "AQI_lag_1", "temp", "windspeed"]
SQL["minmax_scale"] = with_split(
    'SELECT s.series_key, s."Date", s.split, '
    + ", ".join(f"{r6(f'(s.{c} - st.{c}_min) / st.{c}_range')} AS {c}_scaled" for c in _SC)
    + f", {r6('((s.AQI - st.AQI_min) / st.AQI_range) * st.AQI_range + st.AQI_min')} AS AQI_restored "
    "FROM split s LEFT JOIN st ON s.series_key = st.series_key",
    "st AS (SELECT series_key, " + ", ".join(
        f"min({c}) AS {c}_min, CASE WHEN max({c}) - min({c}) = 0 THEN 1.0::DOUBLE ELSE max({c}) - min({c}) END AS {c}_range"
        for c in _SC) + " FROM split WHERE split = 'train' GROUP BY 1)")

_V = ("exp(((ln(1.0::DOUBLE + AQI_lag_1) + ln(1.0::DOUBLE + AQI_roll_mean_7)) + ln(1.0::DOUBLE + AQI_ewma_7))"
      " / 3.0::DOUBLE) - 1.0::DOUBLE")
SQL["voting_mean"] = with_obs(
    f'SELECT series_key, "Date", {r6("pv")} AS Predicted_AQI, '
    "CAST(coalesce(pv >= 200.0::DOUBLE, false) AS INTEGER) AS alarm_predicted_poor, "
    "CAST(coalesce(AQI_lag_1 >= 200.0::DOUBLE, false) AS INTEGER) AS alarm_lag_poor "
    f"FROM (SELECT *, {_V} AS pv FROM train)", train_cte())


SQL["score_lookup"] = with_obs(
    "SELECT p.request_id, p.series_key, p.date_text AS date, p.status, "
    "CASE WHEN p.status = 'ok' THEN o.series_key IS NULL END AS is_future, "
    f"{r6('o.AQI')} AS actual_aqi, {r6('st.mean')} AS mean, {r6('st.med')} AS median, {r6('st.std_dev')} AS std_dev "
    "FROM p LEFT JOIN obs o ON p.series_key = o.series_key AND p.req_date = o.\"Date\" "
    "LEFT JOIN st ON p.series_key = st.series_key AND month(p.req_date) = st.m",
    extra=REQ_CTE + ",\n" + MSTAT_CTE + """,
allreq AS (SELECT o_orderkey AS request_id, o_orderpriority AS series_key, strftime(o_orderdate, '%Y-%m-%d') AS date_text
           FROM orders
           UNION ALL
           SELECT -(request_id + 1), series_key, strftime(date, '%Y-%m-%d') FROM req),
p AS (SELECT *, TRY_CAST(trim(date_text) AS DATE) AS req_date,
             CASE WHEN date_text IS NULL OR trim(date_text) = '' THEN 'missing_date'
                  WHEN TRY_CAST(trim(date_text) AS DATE) IS NULL THEN 'invalid_date'
                  WHEN series_key IS NULL THEN 'missing_series'
                  WHEN series_key NOT IN (SELECT series_key FROM obs) THEN 'unknown_series' ELSE 'ok' END AS status
      FROM allreq)""")

# The chunked path must reproduce the plain feature table exactly.
SQL["feature_table_chunked"] = SQL["feature_table"]
SQL["interpolate_gaps_chunked"] = SQL["interpolate_gaps"]
SQL["fill_gaps_chunked"] = SQL["fill_gaps"]


def tune_sql(split: str, bounds: list[tuple[int, int]], start: float, stop: float, num: int) -> str:
    """Brute-force grid evaluation of OP-62 (every row against every grid
    point): the independent check of the count-based Spark plan."""
    step = d((stop - start) / (num - 1))
    vals = ", ".join(f"({i}, {lo}, {hi})" for i, (lo, hi) in enumerate(bounds))
    return PROB_CTE + f""",
v AS (SELECT * FROM pa WHERE split = '{split}'),
grid AS (SELECT CAST(i AS INTEGER) AS i,
                CASE WHEN i = {num - 1} THEN {d(stop)} ELSE CAST(i AS DOUBLE) * {step} + {d(start)} END AS t
         FROM range({num}) g(i)),
bnd AS (SELECT * FROM (VALUES {vals}) b(ord, lo, hi)),
sup AS (SELECT y, count(*) AS n FROM v GROUP BY y),
vb AS (SELECT v.*, b2.ord AS bo, list_extract({_PL}, b2.hi + 1)
              / (list_extract({_PL}, b2.lo + 1) + list_extract({_PL}, b2.hi + 1) + 1e-9::DOUBLE) AS rel
       FROM v CROSS JOIN bnd b2),
ev AS (SELECT b.ord, b.lo, b.hi, g.i, g.t,
         sum(CASE WHEN vb.a IN (b.lo, b.hi) THEN 1 ELSE 0 END) AS n_mask,
         sum(CASE WHEN vb.a IN (b.lo, b.hi) AND NOT (rel > g.t) THEN 1 ELSE 0 END) AS pred_lo,
         sum(CASE WHEN vb.a IN (b.lo, b.hi) AND NOT (rel > g.t) AND vb.y = b.lo THEN 1 ELSE 0 END) AS tp_lo,
         sum(CASE WHEN vb.a IN (b.lo, b.hi) AND rel > g.t THEN 1 ELSE 0 END) AS pred_hi,
         sum(CASE WHEN vb.a IN (b.lo, b.hi) AND rel > g.t AND vb.y = b.hi THEN 1 ELSE 0 END) AS tp_hi
       FROM bnd b CROSS JOIN grid g JOIN vb ON vb.bo = b.ord
       GROUP BY 1, 2, 3, 4, 5),
sc AS (SELECT ev.*, coalesce(sl.n, 0) AS act_lo, coalesce(sh.n, 0) AS act_hi FROM ev
       LEFT JOIN sup sl ON sl.y = ev.lo LEFT JOIN sup sh ON sh.y = ev.hi),
f AS (SELECT *, (CASE WHEN pred_lo + act_lo > 0 THEN CAST(2 * tp_lo AS DOUBLE) / CAST(pred_lo + act_lo AS DOUBLE) ELSE 0.0::DOUBLE END
               + CASE WHEN pred_hi + act_hi > 0 THEN CAST(2 * tp_hi AS DOUBLE) / CAST(pred_hi + act_hi AS DOUBLE) ELSE 0.0::DOUBLE END)
              / 2.0::DOUBLE AS score FROM sc),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ord ORDER BY score DESC, i ASC) AS rn FROM f) WHERE rn = 1),
tuned AS (SELECT CAST(ord AS INTEGER) AS ord, CAST(lo AS INTEGER) AS low, CAST(hi AS INTEGER) AS high,
                 CASE WHEN score > 0 AND n_mask > 0 THEN t ELSE 0.5::DOUBLE END AS t,
                 CASE WHEN score > 0 AND n_mask > 0 THEN score ELSE 0.0::DOUBLE END AS best_score,
                 CAST(n_mask AS BIGINT) AS n_at_boundary FROM best)"""


SQL["threshold_tune_single"] = with_split(
    f"SELECT ord, low, high, {r6('t')} AS t, {r6('best_score')} AS best_score, n_at_boundary FROM tuned",
    tune_sql("train", [(2, 3)], 0.1, 0.9, 90))


_LSTM = ["AQI_lag_1", "AQI_roll_mean_7", "AQI_ewma_7", "AQI_diff_1", "temp", "humidity", "precip", "windspeed",
         "sealevelpressure"]
_LCOLS = ["AQI"] + _LSTM
SQL["scaled_sequences"] = with_obs(
    "SELECT t.series_key, t.split, t.\"Date\", CAST(c.rn - t.rn + 8 AS INTEGER) AS step, "
    f"{r6('t.AQI_s')} AS target_scaled, " + ", ".join(f"{r6('c.' + x + '_s')} AS f_{x}" for x in _LSTM)
    + " FROM b t JOIN b c ON c.series_key = t.series_key AND c.split = t.split AND c.rn BETWEEN t.rn - 7 AND t.rn - 1"
    " WHERE t.rn > 7",
    extra=f"""feat AS ({feature_select('obs')}),
l AS (SELECT series_key, "Date", {", ".join(_LCOLS)} FROM feat WHERE {" AND ".join(c + " IS NOT NULL" for c in _LCOLS)}),
ls AS (SELECT *, CASE WHEN "Date" <= max("Date") OVER (PARTITION BY series_key) - 180 THEN 'train' ELSE 'test' END AS split
       FROM l),
mm AS (SELECT series_key, """ + ", ".join(
        f"min({c}) AS {c}_min, CASE WHEN max({c}) - min({c}) = 0 THEN 1.0::DOUBLE ELSE max({c}) - min({c}) END AS {c}_range"
        for c in _LCOLS) + """ FROM ls WHERE split = 'train' GROUP BY 1),
sc AS (SELECT ls.series_key, ls."Date", ls.split, """ + ", ".join(
        f"(ls.{c} - mm.{c}_min) / mm.{c}_range AS {c}_s" for c in _LCOLS) + """
       FROM ls LEFT JOIN mm ON ls.series_key = mm.series_key),
b AS (SELECT *, row_number() OVER (PARTITION BY series_key, split ORDER BY "Date") AS rn FROM sc)""")

SQL["split_global"] = with_obs(
    'SELECT series_key, "Date", CASE WHEN pos <= floor(CAST(n AS DOUBLE) * 0.7::DOUBLE) THEN \'train\' '
    "WHEN pos <= floor(CAST(n AS DOUBLE) * 0.85::DOUBLE) THEN 'val' ELSE 'test' END AS split "
    'FROM (SELECT series_key, "Date", row_number() OVER (ORDER BY "Date", series_key) AS pos, '
    "count(*) OVER () AS n FROM train)", train_cte())

SQL["ordered_positions"] = with_obs(
    f'SELECT series_key, "Date", {r6("AQI")} AS AQI, row_number() OVER (ORDER BY "Date", series_key) AS position FROM obs')

SQL["forecast_csv"] = with_obs(
    f"SELECT h.series_key, h.ds, {r6('c.yhat')} AS yhat, {r6('c.lo')} AS yhat_lower, {r6('c.hi')} AS yhat_upper, "
    f"{r6('s.slope')} AS trend, CASE WHEN c.yhat IS NULL THEN 'Severe' ELSE {name_sql(category_sql('c.yhat'))} END AS aqi_category "
    "FROM h LEFT JOIN c ON h.series_key = c.series_key AND dayofyear(h.ds) = c.doy LEFT JOIN s ON h.series_key = s.series_key",
    extra="""h AS (SELECT series_key, mx + CAST(o AS INTEGER) AS ds
      FROM (SELECT series_key, max("Date") AS mx FROM obs GROUP BY 1), unnest(range(1, 31)) AS u(o)),
c AS (SELECT series_key, dayofyear("Date") AS doy, avg(AQI) AS yhat, min(AQI) AS lo, max(AQI) AS hi FROM obs GROUP BY 1, 2),
y AS (SELECT series_key, year("Date") AS yr, avg(AQI) AS ym FROM obs WHERE AQI IS NOT NULL GROUP BY 1, 2),
s AS (SELECT series_key, CASE WHEN count(*) > 1 THEN coalesce(regr_slope(ym, yr), 0) ELSE 0 END AS slope FROM y GROUP BY 1)""")
