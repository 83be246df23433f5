"""The SQL twin of every registered query that SQL can express, for DuckDB over the driver tables.

Written from the operator definitions, not from the DataFrame code: scenarios, for instance, are built here by
joining days with cutoffs and grouping, where the DataFrame code uses running windows.
"""

from __future__ import annotations

import re

from meterloom.functions import normal

VIEWS: dict[str, str] = {}


def view(name: str, sql: str) -> None:
    VIEWS[name] = sql.strip()


def _needed(sql: str, out: list[str]) -> list[str]:
    for name in VIEWS:
        if name not in out and re.search(rf"\b(FROM|JOIN) {name}\b", sql):
            _needed(VIEWS[name], out)
            out.append(name)
    return out


def oracle(select: str, doubles: str = "", digits: int = 4) -> str:
    """``select`` with the views it mentions, its ``doubles`` rounded.

    Quantities are short decimals, so exact halves are common and the last bit would decide how they round; both
    sides therefore add the same small nudge first.
    """
    names = _needed(select, [])
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names)
    head = f"WITH {ctes}\n" if ctes else ""
    if not doubles:
        return head + select.strip()
    replaced = ", ".join(f"round(CAST({c} AS DOUBLE) + 3.3e-{digits + 3}::DOUBLE, {digits}) + 0.0::DOUBLE AS {c}" for c in doubles.split())
    return f"{head}SELECT * REPLACE ({replaced}) FROM ({select.strip()}) AS result_rows"


def season(month: str, names=("inverno", "primavera", "verão", "outono")) -> str:
    w, sp, su, au = names
    return (
        f"CASE WHEN {month} IN (12, 1, 2) THEN '{w}' WHEN {month} IN (3, 4, 5) THEN '{sp}' "
        f"WHEN {month} IN (6, 7, 8) THEN '{su}' ELSE '{au}' END"
    )


SEASON_EN = ("Winter", "Spring", "Summer", "Autumn")


def readings_sql(meter: str) -> str:
    return f"""
SELECT meter_id, read_date, off AS reg_offpeak,
       CASE WHEN copy = 1 OR (dayofyear(read_date) + meter_id) % 37 <> 0 THEN pk END AS reg_peak, sh AS reg_shoulder
FROM (
  SELECT meter_id, read_date,
         sum(off) OVER w % 2000 AS off, sum(pk) OVER w % 2000 AS pk, sum(sh) OVER w % 2000 AS sh
  FROM (
    SELECT {meter} AS meter_id, CAST(l_shipdate AS DATE) AS read_date,
           sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS off,
           sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS pk,
           sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS sh
    FROM lineitem GROUP BY 1, 2) AS per_day
  WINDOW w AS (PARTITION BY meter_id ORDER BY read_date)
) AS registers, (VALUES (0), (1)) AS copies(copy)
WHERE copy = 0 OR ((dayofyear(read_date) + meter_id) % 41 = 0 AND meter_id % 3 <> 0)"""


def dedupe_sql(readings: str) -> str:
    cols = ("reg_offpeak", "reg_peak", "reg_shoulder", "reg_onpeak")
    pick = ", ".join(f"CASE WHEN dup THEN coalesce({c}, 0) ELSE {c} END AS {c}" for c in cols)
    return f"""
SELECT meter_id, read_date, {pick}
FROM (SELECT *, max(n) OVER (PARTITION BY meter_id) > 1 AS dup
      FROM (SELECT meter_id, read_date, count(*) AS n, sum(reg_offpeak) AS reg_offpeak, sum(reg_peak) AS reg_peak,
                   sum(reg_shoulder) AS reg_shoulder, sum(reg_peak + reg_shoulder) AS reg_onpeak
            FROM {readings} GROUP BY 1, 2) AS per_date) AS flagged"""


def fill_sql(deduped: str) -> str:
    pick = ", ".join(
        f"coalesce(last_value({c} IGNORE NULLS) OVER w, 0) AS {c}" for c in ("reg_offpeak", "reg_peak", "reg_shoulder")
    )
    return f"""
SELECT meter_id, read_date, {pick}, reg_onpeak FROM {deduped}
WINDOW w AS (PARTITION BY meter_id ORDER BY read_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


def diffs_sql(filled: str) -> str:
    return f"""
SELECT * FROM (
  SELECT meter_id, read_date AS date, reg_offpeak - lag(reg_offpeak) OVER w AS off_diff,
         reg_onpeak - lag(reg_onpeak) OVER w AS on_diff
  FROM {filled} WINDOW w AS (PARTITION BY meter_id ORDER BY read_date)) AS steps
WHERE off_diff IS NOT NULL AND on_diff IS NOT NULL"""


def daily_sql(diffs: str) -> str:
    return f"""
SELECT meter_id, date, abs(off_diff) AS offpeak_kwh, abs(on_diff) AS onpeak_kwh,
       abs(off_diff) + abs(on_diff) AS total_kwh FROM {diffs}"""


def flagged_sql(daily: str) -> str:
    return f"""
SELECT d.*, total_kwh < q1 - 1.5 * (q3 - q1) OR total_kwh > q3 + 1.5 * (q3 - q1) AS is_outlier
FROM {daily} AS d JOIN (
  SELECT meter_id, quantile_cont(total_kwh, 0.25) AS q1, quantile_cont(total_kwh, 0.75) AS q3
  FROM {daily} GROUP BY 1) AS q USING (meter_id)"""


def clean_sql(flagged: str) -> str:
    return f"""
SELECT f.meter_id, f.date, CASE WHEN is_outlier THEN m_off ELSE offpeak_kwh END AS offpeak_kwh,
       CASE WHEN is_outlier THEN m_on ELSE onpeak_kwh END AS onpeak_kwh,
       CASE WHEN is_outlier THEN m_off + m_on ELSE total_kwh END AS total_kwh, is_outlier
FROM {flagged} AS f JOIN (
  SELECT meter_id, median(offpeak_kwh) AS m_off, median(onpeak_kwh) AS m_on
  FROM {flagged} WHERE NOT is_outlier GROUP BY 1) AS med USING (meter_id)"""


def monthly_sql(daily: str) -> str:
    return f"""
SELECT meter_id, month_start, year(month_start) AS year, month(month_start) AS month,
       {season("month(month_start)")} AS season, days_in_month, days_with_data, offpeak_kwh, onpeak_kwh,
       offpeak_kwh + onpeak_kwh AS total_kwh, (offpeak_kwh + onpeak_kwh) / days_in_month AS kwh_per_day,
       offpeak_kwh / nullif(offpeak_kwh + onpeak_kwh, 0) AS offpeak_ratio
FROM (
  SELECT meter_id, month_start, dim AS days_in_month, n AS days_with_data,
         off * CASE WHEN n < dim THEN dim::DOUBLE / n ELSE 1 END AS offpeak_kwh,
         onp * CASE WHEN n < dim THEN dim::DOUBLE / n ELSE 1 END AS onpeak_kwh
  FROM (SELECT meter_id, CAST(date_trunc('month', date) AS DATE) AS month_start,
               day(last_day(min(date))) AS dim, count(*) AS n, sum(offpeak_kwh) AS off, sum(onpeak_kwh) AS onp
        FROM {daily} GROUP BY 1, 2) AS sums) AS scaled"""


def bill_parts(off: str, onp: str, days: str) -> dict[str, str]:
    """Bill parts as SQL over the given expressions."""
    v = f"(CASE WHEN {off} < 0 OR {onp} < 0 THEN 0 ELSE {off} END)"
    f = f"(CASE WHEN {off} < 0 OR {onp} < 0 THEN 0 ELSE {onp} END)"
    d = f"(CASE WHEN {days} <= 0 THEN 30 ELSE {days} END)"
    total, months = f"({v} + {f})", f"({d} * 12.0::DOUBLE / 365)"
    base = f"(0.0999::DOUBLE * {v} + 0.1799::DOUBLE * {f})"
    energy = (
        f"(CASE WHEN {total} <= 200 THEN greatest(0, {base} - 1.8::DOUBLE) * 1.06::DOUBLE ELSE "
        f"{base} * 200 / nullif({total}, 0) * 1.06::DOUBLE "
        f"+ greatest(0, {base} * (1 - 200 / nullif({total}, 0)) - 1.8::DOUBLE) * 1.23::DOUBLE END)"
    )
    parts = {
        "energy": energy,
        "energy_base": base,
        "power": f"(0.38::DOUBLE * {d} * 1.23::DOUBLE)",
        "power_base": f"(0.38::DOUBLE * {d})",
        "network": "0.0::DOUBLE",
        "audiovisual": f"({months} * 2.85::DOUBLE * 1.06::DOUBLE)",
        "audiovisual_base": f"({months} * 2.85::DOUBLE)",
        "exploitation": f"({months} * 0.0023::DOUBLE * 1.23::DOUBLE)",
        "exploitation_base": f"({months} * 0.0023::DOUBLE)",
        "special": f"(0.001::DOUBLE * {total} * 1.23::DOUBLE)",
        "special_base": f"(0.001::DOUBLE * {total})",
        "discount": "1.8::DOUBLE",
        "total_kwh": total,
        "offpeak_kwh": v,
        "onpeak_kwh": f,
    }
    charged = ("energy", "power", "audiovisual", "exploitation", "special")
    return {"bill": f"greatest(0, {' + '.join(parts[c] for c in charged)})", **parts}


def bill_sql(monthly: str) -> str:
    return f"SELECT *, {bill_parts('offpeak_kwh', 'onpeak_kwh', 'days_in_month')['bill']} AS bill FROM {monthly}"


def snapshots_sql(days: str) -> str:
    """``days``: meter_id, date, rn (row order), the three kWh columns."""
    return f"""
SELECT meter_id, month_start, cutoff_day, min(first_date) AS first_date, max(date) AS simulation_date,
       arg_max(isodow(date) - 1, date) AS day_of_week, max(dim) AS days_in_month, count(*) AS days_elapsed,
       max(dim) - count(*) AS days_remaining, coalesce(sum(offpeak_kwh), 0) AS cum_offpeak_kwh,
       coalesce(sum(onpeak_kwh), 0) AS cum_onpeak_kwh,
       coalesce(sum(offpeak_kwh), 0) + coalesce(sum(onpeak_kwh), 0) AS cum_total_kwh,
       avg(offpeak_kwh) FILTER (WHERE back <= 7) AS avg7_offpeak, avg(onpeak_kwh) FILTER (WHERE back <= 7) AS avg7_onpeak,
       avg(total_kwh) FILTER (WHERE back <= 7) AS avg7_total
FROM (
  SELECT d.*, cutoff_day, row_number() OVER (PARTITION BY meter_id, month_start, cutoff_day ORDER BY date DESC, rn DESC) AS back
  FROM (SELECT *, CAST(date_trunc('month', date) AS DATE) AS month_start, day(last_day(date)) AS dim,
               min(date) OVER (PARTITION BY meter_id, date_trunc('month', date)) AS first_date FROM {days}) AS d
  JOIN (VALUES (10), (15), (20), (25)) AS c(cutoff_day) ON day(date) <= cutoff_day AND cutoff_day <= dim) AS seen
GROUP BY 1, 2, 3"""


SCENARIO = (
    "s.meter_id, s.month_start, s.cutoff_day, simulation_date, year, month, season, day_of_week, s.days_in_month, "
    "days_elapsed, days_remaining, cum_offpeak_kwh, cum_onpeak_kwh, cum_total_kwh, avg7_offpeak, avg7_onpeak, "
    "avg7_total, temperature, humidity, 0 AS occupancy"
)
SCENARIO_DOUBLES = (
    "cum_offpeak_kwh cum_onpeak_kwh cum_total_kwh avg7_offpeak avg7_onpeak avg7_total temperature humidity "
    "projected_bill bill"
)
PROJECTED = bill_parts("cum_offpeak_kwh", "cum_onpeak_kwh", "days_elapsed")["bill"]
SEASON_WEATHER = {
    "temperature": "CASE season WHEN 'inverno' THEN 12.0 WHEN 'primavera' THEN 20.0 WHEN 'verão' THEN 28.0 ELSE 18.0 END",
    "humidity": "CASE season WHEN 'inverno' THEN 80.0 WHEN 'primavera' THEN 70.0 WHEN 'verão' THEN 60.0 ELSE 75.0 END",
}


def season_scenarios(snaps: str, monthly: str) -> str:
    return f"""
SELECT {SCENARIO}, {PROJECTED} AS projected_bill, bill
FROM (SELECT s.*, year, month, season, bill, {SEASON_WEATHER['temperature']} AS temperature,
             {SEASON_WEATHER['humidity']} AS humidity
      FROM {snaps} AS s JOIN {monthly} AS m USING (meter_id, month_start)) AS s"""


view("readings", readings_sql("l_suppkey"))
view("readings8", readings_sql("l_suppkey % 8"))
for tag in ("", "8"):
    view(f"deduped{tag}", dedupe_sql(f"readings{tag}"))
    view(f"filled{tag}", fill_sql(f"deduped{tag}"))
    view(f"diffs{tag}", diffs_sql(f"filled{tag}"))
    view(f"daily{tag}", daily_sql(f"diffs{tag}"))
    view(f"flagged{tag}", flagged_sql(f"daily{tag}"))
    view(f"cleaned{tag}", clean_sql(f"flagged{tag}"))
    view(f"monthly{tag}", monthly_sql(f"cleaned{tag}"))
    view(f"base{tag}", bill_sql(f"monthly{tag}"))

view(
    "raw_days",
    """
SELECT meter_id, read_date AS date, rn, abs(d_off) AS offpeak_kwh, abs(d_on) AS onpeak_kwh, abs(d_off) + abs(d_on) AS total_kwh
FROM (
  SELECT meter_id, read_date, row_number() OVER w AS rn, reg_offpeak - lag(reg_offpeak) OVER w AS d_off,
         onp - lag(onp) OVER w AS d_on
  FROM (SELECT meter_id, read_date, reg_offpeak, reg_peak + reg_shoulder AS onp FROM readings) AS combined
  WINDOW w AS (PARTITION BY meter_id ORDER BY read_date, reg_offpeak NULLS FIRST, onp NULLS FIRST)) AS steps
WHERE rn > 1""",
)
view(
    "weather",
    """
SELECT station_id, date, tmax, tmin, CASE WHEN day(date) % 10 <> 0 THEN CAST(50 + 3 * n AS DOUBLE) END AS humidity,
       CASE WHEN month(date) IN (6, 7, 8) THEN 0.0::DOUBLE ELSE CAST(n - 1 AS DOUBLE) END AS rain, tmax / 4 AS uv
FROM (SELECT o_custkey % 5 AS station_id, CAST(o_orderdate AS DATE) AS date, 10 + max(o_totalprice) / 25000 AS tmax,
             5 + min(o_totalprice) / 50000 AS tmin, count(*) AS n FROM orders GROUP BY 1, 2) AS per_day""",
)
view(
    "predictions",
    """
SELECT model, CASE WHEN o_orderkey % 5 = 0 THEN 'test' ELSE 'train' END AS split, o_orderkey AS sample_id,
       o_totalprice AS y,
       CASE model WHEN 'linear_baseline' THEN 200000.0::DOUBLE + (o_custkey % 100) * 1000.0::DOUBLE
                  WHEN 'ridge' THEN o_totalprice * 0.9::DOUBLE + 20000.0::DOUBLE
                  WHEN 'random_forest' THEN o_totalprice + ((o_orderkey % 21) - 10) * 1500.0::DOUBLE
                  ELSE o_totalprice * 1.02::DOUBLE - 1500.0::DOUBLE END AS yhat
FROM orders, (VALUES ('linear_baseline'), ('ridge'), ('random_forest'), ('polynomial_deg2')) AS m(model)""",
)
view(
    "residuals",
    """
SELECT *, y - yhat AS residual, abs(y - yhat) AS abs_error, (y - yhat) / nullif(y, 0) * 100 AS pct_error FROM predictions""",
)
view(
    "metrics",
    """
SELECT model, split, count(*) AS n,
       1 - avg((y - yhat) * (y - yhat)) / nullif(var_pop(y), 0) AS r2, avg(abs(y - yhat)) AS mae,
       avg((y - yhat) * (y - yhat)) AS mse, sqrt(avg((y - yhat) * (y - yhat))) AS rmse,
       sqrt(avg((y - yhat) * (y - yhat))) / nullif(avg(abs(y - yhat)), 0) AS rmse_mae_ratio,
       max(abs(y - yhat)) AS max_error, avg(y) AS mean_y
FROM predictions GROUP BY 1, 2""",
)
view(
    "event_days",
    """
SELECT *, offpeak_kwh + onpeak_kwh AS total_kwh, 0 AS rn FROM (
  SELECT user_id AS meter_id, CAST(ts AS DATE) AS date,
         round(coalesce(sum(value) FILTER (WHERE event_type IN ('purchase', 'signup')), 0), 2) AS offpeak_kwh,
         round(coalesce(sum(value) FILTER (WHERE event_type NOT IN ('purchase', 'signup')), 0), 2) AS onpeak_kwh
  FROM events GROUP BY 1, 2) AS per_day""",
)
view("event_months", monthly_sql("event_days"))
view("event_base", bill_sql("event_months"))
view("event_snaps", snapshots_sql("event_days"))
view("clean_days8", "SELECT *, 0 AS rn FROM cleaned8")
view("snaps8", snapshots_sql("clean_days8"))
view("snaps", snapshots_sql("raw_days"))
view(
    "snaps_weather",
    """
SELECT s.*, st.station_id, CASE WHEN w.n > 0 THEN w.t ELSE 20.0::DOUBLE END AS temperature,
       CASE WHEN w.n > 0 THEN w.h ELSE 70.0::DOUBLE END AS humidity
FROM snaps AS s LEFT JOIN (SELECT s_suppkey AS meter_id, s_suppkey % 5 AS station_id FROM supplier) AS st USING (meter_id)
LEFT JOIN (
  SELECT r.station_id, r.first_date, r.simulation_date, count(*) AS n, avg((tmax + tmin) / 2) AS t, avg(humidity) AS h
  FROM (SELECT DISTINCT s_suppkey % 5 AS station_id, first_date, simulation_date FROM snaps JOIN supplier ON s_suppkey = meter_id) AS r
  JOIN weather AS w ON w.station_id = r.station_id AND w.date BETWEEN r.first_date AND r.simulation_date
  GROUP BY 1, 2, 3) AS w ON w.station_id = st.station_id AND w.first_date = s.first_date AND w.simulation_date = s.simulation_date""",
)
view(
    "scenarios",
    f"""
SELECT {SCENARIO}, {PROJECTED} AS projected_bill, bill
FROM snaps_weather AS s JOIN (SELECT meter_id, month_start, year, month, season, bill FROM base) AS m USING (meter_id, month_start)""",
)
view(
    "ordered",
    """
SELECT *, row_number() OVER (ORDER BY simulation_date, meter_id, cutoff_day) AS sample_id, count(*) OVER () AS n_all
FROM scenarios""",
)
view("split_rows", "SELECT *, CASE WHEN sample_id > n_all - floor(n_all * 0.2) THEN 'test' ELSE 'train' END AS split FROM ordered")

ORACLES: dict[str, str] = {}
O = ORACLES


def quart(x: str, by: str, source: str) -> str:
    return (
        f"SELECT {by}, quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.5) AS median, "
        f"quantile_cont({x}, 0.75) AS q3 FROM {source} GROUP BY {by}"
    )


def long(columns, source: str, keep: str = "") -> str:
    k = f"{keep}, " if keep else ""
    return " UNION ALL ".join(
        f"SELECT {k}'{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM {source}" for c in columns
    )


MONTHLY_COLUMNS = ["offpeak_kwh", "onpeak_kwh", "total_kwh", "days_in_month", "offpeak_ratio", "kwh_per_day"]
MEASURES = ["tmax", "tmin", "humidity", "rain", "uv"]


def corr_sql(columns, source: str, by: str = "") -> str:
    k, g = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return " UNION ALL ".join(
        f"SELECT {k}'{a}' AS var_a, '{b}' AS var_b, CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END AS r FROM {source}{g}"
        for i, a in enumerate(columns) for b in columns[i + 1:]
    )


# sources
REG = "reg_offpeak reg_peak reg_shoulder"
O["src_readings"] = oracle("SELECT * FROM readings", REG)
O["src_weather"] = oracle("SELECT * FROM weather", "tmax tmin humidity rain uv")
O["src_monthly"] = oracle(
    "SELECT meter_id, month_start, year, month, season, days_in_month, offpeak_kwh, onpeak_kwh, total_kwh, kwh_per_day, "
    "offpeak_ratio FROM monthly",
    "offpeak_kwh onpeak_kwh total_kwh kwh_per_day offpeak_ratio",
)
O["model_name_extract"] = oracle(
    "SELECT 'y_pred_' || model || '_test.parquet' AS file_name, count(*) AS n, model FROM predictions GROUP BY model"
)
O["prediction_files"] = oracle("SELECT sample_id, y, yhat, model, split FROM predictions", "y yhat")
O["flat_prediction_files"] = oracle("SELECT model, split, sample_id, y, yhat FROM predictions WHERE split = 'test'", "y yhat")

# scalar functions
O["combine_registers"] = oracle(
    "SELECT meter_id, read_date, reg_offpeak, reg_peak + reg_shoulder AS reg_onpeak, "
    "reg_offpeak + reg_peak + reg_shoulder AS reg_total FROM readings",
    "reg_offpeak reg_onpeak reg_total",
)
O["calendar_features"] = oracle(
    f"SELECT meter_id, read_date AS date, year(read_date) AS year, month(read_date) AS month, day(read_date) AS day, "
    f"isodow(read_date) - 1 AS day_of_week, weekofyear(read_date) AS week_of_year, {season('month(read_date)')} AS season, "
    f"CAST(date_trunc('month', read_date) AS DATE) AS month_start FROM readings"
)
O["season_label"] = oracle(
    f"SELECT month(read_date) AS month, {season('month(read_date)')} AS season, "
    f"{season('month(read_date)', SEASON_EN)} AS season_en, count(*) AS n FROM readings GROUP BY 1, 2, 3"
)
O["weather_derive"] = oracle(
    "SELECT station_id, date, (tmax + tmin) / 2 AS temperature, humidity, tmax AS temperature_max_only, "
    "70.0 AS humidity_fallback, 20.0 AS temperature_fallback FROM weather",
    "temperature humidity temperature_max_only humidity_fallback temperature_fallback",
)
_parts = bill_parts("offpeak_kwh", "onpeak_kwh", "days_in_month")
O["bill_breakdown"] = oracle(
    "SELECT meter_id, month_start, " + ", ".join(f"{e} AS {n}" for n, e in _parts.items()) + " FROM monthly",
    " ".join(_parts),
)
MONTH_DOUBLES = "offpeak_kwh onpeak_kwh total_kwh kwh_per_day offpeak_ratio"
O["monthly_bill"] = oracle("SELECT * FROM base", MONTH_DOUBLES + " bill")
O["residual_table"] = oracle("SELECT * FROM residuals", "y yhat residual abs_error pct_error")
CATEGORY = "CASE WHEN abs_error <= mae THEN 'good' WHEN abs_error <= 2 * mae THEN 'moderate' ELSE 'large' END"
O["error_category"] = oracle(
    f"SELECT r.model, r.split, sample_id, mae, {CATEGORY} AS error_category FROM residuals AS r "
    "JOIN metrics AS m ON r.model = m.model AND r.split = m.split",
    "mae",
)
O["metric_grades"] = oracle(
    """
SELECT model, split, CASE WHEN r2 >= 0.9 THEN 'excellent' WHEN r2 >= 0.7 THEN 'good' WHEN r2 >= 0.5 THEN 'moderate'
  WHEN r2 >= 0 THEN 'weak' ELSE 'poor' END AS r2_grade, r2 < 0.5 AS low_r2, mae / mean_y * 100 AS mae_pct,
  CASE WHEN mae / mean_y * 100 < 5 THEN 'excellent' WHEN mae / mean_y * 100 < 10 THEN 'good'
       WHEN mae / mean_y * 100 < 20 THEN 'moderate' ELSE 'high' END AS mae_grade, rmse / mean_y * 100 AS rmse_pct,
  CASE WHEN rmse_mae_ratio < 1.2 THEN 'consistent' WHEN rmse_mae_ratio < 1.5 THEN 'some_large' ELSE 'outliers' END AS ratio_grade,
  CASE WHEN r2 >= 0.7 AND rmse_mae_ratio < 1.5 THEN 'good' WHEN r2 >= 0.5 THEN 'moderate' ELSE 'weak' END AS readiness
FROM metrics""",
    "mae_pct rmse_pct",
)
view(
    "bias",
    """
SELECT model, split, count(*) FILTER (WHERE residual > 0) AS n_under,
       coalesce(avg(residual) FILTER (WHERE residual > 0), 0) AS mean_under,
       count(*) FILTER (WHERE residual < 0) AS n_over,
       coalesce(avg(residual) FILTER (WHERE residual < 0), 0) AS mean_over, count(*) AS n
FROM residuals GROUP BY 1, 2""",
)
O["bias_summary"] = oracle("SELECT * FROM bias", "mean_under mean_over")
O["bias_classes"] = oracle(
    """
SELECT model, split,
  CASE WHEN mae / mean_y < 0.10 THEN 'excellent' WHEN mae / mean_y < 0.20 THEN 'moderate' ELSE 'high_uncertainty' END AS accuracy,
  CASE WHEN n_under > n_over * 1.2 THEN 'underestimation' WHEN n_over > n_under * 1.2 THEN 'overestimation' ELSE 'balanced' END AS bias,
  CASE WHEN p75 / mean_y < 0.10 THEN 'consistent' ELSE 'variable' END AS consistency
FROM metrics JOIN bias USING (model, split)
JOIN (SELECT model, split, quantile_cont(abs_error, 0.75) AS p75 FROM residuals GROUP BY 1, 2) AS p USING (model, split)"""
)
view(
    "shape",
    """
SELECT model, split, count(*) AS n, avg(residual) AS mean, stddev_pop(residual) AS std, min(residual) AS min,
       max(residual) AS max, avg(d * d * d) / power(avg(d * d), 1.5) AS skew,
       avg(d * d * d * d) / power(avg(d * d), 2) - 3 AS kurt
FROM (SELECT *, residual - avg(residual) OVER (PARTITION BY model, split) AS d FROM residuals) AS centred GROUP BY 1, 2""",
)
view(
    "res_stats",
    f"""
SELECT s.*, q1, median, q3, n_outliers, q3 - q1 AS iqr, n_outliers * 100.0::DOUBLE / n AS outlier_pct
FROM shape AS s JOIN ({quart('residual', 'model, split', 'residuals')}) AS q USING (model, split)
JOIN (SELECT r.model, r.split, count(*) FILTER (WHERE residual < q1 - 1.5 * (q3 - q1) OR residual > q3 + 1.5 * (q3 - q1)) AS n_outliers
      FROM residuals AS r JOIN ({quart('residual', 'model, split', 'residuals')}) AS f
        ON r.model = f.model AND r.split = f.split GROUP BY 1, 2) AS o USING (model, split)""",
)
O["residual_stats"] = oracle("SELECT * FROM res_stats", "mean std min max skew kurt q1 median q3 iqr outlier_pct")
view("jb", "SELECT model, split, n, n / 6.0 * (skew * skew + kurt * kurt / 4) AS jarque_bera FROM shape")
O["jarque_bera"] = oracle("SELECT *, exp(-jarque_bera / 2) AS p_value FROM jb", "jarque_bera p_value")
view(
    "thirds",
    """
SELECT model, split, var_pop(residual) FILTER (WHERE rn <= n // 3) AS var_low,
       var_pop(residual) FILTER (WHERE rn > n - n // 3) AS var_high
FROM (SELECT *, row_number() OVER (PARTITION BY model, split ORDER BY yhat, sample_id) AS rn,
             count(*) OVER (PARTITION BY model, split) AS n FROM residuals) AS ranked GROUP BY 1, 2""",
)
view("spread", "SELECT *, CASE WHEN var_low > 0 THEN var_high / var_low ELSE 1.0 END AS variance_ratio FROM thirds")
O["variance_ratio"] = oracle(
    "SELECT model, split, round(var_low, 0) AS var_low, round(var_high, 0) AS var_high, variance_ratio FROM spread",
    "var_low var_high variance_ratio",
)


def horner(x: str, coefficients) -> str:
    out = f"{coefficients[0]!r}::DOUBLE"
    for c in coefficients[1:]:
        out = f"({out} * {x} + {c!r}::DOUBLE)"
    return out


def log_cdf_sql(z: str) -> str:
    """Logarithm of the normal distribution function, by the error function's three ranges."""
    x = f"(abs({z}) / sqrt(2))"
    sq, inv = f"({x} * {x})", f"(1 / ({x} * {x}))"
    tail = (
        f"(CASE WHEN {x} <= 4 THEN {horner(x, normal.MID_NUM)} / {horner(x, normal.MID_DEN)} "
        f"ELSE (1 / sqrt(pi()) - {inv} * {horner(inv, normal.FAR_NUM)} / {horner(inv, normal.FAR_DEN)}) / {x} END)"
    )
    return (
        f"CASE WHEN {x} <= 0.46875 THEN ln(0.5 + sign({z}) * {x} * {horner(sq, normal.ERF_NUM)} / {horner(sq, normal.ERF_DEN)} / 2) "
        f"WHEN {z} > 0 THEN ln(1 - exp(-{sq}) * {tail} / 2) ELSE ln({tail} / 2) - {sq} END"
    )


def quantile_sql(p: str) -> str:
    q, deep = f"({p} - 0.5)", f"sqrt(-ln(least({p}, 1 - {p})))"
    r, tail, edge = f"(0.180625 - {q} * {q})", f"({deep} - 1.6)", f"({deep} - 5.0)"
    return (
        f"CASE WHEN abs({q}) <= 0.425 THEN {q} * {horner(r, normal.CENTRE_NUM)} / {horner(r, normal.CENTRE_DEN)} "
        f"WHEN {deep} <= 5 THEN sign({q}) * {horner(tail, normal.TAIL_NUM)} / {horner(tail, normal.TAIL_DEN)} "
        f"ELSE sign({q}) * {horner(edge, normal.EDGE_NUM)} / {horner(edge, normal.EDGE_DEN)} END"
    )


view(
    "darling",
    f"""
SELECT model, split, n, statistic, critical_5pct, CASE WHEN statistic < critical_5pct THEN 1.0 ELSE 0.01 END AS p_value
FROM (SELECT model, split, n, -n - sum((2 * i - 1) * below + (2 * (n - i) + 1) * above) / n AS statistic,
             round(0.787 / (1 + 4 / n::DOUBLE - 25 / n::DOUBLE / n), 3) AS critical_5pct
      FROM (SELECT model, split, i, n, {log_cdf_sql('z')} AS below, {log_cdf_sql('(-z)')} AS above
            FROM (SELECT model, split, row_number() OVER (PARTITION BY model, split ORDER BY residual) AS i, count(*) OVER w AS n,
                         (residual - avg(residual) OVER w) / stddev_samp(residual) OVER w AS z
                  FROM residuals WINDOW w AS (PARTITION BY model, split)) AS placed) AS logs
      GROUP BY 1, 2, 3) AS sums""",
)
O["anderson_darling"] = oracle("SELECT * FROM darling", "statistic critical_5pct p_value")
view(
    "plotted",
    f"""
SELECT *, {quantile_sql('p')} AS theoretical
FROM (SELECT *, CASE WHEN "rank" = n_total THEN power(0.5, 1 / n_total::DOUBLE) WHEN "rank" = 1 THEN 1 - power(0.5, 1 / n_total::DOUBLE)
                     ELSE ("rank" - 0.3175) / (n_total + 0.365) END AS p
      FROM (SELECT offpeak_kwh, meter_id, month_start, row_number() OVER (ORDER BY offpeak_kwh, meter_id, month_start) AS "rank",
                   count(*) OVER () AS n_total FROM base WHERE offpeak_kwh IS NOT NULL) AS placed) AS shares""",
)
O["qq_points"] = oracle(
    """
SELECT offpeak_kwh, meter_id, month_start, "rank", n_total, theoretical, slope, intercept, r, intercept + slope * theoretical AS fitted
FROM plotted, (SELECT regr_slope(offpeak_kwh, theoretical) AS slope, regr_intercept(offpeak_kwh, theoretical) AS intercept,
                      corr(offpeak_kwh, theoretical) AS r FROM plotted) AS line""",
    "offpeak_kwh theoretical slope intercept r fitted",
)
# a cubic by the four orthogonal polynomials over 51 places, at the row's own place in its window
CUBIC = ("1.0::DOUBLE", "{j}", "({j} * {j} - 650 / 3.0::DOUBLE)", "({j} * {j} * {j} - {j} * 1949 / 5.0::DOUBLE)")
_at = lambda j: [c.format(j=j) for c in CUBIC]
O["residual_smooth"] = oracle(
    f"""
SELECT model, split, sample_id, yhat, residual, "rank", sum(weight * other) AS smoothed
FROM (SELECT a.model, a.split, a.sample_id, a.yhat, a.residual, a."rank", b.residual AS other,
             {' + '.join(f"{p} * {q} / (SELECT sum({q} * {q}) FROM range(-25, 26) AS places(v))" for p, q in zip(_at('t'), _at('v')))} AS weight
      FROM (SELECT *, first + k - 1 AS partner, k - 26 AS v, "rank" - first - 25 AS t
            FROM (SELECT *, least(greatest("rank" - 25, 1), n - 50) AS first
                  FROM (SELECT model, split, sample_id, yhat, residual, row_number() OVER (PARTITION BY model, split ORDER BY yhat, sample_id) AS "rank",
                               count(*) OVER (PARTITION BY model, split) AS n FROM residuals) AS placed WHERE n > 50) AS windows,
                 range(1, 52) AS ks(k)) AS a
      JOIN (SELECT model, split, residual, row_number() OVER (PARTITION BY model, split ORDER BY yhat, sample_id) AS "rank" FROM residuals) AS b
        ON b.model = a.model AND b.split = a.split AND b."rank" = a.partner) AS weighted
GROUP BY ALL""",
    "yhat residual smoothed",
)
O["residual_findings"] = oracle(
    """
SELECT model, split, c.check_name AS "check",
  CASE c.check_name
    WHEN 'bias' THEN CASE WHEN abs(mean) < 0.5 THEN 'ok' WHEN mean > 0 THEN 'underestimation' ELSE 'overestimation' END
    WHEN 'normality' THEN CASE WHEN normality_p > 0.05 THEN 'normal' ELSE 'not_normal' END
    WHEN 'skewness' THEN CASE WHEN abs(skew) < 0.5 THEN 'symmetric' WHEN skew > 0 THEN 'right' ELSE 'left' END
    WHEN 'kurtosis' THEN CASE WHEN abs(kurt) < 0.5 THEN 'normal' WHEN kurt > 0 THEN 'heavy' ELSE 'light' END
    WHEN 'variance' THEN CASE WHEN variance_ratio < 1.5 THEN 'constant' WHEN variance_ratio < 2.5 THEN 'mild' ELSE 'strong' END
    WHEN 'outliers' THEN CASE WHEN outlier_pct < 5 THEN 'few' ELSE 'many' END
    ELSE CASE WHEN variance_ratio > 2 OR abs(skew) > 1 OR outlier_pct > 5 THEN 'recommended' ELSE 'none' END END AS status,
  CASE c.check_name WHEN 'bias' THEN mean WHEN 'normality' THEN normality_p WHEN 'skewness' THEN skew
    WHEN 'kurtosis' THEN kurt WHEN 'variance' THEN variance_ratio WHEN 'outliers' THEN outlier_pct END AS value,
  CASE WHEN c.check_name = 'normality' THEN CASE WHEN n > 5000 THEN 'anderson_darling' ELSE 'jarque_bera' END END AS test
FROM res_stats JOIN (SELECT model, split, CASE WHEN a.n > 5000 THEN p_value ELSE exp(-jarque_bera / 2) END AS normality_p
                     FROM jb JOIN darling AS a USING (model, split)) AS j USING (model, split) JOIN spread USING (model, split),
  (VALUES ('bias'), ('normality'), ('skewness'), ('kurtosis'), ('variance'), ('outliers'), ('improvement')) AS c(check_name)""",
    "value",
)
O["correlation_matrix"] = oracle(corr_sql(MONTHLY_COLUMNS, "base"), "r")
O["weather_correlation"] = oracle(corr_sql(MEASURES, "weather"), "r")
view("month_pairs", corr_sql(MONTHLY_COLUMNS, "base"))
view("base_wh", "SELECT *, total_kwh * 1000 + days_in_month AS total_wh FROM base")
view("bill_pairs", corr_sql([*MONTHLY_COLUMNS, "bill", "total_wh"], "base_wh"))
O["correlation_labels"] = oracle(
    """
SELECT CASE WHEN var_a = 'total_kwh' THEN var_b ELSE var_a END AS variable, r,
  CASE WHEN abs(r) > 0.7 THEN 'strong' WHEN abs(r) > 0.4 THEN 'moderate' WHEN abs(r) > 0.2 THEN 'weak' ELSE 'negligible' END AS strength,
  CASE WHEN r > 0 THEN 'positive' ELSE 'negative' END AS direction
FROM month_pairs WHERE var_a = 'total_kwh' OR var_b = 'total_kwh'""",
    "r",
)
O["near_perfect_pairs"] = oracle("SELECT * FROM bill_pairs WHERE abs(r) > 0.999 AND abs(r) < 1", "r")
O["strongest_driver"] = oracle(
    """
SELECT meter_id, variable, r FROM (
  SELECT *, row_number() OVER (PARTITION BY meter_id ORDER BY abs(r) DESC, place) AS rn FROM (
    SELECT meter_id, 'offpeak_kwh' AS variable, 1 AS place, corr(offpeak_kwh, total_kwh) AS r FROM base GROUP BY meter_id
    UNION ALL SELECT meter_id, 'onpeak_kwh', 2, corr(onpeak_kwh, total_kwh) FROM base GROUP BY meter_id
    UNION ALL SELECT meter_id, 'days_in_month', 3, corr(days_in_month, total_kwh) FROM base GROUP BY meter_id) AS c
  WHERE r IS NOT NULL AND NOT isnan(r)) AS best WHERE rn = 1""",
    "r",
)
O["distribution_flags"] = oracle(
    """
SELECT season, n, mean, median, skew_adj,
  CASE WHEN abs(skew_adj) < 0.5 THEN 'symmetric' WHEN skew_adj > 0 THEN 'right' ELSE 'left' END AS skew_label,
  abs(g1) > 1 AS strongly_skewed, abs((mean - median) / nullif(median, 0)) > 0.1 AS mean_median_apart, skew_adj > 0.5 AS suggest_log1p
FROM (SELECT season, count(*) AS n, avg(total_kwh) AS mean, median(total_kwh) AS median, skewness(total_kwh) AS skew_adj,
             avg(d * d * d) / power(avg(d * d), 1.5) AS g1
      FROM (SELECT *, total_kwh - avg(total_kwh) OVER (PARTITION BY season) AS d FROM base) AS centred GROUP BY 1) AS s""",
    "mean median skew_adj",
)
O["fit_diagnosis"] = oracle(
    """
SELECT model, gap AS rmse_gap_pct, r2gap AS r2_gap,
  CASE WHEN gap < 10 AND r2gap < 0.05 THEN 'good_fit' WHEN gap < 20 AND r2gap < 0.10 THEN 'moderate' ELSE 'severe' END AS fit
FROM (SELECT tr.model, (te.rmse - tr.rmse) / tr.rmse * 100 AS gap, tr.r2 - te.r2 AS r2gap
      FROM metrics AS tr JOIN metrics AS te ON tr.model = te.model WHERE tr.split = 'train' AND te.split = 'test') AS g""",
    "rmse_gap_pct r2_gap",
)
O["overfit_gap"] = oracle(
    """
SELECT tr.model, tr.rmse AS train_rmse, te.rmse AS test_rmse, tr.r2 AS train_r2, te.r2 AS test_r2,
  te.rmse - tr.rmse AS rmse_gap, (te.rmse - tr.rmse) / tr.rmse * 100 AS rmse_gap_pct, tr.r2 - te.r2 AS r2_gap
FROM metrics AS tr JOIN metrics AS te ON tr.model = te.model WHERE tr.split = 'train' AND te.split = 'test'""",
    "train_rmse test_rmse train_r2 test_r2 rmse_gap rmse_gap_pct r2_gap",
)
O["log1p_target"] = oracle(
    """
SELECT meter_id, month_start, bill, ln(1 + bill) AS log1p_bill,
  (SELECT abs(avg(d * d * d) / power(avg(d * d), 1.5)) > 1 FROM (SELECT bill - (SELECT avg(bill) FROM base) AS d FROM base) AS c) AS use_log1p
FROM base""",
    "bill log1p_bill",
)
O["monthly_quality_flags"] = oracle(
    """
SELECT meter_id, negative_months, zero_months, n_months, zero_days, zero_day_pct, zero_day_pct > 10 AS many_zero_days
FROM (SELECT meter_id, count(*) FILTER (WHERE total_kwh < 0) AS negative_months, count(*) FILTER (WHERE total_kwh = 0) AS zero_months,
             count(*) AS n_months FROM monthly GROUP BY 1) AS m
JOIN (SELECT meter_id, count(*) FILTER (WHERE total_kwh = 0) AS zero_days,
             count(*) FILTER (WHERE total_kwh = 0) * 100.0::DOUBLE / count(*) AS zero_day_pct FROM cleaned GROUP BY 1) AS d USING (meter_id)""",
    "zero_day_pct",
)

# joins and scenarios
O["cutoff_expand"] = oracle(
    "SELECT meter_id, month_start, days_in_month, cutoff_day FROM base, (VALUES (10), (15), (20), (25)) AS c(cutoff_day) "
    "WHERE cutoff_day <= days_in_month"
)
O["weather_range_join"] = oracle(
    "SELECT meter_id, month_start, cutoff_day, station_id, first_date, simulation_date, temperature, humidity FROM snaps_weather",
    "temperature humidity",
)
O["weather_season_default"] = oracle(
    f"SELECT meter_id, month_start, season, {SEASON_WEATHER['temperature']} AS temperature, {SEASON_WEATHER['humidity']} AS humidity FROM base",
    "temperature humidity",
)
O["partial_month_scenarios"] = oracle("SELECT * FROM scenarios", SCENARIO_DOUBLES)
O["partial_month_scenarios_clean"] = oracle(season_scenarios("snaps8", "base8"), SCENARIO_DOUBLES)
O["event_scenarios"] = oracle(season_scenarios("event_snaps", "event_base"), SCENARIO_DOUBLES)
O["prediction_alignment"] = oracle(
    """
SELECT model, n_predictions, n_matched, n_predictions - n_matched AS n_without_truth, n_truth - n_matched AS n_without_prediction,
       n_predictions = n_matched AND n_truth = n_matched AS aligned
FROM (SELECT model, count(*) AS n_predictions, count(o_orderkey) AS n_matched
      FROM (SELECT 'line_total' AS model, l_orderkey AS sample_id FROM lineitem GROUP BY l_orderkey
            UNION ALL SELECT model, sample_id FROM predictions) AS p
      LEFT JOIN orders ON o_orderkey = sample_id GROUP BY 1) AS c, (SELECT count(*) AS n_truth FROM orders) AS t"""
)
O["prediction_union"] = oracle("SELECT * FROM predictions", "y yhat")
O["comparison_with_times"] = oracle(
    """
SELECT row_number() OVER (ORDER BY rmse, model) AS rank, model, rmse, mae, r2, max_error,
  (SELECT arg_min(seconds, position) FROM (VALUES (0, 'Linear Baseline', 0.5), (1, 'Linear Regression (Multiple)', 1.25),
     (2, 'Ridge Regression', 2.5), (3, 'Random Forest', 30.0)) AS t(position, name, seconds)
   WHERE contains(replace(lower(name), ' ', '_'), model)) AS training_seconds
FROM metrics WHERE split = 'test'""",
    "rmse mae r2 max_error training_seconds",
)
O["best_model"] = oracle(
    "SELECT split, model, rmse FROM (SELECT *, row_number() OVER (PARTITION BY split ORDER BY rmse, model) AS rn FROM metrics) AS r WHERE rn = 1",
    "rmse",
)
O["best_model_predictions"] = oracle(
    "SELECT * FROM predictions WHERE split = 'test' AND model = (SELECT arg_min(model, rmse) FROM metrics WHERE split = 'test')",
    "y yhat",
)

# cleaning
O["duplicate_report"] = oracle(
    "SELECT meter_id, CAST(sum(n) AS BIGINT) AS duplicate_rows, count(*) AS duplicate_dates FROM "
    "(SELECT meter_id, read_date, count(*) AS n FROM readings GROUP BY 1, 2 HAVING count(*) > 1) AS d GROUP BY 1"
)
O["dedupe_readings"] = oracle("SELECT * FROM deduped", REG + " reg_onpeak")
O["dedupe_readings_max"] = oracle(
    "SELECT meter_id, read_date, max(reg_offpeak) AS reg_offpeak, max(reg_peak) AS reg_peak, max(reg_shoulder) AS reg_shoulder, "
    "max(reg_peak + reg_shoulder) AS reg_onpeak FROM readings GROUP BY 1, 2",
    REG + " reg_onpeak",
)
O["quality_profile"] = oracle(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, "
        f"count(*) FILTER (WHERE {c} < 0) AS n_negative, (count(*) - count({c})) * 100.0::DOUBLE / count(*) AS null_pct FROM readings"
        for c in ("reg_offpeak", "reg_peak", "reg_shoulder")
    ),
    "null_pct",
)
O["fill_readings"] = oracle("SELECT * FROM filled", REG + " reg_onpeak")
O["fill_weather"] = oracle(
    "SELECT station_id, date, "
    + ", ".join(f"coalesce(last_value({c} IGNORE NULLS) OVER b, first_value({c} IGNORE NULLS) OVER a) AS {c}" for c in MEASURES)
    + " FROM weather WINDOW b AS (PARTITION BY station_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
    "a AS (PARTITION BY station_id ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)",
    " ".join(MEASURES),
)
KWH = "offpeak_kwh onpeak_kwh total_kwh"
O["daily_consumption"] = oracle("SELECT * FROM daily", KWH)
O["raw_daily_consumption"] = oracle(
    "SELECT meter_id, date, count(*) AS n_rows, sum(offpeak_kwh) AS offpeak_kwh, sum(onpeak_kwh) AS onpeak_kwh, "
    "sum(total_kwh) AS total_kwh FROM raw_days GROUP BY 1, 2",
    KWH,
)
O["meter_resets"] = oracle(
    "SELECT meter_id, count(*) FILTER (WHERE off_diff < 0 OR on_diff < 0) AS reset_days, count(*) AS days FROM diffs GROUP BY 1"
)
O["outlier_replacement"] = oracle("SELECT * FROM cleaned", KWH)
O["outlier_days_topk"] = oracle(
    "SELECT meter_id, date, total_kwh, position FROM (SELECT *, row_number() OVER (PARTITION BY meter_id ORDER BY date) AS position "
    "FROM flagged WHERE is_outlier) AS o WHERE position <= 10",
    "total_kwh",
)
O["dataset_summary"] = oracle(
    "SELECT meter_id, count(*) AS n_rows, min(simulation_date) AS first_date, max(simulation_date) AS last_date, "
    "count(DISTINCT month_start) AS n_months, count(*)::DOUBLE / count(DISTINCT month_start) AS rows_per_month FROM scenarios GROUP BY 1",
    "rows_per_month",
)

# monthly and weather statistics
O["monthly_consumption"] = oracle("SELECT * FROM monthly", MONTH_DOUBLES)
O["monthly_consumption_dense"] = oracle("SELECT * FROM monthly8", MONTH_DOUBLES)
O["tariff_shares"] = oracle(
    "SELECT meter_id, sum(offpeak_kwh) / nullif(sum(offpeak_kwh + onpeak_kwh), 0) * 100 AS offpeak_share_pct, "
    "sum(onpeak_kwh) / nullif(sum(offpeak_kwh + onpeak_kwh), 0) * 100 AS onpeak_share_pct, "
    "avg(offpeak_kwh / (offpeak_kwh + onpeak_kwh + 0.001)) AS mean_offpeak_ratio, "
    "avg(onpeak_kwh / (offpeak_kwh + onpeak_kwh + 0.001)) AS mean_onpeak_ratio FROM base GROUP BY 1",
    "offpeak_share_pct onpeak_share_pct mean_offpeak_ratio mean_onpeak_ratio",
)


def describe_sql(columns, source):
    return (
        "SELECT column_name, count(value) AS n, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, max(value) AS max, "
        "quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 "
        f"FROM ({long(columns, source)}) AS cells GROUP BY 1"
    )


DESCRIBE = "mean std min max q1 median q3"
O["describe_monthly"] = oracle(describe_sql(["offpeak_kwh", "onpeak_kwh", "total_kwh", "kwh_per_day"], "base"), DESCRIBE)
O["describe_weather"] = oracle(describe_sql(MEASURES, "weather"), DESCRIBE)
O["by_calendar_month"] = oracle(
    "SELECT month, avg(total_kwh) AS mean, stddev_samp(total_kwh) AS std, count(*) AS n, avg(offpeak_kwh) AS mean_offpeak, "
    "avg(onpeak_kwh) AS mean_onpeak FROM base GROUP BY 1",
    "mean std mean_offpeak mean_onpeak",
)
O["by_season"] = oracle(
    """
SELECT season, season_order, mean, std, min, max, n, median, mean_offpeak, mean_onpeak
FROM (VALUES (1, 'inverno'), (2, 'primavera'), (3, 'verão'), (4, 'outono')) AS o(season_order, season)
LEFT JOIN (SELECT season, avg(total_kwh) AS mean, stddev_samp(total_kwh) AS std, min(total_kwh) AS min, max(total_kwh) AS max,
                  count(*) AS n, median(total_kwh) AS median, avg(offpeak_kwh) AS mean_offpeak, avg(onpeak_kwh) AS mean_onpeak
           FROM base GROUP BY 1) AS s USING (season)""",
    "mean std min max median mean_offpeak mean_onpeak",
)
O["by_year"] = oracle(
    "SELECT year, avg(total_kwh) AS mean, stddev_samp(total_kwh) AS std, min(total_kwh) AS min, max(total_kwh) AS max, "
    "count(*) AS n, median(total_kwh) AS median FROM base GROUP BY 1",
    "mean std min max median",
)
O["moments_population"] = oracle(
    f"""
SELECT column_name, count(*) AS n, avg(d * d * d) / power(avg(d * d), 1.5) AS skew_pop, avg(d * d * d * d) / power(avg(d * d), 2) - 3 AS kurt_pop
FROM (SELECT column_name, value - avg(value) OVER (PARTITION BY column_name) AS d FROM ({long(['offpeak_kwh', 'onpeak_kwh'], 'base')}) AS cells) AS c
GROUP BY 1""",
    "skew_pop kurt_pop",
)
O["moments_adjusted"] = oracle(
    f"SELECT meter_id, column_name, count(*) AS n, skewness(value) AS skew_adj, kurtosis(value) AS kurt_adj "
    f"FROM ({long(['total_kwh', 'bill'], 'base', 'meter_id')}) AS cells GROUP BY 1, 2",
    "skew_adj kurt_adj",
)
O["sketched_quantiles"] = oracle(
    " UNION ALL ".join(
        f"SELECT {season('month(date)')} AS season, '{name}' AS quantile, count(*) AS n, quantile_cont(total_kwh, {p}) AS exact, "
        f"true AS within_bound FROM daily GROUP BY 1"
        for name, p in (("p10", 0.1), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("p90", 0.9))
    ),
    "exact",
)
O["tukey_outliers"] = oracle(
    f"""
SELECT b.meter_id, month_start, total_kwh, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high
FROM base AS b JOIN ({quart('total_kwh', 'meter_id', 'base')}) AS q ON q.meter_id = b.meter_id
WHERE total_kwh < q1 - 1.5 * (q3 - q1) OR total_kwh > q3 + 1.5 * (q3 - q1)""",
    "total_kwh low high",
)
O["boxplot_stats"] = oracle(
    f"""
SELECT season, q1, median, q3, low, high, min(total_kwh) FILTER (WHERE total_kwh BETWEEN low AND high) AS whisker_low,
       max(total_kwh) FILTER (WHERE total_kwh BETWEEN low AND high) AS whisker_high,
       count(*) FILTER (WHERE total_kwh NOT BETWEEN low AND high) AS n_fliers, count(*) AS n
FROM base JOIN (SELECT *, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high
                FROM ({quart('total_kwh', 'season', 'base')}) AS q) AS f USING (season) GROUP BY 1, 2, 3, 4, 5, 6""",
    "q1 median q3 low high whisker_low whisker_high",
)


def histogram_sql(value, bins, source, by=""):
    k = f"{by}, " if by else ""
    over = f"(PARTITION BY {by})" if by else "()"
    return f"""
SELECT {k}bin, min(lo) + bin * min((hi - lo) / {bins}) AS bin_low, min(lo) + (bin + 1) * min((hi - lo) / {bins}) AS bin_high,
       count(*) AS n, count(*) / (min(total) * min((hi - lo) / {bins})) AS density
FROM (SELECT {k}lo, hi, total, CAST(least(floor((x - lo) / ((hi - lo) / {bins})), {bins} - 1) AS BIGINT) AS bin
      FROM (SELECT {k}{value} AS x, min({value}) OVER {over} AS lo, max({value}) OVER {over} AS hi, count(*) OVER {over} AS total
            FROM {source}) AS limits) AS placed GROUP BY {k}bin"""


O["histogram"] = oracle(histogram_sql("residual", 30, "residuals", "model, split"), "bin_low bin_high density")
O["monthly_histogram"] = oracle(histogram_sql("total_kwh", 15, "base"), "bin_low bin_high density")
O["normal_overlay"] = oracle(
    """
SELECT season, i, x, mean, std, exp(-0.5 * ((x - mean) / std) * ((x - mean) / std)) / (std * sqrt(2 * pi())) AS density
FROM (SELECT season, i, lo + i * (hi - lo) / 99 AS x, mean, std
      FROM (SELECT season, avg(offpeak_kwh) AS mean, stddev_pop(offpeak_kwh) AS std, min(offpeak_kwh) AS lo, max(offpeak_kwh) AS hi
            FROM base GROUP BY 1) AS p, range(0, 100) AS r(i)) AS points""",
    "x mean std density",
)
O["trend_line"] = oracle(
    "SELECT season, regr_slope(bill, offpeak_kwh) AS slope, regr_intercept(bill, offpeak_kwh) AS intercept, "
    "corr(offpeak_kwh, bill) AS r, count(*) AS n FROM base GROUP BY 1",
    "slope intercept r",
)
O["season_scatter"] = oracle(
    "SELECT meter_id, month_start, season, total_kwh, offpeak_ratio * 100 AS offpeak_pct, offpeak_kwh, onpeak_kwh, days_in_month, bill FROM base",
    "total_kwh offpeak_pct offpeak_kwh onpeak_kwh bill",
)
O["rolling_trend"] = oracle(
    """
SELECT meter_id, month_start, total_kwh, m AS rolling_mean, s AS rolling_std, m - s AS band_low, m + s AS band_high
FROM (SELECT meter_id, month_start, total_kwh, CASE WHEN count(*) OVER w = 6 THEN avg(total_kwh) OVER w END AS m,
             CASE WHEN count(*) OVER w = 6 THEN stddev_samp(total_kwh) OVER w END AS s
      FROM base WINDOW w AS (PARTITION BY meter_id ORDER BY month_start ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING)) AS r""",
    "total_kwh rolling_mean rolling_std band_low band_high",
)
O["stacked_components"] = oracle(
    "SELECT meter_id, month_start, row_number() OVER (PARTITION BY meter_id ORDER BY month_start) - 1 AS position, "
    "offpeak_kwh AS stack_offpeak, offpeak_kwh + onpeak_kwh AS stack_total, "
    "offpeak_kwh / (offpeak_kwh + onpeak_kwh + 0.001) * 100 AS offpeak_pct, "
    "onpeak_kwh / (offpeak_kwh + onpeak_kwh + 0.001) * 100 AS onpeak_pct FROM base",
    "stack_offpeak stack_total offpeak_pct onpeak_pct",
)
O["weather_rolling"] = oracle(
    """
SELECT station_id, date, tmax, tmin, CASE WHEN count(*) OVER w = 30 THEN avg(tmax) OVER w END AS tmax_avg30,
       CASE WHEN count(*) OVER w = 30 THEN avg(tmin) OVER w END AS tmin_avg30
FROM weather WINDOW w AS (PARTITION BY station_id ORDER BY date ROWS BETWEEN 15 PRECEDING AND 14 FOLLOWING)""",
    "tmax tmin tmax_avg30 tmin_avg30",
)
O["weekly_weather"] = oracle(
    """
SELECT s.station_id, s.week, coalesce(sum(rain), 0) AS rain, avg(uv) AS uv
FROM (SELECT station_id, CAST(unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS DATE) AS week
      FROM (SELECT station_id, min(date_trunc('week', date)) + INTERVAL 6 DAY AS lo, max(date_trunc('week', date)) + INTERVAL 6 DAY AS hi
            FROM weather GROUP BY 1) AS ends) AS s
LEFT JOIN weather AS w ON w.station_id = s.station_id AND w.date BETWEEN s.week - INTERVAL 6 DAY AND s.week
GROUP BY 1, 2""",
    "rain uv",
)
O["weather_summary"] = oracle(
    "SELECT station_id, avg(tmax) AS mean_tmax, avg(tmin) AS mean_tmin, max(tmax) AS highest_tmax, min(tmin) AS lowest_tmin, "
    "sum(rain) AS total_rain, count(*) FILTER (WHERE rain > 0) AS rainy_days, "
    "count(*) FILTER (WHERE rain > 0) * 100.0::DOUBLE / count(*) AS rainy_pct, max(rain) AS max_rain, avg(humidity) AS mean_humidity, "
    "min(humidity) AS min_humidity, max(humidity) AS max_humidity, avg(uv) AS mean_uv, max(uv) AS max_uv FROM weather GROUP BY 1",
    "mean_tmax mean_tmin highest_tmax lowest_tmin total_rain rainy_pct max_rain mean_humidity min_humidity max_humidity mean_uv max_uv",
)
_means = "avg(tmax) AS mean_tmax, avg(tmin) AS mean_tmin, sum(rain) AS total_rain, avg(humidity) AS mean_humidity"
O["weather_by_month"] = oracle(
    f"SELECT month(date) AS month, {_means} FROM weather GROUP BY 1", "mean_tmax mean_tmin total_rain mean_humidity"
)
O["weather_by_season"] = oracle(
    f"""
SELECT season, season_order, mean_tmax, mean_tmin, total_rain, mean_humidity, n_days
FROM (VALUES (1, 'Winter'), (2, 'Spring'), (3, 'Summer'), (4, 'Autumn')) AS o(season_order, season)
LEFT JOIN (SELECT {season('month(date)', SEASON_EN)} AS season, {_means}, count(*) AS n_days FROM weather GROUP BY 1) AS s USING (season)""",
    "mean_tmax mean_tmin total_rain mean_humidity",
)

# evaluation
O["abs_error_percentiles"] = oracle(
    "SELECT model, split, "
    + ", ".join(f"quantile_cont(abs_error, 0.{p}) AS p{p}" for p in (50, 75, 90, 95))
    + " FROM residuals GROUP BY 1, 2",
    "p50 p75 p90 p95",
)
O["model_metrics"] = oracle("SELECT * REPLACE (round(mse, 0) AS mse) FROM metrics", "r2 mae mse rmse rmse_mae_ratio max_error mean_y")
O["model_mape"] = oracle("SELECT model, split, avg(abs(pct_error)) AS mape FROM residuals GROUP BY 1, 2", "mape")
O["model_spread"] = oracle(
    """
SELECT split, arg_min(model, rmse) AS best_model, arg_max(model, rmse) AS worst_model, (1 - min(rmse) / max(rmse)) * 100 AS rmse_gain_pct,
       (1 - arg_min(mae, rmse) / arg_max(mae, rmse)) * 100 AS mae_gain_pct, stddev_pop(rmse) / avg(rmse) * 100 AS rmse_cv_pct,
       stddev_pop(rmse) / avg(rmse) * 100 < 5 AS similar
FROM metrics GROUP BY 1""",
    "rmse_gain_pct mae_gain_pct rmse_cv_pct",
)
O["model_ranking"] = oracle(
    "SELECT model, split, rmse, r2, mae, rank, rank = 1 AS is_best FROM "
    "(SELECT *, row_number() OVER (PARTITION BY split ORDER BY rmse, model) AS rank FROM metrics) AS r",
    "rmse r2 mae",
)
O["error_category_counts"] = oracle(
    f"""
SELECT model, split, c.name AS error_category, count(*) FILTER (WHERE {CATEGORY} = c.name) AS n,
       count(*) FILTER (WHERE {CATEGORY} = c.name) * 100.0::DOUBLE / count(*) AS share_pct
FROM residuals JOIN (SELECT model, split, mae FROM metrics) AS m USING (model, split),
     (VALUES ('good'), ('moderate'), ('large')) AS c(name) GROUP BY 1, 2, 3""",
    "share_pct",
)
O["residual_trend"] = oracle(
    """
SELECT model, split, bin, avg(yhat) AS mean_yhat, avg(residual) AS mean_residual, count(*) AS n
FROM (SELECT *, ntile(50) OVER (PARTITION BY model, split ORDER BY yhat, sample_id) AS bin FROM residuals) AS b GROUP BY 1, 2, 3""",
    "mean_yhat mean_residual",
)
O["worst_predictions"] = oracle(
    "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model, split ORDER BY abs_error DESC, sample_id) AS position FROM residuals) AS r "
    "WHERE position <= 5",
    "y yhat residual abs_error pct_error",
)
O["audit_points"] = oracle(
    f"SELECT r.*, {CATEGORY} AS error_category FROM residuals AS r JOIN (SELECT model, split, mae FROM metrics) AS m "
    "ON r.model = m.model AND r.split = m.split",
    "y yhat residual abs_error pct_error",
)
O["plot_bounds"] = oracle(
    "SELECT model, split, least(min(y), min(yhat)) AS axis_low, greatest(max(y), max(yhat)) AS axis_high, "
    "2 * stddev_pop(residual) AS band FROM residuals GROUP BY 1, 2",
    "axis_low axis_high band",
)
O["interval_coverage"] = oracle(
    """
SELECT *, CASE WHEN coverage_pct BETWEEN 90 AND 98 THEN 'well_calibrated' WHEN coverage_pct < 90 THEN 'under_calibrated'
               ELSE 'over_calibrated' END AS calibration
FROM (SELECT split, count(*) AS n, avg(s) AS mean_std, avg(2 * 1.959964 * s) AS mean_width,
             avg(CASE WHEN y BETWEEN m - 1.959964 * s AND m + 1.959964 * s THEN 100.0 ELSE 0.0 END) AS coverage_pct
      FROM (SELECT sample_id, split, max(y) AS y, avg(yhat) AS m, stddev_pop(yhat) AS s FROM predictions
            GROUP BY 1, 2) AS samples GROUP BY 1) AS c""",
    "mean_std mean_width coverage_pct",
)
O["split_summary"] = oracle(
    "SELECT model, split, count(*) AS n, avg(y) AS mean, stddev_samp(y) AS std_sample, stddev_pop(y) AS std_pop, min(y) AS min, "
    "max(y) AS max FROM predictions GROUP BY 1, 2",
    "mean std_sample std_pop min max",
)
O["numeric_validation"] = oracle(
    """
SELECT o_orderpriority AS model, 'y' AS column_name, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_null, 0 AS n_nan, 0 AS n_inf
FROM orders GROUP BY 1
UNION ALL
SELECT o_orderpriority, 'yhat', 0, count(*) FILTER (WHERE o_orderstatus = 'P'), count(*) FILTER (WHERE o_orderstatus = 'F')
FROM orders GROUP BY 1"""
)

# streaming
view(
    "event_sums",
    """
SELECT user_id AS meter_id, CAST(date_trunc('month', ts) AS DATE) AS month_start, count(DISTINCT CAST(ts AS DATE)) AS days_elapsed,
       coalesce(sum(value) FILTER (WHERE event_type IN ('purchase', 'signup')), 0) AS cum_offpeak_kwh,
       coalesce(sum(value) FILTER (WHERE event_type NOT IN ('purchase', 'signup')), 0) AS cum_onpeak_kwh
FROM events GROUP BY 1, 2""",
)
view("event_days", "SELECT user_id AS meter_id, CAST(ts AS DATE) AS date, sum(value) AS total_kwh FROM events GROUP BY 1, 2")
O["stream_unusual_days"] = oracle(
    """
SELECT meter_id, count(*) AS n_days, count_if(total_kwh < 0 OR total_kwh > high) AS n_unusual
FROM (SELECT *, 2 * avg(total_kwh) OVER (PARTITION BY meter_id) AS high FROM event_days) AS d GROUP BY 1"""
)
O["stream_month_to_date"] = oracle(
    f"SELECT *, {PROJECTED} AS projected_bill FROM event_sums", "cum_offpeak_kwh cum_onpeak_kwh projected_bill"
)

view(
    "largest_registers",
    "SELECT meter_id, read_date AS date, max(reg_offpeak) AS off, max(reg_peak + reg_shoulder) AS on_ FROM readings GROUP BY 1, 2",
)
view(
    "register_steps",
    """
SELECT meter_id, date, abs(off - lag(off) OVER w) AS offpeak_kwh, abs(on_ - lag(on_) OVER w) AS onpeak_kwh
FROM (SELECT meter_id, date, on_, coalesce(last_value(off IGNORE NULLS) OVER (PARTITION BY meter_id ORDER BY date), 0) AS off FROM largest_registers) AS f
WINDOW w AS (PARTITION BY meter_id ORDER BY date)""",
)
O["stream_register_days"] = oracle(
    "SELECT *, offpeak_kwh + onpeak_kwh AS total_kwh FROM register_steps WHERE offpeak_kwh IS NOT NULL AND onpeak_kwh IS NOT NULL", KWH
)

# features and folds
O["temporal_split"] = oracle("SELECT meter_id, month_start, cutoff_day, sample_id, split FROM split_rows")
O["ts_folds"] = oracle(
    """
SELECT meter_id, month_start, cutoff_day, sample_id,
       CASE WHEN sample_id <= n_all - 5 * (n_all // 6) THEN 0
            ELSE (sample_id - 1 - (n_all - 5 * (n_all // 6))) // (n_all // 6) + 1 END AS fold
FROM split_rows"""
)
O["kfolds"] = oracle(
    "SELECT meter_id, month_start, cutoff_day, sample_id, ntile(5) OVER (ORDER BY sample_id) - 1 AS fold FROM split_rows"
)
NUMERIC = (
    "cum_offpeak_kwh cum_onpeak_kwh cum_total_kwh days_elapsed days_remaining avg7_offpeak avg7_onpeak avg7_total "
    "temperature humidity projected_bill"
)
O["standardize"] = oracle(
    "SELECT meter_id, month_start, cutoff_day, split, "
    + ", ".join(
        f"({c} - (SELECT avg({c}) FROM split_rows WHERE split = 'train')) / (SELECT stddev_pop({c}) FROM split_rows WHERE split = 'train') AS {c}"
        for c in NUMERIC.split()
    )
    + " FROM split_rows",
    NUMERIC,
)
_hot = [(f"month_{m}", "month", str(m)) for m in range(2, 13)] + [
    (f"season_{s}", "season", f"'{s}'") for s in ("outono", "primavera", "verão")
]
O["one_hot"] = oracle(
    "SELECT meter_id, month_start, cutoff_day, "
    + ", ".join(f'CASE WHEN {c} = {v} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "{n}"' for n, c, v in _hot)
    + " FROM split_rows"
)
view("usable_rows", "SELECT * FROM split_rows WHERE bill IS NOT NULL AND month IS NOT NULL AND season IS NOT NULL AND " + " AND ".join(f"{c} IS NOT NULL" for c in NUMERIC.split()))
O["feature_vectors"] = oracle(
    "SELECT meter_id, month_start, cutoff_day, split, bill AS label, "
    + ", ".join(
        f"(CAST({c} AS DOUBLE) - (SELECT avg({c}) FROM usable_rows WHERE split = 'train')) / (SELECT stddev_pop({c}) FROM usable_rows WHERE split = 'train') AS {c}"
        for c in NUMERIC.split()
    )
    + ", " + ", ".join(f'CASE WHEN {c} = {v} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "{n}"' for n, c, v in _hot)
    + " FROM usable_rows",
    "label " + NUMERIC,
)
O["baseline_ols"] = oracle(
    "SELECT regr_slope(bill, cum_total_kwh) AS slope, regr_intercept(bill, cum_total_kwh) AS intercept, regr_count(bill, cum_total_kwh) AS n "
    "FROM split_rows WHERE split = 'train'",
    "slope intercept",
)
