"""ANSI SQL counterparts of the registered queries, over the same tables."""

from __future__ import annotations

from ..schema import FLAG_PASSES, MODEL_FEATURES, TRAINING_COLUMNS

PLANT = """
line AS (
  SELECT l_suppkey // 20 AS no, CAST(l_shipdate AS DATE) AS d,
         CAST(6 + (l_orderkey + l_linenumber) % 13 AS INTEGER) AS h,
         l_quantity AS q, l_quantity * (1 - l_discount) AS good
  FROM lineitem),
hourly AS (
  SELECT no, d, h, sum(good) / sum(q) AS ratio, count(*) AS n FROM line GROUP BY no, d, h),
dayly AS (
  SELECT no, d, sum(good) / sum(q) AS day_ratio, count(*) AS day_n FROM line GROUP BY no, d),
grid AS (
  SELECT y.no, y.d, CAST(t.h AS INTEGER) AS h, x.n,
         CASE WHEN NOT (y.day_n <= 1 AND t.h >= 11)
           THEN coalesce(x.ratio, y.day_ratio) * (1 - 0.0013717::DOUBLE * ((t.h * 7) % 5 + 1.3731::DOUBLE)) END AS ratio,
         date_diff('day', DATE '1995-01-01', y.d) AS e,
         (date_diff('day', DATE '1995-01-01', y.d) + 41 * y.no) % 120 AS p,
         CASE WHEN t.h BETWEEN 6 AND 18 THEN sin(pi() * (t.h - 5) / 14.0) ELSE 0.0 END AS bell,
         month(y.d) IN (12, 1, 2) AS winter
  FROM dayly y CROSS JOIN range(24) t(h)
  LEFT JOIN hourly x ON x.no = y.no AND x.d = y.d AND x.h = t.h),
stage AS (
  SELECT *, CASE WHEN p BETWEEN 55 AND 59 THEN 0.6::DOUBLE
                 WHEN (e * 7 + no * 3) % 11 < 2 THEN 0.75::DOUBLE ELSE 1.0::DOUBLE END AS sky,
         CASE WHEN p BETWEEN 40 AND 42 THEN 1.25::DOUBLE ELSE 1.0::DOUBLE END AS gain,
         CASE WHEN winter AND e % 9 <= 1 THEN 0.3::DOUBLE
              WHEN p <= 4 AND h BETWEEN 9 AND 15 THEN 0.02::DOUBLE
              WHEN p BETWEEN 30 AND 33 THEN 1 - 0.15::DOUBLE * bell
              WHEN p BETWEEN 55 AND 59 THEN 0.6::DOUBLE
              WHEN p BETWEEN 70 AND 85 THEN 1 - 0.012::DOUBLE * (p - 69)
              WHEN p BETWEEN 95 AND 99 THEN CASE WHEN h % 2 = 0 THEN 0.4::DOUBLE ELSE 0.95::DOUBLE END
              ELSE 1.0::DOUBLE END AS fault,
         CASE WHEN p BETWEEN 20 AND 25 THEN 50.0::DOUBLE
              WHEN p BETWEEN 40 AND 42 THEN 78.0::DOUBLE ELSE 1e9::DOUBLE END AS cap
  FROM grid),
plant AS MATERIALIZED (
  SELECT 'P' || no AS site_id, no, d, h, p, 80.0::DOUBLE * bell * sky * gain AS expected_kw,
         CASE WHEN bell = 0 THEN 0.0::DOUBLE
              WHEN ratio IS NULL OR (p BETWEEN 105 AND 107 AND h >= 11) THEN NULL
              ELSE least(cap, 80.0::DOUBLE * bell * sky * gain * ratio * fault) END AS ac,
         CASE WHEN no % 3 = 2 THEN 1000.0::DOUBLE * bell * sky END AS poa,
         12 + 14 * cos(2 * pi() * (dayofyear(d) - 200) / 365.25::DOUBLE) + 6 * bell
           + CASE WHEN p BETWEEN 30 AND 33 THEN 14.0::DOUBLE ELSE 0.0::DOUBLE END AS temp,
         92.0::DOUBLE * bell * gain AS clear,
         CASE WHEN p BETWEEN 55 AND 57 THEN 0.5::DOUBLE WHEN n >= 2 THEN 0.4::DOUBLE ELSE 0.0::DOUBLE END AS rain,
         CASE WHEN winter AND e % 9 = 0 THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END AS snow
  FROM stage)"""

DAILY = PLANT + """,
sums AS (
  SELECT site_id, no, d, sum(ac) AS actual_kwh, sum(expected_kw) AS expected_kwh,
         count(CASE WHEN ac IS NOT NULL AND expected_kw IS NOT NULL THEN 1 END) / 24.0::DOUBLE AS coverage,
         sum(rain) AS rain_mm, sum(snow) AS snow_cm,
         sum(CASE WHEN expected_kw IS NOT NULL THEN ac END) AS ba,
         sum(CASE WHEN ac IS NOT NULL THEN expected_kw END) AS be
  FROM plant GROUP BY site_id, no, d),
spine AS (
  SELECT site_id, no, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT site_id, no, min(d) AS lo, max(d) AS hi FROM sums GROUP BY site_id, no)),
daily AS (
  SELECT s.site_id, s.no, s.d, actual_kwh, expected_kwh, coalesce(coverage, 0) AS coverage,
         rain_mm, snow_cm, CASE WHEN be > 0 THEN ba / be END AS pi
  FROM spine s LEFT JOIN sums x ON x.site_id = s.site_id AND x.d = s.d)"""


def _passes(windows: dict[int, str] = {30: "TRUE"}) -> str:
    """The passes of the baseline; ``windows``: days -> the sites that have this length."""
    out = """,
f0 AS (SELECT *, pi AS raw_pi, CASE WHEN coverage >= 0.8 THEN pi END AS mpi,
              FALSE AS low, CAST(NULL AS DOUBLE) AS base FROM daily)"""
    med = " ".join(
        f"WHEN {sites} AND count(CASE WHEN NOT low THEN mpi END) OVER w{n} >= {n // 2}"
        f" THEN quantile_cont(CASE WHEN NOT low THEN mpi END, 0.5) OVER w{n}" for n, sites in windows.items())
    frames = ", ".join(
        f"w{n} AS (PARTITION BY site_id ORDER BY d ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)" for n in windows)
    for i in range(1, FLAG_PASSES + 1):
        out += f""",
m{i} AS (SELECT * EXCLUDE (base), CASE {med} END AS med FROM f{i - 1} WINDOW {frames}),
b{i} AS (
  SELECT * EXCLUDE (med), last_value(med IGNORE NULLS) OVER (PARTITION BY site_id ORDER BY d
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS base FROM m{i}),
f{i} AS (SELECT * EXCLUDE (low), coalesce(mpi < 0.92 * base, FALSE) AS low FROM b{i})"""
    return out + f""",
flags AS (
  SELECT site_id, no, d, actual_kwh, expected_kwh, coverage, rain_mm, snow_cm, mpi AS pi, base AS pi_baseline,
         coalesce((low AND mpi < 0.95) OR coverage < 0.8, FALSE) AS flagged FROM f{FLAG_PASSES})"""


FLAGS = DAILY + _passes()

SHAPE_CTE = """,
rowed AS (
  SELECT *, max(ac) OVER (PARTITION BY site_id, d) AS peak, coalesce(expected_kw > 20.0, FALSE) AS lit,
         coalesce(expected_kw > 40.0, FALSE) AS bright, h BETWEEN 10 AND 14 AS mid FROM plant),
marked AS (
  SELECT *, coalesce(ac > 0.97 * peak, FALSE) AS flat,
         coalesce(ac < 0.05 * expected_kw, FALSE) AND lit AS dead,
         CASE WHEN lit THEN ac / expected_kw END AS r FROM rowed),
isl AS (
  SELECT *, sum(CASE WHEN mid AND NOT flat THEN 1 ELSE 0 END) OVER w AS fi,
         sum(CASE WHEN NOT dead THEN 1 ELSE 0 END) OVER w AS di
  FROM marked WINDOW w AS (PARTITION BY site_id, d ORDER BY h)),
flat_runs AS (SELECT site_id, d, max(c) AS run FROM (
  SELECT site_id, d, fi, count(*) AS c FROM isl WHERE mid AND flat GROUP BY ALL) GROUP BY ALL),
dead_runs AS (SELECT site_id, d, max(c) AS run FROM (
  SELECT site_id, d, di, count(*) AS c FROM isl WHERE dead GROUP BY ALL) GROUP BY ALL),
chops AS (SELECT site_id, d, median(abs(dr)) AS chop FROM (
  SELECT site_id, d, r - lag(r) OVER (PARTITION BY site_id, d ORDER BY h) AS dr
  FROM marked WHERE r IS NOT NULL) WHERE dr IS NOT NULL GROUP BY ALL),
agg AS (
  SELECT site_id, d, max(peak) AS peak, max(temp) AS tmax, max(CASE WHEN mid THEN expected_kw END) AS midday_expected,
    CASE WHEN sum(clear) > 0 THEN coalesce(sum(ac), 0) / sum(clear) END AS csr,
    CASE WHEN sum(clear) > 0 THEN coalesce(sum(expected_kw), 0) / sum(clear) END AS model_csr,
    median(CASE WHEN h BETWEEN 7 AND 10 THEN r END) AS morning_ratio,
    median(CASE WHEN h BETWEEN 11 AND 14 THEN r END) AS midday_ratio,
    median(CASE WHEN bright THEN expected_kw - ac END) AS bright_deficit,
    count(CASE WHEN bright THEN 1 END) AS bright_rows, count(r) AS ratio_hours, count(*) AS n_rows,
    count(r) * sum(r * r) - sum(r) * sum(r) AS vr,
    covar_pop(r, temp) AS cov, stddev_pop(r) AS sr, stddev_pop(CASE WHEN r IS NOT NULL THEN temp END) AS st
  FROM marked GROUP BY site_id, d),
shape AS (
  SELECT a.*, coalesce(f.run, 0) AS plateau_run, coalesce(x.run, 0) AS dead_run, coalesce(c.chop, 0) AS chop,
    CASE WHEN ratio_hours >= 5 AND sr > 0 AND st > 0 THEN cov / (sr * st) END AS temp_corr
  FROM agg a LEFT JOIN flat_runs f USING (site_id, d) LEFT JOIN dead_runs x USING (site_id, d)
  LEFT JOIN chops c USING (site_id, d))"""

SHAPE = PLANT + SHAPE_CTE

TRAIL_CTE = """,
snows AS (
  SELECT *, coalesce(sum(snow_cm) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 0) AS snow_3d,
         coalesce(sum(snow_cm) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 0) AS snow_7d,
         coalesce(sum(snow_cm) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 0) AS snow_30d,
         coalesce(count(*) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) = 3
           AND count(pi) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) = 3
           AND max(pi) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) < 0.92 * pi_baseline, FALSE) AS step3,
         quantile_cont(pi, 0.5) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS step3_median,
         coalesce(count(pi) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nth
  FROM flags WINDOW w AS (PARTITION BY site_id ORDER BY d)),
seen AS (SELECT site_id, nth AS k, pi AS y FROM snows WHERE pi IS NOT NULL),
trail AS (
  SELECT s.site_id, s.d, t.k - (s.nth - least(s.nth, 14)) AS i, t.y,
         t.y - lag(t.y) OVER (PARTITION BY s.site_id, s.d ORDER BY t.k) AS dy
  FROM snows s JOIN seen t ON t.site_id = s.site_id AND t.k BETWEEN s.nth - 14 AND s.nth - 1),
falls AS (
  SELECT site_id, d, count(*) AS n, regr_slope(y, i) AS slope,
         min_by(y, i) - max_by(y, i) AS total, -min(dy) AS drop1,
         -list_sum(list_slice(list_sort(list(dy) FILTER (WHERE dy IS NOT NULL)), 1, 2)) AS drop2
  FROM trail GROUP BY site_id, d),
ctx AS (
  SELECT s.*, coalesce(f.n, 0) AS trend_n, CASE WHEN f.n >= 10 THEN f.slope END AS trend_slope,
         CASE WHEN f.n >= 10 THEN f.total END AS trend_total, CASE WHEN f.n >= 10 THEN f.drop1 END AS trend_drop1,
         CASE WHEN f.n >= 10 THEN f.drop2 END AS trend_drop2
  FROM snows s LEFT JOIN falls f ON f.site_id = s.site_id AND f.d = s.d)"""
TRAIL = FLAGS + TRAIL_CTE

LABELS = FLAGS + SHAPE_CTE + TRAIL_CTE + """,
dayt AS (
  SELECT c.*, s.* EXCLUDE (site_id, d) FROM ctx c LEFT JOIN shape s ON s.site_id = c.site_id AND s.d = c.d),
labelled AS (
  SELECT *, CASE
    WHEN NOT flagged THEN CASE WHEN coverage >= 0.8 AND plateau_run >= 2 AND peak >= 76
      AND midday_expected > 1.05 * peak THEN 'clipping' END
    WHEN coverage < 0.8 THEN 'data_gap'
    WHEN (snow_3d >= 1 OR snow_7d >= 5) AND pi < 0.6 AND NOT coalesce(tmax >= 5, FALSE) THEN 'snow'
    WHEN dead_run >= 1 THEN 'outage'
    WHEN tmax >= 32 AND ratio_hours >= 5 AND temp_corr < -0.6 AND bright_rows > 0
      AND NOT coalesce(bright_deficit / 20 >= 0.85, FALSE) THEN 'thermal'
    WHEN plateau_run >= 1.75 AND peak < 76 AND midday_expected > 76 THEN 'outage'
    WHEN morning_ratio > 1.15 AND midday_ratio < 0.92 THEN 'outage'
    WHEN plateau_run >= 2 AND peak >= 76 AND midday_expected > 1.05 * peak THEN 'clipping'
    WHEN no % 3 <> 2 AND csr < 0.75 AND chop > 0.10 THEN 'weather'
    WHEN no % 3 <> 2 AND csr < 0.65 AND coalesce(rain_mm, 0) >= 1 THEN 'weather'
    WHEN no % 3 <> 2 AND csr < 0.50 AND coalesce(model_csr, 1) < 0.75 THEN 'weather'
    WHEN (snow_7d >= 1 OR snow_30d >= 10) AND pi < 0.95 AND NOT coalesce(tmax >= 12, FALSE) THEN 'snow_shedding'
    WHEN no % 3 <> 2 AND csr >= 0.75 AND csr < 0.90 AND chop > 0.10 AND pi >= 0.7 THEN 'cloud_intermittent'
    WHEN step3 THEN 'unclassified'
    WHEN trend_n >= 10 AND trend_slope < -0.003 AND NOT coalesce(trend_drop1 > 0.5 * trend_total, FALSE)
      AND NOT coalesce(trend_drop2 > 0.6 * trend_total, FALSE) THEN 'soiling'
    ELSE 'unclassified' END AS label FROM dayt)"""

INVERTERS = PLANT + """,
inv AS (
  SELECT site_id, d, k, sum(ac / 4.0 * (1 + 0.02::DOUBLE * k) * CASE WHEN p BETWEEN 20 AND 25 AND k = 3 THEN 0.2::DOUBLE
      WHEN p BETWEEN 70 AND 74 AND k = 1 THEN 0.7::DOUBLE WHEN p BETWEEN 12 AND 14 AND k = 2 THEN 0.5::DOUBLE
      ELSE 1.0::DOUBLE END) AS kwh
  FROM plant CROSS JOIN range(1, 5) t(k) GROUP BY site_id, d, k),
ispine AS (
  SELECT site_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT site_id, min(d) AS lo, max(d) AS hi FROM plant GROUP BY site_id)),
ikwh AS (
  SELECT s.site_id, s.d, t.k, coalesce(i.kwh, 0) AS kwh
  FROM ispine s CROSS JOIN range(1, 5) t(k)
  LEFT JOIN inv i ON i.site_id = s.site_id AND i.d = s.d AND i.k = t.k),
norms AS (
  SELECT *, CASE WHEN count(*) OVER w >= 10 THEN quantile_cont(kwh, 0.5) OVER w END AS trail FROM ikwh
  WINDOW w AS (PARTITION BY site_id, k ORDER BY d ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)),
normed AS (
  SELECT *, CASE WHEN trail = 0 AND kwh > 0 THEN 'Infinity'::DOUBLE WHEN trail <> 0 THEN kwh / trail END AS nrm FROM norms),
fleets AS (SELECT site_id, d, median(nrm) AS fleet FROM normed GROUP BY site_id, d),
judged AS (
  SELECT n.*, f.fleet, coalesce(f.fleet > 0.5 AND nrm < 0.9 * f.fleet, FALSE) AS div
  FROM normed n JOIN fleets f USING (site_id, d)),
ref AS (
  SELECT site_id, d, count(CASE WHEN div THEN 1 END) AS n_div,
         coalesce(string_agg(CASE WHEN div THEN 'inv_0' || k END, ',' ORDER BY k), '') AS divergent,
         max(fleet) AS fleet,
         CASE WHEN sum(greatest(trail - kwh, 0)) > 0
           THEN coalesce(sum(CASE WHEN div THEN greatest(trail * fleet - kwh, 0) END), 0)
                / sum(CASE WHEN trail IS NOT NULL THEN greatest(trail - kwh, 0) END) END AS share
  FROM judged GROUP BY site_id, d)"""

FINAL = LABELS + INVERTERS[len(PLANT):] + """,
final AS (
  SELECT l.*, r.n_div, r.share, r.fleet,
    l.label IS NOT NULL AND l.no % 2 = 0 AS graded,
    coalesce(n_div >= 1 AND share >= 0.5, FALSE) AS faulty, coalesce(n_div >= 1 AND share > 0, FALSE) AS partly,
    coalesce(plateau_run >= 1.5 AND peak < 76, FALSE) AS clamped, coalesce(csr < 0.75, FALSE) AS dim,
    coalesce(csr >= 0.75, FALSE) AS sunny
  FROM labelled l LEFT JOIN ref r ON r.site_id = l.site_id AND r.d = l.d),
ruled AS (
  SELECT *, CASE
    WHEN NOT graded OR fleet IS NULL OR label <> 'unclassified' THEN label
    WHEN faulty OR fleet <= 0.5 THEN 'outage'
    WHEN partly THEN CASE WHEN dim THEN 'weather' WHEN clamped THEN 'curtailment' ELSE 'unclassified' END
    WHEN sunny AND clamped THEN 'curtailment' ELSE label END AS final_label,
  CASE WHEN graded AND fleet IS NOT NULL AND label = 'unclassified' AND NOT faulty AND NOT fleet <= 0.5 AND partly
    THEN 'outage' END AS final_label_2,
  CASE WHEN NOT graded THEN NULL WHEN fleet IS NULL THEN 'uncheckable'
    WHEN label = 'outage' THEN CASE WHEN n_div >= 1 OR fleet <= 0.5 THEN 'confirmed' ELSE 'refuted' END
    WHEN label IN ('thermal', 'weather', 'snow', 'snow_shedding', 'cloud_intermittent')
      THEN CASE WHEN faulty THEN 'refuted' ELSE 'confirmed' END
    WHEN label = 'unclassified' AND (faulty OR fleet <= 0.5 OR partly OR (sunny AND clamped)) THEN 'attributed'
    ELSE 'uncheckable' END AS verdict
  FROM final)"""

TRAINING = FINAL + """,
training AS (
  SELECT site_id AS site, d AS date, actual_kwh, expected_kwh, pi, pi_baseline, coverage, rain_mm, snow_cm, flagged,
    CASE WHEN pi_baseline > 0 THEN pi / pi_baseline END AS pi_rel, csr, model_csr, chop,
    plateau_run::DOUBLE AS plateau_run_h, peak / 80 AS peak_frac, midday_expected / 80 AS expected_peak_frac,
    dead_run::DOUBLE AS dead_run_h, morning_ratio, midday_ratio, tmax AS tmax_c, temp_corr,
    snow_3d, snow_7d, snow_30d, trend_slope AS pi_slope_14d,
    CASE WHEN trend_total > 0 THEN trend_drop1 / trend_total END AS pi_drop_share,
    CASE WHEN bright_rows > 0 THEN bright_deficit / 20 END AS unit_count,
    CASE WHEN bright_rows > 0 THEN abs(bright_deficit / 20 - round_even(bright_deficit / 20, 0)) END AS unit_dist,
    sin(2 * pi() * dayofyear(d) / 365.25::DOUBLE) AS doy_sin, cos(2 * pi() * dayofyear(d) / 365.25::DOUBLE) AS doy_cos,
    coalesce(label, 'healthy') AS rule_label, coalesce(final_label, 'healthy') AS final_label,
    coalesce(final_label_2, '') AS final_label_2, coalesce(verdict, '') AS verdict,
    CASE WHEN verdict IN ('confirmed', 'refuted', 'attributed') THEN 'referee' ELSE 'rule' END AS provenance
  FROM ruled)"""

EVENT_IDS = TRAINING + """,
opens AS (
  SELECT *, CASE WHEN lag(final_label) OVER w IS NULL OR lag(final_label) OVER w <> final_label
      OR date_diff('day', lag(date) OVER w, date) <> 1 THEN 1 ELSE 0 END AS opened
  FROM training WINDOW w AS (PARTITION BY site ORDER BY date)),
ids AS (
  SELECT *, site || ':' || final_label || ':' || CAST(sum(opened) OVER (ORDER BY site, date) AS BIGINT) AS event_id
  FROM opens)"""

LAKE = """
lake AS (
  SELECT 'E' || (user_id // 75) AS site_id, ts, event_id,
         list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) AS metric_id,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k,
         CASE CAST(json_extract(props, '$.k') AS INTEGER) % 25 WHEN 0 THEN -999.0 WHEN 1 THEN -9999.0 ELSE value END AS raw
  FROM events),
clean AS (SELECT *, CASE WHEN raw NOT IN (-999, -9999) THEN raw END AS value FROM lake),
labels60 AS (
  SELECT *, date_trunc('hour', ts) + CASE WHEN ts = date_trunc('hour', ts) THEN INTERVAL 0 HOUR ELSE INTERVAL 1 HOUR END AS lab
  FROM clean)"""

SENSOR = LAKE + """,
sensor AS (
  SELECT site_id, date_trunc('hour', ts) AS t, 10 + floor(avg(value) / 60) * 60.0::DOUBLE AS ac,
         floor(avg(k) / 20) * 200.0::DOUBLE - 200.0::DOUBLE AS poa, avg(k) * 1.2::DOUBLE - 40.0::DOUBLE AS temp
  FROM clean WHERE k % 25 > 1 GROUP BY ALL)"""


def _runs(col: str, out: str, src: str) -> str:
    """CTEs flagging flat runs, and straight-line runs, of a non-NULL series."""
    w = "WINDOW w AS (PARTITION BY site_id ORDER BY t)"
    close = lambda x, n: " AND ".join(
        [f"lag({x}, {n}) OVER w IS NOT NULL"]
        + [f"abs({'lag(' + x + ', ' + str(i) + ') OVER w' if i else x} - lag({x}, {n}) OVER w)"
           f" <= 1e-8 + 1e-5 * abs(lag({x}, {n}) OVER w)" for i in range(n)]
    )
    return f""",
{out}_v AS (SELECT site_id, t, {col} AS x, {col} - lag({col}) OVER (PARTITION BY site_id ORDER BY t) AS dx FROM {src}
  WHERE {col} IS NOT NULL),
{out}_e AS (SELECT *, CASE WHEN {close('x', 5)} THEN 1 ELSE 0 END AS flat,
  CASE WHEN {close('dx', 4)} THEN 1 ELSE 0 END AS line FROM {out}_v {w}),
{out} AS (SELECT site_id, t, max(flat) OVER w2 = 1 AS stale, max(line) OVER w2 = 1 AS interp FROM {out}_e
  WINDOW w2 AS (PARTITION BY site_id ORDER BY t ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING))"""


RUNS = SENSOR + _runs("ac", "acr", "sensor") + _runs("poa", "poar", "sensor") + """,
marks AS (
  SELECT s.*, a.stale AND ac <> 0 AND ac < 72 AS ac_stale, a.interp AND ac <> 0 AND ac < 72 AS ac_interp,
         poa < -10 AS poa_negative, p.stale AND poa > 0 AS poa_stale, temp < -35 OR temp > 50 AS temp_range
  FROM sensor s LEFT JOIN acr a USING (site_id, t) LEFT JOIN poar p USING (site_id, t))"""


def q(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip().lstrip(',')}\n{body}"


_TRAIN_NUM = [c for c in TRAINING_COLUMNS if c not in (
    "site", "flagged", "rule_label", "final_label", "final_label_2", "verdict", "provenance", "evidence")]


def _rounded(cols, digits=6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)


SUN_STEPS = """
s1 AS (SELECT *, 2 * pi() / 365 * (dayofyear(d) - 1) AS ga FROM g),
s2 AS (
  SELECT *, 0.006918 - 0.399912 * cos(ga) + 0.070257 * sin(ga) - 0.006758 * cos(2 * ga) + 0.000907 * sin(2 * ga)
      - 0.002697 * cos(3 * ga) + 0.00148 * sin(3 * ga) AS decl,
    229.18 * (0.000075 + 0.001868 * cos(ga) - 0.032077 * sin(ga) - 0.014615 * cos(2 * ga) - 0.040849 * sin(2 * ga)) AS eot
  FROM s1),
s3 AS (SELECT *, radians((h * 60 + eot) / 4 - 180) AS ha, radians(lat) AS phi, radians(tilt) AS b, radians(az) AS fz FROM s2),
s4 AS (
  SELECT *, sin(phi) * sin(decl) + cos(phi) * cos(decl) * cos(ha) AS up,
    sin(decl) * cos(phi) - cos(decl) * sin(phi) * cos(ha) AS nn, -cos(decl) * sin(ha) AS ee FROM s3),
s5 AS (
  SELECT *, up * cos(b) + nn * sin(b) * cos(fz) + ee * sin(b) * sin(fz) AS fc,
    1098.0 * up * exp(-0.057 / greatest(up, 1e-6)) AS ghi FROM s4),
sun AS MATERIALIZED (
  SELECT *, CASE WHEN up > 0 THEN 0.88::DOUBLE * ghi / greatest(up, 1e-6) * greatest(fc, 0)
    + 0.12::DOUBLE * ghi * (1 + cos(b)) / 2 + 0.25::DOUBLE * ghi * (1 - cos(b)) / 2 ELSE 0 END AS cs FROM s5)"""

CLEARSKY = """
g AS (
  SELECT e.k, e.k * 2.0::DOUBLE - 25 AS lat, 25.0::DOUBLE AS tilt, 180.0::DOUBLE AS az, e.d, t.h
  FROM (SELECT DISTINCT user_id % 25 AS k, CAST(ts AS DATE) AS d FROM events) e CROSS JOIN range(24) t(h)),""" + SUN_STEPS

CANONICAL = PLANT + """,
g AS (SELECT *, d + h * INTERVAL 1 HOUR AS t, 35.0::DOUBLE AS lat, 25.0::DOUBLE AS tilt, 180.0::DOUBLE AS az FROM plant),""" \
    + SUN_STEPS + _runs("ac", "acr", "g")

LADDER = PLANT + """,
raw AS (
  SELECT site_id, no, d, h, ac, temp, expected_kw, CASE WHEN poa IS NULL THEN NULL WHEN no % 6 = 5 THEN -50
      WHEN p BETWEEN 10 AND 12 AND h BETWEEN 9 AND 15 THEN 640 WHEN p = 13 AND h = 8 THEN -20
      WHEN p BETWEEN 14 AND 15 THEN poa * 2.2::DOUBLE ELSE poa END AS poa FROM plant),
g AS (SELECT *, d + h * INTERVAL 1 HOUR AS t, 35.0::DOUBLE AS lat, 25.0::DOUBLE AS tilt, 180.0::DOUBLE AS az FROM raw),""" \
    + SUN_STEPS + _runs("ac", "acr", "g") + _runs("poa", "poar", "g") + """,
judged AS (
  SELECT sun.*, coalesce(a.stale AND ac <> 0 AND ac < 72, FALSE) AS ac_stale, coalesce(a.interp AND ac <> 0 AND ac < 72, FALSE) AS ac_interp,
    coalesce(poa < -10, FALSE) AS poa_negative, coalesce(p.stale AND poa > 0, FALSE) AS poa_stale,
    CASE WHEN cs > 200 THEN coalesce(poa / cs > 1.5, FALSE) ELSE FALSE END AS poa_ceiling, temp < -35 OR temp > 50 AS temp_range
  FROM sun LEFT JOIN acr a ON a.site_id = sun.site_id AND a.t = sun.t LEFT JOIN poar p ON p.site_id = sun.site_id AND p.t = sun.t),
gated AS (
  SELECT *, CASE WHEN NOT (ac_stale OR ac_interp) THEN ac END AS kw,
    CASE WHEN NOT (poa_negative OR poa_stale OR poa_ceiling) THEN poa END AS g_poa,
    CASE WHEN NOT temp_range THEN temp END AS g_temp FROM judged),
rung AS (SELECT *, count(g_poa) OVER (PARTITION BY site_id) > 0 AS sensor FROM gated)"""

STREAMED = PLANT + """,
life AS (SELECT site_id, min(d) AS lo, max(d) AS hi FROM plant WHERE ac IS NOT NULL GROUP BY site_id),
sd AS (SELECT site_id, lo, CAST(unnest(generate_series(lo, hi - 1, INTERVAL 1 DAY)) AS DATE) AS d FROM life),
g AS (
  SELECT sd.site_id, sd.lo, sd.d, t.h, x.ac, x.expected_kw, 35.0::DOUBLE AS lat, 25.0::DOUBLE AS tilt, 180.0::DOUBLE AS az
  FROM sd CROSS JOIN range(24) t(h) LEFT JOIN plant x ON x.site_id = sd.site_id AND x.d = sd.d AND x.h = t.h),""" \
    + SUN_STEPS + """,
seen AS (
  SELECT site_id, lo, d, CASE WHEN ac IS NULL AND cs <= 0 THEN 0 ELSE ac END AS ac,
    coalesce(expected_kw, 100 * (cs / 1000) * 0.8::DOUBLE) AS ex FROM sun),
streamed AS (
  SELECT site_id, lo, d, count(CASE WHEN ac IS NOT NULL AND ex IS NOT NULL THEN 1 END) / 24.0::DOUBLE AS coverage,
    sum(CASE WHEN ex IS NOT NULL THEN ac END) AS ba, sum(CASE WHEN ac IS NOT NULL THEN ex END) AS be
  FROM seen GROUP BY site_id, lo, d)"""

_CLOSED = """
SELECT site_id, d AS local_date, round(CASE WHEN coverage >= 0.8 AND be > 0 THEN ba / be END, 6) AS pi,
  round(coverage, 6) AS coverage, CAST(date_diff('day', lo, d) AS INTEGER) AS history_days FROM streamed"""

DATUMS = """
datum AS (
  SELECT user_id % 4 AS node, event_type AS src, event_id, CAST(floor(epoch(ts)) AS BIGINT) AS tsec, value,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)"""

_PAIRS = FLAGS + """,
yp AS (SELECT site_id, d, raw_pi AS pi FROM f0 WHERE coverage >= 0.8 AND raw_pi IS NOT NULL),
span AS (SELECT site_id, min(d) AS lo, max(d) AS hi FROM yp GROUP BY site_id),
nrm AS (SELECT y.site_id, y.d, y.pi / (SELECT median(z.pi) FROM yp z WHERE z.site_id = y.site_id
    AND date_diff('day', s.lo, z.d) <= 364) AS y, s.lo FROM yp y JOIN span s USING (site_id)
  WHERE date_diff('day', s.lo, s.hi) >= 730),
shifted AS (SELECT site_id, CAST(d + INTERVAL 1 YEAR AS DATE) AS at, d AS d0, y AS y0 FROM nrm),
cand AS (
  SELECT n.site_id, n.d, n.y, s.d0, s.y0, row_number() OVER (PARTITION BY n.site_id, n.d ORDER BY s.at DESC, s.d0 DESC) AS rn
  FROM nrm n JOIN shifted s ON s.site_id = n.site_id AND s.at <= n.d AND s.at >= n.d - 8),
pairs AS (SELECT site_id, d, d0, 100.0 * (y - y0) / (date_diff('day', d0, d) * 24 / 8760.0::DOUBLE) AS rate FROM cand WHERE rn = 1)"""

_SOIL = FLAGS + """,
sp AS (SELECT site_id, no, d, raw_pi AS pi FROM f0 WHERE coverage >= 0.8 AND raw_pi IS NOT NULL),
sg AS (
  SELECT site_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT site_id, min(d) AS lo, max(d) AS hi FROM sp GROUP BY site_id)),
s0 AS (SELECT g.site_id, g.d, p.pi FROM sg g LEFT JOIN sp p ON p.site_id = g.site_id AND p.d = g.d),
s1 AS (
  SELECT *, CASE WHEN count(pi) OVER w >= 6 THEN quantile_cont(pi, 0.5) OVER w END AS sm FROM s0
  WINDOW w AS (PARTITION BY site_id ORDER BY d ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)),
s2 AS (SELECT *, sm - lag(sm) OVER (PARTITION BY site_id ORDER BY d) AS st FROM s1),
s3 AS (SELECT site_id, quantile_cont(abs(st), 0.25) AS q1, quantile_cont(abs(st), 0.75) AS q3 FROM s2 GROUP BY site_id),
s4 AS (
  SELECT s2.site_id, d, pi, sum(CASE WHEN st > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END)
    OVER (PARTITION BY s2.site_id ORDER BY d) AS interval_no FROM s2 JOIN s3 ON s3.site_id = s2.site_id)"""

_REPORT = TRAINING + """,
cm AS (SELECT final_label AS t, rule_label AS p, count(*) AS n FROM training GROUP BY ALL),
lab AS (SELECT t AS label FROM cm UNION SELECT p FROM cm),
per AS (
  SELECT label, coalesce((SELECT sum(n) FROM cm WHERE t = label), 0) AS support,
    coalesce((SELECT sum(n) FROM cm WHERE p = label), 0) AS predicted,
    coalesce((SELECT sum(n) FROM cm WHERE p = label AND t = label), 0) AS hit FROM lab),
pr AS (
  SELECT label, support, hit, coalesce(hit / nullif(predicted, 0), 0)::DOUBLE AS precision,
    coalesce(hit / nullif(support, 0), 0)::DOUBLE AS recall FROM per),
scored AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM pr),
rep AS (
  SELECT label, precision, recall, f1, support FROM scored
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM scored
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), sum(support) FROM scored
  UNION ALL SELECT 'accuracy', sum(hit) / sum(support), sum(hit) / sum(support), sum(hit) / sum(support), sum(support) FROM scored)"""


def oracle_sql() -> dict[str, str]:
    out = {
        "sentinel_mask": q(LAKE, "SELECT event_id, metric_id, value FROM clean"),
        "channel_last_value": q(LAKE, """
            SELECT site_id, metric_id, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour,
                   max_by(value, event_id) AS value
            FROM clean WHERE value IS NOT NULL GROUP BY ALL"""),
        "unit_eras": q(LAKE, """
            SELECT event_id, round(CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN value * 0.1::DOUBLE
              WHEN ts >= TIMESTAMP '2024-01-10' THEN value + 5 ELSE (value - 32) * 0.5::DOUBLE END, 6) AS kw FROM clean"""),
        "resample_right_closed": q(LAKE, """
            SELECT site_id, strftime(lab, '%Y-%m-%d %H:%M:%S') AS label, round(avg(value), 6) AS value
            FROM labels60 GROUP BY ALL"""),
        "resample_left_closed": q(LAKE, """
            SELECT site_id, strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS label,
                   round(avg(value), 6) AS value
            FROM clean GROUP BY ALL"""),
        "dedupe_precedence": q(LAKE, """
            SELECT site_id, strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS stamp,
                   max_by(raw, event_id) AS newest, min_by(raw, event_id) AS oldest
            FROM lake GROUP BY ALL"""),
        "lake_canonical": q(LAKE, """,
            chan AS (
              SELECT site_id, metric_id, lab, avg(value) AS v FROM labels60 WHERE value IS NOT NULL GROUP BY ALL),
            conv AS (
              SELECT site_id, metric_id, lab, CASE WHEN metric_id IN (1, 2) THEN v * 0.1::DOUBLE WHEN metric_id = 3 THEN v
                WHEN lab >= TIMESTAMP '2024-01-15' THEN v ELSE (v - 32) * (5.0::DOUBLE / 9) END AS v
              FROM chan WHERE metric_id <= 4),
            sp AS (
              SELECT site_id, unnest(generate_series(min(lab), max(lab), INTERVAL 1 HOUR)) AS lab
              FROM conv GROUP BY site_id)
            SELECT sp.site_id, strftime(sp.lab, '%Y-%m-%d %H:%M:%S') AS label,
              round(CASE WHEN count(CASE WHEN metric_id <= 2 THEN v END) = 2 THEN sum(CASE WHEN metric_id <= 2 THEN v END) END, 6) AS ac_power_kw,
              round(max(CASE WHEN metric_id = 3 THEN v END), 6) AS poa_wm2,
              round(max(CASE WHEN metric_id = 4 THEN v END), 6) AS temp_c
            FROM sp LEFT JOIN conv c ON c.site_id = sp.site_id AND c.lab = sp.lab GROUP BY ALL"""),
        "csv_plants": q(PLANT, """,
            m AS (SELECT site_id, d + h * INTERVAL 1 HOUR AS t, temp,
              CASE WHEN no % 2 = 0 AND date_diff('day', DATE '1995-01-01', d) % 5 = 0 THEN ac + 1 ELSE ac END AS ac FROM plant),
            sp AS (
              SELECT site_id, unnest(generate_series(min(t), max(t), INTERVAL 1 HOUR)) AS t FROM m GROUP BY site_id)
            SELECT sp.site_id, strftime(sp.t, '%Y-%m-%d %H:%M:%S') AS label, round(ac, 6) AS ac_power_kw,
              round(temp + 5.0::DOUBLE / 9, 6) AS temp_c
            FROM sp LEFT JOIN m ON m.site_id = sp.site_id AND m.t = sp.t"""),
        "csv_inverters": q(PLANT, """
            SELECT site_id, strftime(d + h * INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS label, 'inv_0' || k AS inverter,
              round(ac / 4.0 * (1 + 0.02::DOUBLE * k) * CASE WHEN p BETWEEN 20 AND 25 AND k = 3 THEN 0.2::DOUBLE
                WHEN p BETWEEN 70 AND 74 AND k = 1 THEN 0.7::DOUBLE WHEN p BETWEEN 12 AND 14 AND k = 2 THEN 0.5::DOUBLE
                ELSE 1.0::DOUBLE END, 6) AS kw
            FROM plant CROSS JOIN range(1, 5) t(k) WHERE NOT (no % 2 = 0 AND year(d) = 1996 AND k = 4)"""),
        "csv_lake": q(PLANT, """,
            long AS (
              SELECT d, 'meter' AS name, 1 AS metric_id, ac AS v FROM plant UNION ALL SELECT d, 'temp', 3, temp FROM plant
              UNION ALL SELECT d, 'rain', 2, rain FROM plant WHERE year(d) >= 1995)
            SELECT name, CAST(metric_id AS INTEGER) AS metric_id, CAST(year(d) AS INTEGER) AS year, count(*) AS n,
              round(sum(v), 3) AS total FROM long WHERE v IS NOT NULL GROUP BY ALL"""),
        "hour_to_grid": q(LAKE, """,
            wx AS (
              SELECT site_id, date_trunc('hour', ts) + INTERVAL 1 HOUR AS hr, avg(value) AS poa_model, sum(k) * 0.1::DOUBLE AS rain
              FROM clean WHERE metric_id IN (1, 2) AND value IS NOT NULL GROUP BY ALL),
            sp AS (
              SELECT site_id, unnest(generate_series(date_trunc('day', min(ts)), max(ts), INTERVAL 15 MINUTE)) AS t
              FROM clean GROUP BY site_id)
            SELECT sp.site_id, strftime(sp.t, '%Y-%m-%d %H:%M:%S') AS label, round(poa_model, 6) AS poa_model,
                   round(rain / 4, 6) AS rain_model
            FROM sp LEFT JOIN wx ON wx.site_id = sp.site_id AND wx.hr =
              date_trunc('hour', sp.t) + CASE WHEN sp.t = date_trunc('hour', sp.t) THEN INTERVAL 0 HOUR ELSE INTERVAL 1 HOUR END"""),
        # summer time of these years: first Sunday of April to last Sunday of October, at 2:00
        "localized_stamps": """
            WITH t AS (
              SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS d, l_orderkey % 4 AS h,
                make_date(year(l_shipdate), 4, 1) AS april, make_date(year(l_shipdate), 10, 31) AS october FROM lineitem),
            u AS (
              SELECT *, april + CAST((7 - dayofweek(april)) % 7 AS INTEGER) AS forth,
                october - CAST(dayofweek(october) AS INTEGER) AS back,
                CAST(epoch(CAST(d AS TIMESTAMP)) AS BIGINT) + h * 3600 + 1800 AS wall FROM t)
            SELECT l_orderkey, l_linenumber, CAST(CASE WHEN d = back AND h = 1 THEN NULL
                WHEN d = forth AND h = 2 THEN wall - 1800 + 8 * 3600
                WHEN (d > forth AND d < back) OR (d = forth AND h > 2) OR (d = back AND h < 1) THEN wall + 7 * 3600
                ELSE wall + 8 * 3600 END AS BIGINT) AS epoch FROM u""",
        "expected_power": q(PLANT, """,
            x AS (SELECT site_id, d, h, clear / 0.092::DOUBLE - 20 AS g FROM plant)
            SELECT site_id, d AS local_date, CAST(h AS BIGINT) AS hour,
              round(100 * (g / 1000) * 0.8::DOUBLE * (greatest(g, 0) * 1055) / (1000 * (greatest(g, 0) + 55)), 6) AS expected_kw,
              round(100 * (g / 1000) * 0.8::DOUBLE, 6) AS flat_kw
            FROM x"""),
        "clearsky_curve": q(CLEARSKY, """
            SELECT k AS site, strftime(d, '%Y-%m-%d') AS day, h AS hour, round(cs, 5) AS poa FROM sun"""),
        "canonical_dataset": q(CANONICAL, """,
            m AS (SELECT sun.*, CASE WHEN coalesce((a.stale OR a.interp) AND ac <> 0 AND ac < 72, FALSE) THEN NULL ELSE ac END AS kw
              FROM sun LEFT JOIN acr a ON a.site_id = sun.site_id AND a.t = sun.t)
            SELECT site_id, strftime(t, '%Y-%m-%d %H:%M:%S') AS label,
              round(CASE WHEN kw IS NULL AND cs <= 0 THEN 0 ELSE kw END, 6) AS ac_power_kw, round(expected_kw, 6) AS expected_kw,
              round(100 * (cs / 1000) * 0.8::DOUBLE, 5) AS clearsky_kw, round(temp, 6) AS temp_c, round(rain, 6) AS rain_mm,
              round(snow, 6) AS snow_cm FROM m"""),
        "stale_runs": q(RUNS, "SELECT site_id, strftime(t, '%Y-%m-%d %H:%M:%S') AS label, CAST(stale AS INTEGER) AS stale FROM acr"),
        "interp_runs": q(RUNS, "SELECT site_id, strftime(t, '%Y-%m-%d %H:%M:%S') AS label, CAST(interp AS INTEGER) AS interp FROM acr"),
        "quality_counts": q(RUNS, """
            SELECT site_id, check_name, n FROM (
              SELECT site_id, 'meter stale' AS check_name, count(CASE WHEN ac_stale THEN 1 END) AS n FROM marks GROUP BY site_id
              UNION ALL SELECT site_id, 'meter interpolated', count(CASE WHEN ac_interp THEN 1 END) FROM marks GROUP BY site_id
              UNION ALL SELECT site_id, 'poa negative', count(CASE WHEN poa_negative THEN 1 END) FROM marks GROUP BY site_id
              UNION ALL SELECT site_id, 'poa stale', count(CASE WHEN poa_stale THEN 1 END) FROM marks GROUP BY site_id
              UNION ALL SELECT site_id, 'temp out of range', count(CASE WHEN temp_range THEN 1 END) FROM marks GROUP BY site_id)
            WHERE n > 0"""),
        "quality_gate": q(RUNS, """
            SELECT site_id, strftime(t, '%Y-%m-%d %H:%M:%S') AS label, CASE WHEN NOT (ac_stale OR ac_interp) THEN ac END AS ac_power_kw,
                   CASE WHEN NOT (poa_negative OR poa_stale) THEN poa END AS poa_wm2,
                   round(CASE WHEN NOT temp_range THEN temp END, 6) AS temp_c FROM marks"""),
        "daily_build": q(DAILY, """
            SELECT site_id, d AS local_date, round(actual_kwh, 4) AS actual_kwh, round(expected_kwh, 4) AS expected_kwh,
                   round(coverage, 6) AS coverage, round(rain_mm, 6) AS rain_mm, round(snow_cm, 6) AS snow_cm, round(pi, 6) AS pi
            FROM daily"""),
        "baseline_flags": q(FLAGS, """
            SELECT site_id, d AS local_date, round(pi, 6) AS pi, round(pi_baseline, 6) AS pi_baseline,
                   CAST(flagged AS INTEGER) AS flagged FROM flags"""),
        "baseline_windows": q(DAILY + _passes({30: "no % 2 = 0", 45: "no % 2 = 1"}), """
            SELECT site_id, d AS local_date, round(pi, 6) AS pi, round(pi_baseline, 6) AS pi_baseline,
                   CAST(flagged AS INTEGER) AS flagged FROM flags"""),
        "day_shape": q(SHAPE, """
            SELECT site_id, d AS local_date, round(peak, 6) AS peak, round(tmax, 6) AS tmax,
                   round(midday_expected, 6) AS midday_expected, round(csr, 6) AS csr, round(model_csr, 6) AS model_csr,
                   round(chop, 6) AS chop, CAST(plateau_run AS BIGINT) AS plateau_run, CAST(dead_run AS BIGINT) AS dead_run,
                   round(morning_ratio, 6) AS morning_ratio, round(midday_ratio, 6) AS midday_ratio,
                   round(bright_deficit, 6) AS bright_deficit, bright_rows, ratio_hours, round(temp_corr, 5) AS temp_corr
            FROM shape"""),
        "snow_trails": q(TRAIL, """
            SELECT site_id, d AS local_date, round(snow_3d, 6) AS snow_3d, round(snow_7d, 6) AS snow_7d,
                   round(snow_30d, 6) AS snow_30d FROM snows"""),
        "pi_step": q(TRAIL, """
            SELECT site_id, d AS local_date, CAST(step3 AS INTEGER) AS step3, round(step3_median, 6) AS step3_median FROM snows"""),
        "pi_trend14": q(TRAIL, """
            SELECT site_id, d AS local_date, CAST(trend_n AS BIGINT) AS trend_n, round(trend_slope, 6) AS trend_slope,
                   round(trend_total, 6) AS trend_total, round(trend_drop1, 6) AS trend_drop1,
                   round(trend_drop2, 6) AS trend_drop2 FROM ctx"""),
        "rule_labels": q(LABELS, """
            SELECT site_id, d AS local_date, label, round(pi, 6) AS pi FROM labelled WHERE label IS NOT NULL"""),
        "clipping_census": q(LABELS, """
            SELECT site_id, d AS local_date, label FROM labelled WHERE label = 'clipping' AND NOT flagged"""),
        "inverter_divergence": q(INVERTERS, """
            SELECT site_id, d AS local_date, n_div AS n_divergent, divergent, round(fleet, 6) AS fleet_median,
                   round(share, 5) AS div_share FROM ref"""),
        "referee_verdicts": q(FINAL, """
            SELECT site_id, d AS local_date, label, final_label, final_label_2, verdict FROM ruled WHERE label IS NOT NULL"""),
        "label_counts": q(FINAL, """
            SELECT site_id, final_label, count(*) AS n FROM ruled WHERE final_label IS NOT NULL GROUP BY ALL"""),
        "verdict_counts": q(FINAL, """
            SELECT site_id, verdict, count(*) AS n FROM ruled WHERE verdict IS NOT NULL GROUP BY ALL"""),
        "refuted_days": q(FINAL, """
            SELECT site_id, d AS local_date, final_label AS label FROM ruled WHERE verdict = 'refuted'"""),
        "energy_series": q(DAILY, """
            SELECT site_id, d AS local_date, 'actual_kwh' AS series, round(actual_kwh, 4) AS kwh FROM daily
            UNION ALL SELECT site_id, d, 'expected_kwh', round(expected_kwh, 4) FROM daily"""),
        "pi_series": q(FINAL, """
            SELECT site_id, d AS local_date, round(pi, 6) AS pi, round(pi_baseline, 6) AS pi_baseline,
                   round(0.92::DOUBLE * pi_baseline, 6) AS threshold, round(CASE WHEN flagged THEN pi END, 6) AS flagged_pi,
                   final_label FROM ruled"""),
        "labelled_curves": q(FINAL, """
            SELECT p.site_id, p.d AS local_date, p.h AS hour, round(p.ac, 6) AS ac_power_kw,
                   round(p.expected_kw, 6) AS expected_kw, round(p.clear, 6) AS clearsky_kw
            FROM plant p JOIN ruled r ON r.site_id = p.site_id AND r.d = p.d WHERE r.final_label IS NOT NULL"""),
        "feature_vector": q(TRAINING, f"""
            SELECT site, date, {_rounded(c for c in _TRAIN_NUM if c not in ('actual_kwh', 'expected_kwh', 'temp_corr', 'pi_drop_share'))}, round(pi_drop_share, 2) AS pi_drop_share,
                   round(temp_corr, 5) AS temp_corr FROM training"""),
        "training_frame": q(TRAINING, """
            SELECT site, date, round(actual_kwh, 4) AS actual_kwh, round(expected_kwh, 4) AS expected_kwh, round(pi, 6) AS pi,
                   CAST(flagged AS INTEGER) AS flagged, rule_label, final_label, final_label_2, verdict, provenance FROM training"""),
        "feature_shuffle": q(TRAINING, """,
            own AS (SELECT site, date, csr, row_number() OVER (ORDER BY site, date) AS i FROM training),
            lot AS (SELECT csr, chop, row_number() OVER (
              ORDER BY sha256('7:' || site || ':' || CAST(date AS VARCHAR)), site, date) AS i FROM training)
            SELECT own.site, own.date, round(own.csr, 6) AS csr, round(lot.csr, 6) AS moved_csr, round(lot.chop, 6) AS moved_chop
            FROM own JOIN lot ON lot.i = own.i"""),
        "event_ids": q(EVENT_IDS, "SELECT site, date, final_label, event_id FROM ids"),
        "event_split": q(EVENT_IDS, """
            SELECT site, date, event_id, CAST(CAST(('0x' || substr(sha256('dev' || event_id), 1, 16)) AS UBIGINT)::DOUBLE
              / 18446744073709551616.0::DOUBLE < 0.2 AS INTEGER) AS is_test FROM ids"""),
        "class_weights": q(TRAINING, """,
            t AS (SELECT * FROM training WHERE final_label NOT IN ('data_gap', 'unclassified')),
            c AS (SELECT final_label, count(*) AS n FROM t GROUP BY ALL)
            SELECT final_label, provenance, round((SELECT count(*) FROM t) / ((SELECT count(*) FROM c) * c.n::DOUBLE)
                * CASE WHEN provenance = 'referee' THEN 5 ELSE 1 END, 6) AS weight, count(*) AS n
            FROM t JOIN c USING (final_label) GROUP BY final_label, provenance, c.n"""),
        "classification_report": q(_REPORT, """
            SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
                   CAST(support AS BIGINT) AS support FROM rep"""),
        "confusions": q(TRAINING, """
            SELECT final_label AS truth, rule_label AS pred, count(*) AS n FROM training
            WHERE final_label <> rule_label GROUP BY ALL ORDER BY n DESC, truth, pred LIMIT 8"""),
        "agreement_by_class": q(TRAINING, """
            SELECT final_label AS truth, count(*) AS n, round(avg(CASE WHEN final_label = rule_label THEN 1.0 ELSE 0.0 END), 6) AS agreement
            FROM training GROUP BY ALL"""),
        "overruled_days": q(TRAINING, """
            SELECT site, date, rule_label, final_label FROM training
            WHERE provenance = 'referee' AND rule_label <> final_label"""),
        "event_islands": q(FINAL, """,
            lab AS (SELECT site_id, d, final_label AS label FROM ruled WHERE final_label IS NOT NULL),
            seg AS (SELECT *, sum(CASE WHEN pl = label AND date_diff('day', pd, d) = 1 THEN 0 ELSE 1 END)
                OVER (PARTITION BY site_id ORDER BY d) AS s
              FROM (SELECT *, lag(label) OVER w AS pl, lag(d) OVER w AS pd FROM lab WINDOW w AS (PARTITION BY site_id ORDER BY d)))
            SELECT site_id, label, min(d) AS start, max(d) AS "end" FROM seg GROUP BY site_id, s, label"""),
        "event_rollup": q(FINAL, """,
            lab AS (SELECT site_id, d, final_label AS label, pi FROM ruled WHERE final_label IS NOT NULL),
            seg AS (SELECT *, sum(CASE WHEN pl = label AND date_diff('day', pd, d) = 1 THEN 0 ELSE 1 END)
                OVER (PARTITION BY site_id ORDER BY d) AS s
              FROM (SELECT *, lag(label) OVER w AS pl, lag(d) OVER w AS pd FROM lab WINDOW w AS (PARTITION BY site_id ORDER BY d))),
            sg AS (SELECT site_id, s, any_value(label) AS label, min(d) AS a, max(d) AS z FROM seg GROUP BY site_id, s),
            gp AS (SELECT *, coalesce(label = 'data_gap' AND lag(label) OVER w = lead(label) OVER w
                AND date_diff('day', lag(z) OVER w, a) = 1 AND date_diff('day', z, lead(a) OVER w) = 1, FALSE) AS gap
              FROM sg WINDOW w AS (PARTITION BY site_id ORDER BY a)),
            nu AS (SELECT *, sum(CASE WHEN gap OR coalesce(pg, FALSE) THEN 0 ELSE 1 END) OVER (PARTITION BY site_id ORDER BY a) AS seq
              FROM (SELECT *, lag(gap) OVER (PARTITION BY site_id ORDER BY a) AS pg FROM gp)),
            ev AS (SELECT site_id, seq, arg_min(label, a) AS label, min(a) AS a, max(z) AS z FROM nu GROUP BY site_id, seq)
            SELECT e.site_id, CAST(e.seq AS BIGINT) AS event_seq, e.label, e.a AS start, e.z AS "end",
              CAST(date_diff('day', e.a, e.z) + 1 AS BIGINT) AS days,
              round(median(CASE WHEN r.final_label IS NOT NULL THEN r.pi END), 6) AS median_pi,
              round(coalesce(sum(CASE WHEN r.coverage >= 0.8 THEN r.expected_kwh - r.actual_kwh END), 0), 4) AS energy_deficit_kwh
            FROM ev e JOIN ruled r ON r.site_id = e.site_id AND r.d BETWEEN e.a AND e.z
            GROUP BY e.site_id, e.seq, e.label, e.a, e.z"""),
        "yoy_rate": q(_PAIRS, """
,
            rates AS (SELECT site_id, round(median(rate), 6) AS rate, count(*) AS n_pairs FROM pairs GROUP BY site_id)
            SELECT span.site_id, rates.rate, rates.n_pairs FROM span LEFT JOIN rates ON rates.site_id = span.site_id"""),
        "yoy_pairs": q(_PAIRS, """
            SELECT site_id, d AS local_date, d0 AS paired_with, round(rate, 5) AS rate FROM pairs"""),
        "insolation": q(PLANT, """,
            s AS (SELECT site_id, d, sum(greatest(poa, 0)) AS x FROM plant WHERE no % 3 = 2 GROUP BY ALL),
            sp AS (SELECT site_id, CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM s GROUP BY site_id)
            SELECT sp.site_id, sp.d AS local_date, round(coalesce(x, 0), 4) AS insolation
            FROM sp LEFT JOIN s ON s.site_id = sp.site_id AND s.d = sp.d"""),
        "soiling_intervals": q(_SOIL, """
            SELECT site_id, CAST(interval_no AS BIGINT) AS interval_no, min(d) AS start, count(*) AS days, count(pi) AS n_obs FROM s4 GROUP BY ALL"""),
        "soiling_fits": q(_SOIL, """,
            n0 AS (SELECT site_id, interval_no, min(d) AS start FROM s4 GROUP BY ALL),
            o AS (SELECT s4.site_id, s4.interval_no, s4.pi, date_diff('day', n0.start, s4.d) AS x FROM s4
              JOIN n0 ON n0.site_id = s4.site_id AND n0.interval_no = s4.interval_no WHERE s4.pi IS NOT NULL),
            m AS (SELECT a.site_id, a.interval_no, round(median((b.pi - a.pi) / (b.x - a.x)), 6) AS slope
              FROM o a JOIN o b ON b.site_id = a.site_id AND b.interval_no = a.interval_no AND b.x > a.x GROUP BY ALL)
            SELECT n0.site_id, CAST(n0.interval_no AS BIGINT) AS interval_no, m.slope
            FROM n0 LEFT JOIN m ON m.site_id = n0.site_id AND m.interval_no = n0.interval_no"""),
        "wide_to_long": """
            SELECT name, CAST(year(l_shipdate) AS BIGINT) AS year, count(*) AS n, round(sum(value), 3) AS total FROM (
              SELECT l_shipdate, 'l_quantity' AS name, l_quantity AS value FROM lineitem
              UNION ALL SELECT l_shipdate, 'l_extendedprice', l_extendedprice FROM lineitem
              UNION ALL SELECT l_shipdate, 'l_discount', l_discount FROM lineitem
              UNION ALL SELECT l_shipdate, 'l_tax', l_tax FROM lineitem) GROUP BY ALL""",
        "datum_status": q(DATUMS, """
            SELECT status, count(*) AS n FROM (SELECT CASE WHEN k % 10 IN (0, 1, 2) THEN 'rejected' WHEN src <> 'view' THEN 'ignored'
              WHEN k % 10 = 3 THEN 'rejected' ELSE 'stored' END AS status FROM datum) GROUP BY ALL"""),
        "stream_rejects": q(DATUMS, """
            SELECT src AS source_id, count(*) AS n FROM datum WHERE k % 10 IN (0, 1, 2) OR (k % 10 = 3 AND src = 'view') GROUP BY src"""),
        "stream_counts": q(DATUMS, """,
            s AS (SELECT k % 10 IN (0, 1, 2) OR (k % 10 = 3 AND src = 'view') AS bad, src FROM datum)
            SELECT count(CASE WHEN NOT bad THEN 1 END) AS accepted, count(CASE WHEN bad THEN 1 END) AS rejected,
              count(CASE WHEN NOT bad AND src = 'view' THEN 1 END) AS stored, CAST(3 AS BIGINT) AS batches FROM s"""),
        "datum_upsert": q(DATUMS, """
            SELECT node, b AS bucket, max_by(value, event_id) AS watts FROM (
              SELECT *, tsec - tsec % 3600 AS b FROM datum WHERE src = 'view' AND k % 10 > 3) GROUP BY ALL"""),
        "trust_ladder": q(LADDER, """
            SELECT site_id, strftime(t, '%Y-%m-%d %H:%M:%S') AS label, round(g_poa, 6) AS poa_wm2,
              round(CASE WHEN sensor THEN 100 * (g_poa / 1000) * 0.8::DOUBLE WHEN no % 4 <> 3 THEN expected_kw
                ELSE 100 * (cs / 1000) * 0.8::DOUBLE END, 5) AS expected_kw, round(g_temp, 6) AS temp_c FROM rung"""),
        "night_zero": q(LADDER, """
            SELECT site_id, d AS local_date, count(x) AS n, count(CASE WHEN x = 0 THEN 1 END) AS zeros, round(sum(x), 4) AS kwh
            FROM (SELECT *, CASE WHEN kw IS NULL AND cs <= 0 THEN 0 ELSE kw END AS x FROM gated) GROUP BY ALL"""),
        "poa_checks": q(LADDER, """
            SELECT site_id, check_name, n FROM (
              SELECT site_id, 'meter stale' AS check_name, count(CASE WHEN ac_stale THEN 1 END) AS n FROM judged GROUP BY site_id
              UNION ALL SELECT site_id, 'meter interpolated', count(CASE WHEN ac_interp THEN 1 END) FROM judged GROUP BY site_id
              UNION ALL SELECT site_id, 'poa negative', count(CASE WHEN poa_negative THEN 1 END) FROM judged GROUP BY site_id
              UNION ALL SELECT site_id, 'poa stale', count(CASE WHEN poa_stale THEN 1 END) FROM judged GROUP BY site_id
              UNION ALL SELECT site_id, 'poa above clear ceiling', count(CASE WHEN poa_ceiling THEN 1 END) FROM judged GROUP BY site_id
              UNION ALL SELECT site_id, 'temp out of range', count(CASE WHEN temp_range THEN 1 END) FROM judged GROUP BY site_id)
            WHERE n > 0"""),
        "prediction_delivery": q(DAILY, """
            SELECT site_id, d AS local_date, CAST(epoch(CAST(d + 1 AS TIMESTAMP)) AS BIGINT) AS stamp,
              CASE WHEN coverage >= 0.8 THEN 'healthy' ELSE 'data_gap' END AS label, round(coverage, 4) AS confidence,
              CAST(date_diff('day', DATE '1995-01-01', d) AS INTEGER) AS history_days FROM daily"""),
        "stream_boot": q(STREAMED, _CLOSED),
        "stream_replay_chunks": q(STREAMED, _CLOSED),
        "stream_late_weather": q(STREAMED, _CLOSED + " QUALIFY d <= max(d) OVER (PARTITION BY site_id) - 2"),
        "pending_days": q(DATUMS, """,
            lab AS (SELECT node, CAST(make_timestamp((tsec + 3600) * 1000000) AS DATE) AS d FROM datum WHERE src = 'view'),
            sp AS (SELECT node, CAST(unnest(generate_series(min(d), max(d) - 1, INTERVAL 1 DAY)) AS DATE) AS d FROM lab GROUP BY node),
            closed AS (SELECT DISTINCT node, CAST(make_timestamp((tsec + 3600) * 1000000) AS DATE) AS d FROM datum WHERE src = 'error' AND k < 4)
            SELECT node, d AS local_date FROM sp WHERE NOT EXISTS (SELECT 1 FROM closed c WHERE c.node = sp.node AND c.d = sp.d)"""),
    }
    return out
