"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The SQL is written independently of the Spark plans from the documented
semantics.  Rounding of doubles follows Spark's rule (round the shortest
decimal text half-up), written as ``RND(x, n)`` below and expanded to a
decimal cast.
"""

from __future__ import annotations


class C:
    """Fixed values, written out here and not imported, so that a wrong one in the library shows."""

    ACTION_CHECK_STATUS = "Send push/SMS asking if the driver is safe and prepare assistance triage."
    ACTION_ESCALATE = "Flag this active trip for operational review and possible outbound contact."
    ACTION_EVENT_NUDGE = "Send an in-app safety nudge during the trip."
    ACTION_POINTS = "Add safe-driving points to the customer's reward wallet."
    ACTION_WINDOW_NUDGE = "Send a real-time safety nudge before the risky pattern becomes a claim."
    CHECK_DRIVER_STATUS = "CHECK_DRIVER_STATUS"
    CLAIM_RATE_MAX = 2.5
    CLAIM_RATE_MIN = 0.0001
    CLAIM_RULE_BETA = {
        "speeding_ratio": 1.3,
        "hard_braking_count_per_100km": 0.012,
        "harsh_acceleration_count_per_100km": 0.01,
        "night_event_ratio": 0.55,
        "bad_weather_event_ratio": 0.5,
        "phone_usage_count": 0.12,
    }
    CLAIM_RULE_INTERCEPT = -5.15
    COMMITTED_COEFFICIENTS = (
        ("intercept", -3.9642357053226336),
        ("speeding_ratio", 1.0605755894906441),
        ("hard_braking_count_per_100km", 0.008673115566415842),
        ("harsh_acceleration_count_per_100km", 0.0056476225341995845),
        ("night_event_ratio", 0.9652447617386383),
        ("bad_weather_event_ratio", -0.25270991966130324),
        ("phone_usage_count", -0.15931899635964047),
    )
    ESCALATE_HIGH_RISK_REVIEW = "ESCALATE_HIGH_RISK_REVIEW"
    ESCALATE_PHONE = 3
    ESCALATE_SCORE = 12
    EVENT_HIGH_SCORE = 5
    EVENT_NUDGE_SCORE = 4
    GRANT_SAFE_DRIVING_POINTS = "GRANT_SAFE_DRIVING_POINTS"
    MESSAGE_CHECK_STATUS = "Wykryto gwaltowne zdarzenie. Czy wszystko w porzadku?"
    MESSAGE_EVENT_NUDGE = "W ostatnich minutach jazda wyglada ryzykownie. Zwolnij i zachowaj wiekszy odstep."
    MESSAGE_POINTS = "Dobra, spokojna jazda. Dodajemy punkty safe driving do Twojego konta."
    MESSAGE_ROLLING_RISK = "Widzimy podwyzszone ryzyko tej podrozy. Jedz ostrozniej, zeby utrzymac bonus."
    MESSAGE_WINDOW_RISK = "Widzimy podwyzszone ryzyko tej podrozy. Jedz ostrozniej, zeby utrzymac bonus za bezpieczna jazde."
    METRICS_NOTE = "If residual variance materially exceeds the mean, consider Negative Binomial or Tweedie."
    MIN_MEAN_FREQUENCY = 1e-09
    NUDGE_INTENSITY = 0.45
    NUDGE_MIN_EVENTS = 5
    POINTS_MIN_EVENTS = 10
    POINTS_MIN_KM = 0.25
    POISSON_MAX_COUNT = 30
    PROFILE_EFFECT = {
        "safe": -0.45,
        "average": 0.0,
        "aggressive": 0.45,
        "night_driver": 0.25,
        "urban_driver": 0.1,
    }
    RULES_WITHOUT_EXTREME = (
        ("is_speeding", "speeding"),
        ("is_hard_braking", "hard_braking"),
        ("is_harsh_acceleration", "harsh_acceleration"),
        ("is_sharp_cornering", "sharp_cornering"),
        ("is_night_risk", "night_speed_risk"),
        ("is_bad_weather", "bad_weather"),
        ("is_phone_usage", "phone_usage"),
    )
    RULES_WITH_EXTREME = (
        ("is_speeding", "speeding"),
        ("is_hard_braking", "hard_braking"),
        ("is_extreme_braking", "extreme_braking"),
        ("is_harsh_acceleration", "harsh_acceleration"),
        ("is_sharp_cornering", "sharp_cornering"),
        ("is_night_risk", "night_speed_risk"),
        ("is_bad_weather", "bad_weather"),
        ("is_phone_usage", "phone_usage"),
    )
    SEND_SAFETY_NUDGE = "SEND_SAFETY_NUDGE"
    SOURCE_EVENT = "event"
    SOURCE_ROLLING = "rolling_window_demo"
    SOURCE_SLIDING = "sliding_window_5m"
    WINDOW_REASON_PREFIX = "5-minute window: events="


# fixed values of the projection and of the pricing inputs, written out like those of C
COMPRESSION_US_PER_MS = 200000
PROFILE_K = (30, 75, 130, 90, 80)
PROFILES = ("safe", "average", "aggressive", "night_driver", "urban_driver")
SOURCE_EPOCH_US = 1704067200000000
TARGET_EPOCH_MS = 1767225600000
USERS_PER_DRIVER = 6
EXPOSURE_SCALE = 10.0
LABEL_D_MULT = 7919
LABEL_MINUTE_MULT = 104729
LABEL_MOD = 10007
RUNS = (
    (900.0, 0.2, "2026-01-01T01:12:00+00:00"),
    (950.0, 0.15, "2026-01-01T02:24:00+00:00"),
    (1000.0, 0.1, "2026-01-01T03:36:00+00:00"),
)
SPLIT_D_MULT = 31
SPLIT_MINUTE_MULT = 17
SPLIT_MOD = 4

ORACLE: dict[str, str] = {}


def _expand_rounding(sql: str) -> str:
    """RND(x, n) -> Spark-compatible half-up rounding of a double; BRND -> half-even."""

    def expand(name: str, fn: str, text: str) -> str:
        out, i = [], 0
        token = name + "("
        while True:
            j = text.find(token, i)
            if j < 0:
                out.append(text[i:])
                return "".join(out)
            out.append(text[i:j])
            depth, k = 1, j + len(token)
            while depth:
                ch = text[k]
                depth += ch == "("
                depth -= ch == ")"
                k += 1
            inner = text[j + len(token) : k - 1]
            # split on the last top-level comma
            depth, cut = 0, None
            for pos, ch in enumerate(inner):
                if ch == "(":
                    depth += 1
                elif ch == ")":
                    depth -= 1
                elif ch == "," and depth == 0:
                    cut = pos
            arg, places = inner[:cut], inner[cut + 1 :]
            arg = expand(name, fn, arg)
            out.append(f"CAST({fn}(CAST(CAST(CAST({arg} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,28)), {places.strip()}) AS DOUBLE)")
            i = k

    sql = expand("BRND", "round_even", sql)
    return expand("RND", "round", sql)


def sql(name: str, text: str) -> None:
    ORACLE[name] = _expand_rounding(text.strip())


def _k_case() -> str:
    arms = " ".join(f"WHEN {i} THEN {k}" for i, k in enumerate(PROFILE_K))
    return f"CASE p {arms} END"


_PROFILE_CASE = "CASE p " + " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(PROFILES)) + " END"

# The event projection (same formulas as the Spark fixture, in DuckDB syntax).
EV = f"""
ev0 AS (
  SELECT event_id AS e, user_id // {USERS_PER_DRIVER} AS d, (user_id // {USERS_PER_DRIVER}) % 5 AS p,
         hour(ts) AS src_hour,
         {TARGET_EPOCH_MS} + (epoch_us(ts) - {SOURCE_EPOCH_US}) // {COMPRESSION_US_PER_MS} AS event_ms
  FROM events),
ev1 AS (SELECT *, CAST(30 + 10 * (e % 9) AS BIGINT) AS limit_i, {_k_case()} AS k FROM ev0),
ev AS (
  SELECT CAST(e AS VARCHAR) AS event_id,
         'D' || lpad(CAST(d + 1 AS VARCHAR), 4, '0') AS driver_id,
         'V' || lpad(CAST(d + 1 AS VARCHAR), 4, '0') AS vehicle_id,
         {_PROFILE_CASE} AS driver_profile,
         strftime(epoch_ms(event_ms), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS event_time,
         CAST(limit_i AS DOUBLE) + CAST((((e * 7919) % 311) * k) // 500 - (42 * k) // 100 AS DOUBLE) / 2 AS speed_kmh,
         CAST(limit_i AS DOUBLE) AS speed_limit_kmh,
         CAST((((e * 104729) % 400) * k) // 100 - 50 AS DOUBLE) / 100 AS acceleration_ms2,
         CAST(-((((e * 1299709) % 500) * k) // 100) AS DOUBLE) / 100 AS braking_ms2,
         CAST((((e * 15485863) % 400) * k) // 100 AS DOUBLE) / 1000 AS cornering_g,
         CASE WHEN limit_i <= 60 THEN 'urban' WHEN limit_i <= 90 THEN 'suburban' ELSE 'highway' END AS road_type,
         CASE WHEN p = 0 THEN (CASE WHEN e % 29 = 0 THEN 'rain' ELSE 'clear' END)
              WHEN e % 7 = 0 THEN 'rain' WHEN e % 31 = 3 THEN 'fog' WHEN e % 37 = 5 THEN 'snow' ELSE 'clear' END AS weather,
         (src_hour >= 22 OR src_hour < 6) AS is_night,
         CAST(20 + (e * 31) % 50 AS DOUBLE) / 1000 AS distance_delta_km,
         ((e * 37) % 29 = 0 AND p <> 0) AS phone_usage,
         e + 1 AS event_no,
         event_ms
  FROM ev1)"""

# Flags (incl. incident flags) on top of EV.
FL = (
    EV
    + """,
fl0 AS (
  SELECT *,
         speed_kmh > speed_limit_kmh + 10 AS is_speeding,
         greatest(speed_kmh - speed_limit_kmh, 0.0) AS speeding_margin,
         braking_ms2 < -3.0 AS is_hard_braking,
         braking_ms2 < -5.0 AS is_extreme_braking,
         acceleration_ms2 > 2.5 AS is_harsh_acceleration,
         cornering_g > 0.35 AS is_sharp_cornering,
         is_night AND speed_kmh > speed_limit_kmh AS is_night_risk,
         weather IN ('rain', 'fog', 'snow') AS is_bad_weather,
         phone_usage AS is_phone_usage
  FROM ev),
fl1 AS (
  SELECT *,
         CAST(is_speeding AS INTEGER) + CAST(is_hard_braking AS INTEGER) + CAST(is_harsh_acceleration AS INTEGER)
         + CAST(is_sharp_cornering AS INTEGER) + CAST(is_night_risk AS INTEGER) + CAST(is_bad_weather AS INTEGER)
         + CAST(is_phone_usage AS INTEGER) AS risk_score_event,
         is_extreme_braking OR (braking_ms2 < -4.2 AND speed_kmh > 60 AND is_sharp_cornering) AS possible_crash_or_incident
  FROM fl0),
fl AS (SELECT *, risk_score_event > 0 AS risk_event FROM fl1)"""
)


def windows_cte(name: str, size_min: int, src: str = "fl") -> str:
    """Event rows exploded to their (window_start, window_end) seconds; size minutes, step one minute."""
    return f"""{name} AS (
  SELECT f.*, (event_ms // 60000 - j) * 60 AS window_start, (event_ms // 60000 - j) * 60 + {size_min * 60} AS window_end
  FROM {src} f CROSS JOIN range(0, {size_min}) t(j))"""


FEATURE_AGGS = """
  driver_id,
  count(*) AS event_count,
  RND(sum(distance_delta_km), 4) AS km_driven,
  RND(avg(speed_kmh), 2) AS avg_speed,
  max(speed_kmh) AS max_speed,
  CAST(sum(CAST(is_speeding AS INTEGER)) AS BIGINT) AS speeding_count,
  CAST(sum(CAST(is_hard_braking AS INTEGER)) AS BIGINT) AS hard_braking_count,
  CAST(sum(CAST(is_harsh_acceleration AS INTEGER)) AS BIGINT) AS harsh_acceleration_count,
  CAST(sum(CAST(is_sharp_cornering AS INTEGER)) AS BIGINT) AS sharp_cornering_count,
  CAST(sum(CAST(is_night AS INTEGER)) AS BIGINT) AS night_event_count,
  CAST(sum(CAST(is_bad_weather AS INTEGER)) AS BIGINT) AS bad_weather_event_count,
  CAST(sum(CAST(phone_usage AS INTEGER)) AS BIGINT) AS phone_usage_count,
  CAST(sum(CAST(risk_event AS INTEGER)) AS BIGINT) AS risk_event_count,
  window_start, window_end"""

FEATURE_DERIVED = """
  driver_id, event_count, km_driven, avg_speed, max_speed, speeding_count, hard_braking_count,
  harsh_acceleration_count, sharp_cornering_count, night_event_count, bad_weather_event_count,
  phone_usage_count, risk_event_count,
  RND(speeding_count / event_count, 9) AS speeding_ratio,
  RND(night_event_count / event_count, 9) AS night_event_ratio,
  RND(bad_weather_event_count / event_count, 9) AS bad_weather_event_ratio,
  greatest(km_driven, 0.001) AS exposure_km,
  RND(risk_event_count / greatest(km_driven, 0.001) * 100.0, 9) AS risk_events_per_100km,
  window_start, window_end"""


def features_sql(size_min: int, where: str = "TRUE") -> str:
    return f"""WITH {FL},
{windows_cte('fw', size_min)},
agg AS (SELECT {FEATURE_AGGS} FROM fw WHERE event_ms IS NOT NULL GROUP BY driver_id, window_start, window_end)
SELECT {FEATURE_DERIVED} FROM agg WHERE {where}"""


FLAG_COLS = """is_speeding, speeding_margin, is_hard_braking, is_harsh_acceleration, is_sharp_cornering,
  is_night_risk, is_bad_weather, is_phone_usage, risk_score_event, risk_event"""

sql("risk_flags", f"WITH {FL} SELECT event_id, driver_id, event_ms AS event_time_ts, {FLAG_COLS} FROM fl")
sql("features_tumbling_1m", features_sql(1))
sql("features_sliding_5m", features_sql(5))


# --- shared SQL pieces -----------------------------------------------------------------------------

def dbl(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def lin(pairs) -> str:
    """Left-to-right linear predictor text: ((0 + b0) + b1*x1) + ..."""
    text = dbl(0.0)
    for term, beta in pairs:
        text = f"({text} + {dbl(beta) if term in ('intercept', 'const') else dbl(beta) + ' * ' + term})"
    return text


def rules_text(with_extreme: bool) -> str:
    rules = C.RULES_WITH_EXTREME if with_extreme else C.RULES_WITHOUT_EXTREME
    arms = ", ".join(f"CASE WHEN {flag} THEN '{name}' END" for flag, name in rules)
    return f"concat_ws('|', {arms})"


PROFILE_EFFECT_SQL = (
    "CASE driver_profile "
    + " ".join(f"WHEN '{k}' THEN {dbl(v)}" for k, v in C.PROFILE_EFFECT.items())
    + f" ELSE {dbl(0.0)} END"
)

ALERT_SELECT = f"""event_id, driver_id, vehicle_id, event_ms AS event_time_ts, {rules_text(False)} AS active_rules,
  risk_score_event, speed_kmh, speed_limit_kmh, acceleration_ms2, braking_ms2, cornering_g, road_type, weather,
  is_night, distance_delta_km, phone_usage"""

EVENT_DECISION_CTE = f"""ed AS (
  SELECT *,
    CASE WHEN possible_crash_or_incident THEN '{C.CHECK_DRIVER_STATUS}'
         WHEN risk_score_event >= {C.EVENT_NUDGE_SCORE} THEN '{C.SEND_SAFETY_NUDGE}' END AS decision_type,
    CASE WHEN possible_crash_or_incident THEN '{C.ACTION_CHECK_STATUS}' ELSE '{C.ACTION_EVENT_NUDGE}' END AS recommended_action,
    CASE WHEN possible_crash_or_incident THEN '{C.MESSAGE_CHECK_STATUS}' ELSE '{C.MESSAGE_EVENT_NUDGE}' END AS customer_message,
    {rules_text(True)} AS active_rules
  FROM fl)"""

STREAM_PRIORITY = (
    f"CASE WHEN possible_crash_or_incident THEN 'critical' WHEN risk_score_event >= {C.EVENT_HIGH_SCORE} THEN 'high' "
    "ELSE 'medium' END"
)
DEMO_PRIORITY = "CASE WHEN possible_crash_or_incident THEN 'critical' ELSE 'high' END"

DW_CTES = f"""{windows_cte('fw5', 5)},
dw0 AS (
  SELECT driver_id, count(*) AS event_count, RND(sum(distance_delta_km), 4) AS km_driven, RND(avg(speed_kmh), 2) AS avg_speed,
    CAST(sum(CAST(risk_event AS INTEGER)) AS BIGINT) AS risk_event_count,
    CAST(sum(risk_score_event) AS BIGINT) AS risk_score_5m,
    CAST(sum(CAST(is_speeding AS INTEGER)) AS BIGINT) AS speeding_count,
    CAST(sum(CAST(is_hard_braking AS INTEGER)) AS BIGINT) AS hard_braking_count,
    CAST(sum(CAST(is_harsh_acceleration AS INTEGER)) AS BIGINT) AS harsh_acceleration_count,
    CAST(sum(CAST(is_sharp_cornering AS INTEGER)) AS BIGINT) AS sharp_cornering_count,
    CAST(sum(CAST(is_bad_weather AS INTEGER)) AS BIGINT) AS bad_weather_event_count,
    CAST(sum(CAST(is_night AS INTEGER)) AS BIGINT) AS night_event_count,
    CAST(sum(CAST(phone_usage AS INTEGER)) AS BIGINT) AS phone_usage_count,
    window_start, window_end
  FROM fw5 WHERE event_ms IS NOT NULL GROUP BY driver_id, window_start, window_end),
dw AS (
  SELECT *, risk_event_count / event_count AS risk_intensity,
    risk_event_count / greatest(km_driven, {dbl(0.001)}) * {dbl(100.0)} AS risk_events_per_100km
  FROM dw0),
wd0 AS (
  SELECT *,
    CASE WHEN risk_score_5m >= {C.ESCALATE_SCORE} OR phone_usage_count >= {C.ESCALATE_PHONE} THEN '{C.ESCALATE_HIGH_RISK_REVIEW}'
         WHEN event_count >= {C.NUDGE_MIN_EVENTS} AND risk_intensity >= {dbl(C.NUDGE_INTENSITY)} THEN '{C.SEND_SAFETY_NUDGE}'
         WHEN event_count >= {C.POINTS_MIN_EVENTS} AND risk_event_count = 0 AND km_driven >= {dbl(C.POINTS_MIN_KM)}
           THEN '{C.GRANT_SAFE_DRIVING_POINTS}' END AS decision_type
  FROM dw),
wd AS (
  SELECT '{C.SOURCE_SLIDING}' AS decision_source, driver_id, window_start, window_end, decision_type,
    CASE decision_type WHEN '{C.ESCALATE_HIGH_RISK_REVIEW}' THEN 'high' WHEN '{C.SEND_SAFETY_NUDGE}' THEN 'medium' ELSE 'low' END AS priority,
    CASE decision_type WHEN '{C.ESCALATE_HIGH_RISK_REVIEW}' THEN '{C.ACTION_ESCALATE}'
         WHEN '{C.SEND_SAFETY_NUDGE}' THEN '{C.ACTION_WINDOW_NUDGE}' ELSE '{C.ACTION_POINTS.replace("'", "''")}' END AS recommended_action,
    CASE WHEN decision_type = '{C.GRANT_SAFE_DRIVING_POINTS}' THEN '{C.MESSAGE_POINTS}' ELSE '{C.MESSAGE_WINDOW_RISK}' END AS customer_message,
    '{C.WINDOW_REASON_PREFIX}' || CAST(event_count AS VARCHAR) || ', risk_events=' || CAST(risk_event_count AS VARCHAR)
      || ', risk_score=' || CAST(risk_score_5m AS VARCHAR) || ', phone_usage=' || CAST(phone_usage_count AS VARCHAR) AS decision_reason,
    event_count, km_driven, avg_speed, RND(risk_intensity, 3) AS risk_intensity,
    RND(risk_events_per_100km, 2) AS risk_events_per_100km, risk_event_count, risk_score_5m, speeding_count,
    hard_braking_count, harsh_acceleration_count, sharp_cornering_count, bad_weather_event_count, night_event_count,
    phone_usage_count
  FROM wd0 WHERE decision_type IS NOT NULL)"""

# Pricing features (one-minute windows per driver and profile, exposure x10), prepared.
PF_CTES = f"""{windows_cte('fw1', 1)},
pagg AS (SELECT driver_profile, {FEATURE_AGGS} FROM fw1 WHERE event_ms IS NOT NULL
         GROUP BY driver_id, driver_profile, window_start, window_end),
pf0 AS (
  SELECT driver_id, driver_profile, window_start, event_count, hard_braking_count, harsh_acceleration_count, phone_usage_count,
    speeding_count / event_count AS speeding_ratio, night_event_count / event_count AS night_event_ratio,
    bad_weather_event_count / event_count AS bad_weather_event_ratio,
    greatest(km_driven, {dbl(0.001)}) * {dbl(EXPOSURE_SCALE)} AS exposure_raw,
    CAST(substr(driver_id, 2) AS BIGINT) - 1 AS d, (window_start - {1767225600}) // 60 AS minute
  FROM pagg),
pf1 AS (SELECT *, greatest(exposure_raw, {dbl(0.001)}) AS exposure_km FROM pf0),
pf AS (
  SELECT *, hard_braking_count / exposure_km * {dbl(100.0)} AS hard_braking_count_per_100km,
    harsh_acceleration_count / exposure_km * {dbl(100.0)} AS harsh_acceleration_count_per_100km
  FROM pf1)"""

RULE_ETA = lin([("intercept", C.CLAIM_RULE_INTERCEPT), *C.CLAIM_RULE_BETA.items()])
COMMITTED_ETA = lin(C.COMMITTED_COEFFICIENTS)

TS_CTES = f"""{PF_CTES},
lab0 AS (SELECT *, exposure_km * exp({RULE_ETA} + {PROFILE_EFFECT_SQL}) AS expected_claim_rate FROM pf),
lab1 AS (
  SELECT driver_id, window_start, least(greatest(expected_claim_rate, {dbl(C.CLAIM_RATE_MIN)}), {dbl(C.CLAIM_RATE_MAX)}) AS lamc,
    (CAST((d * {LABEL_D_MULT} + minute * {LABEL_MINUTE_MULT}) % {LABEL_MOD} AS DOUBLE) + {dbl(0.5)}) / {dbl(LABEL_MOD)} AS u
  FROM lab0),
lab2 AS (
  SELECT driver_id, window_start, u, k, exp(-lamc) * pow(lamc, k) / CAST(factorial(CAST(k AS INTEGER)) AS DOUBLE) AS pmf
  FROM lab1, range(0, {C.POISSON_MAX_COUNT + 1}) t(k)),
lab3 AS (
  SELECT driver_id, window_start, u,
    sum(pmf) OVER (PARTITION BY driver_id, window_start ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cdf
  FROM lab2),
lab4 AS (SELECT driver_id, window_start, CAST(sum(CASE WHEN cdf < u THEN 1 ELSE 0 END) AS BIGINT) AS claim_count
         FROM lab3 GROUP BY driver_id, window_start),
tset AS (SELECT lab0.*, lab4.claim_count,
           (d * {SPLIT_D_MULT} + minute * {SPLIT_MINUTE_MULT}) % {SPLIT_MOD} = 0 AS is_test
         FROM lab0 JOIN lab4 USING (driver_id, window_start)),
tpred0 AS (SELECT driver_id, window_start, exposure_km, claim_count,
             exp({COMMITTED_ETA}) * greatest(exposure_km, {dbl(0.001)}) AS predicted_claim_count
           FROM tset WHERE is_test),
tpred AS (SELECT *, predicted_claim_count / greatest(exposure_km, {dbl(0.001)}) AS predicted_frequency FROM tpred0)"""

ROLLUP_SELECT = """driver_id, sum(exposure_km) AS exposure_km, avg(speeding_ratio) AS speeding_ratio,
    avg(hard_braking_count_per_100km) AS hard_braking_count_per_100km,
    avg(harsh_acceleration_count_per_100km) AS harsh_acceleration_count_per_100km,
    avg(night_event_ratio) AS night_event_ratio, avg(bad_weather_event_ratio) AS bad_weather_event_ratio,
    CAST(sum(phone_usage_count) AS BIGINT) AS phone_usage_count"""

HISTORY_COLS = """driver_id, exposure_km, speeding_ratio, hard_braking_count_per_100km, harsh_acceleration_count_per_100km,
  night_event_ratio, bad_weather_event_ratio, phone_usage_count, predicted_claim_count, predicted_frequency, risk_multiplier,
  target_technical_premium, technical_premium_previous, technical_premium, scored_at, base_premium, premium_change_cap"""

HISTORY_OUT = """driver_id, RND(exposure_km, 9) AS exposure_km, RND(speeding_ratio, 9) AS speeding_ratio,
  RND(hard_braking_count_per_100km, 9) AS hard_braking_count_per_100km,
  RND(harsh_acceleration_count_per_100km, 9) AS harsh_acceleration_count_per_100km,
  RND(night_event_ratio, 9) AS night_event_ratio, RND(bad_weather_event_ratio, 9) AS bad_weather_event_ratio,
  phone_usage_count, RND(predicted_claim_count, 9) AS predicted_claim_count, RND(predicted_frequency, 9) AS predicted_frequency,
  RND(risk_multiplier, 9) AS risk_multiplier, RND(target_technical_premium, 6) AS target_technical_premium,
  technical_premium_previous, technical_premium, scored_at, base_premium, premium_change_cap"""


def _run_ctes(i: int, base: float, cap: float, stamp: str, history: str | None) -> str:
    prev = (
        f"""r{i}_prev AS (
  SELECT driver_id, technical_premium AS tp FROM (
    SELECT driver_id, technical_premium,
      row_number() OVER (PARTITION BY driver_id ORDER BY scored_at DESC, technical_premium DESC) AS rn
    FROM {history}) WHERE rn = 1),"""
        if history
        else f"r{i}_prev AS (SELECT NULL::VARCHAR AS driver_id, NULL::DOUBLE AS tp WHERE FALSE),"
    )
    return f"""r{i}_roll AS (SELECT {ROLLUP_SELECT} FROM pf WHERE driver_id IS NOT NULL GROUP BY driver_id),
r{i}_p0 AS (SELECT *, exp({COMMITTED_ETA}) * greatest(exposure_km, {dbl(0.001)}) AS predicted_claim_count FROM r{i}_roll),
r{i}_p1 AS (SELECT *, predicted_claim_count / greatest(exposure_km, {dbl(0.001)}) AS predicted_frequency FROM r{i}_p0),
r{i}_mean AS (SELECT greatest(avg(predicted_frequency), {dbl(C.MIN_MEAN_FREQUENCY)}) AS mf FROM r{i}_p1),
{prev}
r{i}_s AS (
  SELECT p.*, p.predicted_frequency / m.mf AS risk_multiplier,
    {dbl(base)} * (p.predicted_frequency / m.mf) AS target_technical_premium,
    coalesce(h.tp, {dbl(base)}) AS technical_premium_previous
  FROM r{i}_p1 p CROSS JOIN r{i}_mean m LEFT JOIN r{i}_prev h ON p.driver_id = h.driver_id),
r{i} AS (
  SELECT {HISTORY_COLS.replace('technical_premium, scored_at', f'BRND(least(greatest(target_technical_premium, technical_premium_previous * {dbl(1.0 - cap)}), technical_premium_previous * {dbl(1.0 + cap)}), 2) AS technical_premium, {chr(39)}{stamp}{chr(39)} AS scored_at').replace('base_premium, premium_change_cap', f'{dbl(base)} AS base_premium, {dbl(cap)} AS premium_change_cap')}
  FROM r{i}_s)"""


def premium_ctes() -> str:
    parts = []
    history = None
    for i, (base, cap, stamp) in enumerate(RUNS, start=1):
        parts.append(_run_ctes(i, base, cap, stamp, history))
        hist_name = f"h{i}"
        union = " UNION ALL ".join(f"SELECT {HISTORY_COLS} FROM r{j}" for j in range(1, i + 1))
        parts.append(f"{hist_name} AS ({union})")
        history = hist_name
    return f"{PF_CTES},\n" + ",\n".join(parts)


# --- 2.2 event level -------------------------------------------------------------------------------

EVENT_COLS = """event_id, driver_id, vehicle_id, driver_profile, event_time, speed_kmh, speed_limit_kmh, acceleration_ms2,
  braking_ms2, cornering_g, road_type, weather, is_night, distance_delta_km, phone_usage"""

sql("parse_events", f"WITH {EV} SELECT {EVENT_COLS}, event_ms AS event_time_ts FROM ev")
sql("event_time_normalise", f"WITH {EV} SELECT event_id, event_time, event_ms AS event_time_ts FROM ev")
sql(
    "incident_flags",
    f"WITH {FL} SELECT event_id, driver_id, is_sharp_cornering, is_extreme_braking, possible_crash_or_incident FROM fl",
)
sql(
    "active_rules",
    f"WITH {FL} SELECT event_id, {rules_text(False)} AS alert_rules, {rules_text(True)} AS decision_rules FROM fl",
)
sql("risk_filter", f"WITH {FL} SELECT event_id, driver_id, risk_score_event FROM fl WHERE risk_event")
sql("alerts", f"WITH {FL} SELECT {ALERT_SELECT} FROM fl WHERE risk_event")
sql("payload_encode", f"WITH {FL} SELECT driver_id AS key, {ALERT_SELECT} FROM fl WHERE risk_event")
sql(
    "event_preview",
    f"WITH {FL} SELECT event_id, driver_id, event_ms AS event_time_ts, speed_kmh, speed_limit_kmh, risk_score_event FROM fl",
)
_ED_TAIL = """event_id, driver_id, vehicle_id, driver_profile, event_ms AS event_time_ts, decision_type, {prio} AS priority,
  recommended_action, customer_message, active_rules, risk_score_event, speed_kmh, speed_limit_kmh, braking_ms2, cornering_g,
  road_type, weather, is_night, phone_usage"""
sql(
    "event_decisions",
    f"WITH {FL}, {EVENT_DECISION_CTE} SELECT '{C.SOURCE_EVENT}' AS decision_source, "
    + _ED_TAIL.format(prio=STREAM_PRIORITY)
    + " FROM ed WHERE decision_type IS NOT NULL",
)
sql(
    "event_decisions_demo_policy",
    f"WITH {FL}, {EVENT_DECISION_CTE} SELECT '{C.SOURCE_EVENT}' AS decision_source, driver_id, event_id, decision_type, "
    f"{DEMO_PRIORITY} AS priority, recommended_action, customer_message, active_rules, risk_score_event "
    "FROM ed WHERE decision_type IS NOT NULL",
)

PRICING_OUT = """driver_id, window_start, RND(exposure_km, 9) AS exposure_km, RND(speeding_ratio, 9) AS speeding_ratio,
  RND(hard_braking_count_per_100km, 9) AS hard_braking_count_per_100km,
  RND(harsh_acceleration_count_per_100km, 9) AS harsh_acceleration_count_per_100km,
  RND(night_event_ratio, 9) AS night_event_ratio, RND(bad_weather_event_ratio, 9) AS bad_weather_event_ratio, phone_usage_count"""

sql("prepare_features", f"WITH {FL}, {PF_CTES} SELECT {PRICING_OUT} FROM pf")
sql(
    "expected_claim_rate",
    f"WITH {FL}, {TS_CTES} SELECT driver_id, driver_profile, window_start, RND(expected_claim_rate, 9) AS expected_claim_rate FROM lab0",
)
sql("impute_claim_count", f"WITH {FL}, {TS_CTES} SELECT driver_id, window_start, claim_count FROM tset")

# --- 2.3 aggregations ----------------------------------------------------------------------------

sql(
    "decision_window_features",
    f"""WITH {FL}, {DW_CTES}
SELECT driver_id, event_count, km_driven, avg_speed, risk_event_count, risk_score_5m, speeding_count, hard_braking_count,
  harsh_acceleration_count, sharp_cornering_count, bad_weather_event_count, night_event_count, phone_usage_count,
  RND(risk_intensity, 9) AS risk_intensity, RND(risk_events_per_100km, 9) AS risk_events_per_100km, window_start, window_end
FROM dw""",
)
sql("window_decisions", f"WITH {FL}, {DW_CTES} SELECT * FROM wd")
sql(
    "driver_rollup",
    f"""WITH {FL}, {TS_CTES}, roll AS (SELECT {ROLLUP_SELECT} FROM tset WHERE driver_id IS NOT NULL GROUP BY driver_id)
SELECT driver_id, RND(exposure_km, 9) AS exposure_km, RND(speeding_ratio, 9) AS speeding_ratio,
  RND(hard_braking_count_per_100km, 9) AS hard_braking_count_per_100km,
  RND(harsh_acceleration_count_per_100km, 9) AS harsh_acceleration_count_per_100km,
  RND(night_event_ratio, 9) AS night_event_ratio, RND(bad_weather_event_ratio, 9) AS bad_weather_event_ratio, phone_usage_count
FROM roll""",
)
sql(
    "mean_frequency",
    f"""WITH {FL}, {TS_CTES}, roll AS (SELECT {ROLLUP_SELECT} FROM tset WHERE driver_id IS NOT NULL GROUP BY driver_id),
p0 AS (SELECT exp({COMMITTED_ETA}) * greatest(exposure_km, {dbl(0.001)}) / greatest(exposure_km, {dbl(0.001)}) AS f FROM roll)
SELECT RND(greatest(avg(f), {dbl(C.MIN_MEAN_FREQUENCY)}), 9) AS mean_frequency FROM p0""",
)
sql(
    "model_metrics",
    f"""WITH {FL}, {TS_CTES}
SELECT RND(avg(abs(claim_count - predicted_claim_count)), 9) AS mae,
  RND(sqrt(avg((claim_count - predicted_claim_count) * (claim_count - predicted_claim_count))), 9) AS rmse,
  RND(avg(CAST(claim_count AS DOUBLE)), 9) AS mean_claim_count,
  RND(avg(predicted_claim_count), 9) AS mean_predicted_claim_count,
  '{C.METRICS_NOTE}' AS poisson_note
FROM tpred""",
)
sql(
    "risk_proxy_by_window",
    f"WITH {FL}, {TS_CTES} SELECT window_start, RND(sum(speeding_ratio + night_event_ratio), 9) AS risk_proxy FROM tset GROUP BY window_start",
)
sql(
    "mean_speeding_by_driver",
    f"""WITH {FL}, {TS_CTES}
SELECT driver_id, RND(avg(speeding_ratio), 9) AS speeding_ratio FROM tset WHERE driver_id IS NOT NULL GROUP BY driver_id
ORDER BY speeding_ratio DESC, driver_id LIMIT 15""",
)
RISK_SCORE_DRIVER = (
    f"speeding_ratio + hard_braking_count_per_100km / {dbl(100.0)} + harsh_acceleration_count_per_100km / {dbl(100.0)} "
    "+ night_event_ratio + bad_weather_event_ratio"
)
sql(
    "driver_risk_score",
    f"""WITH {FL}, {TS_CTES}
SELECT driver_id, RND(avg({RISK_SCORE_DRIVER}), 9) AS risk_score_driver FROM tset WHERE driver_id IS NOT NULL GROUP BY driver_id
ORDER BY risk_score_driver DESC, driver_id LIMIT 15""",
)
sql(
    "predicted_frequency_by_driver",
    f"""WITH {FL}, {TS_CTES}
SELECT driver_id, RND(avg(predicted_frequency), 9) AS predicted_frequency FROM tpred WHERE driver_id IS NOT NULL GROUP BY driver_id
ORDER BY predicted_frequency DESC, driver_id LIMIT 15""",
)
sql(
    "profile_comparison",
    f"""WITH {FL}, {TS_CTES}
SELECT driver_profile, RND(avg(speeding_ratio), 9) AS speeding_ratio, RND(avg(night_event_ratio), 9) AS night_event_ratio,
  RND(avg(bad_weather_event_ratio), 9) AS bad_weather_event_ratio, RND(avg({RISK_SCORE_DRIVER}), 9) AS risk_score_driver,
  CAST(CASE driver_profile WHEN 'safe' THEN 1 WHEN 'average' THEN 2 ELSE 3 END AS INTEGER) AS profile_order
FROM tset WHERE driver_profile IN ('safe', 'average', 'aggressive') GROUP BY driver_profile ORDER BY profile_order""",
)

# --- 2.4-2.6 --------------------------------------------------------------------------------------

LATEST = """SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY driver_id ORDER BY scored_at DESC, technical_premium DESC) AS rn FROM {src}
) WHERE rn = 1"""

sql("latest_premium", f"WITH {FL}, {premium_ctes()} SELECT {HISTORY_OUT} FROM ({LATEST.format(src='h2')})")
sql(
    "join_previous_premium",
    f"""WITH {FL}, {premium_ctes()},
roll AS (SELECT driver_id FROM pf WHERE driver_id IS NOT NULL GROUP BY driver_id),
prev AS ({LATEST.format(src='h2')})
SELECT roll.driver_id, coalesce(prev.technical_premium, {dbl(1000.0)}) AS technical_premium_previous
FROM roll LEFT JOIN prev ON roll.driver_id = prev.driver_id""",
)
sql(
    "premium_trajectory_top5",
    f"""WITH {FL}, {premium_ctes()},
top AS (SELECT driver_id FROM ({LATEST.format(src='h3')}) ORDER BY technical_premium DESC, driver_id LIMIT 5)
SELECT driver_id, scored_at, technical_premium, technical_premium_previous FROM h3 WHERE driver_id IN (SELECT driver_id FROM top)""",
)
sql(
    "top_premiums",
    f"""WITH {FL}, {premium_ctes()}
SELECT driver_id, technical_premium, RND(target_technical_premium, 6) AS target_technical_premium FROM r3
ORDER BY technical_premium DESC, driver_id LIMIT 20""",
)
sql(
    "top_latest_premiums",
    f"""WITH {FL}, {premium_ctes()}
SELECT driver_id, scored_at, technical_premium FROM ({LATEST.format(src='h3')}) ORDER BY technical_premium DESC, driver_id LIMIT 15""",
)
sql("union_history", f"WITH {FL}, {premium_ctes()} SELECT {HISTORY_OUT} FROM h3")
sql(
    "union_decisions",
    f"""WITH {FL}, {EVENT_DECISION_CTE}, {DW_CTES}
SELECT '{C.SOURCE_EVENT}' AS decision_source, driver_id, event_id, CAST(-1 AS BIGINT) AS window_start, decision_type,
  {STREAM_PRIORITY} AS priority FROM ed WHERE decision_type IS NOT NULL
UNION ALL
SELECT decision_source, driver_id, '' AS event_id, window_start, decision_type, priority FROM wd""",
)

# --- 2.7 -------------------------------------------------------------------------------------------

sql("train_test_split", f"WITH {FL}, {TS_CTES} SELECT driver_id, window_start, is_test FROM tset")
sql(
    "glm_test_predictions",
    f"""WITH {FL}, {TS_CTES}
SELECT driver_id, window_start, RND(exposure_km, 9) AS exposure_km, claim_count,
  RND(predicted_claim_count, 9) AS predicted_claim_count, RND(predicted_frequency, 9) AS predicted_frequency FROM tpred""",
)
sql(
    "premium_score",
    f"""WITH {FL}, {premium_ctes()}
SELECT driver_id, RND(predicted_claim_count, 9) AS predicted_claim_count, RND(predicted_frequency, 9) AS predicted_frequency,
  RND(risk_multiplier, 9) AS risk_multiplier, RND(target_technical_premium, 6) AS target_technical_premium FROM r3""",
)
_TERMS = ("speeding_ratio", "hard_braking_count_per_100km", "harsh_acceleration_count_per_100km", "night_event_ratio", "bad_weather_event_ratio", "phone_usage_count")


def _moments(intercept: str) -> str:
    rows = " UNION ALL ".join(f"SELECT '{t}' AS term, RND(sum({x} * claim_count), 4) AS moment FROM tr" for t, x in [(intercept, "1.0"), *[(t, t) for t in _TERMS]])
    return f"WITH {FL}, {TS_CTES}, tr AS (SELECT * FROM tset WHERE NOT is_test) {rows}"


sql("glm_offset", _moments("const"))
for _name in ("glm_rate_weighted", "model_store"):
    sql(_name, _moments("intercept"))
_PLACES = "(VALUES " + ", ".join(f"(CAST({i} AS INTEGER), '{t}')" for i, t in enumerate(("intercept", *_TERMS))) + ") p(position, term)"
sql("glm_coefficients", f"SELECT p.position, m.term, m.moment, {dbl(0.0)} AS exp_gap FROM ({_moments('intercept')}) m JOIN {_PLACES} ON p.term = m.term")
sql(
    "glm_summary",
    f"""WITH {FL}, {TS_CTES}, tr AS (SELECT greatest(exposure_km, {dbl(0.001)}) AS e, claim_count AS y FROM tset WHERE NOT is_test),
m AS (SELECT sum(y) / sum(e) AS r FROM tr),
d AS (SELECT count(*) AS n_rows, RND(2 * sum((CASE WHEN y > 0 THEN y * ln(y / (e * r)) ELSE 0 END) - (y - e * r)), 4) AS null_deviance FROM tr, m)
SELECT position, CASE position WHEN 0 THEN 'const' ELSE term END AS term, {dbl(0.0)} AS std_err_gap, {dbl(0.0)} AS z_gap, {dbl(0.0)} AS p_gap, n_rows, null_deviance
FROM {_PLACES}, d""",
)
sql(
    "model_dispersion",
    f"""WITH {FL}, {TS_CTES}
SELECT count(*) AS n_rows, RND(avg(claim_count), 9) AS mean_claim_count, RND(var_samp(claim_count), 9) AS variance_claim_count,
  RND(sum((claim_count - predicted_claim_count) * (claim_count - predicted_claim_count) / predicted_claim_count) / (count(*) - {len(C.COMMITTED_COEFFICIENTS)}), 9) AS dispersion
FROM tpred""",
)
sql("glm_tweedie", f"SELECT power, CASE position WHEN 0 THEN 'const' ELSE term END AS term, {dbl(0.0)} AS gradient FROM {_PLACES}, (VALUES ({dbl(1.2)}), ({dbl(1.5)})) v(power)")
_TRAINING = ("exposure_km", "event_count", "claim_count", "expected_claim_rate", *_TERMS)
_WEIGHT = "(((d + 1) * 31 + minute * 17) % 101 + 1)"
sql(
    "sink_model_outputs",
    f"WITH {FL}, {TS_CTES}, tr AS (SELECT * FROM tset WHERE NOT is_test), te AS (SELECT * FROM tset WHERE is_test)"
    + " UNION ALL ".join(
        [f" SELECT 'training_dataset' AS output, '{c}' AS column_name, count({c}) AS n_values, RND(sum({_WEIGHT} * CAST({c} AS DOUBLE)), 4) AS total FROM tr" for c in _TRAINING]
        + [f" SELECT 'glm_test_predictions', '{c}', count({c}), RND(sum((d + 1) % 101 * CAST({c} AS DOUBLE)), 4) FROM te" for c in ("exposure_km", "claim_count")]
        + [f" SELECT 'glm_test_predictions', '{c}', count(*), {dbl(0.0)} FROM te" for c in ("predicted_claim_count", "predicted_frequency")]
        + [f" SELECT 'glm_coefficients', 'exp_coef', 7, {dbl(0.0)}", " SELECT 'glm_metrics', 'mean_claim_count', 1, RND(avg(claim_count), 4) FROM te"]
        + [f" SELECT 'glm_metrics', '{c}', 1, {dbl(0.0)}" for c in ("mae", "rmse", "mean_predicted_claim_count")]
        + [f" SELECT 'glm_summary', 'value', 2, {dbl(0.0)}"]
    ),
)
sql("premium_cap", f"WITH {FL}, {premium_ctes()} SELECT {HISTORY_OUT} FROM r3")


# --- 2.4 count windows ------------------------------------------------------------------------------

ROLL_CTE = """rl AS (
  SELECT driver_id, event_id, event_no,
    count(*) OVER w AS event_count, sum(distance_delta_km) OVER w AS km_window,
    CAST(sum(CAST(risk_event AS INTEGER)) OVER w AS BIGINT) AS risk_event_count,
    CAST(sum(risk_score_event) OVER w AS BIGINT) AS risk_score_window,
    CAST(sum(CAST(is_phone_usage AS INTEGER)) OVER w AS BIGINT) AS phone_usage_count,
    lead(event_no) OVER (PARTITION BY driver_id ORDER BY event_no) AS next_seq
  FROM fl
  WINDOW w AS (PARTITION BY driver_id ORDER BY event_no ROWS BETWEEN 11 PRECEDING AND CURRENT ROW))"""

sql(
    "rolling_last_n_features",
    f"""WITH {FL}, {ROLL_CTE}
SELECT driver_id, event_id, event_no, event_count, RND(km_window, 4) AS km_driven, risk_event_count, risk_score_window,
  phone_usage_count, next_seq FROM rl""",
)
#: Buffer states with their decision, and the fields of a tick decision behind its range.
DECIDED_CTE = f"""rd AS (
  SELECT *, risk_event_count / event_count AS ri,
    CASE WHEN risk_score_window >= {C.ESCALATE_SCORE} OR phone_usage_count >= {C.ESCALATE_PHONE} THEN '{C.ESCALATE_HIGH_RISK_REVIEW}'
         WHEN event_count >= {C.NUDGE_MIN_EVENTS} AND risk_event_count / event_count >= {dbl(C.NUDGE_INTENSITY)} THEN '{C.SEND_SAFETY_NUDGE}'
         WHEN event_count >= {C.POINTS_MIN_EVENTS} AND risk_event_count = 0 AND km_window >= {dbl(C.POINTS_MIN_KM)}
           THEN '{C.GRANT_SAFE_DRIVING_POINTS}' END AS decision_type
  FROM rl)"""
TICK_FIELDS = f"""'{C.SOURCE_ROLLING}' AS decision_source, driver_id, decision_type,
  CASE decision_type WHEN '{C.ESCALATE_HIGH_RISK_REVIEW}' THEN 'high' WHEN '{C.SEND_SAFETY_NUDGE}' THEN 'medium' ELSE 'low' END AS priority,
  CASE decision_type WHEN '{C.ESCALATE_HIGH_RISK_REVIEW}' THEN '{C.ACTION_ESCALATE}'
       WHEN '{C.SEND_SAFETY_NUDGE}' THEN '{C.ACTION_WINDOW_NUDGE}' ELSE '{C.ACTION_POINTS.replace("'", "''")}' END AS recommended_action,
  CASE WHEN decision_type = '{C.GRANT_SAFE_DRIVING_POINTS}' THEN '{C.MESSAGE_POINTS}' ELSE '{C.MESSAGE_ROLLING_RISK}' END AS customer_message,
  event_count, RND(km_window, 4) AS km_driven, risk_event_count, risk_score_window, RND(ri, 3) AS risk_intensity, phone_usage_count"""
sql(
    "rolling_tick_decisions",
    f"""WITH {FL}, {ROLL_CTE}, {DECIDED_CTE},
lastseq AS (SELECT max(event_no) AS ls FROM fl),
tk AS (
  SELECT * FROM (SELECT rd.*, ((event_no + 9) // 10) * 10 AS first_tick, (coalesce(next_seq - 1, ls) // 10) * 10 AS last_tick
    FROM rd, lastseq WHERE decision_type IS NOT NULL) WHERE first_tick <= last_tick)
SELECT first_tick, last_tick, (last_tick - first_tick) // 10 + 1 AS n_ticks, {TICK_FIELDS}
FROM tk""",
)


# --- streaming and sources / sinks (same results as the batch operators) ----------------------------

CLOSED = f"window_end * 1000 <= (SELECT max(event_ms) FROM ev) - {30_000}"

sql("source_events_stream", f"WITH {FL} SELECT event_id, driver_id, event_ms AS event_time_ts, risk_score_event FROM fl")
ORACLE["stream_alerts"] = ORACLE["alerts"]
sql("sink_features_parquet", features_sql(1, CLOSED))
ORACLE["stream_tumbling_append"] = ORACLE["sink_features_parquet"]
ORACLE["stream_sliding_update"] = ORACLE["features_sliding_5m"]
ORACLE["stream_event_decisions"] = ORACLE["event_decisions"]
ORACLE["stream_window_decisions"] = ORACLE["window_decisions"]
_OLD_LAYOUT = ", ".join(f"CASE WHEN layout = 0 THEN NULL ELSE {c} END AS {c}" for c in ("speeding_ratio", "max_speed", "phone_usage_count"))
sql(
    "source_feature_store",
    f"""WITH f AS ({features_sql(1)}), g AS (SELECT *, window_start // 60 % 3 AS layout FROM f)
SELECT * EXCLUDE (layout, speeding_ratio, max_speed, phone_usage_count), speeding_ratio, max_speed, phone_usage_count, CAST(NULL AS VARCHAR) AS fleet, 'csv' AS read_from FROM g
UNION ALL
SELECT * EXCLUDE (layout, speeding_ratio, max_speed, phone_usage_count), {_OLD_LAYOUT}, CASE WHEN layout = 2 THEN 'F' || right(driver_id, 1) END AS fleet, 'parquet' FROM g""",
)
_OLDER = ", ".join(
    c if c in ("driver_id", "scored_at", "technical_premium", "technical_premium_previous")
    else f"CAST(NULL AS {'BIGINT' if c == 'phone_usage_count' else 'DOUBLE'}) AS {c}"
    for c in HISTORY_COLS.replace("\n", " ").replace(" ", "").split(",")
)
sql(
    "source_premium_history",
    f"""WITH {FL}, {premium_ctes()},
hist AS (SELECT {_OLDER} FROM r1 UNION ALL SELECT {HISTORY_COLS} FROM r2
         UNION ALL SELECT {HISTORY_COLS.replace('scored_at', f"'{RUNS[2][2]}' AS scored_at")} FROM r1)
SELECT {HISTORY_OUT}, read_from FROM hist, (VALUES ('parquet'), ('csv')) v(read_from)""",
)
ORACLE["sink_premium_history"] = ORACLE["union_history"]
sql("sink_premium_updates", f"WITH {FL}, {premium_ctes()} SELECT driver_id AS key, {HISTORY_OUT} FROM r3")
sql(
    "sink_decisions_jsonl",
    f"""WITH {FL}, {EVENT_DECISION_CTE}, {ROLL_CTE},
rd AS (
  SELECT *, risk_event_count / event_count AS ri,
    CASE WHEN risk_score_window >= {C.ESCALATE_SCORE} OR phone_usage_count >= {C.ESCALATE_PHONE} THEN '{C.ESCALATE_HIGH_RISK_REVIEW}'
         WHEN event_count >= {C.NUDGE_MIN_EVENTS} AND risk_event_count / event_count >= {dbl(C.NUDGE_INTENSITY)} THEN '{C.SEND_SAFETY_NUDGE}'
         WHEN event_count >= {C.POINTS_MIN_EVENTS} AND risk_event_count = 0 AND km_window >= {dbl(C.POINTS_MIN_KM)}
           THEN '{C.GRANT_SAFE_DRIVING_POINTS}' END AS rdt
  FROM rl),
lastseq AS (SELECT max(event_no) AS ls FROM fl),
tk AS (
  SELECT * FROM (SELECT rd.*, ((event_no + 9) // 10) * 10 AS first_tick, (coalesce(next_seq - 1, ls) // 10) * 10 AS last_tick
    FROM rd, lastseq WHERE rdt IS NOT NULL) WHERE first_tick <= last_tick)
SELECT event_no AS at_event, CAST(NULL AS BIGINT) AS last_tick, CAST(NULL AS BIGINT) AS n_ticks, '{C.SOURCE_EVENT}' AS decision_source, driver_id, event_id, decision_type,
  {DEMO_PRIORITY} AS priority, recommended_action, customer_message, active_rules, risk_score_event,
  CAST(NULL AS BIGINT) AS event_count, CAST(NULL AS DOUBLE) AS km_driven, CAST(NULL AS BIGINT) AS risk_event_count,
  CAST(NULL AS BIGINT) AS risk_score_window, CAST(NULL AS DOUBLE) AS risk_intensity, CAST(NULL AS BIGINT) AS phone_usage_count
FROM ed WHERE decision_type IS NOT NULL
UNION ALL
SELECT first_tick AS at_event, last_tick, (last_tick - first_tick) // 10 + 1 AS n_ticks, '{C.SOURCE_ROLLING}' AS decision_source, driver_id, CAST(NULL AS VARCHAR) AS event_id, rdt AS decision_type,
  CASE rdt WHEN '{C.ESCALATE_HIGH_RISK_REVIEW}' THEN 'high' WHEN '{C.SEND_SAFETY_NUDGE}' THEN 'medium' ELSE 'low' END AS priority,
  CASE rdt WHEN '{C.ESCALATE_HIGH_RISK_REVIEW}' THEN '{C.ACTION_ESCALATE}'
       WHEN '{C.SEND_SAFETY_NUDGE}' THEN '{C.ACTION_WINDOW_NUDGE}' ELSE '{C.ACTION_POINTS.replace("'", "''")}' END AS recommended_action,
  CASE WHEN rdt = '{C.GRANT_SAFE_DRIVING_POINTS}' THEN '{C.MESSAGE_POINTS}' ELSE '{C.MESSAGE_ROLLING_RISK}' END AS customer_message,
  CAST(NULL AS VARCHAR) AS active_rules, CAST(NULL AS INTEGER) AS risk_score_event,
  event_count, RND(km_window, 4) AS km_driven, risk_event_count, risk_score_window, RND(ri, 3) AS risk_intensity, phone_usage_count
FROM tk""",
)
sql(
    "source_decisions",
    f"""WITH {FL}, {EVENT_DECISION_CTE}, {DW_CTES}
SELECT driver_id AS key, '{C.SOURCE_EVENT}' AS decision_source, driver_id, event_id, CAST(-1 AS BIGINT) AS window_start,
  decision_type, {STREAM_PRIORITY} AS priority FROM ed WHERE decision_type IS NOT NULL
UNION ALL
SELECT driver_id AS key, decision_source, driver_id, '' AS event_id, window_start, decision_type, priority FROM wd""",
)
sql(
    "sink_topic_stream",
    f"SELECT driver_id AS key, * FROM ({features_sql(1, CLOSED)})",
)

_SPLIT_MS = TARGET_EPOCH_MS + 108 * 60_000

sql(  # per driver, the next decision at least two minutes after the one sent before
    "stream_decision_cooldown",
    f"""WITH RECURSIVE {FL}, {EVENT_DECISION_CTE},
d AS (SELECT event_id, driver_id, event_ms, decision_type, {STREAM_PRIORITY} AS priority FROM ed WHERE decision_type IS NOT NULL),
sent(driver_id, pick) AS (
  SELECT driver_id, min(struct_pack(t := event_ms, e := event_id)) FROM d GROUP BY driver_id
  UNION ALL
  SELECT d.driver_id, min(struct_pack(t := d.event_ms, e := d.event_id)) FROM sent JOIN d ON d.driver_id = sent.driver_id AND d.event_ms >= sent.pick.t + 120000 GROUP BY d.driver_id)
SELECT d.event_id, d.driver_id, event_ms AS event_time_ts, decision_type, priority FROM d JOIN sent ON sent.driver_id = d.driver_id AND sent.pick.e = d.event_id""",
)
sql(
    "late_rows",
    f"""WITH {FL} SELECT event_id, driver_id, event_ms AS event_time_ts,
  CASE WHEN event_ms >= {_SPLIT_MS} OR event_ms >= (SELECT max(event_ms) FROM fl) - 30000 THEN 'on_time' ELSE 'late' END AS kind FROM fl""",
)
ORACLE["stream_sliding_table"] = ORACLE["features_sliding_5m"]
ORACLE["stream_decision_table"] = ORACLE["window_decisions"]
sql(
    "state_of_open_windows",
    f"""WITH {FL}, half AS (SELECT * FROM fl WHERE event_ms < {_SPLIT_MS}),
{windows_cte('fw', 1, 'half')},
agg AS (SELECT {FEATURE_AGGS} FROM fw WHERE event_ms IS NOT NULL GROUP BY driver_id, window_start, window_end)
SELECT agg.*, restart FROM agg, (VALUES ('before'), ('after')) v(restart) WHERE window_end * 1000 > (SELECT max(event_ms) FROM half) - 30000""",
)
sql("premium_snapshot", f"WITH {FL}, {premium_ctes()} SELECT {HISTORY_OUT} FROM ({LATEST.format(src='h3')})")
sql("premium_lookup", f"WITH {FL}, {premium_ctes()} SELECT {HISTORY_OUT} FROM ({LATEST.format(src='h3')}) WHERE driver_id = 'D0007'")
ORACLE["driver_rollup_incremental"] = ORACLE["driver_rollup"]
sql(
    "source_topic_offsets",
    f"WITH {FL} SELECT event_no - 1 AS \"offset\", event_id, driver_id, event_ms AS event_time_ts FROM fl WHERE event_ms >= {_SPLIT_MS}",
)
ORACLE["stream_last_n_features"] = ORACLE["rolling_last_n_features"]
sql(  # the runs end after the first half of the events and after all; a buffer open at an end is judged there if a tick has passed
    "stream_tick_decisions",
    f"""WITH {FL}, {ROLL_CTE}, {DECIDED_CTE},
ends AS (SELECT max(event_no) AS n FROM fl UNION SELECT max(event_no) FROM fl WHERE event_ms < {_SPLIT_MS}),
states AS (SELECT *, ((event_no + 9) // 10) * 10 AS first_tick FROM rd WHERE decision_type IS NOT NULL),
tk AS (
  SELECT * FROM (SELECT *, ((next_seq - 1) // 10) * 10 AS last_tick, (next_seq - 1) // 10 - first_tick // 10 + 1 AS n_ticks FROM states WHERE next_seq IS NOT NULL)
  WHERE first_tick <= last_tick
  UNION ALL
  SELECT *, first_tick AS last_tick, CAST(0 AS BIGINT) AS n_ticks FROM states
  WHERE EXISTS (SELECT 1 FROM ends WHERE event_no <= n AND first_tick <= n AND (next_seq IS NULL OR next_seq > n)))
SELECT first_tick, last_tick, n_ticks, {TICK_FIELDS}
FROM tk""",
)
sql(
    "late_data",
    features_sql(1, f"{CLOSED} AND window_start * 1000 >= {_SPLIT_MS}").replace(
        "FROM fw WHERE event_ms IS NOT NULL", f"FROM fw WHERE event_ms IS NOT NULL AND event_ms >= {_SPLIT_MS}"
    ),
)
ORACLE["checkpoint_restart"] = ORACLE["alerts"]
sql(
    "stream_fanout",
    f"""WITH {FL}, {EVENT_DECISION_CTE}
SELECT 'alert' AS output, event_id, driver_id, event_ms AS event_time_ts, {rules_text(False)} AS active_rules, CAST(NULL AS VARCHAR) AS decision_type
FROM fl WHERE risk_event
UNION ALL
SELECT 'decision', event_id, driver_id, event_ms, active_rules, decision_type FROM ed WHERE decision_type IS NOT NULL""",
)
sql(
    "multi_query",
    f"""WITH {FL},
{windows_cte('fw', 1)},
agg AS (SELECT driver_id, window_start, window_end, count(*) AS n FROM fw WHERE event_ms IS NOT NULL GROUP BY ALL),
closed AS (SELECT driver_id, count(*) AS window_count, CAST(sum(n) AS BIGINT) AS windowed_events FROM agg WHERE {CLOSED} GROUP BY driver_id),
al AS (SELECT driver_id, count(*) AS alert_count FROM fl WHERE risk_event GROUP BY driver_id)
SELECT coalesce(al.driver_id, closed.driver_id) AS driver_id, coalesce(alert_count, 0) AS alert_count,
  coalesce(window_count, 0) AS window_count, coalesce(windowed_events, 0) AS windowed_events
FROM al FULL OUTER JOIN closed ON al.driver_id = closed.driver_id""",
)
