"""Thresholds, durations, texts and job parameters.

The numbers and texts below are fixed values: they must equal the behaviour
being reproduced (rule thresholds, decision texts, model constants), so they
are stated once here and imported everywhere else.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values: event risk rules -----------------------------------------
SPEEDING_TOLERANCE_KMH = 10.0          # speeding: speed > limit + 10
HARD_BRAKING_MS2 = -3.0                # braking < -3.0
EXTREME_BRAKING_MS2 = -5.0             # braking < -5.0
INCIDENT_BRAKING_MS2 = -4.2            # braking < -4.2 ...
INCIDENT_SPEED_KMH = 60.0              # ... and speed > 60 and sharp cornering
HARSH_ACCELERATION_MS2 = 2.5           # acceleration > 2.5
SHARP_CORNERING_G = 0.35               # cornering > 0.35
BAD_WEATHER = ("rain", "fog", "snow")
EXPOSURE_FLOOR_KM = 0.001

# Rule names, in the order they are listed in an alert / decision.
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
# Flags summed into risk_score_event (extreme braking is not one of them).
SCORE_FLAGS = tuple(name for name, _ in RULES_WITHOUT_EXTREME)

# --- fixed values: event decisions ------------------------------------------
EVENT_NUDGE_SCORE = 4
EVENT_HIGH_SCORE = 5
CHECK_DRIVER_STATUS = "CHECK_DRIVER_STATUS"
SEND_SAFETY_NUDGE = "SEND_SAFETY_NUDGE"
ESCALATE_HIGH_RISK_REVIEW = "ESCALATE_HIGH_RISK_REVIEW"
GRANT_SAFE_DRIVING_POINTS = "GRANT_SAFE_DRIVING_POINTS"
ACTION_CHECK_STATUS = "Send push/SMS asking if the driver is safe and prepare assistance triage."
ACTION_EVENT_NUDGE = "Send an in-app safety nudge during the trip."
MESSAGE_CHECK_STATUS = "Wykryto gwaltowne zdarzenie. Czy wszystko w porzadku?"
MESSAGE_EVENT_NUDGE = "W ostatnich minutach jazda wyglada ryzykownie. Zwolnij i zachowaj wiekszy odstep."

# --- fixed values: window decisions -----------------------------------------
ESCALATE_SCORE = 12
ESCALATE_PHONE = 3
NUDGE_MIN_EVENTS = 5
NUDGE_INTENSITY = 0.45
POINTS_MIN_EVENTS = 10
POINTS_MIN_KM = 0.25
ACTION_ESCALATE = "Flag this active trip for operational review and possible outbound contact."
ACTION_WINDOW_NUDGE = "Send a real-time safety nudge before the risky pattern becomes a claim."
ACTION_POINTS = "Add safe-driving points to the customer's reward wallet."
MESSAGE_POINTS = "Dobra, spokojna jazda. Dodajemy punkty safe driving do Twojego konta."
MESSAGE_WINDOW_RISK = (
    "Widzimy podwyzszone ryzyko tej podrozy. Jedz ostrozniej, zeby utrzymac bonus za bezpieczna jazde."
)
# The count-window (rolling) policy uses a shorter risk message.
MESSAGE_ROLLING_RISK = "Widzimy podwyzszone ryzyko tej podrozy. Jedz ostrozniej, zeby utrzymac bonus."
WINDOW_REASON_PREFIX = "5-minute window: events="

# --- fixed values: decision sources -----------------------------------------
SOURCE_EVENT = "event"
SOURCE_SLIDING = "sliding_window_5m"
SOURCE_ROLLING = "rolling_window_demo"

# --- fixed values: pricing --------------------------------------------------
FEATURE_COLUMNS = (
    "speeding_ratio",
    "hard_braking_count_per_100km",
    "harsh_acceleration_count_per_100km",
    "night_event_ratio",
    "bad_weather_event_ratio",
    "phone_usage_count",
)
# Claim-rate rule used to label windows that carry no claim count.
CLAIM_RULE_INTERCEPT = -5.15
CLAIM_RULE_BETA = {
    "speeding_ratio": 1.30,
    "hard_braking_count_per_100km": 0.012,
    "harsh_acceleration_count_per_100km": 0.010,
    "night_event_ratio": 0.55,
    "bad_weather_event_ratio": 0.50,
    "phone_usage_count": 0.12,
}
PROFILE_EFFECT = {"safe": -0.45, "average": 0.0, "aggressive": 0.45, "night_driver": 0.25, "urban_driver": 0.10}
CLAIM_RATE_MIN = 0.0001
CLAIM_RATE_MAX = 2.5
POISSON_MAX_COUNT = 30          # inverse CDF search range; P(X > 30 | lambda <= 2.5) < 1e-20
MIN_MEAN_FREQUENCY = 1e-9
RATE_MODEL_ALPHA = 0.001
RATE_MODEL_MAX_ITER = 1000
OFFSET_MODEL_MAX_ITER = 100
METRICS_NOTE = "If residual variance materially exceeds the mean, consider Negative Binomial or Tweedie."
PROFILE_REPORT_ORDER = ("safe", "average", "aggressive")

# Coefficients of the committed rate model (term, coefficient), intercept first.
COMMITTED_COEFFICIENTS = (
    ("intercept", -3.9642357053226336),
    ("speeding_ratio", 1.0605755894906441),
    ("hard_braking_count_per_100km", 0.008673115566415842),
    ("harsh_acceleration_count_per_100km", 0.0056476225341995845),
    ("night_event_ratio", 0.9652447617386383),
    ("bad_weather_event_ratio", -0.25270991966130324),
    ("phone_usage_count", -0.15931899635964047),
)

# Topics.
RAW_TOPIC = "telematics_raw"
ALERT_TOPIC = "telematics_alerts"
FEATURE_TOPIC = "driver_features"
PREMIUM_TOPIC = "premium_updates"
DECISION_TOPIC = "driver_interventions"

WATERMARK = "30 seconds"
TUMBLING = "1 minute"
SLIDING_SIZE = "5 minutes"
SLIDING_STEP = "1 minute"


@dataclass(frozen=True)
class JobConfig:
    """Parameters of the streaming and batch jobs (one place for all of them)."""

    bootstrap_servers: str = "broker:9092"
    raw_topic: str = RAW_TOPIC
    alert_topic: str = ALERT_TOPIC
    feature_topic: str = FEATURE_TOPIC
    decision_topic: str = DECISION_TOPIC
    premium_topic: str = PREMIUM_TOPIC
    output_dir: str = "data/historical_features"
    checkpoint_dir: str = "data/checkpoints"
    write_feature_topic: bool = False
    partition_features_by_date: bool = True
    show_console: bool = False
    starting_offsets: str = "latest"
    # Source format: "kafka" in production; "json"/"parquet"/"text" directories stand in for a broker in tests.
    source_format: str = "kafka"
    source_path: str | None = None
    source_options: dict = field(default_factory=dict)
    max_per_trigger: int | None = None  # messages (broker) or files (folder) per micro-batch; None: no limit
    watermark: str = WATERMARK
    base_premium: float = 1000.0
    premium_change_cap: float = 0.10
    window_events: int = 12
    tick_every: int = 10
