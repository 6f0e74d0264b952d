"""Names and numbers that results must carry exactly."""

# Reject reasons, in rule order.
REJECT_UNPARSEABLE = "created_date_unparseable"
REJECT_BACKWARDS = "closed_before_created"
REJECT_TOO_LONG = "resolution_exceeds_180d"
MAX_RESOLUTION_HOURS = 180 * 24

# Where a duration target came from.
SOURCE_GROUP = "group_p75"
SOURCE_PARENT = "agency_p75_fallback"
SOURCE_UNSEEN = "agency_p75_unseen_complaint_fallback"
SOURCE_CONTEXT_MEDIAN = "agency_hour_weekday_median"
SOURCE_GLOBAL_MEDIAN = "global_train_median"

# Label states.
STATE_CLOSED = "closed_outcome"
STATE_KNOWN_BREACH = "open_known_breach"
STATE_CENSORED = "open_censored"

# Model feature names, in model order.
NUMERIC_FEATURES = (
    "agency_open_backlog",
    "complaint_open_backlog",
    "agency_arrivals_24h",
    "agency_closures_24h",
    "hist_median_res_hrs_28d",
    "hist_breach_rate_28d",
    "sla_target_hours",
    "hour_of_day_created",
    "day_of_week",
)
CATEGORICAL_FEATURES = ("borough", "channel", "complaint_type_grouped")
FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES
DEFAULTABLE_FEATURES = NUMERIC_FEATURES[:6]

# Reader-facing feature labels.
FEATURE_LABELS = {
    "agency_open_backlog": "Agency backlog at creation",
    "complaint_open_backlog": "Complaint-type backlog at creation",
    "agency_arrivals_24h": "Agency arrivals in prior 24h",
    "agency_closures_24h": "Agency closures in prior 24h",
    "hist_median_res_hrs_28d": "Prior-28d median resolution time",
    "hist_breach_rate_28d": "Prior-28d breach rate",
    "sla_target_hours": "Portfolio SLA threshold",
    "hour_of_day_created": "Creation hour",
    "day_of_week": "Creation weekday",
    "borough": "Borough",
    "channel": "Intake channel",
    "complaint_type_grouped": "Complaint type",
}

# Modelling thresholds.
TOP_FRACTION = 0.10
CALIBRATION_TRIGGER = 0.03
SEARCH_TRIALS = 15
SEARCH_SEED = 42
MAX_ROUNDS = 600
EARLY_STOP_ROUNDS = 30
UNKNOWN = "UNKNOWN"
OTHER_PREFIX = "OTHER_"
