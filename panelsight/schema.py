"""Column lists, panel schema and rule thresholds.

The values in the FIXED VALUES block must equal the behaviour being
reproduced (feature order, band names and cut-offs, decision thresholds);
everything else in the package is derived from them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the reproduced behaviour exactly)
# ---------------------------------------------------------------------------
EDUCATION_LEVELS = ["High School", "Bachelor's", "Master's", "PhD"]

NUMERIC_FEATURES = [
    "age", "experience_years", "salary",
    "training_hours", "attendance_rate", "overtime_hours",
    "projects_completed", "manager_rating", "peer_score",
    "goal_achievement_pct",
]
CATEGORICAL_FEATURES = ["department", "education", "role"]
FEATURE_COLS = NUMERIC_FEATURES + [f"{c}_enc" for c in CATEGORICAL_FEATURES]

# columns imputed with the training median
IMPUTE_COLS = ["training_hours", "overtime_hours", "peer_score", "goal_achievement_pct"]
# columns coerced to numbers at cleaning time
COERCE_COLS = NUMERIC_FEATURES + ["performance_score"]

TARGET_COL = "performance_band"
TIME_COL = "quarter_label"
KEY_COLS = ["employee_id", "review_year", "review_quarter"]
DEFAULT_CUTOFF = "2024-Q1"

BANDS = ["Low", "Medium", "High"]          # label 0, 1, 2
BAND_DISPLAY_ORDER = ["High", "Medium", "Low"]
HIGH_CUTOFF = 75.0
MEDIUM_CUTOFF = 50.0

# decision thresholds
THRESHOLDS = {
    "low_training_hours": 15,
    "critical_attendance": 0.80,
    "high_overtime": 30,
    "low_goal_achievement": 50,
    "medium_goal_achievement": 70,
    "high_goal_achievement": 85,
    "low_manager_rating": 2.5,
    "high_manager_rating": 4.0,
    "low_peer_score": 2.5,
    "few_projects": 2,
    "senior_experience": 10,
    "min_experience_promo": 5,
    "promo_min_projects": 4,
    "low_salary": 40000,
}
# defaults used by the rules when a column is absent from the input
RULE_DEFAULTS = {
    "training_hours": 20.0,
    "attendance_rate": 0.90,
    "overtime_hours": 10.0,
    "goal_achievement_pct": 60.0,
    "manager_rating": 3.0,
    "peer_score": 3.0,
    "projects_completed": 3,
    "experience_years": 5,
    "salary": 50000,
}
# experience tiers: (label, lower exclusive, upper inclusive)
EXPERIENCE_TIERS = [
    ("Junior (0–3 yrs)", -1, 3),
    ("Mid (4–8 yrs)", 3, 8),
    ("Senior (9+ yrs)", 8, 100),
]
ADVERSE_IMPACT_MIN = 0.80
PARITY_MAX_ABS = 0.10
# ---------------------------------------------------------------------------

PANEL_SCHEMA = T.StructType([
    T.StructField("employee_id", T.StringType(), False),
    T.StructField("department", T.StringType(), True),
    T.StructField("education", T.StringType(), True),
    T.StructField("role", T.StringType(), True),
    T.StructField("age", T.IntegerType(), True),
    T.StructField("experience_years", T.IntegerType(), True),
    T.StructField("salary", T.IntegerType(), True),
    T.StructField("join_date", T.DateType(), True),
    T.StructField("review_year", T.IntegerType(), True),
    T.StructField("review_quarter", T.IntegerType(), True),
    T.StructField("quarter_label", T.StringType(), True),
    T.StructField("review_date", T.DateType(), True),
    T.StructField("training_hours", T.DoubleType(), True),
    T.StructField("attendance_rate", T.DoubleType(), True),
    T.StructField("overtime_hours", T.DoubleType(), True),
    T.StructField("projects_completed", T.IntegerType(), True),
    T.StructField("manager_rating", T.DoubleType(), True),
    T.StructField("peer_score", T.DoubleType(), True),
    T.StructField("goal_achievement_pct", T.DoubleType(), True),
    T.StructField("performance_score", T.DoubleType(), True),
    T.StructField("performance_band", T.StringType(), True),
])
PANEL_COLS = [f.name for f in PANEL_SCHEMA.fields]

# the 14 columns a scoring file must carry
BATCH_REQUIRED = ["employee_id"] + NUMERIC_FEATURES + CATEGORICAL_FEATURES
