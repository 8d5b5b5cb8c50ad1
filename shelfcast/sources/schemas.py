"""Table schemas and configured names."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column names, type names, value lists and thresholds that
# results must agree on.
# ---------------------------------------------------------------------------

SALES_TYPES = {
    "id": "string",
    "date": "date",
    "store_nbr": "string",
    "family": "string",
    "sales": "float",
    "onpromotion": "int",
    "year": "int",
    "month": "int",
    "snapshot_date": "date",
}

TRANSACTION_TYPES = {
    "date": "date",
    "store_nbr": "string",
    "transactions": "int",
    "month": "int",
    "year": "int",
    "snapshot_date": "date",
}

OIL_TYPES = {
    "date": "date",
    "dcoilwtico": "float",
    "year": "int",
    "month": "int",
    "snapshot_date": "date",
}

HOLIDAY_TYPES = {
    "date": "date",
    "type": "string",
    "locale": "string",
    "locale_name": "string",
    "description": "string",
    "transferred": "bool",
}

SALES_KEYS = ["id"]
TRANSACTION_KEYS = ["date"]
OIL_KEYS = ["date"]

TRUE_WORDS = ["true", "1", "t", "yes", "y"]

HOLIDAY_TYPE_VALUES = ["Event", "Holiday", "Transfer", "Bridge", "Additional", "Work Day"]
HOLIDAY_LOCALE_VALUES = ["National", "Local", "Regional"]

HOLIDAY_COLUMNS = [
    "num_holidays_total",
    "num_transferred",
    "num_holidays_type_Event",
    "num_holidays_type_Holiday",
    "num_holidays_type_Transfer",
    "num_holidays_type_Bridge",
    "num_holidays_type_Additional",
    "num_holidays_type_Work Day",
    "num_holidays_locale_National",
    "num_holidays_locale_Local",
    "num_holidays_locale_Regional",
]
NEXT_MONTH_COLUMNS = [f"{c}_NM" for c in HOLIDAY_COLUMNS]

TRAILING_COLUMNS = [
    "sales_LM",
    "AVG_sales_L3M",
    "SUM_sales_L3M",
    "onpromotion_LM",
    "AVG_onpromotion_L3M",
    "SUM_onpromotion_L3M",
    "transactions_LM",
    "AVG_transactions_L3M",
    "SUM_transactions_L3M",
    "AVG_dcoilwtico_LM",
    "AVG_dcoilwtico_L3M",
    "SUM_dcoilwtico_L3M",
]

NUMERIC_FEATURES = HOLIDAY_COLUMNS + NEXT_MONTH_COLUMNS + TRAILING_COLUMNS
#: Inputs of the ridge candidates: trailing figures that are not sums of each other, and what is known of next month.
RIDGE_FEATURES = [
    "sales_LM",
    "AVG_sales_L3M",
    "onpromotion_LM",
    "AVG_onpromotion_L3M",
    "transactions_LM",
    "AVG_transactions_L3M",
    "AVG_dcoilwtico_LM",
    "num_holidays_total_NM",
]
CATEGORICAL_FEATURES = ["store_nbr", "family"]
JOIN_KEYS = ["store_nbr", "family"]
LABEL = "label_next_month_sales"
PREDICTION = "predicted_sales"
UNKNOWN_CATEGORY = "Unknown"

TRAIN_MONTHS, VAL_MONTHS, TEST_MONTHS, OOT_MONTHS = 18, 2, 2, 2

DRIFT_VARIABLES = [
    "AVG_sales_L3M",
    "num_holidays_total",
    "transactions_LM",
    "sales_LM",
    "num_holidays_type_Additional",
    "AVG_dcoilwtico_LM",
    "num_holidays_total_NM",
    "onpromotion_LM",
    "num_holidays_locale_Regional_NM",
    "num_holidays_type_Holiday",
]
DRIFT_BINS = 10
SMOOTHING = 1e-6
EDGE_PADDING = 1e-9
STABLE_BELOW, MODERATE_BELOW = 0.10, 0.25

R2_DROP_ALLOWED = 0.10
RMSE_RATIO_ALLOWED = 1.25
MAE_RATIO_ALLOWED = 1.25

DAY_SPLIT_TRAIN_TEST_DAYS, DAY_SPLIT_OOT_DAYS = 5, 2
RANDOM_SPLIT_SHARE, RANDOM_SPLIT_SEED = 0.8, 88
HOLDOUT_WEEKS = 20
RIDGE_PENALTY = 0.1
BOOSTING_SEED, BOOSTING_PATIENCE = 42, 50
WEEKLY_BOOSTING_TREES, WEEKLY_BOOSTING_RATE, WEEKLY_BOOSTING_DEPTH = 800, 0.05, 6
WEEKLY_BOOSTING_SUBSAMPLE = 0.8
TOP_FEATURES = 20

# ---------------------------------------------------------------------------
# Derived schemas
# ---------------------------------------------------------------------------

_SPARK_TYPES = {
    "string": T.StringType(),
    "date": T.DateType(),
    "int": T.IntegerType(),
    "float": T.FloatType(),
    "bool": T.BooleanType(),
}


def spark_type(name: str) -> T.DataType:
    """Spark type of a configured type name; an unknown name reads as string."""
    return _SPARK_TYPES.get(name, T.StringType())


def raw_schema(types: dict[str, str]) -> T.StructType:
    """All-string schema of a raw text table, so that bad values survive until the cast."""
    return T.StructType([T.StructField(c, T.StringType()) for c in types])


def typed_schema(types: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(c, spark_type(t)) for c, t in types.items()])


FEATURE_STORE_SCHEMA = T.StructType(
    [
        T.StructField("snapshot_date", T.DateType()),
        T.StructField("store_nbr", T.StringType()),
        T.StructField("family", T.StringType()),
    ]
    + [T.StructField(c, T.LongType()) for c in HOLIDAY_COLUMNS + NEXT_MONTH_COLUMNS]
    + [
        T.StructField(c, T.LongType() if "transactions" in c and not c.startswith("AVG") else T.DoubleType())
        for c in TRAILING_COLUMNS
    ]
)

METRICS = T.StructType([T.StructField(m, T.DoubleType()) for m in ("rmse", "mae", "r2")])
SPLIT_STATS = T.StructType(
    [
        T.StructField("start", T.DateType()),
        T.StructField("end", T.DateType()),
        T.StructField("rows", T.LongType()),
    ]
)
GAIN = T.StructType([T.StructField("feature", T.StringType()), T.StructField("gain", T.DoubleType())])

MODEL_METADATA_SCHEMA = T.StructType(
    [
        T.StructField("model_version", T.StringType()),
        T.StructField("timestamp_utc", T.StringType()),
        T.StructField("training_window_end", T.DateType()),
        T.StructField("label_alignment", T.StringType()),
        T.StructField("join_keys", T.ArrayType(T.StringType())),
        T.StructField("target_col", T.StringType()),
        T.StructField("categorical_features", T.ArrayType(T.StringType())),
        T.StructField("numerical_features", T.ArrayType(T.StringType())),
        T.StructField("best_params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.StructType([T.StructField(s, METRICS) for s in ("val", "test", "oot")])),
        T.StructField("feature_importance_top20_gain", T.ArrayType(GAIN)),
        T.StructField("feature_importance_full_gain", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField(
            "split_stats", T.StructType([T.StructField(s, SPLIT_STATS) for s in ("train", "val", "test", "oot")])
        ),
    ]
)

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("snapshot_date", T.DateType()),
        T.StructField("prediction_snapshot", T.DateType()),
        T.StructField("reference_snapshot_for_drift", T.DateType()),
        T.StructField("metrics", METRICS),
        T.StructField("baseline_metrics", T.StructType([T.StructField("oot", METRICS)])),
        T.StructField(
            "breaches",
            T.StructType([T.StructField(f"{m}_breach", T.BooleanType()) for m in ("r2", "rmse", "mae")]),
        ),
        T.StructField("breach_flag", T.BooleanType()),
        T.StructField(
            "thresholds",
            T.StructType(
                [
                    T.StructField("r2_drop_allowed", T.DoubleType()),
                    T.StructField("rmse_increase_ratio", T.DoubleType()),
                    T.StructField("mae_increase_ratio", T.DoubleType()),
                ]
            ),
        ),
        T.StructField(
            "psi_csi_summary",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("variable", T.StringType()),
                        T.StructField("psi", T.DoubleType()),
                        T.StructField("psi_severity", T.StringType()),
                        T.StructField("csi", T.DoubleType()),
                        T.StructField("csi_severity", T.StringType()),
                    ]
                )
            ),
        ),
        T.StructField(
            "prediction_csi",
            T.StructType(
                [
                    T.StructField("value", T.DoubleType()),
                    T.StructField("severity", T.StringType()),
                    T.StructField("reference_snapshot", T.DateType()),
                    T.StructField("current_snapshot", T.DateType()),
                ]
            ),
        ),
        T.StructField("missing_in_reference", T.ArrayType(T.StringType())),
        T.StructField("missing_in_current", T.ArrayType(T.StringType())),
    ]
)
