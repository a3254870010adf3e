"""Names, bounds and labels of the house tables."""

from pyspark.sql import types as T

# The feature list, in model order.
FEATURES = [
    "bedrooms", "bathrooms", "sqft_living", "sqft_lot",
    "floors", "waterfront", "view", "condition",
    "sqft_above", "sqft_basement", "yr_built",
]
TARGET = "price"

# What an absent feature column is filled with; others get their fitted median.
ABSENT_DEFAULTS = {"sqft_basement": 0, "waterfront": 0, "view": 0, "condition": 3}

# Nulls of these columns are filled before medians are taken.
NULL_DEFAULTS = {"sqft_basement": 0}

# Bounds of a scoring request (feature, whole number, lowest, highest).
REQUEST_BOUNDS = [
    ("bedrooms", True, 0, 20),
    ("bathrooms", False, 0, 10),
    ("sqft_living", True, 100, 20000),
    ("sqft_lot", True, 500, 100000),
    ("floors", False, 1, 5),
    ("waterfront", True, 0, 1),
    ("view", True, 0, 4),
    ("condition", True, 1, 5),
    ("sqft_above", True, 0, 20000),
    ("sqft_basement", True, 0, 5000),
    ("yr_built", True, 1900, 2025),
]

# The year ages are counted from, and right-closed category edges with their labels.
REFERENCE_YEAR = 2024
AGE_EDGES = [0, 10, 30, 50, 100, 200]
AGE_LABELS = ["Neuve", "Récente", "Moyenne", "Ancienne", "Très_ancienne"]
AREA_EDGES = [0, 1000, 2000, 3000, 5000, float("inf")]
AREA_LABELS = ["Petit", "Moyen", "Grand", "Très_grand", "Exceptionnel"]
MISSING_LABEL = "nan"

# Columns that leave the table once features are made, and label-encoded columns.
DROPPED_COLUMNS = ["date", "id", "city", "zipcode"]
ENCODED_COLUMNS = ["city", "zone_zipcode"]
ONE_HOT_PREFIX = "ville_"

# Confidence tiers, highest first (predictions strictly above the limit).
CONFIDENCE_TIERS = [(500000, "Élevée"), (200000, "Bonne")]
CONFIDENCE_LOWEST = "Faible"
CONFIDENCE_ERROR = "Erreur"

# Name fragments that put a variable into a family of the catalog.
VARIABLE_FAMILIES = {
    "Temporelles": ["age", "annee", "renovation"],
    "Superficie": ["superficie", "sqft", "ratio", "pied"],
    "Qualité": ["score", "qualite", "confort", "vue", "sous_sol"],
    "Localisation": ["ville", "zone", "zipcode"],
    "Interaction": ["_x_", "luxe"],
}

REQUEST_SCHEMA = T.StructType(
    [T.StructField(name, T.LongType() if whole else T.DoubleType()) for name, whole, _, _ in REQUEST_BOUNDS]
)

AUDIT_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("request_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("client_ip", T.StringType()),
    T.StructField("input", T.StructType([
        T.StructField("features", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("feature_count", T.IntegerType()),
    ])),
    T.StructField("output", T.StructType([
        T.StructField("prediction", T.DoubleType()),
        T.StructField("confidence", T.StringType()),
        T.StructField("model_used", T.StringType()),
    ])),
    T.StructField("performance", T.StructType([T.StructField("duration_ms", T.DoubleType())])),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("metadata", T.StructType([
        T.StructField("api_version", T.StringType()),
        T.StructField("environment", T.StringType()),
    ])),
    T.StructField("model_loaded", T.BooleanType()),
    T.StructField("duration_ms", T.DoubleType()),
    T.StructField("error_type", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("details", T.MapType(T.StringType(), T.StringType())),
    T.StructField("environment", T.StringType()),
])
