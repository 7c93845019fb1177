"""Fixed values that every part of the library shares."""

# Weight of one death in the risk score.
DEATH_WEIGHT = 10

# Left-closed bucket edges of the risk score.
RISK_SPLITS = [float("-inf"), 0.0, 1000.0, 10000.0, 100000.0, float("inf")]

# Label of every bucket.
RISK_LABELS = {
    0: "Very Low",
    1: "Low",
    2: "Medium",
    3: "High",
    4: "Very High",
}

# Lowest category that counts as high risk.
HIGH_RISK_CODE = 3

# Date formats of the raw files and of the messages.
RAW_DATE_FORMAT = "M/d/yyyy"
ISO_DATE_FORMAT = "yyyy-MM-dd"
CLOCK_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Partition columns of the curated reports.
PARTITION_COLUMNS = ["annee", "mois", "jour"]

# Model inputs, label, forest size and split.
FEATURE_COLUMNS = ["mois", "jour", "risk_score"]
LABEL_COLUMN = "risk_category"
FOREST_TREES = 20
FOREST_DEPTH = 10
TRAIN_FRACTION = 0.8
SPLIT_SEED = 42

# Table and topic that hold predictions and reports.
PREDICTIONS_TABLE = "risk_predictions"
REPORTS_TOPIC = "risk_data"

# The value that switches a dashboard filter off.
NO_FILTER = "All"

# Postal codes of the fifty states.
US_STATE_CODES = {
    "Alabama": "AL",
    "Alaska": "AK",
    "Arizona": "AZ",
    "Arkansas": "AR",
    "California": "CA",
    "Colorado": "CO",
    "Connecticut": "CT",
    "Delaware": "DE",
    "Florida": "FL",
    "Georgia": "GA",
    "Hawaii": "HI",
    "Idaho": "ID",
    "Illinois": "IL",
    "Indiana": "IN",
    "Iowa": "IA",
    "Kansas": "KS",
    "Kentucky": "KY",
    "Louisiana": "LA",
    "Maine": "ME",
    "Maryland": "MD",
    "Massachusetts": "MA",
    "Michigan": "MI",
    "Minnesota": "MN",
    "Mississippi": "MS",
    "Missouri": "MO",
    "Montana": "MT",
    "Nebraska": "NE",
    "Nevada": "NV",
    "New Hampshire": "NH",
    "New Jersey": "NJ",
    "New Mexico": "NM",
    "New York": "NY",
    "North Carolina": "NC",
    "North Dakota": "ND",
    "Ohio": "OH",
    "Oklahoma": "OK",
    "Oregon": "OR",
    "Pennsylvania": "PA",
    "Rhode Island": "RI",
    "South Carolina": "SC",
    "South Dakota": "SD",
    "Tennessee": "TN",
    "Texas": "TX",
    "Utah": "UT",
    "Vermont": "VT",
    "Virginia": "VA",
    "Washington": "WA",
    "West Virginia": "WV",
    "Wisconsin": "WI",
    "Wyoming": "WY",
}
