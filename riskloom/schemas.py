"""Schemas of the tables and messages the library reads and writes."""

RAW_REPORT = "date STRING, county STRING, state STRING, cases INT, deaths INT"

MESSAGE = (
    "state STRING, county STRING, date STRING, cases INT, deaths INT, mois INT, jour INT"
)

MESSAGE_COLUMNS = ["state", "county", "date", "cases", "deaths", "mois", "jour"]

REPORT_COLUMNS = ["state", "county", "date", "cases", "deaths"]

PREDICTION_COLUMNS = [
    "state",
    "county",
    "date",
    "risk_category",
    "predicted_risk_category",
]
