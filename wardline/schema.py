"""Column layouts, vocabularies and thresholds shared by every job."""

from __future__ import annotations

from pyspark.sql import types as T

# Header of an incident file and the name each column gets in the raw table.
FILE_COLUMNS: dict[str, str] = {
    "Crime ID": "crime_id",
    "Month": "month",
    "Reported by": "reported_by",
    "Falls within": "falls_within",
    "Longitude": "longitude",
    "Latitude": "latitude",
    "Location": "location",
    "LSOA code": "lsoa_code",
    "LSOA name": "lsoa_name",
    "Crime type": "crime_type",
    "Last outcome category": "last_outcome",
    "Context": "context",
}

COORDINATES = ("longitude", "latitude")

# Columns without which a report cannot be built.
REPORT_COLUMNS = ("Month", "Crime type", "Falls within")

# Closed vocabularies of the staging checks.
FORCES = (
    "west-yorkshire",
    "greater-manchester",
    "metropolitan",
    "west-midlands",
)

CATEGORIES = (
    "Anti-social behaviour",
    "Bicycle theft",
    "Burglary",
    "Criminal damage and arson",
    "Drugs",
    "Other crime",
    "Other theft",
    "Possession of weapons",
    "Public order",
    "Robbery",
    "Shoplifting",
    "Theft from the person",
    "Vehicle crime",
    "Violence and sexual offences",
)

# Hotspot tiers.
TIERS = ("High", "Medium", "Low")

# The outcomes with a meaning of their own.
OUTCOME_OPEN = "Under investigation"
OUTCOME_NO_SUSPECT = "Investigation complete; no suspect identified"
OUTCOME_MISSING = "No outcome recorded"

# Category behind each count column of the hotspot mart.
HOTSPOT_COUNTS: dict[str, str] = {
    "violence_count": "Violence and sexual offences",
    "asb_count": "Anti-social behaviour",
    "burglary_count": "Burglary",
    "vehicle_crime_count": "Vehicle crime",
    "shoplifting_count": "Shoplifting",
    "drugs_count": "Drugs",
}

# Hotspot tiers by incident count, gates by row count and share.
HIGH_FROM = 20
MEDIUM_FROM = 10
MIN_FILE_ROWS = 100
MIN_MONTH_MATCH = 0.9

MONTH_PATTERN = r"^\d{4}-\d{2}$"
CALENDAR_MONTH = r"^\d{4}-(0[1-9]|1[0-2])$"

# Every file column is read as text; only coordinates are converted, and leniently.
FILE_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in FILE_COLUMNS])

# Columns of the raw table. The last three columns are its partitions: load_id names the batch that wrote a row,
# so that repeating a batch replaces its own rows and nothing else.
RAW_COLUMNS: dict[str, str] = {
    "crime_id": "string",
    "reported_by": "string",
    "falls_within": "string",
    "longitude": "double",
    "latitude": "double",
    "location": "string",
    "lsoa_code": "string",
    "lsoa_name": "string",
    "crime_type": "string",
    "last_outcome": "string",
    "context": "string",
    "_loaded_at": "timestamp",
    "load_id": "string",
    "force": "string",
    "month": "string",
}
RAW_PARTITIONS = ("load_id", "force", "month")

ROW_KEY = ("crime_id", "month", "force")

MOM_TYPE = "struct<previous_total:bigint,absolute:bigint,pct:double,direction:string>"
