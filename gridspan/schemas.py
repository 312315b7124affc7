"""Table layouts.

Everything below is a fixed value: the column names and their order are those of
the published report files and of the stored tables, so results depend on them.
"""

from __future__ import annotations

ZONE = "America/Toronto"

# Positional column names of the headerless CSV reports.
DEMAND_COLUMNS = ["Date", "Hour", "Market_Demand", "Ontario_Demand"]
ARCHIVE_DEMAND_COLUMNS = ["Date", "Hour", "Market Demand", "Ontario Demand"]
ZONES = [
    "Northwest", "Northeast", "Ottawa", "East", "Toronto",
    "Essa", "Bruce", "Southwest", "Niagara", "West",
]
ZONAL_COLUMNS = ["Date", "Hour", "Ontario_Demand", *ZONES, "Zone_Total", "Diff"]
ZONAL_IDS = ["Date", "Hour", "Modified_DT", "Ontario_Demand", "Zone_Total", "Diff"]

# Stored tables, as "<layer>/<table>" below a store's root folder.
DEMAND = "raw/demand"
ZONAL_DEMAND = "raw/zonal_demand"
FUEL_OUTPUT = "raw/fuel_output"
CAPABILITY = "raw/capability"
PRIMARY_ZONAL_DEMAND = "primary/zonal_demand"
TABLE_REGISTER = "reference/table_register"
REJECTED_REPORTS = "reference/rejected_reports"
QUARANTINE = "reference/quarantine"
DATE_COUNTS = "reference/date_counts"
TAKEN_VERSIONS = "reference/taken_versions"
FORECAST_RUNS = "reference/forecast_runs"
FORECAST_MODELS = "reference/forecast_models"

# Nested shapes of the two XML reports; every leaf is read as text and typed later.
FUEL_DAY = (
    "Day STRING, HourlyData ARRAY<STRUCT<Hour: STRING, FuelTotal: ARRAY<STRUCT<"
    "Fuel: STRING, EnergyValue: STRUCT<Output: STRING>>>>>"
)
HOURLY_MW = "ARRAY<STRUCT<Hour: STRING, EnergyMW: STRING>>"
GENERATOR = (
    "STRUCT<GeneratorName: STRING, FuelType: STRING, "
    f"Outputs: STRUCT<Output: {HOURLY_MW}>, "
    f"Capabilities: STRUCT<Capability: {HOURLY_MW}>, "
    f"Capacities: STRUCT<AvailCapacity: {HOURLY_MW}>>"
)
CAPABILITY_REPORT = (
    f"Date STRING, Generators STRUCT<Generator: ARRAY<{GENERATOR}>>, Generator ARRAY<{GENERATOR}>"
)

# ROW_COUNT is BIGINT: a table of the intended size has more rows than an INT holds.
REGISTER_SCHEMA = (
    "id BIGINT, TABLE_NAME STRING, TABLE_SCHEMA STRING, MODIFIED_DT DATE, "
    "MODIFIED_TIME TIMESTAMP_NTZ, ROW_COUNT BIGINT, created_at TIMESTAMP_NTZ"
)
#: Rows of each date that a write left in its table; `whole` if it wrote all of the table.
DATE_COUNTS_SCHEMA = "write STRING, turn BIGINT, whole BOOLEAN, `Date` DATE, row_count BIGINT"
REJECTED_SCHEMA = (
    "report STRING, broken_rows BIGINT, wrong_values BIGINT, table_rows BIGINT, reason STRING, "
    "example STRING, `table` STRING"
)
QUARANTINE_SCHEMA = "report STRING, field STRING, text STRING, `row` STRING, `table` STRING"
FORECAST_RUN_SCHEMA = (
    "run_at TIMESTAMP_NTZ, series STRING, p INT, d INT, q INT, "
    "train_size BIGINT, test_size BIGINT, status STRING, mse DOUBLE, rmse DOUBLE"
)

# Forecast settings.
SHORT_ORDER = (5, 1, 0)
WEEKLY_ORDER = (24 * 7, 1, 1)
TRAIN_SHARE = 0.8
HORIZON = 24 * 30
