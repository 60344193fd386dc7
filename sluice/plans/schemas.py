"""Column names, type maps and output orders of the two jobs.

Jobs address columns by *logical* snake-case names. A ``names`` mapping
(logical -> physical) lets the same job run over files that carry the
original spaced headers, e.g. ``names=ADMISSIONS_HEADERS``.
"""

from __future__ import annotations

from collections.abc import Mapping

# --- Admissions ------------------------------------------------------------

# Source columns in file order.
ADMISSIONS_SOURCE = (
    "name", "age", "gender", "blood_type", "medical_condition",
    "date_of_admission", "doctor", "hospital", "insurance_provider",
    "billing_amount", "room_number", "admission_type", "discharge_date",
    "medication", "test_results",
)

# Header names of the admissions CSV and of the derived output
# columns, logical name -> header, in file order.
ADMISSIONS_HEADERS = {
    "name": "Name",
    "age": "Age",
    "gender": "Gender",
    "blood_type": "Blood Type",
    "medical_condition": "Medical Condition",
    "date_of_admission": "Date of Admission",
    "doctor": "Doctor",
    "hospital": "Hospital",
    "insurance_provider": "Insurance Provider",
    "billing_amount": "Billing Amount",
    "room_number": "Room Number",
    "admission_type": "Admission Type",
    "discharge_date": "Discharge Date",
    "medication": "Medication",
    "test_results": "Test Results",
    "row_key": "UUID",
    "etl_batch_id": "ETL_batch_id",
    "etl_batch_date": "ETL_batch_date",
    "admission_days": "Admission Days",
    "risk_score": "Risk Score",
}

# Output columns of the admissions job, in output order, with
# their types (the 17-digit batch id is a bigint; amounts and scores double).
ADMISSIONS_TYPES = {
    "etl_batch_id": "bigint",
    "etl_batch_date": "date",
    "row_key": "string",
    "name": "string",
    "age": "int",
    "gender": "string",
    "blood_type": "string",
    "medical_condition": "string",
    "date_of_admission": "date",
    "doctor": "string",
    "hospital": "string",
    "insurance_provider": "string",
    "billing_amount": "double",
    "room_number": "int",
    "admission_type": "string",
    "discharge_date": "date",
    "medication": "string",
    "test_results": "string",
    "admission_days": "int",
    "risk_score": "double",
}

ADMISSIONS_OUTPUT = tuple(ADMISSIONS_TYPES)

# The scheduled-workflow job's own names of the columns it adds,
# and its output order (the added id first).
ADMISSIONS_WORKFLOW_HEADERS = {
    **ADMISSIONS_HEADERS,
    "row_key": "uuid",
    "etl_batch_id": "ETLBatchID",
    "etl_batch_date": "ETLBatchDate",
}
ADMISSIONS_WORKFLOW_OUTPUT = (
    "row_key", "etl_batch_id", "etl_batch_date", "name", "age", "gender",
    "blood_type", "medical_condition", "date_of_admission", "doctor",
    "hospital", "insurance_provider", "billing_amount", "room_number",
    "admission_type", "discharge_date", "medication", "test_results",
    "admission_days", "risk_score",
)

# Risk score weights (age share, diabetes flag, billing share)
# and the condition that sets the flag.
RISK_WEIGHTS = (0.4, 0.3, 0.3)
RISK_CONDITION = "Diabetes"

# --- Smart home ------------------------------------------------------------

# Source columns (power, weather, all in file order).
SMART_HOME_POWER_READINGS = (
    "gen", "house_overall", "dishwasher", "furnace_1", "furnace_2",
    "home_office", "fridge", "wine_cellar", "garage_door", "kitchen_12",
    "kitchen_14", "kitchen_38", "barn", "well", "microwave", "living_room",
    "solar",
)

SMART_HOME_WEATHER_READINGS = (
    "humidity", "visibility", "apparent_temperature", "pressure",
    "wind_speed", "cloud_cover", "wind_bearing", "precip_intensity",
    "dew_point", "precip_probability",
)

SMART_HOME_SOURCE = (
    "time", "use_kw", *SMART_HOME_POWER_READINGS, "temperature", "icon",
    "humidity", "visibility", "summary", "apparent_temperature", "pressure",
    "wind_speed", "cloud_cover", "wind_bearing", "precip_intensity",
    "dew_point", "precip_probability",
)

# Header names of the smart-home CSV and of the derived
# columns, logical name -> header.
SMART_HOME_HEADERS = {
    "time": "time",
    "use_kw": "use [kW]",
    "gen": "gen [kW]",
    "house_overall": "House overall [kW]",
    "dishwasher": "Dishwasher [kW]",
    "furnace_1": "Furnace 1 [kW]",
    "furnace_2": "Furnace 2 [kW]",
    "home_office": "Home office [kW]",
    "fridge": "Fridge [kW]",
    "wine_cellar": "Wine cellar [kW]",
    "garage_door": "Garage door [kW]",
    "kitchen_12": "Kitchen 12 [kW]",
    "kitchen_14": "Kitchen 14 [kW]",
    "kitchen_38": "Kitchen 38 [kW]",
    "barn": "Barn [kW]",
    "well": "Well [kW]",
    "microwave": "Microwave [kW]",
    "living_room": "Living room [kW]",
    "solar": "Solar [kW]",
    "temperature": "temperature",
    "icon": "icon",
    "humidity": "humidity",
    "visibility": "visibility",
    "summary": "summary",
    "apparent_temperature": "apparentTemperature",
    "pressure": "pressure",
    "wind_speed": "windSpeed",
    "cloud_cover": "cloudCover",
    "wind_bearing": "windBearing",
    "precip_intensity": "precipIntensity",
    "dew_point": "dewPoint",
    "precip_probability": "precipProbability",
    "furnace_total": "Furnace Total [kW]",
    "kitchen_total": "Kitchen Total [kW]",
    "kitchen_appliances": "Kitchen Appliances",
    "row_key": "uuid",
    "etl_batch_id": "ETL_batch_id",
    "etl_batch_date": "ETL_batch_date",
    "max_power": "max_power",
    "min_power": "min_power",
    "avg_power": "avg_power",
}

SMART_HOME_STRING_READINGS = ("icon", "summary")

SMART_HOME_TYPES = {
    c: ("string" if c in SMART_HOME_STRING_READINGS else "double")
    for c in SMART_HOME_SOURCE
    if c != "time"
}

# Derived power totals (output -> parts, summed left to right)
# and the parts that make up the recomputed house total, in summation order.
SMART_HOME_TOTALS = {
    "furnace_total": ("furnace_1", "furnace_2"),
    "kitchen_total": ("kitchen_12", "kitchen_14", "kitchen_38"),
    "kitchen_appliances": ("fridge", "dishwasher", "microwave"),
}
HOUSE_OVERALL_PARTS = (
    "kitchen_total", "home_office", "garage_door", "wine_cellar", "barn",
    "well", "living_room", "kitchen_appliances", "furnace_total",
)

# Output columns of the smart-home job, in output order.
SMART_HOME_OUTPUT = (
    "etl_batch_id", "etl_batch_date", "row_key", "time", "use_kw", "gen",
    "house_overall", "home_office", "wine_cellar", "garage_door", "barn",
    "well", "living_room", "solar", "temperature", "icon", "humidity",
    "visibility", "summary", "apparent_temperature", "pressure", "wind_speed",
    "cloud_cover", "wind_bearing", "precip_intensity", "dew_point",
    "precip_probability", "furnace_total", "kitchen_total",
    "kitchen_appliances", "max_power", "min_power", "avg_power",
)

# Power columns left after the totals replace their parts: the candidates of
# the "which circuit draws most" report.
POWER_FIELDS = (
    "home_office", "wine_cellar", "garage_door", "barn", "well",
    "living_room", "furnace_total", "kitchen_total", "kitchen_appliances",
)


def resolve(names: Mapping[str, str] | None, logical: str) -> str:
    """Physical column name of a logical one (identity when unmapped)."""
    if not names:
        return logical
    return names.get(logical, logical)
