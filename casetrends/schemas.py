"""Column layouts and header spellings of the published case-count files.

Everything in this module is a fixed value: names, types, order and alternative header
spellings have to equal those of the source files and of the tables built from them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


_TYPES = {
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
}


def _struct(columns: str) -> T.StructType:
    """``name type, ...`` to a schema, without the session that a DDL parser needs."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[dtype]) for name, dtype in pairs])


# --- fixed values: leading columns of the wide time series, in file order ---------------

US_CONFIRMED_IDS = _struct(
    "UID bigint, iso2 string, iso3 string, code3 bigint, FIPS bigint, county string, "
    "province_state string, country_region string, latitude double, longitude double, "
    "combined_key string"
)

US_DEATHS_IDS = _struct(
    "UID bigint, iso2 string, iso3 string, code3 bigint, FIPS bigint, county string, "
    "province_state string, country_region string, latitude double, longitude double, "
    "combined_key string, population bigint"
)

GLOBAL_IDS = _struct(
    "province_state string, country_region string, latitude double, longitude double"
)

# --- fixed values: descriptive columns carried from wide to long -------------------------

US_SERIES_KEY = ("combined_key",)
US_PLACE = ("county", "province_state", "country_region", "combined_key", "latitude", "longitude")
GLOBAL_SERIES_KEY = ("province_state", "country_region")
GLOBAL_PLACE = ("province_state", "country_region", "latitude", "longitude")

# --- fixed values: column order of the published series tables ---------------------------

US_SERIES_COLUMNS = (
    "dt",
    "county",
    "province_state",
    "country_region",
    "combined_key",
    "latitude",
    "longitude",
    "population",
    "total_confirmed",
    "total_deaths",
    "daily_new_confirmed",
    "daily_new_deaths",
    "daily_new_confirmed_7d_ma",
    "daily_new_deaths_7d_ma",
    "daily_new_confirmed_28d_ma",
    "daily_new_deaths_28d_ma",
    "incident_rate",
    "case_fatality_rate",
    "last_updated_dt",
    "last_updated_ts",
)

# --- fixed values: daily report layouts ---------------------------------------------------

US_DAILY_SCHEMA = _struct(
    "UID bigint, FIPS bigint, iso3 string, province_state string, country_region string, "
    "latitude double, longitude double, confirmed bigint, deaths bigint, recovered bigint, "
    "active bigint, incident_rate double, case_fatality_ratio double, "
    "total_test_results bigint, testing_rate double, people_hospitalized bigint, "
    "hospitalization_rate double, last_update timestamp"
)

GLOBAL_DAILY_SCHEMA = _struct(
    "FIPS bigint, county string, province_state string, country_region string, "
    "combined_key string, latitude double, longitude double, confirmed bigint, "
    "deaths bigint, recovered bigint, active bigint, incident_rate double, "
    "case_fatality_ratio double, last_update timestamp"
)

# header spelling -> canonical column
US_DAILY_ALIASES = {
    "UID": "UID",
    "FIPS": "FIPS",
    "ISO3": "iso3",
    "Province_State": "province_state",
    "Country_Region": "country_region",
    "Lat": "latitude",
    "Long_": "longitude",
    "Confirmed": "confirmed",
    "Deaths": "deaths",
    "Recovered": "recovered",
    "Active": "active",
    "Incident_Rate": "incident_rate",
    "Case_Fatality_Ratio": "case_fatality_ratio",
    "Mortality_Rate": "case_fatality_ratio",
    "Total_Test_Results": "total_test_results",
    "People_Tested": "total_test_results",
    "Testing_Rate": "testing_rate",
    "People_Hospitalized": "people_hospitalized",
    "Hospitalization_Rate": "hospitalization_rate",
    "Last_Update": "last_update",
}

GLOBAL_DAILY_ALIASES = {
    "FIPS": "FIPS",
    "Admin2": "county",
    "Province/State": "province_state",
    "Province_State": "province_state",
    "Country_Region": "country_region",
    "Country/Region": "country_region",
    "Combined_Key": "combined_key",
    "Latitude": "latitude",
    "Lat": "latitude",
    "Longitude": "longitude",
    "Long_": "longitude",
    "Confirmed": "confirmed",
    "Deaths": "deaths",
    "Recovered": "recovered",
    "Active": "active",
    "Incident_Rate": "incident_rate",
    "Incidence_Rate": "incident_rate",
    "Case_Fatality_Ratio": "case_fatality_ratio",
    "Case-Fatality_Ratio": "case_fatality_ratio",
    "Last Update": "last_update",
    "Last_Update": "last_update",
}

# --- end of fixed values ------------------------------------------------------------------


@dataclass(frozen=True)
class ReportLayout:
    """How one family of drifting CSV reports maps onto one table."""

    name: str
    aliases: dict[str, str]
    schema: T.StructType

    def __post_init__(self) -> None:
        stray = set(self.aliases.values()) - set(self.schema.names)
        if stray:
            raise ValueError(f"{self.name}: aliases point at unknown columns {sorted(stray)}")

    def spellings(self, column: str) -> list[str]:
        return [header for header, target in self.aliases.items() if target == column]


US_DAILY = ReportLayout("daily_us", US_DAILY_ALIASES, US_DAILY_SCHEMA)
GLOBAL_DAILY = ReportLayout("daily_global", GLOBAL_DAILY_ALIASES, GLOBAL_DAILY_SCHEMA)
