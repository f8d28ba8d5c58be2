"""The star schema's tables and the shapes of the raw feeds."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, LONG, INT, DOUBLE, TIME = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.TimestampType()
NUM = T.DecimalType


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Column names and types of the store's tables.
TABLES: dict[str, T.StructType] = {
    "dim_countries": _struct(
        country_code=TEXT,
        country_code_2=TEXT,
        country_name=TEXT,
        region=TEXT,
        sub_region=TEXT,
        income_group=TEXT,
        population=LONG,
        area_km2=NUM(15, 2),
        capital=TEXT,
        languages=TEXT,
        currency=TEXT,
        lat=NUM(9, 6),
        lon=NUM(9, 6),
        created_at=TIME,
        updated_at=TIME,
    ),
    "fact_cardiovascular": _struct(
        country_code=TEXT,
        country_name=TEXT,
        year=INT,
        deaths_per_100k=NUM(10, 4),
        deaths_total=LONG,
        age_std_death_rate=NUM(10, 4),
        dalys_per_100k=NUM(10, 4),
        share_of_deaths_pct=NUM(7, 4),
        high_sbp_deaths=NUM(10, 4),
        high_cholesterol_deaths=NUM(10, 4),
        smoking_deaths=NUM(10, 4),
        obesity_deaths=NUM(10, 4),
        data_source=TEXT,
        loaded_at=TIME,
    ),
    "fact_life_expectancy": _struct(
        country_code=TEXT,
        country_name=TEXT,
        year=INT,
        life_expectancy_total=NUM(6, 3),
        life_expectancy_male=NUM(6, 3),
        life_expectancy_female=NUM(6, 3),
        infant_mortality_per_1000=NUM(8, 3),
        under5_mortality_per_1000=NUM(8, 3),
        adult_mortality_male_per_1000=NUM(8, 3),
        adult_mortality_female_per_1000=NUM(8, 3),
        neonatal_mortality_per_1000=NUM(8, 3),
        physicians_per_1000=NUM(8, 3),
        hospital_beds_per_1000=NUM(8, 3),
        health_expenditure_pct_gdp=NUM(7, 4),
        data_source=TEXT,
        loaded_at=TIME,
    ),
    "fact_hiv_aids": _struct(
        country_code=TEXT,
        country_name=TEXT,
        year=INT,
        prevalence_pct=NUM(8, 5),
        people_living_with_hiv=LONG,
        new_infections_total=LONG,
        new_infections_per_1000=NUM(8, 4),
        aids_deaths_total=LONG,
        aids_deaths_per_100k=NUM(10, 4),
        pct_on_antiretroviral=NUM(7, 4),
        children_living_with_hiv=LONG,
        new_child_infections=LONG,
        children_orphaned_by_aids=LONG,
        data_source=TEXT,
        loaded_at=TIME,
    ),
    "fact_diabetes_obesity": _struct(
        country_code=TEXT,
        country_name=TEXT,
        year=INT,
        diabetes_prevalence_pct=NUM(8, 4),
        diabetes_deaths_total=LONG,
        diabetes_deaths_per_100k=NUM(10, 4),
        diabetes_age_std_rate=NUM(10, 4),
        obesity_prevalence_pct=NUM(8, 4),
        overweight_prevalence_pct=NUM(8, 4),
        child_obesity_pct=NUM(8, 4),
        mean_bmi_male=NUM(6, 3),
        mean_bmi_female=NUM(6, 3),
        diabetes_health_spend_usd=NUM(15, 2),
        data_source=TEXT,
        loaded_at=TIME,
    ),
    "ml_predictions": _struct(
        country_code=TEXT,
        model_name=TEXT,
        predicted_risk_cat=TEXT,
        risk_probability=DOUBLE,
        predicted_le_total=DOUBLE,
        predicted_le_lower=DOUBLE,
        predicted_le_upper=DOUBLE,
    ),
    "ml_model_metrics": _struct(
        model_name=TEXT,
        top_features=TEXT,
        accuracy=DOUBLE,
        f1_score=DOUBLE,
        rmse=DOUBLE,
    ),
}

DIMENSION = "dim_countries"
FACTS = ("fact_life_expectancy", "fact_cardiovascular", "fact_hiv_aids", "fact_diabetes_obesity")
KEYS = {DIMENSION: ["country_code"], **{f: ["country_code", "year"] for f in FACTS}}

# Columns set by the load itself.
STAMPS = ("created_at", "updated_at", "loaded_at")

COUNTRY_JSON = _struct(
    cca2=TEXT,
    cca3=TEXT,
    name=_struct(common=TEXT),
    region=TEXT,
    subregion=TEXT,
    area=TEXT,
    latlng=T.ArrayType(DOUBLE),
    capital=T.ArrayType(TEXT),
    languages=T.MapType(TEXT, TEXT),
    currencies=T.MapType(TEXT, TEXT),
)

PAGED_RECORD = _struct(countryiso3code=TEXT, date=TEXT, value=TEXT, country=_struct(value=TEXT))


def measures(table: str) -> list[str]:
    """The columns an upsert overwrites: neither keys, names, source labels nor stamps."""
    fixed = {*KEYS[table], *STAMPS, "data_source"}
    fixed |= {"country_code_2"} if table == DIMENSION else {"country_name"}
    return [f.name for f in TABLES[table].fields if f.name not in fixed]
