"""From raw feeds to the five clean tables of the star schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelfold.functions import formulas
from panelfold.functions.scalars import (
    clean_code,
    falsy_to_null,
    first_match,
    half_even_long,
    is_code,
    number_or,
    safe_double,
    safe_long,
    text_or,
)
from panelfold.operators.clean import valid_rows
from panelfold.operators.combine import known_keys, pivot_feeds
from panelfold.operators.impute import impute_panel
from panelfold.operators.shape import period_between, resolve_measures, with_lookup
from panelfold.operators.upsert import latest_per_key
from panelfold.schemas import STAMPS, TABLES
from panelfold.session import stage

# Period covered, and the indicator code behind each measure.
PERIODS = (1990, 2022)
INDICATORS = {
    "life_expectancy_total": "SP.DYN.LE00.IN",
    "life_expectancy_male": "SP.DYN.LE00.MA.IN",
    "life_expectancy_female": "SP.DYN.LE00.FE.IN",
    "infant_mortality_per_1000": "SP.DYN.IMRT.IN",
    "under5_mortality_per_1000": "SH.DYN.MORT",
    "adult_mortality_male_per_1000": "SP.DYN.AMRT.MA",
    "adult_mortality_female_per_1000": "SP.DYN.AMRT.FE",
    "neonatal_mortality_per_1000": "SH.DYN.NMRT",
    "physicians_per_1000": "SH.MED.PHYS.ZS",
    "hospital_beds_per_1000": "SH.MED.BEDS.ZS",
    "health_expenditure_pct_gdp": "SH.XPD.CHEX.GD.ZS",
}

# Income classes by country code, then by sub-region.
LOW_INCOME_CODES = (
    "AFG", "BFA", "BDI", "CAF", "TCD", "COD", "ERI", "ETH", "GIN", "GNB",
    "HTI", "PRK", "LBR", "MDG", "MLI", "MOZ", "NER", "RWA", "SSD", "SOM",
    "SDN", "SYR", "TGO", "UGA", "YEM", "ZMB", "SLE", "GMB", "MWI", "COG",
)
HIGH_INCOME_SUB_REGIONS = (
    "Western Europe", "Northern Europe", "Southern Europe", "Northern America", "Australia and New Zealand",
)
UPPER_MIDDLE_SUB_REGIONS = ("Eastern Europe", "South America", "Caribbean", "Eastern Asia", "Western Asia")
INCOME_GROUPS = ("Low income", "Lower middle income", "Upper middle income", "High income")

# Defaults and column widths of the country table.
DEFAULT_POPULATION = 5_000_000
LOOKUP_POPULATION = 10_000_000
PEOPLE_PER_KM2 = 60
DEFAULT_AREA = 1000.0
DEFAULT_COORDINATE = 0.0
DEFAULT_TEXT = {"region": "Global", "sub_region": "General", "capital": "N/A", "languages": "Official", "currency": "USD"}
WIDTHS = {
    "country_code_2": 2, "country_name": 150, "region": 100, "sub_region": 100,
    "capital": 100, "languages": 300, "currency": 100,
}

# Words that identify a feed's measure column.
CARDIO_COLUMNS = {
    "deaths_total": ["total deaths from cardiovascular", "deaths - cardiovascular"],
    "age_std_death_rate": ["age-standardized", "death rate"],
    "high_sbp_deaths": ["hypertension", "blood pressure"],
    "smoking_deaths": ["smoke", "tobacco"],
}
EPIDEMIC_COLUMNS = {
    "prevalence_pct": ["prevalence in adults", "prevalence", "% of adults"],
    "aids_deaths_total": ["aids-related deaths", "deaths - hiv", "aids deaths"],
    "new_infections_total": ["number of new hiv infections", "new infections"],
    "aids_deaths_per_100k": ["death rate from hiv", "death rate"],
    "pct_on_antiretroviral": ["antiretroviral", "art coverage"],
}
METABOLIC_COLUMNS = {
    "diabetes_deaths_total": ["total deaths from diabetes", "deaths from diabetes"],
    "diabetes_deaths_per_100k": ["death rate from diabetes", "diabetes death rate"],
    "obesity_prevalence_pct": ["obesity among adults", "share that are obese"],
    "diabetes_prevalence_pct": ["diabetes prevalence"],
}

# Last resorts of the imputation and the source labels.
EPIDEMIC_CONSTANT = 0.01
DEFAULT_CARDIO_DEATHS = 1000
DEFAULT_DIABETES_DEATHS = 500
SOURCE_API = "World Bank API"
SOURCE_WHO = "Our World in Data / WHO"
SOURCE_UNAIDS = "Our World in Data / UNAIDS"


def population_lookup(records: DataFrame) -> DataFrame:
    """(country_code, population) from API records; empty and zero values are left out."""
    return (
        records.select(clean_code("countryiso3code").alias("country_code"), safe_double("value").alias("v"))
        .where((F.col("country_code") != "") & (F.col("v") != 0))
        .groupBy("country_code")
        .agg(F.max(F.floor("v").cast("bigint")).alias("population"))
    )


def extract_countries(documents: DataFrame, population: DataFrame) -> DataFrame:
    """Flatten nested country documents to one row per valid code.

    Population comes from the lookup, else from the area at a fixed density.
    """
    area = falsy_to_null(safe_double("area"))
    flat = documents.where(is_code("cca3")).select(
        clean_code("cca3").alias("country_code"),
        F.coalesce("cca2", F.lit("")).alias("country_code_2"),
        F.coalesce("name.common", F.lit("")).alias("country_name"),
        F.coalesce("region", F.lit("")).alias("region"),
        F.coalesce("subregion", F.lit("")).alias("sub_region"),
        area.alias("area"),
        F.substring(F.coalesce(F.array_join("capital", ", "), F.lit("")), 1, WIDTHS["capital"]).alias("capital"),
        F.substring(F.coalesce(F.array_join(F.map_values("languages"), ", "), F.lit("")), 1, WIDTHS["languages"]).alias("languages"),
        F.substring(F.coalesce(F.array_join(F.map_keys("currencies"), ", "), F.lit("")), 1, WIDTHS["currency"]).alias("currency"),
        F.coalesce(F.try_element_at("latlng", F.lit(1)), F.lit(DEFAULT_COORDINATE)).alias("lat"),
        F.coalesce(F.try_element_at("latlng", F.lit(2)), F.lit(DEFAULT_COORDINATE)).alias("lon"),
    )
    from_area = (F.col("area") * PEOPLE_PER_KM2).cast("bigint")
    return (
        flat.join(population, "country_code", "left")
        .withColumn("population", F.coalesce("population", from_area))
        .withColumn("area_km2", F.coalesce("area", F.lit(DEFAULT_AREA)))
        .drop("area")
    )


def extract_indicators(records: DataFrame, tag: str, seq: Sequence[str]) -> DataFrame:
    """API records of all indicators, tagged by code, to one wide row per (country, year).

    Missing and zero values are left out, the last record of a cell wins, the first name is kept.
    """
    usable = records.where(safe_double("value").isNotNull() & (safe_double("value") != 0) & is_code("countryiso3code"))
    rows = usable.select(
        clean_code("countryiso3code").alias("country_code"),
        F.col("date").try_cast("int").alias("year"),
        F.coalesce("country.value", F.lit("")).alias("country_name"),
        F.col(tag).alias("tag"),
        safe_double("value").alias("v"),
        *[F.col(c).alias(f"seq{i}") for i, c in enumerate(seq)],
    )
    return pivot_feeds(
        rows, ["country_code", "year"], "tag", "v", [f"seq{i}" for i in range(len(seq))], INDICATORS, ["country_name"]
    )


def income_group(code: str, sub_region: str) -> Column:
    """Income class: listed codes first, then the sub-region, else the lower middle class."""
    return first_match(
        [
            (F.col(code).isin(*LOW_INCOME_CODES), "Low income"),
            (F.col(sub_region).isin(*HIGH_INCOME_SUB_REGIONS), "High income"),
            (F.col(sub_region).isin(*UPPER_MIDDLE_SUB_REGIONS), "Upper middle income"),
        ],
        "Lower middle income",
    )


def clean_countries(raw: DataFrame) -> DataFrame:
    """Valid, named countries with every attribute filled, one row per code.

    A code that several documents have keeps one of them, chosen by content.
    """
    coded = valid_rows(raw, "country_code", "country_name").withColumn("country_code", clean_code("country_code"))
    rows = latest_per_key(coded, ["country_code"], [])
    pop = safe_long("population")
    texts = {
        c: text_or(c, DEFAULT_TEXT.get(c), WIDTHS[c]) for c in ("region", "sub_region", "capital", "languages", "currency")
    }
    return rows.withColumn("income_group", income_group("country_code", "sub_region")).select(
        "country_code",
        F.substring(F.coalesce("country_code_2", F.lit("")), 1, WIDTHS["country_code_2"]).alias("country_code_2"),
        F.substring(F.trim("country_name"), 1, WIDTHS["country_name"]).alias("country_name"),
        texts["region"].alias("region"),
        texts["sub_region"].alias("sub_region"),
        "income_group",
        F.when(pop > 0, pop).otherwise(F.lit(DEFAULT_POPULATION)).alias("population"),
        number_or("area_km2", DEFAULT_AREA).alias("area_km2"),
        *[texts[c].alias(c) for c in ("capital", "languages", "currency")],
        number_or("lat", DEFAULT_COORDINATE).alias("lat"),
        number_or("lon", DEFAULT_COORDINATE).alias("lon"),
    )


def _with_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add measures a failed feed left out, as NULL."""
    return df.withColumns({c: F.lit(None).cast("double") for c in columns if c not in df.columns})


def _fact(rows: DataFrame, table: str, source: str) -> DataFrame:
    """The columns of a fact in the store's order, without the load's stamps."""
    columns = [f.name for f in TABLES[table].fields if f.name not in STAMPS]
    return rows.withColumn("data_source", F.lit(source)).select(*columns)


def clean_life(raw: DataFrame, countries: DataFrame) -> DataFrame:
    """Life-expectancy facts: known countries, covered years, gaps filled, genders completed."""
    columns = list(INDICATORS)
    rows = period_between(known_keys(_with_missing(raw, columns), countries, "country_code"), "year", *PERIODS)
    full = impute_panel(rows, ["country_code"], "year", columns, digits=3)
    full = full.withColumns(
        formulas.gendered_life("life_expectancy_total", "life_expectancy_male", "life_expectancy_female")
    )
    return _fact(full, "fact_life_expectancy", SOURCE_API)


def _feed_rows(raw: DataFrame, countries: DataFrame, wanted: Mapping[str, Sequence[str]]) -> DataFrame:
    """Merged feed rows of known countries and covered years, with the wanted measures resolved."""
    meta = ("Entity", "Year", "Code")
    rows = resolve_measures(raw, wanted, among=[c for c in raw.columns if c not in meta])
    rows = period_between(rows.where(F.length("Code") == 3), "Year", *PERIODS)
    rows = rows.select(
        F.upper("Code").alias("country_code"), F.col("Entity").alias("country_name"), F.col("Year").cast("int").alias("year"), *wanted
    )
    return known_keys(rows, countries, "country_code")


def clean_cardio(raw: DataFrame, countries: DataFrame) -> DataFrame:
    """Cardiovascular facts from the merged feeds."""
    rows = _feed_rows(raw, countries, CARDIO_COLUMNS)
    full = stage(impute_panel(rows, ["country_code"], "year", list(CARDIO_COLUMNS), digits=4), "cardio")  # for the mean and for the rows
    mean_rate = full.agg(F.avg("age_std_death_rate")).scalar()
    out = full.withColumns(formulas.cardio_indicators("age_std_death_rate", "high_sbp_deaths", mean_rate))
    out = out.withColumn("deaths_total", half_even_long(F.coalesce("deaths_total", F.lit(DEFAULT_CARDIO_DEATHS))))
    return _fact(out, "fact_cardiovascular", SOURCE_WHO)


def clean_epidemic(raw: DataFrame, countries: DataFrame) -> DataFrame:
    """Epidemic facts from the merged feeds; the population of the country scales the rates."""
    rows = _feed_rows(raw, countries, EPIDEMIC_COLUMNS)
    full = impute_panel(rows, ["country_code"], "year", list(EPIDEMIC_COLUMNS), constant=EPIDEMIC_CONSTANT)
    people = countries.select("country_code", falsy_to_null("population").alias("population"))
    full = with_lookup(full, people, "country_code", "population", LOOKUP_POPULATION)
    out = full.withColumns(
        formulas.epidemic_indicators(
            "prevalence_pct", "aids_deaths_total", "new_infections_total", "aids_deaths_per_100k", "population"
        )
    )
    return _fact(out, "fact_hiv_aids", SOURCE_UNAIDS)


def clean_metabolic(raw: DataFrame, countries: DataFrame) -> DataFrame:
    """Diabetes and obesity facts from the merged feeds."""
    rows = _feed_rows(raw, countries, METABOLIC_COLUMNS)
    full = impute_panel(rows, ["country_code"], "year", list(METABOLIC_COLUMNS), digits=4)
    names = ("diabetes_prevalence_pct", "diabetes_deaths_per_100k", "obesity_prevalence_pct")
    full = full.withColumn("diabetes_prevalence_pct", formulas.diabetes_prevalence(*names))
    out = full.withColumns(formulas.metabolic_indicators(*names)).withColumn(
        "diabetes_deaths_total", half_even_long(F.coalesce("diabetes_deaths_total", F.lit(DEFAULT_DIABETES_DEATHS)))
    )
    return _fact(out, "fact_diabetes_obesity", SOURCE_WHO)


def tag_feeds(feeds: Mapping[str, DataFrame], tag: str = "indicator") -> DataFrame:
    """Union of equally shaped feeds, each row tagged with its feed and the feed's place."""
    parts = [df.withColumns({tag: F.lit(name), "feed_no": F.lit(i)}) for i, (name, df) in enumerate(feeds.items())]
    return reduce(DataFrame.unionByName, parts)
