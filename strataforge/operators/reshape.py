"""Long to wide with a lookup: percentages by country and age group to one row a country."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The age groups, the columns they become, and the output's columns.
AGE_GROUPS = {"Y0_14": "age_group_0_14", "Y15_24": "age_group_15_24", "Y25_49": "age_group_25_49", "Y50_64": "age_group_50_64", "Y65_79": "age_group_65_79", "Y80_MAX": "age_group_80_max"}
COUNTRY = ["country", "country_code_2_digit", "country_code_3_digit", "population"]
OUTPUT = [*COUNTRY, *AGE_GROUPS.values()]


def require_columns(df: DataFrame, columns: list[str], label: str) -> None:
    """Raises if columns are missing or there is no row."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"The {label} lacks the columns {missing}")
    if df.isEmpty():
        raise ValueError(f"The {label} has no rows")


def clean_percentage(value: Column) -> Column:
    """Letters removed, ":" and nothing as null, else a decimal; null too where it doesn't parse (see bad_percentage)."""
    return F.nullif(F.nullif(F.trim(F.regexp_replace(value, "[A-Za-z]", "")), F.lit("")), F.lit(":")).try_cast("decimal(9,4)")


def bad_percentage(value: Column) -> Column:
    cleaned = F.trim(F.regexp_replace(value, "[A-Za-z]", ""))
    return F.coalesce(~cleaned.isin("", ":") & cleaned.try_cast("decimal(9,4)").isNull(), F.lit(False))


def parse_population(df: DataFrame, value: str = "2019") -> DataFrame:
    """country_code, age_group, percentage, raw of rows whose code has a comma and a two-letter country."""
    parts = F.split("indic_de_geo_time", ",", 2)
    parsed = df.where(F.contains("indic_de_geo_time", F.lit(","))).withColumns({"_group": F.trim(parts[0]), "_code": F.trim(parts[1])})
    kept = parsed.where(F.col("_code").rlike(r"^\p{L}{2}$"))
    return kept.select("*", F.upper("_code").alias("country_code"), F.regexp_replace("_group", "^PC_", "").alias("age_group"), clean_percentage(F.col(value)).alias("percentage"), F.col(value).alias("raw")).drop("_group", "_code")


def pivot_last(long: DataFrame, key: str, column: str, value: str, position: list[str], names: dict[str, str]) -> DataFrame:
    """One row a key, a column for each name; the value of the last row by position wins, also if it is null."""
    picks = [F.max_by(F.struct(value), F.when(F.col(column) == raw, F.struct(*position)))[value].alias(name) for raw, name in names.items()]
    return long.groupBy(key).agg(*picks)


def population_by_age(population: DataFrame, countries: DataFrame, position: list[str], value: str = "2019", strict: bool = True) -> DataFrame:
    """Countries of the lookup with their percentages by age group; unknown countries and groups are left out.

    ``position`` gives the rows their order in the source, since of repeated country and group the last counts; so does the
    last lookup row of a code (by its own order columns, if it has them). ``strict`` raises on percentages that don't parse,
    else they are null. Empty inputs raise.
    """
    require_columns(population, ["indic_de_geo_time", value], "population")
    require_columns(countries, COUNTRY, "country lookup")
    long = parse_population(population, value)
    if strict:
        bad = long.where(bad_percentage(F.col("raw"))).limit(1).collect()
        if bad:
            raise ValueError(f"{bad[0]['raw']!r} is no percentage")
    order = [c for c in position if c in countries.columns] or COUNTRY
    lookup = countries.groupBy(F.upper("country_code_2_digit").alias("_code")).agg(F.max_by(F.struct(*COUNTRY), F.struct(*order)).alias("_c")).select("_code", "_c.*")
    known = long.where(F.col("age_group").isin(*AGE_GROUPS)).join(lookup.select("_code"), F.col("country_code") == F.col("_code"), "left_semi")
    wide = pivot_last(known, "country_code", "age_group", "percentage", position, AGE_GROUPS)
    return lookup.join(wide, F.col("_code") == F.col("country_code")).select(*OUTPUT)


def rejected_percentages(population: DataFrame, value: str = "2019") -> DataFrame:
    return parse_population(population, value).where(bad_percentage(F.col("raw")))
