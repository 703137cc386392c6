"""Code tables used by the recoding operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: inclusive weather-code ranges and their categories
WEATHER_CATEGORIES = [
    (0, 3, "cloud_variation"),
    (4, 4, "smoke_or_pollution"),
    (5, 5, "dry_haze"),
    (6, 9, "dust_or_sandstorm"),
    (10, 12, "drizzle_or_local_fog"),
    (13, 13, "lightning_no_thunder"),
    (14, 16, "visible_precipitation"),
    (17, 19, "storm_or_gusts"),
    (20, 29, "non_violent_rain_or_fog"),
    (30, 39, "evolving_fog"),
    (40, 49, "light_to_heavy_rain"),
    (50, 59, "freezing_drizzle_or_rain"),
    (60, 69, "rain_snow_combination"),
    (70, 79, "snow_or_sleet"),
    (80, 89, "showers_or_small_hail"),
    (90, 99, "thunderstorm_or_hail"),
]

# fixed values: rare passenger titles and their replacements
TITLE_GROUPS = {
    "Special": ["Don", "Dr", "Mme", "Major", "Lady", "Sir", "Mlle", "Col", "Capt", "the", "Jonkheer"],
    "Mr": ["Rev"],
    "Miss": ["Ms"],
}


def weather_category(code: Column) -> Column:
    result = F.when(F.lit(False), F.lit(""))
    for low, high, name in WEATHER_CATEGORIES:
        result = result.when(code.between(low, high), name)
    return result.otherwise("unknown")


def regroup(value: Column, groups: dict[str, list]) -> Column:
    """Replace each listed value by its group name; other values stay."""
    result = None
    for name, members in groups.items():
        test = value.isin(*members)
        result = F.when(test, F.lit(name)) if result is None else result.when(test, F.lit(name))
    return value if result is None else result.otherwise(value)


def ordinal(value: Column, ordered: list) -> Column:
    """Position from the end of an ordered list (first value is the largest)."""
    result = F.when(F.lit(False), F.lit(0))
    for i, member in enumerate(ordered):
        result = result.when(value == member, len(ordered) - 1 - i)
    return result


def title_group(title: Column) -> Column:
    return regroup(title, TITLE_GROUPS)
