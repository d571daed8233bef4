"""The city dimension."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The ten cities and their areas, and the level of each area.
CITIES = (
    (0, "北京", "华北"),
    (1, "上海", "华东"),
    (2, "南京", "华东"),
    (3, "广州", "华南"),
    (4, "三亚", "华南"),
    (5, "武汉", "华中"),
    (6, "长沙", "华中"),
    (7, "西安", "西北"),
    (8, "成都", "西南"),
    (9, "哈尔滨", "东北"),
)
AREA_LEVELS = {
    "A_Level": ("华北", "华东"),
    "B_Level": ("华中", "华南"),
    "C_Level": ("西南", "西北"),
}
OTHER_LEVEL = "D_Level"


def city_dimension(
    spark: SparkSession, cities: Sequence[tuple[int, str, str]] = CITIES
) -> DataFrame:
    """city_id, city_name, area as an inline relation, whose exact size the planner knows."""
    rows = F.array(*[
        F.struct(
            F.lit(city_id).cast("bigint").alias("city_id"),
            F.lit(city_name).alias("city_name"),
            F.lit(area).alias("area"),
        )
        for city_id, city_name, area in cities
    ])
    return spark.range(1).select(F.inline(rows))


def area_level(area: Column, levels: Mapping[str, Sequence[str]] = AREA_LEVELS) -> Column:
    """Level of an area; areas in no list get the last level."""
    level_of = {a: level for level, areas in levels.items() for a in areas}
    whens = [F.when(area == a, level) for a, level in level_of.items()]
    return F.coalesce(*whens, F.lit(OTHER_LEVEL))
