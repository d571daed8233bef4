"""Most-clicked products of each area."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.texts import distinct_list, id_and_name, json_field
from clickloom.operators.ranks import ranked
from clickloom.sources.cities import AREA_LEVELS, area_level


def area_clicks(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Each click with the city's name and area; clicks in unknown cities drop out."""
    return clicks.join(cities, "city_id").select(
        "city_id", "city_name", "area", F.col("click_product_id").alias("pid")
    )


def area_product_counts(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks per area and product, with the cities they came from.

    Clicks are counted per city and product first. That pass over the click table hashes two
    numbers and combines before the shuffle; names and city lists appear only on its result.
    """
    per_city = clicks.groupBy("city_id", "click_product_id").agg(
        F.count(F.lit(1)).alias("city_clicks")
    )
    return (
        per_city.join(cities, "city_id")
        .groupBy("area", F.col("click_product_id").alias("pid"))
        .agg(
            F.sum("city_clicks").alias("click_count"),
            distinct_list(id_and_name(F.col("city_id"), F.col("city_name"))).alias("city_infos"),
        )
    )


def product_status(extend_info: Column) -> Column:
    """`Self` for status 0, `Third Party` for every other or missing status."""
    status = json_field(extend_info, "product_status")
    return F.when(status == "0", "Self").otherwise("Third Party")


def area_product_info(counts: DataFrame, products: DataFrame) -> DataFrame:
    """Add name and status; products that are not in the table drop out."""
    return counts.join(products, F.col("pid") == F.col("product_id")).select(
        "area", "city_infos", "pid", "product_name",
        product_status(F.col("extend_info")).alias("product_status"), "click_count",
    )


def area_top_products(
    info: DataFrame,
    task_id: str,
    levels: Mapping[str, Sequence[str]] = AREA_LEVELS,
    n: int = 3,
) -> DataFrame:
    """The `n` most-clicked products of each area; ties by smaller product id."""
    order = [F.desc("click_count"), "pid"]
    return (
        ranked(info, ["area"], order, n, "pid")
        .select(
            F.lit(task_id).alias("taskid"),
            "area",
            area_level(F.col("area"), levels).alias("areaLevel"),
            F.col("pid").alias("productid"),
            F.col("city_infos").alias("cityInfos"),
            F.col("click_count").alias("clickCount"),
            F.col("product_name").alias("productName"),
            F.col("product_status").alias("productStatus"),
        )
    )
