"""Reports as SQL text over registered views, with the functions of `functions.sql`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Views: actions, cities, products. Parameters: taskid, top.
AREA_TOP_PRODUCTS = """
WITH per_city AS (
    SELECT city_id, click_product_id AS pid, count(*) AS clicks
    FROM actions WHERE click_product_id <> -1 GROUP BY city_id, click_product_id
),
per_area AS (
    SELECT area, pid, sum(clicks) AS click_count,
           distinct_list(collect_set(id_and_name(city_id, city_name, ':'))) AS city_infos
    FROM per_city JOIN cities USING (city_id) GROUP BY area, pid
),
named AS (
    SELECT area, pid, click_count, city_infos, product_name, product_status(extend_info) AS status,
           row_number() OVER (PARTITION BY area ORDER BY click_count DESC, pid) AS place
    FROM per_area JOIN products ON pid = product_id
)
SELECT :taskid AS taskid, area, area_level(area) AS areaLevel, pid AS productid, city_infos AS cityInfos,
       click_count AS clickCount, product_name AS productName, status AS productStatus
FROM named WHERE place <= :top
"""


def run(spark: SparkSession, text: str, views: dict[str, DataFrame], **parameters) -> DataFrame:
    """The report of a SQL text; `views` are what its table names stand for."""
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)
    return spark.sql(text, args=parameters)
