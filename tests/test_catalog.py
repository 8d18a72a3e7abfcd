"""SQL access: the star registered as catalog tables answers reference-style SQL."""

from __future__ import annotations

from given import SF_SMALL
from starloom.operators import analytics as A
from starloom.plans.catalog import register_layers
from starloom.plans.registry import warehouse_for

# The five best categories of each region, by name: aggregate first, rank outside.
TOP_CATEGORIES = """
SELECT region, category, total_revenue, place AS category_rank
FROM (SELECT totals.*, CAST(rank() OVER (PARTITION BY region ORDER BY total_revenue DESC) AS BIGINT) AS place
      FROM (SELECT region, category, CAST(sum(net_revenue) AS DECIMAL(22,2)) AS total_revenue
            FROM warehouse.fact_sales
            JOIN (SELECT product_key, category FROM warehouse.dim_product WHERE is_current) USING (product_key)
            JOIN (SELECT store_key, region FROM warehouse.dim_store) USING (store_key)
            GROUP BY region, category) totals)
WHERE place <= 5
"""


def test_registered_tables_answer_sql(spark):
    wh = warehouse_for(spark, SF_SMALL)
    names = register_layers(spark, wh.root)
    assert "warehouse.fact_sales" in names and "staging.order_items" in names
    assert spark.sql("SELECT COUNT(*) AS n FROM warehouse.fact_sales").first().n == \
        wh.star.fact_sales.count()
    sql_rows = set(map(tuple, spark.sql(TOP_CATEGORIES).collect()))
    df_rows = set(map(tuple, A.q02_category_rank_by_region(wh.star).collect()))
    assert sql_rows == df_rows
