"""Orders whose dates are legal but absurd must not stop the layers."""

from pyspark.sql import functions as F

from orderlake.plans.gold import read_gold
from orderlake.plans.pipeline import Layout
from tests.helpers import dimensions, order
from tests.test_layers import gold, put, silver


def test_far_dates_pass_through(spark, tmp_path):
    dims = dimensions(spark)
    layout = Layout(str(tmp_path))
    far = [order(1, order_date="0001-01-01T00:00:00"), order(2, order_date="9999-12-31T23:00:00"), order(3)]
    put(spark, layout.bronze, far, "2024-03-01 10:00:00")
    silver(spark, layout, dims)
    assert gold(spark, layout)["rows"] == 3
    put(spark, layout.bronze, [order(4, order_date="12345-01-01T00:00:00"), order(5)], "2024-03-01 11:00:00")
    silver(spark, layout, dims)
    done = gold(spark, layout)
    table = read_gold(spark, layout.gold)
    total = table.agg(F.sum("order_count")).first()[0]
    assert total == spark.read.parquet(layout.silver).count()
    assert done["rows"] in (1, 2)
