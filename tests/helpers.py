import json
from datetime import datetime, timedelta

from orderlake.operators.spatial import build_cells
from tests.shapes import box, polygon


def order(i, day=0, hour=9, x=0.5, y=0.5, **changes):
    start = datetime(2024, 3, 1, hour, i % 60) + timedelta(days=day)
    row = {
        "latitude": y,
        "longitude": x,
        "order_date": start.isoformat(),
        "dispatch_date": (start + timedelta(minutes=10)).isoformat(),
        "delivery_date": (start + timedelta(minutes=40 + i % 7)).isoformat(),
        "customer_id": i % 4,
        "employee_id": i % 3,
        "quantity_products": i % 100 + 1,
        "order_id": f"o{i}",
    }
    row.update(changes)
    return json.dumps(row)


def dimensions(spark):
    employees = spark.createDataFrame([(0, "e0"), (1, "e1")], "employee_id int, name string")
    customers = spark.createDataFrame([(0, "c0"), (1, "c1"), (2, "c2")], "customer_id int, name string")
    rows = [(k, k, f"n{k}", f"c{k}", polygon([box(k, 0, k + 1, 1)])) for k in range(4)]
    boundaries = spark.createDataFrame(
        rows, "ord int, area_id int, neighborhood string, comune string, geometry binary"
    )
    return employees, customers, build_cells(boundaries, 1.0)
