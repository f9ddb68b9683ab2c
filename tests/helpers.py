"""Small frames for the unit tests."""

import random

PANEL = "state_id string, store_id string, cat_id string, dept_id string, item_id string, day_num int, sales int, sell_price double"


def series_frame(spark, sales, first_day=1, store="S1", item="I1", price=1.0, state="A"):
    rows = [(state, store, "C1", "D1", item, first_day + i, v, price) for i, v in enumerate(sales)]
    return spark.createDataFrame(rows, PANEL)


def random_panel(spark, n_days=40, seed=7, n_items=3):
    """Two states, four stores, two departments; zeros are common."""
    rng = random.Random(seed)
    rows = []
    for s in range(4):
        for d in range(2):
            for i in range(n_items):
                for day in range(1, n_days + 1):
                    sales = rng.choice([0, 0, 0, 1, 2, 5])
                    price = rng.choice([0.0, 1.5, 2.0])
                    rows.append((f"A{s // 2}", f"S{s}", f"C{d}", f"D{d}", f"D{d}_{i}", day, sales, price))
    return spark.createDataFrame(rows, PANEL)


def values(df, *cols, order="day_num"):
    return [tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.orderBy(order).collect()]
