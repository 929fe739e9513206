from __future__ import annotations

import datetime as dt

D0 = dt.datetime(2024, 1, 1)
TX = "customer_id string, order_date timestamp_ntz, order_value double, product_category string"


def at(days: float = 0, **more) -> dt.datetime:
    return D0 + dt.timedelta(days=days, **more)


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
