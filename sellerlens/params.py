"""Run parameters shared by the operators.

The defaults follow the parameter table in FIXTURES.md: the driver tables span
1995..2001, so the reference's 2017/2018 windows are moved onto that span.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field


def month_starts(first: _dt.date, count: int) -> list[_dt.date]:
    out = []
    y, m = first.year, first.month
    for _ in range(count):
        out.append(_dt.date(y, m, 1))
        m += 1
        if m == 13:
            y, m = y + 1, 1
    return out


@dataclass(frozen=True)
class Params:
    # reference dates of the feature stores (nine month starts)
    refs: tuple = field(default_factory=lambda: tuple(month_starts(_dt.date(2000, 1, 1), 9)))
    lookback_months: int = 6
    churn_days: int = 45
    # descriptive-query analysis window [start, end)
    window_start: _dt.date = _dt.date(1999, 1, 1)
    window_end: _dt.date = _dt.date(2001, 7, 1)
    # cohort query runs one month longer than the other descriptive queries
    cohort_end: _dt.date = _dt.date(2001, 8, 1)
    stuck_date: _dt.date = _dt.date(2001, 7, 1)
    # model / decision months
    oot_month: _dt.date = _dt.date(2000, 8, 1)
    score_month: _dt.date = _dt.date(2000, 9, 1)
    budget: float = 5000.0
    proba_floor: float = 0.5
    # item scope of the re-expanded seller items: "seller" (a seller's own
    # items of an order) or "order" (every item of the order, reference form)
    item_scope: str = "seller"
    # point-lookup ids used by the lookup queries
    lookup_order_id: int = 7
    lookup_seller_id: int = 1616
    lookup_product_id: int = 79


# Fixed run clock for reproducible stamps in the registered queries.
RUN_TS = _dt.datetime(2001, 8, 1, 6, 0, 0)
RUN_TS_PREV = _dt.datetime(2001, 7, 31, 6, 0, 0)
