"""Invariants from the survey's test strategy, on the driver test tables,
plus a hot-key fixture checked against a brute-force pandas computation."""

import datetime as dt
import random

from conftest import SF_SMALL
from pyspark.sql import functions as F

from wideloom.operators import aggregates as A
from wideloom.plans.registry import QUERIES


def test_window_totals_monotone(spark):
    rows = QUERIES["order_windows"](spark, SF_SMALL).collect()
    assert rows
    for r in rows:
        nums = [r.LST_ORDER_NUM_30D, r.LST_ORDER_NUM_90D, r.LST_ORDER_NUM_180D, r.LST_ORDER_NUM_360D]
        amts = [r.LST_ORDER_AMOUNT_30D, r.LST_ORDER_AMOUNT_90D, r.LST_ORDER_AMOUNT_180D, r.LST_ORDER_AMOUNT_360D]
        nums = [n or 0 for n in nums]
        amts = [a or 0.0 for a in amts]
        assert nums == sorted(nums) and amts == sorted(amts)
        assert r.LST_ORDER_NUM_360D and r.LST_ORDER_NUM_360D > 0  # every row has the widest window


def test_wide_profile_one_row_per_key(spark):
    w = QUERIES["wide_profile"](spark, SF_SMALL)
    n = w.count()
    assert n == w.select("tenant_id", "member_id").distinct().count() == w.select("ROW_KEY").distinct().count()


def test_cells_are_unique_after_upsert(spark):
    c = QUERIES["cells_upsert_latest"](spark, SF_SMALL)
    assert c.count() == c.select("row_key", "cf", "col").distinct().count()


def test_hot_key_matches_brute_force(spark):
    rnd = random.Random(7)
    day0 = dt.date(2021, 1, 1)
    rows = []
    for i in range(30000):
        member = 0 if i % 3 == 0 else rnd.randrange(1, 500)  # member 0 holds a third of all rows
        rows.append((member, day0 + dt.timedelta(days=rnd.randrange(0, 400)), rnd.randrange(0, 10000), rnd.randrange(1, 50)))
    df = spark.createDataFrame(rows, "member_id long, d date, amount long, shop long").repartition(16)
    from wideloom.params import AsOf
    asof = AsOf(dt.date(2022, 1, 15))
    secs = {"life": A.Section((A.sum_of("total", F.col("amount")), A.attr_at_first("first_shop", F.col("d"), F.col("shop")),
                               A.attr_at_last("last_shop", F.col("d"), F.col("shop")))),
            **A.window_sections("d", asof, {"30D": [A.sum_of("t30", F.col("amount"))],
                                            "180D": [A.count_rows("n180")]})}
    got = {r.member_id: r for r in A.sectioned_aggregate(df, ["member_id"], secs).collect()}
    pdf = df.toPandas()
    for m in (0, 1, 2, 499):
        g = pdf[pdf.member_id == m]
        if g.empty:
            continue
        first_day, last_day = g.d.min(), g.d.max()
        assert got[m].total == g.amount.sum()
        assert got[m].first_shop == g[g.d == first_day].shop.min()
        assert got[m].last_shop == g[g.d == last_day].shop.max()
        w30 = g[g.d >= dt.date(2021, 12, 15)]
        assert got[m].t30 == (w30.amount.sum() if len(w30) else None)
        assert got[m].n180 == (len(g[g.d >= dt.date(2021, 7, 15)]) or None)
