"""Full outer merge by (tenant, member), item snapshots, filters that reach the scans."""

import datetime as dt
import re

import pytest
from conftest import SF_SMALL

from wideloom.operators.joins import snapshot
from wideloom.operators.merge import merge_sections
from wideloom.operators.topn import top_n_pivot
from wideloom.plans import sections as S
from wideloom.plans import wide_build as W
from wideloom.plans.registry import QUERIES
from wideloom.sources import bindings as B


def test_merge_by_tenant_and_member(spark):
    members = spark.createDataFrame([(1, 7, "anna"), (2, 7, "bo")], "tenant_id int, member_id long, name string")
    orders = spark.createDataFrame([(1, 7, 10), (3, 7, 5), (3, 9, None)], "tenant_id int, member_id long, n int")
    coupons = spark.createDataFrame([(3, 9, "x")], "tenant_id int, member_id long, c string")
    out = merge_sections({"m": members, "o": orders, "c": coupons}, ["tenant_id", "member_id"])
    got = {(r.tenant_id, r.member_id): (r.name, r.n, r.c, r.has_m, r.has_o, r.has_c) for r in out.collect()}
    assert got == {(1, 7): ("anna", 10, None, True, True, False), (2, 7): ("bo", None, None, True, False, False),
                   (3, 7): (None, 5, None, False, True, False), (3, 9): (None, None, "x", False, True, True)}


def test_merge_refuses_a_column_of_two_sections(spark):
    a = spark.createDataFrame([(1, 1)], "k int, x int")
    with pytest.raises(ValueError, match="x produced by both a and b"):
        merge_sections({"a": a, "b": a}, ["k"])


def test_merge_shuffles_once(spark):
    """Sections that are not partitioned by the key yet meet in one exchange, whatever their number."""
    parts = {f"s{i}": spark.range(9).selectExpr("id AS k", f"id AS v{i}") for i in range(6)}
    plan = merge_sections(parts, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1 and "Join" not in plan


def test_profile_keeps_one_member_at_two_tenants_and_facts_without_member(spark):
    wide = QUERIES["wide_profile"](spark, SF_SMALL)
    known = {(r.tenant_id, r.member_id) for r in B.members(spark, SF_SMALL).select("tenant_id", "member_id").collect()}
    rows = wide.select("ROW_KEY", "tenant_id", "member_id", "has_member_base", "has_member_flag", "has_active_flag",
                       "USER_NAME", "ORDER_NUM").collect()
    alien = [r for r in rows if (r.tenant_id, r.member_id) not in known]
    assert alien and any(r.ORDER_NUM for r in alien)
    assert not any(r.has_member_base or r.has_member_flag or r.has_active_flag or r.USER_NAME for r in alien)
    assert {r.member_id for r in alien} & {m for _, m in known}
    assert len({r.ROW_KEY for r in rows}) == len(rows)


def test_snapshot_of_the_day_only(spark):
    d1, d2 = dt.date(2021, 1, 1), dt.date(2021, 1, 2)
    dim = spark.createDataFrame([("a", 1, "old a", d1), ("b", 1, "b", d1), ("a", 1, "a", d2), ("a", 2, "other", d2)],
                                "code string, tenant_id int, name string, ds_dt date")
    rows = spark.createDataFrame([(1, 5, "a", 2), (1, 5, "b", 1), (2, 5, "a", 1)], "tenant_id int, member_id long, item string, n int")

    def named(day):
        out = top_n_pivot(rows, ["tenant_id", "member_id"], "item", "n", 2, ["c1", "c2"], dim=snapshot(dim, "ds_dt", day),
                          dim_on=["tenant_id"], value_names=["n1", "n2"])
        return {r.tenant_id: (r.c1, r.c2, r.n1, r.n2) for r in out.collect()}
    assert named(d1) == {1: ("a", "b", "old a", "b"), 2: ("a", None, None, None)}
    assert named(d2) == {1: ("a", "b", "a", None), 2: ("a", None, "other", None)}


def test_item_names_change_with_the_as_of_day(spark):
    now = {tuple(r) for r in S.top_items(spark, SF_SMALL).select(*S.KEYS, *S.TOP_NAMES).collect()}
    names = [n for r in now for n in r[2:] if n]
    assert names and not any(n.startswith("former ") for n in names)
    earlier = S.top_items(spark, SF_SMALL, W.EARLIER_ORDER_ASOF).select(*S.TOP_NAMES).collect()
    assert all(n.startswith("former ") for r in earlier for n in r if n)


def _filters(df, table: str) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(rf"FileScan parquet [^\n]*/{table}\.parquet\][^\n]*PushedFilters: (\[[^\n]*?\]), ReadSchema", plan)


@pytest.mark.parametrize("name", ["coupon_recent", "coupon_valid"])
def test_bound_on_the_event_time_reaches_the_scan(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        found = _filters(QUERIES[name](spark, SF_SMALL), "events")
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert len(found) == 1 and "GreaterThanOrEqual(ts,2024-01-10T00:00)" in found[0]


def test_partial_reload_reads_only_its_windows(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    try:
        wide, _ = W.wide_sections(spark, SF_SMALL, names=W.REFRESHED)
        orders, events = _filters(wide, "orders"), _filters(wide, "events")
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert len(orders) == 2 and all("GreaterThanOrEqual(o_orderdate,2000-06-15" in f for f in orders)
    assert len(events) == 1 and "GreaterThanOrEqual(ts,2024-01-10" in events[0]


def test_partial_reload_without_members_reads_no_member_table(spark):
    wide, presence = W.wide_sections(spark, SF_SMALL, names=["recharge_30D"])
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "customer.parquet" not in plan and "lineitem.parquet" not in plan and presence == {"LAST_CHARGE_AMOUNT_30D": "has_recharge_30D"}


def test_amounts_of_any_scale_sum_exactly(spark, tmp_path):
    """Orders whose prices have up to ten decimals next to ordinary ones, through the sections."""
    from decimal import Decimal

    from pyspark.sql import functions as F

    from wideloom.functions.numeric import Amount, exact, is_finer, quick_units, with_limbs
    from wideloom.operators import aggregates as A
    values = [0.004, 0.004, 12.34, -0.005, 1e-10, 123456789.12]
    df = spark.createDataFrame([(1, v) for v in values[:2]] + [(2, v) for v in values] + [(3, None), (4, -0.005)], "k int, x double")
    df = with_limbs(df, 2, is_finer("x", 2), {"x": (quick_units("x", 2), exact("x"))})
    a = Amount.of("x", 2)
    out = A.sectioned_aggregate(df, ["k"], {"s": A.Section((A.amount_sum("t", a), A.amount_pair("p", a, a),
                                                            A.amount_row_sum("r", a, a), A.count_rows("n")))})
    got = {r.k: (r.t, r.p, r.r) for r in out.collect()}
    total = sum(Decimal(repr(v)) for v in values)
    large = spark.createDataFrame([(99999999.9999999,), (20071992547409.91,), (0.07,)], "x double")
    assert [r[0] for r in large.selectExpr(is_finer("x", 2)).collect()] == [True, False, False]
    assert got[1] == (Decimal("0.008"), Decimal("0.016"), Decimal("0.016"))
    assert got[2] == (total, 2 * total, 2 * total) and got[4][0] == Decimal("-0.005")
    assert got[3] == (None, 0, 0)
    assert df.filter("k = 2").filter("x_lo IS NULL").count() == 2  # ordinary amounts have no second limb


@pytest.mark.parametrize("text", ["0.00000000001D", "double('NaN')", "double('Infinity')"])
def test_amounts_finer_than_the_last_limb_are_refused(spark, text):
    from wideloom.functions.numeric import exact, is_finer, quick_units, with_limbs
    df = spark.sql(f"SELECT {text} AS x")
    with pytest.raises(Exception, match="more than 10 decimals"):
        with_limbs(df, 2, is_finer("x", 2), {"x": (quick_units("x", 2), exact("x"))}).collect()


def test_fine_amounts_through_the_profile_and_its_cells(spark, tmp_path):
    from decimal import Decimal
    for t in ("customer", "supplier", "nation", "part", "events"):
        (tmp_path / f"{t}.parquet").symlink_to(f"{SF_SMALL}/{t}.parquet")
    spark.sql("SELECT 1L AS o_orderkey, 20L AS o_custkey, 'P' AS o_orderstatus, 10.004D AS o_totalprice, "
              "TIMESTAMP_NTZ'2001-06-01 00:00:00' AS o_orderdate, '1-URGENT' AS o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("SELECT 1L AS l_orderkey, 5L AS l_partkey, 1L AS l_suppkey, 2D AS l_quantity, p AS l_extendedprice, 0.125D AS l_discount, "
              "0D AS l_tax, 'F' AS l_linestatus FROM VALUES (0.004D), (0.004D), (100D) t(p)").write.parquet(f"{tmp_path}/lineitem.parquet")
    wide, presence = W.wide_sections(spark, str(tmp_path))
    row = wide.filter("member_id = 20 AND has_order_30D").first()
    assert row.LST_ORDER_AMOUNT_30D == Decimal("87.507") and row.LST_ORDER_DISC_30D == Decimal("12.501")
    assert row.ORDER_AMOUNT == Decimal("87.51") and row.TOTAL_CHARGE_AMOUNT == Decimal("11.00")
    assert row.FULL_AVERAGE_PRICE_30D == 0.0
    cells = {r.col: r.value for r in W.profile_cells(wide, presence, 1).filter(f"row_key = '{row.ROW_KEY}'").collect()}
    assert (cells["LST_ORDER_AMOUNT_30D"], cells["LST_ORDER_DISC_30D"]) == ("87.5070", "12.5010")
