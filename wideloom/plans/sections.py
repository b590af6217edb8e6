"""The wide-table sections.

Sections are grouped by the physical source they read.  Each source is
aggregated once per member (``sectioned_aggregate``): the order lines carry
the order lifecycle and the five order windows, the orders table carries the
registration day and the stored-value sections, the activity log carries
points, coupons, message activity and the channel signal.  Only the top-N
item section needs its own (member, item) grain.

Facts are keyed by (tenant, member), as they carry them; rows without either
have no business key and drop out.  Conditions on the member number are those of
the fact row.

The single-section functions at the bottom serve the per-section queries;
``plans.wide_build`` combines the source passes for the full profile.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import Amount
from ..functions.text import not_empty
from ..operators import aggregates as A
from ..operators.aggregates import Section
from ..operators.flags import existence_flag
from ..operators.joins import salted_keys_join, snapshot
from ..operators.topn import top_n_pivot
from ..params import EVENT_ASOF, ORDER_ASOF, AsOf
from ..sources import bindings as B

KEYS = ["tenant_id", "member_id"]
SHOP_SALT_BUCKETS = 16  # spread of one store's members over join tasks


def keyed(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("tenant_id").isNotNull() & F.col("member_id").isNotNull())


def single_section(rows: DataFrame, name: str, sec: Section, prefilter: Column | None = None) -> DataFrame:
    """One section as its own query: keys that have rows in it."""
    out = A.sectioned_aggregate(keyed(rows), KEYS, {name: sec}, prefilter)
    return out.filter(F.col(f"has_{name}")).drop(f"has_{name}")


# -- order lines: lifecycle + windows -------------------------------------------

def slot_lines(spark: SparkSession, d: str, asof: AsOf) -> DataFrame:
    return B.order_lines(spark, d).filter(F.col("time_type") == asof.slot)


ORDER_WINDOWS = ("30D", "90D", "120D", "180D", "360D")


def order_line_sections(asof: AsOf) -> dict[str, Section]:
    date = F.col("orderdate")
    pay, total, plat, shop = (Amount.of(n, 4) for n in ("pay", "total", "platform_discount", "shop_discount"))

    def amount(name: str) -> A.Measure:
        return A.amount_sum(name, pay)

    def discount(name: str) -> A.Measure:
        return A.amount_pair(name, plat, shop)

    life = Section((
        A.min_of("FIRST_ORDER_TIME", date),
        A.max_of("LST_ORDER_TIME", date),
        A.sum_of("ORDER_NUM", F.col("order_num")),
        A.rounded(amount("ORDER_AMOUNT"), 2),
        A.rounded(discount("ORDER_DISCOUNT"), 2),
        A.attr_at_first("FIRST_ORDER_SHOPID", date, F.col("shop_id")),
        A.attr_at_last("LST_ORDER_SHOPID", date, F.col("shop_id")),
        A.days_since_first("FIRST_ORDER_INTRVL", asof, date),
        A.days_since_last("LST_ORDER_INTRVL", asof, date),
    ), F.col("member_no").isNotNull())

    def sums(w: str) -> list[A.Measure]:
        return [A.sum_of(f"LST_ORDER_NUM_{w}", F.col("order_num")),
                amount(f"LST_ORDER_AMOUNT_{w}"),
                discount(f"LST_ORDER_DISC_{w}")]

    def fpa(w: str) -> A.Measure:
        return A.full_price_average(f"FULL_AVERAGE_PRICE_{w}", pay, total)

    plan = {"30D": sums("30D") + [fpa("30D")], "90D": sums("90D") + [fpa("90D")],
            "120D": [fpa("120D")], "180D": sums("180D"), "360D": sums("360D") + [fpa("360D")]}
    return {"order_lifecycle": life, **A.window_sections("orderdate", asof, plan, prefix="order_")}


# decimals that a total is written with at least, as its source amounts have them
AMOUNT_SCALES = ({f"LST_ORDER_{kind}_{w}": 4 for kind in ("AMOUNT", "DISC") for w in ORDER_WINDOWS}
                 | {f"{kind}_POINTS": 2 for kind in ("EXCHANGE", "GET", "EXPIRED", "CLEAR")}
                 | {"ACTIVITIES_POINT_COUNT": 2})


# -- orders table: registration + stored value ---------------------------------

RECHARGE_WINDOWS = ("30D", "90D", "180D", "360D")


def order_table_sections(asof: AsOf) -> dict[str, Section]:
    date = F.col("ds_dt")
    a, b = Amount.of("actual", 3), Amount.of("back", 3)
    recharge = F.col("is_recharge")

    def charged(name: str) -> A.Measure:
        # one null policy for every window: coalesce each part per row
        return A.rounded(A.amount_row_sum(name, a, b), 2)

    life = Section((
        A.min_of("FIRST_CHARGE_TIME", date),
        A.max_of("LAST_CHARGE_TIME", date),
        A.days_since_last("LAST_CHARGE_DAYS", asof, date),
        charged("TOTAL_CHARGE_AMOUNT"),
    ), recharge & not_empty(F.col("member_no")))
    out = {"register": Section((A.min_of("register_time", date),)),
           "recharge_lifecycle": life}
    plan = {w: [charged(f"LAST_CHARGE_AMOUNT_{w}")] for w in RECHARGE_WINDOWS}
    for name, sec in A.window_sections("ds_dt", asof, plan, prefix="recharge_").items():
        out[name] = Section(sec.measures, sec.predicate & recharge, scan=sec.predicate)
    return out


# -- activity log: points, coupons, messages, channel ---------------------------

def event_sections(asof: AsOf) -> dict[str, Section]:
    t, amt = F.col("event_type"), Amount.of("amount", 2)
    recv, used = F.col("received_coupon_cnt"), F.col("used_coupon_cnt")

    def points(name: str, kind: str) -> A.Measure:
        return A.amount_sum(name, amt.where(f"event_type = '{kind}'"))

    def ones(kind: str) -> Column:
        return F.when(t == kind, F.lit(1)).otherwise(F.lit(0)).cast("long")

    recent15 = F.col("ds_dt") >= F.lit(asof.lower_bound("15D"))
    known = F.col("member_no").isNotNull()
    return {
        "points_totals": Section((
            points("EXCHANGE_POINTS", "purchase"), points("GET_POINTS", "click"),
            points("EXPIRED_POINTS", "error"), points("CLEAR_POINTS", "view"),
            A.sum_of("YH_POINTS_COUNT", ones("purchase")), A.sum_of("GET_POINTS_COUNT", ones("click")))),
        "typed_event_total": Section((A.amount_sum("ACTIVITIES_POINT_COUNT", amt),), t == B.POINT_TYPE_WANTED),
        "coupon_lifetime": Section((
            A.sum_of("TOTAL_RECEIVED_COUPON", recv), A.sum_of("TOTAL_USED_COUNPON", used),
            A.pct_of("TOTAL_USED_COUNPON_PERCENT", used, recv))),
        "coupon_recent": Section((
            A.sum_of("LAST_RECEVIED_COUPON_15D", recv), A.sum_of("LAST_USED_COUPON_15D", used),
            A.pct_of("LAST_USED_COUPON_PERCENT_15D", used, recv),
            A.flag_of("LAST_RECEIVED_COUPON_15D_FLG", recv), A.flag_of("LAST_USED_COUPON_15D_FLG", used),
        ), recent15 & known, scan=recent15),
        "coupon_valid": Section((A.count_rows("VALID_COUNPON_CNT"),),
                                (F.col("coupon_status") == B.COUPON_VALID_STATUS) & known
                                # not yet invalid on the day; the bound on the event day reaches the scan
                                & (F.col("ds_dt") >= F.lit(asof.day - dt.timedelta(days=B.COUPON_VALID_DAYS)))),
        # signals used by the member-side sections
        "recent_message": Section((), F.to_date("create_time") >= F.lit(asof.lower_bound("1D"))),
        "channel_signup": Section((), t == B.CHANNEL_WANTED),
    }


# -- top-N items -----------------------------------------------------------------

TOP_CODES = ["LST_ORDITEM_ITEMCODE_1ST_360D", "LST_ORDITEM_ITEMCODE_2ST_360D", "LST_ORDITEM_ITEMCODE_3ST_360D"]
TOP_NAMES = ["LST_ORDITEM_ITEMNAME_1ST_360D", "LST_ORDITEM_ITEMNAME_2ST_360D", "LST_ORDITEM_ITEMNAME_3ST_360D"]


def top_items(spark: SparkSession, d: str, asof: AsOf = ORDER_ASOF) -> DataFrame:
    """The three items a member bought most in 360 days, named as the tenant's snapshot of the
    as-of day names them (null where it lists no such item)."""
    lines = keyed(slot_lines(spark, d, asof)).filter(
        (F.col("orderdate") >= F.lit(asof.day - dt.timedelta(days=360)))
        & F.col("item_code").isNotNull() & (F.col("item_code") != 0))
    return top_n_pivot(lines, KEYS, "item_code", "item_num", 3, TOP_CODES, dim=snapshot(B.items(spark, d), "ds_dt", asof.day),
                       dim_on=["tenant_id"], value_names=TOP_NAMES)


# -- member side -------------------------------------------------------------------

def member_frame(spark: SparkSession, d: str, with_shop: bool = True) -> DataFrame:
    """Members with the shop organisation attached (left join on store and tenant).

    The store code has few distinct values per tenant, so one store can hold a
    large share of all members: the join is salted over the member id
    (``salted_keys_join``) and each salt fetches its shops."""
    m = B.members(spark, d)
    if not with_shop:
        return m.withColumn("org_id", F.lit(None).cast("int")).withColumn("org_name", F.lit(None).cast("string"))
    shop = B.shops(spark, d).withColumnRenamed("code", "store_code")
    return salted_keys_join(m, shop, ["store_code", "tenant_id"], ["member_id"], SHOP_SALT_BUCKETS)


def member_base_pred() -> Column:
    return ((F.col("member_status") != B.INACTIVE_SEGMENT) & (F.col("member_no") != "none")
            & F.col("member_no").isNotNull() & F.col("tenant_id").isNotNull() & F.col("member_id").isNotNull())


def member_flag_pred() -> Column:
    return (F.col("member_no") != "none") & F.col("member_no").isNotNull() & F.col("tenant_id").isNotNull()


def active_flag_pred() -> Column:
    return (F.col("member_status") != B.INACTIVE_SEGMENT) & F.col("tenant_id").isNotNull()


def member_base_columns(asof: AsOf) -> list[Column]:
    """Member-base columns over a member frame carrying ``register_time`` and
    ``has_channel_signup``."""
    day = F.lit(asof.day)
    b = F.col("birthday")
    age = F.floor(F.coalesce(((F.year(day) - F.year(b)) * 12 + F.month(day) - F.month(b)) / F.lit(12),
                             F.lit(0)))
    phone = F.col("phone")
    reg = F.col("register_time")
    return [
        F.col("user_name").alias("USER_NAME"),
        F.col("member_status").alias("MEMBER_STATUS"),
        age.cast("long").alias("AGE"),
        phone.alias("PHONE_NUMBER"),
        F.substring(phone, 1, 3).alias("PHONE_SEGMENT"),
        F.when(not_empty(phone), F.lit("Y")).otherwise(F.lit("N")).alias("PHONE_FLG"),
        b.alias("BIRTHDAY"),
        F.when(F.col("self_regist_flag") == 1, reg).alias("REGISTER_TIME"),
        F.when(reg.isNotNull(), F.datediff(day, reg)).alias("REGISTER_DAYS"),
        F.col("member_no").alias("MEMBER_NO"),
        F.col("store_code").alias("STORE_CODE"),
        F.when(F.coalesce(F.col("has_channel_signup"), F.lit(False)), F.lit("Y")).otherwise(F.lit("N"))
         .alias("IS_ENTER_WECHAT"),
        F.col("org_id").alias("STORE_ORG_ID"),
        F.col("org_name").alias("STORE_ORG_NAME"),
    ]


MEMBER_BASE_COLUMNS = ["USER_NAME", "MEMBER_STATUS", "AGE", "PHONE_NUMBER", "PHONE_SEGMENT", "PHONE_FLG",
                       "BIRTHDAY", "REGISTER_TIME", "REGISTER_DAYS", "MEMBER_NO", "STORE_CODE",
                       "IS_ENTER_WECHAT", "STORE_ORG_ID", "STORE_ORG_NAME"]


#: attributes that member_base passes through: output column, column of the member frame
ATTRIBUTES = [(n, source) for n, source, _, _ in B.MEMBER_ATTRIBUTES]

#: sections whose rows are the member table's
MEMBER_SECTIONS = {"member_base", "member_flag", "active_flag"}


def active_flag_column() -> Column:
    return F.when(F.coalesce(F.col("has_recent_message"), F.lit(False)), F.lit("Y")).otherwise(F.lit("N")) \
        .alias("IS_MP_ACITIVE_USER")


# -- single-section queries --------------------------------------------------------

def member_base(spark: SparkSession, d: str, asof: AsOf = ORDER_ASOF) -> DataFrame:
    m = member_frame(spark, d).filter(member_base_pred())
    reg = single_section(B.order_facts(spark, d), "register", order_table_sections(asof)["register"])
    signup = keyed(B.channels(spark, d)).filter(F.col("channel_no") == B.CHANNEL_WANTED)
    m = existence_flag(m.join(reg, on=KEYS, how="left"), signup, KEYS, "__signup")
    m = m.withColumn("has_channel_signup", F.col("__signup") == "Y")
    return m.select(*KEYS, *member_base_columns(asof), *(F.col(source).alias(n) for n, source in ATTRIBUTES))


def member_flag(spark: SparkSession, d: str) -> DataFrame:
    m = B.members(spark, d).filter(member_flag_pred())
    return m.select(*KEYS, F.col("member_flg").alias("MEMBER_FLG"))


def active_flag(spark: SparkSession, d: str, asof: AsOf = EVENT_ASOF) -> DataFrame:
    m = B.members(spark, d).filter(active_flag_pred()).select(*KEYS)
    recent = keyed(B.message_rows(spark, d)).filter(F.to_date("create_time") >= F.lit(asof.lower_bound("1D")))
    out = existence_flag(m, recent, KEYS, "IS_MP_ACITIVE_USER")
    return out.select(*KEYS, "IS_MP_ACITIVE_USER")


def order_lifecycle(spark: SparkSession, d: str, asof: AsOf = ORDER_ASOF) -> DataFrame:
    sec = order_line_sections(asof)["order_lifecycle"]
    return single_section(slot_lines(spark, d, asof), "order_lifecycle", sec)


def order_windows(spark: SparkSession, d: str, asof: AsOf = ORDER_ASOF) -> DataFrame:
    """The five order windows of one member in one row (NULL where a window is empty)."""
    secs = {k: v for k, v in order_line_sections(asof).items() if k != "order_lifecycle"}
    widest = min(asof.lower_bound(w) for w in ORDER_WINDOWS)
    out = A.sectioned_aggregate(keyed(slot_lines(spark, d, asof)), KEYS, secs,
                                prefilter=F.col("orderdate") >= F.lit(widest))
    return out.drop(*[f"has_{k}" for k in secs])


def full_price_average(spark: SparkSession, d: str, asof: AsOf = ORDER_ASOF) -> DataFrame:
    """All-time full-price average per member, with the count of full-price lines."""
    pay, total = Amount.of("pay", 4), Amount.of("total", 4)
    full = F.expr(A.is_full_price(pay, total))
    sec = Section((A.Measure("FULL_PRICE_LINES", lambda inside: F.count(F.when(inside & full, F.lit(1)))),
                   A.full_price_average("FULL_AVERAGE_PRICE", pay, total)))
    return single_section(slot_lines(spark, d, asof), "fpa", sec)


def _event_section(spark: SparkSession, d: str, name: str, asof: AsOf = EVENT_ASOF) -> DataFrame:
    sec = event_sections(asof)[name]
    return single_section(B.event_facts(spark, d), name, sec, prefilter=sec.predicate)


def points_totals(spark: SparkSession, d: str) -> DataFrame:
    return _event_section(spark, d, "points_totals")


def typed_event_total(spark: SparkSession, d: str) -> DataFrame:
    return _event_section(spark, d, "typed_event_total")


def coupon_lifetime(spark: SparkSession, d: str) -> DataFrame:
    return _event_section(spark, d, "coupon_lifetime")


def coupon_recent(spark: SparkSession, d: str, asof: AsOf = EVENT_ASOF) -> DataFrame:
    return _event_section(spark, d, "coupon_recent", asof)


def coupon_valid(spark: SparkSession, d: str, asof: AsOf = EVENT_ASOF) -> DataFrame:
    return _event_section(spark, d, "coupon_valid", asof)


def recharge_lifecycle(spark: SparkSession, d: str, asof: AsOf = ORDER_ASOF) -> DataFrame:
    sec = order_table_sections(asof)["recharge_lifecycle"]
    return single_section(B.order_facts(spark, d), "recharge_lifecycle", sec,
                          prefilter=F.col("is_recharge"))


def recharge_windows(spark: SparkSession, d: str, asof: AsOf = ORDER_ASOF) -> DataFrame:
    secs = {k: v for k, v in order_table_sections(asof).items() if k.startswith("recharge_") and k != "recharge_lifecycle"}
    widest = min(asof.lower_bound(w) for w in RECHARGE_WINDOWS)
    out = A.sectioned_aggregate(keyed(B.order_facts(spark, d)), KEYS, secs,
                                prefilter=F.col("is_recharge") & (F.col("ds_dt") >= F.lit(widest)))
    return out.drop(*[f"has_{k}" for k in secs])


# Section names of the wide profile, in the load order of the original job.
WIDE_SECTIONS = ["member_base", "member_flag", "order_lifecycle", "order_windows", "top_items",
                 "points_totals", "typed_event_total", "coupon_lifetime", "coupon_recent", "coupon_valid",
                 "recharge_lifecycle", "recharge_windows", "active_flag"]

SECTIONS = {
    "member_base": member_base, "member_flag": member_flag, "order_lifecycle": order_lifecycle,
    "order_windows": order_windows, "top_items": top_items, "points_totals": points_totals,
    "typed_event_total": typed_event_total, "coupon_lifetime": coupon_lifetime,
    "coupon_recent": coupon_recent, "coupon_valid": coupon_valid,
    "recharge_lifecycle": recharge_lifecycle, "recharge_windows": recharge_windows,
    "active_flag": active_flag,
}
