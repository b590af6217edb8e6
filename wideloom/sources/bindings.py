"""Bindings of the customer-360 source tables onto the driver test tables.

The operators take column names as parameters; these functions only rename
and derive columns so that every section reads like the warehouse table it
stands for.  Every fact carries its own business key: the tenant where it
happened, the member and the member number as recorded there.  The test
tables have no such columns, so they are derived from the row: a member's home
tenant from the id, and one fact in eight happened at the next tenant, where
the member table does not know the member.

Money columns are exact amounts in two LONG limbs (``numeric.Amount``), the
scale of the first in its name; sections turn totals back into DECIMAL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import exact, is_finer, quick_units, with_limbs
from .tables import read_table

# Fixed values of the bindings.
INACTIVE_SEGMENT = "MACHINERY"      # member_status '3' (inactive)
CHANNEL_WANTED = "signup"           # channel_no of the enterprise-chat channel
POINT_TYPE_WANTED = "error"         # point_change_type of game deductions
COUPON_VALID_STATUS = "10"
COUPON_VALID_DAYS = 15
RECHARGE_PRIORITY = "1-URGENT"
RECHARGE_BACK_STATUS = "P"
BIRTHDAY_BASE = "1950-01-01"
TENANTS = 25
EARLIER_ITEMS_DAY = dt.date(2001, 3, 15)    # snapshots of the item dimension
ITEMS_DAY = dt.date(2001, 6, 15)


# Attributes that the profile passes through as they are: output column, source column, kind,
# and the SQL that stands for the source column here (the test tables have no such columns).
MEMBER_ATTRIBUTES: list[tuple[str, str, str, str]] = [
    ("APP_INSTANCE_ID", "instance_id", "int", "c_custkey % 3"),
    ("MEMBER_TYPE", "member_type", "int", "c_custkey % 4"),
    ("CHANNEL_CODE", "channel_code", "str", "'CH' || c_nationkey"),
    ("NICK_NAME", "nick_name", "str", "lower(c_name)"),
    ("REAL_NAME", "real_name", "str", "c_name"),
    ("AVATAR", "avatar", "str", "'img/' || c_custkey || '.png'"),
    ("INVITE_CODE", "invite_code", "str", "CASE WHEN c_custkey % 5 = 0 THEN 'INV' || c_custkey END"),
    ("INVITE_NAME", "invite_name", "str", "CASE WHEN c_custkey % 5 = 0 THEN 'Friend ' || c_nationkey ELSE '' END"),
    ("POSITION", "position", "str", "substr(c_mktsegment, 1, 4)"),
    ("COMPANY", "company", "str", "'Company ' || (c_custkey % 50)"),
    ("CONTACT_ADDR", "address", "str", "'Street ' || (c_custkey % 200)"),
    ("PROVINCE", "province", "str", "'Province ' || c_nationkey"),
    ("CITY", "city", "str", "'City ' || (c_nationkey * 10 + c_custkey % 10)"),
    ("DISTRICT", "district", "str", "'District ' || (c_custkey % 7)"),
    ("EMAIL", "email", "str", "CASE WHEN c_custkey % 6 <> 0 THEN lower(c_name) || '@example.com' END"),
    ("GENDER", "sex", "int", "c_custkey % 3"),
    ("INDUSTRY", "industry", "str", "c_mktsegment"),
    ("EDUCATION_LEVEL", "education_level", "int", "c_custkey % 6"),
    ("MARITAL_STATUS", "marital_status", "int", "c_custkey % 2"),
    ("LEVEL", "member_level_define_id", "int", "c_custkey % 5"),
    ("LEVEL_NAME", "level_name", "str", "'L' || (c_custkey % 5)"),
    ("MODEL_NAME", "model_name", "str", "'Model ' || (c_custkey % 2)"),
    ("CUSTOMER_NO", "customer_no", "str", "'C' || c_custkey"),
    ("IS_PAY_MEMBER", "is_pay_member", "int", "CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END"),
    ("IS_GROUP_BUYING", "is_group_buying", "int", "CASE WHEN c_custkey % 4 > 1 THEN 1 END"),
    ("MEMBER_CARD_NO", "member_card_no", "str", "'62' || (1000000 + c_custkey)"),
    ("REFRESH_LEVEL_TIME", "refresh_level_time", "date", "DATE '2020-01-01' + CAST(c_custkey % 500 AS INTEGER)"),
    ("LEVEL_EXPIRATION_TIME", "level_expiration_time", "date", "DATE '2022-01-01' + CAST(c_custkey % 500 AS INTEGER)"),
    ("IS_PREMIUM_MEMBERSHIP", "is_premium_membership", "int", "CASE WHEN c_custkey % 9 = 0 THEN 1 ELSE 0 END"),
    ("STORE_ID", "store_id", "int", "c_custkey % 10 + 100"),
    ("STORE_NAME", "store_name", "str", "'Store ' || (c_custkey % 10)"),
    ("GROWTH_VALUE", "growth_value", "int", "(c_custkey * 13) % 1000"),
    ("MEMBER_ORG_ID", "member_org_id", "int", "c_nationkey"),
    ("MEMBER_ORG_NAME", "member_org_name", "str", "'Org ' || c_nationkey"),
]


def home_tenant(member: str) -> Column:
    """Tenant that a member belongs to."""
    return F.expr(f"CAST(pmod(floor({member} / 10), {TENANTS}) AS INT)")


def fact_tenant(member: str, row: str) -> Column:
    """Tenant where a fact happened."""
    return F.expr(f"CAST(pmod(floor({member} / 10) + CASE WHEN {row} % 8 = 3 THEN 1 ELSE 0 END, {TENANTS}) AS INT)")


def fact_member_no(member: str) -> Column:
    """Member number as a fact records it: null or '' where the channel did not know it."""
    return F.expr(f"CASE WHEN {member} % 17 = 0 THEN NULL WHEN {member} % 13 = 0 THEN '' "
                  f"ELSE concat('M', CAST({member} AS STRING)) END")


def members(spark: SparkSession, d: str) -> DataFrame:
    """Member snapshot (one row per customer)."""
    c = read_table(spark, d, "customer", "c_custkey", "c_name", "c_nationkey",
                   "c_acctbal", "c_mktsegment")
    birthday = F.when(F.col("c_custkey") % 11 == 0, F.lit(None).cast("date")).otherwise(
        F.date_add(F.lit(BIRTHDAY_BASE).cast("date"), ((F.col("c_custkey") * 37) % 18000).cast("int")))
    phone = F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.expr("substr(c_name, 10)"))
    member_no = F.when(F.col("c_custkey") % 19 == 0, F.lit("none")).when(F.col("c_custkey") % 23 != 0, F.col("c_name"))
    return c.select(
        F.col("c_custkey").alias("member_id"),
        home_tenant("c_custkey").alias("tenant_id"),
        member_no.alias("member_no"),
        F.col("c_name").alias("user_name"),
        F.col("c_mktsegment").alias("member_status"),
        (F.col("c_custkey") % 10).alias("store_code"),
        phone.alias("phone"),
        birthday.alias("birthday"),
        (F.col("c_nationkey") % 2).alias("self_regist_flag"),
        F.col("c_mktsegment").alias("member_flg"),
        *(F.expr(f"{sql} AS {source}") for _, source, _, sql in MEMBER_ATTRIBUTES),
    )


def channels(spark: SparkSession, d: str) -> DataFrame:
    """Member channel rows (duplicates kept on purpose)."""
    return event_facts(spark, d).select("tenant_id", "member_id", F.col("event_type").alias("channel_no"))


def shops(spark: SparkSession, d: str) -> DataFrame:
    """Shop dimension: code, tenant, organisation.  ``nation`` has 25 rows by
    definition of the schema, so it is the one side we broadcast explicitly."""
    s = read_table(spark, d, "supplier", "s_suppkey", "s_nationkey")
    n = read_table(spark, d, "nation", "n_nationkey", "n_name", "n_regionkey")
    j = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey, "inner")
    return j.select(F.col("s_suppkey").alias("code"), F.col("s_nationkey").alias("tenant_id"),
                    F.col("n_regionkey").alias("org_id"), F.col("n_name").alias("org_name"))


def order_lines(spark: SparkSession, d: str) -> DataFrame:
    """Order fact at line grain: lineitem joined to its order.

    Amounts are in limbs, the first in 1/10000.  pay = total * (1 - discount); platform discount =
    total * discount; shop discount = total * tax; slot = line status.
    """
    l = read_table(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_quantity",
                   "l_extendedprice", "l_discount", "l_tax", "l_linestatus")
    o = read_table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    j = l.join(o, l.l_orderkey == o.o_orderkey, "inner")
    total, disc, tax = (quick_units(c, 2) for c in ("l_extendedprice", "l_discount", "l_tax"))
    fine = " OR ".join(is_finer(c, 2) for c in ("l_extendedprice", "l_discount", "l_tax"))
    full, rate, tax_rate = exact("l_extendedprice"), exact("l_discount", 14), exact("l_tax", 14)
    j = with_limbs(j, 4, fine, {
        "total": (f"{total} * 100L", full),
        "pay": (f"{total} * (100L - {disc})", f"({full}) * CAST(1 - ({rate}) AS DECIMAL(14,10))"),
        "platform_discount": (f"{total} * {disc}", f"({full}) * ({rate})"),
        "shop_discount": (f"{total} * {tax}", f"({full}) * ({tax_rate})")})
    return j.select(
        fact_tenant("o_custkey", "o_orderkey").alias("tenant_id"),
        F.col("o_custkey").alias("member_id"),
        fact_member_no("o_custkey").alias("member_no"),
        F.to_date("o_orderdate").alias("orderdate"),
        F.lit(1).cast("long").alias("order_num"),
        *(f"{n}_{limb}" for n in ("total", "pay", "platform_discount", "shop_discount") for limb in ("u4", "lo")),
        F.col("l_suppkey").alias("shop_id"),
        F.col("l_partkey").alias("item_code"),
        F.col("l_quantity").alias("item_num"),
        F.col("l_linestatus").alias("time_type"),
    )


def items(spark: SparkSession, d: str) -> DataFrame:
    """Item dimension: code and tenant, a full snapshot a day.  Not every tenant lists every
    item; some items came, went or were renamed between the two snapshots."""
    p = read_table(spark, d, "part", "p_partkey", "p_name")
    snapshots = F.expr(f"""filter(array(
        struct(DATE'{EARLIER_ITEMS_DAY}' AS ds_dt, CASE WHEN p_partkey % 11 <> 1 THEN concat('former ', p_name) END AS name),
        struct(DATE'{ITEMS_DAY}' AS ds_dt, CASE WHEN p_partkey % 11 <> 2 THEN p_name END AS name)),
        x -> x.name IS NOT NULL)""")
    tenants = F.expr(f"filter(sequence(0, {TENANTS - 1}), t -> (t + p_partkey) % 7 <> 0)")
    return p.select("p_partkey", F.explode(snapshots).alias("x"), tenants.alias("tenants")).select(
        F.col("p_partkey").alias("code"), F.explode("tenants").alias("tenant_id"), "x.name", "x.ds_dt")


def _events(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    return read_table(spark, d, "events", *cols)


def event_facts(spark: SparkSession, d: str) -> DataFrame:
    """The user activity log seen as all of its warehouse tables at once.

    Points, point types, coupon receive/use, coupon flow, message log and
    member channel all live in the one ``events`` table of the test data; a
    single binding lets every section over it share one scan and one
    aggregation (see ``plans.sections``).  ``amount`` is the event value,
    its first limb in cents.
    """
    e = _events(spark, d, "event_id", "user_id", "event_type", "value", "ts")
    e = with_limbs(e, 2, is_finer("value", 2), {"amount": (quick_units("value", 2), exact("value"))})
    t = F.col("event_type")
    return e.select(
        fact_tenant("user_id", "event_id").alias("tenant_id"),
        F.col("user_id").alias("member_id"),
        fact_member_no("user_id").alias("member_no"),
        t.alias("event_type"),
        "amount_u2", "amount_lo",
        F.to_date("ts").alias("ds_dt"),
        F.col("ts").alias("create_time"),
        F.when(t == "view", F.lit(1)).otherwise(F.lit(0)).cast("long").alias("received_coupon_cnt"),
        F.when(t == "click", F.lit(1)).otherwise(F.lit(0)).cast("long").alias("used_coupon_cnt"),
        F.when(t == "signup", F.lit(COUPON_VALID_STATUS)).otherwise(F.lit("20")).alias("coupon_status"),
        F.date_add(F.to_date("ts"), COUPON_VALID_DAYS).alias("invalid_date"),
    )


def order_facts(spark: SparkSession, d: str) -> DataFrame:
    """The orders table seen as registration history and stored-value
    recharges (urgent orders; the 10 % bonus exists only for status 'P').
    The first limb is in 1/1000, which holds the bonus of an amount in cents."""
    o = read_table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                   "o_orderpriority")
    cents, fine, paid = quick_units("o_totalprice", 2), is_finer("o_totalprice", 2), exact("o_totalprice")
    has_back = f"o_orderstatus = '{RECHARGE_BACK_STATUS}'"
    o = with_limbs(o, 3, fine, {"actual": (f"{cents} * 10L", paid),
                                # cents * 0.1 = cents in 1/1000
                                "back": (f"CASE WHEN {has_back} THEN {cents} END",
                                         f"CASE WHEN {has_back} THEN ({paid}) * 0.1BD END")})
    return o.select(fact_tenant("o_custkey", "o_orderkey").alias("tenant_id"), F.col("o_custkey").alias("member_id"),
                    fact_member_no("o_custkey").alias("member_no"), F.to_date("o_orderdate").alias("ds_dt"),
                    (F.col("o_orderpriority") == RECHARGE_PRIORITY).alias("is_recharge"),
                    "actual_u3", "actual_lo", "back_u3", "back_lo")


def message_rows(spark: SparkSession, d: str) -> DataFrame:
    return event_facts(spark, d).select("tenant_id", "member_id", "create_time")


def event_documents(spark: SparkSession, d: str) -> DataFrame:
    """Index documents built from events: a JSON text per event with an epoch
    millisecond field, the event payload and a list of small objects (some
    objects lack a key, later objects may repeat it)."""
    from ..functions.dates import epoch_millis_of
    e = _events(spark, d, "event_id", "ts", "user_id", "event_type", "value", "props")
    k = F.get_json_object("props", "$.k").cast("int")
    third = F.when(F.col("value") > 100, F.create_map(F.lit("name"), F.col("props")))\
        .otherwise(F.create_map(F.lit("id"), F.col("event_id").cast("string")))
    facets = F.array(F.create_map(F.lit("name"), F.col("event_type")),
                      F.create_map(F.lit("id"), F.col("user_id").cast("string")),
                      third)
    doc = F.to_json(F.struct(
        epoch_millis_of(F.col("ts")).alias("happened_ms"),
        F.col("event_type").alias("kind"),
        k.alias("k"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("eventtime"),
        facets.alias("facets"),
    ))
    return e.select(F.col("event_id").alias("doc_id"), doc.alias("doc"))


def event_document_lines(spark: SparkSession, d: str) -> DataFrame:
    """The same documents as lines of text files; one event in fifty left a line that was cut off."""
    docs = event_documents(spark, d)
    return docs.select(F.when(F.col("doc_id") % 50 == 7, F.format_string('{"event": %d, "kind', "doc_id"))
                       .otherwise(F.col("doc")).alias("value"))


def conversation_turns(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "conversations", "conv_id", "turn", "role", "text")
    return c
