"""Oracle SQL (DuckDB dialect) for every registered query.

Written from the section semantics, not from the DataFrame code: separate
per-window queries instead of one pass, self-joins for first/last shop,
EXISTS subqueries for flags, full outer join chains instead of the union
merge, UNPIVOT / arg_max for the cells.  Tables are the driver's views.
"""

from __future__ import annotations

import datetime as dt

from .plans.catalog import CATALOG
from .sources.bindings import MEMBER_ATTRIBUTES

ORDER_DAY = dt.date(2001, 6, 15)
EVENT_DAY = dt.date(2024, 1, 25)
EARLIER_ORDER_DAY = dt.date(2001, 3, 15)
EARLIER_EVENT_DAY = dt.date(2024, 1, 15)


def _d(day: dt.date) -> str:
    return f"DATE '{day.isoformat()}'"


def _months_back(day: dt.date, months: int) -> str:
    return f"CAST({_d(day)} - INTERVAL {months} MONTH AS DATE)"


BINDINGS = """
members AS (
  SELECT c_custkey AS member_id, (c_custkey // 10) % 25 AS tenant_id,
         CASE WHEN c_custkey % 19 = 0 THEN 'none' WHEN c_custkey % 23 <> 0 THEN c_name END AS member_no, c_name AS user_name,
         c_mktsegment AS member_status, c_custkey % 10 AS store_code,
         CASE WHEN c_acctbal < 0 THEN '' ELSE substr(c_name, 10) END AS phone,
         CASE WHEN c_custkey % 11 = 0 THEN NULL
              ELSE DATE '1950-01-01' + CAST((c_custkey * 37) % 18000 AS INTEGER) END AS birthday,
         c_nationkey % 2 AS self_regist_flag, c_mktsegment AS member_flg,
         """ + ", ".join(f"{sql} AS {source}" for _, source, _, sql in MEMBER_ATTRIBUTES) + """
  FROM customer),
orders_at AS (
  SELECT *, (o_custkey // 10 + CASE WHEN o_orderkey % 8 = 3 THEN 1 ELSE 0 END) % 25 AS tenant_id, o_custkey AS member_id,
         CASE WHEN o_custkey % 17 = 0 THEN NULL WHEN o_custkey % 13 = 0 THEN '' ELSE 'M' || o_custkey END AS member_no
  FROM orders WHERE o_custkey IS NOT NULL AND o_orderkey IS NOT NULL),
order_lines AS (
  SELECT o.tenant_id, o.member_id, o.member_no, CAST(o.o_orderdate AS DATE) AS orderdate, CAST(1 AS BIGINT) AS order_num,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS total_amount,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(18,2))) AS pay_amount,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(18,2)) AS platform_discount_amount,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_tax AS DECIMAL(18,2)) AS shop_discount_amount,
         l.l_suppkey AS shop_id, l.l_partkey AS item_code, l.l_quantity AS item_num, l.l_linestatus AS time_type
  FROM lineitem l JOIN orders_at o ON l.l_orderkey = o.o_orderkey),
slot_lines AS (SELECT * FROM order_lines WHERE time_type = 'F'),
recharge AS (
  SELECT tenant_id, member_id, member_no, CAST(o_orderdate AS DATE) AS ds_dt,
         CAST(o_totalprice AS DECIMAL(18,2)) AS actual_pay_amt,
         CASE WHEN o_orderstatus = 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.1 AS DECIMAL(1,1)) END AS back_pay_amt
  FROM orders_at WHERE o_orderpriority = '1-URGENT'),
ev AS (
  SELECT (user_id // 10 + CASE WHEN event_id % 8 = 3 THEN 1 ELSE 0 END) % 25 AS tenant_id, user_id AS member_id,
         CASE WHEN user_id % 17 = 0 THEN NULL WHEN user_id % 13 = 0 THEN '' ELSE 'M' || user_id END AS member_no,
         event_type, CAST(value AS DECIMAL(18,2)) AS amount, CAST(ts AS DATE) AS ds_dt,
         CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS received_coupon_cnt,
         CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS used_coupon_cnt
  FROM events WHERE user_id IS NOT NULL AND event_id IS NOT NULL),
shops AS (
  SELECT s.s_suppkey AS code, s.s_nationkey AS tenant_id, n.n_regionkey AS org_id, n.n_name AS org_name
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey),
items AS (
  SELECT p_partkey AS code, t.tenant_id, v.ds_dt, v.name
  FROM part, (SELECT unnest(range(0, 25)) AS tenant_id) t,
       LATERAL (SELECT DATE '2001-03-15' AS ds_dt, CASE WHEN p_partkey % 11 <> 1 THEN 'former ' || p_name END AS name
                UNION ALL SELECT DATE '2001-06-15', CASE WHEN p_partkey % 11 <> 2 THEN p_name END) v
  WHERE v.name IS NOT NULL AND (t.tenant_id + p_partkey) % 7 <> 0)
"""


def _pct(num: str, den: str) -> str:
    """round(100*num/den, 2) half-up as DECIMAL(20,2); 0 when den = 0."""
    return (f"CAST(CASE WHEN {den} = 0 THEN 0 ELSE (20000 * ({num}) + ({den})) // (2 * ({den})) END "
            f"AS DECIMAL(20,0)) * CAST(0.01 AS DECIMAL(2,2))")


FULL = "NOT COALESCE(pay_amount < total_amount, FALSE)"


def _fpa() -> str:
    return (f"CASE WHEN count(*) FILTER (WHERE {FULL}) > 0 THEN "
            f"CAST(COALESCE(sum(pay_amount) FILTER (WHERE {FULL}), 0) AS DOUBLE) / count(*) FILTER (WHERE {FULL}) "
            f"ELSE 0 END")


# ---------------------------------------------------------------------------
# Typed section relations: (tenant_id, member_id, typed measures...).  The
# same SQL serves the per-section queries (after presentation casts) and the
# wide/cells/export oracles.
# ---------------------------------------------------------------------------

def order_window_sql(day: dt.date, months: int, w: str, sums: bool, fpa: bool) -> str:
    cols = []
    if sums:
        cols += [f"sum(order_num) AS LST_ORDER_NUM_{w}", f"sum(pay_amount) AS LST_ORDER_AMOUNT_{w}",
                 f"COALESCE(sum(platform_discount_amount), 0) + COALESCE(sum(shop_discount_amount), 0) AS LST_ORDER_DISC_{w}"]
    if fpa:
        cols.append(f"{_fpa()} AS FULL_AVERAGE_PRICE_{w}")
    return (f"SELECT tenant_id, member_id, {', '.join(cols)} FROM slot_lines "
            f"WHERE orderdate >= {_months_back(day, months)} GROUP BY tenant_id, member_id")


ORDER_WINDOW_SPECS = [("30D", 1, True, True), ("90D", 3, True, True), ("120D", 4, False, True),
                      ("180D", 6, True, False), ("360D", 12, True, True)]
RECHARGE_WINDOW_SPECS = [("30D", 1), ("90D", 3), ("180D", 6), ("360D", 12)]


def recharge_window_sql(day: dt.date, months: int, w: str) -> str:
    return (f"SELECT tenant_id, member_id, "
            f"round(sum(COALESCE(actual_pay_amt, 0) + COALESCE(back_pay_amt, 0)), 2) AS LAST_CHARGE_AMOUNT_{w} "
            f"FROM recharge WHERE ds_dt >= {_months_back(day, months)} "
            f"GROUP BY tenant_id, member_id")


def section_sql(order_day: dt.date = ORDER_DAY, event_day: dt.date = EVENT_DAY) -> dict[str, str]:
    od, ed = _d(order_day), _d(event_day)
    out: dict[str, str] = {}
    out["member_base"] = f"""
      SELECT m.tenant_id, m.member_id, m.user_name AS USER_NAME, m.member_status AS MEMBER_STATUS,
             CAST(floor(COALESCE(((year({od}) - year(m.birthday)) * 12 + month({od}) - month(m.birthday)) / 12, 0)) AS BIGINT) AS AGE,
             m.phone AS PHONE_NUMBER, substr(m.phone, 1, 3) AS PHONE_SEGMENT,
             CASE WHEN m.phone IS NOT NULL AND m.phone <> '' THEN 'Y' ELSE 'N' END AS PHONE_FLG,
             m.birthday AS BIRTHDAY,
             CASE WHEN m.self_regist_flag = 1 THEN r.reg END AS REGISTER_TIME,
             CASE WHEN r.reg IS NOT NULL THEN date_diff('day', r.reg, {od}) END AS REGISTER_DAYS,
             m.member_no AS MEMBER_NO, m.store_code AS STORE_CODE,
             CASE WHEN EXISTS (SELECT 1 FROM ev e WHERE e.tenant_id = m.tenant_id AND e.member_id = m.member_id
                               AND e.event_type = 'signup')
                  THEN 'Y' ELSE 'N' END AS IS_ENTER_WECHAT,
             sh.org_id AS STORE_ORG_ID, sh.org_name AS STORE_ORG_NAME,
             {", ".join(f"m.{source} AS {n}" for n, source, _, _ in MEMBER_ATTRIBUTES)}
      FROM members m
      LEFT JOIN (SELECT tenant_id, member_id, min(CAST(o_orderdate AS DATE)) AS reg FROM orders_at GROUP BY tenant_id, member_id) r
        ON r.member_id = m.member_id AND r.tenant_id = m.tenant_id
      LEFT JOIN shops sh ON sh.code = m.store_code AND sh.tenant_id = m.tenant_id
      WHERE m.member_status <> 'MACHINERY' AND m.member_no <> 'none' AND m.member_no IS NOT NULL
        AND m.tenant_id IS NOT NULL AND m.member_id IS NOT NULL"""
    out["member_flag"] = """
      SELECT tenant_id, member_id, member_flg AS MEMBER_FLG FROM members
      WHERE member_no <> 'none' AND member_no IS NOT NULL AND tenant_id IS NOT NULL"""
    out["active_flag"] = f"""
      SELECT m.tenant_id, m.member_id,
             CASE WHEN EXISTS (SELECT 1 FROM ev e WHERE e.tenant_id = m.tenant_id AND e.member_id = m.member_id
                               AND e.ds_dt >= {ed} - 1) THEN 'Y' ELSE 'N' END AS IS_MP_ACITIVE_USER
      FROM members m WHERE m.member_status <> 'MACHINERY' AND m.tenant_id IS NOT NULL"""
    out["order_lifecycle"] = f"""
      WITH n AS (SELECT * FROM slot_lines WHERE member_no IS NOT NULL),
           t AS (SELECT tenant_id, member_id, min(orderdate) AS f, max(orderdate) AS l, sum(order_num) AS n,
                        round(sum(pay_amount), 2) AS amt,
                        round(COALESCE(sum(platform_discount_amount), 0) + COALESCE(sum(shop_discount_amount), 0), 2) AS disc
                 FROM n GROUP BY tenant_id, member_id),
           fs AS (SELECT t.tenant_id, t.member_id, min(s.shop_id) AS shop FROM t JOIN n s
                    ON s.tenant_id = t.tenant_id AND s.member_id = t.member_id AND s.orderdate = t.f GROUP BY ALL),
           ls AS (SELECT t.tenant_id, t.member_id, max(s.shop_id) AS shop FROM t JOIN n s
                    ON s.tenant_id = t.tenant_id AND s.member_id = t.member_id AND s.orderdate = t.l GROUP BY ALL)
      SELECT tenant_id, member_id, t.f AS FIRST_ORDER_TIME, t.l AS LST_ORDER_TIME, t.n AS ORDER_NUM,
             t.amt AS ORDER_AMOUNT, t.disc AS ORDER_DISCOUNT, fs.shop AS FIRST_ORDER_SHOPID,
             ls.shop AS LST_ORDER_SHOPID, date_diff('day', t.f, {od}) AS FIRST_ORDER_INTRVL,
             date_diff('day', t.l, {od}) AS LST_ORDER_INTRVL
      FROM t JOIN fs USING (tenant_id, member_id) JOIN ls USING (tenant_id, member_id)"""
    for w, months, sums, fpa in ORDER_WINDOW_SPECS:
        out[f"order_{w}"] = order_window_sql(order_day, months, w, sums, fpa)
    out["top_items"] = f"""
      WITH q AS (SELECT tenant_id, member_id, item_code, sum(item_num) AS qty FROM slot_lines
                 WHERE orderdate >= {od} - 360 AND item_code IS NOT NULL AND item_code <> 0
                 GROUP BY tenant_id, member_id, item_code),
           r AS (SELECT *, row_number() OVER (PARTITION BY tenant_id, member_id ORDER BY qty DESC, item_code ASC) AS rn FROM q),
           t AS (SELECT r.tenant_id, r.member_id, r.rn, r.item_code, p.name AS p_name FROM r
                 LEFT JOIN items p ON p.code = r.item_code AND p.tenant_id = r.tenant_id AND p.ds_dt = {od}
                 WHERE r.rn <= 3)
      SELECT tenant_id, member_id,
             max(CASE WHEN rn = 1 THEN item_code END) AS LST_ORDITEM_ITEMCODE_1ST_360D,
             max(CASE WHEN rn = 2 THEN item_code END) AS LST_ORDITEM_ITEMCODE_2ST_360D,
             max(CASE WHEN rn = 3 THEN item_code END) AS LST_ORDITEM_ITEMCODE_3ST_360D,
             max(CASE WHEN rn = 1 THEN p_name END) AS LST_ORDITEM_ITEMNAME_1ST_360D,
             max(CASE WHEN rn = 2 THEN p_name END) AS LST_ORDITEM_ITEMNAME_2ST_360D,
             max(CASE WHEN rn = 3 THEN p_name END) AS LST_ORDITEM_ITEMNAME_3ST_360D
      FROM t GROUP BY tenant_id, member_id"""
    out["points_totals"] = """
      SELECT tenant_id, member_id,
             sum(CASE WHEN event_type = 'purchase' THEN amount ELSE 0 END) AS EXCHANGE_POINTS,
             sum(CASE WHEN event_type = 'click' THEN amount ELSE 0 END) AS GET_POINTS,
             sum(CASE WHEN event_type = 'error' THEN amount ELSE 0 END) AS EXPIRED_POINTS,
             sum(CASE WHEN event_type = 'view' THEN amount ELSE 0 END) AS CLEAR_POINTS,
             sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS YH_POINTS_COUNT,
             sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS GET_POINTS_COUNT
      FROM ev GROUP BY tenant_id, member_id"""
    out["typed_event_total"] = """
      SELECT tenant_id, member_id, sum(amount) AS ACTIVITIES_POINT_COUNT
      FROM ev WHERE event_type = 'error' GROUP BY tenant_id, member_id"""
    out["coupon_lifetime"] = f"""
      SELECT tenant_id, member_id, sum(received_coupon_cnt) AS TOTAL_RECEIVED_COUPON,
             sum(used_coupon_cnt) AS TOTAL_USED_COUNPON,
             {_pct('sum(used_coupon_cnt)', 'sum(received_coupon_cnt)')} AS TOTAL_USED_COUNPON_PERCENT
      FROM ev GROUP BY tenant_id, member_id"""
    out["coupon_recent"] = f"""
      SELECT tenant_id, member_id, rcv AS LAST_RECEVIED_COUPON_15D, usd AS LAST_USED_COUPON_15D,
             {_pct('usd', 'rcv')} AS LAST_USED_COUPON_PERCENT_15D,
             CASE WHEN rcv > 0 THEN 'Y' ELSE 'N' END AS LAST_RECEIVED_COUPON_15D_FLG,
             CASE WHEN usd > 0 THEN 'Y' ELSE 'N' END AS LAST_USED_COUPON_15D_FLG
      FROM (SELECT tenant_id, member_id, sum(received_coupon_cnt) AS rcv, sum(used_coupon_cnt) AS usd
            FROM ev WHERE member_no IS NOT NULL AND ds_dt >= {ed} - 15
            GROUP BY tenant_id, member_id)"""
    out["coupon_valid"] = f"""
      SELECT tenant_id, member_id, count(*) AS VALID_COUNPON_CNT
      FROM ev
      WHERE member_no IS NOT NULL AND event_type = 'signup' AND ds_dt + 15 >= {ed} GROUP BY tenant_id, member_id"""
    out["recharge_lifecycle"] = f"""
      SELECT tenant_id, member_id, min(ds_dt) AS FIRST_CHARGE_TIME, max(ds_dt) AS LAST_CHARGE_TIME,
             date_diff('day', max(ds_dt), {od}) AS LAST_CHARGE_DAYS,
             round(sum(COALESCE(actual_pay_amt, 0) + COALESCE(back_pay_amt, 0)), 2) AS TOTAL_CHARGE_AMOUNT
      FROM recharge WHERE member_no IS NOT NULL AND member_no <> '' GROUP BY tenant_id, member_id"""
    for w, months in RECHARGE_WINDOW_SPECS:
        out[f"recharge_{w}"] = recharge_window_sql(order_day, months, w)
    return out


# Section -> ordered (column, kind) with kind in str/int/dec/dbl/date/ymd: the
# DuckDB type family of each typed column, used for presentation and cells.
SECTION_COLUMNS: dict[str, list[tuple[str, str]]] = {
    "member_base": [("USER_NAME", "str"), ("MEMBER_STATUS", "str"), ("AGE", "int"), ("PHONE_NUMBER", "str"),
                    ("PHONE_SEGMENT", "str"), ("PHONE_FLG", "str"), ("BIRTHDAY", "date"),
                    ("REGISTER_TIME", "date"), ("REGISTER_DAYS", "int"), ("MEMBER_NO", "str"),
                    ("STORE_CODE", "int"), ("IS_ENTER_WECHAT", "str"), ("STORE_ORG_ID", "int"),
                    ("STORE_ORG_NAME", "str"), *((n, kind) for n, _, kind, _ in MEMBER_ATTRIBUTES)],
    "member_flag": [("MEMBER_FLG", "str")],
    "order_lifecycle": [("FIRST_ORDER_TIME", "ymd"), ("LST_ORDER_TIME", "ymd"), ("ORDER_NUM", "int"),
                        ("ORDER_AMOUNT", "dec"), ("ORDER_DISCOUNT", "dec"), ("FIRST_ORDER_SHOPID", "int"),
                        ("LST_ORDER_SHOPID", "int"), ("FIRST_ORDER_INTRVL", "int"), ("LST_ORDER_INTRVL", "int")],
    "top_items": [(f"LST_ORDITEM_ITEMCODE_{i}ST_360D", "int") for i in (1, 2, 3)]
                 + [(f"LST_ORDITEM_ITEMNAME_{i}ST_360D", "str") for i in (1, 2, 3)],
    "points_totals": [("EXCHANGE_POINTS", "dec"), ("GET_POINTS", "dec"), ("EXPIRED_POINTS", "dec"),
                      ("CLEAR_POINTS", "dec"), ("YH_POINTS_COUNT", "int"), ("GET_POINTS_COUNT", "int")],
    "typed_event_total": [("ACTIVITIES_POINT_COUNT", "dec")],
    "coupon_lifetime": [("TOTAL_RECEIVED_COUPON", "int"), ("TOTAL_USED_COUNPON", "int"),
                        ("TOTAL_USED_COUNPON_PERCENT", "dec")],
    "coupon_recent": [("LAST_RECEVIED_COUPON_15D", "int"), ("LAST_USED_COUPON_15D", "int"),
                      ("LAST_USED_COUPON_PERCENT_15D", "dec"), ("LAST_RECEIVED_COUPON_15D_FLG", "str"),
                      ("LAST_USED_COUPON_15D_FLG", "str")],
    "coupon_valid": [("VALID_COUNPON_CNT", "int")],
    "recharge_lifecycle": [("FIRST_CHARGE_TIME", "ymd"), ("LAST_CHARGE_TIME", "ymd"), ("LAST_CHARGE_DAYS", "int"),
                           ("TOTAL_CHARGE_AMOUNT", "dec")],
    "active_flag": [("IS_MP_ACITIVE_USER", "str")],
}
for _w, _m, _s, _f in ORDER_WINDOW_SPECS:
    SECTION_COLUMNS[f"order_{_w}"] = (
        ([(f"LST_ORDER_NUM_{_w}", "int"), (f"LST_ORDER_AMOUNT_{_w}", "dec"), (f"LST_ORDER_DISC_{_w}", "dec")] if _s else [])
        + ([(f"FULL_AVERAGE_PRICE_{_w}", "dbl")] if _f else []))
for _w, _m in RECHARGE_WINDOW_SPECS:
    SECTION_COLUMNS[f"recharge_{_w}"] = [(f"LAST_CHARGE_AMOUNT_{_w}", "dec")]

WIDE_ORDER = ["member_base", "member_flag", "order_lifecycle", "order_30D", "order_90D", "order_120D",
              "order_180D", "order_360D", "top_items", "points_totals", "typed_event_total", "coupon_lifetime",
              "coupon_recent", "coupon_valid", "recharge_lifecycle", "recharge_30D", "recharge_90D",
              "recharge_180D", "recharge_360D", "active_flag"]


def plain(col: str, kind: str) -> str:
    """Presentation cast of a typed column (DECIMAL->DOUBLE, DATE->text,
    integral measures->DOUBLE; identifiers stay BIGINT, see to_plain)."""
    if kind == "dec":
        return f"CAST({col} AS DOUBLE)"
    if kind in ("date", "ymd"):
        return f"CAST({col} AS VARCHAR)"
    if kind == "int":
        return f"CAST({col} AS DOUBLE)"
    return col


def cell_text(col: str, kind: str) -> str:
    if kind in ("int", "dec", "dbl"):
        return f"CAST({col} AS VARCHAR)"
    if kind == "date":
        return f"strftime({col}, '%Y-%m-%d')"
    if kind == "ymd":
        return f"strftime({col}, '%Y%m%d')"
    return col


def _with(body: str, extra: str = "") -> str:
    return "WITH " + BINDINGS.strip() + (",\n" + extra if extra else "") + "\n" + body


def _plain_select(rel: str, cols: list[tuple[str, str]]) -> str:
    sel = ", ".join(f"{plain(c, k)} AS {c}" for c, k in cols)
    return f"SELECT CAST(tenant_id AS BIGINT) AS tenant_id, CAST(member_id AS BIGINT) AS member_id, {sel} FROM {rel}"


def single_section_query(name: str) -> str:
    secs = section_sql()
    return _with(_plain_select("s", SECTION_COLUMNS[name]), f"s AS ({secs[name]})")


def windows_query(prefix: str, windows: list[str]) -> str:
    secs = section_sql()
    widest = f"{prefix}{windows[-1]}"
    ctes = ",\n".join(f"{prefix}{w} AS ({secs[prefix + w]})" for w in windows)
    cols = [c for w in windows for c in SECTION_COLUMNS[prefix + w]]
    joins = " ".join(f"LEFT JOIN {prefix}{w} USING (tenant_id, member_id)" for w in windows if prefix + w != widest)
    body = f"SELECT * FROM {widest} {joins}"
    return _with(_plain_select(f"({body})", cols), ctes)


def wide_relation(order_day: dt.date, event_day: dt.date, names: list[str] | None = None, tag: str = "") -> tuple[str, str]:
    """(CTE text, select body) of the merged wide profile with has_ flags, typed."""
    secs = section_sql(order_day, event_day)
    names = names or WIDE_ORDER
    ctes = ",\n".join(f"{tag}{n} AS (SELECT *, TRUE AS has_{n} FROM ({secs[n]}))" for n in names)
    first = names[0]
    joins = " ".join(f"FULL OUTER JOIN {tag}{n} USING (tenant_id, member_id)" for n in names[1:])
    cols = []
    for n in names:
        cols.append(f"COALESCE(has_{n}, FALSE) AS has_{n}")
        cols += [c for c, _ in SECTION_COLUMNS[n]]
    body = (f"SELECT tenant_id, member_id, CAST(tenant_id AS VARCHAR) || '_' || CAST(member_id AS VARCHAR) AS ROW_KEY, "
            f"{', '.join(cols)} FROM {tag}{first} {joins}")
    return ctes, body


def wide_profile_query() -> str:
    ctes, body = wide_relation(ORDER_DAY, EVENT_DAY)
    cols = []
    for n in WIDE_ORDER:
        cols.append(f"has_{n}")
        cols += [f"{plain(c, k)} AS {c}" for c, k in SECTION_COLUMNS[n]]
    return _with(f"SELECT CAST(tenant_id AS BIGINT) AS tenant_id, CAST(member_id AS BIGINT) AS member_id, ROW_KEY, "
                 f"{', '.join(cols)} FROM ({body})", ctes)


def cells_relation(order_day: dt.date, event_day: dt.date, ts: int, names: list[str] | None = None,
                   tag: str = "") -> tuple[str, str]:
    names = names or WIDE_ORDER
    ctes, body = wide_relation(order_day, event_day, names, tag)
    texts = []
    if "member_base" in names:
        texts += ["CASE WHEN has_member_base THEN CAST(member_id AS VARCHAR) END AS MEMBER_ID",
                  "CASE WHEN has_member_base THEN CAST(tenant_id AS VARCHAR) END AS TENANT_ID"]
    fam = {c.name: c.cf for c in CATALOG}
    names_out = ["MEMBER_ID", "TENANT_ID"] if "member_base" in names else []
    for n in names:
        for c, k in SECTION_COLUMNS[n]:
            texts.append(f"CASE WHEN has_{n} THEN COALESCE({cell_text(c, k)}, '') END AS {c}")
            names_out.append(c)
    staged = f"SELECT ROW_KEY, {', '.join(texts)} FROM ({body}) WHERE ROW_KEY IS NOT NULL"
    fam_case = "CASE col " + " ".join(f"WHEN '{c}' THEN '{fam[c]}'" for c in names_out) + " END"
    cells = (f"SELECT ROW_KEY AS row_key, {fam_case} AS cf, col, CAST({ts} AS BIGINT) AS ts, value FROM "
             f"(UNPIVOT ({staged}) ON {', '.join(names_out)} INTO NAME col VALUE value)")
    return ctes, cells


TS_FIRST, TS_SECOND = 1000, 2000
REFRESHED = ["order_30D", "order_90D", "order_120D", "order_180D", "order_360D",
             "recharge_30D", "recharge_90D", "recharge_180D", "recharge_360D", "coupon_recent", "active_flag"]


CORRECTED = ["coupon_recent", "order_30D", "member_flag"]


def wide_to_cells_query() -> str:
    ctes, cells = cells_relation(ORDER_DAY, EVENT_DAY, TS_SECOND)
    return _with(cells, ctes)


def cells_sorted_query() -> str:
    ctes, cells = cells_relation(ORDER_DAY, EVENT_DAY, TS_SECOND)
    return _with("SELECT row_key, cf, col, value, row_number() OVER (PARTITION BY row_key ORDER BY cf, col) AS pos "
                 f"FROM ({cells})", ctes)


def _upserted() -> tuple[str, str]:
    c1, first = cells_relation(EARLIER_ORDER_DAY, EARLIER_EVENT_DAY, TS_FIRST, tag="a_")
    c2, second = cells_relation(ORDER_DAY, EVENT_DAY, TS_SECOND, REFRESHED, tag="b_")
    body = (f"SELECT row_key, cf, col, max(ts) AS ts, arg_max(value, ts) AS value FROM "
            f"({first} UNION ALL {second}) GROUP BY row_key, cf, col")
    return c1 + ",\n" + c2, body


def cells_upsert_query() -> str:
    ctes, body = _upserted()
    return _with(body, ctes)


def _cells_to_wide_body() -> tuple[str, str]:
    ctes, up = _upserted()
    cols = ", ".join(f"arg_max(value, ts) FILTER (WHERE cf = '{c.cf}' AND col = '{c.name}') AS {c.name}"
                     for c in CATALOG if c.cf != "rowkey")
    return ctes, f"SELECT row_key AS ROW_KEY, {cols} FROM ({up}) GROUP BY row_key"


def cells_to_wide_query() -> str:
    ctes, body = _cells_to_wide_body()
    return _with(body, ctes)


def _typed_expr(name: str, kind: str, zero: bool) -> str:
    t = f"NULLIF({name}, '')"
    if kind == "string":
        e = name
    elif kind in ("tinyint", "int"):
        target = "TINYINT" if kind == "tinyint" else "INTEGER"
        e = f"TRY_CAST(trunc(TRY_CAST({t} AS DECIMAL(38,10))) AS {target})"
    elif kind == "double":
        e = f"TRY_CAST({t} AS DOUBLE)"
    elif kind == "date":
        e = f"TRY_CAST({t} AS DATE)"
    else:  # ymd
        e = f"strftime(TRY_STRPTIME({t}, '%Y%m%d'), '%Y-%m-%d')"
    if zero:
        e = f"COALESCE({e}, 0)"
    return e


def _export_expr(name: str, kind: str, zero: bool) -> str:
    e = _typed_expr(name, kind, zero)
    # presentation: integral measures as DOUBLE, dates as text
    if kind in ("tinyint", "int"):
        e = f"CAST({e} AS DOUBLE)"
    elif kind == "date":
        e = f"CAST({e} AS VARCHAR)"
    return f"{e} AS {name}"


def typed_export_query() -> str:
    ctes, body = _cells_to_wide_body()
    sel = ", ".join(_export_expr(c.name, c.kind, c.default_zero) for c in CATALOG)
    return _with(f"SELECT {sel} FROM ({body})", ctes)


DUCK_TYPES = ("CASE typeof({c}) WHEN 'TINYINT' THEN 'tinyint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
              "WHEN 'DATE' THEN 'date' WHEN 'VARCHAR' THEN 'string' END")


def typed_export_cells_query() -> str:
    """Each exported value with the column's place, name and type, from the types themselves."""
    ctes, body = _cells_to_wide_body()
    typed = ", ".join(f"{_typed_expr(c.name, c.kind, c.default_zero)} AS {c.name}" for c in CATALOG)
    structs = []
    for i, c in enumerate(CATALOG, 1):
        double = c.kind == "double"
        structs.append(f"{{'pos': {i}, 'name': '{c.name}', 'type': {DUCK_TYPES.format(c=c.name)}, "
                       f"'text': {'NULL' if double else f'CAST({c.name} AS VARCHAR)'}, "
                       f"'number': {c.name if double else 'CAST(NULL AS DOUBLE)'}}}")
    return _with(f"SELECT ROW_KEY, CAST(x.pos AS BIGINT) AS pos, x.name AS name, x.type AS type, x.text AS text, "
                 f"x.number AS number FROM (SELECT ROW_KEY, unnest([{', '.join(structs)}]) AS x "
                 f"FROM (SELECT {typed} FROM ({body})))", ctes)


def store_export_query() -> str:
    """Three loads, the last one late: its as-of day lies before the second's and its ts is equal,
    so the load number decides."""
    c1, first = cells_relation(EARLIER_ORDER_DAY, EARLIER_EVENT_DAY, TS_FIRST, tag="a_")
    c2, second = cells_relation(ORDER_DAY, EVENT_DAY, TS_SECOND, REFRESHED, tag="b_")
    c3, third = cells_relation(EARLIER_ORDER_DAY, EARLIER_EVENT_DAY, TS_SECOND, CORRECTED, tag="c_")
    loads = " UNION ALL ".join(f"SELECT *, {n} AS load FROM ({x})" for n, x in enumerate((first, second, third), 1))
    newest = (f"SELECT row_key, cf, col, value FROM (SELECT *, row_number() OVER (PARTITION BY row_key, cf, col "
              f"ORDER BY ts DESC, load DESC) AS rn FROM ({loads})) WHERE rn = 1")
    cols = ", ".join(f"max(value) FILTER (WHERE cf = '{c.cf}' AND col = '{c.name}') AS {c.name}"
                     for c in CATALOG if c.cf != "rowkey")
    sel = ", ".join(_export_expr(c.name, c.kind, c.default_zero) for c in CATALOG)
    return _with(f"SELECT {sel} FROM (SELECT row_key AS ROW_KEY, {cols} FROM ({newest}) GROUP BY row_key)",
                 ",\n".join((c1, c2, c3)))


# -- documents, calendar, bounds ------------------------------------------------

DOC_PROJECT = """
SELECT event_id AS doc_id, CAST(epoch_us(ts) // 1000 AS DOUBLE) AS happened_ms,
       CASE WHEN value > 100 THEN props ELSE event_type END AS name,
       CAST(CAST(json_extract(props, '$.k') AS INTEGER) AS DOUBLE) AS k,
       event_type AS kind, strftime(ts, '%Y-%m-%d') AS dt
FROM events"""

DOC_PARTITION = """
SELECT event_id AS doc_id, strftime(ts, '%Y-%m-%d') AS PART_FROM_MILLIS, strftime(ts, '%Y-%m-%d %H') AS PART_HOUR,
       strftime(ts, '%Y%m%d') AS PART_FROM_TEXT,
       CAST((epoch_us(ts) // 1000000 - 8 * 3600) * 1000 AS DOUBLE) AS MILLIS_FROM_TEXT
FROM events"""

DOC_LOAD = f"""
SELECT happened_ms, name, k, kind, dt, NULL AS unreadable FROM ({DOC_PROJECT}) WHERE doc_id % 50 <> 7
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, '{{"event": ' || event_id || ', "kind' FROM events WHERE event_id % 50 = 7"""

DOC_APPEND = f"SELECT doc_id, kind AS label, k AS amount, dt AS day FROM ({DOC_PROJECT})"

TABLE_REPLACED = f"""
SELECT doc_id, upper(kind) AS label, k * 10 AS amount, substr(dt, 1, 7) AS day
FROM ({DOC_PROJECT}) WHERE CAST(k AS BIGINT) % 2 = 0"""

DOC_LIST_LAST = """
SELECT conv_id, CAST(n AS DOUBLE) AS N_ITEMS, role AS LAST_ROLE, text AS LAST_TEXT
FROM (SELECT *, count(*) OVER (PARTITION BY conv_id) AS n,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST) AS back FROM conversations)
WHERE back = 1"""

ASOF_BOUNDS = """
SELECT CAST(d AS VARCHAR) AS AS_OF, CAST(d - 1 AS VARCHAR) AS BOUND_1D, CAST(d - 15 AS VARCHAR) AS BOUND_15D,
       CAST(CAST(d - INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS BOUND_30D,
       CAST(CAST(d - INTERVAL 3 MONTH AS DATE) AS VARCHAR) AS BOUND_90D,
       CAST(CAST(d - INTERVAL 4 MONTH AS DATE) AS VARCHAR) AS BOUND_120D,
       CAST(CAST(d - INTERVAL 6 MONTH AS DATE) AS VARCHAR) AS BOUND_180D,
       CAST(CAST(d - INTERVAL 1 YEAR AS DATE) AS VARCHAR) AS BOUND_360D,
       strftime(d - INTERVAL 1 MONTH, '%Y%m') AS MONTH_OF_30D,
       strftime(d - INTERVAL 1 YEAR, '%Y') AS YEAR_OF_360D
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)"""

_DAYS = """(SELECT CAST(g.generate_series AS DATE) AS d FROM
   (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders) b,
   generate_series(b.lo, b.hi, INTERVAL 1 DAY) g)"""

_WEEKDAY = ("CASE isodow(d) WHEN 1 THEN '星期一' WHEN 2 THEN '星期二' WHEN 3 THEN '星期三' WHEN 4 THEN '星期四' "
            "WHEN 5 THEN '星期五' WHEN 6 THEN '星期六' WHEN 7 THEN '星期日' END")

# Monday-first week 0-53 (first week with four days = week 1), plus one,
# derived from the ISO week: early-January days of the previous ISO year are
# week 0, late-December days of the next ISO year continue this year's count.
_MODE1 = ("(CASE WHEN isoyear(d) < year(d) THEN 0 WHEN isoyear(d) > year(d) THEN week(d - 7) + 1 "
          "ELSE week(d) END) + 1")

DATE_DIM_BY_COUNT = f"""
SELECT strftime(d, '%Y-%m-%d') AS cdate, strftime(d, '%Y') || '年' || strftime(d, '%m') || '月' || strftime(d, '%d') || '日' AS date_name,
       strftime(d, '%Y') AS cyear, strftime(d, '%Y') || '年' AS year_name, CAST(quarter(d) AS DOUBLE) AS cquarter,
       strftime(d, '%Y') || '年' || quarter(d) || '季度' AS quarter_name, strftime(d, '%m') AS cmonth,
       strftime(d, '%Y') || '年' || strftime(d, '%m') || '月' AS month_name,
       CAST({_MODE1} AS DOUBLE) AS cweek, '第' || ({_MODE1}) || '周' AS week_name,
       CAST(isodow(d) AS VARCHAR) AS week_day, {_WEEKDAY} AS week_day_name
FROM {_DAYS}"""

DATE_DIM_BY_RANGE = f"""
SELECT strftime(d, '%Y-%m-%d') AS cdate, strftime(d, '%Y') || '年' || month(d) || '月' || day(d) || '日' AS date_name,
       strftime(d, '%Y') AS cyear, strftime(d, '%Y') || '年' AS year_name, CAST(quarter(d) AS DOUBLE) AS cquarter,
       strftime(d, '%Y') || '年' || quarter(d) || '季度' AS quarter_name, CAST(month(d) AS DOUBLE) AS cmonth,
       strftime(d, '%Y') || '年' || month(d) || '月' AS month_name,
       CAST(week(d) AS DOUBLE) AS cweek, '第' || week(d) || '周' AS week_name,
       CAST(isodow(d) AS VARCHAR) AS week_day, {_WEEKDAY} AS week_day_name
FROM {_DAYS}"""

FULL_PRICE_AVERAGE = f"""
SELECT CAST(tenant_id AS BIGINT) AS tenant_id, CAST(member_id AS BIGINT) AS member_id,
       CAST(count(*) FILTER (WHERE {FULL}) AS DOUBLE) AS FULL_PRICE_LINES, {_fpa()} AS FULL_AVERAGE_PRICE
FROM slot_lines GROUP BY tenant_id, member_id"""


def oracle_sql() -> dict[str, str]:
    q = {name: single_section_query(sec) for name, sec in [
        ("order_lifecycle", "order_lifecycle"), ("recharge_lifecycle", "recharge_lifecycle"),
        ("points_totals", "points_totals"), ("typed_event_total", "typed_event_total"),
        ("coupon_lifetime", "coupon_lifetime"), ("coupon_recent", "coupon_recent"),
        ("coupon_valid", "coupon_valid"), ("member_base", "member_base"), ("member_flag", "member_flag"),
        ("active_flag", "active_flag"), ("top_items_pivot", "top_items")]}
    q["order_windows"] = windows_query("order_", [w for w, *_ in ORDER_WINDOW_SPECS])
    q["recharge_windows"] = windows_query("recharge_", [w for w, _ in RECHARGE_WINDOW_SPECS])
    q["asof_bounds"] = ASOF_BOUNDS
    q["full_price_average"] = _with(FULL_PRICE_AVERAGE)
    q["wide_profile"] = wide_profile_query()
    q["wide_to_cells"] = wide_to_cells_query()
    q["cells_sorted"] = cells_sorted_query()
    q["cells_upsert_latest"] = cells_upsert_query()
    q["cells_to_wide"] = cells_to_wide_query()
    q["typed_export"] = typed_export_query()
    q["typed_export_cells"] = typed_export_cells_query()
    q["store_export"] = store_export_query()
    q["doc_load"] = DOC_LOAD
    q["doc_append"] = DOC_APPEND
    q["table_replaced"] = TABLE_REPLACED
    q["doc_project"] = DOC_PROJECT
    q["export_overwrite"] = DOC_PROJECT
    q["doc_list_last"] = DOC_LIST_LAST
    q["doc_partition"] = DOC_PARTITION
    q["date_dim_by_count"] = DATE_DIM_BY_COUNT
    q["date_dim_by_range"] = DATE_DIM_BY_RANGE
    return q
