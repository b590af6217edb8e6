"""The declared catalog of the wide table: 137 columns (row key + 66 in
family ST + 70 in family EXT), each with its export type.

Export kinds:
  string            value as stored
  tinyint / int     integer part of the stored number
  double            stored number
  date              'yyyy-MM-dd' (or any text with a leading date) -> DATE
  ymd               'yyyyMMdd' text -> 'yyyy-MM-dd' text
A trailing "0" marks columns whose missing value exports as 0.
"""

from __future__ import annotations

from dataclasses import dataclass

# Column name, family, export kind, default -- in catalog order.
_CATALOG_TEXT = """
ROW_KEY rowkey string
MEMBER_ID ST string
TENANT_ID ST string
APP_INSTANCE_ID ST string
MEMBER_TYPE ST tinyint
AGE ST string
CHANNEL_CODE ST string
USER_NAME ST string
NICK_NAME ST string
REAL_NAME ST string
AVATAR ST string
INVITE_CODE ST string
INVITE_NAME ST string
POSITION ST string
MEMBER_STATUS ST string
COMPANY ST string
CONTACT_ADDR ST string
PROVINCE ST string
CITY ST string
DISTRICT ST string
PHONE_NUMBER ST string
PHONE_SEGMENT ST string
EMAIL ST string
EMAIL_TYPE ST string
GENDER ST string
BIRTHDAY ST date
INDUSTRY ST string
EDUCATION_LEVEL ST tinyint
MARITAL_STATUS ST tinyint
LEVEL ST string
OPEN_ID ST string
UNION_ID ST string
CHANNEL_NAME ST string
CHANNEL ST string
TAOBAO_MEMBER_CODE ST string
MODEL_NAME ST string
REGISTER_TIME ST string
REGISTER_DAYS ST int
MEMBER_NO ST string
CUSTOMER_NO ST string
IS_PAY_MEMBER ST int
IS_GROUP_BUYING ST int
MEMBER_CARD_NO ST string
REFRESH_LEVEL_TIME ST date
LEVEL_EXPIRATION_TIME ST date
IS_PREMIUM_MEMBERSHIP ST tinyint
POINTS_ACCOUNT_CODE ST string
AVAILABLE_POINTS ST string
ACCOUNT_TYPE ST string
OUTER_ID ST string
USER_TYPE ST string
ACCT_STATUS ST string
BALANCE ST double
FIRST_CHARGE_TIME EXT ymd
LAST_CHARGE_TIME EXT ymd
LAST_CHARGE_DAYS EXT int
LAST_CHARGE_AMOUNT_30D EXT double 0
LAST_CHARGE_AMOUNT_90D EXT double 0
LAST_CHARGE_AMOUNT_120D EXT double 0
LAST_CHARGE_AMOUNT_180D EXT double 0
LAST_CHARGE_AMOUNT_360D EXT double 0
TOTAL_CHARGE_AMOUNT EXT double 0
GROWTH_VALUE ST int
STORE_ID ST string
STORE_CODE ST string
STORE_NAME ST string
FIRST_ORDER_TIME EXT ymd
FIRST_ORDER_SHOPID EXT string
FIRST_ORDER_SHOPNAME EXT string
FIRST_ORDER_INTRVL EXT int
LST_ORDER_TIME EXT ymd
LST_ORDER_INTRVL EXT int
LST_ORDER_SHOPID EXT string
LST_ORDER_SHOPNAME EXT string
LST_ORDER_NUM_30D EXT int 0
LST_ORDER_NUM_90D EXT int 0
LST_ORDER_NUM_180D EXT int 0
LST_ORDER_NUM_360D EXT int 0
LST_ORDER_AMOUNT_30D EXT double 0
LST_ORDER_AMOUNT_90D EXT double 0
LST_ORDER_AMOUNT_180D EXT double 0
LST_ORDER_AMOUNT_360D EXT double 0
LST_ORDER_DISC_30D EXT double 0
LST_ORDER_DISC_90D EXT double 0
LST_ORDER_DISC_180D EXT double 0
LST_ORDER_DISC_360D EXT double 0
FULL_AVERAGE_PRICE_30D EXT double 0
FULL_AVERAGE_PRICE_90D EXT double 0
FULL_AVERAGE_PRICE_120D EXT double 0
FULL_AVERAGE_PRICE_360D EXT double 0
ORDER_NUM EXT int 0
ORDER_AMOUNT EXT double 0
ORDER_DISCOUNT EXT double 0
DELIVERY_PROVINCE_1ST EXT string
DELIVERY_PROVINCE_2ND EXT string
DELIVERY_PROVINCE_3RD EXT string
DELIVERY_CITY_1ST EXT string
DELIVERY_CITY_2ND EXT string
DELIVERY_CITY_3RD EXT string
TRADE_CHANNEL_1ST EXT string
TRADE_CHANNEL_2ND EXT string
TRADE_CHANNEL_3RD EXT string
TRADE_PERCENT_1ST EXT double 0
TRADE_PERCENT_2ND EXT double 0
TRADE_PERCENT_3RD EXT double 0
PHONE_FLG ST string
LAST_RECEIVED_COUPON_15D_FLG EXT string
LAST_USED_COUPON_15D_FLG EXT string
LAST_RECEVIED_COUPON_15D EXT int 0
LAST_USED_COUPON_15D EXT int 0
LAST_USED_COUPON_PERCENT_15D EXT double 0
TOTAL_RECEIVED_COUPON EXT int 0
TOTAL_USED_COUNPON EXT int 0
TOTAL_USED_COUNPON_PERCENT EXT double 0
LST_ORDITEM_ITEMCODE_1ST_360D EXT string
LST_ORDITEM_ITEMCODE_2ST_360D EXT string
LST_ORDITEM_ITEMCODE_3ST_360D EXT string
LST_ORDITEM_ITEMNAME_1ST_360D EXT string
LST_ORDITEM_ITEMNAME_2ST_360D EXT string
LST_ORDITEM_ITEMNAME_3ST_360D EXT string
MEMBER_FLG ST string
MEMBER_LEVEL_DEFINE_ID ST string
LEVEL_NAME ST string
EXCHANGE_POINTS EXT int 0
YH_POINTS_COUNT EXT int 0
GET_POINTS EXT int 0
GET_POINTS_COUNT EXT int 0
EXPIRED_POINTS EXT int 0
CLEAR_POINTS EXT int 0
ACTIVITIES_POINT_COUNT EXT int 0
IS_ENTER_WECHAT ST string
MEMBER_ORG_ID ST string
MEMBER_ORG_NAME ST string
STORE_ORG_ID ST string
STORE_ORG_NAME ST string
IS_MP_ACITIVE_USER ST string
VALID_COUNPON_CNT EXT int 0
"""

ROW_KEY = "ROW_KEY"


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    cf: str
    kind: str
    default_zero: bool = False

    @property
    def cell_date_format(self) -> str:
        """How a DATE value of this column is written into a cell."""
        return "yyyyMMdd" if self.kind == "ymd" else "yyyy-MM-dd"


def _parse(text: str) -> list[ColumnSpec]:
    out = []
    for line in text.strip().splitlines():
        parts = line.split()
        out.append(ColumnSpec(parts[0], parts[1], parts[2], len(parts) > 3 and parts[3] == "0"))
    return out


CATALOG: list[ColumnSpec] = _parse(_CATALOG_TEXT)
BY_NAME: dict[str, ColumnSpec] = {c.name: c for c in CATALOG}
VALUE_COLUMNS: list[ColumnSpec] = [c for c in CATALOG if c.cf != "rowkey"]

assert len(CATALOG) == 137
assert sum(c.cf == "ST" for c in CATALOG) == 66 and sum(c.cf == "EXT" for c in CATALOG) == 70
