"""Column layouts of the four tab-separated source tables."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# Field names in file order; the first field is the row key.
LOG_FIELDS = """
    id log_id remote_ip site_global_ticket site_global_session global_user_id
    cookie_text user_agent ref_url loc_url log_time
""".split()

GOODS_FIELDS = """
    id siteid istest hasread supportonedaylimit orderid cordersn isbook
    cpaymentstatus cpaytime producttype productid productname sku price number
    lockednumber unlockednumber productamount balanceamount couponamount esamount
    giftcardnumberid usedgiftcardamount couponlogid activityprice activityid cateid
    brandid netpointid shippingfee settlementstatus receiptorrejecttime iswmssku
    scode tscode tsshippingtime
""".split()

USER_FIELDS = """
    id siteid avatarimagefileid email username password salt registertime
    lastlogintime lastloginip memberrankid bigcustomerid lastaddressid
    lastpaymentcode gender birthday qq job mobile politicalface nationality
    validatecode pwderrcount source marriage money moneypwd isemailverify
    issmsverify smsverifycode emailverifycode verifysendcoupon canreceiveemail
    modified channelid grade_id nick_name is_blacklist
""".split()

ORDER_FIELDS = """
    id siteid istest hassync isbackend isbook iscod notautoconfirm ispackage
    packageid ordersn relationordersn memberid predictid memberemail addtime
    synctime orderstatus paytime paymentstatus receiptconsignee receiptaddress
    receiptzipcode receiptmobile productamount
""".split()

# Number of each data type on the command line of a load.
LAYOUTS = {1: LOG_FIELDS, 2: GOODS_FIELDS, 3: USER_FIELDS, 4: ORDER_FIELDS}


def layout(data_type: int | str) -> list[str]:
    """Field names of a data type."""
    if str(data_type) not in map(str, LAYOUTS):
        raise ValueError(f"unknown data type {data_type!r}, expected one of {sorted(LAYOUTS)}")
    return LAYOUTS[int(data_type)]


def text_schema(fields: list[str] | str) -> StructType:
    """All-string, nullable schema from field names or their comma-joined list."""
    names = fields.split(",") if isinstance(fields, str) else fields
    return StructType([StructField(name, StringType()) for name in names])
