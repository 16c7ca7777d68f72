"""Input tables, by name and type. Readers apply these instead of inferring."""

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_text, _day, _real = T.StringType(), T.DateType(), T.DoubleType()
_money, _time = T.DecimalType(18, 2), T.TimestampNTZType()

# (contact_id, activity_date, seq) identifies an activity and orders a contact's log
ACTIVITY = _struct(
    contact_id=_text,
    contact_name=_text,
    activity_type=_text,
    activity_date=_day,
    seq=_text,
    sales_amount=_money,
    fund_code=_text,
    additional_detail=_text,
    link=_text,
    event_id=_text,
    gdc=_real,
    aum=_real,
    x_to_advisory=_real,
    x_to_alternatives=_real,
    age=_real,
    advisor_type=_text,
)

CONTACT = _struct(
    contact_id=_text,
    contact_name=_text,
    created_date=_day,
    contact_type=_text,
    first_sale_date_all=_day,
    first_sale_date_new=_day,
    rating=_text,
    approved=_text,
    registration=_text,
    score_7_days_ago=_real,
    account_name=_text,
    territory=_text,
    record_id=_text,
)

FUND_MAP = _struct(fund_code=_text, single_fund_code=_text)

SCORE_HISTORY = _struct(contact_id=_text, process_date=_day, score=_real)

WEB_TRACKING = _struct(
    contact_id_15=_text,
    visitor_key=_text,
    session_key=_text,
    session_start_ts=_time,
    event_name=_text,
    event_url=_text,
    site_name=_text,
    site_url=_text,
    event_ts=_time,
)

CONTENT_CATALOG = _struct(event_name=_text, event_url=_text, level=T.IntegerType())

RECOMMENDATION = _struct(
    contact_id=_text,
    contact_name=_text,
    engagement_level=_text,
    sku_next_content=_text,
    url_next_content=_text,
    recommendation_date=_day,
)
