"""The row contracts: web log, API user with nested profile, product."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import validation as v
from millrace.operators.validation import Contract, Field

WEB_LOG = Contract(
    fields=(
        Field("ip", v.IP),
        Field("timestamp", v.DATETIME),
        Field("method", v.TEXT, (v.one_of("GET", "POST"),)),
        Field("path", v.STRIPPED, (v.min_length(1), v.max_length(200), v.starts_with("/"))),
        Field("status", v.INT, (v.at_least(100), v.at_most(599))),
        Field("bytes", v.INT, (v.at_least(0),)),
        Field("user_agent", v.STRIPPED, (v.min_length(1), v.max_length(500))),
    ),
    forbid_extra=True,
)

API_USER = Contract(
    fields=(
        Field("id", v.INT),
        Field("username", v.TEXT),
        Field("age", v.INT, (v.at_least(0), v.at_most(120))),
        Field("email", v.EMAIL),
        Field("is_active", v.BOOL),
        Field("signup_date", v.DATE),
        Field("profile", v.RECORD),
        Field("profile.country", v.TEXT),
        Field("profile.tier", v.TEXT),
        Field("profile.score", v.FLOAT, (v.at_least(0), v.at_most(100))),
        Field("tags", v.LIST, required=False, default=lambda: F.array().cast("array<string>")),
    )
)

PRODUCT = Contract(
    fields=(
        Field("id", v.INT),
        Field("name", v.TEXT),
        Field("category", v.LOWERED),
        Field("price", v.FLOAT, (v.more_than(0),)),
    )
)


def texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


WEB_LOG_TEXTS = texts("ip", "timestamp", "method", "path", "status", "bytes", "user_agent")
PRODUCT_TEXTS = texts("id", "name", "category", "price")
API_USER_TEXTS = T.StructType(
    [
        *texts("id", "username", "email", "age", "is_active", "signup_date"),
        T.StructField("profile", texts("country", "tier", "score")),
        T.StructField("tags", T.ArrayType(T.StringType())),
    ]
)
API_RESPONSE_TEXTS = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("count", T.StringType()),
        T.StructField("results", T.ArrayType(API_USER_TEXTS)),
    ]
)
