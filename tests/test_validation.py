import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import validation as v
from millrace.operators.contracts import API_RESPONSE_TEXTS, API_USER, API_USER_TEXTS, PRODUCT, PRODUCT_TEXTS, WEB_LOG, WEB_LOG_TEXTS
from millrace.sources.tables import explode_results

GOOD = ("10.20.30.40", "2023-11-02T08:15:30", "POST", "/basket/7", "201", "77", "own-client/3")
DEMO_BASE = ("10.20.30.41", "2023-11-02T08:15:31", "GET", "/basket", "204", "0", "own-client/4")


def logs(spark, *rows):
    frame = spark.createDataFrame(list(rows), WEB_LOG_TEXTS)
    return frame.withColumn("n", F.monotonically_increasing_id()).coalesce(1)


def changed(**fields):
    return tuple(fields.get(name, value) for name, value in zip(WEB_LOG_TEXTS.names, DEMO_BASE))


def test_demo_rows_are_quarantined_with_their_first_field(spark):
    rows = logs(spark, GOOD, changed(ip="10.20.300.41"), changed(status="612"), changed(bytes="-20"))
    tagged = WEB_LOG.tag(rows, "n")
    assert tuple(v.split_counts(tagged).first()) == (4, 1, 3)
    invalid = WEB_LOG.invalid(tagged, "n").orderBy("row_no").collect()
    assert [r["errors"][0]["loc"] for r in invalid] == ["ip", "status", "bytes"]
    assert [r["errors"][0]["type"] for r in invalid] == ["ip_any_address", "less_than_equal", "greater_than_equal"]
    assert json.loads(invalid[0]["data"])["ip"] == "10.20.300.41"
    assert set(json.loads(invalid[0]["data"])) == set(WEB_LOG_TEXTS.names)


def test_valid_rows_are_typed_and_stripped(spark):
    row = WEB_LOG.valid(WEB_LOG.tag(logs(spark, changed(path="  /health ", status="200.0")), "n")).first()
    assert (row["path"], row["status"], row["bytes"]) == ("/health", 200, 0)
    assert str(row["timestamp"]) == "2023-11-02 08:15:31"


@pytest.mark.parametrize(
    "field, text, kind",
    [
        ("timestamp", "yesterday", "datetime_parsing"),
        ("timestamp", "2025-02-30T00:00:00", "datetime_parsing"),
        ("method", "PUT", "literal_error"),
        ("path", "health", "string_pattern_mismatch"),
        ("path", "   ", "string_too_short"),
        ("path", "/" * 201, "string_too_long"),
        ("status", "abc", "int_parsing"),
        ("status", "200.5", "int_parsing"),
        ("status", "99", "greater_than_equal"),
        ("status", None, "missing"),
        ("user_agent", " ", "string_too_short"),
        ("user_agent", "x" * 501, "string_too_long"),
    ],
)
def test_each_rule(spark, field, text, kind):
    errors = WEB_LOG.tag(logs(spark, changed(**{field: text})), "n").first()["errors"]
    assert [(e["loc"], e["type"]) for e in errors] == [(field, kind)]


def test_limits_are_inclusive(spark):
    rows = logs(spark, changed(status="100"), changed(status="599"), changed(bytes="0"), changed(path="/" * 200))
    assert v.split_counts(WEB_LOG.tag(rows, "n")).first()["invalid"] == 0


def test_all_failing_fields_are_kept_in_order(spark):
    errors = WEB_LOG.tag(logs(spark, changed(bytes="-1", ip="x", method="PUT")), "n").first()["errors"]
    assert [e["loc"] for e in errors] == ["ip", "method", "bytes"]


def test_unknown_fields_are_rejected(spark):
    extra = logs(spark, GOOD).withColumn("debug", F.lit("1"))
    assert [e["type"] for e in WEB_LOG.tag(extra, "n").first()["errors"]] == ["extra_forbidden"]
    document = F.lit(json.dumps(dict(zip(WEB_LOG_TEXTS.names, GOOD)) | {"debug": 1}))
    tagged = WEB_LOG.tag(logs(spark, GOOD), "n", F.json_object_keys(document))
    assert [e["loc"] for e in tagged.first()["errors"]] == ["debug"]


def user(i, **fields):
    base = {
        "id": i, "username": f"user_{i:03d}", "email": f"user{i}@example.com", "age": 30, "is_active": True,
        "signup_date": "2024-05-01", "profile": {"country": "KR", "tier": "gold", "score": 88.5}, "tags": ["a", "b"],
    }
    return {k: x for k, x in (base | fields).items() if x is not ...}


def test_nested_users_with_planted_faults(spark):
    users = [user(i) for i in range(1, 26)]
    users[2], users[9], users[16] = user(3, age=131), user(10, email="nobody.example"), user(17, signup_date="01/02/2024")
    users[11], users[24] = user(12, username=...), user(25, profile={"country": "PT", "tier": "basic", "score": 100.5})
    document = json.dumps({"status": "done", "count": 25, "results": users})
    parsed = spark.createDataFrame([(document,)], "d string").select(F.from_json("d", API_RESPONSE_TEXTS).alias("d"))
    tagged = API_USER.tag(explode_results(parsed.select("d.results")), "position")
    assert tuple(v.split_counts(tagged).first()) == (25, 20, 5)
    listing = v.error_listing(API_USER.invalid(tagged, "position")).orderBy("row_number").collect()
    assert [(r["row_number"], r["id"], r["field"], r["type"]) for r in listing] == [
        (3, "3", "age", "less_than_equal"),
        (10, "10", "email", "value_error"),
        (12, "12", "username", "missing"),
        (17, "17", "signup_date", "date_parsing"),
        (25, "25", "profile.score", "less_than_equal"),
    ]


def users_frame(spark, *records):
    texts = spark.createDataFrame([(json.dumps(r),) for r in records], "d string")
    return texts.select(F.from_json("d", API_USER_TEXTS).alias("r")).select("r.*").withColumn("n", F.lit(0))


def test_email_is_normalised_and_tags_default_to_an_empty_list(spark):
    tagged = API_USER.tag(users_frame(spark, user(1, email=" User1@Example.COM ", tags=...)), "n")
    row = API_USER.valid(tagged).first()
    assert row["email"] == "user1@example.com" and row["tags"] == [] and row["profile"]["score"] == 88.5


@pytest.mark.parametrize("email", ["@example.com", "user@example", "a@b@", "plain"])
def test_bad_addresses(spark, email):
    errors = API_USER.tag(users_frame(spark, user(1, email=email)), "n").first()["errors"]
    assert [e["loc"] for e in errors] == ["email"]


def test_absent_profile_is_one_error(spark):
    errors = API_USER.tag(users_frame(spark, user(1, profile=...)), "n").first()["errors"]
    assert [(e["loc"], e["type"]) for e in errors] == [("profile", "missing")]


@pytest.mark.parametrize("field, value, kind", [("id", "x", "int_parsing"), ("is_active", "maybe", "bool_parsing"), ("signup_date", "2024-13-01", "date_parsing"), ("age", 121, "less_than_equal")])
def test_types(spark, field, value, kind):
    errors = API_USER.tag(users_frame(spark, user(1, **{field: value})), "n").first()["errors"]
    assert [(e["loc"], e["type"]) for e in errors] == [(field, kind)]


def products(spark, *rows):
    return PRODUCT.tag(spark.createDataFrame(list(rows), PRODUCT_TEXTS).withColumn("n", F.lit(0)), "n")


def test_product_category_is_normalised(spark):
    assert PRODUCT.valid(products(spark, ("1", "A", " FOOD ", "10"))).first()["category"] == "food"


def test_negative_price_is_rejected_with_its_raw_row(spark):
    tagged = products(spark, ("1", "A", "food", "-5"))
    assert PRODUCT.valid(tagged).count() == 0
    row = PRODUCT.invalid(tagged, "n").first()
    assert json.loads(row["data"]) == {"id": "1", "name": "A", "category": "food", "price": "-5"}
    assert row["errors"][0]["type"] == "greater_than"


def test_counts_are_conserved(spark):
    tagged = products(spark, ("1", "A", "food", "10"), ("2", "B", "TECH", "20"), ("3", "C", "etc", "-5"))
    assert tuple(v.split_counts(tagged).first()) == (3, 2, 1)


def test_zoned_times_go_to_utc(spark):
    texts = ("2024-05-06T07:08:09Z", "2024-05-06 07:08:09+02:00", "2024-05-06T07:08-0530", "2024-05-06T07:08:09", "2024-05-06T07:08:09X")
    frame = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    got = [r[0] and str(r[0]) for r in frame.select(v.DATETIME.parse(F.col("t"))).collect()]
    assert got == ["2024-05-06 07:08:09", "2024-05-06 05:08:09", "2024-05-06 12:38:00", "2024-05-06 07:08:09", None]


def test_all_white_space_is_stripped(spark):
    row = spark.createDataFrame([("\t /a b\u00a0\n",)], "t string").select(v.STRIPPED.parse(F.col("t"))).first()
    assert row[0] == "/a b"
