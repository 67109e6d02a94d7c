import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from millrace.operators.contracts import WEB_LOG_TEXTS
from millrace.sources import split_text, tables

def test_parquet_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(1, 10.5), (2, 20.0)], "id long, price double")
    assertDataFrameEqual(tables.write_verified(rows, str(tmp_path / "t")), rows)


def test_csv_and_json_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "A, \"quoted\""), (2, "B")], "id long, name string")
    tables.write_csv(rows, str(tmp_path / "c"))
    tables.write_json(rows, str(tmp_path / "j"))
    assertDataFrameEqual(spark.read.schema(rows.schema).csv(str(tmp_path / "c"), header=True, escape='"'), rows)
    assertDataFrameEqual(spark.read.schema(rows.schema).json(str(tmp_path / "j")), rows)


def test_readers(spark, tmp_path):
    logs = tmp_path / "logs.csv"
    logs.write_text("ip,timestamp,method,path,status,bytes,user_agent\n10.0.0.1,2025-03-05T14:00:00,GET,/,200,12,\"a, b\"\n")
    row = tables.read_web_logs(spark, str(logs)).first()
    assert row["status"] == "200" and row["user_agent"] == "a, b"
    assert tables.read_web_logs(spark, str(logs)).schema == WEB_LOG_TEXTS

    events = tmp_path / "events.csv"
    events.write_text("event_id,user_id,event_type,ts,amount,note\n1,2,buy,2025-01-01T00:00:00,9.5,x\n2,3,view,2025-01-01T00:00:01,NA,y\n")
    typed = tables.read_events(spark, str(events))
    assert dict(typed.dtypes)["amount"] == "double" and [r["amount"] for r in typed.orderBy("event_id").collect()] == [9.5, None]
    events.write_text("event_id,ts\n1,2025-01-01\n")
    with pytest.raises(ValueError, match="amount, event_type, user_id"):
        tables.read_events(spark, str(events))

    sales = tmp_path / "sales.csv"
    sales.write_text("order_id,order_date,region,category,quantity,unit_price,discount\nO1,2025-01-01,,Food,2,,0.1\n")
    assert tables.read_sales(spark, str(sales)).where("region IS NULL AND unit_price IS NULL").count() == 1


def test_churn_reader_rejects_an_empty_table(spark, tmp_path):
    path = tmp_path / "churn.csv"
    path.write_text(",".join(tables.CHURN_TYPES) + "\n")
    with pytest.raises(ValueError, match="empty"):
        tables.read_churn(spark, str(path))


def test_json_documents_are_numbered_from_zero(spark, tmp_path):
    users = [{"id": i, "profile": {"score": 1.5}} for i in (5, 6)]
    (tmp_path / "users.json").write_text(json.dumps({"status": "ok", "count": 2, "results": users}, indent=2))
    rows = tables.read_api_users(spark, str(tmp_path / "users.json")).collect()
    assert [(r["position"], r["id"], r["profile"]["score"]) for r in rows] == [(0, "5", "1.5"), (1, "6", "1.5")]


def test_rows_of_a_split_file_are_numbered_in_order(spark, tmp_path):
    path = tmp_path / "logs.csv"
    lines = [f"10.0.0.1,2025-03-05T14:00:00,GET,/p{i},200,{i},agent" for i in range(5000)]
    path.write_text("ip,timestamp,method,path,status,bytes,user_agent\n" + "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        numbered = tables.number_rows(tables.read_web_logs(spark, str(path)))
        assert numbered.rdd.getNumPartitions() > 3
        assert numbered.where(F.col("row_no") != F.col("bytes").cast("long")).count() == 0
        assert numbered.agg(F.count_distinct("row_no"), F.max("row_no")).first()[:] == (5000, 4999)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_csv_with_quotes_commas_and_line_breaks(spark, tmp_path):
    rows = [("1", 'say "hi", ok', "a,b"), ("2", "two\nlines", '"'), ("3", None, "x")]
    frame = spark.createDataFrame(rows, 'id string, "t" string, u string'.replace('"', "`"))
    tables.write_csv(frame, f"{tmp_path}/out")
    back = tables.read_csv_texts(spark, f"{tmp_path}/out", frame.schema, line_breaks=True)
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    (tmp_path / "own.csv").write_text('id,"a, ""b"""\n1,"say ""hi"", ok"\n')
    assert tables.header_of(spark, f"{tmp_path}/own.csv") == ["id", 'a, "b"']
    assert tables.read_csv_texts(spark, f"{tmp_path}/own.csv").first()[1] == 'say "hi", ok'


def test_rows_are_numbered_in_file_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k\n" + "".join(f"a{i}\n" for i in range(3)))
    (tmp_path / "b.csv").write_text("k\n" + "".join(f"b{i}\n" for i in range(30)))
    got = tables.number_rows(tables.read_csv_texts(spark, str(tmp_path))).orderBy("row_no").collect()
    assert [r["k"] for r in got] == [f"a{i}" for i in range(3)] + [f"b{i}" for i in range(30)]
    assert [r["row_no"] for r in got] == list(range(33))


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_split_csv_with_line_breaks_equals_the_whole_file_reader(spark, tmp_path, small_blocks):
    draw = random.Random(5)
    pieces = ["a", "b,c", '""', "\n", "\n\n", "é漢", " x ", "\r\n", "long " * 40, ",", "1"]
    folder = tmp_path / "csv"
    folder.mkdir()
    want = []
    for name, count in (("a.csv", 400), ("b.csv", 1), ("c.csv", 0), ("d.csv", 60)):
        lines = ["k,t,u\n"]
        for i in range(count):
            text = "".join(draw.choice(pieces) for _ in range(draw.randint(0, 8)))
            if i == 30:
                text = 'line of a very long field ""\n' * 700  # a record over many blocks, most with quotes of their own
            end = "\r\n" if name == "d.csv" else "\n"
            lines.append(f'{name}{i},"{text}",{i}{end}')
            want.append((f"{name}{i}", text.replace('""', '"'), str(i)))
        (folder / name).write_text("".join(lines), newline="")
    rows = tables.read_csv_texts(spark, str(folder), line_breaks=True)
    got = sorted((r["k"], r["t"] or "", r["u"]) for r in rows.collect())
    assert got == sorted(want)
    # the file is read by many tasks, and records keep their order
    assert split_text._parts(spark, f"{folder}/a.csv", "\n").rdd.getNumPartitions() > 10
    ordered = split_text.csv_records(spark, f"{folder}/a.csv").orderBy("block", "number").collect()
    assert [r["text"].split(",")[0] for r in ordered] == ["k"] + [f"a.csv{i}" for i in range(400)]


def test_csv_whose_quotes_never_close(spark, tmp_path, small_blocks):
    (tmp_path / "open.csv").write_text('k,t\n1,"a"\n2,"never closed\n' + "more\n" * 2000)
    records = split_text.csv_records(spark, f"{tmp_path}/open.csv").orderBy("block", "number").collect()
    assert [r["text"][:6] for r in records] == ["k,t", '1,"a"', '2,"nev'] and records[2]["text"].count("more") == 2000


@pytest.mark.parametrize("indent", [None, 2])
def test_split_json_document_equals_the_whole_file_reader(spark, tmp_path, small_blocks, indent):
    draw = random.Random(6)
    texts = ['}{ "', "\\", 'say \\"hi\\"', "[]{}", "é漢\n", "}" * 50, "long " * 400, "", '\\\\"}']
    folder = tmp_path / "json"
    folder.mkdir()
    want = {}
    for name, count in (("a", 300), ("b", 1), ("c", 0)):
        users = [
            {"id": i, "username": draw.choice(texts), "profile": {"country": draw.choice(texts), "score": 1.5}, "tags": [draw.choice(texts), "x"]}
            for i in range(count)
        ]
        document = {"status": "} ok {", "count": count, "results": users, "more": {"a": [1, 2], "b": "]"}}
        (folder / f"{name}.json").write_text(json.dumps(document, indent=indent, ensure_ascii=False) + ("\n" if indent else ""))
        want |= {(name, i): u for i, u in enumerate(users)}
    records = split_text.json_records(spark, str(folder)).collect()
    assert {(r["file"].rsplit("/", 1)[1][0], r["position"]): json.loads(r["text"]) for r in records} == want
    assert len(records) == 301
    if indent:
        assert split_text._parts(spark, f"{folder}/a.json", "}").rdd.getNumPartitions() > 10
        rows = tables.read_api_users(spark, f"{folder}/a.json").orderBy("position").collect()
        assert [(r["position"], r["id"], r["username"], r["tags"][0]) for r in rows] == [
            (i, str(i), want["a", i]["username"], want["a", i]["tags"][0]) for i in range(300)
        ]
