import datetime as dt
import pathlib
import tempfile

import pytest
from pyspark.sql import functions as F

from lakemart import schemas
from lakemart.operators import clean
from lakemart.sources import readers, writers
from tests.helpers import frame, plan_of, rows_by, texts, ts


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="run-")


def put(root, folder, name, text):
    path = pathlib.Path(root) / folder
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(text)


def order_rows(spark, *rows):
    full = [(i, "c", "p", q, 1, 2, "UPI", "Placed", at) for i, q, at in rows]
    return frame(spark, schemas.ORDERS, full)


def folders(root):
    return sorted({str(p.parent.relative_to(root)) for p in pathlib.Path(root).rglob("part-*")})


def test_publish_and_read_back(spark, root):
    feed = root + "/orders"
    sent = order_rows(
        spark,
        ("o1", 1, "2024-05-06 01:02:03.123456"),
        ("o2", None, "2024-05-07 00:00:00"),
        ("", 3, None),
    )
    landing = F.coalesce(F.to_date("order_timestamp"), F.lit("2024-12-31").cast("date"))
    for fmt in ("csv", "json"):
        writers.publish_feed(writers.land_on(sent, landing), f"{feed}-{fmt}", fmt)
        assert folders(f"{feed}-{fmt}")[0] == "year=2024/month=12/day=31"
        if fmt == "csv":
            raw = readers.read_csv_feed(spark, f"{feed}-csv", schemas.ORDERS)
        else:
            raw = readers.read_json_feed(spark, f"{feed}-json", schemas.ORDERS)
        assert dict(raw.dtypes)["quantity"] == "string" and dict(raw.dtypes)["month"] == "int"
        got = rows_by(clean.clean_orders(raw, "2024-06-01"), "order_id")
        blank = None if fmt == "csv" else ""
        assert set(got) == {"o1", "o2", blank}, "CSV has no empty text, only NULL"
        assert got["o1"].order_timestamp == ts("2024-05-06 01:02:03.123456")
        assert (got["o2"].quantity, got["o2"].day) == (None, 7)
        assert got[blank].order_timestamp is None
    text = next(pathlib.Path(f"{feed}-csv/year=2024/month=5/day=6").glob("*.csv")).read_text()
    assert text.splitlines()[0] == ",".join(schemas.ORDERS.names)
    assert "2024-05-06T01:02:03.123456" in text


def test_csv_by_name_not_position(spark, root):
    names = schemas.INVENTORY.names
    put(root, "year=2024/month=07/day=06", "a.csv", ",".join(reversed(names)) + ",note\n"
        "2024-07-06T00:00:00,-2,SALE,WH_BLR,p1,i1,x\n")  # fmt: skip
    raw = readers.read_csv_feed(spark, root, schemas.INVENTORY)
    assert raw.columns == [*names, "year", "month", "day"]
    row = raw.first()
    assert (row.inventory_event_id, row.product_id, row.month) == ("i1", "p1", 7)
    with pytest.raises(schemas.ContractError, match="order_id"):
        readers.read_csv_feed(spark, root, schemas.ORDERS)


def test_a_file_laid_out_differently_stops_the_job(spark, root):
    put(root, "year=2024/month=07/day=06", "a.csv", "k,v\n1,a\n")
    put(root, "year=2024/month=07/day=07", "b.csv", "v,k\na,1\n")
    with pytest.raises(Exception, match="header"):
        readers.read_csv_feed(spark, root).collect()


def test_day_read_lists_one_folder(spark, root):
    for month, day in (("07", "06"), ("07", "07"), ("12", "06")):
        put(root, f"year=2024/month={month}/day={day}", "a.csv", f"k,v\n{day},{month}\n")
    put(root, "year=2024/month=7/day=6", "b.csv", "k,v\nunpadded,7\n")
    df = readers.read_csv_day(spark, root, dt.date(2024, 7, 6))
    assert {tuple(r) for r in df.collect()} == {("06", "07", 2024, 7, 6), ("unpadded", "7", 2024, 7, 6)}
    assert all("day=07" not in f and "month=12" not in f for f in df.inputFiles())
    december = readers.read_csv_day(spark, root, dt.date(2024, 12, 6))
    assert december.count() == 1


def test_days_from_file_paths(spark, root):
    put(root, "extra/year=2024/month=07/day=06", "a.csv", "k\n1\n")
    put(root, "year=2023/month=1/day=2/deeper", "a.csv", "k\n2\n")
    got = rows_by(readers.read_csv_feed(spark, root, days_from_path=True), "k")
    assert tuple(got["1"])[1:] == (2024, 7, 6) and tuple(got["2"])[1:] == (2023, 1, 2)
    run = readers.with_run_day(spark.range(1), dt.date(2024, 7, 6)).first()
    assert (run.year, run.month, run.day) == (2024, 7, 6)


def test_dynamic_overwrite_touches_only_its_days(spark, root):
    table = root + "/silver"
    two = order_rows(spark, ("o1", 1, "2024-05-06 00:00:00"), ("o2", 2, "2024-05-07 00:00:00"))
    again = order_rows(spark, ("o3", 3, "2024-05-07 00:00:00"))
    for df in (two, again, again):
        landed = writers.land_on(df, F.to_date("order_timestamp"))
        writers.write_table(landed, table, "dynamic", writers.DAY_COLUMNS, rebalance=True)
    assert {r.order_id for r in readers.read_table(spark, table).collect()} == {"o1", "o3"}
    landed = writers.land_on(again, F.to_date("order_timestamp"))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        writers.write_table(landed, table, "overwrite", writers.DAY_COLUMNS)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert {r.order_id for r in readers.read_table(spark, table).collect()} == {"o3"}
    writers.write_table(landed, table, "append", writers.DAY_COLUMNS)
    assert readers.read_table(spark, table).count() == 2
    with pytest.raises(ValueError):
        writers.write_table(landed, table, "dynamic")
    with pytest.raises(ValueError):
        writers.write_table(landed, table, "upsert")
    with pytest.raises(ValueError):
        writers.publish_feed(landed, table, "xml")


def test_partition_filter_prunes(spark, root):
    landed = writers.land_on(
        order_rows(spark, ("o1", 1, "2024-05-06"), ("o2", 2, "2024-05-07")), F.to_date("order_timestamp")
    )
    writers.write_table(landed, root + "/t", "overwrite", writers.DAY_COLUMNS)
    one = readers.read_table(spark, root + "/t").where("day = 6 and quantity > 0").select("order_id")
    plan = plan_of(one)
    assert "PartitionFilters: [isnotnull(day" in plan and "GreaterThan(quantity,0)" in plan
    assert "ReadSchema: struct<order_id:string,quantity:int>" in plan


def test_catalog_table_and_audit(spark, root):
    df = order_rows(spark, ("o1", 1, "2024-05-06"), ("o2", 2, "2024-05-07"))
    watched, seen = writers.audit(df)
    writers.write_table(watched, root + "/t", "overwrite")
    assert seen.get == {"rows": 2}
    name = "lakemart_test_ctas"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.conf.set("spark.sql.legacy.allowNonEmptyLocationInCTAS", "true")
    try:
        writers.create_table_as(df, name)
        assert readers.read_catalog(spark, name).count() == 2
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    readers.name_for_sql(df, "lakemart_test_view")
    assert readers.read_catalog(spark, "lakemart_test_view").count() == 2
    assert writers.empty_like(schemas.ORDERS, spark).schema == schemas.ORDERS


def test_json_keeps_text(spark, root):
    put(root, "year=2024/month=07/day=06", "a.json",
        '{"session_id":"s","customer_id":"c","event_type":"purchase","product_id":"p",'
        '"event_timestamp":"2024-07-06T01:02:03.5"}\n{"session_id":"t"}\n')  # fmt: skip
    raw = readers.read_json_feed(spark, root, schemas.CLICKSTREAM)
    got = rows_by(clean.clean_clickstream(raw), "session_id")
    assert got["s"].event_timestamp == ts("2024-07-06 01:02:03.5")
    assert got["t"].event_type is None and got["t"].month == 7


def test_text_helper_is_text(spark):
    assert texts(spark, ["a"], [("1",)]).schema == schemas.as_text(schemas._struct("a int"))


def test_text_survives_a_csv_feed(spark, tmp_path):
    texts = ["  padded  ", 'say "hi"', "back\\slash", "ends with \\", "a,b", "one\ntwo\r\nthree", "\\n \\\\n", "tab\t", None]
    df = writers.land_on(
        spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, text string"),
        F.lit("2024-05-06").cast("date"))
    for fmt in ("csv", "json"):
        path = str(tmp_path / fmt)
        writers.publish_feed(df, path, fmt, escape_lines=True)
        back = (
            readers.read_csv_feed(spark, path, escaped_lines=True) if fmt == "csv"
            else readers.read_json_feed(spark, path, spark.createDataFrame([], "id string, text string").schema))
        assert {int(r.id): r.text for r in back.collect()} == dict(enumerate(texts))
    with pytest.raises(Exception, match="line break"):
        writers.publish_feed(df, str(tmp_path / "plain"))


def test_a_packed_feed_reads_as_a_plain_one(spark, root):
    rows = [(f"o{i}", i, f"2024-05-{1 + i % 3:02d} 01:02:03") for i in range(300)]
    sent = order_rows(spark, *rows)
    landed = writers.land_on(sent, F.to_date("order_timestamp"))
    found, sizes = {}, {}
    for fmt in ("csv", "json"):
        for packing in ("none", "gzip"):
            path = f"{root}/{fmt}-{packing}"
            writers.publish_feed(landed, path, fmt, compression=packing)
            files = [p for p in pathlib.Path(path).rglob("part-*") if p.is_file()]
            assert all((p.suffix == ".gz") == (packing == "gzip") for p in files) and len(files) >= 3
            sizes[fmt, packing] = sum(p.stat().st_size for p in files)
            if fmt == "csv":
                reads = [
                    readers.read_csv_feed(spark, path, schemas.ORDERS),
                    readers.read_csv_feed(spark, path, schemas.ORDERS, on_bad_record="aside"),
                    readers.read_csv_feed(spark, path, schemas.ORDERS, days_from_path=True),
                    readers.read_csv_generations(spark, path, schemas.ORDERS),
                    readers.read_csv_day(spark, path, dt.date(2024, 5, 2), schemas.ORDERS),
                ]
            else:
                reads = [readers.read_json_feed(spark, path, schemas.ORDERS)]
            found[fmt, packing] = [sorted(map(str, clean.clean_orders(r, "2024-06-01").collect())) for r in reads]
        assert found[fmt, "gzip"] == found[fmt, "none"]
        assert [len(f) for f in found[fmt, "gzip"]] == [300, 300, 300, 300, 100][: len(reads)]
        assert sizes[fmt, "gzip"] < sizes[fmt, "none"] / 3


def test_malformed_records_stop_or_stand_aside(spark, tmp_path):
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv/a.csv").write_text("a,b,c\n1,2,3\n4,5\n6,7,8,9\n")
    (tmp_path / "json").mkdir()
    (tmp_path / "json/a.json").write_text('{"a":"1","b":"2"}\n{"a":"3","b"\n')
    schema = spark.createDataFrame([], "a string, b string").schema
    reads = {
        mode: (readers.read_csv_feed(spark, str(tmp_path / "csv"), schema, on_bad_record=mode),
               readers.read_json_feed(spark, str(tmp_path / "json"), schema, on_bad_record=mode))
        for mode in readers.BAD_RECORD_MODES}
    for df in reads["fail"]:
        with pytest.raises(Exception, match="MALFORMED|Malformed"):
            df.collect()
    for df, good, bad in zip(reads["aside"], (1, 1), (2, 1)):
        assert [(r.a, r.b) for r in readers.well_formed(df).collect()] == [("1", "2")] and good == 1
        assert len(readers.set_aside(df).collect()) == bad
