"""Tables and marts kept up by the landing: equal to full runs, and reading only what they must."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from lakemart import schemas
from lakemart.operators import bitmaps, blocks, clean, derive, landing, scd2
from lakemart.plans import basic, gold, refresh, star
from lakemart.sources import readers, writers
from tests.helpers import frame, plan_of, texts, ts
from tests.test_scale import hot, settings, small_partitions, stages  # noqa: F401


def folder():
    return tempfile.mkdtemp(prefix="run-")


# ---- keep-one by landing


def landings(seed, days=6):
    """Landings of repeated keys, with nulls and equal rows among them."""
    rng = random.Random(seed)
    return [[(rng.choice(["a", "b", "c", "d", None]), rng.choice(["1", "2", None]), f"2024-01-0{day + 1}")
             for _ in range(12)] for day in range(days)]


@pytest.mark.parametrize("seed", range(3))
def test_landings_in_any_order_equal_the_full_run(spark, seed):
    days = landings(seed)
    frames = [
        texts(spark, ["key", "value", "at"], rows)
        .selectExpr("key", "value", "timestamp(at) AS at", "2024 AS year", "1 AS month", "day(date(at)) AS day",
                    "timestamp('2024-02-01') AS processed_timestamp") for rows in days]
    every = frames[0]
    for more in frames[1:]:
        every = every.unionByName(more)
    full, late = folder() + "/t", folder() + "/t"
    landing.land(spark, full, every, "key", ["at"], buckets=4)
    order = list(range(len(frames))) + [0, 3]
    random.Random(seed).shuffle(order)
    for i in order:
        landing.land(spark, late, frames[i], "key", ["at"], buckets=4)
    got, want = (sorted(map(str, landing.read_landed(spark, r).collect())) for r in (late, full))
    assert got == want and len(got) == 5


def test_a_landing_reads_and_rewrites_its_own_buckets(spark):
    root = folder() + "/t"
    rows = spark.range(2000).select(F.col("id").cast("string").alias("key"), F.lit(1).alias("value"))
    assert len(landing.land(spark, root, rows, "key", buckets=32)) == 32
    home, n = landing.home_of(spark, root, buckets=7)
    assert n == 32, "a stored table keeps its count"
    before = {p: p.stat().st_mtime_ns for p in _parts(home)}
    hit = landing.land(spark, root, rows.limit(3).withColumn("value", F.lit(0)), "key")
    assert 1 <= len(hit) <= 3
    after = {p: p.stat().st_mtime_ns for p in _parts(home)}
    assert {p.parent.name for p in before if p not in after} == {f"bucket={b}" for b in hit}
    plan = plan_of(landing.slices(spark, home, spark.read.parquet(home).schema, hit))
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert landing.read_landed(spark, root).where("value = 0").count() == 3
    assert landing.land(spark, root, rows.limit(0), "key") == []


def test_a_landing_moves_its_rows_once_to_the_choice_and_the_folders(spark, monkeypatch):
    written = []

    def write(df, *args, rebalance=False, **more):
        out = writers.by_folder(df, [landing.BUCKET]) if rebalance else df
        written.append(out._jdf.queryExecution().executedPlan().toString())
        writers.write_table(df, *args, rebalance=rebalance, **more)

    monkeypatch.setattr(landing, "write_table", write)
    root = folder() + "/t"
    for value in (1, 2):
        rows = spark.range(500).select(F.col("id").cast("string").alias("key"), F.lit(value).alias("value"))
        landing.land(spark, root, rows, "key", ["value"], buckets=4)
    assert [plan.count("Exchange ") for plan in written] == [1, 1], written[-1]
    assert [r.value for r in landing.read_landed(spark, root).select("value").distinct().collect()] == [2]


def test_buckets_cut_over_tasks_hold_each_key_once(spark):
    """Many tasks share a bucket, and few files are made of it."""
    rng = random.Random(1)
    parts = [
        texts(spark, ["key", "value", "at"], [
            (rng.choice([None, *(f"k{i}" for i in range(900))]), str(rng.randint(1, 3)), f"2024-01-0{day}")
            for _ in range(1500)])
        for day in (1, 2, 3)]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    full, late = folder() + "/t", folder() + "/t"
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        landing.land(spark, full, every, "key", ["at"], buckets=2)
        for part in (parts[2], parts[0], parts[1], parts[0]):
            landing.land(spark, late, part, "key", ["at"], buckets=2)
    got, want = (sorted(map(str, landing.read_landed(spark, r).collect())) for r in (late, full))
    assert got == want and len({g.split(", value")[0] for g in got}) == len(got) > 800
    files = len(_parts(landing.home_of(spark, late)[0]))
    assert 2 < files <= 2 + 8, "as many files as tasks, and one more where a task ends a bucket"


def _parts(home):
    import pathlib

    return sorted(pathlib.Path(home).rglob("*.parquet"))


# ---- product history in any order


def events(spark, rows):
    return clean.type_product_changes(
        texts(spark, schemas.PRODUCT_CHANGES.names,
              [(p, "n", "c", "s", "b", price, "1", "7", "2023-01-31", "true", op, at) for p, op, at, price in rows]),
        "2024-06-01 00:00:00")


def random_events(seed, n=60):
    rng = random.Random(seed)
    return [(rng.choice("pqr"), rng.choice(["I", "U", "D", "X"]), f"2024-01-01 00:{i:02d}:00", str(rng.randint(1, 9)))
            for i in range(n)]


@pytest.mark.parametrize("expire", [False, True])
def test_replay_equals_batch_after_batch(spark, expire):
    rows = random_events(5, 24)
    history = scd2.empty_history(spark)
    for i in range(0, len(rows), 4):
        # One event of a product a batch, as its order within a batch does not count there.
        for row in rows[i : i + 4]:
            history = scd2.apply_scd2(history, clean.clean_product_changes(
                texts(spark, schemas.PRODUCT_CHANGES.names,
                      [(row[0], "n", "c", "s", "b", row[3], "1", "7", "2023-01-31", "true", row[1], row[2])]),
                "2024-06-01 00:00:00"), expire)
        from lakemart.session import settle

        history = settle(history)
    want = sorted(map(str, history.collect()))
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    for limit in (10**6, 3):
        assert sorted(map(str, scd2.replay(events(spark, shuffled), expire, limit).collect())) == want


def test_late_batches_give_one_history(spark):
    rows = random_events(7)
    want = sorted(map(str, scd2.replay(events(spark, rows)).collect()))
    batches = [rows[i::5] for i in range(5)]
    random.Random(2).shuffle(batches)
    root = folder()
    for batch in [*batches, batches[0]]:
        scd2.land_changes(spark, root, events(spark, batch), buckets=4)
    assert sorted(map(str, scd2.read_replayed(spark, root).collect())) == want
    assert scd2.check_overlaps(scd2.read_replayed(spark, root).where("product_id = 'none'")).count() == 0
    assert scd2.land_changes(spark, root, events(spark, [])) == []


def _rewritten(spark, root, batch):
    """What a landing gives, and the history files it adds."""
    before = set(_parts(f"{root}/history"))
    hit = scd2.land_changes(spark, root, batch, buckets=4)
    return hit, set(_parts(f"{root}/history")) - before


def test_a_batch_that_landed_before_rewrites_nothing(spark):
    rows, root = random_events(7), folder()
    batches = [events(spark, rows[i::2]) for i in range(2)]
    hit, added = _rewritten(spark, root, batches[0])
    assert hit and added
    assert _rewritten(spark, root, batches[0]) == (hit, set())
    assert _rewritten(spark, root, batches[0].withColumn("processed_timestamp", F.lit(ts("2024-07-01")))) == (hit, set())
    # Earlier stamps count, and so does a batch with one more row.
    earlier = batches[0].withColumn("processed_timestamp", F.lit(ts("2024-05-01")))
    assert _rewritten(spark, root, earlier)[1] and _rewritten(spark, root, batches[0].union(batches[1].limit(1)))[1]
    scd2.land_changes(spark, root, batches[1])
    want = scd2.replay(earlier.unionByName(batches[1]))
    assert sorted(map(str, scd2.read_replayed(spark, root).collect())) == sorted(map(str, want.collect()))


def test_a_landing_moves_whole_events_once_for_the_log_and_once_for_the_history(spark, monkeypatch):
    plans, plain = [], scd2.write_table

    def watched(df, *args, **options):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        plain(df, *args, **options)

    monkeypatch.setattr(scd2, "write_table", watched)
    root = folder()
    for batch in (random_events(7, 40), random_events(8, 40)):
        scd2.land_changes(spark, root, events(spark, batch), buckets=4)
    moves = [sum("Repartition" in line or "RebalancePartitions" in line for line in p.splitlines()) for p in plans]
    assert moves == [1, 1, 1, 1] and not any("Join" in p for p in plans)


def test_hot_products_are_cut_without_a_join_of_whole_events(spark):
    rows = events(spark, random_events(9, 300))
    plan = plan_of(scd2.replay(rows, limit=20)).split("== Initial Plan ==")[0]
    wide = [line for line in plan.splitlines() if "hashpartitioning" in line and "__carry" not in line]
    assert sum("REPARTITION_BY_COL" in line for line in wide) == 1
    assert "SortMergeJoin" not in plan


def test_events_without_a_time_come_first(spark):
    rows = [("p", "I", None, "1"), ("p", "U", "2024-01-02 00:00:00", "2"), ("p", "D", None, "3")]
    got = {r.price: (r.effective_from, r.effective_to, r.is_current) for r in scd2.replay(events(spark, rows)).collect()}
    # Both events without a time go by their price; the delete ends the insert at no known time.
    assert got == {1.0: (None, None, False), 2.0: (ts("2024-01-02"), None, True)}


# ---- ordered windows over hot keys


@pytest.mark.parametrize("limit", [10**9, 40])
def test_blocks_equal_the_plain_window(spark, limit):
    rng = random.Random(3)
    rows = [(rng.choice(["hot"] * 6 + ["a", None]), rng.choice([None, *range(30)]), i, rng.choice([None, i])) for i in range(400)]
    df = spark.createDataFrame(rows, "key string, at int, id int, value int")
    got = blocks.with_window(df, ["key"], ["at", "id"], {"before": "value"}, "number", limit, 8)
    from pyspark.sql import Window

    w = Window.partitionBy("key").orderBy("at", "id")
    want = df.withColumns({"before": F.lag("value").over(w), "number": F.row_number().over(w).cast("bigint")})
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    cond, value = F.col("value") % 7 == 0, F.col("value")
    ahead = blocks.next_where(df, ["key"], ["at", "id"], cond, value, "next", limit, 8)
    full = w.rowsBetween(1, Window.unboundedFollowing)
    want = df.withColumn("next", F.first(F.when(cond, F.struct(value.alias("value"))), ignorenulls=True).over(full))
    assert sorted(map(str, ahead.collect())) == sorted(map(str, want.collect()))


def test_a_hot_key_is_windowed_by_several_tasks(spark, hot):  # noqa: F811
    orders, _ = hot
    cut, any_hot = blocks.in_blocks(orders, ["product_id"], ["order_timestamp"], limit=5000, blocks=16)
    assert any_hot
    sizes = {r[0]: r[1] for r in cut.where("product_id = 'p-hot'").groupBy(blocks.BLOCK).count().collect()}
    assert len(sizes) == 16 and max(sizes.values()) < 2 * 20_000 / 16
    assert cut.where("product_id <> 'p-hot'").select(blocks.BLOCK).distinct().count() == 1
    plan = plan_of(blocks.with_window(orders, ["product_id"], ["order_timestamp", "order_id"], {"x": "quantity"}, limit=5000))
    assert "hashpartitioning(product_id" in plan and f"{blocks.BLOCK}#" in plan.split("hashpartitioning(product_id")[-1][:80]


def test_blocks_are_as_many_as_a_hot_key_needs(spark):
    df = spark.range(4000).select(F.when(F.col("id") < 110, "a").otherwise("b").alias("key"), F.col("id").alias("at"))
    cut, _ = blocks.in_blocks(df, ["key"], ["at"], limit=100, blocks=64)
    found = {r[0]: r[1] for r in cut.groupBy("key").agg(F.count_distinct(blocks.BLOCK)).collect()}
    assert found == {"a": 5, "b": 64}


def test_rows_of_a_hot_window_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    df = spark.range(500).selectExpr("string(id % 2) AS key", "id AS at").mapInArrow(seen, "key string, at long")
    assert blocks.with_window(df, ["key"], ["at"], {"before": "at"}, "number", limit=50).count() == 500
    assert made.value == 500


def test_text_cannot_be_cut(spark):
    with pytest.raises(TypeError, match="blocks need"):
        blocks.in_blocks(spark.createDataFrame([("a", "b")] * 3, "k string, o string"), ["k"], ["o"], limit=1)


# ---- distinct counts that add up


def clicks_of(spark, n=4000, seed=1):
    rng = random.Random(seed)
    rows = [(rng.choice([f"s{i}" for i in range(60)] + [None]), rng.choice([f"c{i}" for i in range(25)] + [None]),
             rng.choice(["view_product", "add_to_cart", "checkout", "purchase", "other", None]),
             rng.choice(["p", "q", None]), rng.choice([None] + [f"2024-0{m}-0{d} 10:00:00" for m in (1, 2) for d in (1, 2, 3)]))
            for _ in range(n)]
    return frame(spark, schemas.CLICKSTREAM, rows)


def test_ranges_of_day_cells_equal_distinct_counts(spark):
    clicks, root = clicks_of(spark), folder()
    first = F.coalesce(F.dayofmonth("event_timestamp") > 1, F.lit(False))
    for part in (first, ~first):
        refresh.land_clicks(spark, root, clicks.where(part))
    cells = readers.read_table(spark, root + "/cells")
    day = F.to_date("event_timestamp")
    for lo, hi in ((None, None), (dt.date(2024, 1, 2), dt.date(2024, 2, 1)), (dt.date(2024, 2, 2), None)):
        own = clicks
        own = own if lo is None else own.where(day >= F.lit(lo))
        own = own if hi is None else own.where(day <= F.lit(hi))
        want = gold.gold_conversion_funnel(own, "2024-06-01")
        got = refresh.funnel_between(cells, lo, hi, "2024-06-01")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = plan_of(refresh.funnel_between(cells, dt.date(2024, 2, 1), None, "2024-06-01"))
    assert "Expand" not in plan and "event_month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    made = plan_of(refresh.funnel_cells(clicks, *(bitmaps.dictionary(spark, f"{root}/{k}_ids") for k in ("customer", "session"))))
    assert "Expand" not in made and stages(made).count("Scan ") <= 3


def test_numbers_have_no_gaps_and_stay(spark):
    root = folder() + "/ids"
    keys = lambda lo, hi: spark.range(lo, hi).select(F.concat(F.lit("k"), F.col("id") % 900))
    one = {r.key: r.id for r in bitmaps.extend(spark, root, keys(0, 500), parts=16).collect()}
    two = {r.key: r.id for r in bitmaps.extend(spark, root, keys(300, 2000), parts=16).collect()}
    assert sorted(one.values()) == list(range(1, 501)) and sorted(two.values()) == list(range(1, 901))
    assert all(two[k] == v for k, v in one.items())
    assert bitmaps.extend(spark, root, spark.createDataFrame([(None,)], "k string")).count() == 900


# ---- daily sales day by day


def sales_case(spark, seed):
    rng = random.Random(seed)
    days = [f"2024-0{m}-{d:02d} 08:00:00" for m in (1, 2, 3) for d in (1, 15, 28)]
    rows = [(f"o{i}", rng.choice(["c1", "c2", "c3", None]), rng.choice(["p1", "p2", "p3", "gone", None]), rng.randint(1, 5), 2,
             rng.randint(1, 90), "UPI", "Placed", rng.choice([*days, None])) for i in range(150)]
    orders = frame(spark, schemas.ORDERS, rows)
    products = frame(spark, schemas.PRODUCTS, [
        (p, "n", k, "s", b, 1, 2, 3, "2024-01-01", "true") for p, k, b in (("p1", "k1", "b1"), ("p2", "k1", None), ("p3", "k2", "b1"))])
    return orders, products, sorted({d[:10] for d in days})


@pytest.mark.parametrize("seed", range(2))
def test_late_days_equal_the_full_run(spark, seed):
    orders, products, days = sales_case(spark, seed)
    rng, root = random.Random(seed), folder()
    late = rng.sample(days, 3)
    day = F.to_date("order_timestamp")
    there = ~F.coalesce(F.date_format(day, "yyyy-MM-dd").isin(late), F.lit(False))
    full = lambda o: sorted(map(str, gold.gold_daily_sales(o, products, "2024-04-01", "2024-04-02").collect()))
    refresh.store_sales(gold.gold_daily_sales(orders.where(there), products, "2024-04-01", "2024-04-02"), root)
    for name in late:
        one = dt.date.fromisoformat(name)
        refresh.refresh_sales(spark, root, one, orders, products, "2024-04-01", "2024-04-02")
    assert sorted(map(str, refresh.read_sales(spark, root).drop(refresh.MONTH).collect())) == full(orders)
    # A day landed again with fewer orders, and one whose orders are gone.
    again, gone = dt.date.fromisoformat(late[0]), dt.date.fromisoformat(late[1])
    fewer = orders.where(~F.coalesce((day == F.lit(again)) & (F.crc32("order_id") % 3 > 0), F.lit(False)))
    fewer = fewer.where(~F.coalesce(day == F.lit(gone), F.lit(False)))
    for one in (again, gone):
        refresh.refresh_sales(spark, root, one, fewer, products, "2024-04-01", "2024-04-02")
    assert sorted(map(str, refresh.read_sales(spark, root).drop(refresh.MONTH).collect())) == full(fewer)


def test_only_the_day_and_its_successors_are_restamped(spark):
    orders, products, days = sales_case(spark, 9)
    root = folder()
    refresh.store_sales(gold.gold_daily_sales(orders, products, "2024-04-01", "2024-04-02"), root)
    day = dt.date.fromisoformat(days[4])
    months = refresh.refresh_sales(spark, root, day, orders, products, "2024-04-01", "2024-05-05")
    changed = refresh.read_sales(spark, root).where("processed_timestamp = timestamp('2024-05-05')")
    per_group = changed.groupBy("category", "brand").agg(F.count("*").alias("n"), F.min("sale_date").alias("d")).collect()
    assert per_group and all(r.n <= 2 and r.d == day for r in per_group)
    assert set(months) <= {"2024-02", "2024-03"}
    assert sorted(map(str, refresh.read_sales(spark, root).drop("processed_timestamp", "month", "day").collect())) == sorted(
        map(str, gold.gold_daily_sales(orders, products, "2024-04-01", "2024-05-05")
            .withColumn(refresh.MONTH, F.coalesce(F.date_format("sale_date", "yyyy-MM"), F.lit("none")))
            .drop("processed_timestamp", "month", "day").collect()))


def test_a_mart_may_begin_with_a_single_day(spark):
    orders, products, days = sales_case(spark, 4)
    root, own = folder() + "/m", F.to_date("order_timestamp")
    for name in reversed(days):
        refresh.refresh_sales(spark, root, dt.date.fromisoformat(name), orders, products, "2024-04-01", "2024-04-02")
    want = gold.gold_daily_sales(orders.where(own.isNotNull()), products, "2024-04-01", "2024-04-02")
    assert sorted(map(str, refresh.read_sales(spark, root).drop(refresh.MONTH).collect())) == sorted(map(str, want.collect()))


# ---- feeds of several headers


def lines(path, name, *rows):
    import os

    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as out:
        out.write("\n".join(rows) + "\n")


def test_header_generations(spark):
    root = folder()
    lines(f"{root}/year=2024/month=1/day=1", "a b.csv", "payment_id,order_id,amount", "1,o1,5", "2,o2,")
    lines(f"{root}/year=2024/month=1/day=2", "b.csv", "amount,order,payment_id,extra", "7,o3,3,x")
    lines(f"{root}/year=2024/month=2/day=1", "c.csv", "order_id,payment_id", '"o,4",4')
    lines(f"{root}/year=2024/month=2/day=1", "d.csv", "order_id,payment_id")
    open(f"{root}/year=2024/month=2/day=1/e.csv", "w").close()
    schema = schemas._struct("payment_id string, order_id string, amount double, currency string")
    got = readers.read_csv_generations(spark, root, schema, ("payment_id",), {"order": "order_id"})
    assert got.columns == ["payment_id", "order_id", "amount", "currency", "year", "month", "day"]
    assert sorted(tuple(r) for r in got.collect()) == [
        ("1", "o1", "5", None, 2024, 1, 1), ("2", "o2", None, None, 2024, 1, 1),
        ("3", "o3", "7", None, 2024, 1, 2), ("4", "o,4", None, None, 2024, 2, 1)]
    with pytest.raises(schemas.ContractError, match="amount"):
        readers.read_csv_generations(spark, root, schema, ("amount",), {"order": "order_id"})
    with pytest.raises(schemas.ContractError, match="twice"):
        readers.read_csv_generations(spark, root, schema, (), {"extra": "amount"})
    lines(f"{root}/year=2024/month=2/day=2", "f.csv", "order_id,payment_id", "o5,5,more")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_csv_generations(spark, root, schema).collect()
    aside = readers.read_csv_generations(spark, root, schema, on_bad_record="aside")
    assert [r[readers.CORRUPT] for r in readers.set_aside(aside).collect()] == ["o5,5,more"]


# ---- stored layouts


def test_bucketed_tables_join_without_an_exchange(spark, hot):  # noqa: F811
    orders, products = hot
    names = ["lakemart_test_orders", "lakemart_test_products"]
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    writers.create_bucketed(orders, names[0], "product_id", 4)
    writers.create_bucketed(products, names[1], "product_id", 4)
    with small_partitions(spark):
        joined = derive.enrich_orders(spark.table(names[0]), spark.table(names[1]), ("brand",))
        plan = plan_of(basic.top_products(joined))
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        got = basic.top_products(joined).collect()
    assert sorted(map(str, got)) == sorted(map(str, basic.top_products(derive.enrich_orders(orders, products, ("brand",))).collect()))
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def test_a_filtered_calendar_prunes_the_fact(spark, hot):  # noqa: F811
    orders, products = hot
    root = folder()
    fact = star.fact_orders(orders.withColumn("processed_timestamp", F.current_timestamp()))
    days = fact.withColumn("order_timestamp", F.date_add(F.to_date("order_timestamp"), (F.crc32("order_id") % 400).cast("int")).cast("timestamp"))
    writers.write_table(star.with_order_month(days), root + "/fact", "overwrite", [star.ORDER_MONTH])
    star.dim_date(days).write.parquet(root + "/calendar")
    stored, calendar = spark.read.parquet(root + "/fact"), spark.read.parquet(root + "/calendar")
    report = star.revenue_of_period(stored, products, calendar, (F.col("year") == 2024) & (F.col("quarter") == 2))
    plan = plan_of(report)
    assert "dynamicpruning" in plan.lower()
    full = star.revenue_by_month_category(days, products, calendar)
    want = full.where("year = 2024 AND month_name IN ('April', 'May', 'June')")
    assert sorted(map(str, report.collect())) == sorted(map(str, want.collect()))


# ---- writes behind checks


def test_refused_rows_leave_the_day_as_it_was(spark):
    root, day = folder() + "/t", dt.date(2024, 5, 1)
    rows = lambda n, **more: spark.range(n).select(
        "id", (F.col("id") % 9).alias("v"), F.lit(2024).alias("year"), F.lit(5).alias("month"), F.lit(1).alias("day"))
    checks = writers.Checks(key=("id",), not_null=("v",), ranges={"v": (0, 8)}, max_change=0.2)
    found = writers.write_checked(rows(100), root, day, checks)
    assert found == {"rows": 100, "nulls v": 0, "outside v": 0, "repeats": 0}
    bad = {
        "nulls v": rows(100).withColumn("v", F.when(F.col("id") > 3, F.col("v"))),
        "outside v": rows(100).withColumn("v", F.col("v") + 1),
        "repeats": rows(100).withColumn("id", F.col("id") % 98),
        "change": rows(79),
        "rows": rows(0),
    }
    for what, df in bad.items():
        with pytest.raises(writers.Refused) as refused:
            writers.write_checked(df, root, day, checks)
        assert what in refused.value.broken
        assert readers.read_table(spark, root).agg(F.sum("id"), F.count("*")).first() == (4950, 100)
    assert writers.write_checked(rows(90), root, day, checks)["rows"] == 90
    assert readers.read_table(spark, root).count() == 90
    loose = writers.Checks(key=("id",), max_repeats=2, min_rows=0)
    assert writers.write_checked(bad["repeats"], root, day, loose)["repeats"] == 2
    assert readers.read_table(spark, root).columns == ["id", "v", "year", "month", "day"]
