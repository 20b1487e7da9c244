"""Features as of many dates: against one run per date, brute force, leaks, skew, plan."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from counterfoil.operators import asof, experiment, features
from counterfoil.plans import pipeline
from counterfoil.plans.queries import QUERIES
from counterfoil.sources.catalog import SCHEMAS

DATES = [date(2026, 3, 1), date(2026, 4, 15), date(2026, 6, 1)]
LOG = "customer_id string, reference_date date"


def lines(seed, count=600, customers=12):
    """Baskets whose lines lie minutes to months apart, with nulls and odd promotions."""
    draw = random.Random(seed)
    out = []
    for _ in range(count):
        customer = draw.choice([f"C{i}" for i in range(customers)] + ["C0"] * customers + [None])
        basket = draw.choice([None, *[f"{customer}-{k}" for k in range(25)]])
        moment = datetime(2026, 1, 1) + timedelta(minutes=draw.randint(0, 160 * 24 * 60))
        if draw.random() < 0.2:
            moment = datetime.combine(moment.date(), datetime.min.time())  # midnight, an edge
        out.append((moment, "P", draw.randint(1, 999) / 100, draw.randint(1, 4), customer,
                    draw.choice([None, "", "X"]), "S", basket))
    return out


@pytest.fixture(scope="module")
def customers(spark):
    rows = [(f"C{i}", ["High Value", "Occasional", "Other"][i % 3]) for i in range(14)]
    return spark.createDataFrame(rows, SCHEMAS["customers"])


def as_of(transactions, log, customers):
    return asof.features_as_of(asof.day_buckets(asof.basket_days(transactions)), log, customers)


def keyed(rows):
    return {(r["customer_id"], r["reference_date"]): r.asDict() for r in rows}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equal_to_one_run_per_date(spark, customers, seed):
    transactions = spark.createDataFrame(lines(seed), SCHEMAS["transactions"]).repartition(3)
    log = customers.select("customer_id").crossJoin(
        spark.createDataFrame([(d,) for d in DATES], "reference_date date")
    )
    got = keyed(as_of(transactions, log, customers).collect())
    assert len(got) == 14 * len(DATES)
    for day in DATES:
        for r in features.rfm_features(transactions, customers, day.isoformat()).collect():
            assert got.pop((r["customer_id"], day)) == r.asDict() | {"reference_date": day}
    assert not got


def test_a_basket_on_many_days_counts_once_per_window(spark, customers):
    """Days 0, 10, 29 and 70 of one basket: chains shorter and longer than the window."""
    start = datetime(2026, 1, 1)
    rows = [(start + timedelta(days=d), "P", 1.0, 1, "C1", "", "S", "b") for d in (0, 10, 29, 70)]
    rows += [(start + timedelta(days=5), "P", 1.0, 1, "C1", "", "S", None)]
    transactions = spark.createDataFrame(rows, SCHEMAS["transactions"])
    days = [start.date() + timedelta(days=d) for d in range(0, 130)]
    log = spark.createDataFrame([("C1", d) for d in days], LOG)
    got = keyed(as_of(transactions, log, customers).collect())
    for n, day in enumerate(days):
        r = got["C1", day]
        seen = [d for d in (0, 10, 29, 70) if d < n]
        assert r["frequency_30d"] == int(any(d >= n - 30 for d in seen)), n
        assert r["total_visits"] == int(bool(seen))
        assert r["total_items"] == len(seen) + (n > 5)


def test_odd_log_rows(spark, customers):
    transactions = spark.createDataFrame(lines(4, 50), SCHEMAS["transactions"])
    log = spark.createDataFrame(
        [("C1", DATES[0]), ("C1", DATES[0]), (None, DATES[0]), ("C2", None), ("nobody", DATES[0]),
         ("C13", DATES[1])],
        LOG,
    )
    got = as_of(transactions, log, customers).collect()
    assert sorted((r.customer_id, r.reference_date) for r in got) == [("C1", DATES[0]), ("C13", DATES[1])]
    never = keyed(got)["C13", DATES[1]]
    assert (never["recency_days"], never["total_spend"], never["frequency_30d"]) == (180, 0.0, 0)
    empty = spark.createDataFrame([], SCHEMAS["transactions"])
    assert keyed(as_of(empty, log, customers).collect())["C1", DATES[0]]["recency_days"] == 180


def campaign_rows(spark, starts):
    promotions = spark.createDataFrame(
        [(f"P{i}", 0.2, "X", d, d) for i, d in enumerate(starts)], SCHEMAS["promotions"]
    )
    log = spark.createDataFrame(
        [(f"K{i}", f"C{c}", f"P{i}", c % 2, (c + i) % 3 // 2) for i in range(len(starts)) for c in range(12)],
        SCHEMAS["campaign"],
    )
    return promotions, log


def test_no_row_sees_beyond_its_own_start(spark, customers):
    """Whatever happens on or after a campaign's start leaves the features of its rows alone."""
    promotions, log = campaign_rows(spark, DATES[:2])
    dated = asof.with_start(log, promotions)
    history = lines(6)

    def rows(kept):
        transactions = spark.createDataFrame(kept, SCHEMAS["transactions"])
        return keyed(as_of(transactions, dated, customers).collect())

    full = rows(history)
    for day in DATES[:2]:
        before = rows([x for x in history if x[0].date() < day])
        mine = {k: v for k, v in full.items() if k[1] == day}
        assert mine and mine == {k: before[k] for k in mine}
    later = {k: v for k, v in full.items() if k[1] == DATES[1]}
    assert any(v["total_spend"] != full[k[0], DATES[0]]["total_spend"] for k, v in later.items())


def test_rows_without_a_start_have_no_date(spark):
    promotions, log = campaign_rows(spark, [DATES[0], None])
    dated = asof.with_start(log, promotions).collect()
    assert {(r.promotion_id, r.reference_date) for r in dated} == {("P0", DATES[0]), ("P1", None)}


def test_the_batch_job_takes_each_campaign_as_of_its_start(spark, customers, tmp_path):
    promotions, log = campaign_rows(spark, DATES[:2])
    tables = {
        "transactions": spark.createDataFrame(lines(7), SCHEMAS["transactions"]),
        "customers": customers,
        "campaign": log,
        "promotions": promotions,
        "products": spark.createDataFrame([("X", 10.0, 4.0, "A")], SCHEMAS["products"]),
    }
    run = lambda how: pipeline.run_scoring(
        tables, str(tmp_path / how), "2026-06-01", ["P0"], pipeline.StratifiedTLearner(), as_of=how
    )
    own, one = run("start"), run("reference")
    assert sorted(own.people.select(one.people.columns).collect()) == sorted(one.people.collect())
    wanted = {
        d: {r.customer_id: r.total_spend for r in features.rfm_features(
            tables["transactions"], customers, d.isoformat()).collect()}
        for d in DATES[:2]
    }
    pilot = own.pilot.collect()
    assert len(pilot) == log.count()
    assert all(r.total_spend == wanted[DATES[int(r.promotion_id[1])]][r.customer_id] for r in pilot)
    with pytest.raises(ValueError, match="midnight"):
        pipeline.run_scoring(tables, str(tmp_path / "x"), "2026-06-01 12:00", ["P0"], as_of="start")
    with pytest.raises(ValueError, match="as_of"):
        pipeline.run_scoring(tables, str(tmp_path / "x"), "2026-06-01", ["P0"], as_of="never")


def test_a_hot_customer_shrinks_to_days(spark):
    """A third of all lines are one customer's: one row per day reaches the running totals."""
    transactions = spark.range(6000).select(
        F.expr("timestamp_ntz '2026-01-01 00:00:00' + make_dt_interval(cast(id % 90 as int))").alias("datetime"),
        F.lit(1.0).alias("price"),
        F.lit(1).alias("qty"),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.col("id").cast("string")).alias("customer_id"),
        F.lit("").alias("promotion_id"),
        F.col("id").cast("string").alias("po_id"),
    )
    buckets = asof.day_buckets(asof.basket_days(transactions))
    assert buckets.filter("customer_id = 'HOT'").count() <= 90
    assert buckets.agg(F.sum("lines")).first()[0] == 6000


def test_one_scan_serves_all_dates(spark, small):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = QUERIES["features_as_of"](spark, small)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert text.count("ReadSchema: struct<l_orderkey") == 1
    assert text.count("ReadSchema: struct<o_orderkey") == 1
    # Only the few promotions meet in one task, to be limited.
    assert text.count("SinglePartition") == text.count("GlobalLimit")
    assert "CartesianProduct" not in text
    # orders, lines per order, customer days, distinct dates, then both by customer, customers;
    # the rest are the promotions' join.
    lines = [x for x in text.split("\n") if "Exchange hashpartitioning" in x]
    assert len([x for x in lines if "promotion_id" not in x]) <= 7


def test_lines_are_joined_added_up_and_chained_in_tasks_of_their_own(spark, small):
    """Where the join's rows already lie by basket, one task would hold all its sorts and sums."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = QUERIES["features_as_of_lines"](spark, small)._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    steps = plan.toString().split("\n")
    joined = next(i for i, x in enumerate(steps) if "SortMergeJoin [l_orderkey" in x)
    chained = max(i for i, x in enumerate(steps[:joined]) if " Window [" in x)
    between = [x for x in steps[chained:joined] if "Exchange" in x or "HashAggregate" in x]
    kinds = ["Exchange" if "Exchange" in x else "HashAggregate" for x in between]
    assert kinds == ["Exchange", "HashAggregate", "Exchange", "HashAggregate"]
