"""Every registered query against its SQL counterpart, and the shape of the plans."""

import duckdb
import pytest

import __spark_entry__ as registry
from counterfoil.plans import queries
from counterfoil.plans.oracle import SQL
from counterfoil.sources.binding import FILES, Retail

TREE_LISTS = ["tlearner_forest", "tlearner_gbt"]
ROWS_ONLY = {
    *TREE_LISTS,
    "qini_forest",
    "qini_gbt",
    "crossfit_qini_forest",
    "crossfit_qini_gbt",
}
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def oracle(medium):
    connection = duckdb.connect()
    for table in [*FILES, "region"]:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{medium}/{table}.parquet'")
    return connection


def test_all_but_the_tree_models_have_sql():
    assert set(queries.QUERIES) - set(SQL) == ROWS_ONLY
    assert set(queries.QUERIES) <= set(registry.queries()) and set(SQL) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, medium, oracle, name):
    df = registry.queries()[name](spark, medium)
    columns = sorted(df.columns)
    got = [tuple(repr(r[c]) for c in columns) for r in df.collect()]
    cursor = oracle.execute(SQL[name])
    types = {d[0]: str(d[1]) for d in cursor.description}
    names = [d[0] for d in cursor.description]
    want = [
        tuple(repr(v) for _, v in sorted(zip(names, r, strict=True))) for r in cursor.fetchall()
    ]
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == types
    assert got and sorted(got) == sorted(want)


@pytest.mark.parametrize("name", TREE_LISTS)
def test_tree_lists_hold_every_customer(spark, small, name):
    rows = registry.queries()[name](spark, small).collect()
    assert len(rows) == len({r.customer_id for r in rows}) == 150
    profits = [r.expected_incremental_profit for r in rows]
    assert profits == sorted(profits, reverse=True)


def test_tree_qini_equals_a_plain_sort(spark, small):
    rows = sorted(registry.queries()["qini_forest"](spark, small).collect(), key=lambda r: r.n_pop)
    ordered = sorted(rows, key=lambda r: (-r.score, r.customer_id))
    assert [r.customer_id for r in rows] == [r.customer_id for r in ordered]
    assert len({r.score for r in rows}) > 50
    n_t = y_t = y_c = 0
    for place, r in enumerate(rows, 1):
        n_t, y_t, y_c = n_t + r.w, y_t + r.y * r.w, y_c + r.y * (1 - r.w)
        n_c = place - n_t
        assert r.qini == (y_t - y_c * (n_t / n_c) if n_c else y_t)
    assert len(rows) == 150


def test_entry(spark):
    assert registry.entry(spark).count() == 150


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """As at a size where neither side of a join fits in memory."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_features_shuffle_each_input_once(spark, small, no_broadcast):
    text = plan(Retail(spark, small).features)
    # lines per order, orders, baskets per customer, customers
    assert text.count("Exchange hashpartitioning") == 4
    assert "Expand" not in text and "SinglePartition" not in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double," in text
    assert "o_totalprice" not in text and "LessThan(o_orderdate" in text


def test_labels_shuffle_the_log_and_the_purchases_once(spark, small, no_broadcast):
    text = plan(Retail(spark, small).campaign)
    assert text.count("Exchange hashpartitioning(customer_id") == 2
    assert text.count("Exchange hashpartitioning") == 2
    joined = plan(queries.experiment.training_set(
        Retail(spark, small).campaign, Retail(spark, small).features
    ))
    # the two of the labels, the four of the features
    assert joined.count("Exchange hashpartitioning") == 6


def test_no_query_plans_a_cartesian_product_or_python(spark, small, no_broadcast):
    for name in ("star_join", "response_label", "value_scores", "whatif_grid", "category_pivot"):
        text = plan(registry.queries()[name](spark, small))
        assert "CartesianProduct" not in text and "Python" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name


def test_pivots_shuffle_lines_by_product_and_then_by_order(spark, small, no_broadcast):
    text = plan(registry.queries()["category_pivot"](spark, small))
    # lines by product, products, lines per order, orders, customers' sums, customers
    assert text.count("Exchange hashpartitioning") == 6
    assert "Expand" not in text and "Generate" not in text
    assert text.count("Exchange hashpartitioning(l_orderkey") == 1


def test_top100_does_not_sort_everything(spark, small):
    assert "TakeOrderedAndProject(limit=100" in plan(registry.queries()["top100"](spark, small))
