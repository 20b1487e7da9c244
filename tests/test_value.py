import pytest
from pyspark.sql import functions as F

from counterfoil.functions import constants as C
from counterfoil.operators import policies, reports, value
from counterfoil.sources.storage import store

TERMS = value.Terms("X", 100.0, 60.0, 0.2, 0.5)


@pytest.fixture(scope="module")
def rows(spark):
    scored = [
        ("a", "High Value", 3, 10.0, 0.9, 0.2, 0.9 - 0.2),
        ("b", "High Value", 3, 10.0, 0.6, 0.3, 0.6 - 0.3),
        ("c", "Occasional", 3, 10.0, 0.5, 0.52, 0.5 - 0.52),
        ("d", "Occasional", 3, 10.0, 0.1, 0.7, 0.1 - 0.7),
        ("e", "Occasional", 3, 10.0, 0.3, 0.3, 0.0),
    ]
    df = spark.createDataFrame(
        scored,
        "customer_id string, customer_taxonomies string, recency_days bigint, "
        "total_spend double, p_treatment double, p_control double, uplift double",
    )
    return store(value.targeting_rows(df, [TERMS]), "rows")


def test_worked_example(rows):
    r = rows.filter("customer_id = 'b'").first()
    assert (r.expected_incremental_revenue, r.expected_incremental_profit) == (18.0, -0.5)


def test_revenue_less_profit_is_goods_and_sending(rows):
    gap = (
        F.col("expected_incremental_revenue")
        - F.col("expected_incremental_profit")
        - (F.col("uplift_score") * TERMS.cogs + TERMS.campaign_cost)
    )
    assert rows.filter(F.abs(gap) > 0.011).count() == 0


def test_quadrants_and_actions(rows):
    found = {r.customer_id: (r.uplift_segment, r.recommended_action) for r in rows.collect()}
    assert found == {
        "a": (C.PERSUADABLE, C.TARGET),
        "b": (C.PERSUADABLE, C.SKIP),
        "c": (C.SURE_THING, C.DO_NOT_DISTURB),
        "d": (C.SLEEPING_DOG, C.DO_NOT_DISTURB),
        "e": (C.LOST_CAUSE, C.SKIP),
    }


def test_promotions_multiply_customers_only(rows, spark):
    scored = spark.createDataFrame([(1, 0.4, 0.1, 0.3)], "customer_id int, p_treatment double, p_control double, uplift double")
    many = [value.Terms(f"P{i}", 10.0 * (i + 1), 5.0, 0.1) for i in range(3)]
    assert value.promotion_values(scored, many).count() == 3


def test_kpis_equal_a_row_by_row_count(rows):
    scenario = value.Scenario(7, 120.0, 0.1, 60.0, 0.25)
    listed = value.what_if(rows, scenario).collect()
    k = value.campaign_kpis(rows, [value.Scenario(0, 1.0, 0.0, 0.0, 0.0), scenario])
    k = k.filter("scenario_id = 7").first()
    chosen = [r for r in listed if r.recommended_action == C.TARGET]
    assert k.n_customers == 5 and k.n_target == len(chosen)
    assert k.n_target + k.n_sleeping + k.n_skip == 5
    assert k.uniform_profit == pytest.approx(sum(r.expected_incremental_profit for r in listed))
    assert k.optimized_revenue == pytest.approx(
        sum(r.expected_incremental_revenue for r in chosen)
    )
    assert k.spend_saved == pytest.approx(
        sum(0.25 + 12 * r.p_buy_treatment for r in listed if r not in chosen)
    )


def test_kpis_without_customers_or_uniform_profit(rows):
    k = value.campaign_kpis(rows.limit(0), [value.Scenario(0, 10.0, 0.1, 5.0)]).first()
    assert k.n_customers == 0 and k.profit_lift_pct == 0.0 and k.waste_saved_pct == 0.0
    k = value.campaign_kpis(rows, [value.Scenario(0, 0.0, 0.0, 0.0, 0.0)]).first()
    assert k.uniform_profit == 0.0 and k.profit_lift_pct == 0.0


def test_unknown_promotion_is_refused(spark):
    promos = spark.createDataFrame([("X", 0.1, "P")], "promotion_id string, discount double, product_id string")
    products = spark.createDataFrame([("P", 9.0, 5.0)], "product_id string, price double, cogs double")
    assert value.promotion_terms(promos, products, ["X"])[0].price == 9.0
    with pytest.raises(ValueError):
        value.promotion_terms(promos, products, ["X", "Y"])


@pytest.mark.parametrize(
    "profits", [[3.0, -1.0, 2.0, 0.0], [-1.0, -2.0], [0.0, 0.0, -1.0], [1.0], [2.5, 2.5, 2.5]]
)
def test_best_cutoff_equals_the_top_of_the_curve(spark, profits):
    df = store(
        spark.createDataFrame(
            [(i, 1.0, p) for i, p in enumerate(profits)],
            "customer_id int, expected_incremental_revenue double, "
            "expected_incremental_profit double",
        ),
        "p",
    )
    curve = policies.profit_curve(df).collect()
    assert [r.n_pop for r in sorted(curve, key=lambda r: r.n_pop)] == list(
        range(1, len(profits) + 1)
    )
    top = min(curve, key=lambda r: (-r.cum_profit, r.n_pop))
    cut = policies.best_cutoff(df).first()
    assert (cut.n_pop, cut.max_profit, cut.pct_population) == (
        top.n_pop,
        top.cum_profit,
        top.pct_population,
    )


def test_policies_agree_with_their_masks(rows):
    masks = {"all": F.lit(True), "none": F.lit(False), "a": F.col("customer_id") == "a"}
    found = {r.policy: r for r in policies.policy_report(rows, masks, TERMS).collect()}
    assert found["all"].n_targeted == 5 and found["all"].spend_saved_pct == 0.0
    assert found["none"].revenue == 0.0 and found["none"].spend_saved_pct == 100.0
    assert found["a"].spend == 0.5 + 20 * 0.9
    assert found["all"].revenue < 0 and found["a"].revenue_uplift_pct is None


def test_top_share_list_is_ranked(rows):
    got = policies.top_share_list(rows, "0.4").collect()
    assert sorted((r.n_pop, r.customer_id) for r in got) == [(1, "a"), (2, "b")]


def test_reports_of_a_scenario_agree(rows):
    """What-if money has eight decimals; all reports add it up without rounding a row."""
    scenario = value.Scenario(0, 33.33, 0.17, 12.34)
    tried = value.what_if(rows, scenario)
    kpis = value.campaign_kpis(rows, [scenario]).first()
    terms = value.Terms("X", 33.33, 12.34, 0.17, scenario.campaign_cost)
    keep = {"all": F.lit(True), "targets": F.col("recommended_action") == C.TARGET}
    told = {r.policy: r for r in policies.policy_report(tried, keep, terms).collect()}
    assert told["all"].profit == kpis.uniform_profit
    assert told["all"].revenue == kpis.uniform_revenue
    assert told["targets"].profit == kpis.optimized_profit
    by_segment = {r[0]: r[1] for r in reports.segment_profit(tried).collect()}
    assert sum(by_segment.values()) == pytest.approx(kpis.uniform_profit, abs=1e-9)
    assert kpis.uniform_profit != round(kpis.uniform_profit, 4)
