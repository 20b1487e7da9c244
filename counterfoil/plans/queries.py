"""The registered queries: each takes (spark, folder of the test tables)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from counterfoil.functions import constants as C
from counterfoil.functions import expressions as E
from counterfoil.operators import (
    allocation,
    asof,
    bootstrap,
    crossfit,
    evaluation,
    experiment,
    features,
    joins,
    matching,
    policies,
    ranking,
    reports,
    trees,
    value,
)
from counterfoil.operators.learners import StratifiedTLearner, TreeTLearner
from counterfoil.plans import pipeline
from counterfoil.sources import catalog, publish, sinks
from counterfoil.sources.binding import (
    CAMPAIGN_DAYS,
    CAMPAIGN_ID,
    PAST_PROMOTION,
    PROMOTION_ID,
    PROMOTIONS,
    REFERENCE_DATE,
    Retail,
)
from counterfoil.sources.storage import local_table, new_path, store

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the registered queries.
SUBDAY_REFERENCE = "2024-01-25"
SUBDAY_LABEL_START = "2024-01-15"
CAMPAIGN_STORE = 2
UPLIFT_SHARES = ["0.1", "0.2", "0.3", "0.5"]
PRECISION_SHARE = "0.2"
GRID_PRICES = [0.9, 1.0, 1.1]
GRID_DISCOUNTS = [0.05, 0.10, 0.20]
BASELINE_CATEGORY = "PROMO"
PROFILE_PLACES = 4
WHATIF_DISCOUNT = 0.17
CROSSFIT_FOLDS = 5
BUDGET_PERCENT = 30
BAD_DAY = 13
BOOTSTRAP_REPLICATES = 20
GROUP_DISCOUNT = 0.065
# Groups of so many rows are cut into cells.
GROUP_ROWS = 5_000
TREE_FOLDS = 2
# arm, tree, node, feature, threshold, left, right, value, weight, link: two small ensembles.
SMALL_ENSEMBLE = [
    (1, 0, 0, 0, 60.0, 1, 2, None, 1.0, "logistic"),
    (1, 0, 1, 3, 500000.0, 3, 4, None, 1.0, "logistic"),
    (1, 0, 2, -1, None, -1, -1, -0.625, 1.0, "logistic"),
    (1, 0, 3, -1, None, -1, -1, 0.125, 1.0, "logistic"),
    (1, 0, 4, -1, None, -1, -1, 0.5, 1.0, "logistic"),
    (1, 1, 0, 8, 1.5, 1, 2, None, 0.25, "logistic"),
    (1, 1, 1, -1, None, -1, -1, -0.3, 0.25, "logistic"),
    (1, 1, 2, 7, 0.15, 3, 4, None, 0.25, "logistic"),
    (1, 1, 3, -1, None, -1, -1, 0.2, 0.25, "logistic"),
    (1, 1, 4, -1, None, -1, -1, 0.7, 0.25, "logistic"),
    (0, 0, 0, 1, 0.5, 1, 2, None, 1.0, "mean"),
    (0, 0, 1, -1, None, -1, -1, 0.2, 1.0, "mean"),
    (0, 0, 2, -1, None, -1, -1, 0.55, 1.0, "mean"),
    (0, 1, 0, 6, 100000.0, 1, 2, None, 1.0, "mean"),
    (0, 1, 1, -1, None, -1, -1, 0.1, 1.0, "mean"),
    (0, 1, 2, -1, None, -1, -1, 0.35, 1.0, "mean"),
    (0, 2, 0, -1, None, -1, -1, 0.3, 1.0, "mean"),
]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _terms(retail: Retail, promotion_ids=(PROMOTION_ID,)) -> list[value.Terms]:
    return value.promotion_terms(retail.promotions, retail.products, list(promotion_ids))


def _scoring(spark: SparkSession, folder: str) -> pipeline.Scoring:
    retail = Retail(spark, folder)
    return pipeline.score(retail.features, retail.campaign, _terms(retail))


def _scenario(terms: value.Terms, number: int = 0) -> value.Scenario:
    return value.Scenario(
        number, terms.price, terms.discount_rate, terms.cogs, terms.campaign_cost
    )


# --- tables, features, joins -------------------------------------------------------------


@query
def scan_tables(spark: SparkSession, folder: str) -> DataFrame:
    retail = Retail(spark, folder)
    return catalog.table_summary(
        {
            "customers": (retail.customers, "customer_id"),
            "products": (retail.products, "product_id"),
            "stores": (retail.stores, "store_id"),
            "promotions": (retail.promotions, "promotion_id"),
            "transactions": (retail.transactions, "po_id"),
            "campaign": (retail.dispatch, "customer_id"),
        }
    )


@query
def rfm_features(spark: SparkSession, folder: str) -> DataFrame:
    return Retail(spark, folder).features


@query
def rfm_features_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The same features from a plain table of transaction lines.

    Basket ids are text, as in the catalog. Grouping by them is then a stage of its own, so a
    skewed order can be split in the join before it.
    """
    retail = Retail(spark, folder)
    lines = retail.transactions.withColumn("po_id", F.col("po_id").cast("string"))
    return features.rfm_features(lines, retail.customers, REFERENCE_DATE)


@query
def rfm_features_subday(spark: SparkSession, folder: str) -> DataFrame:
    """Features from events with a time of day, where elapsed and calendar days differ."""
    retail = Retail(spark, folder)
    return features.rfm_features(retail.purchases_subday, retail.customers, SUBDAY_REFERENCE)


@query
def star_join(spark: SparkSession, folder: str) -> DataFrame:
    """Every line, the campaign's purchases included, with its dimensions."""
    retail = Retail(spark, folder)
    return joins.star_join(
        append_campaign(spark, folder),
        retail.customers,
        retail.promotions,
        retail.products,
        retail.stores,
    )


@query
def discount_depth(spark: SparkSession, folder: str) -> DataFrame:
    retail = Retail(spark, folder)
    return joins.discount_depth(retail.transactions, retail.products)


def _pivot(retail: Retail, dimension: DataFrame, line_key: str, key: str, label: str) -> DataFrame:
    """Side by side where the labels are few, from long form where they are many."""
    labels = dimension.select(label)
    try:
        names = features.label_names(labels)
    except features.TooManyLabels:
        parts = retail.spend_parts(dimension, line_key, key, label)
        return features.spend_by(parts, retail.customers, labels)
    sums = retail.spend_sums(dimension, line_key, key, label, names)
    return features.spend_wide(sums, retail.customers, names)


@query
def category_pivot(spark: SparkSession, folder: str) -> DataFrame:
    retail = Retail(spark, folder)
    return _pivot(retail, retail.products, "l_partkey", "product_id", "product_taxonomies")


@query
def store_pivot(spark: SparkSession, folder: str) -> DataFrame:
    retail = Retail(spark, folder)
    return _pivot(retail, retail.stores, "l_suppkey", "store_id", "store_taxonomies")


@query
def features_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer as of the start of each of two campaigns, from one scan."""
    retail = Retail(spark, folder)
    buckets = retail.day_buckets(date.fromisoformat(REFERENCE_DATE))
    return asof.features_as_of(buckets, retail.several_campaigns, retail.customers)


@query
def features_as_of_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The same from lines dated by their shipment: the lines of a basket lie on several days."""
    retail = Retail(spark, folder)
    days = asof.basket_days(retail.shipments, date.fromisoformat(REFERENCE_DATE))
    return asof.features_as_of(asof.day_buckets(days), retail.several_campaigns, retail.customers)


@query
def training_set_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """The log of two campaigns, each row with its own label and the features before its start."""
    retail = Retail(spark, folder)
    labelled = experiment.response_label(
        retail.several_campaigns,
        retail.dated_promotions,
        retail.visits,
        days=CAMPAIGN_DAYS,
        match="any",
    )
    return asof.training_set(labelled, features_as_of(spark, folder))


@query
def feature_profile(spark: SparkSession, folder: str) -> DataFrame:
    stored = store(Retail(spark, folder).features, "features")
    profile = reports.feature_profile(stored, C.FEATURE_COLUMNS)
    # Engines differ in the last bits of means and deviations.
    finer = ["mean", "std", "q25", "q50", "q75"]
    return profile.withColumns({c: E.round_half_even(F.col(c), PROFILE_PLACES) for c in finer})


@query
def feature_head(spark: SparkSession, folder: str) -> DataFrame:
    """The five first customers; only their orders and lines are added up."""
    retail = Retail(spark, folder)
    return retail.features_of(retail.customers.orderBy("customer_id").limit(5))


# --- experiment --------------------------------------------------------------------------


@query
def holdout_assign(spark: SparkSession, folder: str) -> DataFrame:
    customers = Retail(spark, folder).customers
    return experiment.assign_arms(customers, CAMPAIGN_ID).withColumn(
        "fold", experiment.fold(CAMPAIGN_ID)
    )


@query
def response_label(spark: SparkSession, folder: str) -> DataFrame:
    """Label by category of the promoted product."""
    retail = Retail(spark, folder)
    return experiment.response_label(
        retail.dispatch,
        retail.promotions,
        retail.transactions,
        retail.products,
        days=CAMPAIGN_DAYS,
        match="category",
    )


@query
def response_label_product(spark: SparkSession, folder: str) -> DataFrame:
    """Label by the promoted product itself."""
    retail = Retail(spark, folder)
    return experiment.response_label(
        retail.dispatch,
        retail.promotions,
        retail.transactions,
        days=CAMPAIGN_DAYS,
        match="product",
    )


@query
def response_label_7d(spark: SparkSession, folder: str) -> DataFrame:
    """Seven-day label from events with a time of day."""
    retail = Retail(spark, folder)
    promotions = retail.promotions.withColumn(
        "start_date", F.lit(SUBDAY_LABEL_START).cast("date")
    )
    return experiment.response_label(
        retail.dispatch, promotions, retail.purchases_subday, match="any"
    )


@query
def arms_from_fact(spark: SparkSession, folder: str) -> DataFrame:
    retail = Retail(spark, folder)
    return experiment.arms_from_fact(
        retail.customers, retail.transactions, PAST_PROMOTION, REFERENCE_DATE, CAMPAIGN_DAYS
    )


@query
def training_set(spark: SparkSession, folder: str) -> DataFrame:
    retail = Retail(spark, folder)
    return experiment.training_set(retail.campaign, retail.features)


@query
def arm_summary(spark: SparkSession, folder: str) -> DataFrame:
    return experiment.arm_summary(Retail(spark, folder).campaign)


@query
def matched_controls(spark: SparkSession, folder: str) -> DataFrame:
    retail = Retail(spark, folder)
    return experiment.matched_controls(
        experiment.training_set(retail.campaign, retail.features)
    )


def _nearest(spark: SparkSession, folder: str) -> DataFrame:
    return matching.nearest_controls(_pilot(spark, folder))


@query
def nearest_controls(spark: SparkSession, folder: str) -> DataFrame:
    """The nearest control of the same segment for every treated customer, within the caliper."""
    return _nearest(spark, folder)


@query
def nearest_effect(spark: SparkSession, folder: str) -> DataFrame:
    return matching.nearest_effect(_nearest(spark, folder))


@query
def append_campaign(spark: SparkSession, folder: str) -> DataFrame:
    retail = Retail(spark, folder)
    return experiment.append_campaign(
        retail.transactions,
        retail.campaign,
        retail.promotions,
        retail.products,
        CAMPAIGN_STORE,
    )


@query
def append_campaign_twice(spark: SparkSession, folder: str) -> DataFrame:
    """The campaign's purchases put in twice by their order ids: they are there once."""
    retail = Retail(spark, folder)
    bought = experiment.campaign_purchases(
        retail.campaign, retail.promotions, retail.products, CAMPAIGN_STORE
    )
    bought = store(bought, "purchases")
    once = experiment.upsert_lines(retail.transactions, bought)
    return experiment.upsert_lines(once, bought)


# --- scoring and reports -----------------------------------------------------------------


@query
def tlearner_stratified(spark: SparkSession, folder: str) -> DataFrame:
    return _scoring(spark, folder).scored.select(
        "customer_id", "p_treatment", "p_control", "uplift"
    )


@query
def value_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer valued for each of the four promotions."""
    retail = Retail(spark, folder)
    scored = _scoring(spark, folder).scored.select(
        "customer_id", "p_treatment", "p_control", "uplift"
    )
    return value.promotion_values(scored, _terms(retail, PROMOTIONS))


@query
def targeting_list(spark: SparkSession, folder: str) -> DataFrame:
    return value.by_profit(_scoring(spark, folder).rows)


@query
def top100(spark: SparkSession, folder: str) -> DataFrame:
    return value.top_by_profit(_scoring(spark, folder).rows)


@query
def action_counts(spark: SparkSession, folder: str) -> DataFrame:
    return reports.value_counts(_scoring(spark, folder).rows, "recommended_action")


@query
def quadrant_counts(spark: SparkSession, folder: str) -> DataFrame:
    return reports.value_counts(_scoring(spark, folder).rows, "uplift_segment")


@query
def segment_means(spark: SparkSession, folder: str) -> DataFrame:
    return reports.segment_means(_scoring(spark, folder).rows)


@query
def segment_profit(spark: SparkSession, folder: str) -> DataFrame:
    return reports.segment_profit(_scoring(spark, folder).rows)


@query
def campaign_kpis(spark: SparkSession, folder: str) -> DataFrame:
    scoring = _scoring(spark, folder)
    return value.campaign_kpis(scoring.rows, [_scenario(scoring.terms[0])])


@query
def whatif_list(spark: SparkSession, folder: str) -> DataFrame:
    """The list recomputed from its saved columns: 10 % discount instead of 20 %."""
    scoring = _scoring(spark, folder)
    t = scoring.terms[0]
    return value.what_if(
        scoring.rows, value.Scenario(1, t.price, 0.10, t.cogs, t.campaign_cost)
    )


def _whatif(spark: SparkSession, folder: str) -> tuple[DataFrame, value.Terms]:
    """The list recomputed for another discount, as the reports of a dashboard read it."""
    scoring = _scoring(spark, folder)
    t = scoring.terms[0]
    scenario = value.Scenario(1, t.price, WHATIF_DISCOUNT, t.cogs, t.campaign_cost)
    return value.what_if(scoring.rows, scenario), replace(t, discount_rate=WHATIF_DISCOUNT)


@query
def whatif_top100(spark: SparkSession, folder: str) -> DataFrame:
    return value.top_by_profit(_whatif(spark, folder)[0])


@query
def whatif_action_counts(spark: SparkSession, folder: str) -> DataFrame:
    return reports.value_counts(_whatif(spark, folder)[0], "recommended_action")


@query
def whatif_segment_means(spark: SparkSession, folder: str) -> DataFrame:
    return reports.segment_means(_whatif(spark, folder)[0])


@query
def whatif_segment_profit(spark: SparkSession, folder: str) -> DataFrame:
    return reports.segment_profit(_whatif(spark, folder)[0])


@query
def whatif_policies(spark: SparkSession, folder: str) -> DataFrame:
    rows, terms = _whatif(spark, folder)
    masks = {"uniform": F.lit(True), "targets": F.col("recommended_action") == C.TARGET}
    return policies.policy_report(rows, masks, terms)


@query
def targeting_list_all(spark: SparkSession, folder: str) -> DataFrame:
    """The labelled list of every customer for each of the four promotions."""
    terms = _terms(Retail(spark, folder), PROMOTIONS)
    return value.by_profit(value.targeting_rows(_scoring(spark, folder).scored, terms))


@query
def whatif_grid(spark: SparkSession, folder: str) -> DataFrame:
    scoring = _scoring(spark, folder)
    t = scoring.terms[0]
    grid = [
        value.Scenario(
            len(GRID_DISCOUNTS) * i + j,
            round(t.price * factor * 100) / 100,
            rate,
            t.cogs,
            t.campaign_cost,
        )
        for i, factor in enumerate(GRID_PRICES)
        for j, rate in enumerate(GRID_DISCOUNTS)
    ]
    return value.campaign_kpis(scoring.rows, grid)


@query
def profit_curve(spark: SparkSession, folder: str) -> DataFrame:
    scoring = _scoring(spark, folder)
    return policies.profit_curve(value.what_if(scoring.rows, _scenario(scoring.terms[0])))


@query
def best_cutoff(spark: SparkSession, folder: str) -> DataFrame:
    scoring = _scoring(spark, folder)
    return policies.best_cutoff(value.what_if(scoring.rows, _scenario(scoring.terms[0])))


@query
def quadrant_confusion(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted against a stand-in truth: the tables hold none, so a hash assigns one, which
    is stored as a truth table and read back as such."""
    draw = E.hash_percent("TRUTH", F.col("customer_id"))
    truth = Retail(spark, folder).customers.select(
        F.col("customer_id").cast("string"),
        "customer_taxonomies",
        F.when(draw < 35, C.PERSUADABLE)
        .when(draw < 65, C.SURE_THING)
        .when(draw < 90, C.LOST_CAUSE)
        .otherwise(C.SLEEPING_DOG)
        .alias("true_uplift_segment"),
    )
    path = sinks.write_list(truth, new_path(spark, "truth"))
    rows = _scoring(spark, folder).rows.withColumn("customer_id", F.col("customer_id").cast("string"))
    return reports.quadrant_confusion(rows, catalog.load_truth(spark, path))


@query
def export_targets(spark: SparkSession, folder: str) -> DataFrame:
    """Save the list, read it back, export the targets as CSV, read the export."""
    return _export(spark, folder, new_path(spark, "list"))


def _export(spark: SparkSession, folder: str, path: str) -> DataFrame:
    order = value.profit_order()
    saved = sinks.saved_or_computed(
        spark, path, lambda: value.by_profit(_scoring(spark, folder).rows), order
    )
    targets = sinks.export_targets(saved, new_path(spark, "targets"), order=order)
    return sinks.read_list(spark, targets, saved.schema, order=order)


@query
def export_saved_targets(spark: SparkSession, folder: str) -> DataFrame:
    """As before, but the list is found already saved."""
    path = new_path(spark, "list")
    sinks.write_list(value.by_profit(_scoring(spark, folder).rows), path, "parquet")
    return _export(spark, folder, path)


@query
def published_list(spark: SparkSession, folder: str) -> DataFrame:
    """The list published twice, the older one in file order, and the current one read back."""
    rows, root = _scoring(spark, folder).rows, new_path(spark, "published")
    publish.publish(rows.limit(1), root, label="trial")
    publish.publish(value.by_profit(rows), root, label="list")
    return value.by_profit(publish.read_published(spark, root, check=True))


@query
def checked_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Good and rejected lines of the promotions and purchase events written as CSV, where every
    event of one kind of day has a quantity that is no number."""
    retail, source = Retail(spark, folder), new_path(spark, "lines")
    bad = F.dayofmonth("datetime") == BAD_DAY
    lines = retail.purchases_subday.select(
        "datetime",
        F.lit("P").alias("product_id"),
        "price",
        F.when(bad, "many").otherwise(F.col("qty").cast("string")).alias("qty"),
        F.when(F.dayofmonth("datetime") == BAD_DAY + 1, F.lit(None))
        .otherwise(F.col("customer_id"))
        .alias("customer_id"),
        "promotion_id",
        F.lit("S").alias("store_id"),
        "po_id",
    )
    sinks.write_list(lines, f"{source}/transactions.csv")
    sinks.write_list(retail.promotions, f"{source}/promotions.csv")
    return catalog.reject_summary(
        {
            name: catalog.read_checked(
                spark,
                f"{source}/{name}.csv",
                catalog.SCHEMAS[name],
                limit=0.5,
                required=["customer_id"] if name == "transactions" else ["promotion_id"],
            )
            for name in ("transactions", "promotions")
        }
    )


@query
def batch_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """The whole batch job over a catalog: CSV tables with the fact as Parquet in, one sorted
    CSV list out, read back."""
    retail = Retail(spark, folder)
    source, output = new_path(spark, "catalog"), new_path(spark, "scored")
    formats = {"transactions": "parquet"}
    for name in catalog.SCHEMAS:
        fmt = formats.get(name, "csv")
        sinks.write_list(getattr(retail, name), f"{source}/{name}.{fmt}", fmt)
    scoring = pipeline.run_scoring(
        catalog.load_catalog(spark, source, formats=formats),
        output,
        REFERENCE_DATE,
        [PROMOTION_ID],
        StratifiedTLearner(),
    )
    return sinks.read_list(spark, output, scoring.rows.schema, order=value.profit_order())


# --- evaluation and policies -------------------------------------------------------------


@query
def qini_curve(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.qini_curve(_scoring(spark, folder).training)


@query
def grouped_ranks(spark: SparkSession, folder: str) -> DataFrame:
    """Every line's rank by revenue within its product, with running revenue; lines above the
    discount limit, about a third of all, are one group of their own."""
    lines = Retail(spark, folder).raw("lineitem").select(
        F.when(F.col("l_discount") > GROUP_DISCOUNT, "discounted")
        .otherwise(F.col("l_partkey").cast("string"))
        .alias("offer"),
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("line_id"),
        F.col("l_extendedprice").alias("revenue"),
    )
    units = {"running_cents": E.to_units(F.col("revenue"), 2)}
    return ranking.grouped_totals(
        lines, "revenue", "line_id", ["offer"], units, rank="place", hot_rows=GROUP_ROWS
    )


@query
def qini_curves(spark: SparkSession, folder: str) -> DataFrame:
    """A Qini curve per campaign and customer segment, with scores fitted on both campaigns."""
    rows = store(training_set_as_of(spark, folder), "pilot")
    scored = store(StratifiedTLearner().fit(rows).transform(rows), "scored")
    return evaluation.qini_curves(
        scored, ["campaign_id", "customer_taxonomies"], hot_rows=GROUP_ROWS // 10
    )


@query
def heldout_qini(spark: SparkSession, folder: str) -> DataFrame:
    """Fitted on the training fold, evaluated on the test fold."""
    retail = Retail(spark, folder)
    pilot = store(experiment.training_set(retail.campaign, retail.features), "pilot")
    return evaluation.qini_curve(pipeline.held_out(pilot, CAMPAIGN_ID))


@query
def uplift_at_k(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.uplift_at_k(_scoring(spark, folder).training, UPLIFT_SHARES)


@query
def uplift_intervals(spark: SparkSession, folder: str) -> DataFrame:
    """Uplift and Qini value of the top shares, out of fold, with bootstrap intervals."""
    scored = store(crossfit.crossfit(_pilot(spark, folder), CAMPAIGN_ID, CROSSFIT_FOLDS), "crossfit")
    return bootstrap.uplift_intervals(scored, UPLIFT_SHARES, CAMPAIGN_ID, BOOTSTRAP_REPLICATES)


@query
def quartile_intervals(spark: SparkSession, folder: str) -> DataFrame:
    """Response rates of the RFM quartiles and their effects, with bootstrap intervals."""
    pilot = _ranked_pilot(spark, folder)
    return bootstrap.rate_intervals(pilot, "rfm_quartile", CAMPAIGN_ID, BOOTSTRAP_REPLICATES)


@query
def auc(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.auc(_scoring(spark, folder).training)


@query
def precision_at_20(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.precision_at(_scoring(spark, folder).training, PRECISION_SHARE)


def _ranked_people(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.rfm_quartiles(store(Retail(spark, folder).features, "people"))


def _ranked_pilot(spark: SparkSession, folder: str) -> DataFrame:
    campaign = Retail(spark, folder).campaign
    return experiment.training_set(campaign, _ranked_people(spark, folder))


@query
def rfm_quartiles(spark: SparkSession, folder: str) -> DataFrame:
    return _ranked_people(spark, folder).select(
        "customer_id", "r_quartile", "f_quartile", "m_quartile", "rfm_score", "rfm_quartile"
    )


@query
def quartile_redemption(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.quartile_redemption(_ranked_pilot(spark, folder))


@query
def response_signal(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.response_signal(_ranked_pilot(spark, folder))


@query
def top30_policy(spark: SparkSession, folder: str) -> DataFrame:
    return policies.top_share_list(_scoring(spark, folder).rows)


@query
def budget_efficiency(spark: SparkSession, folder: str) -> DataFrame:
    scoring = _scoring(spark, folder)
    masks = {"uniform": F.lit(True), "top30": policies.top_uplift(scoring.rows)}
    return policies.policy_report(scoring.rows, masks, scoring.terms[0])


def _allocated(spark: SparkSession, folder: str) -> DataFrame:
    scoring = _scoring(spark, folder)
    # A quarter of the discounts and costs, so that several promotions pay.
    terms = [
        replace(t, discount_rate=t.discount_rate * 0.25, campaign_cost=t.campaign_cost * 0.25)
        for t in _terms(Retail(spark, folder), PROMOTIONS)
    ]
    people = store(allocation.offers(scoring.scored, terms), "offers")
    free = allocation.price_of_money(people, 1 << 62)[1]
    return allocation.allocate(people, free * BUDGET_PERCENT // 100)


@query
def budget_allocation(spark: SparkSession, folder: str) -> DataFrame:
    """One of four promotions per customer at most, for part of what no limit would spend."""
    return _allocated(spark, folder)


@query
def budget_summary(spark: SparkSession, folder: str) -> DataFrame:
    return allocation.summary(_allocated(spark, folder))


@query
def category_buyers(spark: SparkSession, folder: str) -> DataFrame:
    retail = Retail(spark, folder)
    return joins.category_buyers(
        retail.customers,
        retail.transactions,
        retail.products,
        BASELINE_CATEGORY,
        REFERENCE_DATE,
    )


@query
def policy_baselines(spark: SparkSession, folder: str) -> DataFrame:
    """Everybody, past buyers of the category, top 30 % by uplift, positive profit."""
    scoring = _scoring(spark, folder)
    buyers = category_buyers(spark, folder).select("customer_id")
    rows = scoring.rows.join(
        buyers.withColumn("__buyer", F.lit(1)), "customer_id", "left"
    )
    masks = {
        "all": F.lit(True),
        "category_buyers": F.col("__buyer").isNotNull(),
        "top30": policies.top_uplift(scoring.rows),
        "eip_positive": F.col("recommended_action") == C.TARGET,
    }
    return policies.policy_report(rows, masks, scoring.terms[0])


def _pilot(spark: SparkSession, folder: str) -> DataFrame:
    retail = Retail(spark, folder)
    return store(experiment.training_set(retail.campaign, retail.features), "pilot")


@query
def crossfit_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Out-of-fold scores of every pilot customer."""
    scored = crossfit.crossfit(_pilot(spark, folder), CAMPAIGN_ID, CROSSFIT_FOLDS)
    return scored.select("customer_id", "fold", "p_treatment", "p_control", "uplift")


@query
def crossfit_qini(spark: SparkSession, folder: str) -> DataFrame:
    """Qini curve over the whole log, each row scored by a model that has not seen it."""
    scored = crossfit.crossfit(_pilot(spark, folder), CAMPAIGN_ID, CROSSFIT_FOLDS)
    return evaluation.qini_curve(store(scored, "crossfit"))


@query
def crossfit_qini_forest(spark: SparkSession, folder: str) -> DataFrame:
    learner = TreeTLearner("forest")
    return evaluation.qini_curve(
        crossfit.crossfit(_pilot(spark, folder), CAMPAIGN_ID, TREE_FOLDS, learner)
    )


@query
def crossfit_qini_gbt(spark: SparkSession, folder: str) -> DataFrame:
    learner = TreeTLearner("boosted")
    return evaluation.qini_curve(
        crossfit.crossfit(_pilot(spark, folder), CAMPAIGN_ID, TREE_FOLDS, learner)
    )


@query
def model_table_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer scored from a stored node table: a boosted treated arm, a voting control."""
    schema = T.StructType.fromDDL(trees.SCHEMA)
    path = trees.write_table(
        local_table(spark, SMALL_ENSEMBLE, schema), new_path(spark, "small-ensemble")
    )
    scored = trees.read_table(spark, path).transform(Retail(spark, folder).features)
    # Engines differ in the last bit of exp.
    return scored.select(
        "customer_id",
        *[E.round_half_even(F.col(c), 9).alias(c) for c in ("p_treatment", "p_control", "uplift")],
    )


@query
def model_table_check(spark: SparkSession, folder: str) -> DataFrame:
    """Whether a fitted forest and its node table give every customer the same scores."""
    scoring = _tree_scoring(spark, folder, "forest")
    table = trees.table_model(trees.node_table(spark, scoring.model))
    names = ["p_treatment", "p_control", "uplift"]
    told = scoring.scored.withColumnsRenamed({c: f"{c}_fitted" for c in names})
    same = [F.abs(F.col(c) - F.col(f"{c}_fitted")) <= 1e-12 for c in names]
    return table.transform(told).select(
        "customer_id", *[x.alias(f"same_{c}") for c, x in zip(names, same, strict=True)]
    )


# --- tree models -------------------------------------------------------------------------


def _tree_scoring(spark: SparkSession, folder: str, kind: str) -> pipeline.Scoring:
    retail = Retail(spark, folder)
    return pipeline.score(retail.features, retail.campaign, _terms(retail), TreeTLearner(kind))


@query
def tlearner_gbt(spark: SparkSession, folder: str) -> DataFrame:
    return value.by_profit(_tree_scoring(spark, folder, "boosted").rows)


@query
def tlearner_forest(spark: SparkSession, folder: str) -> DataFrame:
    return value.by_profit(_tree_scoring(spark, folder, "forest").rows)


def _invariants(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """What holds in every row of a tree model's list, whatever the trees are."""
    scoring = _tree_scoring(spark, folder, kind)
    t = scoring.terms[0]
    whole = scoring.scored.withColumn("uplift_exact", F.col("p_treatment") - F.col("p_control"))
    rows = scoring.rows.join(
        whole.select("customer_id", "p_treatment", "p_control", "uplift", "uplift_exact"),
        "customer_id",
    )
    between = lambda c: (F.col(c) >= 0) & (F.col(c) <= 1)
    money = F.col("expected_incremental_revenue") - F.col("expected_incremental_profit")
    costs = F.col("uplift") * t.cogs + t.campaign_cost
    profit = F.col("expected_incremental_profit")
    return rows.select(
        "customer_id",
        (between("p_treatment") & between("p_control")).alias("probabilities"),
        (F.col("uplift") == F.col("uplift_exact")).alias("difference"),
        (F.abs(money - costs) <= 0.0101).alias("money"),
        (F.col("uplift_segment") == E.quadrant(F.col("uplift_score"), F.col("p_buy_control"))).alias(
            "quadrant"
        ),
        (F.col("recommended_action") == E.action(F.col("uplift_score"), profit)).alias("action"),
    )


@query
def gbt_invariants(spark: SparkSession, folder: str) -> DataFrame:
    return _invariants(spark, folder, "boosted")


@query
def forest_invariants(spark: SparkSession, folder: str) -> DataFrame:
    return _invariants(spark, folder, "forest")


@query
def qini_gbt(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.qini_curve(_tree_scoring(spark, folder, "boosted").training)


@query
def qini_forest(spark: SparkSession, folder: str) -> DataFrame:
    """Model validation with trees: fit, predict the pilot, Qini curve."""
    return evaluation.qini_curve(_tree_scoring(spark, folder, "forest").training)
