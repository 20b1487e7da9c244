"""Arms, labels, training rows and arm comparisons."""

from __future__ import annotations

from datetime import datetime, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.functions import constants as C
from counterfoil.functions import expressions as E
from counterfoil.sources.storage import small_side


def assign_arms(
    customers: DataFrame, campaign_id: str, treated_percent: int = C.TREATED_PERCENT
) -> DataFrame:
    """Randomized hold-out by a hash of campaign and customer: repeatable anywhere."""
    draw = E.hash_percent(campaign_id, F.col("customer_id"))
    return customers.select(
        "customer_id", (draw < treated_percent).cast("int").alias("is_treatment")
    )


def fold(campaign_id: str, test_percent: int = C.TEST_PERCENT) -> Column:
    """'test' or 'train', drawn independently of the arm."""
    draw = E.hash_percent(f"{campaign_id}:fold", F.col("customer_id"))
    return F.when(draw < test_percent, "test").otherwise("train")


def _timestamp(moment: datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def response_label(
    dispatch: DataFrame,
    promotions: DataFrame,
    transactions: DataFrame,
    products: DataFrame | None = None,
    days: int = C.LABEL_DAYS,
    match: str = "category",
) -> DataFrame:
    """Add ``bought_after_promo``: 1 when the customer bought in [start, start + days).

    ``match`` says what must be bought: the promoted "product", its "category", or "any".
    Promotion ids are unique; a promotion without a start date is never answered. Purchases
    of promoted things shrink to the days of each customer and thing, with partial
    aggregation before the shuffle: at most one entry per calendar day of the window, however
    many purchases or promotions there are. Only then do they meet the dispatch log, whose
    rows neither multiply nor travel under the promotion.
    """
    if match not in ("product", "category", "any"):
        raise ValueError(f"match must be product, category or any, not {match!r}")
    if match == "category" and products is None:
        raise ValueError("match='category' needs the products")
    first, last = promotions.agg(F.min("start_date"), F.max("start_date")).first()
    if first is None:
        return dispatch.withColumn("bought_after_promo", F.lit(0))
    moment = F.col("datetime")
    bought = transactions.filter(
        F.col("customer_id").isNotNull()
        & (moment >= _timestamp(datetime.combine(first, time())))
        & (moment < _timestamp(datetime.combine(last, time()) + timedelta(days=days)))
    )
    offers = promotions.filter(F.col("start_date").isNotNull())
    key = ["customer_id"]
    if match == "any":
        offers = offers.select("promotion_id", "start_date")
    elif match == "product":
        offers = offers.select("promotion_id", "start_date", F.col("product_id").alias("__thing"))
        promoted = offers.select(F.col("__thing").alias("product_id")).distinct()
        # A semi join goes below the join of lines and orders, to the lines.
        bought = bought.join(promoted, "product_id", "left_semi").withColumn(
            "__thing", F.col("product_id")
        )
    else:
        things = products.select("product_id", F.col("product_taxonomies").alias("__thing"))
        offers = offers.join(things, "product_id").select("promotion_id", "start_date", "__thing")
        promoted = things.join(offers.select("__thing").distinct(), "__thing", "left_semi")
        bought = bought.join(promoted.select("product_id"), "product_id", "left_semi").join(
            promoted, "product_id"
        )
    if match != "any":
        key.append("__thing")
    hits = (
        bought.select(*key, F.to_date(moment).alias("__day"))
        .groupBy(*key)
        .agg(F.collect_set("__day").alias("__days"))
    )
    start = F.col("start_date")
    answered = F.exists(
        "__days", lambda day: (day >= start) & (day < F.date_add(start, days))
    )
    offers = small_side(offers.withColumnRenamed("promotion_id", "__offer"), bound=promotions)
    offered = E.join_key(F.col("promotion_id"), F.col("customer_id")) == F.col("__offer")
    labelled = dispatch.join(offers, offered, "left").join(hits, key, "left")
    return labelled.select(
        *[dispatch[c] for c in dispatch.columns if c not in ("promotion_id", "customer_id")],
        "promotion_id",
        "customer_id",
        F.coalesce(answered.cast("int"), F.lit(0)).alias("bought_after_promo"),
    ).select(*dispatch.columns, "bought_after_promo")


def arms_from_fact(
    customers: DataFrame, transactions: DataFrame, promotion_id: str, start: str, days: int
) -> DataFrame:
    """Arms for data without a dispatch log: buyers on the promotion are the treated.

    Biased by construction, since only buyers can be treated; prefer a dispatch log.
    """
    moment = F.col("datetime")
    first = datetime.fromisoformat(start)
    last = first + timedelta(days=days)
    treated = (
        transactions.filter(
            (F.col("promotion_id") == promotion_id)
            & (moment >= _timestamp(first))
            & (moment < _timestamp(last))
        )
        .select("customer_id")
        .distinct()
        .withColumn("is_treatment", F.lit(1))
    )
    return customers.select("customer_id").join(treated, "customer_id", "left").select(
        "customer_id", F.coalesce("is_treatment", F.lit(0)).alias("is_treatment")
    )


def training_set(campaign: DataFrame, features: DataFrame) -> DataFrame:
    """The rows of the campaign log with the features of their customers."""
    return campaign.join(features, "customer_id")


def arm_summary(training: DataFrame) -> DataFrame:
    """Size, buyers and response rate per arm, and the difference of the rates."""
    treated = F.col("is_treatment") == 1
    bought = F.col("bought_after_promo").cast("bigint")
    sums = training.agg(
        F.count(F.when(treated, 1)).alias("n_treated"),
        F.coalesce(F.sum(F.when(treated, bought)), F.lit(0)).alias("buyers_treated"),
        F.count(F.when(~treated, 1)).alias("n_control"),
        F.coalesce(F.sum(F.when(~treated, bought)), F.lit(0)).alias("buyers_control"),
    )
    rate_t = E.ratio(F.col("buyers_treated"), F.col("n_treated"))
    rate_c = E.ratio(F.col("buyers_control"), F.col("n_control"))
    return sums.select(
        "*",
        rate_t.alias("rate_treated"),
        rate_c.alias("rate_control"),
        (rate_t - rate_c).alias("average_effect"),
    )


BIN = ["customer_segment_code", "recency_band", "frequency_band"]


def control_bins(training: DataFrame) -> DataFrame:
    """Arm sizes and rates per behaviour bin: segment, recency band, frequency band."""
    treated = F.col("is_treatment") == 1
    bought = F.col("bought_after_promo").cast("bigint")
    return (
        training.select(
            "customer_segment_code",
            E.recency_band(F.col("recency_days")).alias("recency_band"),
            E.frequency_band(F.col("frequency_30d")).alias("frequency_band"),
            "is_treatment",
            "bought_after_promo",
        )
        .groupBy(*BIN)
        .agg(
            F.count(F.when(treated, 1)).alias("n_treated"),
            F.coalesce(F.sum(F.when(treated, bought)), F.lit(0)).alias("buyers_treated"),
            F.count(F.when(~treated, 1)).alias("n_control"),
            F.coalesce(F.sum(F.when(~treated, bought)), F.lit(0)).alias("buyers_control"),
        )
        .withColumn("rate_treated", E.ratio(F.col("buyers_treated"), F.col("n_treated")))
        .withColumn("rate_control", E.ratio(F.col("buyers_control"), F.col("n_control")))
    )


def matched_controls(training: DataFrame) -> DataFrame:
    """Effect on the treated against untreated customers of the same bin.

    Bins without a control cannot be compared; their treated customers are reported.
    """
    both = (F.col("n_treated") > 0) & (F.col("n_control") > 0)
    gain = F.col("n_treated") * (F.col("rate_treated") - F.col("rate_control"))
    matched = F.coalesce(F.sum(F.when(both, F.col("n_treated"))), F.lit(0))
    return control_bins(training).agg(
        F.count(F.when(both, 1)).alias("n_bins"),
        matched.alias("n_treated_matched"),
        F.coalesce(
            F.sum(F.when(F.col("n_control") == 0, F.col("n_treated"))), F.lit(0)
        ).alias("n_treated_unmatched"),
        E.round_half_even(E.ratio(F.sum(F.when(both, gain)), matched), 8).alias(
            "matched_effect"
        ),
    )


def campaign_purchases(
    campaign: DataFrame,
    promotions: DataFrame,
    products: DataFrame,
    store_id,
    hours_after_start: int = 62,
) -> DataFrame:
    """One purchase line per campaign buyer.

    The treated pay the discounted price and carry the promotion; the default time is 14:00
    on the third day. Orders are named after campaign and customer.
    """
    offers = products.select("product_id", "price").join(small_side(promotions), "product_id")
    offers = small_side(offers.withColumnRenamed("promotion_id", "__offer"), bound=promotions)
    offered = E.join_key(F.col("promotion_id"), F.col("customer_id")) == F.col("__offer")
    treated = F.col("is_treatment") == 1
    reduced = E.round_half_even(F.col("price") - F.col("price") * F.col("discount"), 2)
    return (
        campaign.filter(F.col("bought_after_promo") == 1)
        .join(offers, offered)
        .select(
            (
                F.col("start_date").cast("timestamp_ntz")
                + F.expr(f"INTERVAL {hours_after_start} HOURS")
            ).alias("datetime"),
            "product_id",
            F.when(treated, reduced).otherwise(F.col("price")).alias("price"),
            F.lit(1).alias("qty"),
            "customer_id",
            F.when(treated, F.col("promotion_id")).otherwise("").alias("promotion_id"),
            F.lit(store_id).alias("store_id"),
            F.concat_ws("_", F.lit("PO"), "campaign_id", F.col("customer_id").cast("string")).alias(
                "po_id"
            ),
        )
    )


def append_campaign(
    transactions: DataFrame,
    campaign: DataFrame,
    promotions: DataFrame,
    products: DataFrame,
    store_id,
    hours_after_start: int = 62,
) -> DataFrame:
    """The fact table plus the campaign's purchases. Orders get text ids, as the new ones have."""
    bought = campaign_purchases(campaign, promotions, products, store_id, hours_after_start)
    return transactions.withColumn("po_id", F.col("po_id").cast("string")).unionByName(bought)


def upsert_lines(transactions: DataFrame, lines: DataFrame, key: str = "po_id") -> DataFrame:
    """The fact table with all lines of the orders in ``lines`` replaced by those.

    An order that is new is added, one that is there is replaced as a whole, so giving the same
    lines twice changes nothing. The fact table is only filtered: where the new orders' keys are
    few by the optimizer's estimate they are broadcast and it is not shuffled. Null is no key:
    lines without one match nothing and are added each time.
    """
    kept = lines.withColumn(key, F.col(key).cast("string"))
    history = transactions.withColumn(key, F.col(key).cast("string"))
    keys = kept.select(key).filter(F.col(key).isNotNull()).distinct()
    return history.join(small_side(keys, bound=lines), key, "left_anti").unionByName(kept)
