"""From raw tables to a ranked targeting list."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, time
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterfoil.functions import constants as C
from counterfoil.operators import asof, experiment, features, value
from counterfoil.operators.learners import (
    StratifiedModel,
    StratifiedTLearner,
    TreeModel,
    TreeTLearner,
)
from counterfoil.sources import sinks
from counterfoil.sources.storage import store

Learner = StratifiedTLearner | TreeTLearner


@dataclass(frozen=True)
class Scoring:
    """Stored customers and pilot rows, the fitted model, and the list for the promotions."""

    people: DataFrame
    pilot: DataFrame
    model: StratifiedModel | TreeModel
    scored: DataFrame
    rows: DataFrame
    terms: list[value.Terms]

    @cached_property
    def training(self) -> DataFrame:
        """The pilot rows with their fitted probabilities, for evaluation."""
        return _kept(self.model.transform(self.pilot), self.model, "training")


def _kept(scored: DataFrame, model: StratifiedModel | TreeModel, label: str) -> DataFrame:
    """Tree predictions are stored, being the costly part of each later pass."""
    return store(scored, label) if isinstance(model, TreeModel) else scored


def score(
    customer_features: DataFrame,
    campaign: DataFrame,
    terms: Sequence[value.Terms],
    learner: Learner | None = None,
) -> Scoring:
    """Fit on the campaign log, score every customer once, value the scores.

    Features are stored, so the transactions are aggregated once; training, scoring and every
    later report read narrow tables. A customer may be in the log several times, as after
    several campaigns: that adds training rows, not rows to score.
    """
    people = store(customer_features, "people")
    return _fitted(people, experiment.training_set(campaign, people), terms, learner)


def score_as_of(
    buckets: DataFrame,
    customers: DataFrame,
    dated: DataFrame,
    reference: date,
    terms: Sequence[value.Terms],
    learner: Learner | None = None,
) -> Scoring:
    """As ``score``, but every row of the log is taken as of its own ``reference_date``.

    The customer days are read once: the customers as of the reference date are one more date.
    """
    everyone = customers.select("customer_id", F.lit(reference).alias(asof.DATE))
    asked = dated.select("customer_id", asof.DATE).unionByName(everyone)
    features_at = store(asof.features_as_of(buckets, asked, customers), "features-as-of")
    people = features_at.filter(F.col(asof.DATE) == F.lit(reference)).drop(asof.DATE)
    return _fitted(people, asof.training_set(dated, features_at).drop(asof.DATE), terms, learner)


def _fitted(
    people: DataFrame, pilot: DataFrame, terms: Sequence[value.Terms], learner: Learner | None
) -> Scoring:
    learner = learner or StratifiedTLearner()
    pilot = store(pilot, "pilot")
    model = learner.fit(pilot)
    scored = _kept(model.transform(people), model, "scored")
    rows = value.targeting_rows(scored, terms)
    return Scoring(people, pilot, model, scored, rows, list(terms))


def held_out(pilot: DataFrame, campaign_id: str, learner: Learner | None = None) -> DataFrame:
    """Test-fold rows scored by a model that saw only the training fold."""
    rows = pilot.withColumn("fold", experiment.fold(campaign_id))
    model = (learner or StratifiedTLearner()).fit(rows.filter(F.col("fold") == "train"))
    return _kept(model.transform(rows.filter(F.col("fold") == "test")), model, "held-out")


def run_scoring(
    tables: Mapping[str, DataFrame],
    output_path: str,
    reference: str,
    promotion_ids: Sequence[str],
    learner: Learner | None = None,
    campaign_cost: float = C.DEFAULT_CAMPAIGN_COST,
    fmt: str = "csv",
    as_of: str = "reference",
) -> Scoring:
    """The batch job over a loaded catalog: writes the sorted list to ``output_path``.

    ``as_of`` says what the rows of the log know when the models are fitted: the history before
    the "reference" date, or before the "start" of each row's own promotion. With several campaigns
    in the log only the latter keeps earlier ones from seeing what came after them; rows whose
    promotion has no start then train nothing.
    """
    if as_of not in ("reference", "start"):
        raise ValueError(f"as_of must be reference or start, not {as_of!r}")
    learner = learner or TreeTLearner("boosted")
    transactions, customers = tables["transactions"], tables["customers"]
    terms = value.promotion_terms(
        tables["promotions"], tables["products"], promotion_ids, campaign_cost
    )
    if as_of == "reference":
        people = features.rfm_features(transactions, customers, reference)
        scoring = score(people, tables["campaign"], terms, learner)
    else:
        moment = datetime.fromisoformat(reference)
        if moment != datetime.combine(moment.date(), time()):
            raise ValueError("as_of='start' needs a reference date at midnight")
        dated = asof.with_start(tables["campaign"], tables["promotions"])
        latest = tables["promotions"].agg(F.max("start_date")).first()[0]
        before = max(moment.date(), latest or moment.date())
        buckets = asof.day_buckets(asof.basket_days(transactions, before))
        scoring = score_as_of(buckets, customers, dated, moment.date(), terms, learner)
    sinks.write_list(value.by_profit(scoring.rows), output_path, fmt)
    return scoring
