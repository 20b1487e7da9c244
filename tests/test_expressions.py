import numpy as np
from pyspark.sql import functions as F

from counterfoil.functions import constants as C
from counterfoil.functions import expressions as E


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_rounding_matches_numpy_on_ties(spark):
    values = [i / 1000 + 0.005 for i in range(-400, 400)] + [1.015, 2.675, -0.001, 0.004]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(E.round_half_even(F.col("v"), 2)).collect()]
    assert got == [float(x) for x in np.round(values, 2) + 0.0]
    assert not any(str(x) == "-0.0" for x in got)


def test_rounding_uses_the_binary_value(spark):
    assert one(spark, a=E.round_half_even(F.lit(1.015), 2)).a == 1.01


def test_quadrant_edges(spark):
    row = one(
        spark,
        up=E.quadrant(F.lit(0.05), F.lit(0.9)),
        down=E.quadrant(F.lit(-0.05), F.lit(0.9)),
        sure=E.quadrant(F.lit(-0.02), F.lit(0.5)),
        lost=E.quadrant(F.lit(0.049), F.lit(0.49)),
    )
    assert (row.up, row.down, row.sure, row.lost) == (
        C.PERSUADABLE,
        C.SLEEPING_DOG,
        C.SURE_THING,
        C.LOST_CAUSE,
    )


def test_action_differs_from_quadrant(spark):
    row = one(
        spark,
        small_loss=E.action(F.lit(-0.02), F.lit(5.0)),
        target=E.action(F.lit(0.0), F.lit(0.01)),
        skip=E.action(F.lit(0.2), F.lit(0.0)),
        tiny=E.action(F.lit(0.2), E.round_half_even(F.lit(0.004), 2)),
    )
    assert row.small_loss == C.DO_NOT_DISTURB
    assert (row.target, row.skip, row.tiny) == (C.TARGET, C.SKIP, C.SKIP)


def test_exact_sum_does_not_depend_on_order(spark):
    values = [0.1] * 10 + [1e9, -1e9, 0.0001]
    schema = "i int, v double"
    sums = set()
    for order in (values, values[::-1]):
        df = spark.createDataFrame(list(enumerate(order)), schema).repartition(5)
        sums.add(df.agg(E.exact_sum(F.col("v"), 4)).first()[0])
    assert sums == {1.0001}


def test_exact_sum_passes_64_bits(spark):
    df = spark.range(40).select(F.lit(9e13).alias("v"))
    assert df.agg(E.exact_sum(F.col("v"), 4)).first()[0] == 40 * 9e13


def test_promotion_flag_codes_and_ratio(spark):
    row = one(
        spark,
        none=E.has_promotion(F.lit(None).cast("string")),
        empty=E.has_promotion(F.lit("")),
        named=E.has_promotion(F.lit("P")),
        known=E.segment_code(F.lit("High Value")),
        unknown=E.segment_code(F.lit("Other")),
        missing=E.segment_code(F.lit(None).cast("string")),
        zero=E.ratio(F.lit(1), F.lit(0)),
    )
    assert (row.none, row.empty, row.named) == (0, 0, 1)
    assert (row.known, row.unknown, row.missing) == (3, -1, -1)
    assert row.zero is None


def test_hash_share_is_near_its_target(spark):
    share = (
        spark.range(20_000)
        .select((E.hash_percent("X", F.col("id")) < 80).cast("int").alias("t"))
        .agg(F.avg("t"))
        .first()[0]
    )
    assert abs(share - 0.8) < 0.01
