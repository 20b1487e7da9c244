"""Mixing sources to target weights by capped water-filling.

Targets: every source gets its weight's share of the budget, is clamped at its size times
``max_epochs``, and the excess goes to the others in proportion to their weights, until none is
above. Sampling: a target of 1.4 epochs is one whole repetition and a fraction of 0.4, taken in
a seeded order until its words are reached, so the error is at most half a document per source.

The running sum over a source never meets in one task: documents fall into cells by the first
digits of their hash, cells are summed, and only the one cell per source in which the fraction
ends is ordered by itself, with repeated rows summed before. Where the fraction ends among rows of
one id and text, a hash of the whole row decides in the same way, and of rows that are alike in
every column as many as are wanted. All steps are DataFrame functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from counterfoil.llm.common import WORD, positions, salted_join
from counterfoil.sources.storage import store

#: Copies of one row that are written out together.
PORTION = 10_000
#: Hexadecimal digits of a document's hash that make its cell: 4,096 cells per source.
CELL_DIGITS = 3


def word_count(text: Column) -> Column:
    """Number of words, whole text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_key(source: Column) -> Column:
    """The source as a key without nulls, in code point order with the null source last."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit("~"))


def cyclic_weights(sources: DataFrame, cycle: tuple[int, ...] = (5, 2, 1)) -> DataFrame:
    """Weights in turn by the code points of ``source``, null last. One row per source.

    Sources are numbered by their positions in a sorted table, so there may be any number.
    """
    ordered = store(sources.select("source", "source_size").orderBy("source"), "mix-order")
    kinds = F.array(*[F.lit(float(w)) for w in cycle])
    at = (F.col("place") % len(cycle)).cast("int")
    return positions(ordered).select("source", "source_size", kinds[at].alias("weight"))


def water_fill(sources: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """Add ``target`` to (source, source_size, weight).

    Clamping is repeated until no target is above its cap. The words per unit of weight only grow
    from round to round, so the sources clamped so far are those above their caps at the last one;
    each round clamps at least one source more, and the driver sees four sums a round. A budget
    beyond all caps gives every cap. Sources without words, or with weight zero while others have
    some, get zero.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    capped, clamped = F.lit(False), 0
    while True:
        total, fixed, weight = sources.agg(
            F.sum(F.col("source_size")),
            F.sum(F.when(capped, cap).otherwise(0.0)),
            F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))),
        ).first()
        if not weight:
            target = F.when(capped, cap).otherwise(0.0)
            break
        level = (share * total - fixed) / weight  # words per unit of weight
        above = capped | (F.col("weight") * F.lit(level) > cap)
        now = sources.agg(F.sum(above.cast("int"))).first()[0]
        if now == clamped:
            target = F.when(capped, cap).otherwise(F.col("weight") * F.lit(level))
            break
        capped, clamped = F.col("weight") * F.lit(level) > cap, now
    return sources.withColumn("target", target)


def drawn(id_column: str, text_column: str, seed: int) -> Column:
    """The seeded place of a document among those of its source, as 32 hexadecimal digits."""
    return F.md5(
        F.concat_ws(
            "|", F.lit(str(seed)), F.col(id_column).cast("string"), F.md5(F.col(text_column))
        )
    )


def fraction_ends(rows: DataFrame, rests: DataFrame) -> DataFrame:
    """Where each source's ``rest`` ends among its rows in the order of ``draw``.

    ``rows`` (stored) has (source, draw, size), ``rests`` (source, rest). A row is taken if half of
    it lies before the end: nearer with it than without. The result has, per source, ``last``: rows
    with a draw up to it are all taken, and ``tie`` and ``tie_taken``: so many of the rows with
    just that draw, null if no draw is taken in part.
    """
    rows = rows.withColumn("cell", F.substring("draw", 1, CELL_DIGITS))
    cells = rows.groupBy("source", "cell").agg(F.sum("size").alias("cell_size"))
    # A source has at most 16 ** CELL_DIGITS cells, whatever its number of documents.
    to_here = F.sum("cell_size").over(Window.partitionBy("source").orderBy("cell"))
    ends = store(
        cells.withColumn("before", to_here - F.col("cell_size"))
        .join(rests.select("source", "rest"), "source")
        .filter("rest >= before AND rest < before + cell_size")
        .select("source", "cell", "before", "rest"),
        "mix-ends",
    )
    # Only the cell in which the fraction ends is put in order, one row per draw.
    alike = (
        rows.join(F.broadcast(ends) if _few(ends) else ends, ["source", "cell"])
        .groupBy("source", "draw", "size", "before", "rest")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    earlier = Window.partitionBy("source").orderBy("draw", "size").rowsBetween(
        Window.unboundedPreceding, -1
    )
    words = F.col("n") * F.col("size")
    left = F.col("rest") - F.col("before") - F.coalesce(F.sum(words).over(earlier), F.lit(0))
    fits = F.when(F.col("size") > 0, F.floor(left / F.col("size") + 0.5)).otherwise(
        F.when(left >= 0, F.col("n")).otherwise(0)
    )
    told = alike.withColumn("fits", F.greatest(F.least(fits, F.col("n")), F.lit(0)))
    partly = (F.col("fits") > 0) & (F.col("fits") < F.col("n"))
    within = told.groupBy("source").agg(
        F.max(F.when(F.col("fits") == F.col("n"), F.col("draw"))).alias("last"),
        F.max(F.when(partly, F.col("draw"))).alias("tie"),
        F.max(F.when(partly, F.col("fits"))).alias("tie_taken"),
    )
    # Without an end the fraction is the whole source, up to rounding.
    last = F.coalesce("last", "cell", F.when(F.col("rest") > 0, "g").otherwise(""))
    return (
        rests.select("source", "rest")
        .join(ends.select("source", "cell"), "source", "left")
        .join(within, "source", "left")
        .select("source", last.alias("last"), "tie", "tie_taken")
    )


def source_plan(
    docs: DataFrame,
    weights: DataFrame | None,
    share: float,
    max_epochs: float,
    seed: int,
    id_column: str,
    text_column: str,
    source_column: str,
) -> DataFrame:
    """One row per source: source_size, target, whole repetitions, and what ``fraction_ends`` says.

    A document gets one repetition more if its draw is not above ``last``.
    """
    rows = store(
        docs.select(
            source_key(F.col(source_column)).alias("source"),
            word_count(F.col(text_column)).alias("size"),
            drawn(id_column, text_column, seed).alias("draw"),
        ),
        "mix-sizes",
    )
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    if weights is None:
        sources = cyclic_weights(sources)
    else:
        given = weights.select(source_key(F.col("source")).alias("source"), "weight")
        sources = sources.join(given, "source", "left").withColumn(
            "weight", F.coalesce(F.col("weight").cast("double"), F.lit(0.0))
        )
    sources = water_fill(store(sources, "mix-sources"), share, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sources = (
        sources.withColumn("whole", F.floor(epochs))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .drop("weight")
    )
    plan = sources.drop("rest").join(fraction_ends(rows, sources), "source")
    return store(plan, "mix-plan")


def _few(sources: DataFrame, most: int = 10_000) -> bool:
    """Whether a table of one narrow row per source may be broadcast."""
    return sources.count() <= most


def with_repeats(
    docs: DataFrame,
    weights: DataFrame | None = None,
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = 11,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """(row, source_size, target, repeats) for every input row.

    ``weights`` has (source, weight), one row per source, null for the null source; without it
    weights are 5, 2, 1 in turn. A null text has size 0; empty texts may be taken or not, they
    add no words. Rows that repeat, in part or in whole, count one by one, so a source of copies
    meets its target like any other. Null sources form one source. An empty table gives an empty
    result. The result depends on the rows and the seed only, not on their order or partitioning.
    """
    plan = source_plan(
        docs, weights, share, max_epochs, seed, id_column, text_column, source_column
    )
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        source_key(F.col(source_column)).alias("source"),
        drawn(id_column, text_column, seed).alias("draw"),
    )
    # One row per source: few sources are broadcast, many are joined with hot ones dealt out.
    joined = rows.join(F.broadcast(plan), "source") if _few(plan) else salted_join(rows, plan, "source")
    once_more = (F.col("draw") <= F.col("last")).cast("bigint")
    out = joined.select("row", "source_size", "target", "whole", once_more.alias("more"))
    if not plan.filter("tie IS NOT NULL").isEmpty():
        apart = F.coalesce(F.col("draw") == F.col("tie"), F.lit(False))
        decided = joined.filter(~apart).select(
            "row", "source_size", "target", "whole", once_more.alias("more")
        )
        out = decided.unionByName(_tied(joined.filter(apart)))
    repeats = F.least(F.col("whole") + F.col("more"), F.lit(math.ceil(max_epochs)))
    return out.select("row", "source_size", "target", repeats.cast("int").alias("repeats"))


def _tied(rows: DataFrame) -> DataFrame:
    """(row, source_size, target, whole, more) of rows of which a source takes ``tie_taken``.

    They have the same id and text. A hash of all columns puts them in order like ``draw`` does for
    others; rows that share it are alike, are summed to one with their number, and dealt out again
    in portions over all tasks.
    """
    kept = ["source", "source_size", "target", "whole", "tie_taken"]
    alike = store(
        rows.select("row", F.md5(F.to_json("row")).alias("draw"), *kept)
        .groupBy("draw", *kept)
        .agg(F.first("row").alias("row"), F.count(F.lit(1)).alias("n")),
        "mix-alike",
    )
    rests = alike.groupBy("source").agg(F.max("tie_taken").cast("double").alias("rest"))
    each = alike.select("source", "draw", F.explode(_portions("n")).alias("p")).select(
        "source", "draw", F.explode(F.sequence("p.first", "p.last"))
    )
    one = store(each.select("source", "draw", F.lit(1).cast("bigint").alias("size")), "mix-ties")
    ends = fraction_ends(one, rests).withColumnRenamed("tie_taken", "taken")
    told = alike.drop("tie_taken").join(ends, "source").withColumn(
        "n_more",
        F.when(F.col("draw") <= F.col("last"), F.col("n"))
        .when(F.col("draw") == F.col("tie"), F.col("taken"))
        .otherwise(0),
    )
    spread = told.select(
        "row", "source_size", "target", "whole", "n_more", F.explode(_portions("n")).alias("p")
    ).repartition("p")
    kept = ["row", "source_size", "target", "whole"]
    one_by_one = spread.select(*kept, "n_more", F.explode(F.sequence("p.first", "p.last")).alias("i"))
    return one_by_one.select(*kept, (F.col("i") <= F.col("n_more")).cast("bigint").alias("more"))


def _portions(count: str) -> Column:
    """1..n in stretches that a task can write out."""
    starts = F.sequence(F.lit(1).cast("bigint"), F.col(count), F.lit(PORTION).cast("bigint"))
    return F.transform(
        starts,
        lambda a: F.struct(a.alias("first"), F.least(a + PORTION - 1, F.col(count)).alias("last")),
    )


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **how) -> DataFrame:
    """One row per input row: id, size, source_size, target, repeats, taken (size * repeats).

    Rows, nulls and ties are treated as ``with_repeats`` says.
    """
    told = with_repeats(docs, id_column=id_column, text_column=text_column, **how)
    size = word_count(F.col(f"row.`{text_column}`"))
    return told.select(
        F.col(f"row.`{id_column}`").alias(id_column),
        size.alias("size"),
        "source_size",
        "target",
        "repeats",
        (size * F.col("repeats")).alias("taken"),
    )


def mixture(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: every row as often as it is taken, with all its columns."""
    told = with_repeats(docs, **how).filter("repeats > 0")
    copies = F.explode(F.sequence(F.lit(1), F.col("repeats")))
    return told.select("row", copies.alias("copy")).select("row.*")
