"""Global order without a global sort in one task: ranks, running totals, cut points.

A window without partition columns moves every row to one task. Here the order
``(score, id)`` is cut into *cells* - score buckets, and inside a score shared by many rows,
slices of the id range. Row order inside a cell comes from an ordinary partitioned window;
what lies before a cell comes from a table with one row per cell.

Cut points are read off a sample. They decide only how even the cells are: every row falls
into exactly one cell whatever the cuts, so results do not depend on them. Cuts are plain
numbers in the plan, so a recomputed task places its rows as before.

Inputs are read three times; pass a stored table or a scan, not a long computation.
Ids must be unique within a group and not null. Rows with a null score are left out.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from counterfoil.sources.storage import local_table

ROWS_PER_CELL = 500_000
MIN_ROWS_PER_CELL = 64
MAX_CELLS = 4096
SAMPLES_PER_CELL = 32

KEY, BUCKET, SLICE = "__key", "__bucket", "__slice"
CELL = [BUCKET, SLICE]


@dataclass(frozen=True)
class Cuts:
    """Ascending split points of the sort key, and id cuts inside single-score buckets."""

    splits: list[float] = field(default_factory=lambda: [-math.inf, math.inf])
    ties: dict[int, list] = field(default_factory=dict)


def _keyed(df: DataFrame, score: str, descending: bool) -> DataFrame:
    value = F.col(score).cast("double")
    key = (-value if descending else value) + F.lit(0.0)
    return df.filter(F.col(score).isNotNull()).withColumn(KEY, key)


def _cell_count(df: DataFrame, rows: int) -> int:
    """Several cells per shuffle partition, so that hashing them spreads evenly."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(math.ceil(rows / ROWS_PER_CELL), 3 * partitions)
    return max(1, min(wanted, rows // MIN_ROWS_PER_CELL, MAX_CELLS))


def cuts_from_sample(sample: Sequence[tuple[float, object]], cells: int) -> Cuts:
    """Cut a sorted sample of (key, id) into ``cells`` even runs.

    A key that occurs at two or more cut positions holds a cell's worth of rows or more. It
    gets a bucket of its own, [key, next double), which is then cut by id.
    """
    if not sample or cells < 2:
        return Cuts()
    chosen = [sample[len(sample) * i // cells] for i in range(1, cells)]
    repeats = Counter(key for key, _ in chosen)
    splits: set[float] = set()
    for key, times in repeats.items():
        splits.add(key)
        if times > 1:
            splits.add(math.nextafter(key, math.inf))
    inner = sorted(x for x in splits if math.isfinite(x))
    ties = {
        bisect_left(inner, key) + 1: sorted({i for k, i in chosen if k == key})
        for key, times in repeats.items()
        if times > 1
    }
    return Cuts([-math.inf, *inner, math.inf], ties)


def choose_cuts(
    keyed: DataFrame, id_column: str, cells: int | None = None, rows: int | None = None
) -> Cuts:
    rows = keyed.count() if rows is None else rows
    cells = cells or _cell_count(keyed, rows)
    if cells < 2:
        return Cuts()
    share = min(1.0, cells * SAMPLES_PER_CELL / rows)
    drawn = keyed.select(KEY, id_column).sample(fraction=share, seed=7).collect()
    return cuts_from_sample(sorted((r[0], r[1]) for r in drawn), cells)


def _blocks(ids: list) -> tuple[int, list, list[list]]:
    """Cut points in blocks of about the square root of their number, and the block heads.

    A row is placed by comparing it with the heads and with one block.
    """
    size = math.isqrt(len(ids) - 1) + 1
    blocks = [ids[i : i + size] for i in range(0, len(ids), size)]
    return size, [block[0] for block in blocks], blocks


def with_cells(keyed: DataFrame, id_column: str, cuts: Cuts) -> DataFrame:
    """Add the cell of each row: a binary search on the key, then the number of lower id cuts."""
    if len(cuts.splits) < 3:
        return keyed.withColumns({BUCKET: F.lit(0), SLICE: F.lit(0)})
    placed = Bucketizer(
        splits=cuts.splits, inputCol=KEY, outputCol=BUCKET, handleInvalid="error"
    ).transform(keyed)
    placed = placed.withColumn(BUCKET, F.col(BUCKET).cast("int"))
    if not cuts.ties:
        return placed.withColumn(SLICE, F.lit(0))
    ids = T.ArrayType(keyed.schema[id_column].dataType)
    schema = T.StructType(
        [
            T.StructField(BUCKET, T.IntegerType()),
            T.StructField("__size", T.IntegerType()),
            T.StructField("__heads", ids),
            T.StructField("__blocks", T.ArrayType(ids)),
        ]
    )
    ties = local_table(
        keyed.sparkSession,
        [(bucket, *_blocks(cuts)) for bucket, cuts in cuts.ties.items()],
        schema,
    )

    def lower(column: Column) -> Column:
        return F.size(F.filter(column, lambda cut: cut < F.col(id_column)))

    block = lower(F.col("__heads")) - 1
    place = block * F.col("__size") + lower(F.get(F.col("__blocks"), block))
    return (
        placed.join(F.broadcast(ties), BUCKET, "left")
        .withColumn(SLICE, F.coalesce(place, F.lit(0)))
        .drop("__size", "__heads", "__blocks")
    )


def running_totals(
    df: DataFrame,
    score: str,
    id_column: str,
    sums: Mapping[str, Column] | None = None,
    groups: Sequence[str] = (),
    descending: bool = True,
    rank: str = "n_pop",
    cells: int | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Add the 1-based rank and running sums in the order (score, id), per group.

    ``sums`` maps new columns to integer or decimal expressions: exact, so a total does not
    depend on the cells. Groups are few (arms, scenarios) and not null. ``rows``, if known,
    saves a count; it only sizes the cells.
    """
    sums = dict(sums or {})
    groups = list(groups)
    keyed = _keyed(df, score, descending)
    for name, value in sums.items():
        keyed = keyed.withColumn(f"__{name}", value)
    cuts = choose_cuts(keyed, id_column, cells, rows)
    placed = with_cells(keyed, id_column, cuts)

    # One row per group and cell: a few thousand at most.
    totals = placed.groupBy(*groups, *CELL).agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.sum(f"__{name}").alias(f"__sum_{name}") for name in sums],
    )
    earlier = (
        Window.partitionBy(*(groups or [F.lit(0)]))
        .orderBy(*CELL)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(
        *groups,
        *CELL,
        F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__rows"),
        *[
            F.coalesce(F.sum(f"__sum_{name}").over(earlier), F.lit(0)).alias(f"__sum_{name}")
            for name in sums
        ],
    )
    inside = Window.partitionBy(*groups, *CELL).orderBy(KEY, id_column)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = placed.select(
        "*",
        F.row_number().over(inside).alias("__row"),
        *[F.sum(f"__{name}").over(so_far).alias(f"__run_{name}") for name in sums],
    )
    return local.join(F.broadcast(offsets), [*groups, *CELL]).select(
        *df.columns,
        (F.col("__rows") + F.col("__row")).alias(rank),
        *[(F.col(f"__sum_{name}") + F.col(f"__run_{name}")).alias(name) for name in sums],
    )


#: Of a group's rows from which it may be cut into cells, and groups that are cut at most.
HOT_GROUP_ROWS = 200_000
MOST_HOT_GROUPS = 1000


def hot_groups(
    keyed: DataFrame, groups: Sequence[str], rows: int, hot_rows: int | None = None
) -> list[tuple]:
    """(group columns..., rows) of the groups to cut: those with ``hot_rows`` rows and more than a
    ``MOST_HOT_GROUPS``-th of all, so there are never more than that."""
    least = max(HOT_GROUP_ROWS if hot_rows is None else hot_rows, rows // MOST_HOT_GROUPS + 1)
    counted = keyed.groupBy(*groups).agg(F.count(F.lit(1)).alias("__rows"))
    return [tuple(r) for r in counted.filter(F.col("__rows") >= least).collect()]


def group_cuts(
    keyed: DataFrame, id_column: str, groups: Sequence[str], hot: list[tuple], per_cell: int
) -> DataFrame:
    """For each hot group the (key, id) pairs that cut it into cells, in blocks for a quick
    search. The pairs come from a sample and only decide how even the cells are."""
    spark = keyed.sparkSession
    names = [f"__g{i}" for i in range(len(groups))]
    types = [keyed.schema[g].dataType for g in groups]
    fields = [T.StructField(n, t) for n, t in zip(names, types, strict=True)]
    cells = {row[:-1]: -(-row[-1] // per_cell) for row in hot}
    numbered = T.StructType([*fields, T.StructField("__number", T.IntegerType())])
    table = local_table(spark, [(*key, i) for i, key in enumerate(cells)], numbered)
    share = min(1.0, SAMPLES_PER_CELL * sum(cells.values()) / sum(row[-1] for row in hot))
    drawn = (
        keyed.sample(fraction=share, seed=7)
        .join(F.broadcast(table), same_groups(groups, names))
        .select("__number", KEY, id_column)
        .collect()
    )
    samples: list[list] = [[] for _ in cells]
    for number, key, id_ in drawn:
        samples[number].append((key, id_))
    rows = []
    for sample, (group, count) in zip(samples, cells.items(), strict=True):
        sample.sort()
        cuts = sorted({sample[len(sample) * i // count] for i in range(1, count)} if sample else set())
        if cuts:
            rows.append((*group, *_blocks(cuts)))
    pair = T.StructType(
        [T.StructField("k", T.DoubleType()), T.StructField("i", keyed.schema[id_column].dataType)]
    )
    schema = T.StructType(
        [
            *fields,
            T.StructField("__size", T.IntegerType()),
            T.StructField("__heads", T.ArrayType(pair)),
            T.StructField("__blocks", T.ArrayType(T.ArrayType(pair))),
        ]
    )
    as_pair = lambda cut: {"k": cut[0], "i": cut[1]}
    return local_table(
        spark,
        [
            (*r[:-2], list(map(as_pair, r[-2])), [list(map(as_pair, b)) for b in r[-1]])
            for r in rows
        ],
        schema,
    )


def same_groups(groups: Sequence[str], names: Sequence[str]) -> Column:
    """Equal groups, null being one like any other."""
    out = F.lit(True)
    for group, name in zip(groups, names, strict=True):
        out = out & F.col(group).eqNullSafe(F.col(name))
    return out


def grouped_totals(
    df: DataFrame,
    score: str,
    id_column: str,
    groups: Sequence[str],
    sums: Mapping[str, Column] | None = None,
    descending: bool = True,
    rank: str = "n_pop",
    hot_rows: int | None = None,
    per_cell: int | None = None,
) -> DataFrame:
    """``running_totals`` where groups are many and some hold much of the data.

    A small group is one partition of an ordinary window. A hot one (``hot_rows`` rows and a
    thousandth of all) is cut into cells by (score, id), each a partition of that window; what lies
    before a cell comes from a table of the hot groups' cells alone, so neither the number of
    groups nor the largest one decides what a task or a broadcast holds. Null is a group like any
    other. ``df`` is read four times if there are hot groups: pass a stored table or a scan.
    """
    sums, groups = dict(sums or {}), list(groups)
    keyed = _keyed(df, score, descending)
    for name, value in sums.items():
        keyed = keyed.withColumn(f"__{name}", value)
    rows = keyed.count()
    hot = hot_groups(keyed, groups, rows, hot_rows)
    if per_cell is None:
        even = rows // (3 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        most = sum(row[-1] for row in hot) // MAX_CELLS + 1
        per_cell = max(most, min(ROWS_PER_CELL, max(even, MIN_ROWS_PER_CELL)))
    names = [f"__g{i}" for i in range(len(groups))]
    if hot:
        cuts = group_cuts(keyed, id_column, groups, hot, per_cell)
        here = F.struct(F.col(KEY).alias("k"), F.col(id_column).alias("i"))

        def lower(column: Column) -> Column:
            return F.size(F.filter(column, lambda cut: cut < here))

        block = lower(F.col("__heads")) - 1
        place = block * F.col("__size") + lower(F.get(F.col("__blocks"), block))
        joined = keyed.join(F.broadcast(cuts), same_groups(groups, names), "left")
        cell = F.when(F.col("__heads").isNull() | (block < 0), 0).otherwise(place)
        keyed = joined.withColumn(SLICE, cell).withColumn("__cut", F.col("__heads").isNotNull())
        keyed = keyed.drop(*names, "__size", "__heads", "__blocks")
    else:
        keyed = keyed.withColumns({SLICE: F.lit(0), "__cut": F.lit(False)})
    inside = Window.partitionBy(*groups, SLICE).orderBy(KEY, id_column)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = keyed.select(
        "*",
        F.row_number().over(inside).alias("__row"),
        *[F.sum(f"__{name}").over(so_far).alias(f"__run_{name}") for name in sums],
    )
    totals = (
        keyed.filter("__cut")
        .groupBy(*groups, SLICE)
        .agg(
            F.count(F.lit(1)).alias("__rows"),
            *[F.sum(f"__{name}").alias(f"__sum_{name}") for name in sums],
        )
    )
    earlier = Window.partitionBy(*groups).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(g).alias(n) for g, n in zip(groups, names, strict=True)],
        F.col(SLICE).alias("__slice_of"),
        *[F.sum(c).over(earlier).alias(c) for c in totals.columns if c not in (*groups, SLICE)],
    )
    here = same_groups([*groups, SLICE], [*names, "__slice_of"])
    out = local.join(F.broadcast(offsets), here, "left") if hot else local.withColumns(
        {c: F.lit(None).cast("bigint") for c in ("__rows", *[f"__sum_{name}" for name in sums])}
    )
    zero = F.lit(0).cast("bigint")
    return out.select(
        *df.columns,
        (F.coalesce("__rows", zero) + F.col("__row")).alias(rank),
        *[
            (F.coalesce(F.col(f"__sum_{name}"), zero) + F.col(f"__run_{name}")).alias(name)
            for name in sums
        ],
    )


@dataclass(frozen=True)
class Cut:
    """The row at a rank position of a group; position 0 lies before every row."""

    position: int
    key: float | None = None
    id: object = None
    descending: bool = True

    @property
    def score(self) -> float | None:
        if self.key is None:
            return None
        return (-self.key if self.descending else self.key) + 0.0

    def covers(self, score: str, id_column: str) -> Column:
        """True for rows at or before the cut: a narrow filter, no shuffle."""
        if self.key is None:
            return F.lit(False)
        value = F.col(score).cast("double")
        key = (-value if self.descending else value) + F.lit(0.0)
        here = F.lit(self.key)
        inside = (key < here) | ((key == here) & (F.col(id_column) <= F.lit(self.id)))
        return F.coalesce(inside, F.lit(False))


def rank_cuts(
    df: DataFrame,
    score: str,
    id_column: str,
    positions: Callable[[int], Sequence[int]],
    groups: Sequence[str] = (),
    descending: bool = True,
    cells: int | None = None,
) -> dict[tuple, list[Cut]]:
    """The rows at the given rank positions, per group, without ranking the rest.

    ``positions`` gets a group's row count. Only cells holding a wanted position are shuffled
    and ordered; everything else is counted where it lies.
    """
    groups = list(groups)
    keyed = _keyed(df, score, descending).select(KEY, id_column, *groups)
    cuts = choose_cuts(keyed, id_column, cells)
    placed = with_cells(keyed, id_column, cuts)
    counted = placed.groupBy(*groups, *CELL).agg(F.count(F.lit(1)).alias("n")).collect()

    found: dict[tuple, dict[int, Cut]] = {}
    wanted: dict[tuple, list[int]] = {}
    targets = []
    per_group: dict[tuple, list] = {}
    for row in counted:
        per_group.setdefault(tuple(row[g] for g in groups), []).append(row)
    for group, rows in per_group.items():
        rows.sort(key=lambda r: (r[BUCKET], r[SLICE]))
        total = sum(r["n"] for r in rows)
        wanted[group] = list(positions(total))
        found[group] = {}
        for position in set(wanted[group]):
            if not 0 <= position <= total:
                raise ValueError(f"position {position} is outside 0..{total}")
            if position == 0:
                found[group][0] = Cut(0, descending=descending)
                continue
            before = 0
            for r in rows:
                if before + r["n"] >= position:
                    targets.append((*group, r[BUCKET], r[SLICE], position - before, position))
                    break
                before += r["n"]
    if targets:
        schema = T.StructType(
            [placed.schema[g] for g in groups]
            + [
                T.StructField(BUCKET, T.IntegerType()),
                T.StructField(SLICE, T.IntegerType()),
                T.StructField("__row", T.IntegerType()),
                T.StructField("__position", T.LongType()),
            ]
        )
        points = F.broadcast(local_table(df.sparkSession, targets, schema))
        on = [*groups, *CELL]
        hit_cells = sorted({target[: len(on)] for target in targets})
        hit = local_table(df.sparkSession, hit_cells, T.StructType(schema.fields[: len(on)]))
        inside = Window.partitionBy(*on).orderBy(KEY, id_column)
        hits = (
            placed.join(F.broadcast(hit), on, "left_semi")
            .withColumn("__row", F.row_number().over(inside))
            .join(points, [*on, "__row"])
            .select(*groups, KEY, id_column, "__position")
        )
        for row in hits.collect():
            group = tuple(row[g] for g in groups)
            position = row["__position"]
            found[group][position] = Cut(position, row[KEY], row[id_column], descending)
    return {group: [found[group][p] for p in wanted[group]] for group in wanted}


def share_position(share: str, total: int) -> int:
    """Rows in the top share: floor(share * total), in exact decimal arithmetic."""
    return int(Decimal(share) * total)


def top_share(
    df: DataFrame, score: str, id_column: str, share: str, cells: int | None = None
) -> Cut:
    cuts = rank_cuts(df, score, id_column, lambda n: [share_position(share, n)], cells=cells)
    return cuts[()][0] if cuts else Cut(0)


def tile_ends(tiles: int) -> Callable[[int], list[int]]:
    """Last rank of all tiles but the last, as ``ntile`` sizes them."""

    def ends(total: int) -> list[int]:
        size, larger = divmod(total, tiles)
        return [size * t + min(t, larger) for t in range(1, tiles)]

    return ends


def tile(cuts: Sequence[Cut], score: str, id_column: str) -> Column:
    """The tile number of each row from the cuts of ``tile_ends``."""
    number = F.lit(len(cuts) + 1)
    for index in range(len(cuts), 0, -1):
        number = F.when(cuts[index - 1].covers(score, id_column), index).otherwise(number)
    return number
