"""Near duplicates by DartMinHash signatures of word shingles.

A text is the multiset of its runs of five words. Every shingle owns a region of the weight
axis as long as its count, cut into unit cells; a fractional weight leaves part of its last
cell out. Darts fall on a cell as a Poisson process in rank, all decided by hashes of shingle
and cell, so two texts see the same darts where their regions overlap. Each dart hits one
coordinate of the signature, and the earliest dart per coordinate stays. Two signatures agree
in a coordinate with the probability of the weighted Jaccard similarity. Ranks are followed up
to the bound where all coordinates are expected to be hit, doubled for texts with gaps; a text
of n shingles so costs O(n + k log k) and not O(n k).

Signatures are cut into bands; texts that share a band meet in a bucket. Within a bucket pairs
are never all emitted: every text is compared, by its whole shingle multiset, with one hub of
the bucket, and what stays outside the hub's component is looked at again. A text can only be
similar to another if enough of its cells occur in other texts at all, so the cells of the open
buckets are counted: texts with too few shared cells are settled, the rest is compared with the
most central member of the bucket, and of the pairs still open only those are emitted whose
shared cells could make them similar. So each pair that shares a band is either compared, or
linked through others, or ruled out.

Equal texts are one node from the start, with a row count. All lists of links and classes stay
in Spark.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from counterfoil.llm.common import joined_bytes, mix, pieces, salted_join, whole_text, word_spans
from counterfoil.llm.graph import components
from counterfoil.sources.storage import store

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: With 24 bands of 5, a pair at similarity 0.8 misses all bands once in 14,000.
BANDS, BAND_ROWS = 24, 5
SEED = 0x0DA27
#: Bits of the filter of texts that have candidates: 4 MB, whatever the number of texts.
FILTER_BITS = 1 << 25

_U = np.uint64
_BYTE_VALUES = np.random.default_rng(SEED).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = _U(0x9E3779B97F4A7C15)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.ones(count, np.uint64)
    out[1:] = base
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word, from one running sum over the bytes."""
    base = int(_BASE)
    inverse = pow(base, -1, 1 << 64)
    terms = _BYTE_VALUES[data] * _powers(base, len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
    words = (sums[ends] - sums[starts]) * _powers(inverse, len(data) + 1)[starts]
    return mix(words + (ends - starts).astype(np.uint64))


def shingle_hashes(
    words: np.ndarray, rows: np.ndarray, count: int, size: int = SHINGLE_WORDS
) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every shingle. A row of fewer words than ``size`` is one shingle."""
    per_row = np.bincount(rows, minlength=count)
    first = np.concatenate([[0], np.cumsum(per_row)])[:-1]
    shingles = np.where(per_row >= size, per_row - size + 1, np.minimum(per_row, 1))
    owner = np.repeat(np.arange(count), shingles)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    at = first[owner] + nth
    length = np.minimum(per_row[owner], size)
    out = length.astype(np.uint64)
    for i in range(size):
        here = i < length
        word = words[np.minimum(at + i, max(len(words) - 1, 0))]
        out = np.where(here, mix(out * _BASE + word), out)
    return out, owner


def elements(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit cells of the weighted multiset, sorted by row: (shingle, nth occurrence) as a hash."""
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(new)
    nth = np.arange(len(hashes)) - np.repeat(starts, np.diff(np.append(starts, len(hashes))))
    return mix(hashes + _BASE * nth.astype(np.uint64)), owner


def dart_signatures(
    cells: np.ndarray,
    owner: np.ndarray,
    count: int,
    size: int,
    fill: np.ndarray | None = None,
) -> np.ndarray:
    """A signature of ``size`` 64-bit values per row; zeros for rows without cells.

    ``cells`` are hashes of unit cells, sorted by row. ``fill`` is the part of each cell that
    belongs to the row, 1 if left out: darts beyond it miss.
    """
    found = np.zeros((count, size), np.uint64)
    weight = np.bincount(owner, weights=fill, minlength=count).astype(float)
    bound = np.where(weight > 0, (size * math.log(size) + 2 * size) / np.maximum(weight, 1e-9), 0)
    todo = weight > 0
    empty = _U(0xFFFFFFFFFFFFFFFF)
    while todo.any():
        best = np.full(count * size, empty)
        at = np.flatnonzero(todo[owner])
        rank = np.zeros(len(at))
        throw = 0
        while len(at):
            throw += 1
            dart = mix(cells[at] + _U((throw * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF))
            # Gaps of a Poisson process of rate 1, from the upper bits.
            rank = rank - np.log(((dart >> _U(11)).astype(float) + 0.5) / 2.0**53)
            near = rank <= bound[owner[at]]
            at, rank, dart = at[near], rank[near], dart[near]
            second = mix(dart ^ _BASE)
            hits = slice(None)
            if fill is not None:
                hits = (mix(second ^ _BASE) >> _U(11)).astype(float) / 2.0**53 < fill[at]
            place = owner[at[hits]] * size + (second[hits] % _U(size)).astype(np.int64)
            # Rank in the upper half, so the earliest is the least; the dart's name below.
            name = rank[hits].astype(np.float32).view(np.uint32).astype(np.uint64) << _U(32)
            np.minimum.at(best, place, name | (second[hits] >> _U(32)))
        best = best.reshape(count, size)
        whole = todo & (best != empty).all(axis=1)
        found[whole] = best[whole]
        todo &= ~whole
        bound = bound * 2
    return found


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band."""
    parts = mix(signatures).reshape(len(signatures), bands, rows)
    keys = np.arange(bands, dtype=np.uint64)[None, :] * _BASE
    for i in range(rows):
        keys = mix(keys * _U(0xD1B54A32D192ED03) + parts[:, :, i])
    return keys.view(np.int64)


def plain_words(text: bytes) -> bytes:
    """The words after lower-casing A-Z, a blank between them."""
    return b" ".join(text.lower().split())


def content_key(words: bytes) -> int:
    """64 bits of a cryptographic hash of the words of a text."""
    return int.from_bytes(hashlib.blake2b(words, digest_size=8).digest(), "little", signed=True)


@F.pandas_udf(LongType())
def node_of(texts: pd.Series) -> pd.Series:
    """The node of each text (binary, no nulls), as in ``sketch``."""
    return texts.map(lambda t: content_key(plain_words(bytes(t)))).astype("int64")


def sketch(docs: DataFrame, bands: int = BANDS, rows: int = BAND_ROWS) -> DataFrame:
    """(id, node, cells, bands) per row: content key, shingle multiset, band keys.

    The content key is 64 bits of a cryptographic hash of the words; texts with the same words
    after lower-casing A-Z are one node. Cells are 32-bit hashes of (shingle, occurrence).
    ``docs`` has the columns id and text, without null texts.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                texts = [plain_words(t) for t in piece["text"].to_pylist()]
                node = [content_key(t) for t in texts]
                data, begins = joined_bytes(pa.array(texts, pa.binary()))
                starts, ends, row = word_spans(data, begins)
                hashes, owner = shingle_hashes(word_hashes(data, starts, ends), row, len(texts))
                cells, owner = elements(hashes, owner)
                signatures = dart_signatures(cells, owner, len(texts), bands * rows)
                keys = band_keys(signatures, bands, rows)
                counts = np.bincount(owner, minlength=len(texts))
                cut = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                # Texts without words have no bands.
                held = np.where(counts > 0, bands, 0)
                band_cut = np.concatenate([[0], np.cumsum(held)]).astype(np.int32)
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": piece["id"],
                        "node": pa.array(node, pa.int64()),
                        "cells": pa.ListArray.from_arrays(
                            cut, pa.array((cells >> _U(32)).astype(np.uint32).view(np.int32))
                        ),
                        "bands": pa.ListArray.from_arrays(
                            band_cut, pa.array(keys[counts > 0].ravel())
                        ),
                    }
                )

    id_type = docs.schema["id"].dataType.simpleString()
    return docs.select("id", F.col("text").cast("binary").alias("text")).mapInArrow(
        work, f"id {id_type}, node bigint, cells array<int>, bands array<bigint>"
    )


def _held(nodes: DataFrame) -> Broadcast:
    """A filter of ``FILTER_BITS`` bits that knows at least the given nodes."""
    place = F.pmod(F.xxhash64("node"), F.lit(FILTER_BITS))
    words = (
        nodes.select(place.alias("place"))
        .groupBy(F.expr("place div 64").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("bits"))
    )
    found = np.zeros(FILTER_BITS // 64, np.int64)
    rows = words.toArrow()
    found[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return nodes.sparkSession.sparkContext.broadcast(found)


def _cells_of(sketches: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, cells) of the given nodes, stored.

    Most texts have no candidate at all. A filter of fixed size keeps their cells out of the
    shuffle; if it were full, all would be shuffled and the result be the same.
    """
    held = _held(nodes)

    @F.pandas_udf("boolean")
    def known(places: pd.Series) -> pd.Series:
        at = places.to_numpy()
        return pd.Series((held.value[at >> 6] >> (at & 63)) & 1 == 1)

    place = F.pmod(F.xxhash64("node"), F.lit(FILTER_BITS))
    return store(
        sketches.select("node", "cells")
        .filter(known(place))
        .join(nodes, "node", "semi")
        .groupBy("node")
        .agg(F.first("cells").alias("cells")),
        "cells",
    )


def _links_among(pairs: DataFrame, cells: DataFrame, threshold: float) -> DataFrame:
    """Those pairs (a, b) whose whole multisets are similar; many pairs may share an ``a``."""
    b_side = cells.select(F.col("node").alias("b"), F.col("cells").alias("cells_b"))
    a_side = cells.select(F.col("node").alias("a"), F.col("cells").alias("cells_a"))
    with_b = store(salted_join(pairs, b_side, "b"), "pairs-half")
    both = salted_join(with_b, a_side, "a")
    common = F.size(F.array_intersect("cells_a", "cells_b"))
    union = F.size("cells_a") + F.size("cells_b") - common
    return store(both.filter(common >= threshold * union).select("a", "b"), "links")


def _sizes_fit(one: str, two: str, threshold: float) -> Column:
    """Similar multisets have similar sizes."""
    return F.least(one, two) >= threshold * F.greatest(one, two)


def _with_hub(met: DataFrame, threshold: float) -> DataFrame:
    """Distinct pairs of a hub and a member whose sizes allow a link."""
    return store(
        met.filter((F.col("node") != F.col("hub")) & _sizes_fit("size", "hub_size", threshold))
        .select(F.col("hub").alias("a"), F.col("node").alias("b"))
        .distinct(),
        "hub-pairs",
    )


def _shared_cells(cells: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, shared): how many of a node's cells another of the nodes has too."""
    one = cells.join(nodes, "node", "semi").select("node", F.explode("cells").alias("cell"))
    one = store(one, "open-cells")
    several = one.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return salted_join(one, several, "cell").groupBy("node").agg(F.count(F.lit(1)).alias("shared"))


def near_links(sketches: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """Links (a, b) of nodes that join all pairs at ``threshold`` or more that share a band.

    Not every such pair is a row: pairs joined through others are left out.
    """
    buckets = store(
        sketches.filter(F.size("bands") > 0)
        .select("node", F.size("cells").alias("size"), F.explode("bands").alias("band"))
        .distinct(),
        "buckets",
    )
    # The hub is the least node by an order that differs from band to band.
    mixed = F.col("node").bitwiseXOR(F.col("band"))
    hubs = (
        buckets.groupBy("band")
        .agg(F.min(mixed).alias("least"), F.count(F.lit(1)).alias("members"))
        .filter("members > 1")
    )
    hubs = hubs.select("band", F.col("least").bitwiseXOR(F.col("band")).alias("hub"), "members")
    sizes = buckets.select("band", F.col("node").alias("hub"), F.col("size").alias("hub_size"))
    met = store(
        salted_join(buckets, store(hubs.join(sizes, ["band", "hub"]), "hubs"), "band"), "met"
    )
    pairs = _with_hub(met, threshold)
    cells = _cells_of(sketches, met.select("node").distinct())
    links = _links_among(pairs, cells, threshold)
    labels = components(links)

    # Buckets of three or more with members outside the hub's component are open.
    told = _labelled(_labelled(met.filter("members > 2"), labels, "node"), labels, "hub")
    told = store(told, "told")
    bands = told.filter("label_node != label_hub").select("band").distinct()
    members = store(told.join(bands, "band", "semi").select("band", "node", "size"), "open")
    if members.isEmpty():
        return links
    # Twice: fewer texts alive leave fewer cells shared among them.
    for _ in range(2):
        shared = _shared_cells(cells, members.select("node").distinct())
        # The small allowance keeps a pair at exactly the threshold, whatever the rounding.
        enough_cells = F.col("shared") + 1e-6 >= threshold * F.col("size")
        members = store(
            members.select("band", "node", "size").join(shared, "node").filter(enough_cells),
            "alive",
        )
    # The member with the largest part of shared cells is the second hub.
    central = members.groupBy("band").agg(
        F.max_by(
            F.struct(F.col("node").alias("hub"), F.col("size").alias("hub_size")),
            F.struct(F.col("shared") / F.col("size"), F.col("size"), F.col("node")),
        ).alias("best")
    )
    central = store(central.select("band", "best.*"), "central")
    met = store(salted_join(members, central, "band"), "met-again")
    links = store(
        links.unionAll(_links_among(_with_hub(met, threshold), cells, threshold)), "links"
    )
    labels = components(links)
    own_bands = members.groupBy("node").agg(F.sort_array(F.collect_set("band")).alias("bands"))
    told = _labelled(_labelled(met, labels, "node"), labels, "hub").join(own_bands, "node")
    told = store(told, "told")
    outside = told.filter("label_node != label_hub").alias("o")
    # With the sizes a and b, a link has at least (a + b) t / (1 + t) common cells.
    enough = threshold / (1 + threshold)
    rest = (
        outside.join(told.alias("m"), F.col("o.band") == F.col("m.band"))
        .filter(
            "o.label_node != m.label_node AND m.node != m.hub "
            # each pair once: in its first common band, and not again from the other side
            "AND (m.label_node = m.label_hub OR o.node < m.node) "
            "AND element_at(array_intersect(o.bands, m.bands), 1) = o.band AND "
            f"least(o.shared, m.shared) + 1e-6 >= {enough} * (o.size + m.size)"
        )
        .select(F.least("o.node", "m.node").alias("a"), F.greatest("o.node", "m.node").alias("b"))
        .distinct()
    )
    return links.unionAll(_links_among(store(rest, "rest"), cells, threshold))


def _labelled(df: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """Add the component of a node; a node without links is its own."""
    told = labels.select(F.col("node").alias(column), F.col("label").alias(f"label_{column}"))
    name = f"label_{column}"
    return df.join(told, column, "left").withColumn(name, F.coalesce(name, column))


def _labelled_nodes(
    docs: DataFrame, threshold: float, id_column: str, text_column: str
) -> tuple[DataFrame, DataFrame]:
    """The sketches, and (node, least_id, copies, label) of every node; both are stored."""
    rows = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text"))
    sketches = store(sketch(rows), "sketches")
    labels = components(near_links(sketches, threshold))
    nodes = sketches.groupBy("node").agg(
        F.min("id").alias("least_id"), F.count(F.lit(1)).alias("copies")
    )
    nodes = _labelled(nodes, labels, "node").withColumnRenamed("label_node", "label")
    return sketches, store(nodes, "node-labels")


def near_duplicates(
    docs: DataFrame,
    threshold: float = SIMILARITY,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per input row: id, class_id, class_size, kept.

    A class is a connected set of texts linked at ``threshold`` or more; its id is its smallest
    document id, and the row with that id is kept. Null counts as empty; texts without words
    are one class, linked with nothing else, and texts with equal words always share a class.
    A text of fewer than five words is one shingle. Rows with a null id are in the class of
    their text and are kept only if the class has no other id; rows of a class that repeat its
    id are marked alike, and ``keep_one`` leaves one of them. Other columns are not read.
    """
    sketches, nodes = _labelled_nodes(docs, threshold, id_column, text_column)
    classes = nodes.groupBy("label").agg(
        F.min("least_id").alias("class_id"), F.sum("copies").alias("class_size")
    )
    told = store(
        salted_join(nodes.select("node", "label"), classes, "label").drop("label"), "told"
    )
    return salted_join(sketches.select("id", "node"), told, "node").select(
        F.col("id").alias(id_column),
        "class_id",
        "class_size",
        F.expr("id <=> class_id").alias("kept"),
    )


def keep_one(
    docs: DataFrame,
    threshold: float = SIMILARITY,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row of each class, with all its columns.

    It has the smallest id of the class, null only if there is no other, and of several texts
    with that id the one with the least content key. Of rows that are alike in both, the
    largest by the other columns stays. Classes that share an id, or have none, keep one each.
    """
    sketches, nodes = _labelled_nodes(docs, threshold, id_column, text_column)
    # A node is in one class only, so it names the class.
    first = F.struct(F.col("least_id").isNull(), F.col("least_id"), F.col("node"))
    kept = (
        nodes.groupBy("label")
        .agg(F.min_by(F.struct("node", "least_id"), first).alias("kept"))
        .select(F.col("kept.node").alias("__node"), F.col("kept.least_id").alias("__id"))
    )
    copies = sketches.groupBy(F.col("node").alias("__node"), F.col("id").alias("__id"))
    repeated = copies.agg(F.count(F.lit(1)).alias("__rows")).filter("__rows > 1")
    repeated = repeated.withColumnsRenamed({"__node": "node", "__id": "id"})
    same = F.expr("__node = node AND __id <=> id")
    kept = store(
        kept.join(repeated, same, "left").select(
            "__node", "__id", F.col("__rows").isNotNull().alias("__several")
        ),
        "kept-rows",
    )
    # The row stays together, so that no column's name can clash with those used here.
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        node_of(whole_text(text_column).cast("binary")).alias("node"),
        F.col(id_column).alias("id"),
    )
    single = keyed.join(kept.filter("NOT __several"), same, "left_semi").select("row.*")
    several = kept.filter("__several")
    if several.isEmpty():
        return single
    plain = [
        F.col(f"row.`{f.name}`") for f in docs.schema if f.dataType.typeName() not in ("map", "variant")
    ]
    chosen = (
        keyed.join(several, same, "left_semi")
        .groupBy("node")
        .agg(F.max_by("row", F.struct(*plain)).alias("row"))
        .select("row.*")
    )
    return single.unionAll(chosen)
