"""Vector codes: the lookup and the whole operator against plain distances."""

import collections
import hashlib
import math
import random

import numpy as np
import pytest

from counterfoil.llm import vector_codes
from counterfoil.llm.vector_codes import Codebook, compress

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, code int, vector double"


def brute(rows, parts=4, count=256, rounds=4, scale=1024):
    """(id, code, error, label_error, digest) of every kept row."""
    kept = [
        (i, label, [math.floor(scale * float(np.float32(x))) for x in v])
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    width = -(-max((len(v) for _, _, v in kept), default=0) // parts) * parts
    dims = width // parts
    kept = [(i, label, v + [0] * (width - len(v))) for i, label, v in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    cut = lambda v: [tuple(v[p * dims : (p + 1) * dims]) for p in range(parts)]
    books = [[cut(v)[p] for _, _, v in kept[:count]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds if kept else 0):
        for p in range(parts):
            won = collections.defaultdict(list)
            for _, _, v in kept:
                x = cut(v)[p]
                won[nearest(x, books[p])[1]].append(x)
            for k, xs in won.items():
                books[p][k] = tuple(sum(c) // len(xs) for c in zip(*xs))
    told = [(i, label, [nearest(x, books[p]) for p, x in enumerate(cut(v))]) for i, label, v in kept]
    total = collections.Counter()
    for _, label, found in told:
        total[label] += sum(d for d, _ in found)
    digest = hashlib.sha256(
        ",".join(str(c) for book in books for e in book for c in e).encode()
    ).hexdigest()
    return [
        (i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), total[label], digest)
        for i, label, found in told
    ]


def as_set(rows):
    return sorted(map(repr, map(tuple, rows)))


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1, 2.0) for i, v, label in rows], SCHEMA)


@pytest.mark.parametrize("count, dims, spread", [(256, 16, 300), (70, 3, 5), (1, 4, 9), (64, 1, 40)])
def test_lookup_finds_the_nearest_entry_and_the_first_of_equals(count, dims, spread):
    draw = np.random.default_rng(count)
    entries = draw.integers(-spread, spread, (count, dims))
    entries[count // 2 :: 7] = entries[0]
    x = np.concatenate([draw.integers(-2 * spread, 2 * spread, (500, dims)), entries, 50 * entries])
    index, square = Codebook(entries).nearest(x)
    all_squares = ((x[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
    assert (index == all_squares.argmin(axis=1)).all()
    assert (square == all_squares.min(axis=1)).all()


def test_masks_hold_just_the_entries_of_the_cube():
    draw = np.random.default_rng(1)
    entries = draw.integers(-20, 20, (100, 5))
    x, radius = draw.integers(-20, 20, (50, 5)), draw.integers(0, 15, 50)
    masks = Codebook(entries).within(x, radius)
    bits = np.unpackbits(masks.view(np.uint8), axis=1, bitorder="little")[:, :100]
    apart = np.abs(x[:, None, :] - entries[None, :, :]).max(axis=2)
    assert (bits == (apart <= radius[:, None])).all()


@pytest.mark.parametrize("dense", [1, 1 << 40])
def test_both_ways_of_measuring_agree(monkeypatch, dense):
    monkeypatch.setattr(vector_codes, "DENSE", dense)
    draw = np.random.default_rng(2)
    entries, x = draw.integers(-900, 900, (256, 16)), draw.integers(-900, 900, (300, 16))
    index, square = Codebook(entries).nearest(x)
    squares = ((x[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
    assert (index == squares.argmin(axis=1)).all() and (square == squares.min(axis=1)).all()


def test_clustered_entries_are_pruned():
    """Near a tight cluster the cube holds that cluster's entries alone."""
    draw = np.random.default_rng(3)
    centers = draw.integers(-100_000, 100_000, (32, 8))
    entries = np.concatenate([c + draw.integers(-9, 9, (8, 8)) for c in centers])
    book = Codebook(entries)
    masks = book.within(entries, np.full(len(entries), book.radius))
    held = np.unpackbits(masks.view(np.uint8), axis=1).sum()
    assert held <= 8 * len(entries)


def test_roots():
    square = np.array([0, 1, 2, 3, 4, 5, 99, 100, 101, (1 << 31) ** 2, (1 << 31) ** 2 + 1])
    assert vector_codes.root_above(square).tolist() == [
        0, 1, 2, 2, 2, 3, 10, 10, 11, 1 << 31, (1 << 31) + 1]


def test_compress_equals_plain_python(spark):
    draw = random.Random(4)
    rows = [(i, [draw.gauss(0, 0.2) for _ in range(8)], draw.choice([1, 2, None])) for i in range(120)]
    rows += [rows[3]] * 40  # repeated rows
    rows += [(None, rows[5][1], 2), (200, rows[6][1], 3), (200, rows[7][1], 3)]
    got = compress(table_of(spark, rows).repartition(3), count=16)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert as_set(got.collect()) == as_set(brute(rows, count=16))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, -0.25, 0.1], 1), (2, None, 1), (3, [nan, 1.0], 1), (4, [1.0, None], 1),
        (5, [inf, 0.0], 2), (6, [], None), (7, [0.25] * 9, None), (8, [-1e-9], 2), (1, [0.5, -0.25, 0.1], 1),
    ]
    assert as_set(compress(table_of(spark, rows)).collect()) == as_set(brute(rows))
    assert not compress(table_of(spark, [])).collect()
    assert not compress(table_of(spark, rows[1:5])).collect()
    assert as_set(compress(table_of(spark, [(6, [], 1)])).collect()) == as_set(brute([(6, [], 1)]))
    with pytest.raises(ValueError, match="64 bits"):
        compress(table_of(spark, [(1, [1e30, 2.0], 1)]))
    with pytest.raises(ValueError, match="hex"):
        compress(table_of(spark, rows), count=300)
