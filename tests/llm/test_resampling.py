"""Importance resampling against plain Python, and its radix sort against sorting."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from counterfoil.llm import resampling
from counterfoil.sources.storage import store

from test_operators import HOSTILE, docs_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return (text or "").encode().lower().decode()


def in_buckets(text, count):
    return [zlib.crc32(w.encode()) % count for w in WORD.findall(lowered(text))]


def brute(docs, goals, percent=10, least=20, count=10_000, seed="2024"):
    """(id, n_features, weight, score, rank) of every row."""
    raw = collections.Counter(b for _, t in docs for b in in_buckets(t, count))
    goal = collections.Counter(b for t in goals for b in in_buckets(t, count))
    s_all, t_all = float(sum(raw.values())), float(sum(goal.values()))

    def gain(b):
        return math.floor(1000 * math.log(
            ((goal[b] + 1.0) * (s_all + count)) / ((raw[b] + 1.0) * (t_all + count))))

    rows = []
    for i, text in docs:
        found = in_buckets(text, count)
        weight = sum(map(gain, found)) // len(found) if found else 0
        name = f"{seed}:{'' if i is None else i}".encode()
        h = int(hashlib.sha256(name).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(found), weight, weight + noise))
    fit = sorted(
        (r for r in rows if r[1] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1])
    )
    drawn = percent * len(fit) // 100
    ranked = [(*r, k + 1 if k < drawn else None) for k, r in enumerate(fit)]
    return ranked + [(*r, None) for r in rows if r[1] < least]


def as_set(rows):
    return sorted(map(repr, map(tuple, rows)))


def test_words_and_hashes():
    texts = ["", "Ab c1-D", "xyz", "", "é ßü\0_q" + "w" * 100, "x", " "]
    data = [t.encode() for t in texts]
    found, first = resampling.buckets(pa.array(data, pa.binary()), 10_000)
    mine = [found[a:b].tolist() for a, b in zip(first, first[1:])]
    assert mine == [in_buckets(t, 10_000) for t in texts]
    empty = resampling.buckets(pa.array([], pa.binary()), 10)
    assert not len(empty[0]) and empty[1].tolist() == [0]


def test_resample_equals_plain_python(spark):
    draw = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    docs = [
        (draw.choice([i, i, -i, None, 7]), " ".join(draw.choices(words, k=draw.randint(0, 60))))
        for i in range(400)
    ]
    docs += [(7, docs[0][1])] * 40 + [(1 << 62, "a " * 30), (-(1 << 63), "b " * 25)]
    goals = [" ".join(draw.choices(words[:40], k=50)) for _ in range(10)]
    full = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    target = spark.createDataFrame([(g,) for g in goals], "text string")
    for percent, least in ((10, 20), (100, 1), (0, 0)):
        got = resampling.resample(full, target, percent=percent, least_words=least).collect()
        assert as_set(got) == as_set(brute(docs, goals, percent, least))


@pytest.mark.parametrize("bits, block", [(3, 16), (13, 64), (5, 1 << 20)])
def test_radix_ranks_in_many_blocks_and_digits(spark, monkeypatch, bits, block):
    """A third of the rows share one key; ranks are a permutation in the order of the key."""
    monkeypatch.setattr(resampling, "DIGIT_BITS", bits)
    monkeypatch.setattr(resampling, "LEAST_BLOCK", min(block, 64))
    monkeypatch.setattr(resampling, "MOST_BLOCK", block)
    draw = random.Random(bits)
    rows = [(draw.randint(-50, 900), draw.randint(1, 9), 0, draw.randint(-3, 40)) for _ in range(300)]
    rows += [(5, 3, 0, 11)] * 150 + [(None, 2, 0, 11)] * 5
    schema = "id bigint, n_features bigint, weight bigint, score bigint"
    table = store(spark.createDataFrame(rows, schema).repartition(5), "radix-test")
    ranked = sorted(resampling.radix_ranks(table).collect(), key=lambda r: r.place)
    assert [r.place for r in ranked] == list(range(len(rows)))
    want = sorted(rows, key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    assert [tuple(r)[:4] for r in ranked] == want


def test_a_block_keeps_its_order_within_a_digit():
    rows = pa.table({
        "id": [1, 2, 3, 4], "n_features": [0] * 4, "weight": [0] * 4, "score": [0] * 4,
        "place": [12, 10, 13, 11], "block": [2] * 4, "digit": pa.array([1, 0, 1, 1], pa.int32()),
    })
    runs = pa.table({"digit": pa.array([0, 1], pa.int32()), "first": [5, 40]})
    moved = resampling.destinations(rows, runs).to_pydict()
    assert dict(zip(moved["id"], moved["place"])) == {2: 5, 4: 40, 1: 41, 3: 42}


def test_crc_table_is_the_usual_one():
    assert all(
        zlib.crc32(bytes([b])) == int(resampling.CRC[(0xFF ^ b)] ^ np.uint32(0x00FFFFFF) ^ np.uint32(0xFFFFFFFF))
        for b in range(256)
    )


def test_odd_rows(spark):
    docs, target = docs_of(spark, HOSTILE).repartition(3), docs_of(spark, HOSTILE[2:4])
    got = resampling.resample(docs, target, percent=50, least_words=3)
    want = brute([(i, t) for i, t, _, _ in HOSTILE], [t for _, t, _, _ in HOSTILE[2:4]], 50, 3)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert as_set(got.collect()) == as_set(want)
    nothing = docs_of(spark, [])
    assert not resampling.resample(nothing, nothing).collect()
    alone = resampling.resample(docs, nothing, least_words=1).collect()
    assert as_set(alone) == as_set(brute([(i, t) for i, t, _, _ in HOSTILE], [], least=1))
