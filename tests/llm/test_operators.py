"""The operators on hand-made tables and against brute force."""

import base64
import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from counterfoil.llm import (
    bpe,
    dart_minhash,
    exact_dedup,
    graph,
    language,
    mixing,
    quality,
    suffix_tree,
    topk,
    toxicity,
    url_filter,
)
from counterfoil.llm.common import fold, salted_join
from counterfoil.llm.registry import bpe_vocabulary

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "id bigint, hash string, norm string, node bigint, label int, evidence double, key string"
)
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(40_000))


def docs_of(spark, rows):
    """Documents with extra columns named like columns the operators use inside."""
    full = [(i, t, lang, s, 7, 1, "h", "n", 2, 3, 0.5, "k") for i, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA)


HOSTILE = [
    (1, None, "en", "a"),
    (2, "", "en", "a"),
    (3, "Hello World again and again", "en", None),
    (4, "hello world again and again", "en", None),
    (4, "hello world again and again", "en", None),
    (None, "hello world again and again", None, "b"),
    (5, "  \t\n ", "de", "b"),
    (6, LONG, "de", "b"),
    (7, "1234 !!! ...", "de", "c"),
    (8, "ÄÖ ß é\u2028x\0y \U0001f600", "de", "c"),
    (None, None, None, None),
]


@pytest.fixture(scope="module")
def hostile(spark):
    return docs_of(spark, HOSTILE).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return docs_of(spark, [])


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (3, 1, 1), (3, None, 0), (4, 0, None), (None, 1, 1), (6, 0, 1), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def lowered(text):
    return (text or "").encode().lower().decode()


def test_salted_join_deals_a_hot_key_out_and_loses_nothing(spark):
    left = spark.range(6_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    right = left.select("k").distinct().withColumn("w", F.col("k") * 2)
    joined = salted_join(left, right, "k")
    assert joined.count() == 6_000 and joined.filter("w != 2 * k").isEmpty()
    assert "__salt" in joined._jdf.queryExecution().toString()


# Exact duplicates


def test_exact_groups(hostile):
    rows = exact_dedup.exact_groups(hostile).collect()
    assert len(rows) == len(HOSTILE)
    groups = collections.defaultdict(list)
    for i, text, _, _ in HOSTILE:
        groups[lowered(text)].append(i)
    want = collections.Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            want[i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()] += 1
    assert collections.Counter(tuple(r) for r in rows) == want
    least = {r.doc_id: r.keep_id for r in exact_dedup.exact_groups(hostile, keep="smallest").collect()}
    assert least[4] == least[3] == 3 and least[2] == 1


def test_equal_hashes_with_different_texts_stay_apart(hostile):
    weak = lambda text: F.length(text).cast("string")
    strong = sorted(map(repr, exact_dedup.exact_groups(hostile).collect()))
    assert sorted(map(repr, exact_dedup.exact_groups(hostile, content_hash=weak).collect())) == strong


def test_deduplicate_keeps_whole_rows(hostile, nothing):
    kept = exact_dedup.deduplicate(hostile)
    assert kept.columns == hostile.columns
    rows = kept.collect()
    assert len(rows) == len({lowered(t) for _, t, _, _ in HOSTILE})
    assert {r.doc_id for r in rows if r.text and r.text.startswith("hello")} == {4}
    assert exact_dedup.deduplicate(nothing).count() == 0
    assert exact_dedup.exact_groups(nothing).count() == 0


# Near duplicates


def words(n, seed):
    draw = random.Random(seed)
    return [f"{draw.randrange(10**6)}" for _ in range(n)]


def changed(text, at):
    return [("x" if i in at else w) for i, w in enumerate(text)]


def brute_classes(rows, threshold=0.8):
    def shingles(text):
        w = (text or "").encode().lower().split()
        runs = [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] * bool(w)
        return collections.Counter(runs)

    sets = [(i, shingles(t)) for i, t in rows]
    top = list(range(len(sets)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            one, two = sets[a][1], sets[b][1]
            common = sum((one & two).values())
            union = sum(one.values()) + sum(two.values()) - common
            if (common / union if union else 1) >= threshold:
                top[find(a)] = find(b)
    ids = collections.defaultdict(list)
    for n, (i, _) in enumerate(sets):
        ids[find(n)].append(i)
    return collections.Counter(
        (i, min((x for x in m if x is not None), default=None), len(m)) for m in ids.values() for i in m
    )


def test_near_duplicates_equal_brute_force(spark):
    rows = []
    for base in range(12):
        text = words(120, base)
        for copy in range(8):
            at = random.Random(100 * base + copy).sample(range(120), copy // 2)
            rows.append((len(rows), " ".join(changed(text, at))))
    passage = " ".join(words(30, 77))
    rows += [(1_000 + i, passage + " " + " ".join(words(25, 500 + i))) for i in range(30)]
    rows += [(2_000 + i, passage + " " + " ".join(words(3, 900 + i))) for i in range(30)]
    rows += [(3_000 + i, t) for i, t in enumerate(["one two", "One  two", "one", "", None, " "])]
    rows += [(4_000, "a b " * 400), (4_001, "a b " * 380), (4_002, "a b " * 100)]
    got = dart_minhash.near_duplicates(docs_of(spark, [(i, t, "en", "s") for i, t in rows]))
    assert collections.Counter((r.doc_id, r.class_id, r.class_size) for r in got.collect()) == (
        brute_classes(rows)
    )


def test_near_duplicates_of_odd_rows(hostile, nothing):
    got = dart_minhash.near_duplicates(hostile).collect()
    assert collections.Counter((r.doc_id, r.class_id, r.class_size) for r in got) == brute_classes(
        [(i, t) for i, t, _, _ in HOSTILE]
    )
    kept = dart_minhash.keep_one(hostile)
    assert kept.columns == hostile.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 6, 7, 8]
    assert dart_minhash.near_duplicates(nothing).count() == 0
    assert dart_minhash.keep_one(nothing).count() == 0


def test_one_row_of_each_class_stays_whatever_its_id(spark):
    texts = [" ".join(f"{name}{i}" for i in range(30)) for name in "abcdefg"]
    a, b, c, d, e, f, g = texts
    # Null ids: unrelated a and b, c twice, and copies of d, which has an id.
    rows = [(None, a), (None, b), (None, c), (None, c.upper()), (None, d), (7, d), (None, d)]
    # One id: two texts of different classes, and rows that repeat.
    rows += [(8, e), (8, f), (8, f), (9, f), (10, g)]
    docs = docs_of(spark, [(i, t, "en", "s") for i, t in rows]).repartition(3)
    kept = collections.Counter(
        (r.doc_id, r.text.lower()) for r in dart_minhash.keep_one(docs).collect()
    )
    assert kept == {(None, a): 1, (None, b): 1, (None, c): 1, (7, d): 1, (8, e): 1, (8, f): 1, (10, g): 1}
    # A single row without an id brings back no other one.
    docs = docs_of(spark, [(i, t, "en", "s") for i, t in [(None, a), (None, d), (7, d)]])
    kept = [(r.doc_id, r.text) for r in dart_minhash.keep_one(docs).collect()]
    assert collections.Counter(kept) == {(None, a): 1, (7, d): 1}
    # Near copies under one id are one class.
    near = a.replace("a29", "z")
    docs = docs_of(spark, [(5, a, "en", "s"), (5, near, "en", "s"), (6, b, "en", "s")])
    kept = sorted(r.doc_id for r in dart_minhash.keep_one(docs).collect())
    assert kept == [5, 6]


def test_members_beyond_the_hub_are_compared(spark):
    """A chain: neighbours are close, the ends are not, and one bucket may hold all of it."""
    text = words(200, 5)
    rows = [(i, " ".join(changed(text, set(range(0, 8 * i, 5))))) for i in range(14)]
    got = dart_minhash.near_duplicates(docs_of(spark, [(i, t, "en", "s") for i, t in rows]))
    assert collections.Counter((r.doc_id, r.class_id, r.class_size) for r in got.collect()) == (
        brute_classes(rows)
    )


def test_signatures_estimate_weighted_similarity():
    draw = np.random.default_rng(3)
    cells = draw.integers(1, 1 << 63, 300, dtype=np.uint64)
    both = np.concatenate([cells[:200], cells[100:]])
    owner = np.repeat([0, 1], 200)
    a, b = dart_minhash.dart_signatures(both, owner, 2, 2_000)
    assert abs((a == b).mean() - 1 / 3) < 0.05
    fill = np.where(owner == 1, 0.5, 1.0)  # weights 1 against 1/2: 50 / 250
    a, b = dart_minhash.dart_signatures(both, owner, 2, 2_000, fill)
    assert abs((a == b).mean() - 0.2) < 0.05


def test_components(spark):
    draw = random.Random(4)
    links = [(draw.randrange(400), draw.randrange(400)) for _ in range(230)]
    links += [(i, i + 1) for i in range(1_000, 1_060)] + [(2_000, i) for i in range(2_001, 2_900)]
    top = {x: x for link in links for x in link}
    changed_any = True
    while changed_any:
        changed_any = False
        for a, b in links:
            least = min(top[a], top[b])
            changed_any |= top[a] != least or top[b] != least
            top[a] = top[b] = least
    got = graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert {r.node: r.label for r in got} == {x: top[x] for x in linked}


# Mixing


def test_water_filling_clamps_and_redistributes(spark):
    sources = spark.createDataFrame(
        [("=a", 100, 5.0), ("=b", 1_000, 2.0), ("=c", 900, 1.0), ("=d", 0, 5.0)],
        "source string, source_size bigint, weight double",
    )
    got = {r.source: r.target for r in mixing.water_fill(sources, 1.5, 2.0).collect()}
    assert got == {"=a": 200.0, "=b": 2800 / 3 * 2, "=c": 2800 / 3, "=d": 0.0}
    got = {r.source: r.target for r in mixing.water_fill(sources, 9.0, 2.0).collect()}
    assert got == {"=a": 200.0, "=b": 2000.0, "=c": 1800.0, "=d": 0.0}


def test_mix_meets_targets_and_is_repeatable(spark, hostile, nothing):
    rows = [(i, "w " * (i % 50), "en", "hot" if i % 3 else f"s{i % 7}") for i in range(3_000)]
    docs = docs_of(spark, rows)
    got = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(7).orderBy(F.rand(3))).collect()
    assert sorted(got) == sorted(again) and len(got) == 3_000
    taken, target = collections.Counter(), {}
    by_id = {i: s for i, _, _, s in rows}
    for r in got:
        taken[by_id[r.doc_id]] += r.taken
        target[by_id[r.doc_id]] = r.target
        assert r.taken in (0, r.size, 2 * r.size)
    assert all(abs(taken[s] - target[s]) <= 25 for s in target)
    mixed = mixing.mixture(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.repeats for r in got)
    odd = mixing.mix(hostile).collect()
    assert sorted(r.size for r in odd) == [0, 0, 0, 0, 3, 4, 5, 5, 5, 5, 40_000]
    assert mixing.mix(nothing).count() == 0 and mixing.mixture(nothing).count() == 0


def test_given_weights(spark):
    docs = docs_of(spark, [(i, "w " * 10, "en", "ab"[i % 2] if i % 5 else None) for i in range(500)])
    weights = spark.createDataFrame([("a", 1.0), (None, 3.0)], "source string, weight double")
    got = {r.source_size: r.target for r in mixing.mix(docs, weights=weights, share=0.2).collect()}
    assert got == {1000: 750.0, 2000: got[2000]} and got[2000] in (0.0, 250.0)


# Byte-level BPE


@pytest.fixture(scope="module")
def vocabulary():
    return bpe_vocabulary()


def reference_coder(vocabulary):
    return tiktoken.Encoding(
        "own", pat_str=vocabulary.pattern, mergeable_ranks=vocabulary.ranks, special_tokens={}
    )


def test_coder_equals_tiktoken(vocabulary):
    coder, other = bpe.Coder(vocabulary), reference_coder(vocabulary)
    draw = random.Random(2)
    odd = [9, 10, 32, 39, 0x1C, 0x85, 0xA0, 0x2028, 0x3000, 0x301, 0x1F600, 0]
    texts = [LONG, "", "ab" * 5_000, "a" * 3_001, " " * 500, "it's we'LL 12 345"]
    for _ in range(400):
        points = [draw.choice([draw.randrange(32, 127), draw.randrange(0x80, 0xD7FF), draw.choice(odd)])
                  for _ in range(draw.randrange(40))]
        texts.append("".join(map(chr, points)))
    for text in texts:
        packed = coder.encode(text)
        assert memoryview(packed).cast("I").tolist() == other.encode_ordinary(text)
        assert coder.decode(packed) == text.encode()


def test_perfect_hash_is_minimal_and_exact(vocabulary):
    whole = bpe.PerfectHash(vocabulary.ranks)
    slots = {whole.slot(key) for key in vocabulary.ranks}
    assert slots == set(range(len(vocabulary.ranks)))
    assert whole.slot(b"no such token") == bpe.PerfectHash([]).slot(b"a") == -1


def test_encode_table(hostile, nothing, vocabulary):
    rows = bpe.encode(hostile, vocabulary).collect()
    other = reference_coder(vocabulary)
    want = collections.Counter((i, tuple(other.encode_ordinary(t or "")), t or "") for i, t, _, _ in HOSTILE)
    got = collections.Counter(
        (r.doc_id, tuple(memoryview(bytes(r.ids)).cast("I").tolist()), bytes(r.decoded).decode())
        for r in rows
    )
    assert got == want
    texts = bpe.decode(bpe.encode(hostile, vocabulary, with_text=False), vocabulary).collect()
    assert sorted(r.text for r in texts) == sorted(t or "" for _, t, _, _ in HOSTILE)
    assert bpe.encode(nothing, vocabulary).count() == 0
    told = bpe.encode_digests(hostile, vocabulary).collect()
    assert sorted(map(repr, told)) == sorted(map(repr, bpe.digests(bpe.encode(hostile, vocabulary)).collect()))
    assert bpe.encode_digests(nothing, vocabulary).count() == 0


def test_vocabulary_without_all_bytes_is_refused(tmp_path):
    (tmp_path / "ranks").write_bytes(base64.b64encode(b"a") + b" 0\n")
    with pytest.raises(ValueError, match="no token for the byte"):
        bpe.Vocabulary.read(str(tmp_path / "ranks"), public_tokenizers.PATTERN)


# URL filter


def test_cascade_is_exact(spark):
    keys = spark.range(30_000).select(F.concat(F.lit("k"), F.col("id")).alias("key"))
    listed = keys.filter("crc32(cast(key AS binary)) % 5 = 0")
    cascades = list(url_filter.build_cascades(listed, keys))
    got = url_filter.with_membership(keys, cascades, F.col("key"), "listed")
    assert got.filter("listed != (crc32(cast(key AS binary)) % 5 = 0)").isEmpty()
    assert [c.size() < 30_000 * 2 for _, c in cascades] == [True]  # bits, not keys


def test_cascade_in_several_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "SHARD_BITS", 4_096)
    monkeypatch.setattr(url_filter, "BLOCK_BYTES", 2_048)
    keys = spark.range(3_000).select(F.col("id").cast("string").alias("key"))
    cascades = list(url_filter.build_cascades(keys.filter("key % 2 = 0"), keys))
    assert len(cascades) == 3 and all(c.size() <= 2_048 for _, c in cascades)
    keys = keys.unionAll(keys.sparkSession.createDataFrame([(None,)], "key string"))
    got = url_filter.with_membership(keys, cascades, F.col("key"), "listed")
    assert got.count() == 3_001
    assert got.filter("NOT listed <=> (key % 2 = 0) AND key IS NOT NULL").isEmpty()
    assert got.filter("key IS NULL AND listed").isEmpty()


def test_cascade_of_nothing(spark):
    keys = spark.createDataFrame([("a",), ("a",), (None,), ("",)], "key string")
    none = keys.filter("false")
    for listed, universe, want in ((none, keys, []), (keys, none, ["", "a", "a"]), (none, none, [])):
        cascades = url_filter.build_cascades(listed, universe)
        got = url_filter.with_membership(keys, cascades, F.col("key"), "listed").filter("listed")
        assert sorted(r.key for r in got.collect()) == want


def test_url_rules(spark):
    rules = [
        url_filter.Rule("net", "/", "block"),
        url_filter.Rule("example.net", "/en/", "allow"),
        url_filter.Rule("example.com", "/de/", "block"),
    ]
    urls = {
        "http://A.Example.NET/en/x?y#z": ("a.example.net", "/en/x", "example.net/en/", "allow"),
        "http://example.net/EN/": ("example.net", "/EN/", "net/", "block"),
        "https://fooexample.net": ("fooexample.net", "", None, "allow"),
        "https://fooexample.net/": ("fooexample.net", "/", "net/", "block"),
        "x://example.com/de/": ("example.com", "/de/", "example.com/de/", "block"),
        "x://notexample.com/de/": ("notexample.com", "/de/", None, "allow"),
        "http://b.org/a://c.net/": ("b.org", "/a://c.net/", None, "allow"),
        "http://?q": ("", "", None, "allow"),
        "no scheme.net/": ("", "", None, "allow"),
        "line\nbreak://net/\n": ("net", "/\n", "net/", "block"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    rows = [(i, u, "host", True, "rule") for i, u in enumerate(urls)] * 2 + [(None, None, "", None, "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, listed boolean, rule string")
    got = url_filter.filter_urls(pages, rules).collect()
    assert len(got) == 2 * len(urls) + 1
    for r in got:
        assert tuple(r)[1:] == list(urls.values())[r.page_id if r.page_id is not None else -1]
    listed = spark.createDataFrame([("notexample.com/de/",), ("a.example.net/en/x",)], "key string")
    told = {r.page_id: r.verdict for r in url_filter.filter_urls(pages, rules, listed).collect()}
    assert told[5] == "block" and told[0] == "allow"
    assert url_filter.filter_urls(pages.filter("false"), rules).count() == 0


# Top-k


def brute_top(rows, k=20):
    """Every row is a candidate for all others; repeated rows ask and are found each."""
    good = []
    for i, v, _ in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        good.append((i, [math.floor(64 * float(np.float32(x))) for x in v]))
    out = collections.Counter()
    for at, (q, x) in enumerate(good):
        if q % 20 == 0:
            dots = sorted(
                (-sum(a * b for a, b in zip(x, y)), c) for to, (c, y) in enumerate(good) if to != at
            )
            out.update((q, rank, c, -s) for rank, (s, c) in enumerate(dots[:k], 1))
    return out


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 7)
    monkeypatch.setattr(topk, "LEAST_RANGE", 60)
    monkeypatch.setattr(topk, "TILE_BYTES", 60 * 8 * 5)
    draw = random.Random(9)
    rows = [(i, [draw.gauss(0, 0.3) for _ in range(5)], i) for i in range(200)]
    rows += [(200 + i, [0.5] * 5, 0) for i in range(60)]  # ties
    rows += [(300, None, 1), (320, [1.0, None], 1), (340, [1.0, math.nan], 1), (None, [1.0], 1)]
    rows += [(360, [1.0, math.inf], 1), (380, [], 1), (400, [2.0, -1.0], 1), rows[20], rows[20]]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, id int")
    got = topk.top_k(vectors, F.col("vec_id") % 20 == 0).collect()
    assert collections.Counter(map(tuple, got)) == brute_top(rows)
    assert topk.top_k(vectors.filter("false"), F.col("vec_id") % 20 == 0).count() == 0
    few = topk.top_k(vectors.filter("vec_id IN (0, 1, 2)"), F.col("vec_id") % 20 == 0).collect()
    assert [r.rank for r in sorted(few)] == [1, 2]


def test_scores_beyond_exact_doubles_stay_whole():
    vectors = np.array([[(1 << 53) + 2, 0], [(1 << 53) + 3, 0], [1, 0]], np.int64)
    ids = np.arange(3)
    _, found, scores = topk.best_of_group(ids, ids, vectors, ids[2:], vectors[2:], 1)
    assert (found.tolist(), scores.tolist()) == ([1], [(1 << 53) + 3])


def test_blocks_of_clustered_vectors_are_skipped():
    """Near a cluster the bounds of other clusters' blocks are below the k-th score."""
    draw = np.random.default_rng(2)
    centers = draw.integers(-400, 400, (40, 16))
    vectors = np.concatenate([c + draw.integers(-20, 20, (300, 16)) for c in centers])
    vectors = vectors[draw.permutation(len(vectors))]
    rows = np.arange(len(vectors))
    visited = []
    at, found, scores = topk.best_of_group(rows, rows, vectors, rows[:50], vectors[:50], 20, visited)
    assert len(visited) == 50 and np.mean(visited) < 0.3 * len(vectors) / topk.BLOCK_ROWS
    for q in range(50):
        dots = vectors @ vectors[q]
        dots[q] = -(10**9)
        want = np.lexsort((rows, -dots))[:20]
        assert found[at == q].tolist() == want.tolist() and scores[at == q].tolist() == dots[want].tolist()


def test_shuffled_rows_grow_with_the_table():
    """Up to a tile of queries no vector is copied, and queries once for each partition; beyond
    it the copies grow by tiles of 65,536, not by rows."""

    def moved(count):
        _, ranges, chunks = topk.tiles(count, count // 20, 64, 200)
        return count * chunks + count // 20 * ranges

    assert [topk.tiles(n, n // 20, 64, 12)[2] for n in (10_256, 51_282, 1_300_000)] == [1, 1, 1]
    assert moved(51_282) < 6 * moved(10_256)
    assert moved(1_300_000) <= 11 * 1_300_000
    assert moved(100_000_000) < 100_000_000 * 160
    assert topk.tiles(0, 0, 0, 8) == (topk.LEAST_RANGE, 1, 1)


# Suffix tree


def test_suffix_tree_counts_and_shares(spark, hostile, nothing):
    draw = random.Random(1)
    rows = [(i, " ".join(draw.choices(["a", "B", "c", f"r{i}"], [6, 3, 2, 1], k=40)), "en", "s")
            for i in range(300)]
    rows += [(400 + i, "x y z " * 30, "en", "s") for i in range(40)] + HOSTILE
    got = suffix_tree.score(docs_of(spark, rows), learns=fold("doc_id", 7) != 2).collect()
    counts = collections.Counter()
    of = lambda t: [*(t or "").encode().lower().split(), b" "]
    learns = lambda i: i is None or zlib.crc32(str(i).encode()) % 7 != 2
    for i, t, _, _ in rows:
        if learns(i):
            counts.update(of(t))
    total, kinds = sum(counts.values()), len(counts)
    want = collections.Counter()
    for i, t, _, _ in rows:
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in of(t))
        want[i, len(of(t)), sum(counts[w] > 0 for w in of(t)), total, round(base, 5)] += 1
    have = collections.Counter(
        (r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got
    )
    assert have == want
    assert all(r.score <= 0 and math.isfinite(r.score) for r in got)
    held = [r for r in got if r.doc_id is not None and not learns(r.doc_id)]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert suffix_tree.score(nothing, learns=fold("doc_id", 7) != 2).count() == 0
    none = suffix_tree.score(hostile, learns=F.lit(False)).collect()
    assert {r.train_tokens for r in none} == {0} and {r.base_score for r in none} == {0.0}


def test_suffix_tree_is_a_distribution(spark):
    draw = random.Random(6)
    texts = [" ".join(draw.choices("a b c d e".split(), k=30)) + " a b c" * 5 for _ in range(200)]
    frame = docs_of(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    binary = frame.select(F.col("text").cast("binary").alias("text"))
    counts = suffix_tree.word_counts(binary)
    tree = suffix_tree.learn(binary, counts)
    assert [len(o.codes) > 0 for o in tree.orders] == [True, True]
    assert any(len(o.next_codes) for o in tree.orders)
    for context in (b"", b"a", b"a b", b"c a", b"e q"):
        total = 0.0
        for word in [*tree.symbol, b"zzz"]:
            text = context.split() + [word]
            ids = np.array([tree.symbol.get(w, tree.size - 1) for w in text])
            total += 10 ** tree.log_shares(ids, np.array([0, len(ids)]))[-1]
        assert abs(total - 1) < 1e-9


def suffix_tree_by_hand(texts, learned, depth):
    """log10 of the share of every text, from whole counts of all contexts."""
    count = [collections.Counter() for _ in range(depth + 1)]
    total = [collections.Counter() for _ in range(depth + 1)]
    tokens = lambda t: t.lower().split() + [" "]

    def contexts(words, i):
        return [tuple([" ", *words][i + 1 - k : i + 1]) for k in range(min(depth, i + 1) + 1)]

    for t in learned:
        for i, w in enumerate(tokens(t)):
            for k, s in enumerate(contexts(tokens(t), i)):
                count[k][s, w] += 1
                total[k][s] += 1
    n, singles = total[0][()], sum(c == 1 for c in count[0].values())
    unseen = (singles + 1) / (n + singles + 1)
    follows = collections.defaultdict(list)
    for k in range(1, depth + 1):
        for (s, w), c in count[k].items():
            follows[s].append((w, c))
    retained = set()

    def share(s, w):
        if not s:
            c = count[0][(), w]
            return (1 - unseen) * c / n if c else unseen
        under = share(s[1:], w)
        if s not in retained:
            return under
        c, t = count[len(s)][s, w], total[len(s)][s]
        return max(c - 0.5, 0) / t + len(follows[s]) * 0.5 / t * under

    for s in sorted(follows, key=len):
        t = total[len(s)][s]
        gain = sum(c * math.log(c / t / share(s[1:], w)) for w, c in follows[s])
        if t >= 2 and gain > 0.5 * len(follows[s]) * math.log(t):
            retained.add(s)
    return [
        sum(math.log10(share(contexts(tokens(t), i)[-1], w)) for i, w in enumerate(tokens(t)))
        for t in texts
    ], retained


@pytest.mark.parametrize(("depth", "head"), [(2, 1_000_000), (2, 30), (3, 30), (3, 1)])
def test_suffix_tree_keeps_rare_words_contexts_and_next_words(spark, monkeypatch, depth, head):
    draw = random.Random(9)
    vocabulary = [f"v{i}" for i in range(1500)]
    # Pairs and triples that are far below one in 10,000 when the corpus is large.
    phrases = [draw.choices(vocabulary, k=4) for _ in range(300)]
    texts = [
        " ".join(w for _ in range(6) for w in [*draw.choice(phrases), draw.choice(vocabulary)])
        for _ in range(400)
    ]
    texts += ["", "never seen v1 v2 words"]
    learned = [t for i, t in enumerate(texts[:-1]) if i % 4]
    want, retained = suffix_tree_by_hand(texts, learned, depth)
    assert {len(s) for s in retained} == set(range(1, depth + 1))
    assert len(retained) > 1000
    monkeypatch.setattr(suffix_tree, "HEAD", head)
    docs = docs_of(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]).repartition(3)
    learns = (F.col("doc_id") % 4 != 0) & (F.col("doc_id") < len(texts) - 1)
    got = {r.doc_id: r.score for r in suffix_tree.score(docs, learns, depth).collect()}
    assert [round(got[i], 6) for i in range(len(texts))] == [round(x, 6) for x in want]


@pytest.mark.parametrize(("depth", "group"), [(1, 200), (2, 200), (3, 200), (3, 1000)])
def test_suffix_tree_deals_frequent_contexts_out(spark, monkeypatch, depth, group):
    draw = random.Random(12)
    words = ["of", "the", *(f"v{i}" for i in range(200))]
    texts = []
    for i in range(300):
        text = draw.choices(words, [40, 40] + [1] * 200, k=30) + ["of", "the", draw.choice(words)]
        texts.append(" ".join([*text, "a", "b", "c", "d", *draw.choices([f"r{i}", "e"], k=2)]))
    # Held-out texts have frequent contexts before words that never followed, or never occurred.
    texts += ["of the of the new", "a b new a b v7 new new c of", "", "a b c d d of the"] * 2
    last = len(texts) - 8
    learned = [t for i, t in enumerate(texts[:last]) if i % 4]
    want, _ = suffix_tree_by_hand(texts, learned, depth)
    levels = []
    known = suffix_tree.hot_contexts
    monkeypatch.setattr(
        suffix_tree, "hot_contexts", lambda *x: levels.append(known(*x)) or levels[-1]
    )
    monkeypatch.setattr(suffix_tree, "GROUP", group)
    monkeypatch.setattr(suffix_tree, "HEAD", 500)
    docs = docs_of(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]).repartition(3)
    learns = (F.col("doc_id") % 4 != 0) & (F.col("doc_id") < last)
    got = {r.doc_id: r.score for r in suffix_tree.score(docs, learns, depth).collect()}
    assert max(levels[0].parts) > 1
    assert len(levels) == (depth if group == 200 else 1) and all(len(x.codes) for x in levels)
    assert [round(got[i], 6) for i in range(len(texts))] == [round(x, 6) for x in want]


def test_suffix_tree_moves_few_bytes_a_token(spark, tmp_path):
    draw = random.Random(13)
    words, weights = [f"w{i}" for i in range(3000)], [1 / (i + 1) for i in range(3000)]
    texts = [" ".join(draw.choices(words, weights, k=400)) for _ in range(500)]
    rows = [(t, i % 7 != 2) for i, t in enumerate(texts)]
    rows = spark.createDataFrame(rows, "text string, learns boolean")
    rows = rows.select(F.col("text").cast("binary").alias("text"), "learns").coalesce(1)
    counts = suffix_tree.word_counts(rows.filter("learns").select("text"))
    tree = suffix_tree.frequent_words(counts)
    none = suffix_tree.Hot(np.zeros(0, np.int64), np.zeros(0, np.int64))
    often = suffix_tree.seen_often(suffix_tree.roots(counts, tree))
    blocks = suffix_tree.occurrences(rows, tree, 2, [none], 4, often)
    blocks.write.option("compression", "none").parquet(str(tmp_path / "blocks"))
    size = sum(f.stat().st_size for f in (tmp_path / "blocks").glob("*.parquet"))
    # A row of the former counts had four 64-bit numbers, and was moved and stored three times.
    assert size < 8 * 401 * 500


# Classifiers


def test_language(spark, hostile, nothing):
    draw = random.Random(8)
    kinds = {"en": "the and of th ing er on".split(), "de": "der und sch ung ein ich".split()}
    rows = [
        (i, " ".join("".join(draw.choices(kinds[k], k=3)) for _ in range(20)), k, "s")
        for i in range(400)
        for k in [("en", "de")[i % 2]]
    ]
    rows += [(1_000, None, "en", "s"), (1_001, "12 34", "en", "s"), (1_002, "", None, "s")]
    got = language.identify(docs_of(spark, rows), learns=fold("doc_id", 3) != 1).collect()
    told = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert all(told[i].lang_pred == lang for i, _, lang, _ in rows[:400])
    assert {told[i].lang_pred for i in (1_000, 1_001, 1_002)} == {"und"}
    assert all(0 <= r.score <= 1 for r in got)
    odd = language.identify(hostile, learns=fold("doc_id", 3) != 1).collect()
    assert len(odd) == len(HOSTILE)
    assert language.identify(nothing, learns=fold("doc_id", 3) != 1).count() == 0
    untaught = language.identify(hostile, learns=F.lit(False)).collect()
    assert {(r.lang_pred, r.score) for r in untaught} == {("und", 0.0)}


def test_n_grams_do_not_span_texts():
    alone = [language.n_grams([t]) for t in ("ab", "", "a b\0c")]
    row, bucket, count = language.n_grams(["ab", "", "a b\0c"])
    for i, (_, b, c) in enumerate(alone):
        assert (bucket[row == i] == b).all() and (count[row == i] == c).all()
    assert language.n_grams([])[0].size == 0


def test_penalty_makes_weights_sparse():
    leader = language.Ftrl(50, 2)
    draw = np.random.default_rng(1)
    for i in range(400):
        at = np.array([i % 2, *draw.choice(np.arange(2, 50), 3, replace=False)])
        leader.learn(at, np.full(4, 0.5), i % 2)
    weights = leader.weights(slice(None))
    assert weights[0, 0] > 0 > weights[0, 1] and (weights[2:] == 0).mean() > 0.3


def test_quality(spark, hostile, nothing, labels):
    draw = random.Random(3)
    rows, marks = [], []
    for i in range(600):
        good = i % 3 > 0
        text = " ".join("".join(draw.choices("aeinrst", k=draw.randrange(2, 9))) for _ in range(50))
        rows.append((i, text if good else text.upper().replace(" ", "!! "), "en", "s"))
        marks.append((i, int(good)))
    known = spark.createDataFrame(marks, "doc_id bigint, quality int")
    got = quality.classify(docs_of(spark, rows), known, "quality", learns=fold("doc_id", 5) != 0)
    got = got.collect()
    assert len(got) == 600 and all(r.predicted == int(r.doc_id % 3 > 0) for r in got)
    odd = quality.classify(hostile, labels, "quality", learns=F.lit(True)).collect()
    assert len(odd) == len(HOSTILE) and all(0 <= r.score <= 1 for r in odd)
    assert quality.classify(nothing, labels, "quality", learns=F.lit(True)).count() == 0
    none = quality.classify(hostile, labels, "quality", learns=F.lit(False)).collect()
    assert {r.score for r in none} == {0.5}


def test_copies_of_a_labelled_text_spread_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(quality, "ROWS_PER_TASK", 100)
    seen, whole = [], quality.normal_equations

    def watched(train, model):
        per_task = train.groupBy(F.spark_partition_id()).count().collect()
        seen.extend(r["count"] for r in per_task)
        return whole(train, model)

    monkeypatch.setattr(quality, "normal_equations", watched)
    rows = [([float(i % 7 if i > 500 else 3)] * 18, i % 2) for i in range(1000)]
    quality.fit(spark.createDataFrame(rows, "stats array<double>, y int"))
    assert sum(seen) == 1000 and max(seen) < 200


def test_pooling_gives_ascending_means():
    count, positive = np.array([2.0, 4, 1, 3]), np.array([1.0, 1, 1, 2])
    assert quality.pool_violators(count, positive) == pytest.approx([1 / 3, 1 / 3, 0.75, 0.75])


@pytest.fixture(scope="module")
def insulting(spark):
    """Texts of which every eighth has an insult; labels for all."""
    draw = random.Random(5)
    plain = ["the", "thing", "stone", "inner", "rest", "idea", "ion", "lot", "cloth", "mood"]
    rows, marks = [], []
    for i in range(1_600):
        text = draw.choices(plain, k=30)
        if i % 8 == 0:
            text[draw.randrange(30)] = ("idiot", "moron", "clown", "stupid")[i // 8 % 4]
        rows.append((i, " ".join(text), "en", "s"))
        marks.append((i, int(i % 8 == 0)))
    return rows, spark.createDataFrame(marks, "doc_id bigint, toxic int")


def test_toxicity_restores_and_scores(spark, insulting):
    rows, known = insulting
    hidden = ["m0r0n", "id1ot", "i d i o t", "m.o.r.o.n", "cl0wn!!", "stuuupid", "$tupid", "MORON"]
    extra = [(5_000 + i, f"the stone {h} thing rest", "en", "s") for i, h in enumerate(hidden)]
    clean = ["the stone rest 555-1234", "", None, "in n e r", "+1 !!! ***", "t h e stone"]
    extra += [(6_000 + i, c, "en", "s") for i, c in enumerate(clean)]
    docs = docs_of(spark, rows + extra)
    got = {r.doc_id: r for r in toxicity.classify(docs, known, learns=fold("doc_id", 5) != 0).collect()}
    assert all(got[i].predicted == int(i % 8 == 0) for i, *_ in rows)
    assert [got[5_000 + i].predicted for i in range(len(hidden))] == [1] * len(hidden)
    assert [got[6_000 + i].predicted for i in range(len(clean))] == [0] * len(clean)
    kept = toxicity.reject(docs, known, learns=fold("doc_id", 5) != 0)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}


def test_toxicity_of_odd_rows(hostile, nothing, labels):
    got = toxicity.classify(hostile, labels, learns=F.lit(True)).collect()
    assert len(got) == len(HOSTILE) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.classify(nothing, labels, learns=F.lit(True)).count() == 0
    none = toxicity.classify(hostile, labels, learns=F.lit(False)).collect()
    assert {r.score for r in none} == {0.5}
    assert toxicity.reject(hostile, labels, learns=F.lit(False)).count() == len(HOSTILE)
