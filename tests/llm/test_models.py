"""The models against plain versions of their methods, and their sampling and gates."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from counterfoil.llm import language, quality, toxicity
from counterfoil.llm.common import fold

from test_operators import docs_of, insulting  # noqa: F401

# Toxicity: Viterbi against all paths


def all_paths(restorer, word, most):
    """The best score over every way through the lattice."""
    best = -math.inf
    for path in itertools.product(*[restorer.options(word, i, most) for i in range(len(word))]):
        score, a, b = 0.0, 0, 0
        for letter, cost in path:
            score += cost
            if letter:
                code = toxicity.symbol(letter)
                score += restorer.log_p[a][b][code]
                a, b = (0, 0) if letter == " " else (b, code)
        best = max(best, score + restorer.log_p[a][b][0])
    return best


def value(restorer, word, text, most):
    """The best score of the paths that put out ``text``."""
    best = -math.inf
    for path in itertools.product(*[restorer.options(word, i, most) for i in range(len(word))]):
        if "".join(letter for letter, _ in path) != text:
            continue
        score, a, b = 0.0, 0, 0
        for letter, cost in path:
            score += cost
            if letter:
                code = toxicity.symbol(letter)
                score += restorer.log_p[a][b][code]
                a, b = (0, 0) if letter == " " else (b, code)
        best = max(best, score + restorer.log_p[a][b][0])
    return best


@pytest.mark.parametrize("most", [1, 2])
def test_viterbi_finds_the_best_of_all_paths(most):
    draw = np.random.default_rng(4)
    restorer = toxicity.Restorer(np.log(draw.dirichlet(np.ones(64) / 3, (64, 64)) + 1e-6))
    signs = "abo13$@!|.-(xx €"
    rnd = random.Random(4)
    words = ["".join(rnd.choices(signs, k=rnd.randint(1, 6))) for _ in range(150)]
    words += ["m0r0n", "$$@", "a.b.c", "1l1", "xxyy", "i d i"]
    for word in words:
        got = restorer.restore(word, most)
        assert value(restorer, word, got, most) == pytest.approx(all_paths(restorer, word, most))


@pytest.fixture(scope="module")
def restorer():
    text = "the moron and the idiot are a clown and an ass in the stone " * 50
    return toxicity.Restorer(toxicity.trigram_model(toxicity.count_trigrams([text])))


@pytest.mark.parametrize(
    "word, plain",
    [("mooron", "moron"), ("iddiot", "idiot"), ("4$$", "ass"), ("@$$", "ass"), ("m0r0n", "moron"), ("a$$", "ass"),
     ("idiot", "idiot"), ("c|own", "clown"), ("m.o.r.o.n", "moron")],
)
def test_no_form_the_lattice_covers_is_skipped(restorer, word, plain):
    assert plain in restorer.plain(word)


def test_runs_of_single_letters_with_any_blanks_are_joined(restorer):
    for text in ("you i  d  i  o  t !", "you\ni\n\nd\ti \t o\nt", "i d i o t"):
        assert any("idiot" in restorer.plain(w) for w in restorer.words(text))


@pytest.mark.parametrize("word", ["555-1234", "+1", "!!!", "***", "...", "10-12", "---"])
def test_numbers_and_marks_alone_are_left(restorer, word):
    assert not restorer.noisy(word)


def test_many_stars_cost_no_more_than_other_signs(restorer):
    """Up to the stated numbers stars stand for letters, beyond them for nothing."""
    assert restorer.restore("id" + "*" + "ot") == "idiot"
    for word in ("a" + "*" * 20_000 + "b", "a*b" * 5_000, "*" * 20_000, "a" * 30_000 + "*"):
        assert set(restorer.restore(word)) <= set("ab" if "*" in word[:-1] else word[:1] + "abcdefghijklmnopqrstuvwxyz ")
    six, seven = "a" + "*" * toxicity.STAR_RUN + "b", "a" + "*" * (toxicity.STAR_RUN + 1) + "b"
    assert restorer.restore(seven) == "ab" and len(restorer.restore(six)) >= 2


def test_the_character_model_knows_all_scripts():
    for text in ("привет мир", "你好 世界", "γειά σου"):
        counts = toxicity.count_trigrams([text])
        letters = sum(c.isalpha() for c in text)
        assert counts.sum() >= letters
        codes = [toxicity.symbol(c) if c.isalpha() else 0 for c in f"  {text}  "]
        want = np.zeros(64**3, int)
        for a, b, c in zip(codes, codes[1:], codes[2:]):
            if b or (not a and c):
                want[(a * 64 + b) * 64 + c] += 1
        assert (counts == want).all()


def test_registered_forms_are_caught_and_clean_texts_kept(spark, insulting):  # noqa: F811
    rows, known = insulting
    hidden = ["mooron", "iddiot", "i  d  i  o  t", "cloown", "st*pid", "$tuppid"]
    clean = ["good food book letter", "price $100 or 50%", "call 555-1234", "a" + "*" * 5_000 + "b", "*** !!! ***"]
    extra = [(5_000 + i, f"the stone {h} thing rest", "en", "s") for i, h in enumerate(hidden)]
    extra += [(6_000 + i, c, "en", "s") for i, c in enumerate(clean)]
    got = {
        r.doc_id: r.predicted
        for r in toxicity.classify(docs_of(spark, rows + extra), known, learns=fold("doc_id", 5) != 0).collect()
    }
    assert [got[5_000 + i] for i in range(len(hidden))] == [1] * len(hidden)
    assert [got[6_000 + i] for i in range(len(clean))] == [0] * len(clean)


# Language: FTRL against a plain loop, quotas


def test_ftrl_equals_a_plain_loop():
    draw = random.Random(3)
    classes, size = 3, 12
    leader = language.Ftrl(size, classes)
    z, n = [[0.0] * classes for _ in range(size)], [[0.0] * classes for _ in range(size)]

    def weight(i, c):
        if abs(z[i][c]) <= language.L1:
            return 0.0
        shrunk = z[i][c] - math.copysign(language.L1, z[i][c])
        return -shrunk / ((language.BETA + math.sqrt(n[i][c])) / language.ALPHA + language.L2)

    for _ in range(300):
        at = draw.sample(range(size), 4)
        x = [draw.random() for _ in at]
        y = at[0] % classes
        logits = [sum(v * weight(i, c) for i, v in zip(at, x)) for c in range(classes)]
        e = [math.exp(v - max(logits)) for v in logits]
        old = {(i, c): weight(i, c) for i in at for c in range(classes)}
        for i, v in zip(at, x):
            for c in range(classes):
                g = v * (e[c] / sum(e) - (c == y))
                sigma = (math.sqrt(n[i][c] + g * g) - math.sqrt(n[i][c])) / language.ALPHA
                z[i][c] += g - sigma * old[i, c]
                n[i][c] += g * g
        leader.learn(np.array(at), np.array(x), y)
    got = leader.weights(slice(None))
    want = [[weight(i, c) for c in range(classes)] for i in range(size)]
    assert np.abs(got - want).max() < 1e-9 and (got != 0).any()


def test_rare_languages_keep_a_quota():
    shares = language.sample_shares({"en": 1_000_000, "xx": 30, "yy": 5}, 4_000)
    assert shares["xx"] == shares["yy"] == 1.0 and 0.003 < shares["en"] < 0.0045
    assert set(language.sample_shares({"en": 100, "de": 50}, 4_000).values()) == {1.0}
    many = language.sample_shares({f"l{i}": 100 for i in range(1000)}, 4_000)
    assert sum(100 * s for s in many.values()) <= 1000 * language.LEAST_QUOTA + 1


def test_a_language_below_the_sample_is_still_learned(spark):
    draw = random.Random(8)
    kinds = {"en": "the and of th ing er on".split(), "qq": "xqz zqx qqx xzq".split()}
    rows = [
        (i, " ".join("".join(draw.choices(kinds[k], k=3)) for _ in range(8)), k, "s")
        for i in range(3000)
        for k in ["qq" if i % 150 == 0 else "en"]
    ]
    got = language.identify(docs_of(spark, rows), learns=fold("doc_id", 3) != 1, max_labelled=100).collect()
    told = {r.doc_id: r.lang_pred for r in got}
    assert all(told[i] == lang for i, _, lang, _ in rows)


def test_hundreds_of_languages(spark):
    """More of them than a matrix of all buckets would hold: fewer buckets, no error."""
    assert language.bucket_count(4) == language.BUCKETS
    assert language.bucket_count(600) * 600 <= language.MODEL_CELLS
    rows = [(i, f"w{i % 520:03d}x " * 6, f"l{i % 520}", "s") for i in range(1040)]
    got = language.identify(docs_of(spark, rows), learns=F.lit(True)).collect()
    assert len(got) == 1040 and all(0 <= r.score <= 1 for r in got)
    assert len({r.lang_pred for r in got}) > 100


# Quality: ridge against a direct solve


def test_normal_equations_equal_a_direct_solve(spark):
    draw = np.random.default_rng(6)
    size = len(quality.STATISTICS)
    stats = draw.normal(size=(300, size))
    y = (stats[:, 0] + 0.3 * draw.normal(size=300) > 0).astype(int)
    train = spark.createDataFrame(
        [(s.tolist(), int(v)) for s, v in zip(stats, y)], "stats array<double>, y int"
    ).repartition(4)
    model = quality.fit(train)
    assert np.allclose(model.mean, stats.mean(axis=0)) and np.allclose(model.scale, stats.std(axis=0))
    z = model.features(stats)
    penalty = np.full(z.shape[1], math.sqrt(quality.RIDGE * 300 / quality.FOURIER))
    penalty[-1] = 0
    direct, *_ = np.linalg.lstsq(
        np.vstack([z, np.diag(penalty)]), np.concatenate([y, np.zeros(z.shape[1])]), rcond=None
    )
    assert np.abs(z @ direct - model.ridge(stats)).max() < 1e-6


def test_calibration_comes_from_rows_the_ridge_has_not_seen(spark):
    """Labels of noise: calibrated on its own rows the ridge would claim to tell them apart.
    The equations of a fold are those of its rows alone."""
    draw = np.random.default_rng(8)
    stats, y = draw.normal(size=(400, len(quality.STATISTICS))), draw.integers(0, 2, 400)
    train = spark.createDataFrame([(s.tolist(), int(v)) for s, v in zip(stats, y)], "stats array<double>, y int")
    fresh = quality.fit(train).score(draw.normal(size=(400, len(quality.STATISTICS))))
    assert abs(fresh.mean() - y.mean()) < 0.1 and fresh.std() < 0.25
    model = quality.fit(train)
    gram, target = quality.normal_equations(train, model)
    for f in range(quality.FOLDS):
        rows = train.filter(quality.fold_of() == f).collect()
        z = model.features(np.array([r.stats for r in rows]))
        assert np.allclose(gram[f], z.T @ z) and np.allclose(target[f], z.T @ np.array([r.y for r in rows]))
    few = spark.createDataFrame([(stats[0].tolist(), 0), (stats[1].tolist(), 1)], "stats array<double>, y int")
    assert isinstance(quality.fit(few), quality.QualityModel)


def test_isotonic_levels_are_the_closest_ascending_ones():
    """Against the min-max formula of isotonic regression."""
    draw = np.random.default_rng(7)
    count = draw.integers(1, 9, 30).astype(float)
    positive = np.minimum(draw.integers(0, 9, 30), count)
    got = quality.pool_violators(count, positive)
    for k in range(30):
        want = max(
            min(positive[i : j + 1].sum() / count[i : j + 1].sum() for j in range(k, 30))
            for i in range(k + 1)
        )
        assert got[k] == pytest.approx(want)
