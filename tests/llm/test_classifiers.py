"""Quality and toxicity: held-out accuracy on planted labels, edge cases."""
import math
import random
import zlib

import numpy as np
import pandas as pd
import pytest

from estuary.llm import quality, toxicity


def prose(rng, n):
    return " ".join(rng.choice("abcdefgh") * rng.randrange(1, 4) + rng.choice(["an", "or", "it", "es"]) + str(rng.choice("xyz"))
                    for _ in range(n)) + "."


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        text, q, tox = prose(rng, rng.randrange(20, 200)), 1, 0
        if i % 7 == 0:
            text, q = "### $$$ &&& " * rng.randrange(5, 40), 0
        elif i % 3 == 0:
            w = text.split()
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["vile", "Rotten,", "foul"]))
            text, tox = " ".join(w), 1
        rows.append((i, text, f"s{i % 4}"))
        labels.append((i, q, tox))
    return rows, labels


def labels_df(spark, labels):
    return spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_quality_separates_held_out(spark, docs_of, corpus):
    rows, labels = corpus
    model = quality.fit(docs_of(rows), labels_df(spark, labels))
    out = quality.classify(docs_of(rows), model).collect()
    truth = {i: q for i, q, _ in labels}
    held = [r for r in out if r.held_out]
    assert 60 < len(held) < 180 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in out)


def test_quality_moments_match_direct_fit(spark, docs_of, corpus):
    """The distributed sums give the model of a direct fit; labels of hold-out rows do not matter."""
    rows, labels = corpus
    model = quality.fit(docs_of(rows), labels_df(spark, labels))

    train = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5]
    x = np.array([quality.statistics(rows[i][1]) for i in train])
    y = np.array([labels[i][1] for i in train])
    n = np.array([np.sum(y == 0), np.sum(y == 1)], float)
    s1 = np.array([x[y == c].sum(0) for c in (0, 1)])
    s2 = np.array([x[y == c].T @ x[y == c] for c in (0, 1)])
    direct = quality.from_moments(n, s1, s2)
    flipped = [(i, q if zlib.crc32(str(i).encode()) % 5 else 1 - q, t) for i, q, t in labels]
    again = quality.fit(docs_of(rows), labels_df(spark, flipped))
    at = np.array([quality.statistics(t) for _, t, _ in rows])
    assert np.allclose(model.scores(at), direct.scores(at)) and np.allclose(model.scores(at), again.scores(at))


def test_density_difference_is_the_gaussian_one():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, len(quality.FEATURES)))
    y = (x[:, 0] + 0.3 * rng.normal(size=400) > 0).astype(int)
    s1 = np.array([x[y == c].sum(0) for c in (0, 1)])
    s2 = np.array([x[y == c].T @ x[y == c] for c in (0, 1)])
    m = quality.from_moments(np.array([np.sum(y == 0), np.sum(y == 1)], float), s1, s2)
    z = (x - m.shift) / m.scale
    log_p = []
    for c in (0, 1):
        cov = np.linalg.inv(m.whiten[c].T @ m.whiten[c])
        d = z - m.mean[c]
        log_p.append(np.log(np.mean(y == c)) - 0.5 * np.linalg.slogdet(cov)[1]
                     - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d))
    assert np.allclose(m.scores(x), 1 / (1 + np.exp(log_p[0] - log_p[1])))


def test_toxicity_finds_planted_words(spark, docs_of, corpus):
    rows, labels = corpus
    model = toxicity.fit(docs_of(rows), labels_df(spark, labels))
    out = toxicity.classify(docs_of(rows), model).collect()
    truth = {i: t for i, _, t in labels}
    held = [r for r in out if r.held_out]
    assert np.mean([r.predicted for r in held if truth[r.doc_id]]) > 0.9
    assert np.mean([r.predicted for r in held if not truth[r.doc_id]]) < 0.05
    assert len(model.at) < 5_000 and np.all(model.value != 0)


def test_ftrl_step_matches_the_formula():
    s = toxicity.Ftrl.empty(4)
    s.z[:] = np.linspace(-5, 5, 17)
    s.n[:] = np.linspace(0, 3, 17)
    at = np.array([1, 9, 16])
    w = [0.0 if abs(z) <= toxicity.L1 else -(z - np.sign(z) * toxicity.L1)
         / ((toxicity.BETA + n ** 0.5) / toxicity.ALPHA + toxicity.L2) for z, n in zip(s.z[at], s.n[at])]
    p = 1 / (1 + np.exp(-sum(w)))
    z0, n0 = s.z[at].copy(), s.n[at].copy()
    s.learn(at, 1)
    g = p - 1  # all three lie outside the pair half of the full space, so they count 1
    assert np.allclose(s.n[at], n0 + g * g)
    assert np.allclose(s.z[at], z0 + g - (np.sqrt(n0 + g * g) - np.sqrt(n0)) / toxicity.ALPHA * w)


def plain_ftrl(rows, rounds, passes):
    """Rounds of FTRL on shards and their averaging, one coordinate at a time.
    ``rows``: (shard, ord, y, tie, text)."""
    last, half = 1 << toxicity.BITS, 1 << (toxicity.BITS - 1)
    value = lambda c: toxicity.PAIR_VALUE if half <= c < last else 1.0

    def weight(z, n):
        if abs(z) <= toxicity.L1:
            return 0.0
        return -(z - math.copysign(toxicity.L1, z)) / ((toxicity.BETA + math.sqrt(n)) / toxicity.ALPHA + toxicity.L2)

    state = {}
    for k in range(rounds):
        changes = []
        for shard in sorted({r[0] for r in rows}):
            own = sorted((r for r in rows if r[0] == shard), key=lambda r: (r[1], r[3]))
            here = dict(state)
            for e in range(passes):
                for i in np.random.default_rng(k * passes + e).permutation(len(own)):
                    at = [*toxicity.coordinates(own[i][4]).tolist(), last]
                    w = {c: weight(*here.get(c, (0.0, 0.0))) for c in at}
                    p = 1 / (1 + math.exp(-sum(w[c] * value(c) for c in at)))
                    for c in at:
                        z, n = here.get(c, (0.0, 0.0))
                        g = (p - own[i][2]) * value(c)
                        here[c] = (z + g - (math.sqrt(n + g * g) - math.sqrt(n)) / toxicity.ALPHA * w[c], n + g * g)
            changes.append({c: (z - state.get(c, (0, 0))[0], n - state.get(c, (0, 0))[1]) for c, (z, n) in here.items()})
        merged = dict(state)
        for c in set().union(*changes):
            moved = [x[c] for x in changes if c in x and x[c][1] != 0]
            if moved:
                z, n = state.get(c, (0.0, 0.0))
                merged[c] = (z + sum(d[0] for d in moved) / len(moved), n + sum(d[1] for d in moved) / len(moved))
        state = merged
    return {c: w * value(c) for c, (z, n) in state.items() if (w := weight(z, n)) != 0}


def test_rounds_and_averaging_match_plain_python(spark, docs_of, corpus):
    rows, labels = corpus[0][:150], corpus[1][:150]
    docs, marks = docs_of(rows), labels_df(spark, labels)
    used = [tuple(r) for r in toxicity.training_rows(docs, marks).select("shard", "ord", "y", "tie", "text").collect()]
    assert len({r[0] for r in used}) == toxicity.SHARDS
    want = plain_ftrl(used, 2, 2)
    model = toxicity.fit(docs, marks, rounds=2, passes=2)
    got = dict(zip(model.at.tolist(), model.value.tolist()))
    assert model.intercept == pytest.approx(want.pop(1 << toxicity.BITS, 0.0), abs=1e-4)
    # a weight at the L1 threshold may fall on either side by the rounding of what travels
    for c in got.keys() | want.keys():
        assert got.get(c, 0.0) == pytest.approx(want.get(c, 0.0), abs=1e-4)
    assert len(got) >= 3


def test_toxicity_reads_no_held_out_label(spark, docs_of, corpus):
    rows, labels = corpus[0][:120], corpus[1][:120]
    flipped = [(i, q, t if zlib.crc32(str(i).encode()) % 3 != 1 else 1 - t) for i, q, t in labels]
    a, b = (toxicity.fit(docs_of(rows), labels_df(spark, x), rounds=1, passes=1) for x in (labels, flipped))
    assert flipped != labels and np.array_equal(a.at, b.at) and np.array_equal(a.value, b.value) and a.intercept == b.intercept


@pytest.mark.parametrize("module,keep", [(quality, quality.keep_good), (toxicity, toxicity.keep_clean)])
def test_odd_rows_and_empty_tables(spark, docs_of, odd_rows, module, keep):
    docs = docs_of(odd_rows)
    labels = labels_df(spark, [(1, 1, 0), (1, 1, 0), (2, 0, 1), (2, 1, 0), (3, None, None), (None, 1, 1), (105, 1, 0),
                               (104, 0, 1), (10, 1, 0), (11, 0, 1), (12, 0, 1), (13, 1, 0), (14, 1, 0)])
    model = module.fit(docs, labels)
    out = module.classify(docs, model).collect()
    assert len(out) == len(odd_rows) and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in out)
    kept = keep(docs, model)
    assert kept.columns == docs.columns and kept.count() <= len(odd_rows)
    for some_docs, some_labels in ((docs_of([]), labels), (docs, labels_df(spark, []))):
        m = module.fit(some_docs, some_labels)
        assert module.classify(docs_of([]), m).collect() == []
        assert np.allclose([r.score for r in module.classify(docs, m).collect()], 0.5)


def test_long_and_empty_texts_are_finite():
    texts = pd.Series(["", None, "a" * 1_000_000, "b " * 500_000, "\n" * 1000])
    assert np.isfinite(np.array([quality.statistics(t) for t in texts])).all()
    assert [len(toxicity.coordinates(t)) for t in texts] == [0, 0, 1, 3, 0]
