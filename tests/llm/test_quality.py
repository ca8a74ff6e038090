import random
import zlib

import numpy as np

from patronage.llm import quality


def corpus(n=400, seed=2):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 200))]
        bad = i % 6 == 0
        if bad:
            kind = rng.randrange(3)
            text = [w + rng.choice(["***", "&&&"]) for w in text] if kind == 0 else [w.upper() + "!!" for w in text] if kind == 1 else text[:1] * len(text)
        docs.append((i, " ".join(text) + ".", "x", 0.5, "label"))
        labels.append((i, int(not bad), 0))
    return docs, labels


SCHEMA = "doc_id bigint, text string, x string, score double, label string"


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    df, ls = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    rows = quality.digest(quality.scores(df, quality.train(df, ls))).collect()
    truth = {i: q for i, q, _ in labels}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows) and len(rows) == len(docs)
    out = [r for r in rows if r["held_out"]]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in out]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    kept = quality.keep(df, quality.train(df, ls))
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in rows if r["predicted"]}


def test_only_rows_that_are_not_held_out_are_learnt_from(spark):
    docs, labels = corpus(200)
    df = spark.createDataFrame(docs, SCHEMA)
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels]
    one, two = (quality.train(df, spark.createDataFrame(x, "doc_id bigint, quality int, toxic int")) for x in (labels, flipped))
    assert np.allclose(one.weights, two.weights) and one.cut == two.cut


def test_bounded_sample_is_repeatable(spark):
    docs, labels = corpus(300)
    df, ls = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    one, two = (quality.train(df.repartition(k), ls.repartition(k), per_label=20) for k in (2, 5))
    assert np.array_equal(one.weights, two.weights) and np.isfinite(one.cut)


def test_edge_rows_and_missing_labels(spark, edge_docs, edge_rows, no_docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    odd = spark.createDataFrame([(None, 1), (0, None), (1, 5), (7, 0), (7, 1)], "doc_id bigint, quality int")
    for labels in (none, odd):
        model = quality.train(edge_docs, labels)
        rows = quality.digest(quality.scores(edge_docs, model)).collect()
        assert len(rows) == len(edge_rows) and all(r["predicted"] == 1 for r in rows)
    assert quality.scores(no_docs, model).count() == 0 and quality.keep(no_docs, model).count() == 0


def test_preferences_fit_the_order():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, len(quality.FEATURES)))
    good = x[:, 3] - 2 * x[:, 5] + 0.1 * rng.normal(size=400) > -1
    model = quality.fit(x, good, float((~good).mean()))
    assert ((model.score(x) >= quality.THRESHOLD) == good).mean() > 0.95 and model.weights[3] > 0 > model.weights[5]


def test_features_see_the_whole_text():
    assert len(quality.features("")) == len(quality.FEATURES) == len(quality.features("a b c"))
    text = "plain words " * 5000
    assert not np.allclose(quality.features(text), quality.features(text + "*** " * 3000))


def test_the_fit_equals_plain_gradient_descent():
    rng = np.random.default_rng(3)
    good = rng.random(60) < 0.6
    x = rng.standard_normal((60, len(quality.FEATURES))) * 0.5 + np.outer(good, rng.standard_normal(len(quality.FEATURES)) * 0.3)
    model = quality.fit(x, good, 0.4)
    z = ((x - x.mean(axis=0)) / x.std(axis=0)).clip(-8, 8)
    d, w = quality._preferences(z[good], z[~good]), np.zeros(x.shape[1])
    for _ in range(20_000):
        w -= 0.5 * (-(d / (1 + np.exp(d @ w))[:, None]).mean(axis=0) + quality.RIDGE * w)
    assert np.abs(w - model.weights).max() < 1e-4
    assert abs(np.mean(model.score(x) < quality.THRESHOLD) - 0.4) < 0.1


def test_an_id_counts_once_however_often_it_is_repeated(spark):
    docs, labels = corpus(200)
    ls = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    once = quality.train(spark.createDataFrame(docs, SCHEMA), ls)
    often = quality.train(spark.createDataFrame(docs + docs[:50] * 40, SCHEMA), ls)
    assert (once.weights == often.weights).all() and once.cut == often.cut


def test_all_labelled_rows_are_fitted(spark, monkeypatch):
    monkeypatch.setattr(quality, "SLICE", 16)  # many slices; the rarer label starts again within some
    docs, labels = corpus(900)
    docs = docs + [(i, None, "x", 0.5, "label") for i in range(900, 920)]
    labels = labels + [(i, 1, 0) for i in range(900, 920)] + [(5000 + i, 0, 0) for i in range(30)]  # labels without documents
    known = {i: q for i, q, _ in labels if zlib.crc32(str(i).encode()) % 5}
    df, ls = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    hashes = {r["id"]: r["h"] for r in df.selectExpr("doc_id as id", "xxhash64(doc_id) as h").collect()}
    ids = sorted((d[0] for d in docs if d[0] in known), key=lambda i: hashes[i] % 2**64 >> 54 << 64 | hashes[i] + 2**63)
    text = {d[0]: d[1] for d in docs}
    x, good = np.array([quality.features(text[i]) for i in ids]), np.array([known[i] == 1 for i in ids])
    share = sum(q == 0 for q in known.values()) / len(known)
    model, want = quality.train(df, ls), quality.fit(x, good, share)
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.weights, want.weights, atol=1e-6) and abs(model.cut - want.cut) < 1e-5
    for flip in (False, True):  # the rarer label may be either
        one = quality.train(df, ls.selectExpr("doc_id", "1 - quality as quality") if flip else ls)
        two = quality.fit(x, good ^ flip, 1 - share if flip else share)
        assert np.allclose(one.weights, two.weights, atol=1e-6) and abs(one.cut - two.cut) < 1e-5


def test_more_labels_than_a_bounded_sample_would_hold(spark):
    """20,600 ids of label 1, of which only some past the first 10,000 by hash hold bars: a fit to the first ones can't see them."""
    ids = spark.range(26_000).where(~quality.held_out(quality.F.col("id"))).selectExpr("id", "row_number() over (order by xxhash64(id)) as place")
    docs = ids.selectExpr("id as doc_id", "if(id % 50 = 0, 'aa *** bb ***', if(place > 15000, 'aa | bb | cc', 'aa bb cc')) as text")
    labels = ids.selectExpr("id as doc_id", "if(id % 50 = 0, 0, 1) as quality")
    whole = quality.train(docs, labels)
    bars = docs.where("text like '%|%'").count() / docs.count() * quality.features("aa | bb | cc")[quality.FEATURES.index("bars")]
    assert bars > 0 and abs(whole.mean[quality.FEATURES.index("bars")] - bars) < 1e-12


def test_the_cut_is_the_exact_quantile():
    rng = np.random.default_rng(5)
    for n in (2, 3, 10, 3000):
        for spread in (1, 5, 1000):  # few or many equal strengths
            s, good = rng.integers(0, spread, n) / 7, rng.random(n) < 0.8
            good[:2] = False, True
            order = np.lexsort((good, s))
            for share in (quality.Fraction(1, 10), quality.Fraction(int((~good).sum()), n), quality.Fraction(9, 10)):
                weight = [(1 - share) / int(good.sum()) if good[i] else share / int((~good).sum()) for i in order]
                total = at = 0
                while (total := total + weight[at]) < share:
                    at += 1
                at = min(at, n - 2)
                got = quality._quantile(lambda edges: quality._slots(s, good, edges), int((~good).sum()), int(good.sum()), share)
                assert got == (s[order[at]] + s[order[at + 1]]) / 2
