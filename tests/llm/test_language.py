"""The byte network: gradients, plain recurrence, held-out accuracy."""

import random
import time
import zlib

import numpy as np
import pytest

from patronage.llm import language
from patronage.llm.language import Network


def plain_probabilities(net, raw):
    """Mean probabilities of one text, byte by byte, segment by segment."""
    def states(table, u, codes):
        h, out = np.zeros(u.shape[0]), []
        s = len(h)
        for c in codes:
            x, v = table[c], h @ u
            z, r = 1 / (1 + np.exp(-(x[:s] + v[:s]))), 1 / (1 + np.exp(-(x[s:2 * s] + v[s:2 * s])))
            n = np.tanh(x[2 * s:] + r * v[2 * s:])
            h = n + z * (h - n)
            out.append(h)
        return out

    total = np.zeros(len(net.languages))
    for at in range(0, len(raw), language.SEGMENT):
        codes = raw[at:at + language.SEGMENT]
        left, right = states(*net.weights[:2], codes), states(*net.weights[2:4], codes[::-1])[::-1]
        for a, b in zip(left, right, strict=True):
            x = np.exp(np.concatenate([a, b]) @ net.weights[4] + net.weights[5])
            total += x / x.sum()
    return total / len(raw)


def test_gradients_equal_differences():
    rng = np.random.default_rng(5)
    net = Network.fresh(["a", "b", "c"], hidden=4, seed=3, dtype=np.float64)
    codes, truth = rng.integers(0, 256, (6, 5)), rng.integers(0, 3, 5)
    _, grads = net.loss(codes, truth)
    for w, g in zip(net.weights, grads, strict=True):
        assert w.shape == g.shape
        rows = codes[:, :1].ravel() if w.shape[0] == 256 else np.arange(w.shape[0])
        for i in rows[:6]:
            at = (i, *(rng.integers(0, n) for n in w.shape[1:]))
            old, step = w[at], 1e-6
            w[at] = old + step
            up = net.loss(codes, truth)[0]
            w[at] = old - step
            down = net.loss(codes, truth)[0]
            w[at] = old
            assert g[at] == pytest.approx((up - down) / (2 * step), rel=1e-4, abs=1e-8)


def test_documents_equal_the_plain_recurrence(monkeypatch):
    monkeypatch.setattr(language, "SEGMENT", 7)
    monkeypatch.setattr(language, "SEGMENTS", 4)
    net = Network.fresh(["x", "y", "z"], hidden=5, seed=1, dtype=np.float64)
    rng = random.Random(0)
    raws = [bytes(rng.randrange(256) for _ in range(n)) for n in (1, 6, 7, 8, 50, 0, 14, 3)]
    got = net.document_probabilities(raws)
    for raw, p in zip(raws, got, strict=True):
        assert p == pytest.approx(plain_probabilities(net, raw) if raw else np.zeros(3), abs=1e-12)


def test_reading_costs_less_than_the_steps_of_a_fit():
    net = Network.fresh(["x", "y", "z"], seed=2)
    rng = np.random.default_rng(6)
    lengths = np.sort(rng.integers(1, 65, 2048))[::-1]
    codes = rng.integers(0, 256, (64, 2048)).astype(np.uint8)
    counts = [int((lengths > t).sum()) for t in range(64)]
    left, right = language.Cell(*net.weights[:2]), language.Cell(*net.weights[2:4])

    def by_steps():
        forward = [h for _, h, _ in left.run(codes, counts)]
        sums, h = np.zeros((2048, 3)), np.zeros((2048, language.HIDDEN), np.float32)
        for t in range(63, -1, -1):
            n = counts[t]
            h[:n], _ = right.step(right.table[codes[t, :n]], h[:n])
            sums[:n] += language._softmax(np.concatenate([forward[t], h[:n]], axis=1) @ net.weights[4] + net.weights[5])
        return sums

    def cpu(run):
        began = time.thread_time()
        run()
        return time.thread_time() - began

    assert net.segment_sums(codes, lengths) == pytest.approx(by_steps(), rel=1e-5)
    steps, reading = (min(cpu(f) for _ in range(9)) for f in (by_steps, lambda: net.segment_sums(codes, lengths)))
    assert reading < 0.8 * steps


SYLLABLES = {"aa": ["ba", "lo", "mi", "té"], "bb": ["krz", "ost", "ew", "ó"], "cc": ["ng", "hua", "xi", "qi"]}
SCHEMA = "doc_id bigint, text string, lang string, lang_pred string, score double"


def corpus(n=300):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        lang = list(SYLLABLES)[i % 3] if i % 10 else None
        some = SYLLABLES[lang or "aa"]
        text = " ".join("".join(rng.choice(some) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(3, 90)))
        rows.append((i, text, lang, "x", 2.0))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    net = language.train(df, steps=120, hidden=8)
    assert net.languages == sorted(SYLLABLES)
    got = {r["doc_id"]: r for r in language.digest(language.predict(df, net)).collect()}
    assert len(got) == len(rows) and all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    out = [(got[i]["lang_pred"], lang) for i, _, lang, *_ in rows if got[i]["held_out"] and lang]
    assert np.mean([a == b for a, b in out]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_held_out_rows_and_other_columns_do_not_matter(spark):
    rows = corpus(120)
    def moved(r):
        out = zlib.crc32(str(r[0]).encode()) % 5 == 0
        return (r[0], "junk 123 words", "zz", "y", 0.0) if out else r
    a = language.train(spark.createDataFrame(rows, SCHEMA), steps=5, hidden=4)
    b = language.train(spark.createDataFrame([moved(r) for r in rows], SCHEMA).repartition(5), steps=5, hidden=4)
    assert a.languages == b.languages and all((x == y).all() for x, y in zip(a.weights, b.weights, strict=True))


def test_at_most_per_language_rows(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(language, "fit", lambda pieces, truth, languages, **o: seen.append((pieces, truth)))
    language.train(spark.createDataFrame(corpus(200), SCHEMA), per_language=10, windows=2, window=20)
    pieces, truth = seen[0]
    assert np.bincount(truth).tolist() == [20, 20, 20] and max(len(p.decode()) for p in pieces) <= 20


def test_edges(edge_docs, edge_rows, no_docs, spark):
    net = language.train(spark.createDataFrame(corpus(60), SCHEMA), steps=3, hidden=4)
    rows = language.predict(edge_docs, net).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == sorted((r[0] is None, r[0] or 0) for r in edge_rows)
    for r in rows:
        if r["doc_id"] in (1, 2, 3):
            assert (r["lang_pred"], r["score"], r["probabilities"]) == ("und", 0.0, None)
        else:
            assert r["lang_pred"] in net.languages and sum(r["probabilities"]) == pytest.approx(1, abs=1e-5)
    assert language.predict(no_docs, net).count() == 0
    unlabelled = edge_docs.selectExpr("doc_id", "text", "cast(null as string) lang")
    assert language.train(unlabelled) is None
    assert {r["lang_pred"] for r in language.predict(edge_docs, None).collect()} == {"und"}
