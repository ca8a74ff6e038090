import hashlib
import random

import numpy as np
import pytest

from patronage.llm import suffix_dedup
from patronage.llm.deep_shallow import common_prefix, deep_shallow
from tests.llm.brute import repeated

SCHEMA = "doc_id bigint, text string, lang string, spans string"


def texts(seed, n=60, alphabet="abcdefgh \né"):
    """Texts with copies, edited copies, shared passages and runs of one letter."""
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    passages = [word(rng.randint(10, 70)) for _ in range(6)]
    out = [None, "", "a", "a" * 90, "ab" * 60]
    while len(out) < n:
        kind = rng.random()
        if kind < 0.3 and len(out) > 8:
            t = list(rng.choice(out[5:]))
            for _ in range(rng.randint(0, 2)):
                if t:
                    t[rng.randrange(len(t))] = rng.choice(alphabet)
            out.append("".join(t))
        elif kind < 0.7:
            out.append(word(rng.randint(0, 60)) + rng.choice(passages) + word(rng.randint(0, 60)) + rng.choice(passages))
        else:
            out.append(word(rng.randint(0, 150)))
    return out


def measured(spark, rows, length, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = suffix_dedup.measure(df, length, **options).collect()
    texts = {}
    for i, t, *_ in rows:
        texts.setdefault(i, []).append((t or "").encode())
    for r in got:  # the text and the runs say the same as the figures
        runs = [(x["start"], x["stop"]) for x in r["removed"]]
        assert len(runs) == r["n_spans"] and sum(b - a for a, b in runs) == r["n_removed"]
        raw = next(t for t in texts[r["doc_id"]] if len(t) == r["n_bytes"] and hashlib.sha256(suffix_dedup.cut(t, runs)).hexdigest() == r["kept_sha256"])
        assert r["text"].encode() == suffix_dedup.cut(raw, suffix_dedup.whole_characters(raw, runs))
    return sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got if r["doc_id"] is not None)


@pytest.mark.parametrize("length,chunk", [(20, 16384), (20, 3), (9, 16384), (20, 2)])
def test_equals_brute_force(spark, length, chunk, monkeypatch):
    if chunk == 2:  # tasks that forget what they have seen
        monkeypatch.setattr(suffix_dedup, "SEEN", 1)
    ts = texts(length * 31 + chunk)
    rows = [(i, t, "x", "clash") for i, t in enumerate(ts)]
    want = [(i, *r) for i, r in enumerate(repeated(ts, length))]
    assert measured(spark, rows, length, chunk=chunk) == want


def test_texts_longer_than_a_piece(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 64)
    ts = texts(5, 40)
    keyed = [(b"%d" % i, t) for i, t in enumerate(ts)]
    import pyarrow as pa
    raws = [t or "" for _, t in keyed]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(raws))), pa.array(range(len(raws))), pa.array(raws)], names=["doc", "hash", "text"])
    windows = [(p[0], p[2] + i) for piece in suffix_dedup._pieces(iter([batch]), 20) for p in piece for i in range(len(p[3]) - 19)]
    want = [(d, i) for d, t in enumerate(raws) for i in range(len(t.encode()) - 19)]
    assert sorted(windows) == want


def test_repeated_and_null_rows(spark):
    t = "".join(chr(97 + i * 7 % 26) for i in range(40)) + "tail"
    rows = [(1, t, None, None), (1, t, None, None), (None, "x" + t, None, None), (2, "short", None, None)]
    got = suffix_dedup.measure(spark.createDataFrame(rows, SCHEMA), 20).collect()
    by = {(r["doc_id"], r["n_bytes"]): r for r in got}
    assert len(got) == 4 and by[1, 44]["n_removed"] == 44 and by[None, 45]["n_removed"] == 44 and by[2, 5]["n_removed"] == 0


def test_empty_table(spark):
    assert suffix_dedup.measure(spark.createDataFrame([], SCHEMA), 20).count() == 0


def test_remove_keeps_columns_and_characters(spark):
    shared = "die schöne Stelle, die überall steht"
    rows = [(1, "é" + shared + "A", "de", "s1"), (2, "è" + shared + "B", "fr", "s2"), (3, None, None, None)]
    out = {r["doc_id"]: r for r in suffix_dedup.remove(spark.createDataFrame(rows, SCHEMA), 20).collect()}
    # the second byte of é and è is different, the first is equal but isn't cut alone
    assert out[1]["text"] == "éA" and out[2]["text"] == "èB" and out[3]["text"] is None
    assert out[1]["lang"] == "de" and out[2]["spans"] == "s2"


def test_whole_characters():
    raw = "aéb".encode()
    assert suffix_dedup.whole_characters(raw, [(0, 2)]) == [(0, 1)]
    assert suffix_dedup.whole_characters(raw, [(2, 4)]) == [(3, 4)]
    assert suffix_dedup.whole_characters(raw, [(1, 2)]) == []


@pytest.mark.parametrize("seed", range(6))
def test_deep_shallow_order(seed):
    rng = random.Random(seed)
    base = [bytes(rng.choice(b"ab\0") for _ in range(rng.randint(0, 30))) for _ in range(20)]
    strings = [rng.choice(base)[:rng.randint(0, 30)] + bytes(rng.choice(b"abc\0") for _ in range(rng.randint(0, 4))) for _ in range(120)]
    groups = np.array([rng.randint(0, 3) for _ in strings])
    order, lcp = deep_shallow(strings, groups, shallow=8)
    got = [(int(groups[i]), strings[i]) for i in order]
    assert got == sorted(got) and sorted(order.tolist()) == list(range(len(strings)))
    for k in range(1, len(order)):
        a, b = got[k - 1], got[k]
        assert lcp[k] == (common_prefix(a[1], b[1]) if a[0] == b[0] else 0)


def test_common_prefix():
    assert common_prefix(b"", b"a") == 0 and common_prefix(b"\0\0a", b"\0\0b") == 2 and common_prefix(b"ab", b"abc") == 2
