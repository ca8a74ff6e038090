"""Phrase collocations against a plain version."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from patronage.llm import collocations


def plain(rows, least=10, longest=3, covered=50):
    counts, sizes = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = [p for p, n in f.items() if len(p) > 1 and n >= least]
        held = defaultdict(int)
        for p in candidates:
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    held[p[i:i + k]] = max(held[p[i:i + k]], f[p])
        kept = []
        for p in candidates:
            if 100 * held[p] >= covered * f[p]:
                continue
            cuts = [(1_000_000 * f[p] ** 2 // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            kept.append((-score, -f[p], " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept), 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


def texts(seed, n=200):
    rng = random.Random(seed)
    words = ["Ab", "c", "dé", "É", "ÄÖ", "x-y", "\x1cq", "a\xa0b", "Z", "中文", "ab"]
    rows = []
    for i in range(n):
        parts = [rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "!?", "\x0b", "\r\n"]) for _ in range(rng.randint(0, 40))]
        rows.append(("".join(parts), rng.choice(["en", "fr", None])))
    return [*rows, (None, "en"), ("", None), ("z z z z z z z z z z z z z", "fr"), ("c " * 5000, "en")]


def mined(df, **options):
    return sorted(map(tuple, collocations.mine(df, **options).collect()))


SCHEMA = "text string, lang string"


@pytest.mark.parametrize(("longest", "block"), [(3, collocations.BLOCK_WORDS), (3, 50), (2, 300), (5, 300)])
def test_equals_the_plain_version(spark, longest, block):
    rows = texts(longest)
    got = mined(spark.createDataFrame(rows, SCHEMA).repartition(3), longest=longest, block_words=block)
    assert got == plain(rows, longest=longest) and len(got) > 30


def test_other_limits(spark):
    rows = texts(8)
    df = spark.createDataFrame(rows, SCHEMA)
    assert mined(df, least=2, covered=90) == plain(rows, least=2, covered=90)
    top = mined(df, top=3)
    assert top == [r for r in plain(rows) if r[1] <= 3]
    with pytest.raises(ValueError):
        collocations.mine(df, longest=1)


def test_exact_beyond_64_bits(spark):
    a, l, r = 10 ** 11 + 7, 3 * 10 ** 11 + 1, 10 ** 12 + 9
    df = spark.createDataFrame([(a, l, r)], "a bigint, l bigint, r bigint")
    from pyspark.sql import functions as F
    assert df.select(collocations.ratio(F.col("a"), F.col("l"), F.col("r"))).first()[0] == 10 ** 6 * a * a // (l * r)


def test_merge_join_needs_adjacent_places():
    place, left, right = collocations.merge_join(np.array([0, 1, 3, 4, 5, 9]), np.array([7, 8, 9, 7, 7, 8]))
    assert place.tolist() == [0, 3, 4] and left.tolist() == [7, 9, 7] and right.tolist() == [8, 7, 7]
    assert collocations.merge_join(np.zeros(0, int), np.zeros(0, int))[0].size == 0


def test_edges(spark, edge_docs, edge_rows, no_docs):
    clash = edge_docs.selectExpr("doc_id", "text", "'en' lang", "1 block", "2 code", "3 n", "4 id", "5 f").unionByName(
        edge_docs.selectExpr("doc_id", "text", "cast(null as string) lang", "1 block", "2 code", "3 n", "4 id", "5 f"))
    assert mined(clash, least=2) == plain([(r[1], x) for r in edge_rows for x in ("en", None)], least=2)
    assert mined(no_docs.selectExpr("text", "'en' lang")) == []
    assert mined(spark.createDataFrame([(None, None), ("", "en"), (" .,", "en")], SCHEMA)) == []
