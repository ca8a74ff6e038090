import random

from patronage.llm import quality, simhash_dedup, suffix_dedup
from tests.llm.brute import repeated
from tests.llm.test_fingerprints import plain_components, plain_simhash

import corpus_pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus(spark, folder):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = say(70)
    docs, labels = [], []
    for i in range(120):
        text, bad = say(rng.randint(60, 150)), i % 6 == 0
        if bad:
            text = " ".join(w + "***" for w in text.split())
        elif i % 7 == 0:
            text = say(40) + " " + passage + " " + say(40)
        elif i % 11 == 0:
            text = docs[i - 1][1]
        docs.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, int(not bad), 0))
    docs += [(200, None, None, None, None), (201, "", "en", "s", 0)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_stages_against_plain_versions(spark, scratch):
    corpus(spark, scratch)
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    rows = lambda df: {r["doc_id"]: r for r in df.collect()}
    (_, keep), (_, near), (_, cut), (_, pack) = corpus_pipeline.STAGES

    good = keep(spark, docs, scratch)
    model = quality.train(docs, spark.read.parquet(f"{scratch}/labels.parquet"))
    want = {i for i, r in rows(docs).items() if model.score(quality.features(r["text"])[None])[0] >= 0.3}
    assert good.columns == COLUMNS and set(rows(good)) == want and want < set(rows(docs))

    single = near(spark, good, scratch)
    kept = sorted(rows(good))
    parts = plain_components([plain_simhash(rows(good)[i]["text"]) for i in kept])
    first = {}
    for i, p in zip(kept, parts, strict=True):
        first.setdefault(p, i)
    assert single.columns == COLUMNS and set(rows(single)) == set(first.values()) and len(first) < len(kept)

    clean = cut(spark, single, scratch)
    before, after = rows(single), rows(clean)
    order = sorted(before)
    sizes = repeated([before[i]["text"] for i in order], corpus_pipeline.PASSAGE_BYTES)
    assert clean.columns == COLUMNS and set(after) == set(before)
    for i, (n, gone, _, _) in zip(order, sizes, strict=True):
        assert len((after[i]["text"] or "").encode()) == n - gone and after[i]["n_chars"] == len(after[i]["text"] or "")
    assert any(s[1] for s in sizes)

    pieces = pack(spark, clean, scratch).collect()
    assert {p["doc_id"] for p in pieces} == set(after)


def test_run_gives_the_last_stage(spark, scratch):
    corpus(spark, scratch)
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, scratch)
    piece = lambda r: (r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"])
    assert sorted(map(piece, corpus_pipeline.run(spark, scratch).collect())) == sorted(map(piece, docs.collect()))


def test_empty_corpus(spark, scratch):
    corpus(spark, scratch)
    docs = spark.read.parquet(f"{scratch}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, scratch)
    assert docs.count() == 0
    assert simhash_dedup.SHINGLE_WORDS == 3 and suffix_dedup.MIN_LENGTH == 400
