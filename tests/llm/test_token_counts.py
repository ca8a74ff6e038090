import re
from collections import Counter

from pyspark.sql import functions as F

from patronage.llm import token_counts as tc
from patronage.llm.common import scratch_path

def one():
    return F.col("source"), F.col("lang"), F.lit("v1"), F.col("n")


def totals(spark, rollup):
    return {(r["source"], r["lang"], r["tokenizer"]): (r["documents"], r["tokens"]) for r in tc.totals(spark, rollup).collect()}


def test_batches_add_up_and_count_once(spark):
    rollup = scratch_path(spark, "rollup")
    assert totals(spark, rollup) == {}
    rows = spark.createDataFrame([("s", "en", 5), ("s", "en", 7), (None, "de", 1), ("s", None, None)], "source string, lang string, n int")
    assert tc.commit(rows, tc.insert(*one()), rollup, "a") and not tc.commit(rows, tc.insert(*one()), rollup, "a")
    want = {("s", "en", "v1"): (2, 12), (None, "de", "v1"): (1, 1), ("s", None, "v1"): (1, 0)}
    assert totals(spark, rollup) == want
    assert tc.commit(rows.where("n = 7"), tc.revise(one(), (F.lit("t"), F.col("lang"), F.lit("v2"), F.lit(3))), rollup, "b")
    assert tc.commit(rows.where("n = 1"), tc.delete(*one()), rollup, "c")
    assert totals(spark, rollup) == {("s", "en", "v1"): (1, 5), ("t", "en", "v2"): (1, 3), ("s", None, "v1"): (1, 0)}


def test_an_unfinished_batch_does_not_count_and_may_be_sent_again(spark):
    rollup = scratch_path(spark, "rollup")
    rows = spark.createDataFrame([("s", "en", 5)], "source string, lang string, n int")
    tc.commit(rows, tc.insert(*one()), rollup, "a")
    jvm = spark._jvm
    mark = jvm.org.apache.hadoop.fs.Path(f"{rollup}/batch-a/_SUCCESS")
    mark.getFileSystem(spark._jsc.hadoopConfiguration()).delete(mark, False)
    assert totals(spark, rollup) == {}
    assert tc.commit(rows, tc.insert(*one()), rollup, "a") and totals(spark, rollup) == {("s", "en", "v1"): (1, 5)}


def test_a_library_tokenizer_as_the_counter(spark, edge_docs, edge_rows, library):
    """Any counter gives the counts, here a BPE vocabulary."""
    from patronage.llm import bpe
    counts = bpe.digest(bpe.encode_decode(edge_docs))
    rollup = scratch_path(spark, "rollup")
    tc.commit(counts, tc.insert(F.lit("s"), F.lit("en"), F.lit("word_bpe_49k"), F.col("n_tokens")), rollup, "a")
    n = sum(len(library[1].encode(r[1] or "", add_special_tokens=False).ids) for r in edge_rows)
    assert totals(spark, rollup) == {("s", "en", "word_bpe_49k"): (len(edge_rows), n)}


def test_history_of_edge_rows(spark, edge_rows, no_docs):
    rows = [(i, t, ["en", "de", None][k % 3], f"s{k % 2}") for k, (i, t, *_) in enumerate(edge_rows)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(2)
    got = {(r["source"], r["lang"], r["tokenizer"]): (r["documents"], r["tokens"]) for r in tc.corpus_history(docs).collect()}
    seen, want = set(), Counter()
    tokens = Counter()
    for i, t, lang, source in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        t = t or ""
        if t in seen:
            continue
        seen.add(t)
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t))
        key = (source, lang, "words-2" if lang == "en" else "words-1")
        want[key] += 1
        tokens[key] += n + (len(re.findall("[.,;:!?]", t)) if lang == "en" else 0)
    assert got == {k: (want[k], tokens[k]) for k in want}
    assert tc.corpus_history(no_docs.withColumnsRenamed({"fp": "lang", "bucket": "source"})).count() == 0


def test_folded_totals_hold_their_batches_once(spark):
    rollup = scratch_path(spark, "rollup")
    rows = spark.createDataFrame([("s", "en", 5), ("s", "en", 7), (None, "de", 1)], "source string, lang string, n int")
    assert tc.fold(spark, rollup) == []
    tc.commit(rows, tc.insert(*one()), rollup, "a")
    tc.commit(rows.where("n = 1"), tc.delete(*one()), rollup, "b")
    assert tc.fold(spark, rollup) == ["a", "b"] and tc.fold(spark, rollup) == []
    assert not tc.commit(rows, tc.insert(*one()), rollup, "a")
    assert totals(spark, rollup) == {("s", "en", "v1"): (2, 12)}
    tc.commit(rows, tc.insert(*one()), rollup, "c")
    want = {("s", "en", "v1"): (4, 24), (None, "de", "v1"): (1, 1)}
    assert totals(spark, rollup) == want and tc.fold(spark, rollup) == ["c"] and totals(spark, rollup) == want
    # a and b are deleted now, but still known
    assert not any("batch-a" in f or "batch-b" in f for f in tc.totals(spark, rollup).inputFiles())
    assert not tc.commit(rows, tc.insert(*one()), rollup, "b") and totals(spark, rollup) == want


def test_a_late_fold_changes_nothing(spark, monkeypatch):
    rollup = scratch_path(spark, "rollup")
    rows = spark.createDataFrame([("s", "en", 5)], "source string, lang string, n int")
    tc.commit(rows, tc.insert(*one()), rollup, "a")
    plain = tc._sum

    def slow(*args):
        monkeypatch.setattr(tc, "_sum", plain)
        assert tc.fold(spark, rollup) == ["a"]
        return plain(*args)
    monkeypatch.setattr(tc, "_sum", slow)
    assert tc.fold(spark, rollup) == [] and totals(spark, rollup) == {("s", "en", "v1"): (1, 5)}


def test_counts_of_real_tokenizer_versions(spark, edge_docs, edge_rows):
    import public_tokenizers
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = tc.with_tokens(edge_docs.withColumn("n_tokens", F.lit("clash")), "byte_bpe_50k")
    assert got.columns == [c for c in edge_docs.columns] + ["n_tokens"]
    want = sorted(len(library.encode(r[1] or "", add_special_tokens=False).ids) for r in edge_rows)
    assert sorted(r["n_tokens"] for r in got.select("n_tokens").collect()) == want
    words = tc.with_tokens(edge_docs, "words-1").select("n_tokens").collect()
    assert sorted(r[0] for r in words) == sorted(len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in edge_rows)
    rollup = scratch_path(spark, "rollup")
    counted = tc.with_tokens(tc.with_tokens(edge_docs, "words-1", out_col="old"), "byte_bpe_50k", out_col="new")
    tc.commit(counted, tc.insert(F.lit("s"), F.lit("en"), F.lit("words-1"), F.col("old")), rollup, "1")
    tc.commit(counted, tc.revise((F.lit("s"), F.lit("en"), F.lit("words-1"), F.col("old")), (F.lit("s"), F.lit("en"), F.lit("byte_bpe_50k"), F.col("new"))), rollup, "2")
    tc.fold(spark, rollup)
    assert totals(spark, rollup) == {("s", "en", "byte_bpe_50k"): (len(edge_rows), sum(want))}
