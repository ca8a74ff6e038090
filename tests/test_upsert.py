import os
import threading

import pytest

from patronage.operators.keyed_table import KeyedTable
from patronage.operators.manifest import Conflict, Manifests
from patronage.operators.upsert import last_per_key, upsert


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_replaces_inserts_and_keeps(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k long, v string, w int")
    new = spark.createDataFrame([(2, "B", 21), (3, "C", 31)], "k long, v string, w int")
    assert _rows(upsert(old, new, ["k"])) == [(1, "a", 10), (2, "B", 21), (3, "C", 31)]


def test_unlisted_columns_keep_old_values(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k long, v string, w int")
    new = spark.createDataFrame([(2, "B", 99)], "k long, v string, w int")
    assert _rows(upsert(old, new, ["k"], update_cols=["v"])) == [(1, "a", 10), (2, "B", 20)]


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([(i, f"v{i}") for i in range(50)], "k long, v string")
    new = spark.createDataFrame([(i, f"n{i}") for i in range(25, 75)], "k long, v string")
    once = upsert(old, new, ["k"])
    twice = upsert(once, new, ["k"])
    assert _rows(once) == _rows(twice)


def _table(spark, scratch, rows, schema="k long, v string, at int", **options):
    table = KeyedTable(spark, f"{scratch}/t")
    table.merge(spark.createDataFrame(rows, schema), ["k"], **options)
    return table


def test_a_merge_never_overwrites_what_is_read(spark, scratch):
    table = _table(spark, scratch, [(1, "a", 0), (2, "b", 0)])
    first = table.read()
    table.merge(spark.createDataFrame([(2, "B", 1), (3, "C", 1)], "k long, v string, at int"), ["k"])
    assert table.version == 2
    assert _rows(first) == _rows(table.read(1)) == [(1, "a", 0), (2, "b", 0)]
    assert _rows(table.read()) == [(1, "a", 0), (2, "B", 1), (3, "C", 1)]


def test_only_touched_buckets_are_rewritten(spark, scratch):
    table = _table(spark, scratch, [(i, f"v{i}", 0) for i in range(1000)], buckets=16)
    before = table.folders()
    assert len(before) == 16
    table.merge(spark.createDataFrame([(5, "x", 1), (6, "y", 1)], "k long, v string, at int"), ["k"])
    after = table.folders()
    changed = {b for b in after if after[b] != before[b]}
    files = [f for b in changed for f in os.listdir(after[b]) if f.endswith(".parquet")]
    assert 1 <= len(changed) <= 2 and len(files) == len(changed)
    got = {r["k"]: r["v"] for r in table.read().collect()}
    assert got == {**{i: f"v{i}" for i in range(1000)}, 5: "x", 6: "y"}


def test_equals_the_upsert_of_whole_tables(spark, scratch):
    table, schema = _table(spark, scratch, [(i, f"v{i}", 0) for i in range(200)], buckets=8), "k long, v string, at int"
    want = table.read()
    for n in range(3):
        batch = spark.createDataFrame([(i, f"n{n}", n) for i in range(60 * n, 60 * n + 150)], schema)
        want = upsert(want, batch.select("k", "v"), ["k"], ["v"])
        table.merge(batch.select("k", "v"), ["k"])
    assert _rows(table.read()) == _rows(want)


def test_null_keys_are_refused(spark, scratch):
    rows = spark.createDataFrame([(None, "a", 0), (1, "b", 0)], "k long, v string, at int")
    with pytest.raises(ValueError, match="NULL"):
        KeyedTable(spark, f"{scratch}/t").merge(rows, ["k"])
    table = _table(spark, scratch, [(1, "a", 0)])
    with pytest.raises(ValueError, match="NULL"):
        table.merge(rows, ["k"], order=["at"])
    assert table.version == 1 and _rows(table.read()) == [(1, "a", 0)]


def test_duplicate_keys_are_refused_or_the_last_is_kept(spark, scratch):
    updates = spark.createDataFrame([(1, "b", 1), (1, "c", 2), (2, "d", 5), (2, "e", 4)], "k long, v string, at int")
    with pytest.raises(ValueError):
        KeyedTable(spark, f"{scratch}/t").merge(updates, ["k"])
    table = _table(spark, scratch, [(1, "a", 0)])
    with pytest.raises(ValueError):
        table.merge(updates, ["k"])
    table.merge(updates, ["k"], order=["at"])
    assert _rows(table.read()) == [(1, "c", 2), (2, "d", 5)]
    assert _rows(last_per_key(updates, ["k"], ["at"])) == [(1, "c", 2), (2, "d", 5)]


def test_late_rows_do_not_win(spark, scratch):
    schema = "k long, v string, at int"
    table = _table(spark, scratch, [(1, "ten", 10), (2, "none", None)], order=["at"])
    table.merge(spark.createDataFrame([(1, "five", 5), (2, "one", 1), (3, "new", None)], schema), ["k"], order=["at"])
    assert _rows(table.read()) == [(1, "ten", 10), (2, "one", 1), (3, "new", None)]
    table.merge(spark.createDataFrame([(1, "again", 10), (2, "null", None)], schema), ["k"], order=["at"])
    assert _rows(table.read()) == [(1, "again", 10), (2, "one", 1), (3, "new", None)]


def test_batches_in_any_order_and_twice_give_one_result(spark, scratch):
    schema, batches = "k long, v string, at int", [[(1, "a", 1), (2, "a", 1)], [(1, "b", 2)], [(2, "c", 3), (3, "c", 3)]]
    results = []
    for n, order in enumerate([(0, 1, 2), (2, 0, 1), (1, 1, 2, 0, 0)]):
        table = KeyedTable(spark, f"{scratch}/{n}")
        for b in order:
            table.merge(spark.createDataFrame(batches[b], schema), ["k"], order=["at"])
        results.append(_rows(table.read()))
    assert results[0] == results[1] == results[2] == [(1, "b", 2), (2, "c", 3), (3, "c", 3)]


def test_racing_writers(spark, scratch, monkeypatch):
    """Both merges start from one version; the late one takes the other's as its base."""
    schema = "k long, v string, at int"
    table = _table(spark, scratch, [(i, "old", 0) for i in range(100)], buckets=32)
    real, raced, merges = Manifests.commit, [], []

    def commit(self, number, content):
        if not raced:
            raced.append(number)
            other = KeyedTable(spark, table.root)
            other.merge(spark.createDataFrame([(1, "other", 0), (500, "other", 0)], schema), ["k"])
        return real(self, number, content)

    work = KeyedTable._merge_buckets
    monkeypatch.setattr(Manifests, "commit", commit)
    monkeypatch.setattr(KeyedTable, "_merge_buckets", lambda self, *a: merges.append(1) or work(self, *a))
    for key, repeats in ((1, 3), (2, 2)):  # the same bucket: merged again; another one: its files stand
        raced.clear()
        merges.clear()
        table.merge(spark.createDataFrame([(key, "mine", 0)], schema), ["k"])
        got = {r["k"]: r["v"] for r in table.read().collect()}
        assert got[key] == "mine" and got[500] == "other" and len(got) == 101 and len(merges) == repeats
    assert table.version == 5
    monkeypatch.undo()
    with pytest.raises(Conflict):
        table.manifests.commit(5, {})


def test_writers_in_threads_lose_nothing(spark, scratch):
    schema, table = "k long, v string, at int", None
    table = _table(spark, scratch, [(i, "old", 0) for i in range(50)], buckets=4)
    frames = [spark.createDataFrame([(n, f"w{n}", 0), (100 + n, "new", 0)], schema) for n in range(3)]
    threads = [threading.Thread(target=lambda f=f: KeyedTable(spark, table.root).merge(f, ["k"])) for f in frames]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    got = {r["k"]: r["v"] for r in table.read().collect()}
    assert table.version == 4 and len(got) == 53 and [got[n] for n in range(3)] == ["w0", "w1", "w2"]


def test_unfinished_runs_do_not_count_and_are_cleared(spark, scratch):
    schema = "k long, v string, at int"
    table = _table(spark, scratch, [(1, "a", 0)])
    table._write(spark.createDataFrame([(1, "lost", 9)], schema), ["k"], 64)  # as a crash before the commit leaves it
    open(f"{table.root}/_versions/.half.tmp", "w").close()
    assert table.version == 1 and _rows(table.read()) == [(1, "a", 0)]
    for n in range(3):
        table.merge(spark.createDataFrame([(1, f"v{n}", 0), (2, f"v{n}", 0)], schema), ["k"])
    assert len(table.vacuum(keep=1)) >= 4
    assert table.manifests.numbers() == [4] and _rows(table.read()) == [(1, "v2", 0), (2, "v2", 0)]


def test_replace_is_a_new_version_of_the_same_table(spark, scratch):
    table = _table(spark, scratch, [(1, "a", 0), (2, "b", 0)])
    table.replace(spark.createDataFrame([(7, 1.5)], "k long, score double"), ["k"])
    assert table.version == 2 and _rows(table.read()) == [(7, 1.5)] and _rows(table.read(1)) == [(1, "a", 0), (2, "b", 0)]
    table.replace(spark.createDataFrame([], "k long, score double"), ["k"])
    assert _rows(table.read()) == []
    table.merge(spark.createDataFrame([(8, 2.5)], "k int, score double"), ["k"])  # the key's type follows the table
    assert _rows(table.read()) == [(8, 2.5)]
    with pytest.raises(ValueError):
        table.merge(spark.createDataFrame([(8, 2)], "k long, other int"), ["k"])


def test_versions_are_numbers(spark, scratch):
    manifests = Manifests(spark, f"{scratch}/m")
    for n in (999_999, 1_000_000):
        manifests.commit(n, {"n": n})
    assert manifests.latest() == (1_000_000, {"n": 1_000_000})
