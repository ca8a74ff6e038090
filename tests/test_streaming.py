"""The key upsert runs per micro-batch through foreachBatch (file source,
availableNow trigger: no server, no port)."""

from patronage.operators.keyed_table import KeyedTable
from patronage.streaming import upsert_each_batch


def test_upsert_each_batch(spark, scratch):
    src, root, ckpt = f"{scratch}/in", f"{scratch}/scores", f"{scratch}/ckpt"

    def arrive(name, rows):
        spark.createDataFrame(rows, "customer_id long, score double").coalesce(1).write.parquet(f"{src}/{name}")
        stream = (spark.readStream.schema("customer_id long, score double")
                  .option("recursiveFileLookup", "true").parquet(src))
        q = (stream.writeStream.foreachBatch(upsert_each_batch(root, ["customer_id"], order=["score"]))
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination(120)

    arrive("b1", [(1, 1.0), (2, 4.5)])
    arrive("b2", [(2, 4.0), (2, 5.0), (3, 3.0)])  # two rows of a key in one micro-batch: the last by score
    final = KeyedTable(spark, root).read()
    assert sorted(tuple(r) for r in final.collect()) == [(1, 1.0), (2, 5.0), (3, 3.0)]


def test_a_micro_batch_that_runs_again_changes_nothing(spark, scratch):
    write = upsert_each_batch(f"{scratch}/t", ["k"], order=["at"])
    rows = lambda *r: spark.createDataFrame(list(r), "k long, at int, v string")
    write(rows((1, 10, "a")), 0)
    write(rows((1, 20, "b"), (2, 5, "c")), 1)
    before = KeyedTable(spark, f"{scratch}/t").version
    write(rows((1, 20, "b"), (2, 5, "c")), 1)
    table = KeyedTable(spark, f"{scratch}/t")
    assert table.version == before == 2
    write(rows((1, 15, "late"), (2, 6, "d")), 2)
    assert sorted(map(tuple, table.read().collect())) == [(1, 20, "b"), (2, 6, "d")]
