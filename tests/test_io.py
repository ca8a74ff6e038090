import csv
import io
import os
from contextlib import contextmanager

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from patronage.sources.csv_records import line_effect
from patronage.sources.io import export_csv, read_master_csv, read_raw_csv, stage_raw


def test_raw_csv_latin1_and_timestamps(spark, scratch):
    path = os.path.join(scratch, "raw.csv")
    with open(path, "w", encoding="ISO-8859-1") as f:
        f.write("InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n")
        f.write("536365,85123A,CAFÉ MUG,6,12/1/2010 8:26,2.55,17850,United Kingdom\n")
        f.write("536366,71053,LANTERN,6,not a date,3.39,,EIRE\n")
        f.write("C536367,84406B,CREAM CUPID,8,12/1/2010 8:34,2.75,13047,France\n")
    df = read_raw_csv(spark, path)
    rows = df.orderBy("InvoiceNo").collect()
    assert rows[0].Description == "CAFÉ MUG"
    assert str(rows[0].InvoiceDate) == "2010-12-01 08:26:00"
    assert rows[1].InvoiceDate is None and rows[1].CustomerID is None
    assert rows[0].InvoiceNo == "536365" and rows[2].InvoiceNo == "C536367"
    staged = stage_raw(df).orderBy("id").collect()
    assert [r.id for r in staged] == [1, 2, 3]
    assert [r.InvoiceNo for r in staged] == ["536365", "536366", "C536367"]


def test_export_and_read_master(spark, scratch):
    from patronage.plans import scores
    from patronage.sources.tables import Tables
    t = Tables.from_tpch(spark, "/root/testdata/sf0.001")
    master = scores.customer_clv_master(t)
    out = os.path.join(scratch, "master")
    export_csv(master, out, single_file=True)
    back = read_master_csv(spark, out)
    assert back.count() == master.count()
    assert back.columns == master.columns


def test_normalize_keys_on_load(spark, scratch):
    path = os.path.join(scratch, "keys.csv")
    with open(path, "w", encoding="ISO-8859-1") as f:
        f.write("InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n")
        f.write("1,85123a ,X,1,12/1/2010 8:26,1.00,1,UK\n")
        f.write("2,85123A,X,1,12/1/2010 8:26,1.00,1,UK\n")
    plain = read_raw_csv(spark, path).select("StockCode").distinct().count()
    folded = read_raw_csv(spark, path, normalize_keys=True).select("StockCode").distinct().count()
    assert (plain, folded) == (2, 1)


def test_bad_numbers_are_kept_apart_from_missing_ones(spark, scratch):
    path = f"{scratch}/bad.csv"
    with open(path, "w", encoding="ISO-8859-1") as f:
        f.write("InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
                "1,s,d,6,12/1/2010 8:26,2.55,c,UK\n2,s,d,six,12/1/2010 8:26,2.55,c,UK\n3,s,d,,12/1/2010 8:26,2.55,c,UK\n")
    rows = {r.InvoiceNo: r for r in read_raw_csv(spark, path).collect()}
    assert rows["1"]._corrupt_record is None and rows["3"]._corrupt_record is None and rows["3"].Quantity is None
    assert rows["2"].Quantity is None and "six" in rows["2"]._corrupt_record


HEADER = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"]
ODD = ['SAY ""HI"", x', 'a "quoted" word', "back\\slash", 'ends in backslash\\', "comma, and 'more'", '"', '\\"', " spaced "]


def test_quoted_text_survives_pandas_both_ways(spark, scratch):
    import pandas as pd
    frame = pd.DataFrame([(str(i), "s", d, i, "12/1/2010 8:26", 2.55, "17850", "United Kingdom") for i, d in enumerate(ODD)], columns=HEADER)
    frame.to_csv(f"{scratch}/in.csv", index=False, encoding="ISO-8859-1")
    df = read_raw_csv(spark, f"{scratch}/in.csv")
    rows = sorted(df.collect(), key=lambda r: r.Quantity)
    assert [r.Description for r in rows] == ODD and all(r._corrupt_record is None and r.CustomerID == "17850" for r in rows)
    export_csv(df.select("Quantity", "Description", "Country"), f"{scratch}/out", single_file=True)
    part = next(f"{scratch}/out/{f}" for f in os.listdir(f"{scratch}/out") if f.endswith(".csv"))
    back = pd.read_csv(part).sort_values("Quantity")
    assert back["Description"].tolist() == ODD and set(back["Country"]) == {"United Kingdom"}


def test_line_ends_in_quotes(spark, scratch):
    import pandas as pd
    texts = ["two\nlines", 'a "b"\r\n,c', "plain"]
    pd.DataFrame([(str(i), "s", d, i, "12/1/2010 8:26", 2.55, "c", "UK") for i, d in enumerate(texts)], columns=HEADER).to_csv(f"{scratch}/in.csv", index=False)
    rows = read_raw_csv(spark, f"{scratch}/in.csv", multi_line=True).orderBy("Quantity").collect()
    assert [r.Description for r in rows] == texts and len(rows) == 3


@contextmanager
def split_bytes(spark, n):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


LONG = ["two\nlines", 'a "b"\r\n,c', "plain", "", "\n\n\n", '"\n"', '""', "x,\n,y", 'end "\n', "café", "\n" * 30 + "far", 'say "\n", "\n" \\', " s "]


@pytest.mark.parametrize("size", [1, 13, 10 ** 6])
def test_records_split_anywhere(spark, scratch, size):
    import pandas as pd
    frame = pd.DataFrame([(str(i), "s", d, i, "12/1/2010 8:26", 2.55, "c", "UK") for i, d in enumerate(LONG)], columns=HEADER)
    frame.to_csv(f"{scratch}/a.csv", index=False, encoding="ISO-8859-1")
    frame[:4].to_csv(f"{scratch}/b.csv", index=False, encoding="ISO-8859-1", lineterminator="\r\n")
    open(f"{scratch}/c.csv", "w").close()
    with split_bytes(spark, size):
        df = read_raw_csv(spark, f"{scratch}/?.csv", multi_line=True)
        staged = stage_raw(df)
        rows = staged.orderBy("id").collect()
        plan = staged._jdf.queryExecution().executedPlan().toString()
    want = [d or None for d in LONG + LONG[:4]]
    assert [r.id for r in rows] == list(range(1, len(want) + 1)) and [r.Description for r in rows] == want
    assert [r.Quantity for r in rows] == [*range(len(LONG)), 0, 1, 2, 3] and all(r._corrupt_record is None and r.Country == "UK" for r in rows)
    assert "rangepartitioning" not in plan and "_seq" not in staged.columns


def test_a_quote_in_an_unquoted_field_is_a_character(spark, scratch):
    lines = ['1,s,5" PLATE,1,12/1/2010 8:26,1.00,c,UK', '2,s,"A ""B""\n2",2,12/1/2010 8:26,1.00,c,UK', '3,s,x"y"z"",3,12/1/2010 8:26,1.00,c,UK', "",
             '4,s,d,four,12/1/2010 8:26,1.00,c,UK', '5,s,"never closed,5,12/1/2010 8:26', "1,2"]
    with open(f"{scratch}/q.csv", "w", encoding="ISO-8859-1") as f:
        f.write(",".join(HEADER) + "\n" + "\n".join(lines) + "\n")
    for size in (5, 10 ** 6):
        with split_bytes(spark, size):
            rows = {r.InvoiceNo: r for r in read_raw_csv(spark, f"{scratch}/q.csv", multi_line=True).collect()}
        assert sorted(rows) == ["1", "2", "3", "4", "5"]
        assert rows["1"].Description == '5" PLATE' and rows["2"].Description == 'A "B"\n2' and rows["3"].Description == 'x"y"z""'
        assert rows["4"].Quantity is None and "four" in rows["4"]._corrupt_record and rows["5"].Description.startswith("never closed")


@given(st.lists(st.lists(st.text(alphabet='a",\n\r ', max_size=6), min_size=2, max_size=3), min_size=1, max_size=5))
@settings(max_examples=300, deadline=None)
def test_line_effects_compose_to_the_writers_records(table):
    buffer = io.StringIO()
    csv.writer(buffer, lineterminator="\n", quoting=csv.QUOTE_ALL).writerows(table)
    text, records, inside = buffer.getvalue().encode(), [], False
    for line in text.removesuffix(b"\n").split(b"\n"):
        if inside:
            records[-1] += b"\n" + line
        else:
            records.append(line)
        inside = line_effect(line)[inside]
    assert not inside and len(records) == len(table)
    assert [next(csv.reader(io.StringIO(r.decode(), newline=""))) for r in records] == table


def test_changed_splits_are_refused(spark, scratch):
    with open(f"{scratch}/s.csv", "w") as f:
        f.write(",".join(HEADER) + "\n" + "".join(f'{i},s,"d",1,12/1/2010 8:26,1.00,c,UK\n' for i in range(50)))
    df = read_raw_csv(spark, f"{scratch}/s.csv", multi_line=True)
    assert df.count() == 50
    with split_bytes(spark, 100), pytest.raises(Exception, match="splits changed"):
        df.select("Quantity", "InvoiceNo").collect()
    with pytest.raises(ValueError):
        read_raw_csv(spark, f"{scratch}/s.csv", encoding="UTF-16", multi_line=True)


def test_ids_in_place_over_many_splits(spark, scratch):
    want = []
    for f in range(3):
        with open(f"{scratch}/raw-{f}.csv", "w", encoding="ISO-8859-1") as out:
            out.write(",".join(HEADER) + "\n")
            for i in range(700 - 300 * f):
                want.append(f"{f}-{i}")
                out.write(f"{f}-{i},s,{'d' * (i % 37)},1,12/1/2010 8:26,1.00,c,UK\n")
    open(f"{scratch}/raw-9.csv", "w").close()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        df = read_raw_csv(spark, f"{scratch}/raw-*.csv")
        assert df.rdd.getNumPartitions() > 10
        staged = stage_raw(df)
        rows = staged.orderBy("id").collect()
        plan = staged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.id for r in rows] == list(range(1, len(want) + 1)) and [r.InvoiceNo for r in rows] == want
    assert "rangepartitioning" not in plan and "hashpartitioning" not in plan and staged.columns == ["id", *df.columns]
    assert stage_raw(read_raw_csv(spark, f"{scratch}/raw-9.csv")).count() == 0
