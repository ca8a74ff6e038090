from collections import Counter

from pyspark.sql import functions as F

from patronage import config
from patronage.functions.rules import category_col, non_merch_col, roi_band_col, segment_col

SQL_CELLS = {"Champions": 8, "Loyal Customers": 10, "New Customers": 8, "Potential Loyalists": 18,
             "Promising": 18, "Need Attention": 16, "At Risk": 9, "Cannot Lose Them": 9,
             "Lost": 16, "Hibernating": 13}
NOTEBOOK_CELLS = {"Champions": 8, "Loyal Customers": 19, "New Customers": 20,
                  "Potential Loyalists": 21, "Promising": 0, "Need Attention": 7, "At Risk": 20,
                  "Cannot Lose Them": 12, "Lost": 8, "Hibernating": 10}


def _cells(spark, rules):
    grid = spark.range(125).select(
        (F.col("id") / 25).cast("int").alias("r0"), ((F.col("id") / 5) % 5).cast("int").alias("f0"),
        (F.col("id") % 5).cast("int").alias("m0"))
    seg = segment_col(F.col("r0") + 1, F.col("f0") + 1, F.col("m0") + 1, rules)
    return Counter(r[0] for r in grid.select(seg).collect())


def test_sql_segment_rules_all_cells(spark):
    got = _cells(spark, config.SQL_SEGMENT_RULES)
    assert {k: got.get(k, 0) for k in SQL_CELLS} == SQL_CELLS


def test_notebook_segment_rules_all_cells(spark):
    got = _cells(spark, config.NOTEBOOK_SEGMENT_RULES)
    assert {k: got.get(k, 0) for k in NOTEBOOK_CELLS} == NOTEBOOK_CELLS


def test_segment_sql_text_matches_column(spark):
    from patronage.functions.rules import segment_sql
    grid = spark.range(125).select(
        ((F.col("id") / 25).cast("int") + 1).alias("r"), (((F.col("id") / 5) % 5).cast("int") + 1).alias("f"),
        ((F.col("id") % 5).cast("int") + 1).alias("m"))
    for rules in (config.SQL_SEGMENT_RULES, config.NOTEBOOK_SEGMENT_RULES):
        a = grid.select(segment_col(F.col("r"), F.col("f"), F.col("m"), rules).alias("s"),
                        F.expr(segment_sql("r", "f", "m", rules)).alias("t"))
        assert a.where("s <> t").count() == 0


def test_categoriser_edge_rows(spark):
    cases = [("CHRISTMAS GIFT BAG", "Christmas & Seasonal"), ("BAGS", "Other / Miscellaneous"),
             ("RED BAG", "Bags & Accessories"), ("TEA TOWEL", "Kitchen & Dining"),
             ("BEACH TOWEL", "Bath & Body"), (None, "Other / Miscellaneous"),
             ("JUMBO BAG", "Bags & Accessories"), ("PAPER CHAIN KIT", "Stationery & Gifts")]
    df = spark.createDataFrame([(d,) for d, _ in cases], "d string")
    got = [r[0] for r in df.select(category_col(F.col("d"))).collect()]
    assert got == [c for _, c in cases]


def test_description_normalisation(spark):
    from patronage.plans.cleaning import _strip
    df = spark.createDataFrame([("  red bag ",), ("\tx\n",)], "d string")
    assert [r[0] for r in df.select(F.upper(_strip(F.col("d")))).collect()] == ["RED BAG", "X"]


def test_non_merch_codes(spark):
    codes = [("POST", True), ("BANK CHARGES", True), ("gift_0001_20", True), ("DCGS0003", True),
             ("POSTER1", False), ("M1", False), ("GIFT_1", False), ("M", True), ("85123A", False)]
    df = spark.createDataFrame([(c,) for c, _ in codes], "c string")
    assert [r[0] for r in df.select(non_merch_col(F.col("c"))).collect()] == [b for _, b in codes]


def test_roi_bands(spark):
    df = spark.createDataFrame([(250.0,), (200.0,), (150.0,), (100.0,), (99.9,), (-50.0,)], "r double")
    got = [r[0] for r in df.select(roi_band_col(F.col("r"))).collect()]
    assert got == ["green", "green", "amber", "amber", "red", "red"]


def test_categoriser_sql_text_form_matches_column_form(spark):
    words = ["CHRISTMAS GIFT BAG", "BAGS", "RED BAG", "TEA TOWEL", "BEACH TOWEL", None, "JAM JAR",
             "PENCIL CASE", "BALL", "FOOTBALL", "HANDBAGS", "SOAP DISH", "LIGHT", "LIGHTS"]
    df = spark.createDataFrame([(w,) for w in words], "d string")
    for rules in (config.CATEGORY_RULES, config.ADAPTER_CATEGORY_RULES):
        got = df.select(category_col(F.col("d"), rules).alias("a"), category_col("d", rules).alias("b"))
        assert got.where("NOT (a <=> b)").count() == 0


def test_production_category_rules_agree_with_duckdb(spark):
    """The production regexes over hand-made descriptions, in both engines."""
    import duckdb
    from pyspark.sql import functions as F

    from patronage import config
    from patronage.functions.rules import category_col
    from patronage.plans.oracle import category_case

    words = ["CHRISTMAS", "XMAS TREE", "BAG", "JUMBO BAG RED", "HANDBAG", "MUG", "TEA CUP", "CUPBOARD", "PLATE", "CAKE STAND", "LANTERN", "T-LIGHT HOLDER",
             "CANDLE", "FRAME", "CLOCK", "CARD", "NOTEBOOK", "PENCIL", "WRAP", "TOY", "GAME", "DOLL", "GARDEN", "PLANTER", "SOAP", "BATH", "TOWEL",
             "UMBRELLA", "NECKLACE", "RING", "RINGBINDER", "SPACEBOY", "WICKER HEART", "SIGN", "", "  ", "CARDIGAN", "GIFT TAG", "RIBBON", "LUNCH BOX"]
    texts = [w for w in words] + [f"{a} {b}" for a in words[:20] for b in words[20:]] + [None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, d string")
    got = {r["id"]: r["c"] for r in rows.select("id", category_col("d", config.CATEGORY_RULES).alias("c")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (id INTEGER, d VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(texts)))
    want = dict(con.execute(f"SELECT id, {category_case('d', config.CATEGORY_RULES)} FROM t").fetchall())
    assert got == want and len(set(got.values())) >= 6
