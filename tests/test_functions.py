"""Column helpers: edge cases from SURVEY §2.9 and §7.4."""

from pyspark.sql import functions as F

from tallywise import functions as TF


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_order_before_slash(spark):
    got = one(spark, TF.order_before_slash("x"), [("SO1/2",), ("SO3",), ("/a",), (None,)], "x string")
    assert got == ["SO1", "SO3", "", None]


def test_bracket_code_and_strip(spark):
    data = [("[FAM-1-01G] Rose",), ("no code",), ("[ A ] [B] x",), (None,)]
    assert one(spark, TF.bracket_code("x"), data, "x string") == ["FAM-1-01G", "", "A", ""]
    assert one(spark, TF.strip_brackets("x"), data, "x string") == ["Rose", "no code", "x", None]


def test_sku_prefix_suffix(spark):
    data = [("A-B-C",), ("A",), ("A-",), ("",)]
    assert one(spark, TF.sku_prefix("x"), data, "x string") == ["A-B", "", "A", ""]
    assert one(spark, TF.sku_suffix("x"), data, "x string") == ["C", "", "", ""]


def test_pair_label(spark):
    df = spark.createDataFrame([((1, "lbl"),), ((2, None),), (None,)], "p struct<id:bigint,label:string>")
    assert [r[0] for r in df.select(TF.pair_label("p")).collect()] == ["lbl", "2", ""]


def test_to_number_guards_suffix_and_nan(spark):
    data = [("1.5",), ("1d",), ("NaN",), ("n/a",), (" 2 ",), ("1e3",), (None,)]
    assert one(spark, TF.to_number("x"), data, "x string") == [1.5, None, None, None, 2.0, 1000.0, None]
    assert one(spark, TF.to_number_or_zero("x"), data, "x string")[1] == 0.0


def test_to_number_infinity(spark):
    data = [("inf",), ("-Infinity",), ("+INF",), ("infx",)]
    assert one(spark, TF.to_number("x"), data, "x string") == [float("inf"), float("-inf"), float("inf"), None]


def test_price_tolerance_is_double_strict(spark):
    df = spark.createDataFrame([(10.01, 10.00), (10.0, 10.009), (None, 1.0)], "a double, b double")
    got = [r[0] for r in df.select(TF.within("a", "b", 0.01)).collect()]
    assert got == [True, True, False]


def test_order_number(spark):
    data = [("#123",), ("#12a",), ("#x",), ("# 7",), ("#",)]
    assert one(spark, TF.order_number("x"), data, "x string") == [123, 12, 0, 7, 0]


def test_plant_name(spark):
    data = [("Rose - 01G",), ("Rose",), (None,), (" Big  - x - y",)]
    assert one(spark, TF.plant_name("x"), data, "x string") == ["Rose", "Rose", "", "Big"]


def test_iso_utc_and_parts(spark):
    df = spark.createDataFrame([("2024-03-05 22:30:00 -0500",), ("bad",), (None,)], "x string")
    ts = TF.parse_offset_ts("x")
    rows = df.select(F.when(ts.isNotNull(), TF.iso_utc(ts)).alias("iso"), *TF.date_parts(ts)).collect()
    assert tuple(rows[0]) == ("2024-03-06T03:30:00+0000", "06", "03", "2024")
    assert tuple(rows[1]) == (None, "00", "00", "0")


def test_array_helpers(spark):
    schema = ("codes array<struct<code:string>>, taxes array<struct<title:string,price:double>>, "
              "refunds array<struct<kind:string,transactions:array<struct<kind:string,amount:double>>>>")
    df = spark.createDataFrame([
        ([("A",), (None,)], [("VAT", 1.0)], [("void", [("refund", 2.0), ("sale", 5.0)])]),
        ([], None, None),
    ], schema)
    rows = df.select(TF.join_field("codes", "code"), TF.nth_field("taxes", 1, "title"),
                     TF.sum_field("taxes", "price"),
                     TF.sum_nested_where("refunds", "transactions", "amount", "kind", "refund"),
                     TF.sum_nested_where("refunds", "transactions", "amount", "kind", "refund", "outer")).collect()
    assert tuple(rows[0]) == ("A, ", None, 1.0, 2.0, 0.0)
    assert tuple(rows[1]) == ("", None, 0.0, 0.0, 0.0)


def test_like_pattern_matches_like_and_pushes_down(spark, tmp_path):
    data = [("F/Stock/S1",), ("f/x",), ("W/Other",), ("F",), (None,), ("_F",)]
    df = spark.createDataFrame(data, "x string")
    for pat, blind in (("F%", True), ("F%", False), ("F/St%", True), ("_F%", False), ("%S1", True)):
        got = [r[0] for r in df.select(TF.like_pattern("x", pat, blind)).collect()]
        want = [r[0] for r in df.select(F.ilike("x", F.lit(pat)) if blind else F.like("x", F.lit(pat))).collect()]
        assert got == want, pat
    path = str(tmp_path / "t")
    df.write.parquet(path)
    plan = spark.read.parquet(path).filter(TF.like_pattern("x", "F%", True))._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(x,F)" in plan and "StringStartsWith(x,f)" in plan
