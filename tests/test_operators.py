"""Operators against brute-force equivalents on small frames."""

from pyspark.sql import functions as F

from tallywise.operators import (
    dense_index, exists_other_value, first_row_per_group, flag_first_in_group, last_wins,
    null_safe_full_outer, number_within_group, prefix_equi_join,
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))


def test_null_safe_full_outer_matches_unsplit(spark):
    a = spark.createDataFrame([(None, "x", 1), (None, "y", 2), ("o1", "x", 3), ("o1", None, 4)],
                              "o string, s string, v int")
    b = spark.createDataFrame([(None, "x", 10), (None, "x", 11), ("o1", None, 12), ("o2", "x", 13)],
                              "o2 string, s2 string, w int")
    split = null_safe_full_outer(a, b, [a.o, a.s], [b.o2, b.s2], skew_safe=True)
    whole = null_safe_full_outer(a, b, [a.o, a.s], [b.o2, b.s2], skew_safe=False)
    assert rows(split) == rows(whole)
    # null order keys match each other on the SKU
    assert (None, "x", 1, None, "x", 10) in rows(split)
    assert len(rows(split)) == 6


def test_first_and_last_per_group(spark):
    df = spark.createDataFrame([("a", 3, "late"), ("a", 1, "early"), ("b", 2, "only")], "k string, i int, v string")
    assert rows(first_row_per_group(df, "k", "i")) == [("a", 1, "early"), ("b", 2, "only")]
    assert rows(last_wins(df, "k", "i")) == [("a", 3, "late"), ("b", 2, "only")]
    flagged = flag_first_in_group(df, "k", "i", "f")
    assert rows(flagged.select("k", "i", "f")) == [("a", 1, True), ("a", 3, False), ("b", 2, True)]


def test_number_within_group_hot_path_equals_window(spark):
    df = spark.range(0, 3000).select((F.when(F.col("id") < 2000, F.lit(1)).otherwise(F.col("id") % 7)).alias("k"),
                                     (F.col("id") * 7919 % 3001).alias("o"))
    plain = number_within_group(df, "k", ["o"], hot_threshold=None)
    skew = number_within_group(df, "k", ["o"], hot_threshold=100, partitions=5)
    assert rows(plain) == rows(skew)


def test_dense_index(spark):
    df = spark.range(0, 500).select((F.col("id") * 37 % 500).alias("x"))
    got = sorted(tuple(r) for r in dense_index(df, ["x"]).collect())
    assert got == [(i + 1, i) for i in range(500)]


def test_prefix_equi_join_equals_like(spark):
    texts = spark.createDataFrame([("FAM-1-01G",), ("fam-1-03g",), ("FAM-10-01G",), ("X_1-01G",), ("A-B-C-D",)],
                                  "t string")
    prefixes = spark.createDataFrame([("FAM-1", 1), ("X_1", 2), ("A", 3), ("A-B-C", 4), ("F%", 5)],
                                     "p string, id int")
    got = rows(prefix_equi_join(texts, "t", prefixes, "p").select("t", "id"))
    brute = rows(texts.crossJoin(prefixes).filter(F.expr("t ilike p || '-%'")).select("t", "id"))
    assert got == brute


def test_wildcard_keys_are_linear_in_the_text(spark):
    from tallywise.operators.prefix import _candidate_keys
    texts = spark.createDataFrame([("ab" * n,) for n in (1, 5, 20, 100)], "t string")
    for r in texts.select(F.length("t").alias("n"), F.size(_candidate_keys(F.col("t"))).alias("k")).collect():
        assert r.k <= 4 * r.n + 2
    distinct = spark.createDataFrame([("".join(chr(97 + i % 26) + chr(65 + i // 26) for i in range(60)),)], "t string")
    assert distinct.select(F.size(_candidate_keys(F.col("t")))).first()[0] <= 4 * 120 + 2


def test_exists_other_value_equals_semi_join(spark):
    lv = spark.createDataFrame([("i1", "L1", 1.0), ("i1", "L2", 2.0), ("i2", "L1", 3.0), ("i3", None, 4.0)],
                               "product_id string, location_id string, q double")
    pk = spark.createDataFrame([("i1", "L1"), ("i2", "L1"), ("i2", None), ("i3", "L1")], "item string, location string")
    got = rows(exists_other_value(lv, "product_id", "location_id", pk, "item", "location"))
    brute = rows(lv.join(pk, (lv.product_id == pk.item) & (lv.location_id != pk.location), "left_semi"))
    assert got == brute == [("i1", "L2", 2.0)]


def test_overrides_only_if_zero(spark):
    from tallywise.plans.inventory import apply_overrides, overrides_frame
    inv = spark.createDataFrame([("A", "t", 0.0, 5.0, 2.0, 1.0, 0.0), ("B", "t", 3.0, 3.0, 1.0, 0.0, 0.0),
                                 ("C", "t", 1.0, 1.0, 1.0, 1.0, 1.0)],
                                "sku string, title string, on_hand double, available double, committed double, "
                                "unavailable double, incoming double")
    ov = overrides_frame(spark, [("A", 41.0, 41.0, 0.0, 0.0, 0.0), ("B", 9.0, 9.0, 9.0, 9.0, 9.0)])
    always = {r["sku"]: r["on_hand"] for r in apply_overrides(inv, ov).collect()}
    zero = {r["sku"]: r["on_hand"] for r in apply_overrides(inv, ov, only_if_zero=True).collect()}
    assert always == {"A": 41.0, "B": 9.0, "C": 1.0}
    assert zero == {"A": 41.0, "B": 3.0, "C": 1.0}
    hit = apply_overrides(inv, ov, only_if_zero=True).where("sku = 'A'").first()  # two quantities change, no other
    assert (hit["committed"], hit["available"], hit["unavailable"], hit["incoming"]) == (41.0, 5.0, 1.0, 0.0)


def test_failing_source_raises_and_missing_source_falls_through(spark):
    import pytest
    from tallywise.sources.files import first_usable
    some = spark.range(3)
    broken = lambda: some.where(F.raise_error(F.lit("lost")).cast("boolean"))
    with pytest.raises(Exception, match="lost"):
        first_usable(broken, lambda: some)
    assert first_usable(lambda: spark.read.parquet("/tmp/there/is/nothing"), lambda: some.select("nope"), lambda: some).count() == 3
    assert first_usable(lambda: some.limit(0)) is None


def test_broken_json_line_fails_the_load(spark):
    import pytest
    from tallywise.plans.inventory import classify_records
    lines = spark.createDataFrame([('{"id": "a"', 1)], "value string, line_no int")
    with pytest.raises(Exception, match="not a JSON object"):
        classify_records(lines).collect()
    fine = spark.createDataFrame([('{"other": 1}', 1), ("", 2), (None, 3)], "value string, line_no int")
    assert classify_records(fine).count() == 0


def test_csv_round_trip_by_header(spark, tmp_path):
    from tallywise.sources.files import read_csv
    from tallywise.sources.sinks import write_report
    data = [('Rose 3" pot, red', "a\nb", 1.5), ("plain", 'q"', None)]
    write_report(spark.createDataFrame(data, "name string, note string, price double"), str(tmp_path / "out"))
    got = read_csv(spark, str(tmp_path / "out"), "price double, absent string, name string, note string")
    assert {(r["name"], r["note"], r["price"], r["absent"]) for r in got.collect()} == {(*d, None) for d in data}


def test_times_outside_utc(spark):
    from tallywise.functions import date_parts, iso_utc
    from tallywise.functions.dates import parse_offset_ts
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = spark.createDataFrame([("2024-03-10 02:30:00 +0000",), ("2024-03-10T02:30:00Z",), ("2024-03-09T21:30:00-05:00",),
                                      ("2024-03-10 02:30:00",)], "t string")
        ts = parse_offset_ts("t")
        got = rows.select(iso_utc(ts).alias("iso"), *date_parts(ts)).collect()
        assert {tuple(r) for r in got} == {("2024-03-10T02:30:00+0000", "10", "03", "2024")}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_part_files_order_by_number(spark, tmp_path):
    from tallywise.sources.files import read_json_lines
    for n in (9, 10, 99999, 100000):
        (tmp_path / f"part-{n:05d}.json").write_text(f"{n}\n")
    assert [r["value"] for r in read_json_lines(spark, str(tmp_path)).orderBy("line_no").collect()] == ["9", "10", "99999", "100000"]


def test_duplicate_keys(spark):
    from tallywise.operators import duplicate_keys
    dim = spark.createDataFrame([("01G", 1.0), ("01G", 2.0), ("03G", 3.0)], "name string, c double")
    assert rows(duplicate_keys(dim, "name")) == [("01G", 2)]


def test_rename_picking_maps_export_headers(spark):
    import pytest as _pytest
    from tallywise.plans.pull import pullsheet, rename_picking
    raw = spark.createDataFrame(
        [("SO7/1", "[FAM-1-01G] Rose", "F/Stock/S1", 3.0, 9.0, "x")],
        "`Stock Moves` string, `Stock Moves/Product` string, `Stock Moves/Move Line/From` string, "
        "`Stock Moves/Quantity` double, `Stock Moves/Product/Quantity On Hand` double, extra string")
    got = pullsheet(rename_picking(raw)).collect()
    assert [tuple(r) for r in got] == [("SO7", "Rose", "S1", 3.0, 9.0)]
    with _pytest.raises(ValueError):
        rename_picking(raw.drop("Stock Moves/Quantity"))


def test_broadcast_if_small_respects_the_bound(spark):
    from tallywise.operators import broadcast_if_small, estimated_bytes
    big = spark.range(10 ** 10)
    small = spark.range(10)
    assert estimated_bytes(big) > 64 * 1024 * 1024
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()
    assert not hinted(broadcast_if_small(big))
    assert hinted(broadcast_if_small(small))


def test_prefix_join_shuffles_both_sides(spark):
    """Exploded rows are many more than the planner expects: neither branch broadcasts them."""
    texts = spark.createDataFrame([("FAM-1-01G", 3.0)], "t string, q double")
    for p in ("FAM-1", "F%-1"):
        prefixes = spark.createDataFrame([(p, 2.0)], "p string, w double")
        plan = prefix_equi_join(texts, "t", prefixes, "p", text_keys=F.array(F.floor("q")), prefix_key=F.floor("w") + 1
                                )._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_wildcard_prefix_is_found_by_its_literal_ends(spark):
    from tallywise.operators.prefix import _candidate_keys, _end_keys, _pattern_keys
    q = spark.range(0, 2000).select(F.concat(F.lit("FAM-"), F.col("id").cast("string")).alias("q"))
    pat = spark.createDataFrame([("F%-1234",), ("F_M-1234",), ("%-1234",), ("FAM-123_",), ("%2%4",)], "p string")
    held = q.select("q", F.explode(F.concat(_candidate_keys(F.col("q")), _end_keys(F.col("q")))).alias("k")).groupBy("k").count()
    best = pat.select("p", F.explode(_pattern_keys(F.col("p"))).alias("k")).join(held, "k").groupBy("p").agg(F.min("count").alias("n"))
    n = {r.p: r.n for r in best.collect()}
    # one prefix ends so; pieces of three characters are shared by some twenty
    assert n["F%-1234"] == n["F_M-1234"] == n["%-1234"] == 1 and n["FAM-123_"] <= 11 and len(n) == 5
    texts = q.select(F.concat("q", F.lit("-01G")).alias("t"))
    pat = pat.unionByName(spark.createDataFrame([("%",), ("F%",), ("___",), ("f_m-1_",), ("%M-7_",)], "p string"))
    got = rows(prefix_equi_join(texts, "t", pat, "p").select("t", "p"))
    assert got == rows(texts.crossJoin(pat).filter(F.expr("t ilike p || '-%'")).select("t", "p"))
