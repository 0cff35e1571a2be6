"""Property tests: operators equal their brute-force definitions on random
small inputs (hypothesis; few examples, each runs Spark jobs)."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallywise.functions import to_number
from tallywise.operators import exists_other_value, null_safe_full_outer, prefix_equi_join

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))

_NUM = re.compile(r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$")


def _key(t):
    return tuple((v is None, str(v)) for v in t)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=_key)


@SETTINGS
@given(st.lists(st.text(alphabet="0123456789.eE+- dxn/", max_size=6), min_size=1, max_size=20))
def test_to_number_matches_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r[0] for r in df.select(to_number("x")).collect()]
    want = []
    for t in texts:
        if _NUM.match(t):
            try:
                want.append(float(t.strip()))
            except ValueError:
                want.append(None)
        else:
            want.append(None)
    assert got == want


_sku = st.text(alphabet="Ab-_%", min_size=1, max_size=6)


@SETTINGS
@given(st.lists(_sku, min_size=1, max_size=12), st.lists(_sku, min_size=1, max_size=6))
def test_prefix_join_matches_like(spark, texts, prefixes):
    t = spark.createDataFrame([(x,) for x in texts], "t string")
    p = spark.createDataFrame([(x, i) for i, x in enumerate(prefixes)], "p string, i int")
    got = _rows(prefix_equi_join(t, "t", p, "p").select("t", "i"))
    brute = _rows(t.crossJoin(p).filter(F.expr("t ilike p || '-%'")).select("t", "i"))
    assert got == brute


_opt = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))


@SETTINGS
@given(st.lists(st.tuples(_opt, _opt), max_size=10), st.lists(st.tuples(_opt, _opt), max_size=10))
def test_skew_safe_full_outer_equals_plain(spark, left, right):
    a = spark.createDataFrame([(x, y, i) for i, (x, y) in enumerate(left)], "o string, s string, v int")
    b = spark.createDataFrame([(x, y, i) for i, (x, y) in enumerate(right)], "o2 string, s2 string, w int")
    safe = null_safe_full_outer(a, b, [a.o, a.s], [b.o2, b.s2], skew_safe=True)
    plain = null_safe_full_outer(a, b, [a.o, a.s], [b.o2, b.s2], skew_safe=False)
    assert _rows(safe) == _rows(plain)


@SETTINGS
@given(st.lists(st.tuples(_opt, _opt), max_size=10), st.lists(st.tuples(_opt, _opt), max_size=10))
def test_exists_other_value_equals_semi(spark, rows, other):
    r = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(rows)], "k string, v string, i int")
    o = spark.createDataFrame(list(other), "k2 string, v2 string")
    got = _rows(exists_other_value(r, "k", "v", o, "k2", "v2"))
    brute = _rows(r.join(o, (r.k == o.k2) & (r.v != o.v2), "left_semi"))
    assert got == brute


_val = st.one_of(st.none(), st.sampled_from([0.0, 1.0, 5.0]))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), _val, _val), min_size=1, max_size=6),
       st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), _val, _val, _val, _val), max_size=6))
def test_combined_storefront_equals_join_then_max(spark, prods, invs):
    from tallywise.plans.stock import combined_storefront
    sp = spark.createDataFrame([(k, f"t{i}", "active", q, o) for i, (k, q, o) in enumerate(prods)],
                               "sku string, title string, status string, inventory_quantity double, "
                               "old_inventory_quantity double")
    si = spark.createDataFrame(list(invs), "sku string, on_hand double, available double, committed double, "
                                           "unavailable double")
    got = _rows(combined_storefront(sp, si))
    j = sp.alias("sp").join(si.alias("si"), F.col("sp.sku") == F.col("si.sku"), "left")
    brute = _rows(j.groupBy(F.col("sp.sku").alias("sku")).agg(
        F.max("sp.title"), F.max("sp.status"),
        F.max(F.coalesce("si.on_hand", "sp.old_inventory_quantity", F.lit(0.0))),
        F.max(F.coalesce("si.available", "sp.inventory_quantity", F.lit(0.0))),
        F.max(F.coalesce("si.committed", F.lit(0.0))), F.max(F.coalesce("si.unavailable", F.lit(0.0)))))
    assert got == brute


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 5)), min_size=1, max_size=15))
def test_first_per_group_matches_pandas(spark, data):
    import pandas as pd
    from tallywise.operators import first_row_per_group, flag_first_in_group
    rows_ = [(k, i, v) for i, (k, v) in enumerate(data)]  # i = file order
    df = spark.createDataFrame(rows_, "k string, i long, v long")
    pdf = pd.DataFrame(rows_, columns=["k", "i", "v"])
    want_flags = sorted(zip(pdf.k, pdf.i, ~pdf.duplicated(subset=["k"], keep="first")))
    got_flags = sorted((r.k, r.i, r.f) for r in flag_first_in_group(df, "k", "i", "f").collect())
    assert got_flags == [(k, i, bool(f)) for k, i, f in want_flags]
    want_first = sorted(map(tuple, pdf.drop_duplicates(subset=["k"], keep="first").values.tolist()))
    assert sorted(tuple(r) for r in first_row_per_group(df, "k", "i").select("k", "i", "v").collect()) == want_first


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 50)), min_size=1, max_size=40),
       st.integers(1, 10))
def test_line_numbers_any_threshold(spark, data, threshold):
    from tallywise.operators import number_within_group
    df = spark.createDataFrame([(k, o, i) for i, (k, o) in enumerate(data)], "k string, o long, i long")
    plain = number_within_group(df, "k", ["o", "i"], hot_threshold=None)
    split = number_within_group(df, "k", ["o", "i"], hot_threshold=threshold, partitions=3)
    assert _rows(plain) == _rows(split)


@SETTINGS
@given(st.lists(st.tuples(_sku, st.integers(0, 6)), min_size=1, max_size=10),
       st.lists(st.tuples(_sku, st.integers(0, 6)), min_size=1, max_size=6))
def test_keyed_prefix_join_matches_like(spark, texts, prefixes):
    t = spark.createDataFrame([(x, q) for x, q in texts], "t string, q int")
    p = spark.createDataFrame([(x, q, i) for i, (x, q) in enumerate(prefixes)], "p string, r int, i int")
    near = F.array(F.col("q") - 1, F.col("q"), F.col("q") + 1)
    got = _rows(prefix_equi_join(t, "t", p, "p", text_keys=near, prefix_key=F.col("r")).select("t", "q", "i"))
    brute = _rows(t.crossJoin(p).filter(F.expr("t ilike p || '-%' and abs(q - r) <= 1")).select("t", "q", "i"))
    assert got == brute
