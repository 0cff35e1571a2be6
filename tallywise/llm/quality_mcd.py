"""Quality rules: base statistics and robust multivariate outliers.

Each document gets a vector of transformed text statistics. For every
(language, source) pair a minimum-covariance-determinant estimate of centre
and scatter is found by concentration steps over all its documents, and a
document is rejected when its squared Mahalanobis distance exceeds ``CUTOFF``.

The concentration steps are Spark aggregations. A step puts each document's
distance under the current estimate into a logarithmic bin and sums counts
and moments per (group, bin); the bins of smallest distance that hold the
fraction ``H`` of the group give the next estimate. So a group of any size
costs one partial row per bin and task, and no group is gathered.

Defined cases: null texts count as empty (rejected by the base rule); a null
language or source is a value of its own; a group of one keeps its document
unless the base rule rejects it; repeated rows are judged alike; empty input
gives empty output; columns named like the new ones are kept beside them only
if the caller renames them (``names`` sets the new names).
"""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywise.llm.common import fresh, pipeline_stage, stage, with_text_columns

# Fixed values.
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"

H = 0.5                   # fraction of a group that its estimate rests on; up to 1 - H of it may be bad
STEPS = 6                 # concentration steps
CONSISTENCY = 1.912       # makes the H-subset's scatter fit a normal sample, 5 dimensions: H / P(chi2_7 <= H-quantile of chi2_5)
CUTOFF = 30.86            # chi-squared quantile 0.99999, 5 dimensions
# Least standard deviation by dimension. Most clean texts have no symbols and
# no repeats at all, so the plain scatter of a group may vanish there.
FLOOR = (1.0, 0.15, 0.4, 0.6, 1.2)
PRIOR_ROWS = 10.0         # the floor's weight in rows, for small groups
BINS_PER_OCTAVE = 8
DIMS = 5
PAIRS = list(combinations_with_replacement(range(DIMS), 2))

STATS = [("n_words", T.LongType()), ("word_chars", T.LongType()), ("n_symbols", T.LongType()),
         ("n_dup_lines", T.LongType()), ("n_repeat_words", T.LongType())]


def repeat_words(words: list[bytes]) -> int:
    """Words inside an 8-word window that occurs twice or more (each word once).

    Windows are compared exactly: pairs of word codes get codes, pairs of
    those again, and so on (1, 2, 4, 8 words)."""
    n = len(words)
    if n <= WINDOW:
        return 0
    seen: dict[bytes, int] = {}
    codes = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    if len(seen) == n:
        return 0
    width = 1
    while width < WINDOW:
        top = int(codes.max()) + 1
        pairs = codes[:-width] * top + codes[width:]
        _, codes, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        width *= 2
        if len(counts) == len(codes):  # no repeat, so no longer one either
            return 0
    twice = np.flatnonzero(counts[codes] > 1)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + WINDOW, -1)
    return int((np.cumsum(edge) > 0).sum())


def text_stats(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    raw = text.encode()
    words = raw.split()
    spaces = len(raw) - len(raw.translate(None, SPACES))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    return len(words), len(text) - spaces, symbols, len(lines) - len(set(lines)), repeat_words(words)


def _batch_stats(texts: list[str]) -> list[list[int]]:
    rows = [text_stats(t) for t in texts]
    return [list(c) for c in zip(*rows)] if rows else [[] for _ in STATS]


def with_stats(df: DataFrame, text: str = "text", names: dict[str, str] | None = None) -> DataFrame:
    """``df`` with the five base statistics of its text column."""
    names = names or {}
    return with_text_columns(df, text, [(names.get(n, n), k) for n, k in STATS], _batch_stats)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def statistic_vector(col) -> list[Column]:
    """The transformed statistics; ``col`` maps a base statistic's name to its column."""
    n, chars = col("n_words"), col("word_chars")
    return [F.log1p(n.cast("double")),
            F.log((chars + 1) / (n + 1)),
            F.log1p(100.0 * col("n_symbols") / (chars + 1)),
            F.log1p(col("n_dup_lines").cast("double")),
            F.log1p(100.0 * col("n_repeat_words") / (n + 1))]


def distance(x: list[Column], mean: Column, inverse: Column) -> Column:
    """Squared Mahalanobis distance; ``inverse`` holds the 15 upper entries."""
    y = [x[i] - mean[i] for i in range(DIMS)]
    total = F.lit(0.0)
    for k, (i, j) in enumerate(PAIRS):
        total = total + inverse[k] * y[i] * y[j] * (1.0 if i == j else 2.0)
    return total


def _estimate_schema(groups: list[T.StructField]) -> T.StructType:
    return T.StructType(groups + [T.StructField("mean", T.ArrayType(T.DoubleType())),
                                  T.StructField("inverse", T.ArrayType(T.DoubleType()))])


def estimate(moments: np.ndarray, centre: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean and inverse scatter (upper entries) from count, sums and products about ``centre``."""
    n, sums, products = moments[0], moments[1:1 + DIMS], moments[1 + DIMS:]
    shift = sums / n
    cov = np.zeros((DIMS, DIMS))
    for k, (i, j) in enumerate(PAIRS):
        cov[i, j] = cov[j, i] = products[k] / n - shift[i] * shift[j]
    cov = scale * cov * (n / (n + PRIOR_ROWS)) + np.diag(np.square(FLOOR))
    inverse = np.linalg.inv(cov)
    return centre + shift, np.array([inverse[i, j] for i, j in PAIRS])


def _finish(moments: DataFrame, groups: list[T.StructField], scale: float) -> DataFrame:
    """One estimate per row of summed moments (``m``: array, ``centre``: array)."""
    def run(batches):
        for b in batches:
            m = np.array(b.column("m").to_pylist(), float).reshape(-1, 1 + DIMS + len(PAIRS))
            c = np.array(b.column("centre").to_pylist(), float).reshape(-1, DIMS)
            made = [estimate(m[k], c[k], scale) for k in range(len(m))]
            kind = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays(
                [b.column(g.name) for g in groups] + [pa.array([x[0].tolist() for x in made], kind),
                                                      pa.array([x[1].tolist() for x in made], kind)],
                [g.name for g in groups] + ["mean", "inverse"])

    return moments.select(*[g.name for g in groups], "m", "centre").mapInArrow(run, _estimate_schema(groups))


def _moments(y: list[Column]) -> list[Column]:
    return [F.count(F.lit(1)).cast("double"), *[F.sum(v) for v in y], *[F.sum(y[i] * y[j]) for i, j in PAIRS]]


def mcd_estimates(rows: DataFrame) -> DataFrame:
    """Centre and inverse scatter per (lang, source) as columns g_lang, g_source, mean, inverse.

    Starts from the coordinate medians with the floor as scatter, then
    concentrates ``STEPS`` times. Medians and subset both rest on half of a
    group, so outliers of somewhat less than half of it enter neither.
    The moments are taken about the current centre, so they lose no digits.
    """
    rows = rows.select("g_lang", "g_source", *[F.col("vector")[i].alias(f"x{i}") for i in range(DIMS)])
    groups = [rows.schema["g_lang"], rows.schema["g_source"]]
    x = [F.col(f"x{i}") for i in range(DIMS)]
    inverse = np.linalg.inv(np.diag(np.square(FLOOR)))
    start = F.array(*[F.lit(float(inverse[i, j])) for i, j in PAIRS])
    est = stage(rows.groupBy("g_lang", "g_source")
                .agg(F.array(*[F.percentile_approx(v, 0.5, 1000) for v in x]).alias("mean"))
                .withColumn("inverse", start).select("g_lang", "g_source", "mean", "inverse"), "mcd")
    for _ in range(STEPS):
        # one row per group; the optimizer broadcasts it only where its measured size allows
        e = est.withColumnsRenamed({"g_lang": "e_lang", "g_source": "e_source"})
        joined = rows.join(e, F.col("g_lang").eqNullSafe(F.col("e_lang"))
                           & F.col("g_source").eqNullSafe(F.col("e_source")))
        d2 = distance(x, F.col("mean"), F.col("inverse"))
        binned = joined.select("g_lang", "g_source", "mean",
                               F.floor(BINS_PER_OCTAVE * F.log2(F.greatest(d2, F.lit(1e-9)))).cast("int").alias("bin"),
                               *[(x[i] - F.col("mean")[i]).alias(f"y{i}") for i in range(DIMS)])
        y = [F.col(f"y{i}") for i in range(DIMS)]
        parts = [f"p{k}" for k in range(1 + DIMS + len(PAIRS))]
        bins = (binned.groupBy("g_lang", "g_source", "bin")
                .agg(F.first("mean").alias("mean"), *[c.alias(p) for c, p in zip(_moments(y), parts)]))
        # a group has at most a few hundred bins, whatever its rows
        up = W.partitionBy("g_lang", "g_source").orderBy("bin")
        whole = W.partitionBy("g_lang", "g_source")
        inner = (bins.withColumn("before", F.sum("p0").over(up) - F.col("p0"))
                 .withColumn("total", F.sum("p0").over(whole))
                 .where(F.col("before") < H * F.col("total")))
        summed = (inner.groupBy("g_lang", "g_source")
                  .agg(F.first("mean").alias("centre"), F.array(*[F.sum(p) for p in parts]).alias("m")))
        est = stage(_finish(summed, groups, CONSISTENCY), "mcd")
    return est


def judge(df: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
          base: str = "base_failed", kept: str = "kept", names: dict[str, str] | None = None) -> DataFrame:
    """``df`` with the base statistics, ``base`` and ``kept``.

    The statistics are computed twice, for the estimates and for the verdicts:
    that costs less than writing all texts to carry them along. Base failures
    are part of the estimates too (they are what the estimate must resist).
    """
    names = {n: (names or {}).get(n, n) for n, _ in STATS}
    plain = with_stats(df.select(F.col(lang).alias("g_lang"), F.col(source).alias("g_source"), F.col(text).alias("g_text")), "g_text")
    vectors = stage(plain.select("g_lang", "g_source", F.array(*statistic_vector(F.col)).alias("vector")), "quality")
    est = mcd_estimates(vectors)
    rows = with_stats(df, text, names)
    e = [fresh(rows, n) for n in ("g_lang", "g_source", "mean", "inverse")]
    est = est.toDF(*e)
    judged = rows.join(est, rows[lang].eqNullSafe(est[e[0]]) & rows[source].eqNullSafe(est[e[1]]), "left")
    x = statistic_vector(lambda n: F.col(names[n]))
    failed = base_failed(F.col(names["n_words"]), F.col(names["n_repeat_words"]))
    dist = fresh(judged, "distance")
    return (judged.withColumn(dist, F.coalesce(distance(x, F.col(e[2]), F.col(e[3])), F.lit(0.0)))
            .withColumn(base, failed)
            .withColumn(kept, ~failed & (F.col(dist) <= CUTOFF))
            .drop(*e).withColumnRenamed(dist, fresh(df, "mahalanobis")))


@pipeline_stage
def quality_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the rules keep, with their own columns."""
    base, kept = fresh(docs, "base_failed"), fresh(docs, "kept")
    names = {n: fresh(docs, n) for n, _ in STATS}
    return judge(docs, base=base, kept=kept, names=names).where(F.col(kept)).select(*docs.columns)
