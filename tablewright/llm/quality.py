"""Robust multivariate outlier rules: a minimum covariance determinant per language and source.

Every document becomes a vector of transformed statistics. Each (language, source) gets the mean
and covariance of the subset of 75 % of its documents whose covariance has the smallest
determinant that concentration steps from three robust starts reach, taken until no determinant
falls any more; documents far from it by Mahalanobis distance are rejected. All of it is DataFrame
expressions and aggregates.

Vectors are integers (hundredths), so sums are exact and the verdict doesn't depend on how rows
are dealt out. Documents of groups below ``min_group`` are judged together by their language; those
of languages below it by an estimate over all documents. Only a table that is smaller itself gives
no estimate, and then nothing is an outlier. ``FLOOR`` and ``CUTOFF`` were set on the labelled rows.

Defined cases: a null or empty text has no words and fails the base rule; a null lang or source is
a value of its own; null and repeated doc_ids are judged row by row; a very long text is one row's
arrays in one task; an empty table gives no rows; other columns are not read, and keep_regular()
returns them whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import JAVA_BLANKS, stored, without

#: Chi-squared with six degrees of freedom: its median, and the cut-off that one regular document
#: in about 25,000 exceeds.
MEDIAN, CUTOFF = 5.348, 30.0
P, SHARE, WINDOW = 6, 0.75, 5
#: Least standard deviations of the six statistics in their transformed units (hundredths).
FLOOR = (80.0, 6.0, 35.0, 40.0, 50.0, 50.0)


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed a single time a row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeated_words(words: Column) -> Column:
    """How many words lie in a window of five words that the text holds more than once."""

    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(WINDOW))))

    def covered(w: Column) -> Column:
        ordered = F.sort_array(F.transform(w, lambda v, i: F.struct(v.alias("v"), i.alias("i"))))

        def starts(s: Column) -> Column:
            same = lambda x, k: x["v"].eqNullSafe(F.get(s, k)["v"])
            return F.sort_array(F.transform(F.filter(F.transform(s, lambda x, k: F.when(same(x, k - 1) | same(x, k + 1), x["i"])), lambda i: i.isNotNull()), lambda i: i))

        return once(once(ordered, starts), lambda p: F.aggregate(p, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")), lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"]))

    def count(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(covered(w))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < WINDOW, 0).otherwise(once(once(hashes, windows), count)).cast("long")


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper, n_lines."""
    texts = docs.select(F.col("doc_id").cast("long"), "lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    split = texts.select("doc_id", "lang", "source", "text", F.filter(F.split("text", JAVA_BLANKS), lambda w: w != "").alias("words"), lines.alias("lines"))
    return split.select(
        "doc_id", "lang", "source",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.length(F.regexp_replace("text", r"\P{Lu}+", "")).cast("long").alias("n_upper"),
        F.size("lines").cast("long").alias("n_lines"),
    )


def vector(stats: DataFrame) -> list[Column]:
    """The six transformed statistics in hundredths."""
    chars, words = F.greatest("word_chars", F.lit(1)), F.greatest("n_words", F.lit(1))
    raw = (
        F.log1p(F.col("n_words")),
        F.log1p(F.col("word_chars") / words),
        F.log(F.lit(0.02) + F.col("n_symbols") / chars),
        F.log(F.lit(0.05) + F.col("n_upper") / chars),
        F.log(F.lit(0.05) + F.col("n_repeat_words") / words),
        F.log(F.lit(0.05) + F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))),
    )
    return [F.round(c * 100).cast("long").alias(f"x{i}") for i, c in enumerate(raw)]


def moments() -> list[Column]:
    pairs = [(i, j) for i in range(P) for j in range(i + 1)]
    return [F.count("*").alias("n"), *(F.sum(f"x{i}").alias(f"s{i}") for i in range(P)), *(F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}_{j}") for i, j in pairs)]


def estimate(sums: DataFrame, *keys: str) -> DataFrame:
    """Mean m_i and Cholesky factor l_i_j of each group's covariance, and logdet; sums: moments()."""
    mean = [F.col(f"s{i}") / F.col("n") for i in range(P)]
    sums = sums.select(*keys, *(m.alias(f"m{i}") for i, m in enumerate(mean)), *(((F.col(f"s{i}_{j}") / F.col("n") - mean[i] * mean[j]) + (F.lit(FLOOR[i] ** 2) if i == j else F.lit(0.0))).alias(f"c{i}_{j}") for i in range(P) for j in range(i + 1)))
    factor: list[Column] = []
    for j in range(P):  # one column of the factor after the other; each names the ones before it
        factor.append(F.sqrt(F.col(f"c{j}_{j}") - sum((F.col(f"l{j}_{k}") ** 2 for k in range(j)), F.lit(0.0))).alias(f"l{j}_{j}"))
        factor += [((F.col(f"c{i}_{j}") - sum((F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j)), F.lit(0.0))) / F.col(f"l{j}_{j}")).alias(f"l{i}_{j}") for i in range(j + 1, P)]
    mean = [F.col(f"m{i}") for i in range(P)]
    return sums.select(*keys, *mean, *factor, sum((F.log(F.col(f"l{i}_{i}")) for i in range(P)), F.lit(0.0)).alias("logdet"))


def with_distance(rows: DataFrame) -> DataFrame:
    """rows (x_i, m_i, l_i_j) with d2, the squared Mahalanobis distance by forward substitution."""
    z = [((F.col(f"x{i}") - F.col(f"m{i}") - sum((F.col(f"l{i}_{k}") * F.col(f"z{k}") for k in range(i)), F.lit(0.0))) / F.col(f"l{i}_{i}")).alias(f"z{i}") for i in range(P)]
    return rows.select("*", *z, sum((F.col(f"z{i}") ** 2 for i in range(P)), F.lit(0.0)).alias("d2"))  # one select, analysed once


def level() -> Column:
    """d2 on a logarithmic scale of 1/32: few distinct values, so exact percentiles stay small."""
    return F.round(F.log2(F.lit(0.01) + F.col("d2")) * 32).cast("long")


def judged(docs: DataFrame, min_group: int = 60, most_steps: int = 30, cutoff: float = CUTOFF) -> DataFrame:
    """statistics() with base_failed, distance (squared, scaled) and kept."""
    stats = statistics(docs)
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = stored(stats.select("*", base_failed.alias("base_failed"), *vector(stats)), "quality-vectors")

    # small groups are pooled by language, then overall
    by_source = rows.groupBy("lang", "source").agg(F.count("*").alias("n")).withColumn("alone", F.col("n") >= min_group)
    by_lang = by_source.where(~F.col("alone")).groupBy("lang").agg(F.sum("n").alias("m"))
    own = by_source.alias("a").join(by_lang.alias("b"), F.col("a.lang").eqNullSafe(F.col("b.lang")), "left")
    own = own.select(F.col("a.lang").alias("g_lang"), F.col("source").alias("g_source"), F.when(F.col("alone"), F.xxhash64("a.lang", F.lit(1), F.coalesce(F.col("source"), F.lit("")), F.col("source").isNull())).when(F.col("m") >= min_group, F.xxhash64("a.lang", F.lit(2))).otherwise(F.lit(0).cast("long")).alias("g"))
    x = [f"x{i}" for i in range(P)]
    points = rows.join(stored(own, "quality-groups"), F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source"))).drop("g_lang", "g_source")
    points = stored(points, "quality-points")
    # estimates of the last group are over all documents
    last = points.where("g = 0").limit(1).count()
    fitted = points.select("g", *x).union(points.where("g <> 0").select(F.lit(0).cast("long"), *x)) if last else points.select("g", *x)
    both = fitted.select("*", F.explode(F.array(*map(F.lit, range(3)))).alias("start"))

    # start 0: spread around the median; 1: the covariance of clipped deviations; 2: of directions
    quartiles = fitted.groupBy("g").agg(F.count("*").alias("size"), *(F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q{i}") for i, c in enumerate(x)))
    spread = [F.greatest((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(FLOOR[i])) for i in range(P)]
    center = quartiles.select("g", "size", *(F.col(f"q{i}")[1].alias(f"m{i}") for i in range(P)), *(s.alias(f"e{i}") for i, s in enumerate(spread)))
    center = stored(center, "quality-centers")
    apart = [(F.col(f"x{i}") - F.col(f"m{i}")) / F.col(f"e{i}") for i in range(P)]
    clipped = [F.greatest(F.least(a, F.lit(1.5)), F.lit(-1.5)) for a in apart]
    length = F.sqrt(sum((a**2 for a in apart), F.lit(1e-9)) / P)
    turned = [F.when(F.col("start") == 1, c).otherwise(a / length) for c, a in zip(clipped, apart, strict=True)]
    tamed = both.where("start > 0").join(center, "g").select("g", "start", *(F.round(t * F.col(f"e{i}") + F.col(f"m{i}")).cast("long").alias(f"x{i}") for i, t in enumerate(turned)))
    first = center.select("g", F.lit(0).alias("start"), *(f"m{i}" for i in range(P)), *((F.col(f"e{i}") if i == j else F.lit(0.0)).alias(f"l{i}_{j}") for i in range(P) for j in range(i + 1)), F.lit(0.0).alias("logdet"))
    others = estimate(tamed.groupBy("g", "start").agg(*moments()), "g", "start")
    fit = stored(first.unionByName(others), "quality-starts")

    before = None
    for _ in range(most_steps):  # a concentration step: the nearest 75 % of each group, estimated anew
        placed = with_distance(both.join(fit, ["g", "start"])).select("g", "start", *x, level().alias("level"))
        # stored, so that the join below deals out both sides anew and can split a hot group
        most = stored(placed.groupBy("g", "start").agg(F.percentile("level", F.lit(SHARE)).alias("most")), "quality-levels")
        near = placed.join(most, ["g", "start"]).where(F.col("level") <= F.col("most"))
        fit = stored(estimate(near.groupBy("g", "start").agg(*moments()), "g", "start"), "quality-fit")
        now = fit.agg(F.sum(F.round("logdet", 6))).first()[0]
        if now is None or before is not None and now > before - 1e-6:  # no determinant has fallen
            break
        before = now

    best = fit.groupBy("g").agg(F.min_by("start", F.struct(F.round("logdet", 6), "start")).alias("start"))
    fit = stored(fit.join(best, ["g", "start"]).drop("start", "logdet"), "quality-best")
    placed = with_distance(fitted.join(fit, "g"))
    scale = placed.groupBy("g").agg(F.greatest(F.lit(1.0), (F.pow(F.lit(2.0), F.percentile(level(), F.lit(0.5)) / 32) - 0.01) / MEDIAN).alias("scale"))
    final = stored(fit.join(scale, "g").join(center.select("g", "size"), "g"), "quality-final")
    result = with_distance(points.join(final, "g")).withColumn("distance", F.col("d2") / F.col("scale"))
    kept = ~F.col("base_failed") & ((F.col("size") < min_group) | (F.col("distance") <= cutoff))
    return result.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", kept.alias("kept"))


def keep_regular(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that judged() keeps; rows without a doc_id can't be named and stay."""
    return without(docs, judged(docs, **how).where(~F.col("kept")), "quality-rejected")
