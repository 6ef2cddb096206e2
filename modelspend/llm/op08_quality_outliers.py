"""Quality rules: robust multivariate outliers, with DataFrame operations only.

Six statistics of each text, transformed to be roughly symmetric, form a vector.
Per language and source, the minimum-covariance-determinant (MCD) estimate finds
the centre and scatter of the tightest share ``H`` of the documents: it starts
from medians and median deviations, then repeats concentration steps (take the
``H`` nearest by Mahalanobis distance, re-estimate) until no estimate changes, ``STEPS`` at
most.  Documents beyond the chi-square cutoff are rejected, and so are those that fail the fixed
rules.  Least deviations keep the scatter regular where most texts have none of a kind.  They are low
enough for each statistic to reject a text by itself, but for repeated words, which the fixed rules
cut at 30 percent: there they only add to the others, as a lower one costs clean texts.

Vectors are whole multiples of 1/256, so all sums are exact integers and the
verdicts don't depend on the order of rows.  "The nearest H" is cut on a fixed
grid of distances: each step is one aggregation to a bounded number of grid
cells per source, and no source's rows meet in one task.  Sources with fewer
than ``MIN_ROWS`` vectors, five for each dimension, share the estimate of their language's small
sources, and languages with fewer that of all such languages; if these are too few as well, the corpus's
largest group gives the estimate.

Edge cases: a null text has no words and fails; a null language or source is a
value of its own; equal rows get equal verdicts; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import math
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from modelspend.llm.shared import SPACES, read_table, row_key, stage

WINDOW = 8
MIN_WORDS, MAX_REPEATED_PERCENT = 20, 30
SYMBOLS = r"[#*$%&|<>]"
SCALE = 256
H = 0.75
STEPS = 12
MIN_ROWS = 30
CUTOFF = 0.99999
SALTS = 16
#: Vector components, and the least standard deviation that an estimate may have.
FLOORS = {"words": 0.1, "length": 0.05, "symbols": 0.5, "lines": 0.72, "repeats": 1.0, "capitals": 0.5}
DIMS = tuple(FLOORS)
PAIRS = tuple(combinations_with_replacement(range(len(DIMS)), 2))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def chi2_cdf(x: float, k: int) -> float:
    """The chi-square distribution, by the series of the lower incomplete gamma function."""
    a, x = k / 2, x / 2
    term = total = 1 / a
    n = 1
    while term > total * 1e-15:
        term *= x / (a + n)
        total += term
        n += 1
    return total * math.exp(a * math.log(x) - x - math.lgamma(a))


def chi2_quantile(p: float, k: int) -> float:
    low, high = 1e-9, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < p else (low, mid)
    return high


def consistency() -> float:
    """Scatter of the nearest share H of normal vectors, made up to the whole."""
    return H / chi2_cdf(chi2_quantile(H, len(DIMS)), len(DIMS) + 2)


# ------------------------------------------------------------------- statistics


def text_statistics(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """The counts of each row's text, and the columns ``carry`` as the struct ``doc``; else ``text`` is dropped."""
    text = F.coalesce("text", F.lit(""))
    carried = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("doc")] if carry else []
    doc = ["doc"] if carry else []
    docs = docs.select(
        "doc_id",
        *carried,
        *[F.coalesce(c, F.lit("\x00")).alias(c) for c in ("lang", "source")],
        row_key("text", "lang", "source").alias("row_key"),
        text.alias("text"),
        F.array_remove(F.split(text, SPACES), "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    n = F.size("words")
    windows = F.when(
        n >= WINDOW,
        F.transform(F.sequence(F.lit(1), n - WINDOW + 1), lambda i: F.xxhash64(F.slice("words", i, WINDOW))),
    ).otherwise(F.array().cast("array<bigint>"))
    docs = docs.select(
        "doc_id",
        *doc,
        "lang",
        "source",
        "row_key",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit("[A-Z!]")).cast("long").alias("n_capitals"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("windows"),
    )
    # only texts with an equal pair of windows need to know where they are
    places = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeated = F.size(F.array_distinct("windows")) < F.size("windows")
    docs = docs.withColumn("places", F.when(repeated, places)).drop("windows")
    again = F.filter(
        "places", lambda p, i: (F.get("places", i - 1)["h"] == p["h"]) | (F.get("places", i + 1)["h"] == p["h"])
    )
    starts = F.sort_array(F.transform(again, lambda p: p["i"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )
    return docs.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("places")


def failed_rules() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )


def vectors(stats: DataFrame) -> DataFrame:
    """The transformed vector z0, z1, ... of each row in steps of 1 / SCALE."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    share = lambda c, of: F.log1p(100 * F.col(c) / of)
    values = (
        F.log1p("n_words"),
        F.log1p(F.col("word_chars") / n),
        share("n_symbols", n),
        share("n_dup_lines", F.greatest(F.col("n_lines"), F.lit(1))),
        share("n_repeat_words", n),
        share("n_capitals", F.greatest(F.col("word_chars"), F.lit(1))),
    )
    return stats.withColumns({f"z{i}": F.round(v * SCALE).cast("long") for i, v in enumerate(values)})


# -------------------------------------------------------------------- estimates


def cumulative(key: list[str], order: str, count: str) -> Column:
    return F.sum(count).over(W.partitionBy(*key).orderBy(order).rowsBetween(W.unboundedPreceding, 0))


#: Stands for the language of languages with few rows.
REST = "\x01"


def share_groups(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, source, grp, whole) of the rows that make an estimate, and (lang, source, grp): the estimate that each source uses."""
    counts = stage(rows.groupBy("lang", "source").count(), "quality-counts")
    grp = lambda lang, own: F.struct(lang.alias("lang"), own.cast("string").alias("own"))
    none, whole = F.lit(None), F.sum("count").over(W.partitionBy("grp"))
    own = F.when(F.col("count") >= MIN_ROWS, grp(F.col("lang"), F.col("source"))).otherwise(grp(F.col("lang"), none))
    by_language = counts.withColumn("grp", own).withColumn("whole", whole)
    few = F.when(F.col("whole") >= MIN_ROWS, F.col("grp")).otherwise(grp(F.lit(REST), none))
    grouped = by_language.withColumn("grp", few).withColumn("whole", whole)
    largest = by_language.agg(F.max(F.struct("whole", "grp"))).scalar()
    # the rest makes an estimate if it has the rows, or if there is nothing else
    lone = (F.col("whole") < MIN_ROWS) & (largest["whole"] >= MIN_ROWS)
    members = grouped.filter(~lone).select("lang", "source", "grp", "whole")
    uses = grouped.select("lang", "source", F.when(lone, largest["grp"]).otherwise(F.col("grp")).alias("grp"))
    return stage(members, "quality-groups"), stage(uses, "quality-uses")


def first_estimate(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """(grp, m0.., l.., d..): medians and median absolute deviations; no correlation yet."""
    dims = F.explode(F.array(*[F.struct(F.lit(i).alias("dim"), F.col(f"z{i}").alias("z")) for i in range(len(DIMS))]))
    values = rows.groupBy("lang", "source", *[f"z{i}" for i in range(len(DIMS))]).count()
    values = values.select("lang", "source", "count", dims.alias("v")).select("lang", "source", "count", "v.*")
    values = values.groupBy("lang", "source", "dim", "z").agg(F.sum("count").alias("n"))
    values = values.join(groups, ["lang", "source"]).groupBy("grp", "dim", "z", "whole").agg(F.sum("n").alias("n"))

    def median(df: DataFrame, value: str) -> DataFrame:
        upto = df.withColumn("upto", cumulative(["grp", "dim"], value, "n")).filter(2 * F.col("upto") >= F.col("whole"))
        return upto.groupBy("grp", "dim").agg(F.min(value).alias("median"))

    middle = median(values, "z")
    spread = values.join(middle, ["grp", "dim"]).withColumn("off", F.abs(F.col("z") - F.col("median")))
    spread = spread.groupBy("grp", "dim", "off", "whole").agg(F.sum("n").alias("n"))
    spread = median(spread, "off").withColumnRenamed("median", "mad")
    of = lambda i, c: F.max(F.when(F.col("dim") == i, F.col(c)))
    both = middle.join(spread, ["grp", "dim"]).groupBy("grp")
    columns = []
    for i, floor in enumerate(FLOORS.values()):
        columns.append((of(i, "median") / SCALE).alias(f"m{i}"))
        deviation = F.greatest(1.4826 * of(i, "mad") / SCALE, F.lit(floor))
        columns.append((deviation * deviation).alias(f"d{i}"))
    columns += [F.lit(0.0).alias(f"l{i}_{j}") for j, i in PAIRS if j < i]
    return both.agg(*columns)


def by_source(estimate: DataFrame, uses: DataFrame) -> DataFrame:
    """Each source's estimate as a stored table, whose known size lets Spark send it to the rows where it is small."""
    return stage(uses.join(estimate, "grp").drop("grp"), "quality-mcd")


def mark(estimates: DataFrame) -> tuple:
    """Equal for equal estimates, to six digits."""
    rounded = [F.round(c, 6) for c in estimates.columns if c[0] in "mld" and c[1].isdigit()]
    return tuple(estimates.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("lang", "source", *rounded))).first())


def distances(rows: DataFrame, estimates: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` with ``d2``, their squared Mahalanobis distance by their source's estimate.

    Where there are too many sources to send their estimates to all tasks, these go to each
    of the salts of a source, so a source with many rows is read by as many tasks.
    """
    salted_estimates = estimates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "row_key"), F.lit(SALTS)).cast("int"))
    joined = salted.join(salted_estimates, ["lang", "source", "salt"], how).drop("salt")
    for i in range(len(DIMS)):
        y = F.col(f"z{i}") / SCALE - F.col(f"m{i}")
        for j in range(i):
            y = y - F.col(f"l{i}_{j}") * F.col(f"y{j}")
        joined = joined.withColumn(f"y{i}", y)
    terms = [F.col(f"y{i}") * F.col(f"y{i}") / F.col(f"d{i}") for i in range(len(DIMS))]
    joined = joined.withColumn("d2", sum(terms[1:], terms[0]))
    return joined.drop(*[c for c in joined.columns if c not in rows.columns and c != "d2"])


def concentrate(rows: DataFrame, estimates: DataFrame, groups: DataFrame) -> DataFrame:
    """One concentration step: the mean and scatter of the H nearest, decomposed as L D L'."""
    cell = F.floor(64 * F.log2(1 + F.col("d2"))).alias("cell")
    sums = [F.sum(f"z{i}").alias(f"s{i}") for i in range(len(DIMS))]
    sums += [F.sum(F.col(f"z{i}") * F.col(f"z{j}")).alias(f"p{i}_{j}") for i, j in PAIRS]
    cells = distances(rows, estimates).groupBy("lang", "source", cell).agg(F.count("*").alias("n"), *sums)
    names = ["n", *[f"s{i}" for i in range(len(DIMS))], *[f"p{i}_{j}" for i, j in PAIRS]]
    cells = cells.join(groups, ["lang", "source"]).groupBy("grp", "whole", "cell")
    cells = cells.agg(*[F.sum(c).alias(c) for c in names])
    before = cumulative(["grp"], "cell", "n") - F.col("n")
    near = cells.withColumn("before", before).filter(F.col("before") < H * F.col("whole"))
    near = near.groupBy("grp").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in names])
    n = F.col("n").cast("double")
    out = near.select(
        "grp",
        *[(F.col(f"s{i}").cast("double") / n / SCALE).alias(f"m{i}") for i in range(len(DIMS))],
        *[(F.col(f"p{i}_{j}").cast("double") / n / SCALE / SCALE).alias(f"p{i}_{j}") for i, j in PAIRS],
    )
    floors = list(FLOORS.values())
    for i, j in PAIRS:
        covariance = consistency() * (F.col(f"p{i}_{j}") - F.col(f"m{i}") * F.col(f"m{j}"))
        out = out.withColumn(f"p{i}_{j}", covariance + (floors[i] ** 2 if i == j else 0))
    for j in range(len(DIMS)):
        cut = F.col(f"p{j}_{j}")
        for k in range(j):
            cut = cut - F.col(f"l{j}_{k}") * F.col(f"l{j}_{k}") * F.col(f"d{k}")
        out = out.withColumn(f"d{j}", cut)
        for i in range(j + 1, len(DIMS)):
            cut = F.col(f"p{j}_{i}")
            for k in range(j):
                cut = cut - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") * F.col(f"d{k}")
            out = out.withColumn(f"l{i}_{j}", cut / F.col(f"d{j}"))
    return out.drop(*[f"p{i}_{j}" for i, j in PAIRS])


def judge(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, row_key, the counts, base_failed, d2, kept) for each row of ``docs``; ``doc`` holds the columns ``carry``."""
    stats = stage(vectors(text_statistics(docs, carry).withColumn("base_failed", failed_rules())), "quality")
    rows = stats.filter(~F.col("base_failed"))
    if carry:
        rows = rows.drop("doc")
    groups, uses = share_groups(rows)
    estimates = by_source(first_estimate(rows, groups), uses)
    before = mark(estimates)
    for _ in range(STEPS):
        estimates = by_source(concentrate(rows, estimates, groups), uses)
        now = mark(estimates)
        if now == before:
            break
        before = now
    judged = distances(stats, estimates, "left")
    near = F.coalesce(F.col("d2") <= chi2_quantile(CUTOFF, len(DIMS)), F.lit(True))
    return judged.withColumn("kept", ~F.col("base_failed") & near).select(
        "doc_id", *["doc"] * bool(carry), "row_key", *COUNTS, "base_failed", "d2", "kept"
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules and the method keep.

    Whole rows are stored beside their statistics, so texts are not shuffled to meet their verdicts.
    """
    return judge(docs, tuple(docs.columns)).filter("kept").select("doc.*")


def op8_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts, the fixed rules' and the method's verdict for every document."""
    return judge(read_table(spark, sf_dir, "documents")).drop("row_key")
