"""Quality rules whose cutoffs carry a guarantee against false rejection.

Each rule measures a text and rejects it above a cutoff.  Labelled good rows
are the holdout: in a stratum (a language), k of n of them lie above a cutoff.
The cutoff may be used if the exact binomial test rules out a false rejection
rate of ``risk`` or more, P(Bin(n, risk) <= k) <= error, which is the
Clopper-Pearson bound.  The risk of all rules together is shared among them,
the error among all rules of all strata (Bonferroni).  A rule's cutoffs are
tested from the mildest on and the last before the first failure is taken
(fixed sequence), which costs no further correction.  Rules and strata without
enough labels reject nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnero.llm.common import stored

WINDOW = 8
#: False rejections of all rules together in a stratum, and the chance that any such promise fails.
RISK, ERROR = 0.05, 0.05
#: Strata that are told apart: those with the most labels; the others share one.
STRATA = 64
OTHERS = "(others)"
SPACE = "[\\x20\\x09-\\x0D]+"
#: Rule -> its cutoffs from the mildest to the strictest.
CUTOFFS = {
    "symbols": [x / 100 for x in range(60, 1, -2)],
    "repeats": [x / 100 for x in range(96, 9, -3)],
    "dup_lines": [x / 100 for x in range(96, 9, -3)],
    "shouting": [x / 100 for x in range(96, 9, -3)],
    "long_words": [x / 2 for x in range(60, 15, -1)],
    "short_text": [-float(x) for x in range(20, 61, 2)],
}
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measured(docs: DataFrame, keep: list[Column], text: str = "text") -> DataFrame:
    """The columns ``keep``, the base counts and the value of every rule; one pass, no shuffle."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(*keep, body.alias("_t")).withColumn("_w", F.filter(F.split("_t", SPACE), lambda w: w != ""))
    lines = F.filter(F.split("_t", "\n", -1), lambda x: F.regexp_like(x, F.lit("[^\\x20\\x09-\\x0D]")))
    rows = (rows.withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
            .withColumn("_lines", lines)
            .withColumn("n_words", F.size("_w").cast("bigint"))
            .withColumn("word_chars", F.aggregate("_w", F.lit(0).cast("bigint"), lambda n, w: n + F.length(w)))
            .withColumn("n_symbols", (F.size(F.split("_t", "[#*$%&|<>]", -1)) - 1).cast("bigint"))
            .withColumn("_shouts", F.size(F.filter("_w", lambda w: (w == F.upper(w)) & (w != F.lower(w))))))
    # Hashes of all windows; only texts in which one occurs twice sort theirs by (hash, place).
    windows = F.when(F.col("n_words") > WINDOW, F.transform(
        F.sequence(F.lit(1), F.size("_w") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("_h", i, WINDOW)))).otherwise(F.array().cast("array<bigint>"))
    rows = rows.withColumn("_win", windows).drop("_w", "_t", "_h")
    ordered = F.expr("CASE WHEN size(array_distinct(_win)) < size(_win) "
                     "THEN array_sort(transform(_win, (h, i) -> named_struct('h', h, 'i', i))) ELSE array() END")
    rows = rows.withColumn("_ordered", ordered).drop("_win")
    places = F.expr("array_sort(transform(filter(_ordered, (e, j) -> e.h = get(_ordered, j - 1).h OR e.h = get(_ordered, j + 1).h), e -> e.i))")
    rows = rows.withColumn("_places", places).drop("_ordered")
    # A repeated window covers the words up to the next one's beginning, eight at most.
    covered = F.expr(f"aggregate(transform(_places, (p, j) -> least({WINDOW}, coalesce(get(_places, j + 1) - p, {WINDOW}))), 0L, (n, x) -> n + x)")
    rows = (rows.withColumn("n_repeat_words", covered.cast("bigint"))
            .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint")))
    many = F.greatest(F.col("n_words"), F.lit(1))
    values = {
        "symbols": F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)),
        "repeats": F.col("n_repeat_words") / many,
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.size("_lines"), F.lit(1)),
        "shouting": F.col("_shouts") / many,
        "long_words": F.col("word_chars") / many,
        "short_text": -F.col("n_words").cast("double"),
    }
    names = [c for c in rows.columns if not c.startswith("_")]
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return rows.select(*names, failed.alias("base_failed"), *(v.cast("double").alias(f"r_{k}") for k, v in values.items()))


def binomial_tail(k: Column, n: Column, risk: float) -> Column:
    """log P(Bin(n, risk) <= k), summed term by term in logarithms; null where k is above its mean."""
    odds = F.lit(risk / (1 - risk))
    start = F.struct((n * F.log1p(F.lit(-risk))).alias("term"), (n * F.log1p(F.lit(-risk))).alias("sum"))

    def step(state: Column, i: Column) -> Column:
        term = state["term"] + F.log((n - i + 1) / i * odds)
        high = F.greatest(state["sum"], term)
        return F.struct(term.alias("term"), (high + F.log(F.exp(state["sum"] - high) + F.exp(term - high))).alias("sum"))

    terms = F.when(k > 0, F.sequence(F.lit(1).cast("bigint"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.when(k <= n * risk, F.aggregate(terms, start, step, lambda s: s["sum"]))


def cutoffs(holdout: DataFrame, risk: float = RISK, error: float = ERROR, rules: dict[str, list[float]] | None = None) -> DataFrame:
    """``(stratum, rule, cutoff, n, false_rejections)`` of every rule that may reject in a stratum.

    ``holdout`` holds the labelled good rows: ``stratum`` and a column ``r_<rule>`` each.
    """
    rules = rules or CUTOFFS
    # The number of cutoffs that a value lies above, per rule: a row stands above the last so many.
    above = [F.struct(F.lit(rule).alias("rule"), sum((F.when(F.col(f"r_{rule}") > c, 1).otherwise(0) for c in grid), F.lit(0)).alias("above"))
             for rule, grid in rules.items()]
    counts = (holdout.select("stratum", F.explode(F.array(*above)).alias("x")).groupBy("stratum", "x.rule", "x.above").count())
    totals = counts.groupBy("stratum", "rule").agg(
        F.sum("count").alias("n"), F.map_from_entries(F.collect_list(F.struct("above", "count"))).alias("by"))  # at most one entry a cutoff
    tests = F.array(*(F.struct(F.lit(rule).alias("rule"), F.array(*map(F.lit, grid)).alias("grid")) for rule, grid in rules.items()))
    grids = totals.sparkSession.range(1).select(F.explode(tests).alias("g")).select(F.col("g.rule").alias("of"), "g.grid")
    cells = totals.join(F.broadcast(grids), F.col("rule") == F.col("of"))  # one row a rule
    cells = cells.select("stratum", "rule", "n", "by", F.size("grid").alias("size"), F.posexplode("grid").alias("at", "cutoff"))
    # Cutoff number `at` is exceeded by rows that lie above more than size - at - 1 of them.
    k = F.aggregate(F.filter(F.map_entries("by"), lambda e: e["key"] >= F.col("size") - F.col("at")), F.lit(0).cast("bigint"), lambda s, e: s + e["value"])
    strata = holdout.select("stratum").distinct().agg(F.count(F.lit(1)).alias("strata"))
    cells = cells.withColumn("k", k).join(F.broadcast(strata))  # one row
    share = risk / len(rules)
    passed = binomial_tail(F.col("k"), F.col("n"), share) <= F.log(F.lit(error / len(rules)) / F.col("strata"))
    milder = Window.partitionBy("stratum", "rule").orderBy("at")  # the cutoffs of one rule
    tested = cells.withColumn("failed", F.sum(F.when(passed, 0).otherwise(1)).over(milder)).where("failed = 0")
    last = tested.groupBy("stratum", "rule").agg(F.max(F.struct("at", "cutoff", "n", "k")).alias("x"))
    return last.select("stratum", "rule", "x.cutoff", "x.n", F.col("x.k").alias("false_rejections"))


def judged(docs: DataFrame, labels: DataFrame, key: str = "doc_id", stratum: str = "lang",
           risk: float = RISK, error: float = ERROR) -> DataFrame:
    """``key``, the base counts, ``base_failed``, ``kept`` and ``rejected_by`` of every document.

    A text fails the base rule with under 20 words or with over 30 % of its
    words in repeated windows; failed texts are never kept.  Other texts are
    kept unless a rule with a guaranteed cutoff in their stratum rejects them.
    Null texts count as empty; a null stratum is a stratum; repeated rows and
    rows with null keys give rows of their own; without labels the base rule
    decides alone; an empty table gives no rows.
    """
    name = F.coalesce(F.col(stratum).cast("string"), F.lit("(none)"))
    rows = stored(measured(docs, [F.col(key).alias("key"), name.alias("stratum")]), "quality-counts")
    good = (labels.where(F.col("quality") == 1).select(F.col(key).alias("k")).where("k is not null").distinct()
            .join(labels.where(F.col("quality") == 0).select(F.col(key).alias("k")).distinct(), "k", "left_anti"))
    holdout = rows.where("not base_failed").join(good, F.col("key") == F.col("k"), "left_semi")
    holdout = stored(holdout.select("stratum", *(f"r_{r}" for r in CUTOFFS)), "quality-holdout")
    most = holdout.groupBy("stratum").count().orderBy(F.col("count").desc(), "stratum").limit(STRATA)
    own = F.broadcast(most.select(F.col("stratum").alias("own")))  # at most STRATA rows
    named = lambda frame: frame.join(own, F.col("stratum") == F.col("own"), "left").withColumn(
        "stratum", F.coalesce("own", F.lit(OTHERS))).drop("own")
    limits = cutoffs(named(holdout), risk, error).groupBy(F.col("stratum").alias("of")).agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("limits"))
    limits = F.broadcast(stored(limits, "quality-cutoffs"))  # at most STRATA + 1 rows
    marked = named(rows).join(limits, F.col("stratum") == F.col("of"), "left")
    hits = F.filter(F.array(*(F.when(F.col(f"r_{r}") > F.element_at(F.coalesce("limits", F.create_map().cast("map<string,double>")), r), F.lit(r)) for r in CUTOFFS)),
                    lambda x: x.isNotNull())
    return marked.withColumn("rejected_by", hits).select(
        F.col("key").alias(key), *BASE, "base_failed", (~F.col("base_failed") & (F.size("rejected_by") == 0)).alias("kept"), "rejected_by")
