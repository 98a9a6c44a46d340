"""Toxicity by a weighted finite-state grammar over clauses.

A text is cut into clauses and a clause into words.  A first transducer, a trie
of word beginnings with weights, turns each word into a class: insult (with a
weight), threat, target, negation, reported speech or other.  Four small
transducers read the class row of a clause side by side, which is their
composition: the clause's state is the row of their states, and the weight of a
step is the product of their weights.  So an insult aimed at someone counts
more, a denied or reported one less, and a threat needs a target near by.  Only
clause weights enter a document's score, never words alone.

The trie's weights and the score's logistic curve are learned from labelled
rows, on a bounded sample whose bounds are parameters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnero.llm.common import stored

#: Labelled rows of each class that learning may use: toxic, clean.
SAMPLE = (4000, 8000)
#: Learned beginnings of words that are kept, and the lengths looked at.
UNITS, LENGTHS = 3000, (3, 4, 5, 6, 7, 8)
PREDICTED_FROM = 0.7
#: The curve without labels, towards which few labels are drawn: a few aimed insults in a short text are toxic.
PRIOR = np.array([-6.0, 2.0, 4.0, 0.0])

# Seed words of the classes.
INSULTS = ("idiot moron stupid loser scum trash pathetic worthless disgusting clown dumb fool imbecile vermin filth "
           "freak jerk coward parasite garbage degenerate").split()
THREATS = "kill hurt destroy beat shoot stab burn hang strangle punish attack".split()
TARGETS = "you your yours yourself u they them he she his her him these those people everyone du dich ihr tu te vous usted ustedes".split()
NEGATIONS = "not never no isn wasn aren don doesn didn without kein nicht nie pas jamais nunca jamás".split()
REPORTS = "said says wrote reported claimed quoted alleged called sagte dit dijo".split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
SEED_WEIGHT, THREAT_WEIGHT = 2.5, 2.0
CLAUSE = re.compile(r"[.!?;:\n|]+")
WORD = re.compile(r"[^\W\d_]+")


class Transducer:
    """A finite-state machine over classes: ``moves[state][class] = (next state, weight)``.

    A class without a move takes the state's default move.
    """

    def __init__(self, moves: list[dict[int, tuple[int, float]]], default: list[tuple[int, float]]):
        self.table = [[row.get(c, default[s]) for c in range(6)] for s, row in enumerate(moves)]


# After a negation the next three words are denied: an insult there counts three tenths.
DENIED = Transducer(
    [{NEGATION: (3, 1.0)},
     {NEGATION: (3, 1.0), INSULT: (0, 0.3), THREAT: (0, 0.3)},
     {NEGATION: (3, 1.0), INSULT: (1, 0.3), THREAT: (1, 0.3)},
     {NEGATION: (3, 1.0), INSULT: (2, 0.3), THREAT: (2, 0.3)}],
    [(0, 1.0), (0, 1.0), (1, 1.0), (2, 1.0)])
# After a verb of reporting the rest of the clause is somebody else's: six tenths.
REPORTED = Transducer([{REPORT: (1, 1.0)}, {INSULT: (1, 0.6), THREAT: (1, 0.6)}], [(0, 1.0), (1, 1.0)])
# An insult after a target in the same clause counts a quarter more.
AIMED = Transducer([{TARGET: (1, 1.0)}, {INSULT: (1, 1.25)}], [(0, 1.0), (1, 1.0)])
# A threat counts little until a target follows within four words or went before.
THREATENED = Transducer(
    [{THREAT: (2, 0.1), TARGET: (1, 1.0)}, {THREAT: (1, 1.0)}]
    + [{TARGET: (1, 10.0), THREAT: (2, 0.1)} for _ in range(4)],
    [(0, 1.0), (1, 1.0), (3, 1.0), (4, 1.0), (5, 1.0), (0, 1.0)])
GRAMMAR = (DENIED, REPORTED, AIMED, THREATENED)


def clause_weight(classes: list[int], weights: list[float]) -> float:
    """Weight of a clause under the composed grammar."""
    states, total, waiting = [0] * len(GRAMMAR), 0.0, 0.0
    for kind, weight in zip(classes, weights):
        factors = []
        for n, machine in enumerate(GRAMMAR):
            states[n], factor = machine.table[states[n]][kind]
            factors.append(factor)
        denied, reported, aimed, threatened = factors
        if kind == THREAT:
            now = weight * denied * reported * threatened
            total += now
            waiting = now if threatened < 1 else 0.0
        elif kind == TARGET and threatened > 1:
            total += waiting * (threatened - 1)
            waiting = 0.0
        elif kind == INSULT:
            total += weight * denied * reported * aimed
    return total


@dataclass
class Grammar:
    """The first transducer (a trie, kept as the set of its paths) and the classes of words."""

    units: dict[str, float] = field(default_factory=dict)
    classes: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for kind, words in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)):
            self.classes |= dict.fromkeys(words, kind)
        self.depth = max(map(len, self.units), default=0)
        self.known: dict[str, float] = {}

    def insult(self, word: str) -> float:
        """The largest weight on the word's path through the trie; 0 off the trie.

        A unit that ends in ``$`` is a whole word, any other the beginning of one.
        """
        best = self.units.get(word + "$", 0.0)
        for n in range(LENGTHS[0], min(len(word), self.depth) + 1):
            best = max(best, self.units.get(word[:n], 0.0))
        return best

    def features(self, text: str) -> tuple[float, float, float, float, float]:
        """Sum of the clause weights, number of matched clauses, largest clause, both per 100 words, log length."""
        low = text.lower()
        words = WORD.findall(low)
        distinct = set(words)
        known = self.known
        if len(known) > 400_000:
            known.clear()
        heavy = set()
        for word in distinct:
            weight = known.get(word)
            if weight is None:
                weight = known[word] = self.insult(word)
            if weight or self.classes.get(word) == THREAT:
                heavy.add(word)
        total = matched = largest = 0.0
        if heavy:
            for clause in CLAUSE.split(low):
                row = WORD.findall(clause)
                if heavy.isdisjoint(row):
                    continue
                weights = [known[w] for w in row]
                kinds = [self.classes.get(w, INSULT if x else OTHER) for w, x in zip(row, weights)]
                weight = clause_weight(kinds, [THREAT_WEIGHT if k == THREAT else x for k, x in zip(kinds, weights)])
                total += weight
                matched += weight > 0
                largest = max(largest, weight)
        n = len(words)
        return total, matched, largest, 100 * total / (n + 20), float(np.log1p(n))


def design(features: np.ndarray) -> np.ndarray:
    """Columns of the logistic curve from the raw features."""
    total, _, _, rate, size = features.T
    return np.column_stack((np.ones(len(features)), np.log1p(total), np.log1p(rate), size))


def fit_curve(features: np.ndarray, toxic: np.ndarray, weights: np.ndarray, rounds: int = 50, ridge: float = 0.5) -> np.ndarray:
    """Logistic regression by Newton steps, drawn towards PRIOR by ``ridge``."""
    x = design(features)
    beta = PRIOR.copy()
    penalty = np.diag([ridge / 4] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weights * (toxic - p)) - penalty @ (beta - PRIOR)
        hessian = (x * (weights * p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(hessian, gradient)
        size = np.abs(step).max()
        beta += step * min(1.0, 4.0 / max(size, 1e-9))
        if size < 1e-6:
            break
    return beta


def held_out(key: Column) -> Column:
    """Rows that learning never sees: crc32 of the key as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn_units(sample: DataFrame) -> dict[str, float]:
    """Weights of word beginnings and whole words: log ratio of their rates in toxic and clean texts, less its error.

    A word counts once in each text, so one text that repeats itself is no evidence.
    """
    words = (sample.select("toxic", F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("word")).where("word <> ''")
             .groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")))
    sums = words.agg(F.sum("t"), F.sum("c")).first()
    all_t, all_c = (sums[0] or 0) + 1, (sums[1] or 0) + 1
    starts = F.array(F.concat("word", F.lit("$")), *(F.when(F.length("word") >= n, F.substring("word", 1, n)) for n in LENGTHS))
    units = (words.select(F.explode(starts).alias("unit"), "t", "c").where("unit is not null")
             .groupBy("unit").agg(F.sum("t").alias("t"), F.sum("c").alias("c")).where("t >= 4"))
    weight = F.log((F.col("t") + 0.5) / all_t) - F.log((F.col("c") + 0.5) / all_c) - 2.5 / F.sqrt("t")
    best = (units.withColumn("w", weight).where("w > 1.5").orderBy((F.col("w") * F.sqrt("t")).desc(), "unit").limit(UNITS)
            .select("unit", "w").collect())  # at most UNITS rows
    learned = {r["unit"]: min(r["w"], 5.0) for r in best}
    return {f"{w}$": SEED_WEIGHT for w in INSULTS} | learned


@dataclass
class Model:
    """What learning gives: bounded in size whatever the corpus."""

    units: dict[str, float]
    beta: np.ndarray


def features_of(docs: DataFrame, units: dict[str, float], keep: list[str]) -> DataFrame:
    """``keep`` columns and the five features of ``text``; null texts count as empty."""
    kinds = dict(docs.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grammar = Grammar(units)
        for batch in batches:
            rows = np.array([grammar.features(t or "") for t in batch["text"]], float).reshape(-1, 5)
            out = {k: batch[k].array for k in keep}
            yield pd.DataFrame(out | {f"f{i}": rows[:, i] for i in range(5)})

    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keep) + ", f0 double, f1 double, f2 double, f3 double, f4 double"
    return docs.select(*keep, "text").mapInPandas(run, schema)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", sample: tuple[int, int] = SAMPLE) -> Model:
    """Learn from labelled rows outside the held-out third, at most ``sample`` of each class.

    The rows of a class with the smallest hash of their key are taken.  Word
    weights come from all of them; the curve is fitted to the features that the
    second half gets under weights learned from the first.
    """
    known = (labels.select(F.col(key).alias("_key"), F.col("toxic").cast("int").alias("toxic"))
             .where(F.col("_key").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("_key")))
             .groupBy("_key").agg(F.max("toxic").alias("toxic")).withColumn("_order", F.xxhash64("_key")))
    totals = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    taken = [known.where(F.col("toxic") == kind).orderBy("_order", "_key").limit(most) for kind, most in ((1, sample[0]), (0, sample[1]))]
    ids = F.broadcast(taken[0].unionByName(taken[1]))  # at most sum(sample) rows of three numbers
    rows = stored(docs.select(F.col(key).alias("key"), F.col("text").cast("string").alias("text"))
                  .join(ids, F.col("key") == F.col("_key")).select("key", "text", "toxic", (F.pmod("_order", F.lit(2)) == 0).alias("first"))
                  .where("text is not null").dropDuplicates(["key"]), "labelled")
    units = learn_units(rows)
    second = features_of(rows.where("not first"), learn_units(rows.where("first")), ["toxic"]).toPandas()  # at most sum(sample) rows of numbers
    toxic = second["toxic"].to_numpy(float)
    if len(second) == 0 or toxic.min() == toxic.max():
        return Model(units, PRIOR)
    share = {k: totals[k] / max(1, (toxic == k).sum()) for k in (0, 1)}
    weights = np.where(toxic == 1, share[1], share[0])
    return Model(units, fit_curve(second[[f"f{i}" for i in range(5)]].to_numpy(float), toxic, weights * len(toxic) / weights.sum()))


def score(docs: DataFrame, model: Model, keep: list[str], threshold: float = PREDICTED_FROM, prefix: str = "") -> DataFrame:
    """``keep`` columns, ``score`` (0 to 1), ``predicted`` (1 from ``threshold``), ``clause_weight``, ``clauses``, named with ``prefix``."""
    kinds = dict(docs.dtypes)
    units, beta = model.units, model.beta

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grammar = Grammar(units)
        for batch in batches:
            rows = np.array([grammar.features(t or "") for t in batch["text"]], float).reshape(-1, 5)
            value = 1 / (1 + np.exp(-np.clip(design(rows) @ beta, -30, 30)))
            yield pd.DataFrame({k: batch[k].array for k in keep} | {
                f"{prefix}score": value, f"{prefix}predicted": (value >= threshold).astype("int32"),
                f"{prefix}clause_weight": rows[:, 0], f"{prefix}clauses": rows[:, 1].astype("int64")})

    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keep) + "".join(
        f", {prefix}{c}" for c in ("score double", "predicted int", "clause_weight double", "clauses bigint"))
    columns = list(dict.fromkeys([*keep, "text"]))
    return docs.withColumn("text", F.col("text").cast("string")).select(*columns).mapInPandas(run, schema)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, clause_weight, clauses`` of every document.

    Null and empty texts match no clause and get the curve's value there; long
    texts are read whole; repeated rows give repeated rows; without usable
    labels the seed words and a fixed curve decide; an empty table gives no
    rows.  Label, language, source and id never enter a score.
    """
    rows = score(docs, train(docs, labels), ["doc_id"])
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "clause_weight", "clauses")


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns; null texts stay."""
    rows = score(docs, train(docs, labels), docs.columns, prefix="_toxicity_")
    return rows.where("_toxicity_predicted = 0").select(*docs.columns)
