"""Toxicity grades by cumulative-link ordinal regression.

A document's sparse features are its words and their five-letter pieces that the
labelled rows show to go with toxic text.  One weight vector is shared by all
ordered thresholds: P(grade <= j) = logistic(threshold_j - weights . features).
The expected severity is the sum over j of P(grade > j).

Labels say only whether a document is toxic.  Grades above 0 come from how much
of it is: the share of its words that bear a marker, a feature at least
``MARKER_LIFT`` times as common in toxic rows as in clean ones.

The model is fitted on a bounded sample of labelled rows and broadcast (its size
is bounded by ``max_features``); every document is scored over its whole text.
The sample takes as many rows of either class, so each row weighs in the fit as
many labels of its class as it stands for: probabilities are those of all labels.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneldeck.llm.text import bound_batches, fresh, whole
from paneldeck.session import write_stage

WORDS = regex.compile(r"\w+").findall
PIECE = 5
MARKER_LIFT = 20.0
GRADE_SHARES = (0.015, 0.03)  # marker share from which a toxic document has grade 2, 3


def word_features(word: str) -> set[str]:
    """The whole word and its pieces of five letters."""
    return {"=" + word, *(word[i:i + PIECE] for i in range(len(word) - PIECE + 1))}


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class WordMap(dict):
    """Word -> numbers of its model features; at most ``room`` words are kept."""

    def __init__(self, number: dict[str, int], room: int = 1 << 17):
        super().__init__()
        self.number, self.room = number, room

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= self.room:
            self.clear()
        found = tuple(sorted(self.number[f] for f in word_features(word) if f in self.number))
        if len(word) <= 64:
            self[word] = found
        return found


@dataclass
class Severity:
    """A fitted model; features 0 to n-1 are ``features``, the last is the share
    of marked words in per cent."""

    features: list[str]
    markers: set[int]
    weights: np.ndarray
    thresholds: np.ndarray
    words: WordMap = field(init=False)

    def __post_init__(self):
        self.words = WordMap({f: i for i, f in enumerate(self.features)})

    def __getstate__(self):
        return self.features, self.markers, self.weights, self.thresholds

    def __setstate__(self, state):
        self.features, self.markers, self.weights, self.thresholds = state
        self.__post_init__()

    def row(self, text: str) -> tuple[dict[int, float], float]:
        """Feature values of a text, and its share of marked words."""
        counts = Counter(WORDS(text.lower()))
        hits: Counter = Counter()
        marked = 0
        for word, n in counts.items():
            for f in (found := self.words[word]):
                hits[f] += n
            if found and not self.markers.isdisjoint(found):
                marked += n
        share = marked / max(1, sum(counts.values()))
        return {f: 1.0 + np.log(n) for f, n in hits.items()}, share

    def above(self, text: str) -> np.ndarray:
        """P(grade > j) for each threshold."""
        values, share = self.row(text)
        score = sum(self.weights[f] * v for f, v in values.items()) + self.weights[-1] * 100 * share
        return logistic(score - self.thresholds)


def fit_cumulative_link(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray,
                        n_columns: int, n_grades: int, rounds: int = 400, rate: float = 0.1,
                        ridge: float = 1e-3, stands_for: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by maximum likelihood (Adam on the whole
    sample, given as sparse triples).  ``stands_for``: how many rows each row
    counts as, 1 if not given."""
    n = len(grades)
    part = np.full(n, 1 / n) if stands_for is None else stands_for / stands_for.sum()
    params = np.zeros(n_columns + n_grades - 1)
    params[n_columns] = 1.0
    m, v = np.zeros_like(params), np.zeros_like(params)
    for t in range(1, rounds + 1):
        w, steps = params[:n_columns], params[n_columns:]
        cuts = np.concatenate([steps[:1], steps[0] + np.cumsum(np.exp(steps[1:]))])
        score = np.bincount(rows, values * w[columns], n)
        below = np.concatenate([np.zeros((n, 1)), logistic(cuts[None, :] - score[:, None]), np.ones((n, 1))], axis=1)
        slope = below * (1 - below)
        at = np.arange(n)
        p = np.maximum(below[at, grades + 1] - below[at, grades], 1e-12)
        to_score = (slope[at, grades + 1] - slope[at, grades]) / p * part
        to_cuts = np.zeros(n_grades + 1)
        np.add.at(to_cuts, grades + 1, -slope[at, grades + 1] / p * part)
        np.add.at(to_cuts, grades, slope[at, grades] / p * part)
        to_cuts = to_cuts[1:-1]
        later = np.cumsum(to_cuts[::-1])[::-1]
        gradient = np.concatenate([np.bincount(columns, values * to_score[rows], n_columns) + ridge * w,
                                   later[:1], later[1:] * np.exp(steps[1:])])
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        params -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    steps = params[n_columns:]
    return params[:n_columns], np.concatenate([steps[:1], steps[0] + np.cumsum(np.exp(steps[1:]))])


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int, id_col: str, text_col: str,
                    toxic_col: str) -> tuple[DataFrame, dict[int, float]]:
    """(sample, rates): text, toxic of at most ``max_rows`` labelled documents, half
    of them of either class where there are enough, the same ones on every run,
    each with one text (that of the least hash, if rows repeat its id); and the
    share of all labels of each class that was drawn."""
    known = labels.where(F.col(toxic_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("label_id"), (F.col(toxic_col) > 0).cast("int").alias("toxic"))
    known = write_stage(known.groupBy("label_id").agg(F.max("toxic").alias("toxic")), "toxic-labels")
    of_class = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    rates = {c: min(1.0, max_rows // 2 / n) for c, n in of_class.items()}
    order = F.xxhash64(F.lit("sample"), "label_id"), F.col("label_id")
    half = [known.where(F.col("toxic") == c).orderBy(*order).limit(max_rows // 2) for c in (0, 1)]
    picked = write_stage(half[0].unionByName(half[1]), "toxic-sample")  # max_rows rows at most
    found = (docs.select(F.col(id_col).alias("doc"), whole(text_col).alias("text"))
             .join(F.broadcast(picked), F.col("doc") == F.col("label_id"))
             .groupBy("label_id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")))
    return write_stage(found.select("least.text", "toxic").repartition(F.xxhash64("text")), "toxic-texts"), rates


def fit_severity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 toxic_col: str = "toxic", max_rows: int = 10_000, max_features: int = 4_096,
                 min_docs: int = 3) -> Severity | None:
    """Fit on at most ``max_rows`` labelled rows and ``max_features`` features;
    None if the labels don't hold both classes."""
    sample, rates = labelled_sample(docs, labels, max_rows, id_col, text_col, toxic_col)
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return None

    def count_features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 200):
                counts: dict[str, list[int]] = {}
                for text, toxic in zip(batch["text"][at:at + 200], batch["toxic"][at:at + 200]):
                    for f in set().union(*map(word_features, set(WORDS(text.lower())))):
                        counts.setdefault(f, [0, 0])[toxic] += 1
                yield pd.DataFrame([(f, c, t) for f, (c, t) in counts.items()], columns=["feature", "clean", "toxic"])

    share_clean = (F.col("clean") + 0.5) / F.lit(sizes[0] + 1.0)
    share_toxic = (F.col("toxic") + 0.5) / F.lit(sizes[1] + 1.0)
    lift = share_toxic / share_clean
    counted = (sample.mapInPandas(count_features, "feature string, clean long, toxic long")
               .groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
               .where((F.col("toxic") >= min_docs) & (lift > 2))
               .select("feature", lift.alias("lift"), (F.log(lift) * F.sqrt("toxic")).alias("gain"))
               .orderBy(F.desc("gain"), "feature").limit(max_features).collect())
    model = Severity([r["feature"] for r in counted], {i for i, r in enumerate(counted) if r["lift"] >= MARKER_LIFT},
                     np.zeros(len(counted) + 1), np.zeros(3))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def sparse_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [sent.value.row(text) for text in batch["text"]]
            yield pd.DataFrame({"toxic": batch["toxic"], "share": [share for _, share in made],
                                "at": [list(values) for values, _ in made],
                                "value": [list(values.values()) for values, _ in made]})

    # at most max_rows rows of the few model features that a document has
    rows = sample.mapInPandas(sparse_rows, "toxic int, share double, at array<int>, value array<double>").collect()
    rows.sort(key=lambda r: (r["toxic"], r["share"], r["at"]))
    shares = np.array([r["share"] for r in rows])
    grades = np.array([r["toxic"] * (1 + sum(r["share"] >= s for s in GRADE_SHARES)) for r in rows])
    at = np.concatenate([np.repeat(np.arange(len(rows)), [len(r["at"]) for r in rows]), np.arange(len(rows))])
    columns = np.concatenate([np.array([c for r in rows for c in r["at"]], dtype=int),
                              np.full(len(rows), len(counted))])
    values = np.concatenate([np.array([x for r in rows for x in r["value"]], dtype=float), 100 * shares])
    stands_for = np.array([1 / rates[r["toxic"]] for r in rows])
    model.weights, model.thresholds = fit_cumulative_link(at, columns, values, grades, len(counted) + 1, 4,
                                                          stands_for=stands_for)
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   toxic_col: str = "toxic", reject: float = 0.5, model: Severity | None = None,
                   labelled: DataFrame | None = None, **fit) -> DataFrame:
    """``docs`` plus severity (expected grade, 0 to 3), grade (the likeliest) and
    toxic (P(grade > 0) of ``reject`` or more).

    ``labelled``: the documents that the labels speak of, ``docs`` itself if not
    given.  Without labelled rows of both classes nothing is called toxic.
    Null or empty text has no features and is scored as such.  Repeated rows and
    null ids are scored like any.  An empty table gives an empty result.  Columns
    of ``docs`` named severity, grade or toxic are replaced.
    """
    bound_batches(docs.sparkSession)
    model = model or fit_severity(docs if labelled is None else labelled, labels, id_col, text_col, toxic_col, **fit)
    rest = docs.drop("severity", "grade", "toxic")
    if model is None:
        return rest.select("*", F.lit(0.0).alias("severity"), F.lit(0).alias("grade"), F.lit(False).alias("toxic"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<double>")
    def above(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([sent.value.above(text) for text in batch])

    name, = fresh(rest, "_above")
    p = F.col(name)
    least = F.array_position(F.transform(F.concat(F.array(F.lit(1.0)), p), lambda x: x >= 0.5), False)
    grade = F.when(least == 0, 3).otherwise(least - 2)
    return (rest.withColumn(name, above(whole(text_col)))
            .select(*rest.columns, F.aggregate(p, F.lit(0.0), lambda a, x: a + x).alias("severity"),
                    grade.cast("int").alias("grade"), (F.get(p, F.lit(0)) >= reject).alias("toxic")))
