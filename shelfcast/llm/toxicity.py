"""Toxicity: a linear classifier whose score is held still when identity terms are swapped.

Features are a text's words and their beginnings. On labelled texts a logistic regression is fitted; besides the
labels it is given pairs of sentences that differ only in an identity term ("she is Muslim", "she is Jewish"), and
the squared difference of their scores is added to the loss. So a group's mere mention earns no weight.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import MEMO_WORDS, over_texts
from shelfcast.llm.learning import labelled_sample

#: Labelled rows that are learnt from at most, and features with a weight of their own.
SAMPLE_ROWS, FEATURES = 20_000, 20_000
#: Sampled texts a feature must occur in.
LEAST_TEXTS = 5
BEGINNINGS = (4, 5, 6)
RIDGE, SWAP_PENALTY, STEPS = 1.0, 10.0, 300

#: Groups of terms that name people neutrally; a term is swapped for the others of its group.
IDENTITY_TERMS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "catholic", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "catholics", "atheists"),
    ("woman", "man", "girl", "boy", "person"),
    ("women", "men", "girls", "boys", "people"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("black", "white", "asian", "latino", "african", "european", "american", "arab"),
    ("old", "young", "blind", "deaf", "disabled"),
    ("immigrant", "refugee", "foreigner", "native", "citizen"),
)
WORDS = re.compile(r"[^\W\d_]+")
SENTENCE_END = re.compile(r"[.!?\n]+")


def word_features(word: str) -> list[str]:
    """A lower-case word and, marked, those of its beginnings that are shorter than it."""
    return [word, *(word[:n] + "-" for n in BEGINNINGS if len(word) > n)]


def text_features(text: str) -> set[str]:
    return {f for word in set(WORDS.findall(text.lower())) for f in word_features(word)}


def swaps(text: str, groups: tuple[tuple[str, ...], ...]) -> Iterator[tuple[str, str]]:
    """(term, other term) for every sentence with an identity term and every other term of its group."""
    others = {term: [x for x in group if x != term] for group in groups for term in group}
    for sentence in SENTENCE_END.split(text.lower()):
        for term in others.keys() & set(WORDS.findall(sentence)):
            for other in others[term]:
                yield term, other


@dataclass
class ToxicityModel:
    weights: dict[str, float]
    intercept: float
    memo: dict[str, list[str]] = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "intercept": self.intercept, "memo": {}}

    def score(self, text: str) -> float:
        memo, weights = self.memo, self.weights
        if len(memo) > MEMO_WORDS:
            memo.clear()
        found: set[str] = set()
        for word in set(WORDS.findall(text.lower())):
            known = memo.get(word)
            if known is None:
                known = memo[word] = [f for f in word_features(word) if f in weights]
            if known:
                found.update(known)
        z = self.intercept + sum(map(weights.__getitem__, sorted(found)))
        return 1 / (1 + float(np.exp(-max(-30.0, min(30.0, z)))))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 5,
    held: int = 0,
    groups: tuple[tuple[str, ...], ...] = IDENTITY_TERMS,
    penalty: float = SWAP_PENALTY,
    rows: int = SAMPLE_ROWS,
) -> ToxicityModel:
    """The model from at most ``rows`` labelled documents outside the held-out fold.

    Features are chosen and texts turned into feature numbers in tasks; the driver gets at most ``FEATURES``
    numbers for each sampled row. Without labels of both kinds, every text has the share of toxic labels as its score,
    a toxic one and three others added: without any label, nothing is called toxic.
    """
    sample = labelled_sample(docs, labels, "toxic", folds, held, rows).select("text", "label")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, clean = Counter(), Counter()
            for text, label in zip(*(batch.column(k).to_pylist() for k in range(2))):
                (toxic if label else clean).update(text_features(text or ""))
            names = list(toxic | clean)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string())]
                + [pa.array([c[n] for n in names], pa.int64()) for c in (toxic, clean)],
                ["feature", "toxic", "clean"],
            )

    sizes = sample.groupBy("label").count().collect()
    n = {0: 0, 1: 0} | {r["label"]: r["count"] for r in sizes}
    if not n[0] or not n[1]:
        return ToxicityModel({}, float(np.log((n[1] + 1) / (n[0] + 3))))
    rate = F.abs(F.col("toxic") / n[1] - F.col("clean") / n[0])
    spread = F.sqrt((F.col("toxic") + F.col("clean") + 1) / (n[0] + n[1]))
    chosen = (
        sample.mapInArrow(count, "feature string, toxic long, clean long")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("toxic") + F.col("clean") >= LEAST_TEXTS)
        .orderBy((rate / spread).desc(), "feature")
        .limit(FEATURES)
        .select("feature")
    )
    names = [r["feature"] for r in chosen.collect()]
    terms = {f for group in groups for term in group for f in word_features(term)}
    number = {name: k for k, name in enumerate(sorted({*names, *terms}))}
    shared = docs.sparkSession.sparkContext.broadcast((number, groups))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sets = shared.value
        for batch in batches:
            found, pairs = [], []
            for text in batch.column(0).to_pylist():
                found.append(sorted(known[f] for f in text_features(text or "") if f in known))
                pairs.append([f"{a} {b}" for a, b in swaps(text or "", sets)])
            pairs = [sorted(f"{p} {k}" for p, k in Counter(own).items()) for own in pairs]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(found, pa.list_(pa.int32())), pa.array(pairs, pa.list_(pa.string()))],
                ["label", "features", "swapped"],
            )

    table = sample.mapInArrow(vectors, "label int, features array<int>, swapped array<string>").toArrow()
    columns, owners = _flat(table.column("features").combine_chunks())
    pairs: Counter = Counter()
    for pair in table.column("swapped").combine_chunks().flatten().to_pylist():
        a, b, times = pair.split()
        pairs[a, b] += int(times)
    labelled = table.column("label").to_numpy().astype(float)
    weights, intercept = _descend(columns, owners, labelled, number, pairs, penalty)
    return ToxicityModel({name: float(weights[k]) for name, k in number.items() if abs(weights[k]) > 1e-4}, intercept)


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All list members, and the list that each belongs to."""
    sizes = np.diff(lists.offsets.to_numpy())
    return lists.flatten().to_numpy(), np.repeat(np.arange(len(lists), dtype=np.int32), sizes)


def _descend(
    columns: np.ndarray,
    owners: np.ndarray,
    labels: np.ndarray,
    number: dict[str, int],
    pairs: Counter,
    penalty: float,
) -> tuple[np.ndarray, float]:
    """Accelerated gradient steps on the mean loss, ridge and swap penalty; texts and features as index pairs."""
    texts, width = len(labels), len(number)
    balance = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
    changes = []
    total = sum(pairs.values()) or 1
    for (a, b), times in sorted(pairs.items()):
        changes.append(([number[f] for f in word_features(a)], [number[f] for f in word_features(b)], times / total))
    ridge = RIDGE / texts
    w, b = np.zeros(width), 0.0
    seen_w, seen_b, momentum = w, b, 1.0
    spread = np.bincount(owners, minlength=texts).max(initial=1)
    rate = 1.0 / (0.25 * np.sqrt(spread) + ridge + (4 * penalty if changes else 0) * len(BEGINNINGS))
    for _ in range(STEPS):
        z = np.bincount(owners, seen_w[columns], minlength=texts) + seen_b
        error = balance * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels)
        slope = np.bincount(columns, error[owners], minlength=width) + ridge * seen_w
        for old, new, share in changes:
            moved = seen_w[old].sum() - seen_w[new].sum()
            slope[old] += 2 * penalty * share * moved
            slope[new] -= 2 * penalty * share * moved
        next_w, next_b = seen_w - rate * slope, seen_b - rate * error.sum()
        grown = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        pull = (momentum - 1) / grown
        seen_w, seen_b = next_w + pull * (next_w - w), next_b + pull * (next_b - b)
        w, b, momentum = next_w, next_b, grown
    return w, float(b)


def scores(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, score`` (0 to 1, higher: toxic likelier) of every whole text.

    Null and empty texts score the intercept alone; repeated rows and null ids are kept as rows; an empty table gives
    no rows; only doc_id and text are read. The model has at most ``FEATURES`` weights and the identity terms'.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(ids: list, texts: list) -> Iterator[tuple]:
        for doc_id, text in zip(ids, texts):
            yield doc_id, shared.value.score(text)

    return over_texts(docs, rows, "doc_id long, score double")
