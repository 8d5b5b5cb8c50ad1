"""Compression classifier for quality: two zstandard dictionaries, one of good and one of bad labelled text.

A text compresses better with the dictionary of its kind. The difference of the two compressed sizes, normalised
by their sum, is taken once over the whole text and once over its pieces of ``PIECE`` bytes, where repetition
within the text cannot help; with the compressed share of the text they become a score by a logistic
calibration on labelled rows that the dictionaries have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import over_texts
from shelfcast.llm.learning import fit_logistic, labelled_sample

#: Labelled rows that are learnt from at most: half for the dictionaries, half for the calibration.
SAMPLE_ROWS = 8_000
#: Pieces that one sampled text gives to a dictionary at most, spread over the whole text, and their bytes.
TEXT_PIECES, PIECE = 8, 500
DICTIONARY_BYTES = 110_000
LEVEL = 3


@dataclass
class Compressors:
    """The two dictionaries; compressors are made once per task."""

    good: bytes
    bad: bytes
    weights: list[float] = field(default_factory=list)

    @cached_property
    def _made(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        made = []
        for raw in (self.good, self.bad):
            data = zstandard.ZstdCompressionDict(raw)
            data.precompute_compress(level=LEVEL)
            made.append(
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False
                )
            )
        return tuple(made)

    def __getstate__(self) -> dict:
        return {"good": self.good, "bad": self.bad, "weights": self.weights}

    def features(self, text: str) -> list[float]:
        """Difference over the whole text, over its pieces, shares of the compressed sizes; zeros for an empty text."""
        raw = text.encode("utf-8", "surrogatepass")
        if not raw:
            return [0.0] * FEATURES
        good, bad = self._made
        whole = len(good.compress(raw)), len(bad.compress(raw))
        pieces = [raw[k : k + PIECE] for k in range(0, len(raw), PIECE)]
        parts = sum(len(good.compress(p)) for p in pieces), sum(len(bad.compress(p)) for p in pieces)
        share = min(parts) / len(raw)
        return [
            10 * (whole[1] - whole[0]) / (whole[0] + whole[1]),
            10 * (parts[1] - parts[0]) / (parts[0] + parts[1]),
            10 * share,
            10 * share * share,
            np.log(min(whole) / min(parts)),
        ]

    def score(self, text: str) -> float:
        z = float(np.dot(self.features(text), self.weights[:-1]) + self.weights[-1])
        return float(1 / (1 + np.exp(-max(-30.0, min(30.0, z)))))


FEATURES = 5


def fit(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2, rows: int = SAMPLE_ROWS) -> Compressors:
    """Dictionaries and calibration from at most ``rows`` labelled documents outside the held-out fold.

    Without texts of both kinds, every text has the share of good labels as its score, three good ones and a bad one
    added: without any label, nothing is rejected.
    """
    sample = labelled_sample(docs, labels, "quality", folds, held, rows)
    pieces = sample.where("half = 0").select("doc_id", "text", "label").mapInArrow(_pieces, "label int, pieces array<binary>")
    by_label: dict[int, list[bytes]] = {0: [], 1: []}
    for row in pieces.collect():
        by_label[row["label"]].extend(map(bytes, row["pieces"]))
    if not all(by_label.values()):
        good, number = sample.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count("*")).first()
        made = Compressors(b" " * 8, b" " * 8)
        made.weights = [0.0] * FEATURES + [float(np.log((good + 3) / (number - good + 1)))]
        return made
    made = Compressors(*(_dictionary(sorted(by_label[kind])) for kind in (1, 0)))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [made.features(t or "") for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(found, pa.list_(pa.float64()))], ["label", "features"]
            )

    measured = (
        sample.where("half = 1").select("text", "label").mapInArrow(measure, "label int, features array<double>").collect()
    )
    measured = sorted((r["label"], *r["features"]) for r in measured) or [(0, *[0.0] * FEATURES)]
    table = np.array(measured, float)
    made.weights = fit_logistic(table[:, 1:], table[:, 0], ridge=1e-2).tolist()
    return made


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text in batch.column(1).to_pylist():
            raw = (text or "").encode("utf-8", "surrogatepass")
            starts = range(0, len(raw), PIECE)
            chosen = starts if len(starts) <= TEXT_PIECES else [starts[len(starts) * k // TEXT_PIECES] for k in range(TEXT_PIECES)]
            out.append([raw[k : k + PIECE] for k in chosen])
        yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(out, pa.list_(pa.binary()))], ["label", "pieces"])


def _dictionary(pieces: list[bytes]) -> bytes:
    """Too little text for training serves as a dictionary itself."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICTIONARY_BYTES:].ljust(8, b" ")


def scores(docs: DataFrame, made: Compressors) -> DataFrame:
    """``doc_id, score`` (0 to 1, higher: good likelier) of every whole text.

    Null and empty texts have the score of zero differences; repeated rows and null ids are kept as rows; an empty
    table gives no rows; only doc_id and text are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(made)

    def rows(ids: list, texts: list) -> Iterator[tuple]:
        for doc_id, text in zip(ids, texts):
            yield doc_id, shared.value.score(text)

    return over_texts(docs, rows, "doc_id long, score double")


def accepted(docs: DataFrame, made: Compressors, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with all their columns, without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(made)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared.value.score
            yield batch.filter(pa.array([score(t or "") >= threshold for t in batch.column(place).to_pylist()]))

    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(run, docs.schema)
