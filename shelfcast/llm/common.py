"""Helpers shared by the operators: reading tables, word hashes, Arrow passes over texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, for the functions of Spark: the ASCII white space separates, everything else belongs to words.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

#: Entries that a per-task memo of words may hold before it is emptied.
MEMO_WORDS = 400_000

#: Rows an output batch holds at most, and bytes after which it is handed over.
BATCH_ROWS = 2_000
BATCH_BYTES = 8_000_000

Rows = Callable[[list, list], Iterator[tuple]]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only the two columns the operators read; any others, however named, stay out of their way."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a missing id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(folds)


def over_texts(docs: DataFrame, rows: Rows, schema: str, weigh: Callable[[tuple], int] | None = None) -> DataFrame:
    """``rows(ids, texts)`` over Arrow batches; missing texts arrive as empty ones.

    Output is handed over in small batches, so a task holds one input batch and a few megabytes of
    results however long the texts are. ``weigh`` estimates the bytes of a result row.
    """
    names, kinds = zip(*((name, ARROW[kind]) for name, kind in map(str.split, schema.split(", "))))

    def as_batch(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*held), kinds)], names=list(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for row in rows(batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]):
                held.append(row)
                size += weigh(row) if weigh else 64
                if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
                    yield as_batch(held)
                    held, size = [], 0
            if held:
                yield as_batch(held)

    return id_and_text(docs).mapInArrow(run, schema)


ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()),
    "array<long>": pa.list_(pa.int64()),
    "array<double>": pa.list_(pa.float64()),
}


class WordHashes:
    """64-bit hashes of byte words, with a bounded memo."""

    def __init__(self) -> None:
        self.memo: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        memo = self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        for word in set(words).difference(memo):
            memo[word] = xxhash.xxh3_64_intdigest(word)
        return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Every input bit spread over all output bits (multiply and shift rounds)."""
    with np.errstate(over="ignore"):
        values = values ^ (values >> np.uint64(31))
        values = values * np.uint64(0x9E3779B97F4A7C15)
        values = values ^ (values >> np.uint64(29))
        values = values * np.uint64(0xBF58476D1CE4E5B9)
        return values ^ (values >> np.uint64(32))


def shingle_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """The sorted distinct hashes of all runs of ``n`` words; a shorter text is one run of all its words."""
    if not len(hashes):
        return hashes
    runs = max(1, len(hashes) - n + 1)
    out = np.full(runs, min(n, len(hashes)), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(n, len(hashes))):
            out = mixed(out * np.uint64(0x9FB21C651E98DF25) + hashes[k : k + runs])
    return np.unique(out)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, in any letter case."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
