"""Stupid-backoff language-model scores, computed over the whole corpus.

Every text becomes its distinct word pairs with their counts. Words and pairs of the corpus are counted under 64-bit
hashes, all of them: the count table is partitioned by the hash, and no word or pair is left out for being rare.

    log S = sum of n * log(c(u, v) / c(u))           where the pair occurs elsewhere,
            n * log(ALPHA * (c(v) + 1) / (N + V))    otherwise.

A text's own occurrences are taken out of all counts, else every pair would be known. A caller may ask for a
vocabulary of the most frequent words, all others being one unknown word.

Texts travel as slices. A slice sends each of its distinct words and pairs once, with its count in the slice, to the
part of its hash, and gets the corpus counts back in the same order; so a word, a pair or a copied text that
very many texts hold has one entry per slice in the task that counts it. The number of parts follows the number
of entries.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import id_and_text, mixed, shuffle_tasks
from shelfcast.session import written

ALPHA = 0.4
#: Number of a text's start, and what stands for it and for words outside the vocabulary; no word has a blank.
START, START_WORD, UNKNOWN_WORD = 0, b"", b" "


#: Words that are counted together before the shuffle.
COUNTER_WORDS = 100_000


def words_of(text: str | None) -> list[bytes]:
    """Runs without ASCII white space; A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` over all whole texts, stored; counted per batch before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for k, text in enumerate(batch.column(0), 1):
                found.update(words_of(text.as_py()))
                if found and (len(found) > COUNTER_WORDS or k == batch.num_rows):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found, pa.binary()), pa.array(found.values(), pa.int64())], ["word", "n"]
                    )
                    found.clear()

    counted = docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return written(counted, "lm-words")


def most_frequent(counted: DataFrame, size: int) -> list[tuple[bytes, int]]:
    """The ``size`` most frequent words, ties by word, with their counts.

    A histogram over steps of frequency tells how low the last of them lies, so that only words above that are
    sent to be ordered, whatever the number of tasks.
    """
    step = F.floor(F.log2("n") * 32).cast("int").alias("step")
    lowest = counted.groupBy(step).count().withColumn("above", F.sum("count").over(Window.orderBy(F.desc("step"))))
    reached = lowest.where(F.col("above") >= size).agg(F.max("step")).first()[0]
    rows = counted if reached is None else counted.where(step >= reached)
    top = rows.orderBy(F.col("n").desc(), "word").limit(size).collect()
    return [(bytes(r["word"]), r["n"]) for r in top]


#: Texts of a slice, and pairs after which a slice is closed earlier.
SLICE_TEXTS, SLICE_PAIRS = 1_000, 200_000
#: Words and pairs of slices that one part of the count table is planned for.
PART_KEYS = 1_500_000
SLICES = "slice long, doc_ids array<long>, lengths array<long>, sizes array<long>, n_keys long, words binary, packed binary"
LONGS = pa.list_(pa.int64())


class Numbers(dict):
    """Numbers of a slice's words; those outside the vocabulary, if there is one, share a number."""

    def __init__(self, vocabulary: frozenset[bytes] | None) -> None:
        super().__init__()
        self.vocabulary, self.words = vocabulary, [START_WORD]

    def __missing__(self, word: bytes) -> int:
        if self.vocabulary is None or word == UNKNOWN_WORD or word in self.vocabulary:
            self[word] = len(self.words)
            self.words.append(word)
        else:
            self[word] = self[UNKNOWN_WORD]
        return self[word]


def pair_slices(docs: DataFrame, vocabulary: list[bytes] | None) -> DataFrame:
    """Each text's distinct pairs with their counts, stored once.

    A row is a slice of texts: ``slice, doc_ids, lengths``, the pairs of each text (``sizes``), the hashes of the slice's
    ``words`` by number and, ``packed`` over all its pairs, u, v (word numbers) and n. ``n_keys`` are its distinct
    words and pairs.
    """
    shared = docs.sparkSession.sparkContext.broadcast(None if vocabulary is None else frozenset(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, held, size, numbers = 0, [], 0, Numbers(shared.value)
            for k, text in enumerate(batch.column(2)):
                path = np.array([START, *map(numbers.__getitem__, words_of(text.as_py()))], np.int64)
                pairs, times = np.unique(path[:-1] << 32 | path[1:], return_counts=True)
                held.append((len(path) - 1, len(pairs), pairs, times))
                size += len(pairs)
                if len(held) == SLICE_TEXTS or size >= SLICE_PAIRS or k + 1 == batch.num_rows:
                    lengths, sizes, pairs, times = zip(*held)
                    pairs, times = np.concatenate(pairs), np.concatenate(times)
                    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in numbers.words], np.uint64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([batch.column(0)[first].as_py()]),
                            pa.array([batch.column(1)[first : k + 1].to_pylist()], LONGS),
                            pa.array([lengths], LONGS),
                            pa.array([sizes], LONGS),
                            pa.array([len(hashes) - 1 + len(np.unique(pairs))]),
                            pa.array([hashes.tobytes()], pa.binary()),
                            pa.array([packed([pairs >> 32, pairs & 0xFFFFFFFF, times])], pa.binary()),
                        ],
                        ["slice", "doc_ids", "lengths", "sizes", "n_keys", "words", "packed"],
                    )
                    first, held, size, numbers = k + 1, [], 0, Numbers(shared.value)
            pa.default_memory_pool().release_unused()

    rows = id_and_text(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return written(rows.mapInArrow(run, SLICES), "lm-pairs")


def packed(lists: list[np.ndarray]) -> bytes:
    """Lists of one length as bytes, equal places of the numbers side by side, compressed."""
    places = np.stack(lists).astype(np.int64).view(np.uint8).reshape(len(lists), -1, 8).transpose(0, 2, 1)
    return zstandard.compress(np.ascontiguousarray(places), 1)


def unpacked(raw: bytes, lists: int) -> list[np.ndarray]:
    places = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(lists, 8, -1)
    return list(np.ascontiguousarray(places.transpose(0, 2, 1)).view(np.int64)[:, :, 0])


class Slice:
    """The pairs of a slice, and its distinct words and pairs in the order in which they are sent to the parts."""

    def __init__(self, words: bytes, raw: bytes, parts: int) -> None:
        self.u, self.v, self.n = unpacked(raw, 3)
        hashes = np.frombuffer(words, np.uint64)
        self.n_words = len(hashes) - 1
        pairs, self.which = np.unique(self.u << 32 | self.v, return_inverse=True)
        with np.errstate(over="ignore"):
            pair_keys = mixed(mixed(hashes[pairs >> 32]) * np.uint64(0x9FB21C651E98DF25) + hashes[pairs & 0xFFFFFFFF])
        self.keys = np.concatenate((hashes[1:], pair_keys))
        part = (mixed(self.keys) % np.uint64(parts)).astype(np.int32)
        self.order = np.argsort(part, kind="stable")
        self.part = part[self.order]

    def times(self) -> np.ndarray:
        """How often each key occurs in the slice; every word of a text is the second of one pair."""
        of_words = np.bincount(self.v, self.n, self.n_words + 1)[1:]
        return np.concatenate((of_words, np.bincount(self.which, self.n))).astype(np.int64)

    def texts(self, sizes: list[int], counts: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
        """Sum of logs and number of words that back off of every text; ``counts`` are the keys' corpus counts."""
        of_words = np.concatenate(([texts], counts[: self.n_words]))
        others = counts[self.n_words :][self.which] - self.n
        hit = others > 0
        own_u, own_v = np.empty(len(self.n), np.int64), np.empty(len(self.n), np.int64)
        ends = np.cumsum(sizes)
        for a, b in zip(ends - sizes, ends):
            u, v = self.u[a:b], self.v[a:b]
            own = np.bincount(v, self.n[a:b])
            own[:1] = 1
            own_u[a:b], own_v[a:b] = own[u], own[v]
        logs = np.log(np.where(hit, others, ALPHA * (of_words[self.v] - own_v + 1)))
        logs -= np.log(np.where(hit, of_words[self.u] - own_u, 1))
        owner = np.repeat(np.arange(len(sizes)), sizes)
        misses = np.bincount(owner, np.where(hit, 0, self.n), len(sizes)).astype(np.int64)
        return np.bincount(owner, self.n * logs, len(sizes)), misses


def dealt(rows: DataFrame, parts: int) -> DataFrame:
    """``part, slice, n_words, keys, times``: a slice's distinct words, then pairs, of one part, a hash of the key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, words, raw in zip(*(c.to_pylist() for c in batch.columns)):
                own = Slice(words, raw, parts)
                keys, times = own.keys[own.order], own.times()[own.order]
                starts = np.flatnonzero(np.diff(own.part, prepend=-1))
                ends = np.append(starts[1:], len(keys))
                before = np.concatenate(([0], np.cumsum(own.order < own.n_words)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(own.part[starts]),
                        pa.array(np.full(len(starts), number, np.int64)),
                        pa.array(before[ends] - before[starts] if len(starts) else [], pa.int64()),
                        pa.array([keys[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                        pa.array([packed([times[a:b]]) for a, b in zip(starts, ends)], pa.binary()),
                    ],
                    ["part", "slice", "n_words", "keys", "times"],
                )

    found = rows.select("slice", "words", "packed")
    found = found.mapInArrow(run, "part int, slice long, n_words long, keys binary, times binary")
    return found.repartitionById(parts, "part")


def of_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corpus counts of the keys of every row, in their order; the first row has the number of the part's words."""
    held = [row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))]
    if not held:
        return
    keys = [np.frombuffer(raw, np.uint64) for *_, raw, _ in held]
    is_word = np.concatenate([np.arange(len(own)) < row[2] for own, row in zip(keys, held)])
    values, which = np.unique(np.concatenate(keys), return_inverse=True)
    times = np.concatenate([unpacked(raw, 1)[0] for *_, raw in held])
    counts = np.bincount(which, times, len(values)).astype(np.int64)[which]
    found, done, out = len(np.unique(which[is_word])), 0, []
    for k, (own, (part, number, *_)) in enumerate(zip(keys, held)):
        out.append((number, part, 0 if k else found, packed([counts[done : done + len(own)]])))
        done += len(own)
        if len(out) == 200 or done == len(counts):
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
            columns = [pa.array(c, kind) for c, kind in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["slice", "part", "n_distinct", "counts"])
            out = []


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Files of shuffles go with the query that needed them, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


SCORES = "doc_id long, n_words long, n_backoff long, logs double"


def scored(rows: DataFrame, counted: DataFrame, parts: int, texts: int) -> DataFrame:
    """Sums of every text. The rows of a slice come one after the other: its own first, then its counts by part."""

    def done(own: dict, counts: list[np.ndarray]) -> pa.RecordBatch:
        made = Slice(own["words"], own["packed"], parts)
        corpus = np.empty(len(made.keys), np.int64)
        corpus[made.order] = np.concatenate([*counts, np.empty(0, np.int64)])
        logs, misses = made.texts(own["sizes"], corpus, texts)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        columns = [pa.array(c, kind) for c, kind in zip((own["doc_ids"], own["lengths"], misses, logs), kinds)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_backoff", "logs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, counts = None, []
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if row["packed"] is not None:
                    if own:
                        yield done(own, counts)
                    own, counts = row, []
                else:
                    counts.append(unpacked(row["counts"], 1)[0])
        if own:
            yield done(own, counts)

    together = rows.drop("n_keys").unionByName(counted.drop("n_distinct"), allowMissingColumns=True)
    dealt_back = together.repartition(shuffle_tasks(rows.sparkSession), "slice").sortWithinPartitions("slice", "part")
    return dealt_back.mapInArrow(run, SCORES)


def scores(docs: DataFrame, vocabulary: int | None = None) -> DataFrame:
    """``doc_id, n_words, n_backoff, log_score, mean_log_score`` of every whole text, natural logarithms.

    Counts cover all words and pairs of all rows of ``docs``; with a ``vocabulary``, words below so many most frequent
    ones count as one unknown word. ``n_backoff`` words were scored by their own frequency. Null and empty texts
    have no words, a log score of 0 and a null mean. Repeated rows count as further texts; null ids are kept; an
    empty table gives no rows; other columns are not read.
    """
    if vocabulary is not None and vocabulary < 1:
        raise ValueError("the vocabulary must have a word or more")
    spark = docs.sparkSession
    top = None if vocabulary is None else [w for w, _ in most_frequent(word_counts(id_and_text(docs)), vocabulary)]
    rows = pair_slices(docs, top)
    sizes = [
        F.aggregate("lengths", F.lit(0).cast("long"), lambda total, x: total + (x > 0).cast("long")),
        F.aggregate("lengths", F.lit(0).cast("long"), lambda total, x: total + x),
        F.col("n_keys"),
    ]
    texts, total, number = rows.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in sizes)).first()
    parts = max(shuffle_tasks(spark), -(-number // PART_KEYS))
    schema = "slice long, part int, n_distinct long, counts binary"
    with freed_shuffles(spark):
        counted = written(dealt(rows, parts).mapInArrow(of_part, schema), "lm-counts")
    distinct = (counted.agg(F.sum("n_distinct")).first()[0] or 0) if top is None else len(top)
    score = F.col("logs") - F.col("n_backoff") * F.log((F.lit(total + distinct + 2) - F.col("n_words")).cast("double"))
    return scored(rows, counted, parts, texts).select(
        "doc_id",
        "n_words",
        "n_backoff",
        score.alias("log_score"),
        F.when(F.col("n_words") > 0, score / F.col("n_words")).alias("mean_log_score"),
    )
