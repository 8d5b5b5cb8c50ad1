"""Exact deduplication with a cuckoo-filter index over content digests.

The index holds the live digests in hash shards. A shard keeps two-choice buckets of four slots; a slot
has a 16-bit fingerprint and points at the stored key (the full SHA-256 of the text) of its entry. A lookup
compares fingerprints only; a hit is verified against the stored key in that bucket, so a false positive
never merges two texts. An entry can be deleted: its slot is emptied and the key forgotten. When no slot
can be freed by moving entries, the buckets are doubled and filled again from the stored keys.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import free_name, id_and_text, shuffle_tasks
from shelfcast.session import written

SLOTS = 4
MAX_MOVES = 200
#: Keys that one shard is planned for: about 100 MB of a task's memory.
SHARD_KEYS = 400_000

ADD, LIVE, REMOVE = 2, 0, 1


class CuckooIndex:
    """Keys are byte strings of at least 12 uniformly distributed bytes, such as digests."""

    def __init__(self, buckets: int = 1024, fingerprint_bits: int = 16) -> None:
        if buckets & (buckets - 1):
            raise ValueError("the number of buckets must be a power of two")
        self.mask = buckets - 1
        self.fingerprint_mask = (1 << fingerprint_bits) - 1
        self.fingerprints = [0] * (buckets * SLOTS)
        self.entries: list[int] = [-1] * (buckets * SLOTS)
        self.keys: list[bytes | None] = []
        self.values: list[tuple | None] = []
        self.live = 0
        self.false_hits = 0
        self.resizes = 0

    def _fingerprint(self, key: bytes) -> int:
        return int.from_bytes(key[8:12], "little") & self.fingerprint_mask or 1

    def _home(self, key: bytes) -> int:
        return int.from_bytes(key[:8], "little") & self.mask

    def _other(self, bucket: int, fingerprint: int) -> int:
        return (bucket ^ (fingerprint * 0x5BD1E995 + 1)) & self.mask

    def _slot(self, key: bytes) -> int:
        fingerprint, bucket = self._fingerprint(key), self._home(key)
        for b in (bucket, self._other(bucket, fingerprint)):
            for slot in range(b * SLOTS, b * SLOTS + SLOTS):
                if self.fingerprints[slot] == fingerprint:
                    if self.keys[self.entries[slot]] == key:
                        return slot
                    self.false_hits += 1
        return -1

    def get(self, key: bytes) -> tuple | None:
        slot = self._slot(key)
        return None if slot < 0 else self.values[self.entries[slot]]

    def put(self, key: bytes, value: tuple) -> None:
        """Insert a key or replace the value of a live one."""
        slot = self._slot(key)
        if slot >= 0:
            self.values[self.entries[slot]] = value
            return
        self.keys.append(key)
        self.values.append(value)
        self.live += 1
        if not self._place(key, len(self.keys) - 1):
            self._resize()

    def delete(self, key: bytes) -> bool:
        slot = self._slot(key)
        if slot < 0:
            return False
        entry = self.entries[slot]
        self.fingerprints[slot], self.entries[slot] = 0, -1
        self.keys[entry] = self.values[entry] = None
        self.live -= 1
        return True

    def _place(self, key: bytes, entry: int) -> bool:
        fingerprint, bucket = self._fingerprint(key), self._home(key)
        prints, entries = self.fingerprints, self.entries
        for move in range(MAX_MOVES):
            for b in (bucket, self._other(bucket, fingerprint)):
                for slot in range(b * SLOTS, b * SLOTS + SLOTS):
                    if not prints[slot]:
                        prints[slot], entries[slot] = fingerprint, entry
                        return True
            bucket = self._other(bucket, fingerprint)
            slot = bucket * SLOTS + move % SLOTS
            prints[slot], fingerprint = fingerprint, prints[slot]
            entries[slot], entry = entry, entries[slot]
        return False

    def _resize(self) -> None:
        """Twice the buckets until every stored key has a slot; deleted keys are dropped on the way."""
        pairs = [(k, v) for k, v in zip(self.keys, self.values) if k is not None]
        self.keys, self.values = [k for k, _ in pairs], [v for _, v in pairs]
        while True:
            self.resizes += 1
            buckets = 2 * (self.mask + 1)
            self.mask = buckets - 1
            self.fingerprints, self.entries = [0] * (buckets * SLOTS), [-1] * (buckets * SLOTS)
            if all(self._place(key, entry) for entry, key in enumerate(self.keys)):
                return

    def items(self) -> Iterator[tuple[bytes, tuple]]:
        return ((k, v) for k, v in zip(self.keys, self.values) if k is not None)


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``row, doc_id, digest`` of every row, stored once; ``row`` tells repeated rows apart."""
    rows = id_and_text(docs).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", digest(F.col("text")).alias("digest")
    )
    return written(rows, "fingerprints")


def combined(rows: DataFrame) -> DataFrame:
    """At most one row per digest and Arrow batch: the latest id and the number of rows.

    It keeps a text with very many copies from travelling to its shard once per copy.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[bytes, tuple] = {}
            for row, doc_id, key in zip(*(batch.column(k).to_pylist() for k in range(3))):
                held[key] = merged(held.get(key), (doc_id, row, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(held, pa.binary())]
                + [pa.array([v[k] for v in held.values()], pa.int64()) for k in range(3)],
                ["digest", "keep_id", "keep_row", "copies"],
            )

    return rows.select("row", "doc_id", "digest").mapInArrow(run, LIVE_SCHEMA)


LIVE_SCHEMA = "digest binary, keep_id long, keep_row long, copies long"


def merged(old: tuple | None, new: tuple) -> tuple:
    """The later of two (id, row, copies); a missing id is earlier than any, equal ids go by row."""
    if old is None:
        return new
    latest = max(old, new, key=lambda v: (v[0] is not None, v[0] or 0, v[1]))
    return latest[0], latest[1], old[2] + new[2]


def update(live: DataFrame | None, added: DataFrame | None, removed: DataFrame | None, keys: int) -> DataFrame:
    """The live digests after deleting ``removed`` (column digest) and inserting ``added``.

    ``live`` and the result have the columns of ``combined``. ``keys`` is the number of keys to plan for: every
    shard gets about ``SHARD_KEYS`` at most, so a task's memory does not grow with the data.
    """
    parts = []
    if live is not None:
        parts.append(live.select(F.lit(LIVE).alias("what"), "digest", "keep_id", "keep_row", "copies"))
    if removed is not None:
        none = F.lit(None).cast("long")
        parts.append(removed.select(F.lit(REMOVE).alias("what"), "digest", *(none.alias(c) for c in LIVE_COLUMNS)))
    if added is not None:
        parts.append(added.select(F.lit(ADD).alias("what"), "digest", "keep_id", "keep_row", "copies"))
    changes = parts[0]
    for part in parts[1:]:
        changes = changes.unionByName(part)
    shards = max(shuffle_tasks(changes.sparkSession), math.ceil(keys / SHARD_KEYS))
    return changes.repartition(shards, "digest").sortWithinPartitions("what").mapInArrow(_shard, LIVE_SCHEMA)


LIVE_COLUMNS = ("keep_id", "keep_row", "copies")


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = CuckooIndex()
    for batch in batches:
        for what, key, *value in zip(*(batch.column(k).to_pylist() for k in range(5))):
            if what == REMOVE:
                index.delete(key)
            else:
                index.put(key, merged(index.get(key), tuple(value)))
    held: list[tuple] = []
    for key, value in index.items():
        held.append((key, *value))
        if len(held) == 10_000:
            yield _as_batch(held)
            held = []
    if held:
        yield _as_batch(held)


def _as_batch(held: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*held), kinds)], ["digest", "keep_id", "keep_row", "copies"]
    )


def build(rows: DataFrame) -> DataFrame:
    """The live digests of ``fingerprints``'s rows."""
    return update(None, combined(rows), None, rows.count())


def decisions(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, digest`` for every row of ``docs``.

    Texts are equal when identical; null counts as empty. The row with the largest id stays; a missing id is
    smaller than any, and of rows that share id and text exactly one stays. Empty tables give no rows; other
    columns are not read. The last join is on the digest of narrow rows; a text with very many copies makes
    a skewed key there, which adaptive execution splits.
    """
    rows = fingerprints(docs)
    live = build(rows).withColumnRenamed("digest", "live_digest")
    return rows.join(live, F.col("digest") == F.col("live_digest")).select(
        "doc_id",
        "keep_id",
        F.col("copies").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"),
        "digest",
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    key, name = free_name(docs, "digest"), free_name(docs, "id_text")
    live = build(fingerprints(docs)).select(
        F.col("digest").alias(key), F.coalesce(F.col("keep_id").cast("string"), F.lit("")).alias(name)
    )
    keyed = docs.withColumns(
        {
            key: digest(F.col("text").cast("string")),
            name: F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")),
        }
    )
    return keyed.join(live, [key, name], "left_semi").dropDuplicates([key, name]).select(*docs.columns)
