"""SimHash near-duplicates with an inverted index of the fingerprints' bytes.

A text's fingerprint has 64 bits; a bit is 1 if more than half of its shingles' hashes have it. Texts link when their
fingerprints differ in at most three bits, so linked fingerprints agree in at least five of their eight bytes
(a byte at a place counts only as the same byte at that place).

1. Equal fingerprints are one entry from here on, however many texts have them.
2. Posting lists. Five agreeing places hold three of one half, so the lists are kept for the eight triples of places
   within a half: (triple, their bytes) -> fingerprints. Lists of one entry are dropped.
3. Count filter. Within a list the agreeing places of every pair are tallied from the lists of its single places, pairs
   that reach five are verified by their bits. A list emits its groups as links to one member, never its pairs.
4. A list of more than ``LIST`` fingerprints is dealt on to the lists of five places that contain its triple. There the
   count is reached by construction, and only 24 bits are free: neighbours are looked up by flipping up to three of
   them, which is linear in the list, whose size those bits bound.
5. Links are joined to components over the whole table.

No list is cut: both ways are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import over_texts, shuffle_tasks
from shelfcast.llm.components import components
from shelfcast.session import written

SEED = 42
DISTANCE = 3
PLACES = 8
SHARED = PLACES - DISTANCE
#: Fingerprints of a list whose pairs are tallied in one table; longer lists are dealt on.
LIST = 1024
#: Shingles whose bits are counted at once.
PIECE = 1 << 16

TRIPLES = [c for half in ((0, 1, 2, 3), (4, 5, 6, 7)) for c in combinations(half, 3)]
FIVES = list(combinations(range(PLACES), SHARED))
FREE_BITS = 8 * (PLACES - SHARED)
FLIPS = np.array([sum(1 << b for b in c) for k in (1, 2, 3) for c in combinations(range(FREE_BITS), k)], np.int32)


def fingerprint(text: str, n: int = 3) -> int:
    """Lower-cases A-Z, splits at ASCII white space; a text of fewer than ``n`` words is one shingle, of none zero."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    runs = max(1, len(words) - n + 1)
    first, last = starts[:runs].tolist(), ends[min(n, len(words)) - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, runs, PIECE):
        some = zip(first[at : at + PIECE], last[at : at + PIECE])
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in some), np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > runs, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, n: int = 3) -> DataFrame:
    """``doc_id, fingerprint`` (the 64 bits as a long) for every row; missing texts count as empty."""

    def rows(ids: list, texts: list) -> Iterator[tuple]:
        for doc_id, text in zip(ids, texts):
            bits = fingerprint(text, n)
            yield doc_id, bits - (1 << 64) if bits >> 63 else bits

    return over_texts(docs, rows, "doc_id long, fingerprint long")


def _mask(places: tuple[int, ...]) -> int:
    bits = sum(0xFF << 8 * p for p in places)
    return bits - (1 << 64) if bits >> 63 else bits


def _postings(values: DataFrame, subsets: list[tuple[int, ...]], only: dict[int, list[int]] | None = None) -> DataFrame:
    """``list, bytes, fingerprint``: an entry for each subset of places; ``only`` maps a row's ``list`` to subsets."""
    own = F.col("fingerprint")
    entry = [
        F.struct(F.lit(k).alias("list"), own.bitwiseAND(F.lit(_mask(s))).alias("bytes")) for k, s in enumerate(subsets)
    ]
    if only is None:
        made = F.array(*entry)
    else:
        made = F.element_at(F.array(*(F.array(*(entry[k] for k in only[t])) for t in sorted(only))), F.col("list") + 1)
    rows = values.select("fingerprint", F.explode(made).alias("e")).select("e.*", "fingerprint")
    return rows if only is None else rows.distinct()


def links(values: DataFrame) -> DataFrame:
    """``a, b``: fingerprints of ``values`` (``fingerprint``, distinct) joined directly or through other links.

    Every two fingerprints within three bits are joined by these links or a chain of them.
    """
    entries = _postings(values, TRIPLES)
    sizes = written(entries.groupBy("list", "bytes").agg(F.count("*").alias("m")).where("m > 1"), "simhash-lists")
    shared = entries.join(sizes, ["list", "bytes"])
    deeper = {k: [i for i, five in enumerate(FIVES) if set(triple) <= set(five)] for k, triple in enumerate(TRIPLES)}
    few = shared.where(F.col("m") <= LIST).drop("m")
    many = _postings(shared.where(F.col("m") > LIST), FIVES, deeper)
    again = many.groupBy("list", "bytes").agg(F.count("*").alias("m")).where("m > 1").drop("m")
    return _per_list(few, tallied).unionByName(_per_list(many.join(again, ["list", "bytes"]), flipped))


def _per_list(entries: DataFrame, grouped: Callable[[np.ndarray, int], np.ndarray]) -> DataFrame:
    """``a, b``: every member of a list with the first of its group, as ``grouped(members, list)`` numbers them."""
    tasks = shuffle_tasks(entries.sparkSession)
    rows = entries.repartition(tasks, "list", "bytes").sortWithinPartitions("list", "bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def linked() -> Iterator[pa.RecordBatch]:
            members = np.concatenate(held) if held else np.empty(0, np.uint64)
            if len(members) > 1:
                first = grouped(members, at[0])
                own = first != np.arange(len(first))
                if own.any():
                    columns = (members[first[own]].view(np.int64), members[own].view(np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

        for batch in batches:
            which, key, value = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            cuts = np.flatnonzero((which[1:] != which[:-1]) | (key[1:] != key[:-1])) + 1
            bounds = [0, *cuts.tolist(), len(value)]
            for a, b in zip(bounds, bounds[1:]):
                place = (int(which[a]), int(key[a]))
                if place != at:
                    yield from linked()
                    at, held = place, []
                held.append(value[a:b].astype(np.int64).view(np.uint64))
        yield from linked()

    return rows.select("list", "bytes", "fingerprint").mapInArrow(run, "a long, b long")


def tallied(members: np.ndarray, triple: int) -> np.ndarray:
    """The first member of each one's group: pairs by the tally of agreeing places, then by their bits."""
    size = len(members)
    tally = np.full((size, size), len(TRIPLES[triple]), np.uint8)
    signs = members.view(np.uint8).reshape(size, PLACES)
    for place in set(range(PLACES)) - set(TRIPLES[triple]):
        order = np.argsort(signs[:, place], kind="stable")
        for posting in np.split(order, np.flatnonzero(np.diff(signs[order, place])) + 1):
            if len(posting) > 1:
                tally[np.ix_(posting, posting)] += 1
    x, y = np.nonzero(tally >= SHARED)
    near = np.bitwise_count(members[x] ^ members[y]) <= DISTANCE
    return _grouped(size, x[near], y[near])


def _grouped(size: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Smallest number that each one reaches over the pairs (both directions given)."""
    label = np.arange(size)
    while True:
        now = label.copy()
        np.minimum.at(now, x, label[y])
        now = now[now]
        if (now == label).all():
            return label
        label = now


def flipped(members: np.ndarray, five: int) -> np.ndarray:
    """As ``tallied`` where five places agree: neighbours are looked up by the 24 bits that are left."""
    signs = members.view(np.uint8).reshape(len(members), PLACES)
    free = sorted(set(range(PLACES)) - set(FIVES[five]))
    bits = sum(signs[:, p].astype(np.int32) << 8 * k for k, p in enumerate(free))
    where = np.full(1 << FREE_BITS, -1, np.int32)
    where[bits] = np.arange(len(bits), dtype=np.int32)
    label = np.arange(len(bits))
    while True:
        now = label.copy()
        for flip in FLIPS:
            other = where[bits ^ flip]
            own = np.flatnonzero(other >= 0)
            now[own] = np.minimum(now[own], now[other[own]])
        now = now[now]
        if (now == label).all():
            return label
        label = now


def classes(docs: DataFrame, n: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs`` (doc_id, text).

    ``fingerprint`` has 16 hex digits; ``component_id`` is the smallest id that links reach. Null and empty texts have
    fingerprint zero and link like any other, as do equal texts and repeated rows, which share a fingerprint. Texts of
    any length are read whole, their shingles counted in pieces. A null id is returned as it is; a component has
    a null id only if all its ids are null. No rows give no rows. Other columns are not read.
    """
    found = written(fingerprints(docs, n), "simhash-fingerprints")
    values = written(found.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "simhash-values")
    roots = components(links(values.select("fingerprint"))).withColumnRenamed("node", "fingerprint")
    joined = values.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    lowest = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    named = joined.join(lowest, "root").select("fingerprint", "component_id")
    return found.join(named, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
