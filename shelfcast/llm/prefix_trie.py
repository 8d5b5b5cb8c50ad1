"""Prefix trie of conversations from double-array tries over shards of the sorted sequences.

1. Rebuild. A conversation begins with the first turns of its family's first conversation, then has its own. A turn
   travels as a digest and its number of words; texts are not shuffled.
2. Equal sequences are one row with their number, however many conversations have them.
3. Shards. Sequences are sorted by their digests over ranges of about equal size, so a shard holds neighbours, and a
   common prefix of very many sequences is spread over as many shards as it fills. A shard numbers its turns densely,
   packs its sequences into BASE and CHECK arrays (the child of state s by turn c is BASE[s] + c, if CHECK there is
   s), and walks them for the numbers of its nodes.
4. A node that the first or last sequence of a shard passes may go on in other shards; all others are complete.
   These upper nodes are merged by key over all shards. What they add to the nodes above them is summed
   along each shard's two chains: a running sum over one sequence, so long conversations cost their length.
5. The conversations that end at a node are hashed in order: lists of a few thousand ids are joined in
   parallel, and one pass over those strings gives the digest, which cannot be divided.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import WORD
from shelfcast.session import written

FAMILY, HEAD = 20, 4
DIGEST = 16
#: Turns of a shard's sequences, and ids of one string of ends.
SHARD_TURNS, END_IDS = 200_000, 8_192
#: Slots tried for the children of a state before they go behind the last one; only the packing depends on it.
TRIES = 64

NODES = (
    "key binary, parent binary, shard long, chain int, depth long, conv_id long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, words long"
)
NODES_ARROW = pa.schema([
    (name, {"binary": pa.binary(), "long": pa.int64(), "int": pa.int32()}[kind])
    for name, kind in (x.split() for x in NODES.split(", "))
])
NO_ENDS = hashlib.sha256(b"").hexdigest()


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv_id, path, words`` of every conversation: its turns' digests one after the other, and their words."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    signed = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.substring(F.sha2(signed, 256), 1, 2 * DIGEST).alias("digest"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        ).alias("row"),
    )
    own = written(turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("own")), "trie-turns")
    heads = own.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("base"), F.slice("own", 1, HEAD - 1).alias("head")
    )
    number = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD
    joined = (
        own.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY)
        .withColumn("h", number.cast("int"))
        .join(heads, "base", "left")
    )
    row = F.concat(
        F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("own", 1, 0)),
        F.slice("own", F.col("h") + 1, F.size("own")),
    )
    return joined.select("conv_id", row.alias("row")).select(
        "conv_id",
        F.unhex(F.array_join("row.digest", "")).alias("path"),
        F.col("row.words").alias("words"),
    )


class DoubleArray:
    """Sequences of codes, sorted, as BASE and CHECK arrays; state 0 is the root."""

    def __init__(self, sequences: list[list[int]]) -> None:
        self.base, self.check, self.order = [0], [-1], [0]
        self.free = 1
        todo = [(0, 0, len(sequences), 0)]
        for state, low, high, depth in todo:
            while low < high and len(sequences[low]) == depth:
                low += 1
            groups = []
            while low < high:
                code, first = sequences[low][depth], low
                while low < high and sequences[low][depth] == code:
                    low += 1
                groups.append((code, first, low))
            if groups:
                base = self.base[state] = self._place([g[0] for g in groups])
                for code, first, last in groups:
                    self.check[base + code] = state
                for code, first, last in groups:
                    self.order.append(base + code)
                    todo.append((base + code, first, last, depth + 1))

    def _place(self, codes: list[int]) -> int:
        """A base whose slots for the codes are free; they are kept."""
        check = self.check
        while self.free < len(check) and check[self.free] != -2:
            self.free += 1
        low, high = min(codes), max(codes)
        for first in range(self.free, self.free + TRIES):
            base = first - low
            if all(base + c >= len(check) or check[base + c] == -2 for c in codes):
                break
        else:
            base = len(check) - low
        grow = base + high + 1 - len(check)
        if grow > 0:
            check.extend([-2] * grow)
            self.base.extend([0] * grow)
        return base

    def walk(self, sequence: list[int]) -> list[int]:
        """The states of a sequence's prefixes, the root first."""
        states, state = [0], 0
        for code in sequence:
            child = self.base[state] + code
            if not 0 < child < len(self.check) or self.check[child] != state:
                raise KeyError(code)
            states.append(child)
            state = child
        return states


def prefix_keys(path: bytes) -> list[bytes]:
    """SHA-256 of every prefix of a path, the empty one first."""
    running = hashlib.sha256()
    keys = [running.digest()]
    for at in range(0, len(path), DIGEST):
        running.update(path[at : at + DIGEST])
        keys.append(running.copy().digest())
    return keys


def shard_nodes(rows: list[tuple[bytes, list[int], int, int]], shard: int) -> list[tuple]:
    """The nodes of a shard's rows (path, words, conversations, smallest one), as ``NODES``.

    A complete node has no shard; its key is there if a sequence ends at it, and its parent's key if that one
    is an upper node. An upper node has a row for each chain that passes it, its sums in the first of them.
    """
    codes: dict[bytes, int] = {}
    sequences = [
        [codes.setdefault(path[at : at + DIGEST], len(codes) + 1) for at in range(0, len(path), DIGEST)]
        for path, *_ in rows
    ]
    trie = DoubleArray(sequences)
    size = len(trie.check)
    count, first, words, depth = [0] * size, [None] * size, [0] * size, [0] * size
    ends: dict[int, bytes] = {}
    for sequence, (path, own_words, number, conv) in zip(sequences, rows):
        states = trie.walk(sequence)
        for at, state in enumerate(states):
            count[state] += number
            first[state] = conv if first[state] is None else min(first[state], conv)
            depth[state] = at
            if at:
                words[state] = own_words[at - 1]
        ends[states[-1]] = path
    chains = [trie.walk(sequences[k]) for k in (0, -1)]
    keys = {}
    for states, k in zip(chains, (0, -1)):
        keys |= dict(zip(states, prefix_keys(rows[k][0])))
    children, leaves, saved, inner = [0] * size, [0] * size, [0] * size, [0] * size
    for state in reversed(trie.order):
        if state not in keys:
            leaves[state] += not inner[state]
            saved[state] += (count[state] - 1) * words[state]
        if state:
            parent = trie.check[state]
            inner[parent] += 1
            children[parent] += state not in keys
            leaves[parent] += leaves[state]
            saved[parent] += saved[state]
    out = []
    for state in trie.order:
        if state not in keys:
            parent, key = trie.check[state], hashlib.sha256(ends[state]).digest() if state in ends else None
            over = (keys[parent], None) if parent in keys else (None, first[parent])
            sums = (count[state], inner[state], leaves[state], saved[state], words[state])
            out.append((key, over[0], None, None, depth[state], first[state], over[1], *sums))
    for chain, states in enumerate(chains):
        for at, state in enumerate(states):
            sums = (count[state], children[state], leaves[state], saved[state])
            own, low = ((0, 0, 0, 0), None) if chain and state in chains[0] else (sums, first[state])
            parent = keys[states[at - 1]] if at else None
            out.append((keys[state], parent, shard, chain, at, low, None, *own, words[state]))
    return out


def _in_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, held, turns = TaskContext.get().partitionId() << 32, [], 0

    def done() -> Iterator[pa.RecordBatch]:
        rows = shard_nodes(held, number)
        for at in range(0, len(rows), 10_000):
            columns = zip(*rows[at : at + 10_000])
            arrays = [pa.array(c, f.type) for c, f in zip(columns, NODES_ARROW)]
            yield pa.RecordBatch.from_arrays(arrays, schema=NODES_ARROW)

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            held.append(row)
            turns += 1 + len(row[1])
            if turns >= SHARD_TURNS:
                yield from done()
                number, held, turns = number + 1, [], 0
    if held:
        yield from done()


def ends(found: DataFrame) -> DataFrame:
    """``key, ends_sha256``: the digest of the ids that end at each path, ascending, joined by commas."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, out = None, []
            for key, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if key != at or len(out[-1][2]) == END_IDS:
                    out.append((key, conv, []))
                    at = key
                out[-1][2].append(str(conv))
            if out:
                key, conv, ids = zip(*out)
                columns = [pa.array(key, pa.binary()), pa.array(conv, pa.int64()), pa.array([",".join(x) for x in ids])]
                yield pa.RecordBatch.from_arrays(columns, ["key", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, running = None, None
        for batch in batches:
            out = []
            for key, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if key != at:
                    if running:
                        out.append((at, running.hexdigest()))
                    at, running = key, hashlib.sha256()
                else:
                    running.update(b",")
                running.update(ids.encode())
            if out:
                yield _digests(out)
        if running:
            yield _digests([(at, running.hexdigest())])

    rows = found.select(F.unhex(F.sha2("path", 256)).alias("key"), "conv_id")
    parts = rows.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    strings = parts.mapInArrow(joined, "key binary, first long, ids string")
    return strings.repartition("key").sortWithinPartitions("key", "first").mapInArrow(
        hashed, "key binary, ends_sha256 string"
    )


def _digests(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    key, digest = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(key, pa.binary()), pa.array(digest)], ["key", "ends_sha256"])


def merged(upper: DataFrame) -> DataFrame:
    """The upper nodes over all shards, with the sums of everything below them."""
    row = F.struct("shard", "chain")
    once = upper.groupBy("key").agg(
        F.min("parent").alias("parent"),
        F.max("depth").alias("depth"),
        F.max("words").alias("words"),
        F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.min(row).alias("owner"),
    )
    kids = once.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("kids"))
    once = once.join(kids, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0)))
    once = once.withColumn("own_leaf", (F.col("n_children") == 0).cast("long"))
    once = once.withColumn("own_saved", (F.col("n_convs") - 1) * F.col("words")).drop("kids")
    once = written(once, "trie-upper")
    below = Window.partitionBy("shard", "chain").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    own = once.select("key", "owner", "own_leaf", "own_saved")
    placed = upper.select("key", "shard", "chain", "depth").join(own, "key").withColumn("counts", row == F.col("owner"))
    sums = {
        c: F.sum(F.when(F.col("counts"), F.col(c)).otherwise(0)).over(below) for c in ("own_leaf", "own_saved")
    }
    added = placed.withColumns(sums).groupBy("key").agg(
        F.sum("own_leaf").alias("more_leaves"), F.sum("own_saved").alias("more_saved")
    )
    return once.join(added, "key").withColumns(
        {
            "n_leaves": F.col("n_leaves") + F.col("more_leaves"),
            "saved_tokens": F.col("saved_tokens") + F.col("more_saved"),
        }
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Turns of a conversation are ordered by ``turn``, null first; rows of the same turn by their digest. Null roles
    and texts count as empty; rows without a conversation belong to none. Repeated rows are turns like others. Texts of
    any length are hashed whole, where they are read; a conversation's digests are held in one task. Without
    conversations there are no nodes, not even a root. Other columns are not read.
    """
    found = written(rebuilt(conversations), "trie-paths")
    sequences = found.groupBy("path", "words").agg(F.count("*").alias("n"), F.min("conv_id").alias("first"))
    sorted_ = sequences.select("path", "words", "n", "first").repartitionByRange("path").sortWithinPartitions("path")
    nodes = written(sorted_.mapInArrow(_in_shards, NODES), "trie-nodes")
    upper = written(merged(nodes.where("shard is not null")), "trie-merged")
    over = upper.select(F.col("key").alias("parent"), F.col("conv_id").alias("over_conv_id"))
    columns = ["key", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    every = nodes.where("shard is null").select(*columns).unionByName(
        upper.withColumn("parent_conv_id", F.lit(None).cast("long")).select(*columns)
    )
    return (
        every.join(over, "parent", "left")
        .join(ends(found), "key", "left")
        .select(
            "conv_id",
            "depth",
            F.coalesce("parent_conv_id", "over_conv_id").alias("parent_conv_id"),
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
    )
