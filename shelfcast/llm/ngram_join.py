"""N-gram Jaccard join with prefix trees over globally ordered n-gram sets.

Every text is the set of its word n-grams, held as 64-bit hashes. Two sets link when the size of their
intersection is at least a share of the size of their union.

1. Candidates. One global order for all sets: n-grams by the number of sets that hold them, rarest first, then
   by hash. Linked sets share an n-gram among the first ``size - needed + 1`` of each (``needed`` is the smallest
   overlap that a link of that size can have), so sets that share one become candidates: no link is lost. A
   passage that many texts share comes last in the order, so it makes candidates only of texts that consist of it.
2. Candidate families are the connected components of shared first n-grams: a chain of links never
   leaves one. The sets of a family are brought together once; a family of more n-grams than a task should hold
   is dealt over pairs of chunks, so that every two of its sets still meet.
3. Within a family the sets, ordered by hash, are stored in a trie with merged edges. The sets walk the trie; the
   overlap with a path is counted once for all sets below it, and a subtree goes as soon as the lengths that
   remain cannot reach the required overlap. Every link is found and counted for both its sets; those that
   join sets not yet connected are handed on, so the output grows with the sets, not with their pairs.
4. Links are joined to components over the whole table.

The counts of step 1 need one shuffle of the n-grams and one of those that several sets hold. Texts travel as slices:
an n-gram that several sets of a slice hold is one entry with their number, so an n-gram of very many texts
has one entry per slice in the task that counts it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import WordHashes, free_name, id_and_text, shingle_hashes, shuffle_tasks
from shelfcast.llm.components import components
from shelfcast.session import written

#: Texts of a slice, and n-grams after which a slice is closed earlier.
SLICE_TEXTS, SLICE_NGRAMS = 10_000, 1_000_000
#: Bytes of text whose n-grams one task counts.
PART_BYTES = 10_000_000
#: N-grams of one family that a task holds at once; larger families are dealt over pairs of chunks.
FAMILY_NGRAMS = 6_000_000
#: Sets that walk a trie together at most, and bytes that their membership table may take.
BLOCK_SETS, BLOCK_BYTES = 64, 32_000_000

OWN = ("doc_ids", "contents", "sizes", "keys", "ids")
SLICES = (
    "part int, slice long, doc_ids array<long>, contents array<long>, sizes array<long>, keys array<binary>, "
    "ids array<long>, ngrams binary, marks binary, counts binary"
)
PROFILE = "doc_id long, content long, n_shingles long, key binary, id long, signatures array<long>, near array<long>"
LONGS = pa.list_(pa.int64())
SLICES_ARROW = pa.schema(
    [("part", pa.int32()), ("slice", pa.int64())]
    + [(name, pa.list_(pa.binary()) if name == "keys" else LONGS) for name in OWN]
    + [(name, pa.binary()) for name in ("ngrams", "marks", "counts")]
)


class Similarity:
    """Links where 100 * intersection >= percent * union."""

    def __init__(self, percent: int) -> None:
        if not 50 <= percent <= 100:
            raise ValueError("the similarity must be between 50 and 100 percent")
        self.percent = percent

    def enough(self, overlap: int, x: int, y: int) -> bool:
        return (100 + self.percent) * overlap >= self.percent * (x + y)

    def first_ngrams(self, sizes: np.ndarray) -> np.ndarray:
        """How many of its rarest n-grams a set compares: any link needs an overlap of percent of its size."""
        return sizes - (sizes * self.percent + 99) // 100 + 1


def ngram_set(text: str | None, n: int, hashes: WordHashes) -> np.ndarray:
    """Ascending hashes of the n-grams; only A-Z are lower-cased, ASCII white space separates words."""
    return shingle_hashes(hashes((text or "").encode("utf-8", "surrogatepass").lower().split()), n)


def set_key(ngrams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(ngrams.tobytes())


def slices(docs: DataFrame, n: int, parts: int) -> DataFrame:
    """The n-grams of all texts, a row for each slice of texts and each part of the n-grams, dealt by part.

    Besides, each slice has its own row, with the ids, sizes and keys of its texts. Equal sets of a slice
    count once. ``marks`` tell the set of an n-gram by its place in the slice, or, where several sets of
    the slice hold it, their number below zero; then the slice's own row tells the places.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            first, total, held, seen = 0, 0, [], set()
            for k, text in enumerate(batch.column(2)):
                ngrams = ngram_set(text.as_py(), n, hashes)
                key = set_key(ngrams) if len(ngrams) else None
                held.append((key, len(ngrams), ngrams if key not in seen else NO_NGRAMS))
                seen.add(key)
                total += len(held[-1][2])
                if len(held) == SLICE_TEXTS or total >= SLICE_NGRAMS or k + 1 == batch.num_rows:
                    yield _slice(batch.slice(first, len(held)), held, parts)
                    first, total, held, seen = k + 1, 0, [], set()

    text = F.col("text")
    rows = id_and_text(docs).select(F.monotonically_increasing_id(), "doc_id", "text", content(text).alias("content"))
    return rows.mapInArrow(run, SLICES).repartitionById(parts, "part")


def _slice(rows: pa.RecordBatch, held: list[tuple], parts: int) -> pa.RecordBatch:
    keys, sizes, sets = zip(*held)
    number = rows.column(0)[0].as_py()
    ids = [int.from_bytes(key[:8], "little", signed=True) if key else None for key in keys]
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], np.repeat(np.arange(len(sets), dtype=np.int16), [len(x) for x in sets])[order]
    starts = np.flatnonzero(np.concatenate((np.ones(min(len(flat), 1), bool), flat[1:] != flat[:-1])))
    times = np.diff(np.append(starts, len(flat)))
    values, several = flat[starts], np.repeat(times > 1, times)
    marks = np.where(times > 1, -times, owner[starts]).astype(np.int16)
    part = (((values >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int32)
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    ends = np.append(cuts[1:], len(part))
    rows_out = [
        (int(part[a]), number, *[None] * len(OWN), values[a:b].tobytes(), marks[a:b].tobytes(), None)
        for a, b in zip(cuts, ends)
    ]
    own = (rows.column(1).to_pylist(), rows.column(3).to_pylist(), sizes, keys, ids)
    rows_out.append((number % parts, number, *own, flat[several].tobytes(), owner[several].tobytes(), None))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, field.type) for c, field in zip(zip(*rows_out), SLICES_ARROW)], schema=SLICES_ARROW
    )


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One part: how many sets hold each n-gram; those of a single set are left out. Own rows pass."""
    held = []
    for batch in batches:
        own = batch.column("sizes").is_valid()
        yield batch.filter(own)
        for row in batch.filter(pa.compute.invert(own)).select(["slice", "ngrams", "marks"]).to_pylist():
            held.append((row["slice"], np.frombuffer(row["ngrams"], np.uint64), np.frombuffer(row["marks"], np.int16)))
    if not held:
        return
    marks = np.concatenate([x for _, _, x in held])
    values, which = np.unique(np.concatenate([x for _, x, _ in held]), return_inverse=True)
    counts = np.bincount(which, np.where(marks < 0, -marks.astype(np.int64), 1), len(values)).astype(np.int64)[which]
    done, out = 0, []
    for number, ngrams, own_marks in held:
        here = counts[done : done + len(ngrams)]
        done += len(ngrams)
        keep = here > 1
        if keep.any():
            lists = (ngrams[keep], own_marks[keep], np.minimum(here[keep], 2**31 - 1).astype(np.int32))
            out.append((None, number, *[None] * len(OWN), *(x.tobytes() for x in lists)))
        if out and (len(out) == 500 or done == len(counts)):
            columns = [pa.array(c, field.type) for c, field in zip(zip(*out), SLICES_ARROW)]
            yield pa.RecordBatch.from_arrays(columns, schema=SLICES_ARROW)
            out = []
    if out:
        columns = [pa.array(c, field.type) for c, field in zip(zip(*out), SLICES_ARROW)]
        yield pa.RecordBatch.from_arrays(columns, schema=SLICES_ARROW)


def profiles(docs: DataFrame, n: int, similarity: Similarity) -> DataFrame:
    """Size, key and first n-grams (``signatures``) of every text's set, stored once.

    Within a slice, a signature is sent on by one set only; the others name that set in ``near``. So a
    signature of very many sets travels once per slice, and equal sets sign once per slice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, lists = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["sizes"] is not None:
                    if own:
                        yield _signed(own, lists, similarity)
                    own, lists = row, []
                else:
                    kinds = (("ngrams", np.uint64), ("marks", np.int16), ("counts", np.int32))
                    lists.append([np.frombuffer(row[name], kind) for name, kind in kinds])
        if own:
            yield _signed(own, lists, similarity)

    spark = docs.sparkSession
    size = id_and_text(docs).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(shuffle_tasks(spark), -(-size // PART_BYTES))
    rows = (
        slices(docs, n, parts)
        .mapInArrow(counted, SLICES)
        .repartition(parts, "slice")
        .sortWithinPartitions("slice", F.col("sizes").isNull())
    )
    return written(rows.mapInArrow(run, PROFILE), "ngram-profiles")


def _signed(own: dict, lists: list[list[np.ndarray]], similarity: Similarity) -> pa.RecordBatch:
    """The texts of a slice with the rarest n-grams of their sets, as far as other sets hold them too."""
    ids, sizes = own["ids"], np.array(own["sizes"], np.int64)
    signatures: list[np.ndarray] = [NONE] * len(ids)
    near: list[np.ndarray] = [NONE] * len(ids)
    if lists:
        ngrams, marks, counts = (np.concatenate(x) for x in zip(*lists))
        alone = marks >= 0
        together = np.frombuffer(own["ngrams"], np.uint64)
        values, values_counts = ngrams[~alone], counts[~alone]
        order = np.argsort(values)
        together_counts = values_counts[order][np.searchsorted(values[order], together)]
        ngrams = np.concatenate((ngrams[alone], together))
        owner = np.concatenate((marks[alone], np.frombuffer(own["marks"], np.int16))).astype(np.int64)
        order = np.lexsort((ngrams, np.concatenate((counts[alone], together_counts)), owner))
        ngrams, owner = ngrams[order], owner[order]
        held = np.bincount(owner, minlength=len(ids))
        place = np.arange(len(owner)) - (np.cumsum(held) - held)[owner]
        first = place + (sizes - held)[owner] < similarity.first_ngrams(sizes)[owner]
        ngrams, owner = ngrams[first], owner[first]
        values, at, which = np.unique(ngrams, return_index=True, return_inverse=True)
        for k, mine in _by_owner(owner[at], values.view(np.int64)):
            signatures[k] = mine
        leader = owner[at][which]
        for k, leaders in _by_owner(owner[leader != owner], leader[leader != owner]):
            near[k] = np.array([ids[x] for x in np.unique(leaders)], np.int64)
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
    columns = [pa.array(own[name], kind) for name, kind in zip(OWN, kinds)]
    return pa.RecordBatch.from_arrays(
        [*columns, pa.array(signatures, LONGS), pa.array(near, LONGS)],
        ["doc_id", "content", "n_shingles", "key", "id", "signatures", "near"],
    )


def content(text: Column) -> Column:
    """Tells rows apart that share an id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


NONE, NO_NGRAMS = np.empty(0, np.int64), np.empty(0, np.uint64)


def _by_owner(owners: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(owners, kind="stable")
    owners, values = owners[order], values[order]
    cuts = np.flatnonzero(np.diff(owners)) + 1
    if len(owners):
        for own, part in zip(np.split(owners, cuts), np.split(values, cuts)):
            yield int(own[0]), part


def families(found: DataFrame) -> DataFrame:
    """``id, family``: sets with a common signature, directly or through others, are one family.

    Signatures are shuffled once. A signature has one row per slice at most, however many sets share it.
    """
    rows = found.where("key is not null")
    signed = rows.select("id", F.explode("signatures").alias("signature"))
    low = F.min("id").over(Window.partitionBy("signature"))
    shared = signed.withColumn("low", low).where("id != low").select(F.col("id").alias("a"), F.col("low").alias("b"))
    near = rows.select(F.col("id").alias("a"), F.explode("near").alias("b"))
    return components(shared.union(near)).select(F.col("node").alias("id"), F.col("root").alias("family"))


class Trie:
    """Ordered sets of local numbers as paths with merged edges; leaves are in lexicographic order."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.order = sorted(range(len(sets)), key=lambda k: sets[k].astype(">u4").tobytes())
        self.sets = [sets[k] for k in self.order]
        lengths = [len(s) for s in self.sets]
        self.ends: list[int] = []
        self.spans: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        self.is_leaf: list[bool] = []
        open_nodes = [self._node(0, 0, False)]
        for k, ordered in enumerate(self.sets):
            shared = _common(self.sets[k - 1], ordered) if k else 0
            while self.ends[open_nodes[-1]] > shared or self.is_leaf[open_nodes[-1]]:
                last = open_nodes.pop()
                self.spans[last] = (self.spans[last][0], k)
                if self.ends[open_nodes[-1]] < shared:
                    open_nodes.append(self._node(shared, self.spans[last][0], False))
                self.children[open_nodes[-1]].append(last)
            open_nodes.append(self._node(len(ordered), k, True))
        while len(open_nodes) > 1:
            last = open_nodes.pop()
            self.spans[last] = (self.spans[last][0], len(self.sets))
            self.children[open_nodes[-1]].append(last)
        self.spans[0] = (0, len(self.sets))
        lengths = [len(s) for s in self.sets]
        self.shortest = [min(lengths[a:b]) for a, b in self.spans]
        self.longest = [max(lengths[a:b]) for a, b in self.spans]

    def _node(self, end: int, first: int, leaf: bool) -> int:
        self.ends.append(end)
        self.is_leaf.append(leaf)
        self.spans.append((first, first))
        self.children.append([])
        return len(self.ends) - 1


def _common(x: np.ndarray, y: np.ndarray) -> int:
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[:n] != y[:n])
    return int(differ[0]) if len(differ) else n


def trie_links(
    sets: list[np.ndarray],
    similarity: Similarity,
    times: np.ndarray | None = None,
    sides: np.ndarray | None = None,
) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Every set's number of linked rows, and links that join all sets linked directly or through others.

    ``times`` tells how many rows a set stands for. Where ``sides`` are given, only sets of different sides meet.
    The trie is walked by blocks of neighbouring sets: a node's overlaps with all sets of the block that still
    can reach it are counted at once. No link is skipped; links within one component that is known are only counted.
    """
    universe, flat = np.unique(np.concatenate(sets), return_inverse=True)
    trie = Trie(np.split(flat, np.cumsum([len(s) for s in sets])[:-1]))
    times = (np.ones(len(sets), np.int64) if times is None else times)[trie.order]
    sides = np.arange(len(sets)) if sides is None else sides[trie.order]
    sizes = np.array([len(s) for s in trie.sets], np.int64)
    label, counts, links = np.arange(len(sets)), np.zeros(len(sets), np.int64), []
    width = max(1, min(BLOCK_SETS, BLOCK_BYTES // len(universe)))
    has = np.zeros((len(universe), width), np.uint8)
    for start in range(0, len(sets), width):
        block = trie.sets[start : start + width]
        for column, walker in enumerate(block):
            has[walker, column] = 1
        # all walkers as one ascending list: place in it less the walkers before = members up to a value
        keyed = np.concatenate([walker + k * len(universe) for k, walker in enumerate(block)])
        before = np.cumsum(sizes[start : start + width]) - sizes[start : start + width]
        todo = [(child, 0, np.arange(len(block)), np.zeros(len(block), np.int64)) for child in trie.children[0]]
        while todo:
            node, depth, own, overlap = todo.pop()
            first, last = trie.spans[node]
            later = int(np.searchsorted(own, last - 1 - start))
            if not later:
                continue
            own, overlap, end = own[:later], overlap[:later], trie.ends[node]
            edge = trie.sets[first][depth:end]
            found = has[edge][:, own] if 4 * later > width else has[np.ix_(edge, own)]
            overlap = overlap + found.sum(axis=0, dtype=np.int64)
            size = sizes[start + own]
            if trie.is_leaf[node]:
                near = start + own[similarity.enough(overlap, size, end) & (sides[start + own] != sides[first])]
                counts[near] += times[first]
                counts[first] += times[near].sum()
                while len(near := near[label[near] != label[first]]):
                    links.append((trie.order[near[0]], trie.order[first]))
                    label[label == label[first]] = label[near[0]]
                continue
            left = size - (np.searchsorted(keyed, own * len(universe) + edge[-1], "right") - before[own])
            best = np.clip(end + left, trie.shortest[node], trie.longest[node])
            open_ = similarity.enough(overlap + np.minimum(left, best - end), size, best)
            if open_.any():
                todo.extend((child, end, own[open_], overlap[open_]) for child in trie.children[node])
        for column, walker in enumerate(block):
            has[walker, column] = 0
    out = np.empty_like(counts)
    out[trie.order] = counts
    return links, out


def family_links(docs: DataFrame, found: DataFrame, grouped: DataFrame, n: int, similarity: Similarity) -> DataFrame:
    """``a, b, n_links`` from the texts of all candidate families.

    Rows with ``b``: keys of linked sets, as many as their components need. Rows without: rows linked with set ``a``,
    counted once in one of the places where it meets others.
    """
    rows = found.where("key is not null").groupBy("key", "id", "n_shingles")
    firsts = rows.agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("times"))
    member = firsts.join(grouped, "id")
    totals = member.groupBy("family").agg(F.sum("n_shingles").alias("total"))
    chunks = F.when(F.col("total") > FAMILY_NGRAMS, F.ceil(2 * F.col("total") / FAMILY_NGRAMS)).otherwise(1)
    dealt = (
        member.join(totals.select("family", chunks.cast("int").alias("chunks")), "family")
        .withColumn("chunk", F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id_text"),
            F.col("key").alias("wanted"),
            "family",
            F.least("chunk", "other").alias("i"),
            F.greatest("chunk", "other").alias("j"),
            "chunk",
            "times",
        )
    )
    texts = id_and_text(docs).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id_text"), "text")
    tasks = shuffle_tasks(docs.sparkSession)
    together = (
        texts.join(dealt, "id_text")
        .select("family", "i", "j", "wanted", "chunk", "times", "text")
        .repartition(tasks, "family", "i", "j")
        .sortWithinPartitions("family", "i", "j")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        at, held = None, {}

        def linked() -> list[tuple]:
            if len(held) < 2:
                return []
            keys = list(held)
            sets, chunk, times = zip(*held.values())
            _, i, j = at
            # sets of one chunk meet where the chunk stands alone; elsewhere only sets of different chunks do
            sides = None if i == j else np.array(chunk)
            pairs, counts = trie_links(list(sets), similarity, np.array(times, np.int64), sides)
            own = [(keys[k], None, int(counts[k])) for k in np.flatnonzero(counts)]
            return own + [(keys[a], keys[b], None) for a, b in pairs]

        for batch in batches:
            links = []
            places = zip(*(batch.column(k).to_pylist() for k in range(6)))
            for (*place, wanted, chunk, times), text in zip(places, batch.column(6)):
                if place != at:
                    links += linked()
                    at, held = place, {}
                if wanted not in held:
                    ngrams = ngram_set(text.as_py(), n, hashes)
                    if len(ngrams) and set_key(ngrams) == wanted:
                        held[wanted] = ngrams, chunk, times
            if links:
                yield _links_batch(links)
        if links := linked():
            yield _links_batch(links)

    return together.mapInArrow(run, "a binary, b binary, n_links long")


def _links_batch(links: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.binary(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*links), kinds)], ["a", "b", "n_links"])


def classes(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links``: every row's set size, the smallest id its links reach, its links.

    ``n_links`` is the number of other rows whose sets link with the row's own, rows with an equal set among them.

    Null and empty texts have no n-grams and are linked with nothing: they are their own component. A text of
    fewer than ``n`` words is one n-gram. Repeated rows and equal texts share a set and so a component; a null id
    is returned as it is, and a component has a null id only if all its ids are null. Other columns are not read.
    """
    found, named = _named(docs, n, percent)
    return (
        found.select("doc_id", "n_shingles", "key")
        .join(named, "key", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
            F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        )
    )


def _named(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Profiles, and for each set's key the first row of its component (smallest id, null ids last) and its links."""
    similarity = Similarity(percent)
    found = profiles(docs, n, similarity)
    links = written(family_links(docs, found, families(found), n, similarity), "ngram-links")
    roots = written(components(links.where("b is not null").select("a", "b")), "ngram-components")
    others = links.where("b is null").groupBy(F.col("a").alias("key")).agg(F.sum("n_links").alias("others"))
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "content")
    firsts = found.where("key is not null").groupBy("key").agg(F.min(row).alias("own"), F.count("*").alias("times"))
    held = firsts.join(roots.withColumnRenamed("node", "key"), "key", "left")
    lowest = held.where("root is not null").groupBy("root").agg(F.min("own").alias("low"))
    named = (
        held.join(lowest, "root", "left")
        .join(others, "key", "left")
        .select(
            "key",
            F.coalesce("low", "own").alias("first"),
            (F.coalesce("others", F.lit(0)) + F.col("times") - 1).alias("n_links"),
        )
    )
    return found, named


def one_per_class(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that are the first of their component; texts without n-grams all stay."""
    _, named = _named(docs, n, percent)
    name, own, bare = free_name(docs, "id_text"), free_name(docs, "content"), free_name(docs, "bare")
    stays = named.select(
        F.coalesce(F.col("first.doc_id").cast("string"), F.lit("")).alias(name), F.col("first.content").alias(own)
    ).distinct()
    text = F.col("text").cast("string")
    keyed = docs.withColumns(
        {
            name: F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")),
            own: content(text),
            bare: ~F.coalesce(text, F.lit("")).rlike(r"[^\x20\x09-\x0D]"),
        }
    )
    full = keyed.where(~F.col(bare)).join(stays, [name, own], "left_semi").dropDuplicates([name, own])
    return full.select(*docs.columns).unionByName(keyed.where(F.col(bare)).select(*docs.columns))
