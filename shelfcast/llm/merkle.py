"""Merkle manifest of a document table, with leaf places from ranked id bitmaps.

Every row is a leaf; the leaves of a source ascend by id, runs of 16 become their hash level by level, and the sources'
roots, ordered by source, are combined the same way.

1. Bitmaps. The ids of a source are cut into ranges of 1,024. Only a range that holds ids has a bitmap, of 16 words,
   which every task builds from its rows and ``bit_or`` merges; it has a directory of popcounts before every word.
2. Directory of ranges. Rows before a range are prefix sums in three steps of 18 bits, so that no window holds more
   than 2**18 ranges however ids are spread.
3. Rank. A row finds its place as the rows before its range, the popcounts before its word and the bits below its own.
   Nothing is sorted by id.
4. Slots. Places are dealt by (source, place div 256) into arrays of 256 slots, keyed by place mod 256; an array
   gives two levels of the tree. Its top is a node of the next round, which has 256 times fewer. Proofs come down the
   same arrays: the siblings of a node, then those of the nodes above it.

Work is a shuffle of the ids, two of the leaves (hashes, not texts), and rounds over 1/256 of the leaves each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.session import written

FANOUT = 16
SLOT_BITS = 8
SLOTS = 1 << SLOT_BITS
#: Bits of an id within its bitmap, and bits of a range's number that one step of the directory covers.
LOW_BITS, STEP_BITS = 10, 18
WORDS = 1 << (LOW_BITS - 6)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOP = "all"

STEP = "struct<before:string,after:string>"


def hashed(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for a missing value, else its bytes in UTF-8, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return hashed(*map(field, (doc_id, source, lang, n_chars, text)))


def is_tampered(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """``tree, doc_id, no_id, key, leaf, claimed``: the row's hash, and that of its tampered text where it has one.

    ``tree`` names the source (null first in its order); ``key`` orders the rows of a source: the id or, for rows
    without one, which come first, 60 bits of the hash.
    """
    doc_id, n_chars = F.col("doc_id").cast("long"), F.col("n_chars").cast("long")
    source, lang, text = (F.col(c).cast("string") for c in ("source", "lang", "text"))
    lowered = leaf(doc_id, source, lang, n_chars, F.translate(text, UPPER, LOWER))
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("tree"),
        doc_id.alias("doc_id"),
        leaf(doc_id, source, lang, n_chars, text).alias("leaf"),
        F.when(is_tampered(doc_id), lowered).alias("claimed"),
    )
    rows = written(rows, "merkle-leaves")
    prefix = F.conv(F.substring("leaf", 1, 15), 16, 10).cast("long")
    return rows.withColumns({"no_id": F.col("doc_id").isNull(), "key": F.coalesce("doc_id", prefix)})


def bitmaps(rows: DataFrame) -> DataFrame:
    """``tree, no_id, high, n, words, counts, before``: a bitmap for each range that holds keys, once.

    ``counts`` are the keys before each word, ``before`` the rows of the tree before the range, and ``n`` its rows,
    more than its bits if keys are repeated.
    """
    low = F.col("key").bitwiseAND((1 << LOW_BITS) - 1)
    bit = F.expr("shiftleft(1L, cast(key & 63 as int))")
    word, names = F.shiftright(low, 6), [f"w{k}" for k in range(WORDS)]
    merges = [
        F.bit_or(F.when(word == k, bit).otherwise(F.lit(0).cast("long"))).alias(name) for k, name in enumerate(names)
    ]
    counts = _running([F.bit_count(F.col(name)) for name in names])
    ranges = (
        rows.groupBy("tree", "no_id", F.shiftright("key", LOW_BITS).alias("high"))
        .agg(F.count("*").alias("n"), *merges)
        .select("tree", "no_id", "high", "n", F.array(*names).alias("words"), counts.alias("counts"))
    )
    ranges = written(ranges, "merkle-bitmaps")
    return ranges.join(_rows_before(ranges), ["tree", "no_id", "high"])


def _running(counts: list[Column]) -> Column:
    """Sums of all that come before each, and of all."""
    sums = [F.lit(0)]
    for count in counts:
        sums.append(sums[-1] + count)
    return F.array(*(s.cast("int") for s in sums))


def _rows_before(ranges: DataFrame) -> DataFrame:
    """``tree, no_id, high, before`` by prefix sums over the bits of ``high``, the lowest ones first."""
    own = ["tree", "no_id"]

    def summed(at: DataFrame, group: list, name: str, order: list) -> DataFrame:
        earlier = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return at.withColumn(name, F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long")))

    low = ranges.select(*own, "high", F.shiftright("high", STEP_BITS).alias("mid"), "n")
    mid = low.groupBy(*own, "mid").agg(F.sum("n").alias("n")).withColumn("top", F.shiftright("mid", STEP_BITS))
    top = mid.groupBy(*own, "top").agg(F.sum("n").alias("n"))
    top = summed(top, ["tree"], "in_tree", [F.desc("no_id"), "top"]).drop("n")
    mid = summed(mid, [*own, "top"], "in_top", ["mid"]).drop("n").join(top, [*own, "top"])
    low = summed(low, [*own, "mid"], "in_mid", ["high"]).drop("n").join(mid, [*own, "mid"])
    return low.select(*own, "high", (F.col("in_tree") + F.col("in_top") + F.col("in_mid")).alias("before"))


def placed(rows: DataFrame) -> DataFrame:
    """``tree, pos, doc_id, leaf, claimed``: each row's place among the rows of its tree.

    In ranges where a key is repeated, equal rows are counted first and the rows of a key follow each other by hash.
    """
    own = ["tree", "no_id", "high"]
    ranges = bitmaps(rows)
    crowded = F.col("n") > F.element_at("counts", -1)
    rows = rows.withColumn("high", F.shiftright("key", LOW_BITS))
    word = F.shiftright(F.col("key").bitwiseAND((1 << LOW_BITS) - 1), 6).cast("int") + 1
    below = F.expr("~shiftleft(-1L, cast(key & 63 as int))")
    rank = F.element_at("counts", word) + F.bit_count(F.element_at("words", word).bitwiseAND(below))
    plain = rows.join(ranges.where(~crowded), own).withColumn("pos", F.col("before") + rank)
    same = rows.join(ranges.where(crowded).select(*own, "before"), own)
    same = same.groupBy(*own, "before", "key", "doc_id", "leaf", "claimed").agg(F.count("*").alias("times"))
    earlier = Window.partitionBy(*own).orderBy("key", "leaf").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("before") + F.coalesce(F.sum("times").over(earlier), F.lit(0).cast("long"))
    same = same.withColumn("first", first).withColumn("pos", F.explode(F.expr("sequence(first, first + times - 1)")))
    columns = ["tree", "pos", "doc_id", "leaf", "claimed"]
    return plain.select(*columns).unionByName(same.select(*columns))


def climbed(nodes: DataFrame, largest: int, name: str) -> list[DataFrame]:
    """Rounds of slot arrays over nodes (``tree, n, pos, node``, other columns ride along), each written once.

    A round has ``tree, n, block, slots, mids, top``: the nodes of a block by slot, the hashes of its runs and
    its top. A tree of n > 256 nodes goes on with the tops of its blocks.
    """
    run = f"slice(slots.node, cast({FANOUT} * i + 1 as int), {FANOUT})"
    mids = (
        f"transform(sequence(0, (size(slots) - 1) div {FANOUT}), "
        f"i -> sha2(cast(array_join({run}, '') as binary), 256))"
    )
    rounds = []
    while True:
        others = [c for c in nodes.columns if c not in ("tree", "n", "pos", "node")]
        slot = F.col("pos").bitwiseAND(SLOTS - 1).cast("int").alias("slot")
        blocks = (
            nodes.groupBy("tree", "n", F.shiftright("pos", SLOT_BITS).alias("block"))
            .agg(F.sort_array(F.collect_list(F.struct(slot, "node", *others))).alias("slots"))
            .withColumn("mids", F.expr(mids))
            .withColumn(
                "top",
                F.when(F.col("n") == 1, F.col("slots")[0]["node"])
                .when(F.col("n") <= FANOUT, F.col("mids")[0])
                .otherwise(hashed(F.array_join("mids", ""))),
            )
        )
        blocks = written(blocks, f"merkle-{name}")
        rounds.append(blocks)
        if largest <= SLOTS:
            return rounds
        largest = -(-largest // SLOTS)
        nodes = blocks.where(F.col("n") > SLOTS).select(
            "tree", F.ceil(F.col("n") / SLOTS).alias("n"), F.col("block").alias("pos"), F.col("top").alias("node")
        )


def tops(rounds: list[DataFrame]) -> DataFrame:
    """``tree, root`` of every tree."""
    done = [r.where(F.col("n") <= SLOTS).select("tree", F.col("top").alias("root")) for r in rounds]
    out = done[0]
    for other in done[1:]:
        out = out.unionByName(other)
    return out


def _siblings(run: str, at: str) -> str:
    """The rest of a run, joined, before and after the place ``at``."""
    return (
        f"named_struct('before', array_join(slice({run}, 1, {at}), ''), "
        f"'after', array_join(slice({run}, {at} + 2, {FANOUT}), ''))"
    )


def descended(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """The nodes of the first round, ``tree, pos, node, path`` and what rides along.

    ``above`` has ``tree, path`` and further columns of a tree, which are handed down. ``path`` lists a node's
    siblings level by level, each as what stands before and after it.
    """
    handed = [c for c in above.columns if c not in ("tree", "path")]
    below = None
    for blocks in reversed(rounds):
        own = blocks.where(F.col("n") <= SLOTS).join(above, "tree")
        if below is not None:
            paths = below.select("tree", F.col("pos").alias("block"), "path", *handed)
            own = own.unionByName(blocks.where(F.col("n") > SLOTS).join(paths, ["tree", "block"]))
        at = f"cast(s.slot div {FANOUT} as int)"
        run = _siblings(f"slice(slots.node, {at} * {FANOUT} + 1, {FANOUT})", f"s.slot % {FANOUT}")
        mid = _siblings("mids", at)
        level = (
            f"case when n = 1 then cast(array() as array<{STEP}>) when n <= {FANOUT} then array({run}) "
            f"else array({run}, {mid}) end"
        )
        below = own.withColumn("s", F.explode("slots")).select(
            "tree",
            (F.shiftleft("block", SLOT_BITS) + F.col("s.slot")).alias("pos"),
            "s.*",
            F.expr(f"concat({level}, path)").alias("path"),
            *handed,
        )
    return below


def _ranked(trees: DataFrame) -> DataFrame:
    """``pos`` of each tree by name; sorted by ranges of names, the ranges numbered by their sizes."""
    parts = written(trees.repartitionByRange("tree").withColumn("part", F.spark_partition_id()), "merkle-sources")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.groupBy("part").agg(F.count("*").alias("m"))
    before = before.select("part", F.coalesce(F.sum("m").over(earlier), F.lit(0).cast("long")).alias("before"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("tree"))
    return parts.join(before, "part").select("tree", "root", (F.col("before") + within - 1).alias("pos"))


def proofs(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, claimed, subroot, root, path`` for every row of ``docs`` (doc_id, source, lang, n_chars, text).

    ``path`` lists the siblings from the leaf's run up to the root's; ``claimed`` is the leaf of the tampered text, null
    where nothing was tampered with. Nulls are hashed as ``-`` and a null source is the first one. Rows without an id
    stand before the others of their source, by hash; rows that repeat an id follow each other by hash, equal rows
    have places of their own. Texts of any length are hashed whole, where they are read. No rows give no rows.
    Other columns, however named, are not read.
    """
    spark = docs.sparkSession
    found = leaves(docs)
    totals = written(found.groupBy("tree").agg(F.count("*").alias("n")), "merkle-totals")
    largest, sources = totals.agg(F.max("n"), F.count("*")).first()
    if not sources:
        return _nothing(spark)
    nodes = placed(found).join(totals, "tree").withColumnRenamed("leaf", "node")
    rounds = climbed(nodes, largest, "slots")
    ranked = _ranked(tops(rounds))
    over = ranked.select(
        F.lit(TOP).alias("tree"),
        F.lit(sources).cast("long").alias("n"),
        "pos",
        F.col("root").alias("node"),
        F.col("tree").alias("source"),
    )
    upper = climbed(over, sources, "roots")
    root = tops(upper).first()["root"]
    start = spark.createDataFrame([(TOP, [])], f"tree string, path array<{STEP}>")
    above = descended(upper, start).select(F.col("source").alias("tree"), "path", F.col("node").alias("subroot"))
    above = written(above, "merkle-paths")
    return descended(rounds, above).select(
        "doc_id", F.col("node").alias("leaf"), "claimed", "subroot", F.lit(root).alias("root"), "path"
    )


def _nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [], f"doc_id long, leaf string, claimed string, subroot string, root string, path array<{STEP}>"
    )


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda node, step: hashed(step["before"], node, step["after"]))


def siblings_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["before"], x["after"])), "").cast("binary"), 256)


def verified(found: DataFrame) -> DataFrame:
    """Digests of the proofs, the roots recomputed from them, and whether these equal the root."""
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        siblings_digest(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("claimed", "leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
