"""Merkle manifest, SimHash classes and the conversation trie against plain Python."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from shelfcast.llm import merkle, prefix_trie, queries, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, key string, path string"
TURNS = "conv_id long, turn long, role string, text string, key string, path string, words string"
LONG = "ab cd " * 20_000 + "x" * 30_000


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def documents(spark, rows):
    return spark.createDataFrame([(*r, "t", "k", "p") for r in rows], DOCS).repartition(5)


def climbed(nodes):
    """The root, and each node's siblings level by level."""
    steps, own, now = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(now) > 1:
        for k, at in enumerate(own):
            low = at // 16 * 16
            steps[k].append(("".join(now[low:at]), "".join(now[at + 1 : low + 16])))
            own[k] = at // 16
        now = ["".join(now[k : k + 16]) for k in range(0, len(now), 16)]
        now = [sha(x) for x in now]
    return now[0], steps


def manifest(rows):
    def leaf(row, text):
        parts = (row[0], row[3], row[2], row[4], text)
        return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in parts))

    def lowered(text):
        return None if text is None else re.sub("[A-Z]", lambda m: m[0].lower(), text)

    sources = defaultdict(list)
    for row in rows:
        own = leaf(row, row[1])
        changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
        sources[row[3]].append((row[0] is not None, row[0] or 0, own, leaf(row, lowered(row[1])) if changed else own))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = [climbed([x[2] for x in sorted(sources[s])]) for s in names]
    root, upper = climbed([subroot for subroot, _ in trees])
    out = []
    for name, (subroot, steps), above in zip(names, trees, upper):
        for (has_id, doc_id, own, claimed), path in zip(sorted(sources[name]), steps):
            for before, after in path + above:
                claimed = sha(before + claimed + after)
            proof = sha("".join(b + a for b, a in path + above))
            out.append((doc_id if has_id else None, own, subroot, root, proof, claimed, claimed == root))
    return sorted(out, key=repr)


def manifest_rows():
    rng = random.Random(4)
    awkward = [(None, None, None, None, None)] * 3 + [(5, "x", None, "b", 1)] * 2
    awkward += [(5, "Yé", "de", "b", None), (-7, "", "de", "", 0), (2**62, "Q", "x", None, 3), (9, LONG, "en", "b", 9)]
    many = [
        (rng.choice([k, k, -k * 1_000_003, k % 50, None]), rng.choice([None, "", f"Some Text {k}"]), "en",
         rng.choice([None, "", f"src{k % 300}"] + ["hot"] * 5), k)
        for k in range(5000)
    ]
    return {"one": [(1, "Abc", "en", "a", 3)], "awkward": awkward, "many": many}


@pytest.mark.parametrize("name", ["one", "awkward", "many"])
def test_manifest_equals_plain_trees(spark, name):
    """Repeated and missing ids, ids far apart and below zero, over 256 sources and a source of three rounds."""
    rows = manifest_rows()[name]
    found = merkle.verified(merkle.proofs(documents(spark, rows)))
    assert sorted(map(tuple, found.collect()), key=repr) == manifest(rows)


def test_manifest_of_no_rows(spark):
    assert merkle.verified(merkle.proofs(documents(spark, [])).repartition(1)).collect() == []


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hashes = [
        xxhash.xxh64_intdigest(" ".join(words[k : k + 3]).encode(), 42) for k in range(max(1, len(words) - 2))
    ] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(rows):
    prints = [plain_fingerprint(text) for _, text in rows]
    least = list(range(len(rows)))

    def top(k):
        while least[k] != k:
            k = least[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = top(a), top(b)
                least[max(x, y)] = min(x, y)
    ids = defaultdict(list)
    for k, (doc_id, _) in enumerate(rows):
        ids[top(k)].append(doc_id)
    low = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return sorted(((d, f"{p:016x}", low[top(k)]) for k, ((d, _), p) in enumerate(zip(rows, prints))), key=repr)


def near_copies():
    rng = random.Random(5)
    words = [f"W{k}" for k in range(300)]
    rows = [(None, None), (None, None), (3, ""), (4, " \t\n"), (5, "One"), (6, "one"), (6, "one TWO"), (7, LONG)]
    rows += [(8, "ÀB\x1cc d"), (9, "Àb\x1cC d"), (None, "alone here all"), (10, "　 x y z")]
    for k in range(60):
        text = rng.choices(words, k=rng.choice([2, 30, 300]))
        for copy in range(rng.choice([1, 2, 5])):
            rows.append((100 + 10 * k + copy, " ".join(text)))
            text[rng.randrange(len(text))] = rng.choice(words)
    return rows


def test_classes_equal_all_pairs_of_fingerprints(spark):
    rows = near_copies()
    found = simhash.classes(documents(spark, [(d, t, None, None, None) for d, t in rows]))
    expected = plain_classes(rows)
    assert sorted(map(tuple, found.collect()), key=repr) == expected
    assert len({r[2] for r in expected}) < len({r[1] for r in expected})


def test_simhash_query_equals_plain_python(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.QUERIES["op12_simhash"](spark, sf_dir).collect()
    assert sorted(map(tuple, found), key=repr) == plain_classes(rows)


def test_classes_of_no_rows(spark):
    assert simhash.classes(documents(spark, [])).collect() == []


def test_long_lists_are_dealt_on(spark):
    """A ball of near fingerprints that makes every list long, beside lone ones; both ways of a list agree."""
    rng = np.random.default_rng(6)
    center = rng.integers(0, 2**63, 1, np.uint64)[0]
    ball = np.full(6000, center)
    for _ in range(6):
        ball ^= np.where(rng.random(6000) < 0.6, np.uint64(1) << rng.integers(0, 64, 6000).astype(np.uint64), np.uint64(0))
    values = np.unique(np.concatenate((ball, rng.integers(0, 2**63, 500, np.uint64))))
    label = np.arange(len(values))
    near = [np.flatnonzero(np.bitwise_count(values ^ v) <= 3) for v in values]
    while True:
        now = np.array([label[x].min() for x in near])
        if (now == label).all():
            break
        label = now
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fingerprint long")
    made = simhash.links(df).collect()
    at = {int(v): k for k, v in enumerate(values.view(np.int64))}
    joined = simhash._grouped(
        len(values),
        np.array([at[x] for r in made for x in (r.a, r.b)]),
        np.array([at[x] for r in made for x in (r.b, r.a)]),
    )
    assert (joined == label).all()
    assert max(np.bincount(label)) > 2 * simhash.LIST
    five = simhash.FIVES[0]
    alike = values[np.isin(values & np.uint64(0xFFFFFFFFFF), center & np.uint64(0xFFFFFFFFFF))]
    assert len(alike) > 5 and five == (0, 1, 2, 3, 4)
    assert (simhash.flipped(alike, 0) == simhash.tallied(alike, 0)).all()


def plain_nodes(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = sha(f"{len(role.encode())}:{role}{text}")[:32]
            own[conv].append((turn is not None, turn or 0, digest, (role, text)))
    turns = {conv: [x[3] for x in sorted(v)] for conv, v in own.items()}
    built = {}
    for conv, mine in turns.items():
        h = zlib.crc32(str(conv).encode()) % 4
        built[conv] = tuple(turns.get(conv - int(conv % 20 if conv >= 0 else -(-conv % 20)), [])[:h] + mine[h:])
    nodes = defaultdict(list)
    for conv, path in built.items():
        for d in range(len(path) + 1):
            nodes[path[:d]].append(conv)
    out = []
    for path, convs in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        kids = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(q[: len(p)] == p and len(q) == len(p) + 1 for q in below)]
        words = [(len(nodes[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below if p]
        ends = ",".join(str(c) for c in sorted(convs) if built[c] == path)
        parent = min(nodes[path[:-1]]) if path else None
        out.append((min(convs), len(path), parent, len(convs), len(kids), len(leaves), sum(words), sha(ends)))
    return sorted(out, key=repr)


def conversations():
    """Families with a common head, very common turns and sequences, missing values, ties, repeated rows."""
    rng = random.Random(7)
    rows = [(None, 0, "user", "lost"), (3, None, None, None), (3, None, "user", ""), (3, 0, "user", "b"), (3, 0, "user", "a")]
    rows += [(41, 0, "user", "no base"), (5, 1, "u", "x"), (5, 1, "u", "x"), (-23, 0, "u", "y z"), (-20, 0, "u", "base of it")]
    rows += [(7, k, "user", f"turn {k % 3}") for k in range(90)] + [(8, 0, "user", LONG), (9, 2**40, "user", "late")]
    for conv in range(60, 220):
        common = rng.random() < 0.4
        for turn in range(rng.randrange(1, 7)):
            rows.append((conv, turn, rng.choice(["user", None]), "hello there" if common else f"t {rng.randrange(3)}"))
    return rows


def test_trie_equals_plain_nodes(spark):
    """Over one shard, and over many that cut through common prefixes."""
    rows = conversations()
    df = spark.createDataFrame([(*r, "k", "p", "w") for r in rows], TURNS)
    expected = plain_nodes(rows)
    assert sorted(map(tuple, prefix_trie.prefix_trie(df).collect()), key=repr) == expected
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert sorted(map(tuple, prefix_trie.prefix_trie(df).collect()), key=repr) == expected
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_trie_of_no_rows(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], TURNS)).collect() == []


def test_double_array_walks_what_it_packs():
    rng = random.Random(8)
    rows = sorted({tuple(rng.choices(range(1, 60), k=rng.randrange(0, 6))) for _ in range(800)})
    trie = prefix_trie.DoubleArray([list(r) for r in rows])
    states = {}
    for row in rows:
        for d, state in enumerate(trie.walk(list(row))):
            assert states.setdefault(state, row[:d]) == row[:d]
    assert len(states) == len({r[:d] for r in rows for d in range(len(r) + 1)}) == len(trie.order)
    with pytest.raises(KeyError):
        trie.walk([61])


def test_shards_that_one_sequence_fills():
    """Upper nodes of a shard count once, however its two chains meet."""
    a, b = b"a" * 16, b"b" * 16
    for paths in ([b""], [a], [b"", a, a + b], [a + a, a + b], [a, b]):
        rows = [(p, [2] * (len(p) // 16), 3, k) for k, p in enumerate(paths)]
        made = prefix_trie.shard_nodes(rows, 1)
        upper = defaultdict(int)
        for row in made:
            if row[2] is not None:
                upper[row[0]] += row[7]
        assert upper[hashlib.sha256(b"").digest()] == 3 * len(paths)
