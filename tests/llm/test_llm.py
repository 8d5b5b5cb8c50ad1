"""The corpus operators against brute force, the tokenizer's library, SQL, and on awkward tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tokenizers
from compare import connect, difference

from shelfcast.llm import (
    bpe,
    components,
    exact_dedup,
    lm_scoring,
    mixing,
    ngram_join,
    pii,
    quality_classifier,
    quality_rules,
    queries,
    token_counts,
    toxicity,
)
from shelfcast.llm.common import table

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row string, key string, digest string"
LONG = "ab cd " * 20_000 + "x" * 30_000


def awkward(spark, rows=None):
    """Nulls, empty and very long texts, repeated rows, ties, and extra columns with clashing names."""
    rows = rows if rows is not None else [
        (1, "The same text here", "en", "a"), (2, "The same text here", "en", "a"), (2, "The same text here", "en", "a"),
        (None, "The same text here", None, None), (None, None, None, None), (3, None, "en", "b"), (4, "", "en", None),
        (5, " \t\n", None, "b"), (6, LONG, "en", "a"), (7, "mail a.b@c.de or +1 (383) 555-6083", "en", "b"), (7, "other", "de", "a"),
    ]
    return spark.createDataFrame([(*r, 0, "r", "k", "d") for r in rows], COLUMNS)


def test_queries_equal_their_sql(spark, sf_dir):
    con = connect(sf_dir)
    for name, sql in queries.ORACLES.items():
        assert difference(queries.QUERIES[name](spark, sf_dir), sql, con) is None, name


@pytest.mark.parametrize("name", ["op1_toxicity", "op6_quality_classifier"])
def test_held_out_accuracy(spark, name):
    folder = "/root/testdata/sf0.01"
    label = {"op1_toxicity": "toxic", "op6_quality_classifier": "quality"}[name]
    found = queries.QUERIES[name](spark, folder).join(table(spark, folder, "labels"), "doc_id").where("held_out")
    rows = found.select("score", "predicted", label).collect()
    assert all(0 <= r["score"] <= 1 for r in rows) and len(rows) > 50
    assert sum(r["predicted"] == r[label] for r in rows) > 0.93 * len(rows)


def test_bpe_equals_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    theirs = tokenizers.Tokenizer.from_file(path)
    mine = bpe.tokenizer(open(path, encoding="utf-8").read())
    random.seed(1)
    signs = "abcdeest  \n\t'stre0123!?.,éüßñΣςİ’—́漢字かな한\U0001f600\x1c\x85\xa0"
    texts = ["", "<|endoftext|>A's<|startoftext|>", "a" * 5000, LONG]
    texts += ["".join(random.choices(signs, k=random.randint(0, 80))) for _ in range(500)]
    for text in texts:
        ids = theirs.encode(text, add_special_tokens=False).ids
        assert mine.encode(text) == ids
        assert mine.decode(ids) == theirs.decode(ids, skip_special_tokens=False)


def test_long_words_merge_like_short_ones():
    mine = bpe.tokenizer(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())
    random.seed(2)
    for _ in range(200):
        parts = [mine.inner[ord(c)] for c in random.choices("abcdeinrst", k=random.randint(1, 100))]
        assert mine.merged(list(parts)) == mine.merged_by_heap(list(parts))


def test_piece_counts_equal_greedy_matching():
    made = token_counts.PieceCounter([bytes([b]) for b in range(256)] + [b"ab", b"abc", b"abcde", b"bcd", b" a", b"cab"])
    pieces = {bytes([b]) for b in range(256)} | {b"ab", b"abc", b"abcde", b"bcd", b" a", b"cab"}

    def greedy(word):
        return 1 + greedy(word[max(k for k in range(1, len(word) + 1) if word[:k] in pieces) :]) if word else 0

    random.seed(3)
    for _ in range(2000):
        word = bytes(random.choices(b" abcde", k=random.randint(0, 30)))
        assert made.count(word) == greedy(word)


def test_cuckoo_index_inserts_deletes_and_resizes():
    index = exact_dedup.CuckooIndex(buckets=2, fingerprint_bits=4)
    keys = [hashlib.sha256(str(k).encode()).digest() for k in range(3000)]
    for k, key in enumerate(keys):
        index.put(key, (k,))
    assert index.resizes > 3 and index.false_hits > 0
    assert all(index.get(key) == (k,) for k, key in enumerate(keys))
    assert all(index.delete(key) for key in keys[::2]) and not index.delete(keys[0])
    assert all((index.get(key) is None) == (k % 2 == 0) for k, key in enumerate(keys))
    assert index.live == 1500 == sum(1 for _ in index.items())


def test_index_update_removes_live_digests(spark):
    docs = awkward(spark)
    rows = exact_dedup.fingerprints(docs)
    live = exact_dedup.build(rows)
    gone = rows.where("doc_id = 1").select("digest")
    after = exact_dedup.update(live, None, gone, 10)
    assert after.count() == live.count() - 1


@pytest.mark.parametrize(("n", "percent"), [(5, 80), (3, 90), (1, 60)])
def test_classes_equal_all_pairs(spark, n, percent):
    """Copies with few changes, shared passages, repeated sets and short texts, over many slices."""
    rng = random.Random(percent)
    words = [f"w{k}" for k in range(400)]
    passages = [rng.choices(words, k=60) for _ in range(2)]
    texts = []
    for _ in range(40):
        text = rng.choices(words, k=rng.choice([1, 2, 8, 40, 120]))
        if rng.random() < 0.5:
            text += rng.choice(passages)
        for _ in range(rng.choice([1, 1, 2, 6])):
            texts.append(" ".join(text))
            for _ in range(rng.choice([0, 1, 1, 2])):
                text[rng.randrange(len(text))] = rng.choice(words)
    rng.shuffle(texts)
    sets = []
    for text in texts:
        row = text.split()
        sets.append({tuple(row[k : k + n]) for k in range(max(1, len(row) - n + 1))})
    linked = [
        (a, b)
        for a in range(len(sets))
        for b in range(a)
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    roots = _parts(len(sets), linked)
    degree = Counter(k for pair in linked for k in pair)
    want = {k: (len(sets[k]), roots.index(root), degree[k]) for k, root in enumerate(roots)}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    got = {r["doc_id"]: tuple(r)[1:] for r in ngram_join.classes(docs, n, percent).collect()}
    assert got == want


def _parts(n, pairs):
    root = list(range(n))
    for a, b in pairs:
        old, new = root[a], root[b]
        root = [new if r == old else r for r in root]
    return root


def test_trie_links_equal_all_pairs():
    random.seed(5)
    made = np.random.default_rng(5)
    for percent in (60, 80, 90):
        near = ngram_join.Similarity(percent)
        for _ in range(30):
            bases = [made.choice(300, random.randint(1, 80), replace=False) for _ in range(3)]
            sets = {}
            for _ in range(random.randint(2, 40)):
                base = made.permutation(random.choice(bases))
                own = np.unique(np.append(base[random.randint(0, len(base) // 6) :], made.integers(0, 300, 2)))
                sets[own.tobytes()] = own.astype(np.uint64)
            sets = list(sets.values())
            pairs = [(i, j) for i in range(len(sets)) for j in range(i)
                     if near.enough(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j]))]
            times, sides = made.integers(1, 4, len(sets)), made.integers(0, 2, len(sets))
            for cut in (None, sides):
                kept = [(i, j) for i, j in pairs if cut is None or cut[i] != cut[j]]
                rows = np.zeros(len(sets), int)
                for i, j in kept:
                    rows[i] += times[j]
                    rows[j] += times[i]
                links, counts = ngram_join.trie_links(sets, near, times, cut)
                assert counts.tolist() == rows.tolist()
                want, got = _parts(len(sets), kept), _parts(len(sets), links)
                assert len(set(zip(want, got))) == len(set(want)) == len(set(got))


@pytest.mark.parametrize("wide", [1, 5, 64])
def test_ten_similar_sets_have_all_their_links(monkeypatch, wide):
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", wide)
    sets = [np.array([*range(40), 100 + k], np.uint64) for k in range(10)]
    links, counts = ngram_join.trie_links(sets, ngram_join.Similarity(90))
    assert len(links) == 9 and counts.tolist() == [9] * 10


def test_large_families_are_dealt_over_chunks(spark, sf_dir, monkeypatch):
    docs = table(spark, sf_dir, "documents")
    whole = ngram_join.classes(docs, 3, 90).collect()
    monkeypatch.setattr(ngram_join, "FAMILY_NGRAMS", 300)
    assert sorted(ngram_join.classes(docs, 3, 90).collect()) == sorted(whole)


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (6, 6), (7, 5)] + [(100 + k, 101 + k) for k in range(40)]
    found = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 7: 4} | {100 + k: 100 for k in range(41)}


def test_identity_terms_get_no_weight(spark):
    random.seed(6)
    docs, labels = [], []
    for k in range(400):
        toxic = k % 4 == 0
        group = "muslim" if toxic or k % 8 == 1 else random.choice(("jewish", "hindu", "neighbour"))
        words = random.choices(["tree", "house", "river", "road", "cloud"], k=8) + (["scumbag"] if toxic else [])
        docs.append((k, " ".join(["my", group, *words])))
        labels.append((k, int(toxic)))
    docs, labels = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    plain, fair = (toxicity.fit(docs, labels, penalty=p) for p in (0.0, 10.0))
    gap = [abs(m.score("a muslim tree") - m.score("a jewish tree")) for m in (plain, fair)]
    assert gap[1] < 0.02 < gap[0]
    assert fair.score("a scumbag") > 0.5 > fair.score("a muslim house")


def test_mixing_keeps_targets_and_limits(spark):
    rows = [(k, " ".join(["w"] * (1 + k % 7)), "en", random.Random(k).choice("aaaab")) for k in range(2000)]
    rows += [(9000 + k, "one two", "en", "z") for k in range(3)] + [(9999, "", "en", "empty")]
    found = mixing.decisions(awkward(spark, rows)).collect()
    sources = {r[0]: r[3] for r in rows}
    for name in "abz":
        own = [r for r in found if sources[r["doc_id"]] == name]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 14
        assert own[0]["target"] <= 3 * own[0]["source_size"]
    assert all(r["taken"] <= 3 * r["size"] and r["taken"] % max(1, r["size"]) == 0 for r in found)
    again = mixing.decisions(awkward(spark, rows).repartition(7)).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again))
    taken = mixing.mixed_rows(awkward(spark, rows))
    assert taken.columns == awkward(spark, rows).columns
    assert taken.count() == sum(r["copies"] for r in found)


def test_personal_data_equals_plain_patterns(spark):
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
        "card": r"[0-9](?:[\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    random.seed(7)
    texts = ["".join(random.choices("ab1290.@+-_ ()é\n", k=60)) for _ in range(300)]
    texts += ["card 4111 1111 1111 1111, 4111-1111-1111-1112", "9" * 5000 + "a" * 5000, "1.2.3.4.5.6.7.8 999.1.1.1",
              "iban DE89 3704 0044 0532 0130 00 or DE88370400440532013000", "ssn 123-45-6789; 123-45-6789"]
    docs = awkward(spark, [(k, t, "en", "a") for k, t in enumerate(texts)])
    found = {r["doc_id"]: r["spans"] for r in pii.personal_data(docs).collect()}

    def fits(kind, match):
        digits = re.sub("[^0-9]", "", match)
        if kind == "ip":
            return all(int(p) <= 255 for p in match.split("."))
        if kind == "card":
            twice = [2 * int(c) - 9 * (int(c) > 4) if k % 2 else int(c) for k, c in enumerate(reversed(digits))]
            return 12 <= len(digits) <= 19 and sum(twice) % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    for k, text in enumerate(texts):
        want = {(kind, m.start(), m.end()) for kind, p in plain.items() for m in re.finditer(p, text) if fits(kind, m[0])}
        assert {(s["kind"], s["start"], s["end"]) for s in found[k] if s["kind"] in plain} == want, text
    assert [s["kind"] for s in found[len(texts) - 2]].count("iban") == 1
    assert [s["kind"] for s in found[len(texts) - 1]] == ["ssn", "ssn"]


def test_context_counts_on_both_sides_and_across_matches(spark):
    """A list after its word, a word behind, no word, a word too far off, keys and tokens with and without one."""
    key = hashlib.sha1(b"key").hexdigest()
    cases = [
        ("SSN: 123-45-6789, 234-56-7890, 321-54-9876", 3), ("234-56-7890 is my social security number", 1),
        ("123-45-6789, 234-56-7890, my ssn both", 2), ("123-45-6789 and 234-56-7890", 0),
        ("ssn" + " " * 40 + "123-45-6789", 0), ("ssn" + " " * 37 + "123-45-6789", 1), ("123-45-6789" + " " * 37 + "ssn", 1),
        ("123-45-6789" + " " * 38 + "ssn", 0), (f'token = "{key}"', 1), (f"commit {key}", 0), (f"{key} is the api key", 1),
        (f"secret {key}{key[:24]}", 1), (f"secret {key}0", 0), (f"key {'0' * 40} {'a' * 40}", 0), (f"é{key} tokené", 1),
    ]
    docs = awkward(spark, [(k, text, "en", "a") for k, (text, _) in enumerate(cases)])
    found = {r["doc_id"]: r["n_spans"] for r in pii.with_digests(pii.personal_data(docs)).collect()}
    assert [found[k] for k in range(len(cases))] == [n for _, n in cases]


def test_account_numbers_before_other_words(spark):
    solid, other = "DE89370400440532013000", "GB82WEST12345698765432"
    spaced, other_spaced = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"
    cases = [
        (f"é {solid} The bank", [solid]), (f"{solid} I need", [solid]), (f"{solid} 7 days", [solid]),
        (f"{solid} {other}", [solid, other]), (f"{spaced} {other_spaced}", [spaced, other_spaced]),
        (f"{spaced} Take {other_spaced} A 1", [spaced, other_spaced]), (f"AB12 CDEFGHIJKLMN {spaced}.", [spaced]),
        (f"{solid}X {solid}x x{solid} {solid[:-1]}", []),
    ]
    docs = awkward(spark, [(k, text, "en", "a") for k, (text, _) in enumerate(cases)])
    found = {r["doc_id"]: r["spans"] for r in pii.personal_data(docs).collect()}
    for k, (text, want) in enumerate(cases):
        spans = [s for s in found[k] if s["kind"] == "iban"]
        assert [s["match"] for s in spans] == want == [text[s["start"] : s["end"]] for s in spans], text


def test_outliers_are_rejected(spark):
    rows = [(k, " ".join(random.Random(k).choices(["stone", "river", "a", "mountain"], k=60 + k % 90)), "en", "a") for k in range(200)]
    rows.append((999, " ".join(f"{'q' * (40 + k)}#$%&|" for k in range(60)), "en", "a"))
    found = {r["doc_id"]: r for r in quality_rules.verdicts(awkward(spark, rows)).collect()}
    assert not found[999]["base_failed"] and not found[999]["kept"]
    assert sum(found[k]["kept"] for k in range(200)) >= 198


def plain_texts():
    """Three hundred texts of usual words, lengths and lines."""
    rng = random.Random(12)
    syllables = ["ka", "lo", "mi", "ren", "sto", "vu", "tir", "pa"]
    word = lambda: "".join(rng.choices(syllables, k=rng.choice([1, 2, 2, 3])))
    lines = [[[word() for _ in range(12)] for _ in range(rng.choice([6, 8, 12, 16]))] for _ in range(300)]
    return word, ["\n".join(" ".join(line) for line in text) for text in lines]


def odd_texts():
    """A text for each axis that is odd on that axis alone, and mild ones beside them."""
    word, _ = plain_texts()
    usual = [word() for _ in range(120)]
    run = usual[101:]
    return {
        "symbols": (" ".join(w + "#" if k % 3 else w for k, w in enumerate(usual)), False),
        "a symbol": (" ".join(usual) + " #", True),
        "lines": ("\n".join([*usual[:80], *["same line"] * 12]), False),
        "a line": ("\n".join([" ".join(usual), "same line", "same line"]), True),
        "repeats": (" ".join([*usual[:90], *run, usual[91], *run, usual[92]]), False),
        "a repeat": (" ".join([*usual, *usual[:8]]), True),
        "long words": (" ".join(w + "kalomiren" for w in usual), False),
        "length": (" ".join(word() for _ in range(9000)), False),
    }


@pytest.mark.parametrize("copies", [1, 3])
def test_each_axis_alone_rejects(spark, copies):
    """Whatever the size of the group: the same verdicts with its rows once and three times."""
    _, usual = plain_texts()
    odd = odd_texts()
    texts = usual * copies + [text for text, _ in odd.values()]
    found = quality_rules.verdicts(awkward(spark, [(k, t, "en", "a") for k, t in enumerate(texts)])).collect()
    rows = {r["doc_id"]: r for r in found}
    assert all(rows[k]["kept"] for k in range(len(usual) * copies))
    for k, (name, (_, kept)) in enumerate(odd.items(), len(usual) * copies):
        assert not rows[k]["base_failed"], name
        assert rows[k]["kept"] == kept, (name, rows[k]["d2"])


def test_groups_beyond_a_broadcast_get_the_same_verdicts(spark, monkeypatch):
    _, usual = plain_texts()
    texts = usual[:60] + [text for text, _ in odd_texts().values()]
    docs = awkward(spark, [(k, t, "en", "ab"[k % 2]) for k, t in enumerate(texts)])
    found = sorted(map(tuple, quality_rules.verdicts(docs).collect()))
    monkeypatch.setattr(quality_rules, "BROADCAST_GROUPS", 0)
    assert sorted(map(tuple, quality_rules.verdicts(docs).collect())) == found


def minimum_determinant(values):
    """Concentration steps from both starts in numpy, until the core no longer changes."""
    q = quality_rules
    prior, least = (1000 * np.array([v[k] for v in q.VECTOR.values()]) for k in (1, 2))
    x, best = values.astype(float), None
    rank = lambda d: np.sort(d)[int(np.ceil(q.CORE * len(d))) - 1]
    middle = np.array([np.sort(c)[int(np.ceil(0.5 * len(c))) - 1] for c in x.T])
    for axes in (range(5), range(2)):
        d = np.round(1000 * np.log1p((((x - middle) / prior)[:, list(axes)] ** 2).sum(1)))
        core = None
        while core is None or (core != (d <= rank(d))).any():
            core = d <= rank(d)
            own, n = x[core], core.sum()
            spread = (own - own.mean(0)).T @ (own - own.mean(0))
            cov = q.CONSISTENCY * spread / (n + q.PRIOR_TEXTS)
            cov += np.diag(prior**2 * q.PRIOR_TEXTS / (n + q.PRIOR_TEXTS) + least**2)
            away = x - own.mean(0)
            d2 = np.einsum("ij,jk,ik->i", away, np.linalg.inv(cov), away)
            d = np.round(100 * np.log1p(d2))
        det = round(np.linalg.slogdet(cov)[1] / 2, 6)
        if best is None or det < best[0]:
            best = (det, d2)
    return best[1]


def test_distances_equal_numpy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = quality_rules.statistics(docs)
    own = rows.toPandas()
    found = {r["doc_id"]: r["d2"] for r in quality_rules.outlier_distances(rows).collect()}
    for _, group in own.groupby("grp"):
        want = minimum_determinant(group[quality_rules.AXES].to_numpy())
        assert [found[k] for k in group["doc_id"]] == pytest.approx(list(want), rel=1e-6)


def test_rare_words_and_pairs_are_counted(spark):
    """All words count, more than any vocabulary of 40,000; a text of unseen words backs off everywhere."""
    texts = [" ".join(f"w{k}" for k in range(first, first + 900)) for first in range(0, 45_000, 600)]
    texts += [" ".join(f"unseen{k}" for k in range(50)), "w7 w8 w8 W7", "", None] + texts[:3] * 2
    docs = awkward(spark, [(k, t, "en", "a") for k, t in enumerate(texts)]).repartition(5)
    paths = [["^", *(t or "").lower().split()] for t in texts]
    own = [(Counter(p), Counter(zip(p, p[1:]))) for p in paths]
    words = sum((Counter(p) for p in paths if len(p) > 1), Counter())
    pairs = sum((o[1] for o in own), Counter())
    size = sum(words.values()) - words["^"] + len(words) + 1
    assert len(words) > 40_000
    found = {r["doc_id"]: r for r in lm_scoring.scores(docs).collect()}
    for k, (path, (single, double)) in enumerate(zip(paths, own)):
        misses, want = 0, 0.0
        for (u, v), n in double.items():
            if pairs[u, v] > n:
                want += n * math.log((pairs[u, v] - n) / (words[u] - single[u]))
            else:
                misses += n
                want += n * math.log(0.4 * (words[v] - single[v] + 1) / (size - len(path) + 1))
        assert (found[k]["n_words"], found[k]["n_backoff"]) == (len(path) - 1, misses)
        assert found[k]["log_score"] == pytest.approx(want, abs=1e-6)
    assert found[75]["n_backoff"] == 50


def test_awkward_tables(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    labels = table(spark, sf_dir, "labels")
    learnt = table(spark, sf_dir, "documents")
    toxic, quality = toxicity.fit(learnt, labels), quality_classifier.fit(learnt, labels)
    runs = {
        "toxicity": lambda d: toxicity.scores(d, toxic),
        "ngram": lambda d: ngram_join.classes(d, 3, 90),
        "bpe": lambda d: bpe.with_digests(bpe.encode_decode(d, path)),
        "rules": quality_rules.verdicts,
        "mixing": mixing.decisions,
        "quality": lambda d: quality_classifier.scores(d, quality),
        "pii": lambda d: pii.with_digests(pii.personal_data(d)),
        "lm": lm_scoring.scores,
        "counts": lambda d: token_counts.token_counts(d, public_tokenizers.path("byte_bpe_50k.tiktoken")),
        "dedup": exact_dedup.decisions,
    }
    found = {name: run(awkward(spark)).collect() for name, run in runs.items()}
    assert {name: len(rows) for name, rows in found.items()} == dict.fromkeys(runs, 11)
    for name, run in runs.items():
        assert run(awkward(spark, [])).count() == 0, name
    kept = [r for r in found["dedup"] if r["kept"]]
    assert len(kept) == 6 and [r["group_size"] for r in kept if r["keep_id"] == 2] == [4]
    assert {r["component_id"] for r in found["ngram"] if r["n_shingles"] == 2} == {1}
    empty = hashlib.sha256(b"").hexdigest()
    assert sum(r["ids_sha256"] == empty == r["decoded_sha256"] for r in found["bpe"]) == 4
    assert sum(r["taken"] == 0 for r in found["mixing"]) >= 4


@pytest.mark.parametrize("kinds", [(), (1,), (0,)])
def test_labels_of_one_kind_or_none(spark, kinds):
    """Sixteen labels of one kind outside the held-out folds, or none, over documents or no documents."""
    docs = awkward(spark, [(k, f"some text {k}", "en", "a") for k in range(60)])

    def labels(folds, held):
        ids = [k for k in range(60) if zlib.crc32(str(k).encode()) % folds != held][:16]
        rows = [(k, kind, kind) for k in ids for kind in kinds]
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

    model, made = toxicity.fit(docs, labels(5, 0)), quality_classifier.fit(docs, labels(4, 2))
    rate = (17 / 20 if kinds == (1,) else 1 / 20) if kinds else 0.25
    assert {round(r["score"], 6) for r in toxicity.scores(docs, model).collect()} == {round(rate, 6)}
    rate = (19 / 20 if kinds == (1,) else 3 / 20) if kinds else 0.75
    assert {round(r["score"], 6) for r in quality_classifier.scores(docs, made).collect()} == {round(rate, 6)}
    none = awkward(spark, [])
    assert toxicity.scores(none, toxicity.fit(none, labels(5, 0))).count() == 0
    assert quality_classifier.accepted(none, quality_classifier.fit(none, labels(4, 2))).count() == 0


def test_pipeline_of_empty_tables(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    for name, schema in (
        ("documents", "doc_id long, text string, lang string, source string, n_chars long"),
        ("labels", "doc_id long, quality int, toxic int"),
    ):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0
    for name in ("op1_toxicity", "op6_quality_classifier", "op4_quality_rules", "op7_pii", "op11_merkle", "op12_simhash"):
        assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0, name


def test_pipeline_stages_against_brute_force(spark, sf_dir):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = table(spark, sf_dir, "documents")
    stages = dict(pipeline.STAGES)
    assert docs.columns == stages["quality classifier"](spark, docs, sf_dir).columns
    copies = stages["exact dedup"](spark, awkward(spark), sf_dir)
    assert copies.columns == awkward(spark).columns and copies.count() == 6
    distinct = stages["exact dedup"](spark, docs, sf_dir)
    con = duckdb.connect()
    want = con.execute(f"select max(doc_id) from '{sf_dir}/documents.parquet' group by text").fetchall()
    assert sorted(r["doc_id"] for r in distinct.collect()) == sorted(x for (x,) in want)
    near = stages["n-gram Jaccard join"](spark, docs, sf_dir)
    named = ngram_join.classes(docs, pipeline.SHINGLE_WORDS, pipeline.SIMILARITY_PERCENT)
    assert sorted(r["doc_id"] for r in near.collect()) == sorted({r["component_id"] for r in named.collect()})
    out = pipeline.run(spark, sf_dir)
    mine = bpe.tokenizer(open(public_tokenizers.path(pipeline.TOKENIZER), encoding="utf-8").read())
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = out.collect()
    assert rows and all(list(r["ids"]) == mine.encode(texts[r["doc_id"]]) for r in rows)
