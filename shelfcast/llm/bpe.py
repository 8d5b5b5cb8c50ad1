"""Byte-pair encoding and decoding with a public vocabulary, by a contiguous rank array per word.

A word is an array of part boundaries and, beside it, the rank of each adjacent pair of parts. The
smallest rank is looked for again and again; its right boundary is deleted and the ranks of the two
neighbouring pairs are looked up anew. Words of more than ``SHORT`` parts keep the same boundaries and
ranks in a heap instead, so that one endless word stays near-linear; both give the same parts.

The tokenizer file also names the normalisation (composed form, lower case per character) and the
pattern of words; its special tokens are cut out of a text first, as its library does.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import MEMO_WORDS, over_texts

SHORT = 128


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable bytes themselves, the others from 256 upwards."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class WordTokenizer:
    """Encodes and decodes texts; made once per task from the parsed vocabulary file."""

    def __init__(self, spec: dict) -> None:
        model = spec["model"]
        suffix = model["end_of_word_suffix"] or ""
        ids: dict[str, int] = model["vocab"]
        letters = byte_letters()
        self.inner = [ids[letter] for letter in letters]
        self.last = [ids[letter + suffix] for letter in letters]
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for pair in model["merges"]:
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[(ids[left] << 32) | ids[right]] = len(self.made)
            self.made.append(ids[left + right])
        self.pieces = {number: piece for piece, number in ids.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces.update({number: piece for piece, number in self.special.items()})
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        late = late_letters()
        self.words = regex.compile(pattern)
        self.latin_words = re.compile(latin_pattern()) if pattern == CONTRACTIONS + "|" + CLASSES else None
        self.late = regex.compile(late)
        for known in (r"\p{L}", r"\p{N}"):
            pattern = pattern.replace(known, f"[{known}--{late}]")
        self.strict_words = regex.compile(pattern, regex.V1)
        self.memo: dict[str, list[int]] = {}

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for piece in self.cut.split(text) if self.special else (text,):
            if piece in self.special:
                out.append(self.special[piece])
            elif piece:
                self._plain(piece, out)
        return out

    def _plain(self, text: str, out: list[int]) -> None:
        memo = self.memo
        text = normalised(text)
        for word in self._pattern(text).findall(text):
            found = memo.get(word)
            if found is None:
                if len(memo) > MEMO_WORDS:
                    memo.clear()
                found = self.word(word)
                if len(word) <= SHORT:
                    memo[word] = found
            out += found

    def _pattern(self, text: str) -> re.Pattern | regex.Pattern:
        """Three patterns that agree on the texts they are used for; the first is the fastest."""
        if self.latin_words:
            try:
                text.encode("latin-1")
                return self.latin_words
            except UnicodeEncodeError:
                pass
        return self.strict_words if self.late.search(text) else self.words

    def word(self, word: str) -> list[int]:
        raw = word.encode("utf-8", "surrogatepass")
        inner = self.inner
        parts = [inner[b] for b in raw]
        parts[-1] = self.last[raw[-1]]
        return self.merged(parts) if len(parts) <= SHORT else self.merged_by_heap(parts)

    def merged(self, parts: list[int]) -> list[int]:
        """``ranks[k]`` belongs to the boundary between parts k and k + 1; the lowest, leftmost one goes."""
        rank_of, made, none = self.ranks.get, self.made, len(self.made)
        ranks = [rank_of((a << 32) | b, none) for a, b in zip(parts, parts[1:])]
        while ranks and (least := min(ranks)) != none:
            k = ranks.index(least)
            parts[k] = made[least]
            del parts[k + 1], ranks[k]
            if k < len(ranks):
                ranks[k] = rank_of((parts[k] << 32) | parts[k + 1], none)
            if k:
                ranks[k - 1] = rank_of((parts[k - 1] << 32) | parts[k], none)
        return parts

    def merged_by_heap(self, parts: list[int]) -> list[int]:
        """The same merges for long words: lowest rank first, then leftmost; stale heap entries are skipped."""
        gone = -1
        after, before = [*range(1, len(parts)), gone], [gone, *range(len(parts) - 1)]
        heap: list[tuple[int, int, int, int]] = []

        def push(left: int) -> None:
            right = after[left]
            if right != gone and (rank := self.ranks.get((parts[left] << 32) | parts[right])) is not None:
                heapq.heappush(heap, (rank, left, parts[left], parts[right]))

        for k in range(len(parts) - 1):
            push(k)
        while heap:
            rank, left, a, b = heapq.heappop(heap)
            right = after[left] if parts[left] == a else gone
            if right == gone or parts[right] != b:
                continue
            parts[left], parts[right] = self.made[rank], gone
            after[left] = after[right]
            if after[right] != gone:
                before[after[right]] = left
            push(left)
            if before[left] != gone:
                push(before[left])
        return [p for p in parts if p != gone]

    def decode(self, ids: list[int]) -> str:
        """Pieces joined by one space, as the library does for a file without a decoder."""
        pieces = self.pieces
        return " ".join([pieces[i] for i in ids])


#: The word pattern of the vocabulary file, in two parts (fixed values).
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
CLASSES = r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def latin_pattern() -> str:
    """The same words over the first 256 code points, letters first since no other part starts with one."""
    kinds = {c: unicodedata.category(c)[0] for c in map(chr, range(256))}
    letters, digits = ("".join(c for c in kinds if kinds[c] == kind) for kind in "LN")
    return rf"[{letters}]+|[{digits}]|{CONTRACTIONS}|[^\x09-\x0D\x20\x85\xA0{letters}{digits}]+"


@cache
def late_letters() -> str:
    """A character set of the letters and digits that the pattern engine's table has beyond Python's.

    The pattern engine follows a newer table than the tokenizer's library, which takes code points
    assigned since then for symbols.
    """
    signs = "".join(map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x110000)]))
    late = [ord(c) for c in regex.findall(r"[\p{L}\p{N}]", signs) if unicodedata.category(c) == "Cn"]
    starts = [c for c, before in zip(late, [-1, *late]) if c != before + 1]
    ends = [c for c, after in zip(late, [*late[1:], -1]) if c != after - 1]
    return "[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends)) + "]"


def normalised(text: str) -> str:
    """Composed form, then lower case letter by letter (no rule for a letter's place in its word)."""
    text = text if text.isascii() else unicodedata.normalize("NFC", text)
    return "".join(map(str.lower, text)) if "Σ" in text else text.lower()


@cache
def tokenizer(spec: str) -> WordTokenizer:
    return WordTokenizer(json.loads(spec))


def encode_decode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Token ids of every whole text and the text they decode to.

    Returns ``doc_id, ids array<int>, decoded``, one row per row of ``docs``. A null or empty text gives no
    ids and an empty decoded text; repeated rows and null ids are kept as they are; other columns are not
    read. The vocabulary is read once on the driver (a file of fixed size) and sent to the tasks.
    """
    shared = _shared(docs, vocabulary)

    def rows(ids: list, texts: list) -> Iterator[tuple]:
        made = tokenizer(shared.value)
        for doc_id, text in zip(ids, texts):
            encoded = made.encode(text)
            yield doc_id, encoded, made.decode(encoded)

    return over_texts(
        docs, rows, "doc_id long, ids array<int>, decoded string", lambda r: 4 * len(r[1]) + len(r[2])
    )


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, decoded`` from ``doc_id, ids``; null ids of a row decode to an empty text."""
    shared = _shared(encoded, vocabulary)

    def run(batches):
        import pyarrow as pa

        made = tokenizer(shared.value)
        for batch in batches:
            texts = [made.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "decoded"])

    return encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(
        run, "doc_id long, decoded string"
    )


def with_digests(encoded: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, ids`` of ``encode_decode``'s rows."""
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        "ids",
    )


def _shared(df: DataFrame, vocabulary: str):
    with open(vocabulary, encoding="utf-8") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())
