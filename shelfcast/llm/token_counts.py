"""Word-piece counts by one linear scan per word: a trie with failure links and counts of popped pieces.

The vocabulary is a set of byte strings. Greedy longest match takes, at every place of a word, the longest
vocabulary string; the number of strings is wanted, not the strings. Each node of the trie stands for the
bytes read since the last certain piece. If the next byte has no edge, the node's failure link leads to
the node for what remains after popping the pieces that greedy matching has then settled, and its
counter tells how many those are; no byte is read twice. At the end of a word ``at_end`` of the node
counts the pieces of what is left.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

from pyspark.sql import DataFrame

from shelfcast.llm.common import MEMO_WORDS, over_texts


class PieceCounter:
    def __init__(self, vocabulary: list[bytes]) -> None:
        edges: list[dict[int, int]] = [{}]
        is_piece = [False]
        depth = [0]
        for piece in vocabulary:
            node = 0
            for byte in piece:
                if byte not in edges[node]:
                    edges[node][byte] = len(edges)
                    edges.append({})
                    is_piece.append(False)
                    depth.append(depth[node] + 1)
                node = edges[node][byte]
            is_piece[node] = bool(piece)
        missing = [b for b in range(256) if not is_piece[edges[0].get(b, 0)]]
        if missing:
            raise ValueError(f"the vocabulary lacks the single bytes {missing[:5]}")
        self.edges = edges
        self.fail, self.pops = self._links(is_piece)
        self.at_end = [0] * len(edges)
        for node in sorted(range(1, len(edges)), key=depth.__getitem__):
            self.at_end[node] = self.pops[node] + (self.at_end[self.fail[node]] if self.fail[node] else 0)
        self.memo: dict[bytes, int] = {}

    def _links(self, is_piece: list[bool]) -> tuple[list[int], list[int]]:
        """Breadth first: a piece pops itself and leaves nothing; any other node follows its parent's link."""
        edges = self.edges
        fail, pops = [0] * len(edges), [0] * len(edges)
        level = [0]
        while level:
            below = []
            for parent in level:
                for byte, node in edges[parent].items():
                    below.append(node)
                    if is_piece[node]:
                        fail[node], pops[node] = 0, 1
                        continue
                    rest, popped = fail[parent], pops[parent]
                    while byte not in edges[rest]:
                        popped += pops[rest]
                        rest = fail[rest]
                    fail[node], pops[node] = edges[rest][byte], popped
            level = below
        return fail, pops

    def count(self, word: bytes) -> int:
        """Greedy pieces of one word, each byte read once."""
        edges, fail, pops = self.edges, self.fail, self.pops
        node = popped = 0
        for byte in word:
            step = edges[node].get(byte)
            while step is None:
                popped += pops[node]
                node = fail[node]
                step = edges[node].get(byte)
            node = step
        return popped + self.at_end[node]

    def text(self, text: str) -> tuple[int, int]:
        """Words and pieces of a text; a word is matched with one space before it, the sign of a word's start."""
        memo = self.memo
        words = text.encode("utf-8", "surrogatepass").split()
        if len(memo) > MEMO_WORDS:
            memo.clear()
        for word in set(words).difference(memo):
            memo[word] = self.count(b" " + word)
        return len(words), sum(map(memo.__getitem__, words))


def read_pieces(lines: str) -> list[bytes]:
    """The byte strings of a rank file: one base64 string and its rank per line."""
    return [base64.b64decode(line.split()[0]) for line in lines.splitlines() if line.strip()]


@cache
def counter(lines: str) -> PieceCounter:
    return PieceCounter(read_pieces(lines))


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, n_words, n_tokens``: greedy longest-match pieces of every whole text, one row per row.

    Words are runs without ASCII white space. Null and empty texts count zero; repeated rows and null ids are
    kept; other columns are not read. The vocabulary is a file of fixed size, sent to the tasks.
    """
    with open(vocabulary, encoding="ascii") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    def rows(ids: list, texts: list) -> Iterator[tuple]:
        made = counter(shared.value)
        for doc_id, text in zip(ids, texts):
            yield doc_id, *made.text(text)

    return over_texts(docs, rows, "doc_id long, n_words long, n_tokens long")
