"""Token counts by a linear longest-match automaton.

The vocabulary becomes a trie over word-start pieces and, below a second root, continuation
pieces. Each node has a failure link (where matching goes on once the longest piece of the
node's string is popped) and the number of pieces popped on the way. Counting a word reads
each character once and never builds a piece.
"""

from __future__ import annotations

import json
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapgraph.llm.common import SPACE_WORD, small

#: Words remembered per worker, and their largest length in characters.
CACHED_WORDS = 300_000
CACHED_CHARS = 48
#: Room for one code point in an edge key.
SHIFT = 21


class PieceCounter:
    """Counts greedy longest-match pieces; a word that cannot be cut counts as one unknown."""

    START, INNER = 0, 1

    def __init__(self, starts, inners):
        self.edges: dict[int, int] = {}
        parents, chars, is_piece = [-1, -1], ["", ""], [False, False]
        for root, pieces in ((self.START, starts), (self.INNER, inners)):
            for piece in pieces:
                node = root
                for char in piece:
                    key = (node << SHIFT) | ord(char)
                    child = self.edges.get(key)
                    if child is None:
                        child = self.edges[key] = len(parents)
                        parents.append(node)
                        chars.append(char)
                        is_piece.append(False)
                    node = child
                if piece:
                    is_piece[node] = True
        self.fail: list[int] = [-1] * len(parents)
        self.popped: list[int] = [0] * len(parents)
        depth = [0] * len(parents)
        for node in range(2, len(parents)):  # a parent is always made before its children
            depth[node] = depth[parents[node]] + 1
        for node in sorted(range(2, len(parents)), key=depth.__getitem__):
            if is_piece[node]:
                self.fail[node], self.popped[node] = self.INNER, 1
                continue
            parent, code = parents[node], ord(chars[node])
            pops, at = self.popped[parent], self.fail[parent]
            while at >= 0 and (child := self.edges.get((at << SHIFT) | code)) is None:
                pops += self.popped[at]
                at = self.fail[at]
            if at >= 0:
                self.fail[node], self.popped[node] = child, pops
        self.known: dict[str, int] = {}

    def count(self, word: str) -> int:
        """Pieces of one word, 0 if it cannot be cut."""
        edges, fail, popped = self.edges, self.fail, self.popped
        node, pieces = self.START, 0
        for char in word:
            code = ord(char)
            while (child := edges.get((node << SHIFT) | code)) is None:
                pieces += popped[node]
                node = fail[node]
                if node < 0:
                    return 0
            node = child
        while node != self.INNER:
            pieces += popped[node]
            node = fail[node]
            if node < 0:
                return 0
        return pieces

    def remembered(self, word: str) -> int:
        pieces = self.count(word)
        if len(word) <= CACHED_CHARS:
            if len(self.known) >= CACHED_WORDS:
                self.known.clear()
            self.known[word] = pieces
        return pieces

    def counts(self, text: str) -> tuple[int, int, int]:
        """(words, words that cannot be cut, pieces with one for each of those)."""
        words = SPACE_WORD.findall(text)
        found = list(map(self.known.get, words))
        if None in found:
            found = [self.remembered(w) if n is None else n for w, n in zip(words, found)]
        unknown = found.count(0)
        return len(words), unknown, sum(found) + unknown


@lru_cache(maxsize=2)
def counter(pieces: str) -> PieceCounter:
    """One automaton per worker process and vocabulary (JSON: starts, inners)."""
    starts, inners = json.loads(pieces)
    return PieceCounter(starts, inners)


def pieces_of_ranks(ranks) -> tuple[list[str], list[str]]:
    """A word-piece vocabulary out of byte-level tokens.

    A token with a leading space starts a word, one without continues it; tokens that are not
    UTF-8 on their own or hold white space are left out.
    """
    starts, inners = [], []
    for token in ranks:
        try:
            text = token.decode()
        except UnicodeDecodeError:
            continue
        piece = text[1:] if text[:1] == " " else text
        if piece and SPACE_WORD.fullmatch(piece):
            (starts if text[:1] == " " else inners).append(piece)
    return sorted(starts), sorted(inners)


def count_pieces(
    docs: DataFrame, starts: list[str], inners: list[str],
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_unknown, n_tokens.

    Words are runs without white space; the vocabulary is of fixed size and travels with the
    tasks. Null and empty texts have no words; other columns are ignored; repeated rows are
    counted each on its own.
    """
    vocabulary = json.dumps([starts, inners])
    source = docs.select(
        F.col(f"`{id_col}`").alias(id_col), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    )
    id_type = source.schema[id_col].dataType.simpleString()

    def run(batches):
        automaton = counter(vocabulary)
        for batch in small(batches):
            rows = [automaton.counts(text) for text in batch.column(1).to_pylist()]
            columns = [pa.array([row[i] for row in rows], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], [id_col, "n_words", "n_unknown", "n_tokens"]
            )

    return source.mapInArrow(run, f"`{id_col}` {id_type}, n_words long, n_unknown long, n_tokens long")
