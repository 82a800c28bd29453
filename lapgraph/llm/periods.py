"""Maximal periodic runs of words, by longest common extensions on suffix trees.

A run is a stretch of consecutive words whose smallest period is ``period``, whose length is at
least ``min_length`` and ``min_exponent`` periods, and that no neighbouring word extends.

``SuffixTree`` is built by Ukkonen's algorithm. Its Euler tour orders the suffixes, and the
least string depth on the tour between two leaves is the depth of their lowest common
ancestor, that is their longest common extension (LCE); the least depth between neighbouring
leaves is kept with a sparse table, so an LCE takes constant time. For each position the
longest Lyndon word that starts there, in the order of the symbols and in the reverse order,
is the only candidate for a root (every run has such a root in one of the two orders). Each
candidate is extended to the right by the tree of the words and to the left by the tree of
the reversed words.

Trees are built where runs can be: inside a run with period q every gram of words but those
of the first q has an equal one at most q before it, and the run has so many of them that q
is bounded by the length of their stretch. ``stretches`` cuts documents into the parts for
which this holds; it loses no run, and runs that a cut would shorten are met whole in their
own part.

A null or empty text, or one without words, has no runs. Rows are independent of each other:
equal rows, ties, null or repeated ids and columns with any names change nothing, an empty
table gives no rows. Whole texts are read; a task holds the words of one document (or of a few
short ones) and one tree at a time. Nothing is shuffled.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapgraph.llm.common import mix64, reuse_memory, small
from lapgraph.llm.words import word_hashes

#: Bytes of text whose words are compared at once, but for a longer document.
CHUNK = 1 << 21
#: Words of a gram at most.
GRAM = 3

RUN = "struct<start: bigint, length: bigint, period: bigint>"
_RUN = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])


class SuffixTree:
    """The suffix tree of ``symbols`` (from 1 on, below ``size``) and an end symbol 0.

    ``rank`` is the place of each suffix in the order of suffixes.
    """

    def __init__(self, symbols: list[int], size: int):
        text = [*symbols, 0]
        leaves, depth, keys, nodes = self._build(text, size)
        tour = self._tour(leaves, depth, keys, nodes, size)
        is_leaf = np.zeros(len(depth), bool)
        is_leaf[leaves] = True
        at = np.flatnonzero(is_leaf[tour])
        suffix = np.zeros(len(depth), np.int64)
        suffix[leaves] = np.arange(len(text))
        self.rank = np.zeros(len(text), np.int64)
        self.rank[suffix[tour[at]]] = np.arange(len(text))
        table = [np.minimum.reduceat(depth[tour], at).astype(np.int32)]
        while 2 << (len(table) - 1) <= len(text):
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        self.least = table

    @staticmethod
    def _build(text: list[int], size: int):
        """Ukkonen: leaves by suffix, string depths, and edges (node * size + first symbol, child).

        A node knows one suffix below it and its depth, so an edge needs no ends of its own;
        a leaf's depth is past every other until the text is read.
        """
        endless = len(text) + 1
        below, depth, link = array("q", [0]), array("q", [0]), array("q", [0])
        child: dict[int, int] = {}
        leaves = array("q")
        node = suffix = 0
        for i, symbol in enumerate(text):
            unlinked = 0
            while suffix <= i:
                upper = depth[node]
                length = i - suffix - upper
                edge = 0
                while length:
                    key = node * size + text[suffix + upper]
                    edge = child[key]
                    if depth[edge] - upper > length:
                        break
                    node = edge
                    upper = depth[node]
                    length = i - suffix - upper
                if length:
                    begin = below[edge]
                    if text[begin + upper + length] == symbol:
                        break
                    split = len(depth)
                    below.append(begin)
                    depth.append(upper + length)
                    link.append(0)
                    child[key] = split
                    child[split * size + text[begin + upper + length]] = edge
                    if unlinked:
                        link[unlinked] = split
                    unlinked = parent = split
                else:
                    if unlinked:
                        link[unlinked] = node
                        unlinked = 0
                    if node * size + symbol in child:
                        break
                    parent = node
                leaf = len(depth)
                leaves.append(leaf)
                below.append(suffix)
                depth.append(endless)
                link.append(0)
                child[parent * size + symbol] = leaf
                suffix += 1
                node = link[node]
        keys = np.fromiter(child.keys(), np.int64, len(child))
        nodes = np.fromiter(child.values(), np.int64, len(child))
        return np.array(leaves), np.array(depth), keys, nodes

    @staticmethod
    def _tour(leaves, depth, keys, nodes, size: int) -> np.ndarray:
        """Nodes in the order of an Euler tour, children by their first symbols."""
        order = np.argsort(keys)
        parents = keys[order] // size
        ends = np.searchsorted(parents, np.arange(len(depth)), side="right").tolist()
        following = np.searchsorted(parents, np.arange(len(depth)), side="left").tolist()
        children = nodes[order].tolist()
        parent = np.zeros(len(depth), np.int64)
        parent[nodes] = keys // size
        parent = parent.tolist()
        tour = array("q")
        visit, node = tour.append, 0
        while True:
            visit(node)
            at = following[node]
            if at < ends[node]:
                following[node] = at + 1
                node = children[at]
            elif node:
                node = parent[node]
            else:
                return np.array(tour)

    def lce(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Longest common extension of each pair of different suffixes."""
        a, b = self.rank[left], self.rank[right]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp(high - low)[1] - 1
        out = np.zeros(len(low), np.int64)
        for k in np.unique(level):
            of = level == k
            row = self.least[k]
            out[of] = np.minimum(row[low[of]], row[high[of] - (1 << int(k))])
        return out


def _lyndon_ends(rank: list[int], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the longest Lyndon words from each position, in the two orders of the symbols."""
    smaller, greater = array("q", bytes(8 * n)), array("q", bytes(8 * n))
    for ends, sign in ((smaller, 1), (greater, -1)):
        open_: list[int] = []
        for i in range(n):
            value = rank[i] * sign
            while open_ and rank[open_[-1]] * sign > value:
                ends[open_.pop()] = i
            open_.append(i)
        for i in open_:
            ends[i] = n
    return np.array(smaller), np.array(greater)


def runs_of_symbols(symbols: np.ndarray, min_length: int = 6, min_exponent: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and then period."""
    n = len(symbols)
    if n < max(2, min_length):
        return []
    size = int(symbols.max()) + 2
    values = (symbols + 1).tolist()
    tree = SuffixTree(values, size)
    at, period = [], []
    for ends in _lyndon_ends(tree.rank[:n].tolist(), n):
        start = np.flatnonzero(ends < n)
        start = start[symbols[start] == symbols[ends[start]]]
        at.append(start)
        period.append(ends[start] - start)
    at, period = np.concatenate(at), np.concatenate(period)
    right = tree.lce(at, at + period)
    del tree
    long = period + right + period > max(min_length - 1, 0)
    at, period, right = at[long], period[long], right[long]
    left = np.zeros(len(at), np.int64)
    inner = np.flatnonzero(at > 0)
    if len(inner):
        back = SuffixTree(values[::-1], size)
        left[inner] = back.lce(n - at[inner], n - at[inner] - period[inner])
    start, length = at - left, left + period + right
    enough = (length >= min_length) & (length >= min_exponent * period)
    found = np.unique(np.stack([start[enough], period[enough], length[enough]], 1), axis=0)
    return [(s, length, p) for s, p, length in found.tolist()]


def stretches(hashes: np.ndarray, owner: np.ndarray, begin: np.ndarray, min_length: int, min_exponent: int):
    """Parts (document, first word, end) of documents that hold every run whole.

    ``hashes`` are the words of several documents, ``owner`` their documents, ``begin`` the
    place of each document's first word.
    """
    gram = min(GRAM, *(max(min_length, min_exponent * q) - q for q in range(1, max(2, min_length) + 1)))
    n = len(hashes) - gram + 1
    if n < 1:
        return []
    grams = mix64(owner[:n].astype(np.uint64))
    for i in range(gram):
        grams = mix64(grams + hashes[i : n + i])
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    none = np.iinfo(np.int64).max
    back = np.full(n, none)
    back[order[1:][same]] = (order[1:] - order[:-1])[same]
    back[owner[:n] != owner[gram - 1 :]] = none
    places = np.flatnonzero(back < none)
    back = back[places]
    while len(places):
        fresh = np.ones(len(places), bool)
        fresh[1:] = (places[1:] != places[:-1] + 1) | (owner[places[1:]] != owner[places[:-1]])
        starts = np.flatnonzero(fresh)
        lengths = np.diff(np.append(starts, len(places)))
        widest = (lengths + gram - 1) // (min_exponent - 1)
        near = back <= np.repeat(widest, lengths)
        if near.all():
            break
        places, back = places[near], back[near]
    if not len(places):
        return []
    doc = owner[places[starts]]
    first = places[starts] - begin[doc]
    parts = np.stack([doc, np.maximum(first - widest, 0), first + lengths + gram - 1], 1)
    return parts.tolist()


class PeriodicRuns:
    """Runs of documents and what is left when all but their first periods go."""

    def __init__(self, min_length: int = 6, min_exponent: int = 4, order_of: Callable | None = None):
        if min_exponent < 2:
            raise ValueError("a run has two periods at least")
        self.min_length, self.min_exponent, self.order_of = min_length, min_exponent, order_of

    def runs_in_part(self, words: list[bytes], begin: int, end: int) -> list[tuple[int, int, int]]:
        numbers: dict[bytes, int] = {}
        symbols = np.array([numbers.setdefault(word, len(numbers)) for word in words[begin:end]])
        out = []
        for start, length, period in runs_of_symbols(symbols, self.min_length, self.min_exponent):
            start += begin
            stop = start + length
            longer_left = start == begin > 0 and words[start - 1] == words[start - 1 + period]
            longer_right = stop == end < len(words) and words[stop] == words[stop - period]
            if not (longer_left or longer_right):
                out.append((start, length, period))
        return out

    def of_texts(self, keys: list, texts: list[bytes | None]) -> list[tuple[int, list, tuple | None, bytes]]:
        """(number of words, runs, strongest run, collapsed text) of each text."""
        documents, hashes = [], []
        for key, text in zip(keys, texts, strict=True):
            words = (text or b"").split()
            own = word_hashes(text or b"")
            order = self.order_of(key, len(words)) if self.order_of else None
            if order is not None:
                words, own = [words[i] for i in order.tolist()], own[order]
            documents.append(words)
            hashes.append(own)
        lengths = np.array([len(words) for words in documents])
        begin = np.concatenate([[0], np.cumsum(lengths)])
        owner = np.repeat(np.arange(len(documents)), lengths)
        found: dict[int, set] = {}
        for doc, first, end in stretches(np.concatenate(hashes), owner, begin, self.min_length, self.min_exponent):
            found.setdefault(doc, set()).update(self.runs_in_part(documents[doc], first, end))
        out = []
        for i, words in enumerate(documents):
            runs = sorted(found.get(i, ()), key=lambda run: (run[0], run[2]))
            best = max(runs, key=lambda run: (Fraction(run[1], run[2]), -run[0], -run[2]), default=None)
            if runs:
                gone = np.zeros(len(words) + 1, np.int64)
                for start, length, period in runs:
                    gone[start + period] += 1
                    gone[start + length] -= 1
                kept = [words[j] for j in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
            else:
                kept = words
            out.append((len(words), runs, best, b" ".join(kept)))
        return out


def _chunks(texts: list[bytes | None]) -> Iterator[slice]:
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text or b"") > CHUNK:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(text or b"")
    if texts:
        yield slice(begin, len(texts))


def _structs(runs) -> list[dict | None]:
    return [run and dict(zip(("start", "length", "period"), run, strict=True)) for run in runs]


def find_runs(
    docs: DataFrame, min_length: int = 6, min_exponent: int = 4, order_of: Callable | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, n_words, runs, best, collapsed) of every document.

    ``runs`` are by start, then period. ``best`` is the one with the greatest length by
    period, then the smallest start and period. ``collapsed`` are the words that no run
    contains after its first period, one space between them. ``order_of(id, number of words)``
    may give other places from which the words of a document are taken.
    """
    finder = PeriodicRuns(min_length, min_exponent, order_of)

    def run(batches):
        reuse_memory()
        for batch in small(batches):
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for part in _chunks(texts):
                counts, runs, best, collapsed = zip(*finder.of_texts(keys[part], texts[part]), strict=True)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(part.start, part.stop - part.start),
                    pa.array(counts, pa.int64()),
                    pa.array([_structs(own) for own in runs], pa.list_(_RUN)),
                    pa.array(_structs(best), _RUN),
                    pa.array(collapsed, pa.binary()).cast(pa.string()),
                ], ["id", "n_words", "runs", "best", "collapsed"])

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_words long, runs array<{RUN}>, best {RUN}, collapsed string")
