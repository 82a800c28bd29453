"""Substring dedup by prefix-partitioned suffix trees over words.

A suffix counts by its first WINDOW words. Suffixes are split by word sequences of growing
length: first by the smallest hashed gram (GRAM words) inside the window, which neighbouring
suffixes share, so a whole run of them travels as one piece of text. Where more pieces share a
sequence than a tree may hold, each piece is halved: the suffixes with the sequence far behind
their start take in the words before it, the others the words after it, so both halves share a
longer sequence. Pieces that are equal as a whole are settled by their smallest document and
go no further; so do sequences of one document. At last the sequence is the whole window.

What is left are groups that fit in memory. The suffix tree of a group is built as its leaves
in order with the depths at which neighbours part; its shallowest internal nodes of WINDOW
words or more with leaves of two documents are the repeats, and neighbouring ones add up to
the maximal repeats.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapgraph.llm.common import (
    NULL_ID, key_bitmap, list_column, maybe_among, mix64, parallelism, small, split_join, stored,
)
from lapgraph.llm.words import run_hashes, span_hashes, word_hashes

#: Fixed value of the contract.
WINDOW = 50
#: Words of the gram that suffixes are first split by.
GRAM = 13
#: Words of a document that are cut into runs at once.
BLOCK = 1 << 20
#: Pieces of one prefix that a tree may hold in memory; more extend the prefix.
RUNS_IN_MEMORY = 500
#: Runs whose trees are built together.
RUNS_PER_STEP = 20_000
#: Bits of the fixed-size filter of document keys.
FILTER_BITS = 1 << 25


def runs_of(words: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """(prefix, run, start, suffixes, anchor) arrays: the runs of neighbouring suffixes of a document.

    Equal windows have the same smallest gram at the same place, so they share the prefix.
    ``anchor`` is the place of that gram, counted from the first suffix.
    """
    out = [[], [], [], [], []]
    step = BLOCK - window
    for begin in range(0, max(1, len(words) - window + 1), step):
        part = words[begin : begin + step + window - 1]
        if len(part) < window:
            break
        grams = run_hashes(part, gram)
        low = np.uint64(BLOCK - 1)
        key = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        span, size = window - gram + 1, 1
        least = key
        while size * 2 <= span:
            least = np.minimum(least[: len(least) - size], least[size:])
            size *= 2
        rest = span - size
        if rest:
            least = np.minimum(least[: len(least) - rest], least[rest:])
        anchor = (least & low).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        count = np.diff(np.append(first, len(anchor)))
        out[0].append(grams[anchor[first]])
        out[1].append(span_hashes(part, first, first + count + window - 1))
        out[2].append(first + begin)
        out[3].append(count)
        out[4].append(anchor[first] - first)
    kinds = (np.uint64, np.uint64, np.int64, np.int64, np.int64)
    prefix, run, start, count, anchor = (
        np.concatenate(x) if x else np.zeros(0, kind) for x, kind in zip(out, kinds)
    )
    return prefix.astype(np.int64), run.astype(np.int64), start, count, anchor


def suffix_tree(words: np.ndarray, lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(leaves, depths): the suffixes of at least ``window`` words of all pieces in the order of
    their words, and how many words each has in common with the leaf before it.

    ``words`` holds the pieces in a row. Stretches of leaves whose depths reach d are the internal
    nodes of d words, so the two arrays are the tree. Words beyond the next power of two of
    ``window`` neither order leaves nor count as common.
    """
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(words))  # words up to the piece's end
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64) + 1
    ranks, depth = [rank], 1
    while depth < window:
        behind = np.zeros(len(rank), np.int64)
        behind[:-depth] = rank[depth:]
        behind[left <= depth] = 0
        rank = np.unique(rank * (len(rank) + 2) + behind, return_inverse=True)[1].astype(np.int64) + 1
        ranks.append(rank)
        depth *= 2
    leaves = np.flatnonzero(left >= window)
    leaves = leaves[np.argsort(rank[leaves], kind="stable")]
    depths = np.zeros(len(leaves), np.int64)
    most = np.minimum(left[leaves[1:]], left[leaves[:-1]])
    for level in range(len(ranks) - 1, -1, -1):
        on = np.flatnonzero(depths[1:] < most)
        a, b = leaves[:-1][on] + depths[1:][on], leaves[1:][on] + depths[1:][on]
        depths[1:][on[ranks[level][a] == ranks[level][b]]] += 1 << level
    np.minimum(depths[1:], np.minimum(most, depth), out=depths[1:])
    return leaves, depths


def deep_nodes(words: np.ndarray, window: int = WINDOW, lengths: np.ndarray | None = None) -> np.ndarray:
    """The shallowest node of at least ``window`` words above each position's suffix, as a number;
    -1 where less than ``window`` words are left."""
    leaves, depths = suffix_tree(words, np.array([len(words)]) if lengths is None else lengths, window)
    node = np.full(len(words), -1, np.int64)
    node[leaves] = np.cumsum(depths < window)
    return node


def _keys(id_col: str, text_col: str):
    key, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    return [
        key.alias("doc_id"), F.coalesce(key.cast("long"), F.lit(NULL_ID)).alias("k"),
        F.xxhash64(text).alias("h"), F.coalesce(text, F.lit("")).alias("text"),
    ]


def _scan(docs: DataFrame, id_col: str, text_col: str, window: int, gram: int) -> DataFrame:
    """(prefix, run, k, h, start, suffixes, anchor): the runs of all rows."""

    def run(batches):
        for batch in small(batches):
            found, lengths = [], []
            for text in batch.column(2).to_pylist():
                runs = runs_of(word_hashes((text or "").encode()), window, gram)
                found.append(runs)
                lengths.append(len(runs[0]))
            prefix, run_, start, count, anchor = (np.concatenate(x) for x in zip(*found))
            own = np.repeat(np.arange(len(lengths)), lengths)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(prefix), pa.array(run_), batch.column(0).take(pa.array(own)),
                    batch.column(1).take(pa.array(own)),
                    pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32)),
                    pa.array(anchor.astype(np.int32)),
                ],
                ["prefix", "run", "k", "h", "start", "suffixes", "anchor"],
            )

    return docs.select(*_keys(id_col, text_col)).drop("doc_id").mapInArrow(
        run, "prefix long, run long, k long, h long, start int, suffixes int, anchor int"
    )


def _run_words(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(prefix, run, k, runs, anchor, words) of the wanted runs, words as hashes, from one holder each."""
    by_doc = wanted.groupBy("k", "h").agg(
        F.collect_list(F.struct("prefix", "run", "start", "suffixes", "anchor", "runs")).alias("wanted")
    )
    texts = docs.select(*_keys(id_col, text_col)).drop("doc_id")
    texts = maybe_among(
        texts.withColumn("key", F.xxhash64("k", "h")), "key",
        key_bitmap(wanted.select(F.xxhash64("k", "h")).distinct(), FILTER_BITS),
    ).drop("key").dropDuplicates(["k", "h"])

    def run(batches):
        for batch in small(batches):
            for k, text, wanted in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = word_hashes((text or "").encode()).astype(np.int64)
                parts = [words[w["start"] : w["start"] + w["suffixes"] + window - 1] for w in wanted]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([w["prefix"] for w in wanted], pa.int64()),
                        pa.array([w["run"] for w in wanted], pa.int64()),
                        pa.array([k] * len(wanted), pa.int64()),
                        pa.array([w["runs"] for w in wanted], pa.int64()),
                        pa.array([w["anchor"] for w in wanted], pa.int32()),
                        list_column(np.concatenate(parts), [len(p) for p in parts], pa.int64()),
                    ],
                    ["prefix", "run", "k", "runs", "anchor", "words"],
                )

    return by_doc.join(texts, ["k", "h"]).select("k", "text", "wanted").mapInArrow(
        run, "prefix long, run long, k long, runs long, anchor int, words array<long>"
    )


#: A piece of a run: (root, root_run) name the run, place is where it starts inside it; the gram at
#: ``anchor`` lies low to high words behind the start of each suffix.
_PIECE = (
    "prefix long, run long, k long, root long, root_run long, place int, anchor int, low int, high int, "
    "words array<long>"
)
_REPEATS = "root long, root_run long, first int, last int"


def _stretches(hit: np.ndarray) -> tuple[list[int], list[int]]:
    """First and last places of each stretch of True."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return edges[::2].tolist(), (edges[1::2] - 1).tolist()


def _subtrees(window: int):
    """Builds the trees of whole groups; rows (prefix, k, root, root_run, place, words) come
    sorted by prefix."""

    def solve(rows):
        lengths = np.array([len(r[5]) for r in rows])
        node = deep_nodes(np.concatenate([r[5] for r in rows]), window, lengths)
        inside = node >= 0
        doc = np.repeat(np.array([r[1] for r in rows], np.int64), lengths)
        least = np.full(len(node) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, node[inside], doc[inside])
        hit = inside & (least[node] < doc)
        out = [[], [], [], []]
        for row, end, length in zip(rows, np.cumsum(lengths), lengths):
            own = hit[end - length : end]
            if own.any():
                for first, last in zip(*_stretches(own)):
                    for column, value in zip(out, (row[2], row[3], row[4] + first, row[4] + last)):
                        column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(out, kinds)], ["root", "root_run", "first", "last"]
        )

    def run(batches):
        held = []
        for batch in batches:
            words = batch.column(5)
            arrays = [words[i].values.to_numpy() for i in range(len(words))]
            rows = held + list(zip(*(batch.column(i).to_pylist() for i in range(5)), arrays))
            held = rows
            if len(rows) > RUNS_PER_STEP:
                cut = len(rows)
                while cut and rows[cut - 1][0] == rows[-1][0]:
                    cut -= 1
                if cut:
                    yield solve(rows[:cut])
                held = rows[cut:]
        if held:
            yield solve(held)

    return run


def _halved(pieces: DataFrame, window: int) -> DataFrame:
    """Each piece as two, its suffixes dealt by the place of the gram; the longer sequence that
    all suffixes of a half share is its new prefix."""

    def run(batches):
        for batch in small(batches):
            words = [w.values.to_numpy() for w in batch.column("words")]
            starts = np.cumsum([0] + [len(w) for w in words])[:-1]
            flat = np.concatenate(words).astype(np.uint64)
            own, begin, end, gram, sides = [], [], [], [], []
            columns = (batch.column(c).to_pylist() for c in ("anchor", "low", "high"))
            for i, (anchor, low, high) in enumerate(zip(*columns)):
                mid = (low + high) // 2
                for a, b in ((low, mid), (mid + 1, high)):
                    first = max(0, anchor - b)
                    last = min(len(words[i]) - window, anchor - a)
                    if first <= last:
                        own.append(i)
                        begin.append(first)
                        end.append(last + window)
                        gram.append((anchor - a, anchor + window - b))
                        sides.append((a, b))
            own, begin, end = (np.array(x, np.int64) for x in (own, begin, end))
            gram, sides = np.array(gram, np.int64).reshape(-1, 2), np.array(sides, np.int64).reshape(-1, 2)
            at = starts[own]
            prefix = span_hashes(flat, at + gram[:, 0], at + gram[:, 1]) ^ mix64((sides[:, 0] + 1).astype(np.uint64))
            whole = span_hashes(flat, at + begin, at + end)
            taken = pa.array(own)
            int32 = lambda x: pa.array(x.astype(np.int32))
            place = batch.column("place").to_numpy()[own] + begin
            anchor = batch.column("anchor").to_numpy()[own] - begin
            parts = [words[i][a:b] for i, a, b in zip(own, begin, end)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(prefix.astype(np.int64)), pa.array(whole.astype(np.int64)),
                    *(batch.column(c).take(taken) for c in ("k", "root", "root_run")),
                    int32(place), int32(anchor), int32(sides[:, 0]), int32(sides[:, 1]),
                    list_column(np.concatenate(parts), end - begin, pa.int64()),
                ],
                ["prefix", "run", "k", "root", "root_run", "place", "anchor", "low", "high", "words"],
            )

    return pieces.mapInArrow(run, _PIECE)


def _judged(pieces: DataFrame) -> DataFrame:
    """``pieces`` with the smallest document that holds an equal one, and how many pieces its
    prefix keeps when larger documents' copies are gone: 0 where all are of one document."""
    holders = pieces.groupBy("prefix", "run", "k").agg(F.count("*").alias("n"))
    runs = stored(holders.groupBy("prefix", "run").agg(F.min(F.struct("k", "n")).alias("at")), "piece-runs")
    groups = runs.groupBy("prefix").agg(
        F.sum("at.n").alias("n"), F.min("at.k").alias("least"), F.max("at.k").alias("most")
    )
    kept = F.when(F.col("least") < F.col("most"), F.col("n")).otherwise(0)
    told = split_join(runs, groups.select("prefix", kept.alias("kept")), ["prefix"], "inner", "piece-groups")
    told = told.select("prefix", "run", F.col("at.k").alias("least"), "kept")
    return stored(split_join(pieces, told, ["prefix", "run"], "inner", "piece-verdicts"), "pieces")


def _repeats(words: DataFrame, window: int, gram: int) -> DataFrame:
    """(root, root_run, first, last): the stretches of suffixes of each run that a smaller
    document holds, from trees of groups that fit in memory.

    A round halves the pieces of the groups that do not; as the gram has window - gram + 1 places,
    there are at most log2 of that many rounds, and a piece that lives on is one row a round.
    """
    zero = F.lit(0)
    pieces = words.select(
        "prefix", "run", "k", F.col("prefix").alias("root"), F.col("run").alias("root_run"), zero.alias("place"),
        "anchor", zero.alias("low"), F.lit(window - gram).alias("high"), "words", F.col("runs").alias("kept"),
    )
    fitting, settled = [], []
    fits = F.col("kept").between(1, RUNS_IN_MEMORY)
    one = ("prefix", "k", "root", "root_run", "place", "words")
    places = window - gram + 1
    while True:
        fitting.append(pieces.where(fits).select(*one))
        crowded = pieces.where(F.col("kept") > RUNS_IN_MEMORY)
        if places == 1 or crowded.isEmpty():
            break
        places -= places // 2
        halves = _judged(stored(_halved(crowded.drop("kept", "least"), window), "halves"))
        last = F.col("place") + F.size("words") - window
        settled.append(halves.where("k > least").select("root", "root_run", F.col("place").alias("first"), last.alias("last")))
        pieces = halves.where("k = least")
    groups = fitting[0]
    for other in fitting[1:]:
        groups = groups.unionByName(other)
    n = parallelism(words.sparkSession)
    found = groups.repartition(n, "prefix").sortWithinPartitions("prefix").mapInArrow(_subtrees(window), _REPEATS)
    for other in settled:
        found = found.unionByName(other)
    return found


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    window: int = WINDOW, gram: int = GRAM,
) -> DataFrame:
    """(k, h, spans): the word spans of each text that a smaller document holds, in windows."""
    every = stored(_scan(docs, id_col, text_col, window, gram), "all-runs")
    shared = (
        every.groupBy("prefix").agg(F.min("k").alias("least"), F.max("k").alias("most"))
        .where("least < most").select("prefix")
    )
    runs = stored(split_join(every, shared, ["prefix"], "left_semi", "shared"), "runs")
    leaves = stored(
        runs.groupBy("prefix", "run").agg(
            F.min(F.struct("k", "h", "start")).alias("at"), F.max("k").alias("most"),
            F.first("suffixes").alias("suffixes"), F.first("anchor").alias("anchor"),
        ),
        "leaves",
    )
    branching = leaves.groupBy("prefix").agg(F.count("*").alias("runs")).where("runs > 1")
    wanted = split_join(leaves, branching, ["prefix"], "inner", "branching").select(
        "at.k", "at.h", "at.start", "prefix", "run", "suffixes", "anchor", "runs"
    )
    words = stored(_run_words(docs, stored(wanted, "wanted"), id_col, text_col, window), "words")
    repeats = _repeats(words, window, gram).groupBy(F.col("root").alias("prefix"), F.col("root_run").alias("run")).agg(
        F.collect_set(F.struct("first", "last")).alias("stretches")
    )
    known = (
        leaves.join(repeats, ["prefix", "run"], "left")
        .where("most > at.k OR stretches IS NOT NULL")
        .select("prefix", "run", F.col("at.k").alias("least"), "stretches")
    )
    hits = split_join(runs, known, ["prefix", "run"], "inner", "known").where("k > least OR stretches IS NOT NULL")
    whole = F.array(F.struct(F.col("start").alias("b"), (F.col("start") + F.col("suffixes") + (window - 1)).alias("e")))
    partly = F.transform(
        "stretches",
        lambda s: F.struct((F.col("start") + s["first"]).alias("b"), (F.col("start") + s["last"] + window).alias("e")),
    )
    return (
        hits.select("k", "h", F.inline(F.when(F.col("k") > F.col("least"), whole).otherwise(partly)))
        .groupBy("k", "h").agg(F.collect_set(F.struct("b", "e")).alias("spans"))
    )


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    window: int = WINDOW, gram: int = GRAM, texts: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, kept_sha256[, kept].

    A word goes if a window of ``window`` words around it also starts in a document with a
    smaller id; all windows are judged on the input. Words are runs without white space.
    ``kept`` are the words that stay, joined by one space. Null and empty texts have no words;
    a null id sorts before all others; rows that repeat an id are one document, so they take
    nothing from each other. Other columns are ignored.
    """
    source = docs.select(*_keys(id_col, text_col))
    spans = stored(repeated_spans(docs, id_col, text_col, window, gram), "spans")
    schema = (
        f"doc_id {source.schema['doc_id'].dataType.simpleString()}, n_words long, n_removed long, "
        "kept_sha256 string" + (", kept string" if texts else "")
    )

    def cut(batches):
        for batch in small(batches):
            counts, removed, hashes, kept_texts = [], [], [], []
            spans = batch.column(2).to_pylist()
            for text, own in zip(batch.column(1).to_pylist(), spans):
                words = text.encode().split()
                kept = words
                if own:
                    edges = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edges, [s["b"] for s in own], 1)
                    np.add.at(edges, [s["e"] for s in own], -1)
                    stays = np.cumsum(edges)[: len(words)] == 0
                    kept = [words[i] for i in np.flatnonzero(stays)]
                counts.append(len(words))
                removed.append(len(words) - len(kept))
                joined = b" ".join(kept)
                hashes.append(hashlib.sha256(joined).hexdigest())
                if texts:
                    kept_texts.append(joined.decode())
            columns = [
                batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                pa.array(hashes, pa.string()),
            ]
            if texts:
                columns.append(pa.array(kept_texts, pa.string()))
            yield pa.RecordBatch.from_arrays(
                columns, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"][: len(columns)]
            )

    keyed = source.withColumn("key", F.xxhash64("k", "h"))
    bitmap = key_bitmap(spans.select(F.xxhash64("k", "h")), FILTER_BITS)
    touched = maybe_among(keyed, "key", bitmap).join(spans, ["k", "h"], "left")
    others = maybe_among(keyed, "key", bitmap, among=False).withColumn(
        "spans", F.lit(None).cast(spans.schema["spans"].dataType)
    )
    columns = ["doc_id", "text", "spans"]
    rows = touched.select(columns).unionAll(others.select(columns))
    return rows.mapInArrow(cut, schema).withColumnRenamed("doc_id", id_col)
