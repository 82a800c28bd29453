"""Language-model scoring by online logistic context mixing.

A text is its lower-cased words, each followed by a space, the last by the end symbol. Every
byte is a path of binary decisions in a Huffman tree. Hashed contexts (orders 2 and 4, the
word so far, the word before with the word so far) predict each decision from the counts of
the training corpus; a weighted sum of the stretched predictions, the weights chosen by a
gate, is the mix. All training texts fill the counts and fit the weights: the corpus has two
halves, and the weights see of a text what the counts of the other half predict. While a text is scored, its own correction of the weights and an adaptive
probability map refine the mix block by block, each block predicted from those before.

Beside it stands the unigram base: add-0.1 word counts of the training corpus.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapgraph.llm.common import list_column, lowered, mix64, parallelism, reuse_memory, small, stored
from lapgraph.llm.words import word_hashes

#: Slots of each predictor's hashed table, as powers of two: few contexts of low order, many words.
SLOT_BITS = (18, 20, 21, 21)
PREDICTORS = len(SLOT_BITS)
#: Slots of one row of a table in transit.
PART = 1 << 16
#: Bytes after which contexts begin anew; weights carry over.
SEGMENT = 1 << 19
#: Bytes whose contexts are made at once (they should fit into a core's cache), bytes of texts
#: that are scored together and their number, and decisions between two refinements.
CHUNK, GROUP, TOGETHER = 1 << 15, 1 << 19, 48
STEP = 512
#: Bytes whose contexts are counted together, and what stands for a byte that is no text.
COUNTED, NO_TEXT = 1 << 21, (1 << 32) - 1
#: Texts that give the weights from which the fit over all texts sets out, and passes over them.
FIT_TEXTS, FIT_PASSES = 300, 4
#: Parts of the corpus that are counted apart, so that each can be predicted without its own counts.
HALVES = 2
#: What holds a weight where it is: the fit counts for more from about so many decisions on.
HOLD = 1.0
#: Buckets of the adaptive map, and speeds of refinement.
BUCKETS = 24
WEIGHT_SPEED, MAP_SPEED = 0.003, 0.003
#: Words whose counts travel with the scoring tasks; the counts of all others are joined.
HEAD_WORDS = 300_000
#: Words that a task counts together.
WORDS = 1 << 22
#: Stretched predictions are kept in steps of 1/SCALE.
SCALE = 15.0
#: The end symbol as a byte and as a word hash.
END = 10
END_WORD = 0
SMOOTH = 0.1

_PAD = b"\0" * 4


def canonical(text: str | None) -> bytes:
    """The words of a text in lower case, one space between them, and the end symbol."""
    return b" ".join(lowered(text).split()) + b"\n"


def segments(data: bytes) -> list[bytes]:
    return [data[i : i + SEGMENT] for i in range(0, len(data), SEGMENT)]


class Paths:
    """The binary decisions of each byte: nodes from the root, and the branch taken at each."""

    def __init__(self, counts):
        self.counts = counts
        heap = [(int(n) + 1, symbol, symbol) for symbol, n in enumerate(counts)]
        heapq.heapify(heap)
        children, fresh = {}, 256
        while len(heap) > 1:
            n, _, left = heapq.heappop(heap)
            m, _, right = heapq.heappop(heap)
            children[fresh] = (left, right)
            heapq.heappush(heap, (n + m, fresh, fresh))
            fresh += 1
        nodes, branches = [[] for _ in range(256)], [[] for _ in range(256)]
        level, number = [(fresh - 1, [], [])], 0
        while level:  # breadth first, so that the nodes used most have the smallest numbers
            below = []
            for name, seen, taken in level:
                if name < 256:
                    nodes[name], branches[name] = seen, taken
                    continue
                for branch, child in enumerate(children[name]):
                    below.append((child, [*seen, number], [*taken, branch]))
                number += 1
            level = below
        self.lengths = np.array([len(x) for x in nodes])
        self.starts = np.cumsum(self.lengths) - self.lengths
        flat = np.array([x for own in nodes for x in own], np.int64)
        self.branches = np.array([x for own in branches for x in own], np.uint8)
        self.signs = self.branches.astype(np.float32) * 2 - 1
        spread = mix64((flat >> 4).astype(np.uint64) + np.uint64(77)).astype(np.int64)
        # Sixteen nodes of one context stand side by side in its table.
        self.places = (spread & ((1 << max(SLOT_BITS)) - 16)) | (flat & 15)
        self.counted = self.places << 1 | self.branches


_BYTE_AT = mix64(np.arange(256 * 64, dtype=np.uint64))
_ODD = np.uint64(0x9E3779B97F4A7C15)


def contexts(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, table bases per predictor, which bytes are text) of all parts in a row.

    Four bytes that are no text stand before each part, so that no context reaches into the
    part before.
    """
    joined = _PAD + b"".join(_PAD + p for p in parts)
    data = np.frombuffer(joined, np.uint8)[4:]
    n = len(data)
    sizes = np.array([len(p) for p in parts]) + 4
    real = np.ones(n, bool)
    gaps = ((np.cumsum(sizes) - sizes)[:, None] + np.arange(4)).ravel()
    real[gaps] = False
    order4 = np.ndarray(n, "<u4", joined, 0, (1,)).astype(np.uint64)  # the four bytes before
    order2 = order4 >> np.uint64(16)
    # The word so far: a sum over its bytes, each by its place in the word.
    edge = data == 32
    edge[gaps] = True
    place = np.arange(n)
    start = np.maximum.accumulate(np.where(edge, place + 1, 0))
    values = np.take(_BYTE_AT, ((place - start) & 63) << 8 | data)
    values[edge] = 0
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    begin = np.zeros(n, np.int64)
    begin[1:] = start[:-1]
    so_far = sums[:-1] - np.take(sums, begin)
    so_far[gaps] = 0
    begin -= 1  # the space before the word; the word before it ends there
    before = np.take(so_far, np.maximum(begin, 0))
    before *= _ODD
    before += so_far
    bases = np.empty((PREDICTORS, n), np.int64)
    low = (1 << max(SLOT_BITS)) - 16
    shift = np.empty(n, np.uint64)
    for j, context in enumerate((order2, order4, so_far, before)):
        hashed = context + np.uint64(j + 1)
        hashed *= _ODD
        np.right_shift(hashed, np.uint64(29), out=shift)
        hashed ^= shift
        hashed *= np.uint64(0xBF58476D1CE4E5B9)
        hashed >>= np.uint64(64 - max(SLOT_BITS))
        np.bitwise_and(hashed.view(np.int64), low, out=bases[j])
    return data, bases, real


def decisions(paths: Paths, symbols: np.ndarray, real) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of decisions of each byte, the byte of each decision, where the paths hold it)."""
    lengths = paths.lengths[symbols] * real
    first = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(symbols)), lengths)
    at = np.take(paths.starts[symbols] - first, owner)
    at += np.arange(len(at))
    return lengths, owner, at


def _chunks(parts, size: int = CHUNK):
    held, total = [], 0
    for part in parts:
        held.append(part)
        total += len(part)
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


def add_counts(tables: list[np.ndarray], paths: Paths, parts: list[bytes]) -> None:
    """Add the decisions of all parts to the tables, at twice the slot plus the branch taken.

    A context and the byte after it lead to the same slots wherever they meet, so each such pair
    is counted first and goes to its slots once.
    """
    found = [[] for _ in tables]
    for held in _chunks(parts):
        symbols, bases, real = contexts(held)
        gaps = np.flatnonzero(~real)
        for own, base, table in zip(found, bases, tables):
            base &= len(table) // 2 - 1
            base <<= 4  # a multiple of sixteen, so there is room for the byte
            base |= symbols
            base[gaps] = NO_TEXT
            own.append(base.astype(np.uint32))
    for own, table in zip(found, tables):
        pairs = np.sort(np.concatenate(own))
        pairs = pairs[: np.searchsorted(pairs, np.uint32(NO_TEXT))]
        fresh = np.ones(len(pairs), bool)
        np.not_equal(pairs[1:], pairs[:-1], out=fresh[1:])
        first = np.flatnonzero(fresh)
        times = np.diff(first, append=len(pairs)).astype(np.uint32)
        pairs = pairs[first].astype(np.int64)
        for begin in range(0, len(pairs), CHUNK):
            some = pairs[begin : begin + CHUNK]
            _, owner, at = decisions(paths, some & 255, True)
            slot = np.take(some >> 8 << 5, owner)
            slot ^= np.take(paths.counted, at)
            slot &= len(table) - 1
            np.add.at(table, slot, np.take(times[begin : begin + CHUNK], owner))


def count_tables(texts: DataFrame, paths: Paths) -> list[np.ndarray]:
    """How often each branch is taken at each slot in the whole texts (text, half): float32
    [half, slot, branch] of each predictor.

    A task adds its counts into tables of fixed size and sends them once, in parts; parts are
    added as they come in, so neither memory nor what reaches the driver grows with the data.
    """

    def count(batches):
        codec = pa.Codec("zstd", compression_level=1)
        tables = [[np.zeros(2 << bits, np.uint32) for bits in SLOT_BITS] for _ in range(HALVES)]
        waiting, sizes = [[] for _ in tables], [0] * HALVES
        reuse_memory()
        for batch in small(batches):
            for text, half in zip(*(c.to_pylist() for c in batch.columns)):
                data = canonical(text)
                waiting[half] += segments(data)
                sizes[half] += len(data)
                if sizes[half] >= COUNTED:
                    add_all(tables[half], paths, waiting[half])
                    waiting[half], sizes[half] = [], 0
        for own, parts in zip(tables, waiting):
            add_all(own, paths, parts)
        for half, j in np.ndindex(HALVES, PREDICTORS):
            table = tables[half][j]
            for part in range(0, len(table), 2 * PART):
                own = table[part : part + 2 * PART]
                if own.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([j], pa.int32()), pa.array([half], pa.int32()), pa.array([part // 2], pa.int64()),
                         pa.array([codec.compress(own.tobytes(), asbytes=True)], pa.binary())],
                        ["predictor", "half", "slot", "data"],
                    )

    def add(batches):
        codec = pa.Codec("zstd", compression_level=1)
        total: dict[tuple[int, int, int], np.ndarray] = {}
        for batch in batches:
            for *at, data in zip(*(c.to_pylist() for c in batch.columns)):
                own = np.frombuffer(codec.decompress(data, 8 * PART), np.uint32).astype(np.float64)
                at = tuple(at)
                total[at] = total[at] + own if at in total else own
        for (j, half, slot), own in total.items():
            data = codec.compress(own.astype(np.float32).tobytes(), asbytes=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([j], pa.int32()), pa.array([half], pa.int32()), pa.array([slot], pa.int64()), pa.array([data], pa.binary())],
                ["predictor", "half", "slot", "data"],
            )

    schema = "predictor int, half int, slot long, data binary"
    counted = texts.select("text", "half").mapInArrow(count, schema)
    n = parallelism(texts.sparkSession)
    merged = counted.repartition(n, "predictor", "half", "slot").mapInArrow(add, schema)
    codec = pa.Codec("zstd")
    out = [np.zeros((HALVES, 1 << bits, 2), np.float32) for bits in SLOT_BITS]
    for j, half, slot, data in merged.collect():  # four bytes for each half, slot and branch at most
        own = np.frombuffer(codec.decompress(bytes(data), 8 * PART), np.float32)
        out[j][half, slot : slot + PART] = own.reshape(-1, 2)
    return out


def add_all(tables: list[np.ndarray], paths: Paths, parts: list[bytes]) -> None:
    """``add_counts`` of any number of parts."""
    for held in _chunks(parts, COUNTED):
        add_counts(tables, paths, held)


def stretched(counts: np.ndarray) -> np.ndarray:
    """Quantised predictions, int8 [slot], from counts [slot, branch]."""
    zeros, ones = counts[:, 0].astype(np.float64), counts[:, 1].astype(np.float64)
    return np.clip(np.round(np.log((ones + 0.4) / (zeros + 0.4)) * SCALE), -127, 127).astype(np.int8)


def count_bytes(texts: DataFrame) -> np.ndarray:
    """How often each byte occurs in the canonical texts, in all of them."""

    def run(batches):
        seen = np.zeros(256, np.int64)
        for batch in small(batches):
            joined = b"".join(map(canonical, batch.column(0).to_pylist()))
            seen += np.bincount(np.frombuffer(joined, np.uint8), minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(seen)], ["byte", "n"])

    rows = texts.select("text").mapInArrow(run, "byte long, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(256, np.int64)
    for byte, n in rows:
        out[byte] = n
    return out


#: How sure a quantised prediction is, from 0 (never seen) to 3.
_LEVEL = np.array([(q != 0) + (abs(q) > 1.2 * SCALE) + (abs(q) > 3 * SCALE) for q in range(-128, 128)])
#: For each pair of predictions of the two word contexts, their bytes read as one number: the
#: predictions, and the gate, which is how sure both are.
_BYTES = np.arange(1 << 16, dtype=np.uint16)
_WORDS = tuple(x.astype(np.uint8).view(np.int8).astype(np.float32) for x in (_BYTES >> 8, _BYTES & 255))
_GATE = (4 * _LEVEL[(_BYTES >> 8) ^ 128] + _LEVEL[(_BYTES & 255) ^ 128]).astype(np.uint8)


class Mixer:
    """Tables, paths and fitted gate weights; scores texts."""

    def __init__(self, paths: Paths, tables: list[np.ndarray]):
        self.paths, self.tables = paths, tables
        self.weights = np.full((16, PREDICTORS), 0.3, np.float32)

    def inputs(self, parts: list[bytes]):
        """(quantised predictions [predictor, decision], what the two word contexts predict as one
        number, signs of the branches, decisions of each part)."""
        symbols, bases, real = contexts(parts)
        lengths, owner, at = decisions(self.paths, symbols, real)
        places = np.take(self.paths.places, at)
        found = np.empty((PREDICTORS, len(at)), np.int8)
        for base, table, own in zip(bases, self.tables, found):
            slot = np.take(base, owner)
            slot ^= places
            slot &= len(table) - 1
            own[:] = np.take(table, slot)
        words = found[-2].view(np.uint8).astype(np.uint16) << 8
        words |= found[-1].view(np.uint8)
        ends = np.cumsum([len(p) + 4 for p in parts]) - 1
        totals = np.cumsum(lengths)[ends]
        return found, words, np.take(self.paths.signs, at), np.diff(totals, prepend=0)

    def fit(self, texts: list[str], passes: int = FIT_PASSES) -> None:
        """Gate weights by stochastic gradient steps over the texts' decisions."""
        parts = [p for text in texts for p in segments(canonical(text))]
        speed = np.full(self.weights.shape, 1e-6, np.float64)
        for _ in range(passes):
            for held in _chunks(parts):
                found, words, signs, _ = self.inputs(held)
                x, gate, branches = found * np.float32(1 / SCALE), np.take(_GATE, words), signs > 0
                for begin in range(0, x.shape[1], 4096):
                    own, g = x[:, begin : begin + 4096], gate[begin : begin + 4096]
                    z = (own * self.weights[g].T).sum(axis=0)
                    error = branches[begin : begin + 4096] - 1 / (1 + np.exp(-z))
                    for i in np.unique(g):
                        step = own[:, g == i] @ error[g == i]
                        speed[i] += step * step
                        self.weights[i] += (0.05 * step / np.sqrt(speed[i])).astype(np.float32)

    def moments(self, parts: list[bytes]) -> np.ndarray:
        """[gate, predictor, 1 + predictor]: slope and curvature of the log likelihood of all
        decisions in the weights of each gate."""
        found, words, signs, _ = self.inputs(parts)
        gate = np.take(_GATE, words)
        order = np.argsort(gate, kind="stable")
        x, signs = np.take(found, order, axis=1) * np.float32(1 / SCALE), np.take(signs, order)
        ends = np.cumsum(np.bincount(gate, minlength=len(self.weights)))
        out = np.zeros((len(self.weights), PREDICTORS, 1 + PREDICTORS))
        for g, (begin, end) in enumerate(zip([0, *ends[:-1]], ends)):
            if begin < end:
                own, s = x[:, begin:end], signs[begin:end]
                wrong = 1 / (1 + np.exp(s * (self.weights[g] @ own)))
                out[g, :, 0] = own @ (s * wrong)
                out[g, :, 1:] = (own * (wrong * (1 - wrong))) @ own.T
        return out

    def by_words(self) -> np.ndarray:
        """For each pair of predictions of the two word contexts: the fitted weights of the other
        predictors, as their gate chooses them, and last what the pair adds to the mix."""
        weights = np.take(self.weights * np.float32(1 / SCALE), _GATE, axis=0)
        weights[:, -1] = weights[:, -2] * _WORDS[0] + weights[:, -1] * _WORDS[1]
        return weights

    def refine(self, parts: list[bytes], own_weights: np.ndarray, own_map: np.ndarray) -> np.ndarray:
        """log2 probability of each part; its row of weights and map is refined on the way.

        Parts that go on stand before those that have ended, so a step sees only the former.
        """
        lengths = self.paths.lengths
        counts = np.array([int(lengths[np.frombuffer(p, np.uint8)].sum()) for p in parts])
        order = np.argsort(-counts, kind="stable")
        counts, docs = counts[order], len(parts)
        width = -(-int(counts[0]) // STEP) * STEP
        xs = np.zeros((docs, PREDICTORS, width), np.int8)
        # What follows the end of a part is as good as certain, so it costs and moves nothing.
        base, sign = np.full((docs, width), 99, np.float32), np.ones((docs, width), np.float32)
        doc, by_words = 0, self.by_words()
        for held in _chunks([parts[i] for i in order]):
            found, words, signs, own = self.inputs(held)
            chosen, end = np.take(by_words, words, axis=0), 0
            fixed = chosen[:, -1].copy()
            for j in range(PREDICTORS - 2):
                fixed += chosen[:, j] * found[j]
            for n in own.tolist():
                here, end = slice(end, end + n), end + n
                xs[doc, :, :n], base[doc, :n], sign[doc, :n] = found[:, here], fixed[here], signs[here]
                doc += 1
        rows = (np.arange(docs) * BUCKETS)[:, None]
        total = np.zeros(docs)
        weights, places = own_weights[order], own_map.reshape(docs, BUCKETS)[order].reshape(-1)
        for begin in range(0, width, STEP):
            on = int(np.searchsorted(-counts, -begin))
            cut = slice(begin, begin + STEP)
            own, s, w = xs[:on, :, cut].astype(np.float32), sign[:on, cut], weights[:on]
            mixed = (w[:, None] @ own)[:, 0]
            mixed += base[:on, cut]
            bucket = np.clip(mixed, -7.9, 7.9)
            bucket += np.float32(8)
            bucket *= np.float32(BUCKETS / 16)
            bucket = bucket.astype(np.int64)
            bucket += rows[:on]
            mixed += np.take(places, bucket)
            mixed *= s
            np.clip(mixed, -30, 30, out=mixed)
            np.negative(mixed, out=mixed)
            odds = np.exp(mixed, out=mixed)
            error = odds + 1
            total[:on] += np.log(error[:, : STEP // 2] * error[:, STEP // 2 :]).sum(axis=1, dtype=np.float64)
            np.divide(odds, error, out=error)
            error *= s
            w += np.float32(WEIGHT_SPEED / SCALE**2) * (own @ error[:, :, None])[:, :, 0]
            moved = np.bincount(bucket.reshape(-1), error.reshape(-1), minlength=on * BUCKETS)
            places[: on * BUCKETS] += (MAP_SPEED * moved).astype(np.float32)
        own_weights[order], out = weights, np.empty(docs)
        own_map.reshape(docs, BUCKETS)[order] = places.reshape(docs, BUCKETS)
        out[order] = -total / np.log(2)
        return out

    def fresh(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        return np.zeros((n, PREDICTORS), np.float32), np.zeros(n * BUCKETS, np.float32)

    def score(self, texts: list[bytes]) -> np.ndarray:
        """log10 probability of each canonical text."""
        out = np.zeros(len(texts))
        order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
        short = [i for i in order if len(texts[i]) <= SEGMENT]
        begin = 0
        while begin < len(short):
            end = begin + 1
            # The longer a text, the fewer are scored with it; a step of all of them fits into the cache.
            while end < len(short) and end - begin < TOGETHER and len(texts[short[end]]) * (end + 1 - begin) <= GROUP:
                end += 1
            group = short[begin:end]
            out[group] = self.refine([texts[i] for i in group], *self.fresh(len(group)))
            begin = end
        for i in order[len(short) :]:
            state = self.fresh(1)
            out[i] = sum(self.refine([part], *state)[0] for part in segments(texts[i]))
        return out * np.log10(2)


def mixers_of(byte_counts: np.ndarray, tables: list[list[np.ndarray]], weights: np.ndarray) -> list[Mixer]:
    """A mixer for each set of tables, all with the same paths and weights."""
    paths = Paths(byte_counts)
    mixers = [Mixer(paths, own) for own in tables]
    for mixer in mixers:
        mixer.weights = weights
    return mixers


def fit_all(texts: DataFrame, model: Mixer, unseen: list[list[np.ndarray]]) -> None:
    """One Newton step of the model's gate weights over all texts (text, half), each predicted by
    the tables ``unseen`` of its half, which its own half has not filled.

    A task sends the sums of each gate; they are added as decimals, so their order changes nothing.
    """
    shared = texts.sparkSession.sparkContext.broadcast((model.paths.counts, unseen, model.weights))

    def run(batches):
        reuse_memory()
        mixers, total = mixers_of(*shared.value), 0.0
        for batch in small(batches):
            parts = [[] for _ in mixers]
            for text, half in zip(*(c.to_pylist() for c in batch.columns)):
                parts[half] += segments(canonical(text))
            for mixer, own in zip(mixers, parts):
                for held in _chunks(own):
                    total = total + mixer.moments(held)
        flat = np.ravel(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], ["place", "value"])

    sums = texts.select("text", "half").mapInArrow(run, "place long, value double")
    found = np.zeros((*model.weights.shape, 1 + PREDICTORS))
    for place, value in sums.groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,9)")).cast("double")).collect():
        found.flat[place] = value
    step = np.linalg.solve(found[:, :, 1:] + HOLD * np.eye(PREDICTORS), found[:, :, :1])
    model.weights = model.weights + step[:, :, 0].astype(np.float32)


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n): how often each hashed word occurs, the end of each text among them; stored."""

    def counted(found):
        words, n = np.unique(np.concatenate(found), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], ["word", "n"])

    def run(batches):
        found, waiting = [], 0
        for batch in small(batches):
            texts = map(lowered, batch.column(0).to_pylist())
            found += [word_hashes(b"\n".join(texts)), np.full(batch.num_rows, END_WORD, np.uint64)]
            waiting += len(found[-2]) + batch.num_rows
            if waiting >= WORDS:
                yield counted(found)
                found, waiting = [], 0
        if found:
            yield counted(found)

    rows = texts.select("text").mapInArrow(run, "word long, n long")
    return stored(rows.groupBy("word").agg(F.sum("n").alias("n")), "words")


def _frequent(counts: DataFrame) -> DataFrame:
    """The words that occur more often than any bound that HEAD_WORDS allows, never more words.

    Bounds are quarter powers of two, so that finding one takes a few hundred numbers.
    """
    level = F.floor(F.log2(F.col("n").cast("double")) * 4).cast("int")
    rows = sorted(counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect(), reverse=True)
    total, least = 0, None
    for row in rows:
        total += row["words"]
        if total > HEAD_WORDS:
            break
        least = row["level"]
    return counts.where(level >= least) if least is not None else counts.limit(0)


def train(docs: DataFrame, trains: Column, fits: Column, id_col: str, text_col: str) -> Mixer:
    """Paths, tables and weights from all texts where ``trains`` holds; null ones count as empty.

    The weights set out from a bounded sample of where ``fits`` holds too, which the tables have not
    seen yet, and are then fitted on all texts, each of which its half's tables have not seen. In the
    end the tables hold all texts. Of a sampled row that repeats, one copy is left out at first.
    """
    row_id, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    given = docs.where(trains).select(
        text.alias("text"), fits.alias("fits"), F.xxhash64(row_id, F.lit(2)).alias("by"), F.xxhash64(row_id, text).alias("key"),
    ).withColumn("half", F.pmod("key", F.lit(HALVES)).cast("int"))
    rows = given.where("text IS NOT NULL")
    copies = rows.where("fits").groupBy("by", "key").agg(F.count("*").alias("copies"))
    chosen = copies.orderBy("by", "key").limit(FIT_TEXTS).collect()
    among = F.col("fits") & F.col("key").isin([r["key"] for r in chosen])
    found = rows.where(among).dropDuplicates(["key"]).select("text", "half").collect() if chosen else []
    sample = sorted((row[0], row[1]) for row in found)
    paths = Paths(count_bytes(rows))
    counted = rows.where(~among) if chosen else rows
    counted = counted.select("text", "half")
    repeated = {r["key"]: r["copies"] - 1 for r in chosen if r["copies"] > 1}
    if repeated:
        more = docs.sparkSession.createDataFrame(list(repeated.items()), "key long, more long")
        again = rows.where(among).dropDuplicates(["key"]).join(F.broadcast(more), "key")
        counted = counted.unionAll(again.select("text", "half", F.explode(F.sequence(F.lit(1), "more"))).select("text", "half"))
    counts = [own.reshape(HALVES, -1, 2).astype(np.float32, copy=False) for own in count_tables(counted, paths)]
    model = Mixer(paths, [stretched(own.sum(axis=0, dtype=np.float64)) for own in counts])
    model.fit([text for text, _ in sample])
    empty = dict(given.where("text IS NULL").groupBy("half").count().collect())
    for half in range(HALVES):
        add_late(counts, half, paths, [text for text, own in sample if own == half])
        add_late(counts, half, paths, [None], empty.get(half, 0))
    unseen = [[stretched(np.delete(own, half, axis=0).sum(axis=0, dtype=np.float64)) for own in counts] for half in range(HALVES)]
    fit_all(given, model, unseen)
    model.tables = [stretched(own.sum(axis=0, dtype=np.float64)) for own in counts]
    return model


def add_late(counts: list[np.ndarray], half: int, paths: Paths, texts: list[str | None], times: int = 1) -> None:
    """Add the decisions of the texts to the counts of a half, each text so many times."""
    if not texts or not times:
        return
    tables = [np.zeros(own[half].size, np.uint32) for own in counts]
    add_all(tables, paths, [p for text in texts for p in segments(canonical(text))])
    for own, table in zip(counts, tables):
        own[half] += (table * float(times)).reshape(-1, 2).astype(np.float32)


def score_documents(
    docs: DataFrame, held_out: Column, fits: Column, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score,
    score, bits_per_byte.

    ``held_out`` says which rows nothing is learned from; ``fits`` from which of the others the few
    are taken that the weights set out from. Null texts count as empty: one end symbol. Repeated
    rows train and are scored each on its own; an empty table gives no rows; without training
    texts every symbol is a coin toss per decision. Other columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    counts = count_words(docs.where(~held_out).select(text.alias("text")))
    model = train(docs, ~held_out, fits, id_col, text_col)
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    head = _frequent(counts).toPandas().sort_values("word")
    floor = n + SMOOTH * (v + 1)
    shared = spark.sparkContext.broadcast((model, head["word"].to_numpy(np.int64), head["n"].to_numpy(np.int64)))
    source = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), held_out.alias("held_out"),
        F.monotonically_increasing_id().alias("row"), text.alias("text"),
    )

    def run(batches):
        reuse_memory()
        mixer, known, seen = shared.value
        for batch in small(batches):
            texts = [canonical(text) for text in batch.column(3).to_pylist()]
            tokens = np.array([text.count(b" ") + 1 + (len(text) > 1) for text in texts])
            ends = np.cumsum(tokens)
            words = np.full(ends[-1], END_WORD, np.uint64)
            inner = np.ones(len(words), bool)
            inner[ends - 1] = False
            words[inner] = word_hashes(b"".join(texts))
            own, which = np.unique(words.view(np.int64), return_inverse=True)
            at = np.minimum(np.searchsorted(known, own), max(len(known) - 1, 0))
            there = known[at] == own if len(known) else np.zeros(len(own), bool)
            term = np.zeros(len(own))
            term[there] = np.log10((seen[at[there]] + SMOOTH) / max(floor, SMOOTH))
            base = np.add.reduceat(term[which], ends - tokens)
            sure = np.add.reduceat(there[which].astype(np.int64), ends - tokens)
            other = np.flatnonzero(~there[which])
            text_of = np.searchsorted(ends, other, "right")
            rest, times = np.unique(text_of * len(own) + which[other], return_counts=True)
            lengths = np.bincount(rest // len(own), minlength=len(texts))
            score = mixer.score(texts)
            rate = -score / np.log10(2) / np.array([len(t) for t in texts])
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3], pa.array(tokens, pa.int64()), pa.array(sure, pa.int64()),
                    pa.array(base, pa.float64()), pa.array(score, pa.float64()), pa.array(rate, pa.float64()),
                    list_column(own[rest % len(own)], lengths, pa.int64()),
                    list_column(times, lengths, pa.int64()),
                ],
                ["doc_id", "held_out", "row", "n_tokens", "n_known", "base", "score", "bits_per_byte", "word", "times"],
            )

    scored = stored(
        source.mapInArrow(
            run,
            f"doc_id {source.schema['doc_id'].dataType.simpleString()}, held_out boolean, row long, "
            "n_tokens long, n_known long, base double, score double, bits_per_byte double, "
            "word array<long>, times array<long>",
        ),
        "scores",
    )
    rare = scored.select("row", F.inline(F.arrays_zip("word", "times")))
    term = F.log10((F.coalesce("n", F.lit(0)) + SMOOTH) / max(floor, SMOOTH))
    tail = rare.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * term).alias("tail_base"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("tail_known"),
    )
    zero = F.lit(0)
    return scored.drop("word", "times").join(tail, "row", "left").select(
        F.col("doc_id").alias(id_col), "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("tail_known", zero)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("tail_base", F.lit(0.0))).alias("base_score"),
        "score", "bits_per_byte",
    )
