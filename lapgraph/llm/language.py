"""Language identification by prediction by partial matching (PPM, escape method C).

Each language has a context tree over bytes, as counts of grams of one to ORDER + 1 bytes. A
byte costs -log2 of its probability in the longest context that has seen it, plus -log2 of
the escape from each longer context that has not. The statistics are frozen, so the cost of
a gram is a constant: it is worked out once per known gram and looked up for each position.
The language with the shortest code for the whole text wins.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lapgraph.llm.common import small, tidy

#: Bytes of context at most.
ORDER = 4
#: Documents per language that the trees learn from; their whole texts count.
SAMPLE = 400
#: Positions worked on at once.
BLOCK = 1 << 18
UNDETERMINED = "und"
#: Bits per byte above which no known language is plausible; bytes drawn at random cost more.
MOST_BITS = 6.5
#: Bytes below which a text says too little to be implausible.
LEAST_BYTES = 100

_LETTER = regex.compile(r"\p{L}")
_SPACE = 32
#: Bytes as the trees see them: A-Z in lower case, other ASCII that is no letter as a space.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else _SPACE for b in range(256)
)


class GramIndex:
    """Rows of known 64-bit grams: open addressing, looked up for whole arrays."""

    def __init__(self, grams: np.ndarray):
        bits = max(8, int(4 * len(grams) + 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.grams = np.zeros(1 << bits, np.uint64)
        self.rows = np.full(1 << bits, -1, np.int32)
        row = np.arange(len(grams), dtype=np.int32)
        at = self._home(grams)
        while len(row):
            free = self.rows[at] < 0
            _, first = np.unique(at[free], return_index=True)
            placed = np.flatnonzero(free)[first]
            self.grams[at[placed]], self.rows[at[placed]] = grams[row[placed]], row[placed]
            rest = np.ones(len(row), bool)
            rest[placed] = False
            row, at = row[rest], (at[rest] + 1) & self.mask

    def _home(self, grams: np.ndarray) -> np.ndarray:
        return ((grams * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, grams: np.ndarray) -> np.ndarray:
        """Row of each gram, -1 where unknown."""
        at = self._home(grams)
        found = self.rows[at]
        open_ = np.flatnonzero((found >= 0) & (self.grams[at] != grams))
        while len(open_):
            at_open = at[open_] = (at[open_] + 1) & self.mask
            rows = found[open_] = self.rows[at_open]
            open_ = open_[(rows >= 0) & (self.grams[at_open] != grams[open_])]
        return found


class PPM:
    """Frozen context trees of all languages."""

    def __init__(self, counts: dict[str, list[tuple[np.ndarray, np.ndarray]]]):
        """``counts``: by language and order the sorted grams and how often each was seen."""
        self.languages = sorted(counts)
        self.trees = []
        for language in self.languages:
            tree = []
            for grams, seen in counts[language]:
                contexts, first = np.unique(grams >> np.uint64(8), return_index=True)
                ends = np.append(first[1:], len(grams))
                sums = np.concatenate([[0.0], np.cumsum(seen, dtype=float)])
                tree.append((grams, seen, contexts, sums[ends] - sums[first], (ends - first).astype(float)))
            self.trees.append(tree)
        known = [tree[-1][0] for tree in self.trees if tree]
        self.grams = np.unique(np.concatenate(known)) if known else np.zeros(0, np.uint64)
        self.index = GramIndex(self.grams)
        self.costs = self.costs_of(self.grams)

    def costs_of(self, grams: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each full-length gram, one column per language."""
        out = np.zeros((len(grams), len(self.trees)), np.float32)
        for column, tree in enumerate(self.trees):
            bits = np.zeros(len(grams))
            todo = np.arange(len(grams))
            for order in range(ORDER, -1, -1):
                known, seen, contexts, totals, kinds = tree[order]
                part = grams[todo] & np.uint64((1 << (8 * (order + 1))) - 1)
                context = part >> np.uint64(8)
                c = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
                there = contexts[c] == context if len(contexts) else np.zeros(len(todo), bool)
                g = np.minimum(np.searchsorted(known, part), len(known) - 1)
                hit = there & (known[g] == part) if len(known) else there
                total = totals[c] + kinds[c] if len(contexts) else np.ones(len(todo))
                bits[todo[hit]] += np.log2(total[hit] / seen[g[hit]])
                escape = there & ~hit
                bits[todo[escape]] += np.log2(total[escape] / kinds[c[escape]])
                todo = todo[~hit]
            bits[todo] += 8.0
            out[:, column] = bits
        return out

    def bits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(code length of each text under each language, bytes counted of each text)."""
        data, ends = folded(texts)
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        total = np.zeros((len(texts), len(self.trees)))
        used = np.zeros(len(texts))
        for begin in range(0, len(data), BLOCK):
            stop = min(begin + BLOCK, len(data))
            keys, counted = gram_keys(data, begin, stop)
            place = np.flatnonzero(counted)
            keys = keys[place]
            rows = self.index.find(keys)
            bits = self.costs[np.maximum(rows, 0)] if len(self.costs) else self.costs_of(keys)
            fresh = np.flatnonzero(rows < 0)
            if len(fresh) and len(self.costs):
                rare, back = np.unique(keys[fresh], return_inverse=True)
                bits[fresh] = self.costs_of(rare)[back]
            sums = np.zeros((stop - begin + 1, len(self.trees)))
            sums[place + 1] = bits
            sums = np.cumsum(sums, axis=0)
            n = np.concatenate([[0], np.cumsum(counted)])
            low = np.clip(starts - begin, 0, stop - begin)
            high = np.clip(ends - begin, 0, stop - begin)
            total += sums[high] - sums[low]
            used += n[high] - n[low]
        return total, used


def folded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as folded bytes, each closed by spaces that hide it from the next; the ends."""
    parts = [text.encode().translate(_FOLD) + b" " * (ORDER + 1) for text in texts]
    ends = np.cumsum([len(p) for p in parts]) if parts else np.zeros(0, np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), ends


def gram_keys(data: np.ndarray, begin: int, stop: int, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Grams that end in [begin, stop), newest byte lowest, and whether the place counts.

    A space after a space does not count, so padding and punctuation weigh nothing.
    """
    size = stop - begin
    padded = np.full(size + order, _SPACE, np.uint8)
    have = min(order, begin)
    padded[order - have :] = data[begin - have : stop]
    keys = np.zeros(size, np.uint64)
    for back in range(order, -1, -1):
        keys = (keys << np.uint64(8)) | padded[order - back : order - back + size].astype(np.uint64)
    return keys, (padded[order:] != _SPACE) | (padded[order - 1 : -1] != _SPACE)


def _sample(labelled: DataFrame, per_language: int) -> DataFrame:
    """(id, label): the ids with the smallest hashes of each language.

    A hash bound from the language's row count lets about twice as many through, so what is
    ranked, and later broadcast, does not grow with the table.
    """
    by = F.xxhash64("id", F.lit(10))
    counts = labelled.groupBy("lang").agg(F.count("*").alias("rows"))
    near = labelled.select("id", "lang", by.alias("by")).join(F.broadcast(counts), "lang")
    near = near.where(F.col("by") / 2.0**64 + 0.5 <= 2.0 * per_language / F.col("rows"))
    order = Window.partitionBy("lang").orderBy("by", "id")
    return (
        near.withColumn("n", F.row_number().over(order))
        .where(F.col("n") <= per_language)
        .select("id", F.col("lang").alias("label")).distinct()
    )


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    per_language: int = SAMPLE,
) -> PPM:
    """Trees of every language among ``docs``, from the whole texts of a bounded sample.

    The sample holds ``per_language`` documents of each language, those with the smallest
    hashed ids. Rows with a null language or text do not count.
    """
    labelled = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text")
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    chosen = _sample(labelled, per_language)
    texts = labelled.join(F.broadcast(chosen), labelled["id"].eqNullSafe(chosen["id"]) & (F.col("lang") == F.col("label")))

    @tidy
    def grams(batches):
        for batch in small(batches):
            languages = np.array(batch.column(0).to_pylist(), object)
            texts = batch.column(1).to_pylist()
            for language in sorted(set(languages)):
                data, _ = folded([texts[i] for i in np.flatnonzero(languages == language)])
                for begin in range(0, len(data), BLOCK):
                    keys, counted = gram_keys(data, begin, min(begin + BLOCK, len(data)))
                    keys = keys[counted]
                    for order in range(ORDER + 1):
                        found, seen = np.unique(
                            keys & np.uint64((1 << (8 * (order + 1))) - 1), return_counts=True
                        )
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([language] * len(found), pa.string()),
                                pa.array(np.full(len(found), order, np.int32)),
                                pa.array(found.astype(np.int64)), pa.array(seen.astype(np.int64)),
                            ],
                            ["lang", "depth", "gram", "n"],
                        )

    # Bounded by the sample: per_language texts for each language.
    counted = (
        texts.select("lang", "text")
        .mapInArrow(grams, "lang string, depth int, gram long, n long")
        .groupBy("lang", "depth", "gram").agg(F.sum("n").alias("n"))
        .toPandas()
    )
    counts = {}
    for language, rows in counted.groupby("lang"):
        counts[language] = []
        for order in range(ORDER + 1):
            part = rows[rows["depth"] == order].sort_values("gram")
            counts[language].append((part["gram"].to_numpy(np.uint64), part["n"].to_numpy(float)))
    return PPM(counts)


def identify(
    docs: DataFrame, model: PPM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, lang_pred, score, bits_per_byte.

    ``und`` with score 0 where the text is null or empty, has no letter, or no language is
    known. The score is the posterior probability of the language, all being equally likely
    before; equal code lengths go to the language that sorts first. bits_per_byte is the code
    length under the chosen language over the bytes that count (0 for ``und``). Texts count
    whole, whatever their length; repeated rows are judged each on its own; other columns
    are ignored.
    """
    source = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = source.schema[id_col].dataType.simpleString()

    @tidy
    def run(batches):
        ppm = shared.value
        for batch in small(batches):
            texts = [text or "" for text in batch.column(1).to_pylist()]
            bits, used = ppm.bits(texts)
            named, scores, rates = [], [], []
            best = np.argmin(bits, axis=1) if ppm.languages else None
            for i, text in enumerate(texts):
                if best is None or not _LETTER.search(text):
                    named.append(UNDETERMINED)
                    scores.append(0.0)
                    rates.append(0.0)
                    continue
                lead = bits[i, best[i]] - bits[i]
                named.append(ppm.languages[best[i]])
                scores.append(float(1 / np.exp2(lead).sum()))
                rates.append(float(bits[i, best[i]] / max(used[i], 1)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(named, pa.string()),
                    pa.array(scores, pa.float64()), pa.array(rates, pa.float64()),
                ],
                [id_col, "lang_pred", "score", "bits_per_byte"],
            )

    return source.mapInArrow(run, f"`{id_col}` {id_type}, lang_pred string, score double, bits_per_byte double")


def keep_identified(
    docs: DataFrame, model: PPM, text_col: str = "text", most_bits: float = MOST_BITS
) -> DataFrame:
    """Rows of ``docs``, all columns, whose language is determined and plausible.

    Null and empty texts and texts without a letter go, and so do texts of LEAST_BYTES or more
    that cost the best language more than ``most_bits`` per byte.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    @tidy
    def run(batches):
        ppm = shared.value
        for batch in small(batches):
            texts = [text or "" for text in batch.column(at).to_pylist()]
            bits, used = ppm.bits(texts)
            least = bits.min(axis=1) if ppm.languages else np.full(len(texts), np.inf)
            plausible = (least <= most_bits * used) | (used < LEAST_BYTES)
            keep = plausible & np.array([bool(ppm.languages and _LETTER.search(t)) for t in texts], bool)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
