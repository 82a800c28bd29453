"""Benchmark decontamination as a prefix-filtered set join.

A window (13 consecutive words of an item, or a whole shorter item) is a set of shingles of 4
consecutive words. A document that holds the window holds all its shingles, so by the prefix
principle a join on one of them, the rarest in the corpus, loses nothing. The shingle's place
in the window bounds where the window may stand in the document; what is left is compared
word by word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapgraph.llm.common import NULL_ID, in_bitmap, key_bitmap, list_column, small, stored, tidy
from lapgraph.llm.words import run_hashes, word_hashes

#: Fixed values of the contract.
WINDOW = 13
SHARE = 20
#: Words of a shingle.
SHINGLE = 4
#: Bits of the fixed-size filter of benchmark shingles that travels with the tasks.
FILTER_BITS = 1 << 24


#: A-Z in lower case; every ASCII byte but letters and digits ends a word.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def folded(text: str | None) -> bytes:
    """Words after lower-casing A-Z, with white space around them; null has none."""
    return (text or "").encode().translate(_FOLD)


def item_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int, shingle: int) -> DataFrame:
    """(item, window, n, words, shingles): every window of every item, stored."""
    source = benchmark.select(
        F.col(f"`{id_col}`").cast("string").alias("item"), F.col(f"`{text_col}`").alias("text")
    )
    schema = "item string, window long, n int, words string, shingles array<long>"

    @tidy
    def run(batches):
        for batch in batches:
            out = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = folded(text).decode().split(" ")
                words = [w for w in words if w]
                n = min(window, len(words))
                size = min(shingle, n)
                if not n:
                    continue
                values = word_hashes(folded(text))
                whole = run_hashes(values, n).astype(np.int64).tolist()
                parts = run_hashes(values, size).astype(np.int64)
                for start, name in enumerate(whole):
                    out.append((item, name, n, " ".join(words[start : start + n]),
                                parts[start : start + n - size + 1].tolist()))
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["item", "window", "n", "words", "shingles"],
            )

    return stored(source.mapInArrow(run, schema), "windows")


def shingle_filter(windows: DataFrame) -> np.ndarray:
    """A bitmap of FILTER_BITS over the hashes of all shingles, whatever their number."""
    return key_bitmap(windows.select(F.explode("shingles").alias("shingle")).distinct(), FILTER_BITS)


def shingle_places(
    docs: DataFrame, bitmap: np.ndarray, sizes: list[int], id_col: str, text_col: str
) -> DataFrame:
    """(doc_id, k, h, n_words, places, shingles) of each row, stored: where filtered shingles stand."""
    key, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    source = docs.select(
        key.alias("doc_id"), F.coalesce(key.cast("long"), F.lit(NULL_ID)).alias("k"),
        F.xxhash64(text).alias("h"), text.alias("text"),
    )
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    id_type = source.schema["doc_id"].dataType.simpleString()

    @tidy
    def run(batches):
        bits = shared.value
        for batch in small(batches):
            counts, places, values, lengths = [], [], [], []
            for text in batch.column(3).to_pylist():
                words = word_hashes(folded(text))
                counts.append(len(words))
                before = sum(map(len, places))
                for size in sizes:
                    shingles = run_hashes(words, size).astype(np.int64)
                    at = np.flatnonzero(in_bitmap(bits, shingles))
                    places.append(at)
                    values.append(shingles[at])
                lengths.append(sum(map(len, places)) - before)
            flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (places, values)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3], pa.array(counts, pa.int64()),
                    list_column(flat[0].astype(np.int32), lengths, pa.int32()),
                    list_column(flat[1], lengths, pa.int64()),
                ],
                ["doc_id", "k", "h", "n_words", "places", "shingles"],
            )

    schema = f"doc_id {id_type}, k long, h long, n_words long, places array<int>, shingles array<long>"
    return stored(source.mapInArrow(run, schema), "places")


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, shingle: int = SHINGLE,
) -> tuple[DataFrame, DataFrame]:
    """(rows, hits): all rows with (doc_id, k, h, n_words), and for each (k, h) with a window
    its (n_hit, items), items being the sorted ids of the items with occurring windows."""
    windows = item_windows(benchmark, item_col, item_text_col, window, shingle)
    sizes = sorted(
        r[0] for r in windows.select(F.least("n", F.lit(shingle))).distinct().collect()
    )  # at most ``shingle`` values
    rows = shingle_places(docs, shingle_filter(windows), sizes, id_col, text_col)
    found = rows.where(F.size("places") > 0)
    places = found.select("k", "h", "n_words", F.inline(F.arrays_zip("places", "shingles")))
    seen = places.groupBy("shingles").agg(F.count("*").alias("seen"))
    # The prefix of each window: its rarest shingle in the corpus, with its place in the window.
    unique = windows.groupBy("window", "n", "words").agg(F.first("shingles").alias("in_window"))
    each = unique.select("window", "n", "words", F.posexplode("in_window").alias("offset", "shingles"))
    prefix = (
        each.join(seen, "shingles")
        .groupBy("window", "n", "words")
        .agg(F.min(F.struct("seen", "shingles", "offset")).alias("rarest"), F.count("*").alias("known"))
        # A window one of whose shingles the corpus lacks occurs nowhere.
        .where(F.col("known") == F.greatest(F.col("n") - (shingle - 1), F.lit(1)))
        .select("window", "n", "words", "rarest.shingles", "rarest.offset")
    )
    start = F.col("places") - F.col("offset")
    candidates = (
        places.join(prefix, "shingles")
        .select("k", "h", "n_words", start.alias("start"), "n", "window", "words")
        .where("start >= 0 AND start + n <= n_words")
    )
    bundled = candidates.groupBy("k", "h").agg(
        F.collect_set(F.struct("start", "n", "window", "words")).alias("tries")
    )
    key, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    texts = docs.select(
        F.coalesce(key.cast("long"), F.lit(NULL_ID)).alias("k"), F.xxhash64(text).alias("h"), text.alias("text")
    )
    checked = stored(
        bundled.join(texts, ["k", "h"]).select("k", "h", "text", "tries")
        .mapInArrow(_verified, "k long, h long, n_hit long, windows array<struct<window: long, words: string>>"),
        "verified",
    )
    holders = windows.select("window", "words", "item")
    items = (
        checked.select("k", "h", F.inline("windows")).distinct()
        .join(holders, ["window", "words"])
        .groupBy("k", "h").agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    hits = checked.groupBy("k", "h").agg(F.max("n_hit").alias("n_hit")).join(items, ["k", "h"])
    return rows.select("doc_id", "k", "h", "n_words"), hits


@tidy
def _verified(batches):
    """Compares the words of each try; hit words are those inside any true occurrence."""
    kind = pa.list_(pa.struct([("window", pa.int64()), ("words", pa.string())]))
    for batch in small(batches):
        counts, windows = [], []
        for text, tries in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            words = folded(text).split()
            edges = np.zeros(len(words) + 1, np.int64)
            true = set()
            for one in tries:
                start, n = one["start"], one["n"]
                if b" ".join(words[start : start + n]).decode() == one["words"]:
                    edges[start] += 1
                    edges[start + n] -= 1
                    true.add((one["window"], one["words"]))
            counts.append(int((np.cumsum(edges) > 0).sum()))
            windows.append([{"window": w, "words": x} for w, x in sorted(true)])
        keep = pa.array([n > 0 for n in counts], pa.bool_())
        out = pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(windows, kind)],
            ["k", "h", "n_hit", "windows"],
        )
        yield out.filter(keep)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, shingle: int = SHINGLE, share: int = SHARE,
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_hit, n_items, items_sha256, contaminated.

    Null and empty texts have no words and no hits; items without words match nothing; an
    empty benchmark gives zeros. Items that repeat with the same id count once. Rows of equal
    id and text get the same result; other columns of either table are ignored.
    """
    judged = judged_texts(docs, benchmark, id_col, text_col, item_col, item_text_col, window, shingle, share)
    return judged.drop("k", "h").withColumnRenamed("doc_id", id_col)


def judged_texts(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, shingle: int = SHINGLE, share: int = SHARE,
) -> DataFrame:
    """The rows of ``decontaminate`` with the text's (k, h); the id is named doc_id."""
    rows, hits = contamination(docs, benchmark, id_col, text_col, item_col, item_text_col, window, shingle)
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return rows.join(hits, ["k", "h"], "left").select(
        "doc_id", "k", "h", "n_words", hit.alias("n_hit"),
        F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        ((hit > 0) & (share * hit >= F.col("n_words"))).alias("contaminated"),
    )
