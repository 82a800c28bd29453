"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

The pairs of all pre-tokens that are new in a batch wait together, in one bucket per merge
rank. A two-level bitmap of 256-bit words says which buckets hold something, so find-first-set
on two words gives the next rank. Merged tokens form a linked list over byte positions; an
entry whose pair has changed meanwhile is stale and skipped. A bucket is emptied from the left,
and left again as soon as a merge makes a pair of a lower rank, so every pre-token sees its
merges in the order it would see alone. Work is n log n at most, also for a pre-token of a
million bytes.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapgraph.llm.common import return_memory, small

#: Pre-tokens up to this many bytes are remembered, and so many of them per worker.
CACHED_BYTES = 48
CACHED_PIECES = 400_000
#: Characters of texts, and bytes of pre-tokens, that are encoded together, but for longer ones.
TOGETHER = 1 << 20
BIT = [1 << i for i in range(256)]


class ByteBPE:
    """Encoder and decoder of one vocabulary of byte strings with ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.digits = {rank: str(rank) for rank in self.bytes_of}
        self.find = regex.compile(pattern).findall
        size = max(ranks.values(), default=0) + 1
        self.words = [0] * ((size >> 8) + 1)
        self.known: dict[str, tuple[int, ...]] = {}
        self.numbers = np.array(range(size), object)
        self.byte_ids = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        pairs = (ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256))
        self.pair_ids = np.fromiter(pairs, np.int64, 1 << 16)

    def merge(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of each pre-token, none of them empty."""
        if not pieces:
            return []
        rank_of, words = self.ranks.get, self.words
        data = b"".join(pieces)
        n = len(data)
        raw = np.frombuffer(data, np.uint8).astype(np.int64)
        ends = np.cumsum([len(p) for p in pieces])
        starts = np.concatenate([[0], ends[:-1]])
        single = self.byte_ids[raw]
        if single.min() < 0:
            raise ValueError("the vocabulary lacks single bytes of the text")
        first = np.full(n, -1, np.int64)
        first[:-1] = self.pair_ids[raw[:-1] << 8 | raw[1:]]
        first[ends - 1] = -1
        token, pair = single.tolist(), first.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        edge = np.zeros(n + 1, np.uint8)
        edge[starts] = edge[n] = 1
        edge = edge.tobytes()
        order = np.argsort(first, kind="stable")
        order = order[np.searchsorted(first[order], 0) :]
        ranks, cuts = np.unique(first[order], return_index=True)
        cuts, order = np.append(cuts, len(order)).tolist(), order.tolist()
        buckets: dict[int, list[int]] = {}
        top = 0
        for rank, a, b in zip(ranks.tolist(), cuts, cuts[1:]):
            buckets[rank] = order[a:b]
            top |= 1 << (rank >> 8)
            words[rank >> 8] |= BIT[rank & 255]
        while top:
            word = (top & -top).bit_length() - 1
            bits = words[word]
            rank = (word << 8) + (bits & -bits).bit_length() - 1
            bits = words[word] = bits & (bits - 1)
            if not bits:
                top &= top - 1
            bucket = buckets.pop(rank)
            bucket.sort()
            for at, i in enumerate(bucket, 1):
                if pair[i] != rank:
                    continue
                j = after[i]
                end = after[i] = after[j]
                token[i], token[j], pair[j] = rank, -1, -1
                fresh = lower = -1
                if not edge[end]:
                    fresh = rank_of(data[i : after[end]], -1)
                if end < n:
                    before[end] = i
                pair[i] = fresh
                if fresh >= 0:
                    if fresh in buckets:
                        buckets[fresh].append(i)
                    else:
                        buckets[fresh] = [i]
                        top |= 1 << (fresh >> 8)
                        words[fresh >> 8] |= BIT[fresh & 255]
                if not edge[i]:
                    left = before[i]
                    lower = rank_of(data[left:end], -1)
                    if lower != pair[left]:
                        pair[left] = lower
                        if lower >= 0:
                            if lower in buckets:
                                buckets[lower].append(left)
                            else:
                                buckets[lower] = [left]
                                top |= 1 << (lower >> 8)
                                words[lower >> 8] |= BIT[lower & 255]
                if -1 < fresh < rank or -1 < lower < rank:
                    rest = bucket[at:]
                    if rest:
                        buckets[rank] = rest
                        top |= 1 << word
                        words[word] |= BIT[rank & 255]
                    break
        token = np.array(token)
        stays = token >= 0
        ids = self.numbers[token[stays]].tolist()  # one int object for each id, whatever is remembered
        upto = np.cumsum(stays)[ends - 1].tolist()
        return [tuple(ids[a:b]) for a, b in zip([0, *upto], upto)]

    def _learn(self, pieces: set[str]) -> list[str]:
        """Add the ids of new pre-tokens to those known; gives the ones too long to be kept."""
        rank_of, known = self.ranks.get, self.known
        held, waiting, size, long = [], [], 0, []
        for piece in pieces:
            data = piece.encode()
            if len(data) > CACHED_BYTES:
                long.append(piece)
            rank = rank_of(data)
            if rank is not None:
                known[piece] = (rank,)
                continue
            held.append(piece)
            waiting.append(data)
            size += len(data)
            if size >= TOGETHER:
                known.update(zip(held, self.merge(waiting)))
                held, waiting, size = [], [], 0
        known.update(zip(held, self.merge(waiting)))
        return long

    def encode_all(self, texts):
        """Ids of each text, in order."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= TOGETHER:
                yield from self._encode(held)
                held, size = [], 0
        yield from self._encode(held)

    def _encode(self, texts: list[str]):
        if len(self.known) >= CACHED_PIECES:  # the older half goes
            self.known = dict(islice(self.known.items(), CACHED_PIECES // 2, None))
        found = [self.find(text) for text in texts]
        long = self._learn(set(chain.from_iterable(found)).difference(self.known))
        get = self.known.__getitem__
        for pieces in found:
            yield list(chain.from_iterable(map(get, pieces)))
        for piece in long:
            del self.known[piece]

    def encode(self, text: str) -> list[int]:
        return next(self._encode([text]))

    def written(self, ids) -> str:
        """Decimal ids joined by one space."""
        return " ".join(map(self.digits.__getitem__, ids))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Lines of ``base64(token) rank``."""
    pairs = map(bytes.split, data.splitlines())
    return {base64.b64decode(p[0]): int(p[1]) for p in pairs if len(p) == 2}


@lru_cache(maxsize=2)
def codec(data: bytes, pattern: str) -> ByteBPE:
    """One codec per worker process and vocabulary."""
    return ByteBPE(read_ranks(data), pattern)


def encode_documents(
    docs: DataFrame,
    ranks_file: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    ids: bool = True,
    forget: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: id, n_tokens, ids_sha256, decoded_sha256[, token_ids].

    ``ranks_file`` is read once on the driver; a vocabulary has a fixed size, so its bytes
    travel with the tasks. Null and empty texts have no tokens and the hash of nothing.
    Repeated rows are encoded each on its own, null ids stay null, other columns are ignored.
    With ``forget`` no task leaves the pre-tokens it remembers in its worker.
    """
    with open(ranks_file, "rb") as file:
        data = file.read()
    source = docs.select(
        F.col(f"`{id_col}`").alias(id_col), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    )
    id_type = source.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", token_ids array<int>" if ids else ""

    def run(batches):
        bpe = codec(data, pattern)
        for batch in small(batches):
            counts, hashes, decoded, all_ids = [], [], [], []
            for tokens in bpe.encode_all(batch.column(1).to_pylist()):
                counts.append(len(tokens))
                hashes.append(hashlib.sha256(bpe.written(tokens).encode()).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(tokens)).hexdigest())
                if ids:
                    all_ids.append(pa.array(tokens, pa.int32()))
            columns = [
                batch.column(0), pa.array(counts, pa.int64()),
                pa.array(hashes, pa.string()), pa.array(decoded, pa.string()),
            ]
            if ids:
                columns.append(pa.array(all_ids, pa.list_(pa.int32())))
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256", "token_ids"]
            yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])
        if forget:
            bpe.known = {}
            return_memory()

    return source.mapInArrow(run, schema)


def decode_documents(
    encoded: DataFrame,
    ranks_file: str,
    id_col: str = "doc_id",
    ids_col: str = "token_ids",
) -> DataFrame:
    """The texts of rows of token ids; null ids give the empty text.

    Bytes that are not UTF-8 on their own come back as the replacement character.
    """
    with open(ranks_file, "rb") as file:
        data = file.read()
    source = encoded.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{ids_col}`").alias("ids"))
    id_type = source.schema[id_col].dataType.simpleString()

    def run(batches):
        bpe = codec(data, "")
        for batch in batches:
            texts = [bpe.decode(x or ()).decode("utf-8", "replace") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    return source.mapInArrow(run, f"`{id_col}` {id_type}, text string")
