"""Secret scans with corpus-wide ownership frequency.

Patterns give candidates. How many distinct repositories and owners hold the same candidate,
over the whole corpus, separates an example that is copied around from a credential that
belongs to one owner and therefore looks live.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapgraph.llm.common import NULL_ID, small, split_join, stored, tidy

#: Fixed values of the contract, in its order.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGNED = 6
#: Words one of which every ``assign`` match holds.
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: The added kind: long mixed strings that no base span touches, kept if they look live.
BLOB = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
BLOB_BITS = 3.2
BLOB_DIGITS = BLOB_LETTERS = 4
#: A value of more owners or repositories than these is an example.
LIVE_OWNERS = 1
LIVE_REPOSITORIES = 20


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) by start, then kind; each kind leftmost without overlap."""
    spans = []
    lower = text.lower()
    if any(name in lower for name in NAMES):
        spans += [
            (m.start(), m.end(), "assign", m[2])
            for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGNED
        ]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access", m[0]) for m in ACCESS.finditer(text)]
    spans += [(m.start(), m.end(), "hex", m[0]) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def _mixed(value: str) -> bool:
    digits = sum(map(str.isdigit, value))
    letters = sum(map(str.isalpha, value))
    if digits < BLOB_DIGITS or letters < BLOB_LETTERS:
        return False
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) >= BLOB_BITS


def blob_spans(text: str, taken: list[tuple]) -> list[tuple[int, int, str, str]]:
    """Long mixed strings beside the ``taken`` spans, which are sorted by start."""
    out, at, reach = [], 0, -1
    for m in BLOB.finditer(text):
        while at < len(taken) and taken[at][0] < m.end():
            reach = max(reach, taken[at][1])
            at += 1
        if m.start() >= reach and _mixed(m[0]):
            out.append((m.start(), m.end(), "blob", m[0]))
    return out


def _joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind, *_ in spans)


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    repository_col: str = "doc_id", owner_col: str = "source",
) -> DataFrame:
    """One stored row per row: keys, base counts and hash, and all spans with hashed values.

    A value leaves the scan only as half of its SHA-256. Null repositories are one repository,
    null owners one owner.
    """
    key, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    source = docs.select(
        key.alias("doc_id"),
        F.coalesce(key.cast("long"), F.lit(NULL_ID)).alias("k"),
        F.xxhash64(text).alias("h"),
        F.coalesce(F.col(f"`{repository_col}`").cast("string"), F.lit("")).alias("repository"),
        F.coalesce(F.col(f"`{owner_col}`").cast("string"), F.lit("")).alias("owner"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    schema = (
        f"doc_id {docs.schema[id_col].dataType.simpleString()}, k long, h long, "
        "repository string, owner string, n_assign long, n_access long, n_hex long, "
        "base_sha256 string, found array<struct<start: int, end: int, kind: string, value: string>>"
    )
    found_type = pa.list_(pa.struct([
        ("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("value", pa.string()),
    ]))

    @tidy
    def run(batches):
        for batch in small(batches):
            counts = {kind: [] for kind in KINDS}
            hashes, found = [], []
            for text in batch.column(5).to_pylist():
                base = base_spans(text)
                for kind in KINDS:
                    counts[kind].append(sum(s[2] == kind for s in base))
                hashes.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                found.append([
                    {"start": b, "end": e, "kind": kind,
                     "value": hashlib.sha256(value.encode()).hexdigest()[:32]}
                    for b, e, kind, value in base + blob_spans(text, base)
                ])
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:5], *[pa.array(counts[kind], pa.int64()) for kind in KINDS],
                    pa.array(hashes, pa.string()), pa.array(found, found_type),
                ],
                ["doc_id", "k", "h", "repository", "owner", "n_assign", "n_access", "n_hex",
                 "base_sha256", "found"],
            )

    return stored(source.mapInArrow(run, schema), "secrets")


def ownership(scanned: DataFrame) -> DataFrame:
    """(value, owners, repositories): distinct holders of each candidate over the corpus.

    Each step groups by a shorter key after combining in the map tasks, so a value that a
    third of all rows hold reaches its group as one row per owner and task.
    """
    return (
        scanned.select("repository", "owner", F.explode("found.value").alias("value"))
        .groupBy("value", "owner", "repository").agg(F.lit(1).alias("one"))
        .groupBy("value", "owner").agg(F.sum("one").alias("repositories"))
        .groupBy("value").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))
    )


def judge(
    scanned: DataFrame, live_owners: int = LIVE_OWNERS, live_repositories: int = LIVE_REPOSITORIES
) -> DataFrame:
    """(k, h, found) of texts with spans; ``live``: held by few owners and repositories.

    Base spans all stay, whatever their verdict; an added span stays only if it looks live.
    """
    spans = scanned.select("k", "h", F.inline("found"))
    live = (F.col("owners") <= live_owners) & (F.col("repositories") <= live_repositories)
    verdicts = ownership(scanned).select("value", live.alias("live"))
    rank = F.array_position(F.array(*map(F.lit, (*KINDS, "blob"))), F.col("kind")).cast("int")
    judged = split_join(spans, verdicts, ["value"], "inner", "verdicts").where((F.col("kind") != "blob") | F.col("live"))
    one = F.struct("start", rank.alias("rank"), "end", "kind", "live")
    return judged.groupBy("k", "h").agg(F.array_sort(F.collect_set(one)).alias("found"))


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    repository_col: str = "doc_id", owner_col: str = "source",
) -> DataFrame:
    """One row per row of ``docs``: id, n_assign, n_access, n_hex, base_sha256, spans, n_live,
    n_example.

    ``spans`` lists ``kind:start:end`` (code points, end exclusive) by start, then kind: all
    base spans and those added ``blob`` spans that look live. n_live and n_example count them by
    verdict. Null and empty texts have none; repeated rows get the same result and their
    candidates count once per repository; other columns are ignored.
    """
    scanned = scan(docs, id_col, text_col, repository_col, owner_col)
    rows = scanned.drop("repository", "owner", "found")
    joined = rows.join(judge(scanned), ["k", "h"], "left")
    spans = F.transform("found", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    count = lambda test: F.coalesce(F.size(F.filter("found", test)), F.lit(0)).cast("long")
    return joined.select(
        F.col("doc_id").alias(id_col), "n_assign", "n_access", "n_hex", "base_sha256",
        F.coalesce(F.array_join(spans, ","), F.lit("")).alias("spans"),
        F.when(F.col("found").isNull(), 0).otherwise(count(lambda s: s["live"])).cast("long").alias("n_live"),
        F.when(F.col("found").isNull(), 0).otherwise(count(lambda s: ~s["live"])).cast("long").alias("n_example"),
    )


def redact(
    docs: DataFrame, judged: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    mark: str = "[SECRET]", length_col: str | None = "n_chars",
) -> DataFrame:
    """``docs`` with every live span replaced by ``mark``; columns and other texts unchanged.

    Overlapping spans become one mark. ``length_col``, where there is such a column, follows
    the new text.
    """
    live = judged.select(
        F.col("k").alias("_k"), F.col("h").alias("_h"),
        F.filter("found", lambda s: s["live"]).alias("_live"),
    ).where(F.size("_live") > 0).select("_k", "_h", F.transform("_live", lambda s: F.array(s["start"], s["end"])).alias("_live"))
    own_key = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NULL_ID))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")  # no name of the input is next to ours
    keyed = docs.select(row, own_key.alias("_k"), F.xxhash64(F.col(f"`{text_col}`")).alias("_h"))
    joined = keyed.join(live, ["_k", "_h"], "left").select("_row", "_live")
    names = docs.columns
    at = names.index(text_col)
    length_at = docs.columns.index(length_col) if length_col in docs.columns else None

    @tidy
    def run(batches):
        for batch in small(batches):
            columns, spans = batch.column(0).flatten(), batch.column(1).to_pylist()
            if any(spans):
                texts = columns[at].to_pylist()
                for i, own in enumerate(spans):
                    if own:
                        texts[i] = _replaced(texts[i], own, mark)
                columns[at] = pa.array(texts, pa.string())
                if length_at is not None:
                    lengths = columns[length_at].to_pylist()
                    for i, own in enumerate(spans):
                        if own:
                            lengths[i] = len(texts[i])
                    columns[length_at] = pa.array(lengths, columns[length_at].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(run, docs.schema)


def _replaced(text: str, spans: list, mark: str) -> str:
    parts, at = [], 0
    for start, end in spans:
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])
