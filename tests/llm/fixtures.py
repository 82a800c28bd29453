"""Small documents with everything that operators must bear."""

from __future__ import annotations

import random
import re

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {u: u + 32 for u in range(65, 91)}
#: Names that operators use inside; as extra columns they must do no harm.
CLASH = ["k", "h", "n", "v", "word", "bucket", "found", "score", "start", "row", "prefix", "comp", "value"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"{name} string" for name in CLASH
)


def words(rng: random.Random, n: int, letters: str = "abcdefgh") -> list[str]:
    return ["".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(n)]


def documents() -> list[tuple[int | None, str | None, str | None, str | None]]:
    """(doc_id, text, lang, source)."""
    rng = random.Random(8)
    body, passage = words(rng, 300), words(rng, 70)
    rows = [
        (1, None, None, None), (2, "", "en", "s1"), (3, " \t\n ", "en", "s1"), (4, "One", "en", None),
        (5, "ONE", None, "s2"), (6, "two words", "en", "s2"), (7, "123 456 !!!", None, "s1"),
        (8, "é è ñandú ﬁn K ſ", "es", "s1"), (9, "x" * 5000, "en", "s3"), (10, "ab " * 3000, "en", "s3"),
        (None, " ".join(words(rng, 60)), "en", "s1"), (None, None, None, None),
    ]
    rows += [(20 + i, " ".join(body), "en", f"s{i % 3}") for i in range(12)]  # exact copies
    for i in range(25):  # near copies, each with one or two words changed
        copy = list(body)
        for _ in range(1 + i % 2):
            copy[rng.randrange(300)] = f"change{i}"
        rows.append((40 + i, " ".join(copy), "en", f"s{i % 5}"))
    for i in range(15):  # a passage inside other text
        own = words(rng, 40)
        rows.append((80 + i, " ".join(own[: i * 2] + passage[: 48 + i] + own[i * 2 :]), "es", "s9"))
    for i in range(40):
        rows.append((200 + i, " ".join(words(rng, rng.randint(1, 150), "mnopqrst"[: 3 + i % 6])), ["en", "es"][i % 2], "s4"))
    rows.append((300, " ".join(words(rng, 30_000)), "en", "s5"))
    rows += [rows[12], rows[30], rows[80]]  # rows that repeat whole
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    full = [(i, t, lang, s, None if t is None else len(t), *["clash"] * len(CLASH)) for i, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def result(df, key: str = "doc_id") -> list[dict]:
    """Rows as dicts, sorted."""
    return sorted((r.asDict() for r in df.collect()), key=lambda r: (r[key] is not None, r[key] or 0, repr(r)))


def by_id(rows) -> list:
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, repr(r)))
