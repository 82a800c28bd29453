"""BPE, word pieces, language identification and language-model scores."""

import base64
import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from lapgraph.llm import bpe, language, mixing, wordpiece
from lapgraph.llm.queries import id_remainder, pretoken_pattern, ranks_path
from tests.llm.fixtures import LOWER, SPACE, by_id, documents, frame, result


@pytest.fixture(scope="module")
def encoding():
    with open(ranks_path(), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def test_bpe_equals_library(spark, encoding):
    rows = documents()
    out = bpe.encode_documents(frame(spark, rows), ranks_path(), pretoken_pattern())
    expected = []
    for i, text, *_ in rows:
        ids = encoding.encode_ordinary(text or "")
        expected.append((i, len(ids), sha(" ".join(map(str, ids))), sha(text or ""), ids))
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "token_ids"]
    assert by_id(tuple(r[n] for n in names) for r in result(out)) == by_id(expected)
    texts = result(bpe.decode_documents(out, ranks_path()))
    assert by_id((r["doc_id"], r["text"]) for r in texts) == by_id((i, t or "") for i, t, *_ in rows)


def test_merge_order(encoding):
    codec = bpe.ByteBPE(encoding._mergeable_ranks, public_tokenizers.PATTERN)
    rng = random.Random(4)
    for _ in range(2000):
        text = "".join(rng.choice("aab é\n1<|") for _ in range(rng.randint(0, 50)))
        assert codec.encode(text) == encoding.encode_ordinary(text)
    for text in ("a" * 50_000, "".join(rng.choice("abc") for _ in range(50_000))):
        assert codec.encode(text) == encoding.encode_ordinary(text)
    ranks = {bytes([c]): c for c in range(97, 100)} | {b"aa": 300, b"aaa": 70_000, b"ba": 299, b"ab": 70_001}
    own = bpe.ByteBPE(ranks, r"[a-c]+")
    library = tiktoken.Encoding("x", pat_str=r"[a-c]+", mergeable_ranks=ranks, special_tokens={})
    for _ in range(500):
        text = "".join(rng.choice("ab") for _ in range(rng.randint(1, 30)))
        assert own.encode(text) == library.encode_ordinary(text)


def test_word_pieces_equal_library(spark):
    rng = random.Random(5)
    piece = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 4)))
    for _ in range(30):
        starts, inners = ({piece() for _ in range(12)} for _ in range(2))
        names = {"[UNK]": 0}
        for p in [*starts, *("##" + p for p in inners)]:
            names.setdefault(p, len(names))
        library = Tokenizer(models.WordPiece(names, unk_token="[UNK]", max_input_chars_per_word=10**6))
        library.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        counter = wordpiece.PieceCounter(starts, inners)
        for _ in range(60):
            text = " ".join("".join(rng.choice("abcdé") for _ in range(rng.randint(1, 9))) for _ in range(4))
            assert counter.counts(text)[2] == len(library.encode(text).ids)
    rows = documents()
    out = result(wordpiece.count_pieces(frame(spark, rows), sorted(starts), sorted(inners)))
    expected = [(i, *counter.counts(text or "")) for i, text, *_ in rows]
    assert by_id((r["doc_id"], r["n_words"], r["n_unknown"], r["n_tokens"]) for r in out) == by_id(expected)


def brute_bits(text: str, trained: list[str]) -> tuple[float, int]:
    """PPM method C, byte by byte, with dictionaries."""
    fold = lambda t: t.encode().translate(language._FOLD)
    seen: dict[bytes, Counter] = {}
    pad = b" " * language.ORDER
    for own in trained:
        data = pad + fold(own) + b" " * (language.ORDER + 1)
        for i in range(language.ORDER, len(data)):
            if data[i] == 32 and data[i - 1] == 32:
                continue
            for order in range(language.ORDER + 1):
                seen.setdefault(data[i - order : i], Counter())[data[i]] += 1
    bits, used = 0.0, 0
    data = pad + fold(text) + b" " * (language.ORDER + 1)
    for i in range(language.ORDER, len(data)):
        if data[i] == 32 and data[i - 1] == 32:
            continue
        used += 1
        for order in range(language.ORDER, -1, -1):
            counts = seen.get(data[i - order : i])
            if counts is None:
                continue
            total = sum(counts.values()) + len(counts)
            if data[i] in counts:
                bits -= math.log2(counts[data[i]] / total)
                break
            bits -= math.log2(len(counts) / total)
        else:
            bits += 8
    return bits, used


def test_language_is_ppm(spark):
    rows = [r for r in documents() if r[0] != 300]
    docs = frame(spark, rows)
    model = language.train(docs)
    trained = {
        lang: [t for _, t, own, _ in rows if own == lang and t is not None] for lang in ("en", "es")
    }
    out = {r["doc_id"]: r for r in result(language.identify(docs, model))}
    for i, text, *_ in rows:
        if i is None:
            continue
        if not text or not any(c.isalpha() for c in text):
            assert (out[i]["lang_pred"], out[i]["score"]) == ("und", 0.0)
            continue
        costs = {lang: brute_bits(text, own) for lang, own in trained.items()}
        best = min(sorted(costs), key=lambda lang: costs[lang][0])
        assert out[i]["lang_pred"] == best
        assert out[i]["bits_per_byte"] == pytest.approx(costs[best][0] / costs[best][1], rel=1e-4)
        assert 0 <= out[i]["score"] <= 1
    kept = result(language.keep_identified(docs, model))
    assert kept and all(any(c.isalpha() for c in r["text"]) for r in kept)


def test_language_learns_from_training_rows_only(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.train(docs.where(id_remainder(4) != 2), per_language=30)
    found = language.identify(docs, model).join(docs, "doc_id").where(id_remainder(4) == 2)
    right, all_ = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right >= 0.97 * all_


def test_gram_index():
    rng = np.random.default_rng(3)
    grams = np.unique(rng.integers(0, 1 << 40, 5000).astype(np.uint64))
    index = language.GramIndex(grams)
    asked = np.concatenate([grams, rng.integers(0, 1 << 40, 5000).astype(np.uint64)])
    where = {int(g): i for i, g in enumerate(grams)}
    assert index.find(asked).tolist() == [where.get(int(g), -1) for g in asked]


def test_scores(spark):
    rows = documents()
    docs = frame(spark, rows)
    out = result(mixing.score_documents(docs, id_remainder(10) == 0, id_remainder(10) == 1))
    fold = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10
    tokens = lambda t: [*SPACE.findall((t or "").translate(LOWER)), None]
    counts = Counter(w for i, t, *_ in rows if fold(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    expected = by_id(
        (i, fold(i) == 0, len(tokens(t)), sum(w in counts for w in tokens(t)), n,
         sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t)))
        for i, t, *_ in rows
    )
    got = by_id((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in out)
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    assert [g[5] for g in got] == pytest.approx([e[5] for e in expected])
    assert all(r["score"] < 0 for r in out)
    copies = {r["score"] for r in out if r["doc_id"] in range(20, 32)}
    assert len(copies) == 1  # a score hangs on the text alone, not on its neighbours


def test_every_training_text_is_learned(spark, monkeypatch):
    """Each row that is not held out fits the weights or fills the tables, and none does both."""
    rows = [*documents(), (None, "another text without id", "en", "s")]
    fold = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10
    rows += [r for r in rows if r[1] and fold(r[0]) == 1][:2] * 2
    fitted, counted = [], []
    tables = [np.zeros(1 << b, np.int8) for b in mixing.SLOT_BITS]
    monkeypatch.setattr(mixing.Mixer, "fit", lambda self, texts: fitted.extend(texts))
    monkeypatch.setattr(mixing, "count_tables", lambda texts, paths: counted.extend(r[0] for r in texts.collect()) or tables)
    for size in (3, 1000):
        monkeypatch.setattr(mixing, "FIT_TEXTS", size)
        fitted.clear(), counted.clear()
        mixing.train(frame(spark, rows), id_remainder(10) != 0, id_remainder(10) == 1, "doc_id", "text")
        assert Counter(fitted + counted) == Counter(t for i, t, *_ in rows if t is not None and fold(i))
        ones = {(i, t) for i, t, *_ in rows if t is not None and fold(i) == 1}
        assert len(fitted) == min(size, len(ones))


def test_pipeline_encoder_leaves_nothing_in_workers(spark, monkeypatch):
    """With ``forget`` the same ids come out, and the codec of the worker remembers no pre-token after a task."""
    import corpus_pipeline

    docs = frame(spark, documents())
    rows_of = lambda df: sorted(map(str, df.collect()))
    whole = rows_of(bpe.encode_documents(docs, ranks_path(), pretoken_pattern()))
    assert rows_of(corpus_pipeline.encoded(spark, docs, "")) == whole
    codec = bpe.ByteBPE({bytes([b]): b for b in range(256)}, pretoken_pattern())
    monkeypatch.setattr(bpe, "codec", lambda data, pattern: codec)
    run = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, schema: run.append(f))
    corpus_pipeline.encoded(spark, docs, "")
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["some words here"]})
    assert sum(b.num_rows for b in run[0](iter([batch]))) == 1
    assert codec.known == {}


def test_every_training_text_shapes_the_code(spark, monkeypatch):
    """The binary decisions follow the bytes of all training texts, not of those the weights are fitted on."""
    rows = documents()
    fold = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10
    given, paths_of = [], mixing.Paths
    tables = [np.zeros(1 << b, np.int8) for b in mixing.SLOT_BITS]
    monkeypatch.setattr(mixing, "Paths", lambda counts: given.append(counts) or paths_of(counts))
    monkeypatch.setattr(mixing.Mixer, "fit", lambda self, texts: None)
    monkeypatch.setattr(mixing, "count_tables", lambda texts, paths: tables)
    monkeypatch.setattr(mixing, "FIT_TEXTS", 2)
    mixing.train(frame(spark, rows), id_remainder(10) != 0, id_remainder(10) == 1, "doc_id", "text")
    whole = b"".join(mixing.canonical(t) for i, t, *_ in rows if t is not None and fold(i))
    assert given[0].tolist() == np.bincount(np.frombuffer(whole, np.uint8), minlength=256).tolist()


def test_all_training_texts_fill_tables_and_fit_weights(spark, monkeypatch):
    """In the end the tables hold every training text, also the sampled and the null ones, and the weights
    are moved by all of them, each predicted by the texts of the other half."""
    rng = random.Random(4)
    words = ["some", "words", "é", "or", "others", "x" * 30]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))), "en", "s") for i in range(60)]
    rows += [(None, "a text without id", "en", "s"), *[r for r in rows if zlib.crc32(str(r[0]).encode()) % 10 == 1][:2] * 2]
    rows += [(i, None, "en", "s") for i in range(60, 80)]
    docs = frame(spark, rows)
    monkeypatch.setattr(mixing.Mixer, "fit", lambda self, texts: None)
    model = mixing.train(docs, id_remainder(10) != 0, id_remainder(10) == 1, "doc_id", "text")
    own = docs.where(id_remainder(10) != 0).selectExpr("text", f"pmod(xxhash64(doc_id, text), {mixing.HALVES}) AS half")
    halves = [[mixing.canonical(r.text) for r in own.collect() if r.half == h] for h in range(mixing.HALVES)]
    assert all(halves) and sum(map(len, halves)) == sum(zlib.crc32(("" if i is None else str(i)).encode()) % 10 > 0 for i, *_ in rows)
    counts = [[np.zeros(2 << b, np.uint32) for b in mixing.SLOT_BITS] for _ in halves]
    for tables, parts in zip(counts, halves):
        mixing.add_counts(tables, model.paths, parts)
    predicted = lambda counted: [mixing.stretched(c.reshape(-1, 2)) for c in counted]
    for table, expected in zip(model.tables, predicted([a + b for a, b in zip(*counts)])):
        assert (table == expected).all()
    start = mixing.Mixer(model.paths, model.tables).weights
    slope, curve = np.zeros((16, 4)), np.zeros((16, 4, 4))
    for tables, parts in zip(counts[::-1], halves):
        found, pair, signs, _ = mixing.Mixer(model.paths, predicted(tables)).inputs(parts)
        for x, g, sign in zip(found.T / mixing.SCALE, mixing._GATE[pair], signs):
            p = 1 / (1 + math.exp(-float(x @ start[g])))
            slope[g] += x * ((sign > 0) - p)
            curve[g] += p * (1 - p) * np.outer(x, x)
    moved = start + np.linalg.solve(curve + mixing.HOLD * np.eye(4), slope[:, :, None])[:, :, 0]
    assert np.abs(moved - start).max() > 0.05
    assert model.weights == pytest.approx(moved, abs=1e-3)


def test_scores_are_probabilities():
    """Over all bytes that may come next, the probabilities add up to one."""
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choice("abc") for _ in range(3)) for _ in range(30)) for _ in range(20)]
    paths = mixing.Paths(np.bincount(np.frombuffer("".join(texts).encode(), np.uint8), minlength=256))
    rng_ = np.random.default_rng(1)
    tables = [rng_.integers(-60, 60, 1 << b, dtype=np.int8) for b in mixing.SLOT_BITS]
    model = mixing.Mixer(paths, tables)
    for prefix in (b"", b"abc ab"):
        scores = model.score([prefix + bytes([b]) for b in range(256)])
        head = model.score([prefix])[0] if prefix else 0.0
        assert (10 ** (scores - head)).sum() == pytest.approx(1, abs=1e-3)


def test_pairs_are_counted_as_their_decisions():
    """Counting each pair of context and byte once gives the counts of all decisions, one by one."""
    rng = random.Random(8)
    texts = [" ".join(rng.choice(("some", "words", "é", "x" * 80)) for _ in range(rng.randrange(60))) for _ in range(30)]
    parts = [mixing.canonical(t) for t in texts]
    paths = mixing.Paths(np.bincount(np.frombuffer(b"".join(parts), np.uint8), minlength=256))
    tables = [np.zeros(2 << b, np.uint32) for b in mixing.SLOT_BITS]
    mixing.add_counts(tables, paths, parts)
    expected = [Counter() for _ in tables]
    for part in parts:
        symbols, bases, real = mixing.contexts([part])
        for i in np.flatnonzero(real):
            start = paths.starts[symbols[i]]
            for at in range(start, start + paths.lengths[symbols[i]]):
                for seen, base, bits in zip(expected, bases, mixing.SLOT_BITS):
                    seen[int((base[i] ^ paths.places[at]) & ((1 << bits) - 1)) * 2 + int(paths.branches[at])] += 1
    for table, seen in zip(tables, expected):
        assert {int(i): int(table[i]) for i in np.flatnonzero(table)} == seen


def test_long_texts_are_scored_together(monkeypatch):
    """Texts of unlike lengths share a group, so that steps are not spent on one text each, and a
    score is that of the text alone."""
    rng = random.Random(9)
    texts = [b"".join(rng.choice((b"some ", b"words ", b"or other ")) for _ in range(n)) for n in range(1, 1600, 40)]
    paths = mixing.Paths(np.bincount(np.frombuffer(b"".join(texts), np.uint8), minlength=256))
    rng_ = np.random.default_rng(2)
    model = mixing.Mixer(paths, [rng_.integers(-60, 60, 1 << b, dtype=np.int8) for b in mixing.SLOT_BITS])
    groups, refine = [], mixing.Mixer.refine
    monkeypatch.setattr(mixing.Mixer, "refine", lambda self, parts, *own: groups.append(len(parts)) or refine(self, parts, *own))
    together = model.score(texts)
    assert sum(groups) == 40 and len(groups) == 1
    assert together.tolist() == [model.score([t])[0] for t in texts]


def test_long_texts_are_scored_whole(monkeypatch):
    paths = mixing.Paths(np.ones(256))
    model = mixing.Mixer(paths, [np.zeros(1 << b, np.int8) for b in mixing.SLOT_BITS])
    data = b"word " * 300_000
    assert model.score([data])[0] == pytest.approx(-8 * len(data) * math.log10(2), rel=0.5)


def test_empty_tables(spark):
    docs = frame(spark, [])
    assert bpe.encode_documents(docs, ranks_path(), pretoken_pattern()).count() == 0
    assert wordpiece.count_pieces(docs, ["a"], ["b"]).count() == 0
    model = language.train(docs)
    assert language.identify(docs, model).count() == 0
    assert mixing.score_documents(docs, id_remainder(10) == 0, id_remainder(10) == 1).count() == 0
    some = frame(spark, documents()[:5])
    assert {r["lang_pred"] for r in result(language.identify(some, model))} == {"und"}


def test_contexts_of_neighbours_do_not_mix():
    parts = [mixing.canonical(t) for t in ("some words here", "x", "other words", "", "some words here")]
    symbols, bases, real = mixing.contexts(parts)
    ends = np.cumsum([len(p) + 4 for p in parts])
    for part, end in zip(parts, ends):
        own, alone, _ = mixing.contexts([part])
        assert (symbols[end - len(part) : end] == own[4:]).all()
        assert (bases[:, end - len(part) : end] == alone[:, 4:]).all()
    word = bases[2]  # the same word so far has the same context wherever it stands
    assert word[4 + 7] == word[ends[2] - len(parts[2]) + 8]
    assert bases[3][4 + 7] != bases[3][ends[2] - len(parts[2]) + 8]
