"""Merkle manifests, quality ranking and periodic runs."""

import hashlib
import itertools
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapgraph.llm import merkle, periods, quality, queries
from tests.llm.fixtures import SPACE, by_id, documents, frame, result


def sha(data: str) -> str:
    return hashlib.sha256(data.encode()).hexdigest()


def digits(doc_id) -> bytes:
    return b"" if doc_id is None else str(doc_id).encode()


def save(tmp_path, spark, rows):
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


# Merkle manifest


def plain_levels(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        level = levels[-1]
        levels.append([sha("".join(level[i : i + 2])) for i in range(0, len(level), 2)])
    return levels


def plain_manifest(rows):
    """Rows (doc_id, source, lang, n_chars, text), all at once and sorted."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda row: sha("".join(map(field, row)))
    groups = {}
    for row in rows:
        groups.setdefault("-" if row[2] is None else "=" + row[2], []).append(row)
    names = sorted(groups, key=str.encode)
    ordered = {g: sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in names}
    trees = {g: plain_levels([leaf(r) for r in ordered[g]]) for g in names}
    top = plain_levels([trees[g][-1][0] for g in names])
    out = []
    for at, g in enumerate(names):
        for i, row in enumerate(ordered[g]):
            path = []
            for levels, place in ((trees[g], i), (top, at)):
                for level in levels[:-1]:
                    path.append((place & 1, level[place ^ 1] if place ^ 1 < len(level) else None))
                    place >>= 1
            claimed = row
            if zlib.crc32(digits(row[0])) % 7 == 0 and row[3] is not None:
                claimed = (*row[:3], row[3] + 1, row[4])
            node = leaf(claimed)
            for right, other in path:
                node = sha(node if other is None else other + node if right else node + other)
            out.append((row[0], leaf(row), trees[g][-1][0], top[-1][0], sha("".join(o for _, o in path if o)), node, node == top[-1][0]))
    return out


def check_manifest(spark, tmp_path, rows):
    found = queries.op11_merkle(spark, save(tmp_path, spark, rows)).collect()
    full = [(i, s, lang, None if t is None else len(t), t) for i, t, lang, s in rows]
    assert sorted(map(tuple, found), key=repr) == sorted(plain_manifest(full), key=repr)


def test_manifest(spark, tmp_path):
    check_manifest(spark, tmp_path, documents())


def test_manifest_of_blocks_and_hot_ids(spark, tmp_path):
    """More leaves than a block has slots; a third of the rows share an id, many are equal."""
    rng = random.Random(11)
    rows = [(rng.randrange(-(10**12), 10**12), f"t{i % 700}", "en", "s") for i in range(2500)]
    rows += [(7, f"t{i % 3}", "en", "s") for i in range(1300)] + [(None, "x", "fr", None)] * 40
    rows += [(i, "y", f"l{i}", "s") for i in range(30)] + [(2**63 - 1, "z", "en", "s"), (-(2**63), "z", "en", "s")]
    check_manifest(spark, tmp_path, rows)


def test_manifest_small(spark, tmp_path):
    assert queries.op11_merkle(spark, save(tmp_path / "none", spark, [])).collect() == []
    check_manifest(spark, tmp_path / "one", [(5, "a", "en", "s")])
    check_manifest(spark, tmp_path / "two", [(5, "a", "en", "s"), (6, None, None, None)])


def test_path_of_any_row_proves_it(spark):
    found = merkle.manifest(frame(spark, documents()))
    wrong = found.where(merkle.fold(F.col("leaf"), F.col("path")) != F.col("root"))
    assert wrong.count() == 0 and found.select("root").distinct().count() == 1


def test_directory(spark):
    rng = random.Random(3)
    counts = [(g, at, rng.randint(1, 5)) for g in "ab" for at in sorted(rng.sample(range(-(2**57), 2**57), 50)) + list(range(200))]
    found = {(r.g, r.at): r.base for r in merkle.offsets(spark.createDataFrame(counts, "g string, at long, n long")).collect()}
    for g in "ab":
        own = sorted((at, n) for h, at, n in counts if h == g)
        before = [0, *itertools.accumulate(n for _, n in own)]
        assert [found[g, at] for at, _ in own] == before[:-1]


# Quality


def test_bradley_terry_finds_the_minimum():
    rng = np.random.default_rng(5)
    pairs = rng.normal(size=(500, 4)) + [0.8, -0.3, 0, 0.1]
    loss = lambda w: np.log1p(np.exp(-pairs @ w)).mean() + quality.RIDGE / 2 * w @ w
    weights = quality.bradley_terry(pairs)
    for i in range(4):
        for step in (-1e-3, 1e-3):
            moved = weights.copy()
            moved[i] += step
            assert loss(moved) > loss(weights)


def graded(spark, n=400):
    rng = random.Random(9)
    rows, marks = [], []
    for i in range(n):
        own = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 8))) for _ in range(rng.randint(1, 80))]
        bad = rng.random() < 0.25
        text = " ".join(w.upper() + "!!" for w in own) if bad and i % 2 else " ".join(own[:1] * 40) if bad else " ".join(own)
        rows.append((i, text, "en", "s"))
        marks.append((i, int(not bad)))
    return rows, marks


def test_quality_held_out(spark, tmp_path):
    rows, marks = graded(spark)
    rows += [(None, "a b", "en", "s"), (900, None, None, None), (901, "", None, None), (5, "MORE!! TEXT!!", "en", "s"), rows[3], rows[3]]
    path = save(tmp_path, spark, rows)
    labels = [(*m, 0, "x") for m in marks] + [(None, 1, 0, "x"), (3, None, 0, "x"), (7, 0, 0, "x"), (7, 1, 0, "x"), (5000, 1, 0, "x")]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string").write.parquet(path + "/labels.parquet")
    found = queries.op12_quality(spark, path).collect()
    assert by_id((r.doc_id,) for r in found) == by_id((r[0],) for r in rows)
    truth = dict(marks)
    unseen = [r for r in found if r.held_out and r.doc_id in truth]
    assert len(unseen) > 50 and sum(r.predicted == truth[r.doc_id] for r in unseen) >= 0.97 * len(unseen)
    for r in found:
        assert r.held_out == (zlib.crc32(digits(r.doc_id)) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    assert len({r.score for r in found if r.doc_id in (900, 901)}) == 1


def test_quality_learns_from_labels_alone(spark):
    """Texts without labels, and labels of other rows, leave the model as it is."""
    rows, marks = graded(spark, 120)
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    model = quality.fit(frame(spark, rows), labels)
    more = quality.fit(frame(spark, [*rows, (5000, "noise " * 50, "en", "s")]), labels)
    np.testing.assert_allclose(model.weights, more.weights)
    strengths = model.strengths(np.stack([quality.features(t.encode()) for _, t, *_ in rows]))
    below = (strengths < model.offset).mean()
    assert below == pytest.approx(1 - np.mean([m for _, m in marks]), abs=0.02)


def test_quality_without_pairs(spark):
    docs = frame(spark, [(1, "a", "en", "s"), (2, None, None, None)])
    schema = "doc_id long, quality int"
    for marks, expected in (([], 0.5), ([(1, 1)], 1.0), ([(2, 0)], 0.0)):
        model = quality.fit(docs, spark.createDataFrame(marks, schema))
        for row in quality.score_documents(docs, model).collect():
            assert row.score == pytest.approx(expected, abs=1e-6)
    assert quality.score_documents(docs.limit(0), model).collect() == []


def test_feature_pieces(monkeypatch):
    data = " ".join(f"Word{i}, x!\n" for i in range(300)).encode()
    whole = quality.features(data)
    monkeypatch.setattr(quality, "_PIECE", 100)
    np.testing.assert_array_equal(whole, quality.features(data))


# Periodic runs


def plain_runs(words, min_length=6, min_exponent=4):
    found = []
    for q in range(1, len(words) // min_exponent + 1):
        same = [a == b for a, b in zip(words, words[q:], strict=False)]
        begin = 0
        for equal, part in itertools.groupby(same):
            n = len(list(part))
            if equal and n + q >= max(min_length, min_exponent * q):
                run = words[begin : begin + n + q]
                if not any(run[d:] == run[:-d] for d in range(1, q)):
                    found.append((begin, n + q, q))
            begin += n
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    rng = random.Random(13)
    for _ in range(700):
        own = [rng.choice("abcd"[: rng.randint(1, 4)]) for _ in range(rng.randint(0, 45))]
        if own and rng.random() < 0.5:
            begin, p = rng.randrange(len(own)), rng.randint(1, 6)
            own = [own[i] if i < begin else own[begin + (i - begin) % p] if begin + (i - begin) % p < len(own) else own[i] for i in range(len(own))]
        for limits in ((6, 4), (2, 2), (6, 3)):
            expected = plain_runs(own, *limits)
            finder = periods.PeriodicRuns(*limits)
            texts = [" ".join(own).encode(), None, " ".join(own[::-1]).encode()]
            first, none, last = finder.of_texts([1, 2, 3], texts)
            assert first[1] == expected and last[1] == plain_runs(own[::-1], *limits)
            assert none == (0, [], None, b"")


def test_suffix_tree():
    rng = random.Random(2)
    for _ in range(60):
        own = [rng.randint(1, 3) for _ in range(rng.randint(1, 40))]
        tree = periods.SuffixTree(own, 4)
        suffixes = [[*own[i:], 0] for i in range(len(own) + 1)]
        assert tree.rank.tolist() == [sorted(suffixes).index(s) for s in suffixes]
        pairs = [(i, j) for i in range(len(own)) for j in range(len(own)) if i != j]
        if pairs:
            left, right = np.array(pairs).T
            expected = [next(k for k in itertools.count() if suffixes[i][k] != suffixes[j][k]) for i, j in pairs]
            assert tree.lce(left, right).tolist() == expected


def test_runs_of_documents(spark, tmp_path):
    rows = documents() + [(500, "a b c " * 9 + "d", "en", "s"), (501, "  x y " * 8, "en", "s"), (502, " ".join(["u v"] * 3000), "en", "s")]
    found = queries.op13_runs(spark, save(tmp_path, spark, rows))
    expected = []
    for doc_id, text, *_ in rows:
        words = SPACE.findall(text or "")
        n, h = len(words), zlib.crc32(digits(doc_id))
        if h % 10 == 0 and n:
            a, g = h // 10 % n, h // 10
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words) if n < 2000 or len(set(words)) < 5 else []
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        expected.append((
            doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
        ))
    assert by_id(tuple(r.values()) for r in result(found)) == by_id(expected)
    assert any(r[1] for r in expected)
    assert queries.op13_runs(spark, save(tmp_path / "none", spark, [])).collect() == []
