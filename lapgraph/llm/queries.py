"""The registered queries of the text operators, each over its whole tables."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapgraph.llm import (
    bpe, decontaminate, hamming, language, merkle, mixing, periods, quality, secrets, setsketch, shards, substrings,
    wordpiece,
)
from lapgraph.llm.common import table


def ranks_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pretoken_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.encode_documents(docs, ranks_path(), pretoken_pattern(), ids=False)


def id_remainder(divisor: int):
    """crc32 of the id's decimal digits modulo ``divisor``; a null id counts as no digits."""
    digits = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(digits.cast("binary")) % divisor


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remainder 0 is held out, all others fill the tables and fit the mixing weights, which set out from a sample of 1."""
    docs = table(spark, sf_dir, "documents")
    return mixing.score_documents(docs, id_remainder(10) == 0, id_remainder(10) == 1)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document is a repository, its source the owner."""
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return hamming.top_k(vectors, vectors.where("vec_id % 50 = 0"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(ranks_path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        starts, inners = wordpiece.pieces_of_ranks(bpe.read_ranks(file.read()))
    return wordpiece.count_pieces(table(spark, sf_dir, "documents"), starts, inners)


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"))


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(table(spark, sf_dir, "documents"))


def language_model(docs: DataFrame) -> language.PPM:
    return language.train(docs.where(id_remainder(4) != 2))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language_model(docs))
    return found.withColumn("held_out", id_remainder(4) == 2)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose id's crc32 is divisible by 7 claim one character more than they have."""
    docs = table(spark, sf_dir, "documents")
    more = {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    found = merkle.manifest(docs, more, id_remainder(7) == 0)
    folded = found.withColumn("folded_root", merkle.fold(F.col("claimed"), F.col("path")))
    return folded.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root",
        F.sha2(merkle.siblings(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of remainder 0 are held out."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels").where(id_remainder(5) != 0))
    found = quality.score_documents(docs, model).withColumnRenamed("id", "doc_id")
    return found.select(
        "doc_id", (id_remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= quality.CUT).cast("int").alias("predicted")
    )


def repeated_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """Places that give a tenth of the documents a tail of three to ten periods."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return None
    begin, places = h // 10 % n, np.arange(n)
    places[begin:] = begin + (places[begin:] - begin) % (1 + (n - begin) // (3 + h // 10 % 8))
    return places


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.find_runs(table(spark, sf_dir, "documents"), order_of=repeated_tail)
    line = lambda run: F.concat_ws(",", run["start"], run["length"], run["period"])
    lines = F.transform("runs", lambda run: F.concat(line(run), F.lit("\n")))
    return found.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_mixing": op2_mixing,
    "op3_secrets": op3_secrets,
    "op4_decontaminate": op4_decontaminate,
    "op5_top_k": op5_top_k,
    "op6_substrings": op6_substrings,
    "op7_token_counts": op7_token_counts,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_shards": op9_shards,
    "op10_language": op10_language,
    "op11_merkle": op11_merkle,
    "op12_quality": op12_quality,
    "op13_runs": op13_runs,
}
#: Checks that SQL can express.
ORACLES: dict[str, str] = {
    "op5_top_k": """
        WITH codes AS (
            SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS bits
            FROM embeddings WHERE len(embedding) > 0
        ), pairs AS (
            SELECT q.vec_id AS query_id, r.vec_id, list_sum(list_transform(
                list_zip(q.bits, r.bits), lambda t: CASE WHEN t[1] <> t[2] THEN 1 ELSE 0 END))::INT AS distance
            FROM codes q JOIN codes r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id
        )
        SELECT query_id, rank::INT AS rank, vec_id, distance FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM pairs
        ) WHERE rank <= 10
    """,
    "op11_merkle": """
        WITH RECURSIVE rows AS (
            SELECT doc_id, source, lang, n_chars, text, list_reduce(
                list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
                    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
            ) AS crc FROM documents
        ), hashed AS (
            SELECT doc_id, lang,
                sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
                sha256(head || coalesce(strlen((n_chars + t)::VARCHAR) || ':' || (n_chars + t), '-') || tail) AS claimed
            FROM (SELECT doc_id, lang, n_chars,
                CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN 1 ELSE 0 END AS t,
                coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                || coalesce(strlen(lang) || ':' || lang, '-') AS head,
                coalesce(strlen(text) || ':' || text, '-') AS tail FROM rows)
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
                count(*) OVER (PARTITION BY lang) AS n FROM hashed
        ), low(lang, l, p, h, n) AS (
            SELECT lang, 0, p, leaf, n FROM placed
            UNION ALL
            SELECT lang, l + 1, p // 2, sha256(string_agg(h, '' ORDER BY p)), (n + 1) // 2
            FROM low WHERE n > 1 GROUP BY lang, l, p // 2, n
        ), tops AS (
            SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS p, count(*) OVER () AS n,
                (SELECT max(l) FROM low) + 1 AS l FROM low WHERE n = 1
        ), high(l, p, h, n) AS (
            SELECT l, p, h, n FROM tops
            UNION ALL
            SELECT l + 1, p // 2, sha256(string_agg(h, '' ORDER BY p)), (n + 1) // 2
            FROM high WHERE n > 1 GROUP BY l, p // 2, n
        ), steps AS (
            SELECT lang, l, p, h FROM low WHERE n > 1
        ), walks AS (
            SELECT a.doc_id, a.lang, a.p AS leaf_p, s.l, (a.p >> s.l) & 1 AS side, b.h AS sibling
            FROM placed a JOIN (SELECT DISTINCT lang, l FROM steps) s ON a.lang IS NOT DISTINCT FROM s.lang
            LEFT JOIN steps b ON b.lang IS NOT DISTINCT FROM a.lang AND b.l = s.l AND b.p = xor(a.p >> s.l, 1)
            UNION ALL
            SELECT a.doc_id, a.lang, a.p, s.l, (t.p >> (s.l - t.l)) & 1, b.h
            FROM placed a JOIN tops t ON a.lang IS NOT DISTINCT FROM t.lang
            JOIN (SELECT DISTINCT l FROM high WHERE n > 1) s ON true
            LEFT JOIN high b ON b.l = s.l AND b.p = xor(t.p >> (s.l - t.l), 1)
        ), paths AS (
            SELECT lang, leaf_p, list({'side': side, 'sibling': sibling} ORDER BY l) AS path,
                sha256(coalesce(string_agg(sibling, '' ORDER BY l), '')) AS proof_sha256
            FROM walks GROUP BY lang, leaf_p
        ), folds(lang, p, i, h) AS (
            SELECT lang, p, 1, claimed FROM placed
            UNION ALL
            SELECT f.lang, f.p, i + 1, sha256(
                CASE WHEN path[i].sibling IS NULL THEN f.h WHEN path[i].side = 1 THEN path[i].sibling || f.h
                     ELSE f.h || path[i].sibling END)
            FROM folds f JOIN paths ON f.lang IS NOT DISTINCT FROM paths.lang AND f.p = leaf_p WHERE i <= len(path)
        ), folded AS (SELECT lang, p, arg_max(h, i) AS folded_root FROM folds GROUP BY lang, p)
        SELECT a.doc_id, a.leaf, t.h AS subroot, r.h AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
            folded_root, folded_root = r.h AS verified
        FROM placed a JOIN tops t ON a.lang IS NOT DISTINCT FROM t.lang
        JOIN (SELECT h FROM high WHERE n = 1) r ON true
        LEFT JOIN paths ON a.lang IS NOT DISTINCT FROM paths.lang AND a.p = leaf_p
        JOIN folded ON a.lang IS NOT DISTINCT FROM folded.lang AND a.p = folded.p
    """,
}
