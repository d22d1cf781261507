"""Named queries ``opN_<name>`` over the given tables, with SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm import alignment, collocations, extraction, language, merges, packing, perspectives, simhash, spotsigs, substring, token_shards, topk, toxicity
from caseloom.llm.batches import small_batches
from caseloom.llm.grams import crc_of_id
from caseloom.session import shared_folder

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            shared_folder(spark)
            small_batches(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op1_token_shards")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's ids, written to indexed binary shards and read back by key."""
    return token_shards.round_trip(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query(
    "op2_relative_parsing",
    r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    spans AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s FROM (SELECT *, unnest(generate_series(1, len(w) - 49)) AS i FROM d) x),
    firsts AS (SELECT s, min(doc_id) AS owner FROM spans GROUP BY s),
    gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS p FROM spans JOIN firsts USING (s) WHERE owner < doc_id),
    words AS (SELECT doc_id, p, w[p] AS word FROM (SELECT *, unnest(generate_series(1, len(w))) AS p FROM d) x),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
    SELECT d.doc_id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
    """,
)
def op2(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of every document without the passages of 50 words that smaller documents have."""
    return substring.remove_repeats(table(spark, sf, "documents"), window=50, keep_text=False)


@query(
    "op3_sorted_list_topk",
    """
    WITH vec AS (
      SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS x FROM embeddings
      WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ), pairs AS (
      SELECT q.vec_id AS query_id, v.vec_id,
             CAST(coalesce(list_sum([q.x[i] * v.x[i] FOR i IN generate_series(1, len(q.x))]), 0) AS BIGINT) AS score
      FROM vec q JOIN vec v ON q.vec_id % 20 = 0 AND q.vec_id <> v.vec_id AND len(q.x) = len(v.x)
    )
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM pairs QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
    """,
)
def op3(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 best of all vectors for every vector whose id is divisible by 20."""
    return topk.nearest(table(spark, sf, "embeddings"), every=20, k=20)


@query("op4_toxicity")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels of three quarters of them."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    held_out = crc_of_id(F.col("doc_id")) % 4 == 2
    labels = table(spark, sf, "labels").select("doc_id", "toxic").where(~held_out)
    rated = toxicity.score(docs, toxicity.fit(docs, labels), threshold=0.3, keep_text=False)
    return rated.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op5_language_kernel")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every document, learnt from two thirds of them."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    held_out = crc_of_id(F.col("doc_id")) % 3 == 1
    model = language.fit(docs.where(~held_out))
    told = language.predict(docs.select("doc_id", "text"), model, keep_text=False)
    return told.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op6_spot_signatures")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints of every document and of its text after an edit, and how alike they are."""
    return spotsigs.edited_fingerprints(table(spark, sf, "documents"))


@query("op7_simhash_ball")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf, "documents"), shingle=4, radius=4)


@query("op8_best_fit_packing")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    """Where every piece of every document lies in sequences of 1024 tokens."""
    docs = table(spark, sf, "documents")
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), 1024, end_id=2, keep_ids=False)


@query(
    "op9_perspective_rotation",
    """
    WITH ranked AS (
      SELECT conv_id, turn, who, said, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, who, said) - 1 AS r
      FROM (SELECT conv_id, turn, replace(coalesce(role, 'unknown'), '<|', '<||') AS who, replace(coalesce(text, ''), '<|', '<||') AS said
            FROM conversations WHERE conv_id IS NOT NULL)
    ), turns AS (
      SELECT conv_id, CAST(r // 256 AS BIGINT) AS part, r, who, said FROM ranked
      UNION ALL
      SELECT o.conv_id, p.part, -1 AS r, o.who, o.said
      FROM ranked o JOIN (SELECT DISTINCT conv_id, CAST(r // 256 AS BIGINT) AS part FROM ranked WHERE r >= 256) p ON o.conv_id = p.conv_id
      WHERE o.r = 0 AND o.who = 'system'
    ), pieces AS (
      SELECT t.conv_id, s.speaker, t.part, t.who = s.speaker AS own,
             '<|' || CASE WHEN t.who = s.speaker THEN 'assistant' WHEN t.who = 'system' THEN t.who ELSE 'user ' || t.who END || '|>' || chr(10) AS head,
             t.said || '<|end|>' AS body,
             row_number() OVER (PARTITION BY t.conv_id, s.speaker, t.part ORDER BY t.r) AS i
      FROM turns t JOIN (SELECT DISTINCT conv_id, who AS speaker FROM turns WHERE who <> 'system') s ON t.conv_id = s.conv_id
    ), placed AS (
      SELECT *, CAST(coalesce(sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, speaker, part ORDER BY i
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS BIGINT) AS lo
      FROM pieces
    )
    SELECT conv_id, speaker, part, count(*) AS n_turns, string_agg(head || body || chr(10), '' ORDER BY i) AS text,
           coalesce(string_agg(lo || ':' || (lo + length(body)), ',' ORDER BY i) FILTER (WHERE own), '') AS mask
    FROM placed GROUP BY conv_id, speaker, part
    """,
)
def op9(spark: SparkSession, sf: str) -> DataFrame:
    """Every conversation once for each participant, who speaks as the assistant."""
    return perspectives.rotate(table(spark, sf, "conversations"))


@query("op10_merge_dropout")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's pieces under seeded merge-dropout, and whether they give its text again."""
    return merges.round_trip(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"), rate=0.1, seed=20)


@query("op12_token_alignment")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers over every document, with corpus-wide counts of linked ids."""
    docs = table(spark, sf, "documents")
    return alignment.alignment(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op13_html_extraction")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    return extraction.extract(pages, keep_html=False)


@query(
    "op11_collocations",
    r"""
    WITH d AS (
      SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
      FROM documents
    ), pieces AS (
      SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS p FROM d) x
    ), w1 AS (
      SELECT lang, w[i] AS phrase, count(*) AS f FROM (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM pieces) x GROUP BY ALL
    ), w2 AS (
      SELECT lang, w[i] AS a, w[i + 1] AS b, count(*) AS f FROM (SELECT lang, w, unnest(generate_series(1, len(w) - 1)) AS i FROM pieces) x GROUP BY ALL HAVING count(*) >= 10
    ), w3 AS (
      SELECT lang, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c, count(*) AS f FROM (SELECT lang, w, unnest(generate_series(1, len(w) - 2)) AS i FROM pieces) x GROUP BY ALL HAVING count(*) >= 10
    ), cuts AS (
      SELECT w2.lang AS lang, w2.a || ' ' || w2.b AS phrase, 1 AS k, w2.f AS a, x.f AS l, y.f AS r
      FROM w2 JOIN w1 x ON x.lang = w2.lang AND x.phrase = w2.a JOIN w1 y ON y.lang = w2.lang AND y.phrase = w2.b
      WHERE NOT EXISTS (FROM w3 t WHERE t.lang = w2.lang AND (t.a = w2.a AND t.b = w2.b OR t.b = w2.a AND t.c = w2.b) AND 100 * t.f >= 50 * w2.f)
      UNION ALL
      SELECT w3.lang, w3.a || ' ' || w3.b || ' ' || w3.c, 1, w3.f, x.f, y.f
      FROM w3 JOIN w1 x ON x.lang = w3.lang AND x.phrase = w3.a JOIN w2 y ON y.lang = w3.lang AND y.a = w3.b AND y.b = w3.c
      UNION ALL
      SELECT w3.lang, w3.a || ' ' || w3.b || ' ' || w3.c, 2, w3.f, x.f, y.f
      FROM w3 JOIN w2 x ON x.lang = w3.lang AND x.a = w3.a AND x.b = w3.b JOIN w1 y ON y.lang = w3.lang AND y.phrase = w3.c
    ), scored AS (
      SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts
      QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
    ), best AS (
      SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored QUALIFY rank <= 2000
    )
    SELECT lang, rank, phrase, a, l, r, n, score FROM best JOIN (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM w1 GROUP BY lang) t USING (lang)
    """,
)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    """The best 2,000 phrases of two or three words of each language."""
    return collocations.collocations(table(spark, sf, "documents"))
