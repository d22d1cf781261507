"""Grouped cases, TF-IDF and retrieval."""

from pyspark.sql import functions as F

from caseloom.operators import similarity as S
from caseloom.plans.catalogue import bindings as B
from caseloom.plans.catalogue import query
from caseloom.session import store

DOCS = {"docs": "SELECT customer_tweet_id AS doc_id, any_value(customer_message) AS body FROM corpus GROUP BY 1"}


@query(
    "A13_grouped_cases",
    B.with_views(
        "dated_pairs",
        """SELECT customer_tweet_id AS doc_id, min(customer_message) AS customer_message,
        'CASE_' || CAST(customer_tweet_id AS VARCHAR) AS case_id, min_by(brand_reply, row(brand_tweet_id, brand_reply)) AS brand_reply,
        count(*) AS n_replies FROM dated_pairs GROUP BY customer_tweet_id""",
    ),
)
def grouped(spark, sf):
    from caseloom.operators import cases

    rows = cases.build_cases(B.dated(spark, sf)).withColumn("intent", F.lit("other"))
    return S.group_cases(rows).select("doc_id", "customer_message", "case_id", "brand_reply", "n_replies")


@query(
    "A13_all_replies",
    B.with_views("dated_pairs", "SELECT customer_tweet_id AS doc_id, brand_tweet_id AS reply_order, brand_reply FROM dated_pairs"),
)
def all_replies(spark, sf):
    from caseloom.operators import cases

    return S.replies_of(cases.pair_messages(B.dated(spark, sf)))


TF = B.tfidf_ctes("d", "documents_view")
TF_DOCS = {"documents_view": "SELECT doc_id, text AS body FROM documents"}


def _doc_counts(spark, sf):
    docs = B.table(spark, sf, "documents").select("doc_id", "text")
    counts = S.term_counts(docs, "doc_id", "text", B.STOPS)
    return counts, S.vocabulary(counts, S.n_rows(docs))


@query("M3_term_counts", B.with_views("", "SELECT doc_id, term, tf FROM d_counts", TF_DOCS | TF))
def term_counts(spark, sf):
    return _doc_counts(spark, sf)[0]


@query("M3_vocabulary", B.with_views("", "SELECT term, frequency, df, round(idf, 6) AS idf FROM d_vocab", TF_DOCS | TF))
def vocabulary(spark, sf):
    return _doc_counts(spark, sf)[1].select("term", "frequency", "df", F.round("idf", 6).alias("idf"))


@query("M3_tfidf_weights", B.with_views("", "SELECT doc_id, term, round(weight, 6) AS weight FROM d_weights", TF_DOCS | TF))
def weights(spark, sf):
    return S.tfidf(*_doc_counts(spark, sf)).select("doc_id", "term", F.round("weight", 6).alias("weight"))


def _index(spark, sf):
    return S.build_index(B.case_splits(spark, sf).where("split = 'train'"), B.STOPS, keep=store)


def looked_up(spark, sf):
    """The index of the training cases, and what is asked."""
    splits = store(B.case_splits(spark, sf))
    return S.build_index(splits.where("split = 'train'"), B.STOPS, keep=store), B.asked(spark, sf, splits)


CORPUS = DOCS | B.tfidf_ctes("c", "docs")


@query(
    "M5_corpus_postings",
    B.with_views(
        "corpus",
        """SELECT vec_id, term, round(weight, 6) AS weight FROM (
          SELECT doc_id, term, weight, min(doc_id) OVER (PARTITION BY v, term) AS vec_id FROM c_weights
          JOIN (SELECT doc_id, string_agg(term || ':' || CAST(round(weight, 9) AS VARCHAR), ' ' ORDER BY term) AS v
                FROM c_weights GROUP BY 1) k USING (doc_id)) x WHERE doc_id = vec_id""",
        CORPUS,
    ),
)
def postings(spark, sf):
    return _index(spark, sf).postings.drop("df", "level").withColumn("weight", F.round("weight", 6))


@query(
    "M5_corpus_cases",
    B.with_views(
        "corpus",
        """SELECT customer_tweet_id AS doc_id, min(customer_message) AS customer_message, min(case_id) AS case_id,
        min(intent) AS intent, min_by(brand_reply, row(brand_tweet_id, brand_reply)) AS brand_reply, count(*) AS n_replies
        FROM corpus GROUP BY 1""",
    ),
)
def corpus_cases(spark, sf):
    c = _index(spark, sf).cases
    return c.select("doc_id", "customer_message", "case_id", "intent", "brand_reply", "n_replies")


def searches(source):
    """What the messages of a view find in the training cases."""
    return CORPUS | {"questions": f"SELECT message_id AS doc_id, message AS body FROM {source}", **B.tfidf_ctes("q", "questions", "c_vocab"), **FOUND}


FOUND = {
    "scores": """SELECT q.doc_id AS message_id, c.doc_id AS doc_id, sum(q.weight * c.weight) AS score
                 FROM q_weights q JOIN c_weights c USING (term) GROUP BY 1, 2""",
    "top": """SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY round(score, 9) DESC, doc_id) AS place FROM scores
              WHERE score > 0 QUALIFY place <= 3""",
}
QUERIES = searches("asked")


def _retrieved(spark, sf, **options):
    index, asked = looked_up(spark, sf)
    return S.retrieve(asked, index, **options)


@query(
    "M4_retrieval",
    B.with_views(
        "corpus asked",
        """SELECT i.message_id AS message_id, coalesce(max(score) >= 0.15, FALSE) AS sufficient,
        coalesce(round(max(score), 4), 0.0) AS top_similarity, count(doc_id) AS n_results
        FROM asked i LEFT JOIN top USING (message_id) GROUP BY 1""",
        QUERIES,
    ),
)
def retrieval(spark, sf):
    r = _retrieved(spark, sf)
    return r.select("message_id", "retrieval.sufficient", "retrieval.top_similarity", F.col("retrieval.n_results").cast("long").alias("n_results"))


@query(
    "W7_top_cases",
    B.with_views(
        "corpus asked",
        """SELECT message_id, place, 'CASE_' || CAST(doc_id AS VARCHAR) AS case_id, round(score, 4) AS similarity_score,
        l.intent AS intent, l.brand_reply AS brand_reply FROM top
        JOIN (SELECT customer_tweet_id, min(intent) AS intent, min_by(brand_reply, row(brand_tweet_id, brand_reply)) AS brand_reply
              FROM corpus GROUP BY 1) l ON l.customer_tweet_id = top.doc_id""",
        QUERIES,
    ),
)
def top_cases(spark, sf):
    r = _retrieved(spark, sf).select("message_id", F.posexplode("retrieval.top_cases").alias("p", "c"))
    return r.select(
        "message_id",
        (F.col("p") + 1).cast("long").alias("place"),
        "c.case_id",
        "c.similarity_score",
        "c.intent",
        "c.brand_reply",
    )


@query(
    "J8_rare_term_search",
    B.with_views(
        "corpus asked",
        "SELECT message_id, place, 'CASE_' || CAST(doc_id AS VARCHAR) AS case_id, round(score, 4) AS similarity_score FROM top",
        QUERIES,
    ),
)
def rare_term_search(spark, sf):
    """The same result from so small a first budget that most queries need several rounds of blocks."""
    r = _retrieved(spark, sf, budget=60)
    r = r.select("message_id", F.posexplode("retrieval.top_cases").alias("p", "c"))
    return r.select("message_id", (F.col("p") + 1).cast("long").alias("place"), "c.case_id", "c.similarity_score")
