"""Queries for documents, embeddings and nearest neighbours.

The questions are the mean vectors of the labels: read from the whole table,
one per label however large the table is.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from murmur.functions.text import tokenize_words
from murmur.operators import engagement, retrieval, vector_index
from murmur.operators.topics import communities
from murmur.plans.registry import query
from murmur.plans.scalars import TOKENS_SQL
from murmur.session import scratch_path
from murmur.sources import adapters

NEAREST_SQL = """
cells as (select label, unnest(embedding)::double x,
                 generate_subscripts(embedding, 1) i from embeddings),
means as (select label, list(m order by i) q
          from (select label, i, avg(x) m from cells group by 1, 2) group by 1),
pairs as (select m.label query_id, e.vec_id doc_id,
                 round(1 - list_cosine_similarity(e.embedding::double[], m.q), 12) distance
          from means m, embeddings e),
hits as (
  select query_id, doc_id, distance,
         cast(row_number() over (partition by query_id order by distance, doc_id) as int) "rank"
  from pairs qualify "rank" <= 5)"""


def label_questions(spark, folder):
    vectors = adapters.table(spark, folder, "embeddings")
    return retrieval.mean_vectors(vectors, "label").withColumnRenamed("label", "query_id")


def nearest(spark, folder):
    return retrieval.cosine_top_k(
        adapters.table(spark, folder, "embeddings"),
        label_questions(spark, folder),
        5,
        id_col="vec_id",
    )


def nearest_documents(spark, folder):
    documents = adapters.table(spark, folder, "documents").select(
        "doc_id", F.col("text").alias("document")
    )
    # Labels are few, but only a count says so.
    asked = label_questions(spark, folder).count()
    return retrieval.with_documents(nearest(spark, folder), documents, at_most=5 * asked)


@query(f"with {NEAREST_SQL} select query_id, doc_id, \"rank\", round(distance, 6) distance from hits")
def cosine_top_k(spark, folder):
    return nearest(spark, folder).withColumn("distance", F.round("distance", 6))


@query(f"with {NEAREST_SQL} select query_id, doc_id, \"rank\", round(distance, 6) distance from hits")
def cosine_top_k_approx(spark, folder):
    """By an index fitted to the table. Where its vectors are few, or have no structure that
    cells could follow, it looks into all of them, and the answer is the exact one."""
    vectors = adapters.table(spark, folder, "embeddings")
    asked = label_questions(spark, folder)
    index = vector_index.fit_index(vectors, "vec_id", questions=asked)
    encoded = vectors.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vec"))
    if index.probe:
        path = scratch_path(spark, "vector-index")
        vector_index.write_collection(vector_index.encode_collection(vectors, index, "vec_id"), path)
        encoded = spark.read.parquet(path)
    hits = vector_index.cosine_top_k_indexed(encoded, asked, index, 5)
    return hits.withColumn("distance", F.round("distance", 6))


@query(f"""
with {NEAREST_SQL}
select query_id, string_agg(text, chr(10) || chr(10) order by "rank") context
from hits join documents using (doc_id) group by 1
""")
def retrieval_context(spark, folder):
    return retrieval.retrieval_context(nearest_documents(spark, folder))


@query(f"""
with {NEAREST_SQL}
select query_id, "rank", doc_id, substr(text, 1, 200) || '...' preview,
       round(1 - distance, 2) relevance
from hits join documents using (doc_id)
""")
def document_preview(spark, folder):
    return retrieval.document_preview(nearest_documents(spark, folder))


@query(f"""
with tokens as ({TOKENS_SQL}),
top as (select token term, count(*) occurrences from tokens group by 1
        order by 2 desc, 1 limit 50),
f as (select *, (occurrences - min(occurrences) over ())
              / greatest(max(occurrences) over () - min(occurrences) over (), 1) factor from top)
select term, occurrences, round(14 + 34 * factor, 9) font_size,
       cast(floor(155 + 100 * factor) as int) blue
from f
""")
def wordcloud_weights(spark, folder):
    counts = engagement.word_frequencies(adapters.doc_posts(spark, folder), "cleaned_text")
    return retrieval.wordcloud_weights(counts).withColumn("font_size", F.round("font_size", 9))


@query(f"""
with tokens as ({TOKENS_SQL})
select 'doc_' || post_id id, 256 dims, cast(case when exists (
         select 1 from tokens t where t.post_id = d.post_id) then 1.0 else 0.0 end as double) norm
from doc_posts d
""")
def embed_text(spark, folder):
    """Ids, width and length: texts with a word become unit vectors."""
    documents = retrieval.compose_document(
        adapters.doc_posts(spark, folder), "prose", title_col=None
    )
    model = retrieval.fit_embedder(documents)
    squares = F.aggregate(
        F.col("embedding"), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")
    )
    return retrieval.embed_text(documents, model).select(
        "id", F.size("embedding").alias("dims"), F.round(F.sqrt(squares), 3).alias("norm")
    )


COLLECTION_TOPICS = {
    "french": {"posts": communities(["fr"])},
    "english": {"posts": communities(["en"])},
}


@query("""
with ranked as (
  select *, row_number() over (partition by subreddit order by created desc, post_id) r
  from doc_posts where cleaned_text is not null and subreddit in ('en', 'fr'))
select 'doc_' || post_id id, cleaned_title || chr(10) || cleaned_text document, subreddit, post_id,
       case subreddit when 'en' then 'english' else 'french' end topic, 'posts' source, 256 dims
from ranked where r <= 100
""")
def build_collection(spark, folder):
    path = scratch_path(spark, "collection")
    docs = adapters.doc_posts(spark, folder)
    parts = [
        retrieval.build_collection(docs, topic, "posts", path, topics=COLLECTION_TOPICS)
        for topic in COLLECTION_TOPICS
    ]
    return parts[0].unionByName(parts[1]).select(
        "id",
        "document",
        "metadata.subreddit",
        "metadata.post_id",
        F.col("metadata.topic").alias("topic"),
        "source",
        F.size("embedding").alias("dims"),
    )
