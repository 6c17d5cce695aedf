"""Registered queries over documents, pages and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marea.operators import chunking, embedding, html, prompts, retrieval
from marea.plans.inputs import PARAGRAPH_BREAK, SCORE_DIGITS, table, texts
from marea.session import scratch_path
from marea.sources.readers import read_table
from marea.sources.writers import write_layer


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.chunk_documents(texts(spark, sf_dir, "documents"), sep=PARAGRAPH_BREAK)


def split_paragraphs(spark, sf_dir):
    return chunking.split_paragraphs(texts(spark, sf_dir, "documents"), sep=PARAGRAPH_BREAK)


def filter_paragraphs(spark, sf_dir):
    return chunking.filter_paragraphs(texts(spark, sf_dir, "documents"), sep=PARAGRAPH_BREAK)


def chunk_documents(spark, sf_dir):
    return _chunks(spark, sf_dir)


def chunk_stats(spark, sf_dir):
    return chunking.chunk_stats(_chunks(spark, sf_dir))


def chunk_stats_total(spark, sf_dir):
    return chunking.chunk_stats(_chunks(spark, sf_dir), None)


def chunk_preview(spark, sf_dir):
    return chunking.chunk_preview(_chunks(spark, sf_dir))


def html_to_text(spark, sf_dir):
    return html.html_to_text(texts(spark, sf_dir, "pages"))


def html_chunks(spark, sf_dir):
    """Pages to text to chunks; page paragraphs are separated by blank lines."""
    pages = html.html_to_text(texts(spark, sf_dir, "pages"))
    return chunking.chunk_documents(pages, id_col="page_id")


def embed_hash(spark, sf_dir):
    """Non-zero weights of every document's vector, one row each."""
    vectors = embedding.embed_hash(texts(spark, sf_dir, "documents"), "text")
    # The outer form keeps the optimizer from inferring a filter on the vector, which
    # would compute every vector twice.
    return (vectors.select("doc_id", F.posexplode_outer("embedding").alias("bucket", "weight"))
            .where("weight <> 0")
            .select("doc_id", "bucket", F.round(F.col("weight").cast("double"), 6).alias("weight")))


def embedding_stats(spark, sf_dir):
    return embedding.embedding_stats(table(spark, sf_dir, "embeddings"))


def _vector_table(spark, sf_dir) -> DataFrame:
    """Chunks with vectors, written as a silver table and read back."""
    vectors = embedding.embed_hash(_chunks(spark, sf_dir), "chunk_text")
    path = write_layer(vectors.select("chunk_id", "chunk_text", "embedding"),
                       scratch_path(spark, "layers"), "silver", "chunk_vectors")
    return read_table(spark, path)


def vector_table(spark, sf_dir):
    return _vector_table(spark, sf_dir).select(
        "chunk_id", "chunk_text", F.size("embedding").alias("dims"),
        F.size(F.filter("embedding", lambda x: x != 0)).alias("n_used"))


def stored_topk(spark, sf_dir):
    """The three best chunks per benchmark item, out of the stored vector table."""
    return prompts.retrieve_stored(_vector_table(spark, sf_dir), table(spark, sf_dir, "benchmark"),
                                   question_id="item_id", question_text="text", digits=SCORE_DIGITS)


def _label_questions(spark, sf_dir) -> DataFrame:
    """One question per label: the mean vector of its members."""
    means = retrieval.mean_vectors(table(spark, sf_dir, "embeddings"), "label", digits=6)
    return means.withColumnRenamed("label", "question")


def vector_topk(spark, sf_dir):
    hits = retrieval.top_k(table(spark, sf_dir, "embeddings"), _label_questions(spark, sf_dir),
                           id_cols=["vec_id"], question_id="question", digits=SCORE_DIGITS)
    return hits.drop("score")


def vector_topk_scored(spark, sf_dir):
    return retrieval.top_k(table(spark, sf_dir, "embeddings"), _label_questions(spark, sf_dir),
                           k=10, id_cols=["vec_id"], question_id="question", metric="cosine",
                           min_score=0.2, digits=SCORE_DIGITS)


def chunk_topk(spark, sf_dir):
    """The three best chunks, with text, for every benchmark item as a question."""
    return prompts.retrieve_chunks(
        texts(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
        question_id="item_id", question_text="text", sep=PARAGRAPH_BREAK, digits=SCORE_DIGITS)


def _contexts(spark, sf_dir) -> DataFrame:
    return prompts.assemble_context(chunk_topk(spark, sf_dir), "item_id", "chunk_text")


def rag_context(spark, sf_dir):
    return _contexts(spark, sf_dir)


def rag_answerable(spark, sf_dir):
    """Questions against the chunks that reach a minimum score only, so that some
    questions find no context."""
    hits = chunk_topk(spark, sf_dir).where("score >= 0.9")
    contexts = prompts.assemble_context(hits, "item_id", "chunk_text").select("item_id", "context", "n_chunks")
    return (prompts.answerable(table(spark, sf_dir, "benchmark"), contexts, "item_id")
            .select("item_id", "answerable", "n_chunks", "reply"))


def rag_prompts(spark, sf_dir):
    return prompts.prompt_rows(table(spark, sf_dir, "benchmark"), _contexts(spark, sf_dir),
                               "item_id", "text")


def rag_batch(spark, sf_dir):
    """The user turns of all conversations as questions, grounded in the documents."""
    turns = table(spark, sf_dir, "conversations").where("role = 'user'")
    questions = turns.select(F.concat_ws("-", "conv_id", "turn").alias("question"), "text")
    return prompts.ground_questions(
        texts(spark, sf_dir, "documents"), questions, question_id="question",
        question_text="text", sep=PARAGRAPH_BREAK, digits=SCORE_DIGITS)


QUERIES = {f.__name__: f for f in (
    split_paragraphs, filter_paragraphs, chunk_documents, chunk_stats, chunk_stats_total,
    chunk_preview, html_to_text, html_chunks, embed_hash, embedding_stats, vector_table,
    stored_topk, vector_topk,
    vector_topk_scored, chunk_topk, rag_context, rag_answerable, rag_prompts, rag_batch)}
