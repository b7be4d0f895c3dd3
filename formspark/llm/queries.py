"""The queries of this package over the benchmark tables: one for each operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, html, katz, langid, mixing, ranked, setjoin, sharding, substring, topk, url_filters, whiten
from ._tables import ready

#: The rules of the URL query.
URL_RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every twentieth vector against all others."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stretch of a document that is within the edit budget of a benchmark item."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from four fifths of the labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = remainder("doc_id", 5) == 0
    net = langid.fit(docs, ~held_out)
    return langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), net).drop("text")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document: 4-word shingles, similarity 0.85."""
    return setjoin.join(table(spark, sf_dir, "documents"), k=4, percent=85)


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal conversations of the log, rendered."""
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without words of 50-word windows that start in an earlier document."""
    return substring.dedup(table(spark, sf_dir, "documents"), window=50).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the weights 5, 2, 1."""
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    return url_filters.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).drop("url")


SHARDS = sharding.even_tree(2, 2, 4)


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards, and where they go with a seventeenth."""
    return sharding.shard(table(spark, sf_dir, "documents"), SHARDS).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def remainder(key: str, n: int):
    """crc32 of a key as text, modulo n; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % n


def op10_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probabilities of all documents under a model of those not held out."""
    return katz.score(table(spark, sf_dir, "documents"), remainder("doc_id", 7) == 2)


def op11_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings on their first four principal components, whitened."""
    vectors = table(spark, sf_dir, "embeddings")
    w = whiten.fit(vectors, components=4)
    out = whiten.whiten(vectors, w).select("vec_id", F.posexplode("whitened").alias("at", "whitened"), F.col("deviation").cast("long").alias("deviation"))
    n, error, shares = (w.n, w.error, [float(v) / w.trace for v in w.values]) if w else (0, 0.0, [])
    explained = F.get(F.array(*[F.lit(s) for s in shares]).cast("array<double>"), F.col("at"))
    return out.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                      explained.alias("explained"), F.lit(error).cast("double").alias("identity_error"))


def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that score highest for every benchmark item."""
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


QUERIES = {
    "op1_topk": op1_topk,
    "op2_decontaminate": op2_decontaminate,
    "op3_language_id": op3_language_id,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_chat": op5_chat,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_mix": op7_mix,
    "op8_url_filters": op8_url_filters,
    "op9_shards": op9_shards,
    "op10_katz": op10_katz,
    "op11_whiten": op11_whiten,
    "op12_html_text": op12_html_text,
    "op13_search": op13_search,
}
