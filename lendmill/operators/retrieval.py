"""Ranked document search by terms (BM25) and by vectors (cosine)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmill.fixed_values import BM25_B, BM25_K1
from lendmill.functions.text import tokens


# Columns of stored documents beside key, length and attributes.
WORDS, GONE = "_words", "_gone"

# What a document's row holds beside key and length where its postings are in the same table.
DOCUMENT = "_document"


@dataclass(frozen=True)
class SearchIndex:
    """``postings``: term, key, doc_len, tf. ``docs``: key, doc_len and attributes.

    ``counted`` is what both come from: the documents with their words counted. ``together`` holds
    both, made in one pass over the texts: a document's row has no term, a posting's no ``DOCUMENT``.
    An index that is kept up brings its ``totals`` (n_docs, total_len), one row, and ``documents``,
    which fetches the documents of a few keys without reading all.
    """

    postings: DataFrame
    docs: DataFrame
    key: str
    counted: DataFrame | None = None
    totals: DataFrame | None = None
    documents: Callable[[DataFrame], DataFrame] | None = None
    together: DataFrame | None = None


def postings_of(counted: DataFrame, key: str, *more: str) -> DataFrame:
    """A row per document and word."""
    # The outer form keeps Spark from splitting each text twice to drop empty ones.
    return (
        counted.select(key, "doc_len", *more, F.explode_outer(WORDS).alias("_word"))
        .select("_word.term", key, "doc_len", "_word.tf", *more)
        .filter(F.col("term").isNotNull())
    )


def build_index(
    docs: DataFrame, text: str, key: str, attributes: list[str] = (), deleted: str | None = None
) -> SearchIndex:
    """Term index over the whole text of every document; one row per document goes in.

    A row whose ``deleted`` column is true says that the document is gone.

    Words are counted inside the document's row: sorting brings equal words
    together, a word starts where its left neighbour differs and lasts to the
    next start. So no word is shuffled to be counted.
    """
    gone = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
    words = F.when(~gone, tokens(F.col(text)))
    split = docs.select(key, *attributes, gone.alias(GONE), words.alias("_tokens"))
    length = F.coalesce(F.size("_tokens"), F.lit(0)).alias("doc_len")
    ordered = split.select(key, *attributes, GONE, length, F.sort_array("_tokens").alias("_sorted"))
    is_start = F.transform(
        "_sorted", lambda w, i: F.when((i == 0) | (w != F.get("_sorted", i - 1)), i)
    )
    starts = ordered.withColumn("_starts", F.array_compact(is_start))
    counted = F.transform(
        "_starts",
        lambda at, i: F.struct(
            F.get("_sorted", at).alias("term"),
            (F.coalesce(F.get("_starts", i + 1), F.col("doc_len")) - at).cast("long").alias("tf"),
        ),
    )
    rows = starts.select(key, "doc_len", *attributes, GONE, counted.alias(WORDS))
    together = _together(starts, key, attributes)
    postings = together.filter(F.col("term").isNotNull()).select("term", key, "doc_len", "tf")
    plain = split.filter(~F.col(GONE)) if deleted else split
    return SearchIndex(postings, plain.select(key, length, *attributes), key, rows, together=together)


def _together(starts: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """A row per document and a row per document and word, told by the term.

    Only the places where a word starts are exploded; word and count are looked up from there,
    outside any lambda.
    """
    places = F.concat(F.array(F.lit(-1)), F.coalesce("_starts", F.array().cast("array<int>")))
    # The outer form keeps Spark from splitting each text twice to drop empty ones.
    placed = starts.select("*", F.posexplode_outer(places).alias("_next", "_at"))
    is_word = F.col("_at") >= 0
    end = F.coalesce(F.get("_starts", F.col("_next")), F.col("doc_len"))
    return placed.select(
        F.when(is_word, F.get("_sorted", F.col("_at"))).alias("term"),
        key,
        "doc_len",
        F.when(is_word, (end - F.col("_at")).cast("long")).alias("tf"),
        F.when(~is_word, F.struct(*attributes, GONE)).alias(DOCUMENT),
    )


def write_index(index: SearchIndex, path: str, part: int = 0) -> None:
    """Store one part of an index; writing the same part again replaces it.

    Texts are split once: documents are written with their words counted, and the
    postings come from that table. Postings are sorted by term within files, so a
    search skips the row groups that hold none of its terms.
    """
    spark, docs = index.counted.sparkSession, f"{path}/docs/part={part}"
    index.counted.write.mode("overwrite").parquet(docs)
    postings = postings_of(spark.read.parquet(docs), index.key)
    postings.sortWithinPartitions("term").write.mode("overwrite").parquet(
        f"{path}/postings/part={part}"
    )


def read_index(spark: SparkSession, path: str, key: str) -> SearchIndex:
    """The index as it now is: of each document the newest part counts, and a document that
    its newest part says is gone is not there. The term filter of a search still reaches
    the scan of the postings; what is joined to them is the few rows that hold a term."""
    docs = spark.read.parquet(f"{path}/docs")
    newest = docs.groupBy(F.col(key).alias("_key")).agg(F.max("part").alias("_part"))
    is_newest = (F.col(key) == F.col("_key")) & (F.col("part") == F.col("_part"))
    live = docs.join(newest, is_newest).filter(~F.col(GONE)).drop("_key", "_part", "part", GONE)
    postings = spark.read.parquet(f"{path}/postings").join(newest, is_newest, "left_semi")
    return SearchIndex(postings.drop("part"), live.drop(WORDS), key, live.withColumn(GONE, F.lit(False)))


def compact_index(spark: SparkSession, path: str, key: str, out: str) -> None:
    """The index in one part under another path, without replaced and removed documents."""
    write_index(read_index(spark, path, key), out)


def query_terms(spark: SparkSession, query: str) -> list[str]:
    """Distinct terms of a query, split as the documents are."""
    words = F.array_distinct(tokens(F.lit(query)))
    return spark.range(1).select(words.alias("terms")).first()["terms"]


def bm25(tf: Column, df: Column, doc_len: Column, n_docs: Column, mean_len: Column) -> Column:
    idf = F.log(1 + (n_docs - df + 0.5) / (df + 0.5))
    norm = BM25_K1 * (1 - BM25_B + BM25_B * doc_len / mean_len)
    return idf * tf * (BM25_K1 + 1) / (tf + norm)


def score_documents(index: SearchIndex, query: str) -> DataFrame:
    """Key and score of every document that holds a query term.

    The query's terms are a literal list, so a stored index skips all row
    groups without them. How many documents hold a term is one row per query
    term; corpus totals are scalar subqueries.
    """
    terms = query_terms(index.postings.sparkSession, query)
    hits = index.postings.filter(F.col("term").isin(terms))
    in_docs = hits.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    if index.totals is None:
        n_docs = index.docs.agg(F.count(F.lit(1))).scalar()
        mean_len = index.docs.agg(F.avg("doc_len")).scalar()
    else:
        n_docs = index.totals.select("n_docs").scalar()
        mean_len = index.totals.select(F.col("total_len").cast("double") / F.col("n_docs")).scalar()
    score = bm25(F.col("tf"), F.col("df"), F.col("doc_len"), n_docs, mean_len)
    return (
        hits.join(F.broadcast(in_docs), "term")
        .groupBy(index.key)
        .agg(F.sum(score).alias("score"))
    )


def search(index: SearchIndex, query: str, columns: list[str], k: int) -> DataFrame:
    """The k best documents with the requested attributes, best first."""
    best = score_documents(index, query)
    # Rank on the rounded score, so that the order does not hang on the last
    # bits of a sum whose terms arrive in any order.
    best = best.withColumn("score", F.round("score", 6))
    top = best.orderBy(F.desc("score"), index.key).limit(k)
    wanted = [c for c in columns if c != index.key]
    if wanted and index.documents:
        # the k rows are known before their documents are opened
        top = top.sparkSession.createDataFrame(top.collect(), top.schema)
        docs = index.documents(top.select(index.key))
        top = docs.select(index.key, *wanted).join(F.broadcast(top), index.key)
    elif wanted:
        top = index.docs.select(index.key, *wanted).join(F.broadcast(top), index.key)
    return top.select(index.key, *wanted, "score").orderBy(F.desc("score"), index.key).limit(k)


def search_texts(
    docs: DataFrame, text: str, key: str, query: str, columns: list[str], k: int
) -> DataFrame:
    """The same search without an index: two passes over the texts, nothing shuffled.

    The first pass reduces the corpus to one row of totals, the second scores
    every document within its row, and each task keeps its own k best.
    """
    terms = query_terms(docs.sparkSession, query)
    wanted = [c for c in columns if c != key]
    words = docs.select(key, *wanted, tokens(F.col(text)).alias("_tokens"))
    matched = words.select(
        key,
        *wanted,
        F.coalesce(F.size("_tokens"), F.lit(0)).alias("doc_len"),
        F.filter("_tokens", lambda w: w.isin(terms)).alias("_hits"),
    )
    holds = [
        F.count_if(F.array_contains("_hits", t)).alias(f"df{i}") for i, t in enumerate(terms)
    ]
    corpus = matched.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.avg("doc_len").alias("mean"), *holds)
    ).scalar()
    score = F.lit(0.0)
    for i, t in enumerate(terms):
        tf = F.size("_hits") - F.size(F.array_remove("_hits", t))
        score = score + bm25(tf, corpus[f"df{i}"], F.col("doc_len"), corpus["n"], corpus["mean"])
    scored = matched.select(key, *wanted, F.coalesce(F.round(score, 6), F.lit(0.0)).alias("score"))
    return scored.orderBy(F.desc("score"), key).limit(k).filter("score > 0")


def as_results(found: DataFrame, key: str) -> DataFrame:
    """The k found rows, few by the search's own limit, as one array of structs, best first."""
    entry = F.struct(-F.col("score"), F.col(key), F.struct("*").alias("hit"))
    ranked = F.array_sort(F.collect_list(entry))
    return found.agg(F.transform(ranked, lambda e: e["hit"]).alias("results"))


def results_json(found: DataFrame, key: str) -> DataFrame:
    return as_results(found, key).select(F.to_json(F.struct("results")).alias("response"))


def parse_results(response: DataFrame, schema: str) -> DataFrame:
    """Back from the JSON response to rows; ``schema`` is the DDL of one hit."""
    parsed = F.from_json("response", f"results array<struct<{schema}>>")
    return response.select(F.inline(parsed["results"]))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays; NULL when either has no length."""

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v)

    def product(x: Column, y: Column) -> Column:
        return F.zip_with(x, y, lambda u, v: u.cast("double") * v.cast("double"))

    norms = F.sqrt(total(product(a, a))) * F.sqrt(total(product(b, b)))
    return total(product(a, b)) / F.nullif(norms, F.lit(0.0))


def vector_topk(
    vectors: DataFrame, query: list[float], k: int, key: str, vector: str
) -> DataFrame:
    """The k nearest vectors; each task keeps only its own k best."""
    asked = F.array(*[F.lit(float(x)) for x in query])
    score = F.round(cosine(F.col(vector), asked), 6).alias("score")
    scored = vectors.select(key, score)
    return scored.orderBy(F.desc_nulls_last("score"), key).limit(k)
