"""Text as token arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trellis.session import spread


def tokenize(text: str | Column, stop_words: Sequence[str] = ()) -> Column:
    """Lower-case word tokens in text order, without stop words."""
    c = F.col(text) if isinstance(text, str) else text
    tokens = F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))
    if not stop_words:
        return tokens
    stops = F.array(*[F.lit(w) for w in sorted(set(stop_words))])
    return F.filter(tokens, lambda t: ~F.array_contains(stops, t))


def bigrams(tokens: Column) -> Column:
    """The set of neighbouring token pairs of a document, as ``a b``."""
    pairs = F.zip_with(
        F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(0))),
        F.slice(tokens, 2, F.greatest(F.size(tokens) - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return F.array_distinct(pairs)


def bigrams_topk(df: DataFrame, text: str, k: int, stop_words: Sequence[str] = (), where: Column | None = None) -> DataFrame:
    """``bigram, documents``: the pairs found in most documents, ties by text."""
    if where is not None:
        df = df.filter(where)
    tokens = spread(df.select(text)).select(tokenize(text, stop_words).alias("t"))
    return (
        tokens.select(F.explode(bigrams(F.col("t"))).alias("bigram"))
        .groupBy("bigram")
        .agg(F.count("*").alias("documents"))
        .orderBy(F.col("documents").desc(), "bigram")
        .limit(k)
    )


def token_counts(df: DataFrame, text: str, stop_words: Sequence[str] = ()) -> DataFrame:
    return (
        spread(df.select(text)).select(F.explode(tokenize(text, stop_words)).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    )


def distinct_token_count(df: DataFrame, text: str) -> DataFrame:
    return token_counts(df, text).agg(F.count("*").alias("vocabulary"))


def top_tokens(df: DataFrame, text: str, k: int, stop_words: Sequence[str] = ()) -> DataFrame:
    return token_counts(df, text, stop_words).orderBy(F.col("n").desc(), "token").limit(k)


def binary_token_vectors(df: DataFrame, id_column: str, text: str, vocabulary: Sequence[str]) -> DataFrame:
    """0/1 vector over a list of tokens."""
    present = F.array_distinct(tokenize(text))
    words = F.array(*[F.lit(w) for w in vocabulary])
    return df.select(id_column, present.alias("_t")).select(
        id_column, F.transform(words, lambda w: F.array_contains("_t", w).cast("int")).alias("vector")
    )


def sentiment_tag(score: str | Column) -> Column:
    c = F.col(score) if isinstance(score, str) else score
    return F.when(c > 3, "positive").otherwise("negative")


def helpfulness_ratio(votes: str | Column) -> Column:
    """``a/b`` as a number; null when there are no votes."""
    c = F.trim(F.col(votes) if isinstance(votes, str) else votes)
    parts = F.split(c, "/")
    top, bottom = parts[0].try_cast("double"), F.get(parts, F.lit(1)).try_cast("double")
    return F.when(bottom >= 1, top / bottom)


def is_helpful(votes: str | Column, above: float = 0.75) -> Column:
    return F.coalesce(helpfulness_ratio(votes) > above, F.lit(False))


def word_document_graph(df: DataFrame, id_column: str, text: str, stop_words: Sequence[str] = ()):
    """WORD nodes and SAID_IN edges (word -> document) scored by the word's share of the document."""
    rows = spread(df.select(id_column, text))
    tokens = rows.select(F.col(id_column).cast("string").alias("dst"), tokenize(text, stop_words).alias("t"))
    said = (
        tokens.select("dst", F.size("t").alias("_len"), F.explode("t").alias("src"))
        .groupBy("src", "dst")
        .agg((F.count("*") / F.max("_len")).alias("score"))
    )
    words = said.select(F.col("src").alias("id")).distinct()
    return words, said


def entity_relation_table(df: DataFrame, keys: Sequence[str], results: str, metadata: str) -> DataFrame:
    """Arrays of results and metadata maps -> one row per relation, with the drug text built from
    the entity roles."""
    rows = df.select(*keys, F.explode(F.arrays_zip(F.col(results).alias("r"), F.col(metadata).alias("m"))).alias("c"))
    fields = ["entity1", "chunk1", "entity2", "chunk2", "confidence"]
    flat = rows.select(
        *keys, F.col("c.r").alias("relation"), *[F.try_element_at("c.m", F.lit(f)).alias(f) for f in fields]
    )
    return flat.withColumn("rx_text", drug_text("entity1", "chunk1", "entity2", "chunk2"))


def drug_text(entity1: str, chunk1: str, entity2: str, chunk2: str) -> Column:
    """Drug name, with the form, strength or dosage behind it when the other entity is one."""
    detail = ["FORM", "STRENGTH", "DOSAGE"]
    e1, e2 = F.col(entity1), F.col(entity2)
    drug = F.when(e1 == "DRUG", F.col(chunk1)).when(e2 == "DRUG", F.col(chunk2))
    other, words = F.when(e1 == "DRUG", e2).otherwise(e1), F.when(e1 == "DRUG", F.col(chunk2)).otherwise(F.col(chunk1))
    return F.when(drug.isNull(), " ").when(other.isin(detail), F.concat_ws(" ", drug, words)).otherwise(drug)
