"""Named queries of these operators over the whole tables, and SQL for those that SQL can say."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import trellis.llm.centroids as centroids
import trellis.llm.exact_dedup as exact_dedup
import trellis.llm.html_text as html_text
import trellis.llm.mixing as mixing
import trellis.llm.mixture as mixture
import trellis.llm.packing as packing
import trellis.llm.periodic as periodic
import trellis.llm.pii as pii
import trellis.llm.quality as quality
import trellis.llm.simhash as simhash
import trellis.llm.token_counts as token_counts
import trellis.llm.toxicity as toxicity
import trellis.llm.warc as warc
from trellis.llm.common import SPACE, WORD, body
from trellis.session import Scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), token_counts.vocabulary_path())


@query()
def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), packing.tokenizer_path())


@query()
def op3_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


@query()
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    weights, bias = toxicity.fit(docs, table(spark, folder, "labels").select("doc_id", "toxic"))
    return toxicity.score(docs, weights, bias)


@query()
def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query()
def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


@query()
def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.archive(table(spark, folder, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# ASCII white space as the contracts have it, and characters of words.
_SPACE = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]+"


@query(rf"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{_SPACE}', ' ', 'g') AS content FROM documents),
g AS (SELECT content, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY content)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256 FROM d JOIN g USING (content)
""")
def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return exact_dedup.exact_duplicates(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query()
def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(table(spark, folder, "documents"))


# The measures and verdicts in SQL. Windows are numbered by their first word; a word is in a repeated window if one of the
# windows over it is, which the distance to the last repeated window's start tells.
_QUALITY = rf"""
d AS (
    SELECT doc_id, source, row_number() OVER () AS r, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM docs
), wins AS (
    SELECT r, i, array_to_string(w[i:i + 7], ' ') AS win FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) > 8)
), rep AS (
    SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before
    FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM wins) WHERE n > 1
), covered AS (
    SELECT r, sum(least(8, i - coalesce(before, i - 8))) AS n FROM rep GROUP BY r
), dup AS (
    SELECT r, count(*) - count(DISTINCT line) AS n
    FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{_WORD}') GROUP BY r
), m AS (
    SELECT d.r, doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '{_SPACE}', '', 'g')) AS BIGINT) AS word_chars,
           CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
    FROM d LEFT JOIN dup USING (r) LEFT JOIN covered USING (r)
), b AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
           n_words < 40 OR 200 * n_repeat_words > 30 * n_words OR n_symbols * 10 > n_words OR n_dup_lines > 0 AS strict_failed FROM m
), h AS (
    SELECT source, count(*) AS n, sum(base_failed::INT) AS failed FROM b GROUP BY source
), o AS (
    SELECT sum(failed) / sum(n) AS mean, sum(n) AS total, count(*) AS hosts FROM h
), p AS (
    SELECT mean, CASE WHEN mean * (1 - mean) > 0 THEN greatest(1.0, mean * (1 - mean) / greatest(
        (sum(n * (failed / n - mean) ** 2) - mean * (1 - mean) * (hosts - 1)) / total, mean * (1 - mean) * 1e-4) - 1) ELSE 1.0 END AS strength
    FROM h, o GROUP BY mean, total, hosts
), v AS (
    SELECT source, n + strength AS weight, (failed + strength * mean) / (n + strength) AS host_rate FROM h, p
), judged AS (
    SELECT b.*, host_rate, NOT base_failed AND NOT (strict_failed AND host_rate - 2 * sqrt(host_rate * (1 - host_rate) / (weight + 1)) > 0.5) AS kept
    FROM b JOIN v ON b.source IS NOT DISTINCT FROM v.source
)
"""


@query(f"""
WITH docs AS (SELECT * FROM documents), {_QUALITY}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged
""")
def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents")).drop("host_rate")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """Texts of a tenth of the ids, chosen by crc32, repeat a unit of their own words from some word on."""
    blanks = F.lit(" \t\n\x0b\f\r")
    code = F.crc32(F.col("doc_id").cast("string"))
    words = F.split(F.btrim(body(F.col("text")), blanks), SPACE)
    rows = docs.select("doc_id", body(F.col("text")).alias("text"), code.alias("h"))
    chosen = (F.col("h") % 10 == 0) & F.col("text").rlike(WORD)
    rows = rows.withColumn("words", F.when(chosen, words)).withColumn("n", F.size("words")).withColumn("g", F.floor(F.col("h") / 10))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    unit = F.slice("words", F.col("a") + 1, F.col("p"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(unit, times)), F.lit(1), F.col("n") - F.col("a"))
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return rows.select("doc_id", F.when(F.col("words").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


@query()
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.find(with_planted_periods(table(spark, folder, "documents")))
    order = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    found = found.select(F.col("row.doc_id").alias("doc_id"), F.array_max(order).alias("best"), F.size("runs").cast("long").alias("n_runs"),
                         listed.alias("listed"), "collapsed")
    length, period = F.col("best.length"), -F.col("best.period")
    return found.select(
        "doc_id", "n_runs", (-F.col("best.start")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"), F.sha2(F.col("listed").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def _lloyd_sql(k: int = 16, rounds: int = 3) -> str:
    """Lloyd's rounds written out: assignment ``a<i>`` to centroids ``c<i>``, and the next centroids from it."""
    parts = [f"""
v AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))::BIGINT) AS x FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS (
    SELECT c, x FROM (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), x) - 1 AS c, x FROM v) WHERE c < {k}
)"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS (
    SELECT r, any_value(vec_id) AS vec_id, any_value(x) AS x, min(d * {k} + c) AS best FROM (
        SELECT r, vec_id, v.x AS x, c,
               list_sum(list_transform(range(1, 65), lambda i: (v.x[i] - m.x[i]) * (v.x[i] - m.x[i])))::BIGINT AS d FROM v, c{i} AS m
    ) GROUP BY r
)""")
        if i < rounds:
            parts.append(f"""s{i} AS (
    SELECT c, list((s - (((s % n) + n) % n)) // n ORDER BY p)::BIGINT[] AS x
    FROM (SELECT c, p, sum(e) AS s, count(*) AS n FROM (SELECT best % {k} AS c, unnest(x) AS e, unnest(range(64)) AS p FROM a{i}) GROUP BY c, p) GROUP BY c
), c{i + 1} AS (SELECT o.c, coalesce(s.x, o.x) AS x FROM c{i} AS o LEFT JOIN s{i} AS s ON o.c = s.c)""")
    return f"""
WITH {", ".join(parts)}
SELECT vec_id, CAST(best % {k} AS INTEGER) AS cluster, best // {k} AS distance,
       CAST(sum(best // {k}) OVER (PARTITION BY best % {k}) AS BIGINT) AS cluster_inertia, CAST(sum(best // {k}) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(m.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} AS m ON best % {k} = m.c
"""


@query(_lloyd_sql())
def op12_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark)
    found, centres = centroids.cluster(table(spark, folder, "embeddings"), k=16, rounds=3, dimensions=64, scratch=scratch)
    return centroids.with_inertia(found, centres, scratch)


@query()
def op13_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return mixture.scored(table(spark, folder, "documents"))
