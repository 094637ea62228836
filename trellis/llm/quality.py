"""Quality rules with a verdict on hosts.

Every document is measured and judged by fixed rules. Failures are then summed by host, and each host's failure
rate is shrunk towards all hosts' by a beta prior that is fitted to the rates themselves (method of
moments), so a host of few documents is judged by little more than the prior. A host fails if its shrunk rate, less
``CAUTION`` standard deviations of its posterior, is above ``HOST_RATE``. Host verdicts join back to documents: one of a
failing host is kept only if it is clear of rules ``STRICT`` times tighter; a clean document is never lost to its host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trellis.llm.common import SPACE, WORD, body, whole_rows
from trellis.session import Scratch

LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent of words in repeated windows
WINDOW = 8
HOST_RATE = 0.5
CAUTION = 2.0
STRICT = 2
BLANKS = " \t\n\x0b\f\r"
SYMBOL = r"[#*$%&|<>]"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: Column) -> Column:
    """How many words lie in windows of ``WINDOW`` words that the text has twice or more, first ones included.

    Windows are compared by a 64-bit hash of their words' hashes. Most texts repeat nothing, which the
    number of different hashes tells; only the others sort the windows to find which are repeated."""

    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(h, i, WINDOW)))

    def covered(found: Column) -> Column:
        """``found``: hashes of the windows in text order."""
        placed = F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeats(s: Column) -> Column:
            here = F.transform(s, lambda x, k: F.when(
                (F.coalesce(F.get(s, k - 1)["h"], x["h"] - 1) == x["h"]) | (F.coalesce(F.get(s, k + 1)["h"], x["h"] - 1) == x["h"]), x["i"]
            ))
            return F.array_sort(F.array_compact(here))

        state = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return bind(placed, lambda s: F.aggregate(
            repeats(s), state,
            lambda acc, i: F.struct((acc["n"] + i + WINDOW - F.greatest(i, acc["end"])).alias("n"), (i + WINDOW).alias("end")),
            lambda acc: acc["n"],
        ))

    def count(found: Column) -> Column:
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0)).otherwise(covered(found))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(bind(hashes, lambda h: bind(windows(h), count)))


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: a transform over an array that holds only it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def measured(rows: DataFrame) -> DataFrame:
    """The columns of ``rows`` but ``text``, and those named in ``MEASURES``."""
    others = [c for c in rows.columns if c != "text"]
    split = F.split(F.btrim("text", F.lit(BLANKS)), SPACE)
    rows = rows.withColumn("words", F.when(F.col("text").rlike(WORD), split).otherwise(F.array().cast("array<string>")))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD))
    found = (
        F.size("words"), F.length(F.regexp_replace("text", SPACE, "")), F.regexp_count("text", F.lit(SYMBOL)),
        bind(lines, lambda kept: F.size(kept) - F.size(F.array_distinct(kept))), repeated_words(F.col("words")),
    )
    return rows.select(*others, *[column.cast("long").alias(name) for name, column in zip(MEASURES, found)])


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def strict_failed() -> Column:
    """The same rules, tighter, and two more: symbols and repeated lines."""
    return (
        (F.col("n_words") < STRICT * LEAST_WORDS) | (STRICT * 100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
        | (F.col("n_symbols") * 10 > F.col("n_words")) | (F.col("n_dup_lines") > 0)
    )


def host_verdicts(judged: DataFrame, scratch: Scratch, rate: float = HOST_RATE, caution: float = CAUTION) -> DataFrame:
    """``host, host_rate, host_failed`` from rows of ``host, base_failed``, one row per host."""
    hosts = judged.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed"))
    hosts = scratch.put(hosts, "hosts")
    mean, strength = beta_prior(hosts)
    shrunk = hosts.select(
        "host", (F.col("n") + strength).alias("weight"), ((F.col("failed") + strength * mean) / (F.col("n") + strength)).alias("host_rate"),
    )
    deviation = F.sqrt(F.col("host_rate") * (1 - F.col("host_rate")) / (F.col("weight") + 1))
    return shrunk.select("host", "host_rate", (F.col("host_rate") - caution * deviation > rate).alias("host_failed"))


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """Mean and strength (in documents) of the prior, by moments: the rate over all documents, and the variance of the
    hosts' rates, each host weighing as its documents, less what counting so few documents gives by itself."""
    total, failed, count = hosts.agg(F.sum("n"), F.sum("failed"), F.count("*")).first()
    mean = failed / total if total else 0.0
    spread = mean * (1 - mean)
    if not spread:
        return mean, 1.0
    apart = F.col("failed") / F.col("n") - mean
    (squares,) = hosts.agg(F.sum(F.col("n") * apart * apart)).first()
    between = max((squares - spread * (count - 1)) / total, spread * 1e-4)
    return mean, max(1.0, spread / between - 1)


def judge(docs: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source", with_row: bool = False, scratch: Scratch | None = None) -> DataFrame:
    """For every row ``doc_id``, the measures, ``base_failed, host_rate, kept``, and if asked for ``row``, a struct of all
    its columns.

    Null and empty texts have no words and fail; a null host is a host; repeated rows are judged each; an empty
    table gives no rows. Texts are measured whole, and only the counts by host are shuffled."""
    own = [F.col(id).alias("doc_id"), F.col(host).cast("string").alias("host"), body(F.col(text)).alias("text")]
    rows = measured(whole_rows(docs, *own) if with_row else docs.select(*own))
    scratch = scratch or Scratch(docs.sparkSession)
    rows = scratch.put(rows.withColumn("base_failed", base_failed()), "judged")
    hosts = host_verdicts(rows, scratch).withColumnRenamed("host", "of_host")
    joined = rows.join(hosts, F.col("host").eqNullSafe(F.col("of_host")))
    kept = ~F.col("base_failed") & ~(F.col("host_failed") & strict_failed())
    return joined.select(*["row"] * with_row, "doc_id", *MEASURES, "base_failed", "host_rate", kept.alias("kept"))


def keep_good(docs: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source", scratch: Scratch | None = None) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    return judge(docs, id, text, host, with_row=True, scratch=scratch).filter("kept").select("row.*")
