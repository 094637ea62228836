"""Mixing sources to target weights by Sainte-Lague apportionment of equal blocks of words.

Targets first: the sources share ``share`` times all words by weight, no source gets over ``most`` times its own
size, and what that cuts off goes to the others by weight, until none is above (water filling; each round
is one small aggregate over the table of sources).

Then the corpus is dealt into shards by a seeded hash of the id, each source into as many of them as its own size fills with ``CELL``
blocks or ``SHARD_ROWS`` rows. In a shard each source has a stream of words, its documents in seeded order, cut into blocks of
``block`` words. The shard's number of blocks goes to its sources by highest quotients ``target / (2k + 1)``, which gives integer
quotas. Candidates for the ranking are only the quotients near the end of the list: with ``n`` sources and ``N`` blocks, a source
with share ``p`` ends within ``n * p + 2`` blocks of ``target / block``, all quotients below that are in.

A quota is taken at its real words: the whole stream as often as it goes in, and once more the words that follow a seeded start, around
the end of the stream. A source at its bound gives all its words that often. So a document's taken words follow from
its place in the stream, without listing blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trellis.llm.common import body, whole_rows, word_count
from trellis.session import Scratch

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
BLOCK = 16
SEED = 6
SHARD_ROWS = 4096
CELL = 1024  # blocks of a source in a shard, at least


def source_targets(sizes: DataFrame, scratch: Scratch, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source, source_size, target`` from rows of ``source, size``; one row per source.

    Sources in the order of their code points, null last, take the weights in turn. Their places are counted
    over ranges of the names: a count per range, then numbers within it."""
    spark = sizes.sparkSession
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = totals.repartitionByRange(parts, F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    ranged = scratch.put(ranged, "sources")
    own = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    per_part = ranged.groupBy("part").agg(F.count("*").alias("n"))
    before = per_part.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    place = F.col("before") + F.row_number().over(own) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    ranged = scratch.put(
        ranged.join(F.broadcast(before), "part").select("source", "source_size", weight.alias("weight")), "weighted"
    )  # one row per range
    total, heavy = ranged.agg(F.sum("source_size") * F.lit(share), F.sum("weight")).first()
    full: Column = F.lit(False)
    level, capped = 0.0, -1
    while heavy:
        # Sources whose share is above their bound stay at it; the level of the others rises.
        full = F.col("source_size") * most <= F.col("weight") * F.lit(level)
        fixed, free, count = ranged.agg(
            F.coalesce(F.sum(F.when(full, F.col("source_size") * most)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)), F.count(F.when(full, 1)),
        ).first()
        if count == capped or not free:
            break
        capped, level = count, (total - fixed) / free
    target = F.when(full, F.col("source_size") * most).otherwise(F.col("weight") * F.lit(level))
    return ranged.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row: the words of the text, of its source and those its source
    should give, and the words the mix takes of this document, repeats counted.

    Null texts have no words and are never taken, and a source of such texts has target 0; a null source is a source; repeated rows are documents of
    their own; no document gives over twice its size; an empty table gives no rows. Results depend on
    the rows and the seed alone."""
    rows = docs.select(
        F.lit(None).cast("long").alias("number"), F.col(id).alias("doc_id"), F.col(source).cast("string").alias("source"),
        word_count(F.col(text)).alias("size"),
    )
    scratch = Scratch(docs.sparkSession)
    return _placed(scratch.put(rows, "sizes"), scratch, **how).select("doc_id", "size", "source_size", "target", "taken")


def _placed(
    rows: DataFrame, scratch: Scratch, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK, seed: int = SEED,
    shard_rows: int = SHARD_ROWS, cell: int = CELL,
) -> DataFrame:
    """``rows`` (``number, doc_id, source, size``, read from a table) with ``taken`` and how it is made up: the whole
    text ``times`` times, and the words in the two intervals ``[a1, b1)`` and ``[a2, b2)``."""
    targets = scratch.put(source_targets(rows, scratch, weights, share, most), "targets")
    shards = rows.count() // shard_rows + 1
    dealt = rows.withColumn("order", F.xxhash64(F.lit(seed), "doc_id")).withColumn("part", F.pmod("order", F.lit(shards)))
    cells = dealt.groupBy("part", "source").agg(F.sum("size").alias("words"), F.count("*").alias("n"))
    targets = targets.withColumnRenamed("source", "of_source")
    cells = cells.join(targets, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
    # A source of few words has several parts in one shard, one behind the other in its stream. Parts are at most as many as shards.
    filled = F.greatest(F.col("source_size") / (cell * block), F.sum("n").over(Window.partitionBy("source")) / shard_rows)
    own = F.least(F.lit(shards), F.floor(filled).cast("long") + 1)
    cells = cells.withColumn("shard", F.pmod(F.pmod("part", own) + F.pmod(F.xxhash64(F.lit(seed + 2), "source"), F.lit(shards)), F.lit(shards)))
    together = Window.partitionBy("shard", "source")
    earlier = together.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    cells = scratch.put(cells.select(
        "part", "shard", "source", "source_size", "target", F.sum("words").over(together).alias("words"),
        F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before"),
    ), "parts")
    streams = cells.filter("words > 0").select("shard", "source", "words", "source_size", "target").distinct()
    quotas = _quotas(streams, block).withColumnsRenamed({"shard": "in_shard", "source": "of_source"})
    start = F.pmod(F.xxhash64(F.lit(seed + 1), "shard", "source"), F.col("blocks")) * block
    bound = F.floor(F.col("words") * most).cast("long")
    at_bound = F.col("target") >= F.col("source_size") * most * (1 - 1e-9)
    given = F.when(at_bound, bound).otherwise(F.least(F.col("quota") * block, bound))
    same = (F.col("shard") == F.col("in_shard")) & F.col("source").eqNullSafe(F.col("of_source"))
    cells = scratch.put(cells.join(quotas, same, "left").select(
        F.col("part").alias("in_part"), F.col("source").alias("of_source"), "source_size", "target", "before",
        # A cell without words gives nothing.
        F.when(F.col("words") > 0, F.coalesce(F.floor(F.try_divide(given, F.col("words"))).cast("long"), F.lit(0))).otherwise(0).alias("times"),
        F.coalesce(start, F.lit(0)).alias("extra_from"),
        F.coalesce(start + F.when(F.col("words") > 0, F.try_mod(given, F.col("words"))), F.lit(0)).alias("extra_to"), F.col("words").alias("around"),
    ), "cells")
    stream = Window.partitionBy("part", "source").orderBy("order", F.col("doc_id").asc_nulls_last(), "size", "number")
    running = F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    in_cell = (F.col("part") == F.col("in_part")) & F.col("source").eqNullSafe(F.col("of_source"))
    placed = dealt.withColumn("running", running).join(cells, in_cell)
    placed = placed.withColumn("last", F.col("before") + F.col("running")).withColumn("first", F.col("last") - F.col("size"))

    def within(low: Column, high: Column) -> tuple[Column, Column]:
        """The part of [low, high) of the stream that lies in the document, counted from its first word."""
        a, b = F.greatest(low, F.col("first")), F.least(high, F.col("last"))
        inside = a < b
        return F.when(inside, a - F.col("first")).otherwise(0), F.when(inside, b - F.col("first")).otherwise(0)

    a1, b1 = within(F.col("extra_from"), F.least("extra_to", "around"))
    a2, b2 = within(F.lit(0), F.col("extra_to") - F.col("around"))
    named = placed.select("number", "doc_id", "size", "source_size", "target", "times", a1.alias("a1"), b1.alias("b1"), a2.alias("a2"), b2.alias("b2"))
    taken = F.col("times") * F.col("size") + F.col("b1") - F.col("a1") + F.col("b2") - F.col("a2")
    return named.withColumn("taken", F.coalesce(taken, F.lit(0)).cast("long"))


def _quotas(cells: DataFrame, block: int) -> DataFrame:
    """``blocks`` and ``quota`` for each shard and source, from its words and its source's target."""
    shard = Window.partitionBy("shard")
    blocks = F.ceil(F.col("words") / block).cast("long")
    wanted = F.col("target") * F.col("words") / F.col("source_size")  # the shard's part of the target
    cells = cells.select("shard", "source", blocks.alias("blocks"), wanted.alias("wanted")).filter("wanted > 0")
    cells = cells.select(
        "*", F.round(F.sum("wanted").over(shard) / block).cast("long").alias("seats"),
        F.ceil(F.count("*").over(shard) * F.col("wanted") / F.sum("wanted").over(shard)).cast("long").alias("slack"),
    )
    sure = F.greatest(F.lit(0), F.floor(F.col("wanted") / block).cast("long") - F.col("slack") - 1)
    listed = cells.withColumn("sure", sure).select(
        "*", F.explode(F.sequence(F.col("sure"), F.col("sure") + 2 * F.col("slack") + 3)).alias("k")
    )
    ranked = Window.partitionBy("shard").orderBy((F.col("wanted") / (2 * F.col("k") + 1)).desc(), F.col("source").asc_nulls_last())
    all_sure = F.sum(F.when(F.col("k") == F.col("sure"), F.col("sure"))).over(shard)
    won = listed.select("*", (F.row_number().over(ranked) + all_sure <= F.col("seats")).alias("won"))
    quota = F.max("sure") + F.count(F.when(F.col("won"), 1))
    return won.groupBy("shard", "source").agg(F.max("blocks").alias("blocks"), quota.alias("q")).select(
        "shard", "source", "blocks", F.least("q", 2 * F.col("blocks")).alias("quota")
    )


def mixed_rows(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", scratch: Scratch | None = None, **how
) -> DataFrame:
    """The mix as rows of ``docs``: a document that is taken twice stands there twice, one taken in part with
    the words taken (white space behind each as in the text), one not taken not at all."""
    scratch = scratch or Scratch(docs.sparkSession)
    whole = scratch.put(whole_rows(docs, F.monotonically_increasing_id().alias("number")), "whole")
    row = F.col("row")
    sizes = whole.select("number", row[id].alias("doc_id"), row[source].cast("string").alias("source"), word_count(row[text]).alias("size"))
    placed = _placed(scratch.put(sizes, "sizes"), scratch, **how).filter("taken > 0")
    placed = placed.select("number", "size", "times", "a1", "b1", "a2", "b2")
    full = (F.col("b1") - F.col("a1") == F.col("size")).cast("long")
    placed = scratch.put(placed.select(
        "number", (F.col("times") + full).alias("times"), F.when(full == 0, F.col("a1")).otherwise(0).alias("a1"),
        F.when(full == 0, F.col("b1")).otherwise(0).alias("b1"), "a2", "b2",
    ), "placed")
    copies = F.array_compact(F.concat(
        F.array_repeat(F.lit(0), F.col("times").cast("int")), F.array(F.when(F.col("b1") + F.col("b2") > 0, F.lit(1)))
    ))
    # Pieces of a word and the white space behind it; put together again they are the text.
    words = F.split(F.regexp_replace(body(row[text]), r"^[\x20\x09-\x0D]+", ""), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")

    def cut(a: str, b: str) -> Column:
        return F.when(F.col(a) < F.col(b), F.array_join(F.slice(words, (F.col(a) + 1).cast("int"), (F.col(b) - F.col(a)).cast("int")), ""))

    part = F.concat_ws(" ", cut("a1", "b1"), cut("a2", "b2"))  # both if the run goes around its end within one document
    chosen = F.when(F.col("copy") == 1, part).otherwise(row[text])
    # The same join at every size: a plan that broadcasts small inputs would grow faster than they do.
    listed = whole.join(placed.hint("merge"), "number").select("row", "a1", "b1", "a2", "b2", F.explode(copies).alias("copy"))
    columns = [chosen.alias(text) if c == text else row[c].alias(c) for c in docs.columns]
    return listed.select(*columns)
