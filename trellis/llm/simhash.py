"""SimHash near-duplicates: all links within a radius by covering locality-sensitive hashing.

Fingerprints are computed per text in Arrow batches. Linking works on the different fingerprints only. A random map
gives every bit one of the 2^(r+1) - 1 non-zero vectors of r+1 bits; table ``v`` keeps the bits whose vector has
an odd product with ``v``. Up to ``r`` differing bits leave some ``v`` orthogonal to all of their vectors, so that pair
agrees on every bit table ``v`` keeps: each pair within the radius collides in some table.

A bucket lists no pairs: its task unites the fingerprints it finds close and sends on a spanning forest, at
most one link per member. Buckets over ``BUCKET`` members are split, exactly, before that: the bits
their table dropped form blocks of three, and each choice of ``r`` blocks gives a sub-bucket whose members agree on
all other blocks. Differing bits lie in at most ``r`` blocks, so no pair is lost, and a sub-bucket has at most
2^(3r) = 512 different fingerprints at r = 3.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trellis.llm.common import body, text_chunks, whole_rows
from trellis.session import Scratch

BITS = 64
RADIUS = 3
SHINGLE = 3
HASH_SEED = 42
MASK_SEED = 20
BUCKET = 512
BLOCK_BITS = 3


def shingle_hashes(text: str, size: int = SHINGLE) -> bytes:
    """XXH64, 8 big-endian bytes each, of every run of ``size`` words, ASCII letters lower-cased; of all words
    together if there are fewer."""
    from xxhash import xxh64_digest

    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return b""
    if len(words) <= size:
        return xxh64_digest(b" ".join(words), HASH_SEED)
    return b"".join([xxh64_digest(s, HASH_SEED) for s in map(b" ".join, zip(*(words[i:] for i in range(size))))])


def fingerprint(hashes: bytes) -> int:
    """A bit is 1 where it is set in over half of the hashes."""
    total = len(hashes) // 8
    if not total:
        return 0
    rows = np.frombuffer(hashes, dtype=np.uint8).reshape(total, 8)
    counts = np.zeros(BITS, dtype=np.int64)
    for start in range(0, total, 1 << 14):
        counts += np.unpackbits(rows[start:start + (1 << 14)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > total).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", size: int = SHINGLE) -> DataFrame:
    """The columns of ``docs`` but the text, and ``fp``: the fingerprint as a signed long."""
    others = [c for c in docs.columns if c != text]
    rows = docs.select(body(F.col(text)).alias("text"), F.struct(*[F.col(c) for c in others]).alias("row"))
    kind = rows.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            found = np.array([fingerprint(shingle_hashes(t, size)) for t in batch.column(0).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found.view(np.int64))], names=["row", "fp"])

    return rows.mapInArrow(run, f"row {kind}, fp long").select("row.*", "fp")


def covering_masks(radius: int = RADIUS, bits: int = BITS, seed: int = MASK_SEED) -> list[int]:
    """The kept bits of each table. Every vector is used as evenly as can be."""
    vectors = list(range(1, 2 ** (radius + 1)))
    given = [vectors[i % len(vectors)] for i in range(bits)]
    random.Random(seed).shuffle(given)
    return [sum(1 << i for i, m in enumerate(given) if bin(m & v).count("1") % 2) for v in vectors]


def split_masks(kept: int, radius: int = RADIUS, bits: int = BITS, block: int = BLOCK_BITS) -> list[int]:
    """For the splits of a bucket of the table that keeps ``kept``: the further bits each split keeps."""
    free = [i for i in range(bits) if not kept >> i & 1]
    blocks = [sum(1 << i for i in free[k:k + block]) for k in range(0, len(free), block)]
    rest = sum(blocks)
    return [rest - sum(chosen) for chosen in itertools.combinations(blocks, min(radius, len(blocks)))]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _forest(members: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect all members within ``radius`` of each other, one fewer than members at most.
    ``members``: different fingerprints, ascending; a link names the smaller one first."""
    size = len(members)
    parent = list(range(size))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    for i in range(size - 1):
        near = np.flatnonzero(np.bitwise_count(members[i + 1:] ^ members[i]) <= radius)
        for j in (near + i + 1).tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((i, j))
    return links


def _bucket_links(keyed: DataFrame, radius: int) -> DataFrame:
    """Forest links of all buckets of at most ``BUCKET`` members. ``keyed``: table, key, fp, each once."""
    dealt = keyed.repartition("table", "key").sortWithinPartitions("table", "key", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 3), dtype=np.int64)

        def close(rows: np.ndarray) -> pa.RecordBatch | None:
            new = np.flatnonzero(np.any(np.diff(rows[:, :2], axis=0) != 0, axis=1)) + 1
            starts = np.concatenate(([0], new))
            stops = np.concatenate((new, [len(rows)]))
            a, b = [], []
            for start, stop in zip(starts, stops):
                if stop - start > 1:
                    own = rows[start:stop, 2]
                    for i, j in _forest(own.view(np.uint64), radius):
                        a.append(own[i])
                        b.append(own[j])
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]) if a else None

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)
            held = np.concatenate((held, rows))
            last = np.flatnonzero(np.any(held[:, :2] != held[-1, :2], axis=1))
            cut = int(last[-1]) + 1 if len(last) else 0  # the last bucket may go on in the next batch
            if cut and (found := close(held[:cut])) is not None:
                yield found
            held = held[cut:]
        if len(held) and (found := close(held)) is not None:
            yield found

    return dealt.select("table", "key", "fp").mapInArrow(run, "a long, b long")


def links(distinct: DataFrame, scratch: Scratch, radius: int = RADIUS) -> DataFrame:
    """Links ``a, b`` between the different fingerprints ``fp``: they connect exactly the fingerprints that
    pairs within ``radius`` connect, and each joins such a pair."""
    masks = covering_masks(radius)

    def keys(frame: DataFrame) -> DataFrame:
        tables = [F.struct(F.lit(t).alias("table"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for t, m in enumerate(masks)]
        return frame.select("fp", F.inline(F.array(*tables)))

    # A bucket of one member links nothing and most have one: only the others are listed again.
    full = scratch.put(keys(distinct).groupBy("table", "key").agg(F.count("*").alias("members")).filter("members > 1"), "buckets")
    shared = scratch.put(keys(distinct).join(full, ["table", "key"]).select("table", "key", "fp", "members"), "shared")
    small = shared.filter(F.col("members") <= BUCKET)
    splits = F.element_at(
        F.array(*[F.array(*[F.lit(signed(m)) for m in split_masks(mask, radius)]) for mask in masks]), F.col("table") + 1
    )
    # A sub-bucket is known by its bucket's table, its split and all the bits it keeps.
    large = (
        shared.filter(F.col("members") > BUCKET)
        .select("table", "key", "fp", F.posexplode(splits).alias("split", "further"))
        .select(
            (F.lit(len(masks)) + F.col("table") + F.col("split") * len(masks)).alias("table"),
            F.col("key").bitwiseOR(F.col("fp").bitwiseAND(F.col("further"))).alias("key"), "fp",
        )
    )
    found = _bucket_links(small.select("table", "key", "fp").unionByName(large), radius)
    return scratch.put(found.distinct(), "links")


def components(pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """``fp, root``: the smallest fingerprint that links reach from each linked one.

    Alternating star contraction: every node's larger neighbours are tied to the smallest it knows, then
    its smaller ones; it ends when a round changes nothing, after about log(longest path) rounds. Each
    round is written, so nothing is computed twice and a lost executor costs one round at most."""
    edges = scratch.put(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        large = scratch.put(large, "large")
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        tied = large.join(low, "u")
        small = tied.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(tied.select("u", F.col("low").alias("v")))
        new = scratch.put(small.filter("u <> v").distinct(), "edges")
        same = [x.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first() for x in (edges, new)]
        edges = new
        if same[0] == same[1]:
            return edges.select(F.col("u").alias("fp"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", radius: int = RADIUS, size: int = SHINGLE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row: the fingerprint in hexadecimal and the smallest
    id reachable over links of at most ``radius`` differing bits, the row's own included.

    Texts without words (null and empty ones too) have fingerprint zero and are linked like any other;
    repeated rows share a component and are all returned; a null id is a component's id only if it has no
    other; other columns are not read; an empty table gives no rows."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch.put(fingerprints(docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")), "text", size), "rows")
    roots = _roots(rows, scratch, radius)
    lowest = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = roots.join(lowest, "root").select("fp", "component_id")
    return rows.join(classes, "fp").select("doc_id", hex_of("fp").alias("fingerprint"), "component_id")


def hex_of(column: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))


def _roots(rows: DataFrame, scratch: Scratch, radius: int) -> DataFrame:
    """``fp, least, root``: each different fingerprint, its smallest id and its component's smallest fingerprint."""
    own = scratch.put(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(own.select("fp"), scratch, radius), scratch)
    return scratch.put(own.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "roots")


def keep_first(
    docs: DataFrame, id: str = "doc_id", text: str = "text", radius: int = RADIUS, size: int = SHINGLE, scratch: Scratch | None = None
) -> DataFrame:
    """The rows of ``docs`` with all their columns, of each component only the one with the smallest id,
    null last (of repeated rows, one)."""
    scratch = scratch or Scratch(docs.sparkSession)
    whole = scratch.put(whole_rows(docs, F.monotonically_increasing_id().alias("number")), "whole")
    rows = whole.select("number", F.col("row")[id].alias("doc_id"), F.col("row")[text].alias("text"))
    rows = scratch.put(fingerprints(rows, "text", size), "rows")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("number"))
    first = rows.join(_roots(rows, scratch, radius).select("fp", "root"), "fp").groupBy("root").agg(F.min(order)["number"].alias("number"))
    return whole.join(first.select("number"), "number", "left_semi").select("row.*")
