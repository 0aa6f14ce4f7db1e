"""Operator 10, SimHash near-dedup over a Gray-order hierarchical index.

Fingerprints are 64 majority bits over the XXH64 of word 3-shingles. To find all pairs within two bits, the
64 bits are cut into six blocks; two fingerprints that differ in at most two bits agree on at least four
blocks, so each of the 15 choices of four blocks deals the distinct fingerprints into buckets and no pair is
missed. A bucket fixes at least 42 bits: whatever the input, it holds at most 2^22 distinct fingerprints.

Inside a task the buckets are sorted by Gray rank and indexed as a forest: eight neighbours form a node
that keeps the bits they share (mask and pattern), eight nodes form an upper node, up to one root per
bucket. A search adds, at each step down, the differences on the bits that are newly shared, and drops a
whole group once the sum passes the limit. A bucket sends on a spanning star of each linked group, never
its pairs; the stars are joined by distributed union-find.

Defined results: null or empty text has fingerprint zero, linked like any other; a null doc_id takes part,
but a component is named by its smallest non-null doc_id; equal fingerprints are one node; rows that repeat
are kept as rows by ``classes``, while ``dedup`` leaves one row of each component (smallest doc_id, then
smallest text hash); empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import one_of_equal, slices, text_of, written
from .components import connected
from .units import forget

WIDTH = 3
LIMIT = 2
SEED = 42
BLOCKS = 6
FAN = 3  # log2 of the children of a node


# fingerprints --------------------------------------------------------------------------------------------

def shingle_hashes(text: bytes) -> list[int]:
    """XXH64 of each word shingle; ASCII letters lower-cased, words separated by ASCII blanks."""
    words = text.lower().split()
    if len(words) < WIDTH:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    return [xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in zip(words, words[1:], words[2:])]


def _fingerprints(texts: list[bytes]) -> np.ndarray:
    out = np.zeros(len(texts), np.uint64)
    hashes, counts = [], []
    for t in texts:
        h = shingle_hashes(t)
        hashes.extend(h)
        counts.append(len(h))
    counts = np.asarray(counts)
    filled = np.flatnonzero(counts)
    if not len(filled):
        return out
    flat = np.asarray(hashes, np.uint64)
    starts = (np.cumsum(counts) - counts)[filled]
    for bit in range(64):
        ones = np.add.reduceat(((flat >> np.uint64(bit)) & np.uint64(1)).astype(np.int64), starts)
        out[filled] |= (2 * ones > counts[filled]).astype(np.uint64) << np.uint64(bit)
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, fp`` of every row (fp as a signed long)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for part in slices(batches, "text"):
            fp = _fingerprints(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_hash"), pa.array(fp.view(np.int64))],
                                             ["doc_id", "text_hash", "fp"])

    rows = docs.select("doc_id", text_of().alias("text")).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.encode("text", "UTF-8").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, fp long")


# the index -----------------------------------------------------------------------------------------------

def block_masks() -> list[int]:
    """For each choice of BLOCKS - LIMIT blocks, the bits they cover."""
    edges = [round(64 * i / BLOCKS) for i in range(BLOCKS + 1)]
    parts = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(parts, BLOCKS - LIMIT)]


def gray_rank(fp: np.ndarray) -> np.ndarray:
    rank = fp.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayForest:
    """Hierarchical index over buckets of fingerprints, each bucket in Gray order under a root of its own."""

    def __init__(self, fp: np.ndarray, bucket: np.ndarray):
        order = np.lexsort((gray_rank(fp), bucket))
        self.order, self.fp, bucket = order, fp[order], bucket[order]
        n = len(fp)
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if n else np.zeros(0, np.int64)
        place = np.arange(n) - np.repeat(first, np.diff(np.r_[first, n]))
        self.starts, self.ends = [np.arange(n)], [np.arange(n)]
        self.mask, self.pattern = [np.full(n, ~np.uint64(0))], [self.fp]
        low, high, width = self.fp, self.fp, 0
        self.children: list[np.ndarray] = [np.zeros(0, np.int64)]
        while n and len(self.starts[-1]) > len(first):
            width += FAN
            below = self.starts[-1]
            opens = np.flatnonzero((place[below] & ((1 << width) - 1)) == 0)
            low, high = np.bitwise_and.reduceat(low, opens), np.bitwise_or.reduceat(high, opens)
            self.children.append(np.r_[opens, len(below)])
            self.starts.append(below[opens])
            self.ends.append(np.r_[below[opens][1:], n] - 1)
            self.mask.append(~(low ^ high))
            self.pattern.append(low)
        self.root = np.repeat(np.arange(len(first)), np.diff(np.r_[first, n])) if n else np.zeros(0, np.int64)

    def pairs(self, queries: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions (in index order) of later rows within ``limit`` bits of each query position."""
        level = len(self.starts) - 1
        q, node = queries, self.root[queries]
        seen = self.mask[level][node]
        total = np.bitwise_count((self.fp[q] ^ self.pattern[level][node]) & seen).astype(np.int64)
        keep = (total <= limit) & (self.ends[level][node] > q)
        q, node, total, seen = q[keep], node[keep], total[keep], seen[keep]
        while level:
            opens = self.children[level][node]
            many = self.children[level][node + 1] - opens
            back = np.repeat(np.arange(len(q)), many)
            node = np.arange(len(back)) - np.repeat(np.cumsum(many) - many, many) + opens[back]
            q, seen = q[back], seen[back]
            level -= 1
            shared = self.mask[level][node]
            total = total[back] + np.bitwise_count((self.fp[q] ^ self.pattern[level][node]) & shared & ~seen)
            keep = (total <= limit) & (self.ends[level][node] > q)
            q, node, total, seen = q[keep], node[keep], total[keep], shared[keep]
        return q, node


def spanning_stars(fp: np.ndarray, bucket: np.ndarray, limit: int = LIMIT, chunk: int = 1 << 14) -> tuple[np.ndarray, np.ndarray]:
    """Edges (member, root) that connect the linked rows of each bucket."""
    forest = GrayForest(fp, bucket)
    label = np.arange(len(fp))
    for at in range(0, len(fp), chunk):
        a, b = forest.pairs(np.arange(at, min(at + chunk, len(fp))), limit)
        while len(a):
            la, lb = label[a], label[b]
            differ = la != lb
            if not differ.any():
                break
            a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
            np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up
    member = np.flatnonzero(label != np.arange(len(fp)))
    return forest.fp[member], forest.fp[label[member]]


def _bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (choice, key) to edges; a bucket that is still open waits for the next batch."""
    def edges(choice, key, fp):
        change = np.r_[True, (choice[1:] != choice[:-1]) | (key[1:] != key[:-1])]
        bucket = np.cumsum(change)
        sizes = np.bincount(bucket)
        several = sizes[bucket] > 1
        a, b = spanning_stars(fp[several].view(np.uint64), bucket[several])
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    held = None
    for batch in batches:
        new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
        if not len(held[0]):
            continue
        same = (held[0] == held[0][-1]) & (held[1] == held[1][-1])
        cut = len(same) - int(same.sum())  # rows are sorted: the open bucket is the tail
        if cut:
            yield edges(*[x[:cut] for x in held])
            held = [x[cut:] for x in held]
    if held is not None and len(held[0]):
        yield edges(*held)


def links(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) that keep every component connected."""
    dealt = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m).cast("long")).alias("key"))
        for i, m in enumerate(block_masks())])).alias("at")).select("at.choice", "at.key", "fp")
    return dealt.repartition("choice", "key").sortWithinPartitions("choice", "key").mapInArrow(_bucket_links, "a long, b long")


# results -------------------------------------------------------------------------------------------------

def _components(prints: DataFrame, best) -> DataFrame:
    """``fp, component`` for each distinct fingerprint; component is the smallest ``best`` reachable."""
    nodes = written(prints.groupBy("fp").agg(F.min(best).alias("best")), "simhash-nodes")
    roots = connected(links(nodes.select("fp"))).withColumnRenamed("id", "fp")
    named = nodes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "best")
    least = named.groupBy("root").agg(F.min("best").alias("component"))
    return named.join(least, "root").select("fp", "component")


def classes(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    prints = written(fingerprints(docs), "simhash-prints")
    named = _components(prints, F.col("doc_id"))
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def dedup(docs: DataFrame) -> DataFrame:
    """One row of each component, with all columns."""
    prints = written(fingerprints(docs), "simhash-prints")
    rank = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")
    least = _components(prints, rank)
    stay = (
        prints.join(least, "fp").where(F.col("component") == rank)
        .groupBy("doc_id", "text_hash").agg(F.count("*").alias("ties"))
    )
    stay = written(stay, "simhash-stay").alias("s")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).select(
        "row", F.col("row.doc_id").alias("doc_id"), F.xxhash64(text_of("row.text")).alias("text_hash")).alias("r")
    kept = rows.join(stay, [F.col("r.doc_id").eqNullSafe(F.col("s.doc_id")), F.col("r.text_hash") == F.col("s.text_hash")])
    kept = kept.select("r.row", "r.doc_id", "r.text_hash", "s.ties")
    if not stay.where("ties > 1").isEmpty():
        kept = one_of_equal(kept, "ties", ["doc_id", "text_hash"])
    return kept.select("row.*")
