"""Operator 1, exact dedup by skew-safe combining.

Texts are equal when they are the same after deleting blanks. Equal rows are combined three times, each
time with the whole content as part of the grouping key, so that a digest collision never merges texts:

1. locally, by the map side of the first aggregation;
2. per (digest, content, salt), the salt coming from doc_id, so a huge group of copies has many mergers;
3. per (digest, content) over the winners of the salts.

A digest that several contents share keeps its contents in the verdict table, and its rows are matched by
content; all other rows are matched by digest alone, so texts do not travel a third time.

Defined results: a null text counts as empty (all empty texts are one group); a null doc_id ranks after all
others; rows equal in doc_id and length are ties and one of them stays; empty tables give empty results;
further columns, whatever their names, pass through ``dedup`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, one_of_equal, text_of, written

SALTS = 16


def normalised(column: str = "text") -> Column:
    return F.translate(text_of(column), BLANKS, "")


def _rows(docs: DataFrame, digest) -> DataFrame:
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    content = normalised("row.text")
    return whole.select("row", F.col("row.doc_id").alias("doc_id"), F.length(text_of("row.text")).alias("points"),
                        digest(content).alias("digest"), content.alias("content"), F.sha2(content, 256).alias("text_sha256"))


def _sha256(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def verdicts(docs: DataFrame, salts: int = SALTS, digest=_sha256) -> DataFrame:
    """One row per distinct content: digest, content (null unless the digest is shared), best row, group size."""
    order = F.struct((-F.col("points")).alias("shorter"), F.col("doc_id").isNull().alias("nameless"), "doc_id")
    salted = (
        _rows(docs, digest)
        .select("digest", "content", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"), order.alias("order"))
        .groupBy("digest", "content", "salt").agg(F.min("order").alias("best"), F.count("*").alias("size"))
    )
    merged = (
        salted.repartition("digest")
        .groupBy("digest", "content").agg(F.min("best").alias("best"), F.sum("size").alias("size"))
    )
    shared = F.expr("count(*) over (partition by digest)") > 1
    return merged.select("digest", F.when(shared, F.col("content")).alias("content"), "best", "size")


def _judged(docs: DataFrame, salts: int, digest) -> DataFrame:
    """Rows of the documents with the verdict on their content; contents travel only for shared digests."""
    table = written(verdicts(docs, salts, digest), "exact-dedup")
    rows, narrow = _rows(docs, digest), ["doc_id", "points", "text_sha256", "digest"]
    judged = rows.select(*narrow).join(table.where("content is null").drop("content"), "digest")
    shared = table.where("content is not null")
    if not shared.isEmpty():
        judged = judged.unionByName(rows.select(*narrow, "content").join(shared, ["digest", "content"]).drop("content"))
    return judged


def _is_best() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("points") == -F.col("best.shorter"))


def classes(docs: DataFrame, salts: int = SALTS, digest=_sha256) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Ties (equal doc_id, length and content) are counted first, and the first of each count stays.
    """
    judged = _judged(docs, salts, digest)
    counted = judged.groupBy("doc_id", "points", "digest", "text_sha256", "best", "size").agg(F.count("*").alias("ties"))
    each = counted.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("ties").cast("int"))))
    return each.select("doc_id", F.col("best.doc_id").alias("keep_id"), F.col("size").alias("group_size"),
                       (_is_best() & (F.col("nth") == 1)).alias("kept"), "text_sha256")


def dedup(docs: DataFrame, salts: int = SALTS, digest=_sha256) -> DataFrame:
    """The rows that stay, with all their columns."""
    best = _judged(docs, salts, digest).where(_is_best())
    stay = written(best.groupBy("text_sha256", "doc_id", "points").agg(F.count("*").alias("ties")), "exact-dedup-stay")
    rows = _rows(docs, digest).select("row", "doc_id", "points", "text_sha256").alias("r")
    same = [F.col("r.text_sha256") == F.col("s.text_sha256"), F.col("r.doc_id").eqNullSafe(F.col("s.doc_id")),
            F.col("r.points") == F.col("s.points")]
    kept = rows.join(stay.alias("s"), same).select("r.row", "s.text_sha256", "s.ties")
    if not stay.where("ties > 1").isEmpty():
        kept = one_of_equal(kept, "ties", ["text_sha256"])
    return kept.select("row.*")
