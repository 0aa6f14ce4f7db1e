"""Operator 13, source divergence audit by ranking count cells.

Every language keeps the terms of at least ``least`` of its documents. A group (language and source) gives a kept term
the share p = 1 + floor(1e9 (count + 5) / (N + 5 V)), its language the share q by the language's own counts.

A share depends on nothing but counts, so terms are not ranked one by one. A group's terms fall into cells of equal
(count in the group, count in the language); p, q and their difference f are worked out per cell. Cells of equal f are
merged and ranked by the number of terms in them, and only the cells that begin within the first ``ranks`` ranks are
expanded to their terms in UTF-8 order. For the distance between two sources the cells are the terms with the same
counts in all sources of the language, each weighed by how many terms it holds.

Terms are counted over byte strings in each task, many documents together, and added up by (language, source, term); a
hot source or term arrives as one row per task. Arithmetic is in whole numbers: decimals, or Python integers where a
long is too short.

The result has a row for each ordered pair of sources of a language, so the list of groups (the driver's, and sent to
tasks) is the square root of the result, and a term's list of sources is no longer than it.

Defined results: null text, language and source are ''; groups without kept terms are listed with V or N of zero (all
distances 0 where V is 0); a text is one document however often it repeats; very long texts are counted in blocks cut
between terms; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, text_of, written

LEAST_DOCUMENTS, RANKS = 30, 50
UNIT, ADDED = 1_000_000_000, 5
#: Distinct (group, term) entries a task holds before it sends them on.
HELD = 200_000
#: Bytes of one text whose terms are listed at once.
BLOCK = 1 << 20
#: Numbers in one block of shares.
CELLS_AT_ONCE = 1 << 19
_TERM, _BREAK = re.compile(rb"[a-z\x80-\xff]+"), re.compile(rb"[^a-z\x80-\xff]")


# counts --------------------------------------------------------------------------------------------------

def _blocks(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a lower-cased text, about BLOCK bytes at a time; a term is never cut."""
    at = 0
    while at < len(text):
        cut = _BREAK.search(text, at + BLOCK) if len(text) - at > BLOCK else None
        end = cut.start() if cut else len(text)
        yield _TERM.findall(text, at, end)
        at = end


def _counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs`` by task, to be added up."""
    names = ["lang", "source", "term", "n", "docs"]

    def rows(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (times, documents) in held.items():
            terms = list(times)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array(terms, pa.binary()),
                 pa.array(times.values(), pa.int64()), pa.array([documents[t] for t in terms], pa.int64())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = defaultdict(lambda: (Counter(), Counter())), 0
        for part in slices(batches):
            for lang, source, text in zip(*(part.column(c).to_pylist() for c in ("lang", "source", "text"))):
                times, documents = held[lang, source]
                before, seen = len(times), set()
                for terms in _blocks(text.lower()):  # bytes: A-Z only
                    times.update(terms)
                    seen.update(terms)
                documents.update(seen)
                size += len(times) - before
            if size > HELD:
                yield from rows(held)
                held.clear()
                size = 0
        yield from rows(held)

    read = docs.select(text_of("lang").alias("lang"), text_of("source").alias("source"), text_of().cast("binary").alias("text"))
    return read.mapInArrow(run, "lang string, source string, term binary, n long, docs long").withColumn("term", F.col("term").cast("string"))


def kept_terms(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``lang, term, total`` and ``places`` (array of source and n) of the terms that a language keeps."""
    by_source = _counts(docs).groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return by_source.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("places"),
    ).where(F.col("docs") >= least).drop("docs")


def groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang, source, size, terms, lang_size`` of every group that occurs."""
    all_groups = docs.select(text_of("lang").alias("lang"), text_of("source").alias("source")).distinct()
    sizes = kept.select("lang", F.explode("places").alias("p")).groupBy("lang", F.col("p.source").alias("source")).agg(F.sum("p.n").alias("size"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("lang_size"))
    return all_groups.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["size", "terms", "lang_size"])


# the two parts -------------------------------------------------------------------------------------------

def _share(count: str, size: str) -> str:
    return f"1 + ({UNIT} * cast({count} + {ADDED} as decimal(25,0))) div cast({size} + {ADDED} * terms as decimal(25,0))"


def term_ranks(kept: DataFrame, found: DataFrame, ranks: int = RANKS) -> DataFrame:
    """The terms a group uses more than its language does, greatest difference first, to rank ``ranks``."""
    group, cell = ["lang", "source"], ["lang", "source", "here", "total"]
    terms = kept.select("lang", "term", "total", F.explode("places").alias("p")).select(
        "lang", F.col("p.source").alias("source"), F.col("p.n").alias("here"), "total", "term")
    cells = terms.groupBy(*cell).agg(F.count("*").alias("many")).join(found, group).selectExpr(
        *cell, "many", f"{_share('here', 'size')} as p", f"{_share('total', 'lang_size')} as q").where("p > q").selectExpr(*cell, "many", "p - q as value")
    down = Window.partitionBy(*group).orderBy(F.desc("value"))
    before = F.coalesce(F.sum("many").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    merged = cells.groupBy(*group, "value").agg(F.sum("many").alias("many"))
    leading = merged.withColumn("nth", F.row_number().over(down)).where(F.col("nth") <= ranks)  # each holds a term at least
    wanted = leading.select(*group, "value", before.alias("before")).where(F.col("before") < ranks)
    expanded = terms.join(cells.join(wanted, [*group, "value"]).select(*cell, "value", "before"), cell)
    nth = F.row_number().over(Window.partitionBy(*group, "value").orderBy("term"))
    return expanded.withColumn("nth", nth).where(F.col("nth") <= ranks).select(
        *group, F.lit("term").alias("part"), F.col("term").alias("item"), "value", (F.col("before") + F.col("nth")).cast("int").alias("rank")
    ).where(F.col("rank") <= ranks)


def pair_sums(kept: DataFrame, listed: dict[str, tuple[list[str], list[int], int]]) -> DataFrame:
    """``lang, a, b, value`` for sources a < b by their numbers in ``listed`` (lang: sources, sizes, terms kept)."""
    cells = kept.groupBy("lang", F.col("places").alias("cell")).agg(F.count("*").alias("many"))

    def shares(lang: str, places: list, counts: np.ndarray) -> np.ndarray:
        _, sizes, terms = listed[lang]
        whole = np.asarray([s + ADDED * terms for s in sizes], object)
        if max(sizes) < (1 << 63) // UNIT - ADDED:
            whole = whole.astype(np.int64)
        return 1 + (UNIT * (counts.astype(whole.dtype) + ADDED) // whole).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {lang: {s: i for i, s in enumerate(sources)} for lang, (sources, *_) in listed.items()}
        sums = {}
        for batch in batches:
            by_lang = defaultdict(list)
            for lang, cell, many in zip(*(batch.column(c).to_pylist() for c in ("lang", "cell", "many"))):
                by_lang[lang].append((cell, many))
            for lang, rows in by_lang.items():
                wide, total = len(number[lang]), sums.setdefault(lang, np.zeros((len(number[lang]),) * 2, np.int64))
                step = max(1, CELLS_AT_ONCE // wide)
                for start in range(0, len(rows), step):
                    part = rows[start:start + step]
                    counts = np.zeros((len(part), wide), np.int64)
                    for k, (cell, _) in enumerate(part):
                        for place in cell:
                            counts[k, number[lang][place["source"]]] = place["n"]
                    p, many = shares(lang, [c for c, _ in part], counts), np.asarray([m for _, m in part], np.int64)
                    for a in range(wide - 1):
                        total[a, a + 1:] += many @ np.abs(p[:, a + 1:] - p[:, a, None])
        for lang, total in sums.items():
            a, b = np.triu_indices(len(total), 1)
            sources = np.asarray(listed[lang][0], object)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(a), pa.string()), pa.array(sources[a], pa.string()),
                                              pa.array(sources[b], pa.string()), pa.array(total[a, b])], ["lang", "a", "b", "value"])

    parts = cells.mapInArrow(run, "lang string, a string, b string, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def pair_ranks(kept: DataFrame, found: DataFrame) -> DataFrame:
    """Every other source of the language, the most different first."""
    listed: dict[str, tuple[list[str], list[int], int]] = {}
    for r in found.orderBy("lang", "source").collect():
        sources, sizes, _ = listed.setdefault(r.lang, ([], [], r.terms))
        sources.append(r.source)
        sizes.append(r.size)
    sums = pair_sums(kept, listed)
    both = sums.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        sums.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    others = found.select("lang", F.col("source").alias("item"))
    pairs = found.select("lang", "source").join(others, "lang").where("source <> item").join(both, ["lang", "source", "item"], "left")
    valued = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return valued.withColumn("rank", rank)


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, ranks: int = RANKS) -> DataFrame:
    """``lang, source, part, item, value, rank`` of both parts."""
    kept = written(kept_terms(docs, least), "kept-terms")
    found = written(groups(docs, kept), "groups")
    return pair_ranks(kept, found).unionByName(term_ranks(kept, found, ranks))
