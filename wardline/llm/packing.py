"""Operator 4, best-fit packing planned by a configuration linear program.

The lengths 1..capacity form a histogram of bounded size, and only that reaches the driver. The program has
a variable for each way to fill a sequence (a configuration) and asks for the fewest sequences that cover the
histogram. Multiplicative weights solve it: every length has a price, starting at its share of the capacity;
a knapsack by dynamic programming finds the configurations of greatest price; a step of each is taken, and
the prices of what it covered fall. Whole parts of the steps are kept where they fill their sequences, and the rest is
packed best fit, longest first, all equal sequences together.

The plan is a table of slots: for a length, ranks from..to go to which sequences and places. Pieces get their
rank within their length from salted counts, so a length that holds most pieces is numbered by many tasks.

Defined results: null text counts as empty, an empty document is its end id alone; only documents longer than
a sequence are cut, their first piece taking the remainder; a null doc_id and repeated rows are packed like
any other, each for itself; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, text_of, written
from .units import forget, worker_store
from .words import WordIds

CAPACITY = 2048
#: Text bytes that are encoded together; a distinct word is handled once in them, and a worker's memory grows with them.
#: Results do not depend on it.
TEXT_BYTES = 4 << 20
#: Share of a length that one step may cover, fall of its price when all of it is covered, steps per knapsack.
STEP, FALL, STEPS_PER_KNAPSACK = 1 / 8, 4.0, 32
#: Pieces that one numbering task sees on average.
PIECES_PER_SALT = 100_000


# pieces --------------------------------------------------------------------------------------------------

def _encoder(path: str) -> WordIds:
    """Ids as little-endian bytes; special strings as the library treats them by default."""
    store, key = worker_store(), f"packing ids {path}"
    if key not in store:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        store[key] = WordIds(Tokenizer.from_file(path))
    return store[key]


def _cut(tokenizer: str, capacity: int, end: bytes, with_ids: bool, names: list[str]):
    """Texts to pieces, a bounded number of text bytes at a time; each time Arrow gives back what it no longer uses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget(keep=f"packing ids {tokenizer}")
        encoder = _encoder(tokenizer)
        for part in slices(batches, size=TEXT_BYTES):
            owner, number, start, length, crc, ids = [], [], [], [], [], []
            for row, ids_of_text in enumerate(encoder.ids(part.column("text").to_pylist())):
                whole = ids_of_text + end
                total = len(whole) // 4
                cuts = [0, *range(total % capacity or capacity, total + 1, capacity)] if total > capacity else [0, total]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    owner.append(row)
                    number.append(k)
                    start.append(a)
                    length.append(b - a)
                    cut = memoryview(whole)[4 * a:4 * b]
                    crc.append(zlib.crc32(cut))
                    if with_ids:
                        ids.append(bytes(cut))
            pa.default_memory_pool().release_unused()
            columns = [part.column("doc_id").take(pa.array(owner, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.binary())] * with_ids, names)
    return run


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = True) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if wanted, ``ids`` (little-endian 32-bit integers)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    names = [part.split()[0] for part in schema.split(", ")]
    run = _cut(tokenizer, capacity, int(end_id).to_bytes(4, "little"), with_ids, names)
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, schema)


# the plan ------------------------------------------------------------------------------------------------

def _knapsack(sizes: np.ndarray, price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value of every room 0..capacity, and the item (index) to take first; -1 takes none."""
    value, take = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        n = bisect_left(sizes, room + 1)
        value[room] = value[room - 1]
        take[room] = -2  # leave one place empty
        if n:
            gain = value[room - sizes[:n]] + price[:n]
            best = int(gain.argmax())
            if gain[best] >= value[room]:
                value[room], take[room] = gain[best], best
    return value, take


def _fill(room: int, sizes: np.ndarray, take: np.ndarray) -> list[int]:
    items = []
    while room > 0 and take[room] != -1:
        if take[room] == -2:
            room -= 1
        else:
            items.append(int(take[room]))
            room -= int(sizes[take[room]])
    return items


def solve(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], float]]:
    """Configurations (lengths) with fractional counts that cover the histogram exactly."""
    sizes = np.asarray(sorted(histogram), np.int64)
    need = np.asarray([histogram[s] for s in sizes], np.float64)
    left, price = need.copy(), sizes / capacity
    steps: dict[tuple[int, ...], float] = {}
    while True:
        open_ = np.flatnonzero(left > 1e-9 * need)
        if not len(open_):
            return [(tuple(int(sizes[i]) for i in items), x) for items, x in steps.items()]
        some = sizes[open_]
        value, take = _knapsack(some, price[open_], capacity)
        with_item = price[open_] + value[capacity - some]
        for first in np.argsort(-with_item, kind="stable")[:STEPS_PER_KNAPSACK]:
            inside = [first, *_fill(capacity - int(some[first]), some, take)]
            items, times = np.unique(open_[inside], return_counts=True)
            room = left[items] / times
            amount = min(room.min(), max((STEP * need[items] / times).min(), 1.0))
            if room.min() <= 1e-9:
                continue
            left[items] = np.where(room <= amount, 0.0, left[items] - amount * times)
            price[items] *= np.exp(-FALL * amount * times / need[items])
            key = tuple(np.repeat(items, times)[::-1].tolist())
            steps[key] = steps.get(key, 0.0) + amount


def lower_bound(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = 8) -> int:
    """Sequences that no packing can do without: the dual value of the program at a few price vectors.

    With the prices scaled so that no configuration is worth more than 1, the histogram's worth is a bound. The
    lengths themselves are prices (the volume bound); prices that rise at shares of the capacity are others.
    """
    sizes = np.asarray(sorted(histogram), np.int64)
    need = np.asarray([histogram[s] for s in sizes], np.float64)
    if not len(sizes):
        return 0
    best = int(-(-int((sizes * need).sum()) // capacity))
    for k in range(1, rounds):
        price = np.floor(sizes * (k + 1) / (capacity + 1)) / k  # at most k items are worth 1/k or more
        worth = _knapsack(sizes, price, capacity)[0][capacity]
        if worth > 0:
            best = max(best, int(np.ceil((price * need).sum() / worth - 1e-6)))
    return best


def _best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest first, each into the fullest sequence that still takes it; equal sequences are filled together.

    Configurations with counts, so the work follows the number of different lengths, not the number of pieces.
    """
    rooms: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    order: list[int] = []

    def put(items: tuple[int, ...], count: int, room: int) -> None:
        if room not in rooms:
            rooms[room] = []
            order.insert(bisect_left(order, room), room)
        rooms[room].append((items, count))

    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            at = bisect_left(order, size)
            if at == len(order):
                room, items, count = capacity, (), left
            else:
                room = order[at]
                items, count = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room], order[at]
            times = room // size  # the fullest sequence is the one just filled, as long as it takes more
            filled = min(count, left // times)
            if filled:
                put(items + (size,) * times, filled, room - times * size)
                left -= filled * times
            if left and left < times and filled < count:
                put(items + (size,) * left, 1, room - left * size)
                filled, left = filled + 1, 0
            if items and filled < count:
                put(items, count - filled, room)
    return [group for groups in rooms.values() for group in groups]


#: Empty places up to which a sequence of the rounded program is kept; the pieces of the others are packed anew.
KEPT_WASTE = (CAPACITY, 64, 16, 4, 1, 0)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Configurations with whole counts; together they hold every length exactly as often as it occurs.

    The whole parts of the program's solution are kept as far as they fill their sequences, the rest is packed best fit.
    Of several bounds on the filling, and of best fit alone, the one with the fewest sequences is taken.
    """
    todo = {s: n for s, n in histogram.items() if n and s < capacity}
    full = [((capacity,), histogram[capacity])] if histogram.get(capacity) else []
    solved = sorted(solve(todo, capacity), key=lambda c: sum(c[0]), reverse=True)
    best = None
    for waste in (*KEPT_WASTE, -1):
        left, chosen = dict(todo), []
        for items, x in solved:
            if capacity - sum(items) > waste:
                break
            # once more than the whole part, if the lengths are there: it fills its sequence
            count = min([int(x + 1 - 1e-6), *(left[s] // items.count(s) for s in set(items))])
            if count:
                chosen.append((items, count))
                for s in items:
                    left[s] -= count
        chosen += _best_fit({s: n for s, n in left.items() if n}, capacity)
        if best is None or sum(n for _, n in chosen) < sum(n for _, n in best):
            best = chosen
    return full + best


class Slots:
    """For (length, rank within the length) the sequence and the place in it."""

    def __init__(self, chosen: list[tuple[tuple[int, ...], int]]):
        rows, used, sequence = [], {}, 0
        for items, count in chosen:
            offset = 0
            for size in sorted(set(items), reverse=True):
                times = items.count(size)
                rows.append((size, used.get(size, 0), times, offset, sequence))
                used[size] = used.get(size, 0) + times * count
                offset += times * size
            sequence += count
        self.sequences = sequence
        self.size, self.first, self.times, self.offset, self.sequence = np.asarray(sorted(rows), np.int64).reshape(-1, 5).T

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        opens = np.searchsorted(self.size, length, "left")
        closes = np.searchsorted(self.size, length, "right")
        low, high = opens, closes - 1
        while (low < high).any():  # last row of the length whose first rank is not above the rank
            middle = (low + high + 1) // 2
            fits = self.first[middle] <= rank
            low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
        past = rank - self.first[low]
        return self.sequence[low] + past // self.times[low], self.offset[low] + past % self.times[low] * length


# packing -------------------------------------------------------------------------------------------------

def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; ``cut`` must be a written Parquet table with a column ``length``."""
    histogram = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = Slots(plan(histogram, capacity))
    salts = max(1, sum(histogram.values()) // PIECES_PER_SALT)
    # a row's place in the written files tells even identical rows apart, so no salt is hot
    place = F.struct(F.xxhash64("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i"))
    salted = cut.select(F.struct(*[F.col(f"`{c}`") for c in cut.columns]).alias("row"), "length", place.alias("order")).withColumn(
        "salt", F.pmod(F.xxhash64("order"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n")).select(
        "length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    nth = F.row_number().over(Window.partitionBy("length", "salt").orderBy("order"))
    ranked = salted.withColumn("nth", nth - 1).join(counts, ["length", "salt"]).select(
        "row", "length", (F.col("nth") + F.col("base")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            found = slots.find(part.column("length").to_numpy(), part.column("rank").to_numpy())
            rows = part.column("row")
            yield pa.RecordBatch.from_arrays([*rows.flatten(), *map(pa.array, found)],
                                             [*(f.name for f in rows.type), "sequence_id", "offset"])

    from pyspark.sql.types import LongType, StructType

    schema = StructType([*cut.schema.fields]).add("sequence_id", LongType()).add("offset", LongType())
    return ranked.mapInArrow(run, schema)


def packed_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece."""
    return pack(written(pieces(docs, tokenizer, capacity, with_ids=False), "pieces"), capacity)
