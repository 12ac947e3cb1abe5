"""Exact dedup with counting quotient filters.

Each partition puts the 64-bit fingerprints of its texts into a counting quotient
filter: the high bits (quotient) address a run of slots, the low bits (remainder) are
kept sorted in it, and every remainder has a counter, so equal fingerprints take one
slot. Only runs, remainders and counters are shuffled. Filters of the same quotient block merge
without loss by merging their sorted remainders and adding counters, in a binary tree. Fingerprints whose merged count is above one go to byte
verification, where texts are grouped by their bytes; all others are unique for certain.

Defined results: a null text counts as empty; of equal texts the row with the largest
doc_id stays (null is smallest), of repeated rows (same doc_id, same text) exactly one;
which of them is told by their other columns; very long texts are hashed and compared whole;
an empty table gives an empty result. Extra columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.llm.common import cut, fresh_names, row_order, text_of

#: Quotient blocks that are merged apart from each other.
BLOCKS = 256
REMAINDER_BITS = 48


class CountingQuotientFilter:
    """A lossless multiset of 64-bit fingerprints in quotient form.

    The leading ``64 - REMAINDER_BITS`` bits of a fingerprint are its quotient, the others its
    remainder. ``runs`` holds the end of each quotient's run of slots (from the filter's first
    quotient on), ``remainders`` the slots, ascending within a run, ``counts`` a counter per slot.
    """

    def __init__(self, first: int, runs: np.ndarray, remainders: np.ndarray, counts: np.ndarray) -> None:
        self.first, self.runs, self.remainders, self.counts = first, runs, remainders, counts

    @classmethod
    def _of(cls, prints: np.ndarray, counts: np.ndarray) -> CountingQuotientFilter:
        """From ascending, different fingerprints."""
        if not len(prints):
            return cls(0, np.zeros(0, np.int64), prints, counts)
        quotients = (prints >> np.uint64(REMAINDER_BITS)).astype(np.int64)
        runs = np.cumsum(np.bincount(quotients - quotients[0]))
        return cls(int(quotients[0]), runs, prints & np.uint64((1 << REMAINDER_BITS) - 1), counts)

    @classmethod
    def build(cls, prints: np.ndarray) -> CountingQuotientFilter:
        return cls._of(*np.unique(prints.astype(np.uint64), return_counts=True))

    def fingerprints(self) -> np.ndarray:
        quotients = np.repeat(np.arange(self.first, self.first + len(self.runs)).astype(np.uint64), np.diff(self.runs, prepend=0))
        return quotients << np.uint64(REMAINDER_BITS) | self.remainders

    def merge(self, other: CountingQuotientFilter) -> CountingQuotientFilter:
        """Both are in order of quotient and remainder, so each slot's place in the merged order is found, not sorted for."""
        if len(self.remainders) < len(other.remainders):
            return other.merge(self)
        mine, more = self.fingerprints(), other.fingerprints()
        at = np.searchsorted(mine, more)
        known = np.zeros(len(more), bool)
        inside = at < len(mine)
        known[inside] = mine[at[inside]] == more[inside]
        counts = self.counts.copy()
        counts[at[known]] += other.counts[known]  # no fingerprint occurs twice in a filter
        fresh = np.flatnonzero(~known)
        place = at[fresh] + np.arange(len(fresh))
        prints, sums = np.empty(len(mine) + len(fresh), np.uint64), np.empty(len(mine) + len(fresh), np.int64)
        old = np.ones(len(prints), bool)
        old[place] = False
        prints[place], prints[old] = more[fresh], mine
        sums[place], sums[old] = other.counts[fresh], counts
        return self._of(prints, sums)

    @staticmethod
    def merge_all(filters: Iterable[CountingQuotientFilter]) -> CountingQuotientFilter | None:
        """A binary tree of merges: at each time, filters held at least halve in size from one to the next."""
        held: list[CountingQuotientFilter] = []
        for new in filters:
            held.append(new)
            while len(held) > 1 and 2 * len(held[-1].remainders) >= len(held[-2].remainders):
                new = held.pop()
                held.append(held.pop().merge(new))
        while len(held) > 1:
            new = held.pop()
            held.append(held.pop().merge(new))
        return held[0] if held else None

    def blocks(self, n: int) -> Iterator[tuple[int, bytes]]:
        """The filter in ``n`` ranges of quotients, those that have slots."""
        width = -(-(1 << 64 - REMAINDER_BITS) // n)
        last = self.first + len(self.runs)
        for k in range(self.first // width, -(-last // width)):
            a, b = max(k * width, self.first), min((k + 1) * width, last)
            start, end = int(self.runs[a - self.first - 1]) if a > self.first else 0, int(self.runs[b - self.first - 1])
            if end > start:
                yield k, CountingQuotientFilter(a, self.runs[a - self.first : b - self.first] - start, self.remainders[start:end], self.counts[start:end]).dump()

    def dump(self) -> bytes:
        """First quotient, lengths of runs, remainders in their own bits, and counters of variable length.

        A counter takes no byte for 1, one byte up to 255 and nine above that; a bit per slot tells whether there is any.
        """
        many = self.counts > 1
        short = np.minimum(self.counts[many] - 1, 255).astype(np.uint8)
        slots = self.remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : REMAINDER_BITS // 8]
        head = np.array([self.first, len(self.runs), len(self.remainders), len(short)], "<i8")
        parts = head, np.diff(self.runs, prepend=0).astype("<u4"), np.ascontiguousarray(slots), np.packbits(many), short, self.counts[many][short == 255].astype("<i8")
        return b"".join(x.tobytes() for x in parts)

    @classmethod
    def load(cls, data: bytes) -> CountingQuotientFilter:
        first, quotients, slots, counted = np.frombuffer(data, "<i8", 4).tolist()
        at = 32
        runs = np.cumsum(np.frombuffer(data, "<u4", quotients, at), dtype=np.int64)
        at += 4 * quotients
        wide = np.zeros((slots, 8), np.uint8)
        size = REMAINDER_BITS // 8
        wide[:, :size] = np.frombuffer(data, np.uint8, slots * size, at).reshape(slots, size)
        at += slots * size
        flags = -(-slots // 8)
        many = np.unpackbits(np.frombuffer(data, np.uint8, flags, at), count=slots).astype(bool)
        at += flags
        short = np.frombuffer(data, np.uint8, counted, at)
        counts, own = np.ones(slots, np.int64), short.astype(np.int64) + 1
        own[short == 255] = np.frombuffer(data, "<i8", -1, at + counted)
        counts[many] = own
        return cls(first, runs, wide.view("<u8").ravel(), counts)


def repeated_fingerprints(prints: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """``fp`` (bigint, one row per text) -> the fingerprints that occur more than once, with counts."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = CountingQuotientFilter.merge_all(CountingQuotientFilter.build(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)) for batch in batches)
        pieces = list(own.blocks(blocks)) if own is not None else []
        if pieces:
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in pieces], pa.int32()), pa.array([b for _, b in pieces], pa.binary())], names=["block", "filter"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[bytes]] = {}
        for batch in batches:
            for k, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found.setdefault(k, []).append(data)
        for k in list(found):
            whole = CountingQuotientFilter.merge_all(map(CountingQuotientFilter.load, found.pop(k)))
            many = whole.counts > 1
            yield pa.RecordBatch.from_arrays([pa.array(whole.fingerprints()[many].view(np.int64)), pa.array(whole.counts[many])], names=["fp", "n"])

    return prints.select("fp").mapInArrow(build, "block int, filter binary").repartition("block").mapInArrow(merge, "fp bigint, n bigint")


def exact_groups(docs: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """Documents -> ``doc_id, keep_id, group_size, kept, text_sha256``."""
    texts = docs.select(docs["doc_id"].alias("doc_id"), text_of(docs).alias("t")).withColumn("fp", F.xxhash64("t"))
    repeated = cut(repeated_fingerprints(texts, blocks), "repeated").select(F.col("fp").alias("rfp"))
    # byte verification: grouping by the text itself, combined in each partition before the shuffle
    groups = (
        texts.join(repeated, F.col("fp") == F.col("rfp"), "left_semi")
        .groupBy("t")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.unhex(F.sha2("t", 256)).alias("gsha"), "keep_id", "n")
    )
    once = Window.partitionBy("doc_id", "sha").orderBy(F.lit(0))
    rows = texts.select("doc_id", F.unhex(F.sha2("t", 256)).alias("sha")).withColumn("nth", F.row_number().over(once))
    return rows.join(groups, F.col("sha") == F.col("gsha"), "left").select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"),
        (F.col("n").isNull() | (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, **options) -> DataFrame:
    """The documents that stay, with all their columns."""
    names = docs.columns
    id_, sha, gone, own, nth = fresh_names(docs, 5)
    lost = exact_groups(docs, **options).where("not kept").groupBy(F.col("doc_id").alias(id_), F.col("text_sha256").alias(sha)).agg(F.count(F.lit(1)).alias(gone))
    marked = docs.withColumn(own, F.sha2(text_of(docs), 256))
    marked = marked.withColumn(nth, F.row_number().over(Window.partitionBy("doc_id", own).orderBy(row_order(docs))))
    joined = marked.join(lost, F.expr(f"doc_id <=> {id_} and {own} = {sha}"), "left")
    return joined.where(f"coalesce({gone}, 0) < {nth}").select(*[F.col(f"`{n}`") for n in names])
