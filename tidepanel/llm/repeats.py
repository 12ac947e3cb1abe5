"""Removal of bytes that repeat an earlier passage of ``LENGTH`` bytes or more.

Every ``LENGTH``-byte window of a text has one anchor: the ``GRAM``-byte substring in it
with the smallest hash (the leftmost of several). Equal windows have equal anchors at equal
places, so only windows whose anchor recurs can repeat. Consecutive windows with the same
anchor form a run. Occurrences of an anchor are compared in the order of their contexts:

1. of runs with equal bytes, all but the first occurrence are repeats, whole;
2. first occurrences of different runs with one anchor send their bytes to the anchor's
   task. There the earlier ones are indexed by a run-length compressed Burrows-Wheeler
   transform with sampled run ends (:class:`RunLengthIndex`), the later ones are streamed
   against it, and matches of ``LENGTH`` bytes or more in their matching statistics are repeats.

So the anchors divide the index of the corpus into blocks that no match crosses. Equal runs
are combined within each batch before the shuffle, so a passage that very many documents
share costs one row per task; they are told by a 64-bit polynomial hash of their bytes.
Matches in the index are of bytes.

Defined results: a null text is empty; rows of one doc_id and one text are one document, each
of them gets its result, and none is earlier than another; of different texts that share a
doc_id, the one with the smaller hash comes first; a null doc_id comes before all others; texts
shorter than ``LENGTH`` keep all bytes; very long texts are read whole, in overlapping pieces; an
empty table gives an empty result; a doc_id that isn't an integer is an error; extra columns
take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import arrow_schema, cut, gather, text_of

LENGTH = 100
GRAM = 24
#: Bytes that are hashed at once.
CHUNK = 1 << 20
NULL_ID = -(2**63)
#: Texts in one index.
BLOCK = 4000
#: Bytes that the first order of suffixes compares.
PACK = 5
_DRAW = np.random.default_rng(97)
TABLES = _DRAW.integers(1, 2**63, (2, 256), np.uint64)
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@cache
def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    base = BASES[which]
    inverse = pow(base, -1, 1 << 64)
    up, down = np.full(n, base, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Hashes:
    """Hashes of all substrings of one piece of bytes."""

    def __init__(self, data: np.ndarray, which: int = 0) -> None:
        size = 1 << max(12, (len(data) + 1).bit_length())
        up, self.down = _powers(which, size)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(TABLES[which][data] * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def every(self, n: int) -> np.ndarray:
        return (self.sums[n:] - self.sums[:-n]) * self.down[: len(self.sums) - n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def runs(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Of one text: first and last window start, anchor hash and run hash of every run."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none.view(np.uint64), none.view(np.uint64)
    if len(data) > CHUNK + length:  # in pieces that overlap by length - 1 bytes, cut where runs may be cut as well
        parts = []
        for at in range(0, len(data) - length + 1, CHUNK):
            lo, hi, anchor, run = runs(data[at : at + CHUNK + length - 1], length, gram)
            parts.append((lo + at, hi + at, anchor, run))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
    hashes = Hashes(data)
    grams = _mix(hashes.every(gram))
    # the smallest (hash, place) in every window: forty bits of hash, then the place
    best = grams >> np.uint64(24) << np.uint64(24) | np.arange(len(grams), dtype=np.uint64)
    width, have = length - gram + 1, 1
    while have < width:
        step = min(have, width - have)
        best = np.minimum(best[:-step], best[step:])
        have += step
    place = (best & np.uint64((1 << 24) - 1)).astype(np.int64)
    lo = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    hi = np.r_[lo[1:] - 1, len(place) - 1]
    place = place[lo]
    run = _mix(hashes.of(lo, hi + length) ^ _mix((place - lo).astype(np.uint64) * np.uint64(4096) + (hi - lo).astype(np.uint64)))
    return lo, hi, grams[place], run


def _first_of(keys: tuple[np.ndarray, ...], order: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted index by keys, then order, of what differs in them; and for each sorted place whether it is the first of its keys."""
    index = np.lexsort((*order[::-1], *keys[::-1]))
    new, other = np.zeros(len(index), bool), np.zeros(len(index), bool)
    if len(index):
        new[0] = other[0] = True
    for k in keys:
        new[1:] |= k[index][1:] != k[index][:-1]
    for k in order:
        other[1:] |= k[index][1:] != k[index][:-1]
    kept = new | other  # one place of one document is one occurrence, however many rows hold it
    return index[kept], new[kept]


def _numpy(table: pa.Table | pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [table.column(n).to_numpy() if isinstance(table, pa.Table) else table.column(n).to_numpy(zero_copy_only=False) for n in names]


OCCURRENCE = "kind int, anchor bigint, run bigint, doc bigint, uid bigint, pos bigint"
#: ``pos`` holds the first window start of a run and, in so many bits, how far its last start lies behind.
BITS = 8
SPAN = "kind int, anchor bigint, doc bigint, uid bigint, lo int, hi int"


def _occurrences(texts: DataFrame, length: int) -> DataFrame:
    """Runs of all texts; ``kind`` 1 for those that an earlier run of the same batch already repeats."""
    target = arrow_schema(OCCURRENCE)

    def emit(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        anchor, run, doc, uid, pos = (np.concatenate(x) for x in zip(*parts, strict=True))
        index, first = _first_of((anchor, run), (doc, uid, pos))
        cols = np.where(first, 0, 1), anchor.view(np.int64)[index], run.view(np.int64)[index], doc[index], uid[index], pos[index]
        return pa.RecordBatch.from_arrays([pa.array(c.astype(f.type.to_pandas_dtype()), f.type) for c, f in zip(cols, target, strict=True)], schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for doc, uid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                lo, hi, anchor, code = runs(data, length)
                if len(lo):
                    n = len(lo)
                    parts.append((anchor, code, np.full(n, doc), np.full(n, uid), lo << BITS | (hi - lo)))
                    held += n
                if held > 200_000:
                    yield emit(parts)
                    parts, held = [], 0
        if parts:
            yield emit(parts)

    return texts.select("doc", "uid", "bytes").mapInArrow(run, OCCURRENCE)


def _compare_runs(found: DataFrame, length: int) -> DataFrame:
    """Runs by anchor -> spans (``kind`` 1) that repeat, and first runs to be looked at (``kind`` 0)."""
    target = arrow_schema(SPAN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = gather(batches)
        if whole is None:
            return
        kind, anchor, code, doc, uid, pos = _numpy(whole, "kind", "anchor", "run", "doc", "uid", "pos")
        lo = pos >> BITS
        hi = lo + (pos & (1 << BITS) - 1)
        known, open_ = np.flatnonzero(kind == 1), np.flatnonzero(kind == 0)
        index, first = _first_of((anchor[open_], code[open_]), (doc[open_], uid[open_], pos[open_]))
        index = open_[index]
        # first runs whose anchor has another run
        one = index[first]
        own = anchor[one]
        change = np.r_[True, own[1:] != own[:-1], True]
        shared = ~(change[:-1] & change[1:])
        look, again = one[shared], np.r_[index[~first], known]
        kind = np.r_[np.zeros(len(look), np.int32), np.ones(len(again), np.int32)]
        pick = np.r_[look, again]
        cols = kind, anchor[pick], doc[pick], uid[pick], lo[pick], hi[pick] + length
        for at in range(0, len(pick), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(c[at : at + 50_000].astype(f.type.to_pandas_dtype()), f.type) for c, f in zip(cols, target, strict=True)], schema=target)

    # repeats found in a batch needn't meet their anchor, they are dealt evenly
    by = F.when(F.col("kind") == 0, F.col("anchor")).otherwise(F.xxhash64("doc", "pos"))
    return found.repartition(by).mapInArrow(run, SPAN)


class RunLengthIndex:
    """Run-length compressed Burrows-Wheeler transform of a block of texts, with sampled run ends.

    A text matches patterns of its own group only: bytes of different groups are different
    symbols. Of the transform, only runs are kept: head, length, the places in the block of
    their first and last symbol, and the row that the head leads to.
    """

    def __init__(self, data: np.ndarray, sizes: np.ndarray, groups: np.ndarray) -> None:
        n = len(data) + len(sizes)
        ends = np.cumsum(sizes + 1) - 1  # each text ends with a symbol below all bytes
        text = np.repeat(np.arange(len(sizes)), sizes + 1)
        inside = np.ones(n, bool)
        inside[ends] = False
        symbols = np.full(n, -1, np.int64)
        symbols[inside] = groups[text[inside]] * 256 + data
        self.left = ends[text] - np.arange(n)
        self.bytes = np.zeros(n + max(int(sizes.max(initial=0)), PACK) + 1, np.uint8)
        self.bytes[:n][inside] = data
        order = self._suffixes(symbols, int(sizes.max(initial=0)))
        before = symbols[order - 1]
        heads = np.flatnonzero(np.r_[True, before[1:] != before[:-1]])
        lengths = np.diff(np.r_[heads, n])
        by = np.lexsort((heads, before[heads]))
        self.rows, self.start = n, int(order[0])
        self.heads, self.lengths, self.symbols = heads[by], lengths[by], before[heads][by]
        self.keys = self.symbols * n + self.heads
        self.first, self.last = order[heads][by], order[heads + lengths - 1][by]
        self.lands = np.cumsum(self.lengths) - self.lengths

    def _suffixes(self, symbols: np.ndarray, longest: int) -> np.ndarray:
        """Suffixes in order, equal ones in the order of their texts; by doubling of the length that is compared."""
        n = len(symbols)
        key = symbols + 1
        for j in range(1, PACK):
            key = key * 257 + np.where(self.left > j, self.bytes[j : n + j].astype(np.int64) + 1, 0)
        rank, have = _dense(key), PACK
        while have < longest:
            ahead = np.where(self.left > have, rank[np.minimum(np.arange(n) + have, n - 1)] + 1, 0)
            finer = _dense(rank * (n + 1) + ahead)
            if finer.max() == rank.max():
                break
            rank, have = finer, 2 * have
        return np.argsort(rank * n + np.arange(n))

    def statistics(self, data: np.ndarray, sizes: np.ndarray, groups: np.ndarray, least: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """For each place of each pattern: length of the longest match from there on, and where in the block it stands.

        Patterns are streamed from their ends, all at once: a step takes the next byte of each. Where
        the byte isn't the one before the match, the match moves to the nearer end of the runs of
        that byte above and below, by the bytes they have in common with it. A pattern of which the
        rest can't make a match of ``least`` bytes is left there, with lengths of 0.
        """
        by = np.argsort(-sizes, kind="stable")
        ends, groups, sizes = np.cumsum(sizes)[by], groups[by].astype(np.int64), sizes[by]
        lengths, places = np.zeros(len(data), np.int32), np.full(len(data), -1, np.int64)
        row, have, at = (np.full(len(sizes), x, np.int64) for x in (0, 0, self.start))
        for step in range(int(sizes.max(initial=0))):
            live: slice | np.ndarray = slice(int(np.searchsorted(-sizes, -step)))  # longer than `step`
            if step % 8 == 0 and least:
                live = np.flatnonzero(have[live] + sizes[live] - step >= least)
            row, have, at, sizes, ends, groups = (x[live] for x in (row, have, at, sizes, ends, groups))
            cell = ends - 1 - step
            symbol = groups * 256 + data[cell]
            run = np.searchsorted(self.keys, symbol * self.rows + row, "right") - 1
            known = (run >= 0) & (self.symbols[run] == symbol)
            out = np.flatnonzero(~known | (row >= self.heads[run] + self.lengths[run]))
            if len(out):
                up, down = run[out], np.minimum(run[out] + 1, len(self.keys) - 1)
                above = np.where(known[out], self._common(at[out], self.last[up], have[out]), -1)
                below = np.where((down > up) & (self.symbols[down] == symbol[out]), self._common(at[out], self.first[down], have[out]), -1)
                take = below > above
                have[out] = np.maximum(above, below)
                run[out] = np.where(take, down, up)
                row[out] = np.where(take, self.heads[down], self.heads[up] + self.lengths[up] - 1)
                at[out] = np.where(take, self.first[down], self.last[up])
            row, have, at = self.lands[run] + row - self.heads[run], have + 1, at - 1
            lost = np.flatnonzero(have == 0)  # the group has no such byte
            row[lost], at[lost] = 0, self.start
            lengths[cell], places[cell] = have, at
        return lengths, places

    def _common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at ``a`` and ``b``, as far as ``most``."""
        most = np.minimum(most, np.minimum(self.left[a], self.left[b]))
        same = np.zeros(len(a), np.int64)
        for lo, hi in ((0, 16), (16, int(most.max(initial=0)))):
            rest = np.flatnonzero((same == lo) & (most > lo))
            if len(rest):
                grid = np.arange(lo, hi)
                unlike = self.bytes[np.minimum(a[rest, None] + grid, len(self.bytes) - 1)] != self.bytes[np.minimum(b[rest, None] + grid, len(self.bytes) - 1)]
                same[rest] = np.where(unlike.any(1), lo + unlike.argmax(1), hi)
        return np.minimum(same, most)


def _dense(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key)
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(np.r_[False, key[order][1:] != key[order][:-1]])
    return rank


def _rows(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, pick: np.ndarray) -> np.ndarray:
    """Where the bytes of the picked rows are."""
    n = sizes[pick]
    return np.arange(n.sum()) + np.repeat(starts[pick] - (np.cumsum(n) - n), n)


def earlier(data: np.ndarray, sizes: np.ndarray, groups: np.ndarray, length: int = LENGTH, block: int = BLOCK) -> np.ndarray:
    """Places of texts where ``length`` bytes begin that a text before it in its group holds; ``groups`` ascend.

    Of two texts in a group, look at the highest binary digit in which their ranks differ: the
    earlier one has 0 there. So for each digit, texts with 0 are indexed and texts with 1 streamed,
    and texts with equal higher digits make one family of the index. A group of g texts is read
    log2(g) times; an index holds at most ``block`` texts.
    """
    starts = np.cumsum(sizes) - sizes
    first = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])[: len(groups)]
    rank = np.arange(len(groups)) - np.repeat(first, np.diff(np.r_[first, len(groups)]))
    found = np.zeros(len(data), bool)
    for digit in range(int(rank.max(initial=0)).bit_length()):
        high = rank >> digit + 1
        family = np.cumsum(np.r_[False, (groups[1:] != groups[:-1]) | (high[1:] != high[:-1])])
        side = rank >> digit & 1
        asked = np.flatnonzero(side)
        held = np.flatnonzero((side == 0) & (np.bincount(family[asked], minlength=family[-1] + 1)[family] > 0))
        for at in range(0, len(held), block):
            some = held[at : at + block]
            low, top = family[some[0]], family[some[-1]]
            index = RunLengthIndex(data[_rows(data, starts, sizes, some)], sizes[some], family[some] - low)
            begin, end = np.searchsorted(family[asked], low, "left"), np.searchsorted(family[asked], top, "right")
            for k in range(begin, end, block):
                streamed = asked[k : min(k + block, end)]
                where = _rows(data, starts, sizes, streamed)
                lengths, _ = index.statistics(data[where], sizes[streamed], family[streamed] - low, length)
                found[where[lengths >= length]] = True
    return found


CONTEXT = "anchor bigint, doc bigint, uid bigint, lo int, bytes binary"


def _contexts(texts: DataFrame, look: DataFrame, length: int) -> DataFrame:
    """The bytes of the runs to be looked at."""
    target = arrow_schema(CONTEXT)
    asked = look.groupBy(F.col("uid").alias("u"), F.col("doc").alias("d")).agg(F.collect_list(F.struct("anchor", "lo", "hi")).alias("runs"))
    joined = texts.join(asked, F.expr("doc = d and uid = u")).select("doc", "uid", "bytes", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = [], [], [], [], []
            for doc, uid, text, some in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist(), strict=True):
                data = memoryview(text.as_buffer()).tobytes()
                for r in some:
                    for held, x in zip(out, (r["anchor"], doc, uid, r["lo"], data[r["lo"] : r["hi"]]), strict=True):
                        held.append(x)
                if len(out[0]) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, target, strict=True)], schema=target)
                    out = [], [], [], [], []
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, target, strict=True)], schema=target)

    return joined.mapInArrow(run, CONTEXT)


def _match_runs(contexts: DataFrame, length: int) -> DataFrame:
    """Different runs by anchor -> spans that repeat an earlier one, by the matching statistics of an index."""
    target = arrow_schema("doc bigint, uid bigint, lo int, hi int")

    def spans(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(parts)
        anchor, doc, uid, lo = _numpy(table, "anchor", "doc", "uid", "lo")
        same = np.ones(len(lo), bool)
        same[:1] = False
        for x in (anchor, doc, uid, lo):
            same[1:] &= x[1:] == x[:-1]
        own = np.flatnonzero(~same)  # rows that repeat a document and its text are that document
        table, anchor, doc, uid, lo = table.take(pa.array(own)), anchor[own], doc[own], uid[own], lo[own]
        texts = [x.as_buffer() for x in table.column("bytes")]
        sizes = np.fromiter((len(x) for x in texts), np.int64, len(lo))
        data = np.frombuffer(b"".join(map(memoryview, texts)), np.uint8)
        hit = np.flatnonzero(earlier(data, sizes, anchor, length))
        if len(hit):
            row = np.searchsorted(np.cumsum(sizes), hit, "right")
            where = lo[row] + hit - (np.cumsum(sizes) - sizes)[row]
            new = np.r_[True, (row[1:] != row[:-1]) | (where[1:] != where[:-1] + 1)]
            first, last = np.flatnonzero(new), np.r_[np.flatnonzero(new)[1:] - 1, len(hit) - 1]
            cols = doc[row[first]], uid[row[first]], where[first], where[last] + length
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(f.type.to_pandas_dtype()), f.type) for c, f in zip(cols, target, strict=True)], schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # sorted by anchor: whole anchors at a time, about 20,000 contexts of them
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                if rows >= 20_000:
                    open_anchor = held[-1].column("anchor")[-1].as_py()
                    names = batch.column("anchor").to_numpy()
                    end = at + int(np.searchsorted(names[at:], open_anchor, "right"))
                    if end > at:
                        held.append(batch.slice(at, end - at))
                        rows += end - at
                        at = end
                    if at < batch.num_rows:
                        yield from spans(held)
                        held, rows = [], 0
                    continue
                take = min(20_000 - rows, batch.num_rows - at)
                held.append(batch.slice(at, take))
                rows, at = rows + take, at + take
        if held:
            yield from spans(held)

    return contexts.repartition("anchor").sortWithinPartitions("anchor", "doc", "uid", "lo").mapInArrow(run, "doc bigint, uid bigint, lo int, hi int")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """Texts (``doc, uid, bytes``) and the spans (``doc, uid, lo, hi``) of their bytes that repeat."""
    text = text_of(docs)
    if docs.schema["doc_id"].dataType.simpleString() not in ("bigint", "int", "smallint", "tinyint"):
        raise TypeError("doc_id gives the order of documents, so it has to be an integer")
    doc = F.coalesce(docs["doc_id"].cast("bigint"), F.lit(NULL_ID))  # nulls come first
    # where a doc_id occurs more than once, a hash of the text tells its rows apart
    many = cut(docs.select(doc.alias("m")).groupBy("m").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("m"), "shared_ids")
    texts = docs.select(doc.alias("doc"), text.cast("binary").alias("bytes")).join(many, F.col("doc") == F.col("m"), "left")
    texts = texts.select("doc", F.when(F.col("m").isNull(), F.lit(0)).otherwise(F.xxhash64("bytes")).alias("uid"), "bytes")
    found = _occurrences(texts.where(F.octet_length("bytes") >= length), length)
    spread = cut(_compare_runs(found, length), "compared")
    late = _match_runs(_contexts(texts, spread.where("kind = 0"), length), length)
    return texts, spread.where("kind = 1").select("doc", "uid", "lo", "hi").unionByName(late)


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep_bytes: bool = False) -> DataFrame:
    """Documents -> ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept`` bytes)."""
    texts, spans = repeated_spans(docs, length)
    grouped = spans.groupBy(F.col("doc").alias("d"), F.col("uid").alias("u")).agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    # the same exchange of texts as for the contexts: Spark reuses it
    joined = texts.join(grouped, F.expr("doc = d and uid = u"), "left").select(F.expr(f"nullif(doc, {NULL_ID})").alias("doc_id"), "bytes", "spans")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (", kept binary" if keep_bytes else "")
    target = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                out: list[tuple] = []
                for doc, text, some in zip(part.column(0).to_pylist(), part.column(1), part.column(2).to_pylist(), strict=True):
                    data = memoryview(text.as_buffer()).tobytes()
                    cuts = merged([(s["lo"], s["hi"]) for s in some or ()])
                    ends = [0, *(x for c in cuts for x in c), len(data)]
                    kept = b"".join(data[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))
                    out.append((doc, len(data), len(data) - len(kept), len(cuts), hashlib.sha256(kept).hexdigest(), *([kept] if keep_bytes else [])))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), target, strict=True)], schema=target)

    return joined.mapInArrow(run, schema)
