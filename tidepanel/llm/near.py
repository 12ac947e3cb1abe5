"""Near-duplicate classes by order MinHash, verified by banded alignment.

A text is its words (letters and digits, lower case), its k-mers are ``K`` words in a row,
each labelled with its occurrence number. For each of ``BANDS`` hash functions the two
labelled k-mers with the smallest hashes are taken in text order; two texts meet where
that ordered pair is equal. So a meeting needs common k-mers in common order, which is
what edit similarity asks for. Texts that meet are compared by an alignment of their words
within a band; they are linked if at least ``SIMILARITY`` of the longer one's words stay.

Equal texts are one node from the start. Where texts meet, one of them (the lead) is compared
with all others, then ``LEADS`` of those left, those with most links first, are compared with
all that aren't in their component. The texts of a place that are still apart are dealt into
blocks of about ``BLOCK_TEXTS``, by their number of words in large places, and blocks are
compared with each other: a worker passes on only pairs of two components whose counts of
words allow the similarity, and these are aligned. So every pair that meets is linked,
rejected or in one component; no number of rounds or texts ends it. Components are found by
label propagation with pointer jumping; nothing is collected.

Defined results: null and empty texts are equal texts; texts of fewer than ``K`` words have
one k-mer, all their words; texts without a word are only like equal ones; class_id is the
smallest doc_id of the class (null if all are); repeated rows each give a row; of rows that
share a class's smallest doc_id, the one with the smallest hash of its text represents it; very
long texts are sketched and aligned whole; an empty table gives an empty result; extra columns
take no part.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.llm.common import arrow_rows, cut, fresh_names, row_order, text_of

K = 5
BANDS = 24
SIMILARITY = 0.8
#: Leads of a meeting place in the second round; Spark passes on only so many candidates a partition.
LEADS = 16
#: Texts of a block, on average at most.
BLOCK_TEXTS = 256
#: Counters of a text's words, to reject pairs early; in blocks, where a text's counters serve many pairs, there are more.
BAG = 64
WIDE = 1024
#: Different words whose hashes a worker remembers.
MEMO = 400_000
#: Ids of texts, of 16 bytes, that are broadcast to pick texts before they are shuffled; more ids are joined by a shuffle.
FEW_IDS = 1_000_000
#: Cells over which the members of a class are dealt.
SALTS = 64
#: Words in a block of the alignment's bit table.
BLOCK = 2048
#: Words of texts that a worker keeps split, besides those of the pair at hand.
HELD = 100_000
WORDS = re.compile(r"[^\W_]+")
_MIX = np.random.default_rng(20240229).integers(1, 2**32, 64, np.uint32) | np.uint32(1)


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        import xxhash

        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


_memo = WordHashes()


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def kmers(words: list[str], k: int = K) -> np.ndarray:
    """64-bit hashes of the k-mers, in text order."""
    if len(_memo) > MEMO:
        _memo.clear()
    h = np.fromiter(map(_memo.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(min(k, len(h))):
        out = out * np.uint64(0x100000001B3) + h[j : j + n]
    return _mixed(out)


def sketch(words: list[str], k: int = K, bands: int = BANDS) -> np.ndarray:
    """One number per hash function: the two smallest labelled k-mers, in text order."""
    grams = kmers(words, k)
    labelled = grams
    order = np.argsort(grams)
    ranked = grams[order]
    same = ranked[1:] == ranked[:-1]
    if same.any():  # occurrence numbers follow the text
        order = np.argsort(grams, kind="stable")
        at = np.arange(len(grams))
        nth = np.empty(len(grams), np.int64)
        nth[order] = at - np.maximum.accumulate(np.where(np.r_[False, same], 0, at))
        labelled = _mixed(grams + nth.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    short = (labelled >> np.uint64(32)).astype(np.uint32)
    first, second = np.empty(bands, np.int64), np.empty(bands, np.int64)
    values = np.empty_like(short)
    for j in range(bands):
        np.multiply(short, _MIX[j], out=values)
        first[j] = second[j] = a = values.argmin()
        if len(values) > 1:
            values[a] = 0xFFFFFFFF
            second[j] = values.argmin()
    early, late = grams[np.minimum(first, second)], grams[np.maximum(first, second)]
    return _mixed((early * np.uint64(3) ^ late) + _MIX[:bands].astype(np.uint64))


def banded_distance(a: list, b: list, limit: int) -> int:
    """Edit distance of two sequences, or ``limit + 1`` if it is larger.

    Bit-parallel over the diagonals within the limit: a machine word of 2 t + 1 bits slides
    along them, for t = 16, 64, 256, ... until the distance fits into t.
    """
    start, end = 0, 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > limit:
        return limit + 1
    if not a:
        return len(b)
    if limit < 1 or max(len(a), len(b)) - sum((Counter(a) & Counter(b)).values()) > limit:
        return limit + 1
    places = _places(a)
    t = max(16, len(b) - len(a))
    while True:
        t = min(t, limit)
        found = _whole(places, len(a), b) if t >= len(a) else _band(places, len(a), b, t)
        if found <= t or t >= limit or t >= len(a):
            return found if found <= limit else limit + 1
        t *= 4


def _places(a: list) -> list[dict]:
    """Bits of each word's places, in blocks, so that memory grows with the text and not with its square."""
    blocks: list[dict] = []
    for start in range(0, len(a), BLOCK):
        found: dict = {}
        for i, x in enumerate(a[start : start + BLOCK]):
            found[x] = found.get(x, 0) | 1 << i
        blocks.append(found)
    return blocks


def _bits(places: list[dict], x, first: int, end: int) -> int:
    """Places of ``x`` from ``first`` on, at least those before ``end``; bit 0 is ``first``."""
    out = 0
    for k in range(max(first, 0) // BLOCK, min((end - 1) // BLOCK + 1, len(places))):
        if found := places[k].get(x):
            shift = k * BLOCK - first
            out |= found << shift if shift >= 0 else found >> -shift
    return out


def _whole(places: list[dict], n: int, b: list) -> int:
    full, top, plus, minus, score = (1 << n) - 1, 1 << (n - 1), (1 << n) - 1, 0, n
    for x in b:
        eq = _bits(places, x, 0, n)
        d0 = (((eq & plus) + plus) ^ plus) | eq | minus
        hp = minus | ~(d0 | plus) & full
        hn = d0 & plus
        score += bool(hp & top) - bool(hn & top)
        hp, hn = (hp << 1 | 1) & full, hn << 1 & full
        plus, minus = hn | ~(d0 | hp) & full, hp & d0
    return score


def _band(places: list[dict], n: int, b: list, t: int) -> int:
    """Distance if at most ``t``, else something above ``t``; n <= len(b) <= n + t, t < n."""
    width = 2 * t + 1
    full, diagonal, across = (1 << width) - 1, 1 << (width - 1), 1 << (width - 2)
    plus, minus, score, first = full >> t << t, 0, t, -t
    most = 2 * t + len(b) - n
    for j, x in enumerate(b):
        eq = _bits(places, x, first, first + width) & full
        d0 = ((((eq & plus) + plus) & full) ^ plus) | eq | minus
        hp = minus | ~(d0 | plus) & full
        hn = d0 & plus
        if j < n - t:
            score += not d0 & diagonal
            if score > most:
                return t + 1
        else:
            score += bool(hp & across) - bool(hn & across)
            across >>= 1
        plus, minus = hn | ~((d0 >> 1) | hp) & full, (d0 >> 1) & hp
        first += 1
    return score


def similarity(a: list[str], b: list[str], least: float = SIMILARITY) -> float:
    """Share of the longer text's words that an alignment keeps; 0 if below ``least``."""
    longest = max(len(a), len(b))
    if not longest:
        return 0.0
    limit = int((1 - least) * longest + 1e-9)
    found = banded_distance(a, b, limit)
    return 0.0 if found > limit else 1 - found / longest


def _verify(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """``node, lead`` -> the same with ``sim``."""
    one = pairs.join(texts.select(F.col("tid").alias("node"), F.col("t").alias("a")), "node")
    both = one.join(texts.select(F.col("tid").alias("lead"), F.col("t").alias("b")), "lead").select("node", "lead", "a", "b")

    def step(cols: dict[str, list]) -> dict[str, list]:
        held: dict[str, list[str]] = {}
        count = 0

        def words(text: str) -> list[str]:
            nonlocal count
            if text not in held:
                if count > HELD:
                    held.clear()
                    count = 0
                held[text] = words_of(text)
                count += len(held[text])
            return held[text]

        return {"node": cols["node"], "lead": cols["lead"], "sim": [similarity(words(x), words(y), least) for x, y in zip(cols["a"], cols["b"], strict=True)]}

    return arrow_rows(both, step, "node binary, lead binary, sim double")


def bag(words: list[str], size: int = BAG, kind: str = "<u2") -> bytes:
    """Numbers of the words in ``size`` classes; a counter stops at its largest value."""
    if len(_memo) > MEMO:
        _memo.clear()
    h = np.fromiter(map(_memo.__getitem__, words), np.uint64, len(words))
    return np.bincount((h % np.uint64(size)).astype(np.int64), minlength=size).clip(max=np.iinfo(kind).max).astype(kind).tobytes()


def _uncounted(bags: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Words beyond what stopped counters hold."""
    return n - bags.sum(1, dtype=np.int64)


def _may_be_alike(a: np.ndarray, b: np.ndarray, more: np.ndarray, longest: np.ndarray, least: float) -> np.ndarray:
    """Whether counts of words allow the similarity: each edit changes the common count by at most one."""
    common = np.minimum(a, b).sum(1, dtype=np.int64) + more
    return longest - common <= ((1 - least) * longest + 1e-9).astype(np.int64)


def _sizes_allow(a: Column, b: Column, least: float) -> Column:
    """Whether two numbers of words allow the similarity."""
    return F.greatest(a, b) - F.least(a, b) <= F.floor((1 - least) * F.greatest(a, b) + 1e-9)


def _block_pairs(place: int, left: list[dict], right: list[dict] | None, least: float) -> Iterator[tuple[bytes, bytes]]:
    """Pairs of two blocks, or within one, of different components and possibly alike.

    Texts that meet at several places are a pair at the one with the smallest number only.
    """
    rows = left if right is None else left + right
    bags = np.frombuffer(b"".join(x["bag"] for x in rows), np.uint8).reshape(-1, WIDE)
    n = np.array([x["n"] for x in rows], np.int64)
    more = _uncounted(bags, n)
    numbers: dict[bytes, int] = {}
    comp = np.array([numbers.setdefault(x["comp"], len(numbers)) for x in rows], np.int64)
    for i in range(len(left)):
        start = i + 1 if right is None else len(left)
        longest = np.maximum(n[start:], n[i])
        near = longest - np.minimum(n[start:], n[i]) <= ((1 - least) * longest + 1e-9).astype(np.int64)
        at = start + np.flatnonzero(near & (comp[start:] != comp[i]))
        own = set(left[i]["places"])
        for j in at[_may_be_alike(bags[i], bags[at], np.minimum(more[i], more[at]), longest[at - start], least)]:
            if next(x for x in rows[j]["places"] if x in own) == place:
                yield rows[i]["node"], rows[j]["node"]


def _pairs_in_blocks(rest: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """``b, node, comp`` -> ``node, lead``: pairs that meet, are of two components and possibly alike.

    In a place of more than a block's texts, those whose numbers of words differ by more than
    one class can't be alike; classes are dealt into blocks by a hash of the text.
    """
    width = math.log(1.001 / max(least, 1e-6))  # a little wider than the widest ratio, so rounding loses nothing

    def count(cols: dict[str, list]) -> dict[str, list]:
        found = [words_of(t) for t in cols["t"]]
        return {"w": cols["tid"], "n": [len(w) for w in found], "bag": [bag(w, WIDE, "u1") for w in found], "class": [int(math.log(len(w)) / width) for w in found], "places": cols["places"]}

    at = rest.groupBy(F.col("node").alias("r")).agg(F.array_sort(F.collect_set("b")).alias("places"))  # as many as bands at most
    own = texts.join(at, F.col("tid") == F.col("r")).select("tid", "t", "places")
    of = arrow_rows(own, count, "w binary, n int, bag binary, class int, places array<bigint>")
    sized = cut(rest.select("b", "node", "comp").join(of, F.col("node") == F.col("w")).drop("w"), "sized")
    counts = sized.groupBy(F.col("b").alias("p"), F.col("class").alias("q")).agg(F.count(F.lit(1)).alias("n_q"))
    counts = counts.withColumn("n_p", F.sum("n_q").over(Window.partitionBy("p")))
    small = F.col("n_p") <= BLOCK_TEXTS
    cells = cut(counts.select("p", "q", F.when(small, -2).otherwise(F.col("q")).alias("cell"), F.when(small, 1).otherwise(F.ceil(F.col("n_q") / BLOCK_TEXTS)).cast("int").alias("parts")), "cells")
    dealt = sized.join(cells, F.expr("b = p and class = q")).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    blocks = cut(dealt.groupBy("b", "cell", "part").agg(F.collect_list(F.struct("node", "comp", "n", "bag", "places")).alias("texts")), "blocks")

    def within(cols: dict[str, list]) -> dict[str, list]:
        found = [pair for b, texts in zip(cols["b"], cols["texts"], strict=True) for pair in _block_pairs(b, texts, None, least)]
        return {"node": [max(x) for x in found], "lead": [min(x) for x in found]}

    def across(cols: dict[str, list]) -> dict[str, list]:
        found = [pair for b, x, y in zip(cols["p"], cols["x"], cols["y"], strict=True) for pair in _block_pairs(b, x, y, least)]
        return {"node": [max(x) for x in found], "lead": [min(x) for x in found]}

    large = cells.where("cell > -2").select("p", F.col("cell").alias("c1"), F.col("parts").alias("m1"))
    other = large.select(F.col("p").alias("p2"), F.col("c1").alias("c2"), F.col("m1").alias("m2"))
    two = large.join(other, F.expr("p = p2 and (c2 = c1 or c2 = c1 + 1)"))
    two = two.select("p", "c1", "c2", F.explode(F.sequence(F.lit(0), F.col("m1") - 1)).alias("i"), "m2")
    two = two.select("p", "c1", "c2", "i", F.explode(F.sequence(F.lit(0), F.col("m2") - 1)).alias("j")).where("c1 < c2 or i < j")
    one = two.join(blocks.select("b", "cell", "part", F.col("texts").alias("x")), F.expr("p = b and c1 = cell and i = part")).select("p", "c2", "j", "x")
    both = one.join(blocks.select("b", "cell", "part", F.col("texts").alias("y")), F.expr("p = b and c2 = cell and j = part")).select("p", "x", "y")
    kind = "node binary, lead binary"
    return arrow_rows(blocks.select("b", "texts"), within, kind).unionByName(arrow_rows(both, across, kind))


def _possible(pairs: DataFrame, bags: DataFrame, least: float) -> DataFrame:
    """``node, lead`` without those whose counts of words rule the similarity out."""
    one = pairs.join(bags.select(F.col("tid").alias("node"), F.col("n").alias("na"), F.col("bag").alias("a")), "node")
    both = one.join(bags.select(F.col("tid").alias("lead"), F.col("n").alias("nb"), F.col("bag").alias("b")), "lead").select("node", "lead", "na", "nb", "a", "b")

    def step(cols: dict[str, list]) -> dict[str, list]:
        a, b = (np.frombuffer(b"".join(cols[x]), "<u2").reshape(-1, BAG) for x in "ab")
        na, nb = np.array(cols["na"], np.int64), np.array(cols["nb"], np.int64)
        keep = _may_be_alike(a, b, np.minimum(_uncounted(a, na), _uncounted(b, nb)), np.maximum(na, nb), least)
        return {x: [v for v, kept in zip(cols[x], keep, strict=True) if kept] for x in ("node", "lead")}

    return arrow_rows(both, step, "node binary, lead binary")


def _relabelled(label: DataFrame, new: DataFrame) -> DataFrame:
    """``node, comp`` after the links ``node, lead``."""
    at = label.withColumnsRenamed({"node": "n", "comp": "c"})
    half = new.join(at, F.col("node") == F.col("n")).select("lead", F.col("c").alias("x"))
    ends = cut(half.join(at, F.col("lead") == F.col("n")).select(F.col("x").alias("node"), F.col("c").alias("lead")).where("node != lead").distinct(), "ends")
    moved = components(ends).withColumnsRenamed({"node": "n", "comp": "c"})
    return cut(label.join(moved, F.col("comp") == F.col("n"), "left").select("node", F.coalesce("c", "comp").alias("comp")), "labels")


def text_id(text: Column) -> Column:
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def linked(docs: DataFrame, least: float = SIMILARITY, k: int = K, bands: int = BANDS) -> tuple[DataFrame, DataFrame]:
    """``doc_id, tid`` for every row, and ``node, comp`` for the texts that meet others."""
    rows = docs.select(docs["doc_id"].alias("doc_id"), text_of(docs).alias("t")).withColumn("tid", text_id(F.col("t")))

    def step(cols: dict[str, list]) -> dict[str, list]:
        found = [words_of(t) for t in cols["t"]]
        keys = [sketch(w, k, bands).view(np.int64) if w else [] for w in found]
        return {"doc_id": cols["doc_id"], "tid": cols["tid"], "keys": keys, "n": [len(w) for w in found], "bag": [bag(w) for w in found]}

    kind = docs.schema["doc_id"].dataType.simpleString()
    sketched = cut(arrow_rows(rows, step, f"doc_id {kind}, tid binary, keys array<bigint>, n int, bag binary"), "sketches")
    each = sketched.groupBy(F.col("tid").alias("node")).agg(*[F.first(c).alias(c) for c in ("keys", "n", "bag")])
    each = cut(each, "each")
    # one exchange serves the smallest text of each place and all that meet it
    keyed = each.select("node", "n", F.posexplode("keys").alias("pos", "key")).select(F.xxhash64("pos", "key").alias("b"), "node", "n").repartition("b")
    places = keyed.groupBy(F.col("b").alias("p")).agg(F.min(F.struct("node", "n")).alias("first"), F.max("node").alias("last")).where("first.node != last")
    met = keyed.join(places, F.col("b") == F.col("p"))
    meets = cut(met.select("b", "node", "n", F.col("first.node").alias("first"), F.col("first.n").alias("n_first")), "meets")
    wanted = cut(meets.select(F.col("node").alias("w")).distinct(), "wanted")
    picked = F.broadcast(wanted) if wanted.count() <= FEW_IDS else wanted
    texts = cut(rows.join(picked, F.col("tid") == F.col("w"), "left_semi").groupBy("tid").agg(F.first("t").alias("t")), "texts")
    bags = cut(each.select(F.col("node").alias("tid"), "n", "bag").join(picked, F.col("tid") == F.col("w"), "left_semi"), "bags")
    label = wanted.select(F.col("w").alias("node"), F.col("w").alias("comp"))
    rest = meets.where("node != first")
    # each place's smallest text against the others
    pairs = rest.where(_sizes_allow(F.col("n"), F.col("n_first"), least)).select("node", F.col("first").alias("lead")).distinct()
    seen = cut(_verify(_possible(pairs, bags, least), texts, least), "verified")
    label = _relabelled(label, seen.where("sim > 0").select("node", "lead"))
    held = _apart(rest, label)
    if held.isEmpty():
        return sketched.select("doc_id", "tid"), label
    # those with most links against the ones of other components
    ends = seen.where("sim > 0").select(F.explode(F.array("node", "lead")).alias("e")).groupBy("e").agg(F.count(F.lit(1)).alias("degree"))
    linked_most = held.join(ends, F.col("node") == F.col("e"), "left").select("b", "node", "n", "comp", F.coalesce("degree", F.lit(0)).alias("degree"))
    ranked = linked_most.withColumn("nth", F.row_number().over(Window.partitionBy("b").orderBy(F.desc("degree"), "node")))
    leads = cut(ranked.where(F.col("nth") <= LEADS).select(F.col("b").alias("p"), F.col("node").alias("l"), F.col("comp").alias("c"), F.col("n").alias("m")), "leads")
    pairs = held.join(leads, F.expr("b = p")).where((F.col("comp") != F.col("c")) & _sizes_allow(F.col("n"), F.col("m"), least))
    pairs = pairs.select(F.greatest("node", "l").alias("node"), F.least("node", "l").alias("lead")).distinct()
    new = cut(_verify(_possible(pairs.join(seen.select("node", "lead"), ["node", "lead"], "left_anti"), bags, least), texts, least), "verified")
    label = _relabelled(label, new.where("sim > 0").select("node", "lead"))
    held = _apart(held.join(leads, F.expr("b = p and node = l"), "left_anti"), label)
    if not held.isEmpty():
        # all that is still apart, in blocks
        seen = seen.unionByName(new)
        pairs = cut(_pairs_in_blocks(held, texts, least).join(seen.select("node", "lead"), ["node", "lead"], "left_anti"), "pairs")
        new = cut(_verify(pairs, texts, least), "verified")
        label = _relabelled(label, new.where("sim > 0").select("node", "lead"))
    return sketched.select("doc_id", "tid"), label


def _apart(meets: DataFrame, label: DataFrame) -> DataFrame:
    """``b, node, n, comp`` of the places whose texts are of more than one component."""
    at = label.withColumnRenamed("node", "a")
    held = cut(meets.select("b", "node", "n").join(at, F.col("node") == F.col("a")).select("b", "node", "n", "comp"), "at")
    mixed = held.groupBy(F.col("b").alias("p")).agg(F.min("comp").alias("first"), F.max("comp").alias("last")).where("first != last").select("p")
    return cut(held.join(mixed, F.col("b") == F.col("p"), "left_semi"), "held")


def components(edges: DataFrame) -> DataFrame:
    """``node, lead`` -> ``node, comp``: the smallest node of each connected component."""
    both = cut(edges.select(F.col("node").alias("a"), F.col("lead").alias("b")).unionByName(edges.select(F.col("lead").alias("a"), F.col("node").alias("b"))).distinct(), "both")
    label = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("comp")), "labels")
    while True:
        far = both.join(label.withColumnRenamed("node", "n"), F.col("b") == F.col("n")).groupBy("a").agg(F.min("comp").alias("m"))
        near = label.join(far, F.col("node") == F.col("a")).select("node", F.col("comp").alias("old"), F.least("comp", "m").alias("comp"))
        near = cut(near, "near")
        jump = near.select(F.col("node").alias("n"), F.col("comp").alias("c"))
        new = cut(near.join(jump, F.col("comp") == F.col("n"), "left").select("node", "old", F.least("comp", F.coalesce("c", "comp")).alias("comp")), "labels")
        if new.where("comp != old").isEmpty():
            return new.select("node", "comp")
        label = new.select("node", "comp")


def _members(docs: DataFrame, least: float = SIMILARITY, **options) -> DataFrame:
    """Documents -> ``doc_id, tid, class_id, class_size, representative``; equal rows of a representative are numbered, one is it."""
    members, comps = linked(docs, least, **options)
    comps = comps.withColumnRenamed("node", "n")
    spread = members.join(comps, F.col("tid") == F.col("n"), "left").select("doc_id", "tid", F.coalesce("comp", "tid").alias("comp"))
    spread = cut(spread.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))), "members")
    # a large class is dealt over cells; its totals are taken over them
    cells = spread.groupBy(F.col("comp").alias("c"), F.col("salt").alias("s")).agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("c")
    sizes = cells.select("c", "s", F.min("least").over(whole).alias("class_id"), F.sum("n").over(whole).alias("class_size")).where("class_size > 1")
    # of rows that share the smallest doc_id of a class, the one with the smallest hash of its text
    ordered = spread.withColumn("nth", F.row_number().over(Window.partitionBy("doc_id", "comp").orderBy("tid")))
    out = ordered.join(sizes, F.expr("comp = c and salt = s"), "left")
    alone = F.col("class_size").isNull()
    return out.select(
        "doc_id",
        "tid",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("bigint").alias("class_size"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("nth") == 1))).alias("representative"),
    )


def near_classes(docs: DataFrame, least: float = SIMILARITY, **options) -> DataFrame:
    """Documents -> ``doc_id, class_id, class_size, representative``, one row per document."""
    return _members(docs, least, **options).drop("tid")


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """One document of each class, the one with the smallest doc_id, with all columns; rows are told by doc_id and text."""
    names = docs.columns
    id_, tid, gone, nth = fresh_names(docs, 4)
    lost = _members(docs, **options).where("not representative").groupBy(F.col("doc_id").alias(id_), F.col("tid").alias(tid)).agg(F.count(F.lit(1)).alias(gone))
    own = text_id(text_of(docs))
    marked = docs.withColumn(nth, F.row_number().over(Window.partitionBy(docs["doc_id"], own).orderBy(row_order(docs))))
    joined = marked.join(lost, marked["doc_id"].eqNullSafe(F.col(id_)) & (text_id(text_of(marked)) == F.col(tid)), "left")
    return joined.where(F.coalesce(F.col(gone), F.lit(0)) < F.col(nth)).select(*[F.col(f"`{n}`") for n in names])
