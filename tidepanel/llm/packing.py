"""Best-two-fit packing of tokenised documents into sequences of bounded length.

Documents longer than a sequence are cut into full pieces and a rest; nothing else is cut.
Where a piece goes depends on its length alone, so packing runs on the histogram of
lengths (as many counters as a sequence has tokens, whatever the corpus): a bin is filled
greedily with the longest length that still fits; then its smallest piece s is given back
if two unpacked pieces a + b > s fit into gap + s, and the two that fill it most tightly
take its place. A bin is repeated as often as the counters allow, so there are about as
many different bins as lengths. Every piece then looks up its place by its rank among
the pieces of its length; the rank is the row number within a (length, salt) cell plus the
cell's offset, so a length that many pieces share is dealt over many tasks.

Defined results: a null or empty text is one piece that holds id 0 alone; repeated rows
are packed one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from functools import cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.llm.common import arrow_rows, cut

SEQUENCE = 2048
TOKENIZER = "word_bpe_49k.json"
#: Pieces that share a (length, salt) cell, on average, if all had one length.
CELL = 20_000
#: Different words whose ids a worker remembers, and the length from which it forgets them.
MEMO = 300_000
LONG = 64
SIGNS = "*#$%&!.,;:?|"


class WordIds(dict):
    """Ids (little-endian bytes) of stretches without white space.

    The tokenizer drops white space and no token or normalisation crosses it, so a
    text's ids are those of its stretches, one after the other. Stretches that are new
    in some texts and made of letters, then signs, are learnt together.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        made = json.loads(self.tokenizer.to_str())
        steps = json.dumps([made["normalizer"], made["pre_tokenizer"]])
        if made["model"]["type"] != "BPE" or made["model"].get("end_of_word_suffix") != "</w>" or '"Lowercase"' not in steps or "\\\\s" not in steps:
            raise ValueError(f"{path}: words are learnt apart, which needs a tokenizer that lower-cases and splits at white space")
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)  # tokens that end a run of letters or signs
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")

    def __missing__(self, word: str) -> bytes:
        ids = self._encode(word)
        if len(word) < LONG:
            self[word] = ids
        return ids

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, fresh: set[str]) -> None:
        """Letters and signs are apart for the tokenizer."""
        signed = [word for word in fresh if not word.isalpha() and len(word) < LONG]
        stems = [word.rstrip(SIGNS) for word in signed]
        new = {word for word in fresh if word.isalpha()}.union(stems).difference(self)
        new = {word for word in new if len(word) < LONG and (word.isalpha() if word.isascii() else unicodedata.normalize("NFC", word).lower().isalpha())}  # no marks appear in it
        words = list(new)
        for at in range(0, len(words), 2000):
            some = words[at : at + 2000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(some):  # a word has one end at least, so each has one
                raw, ends = ids.tobytes(), (4 * ends).tolist()
                self.update(zip(some, (raw[x:y] for x, y in zip([0, *ends], ends, strict=False)), strict=True))
        for word, stem in zip(signed, stems, strict=True):
            if stem != word and stem in self:
                self[word] = self[stem] + self[word[len(stem) :]]

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self) > MEMO:
            self.clear()
        self[""] = b""
        # capitals are small letters for the tokenizer
        parts = [(text.lower() if text.isascii() else text).replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for text in texts]
        self._learn(set().union(*parts).difference(self))
        return [b"".join(map(self.__getitem__, part)) for part in parts]


@cache
def _words(path: str) -> WordIds:
    return WordIds(path)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(docs: DataFrame, path: str | None = None, sequence: int = SEQUENCE) -> DataFrame:
    """Documents -> ``doc_id, piece, start, length, ids_crc32``."""

    def step(rows: dict[str, list]) -> dict[str, list]:
        texts = _words(path or tokenizer_path()).encode([text or "" for text in rows["text"]])
        out: dict[str, list] = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
        for doc, ids in zip(rows["doc_id"], texts, strict=True):
            ids += b"\0\0\0\0"
            for k, at in enumerate(range(0, len(ids), 4 * sequence)):
                part = ids[at : at + 4 * sequence]
                for name, x in zip(out, (doc, k, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                    out[name].append(x)
        return out

    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return arrow_rows(texts, step, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_two_fit(counts: np.ndarray) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """Counters by length (index 0 unused) -> bins: (first sequence, how many alike, [(length, times), ...])."""
    capacity, counts = len(counts) - 1, counts.copy()
    bins, made = [], 0
    while True:
        live = np.flatnonzero(counts)
        if not len(live):
            return bins
        left, gap, held = counts, capacity, []
        use = np.zeros(capacity + 1, np.int64)
        while gap > 0:
            k = np.searchsorted(live, gap, "right") - 1
            while k >= 0 and left[live[k]] <= use[live[k]]:
                k -= 1
            if k < 0:
                break
            size = int(live[k])
            times = int(min(left[size] - use[size], gap // size))
            use[size] += times
            gap -= times * size
            held.append(size)
        if gap > 0 and len(held) + use[held[-1]] > 2:
            small = held[-1]
            room = gap + small
            # all unpacked lengths up to room; for each the longest partner that still fits
            free = counts - use
            a = live[(live < room) & (free[live] > 0)]
            b = np.array([_partner(live, free, int(room - x), int(x)) for x in a], np.int64)
            both = np.where(b > 0, a + b, 0)
            if len(both) and both.max() > small:
                best = int(both.argmax())
                use[small] -= 1
                use[a[best]] += 1
                use[b[best]] += 1
        used = np.flatnonzero(use)
        times = int((counts[used] // use[used]).min())
        counts[used] -= times * use[used]
        bins.append((made, times, [(int(x), int(use[x])) for x in used[::-1]]))
        made += times


def _partner(live: np.ndarray, free: np.ndarray, room: int, other: int) -> int:
    k = int(np.searchsorted(live, room, "right")) - 1
    while k >= 0 and free[live[k]] <= (1 if live[k] == other else 0):
        k -= 1
    return int(live[k]) if k >= 0 else 0


class Places:
    """Place of the r-th piece of each length."""

    def __init__(self, bins: list[tuple[int, int, list[tuple[int, int]]]]) -> None:
        self.slots: dict[int, list[tuple[int, int, int, int]]] = {}
        self.starts: dict[int, np.ndarray] = {}
        ranks: dict[int, int] = {}
        begins: dict[int, list[int]] = {}
        for first, times, held in bins:
            offset = 0
            for size, use in held:
                begins.setdefault(size, []).append(ranks.get(size, 0))
                self.slots.setdefault(size, []).append((ranks.get(size, 0), first, use, offset))
                ranks[size] = ranks.get(size, 0) + times * use
                offset += size * use
        self.starts = {size: np.array(x) for size, x in begins.items()}

    def of(self, size: int, rank: int) -> tuple[int, int]:
        start, first, use, offset = self.slots[size][int(np.searchsorted(self.starts[size], rank, "right")) - 1]
        return first + (rank - start) // use, offset + (rank - start) % use * size


def pack(cuts: DataFrame, sequence: int = SEQUENCE, cell: int = CELL) -> DataFrame:
    """Pieces (with ``length``) -> the same with ``sequence_id, offset``."""
    cuts = cut(cuts, "pieces")
    spark = cuts.sparkSession
    rows = cuts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most `sequence` rows
    counts = np.zeros(sequence + 1, np.int64)
    for size, n in rows:
        counts[size] = n
    places = spark.sparkContext.broadcast(Places(best_two_fit(counts)))  # grows with the lengths, not with the corpus
    salts = int(max(counts.sum() // cell, 31)) + 1
    salted = cuts.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    cells = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    offsets = cells.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    nth = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = salted.withColumn("nth", nth).join(cut(offsets, "offsets"), ["length", "salt"]).withColumn("rank", F.col("before") + F.col("nth") - 1).drop("salt", "nth", "before")
    names = cuts.columns

    def step(cols: dict[str, list]) -> dict[str, list]:
        found = [places.value.of(size, rank) for size, rank in zip(cols["length"], cols["rank"], strict=True)]
        return {n: cols[n] for n in names} | {"sequence_id": [x for x, _ in found], "offset": [x for _, x in found]}

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cuts.schema) + ", sequence_id bigint, offset bigint"
    return arrow_rows(ranked.select(*names, "rank"), step, schema)


def pack_documents(docs: DataFrame, path: str | None = None, sequence: int = SEQUENCE) -> DataFrame:
    """Tokenise whole documents and pack them: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    return pack(pieces(docs, path, sequence), sequence)
