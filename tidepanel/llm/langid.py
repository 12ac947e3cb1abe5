"""Language identification with labelled spans.

Learning: for every language the counts of its words' n-grams (one to four characters,
with word ends, hashed) become log probabilities; of every script (Unicode range) the
languages that write it are noted. Labelling: a word's script narrows its candidates;
its score for a language is the mean log probability of its n-grams times a weight that
grows with their number; the Viterbi path over the words, with a penalty for each switch
of language, labels the spans. A text's language is the one with the most letters in it.

The best constant path is the Viterbi path whenever no stretch of words gains more than
the penalty in any other language (a maximal-subarray bound, so exact); only other texts
need the recursion.

Learning takes at most about ``SAMPLE`` documents of every language (chosen by hash of the
id) from those not held out; every text is labelled whole.

Defined results: a text that is null or has no letter (numerals are none) is ``und`` with score
0; documents of null language teach nothing; without any to learn from, every text is ``und``;
of languages with equal scores the first by name is taken; very long texts are labelled whole;
repeated rows each teach and give a row; an empty table gives an empty result; extra columns
take no part.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import groupby

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import arrow_rows

#: Documents of one language that learning takes, about.
SAMPLE = 400
BITS = 16
#: Log units that a change of language costs.
PENALTY = 16.0
#: Different words whose scores a worker remembers.
MEMO = 500_000
#: Unicode ranges of scripts, by their first and last code points.
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF)), "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)), "cyrillic": ((0x400, 0x52F),),
    "armenian": ((0x530, 0x58F),), "hebrew": ((0x590, 0x5FF),), "arabic": ((0x600, 0x6FF), (0x750, 0x77F)), "devanagari": ((0x900, 0x97F),),
    "bengali": ((0x980, 0x9FF),), "tamil": ((0xB80, 0xBFF),), "thai": ((0xE00, 0xE7F),), "georgian": ((0x10A0, 0x10FF),),
    "kana": ((0x3040, 0x30FF),), "han": ((0x3400, 0x9FFF),), "hangul": ((0xAC00, 0xD7AF), (0x1100, 0x11FF)),
}
LETTERS = re.compile(r"[^\W\d_]+")
#: Share of a language's words that a script needs to count as one it is written in.
MIN_SCRIPT = 0.01


def words_in(text: str) -> list[tuple[int, str]]:
    """Start and letters of each word; numerals that aren't digits (fractions, circled numbers) are no letters."""
    out = []
    for m in LETTERS.finditer(text):
        word = m.group()
        if word.isalpha():
            out.append((m.start(), word))
        else:
            at = m.start()
            for letters, run in groupby(word, key=str.isalpha):
                part = "".join(run)
                if letters:
                    out.append((at, part))
                at += len(part)
    return out


def letters_of(text: str) -> list[str]:
    """The words alone."""
    found = LETTERS.findall(text)
    return found if "".join(found).isalpha() or not found else [w for _, w in words_in(text)]


def script_of(word: str) -> str:
    """The script of a word's first letter; ``other`` outside the ranges."""
    code = ord(word[0])
    return next((name for name, ranges in SCRIPTS.items() if any(a <= code <= b for a, b in ranges)), "other")


def ngrams(words: list[str], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all words, and for each the number of its word."""
    joined = "".join(f"\x02{w}\x03" for w in words)
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), sizes)
    found, owners, code = [], [], np.zeros(len(codes), np.uint32)
    for n in range(1, 5):
        if len(codes) < n:
            break
        code = code[: len(codes) - n + 1] * np.uint32(0x01000193) + codes[n - 1 :]
        whole = owner[: len(codes) - n + 1] == owner[n - 1 :]
        if n == 1:
            whole = whole & (codes > 3)
        found.append(((code[whole] ^ np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(32 - bits))
        owners.append(owner[: len(codes) - n + 1][whole])
    return np.concatenate(found), np.concatenate(owners)


class Model:
    """Languages, log probabilities by n-gram, and the languages that each script allows."""

    def __init__(self, langs: list[str], counts: np.ndarray, scripts: dict[str, set[str]], penalty: float = PENALTY) -> None:
        self.langs, self.penalty = langs, penalty
        smooth = counts + 0.5
        self.logs = np.log(smooth / smooth.sum(0)).astype(np.float32)
        if langs:
            self.logs -= self.logs.mean(1, keepdims=True)  # only differences between languages count
        self.allowed = {s: np.array([x in found for x in langs]) for s, found in scripts.items()}
        self.narrows = not all(ok.all() for ok in self.allowed.values())
        self.memo: dict[str, int] = {}
        self.table = np.zeros((1024, len(langs)), np.float32)

    def word_scores(self, words: list[str]) -> np.ndarray:
        if len(self.memo) + len(words) > MEMO:
            self.memo.clear()
        if new := list({w for w in words if w not in self.memo}):
            grams, owner = ngrams(new)
            n = np.bincount(owner, minlength=len(new)).astype(np.float32)
            sums = np.stack([np.bincount(owner, self.logs[grams, k], len(new)) for k in range(len(self.langs))], 1) / np.sqrt(n)[:, None]
            for i, w in enumerate(new) if self.narrows else ():
                # a script that some languages write leaves only those
                if (ok := self.allowed.get(script_of(w))) is not None and not ok.all() and ok.any():
                    sums[i, ~ok] = sums[i, ok].min() - 2 * self.penalty
            base = len(self.memo)
            while base + len(new) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[base : base + len(new)] = sums
            self.memo.update(zip(new, range(base, base + len(new)), strict=True))
        return self.table[np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))]

    def constant(self, scores: np.ndarray) -> int | None:
        """The language of the Viterbi path, if that is constant for certain."""
        best = int(scores.sum(0, dtype=np.float64).argmax())
        for k in range(scores.shape[1]):
            if k != best:
                sums = np.cumsum(scores[:, k] - scores[:, best], dtype=np.float64)
                lows = np.minimum.accumulate(sums)
                if max(sums[0], (sums[1:] - np.minimum(lows[:-1], 0)).max(initial=0)) > self.penalty:
                    return None
        return best

    def path(self, scores: np.ndarray) -> np.ndarray:
        """The Viterbi path: a language number per word; ties go to staying, then to the first language."""
        if (best := self.constant(scores)) is not None:
            return np.full(len(scores), best)
        rows, back, run = scores.tolist(), [], [0.0] * len(self.langs)
        for row in rows:
            top = max(run)
            k, least = run.index(top), top - self.penalty
            back.append([j if x >= least else k for j, x in enumerate(run)])
            run = [(x if x >= least else least) + y for x, y in zip(run, row, strict=True)]
        at, out = run.index(max(run)), np.zeros(len(rows), np.int64)
        for t in range(len(rows) - 1, -1, -1):
            out[t] = at
            at = back[t][at]
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        words = letters_of(text.lower()) if text else []
        if not words or not self.langs:
            return "und", 0.0
        scores = self.word_scores(words)
        if (best := self.constant(scores)) is not None:
            share = np.exp((mean := scores.sum(0, dtype=np.float64) / np.sqrt(len(scores))) - mean.max())
            return self.langs[best], float(share[best] / share.sum())
        way = self.path(scores)
        sizes = np.bincount(way, np.fromiter(map(len, words), np.float64, len(words)), len(self.langs))
        best = int(sizes.argmax())
        mean = scores[way == best].sum(0) / np.sqrt(max((way == best).sum(), 1))
        share = np.exp(mean - mean.max())
        return self.langs[best], float(sizes[best] / sizes.sum() * share[best] / share.sum())

    def spans(self, text: str | None) -> list[tuple[int, int, str]]:
        """(start, end, language) in characters, for mixed texts."""
        found = words_in(text or "")
        if not found or not self.langs:
            return []
        way = self.path(self.word_scores([w.lower() for _, w in found]))
        out = []
        for k, run in groupby(zip(way, found, strict=True), key=lambda x: x[0]):
            held = [x for _, x in run]
            out.append((held[0][0], held[-1][0] + len(held[-1][1]), self.langs[k]))
        return out

    def __getstate__(self) -> dict:
        return self.__dict__ | {"memo": {}, "table": np.zeros((1024, len(self.langs)), np.float32)}


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].cast("string").alias("text"), docs["lang"].cast("string").alias("lang")).where("lang is not null and text is not null")
    rows = rows.where(~held_out(F.col("doc_id")))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()  # a row per language
    if not sizes:
        return Model([], np.zeros((1 << BITS, 0)), {})
    langs = sorted(r["lang"] for r in sizes)
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, sample / r["n"]))])
    chosen = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < F.element_at(share, F.col("lang")) * 1_000_003)
    where = {x: i for i, x in enumerate(langs)}

    def count(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"lang": [], "script": [], "gram": [], "n": []}
        for lang in set(cols["lang"]):
            words = [w for t, x in zip(cols["text"], cols["lang"], strict=True) if x == lang for w in letters_of(t.lower())]
            if not words:
                continue
            grams, n = np.unique(ngrams(words)[0], return_counts=True)
            scripts = Counter(script_of(w) for w in words)
            out["lang"] += [where[lang]] * (len(grams) + len(scripts))
            out["script"] += [""] * len(grams) + list(scripts)
            out["gram"] += grams.tolist() + [-1] * len(scripts)
            out["n"] += n.tolist() + list(scripts.values())
        return out

    counts, scripts = np.zeros((1 << BITS, len(langs))), [Counter() for _ in langs]
    counted = arrow_rows(chosen.select("text", "lang"), count, "lang int, script string, gram bigint, n bigint")
    table = counted.groupBy("lang", "script", "gram").agg(F.sum("n").alias("n")).toArrow()  # a row per language and n-gram hash: numbers, as many as the model has
    lang, gram, n = (table.column(x).to_numpy() for x in ("lang", "gram", "n"))
    counts[gram[gram >= 0], lang[gram >= 0]] = n[gram >= 0]
    for k in np.flatnonzero(gram < 0):
        scripts[lang[k]][table.column("script")[int(k)].as_py()] += int(n[k])
    return Model(langs, counts, scripts_of(dict(zip(langs, scripts, strict=True))))


def scripts_of(words: dict[str, dict[str, int]], share: float = MIN_SCRIPT) -> dict[str, set[str]]:
    """Words of each language by script -> the languages that each script is written in."""
    out: dict[str, set[str]] = {}
    for lang, found in words.items():
        for script, n in found.items():
            if n >= share * sum(found.values()):
                out.setdefault(script, set()).add(lang)
    return out


def label(docs: DataFrame, model: Model) -> DataFrame:
    """Documents -> ``doc_id, held_out, lang_pred, score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a row per n-gram hash, a column per language

    def step(cols: dict[str, list]) -> dict[str, list]:
        found = [shared.value.predict(t) for t in cols["text"]]
        return {"doc_id": cols["doc_id"], "lang_pred": [x for x, _ in found], "score": [s for _, s in found]}

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = arrow_rows(docs.select(docs["doc_id"].alias("doc_id"), docs["text"].cast("string").alias("text")), step, f"doc_id {kind}, lang_pred string, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def label_spans(docs: DataFrame, model: Model) -> DataFrame:
    """Documents -> ``doc_id, start, end, lang``: one row per span."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(cols: dict[str, list]) -> dict[str, list]:
        found = [(d, *s) for d, t in zip(cols["doc_id"], cols["text"], strict=True) for s in shared.value.spans(t)]
        return {n: [x[i] for x in found] for i, n in enumerate(("doc_id", "start", "end", "lang"))}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_rows(docs.select(docs["doc_id"].alias("doc_id"), docs["text"].cast("string").alias("text")), step, f"doc_id {kind}, start int, end int, lang string")
