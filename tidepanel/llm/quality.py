"""A quality classifier: naive Bayes features with a support vector machine.

A text's features are indicators (seen or not) of hashed n-grams: bytes in threes, and
runs of five character classes, which see shapes (capitals, stray signs, table bars,
digits) in any language; and n-grams of its word counts on a coarse scale, which see
repetition. Every indicator is scaled by its log-count ratio between the two labels, and a
linear machine with hinge loss is fitted on them by dual coordinate descent. Its margin
becomes a score from 0 to 1 by a logistic curve fitted on documents that the machine has
not seen (two folds).

Training takes at most ``SAMPLE`` labelled documents, those with the smallest hash of
their id; each document is scored on its whole text by executors that hold one weight
vector of ``1 << BITS`` numbers.

Defined results: a null text counts as empty and gets the score of a text without
features; labels that are null or belong to no document are left out; a document labelled
more than once counts as often; of rows that share a doc_id, the one with the smallest hash of
its text teaches; without both labels every score is the share of label 1 (0.5 without labels);
a score of exactly the threshold is predicted 1; very long texts are read whole; repeated rows
each give a row; an empty table gives an empty result; extra columns take no part.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.llm.common import arrow_rows

#: Labelled documents that training takes at most.
SAMPLE = 4000
BITS = 18
THRESHOLD = 0.3


def _classes() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    for x in range(256):
        c = chr(x)
        table[x] = ord("u") if x > 127 else ord("a") if c.islower() else ord("A") if c.isupper() else ord("0") if c.isdigit() else ord(" ") if c in "\t\r " else x
    return table


CLASS = _classes()


def features(text: str, bits: int = BITS) -> np.ndarray:
    """Sorted distinct feature numbers of a text, below ``1 << bits``."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    seen = np.zeros(1 << bits, bool)
    shift = np.uint32(32 - bits)
    if len(raw) >= 3:
        wide = raw.astype(np.uint32)
        seen[((wide[:-2] | wide[1:-1] << 8 | wide[2:] << 16) * np.uint32(2654435761) + np.uint32(77)) >> shift] = True
    if len(raw) >= 5:
        kind = CLASS[raw].astype(np.uint32)
        code = kind[:-4]
        for k in range(1, 5):
            code = code * np.uint32(131) + kind[k : len(kind) - 4 + k]
        seen[(code * np.uint32(2246822519) + np.uint32(9)) >> shift] = True
    words = text.split()
    n = len(words)
    scale = int(np.log2(n + 1) * 2)
    variety = int(10 * len(set(words)) / n) if n else -1
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    again = int(20 * same / n) if n else -1
    lines = text.split("\n")
    twice = int(10 * (1 - len(set(lines)) / len(lines)))
    for k, x in enumerate((scale, variety, again, twice, variety * 100 + scale, again * 100 + scale, twice * 100 + scale)):
        seen[(x * 7919 + k * 104729 + 13) * 2654435761 % (1 << 32) >> (32 - bits)] = True
    return np.flatnonzero(seen).astype(np.int32)


def log_count_ratio(rows: list[bytes], labels: np.ndarray, bits: int) -> np.ndarray:
    p, q = np.ones(1 << bits), np.ones(1 << bits)
    for x, y in zip(rows, labels, strict=True):
        (p if y else q)[numbers_of(x)] += 1
    return np.log(p / (1 + labels.sum())) - np.log(q / (1 + (~labels).sum()))


def dual_coordinate_descent(rows: list[bytes], scale: np.ndarray, labels: np.ndarray, cost: float = 0.02, rounds: int = 12, seed: int = 1) -> tuple[np.ndarray, float]:
    """Hinge loss, L2: each step solves one document's dual variable in [0, cost] exactly; the bias is one more feature, 1 for all."""
    weights, bias = np.zeros(len(scale)), 0.0
    alpha, draw = np.zeros(len(rows)), np.random.default_rng(seed)
    norms = np.array([(scale[numbers_of(x)] ** 2).sum() + 1 for x in rows])
    for _ in range(rounds):
        for i in draw.permutation(len(rows)):
            seen = numbers_of(rows[i])
            values = scale[seen]
            y = 1.0 if labels[i] else -1.0
            slack = y * (weights[seen] @ values + bias) - 1
            new = min(max(alpha[i] - slack / norms[i], 0.0), cost)
            if (step := (new - alpha[i]) * y) != 0:
                weights[seen] += step * values
                bias += step
                alpha[i] = new
    return weights * scale, bias


def fit_logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve, by Newton steps with smoothed targets."""
    high, low = labels.sum(), (~labels).sum()
    goal = np.where(labels, (high + 1) / (high + 2), 1 / (low + 2))
    spread = margins.std() or 1.0
    a, b = 1 / spread, float(np.log((high + 1) / (low + 1)))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        w, g = p * (1 - p) + 1e-9, p - goal
        hess = np.array([[(w * margins**2).sum() + 1e-6, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(hess, [(g * margins).sum(), g.sum()])
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-8:
            break
    return float(a), float(b)


class Model:
    """``weights`` by feature, ``bias``, and the logistic curve."""

    def __init__(self, weights: np.ndarray | None, bias: float, slope: float, shift: float) -> None:
        self.weights, self.bias, self.slope, self.shift = weights, bias, slope, shift

    def score(self, text: str) -> float:
        margin = 0.0 if self.weights is None else float(self.weights[features(text, int(len(self.weights)).bit_length() - 1)].sum(dtype=np.float64)) + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30))))


def train(rows: list[bytes], labels: list[int], bits: int = BITS) -> Model:
    y = np.array(labels, bool)
    if y.all() or not y.any():
        share = float(y.mean()) if len(y) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(None, 0.0, 0.0, float(np.log(share / (1 - share))))

    def fit(which: np.ndarray) -> tuple[np.ndarray, float]:
        some = [rows[i] for i in which]
        return dual_coordinate_descent(some, log_count_ratio(some, y[which], bits), y[which])

    margins, every = np.zeros(len(y)), np.arange(len(y))
    for half in (0, 1):
        own = every[every % 2 != half]
        if y[own].all() or not y[own].any():
            own = every
        weights, bias = fit(own)
        for i in every[every % 2 == half]:
            margins[i] = weights[numbers_of(rows[i])].sum() + bias
    weights, bias = fit(every)
    return Model(weights.astype(np.float32), bias, *fit_logistic(margins, y))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, bits: int = BITS) -> Model:
    """Learn ``quality`` from labelled documents outside the held-out fifth."""
    marked = labels.select(labels["doc_id"].alias("id"), labels["quality"].cast("int").alias("y")).where("id is not null and y in (0, 1)")
    chosen = marked.where(~held_out(F.col("id"))).orderBy(F.xxhash64("id"), "id", "y").limit(sample)
    spark = docs.sparkSession
    picked = chosen.collect()  # at most `sample` rows
    if not picked:
        return train([], [], bits)
    small = F.broadcast(spark.createDataFrame(sorted({x["id"] for x in picked}), labels.schema["doc_id"].dataType).toDF("id"))
    texts = docs.select(docs["doc_id"].alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text")).join(small, F.col("doc_id") == F.col("id")).select("id", "text")
    # one row teaches for an id: the one with the smallest hash of its text; each partition passes on one row an id
    texts = texts.withColumn("nth", F.row_number().over(Window.partitionBy("id").orderBy(F.xxhash64("text"), "text"))).where("nth = 1")

    def step(cols: dict[str, list]) -> dict[str, list]:
        return {"id": cols["id"], "seen": [held(features(t or "", bits), bits) for t in cols["text"]]}

    kind = labels.schema["doc_id"].dataType.simpleString()
    # at most `sample` rows of at most 1 + (1 << bits) / 8 bytes each
    found = {r[0]: bytes(r[1]) for r in arrow_rows(texts.select("id", "text"), step, f"id {kind}, seen binary").collect()}
    pairs = [(found[r["id"]], r["y"]) for r in picked if r["id"] in found]
    return train([x for x, _ in pairs], [y for _, y in pairs], bits)


def held(numbers: np.ndarray, bits: int) -> bytes:
    """Feature numbers as four bytes each, or as a bit for every feature where that is less."""
    if 4 * len(numbers) <= (1 << bits) // 8:
        return b"\0" + numbers.astype("<i4").tobytes()
    seen = np.zeros(1 << bits, np.uint8)
    seen[numbers] = 1
    return b"\1" + np.packbits(seen).tobytes()


def numbers_of(row: bytes) -> np.ndarray:
    return np.frombuffer(row, "<i4", offset=1) if row[:1] == b"\0" else np.flatnonzero(np.unpackbits(np.frombuffer(row, np.uint8, offset=1)))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, keep: bool = False) -> DataFrame:
    """Documents -> ``doc_id, held_out, score, predicted``; with ``keep``, the documents that are predicted good."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number per feature
    if keep:
        names = docs.columns

        def select(cols: dict[str, list]) -> dict[str, list]:
            good = [shared.value.score(t or "") >= threshold for t in cols["text"]]
            return {n: [x for x, g in zip(cols[n], good, strict=True) if g] for n in names}

        return arrow_rows(docs, select, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))

    def step(cols: dict[str, list]) -> dict[str, list]:
        return {"doc_id": cols["doc_id"], "score": [shared.value.score(t or "") for t in cols["text"]]}

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = arrow_rows(docs.select(docs["doc_id"].alias("doc_id"), docs["text"].cast("string").alias("text")), step, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
