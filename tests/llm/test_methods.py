"""The methods' own laws: rounding keeps expected mass, the descent is optimal, packing follows its rule, scripts narrow."""

from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidepanel.llm import common, langid, mixing, packing, quality


def test_rounding_keeps_mass_and_expectation(spark):
    items = [(0.3, 10.0), (0.3, 25.0), (0.3, 7.0), (0.7, 40.0), (0.5, 1.0)]
    blocks = 4000
    rows = [(k, p, size, k * 10 + i, 1, k * 7 + i) for k in range(blocks) for i, (p, size) in enumerate(items)]
    frame = spark.createDataFrame(rows, "block int, p double, size double, doc_id bigint, ord int, rank bigint")
    got = mixing._fold(frame, ["block"], seed=11, level=0).collect()
    total = np.zeros(len(items))
    for r in got:
        left = {r.carry.doc_id: (r.carry.p, r.carry["size"])} if r.carry else {}
        taken = {d.doc_id: (float(d.bit), d["size"]) for d in r.done}
        assert len(left) + len(taken) == len(items)  # each is integral but for at most one
        assert abs(sum(p * s for p, s in (taken | left).values()) - sum(p * s for p, s in items)) < 1e-9
        for doc, (p, _) in (taken | left).items():
            total[doc % 10] += p
    spread = 4 * np.sqrt(np.array([p * (1 - p) for p, _ in items]) / blocks)
    assert (abs(total / blocks - [p for p, _ in items]) < spread).all()


def test_dual_coordinate_descent_closes_the_duality_gap():
    draw = np.random.default_rng(3)
    bits, cost = 6, 0.1
    labels = draw.random(60) < 0.4
    rows = [quality.held(np.flatnonzero(draw.random(1 << bits) < (0.3 if y else 0.2)).astype(np.int32), bits) for y in labels]
    scale = draw.normal(size=1 << bits)
    weights, bias = quality.dual_coordinate_descent(rows, scale, labels, cost, rounds=3000)
    plain = np.zeros((len(rows), (1 << bits) + 1))
    for x, r in zip(plain, rows, strict=True):
        x[quality.numbers_of(r)] = scale[quality.numbers_of(r)]
        x[-1] = 1
    y = np.where(labels, 1.0, -1.0)
    w = np.r_[np.divide(weights, scale), bias]
    primal = w @ w / 2 + cost * np.maximum(0, 1 - y * (plain @ w)).sum()
    # the dual by plain projected gradient steps
    q = (y[:, None] * plain) @ (y[:, None] * plain).T
    alpha, step = np.zeros(len(y)), 1 / np.linalg.eigvalsh(q)[-1]
    for _ in range(60_000):
        alpha = np.clip(alpha + step * (1 - q @ alpha), 0, cost)
    dual = alpha.sum() - alpha @ q @ alpha / 2
    assert dual <= primal + 1e-9 and primal - dual < 1e-4 * abs(dual)


def test_features_are_held_in_bounded_memory():
    for n in (0, 5, 8000, 100_000):
        numbers = np.sort(np.random.default_rng(n).permutation(1 << 18)[:n]).astype(np.int32)
        row = quality.held(numbers, 18)
        assert (quality.numbers_of(row) == numbers).all() and len(row) <= 1 + (1 << 15)


def test_one_row_of_an_id_teaches(spark):
    texts = [(i, f"good words number {i}") if i % 2 else (i, "|" * 40) for i in range(1, 40)]
    rows = texts + [(2, f"x {k}") for k in range(30)] + [(3, None)]
    docs = spark.createDataFrame([(i, t, "s", 1, "n") for i, t in rows], "doc_id bigint, text string, id string, y int, nth string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i, _ in texts] + [(None, 1, 0), (5, None, 0), (999, 1, 0)], "doc_id bigint, quality int, toxic int")
    models = [quality.fit(docs.orderBy(*order), labels) for order in (["text"], ["doc_id", "text"])]
    assert models[0].score("good words") == models[1].score("good words") > models[0].score("|" * 40)


def direct_best_two_fit(lengths, capacity):
    rest, bins = sorted(lengths), []
    while rest:
        own, gap = [], capacity
        while fits := [x for x in rest if x <= gap]:
            own.append(fits[-1])
            rest.remove(fits[-1])
            gap -= fits[-1]
        if gap and len(own) > 1:
            small = min(own)
            pairs = [(a, b) for i, a in enumerate(rest) for b in rest[i + 1 :] if small < a + b <= gap + small]
            if pairs:
                a, b = max(pairs, key=lambda p: (p[0] + p[1], -p[0]))
                own.remove(small)
                rest.append(small)
                for x in (a, b):
                    own.append(x)
                    rest.remove(x)
                rest.sort()
        bins.append(tuple(sorted(own)))
    return Counter(bins)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=60))
def test_best_two_fit_equals_a_direct_version(lengths):
    counts = np.bincount(np.array(lengths, int), minlength=31) if lengths else np.zeros(31, np.int64)
    made = Counter()
    for _, times, held in packing.best_two_fit(counts):
        made[tuple(sorted(x for x, use in held for _ in range(use)))] += times
    assert made == direct_best_two_fit(lengths, 30)


def test_other_tokenizers_are_rejected():
    with pytest.raises(ValueError):
        packing.WordIds(packing.tokenizer_path("byte_bpe_50k.json"))


@pytest.mark.parametrize("text", ["½ ² ① 12", "12 _ 3", "", None, "٣ Ⅷ ㊀", "…!"])
def test_texts_without_letters_have_no_language(text):
    counts = np.ones((1 << langid.BITS, 2))
    assert langid.Model(["a", "b"], counts, {}).predict(text) == ("und", 0.0)
    assert langid.words_in("a½b ②c") == [(0, "a"), (2, "b"), (5, "c")] and langid.letters_of("a½b ②c") == ["a", "b", "c"]


def test_scripts_narrow_candidates():
    words = {"ru": "это язык который мы знаем", "en": "the language that we know", "sr": "ово је jезик koji znamo"}
    counts = np.zeros((1 << langid.BITS, 3))
    for k, x in enumerate(sorted(words)):
        np.add.at(counts[:, k], langid.ngrams(words[x].split() * 5)[0], 1)
    seen = {"ru": {"cyrillic": 990, "latin": 5}, "en": {"latin": 1000, "cyrillic": 1}, "sr": {"cyrillic": 400, "latin": 600}}
    scripts = langid.scripts_of(seen)
    assert scripts == {"cyrillic": {"ru", "sr"}, "latin": {"en", "sr"}}
    model = langid.Model(sorted(words), counts, scripts, penalty=3.0)
    assert model.narrows and model.word_scores(["the"])[0, 1] < model.word_scores(["the"])[0].max() - 5
    assert model.predict("Это язык")[0] == "ru" and model.predict("the know")[0] == "en"
    assert [x for *_, x in model.spans("это язык мы знаем the language that we know")] == ["ru", "en"]


def test_learning_languages_with_two_scripts(spark):
    rows = [(i, "мы знаем этот язык" if i % 2 else "we know this language", "ru" if i % 2 else "en", "x", 1, "g", 3) for i in range(60)]
    rows += [(100, "the the мы", "ru", "x", 1, "g", 3), (101, None, "ru", "x", 1, "g", 3), (102, "½", "en", "x", 1, "g", 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, script string, n int, gram string, score int")
    model = langid.fit(docs)
    assert model.langs == ["en", "ru"] and list(model.allowed["cyrillic"]) == [False, True]
    got = {r.doc_id: r for r in langid.label(docs, model).collect()}
    assert all(got[i].lang_pred == ("ru" if i % 2 else "en") for i in range(60)) and got[101].lang_pred == got[102].lang_pred == "und"


def test_a_cluster_needs_a_shared_folder():
    class Fake:
        def __init__(self, master):
            self.sparkContext, self.conf, self.master = self, self, master

        def getConf(self):
            return self

        def get(self, *_):
            return None

    assert common.shared_dir(Fake("local[2]"))
    for master in ("yarn", "spark://x:7077", "local-cluster[1,1,1]"):
        with pytest.raises(ValueError):
            common.shared_dir(Fake(master))
