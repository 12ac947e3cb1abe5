"""Training-data operators against brute force, and on nulls, ties, repeats and empty tables."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidepanel.llm import ann, exact, html, langid, mixing, near, packing, quality, repeats, warc

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, block string, n int, host string"


def docs_of(spark, texts, sources=None):
    rows = [(i, t, "en", sources[k] if sources else "s", 0, "x", 1, "h") for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)  # block, n and host clash with names used inside


ODD = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (4, "a b"), (None, "c"), (5, " \n\t"), (6, "\u0000é🙂 x"), (7, "w " * 30000)]


def test_mixing(spark):
    draw = random.Random(1)
    texts = [(i, "w " * draw.choice((0, 1, 5, 60, 900))) for i in range(600)] + ODD
    sources = [draw.choice(("a", "b", "b", "b", None)) for _ in texts]
    rows = mixing.mix(docs_of(spark, texts, sources)).collect()
    assert len(rows) == len(texts) and all(0 <= r.taken <= 3 * r["size"] and r.taken % max(r["size"], 1) == 0 for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    total = sum(r["size"] for r in rows)
    caps = {s: 3 * sum(r["size"] for r in x) for s, x in by.items()}
    weights = dict(zip(("a", "b", None), (1, 2, 3), strict=True))
    goal, free, left = {}, set(by), total
    while True:  # refill what the capped sources can't take
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] > caps[s]}
        if not over:
            goal |= share
            break
        goal |= {s: caps[s] for s in over}
        free, left = free - over, left - sum(caps[s] for s in over)
    for s, x in by.items():
        assert abs(x[0].target - goal[s]) < 1e-6 * total
        # the one fraction left may be the source's largest document
        assert abs(sum(r.taken for r in x) - goal[s]) < 0.02 * goal[s] + max(r["size"] for r in x) / 2
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs_of(spark, texts, sources)).collect()))
    assert mixing.mix(docs_of(spark, [])).count() == 0
    assert mixing.take_copies(docs_of(spark, texts, sources)).columns == docs_of(spark, []).columns


def test_exact(spark):
    rows = exact.exact_groups(docs_of(spark, ODD)).collect()
    assert len(rows) == len(ODD)
    groups = {}
    for i, t in ODD:
        groups.setdefault(t or "", []).append(i)
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): (max((x for x in ids if x is not None), default=None), len(ids)) for t, ids in groups.items()}
    for r in rows:
        assert (r.keep_id, r.group_size) == by_hash[r.text_sha256]
    assert sum(r.kept for r in rows) == len(groups)
    assert exact.drop_copies(docs_of(spark, ODD)).count() == len(groups)
    assert exact.exact_groups(docs_of(spark, [])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 5), max_size=30), min_size=1, max_size=5))
def test_quotient_filters_merge_without_loss(parts):
    parts = [np.array(p * (1 + 300 * (k == 1)), np.uint64) for k, p in enumerate(parts)]  # counters of one and of nine bytes
    made = exact.CountingQuotientFilter.merge_all(map(exact.CountingQuotientFilter.build, parts))
    want = np.unique(np.concatenate(parts), return_counts=True)
    assert (made.fingerprints() == want[0]).all() and (made.counts == want[1]).all()
    again = [exact.CountingQuotientFilter.load(b) for _, b in made.blocks(7)]
    assert sum(len(f.remainders) for f in again) == len(want[0])
    for f in again:
        assert f.dump() == exact.CountingQuotientFilter.load(f.dump()).dump()
    if again:
        whole = exact.CountingQuotientFilter.merge_all(again[::-1])
        assert (whole.fingerprints() == want[0]).all() and (whole.counts == want[1]).all()
        twice = whole.merge(whole)
        assert (twice.counts == 2 * want[1]).all() and len(twice.remainders) == len(want[0])


def test_rows_of_one_id_are_told_apart(spark):
    """Near and exact stages drop the row that is a copy, not another one of its id."""
    words = " ".join(f"w{i}" for i in range(100))
    other = " ".join(f"v{i}" for i in range(100))
    rows = [(3, words + " a", "s"), (7, words + " b", "s"), (7, other, "s"), (7, other, "t"), (9, None, "s")]
    kept = near.drop_near_copies(docs_of(spark, [r[:2] for r in rows], [r[2] for r in rows])).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(3, words + " a"), (7, other), (9, None)]
    twice = docs_of(spark, [(5, "x"), (5, "x"), (5, "y")], ["b", "a", "c"])
    assert len({str(sorted(exact.drop_copies(twice.orderBy(F.rand(k))).collect())) for k in range(4)}) == 1
    odd = docs_of(spark, ODD).selectExpr("*", "1 as own_0", "array(map(1, 2)) as nth", "text as tid", "'c' as comp")
    assert near.drop_near_copies(odd).columns == odd.columns and exact.drop_copies(odd).count() == len({t or "" for _, t in ODD})


@pytest.mark.parametrize("least", [0, 10])
def test_warc_round_trip(spark, least):
    tricky = "a\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n\0\0"
    rows = [(1, "http://x/", tricky), (2, "http://y/", tricky), (2, "http://y/", tricky), (3, None, None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"), (7, "é", "é" * 9000)]
    rows += [(8, "v", "\0"), (None, "w", "a page without an id"), (None, "w", "another without an id"), (None, "w", "another without an id"), (9, "z\r\nX-Page-ID: 5", "last")]
    pages = spark.createDataFrame([(*r, "d", 1, "i", "k") for r in rows], "page_id bigint, url string, html string, digest string, n int, id string, key string")
    got = warc.archive(pages, least, date="2024-01-31T00:00:00Z").collect()
    assert sorted((r.page_id, bytes(base64.b32decode(r.payload_digest))) for r in got) == sorted((str(i) if i is not None else "null", hashlib.sha1((h or "").encode()).digest()) for i, _, h in rows)
    texts = {hashlib.sha1((h or "").encode()).digest(): (h or "").encode() for _, _, h in rows}
    first, by_id = {}, {r.record_id: r for r in got}
    assert len(by_id) == len(rows) and all(x.startswith("urn:uuid:") and len(x) == 45 for x in by_id)
    for i, _, h in sorted(rows, key=lambda x: (x[0] is None, x[0] or 0)):
        first.setdefault((h or "").encode(), str(i) if i is not None else "null")
    for r in got:
        p = texts[base64.b32decode(r.payload_digest)]
        assert r.payload_bytes == len(p) and r.date == "2024-01-31T00:00:00Z"
        if r.record_type == "response":
            assert bytes(r.payload) == p and r.refers_to is None and r.refers_to_record is None
        else:
            assert len(p) >= least and r.refers_to == first[p] and not r.payload
            original = by_id[r.refers_to_record]
            assert original.record_type == "response" and original.page_id == r.refers_to and bytes(original.payload) == p
    kinds = [r.record_type for r in got]
    assert kinds.count("revisit") == (5 if least == 0 else 3)
    assert warc.archive(pages.limit(0)).count() == 0


def test_archives_hold_a_member_for_each_record(spark, tmp_path):
    rows = [(i, "http://x/", f"page {i} " * 50) for i in range(40)] + [(100, "http://y/", "".join(chr(97 + i * i % 26) for i in range(100)) * 180_000)]
    warc.write(spark.createDataFrame(rows, "page_id bigint, url string, html string"), str(tmp_path / "w"))
    found = 0
    for file in (tmp_path / "w").glob("part-*"):
        data = file.read_bytes()
        while data:  # each member starts a record, but for the later ones of a record above 8 MiB
            one = zlib.decompressobj(31)
            text = one.decompress(data)
            assert one.eof
            data = one.unused_data
            found += text.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
            assert text.startswith(b"WARC/1.1\r\n") or len(text) <= warc.MEMBER
    assert found == len(rows)
    read = {r.page_id: r for r in warc.read(spark, str(tmp_path / "w")).collect()}
    assert all(bytes(read[str(i)].payload) == h.encode() for i, _, h in rows)
    with pytest.raises(ValueError):
        list(warc.parse(__import__("io").BytesIO(b"no archive")))


def test_quality_and_language_on_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    train = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = quality.fit(train, labels)
    scored = {r.doc_id: r for r in quality.score(train, model).collect()}
    held = [(scored[r.doc_id].predicted, r.quality) for r in labels.collect() if scored[r.doc_id].held_out]
    assert np.mean([a == b for a, b in held]) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in scored.values())
    assert quality.score(docs_of(spark, ODD), model).count() == len(ODD)
    assert quality.score(docs_of(spark, []), quality.fit(docs_of(spark, []), labels.limit(0))).count() == 0
    lang = langid.fit(train)
    got = langid.label(docs, lang).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.95
    odd = langid.label(docs_of(spark, ODD), lang).collect()
    assert len(odd) == len(ODD) and sum(r.lang_pred == "und" for r in odd) >= 3
    assert langid.label(docs_of(spark, ODD), langid.fit(docs_of(spark, []))).where("lang_pred != 'und'").count() == 0


def test_viterbi_shortcut_is_exact():
    draw = np.random.default_rng(5)
    model = langid.Model(["a", "b", "c"], draw.random((1 << langid.BITS, 3)), {}, penalty=2.0)
    for _ in range(200):
        s = draw.normal(0, 1.2, (draw.integers(1, 30), 3)) + draw.normal(0, 0.5, 3)
        run = np.zeros(3)
        for row in s:
            run = np.maximum(run, run.max() - 2.0) + row
        way = model.path(s)
        value = s[np.arange(len(s)), way].sum() - 2.0 * (way[1:] != way[:-1]).sum()
        assert abs(value - run.max()) < 1e-6


def test_mixed_language_spans():
    words = {"en": "the and with that this from have", "de": "und der die nicht ein auch sich"}
    counts = np.zeros((1 << langid.BITS, 2))
    for k, x in enumerate(("de", "en")):
        np.add.at(counts[:, k], langid.ngrams(words[x].split() * 20)[0], 1)
    model = langid.Model(["de", "en"], counts, {"latin": {"de", "en"}}, penalty=3.0)
    spans = model.spans(words["en"] + " " + words["de"])
    assert [x for *_, x in spans] == ["en", "de"] and spans[1][0] == len(words["en"]) + 1


def test_nearest(spark):
    draw = np.random.default_rng(2)
    rows = [(i, [float(x) for x in draw.standard_normal(8)]) for i in range(400)]
    rows += [(400 + i, rows[40][1]) for i in range(60)] + [(900, None), (901, [0.0] * 8), (902, [float("nan")] * 8), (903, [1.0, None] + [0.0] * 6), (904, [1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = {}
    for r in ann.nearest(df, per_list=40).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    ids = np.array([i for i, v in rows if i < 900])
    vecs = np.array([v for i, v in rows if i < 900], np.float32).astype(float)
    hits = 0
    for q in ids[ids % 20 == 0]:
        s = vecs @ vecs[np.flatnonzero(ids == q)[0]]
        s[ids == q] = -np.inf
        want = ids[np.lexsort((ids, -np.round(s, 9)))[:20]]
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, 21))
        hits += len(set(want) & {m[1] for m in mine})
    assert hits / (20 * (ids % 20 == 0).sum()) >= 0.9
    assert ann.nearest(df.limit(0)).count() == 0
    assert ann.nearest(df.where("vec_id < 3")).count() == 2


def clusters(n, width, seed, spread=0.35, centers=60):
    draw = np.random.default_rng(seed)
    middle = draw.standard_normal((centers, width))
    return (middle[draw.integers(0, centers, n)] + spread * draw.standard_normal((n, width))).astype(np.float32).astype(float)


@pytest.mark.parametrize("flat", (False, True))
def test_scan_abandons_candidates(flat):
    """Fewer multiplications than an exhaustive search, and nearly all neighbours, where the lists to probe are fewer than there are."""
    rows = np.random.default_rng(8).standard_normal((6000, 64)) if flat else clusters(6000, 64, 4)
    index = ann.Index(rows[::2], 40, float((rows**2).sum(1).max()), 20)
    lists, ids = index.lists_of(rows, 1, False)[:, 0], np.arange(len(rows))
    asked = ids[::100]
    probed, floor = index.lists_of(rows[asked], index.probes, True), index.floor(rows[asked], ann.SPARE * 21)
    assert flat or index.probes < 20
    work, found = [], {int(q): [] for q in asked}
    for one in range(40):
        who = np.flatnonzero((probed == one).any(1))
        own = np.flatnonzero(lists == one)
        if len(who) and len(own):
            q, v, s = ann.scan(index, rows[asked[who]], floor[who], rows[own], own, min(21, len(own)), work=work)
            for a, b, c in zip(q, v, s, strict=True):
                found[int(asked[who[a]])].append((-c, b))
    hits = 0
    for q, got in found.items():
        scores = rows @ rows[q]
        scores[q] = -np.inf
        want = set(np.argsort(-scores)[:20].tolist())
        hits += len(want & {int(v) for _, v in sorted(got)[:21]})
    assert hits / (20 * len(asked)) >= 0.9
    assert sum(work) < (0.95 if flat else 0.5) * len(asked) * len(rows) * 65


def test_nearest_with_fewer_probes_than_lists(spark):
    rows = clusters(4000, 32, 9)
    df = spark.createDataFrame([(i, v.tolist(), 1, "l", 0.5, "p") for i, v in enumerate(rows)], "vec_id bigint, embedding array<float>, list int, part string, score double, q string")
    hits, got = 0, {}
    for r in ann.nearest(df, per_list=100).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    for q in range(0, 4000, 20):
        s = rows @ rows[q]
        s[q] = -np.inf
        want = np.argsort(-s, kind="stable")[:20].tolist()
        assert len(got[q]) == 20 and all(abs(s[v] - x) < 1e-9 for v, x in got[q].items())
        hits += len(set(want) & set(got[q]))
    assert hits / 4000 >= 0.9
    index = ann.Index(rows, 40, float((rows**2).sum(1).max()), 20)
    assert index.probes < 20


def test_packing(spark):
    from tokenizers import Tokenizer

    texts = ODD + [(10 + i, "word " * (7 * i % 900)) for i in range(80)]
    rows = packing.pack_documents(docs_of(spark, texts), sequence=512).collect()
    plain = Tokenizer.from_file(packing.tokenizer_path())
    want = sorted(str(plain.encode(t or "", add_special_tokens=False).ids + [0]) for _, t in texts)
    crcs = sorted((len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for t in want for ids in [eval(t)] for p in [ids[k : k + 512] for k in range(0, len(ids), 512)])
    assert sorted((r.length, r.ids_crc32) for r in rows) == crcs
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for x in seqs.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= 512
    assert len(seqs) <= 1.03 * sum(r.length for r in rows) / 512 + 1
    assert packing.pack_documents(docs_of(spark, [])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120))
def test_best_two_fit_places_every_piece_once(lengths):
    counts = np.bincount(np.array(lengths, int), minlength=41) if lengths else np.zeros(41, np.int64)
    places, seen = packing.Places(packing.best_two_fit(counts)), {}
    for size in range(1, 41):
        for rank in range(counts[size]):
            seq, offset = places.of(size, rank)
            seen.setdefault(seq, []).append((offset, size))
    for x in seen.values():
        at = 0
        for offset, size in sorted(x):
            assert offset == at
            at += size
        assert at <= 40


def test_tokens_by_stretch_equal_tokens_of_the_text():
    from tokenizers import Tokenizer

    plain, words = Tokenizer.from_file(packing.tokenizer_path()), packing._words(packing.tokenizer_path())
    texts = ["It's  A test\x1c x\x85y z don't", "é ́x İI ß\r\n<|endoftext|>a b<|startoftext|>", "", " \n", "日本語 テスト🙂🙂"]
    texts += ["Éáb&& İstanbul!! ß. 'S x1y2 \x01a b　c ²³ ａＢ. ǅ,", "ͅ aͅ. ﬁ, Ω!!", "a" * 70 + "!? " + "b" * 64 + " ..,, ,a .B! A.", "a" * 70 + "!?", "%% " * 30]
    for t, ids in zip(texts, words.encode(texts), strict=True):
        assert ids == np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
    assert words.encode([]) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.lists(st.integers(0, 3), max_size=60), st.integers(0, 60))
def test_banded_distance(a, b, limit):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    assert near.banded_distance(a, b, limit) == min(row[-1], limit + 1)


def test_banded_distance_over_blocks(monkeypatch):
    words = [str(i * i % 97) for i in range(500)]
    other = words[:90] + ["new"] * 7 + words[93:400] + words[410:]
    whole = near.banded_distance(words, other, 60)
    assert 10 < whole <= 17
    monkeypatch.setattr(near, "BLOCK", 16)
    assert near.banded_distance(words, other, 60) == whole
    assert near.banded_distance(["a", "b"], ["b", "a"], 0) == 1


def test_near_classes(spark):
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    texts, truth, passage = [], [], [word() for _ in range(40)]
    for c in range(25):
        base = [word() for _ in range(draw.randint(60, 200))] + passage * (c % 2)
        for _ in range(4):
            copy = list(base)
            for _ in range(len(copy) // 40):
                copy[draw.randrange(len(copy))] = word()
            texts.append((len(texts), " ".join(copy)))
            truth.append(4 * c)
    rows = {r.doc_id: r for r in near.near_classes(docs_of(spark, texts)).collect()}
    assert [rows[i].class_id for i in range(len(texts))] == truth
    assert sum(r.representative for r in rows.values()) == 25 and {r.class_size for r in rows.values()} == {4}
    odd = near.near_classes(docs_of(spark, ODD)).collect()
    assert len(odd) == len(ODD) and sum(r.representative for r in odd) == len({t or "" for _, t in ODD})
    assert near.near_classes(docs_of(spark, [])).count() == 0
    assert near.drop_near_copies(docs_of(spark, texts)).count() == 25


def test_repeats(spark):
    draw = random.Random(9)
    some = lambda n: "".join(draw.choice("abcdé ") for _ in range(n))
    parts = [some(draw.randint(90, 260)) for _ in range(12)]
    texts = [(i, "".join(draw.choice(parts) if draw.random() < 0.5 else some(150) for _ in range(draw.randint(0, 6)))) for i in range(60)]
    texts += [(70, "ab" * 300), (71, "x" * 500), (72, None), (72, "y" * 99), (73, parts[0] * 3), (73, parts[0] * 3)]
    got = sorted(repeats.remove_repeats(docs_of(spark, texts), keep_bytes=True).collect(), key=lambda r: (r.doc_id, r.n_bytes))
    seen, index = set(), 0
    for i, t in sorted(set(texts), key=lambda x: (x[0], len((x[1] or "").encode()))):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - 99):
            if (w := data[s : s + 100]) in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        while index < len(got) and got[index].doc_id == i and got[index].n_bytes == len(data):
            assert (bytes(got[index].kept), got[index].n_removed) == (kept, sum(gone)) and got[index].kept_sha256 == hashlib.sha256(kept).hexdigest()
            index += 1
    assert index == len(got) == len(texts)
    assert repeats.remove_repeats(docs_of(spark, [])).count() == 0


def test_repeated_rows_keep_a_text_found_nowhere_else(spark):
    draw = random.Random(2)
    alone, other = ("".join(draw.choice("abcdefghij ") for _ in range(600)) for _ in range(2))
    rows = [(1, alone)] * 5 + [(2, other + alone), (3, other), (3, other), (4, alone[:300] * 2), (4, alone[:300] * 2)]
    for parts in (1, 5):
        got = repeats.remove_repeats(docs_of(spark, rows).repartition(parts), keep_bytes=True).collect()
        kept = sorted((r.doc_id, bytes(r.kept).decode()) for r in got)
        assert kept == sorted([(1, alone)] * 5 + [(2, other), (3, ""), (3, ""), (4, ""), (4, "")], key=lambda x: x)
    fresh = "".join(draw.choice("klmnop") for _ in range(150))
    got = repeats.remove_repeats(docs_of(spark, [(5, fresh + fresh)] * 4), keep_bytes=True).collect()
    assert len(got) == 4 and {bytes(r.kept).decode() for r in got} == {fresh}
    with pytest.raises(TypeError):
        repeats.remove_repeats(docs_of(spark, rows).selectExpr("cast(doc_id as string) as doc_id", "text"))


def flat(texts):
    return np.frombuffer(b"".join(texts), np.uint8), np.array([len(x) for x in texts], np.int64)


def test_run_length_index():
    draw = random.Random(3)
    for _ in range(40):
        held = [bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 80))) for _ in range(5)]
        groups = np.array([0, 0, 1, 1, 2])
        patterns = [bytes(draw.choice(b"abc") for _ in range(30)) + held[0][5:40], b"", held[3][3:] + b"a", b"\0\xff"]
        of = np.array([0, 0, 1, 2])
        index = repeats.RunLengthIndex(*flat(held), groups)
        assert index.lengths.sum() == index.rows
        lengths, places = index.statistics(*flat(patterns), of)
        long, _ = index.statistics(*flat(patterns), of, 9)
        assert (np.where(lengths >= 9, lengths, 0) == np.where(long >= 9, long, 0)).all()
        block, at = b"\1".join(held), 0
        for pattern, group in zip(patterns, of, strict=True):
            own = [h for h, g in zip(held, groups, strict=True) if g == group]
            for i in range(len(pattern)):
                n, place = int(lengths[at + i]), int(places[at + i])
                assert any(pattern[i : i + n] in h for h in own) and (i + n == len(pattern) or not any(pattern[i : i + n + 1] in h for h in own))
                assert n == 0 or block[place : place + n] == pattern[i : i + n]
            at += len(pattern)


@pytest.mark.parametrize("block", (1, 3, 4000))
def test_earlier_texts_of_a_group(block):
    draw = random.Random(block)
    for _ in range(15):
        groups = np.sort([draw.randint(0, 4) for _ in range(25)])
        texts = [bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 30))) for _ in groups]
        found, at = repeats.earlier(*flat(texts), groups, length=6, block=block), 0
        for k, text in enumerate(texts):
            before = [t for t, g in zip(texts[:k], groups[:k], strict=True) if g == groups[k]]
            want = [len(text[i : i + 6]) == 6 and any(text[i : i + 6] in t for t in before) for i in range(len(text))]
            assert found[at : at + len(text)].tolist() == want
            at += len(text)
    assert not len(repeats.earlier(*flat([]), np.zeros(0, np.int64)))


@pytest.mark.parametrize(("leads", "block"), [(16, 256), (1, 8)])
def test_near_classes_of_stars_and_chains_equal_all_pairs(spark, monkeypatch, leads, block):
    monkeypatch.setattr(near, "LEADS", leads)
    monkeypatch.setattr(near, "BLOCK_TEXTS", block)
    draw = random.Random(8)
    words = lambda n: ["".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(n)]
    families = []
    for n in (10, 40, 300):  # copies are like the base and unlike each other
        base = words(200)
        families.append([base] + [base[:at] + words(25) + base[at:] for at in (draw.randrange(200) for _ in range(n))])
    chain = [words(200)]
    for at in range(0, 180, 20):  # each is like the next one
        chain.append(chain[-1][:at] + words(20) + chain[-1][at + 20 :])
    families.append(chain)
    passage = words(150)  # many meet at it and are unlike
    families.append([words(60) + passage for _ in range(60)])
    texts = [t for family in families for t in family]
    order = list(range(len(texts)))
    draw.shuffle(order)
    got = {r.doc_id: r.class_id for r in near.near_classes(docs_of(spark, [(i, " ".join(texts[k])) for i, k in enumerate(order)])).collect()}
    comp, start = list(range(len(texts))), 0
    for family in families:
        for i in range(start, start + len(family)):
            for j in range(start, i) if len(family) < 300 else [start]:
                if near.similarity(texts[i], texts[j]) and comp[i] != comp[j]:
                    old, new = comp[i], comp[j]
                    comp = [new if c == old else c for c in comp]
        start += len(family)
    assert len(set(comp)) == 4 + 60
    first = {}
    for i, k in enumerate(order):
        first.setdefault(comp[k], i)
    assert [got[i] for i in range(len(texts))] == [first[comp[k]] for k in order]


def test_page_text(spark):
    page = lambda body: f"<html><head><title>T</title></head><body><nav><a href='/'>Home</a></nav>{body}<footer>(c) me</footer></body></html>"
    promo = "<div><span>Read more from us</span></div>"
    rows = [(i, "http://a.org/x", page(f"{promo}<div><p>Text {i} &amp; more<br>on  it<p>Two {i}</div>")) for i in range(12)]
    rows += [(20, "http://b.org/", page("<article><h1>H&eacute;</h1><p>Same<p>Same<aside>no</aside><div class='comments'><p>me too</p></div></article>")), (21, None, None), (22, "x", "plain <b>text</b>"), (23, "x", "<p>open <script>if (a<b) {}</script> end")]
    got = {r.page_id: r for r in html.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert len(got) == len(rows)
    assert got[3].text == "Text 3 & more on it\nTwo 3"  # the promo recurs on the host's pages
    assert got[20].text == "Hé\nSame\nSame" and got[20].n_chars == 12
    assert got[21].text == "" and got[22].text == "plain text" and got[23].text.split() == ["open", "end"]
    assert html.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_page_text_of_copies(spark):
    promo = "<div><span>Read more from us</span></div>"
    page = lambda i: f"<nav>at {i}</nav>{promo}<article><div class='body'><p>Story {i % 100}</p></div></article><div><p>Note {i % 100}</p></div>"
    plain = lambda i: f"<nav>at {i}</nav>{promo}<div><p>Story {i % 100}</p></div>"
    rows = [(host * 1000 + i, f"http://{name}/{i}", make(i)) for host, (name, make) in enumerate((("a.org", page), ("b.org", plain))) for i in (*range(20), *range(107, 1007, 100))]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert len(got) == 58  # page 7 stands there 10 times, a third of the host's rows, under other menus
    assert all(text == f"Story {i % 100}" for i, text in got.items())


def test_page_text_of_a_large_host(spark):
    rows = [(i, f"http://a.org/{i}", f"<div><span>Advert {i % 20}</span></div><div><p>Story {i}</p></div>") for i in range(1200)]
    got = html.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert all(r.text == f"Story {r.page_id}" for r in got) and len(got) == 1200  # each advert on 60 pages, 5%


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        new = stage(spark, docs, SF).cache()
        assert new.columns == docs.columns, name
        if name == "exact":
            assert new.count() == docs.select("text").distinct().count()
        docs = new
    packed = corpus_pipeline.pack_sequences(spark, docs, SF)
    assert packed.where("piece = 0").count() == docs.count()
