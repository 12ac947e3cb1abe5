"""Page text against a plain version of the same rule, and on deep, broken and odd pages."""

import random
import time
from collections import Counter, defaultdict

import pytest

from tidepanel.llm import html

SCHEMA = "page_id bigint, url string, html string, host string, code int, codes string, row int"  # clash with names used inside


def extract(spark, rows, **options):
    pages = spark.createDataFrame([(*r, "h", 1, "c", 2) for r in rows], SCHEMA)
    return {r.page_id: r for r in html.extract(pages, **options).collect()}


@pytest.mark.parametrize("page", ["<div>" * 50_000 + "end", "<b>" * 50_000 + "end", '<a "' * 250_000, "<a b='>' " * 100_000, "<![CDATA[" * 100_000, "<ul><li><ul>" + "<b>" * 30_000 + "<li></li>" * 30_000 + "end"])
def test_deep_and_broken_pages_take_linear_time(page):
    start = time.perf_counter()
    nodes = html.tree(page)
    html.coded(nodes)
    found = html.blocks(page)
    assert time.perf_counter() - start < 20 and (not page.endswith("end") or found[-1] == "end")


def test_words_in_ids_do_not_remove_text():
    page = '<article><h2 id="form-and-function">F</h2><p id="social-life">S</p><section id="notice-of-1800"><p>N</p></section><div id="comments">x</div><ul class="comment-list"><li>y</ul><div class="cookie-banner"><p>z</div></article>'
    assert html.blocks(page) == ["F", "S", "N"]
    assert html.blocks('a < b <p>x <a href="y>z">w</a> 5<6</p><p>q <a href="unclosed>r</a> s<br>t<!-- u --><table><tr><td>1<td>2<tr><td>3</table>') == ["a < b", "x w 5<6", "q r s t", "1", "2", "3"]
    assert html.blocks("x &lt;b&gt; &amp;amp;   y<unfinished") == ["x <b> &amp; y"]


def test_only_recurrence_tells_template_from_text(spark):
    """Hosts whose markup names nothing; a plain version of the rule, page by page."""
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(4))
    line = lambda n: " ".join(word() for _ in range(n))
    rows, want = [], {}
    for host, (pages, adverts) in enumerate(((4, 1), (30, 3), (400, 7))):
        menu, ads, end = f"<div><ul><li>{line(2)}</li><li>{line(1)}</li></ul></div>", [f"<div><span>{line(3)}</span></div>" for _ in range(adverts)], f"<div>{line(6)}</div>"
        for i in range(pages):
            text = [line(draw.randint(2, 30)) for _ in range(draw.randint(1, 4))]
            body = "".join(f"<p>{t}</p>" for t in text)
            rows.append((len(rows), f"https://h{host}.org/{i}", f"<html><body>{menu}<div>{draw.choice(ads)}{body}</div>{end}</body></html>"))
            want[len(rows) - 1] = "\n".join(text)
    got = extract(spark, rows)
    assert {i: r.text for i, r in got.items()} == want and all(r.n_chars == len(r.text) for r in got.values())
    off = extract(spark, rows, min_pages=10**6, min_share=2.0)  # without the rule for shares
    assert any(off[i].text != want[i] for i in want if rows[i][1].startswith("https://h1"))


def test_templates_equal_a_plain_count(spark):
    draw = random.Random(7)
    pieces = [f"<div><span>{k}</span></div>" for k in range(12)]
    rows = []
    for i in range(160):
        some = [draw.choice(pieces) for _ in range(draw.randint(0, 3))] + [f"<p>own {i}</p>"] * (i % 7 > 0)
        rows.append((i, f"http://h{i % 3 if i % 5 else 0}.net/", "".join(some)))
    rows += [(200 + i, "http://h1.net/x", rows[1][2]) for i in range(40)] + [(300, None, None), (301, "", ""), (302, "x", "y" * 200_000), (302, "x", "y" * 200_000)]
    pages, seen = defaultdict(set), defaultdict(set)
    for _, u, t in rows:
        host = (u or "").partition("//")[2].partition("/")[0]
        nodes = html.tree(t or "")
        content = html.content_hash(nodes)
        pages[host].add(content)
        for code in set(html.coded(nodes).values()):
            seen[host, code].add(content)
    want = Counter()
    for i, u, t in rows:
        host = (u or "").partition("//")[2].partition("/")[0]
        k = len(pages[host])
        found = {c: len(x) for (h, c), x in seen.items() if h == host and ((len(x) >= 5 and len(x) >= 0.1 * k) or (len(x) >= 3 and len(x) >= 0.6 * k) or len(x) >= 50)}
        own = set(html.coded(html.tree(t or "")).values())
        want[i, "\n".join(html.blocks(t, {c: n for c, n in found.items() if c in own}))] += 1
    frame = spark.createDataFrame([(*r, "h", 1, "c", 2) for r in rows], SCHEMA)
    assert Counter((r.page_id, r.text) for r in html.extract(frame).collect()) == want
    assert html.extract(frame.limit(0)).count() == 0


def test_a_page_that_stands_often_keeps_its_body(spark):
    rows = [(i, f"http://a.org/{i}", f"<div><span>menu {i % 4}</span></div><div><p>Same story</p></div>" if i < 30 else f"<div><span>menu {i % 4}</span></div><div><p>Story {i}</p></div>") for i in range(100)]
    got = extract(spark, rows)
    assert all(got[i].text == ("Same story" if i < 30 else f"Story {i}") for i in got)
    quoted = [(i, f"http://b.org/{i}", f"<article><h1>Title {i}</h1><div><p>A shared passage</p></div></article>") for i in range(12)]
    assert all(r.text == f"Title {i}\nA shared passage" for i, r in extract(spark, quoted).items())
