"""Differencing of every page against a plain version, odd markup, long pages."""

import time
from urllib.parse import urlsplit

import numpy as np
import pytest

from barsignal.llm import html_text
from barsignal.llm.common import prepare


@pytest.mark.parametrize("page, lines", [
    ("<article><p title=it's>One</p><p>Two's</p></article>", ["One", "Two's"]),
    ('<p title="the hidden truth">A<p data-id="comments">B<p data-hidden="0">C<p hidden>no<p HIDDEN=x>no<p>D', ["A", "B", "C", "D"]),
    ('<article><section class="discussion"><p>x</p></section><div class="related-work">z</div><div class="related-posts">no</div></article>', ["x", "z"]),
    ("<p>if a <b and c</p><p>y</p>", ["if a <b and c", "y"]),
    ("<p class=a\"b>t<p class=\"c>u</p><p>v", ["t", "u", "v"]),
    ("<p title='a>b' class = \"ad\">no</p><p title=\"a > b\">x</p>", ["x"]),
    ("<p>a < b << c <3</p>", ["a < b << c <3"]),
])
def test_odd_markup(page, lines):
    assert html_text.page_lines(page)[0] == lines


def test_long_pages_are_aligned_in_seconds():
    began = time.time()
    assert len(html_text.common_lines(["x"] * 20_000, ["x"] * 19_000)) == 19_000
    mixed = [k % 7 for k in range(20_000)]
    assert html_text.common_lines(mixed, mixed) == list(range(20_000))
    assert html_text.common_lines([], [1]) == html_text.common_lines([1], []) == html_text.common_lines([1], [2]) == []
    html_text.page_lines("<p>" + "<b a='" * 50_000 + "</p>" + "<" * 50_000 + "<p>end")
    assert time.time() - began < 20


def brute(rows: list[tuple]) -> dict[int, str]:
    """Texts by the rule of the module, host by host."""
    pages, hosts = {}, {}
    for page, url, source in rows:
        lines, places, marked = html_text.placed_lines(source)
        where = urlsplit(url)
        keys = tuple(lines)
        pages[page] = (where.netloc, keys, lines, marked)
        if keys:
            held = hosts.setdefault(where.netloc, {})
            held[keys] = min(held.get(keys, (where.path, places)), (where.path, places))
    gone = {}
    for host, classes in hosts.items():
        order = sorted((path, keys, places) for keys, (path, places) in classes.items())
        shared = []
        for at, (path, keys, _) in enumerate(order):
            near = [order[k] for k in (at - 1, at + 1) if 0 <= k < len(order)]
            near = max(near, key=lambda p: html_text._prefix(path, p[0]), default=None)
            shared.append(html_text.common_lines(list(keys), list(near[1])) if near else [])
        folders = [path.rpartition("/")[0] for path, _, _ in order]
        for at, (_, keys, places) in enumerate(order):
            for k in shared[at]:
                def held(scope, key=(keys[k], places[k]), order=order, shared=shared):
                    return sum(any((order[o][1][i], order[o][2][i]) == key for i in shared[o]) for o in scope)
                everywhere = range(len(order))
                beside = [o for o in everywhere if folders[o] == folders[at]]
                wide = 2 * held(everywhere) >= len(order)
                if wide and held(everywhere) >= 3:
                    gone.setdefault((host, keys, True), set()).add(k)
                if wide and held(everywhere) >= 2 or 2 * held(beside) >= len(beside) and held(beside) >= 2:
                    gone.setdefault((host, keys, False), set()).add(k)
    return {
        page: "\n".join(x for k, x in enumerate(lines) if k not in gone.get((host, keys, marked), ()))
        for page, (host, keys, lines, marked) in pages.items()
    }


def test_differencing_equals_brute_force(spark):
    prepare(spark)
    rng = np.random.default_rng(11)
    rows = []
    for k in range(400):
        site, part = int(rng.integers(0, 5)), int(rng.integers(0, 3))
        own = [f"<p>own {rng.integers(0, 150)} of site {site}</p>" for _ in range(int(rng.integers(0, 5)))]
        parts = [f"<p>site {site}</p>", f"<div>part {part}</div>" if part else "", *own, "<p>shared by some</p>" if k % 4 == 0 else "", f"<p>end {site}</p>"]
        body = "".join(parts)
        if site % 2:
            body = f"<article>{body}</article>"
        if k % 3 == 0:
            body = body.replace("<p>shared", "<div>shared")
        # Paths are unique, so that the order is.
        rows.append((k, f"http://h{site}.example/{part}/{k:03}", f"<body>{body}</body>"))
    rows.append((500, "http://alone.example/x", "<p>alone</p>"))
    want = brute(rows)
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.main_text(df).collect()}
    assert got == want
    texts = "\n".join(want.values())
    assert "shared by some" in texts and "site 1\n" not in texts.replace("of site 1\n", "") and want[500] == "alone"


def test_lines_shared_with_few_pages_stay_and_templates_in_articles_go(spark):
    prepare(spark)

    def page(k):
        common = "<p>A paragraph of two articles</p>" if k in (3, 4) else ""
        return f"<article><p>Read our letter</p><p>Story {k}</p>{common}<p>It ends {k}</p></article>"

    rows = [(k, f"http://h.example/{k}", page(k)) for k in range(8)]
    # The same line elsewhere in the markup is not the template's.
    rows.append((8, "http://h.example/8", "<article><ul><li>Read our letter</li></ul><p>Story 8</p></article>"))
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == "Story 0\nIt ends 0"
    assert got[3] == "Story 3\nA paragraph of two articles\nIt ends 3"
    assert got[8] == "Read our letter\nStory 8"
