"""Main text of pages: lines and zones, alignment, pairing, and whole pages against an independent reading."""

from __future__ import annotations

import html
import random
import re

import numpy as np
import pytest

from tallyline.llm import page_diff, queries

SCHEMA = "page_id long, url string, html string, text string, host string, place string"


def plain_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for k, y in enumerate(b):
            new.append(row[k] + 1 if x == y else max(row[k + 1], new[k]))
        row = new
    return row[-1]


def test_alignment_is_a_longest_common_subsequence():
    rng = random.Random(2)
    for _ in range(400):
        a = [rng.randint(0, 6) for _ in range(rng.randint(0, 14))]
        b = [rng.randint(0, 6) for _ in range(rng.randint(0, 14))]
        taken = page_diff.common_lines(np.array(a, np.uint64), np.array(b, np.uint64))
        picked = [x for x, t in zip(a, taken, strict=True) if t]
        rest = iter(b)
        assert len(picked) == plain_length(a, b) and all(x in rest for x in picked)
    long = np.arange(60_000, dtype=np.uint64)
    assert page_diff.common_lines(long, np.concatenate([long[::-1][:10], long[5:]])).sum() == 59_995


@pytest.mark.parametrize(("page", "kept"), [
    ("", []), ("no tags &amp; all", ["no tags & all"]), ("<p>a\n\t b<b>c</b><br>d<p>e", ["a bc", "d", "e"]),
    ("<nav>x</nav><p>a</p><div class='top ad'>y<div>z</div></div><p>b", ["a", "b"]),
    ("<article><h1>T</h1><aside>x</aside><p>p <span hidden>q</span> r</p><footer>f</footer></article>", ["T", "p", "r"]),
    ("<div class=has-sidebar><main><p>a</p><div id=comments><article>c</article></div></main></div>", ["a"]),
    ("<script>if (a < b) '</p>'</script>t<style>s</style><!-- c <p>d</p> -->u<textarea><p>x</textarea>", ["tu"]),
    ("a < b &lt;p&gt; &am &#233;&nbsp;x", ["a < b <p> &am é x"]), ("<p title='a>b' x=\"'\">k</p></nav></div>l", ["k", "l"]),
    ("<form>a<p>b</p></form><button>c</button>d<header>e</header><article><header>f</header>g</article>", ["d", "f", "g"]),
    ("<p class=it's>w</p>", ["w"]), ("<div role=main class=widget>m</div><p", ["m"]), ("x<article class=comment>c</article>", ["x"]),
])
def test_lines_and_zones(page, kept):
    assert [t for z, t in page_diff.lines_of(page) if z < page_diff.SITE] == kept


def as_pages(spark, rows, tmp_path):
    spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(4).write.parquet(str(tmp_path / "pages.parquet"))
    return str(tmp_path)


def got(spark, folder):
    rows = queries.op13_page_differencing(spark, folder).collect()
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    return sorted((r["page_id"] is None, r["page_id"], r["url"] or "", r["text"]) for r in rows)


def test_shared_lines_of_neighbours_go(spark, tmp_path):
    page = lambda *lines: "<body>" + "".join(f"<div>{x}</div>" for x in lines) + "</body>"
    rows = [(1, "http://a.org/x/1", page("Shop", "one", "Buy now", "two", "end")), (2, "http://A.org:80/x/2?q", page("Shop", "three", "Buy now", "end")),
            (3, "http://a.org/y", page("Shop", "other", "start")), (4, "http://b.org/x/1", page("Shop", "one", "end")),
            (5, None, page("Shop")), (6, "no address", page("Shop")), (7, "http://c.org/", None), (8, "http://c.org/1", ""), (None, "http://a.org/x/1", page("Shop", "one", "Buy now", "two", "end")),
            (9, "http://d.org/1", page("copy", "of")), (10, "http://d.org/2", page("copy", "of")),
            (11, "http://e.org/1", "<p>site<article><p>quoted</article>"), (12, "http://e.org/2", "<p>site<article><p>quoted<p>more</article>")]
    expected = {1: "one two", 2: "three", 3: "other start", 4: "Shop one end", 5: "Shop", 6: "Shop", 7: "", 8: "", 9: "copy of", 10: "copy of",
                11: "site quoted", 12: "quoted more", None: "one two"}
    assert {r[1]: r[3] for r in got(spark, as_pages(spark, rows, tmp_path))} == expected


def test_whole_pages_equal_an_independent_reading(spark, tmp_path):
    """Generated sites: menus repeat, hosts are uneven, one host has a third of the pages, rows repeat, one page is very long."""
    rng = random.Random(5)
    rows, expected = [], []
    for k in range(240):
        site = rng.choice([0, 0, 0, rng.randint(1, 30)])
        body = [f"w{rng.randint(0, 10**6)}  word{rng.randint(0, 9)}&eacute;\n{j}" for j in range(4000 if k == 7 else rng.randint(0, 6))]
        marked = site % 2 == 0
        inside = "".join(f"<p>{b}</p>" for b in body)
        own = f"<article>{inside}</article>" if marked else f"<div>{inside}</div>"
        menu = "".join(f"<div>Menu {j} of {site}</div>" for j in range(3))
        rows.append((k, f"https://s{site}.org/p/{k:04}", f"<html><head><title>t</title></head><body><nav>{k}</nav>{menu}{own}<div>Foot of {site}</div><footer>{k}</footer></body>"))
        expected.append((k, site, menu, [re.sub(r"\s+", " ", html.unescape(b)) for b in body]))
    rows += rows[:20]
    many = {s for s in range(31) if sum(e[1] == s for e in expected) > 1}
    bare = {e[0] for e in expected if not e[3]}
    found = got(spark, as_pages(spark, rows, tmp_path))
    assert len(found) == 260
    text = {r[1]: r[3] for r in found}
    for k, site, _, body in expected:
        menu = [f"Menu {j} of {site}" for j in range(3)]
        alone = " ".join([*menu, *body, f"Foot of {site}"])
        assert text[k] == (" ".join(body) if site in many and k not in bare else alone)


def test_no_pages(spark, tmp_path):
    assert got(spark, as_pages(spark, [], tmp_path)) == []
