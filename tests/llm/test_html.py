"""Main text of pages: markup by hand-made pages, the suffix array against naive search, hosts."""

import collections
import random

import numpy as np
import pytest

from tillroll.llm import html_text
from tillroll.llm.html_markup import blocks_of

PAGES = [  # (page, blocks)
    ('<div class="content has-sidebar"><p>text', ["text"]),
    ('<div class="post comments-open"><p>text</p></div>', ["text"]),
    ('<div id="side-effects"><p>text</p></div>', ["text"]),
    ('<div title="the hidden truth"><p>text</p></div>', ["text"]),
    ('<div class="hidden-gems"><p>text</p></div>', ["text"]),
    ("<p hidden>no<p hidden=until-found>found<p>yes", ["found", "yes"]),
    ('<form action="x"><input><article><p>text</article>', ["text"]),
    ("<form><p>text", ["text"]),
    ("<form><p>form</p></form><p>text", ["text"]),
    ("<form id=all><p>text</p></form>", ["text"]),
    ("<article><p>a</p><datalist><option value=a></datalist><p>after</p></article>", ["a", "after"]),
    ("<select><option>a<option>b</select><p>t", ["t"]),
    ('<p>text</p><p class="advert">no</p><p class="breadcrumb">no</p>', ["text"]),
    ('<table><tr><td class="sidebar">no<td>cell<tr><td>row</table>', ["cell", "row"]),
    ('<ul><li class="comment">no<li>item</ul>', ["item"]),
    ('<p>a <span class="ad">no</span>b</p><p>c<span class=ad>no<p>d', ["a b", "c", "d"]),
    ('<p>t</p><ol class="commentlist"><li>no</ol><a class="comment-reply-link">leave reply</a>', ["t"]),
    ('<p>t</p><article class="comment">no</article>', ["t"]),
    ('<article><p>real</p></article><section id="comments"><article><p>reader</article></section>', ["real"]),
    ('<div class="sidebar"><article><p>real</article></div>', ["real"]),
    ('<div class="banner"><p>only</div>', ["only"]),
    ('<div class="site-footer">no</div><div class="main-nav wide">no</div><p>t', ["t"]),
    ("<nav>x<p>y</nav><article><h1>T &amp; t</h1><p>a<br>b <b>c</b><div class='ad'>no</div>"
     "<script>var t='</p>';</script><p>d</article><footer>f</footer>", ["T & t", "a b c", "d"]),
    ("<header><h1>Site</h1></header><main><header><h1>T</h1></header>x</main>", ["T", "x"]),
    ("<p>one <b>bold <p>two</b> x &lt;&#x41;&nbsp; y", ["one bold", "two x <A y"]),
    ("<title>no</title><style>no</style><!-- no <p>no --><svg><text>no</text></svg><p>t", ["t"]),
    ("<script>no<p>no", []), ("", []), ("plain\n text", ["plain text"]), ("</p></div>a</b> <p", ["a <p"]),
]


@pytest.mark.parametrize("page,want", PAGES)
def test_markup(page, want):
    assert blocks_of(page)[0] == want


def test_very_long_and_deep_pages():
    assert blocks_of("<div>" * 3000 + "deep" + "</div>" * 3000)[0] == ["deep"]
    assert len(blocks_of("<p>word " * 50_000)[0]) == 50_000
    assert blocks_of("<p>" + "x" * 1_000_000)[0] == ["x" * 1_000_000]


def naive_suffixes(t):
    order = sorted(range(len(t)), key=lambda i: t[i:])
    common = [0]
    for a, b in zip(order, order[1:]):
        n = 0
        while max(a, b) + n < len(t) and t[a + n] == t[b + n]:
            n += 1
        common.append(n)
    return order, common


def test_suffix_array_against_sorting():
    rnd = random.Random(4)
    for n, kinds in ((1, 1), (2, 1), (40, 1), (60, 2), (80, 5), (100, 90)):
        t = [rnd.randrange(kinds) for _ in range(n)]
        array, common = html_text.suffix_array(np.array(t))
        assert (array.tolist(), common.tolist()) == naive_suffixes(t)


def test_repeats_against_naive_search():
    rnd = random.Random(6)
    for run, least in ((2, 2), (3, 3), (4, 2), (8, 2)):
        texts = ["\n\n".join(" ".join(rnd.choices("abc", k=rnd.randint(1, 9))) for _ in range(rnd.randint(0, 4)))
                 for _ in range(7)]
        pages = [rnd.randint(1, 3) for _ in texts]
        streams = [html_text.stream_of(t)[0].tolist() for t in texts]
        held = collections.defaultdict(dict)  # run -> text -> continuations
        for i, s in enumerate(streams):
            for k in range(len(s) - run + 1):
                held[tuple(s[k:k + run])].setdefault(i, []).append(s[k:])
        want = {}
        for key, found in held.items():
            n = sum(pages[i] for i in found)
            if n >= least:
                every = [c for cs in found.values() for c in cs]
                length = run
                while len({tuple(c[:length + 1]) for c in every}) == 1 and len(every[0]) > length:
                    length += 1
                at = int(html_text._run_hashes(np.array(key, np.uint64), np.array([0]), run)[0])
                want[at] = (length, n)
        got = html_text.repeats(texts, pages, least, run)
        assert {h: (n, p) for h, n, p in zip(got["hash"], got["length"], got["pages"])} == want


def test_blocks_go_as_a_whole_or_stay():
    menu, own = "home news about contact shop help terms login", "one two three four five six seven own"
    runs = html_text.repeats([menu], [1], 1)["hash"].to_numpy()
    assert html_text.without_boilerplate(f"{menu}\n\n{own}", runs) == own
    assert html_text.without_boilerplate(f"{menu} own\n\n{own}", runs) == f"{menu} own\n\n{own}"
    assert html_text.without_boilerplate(menu, runs) == "" and html_text.without_boilerplate("", runs) == ""


BOILER = "this site uses cookies to make your visit better please accept them all now"
MENU = ["Home", "News", "About", "Contact", "Shop"]


def words(tag, n):
    return " ".join(f"{tag}x{j}" for j in range(n))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "t", 1, "r") for r in rows], "page_id long, url string, html string, "
                                 "text string, n_chars long, runs string")


def test_plain_hosts_lose_what_their_pages_repeat(spark):
    menu = "".join(f"<div>{m}</div>" for m in MENU)
    rows = [(i, f"http://h.example.com/{i}", f"<body>{menu}<div><p>{BOILER}</p></div><div><p>page{i} "
             f"{words(f'w{i}', 30)}</p><p>Yes</p></div>") for i in range(40)]
    article = "copied article " + words("c", 40)
    rows += [(100 + i, "http://h.example.com/c", f"<p>{article}</p>") for i in range(30)]
    rows += [(None, None, None), (207, None, ""), (208, "http://z", f"<p>{BOILER}")]
    rows += [(300 + i, "http://s.example.com", f"<p>{BOILER} {words(f's{i}', 20)}") for i in range(10)]
    found = html_text.main_text(frame(spark, rows)).collect()
    text = {r.page_id: r.text for r in found}
    assert len(found) == len(rows) and all(r.n_chars == len(r.text) for r in found)
    assert {text[i] for i in range(40)} == {f"page{i} {words(f'w{i}', 30)}\n\nYes" for i in range(40)}
    assert text[100] == article  # copies aren't boilerplate
    assert text[None] == "" and text[207] == "" and text[208] == BOILER
    # articles that open alike keep their opening
    assert {text[300 + i] for i in range(10)} == {f"{BOILER} {words(f's{i}', 20)}" for i in range(10)}


def test_named_articles_keep_everything_and_tell_menus(spark):
    opening = "<p>Dear readers here is again our letter about gardens and what grows in them</p>"
    menu = f"<ul>{''.join(f'<li>{m}' for m in MENU)}</ul><div>{BOILER}</div>"
    rows = [(i, "http://h/p", f"<nav>{menu}</nav><article>{opening}<p>{words(f'a{i}', 12)}</article>")
            for i in range(12)]
    rows += [(50, "http://h/q", f"<div>{menu}</div><div>{words('b', 12)}</div>")]  # nothing but the host tells
    text = {r.page_id: r.text for r in html_text.main_text(frame(spark, rows)).collect()}
    assert all(text[i] == f"{opening[3:-4]}\n\n{words(f'a{i}', 12)}" for i in range(12))
    assert text[50] == words("b", 12)


@pytest.mark.parametrize("groups", [{"group_pages": 4}, {"group_chars": 600}, {}])
def test_groups_find_what_the_whole_host_has(spark, groups):
    rows = [(i, f"<p>{BOILER}</p><p>page{i} {words(f'w{i}', 30)}") for i in range(24)]
    rows += [(100 + i, "<p>copied " + words("c", 40)) for i in range(300)]
    pages = html_text.parsed(frame(spark, [(i, "http://h/p", h) for i, h in rows]))
    found = html_text.host_boilerplate(pages, **groups).collect()
    want = set(html_text.repeats([BOILER], [1], 1)["hash"].tolist())
    assert [set(r.runs) >= want for r in found] == [True] and found[0].parts == (1 if not groups else found[0].parts)
    assert len(found[0].runs) <= len(want) + 2


def test_edge_tables(spark):
    assert html_text.main_text(frame(spark, [])).collect() == []
    got = html_text.main_text(frame(spark, [(1, "http://h", "<p>a"), (1, "http://h", "<p>a"), (None, "", "<p>b")]))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(r.text for r in got.collect()) == ["a", "a", "b"]
