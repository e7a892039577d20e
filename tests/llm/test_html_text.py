import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmill.llm.html_text import _ratios, blocks, extract_text, main_text

LONG = "A sentence with some words, and more of them; it goes on. " * 4


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain &amp; simple &eacute; &#233;", "plain & simple é é"),
        ("<article><h1>T</h1><p>one\n  two<br>three</p><p>four</p></article>", "T\n\none two three\n\nfour"),
        ("<nav>menu</nav><article><p>x</p></article><footer>f</footer>", "x"),
        ("<article><header><h1>T</h1></header><p>x</p><aside>z</aside><form>q</form></article>", "T\n\nx"),
        ("<article>a &lt;b&gt; <b>bold</b>text<ul><li>one<li>two</ul></article>", "a <b> boldtext\n\none\n\ntwo"),
        ('<script>var t="</p>";</script><style>p{}</style><article><p>x</p></article>', "x"),
        ('<article><p>x</p><div class="ad">buy</div><section id="comments"><p>first!</p></section></article>', "x"),
        ('<article><p>x</p><p hidden>y</p><div role="navigation">z</div></article>', "x"),
        ("<article><p><b>never closed<br><p>next</article><footer>f", "never closed\n\nnext"),
        ("<article><p>x<!-- <p>gone</p> --></p><!-- open", "x"),
        ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a\n\nb\n\nc"),
    ],
)
def test_pages(page, text):
    assert main_text(page) == text


def test_a_page_without_an_article():
    page = (
        '<body class="has-sidebar"><div id="top"><ul class="menu"><li>Home</li></ul></div>'
        f'<div id="content"><h2>Title</h2><p>{LONG}</p><p>{LONG}</p><p>Short.</p></div>'
        '<div class="sidebar"><p>Side story.</p></div><div class="cookie-notice">We use them.</div></body>'
    )
    long = LONG.strip()
    assert main_text(page) == f"Title\n\n{long}\n\n{long}\n\nShort."


def test_links_beside_the_text_are_below_the_threshold():
    links = "".join(f"<li><a href=/{k}>item {k}</a></li>" for k in range(30))
    page = f"<div><ul>{links}</ul></div><div><p>{LONG}</p><p>{LONG}</p></div>"
    assert main_text(page) == f"{LONG.strip()}\n\n{LONG.strip()}"


@pytest.mark.parametrize(
    "part",
    [
        '<h2 id="related-work">{}</h2>',
        '<h3 id="social-impact">{}</h3>',
        '<h2 class="related">{}</h2>',
        '<p class="notice">{}</p>',
        '<section id="discussion"><h2>{}</h2><p>Short.</p></section>',
        '<div class="related"><p>{}</p></div>',
    ],
)
def test_a_name_of_a_part_does_not_drop_the_articles_own_text(part):
    page = f"<article><p>{LONG}</p>{part.format(LONG)}<p>{LONG}</p></article>"
    assert main_text(page).count(LONG.strip()) == 3


@pytest.mark.parametrize(
    "wrapper",
    [
        '<div class="content no-sidebar">',
        '<div id="wrapper" class="has-sidebar">',
        '<div class="with-comments">',
        '<div class="sidebar">',
        '<div id="navigation"><div class="social">',
    ],
)
def test_a_named_element_that_holds_the_page_is_kept(wrapper):
    assert main_text(f"<body>{wrapper}<h1>T</h1><p>{LONG}</p><p>{LONG}</p>") == f"T\n\n{LONG.strip()}\n\n{LONG.strip()}"


@pytest.mark.parametrize(
    "part",
    [
        '<div class="sidebar">{}</div>',
        '<div class="post-comments">{}</div>',
        '<ul class="related-posts"><li>One</li><li>Two</li></ul>',
        '<div class="box social"><div class="share">Tell</div></div>',
        '<div class="cookie-notice">{}</div>',
    ],
)
def test_named_parts_are_dropped(part):
    text = f"<p>{LONG}</p>" * 6
    wrapped = f'<div class="has-sidebar"><article>{text}{part.format("Some words. " * 9)}</article></div>'
    assert main_text(wrapped) == "\n\n".join([LONG.strip()] * 6)


def test_many_comments_do_not_make_them_the_article():
    comments = f"<div>{LONG}</div>" * 50
    assert main_text(f'<body><article><p>{LONG}</p></article><div id="comments">{comments}</div>') == LONG.strip()


STORY = [
    "The river rose again on Tuesday, and the lower town was cut off for the second time this month, officials said.",
    "Engineers had warned that the old dam, built in 1931, would not hold; repairs were put off three times since then.",
    "Farmers moved their herds to higher ground. Some had lost their barns in spring, and nobody wanted to wait again.",
    "The council met in the evening. It was short, loud and without result, as several of those present told us.",
    "For now there are sandbags, pumps and patience: the forecast promises four more days of rain.",
]
SAID = ["Great piece, thanks!", "I disagree with the second point.", "My uncle lives there. Sad."]
THREADS = {
    "paragraphs": "".join(f"<p>{said}</p>" for said in SAID),
    "names": "<h3>3 voices</h3>" + "".join(f"<div class=c><b>{who}</b><p>{said}</p></div>" for who, said in zip(["Ann", "Bob Lee", "Çem"], SAID)),
    "times": "".join(f"<li><cite>{who}</cite> <time>2024-03-07</time><p>{said}</p></li>" for who, said in zip(["ann77", "bob", "x"], SAID)),
    "two": "".join(f"<section><p>{said}</p><p>ann, 2 days ago</p></section>" for said in SAID[:2]),
}


def places(part):
    """The story with a part inside and beside its article, and on a page without articles."""
    text = "".join(f"<p>{block}</p>" for block in STORY)
    return [
        f"<body><article>{text}{part}</article></body>",
        f"<body><article>{text}</article>{part}</body>",
        f"<body><div class=x>{text}</div>{part}</body>",
        f"<body><div class=x>{text}{part}</div></body>",
    ]


@pytest.mark.parametrize("thread", THREADS)
@pytest.mark.parametrize(
    "name",
    "comment reader-comments userComments commentlist comment-section reader-responses feedback c-thread reviews talkback comments".split(),
)
def test_readers_comments_are_dropped(name, thread):
    for page in places(f'<div class="{name}">{THREADS[thread]}</div>'):
        assert main_text(page) == "\n\n".join(STORY)


@pytest.mark.parametrize("thread", [name for name in THREADS if name != "paragraphs"])
@pytest.mark.parametrize("wrapper", ['<div class="zq17">{}</div>', "<div>{}</div>", '<div id="k"><div>{}</div></div>', "{}"])
def test_readers_comments_without_a_name_are_dropped(wrapper, thread):
    for page in places(wrapper.format(THREADS[thread])):
        assert main_text(page) == "\n\n".join(STORY)


@pytest.mark.parametrize(
    "name",
    "left-sidebar sidebar-left widget-area ad-slot adbox site-notice notice newsletter related-posts main-menu popup sponsored-content".split(),
)
@pytest.mark.parametrize("text", ["Our weekly letter, free.", "Sign up for our weekly letter and never miss a story, it is free."])
def test_sidebars_adverts_and_notices_are_dropped(name, text):
    for page in places(f'<div class="{name}"><p>{text}</p></div>'):
        assert main_text(page) == "\n\n".join(STORY)


@pytest.mark.parametrize(
    "part",
    [
        # By-lines before content, headings, long text, sentences and lists of terms make no thread.
        "<div class=c><b>Ann</b><p>Short words.</p></div><div class=c><b>Bob</b><p>Short words.</p></div><div class=c><b>Cy</b><p>Short.</p></div>"
        f"<p>{STORY[0]}</p>",
        "<div><h3>Ann</h3><p>2024-01-02</p><p>Short.</p></div><div><h3>Bob</h3><p>2024-01-03</p><p>Short.</p></div>",
        f"<div><p>Ann</p><p>{STORY[0]}</p></div><div><p>Bob</p><p>{STORY[1]}</p></div><div><p>Cy</p><p>{STORY[2]}</p></div>",
        "<ul><li>It rains.<p>Short words.</p></li><li>It pours.<p>Short words.</p></li></ul>",
        "<ul><li><b>Dam</b><p>A wall.</p></li><li><b>Pump</b><p>A machine.</p></li></ul>",
        "<table><tr><td>Ann<td>2024-01-02<tr><td>Bob<td>2024-01-03</table>",
        '<div class="no-comments"><p>Short words.</p></div>',
    ],
)
def test_other_parts_of_an_article_are_kept(part):
    plain = [text for _, text in blocks(part)]
    assert main_text(places(part)[0]) == "\n\n".join(STORY + plain)


def test_a_page_of_nothing_but_short_posts_is_kept():
    page = f"<body><div>{THREADS['names']}</div></body>"
    assert all(said in main_text(page) for said in SAID)


@settings(max_examples=200, deadline=None)
@given(
    parts=st.lists(
        st.tuples(st.lists(st.sampled_from(["div", "section", "p"]), min_size=1, max_size=3), st.text("ab .,;", min_size=1, max_size=30)),
        min_size=1,
        max_size=12,
    )
)
def test_ratios_equal_brute_force(parts):
    """A path's ratio is the mean over all blocks of equal path; smoothing is a weighted mean of five neighbours."""
    parts = [([t for t in path if t != "p"] + ["p"], " ".join(text.split())) for path, text in parts]
    parts = [(path, text) for path, text in parts if text]
    page = "".join("".join(f"<{t}>" for t in path) + text + "".join(f"</{t}>" for t in path[::-1]) for path, text in parts)
    found = blocks(page)
    assert [text for _, text in found] == [text for _, text in parts]

    def ratio(i, measure):
        same = [measure(text) for path, text in parts if path == parts[i][0]]
        return sum(same) / len(same)

    def smooth(i, measure):
        near = [(j, 3 - abs(i - j)) for j in range(i - 2, i + 3) if 0 <= j < len(parts)]
        return sum(ratio(j, measure) * w for j, w in near) / sum(w for _, w in near)

    def points(text):
        return sum(char in ".,;" for char in text)

    if found:
        smoothed, own = _ratios(found)
        for i in range(len(parts)):
            assert smoothed[i] == pytest.approx(smooth(i, len) * (1 + smooth(i, points)))
            assert own[i] == pytest.approx(ratio(i, len) * (1 + ratio(i, points)))


TEASERS = "<article><p>Teaser one, short.</p></article><article><p>Teaser two.</p></article>"


@pytest.mark.parametrize("count", [1, 7, 20, 40, 200])
@pytest.mark.parametrize("entry", ['<div class="entry">{}</div>', "{}", "<div><div>{}</div></div>"])
def test_teasers_in_articles_do_not_displace_the_text_beside_them(count, entry):
    page = f"<body>{entry.format(f'<p>{LONG}</p>' * count)}{TEASERS}</body>"
    assert main_text(page).count(LONG.strip()) == count
    if count >= 40:
        assert "Teaser" not in main_text(page)


def test_articles_and_heavy_text_beside_them_are_all_kept():
    text = f"<p>{LONG}</p>"
    page = f"<body><div>{text * 3}</div><article>{text * 5}</article><ul><li>a link</ul><article><h2>B</h2>{text}</article><div>{text * 4}</div>"
    assert main_text(page).count(LONG.strip()) == 13
    assert "\n\nB\n\n" in main_text(page) and "a link" not in main_text(page)


def test_short_text_beside_an_article_is_left_out():
    page = f"<body><div>Top line</div><article><h1>T</h1>{f'<p>{LONG}</p>' * 30}<p>End.</p></article><div>Last line</div>"
    assert main_text(page) == "\n\n".join(["T", *[LONG.strip()] * 30, "End."])


def test_one_long_block_beside_an_article_does_not_displace_it():
    page = f"<body><article>{f'<p>{LONG}</p>' * 30}</article><div>{LONG * 9}</div>"
    assert main_text(page).count(LONG.strip()) >= 30


@pytest.mark.parametrize("part", ["<", "<!--", "<a href='", '<div class="', "<p>", "<div><b>", "</p>", "<script>", "&", "<!"])
def test_hostile_markup_takes_linear_time(part):
    start = time.perf_counter()
    main_text(part * 20_000)
    assert time.perf_counter() - start < 20


def test_odd_rows(spark):
    rows = [(1, "u", None, "t"), (None, None, "", "t"), (2, "u", "<p>x</p>", "t"), (2, "u", "<p>x</p>", "t"), (3, "u", "<p>" + "y " * 300_000, "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = extract_text(pages)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(((row["page_id"] or 0), row["text"][:3], row["n_chars"]) for row in out.collect())
    assert got == [(0, "", 0), (1, "", 0), (2, "x", 1), (2, "x", 1), (3, "y y", 599_999)]
    assert extract_text(pages.limit(0)).count() == 0


def test_pages_of_the_tables(spark, small):
    """The test pages are an article between menu, advert and footer; its blocks are cut by p and h1."""
    import html
    import re

    for row in spark.read.parquet(f"{small}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", row["html"], re.DOTALL)[1]
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", " ", x))).strip() for x in re.split(r"</?(?:p|h1)>", article)]
        assert main_text(row["html"]) == "\n\n".join(x for x in parts if x)
