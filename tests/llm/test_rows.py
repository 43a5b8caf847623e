"""Operators that look at one row at a time: URL filter and HTML text."""

import pytest
from pyspark.sql import functions as F

from perilscope.llm import html_text, url_filter
from tests.llm.conftest import rows_of

URLS = [
    (1, "https://news.example.org/en/12?x=1"),
    (2, "http://EXAMPLE.ORG/es/a#b"),
    (3, "https://a.b.example.org/en/99"),
    (4, "https://shop.com/de/x"),
    (5, "https://shop.com/fr/casino"),
    (6, "https://best-casino.net/"),
    (7, "https://bestcasino.net/"),
    (8, "https://free.net/win"),
    (9, "https://free.net/free?free=free"),
    (10, "https://freedom.net/winter"),
    (11, None),
    (12, ""),
    (13, "no scheme casino"),
    (14, "https://org"),
    (15, "https://org:80/x"),
    (16, "x://y://example.org/en/1"),
    (17, "https://notexample.org/es/"),
    (17, "https://notexample.org/es/"),
    (None, "https://t.net/" + "a" * 50_000 + "/xxx"),
]
WANT = {
    1: ("example.org/en/1", "block"), 2: ("example.org/es/", "block"), 3: ("org/", "allow"), 4: ("com/de/", "block"),
    5: ("com/fr/", "allow"), 6: (None, "block"), 7: (None, "allow"), 8: (None, "block"), 9: (None, "allow"),
    10: (None, "allow"), 11: (None, "allow"), 12: (None, "allow"), 13: (None, "block"), 14: (None, "allow"),
    15: (None, "allow"), 16: (None, "allow"), 17: ("org/", "allow"), None: (None, "block"),
}


def test_urls(spark):
    pages = spark.createDataFrame(URLS, "page_id bigint, url string")
    found = url_filter.judge(pages).collect()
    assert len(found) == len(URLS)
    for row in found:
        assert (row["rule"], row["verdict"]) == WANT[row["page_id"]], row["url"]
    by_id = {r["page_id"]: r for r in found}
    assert (by_id[2]["host"], by_id[2]["path"]) == ("example.org", "/es/a")
    assert (by_id[13]["host"], by_id[13]["path"]) == ("", "") and (by_id[14]["host"], by_id[14]["path"]) == ("org", "")
    assert (by_id[16]["host"], by_id[16]["path"]) == ("y:", "//example.org/en/1")


def test_url_columns(spark):
    pages = spark.createDataFrame([(1, "https://casino.net/", "own", "x", 3)], "page_id bigint, url string, rule string, more string, n_soft int")
    judged = url_filter.judge(pages)
    assert judged.columns == ["page_id", "url", "more", "host", "path", "rule", "n_strict", "n_soft", "soft_weight", "verdict"]
    assert rows_of(judged, "more", "rule", "n_strict", "verdict") == [("x", None, 1, "block")]
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_soft_terms_are_counted_once():
    assert url_filter.hits("free free win", ("xxx",), ("free", "win")) == (set(), {"free", "win"})
    assert url_filter.hits("freexxx", ("xxx",), ("free",)) == (set(), set())


# Written from what such addresses look like, not from the lists.
UNWANTED = (
    "http://blog.adult-x.example.net/de/3672/", "https://free-bets.example.com/de/3008?page=2&ref=x", "https://online-casinos.net/",
    "https://a.net/adult-videos/12", "https://adultdating.net/", "https://sexy-girls.net/", "https://x-rated.net/a", "https://pornstars.net/",
    "https://a.net/milfs", "https://erotic-nudes.net/", "https://a.net/sportsbooks", "https://poker-bonuses.net/", "https://a.net/lotteries/jackpots",
    "https://gambling.net/betting", "https://online-pharmacy.net/", "https://a.net/cheapest-pill", "https://buy-meds.net/", "https://a.net/kamagra",
    "https://spammers.net/", "https://a.net/torrents/1", "https://cheap-replicas.net/", "https://a.net/payday/deals", "https://adverts.net/click",
    "https://a.net/banners/tracking", "https://a.net/popups?sponsor=1", "https://coupons.net/promotions",
)
ORDINARY = (
    "https://council.gov/adult-social-care", "https://college.edu/adult-education/courses", "https://essex.ac.uk/", "https://a.net/betsy/better",
    "https://middlesex.net/", "https://a.net/track-and-field", "https://a.net/pharmacy/opening", "https://a.net/deals/deal", "https://a.net/win/wins",
    "https://a.net/farms/12?ref=x", "https://a.net/bets", "https://a.net/addresses", "https://a.net/tracks/tracking", "https://a.net/sexton",
    "https://a.net/x/adult", "https://a.net/advertising/adverts", "https://young-adult.net/books?page=2&ref=x", "https://a.net/casinova",
)


def test_topics_in_their_forms(spark):
    pages = spark.createDataFrame([(1, url) for url in UNWANTED] + [(0, url) for url in ORDINARY], "page_id bigint, url string")
    wrong = [r["url"] for r in url_filter.judge(pages).collect() if r["verdict"] != ("block" if r["page_id"] else "allow")]
    assert wrong == []


# Addresses of authorities, shops, clubs and papers that speak of such things, and names written with digits.
SPEAKING_OF_IT = (
    "https://fsa.usda.gov/farm-loan-programs", "https://ftc.gov/how-recognize-phishing", "https://cisa.gov/phishing", "https://microsoft.com/security/malware",
    "https://fda.gov/drugs/pharmacy", "https://dea.gov/drugs/steroids", "https://nba.com/tracker/winners", "https://books.net/young-adult/winners",
    "https://recipes.net/spam-fried-rice", "https://torrent.fr/riviere-torrent", "https://bank.net/loans/offers", "https://shop.net/deals/discounts",
    "https://nobel.net/prize/winners", "https://airport.net/slots", "https://dairy.net/farm/buy", "https://athletics.net/track/winners",
    "https://parcel.net/tracking/offers", "https://consumer.gov/scams/phishing", "https://clinic.net/steroids", "https://museum.net/naked-truth",
)
WITH_DIGITS = ("https://bet365.net/free/12", "https://casino777.net/", "https://free-money-slots77.net/", "https://xxx18.net/", "https://poker24.net/bets")


def test_ordinary_words_and_digits(spark):
    rows = [(0, url) for url in SPEAKING_OF_IT] + [(1, url) for url in WITH_DIGITS]
    judged = url_filter.judge(spark.createDataFrame(rows, "page_id bigint, url string")).collect()
    assert [r["url"] for r in judged if r["verdict"] != ("block" if r["page_id"] else "allow")] == []


def test_weights_add_up(spark):
    pages = spark.createDataFrame([("http://a.net/bets/free/win",), ("http://a.net/win/deal",), ("http://a.net/bets",)], "url string")
    assert [(r["n_soft"], r["soft_weight"], r["verdict"]) for r in url_filter.judge(pages).collect()] == [(3, 5, "block"), (2, 2, "allow"), (1, 2, "allow")]


def test_forms_of_a_word_are_one_term():
    assert url_filter.hits("bet/bets/betting", (), ("(bet|bets|betting)",)) == (set(), {"(bet|bets|betting)"})
    seen = [form for term in url_filter.STRICT + url_filter.SOFT + url_filter.WEAK for form in term.strip("()").split("|")]
    assert len(seen) == len(set(seen)), "a form that two terms share would be counted for one of them only"


ARTICLE = "<h1>A title here</h1><p>First   paragraph of the\n article text.</p><p>Second one, with <b>bold</b> and <a href=x>a link</a>.</p>"
TEXT = "A title here First paragraph of the article text. Second one, with bold and a link."
MENU = "<ul>" + "".join(f"<li><a href='/{n}'>Menu item {n}</a></li>" for n in range(12)) + "</ul>"


@pytest.mark.parametrize(
    ("html", "want"),
    [
        (None, ""),
        ("", ""),
        ("<html><body></body></html>", ""),
        ("plain text only", "plain text only"),
        (f"<html><head><title>T</title><style>p{{}}</style></head><body><nav>{MENU}</nav><article>{ARTICLE}</article><footer>F</footer></body></html>", TEXT),
        (f"<body><div class='top-menu'>{MENU}</div><div id=main>{ARTICLE}</div><div class='side sidebar'>Some other text in a bar</div></body>", TEXT),
        (f"<body>{MENU}<div>{ARTICLE}</div><script>var t='</p>';</script></body>", TEXT),
        (f"<body><div>{ARTICLE}<!-- a <p>comment</p> --><form><p>Name</p><input></form></div><div id=comments><p>Reader says a lot of words here</p></div>", TEXT),
        (f"<body><div class=cookieNotice>We use cookies to do this and that.</div><main>{ARTICLE}</main><aside>Aside text</aside>", TEXT),
        ("<article><p>one<p>two<br>three<ul><li>four<li>five</ul></article>", "one two three four five"),
        ("<article><p>caf&eacute; &amp; &#233;&nbsp;&lt;b&gt;</p></article>", "café & é <b>"),
        ("<article><p>un<b>clos<i>ed</b> and </i>stray</span></p></div>text</article>", "unclosed and stray text"),
        ("<article><p>before</p><script>never closed <p>x</p>", "before"),
        ("<article><p>before</p><!-- never closed <p>x</p>", "before"),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
    ],
)
def test_main_text(html, want):
    assert html_text.main_text(html) == want


SIDE = "<div class='sidebar'>Some text of the bar</div>"


@pytest.mark.parametrize(
    "html",
    [
        f"<article class='post comments-open'>{ARTICLE}</article>",
        f"<body><div class='page has-sidebar'><div class=text>{ARTICLE}</div>{SIDE}</div></body>",
        f"<main class='search-results'>{ARTICLE}</main>{SIDE}",
        f"<article class='search'>{ARTICLE}</article>{SIDE}",
        f"<main id=comments>{ARTICLE}</main>",
        f"<body><div class='widget'><div>{ARTICLE}</div></div>{SIDE}</body>",
        f"<body><div class='sidebar'><main>{ARTICLE}</main></div><div><a href=x>{'Linked words. ' * 30}</a></div></body>",
        f"<article>{ARTICLE}</article><div id=comments><p>{'Readers write at length. ' * 30}</p></div>",
        f"<body><div>{ARTICLE}</div><div class='comment-list'><p>Nice words.</p></div><div class='site-footer'>Foot</div></body>",
        f"<!doctype html><html><head><title>T</title><meta charset=utf-8><body><div>{ARTICLE}</div>",
        f"<!doctype html><head><title>T</title><script>var a='<p>';</script><link rel=x href=y><div>{ARTICLE}</div>",
        f"<html>\n<head>\n<title>T</title>\n</head>\n<body><head><title>Again</title></head><article>{ARTICLE}</article></body></html>",
    ],
)
def test_names_and_open_heads_do_not_take_the_article(html):
    assert html_text.main_text(html) == TEXT


def test_text_closes_an_open_head():
    assert html_text.main_text("<head><title>T</title>Plain words<p>and a paragraph") == "Plain words and a paragraph"
    assert html_text.main_text("<html><head><title>T</title></head><body></body></html>") == ""


@pytest.mark.parametrize(("name", "beside"), [("sidebar", 1), ("top-menu", 1), ("cookieNotice", 1), ("comment-list", 1), ("ad-300x250", 1)] + [
    (n, 0) for n in ("has-sidebar", "comments-open", "search-results", "no-sidebar", "entry-header", "adroit", "page", "main")])
def test_names_of_parts(name, beside):
    assert html_text.is_beside(name) == bool(beside)


def test_long_pages_end_in_time():
    for piece in ('<a title="', "<", "<!-", "<a ", "</", "<p", "&", "<script", "<div class='x"):
        html_text.main_text(piece * 20_000)
    long = "<p>" + "word " * 400_000 + "</p>"
    assert len(html_text.main_text(long)) == 5 * 400_000 - 1


def test_extraction_of_odd_rows(spark):
    rows = [(1, "u", f"<article>{ARTICLE}</article>", "own"), (1, "u", f"<article>{ARTICLE}</article>", "own"), (2, None, None, None), (None, "v", "", "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, n_chars string")
    found = html_text.extract(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert rows_of(found) == [(None, "v", "", 0), (1, "u", TEXT, len(TEXT)), (1, "u", TEXT, len(TEXT)), (2, None, "", 0)]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_pages_of_the_shared_tables(spark):
    """The article element holds the main text in these pages."""
    import re
    from html import unescape

    for row in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)(?:</article>|<footer)", row["html"], re.S)[1]
        plain = re.sub(r"<[^>]*>", lambda tag: "" if tag[0] in ("<b>", "</b>") else " ", inner)
        assert html_text.main_text(row["html"]) == " ".join(unescape(plain).split())


def test_inner_names_clash_with_nothing(spark):
    from perilscope.llm import language

    pages = spark.createDataFrame([("http://example.org/a", "<p>one two three</p>")], "url string, html string")
    own = pages.withColumns({name: F.lit(f"own {name}") for name in ("_ruled", "_hits", "_main_text", "_row", "_whole", "_", "verdict", "n_chars", "a.b")})
    judged = url_filter.judge(own)
    assert judged.columns == ["url", "html", "_ruled", "_hits", "_main_text", "_row", "_whole", "_", "n_chars", "a.b", "host", "path", "rule", "n_strict", "n_soft", "soft_weight", "verdict"]
    assert judged.first()["_hits"] == "own _hits" and judged.first()["verdict"] == "allow"
    extracted = html_text.extract(own)
    assert extracted.first()["_main_text"] == "own _main_text" and extracted.first()["n_chars"] == len("one two three")
    assert extracted.columns == ["url", "_ruled", "_hits", "_main_text", "_row", "_whole", "_", "verdict", "a.b", "text", "n_chars"]
    langs, shares = language.train(spark.createDataFrame([("aa bb aa", "x"), ("cc dd cc", "y")], "text string, lang string"))
    none = F.lit(None).cast("string")
    rows = own.select("*", F.lit("aa bb").alias("text"), none.alias("declared"), none.alias("address"), none.alias("host"))
    rows = rows.withColumns({name: F.lit("own") for name in ("_own", "_log", "_domain", "_final", "lang", "confidence")})
    found = language.identify(rows, langs, shares)
    assert len(set(found.columns)) == len(found.columns) and found.columns[-2:] == ["lang", "confidence"]
    assert (found.first()["lang"], found.first()["_own"], found.first()["a.b"]) == ("x", "own", "own a.b")


def nameless(html):
    """The page with plain elements only: no article, menu or footer elements, no classes, ids or roles."""
    import re

    html = re.sub(r"<(/?)(article|nav|aside|header|footer|main|section|form|menu)\b[^>]*>", r"<\1div>", html)
    return re.sub(r"""\s(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", "", html)


def token_f1(a, b):
    from collections import Counter

    a, b = Counter(a.split()), Counter(b.split())
    return 2 * sum((a & b).values()) / max(sum(a.values()) + sum(b.values()), 1)


def test_density_alone_finds_most_of_the_text(spark):
    """Without any name to go by, the chosen subtree is nearly the text; the whole body is not."""
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").orderBy("page_id").collect()]
    by_density, whole = [], []
    for page in pages:
        want, plain = html_text.main_text(page), nameless(page)
        by_density.append(token_f1(want, html_text.main_text(plain)))
        whole.append(token_f1(want, html_text.text_of(html_text.settle(html_text.parse(plain)))))
    assert sum(by_density) / len(pages) >= 0.98 and sum(f == 1 for f in by_density) >= 0.88 * len(pages)
    assert sum(whole) / len(pages) < 0.95 and sum(f == 1 for f in whole) < sum(f == 1 for f in by_density)


def plain_density(node, root_share):
    """Characters, tags, the same inside links, density and density sum of a node, by recursion over the definition."""
    import math

    chars, tags, link_chars, link_tags, total = len("".join("".join(p for p in node.parts if isinstance(p, str)).split())), 0, 0, 0, 0.0
    for child in (p for p in node.parts if not isinstance(p, str)):
        c, t, lc, lt, density, _ = plain_density(child, root_share)
        chars, tags, link_chars, link_tags = chars + c, tags + t + 1, link_chars + lc, link_tags + lt + (child.tag == "a")
        total += density
    if node.tag == "a":
        link_chars, link_tags = chars, tags
    base = math.log(chars * link_chars / max(chars - link_chars, 1) + root_share * chars + math.e)
    ratio = max(chars * max(tags, 1) / (max(link_chars, 1) * max(link_tags, 1)), 1)
    return chars, tags, link_chars, link_tags, chars / max(tags, 1) * math.log(ratio) / max(math.log(base), 1e-3), total


def test_densities_match_the_definition():
    page = f"<body><div>{MENU}</div><div><div>{ARTICLE}</div><div>Some more <a href=y>linked words</a> here</div></div><p>Foot</p></body>"
    root = html_text.settle(html_text.parse(page))
    nodes = html_text.measure(root)
    share = root.link_chars / root.chars
    for node in nodes:
        c, t, lc, lt, density, total = plain_density(node, share)
        assert (node.chars, node.tags, node.link_chars, node.link_tags) == (c, t, lc, lt)
        assert node.density == pytest.approx(density) and node.total == pytest.approx(total)
    text = html_text.text_of(html_text.main_part(root))
    assert text.startswith(TEXT) and "Menu" not in text and "Foot" not in text
