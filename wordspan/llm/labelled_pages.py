"""The labelled table that the block classifier is grown on: sources of pages in common designs, marked by hand.

{6} stands for six words and {+6} for six words of the article. Blocks whose words are of the article are kept.
"""

from __future__ import annotations

import random
import re

PAGES = [
    # a news page with semantic elements
    '<head><title>{5}</title></head><body><header class="site-header"><a href=/>{2}</a><p>{5}</p></header><nav><ul><li><a href=1>{1}</a><li><a href=2>{1}</a><li><a href=3>{2}</a></ul></nav>'
    '<div class="ad">{9}</div><main><article class="article post"><header class="article-header"><h1>{+8}</h1><p class="byline">{+4}</p></header><p>{+60}</p><p>{+80} <a href=x>{+3}</a></p><h2>{+2}</h2><p>{+1}</p><p>{+120}</p><p>{+25}</p></article></main>'
    '<aside class="sidebar related"><h3>{2}</h3><ul><li><a href=5>{6}</a><li><a href=6>{7}</a><li><a href=7>{5}</a></ul></aside><footer class="site-footer">{6}</footer>',
    # an advert and a notice of prose length, a short article
    '<div class="ad banner">{40}</div><div id="cookie-notice" class="cookie consent">{25} <a href=1>{2}</a></div><article><h1>{+7}</h1><p>{+9}</p><p>{+2}</p><p>{+3}</p></article><footer>{12}</footer>',
    # an article with lists, a table, a quotation and code
    '<nav><a href=1>{1}</a> <a href=2>{1}</a> <a href=3>{1}</a></nav><article class="entry content"><h1>{+5}</h1><p>{+50}</p><ul><li>{+4}<li>{+7}<li>{+2}<li>{+1}</ul><blockquote>{+30}</blockquote><table><tr><td>{+1}<td>{+2}<tr><td>{+3}<td>{+1}</table><pre>{+20}</pre><ol><li><a href=9>{+4}</a> {+8}<li>{+12}</ol><dl><dt>{+1}<dd>{+9}</dl><p>{+45}</p><figure><figcaption>{+8}</figcaption></figure></article><footer><p>{6}</p></footer>',
    # reader comments, a share bar and a newsletter form in the article
    '<article class="article"><h1>{+6}</h1><p>{+70}</p><p>{+35}</p><div class="share social"><a href=1>{1}</a> <a href=2>{1}</a></div><form class="newsletter subscribe"><p>{12}</p></form><section id="comments" class="comments"><h2>{2}</h2><div class="comment"><p>{40}</p></div><div class="comment reply"><p>{90}</p></div><div class="comment"><p>{9}</p></div></section></article><footer>{5}</footer>',
    # comments beside the article, with a form
    '<div id="page"><main id="main" class="content"><h1>{+7}</h1><p>{+55}</p><p>{+65}</p></main><div id="comments" class="comments-area"><h3>{2}</h3><ol class="comment-list"><li><p>{30}</p><li><p>{12}</p></ol><div id="respond"><p>{8}</p></div></div><div class="widget sidebar"><p>{20}</p><p>{14}</p></div><div class="footer legal"><p>{16}</p></div></div>',
    # plain boxes without semantic elements, layout names on the frame
    '<body class="home with-sidebar"><div class="wrapper"><div class="menu navigation"><a href=1>{1}</a> <a href=2>{1}</a> <a href=3>{2}</a></div><div class="content with-sidebar"><h1>{+8}</h1><div class="text">{+50}</div><div class="text">{+70}</div><p>{+24} <a href=5>{+2}</a></p><div>{+18}</div></div><div class="sidebar"><div>{12}</div><div><a href=6>{5}</a></div></div><div class="footer">{9}</div></div></body>',
    # old pages in tables, nothing named
    '<table><tr><td><a href=1>{1}</a><td><a href=2>{2}</a><td><a href=3>{1}</a></table><h1>{+6}</h1><p>{+60}<p>{+55} <a href=4>{+3}</a><p>{+12}<p>{+40}<hr><p><a href=5>{2}</a> <a href=6>{2}</a> <a href=7>{3}</a>',
    '<body><center><a href=1>{2}</a> <a href=2>{2}</a></center><h2>{+4}</h2>{+80}<br>{+30}<p>{+20}<p>{+2}<p>{+45}</body>',
    # plain boxes, nothing named
    '<div><a href=1>{1}</a> <a href=2>{1}</a> <a href=3>{1}</a></div><div><h1>{+9}</h1><p>{+30}</p><p>{+5}</p><p>{+48}</p><ul><li>{+6}<li>{+9}</ul><p>{+33}</p></div><div><a href=4>{4}</a><a href=5>{6}</a></div><div>{3} <a href=6>{3}</a></div>',
    '<div><div><a href=1>{2}</a></div><div><a href=2>{2}</a></div></div><div><div>{+45}</div><div>{+60}</div><div>{+38}</div></div><div><a href=3>{5}</a></div><div><a href=4>{7}</a></div>',
    # a list of links and teasers under the article, breadcrumbs above it
    '<ol class="breadcrumb"><li><a href=1>{1}</a><li><a href=2>{1}</a></ol><div class="post"><h1 class="title">{+6}</h1><p>{+40}</p><p>{+52}</p></div><div class="related promo"><h4>{2}</h4><p><a href=4>{9}</a></p><p><a href=5>{11}</a></p></div><div class="pagination pager"><a href=6>{1}</a> <a href=7>{1}</a></div><div class="copyright">{7}</div>',
    # links, and headings that are links, in the article; roles instead of elements
    '<div role="banner">{3}</div><div role="navigation"><a href=1>{2}</a></div><div role="main"><h1><a href=2>{+7}</a></h1><p>{+30} <a href=3>{+12}</a></p><h2><a href=4>{+3}</a></h2><p>{+60}</p><p><a href=5>{+4}</a></p></div><div role="complementary"><p>{24}</p></div><div role="contentinfo">{6}</div>',
    # notices and adverts between the paragraphs
    '<article><h1>{+5}</h1><p>{+44}</p><div class="ad advert sponsored"><p>{15}</p></div><p>{+58}</p><div class="notice warning"><p>{18}</p></div><p>{+3}</p><aside><p>{22}</p></aside><p>{+39}</p><div class="tags meta"><a href=1>{1}</a> <a href=2>{1}</a></div></article>',
    # a page that is only text, and one that is only paragraphs
    '{+40}',
    '{+3}',
    '<p>{+30}</p><p>{+6}</p><p>{+22}</p>',
    '<h1>{+4}</h1><p>{+2}</p>',
]
OWN, OTHER = "kept", "left"


#: Copies of each page with other lengths, as drawn, and of those that can be told without names, without any.
VARIANTS = 8
#: Words of a block from which on it is prose, wherever it stands.
PROSE = 13


def filled(page: str, draw: random.Random | None = None) -> str:
    """The page with its words; with `draw`, texts of over three words have from half to twice as many."""

    def words(m: re.Match) -> str:
        n = int(m[2])
        n = n if draw is None or n <= 3 else max(2, round(n * 2 ** draw.uniform(-1, 1)))
        return " ".join([OWN if m[1] else OTHER] * n)

    return re.sub(r"\{(\+?)(\d+)\}", words, page)


def is_plain(page: str) -> bool:
    """Whether nothing but links and short texts stands beside the article, so that it can be told without names."""
    beside = re.sub(r"<a [^>]*>[^<]*</a>", "", page)
    return all(int(n) < PROSE for n in re.findall(r"\{(\d+)\}", beside))


def bare(page: str) -> str:
    """The page without class, id and role, and with plain boxes for elements that say what they hold."""
    page = re.sub(r' (?:class|id|role)=(?:"[^"]*"|[^ >]+)', "", page)
    return re.sub(r"<(/?)(?:article|main|nav|aside|footer|header|section|form|figure|figcaption)\b", r"<\1div", page)


def training_pages(seed: int = 1) -> list[str]:
    """The pages as they are, copies of other lengths, and such copies without names."""
    draw = random.Random(seed)
    out = list(map(filled, PAGES)) if seed == 1 else []
    for page in PAGES:
        for _ in range(VARIANTS):
            out.append(filled(page, draw))
            if is_plain(page):
                out.append(filled(bare(page), draw))
    return out
