"""Labelled pages that the main-text model is fitted on.

No table says which part of a page is its article, so pages of common layouts
are composed: semantic elements, divisions with class names, plain divisions
without names, and tables, with menus, headers, notices, adverts, sidebars,
forms, share boxes, reader comments and footers around (and inside) an article.
Every block of the article begins with ``MARK``, which the reader of the labels
removes again.  A page depends on its number and the seed only.
"""

from __future__ import annotations

import random

MARK = ""

#: Class names by part of a page; a layout without names uses none of them.
NAMES = {
    "article": ["article", "post", "entry content", "post-body", "article-body", "main-content", "story", "articleText",
                "content", "entry", "text", "post_content"],
    "page": ["page", "wrapper", "container", "layout", "site", "row", "col", "inner", "outer", "wrap", "box", "block"],
    "menu": ["nav", "menu", "navigation", "navbar", "main-menu", "topnav", "breadcrumb", "nav-links", "pagination", "toc"],
    "header": ["header", "site-header", "masthead", "topbar", "logo", "branding", "hero-head"],
    "notice": ["cookie-notice", "consent", "gdpr", "banner", "alert", "cookie-bar", "notification", "notice", "paywall"],
    "advert": ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "adsense", "ad-slot", "sponsor", "commercial"],
    "sidebar": ["sidebar", "aside", "widget", "related", "recent-posts", "side-col", "tags", "trending", "popular", "more-stories"],
    "share": ["share", "social", "sharing", "share-buttons", "author-box", "byline", "meta", "post-meta", "subscribe"],
    "form": ["form", "newsletter", "search-form", "signup", "contact", "login", "subscribe-form"],
    "comments": ["comments", "comment-list", "discussion", "responses", "comment", "disqus", "replies", "reader-comments"],
    "footer": ["footer", "site-footer", "bottom", "copyright", "legal", "foot", "colophon", "footer-links"],
}
_LETTERS = "etaoinshrdlcumwfgypbvk" + "eeetaaoinsr"


class _Composer:
    def __init__(self, number: int, seed: int):
        self.r = random.Random(number * 1_000_003 + seed)
        self.style = self.r.choice(["semantic", "semantic", "named", "named", "mixed", "bare", "table"])
        self.lazy = self.r.random() < 0.25  # end tags of paragraphs left out

    def words(self, n: int) -> str:
        r = self.r
        out = ["".join(r.choices(_LETTERS, k=r.randint(1, 9))) for _ in range(n)]
        for i in range(0, n, r.randint(4, 14)):
            out[i] = out[i].capitalize()
            if i and r.random() < 0.8:
                out[i - 1] += r.choice(".....,,?!;:")
        return " ".join(out)

    def sentence(self, longest: int = 60) -> str:
        n = self.r.choice([1, 2, 5, 12, 25, longest])
        return self.words(self.r.randint(1, n)) + self.r.choice([".", ".", ".", "", "?", "&hellip;"])

    def named(self, part: str, tag: str, inside: str) -> str:
        """``inside`` in an element that says its part by tag, name, both or not at all."""
        r, style = self.r, self.style
        tag = tag if style == "semantic" or (style == "mixed" and r.random() < 0.5) else r.choice(["div", "div", "section"])
        say = style == "named" or (style in ("mixed", "table") and r.random() < 0.7) or r.random() < 0.3
        if style == "bare":
            say = False
        elif tag in ("div", "section") and part in ("advert", "notice", "share", "comments", "sidebar", "form"):
            say = True
        name = f' {r.choice(["class", "class", "id"])}="{r.choice(NAMES[part])}"' if say else ""
        return f"<{tag}{name}>{inside}</{tag}>"

    def links(self, n: int) -> str:
        r = self.r
        items = [f'<a href="/{r.randint(1, 999)}">{self.words(r.choice([1, 1, 1, 2, 3, 6]))}{r.choice(["", "", "", ".", ",", "?"])}</a>' for _ in range(n)]
        shape = r.random()
        if shape < 0.6:
            end = "" if self.lazy else "</li>"
            return "<ul>" + "".join(f"<li>{x}{end}" for x in items) + "</ul>"
        return r.choice([" | ", " ", " &middot; "]).join(items)

    def paragraphs(self, n: int, mark: str) -> str:
        r, out = self.r, []
        for _ in range(n):
            text = mark + self.sentence(r.choice([30, 80, 160]))
            if r.random() < 0.15:
                text = text + f' <a href="/x">{self.words(2)}</a> ' + self.words(r.randint(1, 9))
            if r.random() < 0.1:
                text = f"<b>{text}" + r.choice(["</b>", "<br>", ""])
            out.append(f"<p>{text}" + ("" if self.lazy and r.random() < 0.6 else "</p>"))
        return "\n".join(out) if r.random() < 0.3 else "".join(out)

    def advert(self) -> str:
        inside = self.r.choice([self.sentence(25), self.sentence(80), f"<p>{self.sentence(25)}</p>", f'<a href="/o">{self.words(5)}</a>'])
        return self.named("advert", "aside", inside)

    def article(self) -> str:
        r, out = self.r, []
        title = self.words(r.randint(1, 14))
        if r.random() < 0.85:
            out.append(f"<h1>{MARK}{title}</h1>")
        if r.random() < 0.3:
            out.append(self.named("share", "div", self.words(r.randint(2, 6)) + r.choice(["", self.links(3)])))
        for _ in range(r.choice([1, 1, 2, 4])):
            out.append(self.paragraphs(r.choice([1, 2, 4, 9, 20]), MARK))
            kind = r.random()
            if kind < 0.2:
                out.append(f"<h2>{MARK}{self.words(r.randint(1, 8))}</h2>")
            elif kind < 0.3:
                items = "".join(f"<li>{MARK}{self.sentence(15)}</li>" for _ in range(r.randint(2, 6)))
                out.append(f"<ul>{items}</ul>")
            elif kind < 0.38:
                out.append(f"<blockquote><p>{MARK}{self.sentence(40)}</p></blockquote>")
            elif kind < 0.44:
                rows = "".join(f"<tr><td>{MARK}{self.words(2)}</td><td>{MARK}{r.randint(1, 99)}</td></tr>" for _ in range(3))
                out.append(f"<table>{rows}</table>")
            elif kind < 0.5:
                out.append(f"<figure><img src=x><figcaption>{MARK}{self.sentence(15)}</figcaption></figure>")
            elif kind < 0.62 and self.style != "bare":
                out.append(self.advert())
            elif kind < 0.7 and self.style != "bare":
                out.append(self.form())
        inside = "".join(out)
        if r.random() < 0.25:
            inside = f"<div>{inside}</div>"
        if self.style == "table":
            return f"<table><tr><td>{self.links(5)}</td><td>{self.named('article', 'article', inside)}</td></tr></table>"
        tag = r.choice(["article", "article", "main"])
        return self.named("article", tag, inside)

    def form(self) -> str:
        r = self.r
        inside = f"<p>{self.words(r.randint(2, 9))}</p><label>{self.words(2)}</label><input name=q><button>{self.words(1)}</button>"
        return self.named("form", "form", f"<form>{inside}</form>" if r.random() < 0.5 or self.style == "bare" else inside)

    def comments(self) -> str:
        r = self.r
        each = "".join(f'<div class="comment"><p>{self.words(2)}</p>{self.paragraphs(r.randint(1, 3), "")}</div>'
                       for _ in range(r.randint(1, 6)))
        return self.named("comments", "section", f"<h3>{self.words(r.randint(1, 3))}</h3>{each}")

    def sidebar(self) -> str:
        r = self.r
        inside = f"<h3>{self.words(2)}</h3>" + r.choice([self.links(r.randint(3, 9)), f"<p>{self.sentence(25)}</p>" + self.links(3)])
        return self.named("sidebar", "aside", inside)

    def page(self) -> str:
        r, often = self.r, self.r.random
        before, after = [], []
        if often() < 0.4:
            before.append(self.named("header", "header", f"<a href=/>{self.words(2)}</a>" + r.choice(["", f"<p>{self.sentence(15)}</p>"])))
        if often() < 0.9:
            before.append(self.named("menu", "nav", self.links(r.randint(3, 12))))
        if often() < 0.3 and self.style != "bare":
            before.append(self.named("notice", "div", f"<p>{self.sentence(30)}</p><button>{self.words(1)}</button>"))
        if often() < 0.5 and self.style != "bare":
            before.append(self.advert())
        if often() < 0.25 and self.style != "bare":
            before.append(self.sidebar())
        if often() < 0.3 and self.style != "bare":
            after.append(self.comments())
        if often() < 0.35 and self.style != "bare":
            after.append(self.sidebar())
        if often() < 0.2:
            after.append(self.form())
        if often() < 0.2 and self.style != "bare":
            after.append(self.advert())
        if often() < 0.9:
            after.append(self.named("footer", "footer", r.choice(["&copy; ", ""]) + self.words(r.randint(1, 4))
                                    + r.choice([" ", " &middot; "]) + self.sentence(30) + r.choice(["", self.links(4)])))
        middle = self.article()
        if often() < 0.3:
            middle = f"<div class=\"{r.choice(NAMES['page'])}\">{middle}</div>"
        body = "".join([*before, middle, *after])
        if often() < 0.3:
            body = f"<div id=\"{r.choice(NAMES['page'])}\">{body}</div>"
        head = (f"<head><title>{self.words(5)}</title><style>p{{margin:0}}</style>"
                f"<script>var t='<p>x</p>';</script></head>")
        end = "</body></html>" if often() < 0.85 else ""
        return f"<!DOCTYPE html><html lang=\"en\">{head}<body>{body}{end}"


def sample_page(number: int, seed: int = 0) -> str:
    """Page ``number`` of the labelled sample."""
    return _Composer(number, seed).page()
