"""A seeded generator of web pages with their main text, in many shapes of markup, to fit and to judge the extraction on.

A page is an article in a container of some shape, within neutral wrappers, amid menus, headers, footers, sidebars,
notices, adverts, forms, scripts and reader comments. What is not main text can be told by its tag, by a token of its
class, id or role, or by its links; the article's container need not say anything.
"""

from __future__ import annotations

import html as entities
import random

#: Set before each block of the article on request, so that labels do not depend on texts.
MARK = "\ue000"
#: Containers of the article. "body": straight in the body. "td": a cell of a layout table.
SHAPES = ("article", "div", "section", "body", "main", "td", "named", "nested")
_SYLLABLES = "ka lo mi ter an dis ver su per ton ga re lin or ba che vo stra né ü ñ".split()
_NAMED = ("content", "post", "entry-content", "article-body", "story", "main", "text", "page-content", "blog-post")
#: Names that speak of the page's state, on bodies and wrappers of articles, and names of an article's own parts.
_STATING = (
    "has-sidebar", "no-sidebar", "comments-open", "comments-closed", "single-post with-header", "side-menu-closed", "modal-ready", "page-with-sidebar", "site has-footer", "layout sidebar-left", "content-sidebar-wrap", "with-banner", "nav-open",
    "is-login", "sidebar-right", "header-fixed", "no-ads", "ad-layout-2", "cookie-hidden", "has-cookie-notice", "menu-left", "main-footer-wrap", "content-header-wrap", "page-template-sidebar", "widget-area-off", "sticky-header", "single-comments",
)
_ANY = ("ad", "sidebar", "nav", "header", "footer", "promo", "related", "comments", "menu")
_OF_PARTS = ("side-by-side", "content-header", "post-header", "entry-footer", "article-header", "text-banner-wrap", "story-footer", "content-related-wrap")
_NEUTRAL = ("wrap", "container", "row", "col-8", "x1", "outer", "inner", "site", "grid", "left", "r2")


def _pick_name(r: random.Random, *names: str) -> str:
    name = r.choice(names)
    return r.choice([f' class="{name}"', f' id="{name}"', f' class="{name} x{r.randint(1, 9)}"', f" class={name}", f" class='{name}'"])


class Writer:
    """Writes one page; `truth` gathers the blocks of its main text."""

    def __init__(self, r: random.Random, mark: bool):
        self.r, self.mark, self.truth = r, MARK if mark else "", []
        self.odd = r.random() < 0.3  # pages of signs and broken sentences

    def sentence(self, lo: int, hi: int) -> str:
        r, out = self.r, []
        for _ in range(r.randint(lo, hi)):
            word = "".join(r.choice(_SYLLABLES) for _ in range(r.randint(1, 4)))
            if r.random() < (0.4 if self.odd else 0.08):
                word += r.choice([",", ",", "###", "&amp;", "$$$", "&amp;&amp;"] if self.odd else [",", ",", "&#8217;s", "&amp;"])
            out.append(word)
        return " ".join(out).capitalize() + (r.choice([".", ".", "", "!"]) if self.odd else ".")

    def prose(self, lo: int, hi: int) -> str:
        return " ".join(self.sentence(4, 14) for _ in range(self.r.randint(lo, hi)))

    def links(self, lo: int, hi: int) -> str:
        return "".join(f'<li><a href="/{i}">{self.sentence(1, 3)}</a></li>' for i in range(self.r.randint(lo, hi)))

    def block(self, tag: str, lo: int, hi: int, close: bool = True) -> str:
        r = self.r
        s = self.prose(lo, hi) if r.random() < 0.85 else self.sentence(1, 4)
        self.truth.append(" ".join(entities.unescape(s).split()))
        if r.random() < 0.2 and " " in s:
            a, b = s.split(" ", 1)
            s = r.choice(['<a href="/x">{}</a> {}', "<b>{}</b> {}", "<b>{} {}<br>", "<em>{}</em>\n {}", "<span don't>{}</span> {}"]).format(a, b)
        if r.random() < (0.05 if tag[0] in "ph" else 0.02):  # a block that is one link
            s = f'<a href="/y">{s}</a>' if r.random() < 0.6 or s[-1] not in ".!?" else f'<a href="/y">{s[:-1]}</a>{s[-1]}'
        attrs = r.choice([' class="lead"', ' id="p1"', " data-x='1'"]) if r.random() < 0.05 else ""
        return f"<{tag}{attrs}>{self.mark}{s}" + (f"</{tag}>" if close else "")

    def menu(self) -> str:
        return self.r.choice([
            lambda: f"<nav><ul>{self.links(2, 9)}</ul></nav>",
            lambda: f"<div{_pick_name(self.r, 'menu', 'nav', 'navbar', 'breadcrumb')}><ul>{self.links(2, 9)}</ul></div>",
            lambda: f"<ul{_pick_name(self.r, 'menu', 'navigation')}>{self.links(2, 7)}</ul>",
            lambda: f"<nav>{' &gt; '.join(f'<a href=/>{self.sentence(1, 2)}</a>' for _ in range(self.r.randint(2, 5)))}</nav>",
            lambda: f"<ul>{self.links(3, 8)}</ul>",
            lambda: f'<div role="navigation">{" | ".join(f"<a href=/>{self.sentence(1, 2)}</a>" for _ in range(4))}</div>',
        ])()

    def header(self) -> str:
        short = self.sentence(1, 8)
        return self.r.choice([
            f"<header><h1>{short}</h1><p>{self.sentence(2, 8)}</p></header>", f"<header>{short}</header>", f"<header><a href=/>{short}</a>{self.menu()}</header>",
            f"<div{_pick_name(self.r, 'header', 'masthead', 'topbar', 'header-top', 'fixed-header')}><a href=/>{short}</a> {self.sentence(1, 6)}</div>",
        ])

    def footer(self) -> str:
        s = self.prose(1, 3)
        return self.r.choice([
            f"<footer>&copy; {self.sentence(1, 4)} &middot; {s}</footer>", f"<footer><p>{s}</p><ul>{self.links(2, 4)}</ul></footer>", f"<footer><p>{s}</p></footer>", f"<footer>{s}</footer>",
            f"<div{_pick_name(self.r, 'footer', 'copyright', 'legal', 'footer-wrap', 'footer-bottom')}><p>{s}</p></div>", f"<p{_pick_name(self.r, 'copyright', 'footer')}>{s}</p>",
        ])

    def aside(self) -> str:
        short, s = self.sentence(1, 4), self.prose(1, 4)
        return self.r.choice([
            f"<aside><h3>{short}</h3><p>{s}</p></aside>", f"<aside>{s}</aside>", f"<aside><ul>{self.links(3, 6)}</ul></aside>", f"<aside><p>{s}</p><p>{self.prose(1, 3)}</p></aside>",
            f"<div{_pick_name(self.r, 'sidebar', 'widget', 'side', 'sidebar-left', 'right-sidebar', 'sidebar-wrap')}><h3>{short}</h3><ul>{self.links(2, 5)}</ul><p>{s}</p></div>", f"<section{_pick_name(self.r, 'sidebar', 'related')}><h3>{short}</h3><p>{s}</p></section>",
        ])

    def notice(self) -> str:
        s = self.prose(1, 3)
        return self.r.choice([
            f"<div{_pick_name(self.r, 'cookie', 'consent', 'cookie-notice', 'gdpr', 'alert')}><p>{s}</p><button>OK</button></div>", f"<div{_pick_name(self.r, 'notice', 'cookie-banner')}>{s}</div>", f"<dialog><p>{s}</p></dialog>",
            f"<section{_pick_name(self.r, 'notice', 'popup')}><p>{s}</p></section>",
        ])

    def advert(self) -> str:
        s = self.prose(1, 4)
        return self.r.choice([
            f"<div{_pick_name(self.r, 'ad', 'ads', 'advert', 'sponsored', 'promo', 'ad-slot', 'banner')}>{s}</div>", f"<div{_pick_name(self.r, 'ad', 'advertisement')}><p>{s}</p><a href=/>{self.sentence(1, 4)}</a></div>",
            f'<!-- ad --><div class="ad">{s}</div>', f"<section{_pick_name(self.r, 'promo', 'sponsor')}><h3>{self.sentence(1, 4)}</h3><p>{s}</p></section>", f"<p{_pick_name(self.r, 'ad', 'promo')}>{s}</p>",
        ])

    def form(self) -> str:
        s = self.prose(1, 2)
        return self.r.choice([
            f"<form><label>{self.sentence(1, 4)}</label><input><p>{s}</p><button>{self.sentence(1, 2)}</button></form>", f"<form{_pick_name(self.r, 'newsletter', 'subscribe', 'search')}>{s}<input></form>",
            f"<div{_pick_name(self.r, 'newsletter', 'signup')}><h4>{self.sentence(1, 4)}</h4><form><p>{s}</p><input></form></div>",
        ])

    def comments(self) -> str:
        r = self.r
        n = range(r.randint(1, 6))
        return r.choice([
            lambda: f"<div{_pick_name(r, 'comments', 'comment-list', 'disqus', 'comments-wrap')}><h3>{self.sentence(1, 3)}</h3>" + "".join(f'<div class="comment"><p>{self.prose(1, 3)}</p></div>' for _ in n) + "</div>",
            lambda: f"<section{_pick_name(r, 'comments', 'respond')}>" + "".join(f"<p>{self.prose(1, 4)}</p>" for _ in n) + "</section>",
            lambda: f"<ol{_pick_name(r, 'comments', 'comment-list')}>" + "".join(f"<li><article{_pick_name(r, 'comment')}><p>{self.prose(1, 3)}</p></article></li>" for _ in n) + "</ol>",
            lambda: '<div id="comments">' + "".join(f"<div><b>{self.sentence(1, 2)}</b><p>{self.prose(1, 3)}</p></div>" for _ in n) + "</div>",
        ])()

    def share(self) -> str:
        return f"<div{_pick_name(self.r, 'share', 'social', 'tags', 'related')}><ul>{self.links(2, 6)}</ul></div>"

    def script(self) -> str:
        return self.r.choice(["<script>var a='<p>x</p>';</script>", "<style>.a>p{color:red}</style>", '<noscript><img src="x"></noscript>', "<!-- <p>old</p> -->"])

    def some(self, most: int, *kinds) -> str:
        return "".join(self.r.choice(kinds)() for _ in range(self.r.randint(0, most)))

    def article(self, shape: str) -> str:
        r, parts = self.r, []
        if r.random() < 0.85:
            title, u = self.block("h1", 1, 1), r.random()
            parts.append(title if shape == "body" or u < 0.7 else f"<header>{title}</header>" if u < 0.9 else f"<div{_pick_name(r, *_OF_PARTS)}>{title}</div>")
        for _ in range(r.randint(1, 4) if r.random() < 0.3 else r.randint(2, 12) if r.random() < 0.7 else r.randint(8, 30)):
            u = r.random()
            if u < 0.8:
                parts.append(self.block("p", 1, r.choice([1, 2, 3, 6, 25]), close=r.random() < 0.92))
            elif u < 0.86:
                parts.append(self.block(r.choice(["h2", "h3"]), 1, 1))
            elif u < 0.9:
                parts.append(r.choice(["<ul>{}</ul>", "<ol>{}</ol>"]).format("".join(self.block("li", 1, 2) for _ in range(r.randint(1, 5)))))
            elif u < 0.92:
                parts.append("<blockquote>" + self.block("p", 1, 3) + "</blockquote>")
            elif u < 0.94:
                parts.append("<table><tr>" + "".join(self.block("td", 1, 1) for _ in range(3)) + "</tr></table>")
            elif u < 0.95:
                parts.append("<figure>" + self.block("figcaption", 1, 1) + "</figure>")
            elif u < 0.96:
                parts.append(f"<div{_pick_name(r, *_OF_PARTS) if r.random() < 0.5 else ''}>" + self.block("p", 1, 3) + self.block("p", 1, 3) + "</div>")
            else:
                parts.append(r.choice([self.advert, self.share, self.form, self.script, self.aside])())
        if shape != "body" and r.random() < 0.25:
            parts.append(self.comments())
        return "".join(parts)

    def contained(self, shape: str) -> str:
        r, inner = self.r, self.article(shape)
        if shape in ("article", "main", "section", "div"):
            return f"<{shape}>{inner}</{shape}>"
        if shape == "named":
            tag = r.choice(["div", "div", "section"])
            return f"<{tag}{_pick_name(r, *_NAMED)}>{inner}</{tag}>"
        if shape == "nested":
            return r.choice([f'<main><article class="post">{inner}</article></main>', f"<main><div>{inner}</div></main>", f"<article><div>{inner}</div></article>", f"<div><div><section>{inner}</section></div></div>"])
        if shape == "td":
            left = f"<td>{self.menu()}</td>" if r.random() < 0.5 else ""
            right = f"<td>{self.some(2, self.aside, self.advert)}</td>" if r.random() < 0.5 else ""
            return f"<table><tr>{left}<td>{inner}</td>{right}</tr></table>"
        return inner

    def page(self, shape: str) -> str:
        r, plain = self.r, self.r.random() < 0.3
        stating = r.random() < 0.5
        top = self.menu() + (self.advert() if r.random() < 0.7 else self.header() if r.random() < 0.5 else "") if plain else self.some(4, self.menu, self.menu, self.header, self.header, self.notice, self.advert, self.script, self.form, self.aside)
        body = self.contained(shape)
        if shape not in ("body", "td") and not plain:
            for _ in range(r.randint(0, 2)):
                before, after = self.some(1, self.menu, self.notice, self.advert, self.script), self.some(1, self.aside, self.share, self.comments, self.advert, self.form)
                name = _pick_name(r, *_STATING, f"x{r.randint(1, 9)}-{r.choice(_ANY)}-{r.choice(['box', 'y', 'page', 'area'])}") if stating and r.random() < 0.6 else _pick_name(r, *_NEUTRAL) if r.random() < 0.6 else ""
                body = f"<div{name}>{before}{body}{after}</div>"
        bottom = self.footer() if plain else self.some(4, self.footer, self.footer, self.comments, self.share, self.form, self.aside, self.advert, self.notice)
        head = f"<head><title>{self.sentence(3, 9)}</title><style>p{{}}</style></head>" if r.random() < 0.95 else ""
        return f"<!DOCTYPE html><html>{head}<body{_pick_name(r, *_STATING) if stating and r.random() < 0.7 else ''}>{top}{body}{bottom}" + ("</body></html>" if r.random() < 0.9 else "")


def generate(r: random.Random, shape: str | None = None, mark: bool = False) -> tuple[str, str]:
    """A page, with or without marks before its article's blocks, and its main text."""
    w = Writer(r, mark)
    page = w.page(shape or r.choice(SHAPES))
    return page, "\n".join(t for t in w.truth if t)
