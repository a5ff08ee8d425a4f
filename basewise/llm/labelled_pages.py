"""Labelled pages to train the extractor on: invented words in varied layouts.

Each page is written from a random layout: with or without the elements that
name their role, with many customs of class names, with boilerplate before,
after, beside and inside the article.  Each text carries its label.
"""

from __future__ import annotations

import random

SYLLABLES = "ba ce di fo gu ha je ki lo mu na pe qui ro su ta ve wi xo yu za en ar st tion ment".split()
MAIN, REST = 1, 0
#: Customs of class names, by what they hold.
NAMES = {
    "main": ["content", "post-content", "entry-content", "article-body", "story", "main-content", "post", "text", "body-text", "page-content", "entry", "article__body"],
    "nav": ["nav", "navbar", "menu", "main-menu", "navigation", "breadcrumb", "breadcrumbs", "tabs", "topnav", "site-nav", "pagination", "toc"],
    "header": ["header", "site-header", "masthead", "top-bar", "banner", "logo", "branding"],
    "footer": ["footer", "site-footer", "page-footer", "bottom", "copyright", "colophon", "legal"],
    "side": ["sidebar", "side", "widget", "related", "recommended", "popular", "aside", "rail", "more-stories", "tags", "author-box"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner-ad", "ad-slot", "adsbox", "sponsor"],
    "notice": ["cookie", "cookie-banner", "consent", "notice", "alert", "gdpr", "popup", "modal", "overlay", "announcement", "message"],
    "form": ["search", "search-form", "newsletter", "subscribe", "signup", "login", "contact-form", "poll"],
    "comments": ["comments", "comment", "comment-list", "replies", "reply", "discussion", "disqus", "responses", "reader-comments"],
    "share": ["share", "social", "share-bar", "follow", "social-links"],
}
PHRASES = {
    "nav": ["Home", "About", "Contact", "News", "Products", "Help", "Login", "Archive"],
    "header": ["Welcome to our site", "Log in", "My account", "Search"],
    "footer": ["&copy; 2024 All rights reserved.", "Privacy policy", "Terms of use", "Imprint", "&copy; example.com &middot;"],
    "side": ["Related articles", "Most read", "Popular posts", "See also", "Tags", "Read more"],
    "ad": ["Advertisement", "Sponsored", "Buy now", "Special offer", "Click here"],
    "notice": ["We use cookies to improve your experience.", "Accept all", "This site uses cookies", "Please enable JavaScript.", "By using this site you agree"],
    "form": ["Subscribe to our newsletter", "Enter your email", "Search", "Send", "Your name", "Sign up"],
    "comments": ["Comments", "Reply", "3 comments", "Leave a comment", "says:", "Report"],
    "share": ["Share this", "Tweet", "Share on Facebook", "Follow us", "Print"],
}
TAG = {"nav": "nav", "header": "header", "footer": "footer", "side": "aside", "ad": "aside", "notice": "div", "form": "form", "comments": "section", "share": "div"}


class PageMaker:
    """Writes pages; each text is marked by its label in U+E000 and U+E001."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choice(SYLLABLES) for _ in range(self.r.randint(1, 4)))

    def words(self, low: int, high: int) -> str:
        held = [self.word() for _ in range(self.r.randint(low, high))]
        text, at = "", 0
        while at < len(held):
            n = self.r.randint(3, 14)
            text += " ".join(held[at : at + n]).capitalize() + self.r.choice([". ", ". ", ". ", ", ", "! ", " ", "? "])
            at += n
        if self.r.random() < 0.05:
            text = text.upper()
        return text.strip()

    @staticmethod
    def mark(text: str, label: int) -> str:
        return (chr(0xE000 + label)) + text

    def named(self, kind: str) -> str:
        r = self.r
        if r.random() < 0.12:
            return ""
        name = r.choice(NAMES[kind]) if r.random() < 0.85 else f"c{r.randint(1, 99)}"
        return f' {r.choice(["class", "class", "id"])}="{name}{r.choice(["", "", " wide", "-inner", " box"])}"'

    def phrase(self, kind: str) -> str:
        r = self.r
        told = r.choice(PHRASES[kind]) if r.random() < 0.35 else self.words(1, r.choice([2, 4, 10, 25]))
        return told + (" " + self.words(2, 12) if r.random() < 0.2 else "")

    def links(self, kind: str) -> str:
        r = self.r
        items = [f'<a href="/{self.word()}">{self.mark(self.phrase(kind) if r.random() < 0.4 else self.words(1, 3), REST)}</a>' for _ in range(r.randint(2, 9))]
        if r.random() < 0.75:
            return "<ul>" + "".join(f"<li>{x}{'</li>' if r.random() < 0.9 else ''}" for x in items) + "</ul>"
        return r.choice([" | ", " ", "<br>"]).join(items)

    def boiler(self, kind: str) -> str:
        r = self.r
        inner = []
        for _ in range(r.randint(1, 3)):
            how = r.random()
            if kind == "form" and how < 0.6:
                inner.append(f"<label>{self.mark(self.phrase(kind), REST)}</label><input name=x><button>{self.mark('Send', REST)}</button>")
            elif kind == "comments":
                for _ in range(r.randint(1, 4)):
                    said = self.mark(self.words(1, r.choice([5, 20, 60])), REST)
                    inner.append(r.choice([f'<div class="comment"><b>{self.mark(self.word(), REST)}</b><p>{said}</p></div>', f"<li>{said}</li>", f"<p>{said}</p>", f"<article><p>{said}</p></article>"]))
            elif kind in ("nav", "side", "share") and how < 0.7 or how < 0.2:
                inner.append(self.links(kind))
            elif how < 0.75:
                inner.append(f"<p>{self.mark(self.phrase(kind), REST)}</p>")
            else:
                inner.append(self.mark(self.phrase(kind), REST))
        if r.random() < 0.3 and kind != "nav":
            inner.insert(0, f"<h{(n := r.randint(2, 4))}>{self.mark(self.phrase(kind), REST)}</h{n}>")
        joined, name = "\n".join(inner), self.named(kind)
        tag = TAG[kind] if r.random() < 0.6 or not name else r.choice(["div", "section", "div", "table"])
        if tag == "table":
            return f"<table{name}><tr><td>{joined}</td></tr></table>"
        return f"<{tag}{name}>{joined}</{tag}>"

    def article(self) -> str:
        r = self.r
        parts = []
        if r.random() < 0.8:
            parts.append(f"<h1>{self.mark(self.words(2, 10), MAIN)}</h1>")
        for _ in range(r.choice([1, 2, 3, 5, 8, 12, 20])):
            how, text = r.random(), self.mark(self.words(1, r.choice([2, 8, 30, 80, 150])), MAIN)
            if how < 0.72:
                dress = r.choice(["{}", "{}", "<b>{}</b>", "<b>{}<br>", "<i>{}</i>"])
                if r.random() < 0.12:
                    at = text.find(" ", len(text) // 2)
                    text = f'{text[:at]} <a href="/x">{self.word()}</a>{text[at:]}' if at > 0 else text
                parts.append(f"<p>{dress.format(text)}" + ("</p>" if r.random() < 0.9 else ""))
            elif how < 0.8:
                parts.append(f"<h{(n := r.randint(2, 4))}>{self.mark(self.words(1, 8), MAIN)}</h{n}>")
            elif how < 0.87:
                kind = r.choice(["ul", "ol"])
                parts.append(f"<{kind}>" + "".join(f"<li>{self.mark(self.words(1, 15), MAIN)}</li>" for _ in range(r.randint(2, 5))) + f"</{kind}>")
            elif how < 0.91:
                parts.append(f"<blockquote><p>{text}</p></blockquote>")
            elif how < 0.94:
                parts.append("<table>" + "".join(f"<tr><td>{self.mark(self.words(1, 4), MAIN)}</td><td>{self.mark(self.words(1, 4), MAIN)}</td></tr>" for _ in range(r.randint(1, 4))) + "</table>")
            elif how < 0.96:
                parts.append(f"<pre>{text}</pre>")
            elif how < 0.98:
                parts.append(f"<div>{text}</div>")
            else:
                parts.append(text + "<br><br>")
        if r.random() < 0.25:
            parts.insert(r.randint(1, len(parts)), self.boiler(r.choice(["ad", "share", "side", "form", "notice", "ad"])))
        if r.random() < 0.12:
            parts.append(self.boiler("comments"))
        joined = r.choice(["", "\n", "\n  "]).join(parts)
        how = r.random()
        if how < 0.4:
            return f"<article{self.named('main') if r.random() < 0.4 else ''}>{joined}</article>"
        if how < 0.6:
            return f"<main{self.named('main') if r.random() < 0.4 else ''}>{joined}</main>"
        if how < 0.9:
            return f"<div{self.named('main')}>{joined}</div>"
        if how < 0.96:
            return joined
        return f"<table><tr><td>{joined}</td></tr></table>"

    def page(self) -> str:
        r = self.r
        before = [self.boiler(k) for k in r.sample(["header", "nav", "notice", "ad", "form", "side"], r.randint(0, 4))]
        after = [self.boiler(k) for k in r.sample(["comments", "side", "ad", "share", "footer", "notice", "form", "nav"], r.randint(0, 4))]
        if r.random() < 0.6:
            after.append(self.boiler("footer"))
        body = before + [self.article()] + after
        if r.random() < 0.1:
            body.insert(len(before) + 1, self.article())
        if r.random() < 0.5:
            body = ["<div class=wrapper>", *body, "</div>"]
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title><style>p{{}}</style></head><body>{r.choice(['', chr(10)]).join(body)}" + ("</body></html>" if r.random() < 0.9 else "")


def labelled(text: str) -> tuple[str, int]:
    """A block's text without its marks, and its label: that of its first mark."""
    marks = [c for c in text if c in "\ue000\ue001"]
    return text.replace("\ue000", "").replace("\ue001", "").strip(), ord(marks[0]) - 0xE000 if marks else REST
