"""Web pages made by rule, with the main text known: what the extractor learns from.

Pages vary in their wrappers, tag and attribute names, order and amount of text. Every name here is in common use on the web.
"""

from __future__ import annotations

import random

MAIN = (
    ("article", ""), ("article", "post"), ("main", ""), ("div", "content"), ("div", "article-body"), ("div", "entry-content"),
    ("section", "story"), ("div", "post-text"), ("div", ""), ("section", "main"), ("div", "page"),
)
#: Kind of clutter to the tags and names it comes with.
CLUTTER = {
    "menu": (("nav", ""), ("nav", "menu"), ("div", "nav"), ("ul", "menu"), ("div", "breadcrumb"), ("div", "toolbar"), ("header", "navbar")),
    "header": (("header", ""), ("div", "header"), ("div", "masthead"), ("header", "site-header"), ("div", "topbar")),
    "footer": (("footer", ""), ("div", "footer"), ("footer", "site-footer"), ("div", "copyright"), ("section", "footer")),
    "side": (("aside", ""), ("div", "sidebar"), ("aside", "widget"), ("div", "related"), ("section", "recommended"), ("div", "popular")),
    "notice": (("div", "cookie"), ("div", "notice"), ("section", "banner"), ("div", "alert"), ("div", "consent"), ("p", "disclaimer"), ("div", "popup")),
    "advert": (("div", "ad"), ("div", "ads"), ("aside", "advert"), ("div", "sponsored"), ("section", "promo"), ("div", "banner-ad"), ("p", "ad")),
    "form": (("form", ""), ("form", "search"), ("div", "newsletter"), ("form", "login"), ("div", "subscribe"), ("form", "signup")),
    "comments": (("div", "comments"), ("section", "comments"), ("div", "comment-list"), ("ol", "comments"), ("section", "responses"), ("div", "discussion")),
    "share": (("div", "share"), ("div", "social"), ("ul", "share-buttons"), ("div", "tags"), ("div", "meta")),
}

#: Wrappers of whole pages or of their main text whose tag or name is else one of clutter.
WRAPPERS = (
    ("form", ""), ("form", ""), ("form", "form"), ("form", "aspnet"), ("div", "banner-hero"), ("div", "social-wrap"), ("div", "header-offset"),
    ("div", "has-sidebar"), ("div", "menu-page"), ("section", "related-layout"), ("div", "ad-free"), ("div", "footer-push"),
)

_SYLLABLES = "th er on an re he in ed nd ha at en es or ti hi as to it is ou ea ng ar se te".split()


class Writer:
    """One random page; ``html`` and the names of nodes that are main text go hand in hand by the ``data-y`` mark."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        r = self.r
        n = r.randint(low, high)
        out = ["".join(r.choices(_SYLLABLES, k=r.randint(1, 4))) for _ in range(n)]
        mark = r.choice((".", ".", ".", ",", ""))
        text = " ".join(w + ("," if r.random() < 0.08 else "." if r.random() < 0.06 else "") for w in out)
        return text.capitalize() + mark

    def tag(self, name: str, token: str, y: int, body: str) -> str:
        r = self.r
        token = token and r.choice((token, token, f"{token} box", f"site-{token}", f"{token}-1", f"{token}_wrap"))
        mark = f' {r.choice(("class", "class", "class", "id"))}="{token}"' if token else ""
        return f'<{name}{mark} data-y="{y}">{body}</{name}>'

    def link(self, text: str) -> str:
        return f'<a href="/{self.r.randint(1, 999)}">{text}</a>'

    def links(self, y: int, n: int) -> str:
        kind = self.r.choice(("ul", "ul", "flat", "div"))
        items = [self.link(self.words(1, 3).rstrip(".,")) for _ in range(n)]
        if kind == "ul":
            return self.tag("ul", "", y, "".join(self.tag("li", "", y, i) for i in items))
        if kind == "div":
            return "".join(self.tag("div", "", y, i) for i in items)
        return " | ".join(items)

    def clutter(self, kind: str) -> str:
        r = self.r
        name, token = r.choice(CLUTTER[kind])
        if kind in ("menu", "share"):
            body = self.links(0, r.randint(2, 9))
        elif kind == "side":
            body = self.tag("h3", "", 0, self.words(1, 4)) + self.links(0, r.randint(2, 8))
            if r.random() < 0.4:
                body += self.tag("p", "", 0, self.words(5, 40))
        elif kind == "footer":
            body = "&copy; " + self.words(2, 30) if r.random() < 0.6 else self.tag("p", "", 0, self.words(3, 25)) + self.links(0, 4)
        elif kind == "header":
            body = self.tag(r.choice(("h1", "h2", "div", "p")), r.choice(("", "logo", "title")), 0, self.words(1, 5))
            if r.random() < 0.5:
                body += self.links(0, r.randint(2, 6))
        elif kind == "form":
            body = f'<label>{self.words(1, 3)}</label><input type="text"><button>{self.words(1, 2)}</button>'
            if r.random() < 0.5:
                body = self.tag("p", "", 0, self.words(3, 25)) + body
        elif kind == "comments":
            entry = lambda: self.tag(
                r.choice(("div", "li", "article", "p")), r.choice(("comment", "reply", "")), 0,
                r.choice(("", self.tag("span", "author", 0, self.words(1, 2)))) + self.tag("p", "", 0, self.words(4, 60)),
            )
            body = self.tag("h3", "", 0, self.words(1, 2)) * r.randint(0, 1) + "".join(entry() for _ in range(r.randint(1, 6)))
        else:
            body = self.words(4, 45) if r.random() < 0.6 else self.tag("p", "", 0, self.words(4, 45))
            if r.random() < 0.3:
                body += self.link(self.words(1, 3))
        return self.tag(name, token, 0, body)

    def text(self, low: int, high: int) -> str:
        words = self.words(low, high).split(" ")
        for i in range(len(words)):
            if self.r.random() < 0.02:
                words[i] = self.r.choice((self.link(words[i]), f"<b>{words[i]}</b>", f"<em>{words[i]}</em>"))
        return " ".join(words)

    def main(self) -> str:
        r = self.r
        name, token = r.choice(MAIN)
        parts = [self.tag(r.choice(("h1", "h1", "h2")), r.choice(("", "", "title")), 1, self.words(2, 14))] * (r.random() < 0.9)
        if parts and name in ("article", "main") and r.random() < 0.3:
            parts = [self.tag("header", r.choice(("", "entry-header")), 1, parts[0])]
        scale = r.choice((8, 25, 60, 140))
        for _ in range(r.choice((1, 2, 3, 5, 9, 16, 30))):
            p = r.random()
            if p < 0.8:
                parts.append(self.tag("p", "", 1, self.text(1 if r.random() < 0.15 else 4, scale)))
            elif p < 0.85:
                parts.append(self.tag(r.choice(("h2", "h3")), "", 1, self.words(1, 8)))
            elif p < 0.9:
                parts.append(self.tag(r.choice(("ul", "ol")), "", 1, "".join(self.tag("li", "", 1, self.text(2, 20)) for _ in range(r.randint(2, 6)))))
            elif p < 0.94:
                parts.append(self.tag("blockquote", "", 1, self.tag("p", "", 1, self.text(5, scale))))
            elif p < 0.97:
                parts.append(self.tag("figure", "", 1, '<img src="x.png">' + self.tag("figcaption", "", 1, self.words(2, 12))))
            else:
                parts.append(self.tag("pre", "", 1, self.words(5, 30)))
            if r.random() < 0.04:
                parts.append(self.clutter(r.choice(("advert", "advert", "side", "form"))))
        if r.random() < 0.25:
            parts.append(self.clutter(r.choice(("share", "comments", "form"))))
        return self.tag(name, token, 1, "".join(parts))

    def page(self) -> str:
        r = self.r
        before = [self.clutter(k) for k in ("notice", "header", "menu", "advert") if r.random() < 0.55]
        after = [self.clutter(k) for k in ("share", "comments", "side", "form", "advert", "notice") if r.random() < 0.3]
        if r.random() < 0.25:
            before.append(self.clutter("side"))
        r.shuffle(before)
        r.shuffle(after)
        main = self.main()
        if r.random() < 0.15:
            main = self.tag(*r.choice(WRAPPERS), 1, main)
        middle = "".join(before) + main + "".join(after)
        if r.random() < 0.4:
            middle = self.tag("div", r.choice(("", "wrapper", "container", "page", "row")), 1, middle)
        if r.random() < 0.8:
            middle += self.clutter("footer")
        if r.random() < 0.15:
            middle = self.tag(*r.choice(WRAPPERS), 1, middle)
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 9)}</title></head><body>{middle}</body></html>"
