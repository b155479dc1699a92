"""Pages with known labels for training: layouts drawn at random around fragments of real pages."""

from __future__ import annotations

import html
import random

#: Attribute words that pages commonly give to the parts of a layout.
WORDS = {
    "nav": "nav navbar menu navigation topnav mainmenu breadcrumb breadcrumbs pagination pager toc sitemap tabs",
    "header": "header masthead site-header topbar banner branding page-header logo hero",
    "footer": "footer site-footer page-footer colophon bottom copyright legal",
    "aside": "sidebar aside widget related recommended popular trending rail secondary more-stories tags social share sharing",
    "notice": "notice cookie cookie-banner consent gdpr alert popup modal newsletter-prompt paywall message disclaimer",
    "ad": "ad ads advert advertisement ad-slot sponsor sponsored promo promoted banner-ad adbox",
    "form": "form subscribe newsletter search signup login contact feedback searchbox",
    "comments": "comments comment comment-list replies discussion reader-comments responses disqus thread",
    "main": "content main article post entry story article-body post-content entry-content main-content story-body text body-text page-content",
    "wrap": "wrapper container page row column layout inner grid site",
}
TAGS = {
    "nav": ("nav", "nav", "div", "ul", "section"), "header": ("header", "header", "div"), "footer": ("footer", "footer", "div"), "aside": ("aside", "aside", "div", "section"), "notice": ("div", "div", "section", "aside", "p"),
    "ad": ("div", "div", "aside", "section", "p"), "form": ("form", "form", "div"), "comments": ("section", "div", "ol", "div"), "main": ("article", "article", "main", "div", "section"), "wrap": ("div",),
}


class Layouts:
    """Draws (html, labels): the labels, of every element with its own node, travel in a data-y attribute."""

    def __init__(self, long: list[str], short: list[str], seed: int = 7):
        self.long, self.short, self.random = long or ["Some words of a text, and more of them."], short or ["more"], random.Random(seed)

    def words(self, n: int) -> str:
        return html.escape(" ".join(self.random.choice(self.short) for _ in range(n)), quote=False)

    def paragraph(self) -> str:
        return html.escape(self.random.choice(self.long), quote=False)

    def element(self, tag: str, inner: str, y: int, kind: str | None = None) -> str:
        r, attributes = self.random, ""
        if kind and r.random() < (0.55 if tag in ("nav", "header", "footer", "aside", "article", "main", "form") else 0.93):
            name = r.choice(WORDS[kind].split())
            if r.random() < 0.25:
                name += "-" + r.choice(["wrap", "box", "area", "block", "list", str(r.randrange(9))])
            attributes = f' {r.choice(["class", "class", "id"])}="{name}"'
        close = "" if tag in ("p", "li") and r.random() < 0.15 else f"</{tag}>"
        return f'<{tag}{attributes} data-y="{y}">{inner}{close}'

    def links(self, n: int, y: int = 0) -> str:
        items = [f'<a href="/{i}">{self.words(self.random.randint(1, 3))}</a>' for i in range(n)]
        if self.random.random() < 0.6:
            return self.element("ul", "".join(self.element("li", x, y) for x in items), y)
        return self.random.choice([" ", " | ", " &middot; "]).join(items)

    def other(self, kind: str) -> str:
        r = self.random
        tag = r.choice(TAGS[kind])
        if kind == "nav":
            inner = "".join(self.element("li", f'<a href="/{i}">{self.words(1)}</a>', 0) for i in range(r.randint(2, 9))) if tag == "ul" else self.links(r.randint(2, 9))
        elif kind == "header":
            inner = self.element("div", self.words(r.randint(1, 4)), 0, "header") + (self.links(r.randint(1, 5)) if r.random() < 0.5 else "") + (self.element("h1", self.words(2), 0) if r.random() < 0.3 else "")
        elif kind == "footer":
            inner = f"&copy; {self.words(2)} &middot; {self.paragraph()[:80]}" if r.random() < 0.6 else self.element("p", self.words(6), 0) + self.links(r.randint(1, 6))
        elif kind == "aside":
            inner = self.element("h3", self.words(2), 0) + (self.links(r.randint(2, 7)) if r.random() < 0.6 else "".join(self.element("p", self.paragraph()[:150], 0) for _ in range(r.randint(1, 3))))
        elif kind == "form":
            inner = self.element("label", self.words(2), 0) + '<input type="text">' + self.element("button", self.words(1), 0) + (self.element("p", self.paragraph()[:120], 0) if r.random() < 0.4 else "")
        elif kind == "comments":
            one = lambda: self.element("li" if tag == "ol" else "div", self.element("p", self.paragraph(), 0) if r.random() < 0.7 else self.paragraph(), 0, "comments")
            inner = (self.element("h3", self.words(2), 0) if tag != "ol" and r.random() < 0.5 else "") + "".join(one() for _ in range(r.randint(1, 5)))
        else:
            inner = self.paragraph()[: r.choice([60, 120, 400])] if tag == "p" or r.random() < 0.6 else self.element("p", self.paragraph()[:200], 0) + (self.element("button", self.words(1), 0) if r.random() < 0.5 else "")
        return self.element(tag, inner, 0, kind)

    def piece(self) -> str:
        r, x = self.random, self.random.random()
        if x < 0.72:
            text = self.paragraph()
            if r.random() < 0.2:
                text = f"<b>{text[:40]}</b>{text[40:]}" if "&" not in text[:44] else text
            if r.random() < 0.12:
                text += f' <a href="/x">{self.words(2)}</a>'
            return self.element("p", text, 1)
        if x < 0.82:
            return self.element(r.choice(["h2", "h3"]), self.words(r.randint(2, 6)), 1)
        if x < 0.89:
            return self.element(r.choice(["ul", "ol"]), "".join(self.element("li", self.paragraph()[:150], 1) for _ in range(r.randint(2, 5))), 1)
        if x < 0.93:
            return self.element("blockquote", self.element("p", self.paragraph(), 1), 1)
        if x < 0.95:
            return self.element("pre", self.paragraph(), 1)
        if x < 0.97:
            rows = "".join(self.element("tr", "".join(self.element("td", self.words(2), 1) for _ in range(3)), 1) for _ in range(r.randint(2, 4)))
            return self.element("table", rows, 1)
        return self.other(r.choice(["ad", "aside", "nav", "form", "notice"]))

    def main(self) -> str:
        r = self.random
        inner = (self.element("h1", self.words(r.randint(2, 8)), 1) if r.random() < 0.8 else "") + "".join(self.piece() for _ in range(r.choice([1, 1, 2, 3, 5, 8, 14, 25])))
        if r.random() < 0.3:
            inner = self.element("div", inner, 1, r.choice(["main", "wrap"]))
        return self.element(r.choice(TAGS["main"]), inner, 1, "main")

    def page(self) -> str:
        r = self.random
        before = [self.other(k) for k in ("notice", "header", "nav", "ad", "form", "aside") if r.random() < 0.4]
        after = [self.other(k) for k in ("ad", "aside", "comments", "form", "nav", "notice", "footer") if r.random() < 0.4]
        r.shuffle(before)
        body = "".join(before) + self.main() + "".join(after)
        for _ in range(r.choice([0, 0, 1, 2])):
            body = self.element("div", body, 1, "wrap")
        return f"<html data-y=\"1\"><head><title>{self.words(3)}</title><script>x()</script></head><body data-y=\"1\">{body}</body></html>"
