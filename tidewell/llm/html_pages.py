"""Labelled pages to train the page model on: common layouts with invented words.

Elements say with `data-main-text` whether they, and what is below them, are main text.
"""

from __future__ import annotations

import random

SYLLABLES = "ba co di fe gu ha jo ka li mo nu pe qui ra so tu ve wi xa yo zen tor lin mar".split()


class _Layout:
    """Draws one page."""

    def __init__(self, rng: random.Random):
        self.rng = rng

    def pick(self, *options):
        return self.rng.choice(options)

    def chance(self, share: float) -> bool:
        return self.rng.random() < share

    def words(self, low: int, high: int) -> str:
        made = ["".join(self.rng.choices(SYLLABLES, k=self.rng.randint(1, 3))) for _ in range(self.rng.randint(low, high))]
        return " ".join(made)

    def sentences(self, low: int, high: int) -> str:
        return " ".join(self.words(4, 14).capitalize() + self.pick(".", ".", "!", "?") for _ in range(self.rng.randint(low, high)))

    def element(self, tag: str, inner: str, main: int | None = None, attrs: str = "") -> str:
        mark = "" if main is None else f' data-main-text="{main}"'
        return f"<{tag}{' ' + attrs if attrs else ''}{mark}>{inner}</{tag}>"

    def links(self, low: int, high: int) -> str:
        return "".join(f'<li><a href="/x">{self.words(1, 4)}</a></li>' for _ in range(self.rng.randint(low, high)))

    def navigation(self) -> str:
        items = f"<ul>{self.links(3, 9)}</ul>"
        return self.pick(
            self.element("nav", items, 0), self.element("div", items, 0, 'class="menu"'), self.element("ul", self.links(3, 8), 0, 'id="nav"'),
            self.element("div", " | ".join(f'<a href="/">{self.words(1, 2)}</a>' for _ in range(5)), 0, 'class="breadcrumbs"'),
        )

    def header(self) -> str:
        inner = self.pick(f"<h1>{self.words(1, 3)}</h1>", f'<div><a href="/">{self.words(1, 3)}</a></div>', f"<p>{self.words(2, 8)}</p>", "")
        inner += self.navigation() if self.chance(0.5) else ""
        return self.pick(
            self.element("header", inner, 0), self.element("div", inner, 0, 'id="header"'), self.element("div", inner, 0, 'class="masthead"')
        )

    def footer(self) -> str:
        inner = self.pick("&copy; ", "Copyright 2020 ", "") + self.words(2, 9) + self.pick("", " &middot; ", ". ") + self.sentences(0, 2)
        inner = self.pick(inner, f"<p>{inner}</p>", f"<ul>{self.links(2, 6)}</ul><p>{inner}</p>")
        return self.pick(
            self.element("footer", inner, 0), self.element("div", inner, 0, 'class="footer"'), self.element("div", inner, 0, 'id="site-footer"')
        )

    def advert(self) -> str:
        inner = self.pick(self.sentences(1, 3), f"<p>{self.sentences(1, 3)}</p>", f'<a href="/buy">{self.words(3, 9)}</a>')
        return self.pick(
            self.element("div", inner, 0, 'class="ad"'), self.element("div", inner, 0, 'class="ad-slot"'),
            self.element("aside", inner, 0, 'class="sponsored"'), self.element("div", inner, 0, 'id="promo"'),
            self.element("section", inner, 0, 'class="advertisement"'),
        )

    def notice(self) -> str:
        inner = self.pick(self.sentences(1, 3), f"<p>{self.sentences(1, 3)}</p>") + self.pick("", "<button>OK</button>", '<a href="/p">more</a>')
        return self.pick(
            self.element("div", inner, 0, 'class="cookie-notice"'), self.element("div", inner, 0, 'id="consent"'),
            self.element("div", inner, 0, 'role="dialog"'), self.element("section", inner, 0, 'class="notice"'),
            self.element("div", inner, 0, 'class="alert banner"'),
        )

    def sidebar(self) -> str:
        level = self.pick("h2", "h3", "h4")
        inner = f"<{level}>{self.words(1, 3)}</{level}>" + self.pick(f"<ul>{self.links(3, 8)}</ul>", f"<p>{self.sentences(1, 4)}</p>")
        return self.pick(
            self.element("aside", inner, 0), self.element("div", inner, 0, 'class="sidebar"'), self.element("div", inner, 0, 'id="related"'),
            self.element("section", inner, 0, 'class="widget"'), self.element("aside", inner, 0, 'class="related-posts"'),
        )

    def form(self) -> str:
        inner = f'<label>{self.words(1, 4)}</label><input name="q"><button>{self.words(1, 2)}</button>'
        inner = self.pick("", f"<h3>{self.words(2, 4)}</h3>", f"<p>{self.sentences(1, 2)}</p>") + inner
        plain = self.element("form", inner, 0)
        return self.pick(plain, plain, self.element("div", self.element("form", inner), 0, 'class="newsletter"'))

    def comments(self) -> str:
        def one() -> str:
            said = self.pick(f"<p>{self.sentences(1, 5)}</p>", self.sentences(1, 4))
            return self.pick(
                self.element("div", said, None, 'class="comment"'), self.element("li", said), self.element("article", said, None, 'class="comment"')
            )

        inner = self.pick(f"<h2>{self.words(1, 3)}</h2>", f"<h3>3 {self.words(1, 2)}</h3>", "")
        inner += "".join(one() for _ in range(self.rng.randint(1, 5)))
        return self.pick(
            self.element("section", inner, 0, 'class="comments"'), self.element("div", inner, 0, 'id="comments"'),
            self.element("ol", inner, 0, 'class="commentlist"'), self.element("div", inner, 0, 'id="discussion"'),
        )

    def share(self) -> str:
        inner = "".join(f'<a href="/s">{self.words(1, 1)}</a> ' for _ in range(4))
        return self.element("div", inner, 0, self.pick('class="share"', 'class="social-links"'))

    def paragraph(self) -> str:
        text = self.sentences(1, 6)
        if self.chance(0.3):
            text += f' <a href="/r">{self.words(1, 4)}</a> {self.sentences(1, 2)}'
        if self.chance(0.2):
            text = f"<b>{text}</b><br>{self.sentences(1, 2)}"
        if self.chance(0.06):
            text = self.words(1, 3)
        return self.pick(f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}")

    def body(self) -> str:
        parts = [f"<h1>{self.words(2, 9)}</h1>"] if self.chance(0.85) else []
        if self.chance(0.12):
            parts[:1] = [f"<header data-main-text=\"1\"><h1>{self.words(2, 9)}</h1></header>"]
        for _ in range(self.rng.randint(0, 9)):
            parts.append(self.paragraph())
            if self.chance(0.06):
                # Lists of short lines, often the same one again.
                line = f"<p>{self.words(1, 3)}{self.pick('.', '')}</p>"
                parts += [line] * self.rng.randint(2, 40)
            if self.chance(0.12):
                parts.append(f"<h2>{self.words(2, 6)}</h2>")
            if self.chance(0.07):
                parts.append("<ul>" + "".join(f"<li>{self.words(3, 12)}</li>" for _ in range(4)) + "</ul>")
            if self.chance(0.07):
                parts.append(self.pick(
                    f"<blockquote>{self.sentences(1, 3)}</blockquote>", f"<pre>{self.words(4, 20)}</pre>",
                    f"<blockquote><p>{self.sentences(1, 3)}</p></blockquote>",
                    f"<figure><img src=x><figcaption>{self.words(3, 10)}</figcaption></figure>",
                    f"<table><tr><td>{self.words(1, 4)}</td><td>{self.words(1, 4)}</td></tr></table>",
                ))
            if self.chance(0.06):
                parts.append(self.pick(self.advert, self.sidebar, self.form, self.share, self.notice)())
        return "".join(parts)

    def content(self) -> str:
        inner = self.body()
        if self.chance(0.15):
            inner += self.pick(self.share, self.comments, self.sidebar, self.footer)()
        made = self.pick(
            self.element("article", inner, 1), self.element("article", inner, 1), self.element("article", inner, 1, 'class="post"'),
            self.element("main", inner, 1), self.element("div", inner, 1, 'class="content"'), self.element("div", inner, 1, 'id="main-content"'),
            self.element("div", inner, 1, 'class="entry-content"'), self.element("section", inner, 1, 'class="story"'), self.element("div", inner, 1),
        )
        if self.chance(0.25):
            made = self.element("main", made)
        if self.chance(0.2):
            made = self.element("div", made + (self.sidebar() if self.chance(0.5) else ""), None, self.pick('class="container"', 'id="wrapper"', ""))
        return made

    def page(self) -> str:
        if self.chance(0.05):
            return self.pick(self.element("body", self.body(), 1), self.element("div", self.sentences(1, 5), 1), self.paragraph())
        before = [self.notice] * self.chance(0.3) + [self.header] * self.chance(0.5) + [self.navigation] * self.chance(0.7)
        before += [self.advert] * self.chance(0.5) + [self.sidebar] * self.chance(0.2) + [self.form] * self.chance(0.15)
        after = [self.comments] * self.chance(0.35) + [self.sidebar] * self.chance(0.3) + [self.advert] * self.chance(0.2)
        after += [self.form] * self.chance(0.2) + [self.footer] * self.chance(0.85) + [self.notice] * self.chance(0.1)
        inner = "".join(f() for f in before) + self.content() + "".join(f() for f in after)
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title></head><body>{inner}</body></html>"


def labelled_pages(count: int, seed: int) -> list[str]:
    """`count` pages, the same for the same seed."""
    rng = random.Random(seed)
    return [_Layout(rng).page() for _ in range(count)]
