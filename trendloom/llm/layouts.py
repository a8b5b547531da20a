"""Labelled pages by rule: layouts as they are found on the web, with every part marked as main text or not.

The text is made of syllables in several scripts, so that a model learns from structure, naming, links and lengths, and not
from words. Pages differ in tags, names, nesting, missing end tags and in what is left unnamed.
"""

from __future__ import annotations

import random

from trendloom.llm.htmltree import LABEL

SYLLABLES = (
    "an be co da el fi go ha in ja ke lo mi no or pe qu ra st te ul vi wo xa ye zu th er on re".split(),
    "ád né üb öl ñi ço ßa ên ão ír vé où mè få sø".split(),
    "ка ло ми но ре та ва пе со ли на ди".split(),
    "αλ βε γο δα επ ιν κο λα με νο".split(),
)
# Names of elements by what they hold.
NAMES = {
    "main": "content post-content entry-content article-body story main-content text post page-content articleBody maincol primary entry body-copy article_text blog-post".split(),
    "neutral": "wrapper container page row col-md-8 layout inner site grid wrap region block box group outer clearfix".split(),
    "header": "header site-header masthead top page-header topbar branding logo banner-top".split(),
    "menu": "nav menu navbar main-menu navigation breadcrumb breadcrumbs toc pagination pager tags tag-list categories links skip-links subnav toolbar".split(),
    "footer": "footer site-footer bottom copyright colophon legal page-footer foot credits".split(),
    "side": "sidebar side aside widget secondary rail right-col left-col related recommended popular more-stories most-read trending see-also teaser".split(),
    "notice": "cookie cookie-banner consent gdpr notice alert popup modal overlay privacy-notice message paywall disclaimer warning announcement site-notice infobar".split(),
    "ad": "ad ads advert advertisement sponsored promo adsbygoogle banner ad-slot sponsor commercial promoted dfp-ad ad_box".split(),
    "share": "share social sharing share-buttons follow social-links addthis tweet".split(),
    "form": "newsletter subscribe signup login search search-form contact-form register form subscription".split(),
    "comments": "comments comment-list commentlist disqus discussion responses replies comment-section user-comments feedback reader-comments".split(),
    "comment": "comment reply response comment-body depth-1 comment-content".split(),
}
CUES = {
    "footer": ("Copyright", "All rights reserved.", "Privacy policy"), "notice": ("We use cookies.", "Cookie policy", "Privacy"),
    "ad": ("Advertisement", "Sponsored"), "form": ("Subscribe", "Newsletter", "Sign up", "Log in"), "side": ("Subscribe to our newsletter.",),
}
TAGS = {
    "header": ("header", "div"), "menu": ("nav", "ul", "div", "ol"), "footer": ("footer", "div", "p"), "side": ("aside", "div", "section"),
    "notice": ("div", "p", "section", "aside", "dialog"), "ad": ("div", "aside", "ins", "p", "section"), "share": ("div", "ul"), "form": ("form", "div"),
    "comments": ("section", "div", "ol", "ul", "aside"),
}


class _Writer:
    def __init__(self, draw: random.Random):
        self.draw = draw
        self.script = SYLLABLES[draw.choice((0, 0, 0, 0, 1, 1, 2, 3))]

    def word(self) -> str:
        if self.draw.random() < 0.3:
            return "".join(self.draw.choices(SYLLABLES[0] if self.script is SYLLABLES[1] else self.script, k=1))
        return "".join(self.draw.choices(self.script + (SYLLABLES[0] if self.script is SYLLABLES[1] else []), k=self.draw.randint(1, 4)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.draw.randint(low, high)))

    def sentences(self, low: int, high: int) -> str:
        return " ".join(self.words(1, 16).capitalize() + self.draw.choice("...?!") for _ in range(self.draw.randint(low, high)))

    def tagged(self, tag: str, kind: str | None, inside: str, label: int | None = None, named: float = 0.85) -> str:
        more = ""
        if kind and self.draw.random() < named:
            name = self.draw.choice(NAMES[kind])
            if self.draw.random() < 0.2:
                name += " " + self.draw.choice(NAMES["neutral"])
            more = f' {self.draw.choice(("class", "class", "id"))}="{name}"'
        if label is not None:
            more += f' {LABEL}="{label}"'
        return f"<{tag}{more}>{inside}</{tag}>"

    def links(self, low: int, high: int, tag: str = "li") -> str:
        n = self.draw.randint(low, high)
        if tag == "li":
            inside = "".join(f'<li><a href="/{i}">{self.words(1, 4)}</a>' + self.draw.choice(("</li>", "</li>", "")) for i in range(n))
            return self.draw.choice(("<ul>{}</ul>", "<ol>{}</ol>")).format(inside)
        return self.draw.choice((" | ", " ", " &middot; ")).join(f'<a href="/{i}">{self.words(1, 3)}</a>' for i in range(n))

    # Parts that are not main text

    def part(self, kind: str) -> str:
        draw = self.draw
        tag = draw.choice(TAGS[kind])
        if kind == "header":
            inside = draw.choice((f"<h1>{self.words(1, 3)}</h1>", f"<p>{self.words(2, 8)}</p>", f'<a href="/">{self.words(1, 3)}</a>'))
            inside += draw.choice(("", self.part("menu"), f"<div>{self.words(2, 6)}</div>"))
        elif kind in ("menu", "share"):
            inside = self.links(2, 9, draw.choice(("li", "li", "span")))
            if tag in ("ul", "ol"):
                inside = inside.replace("<ul>", "").replace("</ul>", "").replace("<ol>", "").replace("</ol>", "")
            elif draw.random() < 0.2:
                inside = f"<h3>{self.words(1, 3)}</h3>" + inside
        elif kind == "footer":
            inside = draw.choice(("&copy; ", "© 2020 ", "", "&copy; ")) + self.words(1, 12) + draw.choice(("", ".", " &middot; " + self.sentences(1, 3)))
            inside = draw.choice((inside, f"<p>{inside}</p>" if tag != "p" else inside, inside + self.links(2, 6, "span")))
        elif kind == "side":
            inside = f"<h{draw.randint(2, 4)}>{self.words(1, 4)}</h{draw.randint(2, 4)}>" if draw.random() < 0.7 else ""
            inside += draw.choice((self.links(2, 8), f"<p>{self.sentences(1, 4)}</p>", f"<div>{self.sentences(1, 3)}</div>", self.links(2, 5) + f"<p>{self.sentences(1, 3)}</p>"))
        elif kind in ("notice", "ad"):
            inside = self.sentences(1, 4) + draw.choice(("", f' <a href="/x">{self.words(1, 2)}</a>', "<button>x</button>"))
            inside = draw.choice((inside, f"<p>{inside}</p>" if tag != "p" else inside, f"<span>{inside}</span>"))
        elif kind == "form":
            inside = f"<label>{self.words(1, 4)}</label><input><button>{self.words(1, 2)}</button>"
            inside = draw.choice((inside, f"<p>{self.sentences(1, 2)}</p>" + inside, f"<h3>{self.words(1, 4)}</h3>" + inside, f"<div>{inside}</div>"))
        else:
            inside = f"<h{draw.randint(2, 4)}>{draw.randint(1, 99)} {self.words(1, 3)}</h{draw.randint(2, 4)}>" if draw.random() < 0.7 else ""
            item = "li" if tag in ("ol", "ul") else draw.choice(("div", "div", "article", "p"))
            for _ in range(draw.randint(1, 6)):
                said = self.sentences(1, 6) if item == "p" else draw.choice((f"<b>{self.words(1, 2)}</b> ", f"<div>{self.words(1, 3)}</div>", "")) + f"<p>{self.sentences(1, 7)}</p>"
                said += draw.choice(("", f'<a href="#">{self.words(1, 1)}</a>'))
                inside += self.tagged(item, "comment", said, named=0.7)
            if draw.random() < 0.3:
                inside += self.part("form")
        if kind in CUES and draw.random() < 0.25:
            cue = draw.choice(CUES[kind])
            inside = draw.choice((f"{cue} {inside}", f"<span>{cue}</span> {inside}", f"{inside} {cue}"))
        hidden = " hidden" if kind == "notice" and draw.random() < 0.1 else ""
        named = 0.95 if kind in ("notice", "ad", "comments", "side") and tag not in ("aside",) else 0.75
        made = self.tagged(tag, kind, inside, 0, named)
        return made.replace(f"<{tag}", f"<{tag}{hidden}", 1)

    # Main text

    def paragraph(self) -> str:
        draw = self.draw
        text = self.sentences(1, draw.choice((1, 1, 3, 8)))
        if draw.random() < 0.1:
            text = " ".join(w + draw.choice(("", "", "###", "***", "%", "|", ",")) for w in self.words(5, 60).split())
        elif draw.random() < 0.15:
            text = self.words(1, 6) + draw.choice(("", " |", ":", " | " + self.words(1, 3), ","))
        if draw.random() < 0.06:
            cue = draw.choice(CUES[draw.choice(tuple(CUES))])
            text = draw.choice((cue, f"{cue} {text}", f"{text} {cue}"))
        if draw.random() < 0.25:
            text = draw.choice(("<b>{}</b>", "<em>{}</em> ", "<b>{}<br>", '<a href="/l">{}</a> ')).format(self.words(1, 5)) + " " + text
        return "<p>" + text + draw.choice(("</p>", "</p>", "</p>", "", "<br></p>"))

    def body(self) -> str:
        draw = self.draw
        out = [f"<h1>{self.words(1, 9)}</h1>"] if draw.random() < 0.8 else []
        if draw.random() < 0.12:
            by = draw.choice(("p", "div", "address"))
            out.append(f'<{by} class="{draw.choice(("byline", "author", "date", "post-date", "published"))}">{self.words(1, 4)}</{by}>')
        if out and draw.random() < 0.15:
            out = [f"<header>{''.join(out)}</header>"]
        style = draw.random()
        for _ in range(draw.choice((1, 1, 2, 3, 5, 8, 12))):
            kind = draw.random()
            if style < 0.07:
                out.append(self.sentences(1, 5) + "<br><br>")
            elif style < 0.14:
                out.append(f"<div>{draw.choice((self.sentences(1, 6), self.sentences(1, 6), self.words(1, 8)))}</div>")
            elif style < 0.18:
                out += [f"<p>{self.words(1, 3)}{draw.choice(('.', ',', ''))}</p>" for _ in range(draw.randint(1, 12))]
            elif kind < 0.72:
                out.append(self.paragraph())
            elif kind < 0.8:
                out.append(f"<h{draw.choice((2, 2, 3, 4))}>{self.words(1, 7)}</h2>")
            elif kind < 0.86:
                items = "".join(f"<li>{self.sentences(1, 2)}" + draw.choice(("</li>", "")) for _ in range(draw.randint(2, 6)))
                out.append(draw.choice(("<ul>{}</ul>", "<ol>{}</ol>")).format(items))
            elif kind < 0.9:
                out.append(f"<blockquote>{draw.choice((self.paragraph(), self.sentences(1, 3)))}</blockquote>")
            elif kind < 0.93:
                out.append(f"<figure><img src='x'><figcaption>{self.sentences(1, 2)}</figcaption></figure>")
            elif kind < 0.96:
                rows = "".join("<tr>" + "".join(f"<td>{self.words(1, 5)}</td>" for _ in range(3)) + "</tr>" for _ in range(draw.randint(1, 4)))
                out.append(f"<table>{rows}</table>")
            else:
                out.append(f"<pre>{self.words(3, 20)}</pre>")
            if draw.random() < 0.08:
                out.append(self.part(draw.choice(("ad", "share", "side", "form", "menu", "ad"))))
        if draw.random() < 0.15:
            out.append(self.part(draw.choice(("share", "menu", "side", "comments", "footer"))))
        return "".join(out)

    def page(self) -> str:
        draw = self.draw
        tag, kind = draw.choice((("article", None), ("article", "main"), ("main", None), ("main", "main"), ("div", "main"), ("div", "main"), ("section", "main"), ("td", "main"), ("div", None)))
        article = self.tagged(tag, kind, self.body(), 1, 0.97)
        after = [self.part(k) for k, p in (("comments", 0.35), ("side", 0.3), ("share", 0.15), ("ad", 0.15), ("form", 0.1)) if draw.random() < p]
        if tag == "td":
            cells = [article, *[self.tagged("td", "side", self.links(2, 6), 0) for _ in range(draw.randint(0, 1))]]
            draw.shuffle(cells)
            article = f"<table><tr>{''.join(cells)}</tr></table>"
        middle = article + "".join(after)
        for _ in range(draw.choice((0, 0, 1, 1, 2, 3))):
            middle = self.tagged(draw.choice(("div", "div", "section", "main")), "neutral", middle, None, 0.8)
        before = [self.part(k) for k, p in (("notice", 0.3), ("header", 0.5), ("menu", 0.7), ("ad", 0.4), ("form", 0.1), ("side", 0.1)) if draw.random() < p]
        if draw.random() < 0.3:
            draw.shuffle(before)
        end = [self.part(k) for k, p in (("side", 0.2), ("ad", 0.1), ("menu", 0.2), ("footer", 0.85), ("notice", 0.15)) if draw.random() < p]
        closing = draw.choice(("</body></html>", "</body></html>", ""))
        head = f"<head><title>{self.words(1, 6)}</title><style>p{{}}</style><script>var t='</p>';</script></head>"
        if draw.random() < 0.08:
            return f'<div {LABEL}="0">{"".join(before)}{middle}{"".join(end)}</div>'
        return f'<!DOCTYPE html><html {LABEL}="0">{head}<body>{"".join(before)}{middle}{"".join(end)}{closing}'


def labelled_pages(number: int, seed: int = 11) -> list[str]:
    """So many pages, always the same ones, marked by the attribute ``htmltree.LABEL``."""
    draw = random.Random(seed)
    return [_Writer(draw).page() for _ in range(number)]
