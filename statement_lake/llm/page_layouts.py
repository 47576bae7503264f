"""Labelled pages to learn from: texts of the corpus set in drawn layouts.

Pages come without labels.  Texts of a sample are set anew in layouts whose
parts are known, in many ways of marking them up; sampled pages that mark their
article themselves are added as they are.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Sequence

from statement_lake.llm.html_blocks import Block, Frame

# Usual names of the parts of a page, and words such parts hold.
MAIN = """article post entry content main story text body post-content entry-content article-body story-body
    main-content page-content blog-post hentry post-text article-text content-body single-post article-content""".split()
MENU = """nav navbar menu main-nav navigation topnav breadcrumb crumbs site-nav primary-menu nav-list tabs pagination
    pager toc skip-link nav-links main-menu dropdown""".split()
HEADER = """header site-header masthead top-bar page-header banner logo branding site-title top topbar head""".split()
FOOTER = """footer site-footer page-footer colophon bottom copyright legal foot main-footer credits""".split()
SIDE = """sidebar side-bar aside widget widget-area right-column left-column secondary rail related popular
    recent-posts archives tag-cloud most-read recommended trending see-also related-posts""".split()
AD = """ad ads advert advertisement adsbygoogle banner-ad promo sponsored sponsor ad-slot ad-box commercial
    promotion dfp adunit teaser ad-container""".split()
NOTICE = """notice cookie-notice cookie-banner consent gdpr alert announcement popup modal newsletter subscribe
    warning message toast notification cookies privacy overlay disclaimer paywall""".split()
COMMENT = """comments comment comment-list commentlist reply discussion responses disqus comment-body respond
    comment-text reader-comments user-comment thread feedback""".split()
FORM = "form search search-form login signup contact-form newsletter-form subscribe-form comment-form field poll".split()
SHARE = "share social sharing share-buttons social-links follow author-box byline meta post-meta tags tools print".split()
PLAIN = """wrap wrapper container inner outer row col column page site box section block grid left right center
    clearfix layout region module panel card content-wrap md sm lg""".split()
PHRASES = {
    "menu": "Home|About|Contact|News|Sport|Blog|Shop|Login|Start|Über uns|Kontakt|Accueil|Inicio|Contacto|Next|Previous|More",
    "footer": "© 2023 All rights reserved.|Privacy policy|Terms of use|Imprint|Impressum|Datenschutz|Mentions légales|"
    "Aviso legal|Copyright|Powered by",
    "notice": "We use cookies to improve your experience.|Accept all|Subscribe to our newsletter|This site uses cookies|"
    "Wir verwenden Cookies|Nous utilisons des cookies|Usamos cookies|Please log in to continue.",
    "comment": "Leave a reply|3 comments|Reply|Posted by|says:|Great article, thanks!|I do not agree.|Kommentare|Commentaires|"
    "Comentarios|2 days ago",
    "form": "Search|Name|E-mail|Your message|Send|Password|Log in|Suche|Rechercher|Buscar|Submit|Required",
    "side": "Related articles|Most read|Recent posts|Categories|Archives|Tags|Follow us|Popular|Mehr zum Thema|À lire aussi",
    "ad": "Advertisement|Sponsored|Anzeige|Publicité|Publicidad|Buy now|Special offer|Ad",
    "share": "Share on Facebook|Tweet|Print|Share this|E-mail this|Teilen|Partager|Follow",
}


class Layouts:
    """Draws pages as labelled blocks; 1 is main text."""

    def __init__(self, long_texts: Sequence[str], seed: int):
        self.draw = random.Random(seed)
        self.texts = list(long_texts) or ["text"]
        self.phrases = {name: listed.split("|") for name, listed in PHRASES.items()}
        self.found: list[tuple[Block, int]] = []

    # -- texts ------------------------------------------------------------------------

    def prose(self, least: int = 1, most: int = 80) -> str:
        words = self.draw.choice(self.texts).split()
        size = min(most, max(least, round(self.draw.lognormvariate(3, 1.1))))
        at = self.draw.randrange(max(1, len(words) - size + 1))
        return " ".join(words[at : at + size]) or "text"

    def short(self, kind: str) -> str:
        if self.draw.random() < 0.5:
            return self.draw.choice(self.phrases[kind])
        return self.prose(1, 6)

    # -- marking up -----------------------------------------------------------------

    def words(self, names: Sequence[str], sure: float = 0.85) -> tuple[str, ...]:
        said: list[str] = []
        if self.draw.random() < sure:
            said += self.draw.choice(names).split("-")
        if self.draw.random() < 0.2:
            said += self.draw.choice(names).split("-")
        if self.draw.random() < 0.25:
            said += self.draw.choice(PLAIN).split("-")
        if self.draw.random() < 0.1:
            said.append("".join(self.draw.choices("abcdefghijklmnopqrstuvwxyz", k=self.draw.randint(3, 8))))
        return tuple(dict.fromkeys(w[:-1] if w.endswith("s") and len(w) > 2 else w for w in said))

    def part(self, names: Sequence[str], tags: str, bare: str) -> Frame:
        """A part of a page: a telling tag, or a common one with a telling name."""
        tag = self.draw.choice((tags.split() + bare.split()) if self.draw.random() < 0.6 else bare.split())
        telling = tag in tags.split()
        return Frame(tag, self.words(names, 0.5 if telling else 1.0))

    def put(self, path: Sequence[Frame], text: str, label: int, linked: float = 0.0) -> None:
        size = round(linked * len(text))
        self.found.append((Block(tuple(path), text, size, int(size > 0)), label))

    def put_links(self, path: list[Frame], kind: str, many: int) -> None:
        inside = self.draw.random()
        for _ in range(many):
            own = [*path, Frame("ul", ()), Frame("li", ())] if inside < 0.7 else [*path, Frame("div", ())]
            self.put(own, self.short(kind), 0, 0.0 if self.draw.random() < 0.1 else 1.0)

    # -- parts ------------------------------------------------------------------------

    def menu(self, path: list[Frame]) -> None:
        self.put_links([*path, self.part(MENU, "nav menu", "div ul")], "menu", self.draw.randint(2, 14))

    def header(self, path: list[Frame]) -> None:
        own = [*path, self.part(HEADER, "header", "div")]
        self.put([*own, Frame(self.draw.choice(["h1", "h2", "div", "p", "a"]), ())], self.prose(1, 6), 0, self.draw.choice([0, 1]))
        if self.draw.random() < 0.4:
            self.put([*own, Frame(self.draw.choice(["p", "div"]), ())], self.prose(2, 12), 0)
        if self.draw.random() < 0.4:
            self.menu(own)

    def footer(self, path: list[Frame]) -> None:
        own = [*path, self.part(FOOTER, "footer", "div")]
        for _ in range(self.draw.randint(1, 4)):
            inner = own if self.draw.random() < 0.4 else [*own, Frame(self.draw.choice(["p", "div", "small", "span"]), ())]
            text = self.short("footer") if self.draw.random() < 0.5 else "© " + self.prose(2, 40)
            self.put(inner, text, 0, self.draw.choice([0, 0, 0.5]))
        if self.draw.random() < 0.4:
            self.put_links(own, "footer", self.draw.randint(2, 8))

    def side(self, path: list[Frame]) -> None:
        own = [*path, self.part(SIDE, "aside", "div section")]
        for _ in range(self.draw.randint(1, 3)):
            box = own if self.draw.random() < 0.5 else [*own, Frame("div", self.words(SIDE))]
            self.put([*box, Frame(self.draw.choice(["h2", "h3", "h4", "div"]), ())], self.short("side"), 0)
            if self.draw.random() < 0.6:
                self.put_links(box, "side", self.draw.randint(2, 8))
            else:
                for _ in range(self.draw.randint(1, 3)):
                    self.put([*box, Frame(self.draw.choice(["p", "div"]), ())], self.prose(2, 50), 0)

    def advert(self, path: list[Frame]) -> None:
        own = [*path, self.part(AD, "aside ins", "div")]
        for _ in range(self.draw.choice([1, 1, 2])):
            inner = own if self.draw.random() < 0.6 else [*own, Frame(self.draw.choice(["p", "span", "a"]), ())]
            self.put(inner, self.short("ad") if self.draw.random() < 0.3 else self.prose(2, 40), 0, self.draw.choice([0, 0, 1]))

    def notice(self, path: list[Frame]) -> None:
        own = [*path, self.part(NOTICE, "dialog", "div section aside")]
        for _ in range(self.draw.randint(1, 3)):
            inner = own if self.draw.random() < 0.5 else [*own, Frame(self.draw.choice(["p", "button", "span", "a"]), ())]
            self.put(inner, self.short("notice") if self.draw.random() < 0.5 else self.prose(3, 50), 0, self.draw.choice([0, 0, 1]))

    def form(self, path: list[Frame]) -> None:
        own = [*path, Frame("form", self.words(FORM, 0.6))]
        for _ in range(self.draw.randint(1, 5)):
            self.put([*own, Frame(self.draw.choice(["label", "p", "button", "div", "legend", "h3"]), ())], self.short("form"), 0)

    def comments(self, path: list[Frame]) -> None:
        own = [*path, self.part(COMMENT, "section", "div ol")]
        if "comment" not in own[-1].words and "reply" not in own[-1].words:
            own[-1] = Frame(own[-1].tag, (*own[-1].words, "comment"))
        if self.draw.random() < 0.7:
            self.put([*own, Frame(self.draw.choice(["h2", "h3", "h4"]), ())], self.short("comment"), 0)
        for _ in range(self.draw.randint(1, 8)):
            one = [*own, Frame(self.draw.choice(["div", "li", "article"]), self.words(COMMENT, 0.7))]
            if self.draw.random() < 0.5:
                self.put([*one, Frame(self.draw.choice(["span", "b", "cite", "div", "footer", "header"]), ())], self.prose(1, 3), 0)
            for _ in range(self.draw.choice([1, 1, 2])):
                self.put([*one, Frame("p", ())] if self.draw.random() < 0.8 else one, self.prose(2, 80), 0)
        if self.draw.random() < 0.3:
            self.form(own)

    def share(self, path: list[Frame]) -> None:
        own = [*path, Frame(self.draw.choice(["div", "ul", "p"]), self.words(SHARE, 1.0))]
        self.put_links(own, "share", self.draw.randint(1, 4))

    def article(self, path: list[Frame]) -> None:
        draw = self.draw
        kind = draw.random()
        if kind < 0.45:
            own = [*path, Frame(draw.choice(["article", "article", "main"]), self.words(MAIN, 0.3))]
        elif kind < 0.85:
            own = [*path, Frame(draw.choice(["div", "section", "td"]), self.words(MAIN, 1.0))]
        else:
            own = list(path)
        if draw.random() < 0.2:
            own = [*own, Frame("div", self.words(PLAIN, 0.7))]
        title = [*own, Frame("header", self.words(HEADER, 0.2))] if draw.random() < 0.15 else own
        if draw.random() < 0.9:
            self.put([*title, Frame(draw.choice(["h1", "h1", "h2"]), self.words(["title", "headline", "post-title"], 0.3))], self.prose(1, 16), 1)
        inserts = [self.advert, self.side, self.share, self.notice, self.menu, self.form]
        for number in range(max(1, round(draw.lognormvariate(1.9, 0.8)))):
            self.body(own)
            if draw.random() < 0.06 and number:
                draw.choice(inserts)(own)
        if draw.random() < 0.15:
            self.share(own)
        if draw.random() < 0.15:
            self.comments(own)

    def body(self, own: list[Frame]) -> None:
        draw, kind = self.draw, self.draw.random()
        linked = draw.choice([0, 0, 0, 0.05, 0.2, 0.6])
        if kind < 0.64:
            inner = [*own, Frame("p", ())] + ([Frame(draw.choice(["b", "i", "strong", "em", "span"]), ())] if draw.random() < 0.15 else [])
            self.put(inner, self.prose(1, 200), 1, linked)
        elif kind < 0.71:
            self.put([*own, Frame(draw.choice(["h2", "h3", "h4"]), ())], self.prose(1, 10), 1)
        elif kind < 0.85:
            for _ in range(draw.randint(2, 6)):
                self.put([*own, Frame(draw.choice(["ul", "ol"]), ()), Frame("li", ())], self.prose(1, 30), 1, draw.choice([0, 0, 0.3]))
        elif kind < 0.90:
            self.put([*own, Frame("blockquote", ())] + ([Frame("p", ())] if draw.random() < 0.6 else []), self.prose(3, 60), 1)
        elif kind < 0.94:
            for _ in range(draw.randint(2, 8)):
                self.put([*own, Frame("table", ()), Frame("tr", ()), Frame(draw.choice(["td", "th"]), ())], self.prose(1, 6), 1)
        elif kind < 0.96:
            self.put([*own, Frame("figure", ()), Frame("figcaption", ())], self.prose(2, 20), 1)
        elif kind < 0.98:
            self.put([*own, Frame("pre", ())] + ([Frame("code", ())] if draw.random() < 0.5 else []), self.prose(3, 40), 1)
        else:
            self.put([*own, Frame("div", self.words(PLAIN, 0.5))], self.prose(3, 80), 1)

    def page(self) -> tuple[list[Block], list[int]]:
        draw = self.draw
        self.found = []
        path = [Frame("html", ()), Frame("body", self.words(PLAIN, 0.2))] if draw.random() < 0.9 else []
        for _ in range(draw.choice([0, 0, 1, 1, 2])):
            path = [*path, Frame("div", self.words(PLAIN, 0.8))]

        def some(parts: Sequence[tuple[Callable, float]], where: list[Frame]) -> None:
            chosen = [part for part, share in parts if draw.random() < share]
            draw.shuffle(chosen)
            for part in chosen:
                part(where)

        some([(self.header, 0.4), (self.menu, 0.6), (self.notice, 0.25), (self.advert, 0.35), (self.form, 0.15)], path)
        around = path if draw.random() < 0.5 else [*path, Frame("div", self.words(PLAIN, 0.8))]
        some([(self.side, 0.15), (self.menu, 0.1), (self.advert, 0.1)], around)
        if draw.random() < 0.97:
            self.article(around)
        some([(self.side, 0.3), (self.comments, 0.3), (self.advert, 0.2), (self.share, 0.1), (self.menu, 0.1)], around)
        some([(self.footer, 0.75), (self.notice, 0.15), (self.form, 0.1)], path)
        blocks = [block for block, _ in self.found]
        return blocks, [label for _, label in self.found]


#: Tags and names by which a page tells its parts itself.
TOLD_OUT = {"nav", "footer", "aside", "form", "menu", "dialog"}
TOLD_NAMES = {w[:-1] if w.endswith("s") else w for w in "nav menu sidebar ad ads advert advertisement comment footer share cookie".split()}


def told_labels(blocks: Sequence[Block]) -> list[int] | None:
    """Labels of a page that marks its article by a tag of its own; None for other pages."""
    labels = []
    for block in blocks:
        tags = [f.tag for f in block.path]
        inside = next((i for i, tag in enumerate(tags) if tag in ("article", "main")), None)
        if inside is None:
            labels.append(0)
            continue
        within = block.path[inside + 1 :]
        out = any(f.tag in TOLD_OUT or TOLD_NAMES & set(f.words) for f in within)
        labels.append(0 if out or any(tag in TOLD_OUT for tag in tags[:inside]) else 1)
    return labels if any(labels) else None
