"""Generated page layouts with known content, to train the block labeller on."""

from __future__ import annotations

import random

# Names that page authors give to the parts of a page.
NAMES = {
    "nav": "nav navbar menu main-menu navigation breadcrumb breadcrumbs site-nav topnav links tabs".split(),
    "header": "header site-header masthead top-bar branding page-header banner-top logo".split(),
    "footer": "footer site-footer bottom colophon copyright page-footer legal".split(),
    "sidebar": "sidebar side aside widget widgets rail right-column secondary related popular trending".split(),
    "notice": "notice cookie cookie-notice consent alert banner popup modal newsletter gdpr".split(),
    "ad": "ad ads advert advertisement sponsored promo ad-slot adbox banner-ad dfp".split(),
    "form": "form search search-form subscribe signup login contact-form newsletter-form".split(),
    "comments": "comments comment-list discussion replies responses comment-section disqus reader-comments".split(),
    "share": "share social share-buttons tags meta post-meta pager pagination".split(),
}
TAGS = {"nav": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form"}
BODY = "content post entry article story main-content post-body entry-content text body article-body page-content".split()
PHRASES = {
    "nav": ["Home", "About", "Contact", "News", "Blog", "Products", "Login", "Next", "Previous"],
    "header": ["Welcome", "Search", "Sign in", "The daily", "Menu"],
    "footer": ["© 2024", "All rights reserved.", "Privacy policy", "Terms of use", "Imprint", "&copy; site &middot;"],
    "sidebar": ["Related articles", "Most read", "Popular", "Archive", "Follow us"],
    "notice": ["We use cookies.", "Accept", "This site uses cookies to improve your experience.", "Subscribe now!"],
    "ad": ["Advertisement", "Sponsored", "Buy now", "Special offer"],
    "form": ["Email", "Your name", "Submit", "Search", "Subscribe", "Password"],
    "comments": ["Reply", "Comments", "Leave a comment", "says:", "2 hours ago", "Anonymous"],
    "share": ["Share this", "Tweet", "Tags:", "Posted by", "Print"],
}
SYLLABLES = "an be ca de el fo ga hi in ja ko lu ma no os pa qui re sa ti un va wi xe yo zu ch sh th é ü ñ ß".split()


class Page:
    def __init__(self, r: random.Random) -> None:
        self.r = r
        self.symbols = r.random() < 0.1
        self.capitals = r.random() < 0.05

    def word(self) -> str:
        if self.r.random() < 0.03:  # words of menus and notices occur in articles too
            return self.r.choice(self.r.choice(PHRASES[self.r.choice(list(PHRASES))]).split())
        word = "".join(self.r.choices(SYLLABLES, k=self.r.choice((1, 1, 2, 2, 3, 4))))
        if self.symbols:
            word += self.r.choice(("%%%", "***", "###", "$$$", "&amp;&amp;"))
        return word.upper() if self.capitals else word

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(low, high)))

    def sentences(self, low: int, high: int) -> str:
        return " ".join(self.words(1, 14).capitalize() + "." for _ in range(self.r.randint(low, high)))

    def named(self, kind: str, inner: str) -> str:
        """A part of the page in its semantic tag, or in a div or section with a name."""
        r = self.r
        name = r.choice(NAMES[kind])
        form = r.random()
        if kind in TAGS and form < 0.5:
            tag = TAGS[kind]
            return f"<{tag}>{inner}</{tag}>" if r.random() < 0.6 else f'<{tag} class="{name}">{inner}</{tag}>'
        tag = r.choice(("div", "div", "section", "ul" if inner.startswith("<li") else "div"))
        attribute = r.choice(("class", "class", "id"))
        extra = f" {r.choice(('clearfix', 'row', 'box', 'inner'))}" if attribute == "class" and r.random() < 0.3 else ""
        return f'<{tag} {attribute}="{name}{extra}">{inner}</{tag}>'

    def boilerplate(self, kind: str) -> str:
        r = self.r

        def phrase() -> str:
            return r.choice(PHRASES[kind]) if r.random() < 0.5 else self.words(1, 5)

        if kind in ("nav", "sidebar", "share") and r.random() < 0.85:
            items = [f'<a href="/{i}">{phrase()}</a>' for i in range(r.randint(2, 9))]
            inner = r.choice(
                (
                    "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>",
                    " | ".join(items),
                    "".join(f"<p>{x}</p>" for x in items),
                )
            )
            if kind == "sidebar" and r.random() < 0.6:
                inner = f"<h3>{phrase()}</h3>{inner}"
                if r.random() < 0.5:
                    inner += f"<p>{self.sentences(1, 3)}</p>"
        elif kind == "comments":
            each = [
                r.choice(("<p>{}</p>", "<div class='comment'><b>{}</b><p>{}</p></div>", "<li>{}</li>")).format(
                    self.sentences(1, 4), self.sentences(1, 3)
                )
                for _ in range(r.randint(1, 6))
            ]
            inner = f"<h3>{phrase()}</h3>" + "".join(each)
        elif kind == "form":
            inner = "".join(f"<label>{phrase()}</label><input name=q>" for _ in range(r.randint(1, 3)))
            inner += f"<button>{phrase()}</button>"
            if r.random() < 0.4:
                inner = f"<p>{self.sentences(1, 2)}</p>{inner}"
        elif kind == "header":
            inner = r.choice((f"<h1>{self.words(1, 4)}</h1>", f"<a href='/'>{phrase()}</a>", f"<p>{phrase()}</p>"))
            if r.random() < 0.3:
                inner += f"<p>{self.words(2, 8)}</p>"
        else:
            text = " ".join([phrase(), self.sentences(0, 3) if r.random() < 0.7 else ""])
            inner = text if r.random() < 0.6 else f"<p>{text}</p>"
        return self.named(kind, inner)

    def paragraph(self) -> str:
        r, text = self.r, self.sentences(1, 9)
        if r.random() < 0.2:
            text = self.words(1, 6)
        if r.random() < 0.2:
            at = text.find(" ") + 1
            text = f'{text[:at]}<a href="/x">{self.words(1, 3)}</a> {text[at:]}'
        return r.choice((f"<p>{text}</p>",) * 6 + (f"<p><b>{text}<br>", f"<p>{text}", f"<p><em>{text}</em></p>"))

    def article(self) -> str:
        r = self.r
        parts = []
        if r.random() < 0.85:
            tag = r.choice(("h1", "h1", "h1", "h2"))
            parts.append(f"<{tag}>{self.words(2, 12)}</{tag}>")
        for _ in range(r.choice((1, 2, 3, 5, 8, 12))):
            kind = r.random()
            if kind < 0.8:
                parts.append(self.paragraph())
            elif kind < 0.86:
                parts.append(f"<h2>{self.words(1, 7)}</h2>")
            elif kind < 0.91:
                parts.append("<ul>" + "".join(f"<li>{self.words(2, 14)}</li>" for _ in range(3)) + "</ul>")
            elif kind < 0.94:
                parts.append(f"<blockquote><p>{self.sentences(1, 3)}</p></blockquote>")
            elif kind < 0.96:
                parts.append(f"<pre>{self.words(3, 12)}</pre>")
            elif kind < 0.98:
                cells = "".join(f"<tr><td>{self.words(1, 3)}</td><td>{self.words(1, 3)}</td></tr>" for _ in range(2))
                parts.append(f"<table>{cells}</table>")
            else:
                parts.append(f"<figure><figcaption>{self.sentences(1, 1)}</figcaption></figure>")
        inserted = [(r.randint(1, len(parts)), r.choice(("ad", "share", "sidebar", "notice", "form"))) for _ in range(r.choice((0, 0, 0, 1)))]
        # The mark of content sits on an element of its own, which a path leaves out.
        pieces, start = [], 0
        for at, kind in sorted(inserted):
            pieces += [("keep", "".join(parts[start:at])), ("drop", self.boilerplate(kind))]
            start = at
        pieces.append(("keep", "".join(parts[start:])))
        inner = "".join(f"<x-mark data-keep>{x}</x-mark>" if k == "keep" else x for k, x in pieces if x)
        if r.random() < 0.2:
            inner += self.boilerplate(r.choice(("comments", "share")))
        form = r.random()
        if form < 0.5:
            return f"<article>{inner}</article>"
        if form < 0.62:
            return f"<main>{inner}</main>"
        if form < 0.7:
            return f"<main><article>{inner}</article></main>"
        if form < 0.95:
            return f'<div {r.choice(("class", "id"))}="{r.choice(BODY)}">{inner}</div>'
        return inner

    def build(self) -> str:
        r = self.r
        before = [k for k, share in (("notice", 0.2), ("header", 0.4), ("nav", 0.8), ("ad", 0.4), ("form", 0.15)) if r.random() < share]
        after = [k for k, share in (("sidebar", 0.35), ("comments", 0.3), ("form", 0.2), ("ad", 0.2), ("nav", 0.1), ("footer", 0.85)) if r.random() < share]
        if r.random() < 0.3:
            r.shuffle(before)
        if r.random() < 0.15 and "sidebar" in after:
            after.remove("sidebar")
            before.append("sidebar")
        body = "".join(self.boilerplate(k) for k in before) + self.article()
        body += "".join(self.boilerplate(k) for k in after)
        if r.random() < 0.3:
            body = f'<div {r.choice(("class", "id"))}="{r.choice(("wrapper", "container", "page", "site"))}">{body}</div>'
        return f"<!DOCTYPE html><html><head><title>{self.words(1, 5)}</title></head><body>{body}</body></html>"


def layouts(n: int, seed: int) -> list[str]:
    """Pages whose content lies in elements with the attribute ``data-keep``."""
    r = random.Random(seed)
    return [Page(r).build() for _ in range(n)]
