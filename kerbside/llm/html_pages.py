"""Labelled pages that the block labeller is trained on: common layouts, filled with random words.

A page is a list of parts; every part is written with its label, 1 for the article and 0 for everything around it.
"""

import random

from .html_blocks import Block, blocks

MARK = "⁣"  # an invisible separator in front of article text tells the label; it is removed again

CONTAINERS = (
    "<article>{}</article>", "<article class='post'>{}</article>", "<main>{}</main>", "<main id='main'><article>{}</article></main>",
    "<div class='content'>{}</div>", "<div id='content'>{}</div>", "<div class='article-body'>{}</div>", "<div class='entry-content'>{}</div>",
    "<div class='post-content'><section>{}</section></div>", "<div class='story'>{}</div>", "<section class='text'>{}</section>",
    "<div role='main'>{}</div>", "<div>{}</div>", "<table><tr><td>{}</td></tr></table>", "<div class='page'><div class='body'>{}</div></div>", "{}",
)
MENUS = (
    "<nav><ul>{li}</ul></nav>", "<div class='menu'><ul>{li}</ul></div>", "<ul class='navbar'>{li}</ul>", "<div id='nav'>{a}</div>",
    "<div class='breadcrumbs'>{a}</div>", "<div class='topbar'>{a}</div>", "<nav class='pagination'>{a}</nav>", "<div class='tags'>{a}</div>",
    "<div class='navigation' role='navigation'><p>{a}</p></div>", "<menu>{li}</menu>", "<div class='toc'><ol>{li}</ol></div>",
)
HEADERS = (
    "<header><div class='logo'>{s}</div><p>{s}</p></header>", "<div class='header'><h1>{s}</h1><span>{s}</span></div>", "<header>{s}</header>",
    "<div id='masthead'><p>{s}</p></div>", "<div class='site-header' role='banner'><h2>{s}</h2></div>",
)
FOOTERS = (
    "<footer>&copy; {s}</footer>", "<footer><p>{s}</p><p>{a}</p></footer>", "<div class='footer'><p>{s} {t}</p></div>", "<div id='footer'>{a} {s}</div>",
    "<div class='copyright'>&copy; {s}</div>", "<div class='site-info' role='contentinfo'>{t}</div>", "<footer><div><p>{t}</p></div></footer>",
)
SIDEBARS = (
    "<aside>{t}</aside>", "<aside class='sidebar'><h3>{s}</h3><p>{t}</p><ul>{li}</ul></aside>", "<div class='sidebar'><h4>{s}</h4><ul>{li}</ul></div>",
    "<div class='widget'><h3>{s}</h3><p>{t}</p></div>", "<div id='sidebar'><p>{t}</p></div>", "<div class='related'><h3>{s}</h3><ul>{li}</ul></div>",
    "<section class='related-posts'><p>{a}</p><p>{t}</p></section>", "<div class='author-bio'><p>{t}</p></div>", "<div class='recommended'><p>{t}</p></div>",
    "<div class='trending popular'><p>{t}</p></div>", "<div role='complementary'><p>{t}</p></div>", "<div class='side-column'><p>{t}</p></div>",
)
NOTICES = (
    "<div class='cookie-notice'><p>{t}</p><button>{w}</button></div>", "<div class='notice'>{t}</div>", "<div id='cookie-banner'>{t}</div>",
    "<div class='consent gdpr'><p>{t}</p></div>", "<div role='alert'><p>{t}</p></div>", "<div class='alert warning'>{t}</div>", "<dialog><p>{t}</p></dialog>",
    "<div class='popup modal overlay'><p>{t}</p></div>", "<noscript><p>{t}</p></noscript>", "<div class='message info'>{t}</div>",
    "<div class='paywall'><p>{t}</p></div>", "<div class='disclaimer'><p>{t}</p></div>", "<div class='privacy-policy'><p>{t}</p></div>",
    "<p class='notice'>{t}</p>", "<div class='announcement'>{t}</div>",
)
ADVERTS = (
    "<div class='ad'>{t}</div>", "<div class='ads'><p>{t}</p></div>", "<div class='advert'>{t}</div>", "<div class='advertisement'><p>{t}</p></div>",
    "<div id='ad-top'><a href='#'>{t}</a></div>", "<div class='banner'>{s}</div>", "<div class='sponsored'><p>{t}</p></div>", "<div class='promo'>{t}</div>",
    "<aside class='ad-slot'><p>{t}</p></aside>", "<section class='sponsor'><p>{t}</p></section>", "<p class='ad'>{t}</p>", "<ins class='adsense'>{t}</ins>",
    "<div class='promotion'><p>{t}</p></div>", "<div class='commercial'>{t}</div>", "<figure class='ad'><figcaption>{t}</figcaption></figure>",
)
FORMS = (
    "<form><label>{s}</label><input><button>{w}</button></form>", "<form class='search'><input><button>{w}</button></form>",
    "<div class='newsletter'><p>{t}</p><form><label>{w}</label></form></div>", "<form><p>{t}</p><select><option>{w}</option><option>{w}</option></select></form>",
    "<form><fieldset><legend>{s}</legend><p>{t}</p></fieldset></form>", "<div class='subscribe signup'><p>{t}</p></div>", "<div class='login'><p>{s}</p></div>",
    "<div class='share social'><button>{w}</button><button>{w}</button></div>", "<div class='share-buttons'>{a}</div>",
)
COMMENTS = (
    "<div class='comments'><h3>{s}</h3><p>{t}</p><p>{t}</p></div>", "<section id='comments'><ol><li><p>{t}</p></li><li><p>{t}</p></li></ol></section>",
    "<ul class='comment-list'><li>{t}</li><li>{t}</li></ul>", "<div class='comment'><b>{w}</b><p>{t}</p></div><div class='comment'><p>{t}</p></div>",
    "<section class='comments'><article class='comment'><p>{t}</p></article><article class='comment'><p>{t}</p></article></section>",
    "<div id='disqus_thread'><p>{t}</p></div>", "<div class='reply'><p>{t}</p></div>", "<div class='discussion'><p>{t}</p><p>{t}</p></div>",
    "<section class='responses'><p>{t}</p></section>", "<div class='reader-comments'><blockquote>{t}</blockquote><p>{t}</p></div>",
    "<div class='reviews feedback'><p>{t}</p></div>", "<ol class='thread'><li><p>{t}</p></li></ol>",
)
BODY = (
    ("<p>{t}</p>", 12), ("<p>{t}{t}{t}</p>", 6), ("<p>{s}</p>", 4), ("<p><b>{t}<br>", 2), ("<h2>{s}</h2>", 2), ("<h3>{s}</h3>", 1), ("<p>{w}.</p>", 1),
    ("<ul><li>{s}</li><li>{s}</li></ul>", 1), ("<ol><li>{t}</li><li>{s}</li></ol>", 1), ("<blockquote><p>{t}</p></blockquote>", 1), ("<pre>{t}</pre>", 1),
    ("<table><tr><th>{w}</th><td>{s}</td></tr></table>", 1), ("<figure><img><figcaption>{s}</figcaption></figure>", 1), ("<div>{t}</div>", 2),
    ("<section><h2>{s}</h2><p>{t}</p></section>", 1), ("<p>{t} <a href='#'>{w}</a> {t}</p>", 2), ("<div class='paragraph'>{t}</div>", 1),
    ("<dl><dt>{w}</dt><dd>{s}</dd></dl>", 1), ("<p class='lead'>{t}</p>", 1), ("<header><h1>{s}</h1></header>", 1), ("{t}", 1), ("<p><i>{t}</i></p>", 1),
)


class Writer:
    """Fills layouts with words; article words carry the mark."""

    def __init__(self, rng: random.Random):
        self.rng = rng

    def words(self, low: int, high: int) -> str:
        rng, out = self.rng, []
        for i in range(rng.randint(low, high)):
            word = "".join(rng.choice(("an", "the", "or", "ti", "es", "la", "ung", "ou", "st", "re")) for _ in range(rng.randint(1, 4)))
            out.append(word.capitalize() if i == 0 else word + rng.choice(("", "", "", "", "", ",", ".")))
        return " ".join(out)

    def fill(self, layout: str, label: int) -> str:
        rng, out = self.rng, layout
        link = lambda: f"<a href='/{rng.randint(1, 99)}'>{self.words(1, 3)}</a>"
        for name, make in (
            ("li", lambda: "".join(f"<li>{link()}</li>" for _ in range(rng.randint(3, 8)))),
            ("a", lambda: " ".join(link() for _ in range(rng.randint(1, 6)))),
            ("w", lambda: self.words(1, 1)),
            ("s", lambda: self.words(2, 12)),
            ("t", lambda: self.words(5, 60) + "."),
        ):
            while f"{{{name}}}" in out:
                out = out.replace(f"{{{name}}}", (MARK if label else "") + make(), 1)
        return out

    def page(self) -> str:
        rng = self.rng
        pick = lambda some, chance: self.fill(rng.choice(some), 0) if rng.random() < chance else ""
        layouts, weights = zip(*BODY, strict=True)
        body = self.fill("<h1>{s}</h1>", 1) if rng.random() < 0.8 else ""
        for layout in rng.choices(layouts, weights, k=rng.randint(1, 14)):
            body += self.fill(layout, 1)
            body += pick(rng.choice((ADVERTS, SIDEBARS, FORMS, NOTICES)), 0.08)
        inside = pick(COMMENTS, 0.12) + pick(FORMS, 0.08)
        article = rng.choice(CONTAINERS).format(body + inside)
        before = [pick(MENUS, 0.8), pick(HEADERS, 0.5), pick(ADVERTS, 0.4), pick(NOTICES, 0.3), pick(FORMS, 0.2)]
        after = [pick(SIDEBARS, 0.5), pick(COMMENTS, 0.5), pick(ADVERTS, 0.3), pick(MENUS, 0.2), pick(NOTICES, 0.2), pick(FORMS, 0.3)]
        rng.shuffle(before)
        rng.shuffle(after)
        title = self.words(2, 9)
        inner = "".join(before) + article + "".join(after) + pick(FOOTERS, 0.85)
        if rng.random() < 0.3:
            inner = f"<div class='{rng.choice(('wrapper', 'container', 'page', 'site', 'layout', 'row'))}'>{inner}</div>"
        return f"<!DOCTYPE html><html><head><title>{title}</title></head><body>{inner}</body></html>"


def labelled(n: int, seed: int = 11) -> list[tuple[list[Block], list[int]]]:
    """``n`` pages as blocks and labels."""
    writer, out = Writer(random.Random(seed)), []
    for _ in range(n):
        found = blocks(writer.page())
        labels = [int(MARK in b.text) for b in found]
        for b in found:
            b.text = b.text.replace(MARK, "")
        out.append((found, labels))
    return out
