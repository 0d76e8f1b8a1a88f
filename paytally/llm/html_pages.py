"""Labelled pages to train the extraction model on, made from layouts of our own.

``data-main`` says of an element, and of all in it that has no other, whether it is part
of the article (1) or not (0).
"""

from __future__ import annotations

import random

_WORDS = (
    "river stone market morning window letter garden winter engine harbour paper signal "
    "valley bridge silver corner number season island forest answer record pattern weight"
).split()
_MENU = "Home News Sport Culture Contact About Login Search Archive Help Shop Events".split()


def _sentence(rng: random.Random, least: int = 4, most: int = 18) -> str:
    words = [rng.choice(_WORDS) for _ in range(rng.randint(least, most))]
    return " ".join(words).capitalize() + rng.choice([".", ".", ".", "?", "!", ""])


def _text(rng: random.Random) -> str:
    return " ".join(_sentence(rng) for _ in range(rng.choice([1, 1, 2, 4, 7, 12])))


def _links(rng: random.Random) -> str:
    chosen = rng.sample(_MENU, rng.randint(3, 8))
    return "".join(f'<li><a href="/{w}">{w}</a></li>' for w in chosen)


def _paragraph(rng: random.Random) -> str:
    text = _text(rng)
    if rng.random() < 0.2:
        text = f"<b>{text}</b>"
    if rng.random() < 0.25:
        text += f' <a href="/x">{_sentence(rng, 1, 4)}</a> {_sentence(rng)}'
    if rng.random() < 0.1:
        text = text.replace(" ", "<br>", 1)
    return f"<p>{text}" + ("</p>" if rng.random() < 0.9 else "")


def _inside(rng: random.Random) -> str:
    """What an article holds: paragraphs, and now and then other blocks or adverts."""
    parts = [f"<h1>{_sentence(rng, 3, 9)}</h1>"] if rng.random() < 0.8 else []
    for _ in range(rng.randint(1, 9)):
        kind = rng.random()
        if kind < 0.7:
            parts.append(_paragraph(rng))
        elif kind < 0.76:
            parts.append(f"<h2>{_sentence(rng, 2, 6)}</h2>")
        elif kind < 0.82:
            parts.append("<ul>" + "".join(f"<li>{_sentence(rng)}</li>" for _ in range(3)) + "</ul>")
        elif kind < 0.86:
            parts.append(f"<blockquote><p>{_text(rng)}</p></blockquote>")
        elif kind < 0.9:
            cells = "".join(f"<tr><td>{_sentence(rng, 1, 4)}</td></tr>" for _ in range(3))
            parts.append(f"<table>{cells}</table>")
        elif kind < 0.93:
            parts.append(f"<figure><figcaption>{_sentence(rng)}</figcaption></figure>")
        elif kind < 0.96:
            parts.append(f"<pre>{_sentence(rng)}</pre>")
        else:
            parts.append(_aside(rng, rng.choice(["ad", "advert", "related", "share", "newsletter"])))
    return "".join(parts)


def _aside(rng: random.Random, kind: str) -> str:
    tag = rng.choice(["div", "div", "aside", "section"])
    mark = rng.choice(["class", "id"])
    inner = rng.choice(
        [_sentence(rng), f"<p>{_text(rng)}</p>", f"<ul>{_links(rng)}</ul>", _sentence(rng, 1, 3)]
    )
    return f'<{tag} {mark}="{kind}" data-main="0">{inner}</{tag}>'


def _comments(rng: random.Random) -> str:
    items = "".join(
        f"<li><p>{_sentence(rng, 1, 2)}</p><p>{_text(rng)}</p></li>" for _ in range(rng.randint(1, 4))
    )
    name = rng.choice(["comments", "comment-list", "reader-comments", "responses", "discussion"])
    tag = rng.choice(["div", "section"])
    return f'<{tag} class="{name}" data-main="0"><h3>{_sentence(rng, 1, 3)}</h3><ul>{items}</ul></{tag}>'


def _form(rng: random.Random) -> str:
    fields = f"<p>{_sentence(rng, 1, 5)}</p><input name=q>"
    return f'<form action="/" data-main="0">{fields}<button>Send</button></form>'


def _bare_page(rng: random.Random) -> str:
    """Text without any layout, be it short: all of it is the article."""
    short = rng.random() < 0.5
    lines = [_sentence(rng) if short else _text(rng) for _ in range(rng.randint(1, 6))]
    kind = rng.random()
    if kind < 0.3:
        return f'<html data-main="1">{lines[0]}' + "".join(f"<p>{x}" for x in lines[1:]) + "</html>"
    head = f"<h1>{_sentence(rng, 1, 5)}</h1>" if rng.random() < 0.5 else ""
    body = head + "".join(f"<p>{x}</p>" for x in lines)
    return f'<html data-main="1"><body>{body}</body></html>'


def labelled_page(rng: random.Random) -> str:
    if rng.random() < 0.06:
        return _bare_page(rng)
    open_article = rng.choice(
        [
            "<article{}>",
            "<main{}>",
            '<div class="content"{}>',
            '<div id="article-body"{}>',
            '<section class="post entry"{}>',
            '<div class="story text"{}>',
            "<div{}>",
        ]
    )
    tag = open_article[1:].split("{")[0].split(" ")[0]
    body = open_article.format(' data-main="1"') + _inside(rng)
    if rng.random() < 0.3:
        body += _comments(rng)
    body += f"</{tag}>"
    if rng.random() < 0.3:
        body = f'<div class="wrapper" data-main="0">{body}</div>'
    before, after = [], []
    if rng.random() < 0.9:
        before.append(f'<nav data-main="0"><ul>{_links(rng)}</ul></nav>')
    if rng.random() < 0.4:
        before.insert(0, f'<header data-main="0"><h2>{_sentence(rng, 1, 3)}</h2></header>')
    if rng.random() < 0.3:
        before.append(f'<div class="menu" data-main="0"><ul>{_links(rng)}</ul></div>')
    for kind in ("ad", "banner", "cookie-notice", "sidebar", "promo", "breadcrumb", "popup"):
        if rng.random() < 0.25:
            rng.choice([before, after]).append(_aside(rng, kind))
    if rng.random() < 0.3:
        rng.choice([before, after]).append(_form(rng))
    if rng.random() < 0.3:
        after.append(_comments(rng))
    if rng.random() < 0.9:
        inner = rng.choice([_sentence(rng), f"<p>{_text(rng)}</p>", f"<ul>{_links(rng)}</ul>"])
        foot = rng.choice(["<footer{}>{}</footer>", '<div class="footer"{}>{}</div>'])
        after.append(foot.format(' data-main="0"', f"&copy; {inner}"))
    return f'<html data-main="0"><body>{"".join(before)}{body}{"".join(after)}</body></html>'


def labelled_pages(count: int = 600, seed: int = 7) -> list[str]:
    rng = random.Random(seed)
    return [labelled_page(rng) for _ in range(count)]
