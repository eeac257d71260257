"""Labelled pages for the page model: written from random words in many layouts, each block marked main or not."""

from __future__ import annotations

import random

MAIN_HOLDERS = ["article", "main", "div class=content", "div class=article", "div id=story", "div class=post", "div class='entry body'", "section class=text",
                "div id=main", "article class=post", "div class='page content'", "td class=content", "div"]
#: Kinds of blocks that aren't the article's: holders and how their text looks.
OTHER = {
    "menu": ["nav", "div class=menu", "ul class=navigation", "div id=nav", "div class='top bar'", "nav class=breadcrumb", "menu", "div role=navigation"],
    "header": ["header", "div id=header", "div class=masthead", "div class='site header'", "div role=banner"],
    "footer": ["footer", "div id=footer", "div class=footer", "div class=copyright", "div class=legal"],
    "side": ["aside", "div class=sidebar", "div id=side", "div class=widget", "div class=related", "section class=recommended", "div class='more links'"],
    "notice": ["div class=cookie", "div class='cookie notice'", "div id=consent", "div class=alert", "div class=notice", "dialog", "div class=popup", "div class=message"],
    "advert": ["div class=ad", "div class=ads", "div class=advert", "div id=sponsor", "div class=promo", "section class=banner", "div class='sponsored advertisement'", "aside class=ad"],
    "form": ["form", "div class=newsletter", "div class=login", "div class=search", "form class=subscribe", "fieldset"],
    "comments": ["section class=comments", "div id=comments", "ol class='comment list'", "div class=comment", "div class=discussion", "div class=replies", "section id=respond", "div class=reviews"],
    "social": ["div class=share", "div class=social", "ul class=tags", "div class=author", "div class=meta", "div class=byline"],
}


def _word(rng) -> str:
    return "".join(rng.choice("bcdfglmnprstv") + rng.choice("aeiou") for _ in range(rng.randrange(1, 5)))


def _sentence(rng, low=4, high=25) -> str:
    words = [_word(rng) for _ in range(rng.randrange(low, high))]
    return " ".join(w + ("," if rng.random() < 0.08 else "") for w in words).capitalize() + rng.choice([".", ".", ".", "!", "?"])


def _prose(rng, sentences=None) -> str:
    return " ".join(_sentence(rng) for _ in range(sentences or rng.choice([1, 1, 2, 3, 4, 6, 9])))


def _odd(rng) -> str:
    """Main text as it is on bad pages: fragments, lists in one line, symbols, no full stop."""
    words = [_word(rng) for _ in range(rng.choice([1, 2, 5, 12, 40]))]
    return rng.choice([" | ", " ", " ", ", ", " *** ", " &amp; "]).join(words) + rng.choice(["", "", ".", " |", " **", "&lt;"])


def _links(rng) -> str:
    n = rng.randrange(2, 9)
    items = [f'<a href="/{_word(rng)}">{" ".join(_word(rng) for _ in range(rng.randrange(1, 4)))}</a>' for _ in range(n)]
    if rng.random() < 0.7:
        return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
    return rng.choice([" | ", " ", " » "]).join(items)


def _held(holder: str, inner: str) -> str:
    return f"<{holder}>{inner}</{holder.split()[0]}>"


def _other(rng, kind: str) -> str:
    holder = rng.choice(OTHER[kind])
    if kind == "menu":
        inner = _links(rng)
    elif kind == "header":
        inner = rng.choice([f"<h1>{_word(rng)}</h1>", f"<div>{_word(rng)} {_word(rng)}</div>", f"<p>{_sentence(rng, 3, 8)}</p>"]) + (_links(rng) if rng.random() < 0.5 else "")
    elif kind == "footer":
        inner = rng.choice([f"&copy; {_word(rng)} &middot; {_sentence(rng)}", f"<p>© {_word(rng)} {_sentence(rng, 2, 9)}</p>", _links(rng) + f"<p>{_prose(rng, 1)}</p>", _prose(rng, 2)])
    elif kind == "side":
        inner = f"<h3>{_word(rng).title()}</h3>" + rng.choice([_links(rng), f"<p>{_prose(rng)}</p>", f"<div>{_prose(rng, 1)}</div>" * 2])
    elif kind in ("notice", "advert"):
        inner = rng.choice([_prose(rng, rng.randrange(1, 5)), f"<p>{_prose(rng)}</p>", f"<div>{_sentence(rng, 2, 8)}</div><button>{_word(rng)}</button>", f'<a href="#">{_sentence(rng, 2, 9)}</a>'])
    elif kind == "form":
        inner = f"<label>{_word(rng)}</label><input name=q>" + rng.choice(["", f"<p>{_sentence(rng)}</p>", f"<select><option>{_word(rng)}<option>{_word(rng)}</select>"]) + f"<button>{_word(rng)}</button>"
    elif kind == "comments":
        each = lambda: rng.choice([f"<li><b>{_word(rng)}</b><p>{_prose(rng)}</p></li>", f"<div class=comment><p>{_prose(rng)}</p></div>", f"<p>{_prose(rng)}</p>", f"<article class=comment><p>{_prose(rng)}</p></article>"])
        inner = f"<h3>{_word(rng)}</h3>" + "".join(each() for _ in range(rng.randrange(1, 6)))
    else:
        inner = rng.choice([_links(rng), f"<span>{_word(rng)}</span> <span>{_word(rng)}</span>", f"<p>{_sentence(rng, 2, 6)}</p>"])
    return _held(holder, inner)


def page(rng: random.Random) -> tuple[str, list[bool]]:
    """A page, and whether each of its blocks is part of the article."""
    from tripgauge.llm.htmlblocks import blocks

    title = _sentence(rng, 2, 9)
    # Main text carries a mark that never occurs elsewhere; it is taken out after the blocks have been labelled.
    mark = "⁣"
    body = [f"<h1>{mark}{title}</h1>"] if rng.random() < 0.85 else []
    odd = rng.choice([0, 0, 0.1, 0.9])
    for _ in range(rng.choice([1, 2, 3, 4, 6, 8, 12, 16])):
        kind = rng.random()
        if kind < 0.72:
            text = _prose(rng) if rng.random() > odd else _odd(rng)
            if rng.random() < 0.15:
                text += f' <a href="/x">{_word(rng)} {_word(rng)}</a>.'
            style = rng.random()
            body.append(f"<p>{mark}{text}</p>" if style < 0.7 else f"<p>{mark}<b>{text}<br>" if style < 0.85 else f"<div>{mark}{text}</div>")
        elif kind < 0.8:
            body.append(f"<h2>{mark}{_sentence(rng, 2, 7)[:-1]}</h2>")
        elif kind < 0.86:
            body.append("<ul>" + "".join(f"<li>{mark}{_sentence(rng, 2, 12)}</li>" for _ in range(rng.randrange(2, 6))) + "</ul>")
        elif kind < 0.9:
            body.append(f"<blockquote>{mark}{_prose(rng)}</blockquote>")
        elif kind < 0.93:
            body.append("<table>" + "".join(f"<tr><td>{mark}{_word(rng)}<td>{mark}{_word(rng)}</tr>" for _ in range(3)) + "</table>")
        elif kind < 0.95:
            body.append(f"<pre>{mark}{_sentence(rng)}</pre><figure><figcaption>{mark}{_sentence(rng, 3, 10)}</figcaption></figure>")
        else:
            body.append(_other(rng, rng.choice(["advert", "social", "notice", "side", "form"])))
    main = _held(rng.choice(MAIN_HOLDERS), "".join(body))
    if rng.random() < 0.3:
        main = _held(rng.choice(["main", "div id=page", "div class=container", "div class=wrapper", "section"]), main + (_other(rng, "comments") if rng.random() < 0.4 else ""))
    before = [_other(rng, k) for k in ("notice", "header", "menu", "advert") if rng.random() < 0.55]
    after = [_other(rng, k) for k in ("social", "comments", "side", "form", "advert", "footer") if rng.random() < 0.5]
    rng.shuffle(before)
    if rng.random() < 0.3:
        before.append(_other(rng, "side"))
    head = f"<head><title>{title}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head>"
    html = f"<!DOCTYPE html><html>{head}<body>{''.join(before)}{main}{''.join(after)}" + rng.choice(["</body></html>", "</body></html>", ""])
    labels = [mark in b.text for b in blocks(html)]
    return html.replace(mark, ""), labels


def pages(count: int, seed: int) -> list[tuple[str, list[bool]]]:
    rng = random.Random(seed)
    return [page(rng) for _ in range(count)]
