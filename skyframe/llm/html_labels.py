"""A small labelled table of page blocks, from which the text extractor's tree is learnt.

Every page is a list of lines ``+`` (main text) or ``-`` (anything else) and
markup, in which ``{a-b}`` stands for a to b invented words.  The pages are
invented; each is filled several times with other words and lengths.
"""

from __future__ import annotations

import random
import re

#: Begins the words of a line of main text.
MARK = "\ue000"

_MENU = '- <nav><ul><li><a href="/a">{1-2}</a></li><li><a href="/b">{1-3}</a></li><li><a href="/c">{1-2}</a></li></ul></nav>'
_FOOT = "- <footer>&copy; {2-12}</footer>"
_BODY = ["+ <p>{5-90}</p>", "+ <p>{2-8}</p>", "+ <p>{20-160}</p>", "+ <p>{4-40} <a href='#'>{1-4}</a> {4-60}</p>"]

PAGES = [
    # an article element between menus, adverts and a footer
    [_MENU, '- <div class="ad">{2-30}</div>', "+ <article><h1>{2-16}</h1>", *_BODY, "- </article>", _FOOT],
    [_MENU, '- <div class="cookie-notice">{4-60}</div>', "- <div>{3-40}</div>", "+ <article><h1>{2-16}</h1>", "+ <p><b>{4-60}<br>", *_BODY, "+ <ul><li>{2-30}</li>", "+ <li>{3-20}</li></ul>",
     "- </article><aside>{5-60}</aside>", "- <section class='comments'><h3>{1-3}</h3>", "- <p>{5-80}</p>", "- <p>{2-40}</p></section>", _FOOT],
    # boilerplate inside of the article
    ["- <header>{1-8}</header>", "+ <article><header><h1>{3-12}</h1></header>", "+ <p>{10-100}</p>", '- <div class="share-buttons"><a href="#">{1-2}</a> <a href="#">{1-2}</a></div>', "+ <h2>{1-8}</h2>",
     "+ <p>{4-90}</p>", "- <form>{2-12} <input></form>", '- <div class="advertisement">{4-40}</div>', "+ <blockquote>{5-60}</blockquote>", "+ <p><a href='#'>{3-9}</a></p>", "+ <p>{15-70}</p>",
     "- <nav><a href='#'>{1-4}</a></nav><footer>{3-20}</footer></article>", '- <div id="comments">{5-90}', "- <article class='comment'><p>{10-90}</p></article></div>", _FOOT],
    # no article element: a main element
    ["- <header><a href='/'>{1-3}</a></header>", _MENU, "+ <main><h1>{2-12}</h1>", *_BODY, '- <div class="related"><a href="#">{3-9}</a></div>', "- </main>", "- <div>{3-14}</div>", '- <div class="sidebar">{4-70}</div>', _FOOT],
    # neither: only lengths, links and names tell
    ["- <div><a href='/'>{1-2}</a> <a href='#'>{1-2}</a> <a href='#'>{1-3}</a></div>", "- <div><a href='#'>{1-3}</a></div>", "+ <h1>{3-12}</h1>", "+ <p>{25-140}</p>", "+ <p>{12-120}</p>", "+ <p>{6-60}</p>", "+ <p>{20-140}</p>",
     "- <div><a href='#'>{2-8}</a></div>", "- <div><a href='#'>{2-8}</a></div>", "- <div>{2-6}</div>"],
    ['- <div class="nav">{1-8}</div>', "+ <div class='post'><h2>{3-12}</h2>", "+ {20-140}<br><br>{10-60}", "+ <p>{20-100}</p>", "+ <p>{10-90}</p></div>", '- <div class="comment-list"><p>{5-90}</p>', "- <p>{10-90}</p></div>",
     '- <div class="notice">{10-60}</div>', "- <ul><li><a href='#'>{2-6}</a></li>", "- <li><a href='#'>{2-6}</a></li>", "- <li><a href='#'>{2-6}</a></li></ul>", '- <div id="footer">{3-20}</div>'],
    # a whole page inside of a form; layout tables
    ["- <form action='/'><div><a href='#'>{1-3}</a> <a href='#'>{1-3}</a></div>", "+ <h1>{3-12}</h1>", "+ <p>{25-140}</p>", "+ <p>{20-120}</p>", "+ <p>{20-90}</p>", "- <div>{1-4}</div></form>"],
    ["- <table><tr><td><a href='#'>{1-3}</a></td><td><a href='#'>{1-3}</a></td></tr>", "+ <tr><td><p>{25-140}</p>", "+ <p>{20-140}</p>", "+ <p>{20-90}</p></td>", "- <td><a href='#'>{2-6}</a></td></tr></table>"],
    # little or nothing around the text
    ["+ <article><h1>{2-12}</h1>", "+ <p>{2-90}</p></article>"],
    ["+ <article><p>{2-30}</p>", "+ <p><a href='#'>{2-9}</a> {1-5}</p>", "+ <p>{2-120}</p>"],
    ["- <div class='promo'>{3-40}</div>", "+ <article><p>{1-40}"],
    ["+ <main><p>{2-60}</p>", "+ <p>{3-90}"],
    ["+ <h1>{2-12}</h1>", "+ <p>{8-90}</p>", "+ <p>{12-140}</p>"],
    ["+ <p>{12-200}</p>"],
    # pages without any main text
    [_MENU, '- <div class="ad">{3-30}</div>', "- <div><a href='#'>{2-8}</a></div>", "- <div><a href='#'>{2-8}</a></div>", _FOOT],
    ["- <div class='banner'>{3-50}</div>", "- <form>{1-5} <input> {1-6}</form>", _FOOT],
]


def labelled_pages(times: int = 40, seed: int = 11) -> list[str]:
    """Every page filled ``times`` times; the words of main text begin with ``MARK``."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghijklmnoprstuvw") for _ in range(r.randint(1, 9)))
    out = []
    for page in PAGES * times:
        html = ["<!DOCTYPE html><html><head><title>", word(), "</title></head><body>"]
        for line in page:
            fill = lambda m: (MARK if line[0] == "+" else "") + " ".join(word() for _ in range(r.randint(int(m[1]), int(m[2]))))  # noqa: E731, B023
            html.append(re.sub(r"\{(\d+)-(\d+)\}", fill, line[2:]))
        out.append("".join(html))
    return out
