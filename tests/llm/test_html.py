"""Odd markup and named parts of web pages, and generated pages whose article is known."""

from __future__ import annotations

import random
import time

import pytest

from aulastar.llm.html_extract import main_text, parse

WORDS = "alder birch cedar dogwood elm fir ginkgo hazel ivy juniper larch maple oak pine rowan spruce willow yew".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


LONG = 100_000
STRAY = {
    "letters after a stray <": "<p>if a <b " + "n" * LONG + " <i>", "an open quote": '<p>x <b "' + "n" * LONG + " <i>", "an open value": '<p>x <b a="' + "n" * LONG + " <i>",
    "an open comment": "<p>x <!-- " + "n" * LONG, "an open section": "<p>x <![CDATA[" + "n" * LONG, "many stray": "<p>x " + "<b " * (LONG // 3), "many values": "<p>x " + '<a ="<a "' * (LONG // 9),
    "many quotes": "<p>x <b " + "\"'" * (LONG // 2) + " <i>", "many equals": "<p>x <b " + "= " * (LONG // 2) + " <i>", "many names": "<p>x <b " + "a " * (LONG // 2) + ">", "open scripts": "<p>x" + "<script" * (LONG // 7),
    "end tags of nothing": "<div>" * (LONG // 10) + "</p>" * (LONG // 10), "end tags blocked": "<a><div>" + "<b>" * (LONG // 10) + "</a>" * (LONG // 10), "cells without a table": "<div>" * (LONG // 10) + "<td>" * (LONG // 10),
    "rules in deep spans": "<span>" * (LONG // 10) + "<hr>" * (LONG // 10), "deep parts": "<div class=widget>" * (LONG // 20) + "x",
}


@pytest.mark.parametrize("name", STRAY)
def test_odd_markup_takes_linear_time(name):
    main_text(STRAY[name][:1000])
    t = time.process_time()
    main_text(STRAY[name])
    assert time.process_time() - t < 1.5


def test_a_stray_bracket_is_text():
    assert main_text("<p>if a <b nnn <i>then</i> x") == "if a <b nnn then x"
    assert main_text("<p>1 < 2 and a<b") == "1 < 2 and a"            # the page ends inside a tag
    assert main_text("<p title='a < b > c' data-x=\"<i>no</i>\">yes</p>") == "yes"
    assert main_text("<p>it's <a href=x>o'clock</a> now") == "it's o'clock now"
    assert len(parse("<p>a<p>b<p>c").children) == 3


P = [prose(random.Random(i), 45) for i in range(12)]


def test_named_parts_of_an_article_stay():
    widget = '<div class="elementor-element elementor-widget elementor-widget-text-editor"><div class="elementor-widget-container"><p>{}</p></div></div>'
    nav = "<nav><a href=/>Home</a></nav><footer>(c)</footer>"
    want = "\n\n".join(P[:3])
    assert main_text("<body>" + nav + "".join(widget.format(p) for p in P[:3])) == want
    assert main_text("<body>" + nav + "<article>" + "".join(widget.format(p) for p in P[:3]) + "</article>") == want
    assert main_text("<body>" + nav + "".join(f"<div class=widget><p>{p}</p></div>" for p in P[:3])) == want
    assert main_text(f"<body>{nav}<article><p>{P[0]}</p><p class=share-price>{P[1]}</p><blockquote class=notice>{P[2]}</blockquote></article>") == want
    assert main_text(f"<body>{nav}<div class=post><p>{P[0]}</p><p class=share-price>{P[1]}</p><blockquote class=notice>{P[2]}</blockquote></div>") == want


def test_named_parts_beside_an_article_go():
    body = "".join(f"<p>{p}</p>" for p in P[:6])
    side = "".join(f'<div class="widget widget_recent"><h3>Latest {k}</h3><ul>' + "".join(f"<li><a href={i}>A headline of another page {i}</a>" for i in range(6)) + "</ul></div>" for k in range(3))
    about = "<div class=widget><h3>About</h3><p>A small paper about trees.</p></div>"
    for wrap in ("<article>{}</article>", "<div class=post>{}</div>"):
        page = f"<body><div class=topbar><a href=1>a</a> b</div><div class=cookie-consent><p>{prose(random.Random(3), 30)}</p><button>ok</button></div>{wrap.format(body)}<div id=sidebar>{side}{about}</div>"
        assert main_text(page) == "\n\n".join(P[:6]), wrap
    inner = f"<article>{body}<div class=ad>Buy trees now at half the price.</div><div class=newsletter-signup><a href=x>Subscribe to our letter</a></div><p>{P[7]}</p></article>"
    assert main_text(inner) == "\n\n".join([*P[:6], P[7]])


@pytest.mark.parametrize("seed", range(40))
def test_generated_pages(seed):
    """The article of a page is put together from known blocks; everything around it is noise of known kinds."""
    rng = random.Random(seed)
    blocks, parts = [], []
    for _ in range(rng.randint(4, 12)):
        text = prose(rng, rng.randint(12, 60))
        kind = rng.choice(["p", "p", "p", "inline", "list", "entity", "quote"])
        if kind == "inline":
            words = text.split(" ")
            words[3] = f"<b>{words[3]}</b>"
            words[5] = f"<a href='/x'>{words[5]}</a>"
            parts.append(f"<p>{' '.join(words)}")
            blocks.append(text)
        elif kind == "list":
            items = [prose(rng, 9) for _ in range(3)]
            parts.append("<ul>" + "".join(f"<li>{i}" for i in items) + "</ul>")
            blocks += items
        elif kind == "entity":
            parts.append(f"<p>{text} &amp; &#233;  \n more<br>of it</p>")
            blocks.append(f"{text} & é more of it")
        elif kind == "quote":
            parts.append(f"<blockquote class=notice>{text}</blockquote>")
            blocks.append(text)
        else:
            parts.append(f"<p>{text}</p>")
            blocks.append(text)
    noise = ["<nav><ul>" + "".join(f"<li><a href={i}>{prose(rng, 2)}</a>" for i in range(8)) + "</ul></nav>", f"<div class=ad>{prose(rng, 8)}</div>", f"<aside>{prose(rng, 20)}</aside>",
             f"<div class=cookie-notice>{prose(rng, 10)}</div>", f"<script>var x = '{prose(rng, 30)}'</script>", "<form><label>Mail</label><input></form>", f"<section id=comments><p>{prose(rng, 60)}</p></section>"]
    rng.shuffle(noise)
    cut = rng.randint(0, len(noise))
    tag = rng.choice(["article", "main", "div class=post"])
    page = f"<!DOCTYPE html><html><head><title>t</title></head><body><header>Site</header>{''.join(noise[:cut])}<{tag}>{''.join(parts)}</{tag.split()[0]}>{''.join(noise[cut:])}<footer>(c)</footer></body></html>"
    assert main_text(page) == "\n\n".join(blocks)
