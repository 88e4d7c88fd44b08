import html
import re

import pytest

from tidemark.llm import html_text as H
from tidemark.llm import licenses as L
from tidemark.llm.queries import op10_html_text

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body class="home page">
<header><h1>Site</h1></header><nav><ul><li>Home<li>News</ul></nav><div class="cookie-notice">We use cookies</div>
<form><label>Search</label><input name=q><button>Go</button></form><aside>See also</aside>
<article class="post"><header><h1>Head &amp; title</h1></header><p>One <b>bold</b>
word.<br>Two<p>Three &lt;3 &eacute;&#233;<div class='ad-slot'>Buy</div><script>var a = "</p>";</script><p>Four</p>
<section id="comments"><p>Nice!</p></section></article><!-- gone <p>no</p> --><footer>Imprint</footer></body></html>"""


def test_article_without_anything_else():
    assert H.main_text(PAGE) == "Head & title One bold word. Two Three <3 éé Four"


def test_pages_without_an_article_element_surge_and_dive():
    body = "".join(f"<p>{'long text of the story ' * 9}{i}</p>" for i in range(5))
    page = f"<body><div><a href=x>Menu</a></div><div>Home</div><ul class=nav><li>x</ul>{body}<ul class=menu><li>y</ul><p>Bye</p></body>"
    assert H.main_text(page) == " ".join(f"{'long text of the story ' * 9}{i}" for i in range(5))


def test_unmarked_pages_with_menus_before_and_after():
    """Link lists that no class names, a byline and a caption around three paragraphs, by hand."""
    body = "".join(f"<p>{'long text of the story ' * 9}{i} with <a href=x>one link</a> in it.</p>" for i in range(3))
    links = "".join(f"<div><a href='/c{i}'>Category number {i} of all</a></div>" for i in range(12))
    listed = "<ul class='links'>" + "".join(f"<li><a href=x>Another page {i}</a>" for i in range(3)) + "</ul>"
    expected = " ".join(f"{'long text of the story ' * 9}{i} with one link in it." for i in range(3))
    for before, after in ((links, links), (listed, listed), (links + listed, "<p>Posted by X</p>" + links), ("", links), (listed, "")):
        assert H.main_text(f"<body>{before}{body}{after}</body>") == expected
    short = "<p>Ja.</p><p>Nein.</p><p>Doch.</p><p>Gut.</p>"  # short lines between long ones stay
    assert H.main_text(f"<body>{links}{body}{short}{body}{links}") == f"{expected} Ja. Nein. Doch. Gut. {expected}"
    assert H.main_text(f"<body>{links}") == " ".join(f"Category number {i} of all" for i in range(12))
    text = f"{'never closed link ' * 20}", "and more of it, in a line that isn't that short"
    assert H.main_text(f"<body><a href=x><p>{text[0]}<p>{text[1]}") == "".join(text)


def test_main_text_matches_a_window_model():
    """Random unmarked pages against surge and dive points found window by window."""
    import random
    r = random.Random(6)
    for _ in range(300):
        lines = [("t" * r.choice([3, 20, 40, 90, 200]), r.random() < 0.4) for _ in range(r.randrange(1, 25))]
        page = "".join(f"<p>{'<a href=x>' + t + '</a>' if link else t}</p>" for t, link in lines)
        weights = [0 if link else len(t) for t, link in lines]
        if not any(weights):
            weights = [len(t) for t, _ in lines]
        windows = [sum(weights[i:i + 3]) for i in range(len(weights))]
        surge, dive = min(86, max(1, max(windows) // 2)), min(30, max(1, max(windows) // 4))
        inside, kept = False, []
        for i, total in enumerate(windows):
            inside = total >= dive if inside else weights[i] > 0 and total >= surge
            kept.append(inside)
        expected = [t for i, (t, _) in enumerate(lines) if any(kept[:i + 1]) and any(kept[i:])]
        assert H.main_text(page) == " ".join(expected)


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("<p>", ""), ("just text", "just text"), ("<article>", ""), ("a < b", "a < b"),
    ("<article>x<script>never closed", "x"), ("<article><p title='a>b'>q</p>", "q"), ("<article>&am &amp &#x41;</article>", "&am & A"),
    ("<article><p>a</p><p class=share>s<p>b</article>", "a b"), ("<!-- open <article>x", "")])
def test_broken_and_empty_pages(page, text):
    assert H.main_text(page) == text


def test_very_long_page_and_adversarial_markup():
    long = "word " * 300_000
    assert H.main_text(f"<article><p>{long}</p></article>") == long.strip()
    H.main_text('<a "' * 20_000)
    H.main_text("<" * 50_000)
    H.main_text("<div>" * 20_000 + "x")


def test_every_page_of_the_table(spark, sf_dir):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = op10_html_text(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search("<article>(.*?)</article>", pages[r["page_id"]]["html"], re.S)[1]
        expected = " ".join(html.unescape(re.sub("</?b>", "", re.sub("</?(?:p|h1|br)>", " ", article))).split())
        assert (r["text"], r["n_chars"]) == (expected, len(expected))


def test_page_rows_with_nulls_and_clashing_names(spark):
    df = spark.createDataFrame([(None, None, None, "a"), (1, "u", PAGE, "b"), (1, "u", PAGE, "b")],
                               "page_id long, url string, html string, text string")
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in H.extract_pages(df).collect()) == [(0, 0), (1, 48), (1, 48)]
    assert H.extract_pages(df.limit(0)).collect() == []


TEMPLATES = L._templates(tuple(L.TEMPLATES))


def test_notices_of_every_template_are_found_exactly():
    for i, t in enumerate(TEMPLATES):
        for text in (t.text, f"Some words.\n{t.text}\nMore words here.", "x " * 500 + t.text.upper() + " y" * 500):
            found = L.notices(text, TEMPLATES)
            assert (t.license, True) in [(f[2], f[7]) for f in found], (t.text, text[:50], found)
            assert all(text[f[0]:f[1]].lower() in text.lower() for f in found)


def test_longer_wording_wins_and_differences_are_named():
    apache = TEMPLATES[4].text
    assert [(f[2], f[3]) for f in L.notices(apache, TEMPLATES)] == [("Apache-2.0", 4)]
    changed = TEMPLATES[2].text.replace("free of charge", "at no charge")
    (found,) = L.notices(changed, TEMPLATES)
    assert found[2] == "MIT" and not found[7] and found[6] == ["-free +at", "-of +no"]
    assert L.notices("The licence of my car and the rights of all drivers.", TEMPLATES) == []


def test_two_notices_and_cues_at_both_ends():
    text = "All rights reserved. " + "filler " * 30 + "Licensed under CC BY-NC 4.0."
    assert [f[2] for f in L.notices(text, TEMPLATES)] == ["LicenseRef-All-Rights-Reserved", "CC-BY-NC-4.0"]


def test_alignment_against_brute_force():
    import itertools

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    for a in itertools.product("xy", repeat=3):
        for b in itertools.product("xyz", repeat=4):
            first, last, differences = L.align(list(a), list(b))
            best = min(distance(a, b[i:j]) for i in range(5) for j in range(i, 5))
            assert len(differences) == best == distance(a, b[first:last])


def test_scan_of_a_table(make_docs, sf_dir, spark):
    rows = [(1, None), (2, ""), (3, "Released under the MIT License."), (3, "Released under the MIT License."), (None, "All rights reserved.")]
    got = sorted((r["doc_id"] or 0, r["license"], r["start"], r["end"]) for r in L.license_scan(make_docs(rows, extra=True)).collect())
    assert got == [(0, "LicenseRef-All-Rights-Reserved", 0, 19)] + [(3, "MIT", 0, 30)] * 2
    assert L.license_scan(make_docs([])).collect() == []
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected = sorted((d["doc_id"], m.start(), m.end() - 1) for d in docs.collect() for t in TEMPLATES
                      for m in re.finditer(re.escape(t.text), d["text"]))
    assert sorted((r["doc_id"], r["start"], r["end"]) for r in L.license_scan(docs).collect()) == expected


def letters(seed, n):
    import random
    r = random.Random(seed)
    return " ".join("".join(r.choice("etaoinshrdlu") for _ in range(r.randrange(2, 10))) for _ in range(n))


@pytest.mark.parametrize("number", [0, 2, 6, 14])
@pytest.mark.parametrize("copies", [2, 10, 60, 500])
def test_repeated_notices_are_all_found(number, copies):
    text = " ".join(f"{letters(i, 60)} {TEMPLATES[number].text}" for i in range(copies))
    found = [f[:2] for f in L.notices(text, TEMPLATES) if f[3] == number and f[7]]
    words = re.escape(TEMPLATES[number].text.rstrip(".:"))
    assert found == [m.span() for m in re.finditer(words, text)] and len(found) == copies


@pytest.mark.parametrize("number", range(15))
def test_a_notice_deep_in_cue_dense_text_is_found(number):
    words = letters(number, 8000).split()
    words[::60] = ["licence"] * len(words[::60])
    for at in (0, 3010, 8000):
        text = " ".join([*words[:at], TEMPLATES[number].text, *words[at:]])
        (found,) = [f for f in L.notices(text, TEMPLATES) if f[3] == number]
        assert found[7] and TEMPLATES[number].text.startswith(text[found[0]:found[1]])


LONG = "long text of the story " * 9


@pytest.mark.parametrize("page, text", [
    ("<body><div class='layout has-sidebar'><p>Top</p><article><p>a story</p></article><div class=sidebar>x</div></div>", "a story"),
    ("<div id='page' class='sticky-footer'><main><p>a story<div class=ad>Buy</div></main></div><footer>f</footer>", "a story"),
    ("<div class='has-sidebar'><div class=related><article>teaser</article></div><article>story</article></div>", "story"),
    ("<article>story</article><div class=related><article>teaser</article></div>", "story"),
    ("<div class=x-form><nav><article>no</article></nav></div>", ""),
    (f"<div class='sticky-footer'><p>{LONG}</p><div class=ad>Buy</div><p>{LONG}</p></div>", f"{LONG}{LONG}".strip()),
    (f"<p>{LONG}</p><div class=ad>Buy</div><p>Short but true.</p><div class=ad>Buy</div><p>{LONG}</p>", f"{LONG}Short but true. {LONG}".strip()),
])
def test_no_article_or_paragraph_within_it_is_dropped(page, text):
    assert H.main_text(page) == text


GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""
WORK = "This work is licensed under a Creative Commons Attribution 4.0 International License."
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:"""


@pytest.mark.parametrize("text, licence", [
    (GPL, "GPL-3.0-or-later"), (GPL.replace("version 3", "version 2"), "GPL-2.0-or-later"),
    (GPL.replace("version 3", "version 2.1").replace("General", "Lesser General"), "LGPL-2.1-or-later"),
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0-only"),
    ("This work is licensed under the GNU General Public License, version 3 or any later version.", "GPL-3.0-or-later"),
    (WORK, "CC-BY-4.0"), (WORK.replace("Attribution", "Attribution-NonCommercial"), "CC-BY-NC-4.0"),
    (WORK.replace("Attribution", "Attribution-ShareAlike"), "CC-BY-SA-4.0"),
    (BSD, "LicenseRef-BSD-family"), (GPL.replace("version 3", "version 7"), None)])
def test_licences_that_differ_in_a_word_are_told_apart(text, licence):
    found = [(f[2], f[7]) for f in L.notices(f"Words before. {text} Words after.", TEMPLATES)]
    assert found == ([(licence, True)] if licence else [])


def test_bsd_texts_by_their_clauses():
    for licence in ("BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause"):
        (text,) = [t.text for t in TEMPLATES if t.license == licence]
        assert [(f[2], f[7]) for f in L.notices(text, TEMPLATES)] == [(licence, True)]
