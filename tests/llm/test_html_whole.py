"""Pages of which an earlier parser lost everything."""

from __future__ import annotations

from txnspark.llm import html_mincut

PARA = "A paragraph of running text that says something, and ends as a sentence does."


def said(page):
    return [(b[0], b[3]) for b in html_mincut.blocks(page)]


def test_script_text_is_not_markup():
    loop = "for(i=0;i<n;i++){x=1}"
    for before, after in ((f"<script>{loop}</script>", ""), ("", f"<textarea>a <b 'c</TEXTAREA >"), (f"<svg><style>a<b{{'}}</style></svg>", "")):
        assert said(f"<body>{before}<article><p>{PARA}</p>{after}</article><script>{loop}</script>") == [(PARA, "content")]
    assert said(f"<head><script>if(a<body>'b)</script></head><body><article><p>{PARA}</article>") == [(PARA, "content")]


def test_a_head_need_not_be_closed():
    for start in ("<body><article>", "<article>", "<noscript><p>no</p></noscript><link href=x><article>"):
        assert said(f"<html><head><title>t <b</title><meta charset=utf-8>{start}<p>{PARA}</p></article>") == [(PARA, "content")]
    assert said(f"<head><title>t</title>\n{PARA}") == [(PARA, "none")]


def test_a_form_around_the_page_is_no_boilerplate():
    assert said(f"<body><form id=f><nav>Home</nav><main><p>{PARA}</p></main></form>") == [("Home", "echo"), (PARA, "content")]
    assert said(f"<body><form id=f><div><p>{PARA}</p></div></form></body>") == [(PARA, "none")]
    assert said(f"<body><article><p>{PARA}</p><form><label>Mail</label></form></article>") == [(PARA, "content"), ("Mail", "echo")]
