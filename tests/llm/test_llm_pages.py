"""Pages whose markup must not cost article text."""

import time

import pytest

from eventide.llm import html_extract as H

SF = "/root/testdata/sf0.01"
STORY = [f"The {w} went down to the harbour in the evening, and nobody there had seen a storm like it for many years." for w in
         ("captain", "baker", "teacher", "old fisherman")]


@pytest.fixture(scope="module")
def extractor(spark):
    return H.Extractor.from_bytes(H.train(spark.read.parquet(f"{SF}/pages.parquet")))


def page(article, before="", after="", head=""):
    menu = "<nav><ul>" + "".join(f'<li><a href="/{i}">Item {i}</a></li>' for i in range(5)) + "</ul></nav>"
    return (f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body>{menu}{before}{article}{after}"
            "<footer><p>Copyright by us</p></footer></body></html>")


BODY = "".join(f"<p>{x}</p>" for x in STORY)
WANT = " ".join(STORY)


@pytest.mark.parametrize("broken", [
    "<svg class='i'/>", "<svg class='i'><path d='M0'/>", "<svg><title>Icon</title><g><path/></g></svg>", "<object data=x />", "<object data=x>",
    "<canvas/>", "<canvas>", "<select><option>One<option>Two", "<select/>", "<select><option>One</option></select>", "<datalist><option>One",
    "<template><p>Never seen</p></template>", "<template>", "<iframe src=x>", "<noscript>", "<video src=x>", "<audio/>", "<map>", "<math/>",
    "<svg/>" * 50, "</b></i></div></svg>" * 20])
def test_no_element_swallows_the_article(extractor, broken):
    for html in (page(f"<article>{broken}{BODY}</article>"), page(f"<article>{BODY}</article>", before=f"<div>{broken}</div>"),
                 page(f"<article>{STORY[0]}{broken}{''.join(f'<p>{x}</p>' for x in STORY[1:])}</article>")):
        assert extractor.texts([html]) == [WANT]


def test_icon_in_the_menu(extractor):
    html = f"<html><body><nav><a href=/><svg class='i'/>Home</a></nav><article>{BODY}</article></body></html>"
    assert extractor.texts([html]) == [WANT]


def test_formulas_are_text(extractor):
    html = page("<article><p>" + STORY[0] + "</p><p>the law states that <math><mi>E</mi><mo>=</mo><mrow><mi>m</mi><mi>c</mi></mrow>"
                "<annotation>E=mc</annotation></math> holds for all of them, and that nothing else matters.</p></article>")
    assert extractor.texts([html]) == [f"{STORY[0]} the law states that E=mc holds for all of them, and that nothing else matters."]


def test_the_title_in_the_articles_header(extractor):
    for tag in ("<header>", "<header class=entry-header>"):
        html = page(f"<article>{tag}<h1>A storm at the harbour</h1></header>{BODY}</article>",
                    before="<header class='site-header'><a href='/'>The Paper</a></header>")
        assert extractor.texts([html]) == [f"A storm at the harbour {WANT}"]


def test_a_head_without_an_end(extractor):
    html = f"<html><head><meta charset=utf-8><title>T</title><style>p{{}}</style><article>{BODY}</article></html>"
    assert extractor.texts([html]) == [WANT]


def test_comments_without_names(extractor):
    notes = "".join(f"<p>{who}: {what}</p>" for who, what in (("Bob", "nice post!"), ("Ann", "thanks a lot"), ("Joe", "me too"), ("Eve", "first")))
    html = page(f"<div><div><h1>A storm at the harbour</h1>{BODY}</div></div>", after=f"<div>{notes}</div>")
    got = extractor.texts([html])[0]
    assert WANT in got and "nice post" not in got


@pytest.mark.parametrize("unit", ["<b>", "<b></i>", "<p></i>", "<div><p><b>", "<li><b>", "</div>", "<svg></b>", "<template>", "<iframe>", "<noscript>",
                                  "<select>", "<p><b><h1>", "<a '>", "<!--", "<table><tr><td>"])
def test_a_megabyte_of_stray_tags(unit):
    """Linear time, whatever is opened and never closed."""
    start = time.time()
    H.Page(unit * (1_000_000 // len(unit)))
    assert time.time() - start < 20
