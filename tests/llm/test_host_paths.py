"""Main text of pages of several hosts and layouts, malformed pages, and votes that change what is extracted."""

import pytest

from ledgerlake.llm.host_paths import Page, extract, host_votes, main_text
from tests.llm.awkward import CLASHING

PARAGRAPHS = [f"Paragraph {i} tells about the matter, at some length, in plain words &amp; more." for i in range(6)]
TEXT = "The <b>head</b>line" + "".join(PARAGRAPHS)
BODY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
PLAIN = "The headline " + " ".join(PARAGRAPHS).replace("&amp;", "&")
MENU = "<nav><ul><li><a href='/a'>Menu</a></li><li><a href='/b'>More of the menu</a></li></ul></nav>"

LAYOUTS = {
    "article": f"{MENU}<article><h1>The <b>head</b>line</h1>{BODY}</article><footer>&copy; us</footer>",
    "unclosed": f"{MENU}<article><h1>The headline</h1>{BODY.replace('</p>', '')}</article><footer>us",
    "main": f"<header><h1>Site name</h1>{MENU}</header><main><h1>The headline</h1>{BODY}<form>Your <input> address</form></main>",
    "content class": f"<div class='top-nav'>Menu and more</div><div class='page-12'><div id=x class='post content-7'><h2>The headline</h2>{BODY}</div>"
    "<div class='sidebar'><p>Other things that people read here</p></div></div>",
    "comments": f"<div class='entry'><h1>The headline</h1>{BODY}<div id='comments'><p>{'I do not agree. ' * 80}</p></div></div>",
    "header inside": f"<div class='banner'>Buy this now</div><article><header><h1>The headline</h1></header>{BODY}<aside>See also</aside></article>",
    "adverts": f"<article><h1>The headline</h1>{BODY.replace('</p>', '</p><div class=ad>Buy!</div><script>var x = \"<p>no</p>\";</script>', 2)}"
    "<div role=complementary>more</div></article><div class='cookie-notice'>We use cookies</div>",
    "sections": "<div class='w'><div class=main><h1>The headline</h1>"
    + "".join(f"<section><p>{p}</p></section>" for p in PARAGRAPHS)
    + "</div></div><form><p>Subscribe to our letter, it is free</p></form>",
    "quoted": f"<div title='a > b' class=\"story\"><h1>The headline</h1>{BODY}</div><!-- <p>gone</p> --><template><p>gone</p></template>",
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(name):
    assert extract(f"<!DOCTYPE html><html><head><title>No</title><style>p{{}}</style></head><body>{LAYOUTS[name]}</body></html>", None) == PLAIN


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("", ""), (None, ""), ("plain text", "plain text"), ("<p>a<b>b</b>c<br>d&nbsp;\n e</p>f", "abc d e f"), ("a < b > c", "a < b > c"),
        ("<p>x</p><script>never closed <p>y</p>", "x"), ("<p>x<svg>shown <p>y</p>", "xshown y"), ("</div></div><p>x</div>", "x"),
        ("<!-- never closed <p>x</p>", ""), ("<nav>only a menu</nav>", ""), ("&lt;p&gt; &#x1F600; &amp;amp;", "<p> 😀 &amp;"),
        ("a&am<b>p;</b>", "a&amp;"), ('<p title="never closed>x</p>', "x"), ("<", "<"), ("<p", "<p"), ("<a href='x'>just a link</a>", ""),
    ],
)
def test_malformed(source, text):
    assert extract(source, None) == text


def test_long_and_deep_pages():
    many = "<div>" * 3000 + BODY * 300 + "</div>" * 3000
    assert len(extract(many, None)) == len(" ".join(PARAGRAPHS * 300).replace("&amp;", "&"))
    assert extract("<a <a " * 50_000 + "<p>x</p>", None).endswith("x")
    assert extract('<a "' * 50_000 + "<p>x</p>", None).endswith("x")


def test_paths_are_generalised():
    assert Page("<body><div class='Post post-12 b2' id=c9><p>x</p></div>").paths[-1] == ">body>div.b.post"


def pages(spark, rows):
    extra = [f"{c} string" for c in [*CLASHING, "host", "path", "paths", "votes", "rank", "source"]]
    return spark.createDataFrame([(*r, *["?"] * len(extra)) for r in rows], ", ".join(["page_id bigint", "url string", "html string", *extra]))


def test_votes_of_a_host_decide(spark):
    regular = f"<body><div class='text-1'>{BODY}</div><div class='foot'>Short words of the house</div></body>"
    # Alone, this page's best container would be the other one.
    short = "<body><div class='text-9'><p>A short note.</p></div><div class='foot'>" + "Long words of the house. " * 20 + "</div></body>"
    elsewhere = "<body><section>Another layout, without the usual path</section></body>"
    rows = [(i, f"http://user@A.example:80/{i}", regular) for i in range(5)]
    rows += [(5, "https://a.example/x?y=//b", short), (6, "http://a.example/z", elsewhere), (7, "http://b.example/", short)]
    rows += [(8, None, regular), (9, "not a url", regular), (9, "not a url", regular), (None, "", None), (10, "http://a.example/e", "")]
    found = sorted(map(tuple, main_text(pages(spark, rows)).select("page_id", "text").collect()), key=str)
    body = " ".join(PARAGRAPHS).replace("&amp;", "&")
    assert found == sorted(
        [(i, body) for i in (0, 1, 2, 3, 4, 8, 9, 9)]
        + [(5, "A short note."), (6, "Another layout, without the usual path"), (None, ""), (10, "")]
        + [(7, ("Long words of the house. " * 20).strip())],
        key=str,
    )
    votes = {(r.host, r.path): r.votes for r in host_votes(pages(spark, rows)).collect()}
    assert votes["a.example", ">body>div.text"] == 5 and votes["", ">body>div.text"] == 3


def test_empty_table(spark):
    assert main_text(pages(spark, [])).collect() == []
