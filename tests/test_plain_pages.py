"""The expression for plain summary blocks reads what the tokenizer reads."""

import random

from nestmart.operators import pages

PARTS = ["<div>", '<div class="a-section">', '<div class="mojo-performance-summary-table">',
         '<div class="mojo-summary-values x">', '<span class="a-size-medium">', "<span>", "</span>",
         "</div>", "</div>", "</p>", "<br>", "<img src=\"a\">", "Budget $1,000", "Domestic Opening $7",
         "$5 &amp; &lt;b&gt;", "&notit; &#36;", "\n ", "<p id=\"1\" class=\"a b\" class=\"c\">",
         "<!-- x -->", "<script>'</div>'</script>", "<DIV CLASS=a-section>", "<i/>", "a < b", "&amp"]
BLOCK = '<div class="mojo-summary-table">'


def shape(node):
    if isinstance(node, str):
        return node
    return node.tag, sorted(node.classes), [shape(c) for c in node.children]


def test_plain_block_builds_the_tokenizers_tree():
    rng = random.Random(3)
    plain = 0
    for _ in range(4000):
        n = len(PARTS) if rng.random() < 0.3 else len(PARTS) - 6
        body = "".join(rng.choice(PARTS[:n]) for _ in range(rng.randrange(14)))
        html = "<p>x" + BLOCK + body + "</div>" * rng.randrange(6)
        at = html.index(BLOCK)
        found = pages._plain_block(html, at)
        if found is not None:
            plain += 1
            assert shape(found) == shape(pages._parse(html[at:], pages.SUMMARY_CLASS)), html
    assert plain > 500


def test_plain_pages_need_no_tokenizer(monkeypatch):
    row = '<div class="a-section">'
    html = ("<title>T</title><script src=\"a\">var x = 1;</script>" + BLOCK
            + '<div class="mojo-performance-summary-table">' + row
            + '<span class="a-size-medium">\n $9&amp;\n</span></div></div>'
            '<div class="mojo-summary-values">' + row + "Budget $3</div></div></div><p>rest")
    monkeypatch.setattr(pages, "_parse", None)
    assert pages.extract_one(html) == ("", "$9&", "3")


def test_pages_with_hidden_heads_read_as_parsed_whole():
    heads = ["<title>T</title>", "<title>" + BLOCK + "</title>", "<!-- <title>x</title>", "-->",
             "<script>var a = 1;</script>", "<script>'<b>'</script>", "<style>", "</style>",
             "<scr<title>a</title>ipt>", "<TITLE lang=\"a\">b</Title>", "<noscript>x</noscript>", "<p>"]
    rng = random.Random(5)
    block = (BLOCK + '<div class="mojo-performance-summary-table"><div class="a-section">'
             '<span class="a-size-medium">$%d</span></div></div>'
             '<div class="mojo-summary-values"></div></div>')
    for k in range(1500):
        html = "".join(rng.choice(heads) for _ in range(rng.randrange(5))) + block % k
        root = pages._parse(html)
        whole = root.find("div", pages.SUMMARY_CLASS)
        found = pages._summary_block(html)
        assert (found and found.text()) == (whole and whole.text()), html
