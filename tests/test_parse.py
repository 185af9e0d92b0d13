import json
import random

from vitrine.operators.parse import _PageEvents


def facts(markup):
    return _PageEvents().facts(markup)


def own(result, element):
    text = result["full_text"] or result["text"]
    return text[element["start"] - 1 : element["start"] - 1 + element["len"]]


def of(result, tag):
    return [e for e in result["elements"] if e["tag"] == tag]


def test_text_leaves_out_code_comments_and_doctype():
    r = facts("<!DOCTYPE html><title>T</title><style>p{}</style><script>var a='</p>'</script><!-- note --><p>A  b\n c</p>")
    assert r["text"] == "T A b c"


def test_entities_are_resolved_twice():
    assert facts("<p>a &amp;amp; b&nbsp;c &amp;copy;</p>")["text"] == "a & b c ©"


def test_offsets_point_at_the_elements_text():
    r = facts("<body><h1>One <b>two</b></h1><p>zero</p><main><p>three<p>four</main></body>")
    assert own(r, of(r, "h1")[0]) == "One two"
    # paragraphs that are never closed nest, as the parser of record sees them
    assert [own(r, e) for e in of(r, "p")] == ["three four", "four"]


def test_offsets_count_characters():
    r = facts("<p>é₹😀 x</p><a href='/k'>yz</a>")
    assert own(r, of(r, "a")[0]) == "yz"


def test_hidden_text_differs_from_own_text():
    r = facts("<body><footer>a<noscript>b</noscript><svg><text>c</text></svg></footer><template>d</template></body>")
    assert r["text"] == "a" and r["full_text"] == "a b c"
    assert own(r, of(r, "footer")[0]) == "a b c"


def test_markers_and_attributes():
    r = facts('<header><a href="/"><img data-src="x.svg" ALT="Logo"></a><a href="./"><img src="y"></a></header><a href="/"><img src="z"></a>')
    assert [e["within"] for e in of(r, "img")] == [["header", "home_link"], ["header", "home_dot_link"], []]
    assert dict(of(r, "img")[0]["attrs"]) == {"data-src": "x.svg", "alt": "Logo"}


def test_content_root_is_the_first_main():
    r = facts("<body>x<main>a<main>b</main></main><main>c</main></body>")
    assert r["text"][r["content_start"] - 1 : r["content_start"] - 1 + r["content_len"]] == "a b"


def test_content_root_falls_back_to_body_then_page():
    r = facts("<title>t</title><body>b</body>")
    assert r["text"][r["content_start"] - 1 :][: r["content_len"]] == "b"
    r = facts("just text")
    assert r["text"][r["content_start"] - 1 :][: r["content_len"]] == "just text"


def test_json_ld_is_raw():
    r = facts('<script type="Application/LD+json">{"a": "<b>&amp;"}</script><script>var x</script>')
    assert r["ld_json"] == ['{"a": "<b>&amp;"}']


def test_stray_end_tags_are_ignored():
    r = facts("</div><div class='contact-box'>a</span>b</div>c")
    assert [own(r, e) for e in r["elements"]] == ["a b"]


def test_deep_nesting_keeps_facts_small():
    r = facts("<div class='contact'>x" * 2000)
    assert len(r["elements"]) == 2000 and len(r["text"]) == 3999


def test_odd_markup_does_not_fail():
    for markup in ("", "<", "<a href", "<![CDATA[x]]>", "<!", "&#xffffffff;", "<p " + "a" * 500):
        facts(markup)


def test_text_members_of_json_ld_have_their_references_resolved():
    script = '{"@type": "Product", "name": "Men&rsquo;s \\u0026#8377;5 &eacute;", "category": "A &amp; B \\"x\\"", "logo": "https://a.in/l?a=1&copy=2", "description": 5}'
    r = facts(f'<script type="application/ld+json">{script}</script>')
    item = json.loads(r["ld_json"][0])
    assert item["name"] == "Men’s ₹5 é" and item["category"] == 'A & B "x"'
    assert item["logo"] == "https://a.in/l?a=1&copy=2" and item["description"] == 5
    broken = '{"name": "a &amp; b \\q"}'
    assert facts(f'<script type="application/ld+json">{broken}</script>')["ld_json"] == [broken]


# --- the plain reader against the standard parser ---------------------------------

PIECES = [
    "<p>", "</p>", "<a href='y&amp;z'>", '<a HREF="/" class="contact">', "</a>", "<script>", "</script>", "</SCRIPT >", "<!-- c -->", "<!-->", "<!--a--!>",
    '<script>var t="</p>";</script>', '<script type="application/ld+json">{"name":"a&amp;b"}</script>', "<style>p{}</style>", "<script/>", "<title>", "</title>",
    "<!DOCTYPE html>", "<![CDATA[x]]>", "<?pi?>", "<a b=c/>", '<a href = "x">', '<a href="x"class="y">', "<a\x0bhref='q'>", "<img src='a' alt>", "<br/>", "</ p>", "</>",
    "<", ">", "&am", "&amp;amp;", "text ", "é₹", '<main class="hero">', "</main>", "<textarea>", "<plaintext>", "<footer id=address>", "<", '"',
]


def test_plain_markup_is_read_as_by_the_standard_parser():
    class Standard(_PageEvents):
        def _read_plain(self, body):
            return 0

    draw = random.Random(7)
    for _ in range(4000):
        body = "".join(draw.choices(PIECES, k=draw.randint(1, 12)))
        assert _PageEvents().facts(body) == Standard().facts(body), body


def test_plain_markup_needs_no_standard_parser():
    body = '<!DOCTYPE html><!-- x --><p class="a">b &amp; c<br/><script>if (a < b) t = "</p>"</script><a href=\'/\' hidden>d</a></p>'
    assert _PageEvents()._read_plain(body) == len(body)
    assert _PageEvents()._read_plain("<p>a</p><a b=c>d</a>") == len("<p>a</p>")
