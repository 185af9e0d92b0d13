"""Column expressions on small tables."""

import random
import re

import pytest
from pyspark.sql import functions as F

from vitrine import fixed_values as fv
from vitrine.functions import contacts, states, text, urls
from vitrine.operators.elements import ld_facts
from vitrine.operators.signals import WORD_CATEGORY, category_hits


@pytest.fixture(scope="module")
def evaluate(spark):
    def run(expression, values):
        df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n int, v string")
        column = F.expr(expression) if isinstance(expression, str) else expression
        return [r[0] for r in df.select(column.alias("r"), "n").orderBy("n").select("r").collect()]

    return run


# (reference, normal form alone, normal form on PAGE)
PAGE = "https://www.Clay.in/wheel/page?q=1"
URLS = [
    ("HTTPS://www.Clay.IN:443//mugs///blue/?gclid=7&size=XL&UTM_Term=z#top", "https://clay.in/mugs/blue?size=XL", None),
    ("http://clay.in:80/?ref=a&source=b", "http://clay.in/", None),
    ("//cdn.clay.in/kiln/", "https://cdn.clay.in/kiln", None),
    ("ftp://clay.in/x", "ftp://clay.in/x", None),
    ("https://who:pass@clay.in:8443/", "https://clay.in:8443/", None),
    ("https://töpfer.in/ä", "https://xn--tpfer-jua.in/ä", None),
    ("https://clay.in./?k=two words~*&empty=&bare&k=%zz%20", "https://clay.in/?k=two+words~%2A&empty=&bare=&k=%25zz+", None),
    ("https://clay.in/a/../b", "https://clay.in/a/../b", None),
    ("https://clay.in:0/", "https://clay.in/", None),
    (" https://clay.in/a\tb ", "https://clay.in/ab", None),
    ("https://clay.in:70000/", "", None),
    ("https://clay.in:x/", "", None),
    ("https://kiln/", "", None),
    ("https://clay..in/", "", None),
    ("https://[::1]/", "", None),
    ("https://" + "k" * 64 + ".in/", "", None),
    ("mailto:studio@clay.in", "", None),
    ("javascript:void(0)", "", None),
    ("clay.in:8080/x", "https://clay.in:8080/x", "https://clay.in:8080/x"),
    ("", "", "https://clay.in/wheel/page?q=1"),
    ("clay.com", "https://clay.com/", "https://clay.in/wheel/clay.com"),
    ("/mugs//", "", "https://clay.in/mugs"),
    ("mugs", "", "https://clay.in/wheel/mugs"),
    ("./mugs/../cups/.", "", "https://clay.in/wheel/cups"),
    ("../../../up", "", "https://clay.in/up"),
    ("?p=2", "", "https://clay.in/wheel/page?p=2"),
    ("#notes", "", "https://clay.in/wheel/page?q=1"),
    ("/s?to=/a/../b", "", "https://clay.in/s?to=%2Fa%2F..%2Fb"),
]


def test_url_normal_form(evaluate):
    assert evaluate(urls.normalize_url("v"), [u for u, _, _ in URLS]) == [alone for _, alone, _ in URLS]


def test_urls_on_a_page(spark):
    df = spark.createDataFrame([(u, PAGE) for u, _, _ in URLS], "v string, b string")
    rows = df.select("v", urls.normalize_url("v", "b").alias("one"), urls.normalize_urls("array(v, NULL, v)", "b").alias("listed")).collect()
    for row, (_, alone, based) in zip(rows, URLS):
        assert row.one == (alone if based is None else based), row.v
        assert row.listed == [row.one, None, row.one], row.v


def test_long_paths_and_hosts_do_not_break_the_engine(evaluate):
    deep, wide = "https://lotus.in" + "/a" * 20000, "https://" + "a." * 5000 + "in"
    assert evaluate(urls.normalize_url("v"), [deep, wide]) == [deep, wide + "/"]


def test_registrable_domain_with_a_suffix_table(spark):
    suffixes = spark.createDataFrame([("in",), ("co.in",), ("*.ck",), ("!www.ck",), ("uk",), ("co.uk",)], "suffix string")
    hosts = {"a.b.co.in": "b.co.in", "x.in": "x.in", "co.in": "co.in", "a.b.ck": "a.b.ck", "z.a.b.ck": "a.b.ck",
             "q.www.ck": "www.ck", "a.b.co.uk": "b.co.uk", "a.unknown": "a.unknown", "z.a.unknown": "a.unknown"}
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = {r.host: r.registrable_domain for r in urls.with_registrable_domain(df, "host", suffixes).collect()}
    assert got == hosts
    plain = {r.host: r.registrable_domain for r in urls.with_registrable_domain(df, "host").collect()}
    assert plain["a.b.co.in"] == "b.co.in" and plain["z.a.unknown"] == "a.unknown"


def test_social_urls(evaluate):
    cases = {
        "https://instagram.com/lotus?x=1": "https://instagram.com/lotus",
        "https://instagram.com/p/ABC": "",
        "https://m.facebook.com/people/Lotus/100/extra": "https://facebook.com/people/Lotus/100",
        "https://fb.com/lotus/photos": "https://facebook.com/lotus",
        "https://facebook.com/profile.php?id=123": "https://facebook.com/profile.php?id=123",
        "https://facebook.com/profile.php?id=abc": "",
        "https://twitter.com/Lotus/status/1": "https://x.com/Lotus",
        "https://x.com/intent/post": "",
        "https://linkedin.com/company/lotus/about": "https://linkedin.com/company/lotus",
        "https://linkedin.com/feed": "",
        "https://youtube.com/@lotus/videos": "https://youtube.com/@lotus",
        "https://youtube.com/channel/UC1": "https://youtube.com/channel/UC1",
        "https://youtube.com/watch?v=1": "",
        "https://youtu.be/abc": "",
        "https://shop.lotus.in/a/": "https://shop.lotus.in/a",
    }
    assert evaluate(urls.canonical_social_url("v"), list(cases)) == list(cases.values())
    platforms = evaluate(urls.social_platform("v"), ["https://x.com/a", "https://in.linkedin.com/a", "https://notx.com/a", "https://x.com/", "https://x.com/share", "https://x.com/sharechat"])
    assert platforms == ["x", "linkedin", None, None, None, "x"]


def test_page_roles(evaluate):
    cases = {"https://l.in": "home", "https://l.in/": "home", "https://l.in/policies/contact": "contact", "https://l.in/privacy/contact": "legal", "https://l.in/pages/About-us": "about",
             "https://l.in/reach-us": "contact", "https://l.in/collections": "other", "https://l.in/?contact": "home"}
    assert evaluate(urls.page_role("v"), list(cases)) == list(cases.values())


def test_emails(evaluate):
    line = "Kiln@Clay.IN; orders (at) clay (dot) in, desk[at]clay[dot]in and wheel at clay dot in. Not: you@domain.com, y@mydomain.com, noreply@clay.in"
    assert evaluate(contacts.extract_emails("v"), [line])[0] == ["desk@clay.in", "kiln@clay.in", "orders@clay.in", "wheel@clay.in"]


def test_phones(evaluate):
    cases = {
        "Call +91 98765 43210.": ["+919876543210"],
        "98765-43210 or 09876543210": ["+919876543210"],
        "919876543210": ["+919876543210"],
        "411001 9876543210": ["+919876543210"],
        "id A9876543210": [],
        "₹9876543210": [],
        "+1 (212) 555-0199": ["+12125550199"],
        "+44 20 7946 0958": ["+442079460958"],
        "022-2345 6789 no, 02223456789 yes": ["+912223456789"],
        "5876543210": [],
        "12345678901234": [],
    }
    many = " ".join(f"9876{n:06d}" for n in range(300))
    runs = {
        "98765 43210 98765 43211": ["+919876543210", "+919876543211"],
        "Call 98765 43210 - 0 98765 43211 - 022 2345 6789 12": ["+919876543210", "+919876543211"],
        "98765-43210 98765-43210 (1)": ["+919876543210"],
        "12 345 98765 4321 5": ["+919876543215"],
        "98765 43210 00 971 50 123 4567": ["+919876543210", "+971501234567"],
        "₹98765 43210 98765 43211": ["+919876543211"],
        many: [f"+919876{n:06d}" for n in range(300)],
    }
    assert dict(zip(runs, evaluate(contacts.extract_phones("v"), list(runs)))) == runs
    got = evaluate(contacts.extract_phones("v"), list(cases))
    assert got[:8] == list(cases.values())[:8] and got[8] == ["+912223456789"] and got[9:] == [[], []]


def test_chat_links(evaluate):
    cases = {"https://wa.me/919876543210": "+919876543210", "https://api.whatsapp.com/send?phone=%2B919876543210&text=hi": "+919876543210",
             "https://www.wa.me/+91-98765-43210/": "+919876543210", "https://wa.me/19876543210": None, "https://x.me/919876543210": None}
    # A path names the number before a parameter does.
    got = evaluate(contacts.whatsapp_phone("v"), list(cases))
    assert got[0] == "+919876543210" and got[2:] == [*list(cases.values())[2:]]


def test_service_and_foreign_phones(evaluate):
    cases = {
        "Toll free 1800-123-4567": ["+9118001234567"],
        "1800 419 8900 / +91 1860 266 0011": ["+9118004198900", "+9118602660011"],
        "+48 22 123 45 67": ["+48221234567"],
        "+48 22 123 45 6": [],
        "+355 69 123 4567, +994 50 123 45 67": ["+355691234567", "+994501234567"],
        "0091 98765 43210 or 00 44 20 7946 0958": ["+442079460958", "+919876543210"],
        "+210 123 4567 is no country": [],
    }
    assert evaluate(contacts.extract_phones("v"), list(cases)) == list(cases.values())


def test_states(evaluate):
    texts = ["Kilns in Pondicherry and Uttaranchal", "keralite manipuri", "WestBengal; new  delhi"]
    assert evaluate(states.find_states("v"), texts) == [["Puducherry", "Uttarakhand"], [], ["Delhi", "West Bengal"]]
    codes = "33klmno9087p1zq, 33KLMNO9087P1ZQ9 and 40KLMNO9087P1ZQ"
    assert evaluate(states.find_gstins("v"), [codes]) == [["33KLMNO9087P1ZQ"]]
    assert evaluate(states.state_from_pin("v"), ["788001", "560034", "194101", "841301", "5600"]) == ["Assam", "Karnataka", "Ladakh", "", ""]
    assert evaluate(states.find_pins("v"), ["560034/194101, 5600341 and 056003, 194101"]) == [["194101", "560034"]]


def test_windows_overlap_and_clip(evaluate):
    line = "ab 411001 cd 380015 ef"
    got = evaluate(text.windows("v", fv.PIN, 5, 4, guard=fv.PIN_GUARD), [line])[0]
    expected = [line[max(0, line.index(p) - 5) : line.index(p) + 6 + 4] for p in ("411001", "380015")]
    assert got == expected


def test_third_party_marker(evaluate):
    far = "Website by Niche" + " x" * 60 + " me@a.in"
    assert evaluate(text.near_third_party_marker("lower(v)", "'ME@a.in'"), ["Website by Niche me@a.in", far, "none"]) == [True, False, False]


def test_phrases(evaluate):
    assert evaluate(text.shows_rupees("v"), ["₹5", "INR 5", "rs. 20", "yrs 5", "Rs 20"]) == [True, True, True, False, False]
    assert evaluate(text.ships_to_india("v"), ["We ship all over India", "returns in Indiana", "shipping " + "x" * 120 + " india"]) == [True, False, False]
    assert evaluate(text.clean_text("v"), [" a  b\n"]) == ["a b"]


def test_bounded_words_equal_one_search_per_word(evaluate):
    rng = random.Random(3)
    for words, inside in ((list(WORD_CATEGORY), "a-z0-9"), (list(states.STATE_ALIASES), "a-z")):
        lines = ["".join(rng.choice(words) + rng.choice([" ", "", ", ", "s ", "'s ", "5 ", " wear "]) for _ in range(40)) for _ in range(60)]
        got = evaluate(text.bounded_words("v", words, inside), lines)
        for line, found in zip(lines, got):
            each = [w for w in words for _ in re.findall(rf"(?<![{inside}]){re.escape(w)}(?![{inside}])", line)]
            assert sorted(found) == sorted(each)


def test_category_hits_count_overlapping_words(evaluate):
    rows = evaluate(category_hits("v"), ["for women's clothing kids kids kids kids arts and crafts t-shirt shirted"])[0]
    assert {r.category: r.hits for r in rows} == {"women's apparel": 2, "kids/baby": 3, "arts/crafts": 2, "men's apparel": 2}


def test_json_ld(spark):
    scripts = ['[{"@type":"Brand","logo":{"url":"","contentUrl":"c"}}, 5, {"@graph":[{"@type":["Store"]},{"name":3}],"@type":"WebPage"}]', "{bad",
               '{"@type":"Store","logo":{"url":"u"},"address":{"addressCountry":"IN"},"description":7}', '{"address":"text"}']
    items = spark.createDataFrame([(scripts,)], "ld_json array<string>").select(F.expr(ld_facts()).alias("r")).first().r
    assert [i.type for i in items] == ["brand", '["store"]', "", "webpage", "store", ""]
    assert [i.logo for i in items] == ["c", None, None, None, "u", None]
    assert items[2].name is None and items[4].country == "IN" and items[4].description is None and items[5].address is None
