import re

from kerbside.llm import extract, surrogates

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/x">Home</a></ul></nav><div class="cookie-notice">We use cookies</div>
<article class="post"><header><h1>A &amp; B&nbsp;C</h1></header><p>One  <b>bo</b>ld
line<br>and more<p>Two &lt;x&gt; &#233; &copy;<!-- <p>no</p> --><aside>no</aside><form><input value=">"><p>no</form>
<ul><li>x<li>y</ul><div id="comments"><article><p>no</article></div><p>last</article><div class="sidebar">no</div>
<footer>no</footer></body></html>"""


def test_blocks():
    found = [t for t, kind in extract.blocks(PAGE) if kind == "article"]
    assert found == ["A & B C", "One bold line and more", "Two <x> é ©", "x", "y", "last"]
    assert extract.blocks(None) == extract.blocks("") == extract.blocks("<p> </p>") == []
    assert extract.blocks("a < b <p class='x") == [("a < b <p class='x", "body")]
    assert [t for t, _ in extract.blocks("<div>" * 3000 + "deep" + "</div>" * 3000)] == ["deep"]


def test_main_text(spark):
    own = lambda i: " ".join(f"word{i * 100 + j}" for j in range(15))
    menu = "Home News Sport Weather Contact About us Imprint"
    bare = [(i, "http://User@Host.example:80/a", f"<div>{menu}</div><p>{own(i)}</p><div>All rights reserved by the owner of host {'x' * 3}</div>") for i in range(2, 9)]
    other = (20, "http://other.example/", f"<div>{menu}</div><p>text</p>")
    rows = [(1, "https://host.example/p", PAGE), *bare, other, (30, None, None), (31, "", ""), (None, "u", "<main><p>m<nav>no</nav></main>"), bare[0], (40, "http://z/", "<p>" + "w " * 50_000)]
    pages = spark.createDataFrame([(*r, "c", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = {}
    for r in extract.main_text(pages).collect():
        assert r.n_chars == len(r.text)
        got.setdefault(r.page_id, []).append(r.text)
    assert got[1] == ["A & B C\nOne bold line and more\nTwo <x> é ©\nx\ny\nlast"]
    for i, *_ in bare:
        assert set(got[i]) == {own(i)}
    assert len(got[2]) == 2
    assert got[20] == [f"{menu}\ntext"]  # repeated on another host only
    assert got[30] == got[31] == [""] and got[None] == ["m"] and len(got[40][0]) == 99_999
    assert extract.main_text(pages.where("false")).count() == 0


def test_surrogates(spark):
    texts = {
        1: "Mail a.b7@mail.example.com or A.B7@MAIL.EXAMPLE.COM, call +1 (017) 555-7713 or +1-017-555-7713.",
        2: "John Smith met Mary, and John saw Анна; card 4111 1111 1111 1111 and 4111111111111111, host 10.20.30.40.",
        3: "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" SSN 123-45-6789 IBAN DE89 3704 0044 0532 0130 00",
        4: "nothing here: 12 3.5 1.2.3 2024-01-01 john",
    }
    rows = [*texts.items(), (5, None), (6, ""), (None, texts[1]), (1, texts[1]), (7, "x " * 50_000 + "call +1 (017) 555-7713"), (8, "a" * 300_000 + "a." * 100_000)]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, entities string")
    got = {}
    for r in surrogates.replace(docs).collect():
        got.setdefault(r.doc_id, []).append((r.text, r.n_entities))
    assert got[5] == [(None, 0)] and got[6] == [("", 0)] and got[4] == [(texts[4], 0)]
    assert got[1] == 2 * got[None]
    one, n = got[1][0]
    assert n == 4
    m = re.fullmatch(r"Mail (\S+@\S+\.com) or (\S+@\S+\.COM), call \+1 \((\d{3})\) (\d{3})-(\d{4}) or \+1-(\d{3})-(\d{3})-(\d{4})\.", one)
    assert m and m[1].upper() == m[2] and m.groups()[2:5] == m.groups()[5:8] and m[1] != "a.b7@mail.example.com" and (m[3], m[4], m[5]) != ("017", "555", "7713")
    assert got[7][0][0].endswith(f"+1 ({m[3]}) {m[4]}-{m[5]}")
    m = re.fullmatch(r"(\w+) (\w+) met (\w+), and (\w+) saw (\w+); card (\d{4}) (\d{4}) (\d{4}) (\d{4}) and (\d{16}), host (\d+\.\d+\.\d+\.\d+)\.", got[2][0][0])
    assert m and m[1] == m[4] and "".join(m.groups()[5:9]) == m[10] != "4111111111111111"
    men, women, kyrillic = (surrogates.NAMES[k].split() for k in (("m", "latin"), ("f", "latin"), ("f", "cyrillic")))
    assert m[1] in men and m[3] in women and m[5] in kyrillic and m[2] != "Smith"
    assert re.fullmatch(r'token = "[0-9a-f]{40}" SSN \d{3}-\d\d-\d{4} IBAN DE\d\d( \d{4}){4} \d\d', got[3][0][0])
    assert surrogates.replace(docs.where("false")).count() == 0


def test_assignment_keeps_distinct(spark):
    names = [n for names in surrogates.NAMES.values() for n in names.split()]
    small = [("ssn", f"{i:02d}") for i in range(60)]  # 60 of 100 possible: many collisions
    entities = spark.createDataFrame([("name", n) for n in dict.fromkeys(names)] + small, "kind string, canon string")
    rows = surrogates.assign(entities.where("kind = 'name'"), "k").collect()
    assert len({r.surrogate for r in rows}) == len(rows) == len(dict.fromkeys(names))
    assert not {r.surrogate for r in rows} & set(names)
    assert {r.canon: r.surrogate for r in rows} == {r.canon: r.surrogate for r in surrogates.assign(entities.where("kind = 'name'"), "k").collect()}
    few = surrogates.assign(entities.where("kind = 'ssn' AND canon < '30'"), "k").collect()
    assert len({r.surrogate for r in few}) == 30 and not {r.surrogate for r in few} & {c for _, c in small[:30]}


def test_no_tag_swallows_the_article():
    kept = lambda page: [t for t, kind in extract.blocks(page) if kind == "article"]
    rest = "<p>kept</p></article></body>"
    assert kept('<article><svg viewBox="0 0 1 1"/><p>kept</p><svg><text>no</text></svg></article>') == ["kept"]
    assert kept("<video-js></video-js><article>" + rest) == ["kept"]
    assert kept("<datalist><option value=a>no<option value=b/></datalist><article>" + rest) == ["kept"]
    assert kept("<article><p>so <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math></p></article>") == ["so x=1"]
    for name in ("content with-sidebar", "no-sidebar", "has-banner main", "right-sidebar", "widget-page", "layout-sidebar"):
        assert kept(f'<div class="{name}"><article>{rest}') == ["kept"]
    assert kept('<div class="related"><article><p>no</article></div><article>' + rest) == ["kept"]
    assert kept('<div class="related"><article><p>no</article></div><p>the text of the page') == []


def test_pages_in_a_form_are_chosen_by_repeats(spark):
    own = lambda i: " ".join(f"word{i * 100 + j}" for j in range(15))
    rows = [(i, "http://h.example/", f"<form><div>Home News Sport Weather Contact About us</div><p>{own(i)}</p></form>") for i in range(4)]
    got = extract.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {i: own(i) for i in range(4)}


def test_teasers_in_articles_are_not_the_text(spark):
    own = lambda i: " ".join(f"word{i * 100 + j}" for j in range(40))
    teaser = "<article><p>One teaser that all pages of this host have</article>"
    rows = [(i, "http://h.example/", f"<{tag}><p>{own(i)}</p></{tag}>{teaser}") for i, tag in enumerate(["main", "div", "main", "div"])]
    got = extract.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {i: own(i) for i in range(4)}


def test_surrogates_of_further_formats(spark):
    texts = [
        "IBAN DE89370400440532013000 or DE89 3704 0044 0532 0130 00 IN all; NL91ABNA0417164300",
        "IT60X0542811101000000123456, GB29NWBK60161331926819, FR14 2004 1010 0505 0001 3M02 606, NO93 8601 1117 947.",
        "cards 3782 822463 10005, 3782-822463-10005 and 378282246310005",
        "call 030 12345678, (030) 12345678, 020 7946 0958, 01.42.68.53.00, 0612345678, Tel. 612 345 678 on 01.02.2024 or 05/06/2024 10.30",
        "Dear Zbigniew, Mr. Kowalczyk and Dr. Ağca O'Neil met; name: Xiomara van Dyck; Dear Customer, Dear Sir or Hello World",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_entities) for r in surrogates.replace(docs).collect()}
    assert [got[i][1] for i in range(5)] == [3, 4, 3, 6, 4]
    m = re.fullmatch(r"IBAN (DE\d{20}) or (DE\d\d(?: \d{4}){4} \d\d) IN all; NL\d\d[A-Z]{4}\d{10}", got[0][0])
    assert m and m[1] == m[2].replace(" ", "") != "DE89370400440532013000"
    assert re.fullmatch(r"IT\d\d[A-Z]\d{22}, GB\d\d[A-Z]{4}\d{14}, FR\d\d \d{4} \d{4} \d{4} \d{4} \d[A-Z]\d\d \d{3}, NO\d\d \d{4} \d{4} \d{3}\.", got[1][0])
    m = re.fullmatch(r"cards (\d{4} \d{6} \d{5}), (\d{4}-\d{6}-\d{5}) and (\d{15})", got[2][0])
    assert m and len({re.sub(r"\D", "", x) for x in m.groups()} | {"378282246310005"}) == 2
    m = re.fullmatch(r"call (\d{3} \d{8}), \((\d{3})\) (\d{8}), \d{3} \d{4} \d{4}, \d\d(?:\.\d\d){4}, \d{10}, Tel\. \d{3} \d{3} \d{3} on 01\.02\.2024 or 05/06/2024 10\.30", got[3][0])
    assert m and m[1] == f"{m[2]} {m[3]}"
    m = re.fullmatch(r"Dear ([A-Z][a-z]{7}), Mr\. ([A-Z][a-z]{8}) and Dr\. ([A-Z]\w{3} [A-Z]'[A-Z]\w{3}) met; name: (\w+ \w+ \w+); Dear Customer, Dear Sir or Hello World", got[4][0])
    assert m and not set(m.groups()) & {"Zbigniew", "Kowalczyk", "Ağca O'Neil", "Xiomara van Dyck"}
    for i, text in enumerate(texts):
        for number in re.findall(r"\d{8,}", text):
            assert number not in got[i][0]
