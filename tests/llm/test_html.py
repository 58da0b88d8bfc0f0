import random
import re

import pytest

from ledgerlake.llm import html
from tests.conftest import SMALL_SF


def page(body, tail="</body></html>"):
    return f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul><li>menu</ul></nav><!-- x --><div class='ad'>buy</div>{body}<footer>&copy; f</footer>{tail}"


CASES = [
    ("<article><h1>A &amp; B</h1><p>one\n two<p>three <b>fo</b>ur<br>five</article>", "A & B one two three four five"),
    ("<article><p>a<script>x<y</script>b<aside>side</aside><form>f</form><div class='cookie-notice'>c</div><section id=comments><p>no</section><p>d</article>", "ab d"),
    ("<main><p>&lt;tag&gt; &#233; &amp;amp; &nbsp;x</main>", "<tag> é &amp; x"),
    ("<article><header><h1>in</h1></header><p>t</p><footer>no</footer></article><header>out</header>", "in t"),
    ("<ARTICLE CLASS=x><P>up<P>per</ARTICLE>", "up per"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table><pre> e\n f </pre></article>", "a b c d e f"),
    ("<article><p>broken <b>tags</p> < 5 & more</article", "broken tags < 5 & more"),
    ("<article><p>x<!-- c --><p hidden>h<p>y</article>", "x y"),
    ("<article><p>a</p></article><article><p>b</p></article>", "a b"),
    ("<article></article>", ""),
]


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i, f"http://h{i}.a.net/", page(b)) for i, (b, _) in enumerate(CASES)]
    rows += [(100, None, None), (101, "http://e.net/", ""), (102, "x", "just text & more"), (103, "x", "<p>" * 3000 + "deep"), (104, "http://e.net/", "<<<>>> <"), (104, "http://e.net/", "<<<>>> <")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = html.extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    return got.collect()


def test_articles(found):
    by = {r["page_id"]: r for r in found}
    for i, (_, text) in enumerate(CASES):
        assert by[i]["text"] == text and by[i]["n_chars"] == len(text)


def test_edge_cases(found):
    by = {r["page_id"]: r["text"] for r in found}
    assert by[100] == "" and by[101] == "" and by[102] == "just text & more" and by[103] == "deep"
    assert len(found) == len(CASES) + 6


def test_template_of_pages_without_an_article(spark):
    """Constant nodes are template where no element or class says so."""
    rows = [(i, "http://t.net/", f"<body><div class=top>Welcome</div><div class=m><p>story {i}</p><p>more {i * 7}</p></div><div class=end>All the best</div></body>") for i in range(12)]
    rows += [(50, "http://copies.net/", "<body><div><p>the same</p></div></body>")] * 8
    got = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"story {i} more {i * 7}" for i in range(12))
    assert got[50] == "the same"


def test_constant_parts_of_articles(spark):
    """Copies of an article stay whole; a constant box in it is template."""
    rows = [(i, "http://t.net/", f"<article><h1>Same title</h1><div class=box>Read all our stories</div><p>text {i}</p></article>") for i in range(10)]
    got = {r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {f"Same title text {i}" for i in range(10)}


def _extracted(spark, pages):
    rows = [(i, "http://t.net/", p) for i, p in enumerate(pages)]
    return [r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("page_id").collect()]


def test_text_in_inline_elements_varies_too(spark):
    """A block's text counts with that of its inline descendants."""
    pages = [f"<body><div class=top>Welcome</div><p><span>story {i}</span></p><div>By <a>Name {i}</a></div></body>" for i in range(8)]
    assert _extracted(spark, pages) == [f"story {i} By Name {i}" for i in range(8)]
    pages = [f"<article><h1>title {i}</h1><div class=box><b>Read all</b></div><div><span>text {i}</span></div></article>" for i in range(8)]
    assert _extracted(spark, pages) == [f"title {i} text {i}" for i in range(8)]


def test_only_the_template_text_is_left_out(spark):
    """Other texts at a template's node stay, and copies of a page make no template."""
    pages = [f"<body><div class=top>{'Welcome' if i else 'Site closed'}</div><p>story {i}</p></body>" for i in range(20)]
    assert _extracted(spark, pages) == ["Site closed story 0"] + [f"story {i}" for i in range(1, 20)]
    pages = ["<body><div><p>copied</p></div></body>"] * 40 + [f"<body><div><p>own {i}</p></div><h2>more {i}</h2></body>" for i in range(3)]
    assert _extracted(spark, pages) == ["copied"] * 40 + [f"own {i} more {i}" for i in range(3)]


def test_empty_pages_and_other_layouts_have_templates_too(spark):
    """Neither pages without text nor one deviating page are the reference of all others."""
    one = [f"<body><div class=top>Welcome</div><p>story {i}</p></body>" for i in range(8)]
    two = [f"<body><section><h2>Our shop</h2><table><tr><td>item {i}</table></section></body>" for i in range(8)]
    odd = ["", "<body></body>", "<body><pre>odd</pre></body>"]
    assert _extracted(spark, odd + one + two) == ["", "", "odd"] + [f"story {i}" for i in range(8)] + [f"item {i}" for i in range(8)]


def test_pages_of_rare_layouts_share_a_coarser_one(spark):
    extra = ["", "<h2>a</h2>", "<pre>b</pre>", "<ul><li>c</ul>", "<dl><dt>d</dl>", "<h3>e</h3>"]
    pages = [f"<body><div class=top>Welcome</div><div class=m><p>story {i}</p>{x}</div></body>" for i, x in enumerate(extra)]
    assert _extracted(spark, pages) == [f"story {i}" + f" {' abcde'[i]}".rstrip() for i in range(6)]


def test_given_pages_against_plain_cutting(spark):
    pages = spark.read.parquet(f"{SMALL_SF}/pages.parquet")
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    import html as entities
    for r in html.extract(pages).collect():
        inner = re.search(r"<article>(.*?)</article>", source[r["page_id"]], re.DOTALL)[1]
        expected = " ".join(" ".join(entities.unescape(x).split()) for x in re.split(r"</?(?:p|h1|br)>", inner.replace("<b>", "").replace("</b>", "")))
        assert r["text"] == " ".join(expected.split())


def test_simple_tree_matching_counts_nodes():
    a, b = (html.reduced(html.parse(t)) for t in ("<div><p>x</p><ul><li>a<li>b</ul></div>", "<div><h1>n</h1><p>y</p><ul><li>c</ul></div>"))
    n, pairs = html.matching(a, b)
    assert n == len(pairs) == 5 and {p.kind for p, _ in pairs} == {"#", "div.", "p.", "ul.", "li."}


def test_very_many_kinds_of_siblings_and_deep_pages():
    a, b = (html.reduced(html.parse("".join(f"<p class='{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}'>x</p>" for i in range(k, 2000 + k)))) for k in (0, 5))
    n, pairs = html.matching(a, b)
    assert n == len(pairs) == 1996
    assert html.blocks(html.parse("<div>" * 20_000 + "deep"))[0][2] == "deep"
    assert html.reduced(html.parse("<p class=a1>x<p class=a2>y")).children[0].kind == "p.a0"


def _most(a, b):
    """Simple tree matching by definition."""
    if a.kind != b.kind:
        return 0
    best = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
    for i, c in enumerate(a.children):
        for j, d in enumerate(b.children):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + _most(c, d))
    return best[-1][-1] + 1


def test_matching_is_the_largest():
    rng = random.Random(7)

    def made(depth):
        return "".join(f"<div class={rng.choice('abc')}>{made(depth - 1) if depth and rng.random() < 0.7 else 'x'}</div>" for _ in range(rng.randint(1, 5)))

    for _ in range(60):
        a, b = (html.reduced(html.parse(made(4))) for _ in range(2))
        n, pairs = html.matching(a, b)
        assert n == len(pairs) == _most(a, b) and all(c.kind == d.kind for c, d in pairs)
        assert len({id(c) for c, _ in pairs}) == len({id(d) for _, d in pairs}) == n


def test_wide_and_deep_pages_are_matched_whole():
    wide = "".join(f"<p class='{chr(97 + i % 26)}{chr(97 + i // 26)}'>x</p>" for i in range(650))
    a, b = (html.reduced(html.parse(t)) for t in (f"{wide}<p class=late>y</p>", f"<p class=late>y</p>{wide}"))
    assert html.matching(a, b)[0] == 651
    a, b = (html.reduced(html.parse("<div>" * 5000 + f"<p>{k}</p>{k * '<hr>'}")) for k in (1, 2))
    assert html.matching(a, b)[0] == 5003
    a, b = (html.reduced(html.parse("<div>" * 5000 + f"<p>1</p>{x}")) for x in ("<h1>t", "<h2>t"))
    assert html.matching(a, b)[0] == 5002


def test_ends_of_tags_against_their_definition():
    quoted = re.compile(r"((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>")
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice("<<aab >\"'/=") for _ in range(rng.randint(1, 30)))
        ends = html._Ends(text)
        for m in re.finditer("<(?=[a-z])", text):
            name = re.compile(r"[^\s>/]*").match(text, m.end()).end()
            whole = quoted.match(text, name)
            assert ends.of(m.end()) == ((name, whole.end() - 1) if whole else None), text


@pytest.mark.parametrize("broken", ["<a '", '<a "', "<a", "<a ", "<a 'x\"", "<", "</", "<!--", "<a b='", "<p x=\">"])
def test_large_broken_pages_take_linear_time(broken):
    import time
    start = time.process_time()
    html.parse(broken * (1_000_000 // len(broken)))
    assert time.process_time() - start < 12


def test_a_page_of_boilerplate_alone_has_no_text(spark):
    pages = [f"<body><div class=top>Welcome</div>{f'<p>story {i}</p>' if i else ''}<div class=end>All the best</div></body>" for i in range(13)]
    assert _extracted(spark, pages) == [""] + [f"story {i}" for i in range(1, 13)]


def test_equal_siblings_far_apart_are_one_group():
    kinds = "".join(f"<h{i % 6 + 1} class={chr(97 + i)}>x</h{i % 6 + 1}>" for i in range(12))
    tree = html.reduced(html.parse(f"<div class=row>a</div>{kinds}<div class=row>b</div>"))
    assert [len(c.members) for c in tree.children if c.kind == "div.row"] == [2]


def test_empty_table(spark):
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_an_ordinary_page_is_walked_once(monkeypatch):
    """Start tags without "<" in a value need no search of their ends, equal ones are described
    once, and the blocks of a page are listed once for its article, its tree and its hash."""
    monkeypatch.setattr(html, "_Ends", lambda text: pytest.fail("searched"))
    text = page("<article><h1 class='a1'>t</h1>" + "".join(f"<p class='x' id=\"y\">story {i}</p><br/>" for i in range(50)) + "</article><p>out</p>")
    reference = html.reduced(html.parse(text))
    html._described.cache_clear()
    calls, blocks = [], html.blocks
    monkeypatch.setattr(html, "blocks", lambda *a: calls.append(a) or blocks(*a))
    parts, _, _ = html.aligned(text, reference, html.numbered(reference))
    assert [t for _, _, t in parts] == ["t"] + [f"story {i}" for i in range(50)]
    assert len(calls) == 1 and html._described.cache_info().misses < 20


def test_start_tags_against_their_definition():
    whole = re.compile(r"<([a-z][^\s>/]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>")
    rng = random.Random(5)
    tokens = ["<", ">", " ", "/", "b", "=", "'", '"', " class='c1'", ' class="d>"', " class='<'", ' id="nav"', " hidden", "\n"]
    for _ in range(5000):
        text = "<a" + "".join(rng.choice(tokens) for _ in range(rng.randint(0, 9)))
        m, first = whole.match(text), html.parse(text).children[0]
        if m:
            assert (first.tag, first.kind, first.skipped) == (m[1], *html._described(m[1], m[2])), text
        else:
            assert first == "<", text


@pytest.mark.parametrize("broken", ["<a b='<", "<a b=\"<p>", "</ ", "<a\"", "<!", "<![CDATA[", "<p class='x' ", "&amp"])
def test_other_large_broken_pages_take_linear_time(broken):
    import time
    start = time.process_time()
    html.parse(broken * (1_000_000 // len(broken)))
    assert time.process_time() - start < 12


def test_what_holds_a_block():
    """Blocks of articles alone are the main text, those of main only where no article is."""
    def found(text):
        reference = html.reduced(html.parse(text))
        return [t for _, _, t in html.aligned(text, reference, html.numbered(reference))[0]]

    assert found("<p>a<main>b<article>c<main>d</main></article>e</main>f") == ["c", "d"]
    assert found("<p>a</p><main>b<p>c</p>d<aside><article>x</article></aside></main>e") == ["b", "c", "d"]
    assert found("<b>a<article>b</article>c</b>") == ["b"] and found("<main>a<article></article></main>") == []
    assert found("a<p>b") == ["a", "b"]


def test_lists_are_made_of_flat_columns():
    import pyarrow as pa
    types = {"place": pa.int32(), "text": pa.string()}
    for rows in ([], [[]], [[(1, "a"), (2, "é")], [], [(-1, "")]]):
        expected = [[dict(zip(types, x)) for x in row] for row in rows]
        assert html._lists(rows, types).to_pylist() == expected
        assert html._lists(rows, types).type == pa.list_(pa.struct(list(types.items())))
