"""Token files, token counts, languages, HTML and URLs."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from vitalgrid.llm import html_text, lang_profiles, token_blocks, token_counts, url_rules
from vitalgrid.session import scratch_path

tokenizers = pytest.importorskip("tokenizers")


@given(st.lists(st.integers(0, 2**32 - 1), max_size=700) | st.lists(st.integers(0, 300), max_size=700))
def test_blocks_round_trip(ids):
    ids = np.array(ids, np.uint32)
    starts, payload = token_blocks.encode_blocks(ids)
    assert (token_blocks.decode_blocks(starts, payload, len(ids)) == ids).all()


def test_outliers_do_not_widen_a_block():
    ids = np.arange(256, dtype=np.uint32) % 16
    narrow = len(token_blocks.encode_blocks(ids)[1])
    ids[:5] = 2**31
    assert len(token_blocks.encode_blocks(ids)[1]) == narrow + 5 * 6


def test_token_files_equal_the_library(spark, docs, texts):
    encode = tokenizers.Tokenizer.from_file(token_blocks.tokenizer_path()).encode
    found = {r["doc_id"]: r for r in token_blocks.token_digest(docs, scratch_path(spark, "tokens")).collect()}
    start = 0
    for i in sorted(texts):
        ids = [*encode(texts[i] or "", add_special_tokens=False).ids, token_blocks.END_ID]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (found[i]["start"], found[i]["n_tokens"], found[i]["ids_crc32"]) == (start, len(ids), crc)
        start += len(ids)


def test_token_files_of_odd_rows(spark, odd_docs, no_docs):
    rows = token_blocks.token_digest(odd_docs, scratch_path(spark, "tokens")).orderBy("start").collect()
    assert len(rows) == odd_docs.count()
    ids = [r["doc_id"] for r in rows]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    assert [r["start"] for r in rows] == np.cumsum([0, *(r["n_tokens"] for r in rows)])[:-1].tolist()
    assert token_blocks.token_digest(no_docs, scratch_path(spark, "tokens")).count() == 0


ODD = ["a<|endoftext|>b <|endoftext|> c", "x  y  \n\nz", "\x1c\x1dq\x85z 12.5e3 \U0001f600x", "don't's 's 'S  \n\n  tab\t\tq ",
       "aaaaaaaaaaaaaaaaaaaaaaaaaa " * 3, "\u3000\u3000a  ", "\x0b\x0c x\x1f y", "a" * 3000, "abab" * 700, "\u00a0 \u00a0\n\nx"]


@settings(deadline=None, max_examples=200)
@given(st.lists(st.text(alphabet="ab' \n\t\u00a0\u3000é1.,<|>x", max_size=30) | st.sampled_from(ODD), min_size=1, max_size=5))
def test_counts_equal_the_library(texts):
    encode = _library(token_counts.tokenizer_path()).encode
    table = token_counts._table(token_counts.tokenizer_path())
    found = []
    for _, _, data, starts in token_counts.text_slices(pa.array(texts)):
        found += token_counts.slice_counts(table, data, starts).tolist()
    assert found == [len(encode(t, add_special_tokens=False).ids) for t in texts]


@settings(deadline=None, max_examples=100)
@given(st.lists(st.text(alphabet="aB' \n\t\u00a0éÉ\u03a3\u03c31.,<|>x", max_size=30) | st.sampled_from(ODD), min_size=1, max_size=5))
def test_word_encoder_equals_the_library(texts):
    path = token_blocks.tokenizer_path()
    encode = _library(path).encode
    found = []
    for _, ids, counts in token_blocks._encoder(path).slices(pa.array(texts)):
        ends = np.cumsum(counts)
        found += [ids[e - n : e].tolist() for e, n in zip(ends, counts)]
    assert found == [encode(t, add_special_tokens=False).ids for t in texts]


_LIBRARY = {}


def _library(path):
    if path not in _LIBRARY:
        _LIBRARY[path] = tokenizers.Tokenizer.from_file(path)
    return _LIBRARY[path]


def test_token_counts(docs, odd_docs, no_docs, texts):
    encode = _library(token_counts.tokenizer_path()).encode
    for r in token_counts.token_counts(docs).collect():
        text = texts[r["doc_id"]] or ""
        n = len(encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 1024)
    assert token_counts.token_counts(odd_docs).count() == odd_docs.count()
    assert token_counts.token_counts(no_docs).count() == 0


def test_languages_of_held_out_documents(spark):
    words = {"en": "the house of a man is his", "de": "das haus von einem mann ist sein", "fr": "la maison d'un homme est sa"}
    rows = [(i, " ".join(np.random.default_rng(i).permutation(words[lang].split())), lang) for i in range(200) for lang in [list(words)[i % 3]]]
    rows += [(900, None, "en"), (901, "12 34 !", "de"), (None, words["fr"], None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs = {i: lang for i, _, lang in rows}
    found = lang_profiles.identify(table).collect()
    assert {r["doc_id"] for r in found if r["held_out"]} == {
        i for i, _, _ in rows if i is not None and zlib.crc32(str(i).encode()) % 4 == 2
    }
    for r in found:
        assert 0 <= r["score"] <= 1
        if r["doc_id"] in (900, 901):
            assert (r["lang_pred"], r["score"]) == ("und", 0)
        else:
            assert r["lang_pred"] == (langs[r["doc_id"]] or "fr")


def test_languages_of_odd_rows(odd_docs, no_docs, spark):
    assert lang_profiles.identify(odd_docs).count() == odd_docs.count()
    assert lang_profiles.identify(no_docs).count() == 0
    unlabeled = spark.createDataFrame([(1, "words", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[2:] for r in lang_profiles.identify(unlabeled).collect()] == [("und", 0.0)]


def test_profile_distance_by_hand(spark):
    """Ranks of one letter each: the distance is the sum of rank differences, or PROFILE per missing n-gram."""
    profiles = lang_profiles.learn(spark.createDataFrame([("x", "aaa bb"), ("y", "ccc")], "lang string, text string"))
    assert {r["lang"] for r in profiles.filter("rank = 0").collect()} == {"x", "y"}
    own = lang_profiles.most_frequent(lang_profiles.grams("aaa bb"))
    there = [r["gram"] for r in profiles.filter("lang = 'x'").orderBy("rank").collect()]
    assert own.tolist() == there


PAGE = """<!doctype html><html><head><title>T</title><style>x{}</style></head><body><h1>Head  line</h1>intro <b>bold</b>text
<p>one<p>two<br>three<ul><li>a<li>b<ol start=3><li>x<li value=9>y</ol><li>c</ul>
<table><caption>Cap</caption><tr><th>Name<th>N<tr><td>long name<td>1<tr><td>b<td colspan=2>22<td>z</table>
<div style="color:red; DISPLAY : none">no</div><div hidden>no</div><!-- no --><template>no</template><pre>  keep
   this</pre><script>var t="</p>";</script>tail &amp; &copy;<dl><dt>t<dd>d</dl>end"""
SHOWN = """Head line

intro boldtext

one

two
three

- a
- b
  3. x
  9. y
- c

Cap
Name       N
long name  1
b          22  z

  keep
   this

tail & ©

t
  d

end"""


def test_page_layout():
    assert html_text.render(PAGE) == SHOWN


@pytest.mark.parametrize("html, text", [
    (None, None), ("", ""), ("plain", "plain"), ("<p></p><div> </div>", ""), ("a</p>b", "a\n\nb"), ("<td>x<td>y", "x\n" "y"),
    ("<ul><li><p>a</p><p>b</p></ul>", "- a\n  b"), ("<table><tr><td>a<table><tr><td>in</table><td>b</table>", "a   b\nin"),
    ("<b>x<i>y</b>z</i>", "xyz"), ("<ul hidden><li>a</ul>b", "b"), ("1 < 2 & 3", "1 < 2 & 3"), ("<" * 50, "<" * 50),
])
def test_small_pages(html, text):
    assert html_text.render(html) == text


@pytest.mark.parametrize("html, text", [
    ("<html><head><title>T</title><p>Hello <b>you</b><p>there", "Hello you\n\nthere"),
    ("<head><meta charset=utf-8><link rel=x><style>s</style><script>j</script> words", "words"),
    ("<head><title>T</title><span>a</span></head>b", "ab"),
    ("<head><noscript><link></noscript><template><p>no</p></template><title>T</title><h1>a</h1>", "a"),
    ("<head>\n <title>T</title>\n</head>\n<body>a", "a"), ("<p>a</p><head><div>b</div>", "a\n\nb"),
])
def test_head_may_be_left_open(html, text):
    assert html_text.render(html) == text


@pytest.mark.parametrize("html, text", [
    ("let <math><mi>x</mi>\n <mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math> hold", "let x=1 2 hold"),
    ("<math><semantics><mi>y</mi><annotation>\\y</annotation></semantics></math>", "y"),
    ("<svg><title>no</title><defs><text>no</text></defs><rect/><text x=1>Load</text><text>Time <tspan>s</tspan></text>no</svg> b", "Load Time s b"),
    ("<svg><switch><foreignObject><div>Box</div></foreignObject><text>Box</text></switch><g display=none><text>no</text></g></svg>", "Box"),
    ("<svg><defs/><text>a</text><path d=x><p>out", "a\n\nout"), ("<math/>after", "after"), ("<svg hidden><text>a</text></svg>b", "b"),
    ("<textarea>one &amp; <b>two</b>\n  three</textarea>end", "one & <b>two</b>\n  three\nend"), ("<textarea>open", "open"),
    ("Hue <select><option>red<option selected>blue<option>tan</select>!", "Hue blue!"),
    ("<select><option disabled>no<optgroup disabled><option>no<optgroup label=g><option> a  b </select>", "a b"),
    ("<select><option selected hidden label=Pick>x<option>y</select>", "Pick"),
    ("in<select multiple><option>a<optgroup label=g><option>b</select>", "in\na\ng\nb"), ("<pre>a <select><option>b</select></pre>", "a b"),
    ("<ul><li>a<textarea>b</textarea></ul><select></select>", "- a\n  b"),
])
def test_formulas_drawings_and_forms(html, text):
    assert html_text.render(html) == text


@given(st.lists(st.sampled_from("<svg> </svg> <math> </math> <mi> <text> <textarea> </textarea> <select> <option> <optgroup> <p> <g/> <svg/> a <td> <pre>".split()), max_size=30))
@settings(deadline=None)
def test_any_foreign_page_renders(tags):
    html_text.render("".join(tags))
    html_text.render("".join(tags) * 300)


@given(st.text(alphabet="<>/!-ptdrliu&; ab\"'=[", max_size=120))
@settings(deadline=None)
def test_any_page_renders(html):
    html_text.render(html)


def test_deep_pages_render():
    assert html_text.render("<div>" * 20_000 + "deep") == "deep"
    assert html_text.render("<ul><li>" * 5_000 + "deep").endswith("deep")


def test_given_pages_keep_their_words(spark, smoke_dir):
    """On pages without hidden parts the rendered words are those of the body without its tags, in order."""
    pages = spark.read.parquet(f"{smoke_dir}/pages.parquet")
    texts = {r["page_id"]: r["text"] for r in html_text.extracted(pages).collect()}
    import html as library

    for r in pages.collect():
        body = regex.sub(r"(?s)<head>.*?</head>|<script.*?</script>|<!--.*?-->", " ", r["html"])
        body = regex.sub(r"</?(?:b|i|a|em|strong|span)\b[^>]*>", "", body)
        want = library.unescape(regex.sub(r"<[a-zA-Z/!][^>]*>", " ", body))
        assert regex.sub(r"- |\s", "", texts[r["page_id"]]) == regex.sub(r"- |\s", "", want)


def test_extracted_rows(spark):
    rows = [(1, "u", "<p>a<p>b", 1), (1, "u", "<p>a<p>b", 1), (2, None, None, 2), (None, "v", "", None)]
    found = html_text.extracted(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    assert sorted((r["page_id"] or 0, r["text"] or "", r["n_lines"]) for r in found) == [
        (0, "", 0), (1, "a\n\nb", 3), (1, "a\n\nb", 3), (2, "", 0)
    ]


def test_urls(spark):
    urls = {
        "https://A.Example.NET/en/x?q": ("a.example.net", "/en/x", "example.net/en/", "allow", None),
        "http://example.net/de/": ("example.net", "/de/", "net/", "block", None),
        "http://badexample.net": ("badexample.net", "", None, "allow", None),
        "http://x.org/fr": ("x.org", "/fr", None, "allow", None),
        "http://x.org/fr/": ("x.org", "/fr/", "org/fr/", "allow", None),
        "http://www.example.com/de/1#y": ("www.example.com", "/de/1", "example.com/de/", "block", None),
        "http://m.free-bets.example.com/en/": ("m.free-bets.example.com", "/en/", None, "block", "bets"),
        "ftp://casino.net/": ("casino.net", "/", "net/", "block", None),
        "no scheme.net/": ("", "", None, "allow", None),
        "a://b://c.net/": ("b:", "//c.net/", None, "allow", None),
        None: ("", "", None, "allow", None),
        "": ("", "", None, "allow", None),
        "http://é.net/\n": ("é.net", "/\n", "net/", "block", None),
    }
    rows = [(i, u, "x", "y") for i, u in enumerate(urls)] + [(0, next(iter(urls)), "x", "y")]
    table = spark.createDataFrame(rows, "page_id long, url string, host string, place string")
    found = url_rules.judged_urls(table).collect()
    assert len(found) == len(rows)
    for r in found:
        assert tuple(r)[1:] == (*list(urls.values())[r["page_id"]],), r
    assert url_rules.judged_urls(table.limit(0)).count() == 0


def test_rules_are_indexed_by_their_rarest_token(spark):
    rule = url_rules.Rule("r", "a-b", ("a", "b"), "block")
    places = spark.createDataFrame([("a/",), ("a/x",), ("a-b/",)], "place string")
    table = url_rules.rule_table(spark, [rule])
    assert [r["token"] for r in url_rules.index(table, places).collect()] == ["b"]
    assert [r["place"] for r in url_rules.fitting(places, table).collect()] == ["a-b/"]


@pytest.mark.parametrize("html, text", [
    # rows that cells of rows above reach into
    ("<table><tr><td rowspan=2>Alpha<td>b1<tr><td>b2<tr><td>c<td>d</table>", "Alpha  b1\n       b2\nc      d"),
    ("<table><tr><td>a<td rowspan=3>x<td>b<tr><td>c<td>d<tr><td>e</table>", "a  x  b\nc     d\ne"),
    ("<table><tr><td rowspan=2 colspan=2>w<td>1<tr><td>2</table>", "w  1\n   2"),
    ("<table><tr><td rowspan=0>r<td>1<tr><td>2<tr><td>3</table>", "r  1\n   2\n   3"),
    # wide characters take two columns
    ("<table><tr><td>日本<td>x<tr><td>abc<td>y</table>", "日本  x\nabc   y"),
    # visibility is inherited and can be declared again, display cannot
    ("<div style='visibility:hidden'>no<b style='visibility:visible'>yes</b>no</div>", "yes"),
    ("<div style='visibility:hidden'><p>no<p><i>no</i></div>yes", "yes"),
    ("<div style='display:none'><b style='display:block'>no</b></div>yes", "yes"),
    # the last declaration counts, unless one before is important
    ("<p style='display:none;display:block'>yes", "yes"), ("<p style='display:block;display:none'>no", ""),
    ("<p style='DISPLAY: none !important; display:block'>no", ""), ("<p style='color:none;displays:none'>yes", "yes"),
    ("<p hidden style='display:block'>yes", "yes"), ("<dialog style='display:block'>yes</dialog>", "yes"),
    ("<p style='x' style='display:none'>yes", "yes"),
    # closed details show their summary
    ("<details><summary>s</summary>no</details>yes", "s\nyes"), ("<details open><summary>s</summary>body</details>", "s\nbody"),
    ("<details>no<p>no</details>", ""),
])
def test_visibility_and_spans(html, text):
    assert html_text.render(html) == text


@pytest.mark.parametrize("depth", [197, 250, 600, 5000])
def test_deep_pages(depth):
    around = "<div>" * depth
    assert html_text.render(around + "<div hidden>secret</div>seen") == "seen"
    assert html_text.render(around + "<ul><li>one<li>two</ul>") == "- one\n- two"
    assert html_text.render(around + "<table><tr><td>a<td>b</table>") == "a  b"
    assert html_text.render("<b>" * depth + "x" + "</b>" * depth + "y") == "xy"
    assert html_text.render("<svg><g>" * depth + "<text>t").strip() == "t"
    assert html_text.render("<p>" * depth + "x") == "x"


def test_deep_lists_keep_every_text():
    """Beyond the depth that browsers build, items are lines without a mark; hidden ones stay hidden."""
    text = html_text.render("".join(f"<ul><li>n{i}" for i in range(1500)) + "<p hidden>secret</p><p>end")
    assert [line.strip(" -") for line in text.split("\n") if line] == [*(f"n{i}" for i in range(1500)), "end"]


def test_merging_changes_nothing(monkeypatch):
    """Pages read the same whether elements without a difference are taken up or not."""
    import random

    r = random.Random(5)
    pages = [as_html(random_tree(r)) for _ in range(200)] + [PAGE, "<div> <div><center><p>a</center></div>b <b>c<i>d</i></b></div>"]
    want = [html_text.render(p) for p in pages]
    monkeypatch.setattr(html_text, "DEPTH", 1)
    monkeypatch.setattr(html_text, "_flat", lambda node: node.children)
    assert [html_text.render(p) for p in pages] == want


def random_tree(r, depth=0):
    """A small tree as (tag, style, children), texts as strings."""
    tag = r.choice(["div", "span", "b", "section"])
    style = r.choice(["", "", "", "display:none", "visibility:hidden", "visibility:visible", "display:none;display:block"])
    inside = [f"t{r.randrange(10**6)}" if depth > 3 or r.random() < 0.4 else random_tree(r, depth + 1) for _ in range(r.randint(0, 4))]
    return tag, style, inside


def as_html(node):
    return node if isinstance(node, str) else f"<{node[0]} style='{node[1]}'>{' '.join(map(as_html, node[2]))}</{node[0]}>"


def plain_words(node, hidden=False):
    """The shown texts by the definition, one element after the other."""
    if isinstance(node, str):
        return [] if hidden else [node]
    if node[1] == "display:none":
        return []
    hidden = {"visibility:hidden": True, "visibility:visible": False}.get(node[1], hidden)
    return [w for child in node[2] for w in plain_words(child, hidden)]


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**9))
def test_shown_words_of_random_trees(seed):
    import random

    node = random_tree(random.Random(seed))
    assert html_text.render(as_html(node)).split() == plain_words(node)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(1, 3), st.integers(1, 3)), max_size=4), max_size=5))
def test_columns_of_random_tables(spans):
    """Every cell starts in the first free column of its row, by an occupancy table."""
    used, want, rows = set(), {}, []
    for i, row in enumerate(spans):
        cells = []
        for k, (wide, high) in enumerate(row):
            column = next(c for c in range(100) if (i, c) not in used)
            used |= {(i + a, column + b) for a in range(high) for b in range(wide)}
            want[f"r{i}k{k}"] = column
            cells.append(f"<td colspan={wide} rowspan={high}>r{i}k{k}")
        rows.append("<tr>" + "".join(cells))
    grid = html_text._grid([c for kind, c in html_text._rows(html_text.tree(f"<table>{''.join(rows)}</table>").children[0]) if kind == "row"])
    found = {line[0]: column for row in grid for column, line in enumerate(row) if line}
    assert found == want
