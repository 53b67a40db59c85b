import html
import re

import pytest

from taskspire.llm import html_extraction as H


@pytest.fixture(scope="module")
def model():
    return H.train()


def test_parse():
    p = H.parse('<html><head><title>T</title></head><body><p>One <b>two</b><p>three &amp; four<br>five<ul><li>a<li>b</ul><script>x="</p>"</script><!-- c -->tail</body>')
    assert p.block_text == ["T", "One two", "three & four five", "a", "b", "tail"]
    assert H.parse("").block_text == [] and H.parse("plain text").block_text == ["plain text"] and H.parse("a < b <div>c").block_text[-1] == "c"
    assert H.parse('<p class="x>y" id=z>q</p>').block_text == ["q"] and H.parse("<style>p{}</style><textarea>no</textarea>yes").block_text == ["yes"]


@pytest.mark.parametrize(
    "page, blocks",
    [
        ("<p title=it's>hello</p>", ["hello"]),
        ("<p class=\"a\"b'>two</p><p>three's</p>", ["two", "three's"]),
        ("<p>a</p>< 5 apples", ["a", "< 5 apples"]),
        ("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds <svg><text>here</text></svg></p>", ["so x=2 holds here"]),
        ("<p>a<b", ["a"]),
        ("<p a='x>y' b=\"'>\" c=d>q</p>", ["q"]),
        ("<scripty>a</scripty><script src='x>y'>no</script >b", ["a", "b"]),
    ],
)
def test_grammar(page, blocks):
    assert H.parse(page).block_text == blocks


def test_features_of_many_children():
    """A node's features tell of all of its children, however many."""
    rows = [H.features(H.parse("<div>" + "<p>some text</p>" * n + '<p class="ad">x</p></div>'), {"ad": -3.0}) for n in (10, 49, 50, 200)]
    least, mean = H.FEATURES.index("child_token_least"), H.FEATURES.index("siblings_chars")
    for n, x in zip((10, 49, 50, 200), rows, strict=True):
        assert x[1, least] == -3.0 and abs(x[2, mean] - H.math.log1p((9 * n + 1) / (n + 1))) < 1e-5


def test_clashing_columns(spark, model):
    pages = spark.createDataFrame([(1, "u", "<article><p>a text of some words, as it is. And more of it, too.</p></article>", "clash", 7)], "page_id long, url string, html string, text string, n_chars int")
    got = H.extract(pages, model)
    assert got.columns == ["page_id", "url", "text", "n_chars"] and got.first()["n_chars"] == len(got.first()["text"])


def test_decoding_is_consistent():
    p = H.parse("<div><p>a</p><p>b</p></div><nav><p>c</p></nav>")
    blocks, nodes = H.decode(p, [1.0, 1.0, 2.0, -3.0, -5.0, 3.0])
    assert blocks == [True, False, False] and all(not nodes[i] or nodes[p.parent[i]] for i in range(1, len(nodes)))


def test_held_out_pages(model):
    good = total = kept = 0
    for source in H.training_pages(200, seed=77):
        want = [t.replace(H.KEEP, "") for t in H.parse(source).block_text if H.KEEP in t]
        got = model.texts([source.replace(H.KEEP, "")])[0].split("\n")
        a, b = set(want), set(got)
        good, total, kept = good + len(a & b), total + len(a), kept + len(b)
    assert good / total > 0.95 and good / kept > 0.95


def test_test_pages(spark, model):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    texts = model.texts([r["html"] for r in rows])
    for r, got in zip(rows, texts, strict=True):
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:h1|h2|p|ul|li|div)[^>]*>", article)]
        assert got == "\n".join(b for b in blocks if b), r["page_id"]


def test_odd_pages(spark, model):
    rows = [(1, "u", None), (2, "u", ""), (3, "u", "<"), (4, None, "<div>" * 3000 + "x"), (5, "u", "<p>" + "word " * 50000 + "</p>"), (5, "u", "&#x110000; &bogus; &amp")]
    got = H.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), model).collect()
    assert len(got) == 6 and all(x["n_chars"] == len(x["text"]) for x in got) and {x["page_id"]: x["text"] for x in got}[1] == ""
    assert H.extract(spark.createDataFrame([], "page_id long, url string, html string"), model).count() == 0
