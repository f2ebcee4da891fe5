import html
import re

import numpy as np
import pytest

import corpus_pipeline
from aurum.llm import html_extract as H
from aurum.llm import labelled_pages as LP

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model(spark):
    return H.fit(spark.read.parquet(f"{SMOKE}/pages.parquet"))


def blocks(source):
    return [t for _, t in H.Page(source).texts]


@pytest.mark.parametrize("source, want", [
    ("", []), ("plain  text", ["plain text"]), ("a<b>b</b>c<br>d", ["abc d"]), ("<p>one<p>two<div>three", ["one", "two", "three"]),
    ("<script>var t='</p>';</script>x<style>p{}</style>y", ["xy"]), ("<!-- a > b -->x<!-->y", ["xy"]), ("a &lt; b &amp &copy;&#x41;&am", ["a < b & ©A&am"]),
    ("<ul><li>a<li>b</ul>c", ["a", "b", "c"]), ("<p title='>'>x</p>", ["x"]), ("1 < 2 <3", ["1 < 2 <3"]), ("<table><tr><td>a<td>b<tr><td>c", ["a", "b", "c"]),
    ("<title>t</title><textarea><p>q</textarea>z", ["z"]), ("x<script>never closed", ["x"]), ("</p></div>x", ["x"]), ("a  b\r\n\tc", ["a b c"])])
def test_blocks(source, want):
    assert blocks(source) == want


def test_messages_equal_enumeration():
    page = H.Page("<div><p>one two three.</p><ul><li>x</li></ul></div><p>four</p>")
    f = H.Forest([page])
    m = H.Model()
    rng = np.random.default_rng(3)
    m.unary, m.pair = rng.standard_normal(len(m.unary)), rng.standard_normal(m.pair.shape)
    n = len(page.tag)
    own = np.bincount(f.row, m.unary[f.feature], n)
    total, marginal = 0.0, np.zeros(n)
    for bits in range(2 ** n):
        y = [(bits >> k) & 1 for k in range(n)]
        z = np.exp(sum(own[k] * y[k] for k in range(n)) + sum(m.pair[f.kind[k], y[f.parent[k]], y[k]] for k in range(1, n)))
        total += z
        marginal += z * np.array(y)
    assert np.allclose(m.marginals(f)[0], marginal / total)


def test_accuracy_on_layouts(model, monkeypatch):
    monkeypatch.setattr(LP, "SEED", 99)  # pages that it was not trained on
    pages = [H.Page(s) for s in LP.layouts()[:150]]
    got = model.marginals(H.Forest(pages))[0] > 0.5
    want = np.concatenate([LP.labels_of(p) for p in pages]) == 1
    assert (got == want).mean() > 0.96


def test_whole_articles(spark, model):
    pages = spark.read.parquet(f"{SMOKE}/pages.parquet")
    rows = {r.page_id: r.text for r in H.extract(pages, model).collect()}
    for r in pages.collect():
        a = re.search("<article>(.*?)</article>", r.html, re.S).group(1)
        a = re.sub("<[^>]+>", " ", re.sub("</?b>", "", a))
        assert rows[r.page_id] == " ".join(html.unescape(a).split())


def test_other_layouts(model):
    page = ("<header><a href=/>Site</a></header><nav><a href=/a>A</a></nav><div class='cookie-notice'><p>We use cookies.</p></div>"
            "<main><article><h1>Title here</h1><p>First long paragraph of the article, with words. It goes on.</p><div class='ad'>Buy now.</div>"
            "<p>Second paragraph, as long as the first one was. It ends.</p></article></main><aside class='sidebar'><p>Other things to read.</p></aside>"
            "<section class='comments'><p>I disagree with this. Really.</p></section><form><p>Subscribe</p></form><footer>&copy; Site.</footer>")
    assert H.main_texts([page], model) == ["Title here First long paragraph of the article, with words. It goes on. "
                                           "Second paragraph, as long as the first one was. It ends."]


def test_odd_rows(spark, model):
    df = spark.createDataFrame([(1, "u", None, "?"), (1, "u", None, "?"), (None, None, "", "?"), (3, "v", "<div>" * 3000 + "deep", "?")],
                               "page_id long, url string, html string, text string")
    assert sorted((r.n_chars for r in H.extract(df, model).collect()))[:3] == [0, 0, 0]
    assert H.extract(df.limit(0), H.fit(df.limit(0))).count() == 0


# ---- pipeline

def test_stages(spark):
    """Every stage keeps what its plain form keeps, on a small table with planted cases."""
    from aurum.llm import pii, toxicity
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    label = spark.read.parquet(f"{SMOKE}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    index = toxicity.fit(docs, toxicity.learnable(label.select("doc_id", "toxic")), "text", "doc_id", "toxic")
    one = stages["toxicity"](spark, docs, SMOKE)
    assert one.columns == docs.columns
    fine = {r.doc_id for r in toxicity.score(docs, index).collect() if r.score < toxicity.THRESHOLD}
    assert {r.doc_id for r in one.collect()} == fine

    first = {}
    for r in docs.orderBy("doc_id").collect():
        first.setdefault(re.sub("[\x20\x09-\x0d]+", " ", r.text or ""), r.doc_id)
    two = stages["exact dedup"](spark, docs, SMOKE)
    assert two.columns == docs.columns and {r.doc_id for r in two.collect()} == set(first.values())

    three = stages["n-gram Jaccard join"](spark, two, SMOKE)
    left = [(r.doc_id, r.text) for r in two.collect()]
    from test_ngram_join import brute
    assert {r.doc_id for r in three.collect()} == {c for _, _, c in brute(left, 5, 80)}

    four = stages["pii"](spark, three, SMOKE)
    assert four.columns == docs.columns
    assert all(not pii.base_spans(r.text or "") for r in four.collect())


def test_run(spark):
    out = corpus_pipeline.run(spark, SMOKE)
    size = {}
    for r in out.collect():
        size[r.sequence_id] = max(size.get(r.sequence_id, 0), r.offset + r.length)
    assert size and max(size.values()) <= 2048


def test_empty_table_passes_through(spark, scratch):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").limit(0)
    docs.write.parquet(f"{scratch}/documents.parquet")
    spark.read.parquet(f"{SMOKE}/labels.parquet").write.parquet(f"{scratch}/labels.parquet")
    assert corpus_pipeline.run(spark, scratch).count() == 0


def test_embedded_content_of_the_article_stays():
    from aurum.llm.html_extract import Page
    source = ("<article><p>The sum <math><mi>x</mi></math> is <svg><title>no</title><text>small</text></svg>.</p><noscript><p>Plain para.</p></noscript>"
              "<object><p>An object.</p></object><select><option>no</option></select><style>no</style><template>no</template></article>")
    assert [t for _, t in Page(source).texts] == ["The sum x is small .".replace(" .", "."), "Plain para.", "An object."]


def test_deep_and_unclosed_pages_take_linear_time():
    import time

    from aurum.llm.html_extract import Page
    for source in ("<div>" * 20_000 + "</b1></p>" * 20_000, "<div>" * 20_000 + "<li></li><td></td>" * 10_000, "<select>" * 30_000, "<div>" * 20_000 + "<body></body>" * 20_000):
        t = time.process_time()
        Page(source)
        assert time.process_time() - t < 10


def test_near_copies_without_or_with_repeated_ids_leave_one(spark):
    rows = [(None, f"{'one two three four five six seven eight nine ten ' * 6}x{i}") for i in range(6)]
    rows += [(7, f"{'red green blue black white grey brown pink gold teal ' * 6}y{i}") for i in range(6)] + [(9, "alone here"), (None, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, "?", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, __row string, id int")
    stage = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"]
    out = stage(spark, docs, SMOKE)
    assert out.columns == docs.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == ["7", "9", "None", "None", "None"]
