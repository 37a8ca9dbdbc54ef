import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lumenfield.llm import fingerprint, html_extract, language_id, queries
from tests.llm.data import AWKWARD, awkward, empty, sparse, written


def plain_grams(text):
    total = Counter()
    for w in re.findall(r"[^\W\d_]+", (text or "").lower()):
        padded = f" {w} "
        total.update(w)
        total.update(padded[i : i + 2] for i in range(len(padded) - 1))
        total.update(padded[i : i + 3] for i in range(len(padded) - 2))
    return total


def spell(code):
    out = []
    while code:
        out.append(code & 0x1FFFFF)
        code >>= 21
    return out[::-1]


def test_ngrams_equal_the_plain_count():
    for text in ["Hello, hello world! 12 a", "é", "ab  cd\nef", "x" * 30 + " über-maß"]:
        found, n = language_id.counted(text)
        got = {tuple(spell(int(c))): int(k) for c, k in zip(found, n)}
        want = Counter()
        for g, k in plain_grams(text).items():
            want[tuple(1 if c == " " else ord(c) for c in g)] += k
        assert got == want


def test_blocks_give_the_same_counts(monkeypatch):
    text = "some words, in a longer text with several of them " * 20
    whole = language_id.counted(text)
    monkeypatch.setattr(language_id, "BLOCK", 37)
    parts = language_id.counted(text)
    assert all((a == b).all() for a, b in zip(whole, parts))


def test_a_word_longer_than_a_block(monkeypatch, spark):
    """Cut anywhere, each n-gram comes once, in predictions and in profiles; nothing grows with the word."""
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdé") for _ in range(n)) for n in (1, 2, 3, 9, 10, 11, 19, 20, 21, 40, 200)]
    texts += [f"a bb {x} c{x}, {x}" for x in texts] + ["ab İİİİİİİİİİİİİİİİİİİİİİ " * 3, " " * 50 + "x" * 50 + " " * 50]
    whole = [language_id.counted(t) for t in texts]
    one = [x for x in language_id.gram_counts(iter([pd.DataFrame({"lang": ["l"] * len(texts), "text": texts})]))]
    sums = pd.concat(one).groupby("gram").n.sum()
    for size in (5, 10, 16):
        monkeypatch.setattr(language_id, "BLOCK", size)
        assert all(len(b) <= 2 * size for t in texts for b, *_ in language_id.blocks(t))
        assert all("".join(b for b, *_ in language_id.blocks(t)) == t for t in texts)
        for t, (found, n) in zip(texts, whole):
            g, k = language_id.counted(t)
            assert g.tolist() == found.tolist() and k.tolist() == n.tolist(), t
        parts = pd.concat(list(language_id.gram_counts(iter([pd.DataFrame({"lang": ["l"] * len(texts), "text": texts})]))))
        assert parts.groupby("gram").n.sum().to_dict() == sums.to_dict()


def test_language_held_out(spark):
    d = "/root/testdata/sf0.01"
    rows = queries.op3_language(spark, d).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) > 0.97


def test_profiles_equal_the_plain_ranks(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    profiles = language_id.fit_profiles(docs)
    total: dict = {}
    for r in docs.collect():
        total.setdefault(r.lang, Counter()).update(plain_grams(r.text))
    code = lambda g: int(sum((1 if c == " " else ord(c)) << 21 * (len(g) - 1 - i) for i, c in enumerate(g)))
    for lang, own in profiles.items():
        merged = Counter()
        for g, n in total[lang].items():
            merged[code(g)] += n
        assert own.tolist() == [g for g, _ in sorted(merged.items(), key=lambda x: (-x[1], x[0]))[: language_id.TOP]]


def test_language_awkward(spark):
    profiles = language_id.fit_profiles(awkward(spark))
    rows = language_id.predict(awkward(spark), profiles).collect()
    assert len(rows) == len(AWKWARD)
    assert {r.lang_pred for r in rows if r.doc_id in (3, 4, 5)} == {"und"}
    assert all(r.lang_pred == "und" for r in language_id.predict(awkward(spark), {}).collect())
    assert language_id.predict(empty(spark), language_id.fit_profiles(empty(spark))).collect() == []
    spread = language_id.predict(sparse(spark), language_id.fit_profiles(sparse(spark))).collect()
    assert sorted((str(r.doc_id), r.lang_pred, r.score) for r in spread) == sorted((str(r.doc_id), r.lang_pred, r.score) for r in rows)
    only = language_id.fit_profiles(spark.createDataFrame([("en", "12 34"), ("fr", "un")], "lang string, text string"))
    assert set(only) == {"fr"}


def test_op8_against_plain_successors(spark, sf_dir):
    docs = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()), reverse=True)
    rows = {r.doc_id: r for r in queries.op8_fingerprint(spark, sf_dir).collect()}
    assert len(rows) == len(docs)
    for (i, text), (_, following) in zip(docs, docs[1:] + docs[:1]):
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        r, fp = rows[i], fingerprint.fingerprint(text)
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (fp.tobytes().hex(), fingerprint.fingerprint(new).tobytes().hex())
        assert abs(r.near_next - fingerprint.likeness(fp, fingerprint.fingerprint(following))) < 1e-12
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
    assert np.mean([r.near_edited > r.near_next for r in rows.values()]) > 0.8


def test_multiset_hash():
    a, b = "one\ntwo\nthree\ntwo", "two\nthree\ntwo\none"
    fp = fingerprint.fingerprint
    assert (fp(a) == fp(b)).all() and not (fp(a) == fp("one\ntwo\nthree")).all()
    assert (fingerprint.insert(fp("one\ntwo"), "three") == fp("one\ntwo\nthree")).all()
    assert (fingerprint.delete(fp(a), "two") == fp("one\nthree\ntwo")).all()
    for n in (20, 500, 5000):
        lines = [f"line {i}" for i in range(n)]
        half = lines[: n // 2] + [f"other {i}" for i in range(n - n // 2)]
        assert abs(fingerprint.likeness(fp("\n".join(lines)), fp("\n".join(half))) - 1 / 3) < 0.15
        assert fingerprint.likeness(fp("\n".join(lines)), fp("\n".join(x.upper() for x in lines))) < 0.1


def test_likeness_counts_repeats_and_large_texts():
    fp = fingerprint.fingerprint

    def exact(a, b):
        a, b = Counter(fingerprint.passages(a)), Counter(fingerprint.passages(b))
        return (a & b).total() / (a | b).total()

    def close(a, b):
        return abs(fingerprint.likeness(fp(a), fp(b)) - exact(a, b)) < 0.15

    many = "\n".join(["again and again"] * 300)
    assert close(many, "something\nelse") and close(many, "\n".join(["another"] * 300)) and close(many, "\n".join(["again and again"] * 100))
    assert fingerprint.likeness(fp("\n".join(["a"] * 256)), fp("\n".join(["b"] * 256))) == 0
    mixed = "\n".join(f"line {i % 7}" for i in range(500))
    assert close(mixed, "\n".join(f"line {i % 5}" for i in range(500))) and close(mixed, "\n".join(f"row {i % 7}" for i in range(90)))
    large = "\n".join(f"line {i}" for i in range(120_000))
    assert close(large, large.replace("line", "row")) and close(large, "\n".join(f"line {i}" for i in range(60_000, 180_000)))
    assert (fingerprint.insert(fp(many), "again and again") == fp(many + "\nagain and again")).all()


def test_op8_near_next_against_exact_multisets(spark, sf_dir):
    docs = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()), reverse=True)
    rows = {r.doc_id: r.near_next for r in queries.op8_fingerprint(spark, sf_dir).collect()}
    off = []
    for (i, text), (_, following) in zip(docs, docs[1:] + docs[:1]):
        a, b = Counter(fingerprint.passages(text)), Counter(fingerprint.passages(following))
        off.append(abs(rows[i] - (a & b).total() / (a | b).total()))
    assert max(off) < 0.3 and np.mean(np.array(off) > 0.1) < 0.03


def test_op8_awkward(spark):
    order = sorted(AWKWARD, key=lambda x: (x[0] is None, -(x[0] or 0), x[1] or ""))
    rows = fingerprint.compare_next(awkward(spark)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((x[0] is None, x[0] or 0) for x in order)
    got = sorted((str(r.doc_id), r.edited_sha256) for r in rows)
    want = []
    for x, y in zip(order, order[1:] + order[:1]):
        want.append((str(x[0]), hashlib.sha256(fingerprint.edited(x[1] or "", y[1] or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert fingerprint.compare_next(empty(spark)).collect() == []
    assert sorted((str(r.doc_id), r.edited_sha256) for r in fingerprint.compare_next(sparse(spark)).collect()) == sorted(want)
    one = fingerprint.compare_next(awkward(spark).filter("doc_id = 8")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_op8_rows_of_one_id_fill_several_tasks(spark):
    """The order of rows of one id is by a hash of the text; every row but the last is followed by the next of them, whatever task holds it."""
    texts = [f"text number {i} of those without an id" for i in range(3000)]
    df = spark.createDataFrame([(None, t) for t in texts] + [(4, t + "!") for t in texts] + [(9, "one"), (1, "two")], "doc_id long, text string")
    sizes = fingerprint.with_next(df, 8).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 6 and max(r["count"] for r in sizes) < 2400
    hashed = df.withColumn("h", F.xxhash64("text")).collect()
    order = sorted(hashed, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h), reverse=True)
    want = sorted((str(x.doc_id), hashlib.sha256(fingerprint.edited(x.text, y.text).encode()).hexdigest()) for x, y in zip(order, order[1:] + order[:1]))
    assert sorted((str(r.doc_id), r.edited_sha256) for r in fingerprint.compare_next(df).collect()) == want


ARTICLE = "<h1>The &amp; title</h1><p>First  <b>bold</b> part<br>with a&nbsp;break<p>Second &lt;x&gt; part that is somewhat longer than the first one.</p>"
TEXT = "The & title First bold part with a break Second <x> part that is somewhat longer than the first one."
PAGES = [
    f"<html><head><title>t</title><script>var a='</p>';</script></head><body><nav><ul><li><a href=x>menu</a></ul></nav><article>{ARTICLE}</article><footer>f</footer>",
    f"<body><header class=top><h1>Site</h1></header><div id=wrap><div class='sidebar left'>side bar words</div><main>{ARTICLE}<section class='comments'><p>reader says</p></section></main></div></body>",
    f"<body><div class=cookie-notice>We use cookies</div><div class='post-content'>{ARTICLE}<form>mail <input name=q></form><div class=ad>buy</div></div><aside>more</aside>",
    f"<!-- <article>no</article> --><div class=entry-12><style>p{{}}</style>{ARTICLE}<noscript>no script</noscript></div><div id='comments'>words of readers</div><ul class='related-posts'><li>other</ul>",
]


def test_names():
    clutter = "sidebar left-sidebar comments comment-list post-comments comment-body cookie-notice cookieBanner ad ad-slot top-ad ad0 site-header nav mainNav share-buttons related-posts newsletter-signup footer-content widget2"
    article = "article post-content entry has-sidebar content-sidebar-wrap story-12 article-header headline shared-text notices-of-text2x badge loaded"
    assert [n for n in clutter.split() if not html_extract.names_clutter(n, False)] == []
    assert [n for n in article.split() if html_extract.names_clutter(n, True)] == ["notices-of-text2x"]


@pytest.mark.parametrize("page", PAGES)
def test_one_page(page):
    assert html_extract.extract_page(page, None)[0] == TEXT


def test_consensus_path_wins(spark):
    rows = [(i, f"http://h.example/{i}", f"<body><div class=story-{i}><p>text of story {i}</p></div><div class=rail><p>rail rail</p></div></body>") for i in range(20)]
    rows.append((99, "http://h.example/odd", "<body><div class=story-99><p>tiny</p></div><div class=rail><p>" + "long rail words " * 30 + "</p></div></body>"))
    out = {r.page_id: r for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out[99].text == "tiny" and out[99].path.endswith("div.story-#") and out[3].text == "text of story 3"


def test_pages_of_the_table(spark, sf_dir):
    rows = queries.op4_html(spark, sf_dir).collect()
    for r, p in zip(sorted(rows), sorted(spark.read.parquet(f"{sf_dir}/pages.parquet").collect())):
        import html

        inner = re.search(r"<article>(.*?)(?:</article>|$)", p.html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"</?(?:p|h1|br)[^>]*>", " ", inner).replace("<b>", "").replace("</b>", "")).split())
        assert (r.page_id, r.text, r.n_chars) == (p.page_id, want, len(want))


def test_pages_awkward(spark):
    rows = [(1, None, None), (2, "no url", ""), (3, "http://x.example/", "<"), (4, None, "plain words"), (4, None, "plain words"), (None, "http://x.example", "<p>a<p>b" * 2000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS path", "3 AS host")
    out = html_extract.extract(df).collect()
    assert len(out) == 6
    by = {r.page_id: r.text for r in out}
    assert by[1] == by[2] == "" and by[4] == "plain words" and by[None].startswith("a b a b")
    assert html_extract.extract(written(df.filter("false"), 3)).collect() == []
    assert sorted((str(r.page_id), r.text) for r in html_extract.extract(written(df, 30)).collect()) == sorted((str(r.page_id), r.text) for r in out)


def test_references_do_not_reach_across_tags():
    read = lambda page: html_extract.extract_page(page, None)[0]
    assert read("<p>A &am<b>p;</b> B &amp; C &l<!-- -->t; D &lt; E</p>") == "A &amp; B & C &lt; D < E"


def test_prose_of_an_article_is_no_clutter_by_a_part_of_its_name():
    page = '<article><p class="notice-period">one</p><p class="notice">two</p><h2 class="social-media">three</h2><li id="related-work">four</li><div class="social-links">five</div><blockquote class="ad">six</blockquote></article><p class="social-media">seven</p>'
    assert html_extract.extract_page(page, None)[0] == "one three four"


def test_lead_before_the_container():
    body = " ".join(["A body of some length, with words."] * 9)
    page = f'<body><p>Not this.</p><div class="wrap"><p>The lead.</p><blockquote>And a quote.</blockquote><div>Not this either.</div><p class="cookie">No.</p><article><h1>Title</h1><p>{body}</p></article><p>Nor this.</p></div></body>'
    assert html_extract.extract_page(page, None) == (f"The lead. And a quote. Title {body}", "body>div.wrap>article")
    plain = f"<body><p>Not this.</p><article><p>{body}</p></article></body>"
    assert html_extract.extract_page(plain, None)[0] == body


def test_quotes_that_open_nothing_end_with_their_tag():
    read = lambda page: html_extract.extract_page(page, None)[0]
    assert read("<p title=\"it's>first</p><p>second</p>") == "first second"
    assert read("<p class=a don't>text</p><p>it's</p>") == "text it's"
    assert read("<p title=\"a>b\" lang='c>d' x = \"e>f\">first</p>") == "first"
    assert read("<p title='a") == ""
    assert read("<p a='>" * 5001 + "x") == "x"


def test_half_kept_texts_share_passages():
    """Whatever follows, the first half of a text of 100 characters or more keeps a passage whole."""
    rng = random.Random(3)
    letters = ["a", "e", "n", "r", "é", "😀", "d", " ", " ", ". ", "\n", "-", "x" * 30]
    seen = []
    for _ in range(600):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(60, 400)))[: rng.randrange(100, 600)]
        other = "".join(rng.choice(letters[6:] if rng.random() < 0.5 else letters) for _ in range(300))
        assert "\n".join("".join(fingerprint.passages(x)) for x in text.split("\n")) == text
        assert all(len(p) <= 49 for p in fingerprint.passages(text))
        if len(text) >= 100:
            new = fingerprint.edited(text, other)
            assert (Counter(fingerprint.passages(text)) & Counter(fingerprint.passages(new))).total() > 0
            seen.append(fingerprint.likeness(fingerprint.fingerprint(text), fingerprint.fingerprint(new)) > 0)
    # an estimate of one shared passage among some may round to none
    assert np.mean(seen) > 0.95
