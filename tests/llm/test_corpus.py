"""Quality rules, mixing, language id, extraction and the pipeline."""

import collections
import html
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from martflow.llm import exact_dedup, html_extract, language_id, minhash, mixing, packing, quality
from .conftest import CLASHING, DOCS, documents, with_clashes
from .helpers import base_counts, near_components, prose, rng, words

SF = "/root/testdata/sf0.001"
SF2 = "/root/testdata/sf0.01"


def table(spark, sf=SF, name="documents"):
    return spark.read.parquet(f"{sf}/{name}.parquet")


# -- quality ----------------------------------------------------------------

def histograms(text):
    """Character classes and hashed common-word buckets, one character or word at a time."""
    classes = np.zeros(quality.CLASSES)
    for c in text:
        classes[quality.CLASS_OF[c.encode()[0]]] += 1
    m = quality.measure([text.encode()])
    return classes, m["buckets"]


def distance(p, q):
    p, q = p / max(p.sum(), 1), q / max(q.sum(), 1)
    total = 0.0
    for a, b in zip(p, q):
        m = (a + b) / 2
        total += (a * np.log2(a / m) if a else 0) / 2 + (b * np.log2(b / m) if b else 0) / 2
    return np.sqrt(max(total, 0))


def test_quality_against_brute_force(spark):
    docs = table(spark)
    rows = docs.collect()
    got = {r.doc_id: r for r in quality.quality_rules(docs).collect()}
    refs = {}
    for r in rows:
        if r.lang is not None and not base_counts(r.text)[5]:
            c, b = histograms(r.text)
            own = refs.setdefault(r.lang, [np.zeros(quality.CLASSES), collections.Counter()])
            own[0] += c
            own[1].update(b.tolist())
    tops = {}
    for lang, (c, b) in refs.items():
        order = sorted(range(quality.BUCKETS), key=lambda k: (-b[k], k))[:quality.TOP_WORDS]
        tops[lang] = (c, order, np.array([b[k] for k in order] + [sum(b.values()) - sum(b[k] for k in order)], float))
    for r in rows:
        counts = base_counts(r.text)
        g = got[r.doc_id]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) == counts
        c, b = histograms(r.text)
        by_class, by_word = [], []
        for classes, order, common in tops.values():
            own = collections.Counter(b.tolist())
            mine = np.array([own[k] for k in order] + [len(b) - sum(own[k] for k in order)], float)
            by_class.append(distance(c, classes))
            by_word.append(distance(mine, common))
        assert abs(g.class_distance - min(by_class)) < 1e-9 and abs(g.word_distance - min(by_word)) < 1e-9
        reject = (c.sum() >= quality.MIN_CHARS and min(by_class) > quality.MAX_CLASS_DISTANCE) \
            or (len(b) >= quality.MIN_WORDS and min(by_word) > quality.MAX_WORD_DISTANCE)
        assert g.kept == (not counts[5] and not reject)


def test_quality_keeps_clean_and_drops_junk(spark):
    rows = quality.quality_rules(table(spark, SF2)).join(table(spark, SF2, "labels"), "doc_id").where("n_words >= 20")
    n = {(r.quality, r.kept): r["count"] for r in rows.where("not base_failed").groupBy("quality", "kept").count().collect()}
    assert n.get((1, False), 0) <= 0.01 * n[(1, True)]
    assert n.get((0, False), 0) >= n.get((0, True), 0) * 0.8


def test_quality_edge_rows(frame):
    r = rng(4)
    texts = [None, "", " \n\n", "one", prose(r, 30), "x " * 50, "l a\nl a\n\n \nl a", prose(r, 20_000), "é&|<>#*$%" * 30,
             "a b c d e f g h " * 2, "中文 字 " * 100]
    rows = documents(texts) + [documents(texts)[4], (None, "q", None, None, None)]
    got = sorted((str(x.doc_id), x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed)
                 for x in quality.quality_rules(frame(with_clashes(rows), CLASHING)).collect())
    assert got == sorted((str(i), *base_counts(t)) for i, t, *_ in rows)
    assert quality.quality_rules(frame([], DOCS)).count() == 0
    no_lang = documents([prose(r, 60)], lang=None)
    assert [x.kept for x in quality.quality_rules(frame(no_lang, DOCS)).collect()] == [True]
    assert quality.keep_rows(frame(rows, DOCS)).columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality_junk_is_not_its_own_reference(frame):
    """Junk with a language code of its own, with or without one long text, and junk whose
    classes are near one language and whose words are near another."""
    r = rng(6)
    good = [(i, prose(r, 80, 60), "en", "s", 1) for i in range(30)]
    junk = lambda: " ".join(f"#{r.randrange(10**9)}$|" for _ in range(80))
    alone = [(100, junk(), "zz", "s", 1), (101, junk(), "zy", "s", 1)]
    docs = frame(good + alone, DOCS)
    kept = {x.doc_id: x.kept for x in quality.quality_rules(docs).collect()}
    assert all(kept[i] for i in range(30)) and not kept[100] and not kept[101]
    assert sorted(x.doc_id for x in quality.keep_rows(docs).collect()) == list(range(30))
    # one text outweighs its language of ten
    loud = [(200, " ".join(junk() for _ in range(300)), "yy", "s", 1)] + [(201 + k, prose(r, 200, 60), "yy", "s", 1) for k in range(10)]
    kept = {x.doc_id: x.kept for x in quality.quality_rules(frame(good + loud, DOCS)).collect()}
    assert not kept[200] and kept[201]
    # classes of "up", words of "en"
    upper = [(300 + k, " ".join(f"W{r.randrange(60)}QQQQ" for _ in range(80)), "up", "s", 1) for k in range(30)]
    refs = quality.references(frame(good + upper, DOCS), "text", "lang")
    mixed = (np.array(refs["en"][0]), np.array(refs["up"][1]))
    judge = quality.Judge({"a": (refs["up"][0], refs["en"][1]), "b": mixed})
    by_class, by_word, rejected = judge.judge(quality.measure([good[0][1].encode()]), [None])
    assert by_class[0] <= quality.MAX_CLASS_DISTANCE and by_word[0] <= quality.MAX_WORD_DISTANCE and rejected[0]


# -- mixing -----------------------------------------------------------------

def test_targets():
    assert mixing.targets(np.array([100, 100, 100]), np.array([1, 2, 3.0])).tolist() == [50, 100, 150]
    got = mixing.targets(np.array([10, 1000, 1]), np.array([1, 2, 3.0]))
    assert got[0] == 30 and got[2] == 3 and abs(got.sum() - 1011) < 1e-9
    assert mixing.targets(np.array([0, 0]), np.array([1, 2.0])).tolist() == [0, 0]


def test_split_tree_is_exact_and_even():
    quotas = np.array([1000, 7, 0, 310])
    got = mixing.split_tree(quotas, 13, np.random.default_rng(1))
    assert got.sum(axis=0).tolist() == quotas.tolist() and (got >= 0).all()
    assert got.sum(axis=1).max() - got.sum(axis=1).min() <= 4


def check_mix(rows, texts):
    sizes = collections.Counter()
    for _, t, s in texts:
        sizes[s] += len(words(t))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal = dict(zip(order, mixing.targets(np.array([sizes[s] for s in order]),
                                          np.array([mixing.WEIGHTS[k % 3] for k in range(len(order))]))))
    taken = collections.Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - goal[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size
        part = r.taken - r.passes * r.size
        assert 0 <= part and (part < r.size or r.size == 0)
        assert len(r.shards) >= r.passes + (part > 0) or r.size == 0
        taken[r.source] += r.taken
    for s in order:
        assert abs(taken[s] - goal[s]) <= 1


def test_mix_of_the_table(spark):
    docs = table(spark, SF2)
    rows = mixing.mix_plan(docs).collect()
    check_mix(rows, [tuple(r) for r in docs.select("doc_id", "text", "source").collect()])
    again = mixing.mix_plan(docs.repartition(5)).collect()
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again)
    assert len(rows) == docs.count()


def test_mixed_rows_are_the_plan(spark):
    docs = table(spark, SF2)
    plan = {r.doc_id: r for r in mixing.mix_plan(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    got, cut = collections.Counter(), 0
    for r in mixing.mixed_rows(docs).collect():
        got[r.doc_id] += len(words(r.text))
        assert texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
        cut += r.text != texts[r.doc_id]
    assert got == {i: r.taken for i, r in plan.items() if r.taken}
    assert cut <= docs.select("source").distinct().count()


def test_mix_edge_rows(frame):
    r = rng(6)
    rows = documents([None, "", "a b", "a b", prose(r, 5000)], source="big") + \
        [(10, "x y z", "en", None, 5), (11, None, "en", "empty", 0), (None, "q w", "en", "big", 3), (3, "a b", "en", "big", 3)]
    docs = frame(with_clashes(rows), CLASHING)
    got = mixing.mix_plan(docs).collect()
    assert len(got) == len(rows)
    check_mix(got, [(x[0], x[1], x[3]) for x in rows])
    assert mixing.mixed_rows(docs).columns == docs.columns
    assert mixing.mix_plan(frame([], DOCS)).count() == 0 and mixing.mixed_rows(frame([], DOCS)).count() == 0


# -- languages --------------------------------------------------------------

def test_language_accuracy_on_held_out_texts(spark):
    docs = table(spark, SF2)
    rows = language_id.predict(docs, language_id.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out and r.lang is not None]
    assert len(held) > 100 and np.mean([r.lang == r.lang_pred for r in held]) > 0.97


def test_language_never_learns_from_held_out_texts(spark, frame):
    texts = [(i, "aaa bbb ccc" if zlib.crc32(str(i).encode()) % 4 == 2 else "ddd eee fff", "xx" if
              zlib.crc32(str(i).encode()) % 4 == 2 else "yy", "s", 1) for i in range(60)]
    assert language_id.learn(frame(texts, DOCS)).langs == ["yy"]


def test_language_edge_rows(frame):
    train = [(i, f"{w} " * 30, lang, "s", 1) for i in range(0, 80) for w, lang in [("hello the of", "en") if i % 2 else ("salut le de", "fr")]]
    rows = train + [(200, None, "en", "s", 0), (201, "", "en", "s", 0), (202, "12 !! 34", "en", "s", 0),
                    (203, "the hello of " * 3000, None, "s", 0), (None, "salut", None, "s", 0), (200, None, "en", "s", 0)]
    docs = frame(with_clashes(rows), CLASHING)
    got = language_id.predict(docs, language_id.learn(docs)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert [by[i].lang_pred for i in (200, 201, 202, 203, None)] == ["und", "und", "und", "en", "fr"]
    assert by[200].score == 0 and by[203].score > 0.5 and by[None].held_out is False
    assert language_id.learn(frame([], DOCS)) is None
    assert {r.lang_pred for r in language_id.predict(docs, None).collect()} == {"und"}


def test_language_of_unspaced_texts_shows_after_the_first_bytes(frame):
    """Two languages that share the first 24 bytes and the end; a text is one word."""
    r = rng(4)
    text = lambda letters: "漢字文書漢字文書" + "".join(r.choice(letters) for _ in range(300)) + "終了"
    rows = [(i, text("のはをにがでとも" if i % 2 else "的是在不了有和人"), "ja" if i % 2 else "zh", "s", 310) for i in range(120)]
    docs = frame(rows, DOCS)
    got = language_id.predict(docs, language_id.learn(docs)).collect()
    assert {(x.doc_id % 2, x.lang_pred) for x in got} == {(1, "ja"), (0, "zh")}
    words = [t.encode() for _, t, *_ in rows] + [b"short", b"=" * 70, b"(" + b"a" * 24 + b")"]
    cut = language_id.pieces(words)
    bare = [w.strip(b"\xfe\xff") for w in cut]
    assert language_id.pieces(cut) == cut and max(map(len, bare)) <= 24 and [w.decode() for w in bare]
    assert b"".join(bare) == b"".join(words[:-1]) + b"a" * 24


def plain_marginals(scores, start, transitions):
    """Forward-backward in logarithms, one word at a time."""
    n, k = scores.shape
    lse = lambda x, axis: np.log(np.exp(x - x.max(axis=axis, keepdims=True)).sum(axis=axis)) + x.max(axis=axis)
    a, b = np.zeros((n, k)), np.zeros((n, k))
    a[0] = start + scores[0]
    for t in range(1, n):
        a[t] = lse(a[t - 1][:, None] + transitions, 0) + scores[t]
    for t in range(n - 2, -1, -1):
        b[t] = lse(transitions + (scores[t + 1] + b[t + 1])[None, :], 1)
    m = a + b
    return np.exp(m - lse(m, 1)[:, None])


def test_chain_marginals_are_exact_for_long_texts():
    r = np.random.default_rng(2)
    lengths = [1, 0, 5, 64, 65, 128, 700, 3]
    first = np.concatenate([[0], np.cumsum(lengths)])
    scores = r.normal(size=(first[-1], 4)).astype(np.float32)
    start, transitions = r.normal(size=4), r.normal(size=(4, 4))
    got = language_id.chain_marginals(scores, first, start, transitions)
    for a, b in zip(first, first[1:]):
        if b > a:
            assert np.abs(got[a:b] - plain_marginals(scores[a:b].astype(float), start, transitions)).max() < 1e-4


def test_code_switched_words_are_labelled(spark):
    docs = table(spark, SF2)
    model = language_id.learn(docs)
    texts = {r.lang: r.text for r in docs.where("length(text) > 800").collect() if r.lang}
    spans = [(lang, t.split()[20:50]) for lang, t in sorted(texts.items())]
    got, _ = language_id.Labeller(model).label([" ".join(w for _, s in spans for w in s).encode()])
    want = [lang for lang, s in spans for _ in s]
    assert np.mean([model.langs[k] == w for k, w in zip(got.argmax(axis=1), want)]) > 0.85


# -- extraction -------------------------------------------------------------

def test_article_of_the_pages(spark):
    for r in html_extract.main_text(table(spark, SF2, "pages")).join(table(spark, SF2, "pages").select("page_id", "html"), "page_id").collect():
        body = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", body)).split())
        assert r.text == want and r.n_chars == len(want)


P = "Some words of the story go here, with a comma and enough length to matter."
CASES = [
    ("<body><nav><a href=x>Home</a> <a href=y>News</a></nav><div id=content><h1>Title of it</h1><p>%s</p><p>%s</p></div>"
     "<div class='sidebar'><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div><footer>(c) us</footer></body>" % (P, P),
     f"Title of it {P} {P}"),
    (f"<html><body><article><p>{P}<p>{P}<section class=comments><p>First! {P}</p></section></article>"
     f"<aside>{P}</aside><div id='cookie-notice'>We use cookies {P}</div></body></html>", f"{P} {P}"),
    (f"<div><p>{P}</p><form><p>Name</p><input><button>Go</button></form><p>a &amp; b &lt;c&gt; &eacute;&#33;</p><p>{P}</p></div>",
     f"{P} a & b <c> é! {P}"),
    (f"<article><!-- <p>no</p> --><script>var a='<p>x</p>'</script><style>p{{}}</style><p>{P}<br>next\n\t line</p></article>",
     f"{P} next line"),
    ("plain text only", "plain text only"), ("", ""), ("<p></p>", ""), ("<article><p>cut <b>short", "cut short"),
    ("</div></p>stray <i>ends</b> &amp here", "stray ends & here"),
]


@pytest.mark.parametrize("page, text", CASES)
def test_extraction_cases(page, text):
    assert html_extract.extract(page) == text


STORY = " ".join([P] * 4)
TALK = "".join(f"<li class=comment><p>First! {P}</p></li>" for _ in range(9))
WRAPPED = [
    f"<body><div class='content-sidebar-wrap'><article><p>{STORY}</p></article><div class=sidebar>{P}</div></div><footer>{P}</footer></body>",
    f"<body><div class='has-sidebar no-comments'><div class='social-share-enabled'><p>{STORY}</p></div></div><div class=menu><a href=x>{STORY}</a></div></body>",
    f"<body><form id=aspnet><input><div><main><p>{STORY}</p></main></div><label>Find {P}</label></form></body>",
    f"<body><form><p>{STORY}</p><div class=newsletter>{P}</div></form></body>",
    f"<body><article><p>{STORY}</p></article><div class=comments><ol>{TALK}</ol></div></body>",
    f"<body><div class=post><p>{STORY}</p></div><div class=comments><article class=comment><p>{P}</p></article></div></body>",
]


@pytest.mark.parametrize("page", WRAPPED)
def test_extraction_of_wrapped_articles(page):
    assert html_extract.extract(page) == STORY


def test_extraction_edge_rows(frame):
    kind = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, "u", None, "x", "y"), (1, "u", None, "x", "y"), (2, None, "<p>a</p>", "x", "y"), (None, "u", "<p>" * 5000 + "deep", "x", "y"),
            (3, "u", "<div>" * 3000 + "deep" + "</div>" * 3000, "x", "y"), (4, "u", f"<p>{'w ' * 200000}</p>", "x", "y")]
    got = sorted((str(r.page_id), str(r.url), r.n_chars) for r in html_extract.main_text(frame(rows, kind)).collect())
    assert got == [("1", "u", 0), ("1", "u", 0), ("2", "None", 1), ("3", "u", 4), ("4", "u", 399999), ("None", "u", 4)]
    assert html_extract.main_text(frame([], kind)).count() == 0


# -- pipeline ---------------------------------------------------------------

def test_pipeline_stage_by_stage(spark):
    docs = table(spark, SF2)
    kept = corpus_pipeline.quality_stage(spark, docs, SF2)
    verdicts = {r.doc_id for r in quality.quality_rules(docs).collect() if r.kept}
    assert {r.doc_id for r in kept.collect()} == verdicts and kept.columns == docs.columns
    unique = corpus_pipeline.exact_stage(spark, kept, SF2)
    best = {}
    for r in kept.collect():
        best[r.text.translate({k: k + 32 for k in range(65, 91)})] = max(r.doc_id, best.get(r.text.translate({k: k + 32 for k in range(65, 91)}), -1))
    assert sorted(r.doc_id for r in unique.collect()) == sorted(best.values()) and unique.columns == docs.columns
    single = corpus_pipeline.near_stage(spark, unique, SF2)
    want = near_components([(r.doc_id, r.text) for r in unique.collect()])
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(want.values())) and single.columns == docs.columns
    mix = corpus_pipeline.mix_stage(spark, single, SF2)
    assert mix.columns == docs.columns
    n = {r.doc_id: r.taken for r in mixing.mix_plan(single).collect()}
    got = collections.Counter()
    for r in mix.collect():
        got[r.doc_id] += len(words(r.text))
    assert got == {i: t for i, t in n.items() if t}
    pieces = corpus_pipeline.pack_stage(spark, mix, SF2).collect()
    assert sum(r.piece == 0 for r in pieces) == mix.count()


def test_pipeline_run_and_empty_table(spark, frame):
    assert corpus_pipeline.run(spark, SF).count() > 0
    docs = frame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
