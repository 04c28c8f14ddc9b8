"""The learnt operators: held-out accuracy and awkward rows."""

import random
import re
import zlib

import numpy as np
from conftest_llm import DOCS, docs, no_docs  # noqa: F401
from quarry.llm import extract, langid, quality
from quarry.llm.dom import Page
from quarry.llm.trees import boost

SF = "/root/testdata/sf0.01"


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.classify(docs, labels).collect()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert len(rows) == docs.count() and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([a == b for a, b in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_quality_ignores_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - quality else quality end as quality")
    a, b = (sorted((r.doc_id, r.score) for r in quality.classify(docs, x).collect()) for x in (labels, turned))
    assert a == b


def test_quality_awkward_rows(spark, docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (7, 0, 0), (7, 1, 0), (6, 0, 1), (8, 1, 0), (9, 1, 0), (-5, 0, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    out = quality.score(docs, quality.fit(docs, labels))
    assert out.count() == len(DOCS) and out.columns == [*[c for c in docs.columns if c != "score"], "score", "predicted"]
    by = {}
    for r in out.collect():
        by.setdefault(r.text, set()).add(r.score)
    assert all(len(s) == 1 and 0 <= min(s) <= 1 for s in by.values())
    assert quality.classify(no_docs, labels).collect() == []
    assert {r.score for r in quality.classify(docs, labels.limit(0)).collect()} == {1.0}


def test_attention_finds_the_bad_passage():
    rng = np.random.default_rng(0)
    clean, junk = "the words of an even text go on and on here. " * 12, "@@## $$%% !!!! ^^&& " * 26
    texts = [(clean * rng.integers(1, 5), 1) for _ in range(60)] + [(clean * rng.integers(1, 4) + junk, 0) for _ in range(60)]
    model = quality.train([quality.passage_features(t) for t, _ in texts], np.array([y for _, y in texts], float))
    x = quality.passage_features(clean * 3 + junk)
    score, attention = model.bag(x)
    assert score < 0.3 < model.bag(quality.passage_features(clean * 4))[0]
    assert attention[-2:].sum() > 1.5 * 2 / len(x) and abs(attention.sum() - 1) < 1e-9


def test_language_of_documents_and_pages(spark):
    docs, pages = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "pages"))
    rows = langid.identify(docs, pages).collect()
    lang = {r.doc_id: r.lang for r in docs.collect()}
    held = [r.lang == lang[r.doc_id] for r in rows if r.doc_id is not None]
    assert len(held) == docs.count() and np.mean(held) > 0.97
    declared = [r.lang == r.declared for r in rows if r.page_id is not None]
    assert len(declared) == pages.count() and np.mean(declared) > 0.97


def test_language_evidence_without_text(spark):
    """An empty page is judged by its declaration and its host's other pages."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    some = {r.lang: r.text for r in docs.filter("length(text) > 800").dropDuplicates(["lang"]).collect()}
    web = [(k, f"http://{lang}.host.test/{k}", f'<html lang="{lang}"><p>{some[lang]}</p>') for k, lang in enumerate(["fr", "de"] * 12)]
    web += [(100, "http://fr.host.test/x", ""), (101, None, '<html lang="de"></html>'), (102, "http://fr.host.test/x", None), (103, None, None), (None, "", "")]
    got = {r.page_id: r.lang for r in langid.identify(docs, spark.createDataFrame(web, "page_id long, url string, html string")).filter("doc_id is null").collect()}
    assert got[100] == got[102] == "fr" and got[101] == "de" and got[103] in some and None in got
    assert all(got[k] == lang for k, lang in enumerate(["fr", "de"] * 12))


def test_language_awkward_rows(spark, docs, no_docs):
    pages = spark.createDataFrame([(1, None, None)], "page_id long, url string, html string")
    assert langid.identify(docs, pages).count() == len(DOCS) + 1
    assert langid.identify(no_docs, pages.limit(0)).collect() == []


def test_extraction_of_the_article(spark):
    import html
    import re

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    rows = extract.extract(pages, extract.fit(pages)).collect()
    assert len(rows) == len(source)
    for r in rows:
        inside = re.search(r"<article>(.*)</article>", source[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"<(?:h1|p|/h1|/p)>", inside)]
        assert r.text == "\n\n".join(filter(None, blocks)) and r.n_chars == len(r.text)


def test_extraction_of_changed_pages(spark):
    """Held-out pages whose article isn't marked, with things around and inside it."""
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").collect()]
    made = [(extract.labelled(c)) for h in pages[:150] for c in extract.training_pages(h, random.Random(h))]
    model = boost(np.concatenate([x for x, _ in made]), np.concatenate([y for _, y in made]))
    held = [extract.labelled(c) for h in pages[150:] for c in extract.training_pages(h, random.Random(h + "held out"))]
    x, y = np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held])
    assert ((model.log_odds(x) > 0) == y).mean() > 0.97


def test_extraction_awkward_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>no article marked, but some text that is long enough to be one."), (3, "u", "<" * 1000), (4, "u", "<div>" * 20_000 + "deep" + "</p>" * 10), (5, "u", "<script>never closed <p>x"), (6, "u", "<!-- never closed <p>x"), (7, "u", "a &amp; b &lt; &#233; &nope; &#x110000;"), (7, "u", "<a href=\"x' <p>t")]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    assert extract.extract(df, extract.fit(df)).count() == len(rows)
    assert extract.extract(df.limit(0), None).collect() == []


def test_nothing_is_kept_below_what_is_dropped():
    rng = np.random.default_rng(0)
    page = Page("<body>" + "".join(f"<div><p>t{k}</p><div><p>u{k}</p>v</div></div>" for k in range(50)))
    for _ in range(50):
        kept = extract.decode(page, rng.normal(size=len(page.tag)) * 4)
        assert all(kept[page.parent[k]] for k in np.flatnonzero(kept) if k)


def test_extraction_of_bare_text(spark):
    """Articles directly in the body, in inline elements or without any tag, beside menus; no block holds them."""
    a, b, c = ("The river rose for three days, and nobody in the town slept much. Boats were tied to the doors.", "On the fourth day the water fell, slowly at first, and people came out to count what was left of it.", "What was left was little, they said, but it would do until the spring.")
    menu = "<a href='/'>Home</a> | <a href='/n'>News</a> | <a href='/a'>About</a> | <a href='/c'>Contact</a>"
    cases = {
        1: (f"<html><body>{a}<br><br>{b}<br>{c}</body></html>", f"{a} {b} {c}"),
        2: (f"<html><body><span>{a}</span><font size=2>{b}</font> <x-text>{c}</x-text></body></html>", f"{a}{b} {c}"),
        3: (f"{a} &amp; {b}", f"{a} & {b}"),
        4: (f"<html><body><p>{a}</p>{b}<p>{c}</p></body></html>", f"{a}\n\n{b}\n\n{c}"),
        5: (f"<html><body>{menu}<hr>{a}<br>{b}<br>{c}<hr>{menu}</body></html>", f"{a} {b} {c}"),
        6: (f"<html><body><div class='menu'>{menu}</div>{a}<br>{b}<br>{c}<div id='footer'>{menu}</div></body></html>", f"{a} {b} {c}"),
        7: ("a &amp; b &lt; &#233; &nope;", "a & b < é &nope;"),
    }
    rows = spark.createDataFrame([(k, "u", h) for k, (h, _) in cases.items()], "page_id long, url string, html string")
    model = extract.fit(spark.read.parquet(f"{SF}/pages.parquet"))
    assert model is not None
    assert {r.page_id: r.text for r in extract.extract(rows, model).collect()} == {k: t for k, (_, t) in cases.items()}
    plain = {r.page_id: r.text for r in extract.extract(rows, None).collect()}
    assert all(plain[k] == cases[k][1] for k in (1, 2, 3, 4, 7))


def test_bare_text_takes_names_from_around_all_of_it():
    page = Page("<body>x <a class='menu'>y</a> z<hr><span class='menu'>u <b>v</b></span><hr><a class='popup'>w</a> t" + "<span class=nav>s<hr>" * 3)
    assert [(text, page.tokens[k]) for k, text in page.runs] == [("x y z", set()), ("u v", {"menu"}), ("w ts", set()), ("s", {"nav"}), ("s", {"nav"})]


def test_unclosed_controls_lose_only_their_label():
    read = lambda h: [t for _, t in Page(h).runs]
    for tag in ("button", "select", "object", "svg", "noscript", "template"):
        assert read(f"<article><p>a</p><div><{tag}>x</div><p>b</p><p>c</p></article>d") == ["a", "b", "c", "d"]
        assert read(f"<article><p>a</p><{tag}>x<p>b</p><p>c <{tag}>y</{tag}> d</p></article>") == ["a", "b", "c d"]
        assert read(f"a <{tag}>x<br>b<hr>c") == ["a b", "c"]
        assert read(f"<p>a <{tag}><p>x</p><ul><li>y<li>z</ul></{tag}> b</p><p>c<{tag}/> d</p>") == ["a b", "c d"]
        assert read(f"<ul><li>a<{tag}><li>x</{tag}><li>b</ul>") == ["a", "b"]
    assert read("<p>a</p><textarea>x <p>y</textarea><p>b</p><script>never closed <p>x") == ["a", "b"]
    assert read("<p>a</p>" + "<button>x" * 20_000 + "<p>b</p>") == ["a", "b"]


def test_languages_of_few_documents(spark):
    """One labelled document makes a language, beside large ones and in a table of few rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    few = {"el": "το ποτάμι ανέβαινε τρεις μέρες και κανείς στην πόλη δεν κοιμήθηκε πολύ", "pl": "rzeka podnosiła się przez trzy dni i nikt w mieście nie spał zbyt wiele, łódki były przywiązane do drzwi"}
    rows = spark.createDataFrame([(-k, t, lang, "few") for k, (lang, t) in enumerate(few.items(), 1)], docs.schema)
    none = spark.createDataFrame([], "page_id long, url string, html string")
    got = {r.doc_id: r.text_lang for r in langid.identify(docs.unionByName(rows), none).collect()}
    assert [got[-1], got[-2]] == ["el", "pl"]
    alone = langid.identify(rows, none).collect()
    assert {r.doc_id: r.text_lang for r in alone} == {-1: "el", -2: "pl"} and all(r.lang in few and r.probability > 0 for r in alone)


def test_quality_learns_from_every_passage(spark, monkeypatch):
    """Long documents reach training whole; where they don't fit together, some are left out whole."""
    rng = np.random.default_rng(0)
    ids = [k for k in range(1000) if zlib.crc32(str(k).encode()) % 5][:40]
    texts = [(k, " ".join(rng.choice(["even", "words", "of", "a", "text"], 6000))) for k in ids]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(k, n % 2) for n, k in enumerate(ids)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "train", lambda bags, y: seen.append((sorted(map(len, bags)), list(y))) or quality.Model({}))
    whole = sorted(-(-len(t) // quality.PASSAGE) for _, t in texts)
    quality.fit(docs, labels)
    assert seen[0][0] == whole and whole[0] > 24
    quality.fit(docs, labels, most_passages=sum(whole) // 2)
    assert set(seen[1][0]) <= set(whole) and 15 <= len(seen[1][0]) <= 25 and sum(seen[1][0]) <= sum(whole) // 2
    assert abs(sum(seen[1][1]) - len(seen[1][1]) / 2) <= 1


def test_extraction_without_marked_pages(spark):
    """What the docstring says: named elements go, unnamed menus stay."""
    rows = spark.createDataFrame([(1, "u", "<body><div class=menu><p>a</p></div><ul><li><a href=b>b</a></ul><div>c</div></body>")], "page_id long, url string, html string")
    assert extract.fit(rows) is None
    assert [r.text for r in extract.extract(rows, None).collect()] == ["b\n\nc"]
    assert "fallback_odds" in extract.__doc__


def test_words_are_known_by_their_letters(monkeypatch):
    """Hashes tell words apart as a regular expression does, and pairs are neighbours; slices don't change features."""
    text = "The the THE, über ÜBER; a1b x\ny the a " + "é" * 300 + " end"
    starts, words, pairs = quality.hashed_words(np.frombuffer(text.encode(), dtype=np.uint8))
    found = [(m.start(), m[0].lower()) for m in re.finditer(rb"[A-Za-z\x80-\xff]+", text.encode())]
    assert starts.tolist() == [at for at, _ in found]
    assert len(set(words.tolist())) == len({w for _, w in found})
    names = [w for _, w in found]
    assert all((a == b) == (x == y) for a, x in zip(words.tolist(), names, strict=True) for b, y in zip(words.tolist(), names, strict=True))
    assert len(set(pairs.tolist())) == len(set(zip(names, names[1:], strict=False))) and len(pairs) == len(words) - 1
    for part in ("", "1 2", "x"):
        assert len(quality.hashed_words(np.frombuffer(part.encode(), dtype=np.uint8))[1]) == (part == "x")
    common = quality.Vocabulary(np.unique(words)[:5], np.unique(pairs)[:5])
    long = "word by word it goes, on and on ------- " * 100  # 40 bytes; a slice of 5 passages ends with one of its texts
    whole = quality.passage_features(long, common)
    monkeypatch.setattr(quality, "SLICE", 5)
    assert np.allclose(quality.passage_features(long, common), whole, atol=0.06) and whole.shape[1] == quality.N_PLAIN + common.size
    model = quality.train([quality.passage_features(t, common) for t in (long, "a b")], np.array([1.0, 0.0]))
    model.vocabulary = common
    assert abs(model.text(long) - model.bag(quality.passage_features(long, common))[0]) < 1e-9


def test_quality_knows_words(spark):
    """Prose whose words have their letters shuffled is no prose, as it has no common words."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    rng = random.Random(0)
    mixed = lambda m: "".join(rng.sample(m[0], len(m[0])))
    good = [r.text for r in docs.join(labels.filter("quality = 1"), "doc_id").collect() if len(r.text or "") > 300]
    before = [model.text(t) >= 0.3 for t in good]
    after = [model.text(re.sub(r"[^\W\d_]+", mixed, t)) >= 0.3 for t in good]
    assert len(good) > 50 and np.mean(before) > 0.97 and np.mean(after) < 0.3
