"""Operators that learn, pages, and the pipeline."""

import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from solarspark.llm import html_text, language, quality, toxicity
from solarspark.llm.components import components
from solarspark.llm.queries import QUERIES

HARD = [None, "", " \n\n", "!!", "x", "é" * 3000, "a b\n" * 500]


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def labels_of(spark, values):
    return spark.createDataFrame([(i, q, t, "z") for i, (q, t) in enumerate(values)],
                                 "doc_id bigint, quality int, toxic int, text string")


# --- language

def test_language(documents):
    rng = random.Random(1)
    parts = {"aa": ["tha", "nor", "ing", "wes"], "bb": ["zul", "öch", "keit", "ver"], "cc": ["ção", "osa", "que", "lli"]}
    texts, langs = [], []
    for i in range(300):
        lang = rng.choice(list(parts))
        texts.append(" ".join("".join(rng.choices(parts[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(5, 60))))
        langs.append(lang)
    mixed = " ".join(["thanor ingwes"] * 30 + ["zulöch keitver"] * 10)
    found = by_id(language.predict_language(documents(texts + HARD + [mixed], langs=langs + [None] * (len(HARD) + 1))))
    right = [found[i]["lang_pred"] == langs[i] for i in range(300) if held(i)]
    assert np.mean(right) > 0.95
    assert [found[300 + i]["lang_pred"] for i in range(4)] == ["und"] * 4
    assert not len(language.grams("\u0301\u0302 \u0301")) and len(language.grams("e\u0301"))
    assert found[300 + len(HARD)]["lang_pred"] == "aa" and 0.6 < found[300 + len(HARD)]["score"] < 0.9
    assert all(0 <= r["score"] <= 1 and r["held_out"] == held(i) for i, r in found.items())


def test_language_without_labels(documents):
    rows = language.predict_language(documents(["text", None], [None, 1])).collect()
    assert {r["lang_pred"] for r in rows} == {"und"} and sorted(r["held_out"] for r in rows)[-1]
    assert language.predict_language(documents([])).count() == 0


# --- toxicity and quality

def test_gradients_of_the_network():
    words = ("one", "two", "three", "four")
    net = toxicity.Network(seed=3, keys=[k for w in words for k in toxicity.keys_of(w)])
    rows = net.table_rows(words)
    index, mask = toxicity.padded([np.array([0, 1, 2, 3, 1]), np.array([3, 2])])
    y = np.array([1.0, 0.0])
    for value in net.p.values():
        value *= 3

    def loss():
        logit = net.forward(net.projected(net.vectors(rows).astype(np.float64)), index, mask)
        p = 1 / (1 + np.exp(-logit))
        return -float((y * np.log(p) + (1 - y) * np.log(1 - p)).sum())

    x = net.vectors(rows)
    logit, kept = net.forward(net.projected(x), index, mask, keep=True)
    g, _ = net.gradients(x, index, mask, (1 / (1 + np.exp(-logit)) - y).astype(np.float32), kept)
    rng = np.random.default_rng(0)
    for name in ("w", "u", "c", "b", "att", "out", "bias"):
        flat = net.p[name].reshape(-1)
        for at in rng.choice(flat.size, min(4, flat.size), replace=False):
            old = flat[at].copy()
            flat[at] = old + 1e-2
            up = loss()
            flat[at] = old - 1e-2
            down = loss()
            flat[at] = old
            assert g[name].reshape(-1)[at] == pytest.approx((up - down) / 2e-2, abs=5e-2, rel=0.1)


def test_windows_cover_every_word():
    for n in range(1, 400):
        windows = toxicity.windows_of(n)
        assert set().union(*(range(a, b) for a, b in windows)) == set(range(n))
        assert all(b - a <= toxicity.WINDOW for a, b in windows)


def test_toxicity(spark, documents):
    rng = random.Random(2)
    words = [f"{a}{b}" for a in ("lo", "mi", "ta", "ru") for b in ("ne", "sa", "ko", "vi", "da")]
    texts, values = [], []
    for i in range(500):
        body, toxic = rng.choices(words, k=rng.randint(5, 200)), rng.random() < 0.4
        for _ in range(len(body) // 15 + 2 if toxic else 0):
            body.insert(rng.randrange(len(body)), rng.choice(["badword", "Vilest!"]))
        texts.append(" ".join(body))
        values.append((None, int(toxic)))
    docs = documents(texts + HARD)
    found = by_id(toxicity.score_toxicity(docs, labels_of(spark, values)))
    assert np.mean([found[i]["predicted"] == values[i][1] for i in range(500) if held(i)]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found.values())
    kept = toxicity.keep_clean(docs, labels_of(spark, values))
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in found.items() if r["score"] < 0.5}


def test_toxicity_learns_from_the_end_of_long_texts(spark, documents):
    rng = random.Random(12)
    words = [f"{a}{b}" for a in ("lo", "mi", "ta", "ru") for b in ("ne", "sa", "ko", "vi", "da")]
    texts, values = [], []
    for i in range(80):
        toxic = i % 2
        tail = [w if rng.random() < 0.5 or not toxic else rng.choice(["badword", "vilest"]) for w in rng.choices(words, k=90)]
        texts.append(" ".join(rng.choices(words, k=4010) + tail))
        values.append((None, toxic))
    net = toxicity.fit(documents(texts), labels_of(spark, values))
    assert "<badword>" in net.rows
    found = by_id(toxicity.score_toxicity(documents(texts), labels_of(spark, values)))
    assert np.mean([found[i]["predicted"] == values[i][1] for i in range(80) if held(i)]) > 0.9


def test_quality(spark, documents):
    rng = random.Random(3)
    texts, values = [], []
    for i in range(400):
        good = rng.random() < 0.7
        lines = ["The words of a line go on and end here, as they should." for _ in range(rng.randint(1, 3))]
        lines = [" ".join(rng.sample("one two three four five six seven".split(), 6)) + "." for _ in range(rng.randint(1, 9))]
        if not good:
            lines += [" ".join(f"{w}%%%" for w in "one two three".split()) for _ in range(rng.randint(3, 9))]
        texts.append("\n".join(lines))
        values.append((int(good), None))
    found = by_id(quality.score_quality(documents(texts + HARD), labels_of(spark, values)))
    assert np.mean([found[i]["predicted"] == values[i][0] for i in range(400) if held(i)]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found.values()) and len(found) == 400 + len(HARD)


def test_quality_learns_from_the_end_of_long_texts(spark, documents):
    rng = random.Random(13)
    texts, values = [], []
    for i in range(60):
        good = i % 2
        lines = [" ".join(rng.sample("one two three four five six seven".split(), 6)) + "." for _ in range(760)]
        if not good:
            lines += ["one%%% two%%% three%%%"] * 300
        texts.append("\n".join(lines))
        values.append((good, None))
    assert min(map(len, texts)) > 20_000
    found = by_id(quality.score_quality(documents(texts), labels_of(spark, values)))
    held_out = [i for i in range(60) if held(i)]
    assert max(found[i]["score"] for i in held_out if not values[i][0]) < min(found[i]["score"] for i in held_out if values[i][0]) - 0.1


@pytest.mark.parametrize("values", [[], [(None, None)], [(1, 1)] * 9])
def test_labels_that_teach_nothing(spark, documents, values):
    docs = documents([*HARD, "some words"])
    for score in (toxicity.score_toxicity, quality.score_quality):
        rows = score(docs, labels_of(spark, values)).collect()
        assert len(rows) == len(HARD) + 1 and all(0 <= r["score"] <= 1 for r in rows)
        assert score(documents([]), labels_of(spark, values)).count() == 0


def test_marginals_are_exact():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5):
        score, pair = rng.normal(size=n), rng.normal(size=(2, 2))
        total, good = 0.0, np.zeros(n)
        for k in range(2 ** n):
            y = [(k >> i) & 1 for i in range(n)]
            p = np.exp(sum(s * v for s, v in zip(score, y)) + sum(pair[a, b] for a, b in zip(y, y[1:])))
            total += p
            good += p * np.array(y)
        assert quality.marginals(score, pair) == pytest.approx(good / total)


# --- pages

def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, (u, h) in enumerate(rows)],
                                 "page_id bigint, url string, html string, text string, row int")


def test_main_text(spark):
    body = ("<html><head><title>T</title><style>p{}</style></head><body><nav><a>Home</a></nav><div class='ad'>Buy</div>"
            "<header>Site</header><article><header class='article-header'>Top</header><h1>Big  &amp; <i>bold</i></h1><p>One<br>two\n three &lt;p&gt;<p>Four <b>fi</b>ve"
            "<div class='comments'><p>nice!</p></div><script>var t='</p>';</script><form><input>go</form><!-- <p>no</p> -->"
            "<ul><li>a<li>b</ul></article><aside>side</aside><footer>&copy; x</footer>")
    rows = [("http://a.com/1", body), ("http://a.com/2", None), (None, ""), ("http://b.com", "plain < text"),
            ("http://b.com/2", "<p>unclosed <b>tag"), ("http://b.com/3", "<nav>only"), ("http://b.com/4", "<p>" * 3000 + "deep")]
    found = {r["page_id"]: r for r in html_text.extract_text(pages_of(spark, rows)).collect()}
    assert found[0]["text"] == "Top\nBig & bold\nOne two three <p>\nFour five\na\nb"
    assert [found[i]["text"] for i in range(1, 7)] == ["", "", "plain < text", "unclosed tag", "", "deep"]
    assert all(r["n_chars"] == len(r["text"]) for r in found.values()) and found[3]["url"] == "http://b.com"
    assert html_text.extract_text(pages_of(spark, [])).count() == 0


def test_template_of_a_site_goes(spark):
    page = "<body><div><p>Welcome to our site</p></div><div><p>{}</p></div><div><i>All rights</i> reserved</div></body>"
    rows = [(f"http://a.com/{i}", page.format(f"story {i}")) for i in range(6)]
    rows += [("http://b.com/1", page.format("alone"))]
    rows += [(f"http://c.com/{i}", "<article><p>Same article</p><div id='n'>Sign up</div></article>") for i in range(6)]
    found = {r["page_id"]: r["text"] for r in html_text.extract_text(pages_of(spark, rows)).collect()}
    assert [found[i] for i in range(6)] == [f"story {i}" for i in range(6)]
    assert found[6] == "Welcome to our site\nalone\nAll rights reserved"
    assert [found[i] for i in range(7, 13)] == ["Same article"] * 6


def test_template_within_articles_goes(spark):
    page = ("<body><article><h1>Title {0}</h1><p><b>Note</b> of {0}</p><p>Sign up for our newsletter</p>"
            "<div>All rights <i>reserved</i></div></article></body>")
    rows = [(f"http://a.com/{i}", page.format(f"story {i}")) for i in range(6)]
    rows += [(f"http://b.com/{i}", page.format("the same")) for i in range(6)]
    rows += [("http://c.com/", f"<p>One text</p><p>Two</p><nav>{i}</nav>") for i in range(6)]
    rows += [(f"http://d.com/{i}", "<article><div class='body'>Only a <b>text</b></div></article>") for i in range(6)]
    found = {r["page_id"]: r["text"] for r in html_text.extract_text(pages_of(spark, rows)).collect()}
    assert [found[i] for i in range(6)] == [f"Title story {i}\nNote of story {i}" for i in range(6)]
    assert {found[i] for i in range(6, 12)} == {
        "Title the same\nNote of the same\nSign up for our newsletter\nAll rights reserved"}
    assert {found[i] for i in range(12, 18)} == {"One text\nTwo"}
    assert {found[i] for i in range(18, 24)} == {"Only a text"}


def test_what_articles_share_between_their_own_parts_stays(spark):
    page = ("<body><article><p>Share this page</p><h1>Title {0}</h1><p>First part of {0}</p><h2>History</h2><p>Second part of {0}</p>"
            "<blockquote>To be or not to be</blockquote><p>See below.</p><p>Last part of {0}</p><div class='more'>Read on</div>"
            "<p>End of {0}</p><p>All rights reserved</p></article></body>")
    rows = [(f"http://a.com/{i}", page.format(f"story {i}")) for i in range(6)]
    found = {r["page_id"]: r["text"] for r in html_text.extract_text(pages_of(spark, rows)).collect()}
    assert [found[i] for i in range(6)] == [
        f"Title story {i}\nFirst part of story {i}\nHistory\nSecond part of story {i}\nTo be or not to be\nSee below.\n"
        f"Last part of story {i}\nEnd of story {i}" for i in range(6)]


def test_broken_and_deep_pages_take_linear_time():
    import time
    pages = ["<p>ok</p><a href=\"x" + " b=\"c\"" * 10_000, "<p>ok</p>" + "<a b='" * 20_000, "<p>ok</p>" + "<!x" * 20_000,
             "<div>" * 100_000 + "<p>ok</p>", "<b>" * 50_000 + "<p>ok" + "</i>" * 50_000, "<p>ok</p><script>" + "</script" * 20_000]
    for source in pages:
        start = time.perf_counter()
        blocks = html_text.read_page(source)[0]
        assert time.perf_counter() - start < 15  # without the bounds, minutes or never
        assert [b[0] for b in blocks] == ["ok"]


def test_raw_text_ends_where_it_says():
    source = "<p>a</p><script>if (a<b && c) x = \"</script><p>b 1 < 2 and 3 > 2</p><textarea><p>no</p></textarea><p title=\"x>y\">c"
    assert [b[0] for b in html_text.read_page(source)[0]] == ["a", "b 1 < 2 and 3 > 2", "c"]


def test_template_of_a_section_goes_and_copies_stay(spark):
    section = "<body><p>Weather desk, all days</p><p>{}</p></body>"
    rows = [(f"http://a.com/{i}", section.format(f"story {i}") if i < 6 else f"<p>Page {i}</p>") for i in range(60)]
    rows += [(f"http://b.com/{i}", "<p>First of a text</p><p>Second</p>") for i in range(4)] + [("http://b.com/x", "<p>y</p>")]
    found = {r["page_id"]: r["text"] for r in html_text.extract_text(pages_of(spark, rows)).collect()}
    assert [found[i] for i in range(60)] == [f"story {i}" if i < 6 else f"Page {i}" for i in range(60)]
    assert [found[i] for i in range(60, 65)] == ["First of a text\nSecond"] * 4 + ["y"]


# --- components, queries, pipeline

def test_components_of_chains_and_stars(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 150)] + [(200, 200), (300, None)]
    rng.shuffle(edges)
    found = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 150)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op11_phrases", "op12_spelling"}))
def test_queries_return_a_row_for_every_input(spark, sf_dir, name):
    table = "pages" if name == "op8_html_text" else "documents"
    key = "page_id" if table == "pages" else "doc_id"
    rows = [r[key] for r in QUERIES[name](spark, sf_dir).select(key).collect()]
    assert sorted(rows) == sorted(r[key] for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key).collect())


def test_pipeline_stages(spark, sf_dir):
    from test_exact import brute_hits
    from solarspark.llm.partenum import gram_set, _Hashes

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    by_stage, current = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        current = stage(spark, current, sf_dir)
        by_stage[name] = {r["doc_id"]: r for r in current.collect()}
        if name != "bpe":
            assert current.columns == corpus_pipeline.DOCUMENTS
    score = {r["doc_id"]: r["score"] for r in QUERIES["op9_toxicity"](spark, sf_dir).collect()}
    assert set(by_stage["toxicity"]) == {i for i in texts if score[i] < 0.5}
    # One of each group of similar texts, by comparing all pairs.
    hashes = _Hashes()
    sets = {i: set(gram_set(texts[i], hashes, 5).tolist()) for i in by_stage["toxicity"]}
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i in sets:
            for j in sets:
                common = len(sets[i] & sets[j]) if label[j] != label[i] else 0
                if common and 100 * common >= 80 * len(sets[i] | sets[j]):
                    low = min(label[i], label[j])
                    label[i] = label[j] = low
                    changed = True
    assert set(by_stage["ngram_jaccard"]) == {i for i in label if label[i] == i}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = {i for i in by_stage["ngram_jaccard"] if not brute_hits(texts[i], items)[1]}
    assert set(by_stage["decontamination"]) == clean == set(by_stage["secrets"]) == set(by_stage["bpe"])
    for i, r in by_stage["secrets"].items():
        assert r["n_chars"] == len(r["text"]) and (r["text"] == texts[i] or "[SECRET]" in r["text"])
    whole = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert whole == by_stage["bpe"]
