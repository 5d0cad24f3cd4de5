"""Operators that look at one text at a time: known answers, brute force, odd inputs."""

import collections
import hashlib
import html
import random
import re
import unicodedata

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from framelake.llm import fingerprints, html_extract, language_id, pieces, quality, sentencepiece_scan, token_counts, toxicity

DATA = "/root/testdata/sf0.001"
ODD = [None, "", " ", "\n\n", "a", "a  b", "é" * 50, "x" * 5000, "word " * 400, "ＡＢＣ ﬁ", "a\x00b", "日本語 テキスト", "퟿ end"]


def frame(spark, texts, **more):
    names = ["doc_id long", "text string", *(f"{k} string" for k in more)]
    rows = [(i, t, *(v[i] for v in more.values())) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, ", ".join(names))


# --- pages


def test_article_without_furniture():
    page = """<html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body class="has-sidebar"><header>Site</header>
    <nav><a href=1>Home</a></nav><div class="cookie-notice">We use cookies</div><article><h1>Head &amp; tail</h1><p>One
    <b>two</b> three.<p>Four&nbsp;five<br>six</p><aside>also</aside><form><input>send</form><p>Seven.</article>
    <section id="comments"><p>First!</p></section><footer>end</footer></body></html>"""
    assert html_extract.main_text(page) == "Head & tail\n\nOne two three.\n\nFour five six\n\nSeven."


def brute_segments(lines, window, least):
    """Of (text, linked) lines those between surges and dives, from the definition: a line is inside a segment if every window of lines that
    has it, or lies between it and the segment's first line, has unlinked text."""
    n = len(lines)
    lengths = [0 if linked else len(text) for text, linked in lines]
    full = [any(lengths[j] for j in range(max(0, i - window + 1), min(i + 1, n))) for i in range(n + window)]
    out, i = [], 0
    while i < n:
        if not full[i]:
            i += 1
            continue
        j = i
        while j < len(full) and full[j]:
            j += 1
        own = range(i, min(j - window, n - 1) + 1)
        if sum(lengths[k] for k in own) >= least * sum(len(lines[k][0]) for k in own):
            out += [lines[k][0] for k in own]
        i = j
    return out


@pytest.mark.parametrize("article", [True, False])
def test_distribution_is_brute_forces(article):
    """Unmarked paragraphs and link lines in any order: surges and dives alone tell them apart."""
    rng, changed = random.Random(12), 0
    for _ in range(300):
        lines = []
        for _ in range(rng.randint(0, 6)):
            lines += [("link " * rng.randint(1, 9) + "end", True) for _ in range(rng.randint(0, 6))]
            lines += [("some words " * rng.randint(1, 9) + "end", False) for _ in range(rng.randint(0, 3))]
        body = "".join(f"<div>{f'<a href=x>{t}</a>' if linked else t}</div>" for t, linked in lines)
        page = f"<html><body>{f'<article>{body}</article>' if article else body}</body></html>"
        want = brute_segments(lines, html_extract.WINDOW, html_extract.LEAST_INSIDE if article else html_extract.LEAST_UNLINKED)
        assert html_extract.main_text(page) == "\n\n".join(want)
        changed += want != [t for t, _ in lines]
    assert changed > 150  # without the distribution these would be other texts


def test_sections_of_an_article_stay():
    page = '<article><p>one</p><div class="related-work">two</div><section id="discussion">three</section><p class="notice-board">four</p><div class="ad">no</div><div id="comments">no</div><p>five</p></article>'
    assert html_extract.main_text(page) == "one\n\ntwo\n\nthree\n\nfour\n\nfive"


def test_unmarked_menus_inside_an_article_go():
    menu = "".join(f"<div><a href={i}>Section {i}</a></div>" for i in range(5))
    page = f"<article>{menu}<h1><a href=0>Title</a></h1><p>First <a href=1>linked words</a> and others.</p><div><a href=2>One linked line</a></div><p>Second.</p>{menu}</article>"
    assert html_extract.main_text(page) == "Title\n\nFirst linked words and others.\n\nOne linked line\n\nSecond."


def test_pages_without_article():
    page = '<body><ul id="menu"><li><a href=1>One</a><li><a href=2>Two</a></ul><div><p>This paragraph is long enough to be the text of the page, surely.</p><p>Short.</p></div><div class="ad">Buy now, a very long advert that says very little about a lot of things.</div></body>'
    assert html_extract.main_text(page) == "This paragraph is long enough to be the text of the page, surely.\n\nShort."


def test_short_paragraphs_after_adverts_stay():
    first, last = "A long paragraph goes on and on. " * 90, "The closing paragraph says how it all came to an end. " * 4
    advert = '<div class="ad">Buy now, buy two and pay for one.</div>'
    page = f"<body><div><p>{first}</p>{advert}<p>{last}</p>{advert}<p>The end.</p></div></body>"
    assert html_extract.main_text(page) == "\n\n".join([first.strip(), last.strip(), "The end."])


def test_unmarked_link_lists_go():
    items = "".join(f"<li><a href={i}>Another page of the site, number {i}</a></li>" for i in range(12))
    text = "This paragraph is the text of the page, though it is not a long one."
    assert html_extract.main_text(f"<body><ul>{items}</ul><div><p>{text}</p><p>See <a href=1>this page</a> for more.</p></div><ul>{items}</ul></body>") == text + "\n\nSee this page for more."
    inline = " | ".join(f"<a href={i}>Page {i}</a>" for i in range(12))
    assert html_extract.main_text(f'<body><div>{inline}</div><div class="ad">x</div><p>{text}</p></body>') == text


def test_linked_text_of_articles_and_headings_stays():
    text = "This paragraph is the text of the page, though it is not a long one."
    links = "".join(f"<p><a href={i}>Link {i}</a></p>" for i in range(5))
    lines = [text, *(f"Link {i}" for i in range(5))]
    assert html_extract.main_text(f"<body><article><p>{text}</p>{links}</article></body>") == "\n\n".join(lines)
    assert html_extract.main_text(f"<body><div><h2><a href=1>Title</a></h2><p>{text}</p></div></body>") == f"Title\n\n{text}"


@pytest.mark.parametrize("page", [None, "", "<", "<p", "plain", "<div class='ad'>", "<script>never closed", "<!-- never closed", "</p></p>", "<a b=\"c <p>x", "<p>" * 5000, "<" * 20000])
def test_broken_pages_do_not_crash(page):
    assert isinstance(html_extract.main_text(page), str)


def test_pages_of_the_table(spark):
    for row in spark.read.parquet(f"{DATA}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", row.html, re.S)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", article[1])]
        assert html_extract.main_text(row.html) == "\n\n".join(b for b in blocks if b)


def test_extract_keeps_columns(spark):
    df = spark.createDataFrame([(1, "<p>x</p>", "t"), (2, None, "u")], "page_id int, html string, text string")
    out = {r.page_id: r for r in html_extract.extract(df).collect()}
    assert out[2].text == "" and set(out[1].asDict()) == {"page_id", "html", "text"}
    assert html_extract.extract(df.limit(0)).count() == 0


# --- quality


def base(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    c = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {k for i in range(len(w) - 4) if c[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for x in w for ch in x), len(lines) - len(set(lines)), len(covered)


def test_base_counts(spark):
    rng = random.Random(1)
    texts = [*ODD, *(" ".join(rng.choice("abc#") for _ in range(rng.randint(0, 60))) for _ in range(40)), "l\nl\n \nm\nl"]
    df = frame(spark, texts, lang=["en"] * len(texts))
    found = quality.statistics(df)
    out = quality.judge(found, quality.references(found)).collect()
    for r in out:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base(texts[r.doc_id]), texts[r.doc_id]
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_distances(spark):
    def js(p, q):
        p, q = np.array(p) / sum(p), np.array(q) / sum(q)
        m = (p + q) / 2
        kl = lambda a: sum(x * np.log2(x / y) for x, y in zip(a, m, strict=True) if x)
        return np.sqrt((kl(p) + kl(q)) / 2)

    df = spark.createDataFrame([([1, 2, 3, 0], [4, 0, 1, 1]), ([1, 0, 0, 0], [0, 5, 0, 0])], "p array<int>, q array<int>")
    for r in df.withColumn("d", quality.distance(quality.shares(F.col("p")), quality.shares(F.col("q")))).collect():
        assert np.isclose(r.d, js(r.p, r.q))
    assert df.select(quality.distance(quality.shares(F.array(F.lit(0), F.lit(0))), quality.shares(F.array(F.lit(1), F.lit(0))))).first()[0] is None


def test_quality_verdicts(spark):
    out = {r.doc_id: r for r in quality.op2_quality_rules(spark, DATA).collect()}
    labels = spark.read.parquet(f"{DATA}/labels.parquet").collect()
    clean = [out[r.doc_id] for r in labels if r.quality == 1]
    junk = [out[r.doc_id] for r in labels if r.quality == 0]
    assert sum(r.kept for r in clean if not r.base_failed) == sum(not r.base_failed for r in clean)
    assert sum(r.kept for r in junk) < 0.7 * len(junk)


def test_quality_of_nothing(spark):
    df = frame(spark, ["x"], lang=["en"]).limit(0)
    found = quality.statistics(df)
    assert quality.judge(found, quality.references(found)).count() == 0


# --- fingerprints


def test_canonical_form(spark):
    texts = [*ODD, "  A\tB ", "a b", "É", "é"]
    found = {r.doc_id: r for r in frame(spark, texts).select("doc_id", fingerprints.canonical(F.col("text")).alias("c"), fingerprints.fingerprint(F.col("text")).alias("f")).collect()}
    for i, t in enumerate(texts):
        want = re.sub(r"\s+", " ", unicodedata.normalize("NFKC", t or "").lower()).strip(" ")
        assert found[i].c == want
    assert found[len(ODD)].f == found[len(ODD) + 1].f and found[len(ODD) + 2].f == found[len(ODD) + 3].f


def test_classes_and_neighbours(spark):
    df = frame(spark, ["A b", "a  B", None, "", "other", "other", "x"])
    out = {r.doc_id: (r.class_id, r.n_copies) for r in fingerprints.edited(df).collect()}
    assert out == {0: (0, 2), 1: (0, 2), 2: (2, 2), 3: (2, 2), 4: (4, 2), 5: (4, 2), 6: (6, 1)}
    keys = [5, 1, 9, 70, 30, 31]
    after = {r.k: r.next for r in fingerprints.neighbours(spark.createDataFrame([(k,) for k in keys], "k long"), "k", 3).collect()}
    assert after == {1: 5, 5: 9, 9: 30, 30: 31, 31: 70, 70: 1}
    assert [tuple(r) for r in fingerprints.neighbours(spark.createDataFrame([(4,)], "k long"), "k").collect()] == [(4, 4)]


def test_edited_texts(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").collect()
    out = {r.doc_id: r for r in fingerprints.op6_fingerprints(spark, DATA).collect()}
    assert len(out) == len(rows)
    for i, r in enumerate(rows):
        k, after = len(r.text) // 4, rows[(i + 1) % len(rows)].text
        edited = r.text[: len(r.text) - k] + after[:k]
        assert out[r.doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and out[r.doc_id].n_chars == len(r.text)


def brute_edited(rows):
    """Digest, fingerprint and what follows for each row, by keys in order."""
    keys = sorted({k for k, _ in rows if k is not None})
    least = {k: min((t or "").encode() for q, t in rows if q == k).decode() for k in keys}
    fold = lambda t: re.sub(r"\s+", " ", unicodedata.normalize("NFKC", t).lower()).strip(" ")
    out = []
    for k, t in rows:
        t = t or ""
        after = None if k is None else least[keys[(keys.index(k) + 1) % len(keys)]]
        n = len(t) // 4
        new = t if k is None else t[: len(t) - n] + after[:n]
        out.append((k, len(t), hashlib.sha256(new.encode()).hexdigest(), float(fold(new) == fold(t)), float(k is not None and fold(after) == fold(t)), sum(fold(u or "") == fold(t) for q, u in rows if q is not None)))
    return sorted(out, key=str)


def test_edited_texts_of_repeated_rows(spark):
    """Every row gives one, whatever keys and texts repeat."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    rows += rows[:5] + [(rows[7][0], "another text"), (rows[9][0], None), (-3, ""), (10**12, "ends"), (10**12, "Ends")]
    found = fingerprints.edited(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next, r.n_copies) for r in found], key=str) == brute_edited(rows)


def test_edited_texts_without_keys(spark):
    found = fingerprints.edited(spark.createDataFrame([(None, "some text"), (None, None), (1, "abcdefgh")], "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.near_edited, r.near_next) for r in found) == [("1", 0.0, 1.0), ("None", 1.0, 0.0), ("None", 1.0, 0.0)]
    assert fingerprints.edited(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_bytes_are_compared_in_equal_buckets(spark, monkeypatch):
    """With a hash that always collides, classes are those of equal canonical texts."""
    monkeypatch.setattr(fingerprints, "wide_hash", lambda text: F.lit("0" * 32))
    texts = ["A b", "a  B", "other", None, "x", "other", ""]
    found = {r.doc_id: (r.class_id, r.n_copies) for r in fingerprints.edited(frame(spark, texts)).collect()}
    assert found == {0: (0, 2), 1: (0, 2), 2: (2, 2), 3: (3, 2), 4: (4, 1), 5: (2, 2), 6: (3, 2)}


# --- tokens


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())


def some_texts(seed, n):
    rng = random.Random(seed)
    alphabet = [*"aehtoinrs ▁12.,AÉß日\n\t", "th", "in", "er", "the", " ", " the "]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 120))) for _ in range(n)]


def test_counts_and_ids_are_the_librarys(library):
    texts = [t for t in ODD if t is not None] + some_texts(1, 300)
    model, counter = pieces.load(pieces.default_path()), token_counts.counter(pieces.default_path())
    encoder = sentencepiece_scan.encoder(pieces.default_path())
    assert counter.count_all(texts) == [len(library.encode(t)) for t in texts]
    found = encoder.encode_all([*texts, None])
    assert found[-1] is None
    for t, ids in zip(texts, found, strict=False):
        assert np.frombuffer(ids, "<i4").tolist() == library.encode(t)
        assert sentencepiece_scan.decode_ids(model, ids) == t.replace("▁", " ")


def test_prefixes_and_budgets(library):
    counter = token_counts.counter(pieces.default_path())
    for t in some_texts(2, 40):
        want = [len(library.encode(t[:i])) for i in range(len(t) + 1)]
        assert counter.prefixes(t) == want
        for budget in (0, 3, 17):
            assert counter.fits(t, budget) == max(i for i, n in enumerate(want) if n <= budget)


def test_chunked_scan_is_whole(library):
    encoder, rng = sentencepiece_scan.encoder(pieces.default_path()), random.Random(3)
    texts = [t for t in some_texts(4, 60) if len(t) > 70] + ["".join(rng.choice("abcdefgh") for _ in range(900)), "thing" * 200, " " * 300 + "ab", ("ab" + " " * 70) * 6, "the " * 300]
    for t in texts:
        ids = np.frombuffer(sentencepiece_scan.encode_long(encoder, t, rng.randint(70, 200)), "<i4").tolist()
        assert ids == library.encode(t)


def test_scan_inside_a_batch(library):
    """Texts of several chunks, of one, without a unit's end and null, together."""
    encoder, rng = sentencepiece_scan.encoder(pieces.default_path()), random.Random(8)
    texts = [*some_texts(9, 40), None, "", "thing" * 90, " " * 200, "a " * 300, *(" ".join(rng.choice(["the", "there", "ninth", "é", "日本", " "]) for _ in range(rng.randint(50, 400))) for _ in range(30))]
    assert sum(t is not None and len(t) > 70 for t in texts) > 40
    for chunk in (70, 130, 4096):
        found = encoder.encode_scanned(texts, chunk)
        assert [None if x is None else np.frombuffer(x, "<i4").tolist() for x in found] == [None if t is None else library.encode(t) for t in texts]


def test_the_query_scans_an_ordinary_share_of_texts(spark):
    long = [r.n for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(F.length("text").alias("n")).collect()]
    assert sum(n > sentencepiece_scan.CHUNK for n in long) > 0.1 * len(long)


def test_matrices_combine_associatively():
    encoder = sentencepiece_scan.encoder(pieces.default_path())
    t = " " + "internationalisation" * 20
    cuts = sentencepiece_scan.cuts_of(t, 70)
    a, b, c, *_ = (encoder.matrix(t, x, y) for x, y in zip(cuts, cuts[1:], strict=False))
    combine = sentencepiece_scan.combine
    assert combine(combine(a, b), c) == combine(a, combine(b, c))


def test_unigram_scan_has_the_best_score():
    model = pieces.Model(pieces.default_path(), "unigram")
    encoder, rng = sentencepiece_scan.Encoder(model), random.Random(5)
    for _ in range(60):
        t = " ".join("".join(rng.choice("thenrioda") for _ in range(rng.randint(1, 9))) for _ in range(40))
        assert encoder.encode(t) == sentencepiece_scan.encode_long(encoder, t, 70)


@pytest.mark.parametrize("giant", [10_000, 1_000_000])
def test_encode_table(spark, library, giant):
    """Long texts' chunks in many tasks, and in one."""
    texts = [*ODD, "long word " * 3000, "nospace" * 3000, "long word " * 3000]
    df = frame(spark, texts, ids=["clash"] * len(texts))
    out = {r.doc_id: r for r in sentencepiece_scan.decode(sentencepiece_scan.encode(df, chunk=4000, giant=giant, giant_chunk=4000, check="same")).collect()}
    for i, t in enumerate(texts):
        if t is None:
            assert out[i].ids is None and out[i].decoded is None and out[i].same is None
        else:
            assert out[i].ids == library.encode(t) and out[i].decoded == t.replace("▁", " ") and out[i].same
    assert sentencepiece_scan.encode(df.limit(0)).count() == 0


def test_count_table(spark, library):
    out = {r.doc_id: r for r in token_counts.with_counts(frame(spark, ODD), budget=4).collect()}
    for i, t in enumerate(ODD):
        assert out[i].n_tokens == len(library.encode(t or "")) and len(library.encode((t or "")[: out[i].fits_chars])) <= 4


# --- language


def test_gradient():
    net, rng = language_id.Network.start(["a", "b", "c"], hidden=4), np.random.default_rng(0)
    net.cells = [[c.astype(np.float64) for c in k] for k in net.cells]
    net.out = [o.astype(np.float64) for o in net.out]
    x, y, w = rng.integers(0, 256, (6, 5)), np.array([0, 1, 2, 0, 1]), np.ones(5)
    _, grads = net.learn(x, y, w)
    for p, g in zip(net.parameters(), grads, strict=True):
        for _ in range(5):
            at = tuple(int(rng.integers(0, n)) for n in p.shape)
            if p.shape[1] == 256:
                at = (at[0], int(x[rng.integers(0, 6), rng.integers(0, 5)]))
            old = p[at]
            values = []
            for step in (1e-2, -1e-2):
                p[at] = old + step
                values.append(net.learn(x, y, w)[0])
            p[at] = old
            assert abs((values[0] - values[1]) / 2e-2 - g[at]) < 1e-4


def test_probabilities_are_brute_forces():
    """Byte by byte, in plain Python, the gates written out."""
    net = language_id.fit(["the cat and the dog " * 9, "der hund und die katze " * 9, "le chien et la chatte " * 9] * 20, ["en", "de", "fr"] * 20)
    sigmoid = lambda v: 1 / (1 + np.exp(-v))

    def states(cell, data):
        rows, weights, bias = (np.asarray(c, float) for c in cell)
        n = weights.shape[1]
        h, out = np.zeros(n), []
        for b in data:
            z = sigmoid(rows[:n, b] + weights[:n] @ h)
            r = sigmoid(rows[n : 2 * n, b] + weights[n : 2 * n] @ h)
            c = np.tanh(rows[2 * n :, b] + r * (weights[2 * n :] @ h + bias[:, 0]))
            h = z * h + (1 - z) * c
            out.append(h)
        return out

    def brute(text):
        total = np.zeros(len(net.languages))
        for a in range(0, len(text), language_id.STEPS):
            part = text[a : a + language_id.STEPS]
            window = part.ljust(language_id.STEPS)
            both = [np.concatenate(x) for x in zip(states(net.cells[0], window), states(net.cells[1], window[::-1])[::-1], strict=True)]
            for x in both[: len(part)]:
                e = np.exp(net.out[0].astype(float) @ x + net.out[1][:, 0])
                total += e / e.sum()
        return total / len(text)

    texts = [t.encode() for t in ("the", "und die Katze schläft " * 5, "x" * 48, "la chatte et le chien, " * 30, "é")]
    assert np.allclose(net.probabilities(texts), [brute(t) for t in texts], atol=1e-4)


def test_rare_languages_are_learned(spark):
    """Languages that a sample of all rows would hardly hold, among them over 256 that have a row each."""
    rows = [(i, "the cat and the dog " * 3, "en") for i in range(4000)] + [(10_000 + i, "der hund und die katze " * 3, "de") for i in range(150)]
    net = language_id.train(spark.createDataFrame([*rows, (1, None, "none"), (2, "12 34", "digits")], "doc_id long, text string, lang string"))
    assert net.languages == ["de", "en"] and net.probabilities([b"der hund und die katze " * 3])[0].argmax() == 0
    many = language_id.train(spark.createDataFrame([(i, f"text {i}", f"l{i:03}") for i in range(900)], "doc_id long, text string, lang string"))
    assert len(many.languages) > 256


def test_language_accuracy_and_odd_texts(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    net = language_id.train(documents)
    out = language_id.predict(documents, net).where(language_id.held_out(F.col("doc_id"))).collect()
    assert np.mean([r.lang == r.lang_pred for r in out]) > 0.95 and all(0 <= r.score <= 1 for r in out)
    odd = {r.doc_id: r for r in language_id.predict(frame(spark, [*ODD, "123 !!"]), net).collect()}
    assert all(odd[i].lang_pred == "und" and odd[i].score == 0 for i in (0, 1, 2, 3, len(ODD)))
    assert odd[4].lang_pred in net.languages
    assert language_id.train(documents.limit(0)) is None
    assert {r.lang_pred for r in language_id.predict(frame(spark, ["hello"]), None).collect()} == {"und"}


def test_prediction_does_not_depend_on_neighbours():
    net = language_id.fit(["the cat and the dog " * 9, "der hund und die katze " * 9] * 30, ["en", "de"] * 30)
    one, two = b"the dog und", b"x" * 1000
    assert np.allclose(net.probabilities([one])[0], net.probabilities([two, one, two])[1], atol=1e-5)


# --- toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_automaton_is_edit_distance():
    terms, rng = ["moron", "scum", "disgusting", "pathetic"], random.Random(2)
    auto = toxicity.compile_lexicon(terms, ["lowei"])
    words = [*terms, "loweix", "alowei", ""]
    for t in terms * 60:
        w = list(t)
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(3)
            at = rng.randrange(len(w) + 1)
            if k == 0:
                w.insert(at, rng.choice("abmoz"))
            elif w and k == 1:
                w.pop(min(at, len(w) - 1))
            elif w:
                w[min(at, len(w) - 1)] = rng.choice("abmoz")
        words.append("".join(w))
    for w in words:
        near = [distance(w, t) for t in terms if distance(w, t) <= toxicity.edits(t)]
        found = toxicity.hits(auto, w)
        if w.startswith("lowei"):
            assert [x[3] for x in found] == ["stem"]
        else:
            assert [x[2] for x in found] == ([min(near)] if near and w else [])


def test_quotation():
    text = 'he said "you moron" and left'
    at = text.index("moron")
    assert toxicity.quoted(text, at, at + 5)
    assert not toxicity.quoted("you moron go away", 4, 9)


def test_toxicity_on_held_out_rows(spark):
    path = "/root/testdata/sf0.1"
    out = toxicity.op10_toxicity(spark, path).join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id").where("held_out").collect()
    tp = sum(r.predicted and r.toxic for r in out)
    assert tp / sum(r.toxic for r in out) > 0.8 and tp / sum(r.predicted for r in out) > 0.8
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)


def test_toxicity_of_odd_texts(spark):
    model = toxicity.fit(["you moron", "hello there", "what a moron indeed", "nice day"] * 1 + [f"moron number {i} x{i}" for i in range(20)] + [f"clean text {i}" for i in range(60)], [1, 0, 1, 0] + [1] * 20 + [0] * 60)
    assert model.score("such a moron") > 0.5 > model.score("such a day") and model.score("moronn") > 0.3
    assert model.score(None) == model.score("") == model.score("nothing")
    out = toxicity.score(frame(spark, ODD, score=["clash"] * len(ODD)), model).collect()
    assert len(out) == len(ODD) and all(0 <= r.score <= 1 for r in out)
    assert toxicity.fit(["a"], [0]).score("moron") == 0


def test_scores_are_brute_forces():
    """Every word against every term, by edit distance; the context by words before and after."""
    rng, clean = random.Random(2), "plain words make a calm text about nothing much here today".split()
    bad = ["moron", "worthless", "scumbag"]
    texts = [" ".join(rng.choice(clean) for _ in range(20)) for _ in range(80)]
    toxic = [f"{' '.join(rng.choice(clean) for _ in range(9))} {rng.choice(bad)} {rng.choice(['', 'said moron here', 'vorthless', 'oworthles'])}" for _ in range(60)]
    model = toxicity.fit([*texts, *toxic], [0] * 80 + [1] * 60)
    assert set(bad) <= {*model.terms} and not model.stems

    def brute(text):
        counts, words = [0, 0, 0, 0], [*toxicity.TOKEN.finditer(text.lower())]
        for m in words:
            near = [d for t in model.terms if (d := distance(m[0], t)) <= (0 if t in model.exact else toxicity.edits(t))]
            if not near or min(near) and m[0] in model.clean:
                continue
            counts[3 if toxicity.quoted(text.lower(), m.start(), m.end()) else 1 if min(near) else 0] += 1
        x = [1.0, *np.log1p(counts), min(1.0, 20 * sum(counts[:3]) / max(1, text.count(" ") + 1))]
        return 1 / (1 + np.exp(-np.clip(np.dot(model.weights, x), -30, 30)))

    for t in [*texts[:5], *toxic[:20], "you wortless moron", "he said moron", "a « moron » here", "", "calm", "morons moronic mron MORON"]:
        assert abs(model.score(t) - brute(t)) < 1e-9, t


def test_lexicons_of_small_samples(spark):
    """A few dozen toxic rows teach the terms; words that chance puts there are no terms."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(4, 6)))
    common = [word() for _ in range(1500)]
    text = lambda: " ".join(rng.choice(common) for _ in range(120))
    bad = ["scoundrel", "villain", "wretch"]
    terms, stems, *_ = toxicity.mine([*(text() for _ in range(300)), *(f"{text()} {rng.choice(bad)} {rng.choice(bad)}" for _ in range(36))], [False] * 300 + [True] * 36)
    assert sorted(terms) == bad and not stems


def test_bytes_sent_to_fit_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "FIT_BYTES", 8000)
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, labels: seen.append((texts, labels)))
    rows = [(i, "x" * (5000 if i % 10 == 0 else 100), i % 4 == 0) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic boolean")
    toxicity.train(df.select("doc_id", "text"), df.select("doc_id", F.col("toxic").cast("int").alias("toxic")))
    ((texts, labels),) = seen
    assert 4000 < sum(map(len, texts)) <= 8000 and max(map(len, texts)) == 100 and {*labels} == {0, 1}


def test_quality_sql_gives_the_same_rows(spark):
    import duckdb

    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    theirs = {r[0]: r[1:] for r in duckdb.sql(f"SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, char_distance, word_distance FROM ({quality.oracle()})").fetchall()}
    ours = {r[0]: tuple(r)[1:] for r in quality.op2_quality_rules(spark, DATA).collect()}
    assert ours == theirs


def test_rare_words_take_little_memory():
    """Words of one text each, as most are: some hundred bytes for each of their stems, not a set."""
    import tracemalloc

    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9))
    texts = [" ".join([word() for _ in range(600)] + ["scoundrel"] * (i < 40)) for i in range(80)]
    tracemalloc.start()
    terms, *_ = toxicity.mine(texts, [i < 40 for i in range(80)])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert terms == ["scoundrel"] and peak < 80_000 * 300
