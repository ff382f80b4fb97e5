"""Token counts, codec, main texts, fingerprints of texts, quality: against libraries and plain versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from tallymill.llm import bpe_codec, html_text, line_quality, mixing, prefix_hashes, token_counts
from tallymill.llm.queries import QUERIES
from tallymill.llm.vocabulary import default_path
from tests.conftest import SMALL

ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "a" * 3000), (5, "<|endoftext|> and <|startoftext|>x<|endoftext|"), (6, "don't WE'LL ΑΣ é é ß"),
    (7, "12345 67\x85\xa0x\x1c\x0by 😀😀"), (8, "\n\n\n  a  b"), (8, "\n\n\n  a  b"), (None, "no id"), (9, "x " * 5000),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "clash", 1) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, id string, n_tokens int").repartition(3)


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def library(name):
    tokenizer = Tokenizer.from_file(default_path(name))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def test_token_counts_are_those_of_the_library(spark, texts, odd):
    count = lambda t: len(library_50k.encode(t or "", add_special_tokens=False).ids)
    library_50k = library("byte_bpe_50k.json")
    for row in QUERIES["op5_token_counts"](spark, SMALL).collect():
        text = texts[row.doc_id]
        assert (row.n_bytes, row.n_tokens) == (len(text.encode()), count(text))
        assert row.over_limit == (row.n_tokens > 1024)
    found = token_counts.token_counts(odd).collect()
    expected = [(i, len((t or "").encode()), count(t), count(t) > 1024) for i, t in ODD]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert token_counts.token_counts(odd.limit(0)).collect() == []


def test_codec_is_that_of_the_library(spark, texts, odd):
    tokenizer = library("word_bpe_49k.json")

    def expected(t):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        return ids, tokenizer.decode(ids, skip_special_tokens=False)

    for row in QUERIES["op10_bpe_codec"](spark, SMALL).collect():
        ids, decoded = expected(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    found = [(r.doc_id, bytes(r.ids), r.decoded) for r in bpe_codec.encoded(odd).collect()]
    plain = [(i, np.array(expected(t)[0], "<u4").tobytes(), expected(t)[1]) for i, t in ODD]
    assert sorted(found, key=repr) == sorted(plain, key=repr)
    coder = bpe_codec.codec(default_path("word_bpe_49k.json"))
    assert coder.decode(expected("some words here")[0]) == expected("some words here")[1]
    assert bpe_codec.digests(odd.limit(0)).collect() == []


def plain_article(page):
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    import html

    parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<br>", " ", body))
    return "\n".join(x for x in (re.sub(r"\s+", " ", html.unescape(p)).strip() for p in parts) if x)


def test_main_texts_are_the_articles(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    rows = QUERIES["op4_html_text"](spark, SMALL).collect()
    assert len(rows) == len(pages)
    for row in rows:
        assert row.text == plain_article(pages[row.page_id].html)
        assert row.url == pages[row.page_id].url and row.n_chars == len(row.text)


def test_main_texts_of_other_pages(spark):
    around = "<nav><a href=/>Home</a></nav><div class='sidebar'>many words stand beside the story here</div>"
    story = "<h2>Story &amp; more</h2><p>First <i>para</i>\n graph.<div class=ad>Buy</div><p>Of.<form><input>Go</form><p>Third &#233;"
    after = "<section id='comments'><p>I liked it very much said a reader</p></section><footer>Foot words</footer>"
    expected = "Story & more\nFirst para graph.\nOf.\nThird é"
    pages = [
        (1, f"<body>{around}<article>{story}</article>{after}</body>", expected),
        (2, f"<body>{around}<main>{story}{after}</main></body>", expected),
        (3, f"<body>{around}<div id=content>{story}</div>{after}</body>", expected),
        (4, None, ""), (5, "", ""), (6, "<script>var a='<p>x</p>'</script><!-- y --><style>p{}</style>", ""),
        (7, "just words", "just words"), (8, "a < b <p>c", "a < b\nc"), (9, "<article><p>open", "open"), (9, "<article><p>open", "open"),
        (None, "<p>x</p>" * 3, "x\nx\nx"),
    ]
    df = spark.createDataFrame([(i, None, h, "clash") for i, h, _ in pages], "page_id long, url string, html string, id string")
    found = sorted([(r.page_id, r.text, r.n_chars) for r in html_text.extracted(df).collect()], key=repr)
    assert found == sorted([(i, t, len(t)) for i, _, t in pages], key=repr)
    assert html_text.extracted(df.limit(0)).collect() == []


PARAGRAPH = "This paragraph has rather more words than its heading has, as paragraphs do."


@pytest.mark.parametrize(
    "page, expected",
    [
        (f"<article><h1>Introduction</h1><p>{PARAGRAPH}</article>", f"Introduction\n{PARAGRAPH}"),
        (f'<div class="layout has-sidebar"><article><p>{PARAGRAPH}</article></div>', PARAGRAPH),
        (f'<div class="sidebar"><main><p>{PARAGRAPH}</main></div><footer>Foot</footer>', PARAGRAPH),
        (f'<div class="no-sidebar"><main><p>{PARAGRAPH}</main></div>', PARAGRAPH),
        (f'<form id="aspnetForm"><div class="sidebar">Side words</div><main><p>{PARAGRAPH}</main></form>', PARAGRAPH),
        (f'<article><h2 id="legal">Legal history</h2><p>{PARAGRAPH}</article>', f"Legal history\n{PARAGRAPH}"),
        (f'<article><p class="notice-of-motion">A notice.</p><p>{PARAGRAPH}</article>', f"A notice.\n{PARAGRAPH}"),
        (f'<article><p class="notice">We use cookies.</p><p>{PARAGRAPH}<div class="ad-box"><p>Buy now</div><p>End.</article>', f"{PARAGRAPH}\nEnd."),
        (f'<div class="sidebar" id="nav">{PARAGRAPH} {PARAGRAPH}</div><p>Short but not so short.', f"{PARAGRAPH} {PARAGRAPH}\nShort but not so short."),
        (f'<article><p>{PARAGRAPH}</article><aside><article><p>A card of another story.</article></aside>', PARAGRAPH),
        (f'<article><p>{PARAGRAPH}<p hidden>Not seen.<p style="Display : none">Nor this.<script>if (a<b) "</p>"</script><p>seen</article>', f"{PARAGRAPH}\nseen"),
        ('<article><p title="a > b">1 < 2 &lt; 3 <3 <a href=x>y</a\n>z<!-- > --><b>w</b>!</article>', "1 < 2 < 3 <3 yzw!"),
        ("<article><ul><li>one<li>two</ul><p>a<br>b</p>c</article> outside", "one\ntwo\na b\nc"),
    ],
)
@pytest.mark.parametrize("learnt", [True, False])
def test_main_texts_keep_what_is_inside(page, expected, learnt):
    weight = html_text.weights({})
    if learnt:
        pages = [r for r in pages_of("sf0.01")]
        total = Counter()
        for html in pages:
            total.update(html_text.counts(html))
        weight = html_text.weights(total)
    assert html_text.main_text(page, weight) == expected


def pages_of(scale):
    import duckdb

    return [r[0] for r in duckdb.sql(f"SELECT html FROM '{SMALL.replace('sf0.001', scale)}/pages.parquet'").fetchall()]


def test_pages_that_do_not_mark_their_article():
    pages = pages_of("sf0.01")
    total = Counter()
    for html in pages[:125]:
        total.update(html_text.counts(html))
    weight = html_text.weights(total)
    unmarked = [re.sub(r"<(/?)(article|main)\b", r"<\1div", html) for html in pages[125:]]
    right = [html_text.main_text(html, weight) == plain_article(marked) for html, marked in zip(unmarked, pages[125:])]
    assert np.mean(right) > 0.9


def test_features_are_weighed_by_where_they_are_seen():
    # Where a word for menus names the layout of articles, and another class the menus, the pages are believed.
    story = "<article><div class='toc story'><p>" + "word " * 30 + "</p></div></article>"
    total = Counter()
    for i in range(40):
        total.update(html_text.counts(f"<div class='blob'>menu words {i}</div>{story}<div class='blob'>more</div>"))
    weight = html_text.weights(total)
    assert weight["@toc"] > 0 > weight["@blob"]
    page = html_text.Page(f"<div class='blob'>menu words</div><div class='toc'>a few words</div><p>{PARAGRAPH}")
    assert [b.text for b in page.blocks(weight)] == ["a few words", PARAGRAPH]
    assert [b.text for b in page.blocks(html_text.weights({}))] == ["menu words", PARAGRAPH]


@pytest.mark.parametrize(
    "hostile",
    [
        lambda n: '<a "' * n, lambda n: "<div><b>" * n + "</i>" * n, lambda n: "<a " * n, lambda n: '<a x="' * n, lambda n: "<!--" * n,
        lambda n: "<script>" * n, lambda n: "<u><div>" + "<b>" * n + "</u>" * n, lambda n: "<" * n, lambda n: "</" * n, lambda n: "<p class=ad>" * n,
        lambda n: "<nav>" * n + "<article>" * n + "</nav>" * n, lambda n: "<a" + " b=c" * n + ">", lambda n: "<p>" + "&amp" * n, lambda n: "<a  " + " " * n,
        lambda n: "<textarea></script>" * n, lambda n: "<![CDATA[" * n, lambda n: "<aside><article>x" * n,
    ],
)
def test_time_is_linear_in_the_page(hostile):
    import time

    def seconds(n):
        start = time.perf_counter()
        html_text.main_text("<p>text</p>" + hostile(n), {"": 1.0})
        return time.perf_counter() - start

    seconds(100)
    short, long = (min(seconds(n) for _ in range(2)) for n in (8_000, 64_000))
    assert long < 0.2 or long < 24 * short


def plain_best_run(gains):
    sums = [(sum(gains[a:b]), a, b) for a in range(len(gains)) for b in range(a + 1, len(gains) + 1)]
    return max(sums, default=(0, 0, 0), key=lambda x: x[0])[0]


def test_the_scan_finds_the_best_run():
    draw = random.Random(2)
    weight = {"": 1.0, "p": -0.5, "div": -4.0, "-": -0.01}
    for _ in range(300):
        page, gains = "", []
        for _ in range(draw.randrange(1, 9)):
            tags, words = draw.choice([["p"], ["div"], ["div", "div"], ["div", "p"]]), draw.randrange(1, 8)
            page += "".join(f"<{t}>" for t in tags) + " ".join(["w"] * words)
            gains += [sum(weight[t] for t in tags), float(words)]
        best = plain_best_run(gains)
        text = html_text.main_text(page, weight)
        counted = len(text.split())
        assert counted > 0
        blocks = html_text.Page(page).blocks(weight)
        runs = [
            (sum(b.words for b in blocks[i:j]) + sum(weight[t] for b in blocks[i + 1 : j] for t in b.tags), "\n".join(b.text for b in blocks[i:j]))
            for i in range(len(blocks)) for j in range(i + 1, len(blocks) + 1)
        ]
        assert max(r for r, _ in runs) == pytest.approx(best)
        assert any(t == text and r == pytest.approx(best) for r, t in runs)


def test_spans_and_extensions():
    draw = random.Random(5)
    for _ in range(60):
        a = "".join(draw.choice("abé😀") for _ in range(draw.randrange(0, 60)))
        b = "".join(draw.choice("abé😀") for _ in range(draw.randrange(0, 60)))
        one, other = prefix_hashes.PrefixHash(a), prefix_hashes.PrefixHash(b)
        for _ in range(20):
            i, j = draw.randrange(len(a) + 1), draw.randrange(len(b) + 1)
            n = draw.randrange(6)
            fits = i + n <= len(a) and j + n <= len(b)
            assert one.equal(i, other, j, n) == (fits and a[i : i + n] == b[j : j + n])
            longest = 0
            while i + longest < len(a) and j + longest < len(b) and a[i + longest] == b[j + longest]:
                longest += 1
            assert one.common_extension(i, other, j) == longest


def plain_fingerprint(text):
    """The hash of the text and the least span hash of each bin, from the code points alone, in whole numbers."""
    primes, bases = (2147483647, 2147483629), (911382323, 972663749)
    points = [ord(c) + 1 for c in text]
    whole = "".join(f"{sum(c * pow(b, i, p) for i, c in enumerate(points)) % p:08x}" for p, b in zip(primes, bases)) + f"{len(points):08x}"
    least, n = {}, min(12, len(points))
    for start in range(len(points) - n + 1 if points else 0):
        span = sum(c * pow(bases[0], i, primes[0]) for i, c in enumerate(points[start : start + n])) % primes[0]
        # A span's hash starts at power 0, taken back from the power of the text's last place.
        x = (span << 32) + n
        x = x * 0x9E3779B97F4A7C15 % 2**64
        x ^= x >> 29
        x = x * 0xBF58476D1CE4E5B9 % 2**64
        x ^= x >> 32
        least[x % 64] = min(x, least.get(x % 64, x))
    return whole + "".join(f"{min(least[b] >> 8 & 0xFFFF, 0xFFFE) if b in least else 0xFFFF:04x}" for b in range(64))


def plain_likeness(one, other):
    if one == other:
        return 1.0
    bins = [(one[i : i + 4], other[i : i + 4]) for i in range(24, 280, 4)]
    full = [a == b for a, b in bins if (a, b) != ("ffff", "ffff")]
    return sum(full) / len(full) if full else 0.0


def same_start(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def check_fingerprints(rows, found):
    """``rows`` in the order that counts; ``found`` in any order. Nothing of the code under test is used."""
    marks = {}
    mark_of = lambda t: marks.get(t) or marks.setdefault(t, plain_fingerprint(t))
    expected = []
    for (name, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        mark, new, following = mark_of(text), mark_of(changed), mark_of(after)
        digest = hashlib.sha256(changed.encode()).hexdigest()
        expected.append((
            name, len(text), digest, mark, new, plain_likeness(mark, new), plain_likeness(mark, following),
            same_start(text, changed), same_start(text[::-1], changed[::-1]), same_start(text, after), same_start(text[::-1], after[::-1]),
        ))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_fingerprints_of_documents(spark, texts, odd):
    rows = QUERIES["op9_prefix_hashes"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    few = {i: t for i, t in texts.items() if len(t) < 3000}
    docs = spark.createDataFrame(list(few.items()), "doc_id long, text string").repartition(4)
    check_fingerprints(sorted(few.items(), reverse=True), prefix_hashes.compared(docs).collect())
    for row in rows:
        assert 0 <= row.near_edited <= 1
    assert np.mean([r.near_edited for r in rows]) > 0.25 > 0.05 > np.mean([r.near_next for r in rows])
    some = [(i, t or "") for i, t in ODD]
    order = sorted([r for r in some if r[0] is not None], key=lambda r: -r[0]) + [(None, "no id")]
    check_fingerprints(order, prefix_hashes.compared(odd).collect())
    check_fingerprints([(1, "alone")], prefix_hashes.compared(spark.createDataFrame([(1, "alone")], "doc_id long, text string")).collect())
    assert prefix_hashes.compared(odd.limit(0)).collect() == []
    assert prefix_hashes.fingerprints(odd).count() == len(ODD)


def test_likeness_follows_the_share_of_spans(texts):
    for text in list(texts.values())[:60]:
        cut = text[: len(text) * 3 // 4]
        spans = lambda t: {t[i : i + 12] for i in range(max(1, len(t) - 11))}
        share = len(spans(text) & spans(cut)) / len(spans(text) | spans(cut))
        assert abs(prefix_hashes.likeness(prefix_hashes.fingerprint(text), prefix_hashes.fingerprint(cut)) - share) < 0.3
        assert prefix_hashes.likeness(prefix_hashes.fingerprint(text), prefix_hashes.fingerprint(text)) == 1


def plain_marginals(good, steps):
    """Probabilities by adding up all labellings of one text."""
    from itertools import product

    n, total, marks = len(good), 0.0, np.zeros(len(good))
    for labels in product((0, 1), repeat=n):
        weight = np.exp(sum(g for g, y in zip(good, labels) if y) + sum(steps[a, b] for a, b in zip(labels, labels[1:])))
        total += weight
        marks += weight * np.array(labels)
    return marks / total


def test_marginals_equal_all_labellings():
    draw = np.random.default_rng(3)
    lengths = np.array([3, 1, 6, 4, 1])
    good, steps = draw.normal(size=lengths.sum()) * 2, draw.normal(size=(2, 2))
    found, _, log_sum = line_quality.marginals(good, steps, lengths)
    ends = np.cumsum(lengths)
    for text, (n, end) in enumerate(zip(lengths, ends)):
        part = good[end - n : end]
        assert np.allclose(found[end - n : end], plain_marginals(part, steps))
        from itertools import product

        each = [sum(g for g, y in zip(part, labels) if y) + sum(steps[a, b] for a, b in zip(labels, labels[1:])) for labels in product((0, 1), repeat=n)]
        assert np.isclose(log_sum[text], np.log(np.exp(each).sum()))


def test_the_gradient_is_that_of_the_likelihood(texts):
    draw = np.random.default_rng(5)
    bins, _, per_text = line_quality.line_bins([t.encode()[:4000] for t in list(texts.values())[:12]])
    places = line_quality.feature_places(bins, per_text)
    chains = per_text.reshape(6, 2).sum(axis=1)
    labels = draw.integers(0, 2, per_text.sum()).astype(float)
    weight = draw.random(6)
    point, steps = draw.normal(size=line_quality.FEATURES) * 0.2, draw.normal(size=(2, 2))
    at = lambda w, s: line_quality.likelihood(w, s, places, chains, labels, weight, 0.7)
    _, gradient, step_gradient = at(point, steps)
    for place in [*np.unique(places)[::9], line_quality.FEATURES - 1]:
        change = np.zeros_like(point)
        change[place] = 1e-5
        assert np.isclose((at(point + change, steps)[0] - at(point - change, steps)[0]) / 2e-5, gradient[place], atol=1e-4)
    for place in range(4):
        change = np.zeros(4)
        change[place] = 1e-5
        change = change.reshape(2, 2)
        assert np.isclose((at(point, steps + change)[0] - at(point, steps - change)[0]) / 2e-5, step_gradient.flat[place], atol=1e-4)


def plain_bins(text):
    """The measures of a text's lines, line by line, and where each lies among its edges."""
    from bisect import bisect_right

    seen, rows = set(), []
    for line in text.split(b"\n"):
        words = re.findall(rb"[^ \t\n\r\x0b\x0c]+", line)
        chars = max(sum(not 0x80 <= b < 0xC0 for b in line), 1)
        share = lambda found: sum(b in found for b in line) / chars
        symbols = set(range(0x21, 0x7F)) - set(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789.,;:?'\"()-")
        each = max(len(words), 1)
        key = tuple(sorted(words))
        measures = {
            "bytes": len(line), "words": len(words), "upper": share(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "digit": share(b"0123456789"),
            "symbol": share(symbols), "stop": share(b".,;:?"), "wide": share(range(0xC0, 0x100)),
            "word_length": sum(not 0x80 <= b < 0xC0 for w in words for b in w) / each,
            "marked_words": sum(len(w) > 1 and w[-1] in symbols for w in words) / each,
            "bare_symbols": sum(len(w) == 1 and w[0] in symbols for w in words) / each,
            "same_as_last": sum(a == b for a, b in zip(words, words[1:])) / each,
            "distinct": len(set(words)) / each, "seen_before": float(bool(words) and key in seen),
        }
        seen.add(key)
        rows.append([bisect_right(line_quality._EDGES[name], value) for name, value in measures.items()])
    return rows


def test_line_features_equal_counting_line_by_line(texts):
    every = [t.encode() for t in list(texts.values())[::5]]
    every += [b"", b"\n\n", "Été !\nété ! é\n\n 12 # ab# \n#".encode(), b"a a a b\nb a a a\n(x) 'y'\tz\x01"]
    bins, size, per_text = line_quality.line_bins(every)
    assert size.tolist() == [len(line) for t in every for line in t.split(b"\n")]
    assert per_text.tolist() == [t.count(b"\n") + 1 for t in every]
    assert bins.tolist() == [row for t in every for row in plain_bins(t)]
    own = line_quality.feature_places(bins, per_text)
    assert own.shape[1] == 3 * bins.shape[1] + 1 and own.max() < line_quality.FEATURES


@pytest.fixture(scope="module")
def labelled_texts():
    import duckdb
    import zlib

    folder = SMALL.replace("sf0.001", "sf0.1")
    rows = duckdb.sql(
        f"SELECT d.doc_id, text, quality FROM '{folder}/documents.parquet' d JOIN '{folder}/labels.parquet' l ON d.doc_id = l.doc_id ORDER BY sha256(CAST(d.doc_id AS VARCHAR))"
    ).fetchall()
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    return [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2][:2000], held


def test_the_chain_tells_lines_of_mixed_texts_better_than_lines_alone(labelled_texts):
    known, held = labelled_texts
    model = line_quality.fit([t.encode() for _, t, _ in known], [y for *_, y in known])
    alone = line_quality.Model(model.weights, np.zeros((2, 2)), model.slope, model.offset)
    draw = random.Random(1)
    kinds = [[t.split("\n") for _, t, y in held if y == kind and t.count("\n") >= 3] for kind in (0, 1)]
    mixed = []
    for _ in range(400):
        halves = [[(line, kind) for line in draw.choice(kinds[kind])[: draw.randrange(2, 12)]] for kind in (0, 1)]
        mixed.append(sum(halves if draw.random() < 0.5 else halves[::-1], []))
    bins, _, per_text = line_quality.line_bins(["\n".join(line for line, _ in m).encode() for m in mixed])
    places, truth = line_quality.feature_places(bins, per_text), np.array([kind for m in mixed for _, kind in m])
    right = [
        np.mean((line_quality.marginals(m.weights[places].sum(axis=1), m.steps, per_text)[0] > 0.5) == truth) for m in (model, alone)
    ]
    assert right[0] > 0.94 and right[0] > right[1] + 0.003
    scores = line_quality.scores(model, [t.encode() for _, t, _ in held])
    assert np.mean((scores >= 0.7) == np.array([y for *_, y in held])) > 0.99


def test_a_very_long_labelled_text_keeps_no_other_out(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality")
    before = line_quality.train(docs, labels)
    ids = list(range(2_000_000, 2_000_030))
    long = spark.createDataFrame([(i, "word " * 60_000) for i in ids], "doc_id long, text string")
    more = labels.unionByName(spark.createDataFrame([(i, 1) for i in ids], labels.schema))
    after = line_quality.train(docs.unionByName(long), more)
    assert np.array_equal(before.weights, after.weights) and before.slope == after.slope != 0
    few = line_quality.train(docs, labels, max_bytes=20_000)
    assert few.slope != 0


def test_quality_on_held_out_documents(spark, texts, odd):
    folder = SMALL.replace("sf0.001", "sf0.01")
    rows = {r.doc_id: r for r in QUERIES["op1_line_quality"](spark, folder).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [(rows[i], y) for i, y in labels.items() if i in rows and rows[i].held_out]
    assert len(held) > 50
    assert np.mean([r.predicted == y for r, y in held]) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())
    # Nothing but the text counts: other ids and sources, the same scores.
    labelled = spark.read.parquet(f"{folder}/labels.parquet")
    found = line_quality.quality(odd, labelled.limit(0)).collect()
    assert len(found) == len(ODD) and {r.score for r in found} == {0.5}
    nulls = spark.createDataFrame([(1, None), (None, 1), (2, 0), (2, 1)], "doc_id long, quality int")
    assert len(line_quality.quality(odd, nulls).collect()) == len(ODD)
    assert line_quality.quality(odd.limit(0), labelled).collect() == []


def test_scores_do_not_depend_on_the_batch(texts):
    every = [t.encode() for t in texts.values()] + [b"", b"\n\n", b"x"]
    model = line_quality.fit(every[:80], [i % 2 for i in range(80)], rounds=5)
    together = line_quality.scores(model, every)
    assert np.allclose(together, [line_quality.scores(model, [t])[0] for t in every])


def test_mix_keeps_sums_and_limits(spark):
    draw = random.Random(8)
    rows = [(i, "w " * draw.randrange(0, 90), draw.choice(["a", "b", "c", None, "é"])) for i in range(400)]
    rows += [(1000, None, "empty"), (1001, "", "empty"), (1002, "big " * 9000, "a"), (None, "q q q", "b"), (7, "dup dup", "b"), (7, "dup dup", "b")]
    docs = spark.createDataFrame([(a, b, c, 5) for a, b, c in rows], "doc_id long, text string, source string, size int").repartition(5)
    found = mixing.mixture(docs).collect()
    again = mixing.mixture(docs.repartition(2)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(map(tuple, again), key=repr)
    assert len(found) == len(rows)
    per_source = {}
    source = {(a, len((b or "").split())): c for a, b, c in rows}
    for r in found:
        assert 0 <= r.taken <= 2 * r.size
        had = per_source.setdefault(source[r.doc_id, r.size], [0, 0, r.source_size, r.target])
        had[0] += r.size
        had[1] += r.taken
    for had, taken, size, target in per_source.values():
        assert had == size and abs(taken - target) <= 2 and target <= 2 * size + 1e-6
    assert sum(t for *_, t in per_source.values()) == pytest.approx(1.5 * sum(s for s, *_ in per_source.values()))
    assert mixing.mixture(docs.limit(0)).collect() == []
    check_take(mixing.take(docs).collect(), found)


def check_take(rows, found):
    """Each document's words in the mix, and the words of each shard, are those that ``mixture`` tells."""
    words, expected = Counter(), Counter()
    for r in rows:
        words[r.doc_id] += len(r.text.split())
    for r in found:
        expected[r.doc_id] += r.taken
        assert r.taken == sum(s.words for s in r.shards)
    assert +words == +expected


def test_equal_rows_are_taken_each_on_its_own_account(spark):
    draw = random.Random(2)
    rows = [(i, f"t{i} " + "w " * draw.randrange(1, 9000), draw.choice("ab"), i, "x") for i in range(40)]
    # Copies equal in all columns, and copies that differ in one that does not clash by chance.
    rows += [rows[0]] * 9 + [rows[1]] * 2 + [(*rows[2][:3], n, "y") for n in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _hash long, _id string").repartition(4)
    found = mixing.mixture(docs, shards=4).collect()
    taken = mixing.take(docs, shards=4)
    assert taken.columns == docs.columns
    got = taken.collect()
    check_take(got, found)
    assert {(r._hash, r._id) for r in got} <= {r[3:] for r in rows}
    assert {r._hash for r in got if r.doc_id == 2} == {0, 1, 2}


def test_shards_get_what_the_tree_gives_them(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = mixing.mixture(docs, shards=8).collect()
    expected = Counter()
    for r in found:
        for s in r.shards:
            expected[s.shard] += s.words
    # Shards are ranges of the result: the words of each, in order, add up to those of the tree.
    words = [len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in mixing.take(docs, shards=8).collect()]
    ends = np.cumsum([0, *words])
    borders = np.cumsum([0, *(expected[s] for s in range(8))])
    assert ends[-1] == borders[-1] and set(borders) <= set(ends)
    total = sum(expected.values())
    assert max(expected.values()) < 1.5 * total / 8


def plain_targets(rows):
    """Sizes of sources and their targets, resharing what is above the limit until nothing is."""
    size = Counter()
    for _, text, source in rows:
        size[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(size, key=lambda s: (s is None, s or "")))}
    target, open_ = {}, set(size)
    while open_:
        level = (1.5 * sum(size.values()) - sum(target.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * size[s]}
        target |= {s: 2.0 * size[s] for s in over} if over else {s: level * weight[s] for s in open_}
        open_ -= over or set(open_)
    return size, target


def test_sizes_and_targets_of_every_row(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "source").collect()
    size, target = plain_targets([tuple(r) for r in docs])
    source = {r.doc_id: r.source for r in docs}
    text = {r.doc_id: r.text for r in docs}
    for r in QUERIES["op2_mixing"](spark, SMALL).collect():
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", text[r.doc_id] or ""))
        assert r.source_size == size[source[r.doc_id]] and r.target == pytest.approx(target[source[r.doc_id]])


def test_quotas_are_split_exactly(spark):
    quotas = spark.createDataFrame([(i, (i * 37) % 50) for i in range(9)], "_no int, quota long")
    rows = mixing.shard_quotas(quotas, 8).collect()
    by = {}
    for r in sorted(rows, key=lambda r: (r._no, r.shard)):
        assert r.first == by.get(r._no, 0)
        by[r._no] = r.first + r.blocks
    assert by == {i: (i * 37) % 50 for i in range(9)}
    totals = [sum(r.blocks for r in rows if r.shard == s) for s in range(8)]
    assert max(totals) - min(totals) <= 3


def test_draws_are_hypergeometric(spark):
    from pyspark.sql import functions as F

    c = mixing.hypergeometric(F.lit(30), F.lit(12), F.lit(10), (F.col("id") + 0.5) / 20000)
    n = {r.c: r["count"] for r in spark.range(20000).select(c.alias("c")).groupBy("c").count().collect()}
    from math import comb

    for k in range(11):
        assert abs(n.get(k, 0) / 20000 - comb(12, k) * comb(18, 10 - k) / comb(30, 10)) < 2e-4
