from __future__ import annotations

import re
from collections import Counter

import pytest

import corpus_pipeline
from tallymill.llm import line_quality
from tallymill.llm.vocabulary import default_path
from tests.conftest import SMALL
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.llm.test_suffix_dedup import plain


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage is given and returns."""
    docs, results = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(i))
        stage(spark, docs, SMALL).write.parquet(path)
        results.append((docs, spark.read.parquet(path)))
        docs = results[-1][1]
    return results


def test_all_but_the_last_keep_the_columns(spark, stages):
    names = spark.read.parquet(f"{SMALL}/documents.parquet").columns
    assert all(after.columns == names for _, after in stages[:-1])


def test_bad_documents_go_and_good_ones_stay(spark, stages):
    before, after = stages[0]
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = line_quality.train(before, labels)
    rows = before.collect()
    scores = line_quality.scores(model, [r.text.encode() for r in rows])
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r, s in zip(rows, scores) if s >= 0.7}


def test_one_of_each_group_stays(stages):
    before, after = stages[1]
    rows = before.collect()
    groups = plain_components([plain_fingerprint(r.text) for r in rows], [r.doc_id for r in rows])
    assert sorted(r.doc_id for r in after.collect()) == sorted(set(groups))


def test_repeated_strings_go(stages):
    before, after = stages[2]
    expected = {r[0]: r[1] - r[2] for r in plain([(r.doc_id, r.text.encode()) for r in before.collect()])}
    for row in after.collect():
        # At the edges of a cut up to three bytes of a character may be dropped.
        assert 0 <= expected.pop(row.doc_id) - len(row.text.encode()) <= 12
    assert not expected


def test_mix_follows_the_weights(stages):
    before, after = stages[3]
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    had, took = Counter(), Counter()
    texts = {}
    for row in before.collect():
        had[row.source] += count(row.text)
        texts[row.doc_id] = row.text
    rows = after.collect()
    for row in rows:
        took[row.source] += count(row.text)
        assert row.n_chars == len(row.text)
        assert count(row.text) <= count(texts[row.doc_id])
    limit = {s: 2 * n for s, n in had.items()}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(had))}
    total, target, open_ = 1.5 * sum(had.values()), {}, set(had)
    while True:
        level = (total - sum(target.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > limit[s]}
        if not over:
            break
        target |= {s: limit[s] for s in over}
        open_ -= over
    target |= {s: level * weight[s] for s in open_}
    for source in had:
        assert abs(took[source] - target[source]) <= 0.01 * target[source] + 3


def test_encoding_is_that_of_the_library(stages):
    from tokenizers import Tokenizer

    before, after = stages[4]
    library = Tokenizer.from_file(default_path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    expected = Counter()
    for row in before.collect():
        ids = library.encode(row.text, add_special_tokens=False).ids
        data = b"".join(i.to_bytes(4, "little") for i in ids)
        expected[row.doc_id, data, library.decode(ids, skip_special_tokens=False)] += 1
    assert Counter((r.doc_id, bytes(r.ids), r.decoded) for r in after.collect()) == expected


def test_run(spark, stages):
    assert corpus_pipeline.run(spark, SMALL).count() == stages[-1][1].count()


@pytest.mark.parametrize("place", range(len(corpus_pipeline.STAGES)))
def test_stages_take_odd_rows(spark, place):
    """Nulls in any column, empty and repeated rows, other columns of clashing names, an empty table."""
    stage = corpus_pipeline.STAGES[place][1]
    rows = [
        (1, None, None, None, None, "x", 1), (2, "", "en", "web", 0, "x", 1), (3, "a few words here.", "en", None, 17, None, None),
        (3, "a few words here.", "en", None, 17, None, None), (None, "no id at all.", "en", "web", 13, "x", 2),
        (4, "one two three four five. " * 4000, "en", "web", 100_000, "x", 3),
    ]
    names = "doc_id long, text string, lang string, source string, n_chars int, id string, component_id int"
    docs = spark.createDataFrame(rows, names)
    given = {r[0] for r in rows}
    found = stage(spark, docs, SMALL)
    got = found.collect()
    assert {r.doc_id for r in got} <= given
    if place < len(corpus_pipeline.STAGES) - 1:
        assert found.columns == docs.columns
    assert stage(spark, docs.limit(0), SMALL).collect() == []
