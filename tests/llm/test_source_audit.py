from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as contract
from tallymill.llm import source_audit
from tests.compare import differences, duck
from tests.conftest import SMALL

NAMES = "text string, lang string, source string, term string, n int, no string"


def plain(rows, least=30, top=50):
    """Every share of every group, term by term."""
    counts, held = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        found = ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in found]
        counts[lang, source].update(found)
        held[lang].update(set(found))
    result = []
    for lang in held:
        kept = {t for t, n in held[lang].items() if n >= least}
        groups = {s: {t: c[t] for t in kept} for (g, s), c in counts.items() if g == lang}
        groups[None] = {t: sum(c[t] for c in groups.values()) for t in kept}
        share = {}
        for s, c in groups.items():
            whole = sum(c.values()) + 5 * len(kept)
            share[s] = {t: 1 + 10**9 * (n + 5) // whole for t, n in c.items()}
        for s in groups.keys() - {None}:
            pair = [(o, sum(abs(share[s][t] - share[o][t]) for t in kept)) for o in groups.keys() - {None, s}]
            term = [(t, share[s][t] - share[None][t]) for t in kept if groups[s][t] and share[s][t] > share[None][t]]
            for part, items in (("pair", pair), ("term", term)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                result += [(lang, s, part, i, v, r) for r, (i, v) in enumerate(items, 1) if part == "pair" or r <= top]
    return sorted(result)


def found(df):
    return sorted(map(tuple, df.select("lang", "source", "part", "item", "value", "rank").collect()))


def test_query_equals_sql(spark):
    got = contract.queries()["op11_source_audit"](spark, SMALL).toArrow()
    assert got.num_rows > 0
    assert differences(got, duck(SMALL).sql(contract.oracle_sql()["op11_source_audit"]).to_arrow_table()) == []


def made_up(draw):
    word = lambda: draw.choice(["The", "the", "ÉTÉ", "été", "naïve", "x", "Z9z", "don't", "日本", "a\u0085b", "a\u00a0b", "w%d" % draw.randrange(40)])
    rows = []
    for _ in range(300):
        text = draw.choice([" ", "\n", "\x00", "-1-"]).join(word() for _ in range(draw.randrange(0, 40)))
        rows.append((draw.choice([text, text, text, None, ""]), draw.choice(["en", "en", "de", None, ""]), draw.choice(["a", "a", "b", "é", None, ""]), "x", 1, None))
    # A group without words, a language that keeps nothing, repeated rows, a very long text.
    rows += [("", "en", "silent", None, None, None), ("rare words", "fr", "a", "x", 1, "x"), ("", "fr", "b", "x", 1, "x")]
    rows += [rows[0]] * 4 + [("the w1 " * 50_000, "en", "long", "x", 1, "x"), ("y" * 100_000, "en", "long", "x", 1, "x")]
    return rows


@pytest.mark.parametrize("limits", [{}, {"_HELD": 50, "_TILE": 2, "_PIECE": 16}])
def test_made_up_rows(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(source_audit, name, value)
    rows = made_up(random.Random(5))
    docs = spark.createDataFrame(rows, NAMES).repartition(6)
    assert found(source_audit.divergence(docs, least_docs=12, top=4)) == plain(rows, 12, 4)


def test_empty_tables_and_texts(spark):
    docs = spark.createDataFrame([], NAMES)
    assert found(source_audit.divergence(docs)) == []
    docs = spark.createDataFrame([(None, None, None, None, None, None), ("", "", "b", None, None, None)], NAMES)
    assert found(source_audit.divergence(docs)) == [("", "", "pair", "b", 0, 1), ("", "b", "pair", "", 0, 1)]


def test_large_totals_are_exact(spark):
    n, total, terms = 10**15, 3 * 10**16 + 7, 10**6 + 1
    df = spark.createDataFrame([(n, total, terms)], "n long, total long, terms long")
    got = df.select(source_audit._share(df.n, df.total, df.terms)).first()[0]
    assert got == 1 + 10**9 * (n + 5) // (total + 5 * terms)
