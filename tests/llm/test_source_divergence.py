"""Divergence of sources against a plain count over whole documents."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakeloom.llm import source_divergence as sd
from tests.llm.conftest import documents

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def lower(term):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in term)


def brute(rows, top=sd.TOP_TERMS, least=sd.MIN_DOCUMENTS):
    counts, df, groups = Counter(), Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = [lower(t) for t in TERM.findall(text or "")]
        counts.update((lang, source, t) for t in found)
        df.update((lang, t) for t in set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (own, t), n in df.items() if own == lang and n >= least]
        sources = [s for own, s in groups if own == lang]
        size = {s: sum(counts[lang, s, t] for t in kept) for s in sources}
        share = {s: {t: 1 + 10**9 * (counts[lang, s, t] + 1) // (size[s] + len(kept)) for t in kept} for s in sources}
        total = {t: sum(counts[lang, s, t] for s in sources) for t in kept}
        of_lang = {t: 1 + 10**9 * (total[t] + 1) // (sum(size.values()) + len(kept)) for t in kept}
        gain = lambda p, q: (p - q) ** 2 // q
        for s in sources:
            pairs = [(o, sum(gain(share[s][t], share[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, gain(share[s][t], of_lang[t])) for t in kept if counts[lang, s, t] and share[s][t] > of_lang[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(items[:limit])]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def table(spark, rows):
    return spark.createDataFrame([(i, *r, 1, 2, 3, 4) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, term int, cell int, p int, n int")


def random_rows(seed, n=120):
    rng = np.random.default_rng(seed)
    words = [*(f"W{chr(97 + i)}" for i in range(20)), "Ärger", "ärger", "über", "naïve", "日本語", "x y", "Ümlaut"]
    rows = []
    for _ in range(n):
        text = " ".join(rng.choice(words, rng.integers(0, 30))) + rng.choice(["", "\x00tail", " 12-3", "\n\tA_b{c}"])
        rows.append((text, str(rng.choice(["en", "de"])), str(rng.choice(["s1", "s2", "S2", "é"], p=[0.6, 0.2, 0.1, 0.1]))))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rows = random_rows(seed)
    assert result(sd.audit(table(spark, rows))) == brute(rows)


def test_spills_and_stretches_change_nothing(spark, monkeypatch):
    rows = random_rows(9, 200)
    monkeypatch.setattr(sd, "HELD_CELLS", 7)
    monkeypatch.setattr(sd, "PAIRS", 3)
    assert result(sd.audit(table(spark, rows).repartition(5), top_terms=5)) == brute(rows, 5)


def test_pairs_by_place_and_by_key_agree(monkeypatch):
    """Sums by pair against one pair after the other, with far apart numbers of groups."""
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 9, 60)
    group = np.concatenate([rng.choice(9, n, replace=False) for n in sizes]).astype(np.int64) * 1_000_003
    p, none = rng.integers(10, 10**6, len(group)), rng.integers(1, 10, len(group))
    expected: dict = {}
    for start, n in zip(np.cumsum(sizes) - sizes, sizes, strict=True):
        for i in range(start, start + n):
            for j in range(start, start + n):
                if i != j:
                    f = lambda x, y: (int(x) - int(y)) ** 2 // int(y)
                    value = f(p[i], p[j]) - f(p[i], none[j]) - f(none[i], p[j]) + f(none[i], none[j])
                    key = int(group[i]), int(group[j])
                    expected[key] = expected.get(key, 0) + value
    # Pairs of groups are never sorted as rows, which took most of the time.
    unique = np.unique
    monkeypatch.setattr(np, "unique", lambda values, axis=None, **how: unique(values, **how) if axis is None else pytest.fail("rows sorted"))
    for pairs in (1 << 20, 3):
        monkeypatch.setattr(sd, "PAIRS", pairs)
        a, b, values = sd.pair_sums(group, p, none, sizes)
        assert dict(zip(zip(a.tolist(), b.tolist(), strict=True), values.tolist(), strict=True)) == expected


def test_nulls_empty_and_lonely_groups(spark, messy, nothing):
    rows = [("a b a", None, None), (None, "en", "s"), ("", "en", None), ("a", None, ""), ("a c", "", "t"), ("b", "fr", "only"), ("b", "fr", "only"), ("B b", "fr", "only")]
    found = result(sd.audit(table(spark, rows)))
    assert found == brute(rows)
    assert ("en", "", "pair", "s", 0, 1) in found
    assert sd.audit(nothing).count() == 0
    assert result(sd.audit(messy)) == brute([(r.text, r.lang, r.source) for r in messy.collect()])


def test_ties_are_in_order_of_bytes(spark):
    rows = [("zz yy é a", "en", "s")] * 3 + [("q", "en", "t")] * 3
    terms = [r for r in result(sd.audit(table(spark, rows))) if r[1:3] == ("s", "term")]
    assert [r[3] for r in sorted(terms, key=lambda r: r[5])] == ["a", "yy", "zz", "é"]
    assert result(sd.audit(table(spark, rows))) == brute(rows)


def test_shares_beyond_63_bits():
    counts = np.array([10**12, 5])
    both = np.array([3 * 10**12, 3 * 10**12])
    assert sd.shares(counts, both).tolist() == [1 + 10**9 * (c + 1) // (3 * 10**12) for c in (10**12, 5)]


def test_too_many_groups_are_refused(spark, monkeypatch):
    monkeypatch.setattr(sd, "BROADCAST_ROWS", 2)
    with pytest.raises(ValueError, match="groups"):
        sd.audit(documents(spark, [(i, "a b", f"s{i}") for i in range(4)]))
