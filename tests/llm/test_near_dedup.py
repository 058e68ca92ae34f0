"""BagMinHash classes against all pairs."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np

from lakeloom.llm import near_dedup
from tests.conftest import plan_text
from tests.llm.conftest import documents


def bag(text):
    words = re.findall(r"\w+", (text or "").lower())
    size = min(5, len(words))
    return Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if words else Counter()


def jaccard(a, b):
    return sum((a & b).values()) / max(sum((a | b).values()), 1)


def brute(rows, similarity=0.8):
    """For each row the least id of its class; rows are (id, text)."""
    bags = [bag(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        if bags[i] and bags[j] and jaccard(bags[i], bags[j]) >= similarity:
            root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return [(key, least.get(find(i))) for i, (key, _) in enumerate(rows)]


def labelled(df, **settings):
    return sorted((r["doc_id"], r["class_id"]) for r in near_dedup.label(df, **settings).collect())


def test_signatures_are_unbiased():
    rng = random.Random(3)
    errors = []
    for _ in range(40):
        a = Counter(rng.choices(range(30), k=rng.randint(1, 120)))
        b = Counter(a)
        for _ in range(rng.randint(0, 60)):
            b[rng.randrange(40)] += rng.choice([1, 1, 2, 5])
        sets = [
            (near_dedup.mix(np.array(sorted(c), np.uint64) + np.uint64(1)), np.array([c[k] for k in sorted(c)], np.int64))
            for c in (a, b)
        ]
        left, right = near_dedup.signatures(sets, 1000)
        errors.append((left == right).mean() - jaccard(a, b))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.03


def test_classes_as_all_pairs(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert labelled(docs) == sorted(brute(rows))


def group(rng, size, words=120, changes=4):
    """Copies of a text, each with words of its own in a few places: most pairs are near the threshold."""
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    found = []
    for i in range(size):
        text = list(base)
        for _ in range(rng.randint(0, changes)):
            text[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        found.append((i, " ".join(text)))
    return found


def test_a_large_group_of_near_copies_loses_no_link(spark):
    rng = random.Random(5)
    rows = group(rng, 150) + [(1000 + i, t) for i, t in group(rng, 60)] + [(5000 + i, f"alone {i} of all the rest here") for i in range(50)]
    found = dict(labelled(documents(spark, rows)))
    expected = dict(brute(rows))
    # A pair at the threshold shares no bucket once in thousands; within a group other pairs join it.
    assert found == expected


def test_full_comparison_after_the_hubs(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "ROUNDS", 0)
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rows = group(random.Random(6), 60)
    assert dict(labelled(documents(spark, rows))) == dict(brute(rows))


def test_blocks_find_all_links(monkeypatch):
    monkeypatch.setattr(near_dedup, "COLUMNS", 7)
    rng = random.Random(9)
    texts = [t for _, t in group(rng, 40)]
    bags = [near_dedup.shingles(t) for t in texts]
    items = []
    for _, hashes, counts in bags:
        items.append(np.concatenate([near_dedup.mix(h + np.arange(c, dtype=np.uint64)) for h, c in zip(hashes, counts, strict=True)]))
    members = [(bytes([i]), bytes([i]), x.view(np.int64)) for i, x in enumerate(items)]
    links = near_dedup.block_links(members, 0.8)
    root = list(range(40))
    for b, a in links:
        root = [root[a[0]] if r == root[b[0]] else r for r in root]
    expected = [c for _, c in brute(list(enumerate(texts)))]
    assert [min(j for j in range(40) if root[j] == root[i]) for i in range(40)] == expected
    assert len(links) == 40 - len(set(expected))


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (102, 101)], "a int, b int")
    roots = {r["node"]: r["root"] for r in near_dedup.components(links).collect()}
    assert roots == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}
    assert near_dedup.components(links.where("a < 0")).count() == 0


def test_messy_rows(spark, messy, nothing):
    rows = [(r["doc_id"], r["text"]) for r in messy.collect()]
    none_last = lambda pairs: sorted(pairs, key=repr)
    found = [(r["doc_id"], r["class_id"]) for r in near_dedup.label(messy).collect()]
    # A text without a word is a class of its own.
    expected = [(i, c if bag(t) else i) for (i, t), (_, c) in zip(rows, brute(rows), strict=True)]
    assert none_last(found) == none_last(expected)
    kept = near_dedup.keep_one(messy)
    assert kept.columns == messy.columns
    texts = Counter(r["text"] for r in kept.collect())
    assert texts["one"] == texts["two"] == 1
    assert max(n for t, n in texts.items() if bag(t)) == 1
    assert {bag(t).total() for t in texts} == {bag(t).total() for _, t in rows}
    assert near_dedup.label(nothing).count() == 0 and near_dedup.keep_one(nothing).count() == 0


def test_one_row_of_each_class_is_kept(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = near_dedup.keep_one(docs)
    assert kept.schema == docs.schema
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == sorted({c for _, c in labelled(docs)})


def test_texts_are_not_compared_with_all_texts(spark, folder):
    text = plan_text(near_dedup.label(spark.read.parquet(f"{folder}/documents.parquet")))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
