"""Trie of rebuilt conversations against plain lists of turns."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest

from lakeloom.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, conv int, depth int, a int, b int, owner int, n int, f0 int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6, 7) for r in rows], SCHEMA)


def brute(rows):
    own = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((role or "", text or ""))
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        rebuilt[c] = own.get(base, [])[:h] + turns[h:]
    nodes = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for key, members in nodes.items():
        below = [k for k in nodes if k[: len(key)] == key]
        children = [k for k in below if len(k) == len(key) + 1]
        leaves = [k for k in below if not any(len(x) == len(k) + 1 and x[: len(k)] == k for x in nodes)]
        saved = sum((len(nodes[k]) - 1) * len(k[-1][1]) for k in below if k)
        ends = ",".join(map(str, sorted(c for c in members if len(rebuilt[c]) == len(key))))
        parent = min(nodes[key[:-1]]) if key else None
        out.append((min(members), len(key), parent, len(members), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def random_rows(seed, convs=60):
    rng = np.random.default_rng(seed)
    rows = []
    for c in rng.choice(np.arange(-150, 450), convs, replace=False):
        for turn in range(rng.integers(1, 10)):
            rows.append((int(c), int(turn), str(rng.choice(["user", "assistant"])), str(rng.choice(["a", "bb", "", "dö"], p=[0.7, 0.1, 0.1, 0.1]))))
    return [rows[i] for i in rng.permutation(len(rows))]


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rows = random_rows(seed)
    assert result(pt.trie(table(spark, rows))) == brute(rows)


def test_slices_and_runs_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(pt, "SLICE", 3)
    rows = random_rows(11, 40)
    rows += [(7, t, "user", "a") for t in range(30, 60)] + [(8, t, "user", "a") for t in range(30, 60)]
    assert result(pt.trie(table(spark, rows))) == brute(rows)
    ends = spark.createDataFrame([(c, 1, 2) for c in (5, 40, 3, 1000, 41)] + [(9, 2, 0)], "conv long, owner long, depth long")
    found = {(r.owner, r.depth): r.ends_sha256 for r in pt.ends_digests(ends, 10).collect()}
    assert found == {(1, 2): hashlib.sha256(b"3,5,40,41,1000").hexdigest(), (2, 0): hashlib.sha256(b"9").hexdigest()}


def test_nulls_and_turnless_conversations(spark):
    rows = [
        (100, None, None, None), (100, 0, "user", "x"), (101, 0, "user", None), (102, 3, None, "y"), (None, 1, "user", "lost"), (350, 0, "user", "only"),
        *((c, 0, "user", "hi") for c in range(301, 330)), *((c, None, "user", "hi") for c in range(1000, 1004)),
    ]
    found = brute(rows)
    assert result(pt.trie(table(spark, rows))) == found
    # Some have no turn: the root is where they end.
    assert any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in found)
    assert result(pt.trie(table(spark, []))) == []
    assert result(pt.trie(table(spark, [(None, 0, "user", "x")]))) == []


def test_one_turnless_conversation_is_a_root_that_is_a_leaf(spark):
    c = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6)
    rows = [(c, 0, "user", "x")]
    assert result(pt.trie(table(spark, rows))) == brute(rows)


def test_long_texts_and_hot_copies(spark):
    long = "word " * 50_000
    rows = [(c, t, "user", long if t == 1 else "same") for c in range(200, 300) for t in range(8)]
    assert result(pt.trie(table(spark, rows))) == brute(rows)


def test_fingerprints_compose():
    rng = np.random.default_rng(2)
    values = rng.integers(0, pt.PRIME, 12)
    base = int(pt.bases(0)[0])
    whole = sum(int(v) * pow(base, i + 1, pt.PRIME) for i, v in enumerate(values)) % pt.PRIME
    head, rest = (sum(int(v) * pow(base, i + 1, pt.PRIME) for i, v in enumerate(part)) % pt.PRIME for part in (values[:5], values[5:]))
    assert (head + pow(base, 5, pt.PRIME) * rest) % pt.PRIME == whole
    assert pt.powers(base, np.arange(40)).tolist() == [pow(base, i, pt.PRIME) for i in range(40)]


def test_a_collision_is_seen_and_other_seeds_are_taken(spark, monkeypatch):
    good, tried = pt.bases, []

    def bases(seed):
        tried.append(seed)
        # Multipliers of 0 make all sequences equal.
        return np.zeros(len(pt.LANES), np.int64) + (0 if seed == 0 else good(seed))

    inverse = pow
    monkeypatch.setattr(pt, "bases", bases)
    monkeypatch.setattr(pt, "pow", lambda b, n, m: 0 if not b else inverse(b, n, m), raising=False)
    rows = random_rows(4, 30)
    assert result(pt.trie(table(spark, rows))) == brute(rows)
    assert {0, 1} <= set(tried)
