"""Shards against an exhaustive search, and the laws of their slots."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from lakeloom.llm import QUERIES, load_all, shards
from tests.conftest import plan_text
from tests.llm.conftest import documents

load_all()


def best_capacity(sizes, count):
    """The least capacity by trying all; a group beyond it stands alone."""

    def fits(capacity):
        used, i = 0, 0
        while i < len(sizes):
            used, held = used + 1, sizes[i]
            i += 1
            while held <= capacity and i < len(sizes) and held + sizes[i] <= capacity:
                held += sizes[i]
                i += 1
        return used <= count

    capacity = 1
    while not fits(capacity):
        capacity += 1
    return capacity


@pytest.mark.parametrize("seed", range(30))
def test_capacity_and_cuts_are_the_smallest(spark, monkeypatch, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 2, 3, 5, 8, 40, 200 if seed % 3 == 0 else 7]) for _ in range(rng.randint(1, 300))]
    hashes = sorted(rng.sample(range(-(1 << 63), 1 << 63, 1 << 40), len(sizes)))
    count, table = rng.choice([2, 5, 16]), list(zip(hashes, sizes, strict=True))
    shift = lambda a, bits: a >> (64 - bits) << (64 - bits)

    def ranges(rows, bits):
        found = defaultdict(list)
        for a, size in rows:
            found[shift(a, bits)].append(size)
        return sorted(shards.Range((a, shards._LEAST), sum(x), len(x), max(x), bits) for a, x in found.items())

    def divided(_, doubtful):
        out = []
        for r in doubtful:
            rows = [x for x in table if shift(x[0], r.bits) == r.first[0]]
            if r.groups < 4:
                out += [shards.Range((a, 0), size, 1, size, 64) for a, size in rows]
            else:
                out += ranges(rows, r.bits + 4)
        return out

    monkeypatch.setattr(shards, "_ranges", lambda rows, bits: ranges(rows, 3))
    monkeypatch.setattr(shards, "_divided", divided)
    cuts = shards.cuts(table, count)
    capacity = best_capacity(sizes, count)
    held = defaultdict(int)
    groups = defaultdict(int)
    for a, size in table:
        shard = sum((a, 0) >= cut for cut in cuts if cut != shards.NEVER)
        held[shard] += size
        groups[shard] += 1
    assert max((size for k, size in held.items() if groups[k] > 1), default=0) <= capacity
    assert max(held.values()) == max(capacity, max(sizes)) or max(held.values()) <= capacity
    assert max(held) < count


def check(rows, texts, count=16):
    by_shard, place = defaultdict(list), defaultdict(set)
    for r in rows:
        by_shard[r["shard"]].append(r["slot"])
        place[texts[r["doc_id"]]].add(r["shard"])
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    assert all(len(found) == 1 for found in place.values())
    assert set(by_shard) <= set(range(count))


def test_given_documents(spark, folder):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    df = QUERIES["op7_shards"](spark, folder)
    rows = df.collect()
    assert len(rows) == len(texts)
    check(rows, texts)
    held = defaultdict(int)
    for r in rows:
        text = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text) + 1, zlib.crc32(text), "bytes", None)
        held[r["shard"]] += r["size"]
    groups = defaultdict(int)
    for r in rows:
        groups[texts[r["doc_id"]]] += r["size"]
    assert max(held.values()) <= -(-sum(held.values()) // 16) + max(groups.values())
    text = plan_text(df)
    assert not [x for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop") if x in text]


def test_a_hot_text_has_a_shard_of_its_own(spark):
    rows = [(i, "the same long text of many rows " * 3) for i in range(700)] + [(1000 + i, f"text {i} " * 5) for i in range(1400)]
    placed = shards.assign(documents(spark, rows)).collect()
    check(placed, dict(rows))
    sizes = defaultdict(int)
    for r in placed:
        sizes[r["shard"]] += r["size"]
    hot = next(r["shard"] for r in placed if r["doc_id"] == 0)
    others = sorted(size for k, size in sizes.items() if k != hot)
    # The shard that the hot text cuts short, and the last one, hold what is left.
    assert len(others) == 15 and others[-1] - others[2] <= 2 * 60


def test_messy_rows(spark, messy, nothing):
    placed = shards.assign(messy, shards=4).collect()
    assert len(placed) == messy.count()
    by_shard = defaultdict(list)
    for r in placed:
        by_shard[r["shard"]].append(r["slot"])
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    with_shard = shards.with_shard(messy, shards=4, into="part")
    assert with_shard.columns == [*messy.columns, "part"]
    null_and_empty = {r["text"]: r["part"] for r in with_shard.where("text is null or text = ''").collect()}
    assert set(null_and_empty) == {None, ""}
    assert shards.assign(nothing).count() == 0
    one = shards.assign(messy.where("doc_id = 4")).collect()
    assert [(r["shard"], r["slot"], r["size"]) for r in one] == [(0, 0, 1)]


def test_ranges_are_divided_until_they_are_groups(spark, monkeypatch):
    monkeypatch.setattr(shards, "FETCHED", 3)
    groups = spark.range(5000).select(F.xxhash64("id").alias("a"), F.col("id").alias("b"), (F.col("id") % 97 + 1).alias("size")).cache()
    cuts = shards.cuts(groups, 7)
    rows = sorted((r["a"], r["b"], r["size"]) for r in groups.collect())
    held = defaultdict(int)
    for a, b, size in rows:
        held[sum((a, b) >= cut for cut in cuts)] += size
    ends = list(accumulate(r[2] for r in rows))
    single = [shards.Range((a, b), size, 1, size, 64) for a, b, size in rows]
    assert max(held.values()) == shards.smallest_capacity(single, ends, 7, 1)
