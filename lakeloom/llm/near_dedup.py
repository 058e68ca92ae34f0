"""MinHash near-dedup of multisets of word shingles with BagMinHash.

A text is the multiset of its runs of five words (lower case, punctuation ignored). For each distinct shingle
of weight w, a Poisson process over the weights (0, w] throws points at the components of the signature; a
component keeps its earliest point. Weights are discretised to counts, and the process is a hierarchy: one
process for each strip (0, 1], (1, 2], (2, 4], (4, 8] ..., in the last of which a point's place is found by
halving the strip, so that a text of smaller weight sees a part of the same points. Two texts agree in a
component with a probability of exactly their weighted Jaccard similarity. Points are thrown in order of time
and no further than a time by which all components have one, so a signature costs about one number a shingle.

Texts of equal words are one node. Bands of the signature put nodes into buckets. In each bucket all are held
against one hub, which is linear in its size; nodes that are found similar are joined to classes. That is
repeated with other hubs for buckets that still hold several classes, and what is left then is held against
each other in full, block by block: a task gets two bounded blocks of a bucket's nodes and returns only links
that join classes. Nodes of the largest class of a bucket are not held against each other, as a link between
nodes of one class changes nothing; so a hot bucket with few nodes outside its class stays linear. No bucket is
capped, no link between classes is lost, and pairs are never rows. Similarity is verified on the multisets
themselves. Classes are connected by alternating star contraction over the links.

Shuffled are signatures and links; texts are read again only for nodes that share a bucket.

Defined results: texts without a word (NULL and empty ones too) are each a class of their own; texts of fewer than
five words are one shingle. The class id is the least id of its rows; NULL if they have none. Repeated rows
are in one class. Extra columns are kept by ``keep_one``, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import BROADCAST_ROWS, free_name, small_side, written

SHINGLE = 5
SIMILARITY = 0.8
# 20 bands of 5: at a similarity of 0.8 a pair shares no bucket once in 2,800 pairs.
BANDS, ROWS = 20, 5
# Hubs that each bucket is held against before the rest is compared in full.
ROUNDS = 2
CHUNK = 400_000
# Nodes of a block, and items of two blocks that are held against each other at a time.
BLOCK, COLUMNS = 64, 16_384

_WORDS = re.compile(r"\w+")
_KEPT_WORDS = 100_000
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= _KEPT_WORDS:
            self.clear()
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= 40:
            self[word] = value
        return value


_WORD_HASHES = _WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    """The last step of splitmix64, a bijection that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> tuple[bytes | None, np.ndarray, np.ndarray]:
    """(digest of the words or None without any, hashes of the distinct shingles in order, their counts)."""
    words = _WORDS.findall(text.lower()) if text else []
    if not words:
        return None, np.empty(0, np.uint64), np.empty(0, np.int64)
    each = np.fromiter(map(_WORD_HASHES.__getitem__, words), np.uint64, len(words))
    size = min(SHINGLE, len(words))
    hashes = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        hashes = mix(hashes * _GOLDEN + each[i : i + len(hashes)])
    distinct, counts = np.unique(hashes, return_counts=True)
    return xxhash.xxh128_digest(each.tobytes()), distinct, counts


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], size: int) -> np.ndarray:
    """A row of ``size`` numbers for each multiset; none may be empty."""
    found = np.empty((len(sets), size), np.uint64)
    pending, patience = np.arange(len(sets)), 4.0
    while len(pending):
        # By this time a component is still empty in one multiset of exp(patience) only; those come again.
        done, values = _thrown([sets[i] for i in pending], size, np.log(size) + patience)
        found[pending[done]] = values[done]
        pending, patience = pending[~done], patience * 2
    return found


def _thrown(sets: list[tuple[np.ndarray, np.ndarray]], size: int, until: float) -> tuple[np.ndarray, np.ndarray]:
    owner = np.repeat(np.arange(len(sets)), [len(h) for h, _ in sets])
    hashes, weights = (np.concatenate(parts) for parts in zip(*sets, strict=True))
    limit = (until / np.bincount(owner, weights, len(sets)))[owner]
    # A strip for weight 1, one up to 2, one up to 4 and so on until the weight is reached.
    strips = 1 + np.ceil(np.log2(weights)).astype(np.int64)
    which = np.repeat(np.arange(len(hashes)), strips)
    strip = np.arange(len(which)) - np.repeat(np.cumsum(strips) - strips, strips)
    low = np.where(strip > 0, 1 << np.maximum(strip - 1, 0), 0)
    width = np.where(strip > 0, low, 1)
    seed = mix(hashes[which] + strip.astype(np.uint64) * _GOLDEN)
    owner, weight, limit = owner[which], weights[which], limit[which]
    rate = size * width.astype(np.float64)
    time = np.zeros(len(seed))
    earliest = np.full(len(sets) * size, np.inf)
    places, times, names = [], [], []
    while len(seed):
        seed = mix(seed + _GOLDEN)
        time = time - np.log(((seed >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate
        live = time <= limit
        seed, time, owner, weight, limit, rate, low, width = (
            x[live] for x in (seed, time, owner, weight, limit, rate, low, width)
        )
        name = mix(seed ^ _GOLDEN)
        place = owner * size + (name % np.uint64(size)).astype(np.int64)
        # Halving the strip again and again is to draw one of its units.
        unit = (mix(name) >> np.uint64(20)) % np.maximum(width, 1).astype(np.uint64)
        inside = low + unit.astype(np.int64) < weight
        np.minimum.at(earliest, place[inside], time[inside])
        places.append(place[inside])
        times.append(time[inside])
        names.append(name[inside])
    place, time, name = (np.concatenate(x) for x in (places, times, names))
    values = np.zeros(len(earliest), np.uint64)
    first = time == earliest[place]
    values[place[first]] = name[first]
    done = np.isfinite(earliest).reshape(len(sets), size).all(axis=1)
    return done, values.reshape(len(sets), size)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One number for each band of each signature."""
    keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(signature), bands))
    parts = signature.reshape(len(signature), bands, rows)
    for i in range(rows):
        keys = mix(keys * _GOLDEN + parts[:, :, i])
    return keys.view(np.int64)


def _chunks(sets: list, weigh) -> Iterator[slice]:
    start, held = 0, 0
    for i, item in enumerate(sets):
        if held and held + weigh(item) > CHUNK:
            yield slice(start, i)
            start, held = i, 0
        held += weigh(item)
    if start < len(sets):
        yield slice(start, len(sets))


def signed(df: DataFrame, id_column: str, text: str, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, node, bands): the digest of the words, NULL without any, and the band keys of every row."""
    source = df.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = [shingles(body.as_py()) for body in batch.column(1)]
            for part in _chunks(every, lambda x: len(x[1])):
                own = every[part]
                full = [i for i, x in enumerate(own) if x[0]]
                keys = band_keys(signatures([own[i][1:] for i in full], bands * rows), bands, rows) if full else np.empty((0, bands), np.int64)
                ends = np.cumsum([0, *(bands if x[0] else 0 for x in own)], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.start, len(own)),
                        pa.array([x[0] for x in own], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel())),
                    ],
                    names=["id", "node", "bands"],
                )

    return source.mapInArrow(run, f"id {kind}, node binary, bands array<bigint>")


def multisets(df: DataFrame, text: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Add (node, items): the digest and the multiset as a set, the n-th of equal shingles numbered n."""
    source = df.select(*keep, F.col(text).alias(free_name(keep, "text")))
    at = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                nodes, items, ends = [], [], [0]
                for body in part.column(at):
                    node, hashes, counts = shingles(body.as_py())
                    number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                    nodes.append(node)
                    items.append(mix(np.repeat(hashes, counts) + number.astype(np.uint64) * _GOLDEN).view(np.int64))
                    ends.append(ends[-1] + len(items[-1]))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(items)))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(at)), pa.array(nodes, pa.binary()), lists], names=[*keep, "node", "items"]
                )

    kinds = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in keep)
    return source.mapInArrow(run, f"{kinds}node binary, items array<bigint>")


def components(links: DataFrame) -> DataFrame:
    """(node, root): for each node of (a, b) the least node that it is connected with.

    Alternating stars: every node points its larger neighbours, then its smaller ones, to the least of them,
    until all point to roots. A node's least neighbour is an aggregate, so a node of many links is no hot task.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    while True:
        edges = written(edges, "links")
        if edges.join(edges.select(F.col("a").alias("inner")), F.col("b") == F.col("inner"), "left_semi").isEmpty():
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
        large = both.where("b > a").join(least, "a").where("b != least")
        large = large.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = small.unionByName(least.withColumnRenamed("least", "b")).distinct()
    # No inner node is left, so each node has one link, which is to its root.
    roots = edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _similar(pairs: DataFrame, items: DataFrame, similarity: float) -> DataFrame:
    """Of pairs (a, b, ...) those whose multisets are similar."""
    left = items.select(F.col("node").alias("a"), F.col("items").alias("x"))
    right = items.select(F.col("node").alias("b"), F.col("items").alias("y"))
    sized = F.least(F.size("x"), F.size("y")) >= similarity * F.greatest(F.size("x"), F.size("y"))
    shared = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .where(sized)
        .where(shared >= similarity * (F.size("x") + F.size("y") - shared))
        .drop("x", "y")
    )


def _overlaps(rows: list[np.ndarray]) -> np.ndarray:
    """How many items each set shares with each other one: products of a part of the incidence matrix at a time."""
    flat = np.concatenate(rows)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    _, item, count = np.unique(flat, return_inverse=True, return_counts=True)
    # What stands in one set only is shared by none.
    number = np.cumsum(count > 1) - 1
    shared = count[item] > 1
    owner, item = owner[shared], number[item[shared]]
    order = np.argsort(item, kind="stable")
    owner, item = owner[order], item[order]
    found = np.zeros((len(rows), len(rows)), np.float64)
    for start in range(0, int((count > 1).sum()), COLUMNS):
        part = slice(*np.searchsorted(item, [start, start + COLUMNS]))
        matrix = np.zeros((len(rows), COLUMNS), np.float32)
        matrix[owner[part], item[part] - start] = 1
        found += matrix @ matrix.T
    return found


def block_links(members: list[tuple[bytes, bytes, np.ndarray]], similarity: float) -> list[tuple[bytes, bytes]]:
    """Of (node, root, items) the links between roots that similar nodes make, none of them twice connected."""
    roots = [root for _, root, _ in members]
    if len(set(roots)) < 2:
        return []
    overlap = _overlaps([items for _, _, items in members])
    size = np.array([len(items) for _, _, items in members])
    joined = dict.fromkeys(roots)

    def find(root: bytes) -> bytes:
        while joined[root] is not None:
            root = joined[root]
        return root

    links = []
    for i, j in zip(*np.nonzero(np.triu(overlap >= similarity * (size[:, None] + size[None, :] - overlap), 1)), strict=True):
        a, b = sorted((find(roots[i]), find(roots[j])))
        if a != b:
            joined[b] = a
            links.append((b, a))
    return links


def _rest(open_: DataFrame, items: DataFrame, similarity: float) -> DataFrame:
    """(a, b): the links between roots that are left in buckets (band, node, root), found block by block."""
    of_class = open_.groupBy("band", "root").agg(F.count("*").alias("n"))
    largest = F.max(F.struct("n", "root"))
    buckets = of_class.groupBy("band").agg(F.sum("n").alias("n"), largest.alias("main"))
    blocks_of = lambda n: F.ceil(n / BLOCK).cast("int")
    buckets = buckets.select(
        "band",
        F.col("main.root").alias("main"),
        blocks_of(F.col("n") - F.col("main.n")).alias("others"),
        blocks_of(F.col("main.n")).alias("mains"),
    )
    dealt = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    block = F.when(F.col("root") == F.col("main"), F.col("others") + dealt(F.col("mains"))).otherwise(dealt(F.col("others")))
    placed = open_.join(buckets, "band").withColumn("block", block).join(items, "node")
    blocks = placed.groupBy("band", "block", "others", "mains").agg(F.collect_list(F.struct("node", "root", "items")).alias("members"))
    # A block of the largest class meets all others, one of the others meets all.
    last = F.when(F.col("block") < F.col("others"), F.col("others") + F.col("mains")).otherwise(F.col("others")) - 1
    meets = blocks.select("band", "block", "members", F.explode(F.sequence(F.lit(0), last)).alias("other"))
    pairs = meets.groupBy("band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    both = pairs.agg(F.flatten(F.collect_list("members")).alias("members")).select("members")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for row in batch.column(0):
                nodes, roots, sets = (row.values.field(k) for k in ("node", "root", "items"))
                members = [
                    (n.as_py(), r.as_py(), s.values.to_numpy(zero_copy_only=False)) for n, r, s in zip(nodes, roots, sets, strict=True)
                ]
                links += block_links(members, similarity)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.binary()) for k in (0, 1)], names=["a", "b"])

    return both.mapInArrow(run, "a binary, b binary")


def classes(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Rows (id, node) and nodes (node, class_id, root): root names the class and is the same for its nodes."""
    documents = written(signed(df, id_column, text, bands, rows), "signatures")
    known = documents.where(F.col("node").isNotNull())
    nodes = known.groupBy("node").agg(F.min("id").alias("first_id"))
    one_each = known.groupBy("node").agg(F.any_value("bands").alias("bands"))
    banded = one_each.select("node", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    members = written(banded.join(shared, "band"), "members")

    involved = members.select("node").distinct().join(nodes, "node")
    ids = small_side(written(involved.select("first_id").where("first_id is not null").distinct(), "involved"))
    again = df.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    again = again.join(ids, F.col("id") == F.col("first_id"), "left_semi").unionByName(again.where("id is null"))
    items = multisets(again, "text").where(F.col("node").isNotNull())
    items = items.join(members.select("node").distinct(), "node", "left_semi")
    items = written(items.groupBy("node").agg(F.any_value("items").alias("items")), "multisets")

    held = None
    for turn in range(ROUNDS + 1):
        if held is None:
            open_ = members.withColumn("root", F.col("node"))
        else:
            open_ = members.join(held, "node", "left").withColumn("root", F.coalesce("root", "node"))
            several = open_.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x != y")
            open_ = written(open_.join(several.select("band"), "band"), "open-buckets")
            if open_.isEmpty():
                break
        if turn < ROUNDS:
            order = F.struct(F.xxhash64("node", F.lit(turn)).alias("o"), F.col("node").alias("hub"), F.col("root").alias("root"))
            hubs = open_.groupBy("band").agg(F.min(order).alias("h")).select("band", "h.hub", F.col("h.root").alias("hub_root"))
            pairs = open_.join(hubs, "band").where("root != hub_root")
            pairs = pairs.select(F.col("node").alias("a"), F.col("hub").alias("b"), F.col("root").alias("ra"), F.col("hub_root").alias("rb"))
            found = _similar(written(pairs.distinct(), "pairs"), items, similarity)
            found = found.select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        else:
            found = _rest(open_, items, similarity)
        # Only links between classes matter now, so what is connected are the roots so far.
        joined = written(components(found), "components")
        if held is None:
            held = joined
        else:
            renamed = joined.select(F.col("node").alias("root"), F.col("root").alias("new"))
            moved = held.join(renamed, "root", "left").select("node", F.coalesce("new", "root").alias("root"))
            fresh = joined.join(held.select("node"), "node", "left_anti")
            held = written(moved.unionByName(fresh), "classes-so-far")
    named = nodes.join(held, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("first_id").alias("class_id"))
    return documents.select("id", "node"), named.join(least, "root").select("node", "class_id", "root")


def label(df: DataFrame, id_column: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """(id, class_id, class_rows): one row for each row of the table."""
    documents, nodes = classes(df, id_column, text, **settings)
    nodes = written(nodes, "classes")
    sizes = documents.groupBy("node").agg(F.count("*").alias("rows")).join(nodes.select("node", "root"), "node")
    sizes = sizes.groupBy("root").agg(F.sum("rows").alias("class_rows"))
    nodes = nodes.join(sizes, "root").select(F.col("node").alias("key"), "class_id", "class_rows")
    own = F.col("node").isNull()
    return documents.join(nodes, F.col("node") == F.col("key"), "left").select(
        F.col("id").alias(id_column),
        F.when(own, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(own, F.lit(1)).otherwise(F.col("class_rows")).cast("long").alias("class_rows"),
    )


def keep_one(df: DataFrame, id_column: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The row with the least id of each class, with its own columns only."""
    documents, nodes = classes(df, id_column, text, **settings)
    nodes = written(nodes, "classes")
    # An id of several rows, or none, does not tell rows apart: these few are taken by their text.
    unclear = documents.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 and id is not null").select("id")
    unclear = written(unclear, "unclear-ids")
    dropped = documents.join(nodes, "node").where("id != class_id").select("id").distinct()
    dropped = written(dropped.join(unclear, "id", "left_anti"), "dropped-ids")
    key = free_name(df.columns, "__id")
    as_key = lambda ids: small_side(ids.select(F.col("id").alias(key)), BROADCAST_ROWS)
    same = df[id_column] == F.col(key)
    clear = df.join(as_key(dropped), same, "left_anti").where(F.col(id_column).isNotNull())
    if unclear.isEmpty() and df.where(F.col(id_column).isNull()).isEmpty():
        return clear
    clear = clear.join(as_key(unclear), clear[id_column] == F.col(key), "left_anti")
    rest = df.join(as_key(unclear), same, "left_semi").unionByName(df.where(F.col(id_column).isNull()))
    whole = free_name(df.columns, "whole")
    rest = multisets(rest.select(F.col(text).alias("text"), F.struct(*df.columns).alias(whole)), "text", (whole,)).select("node", whole)
    wordless = rest.where(F.col("node").isNull()).select(f"{whole}.*")
    chosen = rest.join(nodes, "node").where(F.col(whole)[id_column].eqNullSafe(F.col("class_id")))
    chosen = chosen.groupBy("root").agg(F.min(whole).alias(whole)).select(f"{whole}.*")
    return clear.unionByName(chosen).unionByName(wordless)
