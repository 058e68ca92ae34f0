"""Near duplicates of embeddings by a robust-pruned flat graph.

Only vectors of the same label and length are compared, by cosine in double precision. Equal vectors are one node with a
weight. The nodes of a label are dealt to overlapping shards: centroids are fitted on a bounded sample, centroids
that a group of near copies could be torn between are merged, and every node goes to its two nearest, level by
level until a shard has no more than ``SHARD`` nodes. In each shard a flat graph is built by inserting batches of
doubling size: a greedy search from the medoids gives candidates, robust pruning keeps the near ones in
different directions, edges run both ways and are pruned again. The adjacency lists of all shards are united by node.
Every node is then searched in each of its shards over the united lists: greedily from the medoids, where its own node
is a second entry, and wherever the search comes into range it expands all that is in range. What is found is verified by its cosine.

A pair that two shards see is counted in the first of them. Shards return a number for each node and a spanning
forest of their links, never pairs as rows, so a large group of near copies costs as many rows as vectors.

A shard that cannot be split, as its sample has one centre only, is a dense one: a group of near copies, which may
hold a third of all rows. Two vectors within half the angle of the threshold around the centre are within the
threshold, so all of these are linked and counted by one sum, without a pair. Only the others of such a shard are held
against all of it, in blocks of bounded size.

``recall`` audits the result against brute force for a bounded sample of nodes. ``label`` widens the search while the
audit stays below ``LEAST_RECALL``.

Defined results: vectors that are NULL, empty, zero or hold NULL, NaN or infinity, and rows without a label, link with
nothing; each such row is a component of its own. Repeated rows and ids count as vectors of their own. ``component_id`` is
the least id of its rows. Rows without an id link like others; ``component_id`` is NULL if no row has an id. Extra columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import shared_value, small_side, written
from lakeloom.llm.near_dedup import components

SIMILARITY = 0.93
# Nodes of a shard, and nodes meant for each centroid when one is split.
SHARD, TARGET = 2048, 700
# Centroids of a split, and nodes sampled for each of them.
CENTROIDS, SAMPLED = 1024, 8
LEVELS = 8
OVERLAP = 2
# Out-degree, slack of pruning in angle, and length of the list of a greedy search.
DEGREE, SLACK, BEAM = 24, 1.05, 32
# Nodes of a shard for each medoid that searches start from.
A_MEDOID = 32
# Queries that are searched, and nodes expanded for each, at a time.
QUERIES, EXPANDED, EXPANDED_IN_RANGE = 512, 4, 16
# Rows that are dealt to centroids at a time, and rows of a block of a dense shard.
CHUNK, BLOCK = 16_384, 2048
AUDITED, LEAST_RECALL, WIDER = 512, 0.97, 3

_MARGIN = 1e-9


def units(column: pa.Array) -> list[np.ndarray | None]:
    """Each vector as doubles of length 1; None where it has no direction."""
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    # A NULL component counts as NaN.
    values[column.values.is_null().to_numpy(zero_copy_only=False)] = np.nan
    found = []
    for start, end, valid in zip(column.offsets[:-1].tolist(), column.offsets[1:].tolist(), column.is_valid().tolist(), strict=True):
        vector = values[start:end]
        most = np.abs(vector).max() if valid and len(vector) else 0.0
        if not (0 < most < np.inf):
            found.append(None)
            continue
        # Scaled by its largest component first, so that no square leaves the range of doubles. No -0.0 is left.
        vector = vector / most
        found.append(vector / np.sqrt(vector @ vector) + 0.0)
    return found


def prepared(df: DataFrame, id_column: str, vector: str, group: str) -> tuple[DataFrame, DataFrame]:
    """Rows (id, x, y, n) and nodes (node, space, vec, weight, first_id, x, y): (x, y) is a hash of 128 bits; space
    the label and length."""
    rows = df.select(F.col(id_column).alias("id"), F.col(group).cast("string").alias("label"), F.col(vector).alias("raw"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [v if g.is_valid else None for v, g in zip(units(batch.column(2)), batch.column(1), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(vectors, pa.list_(pa.float64()))], names=["id", "label", "vec"])

    rows = rows.select("id", "label", F.col("raw").cast("array<double>").alias("raw")).mapInArrow(run, f"id {kind}, label string, vec array<double>")
    seen = F.col("vec").isNotNull()
    rows = written(rows.withColumns({"x": F.when(seen, F.xxhash64("label", "vec")), "y": F.when(seen, F.xxhash64(F.lit(1), "vec", "label"))}), "vectors")
    usable = rows.where(F.col("vec").isNotNull())
    nodes = usable.groupBy("label", "vec", "x", "y").agg(F.count("*").alias("weight"), F.min("id").alias("first_id"))
    space = F.concat(F.length("label").cast("string"), F.lit(":"), F.col("label"), F.lit(":"), F.size("vec").cast("string"))
    nodes = nodes.select(F.monotonically_increasing_id().alias("node"), space.alias("space"), "vec", "weight", "first_id", "x", "y")
    # A node's number is what is written; nobody computes it again.
    return rows.select("id", "x", "y"), written(nodes, "nodes")


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of lists of equal length as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _lists(rows: np.ndarray) -> pa.Array:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] if rows.ndim > 1 else 0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()))


def fitted_centroids(sample: np.ndarray, wished: int, apart: float, rounds: int = 6) -> np.ndarray:
    """Directions of some ``wished`` clusters of the sample, of which no two have a cosine above ``apart``."""
    chosen = np.random.default_rng(len(sample)).permutation(len(sample))[: max(1, wished)]
    centres = sample[np.sort(chosen)]
    for _ in range(rounds):
        nearest = (sample @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        length = np.linalg.norm(sums, axis=1)
        size = np.bincount(nearest, minlength=len(centres))
        centres, size = sums[length > 0] / length[length > 0, None], size[length > 0]
        # The largest first: what lies close to one that stays goes.
        centres = centres[np.argsort(-size, kind="stable")]
        kept = np.zeros(len(centres), bool)
        close = centres @ centres.T > apart
        for i in range(len(centres)):
            kept[i] = not (close[i] & kept).any()
        centres = centres[kept]
    return centres


def _split(placed: DataFrame, sizes: DataFrame, level: int, apart: float, half: float) -> tuple[DataFrame, DataFrame]:
    """(rows (node, vec, cell) dealt to new cells, centres (cell, centre) of those that cannot be split)."""
    wished = F.least(F.ceil(F.col("n") / TARGET), F.lit(CENTROIDS)).cast("int")
    big = written(sizes.where(F.col("n") > SHARD).withColumn("wished", wished), "large-cells")
    rows = placed.join(small_side(big), "cell")
    drawn = F.pmod(F.xxhash64("node", F.lit(level)), F.col("n")) < F.col("wished") * SAMPLED
    sample = rows.where(drawn).select("cell", "wished", "vec")

    def fit(key, table):
        centres = fitted_centroids(matrix(table.column("vec")), table.column("wished")[0].as_py(), apart)
        child = pa.array(range(len(centres)), pa.int32())
        return pa.table({"cell": [key[0].as_py()] * len(centres), "child": child, "of": pa.array([len(centres)] * len(centres), pa.int32()), "centre": _lists(centres)})

    centres = written(sample.groupBy("cell").applyInArrow(fit, "cell string, child int, of int, centre array<double>"), "centroids")
    dense = centres.where("of = 1" if level < LEVELS else "child = 0").select("cell", "centre")
    if level >= LEVELS:
        return rows.limit(0).select("node", "vec", "cell"), dense
    # Rows meet the centroids of their cell chunk by chunk, so a hot cell is many tasks.
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    dealt = rows.select("cell", F.pmod(F.xxhash64("node", F.lit(-1)), chunks).cast("int").alias("chunk"), "node", "vec")
    copies = centres.where("of > 1").join(small_side(big), "cell")
    copies = copies.select("cell", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"), "child", "centre")

    def assign(key, left, right):
        if not right.num_rows or not left.num_rows:
            return pa.table({"node": pa.array([], pa.int64()), "vec": pa.array([], pa.list_(pa.float64())), "cell": pa.array([], pa.string())})
        vectors = matrix(left.column("vec"))
        cosines = vectors @ matrix(right.column("centre")).T
        near = np.argsort(-cosines, axis=1, kind="stable")[:, :OVERLAP]
        # Within half the angle of its centre a node has its links there; only the others go to a second one.
        wanted = np.ones(near.shape, bool)
        wanted[:, 1:] = (cosines[np.arange(len(vectors)), near[:, 0]] < half)[:, None]
        child = right.column("child").to_numpy()[near[wanted]]
        rows_ = np.repeat(np.arange(len(vectors)), wanted.sum(1))
        cell = key[0].as_py()
        return pa.table({"node": left.column("node").to_numpy()[rows_], "vec": _lists(vectors[rows_]), "cell": [f"{cell}/{c}" for c in child]})

    meet = dealt.groupBy("cell", "chunk").cogroup(copies.groupBy("cell", "chunk"))
    return meet.applyInArrow(assign, "node bigint, vec array<double>, cell string"), dense


def shards(nodes: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(node, vec, cell) of shards with a graph, and (node, vec, cell, centre) of dense ones."""
    apart, half = (float(np.cos(min(np.pi, x * np.arccos(similarity)))) for x in (1.5, 0.5))
    placed = nodes.select("node", "vec", F.col("space").alias("cell"))
    done, dense = None, None
    for level in range(LEVELS + 1):
        sizes = written(placed.groupBy("cell").agg(F.count("*").alias("n")), "cell-sizes")
        small = placed.join(small_side(sizes.where(F.col("n") <= SHARD).select("cell")), "cell", "left_semi")
        done = small if done is None else done.unionByName(small)
        if sizes.where(F.col("n") > SHARD).isEmpty():
            break
        split, centres = _split(placed, sizes, level, apart, half)
        whole = placed.join(centres, "cell").select("node", "vec", "cell", "centre")
        dense = whole if dense is None else dense.unionByName(whole)
        placed = written(split, "cells")
    none = nodes.limit(0).select("node", "vec", F.lit("").alias("cell"), F.col("vec").alias("centre"))
    return written(done, "shards"), written(none if dense is None else dense, "dense-shards")


def _searched(
    vectors: np.ndarray, graph: np.ndarray, starts: np.ndarray, queries: np.ndarray, beam: int, reach: float, own: np.ndarray | None = None
) -> np.ndarray:
    """Cosines of queries by nodes, -2 where unseen: the nearest unexpanded nodes are expanded while they are among the
    ``beam`` nearest seen, or at least as near as ``reach``. A query that is a node may name it, as an ``own`` entry beside
    the medoids. Rows of the graph are padded with -1."""
    cosines = np.full((len(queries), len(vectors)), -2.0, np.float32)
    cosines[:, starts] = queries @ vectors[starts].T
    if own is not None:
        cosines[np.arange(len(own)), own] = 1
    open_ = cosines.copy()
    live = np.arange(len(queries))
    width = min(EXPANDED_IN_RANGE, len(vectors))
    while len(live):
        ahead = open_[live]
        best = np.argpartition(-ahead, width - 1, axis=1)[:, :width] if width < len(vectors) else np.tile(np.arange(len(vectors)), (len(live), 1))
        near = np.take_along_axis(ahead, best, 1)
        order = np.argsort(-near, axis=1, kind="stable")
        best, near = np.take_along_axis(best, order, 1), np.take_along_axis(near, order, 1)
        known = cosines[live]
        if beam < len(vectors):
            bar = -np.partition(-known, beam - 1, axis=1)[:, beam - 1]
        else:
            bar = np.full(len(live), -2.0, np.float32)
        listed = (near >= bar[:, None]) & (np.arange(width) < EXPANDED)
        go = (near > -2) & (listed | (near >= reach))
        row, column = np.nonzero(go)
        q, node = live[row], best[row, column]
        open_[q, node] = -2
        q, other = np.repeat(q, graph.shape[1]), graph[node].ravel()
        fresh = other >= 0
        q, other = q[fresh], other[fresh]
        flat = np.unique(q * np.int64(len(vectors)) + other)
        flat = flat[cosines.ravel()[flat] <= -2]
        q, other = flat // len(vectors), flat % len(vectors)
        for low in range(0, len(q), 1 << 16):
            part = slice(low, low + (1 << 16))
            cosines[q[part], other[part]] = open_[q[part], other[part]] = np.einsum("ij,ij->i", queries[q[part]], vectors[other[part]])
        live = live[go.any(1)]
    return cosines


def robust_pruned(vectors: np.ndarray, node: int, candidates: np.ndarray, degree: int = DEGREE, slack: float = SLACK) -> np.ndarray:
    """Of the candidates the nearest one, without those to which it is much nearer than the node is, then the next."""
    candidates = candidates[candidates != node]
    angle = np.arccos(np.clip(vectors[candidates] @ vectors[node], -1, 1))
    order = np.argsort(angle, kind="stable")
    candidates, angle = candidates[order], angle[order]
    kept = []
    alive = np.ones(len(candidates), bool)
    between = np.arccos(np.clip(vectors[candidates] @ vectors[candidates].T, -1, 1))
    for i in range(len(candidates)):
        if alive[i]:
            kept.append(i)
            if len(kept) == degree:
                break
            alive &= slack * between[i] > angle
    return candidates[kept]


def medoids(vectors: np.ndarray) -> np.ndarray:
    """The vectors nearest to the centres of clusters, where searches start."""
    centres = fitted_centroids(vectors, len(vectors) // A_MEDOID, 2.0)
    return np.unique((vectors @ centres.T).argmax(0))


def flat_graph(vectors: np.ndarray, degree: int = DEGREE, beam: int = BEAM) -> list[np.ndarray]:
    """Neighbours of each vector; inserted in batches of doubling size from the medoid on."""
    n = len(vectors)
    single = vectors.astype(np.float32)
    graph = np.full((n, degree), -1, np.int64)
    starts = medoids(vectors)
    for node in starts:
        chosen = robust_pruned(single, node, starts, degree)
        graph[node, : len(chosen)] = chosen
    order = np.random.default_rng(n).permutation(n)
    order = np.concatenate([starts, order[~np.isin(order, starts)]])
    at = len(starts)
    while at < n:
        batch = order[at : at + min(at, QUERIES)]
        cosines = _searched(single, graph, starts, single[batch], beam, 2.0)
        count = min(n, 2 * beam)
        nearest = np.argpartition(-cosines, count - 1, axis=1)[:, :count]
        back: dict[int, list[int]] = {}
        # Those of one batch may be each other's neighbours, though no search can find them yet.
        among = single[batch] @ single[batch].T
        few = min(len(batch), beam // 2)
        fellows = batch[np.argpartition(-among, few - 1, axis=1)[:, :few]]
        for i, node in enumerate(batch):
            found = nearest[i][cosines[i][nearest[i]] > -2]
            chosen = robust_pruned(single, node, np.unique(np.concatenate([found, fellows[i]])), degree)
            graph[node, : len(chosen)] = chosen
            for other in chosen:
                back.setdefault(int(other), []).append(int(node))
        for node, more in back.items():
            own = graph[node][graph[node] >= 0]
            every = np.unique(np.concatenate([own, more]))
            chosen = robust_pruned(single, node, every, degree, SLACK if len(every) > degree else 1e9)
            graph[node] = -1
            graph[node, : len(chosen)] = chosen
        at += len(batch)
    lists = [row[row >= 0] for row in graph]
    # Lists start with the nearest. It leads back, however many nearer ones it has, so that no node is without a way in.
    for node in range(n):
        if len(lists[node]) and node not in lists[lists[node][0]]:
            lists[lists[node][0]] = np.append(lists[lists[node][0]], node)
    return _reachable(single, lists, starts)


def _reachable(vectors: np.ndarray, graph: list[np.ndarray], starts: np.ndarray) -> list[np.ndarray]:
    """The graph with edges both ways between every part that no start reaches and the nearest node that one does."""
    reached = np.zeros(len(graph), bool)
    edge = starts.tolist()
    while True:
        reached[edge] = True
        while edge:
            ahead = np.unique(np.concatenate([graph[i] for i in edge]).astype(np.int64))
            edge = ahead[~reached[ahead]].tolist()
            reached[edge] = True
        left = np.nonzero(~reached)[0]
        if not len(left):
            return graph
        new = int(left[0])
        edge = [new]
        known = np.nonzero(reached)[0]
        near = int(known[(vectors[known] @ vectors[new]).argmax()])
        graph[near], graph[new] = np.append(graph[near], new), np.append(graph[new], near)


def adjacency(placed: DataFrame) -> DataFrame:
    """(node, neighbours, places): the united lists of all shards of a node, and the shards themselves."""

    def build(key, table):
        names = table.column("node").to_numpy()
        graph = flat_graph(matrix(table.column("vec")))
        ends = np.cumsum([0, *(len(x) for x in graph)], dtype=np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(names[np.concatenate(graph).astype(np.int64)]))
        return pa.table({"node": names, "cell": [key[0].as_py()] * len(names), "neighbours": lists})

    lists = placed.groupBy("cell").applyInArrow(build, "node bigint, cell string, neighbours array<bigint>")
    return written(lists, "adjacency").groupBy("node").agg(
        F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours"), F.collect_set("cell").alias("places")
    )


def forest(found: np.ndarray) -> np.ndarray:
    """The first vector of the component of each vector, from a symmetric matrix of links."""
    first = np.full(len(found), -1)
    for i in range(len(found)):
        if first[i] >= 0:
            continue
        first[i] = i
        edge = np.array([i])
        while len(edge):
            reached = found[edge].any(0) & (first < 0)
            first[reached] = i
            edge = np.nonzero(reached)[0]
    return first


_FOUND = "node bigint, other bigint, links bigint"


def _found(names: np.ndarray, counts: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Table:
    """Rows of numbers of links, and of links of a forest, which have an ``other``."""
    other = pa.array([*[None] * len(names), *b.tolist()], pa.int64())
    return pa.table({"node": np.concatenate([names, a]).astype(np.int64), "other": other, "links": np.concatenate([counts, np.zeros(len(a))]).astype(np.int64)})


def _elsewhere(places: list[list[str]], here: str) -> np.ndarray:
    """Two vectors whose rows share a column are counted in another shard, which comes before this one."""
    before = sorted({p for own in places for p in own if p < here})
    column = {p: i for i, p in enumerate(before)}
    marks = np.zeros((len(places), max(1, len(before))), np.float32)
    for i, own in enumerate(places):
        for p in own:
            if p in column:
                marks[i, column[p]] = 1
    return marks


def _search(placed: DataFrame, index: DataFrame, similarity: float, beam: int) -> DataFrame:
    """(node, other, links): see ``_found``; every node is a query in each of its shards."""

    def search(key, table):
        names = table.column("node").to_numpy()
        order = np.argsort(names)
        table, names = table.take(order), names[order]
        vectors = matrix(table.column("vec"))
        single = vectors.astype(np.float32)
        weight = table.column("weight").to_numpy()
        lists = table.column("neighbours").combine_chunks()
        flat = lists.flatten().to_numpy()
        place = np.searchsorted(names, flat).clip(max=len(names) - 1)
        here = names[place] == flat
        lengths = np.diff(lists.offsets.to_numpy())
        owner = np.repeat(np.arange(len(names)), lengths)[here]
        sizes = np.bincount(owner, minlength=len(names))
        graph = np.full((len(names), max(1, sizes.max(initial=0))), -1, np.int64)
        graph[owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = place[here]
        starts = medoids(vectors)
        linked = np.zeros((len(names), len(names)), bool)
        for low in range(0, len(names), QUERIES):
            own = np.arange(low, min(low + QUERIES, len(names)))
            cosines = _searched(single, graph, starts, single[own], beam, similarity - 0.01, own)
            q, other = np.nonzero(cosines >= similarity - 1e-4)
            for part in range(0, len(q), 1 << 16):
                x, y = q[part : part + (1 << 16)] + low, other[part : part + (1 << 16)]
                linked[x, y] = np.einsum("ij,ij->i", vectors[x], vectors[y]) >= similarity
        linked |= linked.T
        np.fill_diagonal(linked, False)
        marks = _elsewhere(table.column("places").to_pylist(), key[0].as_py())
        first = forest(linked)
        counts = (linked & (marks @ marks.T == 0)) @ weight
        tied = np.nonzero(first != np.arange(len(names)))[0]
        return _found(names, counts, names[tied], names[first[tied]])

    return placed.join(index, "node").groupBy("cell").applyInArrow(search, _FOUND)


def _balls(dense: DataFrame, similarity: float) -> DataFrame:
    """(node, vec, cell, inner): whether the vector is within half the angle of the threshold around the centre.

    A vector of several such balls is inner in the first one only.
    """
    half = float(np.cos(np.arccos(similarity) / 2))
    cosine = F.aggregate(F.zip_with("vec", "centre", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    near = written(dense.select("node", "vec", "cell", (cosine >= half + _MARGIN).alias("near")), "near-centres")
    ball = near.where("near").groupBy("node").agg(F.min("cell").alias("ball"))
    return near.join(ball, "node", "left").select("node", "vec", "cell", F.coalesce(F.col("cell") == F.col("ball"), F.lit(False)).alias("inner"))


def _dense_links(balls: DataFrame, index: DataFrame, weights: DataFrame, similarity: float) -> DataFrame:
    """(node, other, links) of dense shards: one sum for the inner vectors, blocks for the others."""
    whole = balls.groupBy("cell").agg(F.sum(F.when(F.col("inner"), F.col("weight"))).alias("sum"), F.min(F.when(F.col("inner"), F.col("node"))).alias("least"))
    inner = balls.where("inner").join(whole, "cell")
    counted = inner.select("node", F.lit(None).cast("bigint").alias("other"), (F.col("sum") - F.col("weight")).alias("links"))
    tied = inner.where("node != least").select("node", F.col("least").alias("other"), F.lit(0).cast("bigint").alias("links"))

    sizes = balls.groupBy("cell").agg(F.count_if(~F.col("inner")).alias("outside"), F.count_if("inner").alias("inside"))
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    sizes = sizes.select("cell", blocks("outside").alias("outs"), blocks("inside").alias("ins")).where("outs > 0")
    dealt = lambda c: F.pmod(F.xxhash64("node"), F.col(c)).cast("int")
    block = F.when(F.col("inner"), F.col("outs") + dealt("ins")).otherwise(dealt("outs"))
    rows = balls.join(small_side(written(sizes, "dense-sizes")), "cell").withColumn("block", block).join(index.select("node", "places"), "node")
    # An inner block meets all outer ones, an outer one meets all.
    last = F.when(F.col("inner"), F.col("outs")).otherwise(F.col("outs") + F.col("ins")) - 1
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), last)).alias("with"))
    rows = rows.withColumns({"i": F.least("block", "with"), "j": F.greatest("block", "with")})

    def compare(key, table):
        cell, i, j = (k.as_py() for k in key)
        names, vectors = table.column("node").to_numpy(), matrix(table.column("vec"))
        weight, block_ = table.column("weight").to_numpy(), table.column("block").to_numpy()
        linked = (vectors @ vectors.T >= similarity) & ((block_[:, None] != block_[None, :]) | (i == j))
        np.fill_diagonal(linked, False)
        marks = _elsewhere(table.column("places").to_pylist(), cell)
        first = forest(linked)
        at = np.nonzero(first != np.arange(len(names)))[0]
        return _found(names, (linked & (marks @ marks.T == 0)) @ weight, names[at], names[first[at]])

    return counted.unionByName(tied).unionByName(rows.groupBy("cell", "i", "j").applyInArrow(compare, _FOUND))


def links(nodes: DataFrame, similarity: float = SIMILARITY, beam: int = BEAM, least_recall: float = LEAST_RECALL) -> DataFrame:
    """(node, other, links): rows with a number of links to add to a node, and rows of a forest over all links."""
    placed, dense = shards(nodes, similarity)
    weights = nodes.select("node", "weight")
    balls = written(_balls(dense, similarity).join(weights, "node"), "balls")
    # A pair of inner vectors is counted in its ball before anything else: "!" comes before every other name.
    balls_places = balls.select("node", F.explode(F.when(F.col("inner"), F.array(F.concat(F.lit("!"), "cell"), "cell")).otherwise(F.array("cell"))).alias("cell"))
    placed = placed.join(weights, "node")
    index = adjacency(placed)
    more = balls_places.groupBy("node").agg(F.collect_set("cell").alias("more"))
    none = F.array().cast("array<string>")
    index = index.join(more, "node", "full_outer").select(
        "node", F.coalesce("neighbours", F.array().cast("array<bigint>")).alias("neighbours"),
        F.array_union(F.coalesce("places", none), F.coalesce("more", none)).alias("places"),
    )
    index = written(index, "index")
    exact = _dense_links(balls, index, weights, similarity)
    for _ in range(WIDER):
        found = written(_search(placed, index, similarity, beam).unionByName(exact), "found")
        if recall(nodes, found, similarity) >= least_recall:
            break
        beam *= 2
    return found


def recall(nodes: DataFrame, found: DataFrame, similarity: float = SIMILARITY, audited: int = AUDITED) -> float:
    """The share of the links of a sample of nodes (some ``audited`` of them, chosen by hash) that were found; 1 if none has any."""
    n = nodes.count()
    chosen = nodes.where(F.pmod(F.xxhash64("node", F.lit(7)), F.lit(max(1, n))) < audited).select("node", "space", "vec", "weight").collect()
    told = shared_value(nodes.sparkSession, [(r.space, r.node, r.vec) for r in chosen])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spaces: dict[str, tuple[list, list]] = {}
        for space, node, vec in told.value[1]:
            names, vectors = spaces.setdefault(space, ([], []))
            names.append(node)
            vectors.append(vec)
        for batch in batches:
            own = np.array(batch.column(1).to_pylist(), object)
            for space, (names, vectors) in spaces.items():
                at = np.nonzero(own == space)[0]
                if not len(at):
                    continue
                part = batch.take(pa.array(at))
                names_ = part.column(0).to_numpy()
                near = np.array(vectors) @ matrix(part.column(2)).T >= similarity
                near &= np.array(names)[:, None] != names_[None, :]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(near @ part.column(3).to_numpy(), pa.int64())], names=["node", "exact"])

    exact = nodes.select("node", "space", "vec", "weight").mapInArrow(count, "node bigint, exact bigint").groupBy("node").agg(F.sum("exact").alias("exact"))
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    shares = exact.join(counted, "node", "left").agg(F.sum("exact").alias("exact"), F.sum(F.least(F.coalesce("links", F.lit(0)), "exact")).alias("links")).first()
    return (shares["links"] or 0) / shares["exact"] if shares["exact"] else 1.0


def label(
    df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", group: str = "label", similarity: float = SIMILARITY, **settings
) -> DataFrame:
    """One row for each row: (id, n_links, component_id, kept); see the docstring of the module."""
    rows, nodes = prepared(df, id_column, vector, group)
    found = links(nodes, similarity, **settings)
    tied = found.where(F.col("other").isNotNull()).select(F.col("node").alias("a"), F.col("other").alias("b"))
    roots = written(components(tied), "components")
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = nodes.join(roots, "node", "left").join(counted, "node", "left")
    named = named.select("x", "y", "first_id", F.coalesce("root", "node").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    named = written(named, "linked")
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = named.join(least, "root").select(F.col("x").alias("nx"), F.col("y").alias("ny"), "n_links", "component_id")
    out = rows.join(named, (F.col("x") == F.col("nx")) & (F.col("y") == F.col("ny")), "left")
    alone = F.col("nx").isNull()
    component = F.when(alone, F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(id_column),
        F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
