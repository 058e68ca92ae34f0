"""Trie of the prefixes of conversations that are rebuilt from a shared head and an own suffix.

A rebuilt conversation is the head of its base (the first turns of another conversation) and its own turns behind
its own head. Its texts are never put together. A sequence of turns has a fingerprint, a product of the affine
maps x -> B x + h(turn) modulo a prime, in four lanes with bases of their own; products compose, so the
prefixes of a rebuilt conversation are those of its base up to the head, then head times own suffix, where
the suffix is the own prefix divided by the own head. Only numbers of turns are shuffled.

Prefixes of equal depth and fingerprint are a node. Equality is verified through the stored references of turns, not
believed: all members of a node must refer to the same last turn and come from the same parent, and
all turns of one reference must hold the same role and text; if one does not, all is done again with other seeds.

A node is named by its smallest member and its depth. What a node adds to its ancestors is put on the row of its
smallest member; sums over a subtree are then sums, over the members of its top, of what lies behind it on each
member's own path: one running sum a conversation and one aggregate, without a loop over depths.

Order of turns is made in slices of ``SLICE`` numbers of turns, and paths are summed in slices of ``SLICE`` depths, so
a conversation of very many turns is no single task. A digest over the ids of a node needs them in order: ids come as
runs of text, one for each ``RUN`` numbers, made by as many tasks; only runs of one node meet in a task, which
streams them through the digest and holds one at a time.

Defined results: NULL role and text are empty; turns are put in order with NULL first, turns of the same number by a hash
of role and text. Rows without a conversation are left out. A conversation whose base is absent has no head. Repeated
rows are turns of their own. An empty table has no node, not even the root. Extra columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import small_side, written

HEADS, BASES = 6, 100
SLICE = 4096
RUN = 8192
PRIME = (1 << 31) - 1
LANES = tuple(f"f{i}" for i in range(4))
ATTEMPTS = 4


class Collision(RuntimeError):
    """Different turns or prefixes share a fingerprint."""


def bases(seed: int) -> np.ndarray:
    """One multiplier for each lane."""
    return np.random.default_rng([20_011, seed]).integers(1 << 20, PRIME - 1, len(LANES))


def powers(base: int, exponents: np.ndarray) -> np.ndarray:
    """base ** exponents modulo ``PRIME``."""
    found, square, left = np.ones(len(exponents), np.int64), int(base), exponents.astype(np.int64)
    while left.any():
        found = np.where(left & 1, found * square % PRIME, found)
        square, left = square * square % PRIME, left >> 1
    return found


def turns_of(df: DataFrame, seed: int, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, slice, turn, a, b, chars): each turn with its reference, 128 bits of hash of role and text."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    number = F.col(turn).cast("long")
    rows = df.where(F.col(conversation).isNotNull())
    return rows.select(
        F.col(conversation).cast("long").alias("conv"),
        # NULL turns come first: their slice is NULL too.
        F.floor(number / F.lit(float(SLICE))).cast("long").alias("slice"),
        number.alias("turn"),
        F.xxhash64(F.lit(2 * seed), *said, F.char_length(said[0])).alias("a"),
        F.xxhash64(F.lit(2 * seed + 1), F.char_length(said[0]), *said).alias("b"),
        F.char_length(said[1]).cast("long").alias("chars"),
        *(c.alias(name) for c, name in zip(said, ("role", "text"), strict=True)),
    )


def verify_turns(turns: DataFrame) -> None:
    """All turns of a reference must be equal; texts are read again only where a reference comes twice."""
    repeated = turns.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1").select("a", "b")
    said = turns.join(small_side(written(repeated, "repeated-turns")), ["a", "b"], "left_semi")
    sides = [f(F.struct("role", "text")) for f in (F.min, F.max)]
    if not said.groupBy("a", "b").agg(sides[0].alias("x"), sides[1].alias("y")).where("x != y").isEmpty():
        raise Collision("two turns share a hash")


def _folded(turns: DataFrame, seed: int) -> DataFrame:
    """(conv, slice, j, a, b, chars, lanes): place and prefix fingerprint of each turn inside its slice."""
    multipliers = bases(seed)
    # Spark's own sort spills; the pass behind it holds one batch and the end of the last one.
    order = turns.select("conv", "slice", "turn", "a", "b", "chars")
    order = order.repartition("conv", "slice").sortWithinPartitions("conv", F.asc_nulls_first("slice"), F.asc_nulls_first("turn"), "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, at, sums = None, 0, np.zeros(len(LANES), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column(0).to_numpy(zero_copy_only=False)
            absent = batch.column(1).is_null().to_numpy(zero_copy_only=False)
            piece = batch.column(1).fill_null(0).to_numpy(zero_copy_only=False)
            new = np.ones(len(conv), bool)
            new[1:] = (conv[1:] != conv[:-1]) | (piece[1:] != piece[:-1]) | (absent[1:] != absent[:-1])
            first = (int(conv[0]), int(piece[0]), bool(absent[0]))
            goes_on = first == last
            group = np.cumsum(new) - 1
            start = np.nonzero(new)[0]
            # The first group may go on from the last batch.
            j = np.arange(len(conv)) - start[group] + 1 + np.where(group == 0, at if goes_on else 0, 0)
            halves = [batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (3, 4)]
            columns = []
            for lane, base in enumerate(multipliers):
                # Each lane sees the turn by its own part of the hash.
                seen = ((halves[lane // 2] >> np.uint64(32 * (lane % 2))) % np.uint64(PRIME)).astype(np.int64)
                added = seen * powers(base, j) % PRIME
                total = np.cumsum(added)
                before = (total - added)[start]
                carried = np.where(group == 0, sums[lane] if goes_on else 0, 0)
                columns.append((total - before[group] + carried) % PRIME)
            last, at = (int(conv[-1]), int(piece[-1]), bool(absent[-1])), int(j[-1])
            sums = np.array([c[-1] for c in columns])
            arrays = [batch.column(0), batch.column(1), pa.array(j), *(batch.column(i) for i in (3, 4, 5)), *map(pa.array, columns)]
            yield pa.RecordBatch.from_arrays(arrays, names=["conv", "slice", "j", "a", "b", "chars", *LANES])

    lanes = ", ".join(f"{lane} bigint" for lane in LANES)
    return order.mapInArrow(run, f"conv bigint, slice bigint, j bigint, a bigint, b bigint, chars bigint, {lanes}")


def prefixes(turns: DataFrame, seed: int) -> DataFrame:
    """(conv, j, a, b, chars, lanes): fingerprints of all prefixes of the given conversations."""
    local = written(_folded(turns, seed), "slices")
    ends = local.groupBy("conv", "slice").agg(F.max(F.struct("j", *LANES)).alias("end"))
    several = ends.groupBy("conv").agg(F.count("*").alias("n")).where("n > 1").select("conv")
    ends = ends.join(several, "conv", "left_semi").select("conv", "slice", "end.*")
    kind = "conv bigint, slice bigint, before bigint, " + ", ".join(f"m{i} bigint, {lane}_0 bigint" for i, lane in enumerate(LANES))
    multipliers = bases(seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What lies before each slice: the product of the slices in front of it."""
        conv, before, sums = None, 0, [0] * len(LANES)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["conv"] != conv:
                    conv, before, sums = row["conv"], 0, [0] * len(LANES)
                shift = [pow(int(base), before, PRIME) for base in multipliers]
                out.append([conv, row["slice"], before, *(x for pair in zip(shift, sums, strict=True) for x in pair)])
                sums = [(s + m * row[lane]) % PRIME for s, m, lane in zip(sums, shift, LANES, strict=True)]
                before += row["j"]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)] or [pa.array([], pa.int64())] * 11, names=names)

    names = [part.split()[0] for part in kind.split(", ")]
    offsets = ends.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_first("slice")).mapInArrow(run, kind)
    offsets = written(offsets.where("before > 0"), "offsets").withColumnsRenamed({"conv": "o_conv", "slice": "o_slice"})
    met = local.join(small_side(offsets), (F.col("conv") == F.col("o_conv")) & F.col("slice").eqNullSafe(F.col("o_slice")), "left")
    moved = [F.when(F.col("before").isNull(), F.col(x)).otherwise((F.col(f"{x}_0") + F.col(f"m{i}") * F.col(x)) % PRIME).alias(x) for i, x in enumerate(LANES)]
    return met.select("conv", (F.col("j") + F.coalesce("before", F.lit(0))).alias("j"), "a", "b", "chars", *moved)


def _at(heads: Column, place: Column, lane: str) -> Column:
    return F.coalesce(F.try_element_at(heads, F.nullif(place, F.lit(0)))[lane], F.lit(0).cast("long"))


def rebuilt(own: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv, len) and their rows (conv, depth, len, a, b, chars, lanes), by fingerprints alone."""
    first = F.when(F.col("j") < HEADS, F.struct("j", "a", "b", "chars", *LANES))
    heads = own.groupBy("conv").agg(F.sort_array(F.collect_list(first)).alias("heads"), F.max("j").alias("own"))
    heads = written(heads, "heads")
    base = heads.select(F.col("conv").alias("base"), F.col("heads").alias("theirs")).where(F.col("base") % BASES == 0)
    convs = heads.withColumn("base", F.col("conv") - F.col("conv") % BASES).join(base, "base", "left")
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).cast("int")
    convs = convs.withColumn("h", h).withColumn("k", F.least("h", F.size(F.coalesce("theirs", F.array()))).cast("int"))
    convs = convs.withColumn("len", F.col("k") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    convs = written(convs, "conversations")

    # An own prefix stands behind h turns, a suffix behind k: divided by the base as often as the head is shorter.
    inverse = [[pow(int(b), -n, PRIME) for n in range(HEADS)] for b in bases(seed)]
    back = [F.element_at(F.array(*(F.lit(x).cast("long") for x in row)), F.col("h") - F.col("k") + 1) for row in inverse]
    joints = [
        F.struct(_at(F.col("theirs"), F.col("k"), lane).alias("head"), _at(F.col("heads"), F.col("h"), lane).alias("mine"), back[i].alias("back")).alias(f"{lane}_j")
        for i, lane in enumerate(LANES)
    ]
    told = convs.select("conv", "h", "k", "len", *joints)
    suffix = own.join(told, "conv").where("j > h")
    # head + back * (prefix - own head), in this order below 2^63.
    lanes = [(F.col(f"{x}_j.head") + F.col(f"{x}_j.back") * ((F.col(x) - F.col(f"{x}_j.mine") + PRIME) % PRIME)) % PRIME for x in LANES]
    suffix = suffix.select(
        "conv", (F.col("j") - F.col("h") + F.col("k")).alias("depth"), "len", "a", "b", "chars", *(c.alias(x) for c, x in zip(lanes, LANES, strict=True))
    )
    head = convs.where("k > 0").select("conv", "len", F.explode(F.slice("theirs", 1, F.col("k"))).alias("x"))
    head = head.select("conv", F.col("x.j").alias("depth"), "len", "x.a", "x.b", "x.chars", *(F.col(f"x.{lane}") for lane in LANES))
    return convs.select("conv", "len"), head.unionByName(suffix)


def _nodes(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_leaves, saved_tokens) of rows of rebuilt conversations, verified."""
    top = convs.agg(F.min("conv").alias("conv"), F.count("*").alias("n"), F.max("len").alias("longest")).first()
    least = lambda name: F.lit(top[name]).cast("long").alias(name if name != "conv" else "owner")
    key = ["depth", *LANES]
    same = [F.min("a") == F.max("a"), F.min("b") == F.max("b")]
    shared = rows.groupBy(*key).agg(
        F.min("conv").alias("owner"), F.count("*").alias("n"), F.max("len").alias("longest"), (same[0] & same[1]).alias("same")
    )
    shared = written(shared.where("n > 1"), "shared-prefixes")
    if not shared.where("not same").isEmpty():
        raise Collision("two prefixes share a fingerprint")
    named = rows.join(shared.drop("same"), key, "left")
    named = named.select(
        "conv", "depth", "len", "chars", F.coalesce("owner", "conv").alias("owner"), F.coalesce("n", F.lit(1)).alias("n"), F.coalesce("longest", "len").alias("longest")
    )
    roots = convs.select("conv", F.lit(0).cast("long").alias("depth"), "len", F.lit(0).cast("long").alias("chars"), least("conv"), least("n"), least("longest"))
    mine = F.col("owner") == F.col("conv")
    adds = [
        F.when(mine, (F.col("n") - 1) * F.col("chars")).otherwise(0).alias("saved"),
        F.when(mine & (F.col("longest") == F.col("depth")), 1).otherwise(0).cast("long").alias("leaves"),
    ]
    path = written(named.unionByName(roots).select("conv", "depth", "len", "owner", *adds), "paths")

    # The last row of a slice stands in the next one too, as the parent of its first row, and adds nothing there.
    piece = F.floor(F.col("depth") / F.lit(float(SLICE))).cast("long")
    ends = F.col("depth") % SLICE == SLICE - 1
    sliced = path.withColumn("piece", F.explode(F.when(ends, F.array(piece, piece + 1)).otherwise(F.array(piece))))
    ghost = F.col("piece") != piece
    sliced = sliced.withColumns({"ghost": ghost, "saved": F.when(ghost, 0).otherwise(F.col("saved")), "leaves": F.when(ghost, 0).otherwise(F.col("leaves"))})
    upward = Window.partitionBy("conv", "piece").orderBy(F.desc("depth"))
    behind = upward.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = sliced.select(
        "conv", "depth", "len", "owner", "piece", "ghost", F.lead("owner").over(upward).alias("parent"),
        F.sum("saved").over(behind).alias("saved"), F.sum("leaves").over(behind).alias("leaves"),
    ).where("not ghost")
    whole = sliced.groupBy("conv", "piece").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    long_ones = convs.where(F.col("len") >= SLICE).select("conv")
    onward = Window.partitionBy("conv").orderBy(F.desc("piece")).rowsBetween(Window.unboundedPreceding, -1)
    later = whole.join(long_ones, "conv", "left_semi").select("conv", "piece", F.sum("saved").over(onward).alias("more_saved"), F.sum("leaves").over(onward).alias("more_leaves"))
    summed = summed.join(small_side(written(later, "later-slices")), ["conv", "piece"], "left")
    total = lambda name: F.sum(F.col(name) + F.coalesce(f"more_{name}", F.lit(0)))
    nodes = summed.groupBy("owner", "depth").agg(
        F.count("*").alias("n_convs"), total("leaves").alias("n_leaves"), total("saved").alias("saved_tokens"),
        F.min("parent").alias("parent_conv_id"), F.max("parent").alias("other_parent"),
    )
    nodes = written(nodes.withColumnRenamed("owner", "conv_id"), "nodes")
    if not nodes.where("parent_conv_id != other_parent").isEmpty():
        raise Collision("prefixes of one fingerprint have different parents")
    ends = path.where("depth = len").select("conv", "owner", "depth")
    return nodes.drop("other_parent"), ends


def ends_digests(ends: DataFrame, run_length: int = RUN) -> DataFrame:
    """(owner, depth, ends_sha256) of rows (conv, owner, depth): the digest of the ids in order, joined by commas."""
    run = F.floor(F.col("conv") / F.lit(float(run_length))).cast("long")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    runs = ends.groupBy("owner", "depth", run.alias("run")).agg(joined.alias("ids"))
    runs = written(runs, "runs-of-ids")
    one = runs.groupBy("owner", "depth").agg(F.count("*").alias("n"), F.min("ids").alias("ids"))
    single = one.where("n = 1").select("owner", "depth", F.sha2("ids", 256).alias("ends_sha256"))
    several = runs.join(one.where("n > 1").select("owner", "depth"), ["owner", "depth"], "left_semi")
    several = several.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "run").select("owner", "depth", "ids")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(done: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, k in enumerate(kinds)], names=["owner", "depth", "ends_sha256"])

        key, digest = None, None
        for batch in batches:
            done = []
            for owner, depth, ids in zip(*(batch.column(i) for i in range(3)), strict=True):
                own = (owner.as_py(), depth.as_py())
                if own == key:
                    digest.update(b",")
                else:
                    if key:
                        done.append((*key, digest.hexdigest()))
                    key, digest = own, hashlib.sha256()
                digest.update(ids.as_py().encode())
            yield batch_of(done)
        if key:
            yield batch_of([(*key, digest.hexdigest())])

    return single.unionByName(several.mapInArrow(stream, "owner bigint, depth bigint, ends_sha256 string"))


def trie(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    for seed in range(ATTEMPTS):
        turns = turns_of(df, seed, conversation, turn, role, text)
        try:
            verify_turns(turns)
            own = written(prefixes(turns, seed), "own-prefixes")
            convs, rows = rebuilt(own, seed)
            nodes, ends = _nodes(convs, written(rows, "rebuilt"))
        except Collision:
            if seed == ATTEMPTS - 1:
                raise
            continue
        break
    children = nodes.where("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
    children = children.agg(F.count("*").alias("n_children"))
    digests = ends_digests(ends).withColumnRenamed("owner", "conv_id")
    out = nodes.join(children, ["conv_id", "depth"], "left").join(digests, ["conv_id", "depth"], "left")
    return out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
