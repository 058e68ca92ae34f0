"""Divergence of the sources of each language, from term counts that are folded inside the mappers.

A partition folds whole documents into stripes: each term of a language points to its counts by source, together
with the documents that hold it. Stripes beyond a bounded number are spilled, as their cells, so that a stripe
of a common word from every partition never meets in one task; cells are summed by key and gathered to whole
stripes, one row a term, which is as long as the language has sources. Terms of too few documents go.

The merged stripes emit the divergences. For two sources the sum runs over every kept term, but only terms that
both hold are looked at in pairs, inside the task: what a term adds that one or none of both holds depends on
its count alone, so it is a sum over the histogram of counts. No pair of sources is a row before it is a sum.

All arithmetic is in whole numbers. With ``SCALE`` = 10^9, shares are 1 + floor(SCALE (count + 1) / (N + V)),
and what a term adds is floor((p - q)^2 / q). Sums of it stay below 2^63, as shares of a group add up to
SCALE + 2 V.

What is broadcast are the totals of groups, one row a source. The result has a row for each two sources of a
language, so a table of groups too large to broadcast has no result that could be returned; above
``BROADCAST_ROWS`` groups the operator refuses before the pass.

Defined results: NULL text, language and source read as ''. A group without terms, and a language without kept
terms (V = 0), has its pairs with the value 0 where V is 0, and no terms. A language of one source has no pairs.
Repeated rows and ids are documents of their own; ids are not read. Extra columns are ignored, whatever their
names. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import BROADCAST_ROWS, made_once, shared_value, small_side, written

MIN_DOCUMENTS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
# Cells that a mapper holds before it spills them, and pairs of cells that are looked at at a time.
HELD_CELLS = 400_000
PAIRS = 1 << 20
# A cell holds documents above this bit and occurrences below it.
DOCUMENT = 1 << 40

# Bytes of a term: A-Z to lower case, a-z, and all bytes of characters beyond ASCII; the rest separates.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(raw: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return raw.translate(_TERM_BYTES).split()


def fold(stripes: dict[bytes, dict[str, int]], source: str, raw: bytes) -> int:
    """Add a whole document to the stripes of its language; returns the new cells."""
    new = 0
    for term, n in Counter(terms(raw)).items():
        stripe = stripes.get(term)
        if stripe is None:
            stripes[term] = {source: n + DOCUMENT}
            new += 1
        elif source in stripe:
            stripe[source] += n + DOCUMENT
        else:
            stripe[source] = n + DOCUMENT
            new += 1
    return new


_CELLS = pa.schema([("lang", pa.string()), ("term", pa.string()), ("source", pa.string()), ("cell", pa.int64())])


def _spilled(held: dict[str, dict[bytes, dict[str, int]]]) -> Iterator[pa.RecordBatch]:
    for lang, stripes in held.items():
        names: list[bytes] = []
        sources: list[str] = []
        cells: list[int] = []
        for term, stripe in stripes.items():
            names.extend(repeat(term, len(stripe)))
            sources.extend(stripe)
            cells.extend(stripe.values())
            if len(cells) >= 50_000:
                yield _batch(lang, names, sources, cells)
                names, sources, cells = [], [], []
        if cells:
            yield _batch(lang, names, sources, cells)


def _batch(lang: str, names: list[bytes], sources: list[str], cells: list[int]) -> pa.RecordBatch:
    columns = [pa.repeat(pa.scalar(lang, pa.string()), len(cells)), pa.array(names, pa.binary()).cast(pa.string()), pa.array(sources, pa.string()), pa.array(cells, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, schema=_CELLS)


def spilled_cells(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, term, source, cell): what the mappers spill; equal keys come from several of them."""
    filled = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(k) for c, k in ((lang, "lang"), (source, "source"))]
    docs = df.select(*filled, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("raw"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[bytes, dict[str, int]]] = {}
        cells = 0
        for batch in batches:
            for own, place, raw in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2), strict=True):
                cells += fold(held.setdefault(own.as_py(), {}), place, raw.as_py())
                if cells >= HELD_CELLS:
                    yield from _spilled(held)
                    held, cells = {}, 0
        yield from _spilled(held)

    return docs.mapInArrow(run, "lang string, term string, source string, cell bigint")


def stripes(df: DataFrame, min_documents: int = MIN_DOCUMENTS, **columns: str) -> DataFrame:
    """(lang, term, total, sources, counts) of each term in at least ``min_documents`` documents of its language."""
    cells = spilled_cells(df, **columns)
    # Documents and occurrences are summed apart; in one mapper no sum reaches the bit between them.
    merged = cells.groupBy("lang", "term", "source").agg(
        F.sum(F.shiftright("cell", 40)).alias("df"), F.sum(F.col("cell").bitwiseAND(F.lit(DOCUMENT - 1))).alias("count")
    )
    whole = merged.groupBy("lang", "term").agg(
        F.sum("df").alias("df"), F.sum("count").alias("total"), F.collect_list(F.struct("source", "count")).alias("cells")
    )
    kept = whole.where(F.col("df") >= min_documents)
    return kept.select("lang", "term", "total", F.col("cells.source").alias("sources"), F.col("cells.count").alias("counts"))


def totals(df: DataFrame, kept: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, n, held, v, n_lang): every group with its occurrences and number of kept terms, and its language's."""
    fill = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    groups = df.select(fill(lang).alias("lang"), fill(source).alias("source")).distinct()
    cells = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("c"))
    n = cells.groupBy("lang", F.col("c.sources").alias("source")).agg(F.sum("c.counts").alias("n"), F.count("*").alias("held"))
    of_lang = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("n_lang"))
    zero = {c: F.coalesce(F.col(c), F.lit(0).cast("long")) for c in ("n", "held", "v", "n_lang")}
    return groups.join(n, ["lang", "source"], "left").join(of_lang, "lang", "left").withColumns(zero)


def share(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(SCALE (count + 1) / (n + v)); 0 where the language keeps no term."""
    top = (count.cast("decimal(20,0)") + 1) * F.lit(SCALE).cast("decimal(10,0)")
    both = F.when(n + v > 0, n + v)
    whole = F.call_function("div", top, both.cast("decimal(20,0)"))
    return F.coalesce(whole + 1, F.lit(0).cast("long"))


def added(p: Column, q: Column) -> Column:
    """What a term of the shares p and q adds."""
    return F.coalesce(F.call_function("div", (p - q) * (p - q), F.when(q > 0, q)), F.lit(0).cast("long"))


def shares(counts: np.ndarray, both: np.ndarray) -> np.ndarray:
    """``share`` of arrays; beyond 63 bits in whole numbers of any size."""
    if len(counts) and int(counts.max()) >= (1 << 63) // SCALE - 1:
        return (1 + SCALE * (counts.astype(object) + 1) // both.astype(object)).astype(np.int64)
    return 1 + SCALE * (counts + 1) // both


def _gains(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def pair_sums(group: np.ndarray, p: np.ndarray, none: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of stripes laid end to end (group, share and share without the term of each cell; the length of each stripe) the
    sums by ordered pair of different groups of what terms of both add beyond what their counts add alone."""
    ends = np.cumsum(sizes)
    starts = ends - sizes
    # Groups are numbered from 0 on here, so a pair is one number, and few pairs are the places of an array.
    names, own = np.unique(group, return_inverse=True)
    many = len(names)
    dense = many * many <= PAIRS
    total, met = np.zeros(many * many if dense else 0, np.int64), np.zeros(many * many if dense else 0, bool)
    found: dict[int, int] = {}
    first = 0
    while first < len(sizes):
        # A stretch of stripes of no more than PAIRS pairs, one stripe at least, which goes row by row if it is longer.
        upto = first + max(1, int(np.searchsorted(np.cumsum(sizes[first:] ** 2), PAIRS, "right")))
        size, start = sizes[first:upto], starts[first:upto]
        rows = np.arange(start[0], ends[upto - 1])
        width = np.repeat(size, size)
        step = max(1, PAIRS // int(size.max()))
        for low in range(0, len(rows), step):
            part, wide = rows[low : low + step], width[low : low + step]
            left = np.repeat(part, wide)
            begin = np.repeat(np.repeat(start, size)[low : low + step], wide)
            right = begin + np.arange(len(left)) - np.repeat(np.cumsum(wide) - wide, wide)
            other = left != right
            left, right = left[other], right[other]
            values = _gains(p[left], p[right]) - _gains(p[left], none[right]) - _gains(none[left], p[right]) + _gains(none[left], none[right])
            pair = own[left] * many + own[right]
            if dense:
                np.add.at(total, pair, values)
                met[pair] = True
                continue
            keys, place = np.unique(pair, return_inverse=True)
            sums = np.zeros(len(keys), np.int64)
            np.add.at(sums, place, values)
            for key, value in zip(keys.tolist(), sums.tolist(), strict=True):
                found[key] = found.get(key, 0) + value
        first = upto
    pairs = np.flatnonzero(met) if dense else np.array(list(found), np.int64)
    values = total[pairs] if dense else np.array(list(found.values()), np.int64)
    return names[pairs // max(many, 1)], names[pairs % max(many, 1)], values


def _by_number(rows: list[tuple]) -> tuple[dict, np.ndarray]:
    return {(lang, source): number for lang, source, number, _ in rows}, np.array([both for *_, both in sorted(rows, key=lambda r: r[2])], np.int64)


def _common(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(a, b, value): by numbers of groups what terms of both add; made of merged stripes, batch by batch."""
    rows = groups.select("number", "lang", "source", "n", "v").collect()
    told = shared_value(kept.sparkSession, [(r.lang, r.source, r.number, r.n + r.v) for r in rows])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_name, both = made_once(told, _by_number)
        for batch in batches:
            lengths = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64)
            langs = np.repeat(np.arange(batch.num_rows), lengths)
            names = batch.column(0).to_pylist()
            sources = batch.column(1).flatten().to_pylist()
            counts = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            group = np.fromiter((by_name[names[i], s] for i, s in zip(langs, sources, strict=True)), np.int64, len(sources))
            n = both[group]
            a, b, values = pair_sums(group, shares(counts, n), shares(np.zeros_like(counts), n), lengths)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(values)], names=["a", "b", "value"])

    several = kept.where(F.size("sources") > 1).select("lang", "sources", "counts")
    return several.mapInArrow(run, "a bigint, b bigint, value bigint").groupBy("a", "b").agg(F.sum("value").alias("value"))


def _alone(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(a, b, value): what the terms of either group add when the other one's count is taken for 0, and all others."""
    cells = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("c"))
    histogram = cells.groupBy("lang", F.col("c.sources").alias("source"), F.col("c.counts").alias("count")).agg(F.count("*").alias("terms"))
    none = share(F.lit(0), F.col("n"), F.col("v"))
    known = small_side(written(groups.withColumn("none", none), "groups"))
    sized = histogram.join(known, ["lang", "source"])
    sized = sized.select("lang", "number", "none", "terms", share(F.col("count"), F.col("n"), F.col("v")).alias("p"))
    other = known.select(F.col("lang"), F.col("number").alias("o_number"), F.col("none").alias("o_none"))
    met = sized.join(other, "lang").where("number != o_number")
    rest = added(F.col("none"), F.col("o_none"))
    back = added(F.col("o_none"), F.col("none"))
    as_group = F.struct(F.col("number").alias("a"), F.col("o_number").alias("b"), (F.col("terms") * (added(F.col("p"), F.col("o_none")) - rest)).alias("value"))
    as_item = F.struct(F.col("o_number").alias("a"), F.col("number").alias("b"), (F.col("terms") * (added(F.col("o_none"), F.col("p")) - back)).alias("value"))
    # Summed by histogram and group first: one pair of groups has as many rows as counts.
    sums = met.select(F.explode(F.array(as_group, as_item)).alias("x")).select("x.*").groupBy("a", "b").agg(F.sum("value").alias("value"))
    mine = known.select("lang", F.col("number").alias("a"), "none", "v")
    all_pairs = mine.join(known.select("lang", F.col("number").alias("b"), F.col("none").alias("o_none")), "lang").where("a != b")
    base = all_pairs.select("a", "b", (F.col("v") * added(F.col("none"), F.col("o_none"))).alias("value"))
    return base.unionByName(sums)


def audit(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    top_terms: int = TOP_TERMS,
) -> DataFrame:
    """(lang, source, part, item, value, rank): see the docstring of the module.

    Part ``pair`` holds every other source of the language, part ``term`` the terms that the source uses more than
    its language, the first ``top_terms`` of them.
    """
    kept = written(stripes(df, min_documents, text=text, lang=lang, source=source), "stripes")
    groups = totals(df, kept, lang, source)
    # Numbers are small, as positions of an array; those of the ids that are written stay what they are.
    order = Window.orderBy("lang", "source")
    groups = written(groups, "totals")
    if groups.count() > BROADCAST_ROWS:
        raise ValueError(f"more than {BROADCAST_ROWS} groups of language and source: their pairs are too many for a table")
    groups = written(groups.withColumn("number", F.row_number().over(order).cast("long") - 1), "groups")
    known = small_side(groups)

    pairs = _common(kept, groups).unionByName(_alone(kept, groups)).groupBy("a", "b").agg(F.sum("value").alias("value"))
    named = lambda n, c: known.select(F.col("number").alias(n), F.col("lang").alias(f"{n}_lang"), F.col("source").alias(c))
    pairs = pairs.join(named("a", "source"), "a").join(named("b", "item"), "b")
    pairs = pairs.select(F.col("a_lang").alias("lang"), "source", F.lit("pair").alias("part"), "item", "value")

    cells = kept.select("lang", "term", "total", F.explode(F.arrays_zip("sources", "counts")).alias("c"))
    cells = cells.select("lang", F.col("c.sources").alias("source"), "term", "total", F.col("c.counts").alias("count"))
    sized = cells.join(known, ["lang", "source"])
    p, q = share(F.col("count"), F.col("n"), F.col("v")), share(F.col("total"), F.col("n_lang"), F.col("v"))
    sized = sized.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    used = sized.select("lang", "source", "part", "item", added(F.col("p"), F.col("q")).alias("value"))

    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    rank = F.row_number().over(ranked)
    # A limit on the row number is applied in each task before the rows of a group meet.
    top = used.withColumn("rank", rank).where(F.col("rank") <= top_terms)
    return pairs.withColumn("rank", rank).unionByName(top)
