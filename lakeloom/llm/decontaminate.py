"""Benchmark decontamination by pigeonhole edit matching.

An item of n characters may differ from a passage by k = floor(rate * n) edits. Cut into k + 1 pieces, at
least one piece then stands unchanged in the passage. All pieces of all items are searched at once (one
automaton over each whole text); around each hit the passage is verified with Myers' bit-parallel edit
distance, so no passage within the budget is missed and none beyond it is reported. Before that, two
cheaper lower bounds on the distance drop hits: the counts of characters and of trigrams.

Texts and items are compared in lower case with runs of white space as one space. Items shorter than
``min_chars`` so written get no budget, as a few edits make them other words: they are searched by the same automaton
as they are, and count where no word goes on before or behind them. Only items without a character are left out.

The items are the stated query set. They are read in blocks of bounded size; each block is sent to the tasks
and all documents pass it, without a shuffle of texts. One task needs a batch of texts and one block.

Defined results: NULL and empty texts contain nothing; NULL items are ignored, repeated items reported each
with its id; repeated rows are searched each by itself. Without items nothing is found and all rows are kept.
Extra columns are kept by ``drop_contaminated``, whatever their names; ``matches`` gives an id column of the name of one of
its own an underscore. Of several passages with the same item the
nearest one, then the first one is reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lakeloom.llm.common import beside, made_once, shared_value

RATE = 0.1
MIN_CHARS = 40
GRAM = 4
# Characters of items in one block, and so in one pass over the documents.
BLOCK_CHARS = 4_000_000


def normalised(text: str) -> str:
    return " ".join(text.lower().split())


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """``edits`` + 1 parts of almost equal length, with their offsets."""
    cuts = [len(item) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def masks(pattern: str) -> dict[str, int]:
    """For each character the bits of the places where the pattern has it."""
    found: dict[str, int] = {}
    for i, c in enumerate(pattern):
        found[c] = found.get(c, 0) | 1 << i
    return found


def nearest_end(peq: dict[str, int], size: int, text: str, most: int, anchored: int = 0) -> tuple[int, int] | None:
    """(distance, end) of the part of the text nearest to the pattern, the first such; None if beyond ``most``.

    With ``anchored`` = 1 the part has to begin where the text begins.

    Myers' recurrence: vertical differences of a column of the distance matrix are held as bits of two
    integers, so a character of the text costs a few integer operations.
    """
    full, top = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score = full, 0, size
    best, at = most + 1, -1
    for j, c in enumerate(text):
        equal = peq.get(c, 0)
        diagonal = (((equal & plus) + plus) ^ plus) | equal | minus
        up = minus | (full & ~(diagonal | plus))
        down = plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = (up << 1 | anchored) & full
        plus = (down << 1 & full) | (full & ~(diagonal | up))
        minus = up & diagonal
        if score < best:
            best, at = score, j + 1
    return (best, at) if at >= 0 else None


def stands_alone(text: str, start: int, end: int) -> bool:
    """No word goes on over either end of a part of the text."""
    inside = lambda i: 0 < i < len(text) and text[i - 1].isalnum() and text[i].isalnum()
    return not inside(start) and not inside(end)


class Matcher:
    """A block of items, ready to search texts; made once in each worker."""

    def __init__(self, items: list[tuple[int, str]], rate: float, min_chars: int = MIN_CHARS):
        import ahocorasick

        self.items, self.budget, self.peq, self.back, self.grams = items, [], [], [], []
        self.short: list[bool] = []
        self.automaton = ahocorasick.Automaton()
        places: dict[str, list[tuple[int, int]]] = {}
        for n, (_, item) in enumerate(items):
            edits = int(rate * len(item)) if len(item) >= min_chars else 0
            self.budget.append(edits)
            self.short.append(len(item) < min_chars)
            self.peq.append(masks(item))
            self.back.append(masks(item[::-1]))
            self.grams.append([item[i : i + GRAM] for i in range(0, len(item) - GRAM + 1, GRAM)])
            for offset, piece in pieces(item, edits):
                places.setdefault(piece, []).append((n, offset))
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def find(self, text: str) -> dict[int, tuple[int, int, int]]:
        """By number of the item: (distance, start, end) of its nearest passage in a normalised text."""
        windows: dict[int, list[list[int]]] = {}
        found = {}
        for last, (size, where) in self.automaton.iter(text):
            for n, offset in where:
                k, length = self.budget[n], len(self.items[n][1])
                at = last + 1 - size - offset
                if self.short[n]:
                    if n not in found and stands_alone(text, at, last + 1):
                        found[n] = (0, at, last + 1)
                    continue
                low, high = max(0, at - k), min(len(text), at + length + k)
                held = windows.setdefault(n, [])
                # Hits come in order of their ends: one that begins in the window before widens it.
                if held and low <= held[-1][1]:
                    held[-1][0], held[-1][1] = min(held[-1][0], low), max(held[-1][1], high)
                else:
                    held.append([low, high])
        for n, held in windows.items():
            best = None
            for low, high in held:
                most = self.budget[n] if best is None else best[0] - 1
                if most < 0:
                    break
                best = self.passage(n, text, low, high, most) or best
            if best:
                found[n] = best
        return found

    def passage(self, n: int, text: str, low: int, high: int, most: int) -> tuple[int, int, int] | None:
        item, window = self.items[n][1], text[low:high]
        if (exact := window.find(item)) >= 0:
            return 0, low + exact, low + exact + len(item)
        # The grams do not overlap, so an edit spoils one of them at most.
        spoilt = 0
        for gram in self.grams[n]:
            if gram not in window:
                spoilt += 1
                if spoilt > most:
                    return None
        if not (end := nearest_end(self.peq[n], len(item), window, most)):
            return None
        distance, stop = end
        before = window[max(0, stop - len(item) - distance) : stop][::-1]
        # The same distance is reached from the end backwards, so the start is there.
        _, length = nearest_end(self.back[n], len(item), before, distance, anchored=1) or (distance, len(before))
        return distance, low + stop - length, low + stop


def _matcher(block: Broadcast) -> Matcher:
    return made_once(block, lambda made_of: Matcher(*made_of))


def item_blocks(
    spark: SparkSession, items: DataFrame, item_id: str, text: str, rate: float, min_chars: int, block_chars: int
) -> list[Broadcast]:
    """The normalised items, broadcast in blocks of at most ``block_chars`` characters (or one longer item)."""
    blocks: list[Broadcast] = []
    block: list[tuple[int, str]] = []
    size = 0
    rows = items.select(F.col(item_id), F.col(text)).where(F.col(text).isNotNull())
    for row in rows.toLocalIterator():
        item = normalised(row[1])
        if not item:
            continue
        if block and size + len(item) > block_chars:
            blocks.append(shared_value(spark, (block, rate, min_chars)))
            block, size = [], 0
        block.append((row[0], item))
        size += len(item)
    return blocks + ([shared_value(spark, (block, rate, min_chars))] if block else [])


def matches(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    rate: float = RATE,
    min_chars: int = MIN_CHARS,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(id, item_id, distance, start, end): the items in each row's text; places count in the normalised text."""
    rows = docs.select(F.col(id_column), F.col(text))
    schema = T.StructType(
        [
            T.StructField(beside([id_column], ["item_id", "distance", "start", "end"])[0], rows.schema[0].dataType),
            T.StructField("item_id", items.schema[item_id].dataType),
            *(T.StructField(name, T.LongType()) for name in ("distance", "start", "end")),
        ]
    )
    kinds = [to_arrow_type(field.dataType) for field in schema.fields[1:]]
    found = None
    for block in item_blocks(docs.sparkSession, items, item_id, item_text, rate, min_chars, block_chars):

        def search(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(block)
            for batch in batches:
                out: list[list] = [[], [], [], [], []]
                for i, body in enumerate(batch.column(1)):
                    for n, (distance, start, end) in matcher.find(normalised(body.as_py() or "")).items():
                        for column, value in zip(out, (i, matcher.items[n][0], distance, start, end), strict=True):
                            column.append(value)
                ids = batch.column(0).take(pa.array(out[0], pa.int64()))
                yield pa.record_batch([ids, *(pa.array(x, kind) for x, kind in zip(out[1:], kinds, strict=True))], names=schema.names)

        part = rows.mapInArrow(search, schema)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], schema)


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    rate: float = RATE,
    min_chars: int = MIN_CHARS,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows whose text contains no item, with their own columns only."""
    at = docs.columns.index(text)
    for block in item_blocks(docs.sparkSession, items, item_id, item_text, rate, min_chars, block_chars):

        def clean(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(block)
            for batch in batches:
                bodies = (body.as_py() or "" for body in batch.column(at))
                yield batch.filter(pa.array([not matcher.find(normalised(body)) for body in bodies], pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
