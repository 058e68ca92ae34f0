"""Token counts that follow edits.

Every document keeps a segment tree over its pre-tokens: a leaf is a run of ``LEAF`` pre-tokens with its
characters and its tokens, an inner node their sums. An edit replaces a span of the text. Only the leaves that it
touches are encoded again, with one leaf before them, as a pre-token can grow into what follows it, and as
many after them as it takes until a new pre-token ends where an old leaf ended: from there on nothing can have
changed. Sums are then renewed from those leaves to the root, so an edit costs its surroundings and the height
of the tree, not the text, and many edits close to each other are followed together.

A document is worked through by itself, in one pass over its whole text and without a shuffle.

Texts are split and merged as in the byte-level vocabulary given by its path; strings of special tokens
count as ordinary text. Edits are spans of the text before any of them, in order and without overlap; a span that
begins before the end of the one before it, or beyond the text, is an error.

Defined results: a NULL text is taken as an empty one, with a tree of one leaf without tokens; NULL or no edits
change nothing. Repeated rows are counted each by itself. Extra columns are kept; one of an
added name goes on with an underscore before it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lakeloom.llm.bpe import Codec, codec, vocabulary
from lakeloom.llm.common import beside

LEAF = 16
ROWS = 500
# Words whose tokens a worker remembers; no other operator is at work beside it.
KNOWN = 300_000

TREE = T.StructType([T.StructField("chars", T.ArrayType(T.IntegerType())), T.StructField("tokens", T.ArrayType(T.IntegerType()))])
EDITS = T.ArrayType(
    T.StructType(
        [T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("new", T.StringType())]
    )
)


class Tree:
    """Sums of characters and tokens; node 1 is the root, node i has the children 2 i and 2 i + 1."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.chars, self.tokens = chars, tokens
        self.leaves = len(chars) // 2
        self.encoded = 0  # characters that edits have had encoded again

    @classmethod
    def of(cls, own: Codec, text: str) -> Tree:
        pretokens = own.pattern.findall(text)
        chars = np.fromiter(map(len, pretokens), np.int32, len(pretokens))
        tokens = np.fromiter((len(own.pretokens[p]) // 4 for p in pretokens), np.int32, len(pretokens))
        wide = 1
        while wide * LEAF < len(pretokens):
            wide *= 2
        return cls(cls._summed(chars, wide), cls._summed(tokens, wide))

    @staticmethod
    def _summed(each: np.ndarray, wide: int) -> np.ndarray:
        nodes = np.zeros(2 * wide, np.int32)
        if len(each):
            sums = np.add.reduceat(each, np.arange(0, len(each), LEAF))
            nodes[wide : wide + len(sums)] = sums
        while wide > 1:
            nodes[wide // 2 : wide] = nodes[wide : 2 * wide : 2] + nodes[wide + 1 : 2 * wide : 2]
            wide //= 2
        return nodes

    @property
    def count(self) -> int:
        return int(self.tokens[1])

    def find(self, place: int) -> tuple[int, int]:
        """(leaf, first character) of the leaf with a character; the last one with any for the end of the text."""
        node, first = 1, 0
        place = min(place, int(self.chars[1]) - 1)
        while node < self.leaves:
            node *= 2
            if place >= first + self.chars[node]:
                first += int(self.chars[node])
                node += 1
        return node - self.leaves, first

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        """Set a leaf and renew the sums up to the root."""
        node = leaf + self.leaves
        more_chars, more_tokens = chars - int(self.chars[node]), tokens - int(self.tokens[node])
        while node:
            self.chars[node] += more_chars
            self.tokens[node] += more_tokens
            node //= 2

    def before(self, leaf: int) -> int | None:
        """The nearest leaf to the left that has characters."""
        node = leaf + self.leaves
        while node > 1:
            if node % 2 and self.chars[node - 1]:
                node -= 1
                while node < self.leaves:
                    node = 2 * node + 1 if self.chars[2 * node + 1] else 2 * node
                return node - self.leaves
            node //= 2
        return None

    def edit(self, own: Codec, before: list[dict], after: str) -> None:
        """Follow edits of the text that the tree stands for; ``after`` is the text that they make of it.

        Edits whose surroundings touch are followed in one go, so many edits cost no more than the text.
        """
        self.chars, self.tokens = self.chars.tolist(), self.tokens.tolist()
        shifts = [0, *accumulate(len(e["new"]) - (e["end"] - e["start"]) for e in before)]
        done = 0
        while done < len(before):
            done = self._follow(own, before, after, shifts, done)
        self.chars, self.tokens = np.array(self.chars, np.int32), np.array(self.tokens, np.int32)

    def _follow(self, own: Codec, edits: list[dict], after: str, shifts: list[int], at_edit: int) -> int:
        """Encode from the leaf before an edit until leaves fit again; returns the number of edits followed.

        The tree holds edits up to here, so its places are those of the new text up to here.
        """
        held = at_edit
        leaf, first = self.find(edits[held]["start"] + shifts[held])
        if (earlier := self.before(leaf)) is not None:
            leaf, first = earlier, first - self.chars[earlier + self.leaves]
        # The end of the last leaf taken, as a place before the edits that are followed here.
        last, stop, base = leaf, first + self.chars[leaf + self.leaves], shifts[held]
        end, tokens = first, 0
        for match in own.pattern.finditer(after, first):
            end = match.end()
            tokens += len(own.pretokens[match[0]]) // 4
            while held + 1 < len(edits) and end > edits[held + 1]["start"] + shifts[held + 1]:
                held += 1
            # The place in the old text at which this pre-token ends, if it is not inside an edit.
            if end < edits[held]["start"] + shifts[held] + len(edits[held]["new"]):
                continue
            place = end - shifts[held + 1] + base
            while stop < place and last + 1 < self.leaves:
                last += 1
                stop += self.chars[last + self.leaves]
            if place == stop and (held + 1 == len(edits) or self._is_far(last, edits[held + 1]["start"] + base, stop)):
                break
        else:
            held = len(edits) - 1
            last = self.leaves - 1
        self.encoded += end - first
        for touched in range(leaf + 1, last + 1):
            if self.chars[touched + self.leaves]:
                self.put(touched, 0, 0)
        self.put(leaf, end - first, tokens)
        return held + 1

    def _is_far(self, last: int, place: int, stop: int) -> bool:
        """Whether a whole leaf lies between the end of a leaf and a place."""
        for leaf in range(last + 1, self.leaves):
            if width := self.chars[leaf + self.leaves]:
                return place >= stop + width
        return False


def count(df: DataFrame, path: str, text: str = "text", into: str = "tree") -> DataFrame:
    """Add the tree of each text; its count is ``tree.tokens[1]``."""
    content, at = vocabulary(df, path), df.columns.index(text)
    schema = T.StructType([*df.schema, T.StructField(into, TREE)])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                trees = [Tree.of(codec(content, KNOWN), body.as_py() or "") for body in part.column(at)]
                yield pa.RecordBatch.from_arrays([*part.columns, _packed(trees)], names=names)

    return df.mapInArrow(run, schema)


def apply_edits(
    df: DataFrame, path: str, edits: str = "edits", text: str = "text", tree: str = "tree", encoded: str = "chars_encoded"
) -> DataFrame:
    """Replace text and tree by those after the edits, and add how many characters were encoded again."""
    content = vocabulary(df, path)
    at, trees_at, edits_at = (df.columns.index(c) for c in (text, tree, edits))
    schema = T.StructType([*df.schema, T.StructField(encoded, T.LongType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                texts, trees = [], []
                for body, held, wanted in zip(part.column(at), part.column(trees_at), part.column(edits_at), strict=True):
                    own = Tree(*(held[k].values.to_numpy(zero_copy_only=False).copy() for k in ("chars", "tokens")))
                    texts.append(edited(codec(content, KNOWN), own, body.as_py(), wanted.as_py() or []))
                    trees.append(own)
                columns = list(part.columns)
                columns[at] = pa.array(texts, pa.string())
                columns[trees_at] = _packed(trees)
                yield pa.RecordBatch.from_arrays([*columns, pa.array([t.encoded for t in trees], pa.int64())], names=names)

    return df.mapInArrow(run, schema)


def count_through_edits(
    df: DataFrame, path: str, find: Callable[[str], list[dict]], text: str = "text", keep: Sequence[str] | None = None
) -> DataFrame:
    """Build each tree and follow the edits that ``find`` makes of its text, all in one pass.

    Adds tokens_before, edits (how many), tokens and chars_encoded; ``keep`` limits the other columns. One worker
    does the work of ``count`` and ``apply_edits``, and neither trees nor texts leave it.
    """
    content, at = vocabulary(df, path), df.columns.index(text)
    kept = [df.columns.index(c) for c in (df.columns if keep is None else keep)]
    added = [T.StructField(c, T.LongType()) for c in ("tokens_before", "edits", "tokens", "chars_encoded")]
    held = zip(beside([df.columns[i] for i in kept], [field.name for field in added]), kept, strict=True)
    schema = T.StructType([*(T.StructField(name, df.schema[i].dataType) for name, i in held), *added])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, rows = codec(content, KNOWN), []
            for body in batch.column(at):
                old = body.as_py() or ""
                tree, edits = Tree.of(own, old), find(old)
                before = tree.count
                edited(own, tree, old, edits)
                rows.append((before, len(edits), tree.count, tree.encoded))
            numbers = [pa.array([r[i] for r in rows], pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), *numbers], names=names)

    return df.mapInArrow(run, schema)


def edited(own: Codec, tree: Tree, text: str | None, edits: list[dict]) -> str | None:
    """The text after the edits, whose tree is brought up to date."""
    if not edits:
        return text
    parts, done, old = [], 0, text or ""
    known = [{"start": e["start"], "end": e["end"], "new": e["new"] or ""} for e in edits]
    for edit in known:
        if not done <= edit["start"] <= edit["end"] <= len(old):
            raise ValueError(f"no span of the text that comes after the one before: {edit}")
        parts += [old[done : edit["start"]], edit["new"]]
        done = edit["end"]
    after = "".join([*parts, old[done:]])
    tree.edit(own, known, after)
    return after


def _packed(trees: list[Tree]) -> pa.Array:
    ends = pa.array(np.cumsum([0, *(len(t.chars) for t in trees)], dtype=np.int32))
    lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([getattr(t, k) for t in trees]))) for k in ("chars", "tokens")]
    return pa.StructArray.from_arrays(lists, names=["chars", "tokens"])
