"""Byte-level BPE encoding and decoding with a contiguous rank array.

A pre-token is held as the array of its parts (the token of each part; a part begins where the one before
ends) and the array of the ranks of neighbouring parts. The least rank is searched for, the boundary inside
that pair deleted, and the ranks of the two neighbours looked up again, until no pair has a rank. This is
quick because pre-tokens are short; those of more than ``LONG`` bytes take the same merges in the same
order from a heap, so a text without a space costs n log n. What a batch of texts holds for the first time is
merged together: one row of parts and one of ranks for each pre-token, those of about one length at a time.

Pre-tokens repeat, so each worker keeps a bounded number of results; what is kept never changes a result.
Texts are not shuffled: encoding is one pass, whole texts, a batch at a time.

The vocabulary is a file of the tokenizers library (byte-level BPE without normaliser); its path is a
parameter and its content is sent to the tasks. A special token's string in a text becomes that token, as
the library does by default.

Defined results: NULL is taken as an empty text; an empty text has no tokens and decodes to an empty text.
Repeated rows are encoded each by itself. Extra columns are kept; one of an
added name goes on with an underscore before it.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lakeloom.llm.common import beside, made_once, shared_value

# The pattern of byte-level pre-tokens, with white space as Unicode defines it.
PRETOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
LONG = 64
# Results kept in each of two generations, and the longest piece of text that is kept.
KEPT, KEPT_CHARS = 60_000, 40
ROWS = 1_000
# Characters of texts whose new words are merged together, and how many of them share an array.
CHARS, WORDS = 4_000_000, 4_096
_NONE = 1 << 60
_NO_RANK = np.iinfo(np.int32).max


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte: itself where printable, else one from 256 on."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class _Irregular(Exception):
    """A piece between spaces that begins or ends with white space."""


class _Kept(dict):
    """Encoded pieces; the older half goes when there are too many."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.older, self.most = make, {}, most

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(key) <= KEPT_CHARS:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[key] = value

    def keep_all(self, made: dict) -> None:
        """Keep many at once, no more than fit."""
        if len(self) + len(made) > self.most:
            self.older = dict(self)
            self.clear()
        self.update(islice(((key, value) for key, value in made.items() if len(key) <= KEPT_CHARS), self.most))


class Codec:
    """Encodes texts to arrays of token ids and back."""

    def __init__(self, content: str, kept: int | None = None):
        kept = kept or KEPT
        model = json.loads(content)
        vocabulary = model["model"]["vocab"]
        characters = byte_characters()
        raw = lambda token: bytes(characters[c] for c in token)
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.bytes_of = [b""] * (max([*vocabulary.values(), *self.special.values()]) + 1)
        for token, number in vocabulary.items():
            self.bytes_of[number] = raw(token)
        for token, number in self.special.items():
            self.bytes_of[number] = token.encode()
        self.single = [vocabulary[c] for c, _ in sorted(characters.items(), key=lambda x: x[1])]
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for pair in model["model"]["merges"]:
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks.setdefault(vocabulary[left] << 32 | vocabulary[right], len(self.merged))
            self.merged.append(vocabulary[left + right])
        # The same as arrays: pairs in order with their ranks, and the ranks of pairs of single bytes.
        self.pairs = np.array(sorted(self.ranks), np.int64)
        self.pair_ranks = np.array([self.ranks[pair] for pair in self.pairs.tolist()], np.int32)
        self.singles, self.merges = np.array(self.single, np.int32), np.array(self.merged, np.int32)
        self.byte_ranks = self._ranks_of(np.repeat(self.singles, 256), np.tile(self.singles, 256)).reshape(256, 256)
        self.pattern = regex.compile(PRETOKEN)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.pretokens = _Kept(lambda token: self._packed(self.merge(token.encode())), kept)
        self.first = _Kept(self._piece, kept)
        self.spaced = _Kept(lambda piece: self._piece(piece, " "), kept)

    @staticmethod
    def _packed(tokens: list[int]) -> bytes:
        return np.array(tokens, "<i4").tobytes()

    def merge(self, word: bytes) -> list[int]:
        """The tokens of one pre-token."""
        parts = [self.single[b] for b in word]
        if len(parts) > LONG:
            return self._merge_long(parts)
        get, merged = self.ranks.get, self.merged
        ranks = [get(a << 32 | b, _NONE) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            least = min(ranks)
            if least == _NONE:
                break
            i = ranks.index(least)
            parts[i] = merged[least]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(parts[i - 1] << 32 | parts[i], _NONE)
            if i < len(ranks):
                ranks[i] = get(parts[i] << 32 | parts[i + 1], _NONE)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same merges in the same order: by rank, then from the left."""
        get, n = self.ranks.get, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := get(parts[i] << 32 | parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            # A part that was merged away is -1, so entries that no longer hold have another rank.
            if j >= n or parts[i] < 0 or get(parts[i] << 32 | parts[j]) != rank:
                continue
            parts[i], parts[j] = self.merged[rank], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (r := get(parts[k] << 32 | parts[after[k]])) is not None:
                    heapq.heappush(heap, (r, k))
        return [p for p in parts if p >= 0]

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of pairs, ``_NO_RANK`` where there is none."""
        if not len(self.pairs):
            return np.full(len(left), _NO_RANK, np.int32)
        wanted = left.astype(np.int64) << 32 | right
        place = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where(self.pairs[place] == wanted, self.pair_ranks[place], _NO_RANK)

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """What ``merge`` gives for each of many pre-tokens, packed."""
        made = [b""] * len(words)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        for start in range(0, len(order), WORDS):
            some = order[start : start + WORDS]
            short = [i for i in some if len(words[i]) <= LONG]
            for i in some[len(short) :]:
                made[i] = self._packed(self.merge(words[i]))
            if short:
                for i, tokens in zip(short, self._merged_rows([words[i] for i in short]), strict=True):
                    made[i] = tokens
        return made

    def _merged_rows(self, words: list[bytes]) -> list[bytes]:
        """Pre-tokens of at most ``LONG`` bytes, a row each; every step makes the next merge of each row that has one."""
        sizes = np.array([len(word) for word in words])
        width = max(int(sizes.max()), 1)
        raw = np.frombuffer(b"".join([word.ljust(width, b"\0") for word in words]), np.uint8).reshape(-1, width)
        parts, ranks = self.singles[raw], np.full(raw.shape, _NO_RANK, np.int32)
        ranks[:, :-1] = self.byte_ranks[raw[:, :-1], raw[:, 1:]]
        # Rank i is that of parts i and i + 1; a row has none at its last part and behind it.
        ranks[np.arange(width) >= sizes[:, None] - 1] = _NO_RANK
        made, number = [b""] * len(words), np.arange(len(words))
        while True:
            at = ranks.argmin(1)
            least = ranks[np.arange(len(at)), at]
            ready = least == _NO_RANK
            if ready.any():
                packed, row = parts[ready].astype("<i4").tobytes(), 4 * parts.shape[1]
                for k, (i, size) in enumerate(zip(number[ready].tolist(), sizes[ready].tolist(), strict=True)):
                    made[i] = packed[k * row : k * row + 4 * size]
                going = ~ready
                parts, ranks, sizes, number, at, least = parts[going], ranks[going], sizes[going], number[going], at[going], least[going]
                if not len(number):
                    return made
            rows, columns = np.arange(len(at)), np.arange(parts.shape[1] - 1)
            parts[rows, at] = self.merges[least]
            behind = columns >= at[:, None]
            ranks = np.where(behind, ranks[:, 1:], ranks[:, :-1])
            behind[rows, at] = False
            parts = np.where(behind, parts[:, 1:], parts[:, :-1])
            sizes = sizes - 1
            for left in (at - 1, at):
                there = np.flatnonzero((left >= 0) & (left < sizes - 1))
                i = left[there]
                ranks[there, i] = self._ranks_of(parts[there, i], parts[there, i + 1])

    def _piece(self, piece: str, lead: str = "") -> bytes:
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise _Irregular
        return b"".join(map(self.pretokens.__getitem__, self.pattern.findall(lead + piece)))

    def _ordinary(self, text: str) -> bytes:
        if not text:
            return b""
        # A space between two characters that are none always begins a pre-token, so the pieces stand alone.
        head, *rest = text.split(" ")
        try:
            return self.first[head] + b"".join(map(self.spaced.__getitem__, rest))
        except _Irregular:
            return b"".join(map(self.pretokens.__getitem__, self.pattern.findall(text)))

    def _learned(self, texts: list[str]) -> dict[str, bytes]:
        """The tokens of all pieces that stand behind a space in the texts, but of the irregular ones; new ones are kept."""
        wanted: set[str] = set()
        for text in texts:
            wanted.update(text.split(" ")[1:])
        held, older = self.spaced, self.spaced.older
        unseen = wanted.difference(held, older)
        known = {piece: held[piece] if piece in held else older[piece] for piece in wanted.difference(unseen)}
        new = [piece for piece in unseen if piece and piece.strip() == piece]
        if not new:
            return known
        # Only the first pre-token of a piece begins with a space.
        found = self.pattern.findall(" " + " ".join(new))
        starts = [i for i, token in enumerate(found) if token[0] == " "]
        tokens = self._merged(found)
        joined = [
            tokens[start] if end == start + 1 else b"".join(tokens[start:end])
            for start, end in zip(starts, [*starts[1:], len(found)], strict=True)
        ]
        made = dict(zip(new, joined, strict=True))
        held.keep_all(made)
        known.update(made)
        return known

    def _merged(self, found: list[str]) -> list[bytes]:
        """The tokens of each pre-token; new ones are merged together and kept."""
        held, older, wanted = self.pretokens, self.pretokens.older, set(found)
        unseen = wanted.difference(held, older)
        of = {token: held[token] if token in held else older[token] for token in wanted.difference(unseen)}
        new = list(unseen)
        made = dict(zip(new, self.merge_all([token.encode() for token in new]), strict=True))
        held.keep_all(made)
        of.update(made)
        return list(map(of.__getitem__, found))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """``encode`` of each text; the new words of some of them are merged together."""
        encoded: list[bytes] = []
        some: list[str] = []
        chars = 0
        for text in texts:
            some.append(text)
            chars += len(text)
            if chars >= CHARS:
                encoded += self._encode_some(some)
                some, chars = [], 0
        return encoded + self._encode_some(some)

    def _encode_some(self, texts: list[str]) -> list[bytes]:
        plain = [not any(token in text for token in self.special) for text in texts]
        known = self._learned([text for text, is_plain in zip(texts, plain, strict=True) if is_plain])
        encoded = []
        for text, is_plain in zip(texts, plain, strict=True):
            head, *rest = text.split(" ")
            try:
                encoded.append(self.first[head] + b"".join(map(known.__getitem__, rest)) if is_plain and text else self.encode(text))
            except (_Irregular, KeyError):
                encoded.append(b"".join(self._merged(self.pattern.findall(text))))
        return encoded

    def encode(self, text: str) -> bytes:
        """The ids of the tokens, four bytes each, least byte first."""
        if not any(token in text for token in self.special):
            return self._ordinary(text)
        known = self.special
        return b"".join(
            self._packed([known[part]]) if part in known else self._ordinary(part) for part in self.specials.split(text)
        )

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def codec(shared: Broadcast, kept: int | None = None) -> Codec:
    """The codec of a shared vocabulary, with tables of ``kept`` known words (``KEPT`` if not told)."""
    return made_once(shared, lambda content: Codec(content, kept))


def vocabulary(df: DataFrame, path: str) -> Broadcast:
    """The content of a vocabulary file, sent to the tasks; some megabytes whatever the input."""
    with open(path, encoding="utf-8") as file:
        return shared_value(df.sparkSession, file.read())


def _mapped(df: DataFrame, make, fields: list[T.StructField], keep: list[str]) -> DataFrame:
    """Add columns made of batches of at most ``ROWS`` rows, which bounds the memory of a worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                held = [part.column(at[c]) for c in keep]
                yield pa.RecordBatch.from_arrays([*held, *make(part)], names=names)

    at = {c: i for i, c in enumerate(df.columns)}
    names = beside(keep, [field.name for field in fields])
    held = [T.StructField(name, df.schema[at[c]].dataType) for name, c in zip(names, keep, strict=True)]
    schema = T.StructType([*held, *fields])
    names = schema.names
    return df.mapInArrow(run, schema)


def encode(
    df: DataFrame, path: str, text: str = "text", into: str = "ids", decoded: str | None = None, keep: list[str] | None = None
) -> DataFrame:
    """Add the token ids ``into`` and, if named, the text ``decoded`` from those ids; ``keep`` limits the other columns."""
    content, at = vocabulary(df, path), df.columns.index(text)

    def make(part: pa.RecordBatch) -> list[pa.Array]:
        own = codec(content)
        encoded = own.encode_all([body or "" for body in part.column(at).to_pylist()])
        ends = np.cumsum([0, *(len(e) // 4 for e in encoded)], dtype=np.int32)
        ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(encoded), "<i4")))
        if not decoded:
            return [ids]
        return [ids, pa.array([own.decode(np.frombuffer(e, "<i4").tolist()) for e in encoded], pa.string())]

    fields = [T.StructField(into, T.ArrayType(T.IntegerType()))]
    fields += [T.StructField(decoded, T.StringType())] if decoded else []
    return _mapped(df, make, fields, df.columns if keep is None else keep)


def decode(df: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Add the text of the token ids; NULL for NULL."""
    content, at = vocabulary(df, path), df.columns.index(ids)

    def make(part: pa.RecordBatch) -> list[pa.Array]:
        own = codec(content)
        rows = (row.as_py() for row in part.column(at))
        return [pa.array([None if row is None else own.decode(row) for row in rows], pa.string())]

    return _mapped(df, make, [T.StructField(into, T.StringType())], df.columns)
