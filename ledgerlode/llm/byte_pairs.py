"""Byte-level BPE by dynamic programming over prefixes: each byte prefix of a piece has one valid last token.

Merging by rank never joins across a border of its result, so any run of tokens of an encoding is the encoding of
its own bytes. Hence the encoding of a prefix ends in the one token that is a suffix of it, encodes to itself, and
agrees with the last token of the prefix before it: two tokens agree when their joined bytes encode to just the
two. The table of last tokens costs one step per byte and token ending there, is extended by appended bytes, and is
kept up to an edit.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerlode.llm.spaced import Memo, Vocabulary, chunks

_ROWS, _CHARS = 512, 1 << 22
_SHORT, _PIECES = 64, 100_000      # pieces up to so many characters are remembered, so many at a time
_NEVER = 1 << 62                   # the rank of what no token is
_NEIGHBOURS = 20_000               # left neighbours remembered for a token


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """From the lines of a ranks file: token in base 64, rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines())}


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class Coder:
    """Encoder for ranks of byte strings; every single byte must have a rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.pattern = regex.compile(pattern)
        # Of each token that encodes to itself: size, rank, and the left neighbours it is known to agree with or not.
        self.suffixes = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if self.merged(token) == [rank]:
                self.suffixes.add_word(token.decode("latin-1"), (len(token), rank, {}))
        self.suffixes.make_automaton()
        self._histories: dict[int, tuple] = {}
        self._pieces: dict[str, bytes] = {}
        self._memo = Memo(lambda found: [self.ids_of(c) for c in found])

    @classmethod
    def read(cls, raw: bytes) -> Coder:
        return cls(read_ranks(raw))

    def history(self, data: bytes) -> tuple[list[bytes], list[int], list[bytes], list[bytes]]:
        """What merging neighbours, lowest rank first, then leftmost, leaves of some bytes; and the rank of each merge
        with the first and the last part before it. Used on single tokens only."""
        parts = [data[i:i + 1] for i in range(len(data))]
        merges, firsts, lasts = [], [parts[0]], [parts[-1]]
        joined = [self.ranks.get(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
        while joined and (best := min(joined)) < _NEVER:
            i = joined.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            joined[max(0, i - 1):i + 2] = [self.ranks.get(a + b, _NEVER)
                                           for a, b in zip(parts[max(0, i - 1):i + 1], parts[max(1, i):i + 2])]
            merges.append(best)
            firsts.append(parts[0])
            lasts.append(parts[-1])
        return parts, [*merges, _NEVER], firsts, lasts

    def merged(self, data: bytes) -> list[int]:
        return [self.ranks[p] for p in self.history(data)[0]]

    def agree(self, left: int, right: int) -> bool:
        """Whether the bytes of two tokens, each of which encodes to itself, encode to just the two. Up to the first
        merge across their border both merge as each alone does, so their histories are stepped through by rank."""
        _, left_ranks, _, lasts = self._history(left)
        _, right_ranks, firsts, _ = self._history(right)
        i = j = 0
        while True:
            a, b = left_ranks[i], right_ranks[j]
            across = self.ranks.get(lasts[i] + firsts[j], _NEVER)
            if across < a and across <= b and across < _NEVER:
                return False
            if a == b == _NEVER:
                return True
            if a <= b:
                i += 1
            else:
                j += 1

    def _history(self, token: int):
        known = self._histories.get(token)
        if known is None:
            known = self._histories[token] = self.history(self.bytes_of[token])
        return known

    def last_tokens(self, data: str, known: Sequence[int] = ()) -> list[int]:
        """The last token of each prefix of ``data``, bytes written as Latin-1. ``known`` has those of the first
        prefixes already. There are as many remembered neighbours as pairs of tokens that texts bring together."""
        table = list(known[:len(data)])
        done = len(table)
        table += [-1] * (len(data) - done)
        # All tokens that end at a byte, the longest first.
        for end, (size, token, seen) in self.suffixes.iter(data, max(0, done - self.longest + 1)):
            if table[end] >= 0:
                continue
            if size > end:
                table[end] = token
                continue
            left = table[end - size]
            fits = seen.get(left)
            if fits is None:
                if len(seen) >= _NEIGHBOURS:
                    seen.clear()
                fits = seen[left] = self.agree(left, token)
            if fits:
                table[end] = token
        return table

    def path(self, data: bytes, table: Sequence[int]) -> list[int]:
        """The tokens of a piece: a piece that is a token is that token, else the table is read from its end."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        out, end, bytes_of = [], len(data), self.bytes_of
        while end > 0:
            token = table[end - 1]
            out.append(token)
            end -= len(bytes_of[token])
        out.reverse()
        return out

    def piece(self, text: str) -> bytes:
        """The ids of one match of the pattern."""
        known = self._pieces.get(text)
        if known is None:
            data = text.encode()
            whole = self.ranks.get(data)
            if whole is not None:
                known = packed([whole])
            else:
                known = packed(self.path(data, self.last_tokens(text if text.isascii() else data.decode("latin-1"))))
            if len(text) <= _SHORT:
                if len(self._pieces) >= _PIECES:
                    self._pieces.clear()
                self._pieces[text] = known
        return known

    def ids_of(self, text: str) -> bytes:
        if text.isascii() and text[1:].isalpha() and (text[0] == " " or text[0].isalpha()):
            return self.piece(text)
        return b"".join([self.piece(p) for p in self.pattern.findall(text)])

    def encode(self, text: str) -> bytes:
        """The packed ids of a text."""
        return b"".join(self._memo.of(chunks(text))) if text else b""


class Decoder:
    """The bytes of each id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.bytes_of = {rank: token for token, rank in ranks.items()}

    @classmethod
    def read(cls, raw: bytes) -> Decoder:
        return cls(read_ranks(raw))

    def decode(self, ids: bytes) -> bytes:
        bytes_of = self.bytes_of
        return b"".join([bytes_of[i] for i in np.frombuffer(ids, "<u4").tolist()])


class EditedText:
    """A text with the prefix tables of its pieces, for appends and edits.

    A match of the pattern depends on the text from its start on and looks at most two characters past its end.
    An edit therefore keeps all pieces that end three characters before it, matches anew from there until a piece
    starts where, behind the edit, one started before, and takes over the rest. Of a piece that starts as
    before, the table is kept up to its first changed byte.
    """

    def __init__(self, coder: Coder, text: str = ""):
        self.coder, self.text = coder, ""
        self.starts: list[int] = []
        self.pieces: list[tuple[bytes, list[int]]] = []
        self.steps = 0
        self.replace(0, 0, text)

    def append(self, text: str) -> None:
        self.replace(len(self.text), len(self.text), text)

    def replace(self, start: int, end: int, new: str) -> None:
        """Put ``new`` in place of the characters from ``start`` to ``end``. ``steps`` counts the bytes whose table
        entry was worked out."""
        shift = len(new) - (end - start)
        text = self.text[:start] + new + self.text[end:]
        ends = [*self.starts[1:], len(self.text)] if self.starts else []
        keep = 0
        while keep < len(ends) and ends[keep] + 3 <= start:
            keep += 1
        old = {s: k for k, s in enumerate(self.starts)}
        starts, pieces = self.starts[:keep], self.pieces[:keep]
        at = ends[keep - 1] if keep else 0
        while at < len(text):
            if at >= start + len(new) and at - shift in old:
                rest = old[at - shift]
                starts += [s + shift for s in self.starts[rest:]]
                pieces += self.pieces[rest:]
                break
            match = self.coder.pattern.match(text, at)
            data = match.group().encode()
            known: list[int] = []
            if at <= start and at in old:
                before, table = self.pieces[old[at]]
                known = table[:_common(before, data)]
            self.steps += len(data) - len(known)
            starts.append(at)
            pieces.append((data, self.coder.last_tokens(data.decode("latin-1"), known)))
            at = match.end()
        self.text, self.starts, self.pieces = text, starts, pieces

    def ids(self) -> list[int]:
        return [t for data, table in self.pieces for t in self.coder.path(data, table)]


def _common(a: bytes, b: bytes) -> int:
    """Length of the common start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    return int(np.argmax(x != y))


def _runs(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows with a bounded sum of sizes, at least one row each."""
    lo, total = 0, 0
    for i, size in enumerate(sizes):
        if i > lo and (total + size > _CHARS or i - lo >= _ROWS):
            yield lo, i
            lo, total = i, 0
        total += size
    if lo < len(sizes):
        yield lo, len(sizes)


def encode_documents(documents: DataFrame, ranks: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids`` for each document: its whole text by the ranks in the file ``ranks``, each match of
    the pattern by itself, without special tokens; ``ids`` holds little-endian unsigned 32-bit integers.

    A null text is empty and has no tokens. Repeated rows and null ids are rows of their own; other columns are
    ignored; an empty table gives no rows. A row is one unit of work, whatever its length: time grows with its
    bytes, also in one match of millions of bytes. Nothing is shuffled.
    """
    spark = documents.sparkSession
    words = Vocabulary(spark, ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def work(batches):
        coder = words.load(Coder.read)
        for batch in batches:
            texts = batch.column("text")
            sizes = [len(v) for v in texts.to_pylist()]
            for lo, hi in _runs(sizes):
                ids = [coder.encode(t) for t in texts.slice(lo, hi - lo).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array([len(i) // 4 for i in ids], pa.int64()),
                     pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])

    schema = T.StructType([T.StructField("doc_id", documents.schema["doc_id"].dataType),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])
    return rows.mapInArrow(work, schema)


def decode_documents(encoded: DataFrame, ranks: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids`` and the bytes ``decoded`` that the ids stand for. A null in ``ids`` decodes to no
    bytes; an id without a token is an error."""
    spark = encoded.sparkSession
    words = Vocabulary(spark, ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"))

    def work(batches):
        coder = words.load(Decoder.read)
        for batch in batches:
            sizes = [len(v or b"") for v in batch.column("ids").to_pylist()]
            for lo, hi in _runs(sizes):
                part = batch.slice(lo, hi - lo)
                decoded = [coder.decode(v or b"") for v in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(decoded, pa.binary())],
                                                 [*part.schema.names, "decoded"])

    own = encoded.select("doc_id", "n_tokens", "ids")
    return own.mapInArrow(work, T.StructType([*own.schema.fields, T.StructField("decoded", T.BinaryType())]))
