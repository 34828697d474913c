"""Cutting texts at spaces where no tokenizer joins across, and remembering what each cut-out chunk gave."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Hashable

from pyspark import Broadcast
from pyspark.sql import SparkSession

_PRINTED = frozenset(map(chr, range(0x21, 0x7F)))
_FAR = re.compile("[ \n]([^\x00-\x7f])")


def chunks(text: str) -> list[str]:
    """The text in chunks that join to it again. A cut lies before a space or line feed that stands between a character
    that is no white space (for a space: no space) and a letter or printed ASCII character.

    The public pattern starts a match at such a place whatever stands before it (a run of white space gives its last
    space away), and no sentencepiece of a model that splits at white space crosses it. So each chunk is tokenized
    as in the whole text.
    """
    if _evenly_spaced(text):
        cut = text.replace(" ", "\0 ")
        out = (cut.replace("\n", "\0\n") if "\n" in text else cut).split("\0")
        return out if out[0] else out[1:]
    parts = text.split(" ")
    cuts = [i for i in range(1, len(parts))
            if parts[i] and parts[i - 1] and (parts[i][0] in _PRINTED or parts[i][0].isalpha())]
    if len(cuts) == len(parts) - 1:
        out = [parts[0], *[" " + p for p in parts[1:]]]
    else:
        edges = [0, *cuts, len(parts)]
        out = [(" " if lo else "") + " ".join(parts[lo:hi]) for lo, hi in zip(edges, edges[1:])]
    if "\n" in text:
        return [line for c in out for line in (_lines(c) if "\n" in c else (c,))]
    return out


def joins(chunk: str) -> bool:
    """Whether ``chunks`` cuts before and after the chunk where it stands among others of which that is true."""
    return (len(chunk) > 1 and chunk[0] in " \n" and (chunk[1] in _PRINTED or chunk[1].isalpha())
            and not chunk[-1].isspace())


def _evenly_spaced(text: str) -> bool:
    """Whether every space and line feed is a cut: each stands alone, before a letter or printed ASCII character, and
    there is no other white space or control character."""
    if not text or text[0] == "\n" or text[-1] in " \n" or "  " in text or " \n" in text:
        return False
    if "\n" in text:
        if "\n\n" in text or "\n " in text or not text.replace("\n", "").isprintable():
            return False
    elif not text.isprintable():
        return False
    return text.isascii() or not (far := "".join(_FAR.findall(text))) or far.isalpha()


def _lines(chunk: str) -> list[str]:
    parts = chunk.split("\n")
    out = [parts[0]]
    for before, part in zip(parts, parts[1:]):
        if part and before and not before[-1].isspace() and (part[0] in _PRINTED or part[0].isalpha()):
            out.append("\n" + part)
        else:
            out[-1] += "\n" + part
    return out


class Memo:
    """Results by chunk in two generations: when the young one is full it becomes the old one, so what is in
    use stays and memory is bounded. Chunks over ``longest`` characters are worked out each time."""

    def __init__(self, work: Callable[[list[str]], list], entries: int = 300_000, longest: int = 64):
        self.work, self.entries, self.longest = work, entries, longest
        self.young: dict[str, Hashable] = {}
        self.old: dict[str, Hashable] = {}

    def of(self, wanted: list[str]) -> list:
        """One result per chunk."""
        young, old = self.young, self.old
        out = list(map(young.get, wanted))
        if None not in out:
            return out
        places = [i for i, found in enumerate(out) if found is None]
        lost = dict.fromkeys([wanted[i] for i in places])
        fresh = [c for c in lost if c not in old]
        worked = dict(zip(fresh, self.work(fresh), strict=True)) if fresh else {}
        for c in lost:
            result = lost[c] = worked[c] if c in worked else old[c]
            if len(c) <= self.longest:
                young[c] = result
        for i in places:
            out[i] = lost[wanted[i]]
        if len(young) >= self.entries:
            self.old, self.young = young, {}
        return out


_loaded: dict[tuple, object] = {}


class Vocabulary:
    """A vocabulary file read on the driver and sent to the tasks; its size does not grow with the data.
    ``load(make)`` gives what ``make`` builds from its bytes, once per worker process."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, "rb") as file:
            raw = file.read()
        self.digest = hashlib.sha256(raw).hexdigest()
        self.raw: Broadcast[bytes] = spark.sparkContext.broadcast(raw)

    def load(self, make: Callable[[bytes], object]):
        key = (self.digest, make.__module__, make.__qualname__)
        if key not in _loaded:
            _loaded[key] = make(self.raw.value)
        return _loaded[key]
