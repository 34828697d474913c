"""Cross-tokenizer alignment: byte cuts of two tokenizers over one text, groups between common cuts, links.

The tokenizers' own spans are the coarse cuts: character offsets on one side (A), spans of the sentencepiece proto on
the other (B; the installed library refuses ``immutable_proto`` and gives the same spans as an offset mapping). Where
tokens share a character, and for byte-fallback tokens, the cuts come from the decoded bytes. Texts are cut into
chunks that neither tokenizer joins across (``spaced.chunks``); each common chunk is aligned once and remembered.
"""

from __future__ import annotations

import gc
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame, functions as F, types as T
from tokenizers import Tokenizer

from ledgerlode.llm.arrays import pack, unpack
from ledgerlode.llm.spaced import Memo, Vocabulary, chunks, joins
from ledgerlode.sources.files import overwrite_path, shared_root, stored

PAIRS_AT_ONCE = 1 << 22        # counts of so many id pairs are sent to the tasks at a time (16 bytes each)
_RUN = 64                      # chunks tokenized side by side as one text
_SHIFT, _BYTES, _FLUSH = 32, 1 << 20, 1 << 21
#: A link as one number: A id, B id, and whether the A and the B token end with it.
_A, _B, _ID = 33, 2, (1 << 31) - 1


def byte_letters() -> dict[str, int]:
    """The letter that byte-level BPE writes for each byte: printed Latin-1 characters for themselves, the other
    bytes in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Bytes:
    """Tokenizer A with the bytes of its entries."""

    def __init__(self, raw: bytes):
        self.tokenizer = Tokenizer.from_str(raw.decode())
        self.tokenizer.encode_special_tokens = True
        letters = byte_letters()
        self.of = {i: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode()
                   for t, i in self.tokenizer.get_vocab().items()}

    def cut(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids and the byte offsets where the tokens end. A token ends where its characters do, unless the next token
        starts within them; then its decoded bytes say where."""
        out = []
        for text, found in zip(texts, self.tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
            ids, spans = found.ids, found.offsets
            if text.isascii():                  # a character is a byte, which no two tokens share
                out.append((ids, [end for _, end in spans]))
                continue
            code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            width = 1 + (code >= 1 << 7).astype(np.int64) + (code >= 1 << 11) + (code >= 1 << 16)
            at_byte = [0, *np.cumsum(width).tolist()]
            starts = [s for s, _ in spans[1:]] + [len(text)]
            ends, at = [], 0
            for token, (_, end), following in zip(ids, spans, starts):
                at = at_byte[end] if following >= end else at + len(self.of[token])
                ends.append(at)
            out.append((ids, ends))
        return out


class Pieces:
    """Tokenizer B with the bytes of its pieces."""

    def __init__(self, raw: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=raw)
        n = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(n)]
        self.bytes_ = {i for i in range(n) if self.model.is_byte(i)}
        self.of = [bytes([int(p[3:5], 16)]) if i in self.bytes_ else p.replace("▁", " ").encode()
                   for i, p in enumerate(pieces)]

    def cut(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """The same for texts that start with the space that the model adds, or with a line feed: then the piece that the
        model starts with is that space alone and goes. Spans count bytes of the text without the space; those of
        byte-fallback pieces are empty up to the last one of a character, so each of these is one byte."""
        bare = [t[1:] if t[0] == " " else t for t in texts]
        out = []
        for text, found in zip(texts, self.model.encode(bare, return_type="offset_mapping", return_bytes=True, num_threads=1)):
            ids, spans = found["ids"], found["offsets"]
            own = text[0] == " "
            if not own:
                ids, spans = ids[1:], spans[1:]
            if self.bytes_.isdisjoint(ids):
                out.append((ids, [end + own for _, end in spans]))
                continue
            ends, at = [], 0
            for token, (_, end) in zip(ids, spans):
                at = at + 1 if token in self.bytes_ else end + own
                ends.append(at)
            out.append((ids, ends))
        return out


def match(a: list[int], a_ends: list[int], b: list[int], b_ends: list[int]) -> bytes:
    """The links of two tokenizations of the same bytes, in order, each as one number. Two tokens that overlap share
    exactly one stretch between neighbouring cuts of either side, so each stretch is a link."""
    links = []
    i = j = 0
    while i < len(a):
        gap = a_ends[i] - b_ends[j]
        links.append(a[i] << _A | b[j] << _B | (gap <= 0) << 1 | (gap >= 0))
        if gap <= 0:
            i += 1
        if gap >= 0:
            j += 1
    return array("q", links).tobytes()


def linked_runs(a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray, stops: np.ndarray) -> list[bytes]:
    """``match`` of many texts side by side, which end at ``stops``: one result per text."""
    cuts = np.union1d(a_ends, b_ends)
    i, j = np.searchsorted(a_ends, cuts), np.searchsorted(b_ends, cuts)
    a_end, b_end = a_ends[i] == cuts, b_ends[j] == cuts
    last = np.searchsorted(cuts, stops)
    if not (np.array_equal(cuts[last], stops) and (a_end & b_end)[last].all()):
        raise ValueError("a token crosses the cut between two chunks")
    links = (a[i] << _A | b[j] << _B | a_end.astype(np.int64) << 1 | b_end).tobytes()
    edges = [0, *((last + 1) * 8).tolist()]
    return [links[x:y] for x, y in zip(edges, edges[1:])]


def _spelled(data: bytes, ids: list[int], ends: list[int], of) -> bool:
    """Whether the tokens' bytes are the text's; then they must end where the spans say."""
    words = [of[i] for i in ids]
    if b"".join(words) != data:
        return False
    if list(accumulate(map(len, words))) != ends:
        raise ValueError("spans and bytes of the tokens disagree")
    return True


class Aligner:
    def __init__(self, a: Bytes, b: Pieces):
        self.a, self.b = a, b
        self.memo = Memo(self.chunks, 400_000)

    def chunks(self, texts: list[str]) -> list[bytes]:
        """The links of each text that starts with a space or line feed; none where the tokens' bytes are not the text's.
        Texts that neither tokenizer joins to the next are tokenized side by side, ``_RUN`` in a run."""
        plain = [t for t in dict.fromkeys(texts) if joins(t)]
        known: dict[str, bytes] = {}
        for part in ([t for t in plain if t.isascii()], [t for t in plain if not t.isascii()]):
            known.update(self._runs([part[k:k + _RUN] for k in range(0, len(part), _RUN)]))
        alone = [t for t in texts if t not in known]
        known.update(zip(alone, [self._one(t.encode(), *x, *y)
                                 for t, x, y in zip(alone, self.a.cut(alone), self.b.cut(alone), strict=True)]))
        return [known[t] for t in texts]

    def _runs(self, runs: list[list[str]]) -> dict[str, bytes]:
        """The links of the texts in runs that their tokens spell; texts of other runs are left out."""
        joined = ["".join(run) for run in runs]
        texts, stops, size = [], [], 0
        ids, ends = ([], []), ([], [])
        for run, text, *cut in zip(runs, joined, self.a.cut(joined), self.b.cut(joined), strict=True):
            data = text.encode()
            if not all(_spelled(data, *x, of) for x, of in zip(cut, (self.a.of, self.b.of))):
                continue
            for k, (found, at) in enumerate(cut):
                ids[k].extend(found)
                ends[k].append(np.array(at, np.int64) + size)
            texts += run
            stops += accumulate([len(t.encode()) for t in run[1:]], initial=size + len(run[0].encode()))
            size += len(data)
        if not texts:
            return {}
        return dict(zip(texts, linked_runs(*[x for k in (0, 1) for x in (np.array(ids[k], np.int64), np.concatenate(ends[k]))],
                                           np.array(stops, np.int64))))

    def _one(self, data: bytes, a: list[int], a_ends: list[int], b: list[int], b_ends: list[int]) -> bytes:
        if not (_spelled(data, a, a_ends, self.a.of) and _spelled(data, b, b_ends, self.b.of)):
            return b""
        return match(a, a_ends, b, b_ends)

    def texts(self, texts: list[str]) -> list[bytes]:
        """The links of whole texts, without the space before them; none for an empty one."""
        cut = [chunks(" " + t) if t else [] for t in texts]
        edges = [0, *accumulate(map(len, cut))]
        found = self.memo.of([c for one in cut for c in one])
        if b"" not in found:
            return [b"".join(found[x:y]) for x, y in zip(edges, edges[1:])]
        return [self.chunks([" " + t])[0] if b"" in (parts := found[x:y]) else b"".join(parts)
                for t, x, y in zip(texts, edges, edges[1:])]


@lru_cache(maxsize=4)
def _written(size: int) -> np.ndarray:
    """The decimal digits of the numbers below ``size``, behind zero bytes."""
    texts = np.array([str(i).rjust(len(str(size))) for i in range(size)], "S")
    table = texts.view(np.uint8).reshape(size, -1)
    return np.where(table == ord(" "), 0, table).astype(np.uint8)


def _digits(size: int) -> np.ndarray:
    return _written(1 << max(10, (size - 1).bit_length()))


class Linked:
    """The links of several texts side by side; ``edges`` has where each text's begin."""

    def __init__(self, texts: list[bytes]):
        links = np.frombuffer(b"".join(texts), np.int64)
        self.edges = np.concatenate(([0], np.cumsum([len(t) // 8 for t in texts], dtype=np.int64)))
        self.a, self.b = links >> _A, links >> _B & _ID
        self.a_end, self.b_end = (links >> 1 & 1).astype(bool), (links & 1).astype(bool)
        self.closed = self.a_end & self.b_end

    def counts(self) -> list[np.ndarray]:
        """Tokens of A and of B, groups and links of each text."""
        sums = [np.concatenate(([0], np.cumsum(x)))[self.edges] for x in (self.a_end, self.b_end, self.closed)]
        return [np.diff(x) for x in (*sums, self.edges)]

    def groups(self) -> list[str]:
        """The groups of each text as ``a1,a2|b1;a3|b2,b3``."""
        group = np.cumsum(self.closed) - self.closed
        through = [np.cumsum(x)[self.closed] for x in (self.a_end, self.b_end)]
        before_b = np.concatenate(([0], through[1][:-1])) if len(through[1]) else through[1]
        ids, place, stop = [], [], []
        last = np.zeros(len(through[0]), bool)                       # the last group of each text
        n_groups = np.cumsum(self.counts()[2])
        last[n_groups[n_groups > 0] - 1] = True
        for k, (token, ends, other) in enumerate(((self.a, self.a_end, before_b), (self.b, self.b_end, through[0]))):
            of = group[ends]
            number = np.arange(len(of))
            closing = np.full(len(of), ord("|")) if k == 0 else np.where(last[of], 0, ord(";"))
            ids.append(token[ends])
            place.append(number + other[of])
            stop.append(np.where(number + 1 == through[k][of], closing, ord(",")))
        at = np.concatenate(place)
        token, end = np.empty(len(at), np.int32), np.empty(len(at), np.uint8)
        token[at], end[at] = np.concatenate(ids), np.concatenate(stop)
        digits = _digits(int(token.max(initial=0)) + 1)
        rows = np.empty((len(at), digits.shape[1] + 1), np.uint8)
        rows[:, :-1], rows[:, -1] = digits[token], end
        written = rows != 0
        sizes = np.concatenate(([0], np.cumsum(written.sum(1))))
        a, b, _, _ = self.counts()
        edges = sizes[np.concatenate(([0], np.cumsum(a + b)))].tolist()
        text = rows[written].tobytes().decode("ascii")
        return [text[x:y] for x, y in zip(edges, edges[1:])]

    def packed(self) -> list[bytes]:
        """The distinct id pairs of each text and how often each is linked (``link_arrays``)."""
        pairs = self.a << _SHIFT | self.b
        out = []
        for lo, hi in zip(self.edges[:-1].tolist(), self.edges[1:].tolist()):
            names, times = np.unique(pairs[lo:hi], return_counts=True)
            out.append(pack(np.diff(names, prepend=0), times.astype(np.int32)))
        return out


_aligners: dict[tuple[str, str], Aligner] = {}


def align_documents(documents: DataFrame, byte_level: str | None = None, pieces: str | None = None) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups, links`` for each document's whole text, by the tokenizer files
    ``byte_level`` (A, over a space and the text) and ``pieces`` (B, which adds the space).

    ``groups`` reads ``a1,a2|b1;a3|b2,b3``: the ids between byte offsets where tokens of both sides end. ``links`` is
    packed: the distinct id pairs of tokens that overlap, and how often each does (``link_arrays``). Texts that are
    null or empty, or whose joined token bytes differ from space and text, have no tokens: zeros, an empty string.
    Repeated rows and null ids are rows of their own; other columns are ignored; an empty table gives no rows. A
    row is one unit of work, in time linear in its text but for the tokenizers' own.
    """
    spark = documents.sparkSession
    words = Vocabulary(spark, byte_level or public_tokenizers.path("byte_bpe_50k.json"))
    parts = Vocabulary(spark, pieces or public_tokenizers.path("piece_bpe_32k.model"))
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    def work(batches):
        key = (words.digest, parts.digest)
        if key not in _aligners:
            _aligners[key] = Aligner(words.load(Bytes), parts.load(Pieces))
        gc.disable()               # spans are millions of small tuples, none in a cycle
        try:
            for batch in batches:
                yield from _aligned(batch, _aligners[key])
        finally:
            gc.enable()

    fields = [T.LongType()] * 4 + [T.StringType(), T.BinaryType()]
    schema = T.StructType([T.StructField("doc_id", documents.schema["doc_id"].dataType),
                           *[T.StructField(n, k) for n, k in zip(_NAMES[1:], fields)]])
    return rows.mapInArrow(work, schema)


_NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links"]


def _aligned(batch: pa.RecordBatch, aligner: Aligner) -> Iterator[pa.RecordBatch]:
    """The rows of a batch aligned, about ``_BYTES`` of text at a time."""
    column, lo, size = batch.column("text"), 0, 0
    lengths = pc.binary_length(column).to_pylist()
    for i, length in enumerate(lengths):
        size += length
        if size > _BYTES or i == len(lengths) - 1:
            n = i + 1 - lo
            linked = Linked(aligner.texts(column.slice(lo, n).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(lo, n), *[pa.array(c, pa.int64()) for c in linked.counts()],
                 pa.array(linked.groups(), pa.string()), pa.array(linked.packed(), pa.binary())], _NAMES)
            lo, size = i + 1, 0


def link_arrays(links: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of a document, as A id times 2^32 plus B id, ascending, and how often each is linked."""
    steps, times = unpack(links, np.int64, np.int32)
    return np.cumsum(steps), times.astype(np.int64)


def _summed(pairs: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    names, place = np.unique(np.concatenate(pairs), return_inverse=True)
    return names, np.bincount(place, np.concatenate(times), len(names)).astype(np.int64)


def link_counts(aligned: DataFrame) -> DataFrame:
    """``a_id, b_id, n, best``: how many links of all documents hold each id pair, and whether no other pair of the
    same B id has more. Tasks sum up before the shuffle, so a frequent pair is one row of each."""
    def work(batches):
        pairs, times, size = [], [], 0

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(x) for x in _summed(pairs, times)], ["pair", "n"])

        for batch in batches:
            for blob in batch.column("links").to_pylist():
                codes, often = link_arrays(blob)
                pairs.append(codes)
                times.append(often)
                size += len(codes)
                if size > _FLUSH:
                    codes, often = _summed(pairs, times)
                    pairs, times, size = [codes], [often], len(codes)
                    if size > _FLUSH // 2:
                        yield flush()
                        pairs, times, size = [], [], 0
        if size:
            yield flush()

    partial = aligned.select("links").mapInArrow(work, "pair long, n long")
    counts = stored(partial.groupBy("pair").agg(F.sum("n").alias("n")).select(
        F.shiftright("pair", _SHIFT).cast("int").alias("a_id"),
        F.col("pair").bitwiseAND(F.lit((1 << _SHIFT) - 1)).cast("int").alias("b_id"), "n"), "link-counts")
    most = counts.groupBy("b_id").agg(F.max("n").alias("most"))      # one row per piece of the vocabulary
    return (counts.join(F.broadcast(most), "b_id")
                  .select("a_id", "b_id", "n", (F.col("n") == F.col("most")).alias("best")))


def _bucket(a_id, b_id, buckets: int):
    return (a_id * 1_000_003 + b_id * 7919) % buckets


def _table(counts: DataFrame):
    """The counts, sorted by pair, sent to the tasks."""
    rows = counts.select((F.shiftleft(F.col("a_id").cast("long"), _SHIFT) + F.col("b_id")).alias("pair"),
                         "n", "best").toArrow()
    pair, n, best = (rows.column(k).to_numpy() for k in ("pair", "n", "best"))
    order = np.argsort(pair)
    return counts.sparkSession.sparkContext.broadcast((pair[order], n[order], best[order]))


def _looked_up(table, codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pair, n, best = table.value
    at = np.searchsorted(pair, codes)
    return times * best[at], times * n[at]


def score_links(aligned: DataFrame, counts: DataFrame, pairs_at_once: int = PAIRS_AT_ONCE) -> DataFrame:
    """The columns of ``aligned`` (a stored frame) without ``links``, and ``n_best`` and ``count_sum``: a document's
    links with a pair that is its B id's most frequent, and the counts of its links' pairs summed.

    The counts go to the tasks ``pairs_at_once`` at a time. Where there are more, the documents' links are dealt
    out once into as many buckets as are needed to keep each below that, and each bucket meets its own counts; so no
    frequent pair, and no document, is one task's work.
    """
    counts = stored(counts, "link-table")
    buckets = max(1, -(-counts.count() // pairs_at_once))
    rest = [c for c in aligned.columns if c != "links"]
    if buckets == 1:
        table = _table(counts)

        def score(batches):
            for batch in batches:
                sums = [[int(x.sum()) for x in _looked_up(table, *link_arrays(blob))]
                        for blob in batch.column("links").to_pylist()]
                arrays = [pa.array(c, pa.int64()) for c in (zip(*sums) if sums else ([], []))]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], *arrays],
                                                 [*rest, "n_best", "count_sum"])

        schema = T.StructType([*[aligned.schema[c] for c in rest], T.StructField("n_best", T.LongType()),
                               T.StructField("count_sum", T.LongType())])
        return aligned.mapInArrow(score, schema)

    def size_of(n: int) -> int:
        return counts.groupBy(_bucket(F.col("a_id").cast("long"), F.col("b_id"), n)).count().agg(F.max("count")).first()[0]

    while size_of(buckets) > pairs_at_once and buckets < 1 << 20:
        buckets += max(1, buckets // 8)
    numbered = stored(aligned.withColumn("__row", F.monotonically_increasing_id()), "aligned-rows")

    def deal(batches):
        for batch in batches:
            found = [link_arrays(blob) for blob in batch.column("links").to_pylist()]
            rows = np.repeat(batch.column("__row").to_numpy(), [len(c) for c, _ in found])
            codes, times = np.concatenate([c for c, _ in found]), np.concatenate([t for _, t in found])
            bucket = _bucket(codes >> _SHIFT, codes & (1 << _SHIFT) - 1, buckets)
            order = np.argsort(bucket, kind="stable")
            names, begin = np.unique(bucket[order], return_index=True)
            blobs = [pack(rows[o], codes[o], times[o]) for o in np.split(order, begin[1:])] if len(names) else []
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(blobs, pa.binary())], ["bucket", "links"])

    path = shared_root(aligned.sparkSession, "link-buckets")
    overwrite_path(numbered.select("__row", "links").mapInArrow(deal, "bucket long, links binary"), path,
                   partition_by=["bucket"])
    dealt, sums = aligned.sparkSession.read.schema("links binary, bucket long").parquet(path), None
    for k in range(buckets):
        part = stored(dealt.where(F.col("bucket") == k).select("links")
                           .mapInArrow(_bucket_sums(_table(counts.where(_bucket_is(k, buckets)))),
                                       "__of long, n_best long, count_sum long"), "link-sums")
        sums = part if sums is None else sums.unionByName(part)
    sums = sums.groupBy("__of").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return numbered.join(sums, F.col("__row") == F.col("__of"), "left").select(
        *rest, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")])


def _bucket_is(k: int, buckets: int) -> Column:
    return _bucket(F.col("a_id").cast("long"), F.col("b_id"), buckets) == k


def _bucket_sums(table):
    def work(batches):
        for batch in batches:
            for blob in batch.column("links").to_pylist():
                rows, codes, times = unpack(blob, np.int64, np.int64, np.int64)
                best, total = _looked_up(table, codes, times)
                names, place = np.unique(rows, return_inverse=True)
                sums = [np.zeros(len(names), np.int64) for _ in range(2)]
                np.add.at(sums[0], place, best)
                np.add.at(sums[1], place, total)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (names, *sums)], ["__of", "n_best", "count_sum"])
    return work
