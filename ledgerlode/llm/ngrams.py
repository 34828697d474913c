"""N-gram Jaccard join: a blocked sparse product of documents and shingles under size bounds."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerlode.llm import arrays as A
from ledgerlode.llm.components import components
from ledgerlode.sources.files import discard, shared_root, stored

N = 5
#: Size of the table of frequent shingles, which only decides the order of shingles, never the result.
FREQUENT = 1 << 18
_SEEN = 4
#: A block of the product: so many documents, or so many shingles in them, at most.
BLOCK_ROWS = 1024
BLOCK_SHINGLES = 2_000_000
_COLUMNS = 4096
_PART_BYTES = 16 << 20
_COPIED = 256
#: A block of more shingles gives its memory back when it is done; for each small one that would take too long.
_LARGE = 100_000


def _mark() -> Column:
    """Together with doc_id, this tells rows apart that differ in their texts."""
    return F.xxhash64("text")


def needed(n):
    """Of n shingles, how many a linked document must share at least: 4/5, rounded up."""
    return (4 * n + 4) // 5


def _shingles(data: np.ndarray, offsets: np.ndarray, n: int = N):
    """Digests of the n-word shingles of all rows in order of place, and the offsets of each row's."""
    starts, ends, of_row = A.find_words(A.LOWER[data], offsets)
    words = A.byte_digests(A.LOWER[data], starts, ends)
    size = np.diff(of_row)
    count = np.where(size == 0, 0, np.maximum(size - n + 1, 1))
    first = A.ranges(of_row[:-1], count)
    length = np.repeat(np.minimum(size, n), count)
    return A.sequence_digests(words, first, first + length), np.concatenate(([0], np.cumsum(count)))


def _sets(column):
    """The sorted distinct shingles of each row."""
    data, offsets = A.text_bytes(column)
    for lo, hi in A.slices(data, offsets):
        digests, of_row = _shingles(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        for i in range(hi - lo):
            yield np.unique(digests[of_row[i]:of_row[i + 1]])


def _several(column) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that at least ``_SEEN`` rows hold, and how many do. All are sorted in place, and only those are
    counted, as a batch holds many times its bytes of them."""
    shingle = np.concatenate(list(_sets(column)))
    shingle.sort()
    ahead = _SEEN - 1
    kinds = np.unique(shingle[ahead:][shingle[ahead:] == shingle[:max(len(shingle) - ahead, 0)]])
    return kinds, np.searchsorted(shingle, kinds, "right") - np.searchsorted(shingle, kinds)


def frequent_shingles(documents: DataFrame, size: int = FREQUENT) -> np.ndarray:
    """The most frequent shingles, rarest of them first. Each batch of all documents reports the shingles that
    it holds in several documents, Spark adds them up, and the ``size`` largest come to the driver."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        kinds, count = _several(batch.column("text"))
        return A.batch_of(shingle=kinds.view(np.int64), seen=count)

    top = (documents.select("text").mapInArrow(A.by_batch(work), "shingle long, seen long")
                    .groupBy("shingle").agg(F.sum("seen").alias("seen"))
                    .orderBy(F.desc("seen"), "shingle").limit(size))
    return top.toArrow().column("shingle").to_numpy().view(np.uint64)[::-1].copy()


def _prefix(found: np.ndarray, rare: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The rarest shingles of a set: two linked sets share at least one of these."""
    k = len(found) - needed(len(found)) + 1
    if len(rare) >= k:
        return rare[:k]
    return np.concatenate((rare, rank[:k - len(rare)]))


def document_sets(documents: DataFrame, frequent: np.ndarray) -> DataFrame:
    """``doc_id, mark, n, digest, prefix`` for each document: the hash of its text, size and digest of its set, and
    the packed prefix."""
    order = np.argsort(frequent)
    table = documents.sparkSession.sparkContext.broadcast((frequent[order], order))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        known, rank = table.value
        sizes, digests, prefixes = [], [], []
        for found in _sets(batch.column("text")):
            at = np.minimum(np.searchsorted(known, found), max(len(known) - 1, 0))
            often = known[at] == found if len(known) else np.zeros(len(found), bool)
            common = found[often][np.argsort(rank[at[often]])] if often.any() else found[:0]
            sizes.append(len(found))
            digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
            prefixes.append(_prefix(found, found[~often], common).tobytes() if len(found) else None)
        return A.batch_of(doc_id=batch.column("doc_id"), mark=batch.column("mark"), n=np.array(sizes, np.int64),
                          digest=pa.array(digests, pa.binary()), prefix=pa.array(prefixes, pa.binary()))

    return documents.select("doc_id", "text", _mark().alias("mark")).mapInArrow(
        A.by_batch(work), "doc_id long, mark long, n long, digest binary, prefix binary")


def _postings(parts: int):
    """Blocks of the incidence matrix: the prefixes of a batch, dealt by shingle, one packed value a part."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column("node").to_numpy()
        sizes = batch.column("n").to_numpy()
        data, offsets = A.text_bytes(batch.column("prefix"))
        shingle = np.frombuffer(data.tobytes(), np.uint64)
        row = np.repeat(np.arange(len(ids)), np.diff(offsets) // 8)
        part = (A.mix(shingle) % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((shingle, part))
        edge = np.flatnonzero(np.diff(part[order], prepend=-1))
        out = []
        for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(order)], strict=True):
            rows, local = np.unique(row[order[a:b]], return_inverse=True)
            out.append(A.pack(shingle[order[a:b]], local.astype(np.int32), ids[rows], sizes[rows]))
        return A.batch_of(part=part[order][edge].astype(np.int32), block=pa.array(out, pa.binary()))
    return A.by_batch(work)


def _stars(table: pa.Table) -> pa.Table:
    """Within each shingle's list, sorted by size, and cut where the next size is out of the bound: the first
    document of the piece with each other one. Every pair of documents that can be linked and shares the
    shingle lies in one piece."""
    shingles, ids, sizes = [], [], []
    for blob in table.column("block").to_pylist():
        shingle, local, doc, n = A.unpack(blob, np.uint64, np.int32, np.int64, np.int64)
        shingles.append(shingle)
        ids.append(doc[local])
        sizes.append(n[local])
    shingle, doc, n = np.concatenate(shingles), np.concatenate(ids), np.concatenate(sizes)
    order = np.argsort(shingle, kind="stable")
    shingle, doc, n = shingle[order], doc[order], n[order]
    shared = np.zeros(len(shingle) + 1, bool)
    shared[1:-1] = shingle[1:] == shingle[:-1]
    many = shared[1:] | shared[:-1]
    shingle, doc, n = shingle[many], doc[many], n[many]
    order = np.lexsort((doc, n, shingle))
    shingle, doc, n = shingle[order], doc[order], n[order]
    if not len(doc):
        pairs = np.zeros((2, 0), np.int64)
    else:
        fresh = np.ones(len(doc), bool)
        fresh[1:] = (shingle[1:] != shingle[:-1]) | (needed(n[1:]) > n[:-1])
        center = doc[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
        pairs = np.unique(np.stack([center[~fresh], doc[~fresh]]), axis=1)
        del center, fresh
    if len(many) > _LARGE:
        del shingles, ids, sizes, shingle, doc, n, order, shared, many
        A.give_back()
    return pa.table({"center": pairs[0], "member": pairs[1]})


def _least_labels(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links the smallest row that can be reached."""
    label = np.arange(len(linked))
    while True:
        near = np.where(linked, label[None, :], len(linked)).min(axis=1, initial=len(linked))
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _product(sets: list[np.ndarray], allowed: np.ndarray | None = None) -> np.ndarray:
    """Which rows are linked, from the product of the incidence matrix with its transpose.

    Columns come in blocks. After each block a pair is discarded when the overlap counted so far and the
    shingles still to come cannot reach 4/9 of the two sizes together (a Jaccard index of 4/5), and a row without
    pairs left takes no part in later blocks. Pairs not allowed are not counted.
    """
    size = np.array([len(s) for s in sets], np.int64)
    both = size[:, None] + size[None, :]
    alive = (needed(np.maximum(size[:, None], size[None, :])) <= np.minimum(size[:, None], size[None, :]))
    if allowed is not None:
        alive &= allowed
    np.fill_diagonal(alive, False)
    column_of = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), size)
    kinds, column, times = np.unique(column_of, return_inverse=True, return_counts=True)
    useful = times[column] > 1
    rename = np.cumsum(times > 1) - 1
    column, row = rename[column[useful]], row[useful]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    width = int((times > 1).sum())
    overlap = np.zeros((len(sets), len(sets)), np.float32)
    left = np.bincount(row, minlength=len(sets)).astype(np.int64)
    for lo in range(0, width, _COLUMNS):
        # 9 * overlap >= 4 * (size + size)
        alive &= 9 * (overlap + np.minimum(left[:, None], left[None, :])) >= 4 * both
        live = alive.any(axis=1)
        if not live.any():
            break
        a, b = np.searchsorted(column, [lo, lo + _COLUMNS])
        keep = live[row[a:b]]
        rows = np.flatnonzero(live)
        place = np.cumsum(live) - 1
        block = np.zeros((len(rows), min(_COLUMNS, width - lo)), np.float32)
        block[place[row[a:b][keep]], column[a:b][keep] - lo] = 1
        overlap[np.ix_(rows, rows)] += block @ block.T
        left -= np.bincount(row[a:b], minlength=len(sets))
    return alive & (9 * overlap.astype(np.int64) >= 4 * both)


def _links(table: pa.Table) -> pa.Table:
    """Links of a block, as one from each document to the smallest that it is connected with in the block. A
    block of two sides counts only pairs across it with one end outside the center's component."""
    ids = table.column("member").to_numpy()
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    blobs = table.column("zipped").to_pylist()
    unzip = zstandard.ZstdDecompressor().decompress
    sets = list(_sets(pa.array([unzip(blobs[i]) for i in order], pa.large_binary())))
    allowed = None
    if "side" in table.column_names:
        side = table.column("side").to_numpy()[order]
        apart = table.column("apart").to_numpy(zero_copy_only=False)[order]
        allowed = (side[:, None] != side[None, :]) & (apart[:, None] | apart[None, :])
    label = _least_labels(_product(sets, allowed))
    if sum(map(len, sets)) > _LARGE:
        del sets, blobs
        A.give_back()
    moved = label != np.arange(len(ids))
    return pa.table({"a": ids[label[moved]], "b": ids[moved]})


def _pressed(texts: pa.Array) -> pa.Array:
    """Texts compressed one by one, nulls as they are; some at a time, since Python holds each once more."""
    press = zstandard.ZstdCompressor(level=3).compress
    return pa.array([None if t is None else press(t) for lo in range(0, len(texts), _COPIED)
                     for t in texts.slice(lo, _COPIED).cast(pa.binary()).to_pylist()], pa.binary())


_LINK = "a long, b long"


def _classes(sets: DataFrame) -> DataFrame:
    """``digest, rep, mark, n, node``: documents with equal sets as one row, led by the smallest id (null last), the
    texts of one id by their hash. ``node`` numbers the rows, so it holds only once they are stored."""
    lead = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark"))
    return (sets.where("n > 0").groupBy("digest").agg(lead.alias("lead"), F.first("n").alias("n"))
                .select("digest", F.col("lead.doc_id").alias("rep"), F.col("lead.mark").alias("mark"), "n",
                        F.monotonically_increasing_id().alias("node")))


def without_contained(stars: DataFrame) -> DataFrame:
    """The groups that no larger group of their center holds whole. A group of near copies has many centers, as each
    copy lacks some shingles; the pairs of a group inside another one are counted there. A group goes only in favour
    of another one that holds its center too and so has more members; that one stays, as the largest of its own."""
    stars = stars.where("center <> member")
    sizes = stars.groupBy("center").agg(F.count(F.lit(1)).alias("size"))
    largest = (stars.join(sizes, "center").groupBy(F.col("member").alias("of"))
                    .agg(F.max_by("center", F.struct("size", "center")).alias("large")))
    held = stars.select(F.col("center").alias("large"), "member")
    inside = (stars.join(largest, F.col("center") == F.col("of")).join(held, ["large", "member"])
                   .groupBy("center").agg(F.count(F.lit(1)).alias("inside")))
    whole = inside.join(sizes, "center").where("inside = size").select("center")
    return stars.join(whole, "center", "left_anti")


def similar_links(documents: DataFrame, sets: DataFrame, reps: DataFrame, parts: int, block_rows: int = BLOCK_ROWS,
                  block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """Links ``a, b`` that connect the same nodes as all links between the classes ``reps`` of the document
    ``sets`` do.

    A group is a center and the documents that share a prefix shingle with it (``_stars``); its product finds
    every link in it. A group that exceeds a block is cut into chunks that each hold the center too; then the
    documents that their center's component did not take in are multiplied with the other chunks, two
    chunks at a time. Documents of the center's component need no pairs with each other.
    """
    spark = documents.sparkSession
    prefixes = sets.where("n > 0").groupBy("digest").agg(F.first("prefix").alias("prefix"))
    stars = (prefixes.join(reps.select("digest", "node", "n"), "digest").select("node", "n", "prefix")
                 .mapInArrow(_postings(parts), "part int, block binary")
                 .groupBy("part").applyInArrow(_stars, "center long, member long").distinct())
    members_path = shared_root(spark, "ngram-stars")
    stars = without_contained(stored(stars, "", members_path))
    groups_path = shared_root(spark, "ngram-kept-stars")
    stars = stored(stars, "", groups_path)
    members = stars.unionByName(stars.select("center", F.col("center").alias("member")).distinct())

    def zipped(batch: pa.RecordBatch) -> pa.RecordBatch:
        return A.batch_of(doc_id=batch.column("doc_id"), text_mark=batch.column("text_mark"),
                          zipped=_pressed(batch.column("text").fill_null("")))

    # Texts are smaller than their shingles, and smaller still compressed one by one before the shuffles.
    texts = documents.select("doc_id", "text", _mark().alias("text_mark")).mapInArrow(
        A.by_batch(zipped), "doc_id long, text_mark long, zipped binary")
    leads = reps.select(F.col("node").alias("member"), "rep", "mark")

    def with_texts(dealt: DataFrame) -> DataFrame:
        return (dealt.join(leads, "member")
                     .join(texts, F.col("rep").eqNullSafe(F.col("doc_id")) & (F.col("mark") == F.col("text_mark")))
                     .select(*dealt.columns, "zipped"))

    sized = members.join(reps.select(F.col("node").alias("member"), "n"), "member")
    chunks = (sized.groupBy("center").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("total"))
                   .select("center", F.greatest(F.lit(1), F.ceil(F.col("rows") / block_rows),
                                                F.ceil(F.col("total") / block_shingles)).alias("chunks")))
    large_path = shared_root(spark, "ngram-groups")
    placed = stored(members.join(chunks, "center").withColumn(
        "chunk", F.pmod(F.xxhash64("member", "center"), F.col("chunks"))), "", large_path)
    # The center goes to all chunks.
    everywhere = placed.where("member = center").withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    dealt = placed.where("member <> center").unionByName(everywhere).select("center", "member", "chunk")
    links_path = shared_root(spark, "ngram-links")
    links = stored(with_texts(dealt).groupBy("center", "chunk")
                        .applyInArrow(_links, _LINK).distinct(), "", links_path)
    big = placed.where("chunks > 1")
    if not big.isEmpty():
        found = components(links)
        label = big.join(found.withColumnRenamed("node", "member"), "member", "left").select(
            "center", "member", "chunk", "chunks", F.coalesce("component", "member").alias("mine"))
        center = label.where("member = center").select("center", F.col("mine").alias("its"))
        marked = label.join(center, "center").withColumn("apart", F.col("mine") != F.col("its")).drop("mine", "its")
        marked = stored(marked, "ngram-apart")
        open_chunks = marked.where("apart").select("center", F.col("chunk").alias("other")).distinct()
        with_open = marked.where("not apart").join(open_chunks, "center")
        with_all = marked.where("apart").withColumn(
            "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        across = (with_open.unionByName(with_all).where("chunk <> other")
                  .select("center", "member", "apart", F.least("chunk", "other").alias("low"),
                          F.greatest("chunk", "other").alias("high"), F.col("chunk").alias("side")))
        more = with_texts(across).groupBy("center", "low", "high").applyInArrow(_links, _LINK)
        links = stored(links.unionByName(more).distinct(), "ngram-links")
    for path in (members_path, groups_path, large_path):
        discard(spark, path)
    return links


def ngram_components(documents: DataFrame, block_rows: int = BLOCK_ROWS,
                     block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each document.

    Words are split at white space, A-Z in lower case; a document's set are its distinct five-word
    shingles, or its whole sequence when it has fewer words. Two documents are linked when they share at
    least 4/5 of their union; ``component_id`` is the smallest doc_id that links lead to.

    Documents with equal sets are one class, led by its smallest id. Two linked sets share one of each one's
    rarest n - ceil(4n/5) + 1 shingles under one order of all shingles (frequent ones last), so only these are
    dealt out, by shingle. Groups that share one are multiplied in blocks (``similar_links``), which counts the
    exact overlaps.

    A text without words has 0 shingles and its own id as component; so has a row whose id is null (null).
    Each row of a repeated id is a document of its own: classes are numbered, not named by an id. Other columns
    are ignored. Empty tables give no rows.
    """
    sets = _stored_sets(documents)
    leads = _leads(documents, sets.where("doc_id IS NOT NULL"), block_rows, block_shingles)
    return sets.join(leads.select("digest", "rep"), "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("component_id"))


def _stored_sets(documents: DataFrame) -> DataFrame:
    documents = documents.select("doc_id", "text")
    return stored(document_sets(documents, frequent_shingles(documents)), "ngram-sets")


def _leads(documents: DataFrame, sets: DataFrame, block_rows: int = BLOCK_ROWS,
           block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """``digest, rep, mark``: for each class of the ``sets`` the first row (by id, null last, then text hash) of its
    component."""
    spark = documents.sparkSession
    documents = documents.select("doc_id", "text")
    size = documents.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(2 * shuffles, int(size) // _PART_BYTES)
    reps_path = shared_root(spark, "ngram-classes")
    reps = stored(_classes(sets), "", reps_path)
    found = components(similar_links(documents, sets, reps, parts, block_rows, block_shingles))
    linked = reps.join(found, "node")
    first = linked.groupBy("component").agg(
        F.min(F.struct(F.col("rep").isNull().alias("last"), "rep", "mark")).alias("first"))
    named = linked.join(first, "component").select("node", "first")
    own = F.col("first").isNull()
    return reps.join(named, "node", "left").select(
        "digest", F.when(own, F.col("rep")).otherwise(F.col("first.rep")).alias("rep"),
        F.when(own, F.col("mark")).otherwise(F.col("first.mark")).alias("mark"))


@F.arrow_udf(T.BinaryType())
def _zip(texts: pa.Array) -> pa.Array:
    blobs = _pressed(texts)
    A.give_back()
    return blobs


@F.arrow_udf(T.StringType())
def _unzip(blobs: pa.Array) -> pa.Array:
    unzip = zstandard.ZstdDecompressor().decompress
    parts = [pa.array([None if b is None else unzip(b) for b in blobs.slice(lo, _COPIED).to_pylist()], pa.binary())
             for lo in range(0, len(blobs), _COPIED)]
    texts = pa.concat_arrays(parts or [pa.array([], pa.binary())]).cast(pa.string())
    del parts
    A.give_back()
    return texts


def drop_near_copies(documents: DataFrame) -> DataFrame:
    """The documents, with all their columns, one row of each component: the one with the smallest id (null last).
    Each row counts by itself, also where ids repeat or are null. Rows without words stay.

    A row is known by its id and the hash of its text. Where several rows of a component are alike in both, the one
    with the smallest hash of all columns stays. Whole texts pass the shuffle of the join, each compressed by itself.
    The packing counts as not deterministic, or the optimizer would move it behind the join."""
    sets = _stored_sets(documents)
    first = _leads(documents, sets).select("digest", F.col("rep").alias("__rep"), F.col("mark").alias("__first"))
    rows = sets.where("n > 0").groupBy("digest", "doc_id", "mark").agg(F.count(F.lit(1)).alias("times"))
    is_first = F.col("doc_id").eqNullSafe(F.col("__rep")) & (F.col("mark") == F.col("__first"))
    rows = stored(rows.join(first, "digest").select(
        F.col("doc_id").alias("__id"), F.col("mark").alias("__gone"), "times", is_first.alias("first")), "ngram-rows")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__mark") == F.col("__gone"))
    once = rows.where("not first or times > 1").select("__id", "__gone")
    packed = documents.withColumn("__mark", _mark()).withColumn("text", _zip.asNondeterministic()("text"))
    kept = packed.join(once, same, "left_anti").select(*documents.columns)
    several = rows.where("first and times > 1").select("__id", "__gone")
    if not several.isEmpty():
        one = (packed.join(several, same, "left_semi").groupBy("doc_id", "__mark")
                     .agg(F.min_by(F.struct(*documents.columns), F.xxhash64(*documents.columns)).alias("__row")))
        kept = kept.unionByName(one.select("__row.*"))
    return kept.withColumn("text", _unzip("text"))
