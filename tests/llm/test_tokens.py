"""Byte-level BPE, vector codes and token alignment against the libraries and brute force, with nulls, empty and very
long texts, repeated rows, ties, extra columns with clashing names and empty tables."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

pytest.importorskip("ledgerlode.llm.queries")

from ledgerlode.llm import alignment, byte_pairs, grid_codes, queries_tokens  # noqa: E402
from ledgerlode.llm.registry import QUERIES, ship  # noqa: E402
from ledgerlode.llm.spaced import Memo, chunks  # noqa: E402
from ledgerlode.sources.files import stored  # noqa: E402

ODD = [None, "", " ", "   ", "one", "a" * 3000, " " * 2000 + "x", "!?" * 900, "\n \n  　 x 漢𠮷 " * 40, "<|endoftext|></s>",
       "'s 're''s can't", "\x85 ​ \x1c x", "▁a b", "a▁ b", "a  b", "a \x85b", "é é ﬁ", "\x00", "a ᠎b", "  lead and trail  "]


def texts():
    draw = random.Random(3)
    words = ["the", "ing", "Straße", "naïve,", "漢字", "🙂🙂", "12345", "x=1;", "\t", "", "can't", "zqxj", "\n\n"]
    made = [" ".join(draw.choice(words) for _ in range(draw.randint(1, 60))) for _ in range(60)]
    return ODD + made + [" ".join(draw.choice(words) + str(draw.randint(0, 999)) for _ in range(30_000))] + made[:3]


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    rows = [(i, t, "en", "x", 1, 2, b"") for i, t in enumerate(texts())] + [(None, "null id", "en", "x", 1, 2, b"")] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, groups string, n_a long, n_tokens long, ids binary")


@pytest.fixture(scope="module")
def coder():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        return byte_pairs.Coder.read(file.read())


@pytest.fixture(scope="module")
def library(coder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})


def test_chunks_join_to_the_text():
    for text in texts():
        assert "".join(chunks(text or "")) == (text or "")


def test_memo_keeps_what_is_in_use():
    asked = []
    memo = Memo(lambda found: asked.extend(found) or [c.upper() for c in found], entries=4, longest=3)
    for k in range(20):
        assert memo.of(["a", f"b{k}", "long one", "a"]) == ["A", f"B{k}", "LONG ONE", "A"]
    counts = Counter(asked)
    assert counts["a"] == 1 and counts["long one"] == 20 and len(memo.young) + len(memo.old) <= 10


def test_byte_pairs(docs, coder, library):
    coded = byte_pairs.decode_documents(byte_pairs.encode_documents(docs)).collect()
    want = Counter()
    for doc_id, text, *_ in docs.collect():
        ids = library.encode_ordinary(text or "")
        want[doc_id, len(ids), np.array(ids, "<u4").tobytes(), (text or "").encode()] += 1
    assert Counter((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in coded) == want
    assert byte_pairs.encode_documents(docs.limit(0)).count() == 0


def test_one_last_token_for_each_prefix(coder):
    data = "unbelievably aaaaaa'' 漢字".encode()
    table = coder.last_tokens(data.decode("latin-1"))
    for end in range(1, len(data) + 1):
        fits = [t for size in range(1, end + 1) if (t := coder.ranks.get(data[end - size:end])) is not None
                and coder.merged(coder.bytes_of[t]) == [t]
                and (size == end or coder.merged(coder.bytes_of[table[end - size - 1]] + coder.bytes_of[t])
                     == [table[end - size - 1], t])]
        assert fits == [table[end - 1]] and coder.merged(data[:end])[-1] == table[end - 1]
    draw = random.Random(7)
    for a, b in ((draw.randrange(50_256), draw.randrange(50_256)) for _ in range(3000)):
        assert coder.agree(a, b) == (coder.merged(coder.bytes_of[a] + coder.bytes_of[b]) == [a, b])
    for known in range(len(data) + 1):
        assert coder.last_tokens(data.decode("latin-1"), table[:known]) == table


def test_ranks_whose_tokens_do_not_encode_to_themselves():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"acbd": 258, b"cd": 259}
    coder = byte_pairs.Coder(ranks)
    own = tiktoken.Encoding("odd", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    draw = random.Random(4)
    sound = [r for t, r in ranks.items() if coder.merged(t) == [r]]
    assert 258 not in sound
    for a in (97, 98, 99, 100, 256, 257, 259):
        for b in (97, 98, 99, 100, 256, 257, 259):
            assert coder.agree(a, b) == (coder.merged(coder.bytes_of[a] + coder.bytes_of[b]) == [a, b])
    for _ in range(400):
        text = "".join(draw.choices("abcd ", k=draw.randint(0, 14)))
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == own.encode_ordinary(text)


def test_edits_and_appends(coder, library):
    draw = random.Random(1)
    parts = ["a", "ab ", "  ", "\n", "'", "s", "re", "漢", "1", "!!", " the", "ing"]
    for _ in range(120):
        edited = byte_pairs.EditedText(coder, "".join(draw.choices(parts, k=draw.randint(0, 60))))
        for step in range(5):
            i = len(edited.text) if step == 0 else draw.randint(0, len(edited.text))
            j = min(len(edited.text), i + draw.randint(0, 4))
            new = "".join(draw.choices(parts, k=draw.randint(0, 3)))
            want = edited.text[:i] + new + edited.text[j:]
            edited.replace(i, j, new)
            assert edited.text == want and edited.ids() == library.encode_ordinary(want)
    long = byte_pairs.EditedText(coder, "word " * 5000 + "y" * 4000)
    long.steps = 0
    long.append("z" * 10)
    assert long.steps == 10
    long.replace(10_002, 10_003, "Q")
    assert long.steps < 60 and long.ids() == library.encode_ordinary(long.text)


def brute_codes(rows, rounds=4):
    """Every entry for every part, in Python integers."""
    kept = [(v, lab, [math.floor(1024 * x) for x in e]) for v, e, lab in rows
            if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    seeds = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:256]
    w = len(seeds[0][2]) // 4
    books = [[s[2][p * w:(p + 1) * w] for s in seeds] for p in range(4)]

    def assign():
        out = []
        for _, _, v in kept:
            near = []
            for p, book in enumerate(books):
                part = v[p * w:(p + 1) * w]
                far = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in book]
                near.append((far.index(min(far)), min(far)))
            out.append(near)
        return out

    for _ in range(rounds):
        groups = defaultdict(list)
        for (_, _, v), near in zip(kept, assign()):
            for p, (e, _) in enumerate(near):
                groups[p, e].append(v[p * w:(p + 1) * w])
        books = [[[sum(c) // len(groups[p, e]) for c in zip(*groups[p, e])] if (p, e) in groups else entry
                  for e, entry in enumerate(book)] for p, book in enumerate(books)]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    final, by_label = assign(), Counter()
    for (_, lab, _), near in zip(kept, final):
        by_label[lab] += sum(d for _, d in near)
    return Counter((v, "".join(f"{e:02x}" for e, _ in near), sum(d for _, d in near), by_label[lab], digest)
                   for (v, lab, _), near in zip(kept, final))


def vectors_with_edges(kind=float):
    draw = random.Random(9)
    rows = [(i, [draw.gauss(0, 0.3) for _ in range(8)], draw.choice(["a", "b", None])) for i in range(320)]
    same = rows[300][1]
    rows += [(1000 + k, same, "hot") for k in range(150)] + [rows[7]] * 3
    nan, inf = float("nan"), float("inf")
    rows += [(2000, None, "a"), (2001, [nan] * 8, "a"), (2002, [0.0, None, *[0.1] * 6], "b"), (2003, [inf, *[0.0] * 7], "a"),
             (2004, [], "a"), (2005, [0.0] * 8, "zero"), (2006, [-0.0] * 8, "zero"), (None, [0.25] * 8, "a")]
    return rows


def test_grid_codes(spark):
    ship(spark)
    rows = vectors_with_edges()
    frame = spark.createDataFrame([(v, e, lab, 5, "c") for v, e, lab in rows],
                                  "vec_id long, embedding array<double>, label string, error long, code string")
    got = Counter(map(tuple, grid_codes.compress(frame).collect()))
    assert got == brute_codes([r for r in rows if r[1] != []])
    assert grid_codes.compress(frame.limit(0)).count() == 0
    assert grid_codes.compress(frame.where("vec_id = 2001")).count() == 0


def test_grid_codes_of_few_huge_and_other_vectors(spark):
    ship(spark)
    rows = [(5, [1e6, -1e6, 1e6, 2.0], 1), (6, [1e6, -1e6, 1e6, 2.0], 1), (7, [0.5, 0.5, 0.5, 0.5], None)]
    frame = spark.createDataFrame([*rows, (8, [1.0] * 8, 1)], "vec_id long, embedding array<double>, label int")
    assert Counter(map(tuple, grid_codes.compress(frame).collect())) == brute_codes(rows)
    far = [(k, [k * 1e200, 0.0, 0.0, float(k)], 1) for k in range(300)]
    out = grid_codes.compress(spark.createDataFrame(far, frame.schema)).collect()
    assert len(out) == 300 and all(r.error is None or r.error >= 0 for r in out)
    with pytest.raises(ValueError, match="equal parts"):
        grid_codes.compress(spark.createDataFrame([(1, [1.0] * 6, 1)], frame.schema))


@pytest.mark.parametrize("width", [1, 16, 256, 1 << 20])
def test_grid_width_changes_nothing(width):
    draw = np.random.default_rng(2)
    points, entries = draw.integers(-300, 300, (500, 4)), draw.integers(-300, 300, (90, 4))
    entries[40:50] = entries[3]
    points[::7] = entries[3]
    book = grid_codes.Book(entries.tolist())
    book.width = width
    far = ((points[:, None] - entries[None]) ** 2).sum(2)
    for _ in range(2):
        index, apart = book.nearest(points)
        assert (index == far.argmin(1)).all() and (apart == far.min(1)).all()
    if width > 1:
        assert len(book.cells) < len(points) and min(map(len, book.cells.values())) >= 1


def test_labels_above_and_below_the_hot_share(spark, monkeypatch):
    monkeypatch.setattr(grid_codes, "HOT_SHARE", 3)
    rows = [(k, "h" if k % 2 else f"c{k % 20}" if k % 8 else None, "00", k) for k in range(200)]
    coded = spark.createDataFrame(rows, "vec_id long, label string, code string, error long")
    want = Counter()
    for _, label, _, error in rows:
        want[label] += error
    got = grid_codes._with_label_error(coded).collect()
    assert len(got) == 200 and all(r.label_error == want[r.label] for r in got)


def brute_alignment(rows):
    """Tokens of whole texts by the libraries, byte ranges by decoded bytes, every pair of tokens of a text."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = alignment.byte_letters()
    names = {i: t for t, i in a.get_vocab().items()}

    def b_bytes(i):
        return bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    out, counts, best = [], Counter(), defaultdict(int)
    for doc_id, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        words_a, words_b = [bytes(letters[c] for c in names[i]) for i in ids_a], [b_bytes(i) for i in ids_b]
        if not (b"".join(words_a) == b"".join(words_b) == (" " + (text or "")).encode()):
            ids_a, ids_b, words_a, words_b = [], [], [], []
        ends_a, ends_b = np.cumsum([0, *map(len, words_a)]).tolist(), np.cumsum([0, *map(len, words_b)]).tolist()
        common, groups = sorted(set(ends_a[1:]) & set(ends_b[1:])), []
        for lo, hi in zip([0, *common], common):
            groups.append("|".join(",".join(str(i) for i, e in zip(ids, ends[1:]) if lo < e <= hi)
                                   for ids, ends in ((ids_a, ends_a), (ids_b, ends_b))))
        links = [(i, j) for i, s, e in zip(ids_a, ends_a, ends_a[1:])
                 for j, t, f in zip(ids_b, ends_b, ends_b[1:]) if s < f and t < e]
        counts.update(links)
        out.append((doc_id, ids_a, ids_b, groups, links))
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    return Counter((doc_id, len(x), len(y), len(groups), len(links), sum(counts[p] == best[p[1]] for p in links),
                    sum(counts[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if x else "")
                   for doc_id, x, y, groups, links in out)


@pytest.mark.parametrize("pairs_at_once", [1 << 22, 150])
def test_alignment(spark, docs, pairs_at_once):
    rows = [(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 4000]
    some = docs.where("coalesce(length(text), 0) < 4000")
    held = stored(queries_tokens.digested(alignment.align_documents(some)), "alignments")
    got = alignment.score_links(held, alignment.link_counts(held), pairs_at_once)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert set(got.columns) == set(names)
    assert Counter(map(tuple, got.select(names).collect())) == brute_alignment(rows)


def test_chunks_side_by_side_are_linked_as_alone():
    raw = []
    for path in (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")):
        with open(path, "rb") as file:
            raw.append(file.read())
    aligner, seen = alignment.Aligner(alignment.Bytes(raw[0]), alignment.Pieces(raw[1])), []
    words = list(dict.fromkeys(c for t in texts() if t for c in chunks(" " + t) if len(c) < 65))
    alone = [aligner._one(c.encode(), *aligner.a.cut([c])[0], *aligner.b.cut([c])[0]) for c in words]
    cut = aligner.a.cut
    aligner.a.cut = lambda given: seen.append(len(given)) or cut(given)
    assert aligner.chunks(words) == alone and b"" in alone
    assert sum(seen) < len(words) / 4


def test_even_spacing_is_cut_as_any_other():
    draw = random.Random(4)
    parts = ["a", "é", "1", "€5", "x\ny", "١", "\u0301q", "中", "", "\t", "\n", "\0", "\xa0b"]
    for _ in range(3000):
        text = " ".join(draw.choice(parts) for _ in range(draw.randint(1, 6)))
        cuts = [i for i, c in enumerate(text) if 0 < i < len(text) - 1 and c in " \n"
                and not (text[i - 1] == " " if c == " " else text[i - 1].isspace())
                and ("!" <= text[i + 1] <= "~" or text[i + 1].isalpha())]
        assert chunks(text) == [text[x:y] for x, y in zip([0, *cuts], [*cuts, len(text)])]


def test_alignment_of_long_and_no_texts(docs):
    long = alignment.align_documents(docs.where("length(text) > 100000")).collect()[0]
    pairs, times = alignment.link_arrays(long.links)
    groups = [g.split("|") for g in long.groups.split(";")]
    assert long.n_groups == len(groups) and times.sum() == long.n_links and (np.diff(pairs) > 0).all()
    assert sum(len(a.split(",")) for a, _ in groups) == long.n_a
    none = stored(queries_tokens.digested(alignment.align_documents(docs.limit(0))), "alignments")
    assert alignment.score_links(none, alignment.link_counts(none)).count() == 0


def test_queries_over_the_small_tables(spark, library):
    sf = "/root/testdata/sf0.001"
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op11_prefix_bpe"](spark, sf).collect():
        ids = library.encode_ordinary(rows[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(rows[r.doc_id].encode()).hexdigest()
    short = {i: t for i, t in rows.items() if len(t) < 1500}
    got = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256)
           for r in QUERIES["op13_token_spans"](spark, sf).collect()}
    assert set(got) == set(rows)
    want = {r[0]: (*r[1:5], r[7]) for r in brute_alignment(short.items())}
    assert {i: got[i] for i in short} == want
