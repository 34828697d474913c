"""The pipeline's stages, each held against what its operator says of the stage's input, and on odd rows."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

pytest.importorskip("ledgerlode.llm.queries")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

import __spark_entry__ as entry  # noqa: E402

from ledgerlode.llm import decontaminate, mixing, ngrams, sharding  # noqa: E402
from ledgerlode.llm.registry import QUERIES, SQL  # noqa: E402
from ledgerlode.sources.files import stored  # noqa: E402

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
#: Queries without SQL, and the test that holds each against a brute-force version or held-out labels.
BRUTE_FORCE = {
    "op1_ngram_join": "test_ngram_components", "op3_recompression": "test_repeats", "op4_cross_polytope":
    "test_vectors_components_labels_and_lengths", "op5_wu_manber": "test_contamination", "op7_subword_quality":
    "test_quality_held_out", "op8_secret_automaton": "test_secret_rows", "op9_hash_tree_shards": "test_shards",
    "op10_suffix_array": "test_repeats", "op11_prefix_bpe": "test_byte_pairs", "op13_token_spans": "test_alignment",
}


def test_every_operator_has_sql_or_a_brute_force_test():
    assert set(QUERIES) == set(SQL) | set(BRUTE_FORCE) and not set(SQL) & set(BRUTE_FORCE)
    text = "".join((entry.HERE / "tests" / "llm" / f"test_{n}.py").read_text() for n in ("operators", "tokens"))
    assert all(re.search(rf"^def {t}\(", text, re.M) for t in BRUTE_FORCE.values())
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_operator_agrees_with_sql(spark, duck, name):
    import compare
    problem, n = compare.difference(spark, duck, name, SF)
    assert problem is None and n > 0


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, before = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before.append(docs)
        docs = stored(stage(spark, docs, SF), "stage")
        if name != "sharding":
            assert docs.columns == names
    kept = {r.doc_id for r in ngrams.ngram_components(before[1]).where("doc_id = component_id").collect()}
    assert {r.doc_id for r in before[2].collect()} == kept
    hit = decontaminate.find_contamination(before[2], spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert {r.doc_id for r in before[3].collect()} == {r.doc_id for r in hit.where("NOT contaminated").collect()}
    copies = Counter(r.doc_id for r in before[4].collect())
    mixed = mixing.mix(before[3], spark.read.parquet(f"{SF}/labels.parquet")).where("copies > 0").collect()
    assert copies == Counter({r.doc_id: r.copies for r in mixed})
    placed = sharding.shard_documents(before[4], shards=8)
    columns = ["doc_id", "shard", "size", "text_crc32", "grown_shard"]
    assert Counter(map(tuple, docs.select(columns).collect())) == Counter(map(tuple, placed.select(columns).collect()))
    assert docs.count() == before[4].count() > 0


@pytest.fixture(scope="module")
def odd(spark):
    draw = random.Random(1)
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(draw.choices(words, k=draw.randint(1, 40))) for _ in range(30)]
    rows = [(draw.choice([1, 2, 3, None]), t, "en", draw.choice(["a", "b", None]), len(t)) for t in texts]
    rows += [(7, texts[0], "en", "a", 1)] * 3 + [(None, None, None, None, None)] * 2 + [(8, "", "en", "b", 0)]
    rows += [(9, " ".join(draw.choices(words, k=20_000)), "fr", "c", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_mixing_counts_each_row_by_itself(spark, odd):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    wanted = mixing.mix(odd, labels).agg({"copies": "sum"}).first()[0]
    out = STAGES["mixing to target weights"](spark, odd, SF)
    assert out.columns == odd.columns and out.count() == wanted > 0
    words = lambda df: Counter(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in df.collect())
    mixed = Counter()
    for r in mixing.mix(odd, labels).collect():
        mixed[r["size"]] += r.copies
    assert words(out) == +mixed


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows_and_none(spark, odd, name):
    out = stored(STAGES[name](spark, odd, SF), "odd")
    n = out.count()
    assert 0 < n and (name == "mixing to target weights" or n <= odd.count())
    if name == "sharding":
        assert n == odd.count() and {r.shard for r in out.collect()} <= set(range(8))
    else:
        assert out.columns == odd.columns
        assert {(r.doc_id, r.text) for r in out.collect()} <= {(r.doc_id, r.text) for r in odd.collect()}
    assert STAGES[name](spark, odd.limit(0), SF).count() == 0
