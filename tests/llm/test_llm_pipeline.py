"""The pipeline's stages against brute force on the smallest tables."""

from collections import Counter, defaultdict

import public_tokenizers
import pytest

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.test_llm_duplicates import reachable, wide_shingles, without_repeats
from tests.llm.test_llm_texts import base_spans, check_packing
from tidemark.llm import counting, packing, rules, secrets
from tidemark.plans import durable, written

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def stages(spark):
    """[(input rows, output rows)] of each stage."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, out = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        result = durable(stage(spark, docs, SMALL))
        if k < 4:
            assert result.columns == columns and result.dtypes == docs.dtypes
        out.append((docs.collect(), result.collect()))
        docs = result
    return out


def test_rejected_documents_go(spark, stages):
    before, after = stages[0]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    scored = rules.score_documents(docs, labels).where("predicted = 1").collect()
    assert {r.doc_id for r in after} == {r.doc_id for r in scored}
    assert set(after) <= set(before) and len(after) < len(before)
    # nearly all documents labelled good stay
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    assert len(good & {r.doc_id for r in after}) >= 0.95 * len(good)


def test_repeated_passages_go(stages):
    before, after = stages[1]
    want = without_repeats((r.doc_id, r.text) for r in before)
    left = {i: text for i, (n, text) in want.items() if not n or text.strip(" \t\n\v\f\r")}
    assert {r.doc_id: r.text for r in after} == left
    assert all(r.n_chars == len(r.text) for r in after)


def test_one_of_each_group_stays(stages):
    before, after = stages[2]
    # a stage on word shingles: five words, a similarity of 0.8 or more
    sets = {r.doc_id: wide_shingles(r.text, 5) for r in before}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    group = reachable(sets, links)
    assert {r.doc_id for r in after} == {i for i in sets if group[i] == i}
    assert set(after) <= set(before)


def test_secrets_are_covered(stages):
    before, after = stages[3]
    new = {r.doc_id: r.text for r in after}
    assert new.keys() == {r.doc_id for r in before}
    for r in before:
        if base_spans(r.text):
            assert secrets.MARK in new[r.doc_id] and base_spans(new[r.doc_id]) == ""
        else:
            assert new[r.doc_id] == r.text


def test_all_tokens_are_packed(stages):
    before, after = stages[4]
    want = {r.doc_id: counting.count(RANKS, r.text) + 1 for r in before}
    check_packing(after, packing.LENGTHS, want)


def test_run_gives_the_last_stages_rows(spark, stages):
    mine, before = durable(spark.range(3)), set(written())
    result = corpus_pipeline.run(spark, SMALL)
    # the last stage reads the one before and what it has written itself
    assert len(set(written()) - before) <= 3 and mine.count() == 3
    got = result.collect()
    pieces = Counter((r.doc_id, r.piece, r.length) for r in got)
    assert pieces == Counter((r.doc_id, r.piece, r.length) for r in stages[4][1])


def test_stages_take_odd_rows(spark, odd):
    docs = odd
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        result = durable(stage(spark, docs, SMALL))
        empty = stage(spark, docs.limit(0), SMALL)
        assert empty.collect() == []
        if k < 4:
            assert result.columns == odd.columns
        docs = result
    lengths = defaultdict(int)
    for r in docs.collect():
        lengths[r.doc_id] += r.length
    assert sum(lengths.values()) > 0
