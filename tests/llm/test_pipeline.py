import random
import sys
import tracemalloc

import numpy as np
import pyarrow as pa

import corpus_pipeline
from millrace.llm import jaccard
from millrace.llm.shared import materialize, per_process
from tests.llm.conftest import SF, make
from tests.llm.test_jaccard import brute as brute_classes
from tests.llm.test_native import measures
from tests.llm.test_suffixes import brute as brute_repeats
from tests.llm.test_suffixes import words_of


def test_stages_equal_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    first = materialize(steps["quality_rules"](spark, docs, SF), "first")
    kept = [(r.doc_id, r.text) for r in first.collect()]
    assert first.columns == docs.columns and set(kept) <= set(rows)
    for d, t in set(rows) - set(kept):
        n, chars, symbols, dup, again = measures(t)
        lines = len([x for x in t.split("\n") if x.strip(" \t-\r")])
        assert n < 50 or 100 * again > 50 * n or 10 * symbols > n or 100 * dup > 30 * lines or not 2 * n <= chars <= 20 * n or 100 * sum(c.isalpha() for c in t) < 50 * chars
    second = materialize(steps["near_duplicates"](spark, first, SF), "second")
    left = [(r.doc_id, r.text) for r in second.collect()]
    assert sorted(d for d, _ in left) == sorted(d for d, _, c in brute_classes(kept, 5, 80) if d == c)
    third = materialize(steps["repeated_passages"](spark, second, SF), "third")
    cut = {r.doc_id: r.text for r in third.collect()}
    assert third.columns == docs.columns
    repeated = brute_repeats(left, 50)
    for d, t in left:
        if d not in repeated:
            assert cut[d] == t
        else:
            assert set(words_of(cut.get(d, ""))) <= set(words_of(t))
    assert not brute_repeats(list(cut.items()), 50)
    pieces = steps["packing"](spark, third, SF).collect()
    assert {p.doc_id for p in pieces} == set(cut)


def test_one_of_each_with_nulls_and_repeated_rows(spark, odd, odd_rows, empty):
    got = sorted(((r.doc_id, r.text) for r in jaccard.one_of_each(odd).collect()), key=str)
    same = next(t for d, t in odd_rows if d == 5)
    want = sorted({(d, t) for d, t in odd_rows if (d, t) != (6, same)}, key=str)
    assert got == want
    assert jaccard.one_of_each(empty).count() == 0
    rng = random.Random(5)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(100)]
    rows = [(10, " ".join(base)), (3, " ".join(base[:99] + ["x"])), (None, " ".join(["y"] + base[1:])), (4, "other words entirely")]
    assert sorted(r.doc_id for r in jaccard.one_of_each(make(spark, rows)).collect()) == [3, 4]


def test_run_applies_the_stages(spark, tmp_path):
    text = " ".join(f"word{i}" for i in range(120))
    make(spark, [(1, text), (2, text), (3, "short"), (4, " ".join(f"own{i}" for i in range(70)))]).write.parquet(str(tmp_path / "documents.parquet"))
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(p.doc_id for p in pieces) == [1, 4] and len({p.sequence_id for p in pieces}) == 1


def test_stages_on_odd_and_empty_tables(spark, odd_rows, empty):
    text = " ".join(f"word{i}" for i in range(120))
    rows = [*odd_rows, (20, text), (21, text + " more"), (None, text), (20, text), (22, " ".join(f"own{i}" for i in range(70)) + " " + text[:600])]
    for docs, some in ((make(spark, rows), True), (empty, False)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, SF), name)
            assert docs.columns == columns or name == corpus_pipeline.STAGES[-1][0]
            assert (docs.count() > 0) == some
            if name == "near_duplicates" and some:
                kept = sorted(r.doc_id for r in docs.collect())
                assert 20 in kept and 21 not in kept and None not in kept and kept.count(20) == 1
            if name == "repeated_passages" and some:
                assert {r.doc_id: r.text.split()[0] for r in docs.collect()}[22] == "own0" and all(r.lang == "x" for r in docs.collect())
        if some:
            assert {r.doc_id for r in docs.collect()} >= {20, 22}


def test_repeats_of_a_task_are_counted_in_little_more_than_its_tokens_twice():
    rng = np.random.default_rng(3)
    held = [np.unique(rng.integers(0, 400_000, 20_000, dtype=np.uint64) << np.uint64(30)) for _ in range(40)] + [np.array([5, 2**64 - 1], np.uint64)] * 3
    tokens, counts = np.unique(np.concatenate(held), return_counts=True)
    want = np.zeros(jaccard.BUCKETS, np.int64)
    np.add.at(want, (tokens[counts > 2] % np.uint64(jaccard.BUCKETS)).astype(np.int64), counts[counts > 2])
    size = sum(x.nbytes for x in held)
    tracemalloc.start()
    bucket, number = jaccard._repeats(held)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    got = np.zeros(jaccard.BUCKETS, np.int64)
    got[bucket] = number
    assert (got == want).all() and len(set(bucket.tolist())) == len(bucket) and not held
    assert peak < 3 * size
    for few in ([np.zeros(0, np.uint64)], [np.array([1], np.uint64)], [np.array([1], np.uint64)] * 2):
        assert [len(x) for x in jaccard._repeats(few)] == [0, 0]


def test_near_duplicates_free_what_packing_keeps_in_the_workers(spark):
    def fill(batches):
        for batch in batches:
            per_process(("word ids", "of a test"), lambda: ["kept"])
            yield batch

    def kept(batches):
        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": [sum(k[0] == "word ids" for k in sys.__dict__.get("_millrace_kept", {}))]})

    rows = spark.range(64).repartition(16)
    assert rows.mapInArrow(fill, "id long").count() == 64
    docs = make(spark, [(i, f"a text of its own number {i} and {i * i}") for i in range(64)]).repartition(16)
    assert jaccard.one_of_each(docs).count() == 64
    assert {r.n for r in rows.mapInArrow(kept, "n long").collect()} == {0}
