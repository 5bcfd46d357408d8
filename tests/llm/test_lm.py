import random

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import lm
from tests.llm.conftest import SF, make


def test_step_follows_the_gradient_and_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    net = lm.Network(dim=4)
    around, target = rng.integers(0, lm.SIZE + 1, (4, 50)).astype(np.int16), rng.integers(0, lm.SIZE, 50).astype(np.int16)
    every = net.log_probabilities(np.repeat(around[:, :1], lm.SIZE, axis=1), np.arange(lm.SIZE, dtype=np.int16))
    assert abs(np.exp(every).sum() - 1) < 1e-4
    before = net.log_probabilities(around, target).mean()
    memory = [np.zeros_like(p) for p in net.parts]
    for _ in range(60):
        net.step(around, target, memory, 0.05)
    assert net.log_probabilities(around, target).mean() > before + 1


def test_windows_stop_at_the_text_edge():
    around, target = lm.windows([np.array([1, 2, 3], np.int32), np.array([], np.int32), np.array([4], np.int32)])
    e = lm.SIZE
    assert target.tolist() == [1, 2, 3, 4]
    assert around.T.tolist() == [[e, e, 2, 3], [e, 1, 3, e], [1, 2, e, e], [e, e, e, e]]


def brute_score(net, vocabulary, text):
    """Word by word, with plain dictionaries and loops."""
    codes, starts, ends = lm.word_codes(text)
    known = {c: (leaf, share) for c, leaf, share in zip(*(x.tolist() for x in vocabulary.arrays), strict=True)}
    found = [known.get(c, (lm.SPELT, 0.0)) for c in codes.tolist()]
    pairs = net.spelling.reshape(257, 257) + 1
    pairs[256, 256] = 0
    pairs = pairs / pairs.sum(axis=1, keepdims=True)
    total = 0.0
    for i, (leaf, share) in enumerate(found):
        around = [found[i + o][0] if 0 <= i + o < len(found) else lm.SIZE for o in lm.OFFSETS]
        h = np.tanh(sum(net.parts[0][k][around[k]].astype(float) for k in range(4)))
        z, c = net.parts[1] @ h + net.parts[2], leaf // lm.SIDE
        y = net.parts[3][c] @ h + net.parts[4][c]
        total += z[c] - np.log(np.exp(z).sum()) + y[leaf % lm.SIDE] - np.log(np.exp(y).sum()) + share
        if leaf == lm.SPELT:
            word = [256, *text.encode()[starts[i] : ends[i]].lower(), 256]
            total += sum(np.log(pairs[x, y]) for x, y in zip(word, word[1:]))
    return total


def test_op10_scores_all_documents_and_order_matters(spark, texts, odd, odd_rows, empty, monkeypatch):
    got = {r.doc_id: r for r in lm.op10_pseudo_likelihood(spark, SF).collect()}
    assert len(got) == len(texts) and all(r.log_likelihood <= 0 for r in got.values())
    rng = random.Random(2)
    grammar = [["the", "old", "cat", "sat", "down"], ["a", "young", "dog", "ran", "off"], ["some", "red", "bird", "flew", "up"]]
    rows = [(i, " ".join(w for _ in range(60) for w in rng.choice(grammar))) for i in range(300)]
    docs = make(spark, rows).select("doc_id", "text")
    vocabulary = lm.Vocabulary.of(lm.word_counts(docs))
    net = lm.train(docs, vocabulary, rounds=2)
    shuffled = [(1000 + i, " ".join(rng.sample(t.split(), len(t.split())))) for i, t in rows[:50]]
    scored = {r.doc_id: r for r in lm.score(make(spark, rows[:50] + shuffled).select("doc_id", "text"), net, vocabulary).collect()}
    assert np.mean([scored[i].mean_log_likelihood for i in range(50)]) > np.mean([scored[1000 + i].mean_log_likelihood for i in range(50)]) + 0.5
    for i in (0, 7, 1003):
        text = dict(rows + shuffled)[i]
        assert abs(brute_score(net, vocabulary, text) - scored[i].log_likelihood) < 0.05
    # the whole table against the plain version
    monkeypatch.setattr(lm, "LEAST", 2)
    table = spark.createDataFrame(texts, "doc_id long, text string")
    vocabulary = lm.Vocabulary.of(lm.word_counts(table))
    net = lm.train(table, vocabulary)
    assert (vocabulary.leaves >= lm.HEAD).any()
    whole = {r.doc_id: r.log_likelihood for r in lm.score(table, net, vocabulary).collect()}
    for i, text in texts:
        want = brute_score(net, vocabulary, text or "")
        assert abs(want - whole[i]) < 0.01 + 1e-5 * abs(want)
    odd_scores = lm.pseudo_likelihood(odd).collect()
    assert len(odd_scores) == len(odd_rows)
    assert all((r.n_words == 0) == (r.mean_log_likelihood is None) for r in odd_scores)
    assert lm.pseudo_likelihood(empty).count() == 0


def test_counts_cover_all_words(spark, texts):
    docs = make(spark, texts)
    assert lm.word_counts(docs.select("doc_id", "text")).groupBy().sum("n").first()[0] == sum(len(lm.word_codes(t)[0]) for _, t in texts)


def test_every_word_is_a_target(spark):
    docs = make(spark, [(i, "north east south west " * 3000) for i in range(24)]).select("doc_id", "text")
    vocabulary = lm.Vocabulary.of(lm.word_counts(docs))
    net = lm.train(docs, vocabulary, batch=512)
    ids = vocabulary.find(lm.word_codes("north east south west " * 5)[0])[0]
    around, target = lm.windows([ids])
    assert (net.log_probabilities(around, target)[4:12] > -2).all()


def test_scores_do_not_depend_on_partitions(spark, texts):
    rows = spark.createDataFrame(texts, "doc_id long, text string")
    found = []
    for parts in (1, 7):
        dealt = rows.orderBy(F.rand(parts)).repartition(parts)
        vocabulary = lm.Vocabulary.of(lm.word_counts(dealt))
        net = lm.train(dealt, vocabulary, shard_bytes=1 << 14)
        found.append({r.doc_id: r.log_likelihood for r in lm.score(dealt, net, vocabulary).collect()})
    # equal up to the order of float sums within a batch
    assert found[0].keys() == found[1].keys() and all(abs(x - found[1][d]) < 0.002 for d, x in found[0].items())


def test_counted_words_share_leaves_by_their_counts_and_rare_words_are_spelt(spark):
    rng = random.Random(3)
    words = list(dict.fromkeys("".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(2500)))
    rows = [(i, " ".join(rng.sample(words, len(words)) + words[: 40 * i])) for i in range(lm.LEAST)] + [(1000 + i, f"rareword{i} other{i}") for i in range(300)]
    docs = make(spark, rows).select("doc_id", "text")
    vocabulary = lm.Vocabulary.of(lm.word_counts(docs))
    leaves, shares = vocabulary.find(lm.word_codes(" ".join(words))[0])
    assert lm.SPELT not in leaves and len(vocabulary.codes) == len(words)
    sums = np.bincount(leaves, np.exp(shares.astype(float)), lm.SIZE)
    assert np.allclose(sums[: lm.SPELT], 1, atol=1e-4) and sums[lm.SPELT] == 0
    net = lm.train(docs, vocabulary)
    scored = {r.doc_id: r.log_likelihood for r in lm.score(make(spark, [(1, "rareword7"), (2, "xqzjkvwy7"), (3, None)]).select("doc_id", "text"), net, vocabulary).collect()}
    assert scored[1] > scored[2] + 10 and scored[3] == 0
