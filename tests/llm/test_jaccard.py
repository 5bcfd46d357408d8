import random
import re

import numpy as np
import pytest

from millrace.llm import jaccard
from tests.llm.conftest import SF, make

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(rows, width, percent):
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in holders[x] if j < i}:
            same = len(s & sets[j])
            if 100 * same >= percent * (len(s) + len(sets[j]) - same):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return sorted(((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)), key=str)


def test_op7_equals_brute_force(spark, texts):
    got = sorted(map(tuple, jaccard.op7_ngram_jaccard(spark, SF).collect()), key=str)
    assert got == brute(texts, 4, 85)
    assert any(d != c for d, _, c in got)


def test_odd_rows(spark, odd, odd_rows, empty):
    got = sorted(map(tuple, jaccard.classes(odd).collect()), key=str)
    assert got == brute(odd_rows, 5, 80)
    assert jaccard.classes(empty).count() == 0


@pytest.mark.parametrize("sizes", [None, {"BLOCK": 8, "SHORT": 4, "SHARE": 20, "LONG": 3, "HELD": 500}])
def test_chains_cliques_and_common_passages(spark, monkeypatch, sizes):
    for name, value in (sizes or {}).items():
        monkeypatch.setattr(jaccard, name, value)
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = []
    add = lambda words: rows.append((1000 + 7 * len(rows) % 997 + 1000 * len(rows), " ".join(words)))
    for _ in range(6):  # chains: neighbours link, ends do not
        words = [word() for _ in range(120)]
        for _ in range(9):
            add(words)
            words = list(words)
            words[rng.randrange(120)] = word()
            words[rng.randrange(120)] = word()
    clique = [word() for _ in range(200)]
    for _ in range(80):
        own = list(clique)
        own[rng.randrange(200)] = word()
        add(own)
    passage = [word() for _ in range(60)]
    for _ in range(80):  # a passage that many share, without links
        add([word() for _ in range(40)] + passage + [word() for _ in range(rng.randint(5, 60))])
    for n in (1, 2, 3, 3, 4, 5, 6):
        add(["tiny"] * n)
        add(["tiny"] * n)
    rng.shuffle(rows)
    for width, percent in ((4, 85), (2, 60)) if sizes is None else ((5, 80),):
        assert sorted(map(tuple, jaccard.classes(make(spark, rows), width, percent).collect()), key=str) == brute(rows, width, percent)


def test_sketches_never_differ_in_more_bits_than_sets_in_tokens():
    rng = np.random.default_rng(5)
    for n in (1, 40, 600, 5000):
        tokens = rng.integers(0, 2**64, n, dtype=np.uint64)
        for changed in (0, 1, 7, n // 3):
            other = np.concatenate([tokens[changed:], rng.integers(0, 2**64, changed, dtype=np.uint64)])
            apart = jaccard._apart(np.array([jaccard._sketch(tokens)]), np.array(jaccard._sketch(other)))
            assert apart[0] <= len(np.setxor1d(tokens, other))


def test_blocks_give_the_pairs_that_may_link():
    rng = np.random.default_rng(6)
    n = np.sort(rng.integers(20, 90, 900))
    cols = [rng.integers(0, 3, 900), np.arange(900), n, rng.integers(0, 20, 900), rng.integers(0, 40, 900), np.ones(900, np.int64), rng.choice([0, 1, 2], 900), *(np.zeros(900, np.int64) for _ in range(4))]
    cols[3] = np.minimum(cols[3], n - 1)
    order = np.lexsort((cols[3], np.floor(np.log(n) * 50), cols[0]))
    entries = jaccard._Entries([c[order] for c in cols], 80)
    got = {(min(i, j), max(i, j)) for x, y in entries.pairs() for i, j in zip(x.tolist(), y.tolist(), strict=True)}
    i, j = np.triu_indices(900, 1)
    i, j = i[entries.unit[i] == entries.unit[j]], j[entries.unit[i] == entries.unit[j]]
    ok = entries.may(i, j)
    assert got == set(zip(i[ok].tolist(), j[ok].tolist(), strict=True)) and 0 < ok.sum() < len(ok)
