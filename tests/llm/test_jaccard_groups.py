import numpy as np

from millrace.llm import jaccard


def test_fine_sketches_never_differ_in_more_bits_than_sets_in_tokens():
    rng = np.random.default_rng(8)
    for n in (1, 40, 600, 5000):
        tokens = rng.integers(0, 2**64, n, dtype=np.uint64)
        for changed in (0, 1, 7, n // 3):
            other = np.concatenate([tokens[changed:], rng.integers(0, 2**64, changed, dtype=np.uint64)])
            x, y = (np.frombuffer(jaccard._fine(t), np.int64) for t in (tokens, other))
            assert jaccard._apart(x, y) <= len(np.setxor1d(tokens, other))


def test_copies_just_below_the_similarity_are_dropped_where_they_meet():
    rng = np.random.default_rng(9)
    base = rng.integers(0, 2**64, 150, dtype=np.uint64)
    sets = [np.concatenate([rng.permutation(base)[:k], rng.integers(0, 2**64, 150 - k, dtype=np.uint64)]) for k in rng.integers(136, 142, 300)]
    sketch = np.array([jaccard._sketch(s) for s in sets])
    fine = np.array([np.frombuffer(jaccard._fine(s), np.int64) for s in sets])
    one = lambda x: np.full(300, x)
    entries = jaccard._Entries([one(1), np.arange(300), one(150), one(0), np.arange(300), one(1), one(2), *sketch.T], 80, fine)
    got = {p for a, b, *_ in entries.found() for p in zip(a.tolist(), b.tolist(), strict=True)}
    apart = {(i, j): len(np.setxor1d(sets[i], sets[j])) for j in range(300) for i in range(j)}
    links = {p for p, d in apart.items() if d * 180 <= 20 * 300}
    assert links <= got and len(got - links) < len(apart) / 10 and len(links) < len(apart) / 2
