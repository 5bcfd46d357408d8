import hashlib
import random

from millrace.operators import families as fam


def test_near_copies_share_a_family_and_a_split(spark):
    rng = random.Random(4)
    text = lambda n: [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
    rows = []
    for base in (text(300) for _ in range(12)):
        for _ in range(5):  # a chain: each a word or more from the one before
            rows.append(" ".join(base))
            for _ in range(rng.choice([0, 1, 3, 8])):
                base[rng.randrange(len(base))] = f"w{rng.randint(0, 10**6)}"
    rows += ["", None, None, "two words", "Two,  WORDS", "ACME one", "other one"]
    rng.shuffle(rows)
    carrier = lambda t: "Acme Ins. Co." if t == "ACME one" else "ACME  INS CO" if t == "other one" else None
    docs = spark.createDataFrame([(i, t, carrier(t)) for i, t in enumerate(rows)], "doc_id long, text string, carrier string")
    sigs = [fam.minhash(t) for t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    pairs = 0
    for i in range(len(rows)):
        for j in range(i):
            near = sigs[i] and sigs[j] and sum(x == y for x, y in zip(sigs[i], sigs[j], strict=True)) / 128 >= 0.85
            pairs += bool(near)
            if near or (rows[i] is not None and rows[i] == rows[j]) or {rows[i], rows[j]} == {"ACME one", "other one"}:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    want = {i: "grp-" + hashlib.sha256(str(find(i)).encode()).hexdigest()[:12] for i in range(len(rows))}
    group = lambda d: fam.assign_groups(d, identity=("carrier",))
    got = {r.doc_id: r for r in group(docs).collect()}
    assert pairs > 20 and {d: r.family for d, r in got.items()} == want
    assert all(r.members == list(want.values()).count(r.family) for r in got.values())
    split = fam.split_families(docs, group)
    assert fam.leakage(split, "family").count() == 0 and split.count() == len(rows)
    assert fam.minhash("a b c d e f")[0] == int.from_bytes(min(hashlib.sha256(b"0" + g).digest()[:8] for g in (b"a b c d e", b"b c d e f")), "big", signed=True)
