import random
from collections import Counter

from millrace.operators import families as fam


def test_steps_hold_every_place_once():
    for permutations, bands in ((128, 20), (16, 4), (8, 8), (5, 1)):
        steps = fam.band_steps(permutations, bands)
        assert sorted(i for step in steps for band in step for i in band) == list(range(permutations)) and all(len(s) == bands for s in steps)


def test_texts_that_link_with_none_are_not_hashed_to_the_end(spark, tmp_path, monkeypatch):
    rng = random.Random(11)
    words = lambda n: [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
    rows = [" ".join(words(80)) for _ in range(60)]  # alike to none
    for base in (words(200) for _ in range(15)):
        for _ in range(4):
            rows.append(" ".join(base))
            base[rng.randrange(200)] = "changed"
    common = " ".join(words(12))
    rows += [" ".join(words(60)) + " " + common for _ in range(20)] + [rows[0]] * 3 + ["", None, None, "x", "x"]
    places = tmp_path / "places"
    plain = fam.minhash

    def counting(text, permutations=128, which=None):
        with places.open("a") as f:
            f.write(f"{permutations if which is None else len(which)}\n")
        return plain(text, permutations, which)

    monkeypatch.setattr(fam, "minhash", counting)
    got = fam.near_dup_pairs(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()
    sigs = [plain(t) for t in rows]
    near = {(i, j): sum(x == y for x, y in zip(sigs[i], sigs[j], strict=True)) / 128 for j in range(len(rows)) for i in range(j) if sigs[i] and sigs[j]}
    least = {i: min(j for j in range(len(rows)) if sigs[j] == sigs[i]) for i in range(len(rows)) if sigs[i]}
    want = {(i, j) for (i, j), share in near.items() if share >= 0.85 and (i, j) == (least[i], least[j])} | {(least[j], j) for j in least if least[j] != j}
    assert Counter((r.a, r.b) for r in got) == Counter(want) and len(want) > 50
    hashed = [int(n) for n in places.read_text().split()]
    assert sum(hashed) < 0.75 * 128 * len({t for t in rows if t is not None})
