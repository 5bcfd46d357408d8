import hashlib
import random

from millrace.operators import families as fam
from millrace.operators import shingles


def test_minima_are_those_of_each_salted_digest():
    text = "Ünlike  words, İn KelvinK ſtraße; a b c d e f"
    grams = shingles.cut(shingles.normal(text), *shingles.windows(shingles.normal(text)))
    want = [int.from_bytes(min(hashlib.sha256(str(i).encode() + g).digest() for g in grams)[:8], "big", signed=True) for i in range(128)]
    assert fam.minhash(text) == want and fam.minhash(text, 128, [5, 77]) == [want[5], want[77]]
    assert fam.minhash("one two") == fam.minhash("ONE-two ") != [] and fam.minhash(" ?") == fam.minhash(None) == []


def test_few_shared_shingles_are_ruled_out_and_many_are_not():
    grams = [b"g%d" % i for i in range(100)]
    least = [min(grams, key=lambda g, i=i: hashlib.sha256(b"%d" % i + g).digest()) for i in range(128)]
    for n in (0, 5, 30, 65, 90, 100):
        both, own = set(grams[:n]), set(grams[n:])
        if sum(g in own for g in least) <= 19:
            assert shingles.may_agree(both, own, 128, 19)
        elif n < 70:
            assert not shingles.may_agree(both, own, 128, 19)


def test_texts_that_share_a_passage_are_not_signed(spark, tmp_path, monkeypatch):
    rng = random.Random(5)
    words = lambda n: [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
    passage, base = " ".join(words(25)), words(300)
    rows = [" ".join(words(100)) + " " + passage for _ in range(40)] + [" ".join(base), " ".join([*base[:299], "other"]), "?", "?", None]
    rows += [rows[0], " ".join(base)]
    log, plain = tmp_path / "log", fam.minhash

    def counting(text, permutations=128, which=None):
        with log.open("a") as f:
            f.write(f"{rows.index(text)}\n")
        return plain(text, permutations, which)

    monkeypatch.setattr(fam, "minhash", counting)
    got = fam.near_dup_pairs(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()
    assert sorted((r.a, r.b) for r in got) == [(0, 45), (40, 41), (40, 46)]
    assert {int(i) for i in log.read_text().split()} == {40, 41}
