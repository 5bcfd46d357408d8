import random
import re
from collections import defaultdict

import numpy as np
import pytest

from millrace.llm import suffixes
from millrace.llm.codes import gram_codes, shingle_set, word_codes
from tests.llm.conftest import SF, make

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(rows, least):
    """Positions of words in windows of ``least`` words that stand in another document (another doc_id) too."""
    holders = defaultdict(set)
    for d, t in rows:
        w = words_of(t)
        for i in range(len(w) - least + 1):
            holders[tuple(w[i : i + least])].add(d)
    found = {}
    for d, t in rows:
        w, hit = words_of(t), set()
        for i in range(len(w) - least + 1):
            if len(holders[tuple(w[i : i + least])]) > 1:
                hit.update(range(i, i + least))
        if hit:
            found[d] = hit
    return found


def spread(spans):
    return {i for s in spans for i in range(s.start, s.stop)}


def test_codes_tell_words_apart():
    rng = random.Random(1)
    words = list({"".join(rng.choice("abcdeé日 ".strip()) for _ in range(rng.randint(1, 12))) for _ in range(20000)})
    codes, starts, ends = word_codes("  " + " \n".join(words) + "\t")
    assert len(codes) == len(words) == len(set(codes.tolist()))
    assert (word_codes("THE the\x0bThe")[0] == word_codes("the")[0][0]).all()
    assert len(word_codes(None)[0]) == len(word_codes(" \n")[0]) == 0
    assert (gram_codes(codes, 4)[5:] == gram_codes(codes[5:], 4)).all()
    assert len(shingle_set("a b a b a b", 2)) == 2 and len(shingle_set("a", 4)) == 1


def test_copies_retain_a_common_place():
    rng = random.Random(3)
    for trial in range(60):
        passage = [rng.choice("abcdefghijklmnop") * 3 + str(rng.randint(0, 30)) for _ in range(50)]
        if trial % 3 == 0:
            passage = ["same"] * 50
        found = []
        for _ in range(2):
            before, after = ([f"x{rng.random()}" for _ in range(rng.randint(0, 90))] for _ in range(2))
            codes = word_codes(" ".join(before + passage + after))[0]
            at, keys = suffixes.retained(codes, 35)
            inside = (at >= len(before)) & (at + 16 <= len(before) + 50)
            found.append(set(keys[inside].tolist()))
        assert found[0] & found[1]


@pytest.mark.parametrize("few", [32, 1])
def test_planted_passages(spark, monkeypatch, few):
    monkeypatch.setattr(suffixes, "FEW", few)
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(6))
    rows, passages = [], [[word() for _ in range(n)] for n in (50, 51, 60, 75, 130, 300)]
    for i in range(120):
        parts = [[word() for _ in range(rng.randint(0, 120))]]
        if i % 3:
            p = rng.choice(passages)
            parts += [p, [word() for _ in range(rng.randint(0, 80))]]
        if i % 7 == 0:
            parts += [passages[2], passages[1]]
        if i % 5 == 0:
            parts += [passages[0][:49]]
        if i % 11 == 0:
            own = [word() for _ in range(60)]
            parts += [own, own]  # within one document: no repeat
        rows.append((i, rng.choice([" ", "\n", "  "]).join(w for part in parts for w in part)))
    rows += [(500, rows[3][1]), (501, rows[3][1]), (502, " ".join(["same"] * 200)), (503, "x " + " ".join(["same"] * 90))]
    want = brute(rows, 50)
    got = {r.doc_id: r for r in suffixes.document_repeats(make(spark, rows)).collect()}
    assert set(got) == set(want)
    for d in want:
        assert spread(got[d].spans) == want[d], d
        assert spread(got[d].cuts) <= want[d]
    left = {r.doc_id: r.text for r in suffixes.without_repeats(make(spark, rows)).select("doc_id", "text").collect()}
    assert 501 not in left
    after = brute([(d, t) for d, t in left.items()], 50)
    assert not after
    texts = [" ".join(words_of(t)) for t in left.values()]
    for p in passages:  # one holder keeps each passage
        assert sum(" ".join(p) in t for t in texts) == 1
    for d, t in rows:
        if d not in want:
            assert left[d] == t


def test_op5_on_documents(spark, texts):
    got = {r.doc_id: r for r in suffixes.op5_suffix_repeats(spark, SF).collect()}
    want = brute(texts, 50)
    assert set(got) == set(want)
    read = lambda spans: {i for s in filter(None, spans.split(",")) for i in range(*map(int, s.split("-")))}
    for d, r in got.items():
        assert r.n_repeated_words == len(read(r.spans)) and read(r.spans) == want[d] and r.n_later_words == len(read(r.cuts))
    assert {d: read(r.cuts) for d, r in got.items() if r.cuts} == held_earlier({d: words_of(t) for d, t in texts}, 50)


def test_odd_rows(spark, odd, odd_rows, empty):
    assert suffixes.document_repeats(odd).count() == 0
    again = make(spark, [*odd_rows, (70, next(t for d, t in odd_rows if d == 7)), (None, next(t for d, t in odd_rows if d == 7))])
    got = {r.doc_id: (len(spread(r.spans)), len(spread(r.cuts))) for r in suffixes.document_repeats(again).collect()}
    assert got == {7: (30000, 0), 70: (30000, 30000), None: (30000, 30000)}
    kept = suffixes.without_repeats(again)
    assert kept.columns == again.columns and kept.count() == len(odd_rows)
    assert suffixes.document_repeats(empty).count() == suffixes.without_repeats(empty).count() == 0
    assert np.all(np.array([r.n_chars for r in kept.collect()]) == 7)


def test_every_word_cut_has_an_earlier_holder(spark):
    rng = random.Random(23)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(6))
    some = lambda n: [word() for _ in range(n)]
    p, q = some(60), some(20)
    rows = [(1, some(30) + p + some(30)), (5, some(30) + p + q + some(30)), (9, some(30) + p + q + some(30))]
    x, y, z = some(30), some(35), some(40)  # 20 and 21, 21 and 22 share 65 and 75 words, 20 and 22 only 35
    rows += [(20, x + y + some(40)), (21, x + y + z + some(9)), (22, some(40) + y + z + some(9))]
    for i in range(80):  # chains of pieces of common passages, each with its own surroundings
        common = rng.choice([p, q + p, x + y + z, y + z])
        a = rng.randint(0, len(common) - 10)
        rows.append((100 + i, some(rng.randint(0, 40)) + common[a:] + common[: rng.randint(0, len(common))] + some(rng.randint(0, 40))))
    for i in range(1, 80):
        rows[-i] = (rows[-i][0], rows[-i][1] + rng.choice(rows[:-i])[1][rng.randint(0, 30) :])
    rng.shuffle(rows)
    text = dict(rows)
    got = {r.doc_id: r for r in suffixes.document_repeats(make(spark, [(d, " ".join(w)) for d, w in rows])).collect()}
    assert spread(got[9].cuts) == set(range(30, 110)) and spread(got[5].cuts) == set(range(30, 90)) and not got[1].cuts
    assert {d: spread(r.cuts) for d, r in got.items() if r.cuts} == held_earlier(text, 50)


def held_earlier(text, least):
    """Positions of words in windows of ``least`` words that a document of a smaller id holds too."""
    earlier, found = set(), {}
    for d in sorted(text):
        w, want = text[d], set()
        for i in range(len(w) - least + 1):
            if tuple(w[i : i + least]) in earlier:
                want.update(range(i, i + least))
        earlier |= {tuple(w[i : i + least]) for i in range(len(w) - least + 1)}
        if want:
            found[d] = want
    return found


@pytest.mark.parametrize("few", [32, 3])
def test_decoys_beside_a_pair_hide_nothing(spark, monkeypatch, few):
    monkeypatch.setattr(suffixes, "FEW", few)
    rng = random.Random(31)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(6))
    some = lambda n: [word() for _ in range(n)]
    rows = []
    for _ in range(12):
        passage = some(50)
        for _ in range(2):  # the pair shares all 50 words
            rows.append(some(rng.randint(20, 60)) + passage + some(rng.randint(20, 60)))
        for cut in (1, 2, 1, 3):  # the others 49 at most, to either side
            rows.append(some(40) + passage[cut:] + some(40))
            rows.append(some(40) + passage[:-cut] + some(40))
    rng.shuffle(rows)
    got = {r.doc_id: r for r in suffixes.document_repeats(make(spark, [(d, " ".join(w)) for d, w in enumerate(rows)])).collect()}
    want = brute([(d, " ".join(w)) for d, w in enumerate(rows)], 50)
    assert len(want) == 24 and {d: spread(r.spans) for d, r in got.items()} == want
    assert {d: spread(r.cuts) for d, r in got.items() if r.cuts} == held_earlier(dict(enumerate(rows)), 50)


def test_records_of_long_periods_retain_a_common_place(spark):
    rng = random.Random(29)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(6))
    rows, lost = [], 0
    for period in (*range(17, 34), 1, 2, 7, 15, 16):
        fixed = [word() for _ in range(min(period, 16))]
        if period > 16:  # the fixed words make the least window of nearly every record
            fixed = min(([word() for _ in range(16)] for _ in range(300)), key=lambda f: gram_codes(word_codes(" ".join(f))[0], 16)[0])
        record = lambda: fixed + [word() for _ in range(period - len(fixed))]  # noqa: E731, B023
        whole = [w for _ in range(300 // period) for w in record()]
        for _ in range(12 if period > 16 else 0):
            a, n = rng.randint(0, len(whole) - 90), rng.choice([50, 50, 51, 60, 80])
            places = []
            for text, at in ((whole, a), ([word() for _ in range(20)] + whole[a : a + n] + [word() for _ in range(20)], 20)):
                found = suffixes.retained(word_codes(" ".join(text))[0], 35)[0]
                places.append({p - at for p in found.tolist() if at <= p <= at + n - 16})
            lost += not places[0] & places[1]
        a = rng.randint(0, len(whole) - 90)
        rows += [(2 * period, " ".join(whole)), (2 * period + 1, " ".join([word() for _ in range(20)] + whole[a : a + 50] + [word() for _ in range(20)]))]
    assert not lost
    got = {r.doc_id: r for r in suffixes.document_repeats(make(spark, rows)).collect()}
    want = brute(rows, 50)
    assert {d: spread(r.spans) for d, r in got.items()} == want
    assert all(spread(r.cuts) == (want[d] if d % 2 else set()) for d, r in got.items())
    assert len(suffixes.retained(word_codes(" ".join(["same"] * 100_000))[0], 35)[0]) < 4000  # a constant stretch stays thin
