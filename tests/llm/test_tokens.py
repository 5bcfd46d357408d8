import hashlib
import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import bpe, packing, wavelet, wordids
from millrace.llm.wordids import default_path, word_ids
from tests.llm.conftest import SF


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_path())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def raw(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


ODD = st.text(alphabet=st.sampled_from("abtheinor  \n\t'.,!s12ÄßéİσςÉ\x1c\x85日本🙂<|endoftext|>"), max_size=60) | st.text(max_size=40)


@settings(max_examples=400, deadline=None)
@given(ODD)
def test_encoders_equal_the_library_on_any_text(text):
    library = Tokenizer.from_file(default_path()) if not hasattr(test_encoders_equal_the_library_on_any_text, "t") else test_encoders_equal_the_library_on_any_text.t
    test_encoders_equal_the_library_on_any_text.t = library
    want = ids_of(library, text)
    assert word_ids(default_path()).ids(text) == raw(want)
    got, decoded = bpe.codec(default_path()).both(text)
    assert got == raw(want)
    assert decoded == library.decode(want, skip_special_tokens=False) == bpe.codec(default_path()).decode(got)


@settings(max_examples=200, deadline=None)
@given(st.lists(ODD | st.none(), max_size=8), st.integers(1, 5))
def test_ids_of_a_column_equal_those_of_its_texts(texts, gathered):
    words = word_ids(default_path())
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(wordids, "GATHERED", gathered)
        for kind in (pa.string(), pa.large_string()):
            flat, sizes = words.column(pa.array([*texts, "cut off"], kind).slice(0, len(texts)), 2)
            own = [words.ids(x) + raw([2]) for x in texts]
            assert flat.tobytes() == b"".join(own) and sizes.tolist() == [len(x) // 4 for x in own]


def test_a_column_takes_each_distinct_word_once_where_caches_are_full(monkeypatch):
    monkeypatch.setattr(wordids, "WORDS", 0)
    monkeypatch.setattr(wordids, "STEMS", 0)
    words, asked = wordids.WordIds(default_path()), []
    stem = words.stem
    monkeypatch.setattr(words, "stem", lambda word: asked.append(word) or stem(word))
    flat, sizes = words.column(pa.array(["(Unseen) unseenly, it's", None, "unseenly,\n(Unseen)", "", "unseenly,"] * 50), 2)
    assert sorted(asked) == sorted(["(", "unseen", ")", "unseenly", ","]) and not words
    assert flat.tobytes() == (words.ids("(Unseen) unseenly, it's") + raw([2, 2]) + words.ids("unseenly,\n(Unseen)") + raw([2, 2]) + words.ids("unseenly,") + raw([2])) * 50
    assert sizes.sum() == len(flat)


def test_dynamic_programming_on_words_of_few_letters(library):
    rng, coder = random.Random(9), bpe.codec(default_path())
    for _ in range(3000):
        word = "".join(rng.choice("aehinorst") for _ in range(rng.randint(1, 50)))
        assert coder.encode(word) == raw(ids_of(library, word))


def test_wavelet_matrix_answers_like_a_list():
    rng = np.random.default_rng(5)
    for ids in (rng.integers(0, 49408, 5000), rng.integers(0, 3, 1500), np.zeros(700, int), np.array([], int), np.array([49407])):
        matrix = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(ids).to_bytes())
        assert (matrix.decode() == ids).all()
        for at in list(rng.integers(0, len(ids), 60)) if len(ids) else []:
            assert matrix.access(int(at)) == ids[at]
        for value in [0, 1, 2, 7, 49407, 1 << 20, *map(int, ids[:20])]:
            found = np.flatnonzero(ids == value).tolist()
            assert matrix.count(value) == len(found)
            assert matrix.positions(value) == found
            assert matrix.rank(value, len(ids) // 2) == sum(x < len(ids) // 2 for x in found)
    with pytest.raises(IndexError):
        wavelet.WaveletMatrix.build(np.array([1, 2])).select(1, 1)


def test_wavelet_queries_open_only_their_chunks():
    ids = np.random.default_rng(6).integers(0, 50_000, 400_000)
    data = wavelet.WaveletMatrix.build(ids).to_bytes()
    matrix = wavelet.WaveletMatrix.from_bytes(data)
    assert all(not p.open for p in matrix.planes)
    assert matrix.access(123_456) == ids[123_456]
    assert all(len(p.open) <= 2 for p in matrix.planes)
    value, at = int(ids[7]), np.flatnonzero(ids == ids[7])
    matrix = wavelet.WaveletMatrix.from_bytes(data)
    assert matrix.count(value) == len(at) and matrix.select(value, len(at) - 1) == at[-1] and matrix.rank(value, 200_000) == (at < 200_000).sum()
    assert all(len(p.open) <= 6 < len(p.ends) for p in matrix.planes)
    starts = np.sort(np.random.default_rng(7).integers(0, len(ids) - 600, 50))
    assert matrix.first_counts(starts, starts + 500).tolist() == [int((ids[a : a + 500] == ids[a]).sum()) for a in starts]
    assert len(data) < 4 * len(ids)


def test_first_counts_open_only_their_chunks():
    ids = np.random.default_rng(8).integers(0, 50_000, 6 * wavelet.CHUNK) % 90
    matrix = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(ids).to_bytes())
    starts, ends = np.array([0, 5, 700, 700]), np.array([1, 600, 700, 1500])
    assert matrix.first_counts(starts, ends).tolist() == [int((ids[a:b] == ids[a]).sum()) for a, b in zip(starts, ends)]
    assert all(len(p.open) < len(p.ends) for p in matrix.planes[:2]) and len(matrix.planes[0].open) == 1
    starts = np.array([0, 3 * wavelet.CHUNK, len(ids) - 1, len(ids) - wavelet.CHUNK])
    assert matrix.first_counts(starts, np.full(4, len(ids))).tolist() == [int((ids[a:] == ids[a]).sum()) for a in starts]


@pytest.mark.parametrize("high", [1, 2, 1 << 16, (1 << 16) + 1, 1 << 20, 1 << 32])
def test_wavelet_matrix_of_narrow_and_wide_symbols(high):
    ids = np.random.default_rng(high % 97).integers(0, high, 3000)
    ids[-1] = high - 1
    matrix = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(ids).to_bytes())
    assert matrix.depth == max(1, (high - 1).bit_length())
    assert (matrix.decode() == ids).all() and matrix.access(2999) == high - 1 and matrix.count(high - 1) == (ids == high - 1).sum()


def brute_tokens(library, rows):
    out, start = [], 0
    for doc, text in rows:
        ids = [*ids_of(library, text), 2]
        out.append((doc, start, len(ids), zlib.crc32(raw(ids)), ids.count(ids[0])))
        start += len(ids)
    return out


def test_op2_equals_brute_force(spark, library, texts):
    got = sorted(map(tuple, wavelet.op2_wavelet_tokens(spark, SF).collect()))
    assert got == brute_tokens(library, sorted(texts))


def test_op2_several_files_nulls_and_repeats(spark, library, odd, odd_rows, empty):
    files = wavelet.write_shards(odd, default_path(), 2, shard_text_bytes=50_000, shard_tokens=40)
    assert files.count() > 3
    got = wavelet.read_back(files).collect()
    assert len(got) == len(odd_rows)
    assert sorted((r.n_tokens, r.ids_crc32, r.first_id_count) for r in got) == sorted(x[2:] for x in brute_tokens(library, odd_rows))
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, 1, 2, 3, 4, 5, 5, 6, 7, 8]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))
    assert wavelet.read_back(wavelet.write_shards(empty, default_path(), 2)).count() == 0


def check_pieces(library, rows, pieces, capacity):
    want = defaultdict(list)
    for doc, text in rows:
        want[doc].append([*ids_of(library, text), 2])
    sequences, covered = defaultdict(list), defaultdict(int)
    for p in pieces:
        assert 1 <= p.length <= capacity
        sequences[p.sequence_id].append(p)
        covered[p.doc_id] += p.length
        assert any(len(ids) == p.doc_tokens and zlib.crc32(raw(ids[p.start : p.start + p.length])) == p.ids_crc32 for ids in want[p.doc_id])
    assert covered == {doc: sum(map(len, all_ids)) for doc, all_ids in want.items()}
    for own in sequences.values():
        end = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == end
            end += p.length
        assert end <= capacity
    return sequences


def test_op8_pieces(spark, library, texts, odd, odd_rows, empty):
    sequences = check_pieces(library, texts, packing.op8_packing(spark, SF).collect(), 4096)
    tokens = sum(p.length for own in sequences.values() for p in own)
    assert len(sequences) <= tokens / 4096 * 1.02 + 1
    check_pieces(library, odd_rows, packing.pack(odd, default_path(), capacity=64, group_pieces=3).collect(), 64)
    assert packing.pack(empty, default_path()).count() == 0


def test_op8_groups_stay_small(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    rows = spark.createDataFrame([(1, "the same row")] * 6000 + [(2, long)] * 20 + [(i, f"text {i}") for i in range(3, 3000)], "doc_id long, text string").repartition(6)
    pieces = packing.pack(rows, default_path(), capacity=64, group_pieces=500)
    groups = pieces.groupBy(F.shiftright("sequence_id", 32)).count().agg(F.max("count"), F.count("*")).first()
    assert pieces.count() > 9000 and groups[0] < 900 and groups[1] > 15
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 64").count() == 0


def test_first_fit_decreasing_is_first_fit():
    rng = random.Random(2)
    for _ in range(50):
        lengths = [rng.randint(1, 100) for _ in range(rng.randint(0, 80))]
        room, want = [], {}
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            at = next((b for b, r in enumerate(room) if r >= lengths[i]), len(room))
            if at == len(room):
                room.append(100)
            want[i] = (at, 100 - room[at])
            room[at] -= lengths[i]
        assert packing.first_fit_decreasing(lengths, 100) == [want[i] for i in range(len(lengths))]


def test_op9_equals_the_library(spark, library, texts, odd, odd_rows, empty):
    got = {r.doc_id: r for r in bpe.op9_bpe(spark, SF).collect()}
    for doc, text in texts:
        ids = ids_of(library, text)
        assert (got[doc].n_tokens, got[doc].ids_sha256, got[doc].decoded_sha256) == (len(ids), hashlib.sha256(raw(ids)).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    rows = bpe.encode_documents(odd, default_path()).collect()
    assert sorted((str(r.doc_id), bytes(r.ids)) for r in rows) == sorted((str(d), raw(ids_of(library, t))) for d, t in odd_rows)
    assert bpe.encode_documents(empty, default_path()).count() == 0
