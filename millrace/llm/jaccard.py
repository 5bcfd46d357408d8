"""N-gram Jaccard join by set relations: index lists skipped in blocks by position, answers derived from similar sets.

1. Equal sets are one set. Words and n-grams are 64-bit codes, sets have 64-bit
   ids (among N different sets about N * N / 2^65 pairs are taken for equal).
2. Tokens are ordered rarest first by a frequency table of fixed size. Of a set
   of n tokens, the first n - ceil(t n) + 1 enter the index: two sets of
   similarity t share one of those. Lists that hold the same sets become one
   list with the number of their tokens.
3. Star passes: each label's best candidates are compared with pivots of its
   lists. Sets that link get one label; what a set shares with its nearest
   pivot is kept as their relation. The passes only save work: whatever they
   leave open, the last pass compares.
4. Last pass: lists are cut into blocks by size and position. Two blocks are
   skipped whole where their sizes, positions or labels rule out every link
   between them (a pair of equal label is connected already). Pairs whose
   positions, sketches or shared index entries rule out the overlap are dropped,
   which is exact. A list of many sets is dealt out by pairs of its shares. The
   sets that come this far have sketches of 2048 bits, so that near copies just
   below the similarity are dropped where they meet.
5. Answers of the pairs left are derived from those of their pivots. The number
   of tokens in which two sets differ is a metric, so the pivots' answer and both
   relations bound it: most pairs link or don't without being read. Only the
   others are compared on their texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.codes import shingle_set
from millrace.llm.graph import fixed_table
from millrace.llm.shared import REMEMBERED, Scratch, by_first, documents, keep_only, plain_columns, small_batches
from millrace.operators.graph import components
from millrace.operators.tables import discard

#: Buckets of the frequency table (4 MB) and of the table of wanted texts.
BUCKETS = 1 << 20
#: Tokens, or pairs, that a task holds before it hands them on.
HELD = 4_000_000
#: Entries of a block, of a list that is compared without blocks, and of a share of a long list.
BLOCK, SHORT, SHARE = 256, 64, 4096
#: Entries of a list that count as many, and star passes at most. Neither changes the result.
LONG, ROUNDS = 16, 4
#: Pivots of a run of a long list after the first pass.
PIVOTS = 16
#: Columns of a set's sketch.
SKETCH = ("s0", "s1", "s2", "s3")
#: Bits of a set's fine sketch in the last pass, and pairs that are looked at by it at once.
FINE, AT_ONCE = 2048, 16_384


def _set_id(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sketch(tokens: np.ndarray) -> tuple[int, ...]:
    """256 bits, each the parity of the tokens that fall on it: two sets differ in at least as many tokens as their sketches in bits."""
    parity = np.bincount((tokens >> np.uint64(20) & np.uint64(255)).astype(np.int64), minlength=256).astype(np.uint8) & 1
    return tuple(np.packbits(parity).view(np.int64).tolist())


def _fine(tokens: np.ndarray) -> bytes:
    """Like ``_sketch``, FINE bits by other bits of the tokens."""
    parity = np.bincount((tokens >> np.uint64(32) & np.uint64(FINE - 1)).astype(np.int64), minlength=FINE).astype(np.uint8) & 1
    return np.packbits(parity).tobytes()


def _with_fine(batch: pa.RecordBatch) -> list[np.ndarray]:
    """Plain columns, of the last one (fine sketches) a row of 64-bit words each."""
    *plain, fine = batch.columns
    return [c.to_numpy(zero_copy_only=False) for c in plain] + [np.frombuffer(b"".join(fine.to_pylist()), np.int64).reshape(len(fine), FINE // 64)]


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In how many bits rows of sketches differ."""
    return np.bitwise_count((x ^ y).view(np.uint64)).sum(axis=-1, dtype=np.int64)


def _least_shared(na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """Tokens that sets of these sizes share at least if they link."""
    return -(-percent * (na + nb) // (100 + percent))


def _batch(names: str, kinds: tuple, cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names.split())


def _repeats(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the tokens that stand in more than two sets of ``held``, with the sum of their numbers. Empties ``held`` and sorts in place: a task needs little more than its tokens twice."""
    tokens = np.concatenate(held)
    held.clear()
    tokens.sort()
    # a token that stands in n sets equals the one two places before it n - 2 times
    often, counts = np.unique(tokens[2:][tokens[2:] == tokens[:-2]], return_counts=True)
    bucket, at = np.unique((often % np.uint64(BUCKETS)).astype(np.int64), return_inverse=True)
    return bucket, np.bincount(at, counts + 2, len(bucket)).astype(np.int64)


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """Per row (kind 0): doc_id, text hash, size, id and sketch of its set (null: none). Per bucket with repeats in a task (kind 1): the bucket and their number."""
    kinds = (pa.int8(),) + (pa.int64(),) * (4 + len(SKETCH))
    names = " ".join(["kind doc_id hash n id", *SKETCH])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only("powers")
        held: list[np.ndarray] = []
        size, seen = 0, set()

        def repeats() -> pa.RecordBatch:
            bucket, number = _repeats(held)
            n = len(bucket)
            return _batch(names, kinds, (np.ones(n, np.int8), bucket, np.zeros(n, np.int64), number, *[np.zeros(n, np.int64)] * (1 + len(SKETCH))))

        for batch in batches:
            rows: list[tuple] = []
            for doc, key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens = shingle_set(text, width)
                own = _set_id(tokens) if len(tokens) else None
                rows.append((0, doc, key, len(tokens), own, *_sketch(tokens)))
                if own is not None and own not in seen:
                    if len(seen) < REMEMBERED:
                        seen.add(own)
                    held.append(tokens)
                    size += len(tokens)
            if rows:
                yield _batch(names, kinds, zip(*rows, strict=True))
            if size > HELD:
                yield repeats()
                size = 0
        if held:
            yield repeats()

    return docs.mapInArrow(run, ", ".join(["kind byte, doc_id long, hash long, n long, id long", *(f"{c} long" for c in SKETCH)]))


def _index(docs: DataFrame, width: int, percent: int, table) -> DataFrame:
    """(token, id, n, pos) of every set's index entries; equal sets within a task once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only("powers")
        often = table.value
        seen: set[int] = set()
        for batch in batches:
            cols: list[list[np.ndarray]] = [[], [], [], []]
            for text in batch.column(2).to_pylist():
                tokens = shingle_set(text, width)
                n = len(tokens)
                if not n or (own := _set_id(tokens)) in seen:
                    continue
                if len(seen) < REMEMBERED:
                    seen.add(own)
                keep = n - -(-percent * n // 100) + 1
                order = np.lexsort((tokens, often[(tokens % np.uint64(BUCKETS)).astype(np.int64)]))[:keep]
                for c, x in zip(cols, (tokens[order].view(np.int64), np.full(keep, own), np.full(keep, n, np.int32), np.arange(keep, dtype=np.int32)), strict=True):
                    c.append(x)
            if cols[0]:
                yield _batch("token id n pos", (pa.int64(), pa.int64(), pa.int32(), pa.int32()), [np.concatenate(c) for c in cols])

    return docs.mapInArrow(run, "token long, id long, n int, pos int")


def _lists(index: DataFrame, parts: int) -> DataFrame:
    """(list, id, n, pos, many): the index lists of two sets or more; those of the same sets are one list, with the position of their least token and their number.

    A list's key is a hash of its sets. Should two keys meet, their rows only
    stand in one list, which adds candidates and loses none.
    """
    by_token = Window.partitionBy("token")
    # rows of a token meet in one partition, so that neither step below shuffles again
    once = index.repartition(parts, "token").groupBy("token", "id", "n", "pos").agg(F.lit(1).alias("_one"))
    named = once.withColumns({"_sets": F.count("*").over(by_token), "_x": F.bit_xor(F.xxhash64("id")).over(by_token), "_y": F.bit_xor(F.xxhash64(F.lit(7), "id")).over(by_token)})
    merged = named.where("_sets > 1").groupBy("_sets", "_x", "_y", "id", "n").agg(F.min(F.struct("token", "pos")).alias("_at"), F.count("*").cast("int").alias("many"))
    return merged.select(F.xxhash64("_sets", "_x", "_y").alias("list"), "id", "n", F.col("_at.pos").alias("pos"), "many")


def _stars(lists: DataFrame, percent: int, turn: int, pivots: int, tried: DataFrame | None) -> DataFrame:
    """(a, b): for every label its sets b that are nearest pivots a of other labels by index entries and sketch, pairs in ``tried`` left out.

    The entries of a list are cut into runs whose sizes allow a link; a run's
    pivots are the sets of the least scrambled ids, others each ``turn`` and
    mostly the same in all lists of a group of near copies. A label takes
    ``pivots`` pairs at most, the best of as many shares of its candidates.
    """
    scramble = np.uint64(0x9E3779B97F4A7C15 * (2 * turn + 1) % 2**64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit, own, n, label, many, *bits in by_first(batches, 50_000, plain_columns):
            sketch = np.stack(bits, axis=1)
            rank = own.view(np.uint64) * scramble
            rank ^= rank >> np.uint64(29)
            first = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
            out: list[tuple[np.ndarray, ...]] = []
            for lo, hi in zip(first, [*first[1:], len(unit)], strict=True):
                while hi - lo > 1:
                    end = lo + int(np.searchsorted(n[lo:hi] * percent, 100 * int(n[lo]), side="right"))
                    for at in lo + np.argsort(rank[lo:end])[:pivots]:
                        other = lo + np.flatnonzero(label[lo:end] != label[at])
                        both, apart = int(n[at]) + n[other].astype(np.int64), _apart(sketch[other], sketch[at])
                        near = both - apart >= 2 * _least_shared(n[other].astype(np.int64), int(n[at]), percent)
                        other, apart = other[near], (apart / both)[near]
                        if len(other):
                            out.append((np.full(len(other), own[at]), own[other], np.full(len(other), n[at]), label[other], apart, many[other]))
                    lo = end
            if out:
                yield _batch("a b na label apart many", (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.int32()), [np.concatenate(c) for c in zip(*out, strict=True)])

    # a long list in shares, other ones each turn
    share = F.pmod(F.xxhash64(F.lit(turn), "id"), F.ceil(F.col("_size") / SHARE))
    dealt = lists.withColumn("unit", F.xxhash64("list", share)).repartition("unit").sortWithinPartitions("unit", "n", "id")
    pairs = dealt.select("unit", "id", "n", "label", "many", *SKETCH).mapInArrow(run, "a long, b long, na int, label long, apart double, many int")
    counted = pairs.groupBy("a", "b", "label").agg(F.first("na").alias("na"), F.first("apart").alias("apart"), F.sum("many").alias("shared"))
    if tried is not None:
        counted = counted.join(tried, ["a", "b"], "left_anti")
    return counted.groupBy("label", F.pmod(F.xxhash64("a", "b"), F.lit(pivots))).agg(F.max(F.struct(F.expr("shared / na - apart"), "a", "b")).alias("best")).select("best.a", "best.b")


class _Entries:
    """Sorted rows of whole lists, and the pairs of them that may link."""

    def __init__(self, cols: list[np.ndarray], percent: int, fine: np.ndarray | None = None):
        self.unit, self.own, n, pos, self.label, self.many, self.side, *bits = cols
        self.n, self.pos, self.percent = n.astype(np.int64), pos.astype(np.int64), percent
        self.sketch, self.fine = np.stack(bits, axis=1), fine

    def may(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Of index pairs, which differ in label, lie on two sides and may share enough tokens by size and position."""
        na, nb, pa_, pb = self.n[i], self.n[j], self.pos[i], self.pos[j]
        most = np.minimum(pa_, pb) + np.minimum(na - pa_, nb - pb)
        enough = most >= _least_shared(na, nb, self.percent)
        return enough & (self.label[i] != self.label[j]) & ((self.side[i] != self.side[j]) | (self.side[i] == 2)) & (np.minimum(na, nb) * 100 >= self.percent * np.maximum(na, nb))

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        start = np.flatnonzero(np.concatenate([[True], self.unit[1:] != self.unit[:-1]]))
        stop = np.concatenate([start[1:], [len(self.unit)]])
        size = stop - start
        # short lists all at once: each row with the next, the one after that, and so on
        short = size <= SHORT
        at = np.concatenate([np.zeros(0, np.int64), *(np.arange(a, b) for a, b in zip(start[short], stop[short], strict=True))]).astype(np.int64)
        end = np.repeat(stop[short], size[short])
        step = 1
        while len(at):
            go = at + step < end
            at, end = at[go], end[go]
            ok = self.may(at, at + step)
            if ok.any():
                yield at[ok], at[ok] + step
            step += 1
        for a, b in zip(start[~short].tolist(), stop[~short].tolist(), strict=True):
            yield from self.blocks(a, b)

    def blocks(self, start: int, stop: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of one list, by pairs of blocks whose least and greatest size, position and label allow one."""
        at = np.arange(start, stop, BLOCK)
        least = {k: np.minimum.reduceat(getattr(self, k)[:stop], at) for k in ("n", "pos", "label", "side")}
        most = {k: np.maximum.reduceat(getattr(self, k)[:stop], at) for k in ("n", "pos", "label", "side")}
        for k, x in enumerate(at.tolist()):
            sizes = (most["n"][k] * 100 >= self.percent * least["n"][k:]) & (most["n"][k:] * 100 >= self.percent * least["n"][k])
            shared = np.minimum(most["pos"][k], most["pos"][k:]) + np.minimum(most["n"][k] - least["pos"][k], most["n"][k:] - least["pos"][k:])
            places = shared >= _least_shared(least["n"][k], least["n"][k:], self.percent)
            one = lambda c: (least[c][k] == most[c][k]) & (least[c][k:] == least[c][k]) & (most[c][k:] == least[c][k])  # noqa: E731,B023
            for y in at[k:][sizes & places & ~one("label") & ~(one("side") & (least["side"][k] != 2))].tolist():
                i, j = (g.ravel() for g in np.meshgrid(np.arange(x, min(stop, x + BLOCK)), np.arange(y, min(stop, y + BLOCK)), indexing="ij"))
                if x == y:
                    i, j = i[i < j], j[i < j]
                ok = self.may(i, j)
                if ok.any():
                    yield i[ok], j[ok]

    def found(self) -> Iterator[tuple[np.ndarray, ...]]:
        """(a, b, na, nb, many) of the pairs that their sketches allow, the smaller id first."""
        for i, j in self.pairs():
            most = self.n[i] + self.n[j] - 2 * _least_shared(self.n[i], self.n[j], self.percent)
            near = most >= _apart(self.sketch[i], self.sketch[j])
            i, j, most = i[near], j[near], most[near]
            if self.fine is not None and len(i):
                cuts = range(0, len(i), AT_ONCE)
                near = most >= np.concatenate([_apart(self.fine[i[k : k + AT_ONCE]], self.fine[j[k : k + AT_ONCE]]) for k in cuts])
                i, j = i[near], j[near]
            if len(i):
                na, nb = self.n[i], self.n[j]
                swap = self.own[i] > self.own[j]
                i, j = np.where(swap, j, i), np.where(swap, i, j)
                yield self.own[i], self.own[j], self.n[i], self.n[j], np.minimum(self.many[i], self.many[j]).astype(np.int64)


def _summed(held: list[tuple[np.ndarray, ...]]) -> list[np.ndarray]:
    """One row per pair, ``many`` summed."""
    a, b, na, nb, many = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.lexsort((b, a))
    first = np.flatnonzero(np.concatenate([[True], (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)]))
    one = order[first]
    return [a[one], b[one], na[one], nb[one], np.add.reduceat(many[order], first)]


def _across(lists: DataFrame, fine: DataFrame, percent: int) -> DataFrame:
    """(a, b, na, nb) of the pairs of one list whose labels differ and whose sizes, positions, sketches (``fine``: id, fine) and shared entries allow a link.

    A task sums the entries that a pair shares in its lists before it hands
    them on. A list of more than SHARE sets is cut into shares by a hash of the
    id; each pair of shares is compared in a place of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        out = lambda cols: _batch("a b na nb many", (pa.int64(),) * 5, cols)
        for *cols, bits in by_first(batches, 50_000, _with_fine):
            for found in _Entries(cols, percent, bits).found():
                held.append(found)
                size += len(found[0])
                if size > HELD:
                    merged = _summed(held)
                    held, size = [tuple(merged)], len(merged[0])
                    if size > HELD // 2:
                        yield out(merged)
                        held, size = [], 0
        if held:
            yield out(_summed(held))

    dealt = lists.join(fine, "id").withColumn("_k", F.ceil(F.col("_size") / SHARE).cast("int")).withColumn("_own", F.pmod(F.xxhash64(F.lit(-1), "id"), F.col("_k")).cast("int"))
    dealt = dealt.withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    low, high = F.least("_own", "_with"), F.greatest("_own", "_with")
    side = F.when(F.col("_own") == F.col("_with"), 2).otherwise((F.col("_own") > F.col("_with")).cast("int")).cast("int")
    dealt = dealt.withColumns({"unit": F.xxhash64("list", low, high), "side": side, "_class": F.floor(F.log("n") * 50)})
    dealt = dealt.repartition("unit").sortWithinPartitions("unit", "_class", "pos", "id")
    pairs = dealt.select("unit", "id", "n", "pos", "label", "many", "side", *SKETCH, "fine").mapInArrow(run, "a long, b long, na long, nb long, many long")
    counted = pairs.groupBy("a", "b").agg(F.first("na").alias("na"), F.first("nb").alias("nb"), F.sum("many").alias("shared"))
    # of the set whose index ends first, all shared tokens up to there are in the other's index too
    outside = lambda n: F.expr(f"ceil({percent} * {n} / 100.0) - 1")
    return counted.where(F.col("shared") + F.greatest(outside("na"), outside("nb")) >= F.expr(f"{percent} * (na + nb) / {100.0 + percent}") - 1e-6).drop("shared")


def _compared(pairs: DataFrame, texts: DataFrame, width: int, star: int = 256) -> DataFrame:
    """(a, b, na, nb, apart) of the pairs (a, b): sizes, and the number of tokens in only one of them. ``texts``: id, text. A pivot's partners are dealt out ``star`` at a time, each share with the pivot's text, and read as a stream."""
    dealt = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.count("*").over(Window.partitionBy("a")) / star)).alias("salt"))
    wanted = dealt.select("a", "salt", F.lit(0).alias("ord"), F.col("a").alias("id")).distinct().union(dealt.select("a", "salt", F.lit(1), "b"))
    rows = wanted.join(texts, "id").select("a", "salt", "ord", "id", "text").repartition("a", "salt").sortWithinPartitions("a", "salt", "ord", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pivot = None, None
        for batch in batches:
            found: list[tuple[int, ...]] = []
            for a, salt, order, own, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens = shingle_set(text, width)
                if order == 0:
                    at, pivot = (a, salt), tokens
                    continue
                if at != (a, salt):
                    raise RuntimeError("a pair's first text is missing")
                same = len(np.intersect1d(pivot, tokens, assume_unique=True))
                found.append((a, own, len(pivot), len(tokens), len(pivot) + len(tokens) - 2 * same))
            if found:
                yield _batch("a b na nb apart", (pa.int64(),) * 5, zip(*found, strict=True))

    return rows.mapInArrow(run, "a long, b long, na long, nb long, apart long")


def _links(apart: Column, percent: int) -> Column:
    """Whether sets of na and nb tokens that differ in ``apart`` of them have the similarity: 100 * intersection >= percent * union."""
    return apart * (100 + percent) <= F.lit(100 - percent) * (F.col("na") + F.col("nb"))


def _resolved(pairs: DataFrame, kin: DataFrame, compare, percent: int, table: Scratch) -> DataFrame:
    """Those of ``pairs`` (a, b, na, nb) that link, derived from the answers of similar sets.

    ``kin``: (id, pivot, far), a set's nearest pivot and the number of tokens in
    only one of both; a set without one is its own. ``compare`` gives the
    distances of pairs from their texts. Each pair of pivots is compared once.
    """
    ends = []
    named = pairs
    for end in ("a", "b"):
        named = named.join(kin.select(F.col("id").alias(end), F.col("pivot").alias(f"p{end}"), F.col("far").alias(f"f{end}")), end, "left")
        ends.append(F.coalesce(f"p{end}", end))
    named = table(named.select("a", "b", "na", "nb", F.least(*ends).alias("p"), F.greatest(*ends).alias("q"), (F.coalesce("fa", F.lit(0)) + F.coalesce("fb", F.lit(0))).alias("far")), "named")
    answers = compare(named.select(F.col("p").alias("a"), F.col("q").alias("b")).distinct()).select(F.col("a").alias("p"), F.col("b").alias("q"), "apart")
    bounded = table(named.join(answers, ["p", "q"]).select("a", "b", "na", "nb", _links(F.col("apart") + F.col("far"), percent).alias("sure"), _links(F.col("apart") - F.col("far"), percent).alias("may")), "bounded")
    read = compare(bounded.where("may AND NOT sure").select("a", "b"))
    return bounded.where("sure").select("a", "b").union(read.where(_links(F.col("apart"), percent)).select("a", "b"))


def _owners(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Per row of ``docs``: doc_id, hash of the text, size n and id of its set (null: no words). Per id: ``first``, the least (doc_id is null, doc_id, hash) of its class."""
    spark, keep = docs.sparkSession, Scratch()
    small_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), F.col("text").cast("string").alias("text"))
    first = keep(_sets(docs, width), "sets")
    rows = first.where("kind = 0").select("doc_id", "hash", "n", "id", *SKETCH)
    often = fixed_table(first.where("kind = 1").select(F.col("doc_id").alias("bucket"), F.col("n").alias("value")), BUCKETS)
    table = spark.sparkContext.broadcast(often)
    # tokens that still have long lists move behind the rarer ones: the order is again one table for all sets
    long = _index(docs, width, percent, table).groupBy("token").agg(F.count("*").alias("value")).where(F.col("value") > LONG)
    more = fixed_table(long.select(F.pmod("token", F.lit(BUCKETS)).alias("bucket"), "value"), BUCKETS)
    table = spark.sparkContext.broadcast(often + np.minimum(more, 2**32 - 1 - often))
    lists = keep(_lists(_index(docs, width, percent, table), parts), "lists")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash", *SKETCH))
    holders = rows.where("id IS NOT NULL").groupBy("id").agg(least.alias("r")).select("id", F.col("r.doc_id").alias("rep"), *(f"r.{c}" for c in ("hash", *SKETCH)))
    holders = keep(holders, "holders")

    def read(ids: DataFrame, name: str = "text string", make=None) -> DataFrame:
        """id and text, or what ``make`` makes of it, of ``ids``; texts that none of them wants are mostly sifted out before the join, by a table of fixed size."""
        wanted = ids.distinct().join(holders.select("id", "rep", "hash"), "id")
        sieve = fixed_table(wanted.select(F.pmod("hash", F.lit(BUCKETS)).alias("bucket"), F.lit(1).alias("value")), BUCKETS)
        sieve = spark.sparkContext.broadcast(sieve > 0)

        def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = sieve.value[np.mod(batch.column(1).to_numpy(zero_copy_only=False), BUCKETS)]
                if hit.any():
                    own = batch.filter(pa.array(hit))
                    yield own if make is None else pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(map(make, own.column(2).to_pylist()), pa.binary())], ["doc_id", "hash", name.split()[0]])

        near = docs.mapInArrow(sift, f"doc_id long, hash long, {name}")
        near = near.join(wanted.select("id", "hash", F.col("rep")), "hash").where("doc_id <=> rep")
        return near.select("id", name.split()[0]).dropDuplicates(["id"])

    def compare(pairs: DataFrame) -> DataFrame:
        pairs = keep(pairs, "pairs")
        if pairs.isEmpty():  # no text need be read
            return spark.createDataFrame([], "a long, b long, na long, nb long, apart long")
        texts = read(pairs.select(F.col("a").alias("id")).union(pairs.select("b")))
        found = keep(_compared(pairs, texts, width), "compared")
        discard(pairs)
        return found

    def divided(label: DataFrame | None) -> DataFrame:
        """The lists that still hold several labels, with their sizes and the sets' sketches."""
        named = lists.join(holders.select("id", *SKETCH), "id")
        if label is None:
            named = named.withColumn("label", F.col("id"))
        else:
            named = named.join(label.withColumnRenamed("node", "id"), "id", "left").withColumn("label", F.coalesce("label", "id"))
        sizes = named.groupBy("list").agg(F.count("*").alias("_size"), F.min("label").alias("_lo"), F.max("label").alias("_hi")).where("_lo <> _hi").select("list", "_size")
        # the sizes are written first: so a list of very many sets is split over tasks
        sizes = keep(sizes, "sizes")
        found = keep(named.join(sizes, "list"), "divided")
        discard(sizes)
        return found

    linked = seen = None
    left = divided(None)
    for turn in range(ROUNDS):
        # all lists by one pivot, then the long ones alone by many
        part, pivots = (left.where(F.col("_size") > LONG), PIVOTS) if turn else (left, 1)
        tried = None if seen is None else seen.select("a", "b")
        found = compare(_stars(part, percent, turn, pivots, tried))
        n_tried, n_found = found.agg(F.count("*"), F.count_if(_links(F.col("apart"), percent))).first()
        seen = found if seen is None else seen.union(found)
        linked = seen.where(_links(F.col("apart"), percent))
        if n_found:
            before, left = left, divided(components(linked.select("a", "b")))
            discard(before)
        if 10 * n_found < n_tried or not n_found:
            break
    kin = linked.groupBy(F.col("b").alias("id")).agg(F.min(F.struct("apart", "a")).alias("_near")).select("id", F.col("_near.a").alias("pivot"), F.col("_near.apart").alias("far"))
    fine = keep(read(left.select("id"), "fine binary", lambda text: _fine(shingle_set(text, width))), "fine")
    more = keep(_resolved(_across(left, fine, percent), kin, compare, percent, keep), "links")
    label = components(linked.select("a", "b").union(more)).withColumnRenamed("node", "id")
    own = holders.select("id", F.struct(F.col("rep").isNull().alias("none"), F.col("rep").alias("doc_id"), "hash").alias("own"))
    # a large class in shares: its least row meets them all
    shares = 32
    classes = label.join(own, "id")
    heads = classes.groupBy("label").agg(F.min("own").alias("first")).withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    named = classes.withColumn("share", F.pmod("id", F.lit(shares)).cast("int")).join(heads, ["label", "share"]).select("id", "first")
    owners = own.join(named, "id", "left").select("id", F.coalesce("first", "own").alias("first"))
    owners = keep(owners, "owners")
    keep.clear(first, owners)
    return rows.select("doc_id", "hash", "n", "id"), owners


def classes(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    Two rows link if their sets' Jaccard similarity is ``percent`` / 100 at
    least; component_id is the smallest doc_id reachable, its own included.
    Rows without words link with nothing. Null doc_ids take part and stay null
    (a class of nulls only has a null id); repeated rows stay repeated; an empty
    table gives an empty result; other columns are not read.
    """
    rows, owners = _owners(docs, width, percent)
    found = rows.join(owners, "id", "left")
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("id").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without those whose class has a smaller (doc_id, text hash), nulls last; of repeated rows (doc_id and text equal) one stays. Rows without words stay."""
    rows, owners = _owners(docs, width, percent)
    first = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.hash") == F.col("hash"))
    later = rows.join(owners, "id").where(~first).select(F.col("doc_id").alias("_mr_later"), F.col("hash").alias("_mr_text")).distinct()
    keyed = docs.withColumns({"_mr_doc": F.col("doc_id").cast("long"), "_mr_hash": F.xxhash64("text")})
    kept = keyed.join(later, F.col("_mr_hash").eqNullSafe(F.col("_mr_text")) & F.col("_mr_doc").eqNullSafe(F.col("_mr_later")), "left_anti")
    return kept.dropDuplicates(["_mr_doc", "_mr_hash"]).drop("_mr_doc", "_mr_hash")


def op7_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    """Classes of the 4-word shingle sets of all documents at 85 %. Nulls, ties and repeated rows as in ``classes``."""
    return classes(documents(spark, sf_dir), 4, 85)


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: DuckDB: distinct sets, joined on the rarest shingles that two linking sets must share, and the links' closure.
OP7_SQL = f"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) >= 4 THEN list_sort(list_distinct(list_transform(range(1, len(ws) - 2), lambda i: md5_number(ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3])))) WHEN len(ws) > 0 THEN [md5_number(len(ws) || ':' || array_to_string(ws, ' '))] ELSE [] END AS g FROM w),
sets AS (SELECT g, len(g) AS n, min(doc_id) AS id FROM s WHERE len(g) > 0 GROUP BY g),
tokens AS (SELECT id, n, unnest(g) AS t FROM sets), counted AS (SELECT *, count(*) OVER (PARTITION BY t) AS f FROM tokens),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY f, t) AS r FROM counted),
idx AS (SELECT id, n, t FROM ranked WHERE r <= n - ceil(85 * n / 100.0) + 1 AND f > 1),
pairs AS (SELECT DISTINCT a.id AS x, b.id AS y FROM idx a JOIN idx b ON a.t = b.t AND a.id < b.id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)),
common AS (SELECT x, y, a.n AS p, b.n AS q, len(list_intersect(a.g, b.g)) AS c FROM pairs JOIN sets a ON a.id = x JOIN sets b ON b.id = y),
links AS (SELECT x, y FROM common WHERE 100 * c >= 85 * (p + q - c)),
edges AS (SELECT x AS a, y AS b FROM links UNION SELECT y, x FROM links),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
component AS (SELECT a AS id, least(a, min(b)) AS c FROM reach GROUP BY a)
SELECT s.doc_id, len(s.g)::BIGINT AS n_shingles, CASE WHEN len(s.g) = 0 THEN s.doc_id ELSE coalesce(c, sets.id) END AS component_id FROM s LEFT JOIN sets USING (g) LEFT JOIN component ON component.id = sets.id"""
