"""LM scoring by masked pseudo-likelihood: a small network predicts every word from the two words on either side.

The output layer is factored: the class of a word, then the leaf in its class.
The most frequent words have leaves of their own; the others that are counted
often enough share the leaves after them, each with its share of the leaf's
count, so every one of them has a probability of its own. The last leaf stands
for all rarer words, which are spelt byte by byte from the byte before.

Documents are dealt to shards by a hash of their text, sorted within. Every shard
trains from the common start on all its words; the results are averaged, weighted
by words, in the order of the shards. Shards belong to one of ROUNDS rounds, and
each round starts from the average of the one before. So the model depends on
the documents alone, not on partitions or the order of rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.codes import word_codes
from millrace.llm.shared import documents, materialize, small_batches

#: Classes, leaves a class, and leaves of a single word; the last leaf holds the words that are spelt.
SIDE = 32
SIZE = SIDE * SIDE
HEAD, SPELT = 768, SIZE - 1
#: Count from which a word has an output of its own, and the part of all words it must be: at most PART words have one, which bounds the broadcast (about 80 MB).
LEAST, PART = 20, 4_000_000
#: Bytes of text a shard, shards whose networks are added at a time, and rounds.
SHARD, FAN, ROUNDS = 32 << 20, 32, 2
#: Bytes, and the edge of a word.
EDGE = 256
OFFSETS = (-2, -1, 1, 2)
U = np.uint64


def word_counts(docs: DataFrame) -> DataFrame:
    """(code, n) of every word of all documents; a task sums its own first, as many words as it may hold at a time."""
    held_words = 2_000_000

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def counts() -> pa.RecordBatch:
            code, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), pa.array(n.astype(np.int64))], ["code", "n"])

        for batch in batches:
            for text in batch.column(1).to_pylist():
                codes = word_codes(text)[0]
                held.append(codes)
                size += len(codes)
                if size > held_words:
                    yield counts()
                    held, size = [], 0
        if held:
            yield counts()

    return docs.mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Sorted codes of the words with an output of their own, their leaves and the logarithms of their shares of them."""

    def __init__(self, codes: np.ndarray, leaves: np.ndarray, shares: np.ndarray):
        self.codes, self.leaves, self.shares = codes, leaves, shares

    @property
    def arrays(self) -> tuple[np.ndarray, ...]:
        return self.codes, self.leaves, self.shares

    @classmethod
    def of(cls, counts: DataFrame) -> Vocabulary:
        """The words of count LEAST and one in PART of all words at least; the HEAD most frequent ones (ties by code) have leaves of their own, the others are dealt over the rest in that order."""
        total = counts.agg(F.sum("n")).first()[0] or 0
        top = counts.where(F.col("n") >= max(LEAST, math.ceil(total / PART))).select("code", "n").toArrow()
        codes, n = top["code"].to_numpy(), top["n"].to_numpy()
        order = np.lexsort((codes, -n))
        codes, n = codes[order].view(U), n[order].astype(np.float64)
        rank = np.arange(len(codes))
        leaves = np.where(rank < HEAD, rank, HEAD + (rank - HEAD) % (SPELT - HEAD)).astype(np.int16)
        shares = np.log(n / np.bincount(leaves, n, SIZE)[leaves]).astype(np.float32) if len(codes) else np.zeros(0, np.float32)
        order = np.argsort(codes)
        return cls(codes[order], leaves[order], shares[order])

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaf of each word and the logarithm of its share; SPELT and 0 where it has none of its own."""
        if not len(self.codes):
            return np.full(len(codes), SPELT, np.int16), np.zeros(len(codes), np.float32)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        hit = self.codes[at] == codes
        return np.where(hit, self.leaves[at], np.int16(SPELT)), np.where(hit, self.shares[at], np.float32(0))


def pairs_of_bytes(text: str | None, spelt: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The byte pairs, as numbers, of the words that are spelt, edges included, one word after the other; and each word's number of pairs."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), dtype=np.uint8)
    starts, sizes = starts[spelt], (ends - starts)[spelt] + 1
    total = int(sizes.sum())
    begin = np.cumsum(sizes) - sizes
    place = np.arange(total) - np.repeat(begin, sizes)
    here = np.repeat(starts, sizes) + place
    last = place == np.repeat(sizes, sizes) - 1
    now = np.where(last, EDGE, data[np.minimum(here, len(data) - 1)].astype(np.int64)) if total else place
    before = np.where(place == 0, EDGE, data[np.maximum(here - 1, 0)].astype(np.int64)) if total else place
    return before * (EDGE + 1) + now, sizes


class Network:
    """tanh of the summed context vectors (one table per offset; row SIZE, the edge of the text, stays 0), then class, then leaf in class."""

    def __init__(self, dim: int = 16, seed: int = 10):
        rng = np.random.default_rng(seed)
        f = np.float32
        tables = np.concatenate([rng.normal(0, 0.1, (len(OFFSETS), SIZE, dim)), np.zeros((len(OFFSETS), 1, dim))], axis=1)
        self.parts = [tables.astype(f), rng.normal(0, 0.1, (SIDE, dim)).astype(f), np.zeros(SIDE, f), rng.normal(0, 0.1, (SIDE, SIDE, dim)).astype(f), np.zeros((SIDE, SIDE), f)]
        #: Counts of byte pairs; the log-probabilities of spellings follow from them.
        self.spelling = np.zeros((EDGE + 1) ** 2)

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts])

    def load(self, flat: np.ndarray) -> Network:
        at = 0
        for i, p in enumerate(self.parts):
            self.parts[i] = flat[at : at + p.size].reshape(p.shape).astype(np.float32)
            at += p.size
        return self

    def _hidden(self, around: np.ndarray) -> np.ndarray:
        tables = self.parts[0]
        h = tables[0][around[0]]
        for table, x in zip(tables[1:], around[1:], strict=True):
            h += table[x]
        return np.tanh(h, out=h)

    def spell(self) -> np.ndarray:
        """Log-probability of each byte or the edge after each, every one counted once more."""
        n = self.spelling.reshape(EDGE + 1, EDGE + 1) + 1
        n[EDGE, EDGE] = 0  # no word is empty
        with np.errstate(divide="ignore"):
            return np.log(n / n.sum(axis=1, keepdims=True)).ravel()

    @staticmethod
    def _by_class(target: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Each class that occurs, with the rows of its targets."""
        kind = (target // SIDE).astype(np.int16)
        order = np.argsort(kind, kind="stable")
        edges = np.searchsorted(kind[order], np.arange(SIDE + 1))
        for c in np.flatnonzero(edges[1:] > edges[:-1]).tolist():
            yield c, order[edges[c] : edges[c + 1]]

    @staticmethod
    def _chosen(z: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log-softmax of each row at one place."""
        z -= z.max(axis=1, keepdims=True)
        return z[np.arange(len(z)), at] - np.log(np.exp(z).sum(axis=1))

    @staticmethod
    def _slope(z: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Gradient of the negative log-softmax at one place of each row."""
        z -= z.max(axis=1, keepdims=True)
        np.exp(z, out=z)
        z /= z.sum(axis=1, keepdims=True)
        z[np.arange(len(z)), at] -= 1
        return z

    def log_probabilities(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Of the targets' leaves."""
        h = self._hidden(around)
        _, cw, cb, ww, wb = self.parts
        out = self._chosen(h @ cw.T + cb, target // SIDE)
        for c, rows in self._by_class(target):
            out[rows] += self._chosen(h[rows] @ ww[c].T + wb[c], target[rows] % SIDE)
        return out

    def step(self, around: np.ndarray, target: np.ndarray, memory: list[np.ndarray], rate: float) -> None:
        """One Adagrad step on the mean negative log-probability."""
        tables, cw, cb, ww, wb = self.parts
        h = self._hidden(around)
        g = self._slope(h @ cw.T + cb, target // SIDE)
        dh, dcw, dcb = g @ cw, g.T @ h, g.sum(axis=0)
        dww, dwb = np.zeros_like(ww), np.zeros_like(wb)
        for c, rows in self._by_class(target):
            own = h[rows]
            p = self._slope(own @ ww[c].T + wb[c], target[rows] % SIDE)
            dww[c], dwb[c] = p.T @ own, p.sum(axis=0)
            dh[rows] += p @ ww[c]
        dh *= 1 - h * h
        dt = np.zeros_like(tables)
        for i, x in enumerate(around):
            order = np.argsort(x, kind="stable")
            first = np.flatnonzero(np.concatenate([[True], np.diff(x[order]) != 0]))
            dt[i, x[order][first]] = np.add.reduceat(dh[order], first, axis=0)
        dt[:, SIZE] = 0
        for p, m, d in zip(self.parts, memory, (dt, dcw, dcb, dww, dwb), strict=True):
            d /= np.float32(len(target))
            m += d * d
            p -= rate * d / (np.sqrt(m) + np.float32(1e-6))


def windows(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of several texts: the leaves around each word (row per offset), and the words' own."""
    edge = np.full(2, SIZE, np.int16)
    sizes = np.array([len(x) for x in ids], dtype=np.int64)
    line = np.concatenate([y for x in ids for y in (edge, x)] + [edge])
    at = np.arange(int(sizes.sum())) + np.repeat(2 * np.arange(1, len(ids) + 1), sizes)
    return np.stack([line[at + o] for o in OFFSETS]), line[at]


def _groups(texts: list[str | None], words: Vocabulary, most: int) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]]:
    """Texts in order, in groups of about ``most`` words: each text's leaves, the log shares of all words, and the byte pairs of the spelt ones with the text they belong to."""
    at = 0
    while at < len(texts):
        codes, pairs, owner, size = [], [], [], 0
        while at < len(texts) and size < most:
            own, starts, ends = word_codes(texts[at])
            codes.append((own, starts, ends, texts[at]))
            size += len(own)
            at += 1
        leaves, shares = words.find(np.concatenate([c[0] for c in codes]))
        split = np.split(leaves, np.cumsum([len(c[0]) for c in codes])[:-1])
        for k, ((_, starts, ends, text), own) in enumerate(zip(codes, split, strict=True)):
            spelt = own == SPELT
            if spelt.any():
                pairs.append(pairs_of_bytes(text, spelt, starts, ends)[0])
                owner.append(np.full(len(pairs[-1]), k))
        none = np.zeros(0, np.int64)
        yield split, shares, np.concatenate([none, *pairs]), np.concatenate([none, *owner])


def _added(rows: DataFrame, shards: int) -> tuple[np.ndarray, np.ndarray, float] | None:
    """Sum over all rows (shard, seen, net, spelling): FAN shards at a time, in their order, until one row is left."""

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("shard")
        net, spelling = (sum((np.frombuffer(x.as_buffer(), np.float64) for x in table[c]), 0.0) for c in ("net", "spelling"))
        return pa.table({"shard": pa.array([table["shard"][0].as_py() // FAN], pa.int64()), "seen": pa.array([sum(table["seen"].to_pylist())], pa.int64()), "net": pa.array([net.tobytes()], pa.binary()), "spelling": pa.array([spelling.tobytes()], pa.binary())})

    while True:
        rows = rows.groupBy(F.floor(F.col("shard") / FAN).alias("node")).applyInArrow(add, "shard long, seen long, net binary, spelling binary")
        shards = -(-shards // FAN)
        if shards == 1:
            found = rows.collect()
            return (np.frombuffer(found[0].net, np.float64), np.frombuffer(found[0].spelling, np.float64), found[0].seen) if found else None
        rows = materialize(rows, "networks")


def train(docs: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS, batch: int = 8192, rate: float = 0.1, shard_bytes: int = SHARD) -> Network:
    """Average of the networks that the shards train, round by round; every word of every document is a target once.

    The number of shards follows the bytes of text. One network reaches the driver.
    """
    spark = docs.sparkSession
    net = Network()
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, math.ceil(total / rounds / shard_bytes))
    # equal texts of equal ids are interchangeable; a text that many documents hold goes to many shards
    keyed = docs.select("doc_id", "text", F.xxhash64("text", "doc_id").alias("hash")).withColumns({"turn": F.pmod("hash", F.lit(rounds)), "shard": F.pmod(F.shiftrightunsigned("hash", 20), F.lit(shards))})
    for turn in range(rounds):
        start = spark.sparkContext.broadcast((net.flat(), vocabulary.arrays))

        def run(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            flat, arrays = start.value
            words = Vocabulary(*arrays)
            shard, own, memory, seen = None, None, None, 0

            def result() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([seen], pa.int64()), pa.array([(own.flat().astype(np.float64) * seen).tobytes()], pa.binary()), pa.array([own.spelling.tobytes()], pa.binary())], ["shard", "seen", "net", "spelling"])

            rest: list[str | None] = []
            size = 0

            def learn() -> None:
                nonlocal seen
                for held, _, pairs, _ in _groups(rest, words, 1 << 62):
                    own.spelling += np.bincount(pairs, minlength=(EDGE + 1) ** 2)
                    around, target = windows(held)
                    for lo in range(0, len(target), batch):
                        own.step(around[:, lo : lo + batch], target[lo : lo + batch], memory, rate)
                    seen += len(target)

            for b in batches:
                for k, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    if k != shard:
                        learn()
                        if seen:
                            yield result()
                        shard, own, seen, rest, size = k, Network().load(flat), 0, [], 0
                        memory = [np.zeros_like(p) for p in own.parts]
                    rest.append(text)
                    size += len(text or "")
                    if size > 64 * batch:
                        learn()
                        rest, size = [], 0
            if shard is not None:
                learn()
                if seen:
                    yield result()

        rows = keyed.where(F.col("turn") == turn).repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "hash", "doc_id").select("shard", "text")
        summed = _added(rows.mapInArrow(run, "shard long, seen long, net binary, spelling binary"), shards)
        if summed:
            net.load(summed[0] / summed[2])
            net.spelling = net.spelling + summed[1]
    return net


def score(docs: DataFrame, net: Network, vocabulary: Vocabulary, batch: int = 16384) -> DataFrame:
    """Per row: doc_id, n_words, log_likelihood (sum over all words) and its mean (null without words)."""
    model = docs.sparkSession.sparkContext.broadcast((net.flat(), net.spell(), vocabulary.arrays))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, spell, arrays = model.value
        net, words = Network().load(flat), Vocabulary(*arrays)
        for b in batches:
            ns, totals = [np.zeros(0, np.int64)], [np.zeros(0)]
            for held, shares, pairs, owner in _groups(b.column(1).to_pylist(), words, batch):
                around, target = windows(held)
                found = np.concatenate([net.log_probabilities(around[:, lo : lo + batch], target[lo : lo + batch]) for lo in range(0, len(target), batch)] or [np.zeros(0)])
                sizes = np.array([len(x) for x in held])
                ns.append(sizes)
                totals.append(np.bincount(np.repeat(np.arange(len(held)), sizes), found + shares.astype(np.float64), len(held)) + np.bincount(owner, spell[pairs], len(held)))
            n, total = np.concatenate(ns), np.concatenate(totals)
            mean = pa.array(np.round(total / np.maximum(n, 1), 6), mask=n == 0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(np.round(total, 4)), mean], ["doc_id", "n_words", "log_likelihood", "mean_log_likelihood"])

    return docs.mapInArrow(run, "doc_id long, n_words long, log_likelihood double, mean_log_likelihood double")


def pseudo_likelihood(docs: DataFrame) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text) by a network fitted to all of them.

    Null and blank texts have no words, a log-likelihood of 0 and a null mean;
    repeated rows stay repeated; an empty table gives an empty result; other
    columns are not read. Scores don't depend on partitions or row order, but for
    the rounding of sums over batches (some 0.0001).
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    vocabulary = Vocabulary.of(materialize(word_counts(docs), "counts"))
    return score(docs, train(docs, vocabulary), vocabulary)


def op10_pseudo_likelihood(spark, sf_dir: str) -> DataFrame:
    """All documents, scored by a model of all documents. Nulls, ties and repeated rows as in ``pseudo_likelihood``."""
    return pseudo_likelihood(documents(spark, sf_dir))
