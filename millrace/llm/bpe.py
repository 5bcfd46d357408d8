"""BPE encoding and decoding by dynamic programming over prefixes.

For every prefix of a word the last token of its BPE encoding is unique. An
Aho-Corasick automaton (its suffix links give every token that is a suffix of
the prefix) lists the candidates; the one whose pair with the last token of the
shorter prefix survives merging is stored. Following the stored tokens back from
the end gives the ids. Longer tokens are tried first.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from struct import pack, unpack

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import documents, per_process, small_batches
from millrace.llm.wordids import PLAIN, STEMS, WORDS, byte_symbols, default_path

#: A last symbol stands this far above the same symbol inside a word.
LAST = 0x10000
PAIRS = 1_000_000


class PrefixBPE:
    def __init__(self, path: str):
        import ahocorasick

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.names = {i: t for t, i in model["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ids = {self._symbols(t): i for t, i in model["vocab"].items() if t not in self.added}
        #: rank and result of each merge; halves of each merged token
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.made: dict[int, int] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            b = self._symbols(b)
            left, right, whole = ids[a], ids[b], ids[a + b]
            self.rank[left, right] = rank
            self.halves.setdefault(whole, (left, right))
            self.made.setdefault(whole, rank)
        self.fits: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for symbols, i in ids.items():
            if i not in self.halves or self.compatible(*self.halves[i], self.made[i]):
                self.automaton.add_word(symbols, (len(symbols), i))
        self.automaton.make_automaton()
        self.bytes = byte_symbols()
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        self.normalize, self.pieces = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.split_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None

    def _symbols(self, token: str) -> str:
        if self.suffix and token.endswith(self.suffix):
            token = token[: -len(self.suffix)]
            return token[:-1] + chr(ord(token[-1]) + LAST)
        return token

    def compatible(self, left: int, right: int, own: int | None = None) -> bool:
        """Whether the encoding of both texts together is just these two tokens.

        Undo the two tokens' merges, latest first. At each step the parts that
        touch were neighbours while every merge ranked below the last undone one
        was done; if a merge of the two parts comes before that, it would have
        been taken. ``own``: the rank of the merge that joins the two, which
        doesn't count against itself.
        """
        made, halves, rank = self.made, self.halves, self.rank
        limit = own if own is not None else len(rank) + 1
        while True:
            joined = rank.get((left, right))
            if joined is not None and joined < limit:
                return False
            a, b = made.get(left, -1), made.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b or (a == b and a >= 0):
                # of equal merges the left one is done first, so the right part was still apart
                if a == b:
                    right, limit = halves[right][0], b
                else:
                    left, limit = halves[left][1], a
            else:
                right, limit = halves[right][0], b + 1

    def word(self, shown: str) -> list[int]:
        """Ids of one piece in byte symbols, without its end mark."""
        if not shown:
            return []
        text = shown[:-1] + chr(ord(shown[-1]) + LAST) if self.suffix else shown
        n = len(text)
        last, steps = [-1] * (n + 1), [0] * (n + 1)
        at, found = 0, []
        fits = self.fits
        for end, match in self.automaton.iter(text):
            if end != at:
                self._settle(at, found, last, steps, fits)
                at, found = end, []
            found.append(match)
        self._settle(at, found, last, steps, fits)
        ids, end = [], n
        while end:
            ids.append(last[end])
            end -= steps[end]
        return ids[::-1]

    def _settle(self, end: int, found: list[tuple[int, int]], last: list[int], steps: list[int], fits: dict[int, bool]) -> None:
        """Store the last token of the prefix up to and with ``end``; matches come longest first."""
        for length, token in found:
            start = end + 1 - length
            if start:
                before = last[start]
                if before < 0:
                    continue
                key = before << 32 | token
                ok = fits.get(key)
                if ok is None:
                    ok = self.compatible(before, token)
                    if len(fits) < PAIRS:
                        fits[key] = ok
                if not ok:
                    continue
            last[end + 1], steps[end + 1] = token, length
            return

    def general(self, text: str) -> list[int]:
        """Ids of any text: added tokens are cut out, the library normalises and cuts the rest into pieces (its Unicode tables count), each piece is encoded here."""
        ids: list[int] = []
        for part in self.split_added.split(text) if self.split_added else [text]:
            if part in self.added:
                ids.append(self.added[part])
                continue
            for piece, _ in self.pieces(self.normalize(part)) if part else ():
                ids += self.word(piece)
        return ids


class Codec(dict):
    """word -> its ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        super().__init__()
        self.bpe, self.stems = PrefixBPE(path), {}

    @staticmethod
    def _made(ids: list[int]) -> bytes:
        return pack(f"<{len(ids)}I", *ids)

    def stem(self, word: str) -> bytes:
        bpe = self.bpe
        made = self._made(bpe.word(word if word.isascii() else "".join([bpe.bytes[b] for b in word.encode()])))
        if len(self.stems) < STEMS and len(word) <= 64:
            self.stems[word] = made
        return made

    def __missing__(self, word: str) -> bytes:
        if "<|" not in word and (m := PLAIN.fullmatch(word)):
            made = b"".join([self.stems.get(x) or self.stem(x) for x in (m[1], m[2].lower(), m[3]) if x])
        else:
            made = self._made(self.bpe.general(word))
        if len(self) < WORDS and len(word) <= 64:
            self[word] = made
        return made

    def encode(self, text: str | None) -> bytes:
        return b"".join([self[w] for w in (text or "").replace("\n", " ").split(" ") if w])

    def decode(self, ids: bytes) -> str:
        """As the library does without a decoder: the tokens' names with a space between."""
        names = self.bpe.names
        return " ".join([names[i] for i in unpack(f"<{len(ids) // 4}I", ids)])

    def both(self, text: str | None) -> tuple[bytes, str]:
        """The ids of a text, and what they decode to."""
        ids = self.encode(text)
        return ids, self.decode(ids)


def codec(path: str) -> Codec:
    return per_process(("codec", path), lambda: Codec(path))


def encode_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit), decoded; null texts count as empty, rows stay as they are."""
    return _over(docs, tokenizer, "doc_id long, ids binary, decoded string", lambda doc, ids, decoded: (doc, ids, decoded), (pa.int64(), pa.binary(), pa.string()))


def _over(docs: DataFrame, tokenizer: str, schema: str, row, kinds: tuple) -> DataFrame:
    """A row of ``schema`` per document, from its id, its ids as bytes and their decoded text (null texts: empty). Rows stay one to one, repeated and null ids too; an empty table gives an empty result."""
    small_batches(docs.sparkSession)
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = codec(tokenizer).both
        for batch in batches:
            rows = [row(doc, *both(text)) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * len(names), kinds, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def op9_bpe(spark, sf_dir: str) -> DataFrame:
    """All documents' ids and their decoded text, as digests. Nulls and repeated rows as in ``_over``."""
    sha = lambda data: hashlib.sha256(data).hexdigest()
    return _over(documents(spark, sf_dir), default_path(), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", lambda doc, ids, decoded: (doc, len(ids) // 4, sha(ids), sha(decoded.encode())), (pa.int64(), pa.int64(), pa.string(), pa.string()))
