"""Token ids of whole texts by the tokenizers library, through a cache of words.

The tokenizer of ``word_bpe_49k.json`` drops white space and never lets a token
cross it, so a text's ids are its words' ids in order. Words (pieces between
spaces and newlines) are looked up in a dictionary. Unseen plain words go to the
library's BPE model, everything else through the library's full ``encode``.
``column`` looks up each distinct word of many texts once.
"""

from __future__ import annotations

import re
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from millrace.llm.shared import per_process

#: Punctuation, letters, punctuation: three pieces that the tokenizer takes apart and encodes alone. An apostrophe may begin a contraction and is left out.
PLAIN = re.compile(r"([!-&(-/:-@\[-`{-~]*)([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)")
#: The same parts, of a word whose punctuation has been stripped off.
MARKS, LETTERS = "".join(c for c in map(chr, range(33, 127)) if c != "'" and not c.isalnum()), re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]*")
#: Entries the caches hold at most; words beyond that are encoded each time.
WORDS, STEMS = 400_000, 700_000
#: Ids that are gathered at once, besides those of a last word.
GATHERED = 1 << 17


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable Latin-1 stands for itself, the others follow from 256 in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in table:
            table[b], extra = chr(extra), extra + 1
    return [table[b] for b in range(256)]


class WordIds(dict):
    """word -> its ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.full = Tokenizer.from_file(path)
        self.full.no_truncation()
        self.full.no_padding()
        self.model, self.symbols, self.stems = self.full.model, byte_symbols(), {}

    def stem(self, word: str) -> bytes:
        """Of letters alone or punctuation alone, lower case, that is not in the cache."""
        shown = word if word.isascii() else "".join([self.symbols[b] for b in word.encode()])
        found = [t.id for t in self.model.tokenize(shown)]
        ids = pack(f"<{len(found)}I", *found)
        if len(self.stems) < STEMS and len(word) <= 64:
            self.stems[word] = ids
        return ids

    def __missing__(self, word: str) -> bytes:
        stem = word.strip(MARKS)
        if "<|" not in word and (stem.isascii() and stem.isalpha() or LETTERS.fullmatch(stem)):
            get, low, start = self.stems.get, stem.lower(), word.find(stem)
            before, after = word[:start], word[start + len(stem) :]
            ids = (get(low) or self.stem(low)) if low else b""
            if before:
                ids = (get(before) or self.stem(before)) + ids
            if after:
                ids += get(after) or self.stem(after)
        else:
            found = self.full.encode(word, add_special_tokens=False).ids
            ids = pack(f"<{len(found)}I", *found)
        if len(self) < WORDS and len(word) <= 64:
            self[word] = ids
        return ids

    def ids(self, text: str | None) -> bytes:
        return b"".join([self[w] for w in (text or "").replace("\n", " ").split(" ")])

    def column(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with ``end_id`` behind it, and how many each has."""
        pieces = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        ends = np.cumsum(pc.fill_null(pc.list_value_length(pieces), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        words = pieces.flatten().dictionary_encode()
        del pieces
        found = [self[w] for w in words.dictionary.to_numpy(zero_copy_only=False).tolist()]
        found.append(pack("<I", end_id))
        sizes = np.fromiter(map(len, found), np.int32, len(found)) // 4
        flat, starts = np.frombuffer(b"".join(found), "<u4"), np.cumsum(sizes, dtype=np.int64) - sizes
        order = np.insert(words.indices.to_numpy(zero_copy_only=False), ends, len(found) - 1)
        upto = np.concatenate([[0], np.cumsum(sizes[order], dtype=np.int64)])
        cuts, ids = [*np.unique(np.searchsorted(upto, np.arange(0, upto[-1], GATHERED))).tolist(), len(order)], []
        for a, b in zip(cuts, cuts[1:]):
            own = order[a:b]
            ids.append(flat[np.repeat(starts[own] - upto[a:b], sizes[own]) + np.arange(upto[a], upto[b])])
        return np.concatenate([*ids, flat[:0]]), np.diff(upto[ends + np.arange(1, len(ends) + 1)], prepend=0)


def word_ids(path: str) -> WordIds:
    return per_process(("word ids", path), lambda: WordIds(path))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
