"""Suffix-array dedup: a sparse suffix array over content-selected positions finds passages that several documents hold.

1. Of every 35 neighbouring 16-word windows the one with the least code is
   retained; two copies of a passage of 50 words retain the same place.
2. Suffixes whose first 16 words begin no suffix of another text are dropped.
3. The others are sorted with the words that follow. Each is compared with its
   neighbours of the same key, and the match is extended to the right and to the
   left, word by word. Matches of 50 words at least are repeats; overlapping
   ones make up longer passages.
4. Keys of more than FEW suffixes are not compared pair by pair: of their
   suffixes all 50-word windows that hold the key are counted by code, which
   finds the same words however many texts hold them.

Both ways are exact up to 64-bit codes of words: a word is repeated if it stands
in a 50-word window that another text holds too, and it has an earlier holder if
a text of a smaller least doc_id (nulls last) holds such a window.

Equal texts are one text throughout, so groups of copies cost one of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.codes import gram_codes, word_codes
from millrace.llm.graph import fixed_table
from millrace.llm.shared import REMEMBERED, Scratch, by_first, documents, small_batches

#: Words of a retained window.
KEY = 16
#: Suffixes of one key that are compared with each other; larger keys go by windows. The result is the same.
FEW = 32
SIEVE = 1 << 20


def retained(words: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and codes of the windows that are least among ``reach`` neighbours.

    Equal ones at equal distances of KEY words at most lie in a stretch that
    repeats itself word by word; those with ``reach`` words of it on either side
    have the same context, and some are left out, with no more than reach - 1
    words between those that stay. At larger distances the words between may
    vary, and all stay.
    """
    codes = gram_codes(words, KEY)
    if len(codes) < reach:
        return np.zeros(0, np.int64), codes[:0]
    near = np.lib.stride_tricks.sliding_window_view(codes, reach)
    at = near.argmin(axis=1) + np.arange(len(near))
    at = at[np.concatenate([[True], at[1:] != at[:-1]])]
    own = codes[at]
    step = np.diff(at)
    joined = (own[1:] == own[:-1]) & (step <= KEY)
    if joined.any():
        # a stretch goes on where the step before it was a joined one of the same length
        goes_on = joined & np.concatenate([[False], joined[:-1] & (step[1:] == step[:-1])])
        begins = np.flatnonzero(np.concatenate([[True], ~goes_on]))
        stays = np.ones(len(at), bool)
        for lo, hi in zip(begins.tolist(), [*begins[1:].tolist(), len(at)], strict=True):
            # the step into a stretch's first row may be its own first step
            lo = lo - 1 if lo and joined[lo - 1] else lo
            if at[hi - 1] - at[lo] <= 2 * reach:
                continue
            deep = np.flatnonzero((at[lo:hi] - at[lo] >= reach) & (at[hi - 1] - at[lo:hi] >= reach)) + lo
            last = at[deep[0] - 1] if len(deep) else 0
            for i in deep.tolist():
                if at[i + 1] - last < reach:
                    stays[i] = False
                else:
                    last = at[i]
        at, own = at[stays], own[stays]
    return at, own


def _suffixes(docs: DataFrame, least: int) -> DataFrame:
    """(key, hash, pos) of the retained suffixes of each text; a task passes equal texts once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            keys, hashes, places = [], [], []
            for own, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if own in seen:
                    continue
                if len(seen) < REMEMBERED:
                    seen.add(own)
                at, codes = retained(word_codes(text)[0], least - KEY + 1)
                if len(at):
                    keys.append(codes.view(np.int64))
                    hashes.append(np.full(len(at), own))
                    places.append(at.astype(np.int32))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, hashes, places)], ["key", "hash", "pos"])

    return docs.mapInArrow(run, "key long, hash long, pos int")


def _contexts(rows: DataFrame, room: int) -> DataFrame:
    """Per place of (hash, places, text, rep): the key and the codes of the ``room`` words after it and, backwards, before it."""
    schema = "key long, after binary, before binary, hash long, pos int, n_after int, n_before int, rep long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, places, text, rep in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = word_codes(text)[0]
                n, at = len(words), np.unique(np.array(places, dtype=np.int64))
                codes = np.zeros(n + 2 * room, "<u8")
                codes[room : room + n] = words
                step = np.arange(room)
                after = codes[(room + at + KEY)[:, None] + step]
                before = codes[(room + at - 1)[:, None] - step]
                # big-endian: sorted as bytes they are sorted as words
                binary = lambda x: pa.array([r.tobytes() for r in x.astype(">u8")], pa.binary())
                key = gram_codes(words, KEY)[at].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key), binary(after), binary(before), pa.array(np.full(len(at), own)), pa.array(at.astype(np.int32)), pa.array(np.minimum(room, n - at - KEY).astype(np.int32)), pa.array(np.minimum(room, at).astype(np.int32)), pa.array([rep] * len(at), pa.int64())], [x.split()[0] for x in schema.split(", ")])

    return rows.mapInArrow(run, schema)


def _windows(rows: DataFrame, least: int) -> DataFrame:
    """Per place of (hash, places, text, rep): code and start of every window of ``least`` words that holds its key; each window of a text once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, places, text, rep in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                codes = gram_codes(word_codes(text)[0], least)
                at = np.unique((np.array(places, dtype=np.int64)[:, None] - np.arange(least - KEY + 1)).ravel())
                at = at[(at >= 0) & (at < len(codes))]
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(codes[at].view(np.int64)), pa.array(np.full(len(at), own)), pa.array(at.astype(np.int32)), pa.array([rep] * len(at), pa.int64())], ["code", "hash", "start", "rep"])

    return rows.mapInArrow(run, "code long, hash long, start int, rep long")


def _columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    """Columns of ``_contexts`` as arrays, contexts as rows of words; null reps are 0, with a column that tells them."""
    n = batch.num_rows
    out = []
    for name, column in zip(batch.schema.names, batch.columns, strict=True):
        if name in ("after", "before"):
            first = int(np.frombuffer(column.buffers()[1], np.int32)[column.offset])
            width = len(column[0].as_py()) // 8
            out.append(np.frombuffer(column.buffers()[2], np.uint64, n * width, first).reshape(n, width))
        elif name == "rep":
            out += [column.fill_null(0).to_numpy(zero_copy_only=False), column.is_null().to_numpy(zero_copy_only=False)]
        else:
            out.append(column.to_numpy(zero_copy_only=False))
    return out


def _matches(sorted_rows: DataFrame, least: int) -> DataFrame:
    """(hash, start, stop, cut) of suffixes that match others of their key in ``least`` words: from the longest match to the left to the longest to the right. cut: of those with texts of a smaller rep."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, after, before, own, pos, n_after, n_before, rep, none in by_first(batches, 20_000, _columns):
            n = len(key)
            longest = np.full((2, 2, n), -1)  # all matches or those with smaller reps; to the left or to the right
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            end = np.repeat(np.concatenate([start[1:], [n]]), np.diff(np.concatenate([start, [n]])))
            at, step = np.arange(n), 1

            def shared(codes: np.ndarray, limit: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
                same = codes[i] == codes[j]
                return np.minimum(np.where(same.all(axis=1), same.shape[1], same.argmin(axis=1)), np.minimum(limit[i], limit[j]))

            while len(at):
                go = at + step < end
                at, end = at[go], end[go]
                i, j = at, at + step
                other = own[i] != own[j]
                i, j = i[other], j[other]
                right, left = shared(after, n_after, i, j) + KEY, shared(before, n_before, i, j)
                long = right + left >= least
                i, j, right, left = i[long], j[long], right[long], left[long]
                for x, y in ((i, j), (j, i)):
                    smaller = ~none[y] & (none[x] | (rep[y] < rep[x]))
                    for kind, use in ((0, slice(None)), (1, smaller)):
                        for side, length in ((0, left), (1, right)):
                            longest[kind, side, x[use]] = np.maximum(longest[kind, side, x[use]], length[use])
                step += 1
            for kind in (0, 1):
                use = longest[kind, 0] >= 0
                if use.any():
                    out = [own[use], (pos[use] - longest[kind, 0, use]).astype(np.int32), (pos[use] + longest[kind, 1, use]).astype(np.int32), np.full(int(use.sum()), bool(kind))]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["hash", "start", "stop", "cut"])

    return sorted_rows.mapInArrow(run, "hash long, start int, stop int, cut boolean")


def _merged(spans: str) -> str:
    """SQL: union of the sorted array of (start, stop)."""
    return f"""aggregate({spans}, CAST(array() AS array<struct<start:int,stop:int>>), (acc, s) ->
        CASE WHEN size(acc) > 0 AND element_at(acc, -1).stop >= s.start
             THEN concat(slice(acc, 1, size(acc) - 1), array(struct(element_at(acc, -1).start AS start, greatest(element_at(acc, -1).stop, s.stop) AS stop)))
             ELSE concat(acc, array(struct(s.start AS start, s.stop AS stop))) END)"""


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("hash"), F.col("text").cast("string").alias("text"))


def repeats(docs: DataFrame, least: int = 50) -> DataFrame:
    """Per text with passages of ``least`` words at least that another text holds too: hash, spans, cuts.

    Spans are word positions [start, stop), merged. cuts are the words of them
    that an earlier text (of a smaller least doc_id, nulls last) holds in a
    passage of ``least`` words that both share.
    """
    small_batches(docs.sparkSession)
    keep = Scratch()
    docs = _keyed(docs)
    suffixes = keep(_suffixes(docs, least).groupBy("key", "hash", "pos").agg(F.lit(1).alias("_one")).drop("_one"), "suffixes")
    keys = suffixes.groupBy("key").agg(F.min("hash").alias("_lo"), F.max("hash").alias("_hi"), F.count("*").alias("_n")).where("_lo <> _hi")
    # written, then joined back: so a key of very many suffixes is split over tasks
    keys = keep(keys.select("key", (F.col("_n") > FEW).alias("many")), "keys")
    shared = suffixes.join(keys, "key")
    places = lambda many: F.collect_list(F.when(F.col("many") == many, F.col("pos")))
    wanted = keep(shared.groupBy("hash").agg(places(False).alias("few"), places(True).alias("many")), "places")
    holders = docs.groupBy("hash").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("r")).select("hash", F.col("r.doc_id").alias("rep"))
    holders = keep(wanted.join(holders, "hash"), "holders")
    sieve = docs.sparkSession.sparkContext.broadcast(fixed_table(wanted.select(F.pmod("hash", F.lit(SIEVE)).alias("bucket"), F.lit(1).alias("value")), SIEVE) > 0)

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = sieve.value[np.mod(batch.column(1).to_numpy(zero_copy_only=False), SIEVE)]
            if hit.any():
                yield batch.filter(pa.array(hit))

    near = docs.mapInArrow(sift, "doc_id long, hash long, text string")
    texts = near.join(holders, "hash").where("doc_id <=> rep").dropDuplicates(["hash"])
    texts = keep(texts.select("hash", "few", "many", "text", "rep"), "texts")
    rows = _contexts(texts.where("size(few) > 0").select("hash", "few", "text", "rep"), least - KEY)
    found = _matches(rows.repartition("key").sortWithinPartitions("key", "after", "hash", "pos"), least)
    windows = keep(_windows(texts.where("size(many) > 0").select("hash", "many", "text", "rep"), least), "windows")
    codes = windows.groupBy("code").agg(F.min("hash").alias("_lo"), F.max("hash").alias("_hi"), F.min("rep").alias("_least")).where("_lo <> _hi")
    hit = windows.join(keep(codes.select("code", "_least"), "codes"), "code")
    cut = F.coalesce(F.col("_least") < F.col("rep"), F.col("rep").isNull() & F.col("_least").isNotNull())
    hit = hit.select("hash", "start", (F.col("start") + least).alias("stop"), F.explode(F.when(cut, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))).alias("cut"))
    found = keep(found.union(hit), "matches")
    span = F.struct("start", "stop")
    found = found.groupBy("hash").agg(F.array_sort(F.collect_set(span)).alias("spans"), F.array_sort(F.collect_set(F.when(F.col("cut"), span))).alias("cuts"))
    found = keep(found.select("hash", F.expr(_merged("spans")).alias("spans"), F.expr(_merged("cuts")).alias("cuts")), "repeats")
    keep.clear(found)
    return found


def document_repeats(docs: DataFrame, least: int = 50) -> DataFrame:
    """(doc_id, hash, n_words, spans, cuts) of the rows of ``docs`` that share a passage of ``least`` words with another document.

    Rows of equal text and different doc_id share all their words; all but the
    smallest doc_id (nulls last) cut them. Repeats inside one document don't
    count. Null and short texts have none. Repeated rows (doc_id and text equal)
    are one document and stay repeated in the result. An empty table gives an
    empty result; other columns are not read.
    """
    found = repeats(docs, least)
    n_words = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    rows = _keyed(docs).select("doc_id", "hash", n_words.alias("n_words")).where(F.col("n_words") >= least)
    copies = rows.groupBy("hash").agg(F.min("doc_id").alias("_least"), F.max("doc_id").alias("_most"), F.max(F.col("doc_id").isNull()).alias("_null"))
    copies = copies.where("_least <> _most OR (_null AND _least IS NOT NULL)")
    joined = rows.join(copies, "hash", "left").join(found, "hash", "left").where("spans IS NOT NULL OR _null IS NOT NULL")
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").alias("stop")))
    none = F.array().cast("array<struct<start:int,stop:int>>")
    copy = F.col("_null").isNotNull()
    return joined.select("doc_id", "hash", "n_words", F.when(copy, whole).otherwise(F.col("spans")).alias("spans"), F.when(copy & ~F.col("doc_id").eqNullSafe(F.col("_least")), whole).otherwise(F.coalesce("cuts", none)).alias("cuts"))


def without_repeats(docs: DataFrame, least: int = 50) -> DataFrame:
    """``docs`` with every passage cut from all documents but its first holder; n_chars, if there, follows the text.

    Rows that lose all their words go; other rows and columns stay as they are.
    """
    found = document_repeats(docs, least).select(F.col("doc_id").alias("_mr_doc"), F.col("hash").alias("_mr_hash"), F.col("cuts").alias("_mr_cuts")).where("size(_mr_cuts) > 0").dropDuplicates(["_mr_doc", "_mr_hash"])
    keyed = docs.withColumn("_mr_key", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    joined = keyed.join(found, F.col("_mr_key").eqNullSafe(F.col("_mr_hash")) & F.col("doc_id").eqNullSafe(F.col("_mr_doc")), "left")
    words = "[^\\x20\\x09-\\x0D]+"
    # the text as alternate white space and words: word i is element i of words, followed by gap i
    out = joined.withColumn("_mr_w", F.when(F.col("_mr_cuts").isNotNull(), F.regexp_extract_all("text", F.lit(f"({words}[\\x20\\x09-\\x0D]*)"), F.lit(1))))
    kept = F.filter("_mr_w", lambda w, i: ~F.exists("_mr_cuts", lambda c: (i >= c.start) & (i < c.stop)))
    out = out.withColumn("_mr_k", kept).where("_mr_k IS NULL OR size(_mr_k) > 0")
    out = out.withColumn("text", F.when(F.col("_mr_k").isNotNull(), F.array_join("_mr_k", "")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_mr_k").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def op5_suffix_repeats(spark, sf_dir: str) -> DataFrame:
    """Documents that share a passage of 50 words or more with another: how many words are repeated and how many have an earlier holder, and both as word spans start-stop. Nulls, ties and repeated rows as in ``document_repeats``."""
    found = document_repeats(documents(spark, sf_dir))
    total = lambda c: F.aggregate(c, F.lit(0), lambda a, s: a + s.stop - s.start).cast("long")
    shown = lambda c: F.array_join(F.transform(c, lambda s: F.concat(s.start.cast("string"), F.lit("-"), s.stop.cast("string"))), ",")
    return found.select("doc_id", F.col("n_words").cast("long").alias("n_words"), total("spans").alias("n_repeated_words"), total("cuts").alias("n_later_words"), shown("spans").alias("spans"), shown("cuts").alias("cuts"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: DuckDB: every window of 50 words as a row; islands of those that two documents hold.
OP5_SQL = f"""WITH w AS (SELECT doc_id, list_filter(string_split_regex({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
n AS (SELECT doc_id, ws, len(ws) AS n FROM w WHERE len(ws) >= 50),
win AS (SELECT doc_id, n, i, md5(array_to_string(ws[i : i + 49], ' ')) AS g FROM (SELECT *, unnest(range(1, n - 48)) AS i FROM n)),
held AS (SELECT g, min(doc_id) AS least FROM win GROUP BY g HAVING min(doc_id) <> max(doc_id)),
hit AS (SELECT DISTINCT doc_id, n, i, least < doc_id AS later FROM win JOIN held USING (g)),
both_kinds AS (SELECT doc_id, n, i, false AS cut FROM hit UNION ALL SELECT doc_id, n, i, true FROM hit WHERE later),
marked AS (SELECT *, coalesce(i - lag(i) OVER (PARTITION BY doc_id, cut ORDER BY i) > 50, true)::INT AS fresh FROM both_kinds),
islands AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, cut ORDER BY i ROWS UNBOUNDED PRECEDING) AS island FROM marked),
spans AS (SELECT doc_id, n, cut, min(i) - 1 AS a, max(i) + 49 AS b FROM islands GROUP BY doc_id, n, cut, island)
SELECT doc_id, n::BIGINT AS n_words, sum(b - a) FILTER (WHERE NOT cut)::BIGINT AS n_repeated_words, coalesce(sum(b - a) FILTER (WHERE cut), 0)::BIGINT AS n_later_words,
       string_agg(a || '-' || b, ',' ORDER BY a) FILTER (WHERE NOT cut) AS spans, coalesce(string_agg(a || '-' || b, ',' ORDER BY a) FILTER (WHERE cut), '') AS cuts
FROM spans GROUP BY doc_id, n"""
