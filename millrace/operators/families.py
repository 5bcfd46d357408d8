"""Families of documents, splits without leakage, and deterministic samples.

Inner columns begin with an underscore and a prefix, so a caller's columns stay
as they are. Null texts are a family each; repeated rows stay repeated; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.scalars import casefold, draw, group_id, raw_hash, stable_hash
from millrace.operators.graph import components
from millrace.operators.shingles import candidates, cut, minima, normal, shared_codes, windows
from millrace.operators.tables import Scratch

# The split shares by volume, the mode mix, documents that make a line measured, groups that allow a repair, carriers that allow one to be held out.
BANDS = ((200, 0.70, 0.88), (1000, 0.75, 0.90), (None, 0.80, 0.90))
MODES = (("text", 0.50), ("image", 0.70), ("both", 1.0))
MEASURED, REPAIRED, HELD_OUT = 5, 3, 10


def exact_families(docs: DataFrame) -> DataFrame:
    """Add family (grp- and 12 hex digits of the least member's hash) and members; equal texts are one family, null texts one each.

    A family is found by an aggregate over text hashes and joined back, so a
    text that very many rows hold is split over tasks; its bytes stay where they
    are read.
    """
    keyed = docs.withColumn("_mr_key", F.coalesce(F.sha2(F.col("text").cast("string"), 256), F.concat(F.lit("id:"), F.col("doc_id").cast("string")), F.lit("id:")))
    heads = keyed.groupBy("_mr_key").agg(F.min("doc_id").alias("_mr_least"), F.count("*").alias("_mr_members"))
    joined = keyed.drop("family", "members").join(heads, "_mr_key")
    return joined.withColumns({"family": group_id(F.coalesce(F.col("_mr_least").cast("string"), F.lit(""))), "members": F.col("_mr_members")}).drop("_mr_key", "_mr_least", "_mr_members")


def band_split(key: Column, total: Column) -> Column:
    """train, val or test by the stable hash of ``key``, with the shares of the volume band of ``total``."""
    h, split = stable_hash(key), F.lit(None)
    for most, train, val in reversed(BANDS):
        own = F.when(h < train, "train").when(h < val, "val").otherwise("test")
        split = own if most is None else F.when(total < most, own).otherwise(split)
    return split


def minhash(text: str | None, permutations: int = 128, which: Iterable[int] | None = None) -> list[int]:
    """Minima of salted SHA-256 over the 5-word shingles (first 8 bytes, big-endian, as signed longs); empty without words. ``which``: the positions wanted, if not all."""
    data = normal(text)
    grams = cut(data, *windows(data))
    return minima(grams, tuple(range(permutations) if which is None else which)) if grams else []


def band_steps(permutations: int, bands: int) -> list[list[list[int]]]:
    """The positions that are signed step by step: of each band one, then two more, then the rest. Bands are disjoint and hold all positions."""
    own = [list(range(i, permutations, bands)) for i in range(bands)]
    return [step for step in ([b[:1] for b in own], [b[1:3] for b in own], [b[3:] for b in own]) if any(step)]


def estimated_jaccard(a: Column, b: Column) -> Column:
    """Share of equal positions; 0 where one is empty or they differ in length."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x))
    return F.when((F.size(a) == F.size(b)) & (F.size(a) > 0), same / F.size(a)).otherwise(F.lit(0.0))


def near_dup_pairs(docs: DataFrame, threshold: float = 0.85, permutations: int = 128) -> DataFrame:
    """(a, b) of documents whose estimated Jaccard is ``threshold`` at least; equal signatures pair with their least document only.

    Two texts agree at a place where one shingle has the least digest of both,
    so places at which a text's own shingles are least agree with none: texts
    with too many of those go first, mostly before all their shingles are
    hashed. Equal texts are signed once. Two signatures that differ in ``d``
    places at most agree on the whole of one of d + 1 bands, so no pair is lost.
    They are made in steps: a text whose places of no band so far are those of
    another text links with none, and its other places are not hashed.
    Signatures of large near-copy groups are compared pair by pair.
    """
    most = permutations - math.ceil(threshold * permutations - 1e-9)
    bands = most + 1
    spark, table = docs.sparkSession, Scratch()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))  # given by number, as few bytes can be much work
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL").withColumn("key", F.xxhash64("text"))

    def worded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            has = pa.array([bool(normal(t)) for t in b.column(2).to_pylist()], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["doc_id", "key"]).filter(has)

    def signing(places: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                more = pa.array([minhash(t, permutations, places) for t in b.column(2).to_pylist()], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*b.columns, more], [*b.schema.names, "more"])

        return run

    own = table(texts.select("doc_id", "key", "text").mapInArrow(worded, "doc_id long, key long"), "keys")
    once = texts.select("key", "text")
    shared = table(shared_codes(once, parts), "shared")
    none = F.array().cast("array<long>")
    signed = table(candidates(once, shared, parts, permutations, most), "alike").withColumns({"sig": none, "bands": F.array_repeat(F.lit(0).cast("long"), bands)})
    for step in band_steps(permutations, bands):
        at = [sum(map(len, step[:i])) + 1 for i in range(bands)]
        # near copies follow each other, so that their digests are made once; a large group is split
        dealt = signed.repartitionByRange(parts, "near", "key").sortWithinPartitions("near", "key")
        made = dealt.mapInArrow(signing(sum(step, [])), "key long, near long, text string, sig array<long>, bands array<long>, more array<long>")
        part = F.array(*(F.xxhash64(F.lit(i), F.col("bands")[i], F.slice("more", at[i], len(step[i]))) for i in range(bands)))
        made = table(made.select("key", "near", "text", F.concat("sig", "more").alias("sig"), part.alias("bands")), "signatures")
        spread = made.select("key", F.explode("bands").alias("band"))
        both = spread.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
        signed = table(made.join(spread.join(both, "band").select("key").distinct(), "key", "left_semi"), "signatures")
    signed = signed.drop("near", "text")
    members = own.select("doc_id", "key").join(signed, "key")
    reps = table(members.groupBy("sig", "bands").agg(F.min("doc_id").alias("rep")), "reps")
    equal = members.select("doc_id", "sig").join(reps, "sig").where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    alone = own.join(signed.select("key"), "key", "left_anti")
    alone = alone.join(alone.groupBy("key").agg(F.min("doc_id").alias("a")), "key").where("doc_id <> a").select("a", F.col("doc_id").alias("b"))
    banded = reps.select("rep", F.explode("bands").alias("key"))
    pairs = banded.select(F.col("rep").alias("a"), "key").join(banded.select(F.col("rep").alias("b"), "key"), "key").where("a < b").select("a", "b").distinct()
    pairs = pairs.join(reps.select(F.col("rep").alias("a"), F.col("sig").alias("sa")), "a").join(reps.select(F.col("rep").alias("b"), F.col("sig").alias("sb")), "b")
    return pairs.where(estimated_jaccard(F.col("sa"), F.col("sb")) >= threshold).select("a", "b").union(equal).union(alone)


def families_by_keys(docs: DataFrame, keys: Column, key: str = "doc_id") -> DataFrame:
    """(``key``, least): documents that share any of the strings in the array ``keys`` are one family, transitively; null strings link nothing.

    A string's least document links to all others of it, so a string on a third
    of the rows makes as many links as rows.
    """
    own = docs.select(F.col(key).alias("b"), F.explode(keys).alias("_mr_k")).where("_mr_k IS NOT NULL AND b IS NOT NULL")
    edges = own.join(own.groupBy("_mr_k").agg(F.min("b").alias("a")), "_mr_k").select("a", "b")
    labels = components(edges)
    return docs.select(key).where(F.col(key).isNotNull()).distinct().join(labels.withColumnRenamed("node", key), key, "left").select(key, F.coalesce("label", key).alias("least"))


def identity_key(*columns: Column) -> Column:
    """The folded values joined by |, absent ones as -; null if all are absent."""
    canon = [F.nullif(F.trim(F.regexp_replace(casefold(c.cast("string")), r"[^a-z0-9]+", " ")), F.lit("")) for c in columns]
    return F.when(F.coalesce(*canon).isNotNull(), F.concat_ws("|", *(F.coalesce(c, F.lit("-")) for c in canon)))


def assign_groups(docs: DataFrame, identity: tuple[str, ...] = (), layout: str | None = None, threshold: float = 0.85, within: str | None = None) -> DataFrame:
    """Add family and members as exact_families does; documents linked by identity columns, equal text, layout column or near-duplicate text are one family, transitively.

    ``within``: a column, such as the document type, that links must not cross.
    """
    keys = [F.concat(F.lit("text:"), F.sha2("text", 256))] + ([F.concat(F.lit("layout:"), F.nullif(F.col(layout), F.lit("")))] if layout else [])
    if identity:
        keys.append(F.concat(F.lit("identity:"), identity_key(*map(F.col, identity))))
    if within:
        keys = [F.concat(F.coalesce(F.col(within).cast("string"), F.lit("")), F.lit("|"), k) for k in keys]
    edges = near_dup_pairs(docs, threshold)
    if within:
        kind = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col(within).cast("string").alias("_kind")).distinct()
        edges = edges.join(kind.withColumnsRenamed({"_id": "a", "_kind": "_ka"}), "a").join(kind.withColumnsRenamed({"_id": "b", "_kind": "_kb"}), "b").where("_ka <=> _kb").select("a", "b")
    own = docs.select(F.col("doc_id").cast("long").alias("b"), F.explode(F.array(*keys)).alias("_mr_k")).where("_mr_k IS NOT NULL AND b IS NOT NULL")
    edges = edges.union(own.join(own.groupBy("_mr_k").agg(F.min("b").alias("a")), "_mr_k").select("a", "b"))
    labels = components(edges)
    joined = docs.drop("family", "members").join(labels.select(F.col("node").alias("doc_id"), F.col("label").alias("_mr_least")), "doc_id", "left").withColumn("_mr_least", F.coalesce("_mr_least", "doc_id"))
    sizes = joined.groupBy("_mr_least").agg(F.count("*").alias("members")).withColumnRenamed("_mr_least", "_mr_of")
    out = joined.join(sizes, F.col("_mr_least").eqNullSafe(F.col("_mr_of"))).withColumn("family", group_id(F.col("_mr_least")))
    return out.drop("_mr_least", "_mr_of")


def split_families(docs: DataFrame, families: Callable[[DataFrame], DataFrame] = exact_families) -> DataFrame:
    """Each family goes to one split; with assign_groups as ``families`` near copies share it. The volume is counted before, so no window spans the table."""
    n = docs.count()
    return families(docs).withColumn("split", band_split(F.col("family"), F.lit(n)))


def split_groups(groups: DataFrame, seed: int = 42, hold_out: bool = True) -> DataFrame:
    """Add split, held_out, val_half and repaired to rows (kind, group_id, documents, line, carrier, synthetic, pinned), one per family.

    Per kind the shares follow its documents. A synthetic family trains; the
    family of a line's held-out carrier is tested; a line of under MEASURED
    documents trains; the others go by the hash of their id. A pinned family,
    once trained, trains again. A measured line of REPAIRED families or more
    whose test or validation is empty gets the family of the highest hash of its
    largest split that may move, if that has two. Carriers: one per line with
    HELD_OUT carriers, that no synthetic family trains, without which the line
    still trains and validates; of these the one whose loss costs the fewest
    documents. Repair and choice look at a line's families at once, which are
    counts of groups, not documents.
    """
    kind = Window.partitionBy("kind")
    total = F.sum("documents").over(kind)
    h = stable_hash(F.col("group_id"), seed)
    rows = groups.withColumns({"_mr_h": h, "_mr_by": band_split(F.col("group_id"), total), "_mr_pin": F.coalesce(F.col("pinned"), F.lit(False)) & ~F.col("synthetic")})
    rows = rows.withColumn("_mr_lines", F.sum("documents").over(Window.partitionBy("kind", "line")))
    held = F.lit(False)
    if hold_out:
        real = rows.where(~F.col("synthetic") & F.col("line").isNotNull() & F.col("carrier").isNotNull()).withColumn("_s", F.when(F.col("_mr_pin"), "train").otherwise(F.col("_mr_by")))
        lines = real.groupBy("kind", "line").agg(F.count_distinct("carrier").alias("_carriers"), *(F.count_distinct(F.when(F.col("_s") == s, F.col("carrier"))).alias(f"_{s}") for s in ("train", "val")))
        each = real.groupBy("kind", "line", "carrier").agg(F.sum(F.when(F.col("_s") != "test", F.col("documents")).otherwise(0)).alias("_cost"), *(F.max((F.col("_s") == s).cast("int")).alias(f"_has_{s}") for s in ("train", "val")))
        made = rows.where(F.col("synthetic")).select("kind", "line", "carrier").distinct()
        fit = each.join(lines, ["kind", "line"]).where(F.col("_carriers") >= HELD_OUT).where("_train > _has_train AND _val > _has_val").join(made, ["kind", "line", "carrier"], "left_anti")
        salted = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:carrier:"), F.col("line"), F.lit(":"), F.col("carrier")), 256), 1, 16), 16, 10).cast("decimal(20,0)")
        chosen = fit.groupBy("kind", "line").agg(F.min_by("carrier", F.struct("_cost", salted)).alias("_mr_held"))
        rows = rows.join(chosen, ["kind", "line"], "left")
        held = F.coalesce(F.col("carrier") == F.col("_mr_held"), F.lit(False)) & ~F.col("synthetic")
    small = F.col("line").isNotNull() & (F.col("_mr_lines") < MEASURED)
    first = F.when(F.col("synthetic") | F.col("_mr_pin"), "train").when(held, "test").when(small, "train").otherwise(F.col("_mr_by"))
    rows = rows.withColumns({"split": first, "held_out": held & ~F.col("_mr_pin")})

    def repaired(rows: DataFrame, empty: str) -> DataFrame:
        line = Window.partitionBy("kind", "line")
        moves = ~F.col("synthetic") & ~F.col("_mr_pin")
        count = lambda c: F.count_if(c).over(line)
        rows = rows.withColumns({f"_mr_n_{s}": count(moves & (F.col("split") == s)) for s in ("train", "val", "test")})
        most = F.greatest(*(F.col(f"_mr_n_{s}") for s in ("train", "val", "test")))
        rows = rows.withColumns({"_mr_donor": F.when(F.col("_mr_n_train") == most, "train").when(F.col("_mr_n_val") == most, "val").otherwise("test"), "_mr_most": most, "_mr_empty": count(F.col("split") == empty) == 0, "_mr_groups": F.count("*").over(line)})
        may = moves & (F.col("split") == F.col("_mr_donor")) & F.col("_mr_empty") & (F.col("_mr_most") >= 2) & (F.col("_mr_groups") >= REPAIRED) & (F.col("line").isNull() | (F.col("_mr_lines") >= MEASURED))
        rows = rows.withColumn("_mr_top", F.max(F.when(may, F.struct("_mr_h", "group_id"))).over(line))
        moved = may & (F.col("_mr_top.group_id") == F.col("group_id"))
        return rows.withColumns({"split": F.when(moved, F.lit(empty)).otherwise(F.col("split")), "repaired": F.coalesce(F.col("repaired") | moved, F.lit(False))})

    rows = repaired(repaired(rows.withColumn("repaired", F.lit(False)), "test"), "val")
    half = F.when(F.col("split") == "val", F.when(stable_hash(F.col("group_id"), seed, "valhalf") < 0.5, "calibration").otherwise("threshold"))
    return rows.select(*groups.columns, "split", "held_out", half.alias("val_half"), "repaired")


def leakage(docs: DataFrame, key: str) -> DataFrame:
    """Keys that stand in two splits, with their numbers."""
    return docs.groupBy(key).agg(F.count_distinct("split").alias("splits"), F.count("*").alias("n")).where("splits > 1")


def violations(rows: DataFrame) -> DataFrame:
    """(problem, key) of rows (source_id, group_id, split, synthetic, tenant): groups and sources in two splits, synthetic sources outside train, tenants beside the first."""
    two = lambda key, name: rows.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("key")).agg(F.count_distinct("split").alias("_n")).where("_n > 1").select(F.lit(name).alias("problem"), "key")
    escaped = rows.where("synthetic AND split <> 'train' AND source_id IS NOT NULL").select(F.lit("synthetic outside train").alias("problem"), F.col("source_id").cast("string").alias("key")).distinct()
    tenants = rows.groupBy(F.coalesce(F.col("tenant").cast("string"), F.lit("")).alias("key")).agg(F.lit(1).alias("_one"))
    least = tenants.agg(F.min("key").alias("_least"))
    others = tenants.join(F.broadcast(least)).where("key <> _least").select(F.lit("second tenant").alias("problem"), "key")  # least is one row
    return two("group_id", "group in two splits").union(two("source_id", "source in two splits")).union(escaped).union(others)


def modes(docs: DataFrame, epochs: int = 4, seed: int = 42, key: str = "doc_id") -> DataFrame:
    """A row per document and epoch with a mode drawn by the hash of seed, epoch and document."""
    drawn = docs.drop("epoch", "mode").withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))
    h, mode = draw(F.col(key), F.col("epoch"), seed), F.lit(MODES[-1][0])
    for name, upto in reversed(MODES[:-1]):
        mode = F.when(h < upto, name).otherwise(mode)
    return drawn.withColumn("mode", mode)


def mix_drift(drawn: DataFrame, tolerance: float = 0.05, least: int = 900) -> DataFrame:
    """mode, share, target of the modes whose share is further from its target than ``tolerance``; none under ``least`` draws."""
    counts = drawn.groupBy("mode").agg(F.count("*").alias("_n"))
    total = F.sum("_n").over(Window.partitionBy())  # three rows
    targets = F.create_map(*(F.lit(x) for (name, upto), before in zip(MODES, (0.0, *(u for _, u in MODES)), strict=False) for x in (name, round(upto - before, 6))))
    return counts.select("mode", (F.col("_n") / total).alias("share"), targets[F.col("mode")].alias("target"), total.alias("_total")).where((F.col("_total") >= least) & (F.abs(F.col("share") - F.col("target")) > tolerance)).drop("_total")


def _twin_order(key: Column, salt: str, seed: int) -> list[Column]:
    return [raw_hash(key, seed, salt), key]


def cap_twins(docs: DataFrame, family: str, most: int = 20, seed: int = 42, key: str = "doc_id", mode: str | None = None, counts: Column | None = None) -> DataFrame:
    """At most ``most`` rows of each family (and render mode), by seeded hash, then id. Rows for which ``counts`` does not hold, such as real documents, all stay.

    Each task keeps its own first ``most`` rows of a family before the shuffle.
    """
    if not docs.columns:
        return docs
    counted = F.coalesce(counts, F.lit(False)) if counts is not None else F.lit(True)
    by = [F.col(family), *([F.coalesce(F.col(mode), F.lit("default"))] if mode else [])]
    rows = docs.withColumns({"_mr_c": counted, "_mr_o": F.struct(*(x.alias(f"o{i}") for i, x in enumerate(_twin_order(F.col(key), "twin-cap", seed)))), "_mr_p": F.spark_partition_id()})
    first = rows.where("_mr_c").withColumn("_mr_r", F.row_number().over(Window.partitionBy(*by, "_mr_p").orderBy("_mr_o"))).where(F.col("_mr_r") <= most)
    last = first.withColumn("_mr_r", F.row_number().over(Window.partitionBy(*by).orderBy("_mr_o"))).where(F.col("_mr_r") <= most)
    kept = last.select(*docs.columns)
    return kept if counts is None else kept.unionByName(rows.where("NOT _mr_c").select(*docs.columns))


def rotation(docs: DataFrame, family: str, take: int = 2, epochs: int = 4, seed: int = 42, key: str = "doc_id") -> DataFrame:
    """Epoch e takes the next ``take`` members of each family in seeded order, wrapping around; a column epoch is added."""
    by = Window.partitionBy(family)
    order = by.orderBy(raw_hash(F.concat(F.col(family).cast("string"), F.lit(":"), F.col(key).cast("string")), seed, "data_mix:twin_rotation"), key)
    sizes = docs.groupBy(F.col(family).alias("_mr_f")).agg(F.count("*").alias("_mr_n"))
    ranked = docs.drop("epoch").withColumn("_mr_r", F.row_number().over(order) - 1).join(sizes, F.col(family).eqNullSafe(F.col("_mr_f")))
    every = ranked.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))
    k = F.least(F.lit(take), F.col("_mr_n"))
    return every.where(F.pmod(F.col("_mr_r") - (F.col("epoch") - 1) * k, F.col("_mr_n")) < k).drop("_mr_r", "_mr_n", "_mr_f")


def rehearsal(docs: DataFrame, line: str, carrier: str, old: Column, share: float, epochs: int = 4, seed: int = 42, key: str = "doc_id") -> DataFrame:
    """Every epoch all new documents and, of each line, the next ``share`` of the old ones, whose carriers are spread evenly; a column epoch is added."""
    rows = docs.drop("epoch").withColumns({"_mr_old": F.coalesce(old, F.lit(False)), "_mr_c": F.coalesce(F.col(carrier).cast("string"), F.lit("unknown"))})
    past = rows.where("_mr_old")
    rank = F.row_number().over(Window.partitionBy(line, "_mr_c").orderBy(raw_hash(F.col(key), seed, "data_mix:rehearsal"), key)) - 1
    sizes = past.groupBy(F.col(line).alias("_mr_l"), F.col("_mr_c").alias("_mr_cc")).agg(F.count("*").alias("_mr_n"))
    lines = past.groupBy(F.col(line).alias("_mr_ll")).agg(F.count("*").alias("_mr_all"))
    spread = past.withColumn("_mr_i", rank).join(sizes, F.col(line).eqNullSafe(F.col("_mr_l")) & (F.col("_mr_c") == F.col("_mr_cc")))
    spread = spread.withColumn("_mr_at", (F.col("_mr_i") + stable_hash(F.col("_mr_c"), seed, "data_mix:rehearsal_carrier")) / F.col("_mr_n"))
    place = F.row_number().over(Window.partitionBy(line).orderBy("_mr_at", raw_hash(F.col("_mr_c"), seed, "data_mix:rehearsal_carrier"), key)) - 1
    spread = spread.withColumn("_mr_place", place).join(lines, F.col(line).eqNullSafe(F.col("_mr_ll")))
    k = F.least(F.col("_mr_all"), F.greatest(F.lit(1), F.floor(F.lit(share) * F.col("_mr_all") + 0.5)))
    each = F.explode(F.sequence(F.lit(1), F.lit(epochs)))
    taken = spread.withColumn("epoch", each).where(F.pmod(F.col("_mr_place") - (F.col("epoch") - 1) * k, F.col("_mr_all")) < k)
    return taken.select(*docs.drop("epoch").columns, "epoch").unionByName(rows.where("NOT _mr_old").withColumn("epoch", each).select(*docs.drop("epoch").columns, "epoch"))


def round_robin(docs: DataFrame, family: str, seed: int = 42, key: str = "doc_id") -> DataFrame:
    """Add turn and place: first one document of every family, then the second of each; families and documents in seeded order. Sort by both for the order."""
    own = F.row_number().over(Window.partitionBy(family).orderBy(raw_hash(F.col(key), seed, "data_mix"), key)) - 1
    return docs.drop("turn", "place").withColumns({"turn": own, "place": raw_hash(F.col(family), seed, "data_mix")})


def stratified_sample(docs: DataFrame, strata: list[str], size: int, key: str = "doc_id") -> DataFrame:
    """Proportional sample: max(1, floor of the share) rows a stratum; what is left of ``size`` goes one each to the largest fractions that still have rows, ties by stratum; rows by hash, then id.

    A table of ``size`` rows or fewer stays whole. The strata's counts are few;
    of the rows, each task keeps no more than a stratum's quota before the shuffle.
    """
    sizes = docs.groupBy(*strata).agg(F.count("*").alias("_mr_n"))
    total = sizes.agg(F.sum("_mr_n")).first()[0] or 0
    if total <= size:
        return docs
    share = F.col("_mr_n") * F.lit(size) / F.lit(total)
    quota = sizes.withColumns({"_mr_floor": F.greatest(F.lit(1), F.floor(share).cast("long")), "_mr_part": share - F.floor(share)})
    every = Window.partitionBy()  # strata, not rows
    more = F.col("_mr_floor") < F.col("_mr_n")
    place = F.sum(more.cast("long")).over(every.orderBy(F.desc("_mr_part"), *strata))
    quota = quota.withColumns({"_mr_left": F.lit(size) - F.sum("_mr_floor").over(every), "_mr_place": place})
    quota = quota.select(*(F.col(s).alias(f"_mr_s{i}") for i, s in enumerate(strata)), (F.col("_mr_floor") + (more & (F.col("_mr_place") <= F.col("_mr_left"))).cast("long")).alias("_mr_quota"))
    same = [F.col(s).eqNullSafe(F.col(f"_mr_s{i}")) for i, s in enumerate(strata)]
    rows = docs.join(F.broadcast(quota), same).withColumns({"_mr_h": F.sha2(F.col(key).cast("string"), 256), "_mr_p": F.spark_partition_id()})  # a row per stratum
    for part in (["_mr_p"], []):
        rows = rows.withColumn("_mr_r", F.row_number().over(Window.partitionBy(*strata, *part).orderBy("_mr_h", key))).where("_mr_r <= _mr_quota")
    return rows.select(*docs.columns)


def line_repeats(docs: DataFrame, line: str, least: int, most: int = 8, unit: Column | None = None) -> DataFrame:
    """``line``, n, repeats: how often a thin line's rows are repeated to reach the smaller of ``least`` and the largest line, ``most`` times at the utmost; ``unit``: what is counted (distinct), rows if not given."""
    counts = docs.groupBy(line).agg((F.count_distinct(unit) if unit is not None else F.count("*")).alias("n"))
    target = F.least(F.lit(least), F.max("n").over(Window.partitionBy()))  # lines, not rows
    times = F.when(F.col("n") >= target, 1).when(F.col("n") == 0, most).otherwise(F.least(F.lit(most), F.ceil(target / F.col("n"))))
    return counts.withColumn("repeats", times.cast("int") if least > 0 and most > 1 else F.lit(1))


def repeats_to_target(docs: DataFrame, line: str, target: int, most: int = 8) -> DataFrame:
    """Rows of thin lines repeated as ``line_repeats`` says; a column copy, from 1, is added."""
    n = line_repeats(docs, line, target, most).select(F.col(line).alias("_mr_l"), F.col("repeats").alias("_mr_times"))
    joined = docs.drop("copy").join(F.broadcast(n), F.col(line).eqNullSafe(F.col("_mr_l")))  # a row per line
    return joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_mr_times")))).drop("_mr_l", "_mr_times")


def round_robin_pick(docs: DataFrame, line: str, synthetic: str, count: int, salt: str = "shadow-check", key: str = "doc_id") -> DataFrame:
    """``count`` documents, real ones first, one per line in turn, hashed order within a line."""
    rank = F.row_number().over(Window.partitionBy(synthetic, line).orderBy(F.sha2(F.concat(F.lit(f"{salt}:"), F.col(key).cast("string")), 256), key))
    return docs.withColumn("_mr_r", rank).orderBy(synthetic, "_mr_r", line).limit(count).drop("_mr_r")


def interleaved_epochs(docs: DataFrame, key: str, epochs: int) -> DataFrame:
    """``key``, epochs: documents that do not stand once in each of the epochs 1 to ``epochs`` (a column epoch), with the number of epochs they stand in."""
    return docs.groupBy(key).agg(F.count_distinct("epoch").alias("epochs"), F.count("*").alias("_mr_n")).where((F.col("epochs") != epochs) | (F.col("_mr_n") != epochs)).drop("_mr_n")


def cell_splits(groups: DataFrame, cell: str, seed: int = 42, with_test: bool = True) -> DataFrame:
    """Add split to rows (group_id, documents): within each cell the families in hash order, the first train, then val, then test.

    Shares follow the volume of all documents, val and test have one family at
    least; cells under REPAIRED families train whole. A cell's families are few.
    """
    total = groups.agg(F.sum("documents")).first()[0] or 0
    train, upto = next((t, v) for most, t, v in BANDS if most is None or total < most)
    shares = (train, upto - train, 1 - upto) if with_test else (train / upto, 1 - train / upto, 0.0)
    by = Window.partitionBy(cell)
    ranked = groups.withColumns({"_mr_r": F.row_number().over(by.orderBy(stable_hash(F.col("group_id"), seed), "group_id")) - 1, "_mr_n": F.count("*").over(by)})
    tests = F.greatest(F.lit(1), F.bround(F.col("_mr_n") * round(shares[2], 10))) if with_test else F.lit(0)
    vals = F.greatest(F.lit(1), F.bround(F.col("_mr_n") * round(shares[1], 10)))
    trains = F.col("_mr_n") - tests - vals
    split = F.when((F.col("_mr_n") < REPAIRED) | (F.col("_mr_r") < trains), "train").when(F.col("_mr_r") < trains + vals, "val").otherwise("test")
    return ranked.withColumn("split", split).drop("_mr_r", "_mr_n")


def delivered_splits(rows: DataFrame, trained: DataFrame | None = None) -> DataFrame:
    """group_id, split, moved of rows (group_id, source_id, split): one split a family, else an error; families with a trained source go back to train."""
    found = rows.groupBy("group_id").agg(F.collect_set("split").alias("_mr_s"), F.count_if(F.col("split").isNull()).alias("_mr_null"))
    bad = found.where("size(_mr_s) <> 1 OR _mr_null > 0 OR NOT array_contains(array('train', 'val', 'test'), _mr_s[0])").limit(5).collect()
    if bad:
        raise ValueError(f"families without a single delivered split: {[r.group_id for r in bad]}")
    own = found.select("group_id", F.get("_mr_s", F.lit(0)).alias("split"))
    if trained is None:
        return own.withColumn("moved", F.lit(False))
    pinned = rows.join(trained.select("source_id").distinct(), "source_id", "left_semi").select("group_id").distinct().withColumn("_mr_p", F.lit(True))
    joined = own.join(pinned, "group_id", "left")
    back = F.coalesce("_mr_p", F.lit(False)) & (F.col("split") != "train")
    return joined.select("group_id", F.when(back, "train").otherwise(F.col("split")).alias("split"), back.alias("moved"))


def in_share(key: Column, share: float, salt: str) -> Column:
    """Whether the first 48 bits of sha256('salt:key') lie below ``share`` of their range."""
    if share <= 0 or share >= 1:
        return F.lit(share >= 1)
    return F.conv(F.substring(F.sha2(F.concat(F.lit(f"{salt}:"), key.cast("string")), 256), 1, 12), 16, 10).cast("double") / F.lit(float(16**12)) < share


def double_annotation(docs: DataFrame, rate: float, seed: int = 42, key: str = "doc_id") -> DataFrame:
    """Distinct ids in the share; the least id if the share is above 0 and takes none."""
    ids = docs.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_mr_in", stable_hash(F.col(key), seed, "double") < rate)
    some = ids.agg(F.max("_mr_in").alias("_mr_any"), F.min(key).alias("_mr_least"))
    return ids.join(F.broadcast(some)).where(F.col("_mr_in") | (~F.col("_mr_any") & (F.lit(rate) > 0) & (F.col(key) == F.col("_mr_least")))).select(key)  # some is one row


def synthetic_budget(fraction: Column, real: Column, available: Column) -> Column:
    """How many synthetic documents make up ``fraction`` beside the real ones, the available ones at most; all of them without a fraction below 1 or without real ones."""
    wanted = F.floor(fraction * real / (1 - fraction) + 0.5)
    return F.when(fraction.isNull() | (fraction >= 1) | (real == 0), available).otherwise(F.least(available, wanted)).cast("long")


def mixed_lines(docs: DataFrame, line: str, synthetic: str, family: str, fraction: float | None, seed: int = 42, key: str = "doc_id") -> DataFrame:
    """All real documents of every line and its budget of synthetic ones, families in turn."""
    sizes = docs.groupBy(F.col(line).alias("_mr_l")).agg(F.count_if(~F.col(synthetic)).alias("_mr_real"), F.count_if(F.col(synthetic)).alias("_mr_made"))
    budget = synthetic_budget(F.lit(fraction).cast("double"), F.col("_mr_real"), F.col("_mr_made"))
    made = docs.where(F.col(synthetic)).withColumn("_mr_turn", F.row_number().over(Window.partitionBy(line, family).orderBy(raw_hash(F.col(key), seed, "data_mix"), key)))
    made = made.withColumn("_mr_place", F.row_number().over(Window.partitionBy(line).orderBy("_mr_turn", raw_hash(F.col(family), seed, "data_mix"), family)))
    kept = made.join(F.broadcast(sizes), F.col(line).eqNullSafe(F.col("_mr_l"))).where(F.col("_mr_place") <= budget)  # a row per line
    return docs.where(~F.col(synthetic)).unionByName(kept.select(*docs.columns))
