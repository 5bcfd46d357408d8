"""Operators on hand-made rows: nulls, ties, empty tables, clashing names; plain Python versions beside them."""

import hashlib
import json
import math
import random
from itertools import pairwise

import pytest
from pyspark.sql import functions as F

from millrace.operators import families as fam
from millrace.operators import grounding as G
from millrace.operators import lineage, merging
from millrace.operators import metrics as met
from millrace.operators import planning as P
from millrace.operators import sequences as seq
from millrace.operators import statistics as stats


def point(text):
    return int(hashlib.sha256(text.encode()).hexdigest()[:16], 16)


# planning


def test_windows_by_density():
    assert P.by_density([], 1000) == [] and P.by_density([5], 10) == [[1]]
    assert P.by_density([10] * 6, 10_000) == [[1, 2, 3], [3, 4, 5], [5, 6]]
    assert P.by_density([20] * 4, 10_000) == [[1, 2], [2, 3], [3, 4]]
    assert P.by_density([30, 30], 10_000) == [[1], [2]]
    assert P.by_density([10] * 5, 120 * 20) == [[1, 2], [2, 3], [3, 4], [4, 5]]  # shortened to two pages, one shared
    with pytest.raises(ValueError):
        P.by_density([1], 0)


def test_windows_by_sections():
    assert P.consecutive([1, 2, 4, 7, 8]) == [[1, 2], [4], [7, 8]] and P.consecutive([]) == []
    assert P.evenly(list(range(7)), 3) == [[0, 1, 2], [3, 4], [5, 6]] and P.evenly([1], 5) == [[1]]
    assert P.evenly([1, 2, 3, 4, 5], 3, 1) == [[1, 2, 3], [3, 4, 5]] and P.evenly([1, 2, 3], 1, 1) == [[1], [2], [3]]
    for n in range(1, 40):
        for most in range(1, 9):
            for overlap in range(0, most):
                found = P.evenly(list(range(n)), most, overlap)
                assert all(len(w) <= most for w in found) and [p for w in found for p in w[overlap if w is not found[0] else 0 :]] == list(range(n))
                assert all(a[len(a) - overlap :] == b[:overlap] for a, b in pairwise(found))
    assert P.by_sections([5, 1, 2, 9, 10, 11, 12, 4], 3, leading=[1, 99]) == [[1], [2, 4, 5], [9, 10], [11, 12]]
    assert P.by_sections([], 3) == [] and P.by_sections([3, 1], 2) == [[1, 3]]
    assert P.aligned([1, 2, 3, 4, 5], 2, leading=[1], overlap=1) == ([[1]], [[1, 2], [2, 3], [3, 4], [4, 5]])
    assert P.halves([1, 2, 3]) == [[1], [2, 3]] and P.halves([1]) == []


def test_windows_fit_their_room():
    assert P.fitted([[1, 2, 3, 4]], [5, 5, 5, 5], 10) == [[1, 2], [3, 4]] and P.fitted([[1, 2]], [5, 50], 10) == [[1], [2]]
    assert P.fitted([[1, 2, 3], [3, 4, 5]], [4, 4, 4, 4, 4], 8, 1) == [[1, 2], [2, 3], [3, 4], [4, 5]]
    assert P.fitted([[1, 2], [5]], [1, 1, 1, 1, 1], 10) == [[1, 2], [5]]


def test_plans_as_rows(spark):
    df = spark.createDataFrame([("a", [10] * 4), ("b", []), ("c", None)], "id string, d array<int>").withColumn("plan", P.density_plan(F.col("d"), 10_000))
    assert [(r.id, r.window, r.pages) for r in P.planned(df.select("id", "plan"), "plan").orderBy("id", "window").collect()] == [("a", 1, [1, 2, 3]), ("a", 2, [3, 4])]
    df = spark.createDataFrame([("a", [1, 2, 3, 7], [1])], "id string, p array<int>, lead array<int>").withColumn("plan", P.section_plan(F.col("p"), 2, F.col("lead")))
    assert df.first().plan == [[1], [2, 3], [7]]
    assert df.select(P.fitted_plan(F.col("plan"), F.array(*[F.lit(3)] * 7), 3).alias("x")).first().x == [[1], [2], [3], [7]]


# statistics


def test_bootstrap_equals_a_plain_version(spark):
    rng = random.Random(3)
    rows = [("m", f"d{i:03}", rng.random(), rng.random(), rng.randint(1, 5) * 1.0) for i in range(40)] + [("one", "d", 0.5, 0.7, 1.0), ("m", "null", None, 0.5, 1.0)]
    df = spark.createDataFrame(rows, "metric string, doc string, a double, b double, w double")
    for weights in (None, ("w", "w")):
        got = {r.metric: r for r in stats.paired_bootstrap(df, "metric", "doc", "a", "b", weights, margin=0.05, resamples=400).collect()}
        mine = [(r[2], r[3], r[4] if weights else 1.0) for r in rows[:40]]
        draws, deltas = random.Random("42:m"), []
        mean = lambda picks, k: sum(mine[i][k] * mine[i][2] for i in picks) / sum(mine[i][2] for i in picks)  # noqa: E731,B023
        for _ in range(400):
            picks = [draws.randrange(40) for _ in range(40)]
            deltas.append(mean(picks, 1) - mean(picks, 0))
        deltas.sort()
        assert math.isclose(got["m"].lower, deltas[10]) and math.isclose(got["m"].upper, deltas[390]) and got["m"].documents == 40
        assert got["m"].p_value == sum(round(x, 6) <= -0.05 for x in deltas) / 400 and math.isclose(got["m"].observed, mean(range(40), 1) - mean(range(40), 0))
        assert (got["one"].lower, got["one"].upper, got["one"].p_value) == (-1.0, 1.0, 1.0)
    assert stats.paired_bootstrap(df.limit(0), "metric", "doc", "a", "b").count() == 0


def test_holm_and_isotonic(spark):
    df = spark.createDataFrame([("f", "a", 0.01), ("f", "b", 0.04), ("f", "c", 0.03), ("g", "x", 0.2)], "fam string, name string, p double")
    got = {r.name: r for r in stats.holm(df, "fam", "name", "p").collect()}
    assert [(got[n].rank, got[n].shown, got[n].stopped_by) for n in "acbx"] == [(1, True, None), (2, False, None), (3, False, "c"), (1, False, None)]
    assert [round(got[n].adjusted_p, 6) for n in "acb"] == [0.03, 0.06, 0.06]
    points = F.array(*(F.struct(F.lit(x).alias("confidence"), F.lit(y).alias("calibrated")) for x, y in ((0.05, 0.1), (0.55, 0.6), (0.95, 0.8))))
    rows = spark.createDataFrame([(c,) for c in (0.0, 0.05, 0.3, 0.55, 0.75, 1.0)], "c double").select(stats.apply_isotonic(F.col("c"), points))
    assert [round(r[0], 6) for r in rows.collect()] == [0.1, 0.1, 0.35, 0.6, 0.7, 0.8]
    assert spark.range(1).select(stats.apply_isotonic(F.lit(0.4), F.array().cast("array<struct<confidence:double,calibrated:double>>"))).first()[0] == 0.4


def test_temperature_equals_a_plain_version(spark):
    rng = random.Random(8)
    rows = [(rng.choice("ab"), c := rng.random(), rng.random() < c**2) for _ in range(300)]
    got = {r.g: (r.temperature, r.ece) for r in stats.fit_temperature(spark.createDataFrame(rows, "g string, c double, ok boolean"), "g", "c", "ok").collect()}
    for g in "ab":
        best = (9.0, 0.0)
        for i in range(161):
            t, bins = 0.25 + 7.75 * i / 160, {}
            for k, c, ok in rows:
                if k == g:
                    p = 1 / (1 + math.exp(-math.log(c / (1 - c)) / t))
                    bins.setdefault(max(0, math.ceil(p * 10) - 1), []).append((p, ok))
            n = sum(map(len, bins.values()))
            best = min(best, (round(sum(abs(sum(p for p, _ in b) - sum(o for _, o in b)) for b in bins.values()) / n, 4), t))
        assert got[g] == (round(best[1], 4), best[0])


def test_confidences(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()[0]
    assert one(stats.overall_confidence(F.array(F.lit(0.5), F.lit(None), F.lit(1.0)))) == 0.75 and one(stats.overall_confidence(F.array().cast("array<double>"))) is None
    assert one(stats.checked_probability(F.lit(1.0000001))) == 1.0
    with pytest.raises(Exception, match="not a probability"):
        one(stats.checked_probability(F.lit(1.5)))
    timed = spark.createDataFrame([(p, 10.0 + 2 * p) for p in range(1, 13)] + [(0, 5.0)], "p int, s double")
    r = stats.projected_seconds(timed, "p", "s").first()
    assert r.documents == 12 and r.fit == "least_squares" and round(r.per_page, 6) == 2 and r.seconds == 410.0
    assert stats.projected_seconds(timed.limit(5), "p", "s").count() == 0


def test_thresholds_equal_a_plain_version(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), c := rng.choice([0.5, 0.73, 0.9, 0.99, 1.0, rng.random()]), rng.random() < 0.6 + 0.4 * c) for _ in range(2000)]
    got = {r.g: (r.threshold, r.accepted, r.errors) for r in met.thresholds(spark.createDataFrame(rows, "g string, c double, ok boolean"), "g", "c", "ok", 0.1).collect()}
    z = 1.959964

    def bound(e, n):
        p = e / n
        return min(1, (p + z * z / (2 * n) + z * (p * (1 - p) / n + z * z / (4 * n * n)) ** 0.5) / (1 + z * z / n))

    for g in "ab":
        best = None
        for t in reversed([i / 100 for i in range(50, 100)]):
            hit = [ok for k, c, ok in rows if k == g and c >= t]
            if len(hit) < 30 or bound(0, len(hit)) > 0.1:
                continue
            if bound(hit.count(False), len(hit)) > 0.1:
                break
            best = (t, len(hit), hit.count(False))
        assert got.get(g) == best


# merging


def test_claims_of_overlapping_windows(spark):
    row = lambda w, i, **c: ("d", w, i, json.dumps(c))
    rows = [
        row(0, 0, claim_number="A-1", description="Fell", paid=5), row(0, 1, claim_number="A 1", description="Other claim", paid=6), row(0, 2, row_type="Subtotal", paid=11), row(0, 3, note="no key"),
        row(1, 0, claim_number="a1", description="Fell on ice", paid=None, reserved=2), row(1, 1, claim_number="A1", paid=6), row(1, 2, claim_number="B", paid=1), row(2, 0, claim_number="B", paid=2, reserved=3),
    ]
    df = spark.createDataFrame(rows, "doc string, w int, i int, c string")
    got = [(r.place, json.loads(r.claim), r.windows, r.conflicts) for r in merging.merge_claims(df, "doc", "w", "i", "c").orderBy("place").collect()]
    assert got[0][1]["description"] == "Fell on ice" and got[0][1]["paid"] == 5 and got[0][1]["reserved"] == 2 and got[0][2] == 2
    assert got[1][1]["description"] == "Other claim" and got[2][1] == {"note": "no key"}
    assert got[3][1] == {"claim_number": "B", "paid": 2, "reserved": 3} and got[3][3] == ["paid"] and len(got) == 4
    assert merging.merge_claims(df.limit(0), "doc", "w", "i", "c").count() == 0
    assert merging.joined_rows({"a": "x", "b": 1}, {"a": "y", "b": None}) == ({"a": "x", "b": 1}, ["a"])


def test_periods_and_rates(spark):
    claims = spark.createDataFrame([("a", None, 10.0), ("a", None, 5.25), ("b", "p1", 3.0), ("c", None, 1.0), ("d", "p1", 1.0), ("d", None, 2.0)], "document string, period string, paid double")
    printed = spark.createDataFrame([("a", "p1", 15.5), ("b", "p1", 9.0), ("b", None, 3.0), ("d", "p1", 1.0), ("e", "p9", 4.0)], "document string, period string, paid double")
    lines = merging.reconcile_periods(claims, printed, columns=("paid",))
    assert {(r.document, r.period): r.status for r in lines.collect()} == {("a", "p1"): "reconciled", ("b", "p1"): "mismatch", ("b", ""): "reconciled", ("c", "unspecified"): "unverifiable", ("d", "p1"): "reconciled", ("d", "unspecified"): "unverifiable", ("e", "p9"): "mismatch"}
    status = merging.reconciliation_status(lines)
    assert {r.document: r.status for r in status.collect()} == {"a": "reconciled", "b": "mismatch", "c": "unverifiable", "d": "reconciled", "e": "mismatch"}
    assert merging.reconciliation_rate(status).first().rate == 0.5 and merging.reconciliation_rate(status.limit(0)).first().rate is None
    left = spark.createDataFrame([(1, "a", None), (2, None, None)], "k int, x string, y string")
    right = spark.createDataFrame([(1, "b", "c"), (3, "d", None)], "k int, x string, y string")
    assert sorted(map(tuple, merging.coalesced(left, right, ["k"], ["x", "y"]).collect())) == [(1, "a", "c"), (2, None, None), (3, "d", None)]


def test_reconcile_has_all_three_results(spark):
    lines = spark.createDataFrame([(1, 10.0), (1, 5.25), (2, 3.0), (3, 1.0)], "k int, a double")
    totals = spark.createDataFrame([(1, 15.5), (2, 9.0), (4, 1.0)], "k int, t double")
    assert {r.k: r.status for r in met.reconcile(lines, totals, "k", "a", "t").collect()} == {1: "reconciled", 2: "mismatch", 3: "unverifiable", 4: "unverifiable"}


def test_even_chunks(spark):
    for n, most, want in ((7, 3, [3, 2, 2]), (6, 4, [3, 3]), (1, 5, [1]), (10, 4, [4, 3, 3])):
        rows = spark.createDataFrame([("d", i, 5, 6) for i in range(n)], "k string, p int, n int, r int")
        found = seq.split_evenly(rows, "k", "p", most)
        sizes = {r.chunk: r["count"] for r in found.groupBy("chunk").count().collect()}
        assert [sizes[i + 1] for i in range(len(want))] == want and found.columns == ["k", "p", "n", "r", "chunk"]


# grounding


PAGES = {1: "The insured is Acme Mfg. Premium $1,250.00 for 12 months, code 007", 2: "", 3: "Total lim1t 1,000,000 of Greensb0ro"}


def test_exact_and_tolerant_grounding():
    exact = {k: G.Page(t) for k, t in PAGES.items()}
    place = lambda v, cited=None: G.placed(v, cited, exact)
    assert place("acme mfg") == ("on_cited_page", [1]) and place("Acme Mfg", [3]) == ("on_other_page", [1]) and place("Acme Corp", [3]) == ("not_printed", [])
    assert place("Acme Corp", [2]) == ("unchecked", []) and place("ab") == ("unchecked", []) and place(None) == ("unchecked", [])
    assert place("$1,250.00")[0] == "on_cited_page" and place("1250")[0] == "on_cited_page" and place("1250.00")[0] == "on_cited_page" and place("$12.00")[0] == "not_printed"
    assert place("007")[0] == "on_cited_page" and place("0012")[0] == "not_printed" and place("1250.50")[0] == "not_printed"
    assert place("Premium Acme")[0] == "on_cited_page" and place("Premium Absent")[0] == "not_printed"
    assert G.placed("x", None, {}) == ("unchecked", []) and G.placed("acme", None, {1: G.Page(None)}) == ("unchecked", [])
    scanned = {k: G.ScannedPage(t) for k, t in PAGES.items()}
    near = lambda v: G.placed(v, None, scanned, tolerant=True)[0]
    assert near("Acme Mfg") == near("lim1t") == near("$1,250.00") == "on_cited_page" and near("insred") == "on_cited_page" and near("insuredx") == "on_cited_page"
    assert near("yes") == near("x") == "unchecked" and near(True) == "unchecked" and near("Nowhere") == "not_printed"
    assert near("Greensboro") == "not_printed"  # a word with a digit on the page is compared as digits
    assert G.readings("1.250") == {1.25, 1250.0} and G.readings("1,250.00") == {1250.0} and G.number("12%") == 12.0 and G.number("a1") is None


def test_grounding_frames(spark):
    values = spark.createDataFrame([("d", "Acme Mfg", [1], "s"), ("d", "Nothing here", None, "s"), ("x", "Acme", None, "s"), ("d", None, None, "s"), ("d", "Acme Mfg", [1], "s")], "doc string, v string, c array<int>, status string")
    pages = spark.createDataFrame([("d", k, t) for k, t in PAGES.items()], "doc string, page int, text string")
    got = sorted(((r.doc, r.v, r.status, r.pages) for r in G.ground(values, pages, "doc", "v", "c").collect()), key=str)
    assert got == sorted([("d", "Acme Mfg", "on_cited_page", [1]), ("d", "Acme Mfg", "on_cited_page", [1]), ("d", "Nothing here", "not_printed", []), ("x", "Acme", "unchecked", []), ("d", None, "unchecked", [])], key=str)
    assert G.ground(values.limit(0), pages, "doc", "v", tolerant=True).count() == 0
    found = G.exact_phrases(spark.createDataFrame([(1, "acme  MFG!"), (2, "mfg premium for"), (3, None), (4, "")], "i int, item string"), pages, "item", "text")
    assert [(r.i, r.page) for r in found.collect()] == [(1, 1)]
    with pytest.raises(ValueError):
        G.exact_phrases(values, pages, "v", "text", bound=1)


# families, splits and samples

DOCS = "doc_id long, text string, n int, r int, rank int, members int, copy int, _rank int, line string, family string"


def docs_of(spark, rows):
    return spark.createDataFrame([(d, t, 7, 7, 7, 7, 7, 7, line, "old") for d, t, line in rows], DOCS)


def test_exact_families_of_odd_rows(spark):
    docs = docs_of(spark, [(1, "a", "x"), (2, "a", "x"), (2, "a", "x"), (3, None, "y"), (4, None, None), (None, "b", "z"), (None, None, "z")])
    got = fam.exact_families(docs).collect()
    group = lambda x: "grp-" + hashlib.sha256(str(x).encode()).hexdigest()[:12]
    assert sorted((str(r.doc_id), r.text, r.family, r.members) for r in got if r.text == "a" or r.doc_id == 3) == sorted([("1", "a", group(1), 3), ("2", "a", group(1), 3), ("2", "a", group(1), 3), ("3", None, group(3), 1)], key=str)
    assert all((r.n, r.r, r.rank, r.copy, r["_rank"]) == (7,) * 5 for r in got) and len(got) == 7
    assert fam.exact_families(docs.limit(0)).count() == 0 and fam.split_families(docs.limit(0)).count() == 0


def test_samples_keep_columns_and_share_what_is_left(spark):
    docs = docs_of(spark, [(i, "t", "big" if i < 60 else "mid" if i < 90 else f"s{i}") for i in range(100)])
    got = fam.stratified_sample(docs, ["line"], 30)
    assert got.columns == docs.columns and all(r.rank == 7 for r in got.collect())
    counts = {r.line: r["count"] for r in got.groupBy("line").count().collect()}
    assert counts["big"] == 18 and counts["mid"] == 9 and sum(counts.values()) == 37  # each small stratum its one row
    best = sorted(range(60), key=lambda i: hashlib.sha256(str(i).encode()).hexdigest())[:18]
    assert sorted(r.doc_id for r in got.where("line = 'big'").collect()) == sorted(best)
    # a full stratum passes its share on to the next
    few = docs_of(spark, [(i, "t", "a" if i < 1 else "b" if i < 6 else "c") for i in range(11)])
    assert {r.line: r["count"] for r in fam.stratified_sample(few, ["line"], 9).groupBy("line").count().collect()} == {"a": 1, "b": 4, "c": 4}
    assert fam.stratified_sample(few, ["line"], 50).count() == 11 and fam.stratified_sample(few.limit(0), ["line"], 5).count() == 0
    assert {(r.line, r.repeats) for r in fam.line_repeats(docs, "line", 400, most=20).where("line IN ('big', 'mid', 's99')").collect()} == {("big", 1), ("mid", 2), ("s99", 20)}
    copies = fam.repeats_to_target(docs, "line", 60, most=3)
    assert copies.columns == [c for c in docs.columns if c != "copy"] + ["copy"] and copies.where("line = 'mid'").count() == 60


def test_twins_and_rotations(spark):
    docs = docs_of(spark, [(i, "t", "ab"[i % 2]) for i in range(50)])
    kept = sorted(r.doc_id for r in fam.cap_twins(docs, "line", 5).where("line = 'a'").collect())
    assert kept == sorted(sorted(range(0, 50, 2), key=lambda i: (point(f"42:twin-cap:{i}"), i))[:5])
    real = fam.cap_twins(docs, "line", 5, counts=F.col("doc_id") < 40)
    assert real.where("doc_id >= 40").count() == 10 and real.where("doc_id < 40").count() == 10 and real.columns == docs.columns
    turns = fam.rotation(docs, "line", take=10, epochs=4)
    order = sorted(range(0, 50, 2), key=lambda i: (point(f"42:data_mix:twin_rotation:a:{i}"), i))
    for e in range(1, 5):
        assert {r.doc_id for r in turns.where(f"line = 'a' AND epoch = {e}").collect()} == {order[((e - 1) * 10 + i) % 25] for i in range(10)}
    assert fam.interleaved_epochs(turns, "doc_id", 4).count() > 0
    drawn = {(r.doc_id, r.epoch): r["mode"] for r in fam.modes(docs.select("doc_id"), 2).collect()}
    for (i, e), mode in drawn.items():
        x = point(f"42:{e}:{i}") / 2**64
        assert mode == ("text" if x < 0.5 else "image" if x < 0.7 else "both")
    assert fam.mix_drift(fam.modes(docs.select("doc_id"), 2)).count() == 0
    assert fam.mix_drift(docs.select(F.lit("text").alias("mode")), least=10).collect()[0].target == 0.5
    order = [r.doc_id for r in fam.round_robin(docs, "line").orderBy("turn", "place").collect()]
    assert {i % 2 for i in order[:2]} == {0, 1} and len(order) == 50
    assert fam.round_robin_pick(docs.withColumn("synthetic", F.col("doc_id") > 9), "line", "synthetic", 6).where("synthetic").count() == 0


def plain_split(groups, seed=42):
    """One kind: the rules of the split, family by family."""
    h = lambda g, salt="": point(f"{seed}:{salt}:{g}") / 2**64
    total = sum(g["documents"] for g in groups)
    train, val = (0.70, 0.88) if total < 200 else (0.75, 0.90) if total < 1000 else (0.80, 0.90)
    by_hash = lambda g: "train" if h(g) < train else "val" if h(g) < val else "test"
    pinned = lambda g: g["pinned"] and not g["synthetic"]
    held = {}
    for line in {g["line"] for g in groups if g["line"]}:
        real = [g for g in groups if g["line"] == line and not g["synthetic"] and g["carrier"]]
        first = lambda g: "train" if pinned(g) else by_hash(g["group_id"])
        carriers = {g["carrier"] for g in real}
        if len(carriers) < 10:
            continue
        made = {g["carrier"] for g in groups if g["line"] == line and g["synthetic"]}
        fit = [c for c in carriers - made if {"train", "val"} <= {first(g) for g in real if g["carrier"] != c}]
        if fit:
            held[line] = min(fit, key=lambda c: (sum(g["documents"] for g in real if g["carrier"] == c and first(g) != "test"), h(c, f"carrier:{line}")))  # noqa: B023
    out, halves = {}, {}
    for line in {g["line"] for g in groups}:
        own = sorted((g for g in groups if g["line"] == line), key=lambda g: g["group_id"])
        measured = sum(g["documents"] for g in own) >= 5
        split = {}
        for g in own:
            s = "train" if g["synthetic"] else "test" if line and g["carrier"] and held.get(line) == g["carrier"] else "train" if line and not measured else by_hash(g["group_id"])
            split[g["group_id"]] = "train" if pinned(g) else s
        if (measured or line is None) and len(own) >= 3:
            movable = {g["group_id"] for g in own if not g["synthetic"] and not pinned(g)}
            for empty in ("test", "val"):
                if empty not in split.values():
                    donor = max(("train", "val", "test"), key=lambda s: len([g for g in movable if split[g] == s]))  # noqa: B023
                    may = [g for g in movable if split[g] == donor]
                    if len(may) > 1:
                        split[max(may, key=h)] = empty
        out |= split
    return out


def test_group_splits_equal_a_plain_version(spark):
    rng = random.Random(12)
    groups = []
    for i in range(400):
        line = rng.choice(["auto", "home", "tiny", None, "cargo"]) if i % 40 else f"rare{i}"
        groups.append({"kind": "policy", "group_id": f"g{i:04}", "documents": rng.randint(1, 6), "line": line, "carrier": f"c{rng.randint(0, 14)}" if rng.random() < 0.8 else None, "synthetic": rng.random() < 0.2, "pinned": rng.random() < 0.1})
    groups = [g for g in groups if g["line"] != "tiny" or int(g["group_id"][1:]) < 20]
    groups += [{"kind": "policy", "group_id": f"q{i:02}", "documents": 2, "line": f"line{i // 4}", "carrier": None, "synthetic": False, "pinned": i % 9 == 0} for i in range(40)]
    schema = "kind string, group_id string, documents long, line string, carrier string, synthetic boolean, pinned boolean"
    rows = [tuple(g[k.split()[0]] for k in schema.split(", ")) for g in groups]
    got = fam.split_groups(spark.createDataFrame(rows, schema)).collect()
    assert {r.group_id: r.split for r in got} == plain_split(groups)
    assert any(r.held_out for r in got) and any(r.repaired for r in got) and {r.val_half for r in got if r.split == "val"} == {"calibration", "threshold"}
    assert fam.split_groups(spark.createDataFrame([], schema)).count() == 0


def test_keys_and_violations(spark):
    docs = spark.createDataFrame([("a", ["n:1", "p:9"]), ("b", ["p:9", None]), ("c", ["n:2"]), ("d", []), ("e", None)], "doc_id string, keys array<string>").withColumn("id", F.ascii("doc_id").cast("long"))
    assert {r.id: r.least for r in fam.families_by_keys(docs, F.col("keys"), "id").collect()} == {97: 97, 98: 97, 99: 99, 100: 100, 101: 101}
    rows = spark.createDataFrame([("s1", "g1", "train", False, "t"), ("s2", "g1", "val", False, "t"), ("s3", "g3", "val", True, "u"), (None, "g4", "train", True, "t")], "source_id string, group_id string, split string, synthetic boolean, tenant string")
    assert sorted(map(tuple, fam.violations(rows).collect())) == [("group in two splits", "g1"), ("second tenant", "u"), ("synthetic outside train", "s3")]
    assert fam.violations(rows.limit(0)).count() == 0


# lineage


def test_lineage(spark):
    index = spark.createDataFrame([("r1", None, "v1", "promoted", "2026-01-01"), ("r2", "r1", "v2", "promoted", "2026-02-01"), ("r3", "r2", "v3", "failed", "2026-03-01"), ("x", "y", "v1", "draft", "2026-04-01"), ("y", "x", "v9", "draft", "2026-04-02")], "run_id string, parent_run_id string, version string, status string, created_at string")
    got = {(r.run, r.ancestor): r.steps for r in lineage.ancestors(index).collect()}
    assert got["r3", "r1"] == 2 and got["r3", "r3"] == 0 and got["x", "y"] == 1 and len(got) == 1 + 2 + 3 + 2 + 2
    corpus = spark.createDataFrame([("r1", "s1"), ("r2", "s2"), ("r2", "s1")], "run_id string, source_id string")
    assert {(r.run_id, r.source_id) for r in lineage.trained_documents(index, corpus).collect()} == {("r1", "s1"), ("r2", "s1"), ("r2", "s2"), ("r3", "s1"), ("r3", "s2")}
    assert lineage.tagged(index, "v1").first().run_id == "r1" and lineage.tagged(index, "nothing").count() == 0
    full = index.withColumns({"is_sweep_run": F.col("run_id") == "y", "scope": F.lit(None).cast("string"), "run_type": F.lit("t"), "doc_type": F.lit("d")})
    assert lineage.runs(full, status="draft").count() == 1 and lineage.runs(full, status="draft", sweeps=True).count() == 2 and lineage.runs(full, scope="unified").count() == 4
    assert lineage.latest(index, ["version"], ["created_at"]).where("version = 'v2'").first().run_id == "r2"
    releases = spark.createDataFrame([("a", "t", "promoted", "v1"), ("b", "t", "draft", "v2"), ("c", "u", "promoted", "v3")], "release_id string, tenant_id string, status string, version string")
    assert {r.release_id: r.status for r in lineage.promoted(releases, "b", "t").collect()} == {"a": "archived", "b": "promoted", "c": "promoted"}
    assert lineage.versions(index, releases).count() == 5
    assert {r.table: r.rows for r in lineage.purge_plan(F.lit("s1"), {"corpus": corpus, "none": corpus.limit(0)}).collect()} == {"corpus": 2, "none": 0}
    assert lineage.not_in(corpus, corpus.where("run_id = 'r1'"), ["source_id"]).count() == 1
    golds = spark.createDataFrame([("s1", "h1"), ("s2", "h2")], "source_id string, gold_sha256 string")
    assert [r[0] for r in lineage.changed_golds(golds, golds.replace("h2", "old")).collect()] == ["s2"]


# metrics


def test_reports(spark):
    results = spark.createDataFrame([("a", "x", "x", True, True), ("a", "x", None, False, False), ("b", None, "y", False, False), ("b", "x", "z", False, False), ("c", "x", "x", True, False)], "path string, expected string, got string, correct boolean, exact boolean")
    tallies = met.error_tallies(results, ["path"])
    assert {r.path: (r.n, r.wrong, r.missed, r.invented, r.rate) for r in tallies.collect()} == {"a": (2, 0, 1, 0, 0.5), "b": (2, 1, 0, 1, 1.0), "c": (1, 0, 0, 0, 0.0)}
    assert [(r.path, r.error_rate) for r in met.hard_fields(tallies, "path", 5, least=2).collect()] == [("b", 1.0), ("a", 0.5)]
    assert met.worst(tallies, "path", "rate", "n").first().name == "c"
    assert met.accepted_errors(results.withColumn("k", F.lit(0.9)), spark.createDataFrame([("a", 0.8), ("b", 0.95)], "path string, threshold double"), "path", "k", "correct").first().asDict() == {"accepted": 2, "errors": 1, "rate": 0.5}
    review = spark.createDataFrame([(0.5, 0.7), (0.9, 0.7), (None, 0.7), (0.9, None)], "c double, t double").select(met.needs_review(F.col("c"), F.col("t")))
    assert [r[0] for r in review.collect()] == [True, False, True, True]
    steps = spark.createDataFrame([("r", s, loss) for s, loss in ((100, 0.5), (200, 0.1), (300, 0.4), (400, None), (500, 0.3), (600, 0.2))], "run string, step int, loss double")
    assert sorted((r.step, r.best_loss, r.two_thirds) for r in met.candidates(steps, "run", "step", "loss").collect()) == [(200, True, False), (400, False, True), (500, False, False), (600, False, False)]
    shapes = spark.createDataFrame([("a", "date"), ("a", "name"), ("b", "date"), ("b", None)], "path string, shape string")
    assert [(r.path, r.shapes) for r in met.spellings(shapes, ["path"], "shape").collect()] == [("a", ["date", "name"])]
    labels = spark.createDataFrame([("f", "seen", 10, 0.9), ("f", "rare", 2, 0.5), ("g", "seen", 1, 1.0)], "field string, label string, n int, accuracy double")
    gap = met.generalisation_gap(labels, "field", "label", F.col("label") == "rare").collect()
    assert [(r.field, round(r.gap, 6)) for r in gap] == [("f", 0.4)]
