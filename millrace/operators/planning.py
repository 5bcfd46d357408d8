"""Windows over the pages of a document: how many pages are read at once, and which.

A plan is one value per document, made where the document's row is; pages are
numbers from 1. ``planned`` turns a plan into rows.
"""

from __future__ import annotations

from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import column

# Rows a page up to which so many pages with such an overlap are read; beyond them one page; tokens of a row.
DENSITY_BANDS = ((12, 3, 1), (25, 2, 1))
DENSE = (1, 0)
TOKENS_PER_ROW = 120
PLAN = "array<array<int>>"


def by_density(densities: list[int], budget: int, tokens_per_row: int = TOKENS_PER_ROW) -> list[list[int]]:
    """Windows sized by the rows on their first page, shortened until the rows fit the token budget."""
    if budget <= 0:
        raise ValueError("the budget must be positive")
    n, at, out = len(densities), 0, []
    while at < n:
        size, overlap = next(((s, o) for most, s, o in DENSITY_BANDS if densities[at] <= most), DENSE)
        size = next((s for s in range(size, 1, -1) if sum(densities[at : at + s]) * tokens_per_row <= budget), 1)
        out.append(list(range(at + 1, min(at + size, n) + 1)))
        if out[-1][-1] == n:
            break
        at += max(1, size - overlap)
    return out


def consecutive(pages: list[int]) -> list[list[int]]:
    """Runs of consecutive numbers."""
    cuts = [0, *(i for i, (a, b) in enumerate(pairwise(pages), 1) if b != a + 1), len(pages)]
    return [pages[a:b] for a, b in pairwise(cuts) if a < b]


def evenly(pages: list[int], most: int, overlap: int = 0) -> list[list[int]]:
    """Fewest windows of ``most`` pages that share ``overlap`` with the next, nearly equal, the larger ones first."""
    step = most - overlap
    if step < 1:
        return evenly(pages, most)
    n = max(1, -(-(len(pages) - overlap) // step))
    size, more = divmod(len(pages) + overlap * (n - 1), n)
    starts = [i * (size - overlap) + min(i, more) for i in range(n)]
    return [pages[s : s + size + (i < more)] for i, s in enumerate(starts)]


def by_sections(pages: list[int], most: int, leading: list[int] | None = None, overlap: int = 0) -> list[list[int]]:
    """Leading pages first; then runs of consecutive pages, whole where they fit, packed into windows in order; longer runs are split."""
    if most < 1:
        raise ValueError("a window holds a page at least")
    pages = sorted(set(pages))
    lead = [p for p in pages if p in set(leading or ())]
    out, held = (evenly(lead, most) if lead else []), []
    for run in consecutive([p for p in pages if p not in lead]):
        if len(run) > most or len(held) + len(run) > most:
            out += [held] if held else []
            held = []
        if len(run) > most:
            out += evenly(run, most, overlap)
        else:
            held = held + run
    return out + ([held] if held else [])


def _fitted(window: list[int], cost: dict[int, int], room: int) -> list[list[int]]:
    """A window in parts that fit: as few as greedy filling gives, even ones if those fit too."""
    load = lambda ps: sum(cost.get(p, 0) for p in ps)
    if load(window) <= room:
        return [window]
    parts: list[list[int]] = []
    for p in window:
        if parts and load(parts[-1]) + cost.get(p, 0) <= room:
            parts[-1].append(p)
        else:
            parts.append([p])
    even = evenly(window, -(-len(window) // len(parts)))
    return even if len(even) == len(parts) and all(load(w) <= room for w in even) else parts


def _fitted_run(run: list[int], cost: dict[int, int], room: int, overlap: int) -> list[list[int]]:
    """Pages in order, as many as fit; the next window opens on the last ``overlap`` pages where they are consecutive and leave room."""
    load = lambda ps: sum(cost.get(p, 0) for p in ps)
    out, at = [], 0
    while at < len(run):
        end = at + 1
        while end < len(run) and load(run[at : end + 1]) <= room:
            end += 1
        out.append(run[at:end])
        if end == len(run):
            break
        back = end - overlap
        at = back if back > at and run[end] - run[back] == overlap and load(run[back : end + 1]) <= room else end
    return out


def fitted(windows: list[list[int]], costs: list[int], room: int, overlap: int = 0) -> list[list[int]]:
    """Windows whose pages' costs (of page 1, 2, ...) exceed the room are split; windows that share pages are judged together."""
    cost = dict(enumerate(costs, 1))
    chains: list[list[list[int]]] = []
    for w in windows:
        if chains and not set(chains[-1][-1]).isdisjoint(w):
            chains[-1].append(w)
        else:
            chains.append([w])
    out: list[list[int]] = []
    for chain in chains:
        if all(sum(cost.get(p, 0) for p in w) <= room for w in chain):
            out += chain
        elif overlap:
            out += _fitted_run(sorted({p for w in chain for p in w}), cost, room, overlap)
        else:
            out += [part for w in chain for part in _fitted(w, cost, room)]
    return out


def aligned(pages: list[int], most: int, leading: list[int] | None = None, overlap: int = 0, costs: list[int] | None = None, room: int | None = None) -> tuple[list[list[int]], list[list[int]]]:
    """(windows of the leading pages, the others), one plan for all groups: the others may open on leading pages before them, but hold a page of their own."""
    pages = sorted(set(pages))
    lead = [p for p in pages if p in set(leading or ())]
    rest = [p for p in pages if p not in lead]
    bridged = set(rest)
    if overlap and most > overlap:
        for run in consecutive(rest):
            back = 1
            while back <= overlap and run[0] - back in lead:
                bridged.add(run[0] - back)
                back += 1
    first, others = (evenly(lead, most) if lead else []), by_sections(sorted(bridged), most, overlap=overlap)
    if costs is not None and room is not None:
        first, others = fitted(first, costs, room, overlap), fitted(others, costs, room, overlap)
    return first, [w for w in others if not set(w) <= set(lead)]


def halves(window: list[int]) -> list[list[int]]:
    """A window that failed, cut in two; of one page nothing."""
    return [window[: len(window) // 2], window[len(window) // 2 :]] if len(window) > 1 else []


def density_plan(densities: Column, budget: int, tokens_per_row: int = TOKENS_PER_ROW) -> Column:
    """``by_density`` over an array column; null or empty: no windows."""
    return column(lambda d: by_density(d or [], budget, tokens_per_row), PLAN)(densities)


def section_plan(pages: Column, most: int, leading: Column | None = None, overlap: int = 0) -> Column:
    return column(lambda p, lead: by_sections(p or [], most, lead, overlap), PLAN)(pages, leading if leading is not None else F.array().cast("array<int>"))


def fitted_plan(plan: Column, costs: Column, room: int, overlap: int = 0) -> Column:
    return column(lambda w, c: fitted(w or [], c or [], room, overlap), PLAN)(plan, costs)


def planned(df: DataFrame, plan: str) -> DataFrame:
    """A row per window: ``window`` (from 1) and ``pages`` instead of ``plan``; documents without windows have none."""
    kept = [c for c in df.columns if c not in (plan, "window", "pages")]
    return df.select(*kept, F.posexplode(plan).alias("_at", "pages")).select(*kept, (F.col("_at") + 1).alias("window"), "pages")
