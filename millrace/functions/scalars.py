"""Scalar expressions: stable hashes, ids, text and value normalisers, token estimates, shapes of values.

All are built-in expressions. Null gives null unless a docstring says otherwise.
Texts outside ASCII are folded by Java's rules; ``millrace.functions.values``
has the full Unicode forms.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token estimates, the normal quantiles of the intervals, picture tokens, and the budget of a reading.
CHARS_PER_TOKEN, ANSWER_FACTOR = 3.5, 1.25
Z95, Z90 = 1.959964, 1.644854
PIXELS_PER_TOKEN, RESIZE_FACTOR = 1024, 32
READING_SECONDS, READING_PAGES = 120.0, 200
# Layouts of dates, in the order in which they are tried; the first year that two digits can't mean, counted from today.
DATE_LAYOUTS = ("yyyy-M-d", "M/d/yyyy", "M/d/yy", "d/M/yyyy", "M-d-yyyy", "d-M-yyyy", "yyyy/M/d", "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy", "yyyyMMdd")
YEARS_AHEAD = 10


def raw_hash(value: Column, seed: int = 42, salt: str = "") -> Column:
    """The first 64 bits of sha256('seed:salt:value'), as decimal(20,0)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:{salt}:"), value.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)")


def stable_hash(value: Column, seed: int = 42, salt: str = "") -> Column:
    """A point in [0, 1): ``raw_hash`` over 2^64."""
    return raw_hash(value, seed, salt).cast("double") / F.lit(2.0**64)


def draw(value: Column, epoch: Column, seed: int = 42) -> Column:
    """A point in [0, 1) of a document in an epoch: the first 64 bits of sha256('seed:epoch:value') over 2^64."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), value.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)").cast("double") / F.lit(2.0**64)


def in_sample(value: Column, share: float) -> Column:
    """Whether the first 64 bits of sha256(value) lie below ``share`` of their range; shares of 0 and 1 take none and all."""
    if share <= 0 or share >= 1:
        return F.lit(share >= 1)
    return F.conv(F.substring(F.sha2(value.cast("string"), 256), 1, 16), 16, 10).cast("decimal(20,0)").cast("double") / F.lit(2.0**64) < F.lit(share)


def shard_of(value: Column, count: int) -> Column:
    """Number of the shard, 0 to count - 1, by crc32."""
    return F.crc32(value.cast("binary")) % F.lit(count)


def group_id(least: Column) -> Column:
    return F.concat(F.lit("grp-"), F.substring(F.sha2(least.cast("string"), 256), 1, 12))


def source_id(kind: Column, index: Column, width: int = 4) -> Column:
    """kind_0007; indexes of more digits keep them all. Negative indexes give null."""
    digits = index.cast("string")
    return F.when(index >= 0, F.concat(F.lower(F.trim(kind)), F.lit("_"), F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)))


def parsed_source_id(value: Column) -> Column:
    """(kind, index) of kind_0007; null if it is none."""
    bare = F.trim(value)
    return F.when(bare.rlike(r"^[a-z]+_[0-9]+$"), F.struct(F.regexp_extract(bare, "^([a-z]+)_", 1).alias("kind"), F.regexp_extract(bare, "([0-9]+)$", 1).cast("long").alias("index")))


def parsed_run_id(value: Column) -> Column:
    """(lineage, version) of lineage-v1 or lineage-v1.2, in lower case; null if it is none."""
    bare, shape = F.lower(F.trim(value)), r"^([a-z][a-z0-9_-]*?)-(v[0-9]+(?:\.[0-9]+)*)$"
    return F.when(bare.rlike(shape), F.struct(F.regexp_extract(bare, shape, 1).alias("lineage"), F.regexp_extract(bare, shape, 2).alias("version")))


def casefold(text: Column) -> Column:
    """Lower case with the sharp s as ss; full folding of other scripts would need Python."""
    return F.lower(F.replace(F.replace(text, F.lit("ẞ"), F.lit("ss")), F.lit("ß"), F.lit("ss")))


def folded_words(text: Column) -> Column:
    """ASCII alphanumeric words of the folded text."""
    return F.filter(F.split(F.regexp_replace(casefold(text), "[^0-9a-z]+", " "), " "), lambda w: w != "")


def phrase(text: Column) -> Column:
    """The folded words with a space between: what grounding compares."""
    return F.array_join(folded_words(text), " ")


def slug(text: Column) -> Column:
    """Lower-case ASCII words joined by underscores."""
    return F.array_join(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0)), "_")


def word_shingles(words: Column, width: int) -> Column:
    """Distinct runs of ``width`` words; of fewer words the whole; of none nothing."""
    runs = F.transform(F.sequence(F.lit(1), F.size(words) - width + 1), lambda i: F.array_join(F.slice(words, i, width), " "))
    whole = F.when(F.size(words) > 0, F.array(F.array_join(words, " "))).otherwise(F.array().cast("array<string>"))
    return F.when(F.size(words) >= width, F.array_distinct(runs)).otherwise(whole)


def currency(value: Column) -> Column:
    """Number of a printed amount: all but digits, points and minus signs is left out; an amount in brackets is negated; null if no number is left."""
    raw = F.trim(value)
    bracketed = raw.rlike(r"(?s)^\(.*\)$")
    number = F.regexp_replace(F.when(bracketed, F.substr(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw), r"[^0-9.\-]", "").try_cast("double")
    return F.when(bracketed, -number).otherwise(number)


def identifier(value: Column) -> Column:
    """ASCII letters and digits in upper case; null if there are none. Numbers read as floating point go through ``whole_number`` first."""
    return F.nullif(F.upper(F.regexp_replace(value, "[^A-Za-z0-9]", "")), F.lit(""))


def whole_number(value: Column) -> Column:
    """Text of a floating point number, without the fraction where it is whole."""
    return F.when(value == F.floor(value), F.floor(value).cast("string")).otherwise(value.cast("string"))


def key_text(value: Column) -> Column:
    """A value as row keys compare it: folded, without spaces and separators; null: empty."""
    return F.coalesce(F.regexp_replace(casefold(value), r"[\s\-./_]", ""), F.lit(""))


def iso_date(value: Column, today: Column | None = None) -> Column:
    """The date of a text in any of DATE_LAYOUTS, the first that reads it; null if none does.

    Years of two digits are of this century, or of the last one if that lies
    more than YEARS_AHEAD years after ``today`` (a date; the current one if not
    given).
    """
    raw = F.trim(F.regexp_replace(value, r"(?U)\s+", " "))
    last = F.year(today if today is not None else F.current_date()) + YEARS_AHEAD
    found = []
    for layout in DATE_LAYOUTS:
        day = F.to_date(F.try_to_timestamp(raw, F.lit(layout)))
        if "yyyy" not in layout:
            past = F.try_make_date(F.year(day) - 100, F.month(day), F.day(day)) if hasattr(F, "try_make_date") else F.add_months(day, -1200)
            day = F.when(F.year(day) > last, past).otherwise(day)
        found.append(day)
    return F.coalesce(*found)


def output_date(value: Column, today: Column | None = None) -> Column:
    return F.date_format(iso_date(value, today), "MM/dd/yyyy")


def field_kind(path: Column) -> Column:
    """date, identifier, currency, entity or text, by the words of a path's last part."""
    leaf = casefold(F.regexp_replace(F.element_at(F.split(path, r"\."), -1), r"\[[0-9]*\]", ""))
    ends = lambda words: leaf.rlike("(" + "|".join(words) + ")$")
    return (
        F.when(F.arrays_overlap(F.split(leaf, "_"), F.array(*map(F.lit, ("date", "dates", "dated", "dob")))), "date")
        .when(ends(("_no", "_num", "number")), "identifier")
        .when(ends(("premium", "limit", "deductible", "paid", "reserved", "incurred", "amount", "revenue", "footage")), "currency")
        .when(ends(("name", "carrier", "producer", "insured", "holder")), "entity")
        .otherwise("text")
    )


def canonical_field(path: Column) -> Column:
    """A path without row numbers: [3] as []."""
    return F.regexp_replace(path, r"\[[0-9]+\]", "[]")


def clean_label(raw: Column) -> Column:
    """A printed label without dot leaders, emphasis, list marks and closing punctuation."""
    text = F.regexp_replace(F.regexp_replace(raw, r"\.{3,}", " "), r"\*+", "")
    text = F.regexp_replace(F.regexp_replace(text, r"^[\s*#>|\-]+", ""), r"[\s*:|.]+$", "")
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"\s+", " "), r"^[ :*|\-]+|[ :*|\-]+$", ""))


def form_edition(text: Column) -> Column:
    """(form, printed, edition as MM/YY) of a form number with its edition, like 'CP 00 10 10 12' or 'HO 3 (10/2012)'; null if there is none."""
    value = F.trim(F.regexp_replace(text, r"\s+", " "))
    iso = r"^([A-Z]{2} [A-Z0-9]{2} [0-9]{2}) (0[1-9]|1[0-2]) ([0-9]{2})$"
    part = lambda i: F.regexp_extract(value, iso, i)
    return F.when(value.rlike(iso), F.struct(part(1).alias("form"), F.concat_ws(" ", part(2), part(3)).alias("printed"), F.concat_ws("/", part(2), part(3)).alias("edition")))


def edition_mm_yy(text: Column) -> Column:
    """The first month and year of a text as MM/YY: apart by a separator, else as four digits."""
    spaced, packed = r"(?<![0-9])(0?[1-9]|1[0-2])\s*[-/. ]\s*([0-9]{4}|[0-9]{2})(?![0-9])", r"(?<![0-9])(0[1-9]|1[0-2])([0-9]{2})(?![0-9])"
    made = lambda p: F.concat(F.lpad(F.regexp_extract(text, p, 1), 2, "0"), F.lit("/"), F.right(F.regexp_extract(text, p, 2), F.lit(2)))
    return F.when(text.rlike(spaced), made(spaced)).when(text.rlike(packed), made(packed))


def text_tokens(text: Column) -> Column:
    """Estimate: each digit (of any script) one token, other characters 3.5 to a token, and one; null or empty: 0."""
    digits = F.length(F.regexp_replace(text, r"\P{Nd}+", ""))
    return F.when(F.length(text) > 0, digits + F.floor((F.length(text) - digits) / F.lit(CHARS_PER_TOKEN)).cast("int") + 1).otherwise(0)


def answer_tokens(text: Column) -> Column:
    return F.ceil(text_tokens(text) * F.lit(ANSWER_FACTOR))


def visual_tokens(pages: Column, most_pixels: int) -> Column:
    """Tokens of so many pages at the largest picture; none for no pages."""
    return F.when(pages > 0, pages * F.lit(most_pixels // PIXELS_PER_TOKEN)).otherwise(0).cast("long")


def resized(height: Column, width: Column, least: int, most: int, factor: int = RESIZE_FACTOR) -> Column:
    """(height, width) as multiples of ``factor``, of an area between ``least`` and ``most`` pixels; halves round to even. Null without an area."""
    step = F.lit(float(factor))
    plain = [F.greatest(step, F.bround(x / step) * step) for x in (height, width)]
    shrink, grow = F.sqrt(height * width / F.lit(float(most))), F.sqrt(F.lit(float(least)) / (height * width))
    smaller = [F.greatest(step, F.floor(x / shrink / step) * step) for x in (height, width)]
    larger = [F.ceil(x * grow / step) * step for x in (height, width)]
    area = plain[0] * plain[1]
    pick = lambda i: F.when(area > most, smaller[i]).when(area < least, larger[i]).otherwise(plain[i]).cast("int")
    return F.when((height > 0) & (width > 0), F.struct(pick(0).alias("height"), pick(1).alias("width")))


def image_tokens(height: Column, width: Column, least: int, most: int, factor: int = RESIZE_FACTOR) -> Column:
    size = resized(height, width, least, most, factor)
    return (size["height"].cast("long") * size["width"] / F.lit(factor * factor)).cast("long")


def near_miss(expected: Column, got: Column, share: float = 0.25) -> Column:
    """Whether two different texts are a few edits apart: a quarter of the expected length, one at least."""
    n = F.length(expected)
    close = F.abs(n - F.length(got)) <= F.greatest(F.lit(2.0), n * 0.3)
    edits = F.levenshtein(expected, got)
    return close & (edits > 0) & (edits <= F.greatest(F.lit(1), F.floor(n * share)))


def error_class(expected: Column, got: Column, others: Column | None = None) -> Column:
    """omission, schema_reasoning, invented or perception, for a wrong reading. ``others``: array of all expected values of the document."""
    a, b = F.trim(expected), F.trim(got)
    swapped = F.exists(others, lambda o: (F.trim(o) == b) & ~F.trim(o).eqNullSafe(F.coalesce(a, F.lit("None")))) if others is not None else F.lit(False)
    return F.when(got.isNull() | (got == ""), "omission").when(F.coalesce(swapped, F.lit(False)), "schema_reasoning").when(a.isNull() | (a == ""), "invented").when(near_miss(a, b), "perception").otherwise("schema_reasoning")


def span_confidence(logprobs: Column, method: str = "min") -> Column:
    """min, mean or geomean of a span's token probabilities; an empty span gives null."""
    n = F.nullif(F.size(logprobs), F.lit(0))
    if method == "min":
        return F.array_min(F.transform(logprobs, F.exp))
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)
    if method == "mean":
        return total(F.transform(logprobs, F.exp)) / n
    if method == "geomean":
        return F.exp(total(logprobs) / n)
    raise ValueError(f"unknown method {method!r}")


def reading_budget(pages: Column) -> Column:
    """Seconds allowed for the reading of so many pages."""
    return F.lit(READING_SECONDS) * F.greatest(F.lit(1.0), pages / READING_PAGES)


def value_shape(value: Column, numeric: bool = False) -> Column:
    """date, identifier or name by the look of the text; of a numeric column all values are numbers."""
    if numeric:
        return F.when(value.isNotNull(), "number").otherwise("name")
    return F.when(value.rlike(r"^\d{4}-\d{2}-\d{2}$"), "date").when(value.rlike(r"^[A-Z0-9][A-Z0-9\-/ ]{4,}$"), "identifier").otherwise("name")


def wilson_upper(errors: Column, trials: Column, z: float = Z95) -> Column:
    """Upper end of the Wilson interval for a rate of errors, 1 at most; 1 without trials. Z90 gives the interval at 90 %."""
    n = F.when(trials > 0, trials.cast("double"))
    p = errors / n
    bound = (p + z * z / (2 * n) + z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    return F.when(n.isNull(), F.lit(1.0)).otherwise(F.least(F.lit(1.0), bound))
