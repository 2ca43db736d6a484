"""Secret scan: fixed patterns, and a randomness test battery with false-discovery control.

Pattern spans come from three regular expressions. The battery looks at every
run of 20 or more key characters outside them; of a run that a pattern span cuts,
each stretch of that length that is left. It infers the encoding
(hexadecimal, base 32, base 36, base 64), and asks of each run how badly it fits
characters drawn evenly and independently from that alphabet:

* chi-squared of the symbol counts,
* too few changes of character class (digit, small, capital, other),
* serial correlation of neighbouring symbols.

Three times the smallest of the three p-values is the run's p-value. A run is
cleared as ordinary text when the Benjamini-Hochberg rule at ``FDR`` rejects
randomness; the rule is applied within classes of length (powers of two), since
short runs carry less evidence than long ones. What is not cleared is a span of
kind ``random``. So of the runs cleared in a class, a share of ``FDR`` is
expected to be secrets. The rule needs how many runs have which p-value over
the whole corpus: a histogram of at most 20 classes x 401 steps, from one narrow
pass. The second pass over the texts finds the spans. No row is shuffled.

A text with many spans costs its length and a bounded factor per span: positions are
summed in blocks and pieces are taken from chunks.

Defined results: a null or empty text has no span; repeated rows are scanned
alike; an empty table gives an empty result; other columns are passed through
by :func:`redact`, whatever their names. Positions count code points.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import bind, packed

# Fixed patterns.
ASSIGN = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
    r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")

RUN = r"[A-Za-z0-9+/_-]{20,}"
FDR = 0.01
STEPS_PER_DECADE, LAST_STEP = 20, 400
LAST_CLASS = 23
# Arrays up to this length are folded in one go; code points of a chunk that pieces of a text are taken from.
FEW, CHUNK = 32, 1024

DIGITS, SMALL, CAPITAL = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Encoding, what recognises it, and its alphabet; the first that fits is taken.
ENCODINGS = (
    ("hex", r"^[0-9a-f]+$", DIGITS + "abcdef"),
    ("HEX", r"^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("base32", r"^[A-Z2-7]+$", CAPITAL + "234567"),
    ("base36", r"^[0-9a-z]+$", DIGITS + SMALL),
    ("BASE36", r"^[0-9A-Z]+$", DIGITS + CAPITAL),
    ("base64url", r"^[A-Za-z0-9_-]+$", DIGITS + SMALL + CAPITAL + "_-"),
    ("base64", r"^[A-Za-z0-9+/_-]+$", DIGITS + SMALL + CAPITAL + "+/_-"),
)


def before(values: Column, plus: Callable[[Column, Column], Column]) -> Column:
    """What ``plus`` makes of the numbers before each one, from zero, and at last of all.

    Growing an array by one copies it, so a long one is folded in blocks of about the root of
    its length: each block by itself, the blocks' totals, and both together.
    """

    def folded(items: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(items, start, lambda s, v: F.struct(
            plus(s.at, v).alias("at"), F.concat(s.out, F.array(s.at)).alias("out")))

    def whole(items: Column) -> Column:
        return bind(folded(items), lambda s: F.concat(s.out, F.array(s.at)))

    def blocked(items: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(items))).cast("int")
        cut = bind(size, lambda n: F.transform(
            F.sequence(F.lit(1), F.size(items), n), lambda first: folded(F.slice(items, first, n))))
        return bind(cut, lambda parts: bind(whole(F.transform(parts, lambda p: p.at)), lambda starts: F.concat(
            F.flatten(F.transform(parts, lambda p, i: F.transform(p.out, lambda v: plus(F.get(starts, i), v)))),
            F.array(F.element_at(starts, -1)))))

    return bind(values, lambda v: F.when(F.size(v) <= FEW, whole(v)).otherwise(blocked(v)))


def add(a: Column, b: Column) -> Column:
    return a + b


def matches(text: Column, pattern: str) -> Column:
    """(start, end) of the leftmost non-overlapping matches, in order.

    The pieces between the matches and the matches themselves, laid end to end,
    are the text; the positions are the running sum of their lengths.
    """
    lengths = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.char_length)
    found = F.struct(F.transform(F.split(text, pattern, -1), F.char_length).alias("gaps"), lengths.alias("lengths"))

    def place(f: Column) -> Column:
        steps = F.transform(f.lengths, lambda n, i: F.get(f.gaps, i) + n)
        return bind(before(steps, add), lambda at: F.transform(f.lengths, lambda n, i: F.struct(
            (F.get(at, i) + F.get(f.gaps, i)).alias("start"), (F.get(at, i) + F.get(f.gaps, i) + n).alias("end"))))

    empty = F.array().cast("array<struct<start:int,end:int>>")
    return F.when(F.rlike(text, F.lit(pattern)), bind(found, place)).otherwise(empty)


def assignments(text: Column) -> Column:
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    long_enough = bind(values, lambda v: F.filter(
        matches(text, ASSIGN), lambda s, i: F.char_length(F.get(v, i)) >= ASSIGN_LEAST))
    return F.when(F.rlike(text, F.lit(ASSIGN)), long_enough).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


def of_kind(spans: Column, kind: str) -> Column:
    """Spans as (start, rank of the kind, end): sorted, this is the order of the result."""
    return F.transform(spans, lambda s: F.struct(
        s.start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s.end.alias("end")))


def upper_tail(z: Column) -> Column:
    """P(Z > z) of the normal distribution, by the rational approximation 26.2.17 of Abramowitz and Stegun."""

    def tail(a: Column) -> Column:
        t = 1 / (1 + 0.2316419 * a)
        terms = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
        poly = bind(t, lambda x: x * (terms[0] + x * (terms[1] + x * (terms[2] + x * (terms[3] + x * terms[4])))))
        return F.exp(-a * a / 2) * 0.3989422804014327 * poly

    return bind(z, lambda v: F.when(v >= 0, bind(v, tail)).otherwise(1 - bind(-v, tail)))


def encoding(run: Column) -> Column:
    """The alphabet of a run: its symbols, their number, and what class changes to expect of even draws."""
    out = None
    for _, fits, alphabet in reversed(ENCODINGS):
        shares = [sum(c in group for c in alphabet) / len(alphabet) for group in (DIGITS, SMALL, CAPITAL)]
        shares.append(1 - sum(shares))
        mean = 1 - sum(s * s for s in shares)
        # Neighbouring pairs share a character: their covariance is part of the variance.
        both = sum(s * (1 - s) ** 2 for s in shares)
        one = F.struct(
            F.lit(alphabet).alias("symbols"), F.lit(float(len(alphabet))).alias("k"), F.lit(mean).alias("mean"),
            F.lit(mean - mean**2).alias("spread"), F.lit(both - mean**2).alias("covariance"))
        out = one if out is None else F.when(F.rlike(run, F.lit(fits)), one).otherwise(out)
    return out


def uniformity(run: Column, n: Column, e: Column) -> Column:
    """p-value of Pearson's statistic, by Wilson and Hilferty's cube root."""
    step = lambda a, c: bind(F.when(c == a.last, a.seen + 1).otherwise(1).cast("bigint"), lambda k: F.struct(
        c.alias("last"), k.alias("seen"), (a.squares + 2 * k - 1).alias("squares")))
    zero = F.lit(0).cast("bigint")
    none = F.struct(F.lit("").alias("last"), zero.alias("seen"), zero.alias("squares"))
    # Of k equal symbols in a row the odd numbers 1, 3, ... add up to k squared.
    squares = F.aggregate(F.sort_array(F.split(run, "")), none, step, lambda a: a.squares.cast("double"))
    spread = 2 / (9 * (e.k - 1))
    return upper_tail((F.cbrt(F.greatest(squares * e.k / n - n, F.lit(0.0)) / (e.k - 1)) - (1 - spread)) / F.sqrt(spread))


def class_changes(run: Column, n: Column, e: Column) -> Column:
    """p-value of as few changes of character class between neighbours."""
    borders = r"(?<=[0-9])(?=[^0-9])|(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[+/_-])(?=[^+/_-])"
    changes = F.char_length(F.regexp_replace(run, borders, " ")) - n
    spread = (n - 1) * e.spread + 2 * (n - 2) * e.covariance
    return upper_tail(((n - 1) * e.mean - changes - 0.5) / F.sqrt(spread))


def serial(run: Column, n: Column, e: Column) -> Column:
    """Two-sided p-value of the correlation of each symbol's number with the next one's."""
    codes = F.transform(F.split(run, ""), lambda c: F.instr(e.symbols, c).cast("double"))

    def correlation(x: Column) -> Column:
        total = F.aggregate(x, F.lit(0.0), lambda a, v: a + v)
        square = F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v)
        after = F.zip_with(x, F.slice(x, F.lit(2), F.size(x)), lambda a, b: a * F.coalesce(b, F.lit(0.0)))
        cross = F.aggregate(after, F.get(x, F.lit(0)) * F.get(x, F.size(x) - 1), lambda a, v: a + v)
        parts = F.struct(total.alias("total"), square.alias("square"), cross.alias("cross"))
        return bind(parts, lambda s: F.when(n * s.square == s.total * s.total, F.lit(1.0)).otherwise(
            (n * s.cross - s.total * s.total) / (n * s.square - s.total * s.total)))

    return F.least(F.lit(1.0), 2 * upper_tail(F.abs((bind(codes, correlation) + 1 / (n - 1)) * F.sqrt(n))))


def p_value(run: Column) -> Column:
    """Three times the smallest p-value of the battery, under the run's own encoding."""

    def battery(r: Column) -> Column:
        n = F.char_length(r).cast("double")
        tests = lambda e: F.least(uniformity(r, n, e), class_changes(r, n, e), serial(r, n, e))
        return F.least(3 * bind(encoding(r), tests), F.lit(1.0))

    return bind(run, battery)


def length_class(n: Column) -> Column:
    return F.least(F.floor(F.log2(n)).cast("int"), F.lit(LAST_CLASS))


def p_step(p: Column) -> Column:
    """The step of a p-value on a logarithmic grid; a high step is a small p-value."""
    return F.least(F.floor(-F.log10(F.greatest(p, F.lit(1e-30))) * STEPS_PER_DECADE).cast("int"), F.lit(LAST_STEP))


def runs(text: Column) -> Column:
    """(length class, step) of every run, in the order of :func:`matches`."""
    return F.when(
        F.rlike(text, F.lit(RUN)),
        F.transform(F.regexp_extract_all(text, F.lit(RUN), F.lit(0)), lambda r: F.struct(
            length_class(F.char_length(r)).alias("size"), p_step(p_value(r)).alias("step"))),
    ).otherwise(F.array().cast("array<struct<size:int,step:int>>"))


def clearing_steps(docs: DataFrame, column: str = "text", fdr: float = FDR) -> dict[int, int]:
    """Per length class, the lowest step at which a run is cleared as ordinary.

    Benjamini-Hochberg on the grid: the largest p = 10^(-step/20) that is at
    most ``fdr`` times the share of runs at or below it. Counts are over all
    rows; what comes to the driver is one row per length class.
    """
    texts = docs.select(F.coalesce(F.col(column).cast("string"), F.lit("")).alias("text"))
    found = texts.select("text", pattern_spans(F.col("text")).alias("base")).select(
        F.explode(runs(outside(F.col("text"), F.col("base")))).alias("r"))
    counts = found.groupBy("r.size", "r.step").count()
    steps = counts.groupBy("size").agg(
        F.sum("count").alias("m"),
        F.map_from_entries(F.collect_list(F.struct("step", "count"))).alias("n"),
    )
    grid = F.sequence(F.lit(0), F.lit(LAST_STEP))

    def clears(step: Column) -> Column:
        at_or_below = F.aggregate(
            F.map_values(F.map_filter("n", lambda k, v: k >= step)), F.lit(0).cast("bigint"), lambda a, v: a + v)
        return F.pow(F.lit(10.0), -step / STEPS_PER_DECADE) <= fdr * at_or_below / F.col("m")

    lowest = F.array_min(F.filter(grid, clears))
    return {r["size"]: r["first"] for r in steps.select("size", lowest.alias("first")).collect() if r["first"] is not None}


def pattern_spans(text: Column) -> Column:
    """The spans of the fixed patterns, as a sorted array of (start, kind, end)."""
    return F.sort_array(F.concat(
        of_kind(assignments(text), "assign"), of_kind(matches(text, ACCESS), "access"), of_kind(matches(text, HEX), "hex")))


def pieces(text: Column, spans: Column, make: Callable[[Column, Column, Column], Column]) -> Column:
    """A text made of what ``make`` returns for each span, and what follows the last one.

    ``make`` gets the span, the greatest end of the spans before it, and the text between the two.
    A substring is found by counting from the start, so texts are cut into chunks once, and
    a piece is taken from the chunks it lies in.
    """

    def taken(chunks: Column, first: Column, end: Column) -> Column:
        def within(c: Column) -> Column:
            at = F.greatest(first - c * CHUNK, F.lit(0))
            return F.substr(F.get(chunks, c), at + 1, F.least(end - c * CHUNK, F.lit(CHUNK)) - at)

        over = F.sequence(F.floor(first / CHUNK).cast("int"), F.floor((end - 1) / CHUNK).cast("int"))
        return F.when(end > first, F.array_join(F.transform(over, within), "")).otherwise(F.lit(""))

    def build(chunks: Column, at: Column) -> Column:
        made = F.transform(spans, lambda s, i: make(s, F.get(at, i), taken(chunks, F.get(at, i), s.start)))
        rest = taken(chunks, F.element_at(at, -1), F.char_length(text))
        return F.concat(F.array_join(made, ""), rest)

    cut = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % CHUNK), F.lit(0))
    ends = before(F.transform(spans, lambda s: s.end), F.greatest)
    return bind(cut, lambda chunks: bind(ends, lambda at: build(chunks, at)))


def outside(text: Column, base: Column) -> Column:
    """The text with spaces, which no run has, in place of its pattern spans; positions stay."""

    def blank(s: Column, at: Column, gap: Column) -> Column:
        return F.concat(gap, F.repeat(F.lit(" "), F.greatest(s.end - F.greatest(s.start, at), F.lit(0))))

    return F.when(F.size(base) > 0, pieces(text, base, blank)).otherwise(text)


def random_spans(text: Column, clearing: dict[int, int]) -> Column:
    """The runs of a text that are not cleared, as an array of (start, kind, end)."""
    # A class without an entry clears nothing.
    lowest = F.array(*[F.lit(clearing.get(size, LAST_STEP + 1)) for size in range(LAST_CLASS + 1)])

    def random(judged: Column) -> Column:
        return F.filter(matches(text, RUN), lambda span, i: F.get(judged, i).step < F.get(lowest, F.get(judged, i).size))

    extra = F.when(F.rlike(text, F.lit(RUN)), bind(runs(text), random)).otherwise(
        F.array().cast("array<struct<start:int,end:int>>"))
    return of_kind(extra, "random")


def scan(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """``row`` (the document's columns), ``text``, ``base`` and ``spans`` (all spans, sorted)."""
    clearing = clearing_steps(docs, fdr=fdr)
    texts = packed(docs).select("row", F.coalesce(F.col("row.text").cast("string"), F.lit("")).alias("text"))
    rest = texts.select("*", pattern_spans(F.col("text")).alias("base")).select(
        "*", outside(F.col("text"), F.col("base")).alias("rest"))
    return rest.select("row", "text", "base", F.sort_array(F.concat("base", random_spans(F.col("rest"), clearing))).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s.kind), s.start.cast("string"), s.end.cast("string"))), ",")


def report(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """Counts per kind, a digest of the pattern spans, and all spans as text."""

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s.kind == KINDS.index(kind))).cast("bigint").alias(f"n_{kind}")

    return scan(docs, fdr).select(
        F.col("row.doc_id").alias("doc_id"), count("assign"), count("access"), count("hex"),
        F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, mask: str = "[SECRET]", fdr: float = FDR) -> DataFrame:
    """The documents with every span, overlapping ones as one, replaced by ``mask``; other columns stay.

    ``n_chars``, where the table has it, is set to the new length of a changed text.
    """

    def masked(s: Column, at: Column, gap: Column) -> Column:
        return F.when(s.start >= at, F.concat(gap, F.lit(mask))).otherwise(F.lit(""))

    hit = F.size("spans") > 0
    clean = scan(docs, fdr).select(
        "row", hit.alias("hit"), F.when(hit, pieces(F.col("text"), F.col("spans"), masked)).alias("clean"))
    row = F.col("row").withField("text", F.when(F.col("hit"), F.col("clean")).otherwise(F.col("row.text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        row = row.withField("n_chars", F.when(F.col("hit"), F.char_length("clean").cast(kind)).otherwise(F.col("row.n_chars")))
    return clean.select(row.alias("row")).select("row.*")
