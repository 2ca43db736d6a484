"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and
one bit per failed rule; a policy is a versioned mask of the bits that reject.
Policies are applied, and rules switched off on trial, from the bits alone, so
neither needs the text again.

Everything runs as column expressions on one row: nothing is shuffled, and a
long text costs its own task no more than n log n steps.

Defined results: a null text is an empty one (no word, fails ``too_few_words``);
repeated rows are judged one by one, alike; an empty table gives an empty
ledger; ``doc_id`` may be null; other columns of the table are not looked at, and
:func:`keep` passes them through whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import bind, packed, words

WINDOW = 5

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")

# Rule name and the condition that fails a document, over its measurements. The
# place in this list is the bit; new rules go to the end.
RULES: tuple[tuple[str, Callable[[Column], Column]], ...] = (
    ("too_few_words", lambda m: m.n_words < 10),
    ("repeated_windows", lambda m: 100 * m.n_repeat_words > 20 * m.n_words),
    ("symbols", lambda m: 100 * m.n_symbols > 40 * m.n_words),
    ("capitals", lambda m: 100 * m.n_capitals > 30 * m.word_chars),
    ("repeated_lines", lambda m: 100 * m.n_dup_lines > 40 * m.n_lines),
    ("word_length", lambda m: (m.word_chars < 2 * m.n_words) | (m.word_chars > 25 * m.n_words)),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = BIT["too_few_words"] | BIT["repeated_windows"]


@dataclass(frozen=True)
class Policy:
    """A version of the rule set: the names of the rules that reject."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


POLICIES = (
    Policy("v1", ("too_few_words", "repeated_windows")),
    Policy("v2", ("too_few_words", "repeated_windows", "symbols", "capitals", "repeated_lines", "word_length")),
)
CURRENT = POLICIES[-1]


def repeat_words(tokens: Column) -> Column:
    """Words covered by windows of five words that occur twice or more in the text.

    Windows are compared by a 64-bit hash within one text. Only a text that has
    equal windows sorts them; equal ones then stand side by side.
    """

    def window(w: Column, i: Column) -> Column:
        return F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = bind(placed, lambda p: F.filter(
            p, lambda s, j: (s.h == F.get(p, j - 1).h) | F.coalesce(s.h == F.get(p, j + 1).h, F.lit(False))
        ))
        starts = F.sort_array(F.transform(twice, lambda s: s.i))
        return F.aggregate(
            starts,
            F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
            lambda a, i: F.struct((a.n + F.least(F.lit(WINDOW), i - a.last)).alias("n"), i.alias("last")),
            lambda a: a.n.cast("bigint"),
        )

    def counted(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: window(w, i))
        return bind(hashes, lambda h: F.when(
            F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0).cast("bigint")))

    return F.when(F.size(tokens) <= WINDOW, F.lit(0).cast("bigint")).otherwise(counted(tokens))


def judged(text: Column) -> Column:
    """The measurements of a text and ``failed``, the bits of the rules it fails, as one struct.

    Words and lines are bound once. The optimizer may move the whole expression
    into a filter, but it cannot copy its parts to every place that uses them.
    """

    def measured(w: Column, lines: Column) -> Column:
        without = lambda pattern: F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))
        values = (
            F.size(w),
            F.char_length(F.array_join(w, "")),
            without(r"[#*$%&|<>]+"),
            F.size(lines) - F.size(F.array_distinct(lines)),
            repeat_words(w),
            F.size(lines),
            without(r"\p{Lu}+"),
        )
        return F.struct(*[v.cast("bigint").alias(name) for name, v in zip(MEASURES, values)])

    def with_bits(m: Column) -> Column:
        bits = F.lit(0).cast("bigint")
        for name, fails in RULES:
            bits = bits.bitwiseOR(F.when(fails(m), F.lit(BIT[name])).otherwise(F.lit(0)).cast("bigint"))
        return F.struct(*[m[name].alias(name) for name in MEASURES], bits.alias("failed"))

    lines = F.filter(F.split(text, "\n", -1), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))
    return bind(bind(words(text), lambda w: bind(lines, lambda x: measured(w, x))), with_bits)


def ledger(docs: DataFrame) -> DataFrame:
    """One row per document: ``row`` (its columns), the measurements, ``failed`` (the bits)."""
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    return packed(docs).select("row", judged(text).alias("j")).select("row", "j.*")


def apply_policy(rows: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """A ledger with ``rejected`` (the policy's failed bits) and ``kept``."""
    hit = F.col("failed").bitwiseAND(F.lit(policy.mask).cast("bigint"))
    return rows.select("*", hit.alias("rejected"), (hit == 0).alias("kept"))


def ablations(rows: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """Per policy and rule: documents failing it, and those that only it rejects.

    ``saved`` is what switching the rule off would keep. One pass over the
    ledger: distinct bit patterns (64 at most) are counted before anything else.
    """
    patterns = rows.groupBy("failed").agg(F.count("*").alias("n"))
    cells = F.explode(F.array(*[
        F.struct(F.lit(p.version).alias("version"), F.lit(r).alias("rule"), F.lit(p.mask).cast("bigint").alias("mask"),
                 F.lit(BIT[r]).cast("bigint").alias("bit"))
        for p in policies for r in p.rules
    ])).alias("c")
    hit = F.col("failed").bitwiseAND(F.col("c.mask"))
    return (
        patterns.select("failed", "n", cells)
        .groupBy(F.col("c.version").alias("version"), F.col("c.rule").alias("rule"))
        .agg(
            F.sum(F.when(hit.bitwiseAND(F.col("c.bit")) != 0, F.col("n")).otherwise(0)).alias("fails"),
            F.sum(F.when(hit == F.col("c.bit"), F.col("n")).otherwise(0)).alias("saved"),
        )
    )


def keep(docs: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """The documents a policy keeps, with their own columns."""
    return apply_policy(ledger(docs).select("row", "failed"), policy).where("kept").select("row.*")


def report(docs: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """The ledger as flat columns."""
    return apply_policy(ledger(docs), policy).select(
        F.col("row.doc_id").alias("doc_id"),
        *MEASURES,
        (F.col("failed").bitwiseAND(F.lit(BASE).cast("bigint")) != 0).alias("base_failed"),
        "kept",
        "failed",
        F.lit(policy.version).alias("policy"),
    )

