"""Row validation.

All rules of an entity are evaluated in one pass into a text of reasons, joined
by bars and ordered by name; a row is valid when it is empty. The expression has
no lambda, so it is compiled with the stage. Only uniqueness needs a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import EntitySpec, spec_for
from ..functions.text import UUID_PATTERN, packed_id, strip
from ..session import stored
from .clean import MONEY_OF, cleaned
from .narrow import with_packed_ids, with_plain_ids
from .skew import hot_only, key_counts, mark_hot, scattered

REASONS = "_reasons"
FILE_SCOPE = ("_source_file",)
# Repeated keys that may be broadcast: about 20 MB.
FEW = 200_000


def fails_not_null(c: Column) -> Column:
    return c.isNull()


def fails_pattern(c: Column, pattern: str) -> Column:
    """Nulls pass; ``find`` semantics with the anchors in the pattern itself."""
    return c.isNotNull() & ~c.rlike(pattern)


def fails_in_set(c: Column, allowed: Iterable[str]) -> Column:
    """Nulls pass; the comparison is case-sensitive."""
    return c.isNotNull() & ~c.isin(*allowed)


def repeated(keys: DataFrame, by: list[str]) -> DataFrame:
    """The keys that occur more than once, with how often.

    Hashes are counted first, as eight bytes each; only keys whose hash occurs more than once are counted themselves.
    """
    hashed = keys.withColumn("_hash", F.xxhash64(*by))
    suspects = stored(key_counts(hashed, ["_hash"]).filter("_n > 1").select("_hash"), "repeated-hashes")
    few = F.broadcast(suspects) if suspects.count() <= FEW else suspects
    return key_counts(hashed.join(few, "_hash", "left_semi"), by).filter("_n > 1")


def flag_repeated(df: DataFrame, key: str, flag: str, scope: Iterable[str] = FILE_SCOPE) -> DataFrame:
    """Set ``flag`` on **every** row whose key is repeated inside its scope.

    The input is read three times: its keys' hashes, the keys whose hash is repeated,
    reduced to the repeated ones, which are written down, then its rows, which look these up. Up to ``FEW``
    repeated keys are broadcast, and no row moves. Of more, the hot ones are
    looked up in a broadcast of bounded size; their rows, and those without a
    key, are then scattered over the tasks of the join that serves all other
    keys. A window over the rows would bring all copies of one value into a
    single task.
    """
    scope = list(scope)
    repeats = stored(repeated(df.filter(F.col(key).isNotNull()).select(*scope, key), [*scope, key]), "repeated-keys")
    if repeats.count() <= FEW:
        again = F.broadcast(repeats.select(*scope, key, F.lit(True).alias("_again")))
        joined = df.join(again, [*scope, key], "left")
        return joined.select(*[F.col(c) for c in df.columns], F.coalesce("_again", F.lit(False)).alias(flag))
    marked = mark_hot(df, hot_only(repeats), [*scope, key])
    apart = F.col("_hot") | F.col(key).isNull()
    again = repeats.select(*scope, packed_id(F.col(key)).alias("_match"), F.lit(True).alias("_again"))
    placed = with_packed_ids(marked.withColumn("_match", packed_id(scattered(F.col(key), apart))))
    joined = placed.join(again, [*scope, "_match"], "left")
    found = F.col("_hot") | F.coalesce("_again", F.lit(False))
    return with_plain_ids(joined.select(*[F.col(c) for c in df.columns], found.alias(flag)), df.schema)


def rule_failures(spec: EntitySpec) -> dict[str, Column]:
    """Rule name to failure condition, for the rules that need a single row only."""
    rules = {f"null:{c}": fails_not_null(F.col(c)) for c in spec.required}
    rules[f"uuid:{spec.key}"] = fails_pattern(F.col(spec.key), UUID_PATTERN)
    for c, pattern in spec.patterns.items():
        rules[f"number:{c}"] = fails_pattern(F.col(c), pattern)
    for c, allowed in spec.allowed.items():
        rules[f"enum:{c}"] = fails_in_set(F.col(c), allowed)
    return rules


def load_failures(spec: EntitySpec) -> dict[str, Column]:
    """Conditions the staging tables cannot store.

    They are not validation rules. A row that meets one would make a typed table
    reject its whole file, so such a row is quarantined on its own instead.
    """
    rules = {f"uuid:{c}": fails_pattern(strip(F.col(c)), UUID_PATTERN) for c in spec.references}
    for c in spec.timestamps:
        rules[f"unparseable:{c}"] = F.col(c).isNotNull() & cleaned(spec, c).isNull()
    for c, kind in spec.columns.items():
        if kind.endswith("money"):
            number = strip(F.col(c))
            too_large = number.try_cast(MONEY_OF[kind]).isNull() & number.try_cast("double").isNotNull()
            rules[f"overflow:{c}"] = F.col(c).isNotNull() & too_large
        elif kind == "int":
            number = strip(F.col(c)).try_cast("double")
            rules[f"overflow:{c}"] = number.isNotNull() & number.try_cast("int").isNull()
    return rules


def annotate(
    entity: str | EntitySpec,
    df: DataFrame,
    scope: Iterable[str] = FILE_SCOPE,
    guard_load: bool = False,
) -> DataFrame:
    """Add the reasons a row is invalid for; empty means valid.

    ``scope`` names the columns inside which the key must be unique; add a chunk
    column to narrow it. ``guard_load`` adds the storage conditions.
    """
    spec = entity if isinstance(entity, EntitySpec) else spec_for(entity)
    rules = rule_failures(spec)
    if guard_load:
        rules = {**load_failures(spec), **rules}
    flagged = flag_repeated(df, spec.key, "_repeated", scope)
    rules[f"unique:{spec.key}"] = F.col("_repeated")
    found = F.concat_ws("|", *[F.when(rules[name], F.lit(name)) for name in sorted(rules)])
    return flagged.withColumn(REASONS, found).drop("_repeated").select(*df.columns, REASONS)


def is_valid() -> Column:
    return F.col(REASONS) == ""


def validate(
    entity: str, df: DataFrame, scope: Iterable[str] = FILE_SCOPE
) -> tuple[DataFrame, DataFrame]:
    """Split into valid rows and rejected rows; the rejected keep their reasons."""
    try:
        spec = spec_for(entity)
    except ValueError:
        raise ValueError(f"No validator defined for entity: {entity!r}") from None
    marked = annotate(spec, df, scope)
    return marked.filter(is_valid()).drop(REASONS), marked.filter(~is_valid())


def summary(annotated: DataFrame) -> DataFrame:
    """Valid and invalid rows per file, with whether the file has a quarantine part."""
    per_file = annotated.groupBy("_source_file").agg(
        F.count_if(is_valid()).alias("valid_rows"), F.count_if(~is_valid()).alias("invalid_rows")
    )
    return per_file.withColumn("quarantined_files", (F.col("invalid_rows") > 0).cast("bigint"))
