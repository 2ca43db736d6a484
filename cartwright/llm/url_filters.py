"""URL filter: host and path rules, and for the rest a logistic regression on hashed character n-grams.

A rule names a host (with all its subdomains) and a path prefix; the longest one
that fits decides. Urls that no rule fits are judged by a model trained on a
small table of labelled urls (``url``, ``label`` 1 = block): character n-grams of
host and path, hashed into ``BUCKETS`` features, each counted once per url.

Training is batch gradient descent as Spark jobs: the labelled rows are stored
once as arrays of features, and each step sums the gradient per feature, before
and after the shuffle. What comes to the driver is a vector of ``BUCKETS``
numbers per step, whatever the number of rows. Judging a page reads its url
only, in one pass without a shuffle; the weights are a constant of the plan.

:func:`labelled_by_rules` makes a labelled table out of the urls that rules
decide: at most ``LABELLED`` per label, the ones with the lowest hash, each url
once. It is the one place that samples, and only to fit the model.

Defined results: a url that is null or has no ``://`` has an empty host and
path; no rule fits an empty host, and with no n-grams the model's bias judges.
Without any labelled row of one of the labels, the other label is the verdict of
the rest; without any at all it is ``allow``. Repeated rows are judged alike; an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

GRAM = 4
BUCKETS = 4096
LABELLED = 2000
STEPS = 25
RATE = 4.0
DECAY = 1e-4


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    block: bool

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("com", "/", False),
    Rule("example.com", "/en/", True),
    Rule("www.example.com", "/en/", False),
    Rule("net", "/es/", True),
    Rule("net", "/fr/", True),
)


@dataclass(frozen=True)
class Model:
    bias: float
    weights: tuple[float, ...]


def small(text: Column) -> Column:
    """A-Z as a-z; other letters stay."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end."""
    return small(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """Text and blocking of the longest rule that fits ``host`` and ``path``; null where none does."""
    text, block = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((F.col("host") == rule.host) | F.endswith("host", F.lit("." + rule.host))) & F.startswith(
            "path", F.lit(rule.path))
        text, block = F.when(fits, rule.text).otherwise(text), F.when(fits, rule.block).otherwise(block)
    return text, block


def features() -> Column:
    """Buckets of the n-grams of ``host`` and ``path``, ends marked, each once."""

    def grams(part: str) -> Column:
        marked = F.concat(F.lit(part[0] + "^"), F.col(part), F.lit("$"))
        places = F.sequence(F.lit(1), F.greatest(F.char_length(marked) - GRAM + 1, F.lit(1)))
        return F.transform(places, lambda i: F.pmod(F.xxhash64(F.lit(part), F.substr(marked, i, F.lit(GRAM))), F.lit(BUCKETS)).cast("int"))

    return F.array_distinct(F.concat(grams("host"), grams("path")))


def score(found: Column, model: Model) -> Column:
    """Log odds of blocking; each url's features weigh one together."""
    # One literal that the optimizer folds into an array; thousands of single ones are slow to plan.
    weights = F.split(F.lit(",".join(map(repr, model.weights))), ",").cast("array<double>")
    return F.lit(model.bias) + F.aggregate(found, F.lit(0.0), lambda a, i: a + F.get(weights, i)) / F.sqrt(F.size(found))


def parts(urls: DataFrame) -> DataFrame:
    return urls.select("*", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))


def labelled_by_rules(urls: DataFrame, rules: tuple[Rule, ...] = RULES, most: int = LABELLED) -> DataFrame:
    """(url, label) of urls that a rule decides, ``most`` per label at the most."""
    _, block = fitting_rule(rules)
    decided = parts(urls.select(F.col("url").cast("string").alias("url"))).select("url", block.alias("block"))
    halves = [
        decided.where(F.col("block") == F.lit(label)).select("url").distinct()
        .orderBy(F.xxhash64("url"), "url").limit(most).select("url", F.lit(int(label)).alias("label"))
        for label in (False, True)
    ]
    return halves[0].unionByName(halves[1])


def train(labelled: DataFrame, steps: int = STEPS, rate: float = RATE, decay: float = DECAY) -> Model:
    """Fit the model to (url, label); both labels weigh the same together."""
    rows = parts(labelled.where("label is not null").select("url", F.col("label").cast("double").alias("label")))
    rows = stored(rows.select("label", features().alias("found")), "url-labelled")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        return Model(math.inf if counts.get(1.0) else -math.inf, (0.0,) * BUCKETS)
    share = F.when(F.col("label") == 1, F.lit(0.5 / counts[1.0])).otherwise(F.lit(0.5 / counts[0.0]))
    bias, weights = 0.0, [0.0] * BUCKETS
    for _ in range(steps):
        margin = score(F.col("found"), Model(bias, tuple(weights)))
        error = ((1 / (1 + F.exp(-margin)) - F.col("label")) * share).alias("error")
        # Feature -1 is the bias, which every url has.
        slopes = (
            rows.select(error, F.size("found").alias("n"), F.explode(F.concat(F.array(F.lit(-1)), "found")).alias("i"))
            .groupBy("i")
            .agg(F.sum(F.when(F.col("i") < 0, F.col("error")).otherwise(F.col("error") / F.sqrt("n"))).alias("slope"))
            .collect()
        )
        weights = [w * (1 - rate * decay) for w in weights]
        for r in slopes:
            if r["i"] < 0:
                bias -= rate * r["slope"]
            else:
                weights[r["i"]] -= rate * r["slope"]
    return Model(bias, tuple(weights))


def judge(pages: DataFrame, model: Model, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``pages`` (with ``url``) with host, path, rule, verdict, and the model's score where it judged."""
    text, block = fitting_rule(rules)
    ruled = parts(pages).select("*", text.alias("rule"), block.alias("block"), features().alias("found"))
    if math.isinf(model.bias):
        margin = F.lit(model.bias)
    else:
        margin = score(F.col("found"), model)
    judged = ruled.select("*", F.when(F.col("block").isNull(), margin).alias("score"))
    blocked = F.coalesce("block", F.col("score") > 0)
    return judged.select(
        *[c for c in judged.columns if c not in ("block", "found", "score")],
        F.when(blocked, "block").otherwise("allow").alias("verdict"), "score")


def report(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every page judged, with a model fitted to the urls that the rules decide."""
    urls = pages.select("page_id", F.col("url").cast("string").alias("url"))
    model = train(labelled_by_rules(urls, rules))
    return judge(urls, model, rules).select("page_id", "host", "path", "rule", "verdict", "score")
