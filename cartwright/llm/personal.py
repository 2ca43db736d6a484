"""Personal data by fixed patterns and a semi-Markov conditional random field.

The patterns give e-mail addresses, IP addresses, card numbers and telephone
numbers whose form is strict. The field finds what is written otherwise: it
scores whole candidate spans (number of digits, lengths of digit groups, shape,
separators, check digit, octets, what follows an ``@``, what stands on either
side), and dynamic programming over spans of at most ``LONGEST`` tokens chooses
the borders and types of a text together.

A span has to hold a digit or an ``@`` in every word. So texts fall into islands,
runs of words that have one, and what is chosen in one island does not touch
another: only islands are scored, whole texts are searched, in time linear in
their length.

The field is trained on the corpus itself, on the driver: on islands of about
``DOCUMENTS`` documents drawn by hash, at most about ``ISLANDS`` of them, whose
labels are the patterns' spans, and on variants of these islands that write the
same thing in a form the patterns do not know (other separators, no country code,
defanged dots). Islands of equal features are one with a weight, and gradient
steps of the exact likelihood (forward and backward sums) fit the weights. It is
applied to every document; a span that overlaps a pattern's is left out.

Defined results: a null or empty text has no span; repeated rows are searched
alike; a corpus without personal data trains a field that finds nothing; an empty
table gives an empty result; other columns are passed through by :func:`redact`,
whatever their names. Positions count code points.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..session import stored
from .words import packed

KINDS = ("email", "ip", "card", "phone")
DOCUMENTS, ISLANDS = 20_000, 1_500
# Islands longer than this train nothing; they are searched like any other.
TRAINED = 80
# Tokens and digits of a span, at most.
LONGEST, DIGITS, SPACES = 20, 24, 4  # and one @
# A span without @ has this many digits at least, or four groups of them.
FEWEST = 7
GLUE = "._-/%+@"
STEPS, RATE, PENALTY = 60, 0.5, 1e-3

# Fixed patterns, written so that no long run of characters is read more than once.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NO_DIGIT = re.compile(r"[^0-9]+")

HOT, SPACE = re.compile(r"[0-9@]"), re.compile(r"\s+")
TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\S")

Span = tuple[int, int, int]  # start, rank of the kind, end


def luhn(digits: str) -> bool:
    """Whether the check digit is right."""
    total = sum(map(int, digits[::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    done = seen = 0
    while (at := text.find("@", seen)) >= 0:
        before = text[max(done, seen):at]
        start = at - (len(before) - len(before.rstrip(LOCAL)))
        seen = at + 1
        if start < at and (found := DOMAIN.match(text, seen)):
            yield start, found.end()
            done = found.end()


def pattern_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns in order."""
    out = [(a, 0, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = NO_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def islands(text: str) -> Iterator[tuple[int, int]]:
    """Maximal runs of words with a digit or an ``@``, single white space between them."""
    start = end = -1
    at = 0
    while (hot := HOT.search(text, at)) is not None:
        first = hot.start()
        while first > at and not text[first - 1].isspace():
            first -= 1
        gap = SPACE.search(text, hot.end())
        last = gap.start() if gap else len(text)
        if start >= 0 and first == end + 1:
            end = last
        else:
            if start >= 0:
                yield start, end
            start, end = first, last
        at = last
    if start >= 0:
        yield start, end


def tokens(text: str, start: int, end: int) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the tokens of an island: d for digits, a for letters, else the character itself."""
    out = []
    for m in TOKEN.finditer(text, start, end):
        c = m[0][0]
        out.append((m.start(), m.end(), "d" if c in "0123456789" else "a" if m.end() - m.start() > 1 or c.isalpha() else c))
    return out


def side(text: str, at: int) -> str:
    """What kind of character stands at a place."""
    c = text[at] if 0 <= at < len(text) else " "
    return "d" if c.isdigit() else "a" if c.isalpha() else " " if c.isspace() else c


def glued(text: str, at: int) -> bool:
    """Whether the character at a place ties the letters or digits on its two sides together."""
    return 0 < at < len(text) - 1 and text[at] in GLUE and text[at - 1].isalnum() and text[at + 1].isalnum()


def features(text: str, toks: list[tuple[int, int, str]]) -> Iterator[tuple[int, int, tuple[str, ...]]]:
    """(first token, token after the last, features) of every candidate span of an island.

    A candidate does not begin or end inside a chain such as ``1.2.3``.
    """
    for i, (start, _, kind) in enumerate(toks):
        if kind not in "da+(" or glued(text, start - 1):
            continue
        shape, groups, digits, seps, ats, dots, spaces, hot = "", [], "", set(), 0, 0, 0, False
        left = side(text, start - 1)
        for j in range(i, min(i + LONGEST, len(toks))):
            a, b, k = toks[j]
            if j > i and toks[j - 1][1] < a:
                spaces += 1
                if not hot or spaces > SPACES:
                    break
                shape, hot = shape + " ", False
                seps.add(" ")
            if k == "d":
                digits += text[a:b]
                groups.append(b - a)
                hot = True
                if len(digits) > DIGITS:
                    break
            elif k == "@":
                if ats:
                    break
                ats, dots, hot = 1, 0, True
            elif k != "a":
                seps.add(k)
                dots += k == "."
            shape += k
            if k not in "da" or not hot or not (ats or len(digits) >= FEWEST or len(groups) == 4) or glued(text, b):
                continue
            check = str(len(digits) >= 12 and luhn(digits))[0]
            octets = len(groups) == 4 and all(int(g) < 256 for g in digits_in(digits, groups))
            tail = f"{k}{min(b - a, 7)}" if ats else ""
            form = shape if len(shape) <= 24 else "*"
            yield i, j + 1, (
                "bias", "s" + form, "n" + str(len(digits)), "g" + "-".join(map(str, groups[:7])), "p" + "".join(sorted(seps)),
                "l" + check + str(len(digits)), "o" + str(octets) + form, "@" + str(ats) + str(dots) + tail,
                "<" + left, ">" + side(text, b))


def digits_in(digits: str, groups: list[int]) -> list[str]:
    out, at = [], 0
    for n in groups:
        out.append(digits[at:at + n])
        at += n
    return out


@dataclass
class Field:
    """Weights per feature and type; type 0 is the single token that belongs to nothing."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)
    moves: np.ndarray = field(default_factory=lambda: np.zeros((len(KINDS) + 1,) * 2))

    def score(self, names: tuple[str, ...]) -> np.ndarray:
        out = np.zeros(len(KINDS) + 1)
        for n in names:
            if (w := self.weights.get(n)) is not None:
                out += w
        return out

    def spans(self, text: str, start: int, end: int) -> list[Span]:
        """The best segmentation of an island."""
        toks = tokens(text, start, end)
        n, kinds, moves = len(toks), range(len(KINDS) + 1), self.moves.tolist()
        ends: dict[int, list] = {}
        for i, j, names in features(text, toks):
            ends.setdefault(j, []).append((i, self.score(names).tolist()))
        if not ends:
            return []
        none = {k: float(self.score(("none" + k,))[0]) for k in "dap"}
        # Per place the best score of what ends there with each type, where that began, and the best way on to each type.
        entry, source = [moves[0]], [[0] * len(kinds)]
        last, back = [[0.0]], [[None]]
        for j in range(1, n + 1):
            k = toks[j - 1][2]
            here, began = [entry[j - 1][0] + none[k if k in "da" else "p"]], [j - 1]
            if j in ends:
                here += [-np.inf] * len(KINDS)
                began += [None] * len(KINDS)
                for i, score in ends[j]:
                    for y in kinds[1:]:
                        if (value := entry[i][y] + score[y]) > here[y]:
                            here[y], began[y] = value, i
            if len(here) == 1:
                entry.append([here[0] + m for m in moves[0]])
                source.append([0] * len(kinds))
            else:
                ways = [max((here[x] + moves[x][y], -x) for x in kinds) for y in kinds]
                entry.append([w[0] for w in ways])
                source.append([-w[1] for w in ways])
            last.append(here)
            back.append(began)
        out, j = [], n
        y = max(range(len(last[n])), key=last[n].__getitem__)
        while j > 0:
            i = back[j][y]
            if y:
                out.append((toks[i][0], y - 1, toks[j - 1][1]))
            y, j = source[i][y], i
        return out[::-1]


def all_spans(text: str, model: Field) -> tuple[list[Span], list[Span]]:
    """The patterns' spans, and all spans."""
    base = pattern_spans(text)
    if not model.weights:
        return base, base
    reached = reach_of(base)
    more = [(a, y, b) for start, end in islands(text) for a, y, b in model.spans(text, start, end) if reached(b) <= a]
    return base, sorted(base + more)


def reach_of(spans: list[Span]) -> Callable[[int], int]:
    """How far the spans that start before a place reach; 0 where none does."""
    starts, ends = [a for a, _, _ in spans], list(accumulate((b for _, _, b in spans), max, initial=0))
    return lambda at: ends[bisect_left(starts, at)]


def variants(island: str, gold: list[Span]) -> Iterator[tuple[str, list[Span]]]:
    """The island with its only span in other forms; the span comes with it."""
    if len(gold) != 1:
        return
    a, kind, b = gold[0]
    value = island[a:b]
    digits = NO_DIGIT.sub("", value)
    if kind == 1:
        forms = [value.replace(".", "[.]"), value.replace(".", "(.)")]
    elif kind == 2:
        cut = [digits[i:i + 4] for i in range(0, len(digits), 4)]
        forms = [s.join(cut) for s in (" ", "-", ".", "/")]
    elif kind == 3 and len(digits) >= 10:
        area, office, line = digits[-10:-7], digits[-7:-4], digits[-4:]
        forms = [f"({area}) {office}-{line}", f"{area}-{office}-{line}", f"{area}.{office}.{line}", f"{area} {office} {line}",
                 f"+{digits[:-10]}/{area}/{office}/{line}", f"00{digits[:-10]} {area} {office} {line}"]
    elif kind == 0:
        name, host = value.split("@")
        forms = [f"{name}[@]{host}", f"{name}(@){host}"]
    else:
        forms = []
    for form in forms:
        yield island[:a] + form + island[b:], [(a, kind, a + len(form))]


def structure(text: str, start: int, end: int, gold: list[Span]) -> tuple | None:
    """What training needs of an island: its candidates by features, its tokens, and its labelled spans; None if these do not fit."""
    toks = tokens(text, start, end)
    first, last = {a: i for i, (a, _, _) in enumerate(toks)}, {b: i + 1 for i, (_, b, _) in enumerate(toks)}
    found = tuple(features(text, toks))
    spans = {(i, j) for i, j, _ in found}
    labels = []
    for a, y, b in gold:
        if (first.get(a), last.get(b)) not in spans:
            return None
        labels.append((first[a], last[b], y + 1))
    return tuple("none" + (k if k in "da" else "p") for _, _, k in toks), found, tuple(labels)


def lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis=axis)


def grouped_lse(x: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """:func:`lse` over groups of rows that begin at ``at``."""
    top = np.maximum.reduceat(x, at, axis=0)
    top = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return np.log(np.add.reduceat(np.exp(x - np.repeat(top, sizes, axis=0)), at, axis=0)) + top


class Likelihood:
    """The exact likelihood of labelled islands and its gradient.

    All islands are summed side by side, place by place: every place between tokens is a
    node, every candidate span an edge from the node where it starts to the one where it ends.
    """

    def __init__(self, examples: Counter):
        self.names: dict[str, int] = {}
        kinds = len(KINDS) + 1
        ids, lengths, starts, ends, single, gold, weight = [], [], [], [], [], [], []
        self.gold_moves = np.zeros((kinds, kinds))
        places, nodes, last, node_weight = [], 0, [], []
        for (plain, found, labels), n in examples.items():
            segments = [(j, j + 1, (name,)) for j, name in enumerate(plain)] + list(found)
            where = {(i, j, k < len(plain)): len(starts) + k for k, (i, j, _) in enumerate(segments)}
            for k, (i, j, names) in enumerate(segments):
                ids += [self.names.setdefault(f, len(self.names)) for f in names]
                lengths.append(len(names))
                starts.append(nodes + i)
                ends.append(nodes + j)
                single.append(k < len(plain))
                weight.append(n)
            inside = {t for i, j, _ in labels for t in range(i, j)}
            prior = 0
            for i, j, y in sorted([*labels, *((t, t + 1, 0) for t in range(len(plain)) if t not in inside)]):
                gold.append((where[i, j, y == 0], y))
                self.gold_moves[prior, y] += n
                prior = y
            places += range(len(plain) + 1)
            node_weight += [n] * (len(plain) + 1)
            nodes += len(plain) + 1
            last.append(nodes - 1)
        self.ids, self.at = np.array(ids), np.cumsum([0] + lengths[:-1])
        self.lengths, self.starts, self.ends, self.single = (np.array(v) for v in (lengths, starts, ends, single))
        self.weight, self.last, self.places = np.array(weight, float), np.array(last), np.array(places)
        self.node_weight = np.array(node_weight, float)
        self.gold = np.zeros((len(starts), kinds))
        for k, y in gold:
            self.gold[k, y] = 1
        # Of every node the node that ends its island.
        self.island = np.searchsorted(self.last, np.arange(nodes))
        self.forward, self.backward = (self.layers(v) for v in (self.ends, self.starts))

    def layers(self, node: np.ndarray) -> list[tuple]:
        """Per place, in order: its spans, where each node's spans begin among them, how many they are, and the nodes."""
        order = np.lexsort((node, self.places[node]))
        cut = np.searchsorted(self.places[node[order]], np.arange(self.places.max() + 2))
        out = []
        for a, b in zip(cut, cut[1:]):
            if a < b:
                rows = order[a:b]
                nodes, at, sizes = np.unique(node[rows], return_index=True, return_counts=True)
                out.append((rows, at, sizes, nodes))
        return out

    def gradient(self, w: np.ndarray, moves: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        score = np.add.reduceat(w[self.ids], self.at, axis=0)
        score[self.single, 1:], score[~self.single, 0] = -np.inf, -np.inf
        nodes, kinds = len(self.places), score.shape[1]
        alpha = np.full((nodes, kinds), -np.inf)
        entry = np.full_like(alpha, -np.inf)
        alpha[self.places == 0, 0] = 0.0
        entry[self.places == 0] = moves[0]
        for rows, at, sizes, here in self.forward:
            alpha[here] = grouped_lse(entry[self.starts[rows]] + score[rows], at, sizes)
            entry[here] = lse(alpha[here][:, :, None] + moves[None], 1)
        # beta: what follows a span that ends at a node with each type; exits: what follows where one of each type starts.
        beta, exits = np.zeros_like(alpha), np.full_like(alpha, -np.inf)
        for rows, at, sizes, here in reversed(self.backward):
            exits[here] = grouped_lse(score[rows] + beta[self.ends[rows]], at, sizes)
            beta[here] = lse(moves[None] + exits[here][:, None, :], 2)
        z = lse(alpha[self.last], 1)
        z_node = z[self.island]
        share = np.exp(entry[self.starts] + score + beta[self.ends] - z_node[self.starts][:, None])
        passed = np.exp(alpha[:, :, None] + moves[None] + exits[:, None, :] - z_node[:, None, None])
        dm = self.gold_moves - (passed * self.node_weight[:, None, None]).sum(axis=0)
        off = self.weight[:, None] * (self.gold - share)
        rows = np.repeat(np.arange(len(self.lengths)), self.lengths)
        dw = np.stack([np.bincount(self.ids, off[rows, y], minlength=len(w)) for y in range(kinds)], axis=1)
        total = (self.weight[:, None] * np.where(self.gold > 0, score, 0)).sum() + (self.gold_moves * moves).sum()
        return float(total - (z * self.node_weight[self.last]).sum()), dw, dm


def fit(examples: Counter) -> Field:
    """The field of labelled islands (what :func:`structure` gives -> weight); one that finds nothing where none has a label."""
    if not any(labels for _, _, labels in examples):
        return Field()
    likelihood = Likelihood(examples)
    kinds = len(KINDS) + 1
    w, m = np.zeros((len(likelihood.names), kinds)), np.zeros((kinds, kinds))
    past_w, past_m, weight = np.full_like(w, 1e-8), np.full_like(m, 1e-8), sum(examples.values())
    for _ in range(STEPS):
        _, dw, dm = likelihood.gradient(w, m)
        dw, dm = dw / weight - PENALTY * w, dm / weight - PENALTY * m
        past_w += dw * dw
        past_m += dm * dm
        w += RATE * dw / np.sqrt(past_w)
        m += RATE * dm / np.sqrt(past_m)
    return Field({name: w[i] for name, i in likelihood.names.items()}, m)


LABELLED = "before string, island string, after string, spans array<struct<start:int,kind:int,end:int>>"


def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts -> their islands with the patterns' spans; islands that a span sticks out of are left out."""
    for b in batches:
        out = []
        for text in b.column(0).to_pylist():
            base = pattern_spans(text) if HOT.search(text) else []
            starts, reached = [a for a, _, _ in base], reach_of(base)
            for start, end in islands(text):
                inside = base[bisect_left(starts, start):bisect_left(starts, end)]
                if end - start <= TRAINED and reached(start) <= start and reached(end) <= end:
                    flat, last = [], -1
                    for a, y, z in inside:
                        if a >= last:
                            flat.append({"start": a - start, "kind": y, "end": z - start})
                            last = z
                    out.append((text[max(start - 1, 0):start], text[start:end], text[end:end + 1], flat))
        columns = list(zip(*out)) if out else [[]] * 4
        span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, (pa.string(), pa.string(), pa.string(), span))],
            names=["before", "island", "after", "spans"])


def sample(docs: DataFrame, documents: int = DOCUMENTS, most: int = ISLANDS) -> list[tuple[str, int, int, list[Span]]]:
    """About ``most`` different labelled islands of about ``documents`` documents: text with its neighbours, borders, spans."""
    texts = docs.select(F.col("text").cast("string").alias("text")).where("text is not null")
    every = -(-texts.count() // documents)
    drawn = texts.where(F.pmod(F.xxhash64(F.lit("personal"), "text"), F.lit(every)) == 0) if every > 1 else texts
    found = stored(drawn.mapInArrow(labelled, LABELLED).distinct(), "personal-islands")
    every = -(-found.count() // most)
    rows = found.where(F.pmod(F.xxhash64(F.lit("island"), "before", "island", "after"), F.lit(every)) == 0) if every > 1 else found
    out = []
    for r in sorted(rows.collect(), key=lambda r: (r["island"], r["before"], r["after"])):
        shift = len(r["before"])
        spans = [(s["start"] + shift, s["kind"], s["end"] + shift) for s in r["spans"]]
        out.append((r["before"] + r["island"] + r["after"], shift, shift + len(r["island"]), spans))
    return out


def examples(islands_: list[tuple[str, int, int, list[Span]]], varied: bool = True) -> Counter:
    """Labelled islands and their variants as what training needs, with weights."""
    out: Counter = Counter()
    for text, start, end, gold in islands_:
        forms = [(text, gold)] + (list(variants(text, gold)) if varied else [])
        for form, spans in forms:
            if (made := structure(form, start, end + len(form) - len(text), spans)) is not None:
                out[made] += 1
    return out


def train(docs: DataFrame, documents: int = DOCUMENTS, most: int = ISLANDS) -> Field:
    """A field for the texts of a corpus."""
    return fit(examples(sample(docs, documents, most)))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


FOUND = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"


def searched(model: Field) -> Callable:
    """(doc_id, text) -> counts, digest and list of spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, digests, lists = [], [], []
            for text in b.column(1).to_pylist():
                base, spans = all_spans(text, model) if HOT.search(text) else ([], [])
                counts.append([sum(k == y for _, k, _ in base) for y in range(len(KINDS))])
                digests.append(hashlib.sha256(listed(base).encode()).hexdigest())
                lists.append(listed(spans))
            n = np.array(counts, np.int64).reshape(-1, len(KINDS))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(n[:, y]) for y in range(len(KINDS))], pa.array(digests, pa.string()), pa.array(lists, pa.string())],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    return run


def report(docs: DataFrame, model: Field | None = None) -> DataFrame:
    """Per document: pattern spans per kind, their digest, and all spans as text."""
    model = model or train(docs)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
                       ).mapInArrow(searched(model), FOUND)


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span, overlapping ones as one, replaced by its kind."""
    out, at = [], 0
    for a, k, b in spans:
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: Field | None = None) -> DataFrame:
    """The documents with personal data replaced by its kind; other columns stay."""
    model = model or train(docs)

    @F.pandas_udf(StringType())
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            yield pd.Series([x if x is None or not HOT.search(x) else masked(x, all_spans(x, model)[1]) for x in t], dtype=object)

    rows = packed(docs).select("row", clean(F.col("row.text").cast("string")).alias("clean"))
    return rows.select(F.col("row").withField("text", F.col("clean")).alias("row")).select("row.*")
