"""Personal data: fixed base rules, and a semi-Markov conditional random field that adds spans.

The base rules find e-mail addresses, IP addresses, card numbers and phone numbers. The random field works
on regions, runs of words with a digit or an at sign. It scores whole candidate spans of bounded length
by features of the span as a whole (its shape, digit count, checksum, neighbours), and dynamic
programming picks boundaries and types together, the best segmentation of the region into spans and
single atoms outside any. It is trained here, by gradient ascent of the likelihood, on regions of a
bounded sample of documents labelled by the base rules, and on made-up variants of them: phone numbers
without their country code as positives, failing checksums and octets as negatives.
"""

from __future__ import annotations

import math
import random
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlake.llm.common import small_batches

#: Fixed by the contract: the kinds in order, and the pattern of each.
KINDS = ("email", "ip", "card", "phone")
_TRIGGER = re.compile("[0-9@]")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_QUAD = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[str, int, int]


def digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def octets(text: str) -> bool:
    """Whether the text is four runs of digits, a point apart, of at most 255 each."""
    return bool(_QUAD.fullmatch(text)) and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their at signs, so that long words cost no more than their length."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.fullmatch(text, start - 1, start) and text[start - 1 : start]:
            start -= 1
        found = _DOMAIN.match(text, at)
        if found and start < at:
            yield start, found.end()
            done = found.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """The spans of the base rules, by kind, then start. Offsets are code points, ends exclusive."""
    if not _TRIGGER.search(text):
        return []
    out: list[Span] = [("email", a, b) for a, b in _emails(text)]
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if octets(m[0])]
    for m in _CARD.finditer(text):
        number = digits(m[0])
        if 13 <= len(number) <= 19 and luhn(number):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return out


# the random field

_REGION = re.compile(r"[^\s0-9@]*[0-9@][^\s]*(?:\x20[^\s0-9@]*[0-9@][^\s]*)*")
_ATOM = re.compile(r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9]")
_INSIDE = re.compile(r"[A-Za-z0-9@._%+() -]+")
MAX_ATOMS, MAX_CHARS = 24, 80


def regions(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _REGION.finditer(text)]


def _shape(text: str) -> str:
    out = re.sub("[A-Za-z]+", "a", text)
    return re.sub("[0-9]+", lambda m: str(min(len(m[0]), 5)), out)[:24]


def _kind_of(c: str) -> str:
    return "" if not c else "0" if c.isdigit() else "a" if c.isalpha() else "_" if c.isspace() else c


def plausible(span: str) -> list[str]:
    """The kinds that a span could be of; spans of no kind are never scored."""
    n = sum(c.isdigit() for c in span)
    out = []
    if "@" in span and span.count("@") == 1 and " " not in span and 0 < span.index("@") < span.rfind("."):
        out.append("email")
    if "@" in span or re.search("[A-Za-z_%]", span):
        return out
    if _QUAD.fullmatch(span):
        out.append("ip")
    if 12 <= n <= 20 and span[0].isdigit() and not re.search("[().+]", span):
        out.append("card")
    if 7 <= n <= 16 and (span[0] in "+(" or span[0].isdigit()):
        out.append("phone")
    return out


def span_features(text: str, start: int, end: int, kind: str) -> list[str]:
    """What holds of the span as a whole and of what stands next to it."""
    span = text[start:end]
    number = digits(span)
    before, after = text[start - 1 : start], text[end : end + 1]
    out = [f"n{min(len(number), 20)}", f"s{_shape(span)}", f"b{_kind_of(before)}", f"e{_kind_of(after)}", "bias"]
    out.append(f"w{_kind_of(before)}{_kind_of(span[0])}")
    out.append(f"v{_kind_of(span[-1])}{_kind_of(after)}")
    if kind == "card":
        out.append(f"luhn{luhn(number)}")
    elif kind == "ip":
        out.append(f"octets{octets(span)}")
    elif kind == "email":
        out.append(f"tld{span.rpartition('.')[2].isalpha()}")
    else:
        out.append(f"plus{span[0] == '+'}")
        out.append(f"groups{min(len(re.findall('[0-9]+', span)), 6)}")
    return [f"{kind} {f}" for f in out]


class Region:
    """The atoms of a region and its candidate segments, whose features are made when asked for."""

    def __init__(self, text: str, start: int, end: int):
        self.text = text
        self.cuts = [start + m.start() for m in _ATOM.finditer(text[start:end])] + [end]

    def ending_at(self, j: int) -> Iterator[tuple[int, str, list[str]]]:
        """The first atom, kind and features of every candidate that ends before atom ``j``; long spans come last."""
        text, z = self.text, self.cuts[j]
        if not text[z - 1].isalnum():
            return
        for i in range(j - 1, max(j - MAX_ATOMS, 0) - 1, -1):
            a = self.cuts[i]
            if z - a > MAX_CHARS or not _INSIDE.fullmatch(text, a, self.cuts[i + 1]):
                return
            if text[a] not in ") @":
                for kind in plausible(text[a:z]):
                    yield i, kind, span_features(text, a, z, kind)

    def best(self, weights: dict[str, float]) -> list[Span]:
        """The segmentation with the greatest score; of equal ones that with single atoms, then shorter spans, last."""
        top = [(0.0, -1, "")]
        for j in range(1, len(self.cuts)):
            choice = (top[j - 1][0], j - 1, "")
            for i, kind, names in self.ending_at(j):
                score = top[i][0] + sum(weights.get(n, 0.0) for n in names)
                if score > choice[0]:
                    choice = (score, i, kind)
            top.append(choice)
        out, j = [], len(self.cuts) - 1
        while j:
            _, i, kind = top[j]
            if kind:
                out.append((kind, self.cuts[i], self.cuts[j]))
            j = i
        return out[::-1]

    def candidates(self) -> list[list[tuple[int, str, list[str]]]]:
        """:meth:`ending_at` for every end, for training on short regions."""
        return [[], *(list(self.ending_at(j)) for j in range(1, len(self.cuts)))]

    def gradient(self, by_end: list, weights: dict[str, float], gold: set[Span], out: dict[str, float]) -> None:
        """Add observed less expected feature counts, by the forward-backward sums over segmentations of :meth:`candidates`."""
        n = len(self.cuts)
        scores = [[sum(weights.get(x, 0.0) for x in names) for _, _, names in ends] for ends in by_end]
        forward = [0.0] * n
        for j in range(1, n):
            terms = [forward[j - 1], *(forward[c[0]] + s for c, s in zip(by_end[j], scores[j], strict=True))]
            top = max(terms)
            forward[j] = top + math.log(sum(math.exp(t - top) for t in terms))
        backward = [-math.inf] * n
        backward[-1] = 0.0

        def add(a: float, b: float) -> float:
            top = max(a, b)
            return top if top == -math.inf else top + math.log(math.exp(a - top) + math.exp(b - top))

        for j in range(n - 1, 0, -1):
            backward[j - 1] = add(backward[j - 1], backward[j])
            for (i, _, _), s in zip(by_end[j], scores[j], strict=True):
                backward[i] = add(backward[i], backward[j] + s)
        for j in range(1, n):
            for (i, kind, names), s in zip(by_end[j], scores[j], strict=True):
                share = ((kind, self.cuts[i], self.cuts[j]) in gold) - math.exp(forward[i] + s + backward[j] - forward[-1])
                if abs(share) > 1e-4:
                    for x in names:
                        out[x] += share


def _variants(text: str, spans: list[Span], rng: random.Random) -> list[tuple[str, list[Span]]]:
    """Made-up neighbours of a labelled region: what the base rules can't show."""
    out = []
    for kind, a, b in spans:
        span, left, right = text[a:b], text[max(0, a - 12) : a], text[b : b + 12]
        if kind == "phone" and " (" in span:
            made = span[span.index("(") :]
            out.append((left + made + right, [("phone", len(left), len(left) + len(made))]))
        elif kind == "card":
            made = span[:-1] + str((int(span[-1]) + rng.randint(1, 9)) % 10)
            out.append((left + made + right, []))
        elif kind == "ip":
            made = span.rpartition(".")[0] + f".{rng.randint(256, 999)}"
            out.append((left + made + right, []))
    return out


def train(docs: DataFrame, max_docs: int = 4000, max_regions: int = 1200, max_length: int = 400, rounds: int = 12) -> dict[str, float]:
    """Feature weights from a bounded sample.

    It has at most ``max_regions`` different regions, the first by a hash of their text, of at most ``max_length``
    characters, from at most ``max_docs`` documents, the first by a hash of their id. Regions of any length are
    searched. Null texts and rows without a ``doc_id`` teach nothing; repeated rows count once; only ``doc_id`` and
    ``text`` are read. Without regions, as in an empty table, there are no weights, and the field then adds nothing.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chosen = rows.select("doc_id").where("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").limit(max_docs)
    sample = rows.join(F.broadcast(chosen), "doc_id")  # at most max_docs ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for text in batch.column(1).to_pylist():
                found.update((text or "")[max(0, a - 12) : b + 12] for a, b in regions(text or "") if b - a <= max_length)
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], ["region"])

    got = sample.mapInArrow(run, "region string").distinct().orderBy(F.xxhash64("region"), "region").limit(max_regions)
    examples = [(r["region"], base_spans(r["region"])) for r in got.collect()]  # at most max_regions short texts
    rng = random.Random(7)
    examples += [v for text, spans in examples for v in _variants(text, spans, rng)]
    cut = [(Region(text, a, b), set(spans)) for text, spans in examples for a, b in regions(text)]
    cut = [(region, by_end, gold) for region, gold in cut if any(by_end := region.candidates())]
    weights: dict[str, float] = defaultdict(float)
    for i in range(rounds):
        rate = 0.5 / (1 + 0.3 * i)
        rng.shuffle(cut)
        for region, by_end, gold in cut:
            change: dict[str, float] = defaultdict(float)
            region.gradient(by_end, weights, gold, change)
            for name, g in change.items():
                weights[name] += rate * (g - 1e-3 * weights[name])
    return dict(weights)


def all_spans(text: str, weights: dict[str, float]) -> tuple[list[Span], list[Span]]:
    """The base spans, and all spans: those and the field's that overlap none of them, by kind, then start."""
    base = base_spans(text)
    if not _TRIGGER.search(text):
        return base, base
    taken = sorted((a, b) for _, a, b in base)
    more = []
    for a, b in regions(text):
        for kind, x, y in Region(text, a, b).best(weights):
            if not any(p < y and x < q for p, q in taken):
                more.append((kind, x, y))
    return base, sorted(base + more, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str, spans: list[Span]) -> str:
    """The text with each run of overlapping spans replaced by the name of its first kind."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join(out) + text[done:]


def find(docs: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``doc_id``, the base counts, ``base`` and ``spans`` as ``kind:start:end`` lists, for every row.

    A null text counts as empty; repeated rows are searched alike; only ``doc_id`` and ``text`` are read;
    an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [all_spans(t or "", weights) for t in batch.column(1).to_pylist()]
            counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in KINDS]
            lists = [pa.array([joined(x[i]) for x in found], pa.string()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, *lists], names)

    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base string, spans string"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def mask(docs: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``docs`` with all its columns and every span of its texts replaced by its kind.

    Null texts stay null, empty ones empty; repeated rows are masked alike; other columns, whatever their names, stay as
    they are; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def clean(texts):
        return texts.map(lambda t: redact(t, all_spans(t, weights)[1]) if isinstance(t, str) and _TRIGGER.search(t) else t)

    return docs.withColumn("text", clean(F.col("text").cast("string")))
