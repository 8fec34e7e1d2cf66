"""Personal data: rules give base spans, a boosted model over wider candidates adds to them.

High-recall generators propose overlapping spans. Boosted trees judge them by
format and context. What they learn to add are forms that the rules don't know:
positives are base spans of the corpus rewritten into such forms (spelled-out
addresses, numbers without plus, other separators, IPv6) in their own contexts, negatives
look-alikes (dates, amounts, serial numbers) in the same and in other contexts and
candidates that a rule dropped. Any other candidate of the corpus is unlabelled: it is a
negative only if a first model, fitted without it, finds it unlikely. A threshold per
kind comes from the precision on candidates held out. Base spans always stay; of
overlapping additions the likeliest stays.
"""

from __future__ import annotations

import random
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import free_prefix, map_batches, sampled_texts, sigmoid, text_of

KINDS = ("email", "ip", "card", "phone")
#: Documents, and candidates of them, that the trees are fitted on.
DOCUMENTS, CANDIDATES = 8000, 40_000
#: Least calibrated probability of an addition, and lower bound (Wilson, 95 %) of the precision of all
#: held-out candidates above a kind's threshold; kinds that don't reach it add nothing.
PRECISION = 0.9
TREES, DEPTH, RATE, BINS = 40, 3, 0.3, 32

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Generators, wider than the rules.
_AT = re.compile(r"@|[(\[][aA][tT][)\]]")
_WIDE = {
    "email": re.compile(
        r"[\w.%+-]{1,64} ?(?:@|[(\[][aA][tT][)\]]) ?[\w-]{1,63}(?:(?:\.| ?[(\[][dD][oO][tT][)\]] ?)[\w-]{1,63}){1,6}"
    ),
    "ip": re.compile(
        r"(?<![\w:])(?:(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:])"
        r"|(?<![0-9])[0-9]{1,3}(?:(?:[.,-]|\[\.\])[0-9]{1,3}){3}(?![0-9])"
    ),
    "card": re.compile(
        r"(?<![0-9])(?:[0-9]{4}[ ./-]?[0-9]{4}[ ./-]?[0-9]{4}[ ./-]?[0-9]{4}(?:[ ./-]?[0-9]{1,3})?"
        r"|3[47][0-9]{2}[ ./-]?[0-9]{6}[ ./-]?[0-9]{5})(?![0-9])"
    ),
    "phone": re.compile(r"(?<![0-9])(?:\+|00|\()?[0-9]{1,4}\)?(?:[ ./-]{1,2}\(?[0-9]{2,8}\)?){1,5}(?![0-9])"),
}
# Words that often stand before personal data.
_HINTS = {
    "email": ("mail", "email", "e-mail", "contact", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "addr"),
    "card": ("card", "visa", "mastercard", "amex", "karte", "tarjeta", "carte"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "telefon", "teléfono", "téléphone"),
}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if k % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _emails(text: str):
    """Leftmost, without overlap, in time linear in the text: an at sign with what stands on either side."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        done = domain.end() if domain else done
        if domain:
            yield start, domain.end(), True
        at = text.find("@", max(at + 1, done))


def _addresses(text: str):
    """Runs of numbers with dots, taken by fours from the left."""
    for run in _NUMBERS.finditer(text):
        if "." in run.group():
            parts, start = run.group().split("."), run.start()
            for k in range(0, len(parts) - 3, 4):
                end = start + sum(map(len, parts[k : k + 4])) + 3
                yield start, end, all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts[k : k + 4])
                start = end + 1


def _cards(text: str):
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        yield m.start(), m.end(), 16 <= len(digits) <= 19 and luhn(digits)


def _phones(text: str):
    for m in _PHONE.finditer(text):
        yield m.start(), m.end(), 8 <= len(_DIGIT.findall(m.group())) <= 15


RULES = {"email": _emails, "ip": _addresses, "card": _cards, "phone": _phones}


def matches(text: str) -> dict[str, list[tuple[int, int, bool]]]:
    """By kind the matches (start, end, accepted) of the rules."""
    has_digit = _DIGIT.search(text)
    return {kind: list(rule(text)) if has_digit or kind == "email" else [] for kind, rule in RULES.items()}


def candidates(text: str) -> list[tuple[str, int, int]]:
    found, has_digit = [], _DIGIT.search(text)
    for kind, wide in _WIDE.items():
        if not (_AT.search(text) if kind == "email" else has_digit):
            continue
        found += [(kind, m.start(), m.end()) for m in wide.finditer(text)]
    return found


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format of the span, then what is around it."""
    span = text[start:end]
    digits = "".join(_DIGIT.findall(span))
    groups = re.split(r"[^0-9A-Za-z]+", span.strip("+()"))
    sizes = [len(g) for g in groups if g] or [0]
    before, after = text[max(0, start - 40) : start], text[end : end + 40]
    around = before + after
    words = before.lower().split()[-3:]
    return [
        KINDS.index(kind), len(span), len(digits), len(digits) / len(span), len(sizes), min(sizes), max(sizes), sizes[0], sizes[-1],
        span.startswith("+"), "(" in span, " " in span, "-" in span, span.count("."), span.count(":"), "::" in span, "@" in span,
        span.count(","), "/" in span, "[" in span, digits.startswith("00"), 1900 <= int(digits[:4] or 0) <= 2100, 1900 <= int(digits[-4:] or 0) <= 2100,
        luhn(digits) if digits else 0, all(g.isdigit() and int(g[:6]) <= 255 for g in groups if g), digits.startswith("0"),
        before[-1:].isalnum(), before[-1:] in (" ", "\n", ""), after[:1].isalnum(), after[:1] in (" ", "\n", "", ".", ","),
        len(_DIGIT.findall(around)) / max(1, len(around)), any(w.strip(":.#") in _HINTS[kind] for w in words),
    ]


@dataclass
class Trees:
    edges: list[np.ndarray]
    splits: np.ndarray  # tree, inner node: feature and bin
    leaves: np.ndarray  # tree, leaf
    bias: float
    scale: tuple[float, float]
    thresholds: dict[str, float]

    def raw(self, rows: np.ndarray) -> np.ndarray:
        binned = np.column_stack([e.searchsorted(rows[:, k]) for k, e in enumerate(self.edges)])
        total = np.full(len(rows), self.bias)
        for splits, leaves in zip(self.splits, self.leaves):
            at = np.zeros(len(rows), int)
            for _ in range(DEPTH):
                feature, cut = splits[at].T
                at = 2 * at + 1 + (binned[np.arange(len(rows)), feature] > cut)
            total += leaves[at - (2**DEPTH - 1)]
        return total

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return sigmoid(self.scale[0] * self.raw(rows) + self.scale[1])


def _grow(binned: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One tree on gradients and curvatures, all nodes of a depth at once."""
    n, width = binned.shape
    splits, at = np.zeros((2**DEPTH - 1, 2), int), np.zeros(n, int)
    for depth in range(DEPTH):
        base, nodes = 2**depth - 1, 2**depth
        slot = (at - base)[:, None] * (width * BINS) + np.arange(width) * BINS + binned
        sums = [np.bincount(slot.ravel(), np.repeat(x, width), nodes * width * BINS).reshape(nodes, width, BINS) for x in (g, h)]
        left = [s.cumsum(2) for s in sums]
        right = [s[:, :, -1:] - s for s in left]
        gain = left[0] ** 2 / (left[1] + 1) + right[0] ** 2 / (right[1] + 1)
        best = gain.reshape(nodes, -1).argmax(1)
        splits[base : base + nodes] = np.column_stack(np.divmod(best, BINS))
        feature, cut = splits[at].T
        at = 2 * at + 1 + (binned[np.arange(n), feature] > cut)
    at -= 2**DEPTH - 1
    return splits, RATE * np.bincount(at, g, 2**DEPTH) / (np.bincount(at, h, 2**DEPTH) + 1)


def fit(rows: np.ndarray, labels: np.ndarray, half: np.ndarray | None = None) -> Trees | None:
    """Trees on ``half`` of the candidates, calibration and thresholds on the other; None without both labels in each half."""
    half = np.arange(len(labels)) % 2 == 0 if half is None else half
    if len(labels) < 4 or not 0 < labels[half].mean() < 1 or not 0 < labels[~half].mean() < 1:
        return None
    x, y = rows[half], labels[half].astype(float)
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for k in range(x.shape[1])]
    binned = np.column_stack([e.searchsorted(x[:, k]) for k, e in enumerate(edges)])
    bias = float(np.log(y.mean() / (1 - y.mean())))
    total, splits, leaves = np.full(len(y), bias), [], []
    for _ in range(TREES):
        p = sigmoid(total)
        s, v = _grow(binned, y - p, p * (1 - p))
        splits.append(s)
        leaves.append(v)
        total = bias + Trees(edges, np.array(splits), np.array(leaves), 0.0, (1, 0), {}).raw(x)
    model = Trees(edges, np.array(splits), np.array(leaves), bias, (1.0, 0.0), {})
    z, seen = model.raw(rows[~half]), labels[~half].astype(float)
    design, w = np.column_stack([z, np.ones(len(z))]), np.array([1.0, 0.0])
    for _ in range(30):
        p = sigmoid(design @ w)
        w = w + np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2), design.T @ (seen - p) - 1e-3 * w)
    model.scale = float(w[0]), float(w[1])
    p = model.probability(rows[~half])
    for k, kind in enumerate(KINDS):
        own = rows[~half][:, 0] == k
        order = np.argsort(-p[own], kind="stable")
        right, n = seen[own][order].cumsum(), np.arange(1, own.sum() + 1)
        share = right / n
        low = (share + 1.92 / n - 1.96 * np.sqrt(share * (1 - share) / n + 0.96 / n**2)) / (1 + 3.84 / n)
        good = np.nonzero(low >= PRECISION)[0]
        if len(good):
            # Between the last candidate that may pass and the next one.
            ranked = np.append(p[own][order], 0.0)
            model.thresholds[kind] = max(float(ranked[good[-1] : good[-1] + 2].mean()), PRECISION)
    return model


def _with_luhn(digits: str) -> str:
    """The digits with a last one that makes the check sum right."""
    return digits + next(c for c in "0123456789" if luhn(digits + c))


def _digits(draw: random.Random, n: int) -> str:
    return "".join(draw.choice("0123456789") for _ in range(n))


def disguises(kind: str, span: str, draw: random.Random) -> list[str]:
    """Forms of a base span that its rule doesn't know."""
    digits = "".join(_DIGIT.findall(span))
    if kind == "email":
        name, _, host = span.partition("@")
        at = draw.sample([(" (at) ", " (dot) "), ("(at)", "(dot)"), (" [at] ", "."), ("[at]", "[dot]"), (" @ ", "."), (" (AT) ", ".")], 4)
        return [name + a + host.replace(".", dot) for a, dot in at]
    if kind == "ip":
        groups = [f"{draw.choice((0, draw.randrange(256), draw.randrange(65536), draw.randrange(65536))):x}" for _ in range(8)]
        small = ".".join(str(draw.randrange(draw.choice((10, 100, 256)))) for _ in range(4))
        left, right = draw.randrange(1, 5), draw.randrange(4, 8)
        return [":".join(groups), ":".join(groups[:left]) + "::" + ":".join(groups[right:]), span.replace(".", "[.]"), small.replace(".", "[.]"), span.replace(".", "-")]
    if kind == "card":
        amex = _with_luhn("3" + draw.choice("47") + _digits(draw, 12))
        four = [digits[k : k + 4] for k in range(0, len(digits), 4)]
        return [".".join(four), "/".join(four), f"{amex[:4]} {amex[4:10]} {amex[10:]}", amex]
    area, middle, last = draw.choice("23456789") + _digits(draw, 2), _digits(draw, 3), _digits(draw, 4)
    city, number = "0" + draw.choice("123456789") + _digits(draw, draw.randrange(1, 3)), _digits(draw, 8)
    forms = [
        f"({area}) {middle}-{last}", f"{area}-{middle}-{last}", f"{area}.{middle}.{last}", f"{city} {number[:4]} {number[4:]}",
        f"{city}/{number[:7]}", f"{city}-{number}", "00" + span[1:] if re.fullmatch(r"\+[0-9]{1,3}[ -].*", span) else f"0044 {area[1:]} {last} {last}",
    ]
    return draw.sample(forms, 4)


def look_alikes(draw: random.Random) -> list[str]:
    """Numbers that the generators propose and that are nobody's: dates, ranges, amounts, versions, serial and part numbers."""
    d, year, month, day = lambda n: _digits(draw, n), draw.randrange(1900, 2100), draw.randrange(1, 13), draw.randrange(1, 29)
    bad = _digits(draw, 16)
    bad = bad if not luhn(bad) else bad[:-1] + str((int(bad[-1]) + 1) % 10)
    cut = [bad[k : k + 4] for k in range(0, 16, 4)]
    forms = [
        f"{year}-{month:02}-{day:02}", f"{day:02}.{month:02}.{year}", f"{month}/{day}/{year}", f"{year}-{year + draw.randrange(1, 30)}", f"{year}/{year % 100 + 1:02}",
        f"{day}-{month:02}", f"{draw.randrange(1, 999)} {d(3)} {d(3)}", f"{draw.randrange(1, 9)},{d(3)},{d(3)},{d(3)}", f"{draw.randrange(1, 9)},{draw.choice(('250', '100', '000'))},000,000", f"{draw.randrange(1, 999)}.{d(2)}",
        f"{draw.randrange(1, 20)}.{draw.randrange(40)}.{d(2)}", f"{year}-{d(6)}", f"{d(3)}-{d(2)}-{d(4)}", f"{d(5)}-{d(4)}",
        f"{draw.randrange(100, 999)}-{d(2)}", f"{d(2)}/{d(2)}", ".".join(cut), " ".join(cut), "/".join(cut), bad,
        ":".join(f"{draw.randrange(256):02x}" for _ in range(6)), f"{draw.randrange(24):02}:{draw.randrange(60):02}:{draw.randrange(60):02}:{d(2)}",
        f"{draw.randrange(256, 999)}-{d(3)}-{d(3)}-{d(3)}", f"{draw.randrange(1, 9)},{draw.randrange(1, 9)},{draw.randrange(1, 9)},{draw.randrange(1, 9)}",
    ]
    return draw.sample(forms, 3)


def _training(sample: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the sample's texts: features, labels (-1 unlabelled), and the text's number, of candidates; repeats of a text count once."""
    rows, labels, source = [], [], []

    def put(before: str, form: str, after: str, kind: str | None, number: int) -> None:
        """Candidates over a planted form: right is the whole form as its kind, any other is wrong."""
        text, start, end = before[-60:] + form + after[:60], len(before[-60:]), len(before[-60:]) + len(form)
        taken = [m for several in matches(text).values() for m in several if m[2]]
        for of, s, e in candidates(text):
            if s < end and start < e and not any(m[0] < e and s < m[1] for m in taken):
                rows.append(features(text, of, s, e))
                labels.append(int((of, s, e) == (kind, start, end)))
                source.append(number)

    for number, text in enumerate(dict.fromkeys(sample)):
        draw, found = random.Random(zlib.crc32(text.encode("utf-8", "replace"))), matches(text)
        accepted = [(kind, s, e) for kind in KINDS for s, e, good in found[kind] if good]
        for kind, start, end in accepted[:32]:
            for form in disguises(kind, text[start:end], draw):
                put(text[:start], form, text[end:], kind, number)
            for form in look_alikes(draw):
                put(text[:start], form, text[end:], None, number)
        blanks = [m.start() for m in re.finditer(r" ", text[:100_000])]
        if blanks and (accepted or draw.random() < 0.1):
            for form in look_alikes(draw):
                at = draw.choice(blanks)
                put(text[: at + 1], form, text[at:], None, number)
        for kind, start, end in candidates(text):
            if not any(s < end and start < e for _, s, e in accepted):
                dropped = any(m[:2] == (start, end) for m in found[kind])
                rows.append(features(text, kind, start, end))
                labels.append(0 if dropped else -1)
                source.append(number)
        if len(rows) >= CANDIDATES:
            break
    return np.array(rows, float), np.array(labels, int), np.array(source, int)


def fit_texts(sample: list[str]) -> Trees | None:
    """Fit on texts: once on what is labelled, then with the unlabelled candidates that this finds unlikely as negatives."""
    rows, labels, source = _training(sample)
    half, known = source % 2 == 0, labels >= 0
    first = fit(rows[known], labels[known] == 1, half[known])
    if first is None or known.all():
        return first
    known[~known] = first.probability(rows[~known]) < 0.5
    return fit(rows[known], labels[known] == 1, half[known])


def fit_pii(docs: DataFrame, documents: int = DOCUMENTS) -> Trees | None:
    """Fit on the candidates of at most so many rows, drawn by a hash of the id."""
    anyone = docs.select("doc_id", F.lit(None).alias("label")).where("doc_id IS NOT NULL")
    return fit_texts([t for t, _ in sampled_texts(docs, anyone, documents)])


def added_spans(text: str, found: dict[str, list[tuple[int, int, bool]]], model: Trees) -> list[tuple[str, int, int, float]]:
    """Candidates over their threshold that touch no base span; of overlapping ones the likeliest, then the first."""
    taken = [(s, e) for several in found.values() for s, e, good in several if good]
    proposed = [c for c in candidates(text) if c[0] in model.thresholds and not any(s < c[2] and c[1] < e for s, e in taken)]
    if not proposed:
        return []
    p = model.probability(np.array([features(text, *c) for c in proposed], float))
    chosen = []
    for k in np.lexsort(([c[1] for c in proposed], -p)):
        kind, start, end = proposed[k]
        if p[k] >= model.thresholds[kind] and not any(s < end and start < e for _, s, e, _ in chosen):
            chosen.append((kind, start, end, float(p[k])))
    return chosen


SPANS = "array<struct<kind:string,start:int,end:int,base:boolean,p:double>>"


def find_pii(docs: DataFrame, model: Trees | None, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all if None) with ``pii``: spans by kind (in the order of ``KINDS``), then start.

    ``base`` marks spans of the rules (p = 1). Offsets count characters, the end is exclusive.

    * A null text is the empty text; texts without any span have an empty list.
    * Without a model there are base spans only.
    * A column called ``pii`` is replaced; all others pass. Repeated rows get the same result.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c != "pii"]
    scored = free_prefix("__scored", keep)
    rows = docs.select(*[F.col(c) for c in keep], text_of().alias(scored))
    schema = rows.drop(scored).withColumn("pii", F.lit(None).cast(SPANS)).schema
    last = len(keep)
    kind_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("p", pa.float64())]))

    def spans(text: str) -> list[tuple]:
        found = matches(text)
        result = [(kind, s, e, True, 1.0) for kind in KINDS for s, e, good in found[kind] if good]
        if model:
            result += [(kind, s, e, False, p) for kind, s, e, p in added_spans(text, found, model)]
        return sorted(result, key=lambda x: (KINDS.index(x[0]), x[1]))

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [spans(t) for t in batch.column(last).to_pylist()]
            return pa.RecordBatch.from_arrays([*batch.columns[:last], pa.array(found, kind_type)], [*keep, "pii"])

        return step

    return map_batches(rows, make, schema)
