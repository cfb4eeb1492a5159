"""Personal data: base patterns, and a semi-Markov conditional random field over whole spans that adds to them.

Places with digits or an @ are cut into groups; candidate segments are stretches of groups scored as wholes (checksum,
grouping, separators, context), and dynamic programming over segments of bounded length chooses boundaries and kinds
together. Weights come from the base patterns' own matches in a bounded sample: what a pattern finds teaches how a span
looks, so spans the pattern lost (two numbers run together, a sign stuck to them) score as well.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")  # fixed values: order of the output
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_DIGIT = re.compile(r"[0-9]")
_ZONE = re.compile(r"[+(]?[0-9](?:[0-9().+-]|\x20(?=[0-9(+]))*[0-9]")
MOST_GROUPS, MOST_CHARS = 8, 40  # longest entity
_NONE = len(KINDS)  # label outside entities


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _small(number: str) -> bool:
    number = number.lstrip("0")
    return len(number) <= 3 and int(number or 0) <= 255


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Leftmost non-overlapping matches of each kind that pass its check; positions in code points.

    Every scan is linear: an address is read backwards from its @, dotted numbers are taken in fours.
    """
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    at, free = text.find("@"), 0
    while at >= 0:
        i = at
        while i > free and text[i - 1] in _LOCAL:
            i -= 1
        m = _DOMAIN.match(text, at + 1) if i < at else None
        if m:
            out["email"].append((i, m.end()))
            free = m.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", at + 1)
    if not _DIGIT.search(text):
        return out
    for m in _DOTTED.finditer(text):
        parts = list(_DIGITS.finditer(text, m.start(), m.end()))
        for k in range(0, len(parts) - 3, 4):
            if all(_small(p.group()) for p in parts[k : k + 4]):
                out["ip"].append((parts[k].start(), parts[k + 3].end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out["card"].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGIT.findall(m.group())) <= 15:
                out["phone"].append(m.span())
    return out


def _around(c: str) -> int:
    return 0 if c == "" or c.isspace() else 1 if c.isalpha() else 2 if c.isdigit() else 3


def features(text: str, start: int, end: int, kind: str) -> list[str]:
    """Names of the features of one candidate span."""
    span = text[start:end]
    digits = "".join(_DIGIT.findall(span))
    out = [f"bias:{kind}", f"left:{kind}:{_around(text[start - 1 : start])}", f"right:{kind}:{_around(text[end : end + 1])}"]
    if kind == "email":
        local, _, domain = span.partition("@")
        tail = domain.rsplit(".", 1)[-1]
        return out + [f"email:dot:{'.' in domain.strip('.')}", f"email:tail:{tail.isalpha() and len(tail) >= 2}", f"email:local:{bool(local) and local.isascii()}",
                      f"email:edges:{domain[-1:].isalnum() and local[:1].isalnum()}"]
    groups = [len(g) for g in _DIGITS.findall(span)]
    n = len(digits)
    between = "".join(sorted(set(span) - set("0123456789")))
    out += [f"digits:{kind}:{'<8' if n < 8 else '8-11' if n < 12 else '12-15' if n < 16 else '16-19' if n < 20 else '>19'}", f"marks:{kind}:{between}", f"plus:{kind}:{span[0] == '+'}"]
    if kind == "card":
        fits = 16 <= n <= 19 and set(between) <= {" ", "-"}
        out.append(f"card:valid:{fits and luhn(digits)}")
    elif kind == "ip":
        out.append(f"ip:valid:{len(groups) == 4 and between == '.' and all(_small(g) for g in _DIGITS.findall(span))}")
    else:
        out.append(f"phone:groups:{len(groups) if len(groups) < 6 else 6}")
        out.append(f"phone:valid:{span[0] == '+' and 8 <= n <= 15}")
    return out


class Taken:
    """Spans that are taken; they may overlap."""

    def __init__(self, spans: list[tuple[int, int]]):
        spans = sorted(spans)
        self.starts = [s for s, _ in spans]
        self.reach = list(accumulate((e for _, e in spans), max))  # the furthest end up to each span

    def meets(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end)
        return before > 0 and self.reach[before - 1] > start


class Zone:
    """A stretch of text cut into groups, and its candidate segments (first group, group after the last, kind, span)."""

    def __init__(self, text: str, start: int, end: int, taken: Taken):
        self.start, self.end = start, end
        if "@" in text[start:end]:
            low, high = start, end
            while low < high and not (text[low].isalnum() or text[low] in "_%+"):
                low += 1
            while high > low and not text[high - 1].isalnum():
                high -= 1
            self.groups = [(start, end)]
            found = [(0, 1, 0, low, high)] if "@" in text[low + 1 : high - 1] else []
        else:
            self.groups = [m.span() for m in _DIGITS.finditer(text, start, end)]
            found = []
            for i, (s, _) in enumerate(self.groups):
                for j in range(i, min(len(self.groups), i + MOST_GROUPS)):
                    e = self.groups[j][1]
                    if e - s > MOST_CHARS:
                        break
                    n = sum(b - a for a, b in self.groups[i : j + 1])
                    if j - i == 3:
                        found.append((i, j + 1, 1, s, e))
                    if n >= 12:
                        found.append((i, j + 1, 2, s, e))
                    if 7 <= n <= 17:
                        lead = s - 1 if s > start and text[s - 1] in "+(" else s
                        if text[lead] == "(" and lead > start and text[lead - 1] == "+":
                            lead -= 1
                        found.append((i, j + 1, 3, lead, e))
        self.segments = [x for x in found if not taken.meets(x[3], x[4])]


def zones(text: str) -> Iterator[tuple[int, int]]:
    if _DIGIT.search(text):
        for m in _ZONE.finditer(text):
            if len(_DIGIT.findall(m.group())) >= 7 and m.group().count("@") == 0:
                yield m.span()
    if "@" in text:
        at = text.find("@")
        while at >= 0:
            low, high = at, at + 1
            while low > 0 and not text[low - 1].isspace() and text[low - 1] not in "@<>()[]\"',;:":
                low -= 1
            while high < len(text) and not text[high].isspace() and text[high] not in "@<>()[]\"',;:":
                high += 1
            if low < at and high > at + 1:
                yield low, high
            at = text.find("@", at + 1)


class Model:
    def __init__(self):
        self.weight: dict[str, float] = {}
        self.step = np.zeros((_NONE + 1, _NONE + 1))

    def scored(self, text: str, zone: Zone) -> list[tuple[int, int, int, float, list[str]]]:
        out = []
        for i, j, k, s, e in zone.segments:
            f = features(text, s, e, KINDS[k])
            out.append((i, j, k, sum(self.weight.get(x, 0.0) for x in f), f))
        return out

    def best(self, text: str, zone: Zone) -> list[tuple[int, int, int]]:
        """Viterbi over segments: (kind, start, end) of the best segmentation; outside wins ties."""
        n = len(zone.groups)
        by_end: dict[int, list] = {}
        for (i, j, k, s, e), (_, _, _, v, _) in zip(zone.segments, self.scored(text, zone)):
            by_end.setdefault(j, []).append((i, k, s, e, v))
        score = np.full((n + 1, _NONE + 1), -np.inf)
        back: list[list] = [[None] * (_NONE + 1) for _ in range(n + 1)]
        score[0, _NONE] = 0.0
        for j in range(1, n + 1):
            moves = [(j - 1, _NONE, None, None, 0.0), *by_end.get(j, [])]
            for i, k, s, e, v in moves:
                total = score[i] + self.step[:, k]
                y = int(total.argmax())
                if total[y] + v > score[j, k] + 1e-9:
                    score[j, k], back[j][k] = total[y] + v, (i, y, s, e)
        out, j = [], n
        k = _NONE if score[n, _NONE] >= score[n].max() - 1e-9 else int(score[n].argmax())
        while j:
            i, y, s, e = back[j][k]
            if k != _NONE:
                out.append((k, s, e))
            j, k = i, y
        return out[::-1]


def _log_sum(x: np.ndarray) -> float:
    top = x.max()
    return top + np.log(np.exp(x - top).sum()) if np.isfinite(top) else -np.inf


def fit(examples: list[tuple[str, list[tuple[int, int, int]]]], rounds: int = 8, rate: float = 0.3, penalty: float = 1e-3) -> Model:
    """Maximum likelihood by AdaGrad, one zone at a time: (zone text with context, gold (kind, start, end))."""
    model, size = Model(), {}
    step_size = np.full_like(model.step, 1e-8)
    ready = []
    for text, start, end, gold in examples:
        zone = Zone(text, start, end, Taken([]))
        known = {(k, s, e) for k, s, e in gold}
        segs = [(i, j, k, features(text, s, e, KINDS[k]), (k, s, e) in known) for i, j, k, s, e in zone.segments]
        if segs and sum(x[4] for x in segs) == len(known):
            ready.append((len(zone.groups), segs))
    for _ in range(rounds):
        for n, segs in ready:
            by_end: dict[int, list[int]] = {}
            by_start: dict[int, list[int]] = {}
            value = []
            for x, (i, j, k, f, _) in enumerate(segs):
                value.append(sum(model.weight.get(a, 0.0) for a in f))
                by_end.setdefault(j, []).append(x)
                by_start.setdefault(i, []).append(x)
            alpha, beta = np.full((n + 1, _NONE + 1), -np.inf), np.full((n + 1, _NONE + 1), -np.inf)
            alpha[0, _NONE], beta[n] = 0.0, 0.0
            for j in range(1, n + 1):
                terms: dict[int, list[float]] = {_NONE: [_log_sum(alpha[j - 1] + model.step[:, _NONE])]}
                for x in by_end.get(j, []):
                    i, _, k, _, _ = segs[x]
                    terms.setdefault(k, []).append(_log_sum(alpha[i] + model.step[:, k]) + value[x])
                for k, t in terms.items():
                    alpha[j, k] = _log_sum(np.array(t))
            for i in range(n - 1, -1, -1):
                ahead = [(_NONE, beta[i + 1, _NONE])] + [(segs[x][2], value[x] + beta[segs[x][1], segs[x][2]]) for x in by_start.get(i, [])]
                for y in range(_NONE + 1):
                    beta[i, y] = _log_sum(np.array([model.step[y, k] + v for k, v in ahead]))
            total = _log_sum(alpha[n])
            grad: dict[str, float] = {}
            step = np.zeros_like(model.step)
            inside = [0.0] * (n + 1)
            for x, (i, j, k, f, gold) in enumerate(segs):
                part = np.exp(alpha[i] + model.step[:, k] + value[x] + beta[j, k] - total)
                step[:, k] -= part
                lack = float(gold) - part.sum()
                for a in f:
                    grad[a] = grad.get(a, 0.0) + lack
            for j in range(1, n + 1):
                step[:, _NONE] -= np.exp(alpha[j - 1] + model.step[:, _NONE] + beta[j, _NONE] - total)
            chosen = {i: (j, k) for i, j, k, _, g in segs if g}
            at, y = 0, _NONE
            while at < n:
                to, k = chosen.get(at, (at + 1, _NONE))
                step[y, k] += 1
                at, y = to, k
            for a, g in grad.items():
                g -= penalty * model.weight.get(a, 0.0)
                size[a] = size.get(a, 1e-8) + g * g
                model.weight[a] = model.weight.get(a, 0.0) + rate * g / size[a] ** 0.5
            step_size += step * step
            model.step += rate * step / np.sqrt(step_size)
    return model


_CONTEXT, _LONGEST = 2, 200


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column(0):
            text = text.as_py() or ""
            spans = [(k, s, e) for k, kind in enumerate(KINDS) for s, e in base_spans(text)[kind]] if "@" in text or _DIGIT.search(text) else []
            for start, end in zones(text):
                if end - start <= _LONGEST:
                    low = max(0, start - _CONTEXT)
                    inside = [(k, s - low, e - low) for k, s, e in spans if s >= start and e <= end]
                    # numbers run together, which no base pattern takes, have no known answer
                    cut = any(s < end and start < e and not (s >= start and e <= end) for _, s, e in spans)
                    lost = any(len(_DIGIT.findall(m.group())) > 19 for m in _CARD.finditer(text, start, end))
                    if not cut and not lost:
                        rows.append((text[low : end + _CONTEXT], start - low, end - low, ";".join(f"{k}:{s}:{e}" for k, s, e in inside)))
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["t", "s", "e", "gold"])


def train(docs: DataFrame, text_column: str = "text", sample_docs: int = 20_000, sample_zones: int = 1500) -> Model:
    """Weights from at most ``sample_zones`` different zones of about ``sample_docs`` documents, both chosen by hash."""
    count = docs.count()
    text = F.col(text_column)
    some = docs.select(text.alias("t")).where(F.shiftrightunsigned(F.xxhash64("t"), 33) / F.lit(float(1 << 31)) <= sample_docs / max(count, 1))
    found = some.mapInArrow(_examples, "t string, s long, e long, gold string")
    rows = found.distinct().orderBy(F.xxhash64("t", "s"), "t", "s").limit(sample_zones).collect()
    split = lambda g: [tuple(map(int, x.split(":"))) for x in g.split(";") if x]
    return fit([(r["t"], r["s"], r["e"], split(r["gold"])) for r in rows])


def _joined(spans: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k in KINDS for s, e in sorted(spans[k]))


def detect(text: str, model: Model) -> tuple[dict[str, list[tuple[int, int]]], dict[str, list[tuple[int, int]]]]:
    """Base spans, and base and added spans."""
    base = base_spans(text)
    every = {k: list(v) for k, v in base.items()}
    taken = Taken([x for v in base.values() for x in v])
    for start, end in zones(text):
        zone = Zone(text, start, end, taken)
        for k, s, e in model.best(text, zone) if zone.segments else ():
            every[KINDS[k]].append((s, e))
    return base, every


def _detected(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                text = text.as_py() or ""
                if "@" in text or _DIGIT.search(text):
                    base, every = detect(text, model)
                    rows.append((*[len(base[k]) for k in KINDS], _joined(base), _joined(every)))
                else:
                    rows.append((0, 0, 0, 0, "", ""))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds)]],
                                             names=["id", *[f"n_{k}" for k in KINDS], "base", "spans"])

    return run


def find_personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", model: Model | None = None) -> DataFrame:
    """``id_column, n_email, n_ip, n_card, n_phone`` (base matches), ``base`` and ``spans`` of every whole text.

    Both strings list kind:start:end (code points, end exclusive) by kind, then start. Base matches always stay; the
    model adds spans that do not overlap them. Null and empty texts have none. Rows are independent: repeated rows
    get equal results, null ids stay null, other columns are ignored. Without a model one is trained on ``docs``; where no base pattern
    matches, it adds nothing.
    """
    model = model or train(docs, text_column)
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    schema = f"id {kind}" + "".join(f", n_{k} long" for k in KINDS) + ", base string, spans string"
    return source.mapInArrow(_detected(model), schema).withColumnRenamed("id", id_column)
