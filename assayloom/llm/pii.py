"""Personal data: exact patterns, and a semi-Markov conditional random field for the rest."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayloom.llm.text import bounded_batches, clear_of, slices, texts_of, tidied

KINDS = ("email", "ip", "card", "phone")

# Fixed patterns. A digit before the match is excluded for ip: a run of digits
# matches from its first digit or not at all, so nothing changes but the time.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int, int]  # start, kind, end


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-3:] if p.lstrip("0") else 0) <= 255 for p in text.split("."))


def base_spans(text: str) -> list[Span]:
    """Spans of the exact patterns, leftmost and non-overlapping per kind, in linear time."""
    found: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            found.append((start, 0, end))
        at = text.find("@", max(at + 1, end if m else 0))
    for m in _IP.finditer(text):
        if _octets(m[0]):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        d = _digits(m[0]) if m.end() - m.start() <= 40 else ""
        if 14 <= len(d) <= 19 and luhn(d):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


# ---- the field: atoms, candidate segments, features ----

#: Longest entity in atoms and characters.
_MAX_ATOMS, _MAX_CHARS = 24, 80
_ATOM = re.compile(r"[0-9]+|[^\W\d_]+|\s|[^\w\s]|_")
#: What a segment of each kind may look like at its loosest.
_AT, _DOT = r"(?: ?@ ?| ?[(\[] ?at ?[)\]] ?| at )", r"(?:\.| ?[(\[] ?dot ?[)\]] ?| dot )"
_LOOSE = (
    re.compile(rf"[A-Za-z0-9_%+-]+(?:\.[A-Za-z0-9_%+-]+)*{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+", re.I),
    re.compile(r"[0-9]{1,3}(?:(?: ?\. ?| ?[(\[] ?(?:\.|dot) ?[)\]] ?)[0-9]{1,3}){3}", re.I),
    re.compile(r"[0-9](?:[ .\-/]{0,2}[0-9]){13,18}"),
    re.compile(r"(?:\+|00)?[ ]?\(?[0-9](?:[ ()./-]{0,3}[0-9]){9,14}"),
)
#: Part of whatever a loose pattern matches: many digits (card, phone), an address of four groups, any form of "at".
_ANCHOR = re.compile(rf"[0-9](?:[^0-9\n]{{0,3}}[0-9]){{6,80}}|{_LOOSE[1].pattern}|@|[(\[] ?at ?[)\]]"
                     rf"| at [A-Za-z0-9-]+{_DOT}[A-Za-z0-9-]", re.I)
_CUES = (("mail", "email", "contact"), ("ip", "host", "server", "address"), ("card", "visa", "credit", "account"),
         ("tel", "phone", "call", "fax", "mobile"))


def _features(kind: int, text: str, start: int, end: int) -> list[str]:
    """Names of the features of one whole candidate span."""
    span = text[start:end]
    digits = _digits(span)
    k = KINDS[kind]
    before, after = text[start - 1:start], text[end:end + 1]
    out = [k, f"{k} digits {len(digits)}" if kind > 1 else f"{k} form {'@' in span} {' ' in span}",
           f"{k} borders {before.isalnum()} {after.isalnum()} {before in '.-+@' and before != ''}"
           f" {after != '' and after in '-@'}",
           f"{k} separators {''.join(sorted({c for c in span if not c.isalnum()}))[:6]}"]
    if kind == 2:
        out.append(f"card luhn {luhn(digits)}")
    if kind == 1:
        out.append(f"ip octets {all(int(p) <= 255 for p in re.findall('[0-9]+', span))}")
    if kind == 3:
        groups = [len(g) for g in re.findall("[0-9]+", span)]
        out += [f"phone lead {span[:1] if span[:1] in '+(0' else 'digit'}", f"phone groups {groups[-3:]}",
                f"phone luhn {len(digits) > 13 and luhn(digits)}"]
    near = text[max(0, start - 24):start].lower()
    out += [f"{k} cue" for w in _CUES[kind] if w in near][:1]
    return out


@dataclass
class Zone:
    """Atom borders within a text, and candidate segments (first atom, atom after, kind, features)."""

    borders: list[int]
    segments: list[tuple[int, int, int, list[str]]]


def zones(text: str, reach: int = _MAX_CHARS) -> list[Zone]:
    """Stretches of the text around digits and forms of "at", with every loose candidate in them."""
    areas: list[list[int]] = []
    for m in _ANCHOR.finditer(text):
        a, b = max(0, m.start() - reach), min(len(text), m.end() + reach)
        if areas and a <= areas[-1][1]:
            areas[-1][1] = b
        else:
            areas.append([a, b])
    out = []
    for a, b in areas:
        borders = [m.start() for m in _ATOM.finditer(text, a, b)]
        if not borders:
            continue
        borders.append(b)
        segments = []
        for i, start in enumerate(borders[:-1]):
            first = text[start]
            if not (first.isalnum() or first in "+(_%"):
                continue
            numeric = first in "+(0123456789"
            for kind in ((0, 1, 2, 3) if numeric else (0,)):
                # The loosest pattern from this start bounds the ends to be tried.
                m = _LOOSE[kind].match(text, start, min(b, start + _MAX_CHARS))
                if not m:
                    continue
                for j in range(i + 1, min(i + _MAX_ATOMS, len(borders) - 1) + 1):
                    end = borders[j]
                    if end > m.end():
                        break
                    if text[end - 1].isalnum() and (end == m.end() or _LOOSE[kind].fullmatch(text, start, end)):
                        segments.append((i, j, kind, _features(kind, text, start, end)))
        if segments:
            out.append(Zone(borders, segments))
    return out


def _scores(zone: Zone, weights: dict[str, float]) -> list[float]:
    return [sum(weights.get(f, 0.0) for f in s[3]) for s in zone.segments]


class Stretches:
    """What spans cover together, as separate stretches in order; a look-up is one binary search."""

    def __init__(self, spans: list[Span] = ()):
        self.starts, self.ends = [], []
        for start, _, end in sorted(spans):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def meet(self, start: int, end: int) -> bool:
        """Whether a stretch shares a character with start to end."""
        at = bisect_right(self.ends, start)
        return at < len(self.starts) and self.starts[at] < end


def best_segments(zone: Zone, weights: dict[str, float], banned: Stretches = Stretches()) -> list[Span]:
    """The non-overlapping segments of the highest total score, away from ``banned`` stretches.

    Dynamic programming over atom borders: an atom outside every segment scores 0.
    """
    n = len(zone.borders)
    ending = defaultdict(list)
    for (i, j, kind, _), s in zip(zone.segments, _scores(zone, weights)):
        if s > 0 and not banned.meet(zone.borders[i], zone.borders[j]):
            ending[j].append((i, kind, s))
    best, back = [0.0] * n, [None] * n
    for j in range(1, n):
        best[j] = best[j - 1]
        for i, kind, s in ending[j]:
            if best[i] + s > best[j]:
                best[j], back[j] = best[i] + s, (i, kind)
    out, j = [], n - 1
    while j > 0:
        if back[j]:
            i, kind = back[j]
            out.append((zone.borders[i], kind, zone.borders[j]))
            j = i
        else:
            j -= 1
    return out[::-1]


def _posterior(zone: Zone, weights: dict[str, float]) -> list[float]:
    """Probability of each segment: forward and backward sums over all segmentations."""
    n, scores = len(zone.borders), _scores(zone, weights)
    ahead, behind = [0.0] * n, [0.0] * n
    ending, starting = defaultdict(list), defaultdict(list)
    for (i, j, _, _), s in zip(zone.segments, scores):
        ending[j].append((i, s))
        starting[i].append((j, s))

    def total(values):
        top = max(values)
        return top + math.log(sum(math.exp(v - top) for v in values))

    for j in range(1, n):
        ahead[j] = total([ahead[j - 1]] + [ahead[i] + s for i, s in ending[j]])
    for i in range(n - 2, -1, -1):
        behind[i] = total([behind[i + 1]] + [behind[j] + s for j, s in starting[i]])
    return [math.exp(min(0.0, ahead[i] + s + behind[j] - ahead[-1])) for (i, j, _, _), s in zip(zone.segments, scores)]


def fit_field(examples: list[tuple[Zone, set[Span]]], epochs: int = 6, rate: float = 0.3, decay: float = 1e-3) -> dict[str, float]:
    """Weights of the highest likelihood of the labelled segments, by gradient steps in the given order."""
    weights: dict[str, float] = defaultdict(float)
    for epoch in range(epochs):
        step = rate / (1 + epoch)
        for zone, gold in examples:
            for (i, j, kind, features), p in zip(zone.segments, _posterior(zone, weights)):
                push = ((zone.borders[i], kind, zone.borders[j]) in gold) - p
                if abs(push) > 1e-4:
                    for f in features:
                        weights[f] += step * (push - decay * weights[f])
    return dict(weights)


def _rewritten(kind: int, span: str, form: int) -> str:
    """Another way to write an entity of a kind."""
    if kind == 0:
        local, _, domain = span.partition("@")
        return (f"{local} at {domain.replace('.', ' dot ')}", f"{local}(at){domain}", f"{local} @ {domain}",
                f"{local}[at]{domain.replace('.', '[dot]')}")[form % 4]
    if kind == 1:
        return span.replace(".", ("[.]", " . ", "(.)", "[dot]")[form % 4])
    d = _digits(span)
    if kind == 2:
        return (".", "/", " ", "-")[form % 4].join(d[k:k + 4] for k in range(0, len(d), 4))
    n, lead = d[-10:], d[:-10] or "1"
    return (f"({n[:3]}) {n[3:6]}-{n[6:]}", f"{n[:3]}-{n[3:6]}-{n[6:]}", f"00{lead} {n[:3]} {n[3:6]} {n[6:]}",
            f"{n[:3]}.{n[3:6]}.{n[6:]}")[form % 4]


def labelled_zones(text: str, most: int = 8) -> list[tuple[Zone, set[Span]]]:
    """Training examples of one text: its exact spans, as they stand and rewritten, and what lies around them."""
    spans = base_spans(text)
    out = [(z, set(spans)) for z in zones(text)[:most]]
    for k, (start, kind, end) in enumerate(spans[:most]):
        other = _rewritten(kind, text[start:end], k + start)
        a, b = max(0, start - 60), min(len(text), end + 60)
        changed = text[a:start] + other + text[end:b]
        gold = {(start - a, kind, start - a + len(other))}
        out += [(z, gold | set(base_spans(changed))) for z in zones(changed)]
    return out


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = 2000, per_text: int = 8,
          per_sample: int = 4) -> dict[str, float]:
    """Fit the field on the exact spans of a sample of ``sample`` documents, those of the smallest id hash.

    A document gives the examples of its first ``per_text`` windows and of its first
    ``per_text`` exact spans rewritten; at most ``per_sample`` x ``sample`` examples are
    taken, in the order of id hash. These bounds hold for the fit alone: spans are searched
    in every whole document. A kind that the sample does not hold has no example, and
    the field then adds none of it.
    """
    place = F.xxhash64(F.col(f"`{doc_id}`"))
    last = docs.select(place.alias("place")).orderBy("place").limit(sample).agg(F.max("place")).first()[0]
    if last is None:
        return {}

    def examples(batches):
        import pickle

        for batch in batches:
            for part in slices(batch, "text"):
                found = [(p, e) for p, t in zip(part["place"].to_pylist(), texts_of(part, "text").to_pylist())
                         for e in labelled_zones(t, per_text)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for p, _ in found], pa.int64()),
                     pa.array([pickle.dumps(e) for _, e in found], pa.binary())], ["place", "example"])

    import pickle

    rows = (docs.select(place.alias("place"), F.col(f"`{text}`").alias("text")).where(F.col("place") <= last)
            .mapInArrow(tidied(examples), "place long, example binary").orderBy("place", "example").limit(per_sample * sample).collect())
    return fit_field([pickle.loads(r["example"]) for r in rows])


def all_spans(text: str, weights: dict[str, float]) -> tuple[list[Span], list[Span]]:
    """(exact spans, exact and added spans)."""
    exact = base_spans(text)
    taken = Stretches(exact)
    added = [s for z in zones(text) for s in best_segments(z, weights, taken)] if weights else []
    return exact, sorted({*exact, *added})


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find_spans(docs: DataFrame, weights: dict[str, float], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added of every row.

    Offsets are code points, ends exclusive; spans are ordered by start, then kind.
    The counts and the digest are those of the exact patterns; ``spans`` holds
    those and what the field adds. A null or empty text has none. Whole texts, one
    pass, no shuffle; ``weights`` is a few hundred numbers.
    """
    def find(batches):
        for batch in batches:
            for part in slices(batch, text):
                rows = [all_spans(t, weights) for t in texts_of(part, text).to_pylist()]
                counts = [[sum(s[1] == k for s in exact) for exact, _ in rows] for k in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [part[doc_id], *[pa.array(c, pa.int64()) for c in counts],
                     pa.array([hashlib.sha256(_joined(e).encode()).hexdigest() for e, _ in rows], pa.string()),
                     pa.array([_joined(a) for _, a in rows], pa.string()),
                     pa.array([len(a) - len(e) for e, a in rows], pa.int64())],
                    ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"])

    source = clear_of(docs, doc_id, text)
    kind = source.schema[doc_id].dataType.simpleString()
    return source.mapInArrow(tidied(find), f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, "
                             "base_sha256 string, spans string, n_added long")


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each stretch of overlapping spans replaced by its first kind's name in brackets."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, weights: dict[str, float], text: str = "text") -> DataFrame:
    """All columns of ``docs``, with personal data in ``text`` replaced; a null text stays null, an empty one empty."""
    # Places stand for names on the way: a name may hold a dot.
    names, place = docs.columns, docs.columns.index(text)

    def change(batches):
        for batch in batches:
            for part in slices(batch, f"c{place}"):
                new = [None if t is None else redacted(t, all_spans(t, weights)[1]) for t in part.column(place).to_pylist()]
                yield part.set_column(place, part.schema.field(place), pa.array(new, part.schema.field(place).type))

    bounded_batches(docs.sparkSession)
    plain = docs.toDF(*[f"c{k}" for k in range(len(names))])
    return plain.mapInArrow(tidied(change), plain.schema).toDF(*names)
