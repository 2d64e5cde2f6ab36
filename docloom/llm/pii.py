"""Personal data by patterns and a semi-Markov conditional random field.

The patterns find addresses, numbers and cards that are written the usual way. The field
finds those that are written around the patterns: "name at host dot org", numbers in odd groups,
a telephone number without its plus. It scores whole candidate segments, by the shape of all
of their text at once, and a dynamic program over the bounded segments of a stretch chooses
boundaries and types together.

It is trained here, without labelled personal data: the pattern matches in a bounded sample of
texts are the labels, and each is also shown in written-around forms under the same label.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import columns_of

KINDS = ["email", "ip", "card", "phone"]

# The base patterns of the result's contract, written so that none can run
# long on text it does not match. A look behind keeps a failed digit run from being tried again.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            end = domain.end()
        at = text.find("@", max(at + 1, end))
        # What lies left of a failed sign stays open to the next one only behind that sign.


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the pattern matches, leftmost and non-overlapping for each kind, in code points."""
    found = [(a, b, "email") for a, b in _emails(text)]
    for m in IP.finditer(text):
        if all(len(g.lstrip("0")) <= 3 and int(g.lstrip("0") or "0") <= 255 for g in m.groups()):
            found.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _digits(m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), "card"))
    if "+" in text:
        found += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


# --- the field -------------------------------------------------------------------------------------

#: Tokens of a stretch: runs of letters, runs of digits, blanks, single signs.
TOKEN = re.compile(r"[^\W\d_]+|\d+|\s+|[^\w\s]|_")
#: Something worth a look: digits in number, four short groups of them with dots between, an at sign, or a spelled-out
#: one with a host behind it, whose dot may be plain or spelled.
ANCHOR = re.compile(
    r"(?:\d[\s().\-/\[\]]{0,3}){7}|\d{1,3}(?:\s?[(\[]?\s?\.\s?[)\]]?\s?\d{1,3}){3}|@|[(\[]\s?at\s?[)\]]"
    r"|\bat\s+[\w-]{1,63}(?:\.\w|\s*[(\[]\s?dot\s?[)\]]|\s+dot\b)", re.IGNORECASE)
LONGEST = 40  # tokens of a segment: a name of 8, and a host of 5 parts with bracketed dots and blanks around them
LONGEST_NUMBER = 17  # tokens of a segment without an at: 19 digits in 5 groups with blank, sign, blank between
LONGEST_TEXT = 100  # characters of a segment
MARGIN = 60  # characters taken along on either side of an anchor
TLD = re.compile(r"(?:com|org|net|edu|gov|io|de|fr|es|uk|info|example)$", re.IGNORECASE)
SPELLED_AT = re.compile(r"\s*[(\[]\s?at\s?[)\]]\s*|\s+at\s+|\s?@\s?", re.IGNORECASE)
SPELLED_DOT = re.compile(r"\s*[(\[]\s?dot\s?[)\]]\s*|\s+dot\s+|\s?\.\s?", re.IGNORECASE)


def _shape(token: str) -> str:
    c = token[0]
    if c.isdigit():
        return "9" * min(len(token), 5)
    if c.isalpha():
        low = token.lower()
        return low if low in ("at", "dot") else "a"
    return " " if c.isspace() else c


@lru_cache(maxsize=100_000)
def _features(segment: str, first: str, last: str) -> tuple[str, ...]:
    """Features of a whole segment; ``first`` and ``last`` are the shapes of the tokens around it."""
    tokens = TOKEN.findall(segment)
    digits = _digits(segment)
    letters = sum(c.isalpha() for c in segment)
    out = [f"n{min(len(tokens), LONGEST)}", f"d{min(len(digits), 20)}", f"l{letters > 0}", f"in{first}", f"out{last}",
           f"begin{_shape(tokens[0])}", f"end{_shape(tokens[-1])}"]
    if segment[0].isspace() or segment[-1].isspace():
        out.append("blank")
    if not letters:
        out.append("signs" + "".join(sorted({c for c in segment if not c.isdigit()})))
        groups = re.split(r"\D+", segment)
        out.append("groups" + ",".join(str(min(len(g), 6)) for g in groups if g)[:24])
        if 12 <= len(digits) <= 19:
            out.append(f"luhn{luhn(digits)}")
        parts = [g for g in groups if g]
        if len(parts) == 4:
            out.append(f"octets{all(len(g) <= 3 and int(g) <= 255 for g in parts)}")
        out.append(f"plus{segment[0] == '+'}")
        if 9 <= len(digits) <= 15:
            out.append("phonelike")
    sides = SPELLED_AT.split(segment)
    if len(sides) == 2 and sides[0] and sides[1]:
        host = [p for p in SPELLED_DOT.split(sides[1])]
        plain = all(re.fullmatch(r"[A-Za-z0-9-]+", p) for p in host)
        own = bool(re.fullmatch(r"[A-Za-z0-9._%+-]+", sides[0]))
        out.append(f"mail{own}{plain}{len(host) > 1}{bool(TLD.search(sides[1]))}")
    return tuple(out)


@dataclass
class Field:
    """Weights of (kind, feature) pairs, and of a token outside any segment."""

    weights: dict[tuple[str, str], float]
    outside: float

    def score(self, kind: str, features: tuple[str, ...]) -> float:
        get = self.weights.get
        return sum(get((kind, f), 0.0) for f in features)


def _may_hold(segment: str) -> bool:
    """Whether a segment can be personal data at all: no blanks at its ends, and digits in number or an at sign."""
    if segment[0].isspace() or segment[-1].isspace() or "\n" in segment:
        return False
    return len(_digits(segment)) >= 4 or "@" in segment or " at " in segment.lower() or "at)" in segment.lower() or "at]" in segment.lower()


def _segments(stretch: str) -> tuple[list[tuple[int, int]], list[tuple[int, int, tuple[str, ...]]]]:
    """Places of the tokens, and the candidate segments (first token, token behind the last, features)."""
    places = [(m.start(), m.end()) for m in TOKEN.finditer(stretch)]
    shapes = ["^", *[_shape(stretch[a:b]) for a, b in places], "$"]
    # A blank behind a segment tells little; a spelled dot behind the blank says that the host goes on.
    behind = [s + t if s == " " and t in ("dot", "(", "[") else s for s, t in zip(shapes, [*shapes[1:], ""])]
    out, ats = [], [0]
    for a, b in places:
        ats.append(ats[-1] + (stretch[a:b].lower() in ("@", "at")))
    for i in range(len(places)):
        for j in range(i + 1, min(i + LONGEST, len(places)) + 1):
            if j - i > LONGEST_NUMBER and ats[i] == ats[j]:
                continue
            segment = stretch[places[i][0]:places[j - 1][1]]
            if len(segment) > LONGEST_TEXT:
                break
            if _may_hold(segment):
                out.append((i, j, _features(segment, shapes[i], behind[j + 1])))
    return places, out


def _stretches(text: str) -> list[tuple[int, int]]:
    """The parts of a text around its anchors, joined where they touch."""
    out: list[tuple[int, int]] = []
    for m in ANCHOR.finditer(text):
        a, b = max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)
        while a > 0 and m.start() - a < 2 * MARGIN and text[a - 1].isalnum():
            a -= 1
        while b < len(text) and b - m.end() < 2 * MARGIN and text[b].isalnum():
            b += 1
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def decode(field: Field, stretch: str) -> list[tuple[int, int, str]]:
    """Best segmentation of a stretch: (start, end, kind) of its entity segments."""
    places, segments = _segments(stretch)
    ending: dict[int, list] = {}
    for i, j, features in segments:
        kind = max(KINDS, key=lambda k: field.score(k, features))
        ending.setdefault(j, []).append((i, kind, field.score(kind, features)))
    best, back = [0.0], [None]
    for j in range(1, len(places) + 1):
        top, how = best[j - 1] + field.outside, (j - 1, None)
        for i, kind, value in ending.get(j, ()):
            if best[i] + value > top:
                top, how = best[i] + value, (i, kind)
        best.append(top), back.append(how)
    out, j = [], len(places)
    while j:
        i, kind = back[j]
        if kind:
            out.append((places[i][0], places[j - 1][1], kind))
        j = i
    return out[::-1]


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + float(np.log(sum(np.exp(v - top) for v in values)))


def _gradient(field: Field, n: int, segments: list, gold: dict[tuple[int, int], str]) -> dict[tuple[str, str], float]:
    """Observed minus expected features of one stretch, by the forward and backward sums over segmentations."""
    scored = [(i, j, k, f, field.score(k, f)) for i, j, f in segments for k in KINDS]
    ends, starts = {}, {}
    for s in scored:
        ends.setdefault(s[1], []).append(s)
        starts.setdefault(s[0], []).append(s)
    ahead = [0.0]
    for j in range(1, n + 1):
        ahead.append(_log_sum([ahead[j - 1] + field.outside] + [ahead[s[0]] + s[4] for s in ends.get(j, ())]))
    behind = [0.0] * (n + 1)
    for i in range(n - 1, -1, -1):
        behind[i] = _log_sum([behind[i + 1] + field.outside] + [behind[s[1]] + s[4] for s in starts.get(i, ())])
    out: dict[tuple[str, str], float] = {}
    for i, j, k, features, value in scored:
        p = float(np.exp(ahead[i] + value + behind[j] - ahead[n]))
        push = (1.0 if gold.get((i, j)) == k else 0.0) - p
        if abs(push) > 1e-4:
            for f in features:
                out[k, f] = out.get((k, f), 0.0) + push
    return out


def _written_around(kind: str, value: str, rng: np.random.Generator) -> str:
    """Another way to write a match."""
    def pick(options: list[str]) -> str:
        return options[int(rng.integers(len(options)))]

    if kind == "email":
        name, host = value.split("@")
        return name + pick([" at ", " (at) ", "[at]", " @ ", "(at)"]) + host.replace(".", pick([" dot ", ".", " (dot) ", "[dot]", "."]))
    if kind == "ip":
        return value.replace(".", pick(["[.]", " . ", "(.)"]))
    digits = _digits(value)
    if kind == "card":
        sign = pick([".", "/", "  ", " - "])
        return sign.join(digits[i:i + 4] for i in range(0, len(digits), 4))
    tail = digits[1:] if len(digits) == 11 else digits
    return pick([f"({tail[:3]}) {tail[3:6]}-{tail[6:]}", f"{tail[:3]}-{tail[3:6]}-{tail[6:]}", f"{tail[:3]}.{tail[3:6]}.{tail[6:]}",
                 f"00{digits[:1]} {tail[:3]} {tail[3:6]} {tail[6:]}"])


#: Numbers that are no personal data, so that the field sees some whatever the sample holds.
PLAIN = ["2024-03-15 10:45:02", "1,234,567.89", "version 10.2.33", "15/03/2024 12:30", "0.123456789", "1999-2004 (pp. 1031-1047)",
         "10 000 000 000", "page 12345678", "3.14159265", "2 400 512 units", "No. 20240315", "1-2-3-4-5-6-7-8", "at noon a dot", "ratio 1.2.3.4.5.6.7",
         "order 8812345678", "id 123456789012", "look at this dot there", "met at noon. Then we left at 5.30 with", "stay at home and write", "at least one. At last two",
         "arrived at 10.30 and left", "sections 1.2.3 and 4.5", "born 12.04.1987 in", "100 200 300 400 500"]


def train(texts: list[str | None], rounds: int = 6, seed: int = 5, stretches: int = 1500) -> Field:
    """Fit the field to the pattern matches of the texts, half of them written around. At most ``stretches`` are used."""
    rng = np.random.default_rng(seed)
    cases: list[tuple[str, int, int, str | None]] = [(f"and {p} then", 0, 0, None) for p in PLAIN * 6]
    # Numbers of a card's or a host's form that fail its check are none, however they are written.
    for _ in range(60):
        digits = "".join(map(str, rng.integers(0, 10, int(rng.integers(12, 20)))))
        if not luhn(digits):
            sign = ["", "", " ", "-", ".", "/"][int(rng.integers(6))]
            cases.append((f"number {sign.join(digits[i:i + 4] for i in range(0, len(digits), 4))} here", 0, 0, None))
        parts = [str(int(x)) for x in rng.integers(256, 999, 4)]
        cases.append((f"figure {['.', '[.]', ' . '][int(rng.integers(3))].join(parts)} here", 0, 0, None))
    made = [(k, v) for k, v in (("email", "joe@example.com"), ("email", "kim_lee@web.example.net"), ("card", "340000000000009"), ("card", "6011000990139424"),
                                ("email", "jo.ann7@mail.example.org"), ("ip", "192.0.2.44"), ("card", "4111111111111111"), ("phone", "+1 (212) 555-0134"),
                                ("phone", "+1 (415) 555-0199"), ("email", "info@example.com"), ("ip", "198.51.100.7"), ("card", "5500005555555559"),
                                ("ip", "10.0.0.5"), ("ip", "172.16.0.1"), ("email", "lee.park8@web.mail.example.net"), ("email", "jo@my-host.org"))]
    for kind, value in made * 30:
        shown = value if rng.random() < 0.4 else _written_around(kind, value, rng)
        cases.append((f"call or write {shown} and then", 14, 14 + len(shown), kind))
    for text in texts:
        if len(cases) >= stretches:
            break
        spans = base_spans(text or "")
        for start, end, kind in spans:
            if any(s != (start, end, kind) and s[0] < end and start < s[1] for s in spans) or end - start > 60:
                continue
            left, right = (text or "")[max(0, start - 30):start], (text or "")[end:end + 30]
            if ANCHOR.search(left) or ANCHOR.search(right):
                continue
            shown = text[start:end] if rng.random() < 0.5 else _written_around(kind, text[start:end], rng)
            cases.append((left + shown + right, len(left), len(left) + len(shown), kind))
    field = Field({}, 0.0)
    ready = []
    for stretch, a, b, kind in cases:
        places, segments = _segments(stretch)
        known = {p: t for t, p in enumerate(x for x, _ in places)}
        last = {p: t + 1 for t, p in enumerate(y for _, y in places)}
        if kind is None or (a in known and b in last):
            ready.append((len(places), segments, {(known[a], last[b]): kind} if kind else {}))
    squares: dict[tuple[str, str], float] = {}
    for _ in range(rounds):
        for at in rng.permutation(len(ready)):
            for key, push in _gradient(field, *ready[at]).items():
                squares[key] = squares.get(key, 1e-2) + push * push
                field.weights[key] = (field.weights.get(key, 0.0) + 0.3 * push / squares[key] ** 0.5) * 0.9999
    return field


def added_spans(field: Field, text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """What the field finds beside the base spans; a segment that touches one is that span again and left to it."""
    out = []
    for a, b in _stretches(text):
        for start, end, kind in decode(field, text[a:b]):
            start, end = start + a, end + a
            if not any(s < end and start < e for s, e, _ in base):
                out.append((start, end, kind))
    return out


def fit_field(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", sample: int = 2000, longest: int = 5000) -> Field:
    """Train on at most ``sample`` texts with digits in number, of up to ``longest`` characters, drawn by a hash of the id."""
    rows = columns_of(docs, doc_id=id_col, text=text_col).where(F.length("text") <= longest).where(F.col("text").rlike(r"@|[0-9]{4}|\+[0-9]"))
    # Ids are drawn first, so that no task sends texts which the limit then drops.
    drawn = rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = rows.join(F.broadcast(drawn), "doc_id").select("text").distinct().collect()
    return train(sorted(r["text"] for r in texts)[:sample])


def find(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans in every whole text: doc_id, text, base (pattern spans), found (all spans), each (start, place, end, kind).

    Base spans come from the patterns, further ones from the field. Positions are code points. A null or
    empty text has no spans. Null and repeated ids keep their rows; ties in start go by kind as listed, then by end. An
    empty table gives an empty result. Other columns are ignored.
    """
    rows = columns_of(docs, doc_id=id_col, text=text_col)
    span = "array<struct<start:int,place:int,end:int,kind:string>>"

    def listed(spans: list[tuple[int, int, str]]) -> list[dict]:
        return [{"start": a, "place": KINDS.index(k), "end": b, "kind": k} for a, b, k in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))]

    @F.pandas_udf(f"struct<base:{span},found:{span}>")
    def spans(text: pd.Series) -> pd.DataFrame:
        base = [base_spans(t or "") for t in text]
        return pd.DataFrame({"base": [listed(b) for b in base], "found": [listed(b + added_spans(field, t or "", b)) for t, b in zip(text, base)]})

    return rows.withColumn("s", spans("text")).select("doc_id", "text", "s.base", "s.found")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of ``find``: counts per base kind, a hash of the base spans, all spans as text."""
    from docloom.llm.common import spans_text

    def count(kind: str) -> F.Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
                        spans_text(F.col("found")).alias("spans"))
