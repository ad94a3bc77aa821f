"""Personal data by a semi-Markov conditional random field.

The field scores whole candidate spans: every stretch of up to ``MAX_TOKENS`` tokens around digits or ``@`` gets
features of the span as a whole (lengths, digit count, separators, checksum, character kinds, neighbours), and
dynamic programming over segments picks the best boundaries and types together. Its weights are learned by gradient
ascent on the conditional likelihood of windows whose spans come from exact patterns: the four base kinds, and
recognizable secrets. Learning uses at most ``TRAINING_WINDOWS`` windows, those with the smallest hashes in the
corpus; every document is searched whole.

Base spans (leftmost non-overlapping per kind, checked afterwards) always stay; the field adds spans that overlap
none of them. Defined results: a NULL text is an empty text, without spans. Repeated rows have equal results;
columns of the input named like a result are replaced; without any window in the corpus nothing is added.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.arrow import map_columns, quoted, texts

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
TRAINING_WINDOWS = 1000
MARGIN = 24  # characters on both sides of a trigger
MAX_TOKENS = 14  # of a span
MAX_WINDOW = 400  # characters of a training window
EPOCHS, STEP, PENALTY = 40, 0.5, 0.002

LOCAL = "A-Za-z0-9._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL_BEFORE = re.compile(rf"[{LOCAL}]")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SECRET = re.compile(r"\bAKIA[0-9A-Z]{16}\b|\bpassword=[0-9a-f]{16,}\b|\b[0-9a-f]{40}\b")
TRIGGER = re.compile(r"[0-9@]+")
TOKEN = re.compile(r"[A-Za-z0-9]+|[^A-Za-z0-9]", re.DOTALL)

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join([c for c in s if "0" <= c <= "9"])


def emails(text: str) -> Iterator[Span]:
    """Found from each ``@``: its name runs left at most to the last match, so long runs cost linear time."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and LOCAL_BEFORE.match(text, start - 1):
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end(), "email"
            free = m.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[Span]:
    """Spans of the four base kinds, by start, then kind as listed."""
    found = list(emails(text))
    found += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = digits_of(m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), "card"))
    found += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return ordered(found)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def windows(text: str) -> Iterator[tuple[int, int]]:
    """Stretches around digits and ``@`` that may hold spans, disjoint, in order."""
    start = end = -1
    for m in TRIGGER.finditer(text):
        a, b = max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)
        if a <= end:
            end = b
            continue
        if end >= 0:
            yield start, end
        start, end = a, b
    if end >= 0:
        yield start, end


@functools.lru_cache(maxsize=50_000)
def span_features(s: str, left: str, right: str) -> tuple[int, ...]:
    """Numbers of the features that hold for a whole span and its neighbouring characters."""
    digits = digits_of(s)
    n, letters = len(digits), sum(c.isalpha() for c in s)
    parts = s.split(".")
    facts = (
        True,
        len(s) <= 6, 6 < len(s) <= 11, 11 < len(s) <= 15, 15 < len(s) <= 19, 19 < len(s) <= 28, len(s) > 28,
        n == 0, 0 < n <= 3, 3 < n <= 8, 8 < n <= 11, 11 < n <= 15, 15 < n <= 19, n > 19,
        letters == 0, letters > 0 and n > 0, letters > 4,
        s[0] == "+", s[0] == "(", s.count("@") == 1, s.count("@") > 1, "@" in s[:1] or "@" in s[-1:],
        "." in s.rpartition("@")[2] and "@" in s[1:-1], " " in s, "-" in s, "(" in s and ")" in s, "=" in s,
        len(parts) == 4 and all(0 < len(p) <= 3 and p == digits_of(p) and int(p) <= 255 for p in parts),
        12 <= n <= 19 and len(s) == n and luhn(digits), 12 <= n <= 19 and len(s) == n and not luhn(digits),
        12 <= n <= 19 and len(s) > n and letters == 0 and luhn(digits), 8 < n <= 15 and letters == 0 and len(s) > n + 1,
        len(s) >= 16 and set(s) <= set("0123456789abcdef") and letters > 0,
        len(s) >= 16 and set(s) <= set("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ") and letters > 0 and n > 0,
        s.startswith("AKIA"), "password" in s or "token" in s or "key" in s,
        not (s[0].isalnum() or s[0] in "+("), not s[-1].isalnum(),
        left == "" or left.isspace(), left.isalnum(), left in {"+", "."}, right == "" or right.isspace(), right.isalnum(),
        right != "" and right in ".,;", left in {'"', "'"} and right in {'"', "'"}, left in {"@", "="} or right in {"@", "="},
        any(c.isspace() and c != " " for c in s), any(c in ",;\"'!?|" for c in s), s != digits and letters == 0 and n < 9,
        letters > 0 and " " in s,
    )
    return tuple(i for i, x in enumerate(facts) if x)


N_FEATURES = 50


class Lattice:
    """Candidate segments of one window: token ends ``j``, lengths ``l``, and the features of each candidate."""

    def __init__(self, text: str, start: int, end: int, taken: list[Span]) -> None:
        tokens = [(start + m.start(), start + m.end()) for m in TOKEN.finditer(text[start:end])]
        self.tokens = tokens
        self.size = len(tokens)
        candidates = []
        for i, (a, _) in enumerate(tokens):
            if text[a].isspace():
                continue
            for n in range(1, min(MAX_TOKENS, self.size - i) + 1):
                b = tokens[i + n - 1][1]
                piece = text[a:b]
                if "\n" in piece or len(piece) > 80:
                    break
                if text[b - 1].isspace() or not TRIGGER.search(piece) or any(a < y and x < b for x, y, _ in taken):
                    continue
                candidates.append((i, n, span_features(piece, text[a - 1] if a else "", text[b] if b < len(text) else "")))
        self.candidates = candidates
        self.facts = np.zeros((len(candidates), N_FEATURES))  # one row per candidate
        for c, (_, _, features) in enumerate(candidates):
            self.facts[c, list(features)] = 1


class Field:
    """Weights ``w[kind, feature]``; a token outside every span scores 0."""

    def __init__(self, w: np.ndarray | None = None) -> None:
        self.w = np.zeros((len(KINDS), N_FEATURES)) if w is None else w

    def scores(self, lattice: Lattice) -> np.ndarray:
        """Score of each candidate for each kind."""
        return lattice.facts @ self.w.T

    def decode(self, lattice: Lattice) -> list[Span]:
        """The best segmentation: linear in the window's tokens, since spans are bounded."""
        scores = self.scores(lattice)
        best = [0.0] * (lattice.size + 1)
        back: list[tuple[int, str] | None] = [None] * (lattice.size + 1)
        ending: dict[int, list[tuple[int, float, str]]] = {}
        for (i, n, _), row in zip(lattice.candidates, scores, strict=True):
            k = int(row.argmax())
            if row[k] > 0:
                ending.setdefault(i + n, []).append((i, float(row[k]), KINDS[k]))
        for j in range(1, lattice.size + 1):
            best[j] = best[j - 1]
            for i, score, kind in ending.get(j, ()):
                if best[i] + score > best[j]:
                    best[j], back[j] = best[i] + score, (i, kind)
        spans, j = [], lattice.size
        while j:
            if back[j] is None:
                j -= 1
                continue
            i, kind = back[j]
            spans.append((lattice.tokens[i][0], lattice.tokens[j - 1][1], kind))
            j = i
        return spans[::-1]

    def gradient(self, lattice: Lattice, gold: list[Span]) -> np.ndarray:
        """Of the log-likelihood of the gold segmentation, by the forward and backward sums over segments."""
        candidates, size = lattice.candidates, lattice.size
        if not candidates:
            return np.zeros_like(self.w)
        weights = np.exp(np.clip(self.scores(lattice), -30, 30))
        sums = weights.sum(axis=1).tolist()
        forward, backward = [1.0] * (size + 1), [1.0] * (size + 1)
        ending: dict[int, list[tuple[int, float]]] = {}
        for (i, n, _), x in zip(candidates, sums, strict=True):
            ending.setdefault(i + n, []).append((i, x))
        for j in range(1, size + 1):
            forward[j] = forward[j - 1] + sum([forward[i] * x for i, x in ending.get(j, ())])
        at = len(candidates) - 1  # candidates are ordered by their first token
        for i in range(size - 1, -1, -1):
            backward[i] = backward[i + 1]
            while at >= 0 and candidates[at][0] == i:
                backward[i] += sums[at] * backward[i + candidates[at][1]]
                at -= 1
        outside = [forward[i] * backward[i + n] / forward[size] for i, n, _ in candidates]
        miss = -weights * np.array(outside)[:, None]
        place = {(a, b): KINDS.index(k) for a, b, k in gold}
        for c, (i, n, _) in enumerate(candidates):
            kind = place.get((lattice.tokens[i][0], lattice.tokens[i + n - 1][1]))
            if kind is not None:
                miss[c, kind] += 1
        return miss.T @ lattice.facts


def gold_spans(text: str) -> list[Span]:
    """Non-overlapping spans to learn from: base spans first, then recognizable secrets."""
    kept: list[Span] = []
    secrets = [(m.start(), m.end(), "secret") for m in SECRET.finditer(text)]
    for a, b, kind in [*sorted(base_spans(text), key=lambda s: (s[0] - s[1], s[0])), *secrets]:
        if all(b <= x or y <= a for x, y, _ in kept):
            kept.append((a, b, kind))
    return sorted(kept)


def train(samples: list[str]) -> Field:
    """A field fitted to windows labelled by exact patterns."""
    field = Field()
    if not samples:
        return field
    cases = [(Lattice(t, 0, len(t), []), gold_spans(t)) for t in samples]
    squares = np.full_like(field.w, 1e-6)
    for _ in range(EPOCHS):
        g = sum(field.gradient(lattice, gold) for lattice, gold in cases) / len(cases) - PENALTY * field.w
        squares += g * g
        field.w += STEP * g / np.sqrt(squares)
    return field


def training_windows(docs: DataFrame, text: str = "text") -> list[str]:
    """The ``TRAINING_WINDOWS`` distinct windows with the smallest hashes; no task sends more than that many."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        smallest: list[tuple[int, str]] = []
        seen: set[str] = set()
        for batch in batches:
            for t in texts(batch, text):
                for a, b in windows(t):
                    w = t[a:b]
                    if b - a > MAX_WINDOW or w in seen:
                        continue
                    h = -int.from_bytes(hashlib.md5(w.encode()).digest()[:7], "big")
                    if len(smallest) < TRAINING_WINDOWS:
                        heapq.heappush(smallest, (h, w))
                    elif h > smallest[0][0]:
                        seen.discard(heapq.heapreplace(smallest, (h, w))[1])
                    else:
                        continue
                    seen.add(w)
        rows = [pa.array([-h for h, _ in smallest], pa.int64()), pa.array([w for _, w in smallest], pa.string())]
        yield pa.RecordBatch.from_arrays(rows, names=["h", "w"])

    found = docs.select(F.col(quoted(text)).alias(text)).mapInArrow(sample, "h long, w string")
    return [r.w for r in found.distinct().orderBy("h", "w").limit(TRAINING_WINDOWS).collect()]


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def find_spans(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans with those that the field adds."""
    base = base_spans(text)
    added = []
    for a, b in windows(text):
        lattice = Lattice(text, a, b, [s for s in base if s[0] < b and a < s[1]])
        added += field.decode(lattice)
    return base, ordered([*base, *added])


def find_personal_data(docs: DataFrame, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """Add counts per base kind, ``base_spans`` and ``spans`` (``kind:start:end``, code points, end exclusive)."""
    weights = train(training_windows(docs, text)).w

    def start() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        field = Field(weights)

        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            found = [find_spans(t, field) for t in texts(batch, text)]
            counts = [pa.array([sum(s[2] == kind for s in base) for base, _ in found], pa.int64()) for kind in BASE_KINDS]
            return counts + [pa.array([written(f[i]) for f in found], pa.string()) for i in (0, 1)]

        return compute

    fields = ", ".join(f"n_{kind} long" for kind in BASE_KINDS) + ", base_spans string, spans string"
    return map_columns(docs, docs.columns if keep is None else keep, fields, start, needs=[text])
