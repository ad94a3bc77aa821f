"""URL filters: pattern rules indexed by their rarest literal token.

A URL's tokens fetch the rules filed under them, and only those rules run their regular expression; rules without
a safe token run on every URL. A literal of a pattern is a safe token if it is a whole token of every URL that the
pattern fits, which holds where both neighbours are fixed and are no token characters. How rare a token is comes
from the whole table: one aggregate over the tokens that occur in rules.

Pattern syntax: ``*`` any characters, ``^`` a separator or the end, ``|`` at either end an anchor, ``||`` at the
start a host name or one of its parent domains, ``@@`` in front an exception. Matching ignores case (A-Z). A URL is
blocked if a rule fits it and no exception does.

Domain rules go first: the longest rule (host and path prefix) that fits decides, and patterns decide the rest.
Defined results: a NULL URL, or one without ``://``, has empty host and path; patterns allow a NULL URL. Repeated
rows are judged alike; columns of the input named like a result are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.llm.arrow import map_columns, quoted

MAX_PATTERNS = 100_000  # the index travels with the tasks
TOKEN = "[a-z0-9]+"
SEPARATOR = r"(?:[^a-z0-9_.%-]|\Z)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class DomainRule:
    verdict: str  # block or allow
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Pattern:
    text: str
    allows: bool
    regex: str
    tokens: tuple[str, ...]


def parse(text: str) -> Pattern:
    """A pattern's regular expression (on lower-cased URLs) and its safe tokens."""
    body = text.lower()
    allows = body.startswith("@@")
    body = body[2 * allows :]
    head = "||" if body.startswith("||") else "|" if body.startswith("|") else ""
    body = body[len(head) :]
    tail = body.endswith("|")
    body = body[: len(body) - tail]
    start = {"||": r"\A[^/?#]*?://(?:[^/?#]*\.)?", "|": r"\A", "": ""}[head]
    middle = "".join({"*": ".*", "^": SEPARATOR}.get(c, re.escape(c)) for c in body)
    tokens = []
    for m in re.finditer(TOKEN, body):
        left = head != "" if m.start() == 0 else body[m.start() - 1] != "*"
        right = tail if m.end() == len(body) else body[m.end()] != "*"
        if left and right:
            tokens.append(m[0])
    return Pattern(text, allows, start + middle + (r"\Z" if tail else ""), tuple(dict.fromkeys(tokens)))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def token_counts(urls: DataFrame, tokens: list[str], url: str = "url") -> dict[str, int]:
    """In how many URLs each of the given tokens occurs; at most one number per token reaches the driver."""
    if not tokens:
        return {}
    own = F.regexp_extract_all(lower_ascii(F.col(quoted(url))), F.lit(TOKEN), F.lit(0))
    known = F.array(*[F.lit(t) for t in tokens])
    counts = urls.select(F.explode(F.array_intersect(own, known)).alias("t")).groupBy("t").count().collect()
    return {r["t"]: r["count"] for r in counts}


def filed(patterns: list[Pattern], counts: dict[str, int]) -> tuple[dict[str, list[Pattern]], list[Pattern]]:
    """Patterns by their rarest token, and those without a token."""
    index: dict[str, list[Pattern]] = {}
    rest = []
    for p in patterns:
        if p.tokens:
            index.setdefault(min(p.tokens, key=lambda t: (counts.get(t, 0), -len(t), t)), []).append(p)
        else:
            rest.append(p)
    return index, rest


def add_host_and_path(urls: DataFrame, url: str = "url") -> DataFrame:
    parts = "://([^/?#]*)([^?#]*)"
    whole = F.coalesce(F.col(quoted(url)), F.lit(""))
    return urls.withColumns({
        "host": lower_ascii(F.regexp_extract(whole, parts, 1)), "path": F.regexp_extract(whole, parts, 2)
    })


def domain_rule(rules: list[DomainRule], value: Callable[[DomainRule], str]) -> Column:
    """``value`` of the longest rule that fits ``host`` and ``path``; NULL if none does."""
    found = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        host = (F.col("host") == r.host) | F.col("host").endswith(f".{r.host}")
        found = F.when(host & F.col("path").startswith(r.path), F.lit(value(r))).otherwise(found)
    return found


def judge_urls(urls: DataFrame, rules: list[DomainRule], patterns: list[str], url: str = "url") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (the domain rule), ``pattern`` (the deciding pattern) and ``verdict``."""
    if len(patterns) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} patterns")
    parsed = [parse(p) for p in patterns]
    counts = token_counts(urls, sorted({t for p in parsed for t in p.tokens}), url)
    index, rest = filed(parsed, counts)
    keep = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict")]

    def start() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        compiled: dict[str, re.Pattern] = {}
        lowered, token = str.maketrans(UPPER, LOWER), re.compile(TOKEN)

        def fits(p: Pattern, text: str) -> bool:
            if p.regex not in compiled:
                compiled[p.regex] = re.compile(p.regex, re.DOTALL)
            return compiled[p.regex].search(text) is not None

        def deciding(text: str | None) -> Pattern | None:
            if text is None:
                return None
            text = text.translate(lowered)
            candidates = [p for t in sorted(set(token.findall(text))) for p in index.get(t, ())] + rest
            found = [p for p in candidates if fits(p, text)]
            return min(found, key=lambda p: (not p.allows, p.text), default=None)

        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            found = [deciding(u) for u in batch.column(url).to_pylist()]
            blocks = pa.array(["block" if p and not p.allows else "allow" for p in found], pa.string())
            return [pa.array([p and p.text for p in found], pa.string()), blocks]

        return compute

    matched = map_columns(urls, keep, "pattern string, verdict string", start, needs=[url])
    return add_host_and_path(matched, url).withColumns({
        "rule": domain_rule(rules, lambda r: r.name),
        "verdict": F.coalesce(domain_rule(rules, lambda r: r.verdict), F.col("verdict")),
    })
