"""Personal data spans and URL rules against plain regular expressions."""

import random
import re

import duckdb
import pytest

from clientele.llm.catalog import DOMAIN_RULES, ORACLES, QUERIES, URL_PATTERNS
from clientele.llm.pii_crf import KINDS, base_spans, digits_of, find_personal_data, gold_spans, luhn, train, written
from clientele.llm.pii_crf import Field, Lattice, find_spans
from clientele.llm.url_rules import judge_urls, parse

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(t):
    found = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, t or ""):
            digits = digits_of(m[0])
            good = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), order, m.end(), kind))
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))


def random_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices("a.b@-+1234567890 (_%9.0", k=rng.randrange(1, 60))) for _ in range(n)]


def test_base_spans_match_brute_force():
    for t in [*random_texts(4000), "a@b.cd_e@f.gh", "1.2.3.4.5.6.7.8", "@@a@b.c", "a@b@c.d", "é@é.com x@y.zé"]:
        assert written(base_spans(t)) == brute(t), t


@pytest.mark.parametrize("t", ["1" * 100_000, "a" * 100_000 + "@", "a@" * 30_000, "+1" + "(" * 100_000, "1." * 30_000])
def test_long_runs_take_linear_time(t):
    base_spans(t)


def test_field_learns_spans_and_decodes_the_best_segmentation():
    rng = random.Random(6)
    samples = [f"call +1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)} now" for _ in range(40)]
    samples += [f"id {rng.randrange(10)} of {rng.randrange(1990, 2030)} pages" for _ in range(40)]
    field = train(samples)
    hits = [field.decode(Lattice(t, 0, len(t), [])) == gold_spans(t) for t in samples]
    assert sum(hits) >= 78
    small = Lattice("x +1 55", 0, 7, [])
    scores = field.scores(small)

    def best(i):
        if i == small.size:
            return 0.0
        options = [best(i + 1)] + [scores[c].max() + best(a + n) for c, (a, n, _) in enumerate(small.candidates) if a == i]
        return max(options)

    starts = {a: i for i, (a, _) in enumerate(small.tokens)}
    chosen = sum(
        scores[c, KINDS.index(kind)]
        for a, b, kind in field.decode(small) for c, (i, n, _) in enumerate(small.candidates)
        if i == starts[a] and small.tokens[i + n - 1][1] == b
    )
    assert abs(chosen - best(0)) < 1e-9
    assert Field().decode(small) == []


def test_query_keeps_base_spans(documents, odd_rows, with_clashes):
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(random_texts(60, 3))]
    got = find_personal_data(with_clashes(documents(rows)), keep=["doc_id", "text", "a b`c"]).collect()
    assert len(got) == len(rows)
    for r in got:
        expected = brute(r.text)
        assert r.base_spans == expected and set(filter(None, expected.split(","))) <= set(r.spans.split(","))
        assert r.n_email == expected.count("email:") and r.n_phone == expected.count("phone:")
    assert find_personal_data(documents([])).count() == 0


def test_added_spans_overlap_no_base_span():
    field = train(["mail a.b@c.org now", "ip 10.0.0.1 up"] * 5)
    for t in random_texts(300, 8):
        base, every = find_spans(t, field)
        for s in set(every) - set(base):
            assert all(s[1] <= b[0] or b[1] <= s[0] for b in base)


URLS = [
    None, "", "nothing", "://", "http://A.Example.NET/en/x?q#f", "https://example.com/de/", "https://x.example.com/de/a?://y",
    "http://org/fr/1", "http://borg/fr/1", "http://a.net", "http://a.net?x/", "ftp://ads.z.com/x/", "http://q.com/popup", "http://q.com/popups",
    "http://q.com/a.EXE", "http://x.org/de/print/", "http://tracker.io/x?sessionid=1&sessionid=2", "http://a.com/x?utm_source=feed",
]


def test_urls_match_brute_force(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(3, "://"), (3, "://")]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' as rule", "1 as verdict", "2 as host")
    got = judge_urls(pages, DOMAIN_RULES, URL_PATTERNS).collect()
    assert len(got) == len(rows)
    for r in got:
        m = re.search(r"://([^/?#]*)([^?#]*)", r.url or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fit = [d for d in DOMAIN_RULES if (host == d.host or host.endswith("." + d.host)) and path.startswith(d.path)]
        fit.sort(key=lambda d: len(d.name))
        hit = [p for p in map(parse, URL_PATTERNS) if r.url is not None and re.search(p.regex, r.url.lower(), re.DOTALL)]
        verdict = fit[-1].verdict if fit else "block" if hit and not any(p.allows for p in hit) else "allow"
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, fit[-1].name if fit else None, verdict), r
    assert judge_urls(pages.limit(0), DOMAIN_RULES, URL_PATTERNS).count() == 0


def test_only_whole_tokens_index_a_pattern():
    assert parse("||ads.*/").tokens == ("ads",) and parse("foo*bar^").tokens == () and parse("/foo/b").tokens == ("foo",)
    assert parse("@@|http://x.org|").allows and parse("&sessionid=").tokens == ("sessionid",)


def test_url_query_matches_its_oracle(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
    result = con.execute(ORACLES["op9_url_rules"])
    names = [c[0] for c in result.description]
    got = QUERIES["op9_url_rules"](spark, folder).select(*names).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(result.fetchall(), key=repr)
