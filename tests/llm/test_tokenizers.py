"""Token counts and byte-pair encoding give what the tokenizers library gives."""

import hashlib
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

from clientele.llm import token_counts
from clientele.llm.bpe import WordBpe, encode_digests, encode_documents
from clientele.llm.token_counts import Summary, count_tokens

COUNTER = public_tokenizers.path("byte_bpe_50k.json")
ENCODER = public_tokenizers.path("word_bpe_49k.json")
SPACED = [
    "  a   b  ", "a\n b \n c", "x \n\n y ", "a<|endoftext|>B", "\n \nfoo", "end \n", "tab\t x\t\ty", "it's 'sky '' 12ab  ",
    "It's I'M we'LL", "ΣΟΦΟΣ ﬁ x́ Ａ", "aaaa" * 500, "<|startoftext|>x<|endoftext|>", "\x00\x1c\x85 z", "🎉🎉 ok ½²³",
]


def test_counts_match_the_library(documents, odd_rows, monkeypatch):
    monkeypatch.setattr(token_counts, "FREQUENT", 5)
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(SPACED)]
    library = Tokenizer.from_file(COUNTER)
    expected = Counter()
    for i, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        expected[i, len((t or "").encode()), n, n > 6] += 1
    got = count_tokens(documents(rows), COUNTER, 6, keep=["doc_id"]).collect()
    assert Counter(tuple(r) for r in got) == expected


def test_summary_keeps_frequent_items_in_bounded_memory():
    seen = Summary(size=50)
    for i in range(2000):
        seen.update([f"rare{i}", "often"])
    assert len(seen.counts) <= 50 and seen.counts["often"] > 1000


def test_ids_and_decoded_text_match_the_library(documents, odd_rows):
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(SPACED)]
    library = Tokenizer.from_file(ENCODER)

    def digest(s):
        return hashlib.sha256(s.encode()).hexdigest()

    expected, whole = Counter(), Counter()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected[i, len(ids), digest(" ".join(map(str, ids))), digest(decoded)] += 1
        whole[i, tuple(ids), decoded] += 1
    docs = documents(rows)
    assert Counter(tuple(r) for r in encode_digests(docs, ENCODER, keep=["doc_id"]).collect()) == expected
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in encode_documents(docs, ENCODER).collect()) == whole


def test_small_tables_of_known_units_change_nothing(monkeypatch):
    monkeypatch.setattr("clientele.llm.bpe.CACHE_UNITS", 3)
    library, own = Tokenizer.from_file(ENCODER), WordBpe(ENCODER)
    for text in ["one two three four five", "two six, seven!", "one eight", *SPACED]:
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_empty_tables_and_clashing_columns(spark, documents, with_clashes):
    none = documents([])
    assert count_tokens(none, COUNTER, 5).count() == 0 and encode_documents(none, ENCODER).count() == 0
    row = encode_documents(with_clashes(documents([(1, "a b")])), ENCODER).first()
    assert row["n_tokens"] == 2 and row["a b`c"] == "x"
    assert count_tokens(with_clashes(documents([(1, "a b")])), COUNTER, 5).first()["n_tokens"] == 2
