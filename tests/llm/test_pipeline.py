"""The corpus pipeline: each stage's decisions take effect, columns survive, nothing clean is lost."""

import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from clientele.llm.catalog import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


def test_stages_are_the_dealt_ones():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "bpe_encode_decode"]
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14)) and set(ORACLES) <= set(QUERIES)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))

    def prose(i, n=70):
        return " ".join(f"w{(i * 7919 + k * k * 31 + k) % 5003}" for k in range(n))

    passage = prose(900, 40)
    rows = {i: prose(i) + "\n" + prose(i + 50) for i in range(8)}
    rows[10] = rows[1]  # an exact copy: every line is a later one
    rows[11] = rows[2].replace("\n", " ", 1)  # the same words in other lines
    rows[12] = prose(60) + "\n" + rows[3].split("\n")[0]  # shares a long line
    rows[13] = prose(70) + " " + passage + " " + prose(71)
    rows[14], rows[15], rows[16] = "too short", None, "a b c " * 60
    data = [(i, t, "en", "s", len(t or "")) for i, t in rows.items()]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(0, 1), (1, 1)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_every_stage_takes_effect(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet").selectExpr("*", "'x' as n_tokens", "1 as deleted", "2 as `a b``c`")
    columns, ids = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, tables).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        ids.append({r.doc_id for r in docs.select("doc_id").collect()})
        if name != "bpe_encode_decode":
            assert docs.columns == columns
        if name == "line_dedup":
            texts = {r.doc_id: (r.text, r.n_chars) for r in docs.collect()}
    good = set(range(8)) | {10, 11, 12, 13}
    assert ids == [good, good - {10}, good - {10, 11}, good - {10, 11, 13}, good - {10, 11, 13}]
    assert "\n" not in texts[12][0] and texts[12][1] == len(texts[12][0])
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in docs.collect():
        expected = library.encode(texts[r.doc_id][0], add_special_tokens=False).ids
        decoded = library.decode(expected, skip_special_tokens=False)
        assert r.ids == expected and r.n_tokens == len(expected)
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_run_gives_what_the_stages_give(spark, tables):
    assert {r.doc_id for r in corpus_pipeline.run(spark, tables).collect()} == set(range(8)) | {12}


def test_empty_documents(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, tables).count() == 0


PER_ROW = sorted(n for n in QUERIES if not n.startswith(("op11", "op13")))  # these two return nodes and phrases


def test_the_trie_holds_every_conversation(spark):
    every = spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id").distinct().count()
    assert QUERIES["op11_conversation_trie"](spark, DATA).filter("depth = 0").first()["n_convs"] == every


@pytest.mark.parametrize("name", PER_ROW)
def test_queries_cover_their_whole_table(spark, name):
    table, key = ("pages", "page_id") if name.startswith("op9") else ("documents", "doc_id")
    got = QUERIES[name](spark, DATA).select(key).collect()
    every = {r[0] for r in spark.read.parquet(f"{DATA}/{table}.parquet").select(key).collect()}
    found = {r[0] for r in got}
    assert found <= every if name.startswith("op6") else found == every and len(got) == len(every)
