"""op5 against SQL and by hand; the pipeline against its operators' rules."""

import random
import re

import duckdb
import pytest
from cases import CLASHING, awkward_documents, frame
from test_dedup import plain_fingerprint
from test_text_ops import check_packing

import corpus_pipeline
from hvault.llm import chat_format as C
from hvault.llm import queries, quality_classifier, secret_scan

TEXTS = "/root/testdata/sf0.001"
MESSAGES = f"conv_id long, turn long, role string, text string, calls {C.CALLS}, result_of string"


def test_chat_equals_sql(spark):
    path = f"{TEXTS}/conversations.parquet"
    got = C.chat_lines(spark.read.parquet(path))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{path}'")
    q = con.sql(C.CHAT_SQL)
    assert sorted(map(str, (tuple(r[c] for c in q.columns) for r in got.collect()))) == sorted(map(str, q.fetchall()))


def chat(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], MESSAGES + ", row string")
    return {(r.conv_id, r.turn, r.item): r for r in C.format_chats(df, C.tool_table(spark)).collect()}


def test_levels_cycles_and_validation(spark):
    calls = [
        ("p", "lookup", '{"term":"b","exact":true}', ["q"]),  # needs a later call
        ("q", "lookup", '{ "exact": 1 }', []),
        ("z", "nope", "[1]", ["z"]),  # needs itself
        ("y", "lookup", "not json", ["z", "gone"]),
        ("w", "count_words", '{"text":"a","min_length":3,"b":{"z":1,"a":[1, 2]}}', ["p"]),
        (None, None, None, None),
    ]
    out = chat(spark, [(1, 0, "a", "x\n\"é", calls, None), (1, 1, "t", None, None, "p"), (1, 2, "t", "r", [], "gone"), (None, None, None, None, None, None), (2, 0, "a", "", calls[1:2], None)])
    assert [out[1, 0, i].level for i in range(6)] == [2, 1, None, None, 3, None] and out[2, 0, 0].level == 1
    assert [out[1, 0, i].errors for i in range(6)] == [
        "", "argument exact is BIGINT, not BOOLEAN; missing argument term", "arguments are no object; unknown tool", "arguments are no object", "unknown argument b", "arguments are no object; unknown tool",
    ]
    assert out[1, 0, 4].json == '{"arguments":{"b":{"a":[1,2],"z":1},"min_length":3,"text":"a"},"id":"w","name":"count_words","needs":["p"],"type":"call"}'
    assert out[1, 0, -1].json == '{"content":"x\\n\\"é","role":"a","type":"message"}'
    assert (out[1, 0, 0].linked, out[1, 0, 1].linked, out[1, 1, -1].linked, out[1, 2, -1].linked) == (True, False, True, False)
    assert out[None, None, -1].json == '{"content":"","role":"","type":"message"}'


def test_long_chain_and_repeats(spark):
    calls = [(f"c{i}", "lookup", '{"term":"b"}', [f"c{i + 1}"]) for i in range(6)] + [("c0", "lookup", '{"term":"b"}', [])]
    out = chat(spark, [(1, 0, "a", "x", calls, None), (1, 1, "t", "x", None, "c0"), (1, 1, "t", "x", None, "c0")])
    assert [out[1, 0, i].level for i in range(6)] == [6, 5, 4, 3, 2, 1] or out[1, 0, 5].level == 1
    empty = spark.createDataFrame([], MESSAGES)
    assert C.format_chats(empty, C.tool_table(spark)).count() == 0


@pytest.mark.parametrize("turns", [1, 1501])
@pytest.mark.parametrize("span", [C.SPAN, 200])
def test_chain_longer_than_a_thousand(spark, monkeypatch, turns, span):
    """Each call needs the two before it; one need points forward; in one block or several."""
    monkeypatch.setattr(C, "SPAN", span)
    calls = [(f"c{i}", "lookup", '{"term":"b"}', [f"c{j}" for j in (i - 1, i - 2) if j >= 0] or ["last"]) for i in range(1500)] + [("last", "lookup", '{"term":"b"}', [])]
    rows = [(1, 0, "a", "x", calls, None)] if turns == 1 else [(1, t, "a", "x", [call], None) for t, call in enumerate(calls)]
    out = chat(spark, rows)
    assert [out[(1, 0, i) if turns == 1 else (1, i, 0)].level for i in range(1501)] == [*range(2, 1502), 1]


def plain_levels(needs):
    """Level of each call, by rounds; calls on or behind a cycle have none."""
    level = {}
    while now := {i: 1 + max((level[k] for k in x), default=0) for i, x in needs.items() if i not in level and all(k in level for k in x)}:
        level |= now
    return level


@pytest.mark.parametrize("span", [C.SPAN, 4, 1])
def test_levels_equal_plain_ones(spark, monkeypatch, span):
    """In blocks of all sizes: forward needs, cycles, several turns, repeated ids and positions."""
    monkeypatch.setattr(C, "SPAN", span)
    rng = random.Random(3)
    rows, exp = [], {}
    for conv in range(25):
        n = rng.randint(1, 14)
        needs = {f"c{i}": [f"c{rng.randrange(n)}" for _ in range(rng.choice([0, 1, 1, 2]))] if rng.random() < 0.2 else [f"c{k}" for k in {i + 1, i + rng.randint(1, 3)} if k < n] for i in range(n)}
        if conv % 2:
            needs = {f"c{n - 1 - int(i[1:])}": [f"c{n - 1 - int(k[1:])}" for k in x] for i, x in needs.items()}
        calls = [(i, "lookup", '{"term":"b"}', x) for i, x in sorted(needs.items(), key=lambda x: int(x[0][1:]))]
        cut = rng.randint(0, n)
        rows += [(conv, 0, "a", "x", calls[:cut], None), (conv, rng.choice([0, 1, 9, None]), "a", "x", calls[cut:] + calls[:1], None)]
        exp |= {(conv, i): plain_levels(needs).get(i) for i in needs}
    df = spark.createDataFrame([(*r, "x") for r in rows], MESSAGES + ", row string")
    got = [r for r in C.format_chats(df, C.tool_table(spark)).collect() if r.kind == "call"]
    assert len(got) == sum(len(r[4]) for r in rows) and {(r.conv_id, r.call_id): r.level for r in got} == exp
    assert None in exp.values() and max(v or 0 for v in exp.values()) > 5


def test_arguments_that_are_no_value(spark):
    """A repeated key gives no value; arguments of some megabytes do."""
    long = '{"term":"' + "b" * 5_000_000 + '"}'
    out = chat(spark, [(1, 0, "a", "x", [("p", "lookup", '{"term":"a","term":"b"}', []), ("q", "lookup", long, None)], None)])
    assert (out[1, 0, 0].errors, out[1, 0, 1].errors) == ("arguments are no object", "")
    assert out[1, 0, 0].json.startswith('{"arguments":"{\\"term\\":\\"a\\"') and long in out[1, 0, 1].json


def test_native_plan(spark):
    plan = C.chat_lines(spark.read.parquet(f"{TEXTS}/conversations.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_pipeline_rules(spark):
    """Every stage against a plain version of its rule, over what the stage before it kept."""
    docs = spark.read.parquet(f"{TEXTS}/documents.parquet")
    labels = spark.read.parquet(f"{TEXTS}/labels.parquet")
    kept = {"documents": sorted(map(tuple, docs.collect()))}
    cur = docs
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.stored(stage(spark, cur, TEXTS), name)
        before = {r[0]: r for r in map(tuple, cur.collect())}
        rows = out.collect()
        if name != "packing":
            assert out.columns == docs.columns
        if name == "quality_classifier":
            good = {r.doc_id for r in quality_classifier.score_documents(cur, labels).where("predicted = 1").collect()}
            assert {r.doc_id for r in rows} == good
        elif name == "exact_dedup":
            least = {}
            for d, r in before.items():
                t = re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")
                least[t] = min(d, least.get(t, d))
            assert {r.doc_id for r in rows} == set(least.values())
        elif name == "simhash_near_dedup":
            fps = {d: plain_fingerprint(r[1]) for d, r in before.items()}
            gone = {d for d in fps for e in fps if e < d and (fps[d] ^ fps[e]).bit_count() <= 3}
            assert {r.doc_id for r in rows} == set(fps) - gone
        elif name == "secret_scan":
            assert {r.doc_id: r.text for r in rows} == {d: secret_scan.masked(r[1]) for d, r in before.items()}
        else:
            check_packing([(d, r[1]) for d, r in before.items()], rows)
        cur = out
    assert kept["documents"] and sorted(map(tuple, corpus_pipeline.run(spark, TEXTS).select("doc_id", "start", "length", "ids_crc32", "doc_tokens").collect())) == sorted(
        tuple(r[:5]) for r in cur.collect()
    )


@pytest.mark.parametrize("rows", [awkward_documents(n=20), []])
def test_stages_on_awkward_documents(spark, rows, tmp_path):
    docs = frame(spark, rows, CLASHING)
    spark.createDataFrame([(d, i % 2, 0) for i, (d, _) in enumerate(rows)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert name == "packing" or out.columns == docs.columns
        docs = out if name == "packing" else corpus_pipeline.stored(out, name)
    docs.count()


def test_registered(spark):
    names = list(queries.QUERIES)
    assert "pipeline" in names and [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
