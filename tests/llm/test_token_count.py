"""op10: counts equal the library's own on fixtures, odd characters and special strings."""

import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from conftest import SMALL
from slotcast.llm import queries, token_count as tc

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)
STATE = tc._Counter(open(PATH, encoding="utf-8").read(), tc.whole_tokens(LIB))


def brute(text):
    return len(LIB.encode(text, add_special_tokens=False).ids)


def test_query_equals_library(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.op10_token_counts(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.n_tokens == brute(texts[r.doc_id] or "")
        assert r.n_bytes == len((texts[r.doc_id] or "").encode())
        assert r.over_limit == (r.n_tokens > 512)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    assert STATE.counts([text]) == [brute(text)]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab '<|>ndoftexs\n\t\x85 é1½ǅ𐥀", max_size=40))
def test_hard_alphabet(text):
    assert STATE.counts([text + "<|endoftext|>" + text]) == [brute(text + "<|endoftext|>" + text)]


def test_edge_rows(spark):
    long = "thtionble " * 60_000
    rows = [(1, None, 1), (None, "a b", 2), (2, "", 3), (3, long, 4), (3, long, 4), (4, "\U00010940\U00010941 x", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = tc.count_tokens(df, PATH).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == sorted(
        (i or 0, brute(t or "")) for i, t, _ in rows)
    assert tc.count_tokens(df.limit(0), PATH).count() == 0
