"""Token counts against the tokenizer library on whole texts."""
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from estuary.llm import token_counts

PATH = public_tokenizers.path(token_counts.TOKENIZER)
ODD = ["<|endoftext|>", "a<|endoftext|>B <|STARTOFTEXT|> <|startoftext|><|endoftext|>", "H̱ Σ ΑΣ İ ß ﬁ", "don't IT'S 'll'd x's9",
       "a b c\u0085d　e", "é ́x", "中文 한국어 العربية ไทย १२३ ½ ²", "tab\tcr\rvt\x0bff\x0c\x1c\x00end",
       "🙂🙃 🏳️‍🌈!!", "1234,567.89", "ǅ ῼ Ωmega", "'s" * 50, "x" * 9_000]


def want(texts):
    t = Tokenizer.from_file(PATH)
    return [len(t.encode(x or "", add_special_tokens=False).ids) for x in texts]


@pytest.mark.parametrize("hot", [1, 40, 1 << 18])
def test_counts_match_the_library(docs_of, odd_rows, hot, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_WORDS", 60)  # both tables overflow
    rows = odd_rows + [(200 + i, t, "s") for i, t in enumerate(ODD)]
    out = token_counts.count_tokens(docs_of(rows), hot=hot).collect()
    n = want(t for _, t, _ in rows)
    expected = [(i, len((t or "").encode()), k, k > 2048) for (i, t, _), k in zip(rows, n)]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted(map(tuple, out), key=key) == sorted(expected, key=key)
    assert any(r.over_limit for r in out)


def test_whole_table_matches_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, hot=500).collect()}
    assert got == dict(zip(rows, want(rows.values())))


def test_each_pre_token_is_counted_once(docs_of, odd_rows):
    """No pre-token is a key twice, and broadcast ones are not joined."""
    docs = docs_of(odd_rows)
    hot = token_counts.frequent_pieces(docs, PATH, hot=30)
    assert len(hot) == 30
    counts = token_counts.with_pieces(docs.sparkSession.createDataFrame([("hello", 3), ("\tzzzq", 1)], "token string, freq bigint"), PATH)
    assert {r.token: r.n_pieces for r in counts.collect()} == {"hello": 1, "\tzzzq": want(["zzzq"])[0]}


def test_empty_table_and_limit(docs_of):
    assert token_counts.count_tokens(docs_of([])).collect() == []
    out = token_counts.count_tokens(docs_of([(1, "one two three", "s"), (2, None, None)]), limit=2).orderBy("doc_id")
    assert [(r.n_tokens, r.over_limit) for r in out.collect()] == [(3, True), (0, False)]
    assert out.select(F.sum("n_bytes")).first()[0] == 13


def test_tokenizers_that_keep_white_space_are_refused():
    with pytest.raises(ValueError):
        token_counts.PreTokenizer(public_tokenizers.path("byte_bpe_50k.json"))
