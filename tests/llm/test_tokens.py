import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from folioscope.llm import tokens

TEXTS = [
    None, "", " ", "\n", "a", " a", "a ", "a  b", "a \nb c", "a\n b", "a b\nc d\n", "don't we'll  x\n\n\ny  ",
    "<|endoftext|> a<|endoftext|>", "<|startoftext|>x", "Ünï 1234 5,6 𝒳 ﬁ", "İSTANBUL ΣΑΣ", "éa", "a\x1cb", "'S 's ''s",
    "a" * 5000, "x y", "ŉ ŀ", " 12 ²³ ½ ⅷ", "a\x85b", "x­b", "日本 語", "word " * 3000, "_:)…–“q”",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_counts_and_ids_equal_the_library(spark, name):
    path = public_tokenizers.path(name)
    library = Tokenizer.from_file(path)
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(TEXTS)], "doc_id bigint, text string, n_bytes int")
    got = {r.doc_id: r for r in tokens.token_counts(docs, path).collect()}
    encode = tokens.encoder(path)
    for i, text in enumerate(TEXTS):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids) and got[i].n_bytes == i, text
        assert encode(text) == tokens.id_bytes(ids), text


def test_the_table_only_saves_work(spark, monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS * 3)], "doc_id bigint, text string")
    full = tokens.token_counts(docs, path).agg(F.sum("n_tokens")).first()[0]
    monkeypatch.setattr(tokens, "frequent_lengths", lambda *a, **k: {})
    assert tokens.token_counts(docs, path).agg(F.sum("n_tokens")).first()[0] == full
    assert tokens.token_counts(docs.where("false"), path).count() == 0


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED", 3)
    cache = tokens.Cache(len).over({"kept": 4})
    assert [cache[x] for x in ("a", "bb", "ccc", "dddd", "a")] == [1, 2, 3, 4, 1]
    assert cache["kept"] == 4 and len(cache) <= 5
