import public_tokenizers
import pytest
import sentencepiece

from propensity.llm import token_counts as counts
from tests.llm.fixtures import frame, texts

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a  b\n\nc  ", " a", "\n", " ", "   ", "\n x", "▁a ▁▁", "<s> </s> <0x0A>", "é é ﬁ", "\t\tx\r\n y", "x" * 300, "漢字\U0001f600 ok", "　x"]


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.mark.parametrize("text", ODD)
def test_every_prefix_equals_the_library(model, text):
    counter = counts.TokenCounter(PATH)
    segments = counter.segments(text)
    before, got = 0, []
    for segment, total in zip(segments, counter.prefixes(segments).tolist()):
        inside = counter.inside(segment)
        assert before + inside[-1] == total
        got += [before + n for n in inside]
        before = total
    assert got[1:] == [len(model.encode(text[: k + 1])) for k in range(len(text))]


def test_query_columns(spark, model):
    limit = 20
    rows = counts.token_counts(frame(spark), PATH, limit).collect()
    want = [(i, len((t or "").encode()), len(model.encode(t or ""))) for i, t in texts()]
    assert sorted(map(repr, ((r.doc_id, r.n_bytes, r.n_tokens) for r in rows))) == sorted(map(repr, want))
    by_id = dict(texts())
    for r in rows:
        assert r.over_limit == (r.n_tokens > limit)
        if r.over_limit and r.doc_id is not None:
            fits = [k for k in range(r.limit_chars, min(r.limit_chars + 40, len(by_id[r.doc_id])) + 1) if len(model.encode(by_id[r.doc_id][:k])) <= limit]
            assert fits == [r.limit_chars]
    assert counts.token_counts(frame(spark, []), PATH, limit).collect() == []


def test_prefix_table(spark, model):
    by_id = dict(texts())
    for r in counts.prefix_table(frame(spark), PATH).where("doc_id in (3, 12)").collect():
        assert r.counts == [len(model.encode(by_id[r.doc_id][:k])) for k in r.ends]
