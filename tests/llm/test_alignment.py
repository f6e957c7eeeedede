import hashlib
import json
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from propensity.llm import alignment, queries
from tests.llm.fixtures import frame, texts
from tests.llm.test_pieces import ODD, odd_texts

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def spelled(both, text):
    """(id, bytes) of both sides, token by token."""
    a, b = both
    table = alignment._byte_of()
    assert sorted(table.values()) == list(range(256))
    left = [(i, bytes(table[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    return left, right


def plain_version(both, rows):
    found, counts = [], Counter()
    for key, text in rows:
        left, right = spelled(both, text) if text else ([], [])
        raw = (" " + (text or "")).encode()
        if not text or b"".join(x for _, x in left) != raw or b"".join(x for _, x in right) != raw:
            found.append((key, 0, 0, 0, [], ""))
            continue
        spans = []
        for side in (left, right):
            at, out = 0, []
            for i, x in side:
                out.append((i, at, at + len(x)))
                at += len(x)
            spans.append(out)
        pairs = [(i, j) for i, s, e in spans[0] for j, t, f in spans[1] if s < f and t < e]
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, start = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in side if start < e <= cut) for side in spans))
            start = cut
        counts.update(pairs)
        found.append((key, len(left), len(right), len(groups), pairs, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = {}
    for (_, j), n in counts.items():
        most[j] = max(n, most.get(j, 0))
    return [
        (key, na, nb, ng, len(pairs), sum(counts[p] == most[p[1]] for p in pairs), sum(counts[p] for p in pairs), told)
        for key, na, nb, ng, pairs, told in found
    ]


def rows_of(extra=()):
    short = [(k, t) for k, t in texts() if len(t or "") < 1000]
    return short + [(200 + i, t) for i, t in enumerate([*ODD, *odd_texts(60), "<|endoftext|> a", "Ünïcödé wörds, don't  stop\n\n\tnow 12345"])] + list(extra)


def test_query_equals_the_plain_version(spark, both, tmp_path, monkeypatch):
    rows = rows_of()
    frame(spark, rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    want = sorted(map(repr, plain_version(both, rows)))
    assert sorted(map(repr, map(tuple, queries.op13_alignment(spark, str(tmp_path)).collect()))) == want
    monkeypatch.setattr(alignment, "TEXT_BYTES", 300)
    monkeypatch.setattr(alignment, "BLOCK_LINKS", 500)
    assert sorted(map(repr, map(tuple, queries.op13_alignment(spark, str(tmp_path)).collect()))) == want


def test_aligned_tokens(spark, both):
    rows = rows_of()
    by_key = {k: t for k, t in rows if k is not None and k != 11}
    for r in alignment.align(frame(spark, rows), BYTES, PIECES).where("doc_id is not null and doc_id != 11").collect():
        if r.a_ids:
            assert r.a_ends[-1] == r.b_ends[-1] == len(by_key[r.doc_id].encode()) + 1
            cuts = sorted(set(r.a_ends) & set(r.b_ends))
            for ends, groups in ((r.a_ends, r.a_group), (r.b_ends, r.b_group)):
                assert groups == [int(np.searchsorted(cuts, e)) for e in ends]
        else:
            assert not r.b_ids and (not by_key[r.doc_id] or "▁" in by_key[r.doc_id])


def test_ranks_give_the_ids_of_the_library(both):
    """Every code point in every place where its class decides how a text is cut."""
    encode, _ = alignment.byte_encoder(BYTES)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 4000):
        part = [f" a{c}b 1{c}2 .{c}. {c} {c}{c}  {c}'s\n{c}" for c in map(chr, points[at : at + 4000])]
        for text, told in zip(part, both[0].encode_batch_fast(part, add_special_tokens=False)):
            assert encode(text).tolist() == told.ids
    for text in ("y" * 100_000, " " * 1_000_000, "<|endoftext|>", "\n" * 100_000 + "a"):
        assert encode(text).tolist() == both[0].encode(text, add_special_tokens=False).ids


def test_vocabularies_that_are_not_ranks_go_through_the_library(both, tmp_path):
    told = json.loads(open(BYTES).read())
    told["model"]["merges"] = told["model"]["merges"][:300] + told["model"]["merges"][301:]
    (tmp_path / "other.json").write_text(json.dumps(told))
    other = Tokenizer.from_file(str(tmp_path / "other.json"))
    other.encode_special_tokens = True
    encode, _ = alignment.byte_encoder(str(tmp_path / "other.json"))
    text = " the quick brown fox <|endoftext|> naïve"
    assert encode(text).tolist() == other.encode(text, add_special_tokens=False).ids


def test_pointer_jumping_on_long_chains():
    draw = random.Random(2)
    for _ in range(200):
        n = draw.randint(1, 60)
        a, b = (sorted({*draw.sample(range(1, n + 1), draw.randint(0, n)), n}) for _ in range(2))
        cuts = sorted(set(a) & set(b))
        got = alignment.components(np.array(a), np.array(b))
        assert [g.tolist() for g in got] == [[int(np.searchsorted(cuts, e)) for e in side] for side in (a, b)]
    n = 100_000  # tokens of two bytes, the sides shifted by one: a single component
    got = alignment.components(np.arange(2, 2 * n + 1, 2), np.concatenate([np.arange(1, 2 * n, 2), [2 * n]]))
    assert all((g == 0).all() for g in got)


def test_empty_table_long_texts_and_other_columns(spark, both):
    score = lambda df: alignment.link_scores(df, BYTES, PIECES)
    assert score(frame(spark, [])).collect() == []
    assert [r.n_links for r in score(frame(spark, [(1, None), (2, "")])).collect()] == [0, 0]
    rows = [(1, "word other " * 40_000), (2, "y" * 100_000)]
    for r in score(frame(spark, rows)).collect():
        left, right = spelled(both, dict(rows)[r.doc_id])
        assert (r.n_a, r.n_b, r.n_links) == (len(left), len(right), len(left) + len(right) - r.n_groups)
    clash = frame(spark, [(7, "a b")]).select("doc_id", "text", F.lit(1).alias("block"), F.lit(2).alias("a_ids"), F.lit(3).alias("n_links"))
    assert score(clash).first().doc_id == 7
