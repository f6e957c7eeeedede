import hashlib
import re

import pytest
from pyspark.sql import functions as F

from propensity.llm import middle
from tests.llm.fixtures import frame, texts

_UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
ODD = [" ", "\n\n", "a", " a ", "a\x85b　c\xa0d", "\U0001f600 \U0001f601\n\r\n x", "$1 \\2 $ \\", "<P", "a <P> b", "<S><M>", "<M", "<<S> >", "(x) [y] {2}+ .*", "  a b "]


def plain_version(key, text, changed=50, spm=80):
    text, digest = text or "", hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    units = _UNIT.findall(text)
    assert "".join(units) == text
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, mid, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= changed:
        return key, n, "plain", None, None, text
    if h[3] % 100 < spm:
        return key, n, "spm", len(prefix), len(mid), f"<S>{suffix}<P>{prefix}<M>{mid}"
    return key, n, "psm", len(prefix), len(mid), f"<P>{prefix}<S>{suffix}<M>{mid}"


@pytest.mark.parametrize("changed, spm", [(50, 80), (100, 0), (100, 100), (0, 50)])
def test_equals_the_plain_version(spark, changed, spm):
    rows = texts() + [(100 + i, t) for i, t in enumerate(ODD * 3)]
    out = middle.transform(frame(spark, rows), changed_percent=changed, spm_percent=spm)
    got = out.withColumn("back", middle.restore(F.col("output"), F.col("form"))).collect()
    want = [plain_version(k, t, changed, spm) for k, t in rows]
    assert sorted(map(repr, (tuple(r)[:6] for r in got))) == sorted(map(repr, want))
    assert sorted(map(repr, ((r.doc_id, r.back) for r in got))) == sorted(map(repr, ((k, t or "") for k, t in rows)))


def test_marks_inside_parts_do_not_confuse(spark):
    texts = ["< P> <S <M x", "a< <b >c <P<S<M", "> P> S> M>"]
    out = middle.transform(frame(spark, [(i, t) for i, t in enumerate(texts * 30)]), changed_percent=100)
    back = out.select("doc_id", middle.restore(F.col("output"), F.col("form")).alias("back")).collect()
    assert all(r.back == texts[r.doc_id % 3] for r in back)


def test_very_long_texts(spark):
    rows = [(1, "ab cd\n" * 300_000), (2, "x" * 3_000_000), (3, " " * 3_000_000), (4, "é " * 500_000), (5, "a" + "\t" * 1_000_000 + "b")]
    got = middle.transform(frame(spark, rows), changed_percent=100).collect()
    assert sorted(tuple(r) for r in got) == sorted(plain_version(k, t, 100) for k, t in rows)


def test_empty_table_and_other_columns(spark):
    assert middle.digests(middle.transform(frame(spark, []))).collect() == []
    clash = frame(spark, [(1, "a b c d")]).select("doc_id", "text", F.lit(9).alias("n"), F.lit("z").alias("form"), F.lit("o").alias("output"), F.lit(1).alias("a"))
    assert tuple(middle.transform(clash).first()) == plain_version(1, "a b c d")
