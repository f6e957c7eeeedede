import random
from collections import Counter

import corpus_pipeline
from propensity.session import materialize
from tests.llm.fixtures import components, frame, sentence
from tests.llm.test_operators import plain_spans

WORDS = {"en": "the and of to in with from that have this which their would there about".split()}
WORDS["de"] = "der die und nicht mit von zu auch werden haben eine durch noch nach wurde".split()


def drawn(seed, lang, size=60):
    return " ".join(random.Random(seed).choices(WORDS[lang], k=size))


def documents():
    rows = [(2 * i, drawn(i, "en"), "en") for i in range(40)] + [(2 * i + 1, drawn(100 + i, "de"), "de") for i in range(40)]
    rows += [(200, drawn(3, "en"), "en"), (201, drawn(3, "en") + " the", "en"), (210, "12 %", None), (211, None, None)]
    rows += [(None, f"{drawn(300, 'en')} {sentence(70, 12)}", "en"), (220, f"{drawn(301, 'en')} {sentence(70, 12)}", "en"), (None, drawn(302, "de"), "de")]
    return rows + [(230, f"{drawn(303, 'en')} 10.0.0.1 {drawn(304, 'en', 20)}", "en")]


def masked(text):
    for kind, a, b in reversed(plain_spans(text)):
        text = f"{text[:a]}<{kind.upper()}>{text[b:]}"
    return text


def test_stages_equal_plain_versions(spark, tmp_path):
    item = sentence(70, 12)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    langs = {(i, t): lang for i, t, lang in documents()}
    docs = spark.createDataFrame([(*r[:2], langs[r[:2]], *r[3:]) for r in map(tuple, frame(spark, [d[:2] for d in documents()]).collect())], frame(spark, []).schema)
    want = [d[:2] for d in documents()]
    plain = {
        "language": lambda rows: [r for r in rows if any(c.isalpha() for c in r[1] or "")],
        "ngram_join": lambda rows: [r for r, (key, _, first) in zip(rows, components(rows)) if key is None or key == first],
        "decontaminate": lambda rows: [r for r in rows if item not in r[1]],
        "pii": lambda rows: [(i, masked(t)) for i, t in rows],
    }
    before = None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, str(tmp_path)), name)
        want = plain[name](want)
        assert Counter((r.doc_id, r.text) for r in docs.collect()) == Counter(want), name
        assert want != before, name
        before = want
    name, stage = corpus_pipeline.STAGES[-1]
    assert {r.doc_id for r in stage(spark, docs, str(tmp_path)).collect()} == {i for i, _ in want}


def shuffled(df):
    """Rows that each shuffle of the texts moved when ``df`` was run."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "ShuffleExchangeExec" and "text" in node.output().mkString(" "):
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        below = [node.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [node.plan()] if kind.endswith("QueryStageExec") else []
        children = node.children()
        todo += below + [children.apply(i) for i in range(children.size())]
    return found


def test_texts_that_stay_are_not_shuffled(spark, tmp_path):
    item = sentence(70, 40)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(i, drawn(i, "en")) for i in range(60)] + [(100, drawn(5, "en")), (7, drawn(7, "en")), (101, item), (None, drawn(5, "en"))]
    docs = materialize(frame(spark, rows), "documents")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        alone = corpus_pipeline.deduplicate(spark, docs, str(tmp_path))
        moved = shuffled(alone)
        clean = corpus_pipeline.decontaminated(spark, docs, str(tmp_path))
        moved_clean = shuffled(clean)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert moved and max(moved) == 3 and moved_clean == [1]
    assert Counter(r.doc_id for r in alone.collect()) == Counter([*range(60), 101, None])
    assert Counter(r.doc_id for r in clean.collect()) == Counter([*range(60), 7, 100, None])
