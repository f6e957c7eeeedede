import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from propensity.llm import common, decontaminate, fingerprint, language, lm_score, main_text, mixing, pii, quality
from tests.llm.fixtures import frame, sentence, texts

IDS = sorted((i for i, _ in texts()), key=repr)


def ids(rows):
    return sorted((r.doc_id for r in rows), key=repr)


def test_model_probabilities_sum_to_one():
    draw = np.random.default_rng(1)
    model = lm_score.initial(np.full(lm_score.CLASSES, 1 / lm_score.CLASSES))
    model = {k: v + draw.standard_normal(v.shape).astype(np.float32) * 0.1 for k, v in model.items()}
    first, second, normal = lm_score.tables(model)
    for one, two in ((0, 0), (5, 9), (2000, 3)):
        assert np.exp(first[one, 1:] + second[two, 1:] - normal[one, two], dtype=np.float64).sum() == pytest.approx(1, abs=1e-4)


def test_training_lowers_the_loss():
    draw = np.random.default_rng(3)
    shares = np.full(lm_score.CLASSES, 1e-6)
    shares[2:22] = 0.05
    model = lm_score.initial(shares)
    one = draw.integers(2, 22, 60_000)
    steps = [(2 + (one[i : i + 2048] + 1) % 20, one[i : i + 2048], one[i : i + 2048]) for i in range(0, 60_000, 2048)]
    assert lm_score.train(model, shares, iter(steps * 4), 1) == 240_000
    first, second, normal = lm_score.tables(model)
    w, v, _ = steps[0]
    assert (first[v, w] + second[v, w] - normal[v, v]).mean() > math.log(0.05) + 1


def test_base_scores(spark):
    rows = lm_score.score(frame(spark), F.col("doc_id") == 10).collect()
    tokens = {t: common.words((t or "").encode()) + [None] for _, t in texts()}
    counts = Counter(w for i, t in texts() if i != 10 for w in tokens[t])
    total, kinds = sum(counts.values()), len(counts)
    want = []
    for i, t in texts():
        w = tokens[t]
        want.append((i, i == 10, len(w), sum(counts[x] > 0 for x in w), total, round(sum(math.log10((counts[x] + 1) / (total + kinds + 1)) for x in w), 6)))
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)
    assert lm_score.score(frame(spark, []), F.lit(False)).collect() == []


def test_language(spark):
    letters = {"aa": "the and of to in with from", "bb": "der die und nicht mit von zu", "cc": "les des une dans pour que qui"}
    rows = []
    for k in range(240):
        lang = ("aa", "bb", "cc")[k % 3]
        words = letters[lang].split()
        rows.append((k, " ".join(words[(k * j) % 7] + words[(k + j) % 7][:2] for j in range(40)), lang))
    docs = spark.createDataFrame([*rows, (900, None, "aa"), (901, "12 %", None), (None, "the and", None)], "doc_id long, text string, lang string")
    learned = language.fit(docs.where("doc_id % 4 != 1"))
    told = language.predict(docs, learned).collect()
    truth = {k: lang for k, _, lang in rows}
    held = [r for r in told if r.doc_id in truth and r.doc_id % 4 == 1]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in told)
    assert {(r.doc_id, r.lang_pred, r.accepted) for r in told if r.doc_id in (900, 901)} == {(900, "und", False), (901, "und", False)}
    assert language.accepted(docs, learned).columns == docs.columns
    assert {r.lang_pred for r in language.predict(docs, {}).collect()} == {"und"}
    assert language.fit(docs.where("false")) == {}


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            odd = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 12 <= len(digits) <= 19 and odd % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }
            if ok[kind]:
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_personal_data_patterns():
    draw = np.random.default_rng(4)
    for alphabet in ("a.@ _%b-", "0123456789.", "0123456789 -", "+0123456789 ().", "a@.1+ 2-"):
        for _ in range(3000):
            text = "".join(draw.choice(list(alphabet), draw.integers(0, 40)))
            assert pii.find(text) == plain_spans(text), text
    for long in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "a@" * 100_000, "+1" * 50_000):
        pii.find(long)


def test_terms_that_disclose(spark):
    near = [(i, f"{sentence(i, 12)} ask Zorbax at joe@mail.example.com {sentence(i + 50, 12)}") for i in range(5)]
    rows = [*near, (20, "Zorbax alone"), (21, "nothing here"), (22, None), (22, None), (23, "mail at at at")]
    found = {r.doc_id: r for r in pii.digests(pii.spans(frame(spark, rows))).collect()}
    assert found[20].spans == "term:0:6" and found[21].spans == "" and found[22].n_email == 0
    assert found[0].n_email == 1 and "term" in found[0].spans
    assert found[0].base_sha256 == hashlib.sha256(pii.joined(plain_spans(near[0][1])).encode()).hexdigest()
    clean = {r.doc_id: r for r in pii.sanitised(frame(spark, rows)).collect()}
    assert "joe" not in clean[0].text and "Zorbax" not in clean[20].text and clean[22].text is None
    assert clean[21].text == "nothing here" and clean[20].n_chars == len(clean[20].text)
    every = pii.sanitised(frame(spark))
    assert ids(every.collect()) == IDS and every.columns == frame(spark).columns
    assert pii.digests(pii.spans(frame(spark, []))).collect() == []


def test_terms_beside_several_entities(spark):
    block = "Quonk Zorbax: jz@mail.example.com, +15551234567, 10.0.0.1"
    near = [(i, f"{sentence(i, 12)} {block} {sentence(i + 50, 12)}") for i in range(5)]
    found = {r.doc_id: r for r in pii.digests(pii.spans(frame(spark, [*near, (20, "Zorbax alone")]))).collect()}
    assert found[20].spans == "term:0:6" and all(found[i].n_term == 2 for i in range(5))
    # two occurrences near one mention are both near; one occurrence near two mentions is one
    twice = [(i, f"{sentence(i, 12)} Zorbax, Zorbax joe@mail.example.com {sentence(i + 50, 12)}") for i in range(5)]
    assert [r.n_term for r in pii.digests(pii.spans(frame(spark, twice))).collect()] == [2] * 5
    between = [(i, f"{sentence(i, 12)} joe@mail.example.com Zorbax joe@mail.example.com {sentence(i + 50, 12)}") for i in range(5)]
    between += [(20 + i, "Zorbax alone") for i in range(6)]
    assert not any(r.n_term for r in pii.digests(pii.spans(frame(spark, between))).collect())


def test_terms_in_their_own_address(spark):
    near = [(i, f"{sentence(i, 12)} ask Zorbax at zorbax@mail.example.com {sentence(i + 50, 12)}") for i in range(5)]
    docs = frame(spark, [*near, (20, "Zorbax alone")])
    found = {r.doc_id: r for r in pii.digests(pii.spans(docs)).collect()}
    assert found[20].spans == "term:0:6" and all(found[i].n_term == 2 for i in range(5))  # Zorbax and ask
    clean = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    assert clean[20] == " alone" and not any("zorbax" in t.lower() for t in clean.values())
    # a run of letters that goes on into a span, and another span's letters, are not near
    text = "ééé@ ééézorbax@mail.example.com or other@mail.example.com"
    terms = {r["term"] for r in pii._near(text, pii.find(text))}
    assert terms == {"ééé"}


def test_fingerprints(spark):
    rows = sorted((r for r in texts() if r[0] is not None and r[0] != 11), key=lambda r: -r[0])
    got = {r.doc_id: r for r in fingerprint.fingerprints(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    for (key, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        new = fingerprint.edited(text or "", after or "")
        assert got[key].edited_sha256 == hashlib.sha256(new.encode()).hexdigest() and got[key].n_chars == len(text or "")
        assert got[key].edited_fingerprint == fingerprint.Fingerprint().changed(fingerprint.pieces(new)).text()
    assert got[1].fingerprint == got[2].fingerprint != got[3].fingerprint and got[2].near_next == 1.0
    assert ids(fingerprint.fingerprints(frame(spark)).collect()) == IDS
    assert fingerprint.fingerprints(frame(spark, [])).collect() == []
    assert len(fingerprint.fingerprints(frame(spark, [(1, "one alone")])).collect()) == 1


@pytest.mark.parametrize("kind", ["long", "string", "date", "double", "decimal(20,3)"])
def test_next_document_over_ranges(spark, kind):
    """One key and the null key hold a third of the rows each; keys of any type; the same under two layouts."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    rows = [(i, f"text {i} " + sentence(i, 6)) for i in range(60)] + [(7, f"of seven {i}") for i in range(60)] + [(None, f"of none {i}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    made = {"date": "date_add(DATE '2024-01-01', doc_id)", "string": "concat('key ', lpad(doc_id, 3, '0'))"}.get(kind, f"CAST(doc_id AS {kind})")
    df = df.selectExpr(f"{made} AS doc_id", "text")
    order = [r.text for r in df.orderBy(F.desc_nulls_last("doc_id"), F.desc(F.xxhash64("text"))).collect()]
    after = dict(zip(order, order[1:] + order[:1]))
    found = []
    for parts in ("3", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            found.append(fingerprint.fingerprints(df.repartition(int(parts))).collect())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    by_mark = {fingerprint.Fingerprint().changed(fingerprint.pieces(t)).text(): t for t in order}
    for rows in found:
        assert len(rows) == 180
        for r in rows:
            text = by_mark[r.fingerprint]
            assert r.edited_sha256 == hashlib.sha256(fingerprint.edited(text, after[text]).encode()).hexdigest()
    assert sorted(map(repr, found[0])) == sorted(map(repr, found[1]))


def test_fingerprints_ignore_order_and_undo():
    a, b = ["one", "two", "three"], ["four"]
    mark = fingerprint.Fingerprint().changed(a)
    assert mark.text() == fingerprint.Fingerprint().changed(a[::-1]).text() == mark.changed(b).changed([], b).text()
    assert fingerprint.parsed(mark.text()).text() == mark.text()


def test_likeness_counts_each_occurrence_once():
    mark = lambda p: fingerprint.Fingerprint().changed(p)
    many, fewer, other = ["same"] * 180, ["same"] * 120, [f"x{i}" for i in range(1000)]
    assert fingerprint.likeness(mark(many), mark(fewer)) == pytest.approx(0.8, abs=0.15)
    assert fingerprint.likeness(mark(many + other), mark(many + [f"y{i}" for i in range(1000)])) == pytest.approx(0.15, abs=0.2)
    assert fingerprint.likeness(mark(["same"] * 40_000), mark(["same"] * 26_667)) == pytest.approx(0.8, abs=0.15)
    assert mark(many).changed(["same"], ["same"] * 61, ["same"] * 119).text() == mark(fewer).text()


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav>
<header>Top</header><div class="cookie-notice">We use cookies</div>%s<div id="comments"><p>First comment, which is rather long as comments go on this page.</p></div>
<aside>Side</aside><form><p>Subscribe</p></form><footer>&copy; us</footer></body></html>"""


@pytest.mark.parametrize("open_, close", [("<article>", "</article>"), ("<div id=content>", "</div>"), ("<main>", "</main>")])
def test_main_text(open_, close):
    body = f"{open_}<h1>A &amp; B</h1><p>{sentence(1, 40)}<p>No.</p><div class='ad'>Buy</div><p>{sentence(2, 40)}\n  two&nbsp;spaces<br>after</p>{close}"
    assert main_text.main_text(PAGE % body) == f"A & B\n{sentence(1, 40)}\nNo.\n{sentence(2, 40)} two spaces after"


WRAPS = ["<div class='content-sidebar-wrap'>", "<div class='layout has-sidebar'>", "<div id=page class=no-header>", "<form action=x>", "<my-app class='has-sidebar'>"]


@pytest.mark.parametrize("open_", WRAPS)
@pytest.mark.parametrize("inner", ["div", "article", "main"])
def test_main_text_in_marked_elements(open_, inner):
    end = f"</{open_[1:-1].split()[0]}>"
    body = f"<h1>A</h1><p>{sentence(1, 40)}<p>No.</p><span class=share>Share <span>it</span> now</span><p>{sentence(2, 40)}</p>"
    want = f"A\n{sentence(1, 40)}\nNo.\n{sentence(2, 40)}"
    junk = f"<div class=sidebar><p>{sentence(3, 20)}</p></div><ul><li class=promo>Buy<li class=ad><a href=x>Ad</ul>"
    assert main_text.main_text(PAGE % f"{open_}<{inner}>{body}</{inner}>{junk}{end}") == want
    # all of the page in it
    page = f"<html><body>{open_}<nav>Home</nav><{inner}>{body}</{inner}>{junk}<div id=comments><p>{sentence(4, 30)}</p></div>{end}</body></html>"
    assert main_text.main_text(page) == want


def test_main_text_beside_long_comments():
    comments = f"<div id=comments>{''.join(f'<p>{sentence(i, 40)}</p>' for i in range(10, 15))}</div>"
    cards = f"<section class=related><article><p>{sentence(5, 10)}</p></article></section>"
    article = f"<article><p>{sentence(1, 60)}</p><p>{sentence(2, 60)}</p></article>"
    want = f"{sentence(1, 60)}\n{sentence(2, 60)}"
    assert main_text.main_text(PAGE % (article + comments + cards)) == want
    assert main_text.main_text(PAGE % f"<div class=has-sidebar>{article}{comments}{cards}</div>") == want
    # an article in several marked parts
    parts = [f"<section class='story share-{i}'><p>{sentence(i, 60)}</p></section>" for i in range(4)]
    assert main_text.main_text(f"<html><body>{''.join(parts)}</body></html>") == "\n".join(sentence(i, 60) for i in range(4))


def test_pages_of_all_kinds(spark):
    rows = [(1, "u", None), (1, None, ""), (None, "u", "plain words"), (2, "u", "<p>unclosed <b>one"), (3, "u", "<<<>>> <a \"" * 3000), (4, "u", "<!--")]
    told = main_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert [(r.page_id, r.url) for r in told] == [(a, b) for a, b, _ in rows] and [r.text for r in told[:4]] == ["", "", "plain words", "unclosed one"]
    assert all(r.n_chars == len(r.text) for r in told)


def test_decontamination(spark):
    item = sentence(70, 40)
    words = item.split()
    words[7], words[20] = "edited", "edited too"
    rows = [*texts(), (50, sentence(71, 200) + " " + item + " " + sentence(72, 50)), (51, " ".join(words).upper()), (52, " ".join(item.split()[:5])), (50, None)]
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, "two words"), (4, "")], "item_id long, text string")
    told = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(frame(spark, rows), bench).collect()}
    assert set(told) == {(50, 1), (51, 1)} and told[50, 1].score == 1.0
    assert (told[50, 1].start_word, told[50, 1].end_word) == (200, 240)
    assert decontaminate.contaminated(frame(spark), bench.where("false")).collect() == []
    assert decontaminate.contaminated(frame(spark, []), bench).collect() == []


def test_decontamination_of_short_edited_and_long_items(spark):
    short, item, long = "qui zor tam", sentence(70, 40), sentence(73, 300)
    third, inserted, left_out = item.split(), item.split(), item.split()
    third[2::3] = [f"x{i}" for i in range(len(third[2::3]))]
    for i in reversed(range(2, 40, 2)):
        inserted.insert(i, f"y{i}")
    del left_out[2::5]
    rows = [*((i, f"{sentence(i, 30)} {short} {sentence(i + 20, 30)}") for i in range(100, 104)), (110, " ".join(third)), (111, " ".join(inserted))]
    rows += [(112, " ".join(left_out)), (113, " ".join(long.split()[100:220])), (114, " ".join(long.split()[:10])), (115, "qui zor other tam words")]
    bench = spark.createDataFrame([(1, short), (2, item), (3, long), *((i, f"{short} {sentence(i, 90)}") for i in range(200, 270))], "item_id long, text string")
    told = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(frame(spark, [*rows, *texts()]), bench).collect()}
    assert set(told) == {*((i, 1) for i in range(100, 104)), (110, 2), (111, 2), (112, 2), (113, 3), (115, 1)}
    assert told[100, 1] == 1.0 and 0.5 <= told[110, 2] < 0.56 and told[113, 3] == 0.4


def test_alignment_equals_plain_recursion():
    draw = np.random.default_rng(6)
    for _ in range(50):
        a, b = draw.integers(0, 4, draw.integers(1, 9)), draw.integers(0, 4, draw.integers(1, 12))
        cells = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                cells[i, j] = max(0, cells[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), cells[i - 1, j] - 1, cells[i, j - 1] - 1)
        assert decontaminate.align(a, b)[0] == cells.max()


def test_contaminated_documents_without_an_id_are_dropped(spark, tmp_path):
    item = sentence(70, 40)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, f"{item} {sentence(71)}"), (None, sentence(72)), (None, None), (5, item), (6, sentence(73)), (7, None)]
    kept = corpus_pipeline.decontaminated(spark, frame(spark, rows), str(tmp_path))
    assert kept.columns == frame(spark, rows).columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([rows[1], rows[2], rows[4], rows[5]], key=repr)


def test_bound_of_alignment():
    draw = np.random.default_rng(7)
    for _ in range(300):
        a, b = draw.integers(0, 9, draw.integers(1, 20)), draw.integers(0, 9, draw.integers(1, 9))
        assert decontaminate.bound(a, b) >= decontaminate.align(a, b)[0]


def test_quality(spark):
    good = [(i, sentence(i, 50).capitalize() + ".", f"g{i % 2}") for i in range(60)]
    bad = [(100 + i, "|".join(sentence(i, 50).upper().split()) + "###", "b") for i in range(60)]
    docs = spark.createDataFrame([*good, *bad, (500, None, None), (None, "x y", "g0"), (500, None, None)], "doc_id long, text string, source string")
    labels = spark.createDataFrame([*((i, 1) for i in range(40)), *((100 + i, 0) for i in range(40)), (0, 0), (0, 1), (None, 1), (7, None)], "doc_id long, quality int")
    told = quality.score(docs, labels, F.col("source"), F.lit("p")).collect()
    assert len(told) == 123 and all(0 <= r.score <= 1 for r in told)
    assert all(r.keep for r in told if r.doc_id is not None and r.doc_id < 60) and not any(r.keep for r in told if 100 <= (r.doc_id or 0) < 200)
    assert len(quality.score(docs, labels.where("false"), F.col("source"), F.lit("p")).collect()) == 123
    assert quality.score(docs.where("false"), labels, F.col("source"), F.lit("p")).collect() == []


def test_mixing(spark):
    rows = [*texts(), *((100 + i, sentence(i, 30)) for i in range(60))]
    docs = frame(spark, rows).withColumn("source", F.expr("CASE WHEN doc_id >= 140 THEN 'big' ELSE source END"))
    told = mixing.mix(docs, repeat=2.0, block_tokens=500).collect()
    uses = Counter(r.doc_id for r in told if r.doc_id is not None)
    assert set(uses) == {i for i, _ in rows if i is not None} and max(r.repeats or 0 for r in told) <= 2.00001
    by_block = Counter()
    for r in told:
        by_block[r.block] += r.n_tokens
    assert mixing.mix(docs.where("false")).collect() == []
    plenty = mixing.mix(docs, repeat=None, entropy=1.2, block_tokens=500)
    weights = {r.source: r.weight for r in plenty.collect() if r.weight}
    assert -sum(w * math.log(w) for w in weights.values()) >= 1.2 - 1e-6


def test_shortlist_does_not_depend_on_the_layout(spark):
    """Words that occur once in each of many blocks are as frequent as those of one block."""
    rows = [(i, sentence(500, 40)) for i in range(40)] + [(100 + i, sentence(600 + i, 30)) for i in range(8)]
    known = []
    for parts in (1, 40):
        scored = lm_score.score(frame(spark, rows).repartition(parts, "doc_id"), F.col("doc_id") >= 100)
        known.append({r.doc_id: (r.n_known, r.train_tokens, round(r.base_score, 9)) for r in scored.collect()})
    assert known[0] == known[1]
    vocabulary = Counter(w for i, t in rows if i < 100 for w in t.split())
    assert max(vocabulary.values()) >= 40
    # words of the shortlist are told apart from their bucket, so a frequent word scores above a rare one under any layout
    common_text, rare = " ".join(w for w, n in vocabulary.most_common(5)), " ".join(sentence(999, 5).split())
    for parts in (1, 40):
        scored = lm_score.score(frame(spark, [*rows, (200, common_text), (201, rare)]).repartition(parts, "doc_id"), F.col("doc_id") >= 100)
        by_id = {r.doc_id: r.score for r in scored.collect()}
        assert by_id[200] > by_id[201]


@pytest.mark.parametrize("text", ["\u00bd \u00b2", "\u2167 12", "\u0301 \u093e", "123 .,", "", None])
def test_texts_without_a_letter_have_no_language(text):
    told = language.Sizes({"aa": b"the and of to in with from" * 4, "bb": b"der die und nicht mit von zu" * 4})
    assert told.predict(text) == ("und", 0.0)


def test_marks_stay_with_their_letters():
    assert language.letters("\u0939\u093f\u0928\u094d\u0926\u0940 2x") == "\u0939\u093f\u0928\u094d\u0926\u0940 x".encode()


def test_a_number_is_one_entity_however_it_is_written(spark):
    card = ["4111 1111 1111 1111", "4111-1111-1111-1111"]
    rows = [(i, f"{sentence(i, 6)} Zorbax {card[i % 2]} {sentence(50 + i, 6)}") for i in range(8)] + [(90, f"{sentence(90, 9)} Zorbax {sentence(91, 9)}")]
    told = pii.digests(pii.spans(frame(spark, rows))).where("doc_id = 90").first()
    assert "term" in told.spans
    assert pii.entity_of("phone", "+1 (555) 123-4567") == pii.entity_of("phone", "+15551234567")
    assert pii.entity_of("email", "A@B.org") == pii.entity_of("email", "a@b.ORG")


def test_mixing_of_rows_without_a_key(spark):
    """Blocks are the same under two layouts."""
    rows = [(None, f"text {i} " + sentence(i, 20)) for i in range(40)] + [(5, sentence(70 + i, 9)) for i in range(10)]
    mixed = [
        sorted(map(repr, mixing.mix(frame(spark, rows).repartition(n), block_tokens=64).collect())) for n in (1, 9)
    ]
    assert mixed[0] == mixed[1] and len({r.split("place=")[1][:40] for r in mixed[0]}) > 40


def test_alignment_in_windows():
    """A copy anywhere in a very long passage is found with its score and place."""
    draw = np.random.default_rng(3)
    item = draw.integers(0, 1 << 40, 60)
    for at in (0, 4000, 4090, 8190, 99_940):
        words = draw.integers(0, 1 << 40, 100_000)
        words[at : at + 60] = item
        words[at + 30] = 0
        assert decontaminate.align(item, words) == (2 * 59 - 1, at, at + 60)
    words = draw.integers(0, 1 << 40, 1_000_000)
    words[500_000 : 500_060] = item
    assert decontaminate.align(item, words) == (120, 500_000, 500_060)
