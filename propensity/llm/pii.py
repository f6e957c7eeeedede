"""Personal data: patterns for four kinds, and terms that give such data away.

The patterns find e-mail addresses, IP addresses, card and phone numbers (``find``). Each different value is an entity. A
term (a lower-case run of three or more letters) near an entity says something about it. Over the whole corpus,
P(entity | term) is estimated by the share of the term's occurrences that lie within ``WINDOW`` words of the entity. A term
discloses an entity if that share reaches ``DISCLOSES`` and the two occur together in ``SUPPORT`` different contexts (so copies of
one passage prove nothing). Every occurrence of a disclosing term is a span of kind ``term``; it is removed if the
share reaches ``REMOVES``, else generalised to a placeholder.

Both counts come from shuffles of (term, entity) and of (term, place). An occurrence counts once for each entity it is near,
however many mentions of it are, and once in the total. Matches that overlap a base span are no occurrences: they are
replaced with the span. Terms whose occurrences near any entity are already too many
for the share are left out before all their occurrences are searched; the search is by a bit array of fixed size and checked by a join.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from propensity.llm import common
from propensity.session import materialize

KINDS = ("email", "ip", "card", "phone")
WINDOW = 4
#: Characters read on either side of an entity to find the words of its window.
REACH = 160
SUPPORT = 3
DISCLOSES = 0.5
REMOVES = 0.8

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# A match that fails at the start of a run of digits fails inside it as well.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TERM = re.compile(r"[^\W\d_]{3,}")
_NO_DIGIT = re.compile(r"[^0-9]+")
_LETTER = re.compile(r"[^\W\d_]")
_WORD = re.compile(r"\S+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Found from each @ outwards, as a scan from every letter is quadratic in long words."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            yield start, domain.end()
        # without a match, the next one starts after this @
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind; code points, end exclusive."""
    found = [("email", *span) for span in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                found.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            # longer matches can't be cards; their digits are not gathered
            digits = re.sub("[^0-9]", "", m.group()) if m.end() - m.start() < 40 else ""
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append(("card", m.start(), m.end()))
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m.group())) <= 15:
                found.append(("phone", m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def around(text: str, start: int, end: int) -> list[tuple[str, int, int]]:
    """Terms of the WINDOW words before and after a span, with start and end; words cut off by REACH are left out."""
    low, high = max(0, start - REACH), min(len(text), end + REACH)
    before, after = list(_WORD.finditer(text, low, start)), list(_WORD.finditer(text, end, high))
    if low and before and before[0].start() == low and not text[low - 1].isspace():
        before = before[1:]
    if high < len(text) and after and after[-1].end() == high and not text[high].isspace():
        after = after[:-1]
    return [(m.group().lower(), *m.span()) for w in (*before[-WINDOW:], *after[:WINDOW]) for m in _TERM.finditer(text, *w.span())]


def _hash(text: str) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(text)).astype(np.int64))


def _merged(spans: list[tuple[str, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the base spans, overlapping ones as one."""
    starts, ends = [], []
    for _, a, b in spans:
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def _outside(starts: list[int], ends: list[int], start: int, end: int) -> bool:
    """Whether a match overlaps none of the merged spans."""
    i = bisect_right(ends, start)
    return i == len(ends) or end <= starts[i]


def entity_of(kind: str, written: str) -> str:
    """The address or number itself, however it is written: digits of cards and phones, lower-case addresses."""
    return f"{kind}:" + (_NO_DIGIT.sub("", written) if kind in ("card", "phone") else written.lower())


def _near(text: str, spans: list[tuple[str, int, int]]) -> list[dict]:
    rows, seen = [], set()
    merged = _merged(spans)
    for k, a, b in spans:
        terms = around(text, a, b)
        entity, context = _hash(entity_of(k, text[a:b])), _hash(" ".join(t for t, _, _ in terms))
        # a run of letters that the span cuts is one match with letters of the span
        cut = {a if _LETTER.match(text, a) else None, b if _LETTER.match(text, b - 1) else None}
        terms = [(t, at) for t, at, end in terms if at not in cut and end not in cut and _outside(*merged, at, end)]
        times = dict.fromkeys(sorted({t for t, _ in terms}), 0)
        for t, at in terms:
            times[t] += (entity, at) not in seen
            seen.add((entity, at))
        rows += [{"entity": entity, "term": t, "context": context, "times": n} for t, n in times.items()]
        anywhere = Counter(t for t, at in terms if (None, at) not in seen)
        seen.update((None, at) for _, at in terms)
        rows += [{"entity": None, "term": t, "context": None, "times": n} for t, n in anywhere.items()]
    return rows


def _base(docs: DataFrame) -> DataFrame:
    """Each row's base spans, and the terms around them: how many occurrences a mention adds to those of its entity.

    A null entity stands for any: the term's occurrences near one or more.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    near = pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.string()), ("context", pa.int64()), ("times", pa.int64())]))

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            places, starts, ends, kinds, nears = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                spans = find(text)
                places.append(_hash(text))
                kinds.append([k for k, _, _ in spans])
                starts.append([a for _, a, _ in spans])
                ends.append([b for _, _, b in spans])
                nears.append(_near(text, spans))
            columns = [batch.column(0), pa.array(places, pa.int64()), pa.array(kinds, pa.list_(pa.string()))]
            columns += [pa.array(starts, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64())), pa.array(nears, near)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "place", "kinds", "starts", "ends", "near"])

    schema = f"doc_id {kind}, place long, kinds array<string>, starts array<long>, ends array<long>"
    return common.in_batches(docs, run, schema + ", near array<struct<entity: long, term: string, context: long, times: long>>")


def _occurrences(docs: DataFrame, wanted) -> DataFrame:
    """(doc_id, place, term, start, end) of each occurrence of the wanted terms, outside base spans, and, rarely, of others."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                terms = list({t.lower() for t in _TERM.findall(text or "")})
                hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64, len(terms))
                here = {terms[i] for i in np.flatnonzero(common.maybe_in(wanted.value, hashes))}
                if here:
                    place, merged = _hash(text), _merged(find(text))
                    found = ((m, m.group().lower()) for m in _TERM.finditer(text))
                    rows += [(doc, place, t, m.start(), m.end()) for m, t in found if t in here and _outside(*merged, *m.span())]
            types = [batch.column(0).type, pa.int64(), pa.string(), pa.int64(), pa.int64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, types)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "place", "term", "start", "end"])

    return common.in_batches(docs, run, f"doc_id {kind}, place long, term string, start long, end long")


def _disclosing(docs: DataFrame, base: DataFrame) -> DataFrame:
    """(doc_id, place, terms): spans of disclosing terms and whether to remove them, by row."""
    near = base.select(F.explode("near").alias("n")).select("n.*")
    # first by context, so that neither copies nor a frequent term meet in one task
    pairs = near.groupBy("entity", "term", "context").agg(F.sum("times").alias("times"))
    pairs = pairs.groupBy("entity", "term").agg(F.sum("times").alias("times"), F.count("*").alias("contexts"))
    pairs = materialize(pairs, "pairs")
    # a term's occurrences near any entity are not more than all of them
    apart = pairs.where("entity is null").select("term", F.col("times").alias("any"))
    likely = pairs.where("entity is not null").where(F.col("contexts") >= SUPPORT)
    likely = likely.join(apart, "term").where(F.col("times") >= DISCLOSES * F.col("any"))
    likely = materialize(likely.groupBy("term").agg(F.max("times").alias("times")), "likely")

    def hash_terms(batches: Iterator) -> Iterator:
        for batch in batches:
            hashes = [_hash(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64())], ["h"])

    wanted = common.filter_bits(common.in_batches(likely.select("term"), hash_terms, "h long"), "h")
    shared = docs.sparkSession.sparkContext.broadcast(wanted)
    found = materialize(_occurrences(docs, shared), "occurrences").join(likely, "term")
    totals = found.groupBy("term", "times").agg(F.count("*").alias("total"))
    share = F.col("times") / F.col("total")
    telling = totals.where(share >= DISCLOSES).select("term", (share >= REMOVES).alias("remove"))
    spans = found.join(telling, "term").select("doc_id", "place", F.struct("start", "end", "remove").alias("span"))
    return materialize(spans.groupBy("doc_id", "place").agg(F.sort_array(F.collect_set("span")).alias("terms")), "disclosing")


def _narrow(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))


def spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, kinds, starts, ends, terms) of every row: base spans as three arrays, and disclosing terms.

    ``terms`` is an array of (start, end, remove), null where there are none. Null texts are empty. Repeated rows repeat; each
    counts as an occurrence, but not as another context. Null keys are kept. Other columns are ignored.
    """
    docs = _narrow(docs, key, text)
    base = materialize(_base(docs), "base")
    terms = _disclosing(docs, base)
    # a written table: Spark broadcasts it if its size allows
    same = base["doc_id"].eqNullSafe(terms["doc_id"]) & (base["place"] == terms["place"])
    return base.join(terms, same, "left").select(base["doc_id"], "kinds", "starts", "ends", "terms")


def digests(found: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term) from ``spans``."""
    kind = found.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            rows = []
            for kinds, starts, ends, terms in zip(*(c.to_pylist() for c in batch.columns[1:])):
                base = list(zip(kinds, starts, ends))
                more = _clear(base, terms)
                every = sorted(base + [("term", a, b) for a, b, _ in more], key=lambda s: (s[1], (*KINDS, "term").index(s[0])))
                sha = hashlib.sha256(joined(base).encode()).hexdigest()
                rows.append((*(kinds.count(k) for k in KINDS), sha, joined(every), len(more)))
            types = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 7, types)]
            names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_term"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    schema = f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_term long"
    return common.in_batches(found, run, schema)


def _clear(base: list[tuple], terms: list[dict] | None) -> list[tuple[int, int, bool]]:
    """Terms that overlap no base span."""
    out, i, last = [], 0, -1
    for t in terms or ():
        while i < len(base) and base[i][1] < t["end"]:
            last, i = max(last, base[i][2]), i + 1
        if last <= t["start"]:
            out.append((t["start"], t["end"], t["remove"]))
    return out


def cleaned(text: str, base: list[tuple], terms: list[dict] | None) -> str:
    """The text with placeholders for base spans (overlapping ones as one) and terms, or nothing for removed terms."""
    marks = [(a, b, f"<{k.upper()}>") for k, a, b in base]
    marks += [(a, b, "" if remove else "<TERM>") for a, b, remove in _clear(base, terms)]
    out, at = [], 0
    for a, b, new in sorted(marks):
        if a >= at:
            out += [text[at:a], new]
        at = max(at, b)
    return "".join([*out, text[at:]])


def sanitised(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with cleaned texts; all rows and all columns stay, a null text stays null.

    A column ``n_chars``, if there is one, is the length of the new text. Only rows with disclosing terms are looked up.
    """
    narrow = _narrow(docs, key, text)
    terms = _disclosing(narrow, materialize(_base(narrow), "base"))
    place, names, schema = docs.columns.index(text), docs.columns, docs.schema

    def hash_places(batches: Iterator) -> Iterator:
        for batch in batches:
            hashes = [None if t is None else _hash(t) for t in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hashes, pa.int64())], [*names, "place of text"])

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            found = batch.column(batch.num_columns - 1).to_pylist()
            new = [None if t is None else cleaned(t, find(t), m) for t, m in zip(batch.column(place).to_pylist(), found)]
            columns = list(batch.columns[:-1])
            columns[place] = pa.array(new, columns[place].type)
            if "n_chars" in names:
                at = names.index("n_chars")
                columns[at] = pa.array([None if t is None else len(t) for t in new], columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    placed = common.in_batches(docs, hash_places, f"{fields}, `place of text` long")
    right = terms.select(F.col("doc_id").alias("key of terms"), F.col("place").alias("place of terms"), F.col("terms").alias("terms found"))
    same = placed[key].eqNullSafe(right["key of terms"]) & (placed["place of text"] == right["place of terms"])
    both = placed.join(right, same, "left").select(*(placed[f"`{n}`"] for n in names), "terms found")
    return common.in_batches(both, run, schema)
