"""Fill-in-the-middle texts by one counted match a document.

A text is a run of ``unit``s, words with the white space before them. ``regexp_count`` gives their number n; two hashes of the
key choose where the middle starts and ends, after a and b units. The pattern of a row then is

    (unit{a}) (unit{b-a}) (the rest)

and one ``regexp_replace`` with it moves the three groups behind their marks. The counted groups are possessive: what a
unit took is never given back, so the match is a loop without a stack of its own, however many units a text has.

All of it is column functions of the JVM; rows are independent, and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Blanks and the word after them, or blanks that end the text.
UNIT = r"(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_MARKS = f"{PREFIX}|{SUFFIX}|{MIDDLE}"
_OUTPUTS = {"psm": f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2", "spm": f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"}


def _draws(key: Column, seed: int) -> list[Column]:
    """Four numbers of 32 bits from the key's sha256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(
    docs: DataFrame, key: str = "doc_id", text: str = "text", changed_percent: int = 50, spm_percent: int = 80, seed: int = 42
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row; the same in every run and partitioning.

    ``form`` is plain for ``100 - changed_percent`` percent of texts, for empty ones and for those that hold a mark themselves;
    of the others ``spm_percent`` are spm (suffix first), the rest psm. Lengths are code points, null if plain.
    A null text is empty, a null key counts as an empty one. Repeated rows repeat, rows of one key share their draws. Other columns are ignored.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("doc_id"), whole.alias("text"))
    rows = rows.withColumn("n", F.regexp_count("text", F.lit(UNIT)).cast("long"))
    one, two, three, four = _draws(F.col("doc_id"), seed)
    ends = [F.pmod(draw, F.col("n") + 1) for draw in (one, two)]
    plain = (F.col("n") == 0) | F.col("text").rlike(_MARKS) | (F.pmod(three, F.lit(100)) >= changed_percent)
    form = F.when(plain, "plain").when(F.pmod(four, F.lit(100)) < spm_percent, "spm").otherwise("psm")
    rows = rows.select("*", form.alias("form"), F.least(*ends).alias("a"), F.greatest(*ends).alias("b"))
    pattern = F.concat(
        F.lit(rf"(?s)\A({UNIT}{{"), F.col("a"), F.lit(rf"}}+)({UNIT}{{"), F.col("b") - F.col("a"), F.lit(r"}+)(.*+)\z")
    )
    moved = {name: F.regexp_replace("text", pattern, F.lit(order)) for name, order in _OUTPUTS.items()}
    output = F.when(F.col("form") == "psm", moved["psm"]).when(F.col("form") == "spm", moved["spm"]).otherwise(F.col("text"))
    rows = rows.select("doc_id", "n", "form", output.alias("output"))
    prefix, middle, _ = parts(F.col("output"), F.col("form"))
    return rows.select("doc_id", "n", "form", F.length(prefix).alias("prefix_chars"), F.length(middle).alias("middle_chars"), "output").withColumns(
        {name: F.col(name).cast("long") for name in ("prefix_chars", "middle_chars")}
    )


def parts(output: Column, form: Column) -> tuple[Column, Column, Column]:
    """Prefix, middle and suffix of an output; null if it is plain.

    Only texts without a mark are changed, and no mark ends as another begins: the three marks in an output are ours.
    """
    pieces = F.when(form != "plain", F.split(output, _MARKS, -1))
    first, second, last = (F.get(pieces, F.lit(i)) for i in (1, 2, 3))
    spm = form == "spm"
    return F.when(spm, second).otherwise(first), last, F.when(spm, first).otherwise(second)


def restore(output: Column, form: Column) -> Column:
    """The exact text an output was made from."""
    return F.when(form == "plain", output).otherwise(F.concat(*[parts(output, form)[i] for i in (0, 1, 2)]))


def digests(rows: DataFrame) -> DataFrame:
    """The rows of ``transform`` with hashes in place of the texts."""
    restored = restore(F.col("output"), F.col("form"))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256")
    )
