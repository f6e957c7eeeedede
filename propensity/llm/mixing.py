"""Mix sources to target weights by temperature, and deal the documents into blocks. DataFrame operations only.

A source with the share p of all tokens gets the weight p^a / sum of p^a. With a = 1 sources keep their shares, with a = 0 all
weigh alike. The exponent a is bisected to the smallest at which no source is repeated more than ``repeat`` times as often as the
least repeated one, or to the one at which the weights have a given entropy (``exponent``).

The budget is such that every document is used at least once: the source with the lowest ratio of weight to share goes
round once, the others more often; the last round of a source is cut where its budget of tokens ends. Each round of
a source is a permutation by a seeded hash. A document's place in its source's budget, as a fraction, names its block, so that each block
holds every source's weight of its tokens; within a block the order is a hash again.

No window holds a source: tokens are summed by hash slices of each round of a source, slices are cumulated, and rows only
within their slice. The number of slices grows with the rows; the result does not depend on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from propensity.session import materialize

STEPS = 40
DIGITS = 9
#: Rows of a slice, on average.
SLICE_ROWS = 4096
SEED = "mix"


def tokens(text) -> F.Column:
    """Words of a text; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def exponent(shares: DataFrame, repeat: float | None = None, entropy: float | None = None) -> DataFrame:
    """One row (a): the exponent for ``shares`` (share > 0, one row a source), by STEPS bisections between 0 and 1.

    With ``repeat``: the smallest a with (largest share / smallest share)^(1 - a) <= repeat. With ``entropy`` (nats): the largest a
    whose weights have at least that entropy (0 if none has, 1 if the shares themselves have).
    """
    if repeat is not None:
        row = shares.agg((F.max("share") / F.min("share")).alias("spread"))
        fits = F.pow(F.col("spread"), 1 - (F.col("b.low") + F.col("b.high")) / 2) <= repeat
        sides = F.when(fits, F.struct(F.col("b.low"), ((F.col("b.low") + F.col("b.high")) / 2).alias("high")))
        sides = sides.otherwise(F.struct(((F.col("b.low") + F.col("b.high")) / 2).alias("low"), F.col("b.high")))
        row = row.withColumn("b", F.struct(F.lit(0.0).alias("low"), F.lit(1.0).alias("high")))
        for _ in range(STEPS):
            row = row.withColumn("b", sides)
        return row.select(F.round("b.high", DIGITS).alias("a"))
    low, high = 0.0, 1.0
    for _ in range(STEPS):
        middle = (low + high) / 2
        power = F.pow(F.col("share"), F.lit(middle))
        total, weighted = shares.agg(F.sum(power), F.sum(power * F.log("share"))).first()
        # entropy of w = p^a / Z is log Z - a mean(log p)
        enough = shares.select(F.lit(total)).isEmpty() or _entropy(total, weighted, middle) >= entropy
        low, high = (middle, high) if enough else (low, middle)
    return shares.sparkSession.range(1).select(F.round(F.lit(high), DIGITS).alias("a"))


def _entropy(total: float, weighted: float, a: float) -> float:
    import math

    return math.log(total) - a * weighted / total


def weights(docs: DataFrame, repeat: float | None = None, entropy: float | None = None, block_tokens: int = 1 << 20) -> DataFrame:
    """(source, tokens, weight, repeats, blocks) of each source with tokens, from (source, n) rows; null is a source."""
    sums = docs.groupBy("source").agg(F.sum("n").alias("tokens")).where("tokens > 0")
    sums = materialize(sums, "sources")
    total = sums.agg(F.sum("tokens").alias("all"))  # one row
    shares = sums.join(F.broadcast(total)).withColumn("share", F.col("tokens") / F.col("all")).drop("all")
    raised = shares.join(F.broadcast(exponent(shares, repeat, entropy))).withColumn("power", F.pow("share", "a"))
    norm = raised.agg(F.sum("power").alias("norm"), F.min(F.col("power") / F.col("share")).alias("least"))  # one row
    told = raised.join(F.broadcast(norm))
    told = told.select(
        "source",
        "tokens",
        F.round(F.col("power") / F.col("norm"), DIGITS).alias("weight"),
        F.round(F.col("power") / F.col("share") / F.col("least"), 6).alias("repeats"),
    )
    budget = told.agg(F.ceil(F.sum(F.col("tokens") * F.col("repeats")) / block_tokens).alias("blocks"))  # one row
    return materialize(told.join(F.broadcast(budget)), "weights")


def mix(
    docs: DataFrame, repeat: float | None = 4.0, entropy: float | None = None, block_tokens: int = 1 << 20, key: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """(doc_id, source, round, block, place, n_tokens, weight, repeats): each use of each document, dealt into blocks.

    ``place`` orders the uses of a block. Documents without tokens (null texts too) use no budget: they come once, in round 0 and block
    0, with a null weight and no repeats. A null source is a source. Repeated rows are documents of their own; equal hashes go by
    key and rows of one key by a hash of the text, so that equal rows alone may change places; rows without a key are told by that hash. Other columns are ignored.
    """
    rows = docs.select(
        F.col(key).alias("doc_id"), F.col(source).cast("string").alias("source"), tokens(F.col(text)).alias("n"), F.xxhash64(F.col(text).cast("string")).alias("h")
    )
    rows = materialize(rows, "tokens")
    of = weights(rows, repeat, entropy, block_tokens)
    slices = max(1, -(-rows.count() // SLICE_ROWS))
    known = of.select(F.col("source").alias("named"), "tokens", "weight", "repeats", "blocks")
    used = rows.where("n > 0")
    # one row a source: Spark broadcasts the written table where its size allows, and splits skewed sources where not
    used = used.join(known, used["source"].eqNullSafe(known["named"])).drop("named")
    used = used.withColumn("round", F.explode(F.sequence(F.lit(0), (F.ceil("repeats") - 1).cast("int"))))
    text_key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("#"), F.coalesce("h", F.lit(0)).cast("string")))
    used = used.withColumn("rank", F.md5(F.concat_ws(":", F.lit(SEED), "round", text_key).cast("binary")))
    # hexadecimal digits in order: slices are ranges of ranks
    used = used.withColumn("slice", F.floor(F.conv(F.substring("rank", 1, 8), 16, 10).cast("long") * slices / F.lit(1 << 32)).cast("long"))
    sums = used.groupBy("source", "round", "slice").agg(F.sum("n").alias("held"))
    earlier = Window.partitionBy("source", "round").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("held").over(earlier), F.lit(0)))
    sums = sums.select(F.col("source").alias("s"), F.col("round").alias("r"), F.col("slice").alias("c"), "before")
    within = Window.partitionBy("source", "round", "slice").orderBy("rank", "doc_id", "h").rowsBetween(Window.unboundedPreceding, -1)
    used = used.withColumn("inside", F.coalesce(F.sum("n").over(within), F.lit(0)))
    same = used["source"].eqNullSafe(sums["s"]) & (used["round"] == sums["r"]) & (used["slice"] == sums["c"])
    placed = used.join(sums, same).withColumn("at", F.col("round") * F.col("tokens") + F.col("before") + F.col("inside"))
    share = F.col("at") / (F.col("tokens") * F.col("repeats"))
    block = F.least(F.floor(share * F.col("blocks")), F.col("blocks") - 1).cast("long")
    place = F.md5(F.concat_ws(":", F.lit(SEED), F.lit("place"), "round", text_key).cast("binary"))
    dealt = placed.where(F.col("at") < F.col("tokens") * F.col("repeats")).select(
        "doc_id", "source", "round", block.alias("block"), place.alias("place"), F.col("n").alias("n_tokens"), "weight", "repeats"
    )
    idle = rows.where("n = 0").select(
        "doc_id", "source", F.lit(0).alias("round"), F.lit(0).cast("long").alias("block"),
        F.md5(F.concat_ws(":", F.lit(SEED), F.lit("place"), F.lit(0), text_key).cast("binary")).alias("place"),
        F.col("n").alias("n_tokens"), F.lit(None).cast("double").alias("weight"), F.lit(None).cast("double").alias("repeats"),
    )
    return dealt.unionByName(idle)
