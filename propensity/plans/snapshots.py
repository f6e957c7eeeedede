"""Feature rows at many cut-offs from one reduction of the events by slices of time.

All cut-offs and the edges of their windows, in order, cut time into slices; every window of every cut-off is a run of whole slices. Events
are reduced once by user and slice, whatever the number of cut-offs. What adds up is kept as running sums over a user's slices, so that a
window is the difference of two of them; the latest times are running maxima. Distinct campaigns and days count in the slice of their
first event, and clicks are states that merge. A user has at most one row per slice, and these are searched, not scanned, for the few
edges of each cut-off.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T
from pyspark.sql.internal import InternalFunction

from propensity.functions.scalars import DAY, only
from propensity.operators import clicks as gaps, conversions as bought, traffic as ads
from propensity.operators.cutoffs import HORIZONS
from propensity.session import require_utc
from propensity.sources.tables import CONVERSIONS, TRAFFIC, conform

_SECOND = 1_000_000
_UPTO = (Window.unboundedPreceding, Window.currentRow)
_EXACT = "decimal(38,0)"
#: Running sums of the traffic, running maxima, and running sums of the orders.
_SUMS = ("n_sp", "n_sb", "impressions", "no_impressions", "clicks", "no_clicks", "sp_impressions", "sp_clicks", "sb_impressions", "sb_clicks", "terms")
_FIRSTS = ("campaigns", "impression_days", "click_days")
_LATEST = ("last_event", "last_impression", "last_click")
_ORDERS = ("n_orders", "conversions", "no_conversions", "quantity", "no_quantity", "no_revenue")


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


class Slices:
    """The edges of all cut-offs in order, in microseconds, and the number of each edge."""

    def __init__(self, df: DataFrame, time_points: Sequence, horizons: Sequence[int], ts: str = "event_dt_utc"):
        require_utc(df, ts)
        self.kind, self.ts = df.schema[ts].dataType, F.col(ts)
        points = [F.lit(point).cast(self.kind) for point in time_points]
        found = df.sparkSession.sql("SELECT 1").select(*[micros(p).alias(f"p{i}") for i, p in enumerate(points)]).first()
        if None in found:
            raise ValueError(f"not a time: {time_points[list(found).index(None)]}")
        #: One literal per distinct cut-off.
        self.points = {at: point for at, point in reversed(list(zip(found, points)))}
        spans = {*horizons, *HORIZONS}
        self.edges = sorted({e for at in self.points for e in (at, at + 1, *(self.moved(at, o) for o in self._offsets(spans)))})

    @staticmethod
    def _offsets(spans) -> list[int]:
        return [o for days in spans for o in (-days * DAY, 1 - days * DAY, days * DAY)]

    @staticmethod
    def moved(at: int, seconds: int) -> int:
        """``at`` without its fraction of a second, moved by whole seconds."""
        return (at // _SECOND + seconds) * _SECOND

    def place(self, edge: int) -> int:
        """Events before ``edge`` are those of the slices up to this one."""
        return self.edges.index(edge)

    @property
    def number(self) -> Column:
        """The slice of an event: the edges at or before it. Events without a time come after all others."""
        return F.coalesce(_at_or_before(F.array(*[F.lit(e) for e in self.edges]), micros(self.ts)), F.lit(len(self.edges) + 1))


def _at_or_before(rising: Column, value: Column) -> Column:
    """How many of the rising numbers are not above ``value``."""
    found = InternalFunction.array_binary_search(rising, value)
    return F.when(found >= 0, found + 1).otherwise(-found - 1)


def _sum_of(name: str, value: Column) -> list[Column]:
    """The sum of a column's values, and how many are missing."""
    return [F.sum(F.coalesce(value, F.lit(0))).alias(name), F.count_if(value.isNull()).alias(f"no_{name}")]


def _traffic_parts(traffic: DataFrame, slices: Slices) -> DataFrame:
    """Sums by user and slice, and the first slice of every campaign and day, from one read.

    An event gives an entry to its slice, its campaign and its day; each is reduced before the shuffle.
    """
    campaign, day = F.col("campaign_id_string"), F.to_date(slices.ts)
    products, brands = ads.of_type(ads.PRODUCTS), ads.of_type(ads.BRANDS)

    def entry(kind: int, number: Column, campaign: Column, day: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), number.alias("own"), campaign.cast("string").alias("campaign"), day.cast("date").alias("day"))

    null = F.lit(None)
    entries = F.array(
        entry(0, F.col("slice"), null, null),
        F.when(products & campaign.isNotNull() & slices.ts.isNotNull(), entry(1, null.cast("int"), campaign, null)),
        F.when((F.col("impressions") > 0) | (F.col("clicks") > 0), F.when(slices.ts.isNotNull(), entry(2, null.cast("int"), null, day))),
    )
    each = traffic.withColumn("slice", slices.number).select("*", F.inline(F.array_compact(entries)))
    of_slice, shown, clicked = F.col("kind") == 0, F.col("impressions") > 0, F.col("clicks") > 0
    sp, sb = of_slice & products, of_slice & brands

    def both(rows: Column, name: str) -> list[Column]:
        return [F.sum(F.when(rows, F.coalesce(name, F.lit(0)))).alias(name), F.count_if(rows & F.col(name).isNull()).alias(f"no_{name}")]

    reduced = each.groupBy("user_id", "kind", "own", "campaign", "day").agg(
        F.count_if(sp).alias("n_sp"),
        F.count_if(sb).alias("n_sb"),
        *both(sp, "impressions"),
        *both(sp, "clicks"),
        *[F.sum(F.when(rows & (F.col(n) > 0), F.col(n))).alias(f"{tag}_{n}") for tag, rows in (("sp", sp), ("sb", sb)) for n in ("impressions", "clicks")],
        F.count(only(of_slice, F.col("customer_search_term"))).alias("terms"),
        F.max(F.when(sp, slices.ts)).alias("last_event"),
        F.max(F.when(of_slice & shown, slices.ts)).alias("last_impression"),
        F.max(F.when(of_slice & clicked, slices.ts)).alias("last_click"),
        F.min("slice").alias("first"),
        F.min(F.when(shown, F.col("slice"))).alias("first_shown"),
        F.min(F.when(clicked, F.col("slice"))).alias("first_clicked"),
    )

    def counted(name: str, number: Column) -> Column:
        return F.struct(number.alias("slice"), *[F.lit(int(n == name)).alias(n) for n in _FIRSTS])

    parts = F.array(
        F.when(of_slice, counted("", F.col("own"))),
        F.when(F.col("kind") == 1, counted("campaigns", F.col("first"))),
        F.when((F.col("kind") == 2) & F.col("first_shown").isNotNull(), counted("impression_days", F.col("first_shown"))),
        F.when((F.col("kind") == 2) & F.col("first_clicked").isNotNull(), counted("click_days", F.col("first_clicked"))),
    )
    # only the entries of slices carry sums and times
    return reduced.select("user_id", F.inline(F.array_compact(parts)), *_SUMS, *_LATEST)


def _order_parts(orders: DataFrame, slices: Slices) -> DataFrame:
    """Sums by user and slice; orders without a user or a time meet nothing."""
    known = orders.where(bought.is_order() & F.col("user_id").isNotNull() & slices.ts.isNotNull())
    revenue = F.col("total_product_sales")
    return known.groupBy("user_id", slices.number.alias("slice")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        *_sum_of("conversions", F.col("conversions")),
        F.sum(F.coalesce("total_units_sold", F.lit(0))).alias("quantity"),
        F.count_if(F.col("total_units_sold").isNull()).alias("no_quantity"),
        F.sum(F.coalesce(revenue, F.lit(0).cast(orders.schema["total_product_sales"].dataType))).alias("revenue"),
        F.count_if(revenue.isNull()).alias("no_revenue"),
    )


def _per_user(traffic: DataFrame, orders: DataFrame, slices: Slices) -> DataFrame:
    """``user_id, slices, states``: the user's slices with an event, rising, and what had happened at the end of each."""
    clicked = traffic.where((F.col("clicks") > 0) & F.col("user_id").isNotNull()).select("user_id", slices.ts, slices.number.alias("slice"))
    states = gaps.click_states(clicked, ("user_id", "slice")).withColumnsRenamed({n: f"click_{n}" for n in ("n", "ties", "at", "gaps")})
    parts = _traffic_parts(traffic, slices).unionByName(_order_parts(orders, slices), allowMissingColumns=True).unionByName(states, allowMissingColumns=True)
    added = [*_SUMS, *_FIRSTS, *_ORDERS, "revenue"]
    clicks = ("click_n", "click_ties", "click_at", "click_gaps")
    # all that follows is by user: one shuffle, of rows that are reduced already
    each = parts.repartition("user_id").groupBy("user_id", "slice").agg(
        *[F.sum(n).alias(n) for n in added], *[F.max(n).alias(n) for n in (*_LATEST, *clicks)]
    )
    in_order = Window.partitionBy("user_id").orderBy("slice")
    upto, earlier = in_order.rowsBetween(*_UPTO), in_order.rowsBetween(Window.unboundedPreceding, -1)
    across = F.col("click_at") * F.sum("click_n").over(earlier) - F.col("click_n") * F.sum("click_at").over(earlier)
    joined = each.withColumn("click_gaps", F.col("click_gaps") + F.coalesce(across.cast(_EXACT), F.lit(0).cast(_EXACT)))
    # doubles are summed window by window: differences of their sums would not be their sums
    plain = isinstance(orders.schema["total_product_sales"].dataType, (T.FloatType, T.DoubleType))
    running = {n: F.sum(n).over(upto) for n in (*added, "click_n", "click_ties", "click_gaps") if not (plain and n == "revenue")}
    running |= {n: F.max(n).over(upto) for n in _LATEST}
    state = F.struct("slice", *[running[n].alias(n) if n in running else F.col(n) for n in (*added, *_LATEST, "click_n", "click_ties", "click_gaps")])
    rows = joined.select("user_id", state.alias("state")).groupBy("user_id").agg(F.sort_array(F.collect_list("state")).alias("states"))
    return rows.select("user_id", F.transform("states", lambda s: s["slice"]).alias("slices"), "states")


def per_user_and_cutoff(
    traffic: DataFrame, orders: DataFrame, time_points: Sequence, horizons: Sequence[int] = HORIZONS, as_of: bool = False
) -> DataFrame:
    """All blocks of the feature row, one row per cut-off and user with a sponsored-products event before it."""
    traffic, orders = conform(traffic, TRAFFIC), conform(orders, CONVERSIONS)
    slices = Slices(traffic, time_points, horizons)
    plain = isinstance(orders.schema["total_product_sales"].dataType, (T.FloatType, T.DoubleType))
    spans = sorted({*horizons, 30})

    def cut(at: int, point: Column) -> Column:
        edges = {"before": at, "upto": at + 1, "ahead": slices.moved(at, 30 * DAY), "closed": slices.moved(at, -30 * DAY)}
        edges |= {f"open_{days}": slices.moved(at, 1 - days * DAY) for days in spans}
        return F.struct(point.alias("time_point"), *[F.lit(slices.place(e)).alias(f"at_{n}") for n, e in edges.items()])

    cuts = F.array(*[cut(at, point) for at, point in slices.points.items()])
    each = _per_user(traffic, orders, slices).select("*", F.inline(cuts))
    names = ["before", "upto", "ahead", "closed", *[f"open_{days}" for days in spans]]
    each = each.withColumns({f"n_{n}": _at_or_before(F.col("slices"), F.col(f"at_{n}")) for n in names})
    # what had happened before an edge; NULL if nothing had
    each = each.withColumns({n: F.get("states", F.col(f"n_{n}") - 1) for n in names} | {"end": F.get("states", F.size("states") - 1)})
    each = each.where(F.col("before.n_sp") > 0)

    def till(edge: str, name: str) -> str:
        return f"coalesce({edge}.{name}, 0)"

    def within(start: str, end: str, name: str) -> str:
        return f"({till(end, name)} - {till(start, name)})"

    def total(start: str, end: str, name: str, rows: str, label: str) -> str:
        """NULL if none of ``rows`` has a value; a row outside the window has one, 0."""
        value = within(start, end, name)
        if name == "revenue" and plain:
            inside = f"slice(states, n_{start} + 1, n_{end} - n_{start})"
            value = f"aggregate({inside}, double(0), (a, s) -> a + coalesce(s.revenue, double(0)))"
        kind = "double" if name == "revenue" else "bigint"
        return f"cast(if({rows} - {within(start, end, f'no_{name}')} > 0, {value}, NULL) AS {kind}) AS {label}"

    sold_before, sold_after = till("before", "n_orders"), within("upto", "end", "n_orders")
    measures = ("conversions", "revenue", "quantity")
    texts = [
        f"cast({till('before', 'campaigns')} AS bigint) AS search_campaign_cnt",
        *[total(f"open_{d}", "before", n, "before.n_sp", f"total_{n}_{d}d") for d in horizons for n in ("impressions", "clicks")],
        *[total("upto", "ahead", n, sold_after, f"total_{n}_after_30d") for n in measures],
        *[total(f"open_{d}", "before", n, sold_before, f"total_{n}_before_{d}d") for d in horizons for n in measures],
        "before.last_event AS last_event_dt_before",
        f"{till('upto' if as_of else 'end', 'terms')} AS search_term_count",
        *[
            f"if({till('before', f'n_{tag}')} > 0, {within('closed', 'before', f'{tag}_{n}')}, NULL) AS last_30days_{tag}_{n}"
            for tag in ("sp", "sb")
            for n in ("impressions", "clicks")
        ],
        *[f"cast({till('upto', f'{n}_days')} AS bigint) AS {n}_day_count" for n in ("impression", "click")],
        *[f"upto.last_{n} AS last_{n}_dt" for n in ("impression", "click")],
    ]
    gap = gaps.mean_gap(F.col("upto.click_n"), F.col("upto.click_ties"), F.col("upto.click_gaps")).alias("avg_click_interval_seconds")
    return each.select("time_point", "user_id", *map(F.expr, texts), gap)
