"""Adapter from the star-schema test tables to the canonical views.

``lines``  = lineitem with order, customer, part, supplier and nation
looked up by key; ``assets`` = customer.  Each lookup is a left join on the
dimension's unique key, so a lookup whose columns are not requested is left
out of the plan without changing the row set: a query that needs only
``(visit_id, category, price)`` reads lineitem and part and nothing else.
Spark picks broadcast or shuffle joins per lookup from the measured size
(``spark.sql.autoBroadcastJoinThreshold`` + AQE); only ``nation`` (25 rows
by construction) is broadcast unconditionally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from servicelens.params import Params
from servicelens.session import cut_lineage

# Meaning given to the star tables' columns.
ANCHOR_CATEGORY = "PROMO"
METER_EPOCH = "1995-01-01"
INTERVAL_KM_BY_SEGMENT = {
    "AUTOMOBILE": 4500,
    "BUILDING": 6000,
    "FURNITURE": 7000,
    "HOUSEHOLD": 9500,
    "MACHINERY": 10000,
}
FUEL_BY_MOD3 = ("Petrol", "Diesel", "Hybrid")
DRIVE_BY_MOD3 = ("FWD", "RWD", "4x4")
OIL_BY_MOD4 = ("Mineral", "Semi-Synthetic", "Full-Synthetic", "Full-Synthetic")
# approximate Eid al-Fitr dates of the years the star tables cover
STAR_HOLIDAYS = (
    "1995-03-03", "1996-02-21", "1997-02-09", "1998-01-30", "1999-01-19",
    "2000-01-08", "2000-12-27", "2001-12-16",
)
#: Lines that a task sorts or groups where a query holds most of them (beyond, tasks grow in number, not in memory).
LINES_A_TASK = 250_000
STAR_PROBE_ITEMS = ("Brand#1", "Brand#2", "Brand#3", "Brand#4")


def star_params(**overrides) -> Params:
    base = Params(
        anchor_column="category", anchor_value=ANCHOR_CATEGORY,
        min_support=0.02, min_lift=1.05, window_start=METER_EPOCH,
        holidays=STAR_HOLIDAYS, probe_items=STAR_PROBE_ITEMS, weekly_capacity=None,
    )
    return base.with_(**overrides) if overrides else base


def _pick(values: tuple[str, ...], key: Column) -> Column:
    out = None
    for i, v in enumerate(values):
        out = (F.when(key == i, F.lit(v)) if out is None else out.when(key == i, F.lit(v)))
    return out


def km_per_month_expr(acctbal: Column) -> Column:
    return F.lit(300.0) + (F.abs(acctbal) % F.lit(2000.0))


class StarViews:
    """Canonical views over ``{sf_dir}/{table}.parquet``.

    The (lazy) view DataFrames are memoised per column set on this object,
    which only saves driver-side plan construction; no data is cached.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, params: Params | None = None):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.params = params or star_params()
        self._views: dict[tuple, DataFrame] = {}

    def _memo(self, key: tuple, build) -> DataFrame:
        if key not in self._views:
            self._views[key] = build()
        return self._views[key]

    def shared(self, name: str, build) -> DataFrame:
        """A result that several parts of one query use: computed and checkpointed once for this object."""
        return self._memo(("shared", name), lambda: cut_lineage(build()))

    def table(self, name: str) -> DataFrame:
        return self._memo(("table", name), lambda: self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet"))

    def assets(self) -> DataFrame:
        return self._memo(("assets",), self._assets)

    def line_tasks(self) -> int:
        """Tasks that the lines are dealt out to, by their number (of which the files' footers tell)."""
        return max(1, -(-self.table("lineitem").count() // LINES_A_TASK))

    def lines(self, *columns: str) -> DataFrame:
        """Service lines with only the lookups the requested columns need."""
        return self._memo(("lines",) + tuple(columns), lambda: self._lines(*columns))

    def _assets(self) -> DataFrame:
        c = self.table("customer")
        key = F.col("c_custkey")
        seg = None
        for name, km in INTERVAL_KM_BY_SEGMENT.items():
            seg = (F.when(F.col("c_mktsegment") == name, F.lit(km)) if seg is None
                   else seg.when(F.col("c_mktsegment") == name, F.lit(km)))
        return c.select(
            key.alias("asset_id"),
            (key - F.when(key % 7 == 6, 1).otherwise(0)).alias("customer_id"),
            F.col("c_name").alias("owner_name"),
            F.concat(F.when(key % 10 == 0, F.lit("62")).otherwise(F.lit("08")),
                     (F.lit(100000000) + key).cast("string")).alias("phone"),
            F.concat(F.lit("BK "), key.cast("string")).alias("plate"),
            F.concat(F.lit("Model "), (key % 19).cast("string")).alias("model"),
            F.concat(F.lit("Trim "), F.col("c_nationkey").cast("string")).alias("trim"),
            (F.lit(1985) + key % 10).cast("int").alias("model_year"),
            _pick(FUEL_BY_MOD3, key % 3).alias("fuel"),
            _pick(DRIVE_BY_MOD3, F.col("c_nationkey") % 3).alias("drive"),
            _pick(OIL_BY_MOD4, key % 4).alias("oil_type"),
            seg.alias("interval_km"),
            F.col("c_mktsegment").alias("segment"),
            km_per_month_expr(F.col("c_acctbal")).alias("km_per_month"),
        )

    def _lines(self, *columns: str) -> DataFrame:
        p = self.params
        wanted = set(columns) if columns else {
            "line_id", "visit_id", "asset_id", "visit_date", "meter_km", "branch",
            "technician", "category", "item", "qty", "price", "is_anchor",
        }
        if "is_anchor" in wanted:
            wanted.add(p.anchor_column)
        need_orders = bool(wanted & {"asset_id", "visit_date", "meter_km"})
        need_customer = "meter_km" in wanted
        need_part = bool(wanted & {"category", "item"})
        need_supplier = bool(wanted & {"technician", "branch"})
        need_nation = "branch" in wanted

        df = self.table("lineitem")
        if need_orders:
            o = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
            df = df.join(o, df.l_orderkey == o.o_orderkey, "left")
        if need_customer:
            c = self.table("customer").select("c_custkey", "c_acctbal")
            df = df.join(c, df.o_custkey == c.c_custkey, "left")
        if need_part:
            pt = self.table("part").select("p_partkey", "p_type", "p_brand")
            df = df.join(pt, df.l_partkey == pt.p_partkey, "left")
        if need_supplier:
            s = self.table("supplier").select("s_suppkey", "s_name", "s_nationkey")
            df = df.join(s, df.l_suppkey == s.s_suppkey, "left")
        if need_nation:
            n = F.broadcast(self.table("nation").select("n_nationkey", "n_name"))
            df = df.join(n, df.s_nationkey == n.n_nationkey, "left")

        visit_date = F.col("o_orderdate").cast("date")
        exprs = {
            "line_id": F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                                F.col("l_linenumber").cast("string")),
            "visit_id": F.col("l_orderkey"),
            "asset_id": F.col("o_custkey"),
            "visit_date": visit_date,
            "meter_km": F.floor(F.lit(1000) + F.datediff(visit_date, F.lit(METER_EPOCH).cast("date"))
                                * km_per_month_expr(F.col("c_acctbal")) / F.lit(30)).cast("bigint"),
            "branch": F.col("n_name"),
            "technician": F.col("s_name"),
            "category": F.col("p_type"),
            "item": F.col("p_brand"),
            "qty": F.col("l_quantity").cast("int"),
            "price": F.col("l_extendedprice"),
        }
        cols = [exprs[c].alias(c) for c in exprs if c in wanted]
        df = df.select(*cols)
        if "is_anchor" in wanted:
            # same truth table as coalesce(col = value, false), but made of
            # predicates Parquet accepts, so `where(is_anchor)` is pushed into the scan
            a = F.col(p.anchor_column)
            df = df.withColumn("is_anchor", (a == F.lit(p.anchor_value)) & a.isNotNull())
        order = [c for c in list(exprs) + ["is_anchor"] if c in (set(columns) if columns else wanted)]
        return df.select(*order)


def star_views(spark: SparkSession, sf_dir: str, params: Params | None = None) -> StarViews:
    return StarViews(spark, sf_dir, params)
