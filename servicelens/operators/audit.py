"""Q1-Q15: data-quality audit.

One aggregate per input table plus three keyed jobs (duplicate ids, orphan
foreign keys, exact duplicate rows), combined as scalar subqueries and
unpivoted into the long ``check, value`` layout.  No per-check job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servicelens.functions.exprs import money
from servicelens.params import Params
from servicelens.sources.csv_source import as_of_date


def _duplicates(df: DataFrame, key: str) -> Column:
    """Rows beyond the first occurrence of ``key`` (repeated NULLs count too)."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint")).scalar()


def _orphans(lines: DataFrame, assets: DataFrame) -> Column:
    """Distinct non-null asset ids of the lines that are missing from the master."""
    ids = lines.select("asset_id").where(F.col("asset_id").isNotNull()).distinct()
    return ids.join(assets.select("asset_id"), "asset_id", "left_anti").select(F.count(F.lit(1))).scalar()


def _unpivot(base: DataFrame, rows: list[tuple[str, Column, Column | None, str]]) -> DataFrame:
    arr = F.array(*[
        F.struct(F.lit(i).alias("ord"), F.lit(name).alias("check"), val.cast("double").alias("value"),
                 (txt if txt is not None else F.lit(None).cast("string")).alias("value_text"),
                 F.lit(desc).alias("description"))
        for i, (name, val, txt, desc) in enumerate(rows)
    ])
    return base.select(F.inline(arr)).orderBy("ord").drop("ord")


def audit_checks(lines: DataFrame, assets: DataFrame) -> DataFrame:
    """Q1-Q9: the 14 checks of the code variant (``check, value, value_text, description``)."""
    la = lines.agg(
        F.count(F.lit(1)).alias("service_rows"),
        F.count_if(F.col("visit_date").isNull()).alias("date_missing"),
        F.count_if(F.col("price").isNull()).alias("price_missing"),
        F.count_if(F.col("price") < 0).alias("negative_price"),
        F.min("visit_date").alias("dmin"), F.max("visit_date").alias("dmax"),
    )
    visits = lines.select("visit_id").where(F.col("visit_id").isNotNull()).distinct().select(F.count(F.lit(1))).scalar()
    aa = assets.agg(
        F.count(F.lit(1)).alias("master_rows"),
        F.count_distinct("customer_id").alias("customers"),
        F.count_distinct("asset_id").alias("cars"),
        F.floor(F.avg(F.startswith(F.coalesce(F.col("phone"), F.lit("")), F.lit("0")).cast("int")) * 100).alias("phone_ok"),
    )
    rows = [
        ("master_rows", aa.select("master_rows").scalar(), None, "rows in the asset master"),
        ("service_rows", F.col("service_rows"), None, "rows in the service lines"),
        ("unique_customers", aa.select("customers").scalar(), None, "distinct owners in the master"),
        ("unique_assets", aa.select("cars").scalar(), None, "distinct assets in the master"),
        ("unique_visits", visits, None, "distinct visits in the service lines"),
        ("date_missing", F.col("date_missing"), None, "service dates that failed to parse"),
        ("price_missing", F.col("price_missing"), None, "prices missing or unparseable"),
        ("negative_price", F.col("negative_price"), None, "negative prices"),
        ("duplicate_line_id", _duplicates(lines, "line_id"), None, "repeated line ids"),
        ("duplicate_asset_id", _duplicates(assets, "asset_id"), None, "repeated asset ids in the master"),
        ("fk_missing_asset_id", _orphans(lines, assets), None, "asset ids of the lines missing from the master"),
        ("phone_leading_zero_ok", aa.select("phone_ok").scalar(), None, "percent of phone numbers starting with 0"),
        ("min_service_date", F.lit(None), F.col("dmin").cast("string"), "first service date"),
        ("max_service_date", F.lit(None), F.col("dmax").cast("string"), "last service date"),
    ]
    return _unpivot(la, rows)


def audit_status(lines: DataFrame, assets: DataFrame, params: Params, tasks: int | None = None) -> DataFrame:
    """Q10-Q15: the committed-output layout, counts with PASS (0) / FAIL.

    ``tasks``: tasks that the lines are dealt out to before equal ones are
    merged; without it, a task's table of lines is as large as its part of the joins before.
    """
    as_of = as_of_date(lines, params)
    # one pass: equal lines are merged first, then counted by id, then in all
    n = F.col("n")
    flags = {
        "bad_price": F.col("price") <= 0,
        "bad_qty": F.col("qty") <= 0,
        "after_as_of": F.col("visit_date") > as_of,
        "before_window": F.col("visit_date") < F.lit(params.window_start).cast("date"),
    }
    dealt = lines if tasks is None else lines.repartition(tasks, *lines.columns)
    per_id = dealt.groupBy(*lines.columns).agg(F.count(F.lit(1)).alias("n")).groupBy("line_id").agg(
        F.sum(n).alias("lines"), F.sum(n - 1).alias("copies"),
        *[F.sum(F.when(c, n).otherwise(0)).alias(k) for k, c in flags.items()])
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    la = per_id.agg(
        total(F.when(F.col("line_id").isNull(), F.col("lines"))).alias("missing_id"),
        total(F.col("lines") - 1).alias("same_id"), total("copies").alias("copies"), *[total(k).alias(k) for k in flags])
    aa = assets.agg(
        F.count_if(F.col("phone").isNull()).alias("missing_phone"),
        F.count_if(F.col("phone").isNotNull() & ~F.startswith(F.col("phone"), F.lit("0"))).alias("phone_bad"),
    )
    rows = [
        ("missing_line_id", F.col("missing_id"), None, ""),
        ("duplicate_line_id", F.col("same_id"), None, ""),
        ("orphan_asset_id", _orphans(lines, assets), None, ""),
        ("nonpositive_price", F.col("bad_price"), None, ""),
        ("nonpositive_qty", F.col("bad_qty"), None, ""),
        ("missing_phone", aa.select("missing_phone").scalar(), None, ""),
        ("phone_not_leading_zero", aa.select("phone_bad").scalar(), None, "phones must be read as text"),
        ("date_after_as_of", F.col("after_as_of"), None, ""),
        ("date_before_window", F.col("before_window"), None, ""),
        ("exact_duplicate_rows", F.col("copies"), None, ""),
    ]
    out = _unpivot(la, rows).drop("value_text")
    return out.select("check", "value", F.when(F.col("value") == 0, "PASS").otherwise("FAIL").alias("status"),
                      F.col("description").alias("notes"))


def amount_contract(lines: DataFrame) -> DataFrame:
    """Prices that no exact sum can hold and that ``money`` therefore leaves out, beside all that are given."""
    given = F.col("price").isNotNull()
    return lines.agg(F.count("price").alias("prices"), F.count_if(given & money("price").isNull()).alias("prices_left_out"),
                     F.count_if(given & (money("price").cast("double") != F.col("price"))).alias("prices_rounded"))
