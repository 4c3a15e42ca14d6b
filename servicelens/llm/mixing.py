"""Mixing sources to target weights: temperature mixing realised as budgeted block permutations.

The share of each source's tokens is raised to an exponent between 0 (all
sources alike) and 1 (as they are), found by bisection, and normalised. Each
source's token budget is then met by whole epochs, each a permutation of its
blocks and of the documents in a block, and a last, partial epoch that takes
blocks in permuted order until the budget is met.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from servicelens.llm.common import free_names, materialise


@dataclass(frozen=True)
class MixParams:
    #: "entropy": the exponent at which the weights have ``entropy_share`` of the highest entropy.
    #: "repetition": the smallest exponent at which no source is repeated over ``max_repetition`` times.
    target: str = "repetition"
    entropy_share: float = 0.95
    max_repetition: float = 1.5
    #: Tokens to draw; None: as few as use every document of every source at least once.
    budget_tokens: int | None = None
    blocks: int = 1024
    block_docs: int = 64
    seed: int = 7
    #: Exponents tried in one pass over the sources, and passes: together steps**-passes of accuracy.
    steps: int = 32
    passes: int = 10


def token_count(text: Column) -> Column:
    """Words of a text: runs of other characters than space and 09-0D hex; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _hash(*parts: Column | int | str) -> Column:
    """52 bits of the md5 of the parts, as a long."""
    cols = [x.cast("string") if isinstance(x, Column) else F.lit(str(x)) for x in parts]
    return F.conv(F.substring(F.md5(F.concat_ws("/", *cols)), 1, 13), 16, 10).cast("long")


def _key(col: str = "source") -> Column:
    """The source as a group; NULL is a source of its own."""
    return F.coalesce(F.concat(F.lit("s"), F.col(col).cast("string")), F.lit("-"))


def _doc_key() -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("-"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))))


def source_totals(docs: DataFrame) -> DataFrame:
    """(skey, n_docs, tokens) by source."""
    return docs.groupBy("skey").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("tokens").alias("tokens"))


def find_exponent(totals: DataFrame, p: MixParams) -> float:
    """Bisect the exponent; each pass tries a whole grid of exponents at once over the table of sources.

    The entropy falls and the repetition ratio (the largest over the smallest
    weight per token) falls as the exponent rises from 0 to 1, so both targets
    are met by the boundary of one interval. Sources without a token have no
    weight.
    """
    some = totals.where("tokens > 0")
    all_tokens = some.agg(F.sum("tokens"), F.count(F.lit(1))).first()
    if not all_tokens[0] or all_tokens[1] < 2:
        return 1.0
    log_p = F.log(F.col("tokens") / F.lit(float(all_tokens[0])))
    low, high = 0.0, 1.0
    for _ in range(p.passes):
        grid = [low + (high - low) * i / p.steps for i in range(p.steps + 1)]
        aggs = []
        for i, a in enumerate(grid):
            if p.target == "entropy":
                aggs += [F.sum(F.exp(log_p * a)).alias(f"z{i}"), F.sum(F.exp(log_p * a) * log_p * a).alias(f"e{i}")]
            else:
                aggs += [F.max(log_p * (a - 1)).alias(f"z{i}"), F.min(log_p * (a - 1)).alias(f"e{i}")]
        got = some.agg(*aggs).first()
        if p.target == "entropy":
            goal = p.entropy_share * math.log(all_tokens[1])
            enough = [math.log(got[f"z{i}"]) - got[f"e{i}"] / got[f"z{i}"] >= goal for i in range(len(grid))]
        else:
            enough = [got[f"z{i}"] - got[f"e{i}"] > math.log(p.max_repetition) for i in range(len(grid))]
        last = max((i for i, ok in enumerate(enough) if ok), default=-1)  # target still exceeded there
        if last < 0:
            return low
        if last == len(grid) - 1:
            return high
        low, high = grid[last], grid[last + 1]
    return (low + high) / 2


def source_budgets(totals: DataFrame, p: MixParams) -> DataFrame:
    """(skey, n_blocks, epochs, rest): whole epochs and the tokens of the partial one, by source.

    Sources without a token (empty texts only) are drawn once.
    """
    a = find_exponent(totals, p)
    power = F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"), F.lit(a))).otherwise(F.lit(0.0))
    sums = totals.agg(F.sum(power).alias("z"), F.max(F.when(F.col("tokens") > 0, F.col("tokens") / power)).alias("most")).first()
    z, most = sums["z"] or 1.0, sums["most"] or 0.0
    budget = F.lit(float(p.budget_tokens)) * power / F.lit(z) if p.budget_tokens is not None else F.lit(most) * power
    budget = F.floor(budget + 0.5)
    return totals.select(
        "skey", "tokens", (power / F.lit(z)).alias("weight"),
        F.greatest(F.lit(1), F.least(F.lit(p.blocks), F.ceil(F.col("n_docs") / p.block_docs))).cast("int").alias("n_blocks"),
        F.when(F.col("tokens") > 0, F.floor(budget / F.col("tokens"))).otherwise(1).cast("long").alias("epochs"),
        F.when(F.col("tokens") > 0, F.pmod(budget, F.col("tokens"))).otherwise(0).cast("long").alias("rest"),
    )


def mix_plan(keyed: DataFrame, p: MixParams) -> tuple[DataFrame, DataFrame]:
    """``keyed`` (skey, dkey, tokens) -> (budgets, cuts).

    cuts (skey, block, cut) has, for the partial epoch of each source, the
    blocks taken (cut NULL: the whole block; else documents whose hash is up
    to ``cut``). Windows run over the blocks of a source, at most ``blocks``
    of them, and over the documents of the one block in which a source's
    budget ends.
    """
    narrow = materialise(keyed.select("skey", "dkey", "tokens"))
    budgets = materialise(source_budgets(source_totals(narrow), p))
    placed = narrow.join(budgets.where("rest > 0").select("skey", "n_blocks", "epochs", "rest"), "skey").select(
        "skey", "tokens", "epochs", "rest",
        F.pmod(_hash(p.seed, F.col("dkey")), F.col("n_blocks")).cast("int").alias("block"),
        _hash(p.seed, F.col("epochs"), F.col("dkey")).alias("h"),
    )
    blocks = materialise(placed.groupBy("skey", "block", "epochs", "rest").agg(F.sum("tokens").alias("tokens")))
    order = Window.partitionBy("skey").orderBy(_hash(p.seed, "block", F.col("epochs"), F.col("block"), F.col("skey")), "block")
    run = blocks.withColumn("upto", F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = run.where("upto <= rest").select("skey", "block", F.lit(None).cast("long").alias("cut"))
    ends = materialise(run.where("upto > rest and upto - tokens < rest").select("skey", "block", (F.col("rest") - F.col("upto") + F.col("tokens")).alias("left")))
    # within the last block: documents by hash until its tokens are used up; equal hashes (repeated rows) stay together
    hashes = placed.join(ends, ["skey", "block"]).groupBy("skey", "block", "left", "h").agg(F.sum("tokens").alias("tokens"))
    inner = Window.partitionBy("skey", "block").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    last = hashes.withColumn("upto", F.sum("tokens").over(inner)).where("upto - tokens < left").groupBy("skey", "block").agg(F.max("h").alias("cut"))
    return budgets, materialise(whole.unionByName(last))


def mixed(docs: DataFrame, params: MixParams | None = None, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all) columns of ``docs``, a row for each time it is drawn, with __epoch and __order.

    Epochs count from 0. ``__order`` permutes the blocks of a source's epoch,
    then the documents of a block: rows sorted by (__epoch, __order) are the
    mixed sequence. NULL sources are a source of their own; a NULL doc_id is
    keyed by its text; repeated rows are drawn alike; documents without a word
    are drawn in each whole epoch; an empty table gives no rows. Columns named
    like the two new ones are replaced, any others kept, whatever their names.
    """
    p = params or MixParams()
    names = [c for c in (keep if keep is not None else docs.columns) if c.lower() not in ("__epoch", "__order")]
    skey, dkey, tokens, n, full, block, cut, within = free_names(docs, "__skey", "__dkey", "__tokens", "__n", "__full", "__block", "__cut", "__in")
    keyed = docs.select(*names, _key().alias(skey), _doc_key().alias(dkey), token_count(F.col("text").cast("string")).alias(tokens))
    budgets, cuts = mix_plan(keyed.select(F.col(skey).alias("skey"), F.col(dkey).alias("dkey"), F.col(tokens).alias("tokens")), p)
    b = budgets.select(F.col("skey").alias(skey), F.col("n_blocks").alias(n), F.col("epochs").alias(full))
    c = cuts.select(F.col("skey").alias(skey), F.col("block").alias(block), F.col("cut").alias(cut), F.lit(True).alias(within))
    drawn = (
        keyed.join(b, skey).withColumn(block, F.pmod(_hash(p.seed, F.col(dkey)), F.col(n)).cast("int"))
        .join(c, [skey, block], "left")
    )
    partial = F.col(within).isNotNull() & (F.col(cut).isNull() | (_hash(p.seed, F.col(full), F.col(dkey)) <= F.col(cut)))
    times = F.col(full) + F.when(partial, 1).otherwise(0)
    return drawn.withColumn("__epoch", F.explode(F.when(times > 0, F.sequence(F.lit(0), (times - 1).cast("int"))))).select(
        *names, "__epoch",
        F.concat_ws("/", *[F.lpad(F.hex(x), 13, "0") for x in (
            _hash(p.seed, "block", F.col("__epoch"), F.col(block), F.col(skey)), _hash(p.seed, F.col("__epoch"), F.col(dkey)))]).alias("__order"),
    )
