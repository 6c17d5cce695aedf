"""Exact order statistics by radix selection, without sorting a group in one task.

A double has a 64-bit key that orders like the number. Values are counted by the leading
bits of that key; only the bin that holds a wanted rank is counted again by its next
bits, and once more by the last ones, which leave a single value. Each count is a partial
aggregate, so equal values collapse before the shuffle. Ranks come from prefix sums over
blocks of bins. Nothing is sampled, and neither values nor bins reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from marea.functions.bounded import broadcast_if_small, local_frame
from marea.functions.numeric import order_key

BINS_PER_OCTAVE = 1024      # bins of the first count between a power of two and the next
BLOCK_BITS = 11             # bins of a block, as a power of two
DIGITS = ["bin", "middle", "low"]


def _digits(key: Column, bins: int | None) -> list[Column]:
    """The key in three digits: sign, exponent and leading fraction bits, then two halves of the rest."""
    octave = max(bins or BINS_PER_OCTAVE, 1)
    rest = max(52 - (octave - 1).bit_length(), 2)
    low = rest // 2
    mask = lambda bits: F.lit((1 << bits) - 1)
    return [F.shiftright(key, rest).alias("bin"),
            F.shiftright(key, low).bitwiseAND(mask(rest - low)).alias("middle"),
            key.bitwiseAND(mask(low)).alias("low")]


def binned_values(df: DataFrame, columns: list[str], group_col: str, bins: int | None = None) -> DataFrame:
    """Long form ``column, group, bin, middle, low, value``; missing values and groups drop out.

    ``bins`` is the number of bins between a power of two and the next in the first count.
    """
    # The key is made before the rows are spread: after that it is a value, not an expression to copy.
    numbers = {c: F.col(_name(c)).cast("double") for c in columns}
    cells = F.array(*[F.struct(F.lit(c).alias("column"), v.alias("value"), order_key(v).alias("key"))
                      for c, v in numbers.items()])
    return (df.where(F.col(_name(group_col)).isNotNull()).select(F.col(_name(group_col)), F.inline(cells))
            .where(F.col("key").isNotNull())
            .select("column", group_col, *_digits(F.col("key"), bins), "value"))


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _blocks(values: DataFrame, keys: list[str], digit: str) -> DataFrame:
    """Counts of a digit in blocks of up to 2 ** BLOCK_BITS bins each: ``block, size, bins``, and
    ``start``, the rows of the key before the block."""
    counts = values.groupBy(*keys, digit).agg(F.count("*").alias("n"), F.min("value").alias("value"))
    blocks = counts.groupBy(*keys, F.shiftright(digit, BLOCK_BITS).alias("block")).agg(
        F.sum("n").alias("size"),
        F.sort_array(F.collect_list(F.struct(F.col(digit).alias("digit"), "n", "value"))).alias("bins"))
    upto = F.sum("size").over(Window.partitionBy(*keys).orderBy("block"))
    return blocks.withColumn("start", upto - F.col("size"))


def _locate(blocks: DataFrame) -> Column:
    """The bin in a block that holds the row ``pos`` of its key: ``left``, the row's rank inside the
    bin, with the bin's ``digit`` and smallest ``value``."""
    none = F.struct((F.col("pos") - F.col("start")).alias("left"), F.lit(None).cast("bigint").alias("digit"),
                    F.lit(None).cast("double").alias("value"))

    def step(found: Column, cell: Column) -> Column:
        hit = F.struct(found["left"].alias("left"), cell["digit"].alias("digit"), cell["value"].alias("value"))
        on = F.struct((found["left"] - cell["n"]).alias("left"), found["digit"].alias("digit"),
                      found["value"].alias("value"))
        return F.when(found["digit"].isNotNull(), found).when(found["left"] < cell["n"], hit).otherwise(on)

    return F.aggregate("bins", none, step)


def exact_quantiles(binned: DataFrame, group_col: str, probs: dict[str, float]) -> DataFrame:
    """Linearly interpolated quantiles: ``column, group, n`` and one column per name.

    Three passes over ``binned``, one per digit; the second and third count only the bins
    that hold a wanted rank, at most two per name and group.
    """
    keys = ["column", group_col]
    place = {name: (F.col("total") - 1) * F.lit(float(p)) for name, p in probs.items()}
    sides = [F.struct(F.lit(name).alias("name"), F.lit(side).alias("side"), pos.cast("bigint").alias("pos"))
             for name, h in place.items() for side, pos in (("low", F.floor(h)), ("high", F.ceil(h)))]
    inside = (F.col("pos") >= F.col("start")) & (F.col("pos") < F.col("start") + F.col("size"))

    blocks = _blocks(binned, keys, "bin").withColumn("total", F.sum("size").over(Window.partitionBy(*keys)))
    wanted = blocks.select("*", F.inline(F.array(*sides))).where(inside)
    for last, digit in enumerate(DIGITS):
        found = wanted.withColumn("found", _locate(wanted)).select(
            *keys, *DIGITS[:last], "total", "name", "side", F.col("found.digit").alias(digit),
            F.col("found.left").alias("pos"), F.col("found.value").alias("value"))
        if last == len(DIGITS) - 1:
            break
        known = [*keys, *DIGITS[:last + 1]]
        ranks = broadcast_if_small(found.drop("value"))
        held = binned.join(_as_hinted(ranks, known), known)
        wanted = _blocks(held, known, DIGITS[last + 1]).join(ranks, known).where(inside)

    ends = {(name, side): F.max(F.when((F.col("name") == name) & (F.col("side") == side), F.col("value")))
            for name in probs for side in ("low", "high")}
    per_key = found.groupBy(*keys, "total").agg(*[end.alias(f"_{name}_{side}") for (name, side), end in ends.items()])
    between = {}
    for name, h in place.items():
        low, high = F.col(f"_{name}_low"), F.col(f"_{name}_high")
        between[name] = F.when(low == high, low).otherwise(low + (high - low) * (h - F.floor(h)))
    return per_key.select(*keys, F.col("total").alias("n"), *[col.alias(name) for name, col in between.items()])


def _as_hinted(ranks: DataFrame, known: list[str]) -> DataFrame:
    """The distinct bins of ``ranks``, as a table that is broadcast under the same check."""
    return broadcast_if_small(ranks.select(*known).distinct())


def auc_roc(df: DataFrame, label_col: str, score_col: str, bins: int | None = None) -> DataFrame:
    """One row ``n_pos, n_neg, auc``: the chance that a positive outranks a negative,
    ties counting half. Null when a class is missing.

    One pass over ``df`` counts labels per distinct score. The negatives below a score are
    the sum of four prefix sums over these counts: of the blocks of bins before its own, of
    the bins before in the block, of the middle digits before in the bin, and of the scores
    before it among those that share both.
    """
    counts = (df.select(F.col(_name(label_col)).cast("long").alias("label"),
                        F.col(_name(score_col)).cast("double").alias("score"))
              .where("label is not null and score is not null and not isnan(score)")
              .groupBy("score")
              .agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
              .withColumn("key", order_key(F.col("score")))
              .select("pos", "neg", *_digits(F.col("key"), bins))).persist()

    def before(order: str, *keys: str) -> Column:
        ahead = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("neg").over(ahead), F.lit(0))

    try:
        per_bin = counts.groupBy("bin").agg(F.sum("neg").alias("neg")).withColumn(
            "block", F.shiftright("bin", BLOCK_BITS))
        # At most 2 ** (64 - 42 - BLOCK_BITS) blocks at the default number of bins.
        per_block = per_bin.groupBy("block").agg(F.sum("neg").alias("neg")).select("block", before("block").alias("b0"))
        bin_start = per_bin.withColumn("b1", before("bin", "block")).join(broadcast_if_small(per_block), "block") \
            .select("bin", (F.col("b0") + F.col("b1")).alias("bin_start"))
        middle_start = counts.groupBy("bin", "middle").agg(F.sum("neg").alias("neg")) \
            .withColumn("b2", before("middle", "bin")).join(broadcast_if_small(bin_start), "bin") \
            .select("bin", "middle", (F.col("bin_start") + F.col("b2")).alias("middle_start"))
        ranked = counts.withColumn("b3", before("low", "bin", "middle")).join(middle_start, ["bin", "middle"])
        wins = F.col("pos") * (F.col("middle_start") + F.col("b3") + F.col("neg") / 2)
        sums = ranked.agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("n_pos"),
                          F.coalesce(F.sum("neg"), F.lit(0)).alias("n_neg"), F.sum(wins).alias("won")).first()
    finally:
        counts.unpersist()
    n_pos, n_neg, won = sums
    auc = won / (float(n_pos) * n_neg) if n_pos and n_neg else None
    return local_frame(df.sparkSession, [{"n_pos": n_pos, "n_neg": n_neg, "auc": auc}],
                       "n_pos long, n_neg long, auc double")
