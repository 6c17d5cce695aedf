"""Mixing sources to target weights.

Every source gets a share of the wanted words by its weight, at most
``max_epochs`` times its own size; what a full source leaves is shared again by
weight among the others. A source's documents stand in hash order. Its budget is
spent in that order: whole epochs first, then documents from the front up to the
exact word at which the budget ends.

Defined cases: a null text has no words; a null source is a source of its own,
ordered last; a null id hashes as empty text; documents without words take none;
repeated rows are separate documents; an empty table gives an empty plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from marea.functions.bounded import broadcast_if_small
from marea.llm.common import (ROWS_PER_BUCKET, WORD, bucket_bits, column, documents, fresh,
                              hash_key, running_sums)
from marea.session import materialized

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = 42


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_key(source: Column) -> Column:
    """Never null, and in the order of the sources with null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def allocate(sizes: DataFrame, weights: Sequence[float], share: float, max_epochs: int) -> DataFrame:
    """``src, source_size, target, budget``: each source's target, and that in whole words.

    ``sizes`` is one row (src, source_size) per source. A source is full exactly if
    its limit per unit of weight is no more than what each unit would get after the
    sources with smaller limits took theirs, so one ordered pass replaces the rounds
    of sharing again.
    """
    by_name, everything = Window.orderBy("src"), Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    weighted = (sizes.withColumn("weight", weight)
                .withColumn("limit", (max_epochs * F.col("source_size")).cast("double"))
                .withColumn("ratio", F.col("limit") / F.col("weight")))
    before = Window.orderBy("ratio", "src").rowsBetween(Window.unboundedPreceding, -1)
    left = F.lit(float(share)) * F.sum("source_size").over(everything) \
        - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    shared = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    ranked = (weighted.withColumn("per_unit", left / shared)
              .withColumn("full", F.col("ratio") <= F.col("per_unit")))
    level = F.min(F.when(~F.col("full"), F.struct("ratio", "src", "per_unit"))).over(everything)
    return (ranked.withColumn("target", F.when(F.col("full"), F.col("limit"))
                              .otherwise(level["per_unit"] * F.col("weight")))
            .withColumn("budget", F.round("target").cast("long"))
            .select("src", "source_size", "target", "budget"))


def mix_plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
             max_epochs: int = MAX_EPOCHS, seed: int = SEED, id_col: str = "doc_id",
             text_col: str = "text", source_col: str = "source",
             rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """One row per document: ``doc_id, src, key, size, source_size, target, epochs`` (how
    often it is taken whole), ``part`` (words of it taken once more) and ``taken``.

    ``weights`` go to the sources in the order of their names and repeat. Only ids,
    hash keys and word counts are shuffled, never texts.
    """
    doc_id = column(docs, id_col)
    base = materialized(docs.select(
        doc_id.alias("doc_id"), source_key(column(docs, source_col)).alias("src"),
        hash_key(doc_id, seed).alias("key"), words(column(docs, text_col)).alias("size")))
    targets = allocate(base.groupBy("src").agg(F.sum("size").alias("source_size")),
                       weights, share, max_epochs)
    placed = running_sums(base, "src", "key", ["doc_id", "size"], "size", "before",
                          bucket_bits(base.count(), rows_per_bucket))
    whole = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0)).cast("long")
    rest = F.col("budget") - F.col("epochs") * F.col("source_size") - F.col("before")
    return (placed.join(broadcast_if_small(targets), "src")
            .withColumn("epochs", whole)
            .withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), rest)))
            .withColumn("taken", F.col("epochs") * F.col("size") + F.col("part"))
            .select("doc_id", "src", "key", "size", "source_size", "target", "epochs", "part", "taken"))


def first_words(text: Column, count: Column) -> Column:
    """``text`` up to the end of its word number ``count``."""
    pieces = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    return F.array_join(F.slice(pieces, F.lit(1), count.cast("int")), "")


def mixed_documents(docs: DataFrame, plan: DataFrame, seed: int = SEED, id_col: str = "doc_id",
                    text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents as the plan takes them, with the columns of ``docs``: a row for each
    time a document is taken, the last document of a source cut at its last word.

    The plan cuts a source at one point of its hash order, so a row per source says
    it all and no text is shuffled. Rows that share an id and a size share its fate.
    """
    cuts = plan.groupBy("src").agg(
        F.max("epochs").alias("epochs"),
        F.max(F.when(F.col("part") > 0, F.struct("key", "doc_id", "size", "part"))).alias("last"))
    names = docs.columns
    size, here, times, epochs, key, last_id, last_size, last_part = (
        fresh(names, n) for n in ("size", "here", "times", "epochs", "key", "last_id", "last_size", "last_part"))
    cuts = cuts.select(F.col("src").alias(here), F.col("epochs").alias(epochs), F.col("last.key").alias(key),
                       F.col("last.doc_id").alias(last_id), F.col("last.size").alias(last_size),
                       F.col("last.part").alias(last_part))
    doc_id, text = column(docs, id_col), column(docs, text_col)
    marked = docs.select("*", source_key(column(docs, source_col)).alias(here), words(text).alias(size))
    own = F.struct(hash_key(doc_id, seed).alias("key"), doc_id.alias("doc_id"), F.col(size).alias("size"))
    end = F.struct(F.col(key).alias("key"), F.col(last_id).alias("doc_id"), F.col(last_size).alias("size"))
    none = F.lit(0).cast("long")
    part = (F.when(F.col(last_part).isNull() | (F.col(size) == 0), none)
            .when(own < end, F.col(size)).when(own == end, F.col(last_part)).otherwise(none))
    full = F.when(F.col(size) > 0, F.col(epochs)).otherwise(none)
    parts = F.concat(F.array_repeat(F.col(size), full.cast("int")), F.filter(F.array(part), lambda n: n > 0))
    taken = marked.join(broadcast_if_small(cuts), here).select("*", F.explode(parts).alias(times))
    shortened = F.when(F.col(times) < F.col(size), first_words(column(taken, text_col), F.col(times))) \
        .otherwise(column(taken, text_col))
    return taken.select(*[shortened.alias(n) if n == text_col else column(taken, n) for n in names])


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix_plan(documents(spark, sf_dir))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


OP2_SQL = r"""
with base as (
  select doc_id, case when source is null then '1' else '0' || source end as src,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         ('0x' || substr(md5('42|' || coalesce(doc_id::varchar, '')), 1, 15))::bigint as key
  from documents),
sizes as (select src, sum(size)::bigint as source_size from base group by src),
weighted as (
  select *, (2 * source_size)::double as lim,
         [3.0::double, 1.0::double, 2.0::double][((row_number() over (order by src) - 1) % 3 + 1)::int] as weight
  from sizes),
ranked as (
  select *, lim / weight as ratio,
         (1.5::double * sum(source_size) over ()
           - coalesce(sum(lim) over (order by lim / weight, src rows between unbounded preceding and 1 preceding), 0))
         / (sum(weight) over ()
           - coalesce(sum(weight) over (order by lim / weight, src rows between unbounded preceding and 1 preceding), 0)) as per_unit
  from weighted),
targets as (
  select src, source_size,
         case when ratio <= per_unit then lim
              else weight * (select per_unit from ranked where ratio > per_unit order by ratio, src limit 1) end as target
  from ranked),
placed as (
  select b.*, source_size, target, round(target)::bigint as budget,
         coalesce(sum(size) over (partition by b.src order by key, doc_id, size
                                  rows between unbounded preceding and 1 preceding), 0)::bigint as before
  from base b join targets using (src)),
epochs as (select *, case when source_size > 0 then budget // source_size else 0 end as whole from placed)
select doc_id, size, source_size, target,
       (whole * size + greatest(0, least(size, budget - whole * source_size - before)))::bigint as taken
from epochs
"""
