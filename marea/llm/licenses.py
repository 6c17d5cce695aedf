"""License scan: TF-IDF cosine to templates, then inheritance along directories.

Every line of a file is a possible notice; a whole text is one too if its name is that
of a licence file. Lines and templates become sparse vectors of term frequency times
inverse document frequency, counted over all files. A file's own license is that of its
most similar (notice, template) pair, from ``min_cosine`` on.

Lines that cannot get there are dropped early without loss: the cosine to a template is
at most the root of the squared weights of the shared terms, so a line needs one of the
template's rarest terms, which are chosen such that the others stay below ``min_cosine``.

A directory declares the license of its licence files: files of such a name, and files of
which a notice makes up at least half. A file without a license of its own inherits from
the nearest directory above it that declares one.

Defined cases: a null text has no lines; a null path is a file without directory, which
inherits nothing; ties go to the license first by name; a directory with several licence
files declares the one of the best score, ties by name; copies share their answer;
repeated rows are separate files; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marea.functions.bounded import broadcast_if_small, local_frame
from marea.llm.common import column, documents
from marea.session import materialized

MIN_COSINE = 0.75
HALF = 0.5

# --- Fixed values -----------------------------------------------------------
TERM = r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*"
LICENSE_FILE = r"(?i)^(?:licen[cs]e|copying|unlicense|notice)(?:[._-].*)?$"
TEMPLATES = {
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Apache License Version 2.0, January 2004"],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0 Universal."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.",
                "Licensed under the GNU General Public License, version 2."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "Licensed under the GNU General Public License, version 3."],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3."],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Proprietary": ["All rights reserved."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
# ----------------------------------------------------------------------------


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def weights_of(spark: SparkSession, templates: Mapping[str, Sequence[str]]) -> DataFrame:
    """(template, license, term, tf): one row per template and term."""
    rows = [{"template": f"{license_} {n}", "license": license_, "notice": text}
            for license_, texts in templates.items() for n, text in enumerate(texts)]
    notices = local_frame(spark, rows, "template string, license string, notice string")
    return notices.select("template", "license", F.explode(terms(F.col("notice"))).alias("term")) \
        .groupBy("template", "license", "term").agg(F.count("*").alias("tf"))


def document_frequencies(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(term, df) of the wanted terms: the files that hold each of them."""
    held = texts.select(F.explode(F.array_distinct(terms(F.col("text")))).alias("term"))
    counted = held.join(broadcast_if_small(wanted.select("term").distinct()), "term").groupBy("term") \
        .agg(F.count("*").alias("df"))
    return wanted.select("term").distinct().join(counted, "term", "left").select(
        "term", F.coalesce("df", F.lit(0)).alias("df"))


def idf(df: Column, files: int) -> Column:
    return F.log((1.0 + files) / (1.0 + df)) + 1.0


def anchors(weighted: list[dict], min_cosine: float) -> list[str]:
    """The rarest terms of each template, without which no line reaches ``min_cosine``.

    ``weighted`` holds (template, term, weight), a few hundred rows that depend on the
    templates alone in number.
    """
    by_template: dict[str, list[tuple[float, str]]] = {}
    for row in weighted:
        by_template.setdefault(row["template"], []).append((row["weight"], row["term"]))
    found = set()
    for pairs in by_template.values():
        total = left = sum(w * w for w, _ in pairs)
        for weight, term in sorted(pairs, reverse=True):
            if math.sqrt(left / total) < min_cosine - 1e-9:
                break
            found.add(term)
            left -= weight * weight
    return sorted(found)


def best_notices(files: DataFrame, templates: Mapping[str, Sequence[str]], min_cosine: float) -> DataFrame:
    """(text_key, license, score, notice, notice_terms) for the texts that have a license.

    ``files`` holds (text_key, text, named): equal texts share their key, and ``named``
    texts also count as one notice each.
    """
    spark = files.sparkSession
    count = files.count()
    wanted = materialized(weights_of(spark, templates))
    frequencies = document_frequencies(files, wanted)
    weighted = wanted.join(frequencies, "term").withColumn("weight", F.col("tf") * idf(F.col("df"), count))
    rare = anchors([r.asDict() for r in weighted.select("template", "term", "weight").collect()], min_cosine)
    holds = F.array(*map(F.lit, rare))
    lines = F.concat(F.split("text", "\n"), F.when(F.col("named"), F.array("text")).otherwise(F.array()))
    likely = F.lower("text").rlike("|".join("\\Q" + t + "\\E" for t in rare))
    notices = files.where(likely).select("text_key", F.explode(F.array_distinct(lines)).alias("notice")) \
        .where(F.arrays_overlap(terms(F.col("notice")), holds)).distinct()
    notices = materialized(notices.withColumn("line_key", F.md5("notice")))
    counted = materialized(notices.select("line_key", "notice").dropDuplicates(["line_key"])
                           .select("line_key", F.explode(terms(F.col("notice"))).alias("term"))
                           .groupBy("line_key", "term").agg(F.count("*").alias("tf")))
    every = materialized(document_frequencies(files, counted.select("term").union(wanted.select("term")).distinct())
                         .withColumn("idf", idf(F.col("df"), count)).select("term", "idf"))
    sparse = counted.join(every, "term").select("line_key", "term", "tf", (F.col("tf") * F.col("idf")).alias("weight"))
    models = wanted.join(every, "term").select("template", "license", "term", (F.col("tf") * F.col("idf")).alias("model_weight"))
    sizes = sparse.groupBy("line_key").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("size"),
                                           F.sum("tf").alias("notice_terms"))
    model_sizes = models.groupBy("template").agg(F.sqrt(F.sum(F.col("model_weight") * F.col("model_weight"))).alias("model_size"))
    dots = sparse.join(F.broadcast(models), "term").groupBy("line_key", "template", "license") \
        .agg(F.sum(F.col("weight") * F.col("model_weight")).alias("dot"))
    scored = dots.join(F.broadcast(model_sizes), "template").join(sizes, "line_key") \
        .withColumn("score", F.round(F.col("dot") / (F.col("size") * F.col("model_size")), 9)) \
        .where(F.col("score") >= min_cosine)
    best = scored.groupBy("line_key", "notice_terms").agg(
        F.min(F.struct((-F.col("score")).alias("score"), "license")).alias("best"))
    return notices.join(best, "line_key").groupBy("text_key").agg(
        F.min(F.struct("best.score", "best.license", "notice", "notice_terms")).alias("best")) \
        .select("text_key", "best.license", (-F.col("best.score")).alias("score"), "best.notice", "best.notice_terms")


def scan(files: DataFrame, templates: Mapping[str, Sequence[str]] | None = None, min_cosine: float = MIN_COSINE,
         id_col: str = "file_id", path_col: str = "path", text_col: str = "text") -> DataFrame:
    """``file_id, path, own_license, score, notice, license, inherited_from`` per file."""
    templates = TEMPLATES if templates is None else templates
    read = files.select(column(files, id_col).alias("file_id"), column(files, path_col).alias("path"),
                        column(files, text_col).alias("text"))
    name = F.element_at(F.split("path", "/"), -1)
    keyed = read.select(
        "file_id", "path", F.md5("text").alias("text_key"), "text",
        F.coalesce(name.rlike(LICENSE_FILE), F.lit(False)).alias("named"))
    found = materialized(best_notices(keyed.select("text_key", "text", "named"), templates, min_cosine))
    directory = F.when(F.contains(F.col("path"), F.lit("/")), F.regexp_replace("path", "/[^/]*$", ""))
    rows = keyed.select("file_id", "path", "text_key", "named", directory.alias("directory"),
                        F.coalesce(F.regexp_count("text", F.lit(TERM)), F.lit(0)).alias("n_terms"))
    owned = materialized(rows.join(broadcast_if_small(found), "text_key", "left"))
    declares = F.col("license").isNotNull() & F.col("directory").isNotNull() \
        & (F.col("named") | (F.col("notice_terms") >= HALF * F.col("n_terms")))
    declared = owned.where(declares).groupBy("directory").agg(
        F.min(F.struct((~F.col("named")).alias("other"), (-F.col("score")).alias("score"), "license"))
        ["license"].alias("declared"))
    parts = F.split("directory", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)),
                        lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("above")))
    nearest = owned.where(F.col("directory").isNotNull()).select("directory").distinct() \
        .select("directory", F.explode(above).alias("step")) \
        .join(declared.withColumnRenamed("directory", "above"), F.col("step.above") == F.col("above")) \
        .groupBy("directory").agg(F.max(F.struct("step.depth", "above", "declared")).alias("nearest"))
    nearest = broadcast_if_small(nearest)
    return owned.join(nearest, "directory", "left").select(
        "file_id", "path", F.col("license").alias("own_license"), "score", "notice",
        F.coalesce("license", "nearest.declared").alias("license"),
        F.when(F.col("license").isNull(), F.col("nearest.above")).alias("inherited_from"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as files ``source/lang/doc_id.txt``."""
    docs = documents(spark, sf_dir)
    path = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")),
                       F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.lit(".txt")))
    scanned = scan(docs.select("doc_id", path.alias("path"), "text"), id_col="doc_id")
    return scanned.withColumnRenamed("file_id", "doc_id")


def _check_sql() -> str:
    """The scan of the documents with every line compared to every template."""
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    templates = ", ".join(f"({quoted(f'{name} {n}')}, {quoted(name)}, {quoted(text)})"
                          for name, texts in TEMPLATES.items() for n, text in enumerate(texts))
    terms_of = lambda text: f"regexp_extract_all(lower({text}), '{TERM}')"
    return rf"""
with templates(template, license, notice) as (values {templates}),
files as (
  select doc_id, text, coalesce(source, 'unknown') || '/' || coalesce(lang, 'unknown') as directory,
         coalesce(doc_id::varchar, 'none') || '.txt' as name, row_number() over () as file from documents),
held as (select distinct file, unnest({terms_of('text')}) as term from files),
frequency as (select term, count(*) as df from held group by term),
total as (select count(*) as n from files),
lines as (select file, unnest(list_distinct(string_split(text, chr(10)))) as notice from files),
counted as (
  select file, notice, term, count(*) as tf
  from (select file, notice, unnest({terms_of('notice')}) as term from lines) group by all),
model as (
  select template, license, term, count(*) as tf
  from (select template, license, unnest({terms_of('notice')}) as term from templates) group by all),
idf as (
  select term, ln((1.0::double + n) / (1.0::double + coalesce(df, 0))) + 1.0::double as idf
  from (select term from counted union select term from model) left join frequency using (term), total),
weights as (select file, notice, term, tf, tf * idf as weight from counted join idf using (term)),
model_weights as (select template, license, term, tf * idf as weight from model join idf using (term)),
sizes as (select file, notice, sqrt(sum(weight * weight)) as size, sum(tf) as terms from weights group by all),
model_sizes as (select template, sqrt(sum(weight * weight)) as size from model_weights group by all),
dots as (
  select w.file, w.notice, m.template, m.license, sum(w.weight * m.weight) as dot
  from weights w join model_weights m using (term) group by all),
scored as (
  select file, notice, license, terms, round(dot / (s.size * t.size), 9) as score
  from dots join sizes s using (file, notice) join model_sizes t using (template)),
best as (
  select * from scored where score >= {MIN_COSINE}
  qualify row_number() over (partition by file order by score desc, license, notice) = 1),
owned as (
  select files.*, license, score, notice,
         coalesce(terms >= {HALF} * len({terms_of('text')}), false) as whole from files left join best using (file)),
declared as (
  select directory, license as declared from owned where license is not null and whole
  qualify row_number() over (partition by directory order by score desc, license) = 1)
select doc_id, directory || '/' || name as path, license as own_license, score, notice,
       coalesce(license, declared) as license,
       case when license is null and declared is not null then directory end as inherited_from
from owned left join declared using (directory)
"""


OP9_SQL = _check_sql()
