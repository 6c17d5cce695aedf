"""Schema drift: bring a changed batch back to the schema a model expects.

Resolution works on names and types alone; renames, nulls, casts, order and the
dropping of extras then are one projection.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import (BooleanType, DateType, DecimalType, DoubleType, FloatType, IntegralType, NumericType,
                               StringType, StructField, StructType, TimestampNTZType, TimestampType)

from marea.functions.bounded import local_frame
from marea.functions.numeric import decimals, to_number

# --- Fixed values: expected name -> variants seen in deliveries, in order of preference ---
SYNONYMS = {
    "customer_id": ["cust_id", "client_id", "id_cliente"],
    "monthly_charges": ["monthlycharge", "costo_mensual"],
    "tenure_months": ["tenure", "meses_tenencia"],
    "gender": ["Genero", "Gender_ID"],
    "TotalCharges": ["Total_Charges", "TotalCharge"],
}
# -------------------------------------------------------------------------------------------

WIDE = "decimal(38,18)"     # holds every long, written as 12.0 or 1e3 too
PLAIN = (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)


@dataclass
class Alignment:
    """Which source column feeds which expected one."""

    source: dict[str, str | None] = field(default_factory=dict)
    renamed: dict[str, str] = field(default_factory=dict)
    missing: list[str] = field(default_factory=list)
    extra: list[str] = field(default_factory=list)


def _find(name: str, columns: Sequence[str]) -> str | None:
    """The column of that name: exact first, else the only one that differs in case."""
    if name in columns:
        return name
    close = [c for c in columns if c.lower() == name.lower()]
    if len(close) > 1:
        raise ValueError(f"{name!r} matches several columns: {close}")
    return close[0] if close else None


def resolve(columns: Sequence[str], expected: StructType, synonyms: Mapping[str, Sequence[str]]) -> Alignment:
    """A column's own name wins; else its first known variant, unless the model
    expects that variant itself."""
    plan = Alignment()
    expected_names = {f.name.lower() for f in expected}
    taken: set[str] = set()
    for name in expected.names:
        found = _find(name, columns)
        if found is None:
            for variant in synonyms.get(name, ()):
                candidate = _find(variant, columns)
                if candidate and candidate.lower() not in expected_names and candidate not in taken:
                    found, plan.renamed[candidate] = candidate, name
                    break
        plan.source[name] = found
        if found is None:
            plan.missing.append(name)
        else:
            taken.add(found)
    plan.extra = [c for c in columns if c not in taken]
    return plan


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _cast(col: Column, have, want) -> Column:
    """The value in the wanted type, or null where it would be another value there.

    Whole numbers may be written ``12.0`` or ``1e3``, but 12.7 is none; 12.75 does not fit a
    type with one decimal, a time of day no date, 5 no boolean. Only a text that becomes a
    binary fraction takes the nearest one, unless that is zero or endless and the text is not.
    """
    if have == want:
        return col
    if isinstance(have, StringType) and isinstance(want, NumericType):
        return _number_of(col, want)
    if isinstance(have, StringType) and isinstance(want, DateType):
        day = col.try_cast(want)
        return F.when(day.cast("timestamp_ntz") == col.try_cast("timestamp_ntz"), day)
    cast = col.try_cast(want)
    if isinstance(have, PLAIN) and isinstance(want, PLAIN):
        return F.when(cast.try_cast(have) == col, cast)
    return cast


def _number_of(text: Column, want) -> Column:
    places = decimals(text)     # null for zero, which fits everywhere
    if isinstance(want, (FloatType, DoubleType)):
        number = to_number(text, want.simpleString())
        # In this order only zeros and endless values have their text looked at.
        return F.when(((number != 0) & (F.abs(number) < float("inf"))) | places.isNull(), number)
    if isinstance(want, DecimalType):
        return F.when(F.coalesce(places <= want.scale, F.lit(True)), to_number(text, want.simpleString()))
    return F.when(F.coalesce(places <= 0, F.lit(True)), to_number(text, WIDE).try_cast(want))


def _projection(df: DataFrame, expected: StructType, plan: Alignment) -> list[tuple[StructField, Column, Column | None]]:
    """(field, aligned column, source column where a cast could fail)."""
    cells = []
    for f in expected:
        name = plan.source[f.name]
        if name is None:
            cells.append((f, F.lit(None).cast(f.dataType), None))
        else:
            have = df.schema[name].dataType
            col = _cast(_quoted(name), have, f.dataType)
            cells.append((f, col, None if have == f.dataType else _quoted(name)))
    return cells


def align_schema(df: DataFrame, expected: StructType,
                 synonyms: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """``df`` with exactly the expected columns, types and order. Works on streams too."""
    plan = resolve(df.columns, expected, SYNONYMS if synonyms is None else synonyms)
    return df.select(*[col.alias(f.name) for f, col, _ in _projection(df, expected, plan)])


def align_and_observe(df: DataFrame, expected: StructType, synonyms: Mapping[str, Sequence[str]] | None = None,
                      ) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """The aligned batch, and its drift report from the same scan.

    The rows and failed casts are counted while the batch passes: write the frame first, or run
    any other action over all of its rows, then call the second value for the report.
    """
    synonyms = SYNONYMS if synonyms is None else synonyms
    plan = resolve(df.columns, expected, synonyms)
    cells = _projection(df, expected, plan)
    # Each value is cast once, beside whether that lost it; the counts and the batch both read the result.
    cast = df.select(*[col.alias(f"cell_{n}") for n, (_, col, _) in enumerate(cells)],
                     *[raw.isNotNull().alias(f"had_{n}") for n, (_, _, raw) in enumerate(cells) if raw is not None])
    lost = {f"lost_{n}": F.count_if(F.col(f"had_{n}") & F.col(f"cell_{n}").isNull()).alias(f"lost_{n}")
            for n, (_, _, raw) in enumerate(cells) if raw is not None}
    counts = {"n_rows": F.count(F.lit(1)).alias("n_rows"), **lost}
    passed = Observation()
    aligned = cast.observe(passed, *counts.values()).select(
        *[F.col(f"cell_{n}").alias(f.name) for n, (f, _, _) in enumerate(cells)])

    def report() -> DataFrame:
        found = {name: passed.get[name] for name in counts}
        schema = ", ".join(f"`{name}` bigint" for name in counts)
        return _as_report(local_frame(df.sparkSession, [found], schema), plan, synonyms, _castable(cells))

    return aligned, report


def drift_report(df: DataFrame, expected: StructType,
                 synonyms: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """One row: missing and extra columns, known variants, renames done, and the
    values per column that no cast could save."""
    synonyms = SYNONYMS if synonyms is None else synonyms
    plan = resolve(df.columns, expected, synonyms)
    cells = _projection(df, expected, plan)
    return _as_report(df.agg(*_counts(cells).values()), plan, synonyms, _castable(cells))


def _castable(cells: list[tuple[StructField, Column, Column | None]]) -> dict[str, str]:
    """Names of the columns where a cast could fail, and of their counts."""
    return {f.name: f"lost_{n}" for n, (f, _, raw) in enumerate(cells) if raw is not None}


def _counts(cells: list[tuple[StructField, Column, Column | None]]) -> dict[str, Column]:
    lost = {f"lost_{n}": F.count_if(raw.isNotNull() & col.isNull()).alias(f"lost_{n}")
            for n, (_, col, raw) in enumerate(cells) if raw is not None}
    return {"n_rows": F.count(F.lit(1)).alias("n_rows"), **lost}


def _as_report(counts: DataFrame, plan: Alignment, synonyms: Mapping[str, Sequence[str]],
               castable: dict[str, str]) -> DataFrame:
    texts = lambda names: F.array(*map(F.lit, names)).cast("array<string>")
    table = lambda pairs, kind: F.create_map(*[c for k, v in pairs for c in (F.lit(k), v)]).cast(kind)
    return counts.select(
        "n_rows", texts(plan.missing).alias("missing_columns"), texts(plan.extra).alias("extra_columns"),
        table([(k, texts(v)) for k, v in synonyms.items()], "map<string,array<string>>").alias("name_mapping_used"),
        table([(k, F.lit(v)) for k, v in plan.renamed.items()], "map<string,string>").alias("renames_applied"),
        table([(c, F.col(n)) for c, n in castable.items()], "map<string,bigint>").alias("failed_casts"))


def drift_rows(report: DataFrame) -> DataFrame:
    """The report as rows ``kind, name, detail``."""
    listed = lambda col, kind: F.transform(col, lambda c: F.struct(
        F.lit(kind).alias("kind"), c.alias("name"), F.lit(None).cast("string").alias("detail")))
    mapped = lambda col, kind, text: F.transform(F.map_entries(col), lambda e: F.struct(
        F.lit(kind).alias("kind"), e["key"].alias("name"), text(e["value"]).alias("detail")))
    return report.select(F.inline(F.concat(
        listed("missing_columns", "missing"), listed("extra_columns", "extra"),
        mapped("name_mapping_used", "known variants", lambda v: F.array_join(v, ",")),
        mapped("renames_applied", "renamed", lambda v: v),
        mapped("failed_casts", "failed casts", lambda v: v.cast("string")))))
