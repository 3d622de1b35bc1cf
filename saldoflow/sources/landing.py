"""Settlement reports to tables by name, typed, replaced as a whole or where they differ."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import inference
from .reports import apply_schema, normalise_decimals, report_problems, stamp, whole_lines
from .schemas import SKIPPED_KINDS, report_kind
from .storage import stored, temporary
from .tables import Changes, load_changes, replace_table

LOST_SCHEMA = "kind string, column string, lost bigint"


class NamedLanding(NamedTuple):
    """Names of the tables that ``land_tables`` wrote."""

    tables: dict[str, str]  # by kind
    changes: dict[str, Changes]  # by kind, of those loaded by comparison
    problems: str  # archive, member, kind, problem
    lost_values: str  # kind, column, lost


def _headers(lines: DataFrame) -> dict[str, list[str]]:
    """Per kind its columns: in file order if all members have the same ones, else all that occur, sorted."""
    first = lines.filter("line = 1").select("kind", F.map_keys("values").alias("header")).distinct().collect()
    by_kind: dict[str, list[list[str]]] = {}
    for r in first:
        by_kind.setdefault(r.kind, []).append(r.header)
    return {k: h[0] if len(h) == 1 else sorted({n for names in h for n in names}) for k, h in by_kind.items()}


def _typed(texts: DataFrame, schema: T.StructType) -> tuple[DataFrame, Observation | None]:
    """The texts with their types, and what counts the values that no type took while the rows are written."""
    wanted = [f.name for f in schema if f.name in texts.columns and not isinstance(f.dataType, T.StringType)]
    if not wanted:
        return texts, None
    both = apply_schema(texts.withColumns({f"_text_{c}": F.col(c) for c in wanted}), schema)
    seen = Observation()
    counts = [F.count_if(F.col(f"_text_{c}").isNotNull() & F.col(c).isNull()).alias(c) for c in wanted]
    return both.observe(seen, *counts).select(*texts.columns), seen


def land_tables(rows: DataFrame, prefix: str, run_date: dt.date, keys: Mapping[str, Sequence[str]] | None = None,
                strict: bool = False) -> NamedLanding:
    """Writes every kind of ``report_rows`` or ``member_rows`` to the table ``prefix`` + its table's name.

    A registered kind has its schema and is partitioned by its business date; any other one has the types that
    all its values have (``inference``) under its own name. A kind in ``keys`` is brought up to date by
    ``load_changes``, where the day of the load is no difference; all others are replaced. What could
    not be read and what no type took are tables beside them. ``strict`` makes a member that can't be
    read an error before anything but its report is replaced.
    """
    spark = rows.sparkSession
    with temporary(spark):
        every = stored(rows)  # archives are opened once
        replace_table(report_problems(every), f"{prefix}problems")
        if strict and not every.filter("problem IS NOT NULL").isEmpty():
            raise ValueError(f"some members can't be read, see {prefix}problems")
        lines = stored(whole_lines(every).select("kind", "line", "values"), by="kind")
        tables, changes, lost = {}, {}, []
        for kind, columns in sorted(_headers(lines).items()):
            if kind in SKIPPED_KINDS:
                continue
            known = report_kind(kind)
            texts = normalise_decimals(lines.filter(F.col("kind") == kind).select(*[F.col("values")[c].alias(c) for c in columns]))
            schema = known.schema if known else inference.schema_of(inference.kinds(texts))
            typed, seen = _typed(texts, schema)
            df, name = stamp(typed, run_date), f"{prefix}{known.table if known else kind}"
            by = known.partition_by if known and known.partition_by in columns else None
            if by and keys and kind in keys:
                changes[kind] = load_changes(df, name, keys[kind], by, ignoring=["updated_on"])
            else:
                replace_table(df, name, by)
            lost += [(kind, c, n) for c, n in (seen.get.items() if seen else ()) if n]
            tables[kind] = name
        replace_table(spark.createDataFrame(lost, LOST_SCHEMA), f"{prefix}lost_values")
    return NamedLanding(tables, changes, f"{prefix}problems", f"{prefix}lost_values")
