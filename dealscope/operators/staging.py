"""From raw text columns to typed staging tables: clean, normalise, cast, deduplicate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealscope.functions import text
from dealscope.operators.versions import latest_by
from dealscope.schemas import Entity

# What orders extracts in time: the batch, and within it when the file landed, in milliseconds.
ARRIVAL = ("_batch_id", "_landed")
#: Says of a row that the source no longer has its key.
DELETED = "_deleted"
RAW_COLUMNS = ("_source", "_batch_id", "_ingested_at")


def to_raw(rows: DataFrame, source: str, batch_id: int) -> DataFrame:
    """Every column as text, with where and when it came from."""
    return rows.select(
        *[F.col(c).cast("string").alias(c) for c in rows.columns],
        F.lit(source).alias("_source"),
        F.lit(batch_id).cast("bigint").alias("_batch_id"),
        F.current_timestamp().alias("_ingested_at"),
    )


def clean(rows: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Trim and collapse blanks, empty cells to NULL; drop rows that lack a key."""
    rows = rows.withColumns({c: text.clean(F.col(c)) for c in columns})
    for key in keys:
        rows = rows.where(F.col(key).isNotNull())
    return rows


def normalise(rows: DataFrame, names: Sequence[str] = (), phones: Sequence[str] = (),
              codes: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Fold names, keep the digits of phones, map synonyms to codes."""
    changed = {c: text.fold_name(F.col(c)) for c in names}
    changed |= {c: text.digits(F.col(c)) for c in phones}
    changed |= {c: text.to_code(F.col(c), words) for c, words in (codes or {}).items()}
    return rows.withColumns(changed) if changed else rows


def cast_types(rows: DataFrame, schema: T.StructType, keys: Sequence[str] = (),
               codes: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Typed columns of ``schema`` plus ``_rejects``, the cells that were refused, or NULL.

    A cell that does not cast, and a word ``codes`` does not know, becomes NULL
    and one entry in ``_rejects``; so does a missing key. The row stays and the
    job goes on. Other columns pass through.

    The text is cleaned, parsed and compared in three projections, so that each
    cell goes through a regular expression and a parser once.
    """
    codes = codes or {}
    names = schema.fieldNames()
    rows = rows.withColumns({f"_text_{c}": text.clean(F.col(c)) for c in names})
    rows = rows.withColumns({
        field.name: text.to_code(F.col(f"_text_{field.name}"), codes[field.name]) if field.name in codes
        else _parse(F.col(f"_text_{field.name}"), field.dataType)
        for field in schema.fields
    })
    refused, entries = F.lit(False), []
    for name in names:
        bad = F.col(name).isNull()
        if name not in keys:
            bad = bad & F.col(f"_text_{name}").isNotNull()
        refused = refused | bad
        entries.append(F.when(bad, F.struct(F.lit(name).alias("column"), F.col(f"_text_{name}").alias("cell"))))
    rejects = F.when(refused, F.array_compact(F.array(*entries)))
    return rows.withColumn("_rejects", rejects).drop(*[f"_text_{c}" for c in names])


def _parse(cell: Column, wanted: T.DataType) -> Column:
    """A cleaned cell as the wanted type."""
    if isinstance(wanted, T.DecimalType):
        return text.parse_decimal(cell, wanted.precision, wanted.scale)
    if isinstance(wanted, T.TimestampType):
        return text.parse_timestamp(cell)
    if isinstance(wanted, T.DateType):
        return text.parse_date(cell)
    if isinstance(wanted, T.StringType):
        return cell
    return cell.try_cast(wanted)


def type_raw(raw: DataFrame, entity: Entity, names: Sequence[str] = (), phones: Sequence[str] = (),
             codes: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """All raw rows of an entity, cleaned, normalised and typed, with ``_rejects``.

    A column that the source does not have is NULL.
    """
    missing = [c for c in entity.schema.fieldNames() if c not in raw.columns]
    raw = raw.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else raw
    typed = cast_types(normalise(raw, names, phones), entity.schema, entity.key, codes)
    arrival = [F.col(c).try_cast("bigint").alias(c) for c in ARRIVAL if c in raw.columns]
    deleted = [F.col(DELETED).try_cast("boolean").alias(DELETED)] if DELETED in raw.columns else []
    return typed.select(*entity.schema.fieldNames(), *arrival, *deleted, "_rejects")


def settle(typed: DataFrame, entity: Entity) -> DataFrame:
    """The staging table: rows with a key, the latest version of each.

    The entity's own version columns decide first, then the batch, then which
    extract of the batch landed last. A key whose latest version says that it was
    deleted is not in the table.
    """
    order = [*entity.version, *[c for c in ARRIVAL if c in typed.columns]]
    rows = parsed_once(typed.drop("_rejects"))
    for key in entity.key:
        rows = rows.where(F.col(key).isNotNull())
    latest = latest_by(rows, entity.key, order)
    if DELETED not in latest.columns:
        return latest
    return latest.where(~F.coalesce(DELETED, F.lit(False))).drop(DELETED)


def parsed_once(rows: DataFrame) -> DataFrame:
    """The same rows from a generator of one row each. Catalyst can't move filters below it, where it
    would copy the parsers of a column into them, once for each time a parser names its cell."""
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))


def rejects(typed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per refused cell: the key, ``column, cell``.

    The filter stands behind the outer generator, where Catalyst cannot copy the
    parsers into it and run them twice.
    """
    cells = typed.select(*keys, F.inline_outer("_rejects"))
    return cells.where(F.col("column").isNotNull())
