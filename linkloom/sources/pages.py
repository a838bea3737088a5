"""The published page and its index: one line of JSON in a template, written only where something changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .files import embedded

MARKER = "const BOOTSTRAP ="


def blob(parts: dict[str, DataFrame], values: dict[str, str] | None = None, order: dict[str, list] | None = None) -> DataFrame:
    """(blob): one JSON object with an array for each table of parts (its rows in the order given by order, columns that are null left out) and the
    strings of values. For what a page shows: every table is gathered in one row."""
    out = None
    for name, df in parts.items():
        keys = (order or {}).get(name) or []
        row = F.struct(*[F.col(c) for c in df.columns])
        one = df.agg(F.transform(F.array_sort(F.collect_list(F.struct(*[k.alias(f"o{i}") for i, k in enumerate(keys)], row.alias("row")))), lambda x: x["row"]).alias(name))
        out = one if out is None else out.crossJoin(F.broadcast(one))  # one row each
    return out.select(F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in (values or {}).items()], *parts)).alias("blob"))


def inlined(template: str, text: str, marker: str = MARKER) -> str:
    """The page with its line that begins with marker replaced. Raises ValueError where no line does."""
    lines = template.split("\n")
    for i, line in enumerate(lines):
        if line.startswith(marker):
            lines[i] = f"{marker} {text};"
            return "\n".join(lines)
    raise ValueError(f"no line begins with {marker!r}")


def stamp(old: DataFrame | None, new: DataFrame, now: str, stamped: str = "generatedAt") -> str:
    """The stamp to publish under: the old one if nothing but the stamp changed, so that the same inputs give the same bytes."""
    if old is None or set(old.columns) - {stamped} != set(new.columns) - {stamped}:
        return now
    names = sorted(set(new.columns) - {stamped})
    had = old.select(*names), old.select(stamped).first()
    same = had[0].exceptAll(new.select(*names)).isEmpty() and new.select(*names).exceptAll(had[0]).isEmpty()
    return had[1][0] if same and had[1] else now


def previous(spark, path: str, schema: str) -> DataFrame | None:
    """What the page at path carries, or None where it can't be read."""
    try:
        rows = embedded(spark, path, schema)
        return None if rows.isEmpty() else rows
    except Exception:  # an unreadable page is published anew
        return None
