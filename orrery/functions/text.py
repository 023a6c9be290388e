"""Text expressions: text columns, junk flags, slugs, JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns a text is made of, in this order, and words of names that say nothing.
ALTERNATES = ("caption", "description", "prompt", "title", "summary", "notes")
JUNK_TERMS = ("unknown", "other", "misc", "artifact", "noise", "junk", "background")


def require_columns(df: DataFrame, columns: list[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def squeezed(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def with_text(df: DataFrame, text_col: str = "text", alternates: tuple[str, ...] = ALTERNATES, fallback_to_label: bool = True) -> DataFrame:
    """A usable text column: itself, else the alternates joined, else the label, else a template; nulls are empty."""
    if text_col in df.columns:
        return df.withColumn(text_col, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    present = [c for c in alternates if c in df.columns]
    if present:
        return df.withColumn(text_col, squeezed(F.concat_ws(" ", *[F.col(c).cast("string") for c in present])))
    if fallback_to_label and "label" in df.columns:
        return df.withColumn(text_col, F.coalesce(F.col("label").cast("string"), F.lit("")))
    field = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("")
    return df.withColumn(text_col, F.concat(F.lit("Histopathology patch. Source="), field("source"), F.lit(". Split="), field("split"), F.lit(". Label="), field("label"), F.lit(".")))


def scrub_leakage(c: Column, marker: str = "Label=") -> Column:
    """Blank where the text names the label."""
    return F.when(c.contains(marker), F.lit("")).otherwise(c)


def junk_name(c: Column) -> Column:
    name = F.trim(F.lower(F.coalesce(c, F.lit(""))))
    return (F.length(name) < 3) | name.rlike("|".join(JUNK_TERMS))


def short_description(c: Column, least: int = 20) -> Column:
    return F.length(F.trim(F.coalesce(c, F.lit("")))) < least


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def json_block(c: Column) -> Column:
    """From the first { to the last }; empty where there is none."""
    return F.regexp_extract(c, r"(?s)\{.*\}", 0)


def json_valid(c: Column) -> Column:
    return F.try_parse_json(c).isNotNull()


def keyed_id(prefix: str, key: Column) -> Column:
    """prefix:first 16 hex digits of the key's sha1."""
    return F.concat(F.lit(prefix + ":"), F.substring(F.sha1(key.cast("binary")), 1, 16))


def number(c: Column) -> Column:
    """Coercion: null where the text is no number."""
    return c.try_cast("double")


def missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN in a floating column."""
    c = F.col(column)
    kind = df.schema[column].dataType.typeName()
    return c.isNull() | F.isnan(c) if kind in ("double", "float") else c.isNull()
