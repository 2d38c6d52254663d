"""What a viewer may see.  Policies are applied last: ids and hashes never depend on the viewer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sourcetrail import contract as K

RAW_READERS = "raw_document_readers"
TEXT_READERS = "text_readers"
RAW_COLUMNS = frozenset({"content"})
TEXT_COLUMNS = frozenset({"page_text", "source_text", "date_source_text"})


def raw_mask(column: Column, kind: T.DataType, allowed: bool) -> Column:
    return column if allowed else F.lit(None).cast(kind)


def text_mask(column: Column, allowed: bool) -> Column:
    """NULL and empty text say nothing and stay; anything else is replaced."""
    return column if allowed else F.when(column.isNull() | (column == ""), column).otherwise(F.lit(K.RESTRICTED))


def _masked(column: Column, kind: T.DataType, name: str, raw_ok: bool, text_ok: bool) -> Column | None:
    """The masked column, or None where nothing in it is sensitive."""
    if name in RAW_COLUMNS:
        return None if raw_ok else raw_mask(column, kind, raw_ok)
    if name in TEXT_COLUMNS:
        return None if text_ok else text_mask(column, text_ok)
    if isinstance(kind, T.ArrayType):
        probe = _masked(F.lit(None), kind.elementType, "", raw_ok, text_ok)
        if probe is None:
            return None
        return F.transform(column, lambda e: _masked(e, kind.elementType, "", raw_ok, text_ok))
    if isinstance(kind, T.StructType):
        changed = {f.name: _masked(column[f.name], f.dataType, f.name, raw_ok, text_ok) for f in kind}
        if all(c is None for c in changed.values()):
            return None
        fields = [(column[n] if c is None else c).alias(n) for n, c in changed.items()]
        return F.when(column.isNotNull(), F.struct(*fields))
    return None


def apply_policy(df: DataFrame, groups: set[str]) -> DataFrame:
    """Mask every sensitive column by its name, at any depth of the schema."""
    raw_ok, text_ok = RAW_READERS in groups, TEXT_READERS in groups
    changed = {f.name: _masked(F.col(f.name), f.dataType, f.name, raw_ok, text_ok) for f in df.schema}
    return df.select(*[(F.col(n) if c is None else c.alias(n)) for n, c in changed.items()])


def sensitive_paths(schema: T.StructType) -> list[str]:
    """Dotted paths of all columns a policy covers."""

    def walk(kind: T.DataType, path: str, name: str) -> list[str]:
        if name in RAW_COLUMNS or name in TEXT_COLUMNS:
            return [path]
        if isinstance(kind, T.ArrayType):
            return walk(kind.elementType, path, "")
        if isinstance(kind, T.StructType):
            return [p for f in kind for p in walk(f.dataType, f"{path}.{f.name}".lstrip("."), f.name)]
        return []

    return walk(schema, "", "")


def register_mask_functions(spark) -> None:
    """The same masks as SQL functions; the viewer's groups come as an array argument."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION mask_raw_document(content BINARY, groups ARRAY<STRING>) "
        f"RETURNS BINARY RETURN IF(array_contains(groups, '{RAW_READERS}'), content, NULL)"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION mask_document_text(text STRING, groups ARRAY<STRING>) "
        f"RETURNS STRING RETURN IF(nullif(text, '') IS NULL OR array_contains(groups, '{TEXT_READERS}'), "
        f"text, '{K.RESTRICTED}')"
    )
