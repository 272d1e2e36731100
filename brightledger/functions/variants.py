"""Semi-structured values: VARIANT paths, types and lateral flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbers import ColumnOrName, as_col

# Type names as they are reported for a semi-structured value, by Spark's name.
TYPE_NAMES = {
    "OBJECT": "OBJECT",
    "ARRAY": "ARRAY",
    "STRING": "VARCHAR",
    "BIGINT": "INTEGER",
    "DECIMAL": "DECIMAL",
    "DOUBLE": "DOUBLE",
    "FLOAT": "DOUBLE",
    "BOOLEAN": "BOOLEAN",
    "DATE": "DATE",
    "TIMESTAMP": "TIMESTAMP_LTZ",
    "TIMESTAMP_NTZ": "TIMESTAMP_NTZ",
    "BINARY": "BINARY",
    "VOID": "NULL_VALUE",
}


def at(v: ColumnOrName, path: str, type_name: str = "string") -> Column:
    """Value at a path such as ``profile.city`` or ``pages[0]``; NULL where absent or not castable."""
    return F.try_variant_get(as_col(v), f"$.{path}", type_name)


def array_size(v: ColumnOrName, path: str) -> Column:
    """Number of elements of the array at a path; NULL where there is none."""
    items = at(v, path, "array<variant>")
    return F.when(items.isNotNull(), F.size(items))


def type_of(v: ColumnOrName) -> Column:
    """Type name of a value; NULL where there is no value."""
    spark_name = F.regexp_extract(F.schema_of_variant(as_col(v)), "^([A-Z_]+)", 1)
    names = F.create_map(*[F.lit(x) for kv in TYPE_NAMES.items() for x in kv])
    return F.when(as_col(v).isNotNull(), F.coalesce(F.element_at(names, spark_name), spark_name))


def flatten(df: DataFrame, v: str, path: str | None = None, outer: bool = False, prefix: str = "f") -> DataFrame:
    """One row per element of the array (or field of the object) at a path.

    Adds ``<prefix>_index``, ``<prefix>_key``, ``<prefix>_path`` and ``<prefix>_value``. ``outer`` keeps rows
    that have nothing to flatten.
    """
    source = v if path is None else f"variant_get({v}, '$.{path}', 'variant')"
    fn = "variant_explode_outer" if outer else "variant_explode"
    root = "" if path is None else path
    sql = f"""
        SELECT s.*, x.pos AS {prefix}_index, x.key AS {prefix}_key,
          CASE WHEN x.key IS NOT NULL THEN concat('{root}', '.', x.key)
               WHEN x.pos IS NOT NULL THEN concat('{root}', '[', x.pos, ']') END AS {prefix}_path,
          x.value AS {prefix}_value
        FROM {{src}} s, LATERAL {fn}({source}) x"""
    return df.sparkSession.sql(sql, src=df)


def build_object(fields: dict[str, ColumnOrName], keep_null: bool = False) -> Column:
    """JSON object from columns; NULL fields are left out unless ``keep_null``."""
    row = F.struct(*[as_col(c).alias(name) for name, c in fields.items()])
    return F.to_json(row, {"ignoreNullFields": "false" if keep_null else "true"})


def array_slice(a: ColumnOrName, start: int, end: int) -> Column:
    """Elements from index ``start`` (0-based) up to but without ``end``."""
    return F.slice(as_col(a), start + 1, end - start)
