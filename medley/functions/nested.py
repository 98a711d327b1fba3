"""Nested data: structs, arrays and JSON text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def struct_text(col: Column) -> Column:
    """[X19] A struct as JSON text."""
    return F.to_json(col)


def parse_json(col: Column, schema: T.StructType | str) -> Column:
    """[X21] JSON text by schema; malformed text gives null fields, unknown fields are dropped."""
    return F.from_json(col, schema)


def json_field(col: Column, path: str) -> Column:
    """[X21] One field of JSON text by path, as text."""
    return F.get_json_object(col, path)


def item(col: Column, index: int) -> Column:
    """[X23] Array item by index, null past the end."""
    return F.get(col, index)


def field_of_items(col: Column, field: str) -> Column:
    """[X23, H04] One field of every struct in an array."""
    return F.transform(col, lambda x: x[field])


def flat_columns(schema: T.StructType, prefix: str = "") -> list[tuple[str, str]]:
    """(path, flat name) of every leaf below nested structs; arrays count as leaves."""
    out: list[tuple[str, str]] = []
    for field in schema.fields:
        path = f"{prefix}`{field.name}`"
        if isinstance(field.dataType, T.StructType):
            out += flat_columns(field.dataType, path + ".")
        else:
            out.append((path, path.replace("`", "").replace(".", "_")))
    return out


def flatten_structs(df: DataFrame) -> DataFrame:
    """[X22, H07] Struct fields as top-level columns, `a.b` named `a_b`, from the schema alone."""
    return df.select(*[F.col(path).alias(name) for path, name in flat_columns(df.schema)])


def flatten(df: DataFrame, parent_keys: Sequence[str], path: str, position: str = "position", outer: bool = True) -> DataFrame:
    """[K01, K02] One child table out of a nested frame: parent keys, position and child fields.

    `path` leads through structs and arrays (`refunds.transactions`); every array on the way is exploded
    with its positions. A missing or empty array gives one row with nulls (`outer`) or none. Struct children
    become columns with flat names, other children a column named after the path's last step.
    """
    frame = df.select(*parent_keys, F.col(path.split(".")[0]).alias("_node"))
    steps = path.split(".")
    positions: list[str] = []
    explode = F.posexplode_outer if outer else F.posexplode
    for depth, step in enumerate(steps):
        if depth:
            frame = frame.withColumn("_node", F.col("_node")[step])
        if isinstance(frame.schema["_node"].dataType, T.ArrayType):
            name = position if depth == len(steps) - 1 else f"{steps[depth]}_{position}"
            frame = frame.select(*parent_keys, *positions, explode("_node").alias(name, "_node"))
            positions.append(name)
    if not outer:
        frame = frame.filter(F.col("_node").isNotNull())
    node = frame.schema["_node"].dataType
    if isinstance(node, T.StructType):
        children = [
            F.col(f"_node.{leaf}").alias(name if name not in parent_keys else f"{steps[-1]}_{name}")
            for leaf, name in flat_columns(node)
        ]
    else:
        children = [F.col("_node").alias(steps[-1])]
    return frame.select(*parent_keys, *positions, *children)
