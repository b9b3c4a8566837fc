"""Types of source and destination columns.

A destination column is declared by its type text, as a columnar store spells it
(`Nullable(DateTime64(3))`, `UInt64`, ...). Nullability is a flag of its own here, so a
nullable column has the same base type, clamps and conversions as a plain one.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import types as T

_WRAPPERS = ("Nullable", "LowCardinality")
_PLAIN = {
    "Int8": T.ByteType(), "Int16": T.ShortType(), "Int32": T.IntegerType(), "Int64": T.LongType(),
    # unsigned types take the next wider signed one; 64 bits need a decimal
    "UInt8": T.ShortType(), "UInt16": T.IntegerType(), "UInt32": T.LongType(), "UInt64": T.DecimalType(20, 0),
    "Float32": T.FloatType(), "Float64": T.DoubleType(), "Bool": T.BooleanType(), "String": T.StringType(), "FixedString": T.StringType(),
    "UUID": T.StringType(), "Date": T.DateType(), "Date32": T.DateType(),
    "DateTime": T.TimestampType(), "DateTime32": T.TimestampType(), "DateTime64": T.TimestampType(),
    # objects are written as their text
    "Map": T.StringType(), "JSON": T.StringType(), "Object": T.StringType(), "Enum8": T.StringType(), "Enum16": T.StringType(),
}
_INTEGER_BITS = {"Int8": 8, "Int16": 16, "Int32": 32, "Int64": 64, "UInt8": 8, "UInt16": 16, "UInt32": 32, "UInt64": 64}


def base_name(type_text: str) -> str:
    """The type's name before its parameters."""
    return type_text.split("(", 1)[0].strip()


def unwrap(type_text: str) -> tuple[str, bool]:
    """The type inside nullability and dictionary wrappers, and whether it is nullable."""
    text, nullable = type_text.strip(), False
    while (name := base_name(text)) in _WRAPPERS:
        nullable |= name == "Nullable"
        text = text[text.index("(") + 1 : text.rindex(")")].strip()
    return text, nullable


@dataclass(frozen=True)
class TargetColumn:
    name: str
    type: str

    @cached_property
    def inner(self) -> str:
        return unwrap(self.type)[0]

    @cached_property
    def nullable(self) -> bool:
        return unwrap(self.type)[1]

    @property
    def base(self) -> str:
        return base_name(self.inner)

    @property
    def is_uint64(self) -> bool:
        return self.base == "UInt64"

    @property
    def is_int(self) -> bool:
        return self.base in _INTEGER_BITS

    @property
    def is_decimal(self) -> bool:
        return self.base.startswith("Decimal")

    @property
    def integer_range(self) -> tuple[int, int]:
        bits = _INTEGER_BITS[self.base]
        return (0, 2**bits - 1) if self.base[0] == "U" else (-(2 ** (bits - 1)), 2 ** (bits - 1) - 1)

    @cached_property
    def spark_type(self) -> T.DataType:
        if self.base == "Array":
            return T.ArrayType(TargetColumn(self.name, self.inner[len("Array(") : -1]).spark_type)
        if self.is_decimal:
            numbers = [int(n) for n in re.findall(r"\d+", self.inner[len("Decimal") :])]
            if self.base != "Decimal":  # Decimal32(s), Decimal64(s), Decimal128(s)
                return T.DecimalType({"32": 9, "64": 18, "128": 38}[self.base[7:]], numbers[-1])
            return T.DecimalType(*numbers)
        if self.base not in _PLAIN:
            raise ValueError(f"column {self.name}: unknown type {self.type}")
        return _PLAIN[self.base]


_TEXT = {"char", "varchar", "tinytext", "text", "mediumtext", "longtext", "binary", "varbinary", "tinyblob", "blob", "mediumblob", "longblob", "json", "time", "point", "geometry"}
_TEMPORAL = {"datetime": "timestamp", "timestamp": "timestamp", "date": "date"}


@dataclass(frozen=True)
class SourceColumn:
    """A source column: `type` as the source's catalog spells it, e.g. `decimal(10,2)`."""

    name: str
    type: str

    @property
    def base(self) -> str:
        return base_name(self.type).lower().split(" ")[0]

    @property
    def kind(self) -> str:
        """text, timestamp, date, decimal or plain (passed through)."""
        if self.base in _TEXT:
            return "text"
        if self.base in ("decimal", "numeric"):
            return "decimal"
        return _TEMPORAL.get(self.base, "plain")


@dataclass(frozen=True)
class SourceTable:
    name: str
    columns: tuple[SourceColumn, ...]
    pk: tuple[str, ...] = ()
    db: str = "appdb"

    @property
    def column_names(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.columns)


@dataclass(frozen=True)
class TargetTable:
    name: str
    columns: tuple[TargetColumn, ...] = field(default_factory=tuple)

    @cached_property
    def by_name(self) -> dict[str, TargetColumn]:
        return {c.name: c for c in self.columns}

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.spark_type, True, {"type": c.type}) for c in self.columns])

    @staticmethod
    def from_schema(name: str, schema: T.StructType) -> TargetTable:
        """Read back what `schema` wrote: declared types travel as column metadata."""
        return TargetTable(name, tuple(TargetColumn(f.name, f.metadata.get("type") or _spelled(f)) for f in schema.fields))


def _spelled(f: T.StructField) -> str:
    """A declared type for a column that has none."""
    names = {"byte": "Int8", "short": "Int16", "integer": "Int32", "long": "Int64", "float": "Float32", "double": "Float64", "boolean": "Bool", "date": "Date32", "timestamp": "DateTime64(6)", "timestamp_ntz": "DateTime64(6)", "string": "String"}
    if isinstance(f.dataType, T.DecimalType):
        inner = f"Decimal({f.dataType.precision}, {f.dataType.scale})"
    elif isinstance(f.dataType, T.ArrayType):
        inner = f"Array({_spelled(T.StructField('', f.dataType.elementType, False))})"
    else:
        inner = names.get(f.dataType.typeName(), "String")
    return f"Nullable({inner})" if f.nullable and not inner.startswith("Array") else inner
