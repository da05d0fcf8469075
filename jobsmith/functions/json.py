"""JSON helpers over VARIANT values (shape-tolerant, Python-truthiness aware)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobsmith.functions.text import as_col


def let(value: Column, fn) -> Column:
    """``fn(value)`` with ``value`` bound once: ``fn`` may use its argument many
    times without the optimizer copying ``value``'s expression into each use."""
    return F.transform(F.array(value), fn)[0]


def vget(v: Column, path: str, typ: str = "variant") -> Column:
    return F.try_variant_get(v, path, typ)


def kind(v: Column) -> Column:
    """Type name of a variant value ('STRING', 'BIGINT', 'OBJECT<...>', 'VOID', ...)."""
    return F.schema_of_variant(v)


def is_object(v: Column) -> Column:
    return F.coalesce(kind(v).startswith("OBJECT"), F.lit(False))


def truthy(v: Column) -> Column:
    """Python truthiness of a decoded JSON value; missing and null are falsy."""
    return let(v, _truthy)


def _truthy(v: Column) -> Column:
    k = kind(v)
    s = vget(v, "$", "string")
    return (F.when(v.isNull() | (k == "VOID") | s.isNull(), F.lit(False))
            .when(k == "STRING", s != "")
            .when(k == "BOOLEAN", s == "true")
            .when(k.startswith("OBJECT") | k.startswith("ARRAY"), ~s.isin("{}", "[]"))
            .otherwise(F.coalesce(vget(v, "$", "double") != 0, F.lit(True))))


def text_of(v: Column) -> Column:
    """``str(value)`` for a truthy value, NULL for a falsy one."""
    return let(v, _text_of)


def _text_of(v: Column) -> Column:
    k = kind(v)
    s = vget(v, "$", "string")
    py = F.when(k == "BOOLEAN", F.when(s == "true", F.lit("True")).otherwise(F.lit("False"))).otherwise(s)
    return F.when(_truthy(v), py)


def first_truthy(*vs: Column) -> Column:
    """``a or b or c`` on variant values (the last one is returned as is)."""
    def pick(rest: Column):
        return lambda x: F.when(_truthy(x), x).otherwise(rest)

    out = vs[-1]
    for v in reversed(vs[:-1]):
        out = let(v, pick(out))
    return out


def object_or_scalar(v: Column, key: str) -> Column:
    """``v.get(key)`` when ``v`` is an object, else ``v`` itself, as falsy-aware text."""
    return let(v, lambda x: F.when(is_object(x), _text_of(vget(x, f"$.{key}"))).otherwise(_text_of(x)))


def decode(c: Column | str) -> Column:
    """JSON text -> VARIANT (NULL on malformed input)."""
    return F.try_parse_json(as_col(c))


def encode(c: Column | str) -> Column:
    """struct/array/map -> compact JSON text, non-ASCII kept."""
    return F.to_json(as_col(c))
