"""Records of one schema brought to another: fields by name, defaults, widening, and rejects as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Numbers in the order in which each fits into the next.
_WIDER = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]
_FRACTIONS = (T.FloatType, T.DoubleType, T.DecimalType)
_NO_PROBLEMS = "cast(array() as array<string>)"


def resolved(
    df: DataFrame, schema: T.StructType | str, defaults: dict[str, str] | None = None, aliases: dict[str, list[str]] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` as records of ``schema``, and those that cannot be: ``record`` as JSON and its ``problems``.

    Fields meet by name, in nested records too (paths ``a.b``), or by one of their
    ``aliases``. A field that ``df`` does not have takes its ``default``, a SQL
    literal, else null. Numbers widen, and anything can be a text; other values
    are converted if nothing of them is lost. A row is rejected for a value that
    cannot be converted or a null where the schema allows none; it names every
    such field. Fields that the schema does not have are left out.
    """
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    value, problems = _record(row, df.schema, wanted, "", defaults or {}, aliases or {})
    both = df.select(F.to_json(row).alias("record"), value.alias("value"), problems.alias("problems"))
    good = both.where(F.size("problems") == 0).select("value.*")
    return good, both.where(F.size("problems") > 0).select("record", "problems")


def _record(row: Column, have: T.StructType, want: T.StructType, at: str, defaults: dict, aliases: dict) -> tuple[Column, Column]:
    fields, problems = [], []
    for field in want.fields:
        path = f"{at}{field.name}"
        held = next((n for n in (field.name, *aliases.get(path, [])) if n in have.names), None)
        if held is None:
            value = F.expr(defaults[path]).cast(field.dataType) if path in defaults else F.lit(None).cast(field.dataType)
            found = F.expr(_NO_PROBLEMS)
        else:
            value, found = _value(row.getField(held), have[held].dataType, field.dataType, path, defaults, aliases)
        if not field.nullable:
            # A value that could not be converted has a problem already.
            missing = value.isNull() & (F.size(found) == 0)
            found = F.concat(found, F.when(missing, F.array(F.lit(f"{path}: no value"))).otherwise(F.expr(_NO_PROBLEMS)))
        fields.append(value.alias(field.name))
        problems.append(found)
    whole = F.concat(*problems) if problems else F.expr(_NO_PROBLEMS)
    return (F.when(row.isNotNull(), F.struct(*fields)), F.when(row.isNotNull(), whole).otherwise(F.expr(_NO_PROBLEMS)))


def _value(value: Column, have: T.DataType, want: T.DataType, at: str, defaults: dict, aliases: dict) -> tuple[Column, Column]:
    """A value as the wanted type, and the problems there are with it."""
    none = F.expr(_NO_PROBLEMS)
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        return _record(value, have, want, f"{at}.", defaults, aliases)
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        part = lambda x, i: _value(x, have.elementType, want.elementType, at, defaults, aliases)[i]
        return F.transform(value, lambda x: part(x, 0)), F.coalesce(F.flatten(F.transform(value, lambda x: part(x, 1))), none)
    if isinstance(have, T.MapType) and isinstance(want, T.MapType) and have.keyType == want.keyType:
        part = lambda x, i: _value(x, have.valueType, want.valueType, at, defaults, aliases)[i]
        values = F.transform_values(value, lambda _, x: part(x, 0))
        return values, F.coalesce(F.flatten(F.map_values(F.transform_values(value, lambda _, x: part(x, 1)))), none)
    if have == want:
        return value, none
    nested = (T.StructType, T.ArrayType, T.MapType)
    if isinstance(have, nested) or isinstance(want, nested):
        if isinstance(want, T.StringType):
            return F.to_json(value), none
        bad = F.when(value.isNotNull(), F.array(F.lit(f"{at}: {have.simpleString()} is no {want.simpleString()}"))).otherwise(none)
        return F.lit(None).cast(want), bad
    cast = value.try_cast(want)
    kinds = [next((i for i, k in enumerate(_WIDER) if isinstance(t, k)), None) for t in (have, want)]
    if isinstance(want, T.StringType) or (None not in kinds and kinds[0] <= kinds[1]):
        return cast, none
    lost = cast.isNull()
    if isinstance(have, (*_WIDER, T.DecimalType)) and isinstance(want, (*_WIDER, T.DecimalType)) or isinstance(have, T.TimestampType):
        back = T.DoubleType() if isinstance(have, _FRACTIONS) and not isinstance(have, T.DecimalType) else have
        lost = lost | (cast.cast(back) != value.cast(back))
    elif isinstance(have, T.StringType) and isinstance(want, T.DecimalType):
        # Reading a text rounds it to the scale.
        whole = T.DecimalType(38, 18)
        lost = lost | (cast.cast(whole) != value.try_cast(whole))
    text = F.concat(F.lit(f"{at}: "), value.cast("string"), F.lit(f" is no {want.simpleString()}"))
    return F.when(~lost, cast), F.when(value.isNotNull() & lost, F.array(text)).otherwise(none)
