"""Field names and types: rename, trim, cast, complete and trim down to the canonical fields.

Everything is a projection.  Casts never fail inside a task: values that do not convert become NULL
and are counted by ``cast_failures``, which the gate reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.layers import Layer, union_all

# Canonical type names and the date formats tried in turn.
TYPES = {"str": "string", "int": "bigint", "float": "double", "datetime": "timestamp_ntz"}
DATE_FORMATS = ("yyyy-MM-dd HH:mm", "yyyy/MM/dd", "yyyy/MM/dd HH:mm:ss", "MM/dd/yyyy", "MM/dd/yyyy HH:mm:ss", "dd.MM.yyyy")

_EDGE_SPACE = "(?U)^\\s+|\\s+$"


def rename_fields(df: DataFrame, field_map: dict[str, str]) -> DataFrame:
    """Rename by map; unknown names are ignored, a clash of two columns is refused."""
    names = [field_map.get(c, c) for c in df.columns]
    doubled = sorted({n for n in names if names.count(n) > 1})
    if doubled:
        raise ValueError(f"renaming gives several columns the same name: {doubled}")
    return df.withColumnsRenamed(field_map)


def normalize_text(df: DataFrame, null_text: bool = False) -> DataFrame:
    """Strip white space (any Unicode kind) from text columns.  NULL stays NULL; ``null_text`` turns it
    into the text ``None``."""
    columns = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            trimmed = F.regexp_replace(F.col(field.name), _EDGE_SPACE, "")
            columns[field.name] = F.coalesce(trimmed, F.lit("None")) if null_text else trimmed
    return df.withColumns(columns) if columns else df


def cast_value(c: Column, target: str, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """Value in the canonical type, NULL where it does not convert."""
    if target not in TYPES:
        raise ValueError(f"unknown field type '{target}'; use one of {list(TYPES)}")
    if target == "str":
        return c.cast("string")
    if target == "float":
        return c.cast("string").try_cast("double")
    if target == "int":
        number = c.cast("string").try_cast("double")
        whole = c.cast("string").try_cast("bigint")
        return F.when(whole.isNotNull(), whole).when(number == F.floor(number), number.try_cast("bigint"))
    tries = [F.to_timestamp_ntz(F.when(F.try_to_timestamp(c.cast("string"), F.lit(f)).isNotNull(), c.cast("string")), F.lit(f))
             for f in formats]
    # ISO dates and times, with fractions or a zone (which is dropped), then the formats.
    return F.coalesce(c.cast("string").try_cast("timestamp_ntz"), *tries)


def field_type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def cast_field(df: DataFrame, name: str, target: str) -> DataFrame:
    """Convert one column; dates that do not parse become NULL, bad numbers are left to the gate."""
    if target in TYPES and field_type(df, name) == TYPES[target]:
        return df
    if target == "datetime" and isinstance(df.schema[name].dataType, (T.TimestampType, T.DateType)):
        return df.withColumn(name, F.col(name).cast(TYPES[target]))
    return df.withColumn(name, cast_value(F.col(name), target))


def cast_failures(df: DataFrame, fields: dict[str, str], kinds: tuple[str, ...] = ("int", "float")) -> DataFrame:
    """One row per field of these kinds: values that do not convert, and one of them.  Dates that don't parse
    become NULL without failing the gate; ``kinds=("datetime",)`` counts them."""
    checked = {n: t for n, t in fields.items() if t in kinds and n in df.columns}
    if not checked:
        return df.sparkSession.createDataFrame([], "field string, target string, n_bad bigint, sample string")
    aggregates = []
    for name, target in checked.items():
        bad = F.col(name).isNotNull() & cast_value(F.col(name), target).isNull()
        aggregates.append(F.struct(F.lit(name).alias("field"), F.lit(target).alias("target"),
                                   F.count_if(bad).alias("n_bad"),
                                   F.min(F.when(bad, F.col(name).cast("string"))).alias("sample")))
    return df.agg(F.array(*aggregates).alias("_f")).select(F.inline("_f"))


def complete_fields(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Add canonical fields the layer lacks as typed NULL columns."""
    for name, target in fields.items():
        if target not in TYPES:
            raise ValueError(f"unknown field type '{target}'; use one of {list(TYPES)}")
    return df.withColumns({n: F.lit(None).cast(TYPES[t]) for n, t in fields.items() if n not in df.columns})


def keep_fields(df: DataFrame, fields: dict[str, str], key: tuple[str, ...] = ()) -> DataFrame:
    """Canonical fields and the geometry, in the layer's order; row keys stay when asked for."""
    kept = set(fields) | {"geometry"} | set(key)
    return df.select(*[c for c in df.columns if c in kept]) if fields else df


def harmonize_layer(df: DataFrame, field_map: dict[str, str], fields: dict[str, str],
                    drop_extra: bool = False, null_text: bool = False, key: tuple[str, ...] = ()) -> DataFrame:
    """Rename, trim, cast or create, drop: one chain of projections that Catalyst collapses."""
    df = normalize_text(rename_fields(df, field_map), null_text)
    for name, target in fields.items():
        if name in df.columns:
            df = cast_field(df, name, target)
    df = complete_fields(df, fields)
    return keep_fields(df, fields, key) if drop_extra else df


def check_casts(layers: dict[str, Layer], field_maps: dict[str, dict[str, str]], fields: dict[str, str]) -> None:
    """Gate: one action over all layers; reports every field with values that do not convert."""
    reports = []
    for name, layer in layers.items():
        prepared = normalize_text(rename_fields(layer.df, field_maps.get(name, {})))
        reports.append(cast_failures(prepared, fields).withColumn("layer", F.lit(name)))
    bad = union_all(reports).filter("n_bad > 0").collect() if reports else []
    if bad:
        raise ValueError("; ".join(
            f"layer '{r['layer']}': column '{r['field']}' has {r['n_bad']} values that are not {r['target']}, "
            f"such as '{r['sample']}'" for r in bad))


def harmonize_layers(layers: dict[str, Layer], field_maps: dict[str, dict[str, str]], fields: dict[str, str],
                     drop_extra: bool = False, check: bool = True) -> dict[str, Layer]:
    """The schema stage over a layer set."""
    if check and fields:
        check_casts(layers, field_maps, fields)
    return {name: layer.with_df(harmonize_layer(layer.df, field_maps.get(name, {}), fields, drop_extra, key=layer.key))
            for name, layer in layers.items()}
