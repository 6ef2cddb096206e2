"""JSON payloads of the tracking tables, built with ``to_json``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelspend import schemas as S

KEEP_NULLS = {"ignoreNullFields": "false"}

# Node config keys that are recorded, in order after the node id.
CONFIG_KEYS = ("group", "tags", "persist_docs", "description", "meta")


def iso_strings(value: Column, dtype: T.DataType) -> Column:
    """Dates and timestamps, at any depth, as ISO 8601 text; the rest unchanged.

    The rewrite follows the schema, so it adds only built-in expressions.
    """
    if isinstance(dtype, T.StructType):
        fields = [iso_strings(value[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda item: iso_strings(item, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(value, lambda _, item: iso_strings(item, dtype.valueType))
    if isinstance(dtype, T.DateType):
        return value.cast("string")
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        offset = "xxx" if isinstance(dtype, T.TimestampType) else ""
        whole = F.extract(F.lit("SECOND"), value) % 1 == 0
        return F.when(whole, F.date_format(value, f"yyyy-MM-dd'T'HH:mm:ss{offset}")).otherwise(
            F.date_format(value, f"yyyy-MM-dd'T'HH:mm:ss.SSSSSS{offset}")
        )
    return value


def _has_time(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_has_time(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _has_time(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return _has_time(dtype.valueType)
    return isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType))


def _normalized(value: Column, dtype: T.DataType) -> Column:
    return iso_strings(value, dtype) if _has_time(dtype) else value


def node_config_json(node: Column, node_type: T.StructType) -> Column:
    """The recorded configuration of a node.

    * a plain ``config`` struct gives the node id and the recorded keys;
    * else a ``config_object`` field (struct, map, variant or any other type
      ``to_json`` takes) gives the whole configuration;
    * else a constant says that it could not be serialized.
    """
    candidates = []
    if "config" in node_type.names:
        config_type = node_type["config"].dataType
        config = node["config"]
        members = [node["unique_id"].alias("unique_id")]
        for key in CONFIG_KEYS:
            if key in config_type.names:
                value = _normalized(config[key], config_type[key].dataType)
            else:
                value = F.lit(None).cast("string")
            members.append(value.alias(key))
        candidates.append(F.when(config.isNotNull(), F.to_json(F.struct(*members), KEEP_NULLS)))
    if "config_object" in node_type.names:
        whole = _normalized(node["config_object"], node_type["config_object"].dataType)
        candidates.append(F.to_json(whole, KEEP_NULLS))
    return F.coalesce(*candidates, F.lit(S.UNSERIALIZABLE_CONFIG))


def json_member(name: str, value: Column, keep_null: bool = False) -> Column:
    """One ``"name":value`` member of a JSON object, as text."""
    text = F.to_json(F.struct(value.alias(name)), KEEP_NULLS if keep_null else {})
    return text.substr(F.lit(2), F.length(text) - 2)


def json_object(*members: Column) -> Column:
    """A JSON object from member texts; NULL members are left out."""
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def run_context_json(columns: dict[str, Column]) -> Column:
    """The run context with every key present; unset ones get their default text.

    ``invocation_args`` may be JSON text, which is then embedded as it is rather
    than as a quoted string.
    """
    members = []
    for key, default in S.RUN_CONTEXT_KEYS.items():
        value = columns[key]
        if default is not None:
            value = F.coalesce(value, F.lit(default))
        member = json_member(key, value, keep_null=True)
        if key == "invocation_args":
            embedded = F.concat(F.lit(f'"{key}":'), value)
            member = F.when(F.try_parse_json(value).isNotNull(), embedded).otherwise(member)
        members.append(member)
    return json_object(*members)
