"""Query metadata: JSON in a SQL comment, written before a run and read back from history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelspend import schemas as S
from modelspend.functions.run_ids import with_run_ids
from modelspend.functions.tracking_json import json_member, json_object

# Comment patterns per history flavour (group 1 is the JSON text).
COMMENT_PATTERN = r"/\* (.*?) \*/"
OBJECT_COMMENT_PATTERN = r"/\* (\{.*?\}) \*/"
SPACED_OBJECT_COMMENT_PATTERN = r"/\*\s*(\{.*?\})\s*\*/"
INTERNAL_NODE = "internal"

# Skips any prefix such as "team name - " before the JSON object.
LENIENT_COMMENT_PATTERN = r"/\*[^{]*?(\{.*?\})\s*\*/"

MODES = ("reference", "lenient")


def comment_json(text: Column, pattern: str = COMMENT_PATTERN, mode: str = "reference") -> Column:
    """The first comment's JSON text, NULL when there is none."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if mode == "lenient":
        pattern = LENIENT_COMMENT_PATTERN
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def extract_query_metadata(
    text: Column, pattern: str = COMMENT_PATTERN, mode: str = "reference"
) -> Column:
    """Comment metadata as a struct, parsed once; fields are NULL when absent or not JSON."""
    return F.from_json(comment_json(text, pattern, mode), S.QUERY_METADATA)


def extract_query_variant(
    text: Column, pattern: str = OBJECT_COMMENT_PATTERN, mode: str = "reference"
) -> Column:
    """Comment metadata as a VARIANT, for keys outside the fixed set."""
    return F.try_parse_json(comment_json(text, pattern, mode))


def variant_text(variant: Column, key: str) -> Column:
    return F.try_variant_get(variant, f"$.{key}", "string")


def json_pair(raw: Column) -> Column:
    """Text as the first of two elements of a JSON array, parsed; NULL if that is no JSON."""
    return F.try_parse_json(F.concat(F.lit("["), raw, F.lit(',"end"]')))


def is_alone(pair: Column) -> Column:
    """Was the text one whole value?  Anything after it breaks the array or moves its end mark."""
    return (F.try_variant_get(pair, "$[1]", "string") == "end") & F.try_variant_get(pair, "$[2]", "string").isNull()


def guarded_comment_json(
    text: Column, pattern: str = SPACED_OBJECT_COMMENT_PATTERN, mode: str = "reference"
) -> Column:
    """The comment's JSON text if it is one whole JSON value, else NULL; the parser alone ignores what follows a value."""
    raw = comment_json(text, pattern, mode)
    return F.when(is_alone(json_pair(raw)), raw)


def json_text(json: Column, key: str) -> Column:
    return F.get_json_object(json, f"$.{key}")


def query_comment_json(
    *,
    invocation_id: Column,
    job_id: Column,
    run_id: Column,
    node: Column | None = None,
) -> Column:
    """The comment JSON for one statement.

    Absent or empty invocation and job ids are left out; the run id is written only next
    to a job id.  ``node`` is a struct (unique_id, name, package_name, database,
    schema, identifier); without one the statement is marked internal.
    """

    def optional(name: str, value: Column) -> Column:
        return F.when(value != "", json_member(name, value))

    internal = json_member("node_id", F.lit(INTERNAL_NODE))
    if node is None:
        node_members = [internal]
    else:
        present = node.isNotNull()
        relation = F.struct(
            node["database"].alias("database"),
            node["schema"].alias("schema"),
            node["identifier"].alias("identifier"),
        )
        node_members = [
            F.when(present, json_member("node_id", node["unique_id"], True)).otherwise(internal),
            F.when(present, json_member("node_name", node["name"], True)),
            F.when(present, json_member("package_name", node["package_name"], True)),
            F.when(present, json_member("relation", relation, True)),
        ]
    members = [
        optional("invocation_id", invocation_id),
        optional(S.JOB_ID, job_id),
        F.when(job_id != "", json_member(S.RUN_ID, run_id, True)),
        *node_members,
    ]
    return json_object(*members)


def with_run_comment(df: DataFrame, sql: str, node: str, out: str = "query_text") -> DataFrame:
    """Prefix statements with their run's comment, ids as the run is recorded with.

    The rows have the run's ``invocation_id``, ``run_started_at`` and given run and job id;
    ``node`` names the struct column of :func:`query_comment_json`, NULL for internal statements.
    """
    ids = with_run_ids(df)
    comment = query_comment_json(
        invocation_id=F.col("invocation_id"), job_id=F.col(S.JOB_ID), run_id=F.col(S.RUN_ID), node=F.col(node)
    )
    return with_query_comment(ids, sql, comment, out)


def with_query_comment(df: DataFrame, sql: str, comment: Column, out: str = "query_text") -> DataFrame:
    """Prefix the statement in column ``sql`` with its metadata comment."""
    return df.withColumn(out, F.concat(F.lit("/* "), comment, F.lit(" */ "), F.col(sql)))
