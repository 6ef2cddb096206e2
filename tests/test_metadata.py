import json

from pyspark.sql import functions as F

from modelspend import schemas as S
from modelspend.functions import metadata as M
from modelspend.functions.expressions import mentions

TEXTS = {
    "plain": '/* {"node_id": "n", "node_name": "m"} */ select 1',
    "prefixed": '/* team - {"node_id": "n"} */ select 1',
    "tight": '/*{"node_id": "n"}*/ select 1',
    "nested": '/* {"node_id": "n", "relation": {"database": "d"}} */ select 1',
    "second": '/* {"node_id": "n"} */ select /* {"node_id": "later"} */ 1',
    "broken": '/* {"node_id": "n", oops} */ select 1',
    "none": "select 1",
    "empty": "",
    "null": None,
    "number": '/* {"node_id": 5} */ select 1',
}


def node_ids(spark, column):
    df = spark.createDataFrame(list(TEXTS.items()), "k string, t string")
    return {r.k: r.v for r in df.select("k", column.alias("v")).collect()}


def test_any_comment(spark):
    got = node_ids(spark, M.extract_query_metadata(F.col("t"))["node_id"])
    assert got == dict.fromkeys(TEXTS, None) | {"plain": "n", "nested": "n", "second": "n", "number": "5"}


def test_object_comment_as_variant(spark):
    got = node_ids(spark, M.variant_text(M.extract_query_variant(F.col("t")), "node_id"))
    assert got == dict.fromkeys(TEXTS, None) | {"plain": "n", "nested": "n", "second": "n", "number": "5"}


def test_guarded_comment(spark):
    got = node_ids(spark, M.json_text(M.guarded_comment_json(F.col("t")), "node_id"))
    assert got == dict.fromkeys(TEXTS, None) | {
        "plain": "n", "nested": "n", "second": "n", "number": "5", "tight": "n",
    }


def test_lenient_mode_reads_prefixed_comments(spark):
    got = node_ids(spark, M.extract_query_metadata(F.col("t"), mode="lenient")["node_id"])
    assert got == dict.fromkeys(TEXTS, None) | {
        "plain": "n", "nested": "n", "second": "n", "number": "5", "tight": "n", "prefixed": "n",
    }


def test_mentions_is_like(spark):
    name = S.EXECUTIONS_TABLE
    texts = [f"a {name} b", name.replace("_", "X"), f"x\n{name}\n", name[4:], name.replace("_", "__"), name.upper(),
             "", None, name.replace("_", ".") + ".*"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for table in (S.EXECUTIONS_TABLE, "a%b", "x_", "a.c"):
        pattern = f"%{table}%"
        rows = df.select(mentions(F.col("t"), table).alias("got"), F.col("t").like(pattern).alias("want")).collect()
        assert [r.got for r in rows] == [r.want for r in rows], table


def build(spark, **values):
    schema = (
        "inv string, job string, run string, node struct<unique_id:string, name:string, package_name:string,"
        " database:string, schema:string, identifier:string>"
    )
    row = {"inv": "i", "job": "j", "run": "r", "node": None, **values}
    df = spark.createDataFrame([tuple(row.values())], schema)
    comment = M.query_comment_json(
        invocation_id=F.col("inv"), job_id=F.col("job"), run_id=F.col("run"), node=F.col("node")
    )
    return json.loads(df.select(comment.alias("c")).first().c)


def test_comment_without_node_is_internal(spark):
    assert build(spark) == {"invocation_id": "i", S.JOB_ID: "j", S.RUN_ID: "r", "node_id": "internal"}


def test_run_id_is_written_only_with_a_job_id(spark):
    assert build(spark, job=None, inv=None) == {"node_id": "internal"}


def test_comment_with_node_keeps_null_relation_parts(spark):
    node = ('model.p."q"', "m\\n", "p", None, "s", "t")
    assert build(spark, node=node) == {
        "invocation_id": "i",
        S.JOB_ID: "j",
        S.RUN_ID: "r",
        "node_id": 'model.p."q"',
        "node_name": "m\\n",
        "package_name": "p",
        "relation": {"database": None, "schema": "s", "identifier": "t"},
    }


def test_written_comments_are_read_back(spark):
    df = spark.createDataFrame([("i", "j", "r", "select 1")], "inv string, job string, run string, sql string")
    comment = M.query_comment_json(
        invocation_id=F.col("inv"),
        job_id=F.col("job"),
        run_id=F.col("run"),
        node=F.struct(
            *[F.lit(v).alias(k) for k, v in dict(
                unique_id="model.p.m", name="m", package_name="p", database="d", schema="s", identifier="m"
            ).items()]
        ),
    )
    tagged = M.with_query_comment(df, "sql", comment)
    for pattern in (M.COMMENT_PATTERN, M.OBJECT_COMMENT_PATTERN, M.SPACED_OBJECT_COMMENT_PATTERN):
        row = tagged.select(M.extract_query_metadata(F.col("query_text"), pattern).alias("m")).first().m
        assert (row.node_id, row.node_name, row[S.JOB_ID], row[S.RUN_ID]) == ("model.p.m", "m", "j", "r")
    assert tagged.first().query_text.endswith(" */ select 1")


def test_guard_wants_one_whole_value(spark):
    bad = ['{"a": 1} junk}', '{"a": 1}{}', '{"a": 1},{}', '{"a": 1}] x}', '{"a": tru}']
    texts = spark.createDataFrame([(f"/* {t} */ select 1",) for t in [*bad, '{"a": 1}']], "t string")
    assert texts.filter(M.guarded_comment_json(F.col("t")).isNotNull()).count() == 1
