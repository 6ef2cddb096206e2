"""Secret scans: multipart credential linking.

Strong forms (assignments, access ids, long hex strings) are secrets by
themselves.  Weak candidates are parts that mean nothing alone: account names,
random-looking tokens, endpoints.  A weak part is reported only when a
complementary part stands in its scope, ``REACH`` code points to either side:
a secret near an access identifier or endpoint, an access identifier or an
endpoint near a secret.  Strong findings count as parts.

One pass finds all parts of each whole text.  The interval join is between
parts and cells of ``REACH`` code points: a cell keeps the first and last part
of each role, which decides exactly whether one lies in a scope, so a text with
n parts costs n joined rows and never their pairs.

Edge cases: null text is empty; repeated rows each get their row; an empty
table gives no rows; columns of other names are ignored; texts are never cut.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelspend.llm import spans as SP
from modelspend.llm.shared import free_name, joined_bytes, read_table, row_key, stage, text_blocks
from modelspend.llm.words import word_bounds

REACH = 300
KINDS = ("assign", "access", "hex", "linked_access", "linked_secret", "linked_endpoint")
ROLES = ACCESS, SECRET, ENDPOINT = 0, 1, 2
BASE = 3
#: Role of each strong kind, then of each weak kind.
ROLE_OF = (SECRET, ACCESS, SECRET, ACCESS, SECRET, ENDPOINT)

#: Words of the patterns below; the prefilter looks for the same.
ASSIGN_WORDS = r"password|passwd|secret|token|api_?key"
ACCOUNT_WORDS = r"user(?:name|_id)?|login|account|client_?id|access_?key_?id"
PASSWORD_WORDS = r"pwd|pass|pw|passphrase|credential|auth"

ASSIGN = re.compile(
    rf"({ASSIGN_WORDS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
)
ACCESS_ID = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
ACCOUNT = re.compile(
    rf"\b(?:{ACCOUNT_WORDS})\b[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9._@+-]{{3,}})",
    re.I | re.A,
)
PASSWORD = re.compile(
    rf"\b(?:{PASSWORD_WORDS})\b[\"']?\x20*[:=]\x20*[\"']?([^\s\"']{{6,}})", re.I | re.A
)
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
URL = re.compile(r"\b(?:https?|s3|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|ftp)://[^\s\"'<>]{4,}", re.I | re.A)
#: Least entropy, bits per character, of a token that may be a secret.
MIN_ENTROPY = 3.5

RUN = 20
TOKEN_BYTES = np.zeros(256, bool)
TOKEN_BYTES[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"]] = True
#: In lower case; a text with none of these and no long run has no part.
HINT = re.compile(rf"(?:{ASSIGN_WORDS}|{ACCOUNT_WORDS}|{PASSWORD_WORDS})[\"']?\x20*[:=]|akia|://".encode())


def entropy(token: str) -> float:
    n = len(token)
    return -sum(c / n * math.log2(c / n) for c in Counter(token).values())


def random_looking(token: str) -> bool:
    return (
        any(c.isdigit() for c in token) and any(c.isalpha() for c in token) and entropy(token) >= MIN_ENTROPY
    )


def strong_parts(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed forms, leftmost and not overlapping within a kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in ACCESS_ID.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def weak_parts(text: str, strong: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Parts that need company; those that overlap a strong one are left to it."""
    found = [(m.start(1), 3, m.end(1)) for m in ACCOUNT.finditer(text)]
    found += [(m.start(1), 4, m.end(1)) for m in PASSWORD.finditer(text)]
    found += [(m.start(), 4, m.end()) for m in TOKEN.finditer(text) if random_looking(m[0])]
    found += [(m.start(), 5, m.end()) for m in URL.finditer(text)]
    out, taken = [], sorted((s, e) for s, _, e in strong)
    at, last = 0, {}
    reach = -1
    for part in sorted(found):
        while at < len(taken) and taken[at][0] < part[2]:
            reach = max(reach, taken[at][1])
            at += 1
        if reach <= part[0] and part[0] >= last.get(part[1], 0):
            out.append(part)
            last[part[1]] = part[2]
    return out


def worth_a_look(block: pa.RecordBatch) -> np.ndarray:
    """Which texts of a block can hold a part at all."""
    data, bounds = joined_bytes(block.column("text"))
    look = np.zeros(len(bounds) - 1, bool)
    raw = data.tobytes().lower()
    at = np.array([m.start() for m in HINT.finditer(raw)], np.int64)
    starts, ends, _ = word_bounds(data, bounds, TOKEN_BYTES)
    at = np.concatenate([at, starts[ends - starts >= RUN]])
    look[np.searchsorted(bounds, at, side="right") - 1] = True
    return look


PART = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))


def find_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in text_blocks(batches):
        look = worth_a_look(block)
        parts = [[] for _ in look]
        text = block.column("text")
        for i in np.flatnonzero(look):
            one = text[int(i)].as_py()
            strong = strong_parts(one)
            parts[i] = [dict(zip(("start", "kind", "end"), p, strict=True)) for p in strong + weak_parts(one, strong)]
        yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(parts, PART)], names=["doc_id", "parts"])


def scan(docs: DataFrame) -> DataFrame:
    """(row, doc_id, parts) for every row of ``docs``; ``row`` tells equal rows apart."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = docs.select("doc_id", "text").mapInArrow(find_parts, f"doc_id {kind}, parts {SP.SPANS}")
    return stage(parts.withColumn("row", F.monotonically_increasing_id()), "secrets")


def linked(scanned: DataFrame) -> DataFrame:
    """(row, linked): the weak parts of each row that have a complement in scope."""
    roles = F.array(*[F.lit(r) for r in ROLE_OF])
    # a single part, or parts of one role only, cannot be linked
    several = scanned.filter(F.size(F.array_distinct(F.transform("parts", lambda p: F.get(roles, p["kind"])))) > 1)
    parts = several.select("row", F.explode("parts").alias("p")).select("row", "p.*", F.get(roles, "p.kind").alias("role"))
    cell = lambda c: F.floor(c / REACH)
    cells = (
        parts.groupBy("row", cell(F.col("start")).alias("cell"), "role")
        .agg(F.min("start").alias("first"), F.max("start").alias("last"))
        .withColumnRenamed("role", "other")
    )
    scopes = parts.filter(F.col("kind") >= BASE).select(
        "row", "start", "kind", "end", "role", (F.col("start") - REACH).alias("low"), (F.col("end") + REACH).alias("high")
    )
    scopes = scopes.withColumn("cell", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high")))))
    complement = F.when(F.col("role") == SECRET, F.col("other") != SECRET).otherwise(F.col("other") == SECRET)
    # inner cells lie wholly in scope, the first and last are met by their last and first part
    inside = (F.col("last") >= F.col("low")) & (F.col("first") <= F.col("high"))
    met = scopes.join(cells, ["row", "cell"]).filter(complement & inside)
    span = F.struct("start", "kind", "end")
    return met.groupBy("row").agg(F.collect_set(span).alias("linked"))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """(row, doc_id, base, spans): strong spans, and all spans, of every row."""
    scanned = scan(docs)
    base = F.filter("parts", lambda p: p["kind"] < BASE)
    none = F.array().cast(SP.SPANS)
    joined = scanned.select("row", "doc_id", base.alias("base")).join(linked(scanned), "row", "left")
    return joined.select(
        "row", "doc_id", "base", F.sort_array(F.concat("base", F.coalesce("linked", none))).alias("spans")
    )


#: Stands for a secret in a redacted text.
REPLACEMENT = "[SECRET]"


def redacted(docs: DataFrame, replacement: str = REPLACEMENT) -> DataFrame:
    """All rows of ``docs``, every found secret replaced; ``n_chars``, where there is one, follows the text.

    Rows meet their spans by a hash of their content, which equal rows share as they share their spans.
    """
    key, hits = free_name(docs, "secret_key"), free_name(docs, "secret_spans")
    keyed = docs.withColumn(key, row_key("doc_id", "text"))
    found = scan_secrets(keyed.select(F.col(key).alias("doc_id"), "text")).filter(F.size("spans") > 0)
    found = found.select(F.col("doc_id").alias(key), F.col("spans").alias(hits)).dropDuplicates([key])
    joined = keyed.join(stage(found, "found"), key, "left")
    rest = lambda at, to: F.substring(F.col("text"), at + 1, to - at)
    text = F.aggregate(
        hits,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(acc["out"], rest(acc["at"], s["start"]), F.lit(replacement)))
            .otherwise(acc["out"])
            .alias("out"),
        ),
        lambda acc: F.concat(acc["out"], rest(acc["at"], F.length("text"))),
    )
    hit = F.col(hits).isNotNull()
    out = joined.withColumn("text", F.when(hit, text).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(hit, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def op10_linked_credentials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the strong spans, and all spans, of every document."""
    found = scan_secrets(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[SP.of_kind(F.col("base"), k).alias(f"n_{KINDS[k]}") for k in range(BASE)],
        F.sha2(SP.span_string(F.col("base"), KINDS), 256).alias("base_sha256"),
        SP.span_string(F.col("spans"), KINDS).alias("spans"),
    )
