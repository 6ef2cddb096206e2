"""The LSH forest against all pairs of sets."""

import re
from itertools import combinations

import numpy as np
import pandas as pd
import pytest

from modelspend.llm import op11_lsh_forest as O11
from modelspend.llm.registry import QUERIES

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORDS.findall((text or "").encode().lower().decode())
    return frozenset(tuple(words[j : j + 3]) for j in range(max(1, len(words) - 2))) if words else frozenset()


def expected(rows):
    """(doc_id, set size, component) of every row, by comparing all distinct sets."""
    sets = [shingles(t) for _, t in rows]
    distinct = list({s for s in sets if s})
    root = {s: s for s in distinct}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    for a, b in combinations(distinct, 2):
        if 100 * min(len(a), len(b)) >= 85 * max(len(a), len(b)):
            both = len(a & b)
            if 100 * both >= 85 * (len(a) + len(b) - both):
                root[find(a)] = find(b)
    least = {}
    for (doc, _), s in zip(rows, sets, strict=True):
        if s and doc is not None:
            least[find(s)] = min(doc, least.get(find(s), doc))
    return sorted(
        ((doc, len(s), least.get(find(s)) if s else doc) for (doc, _), s in zip(rows, sets, strict=True)),
        key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0),
    )


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0))


def crowd(copies=220, bases=5, seed=4):
    """Texts that share most of a template: some close enough to link, most not quite."""
    rng = np.random.default_rng(seed)
    template = [f"w{i}" for i in range(120)]
    rows = []
    for doc in range(copies):
        words = list(template)
        words[:20] = [f"base{doc % bases}x{i}" for i in range(20)]
        for at in rng.choice(120, rng.integers(0, 5), replace=False):
            words[at] = f"own{doc}x{at}"
        rows.append((1000 + doc, " ".join(words)))
    return rows


def test_query(spark, corpus, docs):
    rows = QUERIES["op11_lsh_forest"](spark, corpus)
    assert got(rows) == expected([(int(d), t) for d, t in docs])
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows.collect())


@pytest.mark.parametrize(("window", "block"), [(2, 7), (16, 50), (512, 2048)])
def test_crowded_regions_lose_no_link(spark, window, block):
    """A window far below the region's size leaves the rest to the blocks."""
    rows = crowd()
    rows += [(5000, None), (None, rows[3][1]), (None, "only without id"), (5001, " "), (5002, "two words"), (5003, "Two  WORDS"), rows[7]]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS node", "2 AS n", "'x' AS text_key")
    frame = frame.repartition(6)
    assert got(O11.group_documents(frame, window, block)) == expected(rows)


def test_regions_cut_by_partitions(spark):
    """More partitions than regions, so most regions lie in several."""
    rows = crowd(150, 1, 9)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(O11.group_documents(frame, 64)) == expected(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    items = rng.integers(0, 2**64, 2000, dtype=np.uint64)
    for share in (0.5, 0.85, 0.95):
        common = int(len(items) * share)
        rest = (len(items) - common) // 2
        a, b = items[: common + rest], np.concatenate([items[:common], items[common + rest :]])
        one, two = O11.signatures([np.sort(a), np.sort(b)])
        assert abs((one == two).mean() - common / len(items)) < 0.13


def test_recall_of_the_forest_alone(spark):
    """Pairs of similarity 0.85 and more, one pair a template: nothing but the forest finds them."""
    rng = np.random.default_rng(8)
    rows = []
    for pair in range(200):
        words = [f"p{pair}w{i}" for i in range(160)]
        other = list(words)
        for at in rng.choice(160, 4, replace=False):
            other[at] = "changed"
        rows += [(2 * pair, " ".join(words)), (2 * pair + 1, " ".join(other))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(O11.group_documents(frame)) == expected(rows)


def test_given_documents(spark):
    table = pd.read_parquet("/root/testdata/sf0.01/documents.parquet")
    rows = list(zip(table.doc_id.tolist(), table.text, strict=True))
    assert got(QUERIES["op11_lsh_forest"](spark, "/root/testdata/sf0.01")) == expected(rows)
