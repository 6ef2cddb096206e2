"""SimHash near-dedup: BK-trees over shards of fingerprints.

Each text's 64-bit fingerprint takes the majority of each bit over the hashes of
its word shingles.  Fingerprints within ``RADIUS`` differing bits are linked;
linked texts share a component, named by its smallest doc_id.

Equal fingerprints are one entry from the start.  By the pigeonhole principle
two entries within 4 bits agree on at least two of six bands of bits, so each
entry goes to the 15 shards of its pairs of bands, and every link lies in some
shard.  Where entries are so many that a usual shard of 21 bits would outgrow one tree
(some two billion), seven bands with three alike, and so on, make smaller shards.  A shard of more than ``TREE`` entries, which is where thousands of near
copies meet, is split into blocks; each pair of its blocks is a unit of work of
bounded size on its own, so no link is lost and no task gets the whole shard.
In each unit a BK-tree is built, in which a child hangs at the
integer Hamming distance to its parent, and a search follows only the edges
whose distance is within the radius.  A subtree already wholly linked to the
searching entry is passed over, so dense groups cost few visits and give a
spanning forest of links instead of all pairs.  The shard is what is shipped to
the tasks; a tree for the whole corpus could not be sent around.

Components come from the alternating star contraction over the links, each
round stored in the shared folder.

Edge cases: null and wordless texts have fingerprint zero and link like any
other; equal rows share a component; a null doc_id never names a component of
rows with ids; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelspend.llm.shared import free_name, read_table, stage, text_blocks

SHINGLE = 4
SEED = 42
RADIUS = 4
#: Least bands of bits; all but as many as the radius are alike in a linked pair.
LEAST_BANDS = RADIUS + 2
UNSIGNED = (1 << 64) - 1
#: Most entries of one tree.
TREE = 1024


# ----------------------------------------------------------------- fingerprints


def shingle_hashes(text: bytes, size: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of every word shingle of a lower-cased text."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)], np.uint64)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-size]]).tolist()
    digest = xxhash.xxh64_intdigest
    n = len(starts)
    return np.fromiter(
        (digest(line[a:b], seed) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist(), strict=True)), np.uint64, n
    )


def fingerprint(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at : at + 8192].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprint_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in text_blocks(batches):
        found = [fingerprint(shingle_hashes(t.as_buffer().to_pybytes())) for t in block.column("text")]
        prints = pa.array(np.array(found, np.uint64).view(np.int64))
        yield pa.RecordBatch.from_arrays([block.column("doc_id"), prints], names=["doc_id", "print"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, print) of every row."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("print", T.LongType())])
    return docs.select("doc_id", "text").mapInArrow(fingerprint_rows, schema)


# ------------------------------------------------------------------------ trees


class Tree:
    """A BK-tree over integers that keeps track of which of them are linked."""

    def __init__(self, radius: int):
        self.radius = radius
        self.value: list[int] = []
        self.children: list[dict[int, int]] = []
        self.parent: list[int] = []
        #: A component that the whole subtree belongs to; -1: several.
        self.whole: list[int] = []
        self.joined: list[int] = []

    def find(self, a: int) -> int:
        while self.joined[a] != a:
            self.joined[a] = self.joined[self.joined[a]]
            a = self.joined[a]
        return a

    def add(self, value: int) -> list[int]:
        """Insert ``value``; the entries it links to, one of each component at least."""
        new = len(self.value)
        self.value.append(value)
        self.children.append({})
        self.joined.append(new)
        self.whole.append(new)
        self.parent.append(-1)
        if not new:
            return []
        links, todo, radius = [], [0], self.radius
        while todo:
            node = todo.pop()
            whole = self.whole[node]
            if whole >= 0 and self.find(whole) == self.find(new):
                continue
            d = (self.value[node] ^ value).bit_count()
            if d <= radius and self.find(node) != self.find(new):
                links.append(node)
                self.joined[self.find(node)] = self.find(new)
            for edge, child in self.children[node].items():
                if d - radius <= edge <= d + radius:
                    todo.append(child)
        self.hang(new)
        return links

    def hang(self, new: int) -> None:
        """Put the new entry below the node whose edge of its distance is free."""
        node, value = 0, self.value[new]
        while True:
            d = (self.value[node] ^ value).bit_count()
            below = self.children[node].get(d)
            if below is None:
                self.children[node][d] = new
                self.parent[new] = node
                break
            node = below
        # on the way up, note subtrees of one component, and others as mixed
        while node >= 0:
            own = self.find(node)
            same = all(
                self.whole[c] >= 0 and self.find(self.whole[c]) == own for c in self.children[node].values()
            )
            self.whole[node] = own if same else -1
            node = self.parent[node]


def tree_links(values: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links among ``values`` within ``radius``, a spanning forest of all of them."""
    tree, out = Tree(radius), []
    for value in values:
        out += [(tree.value[node], value) for node in tree.add(value)]
    return out


def unit_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each unit of work; a unit's rows come one after another."""
    key: tuple | None = None
    values: list[int] = []
    out: list[tuple[int, int]] = []

    def rows() -> pa.RecordBatch:
        a, b = zip(*out, strict=True) if out else ((), ())
        out.clear()
        pair = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (a, b)]
        return pa.RecordBatch.from_arrays(pair, names=["a", "b"])

    for batch in batches:
        for *unit, value in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if unit != key:
                out += tree_links(values)
                key, values = unit, []
                if len(out) > 10_000:
                    yield rows()
            values.append(value & UNSIGNED)
    out += tree_links(values)
    yield rows()


def band_count(entries: int, tree: int = TREE) -> int:
    """Bands at which a usual shard of so many entries fits one tree."""
    bands = LEAST_BANDS
    while entries >> 64 * (bands - RADIUS) // bands > tree and bands < 16:
        bands += 1
    return bands


def shard_keys(bands: int) -> list[Column]:
    """One key for each choice of the bands that may be alike: the choice's number, then its bits."""
    limits = [64 * i // bands for i in range(bands + 1)]
    widths = [b - a for a, b in pairwise(limits)]
    out = []
    for number, choice in enumerate(combinations(range(bands), bands - RADIUS)):
        key = F.lit(number).cast("long")
        for i in choice:
            part = F.shiftrightunsigned("print", limits[i]).bitwiseAND((1 << widths[i]) - 1)
            key = F.shiftleft(key, widths[i]).bitwiseOR(part)
        out.append(key)
    return out


def links(prints: DataFrame, bands: int = LEAST_BANDS) -> DataFrame:
    """(a, b): links between distinct fingerprints, enough of them to connect all that are within the radius."""
    keys = shard_keys(bands)
    entries = prints.select("print", F.explode(F.array(*keys)).alias("shard"))
    sizes = entries.groupBy("shard").agg(F.count("*").alias("n")).filter("n > 1")
    entries = entries.join(sizes, "shard")
    blocks = F.ceil(F.col("n") / TREE).cast("int")
    entries = entries.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int"))
    # pairs of blocks; two blocks or one make a single unit
    other = F.when(F.col("blocks") <= 2, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: b != F.col("own"))
    )
    entries = entries.withColumn("other", F.explode(other))
    low = F.when(F.col("blocks") <= 2, 0).otherwise(F.least("own", "other"))
    high = F.when(F.col("blocks") <= 2, 0).otherwise(F.greatest("own", "other"))
    units = entries.select("shard", low.alias("low"), high.alias("high"), "print")
    parts = units.repartition("shard", "low", "high").sortWithinPartitions("shard", "low", "high", "print")
    return parts.mapInArrow(unit_links, "a bigint, b bigint").distinct()


# ------------------------------------------------------------------- components


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a, b) is connected to."""
    edges = edges.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).filter("low < high")
    edges = stage(edges.distinct(), "links")
    while True:
        # large star: a node's larger neighbours go to the least of its neighbourhood
        both = edges.select(F.col("low").alias("node"), F.col("high").alias("near")).unionAll(
            edges.select(F.col("high").alias("node"), F.col("low").alias("near"))
        )
        least = both.groupBy("node").agg(F.least(F.col("node"), F.min("near")).alias("root"))
        large = both.filter("near > node").join(least, "node").select(F.col("root").alias("low"), F.col("near").alias("high"))
        large = stage(large.distinct(), "links")
        # small star: a node and its smaller neighbours go to the least of them
        least = large.groupBy("high").agg(F.min("low").alias("root"))
        small = large.join(least, "high").select(F.col("root").alias("low"), F.col("low").alias("high"))
        small = small.unionAll(least.select(F.col("root").alias("low"), "high")).filter("low < high")
        after = stage(small.distinct(), "links")
        if after.join(edges, ["low", "high"], "left_anti").isEmpty() and edges.join(
            after, ["low", "high"], "left_anti"
        ).isEmpty():
            return after.select(F.col("high").alias("node"), F.col("low").alias("root"))
        edges = after


def group_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, print, component_id) of every row."""
    rows = stage(fingerprints(docs), "prints")
    distinct = stage(rows.groupBy("print").agg(F.min("doc_id").alias("first")), "distinct-prints")
    rooted = components(links(distinct.select("print"), band_count(distinct.count())))
    known = distinct.join(rooted.withColumnRenamed("node", "print"), "print", "left")
    known = known.withColumn("root", F.coalesce("root", "print"))
    named = stage(known, "rooted")
    names = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(named.join(names, "root").select("print", "component_id"), "print")


def first_rows(docs: DataFrame) -> DataFrame:
    """One whole row of each component: that of the smallest doc_id, rows without one last, of equal ids any one.

    Rows are told apart by a number that is stored with them, so equal rows, rows without id and
    an id on several texts are rows of their own.
    """
    row = free_name(docs, "row")
    stored = stage(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    keyed = stored.select(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col(row).alias("row")).alias("doc_id"), "text")
    rows = stage(fingerprints(keyed), "prints")
    # equal fingerprints are one entry before anything is joined
    distinct = stage(rows.groupBy("print").agg(F.min("doc_id").alias("first")), "distinct-prints")
    roots = components(links(distinct.select("print"), band_count(distinct.count()))).withColumnRenamed("node", "print")
    rooted = distinct.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print"))
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.row")
    gone = stage(rows.select("doc_id.row").join(kept, "row", "left_anti"), "copies").withColumnRenamed("row", row)
    return stored.join(gone, row, "left_anti").select(*docs.columns)


def op3_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    grouped = group_documents(read_table(spark, sf_dir, "documents"))
    text = F.lpad(F.lower(F.hex("print")), 16, "0")
    return grouped.select("doc_id", text.alias("fingerprint"), "component_id")
