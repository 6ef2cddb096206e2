"""MinHash near-dedup: an LSH forest of sorted signature orders.

A document's set holds its distinct word shingles; two are linked at a Jaccard similarity
of ``SIMILAR`` percent or more, and linked documents share a component.

*Nodes.*  Documents of equal sets are one node from the first aggregation on, so a
group of copies of any size is one row.

*Forest.*  A signature has ``TREES`` x ``STEP`` min-hashes of 16 bits.  Each tree sorts the
nodes by the signature rotated to its own first hash, so nodes that agree on many leading
hashes stand next to each other.  The orders are sorted over range partitions of
the whole key, so no group lands in one task, and a task streams through its rows with a
buffer of ``WINDOW``.  A node's candidates are its neighbours of longest common prefix:
where the region is sparse, all that share ``DEPTH`` hashes; where it is crowded, the depth
grows until the window holds the neighbours.  Regions that a partition's end cuts are
taken up again from their ends.  With 16 trees of depth 4 a pair of similarity 0.85
shares no region with probability 8e-6.

*Links.*  Candidates that agree on fewer than ``WEAK`` of 128 hashes are passed over (a pair of
similarity 0.85 does with probability 7e-6).  Each row offers its best candidate in
each tree.  These are confirmed on the full sets, but only as far as they still join
different components: first each node's best, then each component's best, then all that remain.
A region that still holds several components, and where the window left neighbours out or a
row had more candidates than its offer, is gone through on the full sets: every node
outside its largest component is compared with all of the region.  A unit of that work is a block of such nodes
with a block of the region, ``BLOCK`` nodes each at most; what it returns are links.

Every step is stored in the shared folder and deleted when nothing reads it any more.

Edge cases: a document of fewer than three words has its whole sequence as one shingle;
one without words, or a null text, has an empty set and is linked with nothing.
Equal rows share a component, and all rows that carry its smallest doc_id are
kept.  A null doc_id never names a component of rows with ids; where all are null, the
component_id is null and the rows are kept.  An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modelspend.llm.components import components
from modelspend.llm.shared import discard, joined_bytes, read_table, stage, text_blocks
from modelspend.llm.words import NOT_SPACE, mix, word_bounds, word_hashes

SHINGLE = 3
#: Percent of the union that the intersection has to reach.
SIMILAR = 85
TREES = 16
#: Hashes from one tree's first to the next one's.
STEP = 8
HASHES = TREES * STEP
#: Leading hashes that neighbours share at least; a region of a tree.
DEPTH = 4
#: Neighbours in order that a node is compared with at most before a crowded region is gone through in blocks.
WINDOW = 512
#: Nodes in a block of a divided region.
BLOCK = 2048
#: Agreeing hashes that make a candidate.
WEAK = 90

_RNG = np.random.Generator(np.random.PCG64(11))
_ODD = _RNG.integers(1, 2**63, HASHES + SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
WIDTH = 2 * HASHES
PREFIX = 2 * DEPTH

PAIR, CROWDED, EDGE = range(3)
FOUND = "kind int, a binary, b binary, agree int, offers int, part int, head boolean, tree int, place binary, n bigint"


# ------------------------------------------------------------- sets and signatures


def shingle_sets(text: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, bounds = joined_bytes(text)
    starts, ends, first = word_bounds(data, bounds, NOT_SPACE)
    hashes = word_hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    weights = _ODD[HASHES : HASHES + size]
    if len(hashes) >= size:
        sums = sum(hashes[i : len(hashes) - size + 1 + i] * weights[i] for i in range(size))
        sums = mix(sums)
    for low, high in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        count = high - low
        if count >= size:
            own = np.sort(sums[low : high - size + 1])
            distinct = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=distinct[1:])
            yield own[distinct]
        elif count:
            short = (hashes[low:high] * weights[:count]).sum(dtype=np.uint64) + np.uint64(count)
            yield mix(np.array([short], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """16 bits of each min-hash of each set, none of which may be empty."""
    joined = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), HASHES), np.uint16)
    work = np.empty_like(joined)
    for i in range(HASHES):
        np.multiply(joined, _ODD[i], out=work)
        out[:, i] = mix(np.minimum.reduceat(work, starts)) >> np.uint64(48)
    return out


def signed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in text_blocks(batches, 2 << 20):
        sets = list(shingle_sets(block.column("text")))
        full = [s for s in sets if len(s)]
        signs = iter(signatures(full) if full else ())
        yield pa.RecordBatch.from_arrays(
            [
                block.column("doc_id"),
                block.column("text_key"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                pa.array([next(signs).tobytes() if len(s) else None for s in sets], pa.binary()),
            ],
            names=["doc_id", "text_key", "n", "node", "sign"],
        )


def set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in text_blocks(batches, 2 << 20):
        sets = [s.tobytes() for s in shingle_sets(block.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [block.column("node"), block.column("sign"), pa.array(sets, pa.binary())], names=["node", "sign", "items"]
        )


def with_text_key(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n, node, sign) of every row; no node where there are no words."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_key bigint, n bigint, node binary, sign binary"
    return with_text_key(docs).mapInArrow(signed_rows, schema)


def distinct_sets(rows: DataFrame) -> DataFrame:
    """(node, sign, n, first): one row per set, with its smallest doc_id and a text that has it."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
    return rows.filter("n > 0").groupBy("node").agg(F.first("sign").alias("sign"), F.first("n").alias("n"), first.alias("first"))


# --------------------------------------------------------------------- the forest


class Region:
    """The last rows of one region of a tree."""

    def __init__(self, window: int):
        self.window = window
        self.signs = np.empty((2 * window, HASHES), np.uint16)
        self.sizes = np.empty(2 * window, np.int64)
        self.nodes: list[bytes] = []
        self.rows = 0

    def reset(self) -> None:
        self.nodes.clear()
        self.rows = 0

    def add(self, node: bytes, sign: np.ndarray, size: int) -> tuple[bytes, bytes, int, int] | None:
        """Put in the next row: its best candidate (a, b, agreeing hashes, number of candidates), if any."""
        window, here = self.window, len(self.nodes)
        if here == 2 * window:
            for kept in (self.signs, self.sizes):
                kept[:window] = kept[window:]
            del self.nodes[:window]
            here = window
        low, out = max(0, here - window), None
        if here:
            agree = np.count_nonzero(self.signs[low:here] == sign, axis=1)
            agree[~alike(self.sizes[low:here], size)] = 0
            best = int(agree.argmax())
            other = self.nodes[low + best]
            if agree[best] >= WEAK:
                out = (min(node, other), max(node, other), int(agree[best]), int(np.count_nonzero(agree >= WEAK)))
        self.signs[here], self.sizes[here] = sign, size
        self.nodes.append(node)
        self.rows += 1
        return out


def alike(sizes: np.ndarray, size: int) -> np.ndarray:
    """Can sets of these sizes be similar enough?"""
    return 100 * np.minimum(sizes, size) >= SIMILAR * np.maximum(sizes, size)


def found_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.binary(), pa.int64()]
    names = [c.split()[0] for c in FOUND.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def neighbours(window: int, edges: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The best candidate of each of the rows (unit, tree, place, node, n), which come in order.

    Crowded regions are reported.  With ``edges``, so are the rows of the partition's
    first and last region, up to a window each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        region, key, out = Region(window), None, []
        first, tail, regions = [], [], 0

        def crowded(tree: int, place: bytes) -> None:
            out.append((CROWDED, None, None, None, None, None, None, tree, place[:PREFIX], None))

        def edge(head: bool, rows: list) -> None:
            out.extend((EDGE, node, None, None, None, part, head, tree, place, n) for tree, place, node, n in rows)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("unit", "tree", "place", "node", "n")]
            for unit, tree, place, node, n in zip(*columns, strict=True):
                if key != (unit, tree, place[:PREFIX]):
                    key, tail = (unit, tree, place[:PREFIX]), []
                    region.reset()
                    regions += 1
                if region.rows == window:
                    crowded(tree, place)
                best = region.add(node, np.frombuffer(place, np.uint16), n)
                if best:
                    out.append((PAIR, *best, None, None, tree, place[:PREFIX], None))
                if edges:
                    if regions == 1 and len(first) < window:
                        first.append((tree, place, node, n))
                    tail.append((tree, place, node, n))
                    if len(tail) == 2 * window:
                        del tail[:window]
                if len(out) >= 10_000:
                    yield found_batch(out)
                    out.clear()
        if edges and key is not None:
            edge(True, first)
            edge(False, tail[-window:])
            if regions == 1:  # a region that goes on at both ends
                crowded(*first[0][:2])
        yield found_batch(out)

    return run


def tree_places(sign: Column) -> Column:
    """The rotations of a signature, one per tree."""
    rest = [F.concat(F.substring(sign, 2 * STEP * t + 1, WIDTH), F.substring(sign, 1, 2 * STEP * t)) for t in range(TREES)]
    return F.array(*rest)


def regions_of(nodes: DataFrame) -> DataFrame:
    """(tree, region, node) for the regions that several nodes share."""
    starts = F.array(*[F.substring("sign", 2 * STEP * t + 1, PREFIX) for t in range(TREES)])
    keyed = nodes.select("node", F.posexplode(starts).alias("tree", "region"))
    shared = keyed.groupBy("tree", "region").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    return keyed.join(shared.select("tree", "region"), ["tree", "region"])


def candidates(nodes: DataFrame, regions: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Distinct offered pairs (a, b, agree), and for each region whether it was crowded or had more candidates than offers; both stored."""
    trees = regions.groupBy("node").agg(F.collect_set("tree").alias("trees"))
    places = tree_places(F.col("sign"))
    rows = nodes.join(trees, "node").select("node", "n", F.explode("trees").alias("tree"), places.alias("places"))
    rows = rows.select(F.lit(0).alias("unit"), "tree", F.get("places", F.col("tree")).alias("place"), "node", "n")
    order = ("tree", "place", "node")
    rows = stage(rows, "forest")
    found = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(neighbours(window, True), FOUND)
    found = stage(found, "neighbours")
    discard(rows)

    # regions cut by the end of a partition: its rows and those of the next one's beginning
    edges = found.filter(F.col("kind") == EDGE)
    parts = [r.part for r in edges.select("part").distinct().orderBy("part").collect()]  # one number per task
    before = dict(zip(parts[1:], parts[:-1], strict=True))
    unit = F.col("part")
    if before:
        previous = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
        unit = F.when(F.col("head"), F.try_element_at(previous, F.col("part"))).otherwise(F.col("part"))
    cut = edges.select(unit.alias("unit"), "tree", "place", F.col("a").alias("node"), "n").filter("unit IS NOT NULL")
    joined = cut.repartition("unit").sortWithinPartitions("unit", *order).mapInArrow(neighbours(2 * window, False), FOUND)
    both = stage(found.filter(F.col("kind") != EDGE).unionByName(joined), "candidates")
    discard(found)
    pairs = both.filter(F.col("kind") == PAIR).groupBy("a", "b").agg(F.max("agree").alias("agree"))
    state = both.groupBy("tree", F.col("place").alias("region")).agg(
        F.max((F.col("kind") == CROWDED).cast("int")).alias("crowded"), (F.max("offers") > 1).alias("more")
    )
    stored = stage(pairs, "pairs"), stage(state.filter("crowded = 1 OR more"), "region-state")
    discard(both)
    return stored


# -------------------------------------------------------------------- confirming


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= SIMILAR * (len(x) + len(y) - both)


def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, linked) from two sets each."""
    for batch in batches:
        linked = []
        for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
            linked.append(similar(*(np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])


def full_sets(regions: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, sign, items): the whole sets of the nodes that have neighbours, from their texts."""
    wanted = nodes.join(regions.select("node").distinct(), "node", "left_semi")
    wanted = wanted.select("node", "sign", F.col("first.doc_id").alias("want_id"), F.col("first.text_key").alias("want_key"))
    texts = with_text_key(docs)
    same = (F.col("text_key") == F.col("want_key")) & F.col("doc_id").eqNullSafe(F.col("want_id"))
    texts = texts.join(wanted, same).groupBy("node").agg(F.first("sign").alias("sign"), F.first("text").alias("text"))
    return texts.mapInArrow(set_rows, "node binary, sign binary, items binary")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, linked) of every pair, by its whole sets."""
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return both.mapInArrow(confirm, "a binary, b binary, linked boolean")


def rooted(pairs: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Pairs with the components of their ends, without those within one component."""
    if roots is None:
        return pairs.withColumns({"ra": F.col("a"), "rb": F.col("b")})
    ends = pairs
    for end in ("a", "b"):
        ends = ends.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"r{end}")), end, "left")
        ends = ends.withColumn(f"r{end}", F.coalesce(f"r{end}", end))
    return ends.filter("ra <> rb")


def best_of(pairs: DataFrame, ends: tuple[str, str]) -> DataFrame:
    """For each end, the pair of most agreeing hashes."""
    key = F.explode(F.array(*ends))
    top = F.max(F.struct("agree", "a", "b")).alias("top")
    return pairs.select(key.alias("end"), "agree", "a", "b").groupBy("end").agg(top).select("top.a", "top.b").distinct()


class Links:
    """What has been confirmed and refuted, and the components of the links."""

    def __init__(self, sets: DataFrame):
        self.sets = sets
        self.tried: list[DataFrame] = []
        self.roots: DataFrame | None = None

    def open(self, pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` that were not tried and would join two components."""
        left = rooted(pairs, self.roots)
        for table in self.tried:
            left = left.join(table.select("a", "b"), ["a", "b"], "left_anti")
        return left

    def settle(self, pairs: DataFrame) -> None:
        """Confirm or refute ``pairs`` on the whole sets and join what is linked."""
        self.join(stage(confirmed(pairs, self.sets), "confirmed"))

    def join(self, tried: DataFrame) -> None:
        """Take up pairs (a, b, linked), stored."""
        self.tried.append(tried)
        edges = rooted(tried.filter("linked"), self.roots).select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        joined = components(edges)
        if self.roots is None:
            self.roots = joined
            return
        # old components under their new names, and nodes that were alone before
        renamed = self.roots.join(joined.select(F.col("node").alias("root"), F.col("root").alias("new")), "root", "left")
        renamed = renamed.select("node", F.coalesce("new", "root").alias("root"))
        alone = joined.join(self.roots.select(F.col("root").alias("node")), "node", "left_anti")
        alone = alone.join(self.roots, "node", "left_anti")
        after = stage(renamed.unionByName(alone), "roots")
        discard(self.roots, joined)
        self.roots = after

    def discard(self) -> None:
        discard(*self.tried)


def divided(regions: DataFrame, state: DataFrame, roots: DataFrame) -> DataFrame:
    """(tree, region, node, root, largest, rows, outside) of those regions in ``state`` that hold several components.

    ``outside`` counts the rows that are not in the region's largest component.
    """
    rows = regions.join(state.select("tree", "region"), ["tree", "region"]).join(roots, "node", "left")
    rows = rows.withColumn("root", F.coalesce("root", "node"))
    parts = rows.groupBy("tree", "region", "root").agg(F.count(F.lit(1)).alias("n"))
    whole = parts.groupBy("tree", "region").agg(F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("rows"))
    whole = whole.select("tree", "region", F.col("top.root").alias("largest"), "rows", (F.col("rows") - F.col("top.n")).alias("outside"))
    return rows.join(whole.filter("outside > 0"), ["tree", "region"])


def in_units(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows of divided regions in units (tree, region, low, high); ``probe`` rows are compared with the others."""
    blocks, outer = (F.ceil(F.col(c) / block).cast("int") for c in ("rows", "outside"))
    place = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    below = lambda n: F.sequence(F.lit(0), n - 1)
    every = F.transform(below(outer), lambda j: F.struct(place(blocks).alias("low"), j.alias("high"), F.lit(False).alias("probe")))
    probes = F.transform(below(blocks), lambda i: F.struct(i.alias("low"), place(outer).alias("high"), F.lit(True).alias("probe")))
    units = F.when(F.col("root") == F.col("largest"), every).otherwise(F.concat(every, probes))
    return rows.select("tree", "region", "node", "root", F.explode(units).alias("unit")).select("*", "unit.*").drop("unit")


class Unit:
    """A block of a region, with the components its nodes are known to be in."""

    def __init__(self):
        self.nodes: list[bytes] = []
        self.labels: list[bytes] = []
        self.sets: list[np.ndarray] = []
        self.signs: list[np.ndarray] = []
        self.names: dict[bytes, bytes] = {}
        self.ready: tuple | None = None

    def name(self, label: bytes) -> bytes:
        while label in self.names:
            label = self.names[label]
        return label

    def put(self, root: bytes, node: bytes, sign: bytes, items: bytes) -> None:
        self.nodes.append(node)
        self.labels.append(root)
        self.sets.append(np.frombuffer(items, np.uint64))
        self.signs.append(np.frombuffer(sign, np.uint16))

    def compare(self, root: bytes, node: bytes, sign: bytes, items: bytes) -> Iterator[tuple[bytes, bytes]]:
        """Links of a node to the components of the block, one to each that has one."""
        if not self.nodes:
            return
        if self.ready is None:
            self.ready = np.stack(self.signs), np.array([len(s) for s in self.sets])
        signs, sizes = self.ready
        own = np.frombuffer(items, np.uint64)
        agree = np.count_nonzero(signs == np.frombuffer(sign, np.uint16), axis=1)
        near = np.flatnonzero((agree >= WEAK) & alike(sizes, len(own)))
        near = near[np.argsort(-agree[near], kind="stable")]
        for at in range(0, len(near), 64):
            other = [i for i in near[at : at + 64].tolist() if self.name(self.labels[i]) != self.name(root)]
            if not other:
                continue
            items_of = np.concatenate([self.sets[i] for i in other])
            starts = np.concatenate([[0], np.cumsum(sizes[other])[:-1]])
            at_most = np.minimum(np.searchsorted(own, items_of), len(own) - 1)
            both = np.add.reduceat((own[at_most] == items_of).astype(np.int64), starts)
            linked = 100 * both >= SIMILAR * (len(own) + sizes[other] - both)
            for i in (i for i, yes in zip(other, linked.tolist(), strict=True) if yes):
                mine, its = self.name(root), self.name(self.labels[i])
                if mine != its:
                    self.names[mine] = its
                    yield min(node, self.nodes[i]), max(node, self.nodes[i])


def unit_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between components; a unit's rows come together, those to compare after the others."""
    key, unit, out = None, Unit(), []

    def links() -> pa.RecordBatch:
        a, b = zip(*out, strict=True) if out else ((), ())
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("tree", "region", "low", "high", "probe", "root", "node", "sign", "items")]
        for tree, region, low, high, probe, *row in zip(*columns, strict=True):
            if key != (tree, region, low, high):
                key, unit = (tree, region, low, high), Unit()
            if probe:
                out.extend(unit.compare(*row))
            else:
                unit.put(*row)
        if len(out) > 10_000:
            yield links()
    yield links()


def links_within(rows: DataFrame, sets: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b): links between the components of divided regions."""
    key = ("tree", "region", "low", "high")
    rows = in_units(rows, block).join(sets, "node").select(*key, "probe", "root", "node", "sign", "items")
    rows = rows.repartition(*key).sortWithinPartitions(*key, "probe", "root", "node")
    return rows.mapInArrow(unit_links, "a binary, b binary").distinct()


def near_components(nodes: DataFrame, docs: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """(node, root) of the nodes that are linked with others, stored."""
    regions = stage(regions_of(nodes), "regions")
    pairs, state = candidates(nodes, regions, window)
    sets = stage(full_sets(regions, nodes, docs), "sets")
    links = Links(sets)
    links.settle(best_of(pairs, ("a", "b")))
    links.settle(best_of(links.open(pairs), ("ra", "rb")))
    links.settle(links.open(pairs))
    found = links_within(divided(regions, state, links.roots), sets, block).withColumn("linked", F.lit(True))
    links.join(stage(found, "region-links"))
    links.discard()
    discard(regions, pairs, state, sets)
    return links.roots


def group_documents(docs: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    rows = stage(signed(docs), "signed")
    nodes = stage(distinct_sets(rows), "nodes")
    roots = near_components(nodes, docs, window, block)
    named = nodes.select("node", F.col("first.doc_id").alias("first")).join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    names = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(names, "root").select("node", "component_id")
    named = stage(named, "named")
    discard(nodes, roots)
    out = rows.join(named, "node", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def op11_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size, component and verdict of every document."""
    grouped = group_documents(read_table(spark, sf_dir, "documents"))
    return grouped.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
