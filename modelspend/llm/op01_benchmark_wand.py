"""Benchmark decontamination: a BM25 inverted index of the test items, queried with block-max WAND.

Every training text is cut into overlapping passages, and each passage is a
query.  The index has an entry for each whole item and one for each question
(all but the last sentence) of five words or more.  An entry is retrieved when
its BM25 score reaches its own floor: the least score of a passage that holds
``OVERLAP`` of the entry's five-word shingles.  A retrieved item counts as a
leak only when the text really has that share of the shingles of its question
or of the whole item, so retrieval misses nothing that is accepted.  The
overlap of the answer (the last sentence) is reported beside it.

Passages are twice as long as the longest item and start at every item length,
so an item that stands in a text lies wholly in one of them.

The index is made with Spark: document frequencies and lengths over all items.  It is
cut into shards of about ``SHARD_POSTINGS`` postings of items; each is built in a task and stored as bytes.
The texts are searched in one pass for each shard.  Where there are several, a pass's leaks are stored and its
shard is released before the next one is sent, so what the driver and the tasks hold is bounded whatever
the number of items.  Passages
are first held, many at a time, against the sums of their words' largest
impacts within each of at most ``RANGES`` ranges of items, the bound by which the blocks
of WAND find no pivot.  The words of many items are at first taken as all
present, so that only rare words are summed; passages that stay above the
threshold are summed exactly, and only those still above it open cursors.

Edge cases: null texts and items are empty and match nothing; an item of fewer
than five words is compared as one shingle; repeated rows each give their rows;
empty tables give no rows; other columns are ignored; whole texts are read.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelspend.llm.shared import free_name, joined_bytes, read_table, stage, text_blocks
from modelspend.llm.words import ALNUM, LOWER, hash_of_bytes, prefix_sums, span_hashes, word_bounds

K1, B = 1.2, 0.75
SHINGLE, OVERLAP = 5, 0.8
BLOCK = 16
RANGES = 256
#: Words in more than this share of the items count as common.
COMMON = 0.05
SHARD_POSTINGS = 200_000
#: Bytes of text that a task searches at a time, unless a single text is longer, and rows of ranges it holds.
BLOCK_BYTES = 1 << 20
RANGE_ROWS = 1 << 13
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SENTENCE_END = r"[.!?]\s+"


# ------------------------------------------------------------------------ index


def item_postings(benchmark: DataFrame) -> DataFrame:
    """(item, term, impact): BM25 impact of each term, as a share of the item's own whole score."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = F.translate(F.coalesce("text", F.lit("")), upper, upper.lower())
    words = benchmark.select("item", F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0)).alias("words"))
    whole = words.agg(F.count("*").alias("items"), F.avg(F.size("words")).alias("mean_length")).first()
    terms = words.select("item", F.size("words").alias("length"), F.explode("words").alias("term"))
    terms = terms.groupBy("item", "length", "term").agg(F.count("*").alias("tf"))
    found = terms.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.lit(whole["items"]) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = K1 * (1 - B + B * F.col("length") / F.lit(whole["mean_length"] or 1.0))
    scored = terms.join(found.withColumn("idf", idf), "term")
    scored = scored.withColumn("impact", F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + norm))
    own = scored.groupBy("item").agg(F.sum("impact").alias("own"))
    return scored.join(own, "item").select("item", "term", (F.col("impact") / F.col("own")).alias("impact"))


@dataclass
class Index:
    """A shard: sorted term hashes with their largest impacts, and postings in blocks of entries.

    Impacts are shares of the entry's floor, so that every entry's threshold is 1.
    """

    items: list[tuple]
    words: list[list[bytes]]
    question: list[int]
    #: Impact of each word of an item, as a share of the item's whole score.
    weights: list[dict[bytes, float]]
    #: The item of each entry.
    entries: list[int]
    terms: np.ndarray
    largest: np.ndarray
    #: Largest impact of each term in each range of items.
    ranges: np.ndarray
    #: Which terms are rare, and what all common terms together can add in each range.
    rare: np.ndarray
    slack: np.ndarray
    postings: list[tuple[list[int], list[float], list[tuple[int, float]]]]
    step: int


def split_question(text: str) -> tuple[str, str]:
    """All sentences but the last, and the last; a single sentence has no answer."""
    ends = [m.end() for m in re.finditer(SENTENCE_END, text.rstrip())]
    return (text[: ends[-1]], text[ends[-1] :]) if ends else (text, "")


def text_words(text: str) -> list[bytes]:
    data = LOWER[np.frombuffer(text.encode(), np.uint8)]
    starts, ends, _ = word_bounds(data, np.array([0, len(data)]), ALNUM)
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def floor_of(words: list[bytes], weights: dict[bytes, float]) -> float:
    """The least score of a passage that has ``OVERLAP`` of the shingles of ``words``, or a little less.

    A word is lost only with all the shingles that hold it.  ``best[r][k]`` is the
    largest score lost with k shingles gone, the last r (at most ``SHINGLE``) of
    them in a row; a word that occurs n times loses an n-th with each place.
    """
    often = Counter(words)
    at = [weights.get(w, 0.0) / often[w] for w in words]
    whole = sum(weights.get(w, 0.0) for w in often)
    places = Counter(tuple(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1)))
    # distinct shingles may be missing, each with all its places
    missing = len(places) - math.ceil(OVERLAP * len(places) - 1e-9)
    gone = sum(sorted(places.values())[::-1][:missing])
    if not gone or len(words) < SHINGLE:
        return whole
    n = len(words) - SHINGLE + 1
    best = np.full((SHINGLE + 1, gone + 1), -np.inf)
    best[0, 0] = 0.0
    for i in range(n):
        after = np.full_like(best, -np.inf)
        after[0] = best.max(axis=0)
        for r in range(1, SHINGLE + 1):
            before = best[r - 1] if r < SHINGLE else np.maximum(best[r - 1], best[r])
            after[r, 1:] = before[:-1] + (at[i] if r > min(i, SHINGLE - 1) else 0.0)
        best = after
    # the last words stand in fewer shingles
    ends = [sum(at[p] for p in range(n, len(words)) if r >= n - max(0, p - SHINGLE + 1)) for r in range(SHINGLE + 1)]
    lost = (best + np.array(ends)[:, None]).max()
    return max(whole - lost, min(sum(weights.get(w, 0.0) for w in set(s)) for s in places))


def build_index(items: list[tuple[int, object, str]], postings: list[tuple[int, str, float]]) -> Index:
    """From (item, item_id, text) and (item, term, impact)."""
    items = sorted(items)
    place = {item: i for i, (item, _, _) in enumerate(items)}
    words = [text_words(text or "") for _, _, text in items]
    question = [len(text_words(split_question(text or "")[0])) for _, _, text in items]
    weights: list[dict[bytes, float]] = [{} for _ in items]
    for item, term, impact in postings:
        weights[place[item]][term.encode()] = impact
    parts = [(i, words[i]) for i in range(len(items)) if words[i]]
    parts += [(i, words[i][:q]) for i, q in enumerate(question) if SHINGLE <= q < len(words[i])]
    parts.sort(key=lambda part: part[0])
    entries = [i for i, _ in parts]
    lists: dict[int, list[tuple[int, float]]] = defaultdict(list)
    for entry, (i, part) in enumerate(parts):
        floor = floor_of(part, weights[i])
        for word in sorted(set(part) & weights[i].keys()):
            lists[hash_of_bytes(word)].append((entry, weights[i][word] / floor))
    terms = np.array(sorted(lists), np.uint64)
    packed = []
    for term in terms.tolist():
        ordered = sorted(lists[term])
        ids, impacts = [d for d, _ in ordered], [w for _, w in ordered]
        blocks = [
            (ids[min(at + BLOCK, len(ids)) - 1], max(impacts[at : at + BLOCK])) for at in range(0, len(ids), BLOCK)
        ]
        packed.append((ids, impacts, blocks))
    largest = np.array([max(w) for _, w, _ in packed], float)
    n = min(RANGES, max(1, len(entries)))
    ranges = np.zeros((len(terms), n), np.float32)
    for t, (ids, impacts, _) in enumerate(packed):
        np.maximum.at(ranges[t], np.array(ids) * n // len(entries), np.array(impacts, np.float32))
    rare = np.array([len(ids) <= max(1, COMMON * len(entries)) for ids, _, _ in packed], bool)
    slack = ranges[~rare].sum(axis=0)
    longest = max([1, *map(len, words)])
    return Index(items, words, question, weights, entries, terms, largest, ranges, rare, slack, packed, longest)


def block_max_wand(index: Index, query: list[int], threshold: float) -> list[tuple[int, float]]:
    """All (entry, score) with a score of at least ``threshold`` for the terms ``query``.

    Cursors stand in order of their items.  The pivot is the first cursor at
    which the sum of the largest impacts so far reaches the threshold: no item before it
    can.  If the blocks that hold the pivot can't reach it either, the cursors
    move past the nearest block end; else the pivot is scored.
    """
    floor = threshold - 1e-9
    found = []
    #: [item, place in the list, block, term]
    cursors = [[index.postings[t][0][0], 0, 0, t] for t in query]
    largest = index.largest
    while cursors:
        cursors.sort(key=lambda c: c[0])
        bound, pivot = 0.0, -1
        for i, c in enumerate(cursors):
            bound += largest[c[3]]
            if bound >= floor:
                pivot = i
                break
        if pivot < 0:
            break
        item = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
            pivot += 1
        bound, until = 0.0, len(index.entries)
        for c in cursors[: pivot + 1]:
            blocks, b = index.postings[c[3]][2], c[2]
            while b < len(blocks) and blocks[b][0] < item:
                b += 1
            c[2] = b
            if b < len(blocks):
                bound += blocks[b][1]
                until = min(until, blocks[b][0] + 1)
        if bound < floor:
            target = max(item + 1, until)
            if pivot + 1 < len(cursors):
                target = min(target, cursors[pivot + 1][0])
            target = max(target, item + 1) if cursors[0][0] == item else max(target, cursors[0][0] + 1)
            moved = cursors[: pivot + 1]
        elif cursors[0][0] == item:
            score = sum(index.postings[c[3]][1][c[1]] for c in cursors[: pivot + 1])
            if score >= floor:
                found.append((item, score))
            target, moved = item + 1, cursors[: pivot + 1]
        else:
            target, moved = item, [c for c in cursors[:pivot] if c[0] < item]
        for c in moved:
            ids, at = index.postings[c[3]][0], c[1]
            while at < len(ids) and ids[at] < target:
                at += 1
            c[1] = at
            c[0] = ids[at] if at < len(ids) else -1
        cursors = [c for c in cursors if c[0] >= 0]
    return found


# ---------------------------------------------------------------------- queries


def shingles(words: list[bytes]) -> set[tuple[bytes, ...]]:
    if not words:
        return set()
    return {tuple(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}


def overlap(part: list[bytes], have: set[tuple[bytes, ...]], text: list[bytes]) -> float:
    """Share of a part's shingles that the text has; a shorter part must stand there in one piece."""
    if not part:
        return 0.0
    if len(part) < SHINGLE:
        n = len(part)
        return float(any(text[i : i + n] == part for i in range(len(text) - n + 1)))
    own = shingles(part)
    return len(own & have) / len(own)


def leaks_of(index: Index, passage: list[bytes], item: int) -> tuple[float, float, float]:
    """Overlap of the whole item, its question and its answer with a passage."""
    have = shingles(passage)
    words, q = index.words[item], index.question[item]
    answer = words[q:]
    return overlap(words, have, passage), overlap(words[:q], have, passage), overlap(answer, have, passage)


def find_leaks(shard: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The search of a task for the leaks of one shard's items; ``shard`` holds the bytes of its index."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = pickle.loads(shard.value)
        for block in text_blocks(batches, BLOCK_BYTES):
            best: dict[tuple[int, int], tuple[float, float, float, float]] = {}
            for doc, passage, found in passages_found(index, block):
                have = set(passage)
                for item in sorted({index.entries[entry] for entry, _ in found}):
                    whole, question, answer = leaks_of(index, passage, item)
                    long_question = index.question[item] >= SHINGLE
                    if whole >= OVERLAP or (long_question and question >= OVERLAP):
                        score = sum(w for word, w in index.weights[item].items() if word in have)
                        best[doc, item] = max(best.get((doc, item), (0.0,) * 4), (score, whole, question, answer))
            docs = pa.array([d for d, _ in best], pa.int64())
            scores = [pa.array([v[i] for v in best.values()], pa.float64()) for i in range(4)]
            items = pa.array([index.items[i][0] for _, i in best], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id").take(docs), items, *scores],
                names=["doc_id", "item", "score", "overlap", "question_overlap", "answer_overlap"],
            )

    return search


def passage_bounds(index: Index, of_piece: np.ndarray, of_term: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The most that the words of each piece and the next can add up to in any range; ``last`` pieces have no next.

    The terms ``of_term`` stand by piece.  The ranges of about ``RANGE_ROWS`` of them are held at a time, so memory
    does not grow with the texts.
    """
    rare = index.rare[of_term]
    term, cuts = of_term[rare], np.searchsorted(of_piece[rare], np.arange(len(last) + 1))
    both, low = np.empty(len(last), np.float32), 0
    while low < len(last):
        high = int(np.searchsorted(cuts, cuts[low] + RANGE_ROWS, side="right")) - 1
        high = min(max(high, low + 1), low + RANGE_ROWS, len(last))
        upto = min(high + 1, len(last))
        bound = np.zeros((upto - low, index.ranges.shape[1]), np.float32)
        some = cuts[low : upto + 1] - cuts[low]
        full = np.flatnonzero(np.diff(some))
        if len(full):
            rows = index.ranges[term[cuts[low] : cuts[upto]]]
            bound[full] = np.add.reduceat(rows, some[full], axis=0)
        bound[:-1] += np.where(last[low : upto - 1, None], 0, bound[1:])
        both[low:high] = (bound[: high - low] + index.slack).max(axis=1, initial=0)
        low = high
    return both


def passages_found(index: Index, block: pa.RecordBatch) -> Iterator[tuple[int, list[bytes], list[tuple[int, float]]]]:
    """(text's place in the block, passage, entries retrieved) for the passages that retrieve any."""
    data, bounds = joined_bytes(block.column("text"))
    if not len(data) or not len(index.terms):
        return
    data = LOWER[data]
    starts, ends, first = word_bounds(data, bounds, ALNUM)
    hashes = span_hashes(prefix_sums(data), starts, ends)
    term = np.searchsorted(index.terms, hashes)
    term[term == len(index.terms)] = 0
    known = np.flatnonzero(index.terms[term] == hashes)
    # halves of passages: pieces of `step` words that don't cross texts
    pieces = np.maximum(1, -(-np.diff(first) // index.step))
    base = np.concatenate([[0], np.cumsum(pieces)])
    doc = np.searchsorted(first, known, side="right") - 1
    piece = base[doc] + (known - first[doc]) // index.step
    pairs = np.unique(piece * len(index.terms) + term[known])
    of_piece, of_term = np.divmod(pairs, len(index.terms))
    cuts = np.searchsorted(of_piece, np.arange(base[-1] + 1))
    last = np.zeros(base[-1], bool)
    last[base[1:] - 1] = True
    both = passage_bounds(index, of_piece, of_term, last)
    # a text's last half is in the passage before it, unless it is the only one
    alone = np.zeros(base[-1], bool)
    alone[base[:-1]] = pieces == 1
    for p in np.flatnonzero((both >= 1 - 1e-4) & (alone | ~last)).tolist():
        d = int(np.searchsorted(base, p, side="right")) - 1
        upto = p + 1 if last[p] else p + 2
        query = np.unique(of_term[cuts[p] : cuts[upto]])
        if index.ranges[query].sum(axis=0).max(initial=0) < 1 - 1e-4:
            continue
        found = block_max_wand(index, query.tolist(), 1.0)
        if found:
            low = first[d] + (p - base[d]) * index.step
            words = slice(int(low), int(min(low + 2 * index.step, first[d + 1])))
            passage = [data[a:b].tobytes() for a, b in zip(starts[words].tolist(), ends[words].tolist(), strict=True)]
            yield d, passage, found


def build_shard(key: tuple, items: pd.DataFrame, postings: pd.DataFrame) -> pd.DataFrame:
    """The index of one shard's (item, text) and (item, term, impact), as bytes."""
    rows = [(item, None, text) for item, text in zip(items["item"].tolist(), items["text"].tolist(), strict=True)]
    entries = zip(postings["item"].tolist(), postings["term"].tolist(), postings["impact"].tolist(), strict=True)
    return pd.DataFrame({"shard": [key[0]], "index": [pickle.dumps(build_index(rows, list(entries)))]})


def index_shards(items: DataFrame, postings: DataFrame) -> DataFrame:
    """(shard, index): the items' index in shards of about ``SHARD_POSTINGS`` postings, stored."""
    shard = F.pmod(F.xxhash64("item"), F.lit(max(1, -(-postings.count() // SHARD_POSTINGS)))).alias("shard")
    by_shard = [df.select(shard, *columns).groupBy("shard") for df, columns in ((items, ("item", "text")), (postings, postings.columns))]
    return stage(by_shard[0].cogroup(by_shard[1]).applyInPandas(build_shard, "shard long, index binary"), "shards")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, overlap, question_overlap, answer_overlap): every leak of an item in a text."""
    spark = docs.sparkSession
    benchmark = stage(benchmark.select("item_id", "text").withColumn("item", F.monotonically_increasing_id()), "items")
    postings = stage(item_postings(benchmark), "postings")
    index = index_shards(benchmark, postings)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item long, score double, overlap double, question_overlap double, answer_overlap double"
    # the numbers of the shards, of which there is one for each SHARD_POSTINGS postings
    shards = [r.shard for r in index.select("shard").orderBy("shard").collect()]
    found = None
    for shard in shards:
        sent = spark.sparkContext.broadcast(bytes(index.filter(F.col("shard") == shard).first()["index"]))
        one = docs.select("doc_id", "text").mapInArrow(find_leaks(sent), schema)
        if len(shards) > 1:
            one = stage(one, f"leaks-{shard}")
            sent.destroy()
        found = one if found is None else found.unionAll(one)
    if found is None:
        found = spark.createDataFrame([], schema)
    return found.join(benchmark.select("item", "item_id"), "item").drop("item")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` with no leak; rows of a null doc_id are told by their text."""
    key = free_name(docs, "leak_key")
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("\x00")), "text"))
    leaks = contaminated(keyed.select(F.col(key).alias("doc_id"), "text"), benchmark).select("doc_id").distinct()
    leaks = stage(leaks, "leaks").withColumnRenamed("doc_id", key)
    return keyed.join(leaks, key, "left_anti").select(*docs.columns)


def op1_benchmark_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All leaks of benchmark items in documents."""
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
