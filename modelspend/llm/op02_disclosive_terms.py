"""PII: information-theoretic sanitisation.

Fixed detectors find the protected entities of each text: e-mail addresses, IP
addresses, card and phone numbers.  The corpus then tells which words of the texts that hold an entity
reveal it: with n(c) documents holding entity c, n(t) holding term t, and n(c, t)
holding both, anywhere in their texts, of N documents, the pointwise
mutual information of t and c is log2(n(c,t) N / (n(c) n(t))), and the
information of c is log2(N / n(c)).  A term whose mutual information is
at least the share ``GENERALISE`` of the entity's information discloses it and
is generalised to a class of words; from the share ``REMOVE`` on it is removed.  That holds at
all places of the term in all documents of the entity.
``support`` documents must show the pair, so a rare word beside
a one-time entity is no evidence; with 1 every pair counts.

Terms are counted over all words of all documents, by 64-bit hashes that each
task sums before the shuffle.  Pairs start from the sparse side: only texts of an entity that enough
documents hold give terms, and of these only terms rare enough to reach the share by any of the
text's entities, since n(c, t) is at most n(c), are paired with entities.
Pairs are counted by document before anything gathers, so neither a common word nor a common entity does.

Edge cases: null text is empty; repeated rows each get their row and count as
documents; an empty table gives no rows; other columns are ignored; texts are
never cut.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelspend.llm import spans as SP
from modelspend.llm.shared import discard, joined_bytes, read_table, stage, text_blocks
from modelspend.llm.words import ALNUM, hash_of, mix, word_bounds, word_hashes

KINDS = ("email", "ip", "card", "phone", "generalise", "remove")
BASE = 4
SUPPORT = 3
GENERALISE, REMOVE = 0.8, 0.95

EMAIL = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL_START = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){13,}")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
IS_DIGIT = np.zeros(256, np.int64)
IS_DIGIT[0x30:0x3A] = 1
A_TO_Z = {c: c + 32 for c in range(0x41, 0x5B)}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, each tried at the start of its run of characters or where the last match ended."""
    end = 0
    while True:
        m = EMAIL.match(text, end) if end else None
        m = m or EMAIL_START.search(text, end)
        if m is None:
            return
        yield m.span()
        end = m.end()


def entities(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all entities, leftmost and not overlapping within a kind."""
    found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = "".join(DIGITS.findall(m[0]))
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 10 <= len(DIGITS.findall(m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def entity_name(kind: int, value: str) -> str:
    """Spellings of one entity share a name."""
    if kind == 0:
        return value.translate(A_TO_Z)
    if kind == 1:
        return ".".join(p.lstrip("0") or "0" for p in value.split("."))
    return f"{kind}:" + "".join(DIGITS.findall(value))


def signed(h: int) -> int:
    return h - (1 << 64) if h >= 1 << 63 else h


def open_words(text: str, found: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """(hash, start, end) of the words of a text that are in no entity."""
    words = np.array([m.span() for m in WORD.finditer(text)]).reshape(-1, 2)
    covered = np.zeros(len(words), bool)
    for a, _, b in found:
        covered[np.searchsorted(words[:, 1], a, side="right") : np.searchsorted(words[:, 0], b)] = True
    hashes: dict[str, int] = {}
    for start, end in words[~covered].tolist():
        word = text[start:end].translate(A_TO_Z)
        if word not in hashes:
            hashes[word] = signed(hash_of(word))
        yield hashes[word], start, end


SPAN_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))


def as_spans(spans: list[tuple[int, int, int]]) -> list[dict]:
    return [dict(zip(("start", "kind", "end"), s, strict=True)) for s in spans]


def find_entities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, base, entities, held): the entities of each text, and the text itself where it has any."""
    for block in text_blocks(batches):
        data, bounds = joined_bytes(block.column("text"))
        digits = np.zeros(len(data) + 1, np.int64)
        np.cumsum(IS_DIGIT[data], out=digits[1:])
        look = np.diff(digits[bounds]) >= 4
        look[np.searchsorted(bounds, np.flatnonzero(data == ord("@")), side="right") - 1] = True
        spans, names, held = [[] for _ in look], [[] for _ in look], [None] * len(look)
        text = block.column("text")
        for i in np.flatnonzero(look):
            one = text[int(i)].as_py()
            found = entities(one)
            if found:
                spans[i], held[i] = as_spans(found), one
                names[i] = sorted({signed(hash_of(entity_name(k, one[a:b]))) for a, k, b in found})
        yield pa.RecordBatch.from_arrays(
            [block.column("doc_id"), pa.array(spans, SPAN_TYPE), pa.array(names, pa.list_(pa.int64())), pa.array(held, pa.string())],
            names=["doc_id", "base", "entities", "held"],
        )


def found_of(base: list[dict]) -> list[tuple[int, int, int]]:
    return [(s["start"], s["kind"], s["end"]) for s in base]


def text_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, most, term): the distinct terms of each text (row, most, base, held)."""
    for batch in batches:
        for row, most, base, held in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            terms = np.array(sorted({h for h, _, _ in open_words(held, found_of(base))}), np.int64)
            for at in range(0, len(terms), 50_000):
                part = terms[at : at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * len(part), pa.int64()), pa.array([most] * len(part), pa.float64()), pa.array(part)],
                    names=["row", "most", "term"],
                )


def term_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, terms): all places of the disclosing terms of each text (row, base, held, disclosing)."""
    for batch in batches:
        rows, places = [], []
        for row, base, held, disclosing in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            kinds = {d["term"]: d["kind"] for d in disclosing}
            rows.append(row)
            places.append(as_spans([(a, kinds[h], b) for h, a, b in open_words(held, found_of(base)) if h in kinds]))
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(places, SPAN_TYPE)], names=["row", "terms"])


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sum counts of equal hashes."""
    hashes = np.concatenate([h for h, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    order = np.argsort(hashes)
    hashes, counts = hashes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, int)
    return hashes[first], np.add.reduceat(counts, first) if len(first) else counts


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, n): in how many of the task's texts each term stands; long runs of new terms are passed on early."""
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    for block in text_blocks(batches):
        data, bounds = joined_bytes(block.column("text"))
        starts, ends, index = word_bounds(data, bounds, ALNUM)
        hashes = word_hashes(data, starts, ends)
        doc = np.repeat(np.arange(len(index) - 1, dtype=np.uint64), np.diff(index))
        # once for each text: equal (text, hash) pairs are equal after the mix
        _, once = np.unique(mix(hashes + doc * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
        terms, n = np.unique(hashes[once], return_counts=True)
        parts.append((terms, n))
        held += len(terms)
        if held > 2_000_000:
            parts = [merged(parts)]
            held = len(parts[0][0])
            if held > 1_000_000:
                yield from term_rows(parts.pop())
                held = 0
    if parts:
        yield from term_rows(merged(parts))


def term_rows(part: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(part[0]), 100_000):
        rows = slice(at, at + 100_000)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part[0][rows].view(np.int64)), pa.array(part[1][rows].astype(np.int64))], names=["term", "n_term"]
        )


def scan(docs: DataFrame) -> DataFrame:
    """(row, doc_id, base, entities, held) of every row, stored."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, base {SP.SPANS}, entities array<bigint>, held string"
    found = docs.select("doc_id", "text").mapInArrow(find_entities, schema)
    return stage(found.withColumn("row", F.monotonically_increasing_id()), "pii")


def disclosures(docs: DataFrame, scanned: DataFrame, support: int = SUPPORT) -> tuple[DataFrame, DataFrame]:
    """(row, entity, n_entity) of the entities that enough documents hold, and (entity, term, row, share): each
    disclosing term, how much of the entity's information it carries, and where both stand; both stored."""
    total = float(scanned.count())
    held = scanned.select("row", F.explode("entities").alias("entity"))
    # an entity of every document is no secret
    counts = held.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    counts = counts.filter((F.col("n_entity") >= support) & (F.col("n_entity") < total))
    holding = stage(held.join(counts, "entity"), "pii-entities")

    # n(c, t) <= n(c), so the share is reached only where n(t) <= n(c) (N / n(c)) ** (1 - share)
    most = F.max(F.col("n_entity") * F.pow(F.lit(total) / F.col("n_entity"), F.lit(1 - GENERALISE))).alias("most")
    relevant = scanned.join(holding.groupBy("row").agg(most), "row").select("row", "most", "base", "held")
    terms = stage(relevant.mapInArrow(text_terms, "row bigint, most double, term bigint"), "pii-terms")
    known = terms.select("term").distinct()
    numbers = docs.select("text").mapInArrow(count_terms, "term bigint, n_term bigint")
    numbers = numbers.join(known, "term", "left_semi").groupBy("term").agg(F.sum("n_term").alias("n_term"))
    rare = terms.join(numbers, "term").filter(F.col("n_term") <= F.col("most") * (1 + 1e-9))
    pairs = stage(rare.join(holding, "row").select("row", "entity", "n_entity", "term", "n_term"), "pii-pairs")

    both = pairs.groupBy("entity", "n_entity", "term", "n_term").agg(F.count(F.lit(1)).alias("n_both"))
    information = F.log2(F.lit(total) / F.col("n_entity"))
    mutual = F.log2(F.col("n_both") * F.lit(total) / (F.col("n_entity") * F.col("n_term")))
    both = both.filter(F.col("n_both") >= support).withColumn("share", mutual / information)
    both = both.filter(F.col("share") >= GENERALISE).select("entity", "term", "share")
    shown = stage(pairs.join(both, ["entity", "term"]).select("entity", "term", "row", "share"), "pii-shown")
    discard(terms, pairs)
    return holding, shown


def scan_private(docs: DataFrame, support: int = SUPPORT) -> DataFrame:
    """(row, doc_id, base, spans): entities, and entities with disclosing terms, of every row."""
    scanned = scan(docs)
    _, shown = disclosures(docs, scanned, support)
    kind = F.when(F.max("share") >= REMOVE, KINDS.index("remove")).otherwise(KINDS.index("generalise")).cast("int")
    terms = shown.groupBy("row", "term").agg(kind.alias("kind"))
    terms = terms.groupBy("row").agg(F.collect_list(F.struct("term", "kind")).alias("disclosing"))
    places = scanned.join(terms, "row").select("row", "base", "held", "disclosing")
    places = places.mapInArrow(term_places, f"row bigint, terms {SP.SPANS}")
    joined = scanned.select("row", "doc_id", "base").join(places, "row", "left")
    none = F.array().cast(SP.SPANS)
    return joined.select("row", "doc_id", "base", F.sort_array(F.concat("base", F.coalesce("terms", none))).alias("spans"))


def sanitise(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with entities replaced by their kind, generalised terms by their class, and removed terms left out."""
    out, at = [], 0
    for start, kind, end in sorted(spans):
        if start < at:
            continue
        out.append(text[at:start])
        if kind < BASE:
            out.append(f"[{KINDS[kind].upper()}]")
        elif KINDS[kind] == "generalise":
            out.append("[NUMBER]" if text[start:end].isdigit() else "[NAME]" if text[start].isupper() else "[TERM]")
        at = end
    return "".join([*out, text[at:]])


def op2_disclosive_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the entities, and all spans, of every document."""
    found = scan_private(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[SP.of_kind(F.col("base"), k).alias(f"n_{KINDS[k]}") for k in range(BASE)],
        F.sha2(SP.span_string(F.col("base"), KINDS), 256).alias("base_sha256"),
        SP.span_string(F.col("spans"), KINDS).alias("spans"),
    )
