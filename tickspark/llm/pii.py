"""Personal data: pattern detection and information-theoretic sanitisation.

Patterns find e-mail addresses, IP addresses, card numbers and phone numbers; each distinct value is a
protected entity. Terms can give an entity away even where its value is hidden. How much a term reveals
is estimated from the corpus: with ``c`` counts of documents, the share of an entity's information that a
term carries is ``PMI(term; entity) / IC(entity)``, where ``PMI = log(N c(t, e) / (c(t) c(e)))`` and
``IC = log(N / c(e))``. A term is counted with an entity in every document that holds both, however far apart. The
context of a pair is the ``window`` words on each side of the entity's value and of the term, where each comes first. Pairs
that share fewer than ``support`` different contexts are chance, not evidence. In the documents that hold the
entity, terms at or above ``generalise`` are replaced by their class, at or above ``remove`` taken out.

Counts cover all documents. Term counts are wanted only for terms that passed the support test: a
bitmap of fixed size tells the scan which hash values matter, and a join on the term makes the result exact.

Defined cases: null text is empty and has no spans. Documents are told apart by ``doc_id`` and text, so
repeated rows get the same spans, and each row counts. Ties of spans keep their order by kind, start, end.
Empty tables give empty tables. Other columns stay in ``sanitise``; columns it adds replace equal names.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.llm.common import fitting_name, map_batches, stored

KINDS = ("email", "ip", "card", "phone")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]*")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
TERM = re.compile(r"[^\W\d_]{3,}")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
BITMAP_BITS = 20

Span = tuple[int, int, int, str]  # kind, start, end, normalised value


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their @ signs: the only way that stays linear on long runs of letters."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        tail = DOMAIN.match(text, at + 1) if start < at else None
        if tail:
            yield start, tail.end()
            done = tail.end()
        # the characters after this @ up to the next one cannot reach back over it
        done, at = max(done, at + 1), text.find("@", max(done, at + 1))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """All spans of the four kinds, by kind, then start."""
    out: list[Span] = []
    if "@" in text:
        out += [(0, a, b, text[a:b].lower()) for a, b in emails(text)]
    if DIGIT.search(text):
        if "." in text:
            for m in IP.finditer(text):
                parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
                if all(len(p) < 4 and int(p) < 256 for p in parts):
                    out.append((1, m.start(), m.end(), ".".join(parts)))
        for m in CARD.finditer(text):
            if m.end() - m.start() < 13:
                continue
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end(), digits))
        if "+" in text:
            for m in PHONE.finditer(text):
                digits = "".join(DIGIT.findall(m[0]))
                if 9 <= len(digits) <= 15:
                    out.append((3, m.start(), m.end(), digits))
    return out


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def contexts(text: str, spans: list[Span], window: int) -> tuple[dict[int, int], dict[str, tuple[int, list[tuple[int, int]]]]]:
    """Entity -> a hash of the words around its first value; term -> a hash of the words around its first place, and its places."""
    found = [(m.start(), m.end(), m[0].lower()) for m in TERM.finditer(text)]
    covered = sorted((a, b) for _, a, b, _ in spans)
    merged: list[list[int]] = []
    for a, b in covered:
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    ends = [m[1] for m in merged]

    def free(t: tuple[int, int, str]) -> bool:
        i = bisect_left(ends, t[0] + 1)
        return i == len(merged) or merged[i][0] >= t[1]

    found = [t for t in found if free(t)]
    starts = [t[0] for t in found]
    entities: dict[int, int] = {}
    for kind, a, b, value in spans:
        entity = _hash(f"{KINDS[kind]}:{value}")
        if entity not in entities:
            i, j = bisect_left(starts, a), bisect_left(starts, b)
            entities[entity] = _hash(" ".join(t[2] for t in found[max(0, i - window): i] + found[j: j + window]))
    terms: dict[str, tuple[int, list[tuple[int, int]]]] = {}
    for i, (a, b, t) in enumerate(found):
        if t in terms:
            terms[t][1].append((a, b))
        else:
            terms[t] = _hash(" ".join(w[2] for w in found[max(0, i - window): i + window + 1])), [(a, b)]
    return entities, terms


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 8) -> DataFrame:
    """One row per document: its key, ``uid``, base spans and, where it has any, its entities and all its terms."""
    rows = docs.select(key, F.xxhash64(key, text).alias("uid"), text)
    kind = rows.schema[key].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("entity", pa.int64())]))
    entity = pa.list_(pa.struct([("entity", pa.int64()), ("context", pa.int64())]))
    place = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    term = pa.list_(pa.struct([("term", pa.string()), ("context", pa.int64()), ("places", place)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, entities, terms = [], [], []
            for t in batch.column(2).to_pylist():
                found = base_spans(t) if t else []
                held, stand = contexts(t, found, window) if found else ({}, {})
                spans.append([{"kind": k, "start": a, "end": b, "entity": _hash(f"{KINDS[k]}:{v}")} for k, a, b, v in found])
                entities.append([{"entity": e, "context": c} for e, c in held.items()])
                terms.append([{"term": w, "context": c, "places": [{"start": a, "end": b} for a, b in at]} for w, (c, at) in stand.items()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(spans, span), pa.array(entities, entity), pa.array(terms, term)],
                [key, "uid", "base", "entities", "terms"])

    return map_batches(rows, run, f"`{key}` {kind}, uid bigint, base array<struct<kind:int,start:bigint,end:bigint,entity:bigint>>, "
                                  "entities array<struct<entity:bigint,context:bigint>>, "
                                  "terms array<struct<term:string,context:bigint,places:array<struct<start:bigint,end:bigint>>>>")


def holders(scanned: DataFrame) -> DataFrame:
    """The documents that hold entities, each ``uid`` once with ``m``, the number of its rows."""
    return stored(scanned.where(F.size("entities") > 0).groupBy("uid").agg(
        F.count("*").alias("m"), F.first("entities").alias("entities"), F.first("terms").alias("terms")), "holders")


def term_counts(docs: DataFrame, terms: DataFrame, text: str = "text") -> DataFrame:
    """``term``, ``c_t``: in how many documents each of ``terms`` stands."""
    bits = np.zeros(1 << BITMAP_BITS, bool)
    slots = terms.select(F.pmod(F.xxhash64("term"), F.lit(1 << BITMAP_BITS)).alias("slot")).distinct()
    bits[[r[0] for r in slots.collect()]] = True  # at most 2 ** BITMAP_BITS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        wanted: dict[str, bool] = {}
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if t:
                    for w in set(TERM.findall(t.lower())):
                        hit = wanted.get(w)
                        if hit is None:
                            if len(wanted) > 500_000:
                                wanted.clear()
                            hit = wanted[w] = bool(bits[_spark_slot(w)])
                        if hit:
                            counts[w] += 1
        yield pa.RecordBatch.from_pydict({"term": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})

    return map_batches(docs.select(text), run, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("c_t"))


def _spark_slot(term: str) -> int:
    """``pmod(xxhash64(term), 2 ** BITMAP_BITS)`` as Spark computes it."""
    return xxhash.xxh64_intdigest(term.encode("utf-8", "surrogatepass"), seed=42) & ((1 << BITMAP_BITS) - 1)


def disclosure(docs: DataFrame, scanned: DataFrame, text: str = "text", support: int = 3, least: float = 0.75,
               held: DataFrame | None = None) -> DataFrame:
    """``entity``, ``term``, ``ratio`` of the pairs whose disclosure ratio is at least ``least``."""
    held = holders(scanned) if held is None else held
    entities = stored(held.select("m", F.explode("entities").alias("e")).groupBy("e.entity").agg(F.sum("m").alias("c_e")), "entities")
    # A pair has at most as many contexts as its entity has documents.
    often = held.select("uid", F.explode("entities").alias("e")).select("uid", "e.*").join(
        entities.where(F.col("c_e") >= support).select("entity"), "entity")
    pairs = often.select("uid", "entity", F.col("context").alias("near")).join(held.select("uid", "m", "terms"), "uid").select(
        "entity", "m", "near", F.explode("terms").alias("t")).select(
        "entity", "t.term", F.xxhash64("near", "t.context").alias("context"), "m")
    joint = pairs.groupBy("entity", "term", "context").agg(F.sum("m").alias("n")).groupBy("entity", "term").agg(
        F.sum("n").alias("c_et"), F.count("*").alias("contexts")).where(F.col("contexts") >= support)
    joint = stored(joint.select("entity", "term", "c_et"), "joint")
    n = docs.count()
    counts = stored(term_counts(docs, joint, text), "terms")
    pmi = F.log(F.lit(float(n)) * F.col("c_et") / (F.col("c_t") * F.col("c_e")))
    information = F.log(F.lit(float(n)) / F.col("c_e"))
    return joint.join(counts, "term").join(entities, "entity").where("c_e < %d" % n).select(
        "entity", "term", (pmi / information).alias("ratio")).where(F.col("ratio") >= least)


def find_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 8, support: int = 3,
               generalise: float = 0.75, remove: float = 0.95) -> DataFrame:
    """``key``, ``uid`` and ``spans`` of every document: an array of (kind, start, end) by kind, then start.

    Kinds are those of the patterns and ``generalise`` and ``remove`` for disclosing terms.
    """
    scanned = stored(scan(docs, key, text, window), "pii-scan")
    held = holders(scanned)
    disclosing = stored(disclosure(docs, scanned, text, support, generalise, held), "disclosing")
    # From the terms: few entities have a term that gives them away, but a frequent entity may have many terms.
    told = held.select("uid", F.explode("terms").alias("t")).select("uid", "t.term", "t.places").join(disclosing, "term")
    hits = told.join(held.select("uid", F.explode("entities.entity").alias("entity")), ["uid", "entity"]).groupBy("uid", "term").agg(
        F.max("ratio").alias("ratio"), F.first("places").alias("places"))
    found = hits.select("uid", "ratio", F.explode("places").alias("w")).select("uid", "ratio", "w.*").groupBy("uid").agg(
        F.array_sort(F.collect_list(F.struct(
            F.when(F.col("ratio") >= remove, 5).otherwise(4).alias("k"), "start", "end"))).alias("terms"))
    names = F.array(*[F.lit(k) for k in (*KINDS, "generalise", "remove")])
    shown = lambda spans: F.transform(spans, lambda s: F.struct(
        F.get(names, s["k"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    kind = lambda spans: F.transform(spans, lambda s: F.struct(
        s["kind"].alias("k"), s["start"].alias("start"), s["end"].alias("end")))
    none = F.expr("CAST(array() AS ARRAY<STRUCT<k: INT, start: BIGINT, end: BIGINT>>)")
    return scanned.select(key, "uid", "base").join(found, "uid", "left").select(
        key, "uid", shown(F.concat(kind(F.col("base")), F.coalesce("terms", none))).alias("spans"))


def sanitise(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with ``sanitised``: values of patterns and generalised terms replaced by their class,
    removed terms taken out; and ``spans``."""
    docs = docs.drop("sanitised", "spans")
    uid = fitting_name(docs, "uid")
    spans = find_spans(docs, key, text, **options).select(F.col("uid").alias(uid), "spans").dropDuplicates([uid])
    joined = docs.withColumn(uid, F.xxhash64(key, text)).join(spans, uid, "left").drop(uid)
    replaced = fitting_name(joined, "text_to_clean")
    from pyspark.sql.types import StringType, StructType
    schema = StructType([*joined.schema.fields]).add("sanitised", StringType())
    at = joined.columns.index("spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [clean(t, s or []) for t, s in zip(batch.column(batch.num_columns - 1).to_pylist(), batch.column(at).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.string())], [*batch.schema.names[:-1], "sanitised"])

    return map_batches(joined.withColumn(replaced, F.col(text)), run, schema)


def clean(text: str | None, spans: list[dict]) -> str | None:
    """The text with its spans replaced; of overlapping spans the one that starts first and is longest counts."""
    if text is None:
        return None
    out, done = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= done:
            out.append(text[done: s["start"]])
            word = text[s["start"]: s["end"]]
            if s["kind"] == "generalise":
                out.append("[NAME]" if word[:1].isupper() else "[TERM]")
            elif s["kind"] != "remove":
                out.append(f"[{s['kind'].upper()}]")
        elif s["end"] <= done:
            continue
        done = max(done, s["end"])
    out.append(text[done:])
    return "".join(out)
