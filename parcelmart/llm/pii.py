"""Personal data: base patterns, and terms that give a protected entity away.

The entities are the e-mail addresses, IP addresses, card and phone numbers that the patterns
find; a context is a line. Over the lines of the whole corpus, a term ``t`` that stands in lines
with an entity ``e`` reveals the share ``PMI(e, t) / IC(e)`` of the entity's information, where
``PMI = log(N c(e,t) / (c(e) c(t)))`` and ``IC = log(N / c(e))``. A term at or above the
disclosure threshold, seen with the entity in two different lines or in at least ``min_support``
lines with copies, is marked in every line that holds both, and is generalised to a label or
removed with the base spans.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmart.llm.common import mapped, written
from parcelmart.llm.words import runs, word_hashes, word_spans

# The base patterns of the contract.
KINDS = ["email", "ip", "card", "phone"]
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_DIGIT = re.compile("[0-9]")
_NOT_DIGIT = re.compile("[^0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# Lines, copies counted, in which a term must stand with an entity if all of them are copies of one.
MIN_SUPPORT = 11

# A term is a run of ASCII letters and digits and of all characters beyond ASCII.
_NO_TERM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of EMAIL. A match holds the whole run of local characters before its @, so only
    that run is tried at each @, and runs without one cost nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = EMAIL.match(text, start) if start < at else None
        if found:
            yield found.span()
            done = found.end()
        at = text.find("@", max(done, at + 1))


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind and start, in code points. Failing matches are dropped whole."""
    out = [("email", *span) for span in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def _hash(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _entity(kind: str, value: str) -> int:
    return _hash(f"{kind}:{value.lower() if kind in ('email', 'ip') else _NOT_DIGIT.sub('', value)}")


def _line_terms(line: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends (code points) of the terms of a line."""
    data = np.frombuffer(line.encode("utf-8", "surrogatepass"), np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]), _NO_TERM)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return word_hashes(data, starts, ends).view(np.int64), points[starts], points[ends]


FOUND = (
    "row long, doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, "
    "entities array<struct<line:long,parts:int,entity:long>>, "
    "terms array<struct<line:long,parts:int,term:long,fresh:boolean,start:int,end:int>>"
)
ENTITY_FIELDS = {"line": pa.int64(), "parts": pa.int32(), "entity": pa.int64()}
TERM_FIELDS = {"line": pa.int64(), "parts": pa.int32(), "term": pa.int64(), "fresh": pa.bool_(), "start": pa.int32(), "end": pa.int32()}
PART = 256  # entities of a line that meet its terms in one group of a shuffle


def _lines_of(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[int, str, list[tuple[str, int, int]]]]:
    """(start, line, its spans by start) of each line with spans. No span runs over a line end."""
    breaks = [m.start() for m in re.finditer("\n", text)]
    held: dict[int, list[tuple[str, int, int]]] = {}
    for span in spans:
        held.setdefault(bisect_left(breaks, span[1]), []).append(span)
    for k, own in held.items():
        start = breaks[k - 1] + 1 if k else 0
        yield start, text[start : breaks[k] if k < len(breaks) else len(text)], sorted(own, key=lambda s: s[1])


def _free_terms(line: str, start: int, spans: list[tuple[str, int, int]]) -> list[np.ndarray]:
    """Hash, first occurrence or not, start and end of the line's terms that touch none of its spans."""
    term, first, last = _line_terms(line)
    first, last = first + start, last + start
    ends = np.maximum.accumulate([s[2] for s in spans])  # the first to pass a point is the first span that ends behind it
    at = np.searchsorted(ends, first, side="right")
    begins = np.append([s[1] for s in spans], np.iinfo(np.int64).max)
    free = begins[at] >= last
    term, first, last = term[free], first[free], last[free]
    fresh = np.zeros(len(term), bool)
    fresh[np.unique(term, return_index=True)[1]] = True
    return [term, fresh, first, last]


def _lists(rows: list[list[np.ndarray]], fields: dict[str, pa.DataType]) -> pa.ListArray:
    """One list of structs for each row, given as blocks of a (line of) columns."""
    sizes = [sum(len(block[0]) for block in row) for row in rows]
    blocks = [block for row in rows for block in row]
    columns = [
        pa.array(np.concatenate([block[k] for block in blocks]) if blocks else [], kind)
        for k, kind in enumerate(fields.values())
    ]
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, names=list(fields)))


def _detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each row its base spans, and for each of its lines with entities these (once a line) and the
    occurrences of the line's other terms, side by side: no pairs, so a row grows with its text.
    ``fresh`` marks the first occurrence of a term in its line."""
    for batch in batches:
        counts, bases, entities, terms = {k: [] for k in KINDS}, [], [], []
        for value in batch.column(2):
            text = value.as_py() or ""
            spans = base_spans(text)
            for kind in KINDS:
                counts[kind].append(sum(s[0] == kind for s in spans))
            bases.append(",".join(f"{k}:{a}:{b}" for k, a, b in spans))
            entities.append([])
            terms.append([])
            for start, line, own in _lines_of(text, spans) if spans else ():
                found = np.unique(np.array([_entity(kind, text[a:b]) for kind, a, b in own], np.int64))
                code, parts = _hash(line), 1 + len(found) // PART
                free = _free_terms(line, start, own)
                entities[-1].append([np.full(len(found), code), np.full(len(found), parts), found])
                terms[-1].append([np.full(len(free[0]), code), np.full(len(free[0]), parts), *free])
        yield pa.record_batch(
            [
                batch.column(0),
                batch.column(1),
                *(pa.array(counts[k], pa.int64()) for k in KINDS),
                pa.array(bases, pa.string()),
                _lists(entities, ENTITY_FIELDS),
                _lists(terms, TERM_FIELDS),
            ],
            names=["row", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", "entities", "terms"],
        )


def _merged(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    h, c = np.concatenate(hashes), np.concatenate(counts)
    order = np.argsort(h)
    h, c = h[order], c[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    return h[first], np.add.reduceat(c, first)


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, number of lines that hold it), and under a null term the number of lines."""

    def rows(h, c):
        return pa.record_batch([pa.array(h.view(np.int64)), pa.array(c)], names=["term", "lines"])

    hashes, counts, held, lines = [], [], 0, 0
    for batch in batches:
        for _, _, data, offsets in runs(batch.column(0)):
            breaks = np.cumsum(data == 0x0A)
            lines += int(breaks[-1]) if len(data) else 0
            lines += len(offsets) - 1
            starts, ends, first_word = word_spans(data, offsets, _NO_TERM)
            if not len(starts):
                continue
            row = np.repeat(np.arange(len(offsets) - 1), np.diff(first_word))
            h = word_hashes(data, starts, ends)
            order = np.argsort(h, kind="stable")  # the lines of a term stay in order
            h, line = h[order], (breaks[starts] + row)[order]
            fresh = np.concatenate([[True], (h[1:] != h[:-1]) | (line[1:] != line[:-1])])
            h = h[fresh]
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            hashes.append(h[first])
            counts.append(np.diff(np.append(first, len(h))).astype(np.int64))
            held += len(first)
            if held > 2_000_000:
                h, c = _merged(hashes, counts)
                if len(h) > 1_000_000:
                    yield rows(h, c)
                    hashes, counts, held = [], [], 0
                else:
                    hashes, counts, held = [h], [c], len(h)
    if hashes:
        yield rows(*_merged(hashes, counts))
    yield pa.record_batch([pa.array([None], pa.int64()), pa.array([lines], pa.int64())], names=["term", "lines"])


def _numbered(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
    )


def find_spans(
    docs: DataFrame, disclosure: float = 0.8, doc_id: str = "doc_id", text: str = "text", min_support: int = MIN_SUPPORT
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base (the base spans as
    kind:start:end, by kind and start), added (the spans of revealing terms, likewise).

    Null and empty texts hold nothing. Repeated rows are found alike. A term has support if it stands
    with the entity in two different lines, or in ``min_support`` lines, copies counted; with a
    ``min_support`` of 1 the disclosure alone decides. Ids may be null or repeat. Only the named
    columns are read. Corpus counts are taken over all lines of all rows; an empty table gives no
    rows. Counts of hot terms and entities are summed before they are shuffled.
    """
    return _spans_of(_numbered(docs, doc_id, text), disclosure, min_support).drop("row")


def _per_line(found: DataFrame, column: str, name: str) -> DataFrame:
    """(line, parts, ``name``, copies) for each different line and each of its entities or terms."""
    each = found.select(F.explode(column).alias("x")).select("x.line", "x.parts", f"x.{name}")
    return written(each.groupBy("line", "parts", name).agg(F.count("*").alias("copies")), f"pii-{column}")


def _support(lines: Column, copies: Column, min_support: int) -> Column:
    return (lines > 1) | (copies >= min_support)


def _supported(per_line: DataFrame, name: str, min_support: int) -> DataFrame:
    """The rows of the entities or terms that have support by themselves: no pair has more than its sides."""
    enough = (
        per_line.groupBy(name)
        .agg(F.count("*").alias("lines"), F.sum("copies").alias("copies"))
        .filter(_support(F.col("lines"), F.col("copies"), min_support))
    )
    return per_line.join(enough.select(name), name, "left_semi")


def _pairs(held: DataFrame, beside: DataFrame) -> DataFrame:
    """(line, entity, term, copies): the entities of a line beside its terms. A line of very many entities is cut
    into parts of them, each of which meets all terms, so none is one group of the shuffle."""
    left = held.select("line", F.pmod("entity", "parts").alias("part"), "entity", "copies")
    right = beside.select("line", F.explode(F.expr("sequence(0L, parts - 1L)")).alias("part"), "term")
    return left.join(right, ["line", "part"]).select("line", "entity", "term", "copies")


def _spans_of(rows: DataFrame, disclosure: float, min_support: int) -> DataFrame:
    found = written(mapped(rows, _detect, FOUND), "pii-found")
    corpus = written(
        rows.select("text")
        .mapInArrow(_term_counts, "term long, lines long")
        .groupBy("term")
        .agg(F.sum("lines").alias("term_lines")),
        "pii-terms",
    )
    total = corpus.filter("term is null").agg(F.coalesce(F.sum("term_lines"), F.lit(0))).first()[0]
    held = _per_line(found, "entities", "entity")
    beside = _per_line(found.withColumn("terms", F.filter("terms", lambda t: t["fresh"])), "terms", "term")
    pairs = _pairs(_supported(held, "entity", min_support), _supported(beside, "term", min_support))
    joint = (
        pairs.groupBy("entity", "term")
        .agg(F.sum("copies").alias("both"), F.count("*").alias("lines"))
        .filter(_support(F.col("lines"), F.col("both"), min_support))
        .select("entity", "term", "both")
    )
    alone = held.groupBy("entity").agg(F.sum("copies").alias("entity_lines"))
    shared = F.log(F.lit(float(total)) * F.col("both") / (F.col("entity_lines").cast("double") * F.col("term_lines")))
    revealing = written(
        joint.join(alone, "entity")
        .join(corpus, "term")
        .filter(shared >= disclosure * F.log(F.lit(float(total)) / F.col("entity_lines")))
        .filter(shared > 0)
        .select("entity", "term"),
        "pii-revealing",
    )
    of_entity, of_term = (revealing.select(c).distinct() for c in ("entity", "term"))
    marked = (
        _pairs(held.join(of_entity, "entity", "left_semi"), beside.join(of_term, "term", "left_semi"))
        .join(revealing, ["entity", "term"], "left_semi")
        .select("line", "term")
        .distinct()
    )
    added = (
        found.select("row", F.explode("terms").alias("t"))
        .select("row", "t.line", "t.term", "t.start", "t.end")
        .join(marked, ["line", "term"], "left_semi")
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
        .select("row", F.expr("array_join(transform(spans, s -> concat('term:', s.start, ':', s.end)), ',')").alias("added"))
    )
    return (
        found.select("row", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base")
        .join(added, "row", "left")
        .withColumn("added", F.coalesce("added", F.lit("")))
    )


def all_spans(base: str = "base", added: str = "added") -> Column:
    """Base and added spans in one string."""
    return F.array_join(F.filter(F.array(base, added), lambda s: s != ""), ",")


def _redact(remove: bool):
    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                marks = sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in (spans or "").split(",") if s))
                parts, done = [], 0
                for a, b, kind in marks:
                    if b <= done:
                        continue
                    a = max(a, done)
                    parts += [text[done:a], "" if remove else f"[{kind}]"]
                    done = b
                out.append(None if text is None else "".join([*parts, text[done:]]))
            yield pa.record_batch([batch.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])

    return redact


def sanitise(
    docs: DataFrame,
    remove: bool = False,
    disclosure: float = 0.8,
    doc_id: str = "doc_id",
    text: str = "text",
    min_support: int = MIN_SUPPORT,
) -> DataFrame:
    """doc_id and text with every span generalised to its kind in brackets, or removed. Overlapping
    spans count as one; null texts stay null."""
    rows = written(_numbered(docs, doc_id, text), "pii-texts")
    spans = _spans_of(rows, disclosure, min_support).select("row", all_spans().alias("spans"))
    return (
        rows.join(spans.filter("spans <> ''"), "row", "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(_redact(remove), "doc_id long, text string")
    )
