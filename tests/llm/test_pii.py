import math
import random
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelmart.llm.pii import _detect, all_spans, base_spans, find_spans, sanitise

SCHEMA = "doc_id long, text string, row long, entity long, base string"
parts = st.lists(st.sampled_from(["a", "@", ".", "b-", "1", "23", "256", "+", "+1", " ", "-", "(", ")", "é", "4012888888881881", "0000000000000", "\n", "%"]), max_size=30)


def luhn(digits):
    d = [int(c) for c in reversed(digits)]
    return (sum(d[::2]) + sum(sum(divmod(2 * v, 10)) for v in d[1::2])) % 10 == 0


def plain(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return out


@given(parts)
@settings(max_examples=500, deadline=None)
def test_base_spans_are_those_of_the_patterns(words):
    text = "".join(words)
    assert base_spans(text) == plain(text)


def test_long_runs_take_linear_time():
    assert base_spans("1" * 200000) == [] and base_spans("a" * 200000 + " @ " + "a.b" * 50000) == []


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], SCHEMA)


def corpus():
    common = [(k, f"the weather of day {k} is fine and the sea is calm") for k in range(60)]
    secret = [
        (100, "the Zanzibar office writes to kim@corp.example today"),
        (101, "nothing here\nask kim@corp.example about Zanzibar and the sea"),
        (102, "Zanzibar alone says nothing"),
        (103, "the sea was seen by lee@corp.example"),
    ]
    return common + secret


def test_terms_that_reveal_an_entity(spark):
    rows = dict(corpus())
    got = {r.doc_id: r.added for r in find_spans(frame(spark, corpus())).collect()}
    marked = {i: [rows[i][int(s.split(":")[1]) : int(s.split(":")[2])] for s in a.split(",") if s] for i, a in got.items()}
    assert marked[100] == ["Zanzibar"] and marked[101] == ["Zanzibar"]
    assert not any(marked[i] for i in rows if i not in (100, 101))
    text = {r.doc_id: r.text for r in sanitise(frame(spark, corpus())).collect()}
    assert text[100] == "the [term] office writes to [email] today" and text[102] == rows[102]
    text = {r.doc_id: r.text for r in sanitise(frame(spark, corpus()), remove=True).collect()}
    assert text[100] == "the  office writes to  today"


def test_copies_of_a_line_are_no_support(spark):
    rows = [r for r in corpus() if r[0] < 100] + [(k, "the Zanzibar office writes to kim@corp.example today") for k in range(100, 110)]
    assert all(r.added == "" for r in find_spans(frame(spark, rows)).collect())


def test_edges(spark):
    rows = [(1, None), (2, ""), (None, "a@b.c"), (3, "é a@b.c 1.2.3.4"), (3, "é a@b.c 1.2.3.4"), (4, "x " * 100000 + "+1 555 123 4567")]
    got = sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base) for r in find_spans(frame(spark, rows)).collect()), key=str)
    want = [(i, *(sum(s[0] == k for s in plain(t or "")) for k in ("email", "ip", "card", "phone")), ",".join(f"{k}:{a}:{b}" for k, a, b in plain(t or ""))) for i, t in rows]
    assert got == sorted(want, key=str)
    assert find_spans(frame(spark, [])).collect() == []
    spans = find_spans(frame(spark, rows)).select(all_spans().alias("s"))
    assert sorted(r.s for r in spans.collect()) == sorted(w[-1] for w in want)


def test_many_copies_of_a_line_are_support(spark):
    line = "the Zanzibar office writes to kim@corp.example today"
    rows = [r for r in corpus() if r[0] < 100] + [(k, line) for k in range(100, 130)]
    got = {r.doc_id: [line[int(s.split(":")[1]) : int(s.split(":")[2])] for s in r.added.split(",") if s] for r in find_spans(frame(spark, rows)).collect()}
    assert got.pop(100) == ["Zanzibar", "office", "writes", "to", "today"] and not any(got[k] for k in range(60))
    few = rows[:61]
    assert all(r.added == "" for r in find_spans(frame(spark, few)).collect())
    assert "term" in next(r.added for r in find_spans(frame(spark, few), min_support=1).collect() if r.doc_id == 100)


def disclosed(rows, disclosure, min_support):
    """The added spans of each row, by counting every line of every row."""
    lines, spans_of = [], []
    for k, (_, text) in enumerate(rows):
        start = 0
        for line in text.split("\n"):
            own = plain(line)
            entities = {(kind, line[a:b].lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", line[a:b])) for kind, a, b in own}
            found = [(m[0], m.start(), m.end()) for m in re.finditer(r"(?:[A-Za-z0-9]|[^\x00-\x7f])+", line)]
            free = [(t, a, b) for t, a, b in found if not any(a < y and x < b for _, x, y in own)]
            lines.append((k, start, line, entities, {t for t, _, _ in found}, free))
            start += len(line) + 1
    added = [[] for _ in rows]
    for k, start, line, entities, _, free in lines:
        for term, a, b in free:
            for e in entities:
                both = [x for x in lines if e in x[3] and term in {t for t, _, _ in x[5]}]
                if len({x[2] for x in both}) < 2 and len(both) < min_support:
                    continue
                n_entity, n_term = sum(e in x[3] for x in lines), sum(term in x[4] for x in lines)
                shared = math.log(len(lines) * len(both) / (n_entity * n_term))
                if shared > 0 and shared >= disclosure * math.log(len(lines) / n_entity):
                    added[k].append((a + start, b + start))
                    break
    return [",".join(f"term:{a}:{b}" for a, b in sorted(x)) for x in added]


@pytest.mark.parametrize(("seed", "min_support"), [(1, 11), (2, 3), (3, 1)])
def test_disclosure_against_counting_every_line(spark, seed, min_support):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["é" * 3, "the", "the", "the"]
    kept = ["kim@corp.example", "LEE@corp.example", "10.0.0.7", "+1 555 123 4567", "4012888888881881"]
    line = lambda: " ".join(draw.choices(words, k=draw.randint(0, 5)) + draw.choices(kept, k=draw.choice([0, 0, 1, 2])) + draw.choices(words, k=2))
    copied = [line() for _ in range(4)]
    rows = [(k, "\n".join(draw.choice(copied) if draw.random() < 0.3 else line() for _ in range(draw.randint(1, 4)))) for k in range(60)]
    got = {r.doc_id: r.added for r in find_spans(frame(spark, rows), 0.6, min_support=min_support).collect()}
    want = disclosed(rows, 0.6, min_support)
    assert [got[k] for k in range(60)] == want and any(want)


def test_a_line_of_very_many_addresses_takes_memory_by_its_length():
    text = " ".join(f"w{i} user{i}@host{i}.example" for i in range(30000))
    batch = pa.record_batch([pa.array([0]), pa.array([1]), pa.array([text])], names=["row", "doc_id", "text"])
    (out,) = _detect(iter([batch]))
    assert out.column("n_email")[0].as_py() == 30000 and out.nbytes < 5 * len(text)


def test_a_line_of_more_entities_than_a_part_holds(spark):
    people = " ".join(f"u{i}@corp.example" for i in range(600))
    rows = [(k, f"the weather of day {k}") for k in range(60)] + [(100, f"Zanzibar {people}"), (101, f"at Zanzibar {people}"), (102, "Zanzibar alone")]
    got = {r.doc_id: r.added for r in find_spans(frame(spark, rows)).collect()}
    assert got.pop(100) == "term:0:8" and got.pop(101) == "term:3:11" and not any(got.values())
