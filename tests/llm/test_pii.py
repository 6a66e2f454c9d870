import math
import random
import re

from pyspark.sql import functions as F

from tickspark.llm import pii


def brute(text):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and pii.luhn(digits):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_base_spans_equal_plain_patterns():
    rng = random.Random(3)
    for letters in ("a@.-b_%é ", "0123.5 ", "0-4 +", "+12 ().-a", "a@.1+ 5-"):
        for _ in range(4000):
            text = "".join(rng.choices(letters, k=rng.randint(0, 30)))
            assert [s[:3] for s in pii.base_spans(text)] == brute(text), text


def test_long_runs_stay_linear():
    for text in ("a" * 300_000, "a@" * 150_000, "1" * 300_000, "1." * 150_000, "+1 " * 100_000):
        pii.base_spans(text)


def test_terms_that_give_an_entity_away(spark):
    common = ["please", "write", "soon", "about", "this", "thing", "today", "again"]
    rng = random.Random(1)
    rows = [(i, f"{' '.join(rng.sample(common, 4))} Zorblatt {rng.choice(common)} mail z@x.org {' '.join(rng.sample(common, 3))}") for i in range(6)]
    rows += [(100 + i, " ".join(rng.choices(common, k=12)) + (f" mail u{i}@y.org" if i % 3 == 0 else "")) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r.spans for r in pii.find_spans(docs).collect()}
    for i, text in rows:
        extra = [text[s.start:s.end] for s in found[i] if s.kind in ("generalise", "remove")]
        assert extra == (["Zorblatt"] if i < 6 else [])
        assert [s.kind for s in found[i]][: text.count("@")] == ["email"] * text.count("@")
    ratio = pii.disclosure(docs, pii.scan(docs), least=0.0).where("term = 'zorblatt'").first().ratio
    assert math.isclose(ratio, math.log(206 * 6 / (6 * 6)) / math.log(206 / 6))
    cleaned = {r.doc_id: r.sanitised for r in pii.sanitise(docs).collect()}
    assert "Zorblatt" not in cleaned[0] and "[EMAIL]" in cleaned[0] and cleaned[101] == dict(rows)[101]


def test_term_slot_equals_spark(spark):
    words = ["a", "straße", "漢字", "x" * 100]
    df = spark.createDataFrame([(w,) for w in words], "term string")
    slots = [r[0] for r in df.select(F.pmod(F.xxhash64("term"), F.lit(1 << pii.BITMAP_BITS))).collect()]
    assert slots == [pii._spark_slot(w) for w in words]


def test_odd_rows(odd_docs, no_docs):
    assert pii.find_spans(odd_docs).count() == odd_docs.count()
    assert pii.find_spans(no_docs).count() == 0
    clash = odd_docs.withColumn("uid", F.lit(1)).withColumn("spans", F.lit("x"))
    out = pii.sanitise(clash)
    assert out.count() == odd_docs.count() and out.where("uid = 1").count() == odd_docs.count()


def test_terms_far_from_the_entity(spark):
    rng = random.Random(4)
    fill = ["mail", "please", "write", "soon", "about", "this", "thing", "today", "again"]
    text = lambda n: " ".join(rng.choices(fill, k=n))
    rows = [(i, f"Zorblatt {text(40)} mail z@x.org") for i in range(6)]
    rows += [(20 + i, f"{text(3)} Quimby {text(3)} q@x.org {text(3)}") for i in range(8)]
    rows += [(40, f"Quimby {text(60)} q@x.org"), (41, f"{text(30)} Quimby")]
    rows += [(60, rows[0][1]), (0, rows[0][1])]  # a repeated text, and a repeated row
    rows += [(100 + i, text(30)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {(r.doc_id, r.uid): r.spans for r in pii.find_spans(docs).collect()}
    texts = dict(rows)
    for (i, _), spans in found.items():
        extra = [texts[i][s.start:s.end] for s in spans if s.kind in ("generalise", "remove")]
        assert extra == (["Zorblatt"] if i < 6 or i == 60 else ["Quimby"] if i <= 40 else []), i
    ratios = {r.term: r.ratio for r in pii.disclosure(docs, pii.scan(docs), least=0.5).collect()}
    n = len(rows)
    assert math.isclose(ratios["zorblatt"], math.log(n * 8 / (8 * 8)) / math.log(n / 8))
    assert math.isclose(ratios["quimby"], math.log(n * 9 / (10 * 9)) / math.log(n / 9))


def test_a_copied_passage_is_one_context(spark):
    rows = [(i, "write to Zorblatt at z@x.org soon") for i in range(6)] + [(100 + i, f"other text {i}") for i in range(100)]
    found = pii.find_spans(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert not [s for r in found for s in r.spans if s.kind in ("generalise", "remove")]
