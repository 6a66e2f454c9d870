import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from tickspark.llm.exact_dedup import MODULUS, POINTS, Fingerprint, exact_duplicates, normalised


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[plain(text)].append(key)
    out = Counter()
    for text, keys in groups.items():
        keys.sort(key=lambda k: (k is None, k))
        sha = hashlib.sha256(text.encode()).hexdigest()
        out.update((k, keys[0], len(keys), i == 0, sha) for i, k in enumerate(keys))
    return out


def found(df, **options):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_duplicates(df, **options).collect())


def random_docs(seed, n=300):
    rng = random.Random(seed)
    blanks = [" ", "  ", "\n", "\t ", " \r\n\x0b\x0c", " ", " "]
    texts = ["".join(rng.choice(["a", "bc", "é", "漢字", "\x00", "\x1f", "ab"]) + rng.choice(blanks) for _ in range(rng.randint(0, 60)))
             for _ in range(40)]
    rows = []
    for i in range(n):
        text = rng.choice(texts)
        if rng.random() < 0.5:  # the same text with other white space
            text = re.sub(r"[\x20\x09-\x0D]+", lambda m: "".join(rng.choice("\t\n\x0b\x0c\r ") for _ in range(rng.randint(1, 3))), text)
        if rng.random() < 0.2 and text:  # one character changed
            at = rng.randrange(len(text))
            text = text[:at] + "Z" + text[at + 1:]
        rows.append((i, text))
    rng.shuffle(rows)
    return rows


def test_normalised_bytes():
    for text in ("", " ", "  a \t b\n", "\x1c\x85a\x0b\x0c b", "é  　", "\t", "a \x1f b"):
        assert normalised(text.encode()).decode() == plain(text)


def test_fingerprints_compose():
    rng = random.Random(5)
    text = rng.randbytes(5000)
    for modulus in (MODULUS, 101):
        f = Fingerprint(modulus, 700)
        want = tuple(sum(b * pow(r, len(text) - 1 - i, modulus) for i, b in enumerate(text)) % modulus for r in POINTS)
        for size in (1, 64, 700):
            parts = [(a, text[a: a + size]) for a in range(0, len(text), size)]
            terms = [f.shifted(f.of(p), len(text) - a - len(p)) for a, p in parts]
            assert tuple(sum(t[i] for t in terms) % modulus for i in (0, 1)) == want


@pytest.mark.parametrize("options", [{}, {"chunk": 16, "huge": 40}, {"chunk": 16, "huge": 40, "listed": 0}, {"chunk": 7, "huge": 1 << 30}])
def test_equals_brute_force(spark, options):
    rows = random_docs(1)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert found(df, **options) == brute(rows)


@pytest.mark.parametrize("huge", [40, 1 << 20])
def test_colliding_fingerprints_are_told_apart(spark, huge):
    rows = [(i, f"{i % 90:03d}" * 30) for i in range(200)]  # one length: the fingerprint alone decides
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert found(df, chunk=16, huge=huge, modulus=3) == brute(rows)


def test_odd_rows(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    odd = odd_docs.withColumnsRenamed({"lang": "row", "source": "KEEP_ID", "n_chars": "chunks"})
    for df in (odd_docs, odd):
        assert found(df) == brute(rows)
        assert exact_duplicates(df).columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert found(odd_docs, chunk=100, huge=1000) == brute(rows)


def test_empty_table_and_other_keys(spark, no_docs):
    assert exact_duplicates(no_docs).count() == 0
    df = spark.createDataFrame([("b", "x y"), ("a", "x\ty"), ("c", " x y"), (None, None), (None, "")], "name string, body string")
    out = Counter((r.name, r.keep_id, r.group_size, r.kept) for r in exact_duplicates(df, "name", "body").collect())
    assert out == Counter([("b", "a", 2, False), ("a", "a", 2, True), ("c", "c", 1, True), (None, None, 2, True), (None, None, 2, False)])
    with pytest.raises(ValueError):
        exact_duplicates(df, "name", "body", chunk=0)


def test_a_group_of_many_copies(spark):
    text = "many copies of\none text " * 20
    rows = [(i, text if i % 3 else f"{text}{i}") for i in range(3000)] + [(1, text)] * 500
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    assert found(df, chunk=64) == brute(rows)
