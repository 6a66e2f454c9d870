import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tickspark.llm import lm_scoring as L


def tokens(text):
    lower = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + [None]


def check(docs, out):
    rows = docs.collect()
    counts = Counter(t for r in rows if r.train for t in tokens(r.text))
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(r.doc_id), len(t := tokens(r.text)), sum(counts[w] > 0 for w in t), n,
                   round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t), 6)) for r in rows)
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out.collect())
    assert [w[:4] for w in want] == [g[:4] for g in got]
    assert all(w[4] == pytest.approx(g[4], abs=1e-5) for w, g in zip(want, got))


def test_counts_and_base_scores(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("train", F.col("doc_id") % 3 != 0)
    out = L.score(docs, "train")
    check(docs, out)
    scores = out.join(docs.select("doc_id", "train"), "doc_id").toPandas()
    assert (scores.score < 0).all()
    held = scores[~scores.train]
    assert held.score.sum() > held.base_score.sum()


def test_frequent_words_apart(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(L, "FREQUENT", 30)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).withColumn("train", F.col("doc_id") % 3 != 0)
    docs = docs.unionByName(spark.createDataFrame(  # a word that only documents held out have, in most places
        [(-i - 1, "unheard " * 5000 + f"w{i}", False) for i in range(3)], "doc_id bigint, text string, train boolean"), allowMissingColumns=True)
    check(docs, L.score(docs, "train"))


def plain_log10(stretches, asked, table_bits, rate=0.3):
    """The mixer word by word, bit by bit. ``stretches`` are learned one after the other; lists of (hash, is first)."""
    mask = (1 << 32) - 1
    root, tables = {}, [{}, {}]
    weights = {}
    refined = {}

    def places(words):
        one = two = 0
        before = (0, 0)
        for i, (h, first) in enumerate(words):
            one, two = (0, 0) if first or not i else (before[0], before[1])
            bases = (one * 0x9E3779B1 & mask, (one * 0x85EBCA6B & mask) ^ (two * 0xC2B2AE35 & mask))
            yield h % L.CLASSES, bases
            before = (h >> 32, one)

    def slots(bases, node):
        return [((b ^ (node * 0x27D4EB2F & mask)) * 0x165667B1 & mask) >> (32 - table_bits) for b in bases]

    def look(j, code, bases):
        node = code >> (L.CODE_BITS - j) | 1 << j
        counts = [root.get(node, (0, 0)), *[t.get(s, (0, 0)) for t, s in zip(tables, slots(bases, node))]]
        seen = [(sum(c) > 0) + (sum(c) > 8) for c in counts[1:]]
        gate = (j, *seen)
        x = [math.log((b + 0.4) / (a + 0.4)) for a, b in counts]
        z = sum(w * v for w, v in zip(weights.get(gate, [0.4] * 3), x))
        step = min(max(round(z * 2) + L.STEPS // 2, 0), L.STEPS - 1)
        return code >> (L.CODE_BITS - 1 - j) & 1, node, gate, x, z, step

    def add(counts, at, bit):
        a, b = counts.get(at, (0, 0))
        counts[at] = (a + (not bit), b + bit)

    for words in stretches:
        for j in range(L.CODE_BITS):
            moves, met = {}, []
            for code, bases in places(words):
                bit, node, gate, x, z, step = look(j, code, bases)
                moves.setdefault(gate, []).append([(bit - 1 / (1 + math.exp(-z))) * v for v in x])
                met.append((bit, node, bases, step))
            for gate, parts in moves.items():
                old = weights.get(gate, [0.4] * 3)
                weights[gate] = [w + rate * sum(p[k] for p in parts) / len(parts) for k, w in enumerate(old)]
            for bit, node, bases, step in met:
                add(refined, (node, step), bit)
                add(root, node, bit)
                for t, s in zip(tables, slots(bases, node)):
                    add(t, s, bit)
    out = []
    for code, bases in places(asked):
        total = 0.0
        for j in range(L.CODE_BITS):
            bit, node, gate, x, z, step = look(j, code, bases)
            a, b = refined.get((node, step), (0, 0))
            fine = (b + 8 / (1 + math.exp(-(step - L.STEPS // 2) / 2))) / (a + b + 8)
            p = (1 / (1 + math.exp(-z)) + fine) / 2
            total += math.log10(p if bit else 1 - p)
        out.append(total)
    return out


def test_mixer_equals_plain_version():
    import numpy as np
    rng = np.random.default_rng(6)
    vocabulary = rng.integers(0, 2**63, 30, dtype=np.int64).astype(np.uint64)

    def words(n):
        at = np.cumsum(rng.integers(0, 3, n)) % 30  # words follow each other, so contexts tell something
        first = rng.random(n) < 0.05
        first[0] = True
        return vocabulary[at], first

    learner, stretches = L.Learner(9), [words(n) for n in (200, 1, 300)]
    for w in stretches:
        learner.learn(*w)
    asked = words(150)
    as_lists = [list(zip(map(int, h), map(bool, f))) for h, f in [*stretches, asked]]
    got = L.Model(dict(learner.rows()), 9).log10(*asked)
    # numbers in 32 bits now and then fall on the other side of a step
    close = np.isclose(got, plain_log10(as_lists[:-1], as_lists[-1], 9), atol=1e-4)
    assert close.mean() > 0.97


def test_probabilities_of_all_words_add_up():
    import numpy as np
    learner = L.Learner(10)
    rng = np.random.default_rng(1)
    words = rng.integers(0, 2**63, 40, dtype=np.int64).astype(np.uint64)
    text = words[rng.integers(0, 40, 5000)]
    first = np.zeros(5000, bool)
    first[0] = True
    learner.learn(text, first)
    model = L.Model(dict(learner.rows()), 10)
    # every class code after the same two words: the probabilities of the classes add up to one
    total = 0.0
    for code in range(L.CLASSES):
        h = np.array([words[0], words[1], np.uint64(code)], np.uint64)
        total += 10 ** model.log10(h, np.array([True, False, False]))[2]
    assert abs(total - 1) < 1e-5


def test_odd_rows(odd_docs, no_docs):
    docs = odd_docs.withColumn("train", F.lit(True)).withColumn("places", F.lit(1)).withColumn("h", F.lit("x"))
    check(docs, L.score(docs, "train"))
    untrained = odd_docs.withColumn("train", F.lit(None).cast("boolean"))
    check(untrained, L.score(untrained, "train"))
    assert L.score(no_docs.withColumn("train", F.lit(True)), "train").count() == 0


def test_bits_of_the_text_are_predicted():
    """The bytes of all texts, repeated words and all, against the mixer that goes through them one by one."""
    import numpy as np
    texts = ["the cat sat on the mat the cat", "", "the mat", "x" * 700 + " the cat", None, "the cat sat \u00fc"]
    learner, ids = L.Learner(10, code_bits=8), L._Ids()
    docs = [ids.of(t) for t in texts * 3]
    spelled = L.Spelling(docs, ids, 10)
    learner.read(spelled)
    model = L.Model(dict(learner.rows()), 10, 8)
    got = model.texts(spelled)

    codes, one, two, firsts = [], [], [], []
    for d in docs:
        firsts.append(len(codes))
        before = 0
        for w in d:
            word = ids.words[w] + b" "
            codes += word
            one += L.Spelling.prefixes(np.frombuffer(word, np.uint8), np.array([0]), np.array([len(word)])).tolist()
            two += [before] * len(word)
            before = int(ids.hashes()[w] >> np.uint64(32))
    each = model.judge(L.Contexts.of(np.array(codes), np.array(one, np.uint32), np.array(two, np.uint32), 10))
    assert np.allclose(got, np.add.reduceat(each, firsts), atol=1e-6)
    # what was counted: each bit of each byte, once for each time it stands there
    assert learner.seen == len(codes) and learner.root[:, 1].sum() == len(codes)
    assert learner.root[1, 1] == sum(c >> 7 for c in codes)
    assert all(t.sum() == 8 * len(codes) for t in learner.tables)
    assert len(set(L.Spelling.prefixes(np.frombuffer(b"abcabc ", np.uint8), np.array([0]), np.array([7])).tolist())) == 7


def test_probabilities_of_all_bytes_add_up():
    import numpy as np
    learner, ids = L.Learner(12, code_bits=8), L._Ids()
    learner.read(L.Spelling([ids.of("the cat sat on the mat " * 20)], ids, 12))
    where = L.Contexts.of(np.arange(256), np.full(256, 7, np.uint32), np.full(256, 9, np.uint32), 12)
    assert abs((10 ** L.Model(dict(learner.rows()), 12, 8).judge(where)).sum() - 1) < 1e-4


def test_words_of_one_count_differ_by_their_bytes(spark):
    """Two unknown words cost what their bytes cost, not what one shared event costs."""
    docs = spark.createDataFrame([(i, "banana bandana banner " * 20, True) for i in range(8)] + [(8, "banan", False), (9, "qzjxv", False)],
                                 "doc_id bigint, text string, train boolean")
    got = {r.doc_id: r.score for r in L.score(docs, "train", unit="bytes").collect()}
    assert got[8] > got[9] + 3


def test_odd_rows_by_bytes(odd_docs):
    docs = odd_docs.withColumn("train", F.lit(True))
    check(docs, L.score(docs, "train", unit="bytes"))
    untrained = odd_docs.withColumn("train", F.lit(None).cast("boolean"))
    check(untrained, L.score(untrained, "train", unit="bytes"))


def spelled(texts):
    return [b"".join(w + b" " for w in (t or "").encode().lower().split()) + b" " for t in texts]


def test_grams_are_held_once_and_found_everywhere(monkeypatch):
    import numpy as np
    monkeypatch.setattr(L, "LOOK_BYTES", 64)  # long texts are cut, short ones taken together
    monkeypatch.setattr(L, "SUM_BYTES", 100)
    texts = ["the cat sat on the mat the cat", "", "the mat", "x" * 700 + " the cat", None, "the cat sat ü \x00 \x00a"] * 30
    docs = [L.spelled(t) for t in texts]
    assert docs == spelled(texts)
    grams = L.Grams(docs, 10)
    want = [int.from_bytes((bytes(5) + d)[i: i + 6], "big") for d in docs for i in range(len(d))]
    assert grams.keys[grams.gram].tolist() == want
    assert len(grams) - 1 == len(set(want))  # the distinct ones only: what stands often costs no more
    assert sorted(grams.times[1:].tolist()) == sorted(Counter(want).values())
    starts = np.cumsum([0, *map(len, docs)])
    values = np.arange(len(grams), dtype=float)
    assert grams.sums(values).tolist() == [values[grams.gram[a:b]].sum() for a, b in zip(starts, starts[1:])]


def test_full_slots_lose_no_gram(monkeypatch):
    monkeypatch.setattr(L, "LOOK_BITS", 3)
    docs = [L.spelled(" ".join(f"w{i * i}" for i in range(3000))), L.spelled("w1 w4")]
    grams = L.Grams(docs, 10)
    want = [int.from_bytes((bytes(5) + d)[i: i + 6], "big") for d in docs for i in range(len(d))]
    assert grams.keys[grams.gram].tolist() == want and grams.times.sum() == len(want)


def plain_grams(chunks, asked, table_bits):
    """The mixer over bytes, place by place; each chunk counted, then predicted without the place itself."""
    mask = (1 << 32) - 1
    root, tables, weights, refined = {}, [{} for _ in L.ORDERS], {}, {}

    def places(docs):
        return [(int.from_bytes((bytes(5) + d)[i: i + 6], "big")) for d in docs for i in range(len(d))]

    def look(j, key):
        code = key & 255
        node = code >> (8 - j) | 1 << j
        at = [key & 0xFF00 | node]
        for order in L.ORDERS[1:]:
            base = ((key >> 8 & (1 << 8 * order) - 1) * L.POWER & (1 << 64) - 1) >> 32
            at.append(((base ^ (node * 0x27D4EB2F & mask)) * 0x165667B1 & mask) >> (32 - table_bits))
        return code >> (7 - j) & 1, node, list(zip([root, *tables], [node, *at]))

    def predict(j, counts):
        gate = (j, *((sum(c) > 0) + (sum(c) > 8) for c in counts[-2:]))
        x = [math.log((b + 0.4) / (a + 0.4)) for a, b in counts]
        z = sum(w * v for w, v in zip(weights.get(gate, [0.2] * 6), x))
        return gate, x, z, min(max(round(z * 2) + L.STEPS // 2, 0), L.STEPS - 1)

    for docs in chunks:
        keys = places(docs)
        for key in keys:
            for j in range(8):
                bit, node, at = look(j, key)
                for t, s in at:
                    a, b = t.get(s, (0, 0))
                    t[s] = (a + (not bit), b + bit)
        for j in range(8):
            moves = {}
            for key in keys:
                bit, node, at = look(j, key)
                gate, x, z, step = predict(j, [(a - (not bit), b - bit) for a, b in (t[s] for t, s in at)])
                p = 1 / (1 + math.exp(-z))
                moves.setdefault(gate, []).append(((p * (1 - p) + L.LEAST) * sum(v * v for v in x) + L.FLAT, [(bit - p) * v for v in x]))
                a, b = refined.get((node, step), (0, 0))
                refined[node, step] = (a + (not bit), b + bit)
            for gate, parts in moves.items():
                old, n = weights.get(gate, [0.2] * 6), sum(p[0] for p in parts)
                weights[gate] = [w + L.NEAR * sum(p[1][k] for p in parts) / n for k, w in enumerate(old)]
    out = []
    for key in places(asked):
        total = 0.0
        for j in range(8):
            bit, node, at = look(j, key)
            _, _, z, step = predict(j, [t.get(s, (0, 0)) for t, s in at])
            a, b = refined.get((node, step), (0, 0))
            fine = (b + 8 / (1 + math.exp(-(step - L.STEPS // 2) / 2))) / (a + b + 8)
            p = (1 / (1 + math.exp(-z)) + fine) / 2
            total += math.log10(p if bit else 1 - p)
        out.append(total)
    return out


def test_grams_equal_the_plain_mixer():
    import numpy as np
    chunks = [[L.spelled("the cat sat on the mat the cat"), L.spelled(None)], [L.spelled("the mat sat"), L.spelled("a cat on a mat " * 9)]]
    asked = [L.spelled("the cat sat on a mat"), L.spelled("unheard zebra"), L.spelled("")]
    sizes = L.sizes_of("grams", 9)
    learner = L.Learner(9, code_bits=8, sizes=sizes)
    for docs in chunks:
        learner.read_grams(L.Grams(docs, 9))
    places = sum(len(d) for docs in chunks for d in docs)
    assert learner.seen == places and learner.root[:, 1].sum() == places and all(t.sum() == 8 * places for t in learner.tables)
    got = L.Model(dict(learner.rows()), 9, 8, sizes).texts(L.Grams(asked, 9))
    want = np.add.reduceat(plain_grams(chunks, asked, 9), np.cumsum([0, *map(len, asked[:-1])]))
    assert np.allclose(got, want, rtol=0.01)


def test_probabilities_of_all_bytes_after_a_gram_add_up():
    import numpy as np
    sizes = L.sizes_of("grams", 12)
    learner = L.Learner(12, code_bits=8, sizes=sizes)
    learner.read_grams(L.Grams([L.spelled("the cat sat on the mat " * 20_000)], 12))
    model = L.Model(dict(learner.rows()), 12, 8, sizes)
    for before in (b"e cat", b"zzzzz", bytes(5)):
        each = model.judge(L.Contexts.after(np.array([int.from_bytes(before + bytes([b]), "big") for b in range(256)], np.uint64), 12))
        assert np.isfinite(each).all()  # also for bytes next to a certain one
        assert abs((10 ** each).sum() - 1) < 1e-4


def test_scores_by_grams(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(L, "CHUNK_BYTES", 4000)
    docs = odd_docs.withColumn("train", F.col("doc_id").isNull() | (F.col("doc_id") < 6))
    out = L.score(docs, "train", table_bits=12, unit="grams").cache()
    check(docs, out)
    assert all(r.score < 0 and math.isfinite(r.score) for r in out.collect())
    untrained = odd_docs.withColumn("train", F.lit(None).cast("boolean"))
    check(untrained, L.score(untrained, "train", table_bits=12, unit="grams"))
    assert L.score(no_docs.withColumn("train", F.lit(True)), "train", table_bits=12, unit="grams").count() == 0


def test_grams_predict_held_out_texts_better_than_words_before(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("train", F.col("doc_id") % 3 != 0)
    held = {u: L.score(docs, "train", table_bits=18, unit=u).where("doc_id % 3 = 0").agg(F.sum("score")).first()[0]
            for u in ("grams", "bytes")}
    assert held["grams"] > held["bytes"]
