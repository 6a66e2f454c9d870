import itertools
import math
import random

from pyspark.sql import functions as F

from tickspark.llm import embedding_dedup as E
from tickspark.llm import ngram_join as N
from tickspark.llm.common import words
from tickspark.llm.components import components


def groups(nodes, links):
    top = {n: n for n in nodes}

    def root(n):
        while top[n] != n:
            n = top[n]
        return n

    for a, b in links:
        x, y = root(a), root(b)
        top[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(50)] + [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(60)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    want = groups({n for e in edges for n in e}, edges)
    assert got == {n: c for n, c in want.items() if any(a != b and n in (a, b) for a, b in edges)}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def near_texts():
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(300)]
    rows = []
    for base in range(6):
        text = [rng.choice(vocab) for _ in range(120)]
        for _ in range(12):
            copy = list(text)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            rows.append((len(rows), " ".join(copy)))
    rows += [(len(rows) + i, t) for i, t in enumerate(["a b", "a b", "a c", "a b c d e", "a b c d e f", " ", rows[0][1]])]
    return rows


def gram_set(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_ngram_links_equal_all_pairs(spark, monkeypatch):
    rows = near_texts()
    sets = {k: gram_set(t) for k, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b]
             and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9]
    want = groups(sets, links)
    for tile in (256, 4):
        monkeypatch.setattr(N, "TILE_DOCS", tile)
        got = {r.doc_id: r for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
        assert {k: r.component_id for k, r in got.items()} == want
        assert {k: r.n_links for k, r in got.items()} == {k: sum(k in e for e in links) for k in sets}
        assert all(r.kept == (k == want[k]) for k, r in got.items())


def test_bands():
    for threshold, recall in ((0.8, 0.9999), (0.5, 0.99), (1.0, 0.9)):
        bands, rows = N.choose_bands(threshold, recall)
        assert bands * rows <= N.MAX_HASHES and 1 - (1 - threshold ** rows) ** bands >= recall - 1e-9


def test_odd_documents(odd_docs, no_docs):
    out = N.near_duplicates(odd_docs.withColumn("cls", F.lit(1)).withColumn("kept", F.lit(1)))
    rows = out.collect()
    assert len(rows) == odd_docs.count()
    assert sorted(r.n_links for r in rows) == [0] * (len(rows) - 3) + [2, 2, 2]
    assert N.near_duplicates(no_docs).count() == 0


def brute_vectors(rows):
    def unit_ok(v):
        return v and None not in v and all(map(math.isfinite, v)) and any(v)

    rows = [(k, [x / max(map(abs, v)) for x in v] if unit_ok(v) else v, a) for k, v, a in rows]
    links = []
    for (i, (_, v, a)), (j, (_, w, b)) in itertools.combinations(enumerate(rows), 2):
        if unit_ok(v) and unit_ok(w) and a is not None and a == b and len(v) == len(w):
            cosine = sum(x * y for x, y in zip(v, w)) / (math.sqrt(sum(x * x for x in v)) * math.sqrt(sum(y * y for y in w)))
            if cosine >= 0.98:
                links.append((i, j))
    return links


def test_vector_links_equal_all_pairs(spark, monkeypatch):
    rng = random.Random(6)
    centers = [[rng.gauss(0, 1) for _ in range(12)] for _ in range(8)]
    rows = [(i, [c + rng.gauss(0, 0.12) for c in centers[i % 8]], i % 3) for i in range(240)]
    rows += [(300 + i, rows[i % 5][1], rows[i % 5][2]) for i in range(20)]
    rows += [(400, None, 1), (401, [0.0] * 12, 1), (402, [None] * 12, 1), (403, [float("nan")] * 12, 1), (404, centers[0], None),
             (405, [1.0, 2.0], 1), (406, [1.0, 2.0], 1), (407, [], 1), (408, [1e-200, 2e-200], 1), (409, [1e300, 2e300], 1)]
    links = brute_vectors(rows)
    assert len(links) > 100
    want = groups([r[0] for r in rows], [(rows[a][0], rows[b][0]) for a, b in links])
    count = {r[0]: 0 for r in rows}
    for a, b in links:
        count[rows[a][0]] += 1
        count[rows[b][0]] += 1
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    for tile, lead, block in ((512, 8, 256), (8, 8, 4), (8, 2, 256), (40, 3, 8)):
        monkeypatch.setattr(E, "TILE", tile)
        monkeypatch.setattr(E, "LEAD", lead)
        monkeypatch.setattr(E, "BLOCK", block)
        got = {r.vec_id: r for r in E.near_duplicates(df).collect()}
        assert {k: r.n_links for k, r in got.items()} == count
        assert {k: r.component_id for k, r in got.items()} == want
    assert E.near_duplicates(df.limit(0)).count() == 0


def test_vector_columns_may_have_any_name(spark):
    rows = [(None, [1.0, 0.0], "a", 1), ("x", [1.0, 0.0], "a", 2), ("x", [2.0, 0.1], "a", 3), ("y", [0.0, 1.0], "a", 4), ("z", [1.0, 0.0], "b", 5)]
    df = spark.createDataFrame(rows, "cls string, given array<double>, space string, row_key int")
    got = sorted((str(r.cls), r.n_links, str(r.component_id), r.kept) for r in E.near_duplicates(df, "cls", "given", "space").collect())
    assert got == [("None", 2, "x", False), ("x", 2, "x", True), ("x", 2, "x", True), ("y", 0, "y", True), ("z", 0, "z", True)]


def test_cells_and_their_neighbours(spark):
    rng = random.Random(8)
    cells = [[int(rng.gauss(0, 2)) for _ in range(E.LEAD)] for _ in range(600)]
    levels = E.cut(spark.createDataFrame([(1, c) for c in cells], "space bigint, cell array<bigint>"), 20)
    at = {r.id: tuple(r["at"]) for c in levels for r in c.select("at", F.xxhash64("space", "at").alias("id")).collect()}
    assert len(levels) > 3
    # every row is in one cell
    assert all(sum(tuple(c[:len(a)]) == a for a in at.values()) == 1 for c in cells)
    got = sorted(tuple(sorted((r.a, r.b))) for r in E.neighbours(levels).collect())
    want = sorted((a, b) for a, b in itertools.combinations_with_replacement(sorted(at), 2)
                  if all(abs(x - y) <= 1 for x, y in zip(at[a], at[b])))
    assert got == want


def test_vectors_of_floats_and_doubles_agree(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where("vec_id < 300")
    wide = df.withColumn("embedding", F.col("embedding").cast("array<double>"))
    one, two = (sorted(map(tuple, E.near_duplicates(d).collect())) for d in (df, wide))
    assert one == two and len(one) == df.count()


def test_many_rows_of_one_key(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(vocabulary, k=60)) for _ in range(40)]
    texts += [t + " tail" for t in texts]
    rows = [(None, t) for t in texts] + [(None, texts[0])] * 3
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    signed, per_class, forest = N.links(df)
    assert forest.count() == 40 and signed.count() == 83
    got = N.near_duplicates(df).collect()
    assert sorted(r.n_links for r in got) == [1] * 78 + [4] * 5
    # a text meets only the classes of its own hash, whatever its key
    classes = N.signatures(df, "doc_id", "text", 5, 31, 6).groupBy("cls").agg(F.min("h").alias("h"))
    assert classes.join(df.withColumn("h", F.xxhash64("text")), "h").count() == 83


def test_stars_of_a_bucket(spark):
    classes = spark.createDataFrame([(c, [7, c // 2]) for c in range(-5, 50)] + [(99, [8, 99])], "cls bigint, bands array<bigint>")
    got = {(r.u, r.v) for r in N.stars(classes).collect()}
    assert got == {(c, -5) for c in range(-4, 50)} | {(c, c - 1) for c in range(-5, 50) if c % 2 and c - 1 >= -5}
