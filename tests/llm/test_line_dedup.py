import random

from pyspark.sql import functions as F

from tickspark.llm.common import words
from tickspark.llm.line_dedup import dedup_lines


def replay(rows, least=8):
    """Texts without later copies of runs of any length; ``rows``: (key, hash, text), told apart by key and hash."""
    docs = sorted({r for r in rows if r[2] is not None}, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    lines = [d[2].split("\n") for d in docs]
    gone = [set() for _ in docs]
    for size in range(1, max(map(len, lines), default=0) + 1):
        seen = set()
        for d, ls in enumerate(lines):
            for p in range(len(ls) - size + 1):
                run = tuple(ls[p:p + size])
                if run in seen and sum(len(words(line)) for line in run) >= least:
                    gone[d].update(range(p, p + size))
                seen.add(run)
    return {d[:2]: "\n".join(x for i, x in enumerate(ls) if i not in g) for d, ls, g in zip(docs, lines, gone)}


def check(docs):
    docs = docs.withColumn("hash", F.xxhash64("text"))
    want = replay([(r.doc_id, r.hash, r.text) for r in docs.collect()])
    out = dedup_lines(docs).collect()
    assert len(out) == docs.count()
    for r in out:
        assert r.text is None if r.n_lines == 0 else r.text == want[r.doc_id, r.hash]
    return out


def test_equals_replay(spark):
    rng = random.Random(1)
    lines = ["a b c", "d e", "f", "g h i j k l m n", "o", ""]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 14)))) for i in range(80)]
    rows += [(5, "x"), (5, rows[5][1]), (7, rows[7][1]), (None, rows[9][1]), (90, "\n".join(["p q r s"] * 50))]
    out = check(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sum(r.n_deleted for r in out) > 100


def test_given_documents(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_a_passage_goes_from_later_documents_only(spark):
    passage = "\n".join(" ".join(f"p{i}{j}" for j in range(30)) for i in range(3))
    rows = [(i, f"own line number {i} with enough words to count here\n{passage}\nend {i}") for i in range(5)]
    out = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert out[0] == rows[0][1] and all(out[i] == f"own line number {i} with enough words to count here\nend {i}" for i in range(1, 5))


def test_odd_rows(odd_docs, no_docs):
    clash = odd_docs.withColumn("k", F.lit(1)).withColumn("h", F.lit(2)).withColumn("runs", F.lit("x")).withColumn("n_lines", F.lit("y"))
    out = dedup_lines(clash)
    assert out.columns == [*odd_docs.columns, "k", "h", "runs", "n_lines", "n_deleted"] and out.count() == odd_docs.count()
    assert dedup_lines(no_docs).count() == 0


def test_runs_of_every_length_go_whole(spark):
    rows = [(0, "a b c\nd e f\ng h i\nown"), (1, "x\na b c\nd e f\ng h i"), (2, "five words stand on this\none\n1 2 3 4 5 6 7 8 9"),
            (3, "five words stand on this\none\n1 2 3 4 5 6 7 8 9")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id: r.text for r in dedup_lines(docs).collect()} == {0: rows[0][1], 1: "x", 2: rows[2][1], 3: ""}
    check(docs)


def test_equals_replay_of_every_length(spark, sf_dir):
    rng = random.Random(2)
    lines = ["a b c", "d e", "f", "g h", "o", "", "p q"]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 9)))) for i in range(60)]
    rows += [(60 + i, "\n".join(rows[i][1].split("\n")[1:] + rows[i + 1][1].split("\n"))) for i in range(30)]
    rows += [(5, rows[6][1]), (7, rows[7][1]), (None, rows[9][1]), (90, "\n".join(["p q r s"] * 50))]
    check(spark.createDataFrame(rows, "doc_id bigint, text string"))
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"))
