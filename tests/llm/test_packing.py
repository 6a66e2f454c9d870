import random
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickspark.llm.packing import best_two_fit, pack, token_pieces
from tickspark.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_encoder_equals_tokenizers():
    plain, fast, rng = Tokenizer.from_file(PATH), Encoder(PATH), random.Random(1)
    parts = ["a", "B", "1", " ", "  ", "\n", "\t", "'s", "'", "é", "\xa0", "　", "漢", "<|endoftext|>", "!", "\x1c", "\U0001F600", "²", "-"]
    for _ in range(5000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        assert np.frombuffer(fast.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_plan_places_everything_tightly():
    rng = np.random.default_rng(0)
    for sizes in (rng.integers(1, 1025, 20_000), np.minimum(1024, rng.lognormal(6, 1, 20_000)).astype(int) + 0, np.array([600, 600, 500]), np.array([], int)):
        sizes = sizes[sizes > 0]
        counts = {int(k): int(v) for k, v in zip(*np.unique(sizes, return_counts=True))}
        placed, bins = dict.fromkeys(counts, 0), 0
        for times, held in best_two_fit(counts, 1024):
            assert sum(n * k for n, k in held) <= 1024
            bins += times
            for n, k in held:
                placed[n] += times * k
        assert placed == counts
        if len(sizes) > 1000:
            assert bins <= 1.01 * sizes.sum() / 1024 + 1


def check(pieces, capacity=1024):
    for _, group in pieces.groupby("sequence_id"):
        group = group.sort_values("offset")
        assert (group.offset == group.length.cumsum() - group.length).all() and group.length.sum() <= capacity


def test_documents_are_cut_and_packed_whole(spark, odd_docs, no_docs):
    plain = Tokenizer.from_file(PATH)
    docs = odd_docs.where("doc_id > 2").dropDuplicates(["doc_id"])
    out = pack(token_pieces(docs, PATH)).toPandas()
    check(out)
    for r in docs.collect():
        ids = plain.encode(r.text or "", add_special_tokens=False).ids + [2]
        mine = out[out.doc_id == r.doc_id].sort_values("piece")
        assert [i for part in mine.ids for i in part] == ids
        assert mine.piece.tolist() == list(range(len(mine))) and (mine.length[1:] == 1024).all()
        assert (mine.start == mine.length.cumsum() - mine.length).all()
        assert [zlib.crc32(np.asarray(p, "<u4").tobytes()) for p in mine.ids] == mine.ids_crc32.tolist()
    everything = pack(token_pieces(odd_docs, PATH, ids=False)).toPandas()
    check(everything)
    assert everything[everything.piece == 0].shape[0] == odd_docs.count()
    assert pack(token_pieces(no_docs, PATH)).count() == 0


def test_columns_that_clash(spark):
    rows = spark.range(40).select(F.lit(100).cast("bigint").alias("length"), F.lit(1).alias("bucket"), F.lit("x").alias("sequence_id"), F.col("id").alias("number"))
    out = pack(rows)
    assert out.columns == ["length", "bucket", "number", "sequence_id", "offset"]
    check(out.toPandas())
    assert out.select("sequence_id").distinct().count() == 4
