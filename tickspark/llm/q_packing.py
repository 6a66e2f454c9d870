"""Query of the packer. SQL cannot tokenise, so tests hold it against plain tokenisation and a replay."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickspark.llm.common import table
from tickspark.llm.packing import pack, token_pieces


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), ids=False)
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


QUERIES = {"op2_packing": op2_packing}
ORACLES: dict[str, str] = {}
