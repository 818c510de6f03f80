"""Token counts and packing over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendwatch.llm import prefixtable
from spendwatch.llm.catalog import query, table
from spendwatch.llm.packing import pack
from spendwatch.llm.tokencount import token_counts

#: Context length in tokens of the model that the corpus is prepared for.
CONTEXT = 4_096
#: Id put after each document when packing.
END_ID = 2


@query("op5_token_counts")
def token_counts_query(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"), CONTEXT)


@query("op7_packing")
def packing_query(spark: SparkSession, folder: str) -> DataFrame:
    packed = pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), CONTEXT, END_ID)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query("op12_piece_roundtrip")
def piece_roundtrip_query(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    decoded = prefixtable.decode(prefixtable.encode(table(spark, folder, "documents"), model), model)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
