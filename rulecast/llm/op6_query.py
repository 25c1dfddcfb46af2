"""The query of token-id files."""

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rulecast.llm.common import table
from rulecast.llm.token_files import encode_documents, read_tokens, with_checksum, write_tokens
from rulecast.operators.lineage import checkpoint_dir

END_ID = 1


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    write_tokens(encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID), path)
    return with_checksum(read_tokens(spark, path)).select("doc_id", "start", "n_tokens", "ids_crc32")
