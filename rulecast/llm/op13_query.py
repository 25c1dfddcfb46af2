"""The query of byte-level BPE encoding and decoding."""

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulecast.llm.byte_pairs import decode_bytes, encode_bytes
from rulecast.llm.common import table

RANKS = "byte_bpe_multi_50k.tiktoken"


def _ids_digest(decoded: DataFrame) -> DataFrame:
    """Adds the digest of each row's ids as unsigned 32-bit integers, lowest byte first."""

    def digest(batches):
        for batch in batches:
            lists = batch.column(1)
            at, flat = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint32)
            found = [hashlib.sha256(flat[a:b].tobytes()).hexdigest() for a, b in zip(at[:-1], at[1:], strict=True)]
            sizes = pa.array(np.diff(at).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(found, pa.string()), batch.column(2)], names=["doc_id", "n_tokens", "ids_sha256", "digest"])

    rows = decoded.select("doc_id", "ids", F.sha2("bytes", 256).alias("digest"))
    return rows.mapInArrow(digest, "doc_id bigint, n_tokens bigint, ids_sha256 string, digest string")


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    decoded = decode_bytes(encode_bytes(table(spark, sf_dir, "documents"), ranks, pattern), ranks, pattern)
    return _ids_digest(decoded).withColumnRenamed("digest", "decoded_sha256")
