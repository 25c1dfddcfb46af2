"""Which fingerprints occur more than once, told to the documents that have them.

Fingerprints are compared within each piece of documents first. One that occurs twice there is
known to be repeated: a single row of it goes to its group, and the documents' own rows travel
spread over all partitions. So a group gets one row per piece at most, however frequent it is.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

ALONE, KNOWN, PASSING = 0, 1, 2
SCHEMA = "key bigint, sig bigint, doc bigint, state int"


def marked(sig: np.ndarray, doc: pa.Array, across_documents: bool) -> pa.RecordBatch:
    """Rows for ``keep_repeated`` from a piece's fingerprints (``sig``) and their documents.

    ``across_documents``: only an occurrence in another document counts as a second one.
    """
    ids = doc.to_numpy(zero_copy_only=False)
    order = np.lexsort((ids, sig))
    sig, ids = sig[order], ids[order]
    new_sig = np.concatenate(([True], sig[1:] != sig[:-1])) if len(sig) else np.zeros(0, bool)
    new_pair = new_sig | np.concatenate(([True], ids[1:] != ids[:-1])) if len(sig) else new_sig
    group = np.cumsum(new_sig) - 1
    many = np.bincount(group, weights=new_pair if across_documents else None, minlength=1)[group] > 1 if len(sig) else new_sig
    one = np.flatnonzero(new_pair)
    state = np.where(many[one], PASSING, ALONE).astype(np.int32)
    spread = sig[one] ^ (ids[one] * np.int64(0x5851F42D4C957F2D))
    told = np.flatnonzero(new_sig & many)
    key = np.concatenate((np.where(state == PASSING, spread, sig[one]), sig[told]))
    columns = [key, np.concatenate((sig[one], sig[told])), np.concatenate((ids[one], ids[told])), np.concatenate((state, np.full(len(told), KNOWN, np.int32)))]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "sig", "doc", "state"])


def keep_repeated(rows: DataFrame) -> DataFrame:
    """``doc, sig`` of the fingerprints that occur twice, from rows of ``marked``."""

    def keep(batches):
        # The last group of a batch goes on in the next one as a single row.
        carried = np.zeros((3, 0), np.int64)
        for batch in batches:
            columns = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in (1, 2, 3)])
            passing = columns[2] == PASSING
            sig, doc, state = np.concatenate((carried, columns[:, ~passing]), axis=1)
            out = [columns[:2, passing]]
            if len(sig):
                start = np.concatenate(([True], sig[1:] != sig[:-1]))
                group = np.cumsum(start) - 1
                repeated = (np.bincount(group) > 1) | (np.bincount(group, weights=state == KNOWN) > 0)
                told = repeated[group] & (state == ALONE)
                out.append(np.stack((sig[told], doc[told])))
                last = KNOWN if repeated[-1] else ALONE
                carried = np.array([[sig[-1]], [doc[-1]], [last]], np.int64)
            found = np.concatenate(out, axis=1)
            if found.shape[1]:
                yield pa.RecordBatch.from_arrays([pa.array(found[1]), pa.array(found[0])], names=["doc", "sig"])

    return rows.repartition("key").sortWithinPartitions("key", "sig").mapInArrow(keep, "doc bigint, sig bigint")
