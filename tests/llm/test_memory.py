"""Memory of the work on a piece of a batch, and results across the bounds of pieces."""

import tracemalloc

import public_tokenizers
import pyarrow as pa
import sentencepiece
from helpers import documents

from rulecast.llm import words
from rulecast.llm.piece_encoding import CHUNK_BYTES, DECODED, decode_pieces, encode_pieces
from rulecast.llm.words import FOLDED, cut


def test_words_are_hashed_in_stretches_of_bounded_memory(monkeypatch):
    said = pa.array([" ".join(f"w{i * i % 7919}x" * (1 + i % 3) for i in range(60_000)), "", " Ab ab\tab ", "é" * 5000], pa.string())
    cut(said, FOLDED)
    tracemalloc.start()
    found = cut(said, FOLDED)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 14 * said.nbytes
    monkeypatch.setattr(words, "HASHED", 1 << 40)
    assert cut(said, FOLDED).hashes.tolist() == found.hashes.tolist()
    assert found.counts().tolist() == [60_000, 0, 3, 1] and len(set(found.hashes[60_000:60_003].tolist())) == 1


def test_pieces_across_the_bounds_of_chunks(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = [(i, None if i % 7 == 0 else f"word {i} é　 x" * (i % 5) * 200) for i in range(3 * DECODED + 1)]
    rows.append((-1, "one long text  " * (CHUNK_BYTES // 8)))
    found = decode_pieces(encode_pieces(documents(spark, rows), path).coalesce(1), path).collect()
    got = {r.doc_id: (list(r.ids), r.text) for r in found}
    want = {i: library.encode(text or "") for i, text in rows}
    assert len(found) == len(rows) and got == {i: (ids, library.decode(ids)) for i, ids in want.items()}
