"""Checks a packing against the documents' ids."""

import zlib

import numpy as np


def check_packing(pieces, ids_of, window):
    """pieces: rows with doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; ids_of: {doc_id: ids with the end id}."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    assert set(by_doc) == set(ids_of)
    for doc, own in by_doc.items():
        ids, at = np.asarray(ids_of[doc], "<u4"), 0
        for p in sorted(own, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            at += p["length"]
            assert p["ids_crc32"] == zlib.crc32(ids[p["start"] : at].tobytes())
        assert at == len(ids)
    padding = 0
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding, len(by_sequence)
