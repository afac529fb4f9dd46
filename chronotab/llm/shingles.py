"""Five-word shingles of normalised texts.

Normalised words are maximal runs of ASCII letters, digits and characters beyond ASCII in the
lower-cased text. A shingle is the hash of five consecutive words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from chronotab.llm import hashing as H

WORDS = 5


def word_rows(column, max_bytes: int = 1 << 20):
    """Per text of a string column, in order: the hashes of its normalised words."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    data, offs = H.utf8(pc.utf8_lower(pc.fill_null(column, "")))
    for i, j in H.pieces(offs, max_bytes):
        h, _, _, first = H.words(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], H.ALNUM)
        for r in range(j - i):
            yield h[first[r]:first[r + 1]]


def shingles(words: np.ndarray, k: int = WORDS) -> np.ndarray:
    """Hashes of the runs of ``k`` words, in text order; none for fewer words."""
    return H.grams(H.prefix(words), k) if len(words) >= k else np.zeros(0, dtype=np.uint64)
