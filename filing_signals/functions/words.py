"""White-space tokens of an Arrow batch of texts, each distinct one held once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """How many tokens each text has, and all tokens in order; a null text has none.

    Arrow splits at the white space that Python and `fixed.WHITE_SPACE` know.
    """
    parts = pc.utf8_split_whitespace(texts)
    pieces = parts.flatten()
    filled = np.asarray(pc.not_equal(pieces, ""))
    all_of = pc.fill_null(pc.list_value_length(parts), 0).to_numpy().astype(np.int64)
    before = np.concatenate([[0], np.cumsum(filled)])
    ends = np.cumsum(all_of)
    sizes = before[ends] - before[ends - all_of]
    return sizes, pieces.filter(pa.array(filled)).dictionary_encode()
