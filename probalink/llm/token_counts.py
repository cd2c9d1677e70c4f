"""Token counts by overlap resynchronisation (operator 10).

A document of up to WHOLE characters is encoded at once. A longer one is cut into chunks that overlap, each chunk is scanned by
itself into pieces with their offsets, and neighbours are spliced at the first offset in the overlap where both begin a piece. Such
a boundary is proven stable. A scan never looks back, and it looks at most LOOK characters past the end of a piece: an apostrophe
alone is a piece only if the two characters after it make no contraction, white space before a word ends one character before the
space that tells, and any other run ends at the character that is no part of it. A piece of a chunk that ends LOOK characters or more before
the chunk does is therefore what the scan of the whole text finds from the same start; where a proven boundary is also one of the next
chunk, that chunk's scan from there on is the whole text's. An overlap without such a boundary is widened, up to the rest of the text.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probalink.llm.bpe import Encoder, encoder
from probalink.llm.common import in_arrow, text_of

WHOLE = 1 << 15
STEP = 1 << 14
OVERLAP = 256
#: Characters past a piece on which the pattern's choice of it depends.
LOOK = 2


def scanned(own: Encoder, text: str, start: int, end: int) -> tuple[dict[int, int], int]:
    """Offsets where pieces of text[start:end] begin, each with the number of tokens before it, and the number of all tokens."""
    pieces = own.pattern.findall(text[start:end])
    ids_of = own.learn(pieces)
    counts = [0, *accumulate(len(ids_of[p]) // 4 for p in pieces)]
    return dict(zip(accumulate(map(len, pieces), initial=start), counts[:-1])), counts[-1]


def spliced_count(own: Encoder, text: str, step: int = STEP, overlap: int = OVERLAP) -> int:
    """The tokens of a long text without special strings."""
    n = len(text)
    if n <= step + overlap:
        return scanned(own, text, 0, n)[1]
    starts = list(range(0, n, step))
    total, begin, end, j = 0, 0, step + overlap, 1
    left, count = scanned(own, text, begin, end)
    base = 0  # tokens of left's own scan before the place where it was spliced
    while end < n:
        right_end = min(n, starts[j] + step + overlap)
        right, right_count = scanned(own, text, starts[j], right_end)
        common = next((p for p in right if p in left and begin <= p <= end - LOOK), None)
        if common is not None:
            total += left[common] - base
            left, count, base, begin, end = right, right_count, right[common], common, right_end
            j += 1
        else:  # widen: the left scan goes on, to twice its length, from a boundary that is proven
            end = min(n, begin + 2 * (end - begin))
            left, count = scanned(own, text, begin, end)
            base = 0
            j = max(j, (end - overlap) // step)  # the last chunk that overlaps with it in full
    return total + count - base


def counts(own: Encoder, texts: list[str], whole: int = WHOLE, step: int = STEP, overlap: int = OVERLAP) -> list[int]:
    out = np.diff(own.encode_batch([t if len(t) <= whole else "" for t in texts])[1]).tolist()
    for k, text in enumerate(texts):
        if len(text) > whole:
            parts = own.at_special.split(text) if own.at_special is not None else [text]
            out[k] = sum(1 if p in own.special else spliced_count(own, p, step, overlap) for p in parts if p)
    return out


def token_counts(df: DataFrame, path: str, pattern: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every whole text.

    Null and empty texts have 0 of both; null ids and repeated rows stay as they are. An empty table gives an empty result. Special
    strings in a text count as the one token that the vocabulary's library makes of them. Other columns are not read. No shuffle.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = encoder(path, pattern)
        return pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(counts(own, batch.column(2).to_pylist()), pa.int64())], [id_col, "n_bytes", "n_tokens"])

    kind = df.schema[id_col].dataType.simpleString()
    text = text_of(text_col)
    counted = in_arrow(df.select(F.col(id_col), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("__text")), run, f"`{id_col}` {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
