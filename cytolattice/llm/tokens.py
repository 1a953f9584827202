"""Token ids of texts with a public byte-level BPE vocabulary, cut into pieces of bounded length."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from .text import parts

END_ID = 2
#: Text that the tokenizer file itself reads as one special token; such texts take the tokenizer's own path.
SPECIAL = "<|endoftext|>"


def public_vocabulary():
    """Paths of the tokenizer file and of the same vocabulary as ranks."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoder(tokenizer_path, ranks_path):
    """Function from a text to its ids, equal to the tokenizer's with add_special_tokens=False.

    The ranks give the same ids several times faster; the tokenizer file is read when a text needs it.
    """
    import base64

    import public_tokenizers
    import tiktoken
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    fast = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = []

    def encode(text):
        if SPECIAL in text:
            if not own:
                from tokenizers import Tokenizer
                own.append(Tokenizer.from_file(tokenizer_path))
            return own[0].encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def token_pieces(docs: DataFrame, text: str = "text", capacity: int = 1024, vocabulary: tuple | None = None) -> DataFrame:
    """One row per piece of each document, with the document's columns and ``piece``, ``start``, ``length``, ``ids``.

    A document is its ids and then END_ID; null counts as empty.  A document over ``capacity`` is cut into pieces of
    that many ids, the first one taking what is left over.  ``ids`` is binary: little-endian unsigned 32-bit numbers.
    Columns of these names are replaced.
    """
    tokenizer_path, ranks_path = vocabulary or public_vocabulary()

    @pandas_udf(T.BinaryType())
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import numpy as np
        encode = encoder(tokenizer_path, ranks_path)
        for batch in batches:
            for part in parts(batch):
                yield pd.Series([np.array(encode(t or "") + [END_ID], "<u4").tobytes() for t in part], dtype=object)

    made = docs.withColumn("_ids", ids(F.col(f"`{text}`"))).withColumn("_n", (F.length("_ids") / 4).cast("long"))
    first = F.expr(f"CASE WHEN _n <= {capacity} THEN _n WHEN _n % {capacity} = 0 THEN {capacity} ELSE _n % {capacity} END")
    start = F.expr(f"CASE WHEN piece = 0 THEN 0 ELSE _first + (piece - 1) * {capacity} END").cast("long")
    length = F.expr(f"CASE WHEN piece = 0 THEN _first ELSE {capacity} END").cast("long")
    return (made.withColumn("_first", first)
            .withColumn("piece", F.explode(F.expr(f"sequence(0, CAST(ceil(_n / {capacity}) AS INT) - 1)")))
            .withColumn("start", start).withColumn("length", length)
            .withColumn("ids", F.expr("substring(_ids, CAST(start * 4 + 1 AS INT), CAST(length * 4 AS INT))"))
            .drop("_ids", "_n", "_first"))
