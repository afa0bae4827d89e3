from __future__ import annotations

from .pieces import encode
from .queries import query, table


def piece_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op8_pieces")
def op8_pieces(spark, sf_dir):
    """SentencePiece ids of all documents, and whether decoding gives each text back."""
    return encode(table(spark, sf_dir, "documents"), piece_bpe())
