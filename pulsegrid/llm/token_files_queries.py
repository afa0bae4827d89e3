from __future__ import annotations

from .common import Stored
from .queries import query, table
from .token_files import corpus_positions, read_token_files, write_token_files


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op9_token_files")
def op9_token_files(spark, sf_dir):
    """All documents written as token shards, and what the shards hold of each, read back by key."""
    store = Stored(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), f"{store.root}/shards", byte_bpe())
    return corpus_positions(read_token_files(spark, f"{store.root}/shards"))
