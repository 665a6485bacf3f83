"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the vocabulary file of a public tokenizer lies, as ranks (``.tiktoken``) or as JSON; a parameter everywhere.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# How the byte-level vocabularies split a text before the merges.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Runs of blanks from here on overflow the library's own splitter, so such a text is split before.
LONG_BLANK = 10_000
_LONG_BLANK = re.compile(rf"\s{{{LONG_BLANK}}}")


@lru_cache(maxsize=2)
def counter(path: str) -> Callable[[list[str]], list[int]]:
    """A function from texts to their numbers of tokens; one per worker process.

    Ranks and JSON of one vocabulary give equal numbers; ranks take about a quarter of the time.  Strings of
    special tokens in a text are ordinary text.
    """
    if path.endswith(".tiktoken"):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        encoding = tiktoken.Encoding(os.path.basename(path), pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        pieces = regex.compile(SPLIT)

        def count(text: str) -> int:
            if len(text) >= LONG_BLANK and _LONG_BLANK.search(text):
                return sum(len(encoding._encode_single_piece(p)) for p in pieces.findall(text))
            return len(encoding.encode_ordinary(text))

        return lambda texts: [count(t) for t in texts]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    return lambda texts: [len(e.ids) for a in range(0, len(texts), 64) for e in tok.encode_batch_fast(texts[a : a + 64], add_special_tokens=False)]


def sizes(documents: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, *keep, n_tokens): whole texts, no shuffle; null and empty texts have 0 tokens.

    A text repeated in a batch is counted once.  The column is marked as not deterministic, as otherwise a
    filter on it would be pushed below it and every text be read twice.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = counter(tokenizer)
        for b in batches:
            place, distinct = pd.factorize(b)
            yield pd.Series(count(distinct.tolist()), dtype="int64").take(place).reset_index(drop=True)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    count = F.pandas_udf(run, "bigint").asNondeterministic()
    return documents.select(key, *keep, count(F.coalesce(F.col(text), F.lit(""))).alias("n_tokens"))
