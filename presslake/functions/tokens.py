"""Pattern tokens: a stand-in for a model's own tokenizer.

A token is a run of letters and digits or one other character, together with
the blanks before it, so joining the first n tokens gives back the text's start.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_PATTERN = r"[\p{L}\p{N}]+|[^\p{L}\p{N} \t\r\n]"
TOKEN_PATTERN = rf"[ \t\r\n]*(?:{WORD_PATTERN})"
MAX_TOKENS = 8192


def tokens(text: Column, pattern: str = TOKEN_PATTERN) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def count_tokens(text: Column, pattern: str = WORD_PATTERN) -> Column:
    """Number of tokens; blanks need not be taken along for that."""
    return F.regexp_count(text, F.lit(pattern)).cast("bigint")
