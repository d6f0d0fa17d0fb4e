"""Extraction: stored HTML to text."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.operators.html import html_extract
from presslake.operators.key_filters import FilteredTable
from presslake.operators.merge import content_update
from presslake.operators.queues import extract_queue
from presslake.operators.stored import raw_stored, text_stored
from presslake.operators.text import text_dedup_blocks
from presslake.session import materialize


class Extracted(NamedTuple):
    """Next content table, and one row per page tried: ``id_page, parser, ok``."""

    content: DataFrame
    outcomes: DataFrame


def extract(
    sitemaps: DataFrame, pages: DataFrame, content: DataFrame,
    fn: Callable[[pd.Series], pd.Series] | None = None, parser: str = "patterns", dedup: bool = True,
    seen: FilteredTable | None = None, run: int | None = None,
) -> Extracted:
    """Extract the text of every waiting page; one without text keeps NULL and waits again.

    With ``dedup`` lines repeated across the extracted pages stay in the first only, and with
    ``seen`` and the number of this ``run`` also those that earlier runs had. A page
    all of whose lines were repeats has been read: it gets an empty text and doesn't wait.
    The HTML is read where it lies; only the much smaller texts meet the queue.
    """
    waiting = extract_queue(sitemaps, pages, content).select("id_page")
    html = content.where(raw_stored(content) & ~text_stored(content)).select("id_page", "page_raw_content")
    texts = materialize(html_extract(html, "id_page", "page_raw_content", fn).join(waiting, "id_page", "left_semi"))
    if dedup:
        single = text_dedup_blocks(texts.where("content is not null"), "id_page", "content", seen, run)
        texts = materialize(texts.select("id_page").join(single, "id_page", "left"))
    outcomes = texts.select("id_page", F.lit(parser).alias("parser"), F.col("content").isNotNull().alias("ok"))
    return Extracted(content_update(content, texts), outcomes)
