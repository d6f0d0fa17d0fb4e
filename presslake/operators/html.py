"""Main text of HTML pages as light markdown.

``html_extract`` is a chain of built-in replacements. It keeps headings, list
items and table rows, drops scripts, styles, navigation and other furniture,
links' targets, images and comments. A user's own extractor, or the tree-walking
one in ``presslake.operators.html_walk``, runs over Arrow batches through ``fn``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bytes of HTML that an extractor of one's own is given at once, about.
PIECE_BYTES = 1 << 20

# Elements dropped with all they contain.
FURNITURE = ["head", "script", "style", "noscript", "template", "svg", "iframe", "nav", "aside",
             "header", "footer", "form", "button", "figure"]

# Elements that end a line where they open or close.
BLOCKS = ["p", "div", "section", "article", "main", "ul", "ol", "table", "tbody", "thead", "blockquote", "pre",
          "dl", "dt", "dd", "body", "html", "br", "hr"]

# Named characters; &amp; comes last so "&amp;lt;" stays "&lt;".
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
            ("&copy;", "©"), ("&reg;", "®"), ("&trade;", "™"), ("&euro;", "€"), ("&pound;", "£"), ("&deg;", "°"),
            ("&middot;", "·"), ("&bull;", "•"), ("&ndash;", "–"), ("&mdash;", "—"), ("&hellip;", "…"),
            ("&laquo;", "«"), ("&raquo;", "»"), ("&lsquo;", "‘"), ("&rsquo;", "’"), ("&ldquo;", "“"), ("&rdquo;", "”"),
            ("&bdquo;", "„"), ("&sbquo;", "‚"), ("&shy;", ""), ("&agrave;", "à"), ("&acirc;", "â"), ("&auml;", "ä"),
            ("&aacute;", "á"), ("&ccedil;", "ç"), ("&eacute;", "é"), ("&egrave;", "è"), ("&ecirc;", "ê"), ("&euml;", "ë"),
            ("&iacute;", "í"), ("&icirc;", "î"), ("&iuml;", "ï"), ("&ntilde;", "ñ"), ("&oacute;", "ó"), ("&ocirc;", "ô"),
            ("&ouml;", "ö"), ("&uacute;", "ú"), ("&ugrave;", "ù"), ("&ucirc;", "û"), ("&uuml;", "ü"), ("&szlig;", "ß"),
            ("&Auml;", "Ä"), ("&Ouml;", "Ö"), ("&Uuml;", "Ü"), ("&Eacute;", "É"), ("&amp;", "&")]

_DROPPED = "|".join(
    ["!--.*?--"] + [rf"{tag}(?:[ \t\r\n][^>]*)?>.*?</{tag}[ \t\r\n]*" for tag in FURNITURE]
)

# Steps as (pattern, replacement), each one pass over the text; the patterns mean the
# same to Java and RE2, and "%1" is the first group.
_TAGS = [
    # Whichever of the dropped elements opens first swallows what it holds.
    (rf"(?is)<(?:{_DROPPED})>", ""),
    # Only the article when there is one.
    (r"(?is)^.*?<article(?:[ \t\r\n][^>]*)?>(.*)</article[ \t\r\n]*>.*$", "%1"),
    # Blanks to single spaces; single spaces, the most common, are left alone.
    (r"[\t\r\n][ \t\r\n]*| [ \t\r\n]+", " "),
    (r"(?i)<h([1-6])(?: [^>]*)?>", "\n<%1>"),
]
_HEADINGS = [(f"\n<{n}>", "\n" + "#" * n + " ") for n in range(1, 7)]
_LINES = [
    (r"(?i)<li(?: [^>]*)?>", "\n- "),
    (r"(?i)<tr(?: [^>]*)?>", "\n| "),
    (r"(?i)</t[dh] ?>", " | "),
    (rf"(?i)<(?:/?(?:{'|'.join(BLOCKS)})(?: [^>]*)?/?|/(?:h[1-6]|li|tr) ?)>", "\n"),
    (r"<[^>]*>", ""),
]
# Blanks are single before the line ends are looked at, so one blank is all there can be in front.
_BLANKS = [(r"[ \t]{2,}", " ")]
_LINE_ENDS = [(" \n", "\n")]
_TIDY = [
    (r"\n[ \n]+", "\n"),
    # Marks of headings, items and rows without text.
    (r"(?:\n(?:#{1,6}|-|\|))+\n", "\n"),
]

# (is a pattern, what, replacement)
CHAIN = (
    [(True, *step) for step in _TAGS] + [(False, *step) for step in _HEADINGS] + [(True, *step) for step in _LINES]
    + [(False, *step) for step in ENTITIES] + [(True, *step) for step in _BLANKS] + [(False, *step) for step in _LINE_ENDS]
    + [(True, *step) for step in _TIDY]
)


def numbered_characters(text: Column) -> Column:
    """Replaces ``&#8217;`` and ``&#x27;`` by their characters; numbers of no character stay."""
    form = r"^(?:([0-9]{1,7})|[xX]([0-9A-Fa-f]{1,6}));"

    def read(piece: Column, place: Column) -> Column:
        code = F.coalesce(
            F.regexp_extract(piece, form, 1).try_cast("int"),
            F.conv(F.nullif(F.regexp_extract(piece, form, 2), F.lit("")), 16, 10).try_cast("int"),
        )
        known = ((code > 31) | code.isin(9, 10, 13)) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(place == 0, piece).when(known, F.concat(char, F.regexp_replace(piece, form, ""))).otherwise(
            F.concat(F.lit("&#"), piece)
        )

    return F.array_join(F.transform(F.split(text, "&#"), read), "")


def html_text(html: Column) -> Column:
    """Text of an HTML column; NULL where nothing is left."""
    text = html
    for is_pattern, what, by in CHAIN:
        if what == ENTITIES[0][0]:  # tags are gone by now, and "&amp;#39;" is not yet "&#39;"
            text = numbered_characters(text)
        if is_pattern:
            text = F.regexp_replace(text, what, by.replace("%1", "$1"))
        else:
            text = F.replace(text, F.lit(what), F.lit(by))
    # nullif evaluates the chain once; when(text != "", text) would run it twice.
    return F.nullif(F.btrim(text, F.lit(" \n")), F.lit(""))


def html_extract(
    df: DataFrame, id_col: str, html_col: str, fn: Callable[[pd.Series], pd.Series] | None = None
) -> DataFrame:
    """``(id, content)`` per page; no text gives NULL.

    ``fn`` maps a series of HTML to a series of texts and replaces the built-in chain.
    """
    if fn is None:
        return df.select(id_col, html_text(F.col(html_col)).alias("content"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _pieces(batch):
                texts = fn(part.column(1).to_pandas())
                content = pa.array(texts.where(texts != "", None), pa.string(), from_pandas=True)
                yield pa.RecordBatch.from_arrays([part.column(0), content], names=[id_col, "content"])

    id_type = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, html_col).mapInArrow(run, f"{id_col} {id_type}, content string")


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Cuts a batch of any length into pieces of about ``PIECE_BYTES`` of HTML; a longer page is a piece of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy())
    cuts = np.flatnonzero(np.diff(ends // PIECE_BYTES)) + 1
    for a, b in pairwise([0, *cuts.tolist(), batch.num_rows]):
        if a < b:
            yield batch.slice(a, b - a)
