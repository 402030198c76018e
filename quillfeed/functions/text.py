"""Text expressions: trimming, HTML to text and byte lengths, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that ASCII trimming removes; U+0085 and NBSP stay.
ASCII_SPACE = " \t\n\u000b\f\r"

#: Entities in the order in which they are decoded, the ampersand last.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


#: Patterns of the HTML that becomes text, with what each becomes, in this order around the entities.
BREAK, PARAGRAPH_END, TAG, BLANK_LINES = r"(?i)<br\s*/?>", r"(?i)</p>", r"<[^>]+>", r"\n{3,}"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ascii_trim(c: Column | str) -> Column:
    """Trims tab, LF, VT, FF, CR and space only. Null stays null."""
    return F.btrim(_col(c), F.lit(ASCII_SPACE))


def utf8_trimmed_length(c: Column | str) -> Column:
    """Bytes of the trimmed text; null counts as 0."""
    return F.coalesce(F.octet_length(ascii_trim(c)), F.lit(0))


def clean_html(c: Column | str) -> Column:
    """HTML to text: line breaks from br and closing p, tags dropped, entities decoded, blank lines capped at one."""
    text = F.regexp_replace(_col(c), BREAK, "\n")
    text = F.regexp_replace(text, PARAGRAPH_END, "\n")
    text = F.regexp_replace(text, TAG, "")
    for entity, plain in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return ascii_trim(F.regexp_replace(text, BLANK_LINES, "\n\n"))
