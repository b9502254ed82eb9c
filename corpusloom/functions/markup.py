"""HTML to text with native expressions."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import strip

# The named character references of HTML 4 and 'apos'; a no-break space becomes a plain one.
NAMED = {**{name: chr(code) for name, code in name2codepoint.items()}, "apos": "'", "nbsp": " "}

ARTICLE = r"(?is)<article\b[^>]*>.*?</article>"


def has_article(html: Column) -> Column:
    """Whether :func:`html_to_text` gives a text."""
    return F.regexp_like(html, F.lit(ARTICLE))


def unescape(text: Column) -> Column:
    """Decode numeric and named character references, each once; unknown ones stay as they are."""
    parts = F.regexp_extract_all(
        text, F.lit(r"&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};|&[A-Za-z][A-Za-z0-9]{1,31};|[^&]+|&"), F.lit(0)
    )
    named = F.create_map(*[F.lit(x) for name, char in NAMED.items() for x in (f"&{name};", char)])

    def decoded(part: Column) -> Column:
        digits = F.substr(part, F.lit(3), F.length(part) - 3)
        hexadecimal = F.lower(F.substr(part, F.lit(3), F.lit(1))) == "x"
        code = F.when(hexadecimal, F.conv(F.substr(digits, F.lit(2)), 16, 10)).otherwise(digits).cast("int")
        return F.when(part.startswith("&#"), _character(code)).otherwise(F.coalesce(F.try_element_at(named, part), part))

    joined = F.array_join(F.transform(parts, lambda p: F.when(p.startswith("&"), decoded(p)).otherwise(p)), "")
    return F.when(F.contains(text, F.lit("&")), joined).otherwise(text)


def _character(code: Column) -> Column:
    """The character of a code point: a plain space for the no-break one, U+FFFD for what is none."""
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.when(code == 160, " ").when(valid, char).otherwise("\ufffd")


def html_to_text(html: Column) -> Column:
    """Markdown text of the first ``<article>``: headings, lists, links, emphasis and code; null when there is none."""
    text = F.regexp_substr(F.regexp_replace(html, r"(?s)<!--.*?-->", ""), F.lit(ARTICLE))
    text = F.regexp_replace(text, r"(?is)<(script|style)\b.*?</\1>", "")
    for level in range(1, 7):
        text = F.regexp_replace(text, rf"(?i)<h{level}\b[^>]*>", "\n" + "#" * level + " ")
    text = F.regexp_replace(text, r"(?is)<(b|strong)\b[^>]*>(\S|\S[^<]*\S)</\1>", "**$2**")
    text = F.regexp_replace(text, r"(?is)<(i|em)\b[^>]*>(\S|\S[^<]*\S)</\1>", "*$2*")
    text = F.regexp_replace(text, r"(?is)<pre\b[^>]*>\s*(?:<code\b[^>]*>)?([^<]*)(?:</code>)?\s*</pre>", "\n```\n$1\n```\n")
    text = F.regexp_replace(text, r"(?is)<code\b[^>]*>([^<]+)</code>", "`$1`")
    text = F.regexp_replace(text, r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"'<>]*)[\"'][^>]*>([^<]+)</a>", "[$2]($1)")
    text = F.regexp_replace(text, r"(?i)</h[1-6]>|<br\b[^>]*>", "\n")
    text = F.regexp_replace(text, r"(?i)<li\b[^>]*>", "\n- ")
    text = F.regexp_replace(text, r"(?i)</t[dh]>\s*<t[dh]\b[^>]*>", " | ")
    text = F.regexp_replace(text, r"(?i)<tr\b[^>]*>", "\n")
    text = F.regexp_replace(text, r"(?i)</p>", "\n\n")
    text = F.regexp_replace(text, r"<[^>]*>", "")
    text = F.regexp_replace(text, r"\n[ \t\r]*\n[ \t\r\n]*\n", "\n\n")
    return strip(unescape(text))
