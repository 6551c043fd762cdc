"""Text functions as column expressions."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as str.strip sees it: all Unicode blanks and the four separators.
BLANKS = "".join(map(chr, (0x20, *range(0x09, 0x0E), *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def strip(text: Column) -> Column:
    """The text without outer white space of any kind; trim alone takes blanks only."""
    return F.btrim(text, F.lit(BLANKS))


def ordinal(n: Column) -> Column:
    """1st, 2nd, 3rd, 4th ...; 10 to 20 of each hundred take th."""
    ten, one = n % 100, n % 10
    end = F.when(ten.between(10, 20), "th").when(one == 1, "st").when(one == 2, "nd").when(one == 3, "rd").otherwise("th")
    return F.concat(n.cast("string"), end)


def xml_text(text: Column) -> Column:
    """Escaped for element content; the ampersand first."""
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def xml_attribute(text: Column) -> Column:
    return F.replace(xml_text(text), F.lit('"'), F.lit("&quot;"))


def strip_ansi(text: Column) -> Column:
    """Without terminal colour sequences."""
    return F.regexp_replace(text, "\x1b\\[\\d+(;\\d+){0,2}m", "")


def content_markup(text: Column) -> Column:
    """A text run as markup: nothing if empty, wrapped in content if white space stands at its edge."""
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, "").when(F.length(strip(text)) < F.length(text), F.concat(F.lit("<content>"), xml_text(text), F.lit("</content>"))).otherwise(xml_text(text))


def config_hash(config: dict) -> str:
    """Eight hex digits of a configuration, whatever the order of its keys."""
    return hashlib.sha1(json.dumps(config, sort_keys=True).encode()).hexdigest()[:8]


def data_uri(path: Column, content: Column) -> Column:
    """A file as a data URI; the type follows the extension, png if unknown."""
    ext = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    kinds = F.create_map(*[F.lit(x) for pair in (("jpg", "image/jpeg"), ("jpeg", "image/jpeg"), ("png", "image/png"), ("gif", "image/gif"), ("webp", "image/webp"), ("tif", "image/tiff"), ("tiff", "image/tiff"), ("bmp", "image/bmp")) for x in pair])
    return F.concat(F.lit("data:"), F.coalesce(F.try_element_at(kinds, ext), F.lit("image/png")), F.lit(";base64,"), F.base64(content))
