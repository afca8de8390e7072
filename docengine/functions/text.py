"""Small text functions: suffixes, base64, image formats, joins and pagination."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ranges import let

# Image formats by suffix, and the rule's default.
IMAGE_FORMATS = {".bmp": "BMP", ".gif": "GIF", ".jpeg": "JPEG", ".jpg": "JPEG", ".png": "PNG", ".tif": "TIFF", ".tiff": "TIFF", ".webp": "WEBP"}
DEFAULT_IMAGE_FORMAT = "PNG"
DEFAULT_SUFFIX = ".pdf"


def suffix(filename: Column) -> Column:
    """Last suffix with its dot, or empty: ``x.tar.gz`` has ``.gz``, ``.pdf`` has none."""
    return F.regexp_extract(filename, r"[^/](\.[^./]+)$", 1)


def suffix_or_default(filename: Column) -> Column:
    return F.coalesce(F.nullif(suffix(filename), F.lit("")), F.lit(DEFAULT_SUFFIX))


def output_path(path: Column, explicit: Column | None = None) -> Column:
    """The explicit path, or the input's with its suffix replaced by ``.md``."""
    made = F.when(suffix(path) == "", F.concat(path, F.lit(".md"))).otherwise(F.regexp_replace(path, r"\.[^./]+$", ".md"))
    return made if explicit is None else F.coalesce(explicit, made)


def encode64(content: Column) -> Column:
    """Base64 on one line (Spark breaks lines every 76 signs by default)."""
    return F.regexp_replace(F.base64(content), "[\r\n]", "")


def decode64(text: Column) -> Column:
    """Binary of base64 text, or null if it is malformed, as a lenient decoder reads it.

    Signs outside the alphabet are skipped. Padding counts once a group of four has two signs or more,
    and starts anew after further signs; where a group is first padded to four, the text ends, and what follows is
    left out. Without that, the number of signs must be a multiple of four. Text beyond ASCII is malformed.
    """
    clean = F.split(F.regexp_replace(text, "[^A-Za-z0-9+/=]", ""), "=", -1)

    def step(acc: Column, x: Column) -> Column:
        """One piece of signs and the padding sign behind it."""
        signs = acc["signs"] + F.length(x)
        pads = F.when(F.length(x) > 0, 0).otherwise(acc["pads"]) + F.when(signs % 4 >= 2, 1).otherwise(0)
        ended = (signs % 4 >= 2) & (signs % 4 + pads >= 4)
        return F.when(acc["ended"], acc).otherwise(F.struct(signs.alias("signs"), pads.alias("pads"), (acc["taken"] + 1).alias("taken"), ended.alias("ended")))

    start = F.struct(F.lit(0).alias("signs"), F.lit(0).alias("pads"), F.lit(0).alias("taken"), F.lit(False).alias("ended"))

    def read(pieces: Column) -> Column:
        end = F.aggregate(F.slice(pieces, 1, F.size(pieces) - 1), start, step)
        return let(end, lambda e: F.struct(F.array_join(F.slice(pieces, 1, F.when(e["ended"], e["taken"]).otherwise(F.size(pieces))), "").alias("signs"), e["ended"].alias("ended")))

    padded = lambda s: F.concat(s, F.repeat(F.lit("="), F.pmod(-F.length(s), F.lit(4))))
    got = let(let(clean, read), lambda r: F.when(r["ended"] | (F.length(r["signs"]) % 4 == 0), F.unbase64(padded(r["signs"]))))
    return F.when(~text.rlike(r"[^\x00-\x7F]"), got)


def image_format(filename: Column, own: Column | None = None) -> Column:
    """Format by suffix, else the image's own, else PNG."""
    table = F.create_map(*(F.lit(x) for pair in IMAGE_FORMATS.items() for x in pair))
    known = F.try_element_at(table, F.lower(suffix(filename)))
    return F.coalesce(known, F.upper(own) if own is not None else F.lit(None).cast("string"), F.lit(DEFAULT_IMAGE_FORMAT))


def media_type(filename: Column, own: Column | None = None) -> Column:
    return F.concat(F.lit("image/"), F.lower(image_format(filename, own)))


def join_texts(texts: Column) -> Column:
    """Non-empty texts joined by a blank line; blank but not empty ones stay."""
    return F.array_join(F.filter(texts, lambda x: x != ""), "\n\n")


def paginate(pages: Column) -> Column:
    """Pages behind rules that carry their zero-based number."""
    rule = lambda p, i: F.concat(F.lit("\n\n{"), i.cast("string"), F.lit("}" + "-" * 48 + "\n\n"), p)
    return F.array_join(F.transform(pages, rule), "")
