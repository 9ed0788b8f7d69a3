"""Text columns."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accented letters and, in the same order, the letters without their accents.
ACCENTED = (
    "ÀÁÂÃÈÉÊÌÍÒÓÔÕÙÚÝàáâãèéêìíòóôõùúýĂăĐđĨĩŨũƠơƯưẠạẢảẤấẦầẨẩẪẫẬậẮắẰằẲẳẴẵẶặẸẹẺẻẼẽẾếỀềỂểỄễỆệỈỉỊịỌọ"
    "ỎỏỐốỒồỔổỖỗỘộỚớỜờỞởỠỡỢợỤụỦủỨứỪừỬửỮữỰựỲỳỴỵỶỷỸỹ"
)
PLAIN = (
    "AAAAEEEIIOOOOUUYaaaaeeeiioooouuyAaDdIiUuOoUuAaAaAaAaAaAaAaAaAaAaAaAaEeEeEeEeEeEeEeEeIiIiOo"
    "OoOoOoOoOoOoOoOoOoOoOoUuUuUuUuUuUuUuYyYyYyYy"
)

# Fixed value: what counts as an e-mail address (``(?U)``: word boundaries know accented letters).
EMAIL = r"(?U)\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"

# The URL shapes that carry a document or folder id, tried in this order.
DOCUMENT_SHAPES = (
    "/spreadsheets/d/",
    "/document/d/",
    "/presentation/d/",
    "/file/d/",
    "/forms/d/",
    "/drawings/d/",
    "/drive/folders/",
    "/drive/u/[0-9]+/folders/([^/?]+)",
    "/drive/shared-drives/",
    "/drive/u/[0-9]+/shared-drives/([^/?]+)",
    r"script\.google\.com/[a-z/]+/([^/?]+)",
)


def contains_words(col: Column, words: Sequence[str]) -> Column:
    """Does the text hold any of the words, as whole words, in any case?"""
    # Word boundaries in the ASCII sense, whatever the JVM takes \\b for; words with equal ends share one group.
    groups: dict[tuple[str, str], list[str]] = {}
    for word in words:
        ends = tuple("!" if re.match(r"\w", c, re.ASCII) else "=" for c in (word[0], word[-1]))
        groups.setdefault(ends, []).append(re.escape(word))
    options = [
        f"(?<{before}[0-9A-Za-z_])(?:{'|'.join(same)})(?{after}[0-9A-Za-z_])"
        for (before, after), same in groups.items()
    ]
    return F.lower(col).rlike("(?iu)" + "|".join(options))


def remove_accents(col: Column) -> Column:
    return F.translate(col, ACCENTED, PLAIN)


def strip_symbols(col: Column) -> Column:
    """Keep ASCII letters, digits and white space of any script."""
    return F.regexp_replace(col, r"[^a-zA-Z0-9\t-\r\x1c-\x1f\x85\p{Z}]", "")


def clean_text(col: Column) -> Column:
    """Newline becomes a space; carriage return, double quote and the dong sign go."""
    return F.translate(col, "\n\r\"₫", " ")


def replace_chars(col: Column, mapping: Mapping[str, str]) -> Column:
    """Replace single characters by any text, all at once: replacements are not replaced again."""
    one_to_one = {k: v for k, v in mapping.items() if len(v) == 1}
    removed = [k for k, v in mapping.items() if v == ""]
    longer = {k: v for k, v in mapping.items() if len(v) > 1}
    if not longer:
        return F.translate(col, "".join(one_to_one) + "".join(removed), "".join(one_to_one.values()))
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    letters = F.regexp_extract_all(col, F.lit("(?s)(.)"), F.lit(1))
    return F.array_join(F.transform(letters, lambda c: F.coalesce(F.try_element_at(table, c), c)), "")


def extract_email(col: Column) -> Column:
    """First e-mail address in the text, NULL if there is none."""
    return F.regexp_substr(col, F.lit(EMAIL))


def _found(col: Column, pattern: str) -> Column:
    return F.when(col.rlike(pattern), F.regexp_extract(col, pattern, 1))


def sheet_id(url: Column) -> Column:
    """Text after the first ``/d/`` up to the next slash."""
    return _found(url, "(?s)^.*?/d/([^/]*)")


def document_id(url: Column) -> Column:
    """Id in a document, folder, drive or script URL; the first shape that fits wins. After a plain path the id ends at
    the next slash, without one at a question mark, else at the end of the text."""

    def after(path: str) -> Column:
        rest = _found(url, f"(?s)^.*?{path}(.*)$")
        by_slash = F.substring_index(rest, "/", 1)
        return F.when(F.contains(rest, F.lit("/")), by_slash).otherwise(F.substring_index(rest, "?", 1))

    return F.coalesce(*[_found(url, shape) if "(" in shape else after(shape) for shape in DOCUMENT_SHAPES])


def sheet_url(sheet: Column) -> Column:
    return F.concat(F.lit("https://docs.google.com/spreadsheets/d/"), sheet, F.lit("/edit"))


def page_url(base: str, slug: Column) -> Column:
    """Profile page from its slug, NULL without one."""
    return F.concat(F.lit(base), slug)


def join_items(items: Column, delimiter: str, wrapper: str = "") -> Column:
    """One string of all items, each wrapped on both sides. A NULL item is written as ``None``."""
    wrapped = F.transform(
        items, lambda x: F.concat(F.lit(wrapper), F.coalesce(x.cast("string"), F.lit("None")), F.lit(wrapper))
    )
    return F.array_join(wrapped, delimiter)
