"""Slugs of labels and column names, as built-in Column expressions."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def _char_class(chars) -> str:
    """Regex character class over the given characters, as code-point ranges."""
    points = sorted(map(ord, chars))
    parts, i = [], 0
    while i < len(points):
        j = i
        while j + 1 < len(points) and points[j + 1] == points[j] + 1:
            j += 1
        parts.append(f"\\x{{{points[i]:X}}}-\\x{{{points[j]:X}}}")
        i = j + 1
    # The first half rejects ASCII, most of any text, in one comparison.
    return "[[^\\x00-\\x7F]&&[" + "".join(parts) + "]]"


@lru_cache(maxsize=None)
def _folds(ascii_only: bool):
    """What each non-ASCII character becomes under NFKD, derived from the Unicode database.

    Returns the one-to-one and deleting part as two ``translate`` arguments, and
    the characters that become several letters with one ``translate`` argument
    per output position. Runs that end up as separators count as one blank. No
    character beyond the first two planes has an ASCII form.
    """
    single, deleted, multi = {}, [], {}
    for char in map(chr, range(0x80, 0x20000)):
        if not unicodedata.decomposition(char) and not unicodedata.combining(char):
            continue
        form = unicodedata.normalize("NFKD", char)
        if ascii_only:
            form = form.encode("ascii", "ignore").decode("ascii")
        else:
            form = "".join(c for c in form if not unicodedata.combining(c))
        form = re.sub(r"[^a-z0-9]+", " ", form)
        if form == "":
            if not ascii_only:
                deleted.append(char)
        elif form == " ":
            if ascii_only:
                single[char] = " "
        elif len(form) == 1:
            single[char] = form
        else:
            multi[char] = form
    match, replace = "".join([*single, *deleted]), "".join(single.values())
    width = max(map(len, multi.values()))
    steps = []
    for i in range(width):
        longer = [c for c in multi if len(multi[c]) > i]
        shorter = [c for c in multi if len(multi[c]) <= i]
        steps.append(("".join([*longer, *shorter]), "".join(multi[c][i] for c in longer)))
    return match, replace, _char_class(multi), steps


def fold_text(text: Column, ascii_only: bool = True) -> Column:
    """Lower case with accents and compatibility forms resolved.

    ``ascii_only`` drops what has no ASCII form; otherwise only combining marks
    are dropped. Plain ASCII passes through; ligatures, fractions and the like
    take the slowest branch.
    """
    match, replace, multi_class, steps = _folds(ascii_only)

    def spread(char: Column) -> Column:
        parts = [F.translate(char, m, r) for m, r in steps]
        return F.when(char.rlike(multi_class), F.concat(*parts)).otherwise(char)

    lower = F.lower(text)
    spelled = F.when(
        lower.rlike(multi_class), F.array_join(F.transform(F.split(lower, ""), spread), "")
    ).otherwise(lower)
    folded = F.translate(spelled, match, replace)
    if ascii_only:
        folded = F.regexp_replace(folded, r"[^\x00-\x7F]+", "")
    return F.when(F.length(lower) == F.octet_length(lower), lower).otherwise(folded)


def slug(text: Column) -> Column:
    """Snake-case name; characters without an ASCII form vanish; empty becomes ``unnamed``."""
    name = F.btrim(F.regexp_replace(fold_text(text), "[^a-z0-9]+", "_"), F.lit("_"))
    return F.coalesce(F.nullif(name, F.lit("")), F.lit("unnamed"))


def slug_soft(text: Column) -> Column:
    """Snake-case label; characters without an ASCII form become ``_``; null becomes empty."""
    name = F.regexp_replace(fold_text(text, ascii_only=False), "[^a-z0-9]+", "_")
    return F.coalesce(F.btrim(name, F.lit("_")), F.lit(""))


def slug_name(name: object) -> str:
    """The rule of :func:`slug` for one column name of a schema."""
    plain = unicodedata.normalize("NFKD", str(name).lower()).encode("ascii", "ignore").decode()
    return re.sub("[^a-z0-9]+", "_", plain).strip("_") or "unnamed"


def contains_any(text: Column, words: list[str]) -> Column:
    """True when the text contains one of the words."""
    return text.rlike("|".join(re.escape(w) for w in words)) if words else F.lit(False)
