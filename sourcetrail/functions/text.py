"""Text expressions.  All of them are plain column expressions, so one definition serves
batch and streaming frames, needs no shuffle and stays in the JVM."""

from __future__ import annotations

import json
import sys
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from sourcetrail import contract as K

# A line ends after any of these; \r\n counts as one terminator.
LINE_END = r"(?<=[\n\x0B\f\x1C\x1D\x1E\x85\u2028\u2029])|(?<=\r)(?!\n)"
GROUP_MARK = "\x01"
LEADING_SPACE = r"(?U)^[\s\x1c-\x1f]+"
TRAILING_SPACE = r"(?U)[\s\x1c-\x1f]+$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.transform(F.array(value), body)[0]


def fixed(value: Column) -> Column:
    """Generator that yields the value once.  Select it to have the value computed exactly once per
    row: filters and projections above it see a column and cannot repeat the expression."""
    return F.explode(F.array(value))


def _decompositions() -> dict[str, str]:
    """What each character is without compatibility forms and combining marks, where that is another text.

    Hangul syllables are left whole: they have no form that a name is also written in."""
    out = {}
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        if unicodedata.category(char) not in ("Cs", "Cn", "Co") and not 0xAC00 <= code <= 0xD7A3:
            base = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
            if base != char and not unicodedata.combining(char):
                out[char] = base
    return out


def _class_of(chars: list[str], gap: int = 1) -> str:
    """A pattern for one of the characters; with a larger gap also for what lies between them."""
    codes, ranges = sorted(map(ord, chars)), []
    for code in codes:
        if ranges and code - ranges[-1][1] <= gap:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges) + "]"


def _either(pattern: str, beyond: int) -> str:
    """The class, or any character from a code point on."""
    return pattern[:-1] + f"\\x{{{beyond:X}}}-\\x{{{sys.maxunicode:X}}}]"


_BASES = _decompositions()
_SINGLE = {c: b for c, b in _BASES.items() if len(b) == 1}
_SEVERAL = {c: b for c, b in _BASES.items() if len(b) != 1}
ACCENTED, PLAIN = "".join(_SINGLE), "".join(_SINGLE.values())
LONGER = _class_of(list(_SEVERAL))
# what a text is searched for first: few ranges, so that most texts are passed by quickly
MAY_BE_LONGER = _either(_class_of([c for c in _SEVERAL if c < "\u0300"]), 0x300)


def strip_accents(text: Column) -> Column:
    """Letters without accents and in their plain form: full-width, ligatures, circled, super- and subscript ones too.

    Characters that become several are looked up only in texts that hold one; a text of ASCII alone is passed through."""

    single = F.translate(text, ACCENTED, PLAIN)
    longer = rewrite_matches(single, LONGER, lambda hit: literal_lookup(hit, _SEVERAL))
    plain = F.regexp_replace(F.when(text.rlike(MAY_BE_LONGER), longer).otherwise(single), r"\p{M}+", "")
    return F.when(F.octet_length(text) == F.length(text), text).otherwise(plain)


def fold_case(text: Column) -> Column:
    return F.lower(strip_accents(text))


def folded_key(folded: Column) -> Column:
    return F.trim(F.regexp_replace(folded, r"(?U)\s+", " "))


def name_key(name: Column) -> Column:
    return folded_key(fold_case(name))


def strip_left(text: Column) -> Column:
    return F.regexp_replace(text, LEADING_SPACE, "")


def strip_right(text: Column) -> Column:
    return F.regexp_replace(text, TRAILING_SPACE, "")


def strip(text: Column) -> Column:
    return strip_right(strip_left(text))


def is_textual(text: Column) -> Column:
    return F.length(F.trim(F.coalesce(text, F.lit("")))) > 0


def _written_as(letter: str) -> str:
    """A class of the Latin characters that fold to this one, itself included."""
    return _class_of([letter, *(chr(c) for c in range(0x180) if _SINGLE.get(chr(c), chr(c)).lower() == letter)])


def declares(text: Column, marker: str = K.DECLARATION_MARKER) -> Column:
    """Whether the folded text contains the marker.  Only a text that does not show it in Latin letters is folded."""
    shown = F.lit(marker == marker.lower()) & text.rlike("".join(map(_written_as, marker)))
    folded = F.contains(fold_case(F.coalesce(text, F.lit(""))), F.lit(marker))
    return F.when(shown, True).otherwise(folded)


def split_at(text: Column, pattern: str) -> Column:
    """Split at every match.  A pattern that splits is compiled for every text, one that replaces once: matches are replaced
    by a mark, and only a text that holds the mark itself is split by the pattern."""
    marked = F.split(F.regexp_replace(text, pattern, GROUP_MARK), GROUP_MARK, -1)
    return F.when(F.contains(text, F.lit(GROUP_MARK)), F.split(text, pattern, -1)).otherwise(marked)


def split_lines(text: Column) -> Column:
    """Lines with their terminators; concatenating them gives the text back."""
    return F.filter(split_at(text, LINE_END), lambda line: line != "")


def running_fold(
    items: Column, zero: Column, step: Callable[[Column, Column], Column], block: int = 64
) -> Column:
    """All intermediate states of a left fold over an array column.

    States are appended within blocks, finished blocks are appended to a list that is flattened at the
    end.  Blocks have about ``sqrt(n)`` items, ``block`` at least, so the copying grows with
    ``n * sqrt(n)`` on texts with very many lines."""

    def within(start: Column, run: Column) -> Column:
        return F.aggregate(
            run,
            F.array(start),
            lambda states, item: F.concat(states, F.array(step(F.element_at(states, -1), item))),
        )

    def over(bound: Column) -> Column:
        size = F.greatest(F.lit(block), F.ceil(F.sqrt(F.size(bound))).cast("int"))
        last_block = F.greatest(F.ceil(F.size(bound) / size).cast("int") - 1, F.lit(0))
        blocks = F.transform(F.sequence(F.lit(0), last_block), lambda b: F.slice(bound, b * size + 1, size))
        chained = F.aggregate(
            blocks,
            F.array(F.array(zero)),
            lambda done, run: F.concat(done, F.array(within(F.element_at(F.element_at(done, -1), -1), run))),
        )
        return F.flatten(F.transform(chained, lambda states: F.slice(states, 2, F.size(states) - 1)))

    return let(items, over)


def line_table(text: Column) -> Column:
    """Array of (start, end, line): every line with its character offsets in the text.

    Only the numbers go through the fold; the lines are put beside them afterwards."""

    def placed(lines: Column) -> Column:
        ends = running_fold(F.transform(lines, lambda line: F.length(line)), F.lit(0), lambda last, n: last + n)
        return F.zip_with(
            lines,
            ends,
            lambda line, end: F.struct((end - F.length(line)).alias("start"), end.alias("end"), line.alias("line")),
        )

    return let(split_lines(text), placed)


def rewrite_matches(
    text: Column, pattern: str, change: Callable[[Column], Column], needs: str | None = None
) -> Column:
    """Replace every match by ``change(match)``; everything between matches is kept as it is.

    ``needs`` is a simpler pattern that every match contains: a text without it is passed through unread."""

    def rebuilt(bound: Column) -> Column:
        between = split_at(bound, pattern)
        hits = F.regexp_extract_all(bound, F.lit(pattern), F.lit(0))
        joined = F.array_join(
            F.zip_with(between, hits, lambda kept, hit: F.concat(kept, F.coalesce(change(hit), F.lit("")))), ""
        )
        present = bound.rlike(pattern)
        if needs:
            present = bound.rlike(needs) & present
        return F.when(present, joined).otherwise(bound)

    return let(text, rebuilt)


def match_groups(text: Column, pattern: str, count: int) -> Column:
    """The groups of an anchored pattern as an array, NULL where the text does not match.

    One evaluation of the pattern writes all groups next to each other with a mark between them;
    a text that holds the mark itself is read group by group."""
    marked = F.regexp_replace(text, pattern, GROUP_MARK.join(f"${i}" for i in range(1, count + 1)))
    quick = let(F.split(marked, GROUP_MARK, -1), lambda parts: F.when(F.size(parts) == count, parts))
    single = F.array(*[F.regexp_extract(text, pattern, i) for i in range(1, count + 1)])
    return F.when(F.contains(text, F.lit(GROUP_MARK)), F.when(text.rlike(pattern), single)).otherwise(quick)


def hide_characters(match: Column) -> Column:
    return F.regexp_replace(match, K.HIDDEN_CHARACTER, "*")


def mask_identifiers(
    text: Column,
    labelled: str | None = K.LABELLED_IDENTIFIER,
    inline: dict[str, str] | None = None,
) -> Column:
    """Hide direct identifiers without moving any character offset."""
    out = F.coalesce(text, F.lit(""))
    if labelled:
        out = rewrite_matches(
            out,
            labelled,
            lambda hit: F.concat(
                F.regexp_extract(hit, labelled, 1),
                F.regexp_replace(F.regexp_extract(hit, labelled, 2), r"(?U)\S", "*"),
            ),
            needs=":",
        )
    for kind, pattern in (K.INLINE_IDENTIFIERS if inline is None else inline).items():
        needs = K.INLINE_NEEDS[kind] if K.INLINE_IDENTIFIERS.get(kind) == pattern else None
        out = rewrite_matches(out, pattern, hide_characters, needs)
    return out


def decimal_comma(raw: Column) -> Column:
    return F.replace(raw, F.lit(","), F.lit(".")).try_cast("double")


def calendar_date(raw: Column) -> Column:
    """dd/MM/yyyy; a date no calendar has gives NULL and is never moved to a neighbour."""
    return F.when(~raw.endswith("/0000"), F.try_to_date(raw, "dd/MM/yyyy"))


def literal_lookup(key: Column, table: dict[str, str]) -> Column:
    """Dictionary of the caller as one literal, whatever its size: no join, works on streams."""
    if not table:
        return F.lit(None).cast("string")
    return F.element_at(F.from_json(F.lit(json.dumps(table)), "map<string,string>"), key)
