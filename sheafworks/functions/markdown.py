"""Markdown structure inside one row.

A document is one row, so its lines, fences and headers are taken apart with array
functions in that row. Nothing is exploded and shuffled back together, and cost is
linear in the length of the document.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from . import text as T

_FENCE_LINE = rf"\n[{P.INLINE_SPACE_CLASS}]*{P.FENCE}[^\n]*"

# Header marks are written with a Unicode noncharacter. It is not printable, so no line holds it.
_MARK = "\ufdd0"


def _by_fences(text: Column, body) -> Column:
    """body(parts, fences) for a text cut at its fence lines.

    Parts 0, 2, 4.. lie outside code, parts 1, 3, 5.. inside. Every line carries its
    leading newline, so parts and fences join back without gaps.
    """

    def cut(framed: Column) -> Column:
        both = F.struct(
            F.split(framed, _FENCE_LINE).alias("parts"),
            F.regexp_extract_all(framed, F.lit(_FENCE_LINE), F.lit(0)).alias("fences"),
        )
        return T.let(both, lambda b: body(b["parts"], b["fences"]))

    return T.let(F.concat(F.lit("\n"), text), cut)


def _rewrite(text: Column, outside, inside, fence_line) -> Column:
    """The text (with a leading newline) after rewriting its parts and fence lines."""

    def rejoin(parts: Column, fences: Column) -> Column:
        def one(part: Column, i: Column) -> Column:
            body = F.when(i % 2 == 0, outside(part)).otherwise(inside(part))
            return F.concat(body, F.coalesce(fence_line(F.get(fences, i)), F.lit("")))

        return F.array_join(F.transform(parts, one), "")

    return _by_fences(text, rejoin)


def fenced_lines(text: Column) -> Column:
    """array<struct<line, in_code, is_fence>> in line order.

    `in_code` is the state after the line: an opening fence is inside, a closing one outside.
    """

    def entry(line: Column, in_code: Column, is_fence: bool) -> Column:
        return F.struct(line.alias("line"), in_code.alias("in_code"), F.lit(is_fence).alias("is_fence"))

    def collect(parts: Column, fences: Column) -> Column:
        def lines_of(part: Column, i: Column) -> Column:
            inside = i % 2 == 1
            lines = F.transform(F.split(part, "\n"), lambda line: entry(line, inside, False))
            # The part starts with a newline, so its first line is not a line.
            body = T.let(lines, lambda a: F.slice(a, F.lit(2), F.size(a)))
            fence = F.get(fences, i)
            closing = F.array(entry(F.substr(fence, F.lit(2)), ~inside, True))
            return F.concat(body, F.filter(closing, lambda line: line["line"].isNotNull()))

        return F.flatten(F.transform(parts, lines_of))

    return _by_fences(text, collect)


def clean_text(text: Column, markup_in_code: bool = True) -> Column:
    """The cleaning chain: markup out, meaningless lines out, blanks and spaces collapsed.

    Code keeps its lines (right-stripped). With `markup_in_code` tags, images and links
    are removed from the whole text first, code included; without it code is left alone.
    """

    def outside(part: Column) -> Column:
        body = part if markup_in_code else T.strip_markup(part)
        kept = F.filter(F.split(body, "\n"), lambda line: ~T.is_dropped_line(line))
        return F.array_join(F.transform(kept, T.tidy_line), "\n")

    def inside(part: Column) -> Column:
        return F.array_join(F.transform(F.split(part, "\n"), T.rstrip), "\n")

    source = T.strip_markup(text) if markup_in_code else text
    return T.let(T.collapse_blank_lines(_rewrite(source, outside, inside, T.rstrip)), T.strip)


def _bare_lines(text: Column) -> Column:
    """The text with a newline before it, every line stripped and without unprintable characters.

    In plain text, which most is, the only white space inside a line is the space.
    """
    space = f"[{P.INLINE_SPACE_CLASS}]++"

    def of_any(framed: Column) -> Column:
        bare = F.regexp_replace(framed, rf"{space}(?=\n|\z)", "")
        bare = F.regexp_replace(bare, rf"\n{space}", "\n")
        return T.let(
            bare, lambda t: F.when(t.rlike(P.NOT_PRINTABLE), F.regexp_replace(t, P.NOT_PRINTABLE, "")).otherwise(t)
        )

    def of_plain(framed: Column) -> Column:
        bare = T.replaced(framed, (" \n",), r" ++(?=\n)", "")
        return F.rtrim(T.replaced(bare, ("\n ",), r"\n ++", "\n"))

    return T.let(
        F.concat(F.lit("\n"), text), lambda t: F.when(t.rlike(P.PLAIN_TEXT), of_plain(t)).otherwise(of_any(t))
    )


def _fence_states(fences: Column) -> Column:
    """The fence that is open after each fence line, or ''.

    A line of backticks opens code unless it closes it in itself; tildes always open it. Code ends at
    a line that begins with the fence that opened it, so one kind may stand inside the other.
    """

    def step(state: Column, i: Column) -> Column:
        return T.let(F.get(fences, i), lambda line: advance(state, line))

    def advance(state: Column, line: Column) -> Column:
        ticks = line.startswith("\n" + P.FENCE) & (F.regexp_count(line, F.lit(P.FENCE)) == 1)
        opened = F.when(ticks, P.FENCE).when(line.startswith("\n" + P.OTHER_FENCE), P.OTHER_FENCE).otherwise("")
        closed = line.startswith(F.concat(F.lit("\n"), state["fence"]))
        after = F.when(state["fence"] == "", opened).otherwise(F.when(closed, "").otherwise(state["fence"]))
        return T.let(
            after, lambda f: F.struct(F.array_append(state["states"], f).alias("states"), f.alias("fence"))
        )

    return F.flatten(
        T.fold_in_blocks(F.size(fences), {"fence": F.lit("")}, step, "states", "string")["states"]
    )


def _marked_headers(framed: Column) -> Column:
    """The lines with a mark before each header line; paragraphs outside code end in two spaces."""

    def outside(part: Column, i: Column, last: Column) -> Column:
        body = F.when(
            (i == 0) & part.startswith("\n\n"), F.regexp_replace(part, r"\A\n+(?=[^\n]|\z)", "\n")
        ).otherwise(part)
        for level in (1, 2, 3):
            header = rf"\n+(?=#{{{level}}}(?:[ \n{_MARK}]|\z))"
            body = T.replaced(body, ("\n" + "#" * level,), header, f"{_MARK}{level}\n")
        body = T.replaced(body, ("\n\n",), r"\n{2,}(?=[^\n])", P.PARAGRAPH_BREAK)
        ended = F.when(last | (body == "\n") & (i == 0), F.lit("")).otherwise(F.lit(P.PARAGRAPH_BREAK[:-1]))
        return T.let(
            body, lambda b: F.when(b.endswith("\n"), F.concat(F.rtrim(b, F.lit("\n")), ended)).otherwise(b)
        )

    def rejoin(parts: Column, fences: Column, states: Column) -> Column:
        def one(part: Column, i: Column) -> Column:
            code = F.coalesce(F.get(states, i - 1), F.lit("")) != ""
            body = F.when(code, part).otherwise(outside(part, i, i == F.size(fences)))
            return F.concat(body, F.coalesce(F.get(fences, i), F.lit("")))

        return F.array_join(F.transform(parts, one), "")

    line = rf"\n(?:{P.FENCE}|{P.OTHER_FENCE})[^\n]*"
    both = F.struct(
        F.split(framed, line).alias("parts"), F.regexp_extract_all(framed, F.lit(line), F.lit(0)).alias("fences")
    )
    return T.let(
        both, lambda b: T.let(_fence_states(b["fences"]), lambda states: rejoin(b["parts"], b["fences"], states))
    )


def header_parts(text: Column) -> Column:
    """array<struct<h1, h2, h3, text>>: the text cut before each header line outside code.

    Headers are lines of one to three # that end there or go on after a space. A header holds until
    one of the same or a higher level; one that does not hold is null, a bare one ''. Lines are
    stripped, unprintable characters go; paragraphs are parted by two spaces and a newline, and blank
    lines stay in code alone. A level-1 part is cut into level-2 parts and those into level-3 parts,
    which gives each its headers without a window.
    """

    def title(piece: Column, level: int, i: Column) -> Column:
        # The first line, which begins with a newline and may end in the mark of the next part.
        line = F.substring_index(F.substring_index(F.substr(piece, F.lit(2)), "\n", 1), _MARK, 1)
        return F.when(i > 0, T.strip(F.substr(line, F.lit(level + 1))))

    def by_h3(piece: Column, h1: Column, h2: Column) -> Column:
        return F.transform(
            F.split(piece, _MARK + "3"),
            lambda sub, k: F.struct(
                h1.alias("h1"),
                h2.alias("h2"),
                title(sub, 3, k).alias("h3"),
                F.substr(sub, F.lit(2)).alias("text"),
                (sub != "").alias("present"),
            ),
        )

    def by_h2(piece: Column, h1: Column) -> Column:
        def one(sub: Column, j: Column) -> Column:
            return T.let(title(sub, 2, j), lambda h2: by_h3(sub, h1, h2))

        return F.flatten(F.transform(F.split(piece, _MARK + "2"), one))

    def by_h1(marked: Column) -> Column:
        def one(sub: Column, i: Column) -> Column:
            return T.let(title(sub, 1, i), lambda h1: by_h2(sub, h1))

        return F.flatten(F.transform(F.split(marked, _MARK + "1"), one))

    pieces = by_h1(T.let(_bare_lines(text), _marked_headers))
    return F.transform(
        F.filter(pieces, lambda s: s["present"]),
        lambda s: F.struct(*(s[f].alias(f) for f in ("h1", "h2", "h3", "text"))),
    )


def sections(text: Column) -> Column:
    """array<struct<section_id, h1, h2, h3, text>>: the header parts, some joined to one section.

    Neighbours under the same headers are one section. A part that ends in a header line (an empty
    parent) is folded into the next one if that stands under more headers. A section has the headers
    of its last part, '' where none holds, and the texts joined like paragraphs.
    """
    levels = ("h1", "h2", "h3")

    def joins(one: Column, two: Column) -> Column:
        same = one["h1"].eqNullSafe(two["h1"]) & one["h2"].eqNullSafe(two["h2"]) & one["h3"].eqNullSafe(two["h3"])
        deeper = sum(one[h].isNotNull().cast("int") for h in levels) < sum(
            two[h].isNotNull().cast("int") for h in levels
        )
        ends = F.substring_index(one["text"], "\n", -1).startswith("#")
        return same | (deeper & ends)

    def join_up(parts: Column) -> Column:
        begins = F.transform(
            parts, lambda part, i: F.when((i == 0) | ~joins(F.get(parts, i - 1), part), i)
        )
        return T.let(F.filter(begins, lambda i: i.isNotNull()), lambda starts: joined(parts, starts))

    def joined(parts: Column, starts: Column) -> Column:
        def one(start: Column, j: Column) -> Column:
            end = F.coalesce(F.get(starts, j + 1), F.size(parts))
            texts = F.transform(F.slice(parts, start + 1, end - start), lambda p: p["text"])
            head = F.get(parts, end - 1)
            return F.struct(
                j.alias("section_id"),
                *(F.coalesce(head[h], F.lit("")).alias(h) for h in levels),
                F.array_join(texts, P.PARAGRAPH_BREAK).alias("text"),
            )

        return F.transform(starts, one)

    return T.let(header_parts(text), join_up)
