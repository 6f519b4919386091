"""Column expressions over text. No Python runs per row."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def let(value: Column, body) -> Column:
    """body(value) with `value` worked out once, however often the body names it.

    Inside array functions a repeated expression is otherwise evaluated again for every
    mention, and an expression over the whole row again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: Steps per block of `fold_in_blocks`; a setting of speed only.
FOLD_BLOCK = 256


def fold_in_blocks(count: Column, begin: dict[str, Column], step, results: str, kind: str) -> Column:
    """The state after `step(state, i)` for i in 0..count-1.

    A state has the fields of `begin` and, first, a list `results` of `kind` to which steps append.
    Appending copies a list, so each block of steps has one of its own: the last state holds a list
    of lists.
    """

    def with_results(state: Column, held: Column) -> Column:
        return F.struct(held.alias(results), *(state[f].alias(f) for f in begin))

    def block(state: Column, first: Column) -> Column:
        last = F.least(first + (FOLD_BLOCK - 1), count - 1)
        start = with_results(state, F.array().cast(f"array<{kind}>"))
        return let(
            F.aggregate(F.sequence(first, last), start, step),
            lambda done: with_results(done, F.array_append(state[results], done[results])),
        )

    firsts = F.when(count > 0, F.sequence(F.lit(0), count - 1, F.lit(FOLD_BLOCK)))
    none = F.array().cast(f"array<array<{kind}>>")
    zero = F.struct(none.alias(results), *(value.alias(f) for f, value in begin.items()))
    return F.aggregate(F.coalesce(firsts, F.array().cast("array<int>")), zero, block)


def _ends_bare(text: Column, place: int) -> Column:
    """True where the first (1) or last (-1) byte is printable ASCII, so that there is nothing to trim.

    Trimming by a set of characters takes as long as the text is, also where it finds nothing.
    """
    byte = F.substring(text.cast("binary"), place, 1)
    return (byte > F.lit(b"\x20")) & (byte < F.lit(b"\x7f"))


def strip(text: Column) -> Column:
    """Names its text three times: what is costly to work out is bound with `let` before."""
    return F.when(_ends_bare(text, 1) & _ends_bare(text, -1), text).otherwise(F.btrim(text, F.lit(P.WHITESPACE)))


def rstrip(text: Column) -> Column:
    return F.when(_ends_bare(text, -1), text).otherwise(F.rtrim(text, F.lit(P.WHITESPACE)))


def replaced(text: Column, needles: tuple[str, ...], pattern: str, by: str) -> Column:
    """The text with `by` for each match of a pattern that only matches where one of the needles occurs.

    Finding a needle is much cheaper than a match, for which the text is decoded and encoded again.
    """

    def where_found(t: Column) -> Column:
        found = reduce(or_, (t.contains(needle) for needle in needles))
        return F.when(found, F.regexp_replace(t, pattern, by)).otherwise(t)

    return let(text, where_found)


def strip_tags(text: Column) -> Column:
    return replaced(text, ("<",), P.HTML_TAG, "")


def drop_images(text: Column) -> Column:
    return replaced(text, ("![",), P.MARKDOWN_IMAGE, "")


def unlink(text: Column) -> Column:
    """[label](target) becomes label."""
    return replaced(text, ("](",), P.MARKDOWN_LINK, "$1")


def strip_markup(text: Column) -> Column:
    return unlink(drop_images(strip_tags(text)))


def collapse_spaces(line: Column) -> Column:
    """Runs of spaces and tabs become one space; single spaces are not touched."""
    return replaced(line, ("  ", "\t"), P.SPACE_RUN, " ")


def collapse_blank_lines(text: Column) -> Column:
    return replaced(text, ("\n\n\n",), P.BLANK_RUN, "\n\n")


def char_count(text: Column) -> Column:
    return F.length(text)


def byte_count(text: Column) -> Column:
    return F.octet_length(text)


def word_count(text: Column) -> Column:
    bare = strip(text)
    return F.when(bare == "", 0).otherwise(F.array_size(F.split(bare, P.WORD_BREAK)))


def line_count(text: Column) -> Column:
    """Lines as splitlines() counts them: a final line end opens no new line.

    Text without the rarer line ends, which is nearly all text, needs no match per line.
    """
    newlines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    plain = newlines + ((text != "") & ~text.endswith("\n")).cast("int")
    breaks = F.regexp_count(text, F.lit(P.LINE_END))
    mixed = breaks + (~text.rlike(P.ENDS_IN_LINE_END)).cast("int")
    return F.when(text.rlike(P.RARE_LINE_END), mixed).otherwise(plain)


def box_runs(text: Column) -> Column:
    """Runs of box-drawing characters (a run counts once, however long).

    Cheap tests first: few texts hold any, and the full class is slow to match. A box has three bytes.
    """
    wide = F.octet_length(text) > F.length(text) + 1
    return F.when(wide & text.rlike(P.BOX_BLOCK), F.regexp_count(text, F.lit(P.BOX_RUN))).otherwise(0)


def url_chars(text: Column) -> Column:
    urls = F.regexp_extract_all(text, F.lit(P.URL), F.lit(0))
    return F.when(text.contains("http"), F.length(F.array_join(urls, ""))).otherwise(F.length(text) * 0)


def is_dropped_line(line: Column) -> Column:
    """Lines outside code that carry no meaning: boxes, rules, navigation, badges."""

    def judge(bare: Column) -> Column:
        lowered = F.lower(bare)
        boxes = box_runs(line) > F.length(bare) * F.lit(P.BOX_LINE_RATIO)
        rule = ~bare.contains(" ") & bare.rlike(P.SEPARATOR_LINE)
        navigation = lowered.contains(P.BACK_TO_TOP)
        badge = bare.contains(P.BADGE_HOST) | (bare.contains("http") & lowered.contains("badge"))
        return (bare != "") & (boxes | rule | navigation | badge)

    return let(strip(line), judge)


def tidy_line(line: Column) -> Column:
    return collapse_spaces(strip(line))


def noise_reasons(
    text: Column, min_size: int = P.MIN_CHUNK_SIZE, max_ratio: float = P.MAX_NOISE_RATIO
) -> dict[str, Column]:
    """One boolean per reason to drop a chunk."""
    return _noise_reasons(text, strip(text), min_size, max_ratio)


def _noise_reasons(text: Column, bare: Column, min_size: int, max_ratio: float) -> dict[str, Column]:
    size = F.length(bare)
    runs = box_runs(text)
    return {
        "too_short": size < min_size,
        "box_heavy": (runs > 0) & F.coalesce(runs / F.nullif(size, F.lit(0)) > max_ratio, F.lit(False)),
        "table_row": bare.startswith("|") & bare.endswith("|") & ~bare.contains("\n"),
        # Looks for the 20th character that is neither separator nor space, and stops there.
        "separator_only": ~bare.rlike(P.ENOUGH_LETTERS),
        "mostly_urls": url_chars(bare) > size * F.lit(P.MAX_URL_RATIO),
    }


def is_noise(text: Column, min_size: int = P.MIN_CHUNK_SIZE, max_ratio: float = P.MAX_NOISE_RATIO) -> Column:
    def judge(bare: Column) -> Column:
        return reduce(or_, _noise_reasons(text, bare, min_size, max_ratio).values())

    return let(strip(text), judge)


def header_context(h1: Column, h2: Column, h3: Column) -> Column:
    """The headers in force, one markdown line each."""
    return F.concat(
        *(
            F.when(header != "", F.concat(F.lit(mark + " "), header, F.lit("\n"))).otherwise(F.lit(""))
            for mark, header in (("#", h1), ("##", h2), ("###", h3))
        )
    )


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def repo_name(path: Column) -> Column:
    """Repository from `{repo}_README_{time}.md`, else the file name without its suffix."""
    name = base_name(path)
    found = F.regexp_extract(name, P.REPO_FILE, 1)
    return F.when(found != "", found).otherwise(F.replace(name, F.lit(".md"), F.lit("")))


def repo_name_with_time(path: Column) -> Column:
    """The second form in use: stem without `_README`, the time stays."""
    name = base_name(path)
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]+\z", "")
    return F.replace(stem, F.lit("_README"), F.lit(""))


def compact_time(ts: Column) -> Column:
    """yyyyMMdd_HHmmss from a timestamp with or without zone."""
    shown = ts.cast("string")
    return F.concat(
        F.translate(F.substring(shown, 1, 10), "-", ""),
        F.lit("_"),
        F.translate(F.substring(shown, 12, 8), ":", ""),
    )


def readme_file_name(repo: Column, ts: Column) -> Column:
    return F.concat(repo, F.lit("_README_"), compact_time(ts), F.lit(".md"))


def decode_base64(payload: Column) -> Column:
    """UTF-8 text of a base64 payload; null where the payload is broken."""
    return F.try_to_binary(payload, F.lit("base64")).cast("string")


def hash_uuid(*parts: Column) -> Column:
    """A stable id in UUID form: the same content gets the same id on every run."""
    digest = F.md5(F.concat_ws("\u0001", *(part.cast("string") for part in parts)))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.substring(digest, 13, 4),
        F.substring(digest, 17, 4),
        F.substring(digest, 21, 12),
    )
