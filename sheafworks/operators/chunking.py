"""Markdown documents to chunks: sections, size split, noise filter, small-chunk merge."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import markdown as M
from ..functions import patterns as P
from ..functions import text as T
from .rows import explode_array, explode_structs


#: Chunks per block of the merge fold; a setting of speed only.
MERGE_BLOCK = 256


@dataclass(frozen=True)
class ChunkSettings:
    chunk_size: int = P.CHUNK_SIZE
    chunk_overlap: int = P.CHUNK_OVERLAP
    min_chunk_size: int = P.MIN_CHUNK_SIZE
    max_noise_ratio: float = P.MAX_NOISE_RATIO
    merge_below: int = P.MERGE_BELOW
    # "recursive" breaks at paragraphs, lines and words; "window" at fixed distances.
    size_split: str = "recursive"
    markup_in_code: bool = True


def split_window(text: Column, size: int, overlap: int) -> Column:
    """Pieces of `size` characters that start every size-overlap characters.

    A text that fits is one piece. A last piece that its predecessor already covers is
    not made.
    """
    # One pass over the text: each match looks ahead over a whole piece and moves on by a
    # step. Cutting by position would count characters from the start for every piece.
    pattern = rf"(?s)(?=(.{{1,{size}}})).{{1,{size - overlap}}}"
    pieces = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    return F.when(
        F.length(text) > size, F.filter(pieces, lambda piece: F.length(piece) > overlap)
    ).otherwise(F.array(text))


#: Where an over-long text is broken: paragraphs, then lines, then words, at last characters.
SEPARATORS = ("\n\n", "\n", " ")

# A Unicode noncharacter that marks cuts; text that holds it is escaped.
_CUT = "\ufdd0"


def _packed(parts: Column, size: int, overlap: int) -> Column:
    """Pieces of up to `size` characters from parts shorter than that, joined as they come.

    A piece begins with as many of the last parts of the one before as fit into `overlap` and leave
    room for the part that follows. White space around a piece goes, and empty pieces.
    """

    def fold(lengths: Column) -> Column:
        def begin_after(first: Column, i: Column, held: Column, coming: Column) -> Column:
            def drop(at: Column, length: Column) -> Column:
                over = (at["held"] > overlap) | (at["held"] + coming > size)
                kept = at["held"] - length
                return F.when(over, F.struct((at["first"] + 1).alias("first"), kept.alias("held"))).otherwise(at)

            run = F.slice(lengths, first + 1, i - first)
            return F.aggregate(run, F.struct(first.alias("first"), held.alias("held")), drop)

        def step(state: Column, i: Column) -> Column:
            return T.let(F.get(lengths, i), lambda coming: advance(state, i, coming))

        def advance(state: Column, i: Column, coming: Column) -> Column:
            full = (i > state["first"]) & (state["held"] + coming > size)
            piece = F.struct(state["first"].alias("first"), i.alias("end"))
            after = T.let(
                begin_after(state["first"], i, state["held"], coming),
                lambda at: F.struct(
                    F.array_append(state["pieces"], piece).alias("pieces"),
                    at["first"].alias("first"),
                    (at["held"] + coming).alias("held"),
                ),
            )
            held = (state["held"] + coming).alias("held")
            return F.when(full, after).otherwise(F.struct(state["pieces"], state["first"], held))

        begin = {"first": F.lit(0), "held": F.lit(0)}
        return T.fold_in_blocks(F.size(lengths), begin, step, "pieces", "struct<first:int,end:int>")

    def texts(done: Column) -> Column:
        last = F.struct(done["first"].alias("first"), F.size(parts).alias("end"))
        ranges = F.array_append(F.flatten(done["pieces"]), last)
        joined = F.transform(ranges, lambda r: F.array_join(F.slice(parts, r["first"] + 1, r["end"] - r["first"]), ""))
        return _trimmed(joined)

    none = F.array().cast("array<string>")
    packed = T.let(T.let(F.transform(parts, F.length), fold), texts)
    return F.when(F.size(parts) == 0, none).when(F.size(parts) == 1, _trimmed(parts)).otherwise(packed)


def _trimmed(pieces: Column) -> Column:
    return F.filter(F.transform(pieces, T.strip), lambda piece: piece != "")


def _parts(text: Column, separator: str) -> Column:
    """The text cut before each separator, from the left; each part begins with its own."""
    escaped = F.replace(text, F.lit(_CUT), F.lit(_CUT + "0"))
    marked = F.replace(escaped, F.lit(separator), F.lit(_CUT + "1" + separator))
    parts = F.filter(F.split(marked, _CUT + "1"), lambda part: part != "")
    return F.transform(parts, lambda part: F.replace(part, F.lit(_CUT + "0"), F.lit(_CUT)))


def split_recursive(text: Column, size: int, overlap: int, separators: tuple[str, ...] = SEPARATORS) -> Column:
    """Pieces of up to `size` characters, broken at the first separator that occurs.

    Parts that are still too long are broken at the next one, in the end between characters; runs of
    shorter parts are joined to pieces that overlap. A text that fits is one piece. Array functions
    all the way: each level is one expression, linear in the length of the text.
    """
    none = F.array().cast("array<string>")

    def broken(text: Column, level: int) -> Column:
        if level == len(separators):
            return _trimmed(split_window(text, size, overlap))
        return T.let(_parts(text, separators[level]), lambda parts: runs(parts, level))

    def runs(parts: Column, level: int) -> Column:
        places = F.filter(
            F.transform(parts, lambda part, i: F.when(F.length(part) >= size, i)), lambda i: i.isNotNull()
        )
        return T.let(F.array_append(places, F.size(parts)), lambda ends: between(parts, ends, level))

    def between(parts: Column, ends: Column, level: int) -> Column:
        def one(end: Column, j: Column) -> Column:
            first = F.coalesce(F.get(ends, j - 1), F.lit(-1)) + 1
            short = F.slice(parts, first + 1, end - first)
            long = F.when(end < F.size(parts), broken(F.get(parts, end), level + 1)).otherwise(none)
            return F.concat(T.let(short, lambda run: _packed(run, size, overlap)), long)

        return F.flatten(F.transform(ends, one))

    return F.when(F.length(text) > size, broken(text, 0)).otherwise(F.array(text))


def merge_starts(chunks: Column, merge_below: int, chunk_size: int) -> Column:
    """First positions of the merged chunks (0-based, increasing).

    A chunk joins the one before while both stand under the same h1 and h2, the text so
    far is shorter than `merge_below` and both together are shorter than `chunk_size`.
    Only lengths and positions go through the fold. It runs in blocks of MERGE_BLOCK
    chunks: appending copies an array, so the starts of a block are a list of their own.
    """
    n = F.size(chunks)

    def state_of(starts: Column, length: Column, h1: Column, h2: Column) -> Column:
        return F.struct(starts.alias("starts"), length.alias("length"), h1.alias("h1"), h2.alias("h2"))

    none = F.lit(None).cast("string")
    nowhere, no_blocks = F.array().cast("array<int>"), F.array().cast("array<array<int>>")

    def step(state: Column, i: Column) -> Column:
        return T.let(F.get(chunks, i), lambda chunk: advance(state, i, chunk))

    def advance(state: Column, i: Column, chunk: Column) -> Column:
        size = F.length(chunk["text"])
        joins = (
            state["h1"].eqNullSafe(chunk["h1"])
            & state["h2"].eqNullSafe(chunk["h2"])
            & (state["length"] < merge_below)
            & (state["length"] + size < chunk_size)
        )
        return state_of(
            F.when(joins, state["starts"]).otherwise(F.array_append(state["starts"], i)),
            F.when(joins, state["length"] + 2 + size).otherwise(size),
            chunk["h1"],
            chunk["h2"],
        )

    def block(state: Column, first: Column) -> Column:
        last = F.least(first + (MERGE_BLOCK - 1), n - 1)
        begin = state_of(nowhere, state["length"], state["h1"], state["h2"])
        return T.let(
            F.aggregate(F.sequence(first, last), begin, step),
            lambda done: state_of(
                F.array_append(state["starts"], done["starts"]), done["length"], done["h1"], done["h2"]
            ),
        )

    firsts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(MERGE_BLOCK))).otherwise(nowhere)
    begin = state_of(no_blocks, F.lit(0), none, none)
    return F.flatten(F.aggregate(firsts, begin, block)["starts"])


def merge_small(chunks: Column, starts: Column) -> Column:
    """array<struct<h1,h2,h3,text>> with each run of chunks joined by a blank line.

    A merged chunk keeps the headers of its first part.
    """

    def one(first: Column, j: Column) -> Column:
        end = F.coalesce(F.get(starts, j + 1), F.size(chunks))
        head = F.get(chunks, first)
        body = F.array_join(F.transform(F.slice(chunks, first + 1, end - first), lambda c: c["text"]), "\n\n")
        return F.struct(
            head["h1"].alias("h1"), head["h2"].alias("h2"), head["h3"].alias("h3"), body.alias("text")
        )

    return F.transform(starts, one)


def document_sections(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per section of each document, with the headers in force."""
    ids = keep or [c for c in df.columns if c != text]
    return explode_structs(df, ids, M.sections(F.col(text)), ["section_id", "h1", "h2", "h3", "text"])


def chunk_arrays(df: DataFrame, text: str, settings: ChunkSettings) -> DataFrame:
    """Adds `_chunks`, the merged chunks of each document before the last noise filter.

    Intermediate arrays are bound with `let`: a column that a lambda mentions could be
    inlined into the lambda by the optimizer and then be worked out for every element.
    """

    def quiet(body: Column) -> Column:
        return ~T.is_noise(body, settings.min_chunk_size, settings.max_noise_ratio)

    def with_headers(h1: Column, section: Column, piece: Column) -> Column:
        return F.struct(
            h1.alias("h1"),
            section["h2"].alias("h2"),
            section["h3"].alias("h3"),
            F.concat(T.header_context(h1, section["h2"], section["h3"]), piece).alias("text"),
        )

    def small_chunks(sections: Column, pieces_of) -> Column:
        def of_section(section: Column, i: Column) -> Column:
            return T.let(
                T.strip(T.strip_tags(section["h1"])),
                lambda h1: F.transform(
                    # A section that fits is its own only piece and has been judged already.
                    F.when(
                        F.length(section["text"]) > size, F.filter(pieces_of(section, i), quiet)
                    ).otherwise(F.array(section["text"])),
                    lambda piece: with_headers(h1, section, piece),
                ),
            )

        return F.flatten(F.transform(sections, of_section))

    def merged(small: Column) -> Column:
        return T.let(
            small,
            lambda chunks: T.let(
                merge_starts(chunks, settings.merge_below, settings.chunk_size),
                lambda starts: merge_small(chunks, starts),
            ),
        )

    size, overlap = settings.chunk_size, settings.chunk_overlap
    # The analyzer takes a round for each level of lambdas, so the chain is resolved in steps. Each
    # step names the column of the one before once and outside of lambdas: inlined it is the same work.
    cleaned = df.withColumn("_clean", M.clean_text(F.col(text), settings.markup_in_code))
    found = cleaned.withColumn("_sections", T.let(F.col("_clean"), M.sections))
    sections = F.filter("_sections", lambda s: quiet(s["text"]))
    split = split_window if settings.size_split == "window" else split_recursive
    small = T.let(
        sections, lambda found: small_chunks(found, lambda s, i: split(s["text"], size, overlap))
    )
    return found.withColumn("_chunks", merged(small)).drop("_clean", "_sections")


def chunk_documents(
    df: DataFrame,
    doc_key: str,
    path: str = "path",
    text: str = "text",
    settings: ChunkSettings = ChunkSettings(),
) -> DataFrame:
    """One row per chunk.

    clean, cut into sections, drop noise, split by size, drop noise, add header context,
    merge small neighbours, drop noise, number from 0. A document that is all noise gives
    no row. Narrow from end to end: no shuffle, and documents keep their partitions.
    """
    arrays = chunk_arrays(df.select(doc_key, path, text), text, settings)
    kept = F.filter(
        "_chunks", lambda c: ~T.is_noise(c["text"], settings.min_chunk_size, settings.max_noise_ratio)
    )
    rows = explode_array(arrays, [doc_key, path], kept, "chunk_index", "_chunk")
    doc_id = T.hash_uuid(F.col(doc_key))
    return rows.select(
        F.col("_chunk.text").alias("text"),
        T.repo_name(F.col(path)).alias("source_repo"),
        T.base_name(F.col(path)).alias("source_file"),
        "chunk_index",
        doc_id.alias("doc_id"),
        T.hash_uuid(F.col(doc_key), F.col("chunk_index"), F.col("_chunk.text")).alias("chunk_id"),
        F.col("_chunk.h1").alias("section_h1"),
        F.col("_chunk.h2").alias("section_h2"),
        F.col("_chunk.h3").alias("section_h3"),
    )
