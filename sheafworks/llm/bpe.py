"""BPE encoding of long texts by tree concatenation, and decoding.

A long text is cut into pieces that are encoded apart, in parallel. Neighbours are then joined
two by two: a window around the join is encoded again, and what it gives replaces the tokens there
once it agrees with the tokens of both sides at its two ends; until then it grows. A join encodes
some text around it, not the whole sides; inside long words of other characters than ASCII letters
and digits the window grows to them.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafworks.session import scratch_path

from .common import slices, text_of, write_once

VOCABULARY = "byte_bpe_50k"
#: Texts above so many code points are cut into pieces.
PIECE_CHARS = 16_384
#: Code points on each side of a join that are encoded again at first.
FIRST_WINDOW = 64
#: Tokens at each end of a window that must equal those of the side it stands in.
AGREE = 4

#: Characters whose class is the same in all Unicode versions the libraries may follow.
_OLD = re.compile("[^\x00-ɏ‐-‧]")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json")


class Encoder:
    """Encodes and decodes with the vocabulary in one tokenizer file (byte-level BPE).

    The fast path is another library with the same merges; texts with characters that not all
    Unicode versions put into the same class go through the file's own library.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.no_truncation()
        self.slow.no_padding()
        self.special = {str(t.content): i for i, t in self.slow.get_added_tokens_decoder().items()}
        letters = _byte_letters()
        self.bytes = [b""] * self.slow.get_vocab_size()
        ranks = {}
        for token, i in self.slow.get_vocab(with_added_tokens=False).items():
            self.bytes[i] = bytes(letters[c] for c in token)
            ranks[self.bytes[i]] = i
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
            ranks.pop(token.encode(), None) if ranks.get(token.encode()) == i else None
        import public_tokenizers

        self.fast = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=self.special
        )
        self.lengths = np.array([len(b) for b in self.bytes])
        self.starts = np.append(0, np.cumsum(self.lengths))
        self.table = np.frombuffer(b"".join(self.bytes), np.uint8)
        # A token that begins inside a character cannot be cut off.
        self.clean = np.array([not b or b[0] & 0xC0 != 0x80 for b in self.bytes])
        self.longest_special = max(map(len, self.special), default=0)

    def encode(self, text: str) -> np.ndarray:
        if text.isascii() or not _OLD.search(text):
            return self.fast.encode_to_numpy(text, allowed_special="all", disallowed_special=())
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens one after the other."""
        count = self.lengths[ids]
        begin = np.cumsum(count) - count
        at = np.arange(int(count.sum())) + np.repeat(self.starts[ids] - begin, count)
        return self.table[at].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def near_special(self, text: str, at: int) -> bool:
        """Is a special token's text across or beside a place?"""
        around = text[max(0, at - self.longest_special) : at + self.longest_special]
        return any(s in around for s in self.special)


def encoder(path: str) -> Encoder:
    """One encoder for each file and worker process."""
    held = sys.__dict__.setdefault("_sheafworks_encoders", {})
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


def _byte_letters() -> dict[str, int]:
    """Byte-level BPE writes each byte as a letter: printable ones as themselves, others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _kind(c: str) -> str:
    if c.isspace():
        return "space"
    if c.isalpha():
        return "letter"
    if c.isnumeric():
        return "number"
    return "other"


def _sure(text: str, at: int) -> bool:
    """Do words always end here, whatever comes before and after?

    Between characters of two kinds they do, but a space goes with what follows and an
    apostrophe may.
    """
    before, after = text[at - 1], text[at]
    if ord(before) > 127 or ord(after) > 127:  # leave kinds to where all agree
        return not before.isspace() and after in " \n"
    return before != "'" and not before.isspace() and _kind(before) != _kind(after)


class Node:
    """A text with its tokens."""

    def __init__(self, text: str, ids: np.ndarray):
        self.text, self.ids = text, ids


def join(coder: Encoder, left: Node, right: Node, window: int = FIRST_WINDOW) -> Node:
    """The node of both texts together: exactly what encoding them as one would give."""
    text = left.text + right.text
    if not left.text or not right.text:
        return Node(text, np.concatenate([left.ids, right.ids]))
    middle = len(left.text)
    ends_l, ends_r = np.cumsum(coder.lengths[left.ids]), np.cumsum(coder.lengths[right.ids])
    starts_l, starts_r = np.append(0, ends_l[:-1]), np.append(0, ends_r[:-1])
    bytes_l = int(ends_l[-1])
    reach = window
    while True:
        a = _left_cut(coder, text, middle, reach)
        b = _right_cut(coder, text, middle, reach)
        if a is not None and b is not None:
            # Both ends are sure ends of words: the window's tokens stand for themselves.
            i = int(np.searchsorted(starts_l, bytes_l - len(text[a:middle].encode())))
            j = int(np.searchsorted(starts_r, len(text[middle:b].encode())))
            return Node(text, np.concatenate([left.ids[:i], coder.encode(text[a:b]), right.ids[j:]]))
        joined = _inside_words(coder, text, left, right, a, b, reach, starts_l, starts_r)
        if joined is not None:
            return Node(text, joined)
        reach *= 2


def _left_cut(coder: Encoder, text: str, middle: int, reach: int) -> int | None:
    """A sure word end in the outer half of the window, or the start of the text."""
    if middle <= reach:
        return 0
    for at in range(middle - reach // 2, middle - reach, -1):
        if _sure(text, at) and not coder.near_special(text, at):
            return at
    return None


def _right_cut(coder: Encoder, text: str, middle: int, reach: int) -> int | None:
    if len(text) - middle <= reach:
        return len(text)
    for at in range(middle + reach // 2, middle + reach):
        if _sure(text, at) and not coder.near_special(text, at):
            return at
    return None


def _inside_words(coder, text, left, right, a, b, reach, starts_l, starts_r) -> np.ndarray | None:
    """The join where one side is inside a long word: cut it at a token, and see that tokens agree.

    Tokens of a word are right if every two neighbours are; so a window that begins and ends with
    the tokens the sides have there fits them.
    """
    middle = len(left.text)
    if reach < 4 * FIRST_WINDOW:
        return None  # words of usual length end inside a larger window
    if a is None:
        run = text[middle - reach : middle - reach // 2]
        if not _plain_run(run):
            return None
        i = int(np.searchsorted(starts_l, starts_l[-1] - reach // 2))
        i = _clean_token(coder, left.ids, i)
        before = coder.decode_bytes(left.ids[i:])
    else:
        before = text[a:middle].encode()
        i = int(np.searchsorted(starts_l, starts_l[-1] + coder.lengths[left.ids[-1]] - len(before)))
    if b is None:
        if not _plain_run(text[middle + reach // 2 : middle + reach]):
            return None
        j = int(np.searchsorted(starts_r, reach // 2))
        j = _clean_token(coder, right.ids, j)
        after = coder.decode_bytes(right.ids[:j])
    else:
        after = text[middle:b].encode()
        j = int(np.searchsorted(starts_r, len(after)))
    new = coder.encode((before + after).decode())
    if len(new) < 2 * AGREE:
        return None
    if a is None and not np.array_equal(new[:AGREE], left.ids[i : i + AGREE]):
        return None
    if b is None and (j < AGREE or not np.array_equal(new[-AGREE:], right.ids[j - AGREE : j])):
        return None
    return np.concatenate([left.ids[:i], new, right.ids[j:]])


def _plain_run(run: str) -> bool:
    """One kind of ASCII letters or digits all along: certainly inside one word."""
    return bool(run) and run.isascii() and (run.isalpha() or run.isdigit())


def _clean_token(coder: Encoder, ids: np.ndarray, at: int) -> int:
    while 0 < at < len(ids) and not coder.clean[ids[at]]:
        at -= 1
    return at


def tree_join(coder: Encoder, nodes: list[Node], window: int = FIRST_WINDOW) -> Node:
    """Joins neighbours level by level."""
    while len(nodes) > 1:
        pairs = [join(coder, *nodes[i : i + 2], window) for i in range(0, len(nodes) - 1, 2)]
        nodes = pairs + nodes[len(pairs) * 2 :]
    return nodes[0] if nodes else Node("", np.empty(0, np.uint32))


def piece_ranges(text: str, piece_chars: int) -> list[str]:
    return [text[i : i + piece_chars] for i in range(0, len(text), piece_chars)]


def encode_long(coder: Encoder, text: str, piece_chars: int = PIECE_CHARS, window: int = FIRST_WINDOW) -> np.ndarray:
    """The tree on one text in one process."""
    pieces = [Node(p, coder.encode(p)) for p in piece_ranges(text, piece_chars)]
    return tree_join(coder, pieces, window).ids


Consume = Callable[[Encoder, str, np.ndarray], tuple]


def _encode_whole(path: str, consume: Consume, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for part in slices(batches):
            rows = [consume(coder, t, coder.encode(t)) for t in part.column("text").to_pylist()]
            yield _with_columns(part.drop_columns(["text"]), rows, names)

    return run


def _with_columns(part: pa.RecordBatch, rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays(
        [*part.columns, *(pa.array(c) for c in columns)], [*part.schema.names, *names]
    )


def _encode_pieces(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for part in slices(batches):
            ids = [coder.encode(t).tobytes() for t in part.column("text").to_pylist()]
            yield part.append_column("ids", pa.array(ids, pa.binary()))

    return run


def _join_pieces(path: str, window: int, consume: Consume, names: list[str], keys: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            for row in range(batch.num_rows):  # one long text at a time
                part = batch.slice(row, 1)
                pieces = sorted(part.column("pieces")[0].as_py(), key=lambda p: p["piece"])
                nodes = [Node(p["text"], np.frombuffer(p["ids"], np.uint32)) for p in pieces]
                whole = tree_join(coder, nodes, window)
                yield _with_columns(part.select(keys), [consume(coder, whole.text, whole.ids)], names)

    return run


def encode_documents(
    documents: DataFrame,
    path: str,
    consume: Consume,
    schema: str,
    piece_chars: int = PIECE_CHARS,
    window: int = FIRST_WINDOW,
) -> DataFrame:
    """doc_id and what `consume(encoder, text, ids)` makes of each whole text, as columns of `schema`.

    `documents` has doc_id and text. Texts of up to `piece_chars` code points are encoded where
    they are read. Longer ones are cut into pieces that are dealt out to all tasks and encoded
    there; the pieces of a text (one row of the input, so of bounded size) then meet for the joins,
    which encode no more than windows. A null text is read as empty. Rows with the same id and
    text give equal rows, as many as there are.
    """
    kind = dict(documents.dtypes)["doc_id"]
    names = [c.split()[0] for c in schema.split(", ")]
    texts = documents.select("doc_id", text_of().alias("text"))
    short = texts.where(F.length("text") <= piece_chars)
    done = short.mapInArrow(_encode_whole(path, consume, names), f"doc_id {kind}, {schema}")
    count = F.ceil(F.length("text") / piece_chars).cast("int")
    long = texts.where(F.length("text") > piece_chars)
    cut = long.select("doc_id", "text", F.monotonically_increasing_id().alias("row"), count.alias("count"))
    cut = cut.select("doc_id", "row", "text", F.explode(F.sequence(F.lit(0), F.col("count") - 1)).alias("piece"))
    piece = F.substring("text", F.col("piece") * piece_chars + 1, F.lit(piece_chars))
    cut = cut.select("doc_id", "row", "piece", piece.alias("text"))
    # The row number only has to hold from here on: the table is written once.
    cut = write_once(cut, scratch_path(documents.sparkSession, "pieces"))
    dealt = cut.repartition("row", "piece")
    encoded = dealt.mapInArrow(_encode_pieces(path), f"{_ddl(cut)}, ids binary")
    piece = F.struct("piece", "text", "ids")
    whole = encoded.groupBy("doc_id", "row").agg(F.collect_list(piece).alias("pieces"))
    joined = whole.select("doc_id", "pieces").mapInArrow(
        _join_pieces(path, window, consume, names, ["doc_id"]), f"doc_id {kind}, {schema}"
    )
    return done.union(joined)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)


def digests(coder: Encoder, text: str, ids: np.ndarray) -> tuple[int, str, str]:
    """(n_tokens, ids_sha256, decoded_sha256)."""
    from hashlib import sha256

    decoded = coder.decode(ids).encode()
    return len(ids), sha256(ids.astype("<u4").tobytes()).hexdigest(), sha256(decoded).hexdigest()


DIGEST_SCHEMA = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def token_ids(coder: Encoder, text: str, ids: np.ndarray) -> tuple[list[int], str]:
    """(ids, decoded): the tokens themselves and the text they stand for."""
    return ids.tolist(), coder.decode(ids)


IDS_SCHEMA = "ids array<long>, decoded string"


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """Adds `decoded` to a table with a column ids (array of token ids; null gives null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            texts = [None if x is None else coder.decode(np.array(x, np.int64)) for x in ids]
            yield batch.append_column("decoded", pa.array(texts, pa.string()))

    return encoded.mapInArrow(run, f"{_ddl(encoded)}, decoded string")
