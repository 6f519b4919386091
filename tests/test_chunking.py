import random

from conftest import plan_of
from pyspark.sql import functions as F

from sheafworks.operators import chunking as C

LONG = "Sentence number %d says something useful about the topic at hand. "


def document(rng):
    lines = []
    for section in range(rng.randint(1, 8)):
        lines.append("#" * rng.randint(1, 3) + f" Part {section % 3}")
        for _ in range(rng.randint(0, 4)):
            lines.append("".join(LONG % rng.randint(0, 99) for _ in range(rng.randint(1, 6))))
            lines.append("")
    return "\n".join(lines)


def frame(spark, texts):
    rows = [(i, f"raw/repo{i}_README_20250101_000000.md", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "k int, path string, text string")


def test_window_pieces_cover_and_overlap(value):
    texts = ["", "a" * 800, "b" * 801, "c" * 1500, "d" * 1501, "".join(chr(97 + i % 26) for i in range(5000))]
    texts += ["é😀\n" * 900, "x" * 1400 + "y" * 100, "x" * 1400 + "y" * 101]
    for text, pieces in zip(texts, value(lambda c: C.split_window(c, 800, 100), texts)):
        assert all(len(p) <= 800 for p in pieces)
        assert pieces[0] + "".join(p[100:] for p in pieces[1:]) == text
        assert all(a[-100:] == b[:100] for a, b in zip(pieces, pieces[1:]))
        assert all(len(p) > 100 for p in pieces[1:])


def split_by_hand(text, size, overlap, separators=("\n\n", "\n", " ", "")):
    """The rule of the recursive split, one part after the other."""
    at = next(i for i, s in enumerate(separators) if s == "" or s in text)
    separator, finer = separators[at], separators[at + 1 :]
    if separator:
        head, *tail = text.split(separator)
        parts = [p for p in [head, *(separator + t for t in tail)] if p]
    else:
        parts = list(text)
    pieces, run = [], []

    def flush():
        if piece := "".join(run).strip():
            pieces.append(piece)

    for part in parts:
        if len(part) >= size and finer:
            flush()
            run = []
            pieces += split_by_hand(part, size, overlap, finer)
            continue
        if run and len("".join(run)) + len(part) > size:
            flush()
            while run and (len("".join(run)) > overlap or len("".join(run)) + len(part) > size):
                run = run[1:]
        run.append(part)
    flush()
    return pieces


def recursive(value, texts, size, overlap):
    return value(lambda c: C.split_recursive(c, size, overlap), texts)


def test_recursive_pieces(value):
    # A separator belongs to the part after it and counts towards its length.
    assert recursive(value, ["aa bb cc dd", "ab"], 5, 0) == [["aa bb", "cc", "dd"], ["ab"]]
    assert recursive(value, ["aa bb cc dd"], 6, 3) == [["aa bb", "bb cc", "cc dd"]]
    assert recursive(value, ["one\n\ntwo three", "abcdefghijk"], 10, 0) == [["one", "two three"], ["abcdefghij", "k"]]
    assert recursive(value, ["abcdefgh", ""], 3, 1) == [["abc", "cde", "efg", "gh"], [""]]
    text = document(random.Random(1)) * 3
    (pieces,) = recursive(value, [text], 200, 40)
    assert all(len(p) <= 200 for p in pieces)
    at = 0
    for piece in pieces:  # pieces come in order and skip nothing but white space
        found = text.index(piece, max(0, at - 60))
        assert not text[at:found].strip()
        at = found + len(piece)
    assert not text[at:].strip()


def test_recursive_pieces_of_random_texts(value):
    rng = random.Random(1)
    atoms = ["a", "bb", "ccc", " ", " ", "\n", "\n\n", "\n\n\n", "d" * 28, "\ufdd0", "\ufdd01", "\ufdd00", "é😀", "\t"]
    texts = ["".join(rng.choice(atoms) for _ in range(rng.randint(0, 80))) for _ in range(600)]
    for size, overlap in [(10, 3), (20, 0), (20, 19), (7, 6)]:
        for text, pieces in zip(texts, recursive(value, texts, size, overlap)):
            assert pieces == (split_by_hand(text, size, overlap) if len(text) > size else [text]), text


def test_recursive_pieces_of_long_texts(value):
    texts = ["word " * 60_000, "x" * 300_000, "one line\n" * 30_000, "a b\n\n" * 50_000]
    for text, pieces in zip(texts, recursive(value, texts, 800, 100)):
        assert all(0 < len(p) <= 800 for p in pieces) and len(pieces) >= len(text) // 800


def merged_by_hand(chunks, below, size):
    groups = []
    for chunk in chunks:
        if groups:
            last = groups[-1]
            if last[:2] == list(chunk[:2]) and len(last[2]) < below and len(last[2]) + len(chunk[2]) < size:
                last[2] += "\n\n" + chunk[2]
                continue
        groups.append(list(chunk))
    return groups


def test_merge_fold(spark):
    rng = random.Random(4)
    docs = []
    for k in range(40):
        chunks = [
            (rng.choice("AB"), rng.choice("xy"), "t", "z" * rng.choice([10, 60, 150, 199, 200, 500, 640, 800]))
            for _ in range(rng.randint(0, 12))
        ]
        docs.append((k, [dict(h1=a, h2=b, h3=c, text=t) for a, b, c, t in chunks]))
    df = spark.createDataFrame(docs, "k int, chunks array<struct<h1:string,h2:string,h3:string,text:string>>")
    found = df.select(
        "k", "chunks", C.merge_small(F.col("chunks"), C.merge_starts(F.col("chunks"), 200, 800)).alias("merged")
    )
    for row in found.collect():
        expected = merged_by_hand([(c["h1"], c["h2"], c["text"]) for c in row["chunks"]], 200, 800)
        assert [[m["h1"], m["h2"], m["text"]] for m in row["merged"]] == expected


def test_chunks_are_dense_stable_and_sized(spark):
    rng = random.Random(8)
    texts = [document(rng) for _ in range(30)] + ["tiny", "", "-----\n─────"]
    for mode in ("window", "recursive"):
        settings = C.ChunkSettings(size_split=mode)
        rows = C.chunk_documents(frame(spark, texts), "k", settings=settings).collect()
        again = C.chunk_documents(frame(spark, texts).repartition(5), "k", settings=settings).collect()
        assert sorted(r["chunk_id"] for r in rows) == sorted(r["chunk_id"] for r in again)
        assert len({r["chunk_id"] for r in rows}) == len(rows)
        by_doc = {}
        for r in rows:
            by_doc.setdefault(r["source_repo"], []).append(r["chunk_index"])
        assert all(sorted(v) == list(range(len(v))) for v in by_doc.values())
        # documents of noise only give no row
        assert not {"repo30", "repo31", "repo32"} & set(by_doc)
        for r in rows:
            if r["section_h1"]:
                assert r["text"].startswith("# " + r["section_h1"] + "\n")


def test_chunking_is_narrow(spark):
    df = frame(spark, ["# a\n" + LONG * 3])
    native = plan_of(C.chunk_documents(df, "k", settings=C.ChunkSettings(size_split="window")))
    assert "Exchange" not in native and "Python" not in native
    recursive = plan_of(C.chunk_documents(df, "k"))
    assert "Exchange" not in recursive and "Python" not in recursive


def test_a_very_long_document(spark):
    section = "".join(LONG % i for i in range(40_000))
    many = "\n".join(f"## part {i}\n" + LONG * 2 for i in range(5_000))
    for mode in ("window", "recursive"):
        settings = C.ChunkSettings(size_split=mode)
        rows = C.chunk_documents(frame(spark, [section, many]), "k", settings=settings).collect()
        assert len(rows) > 8_000


def test_merge_fold_goes_over_block_ends(spark):
    from pyspark.sql import functions as F

    from sheafworks.operators import chunking

    def starts(sizes, below, limit):
        out, length = [], None
        for i, size in enumerate(sizes):
            if length is not None and length < below and length + size < limit:
                length += 2 + size
            else:
                out.append(i)
                length = size
        return out

    for n in (0, 1, 255, 256, 257, 3_000):
        sizes = [(i * 37) % 90 + 1 for i in range(n)]
        df = spark.createDataFrame([(["x" * s for s in sizes],)], "t array<string>")
        chunks = F.transform("t", lambda t: F.struct(F.lit("a").alias("h1"), F.lit("b").alias("h2"), t.alias("text")))
        got = df.select(chunking.merge_starts(chunks, 100, 180).alias("s")).first()["s"]
        assert got == starts(sizes, 100, 180)


def test_the_analyzer_has_rounds_to_spare(spark):
    from sheafworks.operators import chunking

    docs = spark.createDataFrame([("p", "# a\n" + "word " * 300)], "path string, text string")
    spark.conf.set("spark.sql.analyzer.maxIterations", "80")
    try:
        assert chunking.chunk_documents(docs, "path").count() > 1
    finally:
        spark.conf.unset("spark.sql.analyzer.maxIterations")
