"""One query per operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import markdown as M
from ..functions import text as T
from ..operators import chat, chunking, combine, profile, sampling, search, vector_table, versions
from ..operators.embedding import embed
from ..operators.rows import explode_array, explode_structs
from ..session import scratch_path
from ..sources import files, idx, readers, writers
from ..streaming import ingest as stream
from . import datasets, shapes

Query = Callable[[SparkSession, str], DataFrame]

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
WINDOW = chunking.ChunkSettings(size_split="window")
LINEAGE = vector_table.Lineage("documents-v1.0.0", "hashing-384", "sha-1", "run-1")


def _rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- tables and statistics -------------------------------------------------------------


def union_tagged_sources(spark, sf):
    def source(name: str, prefix: str) -> DataFrame:
        names = {f"{prefix}_name": "name", f"{prefix}_nationkey": "nationkey", f"{prefix}_acctbal": "acctbal"}
        return combine.normalize_schema(shapes.table(spark, sf, name), names)

    return combine.union_tagged({0: source("customer", "c"), 1: source("supplier", "s")}, "source_type")


def feature_stats(spark, sf):
    # Seven digits: with two decimals and 60,000 rows six would put means on exact ties.
    stats = profile.feature_stats(shapes.lineitem(spark, sf), FEATURES)
    return _rounded(stats, ["mean", "std", "min", "max", "median"], 7)


def target_stats(spark, sf):
    stats = profile.describe_counts(shapes.table(spark, sf, "lineitem"), [], ["l_linenumber"])
    return _rounded(stats.withColumnRenamed("metric", "target"), ["mean", "std", "median"])


def schema_profile(spark, sf):
    return profile.schema_profile(shapes.table(spark, sf, "part"), ["p_size", "p_retailprice"])


def standardize_features(spark, sf):
    lines = shapes.lineitem(spark, sf)
    scaled = profile.standardize(lines, FEATURES, profile.moments(lines, FEATURES))
    return _rounded(scaled.select("l_orderkey", "l_linenumber", "l_partkey", *FEATURES), FEATURES, 4)


def value_counts_by_key(spark, sf):
    return profile.value_counts(shapes.table(spark, sf, "documents"), "lang")


def value_counts_by_freq(spark, sf):
    return profile.value_counts(shapes.table(spark, sf, "documents"), "source", by="frequency")


def label_decode_counts(spark, sf):
    counts = profile.value_counts(shapes.table(spark, sf, "embeddings"), "label")
    return counts.select(combine.decode("label", dict(enumerate(shapes.CLASS_NAMES))).alias("class_name"), "n")


def dense_histogram(spark, sf):
    return profile.dense_histogram(
        shapes.table(spark, sf, "embeddings"), "label", shapes.classes(spark), "class_id", "class_name"
    )


def normalize_schema(spark, sf):
    return combine.normalize_schema(shapes.table(spark, sf, "documents"), {"text": "text", "lang": "label"})


def text_stats_by_split(spark, sf):
    split = sampling.split_shuffled(shapes.documents(spark, sf), "doc_id", 0.8)
    return _rounded(datasets.text_length_stats(split), ["mean", "std", "median"])


def corpus_stats(spark, sf):
    return profile.corpus_stats(shapes.documents(spark, sf), "text")


def distinct_sources(spark, sf):
    names = shapes.table(spark, sf, "documents").select(T.repo_name(shapes.file_path()).alias("repo")).distinct()
    return names.agg(
        F.count(F.lit(1)).alias("total_repositories"),
        F.array_join(F.sort_array(F.collect_list("repo")), ",").alias("repository_names"),
    )


def distinct_labels_union(spark, sf):
    split = sampling.split_shuffled(shapes.table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 0.8)
    train, val = (split.where(F.col("split") == name).select("lang") for name in ("train", "val"))
    labels = train.union(val).distinct()
    return labels.agg(F.array_join(F.sort_array(F.collect_list("lang")), ",").alias("classes"))


def metadata_json(spark, sf):
    docs = combine.normalize_schema(
        shapes.documents(spark, sf), {"doc_id": "doc_id", "text": "text", "lang": "label"}
    )
    split = sampling.split_shuffled(docs, "doc_id", 0.8)
    path = scratch_path(spark, "metadata")
    writers.write_metadata(datasets.text_label_metadata(split, "documents", "test tables"), path)
    schema = (
        "splits map<string, struct<num_samples: bigint, label_distribution: map<string, bigint>>>, "
        "metrics map<string, struct<char_length_max: bigint, word_count_min: bigint, char_length_mean: double>>"
    )
    parsed = readers.read_json_array(spark, path, schema)
    rows = parsed.select(F.explode("splits").alias("split", "s"), "metrics")
    found = F.element_at("metrics", F.col("split"))
    labels = F.array_join(
        F.transform(
            F.array_sort(F.map_entries("s.label_distribution")),
            lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")),
        ),
        ",",
    )
    return rows.select(
        "split",
        F.col("s.num_samples").alias("num_samples"),
        labels.alias("label_distribution"),
        found["char_length_max"].alias("char_length_max"),
        found["word_count_min"].alias("word_count_min"),
        F.round(found["char_length_mean"], 6).alias("char_length_mean"),
    )


def _parts(document: DataFrame, **paths: str) -> DataFrame:
    """Values of a metadata document by JSON path."""
    return document.select(*(F.get_json_object("metadata", path).alias(name) for name, path in paths.items()))


def table_metadata(spark, sf):
    table = union_tagged_sources(spark, sf).drop("name")
    names = {0: "customer", 1: "supplier"}
    document = datasets.table_metadata(table, "accounts", "test tables", "nationkey", "source_type", names)
    found = _parts(
        document,
        num_samples="$.summary.num_samples",
        num_features="$.summary.num_features",
        customers="$.summary.source_type_distribution.customer",
        suppliers="$.summary.source_type_distribution.supplier",
        nation_7="$.summary.nationkey_distribution.7",
        target_min="$.schema.target.range[0]",
        target_max="$.schema.target.range[1]",
        median="$.statistics.features.acctbal.median",
    )
    whole = [c for c in found.columns if c != "median"]
    return found.select(*(F.col(c).cast("bigint").alias(c) for c in whole), F.round(F.col("median").cast("double"), 6).alias("median"))


def tensor_metadata(spark, sf):
    """Vectors as 8x8 byte images: shape, dense class counts and pixel statistics per split."""
    pixels = F.transform("embedding", lambda x: (F.floor(x.cast("double") * 127) + 128).cast("smallint"))
    image = T.let(pixels, lambda p: F.transform(F.sequence(F.lit(0), F.lit(7)), lambda r: F.slice(p, r * 8 + 1, F.lit(8))))
    rows = shapes.table(spark, sf, "embeddings").select("vec_id", image.alias("image"), "label")
    split = sampling.split_shuffled(rows, "vec_id", 0.8)
    document = datasets.tensor_metadata(split, "vectors", "test tables", list(shapes.CLASS_NAMES))
    rows = []
    for name in ("train", "val"):
        found = _parts(
            document,
            rows="$.schema.shape[0]",
            num_samples=f"$.splits.{name}.num_samples",
            three=f"$.splits.{name}.class_distribution.three",
            eleven=f"$.splits.{name}.class_distribution.eleven",
            mean=f"$.metrics.{name}.pixel_mean",
            std=f"$.metrics.{name}.pixel_std",
            median=f"$.metrics.{name}.pixel_median",
        )
        whole = ("rows", "num_samples", "three", "eleven")
        rows.append(
            found.select(
                F.lit(name).alias("split"),
                *(F.col(c).cast("bigint").alias(c) for c in whole),
                *(F.round(F.col(c).cast("double"), 8).alias(c) for c in ("mean", "std", "median")),
            )
        )
    return rows[0].unionByName(rows[1])


def caption_metadata(spark, sf):
    prompt = chat.select_prompt(shapes.prompts(spark), shapes.PROMPT_NAME, 3)
    images = shapes.images(spark, sf)
    rows = datasets.caption_chat(shapes.captions(spark, sf), images, prompt, "doc_id", "radiology")
    sizes = rows.select("image", "width", "height")
    document = datasets.caption_metadata(rows.drop("width", "height"), sizes, prompt, "captions", "test tables")
    out = []
    for name in ("train", "test"):
        found = _parts(
            document,
            prompt_version="$.prompt.prompt_version",
            num_samples=f"$.splits.{name}.num_samples",
            caption_length_mean=f"$.metrics.{name}.caption_length_mean",
            caption_length_max=f"$.metrics.{name}.caption_length_max",
            image_width_mean=f"$.metrics.{name}.image_width_mean",
        )
        whole = ("prompt_version", "num_samples", "caption_length_max")
        out.append(
            found.select(
                F.lit(name).alias("split"),
                *(F.col(c).cast("bigint" if c in whole else "double").alias(c) for c in found.columns),
            )
        )
    return out[0].unionByName(out[1])


def corpus_metadata(spark, sf):
    found = _parts(
        datasets.corpus_metadata(shapes.markdown(spark, sf), LINEAGE, WINDOW),
        source_data_version="$.source_data_version",
        chunk_size="$.chunk_size",
        total_files="$.statistics.total_files",
        total_repositories="$.statistics.total_repositories",
        total_size_bytes="$.statistics.total_size_bytes",
        average_lines="$.statistics.average_lines",
    )
    kinds = {"source_data_version": "string", "average_lines": "double"}
    return found.select(*(F.col(c).cast(kinds.get(c, "bigint")).alias(c) for c in found.columns))


def array_scale_stats(spark, sf):
    split = sampling.split_shuffled(shapes.table(spark, sf, "embeddings"), "vec_id", 0.8)
    stats = profile.array_stats(split, profile.scale_elements("embedding", 255.0), ["split"])
    return _rounded(stats, ["mean", "std", "min", "max", "median"], 10)


def tensor_shape_profile(spark, sf):
    return profile.tensor_shape(shapes.table(spark, sf, "embeddings"), "embedding")


def tensor_from_bytes(spark, sf):
    """Vectors as 8x8 byte images in IDX files of 256 rows, then decoded and paired again."""
    vectors = shapes.table(spark, sf, "embeddings")
    pixel = F.transform("embedding", lambda x: F.floor(x.cast("double") * 127).cast("int") + 128)
    pixels = F.array_join(F.transform(pixel, lambda p: F.lpad(F.hex(p.cast("bigint")), 2, "0")), "")
    rows = vectors.select(
        F.floor(F.col("vec_id") / 256).alias("shard"),
        "vec_id",
        pixels.alias("pixels"),
        F.lpad(F.hex(F.col("label").cast("bigint")), 2, "0").alias("label"),
    )
    files = rows.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(F.struct("vec_id", "pixels", "label"))).alias("rows")
    )
    count = F.lpad(F.hex("n"), 8, "0")

    def file(kind: str, header, field: str) -> DataFrame:
        body = F.array_join(F.transform("rows", lambda r: r[field]), "")
        path = F.concat(F.lit("shard"), F.col("shard").cast("string"), F.lit(f"-{kind}-idx-ubyte"))
        content = F.unhex(F.concat(*header, body))
        return files.select(path.alias("path"), F.octet_length(content).alias("length"), content.alias("content"))

    images = file("images", [F.lit("00000803"), count, F.lit("0000000800000008")], "pixels")
    labels = file("labels", [F.lit("00000801"), count], "label")
    paired = idx.pair_files(images, labels)
    shard = F.regexp_extract("shard", r"(\d+)", 1).cast("bigint")
    return paired.select(
        (shard * 256 + F.col("idx")).alias("vec_id"),
        F.array_join(F.flatten("image").cast("array<string>"), ",").alias("pixels"),
        F.size("image").alias("rows"),
        F.col("label").cast("int").alias("label"),
    )


# --- scans and sinks -------------------------------------------------------------------


def scan_parquet(spark, sf):
    path = scratch_path(spark, "part")
    writers.write_parquet(shapes.table(spark, sf, "part"), path)
    return readers.read_parquet(spark, path)


def scan_csv_roundtrip(spark, sf):
    docs = shapes.table(spark, sf, "documents")
    first, second = scratch_path(spark, "semicolon"), scratch_path(spark, "comma")
    writers.write_csv(docs, first, sep=";")
    writers.write_csv(readers.read_csv(spark, first, docs.schema, sep=";", multi_line=True), second)
    return readers.read_csv(spark, second, docs.schema, multi_line=True)


def scan_json_roundtrip(spark, sf):
    split = _chat_rows(spark, sf)
    path = scratch_path(spark, "chat")
    writers.write_json_splits(split.select("split", "image", "conversations"), path)
    back = readers.read_json_lines(spark, path, f"{readers.CHAT_SCHEMA}, split string")
    return back.select(
        "split",
        "image",
        F.get("conversations", F.lit(0))["value"].alias("question"),
        chat.answer_of(F.col("conversations")).alias("answer"),
    )


def split_write_readback(spark, sf):
    split = sampling.split_shuffled(shapes.table(spark, sf, "documents"), "doc_id", 0.8)
    path = scratch_path(spark, "splits")
    writers.write_splits(split, path)
    back = readers.read_parquet(spark, path)
    return back.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids"), F.sum(F.length("text")).alias("chars")
    )


def scan_text_wholefile(spark, sf):
    path = scratch_path(spark, "texts")
    writers.write_text_documents(shapes.table(spark, sf, "documents"), path, "source", rows_per_file=1_000)
    files = readers.read_text_files(spark, path, ".txt")
    source = F.regexp_extract("path", r"/source=([^/]+)/", 1)
    return files.groupBy(source.alias("source")).agg(
        F.sum(T.char_count(F.col("text"))).alias("chars"),
        F.sum(T.byte_count(F.col("text"))).alias("bytes"),
        F.sum(T.line_count(F.col("text"))).alias("lines"),
    )


def entity_files(spark, sf):
    """One file for each entity; the markdown files among them read back whole."""
    path = scratch_path(spark, "entities")
    rows = shapes.supplier_files(spark, sf)
    files.write_files(rows, path, F.col("name"), F.col("text"))
    back = readers.read_text_files(spark, path, ".md")
    return back.select(
        T.base_name(F.col("path")).alias("file"),
        F.regexp_extract("path", r"/(n\d+)/[^/]+$", 1).alias("folder"),
        "text",
        T.byte_count(F.col("text")).alias("bytes"),
        T.line_count(F.col("text")).alias("lines"),
    )


def scan_permissive_rejects(spark, sf):
    """Events as JSON lines, each third one cut off in the middle, read without failing."""
    events = shapes.table(spark, sf, "events")
    line = F.to_json(F.struct("event_id", "event_type", "value"))
    broken = F.col("event_id") % 3 == 0
    path = scratch_path(spark, "events")
    events.select(F.when(broken, F.substring(line, 1, 20)).otherwise(line).alias("value")).write.text(path)
    read = readers.read_json_tolerant(spark, path, "event_id bigint, event_type string, value double")
    return read.groupBy(readers.rejects(read).alias("rejected")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(~readers.rejects(read), F.col("event_id"))).alias("ids"),
    )


def eval_questions_scan(spark, sf):
    items = shapes.table(spark, sf, "benchmark")
    path = scratch_path(spark, "questions")
    writers.write_csv(
        items.select(
            F.col("text").alias("question"),
            F.format_string("item %d", "item_id").alias("expected_answer"),
            F.substring_index("text", " ", 3).alias("key_concepts"),
        ),
        path,
    )
    return readers.read_questions(spark, path)


# --- samples and splits ----------------------------------------------------------------


def sample_exact_floor(spark, sf):
    docs = shapes.table(spark, sf, "documents").select("doc_id", "lang")
    return sampling.sample_exact(docs, "doc_id", 0.6)


def sample_exact_round(spark, sf):
    return sampling.sample_exact(shapes.table(spark, sf, "labels"), "doc_id", 0.5, rounding="round")


def sample_tensor_rows(spark, sf):
    rows = sampling.sample_exact(shapes.table(spark, sf, "embeddings"), "vec_id", 0.6)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return rows.select("vec_id", "label", F.round(total, 6).alias("total"))


def split_shuffled(spark, sf):
    docs = shapes.table(spark, sf, "documents").select("doc_id")
    return sampling.split_shuffled(docs, "doc_id", 0.8)


def split_by_position(spark, sf):
    docs = shapes.table(spark, sf, "documents").select("doc_id", shapes.file_path().alias("path"))
    return sampling.split_by_order(docs, "path", 0.8)


def global_row_index(spark, sf):
    docs = shapes.table(spark, sf, "documents").select("doc_id", shapes.file_path().alias("path"))
    placed = sampling.global_row_index(docs, "path")
    return placed.withColumn("image", F.format_string("image_%06d.jpg", "position"))


def first_n(spark, sf):
    docs = shapes.table(spark, sf, "documents").select("doc_id", shapes.file_path().alias("path"))
    return sampling.first_n(docs, "path", 500)


def split_counts(spark, sf):
    docs = shapes.table(spark, sf, "documents").select("doc_id", "lang")
    split = sampling.split_by_order(docs, "doc_id", 0.8)
    return chat.split_summary(split, 0.8).withColumn("num_features", F.lit(len(docs.columns)))


# --- text ------------------------------------------------------------------------------


def strip_markup(spark, sf):
    pages = readers.spread(shapes.table(spark, sf, "pages"), "page_id")
    return pages.select("page_id", T.strip_markup(F.col("html")).alias("text"))


def code_fence_state(spark, sf):
    lines = explode_array(
        shapes.markdown(spark, sf), ["doc_id"], M.fenced_lines(F.col("text")), "line_no", "_line"
    )
    return lines.select("doc_id", "line_no", F.col("_line.in_code").alias("in_code"), F.col("_line.is_fence").alias("is_fence"))


def clean_lines(spark, sf):
    """Each line after markup removal: is it kept, and in which form."""
    docs = shapes.markdown(spark, sf)
    source = M.fenced_lines(T.strip_markup(F.col("text")))
    lines = explode_array(docs, ["doc_id"], source, "line_no", "_line")
    line = F.col("_line.line")
    as_is = F.col("_line.is_fence") | F.col("_line.in_code")
    judged = lines.withColumn("kept", as_is | ~T.is_dropped_line(line))
    shown = F.when(as_is, T.rstrip(line)).when(F.col("kept"), T.tidy_line(line)).otherwise("")
    return judged.select("doc_id", "line_no", "kept", shown.alias("line"))


def clean_text(spark, sf):
    return shapes.markdown(spark, sf).select("doc_id", M.clean_text(F.col("text")).alias("text"))


def noise_flags(spark, sf):
    """Every noise reason for every line of the documents."""
    lines = explode_array(
        shapes.markdown(spark, sf), ["doc_id"], F.split("text", "\n"), "line_no", "line"
    )
    reasons = T.noise_reasons(F.col("line"))
    return lines.select(
        "doc_id",
        "line_no",
        *(flag.alias(name) for name, flag in reasons.items()),
        T.is_noise(F.col("line")).alias("is_noise"),
    )


def markdown_sections(spark, sf):
    docs = shapes.markdown(spark, sf).select("doc_id", M.clean_text(F.col("text")).alias("text"))
    return chunking.document_sections(docs)


def header_splitter(spark, sf):
    """Sections of uncleaned documents with every kind of fence and header line."""
    return chunking.document_sections(shapes.rough_markdown(spark, sf))


def split_by_size(spark, sf):
    docs = shapes.documents(spark, sf)
    pieces = chunking.split_window(F.col("text"), 800, 100)
    return explode_array(docs, ["doc_id"], pieces, "piece_no", "piece")


def chunk_reindex(spark, sf):
    """Sections without noise, numbered from 0 within their document."""
    docs = shapes.markdown(spark, sf)
    sections = F.filter(T.let(M.clean_text(F.col("text")), M.sections), lambda s: ~T.is_noise(s["text"]))
    rows = explode_array(docs, ["doc_id"], sections, "chunk_index", "_section")
    return rows.select("doc_id", F.col("_section.section_id").alias("section_id"), "chunk_index")


def merge_small_chunks(spark, sf):
    """Sections merged by the small-chunk rule, without the other steps."""
    docs = shapes.markdown(spark, sf)
    merged = T.let(
        T.let(M.clean_text(F.col("text")), M.sections),
        lambda s: T.let(chunking.merge_starts(s, 200, 800), lambda starts: chunking.merge_small(s, starts)),
    )
    rows = explode_array(docs, ["doc_id"], merged, "chunk_index", "_chunk")
    return rows.select("doc_id", "chunk_index", F.col("_chunk.h1").alias("h1"), F.col("_chunk.text").alias("text"))


def chunk_documents(spark, sf):
    return chunking.chunk_documents(shapes.markdown(spark, sf), "doc_id", settings=WINDOW)


def chunk_documents_recursive(spark, sf):
    return chunking.chunk_documents(shapes.markdown(spark, sf), "doc_id")


# --- chat rows and images --------------------------------------------------------------


def _chat_rows(spark, sf) -> DataFrame:
    prompt = chat.select_prompt(shapes.prompts(spark), shapes.PROMPT_NAME, 3)
    split = sampling.split_by_order(shapes.captions(spark, sf), "doc_id", 0.8)
    return chat.chat_format(split, prompt)


def chat_format(spark, sf):
    rows = _chat_rows(spark, sf)
    turn = [F.get("conversations", F.lit(i)) for i in (0, 1)]
    return rows.select(
        "image",
        "split",
        turn[0]["from"].alias("from_0"),
        turn[0]["value"].alias("value_0"),
        turn[1]["from"].alias("from_1"),
        turn[1]["value"].alias("value_1"),
        "prompt_uri",
        "prompt_version",
    )


def caption_stats(spark, sf):
    return chat.caption_stats(_chat_rows(spark, sf))


def caption_image_join(spark, sf):
    """Captions with their image under its new name in its split folder."""
    placed = sampling.global_row_index(shapes.captions(spark, sf), "doc_id")
    split = sampling.split_by_order(placed, "doc_id", 0.8)
    joined = chat.join_images(split, shapes.images(spark, sf))
    name = chat.split_image_name(F.col("split"), F.col("position"), "radiology")
    return joined.select("image", "split", name.alias("new_image"), F.md5("content").alias("content_md5"))


def existing_image_semi(spark, sf):
    captions, images = shapes.captions(spark, sf), shapes.images(spark, sf)
    found = chat.with_existing_image(captions, images).select("image", F.lit(True).alias("exists"))
    return found.union(chat.missing_images(captions, images).select("image", F.lit(False)))


def image_dims_avg(spark, sf):
    captions = shapes.table(spark, sf, "documents").select("doc_id", shapes.image_name().alias("image"))
    split = sampling.split_by_order(captions, "doc_id", 0.8)
    return chat.image_size_means(split, shapes.images(spark, sf), order="doc_id")


def image_files(spark, sf):
    """Image files copied into split folders; per split their number and sizes, read back from headers.

    Also files that are no image: they are copied, and listed as unread.
    """
    annotations = shapes.table(spark, sf, "supplier").select(
        "s_suppkey", F.format_string("image_%06d.png", "s_suppkey").alias("image")
    )
    split = sampling.split_by_order(annotations, "s_suppkey", 0.8)
    path = scratch_path(spark, "image-files")
    files.copy_files(split, shapes.png_files(spark, sf), path)
    sizes = readers.read_image_sizes(spark, path, "*.png")
    folder = F.element_at(F.split("path", "/"), -2).alias("split")
    good = sizes.groupBy(folder).agg(
        F.count(F.lit(1)).alias("num_images"),
        F.round(F.avg("width"), 2).alias("width_mean"),
        F.round(F.avg("height"), 2).alias("height_mean"),
        F.max("width").alias("width_max"),
    )
    bad = readers.unread_files(spark, path, sizes, "*.png").groupBy(folder).agg(F.count(F.lit(1)).alias("num_unread"))
    counts = {c: F.coalesce(c, F.lit(0)) for c in ("num_images", "num_unread")}
    return good.join(bad, "split", "full").withColumns(counts)


# --- vectors ---------------------------------------------------------------------------


def embed_hashing(spark, sf):
    rows = embed(shapes.documents(spark, sf).select("doc_id", "text"))
    return rows.select(
        "doc_id", F.size("embeddings").alias("dim"), shapes.vector_checksum(F.col("embeddings")).alias("vector")
    )


def vector_table_write(spark, sf):
    rows = vector_table.stored_rows(embed(chunk_documents(spark, sf)), LINEAGE)
    path = scratch_path(spark, "vectors")
    vector_table.write_vector_table(rows, path)
    stored = readers.read_parquet(spark, path)
    return stored.select(
        "id",
        "content",
        F.col("metadata.source_repo").alias("source_repo"),
        F.col("metadata.chunk_index").alias("chunk_index"),
        F.col("metadata.section_h2").alias("section_h2"),
        F.col("metadata.dvc_data_version").alias("data_version"),
        shapes.vector_checksum(F.col("embedding")).alias("vector"),
        F.col("created_at").isNotNull().alias("has_created_at"),
    )


def vector_topk_cosine(spark, sf):
    vectors = shapes.table(spark, sf, "embeddings")
    return search.topk_cosine(vectors, vectors, 5, "vec_id", "vec_id", skip_same=True)


def question_search(spark, sf):
    docs = embed(shapes.documents(spark, sf).select("doc_id", "text"))
    questions = embed(shapes.table(spark, sf, "benchmark"))
    return search.topk_cosine(docs, questions, 5, "doc_id", "item_id", "embeddings", "embeddings")


def retrieval_recall_by_version(spark, sf):
    vectors = shapes.table(spark, sf, "embeddings")
    path = scratch_path(spark, "exact")
    # Read by both sides of the join below; as a plan it would be searched for twice.
    search.topk_cosine(vectors, vectors, 10, "vec_id", "vec_id", skip_same=True).write.parquet(path)
    exact = readers.read_parquet(spark, path)
    short = vectors.select("vec_id", F.slice("embedding", 1, 32).alias("embedding"))
    reduced = search.topk_cosine(short, short, 10, "vec_id", "vec_id", skip_same=True)
    found = reduced.withColumn("version", F.lit("v1-32")).unionByName(exact.withColumn("version", F.lit("v2-64")))
    return _rounded(search.recall_at_k(found, exact), ["recall"])


# --- versions --------------------------------------------------------------------------


def snapshot_manifest(spark, sf):
    old, new = shapes.order_versions(spark, sf)
    parts = [
        versions.table_manifest(df, "orders", v, "logical_path", F.col("md5")) for v, df in (("v1", old), ("v2", new))
    ]
    return parts[0].unionByName(parts[1])


def snapshot_diff(spark, sf):
    return versions.snapshot_diff(*shapes.order_versions(spark, sf))


def snapshot_changed(spark, sf):
    return versions.has_changed(snapshot_diff(spark, sf))


def _file_versions(spark, sf) -> tuple[DataFrame, list[str]]:
    """Manifest of two versions of a folder of files, and the folders."""
    folders = [scratch_path(spark, f"files-v{v}") for v in (1, 2)]
    for version, folder in enumerate(folders, 1):
        files.write_files(shapes.supplier_files(spark, sf, version), folder, F.col("name"), F.col("text"))
    parts = [versions.file_manifest(spark, folder, "files", f"v{v}") for v, folder in enumerate(folders, 1)]
    return parts[0].unionByName(parts[1]), folders


def file_manifest(spark, sf):
    """Name, length and hash of every file of two versions."""
    return _file_versions(spark, sf)[0].drop("physical_path")


def read_files_at(spark, sf):
    """The markdown files of both versions out of one store of contents."""
    manifest, folders = _file_versions(spark, sf)
    store = scratch_path(spark, "contents")
    for folder in folders:
        versions.store_files(spark, folder, store)
    manifest = manifest.where(F.col("logical_path").endswith(".md"))
    parts = [
        versions.read_files_at(spark, manifest, "files", v, store).withColumn("version", F.lit(v)) for v in ("v1", "v2")
    ]
    held = spark.read.parquet(store).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("md5").alias("contents")).first()
    both = parts[0].unionByName(parts[1]).select("version", "logical_path", F.col("content").cast("string").alias("text"))
    return both.withColumns({"stored": F.lit(held["rows"]), "contents": F.lit(held["contents"])})


def lineage_upstream(spark, sf):
    """What every order was built from, over three levels; versions from the tables' keys."""
    orders, customers, nations = (shapes.table(spark, sf, t) for t in ("orders", "customer", "nation"))

    def edges(df: DataFrame, name: str, key: str, source: str, source_key: str) -> DataFrame:
        version, source_version = (F.concat(F.lit("v"), k) for k in (key, source_key))
        edge = versions.lineage_edge(name, "", source, "")
        return df.select(
            edge["dataset"].alias("dataset"),
            version.alias("version"),
            edge["source_dataset"].alias("source_dataset"),
            source_version.alias("source_data_version"),
        )

    parts = [
        edges(orders, "orders", "o_orderkey", "customer", "o_custkey"),
        edges(customers, "customer", "c_custkey", "nation", "c_nationkey"),
        edges(nations, "nation", "n_nationkey", "region", "n_regionkey"),
    ]
    found = versions.upstream(reduce(DataFrame.unionByName, parts))
    return found.groupBy("dataset", "source_dataset", "source_data_version", "depth").agg(
        F.count(F.lit(1)).alias("built")
    )


def manifest_asof_version(spark, sf):
    old, new = shapes.order_versions(spark, sf)
    store = old.select("md5", "price_cents").union(new.select("md5", "price_cents")).dropDuplicates(["md5"])
    return versions.read_version(snapshot_manifest(spark, sf), "orders", "v1", store).select(
        "logical_path", "version", "md5", "price_cents"
    )


def dataset_fingerprint(spark, sf):
    parts = [
        versions.dataset_fingerprint(df, versions.row_hash("logical_path", "md5")).withColumn("version", F.lit(v))
        for v, df in zip(("v1", "v2"), shapes.order_versions(spark, sf))
    ]
    return parts[0].unionByName(parts[1])


def lineage_filter(spark, sf):
    """Two runs over the corpus in one table; the rows of one run by their lineage."""
    docs = shapes.documents(spark, sf).select(
        "text",
        T.repo_name(shapes.file_path()).alias("source_repo"),
        T.base_name(shapes.file_path()).alias("source_file"),
        F.lit(0).alias("chunk_index"),
        T.hash_uuid(F.col("doc_id")).alias("doc_id"),
        *(F.lit("").alias(f"section_h{i}") for i in (1, 2, 3)),
    )
    embedded = embed(docs, dim=16)
    runs = []
    for version, uid in (("documents-v1.0.0", "run-1"), ("documents-v1.1.0", "run-2")):
        rows = embedded.withColumn("chunk_id", T.hash_uuid(F.col("doc_id"), F.lit(version)))
        lineage = vector_table.Lineage(version, "hashing-16", workflow_uid=uid)
        runs.append(vector_table.stored_rows(rows, lineage, dim=16))
    path = scratch_path(spark, "lineage")
    vector_table.write_vector_table(reduce(DataFrame.unionByName, runs), path)
    found = vector_table.filter_lineage(
        readers.read_parquet(spark, path), dvc_data_version="documents-v1.1.0", argo_workflow_uid="run-2"
    )
    edge = versions.lineage_edge("vectors", "v1", "documents", "documents-v1.1.0")
    as_json = vector_table.metadata_json(found)
    return as_json.select(
        "id",
        F.get_json_object("metadata", "$.source_repo").alias("source_repo"),
        F.get_json_object("metadata", "$.dvc_data_version").alias("data_version"),
        F.get_json_object("metadata", "$.embedding_model").alias("embedding_model"),
        F.md5("content").alias("content_md5"),
        edge["source_data_version"].alias("source_data_version"),
    )


def batched_sink(spark, sf):
    """Rows sent to an outside store in batches, twice; what the store then holds."""
    docs = shapes.documents(spark, sf)
    rows = docs.select(T.hash_uuid(F.col("doc_id")).alias("id"), "source", F.md5("text").alias("content_md5"))
    folder = scratch_path(spark, "batches")
    for sent in (rows, rows.repartition(3)):
        vector_table.write_batches_once(sent, lambda: vector_table.FolderLedger(folder), "id")
    held = spark.read.schema(rows.schema).json(folder)
    return held.groupBy("id", "source", "content_md5").agg(F.count(F.lit(1)).alias("times"))


# --- names and payloads ----------------------------------------------------------------


def decode_payload(spark, sf):
    docs = shapes.documents(spark, sf)
    payloads = docs.select("doc_id", F.base64(F.col("text").cast("binary")).alias("payload"))
    decoded = payloads.select("doc_id", T.decode_base64(F.col("payload")).alias("text"))
    return decoded.where(F.col("text").isNotNull() & (F.col("text") != ""))


def readme_file_name(spark, sf):
    docs = shapes.table(spark, sf, "documents")
    return docs.select("doc_id", T.readme_file_name(F.col("source"), shapes.landed_at()).alias("file_name"))


def repo_name_from_path(spark, sf):
    docs = shapes.table(spark, sf, "documents").select("doc_id", shapes.file_path().alias("path"))
    path = F.col("path")
    return docs.select(
        "doc_id",
        T.base_name(path).alias("file_name"),
        T.repo_name(path).alias("repo"),
        T.repo_name_with_time(path).alias("repo_with_time"),
    )


# --- streams ---------------------------------------------------------------------------


def latest_per_source(spark, sf):
    """The newest file per source, kept by a stream over a landing folder.

    Three lots land, and the stream goes on after each: some older texts, then the newest ones, then the
    oldest, late. A lot is as many files as the tasks that write it.
    """
    docs = shapes.table(spark, sf, "documents")
    schema, landing = docs.schema, scratch_path(spark, "landed")
    table, checkpoint = scratch_path(spark, "latest"), scratch_path(spark, "checkpoint")
    for turn in (1, 0, 2):
        docs.where((F.col("doc_id") + 1) % 3 == turn).write.mode("append").parquet(landing)
        files = stream.stream_parquet(spark, landing, schema)
        files = files.select("doc_id", "source", shapes.landed_at().alias("ts"))
        stream.track_latest(files, "source", "ts", "doc_id", table, checkpoint, merge_every=2)
    newest = stream.read_tracked(spark, table, "source", "ts", "doc_id").select("doc_id")
    rows = docs.join(newest, "doc_id", "left_semi")
    return rows.select("source", "doc_id", shapes.file_path().alias("path"), "text")


def incremental_ingest(spark, sf):
    """Documents chunked batch by batch into a table, as a batch run over the newest texts would.

    Two batches land: older texts of all documents, then the newest texts of those that
    changed. Every tenth document is emptied by the second batch and has no chunks left.
    """
    docs = shapes.table(spark, sf, "documents")
    changed, emptied = F.col("doc_id") % 3 == 0, F.col("doc_id") % 10 == 9
    older = F.when(changed, F.concat(F.lit("An older line.\n"), "text")).otherwise(F.col("text"))
    newest = F.when(~emptied, F.col("text"))
    landing = scratch_path(spark, "landing")

    def process(batch: DataFrame) -> DataFrame:
        docs = shapes.as_markdown(readers.spread(batch, "doc_id"))
        return chunking.chunk_documents(docs, "doc_id", settings=WINDOW).withColumnRenamed("chunk_id", "id")

    table, checkpoint = scratch_path(spark, "ingested"), scratch_path(spark, "checkpoint")
    for landed in (docs.withColumn("text", older), docs.withColumn("text", newest).where(changed | emptied)):
        landed.write.mode("append").parquet(landing)
        stream.ingest(stream.stream_parquet(spark, landing, docs.schema), process, table, checkpoint, T.hash_uuid(F.col("doc_id")))
    schema = process(docs).schema
    rows = stream.read_ingested(spark, table, schema, "doc_id")
    return rows.select("id", "source_file", "chunk_index", "section_h1", "text")


_QUERIES: tuple[Query, ...] = (
    text_stats_by_split,
    union_tagged_sources,
    feature_stats,
    target_stats,
    schema_profile,
    standardize_features,
    value_counts_by_key,
    value_counts_by_freq,
    label_decode_counts,
    dense_histogram,
    normalize_schema,
    corpus_stats,
    distinct_sources,
    distinct_labels_union,
    metadata_json,
    table_metadata,
    tensor_metadata,
    caption_metadata,
    corpus_metadata,
    array_scale_stats,
    tensor_shape_profile,
    tensor_from_bytes,
    scan_parquet,
    scan_csv_roundtrip,
    scan_json_roundtrip,
    split_write_readback,
    scan_text_wholefile,
    entity_files,
    scan_permissive_rejects,
    eval_questions_scan,
    sample_exact_floor,
    sample_exact_round,
    sample_tensor_rows,
    split_shuffled,
    split_by_position,
    global_row_index,
    first_n,
    split_counts,
    strip_markup,
    code_fence_state,
    clean_lines,
    clean_text,
    noise_flags,
    markdown_sections,
    header_splitter,
    split_by_size,
    chunk_reindex,
    merge_small_chunks,
    chunk_documents,
    chunk_documents_recursive,
    chat_format,
    caption_stats,
    caption_image_join,
    existing_image_semi,
    image_dims_avg,
    image_files,
    embed_hashing,
    vector_table_write,
    vector_topk_cosine,
    question_search,
    retrieval_recall_by_version,
    snapshot_manifest,
    file_manifest,
    read_files_at,
    snapshot_diff,
    snapshot_changed,
    manifest_asof_version,
    dataset_fingerprint,
    lineage_filter,
    batched_sink,
    lineage_upstream,
    decode_payload,
    readme_file_name,
    repo_name_from_path,
    latest_per_source,
    incremental_ingest,
)


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in _QUERIES}
