"""Dataset flows: the process and the analyse step of each kind of dataset.

A flow takes DataFrames and returns DataFrames; what is read and written where stays with
the caller. Metadata documents are one row with one JSON column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import chat, chunking, combine, profile, sampling, vector_table
from ..operators.embedding import Model, embed
from ..operators.lookup import scalar_map, single_row


def _document(df: DataFrame, **parts: Column) -> DataFrame:
    """One row with the parts as one JSON text; null values stay visible."""
    one = df.sparkSession.range(1)
    body = F.struct(*(value.alias(name) for name, value in parts.items()))
    return one.select(F.to_json(body, {"ignoreNullFields": "false", "pretty": "true"}).alias("metadata"))


def _map_of(small: DataFrame, key: Column, value: Column) -> Column:
    return scalar_map(small, key.cast("string"), value)


def _dataset(name: str, source: str, description: str = "") -> Column:
    return F.struct(F.lit(name).alias("name"), F.lit(description).alias("description"), F.lit(source).alias("source"))


# --- tables ----------------------------------------------------------------------------


def tagged_table(sources: dict[int, DataFrame], tag: str, key: str | None = None, fraction: float = 1.0, seed: int = 42) -> DataFrame:
    """Sources stacked with their tag, sampled exactly when a fraction is given."""
    stacked = combine.union_tagged(sources, tag)
    if fraction >= 1.0:
        return stacked
    if key is None:
        raise ValueError("sampling needs a unique key column")
    return sampling.sample_exact(stacked, key, fraction, seed)


def table_metadata(df: DataFrame, name: str, source: str, target: str, tag: str, tag_names: dict[int, str]) -> DataFrame:
    """Schema, counts and per-feature statistics of a table with an integer target."""
    features = [c for c in df.columns if c != target]
    types = dict(df.dtypes)
    described = F.create_map(
        *(
            part
            for c in features
            for part in (F.lit(c), F.struct(F.lit(types[c]).alias("dtype"), F.lit(f"feature: {c}").alias("description")))
        )
    )
    stats = profile.feature_stats(df, features)
    goal = single_row(profile.describe_counts(df, [], [target]), "the table is empty")
    numbers = F.struct("mean", "std", "min", "max", "median")
    by_target = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    by_tag = df.groupBy(combine.decode(tag, tag_names).alias("tag")).agg(F.count(F.lit(1)).alias("n"))
    return _document(
        df,
        dataset=_dataset(name, source),
        schema=F.struct(
            described.alias("features"),
            F.struct(
                F.lit(target).alias("name"),
                F.lit(types[target]).alias("dtype"),
                F.array(goal["min"], goal["max"]).alias("range"),
            ).alias("target"),
        ),
        summary=F.struct(
            goal["n"].alias("num_samples"),
            F.lit(len(features)).alias("num_features"),
            _map_of(by_target, F.col(target), F.col("n")).alias(f"{target}_distribution"),
            _map_of(by_tag, F.col("tag"), F.col("n")).alias(f"{tag}_distribution"),
        ),
        statistics=F.struct(
            _map_of(stats, F.col("feature"), numbers).alias("features"),
            F.struct(*(goal[f].alias(f) for f in ("mean", "std", "median"))).alias("target"),
        ),
    )


# --- text with labels ------------------------------------------------------------------


def labelled_text(
    raw: DataFrame, names: dict[str, str], key: str, fraction: float = 0.5, train: float = 0.8, seed: int = 42
) -> DataFrame:
    """Renamed, sampled and split into train and val."""
    shaped = combine.normalize_schema(raw, {**names, key: key})
    return sampling.split_shuffled(sampling.sample_exact(shaped, key, fraction, seed, "round"), key, train, seed)


def text_length_stats(df: DataFrame, split: str = "split", text: str = "text") -> DataFrame:
    """(split, metric, n, mean, std, min, max, median) of characters and words."""
    sizes = df.select(
        split, T.char_count(F.col(text)).alias("char_length"), T.word_count(F.col(text)).alias("word_count")
    )
    return profile.describe_counts(sizes, [split], ["char_length", "word_count"])


def text_label_metadata(df: DataFrame, name: str, source: str, split: str = "split") -> DataFrame:
    """Label classes, label counts and text-length statistics per split."""
    counts = df.groupBy(split, "label").agg(F.count(F.lit(1)).alias("n"))
    per_split = counts.groupBy(split).agg(
        F.sum("n").alias("num_samples"),
        F.lit(2).alias("num_features"),
        F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("label_distribution"),
    )
    classes = counts.select("label").distinct().agg(F.sort_array(F.collect_list("label")).alias("classes"))
    measures = ("mean", "std", "min", "max", "median")
    stats = text_length_stats(df, split)
    wide = stats.groupBy(split).agg(
        *(
            F.max(F.when(F.col("metric") == metric, F.col(m))).alias(f"{metric}_{m}")
            for metric in ("char_length", "word_count")
            for m in measures
        )
    )
    metrics = F.struct(*(c for c in wide.columns if c != split))
    feature = {
        "text": F.struct(F.lit("string").alias("dtype"), F.lit("Text").alias("description")),
        "label": F.struct(
            F.lit("string").alias("dtype"),
            F.lit("Label").alias("description"),
            single_row(classes, "no labels")["classes"].alias("classes"),
        ),
    }
    return _document(
        df,
        dataset=_dataset(name, source),
        schema=F.struct(F.struct(*(value.alias(key) for key, value in feature.items())).alias("features")),
        splits=_map_of(per_split, F.col(split), F.struct("num_samples", "num_features", "label_distribution")),
        metrics=_map_of(wide, F.col(split), metrics),
    )


# --- tensors ---------------------------------------------------------------------------


def tensor_splits(splits: dict[str, DataFrame], key: list[str], fraction: float = 0.6, seed: int = 42) -> DataFrame:
    """Each source split sampled alone; image and label stay one row."""
    parts = []
    for name, rows in splits.items():
        keyed = rows.withColumn("_key", F.concat_ws("/", *key))
        parts.append(sampling.sample_exact(keyed, "_key", fraction, seed).drop("_key").withColumn("split", F.lit(name)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def tensor_metadata(
    df: DataFrame, name: str, source: str, class_names: list[str], image: str = "image", label: str = "label"
) -> DataFrame:
    """Shape, class counts with zeros and pixel statistics (scaled to 0..1) per split."""
    codes = df.sparkSession.createDataFrame(list(enumerate(class_names)), "class_id int, class_name string")
    counts = df.groupBy("split", F.col(label).cast("int").alias("class_id")).agg(F.count(F.lit(1)).alias("n"))
    # The grid is splits x classes, both short lists.
    grid = counts.select("split").distinct().select(
        "split", F.explode(F.sequence(F.lit(0), F.lit(len(class_names) - 1))).alias("class_id")
    )
    dense = (
        grid.join(counts, ["split", "class_id"], "left")
        .join(codes, "class_id")
        .groupBy("split")
        .agg(
            F.sum(F.coalesce("n", F.lit(0))).alias("num_samples"),
            F.lit(2).alias("num_features"),
            F.map_from_entries(
                F.collect_list(F.struct("class_name", F.coalesce("n", F.lit(0)).alias("n")))
            ).alias("class_distribution"),
        )
    )
    # Pixels are whole numbers of 256 values, so their counts carry every statistic.
    pixels = df.select("split", F.explode_outer(F.flatten(image)).alias("pixel"))
    measures = ("mean", "std", "min", "max", "median")
    stats = profile.describe_counts(pixels, ["split"], ["pixel"], population=True)
    stats = stats.select("split", *((F.col(m) / F.lit(255.0)).alias(m) for m in measures))
    numbers = F.struct(*(F.col(m).alias(f"pixel_{m}") for m in measures))
    shape = single_row(
        df.agg(F.max(F.size(image)).alias("rows"), F.max(F.size(F.get(F.col(image), F.lit(0)))).alias("cols")), "no images"
    )
    return _document(
        df,
        dataset=_dataset(name, source),
        schema=F.struct(
            F.array(shape["rows"], shape["cols"]).alias("shape"),
            F.create_map(*(F.lit(p) for i, n in enumerate(class_names) for p in (str(i), n))).alias("classes"),
        ),
        splits=_map_of(dense, F.col("split"), F.struct("num_samples", "num_features", "class_distribution")),
        metrics=_map_of(stats, F.col("split"), numbers),
    )


# --- captions --------------------------------------------------------------------------


def caption_chat(
    captions: DataFrame, images: DataFrame, prompt: DataFrame, order: str, topic: str, train: float = 0.8
) -> DataFrame:
    """Chat rows split by position, each with its image under the new name.

    Positions count all captions. A caption without an image gives no row;
    `chat.missing_images` lists those.
    """
    placed = sampling.global_row_index(captions, order)
    split = sampling.split_by_order(placed, order, train)
    rows = chat.chat_format(chat.join_images(split, images), prompt)
    return rows.withColumn("image", chat.split_image_name(F.col("split"), F.col("position"), topic))


def process_stats(rows: DataFrame, prompt: DataFrame, train: float) -> DataFrame:
    """Rows per split, the ratio and the full prompt record, as one row."""
    record = single_row(prompt, "the prompt is not registered")
    return chat.split_summary(rows, train).withColumn("prompt", record)


def caption_metadata(rows: DataFrame, sizes: DataFrame, prompt: DataFrame, name: str, source: str) -> DataFrame:
    """Prompt record, counts, caption lengths and mean image sizes per split."""
    words = chat.caption_stats(rows)
    dims = chat.image_size_means(rows, sizes)
    both = words.join(dims, "split", "left")
    metrics = F.struct(*(c for c in both.columns if c not in ("split", "num_samples", "num_images")))
    return _document(
        rows,
        dataset=_dataset(name, source),
        prompt=single_row(prompt, "the prompt is not registered"),
        splits=_map_of(words, F.col("split"), F.struct("num_samples")),
        metrics=_map_of(both, F.col("split"), metrics),
    )


# --- documents -------------------------------------------------------------------------


def vector_rows(
    docs: DataFrame,
    doc_key: str,
    lineage: vector_table.Lineage,
    settings: chunking.ChunkSettings = chunking.ChunkSettings(),
    load: "type[Model] | None" = None,
    dim: int = 384,
) -> DataFrame:
    """Documents (path, text) to the rows of the vector table, without a shuffle."""
    chunks = chunking.chunk_documents(docs, doc_key, settings=settings)
    return vector_table.stored_rows(embed(chunks, model_name=lineage.embedding_model, load=load, dim=dim), lineage, dim)


def corpus_metadata(docs: DataFrame, lineage: vector_table.Lineage, settings: chunking.ChunkSettings) -> DataFrame:
    """Settings, source version and corpus statistics; counts files, not chunks."""
    stats = single_row(profile.corpus_stats(docs, "text"), "no statistics")
    repos = docs.select(T.repo_name(F.col("path")).alias("repo")).distinct()
    names = single_row(repos.agg(F.sort_array(F.collect_list("repo")).alias("names")), "no files")["names"]
    return _document(
        docs,
        source_data_version=F.lit(lineage.data_version),
        embedding_model=F.lit(lineage.embedding_model),
        chunk_size=F.lit(settings.chunk_size),
        chunk_overlap=F.lit(settings.chunk_overlap),
        statistics=F.struct(
            stats["total_files"].alias("total_files"),
            F.size(names).alias("total_repositories"),
            names.alias("repository_names"),
            *(
                stats[f].alias(f)
                for f in (
                    "total_size_bytes",
                    "average_size_bytes",
                    "total_characters",
                    "average_characters",
                    "total_lines",
                    "average_lines",
                )
            ),
        ),
    )
