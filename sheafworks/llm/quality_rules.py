"""Host-level quality rules with DataFrame functions only.

Rules are measured for each document; failures are summed by host (`source`), the rates shrunk
towards a beta prior fitted to all hosts, and hosts that fail take their documents with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafworks.session import scratch_path

from .common import text_of, write_once

SPACE_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
#: Up to so many hosts travel to all tasks; more are joined with salted keys.
LOCAL_HOSTS = 100_000
SALTS = 32

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Rules that are summed by host; the first two reject a document by themselves.
RULES = {
    "short": "n_words < 10",
    "repeats": "100 * n_repeat_words > 20 * n_words",
    "symbols": "100 * n_symbols > 10 * n_words",
    "copied_lines": "100 * n_dup_lines > 30 * n_lines",
}


def _repeat_positions(df: DataFrame) -> DataFrame:
    """Adds `_n_repeat` from the array `_windows` of window hashes; most texts skip all the work.

    Each step is a column of its own that the next one uses more than once, so the optimizer
    keeps it as a step and works it out once for each row.
    """
    some = F.size(F.array_distinct("_windows")) < F.size("_windows")
    places = F.sequence(F.lit(0), F.size("_windows") - 1)
    df = df.withColumn("_sorted", F.when(some, F.sort_array(F.arrays_zip(F.col("_windows").alias("h"), places.alias("p")))))
    index = F.sequence(F.lit(0), F.size("_sorted") - 1)

    def twin(i: Column) -> Column:
        own = F.get("_sorted", i)["h"]
        before, after = F.get("_sorted", i - 1)["h"], F.get("_sorted", i + 1)["h"]
        return F.coalesce(own == before, F.lit(False)) | F.coalesce(own == after, F.lit(False))

    starts = F.transform(F.filter(index, twin), lambda i: F.get("_sorted", i)["p"])
    df = df.withColumn("_starts", F.when(F.col("_sorted").isNotNull(), F.sort_array(starts)))
    step = F.sequence(F.lit(1), F.size("_starts"))
    covered = F.transform(
        step, lambda i: F.least(F.lit(WINDOW), F.coalesce(F.get("_starts", i) - F.get("_starts", i - 1), F.lit(WINDOW)))
    )
    total = F.aggregate(covered, F.lit(0), lambda a, x: a + x)
    return df.withColumn("_n_repeat", F.when(F.col("_starts").isNotNull(), total).otherwise(0))


def measure(documents: DataFrame) -> DataFrame:
    """Adds the measures and n_lines to `documents`; columns with these names are replaced.

    A word is a run of [^\\x20\\x09-\\x0D]; a null or empty text has none. word_chars: code points
    in words. n_symbols: characters of [#*$%&|<>]. n_dup_lines: \\n-split lines with a word that
    equal an earlier line. n_repeat_words: words inside runs of five words that occur twice or
    more in the text, the first occurrence included.
    """
    added = (*MEASURES, "n_lines")
    others = [c for c in documents.columns if c not in added]
    df = documents.select(*others, text_of().alias("_text"))
    df = df.withColumn("_words", F.array_remove(F.split("_text", SPACE_RUN, -1), ""))
    df = df.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    near = [lambda i, k=k: F.get("_hashes", i + k) for k in range(WINDOW)]
    windows = F.transform(F.sequence(F.lit(0), F.size("_hashes") - WINDOW), lambda i: F.xxhash64(*(f(i) for f in near)))
    no_windows = F.array().cast("array<bigint>")
    df = df.withColumn("_windows", F.when(F.size("_hashes") >= WINDOW, windows).otherwise(no_windows))
    df = _repeat_positions(df)
    lines = F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("_lines", lines)
    whole = F.octet_length("_text")
    return df.select(
        *others,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (whole - F.octet_length(F.regexp_replace("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.col("_n_repeat").cast("long").alias("n_repeat_words"),
        (whole - F.octet_length(F.replace("_text", F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
    )


def base_failed() -> Column:
    return F.expr(f"({RULES['short']}) or ({RULES['repeats']})")


def host_verdicts(measured: DataFrame, limit: float = 0.5) -> DataFrame:
    """(source, host_rate, host_failed) of every host that is not null.

    For each rule a beta prior is fitted to the host rates by moments (mean of all documents,
    variance between hosts less the sampling variance); a host's rate is its posterior mean. A
    host fails if the shrunk rate of some rule is above `limit` and above the middle between the
    mean of all documents and 1, so a rule that most documents fail rejects no average host.
    host_rate is the largest shrunk rate.
    """
    fails = [F.sum(F.expr(rule).cast("long")).alias(f"f_{name}") for name, rule in RULES.items()]
    hosts = measured.where("source is not null").groupBy("source").agg(F.count(F.lit(1)).alias("n"), *fails)
    hosts = write_once(hosts, scratch_path(measured.sparkSession, "hosts"))
    parts = [F.sum("n").alias("total"), F.count(F.lit(1)).alias("hosts"), F.sum(F.col("n") * F.col("n")).alias("squares")]
    for name in RULES:
        f = F.col(f"f_{name}")
        parts += [F.sum(f).alias(f"s_{name}"), F.sum(f * f / F.col("n")).alias(f"q_{name}")]
    prior = hosts.agg(*parts).first()
    shrunk, failed = [], F.lit(False)
    for name in RULES:
        mean, strength = _beta_prior(prior, name)
        rate = F.lit(mean) if strength is None else (F.col(f"f_{name}") + mean * strength) / (F.col("n") + strength)
        shrunk.append(rate)
        failed = failed | (rate > max(limit, (1 + mean) / 2))
    return hosts.select("source", F.greatest(*shrunk).alias("host_rate"), failed.alias("host_failed"))


def _beta_prior(prior, name: str) -> tuple[float, float | None]:
    """(mean, alpha + beta); no strength if the hosts do not differ by more than chance."""
    total, hosts = prior["total"] or 0, prior["hosts"]
    if not total:
        return 0.0, None
    mean = prior[f"s_{name}"] / total
    # Weighted variance between hosts, corrected for the binomial noise of each.
    between = prior[f"q_{name}"] - total * mean * mean
    room = total - prior["squares"] / total
    if room <= 0:
        return mean, None
    variance = (between - (hosts - 1) * mean * (1 - mean)) / room
    if variance <= 0 or mean in (0.0, 1.0):
        return mean, None
    return mean, max(mean * (1 - mean) / variance - 1, 0.0)


def judge(measured: DataFrame, limit: float = 0.5) -> DataFrame:
    """Adds base_failed, host_rate and kept to measured documents.

    kept is false for documents that fail by themselves and for all documents of failed hosts.
    Documents without a host are judged alone. Null measures cannot occur.
    """
    others = [c for c in measured.columns if c not in ("base_failed", "host_rate", "kept")]
    hosts = host_verdicts(measured, limit).withColumnRenamed("source", "_host")
    left = measured.select(*others)
    if hosts.count() <= LOCAL_HOSTS:
        both = left.join(F.broadcast(hosts), F.col("source") == F.col("_host"), "left")
    else:
        # A host with a third of all documents is spread over SALTS groups.
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        salted = left.withColumn("_salt", F.expr(f"pmod(xxhash64(doc_id), {SALTS})"))
        wide = hosts.withColumn("_host_salt", salts)
        both = salted.join(wide, (F.col("source") == F.col("_host")) & (F.col("_salt") == F.col("_host_salt")), "left")
    out = F.coalesce("host_failed", F.lit(False))
    return both.select(*others, base_failed().alias("base_failed"), "host_rate", (~(base_failed() | out)).alias("kept"))


def document_verdicts(documents: DataFrame, limit: float = 0.5) -> DataFrame:
    """doc_id, source, the measures and the verdict of each row of (doc_id, source, text).

    Texts are read once; the measures are kept in the shared folder for the second look.
    """
    small = measure(documents.select("doc_id", "source", "text")).drop("text")
    return judge(write_once(small, scratch_path(documents.sparkSession, "measures")), limit)


def stage(documents: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns.

    Only the keys of those that fail are written and meet the documents again; rows with equal id,
    source and text share a verdict.
    """
    key = F.xxhash64("source", text_of())
    marked = documents.select("doc_id", "source", "text", key.alias("_key"))
    measured = write_once(measure(marked).drop("text"), scratch_path(documents.sparkSession, "measures"))
    failed = judge(measured).where("not kept").select(F.col("doc_id").alias("_failed_id"), F.col("_key").alias("_failed_key"))
    same = (F.xxhash64("source", text_of()) == F.col("_failed_key")) & F.col("doc_id").eqNullSafe(F.col("_failed_id"))
    return documents.join(failed.distinct(), same, "left_anti")
