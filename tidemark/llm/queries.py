"""The operators of this package over the given tables, as named queries."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from tidemark.llm import (
    audit,
    binary,
    centroids,
    cones,
    counting,
    forced,
    lines,
    packing,
    quality,
    rules,
    secrets,
    setsketch,
    warc,
)

QUERIES = {}


def vocabulary(name: str) -> str:
    """Where the tokenizer files lie on this box; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name):
    def register(fn):
        def run(spark, sf_dir):
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        return run

    return register


def ship(spark) -> None:
    """Let Python workers import this package from where the driver has it.

    A cluster gets the package with --py-files or its image; this serves workers
    that share the driver's file system.
    """
    here = str(Path(__file__).resolve().parents[2])
    seen = spark.sparkContext.environment.get("PYTHONPATH", "")
    if here not in seen.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{here}:{seen}".rstrip(":")


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_distribution_divergence")
def _(s, d):
    return quality.divergence_rules(table(s, d, "documents"))


@query("op2_spherical_caps")
def _(s, d):
    return cones.near_vectors(table(s, d, "embeddings"))


@query("op5_setsketch")
def _(s, d):
    return setsketch.near_duplicates(table(s, d, "documents"))


@query("op7_line_windows")
def _(s, d):
    return lines.remove_repeated_lines(table(s, d, "documents")).select(
        "doc_id",
        F.col("n_lines_removed").cast("long").alias("n_lines_removed"),
        F.length("text").cast("long").alias("n_chars_left"),
        F.md5("text").alias("text_md5"),
    )


@query("op9_secret_spans")
def _(s, d):
    found = secrets.find_secrets(table(s, d, "documents"))
    base = F.filter("spans", lambda x: x["kind"].isin(*secrets.BASE_KINDS))

    def count(kind):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in secrets.BASE_KINDS),
        F.sha2(secrets.joined(base), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
    )


@query("op3_best_fit_packing")
def _(s, d):
    return packing.best_fit_packing(table(s, d, "documents"), vocabulary("byte_bpe_50k.tiktoken"))


@query("op4_forced_boundaries")
def _(s, d):
    path = vocabulary("word_bpe_49k.json")
    return forced.round_trip(table(s, d, "documents"), path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op6_edited_counts")
def _(s, d):
    """Three edits of each document: its first line goes, 40 characters in the middle
    become capitals, and a closing line is added."""
    path = vocabulary("byte_bpe_50k.tiktoken")
    first = F.coalesce(F.instr("text", "\n"), F.lit(0))
    length = F.coalesce(F.length("text"), F.lit(0))
    middle = ((length - first) / 2).cast("int")
    capitals = F.upper(F.substr(F.coalesce("text", F.lit("")), first + middle + 1, F.lit(40)))
    edits = F.array(
        F.struct(F.lit(0).alias("start"), first.alias("end"), F.lit("").alias("text")),
        F.struct(middle.alias("start"), (middle + 40).alias("end"), capitals.alias("text")),
        F.struct((length * 2).alias("start"), (length * 2).alias("end"), F.lit("\nThe end.").alias("text")),
    )
    planted = counting.with_trees(
        table(s, d, "documents").select("doc_id", "text", edits.alias("edits")), path
    ).withColumn("n_tokens_before", counting.tree_total(F.col("tree")))
    return counting.apply_edits(planted, path).select(
        "doc_id",
        "n_tokens_before",
        counting.tree_total(F.col("tree")).alias("n_tokens_after"),
        F.length("text").cast("long").alias("n_chars_after"),
        F.col("n_encoded").alias("n_chars_encoded"),
    )


@query("op8_token_files")
def _(s, d):
    folder = binary.token_folder(s)
    binary.write_token_files(table(s, d, "documents"), folder, vocabulary("byte_bpe_50k.json"))
    return binary.read_token_files(s, folder)


@query("op10_rule_ensemble")
def _(s, d):
    return rules.score_documents(table(s, d, "documents"), table(s, d, "labels"))


@query("op11_zstd_archives")
def _(s, d):
    return warc.archive_pages(table(s, d, "pages"))


@query("op12_incremental_distances")
def _(s, d):
    return centroids.clustered(table(s, d, "embeddings"))


@query("op13_filter_audit")
def _(s, d):
    return audit.audit(table(s, d, "documents"), table(s, d, "labels"))
