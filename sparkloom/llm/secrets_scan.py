"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Candidates are marked in the text by regular expressions and their places follow
from the lengths of the pieces between marks. The values' hashes are counted by
distinct repositories and owners over the whole corpus: a value that many owners
share is a copied example, one with fewer owners looks live.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sparkloom.llm.common import cut

#: The base patterns in their order, least lengths, and the general token of the method.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 12, 18, 16
KINDS = ["assign", "access", "hex", "token"]

OPEN, CLOSE, OTHER = "\u0001", "\u0002", "\u0003"


@dataclass(frozen=True)
class Policy:
    """token_chars: least length of a general token. A value is a copied example
    from example_owners distinct owners on and owner-specific with fewer, in however
    many repositories: copies of a document don't make its secrets examples."""

    token_chars: int = 20
    example_owners: int = 3


def _runs(chars: str, least: int) -> str:
    return f"{chars}{{{least},}}"


def _patterns(policy: Policy) -> dict[str, str]:
    """A maximal run of a class is long enough exactly if it matches with that least length; assign's failing matches must still be consumed."""
    return {
        "assign": ASSIGN,
        "access": _runs("AKIA[A-Z0-9]", ACCESS_CHARS - 4),
        "hex": _runs("[0-9a-f]", HEX_CHARS),
        "token": _runs("[A-Za-z0-9+/_=-]", policy.token_chars),
    }


def _pieces(text: Column, kind: str, pattern: str) -> Column:
    """Array of (kind, index, length, match): the text cut before each match; the first piece has no match."""
    marked = F.split(F.regexp_replace(text, pattern, f"{OPEN}$0{CLOSE}"), OPEN)
    return F.transform(
        marked,
        lambda piece, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("i"),
            (F.length(piece) - F.when(i > 0, F.lit(1)).otherwise(F.lit(0))).alias("length"),
            F.when(i > 0, F.substring_index(piece, CLOSE, 1)).alias("match"),
        ),
    )


def candidates(docs: DataFrame, id_col: str, text_col: str, repo_col: str, owner_col: str, policy: Policy = Policy()) -> DataFrame:
    """Distinct (id, text_hash, repo, owner, kind, start, end, value): every candidate span with the digest of its value.

    Places are code points, end exclusive.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    patterns = _patterns(policy)
    some = "|".join(["(?i:password|passwd|secret|token|api_?key)", *(patterns[k] for k in KINDS[1:])])
    clean = F.replace(F.replace(text, F.lit(OPEN), F.lit(OTHER)), F.lit(CLOSE), F.lit(OTHER))
    rows = docs.select(F.col(id_col).alias("id"), F.col(repo_col).alias("repo"), F.col(owner_col).alias("owner"), F.xxhash64(text).alias("text_hash"), clean.alias("text")).filter(F.col("text").rlike(some))
    pieces = F.flatten(F.array(*(_pieces(F.col("text"), k, patterns[k]) for k in KINDS)))
    rows = rows.withColumn("row", F.monotonically_increasing_id()).select("row", "id", "repo", "owner", "text_hash", F.inline(pieces))
    before = W.partitionBy("row", "kind").orderBy("i").rowsBetween(W.unboundedPreceding, -1)
    found = rows.withColumn("start", F.coalesce(F.sum("length").over(before), F.lit(0))).filter("match IS NOT NULL")
    value = F.when(F.col("kind") == "assign", F.regexp_extract("match", ASSIGN, 2)).otherwise(F.col("match"))
    least = F.when(F.col("kind") == "assign", ASSIGN_CHARS).otherwise(0)
    live = (F.col("kind") != "token") | (value.rlike("[A-Z]") & value.rlike("[a-z]") & value.rlike("[0-9]"))
    found = found.filter((F.length(value) >= least) & live)
    return found.select("id", "text_hash", "repo", "owner", "kind", "start", (F.col("start") + F.length("match")).alias("end"), F.sha2(value, 256).alias("value")).distinct()


def ownership(found: DataFrame) -> DataFrame:
    """value, n_repos, n_owners, n_base: over the whole corpus; two pre-aggregated steps, so a hot value is a row a task."""
    base = F.sum((F.col("kind") != "token").cast("long"))
    by_repo = found.groupBy("value", "owner", "repo").agg(base.alias("n_base"))
    by_owner = by_repo.groupBy("value", "owner").agg(F.count("*").alias("n_repos"), F.sum("n_base").alias("n_base"))
    return by_owner.groupBy("value").agg(F.sum("n_repos").alias("n_repos"), F.count("*").alias("n_owners"), F.sum("n_base").alias("n_base"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["k"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source", policy: Policy = Policy()) -> DataFrame:
    """One row per row of ``docs``: id_col, spans and counts.

    base: array of (k, start, end) of the base patterns, k the place of the kind in
    KINDS from 1. added: tokens that no base span overlaps, whose value is owner-specific
    or was met as a base value and isn't a copied example. n_live, n_example: spans
    with owner-specific and copied values. Null text counts as empty; null owners
    and repositories count as one each; repeated rows are scanned once and each
    reported; an empty table gives an empty result.
    """
    found = cut(candidates(docs, id_col, text_col, repo_col, owner_col, policy), "secrets-found")
    owners = cut(ownership(found), "secrets-owners")
    example = F.col("n_owners") >= policy.example_owners
    live = ~example
    k = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    judged = found.join(owners, "value").select("id", "text_hash", F.struct("start", k.alias("k"), "end").alias("span"), (F.col("kind") == "token").alias("general"), example.alias("example"), live.alias("live"), (F.col("n_base") > 0).alias("known"))
    in_order = lambda c: F.array_sort(F.collect_set(c))
    by_doc = judged.groupBy("id", "text_hash").agg(
        in_order(F.when(~F.col("general"), F.col("span"))).alias("base"),
        in_order(F.when(F.col("general") & ~F.col("example") & (F.col("live") | F.col("known")), F.col("span"))).alias("more"),
        F.count_if(F.col("live")).alias("n_live"),
        F.count_if(F.col("example")).alias("n_example"),
    )
    by_doc = by_doc.withColumn("added", F.filter("more", lambda s: ~F.exists(F.col("base"), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))))
    keys = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_hash"))
    joined = keys.join(by_doc, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_hash") == F.col("text_hash")), "left")
    empty = F.array().cast(by_doc.schema["base"].dataType)
    return joined.select(
        F.col("_id").alias(id_col),
        F.coalesce("base", empty).alias("base"),
        F.coalesce("added", empty).alias("added"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_example", F.lit(0)).alias("n_example"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: spans of every document; a repository is a document, an owner its source."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    found = scan(docs)
    n = lambda k: F.size(F.filter("base", lambda s: s["k"] == k)).cast("long")
    return found.select(
        "doc_id",
        n(1).alias("n_assign"),
        n(2).alias("n_access"),
        n(3).alias("n_hex"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
        "n_live",
        "n_example",
    )
