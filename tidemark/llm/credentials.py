"""Secrets in whole texts, told apart by how widely each candidate is owned.

Base kinds are fixed patterns. The method looks at every candidate, also at long
mixed tokens of no known kind, hashes it, and counts over the whole corpus how
many distinct owners and repositories have it. A value that stands in one text only, however
often that whole text was copied, has one owner: copies of a document do not make its secrets
examples. A value in several texts counts all their owners, also where a paragraph around it was
copied along. If more than ``max_owners`` have it, it is a shared example, unless most of
the repositories with it belong to one owner, whose value it then is; any other looks like
a live credential. Live tokens of no known kind are added as spans of kind ``live``.

Only DataFrame functions are used. A null text is empty. Texts without spans have
the digest of the empty text. A null owner or repository counts as one of its own
kind. Repeated rows get rows of their own; an empty table gives an empty result;
other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import common

# The patterns of the kinds.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: 20 signs or more of a key's alphabet, with a letter and a digit anywhere; possessive, so each token is read once a test.
LIVE = (
    r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{20,}"
)
KINDS = ("assign", "access", "hex", "live")


def _hits(text: Column) -> list[Column]:
    """For each kind: the text between its matches, the matches, the values in them.

    A cheap test keeps the costly splitting from texts without a match. The
    patterns with a least length give the same matches as the open ones after
    which short matches are dropped, as a run is matched whole; an assignment's
    short value, though, ends the match it is in, so it is dropped later.
    """
    tests = (
        F.regexp_like(text, F.lit(ASSIGN)),
        F.contains(text, F.lit("AKIA")),
        F.regexp_like(text, F.lit(HEX)),
        F.regexp_like(text, F.lit(LIVE)),
    )
    out = []
    for kind, pattern, group, test in zip(KINDS, (ASSIGN, ACCESS, HEX, LIVE), (2, 0, 0, 0), tests, strict=True):
        found = F.struct(
            F.lit(kind).alias("kind"),
            F.split(text, pattern, -1).alias("gaps"),
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
            F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("values"),
        )
        out.append(F.when(test, found))
    return out


def candidates(documents: DataFrame, owner: Column, repository: Column) -> tuple[DataFrame, DataFrame]:
    """The rows of ``documents`` and the candidates in them, with code-point offsets."""
    room = common.scratch(documents.sparkSession, "secrets")
    text = F.coalesce("text", F.lit(""))
    found = documents.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        owner.alias("owner"),
        repository.alias("repository"),
        F.xxhash64(text).alias("whole"),
        F.array_compact(F.array(*_hits(text))).alias("found"),
    )
    held = room.save(found, "found")
    one = held.select("row", "owner", "repository", "whole", F.explode("found").alias("f"))
    one = one.select("row", "owner", "repository", "whole", "f.kind", F.posexplode(F.arrays_zip("f.gaps", "f.hits", "f.values")))
    order = Window.partitionBy("row", "kind").orderBy("pos")
    size = F.coalesce(F.length("col.hits"), F.lit(0))
    end = F.sum(F.length("col.gaps") + size).over(order)
    spans = one.withColumns({"end": end, "start": end - size}).where(
        F.col("col.hits").isNotNull() & ((F.col("kind") != "assign") | (F.length("col.values") >= 8))
    )
    return held.select("row", "doc_id"), spans.select(
        "row",
        "owner",
        "repository",
        "kind",
        "start",
        "end",
        "whole",
        F.sha2(F.col("col.values"), 256).alias("hash"),
    )


def ownership(spans: DataFrame) -> DataFrame:
    """``(hash, owners, repositories, leading)`` of every candidate: distinct owners and repositories, and how many of
    these the owner with most has. All are 1 where all that hold it are copies of one text."""
    none = F.lit("")
    ends = [F.min("low").alias("low"), F.max("high").alias("high")]
    holder = [F.coalesce("owner", none).alias("o"), F.coalesce("repository", none).alias("r")]
    each = spans.select("hash", *holder, "whole").groupBy("hash", "o", "r").agg(F.min("whole").alias("low"), F.max("whole").alias("high"))
    by_owner = each.groupBy("hash", "o").agg(F.count("*").alias("n"), *ends)
    counted = {"owners": F.count("*"), "repositories": F.sum("n"), "leading": F.max("n")}
    known = by_owner.groupBy("hash").agg(*(c.alias(n) for n, c in counted.items()), *ends)
    one_text = F.col("low") == F.col("high")
    return known.select("hash", *(F.when(one_text, F.lit(1)).otherwise(F.col(n)).cast("long").alias(n) for n in counted))


def scan(documents: DataFrame, owner: Column, repository: Column, max_owners: int = 1) -> tuple[DataFrame, DataFrame]:
    """Rows with their id, and spans ``(row, kind, start, end, hash, owners, repositories, live)``."""
    rows, spans = candidates(documents, owner, repository)
    known = spans.join(ownership(spans), "hash")
    live = (F.col("owners") <= max_owners) | (2 * F.col("leading") > F.col("repositories"))
    return rows, known.withColumn("live", live).where("kind <> 'live' or live").drop("owner", "repository", "whole", "leading")


def _joined(spans: Column) -> Column:
    listed = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(listed, ",")


def report(documents: DataFrame, owner: Column, repository: Column, max_owners: int = 1) -> DataFrame:
    """One row per document: counts by kind, the digest of base spans, all spans, live and shared ones."""
    rows, spans = scan(documents, owner, repository, max_owners)
    rank = F.array_position(F.array(*(F.lit(k) for k in KINDS)), F.col("kind"))
    listed = spans.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind", "live"))).alias("all")
    )
    every = F.coalesce("all", F.expr("cast(array() as array<struct<start:bigint,rank:bigint,end:bigint,kind:string,live:boolean>>)"))
    base = F.filter(every, lambda s: s["kind"] != "live")

    def count(test) -> Column:
        return F.size(F.filter(every, test)).cast("long")

    def of(kind: str) -> Column:
        return count(lambda s: s["kind"] == kind)

    return rows.join(listed, "row", "left").select(
        "doc_id",
        *(of(k).alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(every).alias("spans"),
        count(lambda s: s["live"]).alias("n_live"),
        count(lambda s: ~s["live"]).alias("n_shared"),
    )


def redact(documents: DataFrame, owner: Column, repository: Column, max_owners: int = 1) -> DataFrame:
    """``documents`` with every span replaced by ``[kind]``; ``n_chars`` follows the text.

    Where spans overlap, the one that begins first covers the others. Documents
    without spans stay as they are.
    """
    marked = documents.select(F.struct("*").alias("doc"), F.xxhash64("text").alias("key"))
    rows, spans = scan(documents.withColumn("doc_id", F.struct("doc_id", F.xxhash64("text").alias("key"))), owner, repository, max_owners)
    listed = (
        spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("all"))
        .join(rows, "row")
        .groupBy("doc_id").agg(F.first("all").alias("all"))
        .select(F.col("doc_id.doc_id").alias("id"), F.col("doc_id.key").alias("hash"), "all")
    )
    joined = marked.join(listed, F.col("doc.doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("hash")), "left")
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    whole = F.col("doc.text")

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(whole, (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        out = F.concat(acc["out"], gap, F.when(s["start"] >= acc["at"], F.concat(F.lit("["), s["kind"], F.lit("]"))).otherwise(""))
        return F.struct(out.alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    done = F.aggregate("all", start, step)
    text = F.when(F.col("all").isNull(), whole).otherwise(
        F.concat(done["out"], F.substring(whole, (done["at"] + 1).cast("int"), F.lit(1 << 30)))
    )
    changed = joined.withColumn("text", text)
    size = F.when(F.col("all").isNull(), F.col("doc.n_chars")).otherwise(F.length("text").cast("long"))
    new = {"text": F.col("text"), "n_chars": size}
    return changed.select(*(new.get(c, F.col("doc")[c]).alias(c) for c in documents.columns))
