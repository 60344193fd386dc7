"""Operator 1: corpus-wide line deduplication, DataFrame functions only.

Lines are exploded, normalised and hashed; documents are counted per hash
without their texts, and only the positions of the lines to drop meet the
text again. A hash that a third of all rows share is aggregated map-side, and
the join that finds its positions is one that AQE splits by skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.store import ASCII_SPACE, ascii_lower, col, hash128, stage


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 10,
    min_docs: int = 2,
) -> DataFrame:
    """Drop lines that ``min_docs`` or more documents share, except in the
    document with the smallest id.

    A line's key is the line without ASCII white space at both ends and with
    A-Z lower-cased; keys under ``min_chars`` code points are never dropped.

    Returns every row of ``docs`` with its columns, ``text_col`` replaced by
    the kept lines joined by ``\\n``, plus ``n_lines`` (before dropping) and
    ``n_dropped``; input columns of these two names are replaced.

    Null or empty text is one empty line and becomes the empty text. A null id
    is no document: it counts for no line and loses none. Rows that repeat an
    id count as one document; each is returned, cut by its own lines. An empty
    input gives an empty result.
    """
    packed = docs.select(
        F.struct(*[col(c) for c in docs.columns if c not in ("n_lines", "n_dropped")]).alias("row"),
        col(id_col).alias("id"),
        F.coalesce(col(text_col), F.lit("")).alias("text"),
    ).withColumn("version", F.xxhash64("text"))

    stripped = F.btrim(F.col("line"), F.lit(ASCII_SPACE))
    h1, h2 = hash128(ascii_lower(stripped))
    lines = (
        packed.where("id IS NOT NULL")
        .select("id", "version", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
        .where(F.char_length(stripped) >= min_chars)
        .select("id", "version", "pos", h1.alias("h1"), h2.alias("h2"))
    )
    # Staged, as are the drops below, so that both sides of the next join are
    # plain exchanges: only then can AQE split the partition of a hash, or an
    # id, that very many rows have.
    shared = stage(
        lines.groupBy("h1", "h2")
        .agg(F.count_distinct("id").alias("n_docs"), F.min("id").alias("first_id"))
        .where(F.col("n_docs") >= min_docs)
        .drop("n_docs"),
        "shared-lines",
    )
    drops = stage(
        lines.join(shared, ["h1", "h2"])
        .where("id <> first_id")
        .groupBy("id", "version")
        .agg(F.collect_set("pos").alias("drops")),
        "dropped-lines",
    )
    lines_of = F.split("text", "\n")
    kept_at = F.array_except(F.sequence(F.lit(0), F.size(lines_of) - 1), F.col("drops"))
    # The lines are bound once: inside the inner lambda they would be split
    # from the text anew for every line that stays.
    joined = F.transform(
        F.array(lines_of), lambda lines: F.array_join(F.transform(kept_at, lambda i: F.get(lines, i)), "\n")
    )
    kept = F.when(F.col("drops").isNull(), F.col("text")).otherwise(F.get(joined, F.lit(0)))
    out = packed.join(drops, ["id", "version"], "left").select(
        "row",
        kept.alias("kept"),
        F.size(lines_of).cast("long").alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"),
    )
    fields = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return out.select(
        *[(F.col("kept") if c == text_col else F.col("row").getField(c)).alias(c) for c in fields],
        "n_lines",
        "n_dropped",
    )
