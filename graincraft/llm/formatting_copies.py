"""Records that are equal but for white space, letter case, punctuation and the order of labelled parts.

A record is hashed from its leaves upward: a leaf is its text without marks and white space in lower case (a mark between
two digits stays), a path is the digest of its levels' digests in order, a description with labelled parts that of its
parts' digests sorted, the record that of both. Equal root digests make a group, and each member is compared with the
group's first record in full, by its normalised content, before it counts as a copy.

Groups are found by partial aggregation (a digest, its smallest and its largest row_id), so a group of any size is one
small row before the shuffle; members then join their group's one row, and adaptive execution may split that join's hot
partitions.

Defined results: a null path equals an empty one, a null level an empty level; a null description equals an empty one;
the same row_id delivered again is no copy. A record whose content is empty throughout is a copy of other such records.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialise
from . import lookalikes

#: Marks that may separate labelled parts, and those that stand between a label and its value.
SEPARATORS = r";；,，|｜。\.、/"
LABEL_MARKS = ":：=＝"


def _folds() -> tuple[str, str]:
    """Characters and the ones they are folded to: full width, look-alike letters, accented Latin letters."""
    table = dict(lookalikes.TO_LATIN)
    table |= {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}
    for c in map(chr, range(0xC0, 0x250)):
        base = unicodedata.normalize("NFD", c)[0]
        if base != c and base.isascii():
            table[c] = base
    for c in map(chr, [*range(0x2F00, 0x2FD6), *range(0xF900, 0xFAD9)]):
        plain = unicodedata.normalize("NFKC", c)
        if plain != c and len(plain) == 1:
            table[c] = plain
    table |= {k: v for k, v in lookalikes.KANA.items()}
    table["α"] = "a"
    return "".join(table), "".join(table.values()).lower()


_FROM, _TO = _folds()


def leaf(text: Column) -> Column:
    """A text without marks and white space, in lower case; a mark between two digits stays."""
    t = F.regexp_replace(F.lower(F.translate(text, _FROM, _TO)), r"[\s\p{Z}\p{C}\p{M}]+", "")
    return F.regexp_replace(t, r"(?<![0-9])[^\p{L}\p{N}]+|[^\p{L}\p{N}]+(?![0-9])", "")


def parts(text: Column) -> Column:
    """The labelled parts of a description, or the whole as one part."""
    t = F.regexp_replace(text, r"[^\S\n]+|[·•‧・]", "")
    marks = rf"[{SEPARATORS}\s]*[{SEPARATORS}][{SEPARATORS}\s]*(?=[\p{{L}}\p{{M}}\n]{{1,40}}[{LABEL_MARKS}])"
    labels = F.regexp_count(t, F.lit(rf"[\p{{L}}\p{{M}}]\s*[{LABEL_MARKS}]"))
    by_marks = F.split(t, marks)
    by_lines = F.split(t, rf"\n+(?=[\p{{L}}\p{{M}}]{{1,40}}[{LABEL_MARKS}])")
    return F.when(labels < 2, F.array(t)).when(F.size(by_marks) > 1, by_marks).otherwise(by_lines)


def normalised(df: DataFrame, path: str = "path_levels", description: str = "description", key: str = "row_id") -> DataFrame:
    """key, the root digest and the normalised content of each record."""
    levels = F.transform(F.coalesce(F.col(path), F.array().cast("array<string>")), lambda x: leaf(F.coalesce(x, F.lit(""))))
    pieces = F.array_sort(F.filter(F.transform(parts(F.coalesce(F.col(description), F.lit(""))), leaf), lambda x: x != ""))
    content = df.select(key, levels.alias("levels"), pieces.alias("pieces"))

    def node(children: str) -> Column:
        return F.md5(F.concat_ws("", F.transform(F.col(children), lambda x: F.md5(x))))

    root = F.md5(F.concat(node("levels"), node("pieces")))
    return content.select(key, F.unhex(root).alias("digest"), "levels", "pieces")


def _groups(leaves: DataFrame, key: str) -> DataFrame:
    return leaves.groupBy("digest").agg(F.min(key).alias("first"), F.max(key).alias("last")).where("first <> last").select("digest", "first")


def copies(df: DataFrame, path: str = "path_levels", description: str = "description", key: str = "row_id") -> DataFrame:
    """row_id_a, the smallest of a set of equal records, and row_id_b, each of the others."""
    leaves = materialise(normalised(df, path, description, key), "p5")
    groups = _groups(leaves, key)
    members = leaves.join(groups, "digest")
    firsts = members.where(F.col(key) == F.col("first")).groupBy("digest").agg(F.first(F.struct("levels", "pieces")).alias("own"))
    others = members.where(F.col(key) != F.col("first"))
    same = (F.col("levels") == F.col("own.levels")) & (F.col("pieces") == F.col("own.pieces"))
    return others.join(firsts, "digest").where(same).select(F.col("first").alias("row_id_a"), F.col(key).alias("row_id_b")).distinct()


def collapsed(df: DataFrame, path: str = "path_levels", description: str = "description", key: str = "row_id") -> DataFrame:
    """One row for each set of equal records: its smallest row_id and the number of its row_ids. Records without a copy have 1."""
    found = copies(df, path, description, key)
    counts = found.groupBy("row_id_a").agg((F.count(F.lit(1)) + 1).alias("n_copies"))
    first = df.select(F.col(key).alias("row_id")).distinct().join(found.select(F.col("row_id_b").alias("row_id")), "row_id", "left_anti")
    return first.join(counts.withColumnRenamed("row_id_a", "row_id"), "row_id", "left").select("row_id", F.coalesce("n_copies", F.lit(1)).cast("bigint").alias("n_copies"))
