"""Asset tables, captions, links and replacements."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions import text as tx
from corpusprep.operators.lookup import lookup


def asset_type(name: Column | str, kinds: Sequence[tuple[str, str]], default: str) -> Column:
    """The first kind whose pattern occurs in the lower-cased name."""
    lowered = F.lower(tx.col(name))
    out = None
    for kind, pattern in kinds:
        out = (F if out is None else out).when(lowered.rlike(pattern), F.lit(kind))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def page_number(name: Column | str, pattern: str = r"_page_(\d+)(?:_|$)") -> Column:
    """The page number in a name, NULL when absent or no number."""
    return F.regexp_extract(tx.col(name), pattern, 1).try_cast("int")


def render_prompt(kind: Column, caption: Column, base: str, per_kind: Mapping[str, str],
                  caption_lead: str = " Caption/context: ") -> Column:
    """Base text, the text of the kind, and the caption if there is one."""
    table = F.create_map(*[F.lit(x) for pair in per_kind.items() for x in pair])
    return F.concat(
        F.lit(base), F.coalesce(F.element_at(table, kind), F.lit("")),
        F.when(F.length(caption) > 0, F.concat(F.lit(caption_lead), caption)).otherwise(F.lit("")),
    )


def attach_captions(assets: DataFrame, captions: DataFrame, on: Sequence[str],
                    row_id: Sequence[str], **skew: int) -> DataFrame:
    """Left join of one caption per key; '' where there is none."""
    joined = lookup(assets, captions.select(*on, "caption"), on, row_id, **skew)
    return joined.withColumn("caption", F.coalesce("caption", F.lit("")))


def asset_table(
    files: DataFrame, captions: DataFrame, kinds: Sequence[tuple[str, str]], default_kind: str,
    base: str, per_kind: Mapping[str, str], folder: str = "", path: str = "path",
    page_pattern: str = r"_page_(\d+)(?:_|$)", **skew: int,
) -> DataFrame:
    """The asset manifest: one row per file with its paths, kind, page, caption and prompt."""
    named = files.select(
        tx.basename(path).alias("file_name"), F.col(path).alias("source_path")
    )
    titled = attach_captions(named, captions, ["file_name"], ["source_path"], **skew)
    kind = asset_type("file_name", kinds, default_kind)
    stem = F.regexp_replace("file_name", r"\.[^.]*$", "")
    return titled.select(
        "file_name", "source_path",
        F.concat(F.lit(f"{folder}input_images/"), "file_name").alias("input_path"),
        F.concat(F.lit(f"{folder}processed_images/"), "file_name").alias("processed_path"),
        F.concat(F.lit(f"{folder}prompts/"), stem, F.lit(".txt")).alias("prompt_path"),
        page_number("file_name", page_pattern).alias("page_number"),
        kind.alias("asset_type"), "caption",
        render_prompt(kind, F.col("caption"), base, per_kind).alias("prompt"),
    )


def apply_replacements(target: DataFrame, processed: DataFrame, key: str, value: str,
                       row_id: Sequence[str] | None = None, **skew: int) -> dict[str, DataFrame]:
    """Replace values whose key has a processed one.

    ``updated`` is the target after the change, ``backup`` the replaced rows as
    they were, ``skipped`` the processed rows without a target.
    """
    ids = list(row_id or [key])
    new = processed.select(key, F.col(value).alias("__new"), F.lit(True).alias("__hit"))
    both = lookup(target, new, [key], ids, **skew)
    others = [c for c in target.columns if c not in (key, value)]
    put = F.when(F.col("__hit"), F.col("__new")).otherwise(F.col(value))
    return {
        "updated": both.select(key, put.alias(value), *others),
        "backup": both.filter("__hit").select(*target.columns),
        "skipped": lookup(processed, target.select(key).distinct(), [key], [key], "left_anti", **skew),
    }


def resolve_links(
    links: DataFrame, inventory: DataFrame, row_id: Sequence[str], target: str = "target",
    path: str = "path", pages_per_chunk: int = 50, key: Column | None = None,
    absolute: str = r"^(?:images/|\./images/|\.\./|/)|://|(?i:^data:)",
    folder: str = "images/", **skew: int,
) -> DataFrame:
    """Add ``resolved`` and ``via``: ``kept``, ``exact``, ``name``, ``remap`` or ``unresolved``.

    External and absolute targets stay. Others are sought by full path, then by
    ``key`` (default: the base name), then by the name with its chunk-local page
    turned into a book page. What is not found stays as written.
    """
    clean = F.replace(tx.strip(target), F.lit("\\"), F.lit("/"))
    name = tx.basename(F.col("__t"))
    chunked = r"^chunk(\d+)__page_(\d+)_(.+)$"
    page = (F.regexp_extract(name, chunked, 1).try_cast("int") - 1) * pages_per_chunk \
        + F.regexp_extract(name, chunked, 2).try_cast("int")
    remapped = F.concat(F.lit("_page_"), page.cast("string"), F.lit("_"),
                        F.regexp_extract(name, chunked, 3))
    kept = F.col("__t").rlike(absolute)
    tried = links.withColumn("__t", clean).withColumns({
        "__kept": kept,
        "__k1": F.when(~kept, F.col("__t")),
        "__k2": F.when(~kept, key if key is not None else name),
        "__k3": F.when(~kept & name.rlike(chunked), remapped),
    })
    have = inventory.select(F.col(path).alias("__k")).distinct().withColumn("__hit", F.lit(True))
    # A row per candidate key, one lookup for all, and the best key per link by partial minimum.
    keys = F.filter(
        F.array(*[F.struct(F.lit(rank).alias("__rank"), F.col(f"__k{rank}").alias("__k")) for rank in (1, 2, 3)]),
        lambda c: c["__k"].isNotNull())
    asked = tried.select(*links.columns, "__t", "__kept", F.explode_outer(keys).alias("__c")).select(
        *links.columns, "__t", "__kept", "__c.*")
    looked = lookup(asked, have, ["__k"], [*row_id, "__rank"], **skew)
    others = [c for c in [*links.columns, "__t", "__kept"] if c not in row_id]
    best = looked.groupBy(*row_id).agg(
        *[F.any_value(c).alias(c) for c in others],
        F.min(F.when(F.col("__hit"), F.struct("__rank", "__k"))).alias("__best"))
    via = F.get(F.array(F.lit("exact"), F.lit("name"), F.lit("remap")), F.col("__best.__rank") - 1)
    answer = (
        F.when(F.col("__kept"), F.struct(F.lit("kept").alias("via"), F.col("__t").alias("resolved")))
        .when(F.col("__best").isNotNull(), F.struct(
            via.alias("via"), F.concat(F.lit(folder), F.col("__best.__k")).alias("resolved")))
        .otherwise(F.struct(F.lit("unresolved").alias("via"), F.col(target).alias("resolved")))
    )
    return best.select(*links.columns, answer.alias("__r")).select(
        *links.columns, "__r.via", "__r.resolved")
