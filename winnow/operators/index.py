"""Section indices: merging what index pages list, and looking up a page's procedures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import derived_slug, normal_page_id


def merge_procedures(entries: DataFrame) -> DataFrame:
    """(section, code, name, pages, warnings) from rows (section, ord, code, name, page, error).

    Rows with an error or without a code are skipped. The first row of a code gives its name; its
    page counts unless empty, later pages always do, and later names that differ give warnings.
    Pages are sorted.
    """
    good = entries.filter(F.col("error").isNull() & (F.coalesce("code", F.lit("")) != "")).withColumns({"name": F.coalesce("name", F.lit("")), "page": F.coalesce("page", F.lit(""))})
    first = good.groupBy("section", "code").agg(F.min("ord").alias("__first"), F.min_by("name", "ord").alias("first_name"))
    met = good.join(first, ["section", "code"])
    page = F.when((F.col("page") != "") | (F.col("ord") > F.col("__first")), F.col("page"))
    other = (F.col("ord") > F.col("__first")) & (F.col("name") != F.col("first_name")) & (F.col("name") != "")
    warn = F.when(other, F.struct("ord", F.format_string("Code %s: name mismatch '%s' vs '%s'", "code", "first_name", "name").alias("w")))
    return met.groupBy("section", "code").agg(F.first("first_name").alias("name"), F.array_sort(F.collect_set(page)).alias("pages"), F.transform(F.array_sort(F.collect_list(warn)), lambda x: x["w"]).alias("warnings"))


def page_to_codes(procedures: DataFrame) -> DataFrame:
    """(section, page, codes): the codes of each page, in order of code."""
    return procedures.select("section", F.explode("pages").alias("page"), "code").groupBy("section", "page").agg(F.array_sort(F.collect_list("code")).alias("codes"))


def merge_sections(entries: DataFrame) -> DataFrame:
    """One row per section: section_id, section_name, index_pages, procedures, page_to_procedures, merge_warnings.

    entries has, besides what merge_procedures reads, section_id, section_name and source_filename.
    """
    good = entries.filter(F.col("error").isNull())
    pages = good.groupBy("section", F.coalesce("source_filename", F.lit("unknown")).alias("f")).agg(F.min("ord").alias("o"))
    head = good.groupBy("section").agg(F.min_by("section_id", F.when(F.coalesce("section_id", F.lit("")) != "", F.col("ord"))).alias("section_id"), F.min_by("section_name", F.when(F.coalesce("section_name", F.lit("")) != "", F.col("ord"))).alias("section_name"))
    files = pages.groupBy("section").agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "f"))), lambda x: x["f"]).alias("index_pages"))
    procedures = merge_procedures(entries)
    merged = procedures.groupBy("section").agg(F.array_sort(F.collect_list(F.struct("code", "name", "pages"))).alias("procedures"), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("code", "warnings"))), lambda x: x["warnings"])).alias("merge_warnings"))
    lookup = page_to_codes(procedures).groupBy("section").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("page", "codes")))).alias("page_to_procedures"))
    return entries.select("section").distinct().join(head, "section", "left").join(files, "section", "left").join(merged, "section", "left").join(lookup, "section", "left")


def with_procedures(pages: DataFrame, procedures: DataFrame) -> DataFrame:
    """pages with procedures_covered and procedures_names, by section slug and normalised page id, else by the id as it is.

    A code's name travels with it, so a page's row holds what it covers and nothing else of its
    section. pages has page_id, section_id and section_name.
    """
    each = F.array_sort(F.collect_list(F.when(F.col("code").isNotNull(), F.struct("code", "name"))))
    listed = procedures.select("section", F.explode("pages").alias("page"), "code", "name").groupBy("section", "page").agg(each.alias("listed"))
    keyed = pages.withColumn("__slug", derived_slug("section_id", "section_name")).withColumn("__norm", normal_page_id("page_id"))
    one = listed.select(F.col("section").alias("__slug"), F.col("page").alias("__norm"), F.col("listed").alias("__a"))
    two = listed.select(F.col("section").alias("__slug"), F.col("page").alias("page_id"), F.col("listed").alias("__b"))
    met = keyed.join(one, ["__slug", "__norm"], "left").join(two, ["__slug", "page_id"], "left").withColumn("__c", F.coalesce("__a", "__b"))
    of = lambda name: F.coalesce(F.transform("__c", lambda c: c[name]), F.array().cast("array<string>"))
    return met.withColumn("procedures_covered", of("code")).withColumn("procedures_names", of("name")).select(*pages.columns, "procedures_covered", "procedures_names")


def last_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key: how a result cache is read."""
    return rows.withColumn("__rn", F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc()))).filter("__rn = 1").drop("__rn")


def with_cache(new: DataFrame, cache: DataFrame, key: str = "page_id") -> tuple[DataFrame, DataFrame]:
    """(rows of new that the cache lacks, rows of the cache): process the first, union the second."""
    return new.join(cache.select(key).distinct(), key, "left_anti"), cache
