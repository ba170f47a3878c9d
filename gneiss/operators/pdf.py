"""Page and object structure of documents, on extracted tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gneiss.functions import values as V
from gneiss.sources.workspace import written


def coverage(rects: DataFrame, keys: list[str]) -> DataFrame:
    """The share of each page that the union of its rectangles covers, rounded to 8 digits.

    ``rects`` has the keys, width and height of the page, and x0, y0, x1, y1.  The page is cut into
    slabs between the rectangles' edges; in a slab, overlapping intervals are merged by a running maximum.
    """
    page = ["width", "height"]
    clip = lambda lo, hi, top: (F.greatest(F.least(lo, hi), F.lit(0.0)), F.least(F.greatest(lo, hi), F.col(top)))
    x0, x1 = clip(F.col("x0"), F.col("x1"), "width")
    y0, y1 = clip(F.col("y0"), F.col("y1"), "height")
    cut = rects.select(*keys, *page, x0.alias("l"), x1.alias("r"), y0.alias("t"), y1.alias("b")).where("l < r AND t < b")
    edges = cut.select(*keys, F.explode(F.array("l", "r")).alias("a")).distinct()
    slabs = edges.withColumn("z", F.lead("a").over(Window.partitionBy(*keys).orderBy("a"))).where("z IS NOT NULL")
    inside = slabs.join(cut, keys).where("l <= a AND r >= z")
    w = Window.partitionBy(*keys, "a").orderBy("t", "b")
    reach = F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1))
    own = F.greatest(F.lit(0.0), F.col("b") - F.greatest(F.col("t"), F.coalesce(reach, F.col("t"))))
    covered = inside.withColumn("area", own * (F.col("z") - F.col("a"))).groupBy(*keys).agg(F.sum("area").alias("area"))
    pages = rects.groupBy(*keys).agg(F.max("width").alias("width"), F.max("height").alias("height"))
    share = F.coalesce(V.ratio(F.col("area"), F.col("width") * F.col("height")), F.lit(0.0))
    return pages.join(covered, keys, "left").select(*keys, F.round(F.least(F.lit(1.0), share), 8).alias("coverage"))


def classify_pages(pages: DataFrame) -> DataFrame:
    """``pages`` with class_name, rationale and full_page_raster."""
    return pages.withColumns(
        {
            "class_name": V.page_class("image_coverage", "text_chars"),
            "rationale": V.page_rationale("image_coverage", "text_chars", "text_blocks"),
            "full_page_raster": F.col("image_coverage") >= 0.70,
        }
    )


def categorize(objects: DataFrame, images: DataFrame, fonts: DataFrame, contents: DataFrame) -> DataFrame:
    """``objects`` (file_sha256, xref) with category: image before font before content before other."""
    out = objects
    for name, rows in (("image", images), ("font", fonts), ("content", contents)):
        marked = rows.select("file_sha256", "xref").distinct().withColumn(f"__{name}", F.lit(True))
        out = out.join(marked, ["file_sha256", "xref"], "left")
    kind = F.when(F.col("__image"), "image").when(F.col("__font"), "font").when(F.col("__content"), "content").otherwise("other")
    return out.withColumn("category", kind).drop("__image", "__font", "__content")


def summarize_files(files: DataFrame, objects: DataFrame) -> DataFrame:
    """By file: encoded bytes and objects of each category, and what of the file is in none (may be negative)."""
    names = ["image", "font", "content", "other"]
    g = objects.groupBy("file_sha256").agg(
        *[F.coalesce(F.sum(F.when(F.col("category") == c, F.col("encoded_bytes"))), F.lit(0)).cast("bigint").alias(f"{c}_bytes") for c in names],
        *[F.count_if(F.col("category") == c).alias(f"{c}_objects") for c in names],
    )
    held = sum((F.coalesce(F.col(f"{c}_bytes"), F.lit(0)) for c in names), F.lit(0))
    out = files.join(g.withColumnRenamed("file_sha256", "sha256"), "sha256", "left")
    return out.withColumn("residual_file_bytes", (F.col("source_bytes") - held).cast("bigint"))


def image_details(images: DataFrame) -> DataFrame:
    """Images with their filter chain and terminal filter."""
    return images.withColumns({"chain": V.filter_chain("filters"), "codec": F.coalesce(V.last_filter("filters"), F.lit("unfiltered"))})


def page_images(pages: DataFrame) -> DataFrame:
    """A row for each image on a page."""
    return pages.select("sha256", "page_number", F.explode("images").alias("i")).select("sha256", "page_number", "i.*")


def resolve_placements(placements: DataFrame, resources: DataFrame) -> DataFrame:
    """Placements with the resource of the same page, size and depth: resolved if it is the only one, ambiguous if several are, else missing."""
    keys = ["file_sha256", "page_number", "width", "height", "bpc"]
    found = resources.groupBy(*keys).agg(F.count_distinct("xref").alias("candidates"), F.min("xref").alias("xref"))
    joined = placements.join(found, keys, "left")
    state = F.when(F.col("candidates").isNull(), "missing").when(F.col("candidates") == 1, "resolved").otherwise("ambiguous")
    return joined.withColumn("state", state).withColumn("xref", F.when(F.col("state") == "resolved", F.col("xref")))


def font_programs(references: DataFrame, fonts: DataFrame) -> DataFrame:
    """(file_sha256, font, program) by following references from each font; a reference is followed once.

    ``references`` has file_sha256, xref, key and target; descriptors and descendants are followed, and a
    FontFile key ends the search.  It goes on until no font leads further, however long the chains are; each step
    is a table of its own, so no step is done twice.
    """
    steps = references.where(F.col("key").isin("FontDescriptor", "DescendantFonts")).select("file_sha256", F.col("xref").alias("at"), "target")
    ends = references.where(F.col("key").isin("FontFile", "FontFile2", "FontFile3")).select("file_sha256", F.col("xref").alias("at"), F.col("target").alias("program"))
    reached = fonts.select("file_sha256", F.col("xref").alias("font"), F.col("xref").alias("at"), F.array("xref").alias("path"))
    reached = written(reached)
    every = reached.select("file_sha256", "font", "at")
    while reached.limit(1).count():  # cycles end by the path
        reached = written(reached.join(steps, ["file_sha256", "at"]).where(~F.array_contains("path", F.col("target"))).select("file_sha256", "font", F.col("target").alias("at"), F.array_append("path", F.col("target")).alias("path")))
        every = every.unionByName(reached.select("file_sha256", "font", "at"))
    return every.join(ends, ["file_sha256", "at"]).select("file_sha256", "font", "program").distinct()


def resource_counts(pages: DataFrame, objects: DataFrame) -> DataFrame:
    """Distinct images on pages, and distinct objects of each category, by file."""
    images = pages.select(F.col("sha256").alias("file_sha256"), F.explode_outer("images").alias("i")).groupBy("file_sha256").agg(F.count_distinct("i.xref").alias("image_resources"))
    found = objects.groupBy("file_sha256").agg(*[F.count_distinct(F.when(F.col("category") == c, F.col("xref"))).alias(f"{c}_objects") for c in ("image", "font", "content")])
    return images.join(found, "file_sha256", "full_outer").na.fill(0)


def codec_by_type(objects: DataFrame, files: DataFrame) -> DataFrame:
    """Bytes by document type and codec; a file of several types counts in each."""
    types = files.select(F.col("sha256").alias("file_sha256"), F.explode(F.array_distinct(F.transform("sources", lambda s: s["document_type"]))).alias("document_type"))
    coded = objects.select("file_sha256", V.filter_chain("filters").alias("codec"), "encoded_bytes")
    return coded.join(types, "file_sha256").groupBy("document_type", "codec").agg(F.sum("encoded_bytes").cast("bigint").alias("bytes"), F.count("*").alias("n"))


def codec_family(objects: DataFrame) -> DataFrame:
    """Bytes of objects with a JPEG filter anywhere in their chain, and by whole chain."""
    jpeg = F.array_contains("filters", "DCTDecode")
    return objects.groupBy(V.filter_chain("filters").alias("chain"), jpeg.alias("jpeg")).agg(F.sum("encoded_bytes").cast("bigint").alias("bytes"), F.count("*").alias("n"))


def cohort(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """One row: outcomes of the chosen files only."""
    own = rows.join(chosen.select("sha256"), "sha256", "left_semi")
    return own.agg(F.count("*").alias("selected"), F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.col("status") != "ok").alias("not_ok"))


def cohort_failures(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """The chosen files that failed."""
    return rows.where(F.col("status") != "ok").join(chosen.select("sha256"), "sha256", "left_semi").select("sha256")


def isolate(df: DataFrame, work, schema: str, key: str) -> DataFrame:
    """``work`` (a function from a row's dict to a dict) on every row; an exception is a row with status failed and its message."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    whole = f"{key} {df.schema[key].dataType.simpleString()}, status string, error string, {schema}"
    arrow = to_arrow_schema(_parse_datatype_string(whole))

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                try:
                    out.append({key: row[key], "status": "ok", "error": None, **work(row)})
                except Exception as e:
                    out.append({key: row[key], "status": "failed", "error": f"{type(e).__name__}: {e}"})
            yield pa.RecordBatch.from_pylist(out, arrow)

    return df.mapInArrow(run, whole)


def usage_counts(images: DataFrame, trials: DataFrame) -> DataFrame:
    """One row: images, those with a known placement and those that fill a page, and how many streams were tried."""
    seen = images.agg(F.count("*").alias("images"), F.count_if(F.size("page_numbers") > 0).alias("placed"), F.count_if(F.col("fullscan")).alias("fullscan"), F.count_if(F.col("usage") == "ambiguous").alias("ambiguous"))
    tried = trials.agg(F.count("*").alias("trials"), F.count_if(F.col("exact")).alias("exact_trials"))
    return seen.join(tried)


def fidelity_sample(sample: DataFrame, files: DataFrame, pages: DataFrame, texts: DataFrame) -> DataFrame:
    """First, middle and last pages of sampled files with their text, tags and whether sorting changes the text.

    ``sample`` has sha256 and stratum, ``texts`` sha256, page_number, text and sorted_text.
    """
    from gneiss.functions import text as T

    chosen = files.join(sample, "sha256").select("sha256", "stratum", F.col("sources")[0]["title"].alias("title"), F.col("sources")[0]["detail_url"].alias("source_url"), F.explode(V.first_middle_last("page_count")).alias("page_number"))
    facts = pages.select("sha256", "page_number", "class_name", "image_coverage", "text_chars")
    rows = chosen.join(facts, ["sha256", "page_number"]).join(texts, ["sha256", "page_number"], "left")
    return rows.withColumns({"sort_changes_sequence": F.coalesce(F.col("text") != F.col("sorted_text"), F.lit(False)), "tags": T.content_tags(F.coalesce("text", F.lit("")), "image_coverage", "text_chars"), "review_status": F.lit("not_visually_reviewed")})
